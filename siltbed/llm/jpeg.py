"""Media columns: baseline JPEG read and written with numpy.

Reading: ``parse`` walks the markers of a baseline (sequential, Huffman, 8-bit)
JPEG, of one scan or several; every image is read through it.  ``dc_thumbnails``
Huffman-decodes the scan of the first component and rebuilds the luminance
thumbnail from DC coefficients alone, one sample per 8 x 8 block.  Restart
intervals are independent, so the decoder steps through all intervals of many
images at once, one symbol of each per numpy call.

Writing: ``encode_samples`` stores 8-bit samples losslessly as the DC
coefficients of a grey image: each sample is one flat 8 x 8 block, its DC
quantiser is 8, so the DC-only thumbnail is exactly the samples.  Rows hold 192
blocks and are restart intervals; an image has at most 8,191 rows (65,528
lines), and longer payloads continue in further images.

Cases: null and empty texts become one row of 192 spaces.  Texts of any length
are cut into images of bounded size, so memory stays bounded.  Truncated or
foreign streams raise ``ValueError``.  Equal texts give equal rows.  An empty
table gives an empty result.  Only the id and text columns are read.
"""

from __future__ import annotations

import hashlib
import re
import struct
import zlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from .shared import bounded_batches, chunks, lean

ROW = 192
MAX_ROWS = 8191
#: Payload bytes handled at once.
BATCH_BYTES = 1 << 20

# Code lengths of the DC categories 0 to 8 in the files written here.
DC_LENGTHS = {2: 3, 3: 3, 4: 3, 5: 3, 6: 3, 0: 4, 1: 4, 7: 4, 8: 5}
# Fixed value: the one AC symbol needed is "end of block", as the code 0.
AC_LENGTHS = {0: 1}


def _huffman_spec(lengths: dict[int, int]) -> tuple[bytes, bytes]:
    """(16 counts, symbols) of a table, as in its DHT segment."""
    order = sorted(lengths, key=lambda s: (lengths[s], s))
    return bytes(sum(n == k for n in lengths.values()) for k in range(1, 17)), bytes(order)


def _codes(counts: bytes, symbols: bytes) -> dict[int, tuple[int, int]]:
    """symbol: (code, length), by the canonical rule."""
    out, code, at = {}, 0, 0
    for length, n in enumerate(counts, 1):
        for _ in range(n):
            out[symbols[at]] = (code, length)
            code += 1
            at += 1
        code <<= 1
    return out


@lru_cache(maxsize=64)
def _lookup(counts: bytes, symbols: bytes) -> np.ndarray:
    """For each 16-bit prefix: length * 256 + symbol; 0 for no code."""
    table = np.zeros(1 << 16, np.int64)
    for s, (code, length) in _codes(counts, symbols).items():
        a = code << (16 - length)
        table[a : a + (1 << (16 - length))] = length << 8 | s
    return table


@lru_cache(maxsize=1)
def _writer() -> tuple[np.ndarray, np.ndarray, bytes, bytes]:
    """Value and length of each difference -255..255 with its end of block, and the parts of the header."""
    dc, ac = _huffman_spec(DC_LENGTHS), _huffman_spec(AC_LENGTHS)
    codes, (eob, eob_length) = _codes(*dc), _codes(*ac)[0]
    value, length = np.zeros(511, np.int64), np.zeros(511, np.int64)
    for d in range(-255, 256):
        size = abs(d).bit_length()
        code, n = codes[size]
        extra = d if d >= 0 else d + (1 << size) - 1
        value[d + 255] = ((code << size | extra) << eob_length) | eob
        length[d + 255] = n + size + eob_length
    seg = lambda marker, body: struct.pack(">BBH", 0xFF, marker, len(body) + 2) + body
    head = b"\xff\xd8" + seg(0xDB, bytes([0, 8]) + bytes([1]) * 63)
    tail = seg(0xC4, b"\x00" + dc[0] + dc[1]) + seg(0xC4, b"\x10" + ac[0] + ac[1])
    tail += seg(0xDD, struct.pack(">H", ROW)) + seg(0xDA, bytes([1, 1, 0, 0, 63, 0]))
    return value, length, head, tail


def encode_samples(parts: list[bytes]) -> list[bytes]:
    """One JPEG for each part; a part has 1 to MAX_ROWS rows of ROW samples."""
    value, length, head, tail = _writer()
    rows = [len(p) // ROW for p in parts]
    if any(len(p) % ROW or not 0 < n <= MAX_ROWS for p, n in zip(parts, rows, strict=True)):
        raise ValueError("a part is not 1 to 8,191 whole rows")
    x = np.frombuffer(b"".join(parts), np.uint8).reshape(-1, ROW).astype(np.int16)
    d = np.empty_like(x)
    d[:, 0] = x[:, 0] - 128
    np.subtract(x[:, 1:], x[:, :-1], out=d[:, 1:])
    d += 255
    n = length[d]
    ends = np.cumsum(n, axis=1)
    row_bytes = (ends[:, -1] + 7) // 8
    row_end = np.cumsum(row_bytes)
    at = ((row_end - row_bytes) * 8)[:, None] + ends - n
    bits = (value[d] << (24 - (at & 7) - n)).ravel()
    byte = (at >> 3).ravel()
    total = int(row_end[-1])
    out = np.zeros(total + 2)
    for k in range(3):
        out += np.bincount(byte + k, weights=(bits >> (16 - 8 * k)) & 255, minlength=total + 2)[: total + 2]
    raw = out[:total].astype(np.uint8)
    raw[row_end - 1] |= ((1 << (row_bytes * 8 - ends[:, -1])) - 1).astype(np.uint8)

    first = np.concatenate([[0], np.cumsum(rows)])
    number = np.arange(len(x)) - np.repeat(first[:-1], rows)
    inner = np.ones(len(x), bool)
    inner[first[1:] - 1] = False  # no restart marker after an image's last row
    more = (raw == 255).astype(np.int64)
    stuffed_last = more[row_end - 1].copy()
    more[row_end[inner] - 1] += 2
    place = np.arange(total) + np.cumsum(more) - more
    final = np.zeros(total + int(more.sum()), np.uint8)
    final[place] = raw
    mark = place[row_end - 1] + stuffed_last + 1
    final[mark[inner]] = 255
    final[mark[inner] + 1] = 0xD0 + number[inner] % 8
    stop = mark[first[1:] - 1]
    start = np.concatenate([[0], stop[:-1]])
    data = final.tobytes()
    return [
        head
        + struct.pack(">BBHBHHB", 0xFF, 0xC0, 11, 8, r * 8, ROW * 8, 1)
        + bytes([1, 0x11, 0])
        + tail
        + data[a:b]
        + b"\xff\xd9"
        for r, a, b in zip(rows, start.tolist(), stop.tolist(), strict=True)
    ]


class Frame:
    """Header of one image and the scan that holds its first component.

    components: [(id, h, v, quantiser of DC, DC table, AC table)] of that scan; grid: its MCUs across and down;
    shape: blocks across and down of the first component; interval: MCUs between restarts; scan: its byte range.
    """

    def __init__(self):
        self.width = self.height = self.interval = 0
        self.components: list[list] = []
        self.grid = self.shape = self.scan = (0, 0)
        self.end = 0

    def layout(self) -> tuple:
        return (self.interval, tuple(tuple(c) for c in self.components))


#: The end of a scan: a marker that is neither a stuffed byte, a restart nor a fill byte.
_SCAN_END = re.compile(rb"\xff[^\x00\xd0-\xd7\xff]")


def parse(data: bytes, at: int = 0) -> Frame:
    """The frame that starts at ``at``, its markers walked one by one; ``end`` is where the next image would start."""
    if data[at : at + 2] != b"\xff\xd8":
        raise ValueError("no start of image")
    f, quant, tables, shape, order = Frame(), {}, {}, {}, []
    interval = 0
    at += 2
    while True:
        if data[at : at + 1] != b"\xff" or at + 2 > len(data):
            raise ValueError("a marker is missing")
        marker = data[at + 1]
        if marker == 0xFF:
            at += 1
            continue
        if marker == 0xD9:
            if not f.components:
                raise ValueError("no scan of the first component")
            f.end = at + 2
            return f
        if at + 4 > len(data):
            raise ValueError("a marker is missing")
        (n,) = struct.unpack_from(">H", data, at + 2)
        if at + 2 + n > len(data):
            raise ValueError("a segment is cut off")
        body = data[at + 4 : at + 2 + n]
        at += 2 + n
        if marker == 0xDB:
            while body:
                wide, k = body[0] >> 4, body[0] & 15
                quant[k] = int.from_bytes(body[1 : 2 + wide], "big")
                body = body[65 + 64 * wide :]
        elif marker == 0xC4:
            while body:
                m = sum(body[1:17])
                tables[body[0]] = (body[1:17], body[17 : 17 + m])
                body = body[17 + m :]
        elif marker == 0xDD:
            (interval,) = struct.unpack(">H", body)
        elif marker in (0xC0, 0xC1):
            depth, f.height, f.width, count = struct.unpack_from(">BHHB", body)
            if depth != 8 or not f.height or not f.width or len(body) < 6 + 3 * count or not count:
                raise ValueError("only 8-bit frames of known size are read")
            for k in range(count):
                i, hv, q = body[6 + 3 * k : 9 + 3 * k]
                shape[i] = (hv >> 4, hv & 15, q)
                order.append(i)
        elif 0xC2 <= marker <= 0xCF and marker != 0xC8:
            raise ValueError("only baseline frames are read")
        elif marker == 0xDA:
            if not order:
                raise ValueError("a scan comes before the frame")
            parts = [(body[1 + 2 * k], body[2 + 2 * k]) for k in range(body[0])]
            end = _SCAN_END.search(data, at)
            if not end:
                raise ValueError("the scan does not end")
            if any(i not in shape for i, _ in parts):
                raise ValueError("a scan of an unknown component")
            if parts[0][0] == order[0]:
                hmax, vmax = max(c[0] for c in shape.values()), max(c[1] for c in shape.values())
                h, v, _ = shape[order[0]]
                f.shape = (-(-(-(-f.width * h // hmax)) // 8), -(-(-(-f.height * v // vmax)) // 8))
                whole = (-(-f.width // (8 * hmax)), -(-f.height // (8 * vmax)))
                f.grid = f.shape if len(parts) == 1 else whole
                try:
                    f.components = [[i, *shape[i][:2], quant[shape[i][2]], tables[t >> 4], tables[16 | t & 15]] for i, t in parts]
                except KeyError as e:
                    raise ValueError("a table is missing") from e
                f.interval, f.scan = interval, (at, end.start())
            at = end.start()


def frames(data: bytes) -> list[Frame]:
    """All images of a media value, one after the other."""
    out, at = [], 0
    while at < len(data):
        f = parse(data, at)
        out.append(f)
        at = f.end
    return out


def _decode(scan: np.ndarray, lanes: np.ndarray, mcus: np.ndarray, blocks: list[tuple[int, np.ndarray, np.ndarray]], n_comp: int) -> list[np.ndarray]:
    """DC values of each block of an MCU: arrays (lane, MCU).  ``blocks``: (component, DC table, AC table)."""
    padded = np.concatenate([scan, np.zeros(16, np.uint8)]).astype(np.uint64)
    n = len(scan) + 8
    window = np.zeros(n, np.uint64)
    for k in range(5):
        window |= padded[k : k + n] << np.uint64(32 - 8 * k)
    window = window.view(np.int64)
    pos = lanes.astype(np.int64) * 8
    limit = len(scan) * 8 + 56
    steps = int(mcus.max(initial=0))
    out = [np.zeros((len(lanes), steps), np.int32) for _ in blocks]
    pred = [np.zeros(len(lanes), np.int64) for _ in range(n_comp)]
    even = bool((mcus == steps).all())
    for m in range(steps):
        live = None if even else np.flatnonzero(mcus > m)
        p = pos if even else pos[live]
        for b, (c, dc, ac) in enumerate(blocks):
            w = window[p >> 3] << (p & 7)
            e = dc[(w >> 24) & 0xFFFF]
            size, used = e & 255, e >> 8
            if not used.all() or (size > 11).any():
                raise ValueError("a code is unknown")
            used = used + size
            v = (w >> (40 - used)) & ((1 << size) - 1)
            v = np.where((size > 0) & (v < (1 << np.maximum(size - 1, 0))), v - (1 << size) + 1, v)
            p = p + used
            if even:
                pred[c] += v
                out[b][:, m] = pred[c]
            else:
                pred[c][live] += v
                out[b][live, m] = pred[c][live]
            # AC coefficients are stepped over.
            todo, k = None, np.ones(len(p), np.int64)
            while todo is None or len(todo):
                q = p if todo is None else p[todo]
                w = window[q >> 3] << (q & 7)
                e = ac[(w >> 24) & 0xFFFF]
                used, run, size = e >> 8, (e >> 4) & 15, e & 15
                if not used.all():
                    raise ValueError("a code is unknown")
                over = (e & 255) == 0
                if todo is None:
                    p = p + used + size
                    if over.all():
                        break
                    k = k + run + 1
                    todo = np.flatnonzero(~over & (k < 64))
                else:
                    p[todo] += used + size
                    k[todo] += run + 1
                    todo = todo[~over & (k[todo] < 64)]
            if p.max(initial=0) > limit:
                raise ValueError("the scan is too short")
        if even:
            pos = p
        else:
            pos[live] = p
    return out


def dc_thumbnails(items: list[tuple[bytes, Frame]]) -> list[np.ndarray]:
    """The luminance thumbnail of each image, uint8, one sample per 8 x 8 block of the first component."""
    out: list[np.ndarray | None] = [None] * len(items)
    groups: dict[tuple, list[int]] = {}
    for k, (_, f) in enumerate(items):
        groups.setdefault(f.layout(), []).append(k)
    for (interval, comps), members in groups.items():
        single = len(comps) == 1
        blocks = [(c, _lookup(*comp[4]), _lookup(*comp[5])) for c, comp in enumerate(comps) for _ in range(1 if single else comp[1] * comp[2])]
        scans, n_mcu, across = [], [], []
        for k in members:
            data, f = items[k]
            scans.append(data[f.scan[0] : f.scan[1]] + b"\x00\x00")
            n_mcu.append(f.grid[0] * f.grid[1])
            across.append(f.grid[0])
        raw = np.frombuffer(b"".join(scans), np.uint8)
        first = np.concatenate([[0], np.cumsum([len(s) for s in scans])])
        ff = np.flatnonzero(raw[:-1] == 255)
        nxt = raw[ff + 1]
        restart = (nxt >= 0xD0) & (nxt <= 0xD7)
        keep = np.ones(len(raw), bool)
        keep[ff[(nxt == 0)] + 1] = False
        keep[ff[nxt == 255]] = False
        keep[ff[restart]] = False
        keep[ff[restart] + 1] = False
        before = np.concatenate([[0], np.cumsum(keep)])
        breaks = np.sort(np.concatenate([first[:-1], ff[restart] + 2]))
        owner = np.searchsorted(first, breaks, "right") - 1
        nth = np.arange(len(breaks)) - np.searchsorted(owner, np.arange(len(members)))[owner]
        n_mcu = np.array(n_mcu)
        step = interval or int(n_mcu.max())
        mcus = np.clip(n_mcu[owner] - nth * step, 0, step)
        if (np.bincount(owner, weights=mcus, minlength=len(members)) != n_mcu).any():
            raise ValueError("restart markers are missing")
        dc = _decode(raw[keep], before[breaks], mcus, blocks, len(comps))
        used = 1 if single else comps[0][1] * comps[0][2]
        lo = np.searchsorted(owner, np.arange(len(members) + 1))
        for j, k in enumerate(members):
            f, a, b = items[k][1], lo[j], lo[j + 1]
            own = [x[a:b].reshape(-1)[: n_mcu[j]].reshape(-1, across[j]) for x in dc[:used]]
            if used == 1:
                grid = own[0]
            else:
                h, v = comps[0][1], comps[0][2]
                grid = np.empty((own[0].shape[0] * v, own[0].shape[1] * h), np.int32)
                for t, x in enumerate(own):
                    grid[t // h :: v, t % h :: h] = x
            grid = grid[: f.shape[1], : f.shape[0]]
            q = comps[0][3]
            out[k] = np.clip((grid * q + 4) // 8 + 128, 0, 255).astype(np.uint8)
    return out


def thumbnail_hash(samples: np.ndarray) -> str:
    """64 bits: the sample range cut into 64 runs, each brighter than the whole or not."""
    runs = samples.reshape(64, -1).sum(1, dtype=np.int64)
    bits = (runs * 64 > runs.sum()).astype(np.uint8)
    return np.packbits(bits).tobytes().hex()


def payload(text: str | None) -> tuple[int, bytes]:
    raw = (text or "").encode()
    return len(raw), raw + b" " * (max(ROW, -(-len(raw) // ROW) * ROW) - len(raw))


SCHEMA = (
    "n_bytes long, payload_bytes long, payload_sha256 string, tail_crc32 long, media_bytes long, media_sha256 string,"
    " feature string, width int, height long"
)


def media_table(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", with_media: bool = False) -> DataFrame:
    """Stores each text as JPEG, reads it back and describes it; ``with_media`` adds the stored bytes."""
    bounded_batches(docs.sparkSession)
    id_type = docs.schema[id_col].dataType.simpleString()
    schema = f"`{id_col}` {id_type}, {SCHEMA}" + ", media binary" * with_media
    names = [id_col, *(c.split()[0] for c in SCHEMA.split(", ")), *["media"] * with_media]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes = [len(s.as_py() or "") for s in batch.column(1)]
            for a, b in chunks(sizes, BATCH_BYTES):
                part = batch.slice(a, b - a)
                rows = _described(part.column(1).to_pylist(), with_media)
                columns = [pa.array(c) for c in zip(*rows, strict=True)]
                out = pa.RecordBatch.from_arrays([part.column(0), *columns], names=names)
                types = [part.column(0).type, *_ARROW, *[pa.binary()] * with_media]
                yield pa.RecordBatch.from_arrays([c.cast(t) for c, t in zip(out.columns, types, strict=True)], names=names)

    return docs.select(docs[id_col], docs[text_col]).mapInArrow(lean(run), schema)


_ARROW = [pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.string(), pa.string(), pa.int32(), pa.int64()]


def _described(texts: list[str | None], with_media: bool = False) -> list[tuple]:
    loads = [payload(t) for t in texts]
    step = ROW * MAX_ROWS
    parts = [(k, p[i : i + step]) for k, (_, p) in enumerate(loads) for i in range(0, len(p), step)]
    media: list[list[bytes]] = [[] for _ in texts]
    for a, b in chunks([len(p) for _, p in parts], BATCH_BYTES):
        for (k, _), jpeg in zip(parts[a:b], encode_samples([p for _, p in parts[a:b]]), strict=True):
            media[k].append(jpeg)
    stored = [b"".join(m) for m in media]
    images = [(k, m, f) for k, m in enumerate(stored) for f in frames(m)]
    samples: list[list[np.ndarray]] = [[] for _ in texts]
    heights = [0] * len(texts)
    for a, b in chunks([f.scan[1] - f.scan[0] for _, _, f in images], BATCH_BYTES):
        for (k, _, f), thumb in zip(images[a:b], dc_thumbnails([(m, f) for _, m, f in images[a:b]]), strict=True):
            samples[k].append(thumb.ravel())
            heights[k] += f.height
    out = []
    for (n, _), m, s, high in zip(loads, stored, samples, heights, strict=True):
        flat = s[0] if len(s) == 1 else np.concatenate(s)
        back = flat.tobytes()
        row = (n, len(back), hashlib.sha256(back).hexdigest(), zlib.crc32(back[-16:]), len(m), hashlib.sha256(m).hexdigest())
        out.append((*row, f"{ROW * 8}x{high}:{thumbnail_hash(flat)}", ROW * 8, high, *[m] * with_media))
    return out
