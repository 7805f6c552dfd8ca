"""A small table of documents with every awkward case, and plain Python versions of the operators' rules."""

from __future__ import annotations

import random
import re
import string

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
WORD = re.compile(r"[^\x20\x09-\x0D]+")
SPACES = re.compile(r"[\x20\x09-\x0D]+")
LOWER = str.maketrans(string.ascii_uppercase, string.ascii_lowercase)


def words(text: str | None) -> list[str]:
    return WORD.findall(text or "")


def texts(seed: int = 1) -> list[str | None]:
    r = random.Random(seed)
    vocabulary = ["".join(r.choice("abcdeéßñ") for _ in range(r.randint(1, 7))) for _ in range(400)]
    prose = lambda n: " ".join(r.choice(vocabulary) + r.choice(["", "", "", ".", ",\n"]) for _ in range(n))
    base = [prose(r.choice([1, 3, 8, 30, 80, 200])) for _ in range(40)]
    passage, line = prose(60), "This work is free: copy it, and keep this line."
    out: list[str | None] = base[:]
    out += [base[3], base[3], base[12], base[12].replace(" ", "\t \n", 1), " " + base[5], base[7].upper()]
    for k in range(8):  # near copies of one text, each with its own edits
        own = words(base[20] + " " + passage + " " + prose(100))
        own[k * 7] = f"edit{k}"
        out.append(" ".join(own[:160]))
    stem = words(prose(120))
    for k in range(12):
        own = stem[:]
        own[r.randrange(120)] = f"x{k}"
        out.append(" ".join(own))
    out += [prose(20) + " " + passage + " " + prose(20) for _ in range(5)]
    out += [prose(12) + "\n" + line + "\n" + prose(9) for _ in range(6)] + [line, line + " ", line.upper()]
    out += [None, None, "", "", " ", "\n\n", "\t", "a", "A", "a b c d e", "a b c d", "word " * 120, "日本語 " * 50, "😀" * 130, "\x00\x01 \x0b\x0c z", "no break space"]
    out += [prose(6000)]
    return out


def rows(seed: int = 1) -> list[tuple]:
    """Documents with ids out of order, null ids, sources and languages, and repeated rows."""
    r = random.Random(seed)
    t = texts(seed)
    out = []
    for k, text in enumerate(t):
        source = None if k % 11 == 0 else ["hot", "hot", "hot", "b", "é", "a"][k % 6]
        out.append((1000 - 7 * k if k % 2 else 7 * k, text, [None, "en", "de"][k % 3], source, None if k % 5 == 0 else len(text or "")))
    out += [out[4], out[4], (None, t[2], "en", "a", 1)]
    r.shuffle(out)
    return out


def documents(spark, seed: int = 1, parts: int = 3):
    return spark.createDataFrame(rows(seed), SCHEMA).repartition(parts)


def unique(spark, seed: int = 1, parts: int = 3):
    """The same without null ids and repeated rows."""
    own = list({x[0]: x for x in rows(seed) if x[0] is not None}.values())
    return spark.createDataFrame(own, SCHEMA).repartition(parts), own


def clashing(df):
    """``df`` with more columns that have the operators' inner names."""
    from pyspark.sql import functions as F

    names = ("id", "k1", "k2", "ranges", "size", "_id", "_h", "_t", "block", "grp", "score", "kept", "n", "node", "_text", "vslot", "target")
    return df.withColumns({n: F.lit("x") for n in names})


def empty(spark):
    return spark.createDataFrame([], SCHEMA)
