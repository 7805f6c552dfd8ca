"""Calls to language and embedding models as operators.

A client is built once in each Python worker and called from a thread pool, so
concurrency is partitions times threads.  Results carry a status beside the
text.  Calls are keyed by the row, so a task that runs again gives the same rows.
"""

from __future__ import annotations

import hashlib
import json
import random
import time
import urllib.error
import urllib.request
from collections import Counter
from collections.abc import Callable, Iterator
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field
from typing import Protocol

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.scores import FAILED_PREFIX

# Sampling settings of judge calls.
JUDGE_MAX_TOKENS = 12000
REPETITION_PENALTY = 1.05
JUDGE_STOPS = ("<|eot_id|>", "<|im_end|>", "</s>", "<|endoftext|>", "</answer>")


@dataclass(frozen=True)
class Reply:
    text: str | None
    prompt_tokens: int | None = None
    completion_tokens: int | None = None


class Client(Protocol):
    def complete(self, messages: list[dict[str, str]], key: str, attempt: int) -> Reply: ...


@dataclass(frozen=True)
class EndpointPool:
    """Endpoints with weights that sum to 1."""

    urls: tuple[str, ...]
    weights: tuple[float, ...]

    @classmethod
    def parse(cls, urls: str, weights: str | None = None) -> EndpointPool:
        """Endpoints joined by ``+``; weights as ``url:2/3+url:0.5``, which drop the urls they leave out."""
        own = [u for u in map(str.strip, urls.split("+")) if u]
        if not own:
            raise ValueError("no endpoint")
        given = dict.fromkeys(own, 1.0) if not weights else dict(map(_weight, [w for w in map(str.strip, weights.split("+")) if w]))
        if not given:
            raise ValueError("no weight")
        used = [(u, given[u]) for u in own if u in given]
        if not used:
            raise ValueError("no endpoint has a weight")
        total = sum(w for _, w in used)
        return cls(tuple(u for u, _ in used), tuple(w / total for _, w in used))

    def choose(self, key: str, attempt: int) -> str:
        """By weight, the same for the same key and attempt."""
        return random.Random(f"{key}/{attempt}").choices(self.urls, self.weights)[0]


def _weight(item: str) -> tuple[str, float]:
    url, colon, ratio = item.rpartition(":")
    top, slash, bottom = ratio.partition("/")
    if not colon or not url.strip() or not top.strip():
        raise ValueError(f"not url:weight: {item}")
    value = float(top)
    if slash:
        if float(bottom) == 0:
            raise ValueError("weight over 0")
        value /= float(bottom)
    if value <= 0:
        raise ValueError("weights are above 0")
    return url.strip(), value


def extra_body(extra: dict | None = None, thinking: bool = False) -> dict:
    """Request settings: a default repetition penalty, and thinking switched as asked."""
    out = {"repetition_penalty": REPETITION_PENALTY} | (extra or {})
    kwargs = out.get("chat_template_kwargs")
    return out | {"chat_template_kwargs": (kwargs if isinstance(kwargs, dict) else {}) | {"enable_thinking": thinking}}


def _post(url: str, body: dict, headers: dict[str, str], timeout: float) -> dict:
    data = json.dumps(body, ensure_ascii=False).encode()
    request = urllib.request.Request(url, data, {"Content-Type": "application/json"} | headers)
    with urllib.request.urlopen(request, timeout=timeout) as answer:
        return json.loads(answer.read())


@dataclass(frozen=True)
class ChatClient:
    """A chat-completions endpoint."""

    pool: EndpointPool
    model: str
    api_key: str = ""
    temperature: float = 0.0
    top_p: float | None = None
    max_tokens: int = JUDGE_MAX_TOKENS
    stop: tuple[str, ...] = ()
    timeout: float = 30.0
    extra: dict = field(default_factory=extra_body)
    strip_thinking: bool = True

    def complete(self, messages: list[dict[str, str]], key: str, attempt: int) -> Reply:
        body = {"model": self.model, "messages": messages, "temperature": self.temperature, "max_tokens": self.max_tokens} | self.extra
        body |= {"stop": list(self.stop)} if self.stop else {}
        body |= {"top_p": self.top_p} if self.top_p is not None else {}
        url = self.pool.choose(key, attempt).rstrip("/") + "/chat/completions"
        got = _post(url, body, {"Authorization": f"Bearer {self.api_key}"}, self.timeout)
        text, usage = got["choices"][0]["message"]["content"], got.get("usage") or {}
        if self.strip_thinking and text:
            text = text.rpartition("</think>")[2]
        return Reply(text, usage.get("prompt_tokens"), usage.get("completion_tokens"))


def judge_client(pool: EndpointPool, model: str, **settings) -> ChatClient:
    """A chat client with the settings of judge calls: temperature 0, the judge's stop tokens and length."""
    return ChatClient(pool, model, **({"temperature": 0.0, "max_tokens": JUDGE_MAX_TOKENS, "stop": JUDGE_STOPS} | settings))


@dataclass(frozen=True)
class TextClient:
    """An endpoint that takes {"text"} and answers under one of a few keys."""

    pool: EndpointPool
    headers: dict[str, str] = field(default_factory=dict)
    timeout: float = 30.0

    def complete(self, messages: list[dict[str, str]], key: str, attempt: int) -> Reply:
        got = _post(self.pool.choose(key, attempt), {"text": messages[-1]["content"]}, self.headers, self.timeout)
        named = [got[k] for k in ("text", "result", "output", "reply") if isinstance(got, dict) and got.get(k) is not None]
        return Reply(str(named[0]) if named else json.dumps(got, ensure_ascii=False))


@dataclass(frozen=True)
class FakeClient:
    """For tests: the answer is a function of the prompt, and some keys fail some attempts."""

    answer: Callable[[str], str] = lambda prompt: f"[[{len(prompt) % 11}]]"
    fails: Callable[[str, int], bool] = lambda key, attempt: False

    def complete(self, messages: list[dict[str, str]], key: str, attempt: int) -> Reply:
        if self.fails(key, attempt):
            raise OSError("planned failure")
        prompt = messages[-1]["content"]
        return Reply(self.answer(prompt), len(prompt), 1)


def attempt_call(client: Client, messages: list[dict[str, str]], key: str, retries: int, pause: float) -> tuple[str, str, int | None, int | None]:
    """(status, text, prompt tokens, completion tokens); failures are stored as text too."""
    error = ""
    for attempt in range(retries + 1):
        try:
            got = client.complete(messages, key, attempt)
            if got.text is not None:
                return "ok", got.text, got.prompt_tokens, got.completion_tokens
            error = "no text"
        except (OSError, ValueError, KeyError, IndexError, TypeError) as e:
            error = str(e)
        if pause and attempt < retries:
            time.sleep(pause)
    return f"failed: {error}"[:200], f"{FAILED_PREFIX}{retries}", None, None


REPLY = "status string, text string, prompt_tokens long, completion_tokens long"


def call_model(df: DataFrame, key: Column, messages: Column, client: Client, threads: int = 8, retries: int = 5, pause: float = 5.0, out: str = "reply") -> DataFrame:
    """Adds a struct (status, text, prompt_tokens, completion_tokens); rows with null or empty messages get null.

    ``messages`` is array<struct<role, content>>.  Calls of a batch run on ``threads`` threads and keep their order.
    The function counts as nondeterministic, so the optimiser evaluates it once for each row.
    """

    @F.pandas_udf(REPLY)
    def run(batches: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.DataFrame]:
        with ThreadPoolExecutor(threads) as pool:
            for keys, texts in batches:
                asked = [None if m is None or not len(m) else [dict(x) for x in m] for m in texts]
                jobs = [m and pool.submit(attempt_call, client, m, str(k), retries, pause) for k, m in zip(keys, asked, strict=True)]
                rows = [j.result() if j else (None,) * 4 for j in jobs]
                frame = pd.DataFrame(rows, columns=["status", "text", "prompt_tokens", "completion_tokens"])
                yield frame.astype({"prompt_tokens": "Int64", "completion_tokens": "Int64"})

    got = df.withColumn("_r", run.asNondeterministic()(key.cast("string"), messages))
    return got.withColumn(out, F.when(F.col("_r.status").isNotNull(), F.col("_r"))).drop("_r")


def user_message(prompt: Column) -> Column:
    """One user message, or null for a blank prompt."""
    return F.when(F.trim(prompt) != "", F.array(F.struct(F.lit("user").alias("role"), prompt.alias("content"))))


def judge(df: DataFrame, key: Column, client: Client, prompt: str = "prompt", text: Column | None = None, out: str = "sglang_result", **options) -> DataFrame:
    """Adds the judge's answer to each row's prompt; null where there was no text to judge."""
    asked = F.when(F.trim(text) != "", F.col(prompt)) if text is not None else F.col(prompt)
    got = call_model(df, key, user_message(asked), client, **options)
    return got.withColumn(out, F.col("reply.text")).drop("reply")


def generate(df: DataFrame, key: Column, messages: Column, client: Client, samples: int = 1, out: str = "samples", slots: Column | None = None, **options) -> DataFrame:
    """Adds ``samples`` answers as an array in slot order; rows without input get an empty array.

    ``slots`` limits the calls to some slots (others are null): a repair pass.
    Rows that share a key name the same request: it is made once, and all of them get its answers.
    """
    every = F.array(*[F.lit(i) for i in range(samples)])
    keyed = df.withColumns({"_key": key.cast("string"), "_messages": messages})
    once = keyed.select("_key", "_messages", (slots if slots is not None else every).alias("_slots")).where(F.size("_messages") > 0).dropDuplicates(["_key"])
    todo = once.select("_key", "_messages", F.explode(F.array_distinct("_slots")).alias("_slot"))
    called = call_model(todo, F.concat_ws("/", "_key", "_slot"), F.col("_messages"), client, **options)
    # At most ``samples`` rows for a key.
    per_row = called.groupBy("_key").agg(F.map_from_entries(F.collect_list(F.struct("_slot", F.col("reply.text")))).alias("_got"))
    joined = keyed.join(per_row, "_key", "left")
    filled = F.transform(every, lambda i: F.try_element_at("_got", i))
    return joined.withColumn(out, F.when(F.size("_messages") > 0, filled).otherwise(F.array().cast("array<string>"))).drop("_key", "_messages", "_got")


class Embedder(Protocol):
    def embed(self, texts: list[str]) -> np.ndarray: ...


@dataclass(frozen=True)
class HashEmbedder:
    """Offline vectors: signed hashed character trigrams.

    Of a trigram's MD5, the first eight hex digits pick the place and the ninth the sign.
    """

    dim: int = 64

    def embed(self, texts: list[str]) -> np.ndarray:
        out = np.zeros((len(texts), self.dim), np.float32)
        for i, t in enumerate(texts):
            for gram, n in Counter(t[k : k + 3] for k in range(max(1, len(t) - 2))).items():
                h = hashlib.md5(gram.encode()).hexdigest()
                out[i, int(h[:8], 16) % self.dim] += n if h[8] >= "8" else -n
        return out


def embed(df: DataFrame, text_col: str, embedder: Embedder, batch: int = 64, out: str = "embedding") -> DataFrame:
    """Adds vectors; a batch that fails is tried row by row, and a row that fails gets zeros."""

    @F.pandas_udf("array<float>")
    def run(parts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        width = 1
        for s in parts:
            rows: list[np.ndarray | None] = []
            for at in range(0, len(s), batch):
                texts = s.iloc[at : at + batch].fillna("").tolist()
                try:
                    rows += list(embedder.embed(texts))
                except Exception:  # noqa: BLE001 - any model error falls back to single rows
                    for t in texts:
                        try:
                            rows.append(embedder.embed([t])[0])
                        except Exception:  # noqa: BLE001
                            rows.append(None)
            width = next((len(r) for r in rows if r is not None), width)
            yield pd.Series([np.zeros(width, np.float32) if r is None else r for r in rows])

    return df.withColumn(out, run(df[text_col]))


