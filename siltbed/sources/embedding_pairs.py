"""Python data source ``embedding_pairs``: X.json (idx, texts, inputs) beside X.npy.

    spark.dataSource.register(EmbeddingPairs)
    spark.read.format("embedding_pairs").load(folder)

One partition per pair; rows are the shortest of ids, texts and vectors, and a
one-dimensional array is one row.
"""

from __future__ import annotations

import glob
import json
import os

import numpy as np
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition


class EmbeddingPairs(DataSource):
    @classmethod
    def name(cls) -> str:
        return "embedding_pairs"

    def schema(self) -> str:
        return "file_name string, row_index long, idx long, text string, orig string, embedding array<float>"

    def reader(self, schema) -> DataSourceReader:
        return _Reader(self.options["path"])


class _Reader(DataSourceReader):
    def __init__(self, path: str):
        self.path = path

    def partitions(self) -> list[InputPartition]:
        files = sorted(glob.glob(os.path.join(self.path, "*.json")))
        return [InputPartition(f) for f in files if os.path.exists(f[:-5] + ".npy")]

    def read(self, partition):
        with open(partition.value, encoding="utf-8") as f:
            head = json.load(f)
        vectors = np.atleast_2d(np.load(partition.value[:-5] + ".npy", mmap_mode="r"))
        texts = head.get("texts") or []
        inputs = head.get("inputs") or [None] * len(texts)
        for i in range(min(len(head.get("idx") or []), len(texts), len(vectors))):
            orig = inputs[i] if i < len(inputs) else None
            orig = orig if orig is None or isinstance(orig, str) else json.dumps(orig, ensure_ascii=False)
            yield (os.path.basename(partition.value), i, int(head["idx"][i]), str(texts[i]), orig, vectors[i].astype(float).tolist())
