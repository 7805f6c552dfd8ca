"""Readers and writers."""

import json
import time

import numpy as np
import pytest
from pyspark.sql import functions as F

from siltbed.sources import readers, writers
from siltbed.sources.embedding_pairs import EmbeddingPairs


def lines(tmp_path, *rows):
    path = tmp_path / "x.jsonl"
    path.write_text("\n".join(rows), encoding="utf-8")
    return f"file://{path}"


def test_jsonl_strict_and_permissive(spark, tmp_path):
    path = lines(tmp_path, '{"conversations": [1]}', "", "{bad", '{"conversations": [1]}', '{"k": "é"}')
    assert readers.read_records(spark, path).count() == 3
    with pytest.raises(Exception, match="(?i)malformed|parse"):
        readers.read_records(spark, path, strict=True).collect()
    assert readers.read_jsonl(spark, path, strict=False).count() >= 3
    assert [r.key for r in readers.saved_keys(spark, path).collect()] == ["[1]"]
    assert readers.saved_keys(spark, f"file://{tmp_path}/none.jsonl").count() == 0


def test_whole_file_json(spark, tmp_path):
    array = tmp_path / "a.json"
    array.write_text(json.dumps([{"a": 1}, {"a": 2}], indent=1))
    assert readers.read_json_or_jsonl(spark, f"file://{array}").count() == 2
    assert readers.read_json_or_jsonl(spark, lines(tmp_path, '{"a": 1}', '{"a": 2}', '{"a": 3}')).count() == 3


def test_dispatch_by_suffix(spark, tmp_path):
    table = f"file://{tmp_path}/t.parquet"
    spark.createDataFrame([(1, "x")], "a long, b string").write.parquet(table)
    assert json.loads(readers.read_any(spark, table).first().orig) == {"a": 1, "b": "x"}
    assert readers.read_any(spark, lines(tmp_path, '{"a": 5}')).first().orig == '{"a":5}'


def test_embedding_shards_have_positions(spark, tmp_path):
    base = f"file://{tmp_path}/emb"
    df = spark.createDataFrame([("u1", 0, [1.0, 2.0], "{}", "s"), ("u2", 1, None, "{}", "s")], writers.EMBEDDING_SCHEMA).coalesce(1)
    writers.write_embeddings(df, base)
    got = readers.read_embeddings(spark, base).collect()
    assert [(r.uid, r.row_index, r.embedding) for r in got] == [("u1", 0, [1.0, 2.0])] and got[0].file_name.endswith(".parquet")
    with pytest.raises(Exception, match="(?i)exist"):
        writers.write_embeddings(df, base)


def test_embedding_pairs(spark, tmp_path):
    for name, n, vectors in (("a", 3, np.ones((2, 4))), ("b", 1, np.arange(4.0))):
        (tmp_path / f"{name}.json").write_text(json.dumps({"idx": list(range(n)), "texts": ["t"] * n, "inputs": [{"q": 1}] * n}))
        np.save(tmp_path / f"{name}.npy", vectors)
    (tmp_path / "lonely.json").write_text("{}")
    spark.dataSource.register(EmbeddingPairs)
    got = spark.read.format("embedding_pairs").load(str(tmp_path)).orderBy("file_name", "row_index").collect()
    assert [(r.file_name, r.row_index) for r in got] == [("a.json", 0), ("a.json", 1), ("b.json", 0)]
    assert got[2].embedding == [0.0, 1.0, 2.0, 3.0] and got[0].orig == '{"q": 1}'


def test_kept_and_removed(spark, tmp_path):
    tagged = spark.createDataFrame([(1, True, None), (2, False, 1)], "vec_id long, kept boolean, best_id long")
    kept, removed = (f"file://{tmp_path}/{x}" for x in ("kept", "removed"))
    writers.write_kept_removed(tagged, kept, removed)
    assert spark.read.parquet(kept).columns == ["vec_id"] and spark.read.parquet(removed).first().best_id == 1
    writers.write_kept_removed(tagged.limit(0), kept + "0", removed + "0")
    assert spark.read.parquet(kept + "0").columns == ["vec_id"]


def test_other_sinks(spark, tmp_path):
    df = spark.createDataFrame([(1, "é")], "a long, b string")
    for _ in range(2):
        writers.write_jsonl(df, f"file://{tmp_path}/l")
    assert spark.read.json(f"file://{tmp_path}/l").count() == 2
    writers.write_csv(df, f"file://{tmp_path}/c")
    assert spark.read.option("header", True).csv(f"file://{tmp_path}/c").first().b == "é"
    writers.write_json_array(df, str(tmp_path / "a.json"))
    assert json.loads((tmp_path / "a.json").read_text()) == [{"a": 1, "b": "é"}]
    with pytest.raises(ValueError):
        writers.write_json_array(spark.range(3).select(F.col("id")), str(tmp_path / "b.json"), limit=2)
    writers.compact(df.union(df), f"file://{tmp_path}/p", files=1)
    assert spark.read.parquet(f"file://{tmp_path}/p").count() == 2


def test_stored_tables_leave_no_shuffle_files(spark):
    from siltbed.sources.scratch import cut

    def files():
        found = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles()
        return {found.apply(k).getName() for k in range(found.size()) if found.apply(k).getName().startswith("shuffle_")}

    before, key = files(), "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    rows = spark.range(1000).groupBy((F.col("id") % 7).alias("k")).agg(F.collect_list("id").alias("ids"))
    setting = spark.conf.get(key)
    out = cut(rows, "left")
    ends = time.monotonic() + 10  # files go a little later
    while files() - before and time.monotonic() < ends:
        time.sleep(0.1)
    assert not files() - before and spark.conf.get(key) == setting
    assert out.count() == 7 and cut(rows, "again").count() == 7
