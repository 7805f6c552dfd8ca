"""Filters, similarity, deduplication, clusters, model calls, resume and the pipeline."""

import json
import math
import sys
import uuid

import numpy as np
import pytest
from pyspark import cloudpickle
from pyspark.sql import functions as F

from siltbed.operators import cluster, dedup, filters, model_calls, similarity
from siltbed.plans import multi_turn, pipeline
from siltbed.streaming import resume

cloudpickle.register_pickle_by_value(sys.modules[__name__])  # workers do not import tests
VECTORS = "vec_id long, embedding array<float>"


def plane(spark, degrees):
    return spark.createDataFrame([(i, [math.cos(math.radians(d)), math.sin(math.radians(d))]) for i, d in enumerate(degrees)], VECTORS)


def test_in_range_refuses_nan(spark):
    df = spark.createDataFrame([(1.0,), (7.0,), (float("nan"),), (None,), (10.0,), (11.0,)], "x double")
    assert sorted(r.x for r in df.where(filters.in_range(df["x"], 7, 10)).collect()) == [7.0, 10.0]


def test_score_filter_names_columns(spark):
    df = spark.createDataFrame([("[[8]]",), ("[[3]]",), ("?",)], "out string")
    assert [r.judge_score for r in filters.filter_by_score(df, "out").collect()] == [8.0]
    assert tuple(filters.score_stats(df, "out").first()) == (3, 2, 1)
    with pytest.raises(ValueError, match="out"):
        filters.filter_by_score(df, "missing")


def test_per_file_sample(spark):
    df = spark.range(300).select("id", F.concat(F.lit("f"), (F.col("id") % 3).cast("string")).alias("file"))
    got = filters.per_file_sample(df, "file", 30, F.col("id"))
    assert {r.file: r["count"] for r in got.groupBy("file").count().collect()} == {"f0": 10, "f1": 10, "f2": 10}


@pytest.mark.parametrize(("degrees", "kept"), [((0, 90, 180), [0, 1, 2]), ((0, 0, 0), [0]), ((0, 20, 30), [0]), ((0, 20, 200), [0, 2])])
def test_greedy_dedup_in_the_plane(spark, degrees, kept):
    got = dedup.greedy_dedup(plane(spark, degrees), 0.9)
    assert sorted(r.vec_id for r in got.where("kept").collect()) == kept


def sequential(vectors, threshold):
    """The rule itself, row by row."""
    unit = vectors / np.where((n := np.linalg.norm(vectors, axis=1, keepdims=True)) == 0, 1, n)
    sims = np.round(unit @ unit.T, 12)
    kept = [True] * len(unit)
    for i in range(len(unit)):
        if not kept[i]:
            continue
        others = [j for j in range(len(unit)) if j != i]
        best = max(others, key=lambda j: (sims[i, j], -j)) if others else None
        if best is not None and sims[i, best] >= threshold:
            kept[i if best < i else best] = False
    return [i for i, k in enumerate(kept) if k]


@pytest.mark.parametrize("seed", range(4))
def test_greedy_dedup_equals_the_sequential_rule(spark, seed):
    r = np.random.default_rng(seed)
    v = r.integers(-2, 3, (60, 3)).astype(np.float64)
    df = spark.createDataFrame([(i, x.tolist()) for i, x in enumerate(v)], VECTORS)
    for threshold in (0.7, 0.95):
        got = dedup.greedy_dedup(df, threshold).where("kept").collect()
        assert sorted(x.vec_id for x in got) == sequential(v, threshold)


def test_nearest_in_tiles_equals_broadcast(spark):
    r = np.random.default_rng(1)
    v = r.normal(size=(70, 8))
    df = spark.createDataFrame([(i, x.tolist()) for i, x in enumerate(v)], VECTORS)
    a = similarity.nearest(df, df, 3, exclude_self=True)
    b = similarity.nearest(df, df, 3, exclude_self=True, broadcast_bytes=0, block=16)
    key = lambda f: sorted((x.query_id, x.rank, x.match_id, round(x.sim, 9)) for x in f.collect())
    assert key(a) == key(b)
    unit = v.astype(np.float32).astype(float)
    unit /= np.linalg.norm(unit, axis=1, keepdims=True)
    sims = unit @ unit.T - 2 * np.eye(70)
    assert {x.query_id: x.match_id for x in a.where("rank = 1").collect()} == dict(enumerate(sims.argmax(1).tolist()))


def test_decontaminate(spark):
    train, test = plane(spark, (0, 50, 100)), plane(spark, (5, 200)).withColumn("prompt", F.lit("p"))
    got = {r.vec_id: r for r in dedup.decontaminate(train, test, 0.9, carry=("prompt",)).collect()}
    assert [got[i].kept for i in range(3)] == [False, True, True] and got[0].matched_test_prompt == "p" and got[0].matched_test_index == 0
    assert dedup.decontaminate(train, test.limit(0), 0.9).where("kept").count() == 3
    assert dedup.decontaminate(train.limit(0), test, 0.9).count() == 0


def test_vectors_of_any_spelling(spark):
    df = spark.createDataFrame([("[1, 2]", None), (None, [3.0, 4.0]), ("bad", None), ("(5, 6,)", None)], "emb string, vector array<double>")
    assert sorted(r.embedding for r in similarity.parsed_vectors(df).collect()) == [[1.0, 2.0], [3.0, 4.0], [5.0, 6.0]]


def test_first_of_each_and_not_done(spark):
    df = spark.createDataFrame([(3, "a"), (1, "a"), (2, "b"), (4, None), (5, None)], "pos long, k string")
    assert sorted(r.pos for r in dedup.first_of_each(df, F.col("k"), "pos").collect()) == [1, 2, 4, 5]
    done = spark.createDataFrame([("a",)], "k string")
    assert sorted(r.pos for r in dedup.not_done(df, F.col("k"), done, F.col("k")).collect()) == [2, 4, 5]


def test_best_k_takes_the_first_best(spark):
    df = spark.range(20)
    assert cluster.best_k(df, 2, 6, lambda s, k: {3: 0.5, 5: 0.5}.get(k, 0.1)) == 3
    assert cluster.best_k(df.limit(1), 2, 6, lambda s, k: 1.0) == 1
    assert cluster.best_k(df, 30, 40, lambda s, k: 1.0) == 4


def test_clusters(spark):
    r = np.random.default_rng(0)
    rows = [(i, (r.normal(size=6) + 20 * (i % 3)).tolist()) for i in range(60)] + [(99, [1.0])]
    df = spark.createDataFrame(rows, VECTORS)
    feats = cluster.features(df, pca_dim=2)
    assert feats.count() == 60
    assert cluster.best_k(feats, 2, 5) == 3
    got = cluster.label(feats, cluster.fit(feats, 3))
    assert got.columns[-1] == "kmeans_label" and got.schema["kmeans_label"].dataType.simpleString() == "bigint"
    assert len({(r.vec_id % 3, r.kmeans_label) for r in got.collect()}) == 3
    assert cluster.summary(got, 3) == {"best_k": 3, "n_samples": 60, "dim": 6}


def test_endpoints():
    pool = model_calls.EndpointPool.parse("http://a:1+http://b:2", "http://a:1:2/3+http://b:2:1/3")
    assert pool.urls == ("http://a:1", "http://b:2") and pool.weights == pytest.approx((2 / 3, 1 / 3))
    assert model_calls.EndpointPool.parse("u+v").weights == (0.5, 0.5)
    assert model_calls.EndpointPool.parse("u+v", "v:3").urls == ("v",)
    picks = [pool.choose(str(k), 0) for k in range(600)]
    assert 330 < picks.count("http://a:1") < 470 and picks[7] == pool.choose("7", 0)
    for bad in (("",), ("u", "v:1"), ("u", "u:0"), ("u", "u:1/0"), ("u", "u:-1"), ("u", "u"), ("u", "+")):
        with pytest.raises(ValueError):
            model_calls.EndpointPool.parse(*bad)


def test_extra_body():
    assert model_calls.extra_body({"repetition_penalty": 1.2, "x": 1}, True) == {"repetition_penalty": 1.2, "x": 1, "chat_template_kwargs": {"enable_thinking": True}}


def fails(key, attempt):
    return attempt < 1 or key.startswith("3/") or key == "3"


def test_calls_retry_and_report(spark):
    df = spark.createDataFrame([(1, "abc"), (2, " "), (3, "x"), (4, None)], "k long, p string")
    client = model_calls.FakeClient(fails=fails)
    got = {r.k: r for r in model_calls.judge(df, F.col("k"), client, "p", retries=2, pause=0).collect()}
    assert [got[k].sglang_result for k in (1, 2, 3, 4)] == ["[[3]]", None, "failed_after_2", None]
    made = model_calls.generate(df, F.col("k"), model_calls.user_message(F.col("p")), client, 3, retries=1, pause=0)
    assert {r.k: r.samples for r in made.collect()} == {1: ["[[3]]"] * 3, 2: [], 3: ["failed_after_1"] * 3, 4: []}


def test_embedding_falls_back_to_single_rows(spark):
    class Picky(model_calls.HashEmbedder):
        def embed(self, texts):
            if "bad" in texts:
                raise ValueError("bad")
            return super().embed(texts)

    df = spark.createDataFrame([(1, "good"), (2, "bad"), (3, None)], "k long, t string").coalesce(1)
    got = {r.k: r.embedding for r in model_calls.embed(df, "t", Picky(dim=4)).collect()}
    assert any(got[1]) and not any(got[2]) and len(got[2]) == 4


def answers(spark, df):
    return model_calls.generate(df, F.col("key"), model_calls.user_message(F.col("p")), model_calls.FakeClient(), 2, pause=0)


def test_resume_after_a_stop(spark, tmp_path):
    df = spark.range(25).select(F.col("id").cast("string").alias("key"), F.repeat(F.lit("x"), F.col("id").cast("int") + 1).alias("p"))
    path, calls = f"file://{tmp_path}/parts", []

    def work(part):
        calls.append(part.count())
        if len(calls) == 3:
            raise RuntimeError("stopped")
        return answers(spark, part)

    with pytest.raises(RuntimeError):
        resume.run_in_parts(df, "key", work, path, part_rows=5)
    done = spark.read.parquet(path).count()
    assert 0 < done < 25
    got = resume.run_in_parts(df, "key", work, path, part_rows=5)
    assert got.count() == 25 and got.select("key").distinct().count() == 25
    before = len(calls)
    resume.run_in_parts(df, "key", work, path, part_rows=5)
    assert len(calls) == before
    assert resume.fingerprint(df, "key") == resume.fingerprint(df.orderBy(F.desc("key")), "key")


def test_repair_fills_failed_slots_only(spark):
    stored = [("1", '["a","failed_after_2"]', "xx"), ("2", '["a","b"]', "yy"), ("3", None, "zzz"), ("4", "[]", "w")]
    df = spark.createDataFrame(stored, "key string, llm_response string, p string")

    def again(rows, slots):
        return model_calls.generate(rows, F.col("key"), model_calls.user_message(F.col("p")), model_calls.FakeClient(), 2, slots=slots, pause=0)

    got = {r.key: r.llm_response for r in resume.repair(df, "key", "llm_response", 2, again).collect()}
    assert got == {"1": '["a","[[2]]"]', "2": '["a","b"]', "3": '["[[3]]","[[3]]"]', "4": "[]"}


def test_stream_of_parts(spark, tmp_path):
    source, path, mark = (f"file://{tmp_path}/{x}" for x in ("in", "out", "mark"))
    for k in range(2):
        rows = spark.createDataFrame([(f"{k}-{i}", "x" * (i + 1)) for i in range(4)] + [("0-0", "x")], "key string, p string")
        rows.write.mode("append").parquet(source)
        resume.stream_parts(spark, source, "key string, p string", lambda df: answers(spark, df), path, mark)
        out = spark.read.parquet(path)
        assert out.count() == out.select("key").distinct().count() == 4 * (k + 1)


def test_multi_turn_runner(spark, tmp_path):
    lines = [{"conversations": [{"from": "human", "value": t}]} for t in ("one", "two", "one", "bad", "four")] + [{"other": 1}]
    data, saved = f"file://{tmp_path}/in.jsonl", f"file://{tmp_path}/out"
    (tmp_path / "in.jsonl").write_text("\n".join(map(json.dumps, lines)) + "\n{broken\n")
    client = model_calls.FakeClient(answer=lambda p: "\n" + p.upper() + "\n", fails=lambda key, attempt: False)
    assert multi_turn.open_records(spark, data, saved, 2).count() == 2
    assert multi_turn.run(spark, data, saved, client, "B:", max_samples=3) == 3
    assert multi_turn.run(spark, data, saved, client, "B:", max_samples=0) == 1
    assert multi_turn.run(spark, data, saved, client, "B:", max_samples=0) == 0
    rows = spark.read.json(saved).collect()
    assert sorted(r.outputs for r in rows) == ["B:【USER】：BAD", "B:【USER】：FOUR", "B:【USER】：ONE", "B:【USER】：TWO"]
    down = model_calls.FakeClient(fails=lambda key, attempt: True)
    assert multi_turn.run(spark, data, f"file://{tmp_path}/none", down) == 0


def test_pipeline(spark, tmp_path):
    convs = [{"conversations": [{"role": "user", "content": c}, {"role": "assistant", "content": "fine"}]} for c in ("alpha beta gamma", "alpha beta gamma", "other words here", "zzz")]
    records = spark.createDataFrame([(i, json.dumps(c)) for i, c in enumerate(convs)] + [(9, '{"x": 1}')], "idx long, orig string")
    client = model_calls.FakeClient(answer=lambda p: "[[9]]" if "zzz" not in p else "[[2]]")
    settings = dict(run_name="r", work_dir=f"file://{tmp_path}", judge_client=client, generate_client=model_calls.FakeClient(), samples=2, pause=0)
    out, manifest = pipeline.run(records, pipeline.Settings(**settings))
    assert {k: v["rows"] for k, v in manifest["stages"].items()} == {"embedding": 4, "dedup": 3, "judge": 3, "filter": 2, "inference": 2}
    assert {json.loads(r.orig)["conversations"][0]["content"]: r.llm_response for r in out.collect()} == {"alpha beta gamma": '["[[5]]","[[5]]"]', "other words here": '["[[5]]","[[5]]"]'}
    _, again = pipeline.run(records, pipeline.Settings(**settings))
    assert {v["state"] for v in again["stages"].values()} == {"reused"}
    _, forced = pipeline.run(records, pipeline.Settings(**settings, force=True, skip=("dedup",)))
    assert forced["stages"]["dedup"]["state"] == "skipped" and forced["stages"]["judge"]["rows"] == 4
    _, dry = pipeline.run(records, pipeline.Settings(**settings, dry_run=True))
    assert {v["state"] for v in dry["stages"].values()} == {"planned"}


class Counting:
    """Leaves a file for each call."""

    def __init__(self, folder):
        self.folder = folder

    def complete(self, messages, key, attempt):
        (self.folder / uuid.uuid4().hex).touch()
        return model_calls.Reply("[[8]]", 1, 1)


def test_each_call_is_made_once(spark, tmp_path):
    (tmp_path / "calls").mkdir()
    lines = [json.dumps({"conversations": [{"from": "human", "value": f"text {i}"}]}) for i in range(10)]
    (tmp_path / "in.jsonl").write_text("\n".join(lines))
    assert multi_turn.run(spark, f"file://{tmp_path}/in.jsonl", f"file://{tmp_path}/out", Counting(tmp_path / "calls"), max_samples=0) == 10
    assert len(list((tmp_path / "calls").iterdir())) == 10


def test_rows_without_the_key_are_no_samples(spark, tmp_path):
    lines = ['{"other": 1}'] * 3 + [json.dumps({"conversations": [{"from": "human", "value": f"t{i}"}]}) for i in range(5)]
    (tmp_path / "in.jsonl").write_text("\n".join(lines))
    got = multi_turn.open_records(spark, f"file://{tmp_path}/in.jsonl", f"file://{tmp_path}/none", 2).collect()
    assert sorted(json.loads(r.key)[0]["value"] for r in got) == ["t0", "t1"]


def test_requests_of_one_key_are_one_call(spark, tmp_path):
    df = spark.createDataFrame([("k", "a"), ("k", "a"), ("j", "b")], "key string, p string")
    client = Counting(tmp_path)
    got = model_calls.generate(df, F.col("key"), model_calls.user_message(F.col("p")), client, 2, pause=0).collect()
    assert [r.samples for r in got] == [["[[8]]", "[[8]]"]] * 3 and len(list(tmp_path.iterdir())) == 4


def test_first_of_each_by_key_and_position(spark):
    df = spark.createDataFrame([(3, "B"), (5, "A"), (5, "B"), (5, "A"), (7, None), (7, None)], "pos long, k string")
    assert sorted((r.pos, r.k or "") for r in dedup.first_of_each(df, F.col("k"), "pos").collect()) == [(3, "B"), (5, "A"), (7, ""), (7, "")]


def test_vectors_that_cannot_be_compared(spark):
    uneven = spark.createDataFrame([(1, [1.0, 0.0]), (2, [1.0])], VECTORS)
    with pytest.raises(ValueError, match="1 to 2"):
        similarity.nearest(uneven, uneven, 1)
    holes = spark.createDataFrame([(1, [1.0, 0.0]), (2, [1.0, None]), (3, None), (4, []), (5, [1.0, 0.1]), (6, [1.0, float("nan")])], VECTORS)
    got = similarity.nearest(holes, holes, 2, exclude_self=True).collect()
    assert sorted((r.query_id, r.match_id) for r in got) == [(1, 5), (5, 1)]


@pytest.mark.parametrize("k", [1, 3])
def test_groups_of_blocks_equal_broadcast(spark, k):
    r = np.random.default_rng(k)
    rows = [(i, [float(x) for x in r.integers(-2, 3, 4)]) for i in range(150)]
    df = spark.createDataFrame(rows, VECTORS)
    key = lambda found: sorted((x.query_id, x.match_id, round(x.sim, 9), x["rank"]) for x in found.collect())
    for q, own in ((df, True), (df.where("vec_id % 3 = 0"), False)):
        want = key(similarity.nearest(q, df, k, exclude_self=own))
        assert key(similarity.nearest(q, df, k, exclude_self=own, broadcast_bytes=0, block=16, group_bytes=1200)) == want


def test_a_round_holds_one_chunk(spark, monkeypatch):
    """What a worker holds does not grow with the table, and copies, zero vectors and repeated ids are as in plain numpy."""
    seen, plain = [], spark.sparkContext.broadcast
    monkeypatch.setattr(spark.sparkContext, "broadcast", lambda x: seen.append(x[1].nbytes) or plain(x))
    r = np.random.default_rng(5)
    v = np.concatenate([np.ones((200, 4)), r.integers(-2, 3, (200, 4))])
    ids = [*range(395), *range(390, 395)]
    df = spark.createDataFrame([(i, x.tolist()) for i, x in zip(ids, v, strict=True)], VECTORS)
    norm = np.linalg.norm(v, axis=1, keepdims=True)
    sims = np.round((u := v / np.where(norm == 0, 1, norm)) @ u.T, 12)
    sims[np.equal.outer(ids, ids)] = -np.inf
    want = {i: (ids[(b := min(np.flatnonzero(s == s.max()), key=ids.__getitem__))], round(s[b], 9)) for i, s in zip(ids[:390], sims, strict=False)}
    got = similarity.nearest(df, df, 1, exclude_self=True, broadcast_bytes=0, group_bytes=3200).collect()
    assert {x.query_id: (x.match_id, round(x.sim, 9)) for x in got if x.query_id < 390} == want
    assert len(seen) == 4 and max(seen) <= 2 * 3200


def test_forests_of_any_size(spark):
    r = np.random.default_rng(5)
    df = spark.createDataFrame([(i, [float(x) for x in r.normal(size=3)]) for i in range(200)], VECTORS)
    small, large = (dedup.greedy_dedup(df, 0.8, small_edges=n).select("vec_id", "kept") for n in (10_000, 0))
    assert sorted(small.collect()) == sorted(large.collect())


def test_a_change_reruns_its_stage_and_those_after_it(spark, tmp_path):
    def records(last):
        said = ("alpha beta", "other words", last)
        return spark.createDataFrame([(i, json.dumps({"conversations": [{"role": "user", "content": c}, {"role": "assistant", "content": "ok"}]})) for i, c in enumerate(said)], "idx long, orig string")

    def states(rows, **changes):
        settings = dict(run_name="r", work_dir=f"file://{tmp_path}", judge_client=model_calls.FakeClient(lambda p: "[[8]]"), generate_client=model_calls.FakeClient(), pause=0)
        _, manifest = pipeline.run(rows, pipeline.Settings(**(settings | changes)))
        return [s["state"] for s in manifest["stages"].values()]

    assert states(records("third text")) == ["written"] * 5
    assert states(records("third text")) == ["reused"] * 5
    assert states(records("changed text")) == ["written"] * 5
    assert states(records("third text"), low=6.0) == ["reused"] * 3 + ["written"] * 2
    assert states(records("third text"), judge_client=model_calls.FakeClient(lambda p: "[[9]]")) == ["reused"] * 2 + ["written"] * 3
    assert states(records("third text"), samples=2) == ["reused"] * 4 + ["written"]
    found = [json.loads(p.read_text()) for p in (tmp_path / "r").glob("*/manifest-*.json")]
    assert len(found) == 5 and all(m["filter_stats"]["kept"] == 3 for m in found)


def test_parts_are_read_once(spark, tmp_path):
    df = spark.range(40).select(F.col("id").alias("key"), F.lit("x").alias("p"))
    seen = []

    def work(part):
        assert "range" not in part._jdf.queryExecution().analyzed().toString().lower()
        seen.append(part.count())
        return part

    assert resume.run_in_parts(df, "key", work, f"file://{tmp_path}/p", part_rows=8).count() == 40 and sum(seen) == 40 and len(seen) == 5


def test_cluster_run_writes_labels_and_summary(spark, tmp_path):
    r = np.random.default_rng(3)
    rows = [(i, f"f{i % 2}", [float(x) for x in r.normal(loc=10 * (i % 3), size=4)]) for i in range(90)] + [(99, "f0", None)]
    df = spark.createDataFrame(rows, "id long, file string, embedding array<float>")
    result = cluster.run(df, f"file://{tmp_path}/c", "file", F.col("id"), 2, 5, pca_dim=0)
    assert result["best_k"] == 3 and result["n_samples"] == 90
    out = spark.read.parquet(f"file://{tmp_path}/c/labels")
    assert out.columns[-1] == "kmeans_label" and out.groupBy((F.col("id") % 3).alias("g")).agg(F.countDistinct("kmeans_label").alias("n")).where("n > 1").count() == 0
    assert json.loads((tmp_path / "c" / "result.json").read_text())["best_k"] == 3


def test_judge_client_defaults():
    client = model_calls.judge_client(model_calls.EndpointPool.parse("http://x"), "m")
    assert client.temperature == 0.0 and client.max_tokens == 12000 and len(client.stop) == 5


def test_intermediate_tables_need_a_shared_folder(spark):
    from siltbed.sources import scratch

    class Context:
        master, applicationId = "spark://host:7077", "a"

    class Session:
        sparkContext = Context()
        conf = type("C", (), {"get": staticmethod(lambda key, default=None: default)})()

    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        scratch.shared_dir(Session())
    table = scratch.cut(spark.range(3))
    assert table.count() == 3
    scratch.discard(table, None)
