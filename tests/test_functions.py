"""Chat, text, prompt, score and response expressions on literal values."""

import json
import math

import pytest
from pyspark.sql import functions as F

from siltbed.functions import chat, prompts, responses, scores, text


def one(spark, value, *columns, kind="string"):
    df = spark.createDataFrame([(value,)], f"x {kind}")
    return df.select(*[c(F.col("x")).alias(f"c{i}") for i, c in enumerate(columns)]).first()


def conv(*turns, key="conversations"):
    return json.dumps({key: [{"role": r, "content": c} for r, c in turns]}, ensure_ascii=False)


PAIR = conv(("user", "q1"), ("assistant", "a1"), ("user", "q2"), ("assistant", "a2"), ("user", "q3"))


@pytest.mark.parametrize(
    ("record", "field", "profile", "want"),
    [
        (PAIR, "prompt", "generate", "q3"),
        (PAIR, "response", "generate", "a2"),
        (conv(("human", "h"), ("bot", "b"), key="dialogue"), "prompt", "judge", "h"),
        (conv(("human", "h"), ("gpt", "b")), "response", "judge", "b"),
        (conv(("human", "h"), ("gpt", "b")), "response", "generate", None),
        (conv((" user ", "padded")), "prompt", "judge", "padded"),
        (conv((" user ", "padded")), "prompt", "generate", None),
        ('{"messages": [{"sender": "用户", "text": "t"}]}', "prompt", "generate", "t"),
        ('{"conversations": [], "messages": [{"role": "user", "content": "m"}]}', "prompt", "generate", "m"),
        ('{"role": "user", "content": "solo"}', "prompt", "judge", "solo"),
        ('{"role": "user", "content": "solo"}', "response", "judge", None),
        ('{"prompt": "p", "answer": "a"}', "prompt", "judge", "p"),
        ('{"prompt": "p", "answer": "a"}', "response", "judge", "a"),
        ('{"text": 5, "content": "c"}', "prompt", "generate", "c"),
        ("not json", "prompt", "judge", "not json"),
        ("not json", "response", "judge", None),
        ('[{"role": "user", "content": "listed"}]', "prompt", "judge", "listed"),
        ("[1, 2]", "prompt", "generate", None),
        (None, "prompt", "generate", None),
    ],
)
def test_record_text(spark, record, field, profile, want):
    assert one(spark, record, lambda x: chat.record_text(x, field, profile)).c0 == want


def test_messages(spark):
    record = '{"conversations": ["bare", {"from": "model", "message": "m"}, {"role": "user", "content": null}, null, {"role": "Narrator", "content": "n"}]}'
    got = one(spark, record, lambda x: chat.messages(x, "judge")).c0
    assert [tuple(m) for m in got] == [("", "bare"), ("assistant", "m"), ("narrator", "n")]
    assert one(spark, '{"messages": "[{\\"role\\": \\"user\\", \\"content\\": \\"inner\\"}]"}', lambda x: chat.messages(x, "judge")).c0[0].content == "inner"


@pytest.mark.parametrize(
    ("turns", "want"),
    [
        ([("user", "q"), ("assistant", "a"), ("user", "later")], "用户: q\n助手: a"),
        ([("user", "q")], "用户: q"),
        ([("assistant", "a")], "助手: a"),
        ([("system", "s")], None),
        ([("user", ""), ("assistant", "a")], "助手: a"),
    ],
)
def test_last_pair(spark, turns, want):
    assert one(spark, conv(*turns), lambda x: chat.pair_text(chat.last_pair(chat.messages(x, "judge")))).c0 == want


def test_row_text_prefers_records_then_columns(spark):
    df = spark.createDataFrame(
        [(conv(("user", "from orig")), "col", "out"), ('{"x": 1}', "col", "out"), (None, None, "out")], "orig string, question string, output string"
    )
    rows = df.select(*[chat.row_text(df, f).alias(f) for f in ("prompt", "response", "last_turn")]).collect()
    assert [r.prompt for r in rows] == ["from orig", "col", None]
    assert [r.response for r in rows] == ["out", "out", "out"]
    assert [r.last_turn for r in rows] == ["用户: from orig", "用户: col\n助手: out", "助手: out"]


@pytest.mark.parametrize(
    ("record", "last", "every"),
    [
        (PAIR, "q3", "【turn1】q1\n【turn2】q2\n【turn3】q3"),
        ('{"conversations": [{"role": "user", "content": "c"}], "messages": [{"role": "user", "content": "m"}]}', "m", "【turn1】m"),
        ('{"messages": [{"role": "User", "content": "case"}], "instruction": {"a": 1}}', '{"a":1}', '{"a":1}'),
        ('{"instruction": "", "input": "i"}', "i", "i"),
        ('{"query": "q"}', "q", "q"),
        ('{"other": 1}', None, None),
    ],
)
def test_embedding_text(spark, record, last, every):
    assert tuple(one(spark, record, chat.embedding_text, lambda x: chat.embedding_text(x, True))) == (last, every)


def test_model_messages(spark):
    record = conv(("system", "s"), ("user", "u" * 10), ("weird", "w"), ("assistant", "  "), ("客服", "a"))
    every = one(spark, record, lambda x: chat.model_messages(x, 0, 4), lambda x: chat.model_messages(x, 2)).asDict()
    assert [tuple(m) for m in every["c0"]] == [("system", "s"), ("user", "uuuu...(truncated)"), ("user", "w"), ("assistant", "a")]
    assert [tuple(m) for m in every["c1"]] == [("assistant", "a")]


def test_history_prompt_in_both_dialects(spark):
    other = json.dumps({"conversations": [{"from": "human", "value": "q"}, {"from": "gpt", "value": "a"}, {"from": "x", "value": "z"}]})
    assert one(spark, other, lambda x: chat.history_prompt(x, "B")).c0 == "B【user】：q【AI assistant】：a"
    assert one(spark, PAIR, chat.history_prompt).c0.startswith("【user】：q1【AI assistant】：a1")


@pytest.mark.parametrize(
    ("value", "want"),
    [(None, ""), ("  a 　\n", "a"), ("\x1c x \x1f", "x"), ("é" * 12, "é" * 10 + "...(truncated)"), ("é" * 10, "é" * 10), (" ", "")],
)
def test_sanitize(spark, value, want):
    assert one(spark, value, lambda x: text.sanitize(x, 10)).c0 == want


def test_small_text_helpers(spark):
    assert one(spark, "a</think>b</think>c", text.after_thinking).c0 == "c"
    assert one(spark, "plain", text.after_thinking).c0 == "plain"
    assert one(spark, None, lambda x: text.source_name(x, "fall")).c0 == "fall"
    assert one(spark, " s ", lambda x: text.source_name(x, "fall")).c0 == "s"
    assert [text.model_tag(n) for n in ("/m/a b-7B/", "..", "x/y:z")] == ["a_b-7B", "unknown_model", "y_z"]


def test_prompts(spark, tmp_path):
    df = spark.createDataFrame([("t", "Q {answer}", "A", None), ("t", "q", "a", "mine"), ("t", "q", "a", "none such")], "t string, q string, a string, prompt_key string")
    own = {"pair": "{question}|{answer}|{text}", "mine": "M {text}", "tail": "end"}
    got = [r.prompt for r in prompts.with_prompt(df, df["t"], df["q"], df["a"], "pair", own, extra=" more ").collect()]
    assert sorted(got) == sorted(["Q A|A|{text}", "M t\n\nmore", prompts.TEMPLATES["default"].replace("{text}", "t\n\nmore")])
    safe = df.limit(1).select(prompts.fill(F.lit("{question}|{answer}"), df["t"], df["q"], df["a"], safe=True)).first()[0]
    assert safe == "Q {answer}|A"
    path = tmp_path / "p.py"
    path.write_text('A = "one"\n_B = "hidden"\nC = {"x": 1}\nraise SystemExit\n')
    assert prompts.load_templates(str(path)) == {"A": "one"}


SCORES = [
    ("Rating: [[5]]", 5.0),
    ("<score> 7 </score>", 7.0),
    ('{"score": "8.5", "type": "x"}', 8.5),
    ('{"a": {"score": 5}}', 5.0),
    ("Rating: 8/10", 8.0),
    ("rating： 4 of 5", 4.0),
    ("score 7", 7.0),
    ("between 3 and 9", None),
    ("", None),
    (None, None),
    ("failed_after_5", None),
    ("-2.5", -2.5),
    ('{"overall_score": 6, "n": 3}', 6.0),
    ("5d", 5.0),
]
LITERAL = [("{'rating': 6}", 6.0), ('noise {"value": 3} noise 9', 3.0), ('{"score": NaN}', None), ('{"score": 1} and 2 {"score": 3}', 1.0)]


@pytest.mark.parametrize(("value", "want"), SCORES + LITERAL)
def test_score(value, want):
    assert scores.score_of(value) == want


def test_score_lanes_agree(spark):
    df = spark.createDataFrame([(s,) for s, _ in SCORES], "s string")
    rows = df.select(scores.score(df["s"]).alias("a"), scores.native_score(df["s"]).alias("b")).collect()
    clean = lambda v: None if v is None or math.isnan(v) else v
    assert [(clean(r.a), clean(r.b)) for r in rows] == [(w, w) for _, w in SCORES]
    assert scores.score_of("failed_after_5", failures_count=True) == 5.0


ASPECTS = [
    ('```json\n{"Clarity": {"Score": 8}, "Cognitive_Complexity": {"Score": 9}}\n```', (8.0, 9.0)),
    ('{"Clarity": {"Score": 8}}', None),
    ('{"Clarity": 8, "Cognitive_Complexity": {"Score": 9}}', None),
    ("nonsense", None),
    (None, None),
]


def test_aspects(spark):
    more = [("{'Clarity': {'Score': 1, 'x': true}, 'Cognitive_Complexity': {'Score': 2}}", (1.0, 2.0))]
    df = spark.createDataFrame([(s,) for s, _ in ASPECTS + more], "s string")
    rows = df.select(scores.aspects(df["s"]).alias("a"), scores.native_aspects(df["s"]).alias("b"), scores.bracket_score(df["s"]).alias("c")).collect()
    assert [tuple(r.a) if r.a else None for r in rows] == [w for _, w in ASPECTS + more]
    assert [tuple(r.b) if r.b else None for r in rows][: len(ASPECTS)] == [w for _, w in ASPECTS]
    assert one(spark, "x [[ +3.5 ]]", scores.bracket_score).c0 == 3.5


@pytest.mark.parametrize(("value", "want"), [('{"a": 1}', 1), ("so {'a': 2} there", 2), ('x {"a": {"b": 1}, "a2": 3} y', None), ("[1]", None), (None, None)])
def test_embedded_object(spark, value, want):
    got = one(spark, value, lambda x: F.try_variant_get(scores.embedded_object(x), "$.a", "int")).c0
    assert got == want


@pytest.mark.parametrize(
    ("stored", "want"),
    [
        ('["a","b","c"]', []),
        ('["a","failed_after_2","c"]', [1]),
        ('["a"]', [1, 2]),
        ('["a","","c","d"]', [1]),
        ("[]", []),
        ('["{\\"status\\":\\"failed\\"}","b","c"]', [0]),
        ('["{\\"status\\":\\" OK \\"}","b",null]', [2]),
        ("plain", [1, 2]),
        (" ", [0, 1, 2]),
        (None, [0, 1, 2]),
    ],
)
def test_retry_slots(spark, stored, want):
    assert one(spark, stored, lambda x: responses.retry_slots(responses.samples(x), 3)).c0 == want


def test_serialise(spark):
    assert one(spark, ["a", None], responses.serialise, kind="array<string>").c0 == '["a",null]'
    assert one(spark, None, responses.serialise, kind="array<string>").c0 == "[]"
