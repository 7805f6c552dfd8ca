"""Chat records: many JSON dialects to one array of (role, content), and what is read from it.

A record is a JSON string (or is built from columns by ``turns_to_record``).
Parsing uses VARIANT, which refuses what strict JSON refuses except for text
after the value and repeated keys (those give null).

Functions of a record take its column, or a ``Record``: ``with_record`` stores a
record's parse and lists in columns of a projection of their own, which several
expressions then share.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .text import first_filled, sanitize

# Keys that hold a conversation, in order of preference.
CONVERSATION_KEYS = ("conversations", "conversation", "messages", "dialogue")
# Keys of a message's role and content, in order of preference.
ROLE_KEYS = ("role", "sender", "from")
CONTENT_KEYS = ("content", "text", "message")
# Role names, and those that only the judge profile knows.
USER_NAMES = ("user", "human", "usr", "客户", "用户")
ASSISTANT_NAMES = ("assistant", "agent", "bot", "客服")
JUDGE_ASSISTANT_NAMES = ("助手", "assistant_response", "gpt", "model")
SYSTEM_NAMES = ("system", "sys")
# Single fields that hold a prompt or a response where there is no conversation.
PROMPT_FIELDS = {
    "generate": ("text", "message", "content", "prompt", "input"),
    "judge": ("text", "message", "content", "prompt", "input", "question"),
}
RESPONSE_FIELDS = {"generate": ("text", "message", "content", "prompt", "input"), "judge": ("response", "answer", "output", "solution", "label")}
# Columns read where a row holds no record.
PROMPT_COLUMNS = ("prompt", "input", "question", "text", "content")
RESPONSE_COLUMNS = ("response", "answer", "output", "solution", "label")
# Fields of instruction records, then of plain ones.
INSTRUCTION_FIELDS = ("instruction", "input", "prompt")
PLAIN_FIELDS = ("text", "query", "prompt_text")
# Labels in prompts.
TURN_LABEL, USER_LABEL, ASSISTANT_LABEL = ("【turn", "】"), "用户: ", "助手: "
HISTORY_USER, HISTORY_ASSISTANT = "【user】：", "【AI assistant】："

MESSAGES = "array<struct<role:string,content:string>>"


@dataclass(frozen=True)
class Record:
    """A parsed record in columns named after ``name``."""

    name: str
    profile: str

    @property
    def text(self) -> Column:
        return F.col(self.name)

    @property
    def variant(self) -> Column:
        return F.col(f"_{self.name}_v")

    @property
    def lists(self) -> list[Column]:
        return [F.col(f"_{self.name}_{k}") for k in CONVERSATION_KEYS]

    @property
    def messages(self) -> Column:
        return F.col(f"_{self.name}_said")

    @property
    def columns(self) -> list[str]:
        """The names of the columns added, for ``drop``."""
        return [f"_{self.name}_{k}" for k in ("v", *CONVERSATION_KEYS, "raw", "said")]


def with_record(df: DataFrame, name: str = "orig", profile: str = "generate") -> tuple[DataFrame, Record]:
    """``df`` with the parse of a column, its lists under conversation keys, and its messages; each is made once a row."""
    r = Record(name, profile)
    out = df.withColumn(f"_{name}_v", F.try_parse_json(F.col(name)))
    out = out.withColumns({f"_{name}_{k}": _list(r.variant, k) for k in CONVERSATION_KEYS})
    out = out.withColumn(f"_{name}_raw", raw_messages(r, profile))
    return out.withColumn(f"_{name}_said", _normalised(F.col(f"_{name}_raw"), profile)), r


def parsed(record: Column | Record) -> Column:
    return record.variant if isinstance(record, Record) else F.try_parse_json(record)


def _lists(record: Column | Record) -> list[Column]:
    return record.lists if isinstance(record, Record) else [_list(parsed(record), k) for k in CONVERSATION_KEYS]


def _get(v: Column, key: str, kind: str = "string") -> Column:
    return F.try_variant_get(v, f"$.{key}", kind)


def _list(v: Column, key: str) -> Column:
    """A list under a key, also if it is a string of JSON."""
    inner = F.try_parse_json(_get(v, key))
    return F.coalesce(_get(v, key, "array<variant>"), F.try_variant_get(inner, "$", "array<variant>"))


def _field(item: Column, keys: tuple[str, ...]) -> Column:
    *head, last = [_get(item, k) for k in keys]
    return F.coalesce(*[F.when(c != "", c) for c in head], last)


def canonical_role(role: Column, profile: str = "generate") -> Column:
    """user, assistant or system for known names.

    The judge profile strips, knows more names and passes others through; the
    generate profile does not strip.
    """
    name = F.lower(role)
    if profile == "judge":
        name = F.trim(name)
    assistant = ASSISTANT_NAMES + (JUDGE_ASSISTANT_NAMES if profile == "judge" else ())
    out = F.when(name.isin(*USER_NAMES), "user").when(name.isin(*assistant), "assistant")
    return out.when(name.isin(*SYSTEM_NAMES), "system").otherwise(name)


def raw_messages(record: Column | Record, profile: str = "generate") -> Column:
    """The list of messages as variants, or null.

    generate: the first conversation key with a list that is not empty, or a single message.
    judge: the record itself if it is a list, or the first key that holds a list, even an empty one.
    """
    v, lists = parsed(record), _lists(record)
    if profile == "judge":
        return F.coalesce(F.try_variant_get(v, "$", "array<variant>"), *lists)
    single = F.when(
        _get(v, "role", "variant").isNotNull() & F.coalesce(*[_get(v, k, "variant") for k in CONTENT_KEYS]).isNotNull(),
        F.array(v),
    )
    return F.coalesce(*[F.when(F.size(x) > 0, x) for x in lists], single)


def _normalised(items: Column, profile: str) -> Column:
    def item(x: Column) -> Column:
        bare = F.when(F.schema_of_variant(x) == "STRING", F.try_variant_get(x, "$", "string"))
        role = F.coalesce(canonical_role(_field(x, ROLE_KEYS), profile), F.lit(""))
        return F.struct(role.alias("role"), F.coalesce(_field(x, CONTENT_KEYS), bare).alias("content"))

    return F.filter(F.transform(items, item), lambda m: m["content"].isNotNull())


def messages(record: Column | Record, profile: str = "generate") -> Column:
    """Normalised messages of a record; items without content are dropped, bare strings have role ''."""
    if isinstance(record, Record) and record.profile == profile:
        return record.messages
    return _normalised(raw_messages(record, profile), profile)


def last_content(msgs: Column, role: str) -> Column:
    """Content of the last message of a role."""
    return F.try_element_at(F.filter(msgs, lambda m: m["role"] == role), F.lit(-1))["content"]


def record_text(record: Column | Record, field: str = "prompt", profile: str = "generate") -> Column:
    """The last user (prompt) or assistant (response) text of a record.

    Without a conversation: a single message or the first known field.  A string
    that is not JSON is the prompt itself.
    """
    v, msgs = parsed(record), messages(record, profile)
    role = "user" if field == "prompt" else "assistant"
    names = (PROMPT_FIELDS if field == "prompt" else RESPONSE_FIELDS)[profile]
    is_text = lambda k: F.schema_of_variant(_get(v, k, "variant")) == "STRING"
    plain = F.coalesce(*[F.when(is_text(k), _get(v, k)) for k in names])
    own_role = _get(v, "role", "variant").isNotNull() & _get(v, "content", "variant").isNotNull()
    if profile == "judge":
        mine = F.when(canonical_role(_get(v, "role"), profile) == role, _get(v, "content"))
        structured = F.when(F.size(msgs) > 0, last_content(msgs, role)).when(own_role, mine).otherwise(plain)
    else:
        found = F.coalesce(F.greatest(*[F.size(x) > 0 for x in _lists(record)]), F.lit(False))
        structured = F.when(found, last_content(msgs, role)).when(own_role, _get(v, "content")).otherwise(plain)
    own = record.text if isinstance(record, Record) else record
    whole = own if field == "prompt" or profile == "generate" else F.lit(None).cast("string")
    return F.when(v.isNull(), whole).otherwise(structured)


def last_pair(msgs: Column) -> Column:
    """struct(user, assistant): the last assistant message and the user message before it; without one the last user."""
    said = F.filter(msgs, lambda m: m["role"].isin("user", "assistant"))
    places = F.transform(said, lambda m, i: F.struct(i.alias("i"), m["role"].alias("role"), m["content"].alias("content")))
    answer = F.try_element_at(F.filter(places, lambda m: m["role"] == "assistant"), F.lit(-1))
    before = F.filter(places, lambda m: (m["role"] == "user") & (answer["i"].isNull() | (m["i"] < answer["i"])))
    asked = F.try_element_at(before, F.lit(-1))
    return F.when(F.size(said) > 0, F.struct(asked["content"].alias("user"), answer["content"].alias("assistant")))


def pair_text(pair: Column) -> Column:
    """The pair with its labels; null if both are empty."""
    user = F.when(pair["user"] != "", F.concat(F.lit(USER_LABEL), pair["user"]))
    answer = F.when(pair["assistant"] != "", F.concat(F.lit(ASSISTANT_LABEL), pair["assistant"]))
    joined = F.concat_ws("\n", user, answer)
    return F.when(joined != "", joined)


def with_row_records(df: DataFrame) -> tuple[DataFrame, list[Record]]:
    """``df`` with the parses of the columns that ``row_text`` reads."""
    records = []
    for c in ("messages", "orig"):
        if c in df.columns:
            df, r = with_record(df, c, "judge")
            records.append(r)
    return df, records


def row_text(df: DataFrame, field: str = "prompt", parsed_records: list[Record] | None = None) -> Column:
    """The text that a judge reads of a row: messages, then orig, then plain columns."""
    have = set(df.columns)
    records = parsed_records if parsed_records is not None else [df[c] for c in ("messages", "orig") if c in have]
    plain = lambda names: F.coalesce(*[df[c].cast("string") for c in names if c in have], F.lit(None).cast("string"))
    if field == "last_turn":
        pairs = [pair_text(last_pair(messages(r, "judge"))) for r in records]
        flat = pair_text(F.struct(plain(PROMPT_COLUMNS).alias("user"), plain(RESPONSE_COLUMNS).alias("assistant")))
        return F.coalesce(*pairs, flat)
    own = [record_text(r, field, "judge") for r in records]
    return F.coalesce(*[F.when(c != "", c) for c in own], plain(PROMPT_COLUMNS if field == "prompt" else RESPONSE_COLUMNS))


def user_turns(msgs: Column) -> Column:
    """All user turns with their numbers."""
    mine = F.filter(msgs, lambda m: (m["role"] == "user") & (m["content"] != ""))
    label = lambda m, i: F.concat(F.lit(TURN_LABEL[0]), (i + 1).cast("string"), F.lit(TURN_LABEL[1]), m["content"])
    return F.when(F.size(mine) > 0, F.array_join(F.transform(mine, label), "\n"))


def embedding_text(record: Column | Record, all_turns: bool = False) -> Column:
    """The text that is embedded: user turns of conversations, overridden by those of messages, then fields."""
    v = parsed(record)

    def turns(key: str) -> Column:
        items = _get(v, key, "array<variant>")
        named = F.transform(items, lambda x: F.struct(_get(x, "role").alias("role"), _get(x, "content").alias("content")))
        mine = F.filter(named, lambda m: (m["role"] == "user") & (m["content"] != ""))
        return user_turns(mine) if all_turns else F.try_element_at(mine, F.lit(-1))["content"]

    return F.coalesce(turns("messages"), turns("conversations"), first_filled(*[_get(v, k) for k in INSTRUCTION_FIELDS + PLAIN_FIELDS]))


def model_messages(record: Column | Record, max_turns: int = 0, max_chars: int = 4000) -> Column:
    """Messages for a chat model: the last ``max_turns`` items, roles mapped (others are users), cut, blanks dropped."""
    items = raw_messages(record)
    if max_turns > 0:
        items = F.when(F.size(items) > max_turns, F.slice(items, -max_turns, max_turns)).otherwise(items)

    def item(x: Column) -> Column:
        role = canonical_role(F.trim(_field(x, ROLE_KEYS)))
        role = F.when(role.isNull() | role.isin("user", "assistant", "system"), role).otherwise("user")
        return F.struct(role.alias("role"), F.when(_field(x, CONTENT_KEYS).isNotNull(), sanitize(_field(x, CONTENT_KEYS), max_chars)).alias("content"))

    return F.filter(F.transform(items, item), lambda m: m["role"].isNotNull() & (m["content"] != ""))


def history_prompt(record: Column | Record, base: str = "") -> Column:
    """One prompt with the whole history; the dialect (role/content or from/value) is the first message's."""
    items = F.coalesce(raw_messages(record), raw_messages(record, "judge"))
    first = F.try_element_at(items, F.lit(1))
    other = _get(first, "from", "variant").isNotNull() | _get(first, "value", "variant").isNotNull()

    def said(x: Column) -> Column:
        role = F.when(other, _get(x, "from")).otherwise(_get(x, "role"))
        content = F.when(other, _get(x, "value")).otherwise(_get(x, "content"))
        user, answer = F.when(other, "human").otherwise("user"), F.when(other, "gpt").otherwise("assistant")
        label = F.when(role == answer, HISTORY_ASSISTANT).when(role == user, HISTORY_USER)
        return F.coalesce(F.concat(label, content), F.lit(""))

    return F.concat(F.lit(base), F.array_join(F.transform(items, said), ""))


def last_item_content(record: Column | Record) -> Column:
    """Content of the last item under ``conversations``, whatever its role; null where there is none."""
    return _get(F.try_element_at(_get(parsed(record), "conversations", "array<variant>"), F.lit(-1)), "content")


def project(df: DataFrame, record: str, fields: tuple[str, ...]) -> DataFrame:
    """Fields of a JSON column as columns, replacing columns of the same names; bad JSON gives nulls."""
    v = parsed(df[record])
    return df.withColumns({f: _get(v, f) for f in fields})


def turns_to_record(turns: DataFrame, key: str = "conv_id", order: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """(key, orig): a table of turns as one JSON record for each conversation."""
    turn = F.struct(F.col(order).alias("o"), F.col(role).alias("role"), F.col(text).alias("content"))
    said = F.transform(F.array_sort(F.collect_list(turn)), lambda m: F.struct(m["role"].alias("role"), m["content"].alias("content")))
    return turns.groupBy(key).agg(said.alias("conversations")).select(key, F.to_json(F.struct("conversations")).alias("orig"))
