"""Chat formatting (operator 5): records of many layouts to marked turns. DataFrame only.

A record is a JSON object. The nested field paths of a record, without their types, are
hashed to a fingerprint; a table of declarative mappings says for each known fingerprint
where roles and texts stand. The canonical turns are written with a template that marks
each turn, and are read back from it without loss: control strings inside roles and
texts are broken up by a backslash, and a backslash is doubled.

Defined cases: a null text or role is empty; a record that is no JSON object or whose
fingerprint is unknown has null turns and is kept (`layout` is null), never guessed;
turns with equal numbers are ordered by role, then text; a record with an empty list shows
no field of a turn, so its fingerprint is unknown too; very long texts are ordinary ones.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

TURN, BODY, END = "<|turn|>", "<|body|>", "<|end|>\n"
# No text may hold one of these as it is: the template's own marks and those that
# other templates use. Fixed values.
CONTROL = (
    "<|turn|>", "<|body|>", "<|end|>", "<|im_start|>", "<|im_end|>", "<|endoftext|>",
    "<s>", "</s>", "[INST]", "[/INST]", "<<SYS>>", "<</SYS>>",
)
TRAINED = "assistant"
TURNS = "array<struct<role:string,text:string>>"


@dataclass(frozen=True)
class Mapping:
    """One layout: an example of its fields, and the path of its turns or of its parts.

    `schema` is the type read; `turns` names a list with its role and text fields;
    `parts` are (role, field) in order, where an empty optional part is no turn.
    """

    name: str
    example: str
    schema: str
    turns: tuple[str, str, str] | None = None
    parts: tuple[tuple[str, str], ...] = ()
    roles: tuple[tuple[str, str], ...] = ()
    optional: tuple[str, ...] = ()


MAPPINGS = (
    Mapping(
        "messages",
        '{"messages":[{"role":"","content":""}]}',
        "messages array<struct<role:string,content:string>>",
        turns=("messages", "role", "content"),
    ),
    Mapping(
        "shared",
        '{"conversations":[{"from":"","value":""}]}',
        "conversations array<struct<`from`:string,value:string>>",
        turns=("conversations", "from", "value"),
        roles=(("human", "user"), ("gpt", "assistant")),
    ),
    Mapping(
        "prompt",
        '{"prompt":"","completion":""}',
        "prompt string, completion string",
        parts=(("user", "prompt"), ("assistant", "completion")),
    ),
    Mapping(
        "instruction",
        '{"instruction":"","input":"","output":""}',
        "instruction string, input string, output string",
        parts=(("system", "instruction"), ("user", "input"), ("assistant", "output")),
        optional=("input",),
    ),
)


def field_paths(record: Column) -> Column:
    """Nested field paths of a JSON text, sorted, without the types of their values.

    A list stands for its elements. Null where the text is no JSON.
    """
    shape = F.schema_of_variant(F.try_parse_json(record))
    # `OBJECT<a: ARRAY<OBJECT<b: STRING>>>` becomes `OBJECT<a: ARRAY<OBJECT<b: *>>>`.
    typed = r": (?!OBJECT|ARRAY)[A-Z_]+(\([0-9, ]*\))?"
    return F.regexp_replace(shape, typed, ": *")


def fingerprint(record: Column) -> Column:
    return F.xxhash64(field_paths(record))


def known(spark) -> dict[str, int]:
    """Fingerprint of each mapping, from its example by the same expression."""
    rows = spark.createDataFrame([(m.name, m.example) for m in MAPPINGS], "name string, record string")
    found = rows.select("name", fingerprint(F.col("record")).alias("f")).collect()
    return {r["name"]: r["f"] for r in found}


def _renamed(role: Column, roles: tuple[tuple[str, str], ...]) -> Column:
    for theirs, ours in roles:
        role = F.when(role == theirs, F.lit(ours)).otherwise(role)
    return F.coalesce(role, F.lit(""))


def _turn(role: Column, text: Column) -> Column:
    return F.struct(role.alias("role"), F.coalesce(text, F.lit("")).alias("text"))


def _mapped(record: Column, mapping: Mapping) -> Column:
    read = F.from_json(record, mapping.schema)
    if mapping.turns:
        path, role, text = mapping.turns
        turns = F.coalesce(read[path], F.array().cast(read_type(mapping)))
        return F.transform(turns, lambda t: _turn(_renamed(t[role], mapping.roles), t[text]))
    made = F.array(*[_turn(F.lit(role), read[name]) for role, name in mapping.parts])
    droppable = [role for role, name in mapping.parts if name in mapping.optional]
    return F.filter(made, lambda t: ~t["role"].isin(droppable) | (t["text"] != ""))


def read_type(mapping: Mapping) -> str:
    return mapping.schema.split(" ", 1)[1]


def canonical_turns(records: DataFrame, record: str) -> DataFrame:
    """Add `layout` and `turns`, chosen by the fingerprint of the record."""
    prints = known(records.sparkSession)
    marked = records.withColumn("_print", fingerprint(F.col(record)))
    layout, turns = F.lit(None).cast("string"), F.lit(None).cast(TURNS)
    for m in MAPPINGS:
        fits = F.col("_print") == F.lit(prints[m.name])
        layout = F.when(fits, F.lit(m.name)).otherwise(layout)
        turns = F.when(fits, _mapped(F.col(record), m).cast(TURNS)).otherwise(turns)
    return marked.select("*", layout.alias("layout"), turns.alias("turns")).drop("_print")


def _quoted(text: str) -> str:
    return "".join("\\" + c if c in r"\[](){}|.*+?^$<>/" else c for c in text)


_BREAK = "(" + "|".join(f"{_quoted(c[0])}(?={_quoted(c[1:])})" for c in CONTROL) + ")"


def escaped(text: Column) -> Column:
    """Backslashes doubled; a backslash put behind the first sign of a control string."""
    doubled = F.replace(text, F.lit("\\"), F.lit("\\\\"))
    return F.regexp_replace(doubled, _BREAK, "$1\\\\")


def unescaped(text: Column) -> Column:
    return F.regexp_replace(text, r"(?s)\\(.)", "$1")


def formatted(turns: Column) -> Column:
    """All turns, each as `<|turn|>role<|body|>text<|end|>` and a line end."""
    return F.array_join(
        F.transform(
            turns,
            lambda t: F.concat(F.lit(TURN), escaped(t["role"]), F.lit(BODY), escaped(t["text"]), F.lit(END)),
        ),
        "",
    )


def parsed(text: Column) -> Column:
    """The turns, read back from the formatted text alone."""
    marked = F.filter(F.split(text, _quoted(TURN)), lambda p: p != "")
    closed = F.transform(marked, lambda p: F.substring(p, F.lit(1), F.length(p) - len(END)))

    def turn(piece: Column) -> Column:
        halves = F.split(piece, _quoted(BODY), -1)
        return F.struct(
            unescaped(halves[0]).alias("role"), unescaped(halves[1]).alias("text")
        )

    return F.transform(closed, turn)


def loss_spans(turns: Column) -> Column:
    """`start, length` (code points) in the formatted text of each trained turn's body."""
    zero = F.struct(
        F.lit(0).alias("at"), F.array().cast("array<struct<start:int,length:int>>").alias("spans")
    )

    def step(state: Column, t: Column) -> Column:
        start = state["at"] + F.length(escaped(t["role"])) + len(TURN) + len(BODY)
        size = F.length(escaped(t["text"]))
        span = F.array(F.struct(start.alias("start"), size.alias("length")))
        return F.struct(
            (start + size + len(END)).alias("at"),
            F.when(t["role"] == TRAINED, F.concat(state["spans"], span))
            .otherwise(state["spans"])
            .alias("spans"),
        )

    return F.aggregate(turns, zero, step, lambda s: s["spans"])


def masked_text(text: Column, spans: Column) -> Column:
    """All text under the spans, unescaped, nothing between."""
    return F.array_join(
        F.transform(spans, lambda s: unescaped(F.substring(text, s["start"] + 1, s["length"]))), ""
    )


def format_records(records: DataFrame, record: str = "record") -> DataFrame:
    """Add `layout, turns, formatted, loss_spans` to rows with a JSON record."""
    turned = canonical_turns(records, record)
    return turned.select("*", formatted(F.col("turns")).alias("formatted")).select(
        "*", loss_spans(F.col("turns")).alias("loss_spans")
    )


def records_of(conversations: DataFrame) -> DataFrame:
    """`conv_id, record`: rows by turn gathered to one JSON record per conversation.

    The layout follows the shape: a user and an assistant turn make a prompt record, a
    system, a user and an assistant turn an instruction record, other conversations whose
    roles are user and assistant only a shared one, and all others a messages record.
    """
    turn = F.struct(
        "turn",
        F.coalesce("role", F.lit("")).alias("role"),
        F.coalesce("text", F.lit("")).alias("text"),
    )
    rows = conversations.groupBy("conv_id").agg(F.sort_array(F.collect_list(turn)).alias("t"))
    roles = F.transform("t", lambda t: t["role"])
    text = lambda i: F.get("t", F.lit(i))["text"]
    is_roles = lambda *names: roles == F.array(*[F.lit(n) for n in names])
    both = F.array(F.lit("user"), F.lit("assistant"))
    messages = F.transform("t", lambda t: F.struct(t["role"].alias("role"), t["text"].alias("content")))
    swapped = lambda r: F.when(r == "user", F.lit("human")).otherwise(F.lit("gpt"))
    shared = F.transform(
        "t", lambda t: F.struct(swapped(t["role"]).alias("from"), t["text"].alias("value"))
    )
    # An empty user part would be read as a missing one.
    three = is_roles("system", "user", "assistant") & (F.get("t", F.lit(1))["text"] != "")
    record = (
        F.when(
            is_roles("user", "assistant"),
            F.to_json(F.struct(text(0).alias("prompt"), text(1).alias("completion"))),
        )
        .when(
            three,
            F.to_json(
                F.struct(text(0).alias("instruction"), text(1).alias("input"), text(2).alias("output"))
            ),
        )
        .when(
            F.forall(roles, lambda r: F.array_contains(both, r)),
            F.to_json(F.struct(shared.alias("conversations"))),
        )
        .otherwise(F.to_json(F.struct(messages.alias("messages"))))
    )
    return rows.select("conv_id", record.alias("record"))


def digest_text(turns: Column) -> Column:
    return F.array_join(
        F.transform(turns, lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), ""
    )
