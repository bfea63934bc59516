"""Chat formatting with SQL functions only: schema fingerprints, canonical turns, template, loss mask.

Records are variants, each with a layout of its own: JSON text is parsed, typed rows are turned into
variants. A record's nested field paths are read from its variant schema; the SHA-256 of those that
any mapping uses, sorted, is its fingerprint, which selects a declarative mapping (``LAYOUTS``) that
turns it into canonical turns array<struct<role, text>>. Fields that no mapping uses (ids, sources,
scores) do not matter.

The template writes each turn as ``<|im_start|>role\\ntext<|im_end|>\\n``. Control strings inside
roles and texts are escaped reversibly: ``~`` becomes ``~0``, and ``<`` or ``[`` that would begin a
control string becomes ``~1`` or ``~2`` (a line end in a role: ``~3``). The loss mask is the list of
code-point spans [start, end) of assistant texts in the formatted string.

Defined cases: null texts and roles are empty; rows of one conversation go by turn, then role, then
text (ties and repeats stay); a row without a conversation id is a conversation of its own; an
unknown layout, an empty list and text that is no JSON give null turns; a conversation of more than
``MOST_VARIANT`` bytes is mapped by its table's schema; an empty table gives no conversation; extra
columns are ignored.
"""

from __future__ import annotations

import hashlib

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from markscribe.functions.text import let, once

START, END = "<|im_start|>", "<|im_end|>\n"
TRAINED = "assistant"
#: Control strings of this and other common templates; each begins with < or [.
CONTROL = ("<|", "<s>", "</s>", "<<SYS>>", "<</SYS>>", "[INST]", "[/INST]")
#: Bytes of text in a record that is made a variant.
MOST_VARIANT = 1 << 23
TURNS = "array<struct<role:string,text:string>>"


# --- fingerprints and layouts --------------------------------------------------------------------


def nested_paths(schema: Column) -> Column:
    """The nested field paths of a variant's schema (``OBJECT<a: ARRAY<OBJECT<b: STRING>>>`` has ``a[].b``); ``[]`` stands for an array's elements."""
    parts = F.regexp_extract_all(schema, F.lit(r"(?:`(?:[^`]|``)*`|\w+): |OBJECT<|ARRAY<|>|[A-Z_]+(?:\(\d+, ?\d+\))?"), F.lit(0))
    none = F.array().cast("array<string>")
    zero = F.struct(none.alias("above"), F.lit("").alias("at"), none.alias("paths"))
    state = lambda above, at, paths: F.struct(above.alias("above"), at.alias("at"), paths.alias("paths"))

    def step(acc: Column, part: Column) -> Column:
        name = F.regexp_replace(F.substring(part, 1, F.length(part) - 2), "^`|`$", "")
        top = F.try_element_at(acc["above"], F.lit(-1))
        return (
            F.when(part.endswith(": "), state(acc["above"], F.when(top == "", name).otherwise(F.concat(top, F.lit("."), name)), acc["paths"]))
            .when(part == "OBJECT<", state(F.array_append(acc["above"], acc["at"]), acc["at"], acc["paths"]))
            .when(part == "ARRAY<", state(F.array_append(acc["above"], acc["at"]), F.concat(acc["at"], F.lit("[]")), acc["paths"]))
            .when(part == ">", state(F.slice(acc["above"], 1, F.size(acc["above"]) - 1), acc["at"], acc["paths"]))
            .otherwise(state(acc["above"], acc["at"], F.array_append(acc["paths"], acc["at"])))
        )

    return F.aggregate(parts, zero, step, lambda acc: acc["paths"])


def fingerprint(paths: Column) -> Column:
    """The fingerprint of nested field paths; those that no mapping uses are left out."""
    known = sorted({p for _, used, _ in LAYOUTS for p in used})
    return F.sha2(F.array_join(F.array_sort(F.array_intersect(paths, F.array(*map(F.lit, known)))), ","), 256)


def layout_fingerprint(paths) -> str:
    return hashlib.sha256(",".join(sorted(paths)).encode()).hexdigest()


#: Name, nested field paths, mapping. A mapping is ("list", array, role field, text field)
#: or ("fields", ((role, path), …)); empty optional fields give no turn.
LAYOUTS = (
    ("turn_rows", ("turns[].turn", "turns[].role", "turns[].text"), ("list", "turns", "role", "text")),
    ("messages", ("messages[].role", "messages[].content"), ("list", "messages", "role", "content")),
    ("from_value", ("conversations[].from", "conversations[].value"), ("list", "conversations", "from", "value")),
    ("instruction", ("instruction", "input", "output"), ("fields", (("user", "instruction+input"), ("assistant", "output")))),
    ("instruction_short", ("instruction", "output"), ("fields", (("user", "instruction"), ("assistant", "output")))),
    ("prompt_response", ("prompt", "response"), ("fields", (("user", "prompt"), ("assistant", "response")))),
    ("prompt_completion", ("prompt", "completion"), ("fields", (("user", "prompt"), ("assistant", "completion")))),
    ("system_prompt", ("system", "prompt", "response"), ("fields", (("system", "system"), ("user", "prompt"), ("assistant", "response")))),
)
#: Role names of other layouts (rows by turn keep theirs).
ROLE_NAMES = {"human": "user", "gpt": "assistant", "bot": "assistant", "model": "assistant"}


def _role(role: Column) -> Column:
    found = F.coalesce(role, F.lit(""))
    for other, ours in ROLE_NAMES.items():
        found = F.when(role == other, ours).otherwise(found)
    return found


def _turn(role: Column, text: Column) -> Column:
    return F.struct(role.alias("role"), F.coalesce(text, F.lit("")).alias("text"))


def _apply(mapping: tuple, get) -> Column:
    """A mapping's turns; ``get`` gives a named field, for lists an array of structs."""
    if mapping[0] == "list":
        _, name, role, text = mapping
        named = (lambda c: F.coalesce(c, F.lit(""))) if name == "turns" else _role
        return F.transform(get(name), lambda m: _turn(named(m[role]), m[text]))
    turns = []
    for role, path in mapping[1]:
        parts = path.split("+")
        text = get(parts[0])
        for more in parts[1:]:
            extra = F.coalesce(get(more), F.lit(""))
            text = F.concat(F.coalesce(text, F.lit("")), F.when(extra != "", F.concat(F.lit("\n"), extra)).otherwise(""))
        turn = F.array(_turn(F.lit(role), text))
        turns.append(F.when(F.coalesce(text, F.lit("")) != "", turn).otherwise(F.array().cast(TURNS)) if role == "system" else turn)
    return F.concat(*turns)


def turns_of_variant(record: Column) -> Column:
    """Canonical turns of variants in any known layout, each by its own fingerprint; null where the layout is unknown."""
    chosen = lambda seen: F.coalesce(*(F.when(seen == layout_fingerprint(paths), _apply(mapping, _field(record, mapping))) for _, paths, mapping in LAYOUTS))
    return let(fingerprint(nested_paths(F.schema_of_variant(record))), chosen)


def _field(record: Column, mapping: tuple):
    """How a mapping gets the fields of a variant."""
    if mapping[0] == "list":
        kind = f"array<struct<{mapping[2]}:string,{mapping[3]}:string>>"
        return lambda name: F.try_variant_get(record, f"$.{name}", kind)
    return lambda name: F.try_variant_get(record, f"$.{name}", "string")


def turns_of_json(text: Column) -> Column:
    """Canonical turns of rows of JSON text."""
    return turns_of_variant(F.try_parse_json(text))


def turns_of_row(*columns: str) -> Column:
    """Canonical turns of typed columns."""
    return turns_of_variant(F.to_variant_object(F.struct(*columns)))


# --- template ------------------------------------------------------------------------------------


def escape(text: Column) -> Column:
    out = F.replace(text, F.lit("~"), F.lit("~0"))
    for control in CONTROL:
        out = F.replace(out, F.lit(control), F.lit(("~1" if control[0] == "<" else "~2") + control[1:]))
    return out


def unescape(text: Column) -> Column:
    for mark, char in (("~3", "\n"), ("~2", "["), ("~1", "<"), ("~0", "~")):
        text = F.replace(text, F.lit(mark), F.lit(char))
    return text


def format_turns(df: DataFrame, turns: str = "turns") -> DataFrame:
    """Replace ``turns`` by ``formatted`` and ``loss_spans`` array<struct<start, end>> (code points)."""
    segment = lambda t: F.struct(
        F.concat(F.lit(START), F.replace(escape(t.role), F.lit("\n"), F.lit("~3")), F.lit("\n")).alias("head"),
        escape(t.text).alias("body"),
        (t.role == TRAINED).alias("loss"),
    )
    df = df.withColumn("_segments", F.transform(turns, segment))
    empty = F.array().cast("array<struct<start:int,end:int>>")

    def step(acc, s):
        start = acc.at + F.length(s.head)
        end = start + F.length(s.body)
        span = F.array(F.struct(start.alias("start"), end.alias("end")))
        return F.struct((end + len(END)).alias("at"), F.when(s.loss, F.concat(acc.spans, span)).otherwise(acc.spans).alias("spans"))

    spans = F.aggregate("_segments", F.struct(F.lit(0).alias("at"), empty.alias("spans")), step, lambda acc: acc.spans)
    text = F.array_join(F.transform("_segments", lambda s: F.concat(s.head, s.body, F.lit(END))), "")
    return df.select(*(c for c in df.columns if c not in (turns, "_segments")), text.alias("formatted"), spans.alias("loss_spans"))


def parse_formatted(formatted: Column) -> Column:
    """The turns array<struct<role, text>> that a formatted string holds."""
    parts = F.filter(F.split(formatted, r"<\|im_end\|>\n", -1), lambda p: p != "")
    bare = lambda p: F.substring(p, len(START) + 1, 2**31 - 1)
    role = lambda p: F.substring_index(bare(p), "\n", 1)
    return F.transform(parts, lambda p: F.struct(unescape(role(p)).alias("role"), unescape(F.substr(bare(p), F.length(role(p)) + 2)).alias("text")))


def loss_text(formatted: Column, spans: Column) -> Column:
    """All text under the loss mask, unescaped."""
    return F.array_join(F.transform(spans, lambda s: unescape(F.substr(formatted, s.start + 1, s.end - s.start))), "")


def conversation_turns(rows: DataFrame) -> DataFrame:
    """One row per conversation of ``rows(conv_id, turn, role, text)``: conv_id, turns."""
    turn = F.struct("turn", F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text"))
    grouped = rows.filter("conv_id is not null").groupBy("conv_id").agg(F.array_sort(F.collect_list(turn)).alias("turns"))
    alone = rows.filter("conv_id is null").select("conv_id", F.array(turn).alias("turns"))
    records = grouped.unionByName(alone)
    size = F.aggregate("turns", F.lit(0).cast("long"), lambda n, t: n + F.octet_length(t.text) + F.octet_length(t.role) + 64)
    row = F.to_variant_object(F.struct("turns"))
    typed = _apply(("list", "turns", "role", "text"), F.col)
    records = records.withColumn("_record", once(F.when(size <= MOST_VARIANT, row)))
    return records.select("conv_id", F.when(F.col("_record").isNull(), typed).otherwise(turns_of_variant(F.col("_record"))).alias("turns"))


def format_conversations(rows: DataFrame) -> DataFrame:
    """Formatted string and loss mask of every conversation."""
    return format_turns(conversation_turns(rows))


def digest_columns(formatted: DataFrame) -> DataFrame:
    """The query's columns, all read back from the formatted strings."""
    turns = parse_formatted(F.col("formatted"))
    loss = loss_text(F.col("formatted"), F.col("loss_spans"))
    whole = F.array_join(F.transform("_turns", lambda t: F.concat(t.role, F.lit("\n"), t.text, F.lit("\n"))), "")
    return formatted.withColumn("_turns", turns).withColumn("_loss", loss).select(
        "conv_id",
        F.size("_turns").cast("long").alias("n_turns"),
        F.sha2(whole, 256).alias("turns_sha256"),
        F.length("_loss").cast("long").alias("loss_chars"),
        F.sha2("_loss", 256).alias("loss_sha256"),
        F.length("formatted").cast("long").alias("formatted_chars"),
    )
