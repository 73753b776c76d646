"""Chat formatting on DataFrame functions: schema fingerprints select declarative mappings.

A record is a JSON object of any layout. Its fingerprint is a hash of its nested field paths; a table of
layouts says for each fingerprint which paths hold which turns. Turns are then written with one template that
marks them, with control strings inside texts escaped reversibly, and with the spans that count for the loss.

The template is ``<s>[INST]role[/INST]text</s>`` per turn. In roles and texts ``%`` becomes ``%25`` and the first
character of each control string its ``%`` code, so no control string is left inside and reading back is exact.

A null text or role is empty. A record without turns is an empty text. A record whose fingerprint no layout has, or that is no JSON
object, gets null turns and null output, and stays in the result. Turns with equal numbers go by role and then
text; null numbers come first. Rows with a null id form one conversation. Other columns are not read; an empty
table gives an empty result.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# fixed values: control strings of the template and the codes of their first characters
CONTROL = ("<s>", "</s>", "[INST]", "[/INST]")
CODES = {"<": "%3C", "[": "%5B"}
TURN = "array<struct<role:string,text:string>>"
#: Jackson's own limit of 20,000,000 characters makes a longer text null without an error.
JSON_OPTIONS = {"maxStringLen": "2147483647"}


@dataclass(frozen=True)
class Layout:
    """Field paths of a layout, and how turns are read.

    ``turns``: pairs (role, path) of single fields in order, left out where optional and null; or one triple
    (list, role field, text field) with other names for roles.
    """

    name: str
    paths: tuple[str, ...]
    turns: tuple[tuple[str, ...], ...]
    roles: tuple[tuple[str, str], ...] = ()


LAYOUTS = (
    Layout("prompt", ("prompt", "response"), (("user", "prompt"), ("assistant", "response"))),
    Layout("completion", ("completion", "prompt"), (("user", "prompt"), ("assistant", "completion"))),
    Layout("question", ("answer", "question"), (("user", "question"), ("assistant", "answer"))),
    Layout("instruction", ("instruction", "output"), (("user", "instruction"), ("assistant", "output"))),
    Layout(
        "instruction-system",
        ("instruction", "output", "system"),
        (("system", "system"), ("user", "instruction"), ("assistant", "output")),
    ),
    Layout("messages", ("messages", "messages[].content", "messages[].role"), (("messages", "role", "content"),)),
    Layout(
        "share",
        ("conversations", "conversations[].from", "conversations[].value"),
        (("conversations", "from", "value"),),
        (("human", "user"), ("gpt", "assistant")),
    ),
    Layout("empty-messages", ("messages",), (("messages", "role", "content"),)),
)


def _schema(layouts: tuple[Layout, ...]) -> str:
    """One schema with all fields that any layout names: texts, and lists of objects."""
    lists = {t[0] for layout in layouts for t in layout.turns if len(t) == 3}
    single = {t[1] for layout in layouts for t in layout.turns if len(t) == 2}
    return ", ".join([f"`{x}` string" for x in sorted(single)] + [f"`{x}` array<map<string,string>>" for x in sorted(lists)])


def paths(layouts: tuple[Layout, ...]) -> Column:
    """Sorted nested field paths of ``record``, parsed as ``value``; null if it is no JSON object."""
    lists = sorted({t[0] for layout in layouts for t in layout.turns if len(t) == 3})
    empty = F.array().cast("array<string>")
    inner = []
    for name in lists:
        keys = f"flatten(transform(value.`{name}`, m -> coalesce(map_keys(m), cast(array() AS array<string>))))"
        inner.append(F.coalesce(F.expr(f"transform({keys}, k -> concat('{name}[].', k))"), empty))
    top = F.json_object_keys("record")
    return F.when(top.isNotNull(), F.array_sort(F.array_distinct(F.concat(top, *inner))))


def fingerprint(field_paths: Column) -> Column:
    return F.xxhash64(F.array_join(field_paths, "\n"))


def _turns(layout: Layout) -> Column:
    value = F.col("value")
    text = lambda c: F.coalesce(c, F.lit(""))
    if len(layout.turns[0]) == 2:
        return F.array(*(F.struct(F.lit(role).alias("role"), text(value[path]).alias("text")) for role, path in layout.turns))
    path, role, content = layout.turns[0]

    def named(c: Column) -> Column:
        out = text(c)
        for old, new in layout.roles:
            out = F.when(c == old, new).otherwise(out)
        return out

    return F.transform(value[path], lambda m: F.struct(named(m[role]).alias("role"), text(m[content]).alias("text")))


def canonical(records: DataFrame, layouts: tuple[Layout, ...] = LAYOUTS) -> DataFrame:
    """``conv_id, layout, turns`` of ``conv_id, record``: the mapping whose fingerprint the record has."""
    parsed = records.select("conv_id", "record", F.from_json("record", _schema(layouts), JSON_OPTIONS).alias("value"))
    marked = parsed.select("conv_id", "value", fingerprint(paths(layouts)).alias("own"))
    name, turns = F.lit(None).cast("string"), F.lit(None).cast(TURN)
    for layout in reversed(layouts):
        is_it = F.col("own") == fingerprint(F.array(*map(F.lit, sorted(layout.paths))))
        name = F.when(is_it, F.lit(layout.name)).otherwise(name)
        turns = F.when(is_it, _turns(layout).cast(TURN)).otherwise(turns)
    return marked.select("conv_id", name.alias("layout"), turns.alias("turns"))


def escaped(text: Column) -> Column:
    out = F.replace(text, F.lit("%"), F.lit("%25"))
    for control in CONTROL:
        out = F.replace(out, F.lit(control), F.lit(CODES[control[0]] + control[1:]))
    return out


def unescaped(text: Column) -> Column:
    for plain, code in CODES.items():
        text = F.replace(text, F.lit(code), F.lit(plain))
    return F.replace(text, F.lit("%25"), F.lit("%"))


def formatted(turns: DataFrame) -> DataFrame:
    """``conv_id, layout, formatted, loss_mask``: the text, and (start, end) code points of assistant texts."""
    written = F.transform(
        "turns",
        lambda t: F.struct(
            F.concat(F.lit("<s>[INST]"), escaped(t["role"]), F.lit("[/INST]")).alias("head"),
            escaped(t["text"]).alias("body"),
            (t["role"] == "assistant").alias("loss"),
        ),
    )
    rows = turns.select("conv_id", "layout", written.alias("w"))
    text = F.array_join(F.transform("w", lambda t: F.concat(t["head"], t["body"], F.lit("</s>"))), "")
    # places by a running sum over the turns
    mask = F.expr(
        """aggregate(w, named_struct('at', 0, 'spans', cast(array() AS array<struct<start:int,end:int>>)), (a, t) -> named_struct(
             'at', a.at + length(t.head) + length(t.body) + 4,
             'spans', CASE WHEN t.loss THEN concat(a.spans, array(named_struct(
               'start', a.at + length(t.head), 'end', a.at + length(t.head) + length(t.body)))) ELSE a.spans END), a -> a.spans)"""
    )
    return rows.select("conv_id", "layout", text.alias("formatted"), mask.alias("loss_mask"))


def read_back(text: Column) -> Column:
    """The turns of a formatted text."""
    parts = F.filter(F.split(text, "</s>", -1), lambda x: x != "")
    end = "[/INST]"
    return F.transform(
        parts,
        lambda x: F.struct(
            unescaped(F.substring_index(F.substring_index(x, end, 1), "[INST]", -1)).alias("role"),
            unescaped(F.substring_index(x, end, -1)).alias("text"),
        ),
    )


def report(out: DataFrame) -> DataFrame:
    """Digests read back from the formatted text and the loss mask."""
    turns = read_back(F.col("formatted"))
    told = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    spans = F.transform("loss_mask", lambda s: unescaped(F.substring(F.col("formatted"), s["start"] + 1, s["end"] - s["start"])))
    return (
        out.select("conv_id", "layout", "formatted", turns.alias("turns"), F.array_join(spans, "").alias("loss"))
        .select(
            "conv_id",
            F.size("turns").cast("long").alias("n_turns"),
            F.sha2(told, 256).alias("turns_sha256"),
            F.length("loss").cast("long").alias("loss_chars"),
            F.sha2("loss", 256).alias("loss_sha256"),
            F.length("formatted").cast("long").alias("formatted_chars"),
        )
    )


def records(rows: DataFrame) -> DataFrame:
    """``conv_id, record``: one JSON object per conversation of ``conv_id, turn, role, text`` rows.

    The layout follows the shape: a question with its answer is a prompt or an instruction, with a system
    turn before them an instruction with a system field, anything else a list of messages. A conversation
    is one record, so its rows meet in one place.
    """
    turn = F.struct("turn", F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text"))
    held = rows.select("conv_id", turn.alias("t")).groupBy("conv_id").agg(F.array_sort(F.collect_list("t")).alias("t"))
    order = F.array_join("t.role", ",")
    text = lambda k: F.col("t")[k]["text"]
    even = F.pmod(F.xxhash64("conv_id"), F.lit(4))
    pair = (
        F.when(even == 0, F.to_json(F.struct(text(0).alias("prompt"), text(1).alias("response"))))
        .when(even == 1, F.to_json(F.struct(text(0).alias("prompt"), text(1).alias("completion"))))
        .when(even == 2, F.to_json(F.struct(text(0).alias("question"), text(1).alias("answer"))))
        .otherwise(F.to_json(F.struct(text(0).alias("instruction"), text(1).alias("output"))))
    )
    system = F.to_json(F.struct(text(0).alias("system"), text(1).alias("instruction"), text(2).alias("output")))
    listed = F.transform("t", lambda x: F.struct(x["role"].alias("role"), x["text"].alias("content")))
    shared = F.transform(
        "t",
        lambda x: F.struct(
            F.when(x["role"] == "user", "human").when(x["role"] == "assistant", "gpt").otherwise(x["role"]).alias("from"), x["text"].alias("value")
        ),
    )
    clash = F.exists("t.role", lambda r: r.isin("human", "gpt"))
    many = F.when((even < 2) & ~clash, F.to_json(F.struct(shared.alias("conversations")))).otherwise(F.to_json(F.struct(listed.alias("messages"))))
    record = F.when(order == "user,assistant", pair).when(order == "system,user,assistant", system).otherwise(many)
    return held.select("conv_id", record.alias("record"))
