"""Secret scan on DataFrame functions: patterns, and Markov models of characters.

Two first-order character models, one of random strings and one of ordinary identifiers, are trained from
samples that the patterns label. A candidate (a long run of identifier characters with a digit and a letter, or mixed case)
is a secret when the log-likelihood ratio per character of the two models is above a threshold. Patterns with
fixed forms are found besides and always stay. The models only add: a candidate that overlaps a match of a pattern is none.

Places are code points, the end is exclusive. A null or empty text has no spans. Rows alike in id and text get
equal rows. The samples are the pattern matches and the ordinary words of all documents; without samples of a
kind there are no markov spans. A text of any size is scanned whole. Columns besides id and text are not read;
an empty table gives an empty result.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# fixed values: the patterns (a group in parentheses is the secret itself), and how long it must be
ASSIGN = r"""(?i:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ASSIGN_CHARS = 12
ACCESS = r"AKIA[A-Z0-9]+"
ACCESS_CHARS = 18
HEX = r"[0-9a-f]+"
HEX_CHARS = 16

CANDIDATE = r"[A-Za-z0-9+/_=-]{16,}"
_LONG_ACCESS, _LONG_HEX = ACCESS.replace("+", f"{{{ACCESS_CHARS - 4},}}"), HEX.replace("+", f"{{{HEX_CHARS},}}")
#: What candidates are searched with: base matches, with the identifier that leads up to a keyword, are passed over.
_SEARCH = "|".join([CANDIDATE.replace("{16,}", "*?") + ASSIGN, _LONG_ACCESS, _LONG_HEX, CANDIDATE])
_BASE = "|".join([ASSIGN, _LONG_ACCESS, _LONG_HEX])
#: Characters of a candidate that are taken out of it at once.
_PART = 256
#: Fewest nats per character by which a candidate must look more random than ordinary.
LEAST_RATIO = 0.5
_ASCII = 128
#: Weight, in counts, of the chance of a character whatever stands before it.
_SHRINK = 16.0
#: Spans whose places are summed up together.
_RUN = 256


def _quoted(pattern: str) -> str:
    return pattern.replace("\\", "\\\\").replace("'", "\\'")


def _places(found: str, pattern: str, group: int, least: int) -> Column:
    """Array of (start, end, m) of the matches ``found`` whose ``group`` has ``least`` characters or more.

    The pieces between matches come from a split by the same pattern, made only where there are matches;
    places are their running sum, taken in runs so that very many matches cost little more than their number.
    """
    value = f"regexp_extract(x.m, '{_quoted(pattern)}', {group})" if group else "x.m"
    empty = "cast(array() AS array<struct<start:int,end:int,m:string>>)"
    pairs = f"arrays_zip(slice(split(text, '{_quoted(pattern)}', -1), 1, size({found})), {found})"
    placed = f"""
      aggregate(
        transform(array({pairs}), p -> transform(sequence(0, (size(p) - 1) div {_RUN}), c -> slice(p, c * {_RUN} + 1, {_RUN})))[0],
        named_struct('at', 0, 'runs', cast(array() AS array<array<struct<start:int,end:int,m:string>>>)),
        (a, run) -> aggregate(
          run,
          named_struct('at', a.at, 'spans', {empty}),
          (b, x) -> named_struct(
            'at', b.at + length(x['0']) + length(x['{found}']),
            'spans', concat(b.spans, array(named_struct(
              'start', b.at + length(x['0']), 'end', b.at + length(x['0']) + length(x['{found}']), 'm', x['{found}'])))),
          b -> named_struct('at', b.at, 'runs', concat(a.runs, array(b.spans)))),
        a -> flatten(a.runs))"""
    return F.expr(f"CASE WHEN size({found}) = 0 THEN {empty} ELSE filter({placed}, x -> length({value}) >= {least}) END")


def _found(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    text = F.coalesce(docs[text_col].cast("string"), F.lit(""))
    kinds = {
        "assign": (ASSIGN, 1, ASSIGN_CHARS),
        "access": (ACCESS, 0, ACCESS_CHARS),
        "hex": (_LONG_HEX, 0, HEX_CHARS),  # runs are maximal: the same matches
        "candidates": (_SEARCH, 0, 1),
    }
    matched = docs.select(docs[id_col].alias("doc_id"), text.alias("text")).select(
        "doc_id", "text", *(F.expr(f"regexp_extract_all(text, '{_quoted(p)}', 0)").alias(f"_{k}") for k, (p, _, _) in kinds.items())
    )
    return matched.select("doc_id", *(_places(f"_{k}", *v).alias(k) for k, v in kinds.items()))


def _mixed(value: Column) -> Column:
    """Letters together with digits, or both cases beyond a capital."""
    return (value.rlike("[0-9]") & value.rlike("[A-Za-z]")) | (value.rlike("[a-z][A-Z]") & value.rlike("[A-Z].*[A-Z]"))


def labelled(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """``value, random`` of all documents in one pass: values of the patterns, and ordinary long words."""
    text = F.coalesce(docs[text_col].cast("string"), F.lit(""))
    def all_of(pattern: str, group: int) -> Column:
        return F.expr(f"regexp_extract_all(text, '{_quoted(pattern)}', {group})")

    secret = F.concat(
        F.filter(all_of(ASSIGN, 1), lambda m: F.length(m) >= ASSIGN_CHARS),
        F.filter(all_of(ACCESS, 0), lambda m: F.length(m) >= ACCESS_CHARS),
        F.filter(all_of(_LONG_HEX, 0), lambda m: m.rlike("[a-f]")),
    )

    def kind(values: Column, random: bool) -> Column:
        return F.transform(values, lambda v: F.struct(v.alias("value"), F.lit(random).alias("random")))

    both = F.concat(kind(secret, True), kind(all_of("[A-Za-z][A-Za-z_-]{7,}", 0), False))
    return docs.select(text.alias("text")).select(F.inline(both))


def log_ratios(samples: DataFrame) -> list[float]:
    """Log of random over ordinary chance of each character after each other, for ASCII codes ``a * 128 + b``.

    One table of fixed size; counts are partial sums over the samples, of which equal ones are counted first.
    What follows a rare character is shrunk towards how common the next character is in the model at all.
    Empty if a kind has no sample: two models are needed for a ratio.
    """
    values = samples.where("length(value) > 1").groupBy("random", "value").agg(F.count("*").alias("n"))
    codes = values.select("random", "n", F.expr("transform(split(value, ''), c -> ascii(c))").alias("c"))
    pairs = codes.select("random", "n", F.explode(F.arrays_zip(F.expr("slice(c, 1, size(c) - 1)").alias("a"), F.expr("slice(c, 2, size(c) - 1)").alias("b"))).alias("p"))
    counts = pairs.where(f"p.a < {_ASCII} AND p.b < {_ASCII}").groupBy("random", "p.a", "p.b").agg(F.sum("n").alias("count")).collect()
    table = {kind: [[0] * _ASCII for _ in range(_ASCII)] for kind in (True, False)}
    for row in counts:  # at most 2 * 128 * 128
        if 0 <= row.a < _ASCII and 0 <= row.b < _ASCII:
            table[row.random][row.a][row.b] += row["count"]
    if not all(any(map(any, rows)) for rows in table.values()):
        return []
    chance = {}
    for kind, rows in table.items():
        next_ones = [sum(r[b] for r in rows) + 0.5 for b in range(_ASCII)]
        common = [x / sum(next_ones) for x in next_ones]
        chance[kind] = [[(r[b] + _SHRINK * common[b]) / (sum(r) + _SHRINK) for b in range(_ASCII)] for r in rows]
    return [math.log(chance[True][a][b] / chance[False][a][b]) for a in range(_ASCII) for b in range(_ASCII)]


def scan(
    docs: DataFrame,
    ratios: list[float],
    id_col: str = "doc_id",
    text_col: str = "text",
    least_ratio: float = LEAST_RATIO,
) -> DataFrame:
    """``doc_id, assign, access, hex, markov``: arrays of (start, end, m); ``markov`` holds what the models add.

    Without ``ratios`` they add nothing.
    """
    joined = ",".join(f"{x:.5f}" for x in ratios)
    found = _found(docs, id_col, text_col)
    table = f"cast(split('{joined}', ',') AS array<double>)"  # folded to a literal once
    # a character's place is looked up in a short part only, so a run costs its length
    total = f"""aggregate(regexp_extract_all(x.m, '.{{1,{_PART}}}', 0), named_struct('last', -1, 'sum', 0D), (t, part) -> aggregate(
        sequence(1, length(part)), t, (u, i) -> named_struct(
          'last', ascii(substring(part, i, 1)),
          'sum', u.sum + if(u.last < 0, 0D, element_at({table}, u.last * {_ASCII} + ascii(substring(part, i, 1)) + 1)))), t -> t.sum)"""
    likely = F.expr(f"filter(candidates, x -> {total} / (length(x.m) - 1) >= {least_ratio})" if ratios else "filter(candidates, x -> false)")
    mixed = F.filter("candidates", lambda x: x["m"].rlike(f"^{CANDIDATE}$") & ~x["m"].rlike(_BASE) & _mixed(x["m"]))
    return found.withColumn("candidates", mixed).select("doc_id", "assign", "access", "hex", likely.alias("markov"))


def report(found: DataFrame) -> DataFrame:
    """Counts, a digest of the base spans and all spans as text, by start and then kind."""
    kinds = ("assign", "access", "hex", "markov")
    marked = [F.expr(f"transform(`{k}`, x -> struct(x.start AS start, {i} AS kind, x.end AS end))") for i, k in enumerate(kinds)]
    names = F.array(*map(F.lit, kinds))

    def told(spans: list[Column]) -> Column:
        one = lambda x: F.concat_ws(":", names[x["kind"]], x["start"].cast("string"), x["end"].cast("string"))
        return F.array_join(F.transform(F.array_sort(F.concat(*spans)), one), ",")

    return found.select(
        "doc_id",
        *(F.size(k).cast("long").alias(f"n_{k}") for k in kinds),
        F.sha2(told(marked[:3]), 256).alias("base_sha256"),
        told(marked).alias("spans"),
    )
