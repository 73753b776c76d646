"""Personal data by weak supervision.

Fixed patterns find base spans, which always stay. A wider net (numbers and addresses of looser form) finds
candidates besides. On every span labelers vote: patterns (strict form, checks such as Luhn), a gazetteer
(endings and codes known for the kind) and the context (a cue word before the span, signs beside it); each says
yes, no or nothing. Per kind, expectation-maximisation estimates from the agreement of the votes how reliable each
labeler is, and so a chance for every pattern of votes. A logistic span classifier is then trained on those
chances; it sees votes and the shape of the span, and decides which candidates become spans.

Votes and shapes are a few bits each, so what is gathered over the whole corpus is one count per pattern: a
table of fixed size. Spans are found once and stored; only they, no texts, are read again for the decision.

Places are code points, the end is exclusive. A null or empty text has no spans. Rows alike in id and text
get equal rows. An empty table gives an empty result. A text of any size is scanned whole, in time linear in
its length. Columns besides id and text are not read.
"""

from __future__ import annotations

import hashlib
import re
from bisect import bisect_right
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from hazeline.llm import common
from hazeline.llm.common import stored

KINDS = ("email", "ip", "card", "phone")
# fixed values: the base patterns
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_IP = re.compile(r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
# the wider net, one pattern per kind
_AT = re.compile(r"[A-Za-z0-9._%+-]{1,64}(?: ?[\[(]at[\])] ?| at )[A-Za-z0-9-]{1,63}(?: ?[\[(]dot[\])] ?| dot |\.)[A-Za-z]{2,24}")
_HEX_IP = re.compile(r"(?<![0-9A-Fa-f:])(?:[0-9A-Fa-f]{1,4}:){5,7}[0-9A-Fa-f]{1,4}(?![0-9A-Fa-f:])")
_LONG = re.compile(r"(?<![0-9])[0-9]{13,19}(?![0-9])")
_LOCAL_PHONE = re.compile(r"(?<![0-9+(])(?:\([0-9]{2,4}\)|[0-9]{2,4})[\x20.-][0-9]{3,4}[\x20.-]?[0-9]{4}(?![0-9])")
# fixed values: the gazetteers
_ENDINGS = frozenset("com org net edu gov info io de fr es uk eu us ch at it nl co biz".split())
_CARD_STARTS = ("4", "51", "52", "53", "54", "55", "34", "37", "6011", "65", "35", "30", "36", "38")
_CODES = ("1", "7", "20", "27", "30", "31", "32", "33", "34", "39", "41", "43", "44", "45", "46", "47", "48", "49", "52", "55", "61", "81", "86", "91")
_CUES = {
    "email": re.compile(r"(?i)mail|contact|write|address|@"),
    "ip": re.compile(r"(?i)\bip\b|host|server|address|login"),
    "card": re.compile(r"(?i)card|visa|credit|payment|karte|carte|tarjeta"),
    "phone": re.compile(r"(?i)call|phone|tel|fax|mobile|handy|m[oó]vil"),
}
LABELERS = 5
SHAPES = 4
_YES, _NO, _NOTHING = 1, 0, 2


def _luhn(digits: str) -> bool:
    total = 0
    for k, d in enumerate(reversed(digits)):
        x = int(d) * (1 + k % 2)
        total += x - 9 if x > 9 else x
    return total % 10 == 0


def emails(text: str) -> Iterator[tuple[int, int]]:
    """Leftmost matches of the e-mail pattern, from each ``@`` outwards: linear in the text."""
    done, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > done and text[start - 1] in _LOCAL:
            start -= 1
        done_here = _DOMAIN.match(text, at + 1) if start < at else None
        if done_here:
            done = done_here.end()
            yield start, done
        else:
            done = max(done, at + 1)
        at = text.find("@", max(at + 1, done))


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(kind, start, end) of the fixed patterns, by kind and then start."""
    out = [(0, a, b) for a, b in emails(text)] if "@" in text else []
    for m in _IP.finditer(text):
        if all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or "0") <= 255 for p in m.group().split(".")):
            out.append((1, *m.span()))
    for m in _CARD.finditer(text):
        if m.end() - m.start() >= 16:
            digits = re.sub(r"[^0-9]", "", m.group())
            if 16 <= len(digits) <= 19 and _luhn(digits):
                out.append((2, *m.span()))
    if "+" in text:
        for m in _PHONE.finditer(text):
            if 8 <= sum(c.isdigit() for c in m.group()) <= 15:
                out.append((3, *m.span()))
    return out


def candidates(text: str, base: list[tuple[int, int, int]]) -> list[tuple[int, int, int]]:
    """(kind, start, end) of the wider net outside the base spans."""
    taken = sorted((a, b) for _, a, b in base)
    starts = [a for a, _ in taken]
    reach = np.maximum.accumulate([b for _, b in taken]).tolist() if taken else []
    out = []
    wide = [(2, _LONG), (3, _LOCAL_PHONE)]
    if "at" in text and ("dot" in text or "[" in text or "(" in text):
        wide.append((0, _AT))
    if text.count(":") >= 5:
        wide.append((1, _HEX_IP))
    for kind, pattern in wide:
        for m in pattern.finditer(text):
            k = bisect_right(starts, m.end() - 1)
            if not k or reach[k - 1] <= m.start():
                out.append((kind, *m.span()))
    return out


def votes(text: str, kind: int, start: int, end: int, base: bool) -> tuple[int, int]:
    """The labelers' votes in base 3 and the shape bits of a span."""
    value, name = text[start:end], KINDS[kind]
    before = text[max(0, start - 24) : start]
    after = text[end : end + 1]
    digits = "".join(c for c in value if c.isascii() and c.isdigit())
    said = [_YES if base else _NO]
    if kind == 0:
        said.append(_YES if value.rpartition(".")[2].lower() in _ENDINGS else _NO)
        said.append(_YES if "@" in value else _NO)
    elif kind == 1:
        said.append(_NO if digits.startswith("0") else _YES)
        said.append(_YES if value.count(".") == 3 else _NOTHING)
    elif kind == 2:
        said.append(_YES if digits.startswith(_CARD_STARTS) else _NO)
        said.append(_YES if _luhn(digits) else _NO)
    else:
        said.append((_YES if digits.startswith(_CODES) else _NO) if value.startswith("+") else _NOTHING)
        said.append(_YES if 9 <= len(digits) <= 13 else _NO)
    said.append(_YES if _CUES[name].search(before) else _NOTHING)
    glued = (before[-1:].isalnum() and before[-1:].isascii()) or (after.isalnum() and after.isascii())
    said.append(_NO if glued else _NOTHING)
    code = 0
    for v in said:
        code = code * 3 + v
    shape = (len(value) > 16) | (any(c in " -()" for c in value) << 1) | ((len(set(digits)) > 4) << 2) | (value[:1].isdigit() << 3)
    return code, int(shape)


_SPAN = T.StructType(
    [
        T.StructField("kind", T.IntegerType()),
        T.StructField("start", T.IntegerType()),
        T.StructField("end", T.IntegerType()),
        T.StructField("base", T.BooleanType()),
        T.StructField("votes", T.IntegerType()),
        T.StructField("shape", T.IntegerType()),
    ]
)
_ARROW_SPAN = pa.list_(
    pa.struct([("kind", pa.int32()), ("start", pa.int32()), ("end", pa.int32()), ("base", pa.bool_()), ("votes", pa.int32()), ("shape", pa.int32())])
)
_ANY = re.compile(r"[0-9]|@| at |[\[(]at")


def _scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in common.slices(batches):
        out = []
        for text in batch.column("text").to_pylist():
            found = []
            if _ANY.search(text) or text.count(":") >= 5:
                base = base_spans(text)
                for is_base, spans in ((True, base), (False, candidates(text, base))):
                    for kind, a, b in spans:
                        code, shape = votes(text, kind, a, b, is_base)
                        found.append({"kind": kind, "start": a, "end": b, "base": is_base, "votes": code, "shape": shape})
            out.append(found)
        yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("th"), pa.array(out, _ARROW_SPAN)], ["doc_id", "th", "found"])


def spotted(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, th, found``: base spans and candidates with their votes and shapes."""
    source = common.keyed(docs, id_col, text_col)
    schema = T.StructType([source.schema["doc_id"], T.StructField("th", T.LongType()), T.StructField("found", T.ArrayType(_SPAN))])
    return source.mapInArrow(_scan, schema)


def agreement(codes: np.ndarray, counts: np.ndarray, rounds: int = 50) -> np.ndarray:
    """Chance that a span with each pattern of votes is real, by expectation-maximisation.

    Every labeler has a chance of saying yes, no and nothing for real spans and for others; votes are
    independent given the truth. Starts from the majority of the votes.
    """
    said = np.stack([(codes // 3 ** (LABELERS - 1 - k)) % 3 for k in range(LABELERS)], axis=1)
    real = 0.5 + 0.4 * np.tanh((said == _YES).sum(axis=1) - (said == _NO).sum(axis=1) - 0.5)
    for _ in range(rounds):
        log = np.zeros((len(codes), 2))
        for t, weight in enumerate((counts * (1 - real), counts * real)):
            prior = (weight.sum() + 1) / (counts.sum() + 2)
            log[:, t] = np.log(prior)
            for k in range(LABELERS):
                chance = np.bincount(said[:, k], weight, 3) + 1
                log[:, t] += np.log(chance / chance.sum())[said[:, k]]
        real = 1 / (1 + np.exp(np.clip(log[:, 0] - log[:, 1], -50, 50)))
    return real


def span_model(table: list[tuple[int, int, int, int]]) -> dict[tuple[int, int, int], float]:
    """Chance of every (kind, votes, shape) that occurs, from counts of them."""
    out = {}
    for kind in range(len(KINDS)):
        rows = sorted(r for r in table if r[0] == kind)
        if not rows:
            continue
        codes, shapes, counts = (np.array([r[j] for r in rows]) for j in (1, 2, 3))
        target = agreement(codes, counts.astype(float))
        said = [(codes // 3 ** (LABELERS - 1 - k)) % 3 for k in range(LABELERS)]
        x = np.stack([np.ones(len(rows)), *((s == v).astype(float) for s in said for v in (_YES, _NO)), *(((shapes >> b) & 1).astype(float) for b in range(SHAPES))], axis=1)
        weight, w = counts / counts.sum(), np.zeros(x.shape[1])
        for _ in range(300):  # Newton steps with a small ridge
            p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
            step = x.T @ (weight * (p - target)) + 1e-4 * w
            curve = (x * (weight * p * (1 - p))[:, None]).T @ x + 1e-4 * np.eye(x.shape[1])
            move = np.linalg.solve(curve, step)
            w -= move / max(1.0, float(np.abs(move).max()))
            if np.abs(move).max() < 1e-9:
                break
        chance = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        out.update({(kind, int(c), int(s)): float(p) for c, s, p in zip(codes, shapes, chance, strict=True)})
    return out


def _decide(model: dict, least: float) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            counts = [[] for _ in KINDS]
            digest, every = [], []
            for found in batch.column("found").to_pylist():
                base = sorted((s["kind"], s["start"], s["end"]) for s in found if s["base"])
                more = [
                    (s["kind"], s["start"], s["end"]) for s in found if not s["base"] and model.get((s["kind"], s["votes"], s["shape"]), 0.0) >= least
                ]
                for k, c in enumerate(counts):
                    c.append(sum(b[0] == k for b in base))
                told = lambda spans: ",".join(f"{KINDS[k]}:{a}:{b}" for k, a, b in spans)
                digest.append(hashlib.sha256(told(base).encode()).hexdigest())
                every.append(told(sorted(base + more)))
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), *(pa.array(c, pa.int64()) for c in counts), pa.array(digest, pa.string()), pa.array(every, pa.string())],
                ["doc_id", *(f"n_{k}" for k in KINDS), "base_sha256", "spans"],
            )

    return run


def find_personal(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", least: float = 0.9) -> DataFrame:
    """``doc_id``, base counts by kind, a digest of the base spans, and all spans as text."""
    rows = stored(spotted(docs, id_col, text_col), "spotted")
    patterns = rows.select(F.explode("found").alias("s")).groupBy("s.kind", "s.votes", "s.shape").count()
    model = span_model([tuple(r) for r in patterns.collect()])  # 4 kinds, 3^5 votes, 2^4 shapes at most
    schema = T.StructType(
        [
            rows.schema["doc_id"],
            *(T.StructField(f"n_{k}", T.LongType()) for k in KINDS),
            T.StructField("base_sha256", T.StringType()),
            T.StructField("spans", T.StringType()),
        ]
    )
    return rows.mapInArrow(_decide(model, least), schema)
