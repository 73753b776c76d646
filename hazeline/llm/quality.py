"""Quality classifier: a factorisation machine over hashed words and structure statistics.

A text is a sparse vector: hashed words and signs weighted by the logarithm of their counts and brought to
length one, and statistics of its structure (lengths, shares of character kinds, repetition). The score is a
logistic of a bias, a linear term and all pairwise interactions, each the product of two low-rank vectors;
the sum over pairs is half the square of the sum less the sum of the squares, so a text is scored in time
linear in its words.

The model is fitted on at most ``sample`` labelled rows (those with the smallest hash of the id); every text is
scored whole. Scoring sees the text and nothing else.

A null text is empty; an empty text has all features zero but its statistics and gets a score like any other.
Labels: null ids and null labels are not used; of repeated labels of an id the mean decides, a tie is good.
Without labels every score is 0.5 and the prediction 1. Rows alike in id and text get equal scores. Columns
besides id and text are not read; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from hazeline.llm import common
from hazeline.llm.common import U64

BUCKETS = 1 << 14
FACTORS = 8
#: Most labelled rows the model is fitted on.
SAMPLE = 8000
STATS = 16


@dataclass
class Model:
    bias: float
    linear: np.ndarray  # (BUCKETS + STATS,)
    factors: np.ndarray  # (BUCKETS + STATS, FACTORS)
    center: np.ndarray
    scale: np.ndarray


def _sum_by(values: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    sums = np.append(0, np.cumsum(values, dtype=np.float64))
    return sums[bounds[1:]] - sums[bounds[:-1]]


def features(data: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(row, bucket, weight) of the hashed words and signs of every row, and the rows' statistics."""
    n = len(bounds) - 1
    hashes, firsts, lengths = common.words(data, bounds)
    kind = data[:, None] if len(data) else np.zeros((0, 1), np.uint8)
    kind = kind[:, 0]
    upper = (kind >= 65) & (kind <= 90)
    digit = (kind >= 48) & (kind <= 57)
    space = (kind == 32) | ((kind >= 9) & (kind <= 13))
    letter = ((kind >= 97) & (kind <= 122)) | upper | (kind >= 128)
    sign = ~(digit | space | letter)
    # signs count as words of their own, each byte
    where = np.flatnonzero(sign)
    rows = np.concatenate([np.repeat(np.arange(n), np.diff(firsts)), np.searchsorted(bounds, where, "right") - 1])
    bucket = np.concatenate([hashes >> U64(50), (common.mixed(common._BYTE_CODES[kind[where]]) >> U64(50))]).astype(np.int64)
    pair, count = np.unique(rows * BUCKETS + bucket, return_counts=True)
    row, bucket = pair // BUCKETS, pair % BUCKETS
    weight = np.log1p(count)
    cuts = np.searchsorted(row, np.arange(n + 1))
    norm = np.sqrt(_sum_by(weight**2, cuts))
    weight = weight / np.maximum(norm, 1e-9)[row]
    size = np.diff(bounds).astype(float)
    n_words = np.diff(firsts).astype(float)
    most = np.zeros(n)
    np.maximum.at(most, row, count)
    lines = _sum_by(kind == 10, bounds)
    tokens = np.diff(np.searchsorted(np.flatnonzero(space), bounds)) + 1.0
    after = np.append(kind[1:], 0)
    some = np.maximum(size, 1)
    stats = np.stack(
        [
            np.log1p(size),
            np.log1p(n_words),
            _sum_by(lengths, firsts) / np.maximum(n_words, 1),
            _sum_by(upper, bounds) / some,
            _sum_by(digit, bounds) / some,
            _sum_by(space, bounds) / some,
            _sum_by(sign, bounds) / some,
            _sum_by(kind >= 128, bounds) / some,
            np.diff(cuts) / np.maximum(n_words, 1),
            most / np.maximum(n_words, 1),
            lines / tokens,
            _sum_by(sign & (np.append(0, kind[:-1]) == kind), bounds) / some if len(kind) else np.zeros(n),
            _sum_by(kind == 46, bounds) / np.maximum(n_words, 1),
            _sum_by(sign & (kind != 46) & (kind != 44), bounds) / tokens,
            _sum_by(upper & (after >= 65) & (after <= 90), bounds) / some,
            n_words / tokens,
        ],
        axis=1,
    )
    return row, bucket, weight, stats


def _joined(row, bucket, weight, stats, model_center, model_scale):
    """Hashed features and statistics as one list of (row, column, value) sorted by row."""
    n = len(stats)
    dense = np.clip((stats - model_center) / model_scale, -4, 4) / 4
    r = np.concatenate([row, np.repeat(np.arange(n), STATS)])
    c = np.concatenate([bucket, np.tile(np.arange(STATS) + BUCKETS, n)])
    v = np.concatenate([weight, dense.ravel()])
    order = np.argsort(r, kind="stable")
    return r[order], c[order], v[order]


def _forward(row, column, value, n, bias, linear, factors):
    """Raw scores, and the sums of factor vectors that the gradient needs; linear in the entries."""
    cuts = np.searchsorted(row, np.arange(n + 1))
    part = factors[column] * value[:, None]
    sums = np.add.reduceat(np.vstack([part, np.zeros((1, part.shape[1]))]), np.minimum(cuts[:-1], len(part)), axis=0)
    squares = np.add.reduceat(np.append((part**2).sum(axis=1), 0.0), np.minimum(cuts[:-1], len(part)))
    line = np.add.reduceat(np.append(linear[column] * value, 0.0), np.minimum(cuts[:-1], len(part)))
    return bias + line + 0.5 * ((sums**2).sum(axis=1) - squares), sums, part


def fit(row, bucket, weight, stats, labels: np.ndarray, epochs: int = 10, batch: int = 64, rate: float = 0.1, decay: float = 1e-5) -> Model:
    """AdaGrad on the logistic loss; classes weigh the same in sum up to a factor of four."""
    rng = np.random.default_rng(7)
    width = BUCKETS + STATS
    center = np.median(stats, axis=0) if len(stats) else np.zeros(STATS)
    scale = np.maximum(stats.std(axis=0), 1e-6) if len(stats) else np.ones(STATS)
    bias, linear, factors = 0.0, np.zeros(width), rng.normal(0, 0.05, (width, FACTORS))
    if not len(labels):
        return Model(0.0, linear, np.zeros_like(factors), center, scale)
    r, c, v = _joined(row, bucket, weight, stats, center, scale)
    cuts = np.searchsorted(r, np.arange(len(labels) + 1))
    bad = max(1, int((labels == 0).sum()))
    worth = np.where(labels == 0, min(4.0, max(1.0, (len(labels) - bad) / bad)), 1.0)
    seen_b, seen_l, seen_f = 1e-8, np.full(width, 1e-8), np.full((width, FACTORS), 1e-8)
    for _ in range(epochs):
        order = rng.permutation(len(labels))
        for low in range(0, len(order), batch):
            mine = np.sort(order[low : low + batch])
            counts = cuts[mine + 1] - cuts[mine]
            at = common.spread(cuts[mine], counts)
            rr = np.repeat(np.arange(len(mine)), counts)
            cc, vv = c[at], v[at]
            raw, sums, part = _forward(rr, cc, vv, len(mine), bias, linear, factors)
            g = (1 / (1 + np.exp(-np.clip(raw, -30, 30))) - labels[mine]) * worth[mine] / len(mine)
            columns, where = np.unique(cc, return_inverse=True)
            gl = np.bincount(where, g[rr] * vv, len(columns)) + decay * linear[columns]
            gf = np.zeros((len(columns), FACTORS))
            np.add.at(gf, where, (g[rr] * vv)[:, None] * (sums[rr] - part))
            gf += decay * factors[columns]
            seen_b += g.sum() ** 2
            seen_l[columns] += gl**2
            seen_f[columns] += gf**2
            bias -= rate * g.sum() / np.sqrt(seen_b)
            linear[columns] -= rate * gl / np.sqrt(seen_l[columns])
            factors[columns] -= rate * gf / np.sqrt(seen_f[columns])
    return Model(float(bias), linear, factors, center, scale)


def score(data: np.ndarray, bounds: np.ndarray, model: Model) -> np.ndarray:
    row, bucket, weight, stats = features(data, bounds)
    r, c, v = _joined(row, bucket, weight, stats, model.center, model.scale)
    raw, _, _ = _forward(r, c, v, len(stats), model.bias, model.linear, model.factors)
    return 1 / (1 + np.exp(-np.clip(raw, -30, 30)))


def _vectors(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in common.slices(batches):
        row, bucket, weight, stats = features(*common.text_bytes(batch.column("text")))
        cuts = pa.array(np.searchsorted(row, np.arange(batch.num_rows + 1)).astype(np.int32))
        yield pa.RecordBatch.from_arrays(
            [
                pa.ListArray.from_arrays(cuts, pa.array(bucket.astype(np.int32))),
                pa.ListArray.from_arrays(cuts, pa.array(weight.astype(np.float32))),
                pa.array(list(stats), pa.list_(pa.float64())),
                batch.column("label"),
            ],
            ["bucket", "weight", "stats", "label"],
        )


def train(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality", sample: int = SAMPLE) -> Model:
    """Fit on the documents of at most ``sample`` labels: ``labels`` has the ids that may be learned from."""
    usable = labels.where(F.col(id_col).isNotNull() & F.col(label_col).isNotNull()).groupBy(F.col(id_col).alias("doc_id"))
    chosen = usable.agg((F.avg(label_col) >= 0.5).cast("int").alias("label")).orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample)
    source = common.keyed(docs, id_col, text_col)
    # of repeated ids the text with the smallest hash, found on narrow rows: ``sample`` texts at most
    one = source.join(F.broadcast(chosen), "doc_id").groupBy("doc_id", "label").agg(F.min("th").alias("th"))
    picked = source.join(F.broadcast(one), ["doc_id", "th"]).select("doc_id", "text", "label")
    first = picked.groupBy("doc_id", "label").agg(F.min("text").alias("text")).select("text", "label")
    schema = "bucket array<int>, weight array<float>, stats array<double>, label int"
    got = first.mapInArrow(_vectors, schema).toArrow().combine_chunks()
    if not got.num_rows:
        return fit(np.zeros(0, int), np.zeros(0, int), np.zeros(0), np.zeros((0, STATS)), np.zeros(0))
    bucket, weight, stats = (got.column(k).combine_chunks() for k in ("bucket", "weight", "stats"))
    sizes = np.diff(bucket.offsets.to_numpy())
    stats = stats.flatten().to_numpy().reshape(-1, STATS)
    answer = got.column("label").to_numpy().astype(float)
    order = np.lexsort((answer, *stats.T))  # the order of rows must not change the model
    starts = np.cumsum(sizes) - sizes
    at = common.spread(starts[order], sizes[order])
    return fit(
        np.repeat(np.arange(len(order)), sizes[order]),
        bucket.flatten().to_numpy()[at].astype(np.int64),
        weight.flatten().to_numpy()[at].astype(float),
        stats[order],
        answer[order],
    )


def _scores(model: Model) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in common.slices(batches):
            values = score(*common.text_bytes(batch.column("text")), model)
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("th"), pa.array(values)], ["doc_id", "th", "score"])

    return run


def scored(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, th, score`` of every row."""
    source = common.keyed(docs, id_col, text_col)
    schema = T.StructType([source.schema["doc_id"], T.StructField("th", T.LongType()), T.StructField("score", T.DoubleType())])
    return source.mapInArrow(_scores(model), schema)


def _marks(model: Model, text_col: str, least: float) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in common.slices(batches, text_col):
            texts = batch.column(text_col)
            texts = texts.fill_null("") if texts.null_count else texts
            yield batch.filter(pa.array(score(*common.text_bytes(texts), model) >= least))

    return run


def keep_good(docs: DataFrame, model: Model, text_col: str = "text", least: float = 0.5) -> DataFrame:
    """The rows scored ``least`` or more, with all their columns."""
    return docs.mapInArrow(_marks(model, text_col, least), docs.schema)
