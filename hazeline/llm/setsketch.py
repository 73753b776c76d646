"""Near copies of documents by SetSketch registers.

Every shingle draws one exponential value for each of the registers; a register holds ``floor(1 - log_BASE(smallest value))``,
cut to 0 to ``TOP``. Registers of a union are the larger ones of both, so sketches merge. Two registers are equal with about
the Jaccard similarity of the sets, so bands of them are buckets: two sets at the threshold meet in one of ``BANDS`` but for
a chance of 4e-7.

In a bucket pairs are judged by likelihood: of the similarities that the set sizes allow, how well do they explain how many
registers are larger, smaller and equal. A pair falls if some similarity below the threshold is ``DOUBT`` times (as a
logarithm) likelier than the threshold itself, which happens to a pair at it with a chance of 5e-7. What remains forms candidate
groups, and the sets in a group are compared in full, in whole numbers, block by block; only spanning links leave a task.

A bucket above ``SMALL`` members whose members all pass against its first one is a candidate group as it is. Others are cut
by further registers, several ways, and what is still large is a candidate group as well: a link is never lost to size.

Words are runs of characters other than space, tab and line ends, after A-Z are lowered; fewer than three are one shingle. A
text without words (null, empty, blank) has an empty set and is linked with nothing, not even its equals. Texts with one
set are one member. Null ids are kept; a component is named by its smallest id that is not null. Rows alike in id and text give
as many result rows. Columns besides id and text are not read; an empty table gives an empty result; texts are used whole.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from hazeline.llm import common, jaccard_join
from hazeline.llm.common import U64, stored
from hazeline.llm.components import components

SHINGLE_WORDS = 3
#: Similarity of linked sets, in hundredths.
PERCENT = 85
#: Registers of a band, and bands; the registers of a sketch are their product.
ROWS, BANDS = 5, 25
REGISTERS = ROWS * BANDS
#: Base of the registers' scale, rate of the exponential values, and largest register.
BASE, RATE, TOP = 1.001, 20.0, (1 << 16) - 1
#: Log-likelihood ratio that rules a pair out.
DOUBT = 12.0
#: Members of a bucket that are judged pair by pair; members of a block in the full comparison.
SMALL, BLOCK = 96, 256
#: Ways in which a large mixed bucket is cut, and registers that cut it.
WAYS, CUT = 4, 3
_XOR, _MUL = np.random.default_rng(1107).integers(1, 1 << 63, (2, REGISTERS, 1), dtype=np.uint64) | U64(1)
_CUTS = np.random.default_rng(1108).integers(0, REGISTERS, (BANDS, WAYS, CUT))


def shingle_sets(data: np.ndarray, bounds: np.ndarray) -> list[np.ndarray]:
    """Sorted different shingle hashes of each row."""
    hashes, firsts, _ = common.words(data, bounds, common.SPACED)
    values = common.grams(hashes, SHINGLE_WORDS)
    out = []
    for a, b in zip(firsts[:-1], firsts[1:], strict=True):
        if b - a >= SHINGLE_WORDS:
            out.append(np.unique(values[a : b - SHINGLE_WORDS + 1]))
        else:
            out.append(common.grams(hashes[a:b], int(b - a)) if b > a else np.zeros(0, np.uint64))
    return out


def registers(tokens: np.ndarray) -> np.ndarray:
    """The sketch of one set."""
    least = np.full(REGISTERS, np.iinfo(np.uint64).max, np.uint64)
    for part in range(0, len(tokens), 2048):
        least = np.minimum(least, ((tokens[part : part + 2048] ^ _XOR) * _MUL).min(axis=1))
    smallest = -np.log1p(-(least.astype(np.float64) + 0.5) / 2.0**64) / RATE
    return np.clip(np.floor(1 - np.log(smallest) / np.log(BASE)), 0, TOP).astype("<u2")


def merged(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """The sketch of the union of two sets."""
    return np.maximum(a, b)


def _log_likelihood(similarity: np.ndarray, share: np.ndarray, more: np.ndarray, less: np.ndarray) -> np.ndarray:
    """Of a similarity, given the first set's share of both sizes and how many of its registers are larger and smaller."""
    factor = (BASE - 1) / BASE

    def beyond(x: np.ndarray) -> np.ndarray:
        return np.maximum(-np.log1p(-np.clip(x, 0, 1) * factor) / np.log(BASE), 1e-12)

    p, q = beyond(share - (1 - share) * similarity), beyond((1 - share) - share * similarity)
    return more * np.log(p) + less * np.log(q) + (REGISTERS - more - less) * np.log(np.maximum(1 - p - q, 1e-12))


def estimated(size_a: np.ndarray, size_b: np.ndarray, more: np.ndarray, less: np.ndarray) -> np.ndarray:
    """The likeliest similarity of two sets, to a hundredth."""
    share = size_a / (size_a + size_b)
    most = np.minimum(size_a, size_b) / np.maximum(size_a, size_b)
    grid = np.linspace(0, 1, 101)[:, None] * most[None, :]
    return grid[np.argmax(_log_likelihood(grid, share, more, less), axis=0), np.arange(len(most))]


def likely(size_a: np.ndarray, size_b: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Whether pairs of sketches, row by row, may come from sets at the threshold or above."""
    out = 100 * np.minimum(size_a, size_b) >= PERCENT * np.maximum(size_a, size_b)
    at = np.flatnonzero(out)
    if not len(at):
        return out
    more, less = (a[at] > b[at]).sum(axis=1), (a[at] < b[at]).sum(axis=1)
    share = size_a[at] / (size_a[at] + size_b[at])
    goal = _log_likelihood(np.full(len(at), PERCENT / 100), share, more, less)
    best = np.max([_log_likelihood(np.full(len(at), s), share, more, less) for s in np.linspace(0.02, PERCENT / 100, 42)], axis=0)
    out[at] = best - goal <= DOUBT
    return out


def _sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in common.slices(batches):
        data, bounds = common.text_bytes(batch.column("text"))
        tokens = shingle_sets(data, bounds)
        yield pa.RecordBatch.from_arrays(
            [
                batch.column("doc_id"),
                batch.column("th"),
                pa.array([hashlib.blake2b(t.tobytes(), digest_size=16).digest() if len(t) else None for t in tokens], pa.binary()),
                pa.array([len(t) for t in tokens], pa.int64()),
                pa.array([registers(t).tobytes() if len(t) else None for t in tokens], pa.binary()),
            ],
            ["doc_id", "th", "sid", "size", "sketch"],
        )


def _edges(a: list[bytes], b: list[bytes]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(a, pa.binary()), pa.array(b, pa.binary())], ["a", "b"])


def _sketches(column: pa.Array) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), "<u2").reshape(-1, REGISTERS)


def _alike(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Edges from each member of a small bucket to the first one that its likely pairs connect it to."""
    a, b = [], []
    for group in jaccard_join._by_key(batches, ["node"]):
        n = group.num_rows
        if n < 2:
            continue
        ids, size, sketch = group.column("sid").to_pylist(), group.column("size").to_numpy(), _sketches(group.column("sketch"))
        x, y = np.triu_indices(n, 1)
        linked = np.zeros((n, n), bool)
        linked[x, y] = linked[y, x] = likely(size[x], size[y], sketch[x], sketch[y])
        for k, r in enumerate(jaccard_join._roots(linked)):
            if k != r:
                a.append(ids[k])
                b.append(ids[r])
        if len(a) > 20000:
            yield _edges(a, b)
            a, b = [], []
    yield _edges(a, b)


def _against_first(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Whether each member of a large bucket passes against its first one."""
    for batch in batches:
        ok = np.zeros(0, bool)
        if batch.num_rows:
            sizes = batch.column("size").to_numpy(), batch.column("first_size").to_numpy()
            ok = likely(*sizes, _sketches(batch.column("sketch")), _sketches(batch.column("first_sketch")))
        yield pa.RecordBatch.from_arrays([batch.column("node"), pa.array(ok)], ["node", "passes"])


def candidate_edges(sets: DataFrame) -> DataFrame:
    """Edges ``a, b`` that connect all candidates among ``sid, size, sketch``; as many as bucket members at most."""
    edge = T.StructType([T.StructField("a", T.BinaryType()), T.StructField("b", T.BinaryType())])

    def pieces(places) -> str:
        return ", ".join(f"substring(sketch, {2 * int(p) + 1}, 2)" for p in places)

    bands = ", ".join(f"xxhash64({k}, substring(sketch, {2 * ROWS * k + 1}, {2 * ROWS}))" for k in range(BANDS))
    members = sets.select("sid", F.posexplode(F.expr(f"array({bands})")).alias("band", "node"))
    found = []
    for level in range(2):
        counts = stored(members.groupBy("node").agg(F.count("*").alias("n"), F.min("sid").alias("first")).where("n > 1"), f"buckets-{level}")
        small = members.join(counts.where(F.col("n") <= SMALL).select("node"), "node", "left_semi").join(sets, "sid")
        found.append(small.select("node", "sid", "size", "sketch").repartition("node").sortWithinPartitions("node", "sid").mapInArrow(_alike, edge))
        large = members.join(counts.where(F.col("n") > SMALL).select("node", "first"), "node")
        if level:
            found.append(large.select(F.col("sid").alias("a"), F.col("first").alias("b")).where("a <> b"))
            break
        heads = counts.where(F.col("n") > SMALL).select("first").distinct()
        heads = heads.join(sets, F.col("first") == F.col("sid")).select("first", F.col("size").alias("first_size"), F.col("sketch").alias("first_sketch"))
        large = stored(large.join(sets, "sid"), "large")
        judged = large.join(heads, "first").select("node", "size", "sketch", "first_size", "first_sketch")
        verdicts = judged.mapInArrow(_against_first, "node long, passes boolean")
        mixed = stored(verdicts.groupBy("node").agg(F.min("passes").alias("even")).where("NOT even").select("node"), "mixed")
        found.append(large.join(mixed, "node", "left_anti").select(F.col("sid").alias("a"), F.col("first").alias("b")).where("a <> b"))
        cut = large.join(mixed, "node", "left_semi")
        keys = ", ".join(
            "array(" + ", ".join(f"xxhash64(node, {w}, concat({pieces(_CUTS[k, w])}))" for w in range(WAYS)) + ")" for k in range(BANDS)
        )
        members = stored(cut.select("sid", "band", F.explode(F.expr(f"element_at(array({keys}), band + 1)")).alias("node")), "cut")
    out = found[0]
    for more in found[1:]:
        out = out.unionByName(more)
    return out.distinct()


def _confirmed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Links between the sets of two blocks: each member with the first one it is connected to."""
    for group in jaccard_join._by_key(batches, ["cid", "low", "high"]):
        ids, blocks = group.column("sid").to_pylist(), group.column("block").to_numpy()
        tokens = shingle_sets(*jaccard_join._unpacked(group.column("packed")))
        sizes, shared = np.array([len(t) for t in tokens]), jaccard_join.intersections(tokens)
        linked = 100 * shared >= PERCENT * (sizes[:, None] + sizes[None, :] - shared)
        if group.column("low")[0].as_py() != group.column("high")[0].as_py():
            linked &= blocks[:, None] != blocks[None, :]
        roots = jaccard_join._roots(linked)
        at = np.flatnonzero(roots != np.arange(len(ids)))
        yield _edges([ids[k] for k in at], [ids[roots[k]] for k in at])


def near_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: ``doc_id, th, set_size, sketch, component_id, kept``.

    ``component_id``: the smallest id among all documents connected by links; ``kept``: it is the document's own.
    """
    source = common.keyed(docs, id_col, text_col)
    head = [T.StructField("doc_id", source.schema["doc_id"].dataType), T.StructField("th", T.LongType())]
    more = [T.StructField("sid", T.BinaryType()), T.StructField("size", T.LongType()), T.StructField("sketch", T.BinaryType())]
    rows = stored(source.mapInArrow(_sets, T.StructType([*head, *more])), "sketches")
    order = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "th")
    sets = rows.where("sid IS NOT NULL").groupBy("sid").agg(F.min(order).alias("least"), F.first("size").alias("size"), F.first("sketch").alias("sketch"))
    sets = stored(sets, "sets")
    groups = components(candidate_edges(sets.select("sid", "size", "sketch"))).select(F.col("node").alias("sid"), F.col("root").alias("cid"))
    sizes = groups.groupBy("cid").agg(F.ceil(F.count("*") / BLOCK).cast("int").alias("blocks"))
    asked = groups.join(sizes, "cid").join(sets.select("sid", "least.doc_id", "least.th"), "sid")
    asked = stored(asked.withColumn("block", F.expr("cast(pmod(xxhash64(sid), blocks) AS int)")), "asked")
    # one text for every set, whatever the number of rows alike in id and text
    wanted = source.alias("s").join(asked.select("doc_id", "th").alias("a"), F.expr("s.doc_id <=> a.doc_id AND s.th = a.th"), "left_semi")
    texts = wanted.mapInArrow(jaccard_join._packed, T.StructType([*head, T.StructField("packed", T.BinaryType())]))
    texts = texts.groupBy("doc_id", "th").agg(F.first("packed").alias("packed"))
    texts = texts.alias("t").join(asked.alias("a"), F.expr("t.doc_id <=> a.doc_id AND t.th = a.th")).select("a.sid", "a.cid", "a.block", "a.blocks", "t.packed")
    facing = texts.select("sid", "cid", "block", "packed", F.explode(F.expr("sequence(0, blocks - 1)")).alias("other"))
    facing = facing.select("sid", "cid", "block", "packed", F.least("block", "other").alias("low"), F.greatest("block", "other").alias("high"))
    links = facing.repartition("cid", "low", "high").sortWithinPartitions("cid", "low", "high", "sid").mapInArrow(_confirmed, "a binary, b binary")
    found = components(stored(links, "links")).withColumnRenamed("node", "sid")
    known = sets.select("sid", "least").join(found, "sid", "left").withColumn("root", F.coalesce("root", "sid"))
    named = known.groupBy("root").agg(F.min("least").alias("least"))
    known = known.select("sid", "root").join(named, "root").select("sid", F.col("least.doc_id").alias("component_id"))
    out = rows.where("sid IS NOT NULL").join(known, "sid")
    alone = rows.where("sid IS NULL").withColumn("component_id", F.col("doc_id"))
    out = out.unionByName(alone)
    return out.select("doc_id", "th", F.col("size").alias("set_size"), "sketch", "component_id", F.col("doc_id").eqNullSafe(F.col("component_id")).alias("kept"))
