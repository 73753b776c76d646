"""Jaccard join of 5-word shingle sets by chosen paths.

Texts with one shingle set are one class; only classes are joined. In every repetition a set follows the
tokens whose hash falls below ``1 / (LAM * size)``, so two sets above the threshold share at least
``threshold / LAM`` chosen tokens in expectation. The number of repetitions, the least agreement of sketches and the
splits of small sets follow from the recall asked for (``Plan``). A chosen token is a bucket. Small buckets are compared by brute force on min-hash sketches. A larger one
is split again on sampled tokens of the sketches, each member going on under a few sampled positions, until
its parts are small; what is alike on every level stays together as one candidate group.

Candidates form groups; inside each group the sets are compared exactly, so a link is never guessed and every
link between members is counted, whichever bucket suggested the group. Groups above ``BLOCK`` members are
compared block by block. Only spanning links and counts leave a task, never all pairs.

Words are runs of digits, letters and non-ASCII characters after A-Z are lowered. A text of one to four
words is one shingle. A text without words (null, empty, punctuation) has an empty set: it is in one class
with equal texts and linked to nothing. Null ids are kept; a class is named by its smallest id that is not
null. Rows alike in id and text are copies. Columns besides id and text are not read; an empty table gives
an empty result. A text of any size is used whole.
"""

from __future__ import annotations

import functools
import hashlib
import math
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from hazeline.llm import common
from hazeline.llm.common import U64, stored
from hazeline.llm.components import components

SHINGLE_WORDS = 5
THRESHOLD = 0.8
#: Chance that two sets at the threshold are no candidates: tokens, splits and sketches together, for any size.
MISS = 1e-6
LAM = 0.5
SKETCH = 64
#: Members of a bucket that are compared by brute force; members of a block in the exact comparison.
SMALL, BLOCK = 96, 256
#: Sketch positions sampled in a large bucket, for every level of splitting; small sets may need more.
BRANCHES = (2, 2, 1)
_RNG = np.random.default_rng(612)
_SKETCH_XOR, _SKETCH_MUL, _PATH_XOR, _PATH_MUL = (_RNG.integers(1, 1 << 63, (256, 1), dtype=np.uint64) | U64(1) for _ in range(4))


@dataclass(frozen=True)
class Plan:
    """What keeps the loss of two sets at the threshold below the one asked for."""

    least: int  # equal sketch positions that make a candidate
    repetitions: int
    branches: tuple[tuple[int, tuple[int, ...]], ...]  # (largest size, positions by level), sizes ascending


def _agreeing(threshold: float) -> np.ndarray:
    """Chance of every number of equal positions in the sketches of two sets at the threshold."""
    return np.array([math.comb(SKETCH, k) * threshold**k * (1 - threshold) ** (SKETCH - k) for k in range(SKETCH + 1)])


def _passing(branches: tuple[int, ...]) -> np.ndarray:
    """Chance that a shared token keeps two sets together through all levels, by equal positions of their sketches."""
    equal, out = np.arange(SKETCH + 1) / SKETCH, np.ones(SKETCH + 1)
    for n in reversed(branches):
        out = 1 - (1 - equal * out) ** n
    return out


def loss(threshold: float, size: int, least: int, repetitions: int, branches: tuple[int, ...], shared: float | None = None) -> float:
    """Chance that two sets at the threshold, ``size`` tokens the larger one, are no candidates in crowded buckets.

    Of their shared tokens each is chosen in any repetition or in none, and is one path however often chosen.
    Sketches are the same on all paths.
    """
    shared = math.ceil(threshold * size - 1e-9) if shared is None else shared
    chosen = 1 - (1 - min(1.0, 1 / (LAM * size))) ** repetitions
    chance = _agreeing(threshold)
    return float(chance[:least].sum() + (chance[least:] * (1 - chosen * _passing(branches)[least:]) ** shared).sum())


def planned(threshold: float, miss: float) -> Plan:
    """The fewest repetitions for all but small sets, and the positions that those need."""
    least = int(np.searchsorted(np.cumsum(_agreeing(threshold)), miss / 2, side="right"))

    def enough(few: int, repetitions: int) -> bool:  # the chance falls with the size, but for rounding up shared tokens
        return all(loss(threshold, few << k, least, repetitions, BRANCHES, threshold * (few << k)) <= miss for k in range(0, 24, 4))

    few, high = 64, 1
    while not enough(few, high):
        high *= 2
        if high > 1 << 12:  # with few tokens all are chosen soon
            few, high = few * 4, 1
        if few > 1 << 14:
            raise ValueError(f"a miss of {miss:g} at a threshold of {threshold:g} can't be reached")
    low = high // 2
    while high - low > 1:
        middle = (low + high) // 2
        low, high = (low, middle) if enough(few, middle) else (middle, high)
    now, found = BRANCHES, []
    for size in range(few - 1, 1, -1):
        if math.ceil(threshold * size - 1e-9) >= size:
            break  # no other set can reach the threshold
        while loss(threshold, size, least, high, now) > miss:
            more = [tuple(n + (k == level) for k, n in enumerate(now)) for level in range(len(now))]
            now = min(more, key=lambda b: loss(threshold, size, least, high, b))
            if math.prod(now) > 1 << 15:
                raise ValueError(f"a miss of {miss:g} at a threshold of {threshold:g} can't be reached for sets of {size}")
        if now != BRANCHES and (not found or found[-1][1] != now):
            found.append((size, now))
    return Plan(least, high, tuple(reversed(found)))


def shingle_sets(data: np.ndarray, bounds: np.ndarray, n: int = SHINGLE_WORDS) -> list[np.ndarray]:
    """Sorted different shingle hashes of each row."""
    hashes, firsts, _ = common.words(data, bounds)
    values = common.grams(hashes, n)
    out = []
    for a, b in zip(firsts[:-1], firsts[1:], strict=True):
        if b - a >= n:
            out.append(np.unique(values[a : b - n + 1]))
        elif b > a:
            out.append(common.grams(hashes[a:b], int(b - a)))
        else:
            out.append(np.zeros(0, np.uint64))
    return out


def _least(tokens: np.ndarray) -> np.ndarray:
    """Min-hash of the tokens under each of the sketch's hash functions, 16 bits each."""
    best = np.full(SKETCH, np.iinfo(np.uint64).max, np.uint64)
    for part in range(0, len(tokens), 4096):
        some = tokens[part : part + 4096]
        best = np.minimum(best, ((some ^ _SKETCH_XOR[:SKETCH]) * _SKETCH_MUL[:SKETCH]).min(axis=1))
    return (common.mixed(best) >> U64(48)).astype("<u2")


@functools.cache
def _path_functions(repetitions: int) -> tuple[np.ndarray, np.ndarray]:
    """Factors of the hash functions, one of each for every repetition."""
    more = np.random.default_rng(613).integers(1, 1 << 63, (max(0, repetitions - len(_PATH_XOR)), 2), dtype=np.uint64) | U64(1)
    return tuple(np.concatenate([known, more[:, k : k + 1]])[:repetitions] for k, known in enumerate((_PATH_XOR, _PATH_MUL)))


def _chosen(tokens: np.ndarray, repetitions: int) -> np.ndarray:
    """Tokens chosen in any of the repetitions."""
    xor, mul = _path_functions(repetitions)
    width = max(1, min(4096, (1 << 20) // repetitions))
    limit = U64(min((1 << 64) - 1, int((1 << 64) / (LAM * len(tokens)))))
    out = []
    for part in range(0, len(tokens), width):
        some = tokens[part : part + width]
        out.append(some[(((some ^ xor) * mul) <= limit).any(axis=0)])
    return np.concatenate(out)


def _sets(repetitions: int) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in common.slices(batches):
            data, bounds = common.text_bytes(batch.column("text"))
            sid, size, sketch, nodes = [], [], [], []
            for row, tokens in enumerate(shingle_sets(data, bounds)):
                size.append(len(tokens))
                if len(tokens):
                    sid.append(hashlib.blake2b(tokens.tobytes(), digest_size=16).digest())
                    sketch.append(_least(tokens).tobytes())
                    nodes.append(_chosen(tokens, repetitions).view(np.int64))
                else:
                    raw = data[bounds[row] : bounds[row + 1]].tobytes()
                    sid.append(hashlib.blake2b(raw, digest_size=16, person=b"no words").digest())
                    sketch.append(b"")
                    nodes.append(np.zeros(0, np.int64))
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id"),
                    batch.column("th"),
                    pa.array(sid, pa.binary()),
                    pa.array(size, pa.int32()),
                    pa.array(sketch, pa.binary()),
                    pa.array(nodes, pa.list_(pa.int64())),
                ],
                ["doc_id", "th", "sid", "size", "sketch", "nodes"],
            )

    return run


def _roots(linked: np.ndarray) -> np.ndarray:
    """Smallest member each member is connected to, from a symmetric matrix of links."""
    root = np.arange(len(linked))
    linked = linked | np.eye(len(linked), dtype=bool)
    while True:
        near = np.where(linked, root[None, :], len(root)).min(axis=1)
        near = near[near]
        if (near == root).all():
            return root
        root = near


def _by_key(batches: Iterator[pa.RecordBatch], keys: list[str]) -> Iterator[pa.RecordBatch]:
    """Runs of rows with equal keys, out of sorted batches."""
    held, last = [], None
    for batch in batches:
        if not batch.num_rows:
            continue
        columns = [batch.column(k) for k in keys]
        new = np.zeros(batch.num_rows, bool)
        for c in columns:
            values = np.array(c.to_pylist(), object) if pa.types.is_binary(c.type) else c.to_numpy(zero_copy_only=False)
            new[1:] |= values[1:] != values[:-1]
        edges = np.append(np.flatnonzero(new), batch.num_rows)
        first = tuple(c[0].as_py() for c in columns)
        if held and first != last:
            yield pa.Table.from_batches(held).combine_chunks().to_batches()[0]
            held = []
        a = 0
        for b in edges[:-1]:
            held.append(batch.slice(a, b - a))
            yield pa.Table.from_batches(held).combine_chunks().to_batches()[0]
            held, a = [], b
        held.append(batch.slice(a))
        last = tuple(c[-1].as_py() for c in columns)
    if held:
        yield pa.Table.from_batches(held).combine_chunks().to_batches()[0]


def _alike(least: int) -> Callable:
    """Edges from each member of a small bucket to the first member its sketch is connected to."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        a, b = [], []
        for group in _by_key(batches, ["node"]):
            if group.num_rows < 2:
                continue
            ids = group.column("sid").to_pylist()
            sketches = np.frombuffer(b"".join(group.column("sketch").to_pylist()), "<u2").reshape(-1, SKETCH)
            linked = (sketches[:, None, :] == sketches[None, :, :]).sum(axis=2) >= least
            for k, r in enumerate(_roots(linked)):
                if k != r:
                    a.append(ids[k])
                    b.append(ids[r])
            if len(a) > 20000:
                yield pa.RecordBatch.from_arrays([pa.array(a, pa.binary()), pa.array(b, pa.binary())], ["a", "b"])
                a, b = [], []
        yield pa.RecordBatch.from_arrays([pa.array(a, pa.binary()), pa.array(b, pa.binary())], ["a", "b"])

    return run


def candidate_edges(sets: DataFrame, plan: Plan) -> DataFrame:
    """Edges ``a, b`` that connect all candidates; as many as bucket members at most."""
    edge = T.StructType([T.StructField("a", T.BinaryType()), T.StructField("b", T.BinaryType())])
    sketches = sets.select("sid", "sketch")
    # two sets share the positions of the larger one: smaller sets have as many or more
    members = sets.select("sid", "size", F.explode("nodes").alias("node"))
    found = []
    for level in range(len(BRANCHES) + 1):
        # stored, so that Spark can split the share of a hot bucket in the joins
        sizes = stored(members.groupBy("node").agg(F.count("*").alias("n"), F.min("sid").alias("b")).where("n > 1"), f"sizes-{level}")
        small = members.join(sizes.where(F.col("n") <= SMALL).select("node"), "node", "left_semi")
        crowded = sizes.where(F.col("n") > SMALL)
        if level == len(BRANCHES):
            found.append(members.join(crowded, "node").select(F.col("sid").alias("a"), "b").where("a <> b"))
        large = members.join(crowded.select("node"), "node", "left_semi")
        if level == 0:
            small, large = (x.join(sketches, "sid") for x in (small, large))
        found.append(small.select("node", "sid", "sketch").repartition("node").sortWithinPartitions("node").mapInArrow(_alike(plan.least), edge))
        if level == len(BRANCHES):
            break
        positions = F.lit(BRANCHES[level])
        for most, branches in reversed(plan.branches):
            positions = F.when(F.col("size") <= most, branches[level]).otherwise(positions)
        parts = large.select("sid", "size", "sketch", "node", F.explode(F.sequence(F.lit(0), positions - 1)).alias("j"))
        position = f"2 * pmod(xxhash64(node, j), {SKETCH}) + 1"
        child = F.expr(f"xxhash64(node, j, substring(sketch, cast({position} as int), 2))").alias("node")
        members = stored(parts.select("sid", "size", "sketch", child).distinct(), f"paths-{level}")
    out = found[0]
    for more in found[1:]:
        out = out.unionByName(more)
    return out.distinct()


def intersections(sets: list[np.ndarray], others: list[np.ndarray] | None = None) -> np.ndarray:
    """Sizes of the intersections of all sets with all others, over blocks of the shared vocabulary."""
    every = sets + (others or [])
    sizes = [len(s) for s in every]
    _, token, times = np.unique(np.concatenate(every), return_inverse=True, return_counts=True)
    owner = np.repeat(np.arange(len(every)), sizes)
    rank = np.cumsum(times > 1) - 1
    shared = times[token] > 1
    token, owner = rank[token[shared]], owner[shared]
    n, m = len(sets), len(others) if others else len(sets)
    out = np.zeros((n, m), np.float32)
    order = np.argsort(token, kind="stable")
    token, owner = token[order], owner[order]
    width = 4096
    for low in range(0, int(token[-1]) + 1 if len(token) else 0, width):
        a, b = np.searchsorted(token, [low, low + width])
        dense = np.zeros((len(every), width), np.float32)
        dense[owner[a:b], token[a:b] - low] = 1
        out += dense[:n] @ (dense[n:] if others else dense[:n]).T
    out = out.astype(np.int64)
    if not others:
        out[np.arange(n), np.arange(n)] = sizes
    return out


def _packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Texts compressed one by one: they are shuffled twice, and Spark's own codec sees only small blocks."""
    codec = zstandard.ZstdCompressor(level=3)
    for batch in common.slices(batches):
        data, bounds = common.text_bytes(batch.column("text"))
        raw = memoryview(np.ascontiguousarray(data))
        packed = [codec.compress(raw[a:b]) for a, b in zip(bounds[:-1], bounds[1:], strict=True)]
        yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("th"), pa.array(packed, pa.binary())], ["doc_id", "th", "packed"])


def _unpacked(packed: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All bytes of compressed texts, and where each starts (one more entry for the end)."""
    codec = zstandard.ZstdDecompressor()
    texts = [codec.decompress(p.as_buffer()) for p in packed]
    return np.frombuffer(b"".join(texts), np.uint8), np.cumsum([0, *map(len, texts)])


def _exact(threshold: float) -> Callable:
    """Links of every member inside one comparison of blocks, and the first member it is connected to."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for group in _by_key(batches, ["cid", "low", "high"]):
            ids = group.column("sid").to_pylist()
            firsts = [k for k, sid in enumerate(ids) if k == 0 or ids[k - 1] != sid]
            group = group.take(pa.array(firsts))
            ids = [ids[k] for k in firsts]
            blocks = group.column("block").to_numpy()
            tokens = shingle_sets(*_unpacked(group.column("packed")))
            sizes = np.array([len(t) for t in tokens])
            shared = intersections(tokens)
            linked = shared >= threshold * (sizes[:, None] + sizes[None, :] - shared) - 1e-9
            if group.column("low")[0].as_py() != group.column("high")[0].as_py():
                linked &= blocks[:, None] != blocks[None, :]
            np.fill_diagonal(linked, False)
            roots = _roots(linked)
            yield pa.RecordBatch.from_arrays(
                [pa.array(ids, pa.binary()), pa.array([ids[r] for r in roots], pa.binary()), pa.array(linked.sum(axis=1))], ["sid", "root", "links"]
            )

    return run


def similarity_classes(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", threshold: float = THRESHOLD, miss: float = MISS) -> DataFrame:
    """One row per document: ``doc_id, th, class_id, n_links, n_copies, set_size, first``.

    ``class_id``: smallest id among all documents connected by links. ``n_links``: other shingle sets at or
    above the threshold. ``n_copies``: documents with the same set. ``first``: the row is one of the class's
    smallest (id, hash of text).
    """
    source = common.keyed(docs, id_col, text_col)
    id_type = source.schema["doc_id"].dataType
    plan = planned(threshold, miss)
    schema = T.StructType(
        [
            T.StructField("doc_id", id_type),
            T.StructField("th", T.LongType()),
            T.StructField("sid", T.BinaryType()),
            T.StructField("size", T.IntegerType()),
            T.StructField("sketch", T.BinaryType()),
            T.StructField("nodes", T.ArrayType(T.LongType())),
        ]
    )
    rows = stored(source.mapInArrow(_sets(plan.repetitions), schema), "shingle-sets")
    order = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "th")
    sets = stored(
        rows.groupBy("sid").agg(
            F.min(order).alias("least"),
            F.count("*").alias("n_copies"),
            F.first("size").alias("size"),
            F.first("sketch").alias("sketch"),
            F.first("nodes").alias("nodes"),
        ),
        "classes",
    )
    groups = components(candidate_edges(sets, plan)).select(F.col("node").alias("sid"), F.col("root").alias("cid"))
    sizes = groups.groupBy("cid").agg(F.ceil(F.count("*") / BLOCK).cast("int").alias("blocks"))
    asked = (
        groups.join(sizes, "cid")
        .join(sets.select("sid", F.col("least.doc_id").alias("doc_id"), F.col("least.th").alias("th")), "sid")
        .withColumn("block", F.expr("cast(pmod(xxhash64(sid), blocks) as int)"))
    )
    packed = source.mapInArrow(_packed, T.StructType([*schema.fields[:2], T.StructField("packed", T.BinaryType())]))
    texts = packed.alias("s").join(asked.alias("a"), F.expr("s.doc_id <=> a.doc_id AND s.th = a.th")).select("a.sid", "a.cid", "a.block", "a.blocks", "s.packed")
    facing = texts.select("sid", "cid", "block", "packed", F.explode(F.expr("sequence(0, blocks - 1)")).alias("other"))
    facing = facing.select("sid", "cid", "block", "packed", F.least("block", "other").alias("low"), F.greatest("block", "other").alias("high"))
    links = T.StructType([T.StructField("sid", T.BinaryType()), T.StructField("root", T.BinaryType()), T.StructField("links", T.LongType())])
    verified = stored(
        facing.repartition("cid", "low", "high").sortWithinPartitions("cid", "low", "high", "sid").mapInArrow(_exact(threshold), links), "links"
    )
    classes = components(verified.where("sid <> root").select(F.col("sid").alias("a"), F.col("root").alias("b")))
    counts = verified.groupBy("sid").agg(F.sum("links").alias("n_links"))
    known = sets.select("sid", "least", "n_copies").join(counts, "sid", "left").join(classes.withColumnRenamed("node", "sid"), "sid", "left")
    known = known.withColumn("root", F.coalesce("root", "sid"))
    heads = known.groupBy("root").agg(F.min("least").alias("head"))
    known = known.join(heads, "root").select("sid", "head", "n_copies", F.coalesce("n_links", F.lit(0)).alias("n_links"))
    return rows.select("doc_id", "th", "sid", "size").join(known, "sid").select(
        "doc_id",
        "th",
        F.col("head.doc_id").alias("class_id"),
        "n_links",
        "n_copies",
        F.col("size").alias("set_size"),
        (F.col("doc_id").eqNullSafe(F.col("head.doc_id")) & (F.col("th") == F.col("head.th"))).alias("first"),
    )


def keep_one_of_each(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """The row of every class with the smallest id, with all its columns; one of rows alike in id and text."""
    kept = similarity_classes(docs, id_col, text_col, **options).where("first").select(F.col("doc_id").alias("_hz_id"), F.col("th").alias("_hz_th")).distinct()
    out = docs.withColumn("_hz_hash", F.xxhash64(F.coalesce(docs[text_col].cast("string"), F.lit(""))))
    chosen = out.join(kept, out[id_col].eqNullSafe(kept["_hz_id"]) & (out["_hz_hash"] == kept["_hz_th"]), "left_semi")
    one = Window.partitionBy("_hz_hash", id_col).orderBy(text_col)
    return chosen.withColumn("_hz_n", F.row_number().over(one)).where("_hz_n = 1").drop("_hz_n", "_hz_hash")
