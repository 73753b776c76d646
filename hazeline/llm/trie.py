"""Trie of conversations by whole-sequence collapse.

Identical conversations become one weighted sequence, with the list of those that end there; the turns of one
of them are kept. A sequence that is a proper prefix of another falls to an anti join; the rest are the leaves.
Prefixes of the sequences, weighted, are added up to nodes. A prefix is known by its depth and two 64-bit sums (exclusive or)
of hashes of place, role and text, so it takes no walk from turn to turn.

A node is owned by the sequence with its smallest member; a sequence that owns a node owns all its own nodes below. So what
a subtree saves is all that its sequences own, less what the owner of its top owns above it.

Places and sums along one conversation are made over slices of a range partitioning and shifted by the slices before,
so a conversation of any length is spread over tasks. Lookups of hot nodes are plain joins that Spark splits.

Ids are whole numbers; rows with a null id belong to no conversation. A null role or text is empty. Turns go by
number, null first, and those of one number by role and text; repeated rows are turns of their own. An empty table gives no
nodes, not even a root. Other columns are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from hazeline.llm.common import stored

#: Width of the id ranges in which end lists are put together; a range holds as many ids at most.
END_RANGE = 1024
KEY = ["depth", "p1", "p2"]


def running(rows: DataFrame, key: str, order: list[Column], values: dict[str, tuple[str, str]]) -> DataFrame:
    """The rows with, for every name, the sum or exclusive or (``("sum" | "xor", column)``) over earlier rows of their key."""
    tie = F.monotonically_increasing_id()  # equal rows of one key can lie in several slices
    cut = rows.withColumn("_tie", tie).repartitionByRange(F.col(key), *order, F.col("_tie"))
    cut = stored(cut.withColumn("_slice", F.spark_partition_id()), "slices")
    fold = {"sum": F.sum, "xor": F.bit_xor}
    inside = Window.partitionBy("_slice", key).orderBy(*order, "_tie").rowsBetween(Window.unboundedPreceding, -1)
    ahead = Window.partitionBy(key).orderBy("_slice").rowsBetween(Window.unboundedPreceding, -1)
    sizes = cut.groupBy("_slice", key).agg(*(fold[f](c).alias(n) for n, (f, c) in values.items()))
    shifts = sizes.select("_slice", key, *(F.coalesce(fold[f](n).over(ahead), F.lit(0)).alias(f"_{n}") for n, (f, _) in values.items()))
    local = cut.select("*", *(F.coalesce(fold[f](c).over(inside), F.lit(0)).alias(n) for n, (f, c) in values.items()))
    whole = {n: F.col(n) + F.col(f"_{n}") if f == "sum" else F.col(n).bitwiseXOR(F.col(f"_{n}")) for n, (f, _) in values.items()}
    kept = [c for c in rows.columns if c not in values]
    return local.join(shifts, ["_slice", key]).select(*kept, *(c.alias(n) for n, c in whole.items()))


def placed(conversations: DataFrame, id_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text") -> DataFrame:
    """``conv_id, place`` (from 1), two hashes of role and text ``t1, t2`` and the number of ``words`` of every turn."""
    text = [F.coalesce(F.col(c).cast("string"), F.lit("")) for c in (role_col, text_col)]
    rows = conversations.select(
        F.col(id_col).cast("long").alias("conv_id"), F.col(turn_col).alias("turn"), text[0].alias("role"), text[1].alias("text"), F.lit(1).cast("long").alias("one")
    ).where("conv_id IS NOT NULL")
    order = [F.col("turn").asc_nulls_first(), F.col("role"), F.col("text")]
    return running(rows, "conv_id", order, {"before": ("sum", "one")}).select(
        "conv_id",
        (F.col("before") + 1).alias("place"),
        F.xxhash64(F.lit(1), "role", "text").alias("t1"),
        F.xxhash64(F.lit(2), "role", "text").alias("t2"),
        F.regexp_count("text", F.lit(r"[^\x20\x09-\x0D]+")).cast("long").alias("words"),
    )


def rebuilt(turns: DataFrame) -> tuple[DataFrame, DataFrame]:
    """All ids (``conv_id``), and the turns after the first h of every conversation c come from conversation c - c % 20.

    h is the checksum of the decimal id modulo 4.
    """
    head = F.crc32(F.encode(F.col("conv_id").cast("string"), "UTF-8")) % 4
    sizes = turns.groupBy("conv_id").agg(F.count("*").alias("n"))
    convs = sizes.select("conv_id", (F.col("conv_id") - F.col("conv_id") % 20).alias("base"), head.alias("h"))
    bases = sizes.where("conv_id % 20 = 0").select(F.col("conv_id").alias("base"), "n")
    convs = stored(convs.join(bases, "base", "left").withColumn("taken", F.least("h", F.coalesce("n", F.lit(0)))), "conversations")
    own = turns.join(convs.select("conv_id", "h", "taken"), "conv_id").where("place > h").withColumn("place", F.expr("place - h + taken"))
    first = turns.where("place <= 3 AND conv_id % 20 = 0").withColumnRenamed("conv_id", "base")
    borrowed = first.join(convs.where("taken > 0").select("conv_id", "base", "taken"), "base").where("place <= taken")
    names = ["conv_id", "place", "t1", "t2", "words"]
    return convs.select("conv_id"), own.select(*names).unionByName(borrowed.select(*names))


def _digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One digest a sequence, out of sorted parts of its list."""
    last, digest = None, None

    def told(key: tuple, digest) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([*(pa.array([k], pa.int64()) for k in key), pa.array([digest.hexdigest()])], [*KEY, "ends_sha256"])

    for batch in batches:
        for *key, part in zip(*(batch.column(c).to_pylist() for c in (*KEY, "part")), strict=True):
            if key == last:
                digest.update(b"," + part.encode())
                continue
            if last is not None:
                yield told(last, digest)
            last, digest = key, hashlib.sha256(part.encode())
    if last is not None:
        yield told(last, digest)


def prefix_trie(convs: DataFrame, turns: DataFrame) -> DataFrame:
    """One row per node: ``conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256``.

    ``convs``: every ``conv_id``, once, also those without turns. ``turns``: ``conv_id, place`` (from 1, without gaps), ``t1, t2, words``.
    """
    hashed = turns.select(
        "conv_id",
        F.col("place").cast("long").alias("depth"),
        F.xxhash64("t1", "place").alias("a1"),
        F.xxhash64("t2", "place").alias("a2"),
        "words",
    )
    steps = running(hashed, "conv_id", [F.col("depth")], {"q1": ("xor", "a1"), "q2": ("xor", "a2")})
    steps = stored(steps.select("conv_id", "depth", F.expr("q1 ^ a1").alias("p1"), F.expr("q2 ^ a2").alias("p2"), "q1", "q2", "words"), "turns")
    # whole sequences: the key of the last turn, which is the deepest
    last = steps.groupBy("conv_id").agg(F.max(F.struct(*KEY)).alias("k")).select("conv_id", "k.*")
    zero = F.lit(0).cast("long")
    ends = stored(convs.join(last, "conv_id", "left").select("conv_id", *(F.coalesce(c, zero).alias(c) for c in KEY)), "ends")
    sequences = ends.groupBy(*KEY).agg(F.count("*").alias("weight"), F.min("conv_id").alias("conv_id"))
    proper = steps.select((F.col("depth") - 1).alias("depth"), F.col("q1").alias("p1"), F.col("q2").alias("p2")).distinct()
    leaves = sequences.join(proper, KEY, "left_anti").select("conv_id", F.lit(1).cast("long").alias("leaf"))
    sequences = stored(sequences.join(leaves, "conv_id", "left").select("conv_id", "weight", F.coalesce("leaf", zero).alias("leaf")), "sequences")
    tops = sequences.select("conv_id", *(zero.alias(c) for c in (*KEY, "q1", "q2", "words")), "weight", "leaf")
    prefixes = stored(steps.join(sequences, "conv_id").unionByName(tops), "prefixes")
    nodes = prefixes.groupBy(*KEY).agg(
        F.min("conv_id").alias("conv_id"),
        F.sum("weight").alias("n_convs"),
        F.sum("leaf").alias("n_leaves"),
        *(F.max(c).alias(c) for c in ("q1", "q2", "words")),
    )
    nodes = stored(nodes.withColumn("saved", F.expr("(n_convs - 1) * words")), "nodes")
    owned = nodes.groupBy("conv_id").agg(F.sum("saved").alias("owned")).where("owned > 0")
    below = prefixes.select("conv_id", *KEY).join(owned, "conv_id").groupBy(*KEY).agg(F.sum("owned").alias("below"))
    above = running(nodes, "conv_id", [F.col("depth")], {"above": ("sum", "saved")})
    upper = [F.expr("depth - 1").alias("depth"), F.col("q1").alias("p1"), F.col("q2").alias("p2")]
    children = nodes.where("depth > 0").select(*upper).groupBy(*KEY).agg(F.count("*").alias("n_children"))
    parts = ends.groupBy(*KEY, F.expr(f"floor(conv_id / {END_RANGE})").alias("part_no")).agg(F.array_sort(F.collect_list("conv_id")).alias("ids"))
    parts = parts.select(*KEY, "part_no", F.array_join(F.col("ids").cast("array<string>"), ",").alias("part"))
    parts = parts.repartition(*KEY).sortWithinPartitions(*KEY, "part_no").drop("part_no")
    digests = parts.mapInArrow(_digests, "depth long, p1 long, p2 long, ends_sha256 string")
    parents = nodes.select(F.col("conv_id").alias("parent_conv_id"), *(F.col(c).alias(f"u_{c}") for c in KEY))
    out = above.join(children, KEY, "left").join(below, KEY, "left").join(digests, KEY, "left")
    out = stored(out, "trie")
    out = out.join(parents, F.expr("depth - 1 = u_depth AND q1 = u_p1 AND q2 = u_p2"), "left")
    return out.select(
        "conv_id",
        "depth",
        "parent_conv_id",
        "n_convs",
        F.coalesce("n_children", zero).alias("n_children"),
        "n_leaves",
        (F.coalesce("below", zero) - F.col("above")).alias("saved_tokens"),
        F.coalesce("ends_sha256", F.sha2(F.lit(""), 256)).alias("ends_sha256"),
    )
