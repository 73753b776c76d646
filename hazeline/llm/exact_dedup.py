"""Exact deduplication by progressive refinement: length, then prefix hash, then full hash.

Texts are equal when identical after every run of ``[\\x20\\x09-\\x0D]`` became one space; a null text is
empty. Only narrow columns are grouped: lengths first, prefix hashes among rows whose length repeats, and
whole texts are read for a digest only where a prefix repeats. Every count is a partial aggregate, so a
group with a third of all rows reaches its task as one row per input partition.

Of equal texts the smallest id stays; a null id is larger than any other. Of rows alike in id and text one
stays. An empty table gives an empty result. Columns besides id and text are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from hazeline.llm.common import stored

PREFIX_CHARS = 256
SPACES = r"[\x20\x09-\x0D]+"


def normal(text: Column) -> Column:
    return F.regexp_replace(F.coalesce(text.cast("string"), F.lit("")), SPACES, " ")


def _marked(docs: DataFrame, id_col: str, text_col: str, prefix_chars: int) -> DataFrame:
    text = normal(docs[text_col])
    return docs.select(docs[id_col].alias("doc_id"), text.alias("norm")).select(
        "doc_id", "norm", F.length("norm").alias("len"), F.xxhash64(F.substring("norm", 1, prefix_chars)).alias("prefix")
    )


def repeated_prefixes(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", prefix_chars: int = PREFIX_CHARS) -> DataFrame:
    """Length and prefix hash of every group that full contents must decide."""
    narrow = _marked(docs, id_col, text_col, prefix_chars).groupBy("len", "prefix").agg(F.count("*").alias("n"))
    lengths = narrow.groupBy("len").agg(F.sum("n").alias("same_len")).where("same_len > 1")
    return narrow.join(lengths, "len", "left_semi").where("n > 1").select("len", "prefix", F.lit(True).alias("again"))


def digests(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", prefix_chars: int = PREFIX_CHARS, every_digest: bool = False
) -> DataFrame:
    """``doc_id, len, prefix, digest, copies``: one row per different id and text.

    ``digest`` is null where length and prefix already show a text to be alone, unless ``every_digest``.
    """
    marked = _marked(docs, id_col, text_col, prefix_chars)
    again = repeated_prefixes(docs, id_col, text_col, prefix_chars)
    full = F.sha2(F.encode("norm", "UTF-8"), 256)
    read = marked.join(again, ["len", "prefix"], "left").select(
        "doc_id",
        F.coalesce("again", F.lit(False)).alias("again"),
        (full if every_digest else F.when(F.col("again"), full)).alias("digest"),
        F.when(F.col("again").isNull(), F.struct("len", "prefix")).alias("alone"),
    )
    return stored(read.groupBy("doc_id", "again", "digest", "alone").agg(F.count("*").alias("copies")), "digests")


def exact_groups(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", prefix_chars: int = PREFIX_CHARS, every_digest: bool = False
) -> DataFrame:
    """One row per input row: ``doc_id, keep_id, group_size, kept, digest``."""
    rows = digests(docs, id_col, text_col, prefix_chars, every_digest)
    groups = stored(rows.where("again").groupBy("digest").agg(F.min("doc_id").alias("least"), F.sum("copies").alias("total")), "groups")
    decided = rows.where("again").join(groups, "digest").unionByName(
        rows.where("NOT again").withColumns({"least": F.col("doc_id"), "total": F.col("copies")})
    )
    copy = F.explode(F.sequence(F.lit(1), F.col("copies").cast("int"))).alias("copy")
    return decided.select("doc_id", F.col("least").alias("keep_id"), F.col("total").alias("group_size"), "digest", copy).select(
        "doc_id",
        "keep_id",
        "group_size",
        ((F.col("copy") == 1) & F.col("doc_id").eqNullSafe(F.col("keep_id"))).alias("kept"),
        "digest",
    )


def keep_first(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows that stay, with all their columns.

    Of rows alike in id and text, the one whose raw text is smallest stays; the others are cut before the
    shuffle, to one per input partition.
    """
    rows = digests(docs, id_col, text_col, every_digest=True)
    least = rows.groupBy("digest").agg(F.min("doc_id").alias("keep"))
    out = docs.withColumn("_hz_digest", F.sha2(F.encode(normal(docs[text_col]), "UTF-8"), 256))
    least = least.select(F.col("digest").alias("_hz_keep_digest"), F.col("keep").alias("_hz_keep"))
    chosen = out.join(
        least, (out["_hz_digest"] == least["_hz_keep_digest"]) & out[id_col].eqNullSafe(least["_hz_keep"]), "left_semi"
    )
    first = Window.partitionBy("_hz_digest", id_col).orderBy(text_col)
    return chosen.withColumn("_hz_n", F.row_number().over(first)).where("_hz_n = 1").drop("_hz_n", "_hz_digest")
