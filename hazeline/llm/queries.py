"""The registered queries of the operators: each runs one operator over its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from hazeline.llm.common import ship
from hazeline.llm import chat, decontamination, exact_dedup, jaccard_join, packing, periodic, personal, quality, repeats, secrets, setsketch, sharding, trie

SHARDS = 40


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    ship(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def repeated_strings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repeats.remove_repeats(_table(spark, sf_dir, "documents")).drop("kept")


def virtual_slots(spark: SparkSession, sf_dir: str) -> DataFrame:
    placed = sharding.shard_documents(_table(spark, sf_dir, "documents"), SHARDS)
    return placed.select(
        "doc_id",
        "size",
        "text_crc32",
        F.lit("bytes").alias("law"),
        "shard",
        "slot",
        F.lit(None).cast("int").alias("grown_shard"),
        "virtual_slot",
    )


def exact_copies(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = exact_dedup.exact_groups(_table(spark, sf_dir, "documents"), every_digest=True)
    return rows.withColumnRenamed("digest", "text_sha256")


def benchmark_overlap(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontamination.contaminated_words(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))
    return decontamination.report(found)


def secret_spans(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    ratios = secrets.log_ratios(secrets.labelled(docs))
    return secrets.report(secrets.scan(docs, ratios))


def jaccard_links(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_join.similarity_classes(_table(spark, sf_dir, "documents")).drop("th", "first")


def held_out() -> F.Column:
    return F.pmod(F.crc32(F.encode(F.col("doc_id").cast("string"), "UTF-8")), F.lit(3)) == 1


def quality_model(spark: SparkSession, sf_dir: str, docs: DataFrame) -> quality.Model:
    return quality.train(docs, _table(spark, sf_dir, "labels").where(~held_out()))


def quality_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    rows = quality.scored(docs, quality_model(spark, sf_dir, docs))
    return rows.select(
        "doc_id", F.coalesce(held_out(), F.lit(False)).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted")
    )


def packed_sequences(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    cut = packing.pieces(_table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"))
    return packing.packed(cut).drop("ids")


def chat_turns(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    hard = "</s>[INST] ok [/INST]"
    probe = rows.limit(0).unionByName(
        spark.range(2).select(
            F.lit(-1).cast(rows.schema["conv_id"].dataType).alias("conv_id"),
            F.col("id").cast(rows.schema["turn"].dataType).alias("turn"),
            F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"),
            F.lit(hard).alias("text"),
        )
    )
    return chat.report(chat.formatted(chat.canonical(chat.records(rows.unionByName(probe)))))


def personal_spans(spark: SparkSession, sf_dir: str) -> DataFrame:
    return personal.find_personal(_table(spark, sf_dir, "documents"))


def sketched_copies(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = setsketch.near_copies(_table(spark, sf_dir, "documents"))
    return found.select("doc_id", F.col("set_size").alias("n_shingles"), "component_id", "kept")


def prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    convs, turns = trie.rebuilt(trie.placed(_table(spark, sf_dir, "conversations")))
    return trie.prefix_trie(convs, turns)


def with_planted_runs(docs: DataFrame) -> DataFrame:
    """``doc_id, text``; where h = crc32(doc_id) is a multiple of 10, a part of the words repeats up to the end."""
    space = r"[\x20\x09-\x0D]+"
    hashed = F.crc32(F.encode(F.col("doc_id").cast("string"), "UTF-8"))
    rows = docs.select("doc_id", F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"), hashed.alias("h"), F.expr("crc32(encode(cast(doc_id AS string), 'UTF-8')) div 10").alias("g"))
    words = F.when(F.col("h") % 10 == 0, F.filter(F.split("text", space), lambda w: w != ""))
    rows = rows.withColumn("words", words).withColumn("n", F.size("words"))
    rows = rows.withColumn("a", F.expr("if(n > 0, cast(g % n AS int), null)"))
    rows = rows.withColumn("p", F.expr("cast(1 + (n - a) div (3 + g % 8) AS int)"))
    told = "slice(concat(slice(words, 1, a), flatten(array_repeat(slice(words, a + 1, p), cast(1 + (n - a) div p AS int)))), 1, n)"
    return rows.select("doc_id", F.expr(f"if(n > 0 AND p IS NOT NULL, array_join({told}, ' '), text)").alias("text"))


def periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return periodic.report(periodic.find_runs(with_planted_runs(_table(spark, sf_dir, "documents"))))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_repeated_strings": repeated_strings,
    "op2_virtual_slots": virtual_slots,
    "op3_exact_copies": exact_copies,
    "op4_benchmark_overlap": benchmark_overlap,
    "op5_secret_spans": secret_spans,
    "op6_jaccard_links": jaccard_links,
    "op7_quality_scores": quality_scores,
    "op8_packed_sequences": packed_sequences,
    "op9_chat_turns": chat_turns,
    "op10_personal_spans": personal_spans,
    "op11_sketched_copies": sketched_copies,
    "op12_prefix_trie": prefix_trie,
    "op13_periodic_runs": periodic_runs,
}
