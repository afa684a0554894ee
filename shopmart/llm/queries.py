"""The registered queries of the training-data operators, with production parameters."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shopmart.llm import chat, collocations, embedding_dedup, langid, mixing, pii, quality, sharding, simhash, whitening
from shopmart.llm.decontaminate import contaminated, find_benchmark
from shopmart.llm.line_dedup import remove_repeated_runs
from shopmart.llm.substring_dedup import remove_repeated_windows


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = remove_repeated_windows(table(spark, sf_dir, "documents"), window=35)
    return out.select("doc_id", "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256"))


def op2_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = remove_repeated_runs(table(spark, sf_dir, "documents"), min_lines=2, long_words=20)
    return out.select("row.doc_id", "n_lines", "n_removed", F.sha2("kept", 256).alias("kept_sha256"))


def op4_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = find_benchmark(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"), ["doc_id"], window=13)
    return out.select("row.doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"),
                      F.sha2(F.concat_ws(",", "items"), 256).alias("items_sha256"), contaminated().alias("contaminated"))


def op3_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    out = pii.find(docs, pii.train(docs), ["doc_id"])

    def count(kind: str):
        return F.size(F.filter("base", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")

    def joined(spans: str):
        return F.concat_ws(",", F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])))

    return out.select("row.doc_id", *[count(k) for k in pii.KINDS], F.sha2(joined("base"), 256).alias("base_sha256"), joined("spans").alias("spans"))


def op5_source_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = mixing.mix(table(spark, sf_dir, "documents"))
    return out.select("row.doc_id", "n_tokens", "topic", F.round("probability", 6).alias("probability"), "kept")


def op6_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = simhash.near_duplicates(table(spark, sf_dir, "documents"), ["doc_id"], shingle=3, max_bits=3)
    return out.select("row.doc_id", F.lower(F.lpad(F.hex("fingerprint"), 16, "0")).alias("fingerprint"), "component_id")


def _remainder(n: int):
    """crc32 of the id as text, modulo n (null ids: null, which is in no fold)."""
    return F.crc32(F.col("doc_id").cast("string")) % n


def op7_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    train = quality.training_rows(docs.filter(_remainder(5) != 0), labels)
    out = quality.score(docs, quality.fit(train), ["doc_id"])
    return out.select("row.doc_id", "score").select("doc_id", F.coalesce(_remainder(5) == 0, F.lit(False)).alias("held_out"), "score", (F.col("score") >= 0.3).cast("int").alias("predicted"))


def op8_chat_formatting(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    told = "</s>[INST] ok [/INST]"
    rows = rows.unionByName(spark.createDataFrame([(-1, 0, "user", told), (-1, 1, "assistant", told)], "conv_id long, turn int, role string, text string"))
    return chat.digests(chat.formatted(chat.fold(chat.events_of_messages(rows))))


def op9_embedding_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embedding_dedup.near_duplicates(table(spark, sf_dir, "embeddings"), least=0.9)


def op10_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = langid.fit(docs.filter(_remainder(3) != 1).select("text", "lang"))
    out = langid.predict(docs, model, ["doc_id"]).select("row.doc_id", "lang_pred", "score")
    return out.select("doc_id", F.coalesce(_remainder(3) == 1, F.lit(False)).alias("held_out"), "lang_pred", "score")


def op11_embedding_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = whitening.whiten(table(spark, sf_dir, "embeddings"), ["vec_id"], most=16)
    return out.select("row.vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error")


def op12_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = sharding.pack(table(spark, sf_dir, "documents"), ["doc_id"], shards=16)
    return out.select("row.doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))


def op13_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations.collocations(table(spark, sf_dir, "documents"), least=100, longest=5, top=2000)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {n: f for n, f in globals().items() if n.startswith("op")}
