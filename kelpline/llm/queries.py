"""The queries of these operators: op1 to op13, over whole tables, and the SQL of those that SQL can express."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from kelpline.llm import conversation_repair, decontaminate, ego_join, line_dedup, merkle, mixing, near_dedup, pii, quality_pu, quality_rules, secrets, token_records, url_filter
from kelpline.llm.oracles import ORACLES
from kelpline.llm.recursive_oracles import ORACLES as RECURSIVE


def tokenizer_path() -> str:
    """The vocabulary file; the operators take any path."""
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_token_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_records.written_and_read(_table(spark, sf_dir, "documents"), tokenizer_path())


def op2_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    return line_dedup.dedup(docs, "d", line_dedup.OVER).select("doc_id", "text", F.col("d.n_removed").alias("n_removed"))


def op3_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    found = decontaminate.mark(docs, _table(spark, sf_dir, "benchmark"), "m")
    items = F.col("m.items")
    return found.select(
        "doc_id", F.col("m.n_words").alias("n_words"), F.col("m.n_hit").alias("n_hit"), F.size(items).cast("bigint").alias("n_items"),
        F.sha2(F.array_join(items, ",").cast("binary"), 256).alias("items_sha256"), F.col("m.contaminated").alias("contaminated"),
    )


def op4_quality_pu(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    model = quality_pu.train(docs, _table(spark, sf_dir, "labels"))
    out = quality_pu.score(docs, model)
    return out.select("doc_id", (~quality_pu.in_training(F.col("doc_id"))).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))


def op5_poisson_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "source", "text")
    return mixing.mix(docs, info="i").select("doc_id", "source", "text", "i.*")


def op6_secret_ledger(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets.summary(secrets.scan(_table(spark, sf_dir, "documents")))


def op7_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_filter.summary(_table(spark, sf_dir, "pages"))


def op8_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dedup.near_dedup(_table(spark, sf_dir, "documents"))


def op9_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.summary(_table(spark, sf_dir, "documents"))


def op10_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules.summary(_table(spark, sf_dir, "documents"))


def op11_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    return conversation_repair.repair(conversation_repair.damaged(_table(spark, sf_dir, "conversations")))


def op12_ego_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ego_join.linked(_table(spark, sf_dir, "embeddings"))


def op13_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return merkle.audited(_table(spark, sf_dir, "documents"))


def queries() -> dict:
    own = [
        op1_token_records, op2_line_dedup, op3_decontaminate, op4_quality_pu, op5_poisson_mix, op6_secret_ledger, op7_url_filter, op8_near_dedup, op9_pii, op10_quality_rules,
        op11_conversation_repair, op12_ego_join, op13_merkle_manifest,
    ]
    return {f.__name__: f for f in own}


def oracle_sql() -> dict[str, str]:
    return ORACLES | RECURSIVE
