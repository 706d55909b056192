"""A corpus made ready for training, stage by stage.

Each stage takes the documents that the one before kept, and all but the last return their columns, any others with them. Defined cases, of all stages: null and
empty texts are scored, kept and mixed like others, link with nothing, hold no benchmark and become a record of the end id. Texts of any length are taken whole.
Rows that repeat a doc_id and a text are judged alike and dropped or kept together; a null doc_id takes part. An empty table passes through as one.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from kelpline.llm import decontaminate, mixing, near_dedup, quality_pu
from kelpline.llm.common import Scratch, cleared
from kelpline.llm.queries import tokenizer_path
from kelpline.llm.token_records import written_and_read


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier accepts (op4)."""
    return quality_pu.keep_good(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies (op8), that of least doc_id; null ids come last."""
    return near_dedup.keep_one(docs)


def decontaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents of which fewer than 5 in 100 words are hit by the benchmark (op3)."""
    return decontaminate.clean(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as their source's weight draws them, in an order by hash (op5). A null source is one of its own."""
    return mixing.mix(docs)


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The records of all documents, in the order of the mix (op1): doc_id, start, n_tokens and ids_crc32."""
    return written_and_read(docs, tokenizer_path(), by_id=False, remembered=100_000)  # in the order of the mix; workers hold what earlier stages loaded


STAGES = [("quality", quality), ("near_copies", near_copies), ("decontaminated", decontaminated), ("mixed", mixed), ("tokens", tokens)]

#: SQL can express neither the classifier nor the tokenizer.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages over documents; what each returns is written to the shared folder and read again."""
    with Scratch(spark, "pipeline") as scratch:
        docs, before = spark.read.parquet(f"{sf_dir}/documents.parquet"), []
        for _, stage in STAGES:
            with cleared():  # what the stage's operator saved for itself
                docs = scratch.save(stage(spark, docs, sf_dir))
            scratch.drop(*before)
            before = [docs]
        return docs
