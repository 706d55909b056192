"""Secret scan with an incremental blob ledger. DataFrame and SQL functions only.

Every version of a text is a blob, addressed by its SHA-256. The ledger is a Parquet table of what has been
scanned: blob, rules (name@version) and findings. A scan looks only at blob and rule-version pairs that
the ledger lacks, appends them, and joins the findings back to all paths (documents) of each blob.
So copies are scanned once, a second run over the same texts scans nothing, and a new version
of one rule scans with that rule only.

Defined cases: null text is an empty text, without findings. Rows that repeat get the same findings.
A null doc_id is a path like others. A text of any length is scanned whole. Extra columns are ignored. An empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kelpline.llm.common import Scratch
from kelpline.llm.spans import found, listed

# Name, version, pattern, least length of a part (by its group), whether the contract's base has it.
# Possessive quantifiers change no match here; they keep long runs linear.
RULES = (
    ("assign", 1, r"""(?:[Pp][Aa][Ss][Ss][Ww][Oo][Rr][Dd]|[Pp][Aa][Ss][Ss][Ww][Dd]|[Ss][Ee][Cc][Rr][Ee][Tt]|[Tt][Oo][Kk][Ee][Nn]|[Aa][Pp][Ii]_?[Kk][Ee][Yy])["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]++)""", r"^[^:=]*[:=]\x20*[\"']?", 12, True),
    ("access", 1, r"AKIA[A-Z0-9]++", "", 18, True),
    ("hex", 1, r"(?<![0-9a-f])[0-9a-f]{16,}+", "", 16, True),
    ("pem", 1, r"-----BEGIN [A-Z ]*PRIVATE KEY-----", "", 1, False),
    ("token", 1, r"(?<![A-Za-z0-9_])(?:gh[pousr]_[A-Za-z0-9]{36}|xox[abprs]-[A-Za-z0-9-]{10,}|eyJ[A-Za-z0-9_-]{8,}\.eyJ[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,})", "", 1, False),
)
SALTS = 16
ORDER = {rule[0]: i for i, rule in enumerate(RULES)}
BASE = [rule[0] for rule in RULES if rule[5]]
_FINDINGS = "array<struct<start:bigint,place:int,kind:string,rule:string,end:bigint>>"
_LEDGER = f"blob binary, rules array<string>, findings {_FINDINGS}"


def _scan(text: Column, rule: tuple, todo: Column) -> Column:
    name, version, pattern, before, least, _ = rule
    label = f"{name}@{version}"
    spans = found(text, pattern)
    long = F.filter(spans, lambda s: F.length(F.regexp_replace(s["value"], before, "") if before else s["value"]) >= least)
    rows = F.transform(long, lambda s: F.struct(s["start"].alias("start"), F.lit(ORDER[name]).alias("place"), F.lit(name).alias("kind"), F.lit(label).alias("rule"), s["end"].alias("end")))
    return F.when(F.array_contains(todo, label), rows).otherwise(F.array().cast(_FINDINGS))


def scan(docs: DataFrame, ledger: str | None = None, rules: tuple = RULES) -> DataFrame:
    """doc_id and findings (struct of start, place, kind, rule, end; by start, then kind) of each row of docs.

    ledger: the folder of the ledger, which is made if need be and appended to; None: a new one in the shared folder.
    Runs on one ledger must follow each other.
    """
    spark = docs.sparkSession
    scratch = Scratch(spark, "secrets")
    at = ledger or f"{scratch.path}/ledger"
    labels = [f"{r[0]}@{r[1]}" for r in rules]
    spark.createDataFrame([], _LEDGER).write.mode("append").parquet(at)
    known = spark.read.schema(_LEDGER).parquet(at)
    text = F.coalesce("text", F.lit(""))
    blobs = docs.select("doc_id", F.unhex(F.sha2(text.cast("binary"), 256)).alias("blob"), text.alias("text"))
    paths = scratch.save(blobs.select("doc_id", "blob"))
    wanted = F.array(*[F.lit(x) for x in labels])
    done = scratch.save(known.groupBy("blob").agg(F.flatten(F.collect_list("rules")).alias("done")))
    # copies are brought down to one before texts meet the ledger, which is dealt out by the same key
    unseen = blobs.groupBy("blob").agg(F.first("text").alias("text")).join(done, "blob", "left")
    unseen = unseen.withColumn("todo", F.array_except(wanted, F.coalesce("done", F.array().cast("array<string>")))).where(F.size("todo") > 0)
    findings = F.concat(*[_scan(F.col("text"), r, F.col("todo")) for r in rules])
    unseen.select("blob", F.col("todo").alias("rules"), findings.alias("findings")).write.mode("append").parquet(at)
    now = F.filter("findings", lambda f: F.array_contains(wanted, f["rule"]))
    known = spark.read.schema(_LEDGER).parquet(at)  # with what was just added
    hits = known.select("blob", now.alias("findings")).where(F.size("findings") > 0)
    hits = scratch.save(hits.groupBy("blob").agg(F.flatten(F.collect_list("findings")).alias("findings")))
    # one blob may have a third of all paths: they are dealt out to SALTS parts, each with its findings
    hits = hits.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    paths = paths.withColumn("salt", F.pmod(F.hash("doc_id"), F.lit(SALTS)))
    return paths.join(hits, ["blob", "salt"], "left").select("doc_id", F.array_sort(F.coalesce("findings", F.array().cast(_FINDINGS))).alias("findings"))


def summary(scanned: DataFrame) -> DataFrame:
    """Counts of the base kinds, a digest of the base spans, and all spans as text."""
    base = F.filter("findings", lambda f: f["kind"].isin(*BASE))
    count = lambda kind: F.size(F.filter("findings", lambda f: f["kind"] == kind)).cast("bigint").alias(f"n_{kind}")
    return scanned.select("doc_id", *[count(k) for k in BASE], F.sha2(listed(base).cast("binary"), 256).alias("base_sha256"), listed(F.col("findings")).alias("spans"))
