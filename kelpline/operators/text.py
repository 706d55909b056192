"""Text and evaluation operators: redaction, change selection, sampling, F1, telemetry."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from kelpline.functions.columns import DIRECT_ID, MAX_REVIEW_TEXT, SECRET_LIKE, as_in_sql, exact_average, redact
from kelpline.operators.annotations import ranked, same
from kelpline.operators.ranks import Keep, beside, nearest_ranks
from kelpline.operators.relational import fingerprint


def review_text(title: Column, comment: Column) -> Column:
    part = lambda name, c: F.when(F.trim(c) != "", F.concat(F.lit(f"{name}: "), F.trim(c)))
    return F.concat_ws("\n", part("Title", title), part("Comment", comment))


def dlp_project(df: DataFrame, title: Column, comment: Column, policy: str, source_hash: Column) -> DataFrame:
    """decision, reason, redaction_count, content hash and redacted text. Rules in order: empty, too long, an id, a secret; else redacted."""
    raw = review_text(title, comment)
    x = df.withColumn("raw_text", raw)
    t = F.col("raw_text")
    reason = F.when(t == "", "EMPTY_TEXT").when(F.length(t) > MAX_REVIEW_TEXT, "TEXT_TOO_LONG").when(t.rlike(as_in_sql(DIRECT_ID)), "DIRECT_IDENTIFIER").when(t.rlike(as_in_sql(SECRET_LIKE)), "SECRET_LIKE")
    text, count = redact(t)
    x = x.withColumn("reason", reason).withColumn("opaque_reference", F.sha2(F.concat(F.lit(f"{policy}:"), source_hash).cast("binary"), 256))
    x = x.withColumn("approved_text", F.when(F.col("reason").isNull(), text)).withColumn("redaction_count", F.when(F.col("reason").isNull(), count).otherwise(F.lit(0).cast("bigint")))
    return x.withColumn("decision", F.when(F.col("reason").isNull(), "APPROVED").otherwise("QUARANTINED")).withColumn("content_sha256", F.sha2(F.col("approved_text").cast("binary"), 256)).drop("raw_text")


def select_changes(candidates: DataFrame, committed: DataFrame, key: str, content: str, eligible: Column, approved: Column) -> DataFrame:
    """candidates with `selection`: EXCLUDED_INELIGIBLE, EXCLUDED_DLP, or NEW, CHANGED or REUSED against what was committed under one
    version. What is excluded has a null content. An approved candidate without content is an error; nulls in a condition exclude.
    """
    old = committed.select(F.col(key), F.col(content).alias("old_content"), F.lit(True).alias("was"))
    state = F.when(~F.coalesce(eligible, F.lit(False)), "EXCLUDED_INELIGIBLE").when(~F.coalesce(approved, F.lit(False)), "EXCLUDED_DLP")
    j = candidates.withColumn("selection", state).join(old, key, "left")
    chosen = F.when(F.col(content).isNull(), F.raise_error(F.lit("SELECTION_INVALID")).cast("string")).when(F.col("was").isNull(), "NEW").when(F.col("old_content") == F.col(content), "REUSED").otherwise("CHANGED")
    j = j.withColumn(content, F.when(F.col("selection").isNull(), F.col(content))).withColumn("selection", F.coalesce("selection", chosen))
    return j.drop("old_content", "was")


def selection_plan(selected: DataFrame, key: str, source_hash: str, content: str) -> DataFrame:
    """One row: counts of a selection, and a digest of its keys, hashes and selections that no order of rows changes."""
    states = ("NEW", "CHANGED", "REUSED", "EXCLUDED_INELIGIBLE", "EXCLUDED_DLP")
    counts = selected.agg(*[F.count_if(F.col("selection") == x).alias(f"n_{x.lower()}") for x in states])
    digest = fingerprint(selected.select(key, source_hash, content, "selection"), "selection")
    return counts.crossJoin(digest.select(F.col("content_hash").alias("selection_sha256")))  # of one row each


def commit_validated(committed: DataFrame, new: DataFrame, key: str, content: str) -> DataFrame:
    """Every row after the commit, with INSERTED, REUSED, REPLACED or KEPT."""
    a, b = committed.select(key, F.col(content).alias("o"), F.lit(True).alias("h")), new.select(key, F.col(content).alias("n"), F.lit(True).alias("g"))
    j = a.join(b, key, "full")
    state = F.when(F.col("h").isNull(), "INSERTED").when(F.col("g").isNull(), "KEPT").when(F.col("o") == F.col("n"), "REUSED").otherwise("REPLACED")
    return j.select(key, F.coalesce("n", "o").alias(content), state.alias("commit_state"))


def stratified_holdout(df: DataFrame, key: str, strata: list[str], percent: int, seed: str) -> DataFrame:
    """df with `held_out`: each stratum gives the whole part of its share, and those of the largest remainders one more, to
    the total share rounded up. Within a stratum, and between equal remainders, a seeded hash decides.

    Only counts of the strata meet in one window; rows are ranked in parts of a stratum.
    """
    counts = df.groupBy(*strata).agg(F.count("*").alias("n"))
    x = counts.withColumn("base", F.floor(F.col("n") * percent / 100).cast("bigint")).withColumn("rest", (F.col("n") * percent) % 100)
    name = F.sha2(F.concat_ws(":", F.lit(seed), *[F.col(s).cast("string") for s in strata]).cast("binary"), 256)
    total = x.agg(F.ceil(F.sum("n") * percent / 100).alias("wanted"), F.sum("base").alias("given"))
    x = x.crossJoin(F.broadcast(total)).withColumn("turn", F.row_number().over(Window.orderBy(F.col("rest").desc(), name)))
    quota = x.select(*strata, (F.col("base") + F.when(F.col("turn") <= F.col("wanted") - F.col("given"), 1).otherwise(0)).alias("quota"))
    rows = ranked(df, strata, F.sha2(F.concat(F.lit(f"{seed}:"), F.col(key).cast("string")).cast("binary"), 256), key)
    on = same(rows, quota, strata)
    return rows.join(quota, on).select(*[rows[c] for c in df.columns], "stratum_rank", (rows["stratum_rank"] <= quota["quota"]).alias("held_out"))


def f1_by_class(df: DataFrame, truth: str, predicted: str) -> DataFrame:
    """tp, fp, fn and f1 of each class of either column, from one row for each pair of classes."""
    pairs = df.groupBy(F.col(truth).alias("t"), F.col(predicted).alias("p")).agg(F.count("*").alias("n"))
    hit = F.col("t").eqNullSafe(F.col("p"))
    rows = pairs.select(F.explode(F.when(hit, F.array(F.struct(F.col("t").alias("c"), F.col("n").alias("tp"), F.lit(0).cast("bigint").alias("fp"), F.lit(0).cast("bigint").alias("fn")))).otherwise(
        F.array(F.struct(F.col("p").alias("c"), F.lit(0).cast("bigint").alias("tp"), F.col("n").alias("fp"), F.lit(0).cast("bigint").alias("fn")), F.struct(F.col("t").alias("c"), F.lit(0).cast("bigint").alias("tp"), F.lit(0).cast("bigint").alias("fp"), F.col("n").alias("fn"))))).alias("r"))
    g = rows.groupBy(F.col("r.c").alias("class")).agg(*[F.sum(f"r.{x}").alias(x) for x in ("tp", "fp", "fn")])
    return g.withColumn("f1", F.coalesce(2.0 * F.col("tp") / F.nullif(2 * F.col("tp") + F.col("fp") + F.col("fn"), F.lit(0)), F.lit(0.0)))


def macro_micro_f1(by_class: DataFrame) -> DataFrame:
    micro = 2.0 * F.sum("tp") / F.nullif(2 * F.sum("tp") + F.sum("fp") + F.sum("fn"), F.lit(0))
    return by_class.agg(F.count("*").alias("n_classes"), F.avg("f1").alias("macro_f1"), micro.alias("micro_f1"))


def telemetry(df: DataFrame, by: list[str], state: str, latency: str, cost: str, keep: Keep) -> DataFrame:
    """Requests, distinct states, the sum and nearest-rank 95th percentile of latencies, and costs. keep(name, frame) writes a frame and reads it back."""
    sums = df.groupBy(*by).agg(F.count("*").alias("requests"), F.count_distinct(state).alias("states"), F.sum(latency).alias("latency_total"), F.sum(cost).alias("cost"), exact_average(F.sum(cost), F.count("*")).alias("mean_cost"))
    return beside(sums, nearest_ranks(df, by, latency, "0.95", keep, "latency_p95"), by, "left")


def coverage(base: DataFrame, done: DataFrame, key: str, eligible: Column) -> DataFrame:
    j = base.select(key, eligible.alias("e")).join(done.select(key, F.lit(True).alias("d")), key, "left")
    valid = F.count_if(F.col("e") & F.col("d").isNotNull())
    n = F.count_if("e")
    return j.agg(F.count("*").alias("base_rows"), n.alias("eligible_rows"), valid.alias("valid_rows"), (n - valid).alias("missing_rows"), F.round(valid / F.nullif(n, F.lit(0)), 6).alias("coverage_ratio"))


def length_bucket(text: Column) -> Column:
    n = F.length(F.coalesce(text, F.lit("")))
    return F.when(n < 80, "short").when(n < 240, "medium").otherwise("long")


def category_bucket(categories: Column) -> Column:
    """A short name for a set of categories that doesn't tell what they are."""
    text = F.array_join(F.array_sort(F.array_distinct(categories)), "\x1f")
    return F.when(F.size(categories) > 0, F.concat(F.lit("category_"), F.substring(F.sha2(text.cast("binary"), 256), 1, 16))).otherwise("unknown")


def delivery_outcome(delivered: Column, estimated: Column) -> Column:
    """By days, not times: delayed, on_time, or unknown where one is missing."""
    late = F.to_date(delivered) > F.to_date(estimated)
    return F.when(late.isNull(), "unknown").when(late, "delayed").otherwise("on_time")


def estimated_cost(prompt_tokens: Column, completion_tokens: Column, prompt_price: str, completion_price: str) -> Column:
    """Exact cost of a request, from prices of a token as decimal texts."""
    exact = lambda n, price: n.cast("decimal(19,0)") * F.lit(price).cast("decimal(18,12)")
    return exact(prompt_tokens, prompt_price) + exact(completion_tokens, completion_price)


def estimated_tokens(text: Column, overhead: int = 0) -> Column:
    return (F.floor((F.length(F.coalesce(text, F.lit(""))) + 3) / 4) + overhead).cast("bigint")


# What a log line may not show, in this order, and the names of values that are never shown.
LOG_PATTERNS = (
    (r"(?i)\b[A-Z0-9._%+-]+@[A-Z0-9.-]+\.[A-Z]{2,}\b", "[EMAIL]"),
    (r"(?i)\b(?:https?://|www\.)[^\s<>'\"]+", "[URL]"),
    (r"(?<!\d)(?:\d[ -]?){12,18}\d(?!\d)", "[PAYMENT]"),
    (r"(?<![\w])(?:\+?\d[\d(). -]{7,}\d)(?![\w])", "[PHONE]"),
)
SENSITIVE_KEYS = (
    "authorization", "credential", "credentials", "password", "passphrase", "api_key", "access_key", "access_key_id", "private_key", "private_key_path",
    "secret", "secret_key", "secret_access_key", "token", "auth_token", "refresh_token", "session_cookie",
    "content", "document_text", "chunk_text", "error_message", "message", "prompt", "prompt_text", "provider_body", "query", "question", "raw_payload", "raw_review",
    "request_body", "response_body", "review_comment", "review_text", "review_title",
)
MAX_LOG, REDACTED = 1024, "[REDACTED]"


def redact_log(text: Column) -> Column:
    for pattern, name in LOG_PATTERNS:
        text = F.regexp_replace(text, pattern, name)
    return F.when(F.length(text) > MAX_LOG, F.concat(F.substring(text, 1, MAX_LOG), F.lit("..."))).otherwise(text)


def redact_event(fields: Column) -> Column:
    """A map of texts with the values of sensitive names hidden, and the others redacted."""
    return F.transform_values(fields, lambda k, v: F.when(F.lower(k).isin(*SENSITIVE_KEYS), REDACTED).otherwise(redact_log(v)))
