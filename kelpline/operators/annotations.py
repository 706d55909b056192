"""Labels and model responses: their schema and meaning, label suggestions, stratified samples, F1 of sets, and gates."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# Fixed values.
SENTIMENTS = ("positive", "neutral", "negative", "mixed")
ASPECTS = ("product_quality", "delivery", "packaging", "customer_service", "price_value", "product_description", "payment", "other")
TOPICS = ("delivery_speed", "delivery_condition", "product_quality", "product_match", "packaging", "customer_service", "price_value", "payment_experience", "other")
RESTRICTED = r"(?i)(?:\b[A-Z0-9._%+-]+@[A-Z0-9.-]+\.[A-Z]{2,}\b|\bhttps?://|\b(?:order|customer|seller)[ _-]?id\s*[:=])"
MOST_SUMMARY, MOST_HIGHLIGHTS = 500, 5
GATES = (("AI_ASPECT_SENTIMENT_MACRO_F1_BELOW_GATE", "aspect_macro_f1", 0.75), ("AI_SCHEMA_PASS_RATE_BELOW_GATE", "schema_pass_rate", 1.0), ("AI_SENTIMENT_MACRO_F1_BELOW_GATE", "sentiment_macro_f1", 0.85), ("AI_TOPIC_MICRO_F1_BELOW_GATE", "topic_micro_f1", 0.75))

_NUMBER = r"(?:BIGINT|DOUBLE|DECIMAL\(\d+,\d+\))"
#: how Spark names the type of a response of the right shape: all fields, no others
_SHAPE = rf"^OBJECT<aspect_sentiments: ARRAY<(?:VOID|OBJECT<aspect: STRING, confidence: {_NUMBER}, sentiment: STRING>)>, confidence: {_NUMBER}, highlights: ARRAY<(?:VOID|STRING)>, sentiment: STRING, summary: STRING, topics: ARRAY<(?:VOID|STRING)>>$"
_RESPONSE = "sentiment string, confidence double, aspect_sentiments array<struct<aspect: string, sentiment: string, confidence: double>>, topics array<string>, summary string, highlights array<string>"


def validated_responses(df: DataFrame, payload: str, column: str = "response") -> DataFrame:
    """df with the parsed response as a struct, null unless payload is one object of the right shape and meaning."""
    shape = F.schema_of_variant(F.try_parse_json(payload))
    r = F.from_json(payload, _RESPONSE)
    share = lambda c: c.between(0, 1)
    distinct = lambda a: F.size(F.array_distinct(a)) == F.size(a)
    fine = lambda s: F.coalesce((F.trim(s) != "") & ~s.rlike(RESTRICTED), F.lit(False))
    aspect = lambda a: F.coalesce(a["aspect"].isin(*ASPECTS) & a["sentiment"].isin(*SENTIMENTS) & share(a["confidence"]), F.lit(False))
    # a parser stops after the first value: only a whole one leaves a list of two whole
    alone = F.json_array_length(F.concat(F.lit("["), payload, F.lit(",0]"))) == 2
    ok = [
        shape.rlike(_SHAPE), alone, r["sentiment"].isin(*SENTIMENTS), share(r["confidence"]), F.forall(r["aspect_sentiments"], aspect), distinct(F.transform(r["aspect_sentiments"], lambda a: a["aspect"])),
        F.forall(r["topics"], lambda t: F.coalesce(t.isin(*TOPICS), F.lit(False))), distinct(r["topics"]), F.length(r["summary"]) <= MOST_SUMMARY, fine(r["summary"]), F.size(r["highlights"]) <= MOST_HIGHLIGHTS, F.forall(r["highlights"], fine),
    ]
    return df.withColumn(column, F.when(F.coalesce(reduce(lambda a, b: a & b, ok), F.lit(False)), r))


def suggested_labels(score: Column, delivery: Column) -> Column:
    """A label from score and delivery outcome alone: sentiment, aspect_sentiments and topics."""
    sentiment = F.when(score <= 2, "negative").when(score == 3, "neutral").otherwise("positive")
    tone = F.when(delivery == "delayed", "negative").when((delivery == "on_time") & (score >= 4), "positive")
    one = F.struct(F.lit("delivery").alias("aspect"), tone.alias("sentiment"), F.lit(0.5).alias("confidence"))
    none = F.array().cast("array<struct<aspect:string,sentiment:string,confidence:double>>")
    return F.struct(sentiment.alias("sentiment"), F.when(tone.isNotNull(), F.array(one)).otherwise(none).alias("aspect_sentiments"), F.when(tone.isNotNull(), F.array(F.lit("delivery_speed"))).otherwise(F.array().cast("array<string>")).alias("topics"))


def digest(seed: str, *names: Column) -> Column:
    return F.sha2(F.concat_ws(":", F.lit(seed), *[n.cast("string") for n in names]).cast("binary"), 256)


def same(a: DataFrame, b: DataFrame, columns: list[str]) -> Column:
    return reduce(lambda x, y: x & y, [a[c].eqNullSafe(b[c]) for c in columns])


def ranked(df: DataFrame, strata: list[str], order: Column, key: str) -> DataFrame:
    """df with stratum_rank: the place of a row in its stratum by a hash (as hex digits), then its key.

    A stratum may hold a third of all rows, so it is ranked in 256 parts by the hash's first digits, whose sizes are summed up.
    """
    parted = df.withColumn("hash_", order).withColumn("part_", F.substring("hash_", 1, 2))
    sizes = parted.groupBy(*strata, "part_").agg(F.count("*").alias("size_"))
    before = F.coalesce(F.sum("size_").over(Window.partitionBy(*strata).orderBy("part_").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    sizes = sizes.withColumn("before_", before)
    own = F.row_number().over(Window.partitionBy(*strata, "part_").orderBy("hash_", key))
    parted = parted.withColumn("own_", own)
    out = parted.join(sizes, same(parted, sizes, [*strata, "part_"]))
    return out.select(*[parted[c] for c in df.columns], (parted["own_"] + sizes["before_"]).cast("bigint").alias("stratum_rank"))


def stratified_sample(df: DataFrame, key: str, strata: list[str], count: int, seed: str) -> DataFrame:
    """`count` rows: one of each stratum in the order of the strata's hashes, then again and again one of the stratum that is furthest
    below its share (ties: the greater hash).

    A stratum's k-th row is wanted with its share less k - 1, which falls with k: so these turns are the first rows
    in the order of that number, and no loop is needed. A count below 1 or beyond the rows is refused: the rows are counted at once.
    """
    if count < 1:
        raise ValueError("SELECTION_INVALID: count must be 1 or more")
    rows = ranked(df, strata, digest(seed, F.col(key)), key)
    sizes = df.groupBy(*strata).agg(F.count("*").alias("size_")).withColumn("name_", digest(seed, *[F.col(s) for s in strata]))
    totals = sizes.agg(F.sum("size_").alias("total_"), F.count("*").alias("strata_"))
    first = F.row_number().over(Window.orderBy("name_"))  # one row for each stratum
    sizes = sizes.withColumn("turn_", first).crossJoin(F.broadcast(totals))
    x = rows.join(sizes, same(rows, sizes, strata))
    cols = [rows[c] for c in df.columns]
    ones = x.where((F.col("stratum_rank") == 1) & (F.col("turn_") <= count)).select(*cols)
    wanted = (F.col("size_") * count).cast("double") / F.col("total_") - (F.col("stratum_rank") - 1)
    there = totals.first()
    if count > (there["total_"] or 0):
        raise ValueError(f"SELECTION_INVALID: {count} of {there['total_'] or 0} rows")
    more = x.where("stratum_rank > 1").orderBy(wanted.desc(), F.col("name_").desc()).limit(max(count - there["strata_"], 0)).select(*cols)
    return ones.unionByName(more)


def set_f1(df: DataFrame, truth: str, predicted: str) -> DataFrame:
    """macro_f1 and micro_f1 of columns of sets (arrays); 1 where no label is in either."""
    side = lambda c, name: F.transform(F.array_distinct(c), lambda x: F.struct(x.alias("label"), F.lit(name).alias("kind")))
    kinds = F.concat(side(F.array_intersect(truth, predicted), "tp"), side(F.array_except(predicted, truth), "fp"), side(F.array_except(truth, predicted), "fn"))
    by_label = df.select(F.explode(kinds).alias("x")).groupBy("x.label").agg(*[F.count_if(F.col("x.kind") == k).alias(k) for k in ("tp", "fp", "fn")])
    f1 = lambda tp, fp, fn: (2.0 * tp) / F.nullif(2 * tp + fp + fn, F.lit(0))
    sums = [F.sum(k) for k in ("tp", "fp", "fn")]
    return by_label.agg(F.coalesce(F.avg(f1(*[F.col(k) for k in ("tp", "fp", "fn")])), F.lit(1.0)).alias("macro_f1"), F.coalesce(f1(*sums), F.lit(1.0)).alias("micro_f1"))


def gate(report: DataFrame) -> DataFrame:
    """report (one column for each measure of GATES) with the codes of those below their gate, and a status."""
    codes = F.array_compact(F.array(*[F.when(~F.coalesce(F.col(c) >= least, F.lit(False)), code) for code, c, least in GATES]))
    passed = F.size("codes") == 0
    return report.withColumn("codes", codes).withColumn("status", F.when(passed, "PASSED").otherwise("BLOCKED")).withColumn("codes", F.when(passed, F.array(F.lit("AI_QUALITY_GATE_PASSED"))).otherwise(F.col("codes")))
