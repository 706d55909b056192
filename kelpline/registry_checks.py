"""Queries of contracts, reconciliation, relationships, fingerprints, labels and releases, and their SQL."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kelpline.operators import annotations as A
from kelpline.operators import relational as R
from kelpline.operators import validate as V
from kelpline.plans.oracles import sql
from kelpline.registry import MODELS, _columns, model_sql, models, published, published_sql, register
from kelpline.sinks.release import activation_eligibility
from kelpline.sources.commerce import bronze, table
from kelpline.sources.files import classify_releases

# Checks of facts against tables, and of marts against facts: name, and both sides as (relation, sum or count, where).
_ITEM = "order_parent_exists AND amount_quality_status = 'VALID'"
_REVIEW = "order_parent_exists AND response_interval_valid AND review_score BETWEEN 1 AND 5"
_FACT = "order_id IN (SELECT order_id FROM fact_order)"
CHECKS = [
    ("FACT_ORDER_COUNT", ("fact_order", "count"), ("sil_order", "count", "analysis_scope_status <> 'QUARANTINED'")),
    ("FACT_ORDER_ITEM_COUNT", ("fact_order_item", "count"), ("sil_order_item", "count", _ITEM, True)),
    ("FACT_PAYMENT_COUNT", ("fact_payment", "count"), ("sil_order_payment", "count", _ITEM, True)),
    ("FACT_REVIEW_BASE_COUNT", ("fact_review_base", "count"), ("sil_order_review", "count", _REVIEW, True)),
    ("FACT_ORDER_ITEM_AMOUNT", ("fact_order_item", "item_total_value"), ("sil_order_item", "item_total_value", _ITEM, True)),
    ("FACT_PAYMENT_AMOUNT", ("fact_payment", "payment_value"), ("sil_order_payment", "payment_value", _ITEM, True)),
    ("ORDER_DELIVERY_ORDER_COUNT", ("mart_order_delivery", "order_count"), ("fact_order", "count")),
    ("ORDER_DELIVERY_GMV", ("mart_order_delivery", "gross_merchandise_value"), ("fact_order_item", "price")),
    ("ORDER_DELIVERY_FREIGHT", ("mart_order_delivery", "freight_value"), ("fact_order_item", "freight_value")),
    ("ORDER_DELIVERY_PAYMENT", ("mart_order_delivery", "payment_value"), ("fact_payment", "payment_value")),
    ("PRODUCT_ITEM_COUNT", ("mart_product_review", "item_count"), ("fact_order_item", "count")),
    ("PRODUCT_REVIEW_COUNT", ("mart_product_review", "allocated_review_count"), ("bridge_review_item", "allocation_weight")),
    ("PRODUCT_REVIEW_SCORE", ("mart_product_review", "allocated_review_score"), ("bridge_review_item", "allocated_review_score")),
    ("SELLER_ITEM_COUNT", ("mart_seller_performance", "item_count"), ("fact_order_item", "count")),
    ("SELLER_REVIEW_COUNT", ("mart_seller_performance", "allocated_review_count"), ("bridge_review_item", "allocation_weight")),
    ("SELLER_REVIEW_SCORE", ("mart_seller_performance", "allocated_review_score"), ("bridge_review_item", "allocated_review_score")),
    ("CUSTOMER_ORDER_COUNT", ("mart_customer_overview", "order_count"), ("fact_order", "count")),
    ("CUSTOMER_GMV", ("mart_customer_overview", "gross_merchandise_value"), ("fact_order_item", "price")),
    ("CUSTOMER_PAYMENT", ("mart_customer_overview", "payment_value"), ("fact_payment", "payment_value")),
]


def _side_sql(relation: str, what: str, where: str = "", in_fact: bool = False) -> str:
    """SQL has weights and scores in whole units, and marts of them as rounded doubles."""
    unit = {"allocation_weight": "sum(weight_units)::DOUBLE / 1e18", "allocated_review_score": "sum(score_units)::DOUBLE / 1e18"} if relation.startswith("bridge") else {}
    value = "count(*)" if what == "count" else unit.get(what, f"sum({what})")
    conditions = " AND ".join(c for c in (where, _FACT if in_fact else "") if c)
    return f"(SELECT coalesce({value}, 0)::DOUBLE FROM {relation}{f' WHERE {conditions}' if conditions else ''})"


@register(sql(" UNION ALL ".join(f"SELECT '{n}' AS check_name, abs({_side_sql(*a)} - {_side_sql(*b)}) < 0.01 AS holds" for n, a, b in CHECKS)))
def reconciliation(spark, sf_dir):
    """Facts against tables, and marts as published against facts: one row for each check; each relation is read once.

    Marts show allocated weights and scores with 6 places, so that their sum may be off by more than a cent where the bridge's is exact.
    """
    m = models(spark, sf_dir)
    keys = m["fact_order"].select("order_id")
    return reconciled(m, keys)


def reconciled(m: dict[str, DataFrame], keys: DataFrame) -> DataFrame:
    """The checks over relations by name, of which those of tables meet the orders of `keys`; sums hold if they differ by less than a cent."""
    sides = {side for _, a, b in CHECKS for side in (a, b)}
    shown = lambda source, w: F.round(F.col(w).cast("decimal(38,18)"), 6) if source.startswith("mart_") else F.col(w).cast("decimal(38,18)")
    by: dict[tuple, list] = {}
    for side in sides:
        by.setdefault((side[0], *side[2:]), []).append(side[1])
    frames, names = [], {}
    for i, (source, what) in enumerate(sorted(by.items())):
        rows = m[source[0]].where(source[1]) if len(source) > 1 else m[source[0]]
        rows = rows.join(keys, "order_id") if len(source) > 2 else rows
        one = lambda w: F.count("*").cast("decimal(38,9)") if w == "count" else F.coalesce(F.sum(shown(source[0], w) if "alloc" in w else F.col(w)), F.lit(0))  # noqa: E731, B023
        frames.append(rows.agg(*[one(w).alias(f"s{i}_{w}") for w in what]))
        names |= {(source[0], w, *source[1:]): f"s{i}_{w}" for w in what}
    wide = reduce(lambda a, b: a.crossJoin(b), frames)  # of one row each
    checks = [F.struct(F.lit(n).alias("check_name"), (F.abs(F.col(names[a]) - F.col(names[b])) < F.lit("0.01").cast("decimal(3,2)")).alias("holds")) for n, a, b in CHECKS]
    return wide.select(F.explode(F.array(*checks)).alias("c")).select("c.*")


#: Every foreign key: child, its column, parent and its key.
RELATIONSHIPS = [
    ("dim_customer", "geography_key", "dim_geography", "geography_key"), ("dim_seller", "geography_key", "dim_geography", "geography_key"),
    ("fact_order", "customer_key", "dim_customer", "customer_key"), *[("fact_order", f"{d}_date_key", "dim_date", "date_key") for d in ("purchase", "delivered", "estimated_delivery")],
    ("fact_order_item", "order_key", "fact_order", "order_key"), ("fact_order_item", "product_key", "dim_product", "product_key"), ("fact_order_item", "seller_key", "dim_seller", "seller_key"), ("fact_order_item", "shipping_limit_date_key", "dim_date", "date_key"),
    ("fact_payment", "order_key", "fact_order", "order_key"), ("fact_review_base", "order_key", "fact_order", "order_key"), ("fact_review_base", "review_date_key", "dim_date", "date_key"),
    *[("bridge_review_item", f"{k}_key", p, f"{k}_key") for k, p in (("review", "fact_review_base"), ("order", "fact_order"), ("order_item", "fact_order_item"), ("product", "dim_product"), ("seller", "dim_seller"))],
    ("mart_order_delivery", "geography_key", "dim_geography", "geography_key"), ("mart_customer_overview", "geography_key", "dim_geography", "geography_key"), ("mart_product_review", "product_key", "dim_product", "product_key"),
    ("mart_seller_performance", "seller_key", "dim_seller", "seller_key"), ("mart_seller_performance", "geography_key", "dim_geography", "geography_key"),
]


@register(sql(" UNION ALL ".join(f"SELECT '{c}' AS child, '{k}' AS column_name, '{p}' AS parent, count(*) AS orphans FROM {c} WHERE {k} IS NOT NULL AND {k} NOT IN (SELECT {q} FROM {p})" for c, k, p, q in RELATIONSHIPS)))
def relationships(spark, sf_dir):
    """Rows of every child whose key no parent has; all 23 relationships, of relations that are read once."""
    return R.orphan_counts(models(spark, sf_dir), RELATIONSHIPS)


def _fingerprint_sql(name: str) -> str:
    kinds = dict(_columns(MODELS[name]))
    value = lambda c: f"{f'{c}::DECIMAL(38,6)' if kinds[c] == 'd' else c}::VARCHAR"
    text = lambda c: f"coalesce(strlen({value(c)})::VARCHAR || ':' || {value(c)}, '-')"
    half = lambda at: f"coalesce(sum(('0x' || substr(h, {at}, 13))::BIGINT), 0)::VARCHAR"
    rows = published_sql(model_sql(name), MODELS[name]).partition("\nSELECT ")[2]
    body = f"SELECT md5({' || '.join(map(text, sorted(kinds)))}) AS h FROM (SELECT {rows})"
    return f"SELECT '{name}' AS relation, count(*) AS row_count, sha256(concat_ws(':', count(*)::VARCHAR, {half(1)}, {half(14)})) AS content_hash FROM ({body})"


@register(sql(" UNION ALL ".join(map(_fingerprint_sql, MODELS))))
def relation_fingerprints(spark, sf_dir):
    """Row count and an order-free content hash of every published model."""
    m = models(spark, sf_dir)
    frames = []
    for name, columns in MODELS.items():
        rows = published(m[name], columns)
        exact = [F.col(c).cast("decimal(38,6)").alias(c) if k == "d" else F.col(c) for c, k in _columns(columns)]
        frames.append(R.fingerprint(rows.select(*exact), name))
    return reduce(DataFrame.unionByName, frames)


_DATASETS = ", ".join(f"'{n}'" for n in V.CONTRACTS)
_RUNS = f"""runs AS (SELECT [{_DATASETS}][i + 1] AS dataset_name, i, n, n // 2 AS new_rows, n - n // 2 AS other FROM (SELECT o_custkey % 9 AS i, count(*) AS n FROM orders GROUP BY 1))"""


@register(f"""WITH {_RUNS} SELECT dataset_name, CASE i WHEN 1 THEN 'RECON_SOURCE_DISPOSITION_MISMATCH' WHEN 2 THEN 'RECON_SOURCE_ARCHIVE_HASH_MISMATCH' WHEN 3 THEN 'RECON_RAW_ROW_MISMATCH,RECON_BRONZE_ROW_MISMATCH' WHEN 4 THEN 'RECON_RAW_R2_BYTES_MISMATCH'
  WHEN 5 THEN 'RECON_RAW_R2_HASH_MISMATCH' WHEN 6 THEN 'RECON_COPY_ROW_MISMATCH' WHEN 7 THEN 'RECON_BRONZE_DUPLICATE_EFFECT' ELSE '' END AS issues FROM runs""")
def snapshot_reconciliation(spark, sf_dir):
    """One run of all datasets, from the source's counts to the loaded rows, with a different fault in each of seven."""
    runs = table(spark, sf_dir, "orders").groupBy((F.col("o_custkey") % 9).cast("int").alias("i")).agg(F.count("*").alias("n"))
    i, n = F.col("i"), F.col("n")
    new = F.floor(n / 2)
    zero = F.lit(0).cast("bigint")
    sha = lambda what: F.sha2(F.concat(F.lit(what), i.cast("string")).cast("binary"), 256)
    raw = new + (i == 3).cast("int")
    stored = F.when(i == 3, new).otherwise(raw)
    inputs = runs.select(
        F.element_at(F.array(*map(F.lit, V.CONTRACTS)), i + 1).alias("dataset_name"), (n + (i == 1).cast("int")).alias("source_observed_rows"), new.alias("source_new_rows"), zero.alias("source_replay_rows"), (n - new).alias("source_duplicate_rows"), zero.alias("source_rejected_rows"), zero.alias("source_parse_failed_rows"),
        raw.alias("raw_rows"), (n * 100).alias("raw_bytes"), (n * 100 + (i == 4).cast("int")).alias("stored_bytes"), F.when(i == 8, zero).otherwise(raw + (i == 6).cast("int")).alias("loaded_rows"), stored.alias("bronze_rows"), (stored - (i == 7).cast("int")).alias("bronze_distinct_hashes"),
        sha("s").alias("source_sha256"), F.when(i == 2, sha("x")).otherwise(sha("s")).alias("archived_sha256"), sha("r").alias("raw_sha256"), F.when(i == 5, sha("x")).otherwise(sha("r")).alias("stored_sha256"), (i == 8).alias("loaded_before"),
    )
    return V.reconcile(inputs).select("dataset_name", F.array_join("issues", ",").alias("issues"))


@register("""WITH i AS (SELECT l_orderkey, l_linenumber, l_quantity > 1 AS ok, count(*) AS n FROM lineitem GROUP BY ALL)
SELECT 'order_items' AS dataset_name, sum(n)::BIGINT AS observed_rows, sum(n) FILTER (ok)::BIGINT AS accepted_rows, coalesce(sum(n) FILTER (NOT ok), 0)::BIGINT AS rejected_rows, (sum(n) FILTER (ok) - count(*) FILTER (ok))::BIGINT AS duplicate_rows, 'ROW_COUNT_MISMATCH,DUPLICATE_IDENTITY' AS file_errors FROM i""")
def file_verdict(spark, sf_dir):
    """Items as a file that declares a single row: its counts, and what is wrong with it as a whole."""
    at = F.date_format("l_shipdate", "yyyy-MM-dd HH:mm:ss")
    raw = table(spark, sf_dir, "lineitem").select(
        F.col("l_orderkey").cast("string").alias("order_id"), F.when(F.col("l_quantity") <= 1, "x").otherwise(F.col("l_linenumber").cast("string")).alias("order_item_id"), F.col("l_partkey").cast("string").alias("product_id"),
        F.col("l_suppkey").cast("string").alias("seller_id"), at.alias("shipping_limit_date"), F.lit("1.5").alias("price"), F.lit("0").alias("freight_value"),
    )
    return V.file_verdict(V.validate(raw, V.CONTRACTS["order_items"]), V.CONTRACTS["order_items"], 1).withColumn("file_errors", F.array_join("file_errors", ","))


_JSON = lambda dataset, key, fields, source: f"SELECT '{dataset}' AS dataset_name, {key} AS id, sha256('{{\"contract\":\"record-hash-v1\",\"dataset_name\":\"{dataset}\",\"values\":[' || concat_ws(',', {', '.join(f"'[\"{n}\",' || coalesce({v}, 'null') || ']'" for n, v in fields)}) || ']}}') AS record_hash FROM {source}"
_text = lambda c: f"to_json(nfc_normalize({c}))::VARCHAR"
_time = lambda c: f"'\"' || strftime({c}, '%Y-%m-%d %H:%M:%S') || '\"'"
_money = lambda c: f"'\"' || CASE WHEN contains(({c})::VARCHAR, '.') THEN rtrim(rtrim(({c})::VARCHAR, '0'), '.') ELSE ({c})::VARCHAR END || '\"'"
_ACCENT = "CASE WHEN review_comment_message IS NULL THEN NULL ELSE review_comment_message || 'e' || chr(769) END"


@register(
    sql(
        _JSON("order_reviews", "review_id", [("review_id", _text("review_id")), ("order_id", _text("order_id")), ("review_score", "review_score::VARCHAR"), ("review_comment_title", _text("review_comment_title")), ("review_comment_message", _text(_ACCENT)), ("review_creation_date", _time("review_creation_date")), ("review_answer_timestamp", _time("review_answer_timestamp"))], "b_reviews")
        + " UNION ALL "
        + _JSON("order_payments", "order_id", [("order_id", _text("order_id")), ("payment_sequential", "payment_sequential::VARCHAR"), ("payment_type", _text("payment_type")), ("payment_installments", "payment_installments::VARCHAR"), ("payment_value", _money("payment_value"))], "b_payments")
    )
)
def record_hashes(spark, sf_dir):
    """Canonical hashes of reviews, with accents that have to be composed, and payments, with decimals that have to be cut."""
    b = bronze(spark, sf_dir)
    reviews = b["order_reviews"].withColumn("review_comment_message", F.concat("review_comment_message", F.lit("é")))
    out = [(reviews, "order_reviews", "review_id"), (b["order_payments"], "order_payments", "order_id")]
    return reduce(DataFrame.unionByName, [df.select(F.lit(n).alias("dataset_name"), F.col(k).alias("id"), V.canonical_hash(V.CONTRACTS[n]).alias("record_hash")) for df, n, k in out])


@register("""SELECT 'RECONCILED' AS run_state, t.n AS source_rows, concat_ws(',', CASE WHEN t.k % 3 = 0 THEN 'RECONCILIATION_FAILED' END, CASE WHEN t.bad > 0.05 * t.n THEN 'QUARANTINE_RATE_HIGH' END, CASE WHEN t.k = 4 THEN 'TASK_ERRORS_PRESENT' END, CASE WHEN t.k = 1 THEN 'WAREHOUSE_CLEANUP_REQUIRED' END) AS alerts
FROM (SELECT l_linenumber AS k, count(*) AS n, count(*) FILTER (l_quantity <= l_linenumber) AS bad FROM lineitem GROUP BY 1) t""")
def ingestion_alerts(spark, sf_dir):
    k, n = F.col("l_linenumber"), F.count("*")
    runs = table(spark, sf_dir, "lineitem").groupBy(k).agg(n.alias("source_rows"), F.count_if(F.col("l_quantity") <= k).alias("quarantined_rows"))
    runs = runs.select("*", F.lit("RECONCILED").alias("run_state"), F.col("source_rows").alias("accepted_rows"), (F.col("source_rows") - (k % 3 == 0).cast("int")).alias("bronze_rows"), (k == 4).cast("int").alias("task_errors"), (k != 1).alias("suspended"))
    return V.alerts(runs).select("run_state", "source_rows", F.array_join("alerts", ",").alias("alerts"))


@register("""SELECT doc_id, CASE WHEN doc_id % 12 = 0 THEN 'valid' WHEN doc_id % 12 = 1 THEN 'valid' ELSE 'invalid' END AS verdict FROM documents""")
def response_validation(spark, sf_dir):
    """Responses with ten kinds of faults, and two that are right."""
    k = (F.col("doc_id") % 12).cast("int")
    aspects = F.when(k == 2, '[{"aspect":"delivery","sentiment":"mixed","confidence":0.5},{"aspect":"delivery","sentiment":"mixed","confidence":1}]').when(k == 3, '[{"aspect":"delivery","sentiment":"mixed"}]').when(k == 4, '[{"aspect":"speed","sentiment":"mixed","confidence":0}]').when(k == 1, "[]").otherwise('[{"aspect":"delivery","sentiment":"mixed","confidence":0.5}]')
    topics = F.when(k == 5, '["payment_experience","payment_experience"]').when(k == 6, '["weather"]').when(k == 1, "[]").otherwise('["payment_experience","other"]')
    summary = F.when(k == 7, " ").when(k == 8, "write to a.b@example.com").when(k == 9, "Order id: 7").otherwise("fine")
    payload = F.concat(
        F.lit('{"sentiment":"positive","confidence":'), F.when(k == 10, "1.5").otherwise("1"), F.lit(',"aspect_sentiments":'), aspects, F.lit(',"topics":'), topics, F.lit(',"summary":"'), summary, F.lit('","highlights":["ok"]'), F.when(k == 11, ',"more":1').otherwise(""), F.lit("}"),
    )
    out = A.validated_responses(table(spark, sf_dir, "documents").select("doc_id", payload.alias("payload")), "payload")
    return out.select("doc_id", F.when(F.col("response").isNull(), "invalid").otherwise("valid").alias("verdict"))


@register("""SELECT o_orderkey, CASE WHEN o_orderkey % 5 + 1 <= 2 THEN 'negative' WHEN o_orderkey % 5 + 1 = 3 THEN 'neutral' ELSE 'positive' END AS sentiment,
CASE WHEN o_orderkey % 3 = 0 THEN 'delivery:negative' WHEN o_orderkey % 3 = 1 AND o_orderkey % 5 + 1 >= 4 THEN 'delivery:positive' ELSE '' END AS aspects, CASE WHEN o_orderkey % 3 = 0 OR (o_orderkey % 3 = 1 AND o_orderkey % 5 + 1 >= 4) THEN 'delivery_speed' ELSE '' END AS topics FROM orders""")
def label_suggestions(spark, sf_dir):
    o = F.col("o_orderkey")
    label = A.suggested_labels(o % 5 + 1, F.element_at(F.array(*map(F.lit, ("delayed", "on_time", "unknown"))), (o % 3 + 1).cast("int")))
    x = table(spark, sf_dir, "orders").select("o_orderkey", label.alias("l"))
    aspects = F.array_join(F.transform("l.aspect_sentiments", lambda a: F.concat_ws(":", a["aspect"], a["sentiment"])), ",")
    return x.select("o_orderkey", F.col("l.sentiment").alias("sentiment"), aspects.alias("aspects"), F.array_join("l.topics", ",").alias("topics"))


@register("""WITH d AS (SELECT doc_id, lang, source, sha256(concat_ws(':', 'seed-2', doc_id::VARCHAR)) AS h FROM documents), r AS (SELECT *, row_number() OVER (PARTITION BY lang, source ORDER BY h, doc_id) AS k FROM d),
s AS (SELECT lang, source, count(*) AS n, sha256(concat_ws(':', 'seed-2', lang, source)) AS name FROM d GROUP BY ALL), t AS (SELECT *, row_number() OVER (ORDER BY name) AS turn, sum(n) OVER () AS total, count(*) OVER () AS strata FROM s),
x AS (SELECT r.doc_id, r.k, t.name, t.turn, t.strata, (t.n * 200)::DOUBLE / t.total - (r.k - 1) AS wanted FROM r JOIN t USING (lang, source))
SELECT doc_id FROM x WHERE k = 1 AND turn <= 200 UNION ALL SELECT doc_id FROM (SELECT doc_id, strata, row_number() OVER (ORDER BY wanted DESC, name DESC) AS place FROM x WHERE k > 1) WHERE place <= greatest(200 - strata, 0)""")
def stratified_annotation_sample(spark, sf_dir):
    return A.stratified_sample(table(spark, sf_dir, "documents").select("doc_id", "lang", "source"), "doc_id", ["lang", "source"], 200, "seed-2").select("doc_id")


_TOPIC_ROWS = f"SELECT doc_id, t, (doc_id * (i + 1)) % 4 = 0 AS a, (doc_id * (i + 2)) % 4 = 0 AS p FROM documents, (SELECT unnest(range(0, {len(A.TOPICS)})) AS i, unnest([{', '.join(map(repr, A.TOPICS))}]) AS t)"


@register(f"""WITH x AS ({_TOPIC_ROWS}), l AS (SELECT t, count(*) FILTER (a AND p) AS tp, count(*) FILTER (p AND NOT a) AS fp, count(*) FILTER (a AND NOT p) AS fn FROM x GROUP BY 1),
f AS (SELECT round(avg(2.0 * tp / nullif(2 * tp + fp + fn, 0)), 6) AS macro_f1, round(2.0 * sum(tp) / nullif(2 * sum(tp) + sum(fp) + sum(fn), 0), 6) AS micro_f1 FROM l)
SELECT macro_f1, micro_f1, CASE WHEN micro_f1 >= 0.75 THEN 'AI_QUALITY_GATE_PASSED' ELSE 'AI_TOPIC_MICRO_F1_BELOW_GATE' END AS codes, CASE WHEN micro_f1 >= 0.75 THEN 'PASSED' ELSE 'BLOCKED' END AS status FROM f""")
def set_label_f1(spark, sf_dir):
    """F1 of sets of topics, and the gate that they have to pass."""
    d = F.col("doc_id")
    labels = lambda k: F.array_compact(F.array(*[F.when((d * (i + k)) % 4 == 0, t) for i, t in enumerate(A.TOPICS)]))
    f1 = A.set_f1(table(spark, sf_dir, "documents").select(labels(1).alias("a"), labels(2).alias("p")), "a", "p")
    report = f1.select("*", F.lit(1.0).alias("sentiment_macro_f1"), F.lit(1.0).alias("aspect_macro_f1"), F.lit(1.0).alias("schema_pass_rate"), F.col("micro_f1").alias("topic_micro_f1"))
    return A.gate(report).select(F.round("macro_f1", 6).alias("macro_f1"), F.round("micro_f1", 6).alias("micro_f1"), F.array_join("codes", ",").alias("codes"), "status")


@register(sql("SELECT order_id, string_agg(DISTINCT c, ',' ORDER BY c) AS categories FROM (SELECT order_id, lower(trim(product_category_name)) AS c FROM b_items JOIN b_products USING (product_id)) WHERE c <> '' GROUP BY 1"))
def order_categories(spark, sf_dir):
    """The set of categories of each order."""
    b = bronze(spark, sf_dir)
    kinds = b["products"].select("product_id", F.lower(F.trim("product_category_name")).alias("c")).where("c <> ''")
    rows = b["order_items"].select("order_id", "product_id").join(kinds, "product_id").select("order_id", "c").distinct()
    return rows.groupBy("order_id").agg(F.array_join(F.array_sort(F.collect_list("c")), ",").alias("categories"))


@register("SELECT * FROM (VALUES " + ", ".join(f"('{n}', '{', '.join(d.identity)}', {str(d.unique).lower()}, {len(d.fields)}, {i})" for i, (n, d) in enumerate(V.CONTRACTS.items(), 1)) + ") t(source_name, expected_grain, is_unique, column_count, source_ordinal)")
def source_contract_registry(spark, sf_dir):
    rows = [(n, ", ".join(d.identity), d.unique, len(d.fields), i) for i, (n, d) in enumerate(V.CONTRACTS.items(), 1)]
    return spark.createDataFrame(rows, "source_name string, expected_grain string, is_unique boolean, column_count int, source_ordinal int")


RELATIONS = [("SILVER" if n.startswith("sil_") else "GOLD", n) for n in MODELS if n != "sil_dq_quarantine"]
_EXPECTED = ", ".join(f"('{layer}', '{name}', {i})" for i, (layer, name) in enumerate(RELATIONS))


@register(f"""WITH e AS (SELECT * FROM (VALUES {_EXPECTED}) t(layer, name, i)), x AS (SELECT r_regionkey AS r, i, r_regionkey <> 1 OR i % 5 <> 0 AS has_ref, CASE WHEN r_regionkey = 2 AND i = 3 THEN 'FAILED' WHEN r_regionkey = 3 AND i = 4 THEN NULL ELSE 'TEST_PASSED' END AS state FROM region, e)
SELECT r AS release_id, count(*) FILTER (has_ref) + CASE WHEN r = 4 THEN 1 ELSE 0 END AS object_ref_count, count(*) FILTER (has_ref) AS matched_count, count(*) FILTER (has_ref AND state = 'TEST_PASSED') AS passed_count, r = 0 AS eligible FROM x GROUP BY r""")
def release_eligibility(spark, sf_dir):
    """Five releases of 28 relations: one whole, one that lacks some, one with a failed and one with an untested relation, one with a foreign one."""
    expected = spark.createDataFrame([(layer, name, i) for i, (layer, name) in enumerate(RELATIONS)], "layer string, name string, i int")
    r, i = F.col("r_regionkey"), F.col("i")
    releases = table(spark, sf_dir, "region").select("r_regionkey")
    definitions = releases.select(r.alias("release_id"), F.explode(F.array(F.lit("SILVER"), F.lit("GOLD"))).alias("layer"), F.concat(F.lit("c"), r.cast("string")).alias("candidate_id"))
    grid = releases.crossJoin(expected)  # 5 x 28 rows
    own = grid.where((r != 1) | (i % 5 != 0)).select(r.alias("release_id"), "layer", "name", F.concat(F.lit("o"), F.col("name")).alias("object"))
    refs = own.unionByName(releases.where("r_regionkey = 4").select(r.alias("release_id"), F.lit("GOLD").alias("layer"), F.lit("foreign").alias("name"), F.lit("oforeign").alias("object")))
    event = lambda state, at: grid.where((r != 3) | (i != 4)).select(F.concat(F.lit("c"), r.cast("string")).alias("candidate_id"), "layer", F.concat(F.lit("o"), F.col("name")).alias("object"), state.alias("state"), F.lit(at).alias("event_at"), F.lit(at).alias("event_id"))
    last = F.when((r == 2) & (i == 3), "FAILED").otherwise("TEST_PASSED")
    return activation_eligibility(definitions, expected.drop("i"), refs, event(F.lit("BUILT"), 1).unionByName(event(last, 2)))


@register("""WITH c AS (SELECT DISTINCT o_custkey % 20 AS r FROM orders) SELECT r AS source_release_id, CASE WHEN r % 4 = 0 THEN 'NEW_CANDIDATE' WHEN r % 4 = 1 THEN 'REPLAY' ELSE 'CONFLICT' END AS disposition FROM c""")
def release_dispositions(spark, sf_dir):
    """Twenty releases: a quarter new, a quarter known, a quarter with another size of a file, and a quarter of which a file is not known."""
    files_ = table(spark, sf_dir, "orders").groupBy((F.col("o_custkey") % 20).alias("source_release_id"), F.col("o_orderpriority").alias("file_name")).agg(F.count("*").alias("n_bytes"), F.sha2(F.sum("o_orderkey").cast("string").cast("binary"), 256).alias("sha256"))
    r, first = F.col("source_release_id"), F.col("file_name").startswith("1")
    known = files_.where((r % 4 != 0) & ~((r % 4 == 3) & first)).withColumn("n_bytes", F.col("n_bytes") + ((r % 4 == 2) & first).cast("int"))
    return classify_releases(known, files_)
