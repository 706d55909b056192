"""Queries of file ingestion: files are written from the given tables, with faults planted by rules, and read back."""

from __future__ import annotations

import json
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from kelpline.functions.identities import source_object_id
from kelpline.operators import ingest, partitions, ranks, relational, vectors
from kelpline.operators import validate as V
from kelpline.plans import contracts, silver
from kelpline.plans.oracles import CTES, sql
from kelpline.registry import MODELS, READ_ONLY, model_sql, models, published, published_sql, register, release_models
from kelpline.sinks import loads
from kelpline.sinks.release import Releases, append_ledger, kept_in, shared_folder
from kelpline.sources import bounded_csv, files, landing, snapshots, stores
from kelpline.sources.commerce import RELEASE, bronze, rehashed, table

PAYMENTS = V.CONTRACTS["order_payments"]
_HEAD = ",".join(f.name for f in PAYMENTS.fields)

#: The lines of eight files of payments: some are rejected (a type that isn't allowed), some repeated, some known before; in files 1 and 5 a line has too few
#: fields, in 2 and 6 one has text behind a closing quote, and the header of file 7 is another.
_FILES = f"""WITH o AS (SELECT o_orderkey AS k, o_orderkey % 8 AS part, o_totalprice::DECIMAL(18,2) AS v FROM orders),
s AS (SELECT k, part, CASE WHEN part % 4 = 1 AND k % 101 = 60 THEN 'CSV_FIELD_COUNT_MISMATCH' WHEN part % 4 = 2 AND k % 103 = 59 THEN 'CSV_MALFORMED' WHEN k % 50 = 0 THEN 'VALUE_NOT_ALLOWED' END AS code, v FROM o),
l AS (SELECT *, CASE code WHEN 'CSV_FIELD_COUNT_MISMATCH' THEN k || ',1' WHEN 'CSV_MALFORMED' THEN '"a"b,1,voucher,1,1' ELSE (CASE WHEN k % 13 = 0 THEN '"' || k || chr(10) || 'é"' ELSE k::VARCHAR END) || ',1,' ||
  (CASE WHEN code IS NULL THEN 'voucher' ELSE 'cash' END) || ',' || (k % 10 + 1) || ',' || v END AS line FROM s),
f AS (SELECT *, 1 AS nth FROM l UNION ALL SELECT *, 2 FROM l WHERE k % 11 = 0),
r AS (SELECT *, row_number() OVER (PARTITION BY part ORDER BY k, nth) + 1 AS source_row_number, strlen(line) AS n, {len(_HEAD) + 1} + coalesce(sum(strlen(line) + 1) OVER (PARTITION BY part ORDER BY k, nth ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS byte_start FROM f),
c AS (SELECT part, min(source_row_number) FILTER (code LIKE 'CSV_%') AS cut FROM r GROUP BY part),
x AS (SELECT r.*, CASE WHEN code LIKE 'CSV_%' THEN 'PARSE_FAILED' WHEN code IS NOT NULL THEN 'REJECTED' WHEN nth = 2 THEN 'DUPLICATE' WHEN k % 7 = 0 THEN 'REPLAY' ELSE 'NEW' END AS disposition
  FROM r JOIN c USING (part) WHERE part <> 7 AND (cut IS NULL OR source_row_number <= cut)
  UNION ALL SELECT DISTINCT NULL::BIGINT, 7, 'CSV_HEADER_MISMATCH', NULL::DECIMAL(18,2), '', 1, 1, 0, 0::BIGINT, 'FILE_FAILED' FROM r WHERE part = 7)
"""


def _processed(spark: SparkSession, sf_dir: str) -> DataFrame:
    at = shared_folder(spark, "files")
    k, part = F.col("k"), F.col("part")
    s = table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("k"), (F.col("o_orderkey") % 8).alias("part"), F.col("o_totalprice").cast("decimal(18,2)").cast("string").alias("v"))
    text = lambda c: c.cast("string")
    name = F.when(k % 13 == 0, F.concat(F.lit('"'), text(k), F.lit('\né"'))).otherwise(text(k))
    kind = F.when(k % 50 == 0, "cash").otherwise("voucher")
    line = (
        F.when((part % 4 == 1) & (k % 101 == 60), F.concat(text(k), F.lit(",1"))).when((part % 4 == 2) & (k % 103 == 59), F.lit('"a"b,1,voucher,1,1'))
        .otherwise(F.concat(name, F.lit(",1,"), kind, F.lit(","), text(k % 10 + 1), F.lit(","), F.col("v")))
    )
    lines = s.select(k, part, line.alias("value"))
    heads = s.select(part).distinct().select(F.lit(None).cast("bigint").alias("k"), part, F.when(part == 7, "other").otherwise(_HEAD).alias("value"))
    every = lines.unionByName(lines.where(k % 11 == 0)).unionByName(heads)
    # a file is one task's; Spark would join small ones. The numbers of these eight files are apart mod 45 as Spark hashes them
    every.repartition(45, "part").sortWithinPartitions("part", F.col("k").asc_nulls_first()).drop("k").write.partitionBy("part").text(f"{at}/source")
    # what was accepted before: the same values, some in another spelling
    old = s.where(k % 7 == 0).select(F.regexp_replace(name, '"', "").alias("order_id"), F.lit("+1").alias("payment_sequential"), F.lit("voucher").alias("payment_type"), text(k % 10 + 1).alias("payment_installments"), F.concat(F.col("v"), F.lit("0")).alias("payment_value"))
    history = V.validate(old, PAYMENTS).select(V.canonical_hash(PAYMENTS).alias("record_hash"))
    records = bounded_csv.read(spark, f"{at}/source", PAYMENTS, kept_in(spark, at), pattern="part-*")
    return ingest.processed(records, PAYMENTS, history)


def _part() -> Column:
    return F.regexp_extract("source_file", "part=([0-9]+)", 1).cast("bigint").alias("part")


@register(f"""{_FILES} SELECT part, count(*) FILTER (source_row_number >= 2) AS observed_rows, count(*) FILTER (disposition = 'NEW') AS new_rows, count(*) FILTER (disposition = 'REPLAY') AS replay_rows,
  count(*) FILTER (disposition = 'DUPLICATE') AS duplicate_rows, count(*) FILTER (disposition = 'REJECTED') AS rejected_rows, count(*) FILTER (disposition = 'PARSE_FAILED') AS parse_failed_rows,
  count(*) FILTER (disposition IN ('PARSE_FAILED', 'FILE_FAILED')) AS file_failures, CASE WHEN count(*) FILTER (disposition NOT IN ('NEW', 'REPLAY')) > 0 THEN 'QUARANTINED' ELSE 'VALIDATED' END AS status FROM x GROUP BY part""")
def file_processing(spark, sf_dir):
    """The report of each file: what was observed is explained, and nothing behind a structural fault was."""
    return ingest.reports(_processed(spark, sf_dir)).select(_part(), *[f"{n}_rows" for n in ("observed", "new", "replay", "duplicate", "rejected", "parse_failed")], "file_failures", "status")


@register(f"""{_FILES}, q AS (SELECT *, 'srcobj_' || sha256('{{"fields":{{"file_name":"' || part || '","source_object_sha256":"digest","source_release_id":"{RELEASE}"}},"kind":"source_object","version":"ingestion-id-v1"}}') AS o,
  CASE WHEN disposition IN ('PARSE_FAILED', 'FILE_FAILED') THEN NULL ELSE byte_start + n END AS e FROM x WHERE disposition NOT IN ('NEW', 'REPLAY'))
SELECT part, source_row_number, byte_start, e AS byte_end, CASE WHEN disposition = 'DUPLICATE' THEN 'DUPLICATE_RECORD' ELSE code END AS error_code,
  CASE disposition WHEN 'DUPLICATE' THEN 'order_id,payment_sequential' WHEN 'REJECTED' THEN 'payment_type' ELSE '' END AS error_columns,
  o || CASE WHEN e IS NULL THEN '#row=' || source_row_number ELSE '#bytes=' || byte_start || ':' || e END AS raw_reference,
  CASE WHEN e IS NOT NULL THEN 'record_' || sha256('{{"fields":{{"byte_end":' || e || ',"byte_start":' || byte_start || ',"source_object_id":"' || o || '","source_row_number":' || source_row_number || '}},"kind":"record","version":"ingestion-id-v1"}}') END AS record_id,
  CASE WHEN e IS NOT NULL THEN sha256('{{"order_id":"' || k || (CASE WHEN k % 13 = 0 THEN '\\né' ELSE '' END) || '","payment_installments":"' || (k % 10 + 1) || '","payment_sequential":"1","payment_type":"' || (CASE WHEN code IS NULL THEN 'voucher' ELSE 'cash' END) || '","payment_value":"' || v || '"}}') END AS payload_sha256
FROM q""")
def file_quarantine(spark, sf_dir):
    """What was not accepted, each with its place in the file, its id and its codes."""
    rows = _processed(spark, sf_dir)
    found = ingest.quarantine_rows(rows, PAYMENTS, source_object_id(F.lit(RELEASE), F.regexp_extract("source_file", "part=([0-9]+)", 1), F.lit("digest")))
    return found.select(_part(), "source_row_number", "byte_start", "byte_end", "error_code", F.array_join("error_columns", ",").alias("error_columns"), "raw_reference", "record_id", F.sha2(F.col("raw_payload").cast("binary"), 256).alias("payload_sha256"))


# -- one release and batch of several

LATER = "release-2"


def _two_releases(spark: SparkSession, sf_dir: str):
    """All models of a second release, which lacks a third of the orders with their items; the first lies in the same folders."""
    folder, sources = shared_folder(spark, "two-releases"), bronze(spark, sf_dir)
    kept = F.col("order_id").try_cast("bigint") % 3 != 1
    later = sources | {n: sources[n].where(kept) for n in ("orders", "order_items")}
    batches = {release: landing.batch_of(spark, release) for release in (RELEASE, LATER)}

    def relation(name: str) -> DataFrame:
        for release, frames in ((RELEASE, sources), (LATER, later)):
            landing.land({name: frames[name].drop("record_hash")}, f"{folder}/bronze", release, batches[release])
        return rehashed(landing.landed(spark, f"{folder}/bronze", [name], LATER, batches[LATER])[name])

    return release_models(spark, silver.Lazy({n: lambda _, n=n: relation(n) for n in sources}), f"{folder}/models", LATER)


def _of_later(name: str) -> str:
    """The model's SQL over the second release."""
    text = published_sql(model_sql(name, LATER), MODELS[name]).replace(f"'{RELEASE}'", f"'{LATER}'")
    for relation in ("b_orders", "b_items"):
        text = text.replace(f"{relation} AS ({CTES[relation]})", f"{relation} AS (SELECT * FROM ({CTES[relation]}) WHERE order_id::BIGINT % 3 <> 1)")
    return text


for _model_name in ("sil_order_item", "fact_order", "mart_seller_performance"):

    def _query(spark, sf_dir, name=_model_name):
        return published(_two_releases(spark, sf_dir)[name], MODELS[name])

    _query.__name__ = f"release_{_model_name}"
    register(_of_later(_model_name))(_query)


@register(sql(" UNION ALL ".join(f"SELECT '{n}' AS model, count(*) AS n_rows, 0::BIGINT AS repeated, '{contracts.Model.version(n)}' AS model_contract_version FROM {n}" for n in contracts.MODELS if n in MODELS)))
def model_contracts(spark, sf_dir):
    """Every model with its contract's version, its rows and the grains that it repeats; nulls and conditions were checked as it was written, or
    are now that all its columns are read."""
    m = models(spark, sf_dir)
    return reduce(DataFrame.unionByName, [contracts.measured(n, m[n], n in READ_ONLY) for n in contracts.MODELS if n in MODELS])


# -- roll-ups of invocations

_STATE = "CASE WHEN event_id % 20 = 0 THEN 'FAILED' WHEN event_id % 21 = 0 THEN 'QUARANTINED' ELSE 'SUCCEEDED' END"
_CODE = "CASE WHEN event_id % 20 = 0 THEN 'PROVIDER_TIMEOUT_' || user_id % 3 WHEN event_id % 21 = 0 THEN 'SCHEMA_INVALID' END"


@register(f"""WITH c AS (SELECT event_type, {_STATE} AS state, {_CODE} AS code, user_id AS i, event_id % 1000 AS o, value::DECIMAL(18,2) AS v FROM events),
e AS (SELECT event_type, string_agg(code || '=' || n, ',' ORDER BY code) AS errors FROM (SELECT event_type, code, count(*) AS n FROM c WHERE code IS NOT NULL GROUP BY ALL) GROUP BY 1)
SELECT event_type, count(*) AS invocations, count(*) FILTER (state = 'SUCCEEDED') AS succeeded_invocations, count(*) FILTER (state = 'FAILED') AS failed_invocations, count(*) FILTER (state = 'QUARANTINED') AS quarantined_invocations,
  sum(i)::BIGINT AS total_input_tokens, sum(o)::BIGINT AS total_output_tokens, sum(v)::DOUBLE AS total_cost, sum(v)::DOUBLE AS total_latency, quantile_disc(v, 0.95)::DOUBLE AS p95_latency, max(errors) AS errors FROM c JOIN e USING (event_type) GROUP BY 1""")
def invocation_rollup(spark, sf_dir):
    """Events as invocations: what became of them, their tokens, cost, latency and errors, reconciled with a ledger that is counted apart."""
    v = F.col("value").cast("decimal(18,2)")
    state, code = F.expr(_STATE), F.expr(_CODE)
    e = table(spark, sf_dir, "events").select("event_type", F.col("event_id").alias("invocation_id"), state.alias("state"), F.col("user_id").alias("input_tokens"), (F.col("event_id") % 1000).alias("output_tokens"), v.alias("cost"), v.alias("latency"), code.alias("error_code"))
    ledger = table(spark, sf_dir, "events").groupBy("event_type").agg(F.count_if((F.col("event_id") % 20 != 0) & (F.col("event_id") % 21 != 0)).alias("valid_count"), F.sum(v).alias("committed"))
    r = ranks.reconciled(ranks.invocation_rollup(e, ["event_type"], kept_in(spark, shared_folder(spark, "rollup"))), ledger, ["event_type"])
    errors = F.array_join(F.transform("errors", lambda x: F.concat(x["code"], F.lit("="), x["n"].cast("string"))), ",")
    return r.select("event_type", "invocations", *[f"{s}_invocations" for s in ("succeeded", "failed", "quarantined")], "total_input_tokens", "total_output_tokens", *[F.col(c).cast("double").alias(c) for c in ("total_cost", "total_latency", "p95_latency")], errors.alias("errors"))


@register("SELECT l_returnflag, l_linestatus, quantile_disc(l_extendedprice::DECIMAL(18,2), 0.5)::DOUBLE AS median_price FROM lineitem GROUP BY ALL")
def exact_medians(spark, sf_dir):
    """The exact median of very large groups, by ranges."""
    rows = table(spark, sf_dir, "lineitem").select("l_returnflag", "l_linestatus", F.col("l_extendedprice").cast("decimal(18,2)").alias("v"))
    found = ranks.nearest_ranks(rows, ["l_returnflag", "l_linestatus"], "v", "0.5", kept_in(spark, shared_folder(spark, "ranks")), "median_price")
    return found.withColumn("median_price", F.col("median_price").cast("double"))


# -- snapshots of files

_NAMED = "seller_id,seller_name"
_SNAPSHOT = f"""WITH s AS (SELECT s_nationkey AS n, s_suppkey AS k, s_name AS v FROM supplier),
f AS (SELECT n, 'nation_' || n || '.csv' AS file_name, CASE n % 8 WHEN 3 THEN 'other' WHEN 7 THEN repeat('x', 70000) ELSE '{_NAMED}' END || chr(10) || string_agg(k || ',' || v || chr(10), '' ORDER BY k) AS body FROM s GROUP BY n)
"""


def _seller_files(spark: SparkSession, sf_dir: str, at: str) -> DataFrame:
    """A file of sellers for each nation, with what stores.identities says of it and its name in a snapshot."""
    n = F.col("n")
    s = table(spark, sf_dir, "supplier").select(F.col("s_nationkey").alias("n"), F.col("s_suppkey").alias("k"), F.concat(F.col("s_suppkey").cast("string"), F.lit(","), "s_name").alias("value"))
    heads = s.select(n).distinct().select(n, F.lit(None).cast("bigint").alias("k"), F.when(n % 8 == 3, "other").when(n % 8 == 7, F.repeat(F.lit("x"), F.lit(70_000))).otherwise(_NAMED).alias("value"))
    s.unionByName(heads).repartition("n").sortWithinPartitions("n", F.col("k").asc_nulls_first()).drop("k").write.partitionBy("n").text(f"{at}/written")
    found = stores.identities(spark, f"{at}/written", "part-*")
    nation = F.regexp_extract("path", "n=([0-9]+)", 1)
    return found.select("path", F.concat(F.lit("nation_"), nation, F.lit(".csv")).alias("file_name"), "n_bytes", "sha256", nation.cast("int").alias("n"))


@register(f"""{_SNAPSHOT} SELECT file_name, CASE WHEN n % 8 <> 5 THEN strlen(body) END AS n_bytes, CASE WHEN n % 8 <> 5 THEN sha256(body) END AS sha256,
  [NULL, 'FILE_SIZE_MISMATCH', 'FILE_CHECKSUM_MISMATCH', 'HEADER_MISMATCH', 'MANIFEST_FILE_SET_MISMATCH', 'MISSING_REQUIRED_FILE', 'EXTRA_SOURCE_ENTRY', 'HEADER_INVALID'][n % 8 + 1] AS code FROM f""")
def source_discovery(spark, sf_dir):
    """Files against their manifest and contract, each with the first code that holds: one of each fault is planted, by nation."""
    at = shared_folder(spark, "discovery")
    files = kept_in(spark, at)("files", _seller_files(spark, sf_dir, at))
    snapshots.commit(files.where("n % 8 <> 5"), at, "r1")
    names = files.collect()  # a row a file
    contract = snapshots.Contract({r.file_name: _NAMED.split(",") for r in names if r.n % 8 != 6})
    said = [{"filename": r.file_name, "rows": 1, "bytes": r.n_bytes + (r.n % 8 == 1), "sha256": "0" * 64 if r.n % 8 == 2 else r.sha256} for r in names if r.n % 8 != 4]
    texts = {"schema_version": "1", "manifest_version": contract.manifest_version, "contract_version": contract.contract_version, "data_class": "public", "source": "sellers", "source_contract": contract.source_contract}
    snapshots.put(spark, f"{at}/source/r1/{snapshots.MANIFEST}", json.dumps(texts | {"files": said}).encode())
    return snapshots.discovered(spark, f"{at}/source/r1", contract).select("file_name", "n_bytes", "sha256", "code")


@register(f"{_SNAPSHOT} SELECT file_name, strlen(body) AS n_bytes, sha256(body) AS sha256, CASE WHEN n % 3 = 0 THEN 'UPLOADED' ELSE 'REPLAYED' END AS outcome FROM f")
def source_commit(spark, sf_dir):
    """A commit that was cut off before the files of every third nation goes on with these, and is then read back through its manifest."""
    at = shared_folder(spark, "commit")
    keep = kept_in(spark, at)
    files = keep("files", _seller_files(spark, sf_dir, at))
    keep("first", snapshots.copied(files.where("n % 3 <> 0"), f"{at}/source/r1"))
    again = keep("again", snapshots.copied(files, f"{at}/source/r1"))
    snapshots.commit(files, at, "r1")
    return snapshots.committed(spark, at, "r1").join(again.select("file_name", "outcome"), "file_name").select("file_name", "n_bytes", "sha256", "outcome")


# -- exact partitions, strict histories, two builds, files of different headers

_PARTS = [("fact_order", "sil_order", ["order_id"]), ("fact_order_item", "sil_order_item", ["order_id", "order_item_id"]), ("fact_payment", "sil_order_payment", ["order_id", "payment_sequential"]), ("fact_review_base", "sil_order_review", ["review_id", "order_id"])]
_LEFT_OUT = {
    "fact_order": "analysis_scope_status = 'QUARANTINED'", "fact_order_item": "NOT order_parent_exists OR amount_quality_status <> 'VALID' OR order_id NOT IN (SELECT order_id FROM fact_order)",
    "fact_payment": "NOT order_parent_exists OR amount_quality_status <> 'VALID' OR order_id NOT IN (SELECT order_id FROM fact_order)",
    "fact_review_base": "NOT order_parent_exists OR NOT response_interval_valid OR review_score NOT BETWEEN 1 AND 5 OR order_id NOT IN (SELECT order_id FROM fact_order)",
}


@register(sql(" UNION ALL ".join(f"SELECT '{f}' AS fact, (SELECT count(*) FROM {s}) AS source_count, (SELECT count(*) FROM {f}) AS fact_count, (SELECT count(*) FROM {s} WHERE {_LEFT_OUT[f]}) AS excluded_count" for f, s, _ in _PARTS)))
def fact_partitions(spark, sf_dir):
    """Every classified row is in its fact table or explained as left out, once and in one of them; else the query fails."""
    m, out = models(spark, sf_dir), []
    orders = m["fact_order"].select("order_id", F.lit(True).alias("in_facts"))
    for fact, source, key in _PARTS:
        s = m[source]
        if fact == "fact_order":
            gone = s.where("analysis_scope_status = 'QUARANTINED'")
        else:
            ok = F.col("order_parent_exists") & F.col("in_facts").isNotNull()
            ok = ok & (F.col("response_interval_valid") & F.col("review_score").between(1, 5) if fact == "fact_review_base" else F.col("amount_quality_status") == "VALID")
            gone = s.join(orders, "order_id", "left").where(~ok)
        out.append(partitions.partition_result(s, m[fact], gone, key).select(F.lit(fact).alias("fact"), "*"))
    return reduce(DataFrame.unionByName, out)


@register("""WITH s AS (SELECT l_orderkey AS k, l_linenumber AS n FROM lineitem), a AS (SELECT * FROM s WHERE n <= 3), b AS (SELECT k, CASE WHEN k % 50 = 0 THEN n + 100 ELSE n END AS n FROM s WHERE n >= 3 AND n <> 5 UNION ALL SELECT k, n FROM s WHERE n = 6),
c AS (SELECT k, n, sum(x) AS x, sum(y) AS y, sum(z) AS z FROM (SELECT *, 1 AS x, 0 AS y, 0 AS z FROM s UNION ALL SELECT *, 0, 1, 0 FROM a UNION ALL SELECT *, 0, 0, 1 FROM b) GROUP BY ALL),
i AS (SELECT concat_ws('+', CASE WHEN x > 0 AND y + z = 0 THEN 'GAP' END, CASE WHEN x = 0 THEN 'STRANGER' END, CASE WHEN y > 0 AND z > 0 THEN 'OVERLAP' END, CASE WHEN x > 1 OR y > 1 OR z > 1 THEN 'REPEATED' END) AS issues, k FROM c)
SELECT issues, count(*) AS n, sum(k)::BIGINT AS ids FROM i WHERE issues <> '' GROUP BY 1""")
def partition_faults(spark, sf_dir):
    """Items in two parts that overlap, leave some out, repeat some and have strangers: one shuffle tells which."""
    s = table(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("k"), F.col("l_linenumber").cast("bigint").alias("n"))
    moved = s.where("n >= 3 and n <> 5").select("k", F.when(F.col("k") % 50 == 0, F.col("n") + 100).otherwise(F.col("n")).alias("n"))
    found = partitions.partition_issues(s, {"a": s.where("n <= 3"), "b": moved.unionByName(s.where("n = 6"))}, ["k", "n"])
    return found.groupBy(F.array_join("issues", "+").alias("issues")).agg(F.count("*").alias("n"), F.sum("k").alias("ids"))


@register("""WITH v AS (SELECT user_id, ts AS effective_from, lead(ts) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS effective_to, event_id FROM (SELECT * FROM events QUALIFY row_number() OVER (PARTITION BY user_id, ts ORDER BY event_id) = 1)),
o AS (SELECT o_orderkey, CASE WHEN o_custkey % 3 <> 0 THEN o_custkey % 150 END AS u, o_orderdate + INTERVAL 9000 DAY AS moment FROM orders)
SELECT o_orderkey, coalesce(event_id, -1) AS version FROM o LEFT JOIN v ON user_id = u AND moment >= effective_from AND moment < coalesce(effective_to, TIMESTAMP '9999-12-31')""")
def asof_strict(spark, sf_dir):
    """As asof_versions, over a history that would fail if its ranges overlapped, with orders and versions that have no user."""
    e = table(spark, sf_dir, "events").groupBy("user_id", "ts").agg(F.min("event_id").alias("version"))
    h = e.select("user_id", "version", F.col("ts").alias("effective_from"), F.lead("ts").over(Window.partitionBy("user_id").orderBy("ts")).alias("effective_to"))
    h = h.unionByName(h.where("version % 10 = 0").withColumn("user_id", F.lit(None).cast("bigint")))
    o = table(spark, sf_dir, "orders").select("o_orderkey", F.when(F.col("o_custkey") % 3 != 0, F.col("o_custkey") % 150).alias("user_id"), (F.col("o_orderdate") + F.expr("interval 9000 days")).alias("at"))
    return relational.join_as_of_sorted(o, h, "user_id", "at", "version", F.lit(-1).cast("bigint"), refuse=True).select("o_orderkey", "version")


@register(sql(" UNION ALL ".join(f"SELECT '{n}' AS relation, count(*) AS row_count, NULL::VARCHAR AS issue FROM {n}" for n in contracts.MODELS if n in MODELS)))
def build_equivalence(spark, sf_dir):
    """A full refresh against a replay of the same release in other partitions: every relation with its rows and, if they differ, how."""
    folder, sources = shared_folder(spark, "replay"), bronze(spark, sf_dir)
    batch = landing.batch_of(spark, RELEASE)
    # dealt by another column than the builders use, in as many partitions as the session has
    landing.land({n: df.drop("record_hash").repartition(F.xxhash64(*df.columns[:3])) for n, df in sources.items()}, f"{folder}/bronze", RELEASE, batch)
    landed = landing.landed(spark, f"{folder}/bronze", list(sources), RELEASE, batch)
    replay = release_models(spark, {n: rehashed(df) for n, df in landed.items()}, f"{folder}/models", RELEASE)
    names, first = [n for n in contracts.MODELS if n in MODELS], models(spark, sf_dir)
    prints = lambda m: reduce(DataFrame.unionByName, [relational.fingerprint(m[n], n) for n in names])
    keep = kept_in(spark, f"{folder}/prints")
    a, b = keep("full", prints(first)), keep("replay", prints(replay))
    return a.select("relation", "row_count").join(relational.compare_fingerprints(a, b), "relation", "left")


@register("""WITH o AS (SELECT o_orderkey AS k, o_orderkey % 4 AS part, row_number() OVER (PARTITION BY o_orderkey % 4 ORDER BY o_orderkey) + 1 AS source_row_number FROM orders)
SELECT part, source_row_number, k::VARCHAR AS order_id, CASE WHEN part <> 2 AND k % 3 = 0 THEN NULL WHEN part <> 2 AND k % 5 = 0 THEN NULL ELSE 'name, "' || k || '"' END AS label FROM o""")
def header_subsets(spark, sf_dir):
    """Files whose headers have the wanted columns in four orders, among others; '' and NA are null."""
    at, k, part = shared_folder(spark, "subsets"), F.col("k"), F.col("part")
    o = table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("k"), (F.col("o_orderkey") % 4).alias("part"))
    key = k.cast("string")
    label = F.concat(F.lit('"name, ""'), key, F.lit('"""'))
    label = F.when((part != 2) & (k % 3 == 0), "NA").when((part != 2) & (k % 5 == 0), "").otherwise(label)
    line = F.when(part == 0, F.concat_ws(",", key, label)).when(part == 1, F.concat_ws(",", F.lit("x"), label, key)).when(part == 2, F.concat_ws(",", label, F.lit(""), key, F.lit("y"))).otherwise(F.concat_ws(",", key, F.lit('"a\nb"'), label))
    heads = o.select(part).distinct().select(F.lit(None).cast("bigint").alias("k"), part, F.element_at(F.array(*map(F.lit, ("order_id,label", "more,label,order_id", "label,a,order_id,b", "order_id,c,label"))), (part + 1).cast("int")).alias("value"))
    lines = o.select(k, part, line.alias("value")).unionByName(heads)
    lines.repartition("part").sortWithinPartitions("part", F.col("k").asc_nulls_first()).drop("k").write.partitionBy("part").text(f"{at}/source")
    return bounded_csv.subset_records(spark, f"{at}/source", ["order_id", "label"], kept_in(spark, at), pattern="part-*").select(_part(), "source_row_number", "order_id", "label")


# -- loads, gates and alerts of real runs, and a table of vectors


@register("SELECT s_nationkey::VARCHAR AS object_key, CASE WHEN s_nationkey % 2 = 0 THEN 'REPLAY_SKIPPED' ELSE 'LOADED' END AS status, CASE WHEN s_nationkey % 2 = 0 THEN 0 ELSE count(*) END AS rows_parsed, CASE WHEN s_nationkey % 2 = 0 THEN 0 ELSE count(*) END AS rows_loaded, count(*) AS rows_there FROM supplier GROUP BY s_nationkey")
def bulk_loads(spark, sf_dir):
    """Objects of suppliers, half of them loaded before: these are skipped, and each row is in the table once."""
    at = shared_folder(spark, "loads")
    keep = kept_in(spark, at)
    rows = table(spark, sf_dir, "supplier").select("s_suppkey", "s_name", F.col("s_nationkey").cast("string").alias("object_key"), F.sha2(F.col("s_nationkey").cast("string").cast("binary"), 256).alias("object_sha256"))
    loads.load_objects(rows.where("object_key % 2 = 0"), f"{at}/target", f"{at}/ledger")
    report = keep("report", loads.load_objects(rows, f"{at}/target", f"{at}/ledger"))
    there = loads.loaded_rows(spark, rows, f"{at}/target").groupBy("object_key").agg(F.count("*").alias("rows_there"))
    return report.join(there, "object_key")


_FINDINGS = "SELECT severity, model, code, count(*) AS n FROM sil_dq_quarantine GROUP BY ALL"


@register(sql(f"""SELECT *, sha256('{{"contract_version":"{V.DQ_VERSION}","findings":[' || names || '],"status":"' || status || '"}}') AS fingerprint FROM (
  SELECT CASE WHEN critical_failures > 0 THEN 'BLOCKED' WHEN rules > 0 THEN 'PASS_WITH_FINDINGS' ELSE 'PASS' END AS status, critical_failures, warn_failures, quarantine_failures, names FROM (
  SELECT count(*) AS rules, coalesce(sum(n) FILTER (severity = 'CRITICAL'), 0)::BIGINT AS critical_failures, coalesce(sum(n) FILTER (severity = 'WARN'), 0)::BIGINT AS warn_failures, coalesce(sum(n) FILTER (severity = 'QUARANTINE'), 0)::BIGINT AS quarantine_failures,
    coalesce(string_agg(name, ',' ORDER BY name), '') AS names FROM (SELECT *, '["' || severity || '","' || model || '","' || code || '","' || n || '"]' AS name FROM ({_FINDINGS}))))""").replace("SELECT *, sha256('{\"contract", "SELECT * EXCLUDE names, sha256('{\"contract"))
def quality_gate(spark, sf_dir):
    """The gate over all findings of the classified tables, with a fingerprint that a release can name."""
    findings = models(spark, sf_dir)["sil_dq_quarantine"].groupBy("severity", "model", "code").agg(F.count("*").alias("n"))
    return V.quality_gate(findings, ["model", "code"])


@register(f"""{_FILES}, runs AS (SELECT part, count(*) FILTER (source_row_number >= 2) AS source_rows, count(*) FILTER (disposition = 'NEW') AS accepted_rows, count(*) FILTER (disposition IN ('DUPLICATE', 'REJECTED', 'PARSE_FAILED', 'FILE_FAILED')) AS quarantined_rows,
  count(*) FILTER (disposition IN ('PARSE_FAILED', 'FILE_FAILED')) AS task_errors FROM x GROUP BY part)
SELECT part, source_rows, accepted_rows, CASE WHEN part = 4 THEN 0 ELSE accepted_rows END AS bronze_rows, quarantined_rows, task_errors, concat_ws(',', CASE WHEN task_errors > 0 OR part = 4 AND accepted_rows > 0 THEN 'RECONCILIATION_FAILED' END,
  CASE WHEN quarantined_rows > 0.05 * source_rows THEN 'QUARANTINE_RATE_HIGH' END, CASE WHEN task_errors > 0 THEN 'TASK_ERRORS_PRESENT' END) AS alerts FROM runs""")
def file_alerts(spark, sf_dir):
    """Alerts of a run over real files: counts of what was read, written and read back. The rows of file 4 were not written."""
    at = shared_folder(spark, "alerts")
    keep = kept_in(spark, at)
    rows = keep("processed", _processed(spark, sf_dir))
    raw = keep("raw", ingest.raw_rows(rows, PAYMENTS).where(~F.col("source_file").contains("part=4/")))
    held = keep("quarantine", ingest.quarantine_rows(rows, PAYMENTS, F.lit("object")))
    n = lambda df, name: df.groupBy("source_file").agg(F.count("*").alias(name))
    r = ingest.reports(rows).select("source_file", F.col("observed_rows").alias("source_rows"), F.col("new_rows").alias("accepted_rows"), F.col("file_failures").alias("task_errors"))
    r = r.join(n(raw, "bronze_rows"), "source_file", "left").join(n(held, "quarantined_rows"), "source_file", "left").na.fill(0)
    runs = r.withColumns({"run_state": F.when(F.col("task_errors") > 0, "FAILED").otherwise("RECONCILED"), "suspended": F.lit(True)})
    return V.alerts(runs).select(_part(), "source_rows", "accepted_rows", "bronze_rows", "quarantined_rows", "task_errors", F.array_join("alerts", ",").alias("alerts"))


@register("""WITH n AS (SELECT vec_id, list_transform(embedding, lambda x: x::DOUBLE * 2) AS e, 'R' || label % 2 AS r FROM embeddings WHERE vec_id % 5 = 0),
v AS (SELECT vec_id, list_transform(embedding, lambda x: x::DOUBLE) AS e, 'R' || label % 2 AS r FROM embeddings WHERE vec_id % 5 <> 0 UNION ALL SELECT * FROM n)
SELECT vec_id, round(list_sum(list_transform(range(1, 65), lambda i: (e[i] - 0.25) ** 2)), 6) AS distance FROM v WHERE r = 'R1' ORDER BY 2, vec_id LIMIT 20""")
def vector_upsert_search(spark, sf_dir):
    """A fifth of the vectors is replaced by an upsert; then the nearest of one release are found."""
    e = table(spark, sf_dir, "embeddings").select("vec_id", F.transform("embedding", lambda x: x.cast("double")).alias("embedding"), F.concat(F.lit("R"), (F.col("label") % 2).cast("string")).alias("data_release_id"), F.lit("v1").alias("index_version"), F.lit("reviews").alias("source_table"))
    batch = e.where("vec_id % 5 = 0").withColumn("embedding", F.transform("embedding", lambda x: x * 2))
    found = vectors.search(vectors.upserted(e, batch, "v1"), [0.25] * 64, 20, {"data_release_id": "R1", "index_version": "v1", "source_table": "reviews"})
    return found.select("vec_id", F.round("distance", 6).alias("distance"))


@register("""WITH l AS (SELECT o_custkey AS c, count(*) AS lifetime FROM orders GROUP BY 1), o AS (SELECT CASE WHEN c % 10 <> 0 THEN c END AS c, lifetime FROM orders JOIN l ON o_custkey = c WHERE month(o_orderdate) <= 3)
SELECT count(DISTINCT c) AS customer_count, count(DISTINCT c) FILTER (lifetime > 1) AS repeat_customer_count, round(count(DISTINCT c) FILTER (lifetime > 1)::DOUBLE / count(DISTINCT c), 6) AS repeat_customer_rate, count(*) FILTER (c IS NULL) AS unknown_customer_order_count FROM o""")
def customer_cohort(spark, sf_dir):
    """Customers of the first months of years with their orders over all of them, a tenth of them unknown."""
    o = table(spark, sf_dir, "orders").select("o_custkey", "o_orderdate")
    lifetime = o.groupBy("o_custkey").agg(F.count("*").alias("lifetime"))
    chosen = o.where("month(o_orderdate) <= 3").join(lifetime, "o_custkey").select(F.when(F.col("o_custkey") % 10 != 0, F.col("o_custkey")).alias("c"), "lifetime")
    r = ranks.cohort(chosen, "c", "lifetime")
    return r.withColumn("repeat_customer_rate", F.col("repeat_customer_rate").cast("double"))


# -- sinks: upserts, ledgers, versions of releases, lines of JSON


@register("SELECT o_orderkey AS k, CASE WHEN o_orderkey % 3 = 0 THEN 'new' ELSE 'old' END AS v FROM orders WHERE o_orderkey % 2 = 0 OR o_orderkey % 3 = 0")
def upsert_rows(spark, sf_dir):
    """Rows replaced or added by key."""
    o = table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("k"))
    side = lambda where, v: o.where(where).withColumn("v", F.lit(v))
    return relational.upsert(side("k % 2 = 0", "old"), side("k % 3 = 0", "new"), "k")


@register("SELECT c_custkey AS id, CASE WHEN c_custkey % 2 = 0 THEN 'first' ELSE 'second' END AS run FROM customer WHERE c_custkey % 2 = 0 OR c_custkey % 5 < 4")
def ledger_appends(spark, sf_dir):
    """A ledger after two runs, the second of which brings some keys again, and some of its own twice: each key stays as it came first."""
    at = f"{shared_folder(spark, 'ledger')}/ledger"
    c = table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("id"))
    append_ledger(c.where("id % 2 = 0").withColumn("run", F.lit("first")), at, "id")
    again = c.where("id % 5 < 4").withColumn("run", F.lit("second"))
    append_ledger(again.unionByName(again.where("id % 3 = 0")), at, "id")
    return spark.read.parquet(at)


@register("SELECT 3 AS version, 'customers' AS relation, count(*) AS n_rows, sum(c_custkey)::BIGINT AS ids FROM customer WHERE c_custkey % 2 = 1 UNION ALL SELECT 3, 'suppliers', count(*), sum(s_suppkey)::BIGINT FROM supplier WHERE s_suppkey % 2 = 1")
def release_rollback(spark, sf_dir):
    """Two candidates of two relations, each activated, and the second rolled back: what is read then is all of the first."""
    releases = Releases(spark, shared_folder(spark, "pointer"))
    key = {"customers": table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("k")), "suppliers": table(spark, sf_dir, "supplier").select(F.col("s_suppkey").alias("k"))}
    for i, candidate in enumerate(("c1", "c2")):
        releases.build(candidate, {n: df.where(f"k % 2 = {1 - i}") for n, df in key.items()})
        releases.activate(candidate, i)
    version = releases.rollback(2)
    found = releases.resolve(*key)
    return reduce(DataFrame.unionByName, [df.agg(F.lit(version).alias("version"), F.lit(n).alias("relation"), F.count("*").alias("n_rows"), F.sum("k").alias("ids")) for n, df in found.items()])


@register("SELECT p_partkey::VARCHAR AS product_category_name, CASE WHEN p_partkey % 4 <> 0 THEN p_name || chr(10) || '\"é' END AS product_category_name_english FROM part")
def jsonl_lines(spark, sf_dir):
    """Objects written as lines of JSON, some without a value, and read back by their contract."""
    at = f"{shared_folder(spark, 'jsonl')}/lines"
    key = F.col("p_partkey")
    english = F.when(key % 4 != 0, F.concat("p_name", F.lit('\n"é')))
    table(spark, sf_dir, "part").select(key.cast("string").alias("product_category_name"), english.alias("product_category_name_english")).write.json(at)
    return files.read_jsonl(spark, at, V.CONTRACTS["category_translation"])
