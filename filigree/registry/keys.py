"""Queries for de-duplication, upserts, ledgers, checks and plans."""

from __future__ import annotations

from datetime import date

from pyspark.sql import functions as F

from filigree.functions import text as T
from filigree.operators import dedupe as D
from filigree.operators import ledger as L
from filigree.operators import quality as Q
from filigree.operators import upserts as U
from filigree.plans.filings import backfill_plan as pending_plan
from filigree.plans.filings import run_summary as summary
from filigree.plans.verification import verify_tables
from filigree.registry.base import query, table
from filigree.session import shared_folder
from filigree.sources.schemas import register_tables


@query("""
WITH f AS (
  SELECT l_orderkey, l_returnflag, l_linenumber,
         CASE WHEN l_linenumber % 3 <> 1 THEN l_extendedprice END AS value, l_extendedprice FROM lineitem),
r AS (
  SELECT *, row_number() OVER (PARTITION BY l_orderkey, l_returnflag
                               ORDER BY l_linenumber, l_extendedprice) AS n FROM f)
SELECT l_orderkey, l_returnflag, l_linenumber, value FROM r WHERE n = 1 AND value IS NOT NULL""")
def first_wins_facts(spark, sf_dir):
    facts = table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_returnflag", "l_linenumber",
        F.when(F.col("l_linenumber") % 3 != 1, F.col("l_extendedprice")).alias("value"),
        F.struct("l_linenumber", "l_extendedprice").alias("ord"))
    return D.first_wins(facts, ["l_orderkey", "l_returnflag"], "ord", "value").drop("ord")


@query("""
SELECT o_custkey, o_orderkey, o_orderdate::DATE AS o_orderdate, o_totalprice FROM (
  SELECT *, row_number() OVER (PARTITION BY o_custkey
                               ORDER BY o_orderdate DESC, o_orderkey DESC) AS n FROM orders)
WHERE n = 1""")
def latest_wins(spark, sf_dir):
    o = table(spark, sf_dir, "orders").select(
        "o_custkey", "o_orderkey", F.col("o_orderdate").cast("date").alias("o_orderdate"), "o_totalprice")
    return D.latest_wins(o, ["o_custkey"], [F.col("o_orderdate").desc_nulls_last(),
                                            F.col("o_orderkey").desc_nulls_last()])


@query("""
SELECT conv_id, min(turn) AS turn, trim(text) AS director_name
FROM conversations WHERE role = 'user' AND trim(text) <> '' GROUP BY conv_id, trim(text)""")
def directors(spark, sf_dir):
    said = table(spark, sf_dir, "conversations").where(F.col("role") == "user").select(
        "conv_id", "turn", T.text_value(F.col("text")).alias("director_name"))
    return D.distinct_texts(said, ["conv_id"], "director_name", "turn")


@query("""
WITH n AS (SELECT o_custkey, arg_max(o_orderkey, (o_orderdate, o_orderkey)) AS o_orderkey,
                  max(o_orderdate)::DATE AS filing_date,
                  min(o_orderdate)::DATE AS first_seen FROM orders GROUP BY o_custkey)
SELECT * FROM n""")
def upsert_latest(spark, sf_dir):
    o = table(spark, sf_dir, "orders")
    rows = o.select("o_custkey", "o_orderkey", F.col("o_orderdate").cast("date").alias("filing_date"),
                    F.col("o_orderdate").cast("date").alias("first_seen"), "o_orderstatus")
    existing = rows.where("o_orderstatus <> 'O'").drop("o_orderstatus")
    new = rows.where("o_orderstatus = 'O'").drop("o_orderstatus")
    return U.upsert_latest(existing, new, ["o_custkey"],
                           [F.col("filing_date"), F.col("o_orderkey")], "first_seen")


def _companies(spark, sf_dir):
    """Known companies, and a newer snapshot that lacks the first hundred and
    brings a hundred more."""
    c = table(spark, sf_dir, "customer").select("c_custkey", "c_name", "c_acctbal")
    return c, c.select((F.col("c_custkey") + 100).alias("c_custkey"), "c_name",
                       (-F.col("c_acctbal")).alias("c_acctbal"))


@query("""
WITH staged AS (SELECT c_custkey + 100 AS c_custkey, c_name, -c_acctbal AS c_acctbal FROM customer)
SELECT c_custkey, c_name, c_acctbal FROM customer c
WHERE NOT EXISTS (SELECT 1 FROM staged s WHERE s.c_custkey = c.c_custkey)
UNION ALL SELECT c_custkey, c_name, c_acctbal FROM staged""")
def company_upsert(spark, sf_dir):
    known, staged = _companies(spark, sf_dir)
    return U.replace_matching(known, staged, ["c_custkey"])


@query("""
WITH n AS (SELECT (SELECT count(*) FROM customer) AS c, (SELECT count(*) FROM supplier) AS s),
p AS (SELECT 'customer' AS gate, c AS staged_rows, s AS previous_rows FROM n
      UNION ALL SELECT 'supplier', s, c FROM n
      UNION ALL SELECT 'first', s, 0 FROM n
      UNION ALL SELECT 'empty', 0, s FROM n)
SELECT gate, staged_rows, previous_rows,
       CASE WHEN previous_rows > 0 THEN staged_rows / previous_rows END AS ratio,
       staged_rows > 0 AND (previous_rows = 0 OR staged_rows / previous_rows >= 0.95) AS passed
FROM p""")
def snapshot_gate(spark, sf_dir):
    c, s = table(spark, sf_dir, "customer"), table(spark, sf_dir, "supplier")
    gates = [("customer", c, s), ("supplier", s, c), ("first", s, c.limit(0)), ("empty", c.limit(0), s)]
    rows = [Q.snapshot_gate(a, b).select(F.lit(g).alias("gate"), "*").drop("reason") for g, a, b in gates]
    return rows[0].unionByName(rows[1]).unionByName(rows[2]).unionByName(rows[3])


@query("""
SELECT doc_id, source FROM documents d
WHERE NOT EXISTS (SELECT 1 FROM labels l WHERE l.doc_id = d.doc_id)""")
def new_files(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "source")
    return L.new_files(docs, table(spark, sf_dir, "labels"), ["doc_id"])


@query("""
SELECT doc_id, n_chars FROM documents d WHERE NOT EXISTS (
  SELECT 1 FROM labels l WHERE l.doc_id = d.doc_id AND l.quality = 1)""")
def new_files_by_status(spark, sf_dir):
    """Only labels of quality 1 count as done; wide rows stay in place: sets of bits made
    of the narrow keys say which are new."""
    ledger = table(spark, sf_dir, "labels").withColumn("status", F.col("quality").cast("string"))
    docs = table(spark, sf_dir, "documents").select("doc_id", "n_chars", "lang")
    new = L.new_files(docs.select("doc_id", "lang"), ledger, ["doc_id"], statuses=("1",))
    return L.filter_heavy(docs, new, ["doc_id", "lang"]).drop("lang")


@query("""
SELECT c_custkey AS batch_id, c_name FROM customer c WHERE EXISTS (
  SELECT 1 FROM orders WHERE o_custkey = c_custkey AND o_orderstatus = 'F')""")
def completed_among(spark, sf_dir):
    done = table(spark, sf_dir, "orders").select(
        F.col("o_custkey").alias("batch_id"),
        F.when(F.col("o_orderstatus") == "F", "completed").otherwise("running").alias("status"))
    asked = table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("batch_id"), "c_name")
    return L.completed_among(asked, done)


@query("""
SELECT l_orderkey AS source_file FROM lineitem UNION SELECT o_orderkey FROM orders
UNION SELECT event_id FROM events""")
def source_files(spark, sf_dir):
    t = lambda name, key: table(spark, sf_dir, name).select(F.col(key).alias("source_file"))
    return L.source_files(t("lineitem", "l_orderkey"), t("orders", "o_orderkey"), t("events", "event_id"))


_LEDGER_STATUS = """CASE event_type WHEN 'error' THEN 'failed' WHEN 'view' THEN 'warning' ELSE 'success' END"""


def _status():
    return (F.when(F.col("event_type") == "error", "failed")
            .when(F.col("event_type") == "view", "warning").otherwise("success"))


@query(f"""
SELECT user_id, day, status, event_id FROM (
  SELECT user_id, ts::DATE AS day, {_LEDGER_STATUS} AS status, event_id,
         row_number() OVER (PARTITION BY user_id, ts::DATE ORDER BY ts DESC) AS n FROM events)
WHERE n = 1""")
def ledger_upsert(spark, sf_dir):
    e = table(spark, sf_dir, "events").select(
        "user_id", F.col("ts").cast("date").alias("day"), _status().alias("status"), "event_id",
        F.col("ts").alias("processed_at"))
    merged = L.ledger_upsert(e.where("status = 'success'"), e.where("status <> 'success'"),
                             ["user_id", "day"])
    return merged.drop("processed_at")


@query(f"""
WITH e AS (SELECT ts, CASE WHEN day(ts) = 20 THEN 'error' ELSE event_type END AS event_type FROM events),
c AS (
  SELECT strftime(ts, '%d-%m') AS ch_upload,
         count(*) FILTER (WHERE {_LEDGER_STATUS} = 'success') AS files_processed,
         count(*) FILTER (WHERE {_LEDGER_STATUS} = 'failed') AS files_failed,
         count(*) FILTER (WHERE {_LEDGER_STATUS} = 'warning') AS files_warned
  FROM e WHERE ts >= TIMESTAMP '2024-01-05 12:00:00' GROUP BY ALL)
SELECT *, CASE WHEN files_processed = 0 AND files_failed > 0 THEN 'failed' ELSE 'completed' END AS status,
       CASE WHEN files_processed + files_failed > 0
            THEN printf('%.2f%%', files_processed::DOUBLE / (files_processed + files_failed) * 100)
            ELSE 'N/A' END AS success_rate
FROM c""")
def month_outcome(spark, sf_dir):
    e = table(spark, sf_dir, "events").withColumn(
        "event_type", F.when(F.dayofmonth("ts") == 20, "error").otherwise(F.col("event_type")))
    ledger = e.select(F.date_format("ts", "dd-MM").alias("ch_upload"), _status().alias("status"),
                      F.col("ts").alias("processed_at"))
    since = F.lit("2024-01-05 12:00:00").cast("timestamp_ntz")
    return L.with_rate(L.month_outcome(L.run_counts(ledger, since)))


def _order_months(spark, sf_dir):
    """A month ledger made of orders: one batch per month and priority."""
    o = table(spark, sf_dir, "orders")
    return o.groupBy(
        F.date_format("o_orderdate", "MMM-yy").alias("ch_upload"), F.col("o_orderpriority").alias("source")
    ).agg(F.min("o_orderdate").alias("started_at"), F.max("o_orderdate").alias("completed_at"),
          F.count(F.lit(1)).cast("int").alias("files_processed"),
          F.count_if(F.col("o_orderstatus") == "F").cast("int").alias("files_failed"),
          F.max(F.month("o_orderdate")).alias("m")
    ).withColumn("batch_id", F.concat_ws("_", "source", "ch_upload")).withColumn(
        "status", F.when(F.col("m") % 2 == 1, "completed").otherwise("failed"))


_ORDER_MONTHS = """
b AS (
  SELECT strftime(o_orderdate, '%b-%y') AS ch_upload, o_orderpriority AS source,
         min(o_orderdate) AS started_at, max(o_orderdate) AS completed_at,
         count(*)::INT AS files_processed,
         (count(*) FILTER (WHERE o_orderstatus = 'F'))::INT AS files_failed,
         max(month(o_orderdate)) AS m,
         o_orderpriority || '_' || strftime(o_orderdate, '%b-%y') AS batch_id,
         CASE WHEN max(month(o_orderdate)) % 2 = 1 THEN 'completed' ELSE 'failed' END AS status
  FROM orders GROUP BY 1, 2, 8)"""


@query("WITH" + _ORDER_MONTHS + """
SELECT strftime(month, '%b-%y') AS ch_upload, month::DATE AS month
FROM generate_series(DATE '1994-06-01', DATE '2002-03-01', INTERVAL 1 MONTH) t(month)
WHERE NOT EXISTS (SELECT 1 FROM b WHERE b.ch_upload = strftime(month, '%b-%y') AND status = 'completed')""")
def backfill_plan(spark, sf_dir):
    return pending_plan(spark, _order_months(spark, sf_dir), date(1994, 6, 15), date(2002, 3, 2))


@query("WITH" + _ORDER_MONTHS + """
SELECT batch_id, completed_at::DATE AS completed FROM b WHERE status = 'completed'
ORDER BY completed_at DESC NULLS LAST, batch_id DESC LIMIT 1""")
def latest_completed(spark, sf_dir):
    return L.latest_completed(_order_months(spark, sf_dir)).select(
        "batch_id", F.col("completed_at").cast("date").alias("completed"))


@query("WITH" + _ORDER_MONTHS + """,
r AS (SELECT *, row_number() OVER (PARTITION BY ch_upload ORDER BY started_at DESC, batch_id DESC) AS n FROM b)
SELECT ch_upload, status, files_processed, files_failed,
       date_diff('second', started_at, completed_at) AS duration_seconds FROM r WHERE n = 1""")
def latest_runs(spark, sf_dir):
    return L.latest_runs(_order_months(spark, sf_dir)).drop("started_at", "completed_at")


_AT = "2025-01-01 00:00:00"


@query("WITH" + _ORDER_MONTHS + """,
old AS (SELECT * FROM b WHERE m <= 6),
started AS (
  SELECT coalesce(o.batch_id, n.batch_id) AS batch_id, coalesce(o.ch_upload, n.ch_upload) AS ch_upload,
         CASE WHEN n.batch_id IS NOT NULL THEN 'running' ELSE o.status END AS status,
         coalesce(o.files_processed, 0) AS files_processed, coalesce(o.files_failed, 0) AS files_failed,
         CASE WHEN n.batch_id IS NULL THEN o.completed_at END AS completed_at, n.m AS fresh
  FROM old o FULL JOIN (SELECT * FROM b WHERE m >= 4) n ON o.batch_id = n.batch_id)
SELECT batch_id, ch_upload,
       CASE WHEN fresh >= 8 THEN 'failed' ELSE status END AS status,
       CASE WHEN fresh >= 8 THEN 0 ELSE files_processed END AS files_processed,
       CASE WHEN fresh >= 8 THEN 7 ELSE files_failed END AS files_failed,
       (CASE WHEN fresh >= 8 THEN TIMESTAMP '2025-01-01' ELSE completed_at END)::DATE AS completed
FROM started""")
def month_ledger(spark, sf_dir):
    batches = _order_months(spark, sf_dir)
    stamp = lambda c: F.col(c).cast("timestamp").alias(c)
    old = batches.where("m <= 6").select(
        "batch_id", "ch_upload", "source", F.lit(None).cast("string").alias("zip_filename"), "status",
        "files_processed", "files_failed", stamp("started_at"), stamp("completed_at"),
        F.col("started_at").cast("timestamp").alias("loaded_at"))
    starts = batches.where("m >= 4").select(
        "batch_id", "ch_upload", "source", F.lit(None).cast("string").alias("zip_filename"),
        stamp("started_at"))
    done = batches.where("m >= 8").select(
        "batch_id", F.lit("failed").alias("status"), F.lit(0).alias("files_processed"),
        F.lit(7).alias("files_failed"), F.lit(_AT).cast("timestamp").alias("completed_at"))
    return L.finish_batches(L.start_batches(old, starts), done).select(
        "batch_id", "ch_upload", "status", "files_processed", "files_failed",
        F.col("completed_at").cast("date").alias("completed"))


@query("""
SELECT s_suppkey AS batch_id, s_name AS name FROM supplier
UNION ALL SELECT c_custkey, c_name FROM customer
WHERE NOT EXISTS (SELECT 1 FROM supplier WHERE s_suppkey = c_custkey)""")
def insert_absent(spark, sf_dir):
    existing = table(spark, sf_dir, "supplier").select(
        F.col("s_suppkey").alias("batch_id"), F.col("s_name").alias("name"))
    new = table(spark, sf_dir, "customer").select(
        F.col("c_custkey").alias("batch_id"), F.col("c_name").alias("name"))
    return L.insert_absent(existing, new)


@query(f"""
WITH c AS (
  SELECT strftime(ts, '%b-%y') AS ch_upload,
         count(*) FILTER (WHERE {_LEDGER_STATUS} = 'success') AS files_processed,
         count(*) FILTER (WHERE {_LEDGER_STATUS} = 'failed') AS files_failed,
         count(*) FILTER (WHERE {_LEDGER_STATUS} = 'warning') AS files_warned,
         date_diff('second', date_trunc('second', min(ts)), date_trunc('second', max(ts))) AS duration_seconds
  FROM events GROUP BY 1)
SELECT ch_upload, files_processed, files_failed, files_warned,
       printf('%.2f%%', files_processed::DOUBLE / (files_processed + files_failed) * 100) AS success_rate,
       'completed' AS status, duration_seconds FROM c""")
def run_summary(spark, sf_dir):
    e = table(spark, sf_dir, "events")
    label = F.date_format("ts", "MMM-yy").alias("ch_upload")
    files = e.select(label, _status().alias("status"), F.col("ts").alias("processed_at"))
    months = e.groupBy(label).agg(F.min("ts").alias("started_at"), F.max("ts").alias("completed_at")).select(
        "*", F.lit("b").alias("batch_id"), F.lit("completed").alias("status"),
        F.lit(0).alias("files_processed"), F.lit(0).alias("files_failed"))
    return summary(files, months)


@query("""
SELECT (SELECT count(*) FROM orders) AS total_processed,
       (SELECT coalesce(max(n), 0)::INT FROM (
          SELECT count(*) AS n FROM orders WHERE strftime(o_orderdate, '%b-%y') = 'Mar-97'
          GROUP BY o_orderpriority)) AS stored,
       0 AS stored_unknown""")
def ledger_totals(spark, sf_dir):
    months = _order_months(spark, sf_dir)
    total = L.total_processed(table(spark, sf_dir, "orders")).withColumn("k", F.lit(1))
    stored = L.stored_count(months, "Mar-97").select(F.lit(1).alias("k"), F.col("files_processed").alias("stored"))
    unknown = L.stored_count(months, "Mar-77").select(
        F.lit(1).alias("k"), F.col("files_processed").alias("stored_unknown"))
    return total.join(stored, "k").join(unknown, "k").drop("k")


_VERIFY = """
f AS (SELECT strftime(o_orderdate, '%b-%y') AS ch_upload,
             CASE WHEN o_orderpriority <> '5-LOW' OR month(o_orderdate) <> 3 THEN o_custkey END AS company_number,
             CASE WHEN o_orderstatus <> 'P' OR month(o_orderdate) <> 4 THEN o_orderstatus END AS metric,
             CASE WHEN o_totalprice > 1000 THEN o_totalprice END AS value FROM orders),
d AS (SELECT strftime(l_shipdate, '%b-%y') AS ch_upload, l_suppkey, l_partkey, count(*) AS n
      FROM lineitem GROUP BY ALL),
r AS (SELECT strftime(ts, '%b-%y') AS ch_upload, user_id, event_type, count(*) AS n FROM events GROUP BY ALL),
w AS (
  SELECT ch_upload, 'financial_rows' AS check_name, count(*) AS value FROM f GROUP BY 1
  UNION ALL SELECT ch_upload, 'companies', count(DISTINCT company_number) FROM f GROUP BY 1
  UNION ALL SELECT ch_upload, 'null_company_number', count(*) FILTER (WHERE company_number IS NULL) FROM f GROUP BY 1
  UNION ALL SELECT ch_upload, 'null_metric', count(*) FILTER (WHERE metric IS NULL) FROM f GROUP BY 1
  UNION ALL SELECT ch_upload, 'null_value', count(*) FILTER (WHERE value IS NULL) FROM f GROUP BY 1
  UNION ALL SELECT ch_upload, 'director_rows', sum(n)::BIGINT FROM d GROUP BY 1
  UNION ALL SELECT ch_upload, 'duplicate_directors', count(*) FILTER (WHERE n > 1) FROM d GROUP BY 1
  UNION ALL SELECT ch_upload, 'report_rows', sum(n)::BIGINT FROM r GROUP BY 1
  UNION ALL SELECT ch_upload, 'duplicate_reports', count(*) FILTER (WHERE n > 1) FROM r GROUP BY 1),
g AS (SELECT m.ch_upload, c.check_name FROM (SELECT DISTINCT ch_upload FROM w) m,
             (SELECT DISTINCT check_name FROM w) c)
SELECT ch_upload, check_name, coalesce(value, 0) AS value,
       CASE WHEN check_name = 'financial_rows' AND coalesce(value, 0) = 0 THEN 'error'
            WHEN (starts_with(check_name, 'null_') OR starts_with(check_name, 'duplicate_')) AND value > 0
              THEN 'warning' ELSE 'ok' END AS level
FROM g LEFT JOIN w USING (ch_upload, check_name)"""


@query("WITH " + _VERIFY)
def verify(spark, sf_dir):
    day, month = F.col("o_orderdate"), F.month("o_orderdate")
    facts = table(spark, sf_dir, "orders").select(
        F.date_format(day, "MMM-yy").alias("ch_upload"),
        F.when((F.col("o_orderpriority") != "5-LOW") | (month != 3), F.col("o_custkey")).alias("company_number"),
        F.when((F.col("o_orderstatus") != "P") | (month != 4), F.col("o_orderstatus")).alias("metric"),
        F.when(F.col("o_totalprice") > 1000, F.col("o_totalprice")).alias("value"))
    named = table(spark, sf_dir, "lineitem").select(
        F.date_format("l_shipdate", "MMM-yy").alias("ch_upload"),
        F.col("l_suppkey").alias("company_number"), F.col("l_partkey").alias("director_name"))
    told = table(spark, sf_dir, "events").select(
        F.date_format("ts", "MMM-yy").alias("ch_upload"),
        F.col("user_id").alias("company_number"), F.col("event_type").alias("section"))
    return Q.verify(facts, named, told)


@query("""
WITH f AS (
  SELECT strftime(o_orderdate, '%b-%y') AS ch_upload, CASE WHEN o_orderpriority <> '5-LOW' THEN o_custkey END AS c,
         o_totalprice > 1000 AS valued FROM orders
  WHERE o_orderstatus <> 'P' OR o_orderkey % 3 > 0),
d AS (SELECT l_suppkey, l_partkey, arg_max(  -- labels have two digits of the year
        strftime(l_shipdate, '%b-%y'), year(l_shipdate) % 100 * 12 + month(l_shipdate)) AS ch_upload FROM lineitem GROUP BY ALL),
w AS (
  SELECT ch_upload, 'financial_rows' AS check_name, count(*) AS value FROM f GROUP BY 1
  UNION ALL SELECT ch_upload, 'companies', count(DISTINCT c) FROM f GROUP BY 1
  UNION ALL SELECT ch_upload, 'null_company_number', count(*) FILTER (WHERE c IS NULL) FROM f GROUP BY 1
  UNION ALL SELECT ch_upload, 'null_metric', 0 FROM f GROUP BY 1
  UNION ALL SELECT ch_upload, 'null_value', count(*) FILTER (WHERE NOT valued) FROM f GROUP BY 1
  UNION ALL SELECT ch_upload, 'director_rows', count(*) FROM d GROUP BY 1),
g AS (SELECT m.ch_upload, c.check_name FROM (SELECT DISTINCT ch_upload FROM w) m, (
  VALUES ('financial_rows'), ('companies'), ('null_company_number'), ('null_metric'), ('null_value'), ('director_rows'),
         ('duplicate_directors'), ('report_rows'), ('duplicate_reports')) c(check_name))
SELECT ch_upload, check_name, coalesce(value, 0) AS value,
       CASE WHEN check_name = 'financial_rows' AND coalesce(value, 0) = 0 THEN 'error'
            WHEN starts_with(check_name, 'null_') AND value > 0 THEN 'warning' ELSE 'ok' END AS level
FROM g LEFT JOIN w USING (ch_upload, check_name)""")
def verify_loads(spark, sf_dir):
    """Three loads, verified after each; files of one are replaced by the next, directors
    found again. Each verification counts what is new since the one before."""
    root = f"{shared_folder(spark)}/tables"
    t, at = register_tables(root), F.lit("2025-01-01").cast("timestamp")
    orders, lines = table(spark, sf_dir, "orders"), table(spark, sf_dir, "lineitem")
    facts = orders.select(
        F.when(F.col("o_orderpriority") != "5-LOW", F.col("o_custkey").cast("string")).alias("company_number"),
        F.col("o_orderstatus").alias("metric"), F.when(F.col("o_totalprice") > 1000, F.col("o_totalprice")).alias("value"),
        F.lit(None).cast("string").alias("period"), F.lit(None).cast("date").alias("account_closing_date_last_year"),
        F.lit(None).cast("int").alias("fiscal_period_new"), F.lit("no").alias("is_consolidated"),
        F.lit("x").alias("data_scope"), F.col("o_orderdate").cast("date").alias("filing_date"),
        F.col("o_orderkey").cast("string").alias("source_file"),
        F.date_format("o_orderdate", "MMM-yy").alias("ch_upload"), at.alias("loaded_at"))
    named = lines.select(
        F.col("l_suppkey").cast("string").alias("company_number"), F.col("l_partkey").cast("string").alias("director_name"),
        F.col("l_shipdate").cast("date").alias("filing_date"), F.col("l_orderkey").cast("string").alias("source_file"),
        F.date_format("l_shipdate", "MMM-yy").alias("ch_upload"), at.alias("loaded_at"), "l_returnflag")
    for status, flag in (("F", "A"), ("O", "N"), ("P", "R")):
        t["financials"].append(facts.where(F.col("metric") == status))
        own = D.latest_wins(named.where(F.col("l_returnflag") == flag), ["company_number", "director_name"],
                            D.recency("ch_upload", "filing_date", "source_file"))
        t["directors"].append(own)
        verify_tables(spark, root).collect()  # a few numbers per month
    gone = facts.where("metric = 'P' AND cast(source_file AS bigint) % 3 = 0")
    t["financials"].append(gone.limit(0), replacing=gone.select("source_file", "ch_upload"))
    return verify_tables(spark, root)


@query("""
SELECT event_id AS source_file, strftime(ts, '%b-%y') AS ch_upload,
       left('FILE: ' || event_id || '.html' || chr(10) || 'props' || chr(10) || chr(10)
            || repeat(props, 300), 2000) AS comment
FROM events WHERE event_type = 'error' AND ts >= TIMESTAMP '2024-01-05 12:00:00'""")
def failed_files(spark, sf_dir):
    e = table(spark, sf_dir, "events")
    name = F.concat(F.col("event_id").cast("string"), F.lit(".html"))
    ledger = e.select(
        F.col("event_id").alias("source_file"), F.date_format("ts", "MMM-yy").alias("ch_upload"),
        _status().alias("status"), T.comment(T.error_comment(
            name, F.lit("props"), F.lit(None), F.repeat("props", F.lit(300)))).alias("comment"),
        F.col("ts").alias("processed_at"))
    since = F.lit("2024-01-05 12:00:00").cast("timestamp_ntz")
    return L.failed_files(ledger, since).drop("processed_at")


@query("""
WITH w AS (
  SELECT user_id, 'Format ixt:' || event_type || props || ' not implemented' AS warning,
         row_number() OVER (PARTITION BY user_id ORDER BY event_id) AS n, count(*) OVER (PARTITION BY user_id) AS c
  FROM events WHERE event_type <> 'click')
SELECT user_id, n, warning FROM w""")
def numbered_warnings(spark, sf_dir):
    return L.numbered_warnings(_warnings(spark, sf_dir), ["user_id"], "event_id")


@query("""
WITH w AS (
  SELECT user_id, 'Format ixt:' || event_type || props || ' not implemented' AS warning,
         row_number() OVER (PARTITION BY user_id ORDER BY event_id) AS n, count(*) OVER (PARTITION BY user_id) AS c
  FROM events WHERE event_type <> 'click')
SELECT user_id, max(c) AS n_warnings, left(
  'FILE: ' || user_id || chr(10) || 'Parsed with ' || max(c)
  || ' warning(s) — data SAVED (only flagged fields were skipped):' || chr(10)
  || string_agg('  [' || n || '] ' || warning, chr(10) ORDER BY n), 2000) AS comment
FROM w GROUP BY user_id""")
def warning_comments(spark, sf_dir):
    numbered = L.numbered_warnings(_warnings(spark, sf_dir), ["user_id"], "event_id")
    return L.warning_comments(numbered, ["user_id"], F.col("user_id").cast("string"))


def _warnings(spark, sf_dir):
    prefix = F.when(F.col("event_type") == "click", "Format ").otherwise("Format ixt:")
    return table(spark, sf_dir, "events").select("user_id", "event_id", F.concat(
        prefix, "event_type", "props", F.lit(" not implemented")).alias("warning"))


@query("""
SELECT coalesce(l_returnflag || l_linestatus, 'TOTAL') AS file_name, count(*) AS row_count
FROM lineitem GROUP BY ROLLUP (l_returnflag || l_linestatus)""")
def rows_per_file(spark, sf_dir):
    li = table(spark, sf_dir, "lineitem")
    return Q.rows_per_file(li.select(F.concat("l_returnflag", "l_linestatus").alias("file_name")))


@query("""
SELECT 'customer' AS table_name, count(*) AS row_count FROM customer
UNION ALL SELECT 'orders', count(*) FROM orders UNION ALL SELECT 'lineitem', count(*) FROM lineitem
UNION ALL SELECT 'documents', count(*) FROM documents""")
def load_stats(spark, sf_dir):
    return Q.table_counts({n: table(spark, sf_dir, n) for n in ("customer", "orders", "lineitem", "documents")})


@query("""
SELECT max(date_trunc('month', o_orderdate))::DATE AS month FROM orders
WHERE date_trunc('month', o_orderdate) BETWEEN DATE '2001-07-01' AND DATE '2001-09-01'""")
def latest_snapshot(spark, sf_dir):
    landed = table(spark, sf_dir, "orders").select(
        F.trunc(F.col("o_orderdate").cast("date"), "MM").alias("month"))
    return Q.latest_snapshot(landed, date(2001, 9, 14))


@query("""
SELECT page_id, url AS path FROM pages ORDER BY url, page_id LIMIT 10""")
def sample_files(spark, sf_dir):
    """The bounded preview of a delivery: the limit is the feature."""
    pages = table(spark, sf_dir, "pages").select("page_id", F.col("url").alias("path"))
    return L.sample_files(pages, 10, "path")
