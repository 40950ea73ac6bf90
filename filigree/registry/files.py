"""Queries that write files or tables, read them back, and run whole jobs. Each run
works in a new folder below the shared one."""

from __future__ import annotations

from datetime import date, datetime

from pyspark.sql import functions as F

from filigree import fixed_values as fv
from filigree.functions import text as T
from filigree.plans import filings as J
from filigree.plans import snapshot as P
from filigree.registry.base import query, spread, table, write_filings
from filigree.session import shared_folder
from filigree.sources import ixbrl
from filigree.sources.filings import scan_filings
from filigree.sources.schemas import register_tables
from filigree.sources.snapshot_csv import read_snapshot
from filigree.sources.tables import Table

# noon, so that the day is the same in any session time zone
_AT = datetime(2025, 1, 1, 12)
_LATER = datetime(2025, 2, 1, 12)


# ---- tagged filings ----------------------------------------------------------

def _tag(kind, name, text, attributes=""):
    return F.concat(F.lit(f'<ix:{kind} name="uk:{name}" contextRef="c"{attributes}>'), text,
                    F.lit(f"</ix:{kind}>"))


def _page(*body):
    """A small inline document around the given columns."""
    return F.concat(
        F.lit('<html xmlns:ix="http://www.xbrl.org/2013/inlineXBRL" '
              'xmlns:xbrli="http://www.xbrl.org/2003/instance"><body>'), *body, F.lit("</body></html>"))


def _context(instant=None, start=None, end=None):
    inner = (
        F.concat(F.lit("<xbrli:instant>"), instant, F.lit("</xbrli:instant>")) if instant is not None
        else F.concat(F.lit("<xbrli:startDate>"), start, F.lit("</xbrli:startDate><xbrli:endDate>"), end,
                      F.lit("</xbrli:endDate>")))
    return F.concat(F.lit('<ix:header><xbrli:context id="c"><xbrli:period>'), inner,
                    F.lit("</xbrli:period></xbrli:context></ix:header>"))


_DATED = """
d AS (SELECT o_orderkey, o_orderstatus, o_totalprice, o_custkey, o_orderpriority,
             'Prod224_2601_' || lpad(o_custkey::VARCHAR, 8, '0') || '_' || o_orderkey AS source_file,
             strftime(o_orderdate, '%b-%y') AS ch_upload,
             CASE WHEN o_orderstatus = 'O' THEN strftime(o_orderdate, '%Y-%m-%d') END AS instant,
             CASE WHEN o_orderstatus <> 'O' THEN '1990-01-01' END AS start_date,
             CASE WHEN o_orderstatus <> 'O' THEN strftime(o_orderdate, '%Y-%m-%d') END AS end_date FROM orders)"""


@query("WITH" + _DATED + """,
f AS (
  SELECT *, 0 AS ord, 'nonnumeric' AS kind, 'EntityCurrentLegalOrRegisteredName' AS tag,
         'Sons & ' || o_custkey AS value, NULL::DOUBLE AS num_value FROM d
  UNION ALL SELECT *, 2, 'nonnumeric', 'NameEntityOfficer', o_orderpriority || ' continued', NULL FROM d
  UNION ALL SELECT *, 3, 'numeric', 'Turnover', NULL, o_totalprice FROM d
  UNION ALL SELECT *, 4, 'numeric', 'Debtors', NULL, (-1000 * o_custkey)::DOUBLE FROM d
  UNION ALL SELECT *, 5, 'nonnumeric', 'BalanceSheetDate', '2025-06-30', NULL FROM d)
SELECT source_file, ch_upload, ord, kind, tag, value, num_value, instant, start_date, end_date FROM f""")
def ixbrl_facts(spark, sf_dir):
    o = spread(table(spark, sf_dir, "orders"))
    day = F.date_format("o_orderdate", "yyyy-MM-dd")
    customer = F.col("o_custkey").cast("string")
    content = _page(
        F.when(F.col("o_orderstatus") == "O", _context(instant=day))
        .otherwise(_context(start=F.lit("1990-01-01"), end=day)),
        _tag("nonNumeric", fv.COMPANY_NAME_TAG, F.concat(F.lit(" <b>Sons</b> &amp; "), customer)),
        _tag("nonFraction", "NotMapped", F.lit("5")),
        F.lit('<p>'), _tag("nonNumeric", fv.DIRECTOR_TAG, F.col("o_orderpriority"), ' continuedAt="k"'),
        F.lit('</p><ix:continuation id="k"> continued<ix:exclude>!</ix:exclude></ix:continuation>'),
        _tag("nonFraction", "Turnover", F.format_number("o_totalprice", 2), ' format="ixt:numdotdecimal"'),
        _tag("nonFraction", "Debtors", customer, ' scale="3" sign="-"'),
        _tag("nonNumeric", "BalanceSheetDate", F.lit("30 June 2025"), ' format="ixt:datedaymonthyearen"'))
    stem = F.concat(F.lit("Prod224_2601_"), F.lpad(customer, 8, "0"), F.lit("_"),
                    F.col("o_orderkey").cast("string"))
    path = F.concat(F.lit("/landing/"), F.date_format("o_orderdate", "yyyy-MM/"), stem, F.lit(".html"))
    filings = o.select(path.alias("path"), content.alias("content")).select(
        T.file_stem(F.col("path")).alias("source_file"), T.directory_label(F.col("path")).alias("ch_upload"),
        "content")
    return ixbrl.facts(ixbrl.parse_filings(filings, J.TAGS), "source_file", "ch_upload")


# ---- single sources and sinks ----------------------------------------------------

@query("""
SELECT p_partkey::VARCHAR AS company_number,
       p_name || CASE WHEN p_size <= 25 THEN ' "q" line two' ELSE ' café €' END AS company_name,
       p_brand AS post_town FROM part""")
def snapshot_csv(spark, sf_dir):
    folder = shared_folder(spark)
    p = table(spark, sf_dir, "part")
    small = F.col("p_size") <= 25
    rows = p.select(
        F.col("p_partkey").cast("string").alias(" CompanyNumber"),
        F.concat("p_name", F.when(small, ' "q"\nline two').otherwise(" café €")).alias("CompanyName"),
        F.concat(F.lit(" "), "p_brand", F.lit(" ")).alias("RegAddress.PostTown"), small.alias("small"))

    def save(df, name, encoding):
        (df.write.option("header", True).option("escape", '"').option("encoding", encoding)
         .option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False)
         .csv(f"{folder}/{name}"))

    save(rows.where("small").drop("small"), "utf8", "UTF-8")
    # the euro sign is byte 0x80 in cp1252
    save(rows.where("not small").select(
        "` CompanyNumber`", F.translate("CompanyName", "€", "\x80").alias("CompanyName"),
        "`RegAddress.PostTown`"), "cp1252", "ISO-8859-1")
    from filigree.sources.snapshot_csv import normalise_rows

    return normalise_rows(read_snapshot(spark, folder)).select(
        "company_number", "company_name", "post_town")


@query("""
SELECT 'page_' || page_id AS source_file, strftime(DATE '2020-01-01' + to_months((page_id % 24)::INT), '%b-%y')
  AS ch_upload, length(html) AS n_chars, md5(html) AS content_md5 FROM pages""")
def filing_scan(spark, sf_dir):
    landing = f"{shared_folder(spark)}/landing"
    pages = spread(table(spark, sf_dir, "pages")).select(
        F.date_format(F.add_months(F.lit("2020-01-01").cast("date"), (F.col("page_id") % 24).cast("int")),
                      "yyyy-MM").alias("directory"),
        F.concat(F.lit("page_"), F.col("page_id").cast("string"), F.lit(".html")).alias("file_name"),
        F.col("html").alias("content"))
    write_filings(pages, landing)
    return scan_filings(spark, landing).select(
        "source_file", "ch_upload", F.length("content").alias("n_chars"), F.md5("content").alias("content_md5"))


@query("""
WITH f AS (SELECT *, strftime(l_shipdate, '%b-%y') AS ch_upload FROM lineitem),
late AS (SELECT * FROM f WHERE l_returnflag <> 'A')
SELECT l_orderkey AS source_file, ch_upload, l_linenumber, l_partkey, -l_quantity AS value FROM f
WHERE l_returnflag <> 'R' AND NOT EXISTS (
  SELECT 1 FROM late WHERE late.l_orderkey = f.l_orderkey AND late.ch_upload = f.ch_upload)
UNION ALL SELECT l_orderkey, ch_upload, l_linenumber, l_partkey, l_quantity FROM late""")
def financials_append(spark, sf_dir):
    facts = Table(f"{shared_folder(spark)}/facts",
                  "source_file bigint, ch_upload string, l_linenumber int, l_partkey bigint, value double",
                  ("ch_upload",))
    li = table(spark, sf_dir, "lineitem")

    def load(rows, value):
        new = rows.select(
            F.col("l_orderkey").alias("source_file"), F.date_format("l_shipdate", "MMM-yy").alias("ch_upload"),
            "l_linenumber", "l_partkey", value.alias("value"))
        facts.append(new, replacing=new.select(*J.FILE))

    load(li.where("l_returnflag <> 'R'"), -F.col("l_quantity"))
    for _ in range(2):  # loading the same files again changes nothing
        load(li.where("l_returnflag <> 'A'"), F.col("l_quantity"))
    return facts.read(spark)


@query("SELECT c_custkey, c_name, c_acctbal FROM customer")
def staging_reload(spark, sf_dir):
    staging = Table(f"{shared_folder(spark)}/staging", "c_custkey bigint, c_name string, c_acctbal double")
    c = table(spark, sf_dir, "customer")
    for _ in range(2):
        staging.write(c)
    staging.drop_superseded(spark)
    return staging.read(spark)


@query("""
SELECT event_id::VARCHAR AS source_file, strftime(ts, '%b-%y') AS ch_upload,
       CASE event_type WHEN 'error' THEN 'failed' ELSE 'warning' END AS status,
       CASE WHEN value > 5 THEN props END AS content, repeat(props, 300) AS comment
FROM events WHERE event_type IN ('error', 'view')""")
def quarantine(spark, sf_dir):
    held = register_tables(shared_folder(spark))["quarantine"]
    rows = table(spark, sf_dir, "events").where(F.col("event_type").isin("error", "view")).select(
        F.col("event_id").cast("string").alias("source_file"), F.lit("p").alias("path"),
        F.when(F.col("value") > 5, F.col("props")).alias("content"),
        F.repeat("props", F.lit(300)).alias("comment"), F.lit(0).alias("attempts"),
        F.date_format("ts", "MMM-yy").alias("ch_upload"),
        F.when(F.col("event_type") == "error", "failed").otherwise("warning").alias("status"))
    for _ in range(2):
        held.append(rows, replacing=rows.select(*J.FILE))
    return held.read(spark).select("source_file", "ch_upload", "status", "content", "comment")


@query("SELECT doc_id, text, lang FROM documents")
def reports_json(spark, sf_dir):
    path = f"{shared_folder(spark)}/json"
    J.export_reports(table(spark, sf_dir, "documents").select("doc_id", "text", "lang"), path)
    return spark.read.schema("doc_id bigint, text string, lang string").json(path)


# ---- whole jobs ----------------------------------------------------------------------

@query("""
WITH staged AS (SELECT c_custkey + 10 AS k, c_name, c_mktsegment FROM customer),
kept AS (SELECT c_custkey AS k, c_name, c_mktsegment FROM customer WHERE c_custkey < 10)
SELECT k::VARCHAR AS company_number, 'new ' || c_name AS company_name, c_mktsegment AS county,
       DATE '2025-02-01' AS loaded, 2 AS snapshots FROM staged
UNION ALL SELECT k::VARCHAR, c_name, c_mktsegment, DATE '2025-01-01', 2 FROM kept""")
def snapshot_load(spark, sf_dir):
    """Two monthly snapshots; the second lacks ten companies and brings ten."""
    folder = shared_folder(spark)
    c = table(spark, sf_dir, "customer")
    for n, shift, prefix, at in ((1, 0, "", _AT), (2, 10, "new ", _LATER)):
        path = f"{folder}/snapshot-{n}"
        (c.select((F.col("c_custkey") + shift).cast("string").alias(" CompanyNumber"),
                  F.concat(F.lit(prefix), "c_name").alias("CompanyName"),
                  F.col("c_mktsegment").alias("RegAddress.County"))
         .write.option("header", True).option("escape", '"')
         .option("ignoreLeadingWhiteSpace", False).csv(path))
        for _ in range(2):  # a completed month is skipped
            P.snapshot_load(spark, path, f"{folder}/tables", date(2025, n, 1), at=at)
    tables = register_tables(f"{folder}/tables")
    done = tables["month_ledger"].read(spark).where("status = 'completed'").agg(
        F.count(F.lit(1)).cast("int").alias("snapshots"))
    return tables["companies"].read(spark).select(
        "company_number", "company_name", "county", F.col("loaded_at").cast("date").alias("loaded")
    ).crossJoin(F.broadcast(done))  # one row


def _customer_filings(spark, sf_dir, broken):
    """One filing per customer, landed in twelve months by nation."""
    c = spread(table(spark, sf_dir, "customer"))
    number = F.lpad(F.col("c_custkey").cast("string"), 8, "0")
    month = F.lpad((F.col("c_nationkey") % 12 + 1).cast("string"), 2, "0")
    fine = _page(
        _context(start=F.lit("2020-01-01"), end=F.lit("2020-12-31")),
        _tag("nonNumeric", fv.COMPANY_NAME_TAG, F.col("c_name")),
        _tag("nonNumeric", fv.DIRECTOR_TAG, F.concat(F.lit("Officer "), F.col("c_nationkey").cast("string"))),
        _tag("nonNumeric", fv.DIRECTOR_TAG, F.concat(F.lit("Officer "), F.col("c_nationkey").cast("string"))),
        _tag("nonFraction", "Turnover", F.format_number(F.abs("c_acctbal"), 2)),
        _tag("nonFraction", "Revenue", F.lit("1")),
        _tag("nonNumeric", fv.RELATED_PARTY_TAG, F.lit("short loan")),
        _tag("nonNumeric", fv.RELATED_PARTY_TAG, F.concat(F.lit("A long loan to "), F.col("c_name"))),
        F.when(F.col("c_nationkey") % 5 == 0, _tag(
            "nonNumeric", "AccountsType", F.lit("May 1"), ' format="ixt9:odd"')).otherwise(""),
        F.lit("<h1>Strategic report</h1><p>We trade in "), F.col("c_mktsegment"), F.lit(".</p>"),
        F.lit("<p>Balance sheet</p><p>gone</p>"))
    return c.select(
        F.concat(F.lit("2021-"), month).alias("directory"),
        F.concat(F.lit("Prod224_0086_"), number, F.lit("_20210131.html")).alias("file_name"),
        F.when(F.col("c_mktsegment").isin(*broken), "no markup").otherwise(fine).alias("content"))


def _all_results(spark, root):
    """Rows of all result tables in one long form."""
    t = register_tables(root)
    no = F.lit(None).cast("string")
    facts = t["financials"].read(spark).select(
        F.lit("financials").alias("part"), "company_number", F.col("metric").alias("item"),
        F.concat_ws("|", "period", "fiscal_period_new", "data_scope", "filing_date").alias("detail"),
        "value", "ch_upload")
    named = t["directors"].read(spark).select(
        F.lit("directors"), "company_number", "director_name",
        F.col("filing_date").cast("string"), F.lit(None).cast("double"), "ch_upload")
    told = t["reports"].read(spark).select(
        F.lit("reports"), "company_number", "section", F.concat_ws("|", "company_name", "text"),
        F.lit(None).cast("double"), "ch_upload")
    files = t["file_ledger"].read(spark).select(
        F.lit("file_ledger"), "source_file", "status", _no_path(F.col("comment")), F.lit(None).cast("double"), "ch_upload")
    held = t["quarantine"].read(spark).select(
        F.lit("quarantine"), "source_file", "status", F.concat_ws("|", _no_path(F.col("comment")), F.when(
            F.col("status") == "failed", F.col("content")).otherwise(F.when(F.col("content").isNotNull(), "kept"))),
        F.col("attempts").cast("double"), "ch_upload")
    told_off = t["warnings"].read(spark).select(
        F.lit("warnings"), "source_file", "warning", no, F.col("n").cast("double"), "ch_upload")
    pairs = t["fields"].read(spark).select(
        F.lit("fields"), "company_number", "field", F.concat_ws("|", "value", "filing_date"),
        F.lit(None).cast("double"), "ch_upload")
    months = t["month_ledger"].read(spark).select(
        F.lit("month_ledger"), "batch_id", "status", F.concat_ws("|", "files_processed", "files_failed"),
        F.lit(None).cast("double"), "ch_upload")
    return facts.union(named).union(told).union(files).union(months).union(held).union(told_off).union(pairs)


def _no_path(comment):
    """The landing folder is another one in each run."""
    return F.regexp_replace(comment, "\n[^\n]*/landing/", "\n")


_ALL_RESULTS = """
WITH c AS (
  SELECT *, lpad(c_custkey::VARCHAR, 8, '0') AS n, c_mktsegment IN ('BUILDING') AS broken,
         c_mktsegment NOT IN ('BUILDING') AND c_nationkey % 5 = 0 AS warned, c_nationkey % 12 + 1 AS m,
         strftime(make_date(2021, c_nationkey % 12 + 1, 1), '%b-%y') AS ch_upload FROM customer),
f AS (
  SELECT *, 'Prod224_0086_' || n || '_20210131' AS source_file,
         CASE WHEN broken THEN 'failed' WHEN warned THEN 'warning' ELSE 'success' END AS status,
         'FILE: Prod224_0086_' || n || '_20210131.html' || chr(10) || CASE WHEN broken
           THEN '2021-' || lpad(m::VARCHAR, 2, '0') || '/Prod224_0086_' || n || '_20210131.html' || chr(10) || chr(10)
                || 'ValueError: neither an html nor an xbrl document'
           ELSE 'Parsed with 1 warning(s) — data SAVED (only flagged fields were skipped):' || chr(10)
                || '  [1] Format ixt9:odd not implemented' END AS comment FROM c),
r AS (
SELECT 'financials' AS part, n AS company_number, 'revenue' AS item,
       '2020-01-01 to 2020-12-31|2020|single_entity|2021-01-31' AS detail, abs(c_acctbal) AS value, ch_upload
FROM c WHERE NOT broken
UNION ALL SELECT 'directors', n, 'Officer ' || c_nationkey, '2021-01-31', NULL, ch_upload FROM c WHERE NOT broken
UNION ALL SELECT 'reports', n, 'strategic_report',
                 c_name || '|' || 'We trade in' || chr(32) || c_mktsegment || '.', NULL, ch_upload
          FROM c WHERE NOT broken
UNION ALL SELECT 'reports', n, 'related_party_disclosures_xbrl', c_name || '|A long loan to ' || c_name, NULL, ch_upload
          FROM c WHERE NOT broken
UNION ALL SELECT 'fields', n, u.field, u.value || '|2021-01-31', NULL, ch_upload FROM c, (
            VALUES ('is_consolidated', 'no'), ('related_party_xbrl', 'short loan')) AS u(field, value) WHERE NOT broken
UNION ALL SELECT 'fields', n, 'company_name', c_name || '|2021-01-31', NULL, ch_upload FROM c WHERE NOT broken
UNION ALL SELECT 'file_ledger', source_file, status,
                 CASE status WHEN 'success' THEN 'Processed successfully' ELSE comment END, NULL, ch_upload FROM f
UNION ALL SELECT 'quarantine', source_file, status, comment || CASE WHEN broken THEN '|no markup' ELSE '|kept' END,
                 {attempts}, ch_upload FROM f WHERE status <> 'success'
UNION ALL SELECT 'warnings', source_file, 'Format ixt9:odd not implemented', NULL, 1, ch_upload FROM f WHERE warned
UNION ALL SELECT 'month_ledger', 'accounts_' || ch_upload,
                 CASE WHEN count(*) FILTER (WHERE status = 'success') = 0 AND count(*) FILTER (WHERE broken) > 0
                   THEN 'failed' ELSE 'completed' END,
                 (count(*) FILTER (WHERE status = 'success')) || '|' || (count(*) FILTER (WHERE broken)), NULL, ch_upload
          FROM f GROUP BY ch_upload)
SELECT * FROM r WHERE ch_upload LIKE '{month}'"""


@query(_ALL_RESULTS.format(attempts="0", month="%"))
def filings_load(spark, sf_dir):
    """Every landed month at once, some filings unreadable."""
    folder = shared_folder(spark)
    write_filings(_customer_filings(spark, sf_dir, ["BUILDING"]), f"{folder}/landing")
    J.filings_load(spark, f"{folder}/landing", f"{folder}/tables", at=_AT)
    return _all_results(spark, f"{folder}/tables")


@query(_ALL_RESULTS.format(attempts="CASE WHEN c_mktsegment IN ('BUILDING', 'MACHINERY') THEN 1 ELSE 0 END", month="%"))
def reprocess_failed(spark, sf_dir):
    """As ``filings_load``, but more filings are unreadable until they land again."""
    folder = shared_folder(spark)
    write_filings(_customer_filings(spark, sf_dir, ["BUILDING", "MACHINERY"]), f"{folder}/landing")
    J.filings_load(spark, f"{folder}/landing", f"{folder}/tables", at=_AT)
    write_filings(_customer_filings(spark, sf_dir, ["BUILDING"]), f"{folder}/landing")
    J.reprocess_failed(spark, f"{folder}/landing", f"{folder}/tables", at=_LATER)
    return _all_results(spark, f"{folder}/tables")


@query(_ALL_RESULTS.format(attempts="0", month="Jan-21"))
def monthly_load(spark, sf_dir):
    """The month before the run date, out of twelve landed below a dated folder; the
    second call finds it completed."""
    folder = f"{shared_folder(spark)}/2019-07"
    write_filings(_customer_filings(spark, sf_dir, ["BUILDING"]), f"{folder}/landing")
    for at in (_AT, _LATER):
        J.monthly_load(spark, f"{folder}/landing", f"{folder}/tables", date(2021, 2, 10), at=at)
    return _all_results(spark, f"{folder}/tables")
