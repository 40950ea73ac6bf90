"""Queries for row-wise operators and lookups."""

from __future__ import annotations

from pyspark.sql import functions as F

from filigree import fixed_values as fv
from filigree.functions import sections as S
from filigree.functions import text as T
from filigree.operators import facts as X
from filigree.operators.dedupe import last_value_per_key
from filigree.operators.running import running_last, sections_of_lines
from filigree.registry.base import query, sql_strip, table
from filigree.sources import snapshot_csv


@query(f"""
SELECT c_custkey::VARCHAR AS company_number,
       replace(c_name, '#', ' # ') AS company_name,
       CASE WHEN c_mktsegment <> 'BUILDING' THEN c_mktsegment END AS post_town,
       NULL::VARCHAR AS county
FROM customer""")
def normalise_rows(spark, sf_dir):
    c = table(spark, sf_dir, "customer")
    raw = c.select(
        F.concat(F.lit(" \xa0\t"), F.col("c_custkey").cast("string"), F.lit("  ")).alias(" CompanyNumber"),
        F.replace("c_name", F.lit("#"), F.lit("\t#\r\n")).alias("CompanyName"),
        F.when(F.col("c_mktsegment") == "BUILDING", " \xa0 ")
        .otherwise(F.concat(F.lit("\n"), "c_mktsegment", F.lit("  "))).alias("RegAddress.PostTown"))
    return snapshot_csv.normalise_rows(raw).select("company_number", "company_name", "post_town", "county")


@query("""
SELECT metric, l_linestatus, count(*) AS n_facts, sum(l_quantity)::BIGINT AS quantity
FROM lineitem JOIN (VALUES ('A', 'accepted'), ('R', 'returned')) m(tag, metric)
  ON l_returnflag = tag
GROUP BY metric, l_linestatus""")
def map_metrics(spark, sf_dir):
    li = table(spark, sf_dir, "lineitem").select(
        F.col("l_returnflag").alias("tag"), "l_linestatus", "l_quantity")
    mapped = X.map_tags(li, {"A": "accepted", "R": "returned"}, "tag", "metric")
    return mapped.groupBy("metric", "l_linestatus").agg(
        F.count(F.lit(1)).alias("n_facts"), F.sum("l_quantity").cast("bigint").alias("quantity"))


@query("""
SELECT l_orderkey, l_linenumber, l_partkey, l_quantity AS value,
       CASE WHEN o_orderstatus = 'O' THEN strftime(o_orderdate, '%Y-%m-%d') END AS instant,
       CASE WHEN o_orderstatus <> 'O' THEN strftime(o_orderdate, '%Y-%m-%d') END AS end_date
FROM lineitem LEFT JOIN orders ON l_orderkey = o_orderkey""")
def context_dates(spark, sf_dir):
    day = F.date_format("o_orderdate", "yyyy-MM-dd")
    is_instant = F.col("o_orderstatus") == "O"
    contexts = table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("l_orderkey"), F.when(is_instant, day).alias("instant"),
        F.lit(None).cast("string").alias("start_date"), F.when(~is_instant, day).alias("end_date"))
    li = table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_partkey", F.col("l_quantity").alias("value"))
    return X.with_context_dates(li, contexts, ["l_orderkey"]).drop("start_date")


@query("""
SELECT p_partkey, replace(p_type, ' ', '') AS tag FROM part""")
def strip_namespace(spark, sf_dir):
    p = table(spark, sf_dir, "part")
    bare = F.replace("p_type", F.lit(" "), F.lit(""))
    name = F.when(F.col("p_size") > 25, F.concat(F.lit("a:uk-gaap:"), bare)).otherwise(bare)
    return p.select("p_partkey", T.local_name(name).alias("tag"))


@query("""
SELECT o_orderkey,
       CASE WHEN o_orderstatus = 'P' THEN 'UNKNOWN' ELSE lpad(o_custkey::VARCHAR, 8, '0') END
         AS company_number,
       CASE WHEN o_orderstatus = 'O' THEN o_orderdate::DATE END AS filing_date,
       CASE WHEN o_orderstatus = 'O' THEN strftime(o_orderdate, '%b-%y') END AS batch
FROM orders""")
def parse_file_name(spark, sf_dir):
    o, status = table(spark, sf_dir, "orders"), F.col("o_orderstatus")
    number = F.lpad(F.col("o_custkey").cast("string"), 8, "0")
    stem = (
        F.when(status == "P", F.lit("Prod224_26"))
        .when(status == "F", F.concat(F.lit("Prod224_0086_"), number, F.lit("_20251345")))
        .otherwise(F.concat(F.lit("Prod224_"), F.date_format("o_orderdate", "yyMM_"), number,
                            F.lit("_"), F.date_format("o_orderdate", "yyyyMMdd"))))
    path = F.concat(F.lit("/landing/2021-01/x/"), stem, F.lit(".html"))
    o = o.withColumn("stem", T.file_stem(path))
    stem = F.col("stem")
    return o.select("o_orderkey", T.company_number(stem).alias("company_number"),
                    T.filing_date(stem).alias("filing_date"), T.batch_label(stem).alias("batch"))


@query("""
WITH m AS (SELECT DISTINCT date_trunc('month', o_orderdate)::DATE AS month FROM orders)
SELECT month, strftime(month, '%b-%y') AS label,
       'Accounts_Monthly_Data-' || strftime(month, '%B%Y') || '.zip' AS archive,
       'https://example.org/data/Accounts_Monthly_Data-' || strftime(month, '%B%Y') || '.zip' AS url,
       'accounts_' || strftime(month, '%b-%y') AS filings_batch,
       'company_data_' || strftime(month, '%Y-%m-01') AS snapshot_batch,
       strftime(month, '%B-%Y') AS snapshot_name,
       CASE WHEN year(month) < 2000 THEN NULL ELSE month END AS month_again,
       (month - INTERVAL 1 MONTH)::DATE AS previous
FROM m""")
def month_names(spark, sf_dir):
    months = table(spark, sf_dir, "orders").select(
        F.trunc(F.col("o_orderdate").cast("date"), "MM").alias("month")).distinct()
    month = F.col("month")
    label = T.month_label(month)
    file_name = F.concat(F.lit("BasicData-"), F.date_format(month, "yyyy-MM-dd"), F.lit(".zip"))
    return months.select(
        month, label.alias("label"), T.archive_name(month).alias("archive"),
        T.delivery_url("https://example.org/data/", month).alias("url"),
        T.filings_batch_id(label).alias("filings_batch"),
        T.snapshot_batch_id(month).alias("snapshot_batch"),
        T.snapshot_label(file_name).alias("snapshot_name"),
        # two-digit years are read as 20yy
        F.when(F.year(month) >= 2000, T.label_month(label)).alias("month_again"),
        T.previous_month(month).alias("previous"))


@query("""
WITH d AS (
  SELECT o_orderkey, o_orderkey % 4 AS k, strftime(o_orderdate, '%Y-%m-%d') AS day,
         strftime(o_orderdate - INTERVAL 1 YEAR, '%Y-%m-%d') AS year_ago FROM orders),
c AS (
  SELECT o_orderkey,
         CASE k WHEN 0 THEN 'as at ' || day WHEN 1 THEN year_ago || ' to ' || day ELSE '' END AS period,
         CASE WHEN k IN (0, 1, 3) THEN day END AS closing
  FROM d)
SELECT o_orderkey, period, closing::DATE AS account_closing_date_last_year,
       left(closing, 4)::INT AS fiscal_period_new FROM c""")
def periods(spark, sf_dir):
    day = F.date_format("o_orderdate", "yyyy-MM-dd")
    year_ago = F.date_format(F.col("o_orderdate") - F.expr("interval 1 year"), "yyyy-MM-dd")
    k = F.col("o_orderkey") % 4
    dated = table(spark, sf_dir, "orders").select(
        "o_orderkey", F.when(k == 0, day).alias("instant"),
        F.when(k.isin(1, 2), year_ago).alias("start_date"),
        F.when(k.isin(1, 3), day).alias("end_date"))
    return X.with_period(dated).drop("instant", "start_date", "end_date")


@query(r"""
WITH c AS (
  SELECT page_id,
         contains(html, 'track(7') OR contains(html, 'verlich')
           OR (contains(html, '<footer>') AND contains(html, 'lang="de"')) AS tagged,
         regexp_matches(html, '(?i)the\s+(of\s+)?and') OR regexp_matches(html, '(?i)les\s+(que|de|la)')
           AS told FROM pages),
k AS (
  SELECT page_id, CASE WHEN told THEN 'has_group_but_xbrl_is_parent' WHEN tagged THEN 'yes'
                       ELSE 'no' END AS is_consolidated FROM c)
SELECT page_id, is_consolidated,
       CASE is_consolidated WHEN 'has_group_but_xbrl_is_parent' THEN 'parent_only'
            WHEN 'yes' THEN 'consolidated' ELSE 'single_entity' END AS data_scope FROM k""")
def consolidation_class(spark, sf_dir):
    group_class = T.consolidation_class(
        F.col("html"), ("track(7", "verlich"), ("<footer>", 'lang="de"'),
        (r"the\s+(of\s+)?and", r"les\s+(que|de|la)"))
    return table(spark, sf_dir, "pages").select(
        "page_id", group_class.alias("is_consolidated")
    ).withColumn("data_scope", T.data_scope(F.col("is_consolidated")))


@query("""
WITH v AS (SELECT s_suppkey, s_name, 'loan' || repeat('x', (s_suppkey % 40)::INT) AS loan FROM supplier)
SELECT s_suppkey, 'auditor_name' AS field, s_name AS value FROM v
UNION ALL SELECT s_suppkey, 'related_party_xbrl', loan FROM v WHERE length(loan) <= 20""")
def field_rows(spark, sf_dir):
    s = table(spark, sf_dir, "supplier")
    loan = F.concat(F.lit("loan"), F.repeat(F.lit("x"), (F.col("s_suppkey") % 40).cast("int")))
    facts = s.select("s_suppkey", F.expr("1").alias("ord"), F.explode(F.array(
        F.struct(F.lit("NameEntityAuditors").alias("tag"),
                 F.concat(F.lit(" \xa0"), "s_name", F.lit(" ")).alias("raw")),
        F.struct(F.lit("AddressLine1").alias("tag"), F.lit("  ").alias("raw")),
        F.struct(F.lit("NotMapped").alias("tag"), F.col("s_name").alias("raw")),
        F.struct(F.lit("CountyRegion").alias("tag"), F.lit(None).cast("string").alias("raw")),
        F.struct(F.lit(fv.RELATED_PARTY_TAG).alias("tag"), loan.alias("raw")))).alias("f"))
    facts = facts.select("s_suppkey", "f.tag", T.text_value(F.col("f.raw")).alias("value"))
    return X.field_rows(facts).select("s_suppkey", "field", "value")


@query("""
SELECT c_custkey, 'c_name' AS field, c_name AS value FROM customer
UNION ALL SELECT c_custkey, 'c_nationkey', c_nationkey::VARCHAR FROM customer
UNION ALL SELECT c_custkey, 'c_mktsegment', c_mktsegment FROM customer
          WHERE c_mktsegment <> 'BUILDING'""")
def wide_field_rows(spark, sf_dir):
    c = table(spark, sf_dir, "customer").withColumn(
        "c_mktsegment", F.when(F.col("c_mktsegment") != "BUILDING", F.col("c_mktsegment")))
    return X.unpivot_fields(c, ["c_custkey"], ["c_name", "c_nationkey", "c_mktsegment"])


@query("""
WITH r AS (
  SELECT conv_id, turn, last_value(CASE WHEN role = 'user' THEN text END IGNORE NULLS)
           OVER (PARTITION BY conv_id ORDER BY turn) AS seen FROM conversations),
l AS (SELECT conv_id, arg_max(text, turn) AS last_text FROM conversations
      WHERE role = 'user' GROUP BY conv_id)
SELECT conv_id, turn, coalesce(seen, '') AS text_so_far, last_text
FROM r LEFT JOIN l USING (conv_id)""")
def running_name(spark, sf_dir):
    c = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    said = F.when(F.col("role") == "user", F.col("text"))
    # small blocks, so that values cross block borders here too
    running = running_last(c, ["conv_id"], "turn", said, "text_so_far", default="", block_rows=3)
    last = last_value_per_key(c, ["conv_id"], said, "turn", "last_text")
    return running.select("conv_id", "turn", "text_so_far").join(last, "conv_id", "left")


LINES_SQL = """
raw AS (SELECT {key}, string_split(regexp_replace({text}, '<[^>]+>', chr(10), 'g'), chr(10)) AS ls
        FROM {source}),
cut AS (SELECT {key}, unnest(ls) AS line, generate_subscripts(ls, 1) AS p FROM raw),
lines AS (SELECT {key}, (row_number() OVER (PARTITION BY {key} ORDER BY p) - 1)::INT AS pos, line
          FROM (SELECT {key}, p, {strip} AS line FROM cut) WHERE line <> '')"""


@query("WITH " + LINES_SQL.format(
    key="page_id", text="html", source="pages", strip=sql_strip("line"))
    + " SELECT page_id, pos, line FROM lines")
def text_lines(spark, sf_dir):
    return S.text_lines(table(spark, sf_dir, "pages"), "html", "page_id")


_SECTION_TEXT = ("WITH " + LINES_SQL.format(
    key="doc_id", text="text", source="documents", strip=sql_strip("line")) + r""",
kinds AS (
  SELECT doc_id, pos, line,
         CASE WHEN regexp_matches(line, '(?i)^(The|Tion)') THEN 1
              WHEN regexp_matches(line, '(?i)^In') THEN 2
              WHEN regexp_matches(line, '(?i)^(De|Le)') THEN 3
              WHEN regexp_matches(line, '(?i)^(Of|Licensed|Und)') THEN 0 END AS head,
         regexp_matches(line, '(?i)^(An|Er)') AS skipped,
         regexp_matches(line, '(?i)^(Re|Et|Er)') AS noted FROM lines),
runs AS (SELECT *, count(head) OVER (PARTITION BY doc_id ORDER BY pos) AS run FROM kinds),
own AS (SELECT *, max(head) OVER (PARTITION BY doc_id, run) AS sec FROM runs),
closed AS (
  SELECT *, max(CASE WHEN head IS NULL AND noted AND sec IN (2, 3) THEN 1 ELSE 0 END)
              OVER (PARTITION BY doc_id, run ORDER BY pos) AS shut FROM own)
SELECT doc_id, CASE sec WHEN 1 THEN 'alpha' WHEN 2 THEN 'beta' ELSE 'gamma' END AS section,
       string_agg(line, chr(10) ORDER BY pos) AS text
FROM closed WHERE head IS NULL AND sec > 0 AND NOT skipped AND shut = 0
GROUP BY doc_id, sec HAVING length(string_agg(line, chr(10) ORDER BY pos)) > 10""")
_HEADINGS = dict(
    starts=((r"^(The|Tion)", "alpha"), (r"^In", "beta"), (r"^(De|Le)", "gamma")),
    stops=(r"^(Of|Licensed|Und)",), note_number=r"^(Re|Et|Er)", skips=(r"^(An|Er)",),
    note_sections=("beta", "gamma"))


@query(_SECTION_TEXT)
def section_text(spark, sf_dir):
    return S.section_rows(table(spark, sf_dir, "documents"), "text", "doc_id", **_HEADINGS)


@query(_SECTION_TEXT)
def section_lines(spark, sf_dir):
    """As ``section_text``, of documents that are rows of lines; small blocks, so that
    sections cross their borders here too."""
    told = S.text_lines(table(spark, sf_dir, "documents"), "text", "doc_id")
    return sections_of_lines(told, ["doc_id"], "pos", "line", min_chars=fv.MIN_SECTION_CHARS, block_rows=5, **_HEADINGS)


@query("WITH " + LINES_SQL.format(
    key="page_id", text="html", source="pages", strip=sql_strip("line")) + """,
body AS (SELECT page_id, string_agg(line, chr(10) ORDER BY pos) AS body FROM lines GROUP BY page_id)
SELECT page_id, 'strategic_report' AS section, body || chr(10) || '7.' || chr(10) || 'more text' AS text
FROM body
UNION ALL SELECT page_id, 'related_party_disclosures', 'Loan to a director' FROM body""")
def report_sections(spark, sf_dir):
    """The real heading patterns over whole pages, related-party facts united in."""
    pages = table(spark, sf_dir, "pages")
    dressed = pages.select("page_id", F.concat(
        F.lit("<h1>STRATEGIC REPORT</h1>"), "html", F.lit("<p>7.</p><p>Page 3</p><h1>BALANCE SHEET</h1>"),
        "html", F.lit("<h2>Related party transactions</h2><p>Loan to a director</p><p>12.</p>"),
        "html", F.lit("<h1>STRATEGIC REPORT (CONTINUED)</h1><p>more text</p>")).alias("html"))
    return S.section_rows(dressed, "html", "page_id")
