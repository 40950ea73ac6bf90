"""Load of filings of any number of months at once.

Filings are read and parsed once, into one row per filing in a working table.
Everything after that reads narrow columns of that table. All tables of a load change
by one commit: rows are added, and where files are loaded again, their keys say which
earlier rows no longer count. So a load writes as much as its files give, a reader
sees all of it or nothing, and a run that is cut off is simply run again.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterable, Sequence
from concurrent.futures import ThreadPoolExecutor
from contextlib import contextmanager
from datetime import date, datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from filigree import fixed_values as fv
from filigree.functions import text as T
from filigree.functions import values
from filigree.functions.sections import with_sections
from filigree.operators import facts as X
from filigree.operators import ledger as L
from filigree.operators.dedupe import latest_wins, recency
from filigree.session import small_batches
from filigree.sources.filings import list_filings, read_contents, scan_filings  # noqa: F401
from filigree.sources.ixbrl import facts as fact_rows
from filigree.sources.ixbrl import parse_filings
from filigree.sources.schemas import register_tables
from filigree.sources.tables import State

DOC = ("path", "source_file", "ch_upload")
FILE = list(L.FILE_KEYS)
#: Commits that a load leaves, for queries that began before it.
KEPT_COMMITS = 8
TAGS = (*fv.METRIC_TAGS, *fv.FIELD_TAGS, fv.DIRECTOR_TAG)


# ---- one row per filing ------------------------------------------------------

def parse(filings: DataFrame) -> DataFrame:
    """Group class, report sections and tagged elements of each filing, in one
    narrow pass over its content."""
    classed = filings.withColumn("is_consolidated", T.consolidation_class(F.col("content")))
    return parse_filings(with_sections(classed, "content"), TAGS)


def _identity(df: DataFrame) -> DataFrame:
    stem = F.col("source_file")
    return df.withColumn("company_number", T.company_number(stem)).withColumn(
        "filing_date", T.filing_date(stem))


def fact_table(parsed: DataFrame) -> DataFrame:
    return fact_rows(parsed, *DOC, "is_consolidated")


def financials(facts: DataFrame) -> DataFrame:
    numeric = facts.where(F.col("kind") == "numeric")
    first = X.first_metric_facts(
        numeric.drop("value").withColumnRenamed("num_value", "value"), DOC)
    return _identity(X.with_period(first)).select(
        "company_number", "metric", "value",
        F.nullif(F.col("period"), F.lit("")).alias("period"),
        "account_closing_date_last_year", "fiscal_period_new", "is_consolidated",
        T.data_scope(F.col("is_consolidated")).alias("data_scope"),
        "filing_date", "source_file", "ch_upload")


def _texts(facts: DataFrame) -> DataFrame:
    return facts.where(F.col("kind") == "nonnumeric").select(*DOC, "ord", "tag", "value")


def directors(facts: DataFrame) -> DataFrame:
    return _identity(X.director_rows(_texts(facts), DOC)).select(
        "company_number", "director_name", "filing_date", "source_file", "ch_upload")


def fields(parsed: DataFrame, facts: DataFrame) -> DataFrame:
    tagged = X.field_rows(_texts(facts)).select(*DOC, "field", "value")
    classes = parsed.where(F.col("error").isNull()).select(
        *DOC, F.lit("is_consolidated").alias("field"), F.col("is_consolidated").alias("value"))
    return _identity(tagged.unionByName(classes)).select(
        "company_number", "field", "value", "filing_date", "source_file", "ch_upload")


def _last_company_name(elements: str):
    """Names are few, so they are picked out of the filing's own row."""
    tagged = F.filter(elements, lambda e: T.local_name(e["name"]) == fv.COMPANY_NAME_TAG)
    names = F.filter(
        F.transform(tagged, lambda e: T.text_value(values.text(e["text"], e["format"]))),
        lambda name: name != "")
    return F.coalesce(F.try_element_at(names, F.lit(-1)), F.lit(""))


def reports(parsed: DataFrame, facts: DataFrame) -> DataFrame:
    """Sections of the text (last company name of the filing) and long related-party
    facts (company name seen so far). ``ord`` keeps the order inside a filing."""
    html = parsed.where(F.col("error").isNull()).select(
        *DOC, F.lit(-1).alias("ord"), _last_company_name("elements").alias("company_name"),
        F.inline("sections"))
    tagged = X.related_party_texts(_texts(facts), DOC)
    return _identity(html.unionByName(tagged)).select(
        "company_number", "company_name", "section", "text", "filing_date", "source_file",
        "ch_upload", "ord")


def outcomes(parsed: DataFrame) -> DataFrame:
    """Status and whole comment of each filing; ``content`` is NULL where it is fine."""
    stem = F.substring_index(F.col("path"), "/", -1)
    notable = F.filter("warnings", T.is_format_warning)
    warning = F.when(F.size(notable) > 0, T.warning_comment(
        stem, F.size(notable),
        F.transform(notable, lambda w, i: T.numbered_line(i + 1, w))))
    error = F.when(F.col("error").isNotNull(), T.error_comment(
        stem, F.col("path"), F.lit(None), F.col("error")))
    return parsed.select(
        *DOC, "content", T.file_status(error, warning).alias("status"),
        F.coalesce(error, warning).alias("comment"))


def all_warnings(parsed: DataFrame) -> DataFrame:
    """Every warning of every filing, numbered as it came; nothing is left out."""
    return parsed.select(*FILE, F.posexplode("warnings").alias("n", "warning")).select(
        "source_file", (F.col("n") + 1).cast("int").alias("n"), "warning", "ch_upload")


def filled_files(parsed: DataFrame, facts: DataFrame, financial: DataFrame) -> DataFrame:
    """Files that give at least one row: numbers as stored, the rest read off narrow
    columns, without the windows that pick the rows."""
    texts = _texts(facts).where(
        ((F.col("tag") == fv.DIRECTOR_TAG) & (F.col("value") != ""))
        | X.is_related_party_text(F.col("tag"), F.col("value")))
    told = parsed.where(F.col("error").isNull() & (F.size("sections") > 0))
    return L.source_files(financial, texts, told, keys=FILE)


# ---- writing -------------------------------------------------------------------

#: Tables whose rows belong to a file: loading it again replaces them.
OF_FILES = ("financials", "fields", "warnings", "quarantine", "file_ledger")


@contextmanager
def _working(spark: SparkSession, root: str):
    """A folder below ``root`` for what a load keeps meanwhile; it is deleted, also when
    the load fails."""
    work = f"{root.rstrip('/')}/_work/{uuid.uuid4().hex}"
    try:
        yield work
    finally:
        path = spark._jvm.org.apache.hadoop.fs.Path(work)
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def _commit(spark: SparkSession, root: str, tables: dict, filings: DataFrame,
            months: Sequence[str], at: datetime, seen: State | None = None,
            attempts: DataFrame | None = None) -> None:
    """Parse ``filings`` and commit all they give at once."""
    with _working(spark, root) as work:
        _commit_in(spark, work, tables, filings, months, at, seen, attempts)


def _commit_in(spark, work, tables, filings, months, at, seen, attempts) -> None:
    """``seen`` is the state in which no file was known; None if files may be known."""
    # parsed once, values converted once: what follows reads these two tables
    with small_batches(spark):
        parsed = _stored(parse(filings), f"{work}/parsed")
    facts = _stored(fact_table(parsed), f"{work}/facts")
    files = parsed.select(*FILE).distinct()
    stamped = lambda df: df.withColumn("loaded_at", F.lit(at).cast("timestamp"))

    def newest(name, rows, *then):
        return stamped(latest_wins(rows, list(tables[name].merge.keys),
                                   recency("ch_upload", "filing_date", "source_file", *then)))

    status = outcomes(parsed)
    held = status.where(F.col("status") != "success")
    if attempts is None:
        held = held.withColumn("attempts", F.lit(0))
    else:
        held = held.join(attempts, FILE, "left").withColumn(
            "attempts", F.coalesce(F.col("attempts"), F.lit(0)) + 1)
    results = {
        "reports": newest("reports", reports(parsed, facts), "ord"),
        "financials": stamped(financials(facts)), "fields": fields(parsed, facts),
        "directors": newest("directors", directors(facts)),
        "warnings": all_warnings(parsed), "quarantine": held}
    # they depend on the two tables only, so a small load does not wait for each in turn
    with ThreadPoolExecutor(len(results)) as pool:
        made = dict(zip(results, pool.map(lambda n: tables[n].stage(results[n]), results)))

    filled = filled_files(parsed, facts, tables["financials"].rows_of(spark, [made["financials"]]))
    entries = (
        status.join(filled.withColumn("_filled", F.lit(1)), FILE, "left")
        .select(*FILE, "status", T.comment(T.file_comment(
            F.col("comment"), F.lit(None), F.coalesce("_filled", F.lit(0)))).alias("comment"),
            F.lit(at).cast("timestamp").alias("processed_at")))
    # one entry per file and month, also when a month holds a file name twice
    entries = latest_wins(entries, FILE, [F.col("status").asc()])
    made["file_ledger"] = tables["file_ledger"].stage(entries)

    def change(state: State) -> dict:
        out = {name: [entry] for name, entry in made.items()}
        again = _known_again(spark, tables["file_ledger"], files, months, seen, state)
        if again is not None:
            gone = tables["file_ledger"].stage_gone(again)
            out |= {name: [gone, made[name]] for name in OF_FILES}
        ledger = tables["file_ledger"]
        told = (ledger.rows_of(spark, [made["file_ledger"]]) if attempts is None
                else ledger.read(spark, months, State(0, state.with_entries(out))))
        batches = tables["month_ledger"]
        out["month_ledger"] = [batches.stage(L.finish_batches(
            batches.read(spark, state=state), _closed(spark, months, told, at)), "full")]
        return out

    tables["file_ledger"].store.commit(spark, change)


def _known_again(spark, ledger, files: DataFrame, months, seen: State | None,
                 state: State) -> DataFrame | None:
    """Files whose earlier rows have to go. Of new files these are those that another
    writer has loaded since ``seen``."""
    if seen is None:
        return files if state.entries(ledger.name) else None
    old = {e["dir"] for e in seen.entries(ledger.name)}
    since = [e for e in state.entries(ledger.name) if e["dir"] not in old]
    if not since:
        return None
    both = files.join(ledger.rows_of(spark, since, months).select(*FILE), FILE, "left_semi")
    return None if both.isEmpty() else both


def _stored(df: DataFrame, path: str) -> DataFrame:
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def _closed(spark, labels: Iterable[str], ledger: DataFrame, at: datetime) -> DataFrame:
    """Outcome of months by the ledger entries given."""
    plan = spark.createDataFrame([(m,) for m in labels], "ch_upload string")
    return L.month_outcome(plan.join(L.run_counts(ledger), "ch_upload", "left").fillna(0)).select(
        T.filings_batch_id(F.col("ch_upload")).alias("batch_id"), "status",
        F.col("files_processed").cast("int").alias("files_processed"),
        F.col("files_failed").cast("int").alias("files_failed"),
        F.lit(at).cast("timestamp").alias("completed_at"))


def _tidy(spark, tables: dict) -> None:
    for name in (*OF_FILES, "directors", "reports"):
        tables[name].fold(spark)
    tables["month_ledger"].store.clean(spark, KEPT_COMMITS)


def _directory(label: str) -> str:
    """Landing folder of a month label: Jan-21 -> 2021-01."""
    return datetime.strptime(label, "%b-%y").strftime("%Y-%m")


# ---- jobs ------------------------------------------------------------------------

def filings_load(spark: SparkSession, landing: str, root: str, *,
                 months: Iterable[str] | None = None, at: datetime | None = None,
                 statuses: Sequence[str] | None = None) -> DataFrame:
    """Load new filings of the landed months (folders ``yyyy-mm``; all when None).
    Known filings are not opened.

    ``statuses`` narrows which ledger entries count as done. Returns the month
    ledger. Months whose filings are all known are closed with 0/0.
    """
    with _working(spark, root) as work:
        return _load(spark, root, list_filings(spark, landing, months, f"{work}/listing"),
                     lambda new, _: read_contents(new), at or datetime.now(), statuses)


def filings_table_load(filings: DataFrame, root: str, *, at: datetime | None = None,
                       statuses: Sequence[str] | None = None) -> DataFrame:
    """As ``filings_load``, from a table of filings (source_file, path, ch_upload,
    content) instead of one file each, such as a stored ``scan_filings``."""
    spark = filings.sparkSession
    with _working(spark, root) as work:
        return _load(
            spark, root, filings.select("source_file", "path", "ch_upload"),
            lambda new, labels: L.filter_heavy(
                filings, new, FILE, labels, work=f"{work}/{uuid.uuid4().hex}"), at or datetime.now(), statuses)


def _load(spark: SparkSession, root: str, listed: DataFrame,
          content_of: Callable[[DataFrame, list[str]], DataFrame], at: datetime,
          statuses: Sequence[str] | None) -> DataFrame:
    tables = register_tables(root)
    ledger, batches = tables["file_ledger"], tables["month_ledger"]
    found = listed.groupBy("ch_upload", T.label_month(F.col("ch_upload")).alias("m")).count().orderBy("m").collect()
    odd = [r.ch_upload for r in found if r.m is None]  # months only
    if odd:
        raise ValueError(f"not a month label: {odd[:10]}")
    labels = [r.ch_upload for r in found]
    if not labels:
        return batches.read(spark)

    state = ledger.store.state(spark)
    new = L.new_files(listed, ledger.read(spark, labels, state), statuses=statuses)
    counts = {r.ch_upload: r["count"] for r in new.groupBy("ch_upload").count().collect()}
    busy = [m for m in labels if m in counts]
    started = spark.createDataFrame([(m,) for m in labels], "ch_upload string").select(
        T.filings_batch_id(F.col("ch_upload")).alias("batch_id"), "ch_upload",
        F.lit(fv.FILING_SOURCE).alias("source"),
        T.archive_name(T.label_month(F.col("ch_upload"))).alias("zip_filename"),
        F.lit(at).cast("timestamp").alias("started_at"))
    batches.update(spark, lambda old: L.start_batches(old, started))

    def commit(months):
        own = new.where(F.col("ch_upload").isin(*months))
        _commit(spark, root, tables, content_of(own, months), months, at, None if statuses else state)

    broken, first = [], None
    if busy:
        try:
            commit(busy)
        except Exception as failure:  # the months apart: one must not stop the others
            for month in busy:
                try:
                    if len(busy) == 1:
                        raise failure
                    commit([month])
                except Exception as own:
                    broken.append(month)
                    first = first or own
    if broken:
        outcome = spark.createDataFrame(
            [(m, counts[m]) for m in broken], "ch_upload string, n bigint").select(
            T.filings_batch_id(F.col("ch_upload")).alias("batch_id"),
            F.lit("failed").alias("status"), F.lit(0).alias("files_processed"),
            F.col("n").cast("int").alias("files_failed"), F.lit(at).cast("timestamp").alias("completed_at"))
        batches.update(spark, lambda old: L.finish_batches(old, outcome))
    idle = [m for m in labels if m not in counts]
    if idle:
        none = ledger.rows_of(spark, [])
        batches.update(spark, lambda old: L.finish_batches(old, _closed(spark, idle, none, at)))
    _tidy(spark, tables)
    if first:
        raise first
    return batches.read(spark)


def reprocess_failed(spark: SparkSession, landing: str, root: str, *,
                     months: Iterable[str] | None = None, max_attempts: int = 3,
                     at: datetime | None = None) -> DataFrame:
    """Parse failed filings once more: from the landing folder where the file is
    there, otherwise from the quarantine. Each call is one attempt; a filing is left
    alone after ``max_attempts``. Returns the month ledger."""
    at = at or datetime.now()
    tables = register_tables(root)
    labels = None
    if months is not None:
        months = list(months)
        labels = [datetime.strptime(m, "%Y-%m").strftime("%b-%y") for m in months]
    failed = tables["quarantine"].read(spark, labels).where(
        (F.col("status") == "failed") & (F.col("attempts") < max_attempts))
    busy = [r[0] for r in failed.select("ch_upload").distinct().collect()]
    if not busy:
        return tables["month_ledger"].read(spark)

    with _working(spark, root) as work:
        listed = list_filings(spark, landing, [_directory(m) for m in busy], f"{work}/listing")
        landed = read_contents(listed.join(failed.select(*FILE).distinct(), FILE, "left_semi"))
        kept = failed.join(listed, FILE, "left_anti")
        content = landed.unionByName(kept.select(*landed.columns))
        attempts = failed.groupBy(*FILE).agg(F.max("attempts").alias("attempts"))
        _commit(spark, root, tables, content, busy, at, None, attempts)
    _tidy(spark, tables)
    return tables["month_ledger"].read(spark)


def backfill_plan(spark: SparkSession, month_ledger: DataFrame, start: date, now: date,
                  limit: int = 0) -> DataFrame:
    """Months still to load, oldest first."""
    return L.pending_months(L.month_plan(spark, start, now, limit), month_ledger).orderBy("month")


def monthly_load(spark: SparkSession, landing: str, root: str, run_date: date, *,
                 at: datetime | None = None) -> DataFrame:
    """Load the month before ``run_date`` unless it is completed already."""
    label = spark.range(1).select(
        T.month_label(T.previous_month(F.lit(run_date)))).first()[0]
    batches = register_tables(root)["month_ledger"].read(spark)
    if L.is_completed(batches, f"{fv.FILING_SOURCE}_{label}"):
        return batches
    return filings_load(spark, landing, root, months=[_directory(label)], at=at)


def run_summary(file_ledger: DataFrame, month_ledger: DataFrame, since=None) -> DataFrame:
    """Per month: files processed, failed and warned, success rate, duration."""
    counts = L.with_rate(L.run_counts(file_ledger, since))
    runs = L.latest_runs(month_ledger).select("ch_upload", "status", "duration_seconds")
    return counts.join(runs, "ch_upload", "left")


def export_reports(reports_table: DataFrame, path: str) -> None:
    """Reports with their full text as JSON lines."""
    reports_table.write.json(path)
