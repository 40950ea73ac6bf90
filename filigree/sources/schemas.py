"""Declared schemas of the tables, and where they live below one root."""

from __future__ import annotations

from filigree import fixed_values as fv
from filigree.operators.upserts import filing_order
from filigree.sources.tables import Merge, Table

COMPANY_COLUMNS = tuple(fv.SNAPSHOT_HEADERS.values())

STAGING = ", ".join(f"{c} string" for c in COMPANY_COLUMNS)
COMPANIES = STAGING + ", loaded_at timestamp"
FINANCIALS = (
    "company_number string, metric string, value double, period string, "
    "account_closing_date_last_year date, fiscal_period_new int, is_consolidated string, "
    "data_scope string, filing_date date, source_file string, ch_upload string, "
    "loaded_at timestamp")
DIRECTORS = (
    "company_number string, director_name string, filing_date date, source_file string, "
    "ch_upload string, loaded_at timestamp")
REPORTS = (
    "company_number string, company_name string, section string, text string, "
    "filing_date date, source_file string, ch_upload string, loaded_at timestamp")
FIELDS = (
    "company_number string, field string, value string, filing_date date, "
    "source_file string, ch_upload string")
FILE_LEDGER = (
    "source_file string, ch_upload string, status string, comment string, "
    "processed_at timestamp")
MONTH_LEDGER = (
    "batch_id string, ch_upload string, source string, zip_filename string, status string, "
    "files_processed int, files_failed int, started_at timestamp, completed_at timestamp, "
    "loaded_at timestamp")
QUARANTINE = (
    "source_file string, path string, content string, comment string, attempts int, "
    "ch_upload string, status string")
FACT_CHECKS = (
    "entry string, ch_upload string, company_number string, n bigint, no_metric bigint, no_value bigint")
KEY_CHECKS = "entry string, ch_upload string, n bigint, repeated bigint"
WARNINGS = "source_file string, n int, warning string, ch_upload string"


def register_tables(root: str) -> dict[str, Table]:
    def table(name, schema, partition_by=(), sort_by=(), keys=(), wide=False):
        merge = Merge(keys, filing_order) if keys else None
        return Table(f"{root.rstrip('/')}/{name}", schema, partition_by, sort_by, merge, wide)

    by_month = ("ch_upload",)
    return {
        "staging": table("staging", STAGING),
        "companies": table("companies", COMPANIES, sort_by=("company_number",)),
        "financials": table("financials", FINANCIALS, by_month, ("company_number",)),
        "directors": table("directors", DIRECTORS, by_month, ("company_number",), ("company_number", "director_name")),
        "reports": table("reports", REPORTS, by_month, ("company_number",), ("company_number", "section")),
        "fields": table("fields", FIELDS, by_month, ("company_number",)),
        "file_ledger": table("file_ledger", FILE_LEDGER, by_month, ("source_file",)),
        "month_ledger": table("month_ledger", MONTH_LEDGER),
        "warnings": table("warnings", WARNINGS, by_month, ("source_file",)),
        "fact_checks": table("fact_checks", FACT_CHECKS, ("entry",)),
        "key_checks": table("key_checks", KEY_CHECKS, ("entry",)),
        "quarantine": table("quarantine", QUARANTINE, ("ch_upload", "status"), wide=True),
    }
