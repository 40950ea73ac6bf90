"""Column functions for strings, names, labels and periods."""

from __future__ import annotations

from itertools import chain

from pyspark.sql import Column
from pyspark.sql import functions as F

from filigree import fixed_values as fv

# Python's \s and str.strip() are Unicode aware, Java's are not by default.
_REGEX_FLAGS = "(?iuU)"


def rlike(text: Column, pattern: str) -> Column:
    """Case-insensitive, Unicode-aware search."""
    return text.rlike(_REGEX_FLAGS + pattern)


def rlike_any(text: Column, patterns) -> Column:
    return rlike(text, "|".join(f"(?:{p})" for p in patterns))


def begins_with(text: Column, *patterns: str) -> Column:
    """Does a non-empty text begin with a match of any pattern? The empty
    alternative makes the search end at the first character, where a plain search
    for an anchored pattern would still walk through the whole text."""
    either = "|".join(f"(?:{p})" for p in patterns)
    return F.regexp_extract(text, f"{_REGEX_FLAGS}^((?={either})(?s:.)|)", 1) != ""


def strip(text: Column) -> Column:
    """Trim every Unicode blank, NBSP included. Linear, unlike a regex trim."""
    return F.btrim(text, F.lit(fv.WHITESPACE))


def blank_to_null(text: Column) -> Column:
    return F.nullif(strip(text), F.lit(""))


def flatten_controls(text: Column) -> Column:
    """Tab and line feed become a blank, carriage return goes."""
    return F.translate(text, "\t\n\r", "  ")


def local_name(tag: Column) -> Column:
    """The tag without its namespace prefix."""
    return F.substring_index(tag, ":", -1)


def text_value(value: Column) -> Column:
    """Text fact: NULL reads as an empty string, blanks are trimmed."""
    return strip(F.coalesce(value, F.lit("")))


# ---- lookups over small fixed maps -----------------------------------------

def literal_map(pairs: dict) -> Column:
    return F.create_map(*[F.lit(x) for x in chain.from_iterable(pairs.items())])


def _month_name(mm: Column) -> Column:
    return F.try_element_at(literal_map(fv.MONTHS), mm)


# ---- file names --------------------------------------------------------------

def file_stem(path: Column) -> Column:
    return F.regexp_replace(F.substring_index(path, "/", -1), r"\.[^.]*$", "")


def company_number(stem: Column) -> Column:
    return F.coalesce(F.get(F.split(stem, "_"), F.lit(2)), F.lit("UNKNOWN"))


def filing_date(stem: Column) -> Column:
    """Fourth name part, yyyymmdd; NULL when it is not a calendar date."""
    part = F.get(F.split(stem, "_"), F.lit(3))
    iso = F.concat_ws("-", F.substring(part, 1, 4), F.substring(part, 5, 2),
                      F.substring(part, 7, 2))
    return F.when(F.length(part) == 8, iso.try_cast("date"))


def batch_label(stem: Column) -> Column:
    """Second name part, yymm, as a month label: 2601 -> Jan-26."""
    part = F.get(F.split(stem, "_"), F.lit(1))
    name = _month_name(F.substring(part, 3, 2))
    return F.when(
        F.length(part) == 4,
        F.concat(F.substring(name, 1, 3), F.lit("-"), F.substring(part, 1, 2)),
    )


# ---- months --------------------------------------------------------------------

def month_label(day: Column) -> Column:
    return F.date_format(day, "MMM-yy")


def label_month(label: Column) -> Column:
    """First day of a labelled month. Labels do not sort by time, dates do."""
    numbers = literal_map({name[:3]: mm for mm, name in fv.MONTHS.items()})
    mm = F.try_element_at(numbers, F.substring(label, 1, 3))
    return F.concat(F.lit("20"), F.right(label, F.lit(2)), F.lit("-"), mm,
                    F.lit("-01")).try_cast("date")


def folder_label(folder: Column) -> Column:
    """Month label of a month folder: 2021-01 -> Jan-21; NULL for other names."""
    part = F.regexp_extract(folder, r"^(\d{4})-(\d{2})$", 2)
    return F.concat(F.substring(_month_name(part), 1, 3), F.lit("-"), F.substring(folder, 3, 2))


def directory_label(path: Column) -> Column:
    """Month label of a path by the nearest yyyy-mm directory above the file; of a
    landed file, ``folder_label`` of its month folder is the one to use."""
    return folder_label(F.regexp_extract(path, r"^.*/(\d{4}-\d{2})/", 1))


def previous_month(day: Column) -> Column:
    return F.add_months(F.trunc(day, "MM"), -1)


def archive_name(day: Column) -> Column:
    return F.concat(F.lit(fv.ARCHIVE_PREFIX), F.date_format(day, "MMMMyyyy"), F.lit(".zip"))


def delivery_url(base: str, day: Column) -> Column:
    return F.concat(F.lit(base.rstrip("/") + "/"), archive_name(day))


def filings_batch_id(label: Column) -> Column:
    return F.concat(F.lit(fv.FILING_SOURCE + "_"), label)


def snapshot_batch_id(day: Column) -> Column:
    return F.concat(F.lit(fv.SNAPSHOT_SOURCE + "_"), F.date_format(day, "yyyy-MM"), F.lit("-01"))


def snapshot_label(file_name: Column) -> Column:
    """January-2021 from a dated file name, otherwise the name itself."""
    pattern = r"(\d{4})-(\d{2})-\d{2}"
    month = _month_name(F.regexp_extract(file_name, pattern, 2))
    return F.coalesce(
        F.concat(month, F.lit("-"), F.regexp_extract(file_name, pattern, 1)), file_name)


# ---- periods ---------------------------------------------------------------------

def period_label(instant: Column, start: Column, end: Column) -> Column:
    return (
        F.when(instant.isNotNull(), F.concat(F.lit("as at "), instant))
        .when(start.isNotNull() & end.isNotNull(), F.concat(start, F.lit(" to "), end))
        .otherwise("")
    )


def closing_day(period: Column, instant: Column, end: Column) -> Column:
    """Closing day as text: end, else instant, else read from the label."""
    from_label = (
        F.when(period.startswith("as at "), strip(F.replace(period, F.lit("as at "), F.lit(""))))
        .when(period.contains(" to "), strip(F.substring_index(period, " to ", -1)))
    )
    return F.coalesce(end, instant, from_label)


def fiscal_year(closing: Column) -> Column:
    return F.when(F.length(closing) >= 4, F.substring(closing, 1, 4).try_cast("int"))


# ---- group accounts ----------------------------------------------------------------

def consolidation_class(
    content: Column,
    tag_marks=fv.GROUP_TAG_MARKS,
    tag_pair=fv.GROUP_TAG_PAIR,
    text_patterns=fv.GROUP_TEXT_PATTERNS,
) -> Column:
    in_tags = content.contains(tag_pair[0]) & content.contains(tag_pair[1])
    for mark in tag_marks:
        in_tags = in_tags | content.contains(mark)
    in_text = rlike_any(content, text_patterns)
    return (
        F.when(in_text, "has_group_but_xbrl_is_parent").when(in_tags, "yes").otherwise("no")
    )


def data_scope(group_class: Column) -> Column:
    return (
        F.when(group_class == "has_group_but_xbrl_is_parent", "parent_only")
        .when(group_class == "yes", "consolidated")
        .otherwise("single_entity")
    )


# ---- ledger texts --------------------------------------------------------------------

def comment(text: Column) -> Column:
    """As the file ledger stores it; everywhere else comments are whole."""
    return F.substring(text, 1, fv.COMMENT_CHARS)


def error_comment(file_name: Column, location: Column, source: Column, error: Column) -> Column:
    parts = [F.coalesce(c, F.lit("")) for c in (location, source, error)]
    return F.concat_ws("\n", F.concat(F.lit(fv.FILE_HEAD), file_name), *parts)


def warning_comment(file_name: Column, n: Column, numbered: Column) -> Column:
    """``numbered`` is the array of already numbered warning lines."""
    head = F.concat(
        F.lit(fv.FILE_HEAD), file_name, F.lit(fv.WARNING_HEAD[0]), n.cast("string"), F.lit(fv.WARNING_HEAD[1]))
    return F.concat(head, F.array_join(numbered, "\n"))


def numbered_line(position: Column, text: Column) -> Column:
    return F.concat(F.lit("  ["), position.cast("string"), F.lit("] "), text)


def is_format_warning(text: Column) -> Column:
    return F.lower(text).contains(fv.WARNING_MARK)


def file_status(error: Column, warning: Column) -> Column:
    return (
        F.when(error.isNotNull(), "failed").when(warning.isNotNull(), "warning")
        .otherwise("success")
    )


def file_comment(error: Column, warning: Column, rows: Column) -> Column:
    return F.coalesce(
        error, warning,
        F.when(rows == 0, fv.EMPTY_COMMENT).otherwise(fv.SUCCESS_COMMENT))


def success_rate(processed: Column, failed: Column) -> Column:
    total = processed + failed
    return F.when(
        total > 0, F.format_string("%.2f%%", processed.cast("double") / total * 100)
    ).otherwise("N/A")
