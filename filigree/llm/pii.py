"""Personal data by candidate gradient boosting, in DataFrame functions only.

Base spans are found by pattern and checked. Beside them, generators with high recall
propose overlapping candidates: anything like an address with an at-sign or its
spellings, any run of digits and separators, any account-like run of capitals and
digits. Boosted trees score a candidate by its format and context. They are trained
here, on all candidates, counted by their features, which are small whole numbers: those
that hold a base span are the positive ones, and nothing that defines a base span as
such (the plus of a phone number, the check digit of a card) is a feature. A fifth of the
candidates, by hash of their place, is kept apart; per generator, the lowest score at
which these reach ``PRECISION`` selects; candidates that overlap no base span then are
spans of their own.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from filigree.llm.boosting import fit
from filigree.llm.spans import redacted, said, with_matches
from filigree.llm.work import stored, table

SPANS = "array<struct<order:int,start:int,end:int,kind:string>>"
BASE = ("email", "ip", "card", "phone")
MADE = ("address", "number", "account")
PRECISION = 0.9
#: A match begins where no character that could begin it stands before, or right behind
#: the match before it; so runs are read once. Possessive: nothing is given back.
PATTERNS = {
    "email": r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?:\G|(?<![0-9]))[0-9]++(?:\.[0-9]++){3}",
    "card": r"(?<![0-9])[0-9](?:[\x20-]?[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
    "address": (r"(?:\G|(?<![\w.%+-]))[\w.%+-]++(?:@|\x20?[(\[]at[)\]]\x20?)[\w-]++"
                r"(?:(?:\.|\x20?[(\[]dot[)\]]\x20?)[\w-]++)++"),
    "number": r"(?<![0-9A-Za-z+(])[+(]{0,2}[0-9][0-9\x20().-]{4,60}[0-9](?![0-9A-Za-z])",
    "account": r"(?<![A-Z0-9])[A-Z]{2}[0-9]{2}[A-Z0-9]{8,30}(?![A-Za-z0-9])",
}
OCTET = "0*(?:25[0-5]|2[0-4][0-9]|[01]?[0-9]{1,2})"
#: Words before a candidate that speak of personal data.
TELLS = (r"(?i)(?:phone|tel|call|fax|mobile|sms|mail|contact|card|visa|account|iban|ssn|"
         r"passport|ip|host|addr)[^a-z]*(?:is|no|number)?[^a-z0-9]*$")


def _digits(value: Column) -> Column:
    return F.regexp_replace(value, "[^0-9]", "")


def luhn(digits: Column) -> Column:
    """Whether the check digit of a string of digits is right."""
    each = F.transform(F.filter(F.split(F.reverse(digits), ""), lambda c: c != ""), lambda c, i: F.when(
        i % 2 == 0, c.cast("int")).otherwise(
            c.cast("int") * 2 - F.when(c.cast("int") > 4, 9).otherwise(0)))
    return F.aggregate(each, F.lit(0), lambda a, x: a + x) % 10 == 0


def _valid(kind: str, value: Column) -> Column:
    n = F.length(_digits(value))
    return {"email": F.lit(True), "ip": value.rlike(rf"^{OCTET}(?:\.{OCTET}){{3}}$"),
            "card": F.when(n.between(16, 19), luhn(_digits(value))).otherwise(F.lit(False)),
            "phone": n.between(8, 15)}[kind]


FEATURES = {
    "f_length": lambda c: F.least(F.length(c["value"]), F.lit(40)),
    "f_digits": lambda c: F.least(F.length(_digits(c["value"])), F.lit(30)),
    "f_marks": lambda c: F.least(F.length(F.regexp_replace(c["value"], r"[\w\x20]", "")), F.lit(10)),
    "f_dots": lambda c: F.least(F.length(F.regexp_replace(c["value"], r"[^.]", "")), F.lit(10)),
    "f_blanks": lambda c: F.least(F.length(F.regexp_replace(c["value"], r"[^\x20]", "")), F.lit(10)),
    "f_groups": lambda c: F.least(F.size(F.split(c["value"], r"[^0-9]+")), F.lit(10)),
    "f_last": lambda c: F.least(F.length(F.regexp_extract(c["value"], r"([0-9]*)$", 1)), F.lit(20)),
    "f_first": lambda c: F.least(F.length(F.regexp_extract(c["value"], r"^[^0-9]*([0-9]*)", 1)), F.lit(20)),
    "f_date": lambda c: c["value"].rlike(r"^(?:19|20)[0-9]{2}[-./][01]?[0-9]\b|\b[0-3]?[0-9][-./][01]?[0-9][-./](?:19|20)[0-9]{2}$").cast("int"),
    "f_tell": lambda c: F.coalesce(c["before"], F.lit("")).rlike(TELLS).cast("int"),
    "f_blank_before": lambda c: F.coalesce(c["before"], F.lit("")).rlike(r"(?:^|\s)$").cast("int"),
    "f_money": lambda c: F.coalesce(c["before"], F.lit("")).rlike("[$€£#§]\\s?$").cast("int"),
}


def _spans(kind: str, order: int, keep) -> Column:
    return F.transform(F.filter(kind, keep), lambda s: F.struct(
        F.lit(order).alias("order"), s["start"].alias("start"), s["end"].alias("end"),
        F.lit(kind).alias("kind")))


def _base_spans(kind: str, order: int) -> Column:
    return _spans(kind, order, lambda s: _valid(kind, s["value"]))


def _overlap(a, b) -> Column:
    return (a["start"] < b["end"]) & (b["start"] < a["end"])


def candidates(docs: DataFrame, text: str) -> DataFrame:
    """``_doc`` (the row), ``_text``, ``_base`` (valid base spans) and ``_made`` (the
    generators' candidates with their features and whether they hold a base span)."""
    t = F.coalesce(F.col(text).cast("string"), F.lit(""))
    df = docs.select(F.struct("*").alias("_doc"), t.alias("_text"))
    has = lambda m: F.instr("_text", m) > 0
    digit = F.col("_text").rlike("[0-9]")
    at = has("@") | F.col("_text").rlike(r"[(\[]at[)\]]")
    might = {"email": has("@"), "ip": digit & has("."), "card": digit, "phone": digit & has("+"),
             "address": at, "number": digit, "account": digit}
    df = with_matches(df, "_text", {k: (p, might[k]) for k, p in PATTERNS.items()}, before=30)
    df = df.withColumn("_base", F.array_sort(F.concat(*(_base_spans(k, i) for i, k in enumerate(BASE)))))
    made = F.concat(*(F.transform(k, lambda c: F.struct(
        F.lit(len(BASE) + i).alias("order"), c["start"].alias("start"), c["end"].alias("end"),
        F.lit(k).alias("kind"), *(f(c).alias(n) for n, f in FEATURES.items()),
        F.exists("_base", lambda b: _overlap(b, c)).alias("known")))
        for i, k in enumerate(MADE)))
    return df.select("_doc", "_text", "_base", F.explode(F.array(made)).alias("_made"))


def learn(found: DataFrame, precision: float = PRECISION):
    """Whether a candidate is personal data, as a function of the candidate, learnt from
    all candidates. None if they can't teach it, or no score is precise enough."""
    rows = found.select(F.explode("_made").alias("c"), F.xxhash64("_text").alias("t")).select(
        "c.kind", *(F.col(f"c.{f}").alias(f) for f in FEATURES), F.col("c.known").cast("int").alias("y"),
        (F.pmod(F.xxhash64("t", "c.start", "c.end"), F.lit(5)) == 4).alias("apart"))
    rows = stored(rows.groupBy(*rows.columns).agg(F.count("*").alias("n")), "counts")
    model = fit(rows.where("NOT apart"), list(FEATURES), "y", times="n")
    if model is None:
        return None
    bins = rows.where("apart").groupBy("kind", F.round(model.score(), 1).alias("s")).agg(
        F.sum("n").alias("n"), F.sum(F.col("n") * F.col("y")).alias("y")).collect()
    least = {}
    for kind in MADE:
        n = y = 0
        for b in sorted((b for b in bins if b.kind == kind), key=lambda b: -b.s):
            n, y = n + b.n, y + b.y
            if y >= precision * n:
                least[kind] = b.s
    if not least:
        return None

    def personal(c):
        bound = F.coalesce(*(F.when(c["kind"] == k, F.lit(s)) for k, s in least.items()))
        return F.coalesce(F.round(model.score(lambda f: c[f]), 1) >= bound, F.lit(False))

    return personal


def personal_spans(docs: DataFrame, text: str = "text", precision: float = PRECISION) -> DataFrame:
    """Add ``base`` and ``spans`` to ``docs``: arrays of ``(order, start, end, kind)``,
    sorted by kind as listed (email, ip, card, phone, then address, number, account)
    and start. ``spans`` holds the base ones and the selected candidates that overlap
    none of them. NULL counts as empty. Repeated rows give repeated results, no rows
    none; a table that teaches nothing has base spans only. Columns of ``docs`` named
    ``base`` or ``spans`` are replaced, other columns are kept."""
    found = candidates(docs, text)
    personal = learn(found, precision)
    made = F.array().cast(SPANS) if personal is None else F.transform(
        F.filter("_made", lambda c: ~c["known"] & personal(c)), lambda c: F.struct(
            c["order"].alias("order"), c["start"].alias("start"), c["end"].alias("end"), c["kind"].alias("kind")))
    keep = [F.col(f"_doc.`{c}`").alias(c) for c in docs.columns if c not in ("base", "spans")]
    return found.select(*keep, F.col("_base").alias("base"), F.array_sort(F.concat("_base", made)).alias("spans"))


def redact_personal(docs: DataFrame, text: str = "text", mark: str = "[PERSONAL]") -> DataFrame:
    """``docs`` with every span of ``text`` replaced by ``mark``, overlapping spans by
    one. A NULL text stays NULL. Columns and their order stay."""
    df = personal_spans(docs.select(F.struct("*").alias("doc"), F.col(text).cast("string").alias("t")), "t")
    by_start = F.array_sort(F.transform("spans", lambda s: F.struct(s["start"].alias("start"), s["end"].alias("end"))))
    return df.withColumn("spans", by_start).withColumn("new", redacted("t", "spans", mark)).select(
        *(F.col("new" if c == text else f"doc.`{c}`").alias(c) for c in docs.columns))


def op4_pii(spark, sf_dir):
    df = personal_spans(table(spark, sf_dir, "documents").select("doc_id", "text"))
    count = lambda k: F.size(F.filter("base", lambda s: s["kind"] == k)).cast("long")
    return df.select("doc_id", *(count(k).alias(f"n_{k}") for k in BASE),
                     F.sha2(said(F.col("base")), 256).alias("base_sha256"),
                     said(F.col("spans")).alias("spans"))


QUERIES = {"op4_pii": op4_pii}
