"""Secret scans, in DataFrame functions only.

Known forms are found by pattern. Beyond them, every run of 20 or more characters that
keys are written with is a candidate. In it, the runs of each character class are looked
at: as a window of 20 characters moves over a run, the count of the character that
enters goes up and that of the one that leaves goes down, and only these two change the
sum that the Shannon entropy is taken from. So a run costs in proportion to its length.
A candidate is a secret if a window of a class reaches that class's bits, unless the
allow-list knows it.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from filigree.llm.spans import redacted, said, with_matches
from filigree.llm.work import table

BASE = ("assign", "access", "hex")
ASSIGN = (r"""(?i:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?"""
          r"([A-Za-z0-9+/_.=-]+)")
ACCESS = "AKIA[A-Z0-9]{14,}"
HEX = "[0-9a-f]{16,}"
WINDOW = 20
CANDIDATE = r"[A-Za-z0-9+/_=-]{20,}"
#: Bits a window has to reach, by the class of its characters. A random window of 20 has
#: about 3.3 bits in hex, 3.9 in one case with digits, 4.0 in base64.
CLASSES = (("[0-9a-f]{20,}", 2.9), ("[0-9A-F]{20,}", 2.9), ("[0-9a-z]{20,}", 3.5), ("[0-9A-Z]{20,}", 3.5),
           ("[A-Za-z0-9+/_=-]{20,}", 3.6))
#: Candidates that are no secrets: without digit or without letter (words, numbers),
#: marked as samples, UUIDs, paths of words, names joined by - or _, dates and versions.
ALLOWED = ("^[^0-9]*$", "^[^A-Za-z]*$", "(?i)example|sample|dummy|placeholder|xxxx|changeme",
           "^[0-9a-fA-F]{8}(?:-[0-9a-fA-F]{4}){3}-[0-9a-fA-F]{12}$",
           "^/?(?:[A-Za-z]+|[0-9]{1,8})(?:[-_/=+](?:[A-Za-z]*|[0-9]{1,8}))+$")


#: Counts of up to 31 are kept in 5 bits each, 12 to a number, of characters from "+" on.
FIRST, BITS, EACH, NUMBERS = 43, 5, 12, 7


def _part(count: Column) -> Column:
    """c log2 c"""
    return F.when(count > 0, count * F.log2(count.cast("double"))).otherwise(F.lit(0.0))


def window_entropy(value: Column, window: int = WINDOW) -> Column:
    """The largest entropy, in bits, of any ``window`` (at most 31) consecutive characters
    of a text of ASCII characters from "+" to "z"; of a shorter text 0."""
    size = F.length(value)
    codes = F.transform(F.split(value, ""), lambda c: F.ascii(c) - FIRST)
    before = F.concat(F.array_repeat(F.lit(-1), window), F.slice(codes, F.lit(1), F.greatest(size - window, F.lit(0))))

    def place(code):
        return (code / EACH).cast("int"), ((code % EACH) * BITS).cast("int")

    steps = F.transform(F.arrays_zip(codes.alias("new"), before.alias("old")), lambda z: F.struct(
        z["old"].alias("old"), *(v.alias(n) for code, names in ((z["new"], ("a", "b")), (z["old"], ("c", "d")))
                                 for v, n in zip(place(code), names, strict=True))))

    def count(a, number, shift):
        return F.call_function("shiftright", F.get(a["counts"], number), shift).bitwiseAND(F.lit((1 << BITS) - 1))

    def added(counts, number, shift, one):
        unit = F.call_function("shiftleft", F.lit(1).cast("long"), shift)
        return F.transform(counts, lambda c, k: F.when(k == number, c + one * unit).otherwise(c))

    def step(a, x):
        full = x["old"] >= 0
        # the window held the ``window`` characters before; one leaves, then one enters
        leaves = F.when(full, count(a, x["c"], x["d"])).otherwise(F.lit(0))
        less = F.when(full, added(a["counts"], x["c"], x["d"], F.lit(-1))).otherwise(a["counts"])
        same = full & (x["a"] == x["c"]) & (x["b"] == x["d"])
        enters = count(a, x["a"], x["b"]) - F.when(same, 1).otherwise(0)
        total = (a["total"] + F.when(full, _part(leaves - 1) - _part(leaves)).otherwise(F.lit(0.0))
                 + _part(enters + 1) - _part(enters))
        bits = F.log2(F.lit(float(window))) - total / window
        return F.struct(
            added(less, x["a"], x["b"], F.lit(1)).alias("counts"), total.alias("total"), (a["n"] + 1).alias("n"),
            F.when(a["n"] + 1 >= window, F.greatest(a["best"], bits)).otherwise(a["best"]).alias("best"))

    start = F.struct(F.array_repeat(F.lit(0).cast("long"), NUMBERS).alias("counts"), F.lit(0.0).alias("total"),
                     F.lit(0).alias("n"), F.lit(0.0).alias("best"))
    return F.when(size >= window, F.aggregate(steps, start, step, lambda a: a["best"])).otherwise(F.lit(0.0))


def _dense(bits: float):
    # words and numbers alone are dense too
    return lambda run: run.rlike("[0-9]") & run.rlike("[A-Za-z]") & (window_entropy(run) >= bits)


def _spans(kind: str, order: int, keep) -> Column:
    return F.transform(F.filter(kind, keep), lambda s: F.struct(
        s["start"].alias("start"), F.lit(order).alias("order"), s["end"].alias("end"),
        F.lit(kind).alias("kind")))


def secret_spans(docs: DataFrame, text: str = "text") -> DataFrame:
    """Add ``base`` and ``spans`` to ``docs``: arrays of ``(start, order, end, kind)``,
    sorted by start and kind. ``spans`` holds the base ones and ``entropy`` spans that
    overlap none of them. NULL counts as empty. Rows are judged one by one, so repeated
    rows give repeated results and no rows give none. Columns of ``docs`` named
    ``base`` or ``spans`` are replaced, other columns are kept."""
    t = F.coalesce(F.col(text).cast("string"), F.lit(""))
    df = docs.select(F.struct("*").alias("_doc"), t.alias("_text"))
    has = lambda *marks: F.greatest(*(F.instr("_text", m) for m in marks), F.lit(0)) > 0
    df = with_matches(df, "_text", {
        "assign": (ASSIGN, has(":", "=")), "access": (ACCESS, has("AKIA")),
        "hex": (HEX, F.lit(True)), "entropy": (CANDIDATE, F.lit(True))})
    base = F.array_sort(F.concat(
        _spans("assign", 0, lambda s: F.length(F.regexp_extract(s["value"], f"^{ASSIGN}$", 1)) >= 12),
        _spans("access", 1, lambda s: F.lit(True)), _spans("hex", 2, lambda s: F.lit(True))))
    df = df.withColumn("_base", base)

    def secret(s):
        v = s["value"]
        known = F.lit(False)
        for p in ALLOWED:
            known = known | v.rlike(p)
        taken = F.exists("_base", lambda b: (b["start"] < s["end"]) & (s["start"] < b["end"]))
        dense = F.lit(False)
        for pattern, bits in CLASSES:
            dense = dense | F.exists(F.regexp_extract_all(v, F.lit(pattern), 0), _dense(bits))
        return F.when(known | taken, F.lit(False)).otherwise(dense)

    df = df.withColumn("_spans", F.array_sort(F.concat("_base", _spans("entropy", 3, secret))))
    keep = [F.col(f"_doc.`{c}`").alias(c) for c in docs.columns if c not in ("base", "spans")]
    return df.select(*keep, F.col("_base").alias("base"), F.col("_spans").alias("spans"))


def redact_secrets(docs: DataFrame, text: str = "text", mark: str = "[SECRET]") -> DataFrame:
    """``docs`` with every secret span of ``text`` replaced by ``mark``. A NULL text
    stays NULL. Columns and their order stay."""
    df = secret_spans(docs.select(F.struct("*").alias("doc"), F.col(text).cast("string").alias("t")), "t")
    return df.withColumn("new", redacted("t", "spans", mark)).select(
        *(F.col("new" if c == text else f"doc.`{c}`").alias(c) for c in docs.columns))


def op10_secrets(spark, sf_dir):
    df = secret_spans(table(spark, sf_dir, "documents").select("doc_id", "text"))
    count = lambda k: F.size(F.filter("base", lambda s: s["kind"] == k)).cast("long")
    return df.select("doc_id", *(count(k).alias(f"n_{k}") for k in BASE),
                     F.sha2(said(F.col("base")), 256).alias("base_sha256"),
                     said(F.col("spans")).alias("spans"))


QUERIES = {"op10_secrets": op10_secrets}
