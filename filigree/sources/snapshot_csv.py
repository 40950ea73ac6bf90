"""Company snapshot CSV files."""

from __future__ import annotations

import sys
from functools import reduce

from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from filigree import fixed_values as fv
from filigree.functions import text as T

# Workers get this module by value, so it need not be installed on them.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

_HIGH_BYTES = "".join(map(chr, range(0x80, 0xA0)))


def _lines(spark: SparkSession, paths) -> DataFrame:
    """Lines of text files with their places: ``file_path``, ``file_name``, ``block`` (the
    offset of the split that a line begins in) and ``value``, its bytes as they are."""
    return spark.read.option("pathGlobFilter", "*.[cC][sS][vV]").option(
        "recursiveFileLookup", True).option("lineSep", "\n").text(paths).select(
        F.col("_metadata.file_path").alias("file_path"), F.col("_metadata.file_name").alias("file_name"),
        F.col("_metadata.file_block_start").alias("block"), "value")


def file_profiles(spark: SparkSession, path: str) -> DataFrame:
    """One row per CSV file: is it UTF-8, can it be split by lines, does it break lines
    by carriage returns alone, its header line.

    The whole of every file is checked, in parallel by lines: a line feed is never
    part of a longer UTF-8 character, so a file is valid when all its lines are. A
    file whose lines all hold an even number of quotes has no line break inside a
    field, so it can be read in splits.
    """
    lines = _lines(spark, path).select(
        "file_path", F.struct("block", F.monotonically_increasing_id()).alias("at"),
        F.endswith("value", F.lit("\r")).alias("crlf"), F.regexp_replace("value", "\r$", "").alias("value"),
        F.is_valid_utf8("value").alias("utf8"))
    quotes = F.length("value") - F.length(F.replace("value", F.lit('"'), F.lit("")))
    alone = F.contains("value", F.lit("\r"))
    return lines.groupBy("file_path").agg(
        F.bool_and("utf8").alias("utf8"), F.bool_or(alone).alias("returns"),
        F.bool_and((quotes % 2 == 0) | alone).alias("splittable"),
        F.min_by("value", "at").alias("header"), F.min_by("crlf", "at").alias("crlf"))


# ---- files with line breaks inside fields, read in splits all the same ---------------

def ends_inside(line: str, inside: bool) -> bool:
    """Whether a line that begins inside a quoted field, or at a record's start, ends
    inside one. A quote opens a field at its start only; a doubled one stands for itself."""
    if '"' not in line:
        return inside
    at, n = 0, len(line)
    while True:
        if inside or (at < n and line[at] == '"'):
            at += not inside
            while True:  # to the quote that closes the field
                at = line.find('"', at)
                if at < 0:
                    return True
                if line[at + 1:at + 2] != '"':
                    break
                at += 2
            inside = False
        at = line.find(",", at)
        if at < 0:
            return False
        at += 1


def _by_block(batches):
    """Lines of each split in turn: ``(file, name, block, lines)``; used up one by one."""
    def rows():
        for b in batches:
            yield from zip(*(b.column(i).to_pylist() for i in range(4)), strict=True)

    stream = rows()
    ahead = next(stream, None)
    while ahead is not None:
        place = ahead[:3]

        def lines(place=place):
            nonlocal ahead
            while ahead is not None and ahead[:3] == place:
                yield ahead[3].decode("latin-1")
                ahead = next(stream, None)

        yield *place, lines()


def _effects(batches):
    """What each split does to the state it begins in: both parses at once."""
    import pyarrow as pa

    for file, _, block, lines in _by_block(batches):
        out, closes = [False, True], False
        for line in lines:
            out = [ends_inside(line, s) for s in out]
            closes = closes or not out[1]
        yield pa.RecordBatch.from_pydict({
            "file_path": [file], "block": pa.array([block], pa.int64()), "from_start": [out[0]],
            "from_inside": [out[1]], "closes": [closes]})


def _owners(effects) -> dict[tuple[str, int], tuple[int | None, int | None]]:
    """Per split: the split in which the record that it begins inside of began, and that
    of the record it ends inside of; None where it begins or ends between records."""
    found, file, owner = {}, None, None
    for e in sorted(effects, key=lambda e: (e.file_path, e.block)):
        if e.file_path != file:
            file, owner = e.file_path, None
        begun = owner
        if e.from_start if begun is None else e.from_inside:
            owner = e.block if begun is None or e.closes else begun
        else:
            owner = None
        found[file, e.block] = (begun, owner)
    return found


_RECORD = "file_path string, file_name string, record bigint, block bigint, text string"


def _records(owners: dict, encoding: str, whole: bool):
    """Records that begin and end in one split, or (not ``whole``) the pieces of the
    others, each with the split its record began in. Headers are left out."""
    def run(batches):
        import pyarrow as pa

        for file, name, block, lines in _by_block(batches):
            if (file, block) not in owners:
                raise RuntimeError(f"{file} was split in another way when its records were looked for")
            owner, last = owners[file, block]
            header, inside, held, out = block == 0, owner is not None, [], []

            def batch(out):
                kinds = (pa.string(), pa.string(), pa.int64(), pa.int64(), pa.string())
                return pa.RecordBatch.from_arrays(
                    [pa.array([r[i] for r in out], t) for i, t in enumerate(kinds)],
                    ["file_path", "file_name", "record", "block", "text"])

            def piece(owner):
                # cut at line ends, so no character is cut
                out.append((file, name, owner, block, "\n".join(held).encode("latin-1").decode(encoding)))

            for line in lines:
                held.append(line)
                inside = ends_inside(line, inside)
                if inside:
                    continue
                blank = owner is None and not any(x.strip() for x in held)
                if not blank and header:
                    header = False
                elif not blank and whole == (owner is None):
                    piece(owner)
                held, owner = [], None
                if len(out) >= 1000:
                    yield batch(out)
                    out.clear()
            if held and not whole:
                piece(last)
            if out:
                yield batch(out)
    return run


def _read_with_breaks(spark: SparkSession, files: list[str], utf8: bool, crlf: bool, columns: list[str]) -> DataFrame:
    """Files with line breaks inside fields, by splits. Each split is parsed from both
    states it may begin in, and these effects, put one after the other, tell where
    records begin; the driver sees one row per split. Only records that lie across the
    border of splits are brought together. In files whose lines end in CRLF (``crlf``),
    that is a line feed inside a field too."""
    lines = _lines(spark, files).select("file_path", "file_name", "block", F.col("value").cast("binary"))
    effects = lines.mapInArrow(
        _effects, "file_path string, block bigint, from_start boolean, from_inside boolean, closes boolean").collect()
    owners, encoding = _owners(effects), "utf-8" if utf8 else "latin-1"
    records = lines.mapInArrow(_records(owners, encoding, True), _RECORD).select("file_name", "text")
    across = [place for place, (begun, last) in owners.items() if begun is not None or last is not None]
    if across:
        here = reduce(lambda a, b: a | b, [
            (F.col("file_path") == f) & F.col("block").isin([b for g, b in across if g == f])
            for f in {f for f, _ in across}])
        pieces = lines.where(here).mapInArrow(_records(owners, encoding, False), _RECORD)
        joined = pieces.groupBy("file_path", "record").agg(F.first("file_name").alias("file_name"), F.array_join(
            F.transform(F.array_sort(F.collect_list(F.struct("block", "text"))), lambda p: p["text"]), "\n").alias("text"))
        records = records.unionByName(joined.select("file_name", "text"))
    schema = ", ".join("`{}` string".format(c.replace("`", "``")) for c in columns)
    text = F.regexp_replace("text", "\r$", "")
    if crlf:
        text = F.replace(text, F.lit("\r\n"), F.lit("\n"))
    return records.select("file_name", F.from_csv(text, schema, {"escape": '"', "mode": "PERMISSIVE"}).alias("r")).select(
        "r.*", F.col("file_name").alias("file_name"))


def from_cp1252(text: Column) -> Column:
    """Text that was read as ISO-8859-1: 0x80-0x9F mean other characters in cp1252."""
    return F.translate(text, _HIGH_BYTES, fv.CP1252_HIGH)


def read_snapshot(spark: SparkSession, path: str) -> DataFrame:
    """Every CSV below ``path``, all columns as strings, plus ``file_name``.

    Files are read together when they agree in encoding, in header and in how they can
    be split, and in their line ends; columns of different headers are matched by name.
    """
    groups: dict[tuple, list[str]] = {}
    for p in file_profiles(spark, path).orderBy("file_path").collect():  # one row per file
        how = "whole" if p.returns else "lines" if p.splittable else "breaks"
        groups.setdefault((p.utf8, how, p.crlf, p.header), []).append(p.file_path)
    if not groups:
        raise ValueError(f"no CSV file below {path}")

    parts = []
    for (utf8, how, crlf, _), files in groups.items():
        df = (
            spark.read.option("header", True).option("escape", '"').option("mode", "PERMISSIVE")
            .option("multiLine", how != "lines")
            .option("encoding", "UTF-8" if utf8 else "ISO-8859-1")
            .csv(files))
        names = df.columns  # as Spark names them: none empty, none twice
        if how == "breaks":
            df = _read_with_breaks(spark, files, utf8, crlf, names)
            name = F.col("file_name")
        else:
            name = F.col("_metadata.file_name").alias("file_name")
        columns = [F.col("`{}`".format(c.replace("`", "``"))) for c in names]
        if not utf8:
            columns = [from_cp1252(c).alias(n) for c, n in zip(columns, names)]
        df = df.select(*columns, name)
        if how == "whole":
            # lines end in carriage returns: one task per file can read it, the work
            # after it is spread again
            df = df.repartition(spark.sparkContext.defaultParallelism)
        parts.append(df)
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)


def normalise_rows(raw: DataFrame, headers: dict[str, str] | None = None, *keep: str) -> DataFrame:
    """Rename and project by exact header name; absent headers and blanks are NULL."""
    headers = headers or fv.SNAPSHOT_HEADERS
    present = set(raw.columns)

    def column(header, name):
        if header not in present:
            return F.lit(None).cast("string").alias(name)
        return T.flatten_controls(T.blank_to_null(F.col(f"`{header}`"))).alias(name)

    return raw.select(*keep, *[column(h, n) for h, n in headers.items()])
