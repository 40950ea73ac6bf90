"""Tagged facts of filings.

Only splitting markup into tagged elements needs Python. Everything that follows,
formats and numbers included, is a Column expression on the element rows.
"""

from __future__ import annotations

import re
import sys
from collections.abc import Iterable
from datetime import date
from itertools import accumulate

from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as types_

from filigree import fixed_values as fv
from filigree.functions import text as T
from filigree.functions import values

#: Filings whose elements are held at a time.
SLICE = 256

# Workers get this module by value, so it need not be installed on them.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

ELEMENT = (
    "struct<ord:int,kind:string,name:string,text:string,format:string,scale:int,"
    "sign:string,instant:string,start_date:string,end_date:string>")
_FIELDS = ("ord", "kind", "name", "text", "format", "scale", "sign",
           "instant", "start_date", "end_date")


_DATES = ("instant", "startdate", "enddate")
_FACTS = ("nonfraction", "nonnumeric")
_NOTABLE = frozenset(("html", "xbrl", "exclude", "context", "continuation", *_DATES, *_FACTS))


# xs:date or xs:dateTime, and a number once blanks and group marks are gone
_DAY = re.compile(r"(\d{4})-(\d{2})-(\d{2})(?:T\d{2}:\d{2}:\d{2}(?:\.\d+)?)?(?:Z|[+-]\d{2}:\d{2})?")
_NUMBER = re.compile(r"[+-]?(?:\d+(?:\.\d*)?|\.\d+)")


def _day(text):
    """The day of a context date, None if it is none."""
    match = _DAY.fullmatch(text)
    try:
        return date(*map(int, match.groups())).isoformat() if match else None
    except ValueError:
        return None


def _local(name):
    return name.rsplit(":", 1)[-1].lower()


class _Names(dict):
    """Short forms of element and attribute names, made once each."""

    def __missing__(self, name):
        if len(self) > 10_000:  # names that documents make up
            self.clear()
        lower = name.lower()
        self[name] = short = lower if lower == "xsi:nil" else _local(name)
        return short


class _Collector:
    """Markup events in, tagged elements out."""

    def __init__(self, short=None):
        self.elements, self.contexts, self.continued = [], {}, {}
        self.kinds, self.short = {}, _Names() if short is None else short  # kinds of names seen so far
        self.open, self.context, self.excluded, self.rooted = [], None, 0, False
        self.odd_dates = []

    def start(self, name, attrs):
        kind = self.kinds.get(name)
        if kind is None:
            kind = self.kinds[name] = _local(name)
        if kind not in _NOTABLE and "contextRef" not in attrs and "contextref" not in attrs:
            if self.open:
                self.open.append((name, None, None))
            return
        if kind in ("html", "xbrl"):
            self.rooted = True
        elif kind == "exclude":
            self.excluded += 1
        elif kind in _DATES:
            self.open.append((name, None, []))
        else:
            attrs = dict(zip(map(self.short.__getitem__, attrs), attrs.values()))
            get = attrs.get
            if kind == "context":
                self.context = self.contexts.setdefault(get("id"), {})
            elif kind == "continuation":
                self.open.append((name, attrs, []))
            else:
                numeric = kind == "nonfraction" or (kind != "nonnumeric" and "unitref" in attrs)
                element = {
                    "format": get("format"), "scale": get("scale"), "sign": get("sign"), "ord": len(self.elements),
                    "kind": "numeric" if numeric else "nonnumeric", "name": get("name") if kind in _FACTS else name,
                    "ref": get("contextref"), "next": get("continuedat"), "nil": get("xsi:nil") in ("true", "1")}
                self.elements.append(element)
                self.open.append((name, element, []))

    def data(self, text):
        if self.open and not self.excluded:
            for _, _, pieces in self.open:
                if pieces is not None:
                    pieces.append(text)

    def end(self, name):
        kind = self.kinds.get(name)
        if kind == "exclude":
            self.excluded = max(0, self.excluded - 1)
        elif kind == "context":
            self.context = None
        elif self.open:
            if self.open[-1][0] != name and all(opened != name for opened, _, _ in self.open):
                return
            while self.open:  # also closes elements left open by loose markup
                opened, target, pieces = self.open.pop()
                self._close(opened, target, pieces)
                if opened == name:
                    break

    def _close(self, opened, target, pieces):
        if pieces is None:
            return
        kind, text = self.kinds[opened], "".join(pieces)
        if kind == "continuation":
            self.continued[target.get("id")] = (text, target.get("continuedat"))
        elif target is not None:
            target["text"] = text
        elif self.context is not None:
            text = text.strip()
            self.context[kind] = _day(text)
            if text and self.context[kind] is None:
                self.odd_dates.append(text)

    def finish(self):
        while self.open:
            self._close(*self.open.pop())
        if not self.rooted:
            raise ValueError("neither an html nor an xbrl document")
        for element in self.elements:
            following = element["next"]
            if element["nil"]:
                element["text"] = None
            elif following in self.continued:
                seen, more = set(), [element["text"]]
                while following in self.continued and following not in seen:
                    seen.add(following)
                    text, following = self.continued[following]
                    more.append(text)
                element["text"] = "".join(more)
            dates = self.contexts.get(element["ref"], {})
            element["instant"] = dates.get("instant")
            element["start_date"] = dates.get("startdate")
            element["end_date"] = dates.get("enddate")
            scale = element["scale"]
            element["scale"] = int(scale) if scale and scale.strip().lstrip("+-").isdigit() else None
        return self.elements, [f"Date {d} not understood" for d in self.odd_dates]


def _read_strict(content, short):
    import html
    from xml.parsers import expat

    collector, parser = _Collector(short), expat.ParserCreate()
    parser.buffer_text = True
    parser.UseForeignDTD(True)  # HTML entities are then skipped instead of fatal
    parser.StartElementHandler = collector.start
    parser.EndElementHandler = collector.end
    parser.CharacterDataHandler = collector.data
    parser.SkippedEntityHandler = lambda n, parameter: collector.data(
        "" if parameter else html.unescape(f"&{n};"))
    parser.Parse(content, True)
    return collector.finish()


def _read_loose(content, short):
    from html.parser import HTMLParser

    collector = _Collector(short)

    class Loose(HTMLParser):
        def handle_starttag(self, tag, attrs):
            if tag not in ("br", "hr", "img", "meta", "link", "input", "col"):
                collector.start(tag, dict(attrs))

        def handle_startendtag(self, tag, attrs):
            self.handle_starttag(tag, attrs)
            collector.end(tag)

        def handle_endtag(self, tag):
            collector.end(tag)

        def handle_data(self, data):
            collector.data(data)

    reader = Loose(convert_charrefs=True)
    reader.feed(content)
    reader.close()
    return collector.finish()


def read_elements(content: str, short: dict | None = None) -> tuple[list[dict], list[str]]:
    """Tagged elements of one document in document order, dates resolved, and warnings.
    ``short`` keeps short forms of names from one document to the next."""
    from xml.parsers import expat

    text = content.lstrip("﻿ \t\r\n")
    try:
        return _read_strict(text, short)
    except expat.ExpatError:
        return _read_loose(text, short)


def parse_filings(filings: DataFrame, tags: Iterable[str] | None = None,
                  content: str = "content") -> DataFrame:
    """One row per filing: the other columns as they came, then ``elements``,
    ``warnings``, ``error``. ``content`` is kept only for filings with an error or a
    warning, for the quarantine.

    A filing that cannot be read gets an ``error`` and loses none of its neighbours.
    Elements of unmapped tags are left out when ``tags`` is given; their formats
    are still checked.
    """
    wanted = None if tags is None else frozenset(tags)
    known = values.KNOWN_FORMATS
    dots, commas = frozenset(fv.DOT_DECIMAL_FORMATS), frozenset(fv.COMMA_DECIMAL_FORMATS)
    out = types_.StructType(filings.drop(content).schema.fields).add(
        content, types_.StringType())
    out = out.add("elements", types_.StructType.fromDDL(f"x array<{ELEMENT}>")["x"].dataType)
    out = out.add("warnings", types_.ArrayType(types_.StringType())).add(
        "error", types_.StringType())

    def no_number(e, form):
        """Whether a numeric element holds text that its format can't read."""
        body = "".join((e["text"] or "").split())
        if not body or not (form is None or form in dots or form in commas):
            return False
        if form in commas:
            return not _NUMBER.fullmatch(body.replace(".", "").replace(",", "."))
        return body not in ("-", "–", "—") and not _NUMBER.fullmatch(body.replace(",", ""))

    def parse_one(text, short):
        try:
            elements, odd_dates = read_elements(text or "", short)
        except Exception as failure:  # one bad file must not stop its batch
            return [], [], f"{type(failure).__name__}: {failure}"
        odd, unread = [], []
        for e in elements:
            form = e["format"] and short[e["format"]]
            if form and form not in known:
                odd.append(f"Format {e['format']} not implemented")
            if e["kind"] == "numeric" and no_number(e, form):
                unread.append(f"Number {e['text'].strip()} not understood")
        rows = elements if wanted is None else [e for e in elements if e["name"].rsplit(":", 1)[-1] in wanted]
        return rows, odd + odd_dates + unread, None

    def parse(batches):
        import pyarrow as pa

        fields = [pa.field(f, pa.int32() if f in ("ord", "scale") else pa.string()) for f in _FIELDS]
        short = _Names()
        for batch in (b.slice(k, SLICE) for b in batches for k in range(0, max(1, b.num_rows), SLICE)):
            texts = batch.column(content).to_pylist()
            found = [parse_one(t, short) for t in texts]
            kept = [t if e or w else None for t, (_, w, e) in zip(texts, found)]
            rows = [e for es, _, _ in found for e in es]
            ends = accumulate((len(es) for es, _, _ in found), initial=0)
            columns = [pa.array([e[f.name] for e in rows], f.type) for f in fields]
            result = batch.drop_columns([content])
            result = result.append_column(content, pa.array(kept, pa.string()))
            result = result.append_column("elements", pa.ListArray.from_arrays(
                pa.array(ends, pa.int32()), pa.StructArray.from_arrays(columns, fields=fields)))
            result = result.append_column(
                "warnings", pa.array([w for _, w, _ in found], pa.list_(pa.string())))
            yield result.append_column("error", pa.array([e for _, _, e in found], pa.string()))

    return filings.mapInArrow(parse, out)


def facts(parsed: DataFrame, *keep: str) -> DataFrame:
    """One row per tagged fact: ord, kind, tag, value (text), num_value, dates."""
    rows = parsed.where(F.col("error").isNull()).select(*keep, F.inline("elements"))
    fmt, text = F.col("format"), F.col("text")
    is_number = F.col("kind") == "numeric"
    return rows.select(
        *keep, "ord", "kind", T.local_name(F.col("name")).alias("tag"),
        F.when(~is_number, T.text_value(values.text(text, fmt))).alias("value"),
        F.when(is_number, values.number(text, fmt, F.col("scale"), F.col("sign")))
        .alias("num_value"),
        "instant", "start_date", "end_date")
