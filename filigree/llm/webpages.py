"""Main text of web pages, by nearest-URL page differencing and page structure.

Pages are ordered by host and path over all tasks; each is paired with the neighbour of
its host that shares the longer start of its path. The text lines (blocks) of the two
are aligned by longest common subsequence, and what they share is template and goes.
The alignment is a longest common subsequence, by halves and bit rows: its memory is
linear in the lines, whatever repeats.

Structure comes first where a page has it: lines inside menus, headers, footers,
sidebars, notices, adverts, forms and reader comments go even if no other page has
them, and lines inside an article stay even if a copy of the page has them too.
"""

from __future__ import annotations

import html
import re
from urllib.parse import urlsplit

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from filigree.llm.work import small_batches, stored, table

TOKEN = re.compile(r"""<!--.*?(?:-->|\Z)|<[!?][^>]*+>?|<(/?)([a-zA-Z][^\s/>]*+)((?:[^>"']|"[^"]*+"|'[^']*+'|["'])*?)(?:>|\Z)""", re.S)
ATTRIBUTE = re.compile(r"""([a-zA-Z-]++)(?:\s*+=\s*+("[^"]*+"|'[^']*+'|[^\s"'>]++))?""")
RAW = {t: re.compile(rf"</{t}\b[^>]*>|\Z", re.I) for t in ("script", "style", "textarea", "title", "noscript", "iframe", "template", "xmp", "svg")}
BLOCKS = frozenset("""address article aside blockquote body button caption center dd details dialog dir div dl dt
fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 head header hr html legend li main menu nav ol
option p pre section select summary table tbody td tfoot th thead tr ul""".split())
VOID = frozenset("area base br col embed hr img input link meta source track wbr".split())
#: Elements that are nested in one another; others end wherever a block begins.
NESTED = frozenset("""article aside blockquote body button details dialog div dl fieldset figure footer form header
main menu nav ol section select table ul""".split())
BOILERPLATE = frozenset("nav header footer aside form button select menu dialog fieldset".split())
ROLES = frozenset("navigation banner contentinfo complementary search form dialog alertdialog alert menu menubar toolbar".split())
NAMES = re.compile(r"""(?:^|[\s_-])(?:ads?|adverts?|advertis\w*|sponsor\w*|promo\w*|banner|nav|navbar|navigation|menu|sidebar|
breadcrumbs?|cookies?|consent|gdpr|notice|popup|modal|newsletter|subscri\w*|signup|login|share|sharing|social|related|
recommend\w*|comments?|disqus|repl(?:y|ies)|respond|footer|masthead|widget|pagination|pager|toolbar|copyright)(?:$|[\s_-])""", re.I | re.X)
COMMENT = re.compile(r"(?:^|[\s_-])(?:comments?|repl(?:y|ies)|respond)(?:$|[\s_-])", re.I)
OUT, BODY, MAIN, ARTICLE = 0, 1, 2, 3


def _kind(tag: str, attributes: str, parent: int) -> int:
    if parent == OUT:
        return OUT
    a = {k.lower(): v.strip("\"'") for k, v in ATTRIBUTE.findall(attributes)} if attributes else {}
    names = f"{a.get('class', '')} {a.get('id', '')}"
    role = a.get("role", "").lower()
    if tag in ("html", "body"):
        return parent
    if tag == "article":
        return OUT if COMMENT.search(names) else ARTICLE
    if tag == "main" or role == "main":
        return max(parent, MAIN)
    if tag == "header" and parent == ARTICLE:  # its title
        return ARTICLE
    if (tag in BOILERPLATE or role in ROLES or "hidden" in a or a.get("aria-hidden") == "true"
            or re.search(r"display\s*:\s*none", a.get("style", "")) or NAMES.search(names)):
        return OUT
    return parent


def page_lines(page: str | None) -> tuple[list[str], list[int]]:
    """The blocks of text of a page and where each stands: outside (menus and the like),
    in the body, in its main part, or in an article."""
    page, lines, kinds = page or "", [], []
    stack, held, at = [("", BODY)], [], 0

    def flush():
        text = " ".join(html.unescape("".join(held)).split())
        held.clear()
        if text:
            lines.append(text)
            kinds.append(stack[-1][1])

    for m in iter(lambda: TOKEN.search(page, at), None):
        held.append(page[at:m.start()])
        at = m.end()
        close, tag = m[1], (m[2] or "").lower()
        if not tag:
            continue
        if tag in RAW and not close:
            at = RAW[tag].search(page, at).end()
            if tag != "svg":
                held.append(" ")
        elif tag in BLOCKS:
            flush()
            if tag in NESTED:
                if close:
                    open_ = [k for k in range(len(stack) - 1, 0, -1) if stack[k][0] == tag]
                    if open_:
                        del stack[open_[0]:]
                else:
                    stack.append((tag, _kind(tag, m[3], stack[-1][1])))
        elif tag == "br":
            held.append(" ")
    held.append(page[at:])
    flush()
    return lines, kinds


def host_and_path(url: str | None) -> tuple[str | None, str | None]:
    try:
        u = urlsplit(url or "")
        host = u.hostname
    except ValueError:
        return None, None
    return (host, u.path) if host else (None, None)


def _prefix_lengths(a: list[int], b: list[int]) -> np.ndarray:
    """Length of the longest common subsequence of ``a`` with each prefix of ``b``, in bit
    rows: a bit that is off is a place of ``b`` where the length goes up by one."""
    masks: dict[int, int] = {}
    for k, x in enumerate(b):
        masks[x] = masks.get(x, 0) | 1 << k
    every = (1 << len(b)) - 1
    row = every
    for x in a:
        met = row & masks.get(x, 0)
        row = (row + met | row - met) & every
    raw = np.frombuffer(row.to_bytes(-(-len(b) // 8), "little"), np.uint8)
    up = 1 - np.unpackbits(raw, bitorder="little")[:len(b)].astype(np.int64)
    return np.concatenate([[0], np.cumsum(up)])


def common(a: list[int], b: list[int]) -> np.ndarray:
    """For each line of ``a``, whether it is in a longest common subsequence with ``b``.
    Halves of ``a`` are aligned apart, with the part of ``b`` that serves both best, so
    memory stays linear; equal ends are taken off first."""
    out, todo = np.zeros(len(a), bool), [(0, len(a), 0, len(b))]
    while todo:
        i, j, k, n = todo.pop()
        while i < j and k < n and a[i] == b[k]:
            out[i] = True
            i, k = i + 1, k + 1
        while i < j and k < n and a[j - 1] == b[n - 1]:
            out[j - 1] = True
            j, n = j - 1, n - 1
        if i == j or k == n:
            continue
        if j - i == 1:
            out[i] = a[i] in b[k:n]
            continue
        middle = (i + j) // 2
        best = _prefix_lengths(a[i:middle], b[k:n]) + _prefix_lengths(a[middle:j][::-1], b[k:n][::-1])[::-1]
        cut = k + int(best.argmax())
        todo += [(i, middle, k, cut), (middle, j, cut, n)]
    return out


def _shared_start(a: str, b: str) -> int:
    n = min(len(a), len(b))
    return next((k for k in range(n) if a[k] != b[k]), n)


def _neighbours(batches):
    """Rows come sorted by host, path and row. Emits the neighbours of each row, and of a
    partition's first and last row (``edge``) what the partitions beside it need."""
    part, held, first = TaskContext.get().partitionId(), [], True
    names = ["row", "host", "path", "before", "before_path", "after", "after_path", "edge"]

    def out(rows, last):
        nonlocal first
        cols = [[] for _ in names]
        lead = 0 if first else 1  # one row of the batch before leads in
        for k in range(lead, len(rows) - (0 if last else 1)):
            row, host, path = rows[k]
            before = rows[k - 1] if k and rows[k - 1][1] == host else None
            after = rows[k + 1] if k + 1 < len(rows) and rows[k + 1][1] == host else None
            edge = [part] if (first and k == 0) or (last and k == len(rows) - 1) else None
            for c, v in zip(cols, (row, host, path, before and before[0], before and before[2],
                                   after and after[0], after and after[2], edge and part), strict=True):
                c.append(v)
        if len(rows) - lead > (0 if last else 1):
            first = False
        kinds = [pa.int64(), pa.string(), pa.string(), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64()]
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, kinds, strict=True)], names)

    for b in batches:
        rows = held + list(zip(*(b.column(i).to_pylist() for i in range(3)), strict=True))
        if len(rows) > 2:
            yield out(rows, False)
            rows = rows[-2:]
        held = rows
    if held:
        yield out(held, True)


def partners(pages: DataFrame) -> DataFrame:
    """``(row, partner)`` of ``pages (row, host, path)``: for each row of a host with
    others, the neighbour in path order that shares the longer start, or the one before."""
    near = stored(pages.where("host IS NOT NULL").repartitionByRange("host", "path", "row").sortWithinPartitions(
        "host", "path", "row").mapInArrow(
        _neighbours, "row long, host string, path string, before long, before_path string, after long, "
                     "after_path string, edge long"), "near")
    # a partition has two edge rows at most: few rows in all
    order = Window.orderBy("edge", "host", "path", "row")
    side = lambda c, k: F.when(F.lag("host", k).over(order) == F.col("host"), F.lag(c, k).over(order))
    edges = near.where("edge IS NOT NULL").select(
        "row", side("row", 1).alias("b"), side("path", 1).alias("bp"), side("row", -1).alias("a"), side("path", -1).alias("ap"))
    near = near.join(stored(edges.coalesce(1), "edges"), "row", "left").select(
        "row", "path", F.coalesce("before", "b").alias("b"), F.coalesce("before_path", "bp").alias("bp"),
        F.coalesce("after", "a").alias("a"), F.coalesce("after_path", "ap").alias("ap"))

    def run(batches):
        for batch in batches:
            rows, found = [], []
            for row, path, b, bp, a, ap in zip(*(batch.column(i).to_pylist() for i in range(6)), strict=True):
                if b is None and a is None:
                    continue
                rows.append(row)
                found.append(b if a is None or b is not None and _shared_start(path, bp) >= _shared_start(path, ap) else a)
            yield pa.RecordBatch.from_arrays([pa.array(rows, pa.int64()), pa.array(found, pa.int64())], ["row", "partner"])

    return near.mapInArrow(run, "row long, partner long")


def unlike_partners(pages: DataFrame) -> DataFrame:
    """``(row, partner)`` of ``pages (row, host, path, content)``: as ``partners``, but a
    row whose partner is a copy of it (of equal ``content``) gets a neighbour, in path
    order, of the first of its copies, copies taken as one page. A row of a host with
    copies only has no partner."""
    pairs = partners(pages.select("row", "host", "path")).join(pages.select("row", "host", "content"), "row").join(
        pages.select(F.col("row").alias("partner"), F.col("content").alias("other")), "partner")
    pairs = stored(pairs.select("row", "partner", "host", "content", (F.col("content") == F.col("other")).alias("same")), "pairs")
    firsts = stored(pages.where("host IS NOT NULL").groupBy("host", "content").agg(
        F.min(F.struct("path", "row")).alias("first")).select("host", "content", "first.path", "first.row"), "firsts")
    instead = firsts.select("row", "host", "content").join(
        partners(firsts.select("row", "host", "path")), "row").select("host", "content", "partner")
    return pairs.where("NOT same").select("row", "partner").union(
        pairs.where("same").select("row", "host", "content").join(instead, ["host", "content"]).select("row", "partner"))


def main_text(pages: DataFrame, page_id: str = "page_id", url: str = "url", page: str = "html") -> DataFrame:
    """One row per row of ``pages``: ``page_id``, ``url`` and ``text``: the blocks of the
    article in page order, joined by line breaks; white space inside a block is one
    blank, character references are decoded, empty text if there is none.

    A page without article or main part gives the lines of its body that its partner
    does not share. NULL pages are empty; a page with a NULL or broken url has no
    partner. Repeated rows and copies are pages of their own, but never partners of each
    other. Other columns are not looked at. No rows give no rows."""
    small_batches(pages.sparkSession)

    def parse(batches):
        for b in batches:
            out = [page_lines(p) for p in b.column(2).to_pylist()]
            where = [host_and_path(u) for u in b.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([
                b.column(0), b.column(1), pa.array([w[0] for w in where], pa.string()),
                pa.array([w[1] for w in where], pa.string()), pa.array([x[0] for x in out], pa.list_(pa.string())),
                pa.array([x[1] for x in out], pa.list_(pa.int32()))], ["page_id", "url", "host", "path", "lines", "kinds"])

    parsed = pages.select(F.col(page_id).cast("long"), F.col(url).cast("string"), F.col(page).cast("string")).mapInArrow(
        parse, "page_id long, url string, host string, path string, lines array<string>, kinds array<int>")
    parsed = stored(parsed.select(F.monotonically_increasing_id().alias("row"), "*"), "lines")
    pairs = unlike_partners(parsed.select("row", "host", "path", F.xxhash64("lines").alias("content")))
    hashes = parsed.select("row", F.transform("lines", lambda x: F.xxhash64(x)).alias("h"), "kinds")

    def align(batches):
        for b in batches:
            rows = b.column(0).to_pylist()
            found = [common(x, y) for x, y in zip(b.column(1).to_pylist(), b.column(2).to_pylist(), strict=True)]
            yield pa.RecordBatch.from_arrays([pa.array(rows, pa.int64()), pa.array(found, pa.list_(pa.bool_()))], ["row", "shared"])

    shared = pairs.join(hashes, "row").join(
        hashes.select(F.col("row").alias("partner"), F.col("h").alias("other")), "partner").select(
        "row", "h", "other", "kinds").mapInArrow(
            lambda batches: align(b.select(["row", "h", "other"]) for b in batches), "row long, shared array<boolean>")
    # only where a line of the body is shared does the alignment change a page's text
    body = parsed.where(F.exists("kinds", lambda k: k == BODY) & ~F.exists("kinds", lambda k: k > BODY)).select("row")
    shared = stored(shared.join(body, "row", "left_semi").where(F.exists("shared", lambda s: s)), "shared")
    best = F.array_max("kinds")
    keep = F.filter(F.arrays_zip("lines", "kinds", F.coalesce("shared", F.transform("kinds", lambda k: F.lit(False))).alias("shared")),
                    lambda z: F.when(best > BODY, z["kinds"] == best).otherwise((z["kinds"] == BODY) & ~z["shared"]))
    return parsed.join(shared, "row", "left").select(
        "page_id", "url", F.coalesce(F.array_join(F.transform(keep, lambda z: z["lines"]), "\n"), F.lit("")).alias("text"))


def op7_webpages(spark, sf_dir):
    return main_text(table(spark, sf_dir, "pages")).withColumn("n_chars", F.length("text").cast("long"))


QUERIES = {"op7_webpages": op7_webpages}
