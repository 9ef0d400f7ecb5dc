"""Main text of web pages: markup first, then nearest-URL page differencing.

A page is read into blocks of text, in page order. Menus, headers, footers, sidebars, forms, notices, adverts, scripts, styles and
reader comments go by their elements, roles and whole class names: "related-work" is no "related", and "no-sidebar" no "sidebar". What stands
in an article element (or else in main) is the page's text, whole; where only elements that would go hold one, they stay. On a page without either the markup leaves it open which blocks are the article; there each page is held against
the page of its host whose URL path is nearest, their lines are aligned by a longest common subsequence, and the lines that both
have are deleted. A page of which nothing would be left is a copy of the other, and keeps its lines.

Lines within an article are never deleted for being shared: articles of one host quote and repeat each other, and menus and
adverts that differ from page to page are shared by none, so differencing alone gives neither.

At scale: reading a page needs that page alone. Open pages are put in order by host and path over all tasks, by ranges, which
split a host that has most pages; a page's rank finds its neighbours by an equal join, so no host is any task's alone.

Defined results: null or empty html gives an empty text; a null url is a host of its own without a name; repeated rows give
repeated results, and equal open pages are copies that keep their lines; an empty table gives an empty result. Columns that clash with
the operator's are replaced by them. A page of any length and depth is read whole, in time that grows with its length.
"""

from __future__ import annotations

import bisect
import html as entities
import re
from collections.abc import Iterator, Sequence

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import read, stored, task_files, tidy

# HTML's elements and the names that pages give to what isn't their article.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style noscript template textarea iframe svg math title object canvas select".split())
#: Of these, elements that "/>" closes, and those whose content is never text: with no end tag they go on to the page's end.
FOREIGN, CODE = frozenset(("svg", "math")), frozenset(("script", "style"))
CHROME = frozenset("nav footer aside form menu button dialog fieldset".split())
BLOCKS = frozenset(
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li main menu nav ol p pre section summary table tbody td tfoot th thead tr ul".split()
)
ROLES = frozenset("navigation banner contentinfo complementary search form dialog alert alertdialog menu menubar toolbar".split())
NAMES = frozenset(
    """
    ad ads advert adverts advertisement advertising sponsor sponsored promo promotion banner cookie cookies consent gdpr notice notices notification popup modal overlay paywall
    newsletter subscribe subscription nav navbar navigation menu breadcrumb breadcrumbs sidebar footer comment comments commentlist disqus respond reply replies related recommended
    share sharing social widget pagination pager toolbar masthead signup login skip
    ad-banner ad-box ad-container ad-slot ad-unit ad-wrapper advert-box cookie-banner cookie-bar cookie-consent cookie-notice consent-banner gdpr-banner notice-bar
    newsletter-form newsletter-signup newsletter-box subscribe-box signup-form login-form nav-bar nav-menu site-nav main-nav main-menu site-menu top-nav side-bar site-sidebar
    site-header site-footer page-footer page-header comment-area comment-body comment-form comment-list comment-section comments-area comments-list comments-section user-comments reader-comments
    disqus-thread related-articles related-links related-posts recommended-articles recommended-posts read-more-links share-bar share-buttons share-links social-bar social-buttons social-links
    social-share sharing-buttons skip-link page-navigation post-navigation
    """.split()
)
#: An element that a start tag of its kind, or of those named, ends.
ENDS = {"li": ("li",), "dt": ("dt", "dd"), "dd": ("dt", "dd"), "tr": ("tr", "td", "th"), "td": ("td", "th"), "th": ("td", "th")}
#: How far up an end tag or ENDS looks.
SCOPE = frozenset("ul ol dl table div section article main body html".split())

_TOKEN = re.compile(r"<!--.*?(?:-->|\Z)|<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*)>|<[!?][^>]*>|</?[a-zA-Z][^>]*\Z", re.DOTALL)
_ATTRIBUTE = re.compile(r"([^\s=/\"']+)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>\"']+)))?")
_CAMEL = re.compile(r"(?<=[a-z])(?=[A-Z])")
_HOLDS = re.compile(r"<(?:article|main)[\s>]", re.IGNORECASE)
ARTICLE, MAIN, OPEN = 0, 1, 2


def _chrome(tag: str, text: str, inside: int) -> bool:
    if tag in CHROME or tag == "header" and inside == OPEN:
        return True
    if not text or text.isspace() or tag in ("html", "body", "main"):
        return False
    got = {m[1].lower(): m[2] or m[3] or m[4] or "" for m in _ATTRIBUTE.finditer(text)}
    if "hidden" in got or got.get("aria-hidden") == "true" or "display:none" in got.get("style", "").replace(" ", "").lower() or got.get("role", "").lower() in ROLES:
        return True
    names = f"{got.get('class', '')} {got.get('id', '')}"
    return any(w in NAMES for w in _CAMEL.sub("-", names).lower().replace("_", "-").split())


class _Stack:
    """Open elements. Of each kind it knows the places, so that finding one takes no walk."""

    def __init__(self) -> None:
        self.open: list[tuple[str, int, int]] = []  # element, what was dropped before it, and what it stands in
        self.at: dict[str, list[int]] = {}
        self.scopes: list[int] = []

    def push(self, tag: str, dropped: int, inside: int) -> None:
        self.at.setdefault(tag, []).append(len(self.open))
        if tag in SCOPE:
            self.scopes.append(len(self.open))
        self.open.append((tag, dropped, inside))

    def pop(self) -> tuple[str, int, int]:
        tag = self.open[-1][0]
        self.at[tag].pop()
        if tag in SCOPE:
            self.scopes.pop()
        return self.open.pop()

    def find(self, names: Sequence[str], scope: bool) -> int:
        """The place of the last of names, or -1; scope: only after the last of SCOPE."""
        k = max((self.at[n][-1] for n in names if self.at.get(n)), default=-1)
        return -1 if scope and self.scopes and self.scopes[-1] > k else k


def blocks(page: str | None, held: bool = False) -> list[tuple[str, int]]:
    """The text of each block of a page, with ARTICLE, MAIN or OPEN for where it stands; white space is one space. held: an
    element that would go doesn't, as far as it holds article or main."""
    page, out, text, at = page or "", [], [], 0
    stack, lost = _Stack(), set()
    dropped, inside = 0, OPEN

    def flush() -> None:
        if text:
            block = " ".join(entities.unescape("".join(text)).split())
            if block:
                out.append((block, inside))
            text.clear()

    def pop(depth: int) -> None:
        nonlocal dropped, inside
        while len(stack.open) > depth:
            tag, was_dropped, was = stack.pop()
            if tag in BLOCKS:
                flush()
            dropped, inside = was_dropped, was

    while at < len(page):
        m = _TOKEN.search(page, at)
        end = m.start() if m else len(page)
        if end > at and not dropped:
            text.append(page[at:end])
        if not m:
            break
        at = m.end()
        if not m[2]:
            continue
        tag = m[2].lower()
        if m[1]:
            k = stack.find((tag,), False)
            if k >= 0:
                pop(k)
            elif tag in BLOCKS:
                flush()
        elif tag in VOID:
            if tag in BLOCKS:
                flush()
            elif tag == "br" and not dropped:
                text.append(" ")
        elif tag in RAW:
            if tag in FOREIGN and m[3].endswith("/"):
                continue
            close = None if tag in lost else re.compile(rf"</{tag}\s*>", re.IGNORECASE).search(page, at)
            if close is None:
                lost.add(tag)  # nor is there one further on
            if close or tag in CODE:
                at = close.end() if close else len(page)
        else:
            if tag in BLOCKS:
                k = stack.find(("p",), True)
                if k >= 0:
                    pop(k)
                flush()
            if tag in ENDS and (k := stack.find(ENDS[tag], True)) >= 0:
                pop(k)
            if m[3].endswith("/") and tag not in BLOCKS:
                continue
            stack.push(tag, dropped, inside)
            gone = _chrome(tag, m[3], inside)
            if held and tag in ("article", "main") and not gone:
                dropped = 0
            dropped += gone
            if tag == "article":
                inside = ARTICLE
            elif tag == "main" and inside == OPEN:
                inside = MAIN
    flush()
    return out


def chosen(page: str | None) -> tuple[list[str], bool]:
    """The lines of the page's text, and whether markup leaves it open which of them are the article."""
    got = blocks(page)
    for again in (False, True):
        if again and not (page and _HOLDS.search(page)):
            break
        found = blocks(page, held=True) if again else got
        for kind in (ARTICLE, MAIN):
            lines = [t for t, k in found if k == kind]
            if lines:
                return lines, False
    return [t for t, _ in got], bool(got)


def common(a: Sequence[str], b: Sequence[str]) -> list[int]:
    """Places in a of a longest common subsequence of a and b: the longest chain of matches that rises in both."""
    where: dict[str, list[int]] = {}
    for j in range(len(b) - 1, -1, -1):
        where.setdefault(b[j], []).append(j)  # falling, so that a line of a takes one of b
    tails: list[int] = []
    links: list[tuple[int, tuple | None]] = []
    for i, line in enumerate(a):
        for j in where.get(line, ()):
            k = bisect.bisect_left(tails, j)
            link = (i, links[k - 1] if k else None)
            if k == len(tails):
                tails.append(j)
                links.append(link)
            else:
                tails[k], links[k] = j, link
    out, link = [], links[-1] if links else None
    while link:
        out.append(link[0])
        link = link[1]
    return out[::-1]


def differing(lines: list[str], other: list[str] | None) -> list[str]:
    """lines without those shared with the other page, or all of them where nothing would be left."""
    shared = set(common(lines, other)) if other else set()
    return [t for i, t in enumerate(lines) if i not in shared] or lines


_READ = pa.schema([("lines", pa.list_(pa.string())), ("open", pa.bool_())])


def _ordered(pages: DataFrame) -> DataFrame:
    """pages with rank, their place in the order of host and path over all tasks."""
    dealt = pages.repartitionByRange(task_files(pages), "host", "path", "page_id").sortWithinPartitions("host", "path", "page_id", "lines")
    names = dealt.columns

    @tidy
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task, n = TaskContext.get().partitionId(), 0
        for batch in batches:
            k = len(batch)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array([task] * k, pa.int32()), pa.array(range(n, n + k), pa.int64())], [*names, "task", "nth"])
            n += k

    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in dealt.schema.fields)
    rows = stored(dealt.mapInArrow(run, f"{schema}, task int, nth long"), shuffled=False)
    counts = rows.groupBy("task").agg(F.count("*").alias("n"))  # a row for each task
    before = counts.select("task", (F.sum("n").over(Window.orderBy("task")) - F.col("n")).alias("before"))
    return rows.join(F.broadcast(before), "task").withColumn("rank", F.col("before") + F.col("nth")).drop("task", "nth", "before")


def _shared_path(a: str, b: str) -> F.Column:
    """Segments that two paths begin with in common."""
    pairs = F.arrays_zip(F.split(a, "/").alias("a"), F.split(b, "/").alias("b"))
    return F.aggregate(pairs, F.struct(F.lit(0).alias("n"), F.lit(True).alias("on")), lambda s, x: F.struct((s["n"] + F.when(s["on"] & (x["a"] == x["b"]), 1).otherwise(0)).alias("n"), (s["on"] & F.coalesce(x["a"] == x["b"], F.lit(False))).alias("on")))["n"]


def _differenced(pages: DataFrame) -> DataFrame:
    """Open pages, with the lines that their nearest page of the host has not."""
    rows = stored(_ordered(pages), shuffled=False)
    light = rows.select(F.col("rank").alias("r"), F.col("host").alias("h"), F.col("path").alias("p"))
    near = []
    for name, step in (("before", -1), ("after", 1)):
        side = light.select((F.col("r") - step).alias("rank"), F.col("r").alias(name), F.col("h").alias(f"{name}_h"), F.col("p").alias(f"{name}_p"))
        near.append(side)
    out = rows.join(near[0], "rank", "left").join(near[1], "rank", "left")
    score = {n: F.when(F.col(f"{n}_h") == F.col("host"), _shared_path("path", f"{n}_p")).otherwise(-1) for n in ("before", "after")}
    best = F.when((score["before"] >= score["after"]) & (score["before"] >= 0), F.col("before")).when(score["after"] >= 0, F.col("after"))
    other = rows.select(F.col("rank").alias("other"), F.col("lines").alias("other_lines"))
    both = out.withColumn("other", best).join(other, "other", "left").select("page_id", "url", "lines", "other_lines")

    @tidy
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lines = [differing(a, b) for a, b in zip(batch.column(2).to_pylist(), batch.column(3).to_pylist(), strict=True)]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(lines, pa.list_(pa.string()))], ["page_id", "url", "lines"])

    return both.mapInArrow(run, "page_id long, url string, lines array<string>")


def main_text(pages: DataFrame) -> DataFrame:
    """page_id, url, text and n_chars of pages (page_id, url, html)."""

    @tidy
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            got = [chosen(h) for h in batch.column(2).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array([g[0] for g in got], pa.list_(pa.string())), pa.array([g[1] for g in got])], ["page_id", "url", "lines", "open"])

    source = pages.select(F.col("page_id").cast("long"), "url", "html")
    rows = stored(source.mapInArrow(run, "page_id long, url string, lines array<string>, open boolean"), shuffled=False)
    url = F.coalesce("url", F.lit(""))
    host = F.lower(F.regexp_extract(url, r"^[a-zA-Z][\w+.-]*://([^/?#]*)", 1))
    path = F.regexp_replace(F.regexp_replace(url, r"^[a-zA-Z][\w+.-]*://[^/?#]*", ""), r"[?#].*$", "")
    done = rows.where("not open").select("page_id", "url", "lines")
    left = rows.where("open")
    if not left.isEmpty():
        done = done.unionByName(_differenced(left.select("page_id", "url", "lines", host.alias("host"), path.alias("path"))))
    text = F.array_join("lines", "\n")
    return done.select("page_id", "url", text.alias("text"), F.char_length(text).cast("long").alias("n_chars"))


def op9_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return main_text(read(spark, sf_dir, "pages"))
