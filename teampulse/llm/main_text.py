"""Main text of web pages by differencing against the nearest page of the host.

Each page is cut into blocks of text.  Pages of a host are put in the order of their
URL paths, and each is paired with the neighbour that shares more leading path
segments.  The blocks of both are aligned by their longest common subsequence; what
they share is the host's frame and is deleted.

Differencing cannot do the whole job where menus and notices differ from page to page
and articles share sentences, as they do in the given tables.  So markup is read
first: elements that never hold an article are left out, and blocks inside an element
that the page marks as its article are its text, shared or not.  All other blocks are
the neighbour's to judge, beside a marked article and on pages without one: shared ones
are deleted.  A neighbour that shares nearly all of these is a copy, not a frame, and deletes
nothing; beside a marked article, what no frame is known for does not count as its text.

Neighbours are found by global row numbers, not by a window over a host, so a host
with a third of all pages is spread like any other.  Alignment sees hashes only.

Defined cases: NULL and empty pages have an empty text; NULL URLs share one empty
host and path; equal URLs are no frame for each other; ties go to the page before;
repeated rows are extracted each; unclosed and truncated markup ends with the page;
an empty table gives no rows; other columns are not read.
"""

from __future__ import annotations

import html
import re

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from teampulse.llm.common import map_batches, stored
from teampulse.llm.sharding import numbered

#: Share of its blocks outside an article that a page may share with a frame; above it is a copy.
COPY_SHARE = 0.8
ARTICLE, OTHER = 1, 0

# Elements that end a block, that never hold an article, that open a region, and words of class names.
BLOCKS = set(
    "address article aside blockquote body dd details dialog div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 "
    "head header hr html legend li main menu nav ol option p pre section summary table tbody td tfoot th thead tr ul".split()
)
RAW = set("script style noscript template iframe svg textarea title select button object canvas audio video math head".split())
DROPPED = set("nav aside form footer menu dialog".split())
REGIONS = DROPPED | set("article main header div section ul ol dl table figure details span blockquote body".split())
CLASS_WORDS = set(
    "ad ads advert adverts advertisement advertising sponsor sponsored sponsors promo promotion banner cookie cookies consent gdpr notice "
    "notices notification alert popup modal overlay newsletter subscribe subscription signup login sidebar menu menus nav navbar navigation "
    "breadcrumb breadcrumbs footer masthead comment comments disqus discussion replies share sharing social related recommended recommendations "
    "widget widgets toolbar pagination pager skip hidden".split()
)
ROLES = set("navigation banner contentinfo complementary search dialog alert alertdialog menu menubar form".split())

TOKEN = re.compile(r"""<!--.*?(?:-->|\Z)|<(?P<close>/?)(?P<name>[a-zA-Z][^\s/>]*)(?P<rest>(?:[^>"']|"[^"]*"|'[^']*'|["'])*?)(?:>|\Z)|<[!?/][^>]*(?:>|\Z)""", re.S)
ATTRIBUTE = re.compile(r"""(class|id|role|hidden|aria-hidden|itemprop|style)(?:\s*=\s*("[^"]*"|'[^']*'|[^\s"'>]+))?(?=[\s/>]|$)""", re.I)


def _attributes(rest: str) -> dict[str, str]:
    return {name.lower(): html.unescape(value.strip("\"'")).lower() for name, value in ATTRIBUTE.findall(rest)} if rest.strip(" /") else {}


def _hinted(found: dict[str, str]) -> bool:
    """Whether attributes say that an element is no part of an article."""
    if "hidden" in found or found.get("aria-hidden") == "true" or re.search(r"display\s*:\s*none", found.get("style", "")):
        return True
    if found.get("role") in ROLES:
        return True
    names = f"{found.get('class', '')} {found.get('id', '')}".split()
    return any(CLASS_WORDS.intersection(re.split(r"[^a-z]+", n)) for n in names if not re.match(r"(has|with|no|without|is)[-_]", n))


def blocks(page: str) -> list[tuple[str, int]]:
    """The blocks of a page in order, each with whether it stands in a marked article."""
    out: list[tuple[str, int]] = []
    words: list[str] = []
    regions: list[tuple[str, bool, bool]] = []  # name, dropped, in an article; each with what lies around it
    dropped = article = False

    def end() -> None:
        text = " ".join(html.unescape("".join(words)).split())
        if text:
            out.append((text, ARTICLE if article else OTHER))
        words.clear()

    at, size = 0, len(page)
    while at < size:
        m = TOKEN.search(page, at)
        if not dropped:
            words.append(page[at : m.start() if m else size])
        if not m:
            break
        at = m.end()
        name = (m["name"] or "").lower()
        if not name:
            continue
        if name in RAW and not m["close"]:
            if name in BLOCKS and not dropped:
                end()
            close = re.compile(rf"</{name}\b[^>]*(?:>|\Z)" + (r"|(?=<body\b)" if name == "head" else ""), re.I).search(page, at)
            at = close.end() if close else size
            continue
        if name in BLOCKS and not dropped:
            end()
        elif name == "br" and not dropped:
            words.append(" ")
        if name not in REGIONS:
            continue
        if m["close"]:
            depth = next((i for i in range(len(regions) - 1, -1, -1) if regions[i][0] == name), -1)
            if depth >= 0:
                if not dropped:
                    end()
                del regions[depth:]
        elif not m["rest"].endswith("/"):
            if name == "body":
                regions.clear()
            _, gone, within = regions[-1] if regions else ("", False, False)
            found = _attributes(m["rest"])
            gone = gone or name in DROPPED or (name == "header" and not within) or (name != "body" and _hinted(found))
            within = within or name in ("article", "main") or found.get("role") in ("main", "article") or found.get("itemprop") == "articlebody"
            regions.append((name, gone, within))
        _, now_dropped, article_now = regions[-1] if regions else ("", False, False)
        if now_dropped and not dropped or article_now != article:
            end()
        dropped, article = now_dropped, article_now
    end()
    return out


def _prefix_lengths(a: list, b: list) -> np.ndarray:
    """Lengths of the longest common subsequences of ``a`` and every prefix of ``b``, a row of bits at a time."""
    where: dict = {}
    for j, x in enumerate(b):
        where[x] = where.get(x, 0) | 1 << j
    full = (1 << len(b)) - 1
    row = full
    for x in a:
        both = row & where.get(x, 0)
        row = ((row + both) | (row - both)) & full
    bits = np.unpackbits(np.frombuffer(row.to_bytes(len(b) // 8 + 1, "little"), np.uint8), bitorder="little")[: len(b)]
    return np.concatenate([[0], np.cumsum(1 - bits.astype(np.int64))])


def common(a: list, b: list, start: int = 0) -> list[int]:
    """Positions in ``a`` of a longest common subsequence with ``b``; memory grows with the lengths, not their product."""
    first = 0
    while first < len(a) and first < len(b) and a[first] == b[first]:
        first += 1
    last = 0
    while last < min(len(a), len(b)) - first and a[-1 - last] == b[-1 - last]:
        last += 1
    head, tail = list(range(start, start + first)), list(range(start + len(a) - last, start + len(a)))
    a, b, start = a[first : len(a) - last], b[first : len(b) - last], start + first
    known, wanted = set(b), set(a)
    places = [i for i, x in enumerate(a) if x in known]
    a, b = [a[i] for i in places], [x for x in b if x in wanted]
    if not a:
        found = []
    elif len(a) == 1:
        found = [0]
    else:
        half = len(a) // 2
        cut = int((_prefix_lengths(a[:half], b) + _prefix_lengths(a[half:][::-1], b[::-1])[::-1]).argmax())
        found = common(a[:half], b[:cut]) + common(a[half:], b[cut:], half)
    return head + [start + places[i] for i in found] + tail


def frame(own: list[int], kinds: list[int], other: list[int]) -> list[int]:
    """Positions of the blocks that a page shares with the frame of its neighbour."""
    shared = common(own, other)
    outside = kinds.count(OTHER)
    return [] if sum(kinds[i] == OTHER for i in shared) > COPY_SHARE * outside and outside else shared


def kept(texts: list[str], kinds: list[int], shared: list[int]) -> str:
    """The blocks that are not shared, and all of a marked article.

    What stands outside a marked article is told apart by the neighbour too; where the
    neighbour shows no frame there, the mark alone tells.
    """
    marked = ARTICLE in kinds
    gone = {i for i in shared if not marked or kinds[i] == OTHER}
    if marked and not gone:
        gone = {i for i, k in enumerate(kinds) if k == OTHER}
    return "\n".join(t for i, t in enumerate(texts) if i not in gone)


def _keyed(pages: DataFrame, page_id: str, url: str, body: str) -> DataFrame:
    """The columns that count, and a hash of their values: rows with one hash are one page."""
    rows = pages.select(F.col(page_id).alias("page_id"), F.col(url).alias("url"), F.col(body).alias("html"))
    known = F.concat(F.col("url").isNull().cast("string"), F.col("html").isNull().cast("string"))
    return rows.withColumn("row", F.xxhash64(F.col("page_id").cast("string"), "url", "html", known))


def _cut(keyed: DataFrame) -> DataFrame:
    """row, url, kinds and hashes of the blocks; the texts stay where they are."""

    def make():
        def step(batch: pa.RecordBatch) -> pa.RecordBatch:
            found = [blocks(p or "") for p in batch.column(2).to_pylist()]
            hashes = [[xxhash.xxh3_64_intdigest(t) - (1 << 63) for t, _ in f] for f in found]
            arrays = [pa.array([[k for _, k in f] for f in found], pa.list_(pa.int32())), pa.array(hashes, pa.list_(pa.int64()))]
            return pa.RecordBatch.from_arrays([*batch.columns[:2], *arrays], names=["row", "url", "kinds", "hashes"])

        return step

    return map_batches(keyed.select("row", "url", "html"), make, "row long, url string, kinds array<int>, hashes array<bigint>").dropDuplicates(["row"])


def neighbours(pages: DataFrame) -> DataFrame:
    """row, near: the page whose URL path is nearest, of the pages before and after in the host's order."""
    address = F.coalesce(F.regexp_replace("url", r"^[A-Za-z][A-Za-z0-9+.-]*://|[?#].*$", ""), F.lit(""))
    rows = pages.select("row", F.lower(F.regexp_extract(address, "^[^/]*", 0)).alias("host"), F.regexp_replace(F.regexp_extract(address, "/.*$", 0), r"/$|\.html?$", "").alias("path"))
    order, _ = numbered(rows, ["host", "path"])
    order = order.select("row", "host", F.split("path", "/").alias("path"), "row_number")
    before = order.select("host", (F.col("row_number") + 1).alias("row_number"), F.col("row").alias("before"), F.col("path").alias("path_before"))
    after = order.select("host", (F.col("row_number") - 1).alias("row_number"), F.col("row").alias("after"), F.col("path").alias("path_after"))
    both = order.join(before, ["row_number", "host"], "left").join(after, ["row_number", "host"], "left")

    def depth(other: str):
        """Leading segments in common; -1 for the same path or none."""
        same = F.zip_with("path", other, lambda x, y: x.eqNullSafe(y))
        first = F.array_position(same, F.lit(False))
        return F.coalesce(F.when(F.col(other) == F.col("path"), F.lit(-1).cast("long")).otherwise(first - 1), F.lit(-1).cast("long"))

    both = both.withColumn("b", depth("path_before")).withColumn("a", depth("path_after"))
    near = F.when((F.col("b") < 0) & (F.col("a") < 0), F.lit(None).cast("long")).when(F.col("b") >= F.col("a"), F.col("before")).otherwise(F.col("after"))
    return both.select("row", near.alias("near"))


def frames(cut: DataFrame) -> DataFrame:
    """row, shared: the positions of the blocks that a page has in common with its neighbour, where there are any."""
    near = neighbours(cut).where("near IS NOT NULL").join(cut.select(F.col("row").alias("near"), F.col("hashes").alias("other")), "near")
    both = cut.join(near.select("row", "other"), "row").select("row", "kinds", "hashes", "other")

    def make():
        def step(batch: pa.RecordBatch) -> pa.RecordBatch:
            kinds, hashes, other = (c.to_pylist() for c in batch.columns[1:])
            shared = pa.array([frame(h, k, o) for h, k, o in zip(hashes, kinds, other)], pa.list_(pa.int32()))
            return pa.RecordBatch.from_arrays([batch.column(0), shared], names=["row", "shared"])

        return step

    return map_batches(both, make, "row long, shared array<int>").where(F.size("shared") > 0)


def main_text(pages: DataFrame, page_id: str = "page_id", url: str = "url", body: str = "html") -> DataFrame:
    """page_id, url, text, n_chars and the positions of frame blocks, for every page.

    Pages are read twice, for their hashes and for their texts, and are shuffled only
    if the table of shared blocks is too large for the planner to broadcast.
    """
    keyed = _keyed(pages, page_id, url, body)
    shared = stored(frames(stored(_cut(keyed), "blocks")), "frames")
    both = keyed.join(shared, "row", "left").select("page_id", "url", "html", "shared")

    def make():
        def step(batch: pa.RecordBatch) -> pa.RecordBatch:
            html_, shared = (c.to_pylist() for c in batch.columns[2:])
            text = [kept(*zip(*found), s or []) if (found := blocks(p or "")) else "" for p, s in zip(html_, shared)]
            arrays = [pa.array(text, pa.string()), pa.array(map(len, text), pa.int64()), pa.array([s or [] for s in shared], pa.list_(pa.int32()))]
            return pa.RecordBatch.from_arrays([*batch.columns[:2], *arrays], names=["page_id", "url", "text", "n_chars", "shared"])

        return step

    kind = keyed.schema["page_id"].dataType.simpleString()
    return map_batches(both, make, f"page_id {kind}, url string, text string, n_chars long, shared array<int>")
