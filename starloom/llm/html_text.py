"""Main text of web pages: a host suffix array finds what pages share, block structure says how much sharing it takes.

A page is parsed into text blocks.  The blocks of all pages of a host form one token stream, a suffix array finds
the substrings of `length` tokens or more that distinct pages share, covered blocks are boilerplate and unique
runs stay.  Blocks with fewer tokens are shared as a whole or not at all.  How many pages it takes depends on
the structure that the page declares:

    inside a marked article (`article`, `main`, their role or item property)
        `article_pages` pages or more that are at least `article_share` of the host's: lines that a site puts into its
        articles.  Fewer pages may quote the same passage.
    on a page that marks no article
        two pages.
    outside the article, or in recognised furniture
        never text.

A large host is dealt over several suffix arrays by page.  A substring on `article_share` of the host's pages has
that share in one of the parts, so the parts' finds are all the candidates, and these are counted again over
all parts.  What two open pages of different parts share is found by the 64-bit hashes of their windows.  Results so
don't depend on the split.

Pages are parsed twice, once to hashed words for the arrays and once to the texts that stay: written down, they
would take more disk than the pages.  Open pages of split hosts, and split hosts with candidates, are parsed again.

Defined cases: null or empty html gives an empty text; unclosed, stray and cut-off tags are tolerated, in linear
time; repeated rows are rows of their own, but a page_id counts once among distinct pages, and rows without one are
one page; a null url is a host of its own; extra columns don't matter; an empty table gives no rows.
"""

from __future__ import annotations

import hashlib
import itertools
import re
from collections import Counter, defaultdict
from html.parser import HTMLParser
from typing import NamedTuple

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from starloom.llm.common import Memo, map_rows, written
from starloom.llm.near_duplicates import ODD, mix64

VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
#: Elements without text of their own, by whether they part the text about them.
DROPPED_BLOCKS = frozenset("head title nav header footer aside menu form fieldset dialog".split())
DROPPED_INLINE = frozenset("script style noscript template button select textarea option label iframe object svg canvas audio video".split())
DROPPED = DROPPED_BLOCKS | DROPPED_INLINE
BLOCKS = DROPPED_BLOCKS | frozenset(
    "address article blockquote body caption center dd details div dl dt figcaption figure h1 h2 h3 h4 h5 h6 html li main ol p pre section summary table tbody td tfoot th thead tr ul hr".split()
)
#: Start tags that close an open paragraph.
CLOSES_P = BLOCKS - frozenset("body html td th tr caption head title".split())
#: A class or id names furniture if one of its parts is such a word and all others are words for places and shapes.
FURNITURE = frozenset(
    "ad ads adsbygoogle advert adverts advertisement advertising adv banner sponsor sponsored promo promotion cookie cookies consent gdpr notice notices popup modal overlay newsletter subscribe subscription sidebar menu nav navbar navigation breadcrumb breadcrumbs footer header masthead comment comments disqus respond replies share sharing social related recommended recommendations widget widgets toolbar pagination pager skip teaser teasers".split()
)
SHAPES = frozenset(
    "a area article articles bar block body box bottom btn button buttons card cell column col container content form global group holder inner item items js label left link links list main message module outer page panel post posts primary reader readers region right row secondary section signup site slot sticky text thread title top unit ul user users li wrap wrapper zone".split()
)
ROLES = frozenset("navigation banner contentinfo complementary search menu menubar alert alertdialog dialog form".split())
SCOPED = frozenset("div section ul ol li p span table dl figure details center font td a".split())


#: Between the parts of a name: signs, digits, and where a capital follows a small letter.
NAME_PARTS = re.compile(r"[_\-\d]+|(?<=[a-z])(?=[A-Z])")
UNSEEN = re.compile(r"(?:display\s*:\s*none|visibility\s*:\s*hidden)", re.IGNORECASE)


def names_furniture(names: str) -> bool:
    for name in names.split():
        parts = [p.lower() for p in NAME_PARTS.split(name) if p]
        if any(p in FURNITURE for p in parts) and all(p in FURNITURE or p in SHAPES for p in parts):
            return True
    return False


class PageParser(HTMLParser):
    """Collects (in_article, text) blocks in page order."""

    #: What an implied end tag doesn't reach beyond.
    BARRIERS = {"p": frozenset("article main section div td th li body table button".split()), "li": frozenset(("ul", "ol", "menu"))}

    def __init__(self) -> None:
        super().__init__(convert_charrefs=True)
        self.stack: list[tuple[str, bool, bool]] = []  # tag, dropped, in article
        self.places: dict[str, list[int]] = defaultdict(list)  # of each open tag in the stack
        self.block_places: list[int] = []
        self.barrier_places: dict[str, list[int]] = {"p": [], "li": []}
        self.blocks: list[tuple[bool, str]] = []
        self.run: list[str] = []
        self.has_article = False

    def state(self) -> tuple[bool, bool]:
        return self.stack[-1][1:] if self.stack else (False, False)

    def flush(self) -> None:
        if self.run:
            text = " ".join("".join(self.run).split())
            if text:
                self.blocks.append((self.state()[1], text))
            self.run = []

    def push(self, tag: str, dropped: bool, inside: bool) -> None:
        at = len(self.stack)
        self.stack.append((tag, dropped, inside))
        self.places[tag].append(at)
        if tag in BLOCKS:
            self.block_places.append(at)
        for name, barriers in self.BARRIERS.items():
            if tag in barriers:
                self.barrier_places[name].append(at)

    def pop(self, tag: str, beyond: list[int]) -> None:
        """Close `tag` if it is open above the last place of `beyond`."""
        at = self.places[tag]
        if not at or (beyond and beyond[-1] > at[-1]):
            return
        cut = at[-1]
        # a block's end parts the text, unless it lies in something dropped
        if self.block_places and self.block_places[-1] >= cut and not (cut and self.stack[cut - 1][1]):
            self.flush()
        for name, _, _ in self.stack[cut:]:
            self.places[name].pop()
        del self.stack[cut:]
        for places in (self.block_places, *self.barrier_places.values()):
            while places and places[-1] >= cut:
                places.pop()

    def handle_starttag(self, tag: str, attrs: list[tuple[str, str | None]]) -> None:
        dropped, inside = self.state()
        if not dropped:
            if tag in CLOSES_P:
                self.pop("p", self.barrier_places["p"])
            if tag == "li":
                self.pop("li", self.barrier_places["li"])
            if tag in BLOCKS:
                self.flush()
            if tag == "br":
                self.handle_data(" ")
            dropped, inside = self.state()
        if tag in VOID:
            return
        if tag == "body":
            self.pop("head", [])  # a head left open ends here
            dropped, inside = self.state()[0], False
        a = {k: v or "" for k, v in attrs}
        role = a.get("role", "").lower()
        furniture = (tag in SCOPED or tag == "article") and names_furniture(f"{a.get('class', '')} {a.get('id', '')}")
        if (tag == "article" and furniture) or (UNSEEN.search(a["style"]) if a.get("style") else False):
            dropped = True  # a reader's comment or a teaser can be an article of its own
        elif tag in ("article", "main") or role in ("main", "article") or a.get("itemprop", "").lower() == "articlebody":
            inside = True
            self.has_article = self.has_article or not dropped
        elif tag in DROPPED or role in ROLES or "hidden" in a or a.get("aria-hidden") == "true":
            dropped = True
        elif furniture:
            dropped = True
        self.push(tag, dropped, inside)

    def handle_startendtag(self, tag: str, attrs) -> None:
        self.handle_starttag(tag, attrs)
        if tag not in VOID:
            self.handle_endtag(tag)

    def handle_endtag(self, tag: str) -> None:
        if tag not in VOID:  # an inline end tag doesn't reach past the block it stands in
            self.pop(tag, [] if tag in BLOCKS or tag in DROPPED else self.block_places)

    def handle_data(self, data: str) -> None:
        if not self.state()[0]:
            self.run.append(data)


def page_blocks(html: str | None) -> tuple[bool, list[str]]:
    """(marked, blocks): the article's blocks, or candidate blocks where no article is marked."""
    parser = PageParser()
    parser.feed(html or "")
    parser.close()
    parser.flush()
    if parser.has_article:
        return True, [t for inside, t in parser.blocks if inside]
    return False, [t for _, t in parser.blocks]


def depth_order(tokens: np.ndarray, depth: int) -> np.ndarray:
    """A suffix array by the first `depth` tokens or more: prefix doubling with numpy sorts."""
    n = len(tokens)
    rank = np.unique(tokens, return_inverse=True)[1].astype(np.int64) + 1
    step = 1
    while True:
        second = np.zeros(n, np.int64)
        second[: n - step] = rank[step:] if step < n else 0
        key = rank * (n + 2) + second
        order = np.argsort(key)
        new = np.empty(n, np.int64)
        new[order] = np.cumsum(np.append(True, np.diff(key[order]) != 0))
        if new.max() == n or 2 * step >= min(n, depth):
            return order
        rank, step = new, step * 2


def pages_sharing(tokens: np.ndarray, page: np.ndarray, length: int) -> np.ndarray:
    """For each place, how many distinct pages have the `length` tokens that start there; 0 where a separator comes first.

    `page` is -1 at separators, which have unique negative tokens.  Suffixes that agree in `length` tokens are
    neighbours in the array.
    """
    n = len(tokens)
    out = np.zeros(n, np.int64)
    if n < length:
        return out
    order = depth_order(tokens, length)
    agree = np.ones(n - 1, bool)
    a, b = order[:-1], order[1:]
    for k in range(length):
        ok = (a + k < n) & (b + k < n)
        agree &= ok & (tokens[np.minimum(a + k, n - 1)] == tokens[np.minimum(b + k, n - 1)])
    group = np.append(0, np.cumsum(~agree))
    pairs = np.unique(group * (int(page.max(initial=0)) + 2) + page[order] + 1)
    out[order] = np.bincount(pairs // (int(page.max(initial=0)) + 2), minlength=group[-1] + 1)[group]
    # a start is whole if no separator lies in its tokens
    ends = np.append(0, np.cumsum(page < 0))
    place = np.arange(n)
    whole = (place + length <= n) & (ends[np.minimum(place + length, n)] == ends[place])
    return np.where(whole, out, 0)


def shared_tokens(tokens: np.ndarray, page: np.ndarray, length: int) -> np.ndarray:
    """Which tokens lie in a substring of at least `length` tokens found on two distinct pages."""
    return covered_tokens(pages_sharing(tokens, page, length) > 1, len(tokens), length)


class WordHasher(Memo):
    """32-bit hashes of words."""

    def __init__(self) -> None:
        super().__init__(500_000)

    def __missing__(self, word: str) -> int:
        self.make_room(1)
        h = self[word] = int.from_bytes(hashlib.blake2b(word.encode("utf-8", "surrogatepass"), digest_size=4).digest(), "little", signed=True)
        return h

    def page(self, blocks: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """(words, ends) of all blocks."""
        split = [b.split() for b in blocks]
        ends = np.cumsum([len(x) for x in split], dtype=np.int32)
        n = int(ends[-1]) if split else 0
        return np.fromiter(map(self.__getitem__, itertools.chain.from_iterable(split)), np.int32, n), ends


def window_hashes(words: np.ndarray, length: int) -> np.ndarray:
    """64-bit hashes of a block's windows of `length` words, or of the whole block if it has fewer."""
    size = min(length, len(words))
    h, n = words.astype(np.int64), len(words) - size + 1
    return hash_columns([h[k : k + n] for k in range(size)])


def hash_columns(columns: list[np.ndarray]) -> np.ndarray:
    """One hash of the k-th entries of all columns, and of their number."""
    out = np.full(len(columns[0]), len(columns), np.uint64)  # a short block never equals a window
    for k, h in enumerate(columns):
        out = mix64(out * ODD + h.view(np.uint64) + np.uint64(k + 1))
    return out.view(np.int64)


def covered_tokens(hits: np.ndarray, size: int, length: int) -> np.ndarray:
    """Which of a block's `size` tokens lie in a window that is hit; windows have `length` tokens, or all of a shorter block."""
    ends = np.zeros(size + length + 1, np.int64)
    start = np.flatnonzero(hits)
    np.add.at(ends, start, 1)
    np.add.at(ends, start + min(length, size), -1)
    return np.cumsum(ends[:size]) > 0


def host_of(url: Column) -> Column:
    return F.lower(F.coalesce(F.regexp_extract(url, r"^[A-Za-z]+://([^/?#]*)", 1), F.lit("")))


class Page(NamedTuple):
    number: int  # equal for rows of one page
    marked: bool  # has an article
    words: np.ndarray
    ends: np.ndarray  # of its blocks

    def blocks(self) -> list[np.ndarray]:
        return np.split(self.words, self.ends[:-1]) if len(self.ends) else []


def counted_marks(hashes: np.ndarray, page: np.ndarray, least: float) -> np.ndarray:
    """The hashes on `least` distinct pages or more."""
    order = np.lexsort((page, hashes))
    h, p = hashes[order], page[order]
    once = h[np.append(True, (h[1:] != h[:-1]) | (p[1:] != p[:-1]))[: len(h)]]
    found, n = np.unique(once, return_counts=True)
    return found[n >= least]


def find_marks(pages: list[Page], length: int, least: float) -> np.ndarray:
    """Hashes of the windows and short blocks on `least` distinct pages or more.

    A window can't be on more pages than any of its words, so only stretches of frequent words go into the suffix array.
    """
    if not pages:
        return np.empty(0, np.int64)
    words = np.concatenate([p.words for p in pages])
    sizes = np.concatenate([np.diff(p.ends, prepend=0) for p in pages]).astype(np.int64)
    block_page = np.repeat([p.number for p in pages], [len(p.ends) for p in pages])
    starts = np.cumsum(sizes) - sizes
    found = []
    for size in range(1, length):
        at = np.flatnonzero(sizes == size)
        if at.size:
            found.append(counted_marks(hash_columns([words[starts[at] + k].astype(np.int64) for k in range(size)]), block_page[at], least))
    ids, n = np.unique(words, return_counts=True)
    ids = ids[n >= least]
    if ids.size:
        place = np.minimum(np.searchsorted(ids, words), ids.size - 1)
        ok = (ids[place] == words) & np.repeat(sizes >= length, sizes)
        parted = ~ok
        parted[starts[sizes > 0]] = True  # a find never reaches over the end of a block
        run = np.cumsum(parted)
        kept = np.flatnonzero(ok & (np.bincount(run[ok], minlength=len(words) + 1)[run] >= length))
        if kept.size:
            nth = np.unique(run[kept], return_inverse=True)[1]
            flat = -1 - np.arange(kept.size + nth[-1] + 1)  # separators, all different
            owner = np.full(flat.size, -1)
            at = np.arange(kept.size) + nth
            flat[at], owner[at] = place[kept], np.repeat(block_page, sizes)[kept]
            start = np.flatnonzero(pages_sharing(flat, owner, length) >= least)
            found.append(np.unique(hash_columns([ids[flat[start + k]].astype(np.int64) for k in range(length)])))
    return np.unique(np.concatenate(found)) if found else np.empty(0, np.int64)


def dropped_blocks(page: Page, marks: np.ndarray, length: int, share: float = 0.5) -> list[int]:
    """Numbers of the blocks that marked windows cover by `share` or more."""
    out = []
    for i, x in enumerate(page.blocks() if len(marks) else []):
        hits = np.isin(window_hashes(x, length), marks)
        if hits.any() and covered_tokens(hits, len(x), length).sum() >= share * len(x):
            out.append(i)
    return out


def token_streams(rows: DataFrame) -> DataFrame:
    """Rows (host, part, parts, host_pages, row_id, number, html) as streams: marked, words and ends for the html."""

    def make():
        hasher = WordHasher()

        def run(b: pa.RecordBatch) -> pa.RecordBatch:
            marked, words, ends = [], [], []
            for html in b.column(6).to_pylist():
                has_article, blocks = page_blocks(html)
                w, e = hasher.page(blocks)
                marked.append(has_article)
                words.append(w)
                ends.append(e)
            cols = [pa.array(marked, pa.bool_()), pa.array(words, pa.list_(pa.int32())), pa.array(ends, pa.list_(pa.int32()))]
            return pa.RecordBatch.from_arrays([*b.columns[:6], *cols], names=[*b.schema.names[:6], "marked", "words", "ends"])

        return run

    rows = rows.select("host", "part", "parts", "host_pages", "row_id", "number", "html")
    return map_rows(rows, make, "host string, part int, parts int, host_pages long, row_id long, number long, marked boolean, words array<int>, ends array<int>")


def pages_of(group: pd.DataFrame) -> list[Page]:
    numbers = pd.factorize(group["number"])[0]
    return [Page(int(n), bool(m), np.asarray(w, np.int32), np.asarray(e, np.int64)) for n, m, w, e in zip(numbers, group["marked"], group["words"], group["ends"])]


def windows_of(streams: DataFrame, length: int) -> DataFrame:
    """(host, part, number, mark) of all windows and short blocks; where a column `marks` isn't null, of those among them."""

    def make():
        def run(b: pa.RecordBatch) -> pa.RecordBatch:
            found = []
            for w, e, marks in zip(*(b.column(i).to_pylist() for i in (3, 4, 5))):
                blocks = Page(0, True, np.array(w, np.int32), np.array(e, np.int64)).blocks()
                here = np.unique(np.concatenate([window_hashes(x, length) for x in blocks])) if blocks else np.empty(0, np.int64)
                found.append(here if marks is None else np.intersect1d(here, np.array(marks, np.int64)))
            row = pa.array(np.repeat(np.arange(len(found)), [len(x) for x in found]), pa.int64())
            return pa.RecordBatch.from_arrays([*(b.column(i).take(row) for i in range(3)), pa.array(np.concatenate(found), pa.int64())], names=["host", "part", "number", "mark"])

        return run

    return map_rows(streams.select("host", "part", "number", "words", "ends", "marks"), make, "host string, part int, number long, mark long", 1 << 20)


def marks_across(streams: DataFrame, length: int) -> DataFrame:
    """(host, part, mark): windows and short blocks that two distinct open pages of a host have, for each part that has them."""
    open_windows = windows_of(streams.where("not marked").withColumn("marks", F.lit(None).cast("array<long>")), length)
    number = F.col("number")
    in_part = open_windows.groupBy("host", "mark", "part").agg(F.min(number).alias("low"), F.max(number).alias("high"))
    shared = in_part.groupBy("host", "mark").agg(F.collect_list("part").alias("parts"), (F.min("low") < F.max("high")).alias("two")).where("two")
    return shared.select("host", F.explode("parts").alias("part"), "mark")


def extract(
    pages: DataFrame,
    key: str = "page_id",
    url: str = "url",
    html: str = "html",
    length: int = 12,
    article_pages: int = 8,
    article_share: float = 0.6,
    group_bytes: int = 4 << 20,
) -> DataFrame:
    """(page_id, url, text) of every row."""
    rows = pages.select(F.col(key).cast("long").alias("page_id"), F.col(url).alias("url"), F.col(html).alias("html"))
    # equal rows are equal pages, and a page_id counts once
    rows = rows.withColumns({"row_id": F.xxhash64("page_id", "url", "html"), "number": F.xxhash64("page_id"), "host": host_of(F.col("url"))})
    per_page = rows.groupBy("host", "number").agg(F.sum(F.coalesce(F.length("html"), F.lit(0))).alias("size"))
    hosts = per_page.groupBy("host").agg(F.count(F.lit(1)).alias("host_pages"), F.ceil((F.sum("size") + 1) / group_bytes).cast("int").alias("parts"))
    hosts = written(hosts)  # a table of known size: Spark broadcasts it, or not, before it shuffles pages
    dealt = rows.join(hosts, "host").withColumn("part", F.pmod("number", F.col("parts")).cast("int"))

    def result(host: list, marks: list, rows: list, drops: list) -> pd.DataFrame:
        return pd.DataFrame({
            "host": pd.Series(host, dtype=object),
            "mark": pd.array(marks, dtype="Int64"),
            "row_id": pd.array(rows, dtype="Int64"),
            "drops": pd.Series(drops, dtype=object),
        })

    def decide(group: pd.DataFrame) -> pd.DataFrame:
        """Marks that are strong enough for articles, as far as this part can tell, and the open pages' dropped blocks; of a split host only their rows."""
        found = pages_of(group)
        here, alone = len({p.number for p in found}), group["parts"].iloc[0] == 1
        strong = find_marks(found, length, max(article_pages, article_share * here) if alone else article_share * here).tolist()
        opened = [(int(i), p) for i, p in zip(group["row_id"], found) if not p.marked]
        weak = find_marks([p for _, p in opened], length, 2) if alone else None
        drops = [(i, None if weak is None else dropped_blocks(p, weak, length)) for i, p in opened]
        drops = [x for x in drops if x[1] is None or x[1]]
        no_mark, no_row = [None] * len(drops), [None] * len(strong)
        return result([*[group["host"].iloc[0]] * len(strong), *no_mark], [*strong, *no_mark], [*no_row, *(i for i, _ in drops)], [*no_row, *(d for _, d in drops)])

    kinds = "host string, mark long, row_id long, drops array<int>"
    found = written(token_streams(dealt).groupBy("host", "part").applyInPandas(decide, kinds))
    # Open pages of split hosts: what their parts share is counted first.
    undecided = written(found.where("row_id is not null and drops is null").select("row_id").distinct())
    opened = dealt.join(undecided, "row_id", "left_semi")
    across = marks_across(token_streams(opened), length)

    def decide_open(group: pd.DataFrame, across: pd.DataFrame) -> pd.DataFrame:
        pages = pages_of(group)
        weak = np.union1d(across["mark"].to_numpy(np.int64), find_marks(pages, length, 2))
        drops = [(int(i), d) for i, p in zip(group["row_id"], pages) if (d := dropped_blocks(p, weak, length))]
        nothing = [None] * len(drops)
        return result(nothing, nothing, [i for i, _ in drops], [d for _, d in drops])

    later = token_streams(opened).groupBy("host", "part").cogroup(across.groupBy("host", "part")).applyInPandas(decide_open, kinds)
    local = found.where("mark is not null").select("host", "mark").distinct().join(hosts, "host")
    # The marks of a host are few, as each is on many of its pages: at most 1 / article_share times a page's windows on average.
    candidates = written(local.where("parts > 1").groupBy("host").agg(F.collect_set("mark").alias("marks")))
    again = windows_of(token_streams(dealt.join(candidates.select("host"), "host", "left_semi")).join(candidates, "host"), length)
    counted = again.select("host", "number", "mark").distinct().groupBy("host", "mark").agg(F.count(F.lit(1)).alias("n")).join(hosts, "host")
    counted = counted.where((F.col("n") >= article_pages) & (F.col("n") >= article_share * F.col("host_pages")))
    strong = local.where("parts = 1").select("host", "mark").unionByName(counted.select("host", "mark"))
    strong = written(strong.groupBy("host").agg(F.collect_set("mark").alias("marks")))
    drops = found.where("drops is not null").select("row_id", "drops").unionByName(later.select("row_id", "drops"))
    drops = written(drops.dropDuplicates(["row_id"]))
    kept = rows.join(strong, "host", "left").join(drops, "row_id", "left").select("page_id", "url", "html", "marks", "drops")

    def make():
        hasher = WordHasher()

        def one(page: str | None, marks: list[int] | None, drops: list[int] | None) -> str:
            marked, blocks = page_blocks(page)
            if marked and marks:
                drops = dropped_blocks(Page(0, True, *hasher.page(blocks)), np.array(marks, np.int64), length)
            gone = set(drops or ())
            return "\n".join(b for i, b in enumerate(blocks) if i not in gone)

        def run(b: pa.RecordBatch) -> pa.RecordBatch:
            text = [one(*x) for x in zip(*(b.column(i).to_pylist() for i in (2, 3, 4)))]
            return pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(text, pa.string())], names=["page_id", "url", "text"])

        return run

    return map_rows(kept, make, "page_id long, url string, text string")
