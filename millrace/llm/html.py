"""Main text of web pages: markup where it speaks, else the runs that pages of a host repeat."""

from __future__ import annotations

import re
from collections.abc import Collection, Iterator
from html.parser import HTMLParser
from itertools import groupby

import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.llm.common import ROW, columns, with_row
from millrace.session import pin

# Tokens from which a substring repeated across pages of a host counts as boilerplate.
MIN_RUN = 8
# Distinct pages of a host from which a repeated run of whole blocks is no article's, and how
# many it takes where such runs make up most of a page, which may also be a copy of others.
BLOCK_PAGES = 3
COPIED_PAGES = 10

# Elements without text of their own, or whose text is never an article's.
SKIPPED = frozenset(
    "script style noscript template svg iframe object canvas nav footer aside form button select textarea menu dialog "
    "title head".split()
)
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
BLOCKS = frozenset(
    "address article aside blockquote body br caption dd details div dl dt fieldset figcaption figure footer form h1 h2 "
    "h3 h4 h5 h6 header hr li main nav ol p pre section summary table tbody td tfoot th thead tr ul".split()
)
# Words in class, id or role that mark what is no article.
MARKS = frozenset(
    "ad ads advert advertisement adverts alert banner breadcrumb breadcrumbs comment comments complementary consent "
    "contentinfo cookie cookies disqus gdpr login menu modal nav navbar navigation newsletter notice popup promo promoted "
    "recommended related replies reply search share sharing sidebar signup social sponsor sponsored subscribe "
    "widget".split()
)
# Words before or after a mark that make it a state of the page.
STATES = frozenset("with without has no".split())
STATES_AFTER = frozenset("open closed".split())
# Words of one block from which a form holds running text.
LONG_TEXT = 30
_WORD = re.compile(r"[a-z0-9]+")

PAGE = (
    "page_id long, url string, host string, {row} long, article boolean, blocks array<string>, "
    "grams array<long>, stream long, runs array<long>, body long"
).format(row=ROW)


def _marked(values: list[str]) -> bool:
    """Whether a name in class, id or role marks what is no article; 'has-sidebar' or 'comments-open' say how a page is."""
    for name in " ".join(values).split():
        words = ["", *_WORD.findall(name), ""]
        for before, word, after in zip(words, words[1:], words[2:]):
            if word in MARKS and before not in STATES and after not in STATES_AFTER:
                return True
    return False


class _Blocks(HTMLParser):
    """Blocks of text in page order, each with whether it stands in an article and what skips it."""

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.open: list[tuple[str, int, bool, bool]] = []  # tag, number of the skip or 0, article or main, article
        self.depth: dict[str, int] = {}
        self.articles = self.posts = 0
        self.kinds = [""]  # of each skip: tag, form or mark
        self.outer = [0]  # the skip around each skip, 0 for none
        self.skip = 0  # the innermost open skip
        self.free = False  # an article stands in no skip
        self.hidden: list[int] = []  # the innermost skip around every other article
        self.out: list[tuple[str, bool, int]] = []
        self.parts: list[str] = []

    def close_block(self) -> None:
        text = " ".join("".join(self.parts).split())
        if text:
            self.out.append((text, self.articles > 0, self.skip))
        self.parts = []

    def handle_starttag(self, tag, attrs):
        if tag in BLOCKS or tag in SKIPPED:
            self.close_block()
        if tag in VOID:
            return
        if tag == "body":  # ends a head that was left open
            self.handle_endtag("head")
        named = {name: value.lower() for name, value in attrs if value and name in ("class", "id", "role")}
        post = tag == "article" or named.get("role") == "article"
        article = post or tag == "main" or named.get("role") == "main"
        kind = ""
        if tag in ("body", "html"):
            pass
        elif tag in SKIPPED:
            kind = "form" if tag == "form" else "tag"
        elif tag == "header" and not self.articles:
            kind = "tag"
        # Marks say nothing of an article, but articles within one are its comments, adverts and the like.
        elif named and not (article and not self.posts) and _marked(list(named.values())):
            kind = "mark"
        if article and not kind:
            self.free |= not self.skip
            if self.skip:
                self.hidden.append(self.skip)
        skip = 0
        if kind:
            skip = len(self.kinds)
            self.kinds.append(kind)
            self.outer.append(self.skip)
            self.skip = skip
        self.open.append((tag, skip, article, post))
        self.depth[tag] = self.depth.get(tag, 0) + 1
        self.articles += article
        self.posts += post

    def handle_endtag(self, tag):
        if tag in BLOCKS or tag in SKIPPED:
            self.close_block()
        if not self.depth.get(tag):
            return
        while True:
            name, skip, article, post = self.open.pop()
            self.depth[name] -= 1
            if skip:
                self.skip = self.outer[skip]
            self.articles -= article
            self.posts -= post
            if name == tag:
                return

    def handle_data(self, data):
        self.parts.append(data)

    def handle_startendtag(self, tag, attrs):
        self.handle_starttag(tag, attrs)
        if tag not in VOID:
            self.handle_endtag(tag)

    def parse_html_declaration(self, i):
        # Whatever stands in a declaration, it ends at the next bracket.
        end = self.rawdata.find(">", i + 2)
        return end + 1 if end >= 0 else -1

    def shown(self) -> list[bool]:
        """Of every skip whether it and all around it do not hold: forms around an article or long text, marks around the only articles."""
        n = len(self.kinds)
        forms, untagged = [True] * n, [True] * n  # of a skip and all around it
        for s in range(1, n):  # what is around a skip has a smaller number
            forms[s] = self.kinds[s] == "form" and forms[self.outer[s]]
            untagged[s] = self.kinds[s] != "tag" and untagged[self.outer[s]]
        around = [False] * n
        for s in self.hidden:
            around[s] = True
        for text, _, s in self.out:
            if s and forms[s] and len(text.split()) >= LONG_TEXT:
                around[s] = True
        for s in range(n - 1, 0, -1):
            if around[s]:
                around[self.outer[s]] = True
        lifted = [around[s] and self.kinds[s] == "form" for s in range(n)]
        if not self.free and not any(map(self._open(lifted).__getitem__, self.hidden)):
            only = [False] * n
            for s in self.hidden:
                only[s] = untagged[s]
            for s in range(n - 1, 0, -1):
                if only[s]:
                    only[self.outer[s]] = lifted[s] = True
        return self._open(lifted)

    def _open(self, lifted: list[bool]) -> list[bool]:
        out = [True] * len(lifted)
        for s in range(1, len(lifted)):
            out[s] = lifted[s] and out[self.outer[s]]
        return out


_OPENING = re.compile(r"<!--|<(script|style)\b", re.IGNORECASE)
_MARKUP = re.compile(r"</?[a-zA-Z]|<[!?]")
_COMMENT_END = re.compile(r"--!?>")
_RAW_END = {tag: re.compile(rf"</{tag}\b", re.IGNORECASE) for tag in ("script", "style")}


def without_comments(html: str) -> str:
    """The page without comments; one that does not end reaches to the end of the page, as does an open script or style.

    Each place is looked at once, however many comments stay open.
    """
    kept, at, look = [], 0, 0
    while found := _OPENING.search(html, look):
        start = found.start()
        before = html.rfind("<", at, start)
        if before >= 0 and html[before + 1:before + 2].isalpha() and html.find(">", before, start) < 0:
            look = found.end()  # inside a tag, as part of a value
            continue
        tag = found[1]
        if tag:
            end = _RAW_END[tag.lower()].search(html, found.end())
            if not end:
                return "".join([*kept, html[at:start]])
            look = end.end()
            continue
        kept.append(html[at:start])
        end = _COMMENT_END.search(html, start + 2)
        if not end:
            return "".join(kept)
        at = look = end.end()
    end = _MARKUP.search(html, max(at, html.rfind(">") + 1))
    if end:  # a tag or declaration that does not end
        return "".join([*kept, html[at:end.start()]])
    return "".join([*kept, html[at:]]) if kept else html


def blocks_of(html: str) -> list[tuple[str, bool, bool]]:
    """Blocks in page order, each with whether it stands in an article and whether it is skipped."""
    parser = _Blocks()
    parser.feed(without_comments(html))
    parser.close()
    parser.close_block()
    shown = parser.shown()
    return [(text, inside, not shown[skip]) for text, inside, skip in parser.out]


def host_of(url: str | None) -> str:
    found = re.match(r"^(?:[a-z][a-z0-9+.-]*:)?(?://)?(?:[^/@?#]*@)?([^/:?#]+)", (url or "").lower())
    return found[1] if found else ""


def suffixes(tokens: list[str], length: int) -> list[int]:
    """A key for the first ``length`` tokens of every suffix that has so many."""
    raw = [t.encode() for t in tokens]
    return [
        xxhash.xxh64_intdigest(b" ".join(raw[i:i + length])) - (1 << 63) for i in range(len(raw) - length + 1)
    ]


def block_runs(blocks: list[str], length: int) -> list[tuple[int, int, int]]:
    """First block, end and key of the shortest runs of whole blocks of ``length`` tokens that begin or end at a block.

    Of a longer run that pages share, every block lies in one of these.
    """
    sizes = [block.count(" ") + 1 for block in blocks]
    found, end, held = set(), 0, 0
    for first in range(len(blocks)):
        while end < len(blocks) and held < length:
            held += sizes[end]
            end += 1
        if held < length:
            break
        found.add((first, end))
        held -= sizes[first]
    first, held = len(blocks), 0
    for end in range(len(blocks), 0, -1):
        while first > 0 and held < length:
            first -= 1
            held += sizes[first]
        if held < length:
            break
        found.add((first, end))
        held -= sizes[end - 1]
    return [(a, b, xxhash.xxh64_intdigest("\n".join(blocks[a:b]).encode()) - (1 << 63)) for a, b in sorted(found)]


def repeated_blocks(blocks: list[str], common: set[int], frequent: set[int], length: int) -> set[int]:
    """The places of the blocks that a run of whole blocks repeated over the host covers."""
    sizes = [block.count(" ") + 1 for block in blocks]
    runs = block_runs(blocks, length)
    for gone in (common, frequent):
        covered = {i for a, b, key in runs if key in gone for i in range(a, b)}
        if 2 * sum(sizes[i] for i in covered) <= sum(sizes):
            break
    return covered


def extract_text(
    pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html", min_run: int = MIN_RUN,
) -> DataFrame:
    """Main text of every page from its whole html.

    Markup and the host decide together. Where the page marks an article (``article``,
    ``main``), its blocks are the candidates, except for elements in it that are marked as
    menus, adverts, notices, forms, comments and the like; elsewhere all blocks that are not
    skipped. On every page a run of whole candidate blocks of at least ``min_run`` tokens goes
    when BLOCK_PAGES pages of the host with different texts hold it and either no other host
    does or at least half of the host's pages do: unmarked share lines, related lists, a
    sidebar in main. Where such runs make up more than half of a page, it may
    be a version of other pages, and only those on COPIED_PAGES pages go. On pages without an
    article, runs go by tokens besides: the token streams of the host's blocks outside
    articles form one suffix array, kept as a table, each suffix cut to ``min_run`` tokens;
    equal suffixes of pages with different streams show a repeated substring, and all
    tokens that such substrings cover are removed.
    Suffixes are counted by key before they meet, so neither a large host nor a frequent
    run lands in one task. NULL html gives the empty text, a NULL url the host of no name;
    repeated rows give a row each; further columns are ignored; an empty table gives no
    rows. Returns page_id, url, text.
    """

    def parse(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            out = []
            for page, url, row, html in batch.itertuples(index=False, name=None):
                blocks = blocks_of(html) if html else []
                article = any(inside and not skipped for _, inside, skipped in blocks)
                kept = [text for text, inside, skipped in blocks if not skipped and inside == article]
                tokens = [t for text, inside, _ in blocks if not inside for t in text.split()]
                grams = sorted(set(suffixes(tokens, min_run)))
                stream = xxhash.xxh64_intdigest(" ".join(tokens).encode()) - (1 << 63)
                runs = sorted({key for _, _, key in block_runs(kept, min_run)})
                body = xxhash.xxh64_intdigest("\n".join(kept).encode()) - (1 << 63)
                out.append((page, url, host_of(url), row, article, kept, grams, stream, runs, body))
            done = pd.DataFrame(out, columns=[c.split()[0] for c in PAGE.split(", ")])
            done["page_id"] = done["page_id"].astype("Int64")
            yield done

    rows = with_row(columns(pages, page_id=id_col, url=url_col, html=html_col)).select("page_id", "url", ROW, "html")
    parsed = pin(rows.withColumn("page_id", F.col("page_id").cast("long")).mapInPandas(parse, PAGE))
    grams = parsed.select("host", "stream", F.explode("grams").alias("gram"))
    repeated = (
        grams.groupBy("host", "gram").agg(F.min("stream").alias("a"), F.max("stream").alias("b"))
        .where("a < b").select("host", "gram")
    )
    open_pages = parsed.where(~F.col("article"))
    covered = pin(
        open_pages.select(ROW, "host", F.explode("grams").alias("gram"))
        .join(repeated, ["host", "gram"], "left_semi")
        .groupBy(ROW).agg(F.collect_set("gram").alias("covered"))
    )

    # Pages of one text count once, so that copies are no evidence.
    texts = parsed.groupBy("host", "body").agg(F.min(ROW).alias(ROW)).select(ROW)
    per_host = (
        parsed.select(ROW, "host", F.explode("runs").alias("run")).join(texts, ROW, "left_semi")
        .groupBy("host", "run").agg(F.count("*").alias("pages"))
    )
    # What other hosts write too is language rather than a template, unless most pages of this host hold it.
    hosts = per_host.groupBy("run").agg(F.count("*").alias("hosts"))
    sizes = parsed.join(texts, ROW, "left_semi").groupBy("host").agg(F.count("*").alias("of"))
    pages_of_run = (
        per_host.where(F.col("pages") >= BLOCK_PAGES).join(hosts, "run").join(sizes, "host")
        .where("hosts = 1 OR 2 * pages >= of").select("host", "run", "pages")
    )
    shared = pin(
        parsed.select(ROW, "host", F.explode("runs").alias("run")).join(pages_of_run, ["host", "run"])
        .groupBy(ROW).agg(
            F.collect_set("run").alias("common"),
            F.collect_set(F.when(F.col("pages") >= COPIED_PAGES, F.col("run"))).alias("frequent"),
        )
    )

    def join(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            texts = []
            for blocks, covered, common, frequent in zip(*[batch[c] for c in ("blocks", "covered", "common", "frequent")]):
                blocks = list(blocks)
                whole = repeated_blocks(blocks, set(common), set(frequent), min_run) if common is not None else set()
                texts.append(unique_runs(blocks, covered, min_run, whole))
            yield pd.DataFrame({"page_id": batch["page_id"].astype("Int64"), "url": batch["url"], "text": texts})

    found = parsed.select("page_id", "url", "blocks", ROW).join(covered, ROW, "left").join(shared, ROW, "left").drop(ROW)
    return found.mapInPandas(join, "page_id long, url string, text string")


def unique_runs(blocks, covered, length: int, whole: Collection[int] = ()) -> str:
    """The blocks without those in ``whole`` and what repeated runs cover: whole blocks, or at least ``length`` tokens of one.

    A run that ends a few tokens into the next block leaves those where they are.
    """
    split = [block.split() for block in blocks]
    tokens = [t for block in split for t in block]
    if covered is None or not len(covered):
        return " ".join(block for i, block in enumerate(blocks) if i not in whole)
    gone, until, hidden = set(covered), 0, []
    keys = suffixes(tokens, length)
    for i in range(len(tokens)):
        if i < len(keys) and keys[i] in gone:
            until = i + length
        hidden.append(i < until)
    kept, at = [], 0
    for i, block in enumerate(split):
        for is_hidden, run in groupby(range(at, at + len(block)), key=hidden.__getitem__):
            places = list(run)
            if i not in whole and (not is_hidden or len(places) < min(length, len(block))):
                kept += tokens[places[0]:places[-1] + 1]
        at += len(block)
    return " ".join(kept)
