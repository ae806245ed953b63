"""Main text of web pages: block structure, then suffix ranks over each host.

A page is cut into blocks.  Blocks inside scripts, navigation, headers, footers, forms, adverts,
notices, comments and the like are dropped.  What is left of all pages of a host, marked as article
(``<article>``, ``<main>``, ``role="main"``) or not, is searched for boilerplate by repetition.

A run of at least ``LENGTH`` tokens of one block that ``SHARE`` of the host's distinct pages have, and
no fewer than ``LEAST``, is boilerplate and goes; inside a marked article it takes ``MARKED_SHARE``.
Such a run is a maximal repeat or part of one with the same places, so the tokens that maximal
repeats cover are those that prefixes of ``LENGTH`` tokens cover if as many pages have them; longer
ranks would not change them.  Suffixes end at the border of their block.

Near copies of a page count once.  A page's *sketch* is, for each of ``SKETCHES`` hash functions, the
least hash of its shingles.  The pages that have a run count as the distinct sketches of what these
pages hold besides the run's block (of the page, if that is all it holds), by the function that gives
fewest; the pages of a host as the distinct sketches of its pages, by the function that gives most.
Copies whose shingles differ in part count in that proportion.

The pages of a host are dealt to parts of about ``PART`` characters.  A task ranks the suffixes of its
part by prefix doubling and names the prefixes that are as frequent there as boilerplate has to be in one
part at least.  Where that is a single page, which is so on hosts of long pages or of near copies, a part
says nothing, and prefixes are counted over the host one by one instead.  The places of the named prefixes in all pages of
the host are then counted.  So a host with a third of all pages is never in one place, and only named
prefixes are sent on.

Null or empty pages have an empty text.  Hosts are taken from ``url``; pages without a url form a
host of their own.  Repeated rows each come out.
"""

import html as entities
import re
import zlib
from collections import Counter

import numpy as np
import pandas as pd
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ridegauge.llm.common import whole
from ridegauge.session import written

LENGTH = 8
LEAST = 3
SHARE, MARKED_SHARE = 0.2, 0.5
SKETCHES = 4
PART = 1_000_000
_SHINGLE = 4

# How HTML elements are treated.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title noscript iframe xmp template svg math select button object".split())
DROPPED = frozenset("head nav header footer aside form dialog menu fieldset label".split())
CONTAINERS = frozenset(
    "html body div section article main nav header footer aside form dialog menu fieldset ul ol dl table "
    "thead tbody tfoot tr td th blockquote figure details head center".split()
)
BLOCKS = CONTAINERS | frozenset(
    "p h1 h2 h3 h4 h5 h6 li dt dd pre hr address caption figcaption summary option legend".split()
)
BOILERPLATE = frozenset(
    "ad ads advert adverts advertisement advertising sponsor sponsored promo promotion banner sidebar "
    "menu nav navbar navigation breadcrumb breadcrumbs footer header masthead cookie cookies consent gdpr "
    "notice notices notification alert popup modal overlay newsletter subscribe signup login share sharing "
    "social related recommended comment comments disqus reply replies respond form search toolbar "
    "pagination pager skip".split()
)
ROLES = frozenset("navigation banner contentinfo complementary search dialog alertdialog alert form menu menubar".split())
_NEVER_BY_CLASS = frozenset("html body article main h1 h2 h3 h4 h5 h6".split())
# Class and id names that, as a whole, tell that an article in there is not the page's.
FIRM = frozenset(
    "nav navbar navigation menu footer comment comments comment-list comments-area comments-list comment-body "
    "disqus disqus_thread reply replies respond".split()
)

_TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*+>"
    r"|<(/?)([a-zA-Z][^\s/>]*+)((?:[^>\"']++|\"[^\"]*+\"|'[^']*+')*+|[^>]*+)>",
    re.S,
)
_ATTRIBUTE = re.compile(r"""([a-zA-Z][\w:-]*)\s*(?:=\s*("[^"]*"|'[^']*'|[^\s"'>]+))?""")
_NAME = re.compile(r"[a-z0-9]+")


def _attributes(raw: str) -> dict[str, str]:
    return {name.lower(): value.strip("\"'") for name, value in _ATTRIBUTE.findall(raw)}


def _is_boilerplate(tag: str, attributes: dict[str, str]) -> tuple[bool, bool]:
    """Whether an element goes with all it holds, and whether only a word in its class or id says so."""
    if tag in DROPPED:
        return True, False
    if not attributes or tag in _NEVER_BY_CLASS:
        return False, False
    if attributes.get("role", "").lower() in ROLES or "hidden" in attributes:
        return True, False
    if attributes.get("aria-hidden", "").lower() == "true" or re.search(
        r"display\s*:\s*none", attributes.get("style", ""), re.I
    ):
        return True, False
    names = f"{attributes.get('class', '')} {attributes.get('id', '')}".lower()
    if not FIRM.isdisjoint(names.split()):
        return True, False
    return False, not BOILERPLATE.isdisjoint(_NAME.findall(names))


def _kept(found: list[tuple[str, tuple[int, ...], int]]) -> list[tuple[str, int]]:
    """Blocks that no class word drops, with their articles.

    A class word does not drop an element that holds the page's article (the marked one with most
    text) or, on a page without a mark, most of the text.
    """
    held: Counter = Counter()
    articles: Counter = Counter()
    for text, chain, article in found:
        if article:
            articles[article] += len(text)
        for element in chain:
            held[element] += len(text)
    if articles:
        own = max(articles, key=lambda a: (articles[a], -a))
        void = {element for _, chain, article in found if article == own for element in chain if element < own}
    else:
        void = {element for element, n in held.items() if 2 * n > sum(len(text) for text, _, _ in found)}
    return [(text, article) for text, chain, article in found if void.issuperset(chain)]


def marked_blocks(page: str) -> list[tuple[str, bool]]:
    """The blocks of a page that may be text, and whether each is in a marked article."""
    found: list[tuple[str, tuple[int, ...], int]] = []  # text, elements with class words, article
    now = []
    stack: list[tuple[str, bool, tuple[int, ...], int]] = []  # element, dropped, and as in found
    dropped, chain, marked = False, (), 0
    at, end, elements = 0, len(page), 0

    def flush() -> None:
        if now:
            text = " ".join(entities.unescape("".join(now)).split())
            now.clear()
            if text:
                found.append((text, chain, marked))

    while at < end:
        token = _TOKEN.search(page, at)
        if not dropped:
            now.append(page[at : token.start() if token else end])
        if token is None:
            break
        at = token.end()
        if token[0].startswith("<![CDATA[") and not dropped:
            now.append(entities.escape(token[0][9:].removesuffix("]]>")))
        if token[2] is None:
            continue
        tag = token[2].lower()
        if token[1]:  # an end tag
            if tag in BLOCKS:
                flush()
            for depth in range(len(stack) - 1, -1, -1):
                if stack[depth][0] == tag:
                    outer = stack[depth - 1][1:] if depth else (False, (), 0)
                    if outer[1:] != (chain, marked):
                        flush()
                    del stack[depth:]
                    dropped, chain, marked = outer
                    break
            continue
        if tag in RAW and not token[3].endswith("/"):
            if tag not in VOID:
                close = re.compile(rf"</{re.escape(tag)}\b[^>]*>", re.I).search(page, at)
                at = close.end() if close else end
            continue
        if tag in BLOCKS:
            flush()
            if stack and stack[-1][0] == "p":  # a block ends an open paragraph
                stack.pop()
                dropped, chain, marked = stack[-1][1:] if stack else (False, (), 0)
        elif tag == "br":
            now.append(" ") if not dropped else None
        if tag in VOID or token[3].endswith("/") and tag not in BLOCKS:
            continue
        attributes = _attributes(token[3]) if token[3].strip() else {}
        firm, named = _is_boilerplate(tag, attributes)
        named = named and not dropped
        drop = dropped or firm
        if tag in CONTAINERS or named or drop and not dropped:
            elements += 1
            article = marked
            if not article and (tag in ("article", "main") or attributes.get("role", "").lower() == "main"):
                article = elements
            if named or drop and not dropped:
                flush()
            stack.append((tag, drop, (*chain, elements) if named else chain, article))
            dropped, chain, marked = stack[-1][1:]
    flush()
    return [(text, article > 0) for text, article in _kept(found)]


def blocks(page: str) -> tuple[list[str], bool]:
    """The blocks of a page that may be text, and whether any is in a marked article."""
    found = marked_blocks(page)
    return [text for text, _ in found], any(marked for _, marked in found)


# --- repetition over a host -----------------------------------------------------------------


def suffix_ranks(tokens: np.ndarray, length: int) -> np.ndarray:
    """Ranks of all suffixes by their first ``length`` tokens (a power of two), by prefix doubling.

    Equal ranks mean equal prefixes; a suffix cut short by the end differs from all longer ones.
    """
    ranks = np.unique(tokens, return_inverse=True)[1].astype(np.int64) + 1
    step = 1
    while step < length:
        after = np.zeros_like(ranks)
        after[:-step] = ranks[step:]
        ranks = np.unique(ranks * (int(ranks.max()) + 1) + after, return_inverse=True)[1].astype(np.int64) + 1
        step *= 2
    return ranks


def _tokens(page_blocks: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of a page's tokens, and the block of each."""
    words = [block.split() for block in page_blocks]
    hashes = [xxhash.xxh3_64_intdigest(word) for block in words for word in block]
    return np.array(hashes, np.uint64), np.repeat(np.arange(len(words)), [len(block) for block in words])


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _grams(tokens: np.ndarray, block: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray]:
    """Where ``length`` tokens of one block start, and their hashes."""
    many = max(0, len(tokens) - length + 1)
    found = np.zeros(many, np.uint64)
    for step in range(length):
        found = found * np.uint64(0x9E3779B97F4A7C15) + tokens[step : step + many]
    places = np.flatnonzero(block[:many] == block[length - 1 :]) if many else np.empty(0, np.int64)
    return places, _mixed(found[places]).view(np.int64)


def sketches(tokens: np.ndarray, block: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The sketch of a page, and for each block that of the rest of the page.

    A block shorter than a shingle is one shingle.
    """
    places, shingles = _grams(tokens, block, _SHINGLE)
    where = block[places]
    starts, sizes = np.unique(block, return_index=True, return_counts=True)[1:]
    short = [
        (b, xxhash.xxh3_64_intdigest(tokens[start : start + size].tobytes()))
        for b, (start, size) in enumerate(zip(starts.tolist(), sizes.tolist())) if size < _SHINGLE
    ]
    where = np.concatenate([where, np.array([b for b, _ in short], np.int64)])
    shingles = np.concatenate([shingles.view(np.uint64), np.array([h for _, h in short], np.uint64)])
    page = np.zeros(SKETCHES, np.int64)
    rest = np.zeros((len(starts), SKETCHES), np.int64)
    if len(starts):
        for j in range(SKETCHES):
            hashes = _mixed(shingles ^ np.uint64(0x9E3779B97F4A7C15 * (j + 1) % 2**64))
            first = int(hashes.argmin())
            others = hashes[where != where[first]]
            page[j] = hashes[first : first + 1].view(np.int64)[0]
            rest[:, j] = page[j]
            if len(others):
                rest[where[first], j] = others[others.argmin() :][:1].view(np.int64)[0]
    return page, rest


def named_prefixes(pages: list[list[str]], least: float) -> np.ndarray:
    """Hashes of the prefixes that at least so many of these pages have, near copies counted once."""
    found = [_tokens(page) for page in pages]
    # a border after each block, unlike all tokens and other borders
    line, keys, starts, size = [], [], [], 0
    for tokens, block in found:
        _, rest = sketches(tokens, block)
        ends = np.flatnonzero(np.diff(block, append=-1))
        line.append(np.insert(tokens, ends + 1, np.uint64(0)))
        starts.append(size + np.arange(len(tokens)) + block)
        keys.append(rest[block])
        size += len(tokens) + len(ends)
    line, starts, keys = np.concatenate(line), np.concatenate(starts), np.concatenate(keys)
    if not len(starts):
        return np.empty(0, np.int64)
    ids = np.unique(line, return_inverse=True)[1].astype(np.int64)
    border = np.ones(len(line), bool)
    border[starts] = False
    ids[border] = len(line) + np.arange(border.sum())
    whole_prefix = starts[np.convolve(border, np.ones(LENGTH, int))[LENGTH - 1 :][starts] == 0]
    whole_prefix = whole_prefix[whole_prefix + LENGTH <= len(line)]
    if not len(whole_prefix):
        return np.empty(0, np.int64)
    at_start = np.zeros(len(line), np.int64)
    at_start[starts] = np.arange(len(starts))
    ranks = suffix_ranks(ids, LENGTH)[whole_prefix]
    counted = np.full(int(ranks.max()) + 1, len(line))
    often = np.bincount(ranks)[ranks] >= least
    ranks, whole_prefix = ranks[often], whole_prefix[often]
    for j in range(SKETCHES):
        key = np.unique(keys[at_start[whole_prefix], j], return_inverse=True)[1]
        pairs = np.unique(ranks * (len(line) + 1) + key)
        counted = np.minimum(counted, np.bincount(pairs // (len(line) + 1), minlength=len(counted)))
    one = np.unique(ranks, return_index=True)
    chosen = whole_prefix[one[1][counted[one[0]] >= least]]
    hashes = np.zeros(len(chosen), np.uint64)
    for step in range(LENGTH):
        hashes = hashes * np.uint64(0x9E3779B97F4A7C15) + line[chosen + step]
    return _mixed(hashes).view(np.int64)


def _packed(page_blocks: list[str]) -> bytes:
    """The blocks of a page in few bytes, as they are written and exchanged."""
    return zlib.compress("\n".join(page_blocks).encode()) if page_blocks else b""


def _unpacked(packed: bytes) -> list[str]:
    return zlib.decompress(packed).decode().split("\n") if packed else []


def _named(rows: pd.DataFrame) -> pd.DataFrame:
    found = named_prefixes([_unpacked(b) for b in rows["blocks"]], rows["least"].iloc[0])
    return pd.DataFrame({"host": rows["host"].iloc[0], "prefix": found})


def _prefixes(batches):
    """``host, prefix, sketch``: every prefix of each page, with what else the page holds."""
    for rows in batches:
        for host, page_blocks in zip(rows["host"], rows["blocks"]):
            tokens, block = _tokens(_unpacked(page_blocks))
            places, hashes = _grams(tokens, block, LENGTH)
            if len(places):
                rest = sketches(tokens, block)[1][:, 0]
                yield pd.DataFrame({"host": host, "prefix": hashes, "sketch": rest[block[places]]}).drop_duplicates()


def _places(batches):
    """``host, prefix, j, sketch``: the named prefixes of each page, with what else the page holds."""
    for rows in batches:
        out = []
        for host, page_blocks, named in zip(rows["host"], rows["blocks"], rows["named"]):
            tokens, block = _tokens(_unpacked(page_blocks))
            places, hashes = _grams(tokens, block, LENGTH)
            here = np.isin(hashes, np.asarray(named, np.int64))
            if here.any():
                _, rest = sketches(tokens, block)
                found = set(zip(hashes[here].tolist(), block[places[here]].tolist()))
                out += [(host, prefix, j, int(rest[b, j])) for prefix, b in found for j in range(SKETCHES)]
        yield pd.DataFrame(out, columns=["host", "prefix", "j", "sketch"])


def unique_runs(page_blocks: list[str], marks: list[bool], anywhere: np.ndarray, unmarked: np.ndarray) -> list[str]:
    """Blocks without the tokens that boilerplate covers: of all blocks, and of blocks without a mark."""
    tokens, block = _tokens(page_blocks)
    places, hashes = _grams(tokens, block, LENGTH)
    if not len(places):
        return page_blocks
    free = ~np.asarray(marks, bool)[block[places]]
    covered = np.zeros(len(tokens) + 1, np.int64)
    starts = places[np.isin(hashes, anywhere) | free & np.isin(hashes, unmarked)]
    np.add.at(covered, starts, 1)
    np.add.at(covered, starts + LENGTH, -1)
    gone = np.cumsum(covered) > 0
    if not gone.any():
        return page_blocks
    left, at = [], 0
    for text in page_blocks:
        kept = [word for i, word in enumerate(text.split(), at) if not gone[i]]
        at += len(text.split())
        if kept:
            left.append(" ".join(kept))
    return left


def extracted(pages: DataFrame) -> DataFrame:
    """``page_id, url, text, n_chars`` of each page."""

    def cut(batches):
        row = TaskContext.get().partitionId() << 33
        for rows in batches:
            for at in range(0, len(rows), 256):
                part = rows.iloc[at : at + 256]
                found = [marked_blocks(page) for page in part["html"]]
                texts = [[text for text, _ in page] for page in found]
                yield pd.DataFrame({
                    "row": range(row, row + len(part)), "page_id": part["page_id"].array, "url": part["url"].array, "host": part["host"].array,
                    "blocks": [_packed(page) for page in texts], "marks": [[marked for _, marked in page] for page in found],
                    "size": [sum(map(len, page)) for page in texts],
                    "sketch": [sketches(*_tokens(page))[0].tolist() for page in texts],
                })
                row += len(part)

    host = F.coalesce(F.lower(F.regexp_extract("url", r"^[a-zA-Z][\w+.-]*://(?:[^/@]*@)?([^/:?#]*)", 1)), F.lit(""))
    parsed = written(
        pages.select(F.col("page_id").cast("long"), "url", whole("html").alias("html"), host.alias("host")).mapInPandas(
            cut, "row long, page_id long, url string, host string, blocks binary, marks array<boolean>, "
            "size long, sketch array<long>"
        ), "pages",
    )
    distinct = (
        parsed.select("host", F.posexplode("sketch").alias("j", "sketch")).distinct()
        .groupBy("host", "j").count().groupBy(F.col("host").alias("of")).agg(F.max("count").alias("distinct"))
    )
    hosts = written(
        parsed.groupBy("host").agg(F.count("*").alias("pages"), F.sum("size").alias("size"))
        .join(distinct, F.col("host") == F.col("of")).filter(F.col("pages") >= LEAST)
        .select(
            F.col("host").alias("at"), "pages", F.ceil(F.col("size") / PART).cast("int").alias("parts"),
            F.greatest(F.lit(LEAST), SHARE * F.col("distinct")).alias("need"),
            F.greatest(F.lit(LEAST), MARKED_SHARE * F.col("distinct")).alias("need_marked"),
        ), "hosts",
    )
    rows = (
        parsed.select("row", "host", "blocks").join(hosts, F.col("host") == F.col("at"))
        .withColumn("least", F.col("need") / F.greatest("parts", F.lit(1)))
    )
    ranked = (
        rows.filter("least > 1").withColumn("part", F.pmod(F.xxhash64("row"), F.greatest("parts", F.lit(1))))
        .select("host", "part", "blocks", "least").groupBy("host", "part").applyInPandas(_named, "host string, prefix long")
    )
    # so many parts that a single page may be all that a part has of boilerplate: prefixes are counted one by one
    one_by_one = (
        rows.filter("least <= 1").select("host", "blocks").mapInPandas(_prefixes, "host string, prefix long, sketch long")
        .distinct().groupBy("host", "prefix").count()
        .join(hosts.select("at", "need"), F.col("host") == F.col("at")).filter("count >= need").select("host", "prefix")
    )
    named = ranked.unionByName(one_by_one)
    of_host = written(named.groupBy(F.col("host").alias("at")).agg(F.collect_set("prefix").alias("named")), "named")
    counted = (
        parsed.select("host", "blocks").join(of_host, F.col("host") == F.col("at")).select("host", "blocks", "named")
        .mapInPandas(_places, "host string, prefix long, j int, sketch long").distinct()
        .groupBy("host", "prefix", "j").count().groupBy("host", "prefix").agg(F.min("count").alias("n"))
    )
    # written, so that its size is known before the join: texts are exchanged only if it is not small
    boilerplate = written(
        counted.join(hosts, F.col("host") == F.col("at")).filter("n >= need").groupBy("at").agg(
            F.collect_list(F.when(F.col("n") >= F.col("need_marked"), F.col("prefix"))).alias("anywhere"),
            F.collect_list("prefix").alias("unmarked"),
        ), "boilerplate",
    )

    def keep(batches):
        for rows in batches:
            text = [
                "\n\n".join(_unpacked(b) if a is None else unique_runs(_unpacked(b), m, np.asarray(a, np.int64), np.asarray(u, np.int64)))
                for b, m, a, u in zip(rows["blocks"], rows["marks"], rows["anywhere"], rows["unmarked"])
            ]
            yield pd.DataFrame({"page_id": rows["page_id"], "url": rows["url"], "text": text})

    texts = (
        parsed.join(boilerplate, F.col("host") == F.col("at"), "left")
        .select("page_id", "url", "blocks", "marks", "anywhere", "unmarked")
        .mapInPandas(keep, "page_id long, url string, text string")
    )
    return texts.withColumn("n_chars", F.char_length("text").cast("long"))
