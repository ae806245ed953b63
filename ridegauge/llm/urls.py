"""Allow and block pages by rules and by a list of canonical URLs.

The list is held twice: as a blocked Bloom filter and as a table.  The filter is a table of blocks of
256 bits, one block and eight bits in it for a URL; it has at most ``most_blocks`` rows, so it may be
broadcast whatever the list's length.  A URL whose bits are not all set is not on the list.  What is
left, possible hits, is joined with the list itself on the whole canonical URL, which removes false
positives; a fuller filter passes more of them but changes no verdict.

The join runs once per distinct URL.  What it confirms goes back to the rows with ``salts`` copies of
each URL, so that the rows of one URL, however many, are spread over as many tasks.

Rules come before the list.  A rule is a host and the start of a path; it fits the host, all its
subdomains, and paths that begin with its own.  Of the rules that fit, the longest (host and path
together, then host) decides.

Null URLs and those without ``://`` have an empty host and path, no canonical form and no listing: no
rule fits them and they are allowed.  Very long URLs are compared whole.  Repeated rows each get their
row; null entries of the list are ignored; an empty list blocks nothing and an empty table gives an
empty one.  Only the id and the URL are read from the pages, so other columns may have any name.
"""

from collections.abc import Sequence
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ridegauge.session import written

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

# Parameters that say where a reader came from, not what the page shows.
TRACKING = r"^(utm_[a-z]*|ref|referrer|fbclid|gclid|msclkid|mc_cid|mc_eid)(=|$)"

_WORDS = 4  # 64-bit words of a block
_BITS_PER_URL = 16


class Rule(NamedTuple):
    host: str
    path: str
    verdict: str

    @property
    def name(self) -> str:
        return self.host + self.path


def _rest(url: Column) -> Column:
    """What follows the first ``://``; empty without one."""
    at = F.instr(url, "://")
    return F.when(at > 0, F.substr(url, at + 3)).otherwise("")


def host_of(url: Column) -> Column:
    whole = F.regexp_extract(_rest(url), "^[^/?#]*", 0)
    return F.translate(F.coalesce(whole, F.lit("")), _UPPER, _LOWER)


def path_of(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(_rest(url), "^[^/?#]*([^?#]*)", 1), F.lit(""))


def canonical(url: Column) -> Column:
    """One spelling for the addresses of a page; null if there is no host.

    Scheme, user, default port, ``www.``, a trailing dot or slash, an index page, the fragment and
    tracking parameters go; repeated slashes become one; the parameters left are sorted.
    """
    host = F.regexp_replace(host_of(url), r"^[^@]*@", "")
    host = F.regexp_replace(F.regexp_replace(host, r":(80|443)?$", ""), r"^www\.|\.$", "")
    path = F.regexp_replace(path_of(url), "/{2,}", "/")
    path = F.regexp_replace(F.regexp_replace(path, r"/index\.(html?|php)$", "/"), "/$", "")
    query = F.regexp_extract(_rest(url), r"^[^?#]*\?([^#]*)", 1)
    wanted = F.filter(F.split(query, "&"), lambda p: (p != "") & ~F.rlike(p, F.lit(TRACKING)))
    asked = F.array_join(F.array_sort(wanted), "&")
    return F.when(host != "", F.concat(host, path, F.when(asked != "", F.concat(F.lit("?"), asked)).otherwise("")))


def ruled(host: Column, path: Column, rules: Sequence[Rule]) -> Column:
    """``(rule, verdict)`` of the longest rule that fits, else null.  Rules are constants of the plan."""
    found = []
    for rule in sorted(rules, key=lambda r: (-len(r.name), -len(r.host), r)):
        own = (host == rule.host) | F.endswith(host, F.lit("." + rule.host))
        names = F.struct(F.lit(rule.name).alias("rule"), F.lit(rule.verdict).alias("verdict"))
        found.append(F.when(own & F.startswith(path, F.lit(rule.path)), names))
    return F.coalesce(*found) if found else F.lit(None).cast("struct<rule:string,verdict:string>")


def listing(pages: DataFrame, host_words: Sequence[str]) -> DataFrame:
    """The canonical URLs of pages on hosts whose name has one of ``host_words`` between dots or dashes."""
    named = rf"(^|[.-])({'|'.join(host_words)})([.-]|$)"
    return pages.filter(F.rlike(host_of(F.col("url")), F.lit(named))).select(canonical(F.col("url")).alias("url"))


def _block(url: str, blocks: int) -> Column:
    return F.pmod(F.xxhash64(url), F.lit(blocks)).alias("block")


def _masks(url: str) -> list[Column]:
    """The bits of a URL in each word of its block: eight, from six bits each of a second hash."""

    def bit(i: int) -> str:
        return f"shiftleft(1L, CAST(shiftrightunsigned(xxhash64({url}, 1L), {6 * i}) & 63 AS INT))"

    return [F.expr(f"{bit(2 * w)} | {bit(2 * w + 1)}") for w in range(_WORDS)]


def bloom_filter(listed: DataFrame, blocks: int) -> DataFrame:
    """``block, word0 .. word3`` of the blocks in which ``url`` of ``listed`` sets bits."""
    bits = listed.select(_block("url", blocks), *(m.alias(f"bits{w}") for w, m in enumerate(_masks("url"))))
    return bits.groupBy("block").agg(*(F.bit_or(f"bits{w}").alias(f"word{w}") for w in range(_WORDS)))


def with_possible(rows: DataFrame, url: str, bloom: DataFrame, blocks: int) -> DataFrame:
    """``rows`` with ``possible``: false where ``url`` is certainly not in the filter."""
    met = rows.withColumn("block", _block(url, blocks)).join(F.broadcast(bloom), "block", "left")
    hit = F.lit(True)
    for w, mask in enumerate(_masks(url)):
        hit = hit & (F.col(f"word{w}").bitwiseAND(mask) == mask)
    possible = F.coalesce(F.col(url).isNotNull() & hit, F.lit(False))
    return met.select(*rows.columns, possible.alias("possible"))


def blocks_for(urls: int, most_blocks: int) -> int:
    """Blocks that give each URL about 16 bits, as a power of two up to ``most_blocks``."""
    wanted = 1
    while wanted < most_blocks and wanted * 64 * _WORDS < urls * _BITS_PER_URL:
        wanted *= 2
    return wanted


def judged(
    pages: DataFrame,
    listed: DataFrame,
    rules: Sequence[Rule] = (),
    most_blocks: int = 1 << 18,
    salts: int = 16,
) -> DataFrame:
    """``page_id, host, path, rule, verdict, canonical_url, possible, listed`` of each page.

    ``listed`` holds canonical URLs in ``url``.  A page on the list is blocked, any other allowed,
    unless a rule says otherwise.
    """
    entries = written(listed.select("url").filter("url IS NOT NULL").distinct(), "listed-urls")
    blocks = blocks_for(entries.count(), most_blocks)
    bloom = bloom_filter(entries, blocks)

    url = F.col("url").cast("string")
    host, path = host_of(url), path_of(url)
    rows = pages.select(
        F.col("page_id"), host.alias("host"), path.alias("path"), canonical(url).alias("canonical_url"),
        ruled(host, path, rules).alias("ruled"),
    )
    probed = written(with_possible(rows, "canonical_url", bloom, blocks), "probed-urls")

    hits = probed.filter("possible")
    met = hits.select(F.col("canonical_url").alias("url")).distinct()
    confirmed = met.join(entries.hint("shuffle_hash"), "url", "left_semi")
    spread = confirmed.select(
        F.col("url").alias("canonical_url"), F.explode(F.sequence(F.lit(0), F.lit(salts - 1))).alias("salt"),
        F.lit(True).alias("listed"),
    )
    dealt = hits.withColumn("salt", F.pmod(F.monotonically_increasing_id(), F.lit(salts)).cast("int"))
    checked = dealt.join(spread, ["canonical_url", "salt"], "left").drop("salt")
    clear = probed.filter("NOT possible").withColumn("listed", F.lit(None).cast("boolean"))
    found = F.coalesce("listed", F.lit(False))
    return checked.unionByName(clear).select(
        "page_id", "host", "path", F.col("ruled.rule").alias("rule"),
        F.coalesce("ruled.verdict", F.when(found, "block").otherwise("allow")).alias("verdict"),
        "canonical_url", "possible", found.alias("listed"),
    )
