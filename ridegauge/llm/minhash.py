"""Near-duplicate groups by MinHash, banding, signature checks and full checks.

1. Each document becomes its set of word shingles (64-bit hashes), and that the minima of many
   universal hash functions, once, in the tasks that read the text.
2. Documents with the same set are one node, named by their smallest ``doc_id``; a group of copies
   of any size is one aggregation.
3. Bands of minima are bucket keys.  Buckets of one node are dropped.
4. Links are found in rounds.  A round compares the nodes of a bucket with few *pivots* of it, so a
   bucket makes at most ``PIVOTS`` times as many pairs as it has nodes, and pairs within a component
   found so far are never made, nor pairs whose profiles rule the similarity out: a profile counts
   a set's shingles that some other candidate has, by ranges of their hashes, and two sets share at
   most the smaller count of each range.  The first two rounds keep one pivot per node, the most similar by
   signature; by then large groups have become components.  After that every node outside the
   largest component of its bucket is a pivot once, in lanes of about ``PIVOTS``, until no bucket
   holds an untested pair of two components.
5. A pair whose signatures agree is confirmed on the two full shingle sets.
6. Components come from alternating large-star and small-star steps on the confirmed links.

With 42 bands of 6 minima a pair at a similarity of exactly 0.8 shares no bucket with a probability
of 3e-6, and a pair of 0.85 with 2e-9.  The signature check lets pass what is within 5.5 standard
deviations of the threshold.

Definitions: a document with fewer words than a shingle has its whole word sequence as its one
shingle; without words it has an empty set and is linked with nothing.  Null texts count as empty.
Rows with equal ``doc_id`` are one document.  A row without ``doc_id`` is linked with nothing: its
``component_id`` is null and it is kept.  Other columns pass through wherever a whole table goes in
and out (``without_near_copies``).
"""

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ridegauge.llm.common import in_batches, whole
from ridegauge.session import written

BANDS, ROWS = 42, 6
SIGNATURE = 768
PIVOTS = 64
RANGES = 32
_MARGIN = 5.5


class _WordHashes(dict):
    """Stable 64-bit hashes of words, remembered."""

    def __missing__(self, word: bytes) -> int:
        if len(self) > 300_000:
            self.clear()
        self[word] = found = xxhash.xxh3_64_intdigest(word)
        return found


_word_hashes = _WordHashes()


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(33))) * np.uint64(0xFF51AFD7ED558CCD)
    x = (x ^ (x >> np.uint64(33))) * np.uint64(0xC4CEB9FE1A85EC53)
    return x ^ (x >> np.uint64(33))


def shingle_set(text: str, words: int) -> np.ndarray:
    """The sorted distinct shingle hashes of a text, lower-cased in A-Z."""
    tokens = text.encode().lower().split()
    if not tokens:
        return np.empty(0, np.uint64)
    hashes = np.fromiter(map(_word_hashes.__getitem__, tokens), np.uint64, len(tokens))
    width = min(words, len(tokens))
    n = len(tokens) - width + 1
    total = np.full(n, width, np.uint64)
    for i in range(width):
        total = total * np.uint64(0x9E3779B97F4A7C15) + hashes[i : i + n]
    return np.unique(_mixed(total))


def _hash_functions(count: int) -> tuple[np.ndarray, np.ndarray]:
    """Multipliers and addends of ``count`` universal hash functions on 32 bits."""
    draw = np.random.default_rng(20240229)
    return (
        draw.integers(0, 2**31, count, np.uint32) * np.uint32(2) + np.uint32(1),
        draw.integers(0, 2**32, count, np.uint32),
    )


def minima(shingles: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    x = (shingles >> np.uint64(32)).astype(np.uint32)
    found = np.full(len(a), 2**32 - 1, np.uint32)
    for at in range(0, len(x), 1024):
        part = x[at : at + 1024]
        for low in range(0, len(a), 32):  # a block of products that stays in the cache
            product = a[low : low + 32, None] * part
            product += b[low : low + 32, None]
            np.minimum(found[low : low + 32], product.min(axis=1), out=found[low : low + 32])
    return found


def sketches(docs: DataFrame, words: int) -> DataFrame:
    """``doc_id, n_shingles, fingerprint, bands`` of each row; ``fingerprint`` hashes the whole set."""
    a, b = _hash_functions(BANDS * ROWS)
    band_numbers = np.arange(BANDS, dtype=np.uint64)

    def sketch(doc_ids, texts):
        sizes, marks, bands = [], [], []
        for text in texts.to_pylist():
            shingles = shingle_set(text, words)
            sizes.append(len(shingles))
            if not len(shingles):
                marks.append(None), bands.append(None)
                continue
            least = minima(shingles, a, b)
            marks.append(xxhash.xxh3_128_digest(shingles.tobytes()))
            key = band_numbers
            for row in least.reshape(BANDS, ROWS).T:
                key = _mixed(key * np.uint64(0x9E3779B97F4A7C15) + row.astype(np.uint64))
            bands.append(key.astype(np.int64))
        return pa.RecordBatch.from_arrays(
            [doc_ids, pa.array(sizes, pa.int64()), pa.array(marks, pa.binary()),
             pa.array(bands, pa.list_(pa.int64()))],
            names=["doc_id", "n_shingles", "fingerprint", "bands"],
        )

    return in_batches(
        docs, sketch,
        "doc_id long, n_shingles long, fingerprint binary, bands array<long>",
        F.col("doc_id").cast("long"), whole("text"),
    )


def _components(links: DataFrame) -> DataFrame:
    """``node, component`` for the ends of ``links`` (``u, v``): the smallest node reachable.

    Alternates large-star and small-star until nothing changes.  Each star's smallest neighbour is
    an aggregate and the re-linking a join on it, so a star with very many ends is split like any
    skewed join; the links of a round are written before the next.
    """
    edges = written(
        links.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
        .filter("u <> v").distinct(), "links",
    )
    before = None
    while True:
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy(F.col("u").alias("centre")).agg(F.min("v").alias("least"))
        least = least.select("centre", F.least("least", "centre").alias("least"))
        large = (
            both.filter("v > u").join(least, F.col("u") == F.col("centre"))
            .select(F.col("v").alias("u"), F.col("least").alias("v")).distinct()
        )
        # small star: of the larger end's neighbours, all of which are smaller now
        lowest = large.groupBy(F.col("u").alias("centre")).agg(F.min("v").alias("least"))
        joined = large.join(lowest, F.col("u") == F.col("centre"))
        small = (
            joined.select(F.explode(F.array(
                F.struct(F.col("v").alias("u"), F.col("least").alias("v")),
                F.struct(F.col("centre").alias("u"), F.col("least").alias("v")),
            )).alias("e")).select("e.*").filter("u <> v").distinct()
        )
        edges = written(small, "links")
        mark = edges.agg(
            F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))
        ).first()
        if mark == before:
            return edges.select(F.col("u").alias("node"), F.col("v").alias("component"))
        before = mark


def _labelled(buckets: DataFrame, components: DataFrame | None) -> DataFrame:
    """Bucket members with their component; a node without links is its own."""
    if components is None:
        return buckets.withColumn("label", F.col("node"))
    named = components.select(F.col("node").alias("named"), "component")
    return (
        buckets.join(named, buckets["node"] == named["named"], "left")
        .select("key", "node", "n", "own", "profile", F.coalesce("component", "node").alias("label"))
    )


def _open_buckets(members: DataFrame) -> DataFrame:
    """Buckets that hold several components: ``at`` (key), the largest one there, nodes of others."""
    per_label = members.groupBy("key", "label").agg(F.count("*").alias("many"))
    return (
        per_label.groupBy(F.col("key").alias("at"))
        .agg(
            F.sum("many").alias("members"), F.max(F.struct("many", "label")).alias("largest"),
            F.count("*").alias("labels"),
        )
        .filter("labels > 1")
        .select("at", F.col("largest.label").alias("largest"),
                (F.col("members") - F.col("largest.many")).alias("others"))
    )


def _possible(percent: int) -> Column:
    """Whether a node and a pivot can be similar enough at all, by their sizes and profiles."""
    def enough(shared: Column) -> Column:  # shared >= percent of (n + pivot_n - shared)
        return F.lit(100 + percent).cast("long") * shared >= F.lit(percent).cast("long") * (F.col("n") + F.col("pivot_n"))

    by_range = (F.least(F.col("profile")[i], F.col("pivot_profile")[i]) for i in range(RANGES))
    # the shorter condition first; both stay small enough for Java to compile
    at_most = F.least(F.col("n") - F.col("own"), F.col("pivot_n") - F.col("pivot_own"))
    return enough(at_most) & enough(sum(by_range, F.lit(0)))


def _met(members: DataFrame, pivots: DataFrame, percent: int) -> DataFrame:
    """Members with the pivots of their bucket that are of another component: ``u`` and pivot ``v``."""
    return (
        members.join(
            pivots, (F.col("key") == F.col("at")) & (F.col("label") != F.col("pivot_label")) & _possible(percent)
        ).select(F.col("node").alias("u"), F.col("pivot").alias("v")).distinct()
    )


def _star_pairs(members: DataFrame, salt: int, percent: int) -> DataFrame:
    """Each member with its bucket's pivot: first the one with the least shingles of its own."""
    order = F.col("own") if salt == 0 else F.xxhash64("node", F.lit(salt))
    pivots = (
        members.groupBy(F.col("key").alias("at"))
        .agg(F.min(F.struct(order.alias("order"), "node", "label", "n", "own", "profile")).alias("p"), F.count("*").alias("many"))
        .filter("many > 1")
        .selectExpr("at", "p.node AS pivot", "p.label AS pivot_label", "p.n AS pivot_n", "p.own AS pivot_own", "p.profile AS pivot_profile")
    )
    return _met(members, pivots, percent)


def _lane_pairs(members: DataFrame, still: DataFrame, lane: int, percent: int) -> DataFrame:
    """Each member with the pivots of this lane in its bucket."""
    lanes = F.ceil(F.col("others") / PIVOTS)
    pivots = (
        members.join(still.filter(lanes > lane), F.col("key") == F.col("at"))
        .filter((F.col("label") != F.col("largest")) & (F.pmod(F.xxhash64("node"), lanes) == lane))
        .selectExpr("at", "node AS pivot", "label AS pivot_label", "n AS pivot_n", "own AS pivot_own", "profile AS pivot_profile")
    )
    return _met(members, pivots, percent).select(
        F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")
    ).distinct()


def _alike(pairs: DataFrame, nodes: DataFrame, similarity: float) -> DataFrame:
    """Pairs whose signatures do not rule the similarity out: ``u, v, agreement``."""
    count = SIGNATURE
    least = similarity - _MARGIN * (similarity * (1 - similarity) / count) ** 0.5

    def agreeing(u, v, first, second):
        x = np.frombuffer(b"".join(first.to_pylist()), np.uint8).reshape(-1, count)
        y = np.frombuffer(b"".join(second.to_pylist()), np.uint8).reshape(-1, count)
        agreement = (x == y).mean(axis=1)
        return pa.RecordBatch.from_arrays(
            [u, v, pa.array(agreement, pa.float64())], names=["u", "v", "agreement"]
        ).filter(pa.array(agreement >= least))

    left = nodes.select(F.col("node").alias("u"), F.col("signature").alias("su"))
    right = nodes.select(F.col("node").alias("v"), F.col("signature").alias("sv"))
    both = pairs.join(left, "u").join(right, "v")
    return in_batches(
        both, agreeing, "u long, v long, agreement double",
        F.col("u"), F.col("v"), F.col("su"), F.col("sv"),
    )


def _signatures(sets: DataFrame) -> DataFrame:
    """``node, signature``: one byte of each of many minima, other ones than the bands'."""
    a, b = (x[BANDS * ROWS :] for x in _hash_functions(BANDS * ROWS + SIGNATURE))

    def sign(nodes, shingles):
        found = [
            _mixed(minima(np.asarray(s, np.int64).view(np.uint64), a, b).astype(np.uint64)).astype(np.uint8).tobytes()
            for s in (one.values.to_numpy() for one in shingles)
        ]
        return pa.RecordBatch.from_arrays([nodes, pa.array(found, pa.binary())], names=["node", "signature"])

    return in_batches(sets, sign, "node long, signature binary", F.col("node"), F.col("shingles"))


def _confirmed(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Pairs that share at least ``percent`` of their joint shingles."""
    left = sets.select(F.col("node").alias("u"), F.col("shingles").alias("xu"))
    right = sets.select(F.col("node").alias("v"), F.col("shingles").alias("xv"))
    return (
        pairs.join(left, "u").join(right, "v")
        .withColumn("shared", F.size(F.array_intersect("xu", "xv")))
        .filter(100 * F.col("shared") >= percent * (F.size("xu") + F.size("xv") - F.col("shared")))
        .select("u", "v")
    )


def _by_range(shingles: np.ndarray) -> np.ndarray:
    return np.bincount(shingles & (RANGES - 1), minlength=RANGES).astype(np.int32)


def _sets(docs: DataFrame, wanted: DataFrame, words: int) -> DataFrame:
    """``node, shingles, n, ranges, mark``: sets, sizes, shingles in each hash range, the set's hash."""

    def shingles(doc_ids, texts):
        found = [shingle_set(text, words).astype(np.int64) for text in texts.to_pylist()]
        return pa.RecordBatch.from_arrays(
            [doc_ids, pa.array(found, pa.list_(pa.int64())), pa.array(map(len, found), pa.int32()),
             pa.array(map(_by_range, found), pa.list_(pa.int32())),
             pa.array((xxhash.xxh3_64_intdigest(one.tobytes()) >> 1 for one in found), pa.int64())],
            names=["node", "shingles", "n", "ranges", "mark"],
        )

    chosen = docs.join(wanted.withColumnRenamed("node", "doc_id"), "doc_id", "left_semi")
    return in_batches(
        chosen, shingles, "node long, shingles array<long>, n int, ranges array<int>, mark long",
        F.col("doc_id").cast("long"), whole("text"),
    )


def _sized(sets: DataFrame, percent: int) -> DataFrame:
    """``node, n, own, profile``, without the hopeless.

    ``own`` counts the shingles no other set here has, ``profile`` the others by hash range.  A node
    of which more shingles are its own than similarity allows is linked with nothing, whatever it is
    compared with.  That settles most nodes that look alike without being alike enough.
    """
    alone = (
        sets.select("mark", F.explode("shingles").alias("shingle")).groupBy("shingle")
        .agg(F.count("*").alias("sets"), F.min("mark").alias("of")).filter("sets = 1")
        .groupBy("of").agg(F.collect_list(F.col("shingle").bitwiseAND(RANGES - 1).cast("tinyint")).alias("alone"))
    )

    def profiled(nodes, n, ranges, alone):
        found = [
            np.asarray(all_of, np.int32) - _by_range(np.asarray(own or [], np.int64))
            for all_of, own in zip(ranges.to_pylist(), alone.to_pylist())
        ]
        own = [size - int(shared.sum()) for size, shared in zip(n.to_pylist(), found)]
        return pa.RecordBatch.from_arrays(
            [nodes, n, pa.array(own, pa.int32()), pa.array(found, pa.list_(pa.int32()))],
            names=["node", "n", "own", "profile"],
        )

    joined = sets.select("node", "n", "ranges", "mark").join(alone, F.col("mark") == F.col("of"), "left")
    return written(
        in_batches(
            joined, profiled, "node long, n int, own int, profile array<int>", F.col("node"), F.col("n"),
            F.col("ranges"), F.col("alone"),
        ).filter(100 * (F.col("n") - F.col("own")) >= percent * F.col("n")), "sizes",
    )


def near_copies(docs: DataFrame, words: int = 5, similarity: float = 0.8) -> DataFrame:
    """``doc_id, n_shingles, component_id, kept`` of each row of ``docs``."""
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    sketched = written(sketches(docs, words), "sketches")
    known = sketched.filter("doc_id IS NOT NULL AND n_shingles > 0")
    same = written(
        known.groupBy("fingerprint").agg(F.min("doc_id").alias("node")), "fingerprints"
    )
    # a repeated doc_id with several sets is one node; any of its rows stands for it here, the
    # others are linked to it by their doc_id below
    nodes = written(
        known.join(same.withColumnRenamed("fingerprint", "own"),
                   (F.col("fingerprint") == F.col("own")) & (F.col("doc_id") == F.col("node")))
        .select("node", "fingerprint", "bands").dropDuplicates(["node", "fingerprint"]), "nodes",
    )
    banded = nodes.select("node", F.explode("bands").alias("key"))
    shared = (
        banded.groupBy(F.col("key").alias("at")).agg(F.min("node").alias("a"), F.max("node").alias("b"))
        .filter("a < b").select("at")
    )
    buckets = written(
        banded.join(shared, F.col("key") == F.col("at"), "left_semi").select("key", "node"), "buckets"
    )
    members = buckets.select("node").distinct()
    sets = written(_sets(docs, members, words), "sets")
    percent = round(100 * similarity)
    sized = _sized(sets, percent)
    near = written(_signatures(sets.join(sized.select("node").distinct(), "node", "left_semi")), "signatures")
    buckets = written(buckets.join(sized, "node").select("key", "node", "n", "own", "profile"), "buckets")

    components, links = None, []

    def linked(pairs: DataFrame) -> bool:
        nonlocal components
        found = written(_confirmed(pairs, sets, percent), "links")
        if found.isEmpty():
            return False
        links.append(found)
        joined = found
        if components is not None:  # the components so far are links themselves
            joined = found.unionByName(components.select(F.col("node").alias("u"), F.col("component").alias("v")))
        components = _components(joined)
        return True

    labelled = _labelled(buckets, None)
    for salt in (0, 1):
        alike = _alike(_star_pairs(labelled, salt, percent), near, similarity)
        best = alike.groupBy("u").agg(F.max_by("v", F.struct("agreement", "v")).alias("v"))
        if linked(best):
            labelled = _labelled(buckets, components)
    still = written(_open_buckets(labelled), "open")
    most = still.agg(F.max(F.ceil(F.col("others") / PIVOTS))).first()[0] or 0
    for lane in range(most):
        if linked(_alike(_lane_pairs(labelled, still, lane, percent), near, similarity)):
            labelled = _labelled(buckets, components)

    # copies follow their node; equal doc_ids hold their sets together
    copies = known.join(same, "fingerprint").select(F.col("doc_id").alias("u"), F.col("node").alias("v"))
    own = copies.groupBy("u").agg(F.min("v").alias("v"), F.max("v").alias("w"))
    twice = own.filter("v <> w")
    if not twice.isEmpty():
        more = copies.join(twice.select(F.col("u").alias("t")), F.col("u") == F.col("t"), "left_semi")
        found = more if components is None else more.unionByName(
            components.select(F.col("node").alias("u"), F.col("component").alias("v"))
        )
        components = _components(found)
    placed = own.select(F.col("u").alias("id"), F.col("v").alias("node"))
    if components is not None:
        placed = placed.join(components, "node", "left").select("id", F.coalesce("component", "node").alias("node"))
    return (
        sketched.select("doc_id", "n_shingles")
        .join(placed, F.col("doc_id") == F.col("id"), "left")
        .select("doc_id", "n_shingles", F.coalesce("node", "doc_id").alias("component_id"))
        .withColumn("kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True)))
    )


def without_near_copies(docs: DataFrame, words: int = 5, similarity: float = 0.8) -> DataFrame:
    """One document of each group of near copies, with all its columns.

    Of rows with the same ``doc_id`` one stays.  Rows without ``doc_id`` stay.
    """
    gone = near_copies(docs, words, similarity).filter("NOT kept").select("doc_id").distinct()
    left = docs.join(gone, "doc_id", "left_anti").select(*docs.columns)
    return (
        left.filter("doc_id IS NOT NULL").dropDuplicates(["doc_id"])
        .unionByName(left.filter("doc_id IS NULL"))
    )
