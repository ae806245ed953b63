"""Exact top-k inner products: norm-sorted blocks, rotated partial sums, Cauchy-Schwarz bounds.

Components are the integers floor(64 * x), so that scores are exact.  The second-moment matrix of
all vectors (a sum per task, d * d numbers in all) gives the rotation that puts most of the length
into the first coordinates.  Vectors are sorted by length, longest first, and packed into blocks;
so are queries.  The longest blocks seed each query's k-th score.  After that a pair of blocks is
formed only if its two largest lengths can beat the lowest seed of the query block, and inside a pair
only rows survive whose partial product plus the product of residual lengths can reach the query's
score so far.  Survivors get the exact integer product.

Blocks of vectors are dealt, by the order of their length, to at most ``SLOTS`` slots, and query blocks to
groups; a slot and a group make one task, so tasks are even and no length class is a hot key.  A task
takes a query block through all blocks of its slot and keeps the query's k best between them, so what
it has found narrows what follows, and it gives k rows per query however many blocks there are.  A last
ranking merges the slots.

A vector that is null, or holds a null or non-finite component, takes no part, nor does one without
``vec_id``.  Vectors of different lengths count as filled up with zeros.  Repeated rows (same id and
vector) count once; the same id with other vectors counts as several rows, none a candidate for
another.  An empty table gives an empty result.
"""

import numpy as np
import pandas as pd
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ridegauge.session import written

BLOCK = 2048
QUERY_BLOCK = 128
SLOTS = 64
_PER_SLOT = 6  # blocks of vectors, or of queries, that are worth a task of their own
_SAFE = 2.0**52
_PAIR = ("number", "slot", "q_ids", "q_xs", "least", "ids", "xs")


def whole_components(vectors: DataFrame, column: str = "embedding") -> DataFrame:
    """``vec_id, x``: each usable vector's floor(64 * component), once."""
    good = (
        F.col("vec_id").isNotNull() & F.col(column).isNotNull()
        & F.forall(column, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < float("inf")))
    )
    x = F.transform(column, lambda c: F.floor(F.lit(64.0) * c.cast("double")).cast("long"))
    return vectors.filter(good).select(F.col("vec_id").cast("long").alias("vec_id"), x.alias("x")).distinct()


def _matrix(rows: pd.Series, width: int) -> np.ndarray:
    if all(len(r) == width for r in rows):
        return np.array(rows.tolist(), np.int64).reshape(-1, width)
    found = np.zeros((len(rows), width), np.int64)
    for i, r in enumerate(rows):
        found[i, : len(r)] = r
    return found


def rotation(vectors: DataFrame, width: int) -> np.ndarray:
    """Right singular vectors of all vectors, from the sum of their outer products."""
    def moments(batches):
        total = np.zeros((width, width))
        for rows in batches:
            x = _matrix(rows["x"], width).astype(float)
            total += x.T @ x
        yield pd.DataFrame({"i": np.arange(width), "m": list(total)})

    rows = (
        vectors.select("x").mapInPandas(moments, "i int, m array<double>")
        .select("i", F.posexplode("m").alias("j", "v")).groupBy("i", "j").agg(F.sum("v").alias("v")).collect()
    )
    matrix = np.zeros((width, width))
    for row in rows:
        matrix[row["i"], row["j"]] = row["v"]
    return np.linalg.eigh(matrix)[1][:, ::-1].copy()


def _packed(vectors: DataFrame, width: int, size: int) -> DataFrame:
    """Blocks of ``size`` vectors, longest first: ``longest``, and the ids and vectors in bytes.

    ``turn`` numbers the blocks of a task one after the other, each task from its own number on.
    """
    def pack(batches):
        ids, rows, turn = [], [], TaskContext.get().partitionId()
        for batch in batches:
            ids += batch["vec_id"].tolist()
            rows.append(_matrix(batch["x"], width))
            if len(ids) >= 4 * size:
                x = np.concatenate(rows)
                cut = len(ids) // size * size
                yield blocks(ids[:cut], x[:cut], turn)
                ids, rows, turn = ids[cut:], [x[cut:]], turn + cut // size
        if ids:
            yield blocks(ids, np.concatenate(rows), turn)

    def blocks(ids, x, turn):
        norms = np.sqrt((x.astype(float) ** 2).sum(axis=1))
        found = []
        for at in range(0, len(ids), size):
            part = slice(at, at + size)
            found.append((
                float(norms[part].max()), len(ids[part]),
                np.array(ids[part], np.int64).tobytes(), x[part].tobytes(), turn + at // size,
            ))
        return pd.DataFrame(found, columns=["longest", "rows", "ids", "xs", "turn"])

    squared = F.aggregate("x", F.lit(0.0), lambda a, c: a + c.cast("double") * c)
    ordered = vectors.withColumn("squared", squared)
    sorted_rows = ordered.repartitionByRange(F.desc("squared"), F.col("vec_id")).sortWithinPartitions(
        F.desc("squared"), "vec_id"
    )
    return sorted_rows.select("vec_id", "x").mapInPandas(pack, "longest double, rows int, ids binary, xs binary, turn int")


def _products(q: np.ndarray, c: np.ndarray) -> np.ndarray:
    """Exact integer products; by floating point where that is exact."""
    most = float(np.abs(q).max(initial=0)) * float(np.abs(c).max(initial=0)) * q.shape[1]
    if most < _SAFE:
        return (q.astype(float) @ c.T.astype(float)).astype(np.int64)
    return q @ c.T


class _Best:
    """The k best of each query of a block, over all blocks of vectors that it has met."""

    def __init__(self, queries, qx, least, k, turn, head):
        self.queries, self.qx, self.least, self.k, self.turn, self.head = queries, qx, least.copy(), k, turn, head
        self.turned = qx.astype(float) @ turn
        self.lengths = np.sqrt((self.turned**2).sum(axis=1))
        self.rest = np.sqrt(np.maximum((self.turned[:, head:] ** 2).sum(axis=1), 0))
        none = np.empty(0, np.int64)
        self.ids, self.scores = [none] * len(queries), [none] * len(queries)

    def meet(self, ids: np.ndarray, cx: np.ndarray) -> None:
        lengths = np.sqrt((cx.astype(float) ** 2).sum(axis=1))
        slack = 1e-9 * (1 + np.outer(self.lengths, lengths))
        hopeful = (np.outer(self.lengths, lengths) + slack >= self.least[:, None]).any(axis=1)
        if not hopeful.any():
            return
        rotated = cx.astype(float) @ self.turn
        rest = np.sqrt(np.maximum((rotated[:, self.head:] ** 2).sum(axis=1), 0))
        bound = self.turned[:, : self.head] @ rotated[:, : self.head].T + np.outer(self.rest, rest) + slack
        alive = bound >= self.least[:, None]
        for i in np.flatnonzero(alive.any(axis=1)):
            rows = np.flatnonzero(alive[i])
            rows = rows[ids[rows] != self.queries[i]]
            if not len(rows):
                continue
            found = np.concatenate([self.ids[i], ids[rows]])
            scores = np.concatenate([self.scores[i], _products(self.qx[i : i + 1], cx[rows])[0]])
            order = np.lexsort((found, -scores))[: self.k]
            self.ids[i], self.scores[i] = found[order], scores[order]
            if len(order) == self.k:
                self.least[i] = max(self.least[i], float(scores[order[-1]]))

    def rows(self, number: int) -> pd.DataFrame:
        place = np.repeat(np.arange(len(self.ids)), [len(found) for found in self.ids])
        return pd.DataFrame({
            "query": number, "place": place, "query_id": self.queries[place],
            "vec_id": np.concatenate(self.ids), "score": np.concatenate(self.scores),
        })


def top_k(
    vectors: DataFrame, queries: DataFrame, k: int = 20, head: int = 24, seeds: int = 2
) -> DataFrame:
    """``query_id, rank, vec_id, score`` for ``queries`` against ``vectors``, both of ``whole_components``."""
    schema = "query_id long, rank int, vec_id long, score long"
    vectors = written(vectors, "vectors")
    queries = written(queries, "queries")
    width = max(d.agg(F.max(F.size("x"))).first()[0] or 0 for d in (vectors, queries))
    if not width:
        return vectors.sparkSession.createDataFrame([], schema)
    turn = rotation(vectors, width)
    blocks = written(_packed(vectors, width, BLOCK), "vector-blocks")
    # blocks of few rows, at the end of a task's range, do no harm; seeds are the longest vectors
    first = blocks.orderBy(F.desc("longest"), "ids").limit(seeds).collect()
    seed_ids = np.frombuffer(b"".join(r["ids"] for r in first), np.int64)
    seed_x = np.frombuffer(b"".join(r["xs"] for r in first), np.int64).reshape(-1, width)

    def seeded(batches):
        """Query blocks with each query's k-th score among the seeds, and what a block must reach."""
        for rows in batches:
            found = []
            for ids, xs, number in zip(rows["ids"], rows["xs"], rows["number"]):
                q_ids = np.frombuffer(ids, np.int64)
                q = np.frombuffer(xs, np.int64).reshape(-1, width)
                scores = _products(q, seed_x).astype(float)
                scores[q_ids[:, None] == seed_ids[None, :]] = -np.inf
                least = np.full(len(q), -np.inf)
                if scores.shape[1] >= k:
                    least = -np.partition(-scores, k - 1, axis=1)[:, k - 1]
                norms = np.sqrt((q.astype(float) ** 2).sum(axis=1))
                with np.errstate(divide="ignore", invalid="ignore"):
                    needs = np.where(norms > 0, least / norms, np.where(least > 0, np.inf, -np.inf))
                found.append((number, ids, xs, least.tobytes(), float(needs.min()) * (1 - 1e-9) - 1e-9))
            yield pd.DataFrame(found, columns=["number", "ids", "xs", "least", "needs"])

    query_blocks = written(
        _packed(queries, width, QUERY_BLOCK).withColumn("number", F.monotonically_increasing_id())
        .mapInPandas(seeded, "number long, ids binary, xs binary, least binary, needs double"), "query-blocks",
    )
    longest, many = blocks.agg(F.max("longest"), F.count("*")).first()
    slots = max(1, min(SLOTS, -(-many // _PER_SLOT)))
    groups = max(1, min(SLOTS, -(-query_blocks.count() // _PER_SLOT)))

    def every(n: int) -> Column:
        return F.explode(F.sequence(F.lit(0), F.lit(n - 1)))

    listed = query_blocks.filter(F.col("needs") <= longest).select(
        "number", F.col("ids").alias("q_ids"), F.col("xs").alias("q_xs"), "least", "needs",
        F.pmod(F.xxhash64("number"), F.lit(groups)).cast("int").alias("group"), every(slots).alias("slot"),
    )
    # blocks are numbered in order of length, so neighbours go to different slots and each has long and short ones
    dealt = blocks.select(
        "longest", "ids", "xs", F.pmod("turn", F.lit(slots)).alias("of_slot"), every(groups).alias("of_group")
    )
    # a merge join goes through a slot once for each query block, and holds it on disk if need be
    pairs = listed.join(
        dealt.hint("merge"), (F.col("slot") == F.col("of_slot")) & (F.col("group") == F.col("of_group"))
    ).filter("longest >= needs")

    def search(batches):
        """The pairs of a query block follow one another, as the join goes through its blocks one by one."""
        best, at = None, None
        for rows in batches:
            for number, slot, q_ids, q_xs, least, ids, xs in zip(*(rows[c] for c in _PAIR)):
                if (number, slot) != at:
                    if best is not None:
                        yield best.rows(at[0])
                    at = number, slot
                    best = _Best(
                        np.frombuffer(q_ids, np.int64), np.frombuffer(q_xs, np.int64).reshape(-1, width),
                        np.frombuffer(least, float), k, turn, min(head, width),
                    )
                best.meet(np.frombuffer(ids, np.int64), np.frombuffer(xs, np.int64).reshape(-1, width))
        if best is not None:
            yield best.rows(at[0])

    best = pairs.select(*_PAIR).mapInPandas(
        search, "query long, place long, query_id long, vec_id long, score long"
    )
    ranked = W.partitionBy("query", "place").orderBy(F.desc("score"), "vec_id")
    return (
        best.withColumn("rank", F.row_number().over(ranked)).filter(F.col("rank") <= k)
        .select("query_id", F.col("rank").cast("int"), "vec_id", "score")
    )
