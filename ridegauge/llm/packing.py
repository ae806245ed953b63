"""Pack token sequences by length patterns whose repeat counts come from non-negative least squares.

The pieces' lengths are counted into a histogram, at most ``capacity`` numbers however many
documents there are.  Patterns of up to three documents that fill a sequence, on lengths rounded up
to ``capacity / 256``, are the columns of a least squares fit to the histogram; each repeat count
is rounded down.  What is left over goes best-fit, longest first, into the room the patterns leave
and into new sequences, still as counts of equal lengths rather than one document at a time.  The
plan is a list of runs ("pieces number a to b of length L go to sequences from s on, at offset o"),
whose size depends on ``capacity`` only.  Each piece then finds its place by its number among the
pieces of its length; no piece meets another in one group.

Null texts count as empty and hold the end token alone.  Repeated rows are packed as often as they
come.  An empty table gives an empty result.
"""

import json
import zlib
from bisect import bisect_left, insort
from collections import defaultdict
from collections.abc import Callable
from functools import lru_cache

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ridegauge.llm.common import in_batches, whole
from ridegauge.session import written

_UNITS = 256
_RANK_BITS = 50

PIECES = (
    "doc_id long, piece int, start long, length long, ids_crc32 long, ids binary, task int, nth long"
)


@lru_cache(maxsize=2)
def _encoder(path: str) -> Callable[[str], bytes]:
    """Text to packed ids, as the tokenizer's library gives them without special tokens added.

    The name of a special token in a text becomes that token, as it does there.
    """
    by_rank = _by_rank(path)
    if by_rank is not None:
        return lambda text: by_rank.encode_to_numpy(text, allowed_special="all").astype("<u4").tobytes()
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(path)
    return lambda text: np.array(tokenizer.encode(text, add_special_tokens=False).ids, "<u4").tobytes()


def _by_rank(path: str):
    """The same vocabulary as an encoder by ranks, four times as fast, where ids are ranks.

    That is so if it is a plain byte-level BPE whose ids after the single bytes follow its merges and
    its special tokens are plain strings; any other file gives None and is left to its own library.
    """
    import tiktoken
    from public_tokenizers import PATTERN

    with open(path, encoding="utf-8") as file:
        described = json.load(file)
    model, before = described["model"], described.get("pre_tokenizer") or {}
    plain = (
        model.get("type") == "BPE" and before.get("type") == "ByteLevel" and not described.get("normalizer")
        and not before.get("add_prefix_space") and before.get("use_regex", True)
        and not any(model.get(k) for k in ("dropout", "continuing_subword_prefix", "end_of_word_suffix", "ignore_merges"))
    )
    if not plain:
        return None
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    letters = {chr(b): b for b in shown}  # how byte-level vocabularies write their bytes
    letters |= {chr(256 + i): b for i, b in enumerate(b for b in range(256) if b not in set(shown))}
    special = {token["content"]: token["id"] for token in described.get("added_tokens", ())}
    odd = ("single_word", "lstrip", "rstrip")
    if any(token.get(k) for token in described.get("added_tokens", ()) for k in odd):
        return None
    ids = {token: i for token, i in model["vocab"].items() if token not in special}
    merged = [ids.get("".join(m.split(" ") if isinstance(m, str) else m)) for m in model["merges"]]
    if None in merged or merged != sorted(merged) or len(merged) + 256 != len(ids):
        return None
    ranks = {bytes(letters[c] for c in token): i for token, i in ids.items()}
    return tiktoken.Encoding("ranks", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens=special)


def cut(length: int, capacity: int) -> list[tuple[int, int]]:
    """(start, length) of the pieces of a document; only the first may be shorter."""
    first = length % capacity or capacity
    return [(0, min(first, length))] + [(start, capacity) for start in range(first, length, capacity)]


def tokenized(
    docs: DataFrame, path: str, capacity: int = 2048, end: int = 0, keep_ids: bool = False
) -> DataFrame:
    """The pieces of each document, numbered per task and length in ``nth``.

    ``ids`` holds the packed ids of the piece if ``keep_ids`` is set, else null.
    """
    last = np.array([end], "<u4").tobytes()

    def pieces(batches):
        import os

        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # the task's core is its own, not the machine
        encode, task, seen = _encoder(path), TaskContext.get().partitionId(), defaultdict(int)
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                doc_ids, texts = (column.to_pylist() for column in batch.slice(at, 256).columns)
                rows = []
                for doc_id, text in zip(doc_ids, texts):
                    packed = encode(text) + last
                    for piece, (start, length) in enumerate(cut(len(packed) // 4, capacity)):
                        ids = packed[4 * start : 4 * (start + length)]
                        rows.append((
                            doc_id, piece, start, length, zlib.crc32(ids), ids if keep_ids else None,
                            task, seen[length],
                        ))
                        seen[length] += 1
                yield pa.RecordBatch.from_arrays(
                    [pa.array(column, kind) for column, kind in zip(zip(*rows), _KINDS)],
                    names=[name.split()[0] for name in PIECES.split(", ")],
                )

    _KINDS = [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.binary(), pa.int32(), pa.int64()]
    return docs.select(F.col("doc_id").cast("long"), whole("text")).mapInArrow(pieces, PIECES)


def nnls(a: np.ndarray, b: np.ndarray, tolerance: float = 1e-7) -> np.ndarray:
    """Lawson and Hanson's active set method: the x >= 0 nearest to a @ x = b."""
    x = np.zeros(a.shape[1])
    active = np.zeros(a.shape[1], bool)
    for _ in range(3 * a.shape[0]):
        gradient = a.T @ (b - a @ x)
        gradient[active] = -np.inf
        best = int(np.argmax(gradient))
        if gradient[best] <= tolerance:
            break
        active[best] = True
        while True:
            chosen = np.flatnonzero(active)
            solved = np.linalg.lstsq(a[:, chosen], b, rcond=None)[0]
            if (solved > 0).all():
                x[:] = 0
                x[chosen] = solved
                break
            low = solved <= 0
            step = np.min(x[chosen][low] / (x[chosen][low] - solved[low]))
            x[chosen] += step * (solved - x[chosen])
            x[chosen[(x[chosen] <= 1e-12)]] = 0
            active = x > 0
            if not active.any():
                return x
    return x


def patterns(units: list[int], full: int) -> list[tuple[int, ...]]:
    """One to three of ``units`` that together fill ``full``."""
    have = set(units)
    found = [(full,)] if full in have else []
    for a in units:
        if full - a <= a and full - a in have:
            found.append((a, full - a))
        for b in units:
            c = full - a - b
            if a >= b >= c > 0 and c in have:
                found.append((a, b, c))
    return found


class Plan:
    """Runs of equal pieces: ``(length, first number, how many, first sequence, offset)``."""

    def __init__(self, histogram: dict[int, int], capacity: int):
        self.capacity, self.runs, self.sequences = capacity, [], 0
        self._left = {length: n for length, n in histogram.items() if n > 0}
        self._next = defaultdict(int)
        self._rooms: dict[int, list[list[int]]] = defaultdict(list)
        self._free: list[int] = []
        self._whole()
        self._fitted()
        self._best_fit()

    def _place(self, length: int, many: int, sequence: int, offset: int) -> None:
        self.runs.append((length, self._next[length], many, sequence, offset))
        self._next[length] += many
        self._left[length] -= many

    def _open(self, many: int) -> int:
        self.sequences += many
        return self.sequences - many

    def _room(self, free: int, sequence: int, many: int) -> None:
        if free and many:
            if not self._rooms[free]:
                insort(self._free, free)
            self._rooms[free].append([sequence, many])

    def _whole(self) -> None:
        many = self._left.get(self.capacity, 0)
        if many:
            self._place(self.capacity, many, self._open(many), 0)

    def _fitted(self) -> None:
        grain = max(1, self.capacity // _UNITS)
        full = self.capacity // grain
        by_unit = defaultdict(list)
        for length in sorted(self._left, reverse=True):
            if self._left[length]:
                by_unit[-(-length // grain)].append(length)
        units = sorted(by_unit)
        columns = patterns(units, full)
        if not columns:
            return
        place = {unit: i for i, unit in enumerate(units)}
        a = np.zeros((len(units), len(columns)))
        for j, pattern in enumerate(columns):
            for unit in pattern:
                a[place[unit], j] += 1
        b = np.array([sum(self._left[x] for x in by_unit[unit]) for unit in units], float)
        repeats = np.floor(nnls(a, b / b.max()) * b.max() + 1e-6).astype(np.int64)
        for j in np.argsort(-repeats, kind="stable"):
            self._repeat(columns[j], int(repeats[j]), by_unit)

    def _repeat(self, pattern: tuple[int, ...], many: int, by_unit: dict[int, list[int]]) -> None:
        """Up to ``many`` sequences of ``pattern``, in runs of the same exact lengths."""
        while many > 0:
            lengths, taken = [], defaultdict(int)
            for unit in pattern:
                length = next((x for x in by_unit[unit] if self._left[x] > taken.get(x, 0)), None)
                if length is None:
                    return
                taken[length] += 1
                lengths.append(length)
            run = min([many, *(self._left[x] // n for x, n in taken.items())])
            sequence, offset = self._open(run), 0
            for length in lengths:
                self._place(length, run, sequence, offset)
                offset += length
            self._room(self.capacity - offset, sequence, run)
            many -= run

    def _best_fit(self) -> None:
        for length in sorted(self._left, reverse=True):
            while self._left[length]:
                at = bisect_left(self._free, length)
                if at < len(self._free):
                    free = self._free[at]
                    sequence, rooms = self._rooms[free][-1]
                    many = min(rooms, self._left[length])
                    if many == rooms:
                        self._rooms[free].pop()
                        if not self._rooms[free]:
                            self._free.pop(at)
                    else:
                        self._rooms[free][-1][:] = [sequence + many, rooms - many]
                    self._place(length, many, sequence, self.capacity - free)
                    self._room(free - length, sequence, many)
                else:
                    together = min(self.capacity // length, self._left[length])
                    many = self._left[length] // together
                    sequence = self._open(many)
                    for i in range(together):
                        self._place(length, many, sequence, i * length)
                    self._room(self.capacity - together * length, sequence, many)


def packed(pieces: DataFrame, capacity: int = 2048) -> DataFrame:
    """``pieces`` of ``tokenized``, written out, with ``sequence_id`` and ``offset``.

    The numbers per task are made numbers over all tasks from the counts per task and length.
    """
    counts = pieces.groupBy("task", "length").agg(F.count("*").alias("n"))
    earlier = W.partitionBy("length").orderBy("task").rowsBetween(W.unboundedPreceding, -1)
    before = counts.select(
        F.col("task").alias("of_task"), F.col("length").alias("of_length"),
        F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("before"),
    )
    histogram = {row["length"]: row["n"] for row in counts.groupBy("length").agg(F.sum("n").alias("n")).collect()}
    runs = sorted(Plan(histogram, capacity).runs)
    length, first, _, sequence, offset = (np.array(x, np.int64) for x in zip(*runs or [(0,) * 5]))
    keys = (length << _RANK_BITS) + first

    def place(batches):
        for rows in batches:
            number = rows.pop("number").to_numpy(np.int64)
            run = np.searchsorted(keys, (rows["length"].to_numpy(np.int64) << _RANK_BITS) + number, "right") - 1
            yield rows.assign(
                sequence_id=pd.Series(sequence[run] + number - first[run], index=rows.index),
                offset=pd.Series(offset[run], index=rows.index),
            )

    numbered = pieces.join(
        before, (pieces["task"] == before["of_task"]) & (pieces["length"] == before["of_length"])
    )
    columns = ["doc_id", "piece", "start", "length", "ids_crc32", "ids"]
    return numbered.select(*columns, (F.col("nth") + F.col("before")).alias("number")).mapInPandas(
        place,
        "doc_id long, piece int, start long, length long, ids_crc32 long, ids binary, "
        "sequence_id long, offset long",
    )


def pack(
    docs: DataFrame, path: str, capacity: int = 2048, end: int = 0, keep_ids: bool = False
) -> DataFrame:
    """Each piece of each document (``doc_id``, ``text``) with its sequence and its place there."""
    return packed(written(tokenized(docs, path, capacity, end, keep_ids), "pieces"), capacity)
