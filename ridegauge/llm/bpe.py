"""Byte-level BPE as a tree reduction.

A text is halved until its pieces are small, the pieces are encoded, and neighbours are joined on
the way back up.  Encodings do not simply concatenate: tokens at the seam may change.  The join
therefore encodes a window around the seam again and widens it until both its ends are places no
token can ever cross: a single space after and before another character, as the pre-tokenizer lets
a space only begin a token there.  Tokens beyond such a place cannot depend on what is on its other
side, so they are kept as they are.
Joining is associative with the empty text as its neutral element, whatever the tree.  Decoding
concatenates the bytes of tokens up the same kind of tree.

Null texts count as empty; any text, of any length, comes back byte for byte.
"""

from collections.abc import Iterator
from functools import lru_cache
from hashlib import sha256

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ridegauge.llm.common import in_batches, whole


_LEAF = 2048
_WINDOW = 64


def cut_before(text: str, lowest: int, seam: int) -> int | None:
    """The last place in [lowest, seam) that no token crosses, if there is one."""
    place = text.rfind(" ", max(lowest, 1), seam)
    while place > 0 and not _uncrossed(text, place):
        place = text.rfind(" ", max(lowest, 1), place)
    return place if place > 0 else None


def cut_after(text: str, seam: int, highest: int) -> int | None:
    """The first place in (seam, highest] that no token crosses, if there is one."""
    place = text.find(" ", seam + 1, highest + 1)
    while place > 0 and not _uncrossed(text, place):
        place = text.find(" ", place + 1, highest + 1)
    return place if place > 0 else None


def _uncrossed(text: str, place: int) -> bool:
    return place + 1 < len(text) and not text[place - 1].isspace() and not text[place + 1].isspace()


class Codec:
    """Ranks and pattern of a vocabulary, with the tree on top.  Ids are 4-byte little-endian."""

    def __init__(self, path: str, pattern: str, leaf: int = _LEAF):
        import base64

        import tiktoken

        with open(path, "rb") as lines:
            ranks = {base64.b64decode(a): int(b) for a, b in (line.split() for line in lines if line.strip())}
        self._encoding = tiktoken.Encoding(
            "ranks", pat_str=pattern, mergeable_ranks=ranks, special_tokens={}
        )
        self._bytes = {rank: token for token, rank in ranks.items()}
        self._lengths = np.zeros(max(ranks.values()) + 1, np.int64)
        for token, rank in ranks.items():
            self._lengths[rank] = len(token)
        self._leaf = leaf

    def encode(self, text: str) -> bytes:
        return self._tree(text, 0, len(text)) if text else b""

    def _plain(self, text: str) -> bytes:
        return self._encoding.encode_to_numpy(text, disallowed_special=()).astype("<u4").tobytes()

    def _tree(self, text: str, start: int, end: int) -> bytes:
        if end - start <= self._leaf:
            return self._plain(text[start:end])
        seam = (start + end) // 2
        left, right = self._tree(text, start, seam), self._tree(text, seam, end)
        return self._join(text, start, seam, end, left, right)

    def _join(self, text: str, start: int, seam: int, end: int, left: bytes, right: bytes) -> bytes:
        low = high = None
        width = _WINDOW
        while low is None or high is None:
            if low is None:
                edge = max(start, seam - width)
                # the window may not reach beyond this node: its own start is a start for now
                low = cut_before(text, edge + 1, seam)
                if low is None and edge == start:
                    low = start
            if high is None:
                edge = min(end, seam + width)
                high = cut_after(text, seam, edge - 1)
                if high is None and edge == end:
                    high = end
            width *= 2
        kept = 4 * self._covering(left, len(text[low:seam].encode()), last=True)
        dropped = 4 * self._covering(right, len(text[seam:high].encode()), last=False)
        window = self._plain(text[low:high])
        return left[: len(left) - kept] + window + right[dropped:]

    def _covering(self, ids: bytes, size: int, last: bool) -> int:
        """How many of the first or last tokens have ``size`` bytes together."""
        taken = 0
        many = min(len(ids) // 4, size)
        if many:
            piece = ids[len(ids) - 4 * many :] if last else ids[: 4 * many]
            lengths = self._lengths[np.frombuffer(piece, "<u4")]
            total = np.cumsum(lengths[::-1] if last else lengths)
            taken = int(np.searchsorted(total, size)) + 1
        return taken if size else 0

    def decode(self, ids: bytes) -> bytes:
        if len(ids) <= 4 * _LEAF:
            return b"".join(map(self._bytes.__getitem__, np.frombuffer(ids, "<u4").tolist()))
        middle = len(ids) // 8 * 4
        return self.decode(ids[:middle]) + self.decode(ids[middle:])


@lru_cache(maxsize=1)
def codec(path: str, pattern: str) -> Codec:
    """One per Python worker."""
    return Codec(path, pattern)


def encoded(text: Column, path: str, pattern: str) -> Column:
    """The ids of each text, packed as little-endian unsigned 32-bit integers."""

    @F.pandas_udf("binary")
    def encode(parts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        own = codec(path, pattern)
        for texts in parts:
            yield pd.Series([own.encode(t) for t in texts], dtype=object)

    return encode(F.coalesce(text, F.lit("")))


def decoded(ids: Column, path: str, pattern: str) -> Column:
    """The bytes that packed ids stand for; null ids stand for nothing."""

    @F.pandas_udf("binary")
    def decode(parts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        own = codec(path, pattern)
        for packed in parts:
            yield pd.Series([own.decode(p) for p in packed], dtype=object)

    return decode(F.coalesce(ids, F.lit(b"")))


DIGESTS = "n_tokens long, ids_sha256 string, decoded_sha256 string"


def digests(docs: DataFrame, path: str, pattern: str) -> DataFrame:
    """``doc_id``, the number of ids, and the hashes of the packed ids and of what they decode to.

    Both directions in one pass: neither ids nor decoded texts leave the worker, which holds one
    vocabulary and one document at a time beside its Arrow batch.
    """

    def digest(ids: pa.Array, texts: pa.Array) -> pa.RecordBatch:
        own = codec(path, pattern)
        packed = (own.encode(text.as_py()) for text in texts)
        rows = [(len(p) // 4, sha256(p).hexdigest(), sha256(own.decode(p)).hexdigest()) for p in packed]
        counts, coded, plain = zip(*rows)
        return pa.RecordBatch.from_arrays(
            [ids, pa.array(counts, pa.int64()), pa.array(coded), pa.array(plain)],
            names=["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"],
        )

    return in_batches(docs, digest, f"doc_id long, {DIGESTS}", F.col("doc_id").cast("long"), whole("text"))
