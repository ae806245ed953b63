"""Class-based bigram language model with classes found by exchange clustering.

A word's probability is P(class | class before) * P(word | class), both from counts over all
training texts, smoothed by adding to every count.  A text is its words and one end token; the
first word follows the end.

Texts are split into words once.  A chunk of texts is a row: the words that occur in it, and the texts as
places in that list.  The words of all chunks are counted and numbered by frequency; frequent words are looked
up in the task, the others meet their numbers in a join on the word and go back to their chunk, each once a
chunk.  Bigrams and scores are taken from the numbers.

Every word of the training texts is clustered, over the word bigrams of all of them.  Words are dealt to parts
by number; a part's row holds, for each of its words, which words come before and after it and how often, as
compressed arrays.  In each round the tasks sum these by class; a share of the words, drawn anew each round, may
move to the class that raises the likelihood most.  The ``most_units`` most frequent words are exchanged first,
then all.  While only the frequent move, the others count by class, in a smaller table.  A round that lowers the
likelihood is undone and the share halved.  When a round
of at least half of the words gains less than ``TOLERANCE`` of what all rounds before have gained, or
twelve rounds in a row gain nothing, a last round offers a move to every word at once, and is kept if it gains.

The word counts and neighbours are distributed tables.  The classes of all words, one byte each, are
on the driver and in every task that exchanges or scores.  A word that was not seen in
training may be of any class, with the classes' probabilities.

A text's whole probability depends only on its own words, so rows are scored one by one; repeated
rows are scored as often as they come.  Null texts count as empty (the end token alone).  A row
without ``doc_id`` has no remainder: it is not held out.  With no training texts every word has the
probability of an unseen one.
"""

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ridegauge.llm.common import whole
from ridegauge.session import shuffles_dropped, written

END = "\n"  # no word contains white space
TOLERANCE = 0.01
_SMOOTHING = 0.5


def words(texts: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """The words of all texts, one text after the other, and how many each has."""
    split = pc.ascii_split_whitespace(pc.ascii_lower(texts))
    found, ends = split.flatten(), split.offsets.to_numpy()
    kept = pc.greater(pc.binary_length(found), 0)  # white space at a text's border leaves an empty piece
    before = np.concatenate([[0], np.cumsum(kept.to_numpy(zero_copy_only=False))])
    return found.filter(kept), np.diff(before[ends])


def packed(values: np.ndarray) -> bytes:
    """An array as compressed bytes; its type has to be known to read it."""
    return values.size.to_bytes(8, "little") + pa.compress(values.tobytes(), "zstd", asbytes=True)


def unpacked(data: pa.Scalar, kind: type) -> np.ndarray:
    held = data.as_buffer()
    size = int.from_bytes(held[:8], "little") * np.dtype(kind).itemsize
    return np.frombuffer(pa.decompress(held[8:], size, "zstd"), kind)


def held_out(doc_id: str = "doc_id"):
    return F.coalesce(F.crc32(F.col(doc_id).cast("string")) % 7 == 2, F.lit(False))


@dataclass(frozen=True)
class Coded:
    """Chunks of texts (``chunk``): their distinct words, how often training texts have each (``word, n``), and
    the texts as places in these lists (``codes``, packed, ``sizes`` words a text).  The end token is the first word."""

    rows: DataFrame


def coded(docs: DataFrame, learn: Column | bool = True, most_tokens: int = 1 << 20) -> Coded:
    """All rows of ``doc_id, text`` in chunks of ``most_tokens`` words or more; ``learn`` says which are training texts."""

    def chunks(batches):
        number = TaskContext.get().partitionId() << 33
        rows, found, sizes, tokens, size = [], [], [], 0, 0
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                part = batch.slice(at, 256)
                of_part, each = words(part.column("text"))
                if size + of_part.nbytes > 1 << 30:  # an Arrow string array ends at 2 GB
                    yield chunk(number, rows, found, sizes)
                    rows, found, sizes, tokens, size, number = [], [], [], 0, 0, number + 1
                rows.append(part.drop_columns(["text"]))
                found.append(of_part)
                sizes.append(each)
                tokens, size = tokens + len(of_part), size + of_part.nbytes
                if tokens >= most_tokens:
                    yield chunk(number, rows, found, sizes)
                    rows, found, sizes, tokens, size, number = [], [], [], 0, 0, number + 1
        if rows:
            yield chunk(number, rows, found, sizes)

    def chunk(number: int, rows: list, found: list, sizes: list) -> pa.RecordBatch:
        encoded = pa.concat_arrays([pa.array([END]), *found]).dictionary_encode()
        codes, each = encoded.indices.to_numpy()[1:], np.concatenate(sizes)
        texts = pa.Table.from_batches(rows).combine_chunks()
        learned = texts["learn"].to_numpy()
        n = np.bincount(codes[np.repeat(learned, each)], minlength=len(encoded.dictionary))
        n[0] = learned.sum()
        columns = [texts[name].combine_chunks() for name in ("doc_id", "held_out", "learn")]
        doc_id, held, learn_, word, n = (
            pa.ListArray.from_arrays([0, len(x)], x) for x in (*columns, encoded.dictionary, pa.array(n))
        )
        return pa.RecordBatch.from_arrays(
            [pa.array([number]), doc_id, held, learn_, pa.array([packed(each.astype(np.int64))]),
             pa.array([packed(codes.astype(np.int32))]), word, n],
            names=["chunk", "doc_id", "held_out", "learn", "sizes", "codes", "word", "n"],
        )

    learn = F.lit(learn) if isinstance(learn, bool) else learn
    rows = docs.select(
        F.col("doc_id").cast("long"), held_out().alias("held_out"), F.coalesce(learn, F.lit(False)).alias("learn"),
        whole("text").alias("text"),
    )
    return Coded(written(rows.mapInArrow(
        chunks, "chunk long, doc_id array<long>, held_out array<boolean>, learn array<boolean>, sizes binary, "
        "codes binary, word array<string>, n array<long>"
    ), "texts"))


def word_counts(texts: Coded) -> DataFrame:
    """``word, n`` over all training texts, the end token included."""

    def counts(batches):
        for batch in batches:
            word, n = (batch.column(i).flatten() for i in range(2))
            found = pc.greater(n, 0)
            yield pa.RecordBatch.from_arrays([word.filter(found), n.filter(found)], names=["word", "n"])

    partial = texts.rows.select("word", "n").mapInArrow(counts, "word string, n long")
    return partial.groupBy("word").agg(F.sum("n").alias("n"))


@dataclass(frozen=True)
class Units:
    """The numbers of words, by frequency."""

    numbered: DataFrame

    def of(self, word: bytes) -> int:
        return self.numbered.filter(F.col("word") == word.decode()).first()["id"]


def numbered(counts: DataFrame) -> DataFrame:
    """``word, n, id``: word counts, numbered from the most frequent on."""
    ordered = written(
        counts.orderBy(F.desc("n"), "word").withColumn("place", F.monotonically_increasing_id()), "ordered"
    )
    part = F.shiftright("place", 33)
    sizes = ordered.groupBy(part.alias("part")).count().orderBy("part").collect()
    starts, total = {}, 0
    for row in sizes:
        starts[row["part"]] = total - (row["part"] << 33)
        total += row["count"]
    start = F.element_at(F.create_map(*(F.lit(x).cast("long") for pair in starts.items() for x in pair)), part.cast("long"))
    number = F.col("place") + start if starts else F.col("place")
    return ordered.select("word", "n", number.cast("int").alias("id"))


def numbers(texts: Coded, words_: DataFrame, most_frequent: int) -> DataFrame:
    """The chunks with the number and count of each of their words (``ids, n``, packed; -1 and 0 for unseen words)."""
    top = words_.filter(F.col("id") < most_frequent).orderBy("id").collect()
    frequent, top_n = pa.array([row["word"] for row in top], pa.string()), np.array([row["n"] for row in top] + [0], np.int64)

    def rarer(batches):
        for batch in batches:
            for chunk, word in zip(batch.column(0), batch.column(1)):
                rare = pc.invert(pc.is_in(word.values, value_set=frequent))
                place = np.flatnonzero(rare.to_numpy(zero_copy_only=False)).astype(np.int32)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(len(place), chunk.as_py())), pa.array(place), word.values.filter(rare)],
                    names=["chunk", "place", "word"],
                )

    def looked_up(batches):
        for batch in batches:
            ids = [packed(pc.fill_null(pc.index_in(word.values, value_set=frequent), -1).to_numpy()) for word in batch.column(0)]
            yield pa.RecordBatch.from_arrays([pa.array(ids, pa.binary()), *batch.columns[1:]], names=["ids", "chunk", *kept])

    def met(chunks: pa.Table, found: pa.Table) -> pa.Table:
        ids = unpacked(chunks["ids"][0], np.int32).copy()
        n = top_n[ids]
        place = found["place"].to_numpy()
        ids[place], n[place] = found["id"].to_numpy(), found["n"].to_numpy()
        return chunks.select(kept).append_column("ids", pa.array([packed(ids)])).append_column("n", pa.array([packed(n)]))

    kept = ["doc_id", "held_out", "learn", "sizes", "codes"]
    schema = "doc_id array<long>, held_out array<boolean>, learn array<boolean>, sizes binary, codes binary"
    rare = (
        texts.rows.select("chunk", "word").mapInArrow(rarer, "chunk long, place int, word string")
        .join(words_, "word").select("chunk", "place", "id", "n")
    )
    return written(
        texts.rows.select("word", "chunk", *kept).mapInArrow(looked_up, f"ids binary, chunk long, {schema}")
        .groupBy("chunk").cogroup(rare.groupBy("chunk")).applyInArrow(met, f"{schema}, ids binary, n binary"),
        "numbered-texts",
    )


def in_line(codes: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """Codes of texts one after the other, with the end token (0) before, between and after them."""
    line = np.zeros(len(codes) + len(sizes) + 1, np.int64)
    line[np.arange(1, len(codes) + 1) + np.repeat(np.arange(len(sizes)), sizes)] = codes
    return line


def neighbours(numbered_texts: DataFrame, size: int, tokens: int, most_pairs: int = 2_000_000) -> DataFrame:
    """For each part of the words (``ids``) the words before and after each, and how often they come there.

    Packed: how many different words come before each (``bk``), these (``b``) and their counts (``bn``), likewise after.
    """
    parts = max(1, tokens // 500_000)
    each = -(-size // parts)

    def blocks(batches):
        pending, held = [], 0
        for batch in batches:
            for row in range(batch.num_rows):
                learn, sizes, codes, ids = (batch.column(i)[row] for i in range(4))
                learn, sizes = learn.values.to_numpy(zero_copy_only=False), unpacked(sizes, np.int64)
                ids = unpacked(ids, np.int32).astype(np.int64)
                if not learn.any():
                    continue
                line = ids[in_line(unpacked(codes, np.int32)[np.repeat(learn, sizes)], sizes[learn])]
                pending.append(line[:-1] * size + line[1:])
                held += len(line)
                if held >= most_pairs:
                    yield table(pending)
                    pending, held = [], 0
        if pending:
            yield table(pending)

    def table(pending: list[np.ndarray]) -> pa.RecordBatch:
        pairs, n = np.unique(np.concatenate(pending), return_counts=True)
        first, second = np.divmod(pairs, size)
        found = []
        for side, of, other in (("a", first, second), ("b", second, first)):
            key = (of % parts * each + of // parts) * size + other
            order = np.argsort(key)
            key, count = key[order], n[order]
            place, other = np.divmod(key, size)
            ends = np.searchsorted(place, np.arange(parts + 1) * each)
            for part in np.flatnonzero(np.diff(ends)):
                at = slice(ends[part], ends[part + 1])
                found.append((
                    part, side, packed((place[at] - part * each).astype(np.int32)), packed(other[at].astype(np.int32)),
                    packed(count[at]),
                ))
        kinds = (pa.int32(), pa.string(), pa.binary(), pa.binary(), pa.binary())
        return pa.RecordBatch.from_arrays(
            [pa.array([x[i] for x in found], kind) for i, kind in enumerate(kinds)], names=["part", "side", "k", "w", "n"]
        )

    def merged(rows: pa.Table) -> pa.Table:
        part = rows["part"][0].as_py()
        ids = np.arange(part, size, parts)
        out = [packed(ids.astype(np.int32))]
        for side in ("b", "a"):
            own = rows.filter(pc.equal(rows["side"], side))
            k, w, n = (
                np.concatenate([np.empty(0, kind), *(unpacked(x, kind) for x in own[name])])
                for name, kind in (("k", np.int32), ("w", np.int32), ("n", np.int64))
            )
            key, n = summed(k.astype(np.int64) * size + w, n)
            out += _lists(*np.divmod(key, size), n, len(ids))
        return pa.Table.from_arrays([pa.array([x]) for x in out], names=_COLUMNS)

    return written(
        numbered_texts.select("learn", "sizes", "codes", "ids")
        .mapInArrow(blocks, "part int, side string, k binary, w binary, n binary")
        .groupBy("part").applyInArrow(merged, _SCHEMA), "neighbours",
    )


_COLUMNS = ["ids", "bk", "b", "bn", "ak", "a", "an"]
_SCHEMA = ", ".join(f"{name} binary" for name in _COLUMNS)


def summed(key: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The different keys in order, and the sum of each."""
    order = np.argsort(key, kind="stable")
    key = key[order]
    first = np.flatnonzero(np.diff(key, prepend=-1))
    return key[first], np.add.reduceat(n[order], first) if len(first) else n


def _lists(row: np.ndarray, word: np.ndarray, n: np.ndarray, many: int) -> list[bytes]:
    return [packed(np.bincount(row, minlength=many)), packed(word.astype(np.int32)), packed(n)]


def by_frequent(around: DataFrame, classes: np.ndarray, first: int, many: int) -> DataFrame:
    """``around`` with the words from number ``first`` on replaced by their classes, numbered from there."""

    def known(ids: np.ndarray) -> np.ndarray:
        return np.where(ids < first, ids, first + classes[ids].astype(np.int64))

    def relabelled(batches):
        for batch in batches:
            for row in range(batch.num_rows):
                ids, own = np.unique(known(unpacked(batch.column(0)[row], np.int32)), return_inverse=True)
                out = [packed(ids.astype(np.int32))]
                for side in (1, 4):
                    at, word, n = _neighbours(batch, row, side)
                    key, n = summed(own[at] * (first + many) + known(word), n)
                    out += _lists(*np.divmod(key, first + many), n, len(ids))
                yield pa.RecordBatch.from_arrays([pa.array([x]) for x in out], names=_COLUMNS)

    return written(around.mapInArrow(relabelled, _SCHEMA), "frequent-neighbours")


def _neighbours(batch: pa.RecordBatch, row: int, side: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """For each neighbour on one side: the place of the word it is of, its number, and how often it comes."""
    each, word, n = (unpacked(batch.column(side + i)[row], kind) for i, kind in enumerate((np.int64, np.int32, np.int64)))
    return np.repeat(np.arange(len(each)), each), word, n


def _log(x: np.ndarray) -> np.ndarray:
    return x * np.log(np.maximum(x, 1))


def _likelihood(transitions: np.ndarray) -> float:
    """The clustering's objective; the words' own terms do not depend on the classes."""
    return float(
        _log(transitions).sum() - _log(transitions.sum(axis=0)).sum() - _log(transitions.sum(axis=1)).sum()
    )


def best_classes(sides: np.ndarray, own: np.ndarray, transitions: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Where units with these classes before and after them go, and what the objective gains by each.

    A unit is taken out first: its row and column counts leave its class (pairs of the unit with
    itself count as pairs with its class).
    """
    units, many = len(sides), len(transitions)
    every = np.arange(units)
    before, after = sides[:, :many], sides[:, many:]
    gain = np.zeros((units, many))
    for mine, sums in ((after.sum(axis=1), transitions.sum(axis=1)), (before.sum(axis=1), transitions.sum(axis=0))):
        kinds, kind = np.unique(mine, return_inverse=True)
        change = (_log(sums) - _log(sums + kinds[:, None]))[kind]  # pairs before the unit stay in their row
        rest = np.maximum(sums[own] - mine, 0)
        change[every, own] = _log(rest) - _log(rest + mine)
        gain += change
    # pairs before and after the unit meet where it goes to the class of both
    units_, sides_ = np.divmod(np.flatnonzero(sides), 2 * many)
    is_before = sides_ < many
    met_before, met_after = (units_[is_before], sides_[is_before]), (units_[~is_before], sides_[~is_before] - many)
    unit, g = (x[after[met_before] > 0] for x in met_before)
    b, a = before[unit, g], after[unit, g]
    twice = np.maximum(transitions[g, g] - (own[unit] == g) * (b + a), 0)
    gain[unit, g] += _log(twice + b + a) - _log(twice + b) - _log(twice + a) + _log(twice)
    for mine, others, counts, (unit, other) in (
        (before, after, transitions, met_before), (after, before, transitions.T, met_after)
    ):
        for at in range(0, len(unit), 16_384):
            k, g = unit[at : at + 16_384], other[at : at + 16_384]
            n = mine[k, g]
            # rare words share counts: a term for each class and count, put right where the unit's own class is met
            kinds, kind = np.unique(n.astype(np.int64) * many + g, return_inverse=True)
            rest = counts[kinds % many]
            change = (_log(rest + (kinds // many)[:, None]) - _log(rest))[kind]
            rest = np.maximum(counts[g, own[k]] - n, 0)
            change[np.arange(len(k)), own[k]] = _log(rest + n) - _log(rest)
            same = np.flatnonzero(g == own[k])
            rest = counts[g[same]] - others[k[same]]
            rest[np.arange(len(same)), own[k[same]]] -= n[same]
            np.maximum(rest, 0, out=rest)
            change[same] = _log(rest + n[same, None]) - _log(rest)
            first = np.flatnonzero(np.diff(k, prepend=-1))
            turn = np.arange(len(k)) - np.repeat(first, np.diff(first, append=len(k)))  # each unit's first, second, ...
            for entries in np.split(np.argsort(turn, kind="stable"), np.cumsum(np.bincount(turn))[:-1]):
                gain[k[entries]] += change[entries]
    best = gain.argmax(axis=1)
    return best, gain.max(axis=1) - gain[every, own]


def exchanged(
    around: DataFrame, size: int, many: int, rounds: int | None, most_units: int
) -> tuple[np.ndarray, np.ndarray]:
    """Classes of words, and the class transition counts, once exchange gains little (or after ``rounds``).

    Starts from the most frequent words in a class each and the others dealt by frequency.
    """
    classes = (np.arange(size) % many).astype(np.uint8 if many <= 256 else np.int32)
    drawn = np.random.default_rng(11)
    transitions = _transitions(around, classes, many)
    gained, share, turn, failed, first, last = 0.0, 1.0, 0, 0, min(size, most_units), False
    table, others = around, classes[:0]
    if first < size and rounds != 0:
        table, others = by_frequent(around, classes, first, many), np.arange(many, dtype=classes.dtype)
    while size and (rounds is None or turn < rounds):
        turn += 1
        among = first if first < size else size
        may_move = np.append(drawn.random(among) < share, np.zeros(len(others), bool))
        ids, to = _moves(table, np.append(classes[:among], others), transitions, may_move, many)
        moved = classes.copy()
        moved[ids] = to
        counted = _transitions(table, np.append(moved[:among], others), many) if len(ids) else transitions
        gain = _likelihood(counted) - _likelihood(transitions)
        if gain > 0:
            classes, transitions, gained = moved, counted, gained + gain
        if last:
            break
        failed = 0 if gain > 0 else failed + 1
        if failed and failed < 12 and (len(ids) or share < 1):
            share = share / 2 if len(ids) else 1.0
        elif failed or gain <= TOLERANCE * gained and share >= 0.5:
            if first == size:
                last, share = True, 1.0
            else:
                first, share, failed, table, others = size, 0.5, 0, around, classes[:0]
        else:
            share = min(0.5, 2 * share)
    return classes, transitions


def _transitions(around: DataFrame, classes: np.ndarray, many: int) -> np.ndarray:
    """Class bigram counts, from what follows each word."""

    def by_class(batches):
        total = np.zeros(many * many)
        for batch in batches:
            for row in range(batch.num_rows):
                own = classes[unpacked(batch.column(0)[row], np.int32)].astype(np.int64) * many
                each, word, n = (unpacked(batch.column(i)[row], kind) for i, kind in ((1, np.int64), (2, np.int32), (3, np.int64)))
                total += np.bincount(np.repeat(own, each) + classes[word], n, many * many)
        found = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays(
            [pa.array(found), pa.array(total[found].astype(np.int64))], names=["k", "n"]
        )

    rows = around.select("ids", "ak", "a", "an").mapInArrow(by_class, "k long, n long").groupBy("k").agg(F.sum("n").alias("n")).collect()
    flat = np.zeros(many * many)
    for row in rows:
        flat[row["k"]] = row["n"]
    return flat.reshape(many, many)


def _moves(
    around: DataFrame, classes: np.ndarray, transitions: np.ndarray, may_move: np.ndarray, many: int
) -> tuple[np.ndarray, np.ndarray]:
    """The words that move, and their new classes."""

    def best(batches):
        for batch in batches:
            for row in range(batch.num_rows):
                for ids, sides in summed_sides(batch, row):
                    own = classes[ids].astype(np.int64)
                    to, gain = best_classes(sides, own, transitions)
                    go = (gain > 1e-6) & (to != own)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([ids[go].astype(np.int32).tobytes()]), pa.array([to[go].astype(np.int32).tobytes()])],
                        names=["ids", "classes"],
                    )

    def summed_sides(batch: pa.RecordBatch, row: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        ids = unpacked(batch.column(0)[row], np.int32)
        free = may_move[ids]
        place = np.cumsum(free) - 1
        ids, lists = ids[free], []
        for side in (1, 4):
            at, word, n = _neighbours(batch, row, side)
            kept = free[at]
            lists.append((place[at[kept]], classes[word[kept]].astype(np.int64), n[kept]))
        for start in range(0, len(ids), 4_096):
            part = ids[start : start + 4_096]
            sides = np.zeros(len(part) * 2 * many)
            for offset, (at, cls, n) in zip((0, many), lists):
                here = slice(*np.searchsorted(at, (start, start + len(part))))
                sides += np.bincount((at[here] - start) * 2 * many + offset + cls[here], n[here], len(sides))
            yield part, sides.reshape(len(part), -1)

    found = around.mapInArrow(best, "ids binary, classes binary").collect()
    return tuple(np.frombuffer(b"".join(bytes(row[c]) for row in found), np.int32) for c in ("ids", "classes"))


@dataclass(frozen=True)
class Model:
    """Word counts and classes as a table (``word, n, c``), and what is known of classes.

    The driver and the tasks that score hold one byte a word (``classes``, by the word's number).
    """

    counts: DataFrame
    tokens: int
    distinct: int
    most_frequent: int
    units: Units
    classes: np.ndarray
    steps: np.ndarray  # log10 of the transition probabilities
    class_tokens: np.ndarray
    class_words: np.ndarray
    texts: Coded
    numbers: DataFrame  # the words of ``texts``


def fitted(
    texts: DataFrame | Coded, most_units: int = 8_192, many: int = 64, rounds: int | None = None,
    most_frequent: int = 32_768,
) -> Model:
    """The model of all rows of ``text``, or of the training texts among coded ones.

    ``most_units`` words are exchanged before all are, ``most_frequent`` are looked up by tasks.
    """
    if not isinstance(texts, Coded):
        texts = coded(texts.select(F.lit(None).cast("long").alias("doc_id"), "text"))
    with shuffles_dropped(texts.rows.sparkSession):
        ordered = numbered(word_counts(texts))
        totals = ordered.agg(F.sum("n").alias("n"), F.count("*").alias("v")).first()
        tokens, distinct = totals["n"] or 0, totals["v"]
        own = numbers(texts, ordered, most_frequent)
        around = neighbours(own, distinct, tokens)
        classes, transitions = exchanged(around, distinct, many, rounds, most_units)
    steps = np.log10((transitions + _SMOOTHING) / (transitions.sum(axis=1, keepdims=True) + _SMOOTHING * many))

    def of_class(batches):
        for rows in batches:
            own = classes[rows.column("id").to_numpy()].astype(np.int32)
            yield pa.RecordBatch.from_arrays([rows.column("word"), rows.column("n"), pa.array(own)], names=["word", "n", "c"])

    return Model(
        ordered.mapInArrow(of_class, "word string, n long, c int"), tokens, distinct, most_frequent, Units(ordered),
        classes, steps, transitions.sum(axis=0),  # every word follows one
        np.bincount(classes, minlength=many).astype(float), texts, own,
    )


class Walks:
    """log10 of the probability to get from class to class by a number of unseen words."""

    def __init__(self, steps: np.ndarray, emission_of: np.ndarray):
        self.one = 10.0**steps
        unseen = _SMOOTHING / 10.0**emission_of
        self.scale = float(unseen.max())
        self.by_unseen = (unseen / self.scale)[:, None] * self.one
        self.known = {0: steps}

    def by(self, unseen: int) -> np.ndarray:
        if unseen not in self.known:
            longest = max(x for x in self.known if x < unseen)
            walk, top = self.known[longest], 0.0
            for _ in range(unseen - longest):
                top = float(walk.max())
                walk = np.log10(10.0 ** (walk - top) @ self.by_unseen) + top + np.log10(self.scale)
            if len(self.known) < 256:  # longer runs are walked again
                self.known[unseen] = walk
            return walk
        return self.known[unseen]

    def along(self, line: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Of classes one after the other, -1 for unseen words, the first with a class: the places of the
        further words with a class, and what it takes to get to each from the one before."""
        known = np.flatnonzero(line >= 0)
        unseen = np.diff(known) - 1
        from_, to = line[known[:-1]], line[known[1:]]
        found = np.zeros(len(unseen))
        for x in np.unique(unseen):
            found[unseen == x] = self.by(int(x))[from_[unseen == x], to[unseen == x]]
        return known[1:], found


def scored(docs: DataFrame | Coded, model: Model) -> DataFrame:
    """Each row's ``doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score``."""
    texts = docs if isinstance(docs, Coded) else coded(docs, False)
    with shuffles_dropped(texts.rows.sparkSession):
        rows = model.numbers if texts is model.texts else numbers(texts, model.units.numbered, model.most_frequent)
    base_of = float(np.log10(model.tokens + model.distinct + 1))
    emission_of = np.log10(model.class_tokens + _SMOOTHING * (model.class_words + 1))
    walks = Walks(model.steps, emission_of)
    classes = np.append(model.classes.astype(np.int32), np.int32(-1))  # unseen words have the number -1

    def sums(batches):
        for batch in batches:
            for row in range(batch.num_rows):
                doc_id, held, sizes, codes, ids, n = (batch.column(i)[row] for i in range(6))
                sizes, n, own = unpacked(sizes, np.int64), unpacked(n, np.int64), classes[unpacked(ids, np.int32)]
                own[0] = max(own[0], 0)  # the end token is of a class even if no text was seen
                base, emitted = np.log10(n + 1), np.where(own >= 0, np.log10(n + _SMOOTHING) - emission_of[own], 0.0)
                codes, ends = unpacked(codes, np.int32), np.concatenate([[0], np.cumsum(sizes)])
                parts = np.unique(ends // 500_000, return_index=True)[1]  # texts of some words at a time
                for first, last in zip(parts, [*parts[1:], len(sizes)]):
                    if first == last:
                        continue
                    each = sizes[first:last] + 1
                    line = in_line(codes[ends[first] : ends[last]], sizes[first:last])
                    of = np.repeat(np.arange(len(each)), each)  # the texts of the tokens, the first end left out
                    token = line[1:]
                    place, step = walks.along(own[line])
                    score = np.bincount(of, emitted[token], len(each)) + np.bincount(of[place - 1], step, len(each))
                    known = np.bincount(of, n[token] > 0, len(each)).astype(np.int64)
                    at = slice(first, last)
                    yield pa.RecordBatch.from_arrays(
                        [doc_id.values[at], held.values[at], pa.array(each), pa.array(known),
                         pa.array(np.bincount(of, base[token], len(each)) - base_of * each), pa.array(score)],
                        names=["doc_id", "held_out", "n_tokens", "n_known", "base_score", "score"],
                    )

    return (
        rows.select("doc_id", "held_out", "sizes", "codes", "ids", "n")
        .mapInArrow(
            sums, "doc_id long, held_out boolean, n_tokens long, n_known long, base_score double, score double"
        )
        .select("doc_id", "held_out", "n_tokens", "n_known", F.lit(model.tokens).cast("long").alias("train_tokens"),
                "base_score", "score")
    )
