"""Spelling variants: words that differ by one inserted, deleted or replaced character.

A word with a terminator at its end is turned to all its rotations.  A rotation that begins behind
character i ends with it, so what is before that character - the rotation without the edited one - is a
prefix that the word shares with every word that has another character there (a replacement), and that
is the whole of a rotation of the word without it (an indel).  Sorted by that prefix, a range holds one
rotation per character of the alphabet at most, besides the word that lacks it.  The scan of a range
gives each of its words the number of its neighbours there and the best one; no pair is written.

Of a run of equal characters any may be the inserted one; the first of the run stands for all, so that
each near pair meets in one range only and counts add up.

A word's form is its most frequent near word (then the smallest in code-point order), if that one is at
least ``times`` as frequent.  Frequencies grow along forms, so following them ends; roots are found by
doubling: each round every word that still moves jumps to where its target points, and only such words
are joined again.

Words are numbered in code-point order, so that ranges carry numbers and compare as words do.  A
prefix longer than 64 characters is known by its SHA-256, so a long word costs each of its ranges
no more memory or shuffle than a short one; only time grows with the square of a word's length.

Null texts hold no word.  A null id counts as an empty one.  Texts of any length are cut in whole, and
words may have any length.  Repeated rows count as often as they come.  No words give no rows.  Only
the id and the text are read, so other columns may have any name.
"""

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ridegauge.session import written

RUN = "[A-Za-zÀ-ÿ]+"
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_END = "\x00"  # the terminator: in no word, and before every character
_LONG = 64


def _without(word: Column, place: Column) -> Column:
    """``word`` without the code point at ``place``, from 0."""
    return F.concat(F.substring(word, F.lit(1), place), F.substring(word, place + 2, F.length(word)))


def typed_words(docs: DataFrame, one_in: int = 97) -> DataFrame:
    """``word``: every run of letters, lower-cased.  In one of ``one_in``, which id and run decide, a letter is missing."""
    runs = F.explode(F.regexp_extract_all(F.col("text"), F.lit(f"({RUN})"), F.lit(1)))
    cut = docs.select(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).alias("id"), runs.alias("run"))
    cut = cut.select("id", F.translate("run", _UPPER, _LOWER).alias("run"))
    hashed = cut.select("run", F.crc32(F.concat_ws(":", "id", "run")).alias("h"))
    place = F.pmod(F.col("h"), F.length("run")).cast("int")
    return hashed.select(F.when(F.col("h") % one_in == 0, _without(F.col("run"), place)).otherwise(F.col("run")).alias("word"))


def counted(words: DataFrame, least_length: int = 5, least_count: int = 3) -> DataFrame:
    """``word, n`` of the words that are long and frequent enough."""
    counts = words.filter(F.length("word") >= least_length).groupBy("word").agg(F.count(F.lit(1)).alias("n"))
    return counts.filter(F.col("n") >= least_count)


def numbered(words: DataFrame) -> DataFrame:
    """``words`` with ``id``, which grows with the word in code-point order; to be written before use."""
    return words.repartitionByRange("word").sortWithinPartitions("word").withColumn("id", F.monotonically_increasing_id())


def rotations(words: DataFrame) -> DataFrame:
    """``prefix, id, n, kind``: the ranges of each word.

    ``kind`` is 0 where the prefix is the word's rotation in whole, 1 where it skips the last character,
    and 2 where it does so but an equal character comes before that one.
    """
    word, length, i = F.col("word"), F.length("word"), F.col("place")
    placed = words.select("id", "n", "word", F.explode(F.sequence(F.lit(0), length)).alias("place"))
    head, tail = F.substring(word, F.lit(1), i), F.substring(word, i + 1, length)
    repeats = (i > 0) & (F.substring(word, i, F.lit(1)) == F.substring(word, i + 1, F.lit(1)))
    whole = F.struct(F.concat(tail, F.lit(_END), head).alias("prefix"), F.lit(0).cast("byte").alias("kind"))
    skipping = F.struct(
        F.concat(F.substring(word, i + 2, length), F.lit(_END), head).alias("prefix"),
        F.when(repeats, 2).otherwise(1).cast("byte").alias("kind"),
    )
    turned = placed.select("id", "n", F.explode(F.when(i < length, F.array(whole, skipping)).otherwise(F.array(whole))).alias("r"))
    prefix = F.col("r.prefix")
    known = F.when(F.length(prefix) > _LONG, F.sha2(prefix, 256)).otherwise(prefix)
    return turned.select(known.alias("prefix"), "id", "n", F.col("r.kind").alias("kind"))


def scanned(turned: DataFrame) -> DataFrame:
    """``id, n, near, best`` for each word and range: its neighbours there, and the best as ``(less, id)``.

    A range has one entry per character at most, so what is collected is bounded by the alphabet.
    Entries are put in order of falling frequency, so the first neighbour is the best one.
    """
    entry = F.struct((-F.col("n")).alias("less"), F.col("id"), F.col("kind"))
    ranges = turned.groupBy("prefix").agg(F.array_sort(F.collect_list(entry)).alias("entries"))
    ranges = ranges.filter(F.size("entries") > 1).select("entries")

    def near(own: Column) -> Column:
        """Two that skip a character are a replacement; an indel needs the first of a run."""
        def meets(other: Column) -> Column:
            indel = (own["kind"] == 0) | (other["kind"] == 0)
            return F.when(indel, own["kind"] + other["kind"] == 1).otherwise(own["id"] != other["id"])
        return F.filter("entries", meets)

    found = F.transform("entries", lambda e: F.struct(e["id"].alias("id"), (-e["less"]).alias("n"), near(e).alias("others")))
    each = ranges.select(F.inline(found).alias("id", "n", "others")).filter(F.size("others") > 0)
    top = F.col("others")[0]
    best = F.struct(top["less"].alias("less"), top["id"].alias("id")).alias("best")
    return each.select("id", "n", F.size("others").cast("long").alias("near"), best)


def neighbours(words: DataFrame, times: int = 2) -> DataFrame:
    """``id, n_near, form_id, form_n`` of the words (``id, word, n``) that have a near word."""
    met = scanned(rotations(words)).groupBy("id").agg(
        F.first("n").alias("n"), F.sum("near").alias("n_near"), F.min("best").alias("best")
    )
    fits = -F.col("best.less") >= times * F.col("n")
    return met.select(
        "id", "n_near", F.when(fits, F.col("best.id")).alias("form_id"), F.when(fits, -F.col("best.less")).alias("form_n")
    )


def roots(forms: DataFrame) -> DataFrame:
    """``id, root_id``, where following ``form_id`` ends, of each row of ``forms``.

    After round r a word has gone 2^r forms far, and a chain is no longer than its last word's
    frequency has bits.  Each round reads what the rounds before have written.
    """
    moving = written(forms.select("id", F.col("form_id").alias("at")), "word-steps")
    jumps, ended = moving, []
    while not moving.isEmpty():
        onward = jumps.select(F.col("id").alias("at"), F.col("at").alias("next"))
        step = written(moving.join(onward, "at", "left").select("id", "at", "next"), "word-jumps")
        ended.append(step.filter("next IS NULL").select("id", "at"))
        moving = step.filter("next IS NOT NULL").select("id", F.col("next").alias("at"))
        jumps = reduce(DataFrame.unionByName, ended, moving)
    return reduce(DataFrame.unionByName, ended, moving).select("id", F.col("at").alias("root_id"))


def with_forms(words: DataFrame, times: int = 2) -> DataFrame:
    """``word, form, root, n, n_near, form_n`` of each of ``words`` (``word, n``, each word once)."""
    words = written(numbered(words), "words")
    near = written(neighbours(words, times), "neighbours")
    forms = near.filter("form_id IS NOT NULL").select("id", "form_id")

    def named(rows: DataFrame, which: str) -> DataFrame:
        names = words.select(F.col("id").alias(f"{which}_id"), F.col("word").alias(which))
        return rows.join(names, f"{which}_id").drop(f"{which}_id")

    chains = named(named(forms.join(roots(forms), "id"), "form"), "root")
    whole = words.join(near.drop("form_id").join(chains, "id", "left"), "id", "left")
    return whole.select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n",
        F.coalesce("n_near", F.lit(0).cast("long")).alias("n_near"), "form_n",
    )


def spelling_groups(docs: DataFrame, least_length: int = 5, least_count: int = 3, times: int = 2) -> DataFrame:
    """``word, form, root, n, n_near, form_n`` of every long and frequent enough word of ``docs``."""
    return with_forms(counted(typed_words(docs), least_length, least_count), times)
