"""Spelling variants against all pairs, on small vocabularies."""

import re
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from ridegauge.llm import variants
from ridegauge.llm.queries import QUERIES

SF = "/root/testdata/sf0.001"


def is_near(a, b):
    if abs(len(a) - len(b)) > 1 or a == b:
        return False
    if len(a) > len(b):
        a, b = b, a
    at = next((i for i, (x, y) in enumerate(zip(a, b)) if x != y), len(a))
    return a[at + 1:] == b[at + 1:] if len(a) == len(b) else a[at:] == b[at + 1:]


def words_of(rows):
    found = Counter()
    for doc_id, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = "".join(c.lower() if "A" <= c <= "Z" else c for c in run)
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
            if h % 97 == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1:]
            found[run] += 1
    return found


def near_lists(words):
    """Neighbours by trying every edit, which is the same as all pairs and takes less time."""
    letters = sorted(set("".join(words)))
    for w in words:
        edits = {w[:i] + w[i + 1:] for i in range(len(w))}
        edits |= {w[:i] + c + w[i:] for i in range(len(w) + 1) for c in letters}
        edits |= {w[:i] + c + w[i + 1:] for i in range(len(w)) for c in letters}
        yield w, {e for e in edits if e in words and e != w}


def expected(counts):
    words = {w: n for w, n in counts.items() if len(w) >= 5 and n >= 3}
    forms, near = {}, dict(near_lists(words))
    for w, others in near.items():
        best = min(others, key=lambda o: (-words[o], o), default=None)
        forms[w] = best if best is not None and words[best] >= 2 * words[w] else None
    rows = set()
    for w, n in words.items():
        root = w
        while forms[root] is not None:
            root = forms[root]
        rows.add((w, forms[w], root, n, len(near[w]), words.get(forms[w])))
    return rows


def rows_of(df):
    rows = df.collect()
    found = {(r.word, r.form, r.root, r.n, r.n_near, r.form_n) for r in rows}
    assert len(found) == len(rows)
    return found


def test_brute_force_edits_are_all_pairs():
    draw = np.random.default_rng(5)
    words = {"".join(draw.choice(list("aab"), draw.integers(1, 6))): 1 for _ in range(200)}
    for w, others in near_lists(words):
        assert others == {o for o in words if is_near(w, o)}


@pytest.mark.parametrize("folder", [SF, "/root/testdata/sf0.01"])
def test_query(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "text").collect()
    want = expected(words_of(docs))
    assert rows_of(QUERIES["op11_permuterm_variants"](spark, folder)) == want
    assert sum(r[1] is not None for r in want) > 20 and any(r[1] not in (None, r[2]) for r in want)


@pytest.mark.parametrize("seed", range(3))
def test_dense_words(spark, seed):
    draw = np.random.default_rng(seed)
    words = {"".join(draw.choice(list("abé"), draw.integers(5, 8))) for _ in range(400)}
    words |= {60 * "ab" + "".join(draw.choice(list("aé"), draw.integers(1, 5))) + 30 * "é" for _ in range(30)}
    counts = {w: int(2 ** draw.integers(2, 9) + draw.integers(0, 2)) for w in words}
    rows = spark.createDataFrame(list(counts.items()), "word string, n long")
    found = variants.with_forms(rows)
    assert rows_of(found) == expected(counts)


def test_long_chain(spark):
    counts = {"abcde" + "xyzuvwst"[:i] * (i > 0): 3 * 4 ** (8 - i) for i in range(9)}
    rows = spark.createDataFrame(list(counts.items()), "word string, n long")
    found = rows_of(variants.with_forms(rows))
    assert found == expected(counts) and {r[2] for r in found} == {"abcde"}


def test_awkward(spark):
    rows = [
        (1, None), (2, ""), (None, "hello hello hello Hallo HALLO hallo"), (3, "hello Äpfel äpfel Äpfel Äpfel"),
        (3, "hello Äpfel äpfel Äpfel Äpfel"), (4, "abc ab×c1 under_score under-score " * 5000),
        (5, "z" * 3000), (6, "z" * 3000), (7, "z" * 2999), (8, "z" * 3000), (8, "z" * 2999), (9, "q" * 500_000),
        (9, "hello\u0000hello ıstanbul Kelvin ßÿþ÷× " * 3),
    ]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    for name in ("word", "run", "id", "h", "n", "prefix", "near", "best", "root", "form", "at", "next", "moves"):
        docs = docs.withColumn(name, F.lit("x"))
    got = rows_of(variants.spelling_groups(docs, least_length=4, least_count=2))
    counts = words_of(rows)
    assert {(r[0], r[3]) for r in got} == {(w, n) for w, n in counts.items() if len(w) >= 4 and n >= 2}
    by_word = {r[0]: r for r in got}
    assert by_word["z" * 3000][1:3] == (None, "z" * 3000) and by_word["z" * 2999][4] == 1
    assert by_word["hello"][4] == ("hallo" in by_word) + sum(is_near("hello", w) for w in by_word if w != "hallo")


def test_empty(spark):
    none = spark.createDataFrame([], "doc_id long, text string")
    assert variants.spelling_groups(none).collect() == []
    assert variants.spelling_groups(spark.createDataFrame([(1, None)], "doc_id long, text string")).collect() == []
