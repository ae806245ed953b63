"""What the class bigrams write, and scores of texts that lie in several chunks."""

import zlib

import numpy as np
import pytest

from ridegauge.llm import brown

SCHEMA = "doc_id long, text string"


def test_brown_writes_no_row_for_each_pair(spark, monkeypatch):
    draw = np.random.default_rng(5)
    ranks = np.minimum(draw.zipf(1.5, 60_000), 10**6)
    texts = [" ".join(f"w{x}" for x in ranks[at : at + 300]) for at in range(0, len(ranks), 300)]
    docs = spark.createDataFrame(list(enumerate(texts)), SCHEMA)
    rows, written = {}, brown.written

    def counted(df, purpose):
        found = written(df, purpose)
        rows[purpose] = found.count()
        return found

    monkeypatch.setattr(brown, "written", counted)
    assert brown.scored(docs, brown.fitted(docs, rounds=0)).count() == len(texts)
    assert sum(rows.values()) < len(set(ranks)) + len(texts)


def plain_score(text, counts, model):
    """log10 of the probability by the forward recursion over classes."""
    held = model.class_tokens + 0.5 * (model.class_words + 1)
    to = 10.0 ** model.steps
    words = [w.decode() for w in (text or "").encode().lower().split()]
    at, score = np.eye(len(to))[counts["\n"][1]], 0.0
    for word in [*words, "\n"]:
        n, c = counts.get(word, (0, None))
        at = at @ to * (n + 0.5) / held
        if c is not None:
            at = at * np.eye(len(to))[c]
        score += np.log10(at.sum())
        at = at / at.sum()
    return score


@pytest.mark.parametrize("most_tokens", [1, 70, 10**6])
def test_brown_scores_in_chunks(spark, most_tokens):
    draw = np.random.default_rng(2)
    texts = [" ".join(f"W{x}" for x in draw.zipf(1.6, draw.integers(1, 40))) for _ in range(60)]
    texts += [None, "", " \t", "\x0bnew New  w1 \r\n never w2 seen\x0c", "É é   w1"]
    rows = [*enumerate(texts), (None, "w1 w2"), (7, "again w1"), (7, "again w1")]
    docs = spark.createDataFrame(rows, SCHEMA).repartition(3)
    learned = [text for i, text in rows if zlib.crc32(str(i).encode()) % 7 != 2 or i is None]
    coded = brown.coded(docs, ~brown.held_out(), most_tokens)
    model = brown.fitted(coded, most_units=6, many=4, rounds=6, most_frequent=5)
    counts = {r["word"]: (r["n"], r["c"]) for r in model.counts.collect()}
    words = [w.decode() for text in learned for w in [*(text or "").encode().lower().split(), b"\n"]]
    assert model.tokens == len(words) and {w: n for w, (n, _) in counts.items()} == {w: words.count(w) for w in set(words)}
    known = [sum(n for n, c in counts.values() if c == own) for own in range(4)]
    assert list(model.class_tokens) == known
    expected = sorted((str(i), plain_score(text, counts, model)) for i, text in rows)
    for table in (coded, docs):
        found = sorted((str(r["doc_id"]), r["score"]) for r in brown.scored(table, model).collect())
        assert [i for i, _ in found] == [i for i, _ in expected]
        assert [s for _, s in found] == pytest.approx([s for _, s in expected], rel=1e-9)


def test_brown_without_training_texts(spark):
    docs = spark.createDataFrame([(1, "a b"), (2, None)], SCHEMA)
    model = brown.fitted(docs.filter("false"))
    found = {r["doc_id"]: r for r in brown.scored(docs, model).collect()}
    assert model.tokens == model.distinct == 0 and not found[1]["n_known"]
    assert found[1]["n_tokens"] == 3 and found[1]["base_score"] == found[2]["base_score"] == 0
    assert found[1]["score"] == pytest.approx(found[2]["score"]) and found[2]["score"] < 0
