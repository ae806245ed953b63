"""The toxicity chain and the whole pipeline against plain Python."""

import math
import re
import zlib
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from ridegauge.llm import pii, rules, toxicity

SF = "/root/testdata/sf0.001"
CATEGORIES = ("junk", "toxic_prose", "toxic")


def features(text):
    """Every word and its beginnings of four to eight letters, as often as they come."""
    found = Counter()
    for word in re.findall(r"[^\W\d_]+", text.lower()):
        found[word] += 1
        for n in range(4, 9):
            if n < len(word):
                found["^" + word[:n]] += 1
    return found


def memberships(quality, toxic):
    return {"junk": int(quality == 0), "toxic_prose": int(toxic == 1 and quality == 1), "toxic": int(toxic == 1)}


def selected(sample, most):
    """The features that tell a category's documents from the others, as sets of alike ones' longest."""
    names = {}
    for category in CATEGORIES:
        has, everyone = sum(y[category] for _, y in sample), len(sample)
        counts = {}
        for text, y in sample:
            own = features(text)
            for f in [*own, *("2" + f for f, n in own.items() if n > 1)]:
                row = counts.setdefault(f, {"n": 0, **dict.fromkeys(CATEGORIES, 0)})
                row["n"] += 1
                for c in CATEGORIES:
                    row[c] += y[c]
        scored = []
        for f, row in counts.items():
            if row["n"] >= 5 and 0 < has < everyone:
                share = row["n"] / everyone
                spread = math.sqrt(max(share * (1 - share), 1e-6))
                z = abs(row[category] / has - (row["n"] - row[category]) / (everyone - has)) / spread
                scored.append((-z, f))
        for _, f in sorted(scored)[:most]:
            alike = tuple(counts[f].values())
            bare = f.removeprefix("2")
            names[alike] = max(names.get(alike, ""), bare, key=lambda x: (len(x), x))
    return set(names.values())


@pytest.fixture(scope="module")
def labelled(spark):
    docs = {r.doc_id: r.text or "" for r in spark.read.parquet("/root/testdata/sf0.01/documents.parquet").collect()}
    labels = [r for r in spark.read.parquet("/root/testdata/sf0.01/labels.parquet").collect() if r.doc_id in docs]
    return docs, labels


def test_toxicity_chain(spark, labelled):
    docs, labels = labelled
    rows = spark.createDataFrame(list(docs.items()), "doc_id long, text string")
    of = spark.createDataFrame([(r.doc_id, r.quality, r.toxic) for r in labels], "doc_id long, quality int, toxic int")
    chain = toxicity.fitted(rows, of, most_features=40)
    known = sorted((r.doc_id, memberships(r.quality, r.toxic)) for r in labels if None not in (r.quality, r.toxic))
    assert set(chain.places) == selected([(docs[i], y) for i, y in known], 40)

    def row(text):
        own = features(text)
        return [math.log1p(own[f]) for f in sorted(chain.places, key=chain.places.get)]

    x = np.array([row(docs[i]) for i, _ in known], np.float32).astype(float)
    fold = np.arange(len(known)) % toxicity.FOLDS
    for category in CATEGORIES:
        y = np.array([m[category] for _, m in known], float)
        assert chain.weights[category] == pytest.approx(toxicity._logistic(x, y), rel=1e-3, abs=1e-3)
        unseen = np.zeros(len(y))  # a fold's probabilities come from the other folds
        for f in range(toxicity.FOLDS):
            w = toxicity._logistic(x[fold != f], y[fold != f])
            unseen[fold == f] = 1 / (1 + np.exp(-np.clip(x[fold == f] @ w[:-1] + w[-1], -40, 40)))
        x = np.column_stack([x, unseen])

    got = {r.doc_id: r.toxicity for r in toxicity.scored(rows, chain).collect()}
    for i, text in docs.items():
        line = row(text)
        for category in CATEGORIES:
            w = chain.weights[category]
            p = 1 / (1 + math.exp(-max(-40, min(40, float(np.dot(line, w[:-1]) + w[-1])))))
            assert got[i][f"p_{category}"] == pytest.approx(p, rel=1e-6, abs=1e-9)
            line.append(p)


def shingles(text):
    words = (text or "").encode().translate(bytes(c + 32 if 65 <= c <= 90 else c for c in range(256))).split()
    if not words:
        return set()
    return {tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4))}


def groups(texts):
    """The smallest id that each document reaches over pairs of 80 % and more."""
    sets, reach = {i: shingles(t) for i, t in texts.items()}, {i: i for i in texts}

    def find(i):
        while reach[i] != i:
            i = reach[i]
        return i

    ids = sorted(texts)
    for n, a in enumerate(ids):
        for b in ids[n + 1 :]:
            common = len(sets[a] & sets[b])
            if common and 100 * common >= 80 * len(sets[a] | sets[b]):
                x, y = sorted((find(a), find(b)))
                reach[y] = x
    return {i: find(i) for i in ids}


def test_pipeline(spark, monkeypatch):
    """Each stage of a whole run, on what the stage before it has kept."""
    seen, models = [], {}
    for module, name in ((toxicity, "fitted"), (rules, "learned"), (pii, "fitted")):
        def kept(*given, _fit=getattr(module, name), _name=f"{module.__name__}.{name}", **more):
            return models.setdefault(_name, _fit(*given, **more))
        monkeypatch.setattr(module, name, kept)

    def noting(stage):
        def run(spark, docs, folder):
            seen.append({r.doc_id: r for r in docs.collect()})
            return stage(spark, docs, folder)
        return run

    monkeypatch.setattr(corpus_pipeline, "STAGES", [(n, noting(s)) for n, s in corpus_pipeline.STAGES])
    out = corpus_pipeline.run(spark, SF).collect()
    raw, not_toxic, no_junk, single, clean = seen
    chain, listed = models["ridegauge.llm.toxicity.fitted"], models["ridegauge.llm.rules.learned"]

    def toxic(text):
        own = features(text or "")
        line = [math.log1p(own[f]) for f in sorted(chain.places, key=chain.places.get)]
        for w in chain.weights.values():
            line.append(1 / (1 + math.exp(-max(-40, min(40, float(np.dot(line, w[:-1]) + w[-1]))))))
        return line[-1] >= 0.5

    assert set(not_toxic) == {i for i, r in raw.items() if not toxic(r.text)} and len(not_toxic) < len(raw)

    def few_or_repeated(text):
        words = (text or "").encode().split()
        windows = Counter(tuple(words[i : i + 5]) for i in range(len(words) - 4))
        again = {i + j for i in range(len(words) - 4) if windows[tuple(words[i : i + 5])] > 1 for j in range(5)}
        return len(words) < 10 or 100 * len(again) > 20 * len(words)

    passed = {i for i, r in not_toxic.items() if not few_or_repeated(r.text)}
    assert set(no_junk) <= passed and (listed.rules or set(no_junk) == passed)

    component = groups({i: r.text for i, r in no_junk.items()})
    sizes = Counter(component.values())
    assert {component[i] for i in single} == set(sizes) and len(single) == len(sizes) < len(no_junk)

    assert set(clean) == set(single)
    email = re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
    for i, r in clean.items():
        before = single[i].text
        assert not email.search(r.text or "") and r.n_chars == (len(r.text) if r.text != before else single[i].n_chars)
        pattern = "(.+?)".join(map(re.escape, re.split("<(?:EMAIL|IP|CARD|PHONE|SECRET)>", r.text or "")))
        assert re.fullmatch(pattern, before or "", re.S), i
    assert any(r.text != single[i].text for i, r in clean.items())

    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    ids = {i: tokenizer.encode(r.text or "", add_special_tokens=False).ids + [0] for i, r in clean.items()}
    filled, covered = {}, Counter()
    for r in out:
        part = np.array(ids[r.doc_id][r.start : r.start + r.length], "<u4").tobytes()
        assert len(part) == 4 * r.length and zlib.crc32(part) == r.ids_crc32
        filled.setdefault(r.sequence_id, []).append((r.offset, r.length))
        covered[r.doc_id] += r.length
    assert covered == {i: len(own) for i, own in ids.items()}
    for own in filled.values():
        end = 0
        for offset, length in sorted(own):
            assert offset == end
            end += length
        assert end <= 2048
