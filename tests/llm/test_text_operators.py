"""The text operators against brute force, on small tables and on awkward rows."""

import hashlib
import math
import re
import zlib
from collections import Counter

import duckdb
import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from ridegauge.llm import bpe, brown, html, minhash, packing, pii, rules, topk, toxicity, warc
from ridegauge.llm.queries import QUERIES, SQL

SF = "/root/testdata/sf0.001"
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, kind string, row long, key string"
AWKWARD = [
    (1, None, None, None, None, "x", 1, "k"), (2, "", "en", "s", 0, None, None, None),
    (3, "one", "en", "s", 3, "x", 1, "k"), (3, "one", "en", "s", 3, "x", 1, "k"),
    (None, "Mail me: a@b.org or +1 (499) 555-6503 now", None, None, 9, "y", 2, "k"),
    (4, "word " * 30_000, "en", "s", 150_000, "x", 1, "k"),
    (5, "a" * 50_000 + "1" * 50_000, "en", "s", 100_000, "x", 1, "k"),
    (6, "A b\tc\n\x0b d é 😀 <|endoftext|> 4111111111111111 1.2.3.4", "en", "s", 1, "x", 1, "k"),
]


@pytest.fixture(scope="module")
def awkward(spark):
    return spark.createDataFrame(AWKWARD, SCHEMA)


@pytest.fixture(scope="module")
def labels(spark):
    return spark.createDataFrame(
        [(1, 0, 0), (2, 1, None), (3, 0, 1), (3, 1, 0), (None, 1, 1), (4, 0, 0), (6, 1, 0)],
        "doc_id long, quality int, toxic int",
    )


@pytest.fixture(scope="module")
def docs(spark):
    return spark.read.parquet(f"{SF}/documents.parquet")


def tokens(text):
    return (text or "").encode().lower().split()


@pytest.mark.parametrize("name", sorted(SQL))
def test_sql(spark, name):
    found = QUERIES[name](spark, SF)
    database = duckdb.connect()
    for table in ("documents", "embeddings", "pages"):
        database.execute(f"CREATE VIEW {table} AS SELECT * FROM '{SF}/{table}.parquet'")
    cursor = database.execute(SQL[name])
    places = {column[0]: i for i, column in enumerate(cursor.description)}
    columns = sorted(found.columns)
    expected = sorted((tuple(row[places[c]] for c in columns) for row in cursor.fetchall()), key=repr)
    assert sorted((tuple(row[c] for c in columns) for row in found.collect()), key=repr) == expected


def test_brown(spark, docs):
    rows = docs.collect()
    training = [r for r in rows if zlib.crc32(str(r.doc_id).encode()) % 7 != 2]
    counts = Counter(t for r in training for t in [*tokens(r.text), b"\n"])
    n, v = sum(counts.values()), len(counts)
    found = {r.doc_id: r for r in QUERIES["op1_brown_scoring"](spark, SF).collect()}
    assert len(found) == len(rows)
    for r in rows:
        own = [*tokens(r.text), b"\n"]
        got = found[r.doc_id]
        assert (got.n_tokens, got.n_known) == (len(own), sum(t in counts for t in own))
        assert got.train_tokens == n
        assert got.held_out == (zlib.crc32(str(r.doc_id).encode()) % 7 == 2)
        expected = sum(math.log10((counts[t] + 1) / (n + v + 1)) for t in own)
        assert got.base_score == pytest.approx(expected, rel=1e-9)
    unseen = [r for r in found.values() if r.held_out]
    assert sum(r.score for r in unseen) > sum(r.base_score for r in unseen)


def test_brown_is_a_distribution(spark):
    texts = spark.createDataFrame([(1, "a b a c"), (2, "b a"), (3, "c c d")], "doc_id long, text string")
    model = brown.fitted(texts, most_units=3, many=4, rounds=2, most_frequent=2)
    following = 10.0 ** model.steps
    assert following.sum(axis=1) == pytest.approx(np.ones(4))
    words = {r["word"].encode(): r["n"] for r in model.counts.collect()}
    for c in range(4):
        own = [n for w, n in words.items() if model.classes[model.units.of(w)] == c]
        whole = model.class_tokens[c] + 0.5 * (model.class_words[c] + 1)
        assert sum(n + 0.5 for n in own) + 0.5 == pytest.approx(whole)


def test_brown_exchanges_every_word(spark):
    draw = np.random.default_rng(3)
    kinds = [[f"{c}{i}{'xyz'[i % 3]}same" for i in range(30)] for c in "pqrs"]
    texts = [" ".join(draw.choice(kinds[j % 4]) for j in range(40)) for _ in range(150)]
    rows = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    model = brown.fitted(rows, most_units=20, many=5, most_frequent=10)
    classes = {r["word"]: r["c"] for r in model.counts.collect()}
    own = [{classes[w] for w in kind if w in classes} for kind in kinds]
    assert all(len(c) == 1 for c in own) and len(set.union(*own)) == 4


def test_brown_gain_is_that_of_the_likelihood():
    draw = np.random.default_rng(8)
    counts = draw.poisson(0.7, (12, 12)).astype(float)
    np.fill_diagonal(counts, 0)  # a unit next to itself is counted approximately
    classes = draw.integers(0, 4, 12)

    def transitions(classes):
        one = np.eye(4)[classes]
        return one.T @ counts @ one

    sides = np.hstack([counts.T @ np.eye(4)[classes], counts @ np.eye(4)[classes]])
    to, gain = brown.best_classes(sides, classes, transitions(classes))
    for unit in range(12):
        moved = []
        for c in range(4):
            other = classes.copy()
            other[unit] = c
            moved.append(brown._likelihood(transitions(other)) - brown._likelihood(transitions(classes)))
        assert gain[unit] == pytest.approx(max(moved)) and moved[to[unit]] == pytest.approx(max(moved))


def base_spans(text):
    found = [("email", m.span()) for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", text)]
    found += [("ip", m.span()) for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", text)
              if all(int(x) <= 255 for x in m[0].split("."))]
    for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", text):
        digits = [int(c) for c in m[0] if c.isdigit()][::-1]
        doubled = sum(d if i % 2 == 0 else 2 * d - 9 * (d > 4) for i, d in enumerate(digits))
        if 13 <= len(digits) <= 19 and doubled % 10 == 0:
            found.append(("card", m.span()))
    found += [("phone", m.span()) for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", text)
              if 9 <= sum(c.isdigit() for c in m[0]) <= 15]
    return found


def test_pii_base_spans(spark, docs):
    mixed = ["a", "b1", "@", ".", "-", "+", "1", "23", " ", "(", "4111111111111111", "é", "x@y.zz", "_", "1.2.3.4", "😀"]
    draw = np.random.default_rng(5)
    texts = ["".join(draw.choice(mixed, draw.integers(0, 30))) for _ in range(400)]
    texts += [r.text for r in docs.collect()] + [None, "", "x@y.zz," * 500, "1" * 40_000]
    rows = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r.doc_id: r for r in pii.spans(rows).select("doc_id", *(c.alias(k) for k, c in pii.summary().items())).collect()}
    for i, text in enumerate(texts):
        listed = ",".join(f"{kind}:{a}:{b}" for kind, (a, b) in base_spans(text or ""))
        assert got[i].base_sha256 == hashlib.sha256(listed.encode()).hexdigest(), text
        assert set(filter(None, listed.split(","))) <= set(got[i].spans.split(","))


def test_pii_masks(spark, awkward):
    model = pii.fitted(pii.detected(awkward))
    out = pii.masked(awkward, model)
    assert out.schema == awkward.schema
    masked = {r.doc_id: r.text for r in out.collect()}
    assert masked[None] == "Mail me: <EMAIL> or <PHONE> now"
    assert masked[6].endswith("<CARD> <IP>") and masked[1] is None


def test_pii_long_secrets(spark):
    keys = ["".join(f"{chr(97 + (i + j) % 26)}{j % 10}" for j in range(n)) for i, n in enumerate((20, 150, 800, 3_000))]
    texts = [f"the config says token={key} and no more" for key in keys]
    rows = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r.doc_id: r.spans for r in pii.spans(rows).select("doc_id", *(c.alias(k) for k, c in pii.summary().items())).collect()}
    assert got == {i: f"secret:16:{22 + len(key)}" for i, key in enumerate(keys)}
    masked = {r.doc_id: r.text for r in pii.masked(rows, pii.fitted(pii.detected(rows))).collect()}
    assert set(masked.values()) == {"the config says <SECRET> and no more"}


def test_rules(spark, docs):
    got = {r.doc_id: r for r in QUERIES["op3_quality_rules"](spark, SF).collect()}
    for r in docs.collect():
        text = r.text or ""
        words = re.findall(r"[^\x20\x09-\x0D]+", text)
        windows = [tuple(words[i : i + 5]) for i in range(len(words) - 4)]
        times = Counter(windows)
        again = {j for i, w in enumerate(windows) if times[w] > 1 for j in range(i, i + 5)}
        lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
        failed = len(words) < 10 or 100 * len(again) > 20 * len(words)
        one = got[r.doc_id]
        assert (one.n_words, one.word_chars, one.n_symbols, one.n_dup_lines, one.n_repeat_words, one.base_failed) == (
            len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)),
            len(lines) - len(set(lines)), len(again), failed,
        )
        assert not (failed and one.kept)


def test_decision_list_finds_a_conjunction():
    draw = np.random.default_rng(1)
    values = {name: draw.random(3000) for name in rules.FEATURES}
    bad = (values["symbol_share"] >= 0.5) & (values["upper_share"] < 0.3)
    found = rules.learn(values, bad)
    covered = np.zeros(3000, bool)
    for rule in found.rules:
        covered |= rules._covered(rule, values)
    assert (covered == bad).mean() > 0.98


def test_near_copies_of_awkward_rows(awkward):
    got = {(r.doc_id, r.n_shingles): (r.component_id, r.kept) for r in minhash.near_copies(awkward, 4).collect()}
    assert got[1, 0] == (1, True) and got[2, 0] == (2, True)
    assert got[3, 1] == (3, True) and got[4, 1] == (4, True)
    assert got[None, 5] == (None, True)
    kept = minhash.without_near_copies(awkward, 4)
    assert kept.columns == awkward.columns and kept.filter("doc_id = 3").count() == 1


def test_near_copies_chain(spark):
    base = [f"w{i}" for i in range(300)]
    chain = [base[:300 - i] + [f"x{j}" for j in range(i)] for i in range(0, 120, 12)]
    rows = [(90 - i, " ".join(t)) for i, t in enumerate(chain)] + [(5, "quite another text of its own")]
    got = {r.doc_id: r.component_id for r in minhash.near_copies(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got == {5: 5, **{90 - i: 81 for i in range(10)}}


def test_near_copies_of_a_repeated_id(spark):
    def text(name, changed=0):
        return " ".join([f"{name}{i}" for i in range(200 - changed)] + [f"z{name}{i}" for i in range(changed)])

    rows = [(1, text("a")), (1, text("b")), (2, text("a", 10)), (3, text("b", 10)), (4, text("a", 80)), (5, text("c"))]
    got = {r.doc_id: r.component_id for r in minhash.near_copies(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got == {1: 1, 2: 1, 3: 1, 4: 4, 5: 5}


def test_topk_gives_k_rows_per_query_and_slot(spark, monkeypatch):
    draw = np.random.default_rng(4)
    x = np.int64(draw.normal(0, 40, (3000, 8)))
    vectors = spark.createDataFrame([(i, row.tolist()) for i, row in enumerate(x)], "vec_id long, x array<long>")
    queries = vectors.filter("vec_id % 30 = 0")
    monkeypatch.setattr(topk, "BLOCK", 64)
    monkeypatch.setattr(topk, "QUERY_BLOCK", 16)
    monkeypatch.setattr(topk, "SLOTS", 4)
    found = topk.top_k(vectors, queries, k=5, seeds=1)
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    assert "MapInPandas" in plan
    scores = x[::30] @ x.T
    scores[np.arange(100), np.arange(0, 3000, 30)] = -10**9
    expected = {
        (30 * q, r + 1, int(v), int(scores[q][v]))
        for q in range(100) for r, v in enumerate(np.lexsort((np.arange(3000), -scores[q]))[:5])
    }
    assert {tuple(r) for r in found.collect()} == expected


def test_top_k_leaves_out_what_cannot_take_part(spark):
    rows = [(0, [1.0, 0.0]), (20, None), (1, [0.5, None]), (2, [float("nan"), 1.0]), (3, [2.0, 1.0]), (4, [2.0, -1.0]), (4, [2.0, -1.0])]
    vectors = topk.whole_components(spark.createDataFrame(rows, "vec_id long, embedding array<float>"))
    got = topk.top_k(vectors, vectors.filter("vec_id % 20 = 0"), k=2).collect()
    assert sorted(tuple(r) for r in got) == [(0, 1, 3, 64 * 128), (0, 2, 4, 64 * 128)]


def test_html_blocks():
    page = (
        "<head><title>t</title></head><body><nav><p>menu</p></nav><article><h1>A &amp; B</h1><p><b>one<br>two <p>three"
        "<script>var t='</p>'</script><div class=ad>buy</div><ul><li>x</ul><section id=comments><p>nice</section></article><footer>f"
    )
    assert html.blocks(page) == (["A & B", "one two", "three", "x"], True)
    assert html.blocks("") == ([], False)


@pytest.mark.parametrize("wrapper", [
    "<div class='layout has-sidebar'><main>", "<div id='page' class='sidebar-right'><article>",
    "<section class='search-result'><div role=main>", "<div class='post share-enabled'><div>",
])
def test_html_wrapper(wrapper):
    rest = "<div class=sidebar><p>more</div><section id=comments><article>a comment, longer than the text of the page</section>"
    page = f"<body>{wrapper}<p>The text of<p>this page<div class=ad>buy</div></div></div></main>"
    assert html.blocks(page)[0] == ["The text of", "this page"]
    assert html.blocks(page.replace("<p>this", f"{rest}<p>this"))[0] == ["The text of", "this page"]


def test_html_repetition(spark):
    notice = " ".join(f"n{i}" for i in range(12))
    pages = [(i, "https://h.example/x", f"<body><div>{notice}</div><div>own {i} text</div></body>") for i in range(3)]
    pages += [(9, None, None), (8, "https://o.example/", f"<body><div>{notice}</div></body>")]
    got = {r.page_id: (r.text, r.n_chars) for r in html.extracted(spark.createDataFrame(pages, "page_id long, url string, html string")).collect()}
    assert got[1] == ("own 1 text", 10) and got[9] == ("", 0) and got[8][0] == notice


def texts_of(spark, pages):
    rows = spark.createDataFrame(pages, "page_id long, url string, html string")
    return {r.page_id: r.text for r in html.extracted(rows).collect()}


def test_html_repetition_in_articles(spark):
    notice = " ".join(f"n{i}" for i in range(12))
    own = {i: " ".join(f"w{i}x{j}" for j in range(40)) for i in range(8)}
    pages = [
        (i, "https://h.example/x", f"<article><p>{text}</p><p>{notice}</p></article><p>after {i}</p>")
        for i, text in own.items()
    ]
    assert texts_of(spark, pages) == {i: f"{text}\n\nafter {i}" for i, text in own.items()}


def test_html_repetition_keeps_what_is_not_boilerplate(spark):
    notice, quote = (" ".join(f"{c}{i}" for i in range(12)) for c in "nq")
    own = {i: " ".join(f"w{i}x{j}" for j in range(60)) for i in range(16)}
    own |= {i: f"{own[i]} {quote}" for i in (3, 5)}
    own |= {i: " ".join([*own[0].split()[:30], f"other{i}", *own[0].split()[31:]]) for i in range(16, 24)}
    pages = [
        (i, "https://h.example/x", f"<div>own {i} text</div><div>{notice}</div><p>{text}</p>") for i, text in own.items()
    ]
    assert texts_of(spark, pages) == {i: f"own {i} text\n\n{text}" for i, text in own.items()}


@pytest.mark.parametrize("part", [html.PART, 2_000])
def test_html_against_brute_force(spark, monkeypatch, part):
    monkeypatch.setattr(html, "PART", part)
    draw = np.random.default_rng(4)
    stock = [" ".join(f"s{i}n{j}" for j in range(n)) for i, n in enumerate((6, 8, 9, 15, 30))]
    pages = []
    for i in range(90):
        body = []
        for _ in range(draw.integers(0, 5)):
            words = [" ".join(f"w{x}" for x in draw.integers(0, 300, draw.integers(1, 30)))]
            words += [stock[x] for x in np.flatnonzero(draw.random(5) < (0.1, 0.3, 0.3, 0.15, 0.05))]
            body.append(" ".join(draw.permutation(words)))
        inside = draw.random(len(body)) < 0.5
        pages.append((i, f"http://h{int(i % 7 // 3)}.example/", "".join(
            f"<main><p>{b}</p></main>" if m else f"<p>{b}</p>" for b, m in zip(body, inside))))
    pages += [(100 + i, url, page) for i, url, page in pages[:9]]
    cut = {i: (url, html.marked_blocks(page)) for i, url, page in pages}
    having, sketched = {}, {}
    for url, page in cut.values():
        whole, rest = html.sketches(*html._tokens([text for text, _ in page]))
        for j in range(html.SKETCHES):
            sketched.setdefault((url, j), set()).add(int(whole[j]))
            for b, (text, _) in enumerate(page):
                for k in range(len(text.split()) - 7):
                    having.setdefault((url, tuple(text.split()[k : k + 8]), j), set()).add(int(rest[b, j]))
    expected, gone = {}, 0
    for i, (url, page) in cut.items():
        of_host = max(len(sketched[url, j]) for j in range(html.SKETCHES))
        left = []
        for text, mark in page:
            words, cover = text.split(), set()
            for k in range(len(words) - 7):
                n = min(len(having[url, tuple(words[k : k + 8]), j]) for j in range(html.SKETCHES))
                if n >= max(3, (0.5 if mark else 0.2) * of_host):
                    cover |= set(range(k, k + 8))
            gone += len(cover)
            left.append(" ".join(w for k, w in enumerate(words) if k not in cover))
        expected[i] = "\n\n".join(filter(None, left))
    assert gone > 100
    assert texts_of(spark, pages) == expected


@pytest.mark.parametrize("part", [100, 3000, 1_000_000])
def test_html_parts_do_not_change_the_text(spark, monkeypatch, part):
    """Parts of a page each, of some pages, and one part name the same boilerplate, and little else."""
    monkeypatch.setattr(html, "PART", part)
    draw = np.random.default_rng(9)
    notice = " ".join(f"n{i}" for i in range(12))
    own = [" ".join(f"w{x}" for x in draw.integers(0, 10**6, 60)) for _ in range(40)]
    pages = [(i, "https://h.example/x", f"<p>{text}</p><p>{notice}</p>") for i, text in enumerate(own)]
    copies = [(100 + i, "https://c.example/", f"<p>{own[0]} {i}</p><p>{notice}</p><p>{own[i % 4]}</p>") for i in range(40)]
    named, before = [], html.written
    monkeypatch.setattr(html, "written", lambda df, purpose: before(df, purpose) if purpose != "named" else named.append(before(df, purpose)) or named[-1])
    found = texts_of(spark, pages + copies)
    assert [found[i] for i in range(40)] == own
    names = {r["at"]: len(r["named"]) for r in named[0].collect()}
    assert names["h.example"] == 5


def test_html_sketches():
    a, b, c = ("one two three four five", "six", "seven eight nine ten")
    page, rest = html.sketches(*html._tokens([a, b, c]))
    for i, others in enumerate(([b, c], [a, c], [a, b])):
        assert rest[i].tolist() == html.sketches(*html._tokens(others))[0].tolist()
    assert page.tolist() == html.sketches(*html._tokens([c, b, a]))[0].tolist()


def test_suffix_ranks():
    line = np.array([1, 2, 3, 1, 2, 3, 1, 2])
    ranks = html.suffix_ranks(line, 4)
    for i in range(8):
        for j in range(8):
            assert (ranks[i] == ranks[j]) == (list(line[i : i + 4]) == list(line[j : j + 4]))


def test_packing(spark, docs):
    path = public_tokenizers.path("byte_bpe_50k.json")
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(path)
    rows = packing.pack(docs, path, keep_ids=True).collect()
    ids = {r.doc_id: tokenizer.encode(r.text or "", add_special_tokens=False).ids + [0] for r in docs.collect()}
    pieces, filled = {}, {}
    for r in rows:
        part = np.array(ids[r.doc_id][r.start : r.start + r.length], "<u4").tobytes()
        assert len(part) == 4 * r.length and zlib.crc32(part) == r.ids_crc32 and part == r.ids
        pieces.setdefault(r.doc_id, []).append((r.piece, r.start, r.length))
        filled.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for doc_id, own in pieces.items():
        own.sort()
        assert [p[0] for p in own] == list(range(len(own))) and all(p[2] == 2048 for p in own[1:])
        assert sum(p[2] for p in own) == len(ids[doc_id])
    for own in filled.values():
        end = 0
        for offset, length in sorted(own):
            assert offset == end
            end += length
        assert end <= 2048
    least = -(-sum(map(len, ids.values())) // 2048)
    assert set(pieces) == set(ids) and len(filled) <= 1.03 * least


def test_packing_special_tokens(spark):
    path = public_tokenizers.path("byte_bpe_50k.json")
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(path)
    texts = ["see <|endoftext|> here", "<|endoftext|><|endoftext|>", "a <|endoftext|>\n b<|endof", "<|endoftext|", ""]
    rows = packing.pack(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string"), path, keep_ids=True)
    got = {r.doc_id: np.frombuffer(r.ids, "<u4").tolist() for r in rows.collect()}
    assert got == {i: tokenizer.encode(t, add_special_tokens=False).ids + [0] for i, t in enumerate(texts)}
    assert got[0] == [3826, 220, 50256, 994, 0]


def test_warc_places():
    data, index = b"x" * 50, b"line\n"
    for zip64 in (True, False):
        packed = warc.stored_zip([("a", data), ("b", index)], zip64, b"note") + b"note"
        places = warc.directory(lambda at, n: packed[at : at + n], len(packed))
        assert {k: packed[at : at + n] for k, (at, n) in places.items()} == {"a": data, "b": index}
    with pytest.raises(ValueError):
        warc.directory(lambda at, n: b"no zip"[at : at + n], 6)


@pytest.mark.parametrize("by_ranges", [True, False])
def test_warc_spans(spark, tmp_path, monkeypatch, by_ranges):
    monkeypatch.setattr(warc, "SPAN", 2000)
    if not by_ranges:
        monkeypatch.setattr(warc, "_opens", lambda path: False)
    draw = np.random.default_rng(1)
    texts = {i: "".join(map(chr, draw.integers(33, 0x2000, int(n)))) for i, n in enumerate(draw.integers(0, 3000, 60))}
    texts[60] = "x" + "".join(map(chr, draw.integers(33, 127, 400_000)))
    pages = spark.createDataFrame([(i, f"u{i}", t) for i, t in texts.items()], "page_id long, url string, html string")
    folder = str(tmp_path / "packages")
    warc.write(pages.repartition(2), folder, most=100_000)
    rows = warc.read(spark, folder).collect()
    assert {r.page_id: bytes(r.payload).decode() for r in rows} == texts and len(rows) == 61
    assert all(r.payload_digest == hashlib.sha256(texts[r.page_id].encode()).hexdigest() for r in rows)


def test_warc_spans_hold_neighbours(monkeypatch):
    monkeypatch.setattr(warc, "SPAN", 100)
    index = "1 response 0 60\n2 response 60 40\n3 response 100 1\n4 response 101 500\n5 revisit 601 7\n"
    packed = warc.stored_zip([(warc.DATA, b"z" * 608), (warc.INDEX, index.encode())]) + b"\n"
    reads = []

    def ranged(at, many):
        reads.append(many)
        return packed[at : at + many]

    start = warc.directory(lambda at, n: packed[at : at + n], len(packed))[warc.DATA][0]
    found = [(at - start, lengths) for at, lengths in warc._spans(ranged, len(packed))]
    assert found == [(0, [60, 40]), (100, [1]), (101, [500]), (601, [7])]


def test_warc_awkward_pages(spark):
    same = "<p>" + "x" * 200
    pages = [(3, "u", same), (1, "u\n", same), (None, None, same), (2, None, None), (4, "u", "é"), (1, "u", same)]
    got = warc.written_and_read(spark.createDataFrame(pages, "page_id long, url string, html string")).collect()
    kinds = sorted(((r.page_id or 0), r.record_type, r.refers_to, r.payload_bytes) for r in got)
    assert kinds == [(0, "revisit", 1, 203), (1, "response", None, 203), (1, "response", None, 203),
                     (2, "response", None, 0), (3, "revisit", 1, 203), (4, "response", None, 2)]


def test_bpe_tree():
    import base64

    import tiktoken

    path = public_tokenizers.path("byte_bpe_50k.tiktoken")
    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(path, "rb"))}
    plain = tiktoken.Encoding("plain", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    parts = ["a", "b", " ", "  ", "\n", "é", "1", "'s", "!?", "the", " hello", "\x1c", "\x85", "中", "😀", "<|endoftext|>"]
    draw = np.random.default_rng(2)
    for leaf in (1, 4, 32):
        codec = bpe.Codec(path, public_tokenizers.PATTERN, leaf)
        for _ in range(300):
            text = "".join(draw.choice(parts, draw.integers(0, 50)))
            ids = codec.encode(text)
            assert np.frombuffer(ids, "<u4").tolist() == plain.encode_ordinary(text)
            assert codec.decode(ids) == text.encode()


def test_bpe_query(spark, docs):
    import base64

    import tiktoken

    path = public_tokenizers.path("byte_bpe_50k.tiktoken")
    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(path, "rb"))}
    plain = tiktoken.Encoding("plain", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    expected = {}
    for r in docs.collect():
        ids = plain.encode_ordinary(r.text or "")
        packed, text = np.array(ids, "<u4").tobytes(), (r.text or "").encode()
        expected[r.doc_id] = (len(ids), hashlib.sha256(packed).hexdigest(), hashlib.sha256(text).hexdigest())
    rows = QUERIES["op9_bpe_tree"](spark, SF).collect()
    assert len(rows) == len(expected)
    assert {r.doc_id: (r.n_tokens, r.ids_sha256, r.decoded_sha256) for r in rows} == expected


def test_toxicity_held_out(spark):
    docs = spark.read.parquet("/root/testdata/sf0.1/documents.parquet")
    labels = spark.read.parquet("/root/testdata/sf0.1/labels.parquet")
    held = F.col("doc_id") % 3 == 0
    chain = toxicity.fitted(docs, labels.filter(~held))
    scored = toxicity.scored(docs, chain).join(labels.filter(held), "doc_id")
    right = scored.agg(F.avg(((F.col("toxicity.p_toxic") >= 0.5).cast("int") == F.col("toxic")).cast("int"))).first()[0]
    assert right > 0.97


def test_pipeline_stages_on_awkward_rows(spark, awkward, labels, tmp_path):
    labels.write.parquet(str(tmp_path / "labels.parquet"))
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, awkward, str(tmp_path))
        assert out.columns == awkward.columns, name
        out.collect()
    empty = awkward.limit(0)
    for name, stage in corpus_pipeline.STAGES:
        assert stage(spark, empty, str(tmp_path)).count() == 0, name


def test_stages_leave_clashing_columns_alone(spark, docs, tmp_path):
    names = ("judged", "toxicity", "_pii", "Toxicity_", "body", "at", "of", "row", "pii", "key", "s", "x", "kept")
    plain = docs.filter("doc_id % 4 = 0")
    extra = plain.select("*", *(F.concat(F.lit(f"{n}:"), "doc_id").alias(n) for n in names))
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, extra, SF)
        assert out.schema.simpleString() == extra.schema.simpleString(), name
        rows = {r.doc_id: r for r in out.collect()}
        assert all(r[n] == f"{n}:{i}" for i, r in rows.items() for n in names), name
        same = {r.doc_id: r.text for r in stage(spark, plain, SF).collect()}
        assert {i: r.text for i, r in rows.items()} == same, name


def test_repeated_ids_are_one_row_of_the_sample(spark):
    many = spark.range(3000).selectExpr("7L AS doc_id", "'word ' || (id % 900) AS text").unionByName(
        spark.createDataFrame([(8, "other"), (9, None)], "doc_id long, text string"))
    chosen = spark.createDataFrame([(7, 1), (7, 0), (8, 1), (9, 0)], "of long, quality int")
    from ridegauge.llm.common import one_text

    got = sorted((r.doc_id, r.quality, r.text) for r in one_text(many, chosen).collect())
    assert got == [(7, 0, "word 0"), (7, 1, "word 0"), (8, 1, "other"), (9, 0, None)]


def test_pii_without_bounds(spark):
    labels = " (dot) ".join(f"part{i}" for i in range(12))
    local = "x" * 300
    texts = {
        1: f"mail me at {local} (at) {labels} please", 2: "call 12 34 56 78 90 11 now", 3: "call 12 34 56 78 now",
        4: "12 34 " * 20_000, 5: "a (dot) b " * 20_000 + "q (at) " + "c.d." * 20_000 + "com", 6: "11 22 33 444.5 x",
    }
    rows = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    found = {
        r.doc_id: [(r.text[c["start"]:c["end"]], pii.KINDS[c["kind"]]) for c in r.pii if not c["base"]]
        for r in pii.detected(rows).collect()
    }
    assert found[1] == [(f"{local} (at) {labels} please".removesuffix(" please"), "email")]
    assert found[2] == [("12 34 56 78 90 11", "phone")] and found[3] == []
    assert found[4] == [] and len(found[5][0][0]) > 80_000
    assert found[6] == [] or found[6][0][1] == "phone"


def test_pipeline(spark, docs):
    rows = corpus_pipeline.run(spark, SF).collect()
    assert rows and {r.doc_id for r in rows} < {r.doc_id for r in docs.collect()}


def test_awkward_rows_everywhere(spark, awkward, labels, tmp_path):
    folder = str(tmp_path)
    awkward.write.parquet(f"{folder}/documents.parquet")
    labels.write.parquet(f"{folder}/labels.parquet")
    for name in ("op1_brown_scoring", "op2_pii_weak_supervision", "op3_quality_rules", "op9_bpe_tree", "op10_toxicity_chain"):
        assert QUERIES[name](spark, folder).count() == len(AWKWARD), name
    assert QUERIES["op7_pattern_packing"](spark, folder).select("doc_id").distinct().count() == 7


def test_empty_tables(spark, tmp_path):
    folder = str(tmp_path)
    spark.createDataFrame([], SCHEMA).write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame([], "doc_id long, quality int, toxic int").write.parquet(f"{folder}/labels.parquet")
    spark.createDataFrame([], "page_id long, url string, html string").write.parquet(f"{folder}/pages.parquet")
    spark.createDataFrame([], "vec_id long, embedding array<float>").write.parquet(f"{folder}/embeddings.parquet")
    for name, query in QUERIES.items():
        assert query(spark, folder).count() == 0, name
