"""Personal data: rules, weakly supervised candidates, and a span classifier, in Spark expressions.

Base spans (email, ip, card, phone) follow fixed rules and always stay.  What the rules miss or
refuse becomes candidates: phone numbers of an odd length, written-out addresses, numbers grouped like
phone numbers without a country code, card numbers next to other numbers, secrets after a keyword.  Five labelers (rule, gazetteer,
context, edges, shape) vote on every candidate and base span, or abstain.  Expectation-maximisation
over the counts of vote patterns, a table whose size depends on the labelers only, estimates how
reliable each labeler is per kind, and gives every pattern a probability.  A logistic classifier is
trained on them and applied as a Spark expression; candidates it accepts become spans.

The regular expressions are possessive and start at the edge of a run or where the last match
ended, which changes none of their matches but keeps them linear, and off the stack, on texts such
as a million digits.

Null texts count as empty.  Offsets are code points, ends exclusive.  All columns of the input pass
through, whatever their names; results are in one struct column, and ``masked`` uses a name that the table
does not have.  Repeated rows and repeated ``doc_id`` do not matter, as
no step joins rows.  With no candidates at all nothing is added to the base spans.
"""

import math
from dataclasses import dataclass
from itertools import product

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ridegauge.llm.common import unused, whole
from ridegauge.session import written

KINDS = ("email", "ip", "card", "phone", "secret")
BASE = KINDS[:4]
LABELERS = ("rule", "gazetteer", "context", "edges", "shape")
_BLOCK = 128

# What the finders look for.  A lookbehind that \G (the end of the last match) can
# replace keeps a match from starting inside a run of which an earlier start has failed.
_LOCAL = "[A-Za-z0-9._%+-]"
FINDERS = {
    "email": rf"(?:\G|(?<!{_LOCAL})){_LOCAL}++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?:\G|(?<![0-9]))[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"[0-9](?:[\x20-]?[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
    "spelled": rf"(?<!{_LOCAL}){_LOCAL}++ ?[(\[](?:at|AT)[)\]] ?[A-Za-z0-9-]++"
               r"(?: ?(?:[(\[](?:dot|DOT)[)\]]|\.) ?[A-Za-z0-9-]++)++",
    "local": r"(?<![0-9A-Za-z.+(-])\(?[0-9]{2,4}\)?(?:"
             r"(?:[ .-][0-9]{2,4}(?![0-9A-Za-z])){2,}+(?![.-][0-9])|(?:[ .-][0-9]{2,4}(?= )){2,}+)",
    "alone": r"(?<![0-9])(?:[0-9]{13,19}|[0-9]{4}(?:[ -][0-9]{4}){3})(?![0-9])",
    "secret": r"(?i)(?<![a-z0-9])(?:token|secret|password|passwd|api[_-]?key|access[_-]?key|bearer)"
              r"[\"']?\s{0,3}[=:]\s{0,3}[\"']?[a-z0-9+/_.-]{12,}+",
}
_FINDS = {"spelled": "email", "local": "phone", "alone": "card"}
# Cheap tests that a text must pass to have a match at all.
_POSSIBLE = {
    "email": "contains(body, '@')", "ip": "body RLIKE '[0-9][.][0-9]'", "card": "body RLIKE '[0-9][ -]?[0-9]'",
    "phone": "contains(body, '+')", "spelled": "body RLIKE '(?:at|AT)[)\\\\]]'",
    "local": "body RLIKE '[0-9][ .-][0-9]'", "alone": "body RLIKE '[0-9]{4}[ -]?[0-9]{4}'",
    "secret": "body RLIKE '[=:]'",
}
_DOMAINS = "com|org|net|edu|gov|info|io|de|fr|es|it|uk|eu|nl|ch|at|us|ca|br|in|jp|cn|ru|au"
_CUES = {
    "email": "mail|contact|write|reach|kontakt|correo|courriel",
    "ip": "ip|host|server|address|addr|login|from",
    "card": "card|visa|mastercard|amex|payment|pay|karte|carte|tarjeta",
    "phone": "phone|tel|call|fax|mobile|cell|dial|telefon",
    "secret": "token|secret|password|key",
}
_CONTRA = "version|isbn|issn|licen[sc]e|chapter|page|figure|release|build"


def _text(value: str) -> str:
    """A Spark SQL string literal."""
    return "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"


def _placed(pieces: str) -> str:
    """Matches with their starts, from gaps and matches in order.

    The running position is a fold; it goes in blocks, so that no long array is copied per match.
    """
    empty = "cast(array() AS array<struct<start: int, found: string>>)"
    block = f"slice({pieces}, b * {_BLOCK} + 1, {_BLOCK})"
    inner = (
        f"aggregate({block}, named_struct('at', a.at, 'done', a.done, 'now', {empty}), "
        "(c, x) -> named_struct('at', c.at + x.gap + length(x.found), 'done', c.done, "
        "'now', concat(c.now, array(named_struct('start', c.at + x.gap, 'found', x.found)))), "
        "c -> named_struct('at', c.at, 'done', concat(c.done, array(c.now))))"
    )
    return (
        f"CASE WHEN size({pieces}) > 0 THEN flatten(aggregate("
        f"sequence(0, cast((size({pieces}) - 1) div {_BLOCK} AS int)), "
        "named_struct('at', 0, 'done', cast(array() AS array<array<struct<start: int, found: string>>>)), "
        f"(a, b) -> {inner}, a -> a.done)) ELSE {empty} END"
    )


def _found(rows: DataFrame) -> DataFrame:
    """``found_<finder>``: the matches of each finder, leftmost and not overlapping."""
    cut = {}
    for name, pattern in FINDERS.items():
        if_any = f"CASE WHEN {_POSSIBLE[name]} THEN "
        cut[f"all_{name}"] = F.expr(f"{if_any} regexp_extract_all(body, {_text(pattern)}, 0) END")
        cut[f"gaps_{name}"] = F.expr(f"{if_any} split(body, {_text(pattern)}, -1) END")
    rows = rows.withColumns(cut)
    # one more gap than matches; the last has no match
    rows = rows.withColumns({
        f"pairs_{name}": F.expr(
            f"coalesce(filter(zip_with(gaps_{name}, all_{name}, (g, f) -> "
            "named_struct('gap', length(g), 'found', f)), x -> x.found IS NOT NULL), "
            "cast(array() AS array<struct<gap: int, found: string>>))"
        )
        for name in FINDERS
    }).drop(*cut)
    rows = rows.withColumns({f"found_{name}": F.expr(_placed(f"pairs_{name}")) for name in FINDERS})
    return rows.drop(*(f"pairs_{name}" for name in FINDERS))


_DIGITS = "regexp_replace(x.found, '[^0-9]', '')"
_LUHN = (
    f"aggregate(sequence(1, length({_DIGITS})), 0, (s, i) -> s + "
    f"(CASE WHEN i % 2 = 1 THEN 1 ELSE 2 END) * cast(substr({_DIGITS}, -i, 1) AS int) - "
    f"(CASE WHEN i % 2 = 0 AND substr({_DIGITS}, -i, 1) >= '5' THEN 9 ELSE 0 END)) % 10 = 0"
)
_PART = r"0*(?:25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[0-9]{1,2})"
_RULES = {
    "email": "true",
    "ip": f"x.found RLIKE {_text(rf'^{_PART}[.]{_PART}[.]{_PART}[.]{_PART}$')}",
    "card": f"CASE WHEN length({_DIGITS}) BETWEEN 13 AND 19 THEN {_LUHN} ELSE false END",
    "phone": f"length({_DIGITS}) BETWEEN 9 AND 15",
    "spelled": "false", "local": "false", "alone": "false", "secret": "false",
}
# What is worth a vote although its rule has refused it.  A wrong check digit is not; a card number
# that the base rule has read together with another number is.
_WORTH = {
    "ip": "false", "card": "false", "alone": _LUHN,
    "phone": f"length({_DIGITS}) BETWEEN 7 AND 15",
    "local": f"length({_DIGITS}) BETWEEN 9 AND 12",
}


def _votes(kind: str) -> dict[str, str]:
    """Each labeler's vote as SQL on a candidate ``y``: 1 for, 0 against, -1 for an abstention."""
    gazetteer = {
        "email": f"CASE WHEN y.found RLIKE '(?i)(?:[.]|dot[)\\\\]] ?)(?:{_DOMAINS})$' THEN 1 ELSE 0 END",
        "ip": "CASE WHEN y.found RLIKE '^(?:0|10|127|169|22[4-9]|23[0-9]|24[0-9]|25[0-9])[.]' THEN 0 ELSE 1 END",
        "card": "CASE WHEN y.found RLIKE '^[3-6]' THEN 1 ELSE 0 END",
        "phone": "CASE WHEN y.found RLIKE '^[+][1-9]' THEN 1 ELSE -1 END",
        "secret": "1",
    }
    shape = {
        "email": "CASE WHEN contains(y.found, '..') OR y.found RLIKE '^[.-]' THEN 0 ELSE 1 END",
        "ip": "CASE WHEN y.found RLIKE '(?:^|[.])0[0-9]' THEN 0 ELSE 1 END",
        "card": "CASE WHEN y.found RLIKE '^(?:[0-9]+|[0-9]{4}(?:[ -][0-9]{4}){2,3}(?:[ -][0-9]{1,3})?)$' "
                "THEN 1 ELSE 0 END",
        "phone": "CASE WHEN y.found RLIKE '[(][0-9]{2,4}[)]|[0-9]{3}[ .-][0-9]{3,4}' THEN 1 ELSE 0 END",
        "secret": "CASE WHEN y.found RLIKE '[0-9]' AND y.found RLIKE '(?i)[=:].*[a-z]' THEN 1 ELSE 0 END",
    }
    rule = "CASE WHEN y.base THEN 1 ELSE 0 END"
    if kind == "secret":
        rule = "CASE WHEN length(y.found) >= 28 THEN 1 ELSE 0 END"
    return {
        "rule": rule,
        "gazetteer": gazetteer[kind],
        "context": f"CASE WHEN y.before RLIKE '(?i)(?:{_CONTRA})' THEN 0 "
                   f"WHEN y.before RLIKE '(?i)(?:{_CUES[kind]})' THEN 1 ELSE -1 END",
        "edges": "CASE WHEN y.before RLIKE '[0-9A-Za-z_/#]$' OR y.after RLIKE '^[0-9A-Za-z_/]' THEN 0 ELSE 1 END",
        "shape": shape[kind],
    }


def detected(docs: DataFrame, text: str = "text", column: str = "pii") -> DataFrame:
    """``docs`` with an array of candidates: kind (its place in ``KINDS``), start, end, base, votes."""
    names = [c for c in docs.columns]
    inside = docs.select(F.struct(*(docs[c] for c in names)).alias("row"), whole(text).alias("body"))
    rows = _found(inside)
    # every match with its check, and those that fail without being worth a vote dropped
    checked = {}
    for name in FINDERS:
        worth = _WORTH.get(name, "true")
        checked[f"cand_{name}"] = F.expr(
            f"filter(transform(found_{name}, x -> named_struct("
            "'start', x.start, 'end', x.start + length(x.found), 'found', x.found, "
            f"'base', {_RULES[name]}, 'worth', {worth}, "
            "'before', substr(body, greatest(x.start - 23, 1), least(x.start, 24)), "
            "'after', substr(body, x.start + length(x.found) + 1, 2))), x -> x.base OR x.worth)"
        )
    rows = rows.withColumns(checked).drop(*(f"found_{name}" for name in FINDERS), "body")
    voted = {}
    for name in FINDERS:
        kind = _FINDS.get(name, name)
        votes = ", ".join(f"cast({vote} AS tinyint)" for vote in _votes(kind).values())
        voted[f"cand_{name}"] = F.expr(
            f"transform(cand_{name}, y -> named_struct('kind', {KINDS.index(kind)}, 'start', y.start, "
            f"'end', y.end, 'base', y.base, 'votes', array({votes})))"
        )
    rows = rows.withColumns(voted)
    every = F.concat(*(F.col(f"cand_{name}") for name in FINDERS))
    return rows.select("row.*", every.alias(column))


@dataclass(frozen=True)
class Model:
    """Per kind a bias, and per labeler the weights of a vote for and a vote against."""

    weights: dict[int, tuple[float, tuple[tuple[float, float], ...]]]
    reliability: dict[tuple[int, str], tuple[float, float]]

    def accepts(self, candidate: str) -> str:
        """SQL that tells whether a candidate is personal data."""
        cases = []
        for kind, (bias, by_labeler) in self.weights.items():
            terms = [repr(bias) + "D"]
            for i, (yes, no) in enumerate(by_labeler):
                terms.append(
                    f"(CASE element_at({candidate}.votes, {i + 1}) WHEN 1 THEN {yes!r}D WHEN 0 THEN {no!r}D "
                    "ELSE 0D END)"
                )
            cases.append(f"WHEN {kind} THEN {' + '.join(terms)} >= 0")
        chosen = f"CASE {candidate}.kind {' '.join(cases)} ELSE false END" if cases else "false"
        return f"({candidate}.base OR {chosen})"


def estimated(patterns: dict[tuple[int, tuple[int, ...]], int], steps: int = 40) -> tuple[dict, dict]:
    """Expectation-maximisation over counted vote patterns, per kind.

    Returns each pattern's probability, and per (kind, labeler) how often it votes for a true and
    for a false candidate.  Starts from the share of votes in favour.
    """
    truth, reliability = {}, {}
    for kind in sorted({kind for kind, _ in patterns}):
        own = {votes: n for (k, votes), n in patterns.items() if k == kind}
        belief = {
            votes: (sum(v == 1 for v in votes) + 0.5) / (sum(v >= 0 for v in votes) + 1) for votes in own
        }
        for _ in range(steps):
            true = sum(n * belief[v] for v, n in own.items())
            prior = (true + 1) / (sum(own.values()) + 2)
            rates = []
            for i in range(len(LABELERS)):
                voting = [(v, n) for v, n in own.items() if v[i] >= 0]
                t = sum(n * belief[v] for v, n in voting)
                f = sum(n * (1 - belief[v]) for v, n in voting)
                # a labeler is taken to be better than chance, as by nine votes seen before
                rates.append((
                    (sum(n * belief[v] for v, n in voting if v[i]) + 7) / (t + 9),
                    (sum(n * (1 - belief[v]) for v, n in voting if v[i]) + 2) / (f + 9),
                ))
            for votes in own:
                yes, no = math.log(prior), math.log(1 - prior)
                for (t, f), v in zip(rates, votes):
                    if v >= 0:
                        yes += math.log(t if v else 1 - t)
                        no += math.log(f if v else 1 - f)
                belief[votes] = 1 / (1 + math.exp(max(-500.0, min(500.0, no - yes))))
        truth |= {(kind, votes): p for votes, p in belief.items()}
        reliability |= {(kind, name): rate for name, rate in zip(LABELERS, rates)}
    return truth, reliability


def _classifier(own: dict[tuple[int, ...], tuple[int, float]], steps: int = 400):
    """Logistic regression on (count, probability) per vote pattern; gradient steps, by hand."""
    total = sum(n for n, _ in own.values())
    places = list(product(range(len(LABELERS)), (1, 0)))
    bias, weights = 0.0, [0.0] * len(places)
    for _ in range(steps):
        slope, slopes = 0.0, [0.001 * w for w in weights]
        for votes, (n, p) in own.items():
            z = bias + sum(w for w, (i, v) in zip(weights, places) if votes[i] == v)
            error = (1 / (1 + math.exp(-max(-30.0, min(30.0, z)))) - p) * n / total
            slope += error
            for j, (i, v) in enumerate(places):
                if votes[i] == v:
                    slopes[j] += error
        bias -= slope
        weights = [w - s for w, s in zip(weights, slopes)]
    pairs = tuple((weights[2 * i], weights[2 * i + 1]) for i in range(len(LABELERS)))
    return bias, pairs


def fitted(candidates: DataFrame, column: str = "pii") -> Model:
    """The model of all candidates in ``detected`` rows; only counts of vote patterns are collected."""
    counts = (
        candidates.select(F.explode(column).alias("c")).groupBy("c.kind", "c.votes")
        .agg(F.count("*").alias("n")).collect()
    )
    patterns = {(row["kind"], tuple(row["votes"])): row["n"] for row in counts}
    truth, reliability = estimated(patterns)
    weights = {}
    for kind in sorted({kind for kind, _ in patterns}):
        weights[kind] = _classifier(
            {votes: (n, truth[kind, votes]) for (k, votes), n in patterns.items() if k == kind}
        )
    return Model(weights, reliability)


def accepted(candidates: DataFrame, model: Model, column: str = "pii") -> DataFrame:
    """The candidates' column reduced to base spans and what the classifier accepts, in order.

    A candidate that overlaps a base span adds nothing.
    """
    new = (
        f"filter({column}, y -> {model.accepts('y')} AND (y.base OR NOT exists({column}, "
        "z -> z.base AND z.start < y.end AND y.start < z.end)))"
    )
    return candidates.withColumn(
        column, F.expr(f"array_sort(transform({new}, y -> named_struct('kind', y.kind, 'start', y.start, "
                       "'end', y.end, 'base', y.base)))")
    )


def _joined(spans: str, only: str = "true") -> Column:
    names = ", ".join(_text(kind) for kind in KINDS)
    return F.expr(
        f"concat_ws(',', transform(filter({spans}, s -> {only}), s -> "
        f"concat(element_at(array({names}), s.kind + 1), ':', s.start, ':', s.end)))"
    )


def summary(column: str = "pii") -> dict[str, Column]:
    """Counts and hash of the base spans and all spans as text, of an ``accepted`` column."""
    found = {
        f"n_{kind}": F.expr(f"cast(size(filter({column}, s -> s.base AND s.kind = {i})) AS bigint)")
        for i, kind in enumerate(BASE)
    }
    found["base_sha256"] = F.sha2(_joined(column, "s.base"), 256)
    found["spans"] = _joined(column)
    return found


def masked(docs: DataFrame, model: Model, text: str = "text") -> DataFrame:
    """``docs`` with every span of a text replaced by its kind, such as ``<EMAIL>``.

    ``n_chars``, where there is such a column, becomes the length of the new text.  Null texts stay.
    """
    own = unused("_pii", docs)
    spans = accepted(detected(docs, text, own), model, own)
    marks = ", ".join(_text(f"<{kind.upper()}>") for kind in KINDS)
    by_start = f"array_sort(transform({own}, s -> named_struct('start', s.start, 'end', s.end, 'kind', s.kind)))"
    rebuilt = (
        f"aggregate({by_start}, named_struct('at', 0, 'parts', cast(array() AS array<string>)), "
        "(a, s) -> named_struct('at', greatest(a.at, s.end), 'parts', CASE WHEN s.start >= a.at THEN "
        f"concat(a.parts, array(substr({text}, a.at + 1, s.start - a.at), element_at(array({marks}), s.kind + 1))) "
        f"ELSE a.parts END), a -> concat(array_join(a.parts, ''), substr({text}, a.at + 1)))"
    )
    new = spans.withColumn(text, F.expr(f"CASE WHEN size({own}) > 0 THEN {rebuilt} ELSE {text} END"))
    if "n_chars" in docs.columns:
        new = new.withColumn(
            "n_chars", F.expr(f"CASE WHEN size({own}) > 0 THEN length({text}) ELSE n_chars END").cast(
                docs.schema["n_chars"].dataType
            )
        )
    return new.drop(own)


def spans(docs: DataFrame) -> DataFrame:
    """``doc_id`` and the accepted spans of each row; the model is fitted on all of them."""
    candidates = written(detected(docs.select("doc_id", "text")).select("doc_id", "pii"), "pii")
    return accepted(candidates, fitted(candidates))
