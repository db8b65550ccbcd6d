"""Personal data by candidate gradient boosting, in DataFrame functions alone.

High-recall generators propose overlapping candidate spans. A span is described
by its format (digits, separators, groups, length) and context (characters and
words beside it). Strict patterns and check sums, which those features do not
see, give the labels; boosted trees learn from the features, on counts of all
feature combinations in the corpus (a bounded number), which candidates look like
personal data. Thresholds are calibrated on the other half of the texts, and
candidates above them are added to the strict (base) spans.

Null texts read as empty: no spans. Equal texts give equal spans; an empty table
gives no rows. All steps of a text are linear in it or nearly so: running sums
over ``k`` spans go by blocks and take ``k ** 1.5`` steps.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

KINDS = ("email", "ip", "card", "phone")
PRECISION = 0.95
ROUNDS, RATE, DEPTH = 30, 0.3, 2

# Strict patterns. Lookbehind (or the end of the last match) and possessive runs
# only spare the search inside a run that cannot match; bounded runs stand for
# "all digits of a run, 12 to 19 (9 to 15) of them".
_LOCAL = r"[A-Za-z0-9._%+-]"
STRICT = {
    "email": rf"(?:(?<!{_LOCAL})|\G){_LOCAL}++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?:(?<![0-9])|\G)[0-9]++(?:\.[0-9]++){3}",
    "card": r"(?<![0-9])(?<![0-9][ -])[0-9](?:[ -]?[0-9]){11,18}+(?![ -]?[0-9])",
    "phone": r"\+[0-9](?:[ ().-]*+[0-9]){8,14}+(?![ ().-]*+[0-9])",
}
# Signs of an address that are spelt out: " at ", "(at)", "[dot]". The last label is one of a
# few, since "at" and "dot" are also plain words.
_AT, _DOT = (rf"(?i:[ ]?[(\[{{]{w}[)\]}}][ ]?|[ ]{w}[ ])" for w in ("at", "dot"))
_SPELT = (
    rf"(?<!{_LOCAL}){_LOCAL}++{_AT}[A-Za-z0-9-]++(?:{_DOT}[A-Za-z0-9-]++)*?"
    rf"{_DOT}(?i:com|org|net|edu|gov|info|io)(?![A-Za-z0-9-])"
)
LOOSE = {
    "email": rf"[^\s@<>\"'(),;:]++@[^\s@<>\"'(),;:]++|{_SPELT}",
    "ip": r"(?:(?<![0-9])|\G)[0-9]++(?:[.:][0-9]++){3,}+",
    "card": r"(?<![0-9])(?<![0-9][ ./-])[0-9](?:[ ./-]?[0-9]){8,}+",
    "phone": r"(?<![0-9])(?:(?<!\+)[0-9]{1,2}(?:[ .-][0-9]{2}){4}|"
    r"\(?[0-9]{2,4}\)?[ ./-]?[0-9]{3,4}[ ./-]?[0-9]{3,4})(?![0-9])",
}
# What a text must hold for the patterns of a kind to be tried.
NEEDS = {"email": "@", "ip": "[0-9][.:][0-9]", "card": "[0-9]", "phone": "[0-9]"}
LOOSE_NEEDS = NEEDS | {"email": rf"@|{_DOT}"}
_OCTET = r"0*(?:25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[0-9]{1,2})"
_WORDS = r"(?i)mail|contact|phone|tel|call|mobile|fax|card|visa|credit|host|address|server"


def valid(kind: str, match: Column) -> Column:
    """Whether a strict match passes the checks of its kind."""
    if kind == "ip":
        return match.rlike(rf"^{_OCTET}(?:\.{_OCTET}){{3}}$")
    if kind == "card":
        return F.call_function("luhn_check", F.regexp_replace(match, "[ -]", ""))
    return F.lit(True)


def let(value: Column, body) -> Column:
    """``body`` of a value that is worked out once, however often the body's lambdas use it."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def running(values: Column, plus, zero: Column) -> Column:
    """For each place of an array, all earlier values put together; by blocks of its root."""

    def given(v: Column) -> Column:
        n = F.size(v)
        block = F.greatest(F.ceil(F.sqrt(n)), F.lit(1)).cast("int")
        return let(block, lambda size: blocked(v, size))

    def blocked(v: Column, size: Column) -> Column:
        numbers = F.sequence(F.lit(0), F.ceil(F.size(v) / size).cast("int"))
        sums = F.transform(
            numbers, lambda j: F.aggregate(F.slice(v, j * size + 1, size), zero, plus)
        )

        def starts(sums: Column) -> Column:
            upto = F.sequence(F.lit(0), F.size(sums) - 1)
            return F.transform(
                upto, lambda j: F.aggregate(F.slice(sums, F.lit(1), j), zero, plus)
            )

        return let(sums, lambda s: let(starts(s), lambda before: placed(v, size, before)))

    def placed(v: Column, size: Column, before: Column) -> Column:
        def upto(_: Column, i: Column) -> Column:
            j = F.floor(i / size).cast("int")
            rest = F.slice(v, j * size + 1, i - j * size)
            return F.aggregate(rest, F.get(before, j), plus)

        return F.transform(v, upto)

    return let(values, given)


def _found(df: DataFrame, name: str, pattern: str, needs: str) -> DataFrame:
    """Matches of a pattern with start, end, the text before and the text after each."""
    text, may = F.col("text"), F.col("text").rlike(needs)
    none = F.array().cast("array<string>")
    cut = df.withColumns(
        {
            "__match": F.when(may, F.regexp_extract_all("text", F.lit(pattern), F.lit(0))).otherwise(
                none
            ),
            "__gap": F.when(may, F.split(text, pattern, -1)).otherwise(none),
        }
    )
    sizes = F.transform(
        "__match", lambda m, i: F.char_length(m) + F.char_length(F.get("__gap", i))
    )
    before = running(sizes, lambda a, b: a + b, F.lit(0))

    def span(gaps: Column, offset: Column, m: Column, i: Column) -> Column:
        start = F.get(offset, i) + F.char_length(F.get(gaps, i))
        return F.struct(
            m.alias("match"),
            start.alias("start"),
            (start + F.char_length(m)).alias("end"),
            F.right(F.get(gaps, i), F.lit(24)).alias("left"),
            F.left(F.get(gaps, i + 1), F.lit(1)).alias("right"),
        )

    known = F.struct(F.col("__gap").alias("gaps"), before.alias("offset"))
    spans = let(
        known,
        lambda k: F.transform("__match", lambda m, i: span(k["gaps"], k["offset"], m, i)),
    )
    return cut.withColumn(name, spans).drop("__match", "__gap")


@dataclass(frozen=True)
class Feature:
    """A feature with values ``0 .. levels - 1``; ordered ones are cut, others compared."""

    levels: int
    ordered: bool = True


FEATURES = {
    "digits": Feature(10),
    "separators": Feature(7, ordered=False),
    "groups": Feature(6),
    "length": Feature(6),
    "left": Feature(4, ordered=False),
    "right": Feature(4, ordered=False),
    "word": Feature(2),
    "lead": Feature(4, ordered=False),
}


def _level(value: Column, *bounds: int) -> Column:
    """How many of the bounds the value reaches."""
    level = F.lit(0)
    for b in bounds:
        level = level + (value >= b).cast("int")
    return level


def _side(char: Column) -> Column:
    return (
        F.when(char == "", 0)
        .when(char.rlike(r"^\s$"), 1)
        .when(char.rlike(r"^[\p{L}0-9]$"), 2)
        .otherwise(3)
    )


def features(c: Column) -> dict[str, Column]:
    """Format and context of a candidate. Not whether a plus and a country code stand before
    it, nor any sum or range of its digits: those are for the labels."""
    m = c["match"]
    digits = F.char_length(F.regexp_replace(m, "[^0-9]", ""))
    marks = F.regexp_replace(m, "[A-Za-z0-9]", "")
    separators = (
        F.when(marks == "", 0)
        .when(marks.rlike("^ +$"), 1)
        .when(marks.rlike("^-+$"), 2)
        .when(marks.rlike(r"^\.+$"), 3)
        .when(marks.rlike("[()]"), 4)
        .when(marks.rlike("@"), 5)
        .otherwise(6)
    )
    before = F.regexp_replace(c["left"], r"\+[0-9]{0,3}[ ./-]?$", "")
    lead = F.substring(F.regexp_replace(m, "[^A-Za-z0-9]", ""), 1, 1)
    return {
        "digits": _level(digits, 1, 4, 8, 9, 11, 12, 15, 16, 20),
        "separators": separators,
        "groups": _level(F.size(F.split(m, "[^A-Za-z0-9]+", -1)), 2, 3, 4, 5, 6),
        "length": _level(F.char_length(m), 8, 12, 16, 20, 30),
        "left": _side(F.right(before, F.lit(1))),
        "right": _side(c["right"]),
        "word": before.rlike(_WORDS).cast("int"),
        "lead": F.when(lead.rlike("[3-6]"), 0)
        .when(lead.rlike("[0-2]"), 1)
        .when(lead.rlike("[7-9]"), 2)
        .otherwise(3),
    }


def _written(match: Column) -> Column:
    """An address with its spelt-out signs as signs."""
    signs = F.regexp_replace(F.regexp_replace(match, _AT, "@"), _DOT, ".")
    return F.when(match.contains("@"), match).otherwise(signs)


def _candidate(kind: str, c: Column) -> Column:
    """A proposed span with its feature code, whether it holds a strict one (spelt-out
    signs read as signs), and whether that is a base span already."""
    if kind == "email":
        spelt, c = ~c["match"].contains("@"), c.withField("match", _written(c["match"]))
    else:
        spelt = F.lit(False)
    code = F.lit(0)
    for name, value in features(c).items():
        code = code * FEATURES[name].levels + value
    seen, pattern = c["match"], STRICT[kind]
    if kind == "phone":
        # a candidate is the national number, at the end of a strict one
        seen, pattern = F.concat(c["left"], c["match"]), pattern + "$"
    strict = F.regexp_extract_all(seen, F.lit(pattern), F.lit(0))
    holds = F.exists(strict, lambda m: valid(kind, m))
    return F.struct(
        F.lit(kind).alias("kind"),
        c["start"].alias("start"),
        c["end"].alias("end"),
        code.alias("code"),
        holds.alias("strict"),
        (holds & ~spelt).alias("held"),
    )


def spotted(docs: DataFrame) -> DataFrame:
    """``row`` (the input row), ``text``, and the arrays ``base`` and ``proposed``."""
    df = docs.select(F.struct("*").alias("row"), F.coalesce("text", F.lit("")).alias("text"))
    for kind in KINDS:
        df = _found(df, f"strict_{kind}", STRICT[kind], NEEDS[kind])
        df = _found(df, f"loose_{kind}", LOOSE[kind], LOOSE_NEEDS[kind])

    def strict(kind: str) -> Column:
        passed = F.filter(f"strict_{kind}", lambda c: valid(kind, c["match"]))
        return F.transform(passed, lambda c: _span(c["start"], kind, c["end"]))

    def loose(kind: str) -> Column:
        return F.transform(f"loose_{kind}", lambda c: _candidate(kind, c))

    base = F.array_sort(F.flatten(F.array(*map(strict, KINDS))))
    return df.select(
        "row", "text", base.alias("base"), F.flatten(F.array(*map(loose, KINDS))).alias("proposed")
    )


def _span(start: Column, kind: str | Column, end: Column) -> Column:
    """Spans sort by start, then kind as listed, then end."""
    if isinstance(kind, str):
        rank = F.lit(KINDS.index(kind) + 1)
    else:
        rank = F.array_position(F.array(*map(F.lit, KINDS)), kind).cast("int")
    return F.struct(start.alias("start"), rank.alias("rank"), end.alias("end"))


def tally(spots: DataFrame) -> DataFrame:
    """Candidates by kind and feature code: strict ones and others in either half of the texts.

    The rows are bounded by the number of feature combinations.
    """
    half = F.pmod(F.xxhash64("text"), F.lit(2)).alias("half")
    each = spots.select(half, F.explode("proposed").alias("c")).select(
        "half", "c.kind", "c.code", "c.strict"
    )

    def n(which: int, strict: bool) -> Column:
        return F.count_if((F.col("half") == which) & (F.col("strict") == strict))

    counts = [n(h, s).alias(f"n{h}{int(s)}") for h in (0, 1) for s in (False, True)]
    return each.groupBy("kind", "code").agg(*counts)


def _tests(codes: np.ndarray) -> np.ndarray:
    """One column per test a tree may make: a cut of an ordered feature, a value of another."""
    columns, rest = [], codes.copy()
    for feature in reversed(FEATURES.values()):
        value, rest = rest % feature.levels, rest // feature.levels
        for level in range(feature.levels):
            columns.append(value > level if feature.ordered else value == level)
    return np.stack(columns, axis=1)


def _grow(tests: np.ndarray, g: np.ndarray, h: np.ndarray, depth: int) -> np.ndarray:
    """Values of one regression tree at every row, from gradients and curvatures."""
    leaf = np.full(len(g), -g.sum() / (h.sum() + 1.0))
    if depth == 0:
        return leaf
    gl, hl = g @ tests, h @ tests
    gain = gl**2 / (hl + 1) + (g.sum() - gl) ** 2 / (h.sum() - hl + 1) - g.sum() ** 2 / (h.sum() + 1)
    best = int(np.argmax(gain))
    if gain[best] <= 1e-6:
        return leaf
    for side in (tests[:, best], ~tests[:, best]):
        leaf[side] = _grow(tests[side], g[side], h[side], depth - 1)
    return leaf


def boost(codes: np.ndarray, strict: np.ndarray, other: np.ndarray) -> np.ndarray:
    """Scores of feature codes by boosted trees, weighted with how often each occurs."""
    tests, total = _tests(codes).astype(bool), strict + other
    prior = np.log((strict.sum() + 0.5) / (other.sum() + 0.5))
    score = np.full(len(codes), prior)
    for _ in range(ROUNDS):
        p = 1 / (1 + np.exp(-score))
        g, h = total * p - strict, total * p * (1 - p)
        score = score + RATE * _grow(tests, g, h, DEPTH)
    return score


def falling(score: np.ndarray, hits: np.ndarray, misses: np.ndarray) -> np.ndarray:
    """Chances that never rise along falling scores: neighbours that would are pooled."""
    steps: list[list[float]] = []  # hits, misses, members
    for i in range(len(score)):
        steps.append([hits[i], misses[i], 1])
        while len(steps) > 1 and (
            score[i] == score[i - 1]
            and steps[-1][2] == 1
            or steps[-1][0] * sum(steps[-2][:2]) > steps[-2][0] * sum(steps[-1][:2])
        ):
            last = steps.pop()
            steps[-1] = [a + b for a, b in zip(steps[-1], last, strict=True)]
    return np.concatenate([np.full(int(k), h / (h + m + 1)) for h, m, k in steps])


def accepted(rows: list, precision: float = PRECISION) -> dict[str, list[int]]:
    """Feature codes by kind whose score reaches the calibrated threshold.

    Trees learn from one half. On the other, isotonic regression turns scores into
    chances that a candidate holds a strict span; a pretended miss in every step of
    it keeps codes without evidence out.
    """
    chosen: dict[str, list[int]] = {}
    for kind in KINDS:
        own = sorted((r for r in rows if r["kind"] == kind), key=lambda r: r["code"])
        if not own:
            continue
        codes = np.array([r["code"] for r in own], np.int64)
        n = {k: np.array([r[k] for r in own], float) for k in ("n00", "n01", "n10", "n11")}
        score = boost(codes, n["n01"], n["n00"])
        order = np.argsort(-score, kind="stable")
        chance = falling(score[order], n["n11"][order], n["n10"][order])
        chosen[kind] = codes[order[chance >= precision]].tolist()
    return chosen


def pii_spans(docs: DataFrame, precision: float = PRECISION) -> DataFrame:
    """``row``, ``text``, and the arrays ``base`` and ``spans`` (base and added, sorted)."""
    spots = spotted(docs)
    chosen = accepted(tally(spots).collect(), precision)

    def takes(c: Column) -> Column:
        test = F.lit(False)
        for kind, codes in chosen.items():
            test = test | ((c["kind"] == kind) & c["code"].isin(codes))
        return test & ~c["held"]

    added = F.transform(
        F.filter("proposed", takes), lambda c: _span(c["start"], c["kind"], c["end"])
    )
    spans = F.array_sort(F.array_union("base", added))
    return spots.select("row", "text", "base", spans.alias("spans"))


def told(spans: Column) -> Column:
    """``kind:start:end`` of spans, comma-joined."""
    names = F.array(*map(F.lit, KINDS))
    one = F.transform(
        spans, lambda s: F.concat_ws(":", F.get(names, s["rank"] - 1), s["start"], s["end"])
    )
    return F.array_join(one, ",")


def pii_report(docs: DataFrame) -> DataFrame:
    """Base counts and digest, and all spans, by document."""

    def n(kind: str) -> Column:
        rank = KINDS.index(kind) + 1
        return F.size(F.filter("base", lambda s: s["rank"] == rank)).cast("bigint")

    return pii_spans(docs).select(
        F.col("row.doc_id").alias("doc_id"),
        *[n(k).alias(f"n_{k}") for k in KINDS],
        F.sha2(told(F.col("base")), 256).alias("base_sha256"),
        told(F.col("spans")).alias("spans"),
    )


def redact(docs: DataFrame) -> DataFrame:
    """The input rows with every span replaced by its kind in angle brackets.

    Spans that overlap become one, named for the first. Other columns stay as
    they are; ``n_chars`` counts the new text where there is such a column.
    """
    found = pii_spans(docs)
    ends = F.transform("spans", lambda s: s["end"])
    reach = running(ends, lambda a, b: F.greatest(a, b), F.lit(0))
    marks = F.array(*[F.lit(f"<{k.upper()}>") for k in KINDS])

    def piece(so_far: Column, s: Column) -> Column:
        gap = F.substring("text", so_far + 1, s["start"] - so_far)
        return F.when(s["start"] >= so_far, F.concat(gap, F.get(marks, s["rank"] - 1))).otherwise("")

    pieces = let(reach, lambda r: F.transform("spans", lambda s, i: piece(F.get(r, i), s)))
    last = F.coalesce(F.array_max(ends), F.lit(0))
    tail = F.substring("text", last + 1, F.char_length("text"))
    whole = F.concat(F.array_join(pieces, ""), tail)
    text = F.when(F.size("spans") == 0, F.col("row.text")).otherwise(whole)
    masked = found.select("row", text.alias("__text"))
    columns = {"text": F.col("__text")}
    if "n_chars" in docs.columns:
        changed = F.when(
            F.col("row.text").eqNullSafe(F.col("__text")), F.col("row.n_chars")
        ).otherwise(F.char_length("__text"))
        columns["n_chars"] = changed.cast(docs.schema["n_chars"].dataType)
    return masked.select(
        *[columns.get(c, F.col("row").getField(c)).alias(c) for c in docs.columns]
    )
