"""Secrets in texts: keyed assignments, access keys, hex runs, and strings of high windowed entropy.

Everything is column expressions; texts aren't moved. Positions are code points.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from formline.llm.common import fresh

KINDS = ("assign", "access", "hex", "entropy")

#: The patterns of the three base kinds.
ASSIGN = "((?i:password|passwd|secret|token|api_?key))[\"']?\\x20*[:=]\\x20*[\"']?([A-Za-z0-9+/_.=-]+)"
ACCESS = "AKIA[A-Z0-9]+"
HEX = "[0-9a-f]+"
LEAST = {"assign": 8, "access": 16, "hex": 32}

ALPHABET = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/_-="
#: Windows of the entropy scan: the short one for candidates that the long one doesn't fit in. Strings of
#: fewer characters than the short one are no candidates.
WINDOW = 24
SHORT_WINDOW = 16
CANDIDATE = f"[A-Za-z0-9+/_=-]{{{SHORT_WINDOW},}}+"
#: Classes of candidates by their letters and digits, the first that fits, and how many characters each draws from.
CLASSES = (("hex", "^([0-9a-f]+|[0-9A-F]+)$", 16), ("one case", "^([0-9a-z]+|[0-9A-Z]+)$", 36), ("mixed", "^[0-9A-Za-z]+$", 62))
#: Share of the entropy expected of random characters of the class that a window must reach.
SHARE = 0.89
#: Parts of a candidate between signs that are never secret: words, numbers, versions and sample values. The rest counts.
ALLOWED_PARTS = "(?<![A-Za-z0-9])([A-Z]?[a-z]+|[A-Z]+|[0-9]+|[vV][0-9]+|(?i:example|sample|dummy|test|placeholder|changeme|x{4,})[0-9]*)(?![A-Za-z0-9])"
#: What is left of a candidate and isn't a secret: a word and a number, or the reverse, and too little of either.
ALLOWED = ("^[A-Za-z]*[0-9]*$", "^[0-9]*[A-Za-z]*$")
#: Whole candidates that aren't secrets: UUIDs.
ALLOWED_WHOLE = "^[0-9a-fA-F]{8}(-[0-9a-fA-F]{4}){3}-[0-9a-fA-F]{12}$"

_SPAN = "struct<kind:string,place:int,start:bigint,end:bigint>"


def _span(kind: str, start: Column, end: Column) -> Column:
    return F.struct(F.lit(kind).alias("kind"), F.lit(KINDS.index(kind)).alias("place"), start.alias("start"), end.alias("end"))


def _found(text: Column, kind: str, pattern: str, keep) -> Column:
    """Spans of the matches that ``keep(match, its index)`` accepts.

    A match starts after all pieces between matches and all matches before it.
    """
    regex = F.lit(pattern)
    parts = F.arrays_zip(F.split(text, pattern, -1).alias("gap"), F.regexp_extract_all(text, regex, F.lit(0)).alias("hit"))
    begin = F.struct(F.lit(0).cast("bigint").alias("at"), F.array().cast(f"array<{_SPAN}>").alias("spans"))

    def step(state, part):
        start = state.at + F.length(part.gap)
        end = start + F.coalesce(F.length(part.hit), F.lit(0))
        good = part.hit.isNotNull() & keep(part.hit)
        spans = F.when(good, F.concat(state.spans, F.array(_span(kind, start, end)))).otherwise(state.spans)
        return F.struct(end.alias("at"), spans.alias("spans"))

    return F.aggregate(parts, begin, step, lambda s: s.spans)


def _weight(count: Column) -> Column:
    return F.when(count > 0, count * F.log2(count.cast("double"))).otherwise(F.lit(0.0))


def expected_bits(window: int, size: int) -> float:
    """The mean Shannon entropy of a window of random characters out of ``size``.

    Each character's count is binomial; the entropy is log2(window) less the mean of count * log2(count) over the window.
    """
    p = 1 / size
    terms = (math.comb(window, k) * p**k * (1 - p) ** (window - k) * k * math.log2(k) for k in range(2, window + 1))
    return math.log2(window) - size * sum(terms) / window


def window_bits(candidate: Column, window: int = WINDOW) -> Column:
    """The largest Shannon entropy of a window of so many characters, over all windows of the candidate.

    Counts per character follow the window: one goes up and one goes down per step, and the sum of
    count * log2(count) changes by the terms of these two alone.
    """
    begin = F.struct(
        F.array_repeat(F.lit(0), len(ALPHABET)).alias("counts"), F.lit(0.0).alias("sum"), F.lit(0.0).alias("best")
    )
    # Each step gets the character that enters and the one that leaves: the arrays are made once per
    # candidate, as what a lambda names from outside would be computed again at every step.
    enters = F.transform(F.split(candidate, ""), lambda c: F.position(c, F.lit(ALPHABET)) - 1)
    steps = F.transform(enters, lambda c, i: F.struct(i.alias("i"), c.alias("enters")))
    leaves = F.concat(F.array_repeat(F.lit(-1), window), F.slice(enters, 1, F.length(candidate) - window))
    steps = F.zip_with(steps, leaves, lambda s, c: F.struct(s.i.alias("i"), s.enters.alias("enters"), c.alias("leaves")))

    def slide(state, at):
        full = at.i >= window
        up, left = F.get(state.counts, at.enters), F.get(state.counts, at.leaves)
        change = _weight(up + 1) - _weight(up) - F.when(full, _weight(left) - _weight(left - 1)).otherwise(F.lit(0.0))
        # Where the same character enters and leaves nothing changes.
        total = F.when(at.enters == at.leaves, state.sum).otherwise(state.sum + change)
        counts = F.transform(state.counts, lambda c, j: c + F.when(j == at.enters, 1).otherwise(0) - F.when(j == at.leaves, 1).otherwise(0))
        bits = F.when(at.i >= window - 1, F.log2(F.lit(float(window))) - total / window).otherwise(F.lit(0.0))
        return F.struct(counts.alias("counts"), total.alias("sum"), F.greatest(state.best, bits).alias("best"))

    return F.aggregate(steps, begin, slide, lambda s: s.best)


def _secret_part(candidate: Column) -> Column:
    """The letters and digits of a candidate without its allowed parts; empty where nothing secret can be left."""
    rest = F.regexp_replace(F.regexp_replace(candidate, ALLOWED_PARTS, ""), "[^A-Za-z0-9]+", "")
    allowed = candidate.rlike(ALLOWED_WHOLE) | (F.length(rest) < SHORT_WINDOW)
    for pattern in ALLOWED:
        allowed = allowed | rest.rlike(pattern)
    return F.when(allowed, F.lit("")).otherwise(rest)


def _is_secret(candidate: Column) -> Column:
    def reaches(part, window: int):
        wanted = F.lit(None).cast("double")
        for _, pattern, size in reversed(CLASSES):
            wanted = F.when(part.rlike(pattern), F.lit(SHARE * expected_bits(window, size))).otherwise(wanted)
        return F.coalesce(window_bits(part, window) >= wanted, F.lit(False))

    def judged(part):
        return F.when(part == "", F.lit(False)).when(F.length(part) < WINDOW, reaches(part, SHORT_WINDOW)).otherwise(reaches(part, WINDOW))

    # The part is made once: what a lambda gets is a value, an expression would be made again at each use.
    return F.get(F.transform(F.array(_secret_part(candidate)), judged), F.lit(0))


def spans(text: Column) -> tuple[Column, Column]:
    """Base and entropy spans of a text as ``array<struct<kind, place, start, end>>``.

    NULL counts as an empty text.
    """
    text = F.coalesce(text, F.lit(""))
    none = F.array().cast(f"array<{_SPAN}>")
    # The cheap tests come first: most texts hold nothing.
    assign = F.when(text.rlike("(?i)passw|secret|token|api_?key"), _found(
        text, "assign", ASSIGN, lambda hit: F.length(F.regexp_extract(hit, ASSIGN, 2)) >= LEAST["assign"]
    )).otherwise(none)
    access = F.when(text.contains("AKIA"), _found(text, "access", ACCESS, lambda hit: F.length(hit) >= LEAST["access"])).otherwise(none)
    # A run of 32 or more starts where any maximal run starts, so short runs need not be matched.
    long_hex = f"{HEX[:-1]}{{{LEAST['hex']},}}+"
    hexes = F.when(text.rlike(long_hex), _found(text, "hex", long_hex, lambda hit: F.lit(True))).otherwise(none)
    base = F.concat(assign, access, hexes)
    entropy = F.when(text.rlike(CANDIDATE), _found(text, "entropy", CANDIDATE, _is_secret)).otherwise(none)
    return base, entropy


def _joined(spans: Column) -> Column:
    ordered = F.array_sort(F.transform(spans, lambda s: F.struct(s.start, s.place, s.end, s.kind)))
    return F.concat_ws(",", F.transform(ordered, lambda s: F.concat_ws(":", s.kind, s.start.cast("string"), s.end.cast("string"))))


def with_spans(docs: DataFrame, text: str = "text", base: str = "_base", every: str = "_spans") -> DataFrame:
    """The rows with two more columns: the base spans and all spans. Names that ``docs`` has are replaced."""
    entropy = fresh("_entropy", [*docs.columns, base, every])
    of_base, of_entropy = spans(F.col(text))
    rows = docs.withColumns({base: of_base, entropy: of_entropy})
    added = F.filter(entropy, lambda e: ~F.exists(base, lambda b: (b.start <= e.start) & (e.end <= b.end)))
    return rows.withColumn(every, F.concat(base, added)).drop(entropy)


def scan(docs: DataFrame, id_column: str = "doc_id", text: str = "text") -> DataFrame:
    """Counts and places of the secrets of each row; rows with NULL ids are scanned like any other."""
    rows = with_spans(docs.select(F.col(id_column).cast("bigint").alias("doc_id"), F.col(text).alias("text")))
    count = lambda kind: F.size(F.filter("_base", lambda s: s.kind == kind)).cast("bigint")
    return rows.select(
        "doc_id", *[count(k).alias(f"n_{k}") for k in KINDS[:3]],
        (F.size("_spans") - F.size("_base")).cast("bigint").alias("n_entropy"),
        F.sha2(_joined(F.col("_base")), 256).alias("base_sha256"), _joined(F.col("_spans")).alias("spans"),
    )


def redact(docs: DataFrame, text: str = "text", mark: str = "[SECRET]") -> DataFrame:
    """The rows with every span of their text replaced by ``mark``; spans that overlap become one mark."""
    base, every = (fresh(name, docs.columns) for name in ("_base", "_spans"))
    rows = with_spans(docs, text, base, every)
    ordered = F.array_sort(F.transform(every, lambda s: F.struct(s.start.alias("start"), s.end.alias("end"))))
    begin = F.struct(F.lit(0).cast("bigint").alias("at"), F.array().cast("array<string>").alias("parts"))

    def step(state, s):
        before = F.substring(F.col(text), (state.at + 1).cast("int"), (s.start - state.at).cast("int"))
        further = F.struct(s.end.alias("at"), F.concat(state.parts, F.array(before, F.lit(mark))).alias("parts"))
        over = F.struct(F.greatest(state.at, s.end).alias("at"), state.parts.alias("parts"))
        return F.when(s.start >= state.at, further).otherwise(over)

    rest = lambda s: F.concat(F.concat_ws("", s.parts), F.substring(F.col(text), (s.at + 1).cast("int"), F.length(F.col(text))))
    clean = F.when(F.size(every) > 0, F.aggregate(ordered, begin, step, rest)).otherwise(F.col(text))
    return rows.withColumn(text, clean).select(docs.columns)
