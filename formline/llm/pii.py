"""Personal data: exact patterns, and a semi-Markov conditional random field for what they miss.

The field segments runs of suspicious tokens. Each candidate segment, up to ``LONGEST`` tokens, is
scored by features of the whole span, and dynamic programming chooses boundaries and types
together. There are no span labels, so it learns from the spans of the exact patterns in the corpus and
from rewritten copies of them ("name at host dot org", 00 for +, dotted groups).
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

KINDS = ("email", "ip", "card", "phone")
LONGEST = 8
#: Documents with base spans that a fit uses at most, drawn by hash of the id.
SAMPLE_ROWS = 2_000
#: Runs of one fit, and passes over them.
RUNS, PASSES = 3_000, 12

_AFTER_AT = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
# A match can only begin where a run of digits begins; possessive runs keep long ones linear.
_IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
_CARD = re.compile(r"(?<![0-9])[0-9](?:[ -]?[0-9])++")
_PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
_DIGIT = re.compile(r"[0-9]")


def _digits(s: str) -> list[int]:
    return [int(c) for c in s if "0" <= c <= "9"]


def luhn(digits: list[int]) -> bool:
    total = 0
    for i, d in enumerate(reversed(digits)):
        total += d if i % 2 == 0 else (2 * d - 9 if d > 4 else 2 * d)
    return total % 10 == 0


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """``(start, kind, end)`` of the exact patterns, ordered."""
    out, past, at = [], 0, text.find("@")
    while at >= 0:
        start = at
        while start > past and text[start - 1] in _LOCAL:
            start -= 1
        match = _AFTER_AT.match(text, at + 1) if start < at else None
        if match:
            out.append((start, 0, match.end()))
            past = match.end()
        else:
            past = at + 1
        at = text.find("@", past)
    if _DIGIT.search(text):
        for m in _IP.finditer(text):
            if all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or 0) <= 255 for p in m[0].split(".")):
                out.append((m.start(), 1, m.end()))
        for m in _CARD.finditer(text):
            if m.end() - m.start() <= 38 and 12 <= len(d := _digits(m[0])) <= 19 and luhn(d):
                out.append((m.start(), 2, m.end()))
        if "+" in text:
            for m in _PHONE.finditer(text):
                if 9 <= len(_digits(m[0])) <= 15:
                    out.append((m.start(), 3, m.end()))
    return sorted(out)


_TOKEN = re.compile(r"[^\s]+")
_JOIN = re.compile(r"\W*(?:at|dot)\W*", re.I)
_EDGE = " \t\r\n.,;:!?\"'<>|#*$%&="
_FEATURES = (
    "bias", "tokens", "email", "email words", "dots3", "octets", "luhn", "plus", "zeros", "bracket", "hyphen", "d<7", "d7-8",
    "d9-11", "d12-15", "d16", "d17-19", "d>19", "letters", "one run", "dotted", "key mail", "key call", "key card", "key ip", "uneven",
)
_KEYS = tuple(re.compile(p, re.I) for p in (r"mail|contact|write", r"tel|phone|call|mobil|fax", r"card|visa|account", r"\bip\b|host|server|addr"))
_WORDY = re.compile(r"[\w.%+-]+\W+at\W+[\w-]+(?:(?:\W+dot\W+|\.)[\w-]+)+", re.I)
#: What a wordy address without "dot" can't lack; no segment is longer than 80 characters.
_AT_HOST = re.compile(r"\Wat\W{1,80}[\w-]{1,80}\.[\w-]", re.I)
_PLAIN = re.compile(r"[\w.%+-]+@[\w-]+(?:\.[\w-]+)+")


def _trim(text: str, start: int, end: int) -> tuple[int, int]:
    while start < end and text[start] in _EDGE:
        start += 1
    while end > start and text[end - 1] in _EDGE:
        end -= 1
    return start, end


def runs(text: str) -> Iterator[list[tuple[int, int]]]:
    """Maximal runs of tokens that hold a digit or an at sign, or join such ("at", "dot") with their neighbours."""
    # Cheap test first: most texts have none of these, and no segment can be an entity without one.
    if not _DIGIT.search(text) and "@" not in text and not re.search(r"(?i)\bdot\b", text) and not _AT_HOST.search(text):
        return
    tokens = [m.span() for m in _TOKEN.finditer(text)]
    hot = np.zeros(len(tokens), bool)
    for i, (a, b) in enumerate(tokens):
        token = text[a:b]
        if "@" in token or _DIGIT.search(token):
            hot[i] = True
        elif b - a <= 7 and _JOIN.fullmatch(token):
            hot[max(0, i - 1) : i + 2] = True
    at = np.flatnonzero(hot)
    for part in np.split(at, np.flatnonzero(np.diff(at) > 1) + 1) if len(at) else []:
        yield [tokens[i] for i in part]


def span_features(text: str, start: int, end: int, tokens: int, before: str) -> np.ndarray | None:
    """Features of a whole segment, or None where it can't be an entity."""
    span = text[start:end]
    d = _digits(span)
    plain, wordy = bool(_PLAIN.fullmatch(span)), tokens > 1 and bool(_WORDY.fullmatch(span))
    parts = re.split(r"[^0-9]+", span)
    dots = span.count(".") == 3 and len([p for p in parts if p]) == 4
    # Years, times and counts have fewer digits than any number that reaches a person.
    if end - start > 80 or (len(d) < 7 and not plain and not wordy and not dots):
        return None
    f = np.zeros(len(_FEATURES))
    n = len(d)
    groups = [len(p) for p in parts if p]
    f[:21] = (
        1, tokens > 1, plain, wordy, dots, dots and all(len(p) <= 3 and int(p) <= 255 for p in parts if p), 12 <= n <= 19 and luhn(d),
        span[0] == "+", span.startswith("00"), "(" in span, "-" in span, n < 7, 7 <= n <= 8, 9 <= n <= 11, 12 <= n <= 15, n == 16,
        17 <= n <= 19, n > 19, any(c.isalpha() for c in span), len(groups) == 1, "." in span,
    )
    f[21:25] = [bool(k.search(before)) for k in _KEYS]
    f[25] = len(set(groups)) > 1
    return f


class Field:
    """Weights per type of entity; tokens outside score 0."""

    def __init__(self, weights: np.ndarray):
        self.weights = weights

    def lattice(self, text: str, tokens: list[tuple[int, int]]) -> list[tuple[int, int, int, int, np.ndarray]]:
        """Candidate segments ``(first token, end token, start, end, features)``."""
        out = []
        for i, (a, _) in enumerate(tokens):
            before = text[max(0, a - 24) : a]
            for j in range(i, min(i + LONGEST, len(tokens))):
                start, end = _trim(text, a, tokens[j][1])
                if start < end and (f := span_features(text, start, end, j - i + 1, before)) is not None:
                    out.append((i, j + 1, start, end, f))
        return out

    def best(self, text: str, tokens: list[tuple[int, int]]) -> list[tuple[int, int, int]]:
        """The segments ``(start, kind, end)`` of the best segmentation."""
        segments = self.lattice(text, tokens)
        if not segments:
            return []
        scores = np.array([s[4] for s in segments]) @ self.weights.T
        ending: dict[int, list[int]] = {}
        for k, s in enumerate(segments):
            ending.setdefault(s[1], []).append(k)
        value, back = [0.0], [None]
        for t in range(1, len(tokens) + 1):
            top, by = value[t - 1], None
            for k in ending.get(t, ()):
                kind = int(scores[k].argmax())
                if value[segments[k][0]] + scores[k, kind] > top:
                    top, by = value[segments[k][0]] + scores[k, kind], (k, kind)
            value.append(top)
            back.append(by)
        out, t = [], len(tokens)
        while t:
            if back[t] is None:
                t -= 1
                continue
            k, kind = back[t]
            out.append((segments[k][2], kind, segments[k][3]))
            t = segments[k][0]
        return out[::-1]


def _gradient(weights, segments, n_tokens, gold) -> np.ndarray:
    """Expected minus observed features of one run, by the forward and backward sums over segmentations."""
    features = np.array([s[4] for s in segments])
    scores = features @ weights.T
    forward = np.full(n_tokens + 1, -np.inf)
    forward[0] = 0
    total = np.logaddexp.reduce(scores, axis=1)
    starting: list[list[int]] = [[] for _ in range(n_tokens + 1)]
    for k, s in enumerate(segments):
        starting[s[0]].append(k)
    for t in range(n_tokens):
        forward[t + 1] = np.logaddexp(forward[t + 1], forward[t])
        for k in starting[t]:
            e = segments[k][1]
            forward[e] = np.logaddexp(forward[e], forward[t] + total[k])
    backward = np.full(n_tokens + 1, -np.inf)
    backward[n_tokens] = 0
    for t in range(n_tokens - 1, -1, -1):
        backward[t] = backward[t + 1]
        for k in starting[t]:
            backward[t] = np.logaddexp(backward[t], total[k] + backward[segments[k][1]])
    begin, end = np.array([s[0] for s in segments]), np.array([s[1] for s in segments])
    chance = np.exp(forward[begin][:, None] + scores + backward[end][:, None] - forward[n_tokens])
    for k, kind in gold:
        chance[k, kind] -= 1
    return chance.T @ features


def _rewritten(text: str, spans: list[tuple[int, int, int]], draw: np.random.Generator) -> tuple[str, list[tuple[int, int, int]]]:
    """The text with its base spans written as people write them to be read by people only."""
    out, marks, past, moved = [], [], 0, 0
    for start, kind, end in spans:
        if start < past:
            continue
        span = text[start:end]
        if kind == 0:
            at, dot = ((" at ", " dot "), (" [at] ", " [dot] "), (" (at) ", "."))[draw.integers(3)]
            span = span.replace("@", at).replace(".", dot) if dot != "." else span.replace("@", at)
        elif kind == 3:
            span = "00" + span[1:] if draw.random() < 0.5 else span.replace(" ", ".").replace("-", ".")
        elif kind == 2:
            span = span.replace(" ", ".").replace("-", ".")
        out += [text[past:start], span]
        begin = start + moved
        moved += len(span) - (end - start)
        marks.append((begin, kind, end + moved))
        past = end
    out.append(text[past:])
    return "".join(out), marks


def fit_texts(texts: list[str]) -> Field:
    """Maximum likelihood with a quadratic penalty, by Adagrad over runs of the texts and of their rewritten copies."""
    draw, field = np.random.default_rng(11), Field(np.zeros((len(KINDS), len(_FEATURES))))
    examples = []
    for text in texts:
        spans = base_spans(text)
        for sample, marks in ((text, spans), _rewritten(text, spans, draw)):
            wanted = {(s, e): k for s, k, e in marks}
            for tokens in runs(sample):
                if len(examples) < RUNS and len(tokens) <= 60 and (segments := field.lattice(sample, tokens)):
                    gold, upto = [], 0
                    for k, s in enumerate(segments):
                        kind = wanted.get((s[2], s[3]))
                        if kind is not None and s[0] >= upto:
                            gold.append((k, kind))
                            upto = s[1]
                    examples.append((segments, len(tokens), gold))
    squares = np.full_like(field.weights, 1e-3)
    for _ in range(PASSES):
        for i in draw.permutation(len(examples)):
            g = _gradient(field.weights, *examples[i]) + 1e-4 * field.weights
            squares += g * g
            field.weights -= 0.3 * g / np.sqrt(squares)
    if not examples:
        field.weights[:, 0] = -1.0
    return field


def fit(docs: DataFrame, rows: int = SAMPLE_ROWS, id_column: str = "doc_id", text: str = "text") -> Field:
    """A field from at most ``rows`` lines with base spans (the lines, not the texts, come to the driver)."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            out = []
            for value in batch["text"]:
                for a, _, b in base_spans(value or ""):
                    line = value[max(0, a - 120) : b + 120]
                    out.append((hashlib.md5(line.encode()).hexdigest(), line))
            # Of the batch, the lines that can be among the first of all.
            yield pd.DataFrame(sorted(set(out))[:rows], columns=["draw", "line"])

    lines = docs.select(F.col(text).alias("text")).where(F.col("text").rlike("[0-9@]")).mapInPandas(run, "draw string, line string")
    sample = lines.distinct().orderBy("draw", "line").limit(rows).collect()
    return fit_texts([r.line for r in sample])


def find(text: str, field: Field) -> tuple[list, list]:
    """Base spans, and spans of the field that touch none of them."""
    base, added = base_spans(text), []
    taken = sorted((s, e) for s, _, e in base)
    starts = np.array([s for s, _ in taken], np.int64)
    # Base spans of different kinds may overlap; the furthest end so far decides.
    ends = np.maximum.accumulate(np.array([e for _, e in taken], np.int64)) if taken else starts
    for tokens in runs(text):
        for s, kind, e in field.best(text, tokens):
            before = int(np.searchsorted(starts, e))
            if not before or ends[before - 1] <= s:
                added.append((s, len(KINDS) + kind, e))
    return base, added


def _written(spans: list[tuple[int, int, int]]) -> str:
    names = (*KINDS, *(f"{k}_like" for k in KINDS))
    return ",".join(f"{names[k]}:{s}:{e}" for s, k, e in sorted(spans))


def scan(docs: DataFrame, field: Field, id_column: str = "doc_id", text: str = "text") -> DataFrame:
    """Counts and places of personal data of each row; a NULL text counts as empty, rows with NULL ids as any other."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            out = []
            for value in batch["text"]:
                base, added = find(value or "", field)
                kinds = [k for _, k, _ in base]
                out.append((*[kinds.count(k) for k in range(4)], len(added), hashlib.sha256(_written(base).encode()).hexdigest(), _written(base + added)))
            done = pd.DataFrame(out, columns=[*[f"n_{k}" for k in KINDS], "n_added", "base_sha256", "spans"])
            done.insert(0, "doc_id", batch["doc_id"].astype("Int64").array)
            yield done

    plain = docs.select(F.col(id_column).cast("bigint").alias("doc_id"), F.col(text).alias("text"))
    return plain.mapInPandas(run, "doc_id bigint, n_email bigint, n_ip bigint, n_card bigint, n_phone bigint, n_added bigint, base_sha256 string, spans string")


def redact(docs: DataFrame, field: Field, text: str = "text") -> DataFrame:
    """The rows with every span of their text replaced by its kind in brackets; overlapping spans become one."""
    names = [k.upper() for k in KINDS] * 2

    @F.pandas_udf("string")
    def clean(texts: pd.Series) -> pd.Series:
        done = []
        for value in texts:
            base, added = find(value or "", field)
            parts, past = [], 0
            for s, k, e in sorted(base + added):
                if s >= past:
                    parts += [value[past:s], f"[{names[k]}]"]
                past = max(past, e)
            done.append(value if not parts else "".join(parts) + value[past:])
        return pd.Series(done, dtype=object)

    return docs.withColumn(text, clean(F.col(text)))


def detect(docs: DataFrame) -> DataFrame:
    """Fit the field on a bounded sample, then scan all rows."""
    return scan(docs, fit(docs))
