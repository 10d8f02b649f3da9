"""Quality of documents as strengths of a Bradley-Terry model over surface features."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, replace

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from formline.llm.common import BROADCAST_IDS, held_out, only

#: Labelled rows that a fit uses at most, drawn by hash of the id.
SAMPLE_ROWS = 20_000
#: Preference pairs of one pass over the sample, and passes.
PAIRS, PASSES = 20_000, 60
CUT_SCORE = 0.7
#: The cut is found in counts of strengths by bins a ``BINS``-th wide; strengths beyond ``LARGEST`` share the last bins,
#: so at most 16,386 bins a label reach the driver.
BINS, LARGEST = 128, 64

_CLASS = np.zeros(256, np.int64)
for _i, _members in enumerate((b"abcdefghijklmnopqrstuvwxyz", b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"0123456789", b" \t\r\v\f", b"\n", b".,;:'\"()?-", b"!", b"#*$%&|<>", b"")):
    _CLASS[list(_members)] = _i + 1
_CLASS[128:] = 9


def features(text: str | None) -> np.ndarray:
    """Shares of character classes, word shape and repetition over the whole text."""
    text = text or ""
    data = text.encode()
    size = max(len(data), 1)
    share = np.bincount(_CLASS[np.frombuffer(data, np.uint8)], minlength=10) / size
    words = data.split()
    n = max(len(words), 1)
    lengths = np.fromiter(map(len, words), np.int64, len(words)) if words else np.zeros(1, np.int64)
    lines = [x for x in data.split(b"\n") if x.strip()]
    triples = list(zip(words, words[1:], words[2:], strict=False))
    repeated = 1 - len(set(triples)) / max(len(triples), 1) if triples else 0.0
    upper = sum(map(bytes.isupper, words)) / n
    once = len(set(words)) / n
    odd = sum(not w[-1:].isalpha() and w[-1] < 128 and w[-1:] not in b".,;:)\"'?-" for w in words) / n
    basic = [
        *share, upper, repeated, odd, once, lengths.mean() / 10, lengths.std() / 10,
        1 - len(set(lines)) / max(len(lines), 1), n / max(len(lines), 1) / 100, (lengths == 1).mean(), float(not words),
    ]
    extra = [np.sqrt(max(x, 0)) for x in (share[2], share[3], share[7], share[8], upper, repeated, odd, basic[16])]
    return np.array([*basic, *extra, np.log1p(n) / 10, np.log1p(n) ** 2 / 100], np.float64)


N_FEATURES = len(features(""))


@dataclass(frozen=True)
class Strength:
    """Weights on standardized features and the strength at the cut."""

    centre: np.ndarray
    scale: np.ndarray
    weights: np.ndarray
    cut: float

    def strengths(self, x: np.ndarray) -> np.ndarray:
        return np.clip((x - self.centre) / self.scale, -8, 8) @ self.weights

    def scores(self, x: np.ndarray) -> np.ndarray:
        """0 to 1; a strength at the cut gets exactly ``CUT_SCORE``."""
        strength = self.strengths(x) - self.cut
        return 1 / (1 + np.exp(-np.clip(strength + np.log(CUT_SCORE / (1 - CUT_SCORE)), -35, 35)))


def fit_pairs(x: np.ndarray, label: np.ndarray, seed: int = 5) -> Strength:
    """Logistic loss on feature differences of (better, worse) pairs, then a cut by score quantile.

    The cut is the quantile of the given strengths at the share of label 0; ``fit`` moves it to that of all labelled rows. With one label only
    there are no pairs: all documents then score on the side of that label.
    """
    if not len(x):
        x, label = np.zeros((1, N_FEATURES)), np.zeros(1)
    centre, scale = x.mean(0), np.maximum(x.std(0), 1e-6)
    z, good, bad = np.clip((x - centre) / scale, -8, 8), np.flatnonzero(label == 1), np.flatnonzero(label == 0)
    w = np.zeros(x.shape[1])
    if not len(good) or not len(bad):
        return Strength(centre, scale, w, -2.0 if len(good) else 2.0)
    draw, m, v = np.random.default_rng(seed), np.zeros_like(w), np.zeros_like(w)
    step = 0
    for _ in range(PASSES):
        a, b = draw.choice(good, PAIRS), draw.choice(bad, PAIRS)
        for i in range(0, PAIRS, 2000):
            d = z[a[i : i + 2000]] - z[b[i : i + 2000]]
            g = -(d * (1 / (1 + np.exp(d @ w)))[:, None]).mean(0) + 1e-4 * w
            step += 1
            m, v = 0.9 * m + 0.1 * g, 0.999 * v + 0.001 * g * g
            w -= 0.03 * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.999**step)) + 1e-8)
    strength = np.sort(z @ w)
    at = min(max(len(bad), 1), len(x) - 1)
    return Strength(centre, scale, w, float((strength[at - 1] + strength[at]) / 2))


def _with_features(docs: DataFrame, id_column: str, text: str) -> DataFrame:
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            yield pd.DataFrame({"doc_id": batch["doc_id"].astype("Int64"), "features": [features(t) for t in batch["text"]]})

    return docs.select(F.col(id_column).cast("bigint").alias("doc_id"), F.col(text).alias("text")).mapInPandas(run, "doc_id bigint, features array<double>")


def quantile_of_counts(bins: np.ndarray, counts: np.ndarray, below: float) -> float:
    """The strength that ``below`` of the counted ones lie under, taken as spread evenly within their bin."""
    order = np.argsort(bins)
    bins, ends = bins[order], np.cumsum(counts[order])
    i = min(int(np.searchsorted(ends, below)), len(bins) - 1)
    start = ends[i] - counts[order][i]
    return float((bins[i] + np.clip((below - start) / counts[order][i], 0, 1)) / BINS)


def _cut(plain: DataFrame, known: DataFrame, model: Strength) -> Strength:
    """The model with its cut at the share of label 0 among the strengths of all labelled rows.

    Strengths are counted by bin where they arise, so partial counts merge and only the counts of bins leave the tasks.
    """

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            if len(batch):
                strength = model.strengths(np.array([features(t) for t in batch["text"]]))
                place = np.floor(np.clip(strength, -LARGEST, LARGEST) * BINS).astype(np.int32)
                yield pd.DataFrame({"doc_id": batch["doc_id"], "bin": place})

    ids = known.select("doc_id").distinct()
    few = ids.limit(BROADCAST_IDS + 1).count() <= BROADCAST_IDS
    # Where the ids are too many to send, texts stay where they are and their bins go to the labels.
    texts = plain.join(F.broadcast(ids), "doc_id", "left_semi") if few else plain.where("doc_id is not null")
    met = texts.mapInPandas(run, "doc_id bigint, bin int").join(known, "doc_id")
    counted = met.groupBy("bin").agg(F.count(F.lit(1)).alias("n"), F.count_if(F.col("label") == 0).alias("bad")).collect()
    if not counted:
        return model
    bins, n, bad = (np.array(c, np.float64) for c in zip(*counted, strict=True))
    return replace(model, cut=quantile_of_counts(bins, n, bad.sum()))


def fit(docs: DataFrame, labels: DataFrame, rows: int = SAMPLE_ROWS, id_column: str = "doc_id", label: str = "quality", text: str = "text") -> Strength:
    """A model of the labelled documents outside the held-out fold.

    Weights come from at most ``rows`` labels, drawn by hash of the id, and the cut from all of them. Rows without an id
    or with a label other than 0 and 1 have no part. Of documents that share an id the weights take one, the one with
    the least features, and the cut takes each; each label row of an id counts.
    """
    known = labels.where(~held_out(id_column, 4, 2)).select(F.col(id_column).cast("bigint").alias("doc_id"), F.col(label).cast("int").alias("label"))
    known = known.where("doc_id is not null and label in (0, 1)")
    chosen = known.orderBy(F.xxhash64("doc_id"), "doc_id", "label").limit(rows)
    # The sample is bounded, so it is gathered once and the texts come to it.
    sample = pd.DataFrame([tuple(r) for r in chosen.collect()], columns=["doc_id", "label"])
    if not len(sample):
        return fit_pairs(np.empty((0, N_FEATURES)), np.empty(0))
    ids = docs.sparkSession.createDataFrame(sample[["doc_id"]].drop_duplicates(), "doc_id bigint")
    plain = docs.select(F.col(id_column).cast("bigint").alias("doc_id"), F.col(text).alias("text"))
    one = _with_features(only(plain, ids, "doc_id"), "doc_id", "text").groupBy("doc_id").agg(F.min("features").alias("features"))
    found = pd.DataFrame([tuple(r) for r in one.collect()], columns=["doc_id", "features"])
    both = found.merge(sample, on="doc_id").sort_values(["doc_id", "label"])
    x = np.array(both["features"].to_list(), float).reshape(-1, N_FEATURES)
    model = fit_pairs(x, both["label"].to_numpy())
    return _cut(plain, known, model) if model.weights.any() else model


def score(docs: DataFrame, model: Strength, id_column: str = "doc_id", text: str = "text") -> DataFrame:
    """``(doc_id, held_out, score, predicted)`` of every row; NULL and empty texts are scored by their (empty) features.

    Rows without an id or with a repeated one are scored like any other; without an id a row isn't held out.
    """

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            if len(batch):
                x = np.array([features(t) for t in batch["text"]])
                yield pd.DataFrame({"doc_id": batch["doc_id"].astype("Int64"), "score": model.scores(x)})

    plain = docs.select(F.col(id_column).cast("bigint").alias("doc_id"), F.col(text).alias("text"))
    scored = plain.mapInPandas(run, "doc_id bigint, score double")
    return scored.select("doc_id", held_out("doc_id", 4, 2).alias("held_out"), "score", (F.col("score") >= CUT_SCORE).cast("int").alias("predicted"))


def classify(docs: DataFrame, labels: DataFrame, **options) -> DataFrame:
    """Fit on the labelled documents outside the fold, then score all; see ``fit`` and ``score``."""
    return score(docs, fit(docs, labels, **options))


def accepted(docs: DataFrame, model: Strength, text: str = "text") -> DataFrame:
    """The rows, with all their columns, that the model predicts to be good."""

    @F.pandas_udf("double")
    def scored(texts: pd.Series) -> pd.Series:
        return pd.Series(model.scores(np.array([features(t) for t in texts]).reshape(-1, N_FEATURES)))

    return docs.where(scored(F.col(text)) >= CUT_SCORE)
