"""Toxic documents and their sentences by multiple-instance learning with a noisy-or of sentence scores."""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass
from functools import cached_property, lru_cache

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from formline.llm.common import held_out, only

#: Labelled rows that a fit uses at most, drawn by hash of the id.
SAMPLE_ROWS = 6_000
SLOTS = 1 << 22
#: A word counts as itself and by its beginnings of these lengths, so that forms of a word share weight.
BEGINNINGS = (4, 5)
#: Pull of weights towards zero.
PENALTY = 2e-5
#: Words of fewer documents of the sample have no weight.
LEAST_DOCS = 8
PASSES = 120

_END = re.compile(r"[.!?\n]+")
_WORD = re.compile(r"[^\W\d_]+")


def sentences(text: str) -> list[tuple[int, int]]:
    """Bounds of the sentences of a text that hold more than white space."""
    out, start = [], 0
    for end in [m.end() for m in _END.finditer(text)] + [len(text)]:
        if text[start:end].strip():
            out.append((start, end))
        start = end
    return out


@lru_cache(400_000)
def _slots_of(word: str) -> tuple[int, ...]:
    parts = [word, *(f"{n}{word[:n]}" for n in BEGINNINGS if len(word) >= n)]
    return tuple(xxhash.xxh3_64_intdigest(p) % SLOTS for p in parts)


def slots(text: str | None) -> tuple[np.ndarray, np.ndarray]:
    """Hashed words of a text and the index of the first word of each sentence with words."""
    found, starts = [], []
    text = text or ""
    for a, b in sentences(text):
        words = set(_WORD.findall(text[a:b].lower()))
        if words:
            starts.append(len(found))
            found += {slot for w in words for slot in _slots_of(w)}
    return np.array(found, np.int32), np.array(starts, np.int64)


@dataclass(frozen=True)
class Noisy:
    """Weights of the slots that have any, the bias of a sentence, and the chance of a text without words."""

    used: np.ndarray
    values: np.ndarray
    bias: float
    empty: float

    @cached_property
    def weights(self) -> np.ndarray:
        """By slot; built where it is used, so only the slots with weight travel."""
        dense = np.zeros(SLOTS, np.float32)
        dense[self.used] = self.values
        return dense

    def __getstate__(self) -> dict:
        return {k: v for k, v in self.__dict__.items() if k != "weights"}

    def sentence_scores(self, words: np.ndarray, starts: np.ndarray) -> np.ndarray:
        if not len(starts):
            return np.empty(0)
        z = np.add.reduceat(self.weights[words], starts) + self.bias
        return 1 / (1 + np.exp(-np.clip(z, -30, 30)))

    def judge(self, text: str | None, least: float = 0.5) -> tuple[float, list[tuple[int, int, float]]]:
        """The chance that any sentence is toxic, and the sentences ``(start, end, score)`` to blame.

        To blame are those that score ``least`` or more; where the text as a whole does and none of them alone, the
        first of the likeliest.
        """
        each = self.sentence_scores(*slots(text))
        if not len(each):
            return self.empty, []
        total = float(1 - np.prod(1 - each))
        if total < least:
            return total, []
        bounds = [(a, b) for a, b in sentences(text or "") if _WORD.search(text[a:b])]
        blamed = np.flatnonzero(each >= min(least, each.max()))
        if each.max() < least:
            blamed = blamed[:1]
        return total, [(*bounds[i], float(each[i])) for i in blamed]


def fit_bags(bags: list[tuple[np.ndarray, np.ndarray]], label: np.ndarray) -> Noisy:
    """Weights that make the noisy-or of the sentences fit the documents' labels, by Adam on the logistic loss.

    Only the label of the document is known; the noisy-or lets the likeliest sentences explain it.
    With fewer than two labels all sentences get the share of label 1 as chance (or nearly 0). Texts without words get the
    share of label 1 among such texts, drawn towards that among all as by one more text; 0 where nothing is labelled.
    """
    keep = [i for i, (w, s) in enumerate(bags) if len(s)]
    share = float(label.mean()) if len(label) else 0.0
    wordless = np.delete(label, keep)
    empty = (float(wordless.sum()) + share) / (len(wordless) + 1)
    label = label[keep].astype(float)
    if not len(label) or label.min() == label.max():
        return Noisy(np.zeros(0, np.int64), np.zeros(0, np.float32), 30.0 if len(label) and label.max() == 1 else -30.0, empty)
    words = np.concatenate([bags[i][0] for i in keep])
    n_words = np.array([len(bags[i][0]) for i in keep])
    n_sentences = np.array([len(bags[i][1]) for i in keep])
    first_word = np.concatenate([[0], np.cumsum(n_words)[:-1]])
    starts = np.concatenate([bags[i][1] + at for i, at in zip(keep, first_word, strict=True)])
    first_sentence = np.concatenate([[0], np.cumsum(n_sentences)[:-1]])
    # Words of few documents are noise here: only frequent ones are numbered and learned.
    seen = np.concatenate([np.unique(bags[i][0]) for i in keep])
    used = np.flatnonzero(np.bincount(seen, minlength=SLOTS) >= LEAST_DOCS)
    number = np.full(SLOTS, len(used), np.int32)
    number[used] = np.arange(len(used))
    at = number[words]
    sentence = np.repeat(np.arange(len(starts), dtype=np.int32), np.diff(np.append(starts, len(words))))
    known = at < len(used)
    at, sentence_of = at[known], sentence[known]
    owner = np.repeat(np.arange(len(keep)), n_sentences)
    w, bias = np.zeros(len(used) + 1), float(np.log(label.mean() / n_sentences.mean()))
    m, v = np.zeros(len(used) + 1), np.zeros(len(used) + 1)
    for step in range(1, PASSES + 1):
        z = np.bincount(sentence_of, weights=w[at], minlength=len(starts)) + bias
        p = 1 / (1 + np.exp(-np.clip(z, -30, 30)))
        none = np.add.reduceat(np.log1p(-np.minimum(p, 1 - 1e-9)), first_sentence)
        chance = np.clip(1 - np.exp(none), 1e-9, 1)
        # d(-log likelihood)/dz: p for label 0, -p (1 - P) / P for label 1.
        slope = np.where(label == 1, -(1 - chance) / chance, 1.0)[owner] * p / len(label)
        g = np.append(np.bincount(at, weights=slope[sentence_of], minlength=len(used)) + PENALTY * w[:-1], slope.sum())
        m, v = 0.9 * m + 0.1 * g, 0.99 * v + 0.01 * g * g
        change = 0.15 * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.99**step)) + 1e-7)
        # Words only speak for toxicity: else a long harmless rest of the sentence would outweigh them.
        w[:-1] = np.maximum(w[:-1] - change[:-1], 0)
        bias -= change[-1]
    some = w[:-1] > 0
    return Noisy(used[some], w[:-1][some].astype(np.float32), float(bias), empty)


def fit(docs: DataFrame, labels: DataFrame, rows: int = SAMPLE_ROWS, id_column: str = "doc_id", label: str = "toxic", text: str = "text") -> Noisy:
    """A model of at most ``rows`` labels outside the held-out fold, drawn by hash of the id.

    Rows without an id or with a label other than 0 and 1 have no part. Of documents that share an id the fit takes one,
    the one with the least hashed words; each label row of an id counts.
    """
    chosen = labels.where(~held_out(id_column, 5, 0)).select(F.col(id_column).cast("bigint").alias("doc_id"), F.col(label).cast("int").alias("label"))
    chosen = chosen.where("doc_id is not null and label in (0, 1)").orderBy(F.xxhash64("doc_id"), "doc_id", "label").limit(rows)
    known = pd.DataFrame([tuple(r) for r in chosen.collect()], columns=["doc_id", "label"])
    if not len(known):
        return fit_bags([], np.empty(0))

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            done = [slots(t) for t in batch["text"]]
            yield pd.DataFrame({"doc_id": batch["doc_id"], "words": [w.tobytes() for w, _ in done], "starts": [s.tobytes() for _, s in done]})

    # Bounded by ``rows``: the sample is gathered once, as hashed words.
    ids = docs.sparkSession.createDataFrame(known[["doc_id"]].drop_duplicates(), "doc_id bigint")
    plain = docs.select(F.col(id_column).cast("bigint").alias("doc_id"), F.col(text).alias("text"))
    each = only(plain, ids, "doc_id").mapInPandas(run, "doc_id bigint, words binary, starts binary")
    found = each.groupBy("doc_id").agg(F.min(F.struct("words", "starts")).alias("bag")).select("doc_id", "bag.*").collect()
    both = pd.DataFrame([tuple(r) for r in found], columns=["doc_id", "words", "starts"]).merge(known, on="doc_id")
    both = both.sort_values(["doc_id", "label"])
    bags = [(np.frombuffer(w, np.int32), np.frombuffer(s, np.int64)) for w, s in zip(both["words"], both["starts"], strict=True)]
    return fit_bags(bags, both["label"].to_numpy())


def score(docs: DataFrame, model: Noisy, id_column: str = "doc_id", text: str = "text") -> DataFrame:
    """``(doc_id, held_out, score, predicted, offending)`` of every row; texts without words get the model's chance for such.

    ``offending`` names the sentences to blame as ``start:end``, in code points, joined by commas; it is empty where the
    score is below one half. Rows without an id or with a repeated one are scored like any other.
    """
    sent = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            done = [sent.value.judge(t) for t in batch["text"]]
            yield pd.DataFrame({
                "doc_id": batch["doc_id"].astype("Int64"), "score": [p for p, _ in done],
                "offending": [",".join(f"{a}:{b}" for a, b, _ in blamed) for _, blamed in done],
            })

    plain = docs.select(F.col(id_column).cast("bigint").alias("doc_id"), F.col(text).alias("text"))
    scored = plain.mapInPandas(run, "doc_id bigint, score double, offending string")
    return scored.select(
        "doc_id", held_out("doc_id", 5, 0).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"), "offending"
    )


def offending(docs: DataFrame, model: Noisy, least: float = 0.5, id_column: str = "doc_id", text: str = "text") -> DataFrame:
    """``(doc_id, start, end, score)``: the sentences, in code points, to blame for a text that scores ``least`` or more."""
    sent = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            out = [(i, *s) for i, t in zip(batch["doc_id"], batch["text"], strict=True) for s in sent.value.judge(t, least)[1]]
            yield pd.DataFrame(out, columns=["doc_id", "start", "end", "score"]).astype({"doc_id": "Int64"})

    plain = docs.select(F.col(id_column).cast("bigint").alias("doc_id"), F.col(text).alias("text"))
    return plain.mapInPandas(run, "doc_id bigint, start bigint, end bigint, score double")


def classify(docs: DataFrame, labels: DataFrame, **options) -> DataFrame:
    """Fit on the labelled documents outside the fold, then score all; see ``fit`` and ``score``."""
    return score(docs, fit(docs, labels, **options))
