"""Language of texts by hyperdimensional letter profiles."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from formline.llm.common import held_out

WIDTH = 1024
GRAM = 3
#: Letters beyond a-z and the gap between words share the rest of these codes by their code point.
CODES = 64
UNKNOWN = "und"

_draw = np.random.default_rng(64)
_LETTERS = _draw.choice(np.array([-1.0, 1.0], np.float32), (CODES, WIDTH))
#: Letter vectors permuted (rolled) by their place in the n-gram.
_PLACED = [np.roll(_LETTERS, GRAM - 1 - i, axis=1) for i in range(GRAM)]


def _table() -> np.ndarray:
    """The code of each code point of the first plane: 0 for what isn't a letter."""
    code = np.zeros(0x10000, np.int64)
    for point in range(0x10000):
        letter = chr(point)
        if letter.isalpha():
            code[point] = point - 96 if "a" <= letter <= "z" else 27 + point % (CODES - 27)
    return code


_CODE = _table()


def grams(text: str) -> np.ndarray:
    """Numbers of the letter n-grams of a text, words set apart by one gap; empty without letters."""
    points = np.frombuffer(text.lower().encode("utf-32-le", "surrogatepass"), np.uint32)
    letters = _CODE[np.minimum(points, 0xFFFF)]
    high = np.flatnonzero(points >= 0x10000)
    if len(high):
        # Letters of the further planes share the codes of other letters; emoji and other signs are none.
        found = {p: 27 + p % (CODES - 27) if chr(p).isalpha() else 0 for p in np.unique(points[high]).tolist()}
        letters[high] = [found[p] for p in points[high].tolist()]
    gap = letters == 0
    letters = np.concatenate([[0], letters[~gap | np.append(True, ~gap[:-1])], [0]])
    if not letters.any():
        return np.empty(0, np.int64)
    return (letters[:-2] * CODES + letters[1:-1]) * CODES + letters[2:]


def bound(numbers: np.ndarray) -> np.ndarray:
    """The vectors of n-grams: the product of their letters' vectors, each permuted by its place."""
    first, second, third = numbers // (CODES * CODES), numbers // CODES % CODES, numbers % CODES
    return _PLACED[0][first] * _PLACED[1][second] * _PLACED[2][third]


@dataclass(frozen=True)
class Prototypes:
    names: tuple[str, ...]
    vectors: np.ndarray  # unit rows


def fit(docs: DataFrame, id_column: str = "doc_id", text: str = "text", lang: str = "lang") -> Prototypes:
    """A prototype per language: the bundle (sum) of the vectors of all its documents outside the fold.

    Tasks add up n-gram counts per language and send one vector per language each; the driver gets
    one row per language.
    """

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        totals: dict[str, np.ndarray] = {}
        for batch in batches:
            for name, texts in batch.groupby("lang")["text"]:
                total = totals.setdefault(name, np.zeros(CODES**GRAM, np.int64))
                for value in texts:
                    numbers, times = np.unique(grams(value), return_counts=True)
                    total[numbers] += times
        for name, total in totals.items():
            used = np.flatnonzero(total)
            vector = np.zeros(WIDTH)
            for i in range(0, len(used), 4096):
                part = used[i : i + 4096]
                vector += total[part].astype(np.float64) @ bound(part).astype(np.float64)
            yield pd.DataFrame({"lang": name, "place": np.arange(WIDTH), "value": vector})

    known = docs.where(~held_out(id_column, 4, 2)).select(F.col(lang).alias("lang"), F.col(text).alias("text")).where("lang is not null and text is not null")
    sums = known.mapInPandas(run, "lang string, place int, value double").groupBy("lang", "place").agg(F.sum("value").alias("value"))
    rows = sums.groupBy("lang").agg(F.sort_array(F.collect_list(F.struct("place", "value"))).alias("v")).select("lang", "v.value").collect()
    rows = sorted((r.lang, r.value) for r in rows if any(r.value))
    vectors = np.array([v for _, v in rows]).reshape(-1, WIDTH)
    return Prototypes(tuple(n for n, _ in rows), (vectors / np.linalg.norm(vectors, axis=1, keepdims=True)).astype(np.float32))


def cosines(texts: list[str | None], model: Prototypes) -> np.ndarray:
    """Cosine of each text with each prototype; rows of NaN where there is no letter."""
    found = [np.unique(grams(t), return_counts=True) if t else (np.empty(0, np.int64),) * 2 for t in texts]
    sizes = np.array([len(n) for n, _ in found])
    out = np.full((len(texts), len(model.names)), np.nan)
    if not sizes.sum():
        return out
    used, at = np.unique(np.concatenate([n for n, _ in found]), return_inverse=True)
    counts = np.zeros((len(texts), len(used)), np.float32)
    counts[np.repeat(np.arange(len(texts)), sizes), at] = np.concatenate([c for _, c in found])
    vectors = np.zeros((len(texts), WIDTH), np.float32)
    for i in range(0, len(used), 4096):
        vectors += counts[:, i : i + 4096] @ bound(used[i : i + 4096])
    norms = np.linalg.norm(vectors, axis=1)
    good = (sizes > 0) & (norms > 0)
    out[good] = vectors[good] @ model.vectors.T / norms[good, None]
    return out


def predict(docs: DataFrame, model: Prototypes, id_column: str = "doc_id", text: str = "text") -> DataFrame:
    """``(doc_id, held_out, lang_pred, score)``: the nearest prototype, by name among equals, and its cosine (0 if negative).

    A NULL text, one without letters, or a model without languages gives ``und`` with score 0.
    """

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for i in range(0, len(batch), 256):
                part = batch.iloc[i : i + 256]
                near = cosines(part["text"].to_list(), model) if model.names else np.full((len(part), 1), np.nan)
                none = np.isnan(near[:, 0])
                best = np.where(np.isnan(near), -2, near).argmax(1)
                names = np.where(none, UNKNOWN, np.array(model.names or (UNKNOWN,), object)[best])
                score = np.where(none, 0.0, np.clip(near[np.arange(len(part)), best], 0, 1))
                yield pd.DataFrame({"doc_id": part["doc_id"].astype("Int64"), "lang_pred": names, "score": score})

    plain = docs.select(F.col(id_column).cast("bigint").alias("doc_id"), F.col(text).alias("text"))
    rows = plain.mapInPandas(run, "doc_id bigint, lang_pred string, score double")
    return rows.select("doc_id", held_out("doc_id", 4, 2).alias("held_out"), "lang_pred", "score")


def identify(docs: DataFrame) -> DataFrame:
    """Prototypes from the documents outside the fold, then the language of every row."""
    return predict(docs, fit(docs))
