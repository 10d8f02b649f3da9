"""Quality rules with thresholds from mergeable quantile sketches per language and source."""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from formline.llm.common import stored

WINDOW = 8
LEAST_WORDS = 20
MOST_REPEATED = 30
#: Relative width of a sketch's bins: quantiles are exact to 2 percent.
BIN = 1.04
#: A group's cut moves towards that of its language, and a language's towards that of all documents, as if the
#: larger one had so many documents in it: smoothly by count, at every size.
SHRINK = 50
#: What a count tells about the rate of a text: a text of no length would have half an event in ten places.
EVENT, PLACES = 0.5, 10
#: A rule rejects beyond this quantile of its group, times the margin. Symbols and word lengths are those of junk that
#: can be several percent of a group, so their quantile lies below that; lines and words repeat in few documents.
QUANTILE = {"symbols": 0.9, "dup_lines": 0.99, "repeats": 0.99, "long": 0.9, "short": 0.9}
MARGIN = 1.25

_SYMBOLS = re.compile(r"[#*$%&|<>]")
_COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")


def counts(text: str | None) -> tuple[int, int, int, int, int]:
    """Words, their characters, symbols, duplicated lines, and words in repeated windows of a text."""
    if not text:
        return 0, 0, 0, 0, 0
    data = text.encode()
    words = data.split()  # bytes: ASCII white space alone
    # Bytes that continue a character are 10xxxxxx; the rest are one per character.
    raw = np.frombuffer(data, np.uint8)
    blank = (raw == 32) | ((raw >= 9) & (raw <= 13))
    chars = int(((raw & 0xC0) != 0x80).sum() - blank.sum())
    seen, dup = set(), 0
    for line in data.split(b"\n"):
        if line.split(None, 1):
            dup += line in seen
            seen.add(line)
    repeat = 0
    if len(words) > WINDOW:
        numbers: dict[bytes, int] = {}
        ids = np.fromiter((numbers.setdefault(w, len(numbers)) for w in words), np.int64, len(words))
        # Names of windows twice as wide from pairs of names, exact: 2, 4, 8 words.
        for width in (1, 2, 4):
            pairs = ids[:-width] * np.int64(len(words) + 1) + ids[width:]
            ids = np.unique(pairs, return_inverse=True)[1]
        again = np.bincount(ids)[ids] > 1
        cover = np.zeros(len(words) + 1, np.int64)
        np.add.at(cover, np.flatnonzero(again), 1)
        np.add.at(cover, np.flatnonzero(again) + WINDOW, -1)
        repeat = int((np.cumsum(cover[:-1]) > 0).sum())
    return len(words), chars, len(_SYMBOLS.findall(text)), dup, repeat


def measured(docs: DataFrame, id_column: str, text: str, lang: str, source: str) -> DataFrame:
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            done = pd.DataFrame([counts(t) for t in batch["text"]], columns=list(_COUNTS), dtype=np.int64)
            lines = [len(t.split("\n")) if t else 1 for t in batch["text"]]
            yield pd.concat([batch[["doc_id", "lang", "source"]].reset_index(drop=True).astype({"doc_id": "Int64"}), done, pd.Series(lines, name="lines")], axis=1)

    plain = docs.select(F.col(id_column).cast("bigint").alias("doc_id"), F.col(lang).alias("lang"), F.col(source).alias("source"), F.col(text).alias("text"))
    return plain.mapInPandas(run, "doc_id bigint, lang string, source string, " + ", ".join(f"{c} bigint" for c in _COUNTS) + ", lines bigint")


_PER = {"symbols": ("n_symbols", "n_words"), "dup_lines": ("n_dup_lines", "lines"), "repeats": ("n_repeat_words", "n_words")}


def _lengths() -> dict[str, Column]:
    length = F.greatest(F.col("word_chars") / F.greatest(F.col("n_words"), F.lit(1)), F.lit(0.01))
    return {"long": length, "short": 1 / length}


def _rates() -> dict[str, Column]:
    """What the sketches hold: rates of events as a count alone lets expect them, so no text has rate 0."""
    return {rule: (F.col(n) + EVENT) / (F.col(size) + PLACES) for rule, (n, size) in _PER.items()} | _lengths()


def _sure_rates() -> dict[str, Column]:
    """What is held against the cuts: a rate less one standard error, 0 for a single event in a text of any length."""
    sure = {rule: (F.col(n) - F.sqrt(n)) / F.greatest(F.col(size), F.lit(1)) for rule, (n, size) in _PER.items()}
    return sure | _lengths()


def _base_failed() -> Column:
    return (F.col("n_words") < LEAST_WORDS) | (100 * F.col("n_repeat_words") > MOST_REPEATED * F.col("n_words"))


def thresholds(rows: DataFrame) -> DataFrame:
    """``(lang, source, rule, cut)``: each group's cut-offs, from its documents that pass the base rule.

    Those that fail it are rejected anyway, and would lift the quantiles of repetition out of reach.
    A sketch counts values in bins of equal relative width; sketches merge by adding counts, in any
    order and with the same result. Those of a language and of all are merged from those of the groups. A cut is the
    quantile of the group times the margin, shrunk by count towards that of the language, itself shrunk towards that of all.
    """
    each = F.explode(F.array(*[F.struct(F.lit(k).alias("rule"), v.alias("value")) for k, v in _rates().items()]))
    values = rows.where(~_base_failed()).select("lang", "source", each.alias("r")).select("lang", "source", "r.rule", "r.value")
    bins = values.withColumn("bin", F.floor(F.log("value") / F.lit(float(np.log(BIN)))))
    sketch = stored(bins.groupBy("lang", "source", "rule", "bin").agg(F.count(F.lit(1)).alias("n")), "sketches")

    def cuts(key: list[str]) -> DataFrame:
        merged = sketch.groupBy(*key, "rule", "bin").agg(F.sum("n").alias("n"))
        group = W.partitionBy(*key, "rule")
        ranked = merged.withColumn("upto", F.sum("n").over(group.orderBy("bin"))).withColumn("all", F.sum("n").over(group))
        value = F.pow(F.lit(BIN), F.col("bin") + 0.5)
        wanted = F.create_map(*[F.lit(x) for pair in QUANTILE.items() for x in pair])[F.col("rule")]
        edge = F.min(F.when(F.col("upto") >= F.col("all") * wanted, value))
        return ranked.groupBy(*key, "rule").agg((MARGIN * edge).alias("cut"), F.first("all").alias("n"))

    own, of_lang, of_all = cuts(["lang", "source"]), cuts(["lang"]), cuts([])
    both = own.join(of_lang.select(F.col("lang").alias("l"), F.col("rule").alias("r"), F.col("n").alias("lang_n"), F.col("cut").alias("by_lang")),
                    own["lang"].eqNullSafe(F.col("l")) & (own["rule"] == F.col("r"))).drop("l", "r")
    both = both.join(of_all.select("rule", F.col("cut").alias("by_all")), "rule")
    of_lang = (F.col("lang_n") * F.col("by_lang") + SHRINK * F.col("by_all")) / (F.col("lang_n") + SHRINK)
    cut = (F.col("n") * F.col("cut") + SHRINK * of_lang) / (F.col("n") + SHRINK)
    return both.select("lang", "source", "rule", cut.alias("cut"))


def judge(docs: DataFrame, id_column: str = "doc_id", text: str = "text", lang: str = "lang", source: str = "source") -> DataFrame:
    """One row per input row with its counts, the fixed base rule and the adaptive verdict.

    The thresholds learn from documents that pass the base rule, of all languages and sources; NULL is a
    language, and a source, of its own. A NULL or empty text has no words and fails the base rule.
    Rows with NULL or repeated ids are judged like any other.
    """
    rows = stored(measured(docs, id_column, text, lang, source), "counts")
    cut = thresholds(rows).groupBy("lang", "source").agg(F.map_from_entries(F.collect_list(F.struct("rule", "cut"))).alias("cuts"))
    cut = cut.select(F.col("lang").alias("_lang"), F.col("source").alias("_source"), "cuts")
    # As many rows as groups; Spark broadcasts them if they are small.
    met = rows.join(cut, rows["lang"].eqNullSafe(F.col("_lang")) & rows["source"].eqNullSafe(F.col("_source")), "left")
    failed = _base_failed()
    within = F.lit(True)
    for rule, rate in _sure_rates().items():
        within = within & F.coalesce(rate <= F.col("cuts")[rule], F.lit(True))
    return met.select("doc_id", *_COUNTS, failed.alias("base_failed"), (~failed & within).alias("kept"))
