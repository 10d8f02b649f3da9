"""The training-data pipeline: stages over ``documents``, each written and read again by the next one.

A stage gets ``(spark, docs, sf_dir)`` and returns a DataFrame; all but the last return the columns
of ``docs``. Rows with NULL or repeated ids are documents of their own; an empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from formline.llm import mixing, packing, quality, secrets, setsketch
from formline.llm.common import documents, fresh, stored, table


def _counted(docs: DataFrame) -> DataFrame:
    """The rows with ``n_chars``, where they have it, of the text as it now is."""
    if "n_chars" not in docs.columns:
        return docs
    return docs.withColumn("n_chars", F.coalesce(F.length("text"), F.lit(0)).cast(docs.schema["n_chars"].dataType))


def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier rejects go."""
    return quality.accepted(docs, quality.fit(docs, table(spark, sf_dir, "labels")))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates stays: the one with the least id.

    Rows are told apart by a number, in the order of their ids and NULL last, so that copies without an id or with
    the same one go as well.
    """
    row, known, group = (fresh(name, docs.columns) for name in ("row", "known", "group"))
    rows = stored(docs.withColumn(row, F.monotonically_increasing_id()), "numbered")
    found = setsketch.near_duplicates(rows, id_column=row).select(F.col("doc_id").alias(row), F.col("component_id").alias(group))
    ids = rows.select(row, F.col("doc_id").alias(known)).join(found, row)
    # NULL ids come last: false sorts before true.
    first = F.min_by(F.col(row), F.struct(F.col(known).isNull(), F.col(known), F.col(row)))
    kept = ids.groupBy(group).agg(first.alias(row)).select(row)
    return rows.join(kept, row, "left_semi").select(docs.columns)


def secret_scan(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Secrets in the texts are replaced by a mark; every document stays."""
    return _counted(secrets.redact(docs)).select(docs.columns)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """A row for each pass of the mix that takes words of a document, with the words it takes.

    A text that is taken whole stays as it is; of others the words taken are joined by blanks.
    Documents without words aren't in the mix.
    """
    row, spans, words, whole = (fresh(name, [*docs.columns, "pass", "size"]) for name in ("row_", "spans", "words", "whole"))
    rows = stored(docs.withColumn(row, F.monotonically_increasing_id()), "numbered")
    placed, taken = mixing.mix(rows, id_column=row)
    cuts = mixing.spans(placed, taken).join(placed.select("row", "size", F.col("doc_id").alias(row)), "row")
    drawn = cuts.groupBy(row, "pass").agg(
        F.sort_array(F.collect_list(F.struct("low", "high"))).alias(spans),
        (F.sum(F.col("high") - F.col("low")) == F.any_value("size")).alias(whole),
    ).drop("pass")
    every = F.regexp_extract_all("text", F.lit(mixing.WORD), F.lit(0))
    cut = F.transform(spans, lambda s: F.slice(words, (s.low + 1).cast("int"), (s.high - s.low).cast("int")))
    mixed = rows.join(drawn, row).withColumn(words, F.when(~F.col(whole), every))
    mixed = mixed.withColumn("text", F.when(F.col(whole), F.col("text")).otherwise(F.concat_ws(" ", F.flatten(cut))))
    return _counted(mixed).select(docs.columns)


def best_fit_packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The tokens' places in sequences of fixed length."""
    return packing.pack_documents(docs)


STAGES = [
    ("quality_classifier", quality_classifier),
    ("minhash_near_dedup", near_duplicates),
    ("secret_scan", secret_scan),
    ("mix_sources", mix_sources),
    ("best_fit_packing", best_fit_packing),
]

#: Fits, sketches and tokenizers can't be written in SQL; tests compare stages with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rows of the last stage."""
    docs = documents(spark, sf_dir)
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
