"""What jobs leave on disk: compressed landing files, each small enough for one reader."""

import gzip
from pathlib import Path

import pytest
from conftest import rows_of
from pyspark.sql import DataFrameWriter
from pyspark.sql import functions as F

from formline.plans import star
from formline.plans.catalog import QUERIES, nested
from formline.scratch import compressed, new_folder
from formline.sources import documents, tables
from formline.sources.csv import scan_csv_prefix

SF = "/root/testdata/sf0.001"
needs_tables = pytest.mark.skipif(not Path(SF).exists(), reason="needs the generated tables")


def size(folder):
    return sum(p.stat().st_size for p in Path(folder).rglob("*") if p.is_file() and not p.name.startswith((".", "_")))


def landed(monkeypatch, module):
    """The folders made from now on, by label."""
    made = {}

    def folder(spark, label):
        made[label] = new_folder(spark, label)
        return made[label]

    monkeypatch.setattr(module, "new_folder", folder)
    return made


def test_compressed_lines_come_in_small_files_and_all_of_them_are_read(spark, tmp_path):
    rows = spark.range(0, 2500, 1, 2).select(F.format_string('{"n": %d}', "id").alias("value"))
    compressed(rows, 1000).text(str(tmp_path / "lines"))
    files = list((tmp_path / "lines").glob("*.gz"))
    assert len(files) == 4
    read = spark.read.text(str(tmp_path / "lines"))
    assert read.count() == 2500 and read.exceptAll(rows).isEmpty()


@needs_tables
@pytest.mark.parametrize("name, label", [("bad_record_quarantine", "quarantine"), ("scan_game_json", "games-json")])
def test_documents_land_in_a_fifth_of_their_text(spark, monkeypatch, name, label):
    made = landed(monkeypatch, nested)
    assert QUERIES[name](spark, SF).count() >= star.game_documents(spark, SF).count()
    text = star.game_documents(spark, SF).select(F.sum(F.length(F.to_json(F.struct("*"))))).first()[0]
    assert size(made[label]) < text / 5


def test_a_parse_is_stored_without_sorting_documents(spark, monkeypatch, tmp_path):
    """A file stays open for either side while the parse is written, so no task holds its documents for a sort."""
    name, seen, write = "spark.sql.maxConcurrentOutputFileWriters", [], DataFrameWriter.parquet
    monkeypatch.setattr(DataFrameWriter, "parquet", lambda w, path: (seen.append(spark.conf.get(name)), write(w, path)))
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "a.json").write_text('{"n": 1}\n{"n": oops\n\n{"n": 2}\n')
    parsed = documents.parse_once(spark, str(tmp_path / "in"), "n int")
    assert seen == ["2"] and spark.conf.get(name) == "0"
    assert parsed.counts == {"read": 2, "rejected": 1}
    assert sorted(r.n for r in parsed.documents.collect()) == [1, 2]
    assert [r.record for r in parsed.rejects.collect()] == ['{"n": oops']


def test_compressed_periods_are_read_beside_plain_ones(spark, tmp_path):
    """Several small files per period, each with its header, whatever the order of its columns."""
    rows = spark.range(0, 300, 1, 1).select(F.col("id").cast("int").alias("a"), F.concat(F.lit("x,"), "id").alias("b"))
    tables.sink_csv_period(rows, str(tmp_path), "t", "2024-01-01", compression="gzip")
    tables.sink_csv_period(rows.select("b", "a"), str(tmp_path), "t", "2024-01-02")
    assert {p.suffix for p in (tmp_path / "t").rglob("part-*")} == {".csv", ".gz"}
    assert rows_of(scan_csv_prefix(spark, str(tmp_path / "t"), "a int, b string")) == rows_of(rows.unionAll(rows))
    with pytest.raises(ValueError, match="compression"):
        tables.sink_csv_period(rows, str(tmp_path), "t", "2024-01-03", compression="rar")


@needs_tables
@pytest.mark.parametrize("name", ["flatten", "snapshot_tables", "snapshot"])
def test_flattened_tables_are_a_fraction_of_their_text(spark, monkeypatch, name):
    made = landed(monkeypatch, nested)
    assert QUERIES[name](spark, SF).count() > 0
    files = list(Path(made["flat"]).rglob("*.csv*"))
    shown = [p for p in files if not p.name.startswith(".")]
    assert shown and all(p.name.endswith(".csv.gz") for p in shown)
    assert sum(p.stat().st_size for p in shown) < sum(len(gzip.decompress(p.read_bytes())) for p in shown) / 4
