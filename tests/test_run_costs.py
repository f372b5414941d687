"""What a run does per row: lines are hashed and not sorted, file names are looked at once per file, repeated work is staged."""

from pyspark.sql import functions as F

from replenix import schemas
from replenix.sinks import digest
from replenix.sources import files


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def _feed(root) -> None:
    day = root / "2026-01-14"
    day.mkdir(parents=True)
    (day / "A.json").write_text('\n  \n{"order_id": "1", "sku": "a"}\n{"order_id": "2"}\n')
    (day / "B.json").write_text('[{"order_id": "3"},\n{"order_id": "4"}]')
    (day / "C.json").write_text('[{"order_id": "5"}]\n[{"order_id": "6"}]\n')
    (day / "D.json").write_text('{\n"order_id": "7"\n}\n')


def test_lines_of_a_file_are_not_sorted(spark, tmp_path):
    _feed(tmp_path)
    kinds = files._json_kinds(spark, [str(tmp_path)], ".json")
    assert "SortAggregate" not in _plan(files._heads(files._lines(spark, [str(tmp_path)], ".json"))).split("Exchange")[-1]
    assert {r.path[-6]: r.document for r in kinds.collect()} == {"A": False, "B": True, "C": False, "D": True}


def test_file_names_are_looked_at_once_per_file(spark, tmp_path):
    _feed(tmp_path / "in")
    kinds_named = {"exec_date": F.regexp_extract("path", files.DATE_FOLDER, 1), "source_file": F.lit("s")}
    parse = files._json_by_content(spark, [str(tmp_path / "in")], schemas.ORDERS, ".json", str(tmp_path / "staged"), kinds_named)
    assert "regexp_extract(path" not in _plan(parse)
    rows, rejects = files.ingest_directory(spark, str(tmp_path / "in"), schemas.ORDERS)
    assert sorted((r.order_id, r.exec_date, r.source_file) for r in rows.collect()) == [
        (str(k), "2026-01-14", f) for k, f in enumerate("AABBCCD", 1)]
    assert rejects.count() == 0


def test_digest_adds_up_whole_numbers(spark):
    rows = spark.range(1000).select(F.lit("d").alias("day"), "id")
    table = digest.content_digest(rows, "day")
    per_row = _plan(table).split("Exchange")[-1]
    assert "decimal(38,0)" not in per_row
    hashes = [r[0] for r in rows.select(F.md5(digest.row_text(["id"]).cast("binary"))).collect()]
    assert table.first().digest == "-".join(str(sum(int(h[8 * k:8 * k + 8], 16) for h in hashes)) for k in range(4))
