import json

from conftest import rows
from ledgerloom.sources import packages, sinks
from ledgerloom.streaming import events
from pyspark.sql.types import StructType


def write(path, content):
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_text(content if isinstance(content, str) else json.dumps(content))


def build(root):
    for name in ("p1", "p2"):
        write(root / name / "source_package_manifest.json", {"core_exports": {"clean_markdown": "docling/document.clean.md"}})
        write(root / name / "audit/source_fidelity.json", {"document": {"filename": f"{name}.pdf", "sha256": "0" * 64}, "summary": {"overall_status": "review"}, "recovery_queue": [{"item_type": "table", "item_id": "tbl_1", "status": "required"}, {"item_type": "figure", "item_id": "fig_1", "status": "none"}, {"item_type": "figure", "item_id": "x", "matched_picture_id": "fig_2", "status": "review"}]})
    write(root / "p1/docling/document.clean.md", "# Title\n\nText.")
    write(root / "p1/tables/tbl_1/table.records.json", [{"z": "1", "a": 2}, "no object", {"z": None, "b": "x|y"}])
    write(root / "p2/tables/tbl_9/table.records.json", {"not": "a list"})
    write(root / "p1/figures/fig_2/figure.recovered.json", {"any": 1})


def test_packages(spark, tmp_path):
    build(tmp_path)
    got = packages.read_packages(spark, str(tmp_path))
    assert rows(got.select("package", "source_filename", "problem")) == [("p1", "p1.pdf", None), ("p2", "p2.pdf", "clean_markdown")]
    cells = packages.table_records(spark, str(tmp_path))
    assert [(r["row_index"], r["col_ordinal"], r["column"], r["value"]) for r in cells.orderBy("row_index", "col_ordinal").collect()] == [(0, 0, "z", "1"), (0, 1, "a", "2"), (2, 0, "z", None), (2, 1, "b", "x|y")]
    assert rows(packages.unresolved_items(spark, got, str(tmp_path)).select("package", "item_id")) == [("p1", "tbl_1"), ("p2", "tbl_1"), ("p2", "x")]
    assert packages.scan_files(spark, str(tmp_path), "*.json", 3).count() == 3
    table_ = cells.select("table_id", "row_index", "col_ordinal", "column", "value")
    assert sinks.markdown_table(table_).first()["markdown"] == "| z | a |\n| --- | --- |\n| 1 | 2 |\n|  | x\\|y |"


def test_best_representation(spark):
    df = spark.createDataFrame([("p", "a", "markdown", "m"), ("p", "a", "records", "r"), ("p", "b", "recovered", " "), ("p", "b", "markdown", "m"), ("p", "c", "records", None)], "package string, item_id string, kind string, text string")
    assert rows(packages.best_representation(df).select("item_id", "kind", "text")) == [("a", "records", "r"), ("b", "markdown", "m"), ("c", "placeholder", "[not recovered]")]


def test_sinks(spark, tmp_path):
    df = spark.createDataFrame([(1, None, ["x"]), (2, "ü", [])], "id bigint, name string, tags array<string>")
    assert [json.loads(r[0]) for r in sinks.json_rows(df).collect()] == [{"id": 1, "tags": ["x"]}, {"id": 2, "name": "ü", "tags": []}]
    schema = sinks.json_schema(StructType.fromJson(df.schema.jsonValue()))
    assert schema["required"] == ["id", "name", "tags"] and schema["properties"]["tags"] == {"type": "array", "items": {"type": "string"}} and not schema["additionalProperties"]
    assert sinks.write_sheets({"b": df, "a": df.drop("tags")}, str(tmp_path)) == ["a", "b"] and spark.read.parquet(f"{tmp_path}/b").count() == 2


def test_stream_equals_batch(spark, data):
    batch = events.last_events(spark.read.parquet(f"{data}/events.parquet"), "user_id", "ts", ["event_id"])
    assert rows(events.run_once(events.last_events(events.stream_of(spark, data, "events"), "user_id", "ts", ["event_id"]), "complete")) == rows(batch)


def test_windowed_counts_are_those_of_the_table(spark, data):
    from pyspark.sql import functions as F

    got = events.run_once(events.windowed_counts(events.stream_of(spark, data, "events"), "ts", "event_type"), "update", ["start", "event_type"])
    table_ = spark.read.parquet(f"{data}/events.parquet").groupBy(F.date_trunc("hour", F.col("ts").cast("timestamp")).alias("start"), "event_type").agg(F.count(F.lit(1)).alias("n"))
    assert rows(got) == rows(table_)


def test_landing_takes_equal_contents_once(spark, tmp_path):
    for name in ("a", "b", "c"):
        write(tmp_path / f"{name}.pdf", "same" if name != "c" else "other")
    assert events.run_once(events.landed_files(spark, str(tmp_path), "*.pdf"), "append").count() == 2


def test_entry_points(spark):
    import __spark_entry__ as entry

    queries, sql = entry.queries(), entry.oracle_sql()
    assert set(sql) <= set(queries) and entry.entry(spark).count() > 0
    assert {f"p{n}_found" for n in (1, 3, 4)} <= set(queries)


def test_the_core_stands_without_a_dependency_of_the_optional_part(spark, monkeypatch):
    import sys

    import __spark_entry__ as entry

    for name in [m for m in sys.modules if m.startswith("ledgerloom.llm")]:
        monkeypatch.delitem(sys.modules, name)
    monkeypatch.setitem(sys.modules, "ledgerloom.llm.queries", None)  # its import fails
    queries = entry.queries()
    assert "p1_found" in queries and "p2_found" not in queries and set(entry.oracle_sql()) <= set(queries)
