import pytest
from pyspark.sql import functions as F

from conftest import rows
from ledgerloom.functions import metrics
from ledgerloom.operators import consolidation as c

NAMES = metrics.Names(((" mae ", "mae"), (" rmse ", "rmse"), (" overall accuracy ", "oa")))


def values(spark, column, *data, kinds="string"):
    df = spark.createDataFrame([(k, *(r if isinstance(r, tuple) else (r,))) for k, r in enumerate(data)], "k int, " + ", ".join(f"{n} {t}" for n, t in zip("abcd", kinds.split(","))))
    return [r["x"] for r in df.select("k", column.alias("x")).orderBy("k").collect()]


def test_predicates(spark):
    assert values(spark, c.target_specific(F.col("a")), "231 produced phase-year surfaces", "Five-fold held-out surfaces", "surfaces: 12 of them", "", None) == [True, False, True, False, False]
    assert values(spark, c.generic_basis(F.col("a")), None, "  Reported range (basis  not stated)", "90 % interval") == [True, True, False]
    assert values(spark, c.without_outcome(F.col("a")), "no standalone numerical value", "MAE of 3", None) == [True, False, False]
    assert values(spark, c.structured_evidence(F.col("a"), F.col("b"), F.col("c")), ("table", "author_table", None), ("table", "author_figure", None), ("figure", "author_caption", "x"), ("table", None, "docling_structured"), (None, "authored_prose", "docling_structured"), kinds="string,string,string") == [True, False, True, True, False]
    assert values(spark, c.parameter_like(F.col("a"), F.col("b") == "y", F.col("c")), ("selection_or_tuning", "n", "thresholds of 1 to 9 were tested"), ("selection_or_tuning", "y", "thresholds of 0.1 tested"), ("other", "n", "threshold tested"), ("selection_or_tuning", "n", None), kinds="string,string,string") == [True, False, False, False]
    assert values(spark, c.generated_row(F.col("a"), F.col("b"), F.col("c"), F.lit("5")), (["Rye: MAE 5."], "rye", "MAE"), ([], "rye", "MAE"), (["Rye: MAE 5.", "other"], "rye", "MAE"), kinds="array<string>,string,string") == [True, False, False]


def test_targets_of_records_and_sentences(spark):
    assert values(spark, c.candidate_target(F.col("a")), "crop: field pea; site: X", " site: Y | Crop:  winter-rye | 3", "field pea", "sugar beet; Kér; 2.1 m", "", None) == ["field pea", "winter rye", "field pea", "sugar beet", None, None]


def test_rows_of_selected_tables(spark):
    offered = spark.createDataFrame([(1, "t", x, k, k) for x in ("a", "b", "c") for k in ("mae", "rmse")] + [(1, "u", "a", "mae", "mae")], "bundle_id int, item string, target string, key string, family string")
    taken = spark.createDataFrame([(7, 1, "t", "a", "mae"), (7, 1, "u", "z", "mae"), (8, 2, "t", "a", "mae")], "record_id int, bundle_id int, item string, target string, key string")
    assert rows(c.missing_siblings(offered, taken)) == [(7, "t", "a", "rmse")]
    assert rows(c.missing_targets(offered, taken)) == [(7, "t", 2, "b, c")]
    assert rows(c.missing_targets(offered, taken, 1)) == [(7, "t", 2, "b and 1 more")]
    assert c.missing_targets(offered.limit(0), taken).count() == 0


def test_gaps_are_filled_once(spark):
    import json

    hints = spark.createDataFrame([(k, 1, "structured_table_metric", "t", n, x, v) for k, (n, x, v) in enumerate([("MAE", "crop: rye", "1"), ("RMSE", "crop: rye", "2"), ("rmse", "rye", "3"), ("RMSE", "crop: oat", "4"), (None, "rye", "5")])], "hint_id bigint, bundle_id bigint, kind string, source_item_id string, metric_name string, target string, value string")
    record = {"validation_and_diagnostics": {"validation_metrics": [{"name": "mae", "scope_label": "rye", "context": "c", "evidence": [{"source_item_id": "t"}, {"source_item_id": "t"}]}, {"name": "MAE", "scope_label": "rye", "context": "d", "evidence": [{"source_item_id": "t"}]}]}}
    records = spark.createDataFrame([(9, 1, json.dumps(record)), (8, 1, "{}")], "record_id bigint, bundle_id bigint, record_json string")
    assert rows(c.backfilled(hints, records, NAMES)) == [(9, "t", "rye", "rmse", 1, "2", "c")]
    assert c.backfilled(hints.limit(0), records, NAMES).count() == 0


def test_scopes_give_way_to_special_ones(spark):
    df = spark.createDataFrame([(1, "unknown", "winter rye"), (1, "crop_phase", "rye, winter"), (1, "crop", "the winter rye"), (1, "unknown", "rye"), (1, "phase_year", "rye"), (2, "unknown", "winter rye"), (1, None, None)], "bundle_id int, scope string, scope_label string")
    got = [tuple(r) for r in c.harmonized_scopes(df, ["bundle_id"]).select("scope", "scope_label", "harmonized").collect()]
    assert sorted(r for r in got if r[0] == "unknown") == [("unknown", "rye", "unknown"), ("unknown", "winter rye", "crop_phase"), ("unknown", "winter rye", "unknown")]
    assert all(a == b for a, _, b in got if a != "unknown")


def test_moves_and_keys(spark):
    df = spark.createDataFrame([("MAE", "selection_or_tuning", "threshold tested", None), ("cut", "selection_or_tuning", "threshold = 3", None), ("x", "other", None, "not an independently reported validation result"), (None, None, None, None)], "name string, context string, value_or_summary string, interpretation string")
    assert [r["belongs"] for r in c.sorted_out(df, NAMES).collect()] == ["ledger", "parameters", "evidence", "ledger"]
    keyed = c.merge_key(df.withColumn("t", F.lit("of the Rye field")), "name", "context", "t", "interpretation", "value_or_summary", NAMES).first()
    assert (keyed["k_metric"], keyed["k_target"], keyed["k_value"], keyed["k_support"]) == ("mae", "field rye", "threshold tested", "")


def test_numbered_items(spark):
    df = spark.createDataFrame([(1, "intro\n1. one\n more\n2. two\n3. \n10. ten 4. no"), (2, None), (3, "")], "id int, t string")
    assert rows(c.numbered_items(df, ["id"], "t")) == [(1, 1, "one\n more"), (1, 10, "ten 4. no"), (1, 2, "two")]


def test_novel_limitations(spark):
    said = spark.createDataFrame([(1, "rainfall gauges under trees"), (2, None)], "id int, text string")
    asked = spark.createDataFrame([(1, 0, "Rainfall gauges"), (1, 1, "Sparse station network"), (1, 2, "Later cloud"), (2, 0, "Any limitation"), (3, 0, "a b")], "id int, ord int, statement string")
    assert rows(c.novel_limitations(asked, said, ["id"])) == [(1, "Sparse station network"), (2, "Any limitation")]


def test_boxes_pages_queues_replies(spark):
    captions = spark.createDataFrame([(1, 2, "3", "soil map"), (1, 2, "9", "none")], "doc_id int, page int, number string, caption string")
    blocks = spark.createDataFrame([(1, 2, "3", "soil map", "b1", 1), (1, 2, "3", "soil map", "b0", 0), (1, 2, "3", "other", "b2", 2)], "doc_id int, page int, number string, text string, box string, ord int")
    got = c.caption_boxes(captions, blocks, (F.col("caption") == F.col("text")).cast("int"), "ord")
    assert sorted((r["number"], r["box"]) for r in got.collect()) == [("3", "b0"), ("9", None)]
    pages = spark.createDataFrame([(1, 2, 10.0, 20.0)], "doc_id int, page int, width double, height double")
    assert {r["width"] for r in c.with_page_geometry(captions, pages).collect()} == {10.0}
    assert [tuple(r) for r in c.queue_lines(spark.createDataFrame([(1, ["a", "b"]), (2, None)], "id int, codes array<string>")).collect()] == [(1, "a;b"), (2, "")]
    assert values(spark, c.reply_text(F.col("a")), '{"output_text": "x"}', '{"choices": [{"message": {"content": "y"}}]}', "{}", "no json", None) == ["x", "y", None, None, None]


def test_templates_include_one_another():
    texts = {"a": "A {{INCLUDE:b}}", "b": "B", "c": "{{INCLUDE:d}}", "d": "{{INCLUDE:c}}"}
    assert c.expanded("a", texts) == "A B"
    with pytest.raises(ValueError):
        c.expanded("c", texts)
    with pytest.raises(KeyError):
        c.expanded("x", texts)
