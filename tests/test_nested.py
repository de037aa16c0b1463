import json

from conftest import rows
from ledgerloom.operators import nested


def frame(spark, *records):
    return spark.createDataFrame([(k, r if isinstance(r, str) or r is None else json.dumps(r), "x") for k, r in enumerate(records)], "record_id bigint, record_json string, element string")


def children(spark, *records):
    return rows(nested.section_children(frame(spark, *records)).select("record_id", "child_kind", "parent_ord", "child_ord"))


def vd(**section):
    return {"validation_and_diagnostics": section}


def test_notations_of_a_list_count_the_same(spark):
    e = {"claim": "c"}
    got = children(spark, vd(evidence=[e]), vd(evidence=e), vd(evidence=json.dumps([e])), vd(evidence=[json.dumps(e)]))
    assert got == [(k, "section_evidence", -1, 0) for k in range(4)]


def test_empty_places_keep_their_number(spark):
    got = children(spark, vd(validation_metrics=[None, {"name": "a", "evidence": [None, {"claim": "x"}]}, {"name": "b", "quantitative_value": {"points": {"label": "1"}, "uncertainty_components": [{"name": "s"}]}}]))
    assert got == [(0, "metric", -1, 1), (0, "metric", -1, 2), (0, "metric_evidence", 1, 1), (0, "metric_point", 2, 0), (0, "metric_uncertainty", 2, 0)]


def test_unknown_and_broken_records_give_nothing(spark):
    assert children(spark, None, "", "[1]", "{", {"validation_and_diagnostics": None}, vd(other=[{"evidence": [{"claim": "x"}]}], tuning_parameters=3)) == []


def test_evidence_elsewhere_is_no_case(spark):
    assert children(spark, {"outputs": {"evidence": [{"claim": "x"}]}, "validation_and_diagnostics": {"tuning_parameters": {"name": "t", "evidence": []}}}) == [(0, "parameter", -1, 0)]


def test_result_of_a_record_does_not_depend_on_others(spark):
    one = vd(validation_metrics=[{"quantitative_value": {"points": [{"label": "1"}]}}])
    alone = children(spark, one)
    beside = [r for r in children(spark, one, vd(validation_metrics={"quantitative_value": [{"points": {"label": "2"}}]})) if r[0] == 0]
    assert alone == beside


def test_plan_makes_tables_of_repeated_shared_and_recursive_elements():
    edges = list(nested.edges_of({"a": {"x": 1, "s": {"k": 1}}, "b": {"s": {"k": 2}}, "many": [{"v": 1}], "node": {"node": {"v": 2}}}, "root"))
    plan = nested.plan_of(edges, "root")
    assert plan.tables == {"root", "s", "many", "node"}


def test_shredding_inlines_singletons_and_links_children():
    record = {"a": {"x": 1, "items": [{"v": "p"}, {"v": "q"}]}}
    plan = nested.plan_of(list(nested.edges_of(record, "root")), "root")
    out = list(nested.shred_record(7, record, plan))
    assert [(r[0], r[4], r[7]) for r in out] == [("root", None, -1), ("items", "7/0", 0), ("items", "7/0", 1)]
    assert dict(out[0][10]) == {"a.x": "1"} and out[0][9] == ["$.a[0]"]


def test_the_plan_decides_the_rows(spark, monkeypatch):
    """Without the schema graph nothing is a table, and the lists can't be shredded."""
    import pytest

    record = vd(validation_metrics=[{"name": "a"}, {"name": "b"}])
    assert len(children(spark, record)) == 2
    monkeypatch.setattr(nested, "schema_graph", lambda *a, **k: [])
    with pytest.raises(Exception, match="inlines 'validation_metrics'"):
        children(spark, record)


def test_scalars_of_mixed_lists_stay():
    record = {"a": ["x", {"b": 1}, None, "y"], "c": "[1]", "d": [], "e": [None]}
    plan = nested.plan_of(list(nested.edges_of(record, "root")), "root")
    root, child = nested.shred_record(1, record, plan)
    assert dict(root[10]) == {"a": '["x", null, null, "y"]', "c": "[1]"}
    assert child[7] == 1 and dict(child[10]) == {"b": "1"}


def test_every_child_finds_its_parent(spark):
    df = frame(spark, vd(evidence=[{"claim": "c"}], validation_metrics=[None, {"name": "m", "evidence": [{"claim": "x"}], "quantitative_value": {"points": [{"label": "p"}, {"label": "q"}]}}]))
    got = rows(nested.links(nested.shredded(df)[0]))
    assert got == [("evidence", "record", 1, 0, 0), ("evidence", "validation_metrics", 1, 0, 0), ("points", "validation_metrics", 2, 0, 0), ("validation_metrics", "record", 1, 0, 0)]


def test_empty_table(spark):
    assert nested.section_children(frame(spark).limit(0)).count() == 0


def test_schema_graph_is_bounded(spark):
    import pytest

    with pytest.raises(ValueError):
        nested.schema_graph(frame(spark, {f"k{i}": 1 for i in range(30)}), "record_json", most=10)


def test_fields_of_many_shapes_do_not_end_the_walk(spark):
    bodies = ['{"a": 1}', '{"a": null}', '{"a": [1]}', '{"a": {"x": 1}}', '{"a": {"x": null}}', '{"a": {"x": [1]}}', '{"late": [{"y": 1}]}']
    df = spark.createDataFrame([(b,) for b in bodies], "record_json string").coalesce(1)
    batch = "spark.sql.execution.arrow.maxRecordsPerBatch"
    old = spark.conf.get(batch)
    spark.conf.set(batch, 1)
    try:
        edges = {e[:2]: e[2] for e in nested.schema_graph(df, "record_json", most=5)}
    finally:
        spark.conf.set(batch, old)
    assert edges == {("record", "a"): True, ("a", "x"): True, ("record", "late"): True, ("late", "y"): False}
