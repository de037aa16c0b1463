import math

import pytest

from conftest import rows
from ledgerloom.functions.names import NameResolver, distance, folded
from ledgerloom.operators import units

CATALOGUE = [(c, d, k) for c, d, k in (("d", "duration", True), ("h", "duration", False), ("wk", "duration", False), ("min", "duration", False), ("mm", "length", True), ("cm", "length", False), ("m", "length", False), ("in", "length", False), ("Cel", "temperature", True), ("K", "temperature", False), ("degF", "temperature", False), ("1", "fraction", True), ("%", "fraction", False), ("ppth", "fraction", False), ("t/ha", "areal_mass", True), ("g/m2", "areal_mass", False), ("kg/ha", "areal_mass", False))]


def test_names_of_units():
    for text, code in (("tonnes per hectare", "t/ha"), ("t ha-1", "t/ha"), ("g m-2", "g/m2"), ("grams per square metre", "g/m2"), ("KG/HA", "kg/ha"), ("per cent", "%"), ("‰", "ppth"), ("degrees Fahrenheit", "degF"), ("°C", "Cel"), ("kelvin", "K"), ("in.", "in"), ("inches", "in"), ("sq km", "km2"), ("square kilometres", "km2"), ("kWh m-2", "kWh/m2"), ("metres per second", "m/s"), ("kph", "km/h"), ("knots", "kn"), ("milligrams per kilogram", "mg/kg"), ("hrs", "h"), ("acres", "acre"), ("was found", None), ("every survey", None)):
        assert units.read_unit(text) == code, text


@pytest.fixture(scope="module")
def frames(spark):
    metrics = spark.createDataFrame([("mae", "MAE", "mean absolute error", "error", "variable"), ("avg", None, "arithmetic mean", "level", "variable"), ("oa", "OA", "overall accuracy", "classification", "fraction")], "metric_key string, short_name string, full_name string, metric_family string, quantity_kind string")
    return metrics, spark.createDataFrame(CATALOGUE, "unit_code string, dimension string, is_common boolean")


def hints(spark, *rows_):
    names = ("metric_name", "value", "unit_hint", "column_label", "excerpt", "caption")
    full = [(i, *[r.get(n) for n in names], "clash", 1.0) for i, r in enumerate(rows_)]
    return spark.createDataFrame(full, "hint_id bigint, metric_name string, value string, unit_hint string, column_label string, excerpt string, caption string, at_value string, number double")


LEDGER = "metric_id bigint, name string, as_reported string, unit string, interpretation string, scope_label string"


def run(spark, frames, *rows_):
    out = units.recorded_units(hints(spark, *rows_), spark.createDataFrame([], LEDGER), *frames)
    return {r["row_id"]: r for r in out.collect()}


def test_first_place_that_names_a_unit_wins(spark, frames):
    cap = "Table 1. Results for season length; unit of season length: weeks."
    got = run(
        spark, frames,
        {"metric_name": "MAE", "value": "5 hours", "unit_hint": "d", "column_label": "Value [wk]", "caption": cap},
        {"metric_name": "MAE", "value": "5", "unit_hint": "d", "column_label": "Value [wk]", "caption": cap},
        {"metric_name": "MAE", "value": "5", "column_label": "Value, minutes", "caption": cap},
        {"metric_name": "MAE", "value": "5", "excerpt": "We obtain MAE = 5 hours (winter rye).", "caption": cap},
        {"metric_name": "MAE", "value": "5", "column_label": "Value (2)", "caption": cap},
        {"metric_name": "OA", "value": "5", "column_label": "Value", "caption": cap},
        {"metric_name": "snow share", "value": "5", "caption": cap},
        {"metric_name": None, "value": "5", "caption": cap},
        {"metric_name": "mean absolte error", "value": "7", "caption": cap},
        {"metric_name": "MAE", "value": "n/a", "unit_hint": "h"},
        {"metric_name": "MAE", "value": None, "unit_hint": "h"},
        {"metric_name": "MAE", "value": "5 (4-6)", "excerpt": "MAE of 5 hours (4-6) was found for winter rye."},
    )
    assert [got[k]["unit_code"] for k in range(12)] == ["h", "d", "min", "h", "wk", None, None, None, "wk", None, None, "h"]


def test_inches_ordinals_and_repeated_numbers(spark, frames):
    got = run(
        spark, frames,
        {"metric_name": "MAE", "value": "6.5", "excerpt": "MAE of 6.5 in. was found for oat mixture."},
        {"metric_name": "MAE", "value": "1.80", "excerpt": "We obtain MAE = 1.80 in. (oat mixture)."},
        {"metric_name": "MAE", "value": "0.72 (0.53–0.92)", "excerpt": "MAE reached 0.72 in (0.53–0.92) for faba bean."},
        {"metric_name": "MAE", "value": "5", "excerpt": "MAE of 5 in 5 fields."},
        {"metric_name": "MAE", "value": "5", "column_label": "Result (weeks) (3)"},
        {"metric_name": "MAE", "value": "5", "column_label": "All sites [hours] (2)"},
        {"metric_name": "MAE", "value": "0.08", "excerpt": "MAE of 0.08 metres (0.06-0.08) was found."},
        {"metric_name": "MAE", "value": "5", "excerpt": "MAE of 5 hours was found at 15 d."},
    )
    assert [got[k]["unit_code"] for k in range(8)] == ["in", "in", "in", None, "wk", "h", "m", "h"]


def test_values_in_the_common_unit(spark, frames):
    got = run(
        spark, frames,
        {"metric_name": "arithmetic mean", "value": "68 °F (50–86)"},
        {"metric_name": "MAE", "value": "9 °F"},
        {"metric_name": "MAE", "value": "1,200 ± 30 cm"},
        {"metric_name": "OA", "value": "12.5–25 %"},
        {"metric_name": "OA", "value": "0.5"},
        {"metric_name": "MAE", "value": "median 2e1cm"},
        {"metric_name": "MAE", "value": "-3.5 m"},
    )
    near = lambda k, **want: all(math.isclose(got[k][c], v, abs_tol=1e-9) for c, v in want.items())
    assert near(0, number=20, lower_bound=10, upper_bound=30) and got[0]["common_unit"] == "Cel"
    assert near(1, number=5)
    assert near(2, number=12000, spread=300)
    assert near(3, lower_bound=0.125, upper_bound=0.25) and got[3]["number"] is None
    assert near(4, number=0.5) and got[4]["unit_code"] is None
    assert near(5, number=200)
    assert near(6, number=-3500)


def counted(spark, *sources):
    """Counts of sources ``(spelling, entity, level, values)``."""
    rows_ = [(s, e, level, round(v if level else math.log10(v), 2), 3) for s, e, level, values in sources for v in values]
    return spark.createDataFrame(rows_, "spelling string, entity string, level boolean, b double, n bigint")


def settled(spark, frames, counts, **options):
    spellings = counts.select("spelling").distinct()
    return {r["spelling"]: (r["unit_code"], r["how"]) for r in units.source_graph(counts, spellings, frames[1], units.Graph(**options)).collect()}


def test_links_settle_what_no_grammar_knows_and_propagate(spark, frames):
    days = [8.0, 10.0, 12.0, 14.0]
    week, hour = [x / 7 for x in days], [x * 24 for x in days]
    counts = counted(spark, ("d", "a", False, days), ("d", "b", False, days), ("sennights", "a", False, week), ("sennights", "b", False, week), ("sennights", "c", False, week), ("glasses", "c", False, hour), ("glasses", "c", False, hour), ("strange", "c", False, [1.0, 5.0]))
    # "c" has no anchor: its centre comes from a source that was settled in the round before
    assert settled(spark, frames, counts, names=False) == {"d": ("d", "anchor"), "sennights": ("wk", "links"), "glasses": ("h", "links")}


def test_offsets_tell_degrees_apart(spark, frames):
    celsius = [5.0, 9.0, 13.0, 17.0, 21.0, 25.0, 29.0]
    counts = counted(spark, ("K", "t", True, [x + 273.15 for x in celsius]), ("grad", "t", True, celsius), ("heat", "t", True, [x * 1.8 + 32 for x in celsius]))
    assert settled(spark, frames, counts, names=False) == {"K": ("K", "anchor"), "grad": ("Cel", "links"), "heat": ("degF", "links")}


def test_a_unique_snap_overrules_the_name(spark, frames):
    counts = counted(spark, ("mm", "e", False, [10.0, 12.0, 14.0]), ("inches", "e", False, [1.0, 1.2, 1.4]), ("metres", "f", False, [1.0]))
    assert settled(spark, frames, counts) == {"mm": ("mm", "anchor"), "inches": ("cm", "links"), "metres": ("m", "name")}
    assert "metres" not in settled(spark, frames, counts, names=False)


def test_values_alone_settle_nearly_all_units(spark, data):
    """With the grammar of names off, links still give most rows of the data their unit."""
    from pathlib import Path

    from ledgerloom.session import table

    d = str(Path(data).parent / "sf0.01")
    tables = [table(spark, d, t) for t in ("metric_hint", "ledger_metric", "canonical_metric", "unit_catalog")]
    want, got = (rows(units.recorded_units(*tables, units.Graph(**o)).where("not is_common").select("table_name", "row_id", "unit_code")) for o in ({}, {"names": False, "least": 4}))
    assert len(set(got) & set(want)) >= 0.8 * len(want) and len(set(got) - set(want)) <= 0.01 * len(want)


def test_many_spellings_are_joined(spark, frames):
    rows_ = ({"metric_name": "MAE", "value": "5 hours"}, {"metric_name": "MAE", "value": "5", "unit_hint": "x", "column_label": "Value [wk]"}, {"metric_name": "MAE", "value": "5"})
    read = units.read_quantities(hints(spark, *rows_), spark.createDataFrame([], LEDGER), frames[0])
    known = units.settled_spellings(read, frames[1])
    by_map, by_join = (rows(units.with_unit(read, known, most).select("row_id", "unit_code")) for most in (100, 0))
    assert by_map == by_join == [(0, "h"), (1, "wk"), (2, None)]


def test_name_resolver():
    r = NameResolver([("mae", "MAE", "mean absolute error"), ("rmse", "RMSE", "root mean squared error"), ("ubrmse", None, "unbiased root mean squared error"), ("far", "FAR", "false alarm ratio")])
    for name, key in (("m.a.e.", "mae"), ("avg. abs. error", "mae"), ("error, mean absolute", "mae"), ("unbiased root mean sq. error", "ubrmse"), ("fasle alarm ratio", "far"), ("mеan absolute errors", "mae"), ("meanabsoluteerror", "mae"), ("sowing depth", None), ("", None), (None, None), ("RMSE [cv]", "rmse"), ("x" * 5000, None)):
        assert r.resolve(name) == key, name
    assert distance("abcd", "abdc", 2) == 1 and folded("R M S E") == "rmse"


def test_empty(spark, frames):
    assert rows(units.recorded_units(hints(spark).limit(0), spark.createDataFrame([], LEDGER), *frames)) == []
