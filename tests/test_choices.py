from ledgerloom.functions import choices as c
from pyspark.sql import functions as F


def value(spark, column):
    return spark.range(1).select(column.alias("x")).first()["x"]


def lit(v, kind="string"):
    return F.lit(v).cast(kind)


def test_statuses(spark):
    assert [value(spark, c.ocr_decision(lit(m), lit(s, "boolean"))) for m, s in (("always", False), ("never", True), ("auto", False), ("auto", None))] == [True, False, False, True]
    assert [value(spark, c.overall_status(*[lit(v, "int") for v in n])) for n in ((1, 0, 0), (0, 1, 0), (0, 0, 2), (0, 0, 0))] == ["recovery_required", "review", "review", "pass"]
    assert [value(spark, c.effective_status(lit("review"), lit(u, "int"), lit(r, "int"))) for u, r in ((1, 1), (0, 1), (0, 0))] == ["review", "pass_after_recovery", "review"]
    tiers = [("high", ["workflow", "diagram"]), ("low", ["photo"])]
    assert [value(spark, c.keyword_tier(lit(t), tiers, "medium")) for t in ("A Photo of a Workflow", "photo", "map", None)] == ["high", "low", "medium", "medium"]


def test_phrases(spark):
    assert value(spark, c.candidate_target(lit(" Winter  Wheat (n = 12) "))) == "winter wheat"
    assert value(spark, c.numeric_tokens(lit("1,5 to 2.25 (3)"))) == ["1.5", "2.25", "3"]
    assert value(spark, c.parameter_phrase(lit("A fixed smoothing weight was used"), ["weight", "depth"])).endswith("smoothing weight")
    assert value(spark, c.parameter_phrase(lit("nothing"), ["weight"])) is None


def test_shapes(spark):
    def shape(*v):
        return tuple(value(spark, c.coerced_shape(lit(v[0]), *[lit(x, "double") for x in v[1:]])))

    assert shape("range", None, 1, None) == ("text_summary", None, None, None, None)
    assert shape("scalar", 2, 1, 3) == ("estimate_with_range", 2.0, 1.0, 3.0, None)
    assert shape("range", None, 7, 3)[4] == "descending_range"
    assert value(spark, c.horizontal_overlap(*[lit(x, "double") for x in (0, 10, 5, 25)])) == 0.5


def test_figure_score(spark):
    def score(**over):
        base = dict(same_page=True, numbers_conflict=False, same_number=True, width=200, height=100, area_ratio=0.03, distance=100, overlap=0.5, above=True, similarity=0.9) | over
        return value(spark, c.figure_score({k: lit(v, "boolean" if isinstance(v, bool) else "double") for k, v in base.items()}))

    assert score() == 12.0 and score(same_page=False) is None and score(numbers_conflict=True) is None
    assert score(width=10, area_ratio=0.0, distance=600, same_number=False, overlap=0.0, above=False, similarity=0.0) == -8.5


def test_lists(spark):
    rows = lambda v: F.array(*[lit(x) for x in v])
    assert value(spark, c.ragged_row(rows("abcd"), F.lit(3))) == ["a", "b", "c d"]
    assert value(spark, c.ragged_row(rows("a"), F.lit(3))) == ["a", "", ""]
    assert value(spark, c.appended_once(rows("ab"), lit("a"))) == ["a", "b"] and value(spark, c.appended_once(lit(None, "array<string>"), lit("z"))) == ["z"]
    assert value(spark, c.without(rows("ab"), rows("ab"))) is None and value(spark, c.without(rows("ab"), rows("b"))) == ["a"]


def test_first_json():
    assert c.first_json('Sure:\n```json\n{"a": "}{", "b": [1]}\n``` {"c": 1}') == '{"a": "}{", "b": [1]}'
    assert c.first_json("{ broken } {\"ok\": 1}") == '{"ok": 1}' and c.first_json("none") is None and c.first_json(None) is None
