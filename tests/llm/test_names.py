from conftest import rows
from ledgerloom.llm import canonical_names as names
from ledgerloom.session import table


def mapped(spark, written, reference=None):
    ref = reference or spark.createDataFrame([("mae", "MAE", "mean absolute error", "x"), ("rmse", "RMSE", "root mean squared error", "x"), ("ubrmse", "ubRMSE", "unbiased root mean squared error", "x"), ("sde", "SDE", "standard deviation of errors", "x"), ("far", "FAR", "false alarm ratio", "x"), ("oa", "OA", "overall accuracy", "x"), ("pra", None, "producer accuracy", "x"), ("cv", "CV", "coefficient of variation", "x")], "metric_key string, short_name string, full_name string, score string")
    df = spark.createDataFrame([(w, 1) for w in written], "written string, metric_key int")
    return {r["written"]: r["metric_key"] for r in names.map_names(df, "written", ref).collect()}


def test_repairs_and_decoys(spark):
    want = {
        "mean absolute error": "mae", "M A E": "mae", "mean absolte error": "mae", "error, mean absolute": "mae", "meanabsoluteerror": "mae", "avg. abs. error": "mae", "mеan absolute errors": "mae",
        "unbiased root mean sq. error": "ubrmse", "root mean squared error (RMSE)": "rmse", "std. dev. of errors": "sde", "fasle alarm ratio": "far", "overall producer accuracy": "pra", "RMSE [cv]": "rmse", "CV": "cv",
        "mean sowing order": "unmatched", "sowing depth": "unmatched", "share 65B": "unmatched", "!!!": "unmatched", "x" * 3000: "unmatched",
    }
    assert mapped(spark, want) == want


def test_nulls_blanks_repeats_and_empty(spark):
    assert mapped(spark, [None, "", "   ", "MAE", "MAE"]) == {"MAE": "mae"}
    assert mapped(spark, []) == {}
    empty = spark.createDataFrame([], "metric_key string, short_name string, full_name string")
    assert mapped(spark, ["MAE"], empty) == {"MAE": "unmatched"}


def test_token_join_finds_what_brute_force_finds(spark):
    from ledgerloom.functions.names import distance

    vocabulary = ["absolute", "deviation", "squared", "mean", "error", "interval"]
    tokens = ["absolte", "aboslute", "deviaton", "sqared", "maen", "eror", "intervall", "absolute", "zzz", "meen", "devition", "xabsolutex", "absoute"]
    got = {(r["token"], r["word"]) for r in names.repair_tokens(spark.createDataFrame([(t,) for t in tokens], "token string"), spark.createDataFrame([(w, False) for w in vocabulary], "word string, name boolean")).collect()}
    reach = lambda w: 0 if len(w) < 4 else 1 if len(w) < 6 else 2
    for t in tokens:
        for w in vocabulary:
            if t not in vocabulary and distance(t, w, 3) <= reach(w):
                assert (t, w) in got, (t, w)
    assert ("zzz", "mean") not in got and ("absolute", "absolute") in got


def test_both_forms_agree_on_the_data(spark, data):
    from ledgerloom.functions.names import NameResolver

    ref = table(spark, data, "canonical_metric")
    resolver = NameResolver([tuple(r) for r in ref.select("metric_key", "short_name", "full_name").collect()])
    hints = table(spark, data, "metric_hint")
    got = names.map_names(hints, "metric_name", ref).collect()
    assert got and all((resolver.resolve(r["written"]) or "unmatched") == r["metric_key"] for r in got)


def test_rows_come_with_their_entry(spark, data):
    ref, hints = table(spark, data, "canonical_metric"), table(spark, data, "metric_hint")
    all_rows = names.mapped_rows([("metric_hint", hints, "hint_id", "metric_name")], ref)
    assert all_rows.count() == hints.where("trim(metric_name) <> ''").count()
    assert rows(names.not_verbatim(all_rows, ref).where("written in ('MAE', 'mean absolute error')")) == []


def test_names_are_read_once_and_once_for_the_result(spark, data):
    from ledgerloom.llm import queries

    plan = queries.p5_found(spark, data)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan") == 2  # the rows of the two tables; names come from a cut
