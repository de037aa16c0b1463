import glob
import json
import math
import os

import duckdb
import pandas as pd
import pytest

from conftest import rows
from ledgerloom.functions import ids, metrics, numbers, text
from ledgerloom.operators import audit, candidates, discovery, ledger, rules
from ledgerloom.plans import catalog
from pyspark.sql import functions as F


@pytest.fixture(scope="module")
def duck(data):
    con = duckdb.connect()
    for p in glob.glob(f"{data}/*.parquet"):
        con.execute(f"CREATE VIEW {os.path.basename(p)[:-8]} AS SELECT * FROM '{p}'")
    return con


def plain(v):
    if v is None or v is pd.NaT or (isinstance(v, float) and math.isnan(v)):
        return None
    return round(v, 6) + 0.0 if isinstance(v, float) else v


def ordered(columns, data):
    order = sorted(range(len(columns)), key=lambda k: columns[k])
    return [columns[k] for k in order], sorted((tuple(plain(r[k]) for k in order) for r in data), key=repr)


@pytest.mark.parametrize("name", sorted(catalog.SQL))
def test_both_engines_agree(spark, data, duck, name):
    df = catalog.QUERIES[name](spark, data)
    cursor = duck.execute(catalog.SQL[name])
    assert ordered(df.columns, [tuple(r) for r in df.collect()]) == ordered([c[0] for c in cursor.description], cursor.fetchall())


NAMES = metrics.Names(((" mae ", "mae"), (" mean absolute error ", "mae"), (" rmse ", "rmse")))


def one(spark, column, **values):
    kinds = {str: "string", int: "bigint", float: "double", list: "array<string>", type(None): "string"}
    df = spark.createDataFrame([tuple(values.values())], ", ".join(f"{k} {kinds[type(v)]}" for k, v in values.items()))
    return df.select(column.alias("x")).first()["x"]


def test_displays(spark):
    shown = {
        "5.7": "scalar", "5.7 days": "text_summary", "3.9-7.5": "range", "3.9 – 7.5": "range", "0.900 (0.888–0.920)": "estimate_with_range", "16.3 ± 2.3": "estimate_with_uncertainty",
        "0.7 to 1.3": "range", "7-3": "text_summary", "-0.5": "scalar", "1,234": "scalar", "12 %": "scalar", "median 4": "text_summary", ".5": "scalar", "": "text_summary", "text": "text_summary",
        "2.8-5.1 days (median 3.9 days)": "estimate_with_range", "mean: 3.9 d; range 2.8 to 5.1": "estimate_with_range", "-5 - -3": "range", "-5–3": "range", "1e-11": "scalar", "1.5e3 +/- -2": "estimate_with_uncertainty",
        "1,234.5": "text_summary", "about 95% CI": "text_summary", "5-": "text_summary",
    }
    df = numbers.with_quantity(spark.createDataFrame([*enumerate(shown), (99, None)], "k int, s string"), "s", "q")
    got = {r["s"]: r["q"] for r in df.collect()}
    assert {s: got[s]["kind"] for s in shown} == shown and got[None] is None
    three = lambda s: (got[s]["numeric_value"], got[s]["lower_bound"], got[s]["upper_bound"])
    assert three("0.900 (0.888–0.920)") == (0.9, 0.888, 0.92) and three("2.8-5.1 days (median 3.9 days)") == three("mean: 3.9 d; range 2.8 to 5.1") == (3.9, 2.8, 5.1)
    assert three("-5 - -3") == (None, -5, -3) and three("-5–3") == (None, -5, 3) and got["1e-11"]["numeric_value"] == 1e-11 and got["1.5e3 +/- -2"]["uncertainty"] == 2
    assert (got["7-3"]["parse_error"], got["-0.5"]["numeric_value"], got["1,234"]["numeric_value"], got["12 %"]["unit_code"], got["median 4"]["aggregation"]) == ("descending_range", -0.5, 1.234, "%", "median")
    assert (got["about 95% CI"]["nominal_level"], got["mean: 3.9 d; range 2.8 to 5.1"]["aggregation"], got["0.7 to 1.3"]["range_basis"]) == (0.95, "mean", "reported range (basis not stated)")


def test_quantities_are_filled_in_but_not_overwritten(spark):
    said = [("about 5", "5.0", None), ("3-7", "9", "Values lay between 3 and 7; the median was 4.5."), ("3-7", None, "From 3 to 7 with a median of 5. Nothing else"), ("6", "7", "median 8 of 6"), (None, None, None), (None, "2 to 4", None), ("text", "more text", "mean 3")]
    df = spark.createDataFrame([(k, *r) for k, r in enumerate(said)], "k int, a string, b string, t string")
    got = [tuple(r["q"]) for r in numbers.enriched(df, "a", "b", "t", "q").orderBy("k").collect()]
    assert got == [("scalar", 5, None, None), ("range", None, 3, 7), ("estimate_with_range", 5, 3, 7), ("scalar", 6, None, None), (None, None, None, None), ("range", None, 2, 4), ("text_summary", None, None, None)]


def test_identities(spark):
    assert [one(spark, numbers.number_key(F.col("v")), v=v) for v in (0.9, 100.0, -0.0, 12.5, 1e-11)] == ["0.9", "100", "0", "12.5", "0.00000000001"]
    listed = [("rmse", "RMSE", "root mean squared error"), ("ubrmse", None, "unbiased root mean squared error"), ("mae", "MAE", "mean absolute error")]
    names = metrics.Names.of(spark.createDataFrame(listed, "metric_key string, short_name string, full_name string"))
    keys = lambda n: one(spark, F.array_join(names.families(F.col("n")), ","), n=n)
    assert one(spark, names.identity(F.col("n")), n="Maximum  RMSE") == "rmse+maximum" and one(spark, names.identity(F.col("n")), n="Snow  depth") == "snow depth"
    assert (keys("root mean squared error"), keys("unbiased Root-mean squared error"), keys("RMSE and MAE"), keys("maes"), keys("")) == ("rmse", "ubrmse", "mae,rmse", "", "")
    assert one(spark, names.named(F.col("n")), n="an MAE of 3") and not one(spark, metrics.Names(()).named(F.col("n")), n="MAE")
    assert one(spark, text.token_key(F.col("n")), n="b a, A") == "a|a|b"
    assert one(spark, ids.candidate_id(F.col("a"), F.lit(None).cast("string")), a="x") == __import__("hashlib").sha256(b"x\n").hexdigest()[:16]
    assert one(spark, ids.canonical_json(b=F.col("b"), a=F.col("a")), a='q"ü/', b=None) == json.dumps({"a": 'q"ü/', "b": None}, ensure_ascii=False, separators=(",", ":"))


def test_captions_and_headings(spark):
    assert [one(spark, text.caption_number(F.col("c")), c=c) for c in ("Table 4. x", "Figure IV shows", "Fig. A1: y", "Tables of", None)] == ["4", "4", "A1", None, None]
    assert [one(spark, text.roman(F.col("c")), c=c) for c in ("XIV", "III", "XC")] == [14, 3, 90]
    assert [one(spark, text.heading_title(F.col("c")), c=c) for c in ("## 2 Data 114", "# 3 Since 1990", "Intro 12")] == ["2 Data", "3 Since 1990", "Intro 12"]
    assert one(spark, text.related_sections(F.col("a"), F.col("b")), a="4 Results", b="4.2 Validation") is True
    assert one(spark, text.related_sections(F.col("a"), F.col("b")), a="4 Results", b="41 Other") is False


def test_paths_are_portable_and_stay_so(spark):
    for path, want in (("/data/p1/raw/x.pdf", "raw/x.pdf"), ("C:\\in\\x.pdf", "x.pdf"), ("raw\\x.pdf", "raw/x.pdf"), ("/other/x.pdf", "x.pdf"), ("", ""), (None, None)):
        once = one(spark, text.portable_path(F.col("p"), F.lit("/data/p1")), p=path)
        assert once == want and one(spark, text.portable_path(F.col("p"), F.lit("/data/p1")), p=once) == want


def test_chunks_cover_the_text(spark):
    for n in (0, 1, 4000, 4001, 70_000):
        parts = one(spark, text.chunks(F.col("t")), t="x" * n)
        assert "".join(parts) == "x" * n and all(len(p) <= 4000 for p in parts) and len(parts) >= 1
    assert one(spark, text.json_pointer(F.col("p")), p=["a/b", "c~d"]) == "/a~1b/c~0d"


def test_sentence_windows(spark):
    df = spark.createDataFrame([(1, "One. Two! Three?"), (2, ""), (3, None), (4, "x" * 2000 + ". y.")], "id int, t string")
    got = candidates.sentence_windows(df, ["id"], "t").collect()
    assert [r["window"] for r in got if r["id"] == 1] == ["One.", "One. Two!", "Two!", "Two! Three?", "Three?"]
    assert {r["id"] for r in got} == {1, 4} and [r["window"] for r in got if r["id"] == 4] == ["y."]


def test_merge_is_not_transitive(spark):
    def survivors(*stats):
        df = spark.createDataFrame([(1, k, "RMSE", "5", a, None, None) for k, a in enumerate(stats)], "bundle_id bigint, metric_id bigint, name string, display string, aggregation string, unit string, interpretation string")
        return rows(ledger.deduplicate_metrics(df, NAMES).select("metric_id", "aggregation", "members"))

    assert survivors("median", None, "mean") == [(0, "median", 2), (2, "mean", 1)]
    assert survivors(None, "mean", "median") == [(0, "mean", 2), (2, "median", 1)]


def test_metrics_of_other_targets_or_contexts_stay_apart(spark):
    base = {"bundle_id": 1, "name": "RMSE", "display": "5.0", "aggregation": None, "unit": None, "interpretation": None, "context": "c", "scope": "s", "target": "rain at the site", "support": "grid", "population": None}
    rows_ = [{}, {"context": "d"}, {"scope": "t"}, {"target": "snow"}, {"support": "region"}, {"display": "5", "target": "site, rain", "unit": "mm", "population": "9 sites"}, {"display": "5", "interpretation": "as given"}]
    kinds = ", ".join(f"{k} {'bigint' if k == 'bundle_id' else 'string'}" for k in base)
    df = spark.createDataFrame([(*(base | r).values(), k) for k, r in enumerate(rows_)], f"{kinds}, metric_id bigint")
    got = {r["metric_id"]: r for r in ledger.deduplicate_metrics(df, NAMES).collect()}
    assert sorted(got) == [0, 1, 2, 3, 4] and got[0]["members"] == 3
    # the sixth is richer than the first, and takes what it lacks from the seventh
    assert (got[0]["primary_id"], got[0]["display"], got[0]["unit"], got[0]["population"], got[0]["interpretation"]) == (5, "5", "mm", "9 sites", "as given")


def test_subsets_and_overlap_by_brute_force(spark):
    import itertools
    import random

    rng = random.Random(2)
    sets = {f"s{k}": sorted(rng.sample("abcdefgh", rng.randrange(1, 6))) for k in range(40)}
    df = spark.createDataFrame([(1, k, v) for k, v in sets.items()], "g int, id string, w array<string>")
    got = {(r["parent"], r["child"]) for r in ledger.subset_targets(df, ["g"], "w", "id").collect()}
    assert got == {(a, b) for a, b in itertools.permutations(sets, 2) if set(sets[a]) < set(sets[b])}
    near = {(r["a"], r["b"]) for r in ledger.token_overlap_pairs(df, ["g"], "id", "w", 0.6).collect()}
    assert near == {(a, b) for a, b in itertools.combinations(sorted(sets), 2) if len(set(sets[a]) & set(sets[b])) / len(set(sets[a]) | set(sets[b])) >= 0.6}


def test_caption_matching_is_one_to_one(spark):
    captions = spark.createDataFrame([(1, 0, "2", 5, "Yield at sites"), (1, 1, None, 7, "Rain"), (1, 2, None, 5, "Soil carbon by depth"), (1, 3, "9", 1, "Other")], "doc_id bigint, caption_ord int, number string, page int, caption string")
    items = spark.createDataFrame([(1, "a", "2", 5, "Yield"), (1, "b", None, 7, "Rain totals"), (1, "c", None, 9, "Soil carbon by depth"), (1, "d", "8", 1, "Other")], "doc_id bigint, item_id string, number string, page int, caption string")
    assert rows(audit.match_captions(captions, items).select("caption_ord", "item_id", "reason")) == [(0, "a", "number"), (1, "b", "only_on_page"), (2, "c", "similar")]


def test_captions_of_all_lines_match_items_of_their_kind(spark, tmp_path):
    late = "Intro.\n\nTable 4.  Yield at  the sites, " + "x " * 150 + "\nFigure 2 is missing from the copy.\n"
    docs = [(7, late, 1), (8, "Figure 2. Rain", 1), (9, "Table 4. Rain again", 1), (10, "Table 3. Elsewhere", 2)]
    spark.createDataFrame(docs, "doc_id bigint, text string, bundle_id bigint").write.parquet(f"{tmp_path}/documents.parquet")
    items = [(1, "t4", "table", "Table 4. Yield"), (1, "t4b", "table", "Table 4. Rain again"), (1, "t2", "table", "Table 2. Soil"), (1, "f2", "figure", "Figure 2. Rain"), (1, "t3", "table", "Table 3. Elsewhere")]
    spark.createDataFrame([(b, i, t, 1, None, None, c) for b, i, t, c in items], "bundle_id bigint, source_item_id string, item_type string, source_page int, source_location string, section_hint string, caption string").write.parquet(f"{tmp_path}/registry_item.parquet")
    got = rows(catalog.QUERIES["caption_matches"](spark, str(tmp_path)).select("doc_id", "caption_ord", "line_no", "item_id"))
    assert got == [(1, 7, 2, "t4"), (1, 8, 0, "f2"), (1, 9, 0, "t4b")]


def test_boxes_alike_by_place_or_text(spark):
    boxes = [(1, 1, 0, 0.0, 10.0, 0.0, 10.0, "y = a x + b"), (1, 1, 1, 1.0, 11.0, 0.0, 10.0, "other"), (1, 1, 2, 50.0, 60.0, 50.0, 60.0, "Y = a x + b"), (1, 2, 3, 0.0, 10.0, 0.0, 10.0, "y = a x + b"), (1, 1, 4, 90.0, 95.0, 90.0, 95.0, ""), (1, 1, 5, 70.0, 75.0, 90.0, 95.0, " "), (1, 1, 6, None, None, None, None, None)]
    df = spark.createDataFrame(boxes, "doc_id int, page int, ord int, l double, r double, t double, b double, text string")
    assert rows(audit.alike_pairs(df).select("a", "b")) == [(0, 1), (0, 2)]


def test_sections_within_one_another_are_compatible(spark):
    for a, b, want in (("Results", "Main results", True), ("4 Results", "4.2 Validation", True), ("Data", "Methods", False), ("", "Data", False), (None, "Data", False)):
        assert one(spark, text.compatible_sections(F.col("a"), F.col("b")), a=a, b=b) is want, (a, b)


def test_quality_and_queue(spark):
    t = spark.createDataFrame([(1, 1, 5, 1.0, 0.0, True, False), (2, 5, 5, 0.3, 0.0, False, False), (3, 5, 5, 0.5, 0.0, True, False), (4, 5, 5, 1.0, 0.9, True, False), (5, 6, 5, 1.0, 0.9, True, False), (6, 9, 5, None, None, True, True)], "id int, rows int, columns int, non_empty double, leading_blank double, has_header boolean, failed boolean")
    assert [r["status"] for r in audit.table_quality(t).orderBy("id").collect()] == ["required", "required", "review", "not_needed", "recommended", "required"]
    judged = spark.createDataFrame([(1, ["a", " ", "c"]), (1, ["", "", "x"]), (1, None), (2, None)], "table_id int, cells array<string>")
    assert rows(audit.cell_metrics(judged)) == [(1, 3, 2, 0.5, 0.75), (2, 1, 0, None, None)]


def test_no_issue_gives_one_info_row(spark):
    from ledgerloom.session import table

    empty = [table(spark, "/root/testdata/sf0.001", n).limit(0) for n in ("ledger_metric", "evidence", "registry_item")]
    assert rows(rules.all_issues(*empty).select("code", "severity")) == [("NO_DETERMINISTIC_ISSUES", "info")]


def test_prose_pairs(spark):
    df = spark.createDataFrame([("We obtain MAE = 5.2 ± 0.3 d (winter rye).",), ("POD of 0.56 was found for faba bean.",), ("Nothing here.",), (None,)], "t string")
    got = discovery.prose_pairs(df, "t").collect()
    assert [(r["pair_name"], r["pair_value"], r["pair_target"]) for r in got] == [("MAE", "5.2 ± 0.3 d", "winter rye"), ("POD", "0.56", "faba bean"), (None, None, None), (None, None, None)]


def test_cache_split(spark):
    items = spark.createDataFrame([("a", 1), ("b", 1), (None, 1)], "sha string, v int")
    cache = spark.createDataFrame([("a", "answer")], "sha string, reply string")
    known, new = discovery.with_cached(items, cache, ["sha"])
    assert rows(known.select("sha", "reply")) == [("a", "answer")] and new.count() == 2
