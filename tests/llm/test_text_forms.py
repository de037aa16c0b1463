from conftest import rows
from ledgerloom.llm import confusables, format_dups


def test_readable_form(spark):
    table = confusables.look_alikes(spark)
    same = ["naïve café", "m² at 3 °C ± 0.5 ‰", "“quoted” – dash — … § 1½", "почва", "ποτάμι", "土壌", "Δ σ ≤ 2 µm", "a\tb\nc\r\n", "", "x" * 10_000, "Größe", "\u0133s \u017f"]
    for t in same:
        assert confusables.canonical_text(t, table) == t
    for t, want in (("ｃａｓｅｓ．", "cases."), ("ﬁeld", "field"), ("Südra", "Südra"), ("ti​tle", "title"), ("a b c　d", "a b c d"), ("аccuracy", "accuracy"), ("ΝO3", "NO3"), ("b-eνen", "b-even"), ("soft­hyphen", "softhyphen"), ("𝐀𝟏", "A1"), ("﻿x", "x"), ("Ꭺccuracy", "Accuracy"), ("ꓐias", "Bias"), ("ⲟverall", "overall"), ("ѵalue", "value"), ("ԍain", "gain"), ("Іnterval", "Interval")):
        assert confusables.canonical_text(t, table) == want, t
        assert confusables.canonical_text(want, table) == want


def test_the_table_decides(spark):
    """Without prototypes letters of other scripts stay, and skeletons keep them apart."""
    empty = confusables.LookAlikes({})
    assert confusables.canonical_text("аccuracy", empty) == "аccuracy" and confusables.skeleton_text("аb", empty) != confusables.skeleton_text("ab", empty)


def test_the_readable_form_has_the_same_skeleton(spark):
    table = confusables.look_alikes(spark)
    for t in ("ｃａｓｅｓ．", "аccuracy", "Ꭺccuracy ꓐias", "М​AE", "ԝidth", "ⲟverall", "ѵalue"):
        plain = confusables.canonical_text(t, table)
        assert plain.isascii() and confusables.skeleton_text(plain, table) == confusables.skeleton_text(t, table)


def test_skeletons_join_what_looks_alike(spark):
    table = confusables.look_alikes(spark)
    s = lambda t: confusables.skeleton_text(t, table)
    assert s("scope") == s("ѕсоре") and s("MAE") == s("МАЕ") and s("l0") == s("1O") and s("café") == s("café")
    assert s("mae") != s("mbe") and s("") == ""


def test_changed_and_groups(spark):
    df = spark.createDataFrame([(1, "MAE", "c"), (2, "МАE", "c"), (3, None, "c"), (4, "", "c"), (5, "MAE", "c"), (6, "почва", "c"), (6, "М​AE", "c")], "id bigint, name string, canonical string")
    assert rows(confusables.changed(df, "id", "name").select("row_id", "canonical")) == [(2, "MAE"), (6, "MAE")]
    assert rows(confusables.skeleton_groups(df.selectExpr("'t' AS table_name", "name AS text")).where("rows > 1").select("canonical", "rows", "forms")) == [("MAE", 4, 3)]
    assert confusables.canonicalise(df, "name", "plain").count() == 7
    assert confusables.changed(df.limit(0), "id", "name").count() == 0


def copies(spark, texts, named=True, beside=None):
    data = [(k, t, (beside or [None] * len(texts))[k], "clash", 0) for k, t in enumerate(texts)]
    df = spark.createDataFrame(data, "id bigint, text string, beside string, fields string, copies int")
    return rows(format_dups.group_copies(df, "id", "text", ["beside"], named).where("row_id <> keep_id").select("keep_id", "row_id"))


def test_formatting_is_ignored(spark):
    same = ["crop: winter wheat; year: 2003", "YEAR: 2003; CROP: WINTER WHEAT", "crop = winter-wheat | year = 2003.", "(crop winter wheat / year 2003)", '"year:2003,\n crop:winter\twheat"', "crop: winter wheat; year: 2003"]
    assert copies(spark, same) == [(0, k) for k in range(1, 6)]


def test_words_stay_in_their_field_and_order(spark):
    assert copies(spark, ["crop: rye; previous crop: oat", "crop: oat; previous crop: rye", "crop: rye oat", "crop: oat rye", "value: 1.5", "value: 15", "value: 1 5", "a; a; b", "a; b; b"], False) == []


def test_sentences_keep_their_commas(spark):
    assert copies(spark, ["For rye at X, the mean reached 4.", "for rye at x the mean reached 4", "The mean reached 4, for rye at X."]) == [(0, 1)]


def test_companions_nulls_and_empty(spark):
    assert copies(spark, ["a", "a", "a", None, None, "", "...", "A!"], beside=["x", "y", "x", "x", "x", None, None, "y"]) == [(0, 2), (1, 7), (5, 6)]
    assert copies(spark, []) == []


def test_names_are_learnt(spark):
    df = spark.createDataFrame([(t,) for t in ["colour: red; size: 5", "size = 4 | colour = blue", "Colour: a, SIZE: 3", "Once: said, never again"]], "t string")
    assert format_dups.learnt_names(df, "t") == ("colour", "size")
    other = ["colour: red; size: 5", "size: 4; colour: blue", "colour: x; size: 1", "size 5, colour red", "weight 5, colour red", "colour red weight 5"]
    assert copies(spark, other) == [(0, 3)]


def test_nothing_is_sorted(spark, monkeypatch):
    from ledgerloom.session import cut

    df = spark.createDataFrame([(1, "A b", None)], "id bigint, text string, beside string")
    steps = []
    monkeypatch.setattr(format_dups, "cut", lambda d: steps.append(d._jdf.queryExecution().executedPlan().toString()) or cut(d))
    for got in (format_dups.group_copies(df, "id", "text", ["beside"]), format_dups.collapse(df, "id", "text", ["beside"])):
        plan = got._jdf.queryExecution().executedPlan().toString()
        assert "Sort" not in plan and "ShuffledHashJoin" in plan, plan
    assert len(steps) == 4 and not any("Sort" in s for s in steps) and any("HashAggregate" in s for s in steps)


def test_repeated_ids_count_once(spark):
    df = spark.createDataFrame([(1, "A b", None), (1, "A b", None), (2, "a B", None)], "id bigint, text string, beside string")
    assert rows(format_dups.group_copies(df, "id", "text", ["beside"])) == [(1, 1, 3), (2, 1, 3)]


def test_brute_force(spark, data):
    import re

    from ledgerloom.session import table

    df = table(spark, data, "evidence").select("evidence_id", "claim", "bundle_id", "source_item_id")
    got = rows(format_dups.group_copies(df, "evidence_id", "claim", ["bundle_id", "source_item_id"]).where("row_id <> keep_id").select("keep_id", "row_id"))

    def fields(t):
        t = re.sub(r"^[\W_]+|[\W_]+$", "", t)
        keyed = re.search(r"[;|]|\s/\s", t) or all(re.match(r"\s*(metric|value|crop|previous crop|site|phase|year|depth)\b", p, re.I) for p in t.replace("-", " ").split(","))
        parts = re.split(r";|\||\s/\s|,", t) if keyed and not t.startswith("For") else [t]
        return tuple(sorted(" ".join(re.findall(r"[^\W_]+(?:\.\d+)?", p.lower())) for p in parts))

    first, want = {}, []
    for r in sorted(df.collect()):
        key = (r[2], r[3], fields(r[1]))
        if key in first:
            want.append((first[key], r[0]))
        first.setdefault(key, r[0])
    assert got == sorted(want, key=repr)


def test_collapse_counts_copies(spark):
    df = spark.createDataFrame([(1, "A b", None), (2, "a B", None), (3, None, None), (4, "c", None)], "id bigint, text string, beside string")
    assert rows(format_dups.collapse(df, "id", "text", ["beside"]).select("id", "copies")) == [(1, 2), (3, 1), (4, 1)]
