import csv
import io

from conftest import rows
from ledgerloom.operators import rejects


def tables(spark, *specs):
    return spark.createDataFrame([(k, d, h, t, "clash") for k, (d, h, t) in enumerate(specs)], "table_id bigint, delimiter string, columns_text string, column_types array<string>, reason string")


def records(spark, *texts):
    return spark.createDataFrame([(i, t, x, "clash", 1) for i, (t, x) in enumerate(texts)], "row_id bigint, table_id bigint, row_text string, text string, _salt int")


def reasons(spark, texts, delimiter=",", types=("text", "int", "double", "date")):
    t = tables(spark, (delimiter, delimiter.join("abcd"[: len(types)]), list(types)))
    got = {r["row_id"]: r["reason"] for r in rejects.judge_rows(records(spark, *[(0, x) for x in texts]), t).collect()}
    return [got[k] for k in range(len(texts))]


def test_reasons_in_their_order(spark):
    texts = ["a,1,2.5,2020-02-29", ",,,", 'a"b,1,2,', '"a""b",1,2,', '"a,1,2,', "a,1,2", "a,1,2,,", "a,x,2,", "a,1,n/a,", "a,1,2,2021-02-29", "a,+1,-.5e3,", '"x\ny",1,2,', "x\ny,1,2,", '"a"b,1,2,', "", None, 'a, "1",2,']
    want = [None, None, "broken_quoting", None, "broken_quoting", "column_count", "column_count", "invalid_value", "invalid_value", "invalid_value", None, None, "broken_quoting", "broken_quoting", "column_count", "column_count", "broken_quoting"]
    assert reasons(spark, texts) == want


def test_values_by_type(spark):
    assert reasons(spark, ["nan", "inf", "1e5", "1.", ".5", "-", "1,5", " 1"], "|", ("double",)) == ["invalid_value", "invalid_value", None, None, None, "invalid_value", "invalid_value", "invalid_value"]
    assert reasons(spark, ["9" * 60, "-0", "1.0", ""], "|", ("int",)) == [None, None, "invalid_value", None]
    assert reasons(spark, ["0000-01-01", "2020-1-01", "2020-12-31"], "|", ("date",)) == ["invalid_value", "invalid_value", None]


def test_special_delimiters(spark):
    for d in ("|", "\t", ";", ".", "^", "§", "→", "\x1f"):
        assert reasons(spark, [f"a{d}1", f'"a{d}b"{d}1', f"a{d}1{d}2"], d, ("text", "int")) == [None, None, "column_count"]


def test_delimiters_that_separate_nothing(spark):
    for d in ('"', "\n", "", "||"):
        assert reasons(spark, ["a", f"a{d}1", None], d, ("text", "int")) == ["broken_quoting", "broken_quoting", "column_count"]


def test_days_of_the_calendar():
    import datetime

    import pyarrow as pa

    def is_day(text):
        try:
            return bool(datetime.date.fromisoformat(text))
        except ValueError:
            return False

    days = [f"{y:04}-{m:02}-{d:02}" for y in (0, 1, 1900, 2000, 2023, 2024) for m in range(14) for d in range(33)]
    assert rejects.real_days(pa.array(days)).tolist() == [is_day(x) for x in days]


def test_headers(spark):
    t = tables(spark, (",", "a,b", ["text"] * 2), (",", "a,a", ["text"] * 2), (",", "a,", ["text"] * 2), (",", "a", ["text"] * 2), (",", 'a,"b', ["text"] * 2), (",", '"a",a', ["int"] * 2), (None, "a,b", ["int"] * 2), (",", None, ["int"]), (",", "10,0", ["int"] * 2))
    got = {r["table_id"]: r["reason"] for r in rejects.judge_headers(t).collect()}
    assert [got[k] for k in range(9)] == [None, "invalid_value", "invalid_value", "column_count", "broken_quoting", "invalid_value", None, "column_count", None]


def test_typed_rows_keep_text_and_value(spark):
    t = tables(spark, (";", "n;d;x", ["int", "date", "double"]))
    cells = rejects.typed_rows(records(spark, (0, '"7";2020-01-02;1.5e1'), (0, "x;;"), (0, ";;")), t).orderBy("row_id").collect()
    assert [r["row_id"] for r in cells] == [0, 2]
    assert [(c["name"], c["text"]) for c in cells[0]["cells"]] == [("n", "7"), ("d", "2020-01-02"), ("x", "1.5e1")]
    assert (int(cells[0]["cells"][0]["int_value"]), str(cells[0]["cells"][1]["date_value"]), cells[0]["cells"][2]["double_value"]) == (7, "2020-01-02", 15.0)
    assert [c["text"] for c in cells[1]["cells"]] == [None, None, None]


def test_valid_rows_read_as_csv_does(spark, data):
    from ledgerloom.session import table

    t, r = table(spark, data, "recovered_table"), table(spark, data, "recovered_row")
    delimiter = {x["table_id"]: x["delimiter"] for x in t.collect()}
    text = {x["row_id"]: (x["table_id"], x["row_text"]) for x in r.collect()}
    for x in rejects.typed_rows(r, t).collect():
        table_id, raw = text[x["row_id"]]
        want = next(csv.reader(io.StringIO(raw), delimiter=delimiter[table_id]))
        assert [c["text"] or "" for c in x["cells"]] == want


def test_rows_without_a_table_and_empty_tables(spark):
    t = tables(spark, (",", "a", ["text"]))
    assert rejects.judge_rows(records(spark, (5, "a")), t).count() == 0
    assert rows(rejects.rejects(records(spark).limit(0), t.limit(0))) == []
