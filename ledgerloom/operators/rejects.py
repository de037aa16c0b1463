"""Rows that fail to parse: typed rows on one side, rejects with their reason on the other.

Method: the quoting rule is one regular expression for each delimiter, evaluated in the
JVM.  Well-quoted records go through the CSV reader of Arrow, whose invalid-row callback
gives the structural rejects; all fields are read as strings, whole column vectors are
then tested against their declared type and the failing cells labelled.

Reasons, the first that applies:
``broken_quoting``  a quote outside the quoting rule, or an unquoted line break
``column_count``    another number of cells than declared types
``invalid_value``   a cell not of its type; in headers an empty or a repeated name

Defined results: a null record or null header is ``column_count``; a record without a table
is not judged; an empty cell is a valid null; a delimiter that is null counts as a comma,
any other character may delimit; under a quote, a line break or more or less than one
character as delimiter every record is ``broken_quoting``; an empty list of types accepts
no record.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import pyarrow.csv as pacsv
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: The shape of each type's cells.
SHAPES = {
    "int": r"^[+-]?[0-9]+$",
    "double": r"^[+-]?([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?$",
    "date": r"^[0-9]{4}-[0-9]{2}-[0-9]{2}$",
}

CELL = "array<struct<name:string,type:string,text:string,int_value:decimal(38,0),double_value:double,date_value:date>>"
_OUT = "row_id bigint, table_id bigint, reason string, bad_cells array<int>, cells array<string>, types array<string>, names array<string>"


def well_quoted(text: Column, delimiter: Column) -> Column:
    """Whether every cell is free of quotes and line breaks or quoted as a whole."""
    free = F.translate(text, '"\r\n', "") == text
    # Java quotes the delimiter between \Q and \E, so any character may delimit
    mark = F.concat(F.lit("\\Q"), delimiter, F.lit("\\E"))
    cell = F.concat(F.lit('(?:"(?:[^"]|"")*+"|(?:(?!'), mark, F.lit(')[^"\r\n])*+)'))
    rule = F.concat(F.lit("^"), cell, F.lit("(?:"), mark, cell, F.lit(")*+\\z"))
    return free | F.rlike(text, rule)


def real_days(column: pa.Array) -> np.ndarray:
    """Which strings of the shape yyyy-mm-dd are days of the calendar."""
    year, month, day = (pc.cast(pc.utf8_slice_codeunits(column, a, b), pa.int32()).to_numpy(zero_copy_only=False) for a, b in ((0, 4), (5, 7), (8, 10)))
    leap = (year % 4 == 0) & ((year % 100 != 0) | (year % 400 == 0))
    inside = (month >= 1) & (month <= 12)
    # of the last day only: 30, and 31 in the odd months up to July and the even ones after
    last = np.where(month == 2, 28 + leap, 30 + (month + (month > 7)) % 2)
    return inside & (year >= 1) & (day >= 1) & (day <= last)


def valid_cells(column: pa.Array, kinds: pa.Array) -> np.ndarray:
    """Whether each string is a cell of the type beside it; empty cells are."""
    good = np.ones(len(column), bool)
    told = pc.not_equal(column, "").to_numpy(zero_copy_only=False)
    for kind, shape in SHAPES.items():
        at = np.flatnonzero(told & pc.equal(kinds, kind).fill_null(False).to_numpy(zero_copy_only=False))
        if len(at):
            cells = column.take(pa.array(at))
            shaped = pc.match_substring_regex(cells, shape).to_numpy(zero_copy_only=False).copy()
            if kind == "date" and shaped.any():
                shaped[shaped] = real_days(cells.filter(pa.array(shaped)))
            good[at] = shaped
    return good


def parse_block(ids: list[int], texts: list[str], delimiter: str, width: int) -> tuple[np.ndarray, list[pa.Array], list[int]]:
    """Read records of one delimiter and width: ids and columns of the good, ids of the bad.

    The id is written in front of each record as a cell of its own, so that neither line
    breaks inside cells nor skipped records can shift the numbering.  The reader takes
    delimiters of one byte; any other changes places with a control character.
    """
    bad: list[int] = []
    swap = None
    if not delimiter.isascii():
        swap = str.maketrans({delimiter: "\x1f", "\x1f": delimiter})
        texts, delimiter = [t.translate(swap) for t in texts], "\x1f"

    def skip(row) -> str:
        bad.append(int(row.text.partition(delimiter)[0]))
        return "skip"

    data = "".join(f"{i}{delimiter}{t}\n" for i, t in zip(ids, texts)).encode()
    names = [str(k) for k in range(width + 1)]
    got = pacsv.read_csv(
        pa.BufferReader(data),
        read_options=pacsv.ReadOptions(column_names=names, use_threads=False, block_size=max(1 << 16, len(data) + 1)),
        parse_options=pacsv.ParseOptions(delimiter=delimiter, newlines_in_values=True, ignore_empty_lines=False, invalid_row_handler=skip),
        convert_options=pacsv.ConvertOptions(column_types={n: pa.string() if k else pa.int64() for k, n in enumerate(names)}, strings_can_be_null=False),
    )
    columns = [c.combine_chunks() for c in got.columns]
    if swap:
        columns[1:] = [pa.array([x.translate(swap) for x in c.to_pylist()], pa.string()) for c in columns[1:]]
    return columns[0].to_numpy(zero_copy_only=False), columns[1:], bad


def _judge(only_bad: bool):
    """The judge of a batch of well-quoted records.  Records are read by delimiter and
    width; types are compared as vectors beside each column of cells."""
    schema = pa.schema([("row_id", pa.int64()), ("table_id", pa.int64()), ("reason", pa.string()), ("bad_cells", pa.list_(pa.int32())), ("cells", pa.list_(pa.string())), ("types", pa.list_(pa.string())), ("names", pa.list_(pa.string()))])

    def pack(batch: pa.RecordBatch, at: np.ndarray, reason: pa.Array, bad_cells=None, cells=None) -> pa.RecordBatch:
        kept = batch.take(pa.array(at, pa.int64()))
        none = lambda t: pa.nulls(len(at), t)
        some = [kept.column(n).cast(schema.field(n).type) if not only_bad and n in kept.schema.names else none(schema.field(n).type) for n in ("types", "names")]
        return pa.RecordBatch.from_arrays([kept.column("row_id"), kept.column("table_id"), reason, bad_cells if bad_cells is not None else none(pa.list_(pa.int32())), cells if cells is not None else none(pa.list_(pa.string())), *some], schema=schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            widths = pc.list_value_length(batch.column("types")).fill_null(0).to_pylist()
            groups: dict[tuple[str, int], list[int]] = {}
            for k, key in enumerate(zip(batch.column("delimiter").to_pylist(), widths)):
                groups.setdefault(key, []).append(k)
            for (delimiter, width), members in groups.items():
                if not width:
                    yield pack(batch, np.array(members), pa.array(["column_count"] * len(members)))
                    continue
                # the position in the batch is the id: row ids may repeat
                good, columns, bad = parse_block(members, batch.column("text").take(pa.array(members)).to_pylist(), delimiter, width)
                if bad:
                    yield pack(batch, np.array(bad), pa.array(["column_count"] * len(bad)))
                if not len(good):
                    continue
                kinds = batch.column("types").take(pa.array(good)).flatten()
                valid = np.stack([valid_cells(c, kinds.take(pa.array(np.arange(k, len(kinds), width)))) for k, c in enumerate(columns)], 1)
                wrong = ~valid.all(1)
                keep = np.flatnonzero(wrong) if only_bad else np.arange(len(good))
                if not len(keep):
                    continue
                reason = pa.array(np.where(wrong[keep], "invalid_value", None), pa.string())
                bad_cells = pa.array([np.flatnonzero(~valid[k]).tolist() if wrong[k] else None for k in keep], pa.list_(pa.int32()))
                order = np.arange(width * len(good)).reshape(width, len(good)).T[keep].ravel()
                cells = pa.ListArray.from_arrays(pa.array(np.arange(0, width * len(keep) + 1, width), pa.int32()), pa.concat_arrays(columns).take(pa.array(order)))
                yield pack(batch, good[keep], reason, bad_cells, cells)

    return run


def judge_rows(rows: DataFrame, tables: DataFrame, salts: int = 8, only_bad: bool = False) -> DataFrame:
    """``(row_id, table_id, reason, bad_cells, cells, types, names)`` for every record with a
    table, or for the failing ones only.

    ``reason`` is null for a valid record; ``tables`` may have ``names`` of its columns.
    The declared types are attached by a join on the table; a table may own a third of all
    rows, so its rows are spread over ``salts`` keys and the narrow table side is repeated
    under each.  A key that is still too large adaptive execution splits.
    """
    extra = [F.col("names")] if "names" in tables.columns else []
    types = tables.select(
        "table_id",
        F.coalesce(F.col("delimiter"), F.lit(",")).alias("delimiter"),
        F.col("column_types").alias("types"),
        *extra,
        F.explode(F.sequence(F.lit(0), F.lit(salts - 1))).alias("_salt"),
    )
    salted = rows.select("row_id", "table_id", F.col("row_text").alias("text"), F.pmod(F.xxhash64("row_id"), F.lit(salts)).cast("int").alias("_salt"))
    return _split(salted.join(types, ["table_id", "_salt"]).drop("_salt"), only_bad)


def _split(joined: DataFrame, only_bad: bool = False) -> DataFrame:
    mark = F.col("delimiter")
    quoted = (F.length(mark) == 1) & ~mark.isin('"', "\r", "\n") & well_quoted(F.col("text"), mark)
    early = F.when(F.col("text").isNull(), "column_count").when(~quoted, "broken_quoting")
    marked = joined.withColumn("early", early)
    kept = [F.col(c) if c in joined.columns and not only_bad else F.lit(None).cast("array<string>").alias(c) for c in ("types", "names")]
    none = [F.lit(None).cast("array<int>").alias("bad_cells"), F.lit(None).cast("array<string>").alias("cells")]
    structural = marked.where("early is not null").select("row_id", "table_id", F.col("early").alias("reason"), *none, *kept)
    whole = marked.where("early is null").select("row_id", "table_id", "text", "delimiter", "types", *[c for c in ("names",) if c in joined.columns])
    return structural.unionByName(whole.mapInArrow(_judge(only_bad), _OUT))


def judge_headers(tables: DataFrame) -> DataFrame:
    """``(table_id, reason, names)`` for every header line; reason is null if it is right."""
    lines = tables.select(
        F.col("table_id").alias("row_id"),
        "table_id",
        F.col("columns_text").alias("text"),
        F.coalesce(F.col("delimiter"), F.lit(",")).alias("delimiter"),
        F.transform(F.col("column_types"), lambda _: F.lit("text")).alias("types"),
    )
    read = _split(lines).drop("names")
    names = F.transform(F.col("cells"), lambda c: F.trim(c))
    wrong = F.exists(names, lambda n: n == "") | (F.size(F.array_distinct(names)) < F.size(names))
    return read.select("table_id", F.coalesce(F.col("reason"), F.when(wrong, "invalid_value")).alias("reason"), names.alias("names"))


def rejects(rows: DataFrame, tables: DataFrame) -> DataFrame:
    """Everything that fails: ``(table_name, row_id, reason)``."""
    bad_rows = judge_rows(rows, tables, only_bad=True).where("reason is not null").select(F.lit("recovered_row").alias("table_name"), "row_id", "reason")
    bad_heads = judge_headers(tables).where("reason is not null").select(F.lit("recovered_table").alias("table_name"), F.col("table_id").alias("row_id"), "reason")
    return bad_rows.unionByName(bad_heads)


def typed_rows(rows: DataFrame, tables: DataFrame) -> DataFrame:
    """Valid records with their cells cast: ``(row_id, table_id, cells)``.

    A cell has its text and the value of its type; integers beyond 38 digits keep only
    their text.  Names come from the header where that is right, else ``c0``, ``c1`` ...
    They are joined to the tables, so the rows themselves are joined once, salted.
    """
    heads = judge_headers(tables).where("reason is null").select(F.col("table_id").alias("_t"), "names")
    declared = tables.select("table_id", "delimiter", "column_types")
    named = declared.join(heads, declared["table_id"] == heads["_t"], "left").drop("_t")
    good = judge_rows(rows, named).where("reason is null")

    def cell(text: Column, i: Column) -> Column:
        kind = F.element_at("types", i + 1)
        value = F.when(text != "", text)
        return F.struct(
            F.coalesce(F.element_at("names", i + 1), F.concat(F.lit("c"), i.cast("string"))).alias("name"),
            kind.alias("type"),
            value.alias("text"),
            F.when(kind == "int", value.try_cast("decimal(38,0)")).alias("int_value"),
            F.when(kind == "double", value.try_cast("double")).alias("double_value"),
            F.when(kind == "date", value.try_cast("date")).alias("date_value"),
        )

    return good.select("row_id", "table_id", F.transform("cells", cell).cast(CELL).alias("cells"))
