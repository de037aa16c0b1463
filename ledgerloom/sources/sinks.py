"""Exports: JSON without nulls, tables of a workbook, Markdown, a research-object crate."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, BooleanType, DataType, DoubleType, IntegerType, LongType, StructType


def json_rows(df: DataFrame) -> DataFrame:
    """Each row as one JSON object, nulls left out (K1)."""
    return df.select(F.to_json(F.struct("*"), {"ignoreNullFields": "true"}).alias("value"))


def json_schema(kind: DataType) -> dict:
    """A JSON schema of a Spark type (K2): closed objects whose fields are all required."""
    if isinstance(kind, StructType):
        return {"type": "object", "properties": {f.name: json_schema(f.dataType) for f in kind}, "required": [f.name for f in kind], "additionalProperties": False}
    if isinstance(kind, ArrayType):
        return {"type": "array", "items": json_schema(kind.elementType)}
    plain = {BooleanType: "boolean", IntegerType: "integer", LongType: "integer", DoubleType: "number"}
    return {"type": plain.get(type(kind), "string")}


def write_sheets(sheets: dict[str, DataFrame], folder: str, format_: str = "parquet") -> list[str]:
    """The tables of a workbook (K5), each under its name."""
    for name, df in sheets.items():
        df.write.mode("overwrite").format(format_).options(header="true").save(f"{folder}/{name}")
    return sorted(sheets)


def markdown_table(cells: DataFrame) -> DataFrame:
    """Recovered tables as Markdown (K12): ``(table_id, markdown)``.

    ``cells`` has (table_id, row_index, col_ordinal, column, value); bars are escaped and
    missing cells are empty.
    """
    clean = lambda c: F.regexp_replace(F.regexp_replace(F.coalesce(c, F.lit("")), r"\|", r"\\|"), r"[\r\n]+", " ")
    rows = cells.groupBy("table_id", "row_index").agg(F.array_sort(F.collect_list(F.struct("col_ordinal", clean(F.col("column")).alias("c"), clean(F.col("value")).alias("v")))).alias("x"))
    line = lambda field: F.concat(F.lit("| "), F.array_join(F.transform("x", lambda e: e[field]), " | "), F.lit(" |"))
    rule = F.concat(F.lit("|"), F.array_join(F.transform("x", lambda _: F.lit(" --- ")), "|"), F.lit("|"))
    lined = rows.select("table_id", "row_index", line("v").alias("line"), F.concat_ws("\n", line("c"), rule).alias("head"))
    body = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("row_index", "line"))), lambda e: e["line"]), "\n")
    return lined.groupBy("table_id").agg(F.concat_ws("\n", F.min_by("head", "row_index"), body).alias("markdown"))


def crate_node(identifier: Column, name: Column, digest: Column) -> Column:
    """A file's node of a research-object crate (K7)."""
    return F.to_json(F.struct(identifier.alias("@id"), F.lit("File").alias("@type"), name.alias("name"), digest.alias("sha256")))


def bundle_text(sections: DataFrame, keys: list[str]) -> DataFrame:
    """Ordered sections as one text with its hash (K8); ``sections`` has (ord, text)."""
    text = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("ord", "text"))), lambda s: s["text"]), "\n\n")
    return sections.groupBy(*keys).agg(text.alias("text")).withColumn("sha256", F.sha2("text", 256))
