"""Named queries of the general training-data problems, each over its whole tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerloom.operators import nested, rejects, units
from ledgerloom.session import table


def p1_found(spark: SparkSession, d: str) -> DataFrame:
    return nested.section_children(table(spark, d, "matrix_record")).select("record_id", "child_kind", "parent_ord", "child_ord")


def _flat(spark: SparkSession, d: str, element: str, columns: list[str]) -> DataFrame:
    rows, _ = nested.shredded(table(spark, d, "matrix_record"))
    return nested.flat_table(rows, element, columns)


def p1_metrics(spark: SparkSession, d: str) -> DataFrame:
    """The table of metrics, with the quantitative value inlined."""
    return _flat(spark, d, "validation_metrics", ["name", "context", "scope_label", "quantitative_value.kind", "quantitative_value.as_reported", "quantitative_value.unit_code"])


def p1_parameters(spark: SparkSession, d: str) -> DataFrame:
    return _flat(spark, d, "tuning_parameters", ["name", "value", "unit"])


def p1_evidence(spark: SparkSession, d: str) -> DataFrame:
    """The table of evidence, shared by sections, metrics and parameters."""
    return _flat(spark, d, "evidence", ["claim", "evidence_type", "source_section", "source_text", "source_page", "source_item_id", "review_status"])


def p1_points(spark: SparkSession, d: str) -> DataFrame:
    return _flat(spark, d, "points", ["label", "value"])


def p1_components(spark: SparkSession, d: str) -> DataFrame:
    return _flat(spark, d, "uncertainty_components", ["name", "value"])


def p1_records(spark: SparkSession, d: str) -> DataFrame:
    """The table of the records themselves, singletons inlined."""
    return _flat(spark, d, "record", ["document_metadata.title", "document_metadata.document_status", "dataset_characteristics.spatial.coverage", "dataset_characteristics.temporal.start"])


def p1_links(spark: SparkSession, d: str) -> DataFrame:
    """Rows of each child table, and how many of them don't find their parent."""
    return nested.links(nested.shredded(table(spark, d, "matrix_record"))[0])


def p3_found(spark: SparkSession, d: str) -> DataFrame:
    return rejects.rejects(table(spark, d, "recovered_row"), table(spark, d, "recovered_table"))


def p3_valid(spark: SparkSession, d: str) -> DataFrame:
    """One row for each cell of a valid record, in the column of its type."""
    cells = rejects.typed_rows(table(spark, d, "recovered_row"), table(spark, d, "recovered_table"))
    one = cells.select("row_id", "table_id", F.posexplode("cells").alias("cell_ord", "cell"))
    return one.select("row_id", "table_id", "cell_ord", "cell.*")


def _units(spark: SparkSession, d: str) -> DataFrame:
    return units.recorded_units(table(spark, d, "metric_hint"), table(spark, d, "ledger_metric"), table(spark, d, "canonical_metric"), table(spark, d, "unit_catalog"))


def p4_found(spark: SparkSession, d: str) -> DataFrame:
    return _units(spark, d).where("not is_common").select("table_name", "row_id", "unit_code")


def p4_common(spark: SparkSession, d: str) -> DataFrame:
    return _units(spark, d)


QUERIES = {f.__name__: f for f in (p1_found, p1_metrics, p1_parameters, p1_evidence, p1_points, p1_components, p1_records, p1_links, p3_found, p3_valid, p4_found, p4_common)}


def _decoded(x: str) -> str:
    inner = f"try_cast(({x}->>'$') AS JSON)"
    return f"CASE WHEN json_type({x}) = 'VARCHAR' AND json_type({inner}) IN ('ARRAY', 'OBJECT') THEN {inner} ELSE {x} END"


def _elements(source: str, keys: str, field: str) -> str:
    """Objects of a JSON field in any notation, with their positions."""
    return f"""(SELECT {keys}, cast(i - 1 AS INTEGER) AS ord, {_decoded('l[i]')} AS x FROM (SELECT {keys}, l, unnest(generate_series(1, len(l))) AS i FROM
      (SELECT {keys}, CASE json_type(d) WHEN 'ARRAY' THEN json_extract(d, '$[*]') WHEN 'OBJECT' THEN [d] ELSE [] END AS l FROM (SELECT {keys}, {_decoded('f')} AS d FROM (SELECT {keys}, {field} AS f FROM {source})))) WHERE json_type({_decoded('l[i]')}) = 'OBJECT')"""


_VD = f"(SELECT record_id, {_decoded('v')} AS v FROM (SELECT record_id, cast(record_json AS JSON)->'$.validation_and_diagnostics' AS v FROM matrix_record))"
_METRIC = _elements(_VD, "record_id", "v->'$.validation_metrics'")
_PARAMETER = _elements(_VD, "record_id", "v->'$.tuning_parameters'")
_P1 = " UNION ALL ".join(
    [f"SELECT record_id, '{k}' AS child_kind, cast(-1 AS INTEGER) AS parent_ord, ord AS child_ord FROM {e}" for k, e in (("metric", _METRIC), ("parameter", _PARAMETER), ("section_evidence", _elements(_VD, "record_id", "v->'$.evidence'")))]
    + [
        f"SELECT record_id, '{k}', parent, ord FROM {_elements(f'(SELECT record_id, ord AS parent, x FROM {e})', 'record_id, parent', f)}"
        for k, e, f in (
            ("metric_evidence", _METRIC, "x->'$.evidence'"),
            ("metric_point", _METRIC, "x->'$.quantitative_value.points'"),
            ("metric_uncertainty", _METRIC, "x->'$.quantitative_value.uncertainty_components'"),
            ("parameter_evidence", _PARAMETER, "x->'$.evidence'"),
        )
    ]
)

_CELL = "'(\"(?:[^\"]|\"\")*\"|[^\"' || regexp_escape(d) || '\r\n]*)' || regexp_escape(d)"


def _judged(source: str) -> str:
    """Reasons of records (row_id, t, d, types)."""
    unquoted = "list_transform(cells, lambda c: CASE WHEN starts_with(c, '\"') THEN replace(substr(c, 2, length(c) - 2), '\"\"', '\"') ELSE c END)"
    whole = "CASE types[i] WHEN 'int' THEN regexp_full_match(u[i], '[+-]?[0-9]+') WHEN 'double' THEN regexp_full_match(u[i], '[+-]?([0-9]+\\.?[0-9]*|\\.[0-9]+)([eE][+-]?[0-9]+)?') WHEN 'date' THEN regexp_full_match(u[i], '[0-9]{4}-[0-9]{2}-[0-9]{2}') AND try_cast(u[i] AS DATE) IS NOT NULL ELSE true END"
    return f"""(SELECT row_id, u, types, CASE WHEN t IS NULL THEN 'column_count' WHEN NOT quoted THEN 'broken_quoting' WHEN len(u) <> len(types) THEN 'column_count'
      WHEN len(list_filter(generate_series(1, len(u)), lambda i: u[i] <> '' AND NOT ({whole}))) > 0 THEN 'invalid_value' END AS reason
      FROM (SELECT *, {unquoted} AS u FROM (SELECT row_id, t, d, types, regexp_full_match(t || d, '(?:' || {_CELL} || ')+') AS quoted, regexp_extract_all(t || d, {_CELL}, 1) AS cells FROM {source})))"""


_ROWS = _judged("(SELECT row_id, row_text AS t, coalesce(delimiter, ',') AS d, column_types AS types FROM recovered_row JOIN recovered_table USING (table_id))")
_HEADS = _judged("(SELECT table_id AS row_id, columns_text AS t, coalesce(delimiter, ',') AS d, list_transform(column_types, lambda x: 'text') AS types FROM recovered_table)")
SQL: dict[str, str] = {
    "p1_found": _P1,
    "p3_found": f"""SELECT 'recovered_row' AS table_name, row_id, reason FROM {_ROWS} WHERE reason IS NOT NULL
      UNION ALL SELECT 'recovered_table', row_id, coalesce(reason, 'invalid_value') FROM {_HEADS} WHERE reason IS NOT NULL OR len(list_filter(u, lambda c: trim(c) = '')) > 0 OR len(list_distinct(list_transform(u, lambda c: trim(c)))) < len(u)""",
}
