"""Deeply nested records as related flat tables: shared inlining.

1. *Schema graph.*  Every record is walked once; each partition gives its distinct edges
   (element, field, element below, shape) and the edges are merged.  The graph has the
   size of the schema, not of the data, and is refused beyond a stated number of edges.
2. *Plan.*  An element becomes a table if it is the root, is repeated somewhere, is shared
   by several parents or is recursive; every other descendant is inlined as columns of the
   table above it.
3. *Shredding.*  A second walk writes one row for each object of a table element with its
   own key, its parent's table, key and position, and its own position; the flat tables
   are selections from that one pass.  A row names the objects inlined into it.

Notation: a list counts the same whether it is delivered as a list, as one object standing
alone (element 0) or as a string holding either.  Null elements keep their position and
give no row.  Scalars in a list that also holds objects stay as a list of their own, in
which the objects' places are null.  A record that is null or no JSON object gives no
rows; of repeated keys within an object the last one counts; unknown fields become columns
or tables like others.  A plan that would inline several objects into one row is refused,
as their columns would overwrite one another.
"""

from __future__ import annotations

import json
from collections.abc import Iterator
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerloom.session import cut

_EDGES = "parent string, name string, many boolean, object boolean, scalar boolean"
_ROWS = "element string, record_id bigint, row_key string, parent_element string, parent_key string, parent_field string, parent_ord int, child_ord int, path string, inlined array<string>, body map<string,string>"


def decode(value):
    """A string that holds a JSON list or object, as that list or object."""
    if isinstance(value, str) and value.lstrip()[:1] in ("[", "{"):
        try:
            inner = json.loads(value)
        except ValueError:
            return value
        return inner if isinstance(inner, (list, dict)) else value
    return value


def places(value) -> list[tuple[int, dict]]:
    """Positions and objects of a list in any notation; empty places are left out."""
    value = decode(value)
    if isinstance(value, dict):
        return [(0, value)]
    if not isinstance(value, list):
        return []
    return [(k, x) for k, x in enumerate(map(decode, value)) if isinstance(x, dict)]


def is_list(value) -> bool:
    return isinstance(decode(value), list)


def read_record(text: str | None) -> dict | None:
    try:
        record = json.loads(text) if text else None
    except ValueError:
        return None
    return record if isinstance(record, dict) else None


def edges_of(record: dict, root: str) -> set[tuple[str, str, bool, bool, bool]]:
    """Edges (element, field, is a list, holds objects, holds scalars) of one record."""
    found, todo = set(), [(root, record)]
    while todo:
        element, obj = todo.pop()
        for name, value in obj.items():
            below = places(value)
            plain = not below and decode(value) not in (None, [], {})
            found.add((element, name, is_list(value), bool(below), plain))
            todo += [(name, x) for _, x in below]
    return found


@dataclass
class Plan:
    """Which elements are tables, and which fields of each are inlined below it."""

    root: str
    tables: set[str] = field(default_factory=set)
    children: dict[str, set[str]] = field(default_factory=dict)

    def is_table(self, element: str) -> bool:
        return element in self.tables


def plan_of(edges: list[tuple[str, str, bool, bool, bool]], root: str) -> Plan:
    """Shared inlining over a schema graph: repeated, shared and recursive elements and the
    root become tables, the rest is inlined."""
    parents: dict[str, set[str]] = {}
    children: dict[str, set[str]] = {}
    many: set[str] = set()
    for element, name, repeated, holds, _ in edges:
        if holds:
            parents.setdefault(name, set()).add(element)
            children.setdefault(element, set()).add(name)
            if repeated:
                many.add(name)

    def reaches(start: str) -> set[str]:
        seen, todo = set(), list(children.get(start, ()))
        while todo:
            x = todo.pop()
            if x not in seen:
                seen.add(x)
                todo += children.get(x, ())
        return seen

    tables = {root} | many | {x for x, p in parents.items() if len(p) > 1} | {x for x in children if x in reaches(x)}
    return Plan(root, tables, children)


def scalars_of(value) -> str | None:
    """What a field holds besides objects, as text: a scalar, or a list with the objects'
    places null; None if there is nothing."""
    plain = decode(value)
    if plain is None or isinstance(plain, dict) or plain == []:
        return None
    if isinstance(plain, list):
        kept = [None if isinstance(decode(x), dict) else x for x in plain]
        if all(x is None for x in kept):
            return None
        return value if kept == plain and isinstance(value, str) else json.dumps(kept, ensure_ascii=False)
    return value if isinstance(value, str) else json.dumps(value, ensure_ascii=False)


def shred_record(record_id: int, record: dict, plan: Plan) -> Iterator[tuple]:
    """Rows of one record, parents before children."""
    todo = [(plan.root, record, None, None, None, None, -1, "$")]
    serial = 0
    while todo:
        element, obj, up, up_key, up_field, up_ord, ord_, path = todo.pop()
        key = f"{record_id}/{serial}"
        serial += 1
        body: dict[str, str] = {}
        below: list[tuple] = []
        inlined: list[str] = []
        inline = [("", obj, path)]
        while inline:
            prefix, part, at = inline.pop()
            for name, value in part.items():
                held = places(value)
                if held and plan.is_table(name):
                    below += [(name, x, element, key, prefix + name, ord_, k, f"{at}.{name}[{k}]") for k, x in held]
                elif held:
                    if len(held) > 1:
                        raise ValueError(f"the plan inlines {name!r}, but record {record_id} holds {len(held)} of it in one place")
                    (k, x), = held
                    inline.append((f"{prefix}{name}.", x, f"{at}.{name}[{k}]"))
                    inlined.append(f"{at}.{name}[{k}]")
                if (text := scalars_of(value)) is not None:
                    body[prefix + name] = text
        yield element, record_id, key, up, up_key, up_field, up_ord, ord_, path, inlined, list(body.items())
        todo += reversed(below)


def schema_graph(df: DataFrame, json_col: str, root: str = "record", most: int = 5000) -> list[tuple]:
    """Edges of the schema graph of a column of JSON records.

    Refused beyond ``most`` edges: then some object is a map keyed by data, not a record.
    """

    def walk(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: dict[tuple[str, str], tuple[bool, bool, bool]] = {}
        for batch in batches:
            for text in batch.column(0).to_pylist():
                if (record := read_record(text)) is not None:
                    for parent, name, *shape in edges_of(record, root):
                        before = seen.get((parent, name), (False, False, False))
                        seen[parent, name] = tuple(x or y for x, y in zip(before, shape))
            if len(seen) > most:  # as many merged edges: refused below
                break
        names = ["parent", "name", "many", "object", "scalar"]
        edges = [(*edge, *shape) for edge, shape in seen.items()]
        yield pa.RecordBatch.from_pydict({n: pa.array([e[k] for e in edges], pa.string() if k < 2 else pa.bool_()) for k, n in enumerate(names)})

    parts = df.select(F.col(json_col)).mapInArrow(walk, _EDGES)
    merged = parts.groupBy("parent", "name").agg(F.max("many").alias("many"), F.max("object").alias("object"), F.max("scalar").alias("scalar"))
    rows = merged.limit(most + 1).collect()
    if len(rows) > most:
        raise ValueError(f"the schema graph has more than {most} edges: some object is keyed by data")
    return [tuple(r) for r in rows]


def shred(df: DataFrame, id_col: str, json_col: str, plan: Plan) -> DataFrame:
    """All rows of all tables of a plan in one pass, without a shuffle.

    Columns: ``element`` (the table), ``record_id``, ``row_key``, ``parent_element``,
    ``parent_key``, ``parent_field`` (with the path inlined above it), ``parent_ord``,
    ``child_ord``, ``path``, ``inlined`` (paths of the objects inlined into the row) and
    ``body`` (scalar fields by their path below the row).
    """

    def walk(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["element", "record_id", "row_key", "parent_element", "parent_key", "parent_field", "parent_ord", "child_ord", "path", "inlined", "body"]
        text, short = pa.string(), pa.int32()
        kinds = [text, pa.int64(), text, text, text, text, short, short, text, pa.list_(text), pa.map_(text, text)]
        for batch in batches:
            rows: list[tuple] = []
            for record_id, body in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                if (record := read_record(body)) is not None:
                    rows += shred_record(record_id, record, plan)
                if len(rows) >= 20_000:
                    yield pa.RecordBatch.from_arrays([pa.array([r[k] for r in rows], t) for k, t in enumerate(kinds)], names=names)
                    rows = []
            yield pa.RecordBatch.from_arrays([pa.array([r[k] for r in rows], t) for k, t in enumerate(kinds)], names=names)

    return df.select(F.col(id_col).cast("bigint"), F.col(json_col)).mapInArrow(walk, _ROWS)


KEYS = ("record_id", "row_key", "parent_element", "parent_key", "parent_field", "parent_ord", "child_ord", "path")


def flat_table(rows: DataFrame, element: str, columns: list[str]) -> DataFrame:
    """One flat table of a shredded collection: keys, positions and the named fields."""
    return rows.where(F.col("element") == element).select(*KEYS, *[F.col("body")[c].alias(c.replace(".", "_")) for c in columns])


def shredded(df: DataFrame, id_col: str = "record_id", json_col: str = "record_json", root: str = "record") -> tuple[DataFrame, Plan]:
    """All rows of a column of records under the plan of its own schema graph."""
    plan = plan_of(schema_graph(df, json_col, root), root)
    return shred(df, id_col, json_col, plan), plan


def links(rows: DataFrame) -> DataFrame:
    """Foreign keys checked: ``(element, parent_element, rows, lost, misplaced)``.

    ``lost`` rows name a parent that is no row of the parent's table, ``misplaced`` ones
    another position of it than it has; both are 0 in a right shredding.
    """
    rows = cut(rows.select("element", "record_id", "row_key", "parent_element", "parent_key", "parent_ord", "child_ord"))  # shredded once for both sides
    above = rows.select(F.col("element").alias("_e"), F.col("record_id").alias("_r"), F.col("row_key").alias("_k"), F.col("child_ord").alias("_o"))
    here = (F.col("parent_element") == F.col("_e")) & (F.col("record_id") == F.col("_r")) & (F.col("parent_key") == F.col("_k"))
    joined = rows.where("parent_key is not null").join(above, here, "left")
    return joined.groupBy("element", "parent_element").agg(
        F.count(F.lit(1)).alias("rows"), F.count_if(F.col("_k").isNull()).alias("lost"), F.count_if(F.col("parent_ord") != F.col("_o")).alias("misplaced")
    )


#: Kinds of the objects below the section, by their path without positions.
SECTION = "validation_and_diagnostics"
KINDS = {
    "validation_metrics": "metric",
    "tuning_parameters": "parameter",
    "evidence": "section_evidence",
    "validation_metrics.evidence": "metric_evidence",
    "validation_metrics.quantitative_value.points": "metric_point",
    "validation_metrics.quantitative_value.uncertainty_components": "metric_uncertainty",
    "tuning_parameters.evidence": "parameter_evidence",
}


def section_children(df: DataFrame, id_col: str = "record_id", json_col: str = "record_json") -> DataFrame:
    """One row for each object in a list under the validation section.

    ``(record_id, child_kind, parent_ord, child_ord, row_key, parent_key, body)``.  Which
    objects are rows of a table and which are inlined is the schema graph's doing; an
    object inlined into a row is a child too, with that row's key and body.  Positions are
    those of the path, so a record's result is the same under every plan.
    """
    rows, _ = shredded(df, id_col, json_col)
    objects = rows.select("record_id", "row_key", "parent_key", "body", F.explode(F.concat(F.array("path"), "inlined")).alias("at"))
    below = F.regexp_extract("at", r"^\$\." + SECTION + r"\[0\]\.(.+)$", 1)
    kind = F.create_map(*[F.lit(x) for pair in KINDS.items() for x in pair])[F.regexp_replace(below, r"\[\d+\]", "")]
    first, last = (F.regexp_extract(below, p, 1).try_cast("int") for p in (r"^\w+\[(\d+)\]", r"\[(\d+)\]$"))
    top = F.col("child_kind").isin("metric", "parameter", "section_evidence")
    return (
        objects.withColumn("child_kind", kind)
        .where("child_kind is not null")
        .select("record_id", "child_kind", F.when(top, F.lit(-1)).otherwise(first).alias("parent_ord"), last.alias("child_ord"), "row_key", "parent_key", "body")
    )
