"""Candidates from prose and tables, backfill of a ledger, merging of evidence."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerloom.functions.metrics import Names
from ledgerloom.functions.text import squeezed, stems
from ledgerloom.operators.nested import read_record

#: A name, a relation and what it relates to; the name is what stands before the relation.
PAIR = r"^(?:We obtain )?(.+?) (=|of|reached) ((?:median )?[-+]?[0-9].*?)(?: was found)?(?: for ([a-z ]+)| \(([a-z ]+)\))?\.?$"
SUMMARY = r"\b(median|mean|average|overall|respectively)\b|±"
FRAGMENT = r"\b(et al|figure|table|section|appendix|method|methods)\b"


def prose_pairs(df: DataFrame, text: str) -> DataFrame:
    """Add the metric, relation, value and target a sentence states.

    All are null where the sentence states none; ``summary`` says whether it sums up.
    """
    part = lambda k: F.nullif(F.trim(F.regexp_extract(F.col(text), PAIR, k)), F.lit(""))
    target = F.coalesce(part(4), part(5))
    return df.withColumns({"pair_name": part(1), "relation": part(2), "pair_value": part(3), "pair_target": F.when(valid_target(target), target), "summary": F.lower(text).rlike(SUMMARY)})


def valid_target(text: Column) -> Column:
    """Whether a phrase may name a target (F8): at most twelve words, no citation."""
    return text.isNotNull() & (F.size(F.split(F.trim(text), r"\s+")) <= 12) & ~F.lower(text).rlike(FRAGMENT)


def numeric_looking(cell: Column) -> Column:
    """Whether a cell has a digit (F7); null has none."""
    return F.coalesce(cell.rlike("[0-9]"), F.lit(False))


def table_cell_hints(typed: DataFrame) -> DataFrame:
    """Numeric cells of recovered tables as hints (C2, C3): the row's first text cell is its
    target, null if there is none."""
    first = F.get(F.filter("cells", lambda c: (c["type"] == "text") & c["text"].isNotNull()), F.lit(0))["text"]
    cells = typed.select("row_id", "table_id", first.alias("target"), F.posexplode("cells").alias("cell_ord", "cell"))
    numeric = cells.where(F.col("cell.type").isin("int", "double") & numeric_looking(F.col("cell.text")))
    return numeric.select("row_id", "cell_ord", "target", F.col("cell.name").alias("column_label"), F.col("cell.text").alias("value"))


def backfill(hints: DataFrame, ledger: DataFrame, names: Names) -> DataFrame:
    """Hints whose metric and value a bundle's ledger lacks, with the context and scope of a
    prototype (J19): the bundle's first row of the same metric, else of the same family.

    Hints without a name, target or value are skipped; repeats give one row.
    """
    asked = hints.where("metric_name is not null and target is not null and value is not null")
    keyed = asked.select("bundle_id", names.identity(F.col("metric_name")).alias("identity"), names.family(F.col("metric_name")).alias("family"), squeezed(F.col("value")).alias("shown"), "hint_id")
    once = keyed.groupBy("bundle_id", "identity", "family", "shown").agg(F.min("hint_id").alias("hint_id"))
    rows = ledger.where("name is not null").select("bundle_id", "metric_id", names.identity(F.col("name")).alias("identity"), names.family(F.col("name")).alias("family"), squeezed(F.col("as_reported")).alias("shown"), "context", "scope")
    missing = once.join(rows.select("bundle_id", "identity", "shown").distinct(), ["bundle_id", "identity", "shown"], "left_anti")
    first = lambda keys, p: rows.where(F.col(keys[-1]).isNotNull()).groupBy(*keys).agg(F.min(F.struct("metric_id", "context", "scope")).alias(p))
    same = missing.join(first(["bundle_id", "identity"], "by_metric"), ["bundle_id", "identity"], "left").join(first(["bundle_id", "family"], "by_family"), ["bundle_id", "family"], "left")
    proto = F.coalesce("by_metric", "by_family")
    how = F.when(F.col("by_metric").isNotNull(), "metric").when(F.col("by_family").isNotNull(), "family")
    return same.where(proto.isNotNull()).select("hint_id", "bundle_id", "identity", how.alias("prototype"), proto["context"].alias("context"), proto["scope"].alias("scope"))


def richness(df_cols: dict[str, int]) -> Column:
    """Points of the fields that are filled."""
    return sum((F.when(F.col(c).isNotNull(), p).otherwise(0) for c, p in df_cols.items()), F.lit(0))


#: What a filled field of evidence is worth when the richest sighting is kept.
EVIDENCE_POINTS = {"source_text": 25, "source_item_id": 8, "source_page": 5, "source_location": 4, "source_section": 4, "source_modality": 3, "representation_method": 3, "source_asset_sha256": 2, "representation_confidence": 1, "confidence_note": 1}
REVIEW_RANK = {"human_verified": 10, "human_corrected": 20}


def merge_evidence(evidence: DataFrame) -> DataFrame:
    """One row for each anchor and text (D2): the richest sighting, the first of equals,
    with the gaps of page and section filled from the group and its highest review rank."""
    key = F.coalesce(squeezed(F.col("source_text")), F.concat(F.lit("claim:"), squeezed(F.col("claim"))))
    rank = F.coalesce(*[F.when(F.col("review_status") == s, r) for s, r in REVIEW_RANK.items()], F.lit(0))
    rows = evidence.select("evidence_id", "bundle_id", "source_item_id", key.alias("key"), "source_page", "source_section", rank.alias("rank"), (richness(EVIDENCE_POINTS) + rank).alias("points"))
    best = F.max(F.struct("points", (-F.col("evidence_id")).alias("first"), "source_page", "source_section"))
    merged = rows.groupBy("bundle_id", "source_item_id", "key").agg(best.alias("b"), F.max("source_page").alias("p"), F.max("source_section").alias("s"), F.max("rank").alias("review_rank"), F.count(F.lit(1)).alias("merged"))
    return merged.select((-F.col("b.first")).alias("evidence_id"), "bundle_id", F.coalesce("b.source_page", "p").alias("source_page"), F.coalesce("b.source_section", "s").alias("source_section"), "review_rank", "merged")


def json_leaves(df: DataFrame, id_col: str, json_col: str) -> DataFrame:
    """``(id, path, value)`` for every scalar of JSON records (H6); nulls have no leaf."""

    def leaves(node, path: str) -> Iterator[tuple[str, str]]:
        todo = [(path, node)]
        while todo:
            at, x = todo.pop()
            if isinstance(x, dict):
                todo += [(f"{at}.{k}", v) for k, v in x.items()]
            elif isinstance(x, list):
                todo += [(f"{at}[{k}]", v) for k, v in enumerate(x)]
            elif x is not None:
                yield at, ("true" if x else "false") if isinstance(x, bool) else str(x)

    def walk(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for i, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                record = read_record(text)
                if record is not None:
                    out += [(i, p, v) for p, v in leaves(record, "$")]
            yield pa.RecordBatch.from_arrays([pa.array([o[k] for o in out], pa.int64() if k == 0 else pa.string()) for k in range(3)], names=["id", "path", "value"])

    return df.select(F.col(id_col).cast("bigint"), json_col).mapInArrow(walk, "id bigint, path string, value string")


def provenance_rules(records: DataFrame, bundles: DataFrame) -> DataFrame:
    """Records whose provenance or source hash is missing or differs from their bundle's.

    A missing provenance hides the hash rules; a bundle without a 64-digit hash is not
    asked.  ``(record, code)``.
    """
    has = F.get_json_object("record_json", "$.extraction_provenance")
    mine = F.get_json_object("record_json", "$.extraction_provenance.canonical_source_sha256")
    expected = F.when(F.col("source_sha256").rlike("^[0-9a-f]{64}$"), F.col("source_sha256"))
    rows = records.select("record_id", "bundle_id", has.isNotNull().alias("has"), mine.alias("mine")).join(bundles.select("bundle_id", expected.alias("expected")), "bundle_id", "left")
    code = F.when(~F.col("has"), "EXTRACTION_PROVENANCE_MISSING").when(F.col("expected").isNotNull() & F.col("mine").isNull(), "CANONICAL_SOURCE_HASH_MISSING").when(F.col("expected") != F.col("mine"), "CANONICAL_SOURCE_HASH_MISMATCH")
    return rows.select(F.col("record_id").alias("record"), code.alias("code")).where("code is not null")


def with_cached(items: DataFrame, cache: DataFrame, keys: list[str]) -> tuple[DataFrame, DataFrame]:
    """Items already answered, with their answer, and those still to send (an adapter's
    cache): keys decide, null keys are never cached."""
    return items.join(cache, keys), items.join(cache.select(*keys).distinct(), keys, "left_anti")


def guardrail_coverage(items: DataFrame, texts: DataFrame, keys: list[str]) -> DataFrame:
    """Whether statements are taken up by the text of their key.

    ``items`` has the keys, ``item_id`` and ``text``; ``texts`` the keys and ``text``.  Of
    an item's stems those count that no other item of the key has, if there are two or
    more, else all; covered are items of which two counting stems occur in the text.
    """
    mine = items.select(*keys, "item_id", F.explode(stems(F.col("text"))).alias("stem"))
    df = mine.groupBy(*keys, "stem").agg(F.count(F.lit(1)).alias("df"))
    theirs = texts.select(*keys, F.explode(stems(F.col("text"))).alias("stem")).distinct().withColumn("there", F.lit(1))
    joined = mine.join(df, [*keys, "stem"]).join(theirs, [*keys, "stem"], "left")
    hit, rare = F.col("there").isNotNull(), F.col("df") == 1
    counted = joined.groupBy(*keys, "item_id").agg(F.count_if(rare).alias("rare"), F.count_if(rare & hit).alias("rare_hits"), F.count_if(hit).alias("hits"))
    return counted.select(*keys, "item_id", (F.when(F.col("rare") >= 2, F.col("rare_hits")).otherwise(F.col("hits")) >= 2).alias("covered"))
