"""Deterministic checks as relational rules: one frame of issues each, united in order."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerloom.functions.numbers import with_shape
from ledgerloom.functions.text import squeezed
from ledgerloom.operators.ledger import unique_registry
from ledgerloom.session import cut

SEVERITIES = ("error", "warning", "info")
#: Scopes that speak of one target, and words that speak of all.
TARGET_SCOPES = ("crop", "crop_phase", "phase", "phase_year", "class", "region", "study_or_site")
ALL_WORDS = r"\b(all|overall|every|across|pooled)\b"


def issues(df: DataFrame, subject: str, rules: list[tuple[Column, str, str, str]]) -> DataFrame:
    """All issues of a frame in one pass: ``(record, code, severity, field)``.

    A rule is (condition, code, severity, field); a condition that is null didn't fire.
    """
    fired = F.array(*[F.when(F.coalesce(when, F.lit(False)), F.struct(F.lit(code).alias("code"), F.lit(severity).alias("severity"), F.lit(field).alias("field"))) for when, code, severity, field in rules])
    found = df.select(F.col(subject).cast("bigint").alias("record"), F.filter(fired, lambda x: x.isNotNull()).alias("_fired"))
    # an outer inline: a filter on the list would move below and find everything twice
    return found.select("record", F.inline_outer("_fired")).where("code is not null")


def quantity_rules(ledger: DataFrame) -> tuple[DataFrame, list[tuple]]:
    """Conflicts between what a metric reports and its summary: the rows to ask, the rules."""
    rows = with_shape(with_shape(ledger, "as_reported", "_r"), "value_or_summary", "_s")
    # a range in descending order is text; other shapes compare by number and bounds
    text = lambda p: F.col(f"{p}code").isin("text", "descending")
    key = lambda p: F.concat_ws("|", *[F.coalesce(F.col(p + k).cast("string"), F.lit("")) for k in ("value", "low", "high")])
    unlike = squeezed(F.col("as_reported")) != squeezed(F.col("value_or_summary"))
    return rows, [
        (F.col("as_reported").rlike("[0-9]") & text("_r"), "QUANTITATIVE_VALUE_NOT_STRUCTURED", "warning", "as_reported"),
        (unlike, "QUANTITATIVE_AS_REPORTED_MISMATCH", "error", "value_or_summary"),
        (~text("_r") & ~text("_s") & (key("_r") != key("_s")), "QUANTITATIVE_VALUE_DISPLAY_CONFLICT", "error", "value_or_summary"),
    ]


def scope_rules() -> list[tuple]:
    """Contradictions between a metric's scope and the label of its target."""
    label, scope = F.trim("scope_label"), F.col("scope")
    blank = label.isNull() | (label == "")
    target = scope.isin(*TARGET_SCOPES)
    year = label.rlike(r"\b(19|20)[0-9]{2}\b")
    return [
        (~blank & label.rlike("[;|]"), "METRIC_SCOPE_LABEL_MULTIPLE_TARGETS", "error", "scope_label"),
        (~blank & target & F.lower(label).rlike(ALL_WORDS), "METRIC_SCOPE_LABEL_CONTRADICTS_SCOPE", "error", "scope_label"),
        (blank & target, "METRIC_SCOPE_LABEL_MISSING", "warning", "scope_label"),
        ((scope == "phase_year") & ~F.coalesce(year, F.lit(False)), "PHASE_YEAR_SCOPE_WITHOUT_YEAR", "warning", "scope_label"),
        ((F.col("evaluation_support") == "unknown") & F.lower("name").rlike(r"\b(interval|picp|piw|coverage)\b"), "INTERVAL_METRIC_EVALUATION_SUPPORT_UNKNOWN", "warning", "evaluation_support"),
    ]


def locator_rules(evidence: DataFrame, registry: DataFrame) -> tuple[DataFrame, list[tuple]]:
    """Evidence whose locators contradict its authored item, or whose item is unknown; a
    bundle without any registry is not judged for unknown items."""
    fields = ("item_type", "source_page", "source_location", "section_hint")
    items = unique_registry(registry).select("bundle_id", "source_item_id", *[F.col(c).alias(f"_{c}") for c in fields])
    some = registry.select("bundle_id").distinct().withColumn("_some", F.lit(True))
    rows = evidence.join(items, ["bundle_id", "source_item_id"], "left").join(some, "bundle_id", "left")
    known = F.col("_item_type").isNotNull()
    about = F.col("source_modality").isin("author_table", "author_figure", "author_formula")
    return rows, [
        (F.col("source_item_id").isNotNull() & F.col("_some") & ~known, "SOURCE_ITEM_ID_UNKNOWN", "error", "source_item_id"),
        (about & (F.col("source_modality") != F.concat(F.lit("author_"), F.col("_item_type"))), "SOURCE_ITEM_MODALITY_MISMATCH", "error", "source_modality"),
        (F.col("source_page") != F.col("_source_page"), "SOURCE_ITEM_PAGE_MISMATCH", "error", "source_page"),
        (F.col("source_location") != F.col("_source_location"), "SOURCE_ITEM_LOCATION_MISMATCH", "error", "source_location"),
        (F.col("source_section") != F.col("_section_hint"), "SOURCE_ITEM_SECTION_MISMATCH", "error", "source_section"),
        ((F.col("evidence_type") == "explicit") & F.coalesce(F.col("source_page").cast("string"), "source_item_id", "source_section").isNull(), "EXPLICIT_EVIDENCE_WEAK_LOCATOR", "warning", "source_page"),
    ]


def all_issues(ledger: DataFrame, evidence: DataFrame, registry: DataFrame) -> DataFrame:
    """Every rule in one pass over each relation, or one info row if none fired."""
    rows, quantity = quantity_rules(ledger)
    placed, locators = locator_rules(evidence, registry)
    # what was found is kept, so that asking whether anything was doesn't find it again
    found = cut(issues(rows, "metric_id", quantity + scope_rules()).unionByName(issues(placed, "evidence_id", locators)))
    none = found.agg(F.count(F.lit(1)).alias("n")).where("n = 0")
    clean = none.select(F.lit(None).cast("bigint").alias("record"), F.lit("NO_DETERMINISTIC_ISSUES").alias("code"), F.lit("info").alias("severity"), F.lit(None).cast("string").alias("field"))
    return found.unionByName(clean)
