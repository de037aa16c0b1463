"""Named queries of the llm operators, each over its whole tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerloom.llm import canonical_names, confusables, containment, format_dups, mixing, scan_repair, subjects
from ledgerloom.session import table

HINT_BESIDE = ["bundle_id", "source_item_id", "column_label", "value", "excerpt"]
CLAIM_BESIDE = ["bundle_id", "source_item_id"]


def _labelled(df: DataFrame, name: str) -> DataFrame:
    return df.select(F.lit(name).alias("table_name"), *df.columns)


def p2_found(spark: SparkSession, d: str) -> DataFrame:
    names = confusables.changed(table(spark, d, "metric_hint"), "hint_id", "metric_name")
    texts = confusables.changed(table(spark, d, "evidence"), "evidence_id", "source_text")
    return _labelled(names.select("row_id"), "metric_hint").unionByName(_labelled(texts.select("row_id"), "evidence"))


def p2_canonical(spark: SparkSession, d: str) -> DataFrame:
    names = confusables.canonicalise(table(spark, d, "metric_hint").select(F.col("hint_id").alias("row_id"), "metric_name"), "metric_name", "canonical")
    texts = confusables.canonicalise(table(spark, d, "evidence").select(F.col("evidence_id").alias("row_id"), "source_text"), "source_text", "canonical")
    return _labelled(names.select("row_id", "canonical"), "metric_hint").unionByName(_labelled(texts.select("row_id", "canonical"), "evidence"))


def p2_groups(spark: SparkSession, d: str) -> DataFrame:
    names = table(spark, d, "metric_hint").select(F.lit("metric_hint").alias("table_name"), F.col("metric_name").alias("text"))
    texts = table(spark, d, "evidence").select(F.lit("evidence").alias("table_name"), F.col("source_text").alias("text"))
    return confusables.skeleton_groups(names.unionByName(texts))


def _named(spark: SparkSession, d: str) -> tuple[DataFrame, DataFrame]:
    tables = [("metric_hint", table(spark, d, "metric_hint"), "hint_id", "metric_name"), ("ledger_metric", table(spark, d, "ledger_metric"), "metric_id", "name")]
    reference = table(spark, d, "canonical_metric")
    return canonical_names.mapped_rows(tables, reference), reference


def p5_found(spark: SparkSession, d: str) -> DataFrame:
    rows, reference = _named(spark, d)
    return canonical_names.not_verbatim(rows, reference).select("table_name", "row_id", "metric_key")


def p5_report(spark: SparkSession, d: str) -> DataFrame:
    rows, _ = _named(spark, d)
    return rows.groupBy("metric_key").agg(F.count(F.lit(1)).alias("rows"), F.countDistinct("written").alias("spellings"))


def _scanned(spark: SparkSession, d: str) -> DataFrame:
    evidence = table(spark, d, "evidence").select(F.lit("evidence").alias("table_name"), F.col("evidence_id").alias("row_id"), F.col("source_text").alias("text"))
    bundles = table(spark, d, "source_bundle").select(F.lit("source_bundle").alias("table_name"), F.col("bundle_id").alias("row_id"), F.col("text_for_llm").alias("text"))
    return evidence.unionByName(bundles)


def p6_found(spark: SparkSession, d: str) -> DataFrame:
    return scan_repair.repair(_scanned(spark, d)).select("table_name", "row_id", F.explode("defects").alias("defect"))


def p6_repaired(spark: SparkSession, d: str) -> DataFrame:
    return scan_repair.repair(_scanned(spark, d)).select("table_name", "row_id", "repaired")


def p7_found(spark: SparkSession, d: str) -> DataFrame:
    hints = format_dups.group_copies(table(spark, d, "metric_hint"), "hint_id", "target", HINT_BESIDE, named=False)
    claims = format_dups.group_copies(table(spark, d, "evidence"), "evidence_id", "claim", CLAIM_BESIDE)
    both = _labelled(hints, "metric_hint").unionByName(_labelled(claims, "evidence"))
    return both.where("row_id <> keep_id").select("table_name", "keep_id", F.col("row_id").alias("copy_id"))


def p7_claims(spark: SparkSession, d: str) -> DataFrame:
    evidence = table(spark, d, "evidence").select("evidence_id", "claim", *CLAIM_BESIDE)
    return format_dups.collapse(evidence, "evidence_id", "claim", CLAIM_BESIDE).select("evidence_id", "copies")


def p7_targets(spark: SparkSession, d: str) -> DataFrame:
    hints = table(spark, d, "metric_hint").select("hint_id", "target", *HINT_BESIDE)
    return format_dups.collapse(hints, "hint_id", "target", HINT_BESIDE, named=False).select("hint_id", "copies")


def p8_found(spark: SparkSession, d: str) -> DataFrame:
    return containment.leaked(table(spark, d, "documents"), table(spark, d, "eval_item")).select("doc_id", "item_id")


def p8_items(spark: SparkSession, d: str) -> DataFrame:
    found = containment.leaked(table(spark, d, "documents"), table(spark, d, "eval_item"))
    return found.groupBy("item_id").agg(F.count(F.lit(1)).alias("documents"), F.max("share").alias("most_share"))


def p9_mix(spark: SparkSession, d: str) -> DataFrame:
    return mixing.mixture_report(table(spark, d, "documents"), table(spark, d, "mix_target"))


def p9_copies(spark: SparkSession, d: str) -> DataFrame:
    return mixing.draw_copies(table(spark, d, "documents"), table(spark, d, "mix_target"))[0]


def p10_found(spark: SparkSession, d: str) -> DataFrame:
    return subjects.subjects_of(table(spark, d, "documents"), table(spark, d, "subject_label"), table(spark, d, "subject_area")).select("doc_id", "subject")


def p10_composition(spark: SparkSession, d: str) -> DataFrame:
    return subjects.composition(table(spark, d, "documents"), table(spark, d, "subject_label"), table(spark, d, "subject_area"))


QUERIES = {f.__name__: f for f in (p2_found, p2_canonical, p2_groups, p5_found, p5_report, p6_found, p6_repaired, p7_found, p7_claims, p7_targets, p8_found, p8_items, p9_mix, p9_copies, p10_found, p10_composition)}
