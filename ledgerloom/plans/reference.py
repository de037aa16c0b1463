"""Named queries of the evidence-ledger operators, each over its whole tables.

The SQL counterparts are in ``reference_sql``; both give the same columns and values.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerloom.functions import ids, metrics, numbers, text
from ledgerloom.operators import audit, candidates, consolidation, discovery, ledger, rejects, rules
from ledgerloom.session import table
from ledgerloom.sources import sinks
from ledgerloom.streaming import events as streams


def _names(spark: SparkSession, d: str) -> metrics.Names:
    """The reference list of metric names of a data folder, read once an application."""
    key = (spark.sparkContext.applicationId, d)
    if key not in _lists:
        _lists[key] = metrics.Names.of(table(spark, d, "canonical_metric"))
    return _lists[key]


_lists: dict[tuple[str, str], metrics.Names] = {}


def parse_quantity(spark: SparkSession, d: str) -> DataFrame:
    rows = numbers.with_quantity(table(spark, d, "ledger_metric").select("metric_id", "as_reported", "name", "unit"), "as_reported", "q", "name", "unit")
    return rows.select("metric_id", "q.*")


def quantity_conflict_issues(spark: SparkSession, d: str) -> DataFrame:
    rows, checks = rules.quantity_rules(table(spark, d, "ledger_metric"))
    return rules.issues(rows, "metric_id", checks).groupBy("code", "severity").agg(F.count(F.lit(1)).alias("issues"))


def number_identity(spark: SparkSession, d: str) -> DataFrame:
    rows = table(spark, d, "lineitem").select(numbers.number_key(F.col("l_discount")).alias("key"), "l_quantity")
    return rows.groupBy("key").agg(F.count(F.lit(1)).alias("n"), F.round(F.sum("l_quantity"), 2).alias("quantity"))


def metric_families(spark: SparkSession, d: str) -> DataFrame:
    rows = table(spark, d, "ledger_metric")
    return rows.select("metric_id", F.array_join(_names(spark, d).families(F.col("name")), ",").alias("families"), _names(spark, d).identity(F.col("name")).alias("identity"))


def target_token_key(spark: SparkSession, d: str) -> DataFrame:
    rows = table(spark, d, "metric_hint").where("target is not null")
    return rows.select(text.token_key(F.col("target")).alias("target_key")).groupBy("target_key").agg(F.count(F.lit(1)).alias("n"))


def content_tokens(spark: SparkSession, d: str) -> DataFrame:
    rows = table(spark, d, "registry_item").where("caption is not null").select(F.explode(text.content_tokens(F.col("caption"))).alias("token"))
    return rows.groupBy("token").agg(F.count(F.lit(1)).alias("n"))


def registry_locator_join(spark: SparkSession, d: str) -> DataFrame:
    rows = ledger.with_locators(table(spark, d, "evidence"), table(spark, d, "registry_item"))
    return rows.select("evidence_id", "source_page", "source_location", "source_section", "known_item")


def registry_unknown_item(spark: SparkSession, d: str) -> DataFrame:
    return ledger.unknown_items(table(spark, d, "evidence"), table(spark, d, "registry_item")).select("evidence_id", "bundle_id", "source_item_id")


def issue_catalogue(spark: SparkSession, d: str) -> DataFrame:
    found = rules.all_issues(table(spark, d, "ledger_metric"), table(spark, d, "evidence"), table(spark, d, "registry_item"))
    return found.groupBy("code", "severity").agg(F.count(F.lit(1)).alias("issues"))


def scope_issues(spark: SparkSession, d: str) -> DataFrame:
    return rules.issues(table(spark, d, "ledger_metric"), "metric_id", rules.scope_rules()).select("record", "code")


def table_unpivot(spark: SparkSession, d: str) -> DataFrame:
    cells = candidates.unpivot(table(spark, d, "lineitem"), ["l_returnflag", "l_linestatus"], ["l_quantity", "l_extendedprice", "l_discount", "l_tax"])
    return cells.groupBy("l_returnflag", "l_linestatus", "column_label").agg(F.count(F.lit(1)).alias("n"), F.round(F.sum("value"), 1).alias("total"))


def sibling_gaps(spark: SparkSession, d: str) -> DataFrame:
    """Families that a bundle's hints show and its ledger lacks."""
    hint = table(spark, d, "metric_hint").select("bundle_id", _names(spark, d).family(F.col("metric_name")).alias("family")).where("family is not null").distinct()
    have = table(spark, d, "ledger_metric").select("bundle_id", _names(spark, d).family(F.col("name")).alias("family")).where("family is not null").distinct()
    return hint.join(have.select("bundle_id").distinct(), "bundle_id", "left_semi").join(have, ["bundle_id", "family"], "left_anti")


def table_target_rows(spark: SparkSession, d: str) -> DataFrame:
    """Tables with several targets and families, with the counts of both."""
    rows = table(spark, d, "metric_hint").where("source_item_id is not null and target is not null")
    keyed = rows.select("bundle_id", "source_item_id", text.token_key(F.col("target")).alias("t"), _names(spark, d).family(F.col("metric_name")).alias("f"))
    counted = keyed.groupBy("bundle_id", "source_item_id").agg(F.countDistinct("t").alias("targets"), F.countDistinct("f").alias("families"))
    return counted.where("targets >= 2 and families >= 2")


def context_consensus(spark: SparkSession, d: str) -> DataFrame:
    return ledger.consensus(table(spark, d, "ledger_metric"), ["bundle_id", "scope"], "evaluation_support", "metric_id")


def scope_mode(spark: SparkSession, d: str) -> DataFrame:
    return ledger.mode_per_key(table(spark, d, "ledger_metric"), ["bundle_id"], "scope")


def fitness_views(spark: SparkSession, d: str) -> DataFrame:
    return ledger.fitness_views(table(spark, d, "ledger_metric")).select("metric_id", "view", "context")


def ledger_outer_merge(spark: SparkSession, d: str) -> DataFrame:
    """Candidates and ledger of a bundle as one, by metric identity."""
    hints = table(spark, d, "metric_hint").where("metric_name is not null").select("bundle_id", _names(spark, d).identity(F.col("metric_name")).alias("identity"), F.col("hint_id").alias("ord"), "value")
    mine = table(spark, d, "ledger_metric").where("name is not null").select("bundle_id", _names(spark, d).identity(F.col("name")).alias("identity"), F.col("metric_id").alias("ord"), F.col("as_reported").alias("value"))
    initial = ledger.first_wins(hints, ["bundle_id", "identity"], ["ord"])
    repair = ledger.first_wins(mine, ["bundle_id", "identity"], ["ord"])
    return ledger.outer_merge(initial, repair, ["bundle_id", "identity"], ["value"])


def composite_metrics(spark: SparkSession, d: str) -> DataFrame:
    """Metrics that name several families though their siblings name each."""
    rows = table(spark, d, "ledger_metric").select("metric_id", "bundle_id", "context", _names(spark, d).families(F.col("name")).alias("f"))
    single = rows.where(F.size("f") == 1).groupBy("bundle_id", "context").agg(F.collect_set(F.get("f", F.lit(0))).alias("have"))
    return rows.where(F.size("f") > 1).join(single, ["bundle_id", "context"], "left").select("metric_id", F.coalesce(F.size(F.array_except("f", F.coalesce("have", F.array().cast("array<string>")))) == 0, F.lit(False)).alias("redundant"))


def target_subsets(spark: SparkSession, d: str) -> DataFrame:
    """Scope labels whose words are a proper subset of another's in the bundle."""
    labels = table(spark, d, "metric_hint").where("target is not null").select("bundle_id", "source_item_id", F.array_sort(F.array_distinct(text.tokens(F.col("target")))).alias("words"))
    distinct = labels.where("source_item_id is not null").distinct().withColumn("key", F.array_join("words", " "))
    return ledger.subset_targets(distinct, ["bundle_id", "source_item_id"], "words", "key")


def caption_overlap(spark: SparkSession, d: str) -> DataFrame:
    """Captions of a bundle that share most of their words."""
    rows = table(spark, d, "registry_item").where("caption is not null").groupBy("bundle_id", "caption").agg(F.min("source_item_id").alias("item"))
    words = rows.select("bundle_id", F.concat_ws("#", "item", "caption").alias("id"), F.array_sort(F.array_distinct(text.tokens(F.col("caption")))).alias("words"))
    pairs = ledger.token_overlap_pairs(words, ["bundle_id"], "id", "words", 0.6)
    return pairs.groupBy("bundle_id").agg(F.count(F.lit(1)).alias("pairs"), F.round(F.max("jaccard"), 6).alias("most"))


def stem_document_frequency(spark: SparkSession, d: str) -> DataFrame:
    """How many documents hold each stem."""
    return table(spark, d, "documents").select(F.explode(text.stems(F.col("text"))).alias("stem")).groupBy("stem").agg(F.count(F.lit(1)).alias("documents"))


def sentence_windows(spark: SparkSession, d: str) -> DataFrame:
    rows = candidates.sentence_windows(table(spark, d, "documents"), ["doc_id"], "text")
    return rows.groupBy("doc_id").agg(F.count(F.lit(1)).alias("windows"), F.sum(F.length("window")).alias("characters"), F.max("window_ord").cast("bigint").alias("last"))


def heading_context(spark: SparkSession, d: str) -> DataFrame:
    return candidates.with_heading(table(spark, d, "source_bundle"), ["bundle_id"], "text_for_llm").groupBy("bundle_id", "heading").agg(F.count(F.lit(1)).alias("lines"))


def paragraphs(spark: SparkSession, d: str) -> DataFrame:
    return candidates.paragraphs_of(table(spark, d, "documents"), ["doc_id"], "text").groupBy("doc_id").agg(F.count(F.lit(1)).alias("paragraphs"), F.max(F.length("text")).cast("bigint").alias("longest"))


def candidate_ids(spark: SparkSession, d: str) -> DataFrame:
    rows = table(spark, d, "metric_hint")
    return rows.select("hint_id", ids.candidate_id(F.col("bundle_id"), F.col("source_item_id"), F.col("target"), F.col("metric_name"), F.col("value")).alias("id"))


def canonical_json_ids(spark: SparkSession, d: str) -> DataFrame:
    e = {c: F.col(c) for c in ("claim", "source_item_id", "source_page", "source_section", "source_text")}
    return table(spark, d, "evidence").select("evidence_id", F.sha2(ids.canonical_json(**e), 256).alias("identity"))


def caption_parse(spark: SparkSession, d: str) -> DataFrame:
    p = text.caption_parts(F.col("caption"))
    rows = table(spark, d, "registry_item").distinct()
    return rows.select("bundle_id", "source_item_id", p["kind"].alias("kind"), p["number"].alias("number"), p["body"].alias("body"))


def box_overlap(spark: SparkSession, d: str) -> DataFrame:
    """Pairs of boxes of an order with an IoU of at least 0.45."""
    rows = table(spark, d, "lineitem").select("l_orderkey", F.col("l_quantity").alias("l"), (F.col("l_quantity") + 20).alias("r"), (F.col("l_discount") * 100).alias("t"), (F.col("l_discount") * 100 + 10).alias("b"), "l_partkey", "l_suppkey", "l_linenumber").distinct()
    a, b = rows.alias("a"), rows.alias("b")
    box = lambda x: {k: F.col(f"{x}.{k}") for k in "lrtb"}
    first = F.struct(*[F.col(f"a.{c}") for c in rows.columns]) < F.struct(*[F.col(f"b.{c}") for c in rows.columns])
    pairs = a.join(b, (F.col("a.l_orderkey") == F.col("b.l_orderkey")) & first).select(F.round(numbers.box_iou(box("a"), box("b")), 6).alias("iou"))
    return pairs.where("iou >= 0.45").groupBy("iou").agg(F.count(F.lit(1)).alias("pairs"))


def table_quality(spark: SparkSession, d: str) -> DataFrame:
    """Recovery status of tables by their cells."""
    tables, rows = table(spark, d, "recovered_table"), table(spark, d, "recovered_row")
    cells = audit.cell_metrics(rejects.judge_rows(rows, tables))
    heads = rejects.judge_headers(tables).select("table_id", F.col("reason").isNull().alias("has_header"))
    known = tables.select("table_id", F.size("column_types").alias("columns")).join(heads, "table_id").join(cells, "table_id", "left")
    full = known.withColumns({"rows": F.coalesce("rows", F.lit(0)), "failed": F.coalesce(F.col("rows") > 0, F.lit(False)) & (F.coalesce("parsed", F.lit(0)) == 0)})
    return audit.table_quality(full).select("table_id", F.col("risk_points").cast("bigint").alias("risk_points"), "reason_codes", "status")


def queue_dedup(spark: SparkSession, d: str) -> DataFrame:
    """The strongest event of a user and day, the first of equals (D3)."""
    events = table(spark, d, "events").select("event_id", "user_id", "event_type", F.date_format("ts", "yyyy-MM-dd").alias("day"))
    return audit.strongest(events, ["user_id", "day"], {"error": 3, "purchase": 2, "signup": 1}, "event_type", "event_id")


def last_event(spark: SparkSession, d: str) -> DataFrame:
    """The last event of each user."""
    rows = table(spark, d, "events")
    return rows.groupBy("user_id").agg(F.max_by("event_id", "ts").alias("event_id"), F.max_by("event_type", "ts").alias("event_type"), F.count(F.lit(1)).alias("events"))


def bundle_gate(spark: SparkSession, d: str) -> DataFrame:
    """Boolean checks of each bundle and whether all hold."""
    e = table(spark, d, "evidence").groupBy("bundle_id").agg(F.bool_and(F.col("source_text").isNotNull()).alias("all_quoted"), F.bool_and(F.coalesce(F.col("source_page").cast("string"), "source_item_id").isNotNull()).alias("all_located"))
    b = table(spark, d, "source_bundle").select("bundle_id", (F.col("source_fidelity_status") != "needs_recovery").alias("recovered"))
    j = b.join(e, "bundle_id", "left")
    checks = ["recovered", "all_quoted", "all_located"]
    return j.select("bundle_id", *[F.coalesce(c, F.lit(False)).alias(c) for c in checks]).withColumn("ready", F.col("recovered") & F.col("all_quoted") & F.col("all_located"))


def quality_summary(spark: SparkSession, d: str) -> DataFrame:
    """One row of measures over the ledger (A10)."""
    m = table(spark, d, "ledger_metric")
    return m.agg(
        F.count(F.lit(1)).alias("metrics"),
        F.count_if(F.col("unit").isNotNull()).alias("with_unit"),
        F.count_if(F.col("value_or_summary").isNull()).alias("without_summary"),
        F.countDistinct("bundle_id").alias("bundles"),
        F.countDistinct(F.lower("name")).alias("names"),
        F.count_if(F.col("scope_label").isNull()).alias("without_label"),
    )


def text_chunks(spark: SparkSession, d: str) -> DataFrame:
    """Long texts in pieces with their index and count."""
    rows = table(spark, d, "source_bundle").where("text_for_llm is not null")
    parts = rows.select("bundle_id", F.size(text.chunks(F.col("text_for_llm"))).alias("chunk_count"), F.posexplode(text.chunks(F.col("text_for_llm"))).alias("chunk_index", "chunk"))
    return parts.select("bundle_id", "chunk_index", "chunk_count", F.sha2("chunk", 256).alias("sha256"))


def evidence_first_wins(spark: SparkSession, d: str) -> DataFrame:
    """One row for each quotation or, without one, claim of a bundle."""
    rows = table(spark, d, "evidence").withColumn("key", F.coalesce(text.squeezed(F.col("source_text")), F.concat(F.lit("claim:"), text.squeezed(F.col("claim")))))
    return ledger.first_wins(rows.select("evidence_id", "bundle_id", "key"), ["bundle_id", "key"], ["evidence_id"]).select("evidence_id", "bundle_id")


def hints_per_item(spark: SparkSession, d: str) -> DataFrame:
    """At most 220 prose hints of each bundle, the earliest first (T4)."""
    prose = table(spark, d, "metric_hint").where("kind = 'prose_metric_candidate'").select("bundle_id", "hint_id")
    return ledger.top_per_key(prose, ["bundle_id"], ["hint_id"], 220).select("bundle_id", "hint_id", "rank")


def focus_groups(spark: SparkSession, d: str) -> DataFrame:
    rows = table(spark, d, "metric_hint").where("source_item_id is not null and target is not null and metric_name is not null")
    return candidates.compact_groups(rows, ["bundle_id", "source_item_id", "target"], "metric_name", "hint_id")


def distinct_locations(spark: SparkSession, d: str) -> DataFrame:
    """Distinct item ids and locations of a bundle's evidence, joined."""
    rows = table(spark, d, "evidence").select("bundle_id", "source_item_id", "source_location").distinct()  # as few as the registry's items
    join = lambda c: F.array_join(F.array_sort(F.collect_set(c)), "; ")
    return rows.groupBy("bundle_id").agg(join("source_item_id").alias("items"), join("source_location").alias("locations"))


def peer_targets(spark: SparkSession, d: str) -> DataFrame:
    """Prose hints of a section with the same metric and value, with their targets."""
    rows = table(spark, d, "metric_hint").where("kind = 'prose_metric_candidate'")
    keyed = rows.select("bundle_id", "section_hint", _names(spark, d).identity(F.col("metric_name")).alias("identity"), "value", text.token_key(F.col("target")).alias("t"))
    return keyed.groupBy("bundle_id", "section_hint", "identity", "value").agg(F.countDistinct("t").alias("targets"), F.count(F.lit(1)).alias("hints"))


def portable_paths(spark: SparkSession, d: str) -> DataFrame:
    rows = table(spark, d, "source_bundle").select("bundle_id", F.concat(F.lit("/data/packages/p"), F.col("bundle_id").cast("string")).alias("home"), "source_filename")
    inside = text.portable_path(F.concat("home", F.lit("/raw/"), "source_filename"), F.col("home"))
    windows = text.portable_path(F.concat(F.lit("C:\\incoming\\"), "source_filename"), F.col("home"))
    return rows.select("bundle_id", inside.alias("inside"), windows.alias("elsewhere"), text.portable_path(F.col("source_filename"), F.col("home")).alias("relative"))


def page_statistics(spark: SparkSession, d: str) -> DataFrame:
    rows = table(spark, d, "source_bundle").select("source_fidelity_status", "page_count", F.length("text_for_llm").alias("chars"))
    per_page = F.col("chars") / F.col("page_count")
    return rows.groupBy("source_fidelity_status").agg(F.sum("page_count").alias("pages"), F.round(F.median("page_count"), 3).alias("median_pages"), F.round(F.avg(F.when(per_page < 500, 1.0).otherwise(0.0)), 6).alias("thin"))


def terminology(spark: SparkSession, d: str) -> DataFrame:
    """Texts with deprecated terms replaced, as hashes."""
    terms = [("user accuracy", "users accuracy"), ("percent bias", "relative bias"), ("linear correlation", "product-moment correlation")]
    rows = table(spark, d, "evidence").select("evidence_id", text.replaced_terms(F.col("claim"), terms).alias("t"), "claim")
    return rows.where("t <> claim").select("evidence_id", F.sha2("t", 256).alias("sha256"))


def section_relations(spark: SparkSession, d: str) -> DataFrame:
    """Pairs of sections of a bundle's evidence that stand in one another."""
    s = table(spark, d, "evidence").where("source_section is not null").select("bundle_id", "source_section").distinct()
    return ledger.related_pairs(s, ["bundle_id"], "source_section")


def caption_bodies(spark: SparkSession, d: str) -> DataFrame:
    return candidates.caption_has_body(table(spark, d, "documents"), ["doc_id"], "text").select("doc_id", "line_no", "body_lines")


def metric_dedup_fold(spark: SparkSession, d: str) -> DataFrame:
    """Repeated metrics merged in order where they don't contradict."""
    m = table(spark, d, "ledger_metric").where("name is not null")
    rows = m.select(
        "bundle_id", "metric_id", "name", F.col("as_reported").alias("display"), numbers.aggregation(F.lower(F.concat_ws(" ", "name", "as_reported"))).alias("aggregation"), "unit", "interpretation",
        "context", "scope", F.col("scope_label").alias("target"), F.col("evaluation_support").alias("support"), F.col("evaluation_population").alias("population"),
    )
    return ledger.deduplicate_metrics(rows, _names(spark, d)).select("bundle_id", "identity", "metric_id", "aggregation", "nominal_level", "members", "rows")


def caption_matches(spark: SparkSession, d: str) -> DataFrame:
    """Captions of documents matched one to one to the items of their bundle.

    A caption is any line that begins with a kind, a number and a delimiter ("Figure 5
    shows" is prose), and is compared with the tables or figures of its bundle.  Documents
    have no pages, so the page of a caption is unknown.
    """
    lines = candidates.lines_of(table(spark, d, "documents").select("bundle_id", "doc_id", "text"), ["bundle_id", "doc_id"], "text")
    found = lines.withColumn("caption", F.trim(F.regexp_replace("line", r"[\s\p{Z}]+", " "))).where(F.col("caption").rlike(text.CAPTION))
    captions = found.select(F.col("bundle_id").alias("doc_id"), F.col("doc_id").alias("caption_ord"), "line_no", text.caption_parts(F.col("caption"))["kind"].alias("kind"), text.caption_number(F.col("caption")).alias("number"), F.lit(None).cast("int").alias("page"), "caption")
    items = ledger.unique_registry(table(spark, d, "registry_item")).where("item_type in ('table', 'figure')")
    named = items.select(F.col("bundle_id").alias("doc_id"), F.col("source_item_id").alias("item_id"), F.col("item_type").alias("kind"), text.caption_number(F.col("caption")).alias("number"), F.col("source_page").cast("int").alias("page"), "caption")
    return audit.match_captions(captions, named)


def prose_pairs(spark: SparkSession, d: str) -> DataFrame:
    rows = discovery.prose_pairs(table(spark, d, "metric_hint").where("excerpt is not null").select("hint_id", "excerpt"), "excerpt")
    return rows.drop("excerpt")


def table_cell_hints(spark: SparkSession, d: str) -> DataFrame:
    return discovery.table_cell_hints(rejects.typed_rows(table(spark, d, "recovered_row"), table(spark, d, "recovered_table")))


def ledger_backfill(spark: SparkSession, d: str) -> DataFrame:
    return discovery.backfill(table(spark, d, "metric_hint"), table(spark, d, "ledger_metric"), _names(spark, d))


def evidence_merge(spark: SparkSession, d: str) -> DataFrame:
    return discovery.merge_evidence(table(spark, d, "evidence"))


def record_fields(spark: SparkSession, d: str) -> DataFrame:
    """Scalars of all records by their path without positions (H6)."""
    leaves = discovery.json_leaves(table(spark, d, "matrix_record"), "record_id", "record_json")
    return leaves.groupBy(F.regexp_replace("path", r"\[[0-9]+\]", "[]").alias("path")).agg(F.count(F.lit(1)).alias("n"), F.countDistinct("id").alias("records"))


def provenance_issues(spark: SparkSession, d: str) -> DataFrame:
    return discovery.provenance_rules(table(spark, d, "matrix_record"), table(spark, d, "source_bundle"))


def recovered_markdown(spark: SparkSession, d: str) -> DataFrame:
    """Valid rows of recovered tables rendered, as lengths and hashes."""
    typed = rejects.typed_rows(table(spark, d, "recovered_row"), table(spark, d, "recovered_table"))
    rows = typed.join(table(spark, d, "recovered_row").select("row_id", "row_index"), "row_id").select("table_id", "row_index", F.posexplode("cells").alias("col_ordinal", "cell"))
    text_ = sinks.markdown_table(rows.select("table_id", "row_index", "col_ordinal", F.col("cell.name").alias("column"), F.col("cell.text").alias("value")))
    return text_.select("table_id", F.length("markdown").alias("characters"))


def bundle_digest(spark: SparkSession, d: str) -> DataFrame:
    """Captions of a bundle's items as one ordered text with its hash (K8)."""
    items = ledger.unique_registry(table(spark, d, "registry_item")).where("caption is not null")
    return sinks.bundle_text(items.select("bundle_id", F.col("source_item_id").alias("ord"), F.col("caption").alias("text")), ["bundle_id"]).select("bundle_id", "sha256")


def stream_last_event(spark: SparkSession, d: str) -> DataFrame:
    return streams.run_once(streams.last_events(streams.stream_of(spark, d, "events"), "user_id", "ts", ["event_id", "event_type"]), "complete")


def stream_hourly_counts(spark: SparkSession, d: str) -> DataFrame:
    counts = streams.windowed_counts(streams.stream_of(spark, d, "events"), "ts", "event_type")
    return streams.run_once(counts, "update", ["start", "event_type"]).select(F.date_format("start", "yyyy-MM-dd HH:mm").alias("start"), "event_type", "n")


def recovery_queue(spark: SparkSession, d: str) -> DataFrame:
    return audit.in_queue_order(audit.recovery_queue(ledger.unique_registry(table(spark, d, "registry_item"))))


def guardrail_coverage(spark: SparkSession, d: str) -> DataFrame:
    """Quotations of a bundle taken up by its documents."""
    items = table(spark, d, "evidence").where("source_text is not null").select("bundle_id", F.col("evidence_id").alias("item_id"), F.col("source_text").alias("text"))
    return discovery.guardrail_coverage(items, table(spark, d, "documents").select("bundle_id", "text"), ["bundle_id"])


def registry_build(spark: SparkSession, d: str) -> DataFrame:
    return candidates.registry_of(table(spark, d, "recovered_table"))


def prose_hints(spark: SparkSession, d: str) -> DataFrame:
    """Sentence windows of statements that speak of a metric with a number (C4)."""
    windows = candidates.sentence_windows(table(spark, d, "evidence"), ["evidence_id"], "claim")
    return candidates.prose_hints(windows, "window", _names(spark, d)).groupBy("evidence_id").agg(F.count(F.lit(1)).alias("hints"), F.count_if("summary").alias("summaries"))


def guardrail_sections(spark: SparkSession, d: str) -> DataFrame:
    lines = candidates.lines_of(table(spark, d, "source_bundle").select("bundle_id", "text_for_llm"), ["bundle_id"], "text_for_llm")
    return candidates.sections_under(lines, ["bundle_id"], "limitation|quality|discussion")


def scope_labels(spark: SparkSession, d: str) -> DataFrame:
    rows = table(spark, d, "ledger_metric").where("scope_label is not null")
    return rows.select(text.single_target(F.col("scope_label")).alias("target"), "scope").groupBy("target", "scope").agg(F.count(F.lit(1)).alias("n"))


def unit_consensus(spark: SparkSession, d: str) -> DataFrame:
    """Missing units filled where a bundle's metric agrees on one."""
    rows = table(spark, d, "ledger_metric").where("name is not null").select("metric_id", "bundle_id", _names(spark, d).identity(F.col("name")).alias("identity"), "unit")
    return ledger.filled_by_consensus(rows, ["bundle_id", "identity"], "unit", "metric_id")


def batch_summary(spark: SparkSession, d: str) -> DataFrame:
    """One row a package with the counts of its parts."""
    out = table(spark, d, "source_bundle").select("bundle_id", "source_fidelity_status", "page_count")
    for name in ("registry_item", "metric_hint", "evidence", "ledger_metric"):
        counts = table(spark, d, name).groupBy("bundle_id").agg(F.count(F.lit(1)).alias(f"{name}s"))
        out = out.join(counts, "bundle_id", "left").fillna(0, [f"{name}s"])
    return out


def metric_headers(spark: SparkSession, d: str) -> DataFrame:
    """Column names of recovered tables that look like metrics."""
    names = rejects.judge_headers(table(spark, d, "recovered_table")).where("reason is null").select("table_id", F.explode("names").alias("name"))
    return names.where(F.size(_names(spark, d).families(F.col("name"))) > 0).groupBy("name").agg(F.count(F.lit(1)).alias("tables"))


def prose_unrepresented(spark: SparkSession, d: str) -> DataFrame:
    """Prose hints without a ledger row of their metric that shares a word of the target."""
    words = lambda c: F.array_distinct(text.tokens(F.coalesce(F.col(c), F.lit(""))))
    hints = table(spark, d, "metric_hint").where("kind = 'prose_metric_candidate' and metric_name is not null").select("bundle_id", "hint_id", _names(spark, d).identity(F.col("metric_name")).alias("identity"), words("target").alias("words"))
    rows = table(spark, d, "ledger_metric").where("name is not null").select("bundle_id", _names(spark, d).identity(F.col("name")).alias("identity"), words("scope_label").alias("words"))
    return ledger.unrepresented(hints, rows, ["bundle_id"]).select("hint_id", "bundle_id", "identity")


def structured_siblings(spark: SparkSession, d: str) -> DataFrame:
    """Metrics of a selected table row that a record left out."""
    names = _names(spark, d)
    return consolidation.missing_siblings(consolidation.table_rows(table(spark, d, "metric_hint"), names), consolidation.record_rows(table(spark, d, "matrix_record"), names))


def structured_targets(spark: SparkSession, d: str) -> DataFrame:
    """Rows of a used table that a record left out."""
    names = _names(spark, d)
    return consolidation.missing_targets(consolidation.table_rows(table(spark, d, "metric_hint"), names), consolidation.record_rows(table(spark, d, "matrix_record"), names))


def scope_harmony(spark: SparkSession, d: str) -> DataFrame:
    """Fallback scopes replaced by the most special one of their target."""
    rows = consolidation.harmonized_scopes(table(spark, d, "ledger_metric").select("metric_id", "bundle_id", "scope", "scope_label"), ["bundle_id"])
    return rows.where("scope <> harmonized").select("metric_id", "scope", "harmonized")


def ledger_sorting(spark: SparkSession, d: str) -> DataFrame:
    """Where each row of the ledger belongs."""
    return consolidation.sorted_out(table(spark, d, "ledger_metric"), _names(spark, d)).select("metric_id", "belongs")


def ledger_full_merge(spark: SparkSession, d: str) -> DataFrame:
    """Hints and ledger of a bundle as one by all five parts of the key."""
    names = _names(spark, d)
    hints = table(spark, d, "metric_hint").where("metric_name is not null").select("bundle_id", "hint_id", "metric_name", F.lit("").alias("none"), "target", "value", "unit_hint")
    mine = table(spark, d, "ledger_metric").where("name is not null").select("bundle_id", "metric_id", "name", "context", "scope_label", "evaluation_support", "as_reported", "unit")
    keys = ["bundle_id", "k_metric", "k_context", "k_target", "k_support", "k_value"]
    a = consolidation.merge_key(hints, "metric_name", "none", "target", "none", "value", names).select(*keys, F.col("unit_hint").alias("unit"), F.col("hint_id").alias("ord"))
    b = consolidation.merge_key(mine, "name", "context", "scope_label", "evaluation_support", "as_reported", names).select(*keys, "unit", F.col("metric_id").alias("ord"))
    merged = ledger.outer_merge(ledger.first_wins(a, keys, ["ord"]), ledger.first_wins(b, keys, ["ord"]), keys, ["unit", "ord"])
    return merged.groupBy("origin").agg(F.count(F.lit(1)).alias("rows"), F.count("unit").alias("with_unit"), F.countDistinct("k_metric").alias("metrics"), F.sum("ord").alias("ords"))


def structured_evidence(spark: SparkSession, d: str) -> DataFrame:
    """Evidence that stands on a structured item."""
    items = ledger.unique_registry(table(spark, d, "registry_item")).select("bundle_id", "source_item_id", "item_type")
    rows = table(spark, d, "evidence").join(items, ["bundle_id", "source_item_id"], "left")
    return rows.select("evidence_id", consolidation.structured_evidence(F.col("item_type"), F.col("source_modality"), F.col("representation_method")).alias("structured"))


def locator_counts(spark: SparkSession, d: str) -> DataFrame:
    return consolidation.locator_counts(table(spark, d, "evidence"), ["bundle_id"])


def record_summary(spark: SparkSession, d: str) -> DataFrame:
    return consolidation.record_summaries(table(spark, d, "matrix_record"))


def numbered_sections(spark: SparkSession, d: str) -> DataFrame:
    """Numbered sentences of documents, each line made an item first."""
    rows = table(spark, d, "documents").select("doc_id", F.regexp_replace("text", r"(?m)^#+ ([0-9]+) ", "$1. ").alias("text"))
    items = consolidation.numbered_items(rows, ["doc_id"], "text")
    return items.groupBy("doc_id", "number").agg(F.count(F.lit(1)).alias("items"), F.max(F.length("item")).cast("bigint").alias("longest"))


def evidence_siblings(spark: SparkSession, d: str) -> DataFrame:
    """Metrics that a metric's own evidence speaks of and the record lacks."""
    return consolidation.suggested_siblings(table(spark, d, "matrix_record"), _names(spark, d))


def record_provenance(spark: SparkSession, d: str) -> DataFrame:
    """Records with the source and hash of their package."""
    return consolidation.with_provenance(table(spark, d, "matrix_record").select("record_id", "bundle_id"), table(spark, d, "source_bundle"))


def record_issue_catalogue(spark: SparkSession, d: str) -> DataFrame:
    """Issues of records by code (rules over evidence, siblings, tables and provenance)."""
    found = consolidation.record_issues(table(spark, d, "matrix_record"), table(spark, d, "source_bundle"), table(spark, d, "metric_hint"), _names(spark, d))
    return found.groupBy("code", "severity").agg(F.count(F.lit(1)).alias("issues"), F.countDistinct("record").alias("records"))


def record_unknown_items(spark: SparkSession, d: str) -> DataFrame:
    """Items that records name and their package's registry lacks."""
    return consolidation.record_unknown_items(table(spark, d, "matrix_record"), table(spark, d, "registry_item"))


def structured_backfill(spark: SparkSession, d: str) -> DataFrame:
    """Gaps of selected table rows filled from their hints."""
    return consolidation.backfilled(table(spark, d, "metric_hint"), table(spark, d, "matrix_record"), _names(spark, d))


def quantity_backfill(spark: SparkSession, d: str) -> DataFrame:
    """Quantities of the ledger filled in from the summary and the interpretation."""
    rows = table(spark, d, "ledger_metric").select("metric_id", "as_reported", "value_or_summary", "interpretation")
    return numbers.enriched(rows, "as_reported", "value_or_summary", "interpretation", "q").select("metric_id", "q.*")


NAMES = [
    parse_quantity, quantity_conflict_issues, number_identity, metric_families, target_token_key, content_tokens, registry_locator_join, registry_unknown_item, issue_catalogue,
    scope_issues, table_unpivot, sibling_gaps, table_target_rows, context_consensus, scope_mode, fitness_views, ledger_outer_merge, composite_metrics, target_subsets, caption_overlap,
    stem_document_frequency, sentence_windows, heading_context, paragraphs, candidate_ids, canonical_json_ids, caption_parse, box_overlap, table_quality, queue_dedup, last_event,
    bundle_gate, quality_summary, text_chunks, evidence_first_wins, hints_per_item, focus_groups, distinct_locations, peer_targets, portable_paths, page_statistics, terminology,
    section_relations, caption_bodies, metric_dedup_fold, caption_matches,
    prose_pairs, table_cell_hints, ledger_backfill, evidence_merge, record_fields, provenance_issues, recovered_markdown, bundle_digest, stream_last_event, stream_hourly_counts,
    recovery_queue, guardrail_coverage, registry_build, prose_hints, guardrail_sections, scope_labels, unit_consensus, batch_summary, metric_headers, prose_unrepresented,
    structured_siblings, structured_targets, scope_harmony, ledger_sorting, ledger_full_merge, structured_evidence, locator_counts, record_summary, numbered_sections, evidence_siblings, record_provenance, record_issue_catalogue, record_unknown_items, structured_backfill, quantity_backfill,
]
QUERIES = {f.__name__: f for f in NAMES}
