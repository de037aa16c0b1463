"""Consolidation of a ledger: rows of selected tables, scopes, moves, summaries, predicates."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerloom.functions.metrics import Names
from ledgerloom.functions.text import squeezed, tokens
from ledgerloom.operators.ledger import TARGET_STOP_WORDS
from ledgerloom.operators.nested import section_children
from ledgerloom.session import cut

# Scopes by how special they are, and scopes that give way to a special one.
SCOPE_RANK = {"crop": 1, "crop_phase": 2, "phase_year": 3}
FALLBACK_SCOPES = ("unknown", "subgroup", "variable_or_layer")
# Modalities that go with an authored item, and representations that are
# structured whatever their modality.
ITEM_MODALITIES = {"table": ("author_table",), "figure": ("author_figure", "author_caption"), "formula": ("author_formula",)}
STRUCTURED = ("docling_structured", "structured_visual_recovery")
# Ranges whose basis isn't stated.
GENERIC_BASIS = ("", "reported range (basis not stated)", "reported interval or range (type not stated)", "reported min-max or across-group range")


# --- predicates (F9, F11-F16) -----------------------------------------------------------


def structured_evidence(item_type: Column, modality: Column, representation: Column) -> Column:
    """Whether evidence stands on a structured item (F9): its modality goes with the item,
    or is unknown beside a structured representation."""
    known = F.coalesce(modality, F.lit("unknown"))
    fits = F.lit(False)
    for kind, allowed in ITEM_MODALITIES.items():
        fits = fits | ((item_type == kind) & known.isin(*allowed))
    return F.coalesce(fits, F.lit(False)) | ((known == "unknown") & F.coalesce(representation.isin(*STRUCTURED), F.lit(False)))


def parameter_like(context: Column, names_outcome: Column, text: Column) -> Column:
    """Whether a metric is a tuning parameter (F11): tried in tuning, named like no outcome,
    and its text speaks of a threshold, multiplier, parameter or setting being tried."""
    thing, tried = "(threshold|multiplier|hyperparameter|parameter|setting)s?", "(candidate|tested|evaluated|grid|range|set of|values?|levels?|=)"
    cue = squeezed(text).rlike(rf"\b{thing}\b[^.;]{{0,100}}{tried}|\b{tried}[^.;]{{0,80}}\b{thing}\b")
    return (context == "selection_or_tuning") & ~names_outcome & F.coalesce(cue, F.lit(False))


def without_outcome(text: Column) -> Column:
    """Whether a text says that it reports no result of its own."""
    return F.coalesce(squeezed(text).rlike(r"\bno standalone numerical (summary|value|result)\b|\bnot an independently reported validation result\b"), F.lit(False))


def target_specific(population: Column) -> Column:
    """Whether a population counts the surfaces of one target (F13); such a count is no
    other target's."""
    return F.coalesce(squeezed(population).rlike(r"\b[0-9]+\b[^.;]{0,80}\bsurfaces?\b|\bsurfaces?\b[^.;]{0,80}\b[0-9]+\b"), F.lit(False))


def generated_row(claims: Column, label: Column, name: Column, display: Column) -> Column:
    """Whether all statements of a metric are the sentence a backfilled row is given (F14);
    none is no such row."""
    sentence = squeezed(F.concat(label, F.lit(": "), name, F.lit(" "), display, F.lit(".")))
    return (F.size(claims) > 0) & F.forall(claims, lambda c: squeezed(c) == sentence)


def generic_basis(basis: Column) -> Column:
    """Whether a range's basis isn't stated (F16)."""
    return squeezed(F.coalesce(basis, F.lit(""))).isin(*GENERIC_BASIS)


# --- rows of selected tables (J3, J4, T5) -----------------------------------------------


def candidate_target(text: Column) -> Column:
    """What a hint or metric speaks of: the crop of a record of fields, else its first field,
    as words; null and blank name nothing."""
    fields = F.split(F.lower(text), r"[;|,]|\s/\s")
    crop = F.coalesce(F.get(F.filter(fields, lambda f: f.rlike(r"^\W*crop\W")), F.lit(0)), F.get(fields, F.lit(0)))
    words = F.trim(F.regexp_replace(F.regexp_replace(crop, r"^\W*crop\W", " "), r"[^\p{L}\p{N}]+", " "))
    return F.when(words != "", words)


def record_rows(records: DataFrame, names: Names) -> DataFrame:
    """What the metrics of records stand on: ``(record_id, bundle_id, item, target, key, ord,
    context)``, a row for each item among a metric's evidence."""
    below = cut(section_children(records).where("child_kind in ('metric', 'metric_evidence')"))
    field = lambda c: F.col("body")[c]
    metric = below.where("child_kind = 'metric'").select("record_id", F.col("child_ord").alias("ord"), names.identity(field("name")).alias("key"), candidate_target(field("scope_label")).alias("target"), field("context").alias("context"))
    items = below.where("child_kind = 'metric_evidence'").select("record_id", F.col("parent_ord").alias("ord"), field("source_item_id").alias("item")).where("item is not null").distinct()
    owner = records.select("record_id", "bundle_id").distinct()
    return metric.where("target is not null").join(items, ["record_id", "ord"]).join(owner, "record_id").select("record_id", "bundle_id", "item", "target", "key", "ord", "context").distinct()


def table_rows(hints: DataFrame, names: Names) -> DataFrame:
    """What structured hints offer: ``(bundle_id, item, target, key, family)``."""
    asked = hints.where("kind = 'structured_table_metric' and source_item_id is not null and metric_name is not null")
    rows = asked.select("bundle_id", F.col("source_item_id").alias("item"), candidate_target(F.col("target")).alias("target"), names.identity(F.col("metric_name")).alias("key"), names.family(F.col("metric_name")).alias("family"))
    return rows.where("target is not null").distinct()


def missing_siblings(offered: DataFrame, taken: DataFrame) -> DataFrame:
    """Metrics of a selected row of a table that its record left out (J3): ``(record_id,
    item, target, missing)``.  Only rows a record selected are compared."""
    chosen = taken.select("record_id", "bundle_id", "item", "target").distinct()
    asked = chosen.join(offered.select("bundle_id", "item", "target", "key").distinct(), ["bundle_id", "item", "target"])
    left = asked.join(taken, ["record_id", "bundle_id", "item", "target", "key"], "left_anti")
    return left.groupBy("record_id", "item", "target").agg(F.array_join(F.array_sort(F.collect_set("key")), ", ").alias("missing"))


def backfilled(hints: DataFrame, records: DataFrame, names: Names) -> DataFrame:
    """Rows that fill the gaps of selected table rows (J19): ``(record_id, item, target, key,
    hint_id, value, context)``.

    A gap is filled from the first hint that offers the metric; its context is that of the
    prototype, the record's first metric on the same item and target.  Added rows stand on
    rows that were selected before, so none of them opens further gaps.
    """
    taken = cut(record_rows(records, names))
    row = ["bundle_id", "item", "target"]
    asked = hints.where("kind = 'structured_table_metric' and source_item_id is not null and metric_name is not null")
    offers = asked.select("bundle_id", F.col("source_item_id").alias("item"), candidate_target(F.col("target")).alias("target"), names.identity(F.col("metric_name")).alias("key"), "hint_id", "value")
    first = offers.where("target is not null").groupBy(*row, "key").agg(F.min("hint_id").alias("hint_id"), F.min_by("value", "hint_id").alias("value"))
    proto = taken.groupBy("record_id", *row).agg(F.min_by("context", "ord").alias("context"))
    gaps = proto.join(first, row).join(taken.select("record_id", *row, "key").distinct(), ["record_id", *row, "key"], "left_anti")
    return gaps.select("record_id", "item", "target", "key", "hint_id", "value", "context")


def missing_targets(offered: DataFrame, taken: DataFrame, preview: int = 8) -> DataFrame:
    """Rows of a table with several targets and metrics that a record using the table left
    out (J4), the first few named and the rest counted (T5): ``(record_id, item, missing,
    targets)``."""
    wide = offered.groupBy("bundle_id", "item").agg(F.countDistinct("target").alias("n"), F.countDistinct("family").alias("m")).where("n >= 2 and m >= 2").select("bundle_id", "item")
    used = taken.select("record_id", "bundle_id", "item").distinct().join(wide, ["bundle_id", "item"])
    asked = used.join(offered.select("bundle_id", "item", "target").distinct(), ["bundle_id", "item"])
    left = asked.join(taken.select("record_id", "item", "target").distinct(), ["record_id", "item", "target"], "left_anti")
    named = F.col("all")
    rest = F.when(F.size(named) > preview, F.concat(F.lit(" and "), (F.size(named) - preview).cast("string"), F.lit(" more"))).otherwise("")
    return left.groupBy("record_id", "item").agg(F.array_sort(F.collect_set("target")).alias("all")).select("record_id", "item", F.size(named).alias("missing"), F.concat(F.array_join(F.slice(named, 1, preview), ", "), rest).alias("targets"))


# --- scopes, moves, merges (A5, D10, D6, J15) -------------------------------------------


def target_words(label: Column) -> Column:
    """The sorted words of a target without stop words."""
    return F.array_sort(F.filter(tokens(F.coalesce(label, F.lit(""))), lambda t: ~t.isin(*TARGET_STOP_WORDS)))


def harmonized_scopes(ledger: DataFrame, keys: list[str]) -> DataFrame:
    """Add ``harmonized``, the scope after fallback scopes gave way to the most special one
    of their target (A5, D10).

    Targets of fewer than two words are left alone.  The special scope is a maximum per
    target, joined back; it is one row a target.
    """
    rank = F.coalesce(*[F.when(F.col("scope") == s, r) for s, r in SCOPE_RANK.items()])
    rows = ledger.withColumn("_target", F.array_join(target_words(F.col("scope_label")), " "))
    best = rows.where(F.col("_target").contains(" ") & rank.isNotNull()).groupBy(*keys, "_target").agg(F.max_by("scope", rank).alias("_special"))
    joined = rows.join(best, [*keys, "_target"], "left")
    gives = F.col("scope").isin(*FALLBACK_SCOPES) & F.col("_special").isNotNull()
    return joined.select(*ledger.columns, F.when(gives, F.col("_special")).otherwise(F.col("scope")).alias("harmonized"))


def sorted_out(ledger: DataFrame, names: Names) -> DataFrame:
    """Add where a row belongs (D6): ``parameters``, ``evidence`` where it reports no result,
    else ``ledger``."""
    text = F.concat_ws(" ", "value_or_summary", "interpretation")
    outcome = F.size(names.families(F.col("name"))) > 0
    moved = F.when(parameter_like(F.col("context"), outcome, text), "parameters").when(without_outcome(text), "evidence").otherwise("ledger")
    return ledger.withColumn("belongs", moved)


def merge_key(df: DataFrame, name: str, context: str, target: str, support: str, value: str, names: Names) -> DataFrame:
    """Add the five parts that tell ledger rows apart in a merge (J15): metric, context,
    target, support and value; the scope is none of them."""
    empty = lambda c: F.coalesce(F.col(c), F.lit("")) if c else F.lit("")
    return df.withColumns({
        "k_metric": names.identity(F.col(name)), "k_context": empty(context), "k_target": F.array_join(target_words(F.col(target)), " "), "k_support": empty(support), "k_value": squeezed(empty(value)),
    })


# --- summaries (A11, A17) ---------------------------------------------------------------


def locator_counts(evidence: DataFrame, keys: list[str]) -> DataFrame:
    """Explicit evidence without text, item or section, and recovered visual evidence of
    another modality than an authored item's (A17), by key."""
    weak = (F.col("evidence_type") == "explicit") & F.coalesce("source_text", "source_item_id", "source_section").isNull()
    authored = sorted({m for kinds in ITEM_MODALITIES.values() for m in kinds})
    odd = (F.col("representation_method") == "structured_visual_recovery") & ~F.coalesce(F.col("source_modality").isin(*authored), F.lit(False))
    return evidence.groupBy(*keys).agg(F.count_if(weak).alias("weak_locators"), F.count_if(odd).alias("odd_modalities"))


def record_summaries(records: DataFrame) -> DataFrame:
    """One row a record with its heading fields and the counts of its parts.

    Lists count in whatever notation they were delivered; a record that can't be read has
    no row.
    """
    at = lambda p: F.get_json_object("record_json", f"$.{p}")
    head = records.select("record_id", at("document_metadata.title").alias("title"), at("document_metadata.document_status").alias("status"), at("extraction_provenance.schema_version").alias("schema_version"))
    kinds = {"metric": "metrics", "parameter": "parameters", "section_evidence": "section_evidence"}
    counts = section_children(records).groupBy("record_id").agg(*[F.count_if(F.col("child_kind") == k).alias(v) for k, v in kinds.items()])
    return head.join(counts, "record_id", "left").select("*").fillna(0, list(kinds.values()))


def numbered_items(df: DataFrame, keys: list[str], text: str) -> DataFrame:
    """Numbered items of a text, each up to the next number at a line's beginning (W7):
    ``(keys, number, item)``; empty items are none."""
    parts = F.split(F.regexp_replace(F.col(text), r"(?m)^([0-9]+)\.[ \t]+", "\x01$1\x02"), "\x01")
    items = df.select(*keys, F.explode(parts).alias("_part")).where(F.col("_part").contains("\x02"))
    cells = F.split("_part", "\x02")
    return items.select(*keys, F.get(cells, F.lit(0)).try_cast("int").alias("number"), F.trim(F.regexp_replace(F.get(cells, F.lit(1)), r"^\s+|\s+$", "")).alias("item")).where("item <> ''")


# --- evidence, provenance, geometry, texts (J12, J23, J26, M3, M12, K9, H8, S11) ---------


def suggested_siblings(records: DataFrame, names: Names) -> DataFrame:
    """Metrics that a metric's own statements give a number for and that the record has no
    row of under the same label (J26): ``(record_id, ord, sibling)``."""
    below = cut(section_children(records).where("child_kind in ('metric', 'metric_evidence')"))
    field = lambda c: F.col("body")[c]
    label = F.coalesce(squeezed(field("scope_label")), F.lit(""))
    metric = below.where("child_kind = 'metric'").select("record_id", F.col("child_ord").alias("ord"), names.family(field("name")).alias("key"), label.alias("label"))
    said = below.where("child_kind = 'metric_evidence'").where(field("claim").rlike("[0-9]")).select("record_id", F.col("parent_ord").alias("ord"), F.explode(names.families(field("claim"))).alias("sibling")).distinct()
    own = metric.select("record_id", "ord", F.col("key").alias("own"), "label")
    asked = said.join(own, ["record_id", "ord"]).where("own is null or own <> sibling")
    have = metric.where("key is not null").select("record_id", "label", F.col("key").alias("sibling")).distinct()
    return asked.join(have, ["record_id", "label", "sibling"], "left_anti").select("record_id", "ord", "sibling")


def with_provenance(records: DataFrame, bundles: DataFrame) -> DataFrame:
    """Records with the identity of their package (M12); a hash counts only if it has 64
    hexadecimal digits."""
    hash_ = F.when(F.lower("source_sha256").rlike("^[0-9a-f]{64}$"), F.lower("source_sha256"))
    known = bundles.select("bundle_id", F.col("source_filename").alias("injected_source"), hash_.alias("injected_sha256"))
    return records.join(known, "bundle_id", "left")


def novel_limitations(candidates: DataFrame, texts: DataFrame, keys: list[str], least: float = 0.55) -> DataFrame:
    """The first statement of a key of which less than ``least`` of the longer words occur in
    what its text already says (M3): ``(keys, limitation)``.

    ``candidates`` has the keys, ``ord`` and ``statement``, ``texts`` the keys and ``text``.
    """
    long = F.array_distinct(F.filter(tokens(F.col("statement")), lambda t: F.length(t) >= 5))
    rows = candidates.withColumn("_words", long).join(texts.select(*keys, F.lower("text").alias("_text")), keys, "left")
    held = F.size(F.filter("_words", lambda w: F.coalesce(F.col("_text").contains(w), F.lit(False))))
    novel = rows.where((F.size("_words") > 0) & (held < F.size("_words") * least))
    return novel.groupBy(*keys).agg(F.min_by("statement", "ord").alias("limitation"))


def with_page_geometry(items: DataFrame, pages: DataFrame) -> DataFrame:
    """Items with the size of their page (J23); items of unknown pages keep null."""
    return items.join(pages.select("doc_id", "page", "width", "height"), ["doc_id", "page"], "left")


def caption_boxes(captions: DataFrame, blocks: DataFrame, similarity: Column, order: str) -> DataFrame:
    """Captions with the box of the most similar block of their page and number, the first
    of equals (J12).

    Both sides have ``(doc_id, page, number)``; ``similarity`` is a column over the joined
    rows, ``order`` the blocks' order.
    """
    keys = ["doc_id", "page", "number"]
    joined = captions.join(blocks, keys).withColumn("_s", similarity)
    best = joined.groupBy(*keys).agg(F.max_by("box", F.struct("_s", (-F.col(order)).alias("o"))).alias("box"))
    return captions.join(best, keys, "left")


def queue_lines(queue: DataFrame) -> DataFrame:
    """Queue rows ready for a CSV sink: lists joined by semicolons (K9)."""
    kinds = dict(queue.dtypes)
    return queue.select(*[F.concat_ws(";", c).alias(c) if kinds[c].startswith("array") else F.col(c) for c in queue.columns])


def reply_text(reply: Column) -> Column:
    """The text of a model's reply in any of its known notations (H8); null if there is none."""
    paths = ("$.output_text", "$.output[0].content[0].text", "$.choices[0].message.content", "$.content[0].text")
    return F.coalesce(*[F.nullif(F.trim(F.get_json_object(reply, p)), F.lit("")) for p in paths])


def expanded(name: str, templates: dict[str, str], above: tuple[str, ...] = ()) -> str:
    """A template with the templates it includes put in (S11); a cycle is an error."""
    import re

    if name in above:
        raise ValueError(f"templates include one another: {' > '.join((*above, name))}")
    if name not in templates:
        raise KeyError(f"no template {name!r}")
    return re.sub(r"\{\{INCLUDE:\s*([^}\s]+)\s*\}\}", lambda m: expanded(m[1], templates, (*above, name)), templates[name])


# --- rules over records and packages ----------------------------------------------------

#: Wordings of interval calibration that are no longer used.
DEPRECATED_TERMS = r"\binterval[- ]calibrat|\bcalibrated (prediction |confidence )?intervals?\b"


def record_issues(records: DataFrame, bundles: DataFrame, hints: DataFrame, names: Names) -> DataFrame:
    """Issues of records: ``(record, code, severity)``, a row for each finding.

    The section's objects are found once; each rule then reads only its own part of them.
    A record without provenance isn't asked for hashes, and a package's hash counts only if
    it has 64 hexadecimal digits.
    """
    below = cut(section_children(records).where("child_kind in ('metric', 'metric_evidence')"))
    field = lambda c: F.col("body")[c]
    metric = below.where("child_kind = 'metric'").select("record_id", F.col("child_ord").alias("ord"), field("name").alias("name"), field("scope_label").alias("label"))
    located = F.coalesce(field("source_item_id"), field("source_page"), field("source_section")).isNotNull()
    proof = below.where("child_kind = 'metric_evidence'").groupBy("record_id", F.col("parent_ord").alias("ord")).agg(F.count_if(located).alias("located"))
    asked = metric.join(proof, ["record_id", "ord"], "left")
    taken, offered = record_rows(records, names), table_rows(hints, names)

    def found(rows: DataFrame, code: str, severity: str) -> DataFrame:
        return rows.select(F.col("record_id").alias("record"), F.lit(code).alias("code"), F.lit(severity).alias("severity"))

    at = lambda p: F.get_json_object("record_json", f"$.extraction_provenance.{p}")
    owned = records.select("record_id", "bundle_id", F.get_json_object("record_json", "$.extraction_provenance").isNotNull().alias("has"), at("source_bundle_sha256").alias("mine"), at("unresolved_source_items").alias("open"), F.lower("record_json").alias("text"))
    expected = bundles.select("bundle_id", F.when(F.col("bundle_sha256").rlike("^[0-9a-f]{64}$"), F.col("bundle_sha256")).alias("expected"))
    hashed = owned.where("has").join(expected, "bundle_id").where("expected is not null")
    parts = [
        found(asked.where("located is null"), "QUANTITATIVE_METRIC_EVIDENCE_MISSING", "error"),
        found(asked.where("located = 0"), "QUANTITATIVE_METRIC_EVIDENCE_WEAK_LOCATOR", "warning"),
        found(metric.where(F.size(names.families(F.col("name"))) > 1), "COMPOSITE_CANONICAL_METRIC_RECORD", "error"),
        found(metric.where(F.col("label").rlike("[;|]")), "METRIC_SCOPE_LABEL_MULTIPLE_TARGETS", "error"),
        found(suggested_siblings(records, names), "METRIC_EVIDENCE_SUGGESTS_MISSING_SIBLING", "warning"),
        found(missing_siblings(offered, taken), "STRUCTURED_TABLE_METRIC_SIBLINGS_MISSING", "error"),
        found(missing_targets(offered, taken), "STRUCTURED_TABLE_TARGET_ROWS_MISSING", "error"),
        found(hashed.where("mine is null"), "SOURCE_BUNDLE_HASH_MISSING", "error"),
        found(hashed.where("mine <> expected"), "SOURCE_BUNDLE_HASH_MISMATCH", "error"),
        found(owned.where(F.col("open").rlike(r"^\[.*[^\s\[\]].*\]$")), "SOURCE_REPRESENTATION_INCOMPLETE", "warning"),
        found(owned.where(F.col("text").rlike(DEPRECATED_TERMS)), "DEPRECATED_INTERVAL_CALIBRATION_TERMINOLOGY", "error"),
    ]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def record_unknown_items(records: DataFrame, registry: DataFrame) -> DataFrame:
    """Items that a record's evidence names and its package's registry lacks (J2):
    ``(record_id, item)``; packages without a registry are not judged."""
    named = section_children(records).select("record_id", F.col("body")["source_item_id"].alias("item")).where("item is not null").distinct()
    known = registry.where("source_item_id is not null").select("bundle_id", F.col("source_item_id").alias("item")).distinct()
    owner = records.select("record_id", "bundle_id").distinct().join(known.select("bundle_id").distinct(), "bundle_id", "left_semi")
    return named.join(owner, "record_id").join(known, ["bundle_id", "item"], "left_anti").select("record_id", "item")
