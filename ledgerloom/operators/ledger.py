"""Operators on the metric ledger and its evidence: joins, consensus, views, folds."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ledgerloom.functions.metrics import Names
from ledgerloom.functions.numbers import number_key, with_quantity
from ledgerloom.functions.text import section_anchor, squeezed, token_key, tokens

#: Contexts whose metrics make up the producer's fitness view.
PRODUCER_CONTEXTS = ("out_of_sample_validation", "cross_validated_interval", "spatial_uncertainty_summary")
DOWNSTREAM_CONTEXT = "downstream_use_case"


def first_wins(df: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """The first row of each key in a stated order (D4, W5); null keys are keys.

    A partial aggregate keeps one row a key and task, so a hot key shuffles as few rows.
    """
    rest = [c for c in df.columns if c not in keys]
    best = F.min_by(F.struct(*rest), F.struct(*order))
    return df.groupBy(*keys).agg(best.alias("_row")).select(*keys, "_row.*").select(*df.columns)


def top_per_key(df: DataFrame, keys: list[str], order: list, most: int) -> DataFrame:
    """At most so many rows of each key (T4), never of all together."""
    return df.withColumn("_rank", F.row_number().over(W.partitionBy(*keys).orderBy(*order))).where(F.col("_rank") <= most).withColumnRenamed("_rank", "rank")


def unique_registry(registry: DataFrame) -> DataFrame:
    """One row an item: repeats are equal, gaps are filled from them."""
    fields = ["item_type", "source_page", "source_location", "section_hint", "caption"]
    return registry.groupBy("bundle_id", "source_item_id").agg(*[F.max(c).alias(c) for c in fields])


def with_locators(evidence: DataFrame, registry: DataFrame) -> DataFrame:
    """Evidence with page, location and section from its authored item.

    The authored value wins where the registry has one.  Evidence without an item or with
    an unknown one keeps its own; ``known_item`` says which.
    """
    items = unique_registry(registry).select("bundle_id", "source_item_id", *[F.col(c).alias(f"_{c}") for c in ("source_page", "source_location", "section_hint", "item_type")])
    joined = evidence.join(items, ["bundle_id", "source_item_id"], "left")
    return joined.select(
        *[c for c in evidence.columns if c not in ("source_page", "source_location", "source_section")],
        F.coalesce("_source_page", "source_page").alias("source_page"),
        F.coalesce("_source_location", "source_location").alias("source_location"),
        F.coalesce("_section_hint", "source_section").alias("source_section"),
        F.col("_item_type").isNotNull().alias("known_item"),
    )


def unknown_items(evidence: DataFrame, registry: DataFrame) -> DataFrame:
    """Evidence that names an item its bundle's registry lacks (J2); bundles without any
    registry are not judged."""
    judged = evidence.where("source_item_id is not null").join(registry.select("bundle_id").distinct(), "bundle_id", "left_semi")
    return judged.join(registry.select("bundle_id", "source_item_id").distinct(), ["bundle_id", "source_item_id"], "left_anti")


def consensus(df: DataFrame, keys: list[str], value: str, order: str, normal: Column | None = None) -> DataFrame:
    """The value a key agrees on, else null (A3): exactly one distinct non-null value, in
    the writing of the first row."""
    norm = normal if normal is not None else F.col(value)
    agreed = F.when(F.countDistinct(norm) == 1, F.min_by(value, F.when(F.col(value).isNotNull(), F.col(order))))
    return df.groupBy(*keys).agg(agreed.alias(value), F.count(value).alias("votes"))


def mode_per_key(df: DataFrame, keys: list[str], value: str) -> DataFrame:
    """The most frequent non-null value (A4); of equals the least, so that it is stated."""
    counted = df.where(F.col(value).isNotNull()).groupBy(*keys, value).agg(F.count(F.lit(1)).alias("votes"))
    best = F.min(F.struct((-F.col("votes")).alias("n"), F.col(value).alias("v")))
    return counted.groupBy(*keys).agg(best.alias("b")).select(*keys, F.col("b.v").alias(value), (-F.col("b.n")).alias("votes"))


def fitness_views(ledger: DataFrame) -> DataFrame:
    """The two use-oriented views of the ledger (A14): rebuilt from it, never edited."""
    view = F.when(F.col("context").isin(*PRODUCER_CONTEXTS), "producer").when(F.col("context") == DOWNSTREAM_CONTEXT, "downstream")
    return ledger.withColumn("view", view).where("view is not null")


def outer_merge(initial: DataFrame, repair: DataFrame, keys: list[str], fields: list[str]) -> DataFrame:
    """Two ledgers as one (J15): the repair's fields win, rows of either side are kept.

    Both sides hold one row a key (see ``first_wins``).  ``origin`` is repair, both or
    initial.
    """
    a = initial.select(*keys, *[F.col(c).alias(f"_a_{c}") for c in fields], F.lit(True).alias("_a"))
    b = repair.select(*keys, *[F.col(c).alias(f"_b_{c}") for c in fields], F.lit(True).alias("_b"))
    both = a.join(b, keys, "full")
    origin = F.when(F.col("_a").isNull(), "repair").when(F.col("_b").isNull(), "initial").otherwise("both")
    return both.select(*keys, *[F.coalesce(f"_b_{c}", f"_a_{c}").alias(c) for c in fields], origin.alias("origin"))


def ledger_identity(df: DataFrame, name: str, target: str, names: Names) -> DataFrame:
    """Add the parts of a ledger row's identity: metric identity and target tokens."""
    return df.withColumn("identity", names.identity(F.col(name))).withColumn("target_key", token_key(F.col(target)))


def subset_targets(targets: DataFrame, keys: list[str], token_col: str, id_col: str) -> DataFrame:
    """Pairs (parent, child) of targets where the parent's words are a proper subset of the
    child's (J18), within a key.

    Words are exploded and joined on equality with their key, and a pair counts if all of
    the parent's words met; repeated targets should be made distinct before.
    """
    # a parent is looked up by one of its words only, the least frequent of its key
    words = targets.select(*keys, id_col, token_col, F.explode(token_col).alias("word"))
    df = words.groupBy(*keys, "word").agg(F.count(F.lit(1)).alias("df"))
    rare = words.join(df, [*keys, "word"]).groupBy(*keys, id_col).agg(F.min(F.struct("df", "word")).alias("r"), F.first(token_col).alias("parent_words"))
    parents = rare.select(*keys, F.col(id_col).alias("parent"), "parent_words", F.col("r.word").alias("word"))
    children = words.select(*keys, F.col(id_col).alias("child"), F.col(token_col).alias("child_words"), "word")
    pairs = parents.join(children, [*keys, "word"])
    proper = (F.size("parent_words") < F.size("child_words")) & (F.size(F.array_except("parent_words", "child_words")) == 0)
    return pairs.where(proper).select(*keys, "parent", "child")


_FOLD = "bundle_id bigint, identity string, metric_id bigint, primary_id bigint, display string, aggregation string, nominal_level double, unit string, unit_code string, population string, interpretation string, members int"
#: Words that say nothing about a metric's target.
TARGET_STOP_WORDS = ("the", "a", "an", "of", "for", "in", "on", "at", "to")
#: What a stated field adds to a record's richness.
RICHNESS = {"aggregation": 5, "nominal_level": 4, "unit": 1, "unit_code": 2, "population": 2, "interpretation": 2}


def value_key(display: Column, quantity: Column) -> Column:
    """Kind, numbers and unit of a structured quantity, else the squeezed display."""
    numbers_ = [F.coalesce(number_key(quantity[k]), F.lit("")) for k in ("numeric_value", "lower_bound", "upper_bound", "uncertainty")]
    structured = F.concat_ws(";", quantity["kind"], *numbers_, F.coalesce(quantity["unit_code"], F.lit("")))
    return F.when(quantity["kind"] != "text_summary", structured).otherwise(squeezed(F.coalesce(display, F.lit(""))))


def deduplicate_metrics(metrics: DataFrame, names: Names) -> DataFrame:
    """Merge repeated metrics of one identity in their order.

    ``metrics`` has (bundle_id, metric_id, name, display, aggregation, unit,
    interpretation) and may have (context, scope, target, support), which are then parts of
    the identity, and population.  Rows of one identity and value are visited by
    ``metric_id``; each joins the first survivor it doesn't contradict: two stated
    aggregations must agree, and so must two nominal levels.  The richer of the two is the primary record, ``primary_id``,
    and takes the fields it lacks from the other, so that later rows see what it has
    become; ``metric_id`` is the survivor's first sighting.  The relation isn't transitive,
    hence the fold; a group is one metric's sightings in one bundle.  Null displays are one
    display.
    """
    none = F.lit(None).cast("string")
    has = lambda c: F.col(c) if c in metrics.columns else none
    words = F.filter(tokens(F.coalesce(has("target"), F.lit(""))), lambda t: ~t.isin(*TARGET_STOP_WORDS))
    parts = [names.identity(F.col("name")), *[F.coalesce(has(c), F.lit("")) for c in ("context", "scope", "support")], F.array_join(F.array_sort(words), " ")]
    keyed = with_quantity(metrics, "display", "_q").withColumns({"identity": F.concat_ws("|", *parts, F.coalesce(value_key(F.col("display"), F.col("_q")), F.lit(""))), "population": has("population"), "nominal_level": F.col("_q.nominal_level"), "unit_code": F.col("_q.unit_code")}).drop("_q")
    stated = ["display", *RICHNESS]

    def richness(row: dict) -> int:
        return min(len((row["display"] or "").strip()), 40) + sum(n for k, n in RICHNESS.items() if row[k])

    def fold(pdf: pd.DataFrame) -> pd.DataFrame:
        survivors: list[dict] = []
        for row in pdf.sort_values("metric_id").to_dict("records"):
            row = {k: (None if pd.isna(v) else v) for k, v in row.items()}
            home = next((s for s in survivors if all(s[k] is None or row[k] is None or s[k] == row[k] for k in ("aggregation", "nominal_level"))), None)
            if home is None:
                survivors.append(row | {"primary_id": row["metric_id"], "members": 1})
                continue
            richer = richness(row) > richness(home)
            first, second = (row, home) if richer else (home, row)
            home.update({k: first[k] or second[k] for k in stated}, members=home["members"] + 1)
            if richer:
                home["primary_id"] = row["metric_id"]
        return pd.DataFrame(survivors, columns=["bundle_id", "identity", "metric_id", "primary_id", *stated, "members"])

    # rows that repeat in every field that matters are one row first: a hot group shrinks
    # to its different rows before it is folded
    fields = ["bundle_id", "identity", *stated]
    distinct = keyed.groupBy(*fields).agg(F.min("metric_id").alias("metric_id"), F.count(F.lit(1)).alias("n"))
    groups = distinct.groupBy("bundle_id", "identity").agg(F.sum("n").alias("rows"), F.collect_list(F.struct("metric_id", *stated)).alias("seen"))
    out = ["bundle_id", "identity", "metric_id", "primary_id", *stated, "members"]
    # most groups are one row, which is its own survivor
    alone = groups.where(F.size("seen") == 1).select("bundle_id", "identity", "rows", F.inline("seen")).withColumns({"primary_id": F.col("metric_id"), "members": F.lit(1)})
    several = groups.where(F.size("seen") > 1)
    folded = several.select("bundle_id", "identity", F.inline("seen")).groupBy("bundle_id", "identity").applyInPandas(fold, _FOLD)
    merged = folded.join(several.select("bundle_id", "identity", "rows"), ["bundle_id", "identity"])
    return alone.select(*out, "rows").unionByName(merged.select(*out, "rows"))


def related_pairs(sections: DataFrame, keys: list[str], section: str) -> DataFrame:
    """Pairs ``(keys, a, b)`` with a < b of sections of one key that stand in one another
    (J6, N9): equal anchors, or one dotted number a prefix of the other.

    Each section is looked up by its anchor under its own anchor and the numbers above it,
    so no key's sections meet all others.
    """
    anchor = section_anchor(F.col(section))
    parts = F.split("anchor", r"\.")
    above = F.transform(F.sequence(F.lit(1), F.size(parts)), lambda n: F.array_join(F.slice(parts, F.lit(1), n), "."))
    own = sections.select(*keys, F.col(section).alias("s"), anchor.alias("anchor")).distinct()
    under = own.select(*keys, "s", F.explode(F.when(F.col("anchor").rlike("^[0-9]"), above).otherwise(F.array("anchor"))).alias("anchor"))
    pairs = under.join(own.withColumnRenamed("s", "t"), [*keys, "anchor"]).where("s <> t")
    return pairs.select(*keys, F.least("s", "t").alias("a"), F.greatest("s", "t").alias("b")).distinct()


def token_overlap_pairs(df: DataFrame, keys: list[str], id_col: str, token_col: str, least: float) -> DataFrame:
    """Pairs of rows of one key whose token sets have a Jaccard of at least ``least``.

    ``(keys, a, b, jaccard)`` with a < b.  Prefix filtering: a pair that similar shares one
    of each side's rarest tokens, so only those are joined; equal token sets should be made
    one row before.
    """
    words = df.select(*keys, id_col, token_col, F.explode(token_col).alias("word"))
    freq = words.groupBy("word").agg(F.count(F.lit(1)).alias("df"))
    ranked = words.join(freq, "word").withColumn("_r", F.row_number().over(W.partitionBy(*keys, id_col).orderBy("df", "word")))
    prefix = ranked.where(F.col("_r") <= F.size(token_col) - F.ceil(F.size(token_col) * F.lit(least)) + 1)
    a = prefix.select(*keys, "word", F.col(id_col).alias("a"), F.col(token_col).alias("ta"))
    b = prefix.select(*keys, "word", F.col(id_col).alias("b"), F.col(token_col).alias("tb"))
    near = F.size("ta").between(F.size("tb") * F.lit(least), F.size("tb") / F.lit(least))
    pairs = a.join(b, [*keys, "word"]).where((F.col("a") < F.col("b")) & near)
    score = F.size(F.array_intersect("ta", "tb")) / F.size(F.array_union("ta", "tb"))
    scored = pairs.withColumn("jaccard", score).where(F.col("jaccard") >= least)
    return scored.groupBy(*keys, "a", "b").agg(F.max("jaccard").alias("jaccard"))


def filled_by_consensus(df: DataFrame, keys: list[str], field: str, id_col: str) -> DataFrame:
    """Gaps of a field filled where its key agrees on one value (M13); ``filled`` says so.

    The consensus is one row a key, joined back; stated values are never changed.
    """
    agreed = df.where(F.col(field).isNotNull()).groupBy(*keys).agg(F.countDistinct(field).alias("_n"), F.min(field).alias("_v")).where("_n = 1").drop("_n")
    joined = df.join(agreed, keys, "left")
    return joined.select(id_col, F.coalesce(F.col(field), F.col("_v")).alias(field), (F.col(field).isNull() & F.col("_v").isNotNull()).alias("filled"))


def unrepresented(hints: DataFrame, rows: DataFrame, keys: list[str]) -> DataFrame:
    """Hints that no row of their key with a shared target token and the same identity
    represents (J5).

    Both sides have the keys, ``identity`` and ``words`` (the target's tokens); tokens are
    exploded and joined on equality.  A hint without tokens is compared by identity alone.
    """
    words = lambda df: F.explode(F.when(F.size("words") > 0, F.col("words")).otherwise(F.array(F.lit(""))))
    there = rows.select(*keys, "identity", words(rows).alias("word")).unionByName(rows.select(*keys, "identity", F.lit("").alias("word"))).distinct()
    mine = hints.select(*keys, "hint_id", "identity", words(hints).alias("word"))
    met = mine.join(there, [*keys, "identity", "word"], "left_semi").select("hint_id").distinct()
    return hints.join(met, "hint_id", "left_anti")
