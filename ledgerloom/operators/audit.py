"""Audits of a source package: table quality, caption matching, queues."""

from __future__ import annotations

from difflib import SequenceMatcher

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType

from ledgerloom.functions.numbers import box_iou

#: Share of blank leading cells that is suspect; points of risk at which a
#: table's recovery is required, recommended, reviewed.
LEADING_BLANK = 0.70
LEVELS = ((4, "required"), (2, "recommended"), (1, "review"))


def cell_metrics(judged: DataFrame) -> DataFrame:
    """How full the cells of each table are (F18): ``(table_id, rows, parsed, non_empty,
    leading_blank)``.

    ``judged`` has each record's cells, null where it couldn't be split.  Cells of blanks
    only are empty; the leading ones are the first two.  One row a table is shuffled by each
    task.  Tables without a parsed record have null ratios.
    """
    empty = lambda cells: F.size(F.filter(cells, lambda c: F.trim(c) == ""))
    lead = F.slice("cells", 1, 2)
    sums = judged.groupBy("table_id").agg(
        F.count(F.lit(1)).alias("rows"), F.count("cells").alias("parsed"), F.sum(F.when(F.col("cells").isNotNull(), F.size("cells"))).alias("n"),
        F.sum(empty(F.col("cells"))).alias("e"), F.sum(F.when(F.col("cells").isNotNull(), F.size(lead))).alias("ln"), F.sum(empty(lead)).alias("le"),
    )
    return sums.select("table_id", "rows", "parsed", ((F.col("n") - F.col("e")) / F.nullif("n", F.lit(0))).alias("non_empty"), (F.col("le") / F.nullif("ln", F.lit(0))).alias("leading_blank"))


def table_quality(tables: DataFrame) -> DataFrame:
    """Risk points, their reasons and the recovery status of tables.

    ``tables`` has rows, columns, non_empty and leading_blank (ratios or null), has_header
    and failed, whether nothing of a table could be read.
    """
    points = [
        (F.when(F.col("failed"), 5), "export_failed"),
        (F.when((F.col("rows") < 2) | (F.col("columns") < 2), 4), "too_small"),
        (F.when(F.col("non_empty") < 0.35, 3).when(F.col("non_empty") < 0.55, 1), "sparse"),
        (F.when((F.col("columns") >= 4) & (F.col("rows") >= 4) & ~F.col("has_header"), 1), "no_header"),
        (F.when((F.col("leading_blank") >= LEADING_BLANK) & (F.col("rows") >= 6), 2), "leading_blank"),
    ]
    risk = sum((F.coalesce(p, F.lit(0)) for p, _ in points), F.lit(0))
    reasons = F.filter(F.array(*[F.when(p.isNotNull(), r) for p, r in points]), lambda x: x.isNotNull())
    status = F.lit("not_needed")
    for least, name in reversed(LEVELS):
        status = F.when(F.col("risk_points") >= least, name).otherwise(status)
    return tables.withColumn("risk_points", risk).withColumn("reason_codes", F.array_join(reasons, ";")).withColumn("status", status)


def strongest(queue: DataFrame, keys: list[str], strength: dict[str, int], status: str, order: str) -> DataFrame:
    """The strongest entry of each key, the first of equals (D3)."""
    rank = F.coalesce(F.create_map(*[F.lit(x) for kv in strength.items() for x in kv])[F.col(status)], F.lit(0))
    rest = [c for c in queue.columns if c not in keys]
    best = F.min_by(F.struct(*rest), F.struct(-rank, F.col(order)))
    return queue.groupBy(*keys).agg(best.alias("_row")).select(*keys, "_row.*").select(*queue.columns)


def _plain(text: str) -> str:
    return " ".join("".join(c if c.isalnum() else " " for c in text.lower()).split())


def similarity(a: str | None, b: str | None) -> float:
    """Ratcliff-Obershelp ratio of two squeezed captions; null is like nothing."""
    if a is None or b is None:
        return 0.0
    return SequenceMatcher(None, _plain(a), _plain(b)).ratio()


@F.pandas_udf(DoubleType())
def caption_similarity(a: pd.Series, b: pd.Series) -> pd.Series:
    return pd.Series([similarity(x, y) for x, y in zip(a, b)])


def alike_pairs(boxes: DataFrame, least_iou: float = 0.45, least_similar: float = 0.92) -> DataFrame:
    """Pairs of boxes of a page that lie on one another or say the same.

    ``boxes`` has (doc_id, page, ord, l, r, t, b, text); a pair counts by its IoU or by the
    similarity of its texts, blank texts being like nothing.
    """
    a, b = boxes.alias("a"), boxes.alias("b")
    same = (F.col("a.doc_id") == F.col("b.doc_id")) & F.col("a.page").eqNullSafe(F.col("b.page")) & (F.col("a.ord") < F.col("b.ord"))
    box = lambda x: {k: F.col(f"{x}.{k}") for k in "lrtb"}
    said = F.when(F.trim("a.text") != "", F.col("a.text"))
    pairs = a.join(b, same).select(F.col("a.doc_id"), F.col("a.page"), F.col("a.ord").alias("a"), F.col("b.ord").alias("b"), F.coalesce(box_iou(box("a"), box("b")), F.lit(0.0)).alias("iou"), caption_similarity(said, F.col("b.text")).alias("similarity"))
    return pairs.where((F.col("iou") >= least_iou) | (F.col("similarity") >= least_similar))


def match_captions(captions: DataFrame, items: DataFrame) -> DataFrame:
    """One-to-one matches of captions to items of a document (J10), greedy in order.

    Captions (doc_id, caption_ord, number, page, caption) take, of the items (doc_id,
    item_id, number, page, caption) still free, the one of their number, of several the one
    on their page and most similar; else the only one on their page; else the most similar
    on their page (0.35 or more); else the most similar of all (0.82 or more).  Different
    explicit numbers never match, an unknown page is nobody's page.  If both sides have a
    ``kind``, only items of the caption's kind are its; if captions have a ``line_no``, it
    is part of their order and of the result.  Documents are co-grouped; a document is one
    package and fits a task.
    """
    keys = ["doc_id"] + [c for c in ("kind",) if c in captions.columns and c in items.columns]
    order = ["caption_ord"] + [c for c in ("line_no",) if c in captions.columns]
    kinds = dict(captions.dtypes)
    schema = ", ".join(["doc_id bigint", *[f"{c} {kinds[c]}" for c in order], "item_id string", "score double", "reason string"])

    def assign(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        if left.empty or right.empty:
            return pd.DataFrame(columns=["doc_id", *order, "item_id", "score", "reason"])
        known = lambda v: None if pd.isna(v) else v
        rows = right.sort_values("item_id").to_dict("records")
        plain = [None if pd.isna(i["caption"]) else _plain(i["caption"]) for i in rows]
        free = dict.fromkeys(range(len(rows)))
        unnumbered = dict.fromkeys(k for k, i in enumerate(rows) if pd.isna(i["number"]))
        by_number: dict = {}
        by_page: dict = {}
        for k, i in enumerate(rows):
            by_number.setdefault(known(i["number"]), []).append(k)
            by_page.setdefault(known(i["page"]), []).append(k)

        def best(caption: str | None, among: list[int], least: float) -> tuple[float, int] | None:
            found = None
            for k in among if caption is not None else ():
                if plain[k] is None:
                    continue
                m = SequenceMatcher(None, caption, plain[k])
                # both are bounds from above, and cheap
                if min(m.real_quick_ratio(), m.quick_ratio()) >= (found[0] if found else least):
                    r = m.ratio()
                    if r >= least and (found is None or r > found[0]):
                        found = r, k
            return found

        out = []
        for c in left.sort_values(order).to_dict("records"):
            number, page = known(c["number"]), known(c["page"])
            text = None if pd.isna(c["caption"]) else _plain(c["caption"])
            exact = [k for k in by_number.get(number, ()) if k in free] if number is not None else []
            able = free if number is None else unnumbered
            near = [k for k in by_page.get(page, ()) if k in able] if page is not None else []
            if exact:
                here = [k for k in exact if page is not None and known(rows[k]["page"]) == page] or exact
                pick = here[0] if len(here) == 1 else (best(text, here, 0.0) or (0.0, here[0]))[1], 1.0, "number"
            elif len(near) == 1:
                pick = near[0], 0.9, "only_on_page"
            else:
                found = best(text, near, 0.35) or best(text, list(able), 0.82)
                if found is None:
                    continue
                pick = found[1], found[0], "similar"
            out.append((c["doc_id"], *[c[o] for o in order], rows[pick[0]]["item_id"], pick[1], pick[2]))
            free.pop(pick[0])
            unnumbered.pop(pick[0], None)
        return pd.DataFrame(out, columns=["doc_id", *order, "item_id", "score", "reason"])

    return captions.groupBy(*keys).cogroup(items.groupBy(*keys)).applyInPandas(assign, schema)


#: Order of priorities in a queue.
PRIORITY_RANK = {"high": 0, "medium": 1, "low": 2}
STRENGTH = {"required": 3, "recommended": 2, "review": 1}


def recovery_queue(registry: DataFrame) -> DataFrame:
    """What of a registry asks for recovery (J14): one producer each for items without a
    caption, page or section, united and reduced to the strongest entry of an item (D3)."""
    entry = lambda when, status, priority, reason: F.when(when, F.struct(F.lit(status).alias("status"), F.lit(priority).alias("priority"), F.lit(reason).alias("reason")))
    table_ = F.col("item_type") == "table"
    entries = F.array(
        entry(table_ & F.col("caption").isNull(), "required", "high", "table_without_caption"),
        entry(~table_ & F.col("caption").isNull(), "recommended", "medium", "item_without_caption"),
        entry(F.col("source_page").isNull(), "review", "medium", "page_unknown"),
        entry(F.col("section_hint").isNull(), "review", "low", "section_unknown"),
    )
    asked = registry.select("bundle_id", "source_item_id", "item_type", F.posexplode(F.filter(entries, lambda e: e.isNotNull())).alias("ord", "e")).select("bundle_id", "source_item_id", "item_type", "ord", "e.*")
    return strongest(asked, ["bundle_id", "source_item_id"], STRENGTH, "status", "ord").drop("ord")


def selected_items(queue: DataFrame, ids: list[str] | None = None, statuses: list[str] | None = None, priorities: list[str] | None = None, types: list[str] | None = None) -> DataFrame:
    """Queue items to recover (F1): named ids go past every other filter."""
    if ids:
        return queue.where(F.col("source_item_id").isin(*ids))
    for column, wanted in (("status", statuses), ("priority", priorities), ("item_type", types)):
        if wanted:
            queue = queue.where(F.col(column).isin(*wanted))
    return queue


def in_queue_order(queue: DataFrame) -> DataFrame:
    """A queue by priority, type and id."""
    rank = F.create_map(*[F.lit(x) for kv in PRIORITY_RANK.items() for x in kv])[F.col("priority")]
    return queue.orderBy(rank, "item_type", "bundle_id", "source_item_id")
