"""Small decisions and scalar rules: statuses, priorities, scores, phrases.

Every function takes and gives columns; a null input is named where it matters.
"""

from __future__ import annotations

import json
from collections.abc import Sequence

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import StringType


def ocr_decision(mode: Column, likely_scanned: Column) -> Column:
    """Whether to run character recognition (F4); automatic and unknown means yes."""
    return F.when(mode == "always", True).when(mode == "never", False).otherwise(F.coalesce(likely_scanned, F.lit(True)))


def overall_status(required: Column, recommended: Column, review: Column) -> Column:
    """A package's status from its queue counts."""
    return F.when(required > 0, "recovery_required").when(recommended + review > 0, "review").otherwise("pass")


def effective_status(initial: Column, unresolved: Column, recoverable: Column) -> Column:
    """The status after recovery (F3): what is unresolved keeps the initial one."""
    return F.when(unresolved > 0, initial).when(recoverable > 0, "pass_after_recovery").otherwise(initial)


def keyword_tier(text: Column, tiers: Sequence[tuple[str, Sequence[str]]], default: str) -> Column:
    """The first tier one of whose words the text holds (F19, F20); null gets the default."""
    out = F.lit(default)
    for name, words in reversed(list(tiers)):
        out = F.when(F.lower(text).rlike("|".join(words)), name).otherwise(out)
    return out


def candidate_target(text: Column) -> Column:
    """A target without its counts in brackets, squeezed and in lower case."""
    return F.lower(F.trim(F.regexp_replace(F.regexp_replace(text, r"\(\s*n?\s*=?\s*[0-9]+\s*\)", " "), r"\s+", " ")))


def numeric_tokens(text: Column) -> Column:
    """All numbers with a point as decimal mark."""
    return F.transform(F.regexp_extract_all(text, F.lit(r"[0-9]+(?:[.,][0-9]+)?"), F.lit(0)), lambda t: F.translate(t, ",", "."))


def parameter_phrase(text: Column, nouns: Sequence[str]) -> Column:
    """Up to five words that end in the noun of a parameter (X21), or null."""
    return F.nullif(F.regexp_extract(F.lower(text), rf"((?:[a-z]+[ -]){{1,4}}(?:{'|'.join(nouns)}))\b", 1), F.lit(""))


def coerced_shape(kind: Column, value: Column, low: Column, high: Column) -> Column:
    """A number's kind that fits its parts (N7): a lone bound goes, a range needs both.

    Gives (kind, value, low, high, error); descending bounds are an error, not a range.
    """
    both = low.isNotNull() & high.isNotNull()
    lower, upper = F.when(both, low), F.when(both, high)
    fit = F.when(both & value.isNotNull(), "estimate_with_range").when(both, "range").when(value.isNotNull(), F.when(kind == "estimate_with_uncertainty", kind).otherwise("scalar")).otherwise("text_summary")
    return F.struct(fit.alias("kind"), value.alias("value"), lower.alias("low"), upper.alias("high"), F.when(both & (low > high), "descending_range").alias("error"))


def horizontal_overlap(a_left: Column, a_right: Column, b_left: Column, b_right: Column) -> Column:
    """Shared width over the narrower width (N8); boxes without width share nothing."""
    shared = F.greatest(F.least(a_right, b_right) - F.greatest(a_left, b_left), F.lit(0.0))
    narrow = F.least(a_right - a_left, b_right - b_left)
    return F.when(narrow > 0, shared / narrow).otherwise(0.0)


def figure_score(f: dict[str, Column]) -> Column:
    """How well a figure fits a caption (J11): additive points, null where impossible.

    ``f`` has same_page, numbers_conflict, same_number, width, height, area_ratio,
    distance, overlap, above, similarity.
    """
    size = F.when((f["width"] >= 180) & (f["height"] >= 80), 2.0).otherwise(-4.0)
    area = F.when(f["area_ratio"] >= 0.025, 3.0).when(f["area_ratio"] >= 0.008, 1.0).otherwise(-3.0)
    near = F.when(f["distance"] <= 220, 2.0).when(f["distance"] > 550, -1.5).otherwise(0.0)
    extra = [(f["same_number"], 2.0), (f["overlap"] >= 0.35, 1.5), (f["above"], 0.5), (f["similarity"] >= 0.8, 1.0)]
    points = size + area + near
    for condition, worth in extra:
        points = points + F.when(F.coalesce(condition, F.lit(False)), worth).otherwise(0.0)
    return F.when(f["same_page"] & ~F.coalesce(f["numbers_conflict"], F.lit(False)), points)


def ragged_row(cells: Column, width: Column) -> Column:
    """A row with exactly ``width`` cells (M15): short rows padded, the tail of long ones
    joined into the last cell."""
    head = F.slice(cells, F.lit(1), F.greatest(width - 1, F.lit(0)))
    tail = F.array_join(F.slice(cells, F.greatest(width, F.lit(1)), F.greatest(F.size(cells), F.lit(1))), " ")
    padded = F.concat(cells, F.array_repeat(F.lit(""), F.greatest(width - F.size(cells), F.lit(0))))
    return F.when(F.size(cells) > width, F.concat(head, F.array(tail))).otherwise(padded)


def appended_once(items: Column, text: Column) -> Column:
    """A list with a text appended unless it holds it (M2); a null list is empty."""
    have = F.coalesce(items, F.array().cast("array<string>"))
    return F.when(F.array_contains(have, text), have).otherwise(F.array_append(have, text))


def without(items: Column, unwanted: Column) -> Column:
    """A list without some entries (M5); a list that gets empty is null."""
    kept = F.array_except(items, unwanted)
    return F.when(F.size(kept) > 0, kept)


def first_json(text: str | None) -> str | None:
    """The first balanced JSON object in a reply, fences and chatter around it ignored."""
    if not text:
        return None
    at = text.find("{")
    while at >= 0:
        try:
            found, _ = json.JSONDecoder().raw_decode(text, at)
            return json.dumps(found, ensure_ascii=False, sort_keys=True)
        except ValueError:
            at = text.find("{", at + 1)
    return None


@F.pandas_udf(StringType())
def first_json_object(replies: pd.Series) -> pd.Series:
    """Column form of ``first_json``."""
    return replies.map(first_json, na_action="ignore")
