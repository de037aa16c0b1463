"""Metrics that a free-typed name mentions, by the reference list of metrics.

An entry is mentioned if the words of its short or full name stand in the name, one after
another.  A mention inside a longer one doesn't count: ``root mean squared error`` is none
where ``unbiased root mean squared error`` stands.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerloom.functions.text import squeezed, tokens
from ledgerloom.session import small_rows


def phrase(text: Column) -> Column:
    """The words of a text parted and framed by single spaces; null counts as empty."""
    return F.concat(F.lit(" "), F.array_join(tokens(F.coalesce(text, F.lit(""))), " "), F.lit(" "))


def bound(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use(value)`` with the value evaluated once, not for each step of a lambda."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


@dataclass(frozen=True)
class Names:
    """The reference list: ``(framed phrase, metric key)`` of each short and full name."""

    aliases: tuple[tuple[str, str], ...]

    @classmethod
    def of(cls, reference: DataFrame, most: int = 5000) -> Names:
        """Read the list, refused beyond a stated size."""
        names = reference.where("metric_key is not null").select("metric_key", F.explode(F.array("short_name", "full_name")).alias("name"))
        rows = small_rows(names.where("name is not null").select(phrase(F.col("name")).alias("phrase"), "metric_key").where("trim(phrase) <> ''").distinct(), 2 * most, "the list of metrics")
        return cls(tuple(sorted((r["phrase"], r["metric_key"]) for r in rows)))

    def _listed(self) -> Column:
        if not self.aliases:
            return F.array().cast("array<struct<p:string,k:string>>")
        return F.array(*[F.struct(F.lit(p).alias("p"), F.lit(k).alias("k")) for p, k in self.aliases])

    def families(self, name: Column) -> Column:
        """Keys of all entries a name mentions, in alphabetical order."""

        def widest(found: Column) -> Column:
            return F.filter(found, lambda a: ~F.exists(found, lambda b: (a["p"] != b["p"]) & b["p"].contains(a["p"])))

        found = bound(phrase(name), lambda framed: F.filter(self._listed(), lambda a: framed.contains(a["p"])))
        return F.array_sort(F.array_distinct(F.transform(bound(found, widest), lambda a: a["k"])))

    def family(self, name: Column) -> Column:
        """The first of them, or null."""
        return F.get(self.families(name), F.lit(0))

    def identity(self, name: Column) -> Column:
        """The first entry, else the squeezed name, with marks that change the statistic."""
        text = squeezed(F.coalesce(name, F.lit("")))
        marks = [F.when(text.rlike(rf"\b{w}\b"), f"+{w}").otherwise("") for w in ("range", "maximum", "minimum")]
        return F.concat(F.coalesce(self.family(name), text), *marks)

    def named(self, text: Column) -> Column:
        """Whether a text mentions any entry."""
        return bound(phrase(text), lambda framed: F.exists(self._listed(), lambda a: framed.contains(a["p"])))
