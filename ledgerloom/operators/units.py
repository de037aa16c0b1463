"""Quantities recorded in different units, brought to the common unit of their dimension.

Sources are the spellings of units, entities the metrics of a variable, which many sources
record.  Every spelling that is a catalogue code anchors the graph of sources.  In each
round the settled sources, in the common unit, give every entity a robust centre (a median
of decimal logarithms; of plain values for levels, which a conversion may also shift), and
every other source is paired with the centres of the entities it shares:

* its *scale* is the median gap of logarithms, with the spread of the gaps for its error,
* its *offset*, where the dimension's conversions have any, is what is left of the gap of
  levels under each conversion,
* both are snapped to the known conversions; a source is settled if exactly one fits.

Settled sources join the centres of the next round, so conversions propagate through the
graph until nothing more is settled.  What the values leave open (too few links, or several
conversions that fit) is left to the spelling's own words, read with a small grammar of
unit names; a unique snap of enough links overrules the name.

Which unit a row has: the one named in the value; failing that in the unit field; failing
that in the label, excerpt or interpretation; failing that in the caption, which speaks
only for metrics in the unit of their variable.

Defined results: rows without a number or without any unit are no cases and keep their
number as recorded; null fields name nothing; a number beyond a double is null.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from ledgerloom.functions.names import NameResolver
from ledgerloom.session import cut, small_rows, spread

# What one of a unit is in the common unit of its dimension, and the common
# unit's value at the unit's zero.
CONVERSIONS = {
    "d": (1.0, 0.0), "h": (1 / 24, 0.0), "wk": (7.0, 0.0), "min": (1 / 1440, 0.0),
    "mm": (1.0, 0.0), "cm": (10.0, 0.0), "m": (1000.0, 0.0), "in": (25.4, 0.0),
    "t/ha": (1.0, 0.0), "kg/ha": (0.001, 0.0), "dt/ha": (0.1, 0.0), "g/m2": (0.01, 0.0),
    "Cel": (1.0, 0.0), "K": (1.0, -273.15), "degF": (5 / 9, -160 / 9),
    "1": (1.0, 0.0), "%": (0.01, 0.0), "ppth": (0.001, 0.0),
    "ha": (1.0, 0.0), "km2": (100.0, 0.0), "m2": (0.0001, 0.0), "acre": (0.40468564224, 0.0),
    "g/kg": (1.0, 0.0), "mg/kg": (0.001, 0.0),
    "MJ/m2": (1.0, 0.0), "kWh/m2": (3.6, 0.0), "J/cm2": (0.01, 0.0),
    "m/s": (1.0, 0.0), "km/h": (1 / 3.6, 0.0), "kn": (1852 / 3600, 0.0),
}

# Names of plain units, and the prefixes that go with the names.
_BASE = {"metre": "m", "meter": "m", "gram": "g", "tonne": "t", "joule": "J", "hectare": "ha"}
_PREFIX = {"": "", "kilo": "k", "milli": "m", "centi": "c", "deci": "d", "mega": "M"}
_PLAIN = {
    "day": "d", "hour": "h", "hr": "h", "minute": "min", "week": "wk", "second": "s", "sec": "s", "inch": "in", "inche": "in", "acre": "acre", "ac": "acre", "knot": "kn", "kt": "kn",
    "kelvin": "K", "celsius": "Cel", "centigrade": "Cel", "fahrenheit": "degF", "percent": "%", "pct": "%", "permille": "ppth", "hectopascal": "hPa",
}
_WHOLE = {
    "%": "%", "‰": "ppth", "per cent": "%", "per mille": "ppth", "per mil": "ppth", "°c": "Cel", "deg c": "Cel", "degrees c": "Cel", "degrees celsius": "Cel", "degree celsius": "Cel",
    "°f": "degF", "deg f": "degF", "degrees f": "degF", "degrees fahrenheit": "degF", "degree fahrenheit": "degF", "kph": "km/h", "kmh": "km/h", "mph": "mi/h", "in.": "in", '"': "in",
}
_SYMBOLS = {s.lower(): s for s in ("d", "h", "wk", "min", "s", "mm", "cm", "m", "km", "in", "t", "kg", "g", "mg", "dt", "ha", "K", "MJ", "J", "kWh", "kn")}


def spelling(text: Column) -> Column:
    """A unit's spelling with plain exponents and single spaces."""
    return F.trim(F.regexp_replace(F.translate(text, "²³⁻¹−", "23-1-"), r"(?U)\s+", " "))


def read_unit(text: str) -> str | None:
    """The unit a spelling names, as a code with divisors after a slash, or None."""
    low = text.lower().strip()
    if low in _WHOLE:
        return _WHOLE[low]
    if low.rstrip(".") in _WHOLE:
        return _WHOLE[low.rstrip(".")]
    low = re.sub(r"\bsq(?:uare|\.)?\s+([a-z]+)", r"\g<1>2", low.rstrip("."))
    powers: dict[str, int] = {}
    sign = 1
    for part in re.findall(r"/|[^\s/·*]+", low):
        if part in ("/", "per"):
            sign = -1
            continue
        m = re.fullmatch(r"([a-zµ%°]+)\^?(-?\d)?", part)
        if not m:
            return None
        unit = _unit_word(m[1])
        if unit is None:
            return None
        power = int(m[2] or 1) * sign
        powers[unit] = powers.get(unit, 0) + power
    up = [u + (str(p) if p > 1 else "") for u, p in powers.items() if p > 0]
    down = [u + (str(-p) if p < -1 else "") for u, p in powers.items() if p < 0]
    return "/".join([".".join(up), *down]) if up else None


def _unit_word(word: str) -> str | None:
    for w in (word, word[:-1] if word.endswith("s") and len(word) > 2 else word):
        if w in _SYMBOLS:
            return _SYMBOLS[w]
        if w in _PLAIN:
            return _PLAIN[w]
        for prefix, p in _PREFIX.items():
            if w.startswith(prefix) and w[len(prefix) :] in _BASE:
                return p + _BASE[w[len(prefix) :]]
    return None


# --- where a row names its unit -------------------------------------------------------

NUMBER = r"(?<![\p{L}\d.,])(?<!\p{L}[-⁻])[-+−]?(?:\d{1,3}(?:,\d{3})+|\d+)?(?:\.\d+|(?<=\d))(?:[eE][-+]?\d+)?"
_NOISE = r"(?i)\b(?:to|and|median|mean|range|from|between|about|approx|ca|up|est|estimate|sd|se|ci|n)\b\.?|[()\[\]±–—;:,~<>≤≥=]|(?<=\s)[-−](?=\s)"


def named_in_value(value: Column) -> Column:
    """What stands beside the numbers of a value."""
    rest = F.regexp_replace(F.regexp_replace(value, NUMBER, " "), _NOISE, " ")
    return spelling(F.regexp_replace(rest, r"^[\s.\-−]+|[\s\-−]+$", ""))


def named_in_label(label: Column) -> Column:
    """A unit in brackets, after a comma or after ``in`` at a label's end; an ordinal in
    round brackets after that is no part of it."""
    bare = F.regexp_replace(label, r"(?:\s*\(\d+\))+\s*$", "")
    return spelling(F.regexp_extract(bare, r"(?:\[|\(|, | in )([^\[\](),]+?)[\])]?\s*$", 1))


#: The word is the unit, not a preposition, where no object can follow it.
_INCH = r"in(?=\.|\s*(?:[(;,]|$)|\s+(?:was|were|is|are|for|in|on|at(?!\s+(?:least|most)\b))\s)"
_AFTER = rf"^\s*+(?!(?:was|were|is|are|for|at|on)\b|(?!{_INCH})in\b)([^\s(;,.].*?)(?=\s+(?:was|were|is|are|for|in|at|on)\b|\s*[(;,]|\.?\s*$)"


def named_in_excerpt(excerpt: Column, value: Column) -> Column:
    """What follows each occurrence of the value in its sentence, or of the value's first
    number if the unit stands between that and its bounds; an array in their order.

    An occurrence within another number or word is none.
    """
    head = F.substring_index(value, " (", 1)
    told = F.when(excerpt.contains(value), value).when(excerpt.contains(head), head)
    pieces = F.split(F.when(F.length(told) > 0, F.replace(excerpt, told, F.lit("\x01"))), "\x01")

    def after(piece: Column, k: Column) -> Column:
        apart = (k > 0) & ~F.get(pieces, k - 1).rlike(r"[\p{L}\d]$|\d[.,]$")
        rest = F.when(k < F.size(pieces) - 1, F.concat(piece, told)).otherwise(piece)
        return F.when(apart, spelling(F.regexp_extract(rest, _AFTER, 1)))

    return F.transform(pieces, after)


def named_in_text(text: Column) -> Column:
    """A unit that a sentence or caption ends on or gives before a comma."""
    return spelling(F.regexp_extract(text, r"(?:: | in )([^:(),]+?)(?:\)?\.?\s*$|, |\))", 1))


def named_in_caption(caption: Column) -> Column:
    return spelling(F.regexp_extract(caption, r"(?:: | in )([^:(),]+?)\)?\.?\s*$", 1))


#: A spelling begins with a letter or sign of a unit and has no number of three digits.
_PLAUSIBLE = r"^(?!.*[0-9]{3})[\p{L}%‰°\"][\p{L}%‰°\"/.^ ·*\-0-9]{0,80}$"


def named_units(rows: DataFrame) -> DataFrame:
    """Add the spelling of each place a unit may be named in: ``at_value`` ... ``at_caption``;
    an excerpt may name several, ``at_excerpt`` is an array or null."""

    def plausible(c: Column) -> Column:
        return F.when(c.rlike(_PLAUSIBLE), c)

    told = F.filter(named_in_excerpt(F.col("excerpt"), F.col("value")), lambda c: F.coalesce(c.rlike(_PLAUSIBLE), F.lit(False)))
    return rows.select(
        "*",
        plausible(named_in_value(F.col("value"))).alias("at_value"),
        plausible(spelling(F.col("unit"))).alias("at_unit"),
        plausible(named_in_label(F.col("label"))).alias("at_label"),
        F.when(F.size(told) > 0, told).alias("at_excerpt"),
        plausible(named_in_text(F.col("interpretation"))).alias("at_text"),
        plausible(named_in_caption(F.col("caption"))).alias("at_caption"),
    )


def numbers_of(value: Column) -> Column:
    """All numbers of a value in their order."""
    found = F.regexp_extract_all(value, F.lit(NUMBER), F.lit(0))
    # the minus of a range is no sign
    plain = F.transform(found, lambda x: F.translate(x, "−,", "-").try_cast("double"))
    return F.filter(plain, lambda x: x.isNotNull())


def parsed(value: Column) -> dict[str, Column]:
    """Number, bounds and spread of a value; a median or single number is the number."""
    range_ = value.rlike(r"\d\s*(?:[–—−]|\bto\b|-)\s*\d")
    n = numbers_of(F.regexp_replace(value, r"(?<=\d)\s*[-−–—]\s*(?=\d)", " … "))
    first, second, third = F.get(n, F.lit(0)), F.get(n, F.lit(1)), F.get(n, F.lit(2))
    spread = value.contains("±")
    three = ~spread & third.isNotNull() & range_
    two = ~spread & third.isNull() & second.isNotNull() & range_
    return {
        "number": F.when(two, None).otherwise(first),
        "lower_bound": F.when(three, second).when(two, first),
        "upper_bound": F.when(three, third).when(two, second),
        "spread": F.when(spread, second),
    }


# --- settling the spellings ------------------------------------------------------------


@dataclass(frozen=True)
class Graph:
    """Parameters of the graph of sources."""

    least: int = 8  # links of a source
    unnamed: int = 20  # links of a source whose name says nothing
    purity: float = 0.8  # of its links in one dimension
    tolerance: float = 0.125  # decimal orders; the nearest two conversions are 0.25 apart
    errors: float = 3.0  # standard errors
    rounds: int = 8
    names: bool = True  # whether the grammar may settle what links leave open


@F.pandas_udf(StringType())
def _reading(spellings: pd.Series) -> pd.Series:
    return spellings.map(read_unit, na_action="ignore")


def conversions(catalogue: DataFrame) -> DataFrame:
    """``(unit_code, dimension, is_common, common_unit, scale, shift)`` of the catalogue's
    units with a known conversion: at most as many as ``CONVERSIONS``."""
    codes = [r for r in small_rows(catalogue.where("unit_code is not null"), 5000, "the catalogue of units") if r["unit_code"] in CONVERSIONS]
    common = {r["dimension"]: r["unit_code"] for r in codes if r["is_common"]}
    rows = [(r["unit_code"], r["dimension"], bool(r["is_common"]), common.get(r["dimension"]), *CONVERSIONS[r["unit_code"]]) for r in codes]
    return catalogue.sparkSession.createDataFrame(rows, "unit_code string, dimension string, is_common boolean, common_unit string, scale double, shift double")


def centres(counts: DataFrame, settled: DataFrame, known: DataFrame) -> DataFrame:
    """``(entity, dimension, level, hub)``: robust centres of what settled sources record."""
    log = F.col("b") + F.log10("scale")
    y = F.round(F.when(F.col("level"), F.col("b") * F.col("scale") + F.col("shift")).otherwise(log), 2)
    rows = counts.join(F.broadcast(settled.join(F.broadcast(known), "unit_code")), "spelling")
    return rows.groupBy("entity", "dimension", "level").agg(F.percentile(y, 0.5, F.col("n")).alias("hub"))


def estimates(counts: DataFrame, hubs: DataFrame, known: DataFrame, graph: Graph) -> DataFrame:
    """Scale and offset of every source against the centres, snapped to each conversion:
    ``(spelling, dimension, unit_code, links, gap, scale_order, fits)``."""
    linked = counts.join(hubs, ["entity", "level"])
    quartiles = F.lit([0.25, 0.5, 0.75])
    error = 1.25 * 1.4826 * F.greatest((F.col("q")[2] - F.col("q")[0]) / 2, F.col("floor")) / F.sqrt("links")
    order = linked.where("not level").groupBy("spelling", "dimension").agg(F.percentile(F.round(F.col("hub") - F.col("b"), 2), quartiles, F.col("n")).alias("q"), F.sum("n").alias("links"))
    gap = F.abs(F.col("q")[1] - F.log10("scale"))
    by_scale = order.withColumn("floor", F.lit(0.05)).join(F.broadcast(known), "dimension").select(
        "spelling", "dimension", "unit_code", "links", gap.alias("gap"), F.col("q")[1].alias("scale_order"), (gap <= F.greatest(F.lit(graph.tolerance), graph.errors * error)).alias("fits")
    )
    # levels tell conversions apart that share a scale; only dimensions with offsets need them
    shifted = known.join(F.broadcast(known.where("shift <> 0").select("dimension").distinct()), "dimension", "left_semi")
    left = F.round(F.col("hub") - F.col("b") * F.col("scale") - F.col("shift"), 1)
    level = linked.where("level").join(F.broadcast(shifted), "dimension").groupBy("spelling", "dimension", "unit_code").agg(F.percentile(left, quartiles, F.col("n")).alias("q"), F.sum("n").alias("links"))
    rest, spread_ = F.abs(F.col("q")[1]), (F.col("q")[2] - F.col("q")[0]) / 2
    by_level = level.withColumn("floor", F.lit(1e-3)).select(
        "spelling", "dimension", "unit_code", "links", rest.alias("gap"), F.lit(None).cast("double").alias("scale_order"), (rest <= F.greatest(spread_, graph.errors * error)).alias("fits")
    )
    both = by_scale.unionByName(by_level).groupBy("spelling", "dimension", "unit_code")
    # evidence of fewer links than asked for does not speak against a conversion
    strong = F.col("links") >= graph.least
    return both.agg(
        F.sum("links").alias("links"), F.max("scale_order").alias("scale_order"), F.min("gap").alias("gap"),
        F.coalesce(F.bool_and(F.when(strong, F.col("fits"))), F.lit(False)).alias("fits"),
    )


def snapped(found: DataFrame, readings: DataFrame, graph: Graph) -> DataFrame:
    """Sources that exactly one conversion of their dimension fits:
    ``(spelling, unit_code, how, links, scale_order)``."""
    best = F.max(F.struct(F.col("links"), F.col("dimension"))).alias("best")
    dims = found.groupBy("spelling", "dimension").agg(
        F.max("links").alias("links"), F.count_if("fits").alias("fitting"), F.max(F.when(F.col("fits"), F.col("unit_code"))).alias("unit_code"), F.max("scale_order").alias("scale_order")
    )
    one = dims.groupBy("spelling").agg(best, F.sum("links").alias("all_links")).select("spelling", "best.links", "best.dimension", "all_links")
    chosen = one.join(dims.drop("links"), ["spelling", "dimension"]).join(readings, "spelling", "left")
    asked = F.when(F.col("reading").isNull(), graph.unnamed).otherwise(graph.least)
    sure = (F.col("fitting") == 1) & (F.col("links") >= asked) & (F.col("links") >= graph.purity * F.col("all_links"))
    return chosen.where(sure).select("spelling", "unit_code", F.lit("links").alias("how"), F.col("links").cast("bigint").alias("links"), "scale_order")


def source_graph(counts: DataFrame, spellings: DataFrame, catalogue: DataFrame, graph: Graph = Graph()) -> DataFrame:
    """Units of spellings: ``(spelling, unit_code, how, links, scale_order)``.

    ``counts`` has ``(spelling, entity, level, b, n)``: how often a source records a value
    of about 10**b (for levels b) of an entity.  ``spellings`` lists all spellings.
    Everything stays distributed; a round's result is a row a spelling, cut by checkpoint.
    """
    known = conversions(catalogue)
    counts = cut(counts)
    readings = cut(spellings.select("spelling", _reading("spelling").alias("reading")))
    empty = [F.lit(0).cast("bigint").alias("links"), F.lit(None).cast("double").alias("scale_order")]
    codes = F.broadcast(known.select("unit_code"))
    settled = cut(readings.join(codes, F.col("spelling") == F.col("unit_code")).select("spelling", "unit_code", F.lit("anchor").alias("how"), *empty))
    for _ in range(graph.rounds):
        hubs = centres(counts, settled, known)
        todo = counts.join(settled.select("spelling"), "spelling", "left_anti")
        new = cut(snapped(estimates(todo, hubs, known, graph), readings, graph))
        if new.isEmpty():
            break
        settled = settled.unionByName(new)
    if graph.names:
        left = readings.join(settled.select("spelling"), "spelling", "left_anti").join(codes, F.col("reading") == F.col("unit_code"))
        settled = settled.unionByName(left.select("spelling", "unit_code", F.lit("name").alias("how"), *empty))
    return cut(settled)


def metric_kinds(reference: DataFrame, most: int = 5000) -> tuple[NameResolver, dict[str, tuple[str, str]]]:
    """A resolver of names, and (quantity kind, family) of each entry."""
    rows = small_rows(reference.where("metric_key is not null"), most, "the table of metrics")
    resolver = NameResolver([(r["metric_key"], r["short_name"], r["full_name"]) for r in rows])
    return resolver, {r["metric_key"]: (r["quantity_kind"], r["metric_family"]) for r in rows}


def with_metric(rows: DataFrame, reference: DataFrame, name_col: str = "name") -> DataFrame:
    """Add ``metric_key``, ``quantity_kind`` and ``family`` of a dirty name; distinct names
    are resolved once and joined back."""
    resolver, kinds = metric_kinds(reference)

    @F.pandas_udf(StringType())
    def resolve(names: pd.Series) -> pd.Series:
        return names.map(lambda n: resolver.resolve(n) if isinstance(n, str) else None)

    resolve = resolve.asNondeterministic()  # else a filter on its result moves below the distinct
    table = rows.sparkSession.createDataFrame([(k, a, b) for k, (a, b) in kinds.items()] or [("", "", "")], "metric_key string, quantity_kind string, family string")
    names = rows.select(F.col(name_col).alias("_name")).where("_name is not null").distinct()
    # a name costs far more to resolve than to move: all cores, however small the list is
    names = names.repartition(rows.sparkSession.sparkContext.defaultParallelism)
    known = names.withColumn("metric_key", resolve("_name")).where("metric_key is not null").join(F.broadcast(table), "metric_key")
    return rows.join(known, rows[name_col] == known["_name"], "left").drop("_name")


HINT_COLUMNS = ("hint_id", "metric_name", "value", "unit_hint", "column_label", "excerpt", "caption")
LEDGER_COLUMNS = ("metric_id", "name", "as_reported", "unit", "interpretation", "scope_label")


def quantities(hints: DataFrame, ledger: DataFrame) -> DataFrame:
    """Rows of both tables in one shape."""
    none = F.lit(None).cast("string")
    entity = F.regexp_extract("caption", r"(?:\bfor|\bof)\s(.+?)(?:\s+at\s+\d|[;,(.]|$)", 1)
    a = hints.select(
        F.lit("metric_hint").alias("table_name"), F.col("hint_id").cast("bigint").alias("row_id"), F.col("metric_name").alias("name"), "value", F.col("unit_hint").alias("unit"),
        F.col("column_label").alias("label"), "excerpt", none.alias("interpretation"), "caption", F.trim(entity).alias("variable"),
    )
    b = ledger.select(
        F.lit("ledger_metric").alias("table_name"), F.col("metric_id").cast("bigint").alias("row_id"), "name", F.col("as_reported").alias("value"), "unit",
        none.alias("label"), none.alias("excerpt"), "interpretation", none.alias("caption"), F.trim(F.substring_index("scope_label", ",", 1)).alias("variable"),
    )
    return a.unionByName(b)


def read_quantities(hints: DataFrame, ledger: DataFrame, reference: DataFrame) -> DataFrame:
    """Every row of both tables with what it says: ``(table_name, row_id, entity, level,
    said, first, number, lower_bound, upper_bound, spread)``.

    ``said`` lists the spellings a row names as units in the order of their places,
    ``first`` those of its first place; ``entity`` is the metric of a variable, or a
    fraction, which has the same scale whatever its variable is.
    """
    rows = with_metric(quantities(spread(hints.select(*HINT_COLUMNS)), spread(ledger.select(*LEDGER_COLUMNS))), reference)
    one = lambda c: F.when(F.col(c).isNotNull(), F.array(c))
    caption = F.when((F.col("quantity_kind") == "variable") & F.col("at_caption").isNotNull(), F.array("at_caption"))
    places = [one("at_value"), one("at_unit"), one("at_label"), F.col("at_excerpt"), one("at_text"), caption]
    none = F.array().cast("array<string>")
    variable = F.when(F.col("variable") != "", F.concat_ws("|", "metric_key", "variable"))
    entity = F.when(F.col("quantity_kind") == "variable", variable).when(F.col("quantity_kind") == "fraction", F.col("metric_key"))
    return named_units(rows).select(
        "table_name", "row_id", entity.alias("entity"), F.coalesce(F.col("family") == "level", F.lit(False)).alias("level"),
        F.concat(*[F.coalesce(p, none) for p in places]).alias("said"), F.coalesce(*places, none).alias("first"), *[v.alias(k) for k, v in parsed(F.col("value")).items()],
    )


def source_counts(read: DataFrame) -> DataFrame:
    """How often each source records about which value of which entity."""
    x = F.coalesce(F.col("number"), (F.col("lower_bound") + F.col("upper_bound")) / 2)
    b = F.when(F.col("level"), F.round(x, 1)).when(x > 0, F.round(F.log10(x), 2))
    rows = read.where("entity is not null").select(F.explode("first").alias("spelling"), "entity", "level", b.alias("b"))
    return rows.where("b is not null").groupBy("spelling", "entity", "level", "b").agg(F.count(F.lit(1)).alias("n"))


def settled_spellings(read: DataFrame, catalogue: DataFrame, graph: Graph = Graph()) -> DataFrame:
    return source_graph(source_counts(read), read.select(F.explode("said").alias("spelling")).distinct(), catalogue, graph)


def with_unit(read: DataFrame, settled: DataFrame, most: int = 2000) -> DataFrame:
    """Add ``unit_code``, that of the first spelling a row says that is a unit.

    Up to ``most`` settled spellings are a map in the plan, more are joined by spelling.
    """
    rows = settled.select("spelling", "unit_code").limit(most + 1).collect()
    if len(rows) <= most:
        known = F.create_map(*[F.lit(v) for r in rows for v in r]) if rows else F.create_map().cast("map<string,string>")
        return read.withColumn("unit_code", F.get(F.filter(F.transform("said", lambda x: known[x]), lambda x: x.isNotNull()), F.lit(0)))
    said = read.select("table_name", "row_id", F.posexplode("said").alias("at", "spelling")).join(settled.select("spelling", "unit_code"), "spelling")
    first = said.groupBy("table_name", "row_id").agg(F.min(F.struct("at", "unit_code")).alias("m")).select("table_name", "row_id", "m.unit_code")
    return read.join(first, ["table_name", "row_id"], "left")


def recorded_units(hints: DataFrame, ledger: DataFrame, reference: DataFrame, catalogue: DataFrame, graph: Graph = Graph()) -> DataFrame:
    """Every row of both tables with its unit and its values in the common unit.

    ``(table_name, row_id, unit_code, is_common, common_unit, number, lower_bound,
    upper_bound, spread)``; the unit columns are null for rows without any.
    """
    read = cut(read_quantities(hints, ledger, reference))  # the graph and the result both need it
    wide = with_unit(read, settled_spellings(read, catalogue, graph)).join(F.broadcast(conversions(catalogue)), "unit_code", "left")
    shift = F.when(F.col("level"), F.col("shift")).otherwise(0.0)
    some = F.coalesce(F.col("number"), F.col("lower_bound")).isNotNull()

    def turned(c: str, moved: bool = True) -> Column:
        return F.coalesce(F.col(c) * F.col("scale") + (shift if moved else F.lit(0.0)), F.col(c)).alias(c)

    units = [F.when(some, F.col(c)).alias(c) for c in ("unit_code", "is_common", "common_unit")]
    return wide.select("table_name", "row_id", *units, turned("number"), turned("lower_bound"), turned("upper_bound"), turned("spread", False))
