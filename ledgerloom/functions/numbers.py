"""Numbers as reported: parsing, identity, shape, geometry.

A display is read in two steps.  It is cut into tokens and each token becomes one letter:
``n`` a number, ``t`` a dash or *to*, ``u`` a plus-minus, ``o`` and ``e`` brackets, ``p`` a
percent, ``m`` *median* or *mean*, ``r`` *range*, ``s`` a comma or semicolon, ``w`` any other
word, ``x`` anything else; colons, equals signs and the signs of numbers have none.  The
word of those letters then tells the shape and which number is which.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

TOKEN = r"\+/-|[0-9]+(?:[.,][0-9]*)?(?:[eE][-+]?[0-9]+)?|[.][0-9]+(?:[eE][-+]?[0-9]+)?|[\p{L}°][\p{L}\p{N}°/._]*|\S"
#: Shapes by their letters, with the places of value, lower bound, upper bound and spread
#: among the numbers; -1 where a shape has none.
SHAPES = (
    ("range_named", r"^ntn[wp]?[so]?mn[wp]?e?$", (2, 0, 1, -1)),
    ("named_range", r"^mn[wp]?[so]?rntn[wp]?e?$", (0, 1, 2, -1)),
    ("estimate_range", r"^np?ontnp?ep?$", (0, 1, 2, -1)),
    ("plus_minus", r"^nunp?$", (0, -1, -1, 1)),
    ("range", r"^ntnp?$", (-1, 0, 1, -1)),
    ("scalar", r"^np?$", (0, -1, -1, -1)),
)
#: What a shape is called, and what its range is said to rest on.
KIND = {"range_named": "estimate_with_range", "named_range": "estimate_with_range", "estimate_range": "estimate_with_range", "plus_minus": "estimate_with_uncertainty", "range": "range", "scalar": "scalar"}
BASIS = {
    "range_named": "reported min-max or across-group range",
    "named_range": "reported min-max or across-group range",
    "estimate_range": "reported interval or range (type not stated)",
    "range": "reported range (basis not stated)",
}
#: Codes of the units that are typed beside metrics.
UNIT_CODES = {
    "%": "%", "percent": "%", "percentage": "%", "d": "d", "day": "d", "days": "d", "h": "h", "hour": "h", "hours": "h", "a": "a", "yr": "a", "year": "a", "years": "a",
    "mm": "mm", "cm": "cm", "m": "m", "km": "km", "g": "g", "kg": "kg", "t": "t", "°c": "Cel", "degrees c": "Cel",
}


def decimal_of(text: Column) -> Column:
    """A number; a comma is the decimal mark only where there is no point."""
    plain = F.when(text.contains("."), F.replace(text, F.lit(","))).otherwise(F.replace(text, F.lit(","), F.lit(".")))
    return plain.try_cast("double")


def _letter(token: Column, before: Column, earlier: Column, after: Column) -> Column:
    """A token's letter; a dash is a sign where a number follows and none stands before."""
    low = F.lower(token)
    number = lambda c: F.coalesce(c.rlike("^[.]?[0-9]"), F.lit(False))
    sign = number(after) & ~number(before) & ~F.coalesce(before.isin("%", ")", "]"), F.lit(False))
    return (
        F.when(number(token), "n")
        .when(token.isin("-", "−") & sign, "-")
        .when(token == "+", "")
        .when(token.isin("-", "–", "—", "−") | (low == "to"), "t")
        .when(token.isin("±", "+/-"), "u")
        .when(token.isin("(", "["), "o")
        .when(token.isin(")", "]"), "e")
        .when(low.isin("%", "percent"), "p")
        .when(low.isin("median", "mean"), "m")
        .when(low == "range", "r")
        .when(token.isin(",", ";"), "s")
        .when(token.isin(":", "="), "")
        .when(low.rlike(r"^[\p{L}°]"), "w")
        .otherwise("x")
    )


def with_shape(df: DataFrame, display: str, prefix: str) -> DataFrame:
    """Add a display's shape ``<prefix>code`` (of ``SHAPES``, else text) and its
    ``<prefix>value``, ``low``, ``high``, ``spread`` and ``tokens``.

    Each step is a column of its own, so that no pattern is evaluated twice.  A range in
    descending order has the code ``descending``.
    """
    t, c, code, n = (F.col(prefix + k) for k in ("tokens", "letters", "code", "numbers"))
    df = df.withColumn(prefix + "tokens", F.regexp_extract_all(F.trim(F.col(display)), F.lit(TOKEN), F.lit(0)))
    near = lambda i, by: F.when((i + by >= 0), F.get(t, i + by))
    df = df.withColumn(prefix + "letters", F.transform(t, lambda x, i: _letter(x, near(i, -1), near(i, -2), near(i, 1))))
    signed = F.transform(t, lambda x, i: F.when(F.get(c, i) == "n", decimal_of(x) * F.when((i > 0) & (F.get(c, i - 1) == "-"), -1).otherwise(1)))
    word = F.replace(F.array_join(c, ""), F.lit("-"))
    shape = F.coalesce(*[F.when(word.rlike(p), k) for k, p, _ in SHAPES], F.lit("text"))
    df = df.withColumns({prefix + "code": shape, prefix + "numbers": F.filter(signed, lambda x: x.isNotNull())})
    place = lambda k: F.coalesce(*[F.when(code == s, F.get(n, F.lit(at[k]))) for s, _, at in SHAPES if at[k] >= 0])
    df = df.withColumns({prefix + k: place(i) for i, k in enumerate(("value", "low", "high", "spread"))})
    falls = F.coalesce(F.col(prefix + "low") > F.col(prefix + "high"), F.lit(False))
    return df.withColumns({prefix + "code": F.when(falls, "descending").otherwise(code), **{prefix + k: F.when(~falls, F.col(prefix + k)) for k in ("value", "low", "high")}}).drop(prefix + "numbers")


def with_quantity(df: DataFrame, display: str, out: str, name: str | None = None, unit: str | None = None) -> DataFrame:
    """Add a reported display as a struct.

    ``kind`` is estimate_with_range, estimate_with_uncertainty, range, scalar or
    text_summary.  The unit is that of the unit column, else percent where the display ends
    on it.  A text that states a confidence or prediction level has it as ``nominal_level``.
    A range in descending order keeps its text and says so in ``parse_error``.  Null gives
    null.
    """
    code, t, c = F.col("_code"), F.col("_tokens"), F.col("_letters")
    said = F.lower(F.concat_ws(" ", F.col(name) if name else F.lit(None).cast("string"), F.trim(F.col(display))))
    wide = with_shape(df, display, "_").withColumn("_said", said)
    named = lambda names: F.coalesce(*[F.when(code == k, v) for k, v in names.items()])
    own = F.lower(F.trim(F.col(unit))) if unit else F.lit(None).cast("string")
    typed = F.coalesce(own, F.lit(""))
    unit_code = F.when(typed != "", F.create_map(*[F.lit(x) for pair in UNIT_CODES.items() for x in pair])[typed]).otherwise(F.when(F.element_at(c, -1) == "p", "%"))
    levels = F.transform(t, lambda x, i: F.when((F.get(c, i) == "n") & (F.get(c, i + 1) == "p") & F.lower(F.get(t, i + 2)).rlike("^(ci|confidence|pi|prediction)"), decimal_of(x) / 100))
    level = F.get(F.filter(levels, lambda x: x.isNotNull()), F.lit(0))
    central = F.when(code.isin("range_named", "named_range"), F.lower(F.get(F.filter(t, lambda x: F.lower(x).isin("median", "mean")), F.lit(0))))
    struct = F.struct(
        F.coalesce(named(KIND), F.lit("text_summary")).alias("kind"),
        F.col("_value").alias("numeric_value"),
        F.col("_low").alias("lower_bound"),
        F.col("_high").alias("upper_bound"),
        F.abs("_spread").alias("uncertainty"),
        F.when(F.size(t) > 0, unit_code).alias("unit_code"),
        F.coalesce(central, aggregation(F.col("_said"))).alias("aggregation"),
        named(BASIS).alias("range_basis"),
        F.when((code == "text") & level.between(0, 1), level).alias("nominal_level"),
        F.when(code == "descending", "descending_range").alias("parse_error"),
    )
    return wide.withColumn(out, F.when(F.col(display).isNotNull(), struct)).drop(*[f"_{k}" for k in ("code", "value", "low", "high", "spread", "tokens", "letters", "said")])


def enriched(df: DataFrame, display: str, other: str, text: str, out: str) -> DataFrame:
    """Add a quantity filled in from what else a row says (N5), as a struct of kind,
    numeric_value, lower_bound and upper_bound.

    Structured data is never overwritten, but for two cases: text gives way to what another
    display parses to, and a range becomes an estimate with a range where one fragment of
    the text repeats both of its bounds beside a median or mean.
    """
    wide = with_quantity(with_quantity(df, display, "_own"), other, "_other").withColumn("_parts", F.split(F.coalesce(F.col(text), F.lit("")), r"[;\n]|[.](?=\s|$)"))
    own, extra = F.col("_own"), F.col("_other")
    numbers_in = lambda part: F.transform(F.regexp_extract_all(part, F.lit(r"[0-9]+(?:[.,][0-9]+)?"), F.lit(0)), decimal_of)
    central = r"(?i)\b(?:median|mean)\b[^0-9]{0,20}([0-9]+(?:[.,][0-9]+)?)"
    both = lambda part: F.array_contains(numbers_in(part), F.abs(own["lower_bound"])) & F.array_contains(numbers_in(part), F.abs(own["upper_bound"])) & part.rlike(central)
    hit = F.get(F.filter("_parts", lambda part: F.coalesce(both(part), F.lit(False))), F.lit(0))
    wide = wide.withColumn("_value", F.when(own["kind"] == "range", decimal_of(F.nullif(F.regexp_extract(hit, central, 1), F.lit("")))))
    weak = own.isNull() | (own["kind"] == "text_summary")
    taken = weak & F.coalesce(extra["kind"] != "text_summary", F.lit(False))
    pick = lambda c: F.when(taken, extra[c]).otherwise(own[c])
    raised = F.col("_value").isNotNull()
    struct = F.struct(
        F.when(raised, "estimate_with_range").otherwise(pick("kind")).alias("kind"), F.when(raised, F.col("_value")).otherwise(pick("numeric_value")).alias("numeric_value"),
        pick("lower_bound").alias("lower_bound"), pick("upper_bound").alias("upper_bound"),
    )
    return wide.withColumn(out, struct).drop("_own", "_other", "_parts", "_value")


def aggregation(text: Column) -> Column:
    """The statistic a lower-case text names, the first of a fixed order; a percent speaks
    of a proportion."""
    words = ("median", "mean", "minimum", "maximum", "count")
    share = F.when(text.rlike(r"%|\bpercent(age)?\b|\bproportion\b"), "proportion")
    return F.coalesce(*[F.when(text.rlike(rf"\b{w}\b"), w) for w in words], share)


def number_key(value: Column) -> Column:
    """A number's identity whatever its scale: 0.900 and 0.9 are one."""
    text = F.regexp_replace(F.regexp_replace(value.cast("decimal(38,18)").cast("string"), "0+$", ""), "[.]$", "")
    return F.when(text == "-0", "0").otherwise(text)


def box_area(b: dict[str, Column]) -> Column:
    return F.greatest(b["r"] - b["l"], F.lit(0.0)) * F.greatest(b["b"] - b["t"], F.lit(0.0))


def box_iou(a: dict[str, Column], b: dict[str, Column]) -> Column:
    """Intersection over union of two boxes; boxes without area share nothing."""
    wide = F.greatest(F.least(a["r"], b["r"]) - F.greatest(a["l"], b["l"]), F.lit(0.0))
    high = F.greatest(F.least(a["b"], b["b"]) - F.greatest(a["t"], b["t"]), F.lit(0.0))
    shared = wide * high
    union = box_area(a) + box_area(b) - shared
    return F.when(union > 0, shared / union).otherwise(0.0)
