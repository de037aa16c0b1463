"""Candidates from sources: lines, headings, paragraphs, sentence windows, table cells."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ledgerloom.functions.metrics import Names

HEADING = r"^#+ "
_BREAK, _LINE = "\x01", "\x02"


def split_lines(text: Column) -> Column:
    return F.split(text, r"\r?\n")


def lines_of(df: DataFrame, keys: list[str], text: str) -> DataFrame:
    """One row a line with its number from 0; null texts have none."""
    return df.select(*keys, F.posexplode(split_lines(F.col(text))).alias("line_no", "line"))


def with_heading(df: DataFrame, keys: list[str], text: str) -> DataFrame:
    """Each line of a text with the nearest heading strictly before it (W1); null before the
    first.  ``(keys, line_no, line, heading)``; texts stay where they are, no shuffle."""
    staged = df.select(*keys, split_lines(F.col(text)).alias("_lines"))
    titles = F.transform("_lines", lambda x, i: F.when(x.rlike(HEADING), F.struct(i.alias("at"), F.trim(F.regexp_replace(x, HEADING, "")).alias("title"))))
    staged = staged.withColumn("_heads", F.filter(titles, lambda h: h.isNotNull()))
    lines = staged.select(*keys, "_heads", F.posexplode("_lines").alias("line_no", "line"))
    before = F.filter("_heads", lambda h: h["at"] < F.col("line_no"))
    return lines.withColumn("heading", F.get(before, F.size(before) - 1)["title"]).drop("_heads")


def paragraphs_of(df: DataFrame, keys: list[str], text: str) -> DataFrame:
    """Runs of lines of a text that no blank line or heading parts (W3): ``(keys, par, text,
    lines)``.  ``par`` is the number of such lines before; no shuffle."""
    breaks = F.transform("_lines", lambda x: F.when((F.trim(x) == "") | x.rlike(HEADING), _BREAK).otherwise(x))
    staged = df.select(*keys, split_lines(F.translate(text, _BREAK + _LINE, "  ")).alias("_lines")).select(*keys, F.array_join(breaks, _LINE).alias("_marked"))
    runs = staged.select(*keys, F.posexplode(F.split("_marked", _BREAK)).alias("par", "_run"))
    body = runs.withColumn("_run", F.regexp_replace("_run", f"^{_LINE}|{_LINE}$", "")).where("_run <> ''")
    return body.select(*keys, "par", F.replace("_run", F.lit(_LINE), F.lit(" ")).alias("text"), F.size(F.split("_run", _LINE)).cast("bigint").alias("lines"))


def sentences_of(text: Column) -> Column:
    """Sentences: pieces that end with a stop and white space, or at a line's end."""
    marked = F.regexp_replace(text, r"([.!?])\s+", "$1\n")
    return F.filter(F.transform(F.split(marked, r"\n+"), lambda s: F.trim(s)), lambda s: s != "")


def sentence_windows(df: DataFrame, keys: list[str], text: str, most: int = 1800) -> DataFrame:
    """Single sentences and adjacent pairs of at most ``most`` characters, in the order
    s0, s0+s1, s1, s1+s2 ... (W4)."""
    s = F.col("_sentences")  # a column of its own, so that it is split once a row
    staged = df.select(*keys, sentences_of(F.col(text)).alias("_sentences")).where(F.size("_sentences") > 0)
    pairs = F.transform(F.sequence(F.lit(0), F.size(s) - 1), lambda i: F.array(F.get(s, i), F.concat(F.get(s, i), F.lit(" "), F.get(s, i + 1))))
    kept = F.filter(F.flatten(F.col("_pairs")), lambda w: w.isNotNull() & (F.length(w) <= most))
    return staged.withColumn("_pairs", pairs).select(*keys, F.posexplode(kept).alias("window_ord", "window"))


def unpivot(df: DataFrame, keys: list[str], columns: list[str]) -> DataFrame:
    """Cells of numeric columns as rows (C2), in the authored order of the columns; null
    cells are no candidates."""
    cells = F.array(*[F.struct(F.lit(k).alias("col_ord"), F.lit(c).alias("column_label"), F.col(c).cast("double").alias("value")) for k, c in enumerate(columns)])
    return df.select(*keys, F.inline(cells)).where("value is not null")


def caption_has_body(df: DataFrame, keys: list[str], text: str, ahead: int = 13) -> DataFrame:
    """Caption lines of a text with how many of the next lines hold a table row (W6):
    ``(keys, line_no, line, body_lines)``; no shuffle."""
    staged = df.select(*keys, split_lines(F.col(text)).alias("_lines"))
    captions = staged.select(*keys, "_lines", F.posexplode("_lines").alias("line_no", "line")).where(F.col("line").rlike(r"^(Table|Figure)\s+[0-9]+\."))
    following = F.slice("_lines", F.col("line_no") + 2, F.lit(ahead))
    body = F.size(F.filter(following, lambda x: x.rlike(r"^\s*\|.*\|\s*$"))).cast("bigint")
    return captions.withColumn("body_lines", body).drop("_lines")


def compact_groups(hints: DataFrame, keys: list[str], name: str, order: str, least: int = 2) -> DataFrame:
    """Hints of one item and target together, their names in order."""
    names = F.transform(F.array_sort(F.collect_list(F.struct(order, name))), lambda x: x[name])
    return hints.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"), F.array_join(names, "; ").alias("names")).where(F.col("n") >= least)


def registry_of(tables: DataFrame) -> DataFrame:
    """Registry rows of recovered tables (C1), their location from the caption's number."""
    number = F.regexp_extract("caption", r"^Table ([0-9]+)", 1)
    place = F.when(number != "", F.concat(F.lit("Table "), number)).otherwise(F.regexp_replace("source_item_id", "^tbl_0*", "Table "))
    return tables.select("bundle_id", "source_item_id", F.lit("table").alias("item_type"), F.col("source_page").cast("int").alias("source_page"), place.alias("source_location"), "caption")


def prose_hints(windows: DataFrame, text: str, names: Names) -> DataFrame:
    """Windows that name a metric and hold a number (C4), and whether they sum up."""
    low = F.lower(F.col(text))
    return windows.where(low.rlike("[0-9]") & names.named(F.col(text))).withColumn("summary", low.rlike(r"\b(median|mean|average|overall|respectively)\b|±"))


def sections_under(lines: DataFrame, keys: list[str], pattern: str) -> DataFrame:
    """Sections whose heading matches (W2, C6): each runs to the next heading of its level
    or a higher one; nested matches give a section each.

    ``(keys, start, title, end)`` by line numbers, end exclusive and null at the text's end.
    """
    heads = lines.where(F.col("line").rlike(r"^#+ ")).select(*keys, "line_no", F.length(F.regexp_extract("line", "^(#+)", 1)).alias("level"), F.trim(F.regexp_replace("line", r"^#+ ", "")).alias("title"))
    mine = heads.where(F.lower("title").rlike(pattern)).select(*keys, F.col("line_no").alias("start"), F.col("level").alias("own"), "title")
    after = F.when((F.col("line_no") > F.col("start")) & (F.col("level") <= F.col("own")), F.col("line_no"))
    return mine.join(heads.select(*keys, "line_no", "level"), keys).groupBy(*keys, "start", "title").agg(F.min(after).alias("end"))
