"""Text expressions: spaces, tokens, captions, headings, paths, chunks.

Patterns stay within what Java and RE2 share (no look-around), so that the same expression
can be checked on a second engine.  A null text gives null unless stated otherwise.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Words that say nothing about a target.
STOP_WORDS = ("a", "an", "and", "at", "by", "for", "from", "in", "of", "on", "or", "the", "to", "with")
CAPTION = r"^(Table|Tab\.|Figure|Fig\.)\s+([0-9]+|[IVXLC]+|[A-Z][0-9]+)\s*([.:]|[-–—] )\s*(.*)$"
CAPTION_START = r"^(Table|Tab\.|Figure|Fig\.)\s+([0-9]+|[IVXLC]+|[A-Z][0-9]+)"


def squeezed(text: Column) -> Column:
    """Lower case, runs of any white space as one space, ends trimmed."""
    return F.lower(F.trim(F.regexp_replace(text, r"[\s\p{Z}]+", " ")))


def tokens(text: Column) -> Column:
    """Lower-case words and numbers in their order, repeats included."""
    return F.regexp_extract_all(F.lower(text), F.lit(r"[\p{L}\p{N}]+"), F.lit(0))


def token_key(text: Column) -> Column:
    """The sorted tokens, repeats included, joined by a bar; null counts as empty."""
    return F.array_join(F.array_sort(tokens(F.coalesce(text, F.lit("")))), "|")


def content_tokens(text: Column, least: int = 3) -> Column:
    """Distinct tokens of some length without stop words, a plural's s folded away."""
    kept = F.filter(tokens(text), lambda t: (F.length(t) >= least) & ~t.isin(*STOP_WORDS))
    return F.array_sort(F.array_distinct(F.transform(kept, lambda t: F.regexp_replace(t, r"^(...+)s$", "$1"))))


def stems(text: Column) -> Column:
    """Distinct seven-letter stems of the words of five letters and more."""
    long = F.filter(tokens(text), lambda t: F.length(t) >= 5)
    return F.array_sort(F.array_distinct(F.transform(long, lambda t: F.substring(t, 1, 7))))


def jaccard(a: Column, b: Column) -> Column:
    """Shared over all distinct elements; two empty sets have none in common."""
    return F.coalesce(F.size(F.array_intersect(a, b)) / F.nullif(F.size(F.array_union(a, b)), F.lit(0)), F.lit(0.0))


def caption_parts(text: Column) -> dict[str, Column]:
    """Kind, number and body of a caption that has a delimiter; null where it has none."""
    kind = F.nullif(F.lower(F.substring(F.regexp_extract(text, CAPTION, 1), 1, 3)), F.lit(""))
    return {
        "kind": F.when(kind == "tab", "table").when(kind == "fig", "figure"),
        "number": F.nullif(F.regexp_extract(text, CAPTION, 2), F.lit("")),
        "body": F.nullif(F.regexp_extract(text, CAPTION, 4), F.lit("")),
    }


def caption_number(text: Column) -> Column:
    """The number a caption begins with, Roman numerals as Arabic ones."""
    raw = F.nullif(F.regexp_extract(text, CAPTION_START, 2), F.lit(""))
    return F.when(raw.rlike("^[IVXLCDM]+$"), roman(raw).cast("string")).otherwise(raw)


def roman(text: Column) -> Column:
    """The value of a Roman numeral."""
    value = lambda c: F.when(c == "M", 1000).when(c == "D", 500).when(c == "C", 100).when(c == "L", 50).when(c == "X", 10).when(c == "V", 5).when(c == "I", 1).otherwise(0)
    digits = F.transform(F.split(text, ""), value)
    start = F.struct(F.lit(0).alias("sum"), F.lit(0).alias("last"))
    # read from the right: a smaller digit before a larger one is subtracted
    step = lambda a, v: F.struct((a["sum"] + F.when(v < a["last"], -v).otherwise(v)).alias("sum"), v.alias("last"))
    return F.aggregate(F.reverse(digits), start, step, lambda a: a["sum"])


def slug(text: Column, most: int = 44) -> Column:
    """A short name of letters, digits and underscores."""
    return F.regexp_replace(F.substring(F.regexp_replace(F.regexp_replace(F.lower(text), "[^a-z0-9]+", "_"), "^_+|_+$", ""), 1, most), "_+$", "")


def heading_title(line: Column) -> Column:
    """A heading without its marks; a trailing line number goes unless it is a year."""
    bare = F.trim(F.regexp_replace(line, r"^#+\s*", ""))
    last = F.regexp_extract(bare, r"\s([0-9]{2,4})$", 1)
    drop = bare.rlike(r"^[0-9]") & (last != "") & ~F.coalesce(last.try_cast("int").between(1900, 2100), F.lit(False))
    return F.when(drop, F.regexp_replace(bare, r"\s[0-9]{2,4}$", "")).otherwise(bare)


def section_anchor(text: Column) -> Column:
    """The dotted number a section begins with, else the squeezed section."""
    number = F.regexp_extract(text, r"^\s*([0-9]+(\.[0-9]+)*)", 1)
    return F.when(number != "", number).otherwise(squeezed(text))


def related_sections(a: Column, b: Column) -> Column:
    """Equal sections, or one dotted number a prefix of the other."""
    x, y = section_anchor(a), section_anchor(b)
    numbered = x.rlike("^[0-9]") & y.rlike("^[0-9]")
    return (x == y) | (numbered & (F.startswith(x, F.concat(y, F.lit("."))) | F.startswith(y, F.concat(x, F.lit(".")))))


def compatible_sections(a: Column, b: Column) -> Column:
    """Related sections, or one text within the other (J6); a blank one is compatible with none."""
    x, y = squeezed(F.coalesce(a, F.lit(""))), squeezed(F.coalesce(b, F.lit("")))
    return (x != "") & (y != "") & (F.contains(x, y) | F.contains(y, x) | related_sections(x, y))


def portable_path(path: Column, package: Column) -> Column:
    """A path without its machine: relative ones keep, those inside the package become
    relative, others keep their last part.  Null and blank stay; applied twice it is the
    same."""
    plain = F.replace(path, F.lit("\\"), F.lit("/"))
    home = F.concat(F.regexp_replace(F.replace(package, F.lit("\\"), F.lit("/")), "/+$", ""), F.lit("/"))
    absolute = plain.rlike("^(/|[A-Za-z]:/)")
    inside = F.startswith(plain, home)
    return (
        F.when(path.isNull() | (F.trim(path) == ""), path)
        .when(~absolute, plain)
        .when(F.coalesce(inside, F.lit(False)), F.substring(plain, F.length(home) + 1, F.length(plain)))
        .otherwise(F.regexp_extract(plain, "([^/]*)/*$", 1))
    )


def json_pointer(parts: Column) -> Column:
    """A pointer from the names of a path, with the two escapes."""
    safe = F.transform(parts, lambda p: F.replace(F.replace(p, F.lit("~"), F.lit("~0")), F.lit("/"), F.lit("~1")))
    return F.concat(F.lit("/"), F.array_join(safe, "/"))


def trimmed(text: Column, most: int) -> Column:
    """The first characters, with a mark where something was left out."""
    return F.when(F.length(text) > most, F.concat(F.substring(text, 1, most), F.lit(" […]"))).otherwise(text)


def chunks(text: Column, size: int = 4000) -> Column:
    """Consecutive pieces of a text; an empty text is one empty piece."""
    count = F.greatest(F.ceil(F.length(text) / F.lit(size)).cast("int"), F.lit(1))
    return F.transform(F.sequence(F.lit(1), count), lambda i: F.substring(text, (i - 1) * size + 1, F.lit(size)))


def replaced_terms(text: Column, terms: list[tuple[str, str]]) -> Column:
    """Ordered replacements of terms, case ignored."""
    for old, new in terms:
        text = F.regexp_replace(text, f"(?i)\\b{old}\\b", new)
    return text


def markdown_cell(text: Column) -> Column:
    """A cell with bars escaped and line breaks as spaces."""
    return F.regexp_replace(F.regexp_replace(text, r"\|", r"\\|"), r"[\r\n]+", " ")


def single_target(label: Column) -> Column:
    """A scope label without what is listed after it (X17): the tail after a semicolon, bar
    or comma, and a tail that only names metrics."""
    head = F.trim(F.regexp_replace(label, r"\s*(;|\||,).*$", ""))
    return F.trim(F.regexp_replace(head, r"(?i)\s+and\s+(mae|rmse|bias|error|accuracy)s?$", ""))
