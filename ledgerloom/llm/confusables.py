"""One consistent form for text that looks the same: confusables skeletons.

``skeleton`` decomposes a text, replaces every character by the prototype of its
look-alikes and decomposes again; originals with equal skeletons look alike.  The readable
form is the plain writing of that skeleton: where a character stands for another, the plain
letter of the same prototype and case takes its place, and accents are composed.

The prototypes are the public look-alike table of Unicode (UTS 39), read once from the ICU
library that comes with Spark.

Rules for the readable form
* width and presentation variants of letters, digits and punctuation become plain;
  superscripts, subscripts, fractions and symbols stay,
* accents written apart are composed with their Latin, Greek or Cyrillic letter,
* invisible characters vanish, every other space becomes the plain one; line breaks and
  tabs stay,
* a look-alike of another script becomes Latin only inside a word that also has Latin
  letters; words wholly in another script stay as they are.

Nulls give null and empty texts give empty texts.
"""

from __future__ import annotations

import unicodedata

import pandas as pd
import regex
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

# Ranges of characters, in a syntax that Java and Python share.
_INVISIBLE = r"\u00AD\u034F\u061C\u115F\u1160\u17B4\u17B5\u180B-\u180E\u200B-\u200F\u202A-\u202E\u2060-\u206F\uFEFF\uFE00-\uFE0F"
_SPACES = r"\u0085\u00A0\u1680\u2000-\u200A\u2028\u2029\u202F\u205F\u3000"
#: Latin letters with their accents, plain punctuation, signs: never changed by themselves.
_HARMLESS = r"\u0000-\u0084\u0086-\u009F\u00A1-\u00AC\u00AE-\u024F\u1E00-\u1EFF\u2010-\u2027\u2030-\u205E\u2070-\u209C\u20A0-\u20BF\u2190-\u23FF"
#: Nothing to do unless a text has one of these.
SUSPECT = rf"[^{_HARMLESS}]"

_KINDS = ("<wide>", "<narrow>", "<font>", "<compat>", "<circle>", "<vertical>", "<small>", "<isolated>", "<final>", "<initial>", "<medial>")
_invisible = regex.compile(f"[{_INVISIBLE}]")
_space = regex.compile(f"[{_SPACES}]")
_harmless = regex.compile(f"[{_HARMLESS}]")
_suspect = regex.compile(SUSPECT)
_apart = regex.compile(r"[\p{Latin}\p{Greek}\p{Cyrillic}]\p{Mn}+")
_word = regex.compile(r"[\p{L}\p{M}\p{N}]+")
_latin = regex.compile(r"\p{Latin}")
_other = regex.compile(r"[\p{L}--\p{Latin}]", regex.V1)


class LookAlikes:
    """The look-alike table: ``prototype`` of every character that has another one, and
    ``plain``, the Latin letter that a letter of another script is typed for."""

    def __init__(self, prototype: dict[int, str]):
        self.prototype = prototype
        self.plain: dict[int, str] = {}
        # plain letters by prototype and case: capital I has the prototype l
        own = {(prototype.get(ord(c), c), c.isupper()): c for c in "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz"}
        for code, proto in prototype.items():
            ch = chr(code)
            if len(proto) != 1 or not _other.match(ch):
                continue
            upper = unicodedata.category(ch) != "Ll"  # letters without case look like capitals
            shape = _small_capital(proto)
            if letter := own.get((proto, upper)) or own.get((proto, not upper)) or shape:
                self.plain[code] = letter.upper() if upper else letter.lower()


def _small_capital(ch: str) -> str | None:
    """The plain letter of a small capital; kra is the small capital of k."""
    name = unicodedata.name(ch, "")
    if name == "LATIN SMALL LETTER KRA":
        return "k"
    last = name.removeprefix("LATIN LETTER SMALL CAPITAL ")
    return last.lower() if last != name and len(last) == 1 else None


_tables: dict[str, LookAlikes] = {}


def look_alikes(spark: SparkSession) -> LookAlikes:
    """The table, built once an application; a few thousand entries, shipped to workers."""
    app = spark.sparkContext.applicationId
    if app not in _tables:
        # written ideographs and syllables have no prototypes among other scripts
        skip = ((0x3400, 0xA000), (0xAC00, 0xD7B0), (0x17000, 0x1B300))
        chars = [chr(c) for c in range(0x21, 0x20000) if unicodedata.category(chr(c))[0] in "LNPS" and not any(a <= c < b for a, b in skip)]
        checker = getattr(spark._jvm, "com.ibm.icu.text.SpoofChecker$Builder")().build()
        protos = checker.getSkeleton("\x01".join(chars)).split("\x01")
        _tables[app] = LookAlikes({ord(c): p for c, p in zip(chars, protos) if p != unicodedata.normalize("NFD", c)})
    return _tables[app]


def variant(ch: str) -> str:
    """The plain writing of a width or presentation variant; other characters unchanged.

    Read from the compatibility decompositions of the Unicode database.  Of the general
    ``<compat>`` ones only letters count (ligatures), and no letters of Latin alphabets;
    the micro sign is a symbol.
    """
    kind, _, _ = unicodedata.decomposition(ch).partition(" ")
    if kind not in _KINDS or _harmless.match(ch) or unicodedata.category(ch) == "Zs":
        return ch
    if kind == "<compat>" and not (unicodedata.category(ch)[0] == "L"):
        return ch
    plain = unicodedata.normalize("NFKC", ch)
    return plain if all(unicodedata.category(c)[0] in "LNPSM" for c in plain) else ch


class _Variants(dict):
    """A translate table that looks a character up once."""

    def __missing__(self, code: int) -> str:
        self[code] = variant(chr(code))
        return self[code]


_variants = _Variants()


def canonical_text(text: str, table: LookAlikes) -> str:
    """The consistent readable form of one text."""
    if text.isascii() or not _suspect.search(text):
        return text

    def latinised(match) -> str:
        word = match[0]
        if not (_other.search(word) and _latin.search(word)):
            return word
        return unicodedata.normalize("NFC", unicodedata.normalize("NFD", word).translate(table.plain))

    text = _invisible.sub("", text)
    text = _space.sub(" ", text)
    text = text.translate(_variants)
    text = _apart.sub(lambda m: unicodedata.normalize("NFC", m[0]), text)
    return _word.sub(latinised, text) if _other.search(text) else text


def skeleton_text(text: str, table: LookAlikes) -> str:
    """Decompose, replace every character by its prototype, decompose again."""
    text = unicodedata.normalize("NFD", _space.sub(" ", _invisible.sub("", text)).translate(_variants))
    return unicodedata.normalize("NFD", text.translate(table.prototype))


def _applied(spark: SparkSession, change):
    table = look_alikes(spark)

    @F.pandas_udf(StringType())
    def run(texts: pd.Series) -> pd.Series:
        return texts.map(lambda t: change(t, table), na_action="ignore")

    return run


def suspect(text: Column) -> Column:
    """Whether a text has any character the readable form might change; runs in the JVM."""
    return text.rlike(SUSPECT)


def readable(spark: SparkSession, text: Column) -> Column:
    """The readable form of a column.  Only suspect texts travel to Python."""
    return F.coalesce(_applied(spark, canonical_text)(F.when(suspect(text), text)), text)


def canonicalise(df: DataFrame, text_col: str, out_col: str) -> DataFrame:
    """Add the readable form of a column, in one scan."""
    return df.withColumn(out_col, readable(df.sparkSession, F.col(text_col)))


def changed(df: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """Rows whose text holds characters that stand for others: ``(row_id, canonical)``.

    Such a text differs from the plain writing of its skeleton.  One scan, no shuffle; rows
    without a suspect character end in the scan's filter.
    """
    some = df.where(suspect(F.col(text_col))).select(F.col(id_col).alias("row_id"), F.col(text_col).alias("text"))
    return some.withColumn("canonical", _applied(df.sparkSession, canonical_text)("text")).where("canonical <> text").select("row_id", "canonical")


def skeleton_groups(texts: DataFrame) -> DataFrame:
    """Originals grouped by equal skeleton: ``(table_name, skeleton, canonical, rows, forms)``.

    ``texts`` has ``(table_name, text)``.  ``rows`` counts all rows, ``forms`` the different
    writings and ``canonical`` is the most frequent readable form (the least of equals).
    Rows are first counted by writing, so the skeleton is computed once for each and hot
    names shuffle as one row a task.
    """
    spark = texts.sparkSession
    writings = texts.where("text is not null").groupBy("table_name", "text").agg(F.count(F.lit(1)).alias("rows"))
    forms = writings.select("table_name", "rows", _applied(spark, skeleton_text)("text").alias("skeleton"), readable(spark, F.col("text")).alias("canonical"))
    by_form = forms.groupBy("table_name", "skeleton", "canonical").agg(F.sum("rows").alias("rows"), F.count(F.lit(1)).alias("forms"))
    best = F.min(F.struct((-F.col("rows")).alias("r"), F.col("canonical").alias("canonical")))["canonical"]
    return by_form.groupBy("table_name", "skeleton").agg(best.alias("canonical"), F.sum("rows").alias("rows"), F.sum("forms").alias("forms"))
