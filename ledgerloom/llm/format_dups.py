"""Duplicates hidden by formatting: commutative multiset fingerprints of fields.

A record such as ``crop: winter wheat; year: 2003`` is split into its fields, each field, a
name and its value, is normalised to its words, every field is hashed on its own and the
hashes are combined by addition.  Addition forgets the order, so records that list the same
fields in another order get the same fingerprint without any sorting.  The mark between a
name and its value is punctuation like any other: the pair is hashed as the name's words
followed by the value's.  Members of a group are then compared with the group's
representative, field by field as multisets.

Commas also stand in running sentences.  They separate fields only in a text all of whose
parts begin with a field name, and the names are learnt from the texts themselves: what
stands before a colon or equals sign at a part's beginning.

Defined results: rows whose text is null belong to no group; a text without any word is a
record without fields and equals every other such text with the same companions.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerloom.session import cut, small_rows, spread

_EDGE = r"^[^\p{L}\p{N}]+|[^\p{L}\p{N}]+$"
# one pattern for a whole run: what is no word, with points that stand in no number
_NO_WORD = r"(?:[^\p{{L}}\p{{N}}\p{{M}}.{keep}]|(?<![0-9])\.|\.(?![0-9]))+"


def words_of(text: Column, keep: str = "") -> Column:
    """Lower-case words parted by single spaces; a point inside a number stays, and the
    characters to ``keep``."""
    return F.lower(F.regexp_replace(text, _NO_WORD.format(keep=keep), " "))


def learnt_names(df: DataFrame, text_col: str, least: int = 3, most: int = 1000) -> tuple[str, ...]:
    """Field names of the texts of a column: words before a colon or equals sign at the
    beginning of a part, in at least ``least`` places.  Names are as few as a schema's."""
    said = F.regexp_extract_all(F.col(text_col), F.lit(r"(?:^|[;|,/])[^\p{L};|,/:=]*(\p{L}[^;|,/:=]{0,60}?)\s*[:=]"), F.lit(1))
    names = df.select(F.explode(said).alias("name")).select(F.trim(words_of(F.col("name"))).alias("name"))
    counted = names.where("name <> ''").groupBy("name").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") >= least)
    return tuple(sorted(r["name"] for r in small_rows(counted, most, "the list of field names")))


def with_fields(df: DataFrame, text_col: str, out: str, field_names: tuple[str, ...] | None = ()) -> DataFrame:
    """Add the normalised fields of a record as an array, in the order written.

    The separator is the first of semicolon, bar, spaced slash and comma that occurs inside
    the text.  With ``field_names`` a comma separates only if every part begins with one of
    the names (running sentences have commas too); with None it always does.  The text
    without its edges is a column of its own, so that it is made once a row.
    """
    body = F.col("_body")
    comma = body.contains(",")
    if field_names is not None:
        name = "\\s*(" + "|".join(n.replace(" ", "[\\s\\p{P}]+") for n in field_names) + ")[\\s:=]+"
        comma = comma & body.rlike(f"(?iu)^{name}[^,]*(,{name}[^,]*)+$") if field_names else F.lit(False)
    parts = (
        F.when(body.contains(";"), F.split(body, ";"))
        .when(body.contains("|"), F.split(body, r"\|"))
        .when(body.rlike(r"\s/\s"), F.split(body, r"\s+/\s+"))
        .when(comma, F.split(body, ","))
        .otherwise(F.array(body))
    )
    # the fields are normalised as one text, parted by a mark that no word has
    joined = words_of(F.array_join(F.col("_parts"), "\x1f"), keep="\x1f")
    fields = F.filter(F.transform(F.split(F.col("_joined"), "\x1f"), lambda x: F.trim(x)), lambda x: x != "")
    staged = df.withColumn("_body", F.regexp_replace(F.col(text_col), _EDGE, "")).withColumn("_parts", parts).withColumn("_joined", joined)
    return staged.withColumn(out, fields).drop("_body", "_parts", "_joined")


def multiset_lanes(hashes: Column) -> list[Column]:
    """Two 32-bit lanes of the summed 64-bit field hashes, and their number.

    Each lane adds at most 2**32 per field, so the sums cannot overflow.
    """
    zero = F.lit(0).cast("bigint")
    low = F.aggregate(hashes, zero, lambda a, h: a + h.bitwiseAND(F.lit(0xFFFFFFFF)))
    high = F.aggregate(hashes, zero, lambda a, h: a + F.shiftrightunsigned(h, 32))
    return [low, high, F.size(hashes)]


def same_multiset(a: Column, b: Column) -> Column:
    """Whether two arrays hold the same elements equally often, without sorting them."""

    def times(array: Column, x: Column) -> Column:
        return F.size(F.filter(array, lambda y: y == x))

    return (F.size(a) == F.size(b)) & F.forall(a, lambda x: times(a, x) == times(b, x))


def group_copies(df: DataFrame, id_col: str, text_col: str, companions: list[str], named: bool = True) -> DataFrame:
    """Every row that belongs to a group of copies: ``(row_id, keep_id, copies)``.

    ``keep_id`` is the smallest id of the group and ``copies`` the group's size; rows
    without a copy do not appear.  Rows are copies if their ``companions`` are equal (null
    equals null) and their fields are equal as multisets.  With ``named`` commas separate
    fields that begin with a learnt name, else always.

    Groups are counted by numbers of fixed width, partially before the shuffle.  Members and
    then their representative are attached by hash joins whose hot keys adaptive execution
    splits: the large side is the rows, and a group or representative is one row however
    large its group is.  Nothing is sorted.  A fingerprint shared by different records
    stops the query rather than merging them.
    """
    # ASCII unit and record separators keep (a, null) apart from (null, a)
    beside = F.concat_ws("\x1f", *[F.coalesce(F.concat(F.lit("="), F.col(c).cast("string")), F.lit("\x1e")) for c in companions])
    rows = df.where(F.col(text_col).isNotNull()).select(F.col(id_col).alias("row_id"), F.col(text_col).alias("_text"), beside.alias("beside"))
    names = learnt_names(rows, "_text") if named else None
    rows = with_fields(spread(rows), "_text", "fields", names).withColumn("_hashes", F.transform("fields", lambda x: F.xxhash64(x)))
    low, high, size = multiset_lanes(F.col("_hashes"))
    # the texts are normalised once; groups and members both read what that gave
    rows = cut(rows.select("row_id", "fields", "beside", low.alias("h0"), high.alias("h1"), size.alias("n"), F.xxhash64("beside").alias("h2")))
    key = ["h0", "h1", "n", "h2"]
    groups = rows.groupBy(*key).agg(F.count(F.lit(1)).alias("copies"), F.min("row_id").alias("keep_id")).where("copies > 1")
    members = cut(rows.join(groups.hint("shuffle_hash"), key).select("row_id", "keep_id", "copies", "fields", "beside"))
    kept = members.where("row_id = keep_id").select(F.col("keep_id").alias("_keep"), F.col("fields").alias("_fields"), F.col("beside").alias("_beside"))
    proven = (F.col("beside") == F.col("_beside")) & same_multiset(F.col("fields"), F.col("_fields"))
    keep = F.when(proven, F.col("keep_id")).otherwise(F.raise_error(F.lit("fingerprint collision: use another hash")).cast("bigint"))
    return members.join(kept.hint("shuffle_hash"), F.col("keep_id") == F.col("_keep")).select("row_id", keep.alias("keep_id"), "copies").distinct()  # ids delivered again


def collapse(df: DataFrame, id_col: str, text_col: str, companions: list[str], named: bool = True) -> DataFrame:
    """One row for each distinct record, the one with the smallest id, with ``copies``.

    Rows with a null text are kept, each as its own record with one copy.
    """
    groups = group_copies(df, id_col, text_col, companions, named)
    copies = groups.select(F.col("row_id").alias("_row"), F.col("keep_id").alias("_keep"), F.col("copies").alias("_copies"))
    joined = df.join(copies.hint("shuffle_hash"), df[id_col] == copies["_row"], "left")
    return joined.where(F.col("_keep").isNull() | (F.col("_keep") == df[id_col])).select(df["*"], F.coalesce(F.col("_copies"), F.lit(1).cast("bigint")).alias("copies"))
