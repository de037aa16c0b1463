"""Free-entered names mapped to a reference list: token repair and soft TF-IDF.

1. Names are counted, brought to their readable form, lower-cased and cut into tokens;
   letters written apart (``m a e``) are joined.  Everything after works on the distinct
   names, and the repair on their distinct tokens.
2. *Token repair*: each distinct token is joined to the vocabulary of the reference list by
   edit distance.  The join is an equality join of deletion neighbourhoods, so no token is
   compared with the whole vocabulary; abbreviations join by prefix or by a fixed list.
3. *Ranking*: the repaired tokens give a soft TF-IDF cosine with every alias (short name,
   full name, full name without spaces) that shares a token.  The best alias wins if it is
   covered well enough, else the name is unmatched.

Distinct names, distinct tokens and their repairs are each worked out once and cut from what
they came from, so a table is read once for its names and once for the result.

Sizes: the reference list and its aliases are small and broadcast below a checked bound;
names and tokens are joined by shuffles on their keys.

Defined results: null and blank names are no cases and get no row in ``map_names``; names
without a letter or digit are unmatched; equal scores go to the smaller key.
"""

from __future__ import annotations

import math
import re
from collections import Counter

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerloom.llm.confusables import canonicalise
from ledgerloom.session import cut, small_rows

# Abbreviations that are no prefix of what they stand for.
SHORT_FORMS = {"avg": ["mean"], "average": ["mean"], "std": ["standard"], "stdev": ["standard", "deviation"], "pct": ["percentage", "percent"], "sqrt": ["root"]}
# Words that carry no meaning in a metric's name.
EMPTY_WORDS = ("a", "and", "for", "in", "of", "on", "the", "to")

COVERED = 0.8  # of an alias's weight, needed for a match
_LETTERS = re.compile(r"[^a-z0-9]+")


def reference_aliases(rows: list) -> list[tuple[str, int, dict[str, float]]]:
    """Aliases ``(key, number, token weights)`` of the reference rows (key, short, full)."""
    plain: list[tuple[str, list[str]]] = []
    for key, short, full in rows:
        if short:
            plain.append((key, [_LETTERS.sub("", short.lower())]))
        if full:
            tokens = [t for t in _LETTERS.split(full.lower()) if t and t not in EMPTY_WORDS]
            plain += [(key, tokens), (key, ["".join(_LETTERS.split(full.lower()))])]
    df = Counter(t for _, tokens in plain for t in set(tokens))
    return [(key, k, {t: math.log(1 + len(plain) / df[t]) for t in set(tokens)}) for k, (key, tokens) in enumerate(plain) if tokens]


def clean_name(name: Column) -> Column:
    """Lower case, everything but letters and digits one space, letters and digits that
    stand alone next to each other joined; a remark in square brackets is no name."""
    bare = F.regexp_replace(name, r"\[[^\]]*\]", " ")
    name = F.when(bare.rlike(r"[\p{L}]"), bare).otherwise(name)
    text = F.lower(F.regexp_replace(name, r"(?<=[a-z])(?=[A-Z][a-z]{3})", " "))
    text = F.trim(F.regexp_replace(text, r"[^\p{L}\p{N}]+", " "))
    return F.regexp_replace(text, r"(?<=(^|\s)\w)\s(?=\w(\s|$))", "")


def near(token: Column, reach: Column) -> Column:
    """The deletion neighbourhood: the token without up to ``reach`` of its letters."""

    def less(words: Column) -> Column:
        one = lambda w: F.transform(F.sequence(F.lit(1), F.length(w)), lambda i: F.concat(F.substring(w, F.lit(1), i - 1), F.substring(w, i + 1, F.length(w))))
        return F.array_distinct(F.flatten(F.transform(words, one)))

    once = less(F.array(token))
    twice = F.when(reach >= 2, less(once)).otherwise(F.array().cast("array<string>"))
    return F.array_distinct(F.concat(F.array(token), F.when(reach >= 1, once).otherwise(F.array().cast("array<string>")), twice))


def reach_of(token: Column) -> Column:
    """Letters that may be wrong: none in short tokens, two in long ones."""
    n = F.length(token)
    return F.when(n < 4, 0).when(n < 6, 1).otherwise(2)


def repair_tokens(tokens: DataFrame, vocabulary: DataFrame) -> DataFrame:
    """``(token, word, likeness)`` for every word of the vocabulary a token may mean.

    ``tokens`` has distinct ``token``; ``vocabulary`` has ``word`` and whether it is a
    ``name`` (a short name or joined name, which nothing abbreviates).
    """
    exact = tokens.join(vocabulary, tokens["token"] == vocabulary["word"]).select("token", "word", F.lit(1.0).alias("likeness"))
    unknown = tokens.join(vocabulary, tokens["token"] == vocabulary["word"], "left_anti")
    around = unknown.select("token", F.explode(near(F.col("token"), reach_of(F.col("token")))).alias("part"))
    words = vocabulary.where(F.length("word") > 3).select("word", F.explode(near(F.col("word"), reach_of(F.col("word")))).alias("part"))
    pairs = around.join(words, "part").select("token", "word").distinct()
    apart = F.levenshtein("token", "word")
    swapped = F.when(F.array_sort(F.split("token", "")) == F.array_sort(F.split("word", "")), 1).otherwise(0)
    fuzzy = (
        pairs.withColumn("d", apart)
        .where((F.length("token") > 2) & (F.col("d") - swapped <= reach_of(F.col("word"))))
        .select("token", "word", (1 - (F.col("d") - swapped * 0.5) / F.greatest(F.length("token"), F.length("word")) * 0.6).alias("likeness"))
    )
    stems = vocabulary.where("not name").select("word", F.explode(F.transform(F.sequence(F.lit(2), F.greatest(F.length("word") - 1, F.lit(2))), lambda n: F.substring(F.col("word"), F.lit(1), n))).alias("token"))
    # an abbreviation is at most two thirds of its word, else it is a misspelling
    short = unknown.join(stems, "token").where(F.length("token") * 3 <= F.length("word") * 2).select("token", "word", F.lit(0.9).alias("likeness"))
    number = vocabulary.where("not name").select("word", F.explode(F.array(F.concat("word", F.lit("s")), F.regexp_replace("word", "s$", ""))).alias("token"))
    plural = tokens.join(number.where("token <> word"), "token").select("token", "word", F.lit(0.98).alias("likeness"))
    forms = tokens.sparkSession.createDataFrame([(a, w) for a, ws in SHORT_FORMS.items() for w in ws], "token string, word string")
    fixed = unknown.join(F.broadcast(forms), "token").join(vocabulary.select("word"), "word").select("token", "word", F.lit(0.95).alias("likeness"))
    both = exact.unionByName(fuzzy).unionByName(short).unionByName(plural).unionByName(fixed)
    return both.groupBy("token", "word").agg(F.max("likeness").alias("likeness"))


def rank_names(names: DataFrame, aliases: list[tuple[str, int, dict[str, float]]]) -> DataFrame:
    """``(name, metric_key, score)`` of the best alias for distinct clean ``name``.

    Two shares are asked of an alias: how much of its weight the name covers, which must
    reach ``COVERED``, and the soft TF-IDF cosine, which ranks.
    """
    spark: SparkSession = names.sparkSession
    rows = [(key, number, t, w, math.sqrt(sum(x * x for x in words.values()))) for key, number, words in aliases for t, w in words.items()]
    entries = F.broadcast(spark.createDataFrame(rows, "metric_key string, alias int, word string, weight double, norm double"))
    joined = {t for _, _, words in aliases if len(words) == 1 for t in words}
    spread = {t for _, _, words in aliases if len(words) > 1 for t in words}
    listed = sorted(spread | joined)
    vocabulary = F.broadcast(spark.createDataFrame([(t, t not in spread) for t in listed], "word string, name boolean"))
    parts = names.select("name", F.posexplode(F.array_distinct(F.split("name", " "))).alias("at", "token")).where((F.col("token") != "") & ~F.col("token").isin(*EMPTY_WORDS))
    fixed = cut(repair_tokens(cut(parts.select("token").distinct()), vocabulary))
    found = parts.join(fixed, "token").join(entries, "word")
    # a token speaks for one word of an alias, a word is covered by its best token
    strength = F.max(F.col("weight") * F.col("likeness")).alias("strength")
    by_token = cut(found.groupBy("name", "metric_key", "alias", "norm", "token").agg(F.max(F.struct("likeness", "word", "weight", "at")).alias("m"), strength))
    by_word = by_token.groupBy("name", "metric_key", "alias", "norm", F.col("m.word").alias("word")).agg(F.max("m.likeness").alias("likeness"), F.max("m.weight").alias("weight"), F.min("m.at").alias("at"))
    # what a name says in all: each of its tokens by its heaviest meaning
    said = by_token.groupBy("name", "token").agg(F.max("strength").alias("w")).groupBy("name").agg(F.sqrt(F.sum(F.col("w") * F.col("w"))).alias("said"))
    square = F.col("weight") * F.col("weight")
    scored = by_word.groupBy("name", "metric_key", "alias", "norm").agg(F.sum(square * F.col("likeness")).alias("dot"), (F.count(F.lit(1)) - F.max("at") + F.min("at")).alias("close"))
    full = scored.join(said, "name").withColumn("covered", F.col("dot") / (F.col("norm") * F.col("norm"))).withColumn("cosine", F.col("dot") / (F.col("norm") * F.greatest("said", F.lit(1e-9))))
    good = full.where(F.col("covered") >= COVERED)
    # of equal cosines the alias whose words stand closer together, then the better covered
    rank = F.struct(F.round(F.col("cosine"), 3).alias("c"), F.col("close").alias("s"), F.round(F.col("covered"), 6).alias("v"))
    best = good.groupBy("name", "metric_key").agg(F.max(rank).alias("r")).groupBy("name").agg(F.min(F.struct((-F.col("r.c")).alias("c"), (-F.col("r.s")).alias("s"), (-F.col("r.v")).alias("v"), F.col("metric_key").alias("metric_key"))).alias("b"))
    return best.select("name", "b.metric_key", (-F.col("b.c")).alias("score"))


def map_names(names: DataFrame, name_col: str, reference: DataFrame, most: int = 5000) -> DataFrame:
    """``(written, metric_key, score)`` for each distinct name that is neither null nor
    blank; ``metric_key`` is ``unmatched`` where no entry is meant."""
    rows = [tuple(r) for r in small_rows(reference.where("metric_key is not null").select("metric_key", "short_name", "full_name"), most, "the reference list")]
    written = names.select(F.col(name_col).alias("written")).where(F.col("written").isNotNull() & ~F.col("written").rlike(r"^(?U)\s*$")).distinct()
    clean = cut(canonicalise(written, "written", "plain").select("written", clean_name(F.col("plain")).alias("name")))
    ranked = rank_names(clean.select("name").where("name <> ''").distinct(), reference_aliases(rows))
    return clean.join(ranked, "name", "left").select("written", F.coalesce("metric_key", F.lit("unmatched")).alias("metric_key"), "score")


def mapped_rows(tables: list[tuple[str, DataFrame, str, str]], reference: DataFrame, most: int = 5000) -> DataFrame:
    """``(table_name, row_id, written, metric_key)`` for every row with a name.

    ``tables`` lists (table name, rows, id column, name column).  The map of distinct names
    is joined back on the name; a hot name is split by adaptive execution, the map's side
    being one row.
    """
    parts = [df.select(F.lit(t).alias("table_name"), F.col(i).cast("bigint").alias("row_id"), F.col(c).alias("written")) for t, df, i, c in tables]
    rows = parts[0]
    for p in parts[1:]:
        rows = rows.unionByName(p)
    rows = rows.where("written is not null")
    return rows.join(map_names(rows, "written", reference, most), "written").select("table_name", "row_id", "written", "metric_key")


def not_verbatim(rows: DataFrame, reference: DataFrame, most: int = 5000) -> DataFrame:
    """Rows whose name is not character for character an entry's short or full name."""
    listed = small_rows(reference.select("short_name", "full_name"), most, "the reference list")
    exact = sorted({x for r in listed for x in r if x is not None})
    return rows.where(~F.col("written").isin(*exact)) if exact else rows
