"""Mixing sources to target shares by pivotal dependent rounding.

Sizes are token counts of a public tokenizer.  The share of each source sets how often its
documents are needed: the whole part of that number is taken by every document, the rest
is a fractional copy probability.  Pivotal rounding pairs two fractional documents and
randomly moves probability from one to the other until one of them is 0 or 1.  The moved
amounts are weighted by size, so the expected tokens of a pair, and so of a source, stay
exactly what they were; each document keeps its own probability in expectation.  Every
partition rounds its documents and hands on at most one fractional document a source; the
residuals are combined the same way in a reduction tree.

Defined results: documents without a source, or of a source without a target, get no
copies; null and empty texts have no tokens and get the whole copies of their source;
repeated target rows of a source are refused.
"""

from __future__ import annotations

import base64
import random
from collections.abc import Iterator
from pathlib import Path

import pandas as pd
import pyarrow as pa
from pyspark import SparkFiles
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType

from ledgerloom.session import cut, small_rows, spread

#: Where the vocabulary of the tokenizer is; a parameter, never copied.
VOCABULARY = "/opt/tokenizers/byte_bpe_50k.tiktoken"
#: Fixed value: the public pattern that splits text before byte-pair merging.
PATTERN = r"""'(?:[sdmt]|ll|ve|re)| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
_encodings: dict[str, object] = {}


def encoding(path: str):
    """The tokenizer of a rank file, once a process."""
    if path not in _encodings:
        import tiktoken

        pairs = (line.split() for line in Path(path).read_bytes().splitlines())
        ranks = {base64.b64decode(a): int(b) for a, b in pairs}
        _encodings[path] = tiktoken.Encoding("public", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})
    return _encodings[path]


def count_tokens(df: DataFrame, text_col: str = "text", out: str = "tokens", vocabulary: str = VOCABULARY) -> DataFrame:
    """Add the number of tokens of a text; null counts as empty.

    The vocabulary is read by the driver and travels to the workers as a file of the
    application, so executors need no copy of their own.
    """
    df.sparkSession.sparkContext.addFile(vocabulary)
    name = Path(vocabulary).name

    @F.pandas_udf(LongType())
    def tokens(texts: pd.Series) -> pd.Series:
        encode = encoding(SparkFiles.get(name)).encode_ordinary
        return texts.map(lambda t: len(encode(t)) if t else 0)

    return df.withColumn(out, tokens(F.col(text_col)))


def plan_shares(available: dict[str, int], targets: list[tuple[str, float, int]], total: float | None = None) -> dict[str, dict]:
    """Tokens and copies planned for each source.

    ``total`` is the size of the mixture, by default all tokens of the targeted sources.  A
    source that cannot give its share within its repeats gives all it can, and what it
    lacks is shared out among the others in proportion to their targets, as far as they
    reach; the plan says which targets are met.
    """
    want = {s: share for s, share, _ in targets}
    if len(want) < len(targets):
        raise ValueError("a source has more than one target")
    most = {s: available.get(s, 0) * max(0, repeats) for s, _, repeats in targets}
    size = float(sum(available.get(s, 0) for s in want)) if total is None else float(total)
    given: dict[str, float] = {}
    open_ = {s for s in want if want[s] > 0}
    while open_:
        left = size - sum(given.values())
        weight = sum(want[s] for s in open_)
        full = {s for s in open_ if left * want[s] / weight >= most[s]}
        if not full:
            given |= {s: left * want[s] / weight for s in open_}
            break
        given |= {s: float(most[s]) for s in full}
        open_ -= full
    return {
        s: {
            "target_share": share,
            "max_repeats": repeats,
            "available": available.get(s, 0),
            "planned": given.get(s, 0.0),
            "copies": given.get(s, 0.0) / available[s] if available.get(s) else 0.0,
            "reached": given.get(s, 0.0) + 1e-6 >= share * size,
        }
        for s, share, repeats in targets
    }


def pivot(pool: list[tuple[int, int, float]], rng: random.Random) -> tuple[list[tuple[int, int]], tuple[int, int, float] | None]:
    """Round fractional documents ``(id, size, probability)``: decided ones and a residual.

    Each step keeps ``size * probability`` of the pair and every probability in
    expectation, and decides at least one document.
    """
    done: list[tuple[int, int]] = []
    held: tuple[int, int, float] | None = None
    for doc, size, p in pool:
        if held is None:
            held = (doc, size, p)
            continue
        other, weight, q = held
        # what can move towards the document, and back, in size units
        up = min((1 - p) * size, q * weight)
        down = min(p * size, (1 - q) * weight)
        move = up if rng.random() * (up + down) < down else -down
        p, q = p + move / size, q - move / weight
        rest = []
        for d, s, x in ((doc, size, p), (other, weight, q)):
            if x < 1e-9 or x > 1 - 1e-9:
                done.append((d, int(x > 0.5)))
            else:
                rest.append((d, s, x))
        held = rest[0] if rest else None
    return done, held


_STEP = "source string, doc_id bigint, tokens bigint, p double, copies bigint, part bigint"


def _rounds(seed: int, level: int, last: bool):
    """A step of the tree over one partition: decided documents, and a residual a source."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[str, tuple] = {}
        names = ["source", "doc_id", "tokens", "p", "copies", "part"]
        kinds = [pa.string(), pa.int64(), pa.int64(), pa.float64(), pa.int64(), pa.int64()]
        base: dict[int, tuple[int, int]] = {}  # copies and tokens of the documents at hand
        part, rng = 0, None
        for batch in batches:
            out = []
            for r in batch.to_pylist():
                if rng is None:  # the same whenever a lost partition is done again
                    part = r["part"]
                    rng = random.Random(f"{seed}/{level}/{part}/{r['doc_id']}")
                base[r["doc_id"]] = (r["copies"], r["tokens"])
                pool = [x for x in (held.pop(r["source"], None), (r["doc_id"], r["tokens"], r["p"])) if x]
                done, rest = pivot(pool, rng)
                if rest:
                    held[r["source"]] = rest
                for d, more in done:
                    copies, tokens = base.pop(d)
                    out.append((r["source"], d, tokens, None, copies + more, part))
            yield pa.RecordBatch.from_arrays([pa.array([o[k] for o in out], t) for k, t in enumerate(kinds)], names=names)
        out = []
        for source, (d, size, p) in held.items():
            if last:
                out.append((source, d, size, None, base[d][0] + int(rng.random() < p), part))
            else:
                out.append((source, d, size, p, base[d][0], part))
        yield pa.RecordBatch.from_arrays([pa.array([o[k] for o in out], t) for k, t in enumerate(kinds)], names=names)

    return run


def draw_copies(docs: DataFrame, targets: DataFrame, total: float | None = None, seed: int = 7, fan_in: int = 64, vocabulary: str = VOCABULARY, most_sources: int = 10_000) -> tuple[DataFrame, dict]:
    """Copies of every document of a targeted source, and the plan they follow.

    ``(source, doc_id, tokens, copies)``.  Token counts are computed once and cut with a
    checkpoint, as totals and rounding both need them.  The tree's first level is the
    scan's own partitions; only residuals, one a source and partition, are shuffled.
    """
    asked = [(r["source"], float(r["target_share"]), int(r["max_repeats"])) for r in small_rows(targets.where("source is not null and target_share is not null"), most_sources, "the table of targets")]
    plan_of = docs.sparkSession.createDataFrame(asked or [("", 0.0, 0)], "source string, target_share double, max_repeats int")
    named = docs.join(F.broadcast(plan_of.select("source")), "source", "left_semi")  # as many rows as targets
    counted = cut(count_tokens(spread(named.select("source", "doc_id", "text")), vocabulary=vocabulary).select("source", "doc_id", "tokens"))
    available = {r[0]: r[1] for r in counted.groupBy("source").agg(F.sum("tokens")).collect()}  # one row a source
    plan = plan_shares(available, asked, total)
    copies = docs.sparkSession.createDataFrame([(s, float(p["copies"])) for s, p in plan.items()] or [("", 0.0)], "source string, x double")
    wide = counted.join(F.broadcast(copies), "source").withColumn("copies", F.floor(F.col("x") + 1e-9).cast("bigint"))
    wide = wide.withColumn("p", F.greatest(F.col("x") - F.col("copies"), F.lit(0.0)))
    open_ = (F.col("p") > 1e-9) & (F.col("tokens") > 0)
    columns = ["source", "doc_id", "tokens", "copies"]
    whole = wide.where(~open_).select(*columns)
    step = wide.where(open_).select("source", "doc_id", "tokens", "p", "copies", F.spark_partition_id().cast("bigint").alias("part"))
    width = max(1, counted.rdd.getNumPartitions())
    parts, level = [whole], 0
    while True:
        last = width == 1 and level > 0
        step = cut(step.mapInArrow(_rounds(seed, level, last), _STEP))  # random moves must not be drawn twice
        parts.append(step.where("p is null").select(*columns))
        if last:
            break
        width = -(-width // fan_in)
        step = step.where("p is not null").withColumn("part", F.floor(F.col("part") / fan_in)).repartition(width, "part").sortWithinPartitions("source", "doc_id")
        level += 1
    decided = parts[0]
    for p in parts[1:]:
        decided = decided.unionByName(p)
    return decided, plan


def mixture_report(docs: DataFrame, targets: DataFrame, **options) -> DataFrame:
    """Target and actual share of each source, with the repeats its documents got."""
    drawn, plan = draw_copies(docs, targets, **options)
    rows = [(s, p["target_share"], p["max_repeats"], p["available"], p["planned"], bool(p["reached"])) for s, p in plan.items()]
    planned = docs.sparkSession.createDataFrame(rows, "source string, target_share double, max_repeats int, available_tokens bigint, planned_tokens double, reached boolean")
    got = drawn.groupBy("source").agg(
        F.sum(F.col("tokens") * F.col("copies")).alias("tokens"),
        F.sum("copies").alias("copies"),
        F.count_if(F.col("copies") > 0).alias("documents_used"),
        F.max("copies").alias("most_repeats"),
    )
    total = got.agg(F.sum("tokens")).first()[0] or 0
    share = F.col("tokens") / F.lit(float(total)) if total else F.lit(None).cast("double")
    return planned.join(got, "source", "left").select(planned["*"], F.coalesce("tokens", F.lit(0)).alias("tokens"), share.alias("actual_share"), "copies", "documents_used", "most_repeats")
