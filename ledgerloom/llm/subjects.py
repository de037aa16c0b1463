"""Subject areas of documents: one-versus-rest linear classifiers on hashed n-grams.

A document has a subject if enough of its sentences deal with it, so sentences are
classified and a document's share of them is compared with a calibrated threshold.

* Features: hashed word unigrams and bigrams of a sentence, any language.
* Labels: the hand labels of documents and the subjects' descriptions.  A document label
  says that some sentences deal with the subject, not which; a first fit takes every
  sentence of a document with one label or none at its word, a second and third fit take
  the labels the model itself gives the sentences of all labelled documents, as far as the
  document's labels allow them.
* Thresholds: for each subject the share that separates labelled documents outside the fit
  best.  Every subject is decided for itself, one against the rest.

The fit uses at most ``Fit.documents`` labelled documents, chosen by a hash of their id;
that bound is a parameter.  Everything else covers all documents in one scan.

Defined results: null and empty texts, and texts without a sentence of three words, have
no subject; labels of unknown documents or subjects are ignored; without any label only
the descriptions teach.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerloom.session import small_rows, spread

_SENTENCE = re.compile(r"(?<=[.!?])\s+|\n+|\s*\|\s*")
_WORD = re.compile(r"[^\W\d_]+")
_ids: dict[str, int] = {}


@dataclass(frozen=True)
class Fit:
    """Parameters of the fit; ``documents`` bounds the labelled sample."""

    documents: int = 4000
    bits: int = 17
    epochs: int = 4
    steps: int = 60  # at least, however small the sample
    batch: int = 2048
    rate: float = 0.3
    l2: float = 1e-5
    sure: float = 0.5  # logit of a sentence that deals with a subject
    calibrating: int = 40  # held-out documents needed to calibrate thresholds, else the middle
    lowest: float = 0.125  # shares between these two don't occur
    highest: float = 0.2
    seed: int = 11


def sentences(text: str | None) -> list[list[str]]:
    """Sentences of at least three words; headings and table bars are no sentences."""
    if not text:
        return []
    parts = (p for p in _SENTENCE.split(text) if p and not p.startswith("#"))
    return [w for w in (_WORD.findall(p.lower()) for p in parts) if len(w) >= 3]


def features(tokens: list[str], bits: int) -> list[int]:
    """Hashed unigrams and bigrams."""
    if len(_ids) > 300_000:
        _ids.clear()
    mask, out, before = (1 << bits) - 1, [], 0
    for t in tokens:
        h = _ids.get(t)
        if h is None:
            h = _ids[t] = zlib.crc32(t.encode())
        out.append(h & mask)
        if before:
            out.append(((before * 0x9E3779B1 + h) >> 7) & mask)
        before = h
    return out


class Model:
    """Weights, biases and thresholds of all subjects."""

    def __init__(self, subjects: list[str], fit: Fit):
        self.subjects, self.fit = subjects, fit
        self.weights = np.zeros((1 << fit.bits, len(subjects)), np.float32)
        self.bias = np.full(len(subjects), -2.0, np.float32)
        self.limits = np.full(len(subjects), (fit.lowest + fit.highest) / 2)

    def scores(self, rows: list[list[int]]) -> np.ndarray:
        """A logit for each sentence and subject."""
        if not rows:
            return np.zeros((0, len(self.subjects)))
        sizes = np.array([len(r) for r in rows])
        flat = np.fromiter((x for r in rows for x in r), np.int64, sizes.sum())
        starts = np.concatenate([[0], np.cumsum(sizes)[:-1]])
        return np.add.reduceat(self.weights[flat], starts, axis=0) + self.bias

    def train(self, rows: list[list[int]], labels: np.ndarray) -> None:
        """Logistic regression of every subject against the rest, by AdaGrad."""
        fit, rng = self.fit, np.random.default_rng(self.fit.seed)
        self._start(rows, labels)
        seen = np.full(self.weights.shape, 1e-3, np.float32)
        bias_seen = np.full(len(self.subjects), 1e-3, np.float32)
        batches = -(-len(rows) // fit.batch)
        for _ in range(max(fit.epochs, fit.steps // batches)):
            order = rng.permutation(len(rows))
            for at in range(0, len(order), fit.batch):
                take = order[at : at + fit.batch]
                part = [rows[k] for k in take]
                gap = 1 / (1 + np.exp(-np.clip(self.scores(part), -30, 30))) - labels[take]
                sizes = np.array([len(r) for r in part])
                flat = np.fromiter((x for r in part for x in r), np.int64, sizes.sum())
                used, place = np.unique(flat, return_inverse=True)
                share = np.repeat(gap, sizes, axis=0)
                grad = np.stack([np.bincount(place, share[:, c], len(used)) for c in range(gap.shape[1])], 1) / len(take)
                grad += fit.l2 * self.weights[used]
                seen[used] += grad**2
                self.weights[used] -= fit.rate * grad / np.sqrt(seen[used])
                step = gap.mean(0)
                bias_seen += step**2
                self.bias -= (fit.rate * step / np.sqrt(bias_seen)).astype(np.float32)

    def _start(self, rows: list[list[int]], labels: np.ndarray) -> None:
        """Begin at the smoothed log odds of each feature, which few labels already give."""
        sizes = [len(r) for r in rows]
        flat = np.fromiter((x for r in rows for x in r), np.int64, sum(sizes))
        prior = (labels.mean(0) + 1e-3)[None, :]
        used, place = np.unique(flat, return_inverse=True)
        each = np.repeat(labels, sizes, axis=0)
        hits = np.stack([np.bincount(place, each[:, c], len(used)) for c in range(labels.shape[1])], 1)
        times = np.bincount(place, minlength=len(used))[:, None]
        odds = np.log((hits + prior) / (times * prior + prior))
        self.weights[:] = 0
        self.weights[used] = np.clip(odds, -1.0, 3.0) * (times > 1)
        self.bias[:] = -2.0

    def shares(self, text: str | None) -> np.ndarray:
        """The share of a document's sentences that deal with each subject."""
        rows = [features(s, self.fit.bits) for s in sentences(text)]
        if not rows:
            return np.zeros(len(self.subjects))
        return (self.scores(rows) > self.fit.sure).mean(0)  # each subject against the rest

    def calibrate(self, texts: list[str], truth: np.ndarray) -> None:
        """Thresholds between the stated bounds that give the best F1; of equals the middle."""
        low, high = self.fit.lowest, self.fit.highest
        grid = np.linspace(low, high, 16)[1:-1]
        middle = np.argsort(np.abs(grid - (low + high) / 2), kind="stable")
        shares = np.array([self.shares(t) for t in texts]).reshape(len(texts), len(self.subjects))
        for c in range(len(self.subjects)):
            best = -1.0
            for limit in grid[middle]:
                said = shares[:, c] >= limit
                hit = (said & truth[:, c]).sum()
                f1 = 2 * hit / max(1, said.sum() + truth[:, c].sum())
                if f1 > best + 1e-9:
                    best, self.limits[c] = f1, limit


def learn(labelled: list[tuple[str, set[str]]], described: list[tuple[str, str]], fit: Fit = Fit()) -> Model:
    """Fit on labelled documents ``(text, subjects)`` and descriptions ``(subject, text)``.

    Thresholds come from every fifth document, classified by a fit on the others; the
    model itself is then fitted on all.
    """
    model = _fitted(labelled, described, fit)
    held = labelled[::5]
    if len(held) >= fit.calibrating and model.subjects:
        trial = _fitted([x for k, x in enumerate(labelled) if k % 5], described, fit)
        trial.calibrate([t for t, _ in held], np.array([[s in have for s in model.subjects] for _, have in held]))
        model.limits = trial.limits
    return model


def _fitted(labelled: list[tuple[str, set[str]]], described: list[tuple[str, str]], fit: Fit) -> Model:
    subjects = sorted({s for s, _ in described})
    at = {s: k for k, s in enumerate(subjects)}
    model = Model(subjects, fit)
    docs = [(([features(s, fit.bits) for s in sentences(t)]), sorted(at[x] for x in have if x in at)) for t, have in labelled]
    taught = [(features(words, fit.bits), at[s]) for s, t in described for words in sentences((t or "") + ".")]

    def matrix(rows: list[tuple[list[int], int]]) -> tuple[list[list[int]], np.ndarray]:
        y = np.zeros((len(rows), len(subjects)), np.float32)
        for k, (_, c) in enumerate(rows):
            if c >= 0:
                y[k, c] = 1
        return [r for r, _ in rows], y

    first = taught + [(r, have[0] if have else -1) for rows, have in docs if len(have) < 2 for r in rows]
    if not first:
        return model
    model.train(*matrix(first))
    for _ in range(2):
        again = list(taught)
        for rows, have in docs:
            for r, s in zip(rows, model.scores(rows)):
                best = int(s.argmax())
                if s[best] <= -1 or (best not in have and s[best] <= 1):
                    inside = max(have, key=lambda c: s[c], default=-1)
                    best = inside if inside >= 0 and s[inside] > -1 else -1
                again.append((r, best))
        model.train(*matrix(again))
    return model


def labelled_sample(docs: DataFrame, labels: DataFrame, most: int) -> list[tuple[str, set[str]]]:
    """At most ``most`` labelled documents by the hash of their id, with all their labels."""
    known = labels.where("doc_id is not null and subject is not null").groupBy("doc_id").agg(F.collect_set("subject").alias("subjects"))
    chosen = known.orderBy(F.xxhash64("doc_id"), "doc_id").limit(most)  # a top-k, not a sort of all
    rows = docs.select("doc_id", "text").where("text is not null").join(F.broadcast(chosen), "doc_id").orderBy("doc_id").collect()  # at most `most` rows
    return [(r["text"], set(r["subjects"])) for r in rows]


def subjects_of(docs: DataFrame, labels: DataFrame, areas: DataFrame, fit: Fit = Fit()) -> DataFrame:
    """``(doc_id, subject, share)`` for each subject of each document; one scan, no shuffle."""
    described = [(r["subject"], r["description"]) for r in small_rows(areas.where("subject is not null"), 1000, "the table of subjects")]
    model = learn(labelled_sample(docs, labels, fit.documents), described, fit)
    shared = docs.sparkSession.sparkContext.broadcast(model)  # 2**bits weights a subject

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value
        for batch in batches:
            ids, names, shares = [], [], []
            for d, t in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                share = model.shares(t)
                for c in np.flatnonzero((share >= model.limits) & (share > 0)):
                    ids.append(d)
                    names.append(model.subjects[c])
                    shares.append(float(share[c]))
            yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(names, pa.string()), pa.array(shares, pa.float64())], names=["doc_id", "subject", "share"])

    return spread(docs.select(F.col("doc_id").cast("bigint"), "text")).mapInArrow(run, "doc_id bigint, subject string, share double")


def composition(docs: DataFrame, labels: DataFrame, areas: DataFrame, fit: Fit = Fit()) -> DataFrame:
    """Documents of each subject, and their share of all documents that have any text."""
    found = subjects_of(docs, labels, areas, fit).groupBy("subject").agg(F.count(F.lit(1)).alias("documents"), F.avg("share").alias("mean_share"))
    total = docs.where("text is not null").agg(F.count(F.lit(1)).alias("all_documents"))
    return found.join(F.broadcast(total)).withColumn("corpus_share", F.col("documents") / F.col("all_documents"))  # one row
