"""Evaluation texts leaking into training text: MinHash containment search.

Short test items are searched inside long documents by size-partitioned MinHash
signatures over word shingles, and every candidate is verified exactly.

* Items are partitioned by size, a partition for each doubling of their shingles.  Each
  reads documents whole, as overlapping windows a few times as long as its items, with as
  many hash functions as the containment threshold needs for a window of that size (an
  item makes up a smaller share of a larger window's signature).  So a long item costs
  the search for short ones nothing.
* A window is signed by those of its shingles that may be any item's, if they are as many
  as the partition's least item must share with it; a table of bits tells that for a whole
  batch at once.  Other shingles can only hide an agreement, so no pair is lost by it and
  fewer functions do.
* A pair is a candidate if enough of the functions agree.  With ``expected`` agreements at
  the threshold and ``needed`` asked for, the chance to miss a pair at the threshold is
  the lower tail of a Poisson law (12 and 5: below one percent, and vanishing above it).
* Verification: exact shingle containment in the whole document, then the share of the
  item's words that occur in order, apart from single changed words.

The items are a stated query set searched against all documents in blocks of a bounded
size; one block is what travels to the workers, and is searched in one scan.

Defined results: null or empty documents and items without words hold and leak nothing; an
item shorter than a shingle is compared as one shingle of all its words.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerloom.session import spread

#: A mark within a word is left out with or without the line break after a hyphen.
_WORD = re.compile(r"[^\W_]+(?:(?:[.'’‐]|-(?:[ \t]*[\r\n]\s*)?)[^\W_]+)*")
_MARK = re.compile(r"[\W_]+")


class _Ids(dict):
    """32-bit ids of words, computed once a word."""

    def __missing__(self, word: str) -> int:
        self[word] = zlib.crc32(word.encode())
        return self[word]


_ids = _Ids()


@dataclass(frozen=True)
class Search:
    """Parameters of the search."""

    shingle: int = 5
    containment: float = 0.2  # of an item's shingles, asked of candidates
    share: float = 0.5  # of an item's words, asked of results
    expected: int = 12
    needed: int = 5
    stretch: int = 4  # a window's length in lengths of the partition's longest item
    block: int = 50_000  # items a scan
    chunk: int = 2_000_000  # words held at once
    seed: int = 20240601


def words(text: str) -> list[str]:
    """Lower-case words; ``cross-validated`` and ``2.5`` are one word, also where their mark
    was lost with the punctuation."""
    return [w if w.isalnum() else _MARK.sub("", w) for w in _WORD.findall(text.lower())]


def word_ids(tokens: list[str]) -> np.ndarray:
    """Ids of words; their memory is emptied before it can grow without bound."""
    if len(_ids) > 500_000:
        _ids.clear()
    return np.fromiter(map(_ids.__getitem__, tokens), np.uint64, len(tokens))


def mixed(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser, so that sums of ids become hashes."""
    x = (x ^ (x >> np.uint64(31))) * np.uint64(0x9E3779B97F4A7C15)
    x = (x ^ (x >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
    return x ^ (x >> np.uint64(32))


def shingles(ids: np.ndarray, size: int) -> np.ndarray:
    """Hashes of all runs of ``size`` words, by position."""
    if not len(ids):
        return ids
    size = min(size, len(ids))
    n = len(ids) - size + 1
    h = np.zeros(n, np.uint64)
    for k in range(size):
        h = mixed(h * np.uint64(0x100000001B3) + ids[k : k + n] + np.uint64(k + 1))
    return h


def family(count: int, seed: int) -> tuple[np.ndarray, np.ndarray]:
    rng = np.random.default_rng(seed)
    a = rng.integers(1, 2**63, count, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
    return a[:, None], rng.integers(0, 2**63, count, dtype=np.uint64)[:, None]


def signature(hashes: np.ndarray, fam: tuple[np.ndarray, np.ndarray], count: int) -> np.ndarray:
    """The least value of each of the first ``count`` functions, by 32 high bits."""
    low = np.full(count, np.iinfo(np.uint64).max, np.uint64)
    for at in range(0, len(hashes), 512):
        part = hashes[None, at : at + 512]
        low = np.minimum(low, (part * fam[0][:count] + fam[1][:count]).min(axis=1))
    return low >> np.uint64(32)


def functions_for(size: int, least: int, search: Search) -> int:
    """Hash functions so that ``expected`` agree for an item of ``least`` shingles at the
    threshold, in a window of ``size``."""
    shared = search.containment * least
    return int(np.ceil(search.expected * (size + least - shared) / shared))


def in_order(item: np.ndarray, doc: np.ndarray, run: int = 5) -> float:
    """Words of the item that the document reproduces in order.

    Equal runs of at least ``run`` words are joined over single changed words, lengthened
    by shorter runs beyond a single changed word, and the heaviest chain of runs is taken
    that goes forward in both texts.
    """
    n, m = len(item), len(doc)
    run = min(run, n)
    at: dict[int, list[int]] = {}
    for i, h in enumerate(shingles(item, run).tolist()):
        at.setdefault(h, []).append(i)
    diagonals: dict[int, list[int]] = {}
    for j, h in enumerate(shingles(doc, run).tolist()):
        for i in at.get(h, ()):
            diagonals.setdefault(j - i, []).append(i)
    blocks = []
    for d, starts in diagonals.items():
        starts.sort()
        first = last = None
        for i in starts:
            if last is not None and i <= last + 2:
                last = max(last, i + run - 1)
            else:
                if last is not None:
                    blocks.append((first, last, d))
                first, last = i, i + run - 1
        blocks.append((first, last, d))
    blocks = [_lengthened(b, item, doc, n, m) for b in blocks]
    blocks.sort(key=lambda b: (b[1], b[1] + b[2]))
    best: list[int] = []
    for k, (first, last, d) in enumerate(blocks):
        most = last - first + 1
        for p in range(k):
            f, e, g = blocks[p]
            if e < last and e + g < last + d:
                overlap = max(0, e - first + 1, e + g - (first + d) + 1)
                if overlap < last - first + 1:
                    most = max(most, best[p] + last - first + 1 - overlap)
        best.append(most)
    return float(max(best, default=0))


def _lengthened(block: tuple[int, int, int], item: np.ndarray, doc: np.ndarray, n: int, m: int) -> tuple[int, int, int]:
    """A run, lengthened on its diagonal over single changed words to both sides; a changed
    first or last word of the item counts if the document has a word in its place."""
    first, last, d = block
    while last + 1 < n and last + 1 + d < m:
        if item[last + 1] == doc[last + 1 + d]:
            last += 1
        elif last + 2 == n:
            last += 1
        elif last + 2 + d < m and item[last + 2] == doc[last + 2 + d]:
            last += 2
        else:
            break
    while first > 0 and first - 1 + d >= 0:
        if item[first - 1] == doc[first - 1 + d]:
            first -= 1
        elif first == 1:
            first = 0
        elif first - 2 + d >= 0 and item[first - 2] == doc[first - 2 + d]:
            first -= 2
        else:
            break
    return first, last, d


class Partition:
    """Items of one size: their signatures, and the windows that documents are read in."""

    def __init__(self, run: int, members: list[int], unique: list[np.ndarray], longest: int, search: Search):
        self.search, self.run = search, run
        self.least = min(len(u) for u in unique)
        self.need = max(1, int(np.ceil(search.containment * self.least - 1e-9)))
        self.overlap = longest + run
        self.window = search.stretch * self.overlap
        count = functions_for(self.window, self.least, search)
        self.family = family(count, search.seed)
        high = np.arange(count, dtype=np.uint64) << np.uint64(32)
        keys = np.concatenate([high | signature(u, self.family, count) for u in unique])
        order = np.argsort(keys, kind="stable")
        self.keys, self.owners = keys[order], np.repeat(np.array(members), count)[order]

    def candidates(self, hashes: np.ndarray, hit: np.ndarray) -> set[int]:
        """Items that enough functions agree on, in any window with enough hits."""
        found: set[int] = set()
        total = np.concatenate([[0], np.cumsum(hit)])
        for at in range(0, max(1, len(hashes) - self.overlap), self.window - self.overlap):
            end = min(len(hashes), at + self.window)
            if total[end] - total[at] < self.need:
                continue
            part = np.unique(hashes[at:end][hit[at:end]])
            if len(part) < self.need:
                continue
            count = min(functions_for(len(part), self.least, self.search), self.family[0].shape[0])
            asked = (np.arange(count, dtype=np.uint64) << np.uint64(32)) | signature(part, self.family, count)
            left, right = np.searchsorted(self.keys, asked, "left"), np.searchsorted(self.keys, asked, "right")
            some = right > left
            if some.any():
                own, times = np.unique(np.concatenate([self.owners[a:b] for a, b in zip(left[some], right[some])]), return_counts=True)
                found |= set(own[times >= self.search.needed].tolist())
        return found


class Index:
    """Partitions, shingle sets and words of one block of items."""

    def __init__(self, items: list[tuple[int, str]], search: Search):
        self.search = search
        read = [(i, word_ids(words(t or ""))) for i, t in items]
        read = [(i, w) for i, w in read if len(w)]
        self.ids = [i for i, _ in read]
        self.words = [w for _, w in read]
        unique = [np.unique(shingles(w, search.shingle)) for w in self.words]
        self.sets = [frozenset(u.tolist()) for u in unique]
        # an item of one word repeated has few shingles but is as long as it is
        groups: dict[tuple[int, int, int], list[int]] = {}
        for k, w in enumerate(self.words):
            groups.setdefault((min(search.shingle, len(w)), len(unique[k]).bit_length(), len(w).bit_length()), []).append(k)
        self.partitions = [Partition(run, g, [unique[k] for k in g], max(len(self.words[k]) for k in g), search) for (run, _, _), g in sorted(groups.items())]
        self.runs = sorted({p.run for p in self.partitions})
        # bits of the items' shingles by their high bits, sparse enough to be mostly unset
        self.bits: dict[int, np.ndarray] = {}
        for run in self.runs:
            known = np.concatenate([u for u, w in zip(unique, self.words) if min(search.shingle, len(w)) == run])
            width = max(16, int(len(known) * 64).bit_length())
            table = np.zeros(1 << width, bool)
            table[known >> np.uint64(64 - width)] = True
            self.bits[run] = table

    def hits(self, hashes: np.ndarray, run: int) -> np.ndarray:
        table = self.bits[run]
        return table[hashes >> np.uint64(65 - len(table).bit_length())]

    def leaks(self, text: str) -> list[tuple[int, float, float]]:
        """Items that a text reproduces: (item, shingle containment, share of words)."""
        return [hit[1:] for hit in self.leaks_in([(0, text)])]

    def leaks_of(self, ids: np.ndarray, read: dict[int, tuple[np.ndarray, np.ndarray]]) -> list[tuple[int, float, float]]:
        """The same of a document's words and, by run, its shingles and which are hits."""
        found: set[int] = set()
        mine: dict[int, set[int]] = {}
        for run in self.runs:
            hashes, hit = read[run]
            mine[run] = set(hashes[hit].tolist())
            for p in self.partitions:
                if p.run == run:
                    found |= p.candidates(hashes, hit)
        out = []
        for k in sorted(found):
            item, own = self.words[k], self.sets[k]
            contained = len(own & mine[min(self.search.shingle, len(item))]) / len(own)
            if contained >= self.search.containment and (kept := in_order(item, ids)) >= self.search.share * len(item):
                out.append((self.ids[k], contained, kept / len(item)))
        return out

    def leaks_in(self, docs: list[tuple[int, str]]) -> Iterator[tuple[int, int, float, float]]:
        """``(doc, item, containment, share)`` of many documents.  Their words are hashed as
        one array; documents without enough hits for any partition end there."""
        held: list[tuple[int, list[str]]] = []
        size = 0
        for k, (doc, text) in enumerate(docs):
            tokens = words(text)
            held.append((doc, tokens))
            size += len(tokens)
            if size >= self.search.chunk or k + 1 == len(docs):
                yield from self._chunk(held)
                held, size = [], 0

    def _chunk(self, held: list[tuple[int, list[str]]]) -> Iterator[tuple[int, int, float, float]]:
        lengths = np.array([len(t) for _, t in held])
        ids = word_ids([w for _, t in held for w in t])
        ends = np.cumsum(lengths)
        owner = np.repeat(np.arange(len(held)), lengths)
        enough = np.zeros(len(held), bool)
        flat: dict[int, tuple[np.ndarray, np.ndarray]] = {}
        for run in self.runs:
            if len(ids) < run:
                flat[run] = (ids[:0], np.zeros(0, bool))
                continue
            hashes = shingles(ids, run)
            hit = self.hits(hashes, run)
            flat[run] = (hashes, hit)
            own = owner[: len(hit)]
            inside = own == owner[run - 1 :]  # no run over the end of a document
            counts = np.bincount(own[hit & inside], minlength=len(held))
            enough |= counts >= min(p.need for p in self.partitions if p.run == run)
        for k in np.flatnonzero(enough):
            a, b = ends[k] - lengths[k], ends[k]
            read = {run: (h[a : max(a, b - run + 1)], hit[a : max(a, b - run + 1)]) for run, (h, hit) in flat.items()}
            for hit_ in self.leaks_of(ids[a:b], read):
                yield (held[k][0], *hit_)


def leaked(docs: DataFrame, items: DataFrame, search: Search = Search()) -> DataFrame:
    """``(doc_id, item_id, containment, share)`` for each item that leaked into a document.

    One scan of the documents for each block of items, no shuffle; nothing about the
    documents reaches the driver.
    """
    blocks = _blocks(items, search.block)
    spark = docs.sparkSession
    parts = []
    for block in blocks:
        shared = spark.sparkContext.broadcast(Index(block, search))

        def run(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            index = shared.value
            for batch in batches:
                rows = list(index.leaks_in([(d, t) for d, t in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()) if t]))
                columns = [pa.array([r[k] for r in rows], pa.int64() if k < 2 else pa.float64()) for k in range(4)]
                yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "item_id", "containment", "share"])

        texts = spread(docs.select(F.col("doc_id").cast("bigint"), "text"))
        parts.append(texts.mapInArrow(run, "doc_id bigint, item_id bigint, containment double, share double"))
    if not parts:
        return docs.sparkSession.createDataFrame([], "doc_id bigint, item_id bigint, containment double, share double")
    return reduce(DataFrame.unionByName, parts)


def _blocks(items: DataFrame, size: int) -> Iterator[list[tuple[int, str]]]:
    """The query set in blocks of a bounded size."""
    block: list[tuple[int, str]] = []
    for row in items.select("item_id", "passage").where("passage is not null").toLocalIterator():
        block.append((row[0], row[1]))
        if len(block) == size:
            yield block
            block = []
    if block:
        yield block
