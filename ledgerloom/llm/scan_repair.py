"""Noise in text from scanned pages: cut words, misread characters, page furniture.

Two averaged perceptrons are trained here, on the texts themselves:

* a *character editor* that reads a text's doubtful places and predicts an operation for
  each: a character of a word is kept, replaced, deleted or has others inserted, and a hyphen
  at a line's end is taken out (the line-join operation) or kept.  It learns the characters
  from pairs of a rare and a common word that differ in one place by a substitution which
  many such pairs share, and joins from known words cut anywhere and known compounds
  parted at their hyphen;
* a *line classifier* with features of shape and page position that tells page numbers and
  page headings from text, learnt from lines that repeat a document's title, from lines that the corpus repeats with other numbers, and from running text.

What the editor proposes is accepted only if it is a known word.  Known words are counted
over all texts and kept as a table, as are the repairs of the distinct unknown words: both
are broadcast below a checked size and joined to each text's words beyond it.  Word pairs
are mined by an equality join on words with a hole, over all words.  Fits use a bounded
sample of lines and pairs; every text is processed whole.

Defined results: null texts have no defects and stay null; a text of one line has no
furniture; equal texts get equal results.
"""

from __future__ import annotations

import random
import re
from collections import Counter, defaultdict
from collections.abc import Callable, Iterable, Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerloom.llm.confusables import LookAlikes, canonical_text, look_alikes
from ledgerloom.session import cut, spread

DEFECTS = ("hyphenation", "misread", "header", "page_number")
JOIN, KEEP = "<join>", "<keep>"


@dataclass(frozen=True)
class Fit:
    """Parameters; the first four bound the labelled samples of the fits."""

    lines: int = 40_000
    texts: int = 3000
    longest: int = 20_000  # characters of a sampled text
    pairs: int = 6000
    least: int = 4  # occurrences of a known word
    ratio: int = 15  # how much more frequent the right word is than its misreading
    support: int = 3  # words that share a substitution, and of all words with a partner one in
    of_words: int = 300
    places: int = 4  # characters of a word that may be edited
    broadcast: int = 500_000  # words and repairs; more are joined
    epochs: int = 4
    seed: int = 5


class Perceptron:
    """Multi-class averaged perceptron over sets of string features."""

    def __init__(self) -> None:
        self.weights: dict[str, dict[str, float]] = {}
        self.classes: set[str] = set()
        self.dense: tuple[list[str], dict[str, tuple[float, ...]]] | None = None  # of few classes, once trained

    def scores(self, feats: Iterable[str]) -> dict[str, float]:
        out: dict[str, float] = defaultdict(float)
        for f in feats:
            for c, w in self.weights.get(f, {}).items():
                out[c] += w
        return out

    def best(self, feats: Iterable[str], default: str) -> str:
        if self.dense:
            order, weights = self.dense
            rows = [w for f in feats if (w := weights.get(f))]
            return max((total, c == default, c) for total, c in zip(map(sum, zip(*rows)), order))[2] if rows else default
        s = self.scores(feats)
        return max(s, key=lambda c: (s[c], c == default, c)) if s else default

    def train(self, rows: list[tuple[list[str], str]], epochs: int, seed: int) -> None:
        rng, step = random.Random(seed), 0
        totals: dict[tuple[str, str], float] = defaultdict(float)
        when: dict[tuple[str, str], int] = defaultdict(int)
        self.classes, self.dense = {c for _, c in rows}, None
        default = Counter(c for _, c in rows).most_common(1)[0][0] if rows else ""

        def move(f: str, c: str, by: float) -> None:
            w = self.weights.setdefault(f, {})
            totals[f, c] += (step - when[f, c]) * w.get(c, 0.0)
            when[f, c] = step
            w[c] = w.get(c, 0.0) + by

        for _ in range(epochs):
            rng.shuffle(rows)
            for feats, truth in rows:
                step += 1
                said = self.best(feats, default)
                if said != truth:
                    for f in feats:
                        move(f, truth, 1.0)
                        move(f, said, -1.0)
        for (f, c), total in totals.items():
            w = self.weights[f]
            w[c] = (total + (step - when[f, c]) * w[c]) / max(1, step)
        if len(self.classes) <= 4:
            order = sorted(self.classes)
            self.dense = (order, {f: tuple(w.get(c, 0.0) for c in order) for f, w in self.weights.items()})


# --- the character editor -------------------------------------------------------------


def edits(wrong: str, right: str) -> list[str]:
    """For each character of the wrong word what it should be."""
    i = 0
    while i < min(len(wrong), len(right)) and wrong[i] == right[i]:
        i += 1
    j = 0
    while j < min(len(wrong), len(right)) - i and wrong[-1 - j] == right[-1 - j]:
        j += 1
    out = list(wrong)
    middle = range(i, len(wrong) - j)
    for n, k in enumerate(middle):
        out[k] = right[i : len(right) - j] if n == 0 else ""
    return out


def char_features(word: str, i: int) -> list[str]:
    w = f"^^^{word}$$$"
    k = i + 3
    return [
        f"c{w[k]}", f"l{w[k - 1 : k + 1]}", f"r{w[k : k + 2]}", f"m{w[k - 1 : k + 2]}", f"L{w[k - 2 : k + 1]}", f"R{w[k : k + 3]}",
        f"M{w[k - 2 : k + 3]}", f"A{w[k - 3 : k + 1]}", f"B{w[k : k + 4]}", f"d{w[k].isdigit()}{w[k - 1].isalpha()}{w[k + 1].isalpha()}{w[k]}",
    ]


# --- lines ------------------------------------------------------------------------------

_BREAK = re.compile(r"\r\n|\r|\n|\f")
_NUMBER = re.compile(r"^\W*(?:page|p|pp|seite|s|pg)?\W*\d{1,5}(?:\s*(?:of|/|von|out of)\s*\d{1,5})?\W*$", re.I)
_LETTER = re.compile(r"[^\W\d_]")
_DIGIT = re.compile(r"\d")
_OF = re.compile(r"\b(?:of|OF)\s\S+(?:\s\S+)?:")
_GAP = re.compile(r"\s{2,}\d+$|^\d+\s{2,}")
_ISSUE = re.compile(r"\b(?:no|vol|nr)\.\s*\d", re.I)
_WORDS, _TOP, _BOTTOM = ([f"{n}={k}" for k in range(13)] for n in ("words", "top", "bottom"))
_FIXED = ("Title:", "#", "===")
_TOKEN = re.compile(r"[^\W_]+")
_PART = re.compile(r"(?<![^\W_])([^\W\d_][^\W_]*)[-¬]\Z")
_HEAD = re.compile(r"^[^\W_]+")
_COMPOUND = re.compile(r"[^\W_]+(?:-[^\W_]+)*")
_CUT = re.compile(r"[-¬][ \t]*[\r\n\f]")
_PIECES = re.compile(r"(?<![^\W_])[^\W_]+[-¬][ \t]*[\r\n\f]\s*[^\W_]+")


def masked(line: str) -> str:
    """A line without case and numbers at its ends, numbers inside masked."""
    line = line.strip()
    if _DIGIT.search(line):
        line = re.sub(r"\d+", "0", re.sub(r"^\s*\d+\s+|\s+\d+\s*$", "", line))
    return line.casefold()


def page_lines(text: str) -> list[str]:
    return _BREAK.split(text)


def may_be_furniture(line: str) -> bool:
    """Whether the classifier is asked: no blank line, heading mark or cut word."""
    x = line.strip()
    return bool(x) and not x.startswith(_FIXED) and (x[-1] not in "-¬," or _NUMBER.match(x) is not None)


class Page:
    """The lines of a text, and what all of them say about each."""

    def __init__(self, lines: list[str]):
        self.lines = [x.strip() for x in lines]
        self.asked = [may_be_furniture(x) for x in self.lines]
        self.masks = [masked(x) if a else "" for x, a in zip(self.lines, self.asked)]
        self.repeats = Counter(self.masks)
        self.short = 0.8 * max((len(x) for x in lines), default=0)

    def features(self, k: int) -> list[str]:
        """Shape and page position of a line."""
        lines = self.lines
        x, size = lines[k], len(lines)
        before = lines[k - 1] if k else ""
        if k and not before:
            before = next((lines[j] for j in range(k - 2, -1, -1) if lines[j]), "")
        after = lines[k + 1] if k + 1 < size else ""
        if k + 1 < size and not after:
            after = next((lines[j] for j in range(k + 2, size) if lines[j]), "")
        first, last, words = x[0], x[-1], x.count(" ") + 1
        digits, letters = _DIGIT.search(x) is not None, _LETTER.search(x) is not None
        ends = "ends=" + ("none" if not before else "stop" if before[-1] in ".!?:\"”)" else "cut" if before[-1] in "-¬" else "open")
        on, off, marks = [], [], []
        # marks of headings and numbers; what goes together with them tells one from the other
        if digits and last != "." and _NUMBER.match(x):
            marks.append("number")
        else:
            off.append("!number")
        if len(x) > 6 and x.isupper():
            marks.append("caps")
        else:
            off.append("!caps")
        if ":" in x and _OF.search(x):
            marks.append("of")
        else:
            off.append("!of")
        if x.rstrip("0123456789 ").endswith("..."):
            marks.append("dots")
        if digits and _GAP.search(x):
            marks.append("gap")
        if digits and _ISSUE.search(x):
            marks.append("no")
        if len(x) > 8 and self.repeats[self.masks[k]] > 1:
            marks.append("repeats")
        on.append("stop") if last in ".!?" and not x.endswith("...") else off.append("!stop")
        on.append("lower") if first.islower() else off.append("!lower")
        on.append("few") if words <= 8 else off.append("!few")
        on.append("short") if len(x) < self.short else off.append("!short")
        if not letters:
            on.append("only0")
        elif last.isdigit():
            on.append("num_end")
        if first.isdigit():
            on.append("num_begin")
        if (k == 0 or not lines[k - 1]) and (k + 1 >= size or not lines[k + 1]):
            on.append("alone")
        if k == 0 or k + 1 == size:
            on.append("edge")
        if after[:1].islower():
            on.append("after_lower")
        feats = ["bias", ends, _WORDS[min(words, 12)], _TOP[min(k, 4)], _BOTTOM[min(size - 1 - k, 4)], *on, *off, *marks]
        if len(x) < 14:
            feats.append("shape=" + re.sub(r"[^\W\d_]+", "a", re.sub(r"\d+", "0", x)))
        if not marks:
            feats.append("unmarked")
        for m in marks:
            feats += [f"{m}&{n}" for n in (*on, *marks, ends) if m != n]
        return feats


# --- the editor and the classifier ------------------------------------------------------


class Model:
    """The two perceptrons."""

    def __init__(self, fit: Fit = Fit()):
        self.fit = fit
        self.editor, self.liner = Perceptron(), Perceptron()
        self.options: dict[str, set[str]] = {}  # what the editor has learnt of each character
        self.margin = 0.0

    def teach(self, pairs: list[tuple[str, str]], known: dict[str, int], samples: list[str]) -> Model:
        """Fit on word pairs (misread, right), frequent known words and sampled texts."""
        rng = random.Random(self.fit.seed)
        words = sorted(known, key=lambda w: (-known[w], w))
        rows = [(char_features(w, i), e) for w, r in pairs for i, e in enumerate(edits(w, r))]
        rows += [(char_features(w, i), c) for w in [w for w in words if "-" not in w][: max(500, len(pairs) // 2)] for i, c in enumerate(w)]
        for w, r in pairs:
            for c, e in zip(w, edits(w, r)):
                if c != e:
                    self.options.setdefault(c, set()).add(e)
        lexicon = Lexicon(known, {}, self)
        plain = [w for w in words if w.isalpha() and len(w) > 4][:3000]
        compounds = [w for w in words if w.count("-") == 1][:3000]
        for w in plain:
            i = rng.randrange(2, len(w) - 1)
            rows.append((join_features(lexicon, w[:i], w[i:], "¬" if rng.random() < 0.4 else "-"), JOIN))
        for k in range(len(plain) if compounds else 0):
            a, _, b = compounds[k % len(compounds)].partition("-")
            rows.append((join_features(lexicon, a, b, "-"), KEEP))
        self.editor.train(rows, self.fit.epochs, self.fit.seed)
        gains = sorted(self.gain(w, edits(w, r)) for w, r in pairs)
        # what nearly all pairs of the fit reach
        self.margin = min(0.0, gains[len(gains) // 50]) if gains else 0.0
        self._teach_liner(samples)
        return self

    def gain(self, word: str, ops: list[str]) -> float:
        """How much better the editor likes operations than to keep the word."""
        total = 0.0
        for i, (c, e) in enumerate(zip(word, ops)):
            if e != c:
                s = self.editor.scores(char_features(word, i))
                total += s.get(e, 0.0) - s.get(c, 0.0)
        return total

    def readings(self, word: str) -> dict[str, float]:
        """Everything the editor may make of a word with a gain above the margin, by up to
        ``Fit.places`` edited characters."""
        if word.isdigit() or len(word) < 2 or (len(word) < 4 and word.isalpha()):
            return {}
        options: list[tuple[float, int, str]] = []
        best = [0.0] * len(word)
        for i, c in enumerate(word):
            if seen := self.options.get(c):
                s = self.editor.scores(char_features(word, i))
                stay = s.get(c, 0.0)
                for e in seen:
                    g = s.get(e, 0.0) - stay
                    options.append((g, i, e))
                    best[i] = max(best[i], g)
        # what the other places can still add
        hope = sum(sorted(best, reverse=True)[: self.fit.places - 1])
        options = sorted((o for o in options if o[0] + hope >= self.margin), key=lambda o: -o[0])
        found: dict[str, float] = {}
        todo: list[tuple[float, int, dict[int, str]]] = [(0.0, 0, {})]
        while todo:
            total, start, done = todo.pop()
            left = self.fit.places - len(done)
            for k in range(start, len(options)):
                g, i, e = options[k]
                now = total + g
                # options come best first: neither this nor a later one reaches the margin
                if now + max(0.0, g) * (left - 1) < self.margin:
                    break
                if i in done:
                    continue
                more = {**done, i: e}
                if now >= self.margin:
                    out = "".join(more.get(j, c) for j, c in enumerate(word))
                    if out and now > found.get(out, float("-inf")):
                        found[out] = now
                if left > 1:
                    todo.append((now, k + 1, more))
        found.pop(word, None)
        return found

    def joins(self, lexicon: Lexicon, left: str, right: str, mark: str) -> bool:
        """The editor's operation for a mark at a line's end."""
        s = self.editor.scores(join_features(lexicon, left, right, mark))
        return s.get(JOIN, 0.0) > s.get(KEEP, 0.0)

    def _teach_liner(self, samples: list[str]) -> None:
        common = Counter(m for t in samples for m in {masked(x) for x in page_lines(t) if may_be_furniture(x)})
        often = max(3, len(samples) // 100)
        titles = {masked(x[6:]) for t in samples for x in page_lines(t) if x.startswith("Title:")}
        rows: list[tuple[list[str], str]] = []
        for text in samples:
            lines = page_lines(text)
            if len(lines) < 2:
                continue
            title = next((x[6:].strip().casefold() for x in lines if x.startswith("Title:")), "")
            page = Page(lines)
            for k, x in enumerate(page.lines):
                if not page.asked[k]:
                    continue
                y = page.masks[k]
                short = y.rstrip(". ")
                if _NUMBER.match(x) and not x.endswith("."):
                    label = "page_number"
                elif len(short) > 8 and (y in titles or (title and y.endswith("...") and title.startswith(short))):
                    label = "header"
                elif common[y] >= often and len(y) > 8 and "0" in y and not x.endswith((".", "?", "!")):
                    label = "header"
                elif x[:1].islower() or (k == 0 and page.lines[1][:1].islower()) or (not x.endswith("...") and (title or (x[-1:] in ".!?" and k + 1 == len(lines)))):
                    label = "text"
                else:
                    continue
                rows.append((page.features(k), label))
        self.liner.train(rows[: self.fit.lines], self.fit.epochs, self.fit.seed)

    def furniture(self, lines: list[str]) -> dict[int, str]:
        """Lines that are page furniture, by what they are."""
        out: dict[int, str] = {}
        if len(lines) > 1:
            page = Page(lines)
            for k in range(len(lines)):
                if page.asked[k] and (label := self.liner.best(page.features(k), "text")) != "text":
                    out[k] = label
        return out


class Lexicon:
    """Known words with their counts, and the repairs of unknown ones."""

    def __init__(self, known: dict[str, int], fixes: dict[str, str], model: Model):
        self.known, self.fixes, self.model = known, fixes, model
        self._others: dict[str, str | None] = {}

    def fix(self, word: str) -> str | None:
        """The known word that a lower-case word is a misreading of, or None."""
        if word in self.known:
            return None
        if word in self.fixes:
            return self.fixes[word]
        if word not in self._others:  # no word of the corpus: two parts put together
            if len(self._others) > 100_000:
                self._others.clear()
            self._others[word] = self.best(self.model.readings(word))
        return self._others[word]

    def best(self, readings: dict[str, float]) -> str | None:
        return max(((g, self.known[w], w) for w, g in readings.items() if w in self.known), default=(0, 0, None))[2]


def join_features(lexicon: Lexicon, left: str, right: str, mark: str) -> list[str]:
    whole, compound = left + right, f"{left}-{right}"
    k, c = lexicon.known.get(whole, 0), lexicon.known.get(compound, 0)
    fixable = not k and lexicon.fix(whole) is not None
    parts = left in lexicon.known and right in lexicon.known
    return ["join", f"k{k > 0}", f"c{c > 0}", f"f{fixable}", f"p{parts}", f"k{k > 0}c{c > 0}more{k > c}", f"k{k > 0}f{fixable}c{c > 0}p{parts}", f"mark{mark}", f"jl{left[-2:]}", f"jr{right[:2]}", f"mark{mark}c{c > 0}", f"mark{mark}k{k > 0}"]


def assembled(lines: list[str], page: dict[int, str], joins: Callable[[str, str, str], bool]) -> tuple[bool, list[str]]:
    """Paragraphs without furniture, cut words joined as ``joins`` says; and whether any was."""
    joined = False
    paragraphs: list[str] = []
    held, gap, page_break = "", False, False
    for k, line in enumerate(lines):
        if k in page:
            page_break = True
            continue
        x = line.strip()
        if not x:
            gap = True
            continue
        fixed = x.startswith(_FIXED)
        cut_ = _PART.search(held) if held[-1:] in ("-", "¬") else None
        head = _HEAD.match(x)
        if held and not fixed and cut_ and head and (not gap or page_break or k + 1 < len(lines)) and head[0][0].isalpha():
            if joins(cut_[1].lower(), head[0].lower(), held[-1]):
                joined = True
                held = held[:-1] + x
            else:
                held += x
        elif held and not fixed and not held.startswith(_FIXED) and (not gap or (page_break and held[-1] not in ".!?:")):
            held += " " + x
        else:
            if held:
                paragraphs.append(held)
            held = x
        gap = page_break = False
    if held:
        paragraphs.append(held)
    return joined, paragraphs


def analyse(text: str, model: Model, lexicon: Lexicon) -> tuple[set[str], str]:
    """Defects of a readable text, and its continuous paragraphs."""
    lines = page_lines(text)
    page = model.furniture(lines)
    found = set(page.values())
    joined, paragraphs = assembled(lines, page, lambda a, b, mark: model.joins(lexicon, a, b, mark))
    if joined:
        found.add("hyphenation")
    whole = "\n\n".join(paragraphs)
    better: dict[str, str] = {}
    for word in set(_TOKEN.findall(whole.lower())) - lexicon.known.keys():
        if (right := lexicon.fix(word)) is not None:
            better[word] = right
    if better:
        found.add("misread")
        whole = _TOKEN.sub(lambda m: _cased(m[0], better[m[0].lower()]) if m[0].lower() in better else m[0], whole)
    return found, whole


def needed(text: str, model: Model) -> list[str]:
    """Words whose count or repair an analysis of a text may ask for."""
    lines = page_lines(text)
    asked: set[str] = set()

    def ask(left: str, right: str, mark: str) -> bool:
        asked.update((left, right, left + right, f"{left}-{right}", *model.readings(left + right)))
        return True

    # joined or kept, each word of either text is asked for
    for joins in (ask, lambda *_: False):
        for p in assembled(lines, model.furniture(lines), joins)[1]:
            asked.update(_TOKEN.findall(p.lower()))
    return sorted(asked)


def _cased(before: str, after: str) -> str:
    if before.isupper() and len(before) > 1:
        return after.upper()
    return after[:1].upper() + after[1:] if before[:1].isupper() else after


# --- over tables ------------------------------------------------------------------------


def word_counts(texts: DataFrame) -> DataFrame:
    """``(word, n)`` over all texts: words, and compounds with their hyphens as a whole and
    by their parts.

    What stands on both sides of a mark at a line's end may be pieces and is not counted.
    Each task adds up its own texts, so what is shuffled are words, not their occurrences.
    """
    table = look_alikes(texts.sparkSession)

    def packed(counts: Counter) -> pa.RecordBatch:
        parts: Counter = Counter()
        for word, n in counts.items():
            if "-" in word:
                for part in word.split("-"):
                    parts[part] += n
        words = [(w, n) for c in (counts, parts) for w, n in c.items() if not w.isdigit()]
        return pa.RecordBatch.from_arrays([pa.array([w for w, _ in words], pa.string()), pa.array([n for _, n in words], pa.int64())], names=["word", "n"])

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: Counter = Counter()
        for batch in batches:
            for text in batch.column(0).to_pylist():
                low = canonical_text(text, table).lower()
                counts.update(_COMPOUND.findall(_PIECES.sub(" ", low) if _CUT.search(low) else low))
            if len(counts) > 200_000:
                yield packed(counts)
                counts = Counter()
        yield packed(counts)

    counted = texts.where("text is not null").select("text").mapInArrow(count, "word string, n bigint")
    return counted.groupBy("word").agg(F.sum("n").alias("n"))


def holes(words: DataFrame) -> DataFrame:
    """``(word, n, key, part)``: each word with one place of one or two characters out."""
    word, size = F.col("word"), F.length("word")

    def out(width: int) -> Column:
        return F.transform(F.sequence(F.lit(1), size - (width - 1)), lambda i: F.struct(
            F.concat(F.substring(word, F.lit(1), i - 1), F.lit("\x01"), F.substring(word, i + width, size)).alias("key"), F.substring(word, i, F.lit(width)).alias("part")
        ))

    return words.select("word", "n", F.explode(F.concat(out(1), out(2))).alias("h")).select("word", "n", "h.*")


def word_pairs(counts: DataFrame, fit: Fit) -> DataFrame:
    """``(wrong, n, right, m, a, b)``: rare words and the common one that differs in one
    place, read ``a`` for ``b``.  An equality join on holes: no word meets all others."""
    words = holes(counts.where(F.length("word") > 3))
    rare = words.select(F.col("word").alias("wrong"), "n", "key", F.col("part").alias("a"))
    common = words.where((F.col("n") >= 2 * fit.ratio) & F.col("word").rlike(r"^\p{L}+$")).select(F.col("word").alias("right"), F.col("n").alias("m"), "key", F.col("part").alias("b"))
    first, last = lambda c: F.substring(c, 1, 1), lambda c: F.substring(c, -1, 1)
    apart = (F.col("m") >= fit.ratio * F.col("n")) & (first("a") != first("b")) & ((F.length("a") == 1) | (F.length("b") == 1) | (last("a") != last("b")))
    pairs = rare.join(common, "key").where(apart)
    return pairs.groupBy("wrong", "n", "a", "b").agg(F.max(F.struct("m", "right")).alias("best")).select("wrong", "n", "best.right", "best.m", "a", "b")


@dataclass
class Words:
    """What all texts say about words, as tables."""

    counts: DataFrame  # (word, n)
    known: DataFrame  # (word, n)
    pairs: DataFrame  # (wrong, right) of shared substitutions


def corpus_words(texts: DataFrame, fit: Fit) -> Words:
    counts = cut(word_counts(texts))
    pairs = cut(word_pairs(counts, fit))
    swaps = pairs.groupBy("a", "b").agg(F.countDistinct("wrong").alias("words"), F.percentile(F.col("n") / F.col("m"), 0.5).alias("rate"))
    size = pairs.agg(F.countDistinct("wrong").alias("all_words"))
    shared = F.col("words") >= F.greatest(F.lit(fit.support), F.col("all_words") / fit.of_words)
    swaps = swaps.join(F.broadcast(size)).where(shared).select("a", "b", "rate")  # one row
    shared_pairs = cut(pairs.join(F.broadcast(swaps), ["a", "b"]))  # as many as substitutions of two characters
    # a frequent misreading is as frequent as the substitution lets expect, a word is not
    expected = F.col("n") <= fit.least + 8 * F.col("rate") * F.col("m")
    struck = shared_pairs.where(expected).select(F.col("wrong").alias("word")).distinct()
    most = counts.agg(F.max("n")).first()[0] or 1
    known = counts.where(F.col("n") >= min(fit.least, max(2, most // 50))).join(struck, "word", "left_anti")
    return Words(counts, cut(known), shared_pairs.select("wrong", "right"))


def learn(texts: DataFrame, words: Words, fit: Fit, table: LookAlikes) -> Model:
    """Fit on bounded samples: of pairs and texts by a hash, of known words the most frequent."""
    pairs = words.pairs.distinct().orderBy(F.xxhash64("wrong", "right"), "wrong", "right").limit(fit.pairs).collect()
    top = words.known.where(F.length("word") <= 60).orderBy(F.desc("n"), "word").limit(2 * fit.pairs).collect()
    many = texts.where((F.length("text") <= fit.longest) & F.col("text").contains("\n"))
    taken = many.orderBy(F.xxhash64("table_name", "row_id"), "row_id").limit(fit.texts).collect()  # a top-k
    return Model(fit).teach([(r["wrong"], r["right"]) for r in pairs], {r["word"]: r["n"] for r in top}, [canonical_text(r["text"], table) for r in taken])


def repairs(words: Words, model) -> DataFrame:
    """``(word, fix)`` for the distinct unknown words that the editor turns into a known one."""

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = [(w, r, g) for w in batch.column(0).to_pylist() for r, g in model.value.readings(w).items()]
            yield pa.RecordBatch.from_arrays([pa.array([o[k] for o in out], pa.float64() if k == 2 else pa.string()) for k in range(3)], names=["wrong", "word", "gain"])

    unknown = words.counts.join(words.known, "word", "left_anti").where(F.length("word") > 1).select("word")
    unknown = unknown.repartition(unknown.sparkSession.sparkContext.defaultParallelism)
    proposed = unknown.mapInArrow(read, "wrong string, word string, gain double").join(words.known, "word")
    best = proposed.groupBy("wrong").agg(F.max(F.struct("gain", "n", "word")).alias("best"))
    return best.select(F.col("wrong").alias("word"), F.col("best.word").alias("fix"))


_OUT = "table_name string, row_id bigint, defects array<string>, repaired string"


def repair(texts: DataFrame, fit: Fit = Fit()) -> DataFrame:
    """``(table_name, row_id, defects, repaired)`` for ``(table_name, row_id, text)``."""
    spark = texts.sparkSession
    table = look_alikes(spark)
    rows = spread(texts.select("table_name", F.col("row_id").cast("bigint"), "text"))
    words = corpus_words(rows, fit)
    model = spark.sparkContext.broadcast(learn(rows, words, fit, table))  # bounded by the fit's samples
    fixes = cut(repairs(words, model))
    said = words.known.select("word", "n", F.lit(None).cast("string").alias("fix")).unionByName(fixes.select("word", F.lit(0).cast("bigint").alias("n"), "fix"))
    listed = said.limit(fit.broadcast + 1).collect()
    if len(listed) > fit.broadcast:
        return _by_join(rows, said, model, table)
    shared = spark.sparkContext.broadcast(({r["word"]: r["n"] for r in listed if r["fix"] is None}, {r["word"]: r["fix"] for r in listed if r["fix"] is not None}))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lexicon = Lexicon(*shared.value, model.value)
        for batch in batches:
            yield _analysed(batch, table, model.value, lambda _, lexicon=lexicon: lexicon)

    return rows.mapInArrow(run, _OUT)


def _analysed(batch: pa.RecordBatch, table: LookAlikes, model: Model, lexicon: Callable[[int], Lexicon]) -> pa.RecordBatch:
    texts = batch.column(2).to_pylist()
    done = [analyse(canonical_text(t, table), model, lexicon(k)) if t is not None else (set(), None) for k, t in enumerate(texts)]
    columns = [batch.column(0), batch.column(1), pa.array([sorted(d) for d, _ in done], pa.list_(pa.string())), pa.array([t for _, t in done], pa.string())]
    return pa.RecordBatch.from_arrays(columns, names=["table_name", "row_id", "defects", "repaired"])


def _by_join(rows: DataFrame, said: DataFrame, model, table: LookAlikes) -> DataFrame:
    """Each text with the part of the lexicon that its own words need."""

    def ask(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            asked = [needed(canonical_text(t, table), model.value) if t is not None else [] for t in batch.column(2).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(asked, pa.list_(pa.string()))], names=["table_name", "row_id", "words"])

    asked = rows.mapInArrow(ask, "table_name string, row_id bigint, words array<string>").select("table_name", "row_id", F.explode("words").alias("word"))
    own = asked.join(said, "word").groupBy("table_name", "row_id").agg(F.collect_list(F.struct("word", "n", "fix")).alias("own"))  # words of one text

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            parts = []
            for own_ in batch.column(3).to_pylist():
                own_ = own_ or []
                parts.append(Lexicon({o["word"]: o["n"] for o in own_ if o["fix"] is None}, {o["word"]: o["fix"] for o in own_ if o["fix"] is not None}, model.value))
            yield _analysed(batch, table, model.value, parts.__getitem__)

    return rows.join(own, ["table_name", "row_id"], "left").select("table_name", "row_id", "text", "own").mapInArrow(run, _OUT)
