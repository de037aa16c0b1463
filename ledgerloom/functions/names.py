"""Resolving a free-typed metric name against a small reference, for one name at a time."""

from __future__ import annotations

import math
import re
import unicodedata
from collections import Counter

# Letters of other scripts that are typed for Latin ones.
_TYPED = str.maketrans("АВЕЅІЈКМНОРСТХаеосрхуіѕјΑΒΕΖΗΙΚΜΝΟΡΤΧον", "ABESIJKMHOPCTXaeocpxyisjABEZHIKMNOPTXov")
# Abbreviations that don't begin their word.
_FORMS = {"avg": ("mean",), "average": ("mean",), "std": ("standard",), "pct": ("percentage", "percent")}
_EMPTY = {"a", "and", "for", "in", "of", "on", "the", "to"}
_CUT = re.compile(r"[^a-z0-9]+")


def folded(name: str) -> str:
    """Lower-case letters and digits parted by spaces; single ones next to each other joined."""
    text = "".join(c for c in unicodedata.normalize("NFKC", name) if unicodedata.category(c) != "Cf").translate(_TYPED)
    bare = re.sub(r"\[[^\]]*\]", " ", text)
    text = bare if re.search(r"[^\W\d_]", bare) else text
    return re.sub(r"(?<=\b\w) (?=\w\b)", "", _CUT.sub(" ", text.lower()).strip())


def distance(a: str, b: str, most: int) -> int:
    """Edit distance with swapped neighbours as one edit, or more than ``most``."""
    if abs(len(a) - len(b)) > most:
        return most + 1
    before, last = [], list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        row = [i]
        for j, y in enumerate(b, 1):
            v = min(last[j] + 1, row[j - 1] + 1, last[j - 1] + (x != y))
            if i > 1 and j > 1 and x == b[j - 2] and a[i - 2] == y:
                v = min(v, before[j - 2] + 1)
            row.append(v)
        if min(row) > most:
            return most + 1
        before, last = last, row
    return last[-1]


def without(word: str, most: int) -> set[str]:
    """A word without up to ``most`` of its letters: the deletion neighbourhood."""
    found = layer = {word}
    for _ in range(most):
        layer = {w[:i] + w[i + 1 :] for w in layer for i in range(len(w))}
        found = found | layer
    return found


class NameResolver:
    """The entry a name means: its tokens are repaired, then entries ranked by coverage.

    ``entries`` are (key, short name or None, full name or None).  The reference is small;
    every distinct token is compared with its vocabulary once and remembered.
    """

    def __init__(self, entries: list[tuple[str, str | None, str | None]], covered: float = 0.8):
        self.covered = covered
        aliases: list[tuple[str, set[str]]] = []
        for key, short, full in entries:
            if short:
                aliases.append((key, {folded(short).replace(" ", "")}))
            if full:
                words = {t for t in folded(full).split() if t not in _EMPTY}
                aliases += [(key, words), (key, {folded(full).replace(" ", "")})]
        df = Counter(t for _, words in aliases for t in words)
        self.weight = {t: math.log(1 + len(aliases) / n) for t, n in df.items()}
        self.aliases = aliases
        self.spread = {t for _, words in aliases if len(words) > 1 for t in words}
        self.near: dict[str, set[str]] = {}
        for w in self.weight:
            for part in without(w, self._reach(w)):
                self.near.setdefault(part, set()).add(w)
        self._tokens: dict[str, dict[str, float]] = {}
        self._names: dict[str, str | None] = {}

    @staticmethod
    def _reach(word: str) -> int:
        return 0 if len(word) < 4 else 1 if len(word) < 6 else 2

    def meanings(self, token: str) -> dict[str, float]:
        """Words of the vocabulary that a token may mean, with their likeness."""
        if token in self._tokens:
            return self._tokens[token]
        if len(self._tokens) > 100_000:
            self._tokens.clear()
        out: dict[str, float] = {}
        if 2 < len(token) < 64 and token not in self.weight:
            for w in set().union(*(self.near.get(part, ()) for part in without(token, 1 if len(token) < 6 else 2))):
                d = distance(token, w, self._reach(w)) if self._reach(w) else 1
                if d <= self._reach(w):
                    out[w] = 1 - 0.6 * d / max(len(w), len(token))
        for w in self.weight:
            if w == token:
                out[w] = 1.0
            elif token in (w + "s", w[:-1] if w.endswith("s") else None):
                out[w] = 0.98
            elif w in _FORMS.get(token, ()):
                out[w] = 0.95
            elif token not in self.weight and w in self.spread and len(token) > 1 and w.startswith(token) and 3 * len(token) <= 2 * len(w):
                out[w] = max(out.get(w, 0.0), 0.9)
        self._tokens[token] = out
        return out

    def resolve(self, name: str | None) -> str | None:
        """The key of the entry meant, or None."""
        if not name:
            return None
        if name not in self._names:
            if len(self._names) > 100_000:
                self._names.clear()
            self._names[name] = self._rank(folded(name).split())
        return self._names[name]

    def _rank(self, tokens: list[str]) -> str | None:
        meant = [(k, self.meanings(t)) for k, t in enumerate(tokens) if t not in _EMPTY]
        said = math.sqrt(sum(max((self.weight[w] * s for w, s in m.items()), default=0.0) ** 2 for _, m in meant))
        best: tuple | None = None
        for key, words in self.aliases:
            got: dict[str, tuple[float, int]] = {}
            for k, m in meant:
                for w in words & m.keys():
                    got[w] = max(got.get(w, (0.0, k)), (m[w], k))
            if not got:
                continue
            norm = sum(self.weight[w] ** 2 for w in words)
            dot = sum(self.weight[w] ** 2 * s for w, (s, _) in got.items())
            if dot >= self.covered * norm:
                at = [k for _, k in got.values()]
                rank = (-round(dot / math.sqrt(norm) / said, 3), max(at) - min(at) - len(at), -dot / norm, key)
                best = min(best, rank) if best else rank
        return best[-1] if best else None
