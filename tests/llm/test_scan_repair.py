import random
from collections import Counter

import pytest

from conftest import rows
from ledgerloom.llm import scan_repair
from ledgerloom.llm.confusables import look_alikes

SUBJECTS = "the seasonal rainfall|the regional market price|a corrected soil profile|the well-documented river discharge|an unexpected flood peak|the cross-validated sampling design|the remaining leaf area".split("|")
VERBS = "explains|follows|stabilises|contradicts|responds to|depends on|limits".split("|")
ENDS = "under the conditions described|in every survey since then|although only some entries were complete|before the second survey|within two units of the reference".split("|")


def sentence(rng):
    return f"{rng.choice(SUBJECTS)} {rng.choice(VERBS)} {rng.choice(SUBJECTS)} {rng.choice(ENDS)}.".capitalize()


def wrapped(text, rng, width=50, cut=0.0):
    lines, line = [], ""
    for w in text.split():
        if len(line) + len(w) + 1 > width:
            if len(w) > 6 and w.isalpha() and rng.random() < cut:
                k = rng.randrange(2, len(w) - 2)
                lines.append(f"{line} {w[:k]}" + rng.choice("-¬"))
                line = w[k:]
                continue
            lines.append(line)
            line = w
        else:
            line = f"{line} {w}".strip()
    return [*lines, line]


def noisy(text, rng):
    for a, b in rng.sample([("o", "0"), ("i", "1"), ("l", "1"), ("s", "5"), ("e", "c"), ("m", "rn"), ("u", "ii"), ("d", "cl")], 8):
        at = [k for k in range(1, len(text) - 1) if text[k] == a and text[k - 1].isalpha() and text[k + 1].isalpha()]
        if at:
            k = rng.choice(at)
            return text[:k] + b + text[k + 1 :]
    return text


@pytest.fixture(scope="module")
def corpus(spark):
    rng = random.Random(1)
    texts = []
    for k in range(600):
        title = f"{rng.choice(['Rainfall', 'Price', 'Soil', 'River'])} of {rng.choice(['Mark', 'Loh', 'Tarn'])}stett: {rng.choice(['a regional atlas', 'methods and limits', 'an annual record'])}"
        body = " ".join(sentence(rng) for _ in range(6))
        lines = wrapped(noisy(body, rng) if k % 2 else body, rng, cut=0.3)
        at = rng.randrange(2, len(lines) - 1)
        furniture = rng.choice([[f"Page {k}"], [f"— {k} —"], [f"[{k}]"], [f"- {k} -"], [title.upper()], [f"{title}   {k}"], [f"{k}", "", title.upper()], []])
        texts.append("\n".join([f"Title: {title}", "", *lines[:at], *furniture, *lines[at:]]))
    return spark.createDataFrame([("t", k, t) for k, t in enumerate(texts)], "table_name string, row_id bigint, text string").repartition(4).cache()


@pytest.fixture(scope="module")
def fitted(spark, corpus):
    fit = scan_repair.Fit()
    words = scan_repair.corpus_words(corpus, fit)
    model = scan_repair.learn(corpus, words, fit, look_alikes(spark))
    fixes = scan_repair.repairs(words, spark.sparkContext.broadcast(model))
    return model, scan_repair.Lexicon({r["word"]: r["n"] for r in words.known.collect()}, {r["word"]: r["fix"] for r in fixes.collect()}, model)


@pytest.fixture(scope="module")
def analyse(fitted):
    return lambda text: scan_repair.analyse(text, *fitted)


def test_held_out_noise(analyse):
    rng = random.Random(9)
    right = {d: [0, 0, 0] for d in scan_repair.DEFECTS}
    for k in range(200):
        body = " ".join(sentence(rng) for _ in range(4))
        want = set()
        text = body
        if k % 3 == 0:
            text = noisy(body, rng)
            want |= {"misread"} if text != body else set()
        lines = wrapped(text, rng, cut=0.5 if k % 2 else 0.0)
        if any(x[-1:] == "¬" or (x[-1:] == "-" and not x.endswith(("well-", "cross-"))) for x in lines):
            want.add("hyphenation")
        if k % 4 == 1:
            lines.insert(len(lines) // 2, f"Page {k} of 300")
            want.add("page_number")
        if k % 5 == 2:
            lines.insert(len(lines) // 2, "RIVER OF LOHSTETT: AN ANNUAL RECORD")
            want.add("header")
        found, repaired = analyse("\n".join(lines))
        for d in scan_repair.DEFECTS:
            right[d][0] += d in found and d in want
            right[d][1] += d in found and d not in want
            right[d][2] += d in want and d not in found
        assert "\n" not in repaired.replace("\n\n", "")
    for d, (hit, extra, miss) in right.items():
        assert hit / (hit + extra) > 0.93 and hit / (hit + miss) > 0.9, (d, right[d])


def test_repair_gives_paragraphs(analyse):
    found, text = analyse("Title: River of Tarnstett: an annual record\n\nThe seasonal rain-\n\nPage 3\n\nfall follows the well-\ndocumented rivcr discharge.\n\nA corrected soil profile limits the leaf area.")
    assert found == {"hyphenation", "page_number", "misread"}
    assert text == "Title: River of Tarnstett: an annual record\n\nThe seasonal rainfall follows the well-documented river discharge.\n\nA corrected soil profile limits the leaf area."


def test_edges(analyse):
    for t in ("", "\n\n", "7", "x", "Title: a\n7", "## 2 Data\n", "-\n-", "¬\n¬"):
        analyse(t)
    assert analyse("") == (set(), "")
    long = " ".join(SUBJECTS) * 500
    assert analyse(long)[0] == set()
    untaught = scan_repair.Model().teach([], {}, [])
    assert scan_repair.analyse("any text-\nhere", untaught, scan_repair.Lexicon({}, {}, untaught)) == (set(), "any text-here")


def test_the_perceptrons_decide(fitted, corpus):
    """Without the editor's weights nothing is misread or joined, without the classifier's
    nothing is furniture."""
    import copy

    model, lexicon = fitted
    texts = [r["text"] for r in corpus.limit(200).collect()]

    def defects(m):
        own = scan_repair.Lexicon(lexicon.known, {} if m is not model else lexicon.fixes, m)
        return Counter(d for t in texts for d in scan_repair.analyse(t, m, own)[0])

    whole, no_editor, no_liner = defects(model), copy.copy(model), copy.copy(model)
    no_editor.editor = no_liner.liner = scan_repair.Perceptron()
    no_editor.margin = 1e-9
    assert min(whole[d] for d in scan_repair.DEFECTS) > 20
    assert not {"misread", "hyphenation"} & defects(no_editor).keys()
    assert not {"header", "page_number"} & defects(no_liner).keys()


def test_a_large_lexicon_is_joined(corpus):
    some = corpus.where("row_id < 60")
    by_map, by_join = (rows(scan_repair.repair(some, scan_repair.Fit(broadcast=n))) for n in (500_000, 0))
    assert by_map == by_join and any(r[2] for r in by_map)


def test_frequent_words_are_no_misreadings(spark):
    """A word that a substitution turns into a far more frequent one stays a word."""
    swap = [("c", "e", w) for w in ("release", "second", "before", "section", "described", "between")]
    words = [(w, 4000) for _, _, w in swap] + [(w.replace("e", "c", 1), 12) for _, _, w in swap] + [("head", 4000), ("hcad", 200)]
    texts = spark.createDataFrame([("t", k, " ".join([w] * n)) for k, (w, n) in enumerate(words)], "table_name string, row_id bigint, text string")
    known = {r["word"] for r in scan_repair.corpus_words(texts, scan_repair.Fit()).known.collect()}
    assert known == {w for _, _, w in swap} | {"head", "hcad"}


def test_edits_and_perceptron():
    assert "".join(scan_repair.edits("cornpared", "compared")) == "compared" and "".join(scan_repair.edits("ruhng", "ruling")) == "ruling"
    p = scan_repair.Perceptron()
    p.train([(["a", "b"], "x"), (["c"], "y")] * 5, 3, 1)
    assert p.best(["a"], "x") == "x" and p.best(["c"], "x") == "y" and p.best(["unseen"], "x") == "x"


def test_over_tables(spark):
    df = spark.createDataFrame([("t", 1, "one line only", "c"), ("t", 2, None, "c")], "table_name string, row_id bigint, text string, repaired string")
    got = {r["row_id"]: (r["defects"], r["repaired"]) for r in scan_repair.repair(df).collect()}
    assert got == {1: ([], "one line only"), 2: ([], None)}
    assert scan_repair.repair(df.limit(0)).count() == 0
