import random

import numpy as np

from conftest import rows
from ledgerloom.llm import containment, mixing, subjects
from ledgerloom.session import table

WORDS = [f"word{k}" for k in range(3000)]


def passage(rng, n=80):
    return [rng.choice(WORDS) for _ in range(n)]


def test_containment_against_brute_force(spark, data):
    docs, items = table(spark, data, "documents"), table(spark, data, "eval_item")
    got = {(r[0], r[1]) for r in containment.leaked(docs, items).select("doc_id", "item_id").collect()}
    held = [(r["item_id"], containment.word_ids(containment.words(r["passage"] or ""))) for r in items.collect()]
    want = set()
    for d in docs.collect():
        ids = containment.word_ids(containment.words(d["text"] or ""))
        for i, item in held:
            if len(item) and len(ids):
                mine, own = set(containment.shingles(ids, 5).tolist()), set(containment.shingles(item, 5).tolist())
                if len(own & mine) >= 0.2 * len(own) and containment.in_order(item, ids) >= 0.5 * len(item):
                    want.add((d["doc_id"], i))
    assert got == want and got


def test_recall_in_long_documents():
    rng = random.Random(3)
    items = [(k, " ".join(passage(rng))) for k in range(40)]
    index = containment.Index(items, containment.Search())
    found = 0
    for k, text in items:
        part = text.split()[20:65]
        part[10], part[30] = "changed", "other"
        long = passage(rng, 3000)
        at = rng.randrange(len(long))
        found += k in {h[0] for h in index.leaks(" ".join([*long[:at], *part, *long[at:]]))}
    assert found >= 38


def test_quotations_and_order():
    rng = random.Random(4)
    item = passage(rng)
    index = containment.Index([(1, " ".join(item))], containment.Search())
    leak = lambda words: [h[0] for h in index.leaks(" ".join(words))]
    assert leak(item) == [1] and leak([w.upper() + "," for w in item]) == [1]
    assert leak(passage(rng) + item[:44] + passage(rng)) == [1]
    assert leak(item[:25]) == []
    assert leak(item[60:] + item[40:60] + item[20:40] + item[:20]) == []
    changed = [w if k % 9 else "x" for k, w in enumerate(item)]
    assert leak(changed) == [1]
    assert containment.words("Cross-validated 2.5,\nlong-\n term it's") == ["crossvalidated", "25", "longterm", "its"]


def test_items_of_all_sizes_and_a_long_one():
    """Short items are found by the same search, and a long one costs them nothing."""
    rng = random.Random(6)
    items = [(k, " ".join(f"w{rng.randrange(9999)}" for _ in range(n))) for k, n in enumerate([1, 2, 3, 4, 5, 6, 9, 14, 22, 40, 90, 300, 2000])]
    index, alone = containment.Index(items, containment.Search()), containment.Index(items[9:10], containment.Search())
    filler = " ".join(f"f{rng.randrange(9999)}" for _ in range(700))
    found = [k in {h[0] for h in index.leaks(f"{filler} {text} {filler}")} for k, text in items]
    assert all(found)
    assert min(p.window for p in index.partitions if p.least > 30) == alone.partitions[0].window
    assert list(index.leaks_in([(5, filler), (6, items[9][1]), (7, "")])) == [(6, 9, 1.0, 1.0)]


def test_containment_edges(spark):
    docs = spark.createDataFrame([(1, "alpha beta gamma", "c"), (2, None, "c"), (3, "", "c"), (4, "alpha beta gamma delta epsilon", "c")], "doc_id bigint, text string, item_id string")
    items = spark.createDataFrame([(7, "Alpha, beta gamma!"), (8, None), (9, "?")], "item_id bigint, passage string")
    assert rows(containment.leaked(docs, items).select("doc_id", "item_id")) == [(1, 7), (4, 7)]
    assert containment.leaked(docs, items.limit(0)).count() == 0 and containment.leaked(docs.limit(0), items).count() == 0
    small = containment.Search(block=1)
    assert rows(containment.leaked(docs, items, small).select("doc_id", "item_id")) == [(1, 7), (4, 7)]


def test_plan_shares_caps_and_shares_out():
    plan = mixing.plan_shares({"a": 1000, "b": 100, "c": 10}, [("a", 0.5, 1), ("b", 0.3, 2), ("c", 0.2, 3), ("d", 0.0, 2)])
    assert plan["b"]["planned"] == 200 and not plan["b"]["reached"] and plan["c"]["planned"] == 30
    assert abs(sum(p["planned"] for p in plan.values()) - 1110) < 1e-6 and plan["a"]["copies"] <= 1
    assert mixing.plan_shares({}, [("a", 1.0, 2)])["a"]["copies"] == 0


def test_pivot_keeps_size_and_probability():
    rng = random.Random(1)
    pool = [(k, rng.randrange(1, 50), rng.random()) for k in range(60)]
    mass = sum(s * p for _, s, p in pool)
    size = {k: s for k, s, _ in pool}
    taken = np.zeros(60)
    for t in range(3000):
        done, held = mixing.pivot(list(pool), random.Random(t))
        got = sum(size[d] * c for d, c in done) + (held[1] * held[2] if held else 0)
        assert abs(got - mass) < 1e-6 and len(done) + bool(held) == 60
        for d, c in done:
            taken[d] += c
        if held:
            taken[held[0]] += held[2]
    assert np.abs(taken / 3000 - [p for _, _, p in pool]).max() < 0.05


def test_mixture(spark):
    docs = spark.createDataFrame([(k, "some words here " * (1 + k % 5), "big" if k < 300 else "small" if k < 320 else None, "c") for k in range(330)] + [(400, None, "big", "c"), (401, "", "small", "c")], "doc_id bigint, text string, source string, copies string")
    targets = spark.createDataFrame([("big", 0.6, 1), ("small", 0.3, 4), ("none", 0.1, 2)], "source string, target_share double, max_repeats int")
    drawn, plan = mixing.draw_copies(docs.repartition(5), targets)
    got = drawn.collect()
    assert len(got) == len({r["doc_id"] for r in got}) == 322
    assert max(r["copies"] for r in got if r["source"] == "big") <= 1 and max(r["copies"] for r in got if r["source"] == "small") <= 4
    for s in ("big", "small"):
        assert abs(sum(r["tokens"] * r["copies"] for r in got if r["source"] == s) - plan[s]["planned"]) <= 20
    report = {r["source"]: r for r in mixing.mixture_report(docs, targets).collect()}
    assert report["none"]["tokens"] == 0 and not report["none"]["reached"]
    assert mixing.mixture_report(docs.limit(0), targets).count() == 3


def test_tokens_of_the_public_tokenizer(spark):
    df = mixing.count_tokens(spark.createDataFrame([("hello world",), ("",), (None,)], "text string"))
    assert [r["tokens"] for r in df.collect()] == [2, 0, 0]


TOPICS = {"a": "wheat barley yield leaf canopy".split(), "b": "server cache plugin parser build".split(), "c": "cow milk pasture calf dairy".split()}


def document(rng, topics, n=10):
    def sentence(t):
        return f"In this release the {rng.choice(TOPICS[t])} follows the {rng.choice(TOPICS[t])} in every survey." if t else "The title page names a place of issue."

    kinds = [t for t in topics for _ in range(n // 3)]
    kinds += [None] * (n - len(kinds))
    rng.shuffle(kinds)
    return " ".join(map(sentence, kinds))


def test_subjects_on_held_out_documents():
    rng = random.Random(5)
    make = lambda: (lambda t: (document(rng, t), set(t)))(rng.sample("abc", rng.choice([0, 1, 1, 2])))
    model = subjects.learn([make() for _ in range(150)], [("a", "arable crops"), ("b", "programs"), ("c", "animals")])
    wrong = 0
    for text, want in (make() for _ in range(100)):
        share = model.shares(text)
        wrong += {model.subjects[k] for k in np.flatnonzero(share >= model.limits)} != want
    assert wrong <= 3


def test_subject_edges(spark):
    docs = spark.createDataFrame([(1, None, "c"), (2, "", "c"), (3, "Two words", "c")], "doc_id bigint, text string, subject string")
    labels = spark.createDataFrame([(9, "a"), (None, "b"), (3, None)], "doc_id bigint, subject string")
    areas = spark.createDataFrame([("a", "arable crops and yield"), ("b", None)], "subject string, description string")
    assert subjects.subjects_of(docs, labels, areas).count() == 0
    assert subjects.subjects_of(docs, labels, areas.limit(0)).count() == 0
    assert subjects.composition(docs.limit(0), labels.limit(0), areas).count() == 0
