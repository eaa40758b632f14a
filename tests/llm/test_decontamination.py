import random

import numpy as np
from .helpers import rows_of

from tallyhouse.llm import decontamination as d


def greedy(doc, item, least):
    """Covered words of the item: mark the longest match of unmarked words, again and again."""
    free_doc, free_item, covered = [True] * len(doc), [True] * len(item), 0
    while True:
        best = (0, 0, 0)
        for i in range(len(item)):
            for j in range(len(doc)):
                n = 0
                while (
                    i + n < len(item)
                    and j + n < len(doc)
                    and item[i + n] == doc[j + n]
                    and free_item[i + n]
                    and free_doc[j + n]
                ):
                    n += 1
                if n > best[0]:
                    best = (n, i, j)
        n, i, j = best
        if n < least:
            return covered
        covered += n
        for k in range(n):
            free_item[i + k] = free_doc[j + k] = False


def test_tiles_are_those_of_the_greedy_algorithm():
    rng = random.Random(7)
    for _ in range(60):
        doc = np.array([rng.randrange(4) for _ in range(rng.randint(0, 60))], dtype=np.uint64)
        item = np.array([rng.randrange(4) for _ in range(rng.randint(2, 20))], dtype=np.uint64)
        made = d.tiles(doc, item, 2, d.rolling(doc, 2), d.rolling(item, 2))
        assert sum(n for _, _, n in made) == greedy(doc.tolist(), item.tolist(), 2)
        assert len({i + k for i, _, n in made for k in range(n)}) == sum(n for *_, n in made)


def test_reordered_passages_are_caught_and_clean_texts_are_not(spark, make_docs, odd_docs):
    item = "alpha beta gamma delta epsilon zeta eta theta iota kappa lambda mu nu xi omicron pi"
    words = item.split()
    turned = " ".join(words[8:] + ["and", "then"] + words[:8])
    half = " ".join(words[:6])
    docs = make_docs(
        [(1, f"before {item.upper()}! after", "en", "a"), (2, f"x y {turned} z", "en", "a"),
         (3, f"only {half} here", "en", "a"), (4, "nothing of it", "en", "a")]
    )
    bench = spark.createDataFrame(
        [(10, item), (11, item), (12, None), (13, ""), (14, "too short for it")],
        "item_id long, text string",
    )
    for size in (1_000_000, 8):
        found = rows_of(d.leaks(docs, bench, block_words=size))
        pairs = [(r["doc_id"], r["item_id"], r["coverage"]) for r in found]
        assert sorted(pairs) == [(1, 10, 1.0), (1, 11, 1.0), (2, 10, 1.0), (2, 11, 1.0)]
    kept = d.drop_leaked(odd_docs, bench)
    assert kept.columns == odd_docs.columns and kept.count() == odd_docs.count()
    assert d.leaks(docs.limit(0), bench).collect() == []
    assert d.leaks(docs, bench.limit(0)).collect() == []


def test_tiles_without_a_list_of_pairs_are_the_same(monkeypatch):
    rng = random.Random(8)
    for _ in range(60):
        doc = np.array([rng.randrange(4) for _ in range(rng.randint(0, 60))], dtype=np.uint64)
        item = np.array([rng.randrange(5) for _ in range(rng.randint(2, 20))], dtype=np.uint64)
        listed = d.tiles(doc, item, 2, d.rolling(doc, 2), d.rolling(item, 2))
        assert d._tiles_one_by_one(doc, item, 2) == listed


def test_one_word_over_and_over(make_docs, spark):
    """Seed pairs would be 200 million."""
    docs = make_docs([(1, "no " * 100_000, "en", "a"), (2, "no " * 900, "en", "a")])
    bench = spark.createDataFrame([(5, "no " * 2_000)], "item_id long, text string")
    found = [(r["doc_id"], r["n_covered"]) for r in d.leaks(docs, bench).collect()]
    assert found == [(1, 2_000)]


def test_rows_are_dropped_by_their_own_texts(make_docs, spark):
    item = "alpha beta gamma delta epsilon zeta eta theta"
    rows = [(None, item), (3, item), (3, "clean text"), (None, "clean too"), (3, None)]
    docs = make_docs([(i, text, "en", "a") for i, text in rows])
    bench = spark.createDataFrame([(10, item)], "item_id long, text string")
    for size in (1_000_000, 4):
        kept = d.drop_leaked(docs, bench, block_words=size).collect()
        assert sorted(str((r["doc_id"], r["text"])) for r in kept) == sorted(
            str(x) for x in [(3, "clean text"), (None, "clean too"), (3, None)]
        )
