import random

import numpy as np
import pytest
from .helpers import SMALL, rows_of

from tallyhouse.llm import near_dedup
from tallyhouse.llm.shared import table


def brute_classes(rows):
    """The smallest doc_id of each connected group, from all pairs."""
    bags = [near_dedup.multiset(text) for _, text in rows]
    parent = list(range(len(rows)))

    def top(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i in range(len(rows)):
        for j in range(i):
            if near_dedup.weighted_jaccard(bags[i], bags[j]) >= 0.8:
                a, b = top(i), top(j)
                parent[max(a, b)] = min(a, b)
    groups = {}
    for i, (doc_id, _) in enumerate(rows):
        groups.setdefault(top(i), []).append(doc_id)
    return {doc_id: min(group) for group in groups.values() for doc_id in group}


@pytest.fixture(scope="module")
def variants():
    """Groups of texts around the threshold: each has a base, and copies with 1 to 12 new words."""
    rng = random.Random(5)
    words = [f"w{i}" for i in range(4000)]
    rows = []
    for _ in range(6):
        base = [rng.choice(words) for _ in range(120)]
        rows.append(" ".join(base))
        for _ in range(25):
            copy = list(base)
            for _ in range(rng.randint(0, 5)):
                copy[rng.randrange(120)] = rng.choice(words)
            rows.append(" ".join(copy))
    rng.shuffle(rows)
    return list(enumerate(rows))


@pytest.mark.parametrize("big", [3, 32])
def test_same_groups_as_all_pairs(make_docs, variants, big, monkeypatch):
    monkeypatch.setattr(near_dedup, "CHUNK", 7)
    docs = make_docs([(i, text, "en", "a") for i, text in variants])
    found = {r["doc_id"]: r["class_id"] for r in near_dedup.near_classes(docs, big=big).collect()}
    assert found == brute_classes(variants)


def test_odd_rows(odd_docs):
    found = rows_of(near_dedup.near_classes(odd_docs))
    assert len(found) == odd_docs.count()
    by_id = {r["doc_id"]: r["class_id"] for r in found}
    assert by_id[5] == by_id[6] == by_id[7] == 5
    assert all(by_id[i] == i for i in (1, 2, 3, 4, 8, 9))
    kept = near_dedup.keep_one(odd_docs)
    assert kept.columns == odd_docs.columns
    assert sorted(r["doc_id"] or 0 for r in kept.collect()) == [0, 1, 2, 3, 4, 5, 8, 9]


def test_copies_of_a_row_without_id(make_docs):
    text = "one two three four five six seven"
    docs = make_docs([(None, text, "en", "a"), (4, text, "en", "a"), (3, text + "!", "en", "a")])
    found = sorted((r["doc_id"] or 0, r["class_id"]) for r in near_dedup.near_classes(docs).collect())
    assert found == [(0, 3), (3, 3), (4, 3)]
    assert [r["doc_id"] for r in near_dedup.keep_one(docs).collect()] == [3]


def test_rows_that_share_an_id_are_judged_by_their_own_texts(make_docs):
    one, two = "one two three four five six seven", "eight nine ten eleven twelve and more"
    rows = [(1, one), (1, two), (2, one.upper()), (None, two + "!"), (None, "a b c d e f")]
    rows += rows[:1]
    docs = make_docs([(i, text, "en", "a") for i, text in rows])
    kept = sorted((r["doc_id"] or 0, r["text"]) for r in near_dedup.keep_one(docs).collect())
    assert kept == [(0, "a b c d e f"), (1, two), (1, one)]
    found = near_dedup.near_classes(docs).collect()
    assert sorted((r["doc_id"] or 0, r["class_id"] or 0, r["kept"]) for r in found) == [
        (0, 0, True), (0, 1, False), (1, 1, True), (1, 1, True), (1, 1, True), (2, 1, False),
    ]


def test_same_groups_as_all_pairs_of_the_table(spark):
    docs = table(spark, SMALL, "documents").select("doc_id", "text")
    found = {r["doc_id"]: r["class_id"] for r in near_dedup.near_classes(docs).collect()}
    assert found == brute_classes([(r["doc_id"], r["text"]) for r in docs.collect()])


def test_empty_table(odd_docs):
    assert near_dedup.near_classes(odd_docs.limit(0)).collect() == []


def test_signatures_estimate_weighted_jaccard():
    rng = random.Random(2)
    one = [rng.choice("abcdefghijklmnop") for _ in range(300)]
    two = one[:200] + [rng.choice("qrstuvwxyzabcde") for _ in range(100)]
    bags = [near_dedup.multiset(" ".join(words), 1) for words in (one, two)]
    true = near_dedup.weighted_jaccard(*bags)
    made = near_dedup.signatures(bags, 4096)
    assert abs(float(np.mean(made[0] == made[1])) - true) < 0.03


def test_similarities_are_exact():
    rng = random.Random(4)
    texts = [" ".join(rng.choice("abc") for _ in range(rng.randint(0, 40))) for _ in range(20)]
    bags = [near_dedup.multiset(text) for text in texts]
    made = near_dedup.similarities(bags[:8], bags[8:])
    for i, a in enumerate(bags[:8]):
        for j, b in enumerate(bags[8:]):
            assert made[i, j] == near_dedup.weighted_jaccard(a, b)
