"""The pipeline against plain Python over all pairs, and each stage on odd rows."""

import re

import numpy as np
from .helpers import SMALL
from .test_decontamination import greedy
from .test_near_dedup import brute_classes

import corpus_pipeline
from tallyhouse.llm import mixing, toxicity
from tallyhouse.llm.shared import cut, table
from tallyhouse.llm.words import words

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def leaked(text, items):
    doc = words(text).tolist()
    for item in items:
        item = words(item).tolist()
        if len(item) < 5 or not set(zip(*(doc[k:] for k in range(5)), strict=False)) & set(
            zip(*(item[k:] for k in range(5)), strict=False)
        ):
            continue
        if greedy(doc, item, 5) >= 0.5 * len(item):
            return True
    return False


def test_same_rows_as_brute_force(spark):
    found = {r["doc_id"]: r for r in corpus_pipeline.run(spark, SMALL).collect()}
    docs = table(spark, SMALL, "documents")
    model = toxicity.fit(docs, table(spark, SMALL, "labels"))
    rows = {r["doc_id"]: r for r in docs.collect()}
    left = [
        i for i, r in rows.items()
        if model.expected(r["text"]) < toxicity.REJECT
    ]
    last = {}
    for i in sorted(left):
        last[(rows[i]["text"] or "").translate(LOWER)] = i
    left = sorted(last.values())
    classes = brute_classes([(i, rows[i]["text"]) for i in left])
    left = [i for i in left if classes[i] == i]
    items = [r["text"] for r in table(spark, SMALL, "benchmark").collect()]
    left = [i for i in left if not leaked(rows[i]["text"], items)]
    assert sorted(found) == left
    sizes = {i: len(re.findall(r"[^\x20\x09-\x0D]+", rows[i]["text"] or "")) for i in left}
    assert {i: found[i]["mix_size"] for i in left} == sizes
    taken = sum(found[i]["mix_taken"] for i in left)
    assert abs(taken - mixing.SHARE * sum(sizes.values())) <= 20
    assert all(found[i]["mix_taken"] <= 2 * sizes[i] for i in left)
    for i in left:
        assert all(found[i][c] == rows[i][c] for c in docs.columns)


def test_stages_take_odd_rows_and_empty_tables(spark, odd_docs):
    docs = odd_docs
    for name, stage in corpus_pipeline.STAGES:
        made = stage(spark, docs, SMALL)
        if name != "mixing":
            assert made.columns == odd_docs.columns
        assert made.count() == made.select("doc_id").count() > 0
        assert stage(spark, docs.limit(0), SMALL).collect() == []
        docs = made


def test_null_and_repeated_ids(spark, make_docs):
    """No stage loses a text because another row shares its doc_id, nor keeps one for lack of it."""
    item = table(spark, SMALL, "benchmark").first()["text"]
    clean = [f"plain text number {i} about one thing and another {i}" for i in range(4)]
    rows = [(1, clean[0], "a"), (1, clean[1], "a"), (2, clean[0].upper(), "a")]
    rows += [(None, clean[2], None), (None, clean[2], None), (None, item, "b")]
    rows += [(3, item + " x", "b"), (3, clean[3], "b")]
    docs = make_docs([(i, text, "en", source) for i, text, source in rows])
    for _, stage in corpus_pipeline.STAGES:
        docs = cut(stage(spark, docs, SMALL))
    found = sorted((str(r["doc_id"]), r["text"].lower(), r["mix_size"]) for r in docs.collect())
    assert found == sorted(
        (str(i), clean[k], 10) for i, k in ((2, 0), (1, 1), (None, 2), (3, 3))
    )


def test_rows_that_share_an_id_have_shares_of_their_own(spark, make_docs):
    rows = [(1, "one two three", "a"), (1, "four five", "a"), (1, "six seven", "a")]
    rows.append((None, "x", None))
    docs = make_docs([(i, text, "en", source) for i, text, source in rows])
    made = corpus_pipeline.mix_sources(spark, docs, SMALL).collect()
    assert sorted((r["text"], r["mix_size"]) for r in made) == [
        ("four five", 2), ("one two three", 3), ("six seven", 2), ("x", 1),
    ]
    assert sum(r["mix_taken"] for r in made if r["source"]) == int(
        next(r["mix_target"] for r in made if r["source"])
    )


def test_mixing_columns_replace_others(spark, make_docs):
    docs = make_docs([(1, "one two three", "en", "a"), (2, "four", "en", None)])
    docs = docs.selectExpr("*", "'x' AS mix_size")
    made = corpus_pipeline.mix_sources(spark, docs, SMALL)
    assert made.columns.count("mix_size") == 1
    assert np.array([r["mix_size"] for r in made.orderBy("doc_id").collect()]).tolist() == [3, 1]
