import random

import pytest
from pyspark.sql import functions as F

from .helpers import SMALL, rows_of

from tallyhouse.llm import substring_dedup as op
from tallyhouse.llm.queries import ORACLE_SQL
from tallyhouse.llm.shared import table

COLUMNS = ["doc_id", "n_words", "n_removed", "kept_sha256"]


def brute(rows, window):
    """(doc_id, words, places that go) by a dictionary of all windows."""
    texts = [(i, (t or "").split()) for i, t in rows]
    first = {}
    for i, words in texts:
        for k in range(len(words) - window + 1) if i is not None else ():
            key = tuple(words[k : k + window])
            first[key] = min(i, first.get(key, i))
    out = []
    for i, words in texts:
        gone = set()
        for k in range(len(words) - window + 1) if i is not None else ():
            if first[tuple(words[k : k + window])] < i:
                gone.update(range(k, k + window))
        kept = " ".join(w for k, w in enumerate(words) if k not in gone)
        out.append((i, len(words), len(gone), kept))
    return sorted(out, key=str)


def digests(frame):
    made = frame.withColumn("kept_sha256", F.sha2("kept_text", 256)).select(COLUMNS)
    return sorted(str([r[c] for c in COLUMNS]) for r in made.collect())


def test_same_as_sql(spark, odd_docs, sql):
    for docs in (table(spark, SMALL, "documents"), odd_docs):
        found = digests(op.deduplicated(docs, chunk_bytes=50_000, bin_bytes=20_000))
        theirs = sql(ORACLE_SQL["op13_substring_dedup"], documents=docs.select("doc_id", "text"))
        assert found == sorted(str([r[c] for c in COLUMNS]) for r in theirs)


@pytest.mark.parametrize(("window", "shortest"), [(1, 7), (5, 2), (13, 3), (50, 7)])
def test_same_as_brute_force_at_other_lengths(spark, make_docs, window, shortest):
    """Few different words, so that short windows repeat by chance and long ones by copying."""
    dice = random.Random(window)
    passages = [" ".join(dice.choice("abcdefg") for _ in range(70)) for _ in range(4)]
    rows = []
    for i in range(120):
        parts = [" ".join(dice.choice("abcdefghij") for _ in range(dice.randrange(40)))]
        parts += dice.sample(passages, dice.randrange(3))
        dice.shuffle(parts)
        rows.append((i // 2 if i % 10 == 0 else i, " \n".join(parts), "en", "a"))
    docs = make_docs([*rows, (None, passages[0], "en", "a"), (7, None, None, None)])
    made = op.deduplicated(docs.repartition(3), window, shortest, 2_000, 1_000)
    names = ["doc_id", "n_words", "n_removed", "kept_text"]
    found = sorted((tuple(r[c] for c in names) for r in made.collect()), key=str)
    assert found == brute([(r["doc_id"], r["text"]) for r in docs.collect()], window)


def test_lengths_double_up_to_the_window():
    assert op.lengths() == [7, 13]
    assert op.lengths(100, 7) == [7, 14, 28, 56, 100]
    assert op.lengths(3, 7) == [3]


def test_levels_end_when_nothing_is_left(spark, make_docs):
    docs = make_docs([(i, f"{i}w " * 40, "en", "a") for i in range(5)])
    spans = [r["removed"] for r in op.deduplicated(docs, 40, 5).collect()]
    assert spans == [[]] * 5


def test_spans_and_long_documents(spark, make_docs):
    long = " ".join(f"w{i}" for i in range(100_000))
    docs = make_docs([(1, long, "en", "a"), (2, "new words first " + long, "en", "a")], extra=True)
    found = {r["doc_id"]: r for r in op.deduplicated(docs).collect()}
    assert found[1]["removed"] == [] and found[1]["kept_text"] == long
    assert [tuple(s) for s in found[2]["removed"]] == [(3, 100_003)]
    assert found[2]["kept_text"] == "new words first"


def test_equal_words_meet_in_one_key(spark, make_docs):
    """A document of one word over and over has one window, however many places it starts at."""
    docs = make_docs([(i, "no " * 50_000, "en", "a") for i in (3, 4)])
    assert rows_of(op.deduplicated(docs).select("doc_id", "n_removed")) == [
        {"doc_id": 3, "n_removed": 0},
        {"doc_id": 4, "n_removed": 50_000},
    ]


def test_empty_table(odd_docs):
    assert op.deduplicated(odd_docs.limit(0)).collect() == []
