import random

import pytest

from .helpers import SMALL, rows_of

from tallyhouse.llm import lexical_search as op
from tallyhouse.llm.queries import ORACLE_SQL
from tallyhouse.llm.shared import table


@pytest.fixture(scope="module")
def items(spark):
    rows = [
        (1, "The quick brown fox", "x"),
        (2, None, "x"),
        (3, " ... !!", "x"),
        (4, "ÄRGER \U0001f600 x", "x"),
        (4, "lazy dog dog DOG", "x"),
        (None, "word1x1 word2x1 nobody", "x"),
        (6, " ".join(f"word{i}x3" for i in range(900)) + " the dog", "x"),
        (7, "nowhere", "x"),
    ]
    return spark.createDataFrame(rows, "item_id long, text string, score string")


def as_text(rows):
    return sorted(str(sorted(r.items())) for r in rows)


@pytest.mark.parametrize(("block_terms", "segment"), [(200_000, 32_768), (300, 37)])
def test_same_as_sql(spark, sql, block_terms, segment):
    docs, benchmark = table(spark, SMALL, "documents"), table(spark, SMALL, "benchmark")
    found = rows_of(op.search(docs, benchmark, block_terms=block_terms, segment=segment))
    theirs = sql(ORACLE_SQL["op11_lexical_search"], documents=docs, benchmark=benchmark)
    assert as_text(found) == as_text(theirs) and len(found) > 1000


def test_odd_rows(spark, sql, odd_docs, items):
    found = rows_of(op.search(odd_docs, items, segment=3))
    theirs = sql(
        ORACLE_SQL["op11_lexical_search"],
        documents=odd_docs.select("doc_id", "text"),
        benchmark=items.select("item_id", "text"),
    )
    assert as_text(found) == as_text(theirs)
    assert {r["item_id"] for r in found} == {None, 1, 4, 6}


def test_ties_go_to_the_smaller_id_in_every_segment(spark, make_docs, items):
    """Many documents of one mask and score, over many tasks, and rarer ones that score more."""
    dice = random.Random(5)
    ids = list(range(400))
    dice.shuffle(ids)
    docs = make_docs([(i, "brown cow" if i % 97 else "brown fox", "en", "a") for i in ids])
    found = op.search(docs.repartition(7), items.where("item_id = 1"), top=20, segment=16)
    ranks = [(r["rank"], r["doc_id"]) for r in found.orderBy("rank").collect()]
    best = [0, 97, 194, 291, 388]
    assert ranks == list(enumerate(best + [i for i in range(1, 16)], 1))


def test_empty_tables(odd_docs, items):
    assert op.search(odd_docs.limit(0), items).collect() == []
    assert op.search(odd_docs, items.limit(0)).collect() == []
