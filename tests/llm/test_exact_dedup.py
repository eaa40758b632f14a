import random

from .helpers import rows_of

from tallyhouse.llm import exact_dedup
from tallyhouse.llm.queries import ORACLE_SQL


def same_as_sql(sql, docs, **options):
    ours = rows_of(exact_dedup.exact_groups(docs, **options))
    theirs = sql(ORACLE_SQL["op2_exact_dedup"], documents=docs.select("doc_id", "text"))
    names = sorted(ours[0])
    assert sorted(str([r[n] for n in names]) for r in ours) == sorted(
        str([r[n] for n in names]) for r in theirs
    )


def test_odd_rows(odd_docs, sql):
    same_as_sql(sql, odd_docs)


def test_digests_that_clash_are_told_apart(make_docs, sql):
    rng = random.Random(3)
    texts = ["".join(rng.choice("abcdef ") for _ in range(rng.randint(0, 6000))) for _ in range(30)]
    rows = [(i, texts[i % 30] if i % 4 else texts[i % 30].upper(), "en", "a") for i in range(80)]
    same_as_sql(sql, make_docs(rows), digest_bytes=1)


def test_one_row_of_each_text_stays_whatever_the_ids(make_docs, sql):
    rows = [(1, "A"), (1, "B"), (2, "a"), (2, "A"), (None, "c"), (None, "C"), (None, "d")]
    docs = make_docs([(i, text, "en", "a") for i, text in rows])
    same_as_sql(sql, docs)
    left = exact_dedup.keep_one(docs).collect()
    kept = sorted((r["doc_id"] or 0, r["text"].lower()) for r in left)
    assert kept == [(0, "c"), (0, "d"), (1, "b"), (2, "a")]


def test_clashing_digests_of_rows_without_own_ids(make_docs, sql):
    """Texts of several chunks whose digests are one byte: lists of digests alone would group
    different texts."""
    rng = random.Random(9)
    texts = ["".join(rng.choice("abcdef ") for _ in range(rng.randint(0, 900))) for _ in range(60)]
    for ids in ([None] * 60, [7] * 60, [i % 3 for i in range(60)]):
        docs = make_docs([(i, text, "en", "a") for i, text in zip(ids, texts, strict=True)])
        same_as_sql(sql, docs, digest_bytes=1)
        kept = exact_dedup.keep_one(docs, digest_bytes=1)
        assert sorted(r["text"] for r in kept.collect()) == sorted(set(texts))


def test_empty_table(odd_docs):
    assert exact_dedup.exact_groups(odd_docs.limit(0)).collect() == []
    assert exact_dedup.keep_one(odd_docs.limit(0)).collect() == []


def test_keep_one_keeps_columns(odd_docs):
    kept = exact_dedup.keep_one(odd_docs)
    assert kept.columns == odd_docs.columns
    assert sorted(r["doc_id"] or 0 for r in kept.collect()) == [0, 2, 3, 4, 7, 8, 9]


def test_chunks_make_up_the_text_and_follow_the_content():
    rng = random.Random(1)
    data = bytes(rng.randrange(256) for _ in range(200_000))
    chunks = [body for _, body in exact_dedup.chunks_of(data)]
    assert b"".join(chunks) == data
    assert max(map(len, chunks)) <= exact_dedup.MOST
    moved = [body for _, body in exact_dedup.chunks_of(b"some words before" + data)]
    assert len(set(chunks) & set(moved)) > 0.9 * len(chunks)
