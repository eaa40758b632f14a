from collections import Counter

from .helpers import SMALL, rows_of

from tallyhouse.llm import mixing
from tallyhouse.llm.queries import ORACLE_SQL
from tallyhouse.llm.shared import cut, table


def test_same_as_sql(spark, odd_docs, sql):
    for docs in (table(spark, SMALL, "documents"), odd_docs):
        ours = rows_of(mixing.taken(docs, block=16).drop("source"))
        theirs = sql(ORACLE_SQL["op5_mixing"], documents=docs.select("doc_id", "source", "text"))
        names = sorted(ours[0])
        assert sorted(str([r[n] for n in names]) for r in ours) == sorted(
            str([r[n] for n in names]) for r in theirs
        )


def test_the_schedule_meets_shares_everywhere(spark):
    rows = cut(mixing.placed(mixing.sized(table(spark, SMALL, "documents"))))
    goals = cut(mixing.targets(rows))
    slots = sorted((r["slot"], r["s"]) for r in mixing.schedule(goals, 16).collect())
    assert len({slot for slot, _ in slots}) == len(slots)
    total = Counter(s for _, s in slots)
    for part in (len(slots) // 4, len(slots) // 2):
        seen = Counter(s for _, s in slots[:part])
        for s, n in total.items():
            assert abs(seen[s] - n * part / len(slots)) < 6
    mix = mixing.mixed(rows, goals, 16)
    sums = mix.groupBy("s").agg({"n_words": "sum"}).toDF("s", "w").collect()
    words = {r["s"]: r["w"] for r in sums}
    assert words == {r["s"]: r["words"] for r in goals.collect() if r["words"]}


def test_empty_table(odd_docs):
    assert mixing.taken(odd_docs.limit(0)).collect() == []
