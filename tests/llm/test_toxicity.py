import math
from collections import Counter

import numpy as np
import pytest
from .helpers import SMALL, rows_of
from pyspark.sql import functions as F

from tallyhouse.llm import toxicity
from tallyhouse.llm.shared import table

LARGE = "/root/testdata/sf0.1"


@pytest.fixture(scope="module")
def split_labels(spark):
    labels = table(spark, LARGE, "labels")
    turn = F.pmod(F.xxhash64("doc_id", F.lit(1)), F.lit(2))
    return labels.where(turn == 0), labels.where(turn == 1)


def test_held_out_rows(spark, split_labels):
    docs = table(spark, LARGE, "documents")
    train, test = split_labels
    model = toxicity.fit(docs, train)
    assert (np.diff(model.thresholds) > 0).all() and (model.weights >= 0).all()
    known = test.select("doc_id", F.col("toxic").alias("label"))
    scored = toxicity.severity(docs, model).join(known, "doc_id")
    rates = scored.groupBy("label").agg(F.avg(F.col("toxic").cast("int")).alias("rate")).collect()
    rate = {r["label"]: r["rate"] for r in rates}
    assert rate[1] > 0.8
    assert rate[0] < 0.015


def test_cumulative_link_finds_the_order():
    rng = np.random.default_rng(1)
    score = rng.normal(size=(600, 2)).round(2)
    grade = np.digitize(2 * score[:, 0] + score[:, 1], [-1.0, 0.5, 2.0])
    owner, column = np.repeat(np.arange(600), 2), np.tile([0, 1], 600)
    weights, thresholds = toxicity.fit_cumulative_link(owner, column, score.ravel(), grade, 2)
    assert weights[0] > 1.5 * weights[1] > 0
    assert (np.diff(thresholds) > 0).all()


def test_odd_rows(spark, odd_docs):
    labels = spark.createDataFrame(
        [(5, 1, 1), (7, 1, 0), (8, 0, None), (99, 1, 1), (None, 1, 0)],
        "doc_id long, quality int, toxic int",
    )
    found = rows_of(toxicity.severity(odd_docs, toxicity.fit(odd_docs, labels)))
    assert len(found) == odd_docs.count()
    assert all(0 <= r["severity"] <= 3 for r in found)
    nothing = toxicity.fit(odd_docs, labels.limit(0))
    assert not any(r["toxic"] for r in toxicity.severity(odd_docs, nothing).collect())
    kept = toxicity.drop_toxic(odd_docs, labels.limit(0))
    assert kept.columns == odd_docs.columns and kept.count() == odd_docs.count()
    assert toxicity.drop_toxic(odd_docs.limit(0), labels).collect() == []


def test_length_does_not_make_a_text_toxic(spark, split_labels):
    """Texts of 20,000 words, joined from held-out clean rows that are accepted alone."""
    docs = table(spark, LARGE, "documents")
    train, test = split_labels
    model = toxicity.fit(docs, train)
    clean = docs.join(test.where("toxic = 0").select("doc_id"), "doc_id").orderBy("doc_id")
    texts = [r["text"] for r in clean.collect() if r["text"]]
    texts = [t for t in texts if len(t.split()) <= 1000 and model.expected(t) < toxicity.REJECT]
    rng = np.random.default_rng(3)
    rejected = 0
    for _ in range(40):
        joined, n_words = [], 0
        while n_words < 20_000:
            joined.append(texts[rng.integers(len(texts))])
            n_words += len(joined[-1].split())
        rejected += model.expected("\n".join(joined)) >= toxicity.REJECT
    assert rejected <= 1


def test_severity_of_whole_texts_by_plain_python(spark):
    """The severity of every document of the smallest table, window by window, from the model's
    features alone."""
    docs = table(spark, SMALL, "documents")
    model = toxicity.fit(docs, table(spark, SMALL, "labels"))
    weight = dict(zip(model.features.tolist(), model.weights.tolist(), strict=True))
    found = {r["doc_id"]: r["severity"] for r in toxicity.severity(docs, model).collect()}
    for row in docs.select("doc_id", "text").collect():
        hashes, word, n_words = toxicity.features(row["text"])
        pairs = [(w, h) for h, w in zip(hashes.tolist(), word.tolist(), strict=True) if h in weight]
        worst = 0.0
        for start in toxicity.window_starts(n_words):
            inside = Counter(h for w, h in pairs if start <= w < start + toxicity.WINDOW)
            worst = max(worst, sum(weight[h] * math.log2(1 + n) for h, n in inside.items()))
        wanted = sum(1 / (1 + math.exp(t - worst)) for t in model.thresholds)
        assert abs(found[row["doc_id"]] - wanted) < 1e-9


def test_windows_cover_every_word():
    for n_words in (0, 1, toxicity.WINDOW, toxicity.WINDOW + 1, 5 * toxicity.WINDOW + 7):
        starts = toxicity.window_starts(n_words)
        assert starts[0] == 0 and starts[-1] == max(n_words - toxicity.WINDOW, 0)
        assert all(b - a <= toxicity.WINDOW // 2 for a, b in zip(starts, starts[1:], strict=False))


def test_all_labelled_rows_count(spark):
    """A word of the toxic rows that come last by the hash of doc_id is a feature, whatever the
    number of rows before them, and calibration covers the windows of all clean rows."""
    n = 14_000
    rows = [(i, "calm words here" if i % 2 else f"vile{i % 7} words here", 1 - i % 2) for i in range(n)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, toxic int")
    late = [r["doc_id"] for r in docs.where("toxic = 1").orderBy(
        F.desc(F.xxhash64("doc_id")), "doc_id"
    ).limit(200).select("doc_id").collect()]
    docs = docs.withColumn(
        "text", F.when(F.col("doc_id").isin(late), "zqxjk words here").otherwise(F.col("text"))
    )
    model = toxicity.fit(docs.drop("toxic"), docs.select("doc_id", "toxic"))
    assert toxicity.features("zqxjk")[0][0] in model.features
    assert model.expected("zqxjk words here") >= toxicity.REJECT > model.expected("calm words here")


def test_ranks_by_bins(spark):
    rng = np.random.default_rng(5)
    for values in (rng.exponential(size=5000), np.repeat([0.0, 2.0], [900, 100]), np.zeros(9)):
        frame = spark.createDataFrame([(float(v),) for v in values], "v double")
        for part in (1 / 3, 0.5, 0.95, 1 - toxicity.FALSE_WINDOWS):
            bound = toxicity.value_at(frame, part)
            wanted = np.sort(values)[max(round(part * len(values)), 1) - 1]
            assert wanted - 1e-9 <= bound <= wanted + values.max() / toxicity.BINS**2 + 1e-9
    assert toxicity.value_at(spark.createDataFrame([], "v double"), 0.5) == 0.0


def test_texts_together_are_as_each_alone():
    """The features, the known ones among them, and the worst windows of many texts that are worked
    on at once, against each text for itself and its windows counted one by one."""
    rng = np.random.default_rng(7)
    some = ["VILE", "viles", "ΟΔΟΣ", "x", "straße", "nastyword", "ok-then", "a_b", "éé"]
    texts = [None, "", "Σ", "a\nb\n", "no words: -- !"]
    texts += [" ".join(rng.choice(some, size=n)) for n in (1, 199, 200, 201, 300, 301, 1234)]
    texts.insert(6, None)
    hashes, word, first = toxicity.texts_features(texts)
    alone = [toxicity.features(text) for text in texts]
    assert np.diff(first).tolist() == [n_words for _, _, n_words in alone]
    for number, (own, at, _) in enumerate(alone):
        inside = (word >= first[number]) & (word < first[number + 1])
        assert sorted(zip(word[inside] - first[number], hashes[inside])) == sorted(zip(at, own))
    known = np.unique(toxicity.features("vile nastyword οδος")[0])
    weights = rng.integers(1, 50, size=len(known)) / 7
    model = toxicity.Severity(known, weights, np.array([4.0, 9.0, 20.0]))
    found = model.expected_of(texts)
    weight = dict(zip(known.tolist(), weights.tolist(), strict=True))
    for text, severity, (own, at, n_words) in zip(texts, found, alone, strict=True):
        assert severity == model.expected(text)
        pairs = [(w, h) for w, h in zip(at.tolist(), own.tolist()) if h in weight]
        worst = 0.0
        for start in toxicity.window_starts(n_words):
            inside = Counter(h for w, h in pairs if start <= w < start + toxicity.WINDOW)
            worst = max(worst, sum(weight[h] * math.log2(1 + n) for h, n in inside.items()))
        assert severity == pytest.approx(model.severity_of(worst), abs=1e-9)
    places = toxicity.places(known, texts)
    for rows, windows in toxicity.windows_of(*places):
        scores = windows.scores(weights)
        ends = [*windows.first[1:], len(scores)]
        for begin, end, at in zip(windows.first, ends, windows.worst(weights), strict=True):
            assert at == begin + np.argmax(scores[begin:end])
