"""Severity of toxicity by cumulative-link ordinal regression.

Features are the words of a text and their beginnings (4 to 8 bytes), as exact 64-bit hashes; a
feature that occurs n times has the value log2(1 + n). All thresholds share one weight vector w:
P(grade <= k) = sigmoid(t_k - w x), with t_0 < t_1 < t_2, and w is not negative: the features are
those that occur significantly more often in toxic rows. The output is the expected severity, the
sum over k of P(grade > k), from 0 to 3.

A sum of counts can only rise with length, so a text is judged in windows of `WINDOW` words, each
beginning half a window after the one before it and the last one at the text's end. The severity of
a text is that of its worst window. A text of at most `WINDOW` words is one window. The model is
fitted on the worst window of each labelled row, `ROUNDS` times, as each fit may find another window
worst. At last the thresholds are raised until, of all windows of all labelled clean rows, at most a
share of `FALSE_WINDOWS` (to the nearest whole window) is rejected: a long text has many windows.

Labels say only toxic or not. A toxic row's grade is 1 to 3 by the third of the toxic rows in which
its amount of toxic words lies; a clean row's grade is 0.

All labelled rows count, at each step: the features are counted over all of them, the gradient of
each step of a fit is summed by the tasks that hold their windows (a vector of at most `FEATURES`
numbers a task goes to the driver), and ranks among amounts and scores are found by counting in
bins. Either label counts by the root of the number of its rows. The texts are read twice for it,
once for the features and once for where the chosen ones occur; the rest reads these places.

Edge cases: null and empty texts have no features and get the base severity, which is low. Labels
that are null, or for rows that are not there, are left out. Without labels of both kinds nothing
is toxic (severity 0).
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.storagelevel import StorageLevel

from tallyhouse.llm.shared import FEW_ROWS, checked, cut, filtered, row_groups, stored
from tallyhouse.llm.words import beginning_hashes, mix, spans, texts_bytes

FEATURES = 4000
#: Expected severity from which on a document is rejected.
REJECT = 0.5
#: A feature counts when it is in this many toxic rows and has this z-score of its log odds.
LEAST_ROWS, LEAST_Z = 3, 3.5
#: Words that are judged together; fits, each with the windows that the one before finds worst.
WINDOW, ROUNDS = 200, 3
#: Steps of the first fit and of those after it, which go on from the one before, and the rate of
#: the first step of each; it falls to 0 with the steps.
STEPS, MORE_STEPS, RATE = 120, 60, 0.1
#: Rows whose windows one task of a step takes, about.
BLOCK_ROWS = 50_000
#: Bins in which ranks are counted.
BINS = 4096
#: Share of the windows of clean rows that may be rejected.
FALSE_WINDOWS = 5e-4
_PREFIXES = (4, 5, 6, 7, 8)
#: Places of known features and windows that are worked on at once, about, and leading bits by which most features
#: are told unknown.
_PLACES, _TOLD_BITS = 200_000, 16


@dataclass
class Severity:
    """Sorted features, their weights, and the ordered thresholds."""

    features: np.ndarray
    weights: np.ndarray
    thresholds: np.ndarray

    def expected(self, text: str | None) -> float:
        """Expected severity of the worst window of a text."""
        return float(self.expected_of([text])[0])

    def expected_of(self, texts: Sequence[str | None]) -> np.ndarray:
        """Expected severity of the worst window of each text."""
        worst = np.zeros(len(texts))
        if not len(self.thresholds):
            return worst
        for rows, windows in windows_of(*places(self.features, texts)):
            worst[rows] = np.maximum.reduceat(windows.scores(self.weights), windows.first)
        return (1 / (1 + np.exp(self.thresholds - worst[:, None]))).sum(axis=1)

    def severity_of(self, score: float) -> float:
        return float((1 / (1 + np.exp(self.thresholds - score))).sum())


@dataclass
class Windows:
    """The windows of some rows: of each row its first window; of each window where its entries begin
    and end; of each entry the number of its feature and its value."""

    first: np.ndarray
    begin: np.ndarray
    end: np.ndarray
    number: np.ndarray
    value: np.ndarray

    def scores(self, weights: np.ndarray) -> np.ndarray:
        """The score of each window."""
        weight, value = weights[self.number], self.value
        bounds = zip(self.begin.tolist(), self.end.tolist(), strict=True)
        return np.array([weight[low:high] @ value[low:high] for low, high in bounds])

    def worst(self, weights: np.ndarray) -> np.ndarray:
        """The first window of each row with the largest score."""
        scores = self.scores(weights)
        row = np.repeat(np.arange(len(self.first)), np.diff([*self.first, len(scores)]))
        largest = np.flatnonzero(scores == np.maximum.reduceat(scores, self.first)[row])
        return largest[np.unique(row[largest], return_index=True)[1]]


def places(
    known: np.ndarray, texts: Sequence[str | None]
) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Where the known features occur in texts: their numbers, the numbers of their words in rising
    order, where those of each text end, and how many words each text has."""
    found, word, first = texts_features(texts)
    # Most features are told unknown by their first bits.
    bits = np.zeros(1 << _TOLD_BITS, dtype=bool)
    bits[known >> np.uint64(64 - _TOLD_BITS)] = True
    hit = np.flatnonzero(bits[found >> np.uint64(64 - _TOLD_BITS)])
    at = np.searchsorted(known, found[hit])
    same = known[np.minimum(at, len(known) - 1)] == found[hit]
    hit, at = hit[same], at[same]
    order = np.argsort(word[hit], kind="stable")
    number, word = at[order], word[hit[order]]
    ends = np.searchsorted(word, first[1:])
    return number, word - np.repeat(first[:-1], np.diff(ends, prepend=0)), ends, np.diff(first)


def windows_of(
    number: np.ndarray, word: np.ndarray, ends: np.ndarray, n_words: np.ndarray
) -> Iterator[tuple[slice, Windows]]:
    """The windows of rows, for the places of known features in them (see `places`), some rows at a
    time. A row without places has one window."""
    work = ends + np.cumsum(n_words // (WINDOW // 2))
    row = 0
    while row < len(ends):
        start, done = (int(ends[row - 1]), int(work[row - 1])) if row else (0, 0)
        last = max(row + 1, int(np.searchsorted(work, done + _PLACES, "right")))
        inside = slice(start, int(ends[last - 1]))
        rows = slice(row, last)
        yield rows, _windows(number[inside], word[inside], ends[rows] - start, n_words[rows])
        row = last


def _windows(
    number: np.ndarray, word: np.ndarray, ends: np.ndarray, n_words: np.ndarray
) -> Windows:
    n_places = np.diff(ends, prepend=0)
    starts = [window_starts(n) if k else [0] for n, k in zip(n_words.tolist(), n_places.tolist())]
    n_windows = np.array([len(some) for some in starts])
    # Rows are put one behind the other, so far apart that no window reaches into the next.
    behind = np.arange(len(ends)) * (int(n_words.max()) + WINDOW)
    at = word + np.repeat(behind, n_places)
    start = np.concatenate(starts) + np.repeat(behind, n_windows)
    low, high = np.searchsorted(at, start), np.searchsorted(at, start + WINDOW)
    window = np.repeat(np.arange(len(start)), high - low)
    begin = np.cumsum(high - low) - (high - low)
    inside = np.arange(len(window)) + (low - begin)[window]
    span = int(number.max(initial=0)) + 1
    entry, count = np.unique(window * span + number[inside], return_counts=True)
    bounds = np.searchsorted(entry, np.arange(len(start) + 1) * span)
    value = np.log2(1.0 + count)
    first = np.cumsum(n_windows) - n_windows
    return Windows(first, bounds[:-1], bounds[1:], entry % span, value)


def window_starts(n_words: int) -> list[int]:
    """The first word of each window."""
    last = max(n_words - WINDOW, 0)
    return [*range(0, last, WINDOW // 2), last]


def features(text: str | None) -> tuple[np.ndarray, np.ndarray, int]:
    """The hash of every word and of its beginnings, repeats included, the number of the word that
    each belongs to, and how many words there are."""
    found, word, first = texts_features([text])
    return found, word, int(first[-1])


def texts_features(
    texts: Sequence[str | None],
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The features of several texts, whose words are numbered on from text to text; last the number
    of the first word of each text, and how many words there are."""
    data, begins = texts_bytes(texts)
    starts, ends = spans(data)
    whole, *parts = beginning_hashes(data, starts, ends, _PREFIXES)
    hashes = [whole[0]]
    hashes += [mix(part + np.uint64(size)) for size, (part, _) in zip(_PREFIXES, parts)]
    word = np.concatenate([whole[1], *[of for _, of in parts]])
    return np.concatenate(hashes), word, np.searchsorted(starts, [*begins, len(data)])


def known_labels(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id and toxic (0 or 1) of the labelled documents."""
    known = labels.where("toxic in (0, 1)").groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    return known.join(docs.select("doc_id").distinct(), "doc_id", "left_semi")


def labelled_rows(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, toxic and text of all labelled rows. Labels that are too many to be sent to the texts
    meet them by a shuffle, whose rows are kept."""
    known = cut(known_labels(docs, labels))
    rows = docs.select("doc_id", "text").join(checked(known), "doc_id")
    return rows if known.count() <= FEW_ROWS else stored(rows)


def fit(docs: DataFrame, labels: DataFrame) -> Severity:
    rows = labelled_rows(docs, labels)
    counts = {r["toxic"]: r["n"] for r in rows.groupBy("toxic").agg(
        F.count("*").alias("n")
    ).collect()}
    n_toxic, n_clean = counts.get(1, 0), counts.get(0, 0)
    if not n_toxic or not n_clean:
        return Severity(np.zeros(0, np.uint64), np.zeros(0), np.zeros(0))
    a, b = F.col("n_toxic") + 0.5, F.col("n_clean") + 0.5
    odds = F.log(a / (n_toxic - a + 1)) - F.log(b / (n_clean - b + 1))
    chosen = (
        _feature_counts(rows)
        .where(F.col("n_toxic") >= LEAST_ROWS)
        .withColumn("z", odds / F.sqrt(1 / a + 1 / b))
        .where(F.col("z") >= LEAST_Z)
        .orderBy(F.desc("z"), "feature")
        .limit(FEATURES)
    )
    values = np.array([row["feature"] for row in chosen.select("feature").collect()], np.int64)
    if not len(values):
        return Severity(np.zeros(0, np.uint64), np.zeros(0), np.zeros(0))
    model = Severity(np.sort(values.view(np.uint64)), np.ones(len(values)), np.zeros(0))
    placed = _placed(rows, model.features)
    # Either label counts as the root of the number of its rows.
    share = np.array([counts[t] ** -0.5 for t in (0, 1)]) / (n_toxic**0.5 + n_clean**0.5)
    # Rows are judged by their worst window, and which one that is the model decides: the first fit
    # takes the one with the most features, each later one what the fit before finds worst.
    state = None
    for _ in range(ROUNDS):
        state = _fitted(_worst_windows(placed, model), len(values), share, state)
        model = Severity(model.features, state[: len(values)], _ordered(state[len(values) :]))
    return calibrated(model, placed.where("toxic = 0"))


def _feature_counts(rows: DataFrame) -> DataFrame:
    """In how many toxic and clean rows each feature occurs. Rows of a slice are added up at once."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in row_groups(batches, "text"):
            feature, word, first = texts_features(batch.column("text").to_pylist())
            order = np.argsort(word, kind="stable")
            bounds = np.searchsorted(word[order], first[1:-1])
            found = [np.unique(some) for some in np.split(feature[order], bounds)]
            toxic = np.array(batch.column("toxic").to_pylist(), dtype=np.int64)
            feature, at = np.unique(np.concatenate(found), return_inverse=True)
            toxic = np.repeat(toxic, [len(f) for f in found])
            counted = np.bincount(at * 2 + toxic, minlength=2 * len(feature)).reshape(-1, 2)
            yield pa.RecordBatch.from_arrays(
                [pa.array(feature.view(np.int64)), *[pa.array(counted[:, t]) for t in (1, 0)]],
                names=["feature", "n_toxic", "n_clean"],
            )

    counted = rows.select("toxic", "text").mapInArrow(
        run, "feature long, n_toxic long, n_clean long"
    )
    return counted.groupBy("feature").agg(
        F.sum("n_toxic").alias("n_toxic"), F.sum("n_clean").alias("n_clean")
    )


def _placed(rows: DataFrame, known: np.ndarray) -> DataFrame:
    """toxic, and where the known features occur in the text (see `places`), of each row."""
    sent = rows.sparkSession.sparkContext.broadcast(known)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in row_groups(batches, "text"):
            number, word, ends, n_words = places(sent.value, batch.column("text").to_pylist())
            offsets = pa.array([0, *ends], pa.int32())
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("toxic").cast(pa.int32()),
                    pa.ListArray.from_arrays(offsets, pa.array(number, pa.int32())),
                    pa.ListArray.from_arrays(offsets, pa.array(word, pa.int32())),
                    pa.array(n_words, pa.int32()),
                ],
                names=["toxic", "number", "word", "n_words"],
            )

    return stored(
        rows.select("toxic", "text").mapInArrow(
            run, "toxic int, number array<int>, word array<int>, n_words int"
        )
    )


def _windows_in(batch: pa.RecordBatch) -> Iterator[tuple[slice, Windows]]:
    """The windows of the rows of `_placed`."""
    number, word = batch.column("number"), batch.column("word")
    offsets = number.offsets.to_numpy()
    yield from windows_of(
        number.flatten().to_numpy(),
        word.flatten().to_numpy(),
        offsets[1:] - offsets[0],
        batch.column("n_words").to_numpy(),
    )


def _worst_windows(placed: DataFrame, model: Severity) -> DataFrame:
    """The first window of each row with the largest score."""
    sent = placed.sparkSession.sparkContext.broadcast(model.weights)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        weights = sent.value
        for batch in batches:
            for rows, windows in _windows_in(batch):
                worst = windows.worst(weights)
                low, high = windows.begin[worst], windows.end[worst]
                offsets = np.cumsum([0, *(high - low)])
                inside = np.arange(offsets[-1]) + np.repeat(low - offsets[:-1], high - low)
                value, bounds = windows.value[inside], zip(offsets[:-1], offsets[1:])
                amount = [float(value[start:end].sum()) for start, end in bounds]
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column("toxic")[rows],
                        pa.ListArray.from_arrays(
                            pa.array(offsets, pa.int32()),
                            pa.array(windows.number[inside], pa.int32()),
                        ),
                        pa.ListArray.from_arrays(
                            pa.array(offsets, pa.int32()), pa.array(value, pa.float64())
                        ),
                        pa.array(amount, pa.float64()),
                    ],
                    names=["toxic", "number", "value", "amount"],
                )

    return stored(
        placed.mapInArrow(
            run, "toxic int, number array<int>, value array<double>, amount double"
        )
    )


def _fitted(
    rows: DataFrame, n_features: int, share: np.ndarray, state: np.ndarray | None
) -> np.ndarray:
    """The state of a fit on the windows of all rows, from the state of the one before."""
    amounts = rows.where("toxic = 1").select("amount")
    thirds = [value_at(amounts, part) for part in (1 / 3, 2 / 3)]

    def blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """The rows of a batch as arrays, in one row."""
        for batch in batches:
            toxic = batch.column("toxic").to_numpy()
            amount = batch.column("amount").to_numpy()
            grade = toxic * (1 + sum((amount > third).astype(np.int64) for third in thirds))
            number = batch.column("number")
            arrays = [
                np.diff(number.offsets.to_numpy()),
                number.flatten().to_numpy(),
                batch.column("value").flatten().to_numpy(),
                grade.astype(np.int64),
                share[toxic],
            ]
            yield pa.RecordBatch.from_arrays(
                [pa.array([array.tobytes()], pa.binary()) for array in arrays], names=[*_BLOCK]
            )

    # A step is short, so a task takes many rows; there are more tasks as there are more rows.
    few = rows.coalesce(1 + rows.count() // BLOCK_ROWS)
    packed = few.mapInArrow(blocks, ", ".join(f"{name} binary" for name in _BLOCK))
    # Kept as Python hands them over: each step reads them, and no step turns rows into objects.
    held = packed.rdd.map(lambda block: [bytes(part) for part in block]).persist(StorageLevel.MEMORY_AND_DISK)

    def slopes(at: np.ndarray) -> np.ndarray:
        def summed(blocks: Iterator) -> Iterator[np.ndarray]:
            total = np.zeros(len(at))
            for block in blocks:
                arrays = [np.frombuffer(block[n], dtype=d) for n, d in enumerate(_BLOCK.values())]
                sizes, number, value, grade, of = arrays
                owner = np.repeat(np.arange(len(grade)), sizes)
                total += likelihood_slopes(at, n_features, owner, number, value, grade, of)
            yield total

        # One vector a task; they are added in the order of the tasks, so that runs agree.
        return np.sum(held.mapPartitions(summed).collect(), axis=0)

    try:
        return descend(n_features, slopes, STEPS if state is None else MORE_STEPS, RATE, state)
    finally:
        held.unpersist()


_BLOCK = {
    "sizes": np.int32,
    "number": np.int32,
    "value": np.float64,
    "grade": np.int64,
    "share": np.float64,
}


def value_at(values: DataFrame, part: float) -> float:
    """A bound that the given part of all values of a column, none of them negative, does not exceed,
    and hardly more: the upper edge of the bin with the value of that rank, among `BINS` between
    0 and the largest value, and again inside that bin. 0 if there are no values."""
    value = F.col(values.columns[0])
    total, largest = values.agg(F.count(value), F.max(value)).first()
    rank = max(round(part * total), 1)
    low, high = 0.0, largest or 0.0
    for _ in range(2):
        if high <= low:
            break
        step = (high - low) / BINS
        # Bin n holds the values above its lower edge, up to its upper one.
        number = F.least(F.ceil((value - low) / step) - 1, F.lit(BINS - 1))
        number = F.when(value <= low, -1).otherwise(number).alias("bin")
        found = values.where(value <= high).groupBy(number).agg(F.count("*").alias("n")).collect()
        below = 0
        for row in sorted(found):
            below += row["n"]
            if below >= rank:
                break
        if row["bin"] < 0:
            return low
        low, high = low + row["bin"] * step, low + (row["bin"] + 1) * step
    return high


def calibrated(model: Severity, clean: DataFrame, reject: float = REJECT) -> Severity:
    """The model with its thresholds raised, if need be, until of all windows of all clean rows only
    a share of `FALSE_WINDOWS` is rejected. A text has as many windows as it is long, so without
    this long clean texts would be rejected for one window in a hundred. `clean` are rows of
    `_placed`."""
    sent = clean.sparkSession.sparkContext.broadcast(model.weights)

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for _, windows in _windows_in(batch):
                found = pa.array(windows.scores(sent.value), pa.float64())
                yield pa.RecordBatch.from_arrays([found], names=["score"])

    scores = stored(clean.mapInArrow(score, "score double"))
    most = value_at(scores, 1 - FALSE_WINDOWS)
    low, high = 0.0, 1000.0
    while high - low > 1e-6:
        shift = (low + high) / 2
        raised = Severity(model.features, model.weights, model.thresholds + shift)
        low, high = (shift, high) if raised.severity_of(most) >= reject else (low, shift)
    if model.severity_of(most) < reject:
        high = 0.0
    return Severity(model.features, model.weights, model.thresholds + high)


def fit_cumulative_link(
    owner: np.ndarray,
    column: np.ndarray,
    value: np.ndarray,
    grade: np.ndarray,
    n_features: int,
    share: np.ndarray | None = None,
    steps: int = 400,
    rate: float = 0.05,
) -> tuple[np.ndarray, np.ndarray]:
    """Weights and ordered thresholds of rows that are at hand, which count by their `share`, by
    default alike."""
    share = np.ones(len(grade)) if share is None else share
    share = share / share.sum()
    state = descend(
        n_features,
        lambda at: likelihood_slopes(at, n_features, owner, column, value, grade, share),
        steps,
        rate,
    )
    return state[:n_features], _ordered(state[n_features:])


def descend(
    n_features: int,
    slopes: Callable[[np.ndarray], np.ndarray],
    steps: int,
    rate: float,
    state: np.ndarray | None = None,
    grades: int = 4,
    penalty: float = 1e-4,
) -> np.ndarray:
    """Weights and thresholds after gradient steps (Adam) on the mean log-likelihood, at a rate that
    falls to 0. Weights stay at 0 or above.

    Thresholds are the first one and positive gaps, so their order holds throughout."""
    if state is None:
        state = np.concatenate((np.zeros(n_features), [1.0], np.zeros(grades - 2)))
    first, second = np.zeros_like(state), np.zeros_like(state)
    for step in range(1, steps + 1):
        slope = slopes(state)
        slope[:n_features] += penalty * state[:n_features]
        first = 0.9 * first + 0.1 * slope
        second = 0.999 * second + 0.001 * slope**2
        state = state - rate * (1 - (step - 1) / steps) * (first / (1 - 0.9**step)) / (
            np.sqrt(second / (1 - 0.999**step)) + 1e-8
        )
        state[:n_features] = np.maximum(state[:n_features], 0.0)
    return state


def likelihood_slopes(
    state: np.ndarray,
    n_features: int,
    owner: np.ndarray,
    column: np.ndarray,
    value: np.ndarray,
    grade: np.ndarray,
    share: np.ndarray,
) -> np.ndarray:
    """What some rows add to the slopes of the mean log-likelihood, as a loss."""
    n = len(grade)
    weights, raw = state[:n_features], state[n_features:]
    grades = len(raw) + 1
    score = np.bincount(owner, weights=weights[column] * value, minlength=n)
    thresholds = _ordered(raw)
    cdf = np.hstack(
        (np.zeros((n, 1)), 1 / (1 + np.exp(score[:, None] - thresholds)), np.ones((n, 1)))
    )
    rows = np.arange(n)
    mass = np.maximum(cdf[rows, grade + 1] - cdf[rows, grade], 1e-9)
    slope = cdf * (1 - cdf)
    by_score = (slope[rows, grade + 1] - slope[rows, grade]) / mass * share
    by_threshold = np.zeros((n, grades - 1))
    upper, lower = grade < grades - 1, grade > 0
    by_mass = share / mass
    by_threshold[rows[upper], grade[upper]] -= (slope[rows, grade + 1] * by_mass)[upper]
    by_threshold[rows[lower], grade[lower] - 1] += (slope[rows, grade] * by_mass)[lower]
    t_slope = by_threshold.sum(axis=0)
    raw_slope = np.array(
        [t_slope[k:].sum() * (1.0 if k == 0 else np.exp(raw[k])) for k in range(grades - 1)]
    )
    w_slope = np.bincount(column, weights=by_score[owner] * value, minlength=n_features)
    return np.concatenate((w_slope, raw_slope))


def _ordered(raw: np.ndarray) -> np.ndarray:
    return np.cumsum(np.concatenate((raw[:1], np.exp(raw[1:]))))


def severity(docs: DataFrame, model: Severity, reject: float = REJECT) -> DataFrame:
    """doc_id, expected severity (0 to 3), and whether the document is rejected."""
    sent = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in row_groups(batches, "text"):
            found = sent.value.expected_of(batch.column("text").to_pylist())
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(found, pa.float64())],
                names=["doc_id", "severity"],
            )

    scored = docs.select("doc_id", "text").mapInArrow(run, "doc_id long, severity double")
    return scored.withColumn("toxic", F.col("severity") >= reject)


def drop_toxic(docs: DataFrame, labels: DataFrame, reject: float = REJECT) -> DataFrame:
    """The documents that are not rejected, with all their columns. Each row is judged by its own
    text, whatever its doc_id."""
    sent = docs.sparkSession.sparkContext.broadcast(fit(docs, labels))
    return filtered(docs, lambda texts: sent.value.expected_of(texts) < reject)
