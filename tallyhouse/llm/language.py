"""The language of documents and pages by Bayesian fusion of evidence.

Four kinds of evidence are combined: the likelihood of the text under a model of each language's
byte trigrams; the declared language (a page's `lang` attribute, a document's `lang`), through how
often texts of each language declare what; the address suffix; and the host. The prior of a host is
smoothed towards that of its registered domain, that towards its suffix's, and that towards the
prior of all rows. All are grouped sums of the texts' posteriors over the whole table, less
the row's own share. A document's source takes the host's place.

Trigrams are not independent, so a text's log-likelihood counts with a fraction of its weight and
no more than as that of `MOST` trigrams.

The trigram models are fitted on a bounded sample of the documents with a label: about `SAMPLE` per
language, chosen by a hash of doc_id. Everything is scored whole, and every language with a label is
told apart.

Edge cases: a row without text, declaration and address gets the prior of all rows. Null and empty
texts and unknown declarations carry no evidence. Without labelled documents the result has no
language. Repeated rows count as often as they occur.
"""

from __future__ import annotations

import html as entities
import re
from bisect import bisect_left
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyhouse.llm.shared import cut, row_groups

SAMPLE = 500
#: Weight of a trigram's log-likelihood, and trigrams that count at most.
WEIGHT, MOST = 0.2, 500
#: Rows that the prior of the level above counts as.
SMOOTHING = 5.0
_CELLS = 1 << 16
_SET_ASIDE = re.compile(
    r"(?i)<(/?)(head|script|style|nav|header|footer|aside|form|noscript|template)\b"
)
_TAG_END = re.compile(r"\s*>")
_DECLARED = re.compile(r"(?is)<html\b[^>]*?\blang\s*=\s*[\"']?\s*([a-z]{2,3})\b")
_OPENED = re.compile(r"(?i)<html\b")
_PIECE = 1 << 20
#: Numbers of the trigram table that are looked up at once.
_LOOKED_UP = 4_000_000


@dataclass
class TrigramModel:
    """Languages and the log-probability of each trigram cell in each."""

    languages: list[str]
    table: np.ndarray

    def log_likelihood(self, text: str | None) -> np.ndarray:
        """The tempered log-likelihood of the text in each language, best one 0."""
        total, count = np.zeros(len(self.languages)), 0
        step = max(_LOOKED_UP // max(len(total), 1), 1)
        for cells in trigrams(text):
            for start in range(0, len(cells), step):
                total += self.table[cells[start : start + step]].sum(axis=0, dtype=np.float64)
            count += len(cells)
        if not count or not len(total):
            return np.zeros(len(self.languages))
        total = total * (WEIGHT * min(1.0, MOST / count))
        return total - total.max()


def trigrams(text: str | None) -> Iterator[np.ndarray]:
    """The cells of the trigrams of the text's bytes, lower case, ASCII that is no letter as one
    space; in pieces."""
    cleaned = re.sub(r"[\x00-\x40\x5b-\x60\x7b-\x7f]+", " ", (text or "").lower()).strip()
    data = np.frombuffer(cleaned.encode("utf-8", "replace"), dtype=np.uint8)
    for start in range(0, max(len(data) - 2, 0), _PIECE):
        piece = data[start : start + _PIECE + 2].astype(np.uint32)
        mixed = (piece[:-2] * 961 + piece[1:-1] * 31 + piece[2:]) * np.uint32(2654435761)
        yield (mixed >> np.uint32(16)).astype(np.int64)


def page_text(html: str | None) -> str:
    """The text of a page without the parts that the HTML standard sets aside, and markup."""
    return entities.unescape(_without_markup(_without_parts(html or "")))


def _without_parts(html: str) -> str:
    """The html with a space for each part, from its start to the next end of its name. A part that
    nothing ends is not one. The page is searched once, however many are not ended."""
    opened: list[tuple[int, int, str]] = []
    closed: dict[str, list[tuple[int, int]]] = {}
    for found in _SET_ASIDE.finditer(html):
        name = found[2].lower()
        if not found[1]:
            opened.append((found.start(), found.end(), name))
        elif end := _TAG_END.match(html, found.end()):
            closed.setdefault(name, []).append((found.start(), end.end()))
    out, at = [], 0
    for start, after, name in opened:
        if start < at:
            continue
        ends = closed.get(name, [])
        turn = bisect_left(ends, (after, 0))
        if turn < len(ends):
            out += [html[at:start], " "]
            at = ends[turn][1]
    return "".join([*out, html[at:]])


def _without_markup(html: str) -> str:
    """The html with a space for each comment and tag; what is not ended is neither."""
    out, at, begin = [], 0, html.find("<")
    comments = True
    while begin >= 0:
        end = -1
        if comments and html.startswith("<!--", begin):
            end = html.find("-->", begin + 4) + 3
            comments = end >= 3
        if end < 3:
            end = html.find(">", begin + 1) + 1
            if not end:
                break
        out += [html[at:begin], " "]
        at = end
        begin = html.find("<", end)
    return "".join([*out, html[at:]])


def declared(html: str | None) -> str | None:
    """The `lang` of the first html element that has one, wherever it begins."""
    html, at = html or "", 0
    while opened := _OPENED.search(html, at):
        end = html.find(">", opened.end())
        at = len(html) if end < 0 else end
        if found := _DECLARED.match(html, opened.start(), at):
            return found[1].lower()
    return None


def fit(docs: DataFrame, sample: int = SAMPLE) -> TrigramModel:
    """Trigram models of the languages of labelled documents."""
    labelled = docs.where("lang is not null and text is not null")
    sizes = labelled.groupBy("lang").agg(F.count("*").alias("n"))
    counts = {row["lang"]: row["n"] for row in sizes.collect()}
    names = sorted(counts)
    if not names:
        return TrigramModel([], np.zeros((_CELLS, 0), np.float32))
    shares = docs.sparkSession.createDataFrame(
        [(name, sample / n) for name, n in counts.items()], "lang string, share double"
    )
    turn = F.pmod(F.xxhash64("doc_id"), F.lit(1 << 30)) / float(1 << 30)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in row_groups(batches, "text"):
            seen: dict[str, np.ndarray] = {}
            rows = zip(*(batch.column(n).to_pylist() for n in ("lang", "text")), strict=True)
            for lang, text in rows:
                counted = seen.setdefault(lang, np.zeros(_CELLS, dtype=np.int64))
                for cells in trigrams(text):
                    counted += np.bincount(cells, minlength=_CELLS)
            for lang, counted in seen.items():
                used = np.flatnonzero(counted)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([lang] * len(used), pa.string()),
                        pa.array(used, pa.int64()),
                        pa.array(counted[used], pa.int64()),
                    ],
                    names=["lang", "cell", "n"],
                )

    cells = (
        labelled.select("doc_id", "lang", "text")
        .join(F.broadcast(shares), "lang")
        .where(turn < F.col("share"))
        .select("lang", "text")
        .mapInArrow(run, "lang string, cell long, n long")
        .groupBy("lang", "cell")
        .agg(F.sum("n").alias("n"))
    )
    table = np.zeros((_CELLS, len(names)))
    place = {name: number for number, name in enumerate(names)}
    for row in cells.toLocalIterator():
        table[row["cell"], place[row["lang"]]] = row["n"]
    table += 0.1
    table /= table.sum(axis=0)
    return TrigramModel(names, np.log(table, out=table).astype(np.float32))


def evidence(docs: DataFrame | None, pages: DataFrame | None, model: TrigramModel) -> DataFrame:
    """Of every row: doc_id or page_id, host, domain, suffix, declared language, and the
    log-likelihoods of its text."""
    parts = []
    if docs is not None:
        host = F.concat(F.lit("source "), F.coalesce("source", F.lit("")))
        rows = docs.select(
            "doc_id", F.lit(None).cast("long").alias("page_id"), F.lower("lang").alias("declared"),
            host.alias("host"), host.alias("domain"), F.lit("source").alias("suffix"), "text",
        )
        parts.append(_scored(rows, model, of_pages=False))
    if pages is not None:
        host = F.lower(F.regexp_extract(F.coalesce("url", F.lit("")), r"^\w+://([^/:?#]*)", 1))
        rows = pages.select(
            F.lit(None).cast("long").alias("doc_id"), "page_id",
            F.lit(None).cast("string").alias("declared"), host.alias("host"),
            F.regexp_extract(host, r"([^.]*\.?[^.]*)$", 1).alias("domain"),
            F.regexp_extract(host, r"([^.]*)$", 1).alias("suffix"),
            F.col("html").alias("text"),
        )
        parts.append(_scored(rows, model, of_pages=True))
    return parts[0] if len(parts) == 1 else parts[0].union(parts[1])


def _scored(rows: DataFrame, model: TrigramModel, of_pages: bool) -> DataFrame:
    sent = rows.sparkSession.sparkContext.broadcast(model)
    plain = ("doc_id", "page_id", "host", "domain", "suffix")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = set(sent.value.languages)
        for batch in row_groups(batches, "text"):
            texts = batch.column("text").to_pylist()
            said = batch.column("declared").to_pylist()
            if of_pages:
                said = [declared(text) for text in texts]
                texts = [page_text(text) for text in texts]
            said = [name if name is None or name in known else "other" for name in said]
            told = [sent.value.log_likelihood(text) for text in texts]
            yield pa.RecordBatch.from_arrays(
                [
                    *(batch.column(name) for name in plain),
                    pa.array(said, pa.string()),
                    pa.array(told, pa.list_(pa.float64())),
                ],
                names=[*plain, "declared", "text_evidence"],
            )

    return rows.mapInArrow(
        run,
        "doc_id long, page_id long, host string, domain string, suffix string, "
        "declared string, text_evidence array<double>",
    )


def _sums(size: int) -> list[Column]:
    return [F.sum(F.col("belief")[i]).alias(f"s{i}") for i in range(size)]


def _softmax(scores: np.ndarray) -> np.ndarray:
    scores = np.exp(scores - scores.max(axis=1, keepdims=True))
    return scores / scores.sum(axis=1, keepdims=True)


def _with_belief(rows: DataFrame) -> DataFrame:
    """The rows with the posterior of the text alone."""
    weights = F.transform("text_evidence", lambda x: F.exp(x))
    total = F.aggregate(weights, F.lit(0.0), lambda a, x: a + x)
    return rows.withColumn("belief", F.transform(weights, lambda x: x / total))


def host_levels(rows: DataFrame, size: int) -> DataFrame:
    """host, and for its host, domain, suffix and all rows the summed beliefs and their number."""
    hosts = cut(rows.groupBy("host", "domain", "suffix").agg(F.count("*").alias("n"), *_sums(size)))
    names = ["n", *(f"s{i}" for i in range(size))]

    def level(keys: list[str], name: str) -> DataFrame:
        summed = hosts.groupBy(*keys).agg(*[F.sum(c).alias(c) for c in names])
        return summed.select(*keys, F.array(*[F.col(c).cast("double") for c in names]).alias(name))

    out = hosts.select(
        "host", "domain", "suffix", F.array(*[F.col(c).cast("double") for c in names]).alias("own")
    )
    out = out.join(level(["domain", "suffix"], "of_domain"), ["domain", "suffix"])
    out = out.join(level(["suffix"], "of_suffix"), "suffix")
    everything = level([], "of_all").first()
    all_rows = everything["of_all"] if everything["of_all"][0] is not None else [0.0] * (size + 1)
    return out.select("host", "own", "of_domain", "of_suffix").withColumn(
        "of_all", F.array(*[F.lit(float(x)) for x in all_rows])
    )


def declarations(rows: DataFrame, model: TrigramModel) -> dict[str, np.ndarray]:
    """The log-probability that a row of each language declares a language, by what it declares;
    pages and documents apart."""
    size = len(model.languages)
    counted = (
        rows.where("declared is not null")
        .groupBy(F.col("page_id").isNull().alias("is_doc"), "declared")
        .agg(*_sums(size))
        .collect()
    )
    out = {}
    for is_doc in (True, False):
        mine = {r["declared"]: np.array(r[2:], float) for r in counted if r["is_doc"] == is_doc}
        total = sum(mine.values(), np.zeros(size)) + 0.5 * (size + 1)
        for name in [*model.languages, "other"]:
            out[f"{is_doc} {name}"] = np.log((mine.get(name, np.zeros(size)) + 0.5) / total)
    return out


def identified(
    docs: DataFrame | None, pages: DataFrame | None, model: TrigramModel
) -> DataFrame:
    """A row per document and page: doc_id or page_id, language, its probability, the language of
    the text alone, and the declared one."""
    rows = cut(_with_belief(evidence(docs, pages, model)))
    size = len(model.languages)
    schema = (
        "doc_id long, page_id long, language string, probability double, text_language string, "
        "declared string"
    )
    if not size:
        empty = F.lit(None).cast("string")
        return rows.select(
            "doc_id", "page_id", empty.alias("language"),
            F.lit(None).cast("double").alias("probability"), empty.alias("text_language"),
            "declared",
        )
    levels = cut(host_levels(rows, size))
    sent = rows.sparkSession.sparkContext.broadcast((model.languages, declarations(rows, model)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        languages, said = sent.value
        for batch in batches:
            if not batch.num_rows:
                continue
            n = batch.num_rows
            belief = np.array(batch.column("belief").to_pylist(), float).reshape(n, size)
            text = np.array(batch.column("text_evidence").to_pylist(), float).reshape(n, size)
            prior = np.full((n, size), 1.0 / size)
            for name in ("of_all", "of_suffix", "of_domain", "own"):
                level = np.array(batch.column(name).to_pylist(), float)
                others = np.maximum(level[:, 1:] - belief, 0.0)
                count = np.maximum(level[:, :1] - 1.0, 0.0)
                prior = (others + SMOOTHING * prior) / (count + SMOOTHING)
            is_doc = [x is None for x in batch.column("page_id").to_pylist()]
            stated = batch.column("declared").to_pylist()
            claims = np.array(
                [
                    np.zeros(size) if name is None else said[f"{doc} {name}"]
                    for doc, name in zip(is_doc, stated, strict=True)
                ]
            )
            chance = _softmax(text + claims + np.log(np.maximum(prior, 1e-12)))
            best = chance.argmax(axis=1)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id"),
                    batch.column("page_id"),
                    pa.array([languages[i] for i in best], pa.string()),
                    pa.array(np.round(chance[np.arange(n), best], 4)),
                    pa.array([languages[i] for i in belief.argmax(axis=1)], pa.string()),
                    batch.column("declared"),
                ],
                names=[field.split()[0] for field in schema.split(", ")],
            )

    return rows.join(levels, "host").mapInArrow(run, schema)
