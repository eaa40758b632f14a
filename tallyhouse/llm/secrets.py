"""Secret scans whose false positives a random forest removes.

Candidates are found by patterns: long runs of letters and digits, values assigned to a name, and
known formats. The forest judges a candidate by its length, its transitions between characters,
how much of it dictionary words cover, the words beside it, and its path. The path is the document's
source and the last path or address in the `PATH_BEFORE` characters before the candidate: whether
there is one, how deep it is, whether parts of it name tests and examples or live settings; and how
many candidates the document has, and a document of its source on average (a grouped aggregate over
all findings).

The dictionary is the `WORDS` most frequent words of the whole table, counted over all texts. The
forest is trained on labelled findings: `EXAMPLES` of either label, of the kinds in `SECRETS` and
`HARMLESS`, set into texts of a sample of the table (the first `TEXT_CHARS` characters of `TEXTS`
documents, by a hash), with a path or without, and described by the same code.

Edge cases: null and empty texts have no candidates. A null source has no path and is a source of
its own. Overlapping candidates are one: the one that begins first, then the longer. Repeated rows
give repeated findings. An empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
import math
import random
import re
from collections import Counter
from collections.abc import Collection, Iterator

import pyarrow as pa
from pyspark.ml.classification import RandomForestClassificationModel, RandomForestClassifier
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyhouse.llm.shared import checked, cut, row_groups, stored

#: Words of the dictionary; labelled findings of either label; trees and their depth.
WORDS, EXAMPLES, TREES, DEPTH = 20_000, 1500, 30, 8
#: Probability from which on a finding is a secret.
LIMIT = 0.5
#: Characters on either side that count as neighbours, and those before that can hold the path.
BESIDE, PATH_BEFORE = 40, 200
#: Documents, and characters of each, that labelled findings are set into.
TEXTS, TEXT_CHARS = 300, 4000

# Formats in which services issue keys, and names that keys are assigned to.
FORMATS = {
    "aws": r"\b(?:AKIA|ASIA)[0-9A-Z]{16}\b",
    "github": r"\bgh[pousr]_[0-9A-Za-z]{36}\b",
    "slack": r"\bxox[abprs]-[0-9A-Za-z-]{10,72}",
    "stripe": r"\b[sr]k_(?:live|test)_[0-9A-Za-z]{16,}",
    "google": r"\bAIza[0-9A-Za-z_-]{35}",
    "jwt": r"\beyJ[0-9A-Za-z_-]{8,}\.[0-9A-Za-z_-]{8,}\.[0-9A-Za-z_-]{8,}",
    "pem": r"-----BEGIN [A-Z ]*PRIVATE KEY-----",
}
KEY_NAMES = (
    "token secret password passwd pwd key apikey api_key access_key secret_key auth bearer "
    "credential credentials private client_secret"
).split()
OTHER_NAMES = (
    "commit sha sha1 sha256 md5 checksum digest hash revision build uuid guid id order invoice "
    "phone card number version page image file isbn serial"
).split()
TEST_PARTS = (
    "test tests testing testdata spec fixture fixtures example examples sample samples mock mocks "
    "demo docs vendor"
).split()
LIVE_PARTS = (
    "config configs conf settings secrets credentials env prod production deploy private keys"
).split()
_PATTERNS = [(kind, re.compile(pattern)) for kind, pattern in FORMATS.items()]
_ASSIGNMENT = re.compile(r"[:=]+(?=\s*[\"']?([^\s\"'<>]{8,}))")
_NAMES = tuple(KEY_NAMES)
_LONGEST_NAME = max(map(len, KEY_NAMES))
_DIGITS = re.compile(r"[0-9]+")
_RUN = re.compile(r"[A-Za-z0-9+/_=-]+")
_RUN_CHARS = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/_=-")
_LEAST_RUN = 16
_PARTS = re.compile(r"[^\W_]+")
_WORD = re.compile(r"[^\W\d_]{3,20}")
_FIELDS = (
    "length", "digits", "upper", "lower", "other", "changes", "entropy", "pairs", "repeat", "hex",
    "coverage", "format", "assigned", "key_near", "other_near", "quoted", "equals", "near_words",
    "near_digits", "path_candidates", "path_there", "path_depth", "path_test", "path_live",
    "path_rate",
)
_SCHEMA = (
    "doc_id long, source string, start int, length int, kind string, digest string, "
    "features array<double>"
)


def candidates(text: str | None) -> list[tuple[int, int, str]]:
    """Start, end and kind of the candidates of a text, without overlaps."""
    text = text or ""
    found = [(start, end, "run") for start, end in _runs(text)]
    for kind, pattern in _PATTERNS:
        found += [(*match.span(), kind) for match in pattern.finditer(text)]
    for match in _ASSIGNMENT.finditer(text):
        end = match.start()
        while end and text[end - 1].isspace():
            end -= 1
        if text[max(0, end - _LONGEST_NAME) : end].lower().endswith(_NAMES):
            found.append((*match.span(1), "assigned"))
    found.sort(key=lambda c: (c[0], -c[1], c[2] not in FORMATS, c[2] == "run", c[2]))
    out: list[tuple[int, int, str]] = []
    for start, end, kind in found:
        if not out or start >= out[-1][1]:
            out.append((start, end, kind))
    return out


def _runs(text: str) -> Iterator[tuple[int, int]]:
    """Start and end of the long runs that have a digit, found from their digits."""
    done = 0
    for digits in _DIGITS.finditer(text):
        if digits.start() < done:
            continue
        start, before = digits.start(), done
        done = _RUN.match(text, start).end()
        while start > before and text[start - 1] in _RUN_CHARS:
            start -= 1
        if done - start >= _LEAST_RUN:
            yield start, done


def coverage(candidate: str, dictionary: set[str]) -> float:
    """The share of the characters that dictionary words of 3 to 12 letters cover."""
    lower, covered = candidate.lower(), bytearray(len(candidate))
    for start in range(len(lower) - 2):
        for size in range(min(12, len(lower) - start), 2, -1):
            if lower[start : start + size] in dictionary:
                covered[start : start + size] = b"\x01" * size
                break
    return sum(covered) / max(len(candidate), 1)


def path_of(text: str, start: int, source: str | None) -> list[str]:
    """The parts of the path of what begins at a place: the source's, and those of the last word
    before that place that has a slash."""
    before = text[max(0, start - PATH_BEFORE) : start].split()
    named = next((word for word in reversed(before) if "/" in word or "\\" in word), "")
    return _PARTS.findall(f"{source or ''}/{named}".lower())


def describe(
    text: str,
    start: int,
    end: int,
    kind: str,
    n_found: int,
    dictionary: set[str],
    source: str | None = None,
) -> list[float]:
    """The features of a candidate, in the order of `_FIELDS`, but for the last: its source's rate
    is known when all findings are."""
    value = text[start:end]
    n = len(value)
    digits = sum(c.isdigit() for c in value)
    upper = sum(c.isupper() for c in value)
    lower = sum(c.islower() for c in value)
    kinds = [(c.isdigit(), c.isupper(), c.islower()) for c in value]
    counts = Counter(value)
    entropy = -sum(c / n * math.log2(c / n) for c in counts.values())
    before, after = text[max(0, start - BESIDE) : start], text[end : end + BESIDE]
    near = re.findall(r"[a-z0-9_]+", before.lower())[-3:]
    parts = {part for word in near for part in (word, *word.split("_"))}
    path = path_of(text, start, source)
    around = [w.lower() for w in _WORD.findall(before + " " + after)]
    return [
        float(n),
        digits / n,
        upper / n,
        lower / n,
        (n - digits - upper - lower) / n,
        sum(a != b for a, b in zip(kinds, kinds[1:], strict=False)) / max(n - 1, 1),
        entropy,
        len({value[i : i + 2] for i in range(n - 1)}) / max(n - 1, 1),
        max(counts.values()) / n,
        float(re.fullmatch(r"[0-9a-f]+|[0-9A-F]+", value) is not None),
        coverage(value, dictionary),
        float(kind in FORMATS),
        float(kind == "assigned"),
        float(bool(parts.intersection(KEY_NAMES))),
        float(bool(parts.intersection(OTHER_NAMES))),
        float(before.endswith(('"', "'", "`"))),
        float("=" in before[-4:] or ":" in before[-4:]),
        sum(w in dictionary for w in around) / max(len(around), 1),
        sum(c.isdigit() for c in before + after) / max(len(before + after), 1),
        math.log1p(n_found),
        float(bool(path)),
        float(len(path)),
        float(bool(set(path).intersection(TEST_PARTS))),
        float(bool(set(path).intersection(LIVE_PARTS))),
    ]


def dictionary(docs: DataFrame, words: int = WORDS) -> set[str]:
    """The most frequent words, counted over all texts; ties in alphabetical order."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in row_groups(batches, "text", 8_000_000):
            counts: Counter[str] = Counter()
            for text in batch.column("text").to_pylist():
                counts.update(_WORD.findall((text or "").lower()))
            yield pa.RecordBatch.from_arrays(
                [pa.array(list(counts), pa.string()), pa.array(list(counts.values()), pa.int64())],
                names=["word", "n"],
            )

    found = docs.select("text").mapInArrow(run, "word string, n long")
    counted = cut(found.groupBy("word").agg(F.sum("n").alias("n")))
    # Words as frequent as the last one wanted, told by steps of an eighth of a power of two: few
    # others go through the ranking.
    step = F.floor(8 * F.log2("n")).cast("int")
    steps = counted.groupBy(step.alias("step")).agg(F.count("*").alias("words")).collect()
    left, least = words, 0
    for row in sorted(steps, key=lambda r: -r["step"]):
        left, least = left - row["words"], row["step"]
        if left <= 0:
            break
    top = counted.where(step >= least).orderBy(F.desc("n"), "word").limit(words)
    return {row["word"] for row in top.select("word").collect()}


def findings(docs: DataFrame, known: set[str]) -> DataFrame:
    """Every candidate: doc_id, source, start, length, kind, SHA-256 of the value, and its features
    without its source's rate."""
    sent = docs.sparkSession.sparkContext.broadcast(known)
    kinds = [
        pa.int64(), pa.string(), pa.int32(), pa.int32(), pa.string(), pa.string(),
        pa.list_(pa.float64()),
    ]
    names = [field.split()[0] for field in _SCHEMA.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in row_groups(batches, "text"):
            rows = []
            for doc_id, source, text in zip(
                *(batch.column(n).to_pylist() for n in ("doc_id", "source", "text")), strict=True
            ):
                found = candidates(text)
                for start, end, kind in found:
                    digest = hashlib.sha256(text[start:end].encode()).hexdigest()
                    told = describe(text, start, end, kind, len(found), sent.value, source)
                    rows.append((doc_id, source, start, end - start, kind, digest, told))
            yield pa.RecordBatch.from_arrays(
                [pa.array([row[i] for row in rows], k) for i, k in enumerate(kinds)], names=names
            )

    return docs.select("doc_id", "source", "text").mapInArrow(run, _SCHEMA)


def with_rates(rows: DataFrame, docs: DataFrame) -> DataFrame:
    """The findings with the last feature: how many candidates a document of their source has, on
    average over the whole table. Findings are counted before they move, and a large source's
    findings are joined by as many tasks as hold them."""
    found = rows.groupBy("source").agg(F.count("*").alias("__found"))
    held = docs.groupBy("source").agg(F.count("*").alias("__docs"))
    rates = cut(
        found.join(held, found["source"].eqNullSafe(held["source"])).select(
            found["source"].alias("__source"),
            F.log1p(F.col("__found") / F.col("__docs")).alias("__rate"),
        )
    )
    same = F.col("source").eqNullSafe(F.col("__source"))
    features = F.concat("features", F.array("__rate"))
    return rows.join(checked(rates), same).select(
        *[features.alias(c) if c == "features" else c for c in rows.columns]
    )


def sampled_texts(docs: DataFrame, texts: int = TEXTS) -> list[str]:
    """The beginnings of some documents, to set labelled findings into: chosen by hashes alone."""
    key = F.xxhash64("doc_id", "text").alias("__key")
    there = docs.where(F.length("text") > 0)
    chosen = there.select(key).distinct().orderBy("__key").limit(texts)
    rows = there.select(key, F.substring("text", 1, TEXT_CHARS).alias("text")).join(
        F.broadcast(chosen), "__key"
    )
    found = rows.groupBy("__key").agg(F.max("text").alias("text")).orderBy("__key")
    return [row["text"] for row in found.collect()]


_HEX, _LETTERS = "0123456789abcdef", "abcdefghijklmnopqrstuvwxyz"
_MIXED = _LETTERS + _LETTERS.upper() + "0123456789"


def _drawn(rng: random.Random, alphabet: str, low: int, high: int = 0) -> str:
    return "".join(rng.choice(alphabet) for _ in range(rng.randint(low, high or low)))


def _issued(rng: random.Random, words: list[str]) -> str:
    made = {
        "aws": "AKIA" + _drawn(rng, _LETTERS.upper() + "0123456789", 16),
        "github": "ghp_" + _drawn(rng, _MIXED, 36),
        "slack": "xoxb-" + _drawn(rng, "0123456789", 11) + "-" + _drawn(rng, _MIXED, 24),
        "stripe": "sk_live_" + _drawn(rng, _MIXED, 24),
        "google": "AIza" + _drawn(rng, _MIXED, 35),
        "jwt": "eyJ" + ".".join(_drawn(rng, _MIXED, 20, 60) for _ in range(3)),
    }
    return rng.choice(list(made.values()))


def _assigned(rng: random.Random, words: list[str], value: str) -> str:
    name = rng.choice(KEY_NAMES)
    name = rng.choice([name, name.upper(), f"{rng.choice(words)}_{name}"])
    quote = rng.choice(['"', "'", ""])
    return f"{name}{rng.choice([' = ', '=', ': ', ':'])}{quote}{value}{quote}"


#: Kinds of labelled findings, and how one is made. What is in a test's path is harmless, also if it
#: looks like a secret.
SECRETS = {
    "issued": _issued,
    "hex": lambda r, w: _assigned(r, w, _drawn(r, _HEX, r.choice([32, 40, 64]))),
    "mixed": lambda r, w: _assigned(r, w, _drawn(r, _MIXED, 20, 48)),
    "base64": lambda r, w: _assigned(r, w, _drawn(r, _MIXED + "+/", 40)),
}
HARMLESS = {
    "digest": lambda r, w: r.choice(["{} {}", "{}: {}", '{}="{}"']).format(
        r.choice(OTHER_NAMES), _drawn(r, _HEX, r.choice([32, 40, 64]))
    ),
    "number": lambda r, w: _drawn(r, "0123456789", 16, 24),
    "name": lambda r, w: r.choice(["-", "_", ""]).join(r.choice(w) for _ in range(4))
    + _drawn(r, "0123456789", 1, 4),
    "path": lambda r, w: "/".join(r.choice(w) for _ in range(4)) + "/" + _drawn(r, _HEX, 2, 6),
    "uuid": lambda r, w: r.choice(["id ", "uuid=", ""])
    + "-".join(_drawn(r, _HEX, size) for size in (8, 4, 4, 4, 12)),
    "placeholder": lambda r, w: '{} = "{}"'.format(
        r.choice(KEY_NAMES),
        r.choice(["x" * 20, "your_token_here1", "changeme12345678", "0" * 32, "EXAMPLE1" * 3]),
    ),
    "phrase": lambda r, w: f"{r.choice(KEY_NAMES)}: {r.choice(w)}{r.choice(w)}{r.choice(w)}",
    "in_test": lambda r, w: r.choice(list(SECRETS.values()))(r, w),
}


def _path(rng: random.Random, words: list[str], kind: str) -> str:
    """A path to set before a finding, mostly none; that of a test for what is in one."""
    turn = rng.random()
    if kind != "in_test" and turn < 0.6:
        return ""
    telling = TEST_PARTS if kind == "in_test" else LIVE_PARTS if turn < 0.85 else words
    parts = [rng.choice(words) for _ in range(rng.randint(0, 2))] + [rng.choice(telling)]
    parts += [rng.choice(words) for _ in range(rng.randint(0, 1))]
    return rng.choice(["", "/", "https://"]) + "/".join([*parts, rng.choice(words)])


def labelled_findings(
    known: set[str],
    texts: list[str],
    examples: int = EXAMPLES,
    kinds: Collection[str] | None = None,
    seed: int = 8,
) -> list[tuple[float, list[float], str]]:
    """Label, features and kind of made findings: secrets as services issue them, and what is taken
    for one. `kinds` says which to make; by default all."""
    rng = random.Random(seed)
    words = sorted(known) or ["word"]
    around = [text.split() for text in texts if text.split()] or [words]

    def some(low: int, high: int) -> str:
        own = rng.choice(around)
        start = rng.randrange(len(own))
        return " ".join(own[start : start + rng.randint(low, high)])

    out = []
    for label, makers in ((1.0, SECRETS), (0.0, HARMLESS)):
        chosen = [kind for kind in makers if kinds is None or kind in kinds]
        for turn in range(examples if chosen else 0):
            kind = chosen[turn % len(chosen)]
            path = _path(rng, words, kind)
            # A path stands in the text, or it is the document's source.
            source, path = (path, "") if rng.random() < 0.3 else (None, path)
            start = f"{some(0, 30)} {path}"
            text = f"{start} {makers[kind](rng, words)}"
            area = (len(start), len(text))
            text = f"{text} {some(0, 30)}"
            others = rng.choice([1, 1, 2, 5])
            # Sources full of candidates are mostly lists of digests and numbers.
            rate = rng.uniform(0, 2) if label or rng.random() < 0.7 else rng.uniform(2, 6)
            for begin, end, found in candidates(text):
                if area[0] <= begin and end <= area[1]:
                    told = describe(text, begin, end, found, others, known, source)
                    out.append((label, [*told, rate], kind))
    return out


def fit(
    spark: SparkSession, rows: list[tuple[float, list[float], str]]
) -> RandomForestClassificationModel:
    """The forest trained on labelled findings."""
    frame = spark.createDataFrame(
        [(label, told) for label, told, _ in rows], "label double, features array<double>"
    ).coalesce(1)
    forest = RandomForestClassifier(numTrees=TREES, maxDepth=DEPTH, seed=8)
    return forest.fit(frame.withColumn("features", array_to_vector("features")))


def scanned(docs: DataFrame, limit: float = LIMIT) -> DataFrame:
    """Every candidate with its probability, and whether it is a secret."""
    known = dictionary(docs)
    model = fit(docs.sparkSession, labelled_findings(known, sampled_texts(docs)))
    rows = with_rates(stored(findings(docs, known)), docs)
    rows = rows.withColumn("features", array_to_vector("features"))
    probability = F.round(vector_to_array("probability")[1], 6)
    return (
        model.transform(rows)
        .withColumn("score", probability)
        .select(
            "doc_id",
            "start",
            "length",
            "kind",
            "digest",
            F.col("score").alias("probability"),
            (F.col("score") >= limit).alias("secret"),
        )
    )


def masked(docs: DataFrame, limit: float = LIMIT, mark: str = "[secret]") -> DataFrame:
    """The documents with every secret replaced by the mark; all columns and rows stay."""
    places = (
        scanned(docs, limit)
        .where("secret")
        .groupBy("doc_id")
        .agg(F.sort_array(F.collect_set(F.struct("start", "length"))).alias("places"))
    )
    rows = docs.select(F.struct(*docs.columns).alias("row"))
    joined = rows.join(places, F.col("row.doc_id").eqNullSafe(places["doc_id"]), "left")
    body = F.col("row.text")
    begin = F.struct(F.lit("").alias("done"), F.lit(0).alias("at"))

    def step(so_far: Column, place: Column) -> Column:
        between = F.substring(body, so_far["at"] + 1, place["start"] - so_far["at"])
        return F.struct(
            F.concat(so_far["done"], between, F.lit(mark)).alias("done"),
            (place["start"] + place["length"]).alias("at"),
        )

    walked = F.aggregate("places", begin, step)
    whole = F.concat(
        walked["done"], F.substring(body, walked["at"] + 1, F.length(body))
    )
    text = F.when(F.col("places").isNull(), body).otherwise(whole)
    return joined.select(
        *[text.alias(c) if c == "text" else F.col(f"row.`{c}`") for c in docs.columns]
    )
