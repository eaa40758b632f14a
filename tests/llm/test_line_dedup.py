import random
import re

from pyspark.sql import functions as F

from .helpers import SMALL, rows_of

from tallyhouse.llm import line_dedup
from tallyhouse.llm.grouping import classes
from tallyhouse.llm.shared import table


def distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        last, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            last, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, last + (x != y))
    return row[-1]


def test_exact_and_fuzzy_lines(make_docs):
    rng = random.Random(11)
    letters = "abcdefghijk"
    words = ["".join(rng.choice(letters) for _ in range(rng.randint(2, 9))) for _ in range(900)]
    lines = [" ".join(rng.choice(words) for _ in range(40)) for _ in range(30)]
    close = [line.replace(line.split()[5], "zz", 1) for line in lines]
    docs = make_docs(
        [
            (1, "\n".join(lines), "en", "a"),
            (2, f"\n!!\n{lines[0].upper()}!\na line of its own\n{close[1]}", "en", "a"),
            (3, "\n".join(close) + "\n\n...", "en", "a"),
            (4, "a line of its own\nanother line", "en", "a"),
        ]
    )
    found = {r["doc_id"]: r for r in line_dedup.line_report(docs).collect()}
    assert found[1]["n_dropped"] == 0 and found[1]["n_lines"] == 30
    assert 2 in found[2]["dropped_lines"]
    assert found[4]["dropped_lines"] == [0]
    assert not {0, 1, 3} & set(found[2]["dropped_lines"])
    # Pairs that share no block of the SimHash are not found; most of these do.
    assert found[3]["n_dropped"] >= 12
    rest = line_dedup.without_duplicate_lines(docs).collect()
    left = {r["doc_id"]: r["text"].split("\n") for r in rest}
    assert left[4] == ["another line"] and left[1] == lines
    assert left[2][:2] == ["", "!!"] and left[3][-2:] == ["", "..."]


def test_links_are_those_of_brute_force(spark, make_docs):
    rng = random.Random(12)
    names = "one two three four five six seven".split()
    base = [" ".join(rng.choice(names) for _ in range(12)) for _ in range(40)]
    lines = base + [b[:-1] for b in base] + [b + " one" for b in base]
    docs = make_docs([(i, line, "en", "a") for i, line in enumerate(lines)])
    found = line_dedup.occurrences(docs)
    classes = {r["id"]: r["class_id"] for r in line_dedup.line_classes(found).collect()}
    blocks = {}
    distinct = {r["id"]: r["line"] for r in found.collect()}
    for row in line_dedup.simhashes(found.select("id", "line").distinct()).collect():
        for key in row["blocks"]:
            blocks.setdefault(key, set()).add(row["id"])
    parent = {i: i for i in distinct}

    def top(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for members in blocks.values():
        for a in members:
            for b in members:
                one, two = distinct[a], distinct[b]
                if a < b and distance(one, two) <= int(0.2 * max(len(one), len(two)) + 1e-9):
                    parent[max(top(a), top(b))] = min(top(a), top(b))
    assert len(set(classes.values())) < len(distinct)
    assert {i: classes.get(i, i) for i in distinct} == {i: top(i) for i in distinct}


def test_odd_rows(odd_docs):
    found = {r["doc_id"]: r for r in rows_of(line_dedup.line_report(odd_docs))}
    assert len(found) == 10
    assert [found[i]["n_lines"] for i in (1, 2, 3, 4, 8)] == [0, 0, 0, 1, 1]
    assert found[6]["dropped_lines"] == found[7]["dropped_lines"] == [0, 1]
    assert found[5]["dropped_lines"] == [] and found[None]["n_lines"] == 1
    kept = line_dedup.without_duplicate_lines(odd_docs)
    assert kept.columns == odd_docs.columns and kept.count() == odd_docs.count()
    assert line_dedup.line_report(odd_docs.limit(0)).collect() == []


def test_long_lines(make_docs):
    long = " ".join(f"word{i}" for i in range(30_000))
    rows = [(1, long, "en", "a"), (2, long + " end", "en", "a"), (3, "w " * 40_000, "en", "a"),
            (4, "w " * 38_000, "en", "a")]
    found = {r["doc_id"]: r["n_dropped"] for r in line_dedup.line_report(make_docs(rows)).collect()}
    assert found == {1: 0, 2: 1, 3: 0, 4: 1}


def test_repeated_words_count(make_docs):
    rows = ["no", "no no no no no", "0", "0 0 0 0 0", "el", "el el"]
    docs = make_docs([(i, line, "en", "a") for i, line in enumerate(rows)])
    found = {r["doc_id"]: r["n_dropped"] for r in line_dedup.line_report(docs).collect()}
    assert found == dict.fromkeys(range(6), 0)
    long = make_docs([(1, "no " * 50, "en", "a"), (2, "no " * 45, "en", "a")])
    assert sum(r["n_dropped"] for r in line_dedup.line_report(long).collect()) == 1


def test_recall_of_planted_edits(spark, make_docs):
    """Against the edits themselves, whatever the keys are."""
    rng = random.Random(13)
    texts = [r["text"] for r in table(spark, SMALL, "documents").collect()]
    raw = [line for text in texts if text for line in text.split("\n")]
    clean = sorted({" ".join(re.findall(r"\w+", line.lower())) for line in raw})
    rng.shuffle(clean)

    def word_replaced(line):
        words = line.split()
        at = rng.choice([i for i, word in enumerate(words) if 3 < len(word) < 12])
        return " ".join([*words[:at], "qzqzqz", *words[at + 1 :]])

    def character_replaced(line):
        at = rng.choice([i for i, c in enumerate(line) if c != " "])
        return line[:at] + "q" + line[at + 1 :]

    kinds = {
        "word, 10 to 20 words": (word_replaced, 10, 20, 0.9),
        "word, 40 to 80 words": (word_replaced, 40, 80, 0.95),
        "character, 10 to 20 words": (character_replaced, 10, 20, 0.9),
        "character, 3 to 8 words": (character_replaced, 3, 8, 0.7),
    }
    recall = {}
    for name, (edit, low, high, _) in kinds.items():
        usable = [x for x in clean if low <= len(x.split()) <= high]
        usable = [x for x in usable if re.search(r"\b\w{4,11}\b", x)]
        pairs = [(line, edit(line)) for line in usable[:150]]
        pairs = [(a, b) for a, b in pairs if a != b and distance(a, b) <= 0.2 * max(len(a), len(b))]
        rows = [(2 * i + j, line) for i, pair in enumerate(pairs) for j, line in enumerate(pair)]
        found = line_dedup.simhashes(spark.createDataFrame(rows, "id long, line string")).collect()
        keys = {r["id"]: set(r["blocks"]) for r in found}
        met = sum(bool(keys[2 * i] & keys[2 * i + 1]) for i in range(len(pairs)))
        recall[name] = (met / len(pairs), len(pairs))
    print(recall)
    assert all(recall[name][0] >= least for name, (*_, least) in kinds.items()), recall


def test_crowded_bucket_loses_no_link(make_docs):
    """Lines of the same words share every block of the SimHash, whatever their order."""
    rng = random.Random(14)
    words = [f"word{c}{c}" for c in "abcdefghijkl"]
    lines = []
    for _ in range(30):
        order = rng.sample(words, len(words))
        lines += [" ".join(order), " ".join([*order[:4], order[5], order[4], *order[6:]])]
    docs = make_docs([(i, line, "en", "a") for i, line in enumerate(lines)])
    group = list(range(len(lines)))
    for i, one in enumerate(lines):
        for j, other in enumerate(lines[:i]):
            if distance(one, other) <= int(0.2 * len(one) + 1e-9):
                group = [min(group[i], group[j]) if g in (group[i], group[j]) else g for g in group]
    want = {i: int(group[i] != i) for i in range(len(lines))}
    assert 20 < sum(want.values()) < len(lines) - 2
    found = line_dedup.line_report(docs).collect()
    assert {r["doc_id"]: r["n_dropped"] for r in found} == want


def test_lines_are_normalised_as_one_run_of_others_at_a_time(make_docs):
    rng = random.Random(15)
    texts = ["".join(rng.choice("aB9 é .,_\t\n\r~") for _ in range(60)) for _ in range(200)]
    want = []
    for i, text in enumerate(texts):
        for at, line in enumerate(text.split("\n")):
            words = re.sub(r"[\x00-/:-@\[-`{-\x7f]+", " ", line.lower()).strip(" ")
            want += [(i, at, words)] * bool(words)
    docs = make_docs([(i, text, "en", "a") for i, text in enumerate(texts)])
    found = line_dedup.occurrences(docs).select("doc_id", "line_no", "line").collect()
    assert sorted(map(tuple, found)) == want


def test_pieces_tell_edits_here_and_there_and_never_too_few(spark):
    """Lines with a character replaced in every fifth word or so are told by their pieces; what the
    pieces tell is never less than the distance, whatever the lines."""
    rng = random.Random(16)
    pairs = []
    for i in range(60):
        words = ["".join(rng.choice("abcdé") for _ in range(rng.randint(1, 7))) for _ in range(90)]
        edited = list(words)
        for at in rng.sample(range(90), 12):
            edited[at] = edited[at][:-1] + rng.choice(["q", "", "qq", " qqqq"])
        if i % 3 == 1:
            edited[20:30] = []
        if i % 3 == 2:
            rng.shuffle(edited)
        pairs.append((" ".join(words), " ".join(edited)))
    pairs += [("a" * 300, "a" * 270 + "b"), ("ab " * 100, "ba " * 90), ("a", "b"), ("a" * 200, "b")]
    rows = spark.createDataFrame([(i, *pair) for i, pair in enumerate(pairs)], "i int, a string, b string")
    told = {
        r["i"]: r["told"]
        for r in rows.select(
            "i", line_dedup._pieced(F.col("a"), F.col("b"), F.lit(10**6)).alias("told")
        ).collect()
    }
    assert all(told[i] >= distance(*pair) for i, pair in enumerate(pairs))
    assert all(told[i] <= 0.2 * len(pairs[i][0]) for i in range(0, 60, 3))


def test_words_are_taken_apart_once_for_all_their_keys(spark, make_docs):
    found = line_dedup.occurrences(make_docs([(1, "some words of a line", "en", "a")]))
    plan = line_dedup.simhashes(found.select("id", "line"))._jdf.queryExecution().optimizedPlan()
    # Of words, of runs of characters, and of lines in both.
    assert plan.toString().count("Generate ") == 4


def test_pairs_across_groups_are_compared_once_up_to_the_whole_limit(spark):
    """Both forms tell what the distance tells, and the second pass has its own."""
    rng = random.Random(17)
    lines = [" ".join(rng.choice(["ab", "cdé", "efgh", "a"]) for _ in range(9)) for _ in range(40)]
    pairs = [(i, lines[i % 40], rng.choice(lines)) for i in range(200)]
    pairs += [(200 + i, x, x[:-3] + "zz" * (i % 6)) for i, x in enumerate(lines)]
    rows = spark.createDataFrame(pairs, "i int, a string, b string")
    told = rows.select(
        "i",
        line_dedup.similar("a", "b", 0.8).alias("many"),
        line_dedup.similar("a", "b", 0.8, few=True).alias("few"),
    ).collect()
    want = [distance(a, b) <= int(0.2 * max(len(a), len(b)) + 1e-9) for _, a, b in pairs]
    told = {r["i"]: (r["many"], r["few"]) for r in told}
    assert [told[i] for i in range(len(pairs))] == [(w, w) for w in want] and 10 < sum(want) < 230
    seen = []
    buckets = spark.createDataFrame([(i, 1) for i in range(4)], "id long, key long")

    def noted(name, links):
        def run(pairs):
            seen.append((name, sorted(map(tuple, pairs.collect()))))
            return pairs.where(links)

        return run

    first, rest = noted("first", "b = 1"), noted("rest", "a = 2 and b = 3")
    found = classes(buckets, first, verify_rest=rest).collect()
    assert seen == [("first", [(0, 1), (0, 2), (0, 3)]), ("rest", [(1, 2), (1, 3), (2, 3)])]
    assert sorted(map(tuple, found)) == [(0, 0), (1, 0), (2, 2), (3, 2)]
