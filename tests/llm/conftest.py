import duckdb
import pytest

LONG = " ".join(f"word{i % 997}x{i // 997}" for i in range(60_000))
# Names that operators use themselves, as columns that must come through.
EXTRA = "id key a b n size start target kept class_id words line value share lines row".split()


@pytest.fixture(scope="session")
def make_docs(spark):
    """Rows (doc_id, text, lang, source) as a table of documents."""

    def make(rows, extra=False):
        schema = "doc_id long, text string, lang string, source string, n_chars long"
        full = [(*row, len(row[1] or "")) for row in rows]
        if extra:
            schema += "".join(f", {name} string" for name in EXTRA)
            full = [(*row, *(f"{name}!" for name in EXTRA)) for row in full]
        return spark.createDataFrame(full, schema)

    return make


@pytest.fixture(scope="session")
def odd_docs(make_docs):
    """Nulls in every column, empty, blank and very long texts, ties and repeated rows."""
    text = "The quick brown fox jumps over the lazy dog and runs away\nacross the wide field"
    return make_docs(
        [
            (1, None, None, None),
            (2, "", "en", "a"),
            (3, " \n\t ... !!", "en", "b"),
            (4, LONG, "en", "b"),
            (5, text, "en", "c"),
            (5, text, "en", "c"),
            (6, text.upper(), "en", None),
            (7, text, None, "c"),
            (None, "a text that nobody numbered and that stands alone here", "en", "c"),
            (8, "x", "en", "d"),
            (9, "Ärger \U0001f600 " * 3, "de", "d"),
        ],
        extra=True,
    )


@pytest.fixture(scope="session")
def sql():
    """Run SQL over views of Spark frames."""

    def run(statement, **frames):
        connection = duckdb.connect()
        for name, frame in frames.items():
            arrow = frame.toArrow()
            connection.register(name, arrow)
        found = connection.execute(statement)
        names = [d[0] for d in found.description]
        return sorted((dict(zip(names, row, strict=True)) for row in found.fetchall()), key=str)

    return run
