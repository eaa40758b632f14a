from .helpers import rows_of

from tallyhouse.llm import language
from tallyhouse.llm.shared import table

MIDDLE = "/root/testdata/sf0.01"


def test_accuracy(spark):
    """Texts alone, mostly not trained on, against the documents' labels."""
    docs = table(spark, MIDDLE, "documents")
    model = language.fit(docs, sample=40)
    bare = docs.selectExpr("doc_id", "text", "cast(null as string) AS lang", "source")
    found = {r["doc_id"]: r for r in language.identified(bare, None, model).collect()}
    truth = {r["doc_id"]: r["lang"] for r in docs.select("doc_id", "lang").collect()}
    assert found.keys() == truth.keys()
    assert sum(found[i]["language"] == truth[i] for i in truth) > 0.97 * len(truth)


def test_evidence_is_fused(spark):
    docs = table(spark, MIDDLE, "documents")
    model = language.fit(docs)
    texts = {r["lang"]: r["text"] for r in docs.where("n_chars > 900").collect()}
    german = f'<html lang="de"><p>{texts["de"]}</p>'
    rows = [(i, f"http://a.example.de/{i}", german) for i in range(20)]
    rows += [
        (100, "http://a.example.de/x", "<p>12 34</p>"),
        (101, "http://b.example.de/x", "<p></p>"),
        (102, "http://other.com/", '<html lang="fr-CA"><p>77</p>'),
        (103, "http://a.example.de/y", f'<html lang="de"><p>{texts["fr"]}</p>'),
        (104, "http://c.com/", f'<html lang="fr"><p>{texts["fr"]}</p>'),
    ]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string")
    found = {r["page_id"]: r for r in language.identified(None, pages, model).collect()}
    assert found[100]["language"] == "de" and found[101]["language"] == "de"
    assert found[102]["language"] == "fr" and found[102]["declared"] == "fr"
    assert found[103]["language"] == "fr"
    assert found[100]["probability"] > found[101]["probability"]


def test_odd_rows(spark, odd_docs):
    pages = spark.createDataFrame(
        [
            (1, None, None), (2, "", ""), (None, "no url", "<html lang=xx>"),
            (3, "http://h/", "x" * 300_000),
        ],
        "page_id long, url string, html string",
    )
    model = language.fit(odd_docs)
    found = rows_of(language.identified(odd_docs, pages, model))
    assert len(found) == odd_docs.count() + 4
    assert {r["declared"] for r in found} == {None, "en", "de", "other"}
    none = language.fit(odd_docs.limit(0))
    assert all(r["language"] is None for r in language.identified(odd_docs, pages, none).collect())
    assert language.identified(odd_docs.limit(0), pages.limit(0), model).collect() == []


def test_more_languages_than_fifty(make_docs):
    names = [a + b for a in "abcdef" for b in "klmnopqrst"]
    rows = [(i, f"{name * 3} {name[::-1] * 4} " * 20, name, "s") for i, name in enumerate(names)]
    docs = make_docs(rows * 2 + rows[:50])
    model = language.fit(docs)
    assert model.languages == sorted(names)
    found = language.identified(docs, None, model).collect()
    assert all(r["language"] == names[r["doc_id"]] == r["declared"] for r in found)


def test_late_declaration():
    late = "<!-- " + "x" * 100_000 + " --><HTML class=a><html dir=ltr LANG='pt-BR'><p>"
    assert language.declared(late) == "pt"
    assert language.declared("<html " * 50_000) is None
    assert language.declared("<html><p lang=en>") is None
