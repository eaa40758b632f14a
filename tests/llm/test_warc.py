import hashlib

import pytest
from .helpers import rows_of
from pyspark.sql import functions as F

from tallyhouse.llm import warc
from tallyhouse.llm.queries import ORACLE_SQL


@pytest.fixture(scope="module")
def pages(spark):
    body = "<html>" + "text é \r\n\r\n WARC/1.1\r\n " * 20 + "</html>"
    rows = [(i, f"http://WWW.site{i % 7}.example.com:80{i % 3}/p/{i}?q=1#top", f"<p>{i}</p>" * 40)
            for i in range(60)]
    rows += [(100 + i, f"https://copy.org/{i}", body) for i in range(30)]
    rows += [(200, None, None), (201, "", ""), (202, "a b\r\nc", "short"), (203, "x", "short"),
             (204, "y", body), (204, "y", body), (None, "n", body), (90, "late.org", body),
             (205, "long.org/", "very long " * 200_000)]
    return spark.createDataFrame(rows, "page_id long, url string, html string").repartition(5)


def test_same_as_sql(pages, sql):
    ours = rows_of(warc.archived(pages))
    theirs = sql(ORACLE_SQL["op7_warc"], pages=pages)
    names = sorted(ours[0])
    assert sorted(str([r[n] for n in names]) for r in ours) == sorted(
        str([r[n] for n in names]) for r in theirs
    )
    assert sum(r["record_type"] == "revisit" for r in ours) == 33


def test_every_capture_is_found_and_read_by_its_range(pages, monkeypatch):
    monkeypatch.setattr(warc, "PART_RECORDS", 30)
    monkeypatch.setattr(warc, "FILE_RECORDS", 4)
    found = warc.read_archives(pages, warc.write_archives(pages)).cache()
    index = warc.CaptureIndex(found, block_lines=7)
    assert index.blocks.select("part").distinct().count() > 1
    keys = found.select("key").distinct()
    missing = keys.select(F.concat("key", F.lit("0")).alias("key")).limit(3)
    places = index.locate(keys.union(missing).distinct())
    wanted = {r["key"] for r in keys.collect()}
    assert {r["key"] for r in places.collect()} == wanted
    read = {r["key"]: bytes(r["payload"]) for r in warc.payloads(places).collect()}
    for row in found.where("record_type = 'response'").collect():
        assert hashlib.sha256(read[row["key"]]).hexdigest() == row["payload_digest"]


def test_keys_put_the_host_first():
    key = warc.url_key("https://user@Blog.Example.com:8080/a/b?c=d#e")
    assert key == "com,example,blog:8080)/a/b?c=d"
    assert warc.url_key("example.org") == "org,example)/"


def test_damage_is_found(pages, spark):
    folder = warc.write_archives(pages)
    files = spark.read.format("binaryFile").load(folder)
    broken = files.withColumn(
        "content", F.unhex(F.regexp_replace(F.hex("content"), "3C703E313C", "3C703E323C"))
    )
    with pytest.raises(Exception, match="damaged record"):
        warc.captures(broken).collect()


def test_empty_table(pages):
    assert warc.archived(pages.limit(0)).collect() == []
