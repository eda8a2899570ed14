import hashlib

from stewardry.llm import warc
from stewardry.llm.files import reader
from stewardry.session import scratch_dir

LONG = "é" * 600
PAGES = [
    (1, "http://a/1", LONG), (2, "http://a/2", LONG), (3, None, LONG), (4, "http://a/4", "short"), (5, "http://a/5", "short"),
    (6, "http://a/6", None), (7, "http://a/7\r\nX: y", ""), (8, "http://a/8", "x\r\n\r\nWARC/1.1\r\n" * 90), (9, "http://a/9", "y" * 200_000),
    (None, "http://a/10", LONG), (4, "http://a/4", "short"),
]


def test_round_trip_and_revisits(spark):
    pages = spark.createDataFrame([(*r, "clash") for r in PAGES], "page_id long, url string, html string, digest string")
    got = {r["metadata"]["page_id"]: r for r in warc.archive_pages(pages).collect()}
    assert len(got) == 10
    for i, _, html in PAGES:
        r, payload = got[i], (html or "").encode()
        assert r["response"]["payload_digest"] == hashlib.sha1(payload).hexdigest()
        assert r["request"] is not None and r["concurrent_records"] in (2, 4)
        if i in (1, 2):
            assert (r["response"]["type"], r["refers_to"], r["refers_bytes"]) == ("revisit", 3, 1200)
        else:
            assert (r["response"]["type"], bytes(r["response"]["payload"])) == ("response", payload)


def test_archives_roll_and_are_plain_records(spark):
    pages = spark.createDataFrame(PAGES[:9], "page_id long, url string, html string").repartition(2)
    manifest = warc.write_archives(pages, scratch_dir(spark, "warc"), archive_bytes=300).collect()
    assert len(manifest) > 4 and sum(r["records"] for r in manifest) == 27
    with reader(manifest[0]["path"]) as file:
        fields, block = warc.parse_record(next(warc._members(file)))
    assert fields["warc-type"] in ("response", "revisit") and block.startswith(b"HTTP/1.1 200 OK")


def test_missing_and_repeated_sides(spark):
    rows = [
        ("response", "r1", None, None), ("request", "q2", "r1", None), ("request", "q1", "r1", None), ("metadata", "m1", "r1", None),
        ("revisit", "r2", None, "gone"), ("request", "q9", "none", None), ("response", "r1", None, None),
    ]
    rows = [(t, i, c, f, "u", bytearray(b"x"), 1, "d", None) for t, i, c, f in rows]
    whole = warc.assemble(spark.createDataFrame(rows, warc.RECORDS))
    got = {r["record_id"]: r for r in whole.collect()}
    assert set(got) == {"r1", "r2"}
    assert got["r1"]["request"]["record_id"] == "q1" and got["r1"]["concurrent_records"] == 3
    assert got["r2"]["request"] is None and got["r2"]["refers_bytes"] is None


def test_empty(spark):
    assert warc.archive_pages(spark.createDataFrame([], "page_id long, url string, html string")).collect() == []
