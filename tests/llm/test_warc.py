import gzip

import pytest

from courtside.llm import warc

PAGES = "page_id long, url string, html string, payload string, record_type string"


LOOKALIKE = "WARC/1.1\r\nWARC-Type: response\r\n\r\n" + "y" * 200


def pages(spark):
    big = "<p>" + "äß" * 400 + "</p>"
    rows = [(5, "http://a/1", big), (3, "http://a/2", big), (9, None, big), (9, "http://x", big), (4, "http://a/3", None),
            (7, "http://a/4", ""), (8, "u", "short"), (10, "u", "short"), (11, "u\r\nX-Evil: 1", "x" * 500000),
            (None, "u", big), (12, "u", LOOKALIKE), (3, "http://a/2", big)]
    return spark.createDataFrame([(*r, "p", "q") for r in rows], PAGES)


def test_round_trip(spark):
    out = {(r["page_id"], r["payload_bytes"], r["record_type"], r["refers_to"]) for r in warc.roundtrip(pages(spark)).collect()}
    big = 7 + 4 * 400
    assert out == {(5, big, "revisit", 3), (3, big, "response", None), (9, big, "revisit", 3), (None, big, "revisit", 3),
                   (4, 0, "response", None), (7, 0, "response", None), (8, 5, "response", None), (10, 5, "response", None),
                   (11, 500000, "response", None), (12, len(LOOKALIKE), "response", None)}
    assert warc.roundtrip(pages(spark)).count() == 12
    assert warc.roundtrip(pages(spark).limit(0)).count() == 0


@pytest.mark.parametrize("compression", ["none", "gzip"])
def test_filters_and_columns_are_pushed(spark, tmp_path, compression):
    path = f"file://{tmp_path}/w"
    warc.register(spark)
    warc.records(pages(spark)).write.format("warc").option("compression", compression).option("maxFileBytes", "2000") \
        .mode("append").save(path)
    found = warc.read_archive(spark, path, ["page_id", "record_type"]).filter("record_type = 'response' AND page_id IN (3, 5, 8)")
    assert "Filter" not in found._jdf.queryExecution().executedPlan().toString().replace("RuntimeFilters", "")
    assert sorted(r["page_id"] for r in found.collect()) == [3, 3, 8]
    whole = warc.read_archive(spark, path).filter("page_id = 12").collect()[0]
    assert bytes(whole["payload"]).endswith(b"y" * 200) and whole["target_uri"] == "u"


def test_unwanted_blocks_are_not_read(spark, tmp_path):
    (tmp_path / "a.warc").write_bytes(
        b"WARC/1.1\r\nWARC-Type: response\r\nWARC-Record-ID: <a>\r\nContent-Type: application/http\r\nContent-Length: 60\r\n\r\n"
        b"HTTP/1.1 200 OK\r\nContent-Encoding: gzip\r\n\r\nnot gzip at all!!" + b"\r\n\r\n"
        b"WARC/1.1\r\nWARC-Type: metadata\r\nWARC-Record-ID: <b>\r\nContent-Length: 2\r\n\r\nok\r\n\r\n")
    (tmp_path / "b.warc.gz").write_bytes(gzip.compress(
        b"WARC/1.1\r\nWARC-Type: warcinfo\r\nWARC-Record-ID: <c>\r\nContent-Length: 1\r\n\r\nz\r\n\r\n"))
    data = warc.read_archive(spark, f"file://{tmp_path}").filter("record_type <> 'x'").filter("record_id IN ('<b>', '<c>')")
    assert sorted(bytes(r["payload"]) for r in data.collect()) == [b"ok", b"z"]
    assert warc.read_archive(spark, f"file://{tmp_path}", ["record_id"]).count() == 3
    with pytest.raises(Exception, match="incorrect header|decompress"):
        warc.read_archive(spark, f"file://{tmp_path}").collect()


def test_broken_files_raise(spark, tmp_path):
    (tmp_path / "a.warc").write_bytes(b"WARC/1.1\r\nWARC-Type: response\r\nContent-Length: 90\r\n\r\nshort")
    with pytest.raises(Exception, match="ends early"):
        warc.read_archive(spark, f"file://{tmp_path}").collect()
