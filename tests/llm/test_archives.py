"""Archives: an exact round trip, single records by the index, files, odd rows."""

import hashlib
import io

import pytest
import zstandard
from pyspark.sql import functions as F

from __spark_entry__ import queries
from lapwise.llm import warc

SCHEMA = "page_id long, url string, html string, payload string, first long, payload_digest string, record_id string"


def page_rows():
    big, other = "<p>" + "copy é " * 40, "<p>" + "other " * 60
    return [
        (7, "http://a/7", big), (3, "http://a/3", big), (9, "http://a/9 \r\nX: 1", big), (None, "http://a/n", big), (3, "http://a/3", big),
        (1, None, "small"), (2, "http://a/2", "small"), (4, "http://a/4", None), (5, "http://a/5", ""), (None, None, None),
        (8, "http://a/8", other), (6, "http://a/6", "x" * 99), (11, "http://a/11", "x" * 99), (12, "", "y" * 100), (10, "", "y" * 100),
        (20, "http://a/20", "long \r\n\r\nWARC/1.1\r\n " * 40000), (None, "u", "z" * 200), (None, "u", "z" * 200),
    ]


@pytest.fixture(scope="module")
def pages(spark):
    return spark.createDataFrame([(*r, "p", 0, "d", "r") for r in page_rows()], SCHEMA).repartition(3)


def by_hand(rows):
    least = {}
    for page, _, html in rows:
        data = (html or "").encode()
        if len(data) >= 100 and page is not None:
            least[data] = min(page, least.get(data, page))
    out = []
    for page, _, html in rows:
        data = (html or "").encode()
        first = least.get(data)
        revisit = first is not None and page != first
        out.append((page, len(data), hashlib.sha256(data).hexdigest(), "revisit" if revisit else "response", first if revisit else None))
    return sorted(out, key=str)


def test_round_trip_and_revisits(pages):
    bundles = warc.write_archives(pages, frame_bytes=700, bundle_bytes=3000)
    found = warc.read_archives(bundles, payloads=True).collect()
    facts = [(r["page_id"], r["payload_bytes"], r["payload_digest"], r["record_type"], r["refers_to"]) for r in found]
    assert sorted(facts, key=str) == by_hand(page_rows())
    assert sorted((r["page_id"], bytes(r["payload"]).decode()) for r in found if r["record_type"] == "response" and r["page_id"]) == sorted(
        (p, h or "") for p, _, h in page_rows() if p in (1, 2, 3, 4, 5, 6, 8, 10, 11, 20))
    assert {r["url"] for r in found if r["page_id"] == 9} == {"http://a/9%20%0D%0AX:%201"} and {r["url"] for r in found if r["page_id"] == 1} == {None}
    assert bundles.count() > 3 and bundles.where("records > 1").count() > 0


def test_records_are_found_by_the_index_alone(spark, pages):
    bundles = warc.write_archives(pages, frame_bytes=700, bundle_bytes=6000)
    whole = {r["record_id"]: r for r in warc.read_archives(bundles, payloads=True).collect()}
    contents = {r["bundle"]: bytes(r["content"]) for r in bundles.collect()}
    for place in warc.index(bundles).collect():
        table = warc.seek_table(contents[place["bundle"]])
        raw = warc.frame(contents[place["bundle"]], table[place["frame"]])
        headers, _, stop = warc.parse(raw, place["offset"])
        assert headers["WARC-Record-ID"] == f"<{place['record_id']}>" and stop == place["offset"] + place["length"]
    asked = sorted(whole)[::3]
    found = warc.fetch(bundles, spark.createDataFrame([(a,) for a in [*asked, asked[0], "urn:uuid:none"]], "record_id string")).collect()
    assert {r["record_id"] for r in found} == set(asked)
    assert all(r["payload"] == whole[r["record_id"]]["payload"] for r in found)
    referred = {headers for headers in (warc.record_id(str(r["refers_to"]), r["payload_digest"]) for r in whole.values() if r["refers_to"] is not None)}
    assert referred <= set(whole)


def test_files_are_read_by_any_zstandard_reader(spark, pages, tmp_path):
    bundles = warc.write_archives(pages, frame_bytes=700, bundle_bytes=6000)
    paths = [r["path"] for r in warc.export(bundles, str(tmp_path / "out")).collect()]
    contents = {f"{r['bundle']}.warc.zst": r for r in bundles.collect()}
    for path in paths:
        with open(path, "rb") as file:
            raw = zstandard.ZstdDecompressor().stream_reader(file, read_across_frames=True).read()
        row, offset, count = contents[path.rsplit("/", 1)[1]], 0, 0
        while offset < len(raw):
            _, _, offset = warc.parse(raw, offset)
            count += 1
        assert (count, len(raw)) == (row["records"], row["raw_bytes"])
    again = warc.read_archives(spark.read.format("binaryFile").load(str(tmp_path / "out" / "*.warc.zst")))
    assert again.count() == len(page_rows())


def test_damage_is_an_error(pages):
    row = warc.write_archives(pages.where("page_id = 20")).first()
    content = bytes(row["content"])
    with pytest.raises(ValueError):
        warc.seek_table(content[:-1])
    headers, block, _ = warc.parse(warc.frame(content, warc.seek_table(content)[0]))
    with pytest.raises(ValueError):
        warc.facts(headers, block.replace(b"long", b"lung", 1))
    assert io.BytesIO(content).read(4) == b"\x28\xb5\x2f\xfd"


def test_empty_tables_and_text_ids(spark, pages):
    assert warc.read_archives(warc.write_archives(pages.limit(0))).count() == 0
    named = pages.where("page_id IN (3, 7)").withColumn("page_id", F.concat(F.lit("p é%"), F.col("page_id").cast("string")))
    found = warc.read_archives(warc.write_archives(named), id_type="string").collect()
    assert sorted((r["page_id"], r["refers_to"]) for r in found if r["refers_to"]) == [("p é%7", "p é%3")]
    assert sum(r["record_type"] == "response" for r in found) == 2


def test_the_query(spark, small):
    found = queries()["op12_archives"](spark, small).collect()
    rows = [tuple(r) for r in spark.read.parquet(f"{small}/pages.parquet").select("page_id", "url", "html").collect()]
    assert sorted((tuple(r) for r in found), key=str) == by_hand(rows)
