import base64
import glob
import hashlib

import pytest
import zstandard

from labflow.llm import queries_warc, warc

PAGES = [
    (5, "http://a/5", "<html>same</html>"),
    (3, "http://a/3", "<html>same</html>"),
    (9, None, "<html>same</html>"),
    (1, "http://a/1\nX-Bad: %41", None),
    (2, "http://a/2", ""),
    (-7, "http://é/", "é" * 300_000),
    (2**62 + 11, "u", "\r\n\r\nWARC/1.1\r\n"),
    (None, "none", "no id"),
    (8, "twice", "twice"),
    (8, "twice", "twice"),
]
SCHEMA = "page_id long, url string, html string"


@pytest.fixture(scope="module")
def pages(spark):
    many = [(1000 + i, f"http://site/{i}", f"<html><body>{'page text ' * 20}{i}</body></html>") for i in range(400)]
    frame = spark.createDataFrame(PAGES + many, SCHEMA)
    return frame.selectExpr("*", "'clash' as SHA1", "1 as archive").repartition(3)


def test_round_trip(spark, pages):
    got = warc.round_trip(pages).collect()
    assert len(got) == len(PAGES) + 400
    by_id = {r.page_id: r for r in got}
    for page_id, url, html in PAGES:
        r, payload = by_id[page_id], (html or "").encode()
        assert r.payload_bytes == len(payload)
        assert r.payload_digest == base64.b32encode(hashlib.sha1(payload).digest()).decode()
        assert r.url == url
        assert r.payload is None or bytes(r.payload) == payload
    kinds = {i: (by_id[i].record_type, by_id[i].refers_to) for i in (1, 2, 3, 5, 9, None)}
    assert kinds[3] == ("response", None) and kinds[5] == kinds[9] == ("revisit", 3)
    assert kinds[1] == ("response", None) and kinds[2] == ("revisit", 1) and kinds[None] == ("response", None)
    assert sorted((r.record_type, r.refers_to) for r in got if r.page_id == 8) == [("response", None)] * 2


def test_files_are_frames_with_a_leading_dictionary(spark, pages, tmp_path):
    dictionary = warc.train_dictionary(pages)
    assert dictionary and dictionary == warc.train_dictionary(pages)
    warc.write_archives(warc.with_originals(pages), f"{tmp_path}/a", dictionary, archive_bytes=2000)
    files = glob.glob(f"{tmp_path}/a/part-*")
    assert len(files) > 3
    for name in files:
        with open(name, "rb") as f:
            data = f.read()
        assert data[:4] == bytes.fromhex("5d2a4d18")
        assert data[8 : 8 + int.from_bytes(data[4:8], "little")] == dictionary
        reader = zstandard.ZstdDecompressor(dict_data=zstandard.ZstdCompressionDict(dictionary))
        whole = reader.stream_reader(data, read_across_frames=True).read()
        assert whole == b"".join(warc.frames(data)) and whole.startswith(b"WARC/1.1\r\nWARC-Type: warcinfo")
    assert warc.read_archives(spark, f"{tmp_path}/a").count() == pages.count()


def test_damage_is_found(spark, pages, tmp_path):
    warc.write_archives(warc.with_originals(pages), f"{tmp_path}/a", b"")
    name = glob.glob(f"{tmp_path}/a/part-*")[0]
    with open(name, "rb") as f:
        data = f.read()
    with pytest.raises(Exception):
        list(warc.frames(data[: len(data) // 2]))
    with pytest.raises(ValueError):
        list(warc.frames(data[8:]))
    with pytest.raises(ValueError):
        warc.parse(b"WARC/1.1\r\nContent-Length: 3\r\n\r\nab\r\n\r\n")


def test_record_ids_carry_page_ids():
    ids = [0, 1, -1, 2**63 - 1, -(2**63), 2**62, None]
    assert [warc.page_of(f"<urn:uuid:{warc.record_id(i)}>") for i in ids] == ids


def test_smallest_payload_for_revisits(pages):
    found = {(r.page_id, r.is_original) for r in warc.with_originals(pages, smallest=1).collect()}
    assert (1, True) in found and (2, True) in found and (5, False) in found


def test_empty_table(spark, pages, tmp_path):
    assert warc.round_trip(pages.limit(0)).count() == 0
    pages.write.parquet(f"{tmp_path}/pages.parquet")
    assert queries_warc.op10_dictionary_archives(spark, str(tmp_path)).count() == pages.count()
