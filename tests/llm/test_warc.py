"""Archives written and read back: round trips, revisits, byte ranges."""

import hashlib
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from vicinal.llm.warc import index_archives, ranges_of, read_back, read_records, write_archives

PAGES = "page_id bigint, url string, html string, digest string, key int, value string"


def page(page_id, url, html):
    return (page_id, url, html, "clash", 1, "clash")


def pages_of(spark, rows):
    return spark.createDataFrame(rows, PAGES).repartition(3)


LONG, OTHER = "é" * 500, "<p>\r\n\r\nWARC/1.1\r\nContent-Length: 3\r\n\r\n</p>" * 60
ROWS = [
    page(1, "https://a.b/?q=%20x y", LONG), page(2, "https://a.b/2", LONG), page(9, None, LONG), page(None, "u", LONG), page(3, "u\r\nX: y", OTHER),
    page(4, "u", "short"), page(5, "u", "short"), page(6, "u", None), page(7, "u", ""), page(None, None, None), page(8, "é日", "z" * 999), page(10, "u", "z" * 999),
    page(11, "u", "q" * 3_000_000), page(12, "u", "q" * 3_000_000), page(12, "u", "q" * 3_000_000), page(None, "n", "only null" * 200), page(None, "n", "only null" * 200),
]


def expected(rows):
    groups = {}
    for page_id, _, html, *_ in rows:
        groups.setdefault(html or "", []).append(page_id)
    out = []
    for page_id, _, html, *_ in rows:
        payload, first = (html or "").encode(), None
        same = [i for i in groups[html or ""] if i is not None]
        if len(payload) >= 1000 and len(groups[html or ""]) > 1 and same and page_id != max(same):
            first = max(same)
        out.append((page_id, len(payload), hashlib.sha1(payload).hexdigest(), "response" if first is None else "revisit", first))
    return sorted(out, key=repr)


def test_round_trip(spark):
    path = write_archives(pages_of(spark, ROWS), "page_id", "url", "html", records=4)
    got = [tuple(r) for r in read_back(spark, path, "bigint").select("key", "payload_bytes", "payload_digest", "record_type", "refers_to").collect()]
    assert sorted(got, key=repr) == expected(ROWS)
    payloads = {r["key"]: bytes(r["payload"]).decode() for r in read_records(index_archives(spark, path)).collect() if r["payload"] is not None}
    assert payloads["3"] == OTHER and payloads["9"] == LONG and payloads["6"] == ""
    urls = {r["key"]: r["url"] for r in index_archives(spark, path).collect()}
    assert urls["1"] == "https://a.b/?q=%20x y" and urls["3"] == "u%0D%0AX: y" and urls["8"] == "é日" and urls["9"] is None


def test_files_are_sequences_of_records(spark):
    """Every file parses by its lengths alone, and the index points at each record."""
    path = write_archives(pages_of(spark, ROWS), "page_id", "url", "html")
    index = {(r["archive"].split("/")[-1], r["offset"]): r["length"] for r in index_archives(spark, path).collect()}
    seen = {}
    for file in Path(path.removeprefix("file:")).glob("part-*"):
        data, at = file.read_bytes(), 0
        while at < len(data):
            head = data[at : data.index(b"\r\n\r\n", at)].decode().split("\r\n")
            assert head[0] == "WARC/1.1" and sum(h.startswith("WARC-Record-ID: <urn:uuid:") for h in head) == 1
            size = len("\r\n".join(head).encode()) + 4 + int(next(h for h in head if h.startswith("Content-Length: ")).split()[1])
            assert data[at + size : at + size + 4] == b"\r\n\r\n"
            seen[file.name, at] = size + 4
            at += size + 4
    assert seen == index and len(seen) == len(ROWS)


def test_selected_records_alone_are_read(spark):
    path = write_archives(pages_of(spark, ROWS), "page_id", "url", "html")
    index = index_archives(spark, path)
    some = index.filter("key IN ('4', '11')")
    for gap, most in ((0, 100), (1 << 30, 1 << 30)):
        rows = read_records(some.unionByName(some), gap, most).collect()
        assert sorted(r["key"] for r in rows) == ["11", "4"]
    assert read_records(index.filter(F.lit(False))).collect() == []


def test_empty_table(spark):
    assert read_back(spark, write_archives(pages_of(spark, []), "page_id", "url", "html"), "bigint").collect() == []


@pytest.mark.parametrize("gap,most,want", [(0, 100, [[(0, 5), (5, 5)], [(20, 5)]]), (10, 100, [[(0, 5), (5, 5), (20, 5)]]), (10, 10, [[(0, 5), (5, 5)], [(20, 5)]])])
def test_ranges(gap, most, want):
    assert list(ranges_of([(20, 5), (0, 5), (5, 5)], gap, most)) == want
