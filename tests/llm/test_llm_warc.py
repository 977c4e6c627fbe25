import gzip
import hashlib
import os

import pytest
from pyspark.sql import functions as F

from ctrprep.llm import warc


@pytest.fixture(scope="module")
def pages(spark):
    same = "<p>" + "x" * 200
    rows = [(5, "http://a/é b", same), (3, "http://b", same), (9, None, same), (4, "http://c", "short"), (6, "http://d", "short"), (7, "u", None), (8, "", "")]
    rows += [(None, "http://n", same), (3, "http://b", same), (20, "http://l", "y" * 3_000_000)]
    rows += [(100 + k, f"http://e/{k}", f"<html>{k} {'z' * (k * 37 % 900)}</html>") for k in range(300)]
    return spark.createDataFrame(rows, "page_id long, url string, html string")


def archive(pages, folder, **sizes):
    warc.write_archive(pages, str(folder), **sizes)
    return warc.read_archive(pages.sparkSession, str(folder), payload=True)


def test_round_trip(pages, tmp_path):
    got = archive(pages, tmp_path / "a", shard_bytes=60_000, file_bytes=2_000).collect()
    rows = [r for r in pages.collect()]
    assert len(got) == len(rows)
    first = {}
    for r in rows:
        if r.page_id is not None and len(r.html or "") >= 100:
            first[r.html] = min(first.get(r.html, r.page_id), r.page_id)

    def expected(r):
        body = (r.html or "").encode()
        low = first.get(r.html)
        revisit = low is not None and r.page_id is not None and low < r.page_id
        return (r.page_id, len(body), hashlib.sha256(body).hexdigest(), "revisit" if revisit else "response", low if revisit else None)

    assert sorted((tuple(g)[:5] for g in got), key=str) == sorted(map(expected, rows), key=str)
    assert {g.page_id: bytes(g.payload) for g in got if g.stored}[20] == b"y" * 3_000_000
    assert {g.page_id: g.url for g in got}[5] == "http://a/%C3%A9%20b"


def files(folder):
    return {n: open(os.path.join(folder, n), "rb").read() for n in sorted(os.listdir(folder)) if n.endswith(".warc.gz")}


def test_files_do_not_depend_on_partitions(pages, tmp_path):
    sizes = {"shard_bytes": 60_000, "file_bytes": 2_000}
    warc.write_archive(pages.repartition(1), str(tmp_path / "a"), **sizes)
    warc.write_archive(pages.repartition(7, "url"), str(tmp_path / "b"), **sizes)
    one, other = files(tmp_path / "a"), files(tmp_path / "b")
    assert len(one) > 3
    assert one == other
    assert not [n for n in os.listdir(tmp_path / "a") if n.startswith(".part")]
    for data in one.values():
        assert gzip.decompress(data).startswith(b"WARC/1.1\r\nWARC-Type: warcinfo")


def test_manifest_lists_files_and_changes_are_noticed(pages, tmp_path, spark):
    manifest = warc.write_archive(pages, str(tmp_path / "a"), file_bytes=2_000).collect()
    found = files(tmp_path / "a")
    assert {r.file: r.sha256 for r in manifest} == {n: hashlib.sha256(d).hexdigest() for n, d in found.items()}
    name = manifest[0].file
    with open(tmp_path / "a" / name, "ab") as f:
        f.write(gzip.compress(b"WARC/1.1\r\nWARC-Type: warcinfo\r\nContent-Length: 0\r\n\r\n\r\n\r\n"))
    with pytest.raises(Exception, match="differs from its manifest"):
        warc.read_archive(spark, str(tmp_path / "a")).collect()


def test_an_archive_is_not_overwritten(pages, tmp_path):
    warc.write_archive(pages, str(tmp_path / "a"))
    with pytest.raises(Exception, match="(?i)exist"):
        warc.write_archive(pages, str(tmp_path / "a"))


def test_no_pages(pages, tmp_path):
    assert archive(pages.where(F.lit(False)), tmp_path / "a").collect() == []


@pytest.mark.parametrize("ids", ["far", "one", "null", "equal"])
def test_shards_are_even(spark, tmp_path, ids):
    """A far id, one id for all, no ids at all, and equal rows: shards hold about the same bytes, and no task has more than one."""
    k = F.col("id")
    page = {"far": F.when(k == 7, F.lit(10**12)).otherwise(k), "one": F.lit(5), "null": F.lit(None), "equal": F.lit(5)}[ids].cast("long")
    url = F.lit("http://same") if ids == "equal" else F.concat(F.lit("http://e/"), k)
    html = F.repeat(F.lit("q"), 900) if ids == "equal" else F.concat(k.cast("string"), F.repeat(F.lit("q"), (k % 50 * 30).cast("int")))
    pages = spark.range(0, 4000, 1, 4).select(page.alias("page_id"), url.alias("url"), html.alias("html"))
    manifest = warc.write_archive(pages, str(tmp_path / "a"), shard_bytes=200_000).collect()
    records = {}
    for r in manifest:
        records[r.shard] = records.get(r.shard, 0) + r.records - 1
    got = warc.read_archive(spark, str(tmp_path / "a")).collect()
    assert sum(records.values()) == len(got) == 4000
    assert len(records) >= 10 and sorted(records) == list(range(len(records)))
    assert max(records.values()) <= 2 * 4000 / len(records)
    if ids == "one":
        assert {r.record_type for r in got} == {"response"}


def test_notes_reach_every_shard_of_a_page(spark, tmp_path):
    """Many addresses of one page that revisits another stand in several shards; each of them says so."""
    body = "<p>" + "v" * 3000
    rows = [(1, "http://first", body)] + [(2, f"http://again/{k}", body) for k in range(200)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string")
    got = archive(pages, tmp_path / "a", shard_bytes=20_000).collect()
    assert sorted((r.page_id, r.record_type, r.refers_to) for r in got) == [(1, "response", None)] + [(2, "revisit", 1)] * 200
