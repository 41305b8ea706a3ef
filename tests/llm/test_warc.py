"""Archives: exact round trip, deduplication, commit and determinism."""

from __future__ import annotations

import gzip
import hashlib

from clickflow.llm import warc

PAGES = "page_id long, url string, html string, digest string, shard string"
LONG = "<html>" + "x" * 200


def pages_of(spark, *rows):
    return spark.createDataFrame([(*r, "clash", "clash") for r in rows], PAGES).repartition(4)


def test_round_trip(spark, tmp_path):
    rows = [
        (9, "http://a/9", LONG), (4, "http://a/4", LONG), (7, None, LONG), (1, "http://a b\n/é", None),
        (2, "", ""), (3, "http://a/3", "short"), (5, "http://a/5", "short"), (None, "http://n", LONG),
        (None, None, None), (4, "http://a/4", LONG), (11, "u", "日本" * 60_000), (12, "u", "a\r\n\r\nb" * 50),
    ]
    path = str(tmp_path / "w")
    warc.write_warc(pages_of(spark, *rows), path, shards=3, roll_bytes=500)
    got = warc.read_warc(spark, path, payloads=True).collect()
    assert len(got) == len(rows)
    found = sorted(
        (r["page_id"] or -1, r["payload_bytes"], r["payload_digest"], r["record_type"], r["refers_to"]) for r in got
    )
    expected = []
    for page_id, _, html in rows:
        data = (html or "").encode()
        revisit = page_id is not None and html == LONG and page_id != 4
        expected.append(
            (page_id or -1, len(data), hashlib.sha256(data).hexdigest(),
             "revisit" if revisit else "response", 4 if revisit else None)
        )
    assert found == sorted(expected)
    for r in got:
        if r["record_type"] == "response":
            assert hashlib.sha256(bytes(r["payload"])).hexdigest() == r["payload_digest"]
    archives = warc.manifest(spark, path).collect()
    assert {a["name"] for a in archives} == {p.name for p in (tmp_path / "w").glob("*.warc.gz")}
    assert len(archives) > 3 and not (tmp_path / "w" / "_temporary").exists()
    for a in archives:
        data = (tmp_path / "w" / a["name"]).read_bytes()
        assert hashlib.sha256(data).hexdigest() == a["sha256"] and len(data) == a["bytes"]
        assert gzip.decompress(data).startswith(b"WARC/1.1\r\nWARC-Type: ")


def test_same_pages_same_bytes(spark, tmp_path):
    rows = [(i, f"http://x/{i}", f"{LONG}{i % 50}") for i in range(400)]
    sums = []
    for n, parts in (("a", 2), ("b", 7)):
        path = str(tmp_path / n)
        warc.write_warc(pages_of(spark, *rows).repartition(parts, "html"), path, shards=4, roll_bytes=4000)
        sums.append(sorted((a["name"], a["sha256"]) for a in warc.manifest(spark, path).collect()))
    assert sums[0] == sums[1] and len(sums[0]) > 4


def test_commit_again_changes_nothing_and_strays_are_ignored(spark, tmp_path):
    path = str(tmp_path / "w")
    warc.write_warc(pages_of(spark, (1, "u", LONG), (2, "u", LONG)), path, shards=2)
    (tmp_path / "w" / "_temporary").mkdir()
    (tmp_path / "w" / "_temporary" / "records-000000-000000.warc.gz.99").write_bytes(b"left by a lost task")
    warc._commit(spark, path)
    assert warc.read_warc(spark, path).count() == 2


def test_empty_table(spark, tmp_path):
    path = str(tmp_path / "w")
    warc.write_warc(pages_of(spark, (1, "u", "x")).limit(0), path)
    assert warc.read_warc(spark, path).collect() == []
