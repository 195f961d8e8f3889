"""WARC: records, loser tree, runs, archives read back, merged history."""

import hashlib
import io
import random

import pytest

from riskframe.llm import warc


def test_loser_tree_merges():
    rng = random.Random(1)
    for k in (0, 1, 2, 3, 5, 8, 13, 64):
        runs = [sorted(rng.randrange(40) for _ in range(rng.randrange(9))) for _ in range(k)]
        assert list(warc.LoserTree([iter(r) for r in runs])) == sorted(sum(runs, []))


def test_record_round_trip():
    payload = "é\r\n\r\nWARC/1.1\r\n".encode() * 3
    digest = hashlib.sha256(payload).hexdigest()
    got = warc.parse(warc.record(5, "http://a/\r\nx: y", 86400, payload, digest, len(payload), None))
    assert got["payload"] == payload and got["size"] == len(payload) and got["WARC-Type"] == "response"
    assert got["WARC-Target-URI"] == "http://a/%0D%0Ax: y" and got["WARC-Date"] == "1970-01-02T00:00:00Z"
    got = warc.parse(warc.record(None, None, 0, b"", digest, 77, 5))
    assert (got["size"], got["WARC-Type"], got["WARC-Refers-To"]) == (77, "revisit", "<urn:page:5>")
    with pytest.raises(ValueError):
        warc.parse(b"HTTP/1.1 200 OK\r\n\r\n")


def test_members_cut_short():
    import gzip

    parts = [gzip.compress(bytes([i]) * 300_000) for i in range(5)]
    got = list(warc.members(io.BytesIO(b"".join(parts))))
    assert [d for *_, d in got] == [bytes([i]) * 300_000 for i in range(5)]
    assert [n for _, n, _ in got] == list(map(len, parts))
    with pytest.raises(ValueError):
        list(warc.members(io.BytesIO(b"".join(parts)[:-4])))


def test_runs_by_range(tmp_path):
    rows = sorted([f"k{i % 700:04d}", "20240101000000", i, "a", 0, 1, "d", "response"] for i in range(3000))
    run = warc.RunWriter(str(tmp_path / "r"))
    for r in rows:
        run.add(r)
    n, keys = run.close()
    assert n == 3000 and 1 <= len(keys) <= 32
    assert list(warc.run_captures(str(tmp_path / "r"))) == rows
    low, high = ["k0100", "", 0], ["k0350", "20240101000000", 1050]
    assert list(warc.run_captures(str(tmp_path / "r"), low, high)) == [r for r in rows if low <= r < high]


@pytest.mark.parametrize("url,key", [(None, ""), ("", ""), ("http://B.a.org/x?y#z", "org,a,b)/x?y"), ("http://a.org", "org,a)/"), ("a/b", "a)/b"), ("h://a?x", "a)?x")])
def test_url_keys(url, key):
    assert warc.url_key(url) == key


BIG, OTHER = "x" * 200, "é" * 50
ROWS = [(1, "http://a.b/c", BIG), (2, None, BIG), (3, "x", None), (None, "http://a/\n", BIG), (4, "", ""), (1, "http://a.b/c", BIG), (5, "http://z.b/", "x" * 99), (6, "http://z.b/", "x" * 99), (8, "http://z.b/2", OTHER), (7, "http://z.b/1", OTHER), (9, "u", "y" * 300_000)]


@pytest.mark.parametrize("fan_in", [2, 64])
def test_odd_pages(spark, fan_in):
    df = spark.createDataFrame([(*r, "d", 3) for r in ROWS], "page_id long, url string, html string, digest string, size int").repartition(7)
    folder = warc.shared_folder(spark, "test")
    archives = warc.write_archives(df, folder)
    got = sorted(((r.page_id, r.payload_bytes, r.record_type, r.refers_to) for r in warc.read_archives(archives).collect()), key=str)
    want = [
        (1, 200, "response", None), (1, 200, "response", None), (2, 200, "revisit", 1), (None, 200, "revisit", 1), (3, 0, "response", None), (4, 0, "response", None),
        (5, 99, "response", None), (6, 99, "response", None), (7, 100, "response", None), (8, 100, "revisit", 7), (9, 300_000, "response", None),
    ]
    assert got == sorted(want, key=str)
    history = warc.captures(warc.merge_runs(archives, f"{folder}/m", fan_in)).orderBy("position").collect()
    assert [r.position for r in history] == list(range(len(ROWS)))
    keys = [(r.url_key, r.captured_at, r.page_id is not None, r.page_id or 0) for r in history]
    assert keys == sorted(keys)


def test_empty_table(spark):
    assert warc.archive_pages(spark, spark.createDataFrame([], "page_id long, url string, html string")).count() == 0


def test_query(spark, sf_dir):
    from riskframe.llm.queries import QUERIES

    pages = [(r.page_id, (r.html or "").encode()) for r in spark.read.parquet(f"{sf_dir}/pages.parquet").orderBy("page_id").collect()]
    first, want = {}, set()
    for i, raw in pages:
        head = first.setdefault(raw, i)
        again = len(raw) >= 100 and head != i
        want.add((i, len(raw), hashlib.sha256(raw).hexdigest(), "revisit" if again else "response", head if again else None))
    rows = QUERIES["op8_warc_captures"](spark, sf_dir).collect()
    assert {tuple(r)[:5] for r in rows} == want and len(rows) == len(want)
    assert sorted(r.position for r in rows) == list(range(len(rows)))


def test_records_are_never_broadcast_unmeasured(spark, sf_dir):
    """The last join knows the sizes of both sides; with a small limit it sorts and merges."""
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet")
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "2k")
    try:
        plan = warc.archive_pages(spark, pages)._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    assert "SortMergeJoin" in plan and "BroadcastExchange" not in plan
