import base64
import hashlib

import numpy as np

from gridloom.llm import warc

PAGE = "page_id long, url string, html string, digest string, record_type string"


def frame(spark, rows):
    return spark.createDataFrame([(i, f"http://x/{i}\r\nWARC/1.0", h, "clash", "clash") for i, h in rows], PAGE)


def digest(t):
    return base64.b32encode(hashlib.sha1((t or "").encode()).digest()).decode()


FAKE = "WARC/1.0\r\nWARC-Type: response\r\nWARC-Record-ID: <urn:page:999>\r\nContent-Length: 3\r\n\r\nabc\r\n\r\n"
ROWS = [(1, "<p>one</p>"), (2, "<p>one</p>"), (3, None), (4, ""), (5, FAKE), (6, "x" + FAKE + FAKE), (7, "ü漢🎉\r\n\r\n"), (8, "y" * 300_000), (9, "<p>one</p>"), (10, FAKE[:-4]), (11, "\r\n\r\nWARC/1.0\r\n")]


def test_round_trip(spark):
    out = {r.page_id: r for r in warc.round_trip(frame(spark, ROWS)).collect()}
    assert set(out) == {i for i, _ in ROWS}
    for i, h in ROWS:
        same = [j for j, g in ROWS if (g or "") == (h or "")]
        r = out[i]
        assert (r.payload_bytes, r.payload_digest) == (len((h or "").encode()), digest(h))
        assert (r.record_type, r.refers_to) == (("response", None) if i == max(same) else ("revisit", max(same)))


def test_small_payloads_may_be_left_alone(spark):
    out = {r.page_id: r.record_type for r in warc.round_trip(frame(spark, ROWS), min_bytes=5).collect()}
    assert out[3] == out[4] == "response" and out[1] == "revisit"


def test_repeats_nulls_and_nothing(spark):
    out = warc.round_trip(frame(spark, [(1, "a"), (1, "a"), (None, "a"), (2, "b")])).collect()
    assert sorted(str(r.page_id) for r in out) == ["1", "1", "2", "None"]
    assert warc.round_trip(frame(spark, [])).count() == 0


def test_one_id_with_different_payloads(spark):
    out = warc.round_trip(frame(spark, [(1, "A"), (1, "B"), (2, "A")])).collect()
    got = sorted((r.page_id, r.payload_digest, r.record_type, r.refers_to or 0) for r in out)
    assert got == sorted([(1, digest("A"), "revisit", 2), (1, digest("B"), "response", 0), (2, digest("A"), "response", 0)])


def test_pointer_jumping_keeps_the_chain():
    at = np.array([0, 10, 12, 25, 40, 41])
    successor = np.array([10, 25, 40, 40, 60, 99])
    assert warc.reachable(at, successor).tolist() == [True, True, False, True, True, False]
    shuffled = np.array([3, 0, 5, 1, 4, 2])
    assert warc.reachable(at[shuffled], successor[shuffled]).tolist() == [True, True, False, True, True, False]
    n = 1000
    assert warc.reachable(np.arange(n), np.arange(n) + 1).all()


def test_candidates_inside_payloads_are_seen_and_rejected():
    record = lambda t: f"WARC/1.0\r\nWARC-Type: response\r\nContent-Length: {len(t)}\r\n\r\n{t}\r\n\r\n"
    data = (record("a") + record("x" + FAKE + FAKE) + record("b")).encode()
    lines = data.split(warc.MAGIC.encode())
    batch = warc.pa.record_batch({"path": ["f"] * len(lines), "block": [0] * len(lines), "segment": lines})
    found = warc.pa.Table.from_batches(warc._candidates([batch]))
    assert sum(x is not None for x in found.column("successor").to_pylist()) == 5
    chain = warc._chain(found).to_pylist()
    assert [r["at"] for r in chain if r["kept"]] == [0, len(record("a")), len(data) - len(record("b"))]
    assert len({r["owner"] for r in chain if r["owner"] is not None}) == 1 and sum(r["owner"] is not None for r in chain) == 3


def test_ranges_of_files(spark, tmp_path):
    """Records, payloads and magic strings across the borders of what a task reads, and a file that ends in a record."""
    rows = [(i, h) for k in range(30) for i, h in ((5 * k, f"{k}" + "z" * (37 * k)), (5 * k + 1, f"{k}{FAKE}tail"), (5 * k + 2, None if k else "WARC/1.0\r\n"), (5 * k + 3, FAKE * 3 + str(k)))]
    warc.write_archives(warc.with_revisits(frame(spark, rows).coalesce(1)), f"{tmp_path}/w", per_file=50)
    files = sorted((tmp_path / "w").glob("*.txt"))
    files[0].write_bytes(files[0].read_bytes()[:-9])  # its last record is cut off
    for c in (tmp_path / "w").glob(".*.crc"):
        c.unlink()
    for size in (501, 4001, 1 << 20):
        spark.conf.set("spark.sql.files.maxPartitionBytes", size)
        spark.conf.set("spark.sql.files.openCostInBytes", 0)
        try:
            out = {r.page_id: (r.payload_bytes, r.payload_digest) for r in warc.read_archives(spark, f"{tmp_path}/w").collect()}
        finally:
            spark.conf.unset("spark.sql.files.maxPartitionBytes")
            spark.conf.unset("spark.sql.files.openCostInBytes")
        assert len(out) == len(rows) - 1
        assert all((len((h or "").encode()), digest(h)) == out.get(i, (len((h or "").encode()), digest(h))) for i, h in rows)


def test_base32(spark):
    from pyspark.sql import functions as F

    for t in ("", "a", "ü" * 99):
        assert spark.range(1).select(warc.sha1_base32(F.lit(t).cast("binary")).alias("d")).first().d == digest(t)
