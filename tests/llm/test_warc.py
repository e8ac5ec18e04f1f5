import gzip
import io
import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from casebeacon.llm import warc

PAGES = "page_id long, url string, html string"


def read(data, name="f"):
    salvage = warc.Salvage(io.BytesIO(data), name)
    return list(salvage.records()), salvage.gaps


def record(i, html, refers=None):
    return warc.record_bytes(i, f"http://h/{i}", html, refers)


def test_round_trip(spark, run_dir):
    rows = [(1, "http://a", "x"), (2, "http://b", "y"), (3, "u 1\nz", "x"), (4, None, None), (5, "e", ""), (6, "l", "é" * 3_000_000), (None, "n", "x"), (None, "n", "lone"), (2, "http://b", "y"), (2**60, "big", "x")]
    pages = spark.createDataFrame(rows, PAGES).withColumn("file", F.lit(1)).withColumn("SHA", F.lit(2))
    manifest = warc.write_archives(pages, run_dir, roll_bytes=1000)
    records, gaps = warc.read_archives(manifest, run_dir)
    got = Counter((r.record_type, r.refers_to, r.payload_bytes, r.payload_digest, None if r.payload is None else bytes(r.payload).decode()) for r in records.collect())
    one = lambda html, kind="response", to=None: (kind, to, len(html.encode()), warc.digest(html.encode()), html if kind == "response" else None)
    want = [one("x"), one("y"), one("y"), one("x", "revisit", "<urn:page:1>"), one("x", "revisit", "<urn:page:1>"), one("x", "revisit", "<urn:page:1>"), one(""), one("", "revisit", "<urn:page:4>"), one("é" * 3_000_000), one("lone")]
    assert got == Counter(want) and gaps.count() == 0
    assert manifest.agg(F.sum("n_records")).first()[0] == len(rows)


def test_payloads_below_the_least_size_are_written_again(spark, run_dir):
    pages = spark.createDataFrame([(1, "a", "xx"), (2, "a", "xx"), (3, "a", "long"), (4, "a", "long")], PAGES)
    records, _ = warc.read_archives(warc.write_archives(pages, run_dir, min_bytes=3), run_dir)
    assert Counter((r.record_type, r.payload_bytes) for r in records.collect()) == Counter({("response", 2): 2, ("response", 4): 1, ("revisit", 4): 1})


def test_archives_of_nothing(spark, run_dir):
    records, gaps = warc.read_archives(warc.write_archives(spark.createDataFrame([], PAGES), run_dir), run_dir)
    assert records.collect() == [] and gaps.collect() == []


@pytest.mark.parametrize("plain", [False, True])
def test_damage_costs_only_the_damaged_record(plain):
    members = [record(i, f"<p>{i}</p>" * 50) for i in range(6)]
    if plain:
        members = [gzip.decompress(m) for m in members]
    starts = [sum(map(len, members[:i])) for i in range(7)]
    data = bytearray(b"".join(members))
    middle = starts[2] + len(members[2]) * 2 // 3
    data[middle] ^= 0x55
    rows, gaps = read(bytes(data))
    assert [r[5] for r in rows] == [f"<urn:page:{i}>" for i in (0, 1, 3, 4, 5)]
    assert [(g[1], g[2]) for g in gaps] == [(starts[2], starts[3])]


def test_missing_and_foreign_bytes():
    a, b, c = (record(i, "text" * 400) for i in range(3))
    rows, gaps = read(a + b[:-20] + c)  # the end of b is gone
    assert [r[5] for r in rows] == ["<urn:page:0>", "<urn:page:2>"]
    assert [(g[1], g[2]) for g in gaps] == [(len(a), len(a) + len(b) - 20)]
    rows, gaps = read(a + b"WARC/1.1\r\njunk" + warc.MAGIC + b"no member" * 9 + b + c[:-9])
    assert [r[5] for r in rows] == ["<urn:page:0>", "<urn:page:1>"] and len(gaps) == 2
    assert gaps[-1][2] == len(a) + 14 + 3 + 81 + len(b) + len(c) - 9
    assert read(b"") == ([], []) and read(b"\r\n\r\n") == ([], [])
    assert read(b"nothing here")[1] == [("f", 0, 12, "no member or version line")]


def test_damage_anywhere_never_loses_an_intact_record():
    rng = random.Random(1)
    members = [record(i, f"page {i} " * 30) for i in range(5)]
    whole = b"".join(members)
    for _ in range(150):
        at = rng.randrange(len(whole))
        data = whole[:at] + bytes([whole[at] ^ rng.randrange(1, 256)]) + whole[at + 1 :]
        hit = next(i for i in range(5) if at < sum(map(len, members[: i + 1])))
        rows, gaps = read(data)
        names = [r[5] for r in rows]
        assert all(f"<urn:page:{i}>" in names for i in range(5) if i != hit)
        assert hit in [int(n[10:-1]) for n in names] or len(gaps) == 1


def test_gaps_are_logged_from_files(spark, tmp_path):
    good, bad = record(1, "a"), record(2, "b")
    (tmp_path / "x.warc.gz").write_bytes(good + bad[:-5] + good)
    records, gaps = warc.read_archives(warc.archive_files(spark, str(tmp_path)))
    assert records.count() == 2
    assert [(g.gap_start, g.gap_end) for g in gaps.collect()] == [(len(good), len(good) + len(bad) - 5)]


def test_header_of_a_very_long_url(spark, run_dir):
    url = "http://a.example/" + "x" * 200_000
    pages = spark.createDataFrame([(1, url, "<p>a</p>"), (2, "http://b.example/", "<p>b</p>")], "page_id long, url string, html string")
    records, gaps = warc.read_archives(warc.write_archives(pages, run_dir), run_dir)
    assert {r.target_uri for r in records.collect()} == {url, "http://b.example/"}
    assert gaps.count() == 0


def names(rows):
    return [r[5] for r in rows]


def test_member_that_holds_all_records():
    plain = [gzip.decompress(record(i, f"<p>{i}</p>" * rng_size)) for i, rng_size in enumerate((50, 1, 400_000, 3, 50))]
    data = gzip.compress(b"".join(plain))
    rows, gaps = read(data)
    assert names(rows) == [f"<urn:page:{i}>" for i in range(5)] and gaps == []
    assert {r[1:3] for r in rows} == {(0, None)}
    # A bad record inside costs itself and leaves one gap, the member's.
    bad = plain[:2] + [plain[2].replace(b"<p>2", b"<p>9", 1)] + plain[3:]
    rows, gaps = read(gzip.compress(b"".join(bad)))
    assert names(rows) == [f"<urn:page:{i}>" for i in (0, 1, 3, 4)]
    assert [g[1:] for g in gaps] == [(0, len(gzip.compress(b"".join(bad))), "block digest")]
    # A member that breaks off keeps what came before, and the next member is found.
    rng = random.Random(4)
    noise = [gzip.decompress(record(i, "".join(rng.choice("abcdefghijklmnop") for _ in range(200_000)))) for i in range(4)]
    cut = gzip.compress(b"".join(noise))
    cut = cut[: len(cut) * 7 // 10]
    rows, gaps = read(cut + record(9, "after"))
    assert names(rows) == ["<urn:page:0>", "<urn:page:1>", "<urn:page:9>"]
    assert len(gaps) == 1 and gaps[0][2] == len(cut)


def test_a_member_of_many_records_is_never_held_whole():
    rng = random.Random(5)
    plain = b"".join(gzip.decompress(record(i, "".join(rng.choice("abcdefghijklmnop") for _ in range(20_000)))) for i in range(300))
    salvage, most, n = warc.Salvage(io.BytesIO(gzip.compress(plain)), "f"), 0, 0
    for _ in salvage.records():
        most, n = max(most, len(salvage.held)), n + 1
    assert n == 300 and most < 3 * warc.STEP < len(plain)


def test_long_headers_in_plain_archives():
    members = [gzip.decompress(warc.record_bytes(i, "http://a/" + "x" * n, "text", None)) for i, n in enumerate((5, 70_000, 3_000_000, 5))]
    rows, gaps = read(b"".join(members))
    assert names(rows) == [f"<urn:page:{i}>" for i in range(4)] and gaps == []
    rows, gaps = read(b"WARC/1.1\r\nno colon\r\n" + b"z" * 3_000_000 + members[0])
    assert names(rows) == ["<urn:page:0>"] and len(gaps) == 1


def test_members_without_records():
    assert read(gzip.compress(b"")) == ([], [])
    rows, gaps = read(gzip.compress(b"junk") + record(1, "a"))
    assert names(rows) == ["<urn:page:1>"] and len(gaps) == 1
