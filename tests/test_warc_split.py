"""Archives read in stretches against archives read in one go."""

import gzip
import io
import random
import zlib
from collections import Counter

import pytest
from conftest import dicts
from pyspark.sql import functions as F
from test_extract_warc import record, write_warc

from corpuslake.operators.cdx import target_records
from corpuslake.sources import warc
from corpuslake.sources.warc_format import SURE, first_record, read_records

DRAW = random.Random(11)


def binary(uri, payload, kind="resource"):
    head = f"WARC/1.0\r\nWARC-Type: {kind}\r\nWARC-Target-URI: {uri}\r\nContent-Length: {len(payload)}\r\n\r\n"
    return head.encode() + payload + b"\r\n\r\n"


def noise(n):
    return bytes(DRAW.randrange(256) for _ in range(n))


def nested():
    """An archive as a payload, its own members whole and readable in the outer archive's stored blocks."""
    inner = b"".join(gzip.compress(record(f"inner{i}", f"<p>{i}" + "x" * 50)) for i in range(30))
    return binary("nested", inner)


def stored(data):
    """A gzip member whose bytes are the data itself."""
    packer = zlib.compressobj(0, zlib.DEFLATED, 31)
    return packer.compress(data) + packer.flush()


def archive():
    """Members of every kind: small, large, incompressible, with the magic number, with whole archives inside."""
    out = [gzip.compress(record("info", "", "warcinfo"))]
    for i in range(40):
        out.append(gzip.compress(record(f"u{i}", "<p>" + "word " * DRAW.randrange(1, 400))))
    out.append(stored(nested()))
    out.append(stored(binary("magic", b"\x1f\x8b\x08" * 200 + b"WARC/1.0\r\n" * 9)))
    out.append(gzip.compress(binary("noise", noise(90_000))))
    out.append(stored(binary("large", noise(30_000) + b"".join(gzip.compress(record(f"deep{i}", "y" * i)) for i in range(3000)))))
    out.append(gzip.compress(record("two", "<p>2") + record("three", "<p>3")))
    out.append(gzip.compress(b"\r\n\r\n" + record("after blanks", "<p>4")))
    out.append(b"\0" * 700)
    for i in range(40, 60):
        out.append(gzip.compress(record(f"u{i}", "<p>" + "text " * DRAW.randrange(1, 400))))
    return b"".join(out)


def rows(data, start=0, end=None):
    return [(r[1], r[2], r[5], zlib.crc32(r[6])) for r in read_records("f", io.BytesIO(data), start, end)]


def in_pieces(data, cuts):
    out = []
    for a, b in zip([0, *cuts], [*cuts, len(data)], strict=True):
        start = first_record(io.BytesIO(data), a, b)
        if start is not None:
            out += rows(data, start, b)
    return out


@pytest.fixture(scope="module")
def data():
    return archive()


def test_the_archive_shows_what_it_should(data):
    whole = rows(data)
    assert [r[0] for r in whole].count("response") == 63 and "unreadable" not in {r[0] for r in whole}
    assert data.count(b"\x1f\x8b\x08") > 300 and not any(r[1].startswith(("inner", "deep")) for r in whole)


@pytest.mark.parametrize("n", [2, 3, 7, 40, 150])
def test_pieces_give_the_rows_of_one(data, n):
    assert in_pieces(data, [len(data) * i // n for i in range(1, n)]) == rows(data)


def test_cuts_at_every_kind_of_place(data):
    whole = rows(data)
    places = [i for i in range(len(data)) if data.startswith(b"\x1f\x8b\x08", i)]
    for at in [*DRAW.sample(places, 60), *DRAW.sample(range(1, len(data)), 60)]:
        for cut in (at - 1, at, at + 1):
            if 0 < cut < len(data):
                assert in_pieces(data, [cut]) == whole, cut


def test_archive_in_one_member_goes_to_the_first_piece():
    data = gzip.compress(b"".join(record(f"u{i}", noise(300).hex()) for i in range(50)))
    assert in_pieces(data, [len(data) // 3, len(data) // 2]) == rows(data) and len(rows(data)) == 50


def test_uncompressed_archives():
    inner = record("inner", "<p>x") * 3
    data = b"".join([
        *[record(f"u{i}", "<p>" + "word " * DRAW.randrange(1, 200)) for i in range(30)],
        binary("nested", b"some text\n" + inner), binary("line", b"\nWARC/1.0 is a version line\n"), binary("cut", b"\nWARC/1.0\r\nContent-Length: 9\r\n\r\n"),
        *[record(f"v{i}", "<p>" + "word " * DRAW.randrange(1, 200)) for i in range(30)],
    ])
    whole = rows(data)
    assert len(whole) == 63
    for n in (2, 5, 60):
        assert in_pieces(data, [len(data) * i // n for i in range(1, n)]) == whole
    for at in DRAW.sample(range(1, len(data)), 200):
        assert in_pieces(data, [at]) == whole


def test_damage_costs_one_piece_its_rest():
    members = [gzip.compress(record(f"u{i}", noise(2000).hex())) for i in range(120)]
    broken = bytearray(b"".join(members))
    at = sum(map(len, members[:60])) + len(members[60]) // 2
    broken[at : at + 40] = b"\xff" * 40
    n = 6
    got = in_pieces(bytes(broken), [len(broken) * i // n for i in range(1, n)])
    names = [r[1] for r in got if r[0] == "response"]
    assert names[:60] == [f"u{i}" for i in range(60)] and "u119" in names and "u60" not in names
    assert [r[0] for r in got].count("unreadable") == 1
    assert len(rows(bytes(broken))) == 61  # in one go nothing is found behind it


def test_wanted_records_alone_are_read(data):
    got = [r[2] for r in read_records("f", io.BytesIO(data), wanted=lambda kind, uri, date: uri.endswith("7"))]
    assert got == [f"u{i}" for i in (7, 17, 27, 37, 47, 57)]


def key(r):
    return r["filename"], r["warc_type"], r["target_uri"], r["status_code"], bytes(r["payload"]), tuple(sorted(r["headers"].items()))


def test_scan_splits_large_files(spark, tmp_path, data):
    (tmp_path / "a.warc.gz").write_bytes(data)
    write_warc(tmp_path / "b.warc.gz", [record("b", "<p>1")])
    whole = Counter(map(key, dicts(warc.scan_warc(spark, str(tmp_path)))))
    split = warc.scan_warc(spark, str(tmp_path), split_bytes=len(data) // 9)
    assert split.rdd.getNumPartitions() >= 10
    assert Counter(map(key, dicts(split))) == whole and sum(whole.values()) > 60


def test_wanted_records_reach_the_reader(spark, tmp_path, data):
    (tmp_path / "a.warc.gz").write_bytes(data)
    write_warc(tmp_path / "b.warc.gz", [record("u7", "<p>b")])
    scan = lambda **wanted: warc.scan_warc(spark, str(tmp_path), 50_000, warc.RecordFilter(**wanted))
    one = scan(types=["response"], uris=["u7", "u8", "none"])
    whole = warc.scan_warc(spark, str(tmp_path)).filter("warc_type = 'response' AND target_uri IN ('u7', 'u8', 'none')")
    assert sorted(map(key, dicts(one))) == sorted(map(key, dicts(whole)))
    # What the reader sends is counted before any filter of Spark's: three rows of more than sixty.
    sent = sum(batch.num_rows for piece in warc.pieces(str(tmp_path), 50_000) for batch in warc._read_piece(piece, warc.RecordFilter(types=["response"], uris=["u7", "u8"]).test()))
    assert sent == 3
    assert ") Filter " not in one._jdf.queryExecution().executedPlan().toString()
    assert [r["target_uri"] for r in dicts(scan(files=["b.warc.gz"]))] == ["u7"]
    assert scan(files=["b.warc.gz"]).rdd.getNumPartitions() == 1
    assert {r["target_uri"] for r in dicts(scan(uri_prefix="u5"))} == {"u5", *[f"u{i}" for i in range(50, 60)]}
    assert scan(types=["response"], date_start="2020-04-01", date_end="2020-04-02").count() == 64
    assert scan(types=["response"], date_start="2020-04-02").count() == 0 and scan(types=[]).count() == 0


def test_several_filters_on_one_scan_stay_apart(spark, tmp_path, data):
    (tmp_path / "a.warc.gz").write_bytes(data)
    scan = warc.scan_warc(spark, str(tmp_path), 50_000)
    one, two = scan.filter("target_uri = 'u1'"), scan.filter("target_uri = 'u2'")
    assert [r["target_uri"] for r in dicts(one)] == ["u1"] and [r["target_uri"] for r in dicts(two)] == ["u2"]
    assert one.join(two, "warc_type").count() == 1 and scan.count() == 68


@pytest.mark.parametrize("bits", [1 << 10, 1 << 20])
def test_scan_targets_is_target_records_of_a_scan(spark, tmp_path, data, bits):
    """With few bits many other records pass the filter; the rows stay the same."""
    (tmp_path / "a.warc.gz").write_bytes(data)
    write_warc(tmp_path / "b.warc.gz", [record("u7", "<p>b"), record("é", "<p>c")])
    wanted = [(f"u{i}",) for i in range(0, 60, 3)] + [("é",), ("",), (None,), ("u3",), ("nested",)] + [(f"other{i}",) for i in range(2000)]
    index = spark.createDataFrame(wanted, "url string")
    want = target_records(warc.scan_warc(spark, str(tmp_path)), index)
    got = warc.scan_targets(spark, str(tmp_path), index, split_bytes=40_000, most_bits=bits)
    assert got.columns == warc.WARC_RECORDS.names
    assert Counter(map(key, dicts(got))) == Counter(map(key, dicts(want))) and want.count() == 21
    assert warc.scan_targets(spark, str(tmp_path), index.limit(0)).collect() == []
    (tmp_path / "none").mkdir()
    assert warc.scan_targets(spark, str(tmp_path / "none"), index).collect() == []


def test_url_filter_never_loses_a_url(spark):
    urls = [f"https://example.com/ä/{i}" for i in range(3000)]
    found = warc.url_filter(spark.createDataFrame([(u,) for u in urls], "url string"))
    assert all(u in found for u in urls)
    assert sum(f"https://example.org/{i}" in found for i in range(3000)) < 60


def test_stored_blocks_bound_what_a_payload_can_show():
    """The longest run of readable inner members in a stored member ends within SURE bytes."""
    inner = b"".join(gzip.compress(record(f"i{i}", "z")) for i in range(2000))
    outer = stored(binary("n", inner))
    runs, at = [], outer.find(b"\x1f\x8b\x08", 10)
    while at >= 0:
        end = at
        try:
            while True:
                member = zlib.decompressobj(31)
                member.decompress(outer[end:])
                if not member.eof:
                    break
                end = len(outer) - len(member.unused_data)
        except zlib.error:
            pass
        runs.append(end - at)
        at = outer.find(b"\x1f\x8b\x08", at + 60_000)
    assert 0 < max(runs) <= SURE
