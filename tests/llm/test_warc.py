import base64
import gzip
import hashlib
import json
import zlib

import pytest

from lintlake.llm import warc

from .conftest import prose

SCHEMA = "page_id long, url string, html string, payload string, sha string, keeper string"


def pages(spark, rows):
    return spark.createDataFrame([(*r, "p", "s", "k") for r in rows], SCHEMA).repartition(3)


def plain(rows, least=0):
    out = []
    for page_id, _, html in rows:
        body = (html or "").encode()
        same = [i for i, _, h in rows if (h or "").encode() == body and i is not None]
        first = min(same, default=None) if len(body) >= least else None
        response = first is None or page_id == first
        digest = base64.b32encode(hashlib.sha1(body).digest()).decode()
        out.append((page_id, len(body), digest, "response" if response else "revisit", None if response else first))
    return sorted(out, key=repr)


COLUMNS = ["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"]
EDGE = [
    (1, "http://a.example/ü?q=1 2", "<p>ü</p>"), (2, None, "<p>ü</p>"), (3, "x\r\ny", None), (4, "", ""), (4, "", ""),
    (5, "u", "WARC/1.1\r\n\r\nContent-Length: 3\r\n\r\n"), (None, "n", "<p>ü</p>"), (None, "n", "lonely"), (None, "m", "lonely"),
    (6, "long", prose(1, 60_000)), (7, "long", prose(1, 60_000)), (9, "z", "tail"), (8, "z", "tail"), (8, "z", "tail"),
]


@pytest.mark.parametrize("least", [0, 5])
def test_round_trip(spark, least):
    found = warc.archive_and_read(pages(spark, EDGE), least)
    assert sorted(map(tuple, found.select(*COLUMNS).collect()), key=repr) == plain(EDGE, least)
    payloads = {r.page_id: r.payload for r in found.collect() if r.record_type == "response" and r.page_id is not None}
    assert all(bytes(p).decode() == dict((i, h or "") for i, _, h in EDGE)[i] for i, p in payloads.items())


def test_empty(spark):
    assert warc.archive_and_read(pages(spark, EDGE).where("false")).collect() == []


def test_whole_file_is_normalised(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(warc, "BLOCK_BYTES", 100)
    rows = [(i, f"http://p/{i}", prose(i, i * 3)) for i in range(40)]
    decided = warc.with_decisions(pages(spark, rows)).coalesce(1)
    whole = warc.write_archives(decided, str(tmp_path))
    (source,) = whole.collect()
    records = list(warc.whole_records(source.path))
    assert len(records) == source.records == 40 and b"".join(records) == gzip.open(source.path).read()
    stream = zlib.decompressobj(31)
    stream.decompress(open(source.path, "rb").read())
    assert stream.eof and stream.unused_data == b""  # one member
    (made,) = warc.normalise(whole, str(tmp_path)).collect()
    data = open(made.path, "rb").read()
    index = [json.loads(line) for line in open(f"{made.path}.idx")]
    assert [zlib.decompress(data[e["offset"] : e["offset"] + e["length"]], 31) for e in index] == records
    assert sum(e["length"] for e in index) == len(data)
    assert not [p for p in tmp_path.iterdir() if not p.name.endswith((".warc.gz", ".idx", ".crc"))]


def test_records_across_members(tmp_path):
    records = [warc.make_record(i, "u", prose(i, 30).encode(), None, False) for i in range(5)]
    path = tmp_path / "x.warc.gz"
    path.write_bytes(gzip.compress(b"".join(records[:2])) + gzip.compress(b"".join(records[2:])))
    assert list(warc.whole_records(str(path))) == records
    path.write_bytes(gzip.compress(records[0][:-9]))
    with pytest.raises(ValueError):
        list(warc.whole_records(str(path)))


def test_damage_is_noticed():
    record = warc.make_record(1, "u", b"payload", None, False)
    with pytest.raises(ValueError):
        warc.parse_record(record.replace(b"payload\r\n", b"paylord\r\n"))


def test_a_block_is_inflated_in_pieces(tmp_path, monkeypatch):
    records = [warc.make_record(i, "u", b"0" * n, None, False) for i, n in enumerate((5_000_000, 0, 3 << 20, 7))]
    path = tmp_path / "x.warc.gz"
    path.write_bytes(gzip.compress(b"".join(records)))
    assert path.stat().st_size < warc.BLOCK_BYTES // 16
    with open(path, "rb") as source:
        pieces = list(warc._inflated(source, str(path)))
    assert max(map(len, pieces)) <= warc.BLOCK_BYTES and b"".join(pieces) == b"".join(records)
    assert list(warc.whole_records(str(path))) == records


def test_archives_are_spread_over_tasks(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(warc, "RANGE_BYTES", 4000)
    rows = [(i, f"http://p/{i}", prose(i, 60)) for i in range(120)]
    decided = warc.with_decisions(pages(spark, rows)).repartition(6, "page_id")
    whole = warc.write_archives(decided, str(tmp_path))
    assert whole.count() == 6 and warc._spread(whole).rdd.getNumPartitions() == 6
    made = warc.normalise(whole, str(tmp_path))
    index = warc.by_range(warc.read_index(made), made)
    assert index.rdd.getNumPartitions() == made.selectExpr("sum(ceil(bytes / 4000))").first()[0] > 6
    assert {r.page_id for r in warc.read_records(index).collect()} == set(range(120))
