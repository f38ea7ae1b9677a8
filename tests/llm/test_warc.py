import gzip
import hashlib
import random

import pytest

from tapework.llm import warc
from tapework.session import fresh_path

SCHEMA = "page_id long, url string, html string"


def pages():
    rng = random.Random(4)
    long = "".join(rng.choice("abc<>é漢🙂 \n\r") for _ in range(40_000))
    rows = [(k, f"http://x.example/{k % 3}?a=1 b%", f"<p>{k % 5}</p>" * 30) for k in range(40)]
    return rows + [(100, None, None), (101, "", ""), (102, "u", long), (103, "u\r\nWARC-Type: x", long), (104, "u", "short"), (105, "u", "short"),
                   (None, "u", long), (50, "u", "z" * 99), (51, "u", "z" * 99), (52, "u", "y" * 100), (52, "u", "y" * 100), (53, "u", "y" * 100),
                   (54, "u", "\r\n\r\nWARC/1.1\r\n\x1f")]


def expected(rows):
    first = {}
    for page, _, html in rows:
        data = (html or "").encode()
        if len(data) >= 100 and page is not None:
            first[data] = min(page, first.get(data, page))
    for page, _, html in rows:
        data = (html or "").encode()
        to = first.get(data)
        yield page, len(data), hashlib.sha256(data).hexdigest(), *(("response", None) if to is None or to == page else ("revisit", to))


@pytest.mark.parametrize("split", [1, 97, 1 << 20])
def test_round_trip_for_any_split(spark, split):
    rows = pages() if split > 1 else pages()[:3]
    table = spark.createDataFrame([(*r, "extra") for r in rows], SCHEMA + ", payload string").repartition(3)
    got = warc.round_trip(table, split_bytes=split).collect()
    assert sorted(((r.page_id, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to) for r in got), key=repr) == sorted(expected(rows), key=repr)
    html = {r[0]: (r[2] or "").encode() for r in rows}
    assert all(bytes(r.payload) == html[r.page_id] for r in got if r.record_type == "response" and r.page_id is not None)


def test_empty_table(spark):
    assert warc.round_trip(spark.createDataFrame([], SCHEMA)).collect() == []


def test_records_are_plain_gzip_members(spark):
    folder = fresh_path(spark, "warc-test")
    files = warc.write_archives(warc.with_revisits(spark.createDataFrame(pages(), SCHEMA).coalesce(1)), folder).collect()
    data = b"".join(gzip.decompress(open(f.path.removeprefix("file:"), "rb").read()) for f in files)
    assert data.count(b"WARC/1.1\r\nWARC-Type: ") == len(pages()) == sum(f.records for f in files)


class Bytes:
    def __init__(self, data):
        self.data, self.size = data, len(data)

    def at(self, offset, n=warc.CHUNK):
        return self.data[offset:offset + n]


def test_false_magic_is_no_record():
    fake = warc.MAGIC + b"\0" * 40 + gzip.compress(b"not a record")
    record = warc._member(warc._record(1, "u", b"p" * 500, "d", None, "date"), 6)
    data = fake + record + fake + record + record[:-1]
    second = len(fake) * 2 + len(record)
    found = [s for s in range(len(data)) for _ in ([0] if warc.find_record(Bytes(data), s, s + 1) == s else [])]
    assert found == [len(fake), second, second + len(record)]
    assert len(list(warc.records_in(Bytes(data), 0, second + 1))) == 2
    with pytest.raises(ValueError):
        list(warc.records_in(Bytes(data), second + 1, len(data)))


def test_magic_across_reads(monkeypatch):
    monkeypatch.setattr(warc, "CHUNK", 16)
    record = warc._member(warc._record(1, "u", b"p", "d", None, "date"), 6)
    for lead in range(40):
        assert warc.find_record(Bytes(b"\0" * lead + record), 0, lead + len(record)) == lead
