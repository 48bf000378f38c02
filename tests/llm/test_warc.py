"""Archives: what is written comes back, and damage costs no record but the damaged ones."""
import gzip
import hashlib
import io
import random
import zlib

import pytest

from chronoweave.llm import warc
from chronoweave.llm._common import scratch
from chronoweave.plans.oracle_compare import compare, duck
from llm_helpers import SF_SMALL

PAGES = "page_id long, url string, html string, kind string, offset string, path string, d string, top string"


def pages(spark, rows):
    return spark.createDataFrame([(*r, "x", "x", "x", "x", "x") for r in rows], PAGES).repartition(3)


def round_trip(spark, rows, **kw):
    root = scratch(spark, "warc")
    warc.write_archives(pages(spark, rows), root, **kw)
    return warc.read_archives(spark, root)


def brute(rows, least=1000):
    top = {}
    for k, _, h in rows:
        h = (h or "").encode()
        if len(h) >= least and k is not None:
            top[h] = max(top.get(h, k), k)
    out = []
    for k, _, h in rows:
        h = (h or "").encode()
        t = top.get(h)
        again = t is not None and k != t
        out.append((k, len(h), hashlib.sha1(h).hexdigest(), "revisit" if again else "response", t if again else None))
    return sorted(out, key=repr)


def test_round_trip(spark):
    long_, other = "é" * 700, "x" * 1000
    fake = "a\r\n\r\nWARC/1.1\r\nWARC-Type: response\r\nContent-Length: 3\r\n\r\nabc\r\n\r\n" * 30
    rows = [(1, "http://a/é b?q=%20\r\nX: y", long_), (2, None, long_), (3, "u", long_), (4, "u", "short"), (5, "u", "short"),
            (6, "u", ""), (7, "u", None), (None, "u", long_), (None, "u", other), (None, "v", other), (9, "u", other[:-1]),
            (3, "again", long_), (3, "u", long_), (11, "", fake), (-4, "u", "z" * 2000), (-5, "u", "z" * 2000), (12, "u", "\x00\n\x1f" * 999)]
    got = round_trip(spark, rows)
    assert warc.quarantined(got).count() == 0
    assert sorted((tuple(r) for r in warc.page_records(got).collect()), key=repr) == brute(rows)
    bodies = {r["record_id"]: bytes(r["payload"]) for r in got.where("record_type = 'response'").collect()}
    assert set(bodies.values()) == {(h or "").encode() for _, _, h in rows}
    assert not any("\r" in (r["target_uri"] or "") for r in got.collect())


def test_long_record_and_hot_payload(spark):
    big = "".join(random.Random(1).choices("abcdefgh \n<>", k=17_000_000))
    rows = [(1, "u", big), (2, "u", big)] + [(i, "u", "hot" * 400) for i in range(3, 300)]
    got = round_trip(spark, rows, level=1)
    assert warc.quarantined(got).count() == 0
    assert sorted((tuple(r) for r in warc.page_records(got).collect()), key=repr) == brute(rows)


def test_empty_table(spark):
    got = round_trip(spark, [])
    assert got.count() == 0 and warc.page_records(got).columns[0] == "page_id"


def records(n, seed=3):
    r = random.Random(seed)
    return [warc.format_record(i, f"u{i}", b := bytes(r.choices(b"abc <>\n\xc3\xa9", k=r.randint(0, 3000))),
                               hashlib.sha1(b).hexdigest(), None, False, "2024-01-01T00:00:00Z") for i in range(n)]


def ids(found):
    return [int(x.record.fields["warc-record-id"].split(":")[2]) for x in found if x.record]


def run(data):
    found = list(warc.salvage(io.BytesIO(data), len(data)))
    at = 0  # records and gaps cover the file
    for x in found:
        assert x.length == 0 or x.offset - at in (0, len(warc.EMPTY_MEMBER))
        at = x.offset + x.length if x.length else at
    assert at == len(data) or not data
    return found


@pytest.mark.parametrize("packed", [True, False])
def test_every_damaged_record_costs_itself_only(packed):
    parts = [gzip.compress(x, mtime=0) if packed else x for x in records(12)]
    assert ids(run(b"".join(parts))) == list(range(12))
    r = random.Random(5)
    for hurt in range(12):
        for how in ("flip", "cut", "insert", "zero"):
            p = bytearray(parts[hurt])
            if how == "flip":
                # in plain headers only checked fields count: hit the block
                i = r.randrange(12, len(p)) if packed else p.index(b"\r\n\r\n") + 4 + r.randrange(20)
                p[i] ^= 1 << r.randrange(8)
            elif how == "cut":
                del p[len(p) // 2:]
            elif how == "insert":
                p[len(p) // 2:len(p) // 2] = b"\x1f\x8b\x08junk\nWARC/1.0\r\n"
            else:
                p[:] = bytes(len(p))
            found = run(b"".join([*map(bytes, parts[:hurt]), bytes(p), *parts[hurt + 1:]]))
            got = ids(found)
            assert [i for i in range(12) if i != hurt] == [i for i in got if i != hurt], (hurt, how)
            if hurt not in got:
                assert sum(x.record is None for x in found) == 1 and next(x for x in found if x.record is None).reason
    assert ids(run(b"garbage" + b"".join(parts)[5:])) == list(range(1, 12))
    assert ids(run(b"".join(parts)[:-7])) == list(range(11))


def test_mixed_and_many_in_a_member():
    a = records(9)
    data = gzip.compress(a[0] + a[1] + a[2]) + a[3] + warc.EMPTY_MEMBER + gzip.compress(a[4]) + a[5]
    assert ids(run(data)) == [0, 1, 2, 3, 4, 5]
    member = bytearray(gzip.compress(a[0] + a[1] + a[2]))
    member[-6] ^= 1  # checksum: the last record of the member is in doubt
    found = list(warc.salvage(io.BytesIO(bytes(member) + a[3]), len(member) + len(a[3])))
    assert ids(found) == [0, 1, 3] and any(x.reason for x in found)
    assert list(warc.salvage(io.BytesIO(b""), 0)) == []
    assert [x.reason is not None for x in warc.salvage(io.BytesIO(b"x" * 99), 99)] == [True]


def test_foreign_records():
    block = b"just text"
    rec = (b"WARC/1.0\r\nWARC-Type: resource\r\nWARC-Record-ID: <urn:uuid:1>\r\nX-Long: a\r\n b\r\nWARC-Block-Digest: sha1:"
           + hashlib.sha1(block).hexdigest().upper().encode() + b"\r\nContent-Length: 9\r\n\r\n" + block + b"\r\n\r\n")
    (x,) = warc.salvage(io.BytesIO(rec), len(rec))
    assert x.record.payload == block and x.record.fields["x-long"] == "a b"
    bad = rec.replace(b"just", b"JUST")
    assert [y.reason for y in warc.salvage(io.BytesIO(bad), len(bad))] == ["block digest differs"]


def test_damaged_file_through_spark(spark, tmp_dir):
    parts = [gzip.compress(x) for x in records(40)]
    whole = b"".join(parts)
    at = len(b"".join(parts[:7]))
    with open(f"{tmp_dir}/a b%20.warc.gz", "wb") as f:
        f.write(whole[:at + 9] + b"\xff" * 5 + whole[at + 14:])
    with open(f"{tmp_dir}/plain.warc", "wb") as f:
        f.write(zlib.decompress(parts[0], 31))
    got = warc.read_archives(spark, tmp_dir, payload=False)
    assert got.where("kind = 'record'").count() == 40 and got.where("payload IS NOT NULL").count() == 0
    (gap,) = warc.quarantined(got).collect()
    assert (gap["offset"], gap["length"]) == (at, len(parts[7]))


def test_query_and_sql(spark):
    from chronoweave.llm.queries import ORACLE, QUERIES
    got = QUERIES["op11_warc"](spark, SF_SMALL)
    ok, why = compare(got, duck(SF_SMALL), ORACLE["op11_warc"])
    assert ok, why
