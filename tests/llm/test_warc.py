import gzip
import hashlib
import zlib

import pytest

from oracle_compare import compare, duck
from pricebasket.llm import warc as W

PAGES = "page_id long, url string, html string"
LONG, OTHER = "<p>é漢</p>" * 40, "<b>x\0y</b>\r\n\r\nWARC/1.1\r\n" * 9
ROWS = [(5, "http://a/1", LONG), (3, "http://b/ü?x=1%0A\r\nX: y", LONG), (9, None, LONG), (1, "u", "short"), (2, "u", "short"),
        (7, "u", None), (8, "u", ""), (10, "u", OTHER), (10, "u", OTHER), (11, "u", OTHER), (None, "n", OTHER), (12, "u", "z" * 99),
        (13, "u", "z" * 99), (14, "u", "z" * 100), (15, "u", "z" * 100), (16, "big", "y" * 3_000_000)]


def want():
    out = []
    for i, url, html in ROWS:
        data = (html or "").encode()
        first = min((j for j, _, h in ROWS if (h or "").encode() == data and j is not None), default=None)
        revisit = len(data) >= 100 and first is not None and first != i
        out.append((i, url, len(data), hashlib.sha256(data).hexdigest(), "revisit" if revisit else "response", first if revisit else None))
    return sorted(out, key=str)


@pytest.mark.parametrize("size", [1 << 20, 1])
def test_round_trip(spark, monkeypatch, size):
    monkeypatch.setattr(W, "ARCHIVE_BYTES", size)
    pages = spark.createDataFrame(ROWS, PAGES).selectExpr("*", "'own' as digest", "'own' as first_id", "'own' as payload")
    got = W.round_trip(pages, payloads=True).collect()
    assert all(r["digest_ok"] for r in got)
    assert sorted(((r["page_id"], r["url"], r["payload_bytes"], r["payload_digest"], r["record_type"], r["refers_to"]) for r in got),
                  key=str) == want()
    texts = {(i, hashlib.sha256((h or "").encode()).hexdigest()): (h or "").encode() for i, _, h in ROWS}
    assert all((r["payload"] is None) == (r["record_type"] == "revisit") and
               (r["payload"] is None or bytes(r["payload"]) == texts[r["page_id"], r["payload_digest"]]) for r in got)


def test_archives_are_plain_gzip(spark, tmp_path):
    W.write_archives(spark.createDataFrame(ROWS, PAGES).coalesce(1), f"file://{tmp_path}/a")
    files = sorted(x for x in (tmp_path / "a").iterdir() if x.name.startswith("part-"))
    text = b"".join(gzip.decompress(x.read_bytes()) for x in files)  # padding included
    assert text.count(b"WARC/1.1\r\nWARC-Type: ") == len(ROWS)


def test_empty_table(spark):
    assert W.round_trip(spark.createDataFrame([], PAGES)).collect() == []


def test_damage_is_found():
    digest = hashlib.sha256(b"payload").hexdigest()
    good = W.make_record(1, "u", b"payload", digest, None, False)
    assert [r["digest_ok"] for r in W.read_records(good + b"\0\0" + good + b"\0")] == [True, True]
    raw = gzip.decompress(good)
    assert not next(W.read_records(gzip.compress(raw.replace(b"payload\r", b"pay1oad\r"))))["digest_ok"]
    with pytest.raises(ValueError, match="cut short|Content-Length"):
        list(W.read_records(good[:-20]))
    with pytest.raises(ValueError, match="Content-Length"):
        list(W.read_records(gzip.compress(raw[:-3])))
    with pytest.raises((ValueError, zlib.error)):
        list(W.read_records(good + b"junk"))


def test_oracle(spark):
    sf = "/root/testdata/sf0.01"
    assert compare(spark, duck(sf), "op5", W.op5_warc, W.ORACLE_OP5, sf)["ok"]
