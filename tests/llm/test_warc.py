import base64
import gzip
import hashlib
import random

from docloom.llm import warc

PAGES = "page_id bigint, url string, html string, extra string"


def roundtrip(spark, rows, **options):
    folder = warc.archive_folder(spark)
    warc.write_archive(spark.createDataFrame(rows, PAGES), folder, **options)
    return warc.read_archive(spark, f"{folder}/*.txt").collect()


def test_round_trip(spark):
    rows = [(3, "u3", "same", "x"), (1, "u1", "same", None), (2, None, None, ""), (4, "u4", "", ""), (5, "u5", "é" * 40000, ""), (6, "u\n6", "\r\n\r\nWARC/1.1\r\n", ""), (7, "u7", "abcdefgh" * 2_200_000, ""), (None, "n", "same", ""), (1, "u1", "same", "")]
    got = roundtrip(spark, rows)
    assert len(got) == len(rows) and all(r["kind"] == "record" and r["reason"] is None for r in got)
    by = {r["record_id"].rsplit(":", 1)[1]: r for r in got}
    for key, _, html, _ in rows:
        data = (html or "").encode()
        row = by[str(key) if key is not None else "null"]
        assert row["payload_bytes"] == len(data)
        assert row["payload_digest"] == base64.b32encode(hashlib.sha1(data).digest()).decode()
    assert by["1"]["record_type"] == "response" and by["3"]["refers_to"].endswith(":1") and by["null"]["refers_to"].endswith(":1")
    assert by["2"]["record_type"] == "response" and by["4"]["refers_to"].endswith(":2")
    assert bytes(by["6"]["payload"]) == rows[5][2].encode() and bytes(by["3"]["payload"]) == b""


def test_small_payloads_need_no_revisit(spark):
    got = roundtrip(spark, [(1, "a", "xy", ""), (2, "b", "xy", "")], least_bytes=3)
    assert {r["record_type"] for r in got} == {"response"}


def test_no_rows(spark):
    assert roundtrip(spark, []) == []


def whole(i, text="body"):
    return warc.member(warc.record(f"urn:page:{i}", f"http://x/{i}", text.encode(), None)) + b"\0"


def test_members_are_gzip():
    data = b"".join(whole(i) for i in range(4))
    assert gzip.decompress(data).count(b"WARC/1.1") == 4


def kinds(data):
    return [(r["kind"], r.get("record_id"), r["offset"], r["length"]) for r in warc.salvage(data)]


def test_salvage_skips_damage():
    a, b, c = (whole(i, "text %d " % i * 200) for i in range(3))
    broken = bytearray(b)
    broken[len(b) // 2] ^= 0xFF
    got = kinds(a + bytes(broken) + c)
    assert [g[:2] for g in got] == [("record", "urn:page:0"), ("gap", None), ("record", "urn:page:2")]
    assert got[1][2:] == (len(a), len(b))


def test_salvage_garbage_truncation_and_bare_records():
    bare = warc.record("urn:page:9", None, b"plain", None)
    data = b"junk \x1f\x8b\x08 junk" + whole(1) + b"WARC/1.0 not a record\r\n\r\n" + bare + whole(2)[:-9]
    got = list(warc.salvage(data))
    assert [r["kind"] for r in got] == ["gap", "record", "gap", "record", "gap"]
    assert sum(r["length"] for r in got) == len(data)
    assert got[3]["payload"] == b"plain" and got[4]["reason"] == "truncated member"


def test_wrong_block_digest_is_a_gap():
    bare = warc.record("urn:page:9", None, b"plain", None).replace(b"plain", b"plaid")
    assert [r["reason"] for r in warc.salvage(bare)] == ["block digest differs"]
    assert list(warc.salvage(b"")) == []


def test_salvage_inside_a_member():
    parts = [warc.record(f"urn:page:{i}", None, b"text %d " % i * 50, None) for i in range(6)]
    for bad in (parts[2].replace(b"Content-Length: ", b"Content-Length: 9", 1), parts[2].replace(b"text 2", b"tixt 2", 1)):
        got = list(warc.salvage(b"".join([whole(8), gzip.compress(b"".join([*parts[:2], bad, *parts[3:]])), whole(9)])))
        assert [r.get("record_id") for r in got] == ["urn:page:8", "urn:page:0", "urn:page:1", None, "urn:page:3", "urn:page:4", "urn:page:5", "urn:page:9"]
        gap = got[3]
        assert (gap["kind"], gap["offset"], gap["inner_offset"], gap["length"]) == ("gap", len(whole(8)), len(parts[0]) + len(parts[1]), len(bad))


def test_salvage_of_what_inflates_before_damage():
    r = random.Random(3)
    parts = [warc.record(f"urn:page:{i}", None, r.randbytes(3000), None) for i in range(60)]
    data = bytearray(gzip.compress(b"".join(parts)))
    cut = list(warc.salvage(bytes(data[: len(data) // 2])))
    assert 28 <= len(cut) - 1 <= 30 and [r["record_id"] for r in cut[:-1]] == [f"urn:page:{i}" for i in range(len(cut) - 1)]
    assert (cut[-1]["kind"], cut[-1]["reason"], cut[-1]["length"]) == ("gap", "truncated member", len(data) // 2)
    data[-6] ^= 1  # the CRC
    got = list(warc.salvage(bytes(data) + whole(99)))
    assert [r.get("record_id") for r in got] == [*(f"urn:page:{i}" for i in range(60)), None, "urn:page:99"]
    assert got[60]["kind"] == "gap" and all("incorrect" in r["reason"] for r in got[:60])
    bare = b"WARC/1.0\r\nContent-Length: 2\r\n\r\nok\r\n\r\n"
    got = list(warc.salvage(gzip.compress(bare + bare)[:-4]))
    assert [(r["kind"], r["reason"]) for r in got] == [("record", "truncated member")] * 2 + [("gap", "truncated member")]


def test_headers_of_any_length(spark):
    url = "data:text/html," + "x" * 200_000
    got = roundtrip(spark, [(1, url, "a", ""), (2, "u", "b", "")])
    assert {r["target_uri"] for r in got} == {url, "u"} and all(r["kind"] == "record" for r in got)
    assert [r["kind"] for r in warc.salvage(warc.record("urn:page:1", url, b"a", None))] == ["record"]
