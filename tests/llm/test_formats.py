import gzip
import random
from collections import defaultdict

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from casemill.llm import chat, warc
from tests.llm.helpers import frame

PAGES = "page_id long, url string, html string"


def pages():
    rows = [(i, f"http://h{i}.example/é", f"<p>{i % 7}</p>" * (i % 7 * 50 + 1)) for i in range(40)]
    return [*rows, (41, None, None), (42, "http://a\r\nb", ""), (39, "dup", rows[39][2]), (None, "n", "alone"), (None, "n", rows[3][2]), (43, "http://big", "x\r\n\r\ny" * 200000)]


def expected(rows, least=0):
    groups = defaultdict(list)
    for i, _, h in rows:
        if len((h or "").encode()) >= least:
            groups[h or ""].append(-1 if i is None else i)
    out = []
    for i, _, h in rows:
        data = (h or "").encode()
        top = max(groups[h or ""], default=None) if len(data) >= least else None
        other = top is not None and top >= 0 and top != i
        out.append((i, len(data), warc.sha1_base32(data), "revisit" if other else "response", top if other else None, None if other else data))
    return sorted(out, key=str)


def test_archive(spark, tmp_path):
    rows = pages()
    for least in (0, 200):
        path = warc.write_warc(spark.createDataFrame(rows, PAGES).repartition(3), str(tmp_path / f"w{least}"), min_revisit_bytes=least)
        got = warc.read_warc(spark, path).collect()
        assert sorted(((x.page_id, x.payload_bytes, x.payload_digest, x.record_type, x.refers_to, None if x.payload is None else bytes(x.payload)) for x in got), key=str) == expected(rows, least)
    assert {x.url for x in got} >= {"http://a b", "http://h3.example/é", None}


def test_pushdown(spark, tmp_path):
    path = warc.write_warc(spark.createDataFrame(pages(), PAGES), str(tmp_path / "w"))
    df = warc.read_warc(spark, path)
    some = df.where((F.col("record_type") == "revisit") & F.col("page_id").isin(1, 2, 3))
    assert {x.page_id for x in some.collect()} == {1, 2, 3}
    assert df.where("payload_bytes > 1000 and page_id is not null and url is not null").count() > 0
    reader = warc.WarcReader({"path": path})
    from pyspark.sql.datasource import EqualTo, StringContains

    left = list(reader.pushFilters([EqualTo(("record_type",), "response"), StringContains(("url",), "h")]))
    assert len(left) == 1 and reader.tests == [("record_type", "eq", "response")]
    stats = {}
    data = b"".join(warc.member(warc.record_bytes(type("R", (), dict(page_id=i, url="u", record_type="response", payload_digest="D", payload_bytes=9, refers_to=None, payload=b"p" * 100000)))) for i in range(5))
    rows = list(warc.records(opened(data), lambda r: r["page_id"] == 3, True, stats))
    assert len(rows) == 1 and stats["decoded"] == 1 and rows[0]["payload"] == b"p" * 100000


def opened(data):
    return pa.BufferReader(data)


def record(i, payload, **more):
    row = dict(page_id=i, url="u", record_type="response", payload_digest="D", payload_bytes=len(payload), refers_to=None, payload=payload) | more
    return warc.record_bytes(type("R", (), row))


def test_other_writers_and_gzip():
    one = record(1, b"abc")
    assert gzip.decompress(warc.member(one) * 2) == one * 2
    for data in (gzip.compress(one) + warc.member(one), gzip.compress(one + one), one + one, b"\r\n" + one + b"\r\n\r\n" + one):
        assert [r["payload"] for r in warc.records(opened(data))] == [b"abc", b"abc"]
        assert [r["payload"] for r in warc.records(opened(data), payload=False)] == [None, None]
        assert list(warc.records(opened(data), lambda r: False)) == []


def test_records_that_are_broken():
    one = record(1, b"abc" * 50000)
    for data in (gzip.compress(one)[:-9], warc.member(one)[:-200], one[:-9000], b"no headers", gzip.compress(b"nothing here")):
        for payload in (True, False):
            with pytest.raises(ValueError):
                list(warc.records(opened(data), payload=payload))
    assert list(warc.records(opened(b""))) == []


def test_payloads_are_passed_over():
    """With sl, or in a plain file, only the headers are read; without, time and memory stay in proportion."""
    rng = random.Random(1)
    big = [record(i, rng.randbytes(300_000)) for i in range(20)]
    for data in (b"".join(map(warc.member, big)), b"".join(big)):
        stats = {}
        assert len(list(warc.records(opened(data), payload=False, stats=stats))) == 20
        assert stats["read_bytes"] < len(data) / 3 and "decoded" not in stats
    small = b"".join(gzip.compress(record(i, b"x" * 500)) for i in range(20_000))
    stats = {}
    assert sum(len(r["payload"]) for r in warc.records(opened(small), stats=stats)) == 500 * 20_000
    assert stats["read_bytes"] == len(small)


def test_folder_of_other_writers(spark, tmp_path):
    """Plain and compressed files without a manifest, with records of all types; also a single file."""
    info = b"WARC/1.0\r\nWARC-Type: warcinfo\r\nWARC-Record-ID: <urn:uuid:1-2>\r\nContent-Type: application/warc-fields\r\nContent-Length: 9\r\n\r\nsoft: 1\r\n\r\n\r\n"
    page = "WARC/1.0\r\nWARC-Type: response\r\nWARC-Target-URI: http://a/\r\nWARC-Payload-Digest: sha1:ABC\r\nWARC-Record-ID: <urn:uuid:1-3>\r\nContent-Type: application/http; msgtype=response\r\nContent-Length: 26\r\n\r\nHTTP/1.1 200 OK\r\n\r\n<p>é</p".encode()
    page = page.replace(b"Content-Length: 26", b"Content-Length: " + str(len(page.split(b"\r\n\r\n", 1)[1])).encode()) + b"\r\n\r\n"
    res = b"WARC/1.0\r\nWARC-Type: resource\r\nWARC-Target-URI: file:x\r\nContent-Type: text/plain\r\nContent-Length: 4\r\n\r\nbody\r\n\r\n"
    (tmp_path / "a" / "b").mkdir(parents=True)
    (tmp_path / "a" / "one.warc").write_bytes(info + page + res)
    (tmp_path / "a" / "b" / "two.warc.gz").write_bytes(b"".join(map(gzip.compress, (info, page, res))))
    (tmp_path / "a" / "readme.txt").write_text("no archive")
    got = sorted(((x.record_type, x.url, x.payload_digest, x.payload_bytes, x.page_id, x.payload and bytes(x.payload)) for x in warc.read_warc(spark, str(tmp_path / "a")).collect()), key=str)
    want = [("resource", "file:x", None, 4, None, b"body"), ("response", "http://a/", "ABC", None, None, "<p>é</p".encode()), ("warcinfo", None, None, 9, None, None)]
    assert got == sorted([*want, *want], key=str)
    one = warc.read_warc(spark, str(tmp_path / "a" / "one.warc"))
    assert one.where("payload_bytes = 4").count() == 1 and one.count() == 3
    with pytest.raises(Exception, match="another writer"):
        warc.write_warc(spark.createDataFrame(pages(), PAGES), str(tmp_path / "a"))


def test_second_writes(spark, tmp_path):
    put = lambda i, mode: warc.write_warc(spark.createDataFrame([(i, "u", f"<p>{i}</p>")], PAGES).selectExpr("*", "'x' as payload", "1 as _last"), str(tmp_path / "w"), mode=mode)
    ids = lambda: sorted(x.page_id for x in warc.read_warc(spark, str(tmp_path / "w")).collect())
    put(1, "append")
    put(2, "append")
    assert ids() == [1, 2]
    put(3, "overwrite")
    assert ids() == [3] and len(list((tmp_path / "w").glob("*.warc.gz"))) == 1


def test_empty_archive(spark):
    path = warc.write_warc(spark.createDataFrame([], PAGES))
    assert warc.read_warc(spark, path).count() == 0


TURNS = "conv_id long, turn long, role string, text string"


def plain(rows):
    by = defaultdict(list)
    for c, t, r, x in rows:
        if c is not None:
            by[c].append((t is not None, t or 0, r or "", x or ""))
    out = {}
    for p in {c // 2 for c in by}:
        a, b = ([x[2:] for x in sorted(by.get(c, []))] for c in (2 * p, 2 * p + 1))
        n = next((i for i, (x, y) in enumerate(zip(a, b, strict=False)) if x != y), min(len(a), len(b)))
        show = lambda ts: "".join(f"<|{r}|>\n{x}\n" for r, x in ts)

        def mask(ts):
            at, spans = 0, []
            for r, x in ts:
                start = at + len(r) + 5
                at = start + len(x) + 1
                if r == "assistant":
                    spans.append((start, at))
            return spans

        out[p] = (n, show(a[:n]), show(a[n:]), show(b[n:]), mask(a[n:]), mask(b[n:]))
    return out


def test_preferences(spark):
    rows = [
        (0, 0, "user", "hé"), (0, 1, "assistant", "good"), (0, 2, "user", "more"), (0, 3, "assistant", ""), (1, 0, "user", "hé"), (1, 1, "assistant", "bad"),
        (2, 0, "user", "q"), (3, 0, "user", "q"), (4, 1, "assistant", "a"), (4, 0, "system", "s"), (6, 0, None, None), (7, 0, "user", "z"), (None, 0, "user", "lost"),
        (8, None, "user", "u"), (8, 0, "assistant", "v"), (9, None, "user", "u"), (9, 0, "assistant", "v"), (9, 0, "assistant", "v"), (11, 0, "user", "only rejected"),
        *[(12, t, "user" if t % 2 else "assistant", "long " * 300) for t in range(50)], *[(13, t, "user" if t % 2 else "assistant", "long " * (300 if t < 49 else 2)) for t in range(50)],
    ]
    turns = spark.createDataFrame(rows, TURNS).selectExpr("*", "1 as pair_id", "2 as prompt").repartition(3)
    got = chat.preference_pairs(turns, F.floor(F.col("conv_id") / 2), F.pmod(F.col("conv_id"), F.lit(2)))
    mask = lambda s: [(x.start, x.end) for x in s]
    assert {x.pair_id: (x.n_prompt_turns, x.prompt, x.chosen, x.rejected, mask(x.chosen_mask), mask(x.rejected_mask)) for x in got.collect()} == plain(rows)
    assert chat.preference_pairs(spark.createDataFrame([], TURNS), F.col("conv_id"), F.lit(0)).count() == 0
