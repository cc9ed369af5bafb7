"""WARC archives and their capture index, against plain dictionaries."""

import bisect
import gzip
import hashlib
import random

import pytest
from recforge.llm import queries, warc
from recforge.llm.common import local_path, scratch

SMALL = "/root/testdata/sf0.001"
DDL = "page_id bigint, url string, html string, k string, same int, key string, copies int, target string, file int"
COLUMNS = ["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"]
BIG, BIG2, LONG = "<p>é</p>" * 200, "<b>x</b>" * 125, "<i>long</i>" * 30000
PAGES = [
    (1, "http://a.example.com/x", BIG), (2, "https://b.example.com:8080/y?z=1#f", BIG), (9, "http://a.example.com/x", BIG), (9, "other", BIG),
    (3, None, None), (4, "", ""), (5, "http://user@HOST.org", "short"), (6, "http://host.org/", "short"), (7, "http://[::1]/p\tq r\n", BIG2),
    (7, "http://[::1]/p\tq r\n", BIG2), (7, "http://[::1]/p\tq r\n", BIG2), (None, "http://n.org/", BIG2), (None, None, BIG2),
    (11, "http://long.org/" + "a" * 3000, LONG), (12, "http://long.org/" + "a" * 3000, LONG), (-5, "http://10.0.0.1/é/漢字", "\r\n\r\nWARC/1.1\r\n"),
    (13, "http://long.org/" + "a" * 2999 + "b", "<i>" * 400), (14, "nonsense", "x" * 999), (15, "nonsense", "x" * 999), (16, "p", "x" * 1000),
    (17, "p", "x" * 1000),
]


def frame(spark, pages):
    return spark.createDataFrame([(*p, "k", 1, "key", None, "t", 2) for p in pages], DDL).repartition(3)


def plain(pages):
    """Rows of the query by its contract; of rows alike, one may be the response."""
    groups = {}
    for i, u, h in pages:
        raw = (h or "").encode()
        if len(raw) >= 1000:
            groups.setdefault(raw, []).append((i is not None, i or 0, u is not None, u or ""))
    taken, out = set(), []
    for i, u, h in pages:
        raw, own = (h or "").encode(), (i is not None, i or 0, u is not None, u or "")
        last = max(groups.get(raw, [own]))
        first = len(raw) < 1000 or (own == last and raw not in taken)
        if first and len(raw) >= 1000:
            taken.add(raw)
        out.append((i, len(raw), hashlib.sha1(raw).hexdigest(), "response" if first else "revisit",
                    None if first or not last[0] else last[1]))
    return sorted(out, key=repr)


@pytest.mark.parametrize("block,file_bytes", [(3000, 1 << 28), (1, 300), (2, 5000)])
def test_pages(spark, block, file_bytes):
    pages = frame(spark, PAGES)
    index = warc.write(pages, scratch(spark, "warc"), block=block, file_bytes=file_bytes)
    got = warc.read_pages(index, pages)
    assert got.columns == COLUMNS
    assert sorted((tuple(r) for r in got.collect()), key=repr) == plain(PAGES)


def test_random_access(spark):
    """Any page's record alone, from its URL and id; nothing for what isn't there."""
    pages = frame(spark, PAGES)
    index = warc.write(pages, scratch(spark, "warc"), block=2)
    wanted = spark.createDataFrame([("http://a.example.com/x#any", 9), ("http://HOST.org", 5), ("http://host.org", 6), ("zzz", 1), (None, 3)],
                                   "url string, page_id bigint")
    found = sorted((r.page_id, r.record_type, bytes(r.payload or b"").decode()) for r in warc.fetch(index, warc.locate(index, wanted)).collect())
    # page 9 is there twice with one payload; of these rows the one at "other" is the response
    assert found == [(3, "response", ""), (5, "response", "short"), (9, "revisit", "")]


def test_files_are_warc(spark):
    """Every member of an archive is a record by itself, and the whole file unpacks as records end to end."""
    import pathlib
    folder = scratch(spark, "warc")
    index = warc.write(frame(spark, PAGES), folder)
    kinds, captures = [], {r.file: [] for r in spark.read.parquet(f"{folder}/captures").collect()}
    for path in pathlib.Path(local_path(f"{folder}/archive")).glob("*.warc.gz"):
        raw = gzip.decompress(path.read_bytes())
        while raw:
            assert raw.startswith(b"WARC/1.1\r\n")
            head, _, rest = raw.partition(b"\r\n\r\n")
            fields = dict(x.split(b": ", 1) for x in head.split(b"\r\n")[1:])
            n = int(fields[b"Content-Length"])
            assert rest[n:n + 4] == b"\r\n\r\n"
            kinds.append(fields[b"WARC-Type"])
            raw = rest[n + 4:]
        assert path.name in captures
    assert kinds.count(b"warcinfo") == len(captures) and len(kinds) - len(captures) == len(PAGES)
    assert index.firsts == tuple(sorted(index.firsts))


def test_search_is_exact(spark):
    """Keys that repeat over blocks, keys between blocks, before the first and past the last."""
    rng = random.Random(4)
    urls = [f"http://{rng.choice('abc')}.org/{rng.randrange(30)}" for _ in range(400)]
    pages = spark.createDataFrame([(rng.randrange(6), u, f"{k} text") for k, u in enumerate(urls)], "page_id bigint, url string, html string")
    index = warc.write(pages.repartition(4), scratch(spark, "warc"), block=3)
    plain_rows = sorted((warc.url_key(r.url), r.page_id) for r in pages.collect())
    for host in "abcd":
        for n in range(-1, 31):
            for page in range(-1, 7):
                key = warc.url_key(f"http://{host}.org/{n}")
                n_plain = bisect.bisect_right(plain_rows, (key, page)) - bisect.bisect_left(plain_rows, (key, page))
                assert len(list(index.captures(key, page))) == n_plain


def test_url_keys():
    assert warc.url_key("https://www.Example.com:443/A/b?c=d#e") == "com,example,www)/A/b?c=d"
    assert warc.url_key("http://example.com:8080") == "com,example:8080)"
    assert warc.url_key("http://1.2.3.4/x") == "1.2.3.4)/x" and warc.url_key(None) == warc.url_key("") == ""
    assert warc.url_key("a\tb") == "a%09b)" and len(warc.url_key("x/" + "y" * 10000)) == warc.KEY_CHARS + 65


def test_empty(spark):
    pages = spark.createDataFrame([], DDL)
    index = warc.write(pages, scratch(spark, "warc"))
    assert not index.firsts and warc.read_pages(index, pages).collect() == []


def test_query(spark):
    pages = [(r.page_id, r.url, r.html) for r in spark.read.parquet(f"{SMALL}/pages.parquet").collect()]
    assert sorted((tuple(r) for r in queries.op12_warc(spark, SMALL).collect()), key=repr) == plain(pages)
