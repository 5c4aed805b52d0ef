"""URL filter against a plain search, WARC packages against the zipfile module and an exact round trip."""

import gzip
import hashlib
import io
import random
import re
import zipfile

import pytest

from opsgrain.llm import url_filter, warc
from opsgrain.llm.queries import URL_RULES

PAGES = "page_id bigint, url string, html string, host string, digest string"


def brute_verdict(url):
    """host, path, rule, verdict by plain string work."""
    host = path = ""
    if url and "://" in url:
        rest = url[url.index("://") + 3 :]
        cut = min([rest.index(c) for c in "/?#" if c in rest], default=len(rest))
        host, rest = rest[:cut], rest[cut:]
        path = re.split(r"[?#]", rest)[0]
        host = "".join(c.lower() if c.isascii() else c for c in host)
    best = None
    for what, rule in URL_RULES:
        h, _, p = rule.partition("/")
        if (host == h or host.endswith("." + h)) and path.startswith("/" + p) and (best is None or len(rule) > len(best[1])):
            best = (what, rule)
    low = "".join(c.lower() if c.isascii() else c for c in url or "")
    hit = lambda t: re.search(rf"(?<![a-z0-9]){re.escape(t.text)}(?![a-z0-9])", low) if t.whole else t.text in low
    bad = round(sum(t.weight for t in url_filter.VOCABULARY if hit(t)), 6) >= 1
    return host, path, best[1] if best else None, best[0] if best else "block" if bad else "allow"


URLS = [
    None, "", "no scheme/net/", "http://", "http://net", "http://net/", "http://NET/x", "http://a.net?x", "http://internet/", "https://Example.NET/en/1",
    "https://b.example.net/EN/1", "https://b.example.net/en", "http://example.com/de/", "http://xexample.com/de/casino", "http://a.org/fr/porn", "http://a.org/fr",
    "http://a.org/free/pills", "http://a.org/free-free", "http://a.org/freed/pillsy", "http://sex.a.com/", "http://essex.com/", "http://a.com/?q=sex1", "http://a.com/é\nxxx",
    "http://a.com/#cheap_win", "a://b://net/c", "http://u:p@a.com:80/adult-x", "http://a.com/" + "x" * 100_000 + "/casino", "http://a.com/İ/SEX",
]


def test_urls_match_brute_force(spark):
    rows = [(i, u, "h", "clash", "clash") for i, u in enumerate(URLS + URLS[:3])]
    got = {r.page_id: r for r in url_filter.filter_urls(spark.createDataFrame(rows, PAGES), URL_RULES).collect()}
    assert len(got) == len(rows)
    for i, u, *_ in rows:
        assert (got[i].host, got[i].path, got[i].rule, got[i].verdict) == brute_verdict(u), u
    assert url_filter.filter_urls(spark.createDataFrame([], PAGES), URL_RULES).count() == 0
    assert {r.verdict for r in url_filter.filter_urls(spark.createDataFrame(rows, PAGES), vocabulary=()).collect()} == {"allow"}


def test_weights_and_boundaries():
    clean = ["http://a.org/farm/free-range-eggs", "http://a.org/win/hot-chocolate", "http://a.org/adult-free-admission", "http://essex.org/track/popup-book", "http://a.org/pharmacy"]
    bad = ["http://onlineviagrashop.com", "http://a.com/nude-poker", "http://ads.a.com/popunder?affiliate=1", "http://a.com/SEX", "http://casino.a.org"]
    weight = lambda u: url_filter.term_hits(u)[2]
    assert all(weight(u) < 1 for u in clean) and all(weight(u) >= 1 for u in bad)
    own = (url_filter.Term("eggs", 0.6), url_filter.Term("farm", 0.4), url_filter.Term("milk", 2.0, whole=False))
    assert url_filter.term_hits(clean[0], own) == ([], ["eggs", "farm"], 1.0) and url_filter.term_hits("http://buttermilky", own)[0] == ["milk"]
    assert len({t.text for t in url_filter.VOCABULARY}) == len(url_filter.VOCABULARY)


def test_a_term_has_one_weight(spark):
    with pytest.raises(ValueError):
        url_filter.filter_urls(spark.createDataFrame([], PAGES), vocabulary=url_filter.terms("a a", 1.0))


def test_longest_rule_wins(spark):
    page = spark.createDataFrame([(1, "http://a.example.net/en/x", "", "", "")], PAGES)
    for rules in (URL_RULES, URL_RULES[::-1]):
        assert url_filter.filter_urls(page, rules).first()[3] == "example.net/en/"


class Stream(io.BytesIO):
    def seek(self, *_):
        raise OSError("a stream")


def package(members):
    out = Stream()
    writer = warc.PackageWriter(out)
    for name, parts in members:
        writer.begin(name)
        for p in parts:
            writer.add(p)
        writer.end()
    writer.close()
    return out.getvalue()


def reader(raw):
    return lambda at, n: raw[at : at + n]


def test_packages_are_zip_files():
    raw = package([("archive/data.warc", [b"one", b"two"]), ("indexes/é.cdxj", [b""]), ("x", [b"z" * 70_000])])
    with zipfile.ZipFile(io.BytesIO(raw)) as z:
        assert z.testzip() is None and z.namelist() == ["archive/data.warc", "indexes/é.cdxj", "x"]
        assert z.read("archive/data.warc") == b"onetwo"
    members = warc.directory(reader(raw), len(raw))
    assert [(m.name, m.size) for m in members] == [("archive/data.warc", 6), ("indexes/é.cdxj", 0), ("x", 70_000)]
    at = warc.data_offset(reader(raw), members[0])
    assert raw[at : at + 6] == b"onetwo"


@pytest.mark.parametrize("comment", [b"", b"a comment with PK\x05\x06 inside " + b"." * 30_000])
def test_other_writers_packages_are_read(comment):
    out = io.BytesIO()
    with zipfile.ZipFile(out, "w", zipfile.ZIP_STORED) as z:
        z.writestr("a", b"first")
        with z.open("b", "w", force_zip64=True) as f:
            f.write(b"second")
        z.writestr("c", b"packed" * 100, zipfile.ZIP_DEFLATED)
        z.comment = comment
    raw = out.getvalue()
    a, b, c = warc.directory(reader(raw), len(raw))
    for m, want in ((a, b"first"), (b, b"second")):
        at = warc.data_offset(reader(raw), m)
        assert raw[at : at + m.size] == want
    with pytest.raises(ValueError):
        warc.data_offset(reader(raw), c)
    with pytest.raises(ValueError):
        warc.directory(reader(b"no package"), 10)


def test_archives_round_trip(spark):
    rng = random.Random(4)
    big, bodies = "é" * 400_000, ["x" * 99, "y" * 100, "é" * 50, "<p>\r\n\r\nWARC/1.1\r\n\r\n</p>" * 10, None, ""]
    html = {i: rng.choice(bodies) for i in range(10, 80)} | {3: big, 99: big, 100: f"only {big}"}
    rows = [(i, None if i % 7 == 0 else f"http://a/\n{i}", h, "clash", "clash") for i, h in html.items()]
    rows += [(None, "http://none", "y" * 100, "", ""), (None, "http://none", "z" * 200, "", ""), (None, "http://none", "z" * 200, "", "")]
    packages = warc.write_archives(spark.createDataFrame(rows, PAGES).repartition(3))
    assert packages.agg({"records": "sum"}).first()[0] == len(rows)
    got = [r for r in warc.read_archives(packages).collect()]
    assert len(got) == len(rows)
    for r in (r for r in got if r.page_id is not None):
        raw = (html[r.page_id] or "").encode()
        same = [j for j, h in html.items() if (h or "").encode() == raw]
        revisit = len(raw) >= 100 and min(same) != r.page_id
        want = (len(raw), hashlib.sha256(raw).hexdigest(), "revisit" if revisit else "response", min(same) if revisit else None)
        assert (r.payload_bytes, r.payload_digest, r.record_type, r.refers_to) == want
    nulls = sorted((r.record_type, r.payload_bytes) for r in got if r.page_id is None)
    assert nulls == [("response", 200), ("response", 200), ("revisit", 100)]
    payloads = {r.page_id: bytes(r.payload).decode() for r in warc.read_records(warc.locate(packages)).collect() if r.page_id in (3, 100)}
    assert payloads == {3: big, 100: f"only {big}"}


def test_archives_of_an_empty_table(spark):
    packages = warc.write_archives(spark.createDataFrame([], PAGES))
    assert packages.count() == 0 and warc.read_archives(packages).count() == 0


def gz(*records):
    return [gzip.compress(r) for r in records]


def warc_record(kind, ident, body, http=True, **more):
    block = (b"HTTP/1.1 200 OK\r\nX: y\r\n\r\n" if http else b"") + body
    head = {"WARC-Type": kind, "WARC-Record-ID": ident, "WARC-Target-URI": "http://a/b", "Content-Type": "application/http; msgtype=response" if http else "text/plain"}
    head |= {k.replace("_", "-"): v for k, v in more.items()} | {"Content-Length": str(len(block))}
    return b"WARC/1.0\r\n" + "".join(f"{k}: {v}\r\n" for k, v in head.items()).encode() + b"\r\n" + block + b"\r\n\r\n"


@pytest.mark.parametrize("index", ["cdxj", "gz", "none", "plain"])
def test_foreign_packages_are_read(spark, tmp_path, index):
    """Indexes of key, time and JSON, compressed or not, with numbers as text; record ids as text; archives that no index names."""
    bodies = [b"a" * 50, b"b" * 3_000_000, b"", b"c\r\n\r\nWARC/1.0\r\n"]
    records = [warc_record("response", f"<urn:uuid:{i}>", b) for i, b in enumerate(bodies)]
    records.insert(0, warc_record("warcinfo", "<urn:uuid:info>", b"software: x\r\n", http=False))
    records.append(warc_record("revisit", "<urn:uuid:9>", b"", WARC_Refers_To="<urn:uuid:1>", WARC_Payload_Digest="sha1:ABC"))
    parts, name = (records, "archive/x.warc") if index == "plain" else (gz(*records), "archive/x.warc.gz")
    at, lines = 0, ["!meta {}", ""]
    for i, part in enumerate(parts):
        lines.append(f'com,a)/b 20240101000000 {{"url": "http://a/b", "filename": "x.warc.gz", "offset": "{at}", "length": "{len(part)}"}}')
        at += len(part)
    text = "\n".join(lines).encode()
    members = [(name, parts), ("pages/pages.jsonl", [b"{}"])]
    if index == "cdxj":
        members.append(("indexes/index.cdxj", [text]))
    elif index == "gz":
        members.append(("indexes/index.cdx.gz", [gzip.compress(text[:100]), gzip.compress(text[100:])]))
    path = tmp_path / "p.wacz"
    path.write_bytes(package(members))
    found = warc.read_records(warc.locate(spark.createDataFrame([(str(path),)], "path string"))).collect()
    got = sorted((r.record_id, r.record_type, r.page_id, None if r.payload is None else bytes(r.payload)) for r in found)
    want = [(f"<urn:uuid:{i}>", "response", None, b) for i, b in enumerate(bodies)]
    assert got == sorted([*want, ("<urn:uuid:9>", "revisit", None, None), ("<urn:uuid:info>", "warcinfo", None, b"software: x\r\n")])
    digests = {r.record_id: r.digest for r in found}
    assert digests["<urn:uuid:0>"] == hashlib.sha256(bodies[0]).hexdigest() and digests["<urn:uuid:9>"] == "sha1:ABC"
    assert {r.record_id: r.refers_id for r in found}["<urn:uuid:9>"] == "<urn:uuid:1>"


def test_broken_archives_are_told(spark, tmp_path):
    path = tmp_path / "p.zip"
    path.write_bytes(package([("archive/x.warc.gz", [gz(warc_record("response", "<a>", b"x" * 9999))[0][:-20]])]))
    with pytest.raises(Exception, match="cut"):
        warc.locate(spark.createDataFrame([(str(path),)], "path string")).collect()
