"""WARC derivatives: an independent parser as reference, broken pages, headers, encodings, real files."""

import gzip
import hashlib
import time
import zlib
from html.parser import HTMLParser

import pytest

from eventlens.llm import packing, warc

DATA = "/root/testdata/sf0.001"


class Reader(HTMLParser):
    """Visible text by the standard library's parser, for well-formed pages."""

    def __init__(self, page):
        super().__init__(convert_charrefs=True)
        self.out, self.hidden, self.title, self.lang, self.links, self.inside = [], 0, None, None, {}, False
        self.feed(page)
        self.close()

    def handle_starttag(self, tag, attrs):
        attrs = dict(reversed(attrs))
        self.lang = self.lang or (attrs.get("lang") if tag == "html" else None)
        if tag == "a" and not self.hidden and (attrs.get("href") or "").split():
            self.links[" ".join(attrs["href"].split())] = None
        self.inside = tag == "title"
        if self.inside and self.title is None:
            self.title = ""
        if tag in ("p", "div", "li", "ul", "h1", "h2", "h3", "br", "tr", "table", "body", "html", "nav", "footer", "header", "main", "section", "article"):
            self.out.append("\n")
        self.out.append(" " if tag in ("td", "th") else "")
        self.hidden += tag in ("script", "style", "noscript", "template", "svg", "head")

    def handle_endtag(self, tag):
        self.inside = False
        self.hidden -= tag in ("script", "style", "noscript", "template", "svg", "head")
        self.handle_starttag(tag, []) if tag not in ("script", "style", "noscript", "template", "svg", "head", "title", "a") else None

    def handle_data(self, data):
        if self.inside:
            self.title += data
        elif not self.hidden:
            self.out.append(data)

    def text(self):
        lines = (" ".join(x.replace("\xa0", " ").split()) for x in "".join(self.out).split("\n"))
        return "\n".join(x for x in lines if x)


def test_query_against_an_independent_parser(spark):
    pages = {r.page_id: r for r in spark.read.parquet(f"{DATA}/pages.parquet").collect()}
    got = warc.op10_warc_derivatives(spark, DATA).collect()
    assert len(got) == 2 * len(pages) and len({r.record_id for r in got}) == len(got)
    for r in got:
        page = pages[r.page_id]
        reader = Reader(page.html or "")
        payload = warc.digest((page.html or "").encode())
        assert r.source_payload_digest == payload and r.target_uri == page.url
        assert r.refers_to == warc.record_id("response", page.url, payload)
        if r.warc_type == "conversion":
            want = reader.text().encode()
        else:
            title = [] if reader.title is None else [("title", " ".join(reader.title.split()))]
            named = title + ([("language", reader.lang)] if reader.lang else []) + [("outlink", x) for x in reader.links]
            named += [("http-content-type", "text/html; charset=utf-8"), ("http-content-length", str(len((page.html or "").encode())))]
            named += [("conversion", warc.record_id("conversion", r.refers_to))]
            want = "".join(f"{k}: {v}\r\n" for k, v in named).encode()
        assert r.block_sha256 == hashlib.sha256(want).hexdigest() and r.content_length == len(want) and r.block_digest == warc.digest(want)


@pytest.mark.parametrize("page,text", [
    ("<p>5 <6 and x<y and z</p>", "5 <6 and x<y and z"), ("<td>a</td><td>b</td>", "a b"), ("a<script>var x = '<p>';", "a"), ("a<!-- b", "a"),
    ("<head><title>t</title><body>b", "b"), ("<svg><p>x</p></svg>y", "y"), ("a<br/>b<br>c", "a\nb\nc"), ("<a title='>'>t</a> &lt;", "t <"),
    ("<a title='>t</a>", "t"), ("<x-y>k</x-y><-", "k<-"), ("<p", "<p"), ("", ""), ("\u0130<SCRIPT>x</SCRIPT\n>y", "\u0130y"), ("<textarea><b></textarea>", "<b>")])
def test_text_of_small_pages(page, text):
    assert warc.visible_text(page) == text


@pytest.mark.parametrize("part", ["<svg ", "<script>", "<!--", "<p \"", "<p '\"", "<a href=\"x ", "<", "</p", "<svg>", "</svg><svg>", "<a b ", "&", "<title>", "<!", "<a b='"])
def test_broken_pages_take_linear_time(part):
    page = part * (600_000 // len(part))
    start = time.process_time()
    warc.visible_text(page)
    warc.fields(page)
    assert time.process_time() - start < 8


def response(headers, payload, http):
    block = b"HTTP/1.1 200 OK\r\n" + "".join(f"{k}: {v}\r\n" for k, v in http).encode() + b"\r\n" + payload
    return [{"name": k, "value": v} for k, v in [("WARC-Type", "response"), ("WARC-Record-ID", "<urn:x>"), *headers, ("Content-Length", str(len(block)))]], block


def test_source_headers_charset_and_encodings():
    page = "<html lang=fr><p>déjà vu</p>"
    named = [("WARC-Target-URI", "http://x/"), ("WARC-IP-Address", "10.0.0.1"), ("WARC-Warcinfo-ID", "<urn:w>"), ("WARC-Date", "2024-01-01T00:00:00Z")]
    raw = page.encode("latin-1")
    squeezed = gzip.compress(raw)
    chunked = b"".join(b"%x\r\n" % len(c) + c + b"\r\n" for c in (squeezed[:7], squeezed[7:])) + b"0\r\n\r\n"
    for payload, http in ((raw, []), (squeezed, [("Content-Encoding", "gzip")]), (chunked, [("Content-Encoding", "gzip"), ("Transfer-Encoding", "chunked")]),
                          (zlib.compress(raw), [("Content-Encoding", "deflate")])):
        headers, block = response(named, payload, [("Content-Type", "text/html; charset=ISO-8859-1"), ("Server", "s"), *http])
        meta, conv = warc.derivatives("<urn:x>", headers, block)
        assert conv["block"].decode() == "déjà vu" and b"http-server: s\r\n" in meta["block"] and b"language: fr" in meta["block"]
        for r in (meta, conv):
            by = {h["name"]: h["value"] for h in r["headers"]}
            assert {k: by[k] for k, _ in named} == dict(named) and by["WARC-Refers-To"] == "<urn:x>"
            assert by["WARC-Source-Payload-Digest"] == warc.digest(payload) and by["WARC-Source-Block-Digest"] == warc.digest(block)
    headers, block = response(named, b"\xff\xfe<p>x", [("Content-Type", "text/html; charset=no-such"), ("Content-Encoding", "gzip")])
    assert warc.derivatives("<urn:x>", headers, block)[1]["block"].decode().endswith("x")


def test_real_files(spark, tmp_path):
    rows = warc.responses(spark.read.parquet(f"{DATA}/pages.parquet").limit(30)).collect()
    stored = [warc.serialize([h.asDict() for h in r.headers], bytes(r.block)) for r in rows]
    (tmp_path / "sub").mkdir()
    (tmp_path / "a.warc.gz").write_bytes(b"".join(gzip.compress(x) for x in stored[:20]))
    (tmp_path / "sub" / "b.warc").write_bytes(b"".join(stored[20:]))
    (tmp_path / "c.warc.gz").write_bytes(gzip.compress(stored[0])[:-30])  # cut off
    (tmp_path / "d.txt").write_bytes(b"no archive")
    got = warc.read_files(spark, str(tmp_path)).collect()
    assert sorted((r.record_id, bytes(r.block)) for r in got) == sorted((r.record_id, bytes(r.block)) for r in rows)


def test_clashing_columns(spark):
    pages = spark.createDataFrame([(1, "u", "<p>x</p>", "r", "b", "h")], "page_id long, url string, html string, record_id string, block string, headers string")
    assert {r.warc_type for r in warc.derive(warc.responses(pages)).collect()} == {"metadata", "conversion"}


def test_cheapest_sequence_with_room_is_taken_however_many_are_cheaper():
    """Against a plain search over all sequences."""
    import random

    def plain(lengths, size, linear, quadratic):
        full = sum(lengths) // size
        room, cost, held, tail = [size] * full, [0.0] * full, [[] for _ in range(full)], []
        for item in sorted(range(len(lengths)), key=lambda i: (-lengths[i], i)):
            start, left = 0, lengths[item]
            while left:
                fit = [s for s in range(full) if room[s] >= left] or [s for s in range(full) if room[s]]
                if not fit:
                    tail.append((item, start, left))
                    break
                s = min(fit, key=lambda s: (cost[s], s))
                n = min(left, room[s])
                held[s].append((item, start, n))
                room[s], cost[s] = room[s] - n, cost[s] + linear * n + quadratic * n * n
                start, left = start + n, left - n
        return held

    for seed in range(60):
        r = random.Random(seed)
        lengths = [r.choice([r.randint(1, 63), r.randint(40, 63), 1]) for _ in range(r.randint(0, 150))]
        want = plain(lengths, 64, 1.0, 1 / 64)
        assert packing.balance(lengths, 64, 1.0, 1 / 64)[:len(want)] == want
