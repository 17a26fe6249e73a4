"""WARC derivative builder: responses to linked metadata and conversion records.

``responses`` renders captured pages as WARC/1.1 response records. For every
response, ``derive`` makes a ``metadata`` record (``application/warc-fields``:
title, declared language, out-links) and a ``conversion`` record
(``text/plain``: the visible text). Both name the response in WARC-Refers-To,
keep its named headers (target URI, date, IP address, warcinfo and others), its
block and payload digests as ``WARC-Source-*``, and carry digests of their own;
the HTTP headers are fields of the metadata. The payload is freed of transfer
and content encodings and read in its declared charset.
Ids are name-based UUIDs of the content, so a task that runs again, or a
repeated capture, gives the same ids. Everything is row by row: no shuffle.

``write`` stores records as WARC files (each record a gzip member of its own)
through Spark's writers; ``read`` parses such files again. A file holds at most
``records_per_file`` records, which bounds what a reader holds. ``read_files``
reads ``.warc`` and ``.warc.gz`` files as they are.

A page is scanned once, from left to right, in linear time however broken it
is: comments, scripts and hidden elements that are never closed hide the rest,
quotes that are never closed are characters, and ``<`` begins a tag only before
the name of an HTML element (or one with a hyphen).

Defined results: a null page body reads as empty, a null URL as ``about:blank``;
empty bodies give empty conversion blocks with the digest of nothing; repeated
rows give equal records; very long pages are scanned whole; an unknown charset reads as UTF-8, an
encoding that does not decode stays as it is; other columns, also of clashing names, are ignored; an empty table gives none.
"""

from __future__ import annotations

import base64
import gzip
import hashlib
import html
import io
import re
import uuid
import zlib

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from eventlens.llm.common import per_task, small_batches, table

SCHEMA = "warc_type string, record_id string, headers array<struct<name:string,value:string>>, block binary"
_ARROW = [("warc_type", pa.string()), ("record_id", pa.string()),
          ("headers", pa.list_(pa.struct([("name", pa.string()), ("value", pa.string())]))), ("block", pa.binary())]
_SPACE_ID = uuid.uuid5(uuid.NAMESPACE_URL, "urn:warc:records")

# Names of HTML elements, by what they do to the text.
_BLOCK = frozenset("""address article aside blockquote body br caption dd details dialog div dl dt fieldset figcaption figure footer form
 h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu nav ol optgroup option p pre search section summary table tbody tfoot
 thead tr ul""".split())
_CELL = frozenset(("td", "th"))
_RAW = frozenset(("script", "style", "title", "textarea"))
_HIDDEN = frozenset(("script", "style", "noscript", "template", "svg", "head"))
_INLINE = frozenset("""a abbr area audio b base bdi bdo big button canvas center cite code col colgroup data datalist del dfn em embed
 font frame frameset i iframe img input ins kbd label link map mark math meta meter noframes object output param picture progress q rp
 rt ruby s samp select slot small source span strike strong sub sup time track tt u var video wbr""".split())
_ELEMENTS = _BLOCK | _CELL | _RAW | _HIDDEN | _INLINE
_NAME = re.compile(r"[A-Za-z][^\s/>]*")
_STOP = re.compile(r"[>\"']")
_ATTRIBUTE = re.compile(r"([^\s\"'>/=]+)\s*(?:=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+)))?")
_BLANKS = re.compile(r"[ \t\r\f\v\xa0]+")
_LOWER_CASE = {c: c + 32 for c in range(0x41, 0x5B)}


def scan(body: str):
    """The page as (kind, name, text): ``text``, ``raw`` (content of a script, style, title or text area), ``start`` (with
    the tag's inside) and ``end``."""
    at, held, size = 0, 0, len(body)
    low = body.lower()
    if len(low) != size or "\u212a" in body:  # some characters become two, the Kelvin sign a Latin letter
        low = body.translate(_LOWER_CASE)
    lost: set[str] = set()  # quotes that do not occur any more

    def tag_end(at: int) -> int:
        """Place of the ``>`` outside quotes; -1 if there is none."""
        while m := _STOP.search(body, at):
            at = m.end()
            if m[0] == ">":
                return m.start()
            if m[0] not in lost:
                close = body.find(m[0], at)
                if close < 0:
                    lost.add(m[0])
                else:
                    at = close + 1
        return -1

    open_end = False  # no tag ends after here
    while at < size:
        lt = body.find("<", at)
        if lt < 0:
            break
        if body.startswith("<!--", lt):
            stop = body.find("-->", lt + 4)
            stop = size if stop < 0 else stop + 3
        elif body.startswith(("<!", "<?"), lt):
            stop = body.find(">", lt)
            stop = size if stop < 0 else stop + 1
        else:
            end = body.startswith("</", lt)
            m = _NAME.match(low, lt + 1 + end, lt + 66)
            name = m[0] if m else ""
            if open_end or not (name in _ELEMENTS or "-" in name.strip("-")):
                at = lt + 1
                continue
            close = body.find(">", m.end())
            inside = body[m.end():close]
            if close < 0 or '"' in inside or "'" in inside:
                close = tag_end(m.end())
            if close < 0:
                open_end = True
                at = lt + 1
                continue
            if held < lt:
                yield "text", "", body[held:lt]
            at = held = close + 1
            yield ("end" if end else "start"), name, body[m.end():close]
            if not end and name in _RAW:
                stop = low.find(f"</{name}", at)
                stop = size if stop < 0 else stop
                yield "raw", name, body[at:stop]
                at = held = stop
            continue
        if held < lt:
            yield "text", "", body[held:lt]
        at = held = stop
    if held < size:
        yield "text", "", body[held:]


def _shown(body: str):
    """``scan`` with whether the place is visible: outside scripts, styles, head and the like."""
    hidden: dict[str, int] = {}
    depth = 0
    for kind, name, text in scan(body):
        if kind == "start" and name == "body" and depth == hidden.get("head", 0):
            hidden, depth = {}, 0  # a head that was never closed
        yield kind, name, text, not depth and not (kind == "raw" and name != "textarea")
        if name in _HIDDEN and kind == "start" and not text.endswith("/"):
            hidden[name] = hidden.get(name, 0) + 1
            depth += 1
        elif kind == "end" and hidden.get(name):
            hidden[name] -= 1
            depth -= 1


def digest(block: bytes) -> str:
    return "sha1:" + base64.b32encode(hashlib.sha1(block).digest()).decode()


def record_id(*parts: str) -> str:
    return f"<urn:uuid:{uuid.uuid5(_SPACE_ID, chr(0).join(parts))}>"


def attributes(inside: str) -> dict[str, str]:
    """Attributes of a tag, the first of each name."""
    out: dict[str, str] = {}
    for name, a, b, c in _ATTRIBUTE.findall(inside):
        out.setdefault(name.lower(), html.unescape(a or b or c))
    return out


def page(body: str) -> tuple[str, list[tuple[str, str]]]:
    """Visible text and metadata of a page, from one scan.

    The text has no scripts, styles, head or comments; one line per block element, a blank between cells. Metadata
    are the title, the declared language and the out-links in order, each once.
    """
    out, title, language = [], None, None
    links: dict[str, None] = {}
    for kind, name, text, shown in _shown(body):
        if kind == "text":
            if shown:
                out.append(text)
            continue
        if kind == "raw":
            if shown:
                out.append(text)
            elif name == "title" and title is None:
                title = " ".join(html.unescape(text).split())
            continue
        if name in _BLOCK:
            out.append("\n")
        elif name in _CELL:
            out.append(" ")
        if kind == "start":
            if name == "a":
                if shown and (link := " ".join(attributes(text).get("href", "").split())):
                    links[link] = None
            elif name == "html" and language is None:
                language = attributes(text).get("lang")
    named = [] if title is None else [("title", title)]
    named += ([("language", language)] if language else []) + [("outlink", x) for x in links]
    # A part is unescaped by itself: an entity does not go on across a tag.
    plain = "".join(html.unescape(x) if "&" in x else x for x in out)
    return "\n".join(x for line in _BLANKS.sub(" ", plain).split("\n") if (x := line.strip())), named


def visible_text(body: str) -> str:
    return page(body)[0]


def fields(body: str) -> list[tuple[str, str]]:
    return page(body)[1]


def http_message(block: bytes) -> tuple[list[tuple[str, str]], bytes]:
    """HTTP headers of a response block (folded lines joined), and its payload as transferred."""
    head, _, payload = block.partition(b"\r\n\r\n")
    lines = re.sub(r"\r\n[ \t]+", " ", head.decode("latin-1")).split("\r\n")[1:]
    return [(k.strip(), v.strip()) for k, colon, v in (x.partition(":") for x in lines) if colon], payload


def _unchunked(raw: bytes) -> bytes:
    out, at = [], 0
    while (end := raw.find(b"\r\n", at)) >= 0:
        n = int(raw[at:end].split(b";")[0], 16)
        if n == 0:
            break
        out.append(raw[end + 2:end + 2 + n])
        at = end + 2 + n + 2
    return b"".join(out)


def page_text(block: bytes) -> str:
    """The page of a response block: without transfer and content encodings, in its charset."""
    headers, payload = http_message(block)
    by = {k.lower(): v.lower() for k, v in reversed(headers)}
    try:
        if "chunked" in by.get("transfer-encoding", ""):
            payload = _unchunked(payload)
        if "gzip" in by.get("content-encoding", ""):
            payload = gzip.decompress(payload)
        elif "deflate" in by.get("content-encoding", ""):
            payload = zlib.decompress(payload, 15 if payload[:1] == b"\x78" else -15)
    except (ValueError, EOFError, OSError, zlib.error):
        pass
    charset = re.search(r"charset\s*=\s*[\"']?([\w.:-]+)", by.get("content-type", "")) or re.search(
        r"<meta[^>]{0,200}charset\s*=\s*[\"']?([\w.:-]+)", payload[:4096].decode("latin-1").lower())
    try:
        return payload.decode(charset[1] if charset else "utf-8", "replace")
    except (LookupError, ValueError):
        return payload.decode("utf-8", "replace")


def response(url: str | None, body: str | None, date: str) -> dict:
    payload = (body or "").encode()
    url = url or "about:blank"
    block = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: %d\r\n\r\n" % len(payload) + payload
    rid = record_id("response", url, digest(payload))
    return _record("response", rid, block, [
        ("WARC-Target-URI", url), ("WARC-Date", date), ("Content-Type", "application/http; msgtype=response"), ("WARC-Payload-Digest", digest(payload))])


def _record(kind: str, rid: str, block: bytes, more: list[tuple[str, str]]) -> dict:
    head = [("WARC-Type", kind), ("WARC-Record-ID", rid), *more, ("WARC-Block-Digest", digest(block)), ("Content-Length", str(len(block)))]
    return {"warc_type": kind, "record_id": rid, "headers": [{"name": k, "value": " ".join(v.split())} for k, v in head], "block": block}


#: Headers that every record has of its own, or that name the source's digests.
_OWN = frozenset(("warc-type", "warc-record-id", "warc-block-digest", "warc-payload-digest", "warc-refers-to", "warc-refers-to-target-uri",
                  "warc-refers-to-date", "warc-concurrent-to", "warc-truncated", "warc-segment-number"))


def derivatives(rid: str, headers: list[dict], block: bytes) -> list[dict]:
    """The metadata and the conversion record of a response record."""
    source = {h["name"].lower(): h["value"] for h in headers}
    http, payload = http_message(block)
    text, named = page(page_text(block))
    kept = [(h["name"], h["value"]) for h in headers if h["name"].lower().startswith("warc-") and h["name"].lower() not in _OWN]
    kept += [("WARC-Refers-To", rid), ("WARC-Refers-To-Target-URI", source.get("warc-target-uri", "about:blank")),
             ("WARC-Refers-To-Date", source.get("warc-date", ""))]
    kept += [("WARC-Source-Payload-Digest", source.get("warc-payload-digest", digest(payload))),
             ("WARC-Source-Block-Digest", source.get("warc-block-digest", digest(block)))]
    conv_id, meta_id = record_id("conversion", rid), record_id("metadata", rid)
    text = text.encode()
    named = [*named, *((f"http-{k.lower()}", v) for k, v in http), ("conversion", conv_id)]
    meta = "".join(f"{k}: {' '.join(v.split())}\r\n" for k, v in named).encode()
    return [_record("metadata", meta_id, meta, [*kept, ("WARC-Concurrent-To", conv_id), ("Content-Type", "application/warc-fields")]),
            _record("conversion", conv_id, text, [*kept, ("WARC-Concurrent-To", meta_id), ("Content-Type", "text/plain; charset=utf-8")])]


def _batch(rows: list[dict], extra: list[tuple[str, pa.Array]]) -> pa.RecordBatch:
    cols = [pa.array([r[name] for r in rows], kind) for name, kind in _ARROW]
    return pa.RecordBatch.from_arrays([*(a for _, a in extra), *cols], names=[*(n for n, _ in extra), *(n for n, _ in _ARROW)])


def responses(pages: DataFrame, id_col: str = "page_id", url: str = "url", body: str = "html", date: str = "1970-01-01T00:00:00Z") -> DataFrame:
    """Response records of captured pages, each with the page's id; the capture date is a parameter."""
    small_batches(pages.sparkSession)

    def made(batches):
        for b in batches:
            ids, urls, bodies = b.columns
            yield _batch([response(u, x, date) for u, x in zip(urls.to_pylist(), bodies.to_pylist(), strict=True)], [("id", ids)])

    kind = pages.schema[id_col].dataType.simpleString()
    return (pages.select(F.col(id_col).alias("id"), F.col(url).cast("string").alias("url"), F.col(body).cast("string").alias("body"))
            .mapInArrow(per_task(made), f"id {kind}, {SCHEMA}").withColumnRenamed("id", id_col))


def derive(records: DataFrame, id_col: str = "page_id") -> DataFrame:
    """Metadata and conversion records of every response among ``records``."""
    small_batches(records.sparkSession)

    def made(batches):
        for b in batches:
            ids, rows, at = b.column(0), [], []
            for i, (rid, head, block) in enumerate(zip(*(c.to_pylist() for c in b.columns[1:]), strict=True)):
                rows += derivatives(rid, head, block)
                at += [i, i]
            yield _batch(rows, [("id", ids.take(pa.array(at, pa.int64())))])

    kind = records.schema[id_col].dataType.simpleString()
    out = records.where("warc_type = 'response'").select(F.col(id_col).alias("id"), "record_id", "headers", "block")
    return out.mapInArrow(per_task(made), f"id {kind}, {SCHEMA}").withColumnRenamed("id", id_col)


def header(name: str) -> F.Column:
    """Value of a record's header."""
    return F.filter("headers", lambda h: F.lower(h["name"]) == name.lower())[0]["value"]


def serialize(headers: list[dict], block: bytes) -> bytes:
    head = "WARC/1.1\r\n" + "".join(f"{h['name']}: {h['value']}\r\n" for h in headers) + "\r\n"
    return head.encode() + block + b"\r\n\r\n"


def parse(raw: bytes):
    """Records of a WARC file's bytes (plain, or gzip members), read one by one; what is cut off at the end is left out."""
    f = io.BytesIO(raw)
    if raw[:2] == b"\x1f\x8b":
        f = io.BufferedReader(gzip.GzipFile(fileobj=f))
    while True:
        try:
            line = f.readline()
            while line in (b"\r\n", b"\n"):
                line = f.readline()
            if not line.startswith(b"WARC/"):
                return
            headers = []
            while (line := f.readline()).strip():
                if line[:1] in b" \t" and headers:  # a folded line
                    headers[-1]["value"] += " " + line.decode("utf-8", "replace").strip()
                    continue
                name, _, value = line.decode("utf-8", "replace").partition(":")
                headers.append({"name": name.strip(), "value": value.strip()})
            by = {h["name"].lower(): h["value"] for h in headers}
            n = int(by.get("content-length", 0))
            block = f.read(n)
        except EOFError:
            return
        if len(block) < n:
            return
        yield {"warc_type": by.get("warc-type", ""), "record_id": by.get("warc-record-id", ""), "headers": headers, "block": block}


def write(records: DataFrame, path: str, records_per_file: int = 1000) -> None:
    """Stores records below ``path``: Parquet rows that hold a gzip WARC file's bytes each (``warc`` column).

    Spark has no writer for raw bytes; a row is a complete .warc.gz file of
    bounded size, and goes to any store that Spark writes to.
    """
    def made(batches):
        for b in batches:
            for at in range(0, b.num_rows, records_per_file):
                part = b.slice(at, records_per_file).to_pylist()
                yield pa.RecordBatch.from_arrays([pa.array([b"".join(gzip.compress(serialize(r["headers"], r["block"]), mtime=0) for r in part)], pa.binary()),
                                                  pa.array([len(part)], pa.int64())], names=["warc", "n_records"])

    small_batches(records.sparkSession)
    records.select("headers", "block").mapInArrow(per_task(made), "warc binary, n_records long").write.parquet(path)


def _parsed(batches):
    for b in batches:
        for raw in b.column(0):
            held, size = [], 0
            for record in parse(raw.as_py()):
                held.append(record)
                size += len(record["block"])
                if len(held) == 256 or size > 8 << 20:
                    yield _batch(held, [])
                    held, size = [], 0
            if held:
                yield _batch(held, [])


def read(spark, path: str) -> DataFrame:
    """Records of the files that ``write`` stored."""
    small_batches(spark)
    return spark.read.parquet(path).select("warc").mapInArrow(per_task(_parsed), SCHEMA)


def read_files(spark, path: str) -> DataFrame:
    """Records of ``.warc`` and ``.warc.gz`` files below ``path``; a task holds one file's bytes (at most 2 GB)."""
    small_batches(spark)
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path)
    return files.where(F.col("path").rlike(r"\.warc(\.gz)?$")).select("content").mapInArrow(per_task(_parsed), SCHEMA)


def op10_warc_derivatives(spark, sf_dir) -> DataFrame:
    out = derive(responses(table(spark, sf_dir, "pages")))
    return out.select("page_id", "warc_type", "record_id", header("WARC-Refers-To").alias("refers_to"), header("WARC-Target-URI").alias("target_uri"),
                      header("WARC-Source-Payload-Digest").alias("source_payload_digest"), header("WARC-Block-Digest").alias("block_digest"),
                      F.octet_length("block").cast("long").alias("content_length"), F.sha2("block", 256).alias("block_sha256"))
