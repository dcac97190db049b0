"""WARC derivatives: each response becomes a linked metadata record and a plain-text conversion record.

Response records are rows (record_id, target_uri, date, http_headers, body),
and warc_headers where the frame has it. A metadata record (content type
application/warc-fields) holds the source's HTTP status, media type, character
set, payload length and payload digest, the source's own WARC header lines
(fields source-warc-header), its status line and each of its header lines
(fields source-status-line and source-header, in order, repeated ones too,
folded ones as one line), the title, the language and the links of the page. A
conversion record (text/plain) holds the page's visible text. Both name the
response in WARC-Refers-To, WARC-Refers-To-Target-URI and WARC-Refers-To-Date,
keep its target URI and its date, and carry the digest of their own block.
Their ids are UUIDs derived from the response's id, so a task that runs again
writes the same records, and a later build can refer to them.

The body is bytes (a string counts as its UTF-8 bytes); lengths and digests are
of these bytes. Only the text is decoded: by a byte order mark, else by the
header's character set, else by the one a meta element in the first 1,024 bytes
names, else as UTF-8; what can't be decoded becomes U+FFFD. The digests in
WARC-Payload-Digest and WARC-Block-Digest of the source are carried unchanged
and checked: column digest_check and the fields payload-digest-check and
block-digest-check say match, mismatch or unchecked (an algorithm not known
here), digest_check the worst of both, or none if the source has no digest. A
mismatch is reported, the records are made all the same. Without a digest of
the source the payload's SHA-1 is given. The source's block is its HTTP
headers, the blank line and the body.

Rows: a null body is empty, null headers have no status and no media type, a
null URI or date leaves its headers out. A record without an id is given one
from its URI, date and body. Every response gives its two records; repeated
responses give them again, with the same ids. Bodies that are not HTML (by
their media type) become conversion records as they are, if they are text, and
of no text otherwise. Columns other than the six are not read.
"""

from __future__ import annotations

import base64
import codecs
import hashlib
import html
import re
import uuid
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from period_etl.llm.common import ship
from period_etl.llm.markup import Markup

VERSION = "WARC/1.1"
_NAMESPACE = uuid.uuid5(uuid.NAMESPACE_URL, "urn:warc-derivative")
_HIDDEN = {"script", "style", "noscript", "template", "head"}
_BREAKS = {"address", "article", "aside", "blockquote", "body", "br", "dd", "div", "dl", "dt", "fieldset", "figcaption", "figure", "footer", "form",
           "h1", "h2", "h3", "h4", "h5", "h6", "header", "hr", "html", "li", "main", "nav", "ol", "p", "pre", "section", "table", "td", "th", "tr", "ul"}
_LANGUAGE = re.compile(r"\blang\s*=\s*[\"']?([\w-]+)", re.I)
_LINK = re.compile(r"\bhref\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+))", re.I)

_META = re.compile(rb"<meta[^>]{0,300}?charset\s*=\s*[\"']?\s*([\w.:-]+)", re.I)
_MARKS = ((codecs.BOM_UTF8, "utf-8"), (codecs.BOM_UTF16_LE, "utf-16-le"), (codecs.BOM_UTF16_BE, "utf-16-be"))
#: Labels that pages use for windows-1252 (fixed values of the HTML standard).
_WESTERN = {"ascii", "us-ascii", "iso-8859-1", "iso8859-1", "latin1", "l1", "cp1252"}

RECORDS = ("record_id string, type string, refers_to string, target_uri string, date string, content_type string, block_digest string, "
           "payload_digest string, digest_check string, headers string, block string")


def digest(data: bytes) -> str:
    return "sha1:" + base64.b32encode(hashlib.sha1(data).digest()).decode()


def body_text(data: bytes, charset: str = "") -> str:
    """The text of a body: by its byte order mark, ``charset``, its meta element or UTF-8, in this order."""
    for mark, name in _MARKS:
        if data.startswith(mark):
            return data[len(mark):].decode(name, "replace")
    if not charset and (m := _META.search(data[:1024])):
        charset = m[1].decode().lower()
        if charset.startswith("utf-16"):   # the element was read as ASCII, so this can't be
            charset = ""
    try:
        text = data.decode("windows-1252" if charset in _WESTERN else charset or "utf-8", "replace")
        text.encode()
    except (LookupError, UnicodeError, ValueError):   # no character set of text, or lone surrogates
        text = data.decode("utf-8", "replace")
    return text


def check_digest(given: str, *parts: bytes) -> str:
    """match, mismatch or unchecked: a digest ``algorithm:value`` (base 32 or hexadecimal) of the joined parts."""
    name, _, value = given.strip().partition(":")
    name = name.strip().lower().replace("-", "")
    if name not in ("md5", "sha1", "sha224", "sha256", "sha384", "sha512"):
        return "unchecked"
    own = hashlib.new(name, usedforsecurity=False)
    for part in parts:
        own.update(part)
    spelt = value.strip().rstrip("=").lower()
    return "match" if spelt in (own.hexdigest(), base64.b32encode(own.digest()).decode().rstrip("=").lower()) else "mismatch"


def page_parts(page: str) -> tuple[str, str, str, list[str]]:
    """(text, title, language, link targets) of a page by one pass over its tags.

    The text has one line for each block, white space in a line as one space
    and no empty lines. What stands in comments, scripts and styles doesn't count.
    """
    markup, last, muted, out = Markup(page), 0, 0, []
    title, language, links = None, "", []
    for start, end, closes, name, attributes in markup.tags():
        shown = start >= muted
        if shown:
            out.append(page[max(last, muted):start])
        last = end
        if shown and name in _BREAKS:
            out.append("\n")
        if closes:
            continue
        if name in _HIDDEN:
            _, close = markup.close(name, end)
            stop = close if close >= 0 else len(page)
            muted = max(muted, stop)
            if name in ("script", "style"):
                markup.at = last = stop
        elif name == "title" and title is None:
            close, _ = markup.close(name, end)
            title = page[end:close if close >= 0 else len(page)]
        elif name == "html" and not language and (m := _LANGUAGE.search(attributes)):
            language = m[1]
        elif name == "a" and (m := _LINK.search(attributes)):
            links.append(_one_line(html.unescape(m[1] or m[2] or m[3] or "")))
    out.append(page[max(last, muted):])
    lines = (" ".join(line.split()) for line in html.unescape("".join(out)).split("\n"))
    return "\n".join(line for line in lines if line), _one_line(html.unescape(title or "")), language, links


def visible_text(page: str) -> str:
    """The page's text alone."""
    return page_parts(page)[0]


def header_lines(headers: str | None) -> list[str]:
    """A response's header lines in order, with their continuation lines; no empty lines, no line ends."""
    whole = re.sub(r"(?:\r\n|\r|\n)[ \t]+(?=[^\s])", " ", headers or "")
    return [line.strip() for line in re.split(r"\r\n|\r|\n", whole) if line.strip()]


def http_fields(headers: str | None) -> tuple[str, str, str]:
    """(status, media type, character set) of a response's header lines; empty where missing."""
    lines = header_lines(headers)
    status = m[1] if lines and (m := re.match(r"HTTP/\S+\s+(\d+)", lines[0])) else ""
    kind = next((line.split(":", 1)[1].strip() for line in lines if line.lower().startswith("content-type:")), "")
    charset = m[1] if (m := re.search(r"charset\s*=\s*[\"']?([\w.:-]+)", kind, re.I)) else ""
    return status, kind.split(";")[0].strip().lower(), charset.lower()


def _one_line(text: str) -> str:
    return " ".join(text.split())


def header_value(lines: list[str], name: str) -> str:
    """The first value of a header, by its name in any case; empty where missing."""
    return next((line.split(":", 1)[1].strip() for line in lines if line.lower().startswith(name.lower() + ":")), "")


def derivatives(record_id: str | None, uri: str | None, date: str | None, headers: str | None, body: bytes | None,
                warc_headers: str | None = None) -> Iterator[dict]:
    """The metadata record and the conversion record of one response."""
    data = body or b""
    source = record_id or f"<urn:uuid:{uuid.uuid5(_NAMESPACE, repr((uri, date, data.decode('utf-8', 'surrogateescape'))))}>"
    status, kind, charset = http_fields(headers)
    own_lines = header_lines(warc_headers)
    payload, whole = (header_value(own_lines, f"WARC-{x}-Digest") for x in ("Payload", "Block"))
    checks = {}
    if payload:
        checks["payload-digest-check"] = check_digest(payload, data)
    if whole:
        checks["block-digest-check"] = check_digest(whole, _http_block(headers), data)
    verdict = next((x for x in ("mismatch", "unchecked", "match") if x in checks.values()), "none")
    payload = payload or digest(data)
    is_html = kind in ("", "text/html", "application/xhtml+xml")
    fields = [("http-status", status), ("source-content-type", kind), ("source-charset", charset), ("source-payload-length", str(len(data))),
              ("source-payload-digest", payload), *checks.items(), *(("source-warc-header", line) for line in own_lines)]
    fields += [("source-header" if i or not line.startswith("HTTP/") else "source-status-line", line) for i, line in enumerate(header_lines(headers))]
    page = body_text(data, charset) if is_html or kind.startswith("text/") else ""
    if is_html:
        text, title, language, links = page_parts(page)
        fields += [("title", title), ("language", language), *(("outlink", x) for x in links)]
    else:
        text = page
    for type_, content, block in (
            ("metadata", "application/warc-fields", "".join(f"{k}: {v}\r\n" for k, v in fields if v)), ("conversion", "text/plain; charset=utf-8", text)):
        raw = block.encode()
        own = f"<urn:uuid:{uuid.uuid5(_NAMESPACE, f'{type_} {source}')}>"
        target, day = _one_line(uri or ""), _one_line(date or "")
        head = [("WARC-Type", type_), ("WARC-Record-ID", own), ("WARC-Refers-To", source), ("WARC-Refers-To-Target-URI", target),
                ("WARC-Refers-To-Date", day), ("WARC-Target-URI", target), ("WARC-Date", day),
                ("WARC-Block-Digest", digest(raw)), ("Content-Type", content), ("Content-Length", str(len(raw)))]
        yield {"record_id": own, "type": type_, "refers_to": source, "target_uri": uri, "date": date, "content_type": content, "block_digest": digest(raw),
               "payload_digest": payload, "digest_check": verdict, "headers": VERSION + "\r\n" + "".join(f"{k}: {v}\r\n" for k, v in head if v),
               "block": block}


def _http_block(headers: str | None) -> bytes:
    """A response's HTTP headers as they stand before its body, with the blank line that ends them."""
    text = headers or ""
    if text and not text.endswith("\r\n\r\n"):
        text += "\r\n" if text.endswith("\r\n") else "\r\n\r\n"
    return text.encode()


def build_derivatives(responses: DataFrame) -> DataFrame:
    """Two records for each response, with the columns of RECORDS."""
    ship(responses.sparkSession)
    names = ["record_id", "target_uri", "date", "http_headers", "body", "warc_headers"]

    def run(batches):
        for batch in batches:
            for lo in range(0, batch.num_rows, 200):
                rows = zip(*(batch.column(c).slice(lo, 200).to_pylist() for c in names), strict=True)
                yield pa.RecordBatch.from_pylist([r for row in rows for r in derivatives(*row)], schema=schema)

    schema = pa.schema([(c.split()[0], pa.string()) for c in RECORDS.split(", ")])
    given = {c.lower() for c in responses.columns}
    inputs = [(F.col(c) if c != "warc_headers" or c in given else F.lit(None)).cast("binary" if c == "body" else "string").alias(c) for c in names]
    return responses.select(*inputs).mapInArrow(run, RECORDS)


def record_bytes(records: DataFrame) -> DataFrame:
    """(record_id, data): each record as it stands in a WARC file, header lines, blank line, block and two line ends."""
    whole = F.concat(F.col("headers"), F.lit("\r\n"), F.col("block"), F.lit("\r\n\r\n"))
    return records.select("record_id", whole.cast("binary").alias("data"))


def page_responses(pages: DataFrame, date: str, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """Response records of a table of pages that were fetched at ``date``: 200, HTML in UTF-8, ids from id, URL and text,
    WARC headers with the type, the id and the digest of the payload."""
    body = F.coalesce(F.col(html_col), F.lit(""))
    name = F.sha2(F.concat_ws("\n", F.col(id_col).cast("string"), F.col(url_col), body).cast("binary"), 256)
    parts = [F.substring(name, a, n) for a, n in ((1, 8), (9, 4), (13, 4), (17, 4), (21, 12))]
    record = F.concat(F.lit("<urn:uuid:"), F.concat_ws("-", *parts), F.lit(">"))
    payload = F.concat(F.lit("sha256:"), F.sha2(body.cast("binary"), 256))
    return pages.select(record.alias("record_id"), F.col(url_col).alias("target_uri"),
                        F.lit(date).alias("date"), F.concat(F.lit("HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: "),
                                                           F.octet_length(body).cast("string"), F.lit("\r\n")).alias("http_headers"),
                        F.col(html_col).alias("body"),
                        F.concat(F.lit("WARC-Type: response\r\nWARC-Record-ID: "), record, F.lit("\r\nWARC-Payload-Digest: "), payload,
                                 F.lit("\r\n")).alias("warc_headers"))
