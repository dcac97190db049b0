import base64
import codecs
import hashlib
import html
import random
import time

import numpy as np
import pytest
from pyspark.sql import functions as F

from period_etl.llm import html_text, warc
from period_etl.llm.html_text import blocks, extract_pages, line_hashes, main_text, shared

PAGE = "page_id long, url string, html string"


def body(*parts):
    return "<!DOCTYPE html><html lang=en><head><title>T &amp; t</title><style>p{}</style></head><body>" + "".join(parts) + "</body></html>"


def text_of(page):
    return main_text(page, np.zeros(0, np.int64))


@pytest.mark.parametrize("page, want", [
    ("", ""), ("plain  &amp; text", "plain & text"), (None, ""),
    (body("<nav><a href=/>Home</a></nav><article><h1>Head</h1><p>One <b>two</b>&nbsp;three<br>four</p></article><footer>f</footer>"), "Head\n\nOne two three four"),
    (body("<article><p>a<p>b<div class='comments'><p>bad</p></div><ul><li>c</ul></article>"), "a\n\nb\n\nc"),
    (body("<div class='cookie-notice'>x</div><div id=sidebar>y</div><p>kept</p><form>z</form><aside>q</aside><div role=navigation>n</div>"), "kept"),
    (body("<main><p>x &lt;b&gt; &#233; &copy;</p><script>if (a < b) '</p>'</script><!-- <p>no</p> --></main>"), "x <b> é ©"),
    (body("<div class='no-sidebar'><p>kept</p></div><p hidden>gone</p>"), "kept"),
    ("<article><p>never closed <i>at all", "never closed at all"), ("a < b and c > d", "a < b and c > d"),
    (body("<header>top</header><article><header><h1>Title</h1></header><p>t</p></article>"), "Title\n\nt"),
    (body("<article><p class='notice-period'>a</p><p id=share-price>b</p><p class='x related-posts'>no</p><p class=ad1>no</p><p class='lead ad'>no</p>",
          "<p class=share-buttons>no</p><p class=social-share>no</p><math><mi>c</mi></math> <object>d</object></article><noscript>no</noscript>"), "a\n\nb\n\nc d"),
])
def test_blocks(page, want):
    assert text_of(page or "") == want


def test_longest_common_subsequence():
    r = random.Random(4)
    for _ in range(300):
        a, b = ([r.randint(0, 5) for _ in range(r.randint(0, 12))] for _ in range(2))
        best = [[0] * (len(b) + 1) for _ in range(len(a) + 1)]
        for i in reversed(range(len(a))):
            for j in reversed(range(len(b))):
                best[i][j] = best[i + 1][j + 1] + 1 if a[i] == b[j] else max(best[i + 1][j], best[i][j + 1])
        mark = shared(np.array(a, np.int64), np.array(b, np.int64))
        rest = iter(b)
        assert mark.sum() == best[0][0] and all(x in rest for x, m in zip(a, mark, strict=True) if m)


BROKEN = {"tags never closed": "<a " * 700_000, "quotes never closed": '<a "' * 500_000 + ">", "odd quotes": "<a '\"" * 400_000 + "'>", "names": "<a" * 500_000 + ' ">',
          "open and wrong end tags": "<b>" * 300_000 + "</i>" * 300_000, "raw never closed": "<noscript>" * 200_000, "titles": "<title " * 300_000,
          "comments": "<!-- " * 400_000, "ends without >": "<style></style" * 150_000, "quoted >": "<a '>" * 400_000}


@pytest.mark.parametrize("kind", sorted(BROKEN))
def test_broken_pages_take_linear_time(kind):
    """Megabytes of markup that never closes: each takes a few seconds at most, and 'text stays text' holds at the end."""
    page = BROKEN[kind]
    began = time.monotonic()
    list(blocks(page))
    warc.page_parts(page)
    assert time.monotonic() - began < 15


def test_what_is_no_tag_is_text():
    assert text_of("<p>1 < 2, <a 'x, <b>bold</b>") == "1 < 2, <a 'x, bold"
    assert text_of("<p>open <i class=\"x") == 'open <i class="x' and text_of("<p title='a>b'>t</p>") == "t"


def test_large_alignments_need_linear_memory(monkeypatch):
    r, plain = random.Random(7), html_text._CELLS
    for _ in range(100):
        a, b = (np.array([r.randint(0, 6) for _ in range(r.randint(0, 40))], np.int64) for _ in range(2))
        monkeypatch.setattr(html_text, "_CELLS", plain)
        want = shared(a, b).sum()
        monkeypatch.setattr(html_text, "_CELLS", 4)
        mark = shared(a, b)
        rest = iter(b.tolist())
        assert mark.sum() == want and all(x in rest for x in a[mark].tolist())


def site():
    out = []
    for host in ("a.example", "b.example"):
        for i in range(12):
            out.append((len(out), f"https://{host}/n/{i:03}?q={i}", body("<div>Site name</div>", f"<p>story {host} {i}</p>", "<p>all rights</p>")))
    out.append((90, "https://alone.example/x", body("<div>Site name</div><p>alone</p>")))
    out += [out[3], out[3], (91, None, body("<p>no url</p>")), (92, "not a url", None), (None, "https://c.example/", ""), (93, "https://d.example/", "<p>" + "long " * 50_000)]
    return out


def test_pages_lose_what_they_share_with_their_neighbour(spark):
    frame = spark.createDataFrame(site(), PAGE).withColumns({c: F.lit(1) for c in ("k1", "host", "path", "lines", "mate", "_part", "_row", "p", "l")})
    got = [tuple(r) for r in extract_pages(frame.repartition(4)).collect()]
    want = []
    for i, url, page in site():
        story = [t for t, _, _ in blocks(page or "")]
        if url and (".example/n/" in url):
            story = [t for t in story if t.startswith("story")]
        want.append((i, url, "\n\n".join(story)))
    assert sorted(got, key=str) == sorted(want, key=str)
    assert extract_pages(spark.createDataFrame([], PAGE)).collect() == []


def test_template_without_any_mark_goes_by_differencing(spark):
    """No class, article or other structure: what the pages of a host repeat goes, also where articles only protect."""
    def page(i, story, tag):
        menu = "".join(f"<div>item {j}</div>" for j in range(8))
        return body(f"<div>Site</div>{menu}<{tag}><p>story {i}</p>", "".join(f"<p>{t}</p>" for t in story), f"</{tag}><div>Read next</div><div>by the site</div>")

    stories = [[f"line {i} {j}" for j in range(i % 5 + 1)] for i in range(20)]
    for tag in ("div", "article"):
        made = [(i, f"https://h.example/{i:02}", page(i, s, tag)) for i, s in enumerate(stories)]
        got = {r.page_id: r.text for r in extract_pages(spark.createDataFrame(made, PAGE)).collect()}
        assert got == {i: "\n\n".join([f"story {i}", *s]) for i, s in enumerate(stories)}
    # lines outside an article that the neighbour lacks stay, those it has go; without a neighbour the article alone is the text
    one, two = (body(f"<div>Site</div><div>By {n}</div><article><p>story</p></article>") for n in "ab")
    got = extract_pages(spark.createDataFrame([(1, "https://h.example/1", one), (2, "https://h.example/2", two), (3, "https://i.example/", one)], PAGE))
    assert {r.page_id: r.text for r in got.collect()} == {1: "By a\n\nstory", 2: "By b\n\nstory", 3: "story"}


def test_mirrors_tell_nothing(spark):
    """Copies of a page at other URLs are no neighbours; a page all of whose lines stand in its neighbour keeps them."""
    a, b = (body(f"<div>Site</div><p>{t}</p>") for t in ("one", "two"))
    made = [(1, "https://h.example/1", a), (2, "https://h.example/1?p=2", a), (3, "https://h.example/2", b), (4, "https://i.example/1", a),
            (5, "https://i.example/2", a), (6, "https://j.example/1", a), (7, "https://j.example/2", body("<div>Site</div><p>one</p><p>more</p>"))]
    got = {r.page_id: r.text for r in extract_pages(spark.createDataFrame(made, PAGE)).collect()}
    whole = "Site\n\none"
    assert got == {1: whole, 2: "one", 3: "two", 4: whole, 5: whole, 6: whole, 7: "more"}


def test_neighbour_is_the_page_before(spark):
    lines = [(i, i, "h", f"/{i:02}", "", i, [i]) for i in range(40)] + [(99, 99, "z", "/", "", 99, [99])]
    frame = spark.createDataFrame(lines, "k1 long, k2 long, host string, path string, url string, page_id long, lines array<long>").repartition(5)
    got = {r.k1: r.mate for r in html_text.neighbours(frame).collect()}
    assert got == {**{i: [i - 1] for i in range(1, 40)}, 0: [1], 99: None}


def test_mirrors_of_an_article_keep_it(spark):
    page = body("<nav>n</nav><article><p>same story</p></article>")
    frame = spark.createDataFrame([(1, "https://m.example/a", page), (2, "https://m.example/a?page=2", page)], PAGE)
    assert [r.text for r in extract_pages(frame).collect()] == ["same story"] * 2
    assert len(line_hashes(list(blocks(page)))) == 2


# --- WARC ------------------------------------------------------------------

RESPONSE = "record_id string, target_uri string, date string, http_headers string, body string"
HEAD = "HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=UTF-8\r\n"
RESPONSES = [
    ("<urn:uuid:1>", "https://a.example/", "2024-01-01T00:00:00Z", HEAD, body("<p>One &amp; two<br>three</p><a href='/x?a=1&amp;b=2'>l</a><script>s</script>")),
    ("<urn:uuid:2>", None, None, None, None), (None, "https://b.example/\r\nEvil: 1", "2024-01-01T00:00:00Z", "HTTP/1.1 404 Not Found\nContent-Type: text/plain", "raw <text>"),
    ("<urn:uuid:3>", "u", "d", "HTTP/1.1 200 OK\r\nContent-Type: image/png\r\n", "binary"), ("<urn:uuid:4>", "u", "d", HEAD, ""),
    ("<urn:uuid:5>", "u", "d", HEAD, "<p>" + "very long " * 50_000), ("<urn:uuid:1>", "https://a.example/", "2024-01-01T00:00:00Z", HEAD, body("<p>again</p>")),
]


def sha1(data):
    return "sha1:" + base64.b32encode(hashlib.sha1(data).digest()).decode()


def test_records_link_to_their_response(spark):
    frame = spark.createDataFrame(RESPONSES, RESPONSE).withColumns({c: F.lit(1) for c in ("type", "block", "headers")})
    got = warc.build_derivatives(frame).collect()
    assert len(got) == 2 * len(RESPONSES) and sorted({r.type for r in got}) == ["conversion", "metadata"]
    for r in got:
        head = dict(line.split(": ", 1) for line in r.headers.split("\r\n")[1:-1])
        assert r.headers.startswith("WARC/1.1\r\n") and head["WARC-Refers-To"] == r.refers_to and head["WARC-Record-ID"] == r.record_id
        assert head["WARC-Block-Digest"] == r.block_digest == sha1(r.block.encode()) and int(head["Content-Length"]) == len(r.block.encode())
        assert "Evil" not in head
    assert {r.payload_digest for r in got} == {sha1((b or "").encode()) for *_, b in RESPONSES}
    first = {r.type: r for r in got if r.refers_to == "<urn:uuid:1>" and "again" not in r.block and r.payload_digest == sha1(RESPONSES[0][4].encode())}
    assert first["conversion"].block == "One & two\nthree\nl"
    fields = first["metadata"].block.split("\r\n")
    assert {"http-status: 200", "source-charset: utf-8", "title: T & t", "language: en", "outlink: /x?a=1&b=2"} <= set(fields)
    by = {(r.refers_to, r.type): r.block for r in got}
    assert by["<urn:uuid:3>", "conversion"] == by["<urn:uuid:2>", "conversion"] == by["<urn:uuid:4>", "conversion"] == ""
    assert "raw <text>" in {r.block for r in got}
    assert sorted(map(tuple, warc.build_derivatives(frame).collect())) == sorted(map(tuple, got))   # the same ids each time
    assert warc.build_derivatives(frame.limit(0)).collect() == []


def test_metadata_keeps_all_source_headers(spark):
    lines = ["Content-Type: text/html; charset=UTF-8", "Last-Modified: Mon, 01 Jan 2024 00:00:00 GMT", 'ETag: "a:b"', "Set-Cookie: a=1; Path=/", "Set-Cookie: b=2",
             "Content-Language: en", "Location: https://a.example/?x=1:2", "Content-Length: 007", "no colon"]
    head = "\r\n".join(["HTTP/1.1 404 Not  Here", *lines, "X-Folded: one", "\t two", " three", "", ""])
    frame = spark.createDataFrame([("<urn:uuid:1>", "u", "d", head, body("<p>x</p>")), ("<urn:uuid:2>", "u", "d", "Server: s\nETag: e", ""),
                                   ("<urn:uuid:3>", "u", "d", None, "")], RESPONSE)
    got = {r.refers_to: r.block.split("\r\n") for r in warc.build_derivatives(frame).where("type = 'metadata'").collect()}
    kept = {k: [f.split(": ", 1)[1] for f in v if f.startswith("source-header: ")] for k, v in got.items()}
    assert kept == {"<urn:uuid:1>": [*lines, "X-Folded: one two three"], "<urn:uuid:2>": ["Server: s", "ETag: e"], "<urn:uuid:3>": []}
    assert "source-status-line: HTTP/1.1 404 Not  Here" in got["<urn:uuid:1>"] and "http-status: 404" in got["<urn:uuid:1>"]


def test_bodies_are_bytes_and_source_digests_are_carried(spark):
    latin = "HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=ISO-8859-1\r\n"
    caf = "<p>caf\xe9 \u20ac</p>".encode("cp1252")
    block = (latin + "\r\n").encode() + caf
    hexed = "sha256:" + hashlib.sha256(caf).hexdigest().upper()
    cases = [   # headers, body, WARC headers, text, digest_check, payload_digest
        (latin, caf, f"WARC-Payload-Digest: {hexed}\r\nwarc-block-digest: {sha1(block)}\r\n", "caf\xe9 \u20ac", "match", hexed),
        (latin, caf, f"WARC-Payload-Digest: {hexed}\r\nWARC-Block-Digest: {sha1(caf)}", "caf\xe9 \u20ac", "mismatch", hexed),
        (latin, caf, "WARC-Payload-Digest: blake9:00", "caf\xe9 \u20ac", "unchecked", "blake9:00"),
        ("HTTP/1.1 200 OK", b"<meta charset='koi8-r'><p>" + "\u043c\u0438\u0440".encode("koi8-r"), None, "\u043c\u0438\u0440", "none", None),
        (None, codecs.BOM_UTF16_LE + "<p>x\u00e9".encode("utf-16-le"), "", "x\u00e9", "none", None),
        ("HTTP/1.1 200 OK\r\nContent-Type: text/plain; charset=hex", b"a\xff", "WARC-Type: response", "a\ufffd", "none", None),
        ("HTTP/1.1 200 OK\r\nContent-Type: image/png", bytes(range(256)), "WARC-Payload-Digest: " + sha1(bytes(range(256))), "", "match", sha1(bytes(range(256)))),
        (None, None, "WARC-Payload-Digest: " + sha1(b""), "", "match", sha1(b"")),
    ]
    schema = "record_id string, target_uri string, date string, http_headers string, body binary, warc_headers string"
    frame = spark.createDataFrame([(f"<urn:uuid:{i}>", "u", "d", h, b, w) for i, (h, b, w, *_) in enumerate(cases)], schema)
    got = {(r.refers_to, r.type): r for r in warc.build_derivatives(frame).collect()}
    for i, (_, data, given, text, check, payload) in enumerate(cases):
        meta, plain = got[f"<urn:uuid:{i}>", "metadata"], got[f"<urn:uuid:{i}>", "conversion"]
        assert plain.block == text and meta.digest_check == plain.digest_check == check, i
        assert meta.payload_digest == plain.payload_digest == (payload or sha1(data or b""))
        fields = meta.block.split("\r\n")
        assert [f[20:] for f in fields if f.startswith("source-warc-header: ")] == [x for x in (given or "").split("\r\n") if x]
        assert f"source-payload-length: {len(data or b'')}" in fields
        assert "WARC-Refers-To-Target-URI: u\r\n" in meta.headers and "WARC-Refers-To-Date: d\r\n" in plain.headers
    assert {"payload-digest-check: match", "block-digest-check: mismatch"} <= set(got["<urn:uuid:1>", "metadata"].block.split("\r\n"))
    as_text = frame.where("http_headers is null").withColumn("body", F.col("body").cast("string")).drop("warc_headers")
    assert warc.build_derivatives(as_text).count() == 4


def test_bytes_alike_but_for_what_is_not_utf8_keep_ids_apart(spark):
    frame = spark.createDataFrame([(None, "u", "d", None, b"\xfe"), (None, "u", "d", None, b"\xfd")], RESPONSE.replace("body string", "body binary"))
    assert len({r.record_id for r in warc.build_derivatives(frame).collect()}) == 4


def test_record_bytes_parse_back(spark):
    records = warc.build_derivatives(spark.createDataFrame(RESPONSES, RESPONSE))
    for r in warc.record_bytes(records).collect():
        head, rest = bytes(r.data).split(b"\r\n\r\n", 1)
        n = int(next(line for line in head.split(b"\r\n") if line.startswith(b"Content-Length")).split(b": ")[1])
        assert rest[n:] == b"\r\n\r\n"


def test_visible_text_of_pages():
    assert warc.visible_text(body("<ul><li>a<li>b</ul><td>c</td>")) == "a\nb\nc"
    assert warc.visible_text("x < y &amp; " + html.escape("<b>")) == "x < y & <b>"


def test_page_responses(spark):
    pages = spark.createDataFrame([(1, "u", "<p>é</p>"), (1, "u", "<p>é</p>"), (2, None, None)], PAGE)
    got = warc.page_responses(pages, "2024-01-01T00:00:00Z").collect()
    assert len({r.record_id for r in got}) == 2 and "Content-Length: 9" in got[0].http_headers
    assert {r.digest_check for r in warc.build_derivatives(warc.page_responses(pages, "2024-01-01T00:00:00Z")).collect()} == {"match"}
