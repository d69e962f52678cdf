"""Main text, WARC derivatives and URL verdicts of pages."""

import gzip
import itertools
import json
import random
import re
import time
import zlib
from html.parser import HTMLParser

import pytest
from pyspark.sql import functions as F

from lotbook.llm import main_text, url_filter, warc
from lotbook.llm.queries import URL_RULES

PAGE = """<!DOCTYPE html><html><head><title>Not &amp; text</title><style>p{}</style><script>var t="</p>";</script></head>
<body><header><a href="/">Site</a></header><nav><ul><li><a href="/a">Menu</a></li></ul></nav>
<div class="cookie-notice">We use cookies. Please accept all of them now, thank you. It is needed.</div>
<div id="sidebar"><p>Popular posts of this week, read them all. They are good. They are short.</p></div>
<article><h1>Head &amp; line</h1><p><b>First   paragraph&nbsp;of
text &lt;here&gt;.<br><p>Second &eacute; one.</p><aside>See <a href=x>this</a></aside><form>Sign up <input></form>
<ul><li>point one<li>point two</ul><!-- no <p>text</p> --></article>
<section id="comments"><h2>Comments</h2><article class="comment"><p>Great. I liked it. A lot of it, really.</p></article>
</section><div class="ad">Buy. Now. This is a good one for you and for everybody.</div><footer>&copy; me</footer>"""
TEXT = "Head & line\nFirst paragraph of text <here>.\nSecond é one.\npoint one\npoint two"
AWKWARD = [None, "", "<", "<p", "</p></div>", "plain words only", "<p>" * 500, "<div " + "a='" * 50, "&#0;&bogus;&amp"]


def pages(spark, rows, extra=()):
    frame = spark.createDataFrame(rows, "page_id long, url string, html string").repartition(2)
    for name in extra:
        frame = frame.withColumn(name, F.lit("own"))
    return frame


def test_article_without_its_surroundings(spark):
    rows = [(1, "u", PAGE), (2, None, PAGE), *[(10 + i, "u", h) for i, h in enumerate(AWKWARD)]]
    found = {r["page_id"]: r for r in main_text.main_text(pages(spark, rows, ("text", "n_chars", "_html"))).collect()}
    assert found[1]["text"] == found[2]["text"] == TEXT and found[1]["n_chars"] == len(TEXT)
    assert len(found) == len(rows) and all(r["n_chars"] == len(r["text"]) for r in found.values())
    assert found[10]["text"] == found[11]["text"] == ""
    assert main_text.main_text(pages(spark, [])).collect() == []


def test_page_without_telling_markup():
    long = "This is a paragraph of plain text. It has several sentences. They go on until the length counts in full, too. " * 2
    links = "<div>" + "".join(f"<a href={i}>Link {i}</a> " for i in range(9)) + "</div>"
    html = f"{links}<div><h1>Title</h1><p>{long}</p><p>Short</p><p>{long}</p></div>{links}"
    assert main_text.extract(html) == "\n".join(["Title", long.strip(), "Short", long.strip()])


def test_very_long_page():
    html = "<article>" + "".join(f"<p>Sentence {i} of a long article.</p>" for i in range(20_000)) + "</article>"
    assert main_text.extract(html).count("\n") == 19_999


def test_minimum_cut_equals_brute_force():
    draw = random.Random(1)

    def cost(unary, links, label):
        lost = sum(max(u, 0) if not on else max(-u, 0) for u, on in zip(unary, label, strict=True))
        return lost + sum(c for a, b, c in links if label[a] != label[b])

    for _ in range(200):
        n = draw.randint(1, 9)
        unary = [draw.uniform(-2, 2) for _ in range(n)]
        links = [(a, b, draw.uniform(0, 1.5)) for a in range(n) for b in range(a + 1, n) if draw.random() < 0.5]
        best = min(cost(unary, links, label) for label in itertools.product([False, True], repeat=n))
        assert cost(unary, links, main_text.minimum_cut(unary, links)) == pytest.approx(best)
    assert main_text.minimum_cut([], []) == []


def test_derivatives_refer_to_their_source(spark):
    rows = [(1, "http://a.example/x", PAGE), (2, None, None), (3, "http://b.example/", "text &amp; <b>more</b>")]
    source = warc.responses(pages(spark, rows))
    found = warc.derivatives(source.withColumn("extra", F.lit(1)), keep=["page_id", "type"]).collect()
    assert len(found) == 6 and len({r["record_id"] for r in found}) == 6
    by_page = {r["page_id"]: r for r in source.collect()}
    for r in found:
        origin = by_page[r["page_id"]]
        assert r["headers"]["WARC-Refers-To"] == origin["record_id"]
        assert r["headers"]["WARC-Source-Payload-Digest"] == origin["headers"]["WARC-Payload-Digest"]
        assert r["headers"]["WARC-Block-Digest"] == warc.digest(bytes(r["block"]))
        assert (r["target_uri"], r["date"]) == (origin["target_uri"], origin["date"])
    about = json.loads(next(bytes(r["block"]) for r in found if r["page_id"] == 1 and r["type"] == "metadata"))
    assert about["status"] == "200" and about["html"]["title"] == "Not & text"
    assert {"path": "a", "url": "/a"} in about["html"]["links"]
    assert about["source_warc_headers"]["WARC-Record-ID"] == by_page[1]["record_id"]
    assert next(bytes(r["block"]) for r in found if r["page_id"] == 3 and r["type"] == "conversion") == b"text & more"


@pytest.mark.parametrize("compression", ["gzip", "none"])
def test_files_round_trip(spark, tmp_path, compression):
    rows = [(i, f"http://h{i}.example/", PAGE * (i % 4)) for i in range(40)]
    source = warc.responses(pages(spark, rows)).select(*warc.RECORD.names)
    every = source.unionByName(warc.derivatives(source))
    path = str(tmp_path / compression)
    warc.write_warc(every.repartition(3), path, compression)
    back = warc.read_warc(spark, path).collect()

    def plain(records):
        return sorted((r["record_id"], r["type"], r["target_uri"], bytes(r["block"]),
                       r["headers"].get("WARC-Refers-To")) for r in records)

    assert plain(back) == plain(every.collect()) and not any(r["damaged"] for r in back)
    again = warc.derivatives(warc.read_warc(spark, path).filter("type = 'response'")).collect()
    assert {(r["record_id"], bytes(r["block"])) for r in again if r["type"] == "conversion"} == {
        (r["record_id"], bytes(r["block"])) for r in back if r["type"] == "conversion"}


def test_encodings_and_damage(spark, tmp_path):
    body = "<title>é</title><p>größer".encode("latin-1")
    packed = gzip.compress(body)
    chunked = b"%x\r\n%s\r\n0\r\n\r\n" % (len(packed), packed)
    head = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=iso-8859-1\r\nTransfer-Encoding: chunked\r\n" \
           b"Content-Encoding: gzip\r\n\r\n"
    record = {"type": "response", "record_id": "<urn:x>", "target_uri": None, "date": None, "content_type": None,
              "headers": {"X-Long": "a"}, "block": head + chunked, "damaged": False}
    metadata, text = warc.derivatives_of(record)
    assert text["block"].decode() == "größer" and json.loads(metadata["block"])["html"]["title"] == "é"
    split = {**record, "record_id": "<urn:y>", "block": b"one\r\n\r\nWARC/1.0\r\nX: y\r\n\r\ntwo"}
    short = warc.format_record({**record, "record_id": "<urn:z>"})[:-5]
    file = tmp_path / "x.warc"
    file.write_bytes(b"\r\n\r\n".join([warc.format_record(record), warc.format_record(split), short, b""]))
    back = {r["record_id"]: r for r in warc.read_warc(spark, str(file)).collect()}
    assert not back["<urn:x>"]["damaged"] and bytes(back["<urn:x>"]["block"]) == head + chunked
    assert not back["<urn:y>"]["damaged"] and bytes(back["<urn:y>"]["block"]) == split["block"]
    assert back["<urn:z>"]["damaged"] and warc.derivatives_of(back["<urn:z>"].asDict()) == []


def test_bodies_are_decoded_whole(spark, monkeypatch):
    packed = [("Content-Encoding", "gzip")]
    one, two = gzip.compress(b"<p>one</p>"), gzip.compress(b"<p>two</p>")
    assert warc.decoded_body(packed, one + two) == (b"<p>one</p><p>two</p>", True)
    assert warc.decoded_body(packed, one + two + b"\0" * 9) == (b"<p>one</p><p>two</p>", True)
    assert warc.decoded_body(packed, one + two[:-9])[1] is False
    assert warc.decoded_body(packed, one + two[:10] + b"\xff" * 20) == (b"<p>one</p>", False)
    assert warc.decoded_body(packed, one[:-1]) == (b"<p>one</p>", False)
    assert warc.decoded_body(packed, b"") == (b"", True)
    assert warc.decoded_body([("Content-Encoding", "deflate")], zlib.compress(b"text")[2:-4]) == (b"text", True)
    chunked = [("Transfer-Encoding", "chunked")]
    assert warc.decoded_body(chunked, b"3\r\nabc\r\n0\r\n\r\n") == (b"abc", True)
    for cut in (b"3\r\nabc\r\n", b"3\r\nabc\r\n9\r\nde", b"3\r\nabc\r\nx\r\nde"):
        assert warc.decoded_body(chunked, cut)[1] is False
    assert warc.decoded_body(chunked, b"plain\r\ntext") == (b"plain\r\ntext", True)
    long = b"a" * ((64 << 20) + 9)
    assert warc.decoded_body([], long) == (long, True) == warc.decoded_body(packed, gzip.compress(long, 1))
    monkeypatch.setattr(warc, "BATCH_BYTES", 1)
    source = warc.responses(pages(spark, [(i, "u", PAGE) for i in range(9)]))
    found = warc.derivatives(source, keep=["page_id"]).collect()
    assert sorted(r["page_id"] for r in found) == sorted([*range(9)] * 2)


def test_records_of_any_version_are_all_read(spark, tmp_path):
    def made(version, name, block, size=None):
        return b"WARC/%s\r\nWARC-Record-ID: %s\r\nContent-Length: %d\r\n\r\n%s" % (
            version, name, len(block) if size is None else size, block)

    gap = b"\r\n\r\n"
    inner = b"a" + gap + b"WARC/1.1\r\nX: y" + gap + b"b"
    (tmp_path / "a.warc").write_bytes(gap.join([
        made(b"1.1", b"a", b"one"), made(b"1.1", b"b", inner), made(b"0.18", b"c", b""), made(b"1.1", b"d", b"two", 2),
        made(b"1.1", b"e", b"short", 10**6), made(b"1.0", b"f", b"three"), made(b"1.1", b"g", b"four")]) + gap)
    found = {r["record_id"]: (bytes(r["block"]), r["damaged"]) for r in warc.read_warc(spark, str(tmp_path)).collect()}
    assert found == {"a": (b"one", False), "b": (inner, False), "c": (b"", False), "d": (b"two", True),
                     "e": (b"short", True), "f": (b"three", False), "g": (b"four", False)}
    assert warc.parse_record(made(b"1.0", b"x", b"two", 2))["damaged"]


def test_separators_in_payloads_and_repeated_fields_over_many_tasks(spark, tmp_path):
    """Every record and derivative is there, however the file is split; repeated fields keep all their values."""
    draw = random.Random(4)
    records = []
    for i in range(60):
        inner = [f"<p>part {i} {j} " + "x" * draw.randint(0, 900) for j in range(draw.randint(1, 4))]
        page = draw.choice([warc.SEPARATOR, f"{warc.SEPARATOR}1.1\r\nContent-Length: 3\r\n\r\n"]).join(inner)
        records.append({
            "type": "response", "record_id": f"<urn:{i}>", "target_uri": f"http://h/{i}", "date": "2020-01-01T00:00:00Z",
            "content_type": None, "headers": {"WARC-Concurrent-To": f"<a{i}>\n<b{i}>\n<c{i}>"}, "damaged": False,
            "block": b"HTTP/1.1 200 OK\r\nContent-Type: text/html\r\n\r\n" + page.encode()})
    for number in range(2):
        own = [warc.format_record(r).replace(b"WARC/1.0", b"WARC/1.1", 1) for r in records[number * 30 : number * 30 + 30]]
        (tmp_path / f"{number}.warc").write_bytes(b"\r\n\r\n".join([*own, b""]))
    (tmp_path / "2.warc").write_bytes(warc.format_record({**records[0], "record_id": "<urn:plain>", "block": b""}))
    setting = "spark.sql.files.maxPartitionBytes"
    before = spark.conf.get(setting)
    spark.conf.set(setting, "4k")
    try:
        back = warc.read_warc(spark, str(tmp_path))
        found = {r["record_id"]: r for r in back.collect()}
        derived = warc.derivatives(back).collect()
    finally:
        spark.conf.set(setting, before)
    assert len(found) == 61 and not any(r["damaged"] for r in found.values())
    for r in records:
        assert bytes(found[r["record_id"]]["block"]) == r["block"]
        assert found[r["record_id"]]["headers"]["WARC-Concurrent-To"] == r["headers"]["WARC-Concurrent-To"]
    assert len(derived) == 122
    assert warc.format_record(records[0]).count(b"WARC-Concurrent-To: ") == 3


class _Reader(HTMLParser):
    """Titles, meta tags, links and texts by the standard library's parser."""

    def __init__(self, html):
        super().__init__(convert_charrefs=True)
        self.title, self.metas, self.links, self.words, self.skipping, self.in_title = "", [], [], [], 0, False
        self.feed(html)
        self.close()

    def handle_starttag(self, tag, attrs):
        attrs = dict(attrs)
        if tag == "meta":
            self.metas.append(attrs)
        if tag in ("a", "link", "img", "script", "iframe") and (attrs.get("href") or attrs.get("src")):
            self.links.append({"path": tag, "url": attrs.get("href") or attrs.get("src")})
        self.in_title |= tag == "title"
        self.skipping += tag in ("head", "script", "style")

    def handle_endtag(self, tag):
        self.in_title &= tag != "title"
        self.skipping -= tag in ("head", "script", "style")

    def handle_data(self, data):
        if self.in_title:
            self.title += data
        if not self.skipping:
            self.words += data.split()


def test_derivatives_equal_those_of_another_parser(spark):
    draw = random.Random(9)
    rows = []
    for i in range(80):
        parts = [f"<!DOCTYPE html><html><head><title>T{i} &amp; more</title><meta name='k' content=\"v > {i}\">"
                 f"<link rel=x href='/s{i}.css'><script src=/j{i}.js>var a = '<p>no</p>';</script></head><body>"]
        for j in range(draw.randint(0, 12)):
            word = f"w{i}x{j} &eacute;"
            parts.append(draw.choice([
                f"<p class='a b'>{word} <b>bold</b> text", f"<div><a href='/l{j}?a=1&amp;b=2'>{word}</a></div>",
                f"<ul><li>{word}<li>second</ul>", f" <!-- <a href=no>{word}</a> --> ", f"<img alt='>' src=\"/i{j}.png\"> ",
                f"<table><tr><td>{word}<td>cell</table>", f"<h2>{word}</h2>", f"loose {word}<br>"]))
        rows.append((i, f"http://h/{i}", "".join(parts) + "</body></html>"))
    found = {(r["page_id"], r["type"]): bytes(r["block"]).decode()
             for r in warc.derivatives(warc.responses(pages(spark, rows)), keep=["page_id"]).collect()}
    for i, url, html in rows:
        want, about = _Reader(html), json.loads(found[i, "metadata"])
        assert about["html"] == {"title": want.title, "metas": want.metas, "links": want.links}
        assert found[i, "conversion"].split() == want.words
        assert about["source_warc_headers"]["WARC-Target-URI"] == url
        assert about["payload_digest"] == about["source_warc_headers"]["WARC-Payload-Digest"] == warc.digest(html.encode())


SENTENCES = "A paragraph of plain text stands here. It has several sentences. They go on until the length counts. " * 3
LONG = f"<p>{SENTENCES}</p>"
MENU = "<ul>" + "".join(f"<li><a href=/{i}>Item {i}</a></li>" for i in range(8)) + "</ul>"
#: Pages of many shapes; wanted is one ``SENTENCES`` for each {LONG} in the main text.
SHAPES = [
    *[(f"<div class='{name}'><article>{LONG}{LONG}</article></div>", 2) for name in (
        "layout", "layout has-sidebar", "no-sidebar", "search-results", "with-header", "main-content share", "sidebar",
        "header-wrapper", "is-nav-open without-footer")],
    (f"<div id='comments-policy'><article>{LONG}</article></div>", 1),
    (f"<form id=aspnetForm action=/><main>{LONG}{LONG}</main></form>", 2),
    (f"<nav>{MENU}</nav><article>{LONG}<div class='share-buttons'>Share this. Share it now. Please do.</div>{LONG}</article>", 2),
    (f"<div class=sidebar><article>{LONG}</article></div><article>{LONG}{LONG}</article>", 2),
    (f"<div class=sidebar><article>{LONG}<div class=nav>{MENU}</div></article></div>", 1),
    (f"<article>{LONG}</article><section id=comments><article>{LONG}</article></section>", 1),
    (f"<div class=related-posts><article>{LONG}</article></div><main>{LONG}</main>", 1),
    (f"<div role=main>{LONG}{LONG}</div><div role=complementary>{LONG}</div>", 2),
    (f"<div class='post-content'>{LONG}</div><div class='site-footer'>{LONG}</div>", 1),
    (f"<div class=content data-id=comments>{LONG}{LONG}</div>", 2),
    (f"<table><tr><td>{MENU}<td>{LONG}{LONG}</table>", 2),
    (f"<header><h2>Site</h2>{MENU}</header>{LONG}{LONG}{LONG}<footer>{LONG}</footer>", 3),
    (f"<div class='cookie-banner'>{LONG}</div><div class='newsletter-signup'>{LONG}</div><article>{LONG}</article>", 1),
]


@pytest.mark.parametrize(("html", "wanted"), SHAPES)
def test_whole_extractions_of_many_shapes(html, wanted):
    assert main_text.extract(f"<html><body>{html}</body></html>") == "\n".join([SENTENCES.strip()] * wanted)


HOSTILE = ["<a ", "<!", '<a "', "<a '", "<div>", "</p>", "<b>", "<h1>", '<a ">"', '<a x="y', "<li>", "<title ", "<script ",
           "< ", "<td><b>", "<a '\">", "<!--", "-->", "<a =", "a='", "<meta " + "a" * 50]


@pytest.mark.parametrize("unit", HOSTILE)
def test_broken_markup_takes_linear_time(unit):
    """A tenth and the whole of a MB: far from the hundredfold time that a quadratic scan would take."""
    def seconds(size, tail):
        html = unit * (size // len(unit)) + tail
        began = time.process_time()
        main_text.blocks(html)
        warc.html_metadata(html)
        return time.process_time() - began

    for tail in ("", ">", '"'):
        assert seconds(1 << 20, tail) < 30 * max(seconds(1 << 20 >> 3, tail), 0.02)


def test_deep_and_stray_tags_take_linear_time():
    for make in (lambda n: "<div>" * n + "</p>" * n, lambda n: "<b>" * n + "<div>" + "<i>" * n + "</b>" * n,
                 lambda n: "<h1>" * n + "<li></li>" * n, lambda n: "<b><div>" * n + "<i>x</b>" * n):
        began = time.process_time()
        main_text.blocks(make(60_000))
        assert time.process_time() - began < 10


URLS = [None, "", "nothing", "http://", "http://A.Example.NET/en/1?x#y", "http://a.example.net/en", "http://example.net",
        "http://example.net/", "https://badexample.net/en/", "http://x.org/fr/1", "http://org/fr/", "http://x.org/FR/",
        "http://m.example.com/de/5#t", "http://www.listed.example.com/a/", "http://listed.example.com/a?b",
        "http://listed.example.com/ab", "x://y://z/", "http://u@h:8/p", "http://É.example.com/", "http://a\nb.net/\nen/"]


def brute_verdict(url, listed):
    host = path = ""
    if url and "://" in url:
        rest = url.split("://", 1)[1]
        host = re.split(r"[/?#]", rest)[0]
        path = re.split(r"[?#]", rest[len(host):])[0]
        host = re.sub("[A-Z]", lambda m: m[0].lower(), host)
    fits = [(len(h + p), h + p, v) for v, h, p in URL_RULES
            if (host == h or host.endswith("." + h)) and path.startswith(p)]
    if fits:
        _, rule, verdict = max(fits)
        return host, path, rule, verdict
    key = re.sub(r"^(?:www|m)\.", "", host) + path.rstrip("/") if host else None
    return host, path, None, "block" if key in listed else "allow"


def test_verdicts_equal_brute_force_without_python(spark, capsys):
    rows = [(i, u, "") for i, u in enumerate(URLS * 2)] + [(None, "http://q.example.com/1", "")]
    listed = spark.createDataFrame([("https://listed.example.com/a//",), (None,), ("junk",)] + [
        (f"http://filler{i}.example.com/{i}",) for i in range(300)], "url string")
    result = url_filter.judge(pages(spark, rows, ("host", "rule", "_url", "block")), URL_RULES, listed)
    assert not re.search("Python|Arrow|Pandas", result._jdf.queryExecution().toString())
    found = [(r["page_id"], r["host"], r["path"], r["rule"], r["verdict"]) for r in result.collect()]
    wanted = [(i, *brute_verdict(u, {"listed.example.com/a"})) for i, u, _ in rows]
    assert sorted(found, key=repr) == sorted(wanted, key=repr)


def test_full_filter_still_gives_exact_verdicts(spark, monkeypatch):
    monkeypatch.setattr(url_filter, "MAX_BLOCKS", 1)
    listed = spark.createDataFrame([(f"http://l{i}.example.com/",) for i in range(2000)], "url string")
    rows = [(i, f"http://{'l' if i % 2 else 'n'}{i}.example.com/", "") for i in range(2000)]
    found = url_filter.judge(pages(spark, rows), [], listed).collect()
    assert all(r["verdict"] == ("block" if r["page_id"] % 2 else "allow") for r in found)
    empty = spark.createDataFrame([], "url string")
    assert {r["verdict"] for r in url_filter.judge(pages(spark, rows), [], empty).collect()} == {"allow"}
    assert url_filter.judge(pages(spark, []), URL_RULES, empty).collect() == []
