"""WARC derivatives of hostile records, against plain readers, and in time in proportion to the input."""

import gzip
import html.parser
import io
import json
import random
import time
import zlib

import pytest

from catalyne.llm import warc


def made(body, *fields, kind="text/html; charset=utf-8", more=()):
    head = "".join(f"{k}: {v}\r\n" for k, v in (("Content-Type", kind), *fields))
    block = b"HTTP/1.1 200 OK\r\n" + head.encode() + b"\r\n" + body
    return warc.record([("WARC-Type", "response"), ("WARC-Record-ID", "<urn:x>"), ("WARC-Target-URI", "u"), *more], block)


def text(data):
    blocks = {r[0]: warc.parse(r[8])[1] for r in warc.derivatives(data)}
    return blocks["conversion"].decode() if "conversion" in blocks else None


@pytest.mark.parametrize("name", ["undefined", "idna", "punycode", "hex", "no-such", "unicode_escape", "utf-16", "rot13", "latin-1", "-", "utf_8_sig"])
def test_any_charset(name):
    assert text(made(b"<p>abc \\x \xff", kind=f"text/html; charset={name}")) is not None


def test_repeated_headers_stay():
    record = made(b"x", ("Set-Cookie", "a=1"), ("Set-Cookie", "b=2"), more=[("WARC-Concurrent-To", "<1>"), ("WARC-Concurrent-To", "<2>")])
    meta = json.loads(warc.parse(warc.derivatives(record)[0][8])[1])["Envelope"]
    assert [v for k, v in meta["WARC-Header-Metadata"] if k == "WARC-Concurrent-To"] == ["<1>", "<2>"]
    fields = meta["Payload-Metadata"]["HTTP-Response-Metadata"]["Headers"]
    assert [v for k, v in fields if k == "Set-Cookie"] == ["a=1", "b=2"]


def test_codings():
    page = "<p>one</p><p>zwei \u00fc</p>".encode()
    chunked = b"".join(b"%x;q\r\n%s\r\n" % (len(page[i : i + 7]), page[i : i + 7]) for i in range(0, len(page), 7)) + b"0\r\n\r\n"
    expected = "one\nzwei \u00fc"
    assert text(made(page)) == expected
    assert text(made(gzip.compress(page), ("Content-Encoding", "gzip"))) == expected
    assert text(made(zlib.compress(page), ("Content-Encoding", "deflate"))) == expected
    assert text(made(zlib.compress(page)[2:-4], ("Content-Encoding", "deflate"))) == expected
    assert text(made(chunked, ("Transfer-Encoding", "chunked"))) == expected
    assert text(made(page, ("Transfer-Encoding", "chunked"), ("Content-Encoding", "gzip"))) == expected  # said, but not so
    assert text(made(b"\x01", ("Content-Encoding", "br"))) is None
    assert text(made(b"\x89PNG", kind="image/png")) is None and text(made(b"a  b", kind="text/plain")) == "a  b"
    for cut in (3, 12, 20):
        assert text(made(gzip.compress(page)[:cut], ("Content-Encoding", "gzip"))) is not None


class Reader(html.parser.HTMLParser):
    """A plain reader by the library's tokenizer."""

    def __init__(self):
        super().__init__(convert_charrefs=False)
        self.out, self.links, self.skip, self.title = [], [], 0, None
        self.in_title = False

    def handle_starttag(self, tag, attrs):
        self.skip += tag in warc.HIDDEN
        self.in_title |= tag == "title"
        if tag in warc.BREAKS:
            self.out.append("\n")
        if tag in warc.HIDDEN:
            self.out.append(" ")
        if tag == "a" and "href" in dict(attrs):
            self.links.append(dict(attrs)["href"] or "")

    def handle_endtag(self, tag):
        self.skip -= tag in warc.HIDDEN
        self.in_title &= tag != "title"
        if tag in warc.BREAKS:
            self.out.append("\n")

    def handle_data(self, data):
        if not self.skip and not self.in_title:
            self.out.append(data)

    def handle_entityref(self, name):
        self.handle_data(f"&{name};")

    def handle_charref(self, name):
        self.handle_data(f"&#{name};")


def test_pages_against_a_plain_reader(spark):
    from conftest import SF

    rnd = random.Random(2)
    parts = ["<p>", "</p>", "one ", "two &amp; ", "<b>", "</b>", "<br/>", "<!-- no <p> -->", "<script>if (a < b) {}</script>", '<a href="/x?a=1&amp;b=2">', "</a>", "<A HREF=plain>", "<DIV class='a'>", "</div>", "\n", "&#233;", "\u00e9\u0130 ", "<style>p {}</style>"]
    pages = ["".join(rnd.choice(parts) for _ in range(40)) for _ in range(300)]
    pages += [r["html"] for r in spark.read.parquet(f"{SF}/pages.parquet").collect() if r["html"]]
    for page in pages:
        reader = Reader()
        reader.feed(page)
        reader.close()
        lines = (" ".join(x.split()) for x in html.unescape("".join(reader.out)).split("\n"))
        found, seen = warc.read_page(page)
        assert seen == "\n".join(x for x in lines if x)
        assert found["Links"] == reader.links


def test_query_against_plain_derivatives(spark):
    """Every row of the query, from the table by the readers above."""
    from conftest import SF

    rows = {(r["page_id"], r["kind"]): r for r in warc.query(spark, SF).collect()}
    pages = spark.read.parquet(f"{SF}/pages.parquet").collect()
    assert set(rows) == {(p["page_id"], k) for p in pages for k in ("metadata", "conversion")}
    for p in pages:
        body = (p["html"] or "").encode()
        for kind in ("metadata", "conversion"):
            r = rows[p["page_id"], kind]
            assert (r["target_uri"], r["source_digest"]) == (p["url"] or "", warc.digest(body))
        reader = Reader()
        reader.feed(p["html"] or "")
        reader.close()
        lines = (" ".join(x.split()) for x in html.unescape("".join(reader.out)).split("\n"))
        assert rows[p["page_id"], "conversion"]["block_digest"] == warc.digest("\n".join(x for x in lines if x).encode())


@pytest.mark.parametrize("piece", ["<a ", "<title>", "<", "<!", "<!--", "<p>", "<script>", "</script", "<a href=", "<meta name='", "&amp", "<a x=1 ", "<html lang", "<style><", "< "])
def test_a_megabyte_in_a_second(piece):
    page = piece * (1_000_000 // len(piece))
    began = time.perf_counter()
    warc.read_page(page)
    assert time.perf_counter() - began < 3


class Counted(str):
    """A page that counts how often it is looked at, and how far each look goes."""

    steps = 0

    def find(self, what, at=0):
        end = super().find(what, at)
        Counted.steps += (end if end >= 0 else len(self)) - at
        return end

    def index(self, what, at=0):
        end = super().index(what, at)
        Counted.steps += end - at
        return end


@pytest.mark.parametrize("a, b", [('<a p=">', '<a "q=">'), ("<a p='>", "<a 'q='>"), ('<a p="', "<a q='"), ("<a = ", "<a =\"x'"), ("<meta x=' ", '<title>"')])
def test_a_megabyte_of_two_kinds_of_tags(a, b):
    n = 1_000_000 // (len(a) + len(b))
    for page in (a * n + b * n, (a + b) * n, b * n + a * n):
        began = time.perf_counter()
        warc.read_page(page)
        assert time.perf_counter() - began < 3


def test_random_marks_in_steps_per_character():
    rnd = random.Random(9)
    for k in range(300):
        marks = rnd.choice(["<>=\"' a/", "<a \"'=>", "<a\"", "<!->a ", "<script></script>\"'="])
        page = Counted("".join(rnd.choice(marks) for _ in range(4000)))
        Counted.steps = 0
        warc.read_page(page)
        assert Counted.steps <= 3 * len(page) + 10


def test_marks_inside_quotes():
    found, seen = warc.read_page('<a title="a > b" href="x">link</a> <a href=\'y>z\' title=">">more</a><p title="<p>">end')
    assert seen == "link more\nend" and found["Links"] == ["x", "y>z"]
    assert warc.read_page('<a href="x>open')[1] == '<a href="x>open' or warc.read_page('<a href="x>open')[0]["Links"]


@pytest.mark.parametrize("seed", range(40))
def test_quoted_marks_against_a_plain_reader(seed):
    rnd = random.Random(seed)
    value = lambda: "".join(rnd.choice("ab <>='/&;") for _ in range(rnd.randint(0, 6)))
    page = "".join(rnd.choice([f'<a href="{value()}" title="{value()}">', f'<p class="{value()}">', "</a>", "word ", "<b>", f'<div id="{value()}" >', "<br/>"]) for _ in range(60))
    reader = Reader()
    reader.feed(page)
    reader.close()
    lines = (" ".join(x.split()) for x in html.unescape("".join(reader.out)).split("\n"))
    found, seen = warc.read_page(page)
    assert seen == "\n".join(x for x in lines if x) and found["Links"] == reader.links


def test_titles_of_pictures_are_not_the_page_s():
    found, seen = warc.read_page("<html><svg><title>icon</title></svg><title>Page</title><body>x<svg><title>other</title></svg>y")
    assert found["Title"] == "Page" and seen == "xy"


def test_bodies_that_grow_too_large(monkeypatch):
    monkeypatch.setattr(warc, "MOST_BYTES", 10_000)
    bomb = made(gzip.compress(b"a" * 10_000_000), ("Content-Encoding", "gzip"))
    rows = warc.derivatives(bomb)
    assert [r[0] for r in rows] == ["metadata"] and b"more than 10000 bytes" in rows[0][8]
    assert text(made(gzip.compress(b"a" * 9_000), ("Content-Encoding", "gzip"))) == "a" * 9_000


def test_records_without_a_name():
    bare = [warc.derivatives(made(x).replace(b"WARC-Record-ID: <urn:x>\r\n", b"")) for x in (b"one", b"two", b"one")]
    ids = [[r[1] for r in rows] for rows in bare]
    assert ids[0] == ids[2] and not set(ids[0]) & set(ids[1]) and len(set(ids[0])) == 2


def reader(content):
    """The records of a file that isn't damaged, one after another."""
    stream, out = io.BytesIO(gzip.decompress(content) if content.startswith(warc.GZIP) else content), []
    while head := stream.readline():
        lines = [head]
        while (line := stream.readline()) != b"\r\n":
            lines.append(line)
        n = next(int(x.split(b":")[1]) for x in lines if x.lower().startswith(b"content-length"))
        out.append(b"".join(lines) + b"\r\n" + stream.read(n) + stream.read(4))
    return out


def test_files_against_a_plain_reader(monkeypatch):
    rnd = random.Random(1)
    records = [made(rnd.randbytes(rnd.choice([0, 1, 50, 5000]))) for _ in range(200)]
    whole, single, members = b"".join(records), gzip.compress(b"".join(records)), b"".join(map(gzip.compress, records))
    for block in (7, 100, 1 << 20):
        monkeypatch.setattr(warc, "BLOCK", block)
        assert [*warc.members(whole)] == [*warc.members(single)] == [*warc.members(members)] == reader(whole) == reader(single)
    damaged = bytearray(members)
    at = len(b"".join(map(gzip.compress, records[:50]))) + 30
    damaged[at : at + 4] = b"\xff\xff\xff\xff"
    got = [*warc.members(bytes(damaged))]
    assert set(records) - {records[50]} <= set(got)


def test_large_files_take_time_in_proportion():
    one = made(random.Random(3).randbytes(20_000))
    times = []
    for n in (500, 5000):
        began = time.perf_counter()
        assert sum(1 for _ in warc.members(gzip.compress(one, 1) * n)) == n
        times.append(time.perf_counter() - began)
    assert times[1] < 30 * times[0] + 1
    assert sum(1 for _ in warc.members(one * 5000)) == 5000
