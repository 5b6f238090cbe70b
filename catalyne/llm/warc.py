"""WARC derivatives: of each response record, a metadata record and a plain-text conversion record that refer to it."""

from __future__ import annotations

import base64
import hashlib
import html
import json
import re
import uuid
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import small_batches

VERSION = "WARC/1.1"
#: The date of records made from a table that has none.
DATE = "2024-01-01T00:00:00Z"
RECORD = "page_id long, kind string, record_id string, refers_to string, target_uri string, date string, content_type string, block_digest string, source_digest string, record binary"

#: Elements that no reader sees, and those that begin a line.
HIDDEN = {tag: re.compile(f"</{tag}", re.I) for tag in ("script", "style", "template", "noscript")}
BREAKS = "p div h1 h2 h3 h4 h5 h6 ul ol li table tr article section header footer nav main aside blockquote pre form br hr".split()
BREAKS = frozenset(BREAKS).union("/" + x for x in BREAKS)
#: Tags that a page's metadata come from, or end a title.
TOLD = BREAKS | {"title", "/title", "body", "html", "meta", "a", "svg", "/svg"}
#: A tag's name, what stands between attributes, an attribute's name, what comes before its value, and a value without quotes;
#: all are matched in place, so that a page is read once from its start to its end.
NAME, GAP, ATTRIBUTE = re.compile(r"/?[a-zA-Z][^\s/>]*"), re.compile(r"[\s/]*+"), re.compile(r"=?[^\s/>=]*+")
EQUALS, BARE = re.compile(r"\s*+=\s*+"), re.compile(r"[^\s>]*+")
#: Types of which a text can be made, besides text/*.
TEXTUAL = re.compile(r"(?:application/(?:xhtml\+xml|xml|json|javascript|rss\+xml|atom\+xml)|[\w.-]+/[\w.-]+\+(?:xml|json))$")
MARKUP = re.compile(r"(?:text/html|text/xml|application/xhtml\+xml|application/xml|.*\+xml)$")
#: The start of a gzip member, of a record or either, and a record's length.
GZIP = b"\x1f\x8b\x08"
NEXT = re.compile(rb"\x1f\x8b\x08|WARC/\d\.\d\r\n")
LENGTH = re.compile(rb"\r\ncontent-length[ \t]*:[ \t]*(\d+)[ \t]*\r\n", re.I)
#: Bytes that a compressed body may become; a text beyond that is not held, and the metadata say so.
MOST_BYTES = 256 << 20
#: Bytes of a gzip member that are taken at once, and of a file that are handed on at once.
BLOCK, HANDED = 1 << 20, 16 << 20


class Headers(list):
    """Header fields in their order, repeated ones too, as pairs; by a name in lower case, the first of that name."""

    def __getitem__(self, key):
        if not isinstance(key, str):
            return super().__getitem__(key)
        return next(v for k, v in self if k.lower() == key)

    def get(self, name: str, default: str = "") -> str:
        return next((v for k, v in self if k.lower() == name), default)


def digest(data: bytes) -> str:
    return "sha1:" + base64.b32encode(hashlib.sha1(data).digest()).decode()


def record_id(*parts: str) -> str:
    """A name that the same input always gets."""
    return f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, chr(10).join(parts))}>"


def one_line(x: str) -> str:
    return re.sub(r"[\r\n]+", " ", x) if "\n" in x or "\r" in x else x


def record(headers: list[tuple[str, str]], block: bytes) -> bytes:
    lines = [VERSION, *(f"{k}: {one_line(v)}" for k, v in headers), f"Content-Length: {len(block)}"]
    return "\r\n".join(lines).encode("utf-8", "replace") + b"\r\n\r\n" + block + b"\r\n\r\n"


def fields(lines: list[str]) -> Headers:
    """Header fields as they come, repeated ones too; a line that begins with white space goes on with the one before."""
    out = Headers()
    for x in lines:
        if x[:1] in (" ", "\t") and out:
            out[-1] = (out[-1][0], f"{out[-1][1]} {x.strip()}")
        elif ":" in x:
            name, _, value = x.partition(":")
            out.append((name.strip(), value.strip()))
    return out


def parse(data: bytes) -> tuple[Headers, bytes, bytes]:
    """(headers, block, what follows) of a record at the start of data. ValueError: not a record."""
    head, sep, rest = data.partition(b"\r\n\r\n")
    first, *lines = head.decode("utf-8", "replace").split("\r\n")
    if not sep or not first.startswith("WARC/"):
        raise ValueError("not a WARC record")
    headers = fields(lines)
    length = headers.get("content-length")
    if not (length.isascii() and length.isdigit()) or len(length) > 18:
        raise ValueError("a record without a length")
    n = int(length)
    if n > len(rest):
        raise ValueError("the record is cut short")
    return headers, rest[:n], rest[n:].removeprefix(b"\r\n\r\n")


def response(page_id: int | None, url: str | None, page: str | None) -> bytes:
    """The response record of a page."""
    body = (page or "").encode("utf-8", "replace")
    block = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: %d\r\n\r\n" % len(body) + body
    headers = [("WARC-Type", "response"), ("WARC-Record-ID", record_id("response", str(page_id), url or "", digest(body))), ("WARC-Date", DATE), ("WARC-Target-URI", url or "")]
    return record([*headers, ("WARC-Block-Digest", digest(block)), ("WARC-Payload-Digest", digest(body)), ("Content-Type", "application/http; msgtype=response")], block)


def tag_attributes(page: str, at: int, last: dict[str, int]) -> tuple[dict[str, str], int]:
    """(a tag's attributes, where the page goes on after it) from the end of its name on; of repeated attributes, the first. A >
    inside quotes doesn't end a tag. last: the last place of each quote, so that one that is never closed isn't looked for
    and counts as a character. Place -1: the page ends inside the tag. Every step goes on where the one before stopped."""
    out: dict[str, str] = {}
    n = len(page)
    while True:
        at = GAP.match(page, at).end()
        if at >= n:
            return out, -1
        if page[at] == ">":
            return out, at + 1
        name = ATTRIBUTE.match(page, at)
        at, value = name.end(), ""
        if equals := EQUALS.match(page, at):
            at = equals.end()
            quote = page[at : at + 1]
            if last.get(quote, -1) > at:
                end = page.index(quote, at + 1)
                value, at = page[at + 1 : end], end + 1
            else:
                bare = BARE.match(page, at)
                value, at = bare[0], bare.end()
        out.setdefault(name[0].lower(), html.unescape(value))


def tokens(page: str) -> Iterator[tuple[str, str, dict[str, str]]]:
    """("text", its characters, {}) and ("tag", its name in lower case with / before an end, its attributes), in one pass.
    Comments, declarations and what stands in hidden elements are left out.

    Every search goes on from where the last one ended, and what isn't found ends the pass, so that the work is in
    proportion to the page."""
    at, n, last, none = 0, len(page), {q: page.rfind(q) for q in "\"'"}, {}
    while at < n:
        begin = page.find("<", at)
        if begin < 0:
            yield "text", page[at:], none
            return
        if begin > at:
            yield "text", page[at:begin], none
        if name := NAME.match(page, begin + 1):
            own, at = (none, name.end() + 1) if page.startswith(">", name.end()) else tag_attributes(page, name.end(), last)
            if at < 0:
                yield "text", page[begin:], none
                return
            tag = name[0].lower()
            yield "tag", tag, own
            if tag in HIDDEN and page[at - 2] != "/":
                close = HIDDEN[tag].search(page, at)
                at = close.start() if close else n
        elif page.startswith("<!--", begin):
            end = page.find("-->", begin + 4)
            at = end + 3 if end >= 0 else n
        elif page.startswith(("<!", "<?"), begin):
            end = page.find(">", begin)
            at = end + 1 if end >= 0 else n
        else:
            yield "text", "<", none
            at = begin + 1


def read_page(page: str) -> tuple[dict, str]:
    """(title, language, metas and links; what a reader sees): no title, scripts, styles or comments; a line for each block;
    entities resolved. A title that isn't closed ends with the next block; those of pictures inside the page are no titles
    of it, and aren't seen either."""
    seen, title, in_title, pictures = [], [], False, 0
    found: dict = {"Title": None, "Lang": None, "Metas": [], "Links": []}
    for kind, what, own in tokens(page):
        if kind == "text":
            (title if in_title else seen).append(what)
            continue
        if what not in TOLD:
            if what in HIDDEN:
                seen.append(" ")
            continue
        block = what in BREAKS
        if what in ("svg", "/svg"):
            pictures = pictures + 1 if what == "svg" else max(0, pictures - 1)
        elif what == "title":
            in_title = found["Title"] is None or pictures > 0
        elif what == "/title" or block or what == "body":
            if in_title and pictures == 0:
                found["Title"] = " ".join(html.unescape("".join(title)).split())
            elif in_title:
                title.clear()
            in_title = False
        if what == "html" and found["Lang"] is None:
            found["Lang"] = own.get("lang")
        elif what == "meta":
            if name := own.get("name") or own.get("property"):
                found["Metas"].append({"name": name, "content": own.get("content", "")})
        elif what == "a" and (link := own.get("href")) is not None:
            found["Links"].append(link)
        if block:
            seen.append("\n")
    lines = (" ".join(x.split()) for x in html.unescape("".join(seen)).split("\n") if x)
    return found, "\n".join(x for x in lines if x)


class TooLarge(ValueError):
    """A body that becomes larger than can be held."""


def decoded(body: bytes, http: Headers) -> tuple[bytes, list[str]]:
    """The body without its transfer and content codings, and the codings that couldn't be undone: chunked, gzip and
    deflate are known. A damaged body stays as far as it can be read."""
    names = [x.strip().lower() for h in ("transfer-encoding", "content-encoding") for k, v in http if k.lower() == h for x in v.split(",")]
    left = []
    for name in [x for x in names if x == "chunked"] + [x for x in reversed(names) if x != "chunked"]:
        if name == "chunked":
            body = unchunked(body)
        elif name in ("gzip", "x-gzip", "deflate"):
            try:
                body = inflated(body, 31) if name != "deflate" else inflated(body, 15) or inflated(body, -15) or body
            except TooLarge:
                left.append(f"{name}: more than {MOST_BYTES} bytes")
                break
        elif name not in ("identity", ""):
            left.append(name)
    return body, left


def unchunked(body: bytes) -> bytes:
    """The chunks' bytes. A body that isn't chunked, though said to be, stays as it is."""
    out, at = [], 0
    while m := CHUNK.match(body, at):
        size = int(m[1], 16)
        if not size:
            break
        out.append(body[m.end() : m.end() + size])
        at = m.end() + size
        at += 2 * body.startswith(b"\r\n", at)
    return b"".join(out) if at or CHUNK.match(body) else body


CHUNK = re.compile(rb"([0-9a-fA-F]{1,15})[ \t]*(?:;[^\r\n]*)?\r\n")


def inflated(body: bytes, kind: int) -> bytes:
    """What can be decompressed; a body that isn't compressed, though said to be, stays as it is."""
    held, size = [], 0
    for x, _ in inflate(memoryview(body), 0, kind):
        held.append(x)
        size += len(x)
        if size > MOST_BYTES:
            raise TooLarge
    out = b"".join(held)
    return out or (body if kind == 31 and not body.startswith(GZIP) else b"")


def inflate(data: memoryview, at: int, kind: int = 31) -> Iterator[tuple[bytes, int]]:
    """(bytes, where the input goes on) of the compressed member at a place, a block at a time, up to its end or damage."""
    z = zlib.decompressobj(kind)
    while at < len(data) and not z.eof:
        part, before = data[at : at + BLOCK], z.copy()
        try:
            while True:
                out = z.decompress(z.unconsumed_tail or part, HANDED)
                yield out, at + len(part) - len(z.unused_data) - len(z.unconsumed_tail)
                if not z.unconsumed_tail:
                    break
            at += len(part) - len(z.unused_data)
        except zlib.error:
            if len(part) > 1:  # what can be read of the block
                yield from upto_damage(before, part, at)
            return


def upto_damage(z, part: memoryview, at: int) -> Iterator[tuple[bytes, int]]:
    try:
        for i in range(0, len(part), 64):
            yield z.decompress(part[i : i + 64]), at + i
    except zlib.error:
        return


def text_of(data: bytes, content_type: str) -> str:
    """The characters of a body, in its charset; a charset that isn't known, or can't be used, counts as UTF-8. What can't
    be read becomes the replacement character."""
    found = re.search(r"charset\s*=\s*[\"']?([\w.:-]+)", content_type, re.I)
    try:
        return data.decode(found[1] if found else "utf-8", "replace")
    except (LookupError, ValueError):  # of which errors of Unicode are a kind
        return data.decode("utf-8", "replace")


def derivatives(data: bytes) -> list[tuple]:
    """Of a response record, (kind, id, refers-to, target, date, content type, block digest, source's digest, record) of its
    metadata and, where its body is a text, its conversion. Other records and damaged ones have none."""
    try:
        headers, block, _ = parse(data)
    except ValueError:
        return []
    if headers.get("warc-type").lower() != "response":
        return []
    head, _, body = block.partition(b"\r\n\r\n")
    status, *lines = head.decode("latin-1").split("\r\n")
    http = fields(lines)
    content_type = http.get("content-type")
    kind_of = content_type.partition(";")[0].strip().lower() or "text/html"
    entity, left = decoded(body, http)
    source, target, date = headers.get("warc-record-id"), headers.get("warc-target-uri"), headers.get("warc-date", DATE)
    payload = headers.get("warc-payload-digest") or digest(body)
    found, text = None, None
    if not left and (kind_of.startswith("text/") or TEXTUAL.match(kind_of)):
        text = text_of(entity, content_type)
        if MARKUP.match(kind_of):
            found, text = read_page(text)
    meta = {
        "Envelope": {"WARC-Header-Metadata": headers, "Payload-Metadata": {"HTTP-Response-Metadata": {
            "Status": status, "Headers": http, "Entity-Digest": payload, "Entity-Length": len(body), "HTML-Metadata": found}}},
    }
    if left:
        meta["Envelope"]["Codings-Left"] = left
    name = source or digest(data)  # a record without a name of its own is known by its bytes
    made = [("metadata", "application/json", json.dumps(meta, ensure_ascii=False, sort_keys=True).encode("utf-8", "replace"))]
    if text is not None:
        made.append(("conversion", "text/plain; charset=utf-8", text.encode("utf-8", "replace")))
    out = []
    for kind, kept, block in made:
        own = [("WARC-Type", kind), ("WARC-Record-ID", record_id(kind, name)), ("WARC-Date", date), ("WARC-Target-URI", target), ("WARC-Refers-To", source)]
        own += [("WARC-Refers-To-Target-URI", target), ("WARC-Refers-To-Date", date), ("WARC-Source-Payload-Digest", payload), ("WARC-Block-Digest", digest(block)), ("Content-Type", kept)]
        out.append((kind, own[1][1], source, target, date, kept, digest(block), payload, record(own, block)))
    return out


def responses(pages: DataFrame) -> DataFrame:
    """(page_id, record): a response record for each row of pages (page_id, url, html). Null urls and pages are empty."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            made = [response(*x) for x in zip(*(c.to_pylist() for c in b.columns))]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(made, pa.binary())], ["page_id", "record"])

    small_batches(pages.sparkSession)
    return pages.select(F.col("page_id").cast("long"), F.col("url").cast("string"), F.col("html").cast("string")).mapInArrow(run, "page_id long, record binary")


def derive(records: DataFrame) -> DataFrame:
    """The metadata of every response among records (page_id, record), with all header fields of the record and of HTTP as
    lists of pairs, and the conversion of those whose body is a text.

    Chunked, gzip and deflate bodies are read; other codings, bodies that become larger than MOST_BYTES, and types that are no
    texts, have metadata alone, which name the codings that are left. Null and
    damaged records and those of other kinds have none; repeated rows give repeated records, since a name depends on the
    source alone; a page of any length is read in time in proportion to it; an empty table gives no rows; other columns
    are ignored."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kinds = [pa.int64(), *[pa.string()] * 8, pa.binary()]
        names = [x.split()[0] for x in RECORD.split(", ")]
        for b in batches:
            rows = [(page, *d) for page, data in zip(*(c.to_pylist() for c in b.columns)) if data is not None for d in derivatives(data)]
            cols = zip(*rows) if rows else [()] * len(names)
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, kinds)], names)

    small_batches(records.sparkSession)
    return records.select(F.col("page_id").cast("long"), "record").mapInArrow(run, RECORD)


def read_warc(spark: SparkSession, path: str) -> DataFrame:
    """(page_id, record) of the records in WARC files, plain, or gzip by record or whole; page_id: null. A file is one
    task's work, which holds its bytes and, beyond them, one record and what is handed on at once. Damage is passed over,
    up to the next record or member."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def batch(held: list[bytes]) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.nulls(len(held), pa.int64()), pa.array(held, pa.binary())], ["page_id", "record"])

        for b in batches:
            for i in range(b.num_rows):
                held, size = [], 0
                for one in members(b.column(0)[i].as_buffer()):
                    held.append(one)
                    size += len(one)
                    if size > HANDED:
                        yield batch(held)
                        held, size = [], 0
                if held:
                    yield batch(held)

    return spark.read.format("binaryFile").load(path).select("content").mapInArrow(run, "page_id long, record binary")


def members(content: bytes | pa.Buffer) -> Iterator[bytes]:
    """The records of a file's content: those of every gzip member, and plain ones. Bytes that are neither are passed over,
    up to the next record or member. Places are walked by their offset; nothing is copied but records."""
    view, at = memoryview(content).cast("B"), 0
    while at < len(view):
        if view[at : at + 3] == GZIP:
            held, last = bytearray(), at
            for out, last in inflate(view, at):
                held += out
                done = 0
                while (end := record_end(held, done)) is not None and end + 4 <= len(held):
                    yield bytes(held[done:end])
                    done = end
                if done:
                    del held[:done]
            yield from plain(held)
            at = last if last > at else at + 3
            if not ended(view, at):
                at = following(view, at)
        elif (end := record_end(view, at)) is not None:
            yield bytes(view[at:end])
            at = end
        else:
            at = following(view, at + 1)


def ended(view: memoryview, at: int) -> bool:
    return at >= len(view) or view[at : at + 3] == GZIP or view[at : at + 5] == b"WARC/"


def following(view: memoryview, at: int) -> int:
    """Where the next record or gzip member begins, from a place on."""
    found = NEXT.search(view, at)
    return found.start() if found else len(view)


def plain(data: bytearray) -> Iterator[bytes]:
    """The records in what a gzip member leaves: behind damage, up to the next record each."""
    at = 0
    while at < len(data):
        end = record_end(data, at)
        if end is not None:
            yield bytes(data[at:end])
            at = end
        else:
            found = HEAD.search(data, at + 1)
            at = found.start() if found else len(data)


HEAD = re.compile(rb"WARC/\d\.\d\r\n")
BLANK = re.compile(rb"\r\n\r\n")


def record_end(data: memoryview | bytearray | bytes, at: int) -> int | None:
    """Where the record at a place ends; None: no record, or a damaged one, that holds the start of another in its headers or
    is longer than what is left."""
    if bytes(data[at : at + 5]) != b"WARC/":
        return None
    blank = BLANK.search(data, at)
    if not blank or HEAD.search(data, at + 1, blank.start()):
        return None
    length = LENGTH.search(data, at, blank.start() + 2)
    end = blank.end() + int(length[1]) if length and len(length[1]) < 19 else len(data) + 1
    if end > len(data):
        return None
    return end + 4 if bytes(data[end : end + 4]) == b"\r\n\r\n" else end


def query(spark, sf_dir: str) -> DataFrame:
    rows = derive(responses(spark.read.parquet(f"{sf_dir}/pages.parquet")))
    digests = [F.length("record").cast("long").alias("n_bytes"), F.sha2("record", 256).alias("record_sha256")]
    return rows.select("page_id", "kind", "record_id", "refers_to", "target_uri", "block_digest", "source_digest", *digests)
