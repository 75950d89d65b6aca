"""Derivatives of web captures: metadata and plain-text conversion records.

Each response gives one record of either type. Both refer to the response by its
record id, carry its address, date and payload digest over, and name each other.
"""

from __future__ import annotations

import base64
import hashlib
import html as entities
import re
import uuid
from collections.abc import Iterator
from urllib.parse import urljoin

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from siltstone.llm.tables import row_slices, short_batches

HIDDEN = re.compile(r"<(?:(script|style|noscript|template)\b|!--)", re.I)
CLOSED = {
    name: re.compile(rf"</{name}\s*>", re.I)
    for name in ("script", "style", "noscript", "template")
}
CLOSED[""] = re.compile("-->")
BLOCK = re.compile(
    r"</?(?:address|article|aside|blockquote|body|br|dd|div|dl|dt|fieldset|figure|footer"
    r"|form|h[1-6]|head|header|hr|html|li|main|nav|ol|p|pre|section|table|td|th|title|tr|ul)"
    r"\b[^<>]*>",
    re.I,
)
TAG = re.compile(r"<[^<>]*>")
BLANKS = re.compile(r"[^\S\n]+")
LINES = re.compile(r" ?\n[ \n]*")
LINK = re.compile(
    r"""<(a|area|img|link|script|iframe)\b[^<>]*?\s(?:href|src)\s*=\s*"""
    r"""(?:"([^"]*)"|'([^']*)'|([^\s>]+))""",
    re.I,
)
TITLE = re.compile(r"<title\b[^<>]*>(.*?)(?:</title\s*>|\Z)", re.S | re.I)

SPACE = uuid.uuid5(uuid.NAMESPACE_URL, "urn:warc-derivatives")


def without_hidden(markup: str) -> str:
    """The page without scripts, styles, templates and comments that are closed.

    One pass: once a kind of opener has nothing that closes it, no other of its kind has.
    """
    kept, at, unclosed = [], 0, set()
    opener = HIDDEN.search(markup)
    while opener:
        name, after = (opener[1] or "").lower(), opener.end()
        closed = None if name in unclosed else CLOSED[name].search(markup, after)
        if closed:
            kept += [markup[at : opener.start()], " "]
            at = after = closed.end()
        else:
            unclosed.add(name)
        opener = HIDDEN.search(markup, after)
    return "".join([*kept, markup[at:]])


def plain_text(markup: str) -> str:
    """The text of a page: a line per block, entities resolved, blanks made one.

    A tag ends at the next one's start, closed or not.
    """
    text = BLOCK.sub("\n", without_hidden(markup))
    text = entities.unescape(TAG.sub("", text))
    return LINES.sub("\n", BLANKS.sub(" ", text)).strip()


def one_line(value: str) -> str:
    return " ".join(value.split())


def digest(block: bytes) -> str:
    return "sha1:" + base64.b32encode(hashlib.sha1(block).digest()).decode()


def record(headers: list[tuple[str, str | None]], block: bytes) -> bytes:
    """A WARC/1.1 record; headers without a value are left out."""
    lines = ["WARC/1.1", *[f"{k}: {v}" for k, v in headers if v is not None]]
    lines.append(f"Content-Length: {len(block)}")
    return "\r\n".join(lines).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def urn(*parts: str) -> str:
    return f"<urn:uuid:{uuid.uuid5(SPACE, chr(0).join(parts))}>"


COLUMNS = (
    "response_id string, record_type string, record_id string, refers_to string, "
    "related_id string, target_uri string, date string, source_digest string, "
    "block_digest string, content_length long, record binary"
)


def derive(responses: DataFrame) -> DataFrame:
    """Two rows per response: (key, ``COLUMNS``), for types metadata and conversion.

    ``responses``: key, record_id, target_uri, date, headers (text of the HTTP header
    lines) and payload (text). A null payload is empty; null headers, address or date are
    left out of the records. A null record id, and those that repeat, are carried over as
    they are: what is derived then has ids that follow from the other fields too.
    """
    short_batches(responses)
    fields = ["key", "record_id", "target_uri", "date", "headers", "payload"]
    names = ["key", *[c.split()[0] for c in COLUMNS.split(", ")]]
    schema = f"key {responses.schema['key'].dataType.simpleString()}, {COLUMNS}"

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in row_slices(batches, 128):
            rows = []
            for values in zip(*(c.to_pylist() for c in batch.columns)):
                rows += derived_records(*values)
            kinds = [batch.schema.field(0).type, *[pa.string()] * 9, pa.int64(), pa.binary()]
            arrays = [pa.array(c, k) for c, k in zip(zip(*rows), kinds)]
            yield pa.RecordBatch.from_arrays(arrays, names=names)

    return responses.select(*fields).mapInArrow(build, schema)


def derived_records(key, record_id, uri, date, headers, payload) -> list[tuple]:
    payload = payload or ""
    source = digest(payload.encode("utf-8", "replace"))
    known = (record_id or "", uri or "", date or "", source)
    ids = {t: urn(t, *known) for t in ("metadata", "conversion")}
    text = plain_text(payload).encode("utf-8", "replace")
    title = TITLE.search(payload)
    fields = [
        ("derived-record", ids["conversion"]),
        ("derived-digest", digest(text)),
        ("source-digest", source),
        ("source-length", str(len(payload.encode("utf-8", "replace")))),
        *[("source-header", one_line(h)) for h in (headers or "").splitlines() if h.strip()],
    ]
    if title:
        fields.append(("title", one_line(entities.unescape(TAG.sub("", title[1])))))
    for m in LINK.finditer(without_hidden(payload)):
        target = one_line(entities.unescape(m[2] or m[3] or m[4] or ""))
        try:
            target = urljoin(uri or "", target)
        except ValueError:
            pass  # kept as it is written
        fields.append(("outlink", f"{target} {m[1].lower()}"))
    about = "".join(f"{k}: {v}\r\n" for k, v in fields).encode("utf-8", "replace")
    rows = []
    for kind, block, content in (
        ("metadata", about, "application/warc-fields"),
        ("conversion", text, "text/plain; charset=utf-8"),
    ):
        other = ids["conversion" if kind == "metadata" else "metadata"]
        own = digest(block)
        whole = record(
            [
                ("WARC-Type", kind),
                ("WARC-Record-ID", ids[kind]),
                ("WARC-Refers-To", record_id),
                ("WARC-Concurrent-To", other),
                ("WARC-Target-URI", None if uri is None else one_line(uri)),
                ("WARC-Date", date),
                ("WARC-Source-Digest", source),
                ("WARC-Block-Digest", own),
                ("Content-Type", content),
            ],
            block,
        )
        row = (record_id, kind, ids[kind], record_id, other, uri, date, source, own)
        rows.append((key, *row, len(block), whole))
    return rows


def page_responses(pages: DataFrame, date: str = "2024-01-01T00:00:00Z") -> DataFrame:
    """Rows of a pages table (page_id, url, html) as responses of one crawl date.

    The table has neither record ids nor headers: ids follow from a row's content, and
    the headers are those of an HTML page. Repeated rows are the same capture.
    """
    content = F.concat_ws("\u0000", F.col("page_id").cast("string"), "url", "html")
    hexes = F.md5(content)
    cuts = [(1, 8), (9, 4), (13, 4), (17, 4), (21, 12)]
    dashed = F.concat_ws("-", *[F.substring(hexes, a, n) for a, n in cuts])
    size = F.octet_length(F.coalesce("html", F.lit("")))
    return pages.select(
        F.col("page_id").alias("key"),
        F.concat(F.lit("<urn:uuid:"), dashed, F.lit(">")).alias("record_id"),
        F.col("url").alias("target_uri"),
        F.lit(date).alias("date"),
        F.concat(
            F.lit("HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: "),
            size.cast("string"),
        ).alias("headers"),
        F.col("html").alias("payload"),
    )


def write_records(records: DataFrame, path: str) -> None:
    """Write the records as gzip files that can be read one record after the other."""
    value = F.col("record").cast("string")
    # The writer ends each row with the line feed that is taken off here.
    value = F.substring(value, F.lit(1), F.char_length(value) - 1)
    records.select(value.alias("value")).write.option("compression", "gzip").option(
        "lineSep", "\n"
    ).text(path)


def read_records(blob: bytes) -> Iterator[tuple[dict[str, str], bytes]]:
    """(headers, block) of the records in the bytes of a file, decompressed."""
    at = 0
    while at < len(blob):
        end = blob.index(b"\r\n\r\n", at)
        first, *lines = blob[at:end].decode().split("\r\n")
        if first != "WARC/1.1":
            raise ValueError(f"not a record at {at}")
        headers = dict(line.split(": ", 1) for line in lines)
        start = end + 4
        stop = start + int(headers["Content-Length"])
        yield headers, blob[start:stop]
        at = stop + 4
