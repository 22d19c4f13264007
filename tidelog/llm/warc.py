"""WARC derivatives: each response becomes a metadata record and, if it is text, a plain-text conversion record.

Both refer to the response by WARC-Refers-To and to each other, and keep its target, date and payload digest. The metadata
record is JSON: the WARC and HTTP headers of the source, title, description, and links with their attribute and text. The
conversion record is the text as a reader would see it, one line per block element. Ids are name-based UUIDs of the
response's id, so a repeated task makes the same records.

Defined results: a null block is empty; a block without an HTTP head is all body; a body that does not decode keeps
replacement characters; a content type other than HTML, XHTML or plain text has no conversion record; equal responses
give equal records, each its own; an empty table gives an empty result. Extra columns are not read.
"""

from __future__ import annotations

import base64
import hashlib
import html
import json
import re
import uuid
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidelog.llm.scratch import ship

_MARKUP = re.compile(
    r"<!--.*?(?:-->|\Z)|<(script|style|template)\b.*?(?:</\1\s*>|\Z)|<(/?)([a-zA-Z][a-zA-Z0-9:-]*)((?:[^<>\"']|\"[^\"]*\"|'[^']*')*+)>|<[!?][^>]*>",
    re.DOTALL | re.IGNORECASE,
)
_ATTRIBUTE = re.compile(r"([^\s=\"'/<>]+)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'<>]+))")
#: Elements that begin a new line; fixed values.
_BLOCK = frozenset(
    "address article aside blockquote body br dd details div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 head header hr html li main nav ol "
    "option p pre section summary table td th title tr ul".split()
)
#: Attributes that hold a link, by element; fixed values.
_LINKS = {"a": "href", "area": "href", "link": "href", "img": "src", "script": "src", "iframe": "src", "source": "src", "video": "src", "audio": "src", "form": "action"}

FIELDS = ("record_id", "warc_type", "refers_to", "concurrent_to", "target_uri", "warc_date", "content_type", "payload_digest", "block_digest", "content_length", "content")


def digest(content: bytes) -> str:
    return "sha1:" + base64.b32encode(hashlib.sha1(content, usedforsecurity=False).digest()).decode()


def read_html(page: str) -> tuple[str, str, list[dict[str, str]]]:
    """Plain text, title and links of a page."""
    parts, links, title, at, in_title, link = [], [], [], 0, False, None
    for m in _MARKUP.finditer(page):
        text = page[at : m.start()]
        at = m.end()
        parts.append(text)
        if in_title:
            title.append(text)
        if link is not None:
            link["text"] += text
        name = (m[3] or "").lower()
        if not name:
            continue
        closing = bool(m[2])
        if name in _BLOCK:
            parts.append("\n")
        if name == "title":
            in_title = not closing
        elif name == "a" and closing:
            link = None
        elif not closing and name in _LINKS:
            found = {a[1].lower(): a[2] or a[3] or a[4] or "" for a in _ATTRIBUTE.finditer(m[4])}
            if _LINKS[name] in found:
                link_ = {"path": f"{name.upper()}@/{_LINKS[name]}", "url": html.unescape(found[_LINKS[name]]), "text": ""}
                links.append(link_)
                link = link_ if name == "a" else link
    parts.append(page[at:])
    lines = (" ".join(line.split()) for line in html.unescape("".join(parts).replace("\r", "\n")).split("\n"))
    for each in links:
        each["text"] = " ".join(html.unescape(each["text"]).split())
    return "\n".join(line for line in lines if line), " ".join(html.unescape("".join(title)).split()), links


def split_http(block: bytes) -> tuple[str, list[tuple[str, str]], bytes]:
    """Status line, headers and body."""
    head, mark, body = block.partition(b"\r\n\r\n")
    if not mark or not head.startswith(b"HTTP/"):
        return "", [], block
    status, *lines = head.decode("latin-1").split("\r\n")
    return status, [(name.strip(), value.strip()) for name, _, value in (line.partition(":") for line in lines)], body


def name_id(record_id: str, kind: str) -> str:
    return f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, f'{record_id}#{kind}')}>"


def derive_one(record_id: str, target: str | None, date: str | None, headers: dict[str, str], block: bytes) -> list[tuple]:
    """The records of one response, in the order of FIELDS."""
    status, http, body = split_http(block)
    kind = next((v for k, v in http if k.lower() == "content-type"), "text/html" if body[:512].lstrip()[:1] == b"<" else "")
    charset = re.search(r"charset=[\"']?([\w-]+)", kind, re.IGNORECASE)
    payload = digest(body)
    wanted = "html" in kind.lower() or kind.lower().startswith("text/plain")
    try:
        text = body.decode(charset[1] if charset else "utf-8", "replace")
    except LookupError:
        text = body.decode("utf-8", "replace")
    title, links = "", []
    if "html" in kind.lower():
        text, title, links = read_html(text)
    ids = {k: name_id(record_id, k) for k in ("metadata", "conversion")}
    envelope = {
        "WARC-Header": {**headers, "WARC-Record-ID": record_id, "WARC-Target-URI": target or "", "WARC-Date": date or ""},
        "HTTP-Response": {"Status": status, "Headers": http, "Entity-Length": len(body), "Entity-Digest": payload},
        "HTML": {"Title": title, "Links": links},
        "Conversion": ids["conversion"] if wanted else None,
    }
    out = [("metadata", "application/json", json.dumps(envelope, ensure_ascii=False, sort_keys=True).encode(), ids["conversion"] if wanted else None)]
    if wanted:
        out.append(("conversion", "text/plain; charset=utf-8", text.encode(), ids["metadata"]))
    return [(ids[k], k, record_id, other, target, date, mime, payload, digest(content), len(content), content) for k, mime, content, other in out]


def responses(pages: DataFrame, *, key: str = "page_id", url: str = "url", body: str = "html", date: str = "1970-01-01T00:00:00Z") -> DataFrame:
    """Response records of fetched pages: key, record_id, target_uri, warc_date, headers, block."""
    name = F.md5(F.to_json(F.struct(F.col(key).alias("k"), F.col(url).alias("u"), F.md5(F.coalesce(F.col(body), F.lit(""))).alias("b"))))
    cut = [F.substring(name, a, n) for a, n in ((1, 8), (9, 4), (13, 4), (17, 4), (21, 12))]
    content = F.encode(F.coalesce(F.col(body), F.lit("")), "utf-8")
    head = F.concat(F.lit("HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: "), F.length(content).cast("string"), F.lit("\r\n\r\n"))
    return pages.select(
        F.col(key), F.concat(F.lit("<urn:uuid:"), F.concat_ws("-", *cut), F.lit(">")).alias("record_id"), F.col(url).alias("target_uri"),
        F.lit(date).alias("warc_date"), F.create_map(F.lit("WARC-Type"), F.lit("response")).alias("headers"), F.concat(F.encode(head, "utf-8"), content).alias("block"),
    )


def derive(records: DataFrame, *, key: str = "page_id") -> DataFrame:
    """key and FIELDS: the derived records of response records (columns as `responses` makes them)."""

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 500):
                part = batch.slice(at, 500)
                rows, index = [], []
                for i, (record_id, target, date, headers, block) in enumerate(zip(*(c.to_pylist() for c in part.columns[1:]))):
                    derived = derive_one(record_id or "", target, date, dict(headers or ()), block or b"")
                    rows += derived
                    index += [i] * len(derived)
                columns = [pa.array(c, kind) for c, kind in zip(zip(*rows), kinds)]
                yield pa.RecordBatch.from_arrays([part.column(0).take(pa.array(index)), *columns], [key, *FIELDS])

    kinds = [pa.string()] * 9 + [pa.int64(), pa.binary()]
    schema = T.StructType(
        [T.StructField(key, records.schema[key].dataType), *(T.StructField(f, T.StringType()) for f in FIELDS[:9]), T.StructField(FIELDS[9], T.LongType()), T.StructField(FIELDS[10], T.BinaryType())]
    )
    ship(records.sparkSession)
    return records.select(key, "record_id", "target_uri", "warc_date", "headers", "block").mapInArrow(build, schema)


#: WARC header of each field, in the order in which a record states them.
_HEADERS = {
    "warc_type": "WARC-Type", "target_uri": "WARC-Target-URI", "warc_date": "WARC-Date", "record_id": "WARC-Record-ID", "refers_to": "WARC-Refers-To",
    "concurrent_to": "WARC-Concurrent-To", "payload_digest": "WARC-Payload-Digest", "block_digest": "WARC-Block-Digest", "content_type": "Content-Type", "content_length": "Content-Length",
}


def serialized(derived: DataFrame) -> DataFrame:
    """Adds `record`: the bytes of the WARC record, to be written one after the other, each alone or compressed."""
    lines = [F.when(F.col(f).isNotNull(), F.concat(F.lit(f"{name}: "), F.regexp_replace(F.col(f).cast("string"), r"[\r\n]+", " "))) for f, name in _HEADERS.items()]
    head = F.concat(F.concat_ws("\r\n", F.lit("WARC/1.0"), *lines), F.lit("\r\n\r\n"))
    return derived.withColumn("record", F.concat(F.encode(head, "utf-8"), "content", F.encode(F.lit("\r\n\r\n"), "utf-8")))


def parse_record(record: bytes) -> tuple[dict[str, str], bytes]:
    """Headers and content of a serialized record."""
    head, _, rest = record.partition(b"\r\n\r\n")
    headers = dict(line.split(": ", 1) for line in head.decode().split("\r\n")[1:])
    return headers, rest[: int(headers["Content-Length"])]
