"""WARC derivatives: linked metadata and plain-text conversion records of responses."""

from __future__ import annotations

import base64
import hashlib
import html as entities
import re
import uuid
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession

RECORD = "page_id long, record_id string, record_type string, refers_to string, target_uri string, warc_date string, content_type string, content_length long, block_digest string, payload_digest string, source_headers string, block string"
DATE = "2024-01-01T00:00:00Z"
HTTP_HEAD = "HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {}\r\n"

_UNSEEN = re.compile(r"<!--.*?(?:-->|\Z)|<(script|style|template|noscript)\b.*?(?:</\1\s*>|\Z)", re.S | re.I)
# a tag ends before the next one begins, so that a page of unclosed tags is gone through once
_BREAK = re.compile(r"</?(?:address|article|aside|blockquote|body|br|dd|div|dl|dt|footer|form|h[1-6]|head|header|hr|html|li|main|nav|ol|option|p|pre|section|table|td|th|title|tr|ul)\b[^<>]*>", re.I)
_TAG = re.compile(r"</?[a-zA-Z!?][^<>]*>")
_LINK_TAG = re.compile(r"<(a|img|link|script|iframe)\b([^<>]*)", re.I)
_TARGET = re.compile(r"\b(href|src)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+))", re.I)
_BLANK = re.compile(r"[ \t\r\f\v]+")
_LINES = re.compile(r" *\n[ \n]*")


def digest(block: bytes) -> str:
    return "sha1:" + base64.b32encode(hashlib.sha1(block).digest()).decode()


def record_id(kind: str, *parts: str) -> str:
    """The same record has the same identifier each time it is made."""
    return f"<urn:uuid:{uuid.UUID(bytes=hashlib.sha256('|'.join((kind, *parts)).encode()).digest()[:16], version=5)}>"


def plain_text(page: str) -> str:
    """What a reader of the page sees, block elements on lines of their own."""
    text = _TAG.sub("", _BREAK.sub("\n", _UNSEEN.sub(" ", page)))
    return _LINES.sub("\n", _BLANK.sub(" ", entities.unescape(text).replace("\xa0", " "))).strip()


def without_comments(page: str) -> str:
    """A page without its comments; one that is never closed is text. Each comment is looked for from where the last one ended."""
    out, at = [], 0
    while (begin := page.find("<!--", at)) >= 0 and (end := page.find("-->", begin + 4)) >= 0:
        out.append(page[at:begin])
        at = end + 3
    return "".join(out) + page[at:]


def outlinks(page: str) -> list[tuple[str, str]]:
    """(target, element/attribute) of each link, in order, comments left out."""
    tags = _LINK_TAG.finditer(without_comments(page))
    found = [(tag[1], m) for tag in tags if (m := _TARGET.search(tag[2]))]
    return [(entities.unescape(m[2] or m[3] or m[4] or "").strip(), f"{name.lower()}/@{m[1].lower()}") for name, m in found]


def response(page_id: int | None, url: str | None, page: str | None) -> tuple:
    """A response record; null url and page are empty."""
    payload = (page or "").encode()
    head = HTTP_HEAD.format(len(payload))
    block = head.encode() + b"\r\n" + payload
    return (page_id, record_id("response", str(page_id), url or "", digest(payload)), "response", None, url or "", DATE, "application/http; msgtype=response", len(block), digest(block), digest(payload), head, block.decode())


def derivatives(r: tuple) -> list[tuple]:
    """The metadata and conversion records of a response record."""
    page_id, rid, kind, _, url, date, _, length, block_digest, payload_digest, _, block = r
    if kind != "response":
        return []
    head, _, page = (block or "").partition("\r\n\r\n")
    text = plain_text(page).encode()
    mime = next((x.partition(":")[2].strip() for x in head.split("\r\n") if x.lower().startswith("content-type:")), "")
    fields = [("source-record", rid), ("source-block-digest", block_digest), ("source-payload-digest", payload_digest), ("source-content-length", str(length)), ("source-content-type", mime), ("conversion", record_id("conversion", rid)), *[("outlink", f"{u} {how}".replace("\r", " ").replace("\n", " ")) for u, how in outlinks(page)]]
    meta = "".join(f"{k}: {v}\r\n" for k, v in fields).encode()
    return [
        (page_id, record_id("metadata", rid), "metadata", rid, url, date, "application/warc-fields", len(meta), digest(meta), digest(meta), head, meta.decode()),
        (page_id, record_id("conversion", rid), "conversion", rid, url, date, "text/plain; charset=utf-8", len(text), digest(text), payload_digest, head, text.decode()),
    ]


def _mapped(df: DataFrame, columns: list[str], f) -> DataFrame:
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = [x for r in zip(*[batch[c].astype(object).where(batch[c].notna(), None) for c in columns], strict=True) for x in f(r)]
            yield pd.DataFrame(rows, columns=[x.split()[0] for x in RECORD.split(", ")]).astype({"page_id": "Int64", "content_length": "Int64"})

    return df.select(*columns).mapInPandas(run, RECORD)


def responses(pages: DataFrame) -> DataFrame:
    """One response record a page (page_id, url, html).

    Repeated pages give repeated records; null ids stay null, null urls and
    pages are empty; an empty table gives an empty result; other columns are
    ignored.
    """
    return _mapped(pages, ["page_id", "url", "html"], lambda r: [response(None if r[0] is None else int(r[0]), r[1], r[2])])


def derive(records: DataFrame) -> DataFrame:
    """Metadata and conversion records of all responses; other records have none.

    refers_to is the response's identifier, source_headers its HTTP headers; the
    conversion keeps the payload digest of its source, and the metadata names
    all source digests and the conversion. Pages without text give an empty
    conversion. An empty table gives an empty result; other columns are ignored.
    """
    names = [x.split()[0] for x in RECORD.split(", ")]
    return _mapped(records, names, derivatives)


def serialized(r) -> str:
    """A record as WARC/1.1 text."""
    head = [("WARC-Type", r["record_type"]), ("WARC-Record-ID", r["record_id"]), ("WARC-Refers-To", r["refers_to"]), ("WARC-Target-URI", r["target_uri"]), ("WARC-Date", r["warc_date"]), ("Content-Type", r["content_type"]), ("WARC-Block-Digest", r["block_digest"]), ("WARC-Payload-Digest", r["payload_digest"]), ("Content-Length", r["content_length"])]
    return "WARC/1.1\r\n" + "".join(f"{k}: {v}\r\n" for k, v in head if v is not None) + "\r\n" + r["block"] + "\r\n\r\n"


def parsed(raw: bytes) -> list[dict]:
    """Records of a WARC file by their lengths, whatever their blocks hold."""
    out, at = [], 0
    while at < len(raw):
        end = raw.index(b"\r\n\r\n", at)
        head = dict(x.split(": ", 1) for x in raw[at:end].decode().split("\r\n")[1:])
        size = int(head["Content-Length"])
        out.append(head | {"block": raw[end + 4 : end + 4 + size].decode()})
        at = end + 8 + size
    return out


def write_warc(records: DataFrame, path: str) -> None:
    """Records as gzipped WARC files, one a partition."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            batch = batch.astype(object).where(batch.notna(), None)
            # the sink ends each row with the record's last line break
            yield pd.DataFrame({"value": [serialized(r)[:-2] for r in batch.to_dict("records")]})

    records.mapInPandas(run, "value string").write.option("lineSep", "\r\n").option("compression", "gzip").text(path)


def read_warc(spark: SparkSession, path: str) -> DataFrame:
    """(record_id, record_type, refers_to, target_uri, block_digest, payload_digest, block) of WARC files."""
    keys = {"record_id": "WARC-Record-ID", "record_type": "WARC-Type", "refers_to": "WARC-Refers-To", "target_uri": "WARC-Target-URI", "block_digest": "WARC-Block-Digest", "payload_digest": "WARC-Payload-Digest", "block": "block"}

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        import gzip

        for batch in batches:
            for raw in batch["content"]:
                rows = parsed(gzip.decompress(raw) if raw[:2] == b"\x1f\x8b" else raw)
                yield pd.DataFrame([{k: r.get(v) for k, v in keys.items()} for r in rows], columns=list(keys))

    return spark.read.format("binaryFile").load(path).select("content").mapInPandas(run, ", ".join(f"{k} string" for k in keys))
