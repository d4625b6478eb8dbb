"""Derivative records of an archive: linked metadata and plain-text conversion records from responses."""

from __future__ import annotations

import base64
import hashlib
import html
import re
import uuid
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, functions as F

from haulbook.llm.common import batched

VERSION = "WARC/1.1"
#: Time stamp of records whose response has none: the archive format requires one.
NO_DATE = "1970-01-01T00:00:00Z"

_skip = re.compile(r"<!--.*?(?:-->|$)|<(script|style|noscript|template)\b[^>]*>.*?(?:</\1\s*>|$)", re.S | re.I)
_block = re.compile(r"</?(?:address|article|aside|blockquote|br|dd|div|dl|dt|fieldset|figure|footer|form|h[1-6]|head|header|hr|li|main"
                    r"|nav|ol|p|pre|section|table|tbody|td|tfoot|th|thead|title|tr|ul)\b[^>]*>", re.I)
_tag = re.compile(r"</?[a-zA-Z][^>]*>|<[!?][^>]*>")
_title = re.compile(r"<title\b[^>]*>(.*?)</title\s*>", re.S | re.I)
_link = re.compile(r"""<a\s[^>]*?\bhref\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s>]+))""", re.I)


def digest(data: bytes) -> str:
    return "sha1:" + base64.b32encode(hashlib.sha1(data).digest()).decode()


def record_id(*parts: str) -> str:
    """An id that follows from its parts, so that a rerun names the same record alike."""
    return f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, chr(10).join(parts))}>"


def clean(value: str) -> str:
    """A value fit for a header line."""
    return re.sub(r"[\r\n]+", " ", value or "").strip()


def plain_text(page: str) -> str:
    """Text of a page, one line a block, without markup, scripts and empty lines."""
    text = html.unescape(_tag.sub("", _block.sub("\n", re.sub(r"[\r\n]+", " ", _skip.sub(" ", page)))))
    lines = (re.sub(r"[ \t\r\f\v\xa0]+", " ", line).strip() for line in text.split("\n"))
    return "\n".join(line for line in lines if line)


def page_facts(page: str) -> tuple[str, list[str]]:
    """Title and link targets."""
    title = _title.search(page)
    return (clean(html.unescape(title[1])) if title else "", [clean(html.unescape(a or b or c)) for a, b, c in _link.findall(page)])


def http_parts(message: str) -> tuple[str, list[tuple[str, str]], str]:
    """Status line, headers and body of a response. A message without a header block is all body."""
    head, gap, body = message.partition("\r\n\r\n")
    if not gap or not head.startswith("HTTP/"):
        return "", [], message
    first, *rest = head.split("\r\n")
    return first, [(k.strip(), v.strip()) for k, _, v in (line.partition(":") for line in rest)], body


def derived(source: dict[str, str]) -> list[tuple[str, str, list[tuple[str, str]], str]]:
    """(type, id, headers, block) of the metadata and the conversion record of one response."""
    uri, date, message = clean(source["target_uri"]), source["date"] or NO_DATE, source["http"] or ""
    status, headers, body = http_parts(message)
    whole, payload = digest(message.encode()), digest(body.encode())
    origin = source["record_id"] or record_id("response", uri, date, whole)
    text = plain_text(body)
    title, links = page_facts(body)
    facts = ([("source-record", origin), ("source-block-digest", whole), ("source-payload-digest", payload), ("http-status", status)]
             + [("http-" + k.lower(), v) for k, v in headers] + [("title", title)] + [("outlink", x) for x in links])
    out = []
    for kind, mime, block in (("metadata", "application/warc-fields", "".join(f"{k}: {v}\r\n" for k, v in facts)),
                              ("conversion", "text/plain; charset=utf-8", text)):
        name = record_id(kind, origin, digest(block.encode()))
        out.append((kind, name, [("WARC-Type", kind), ("WARC-Record-ID", name), ("WARC-Refers-To", origin), ("WARC-Target-URI", uri),
                                 ("WARC-Date", date), ("WARC-Block-Digest", digest(block.encode())),
                                 ("Content-Type", mime), ("Content-Length", str(len(block.encode())))], block))
    return out


RECORD = ("_key long, record_type string, record_id string, refers_to string, target_uri string, warc_date string, source_digest string, "
          "source_payload_digest string, block_digest string, content_length long, headers array<struct<name: string, value: string>>, "
          "block string")


def derive_records(responses: DataFrame, key: str) -> DataFrame:
    """Two records for each response: what is known about it, and its plain text.

    ``responses`` has ``record_id``, ``target_uri``, ``date`` and ``http`` (the whole
    message) and a key that is passed on. Every derived record names the response it
    refers to; the metadata block keeps the response's own headers and digests. Nulls
    count as empty: a response without an id gets one from its content, one without a
    date the earliest; an empty message gives an empty text. Repeated responses give
    repeated records.
    """
    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for part in batched(frames, "http", 8_000_000):
            rows = []
            for source in part.to_dict("records"):
                _, _, body = http_parts(source["http"])
                whole, payload = digest(source["http"].encode()), digest(body.encode())
                for kind, name, headers, block in derived(source):
                    values = dict(headers)
                    rows.append((source["_key"], kind, name, values["WARC-Refers-To"], values["WARC-Target-URI"], values["WARC-Date"], whole,
                                 payload, values["WARC-Block-Digest"], int(values["Content-Length"]),
                                 [{"name": k, "value": v} for k, v in headers], block))
            yield pd.DataFrame(rows, columns=[c.split()[0] for c in RECORD.split(", ")][:10] + ["headers", "block"])

    text = [F.coalesce(c, F.lit("")).alias(c) for c in ("record_id", "target_uri", "date", "http")]
    return responses.select(F.col(key).cast("long").alias("_key"), *text).mapInPandas(run, RECORD).withColumnRenamed("_key", key)


def responses_of(pages: DataFrame) -> DataFrame:
    """Response records of fetched pages: the html behind a header block that states its type and length."""
    body = F.coalesce("html", F.lit(""))
    head = F.concat(F.lit("HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: "),
                    F.octet_length(body).cast("string"), F.lit("\r\n\r\n"))
    return pages.select("page_id", F.lit(None).cast("string").alias("record_id"), F.col("url").alias("target_uri"),
                        F.lit(None).cast("string").alias("date"), F.concat(head, body).alias("http"))


def record_report(pages: DataFrame) -> DataFrame:
    """The derived records of every page, their blocks shown by digest and length."""
    return derive_records(responses_of(pages), "page_id").drop("headers", "block")


def write_records(records: DataFrame, path: str) -> None:
    """The records as archive files: text with the record separator between records."""
    lines = F.array_join(F.transform("headers", lambda h: F.concat(h["name"], F.lit(": "), h["value"])), "\r\n")
    text = F.concat(F.lit(VERSION + "\r\n"), lines, F.lit("\r\n\r\n"), F.col("block"))
    records.select(text.alias("value")).write.mode("overwrite").option("lineSep", "\r\n\r\n").option("compression", "gzip").text(path)
