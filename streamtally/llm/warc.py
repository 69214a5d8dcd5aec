"""Derivatives of web archive responses: one `metadata` record with the page's links and one
`conversion` record with its plain text per response.

Both refer to the response (`WARC-Refers-To` its record id, `WARC-Refers-To-Target-URI`,
`WARC-Refers-To-Date`), keep its HTTP headers, and carry the digest of the response's payload beside
that of their own block. Record ids are made from what they name, so a repeated run gives the same
records. Null headers or payloads count as empty; a payload without markup is its own text; a null
URI is left out of the headers. Rows repeated in full give repeated records. A tag ends before the next `<`; a
comment or script that is not closed runs to the end of the page. The work is linear in the page's length, so a very
long page of open tags, comments or references is no more than a long page.

Everything is a column expression, and no row is moved between tasks.
"""

from __future__ import annotations

from html.entities import html5

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

CRLF = "\r\n"
# Frequent named character references; all others of HTML are looked up where they occur, numeric ones computed.
ENTITIES = {"&nbsp;": " ", "&middot;": "·", "&copy;": "©", "&quot;": '"', "&apos;": "'", "&lt;": "<", "&gt;": ">", "&amp;": "&"}
RARE = {f"&{k}": v for k, v in html5.items() if k.endswith(";") and f"&{k}" not in ENTITIES}
# A text is references, the text between them, and ampersands that begin none.
REFERENCE = r"&(?:#[0-9]{1,7}|#[xX][0-9a-fA-F]{1,6}|[A-Za-z][A-Za-z0-9]{1,31});|[^&]+|&"
# No pattern looks past the next `<` for the end of a tag, and what is not closed runs to the end of the page, so
# every pattern is linear in the page, however its markup is broken.
LINK = r"""(?is)<(a|area|link|img|script|iframe|form|source)\b[^<>]*?\s(href|src|action)\s*=\s*("[^"]*"|'[^']*'|[^\s>"']+)"""
# Comments go; of scripts and the like the opening tag stays, as it may hold a link.
UNSHOWN = r"(?is)<!--(?:.*?-->|.*\z)|(<(script|style|noscript|template)\b[^<>]*>)(?:.*?</\2\s*>|.*\z)"
# White space other than a single blank.
WHITE_RUN = r"[ ]*[\t\n\x0B\f\r]\s*|[ ]{2,}"
BREAK = r"(?i)</?(p|div|br|h[1-6]|li|ul|ol|tr|table|section|article|nav|footer|header|title|body|head|html)\b[^<>]*>"
TAG = r"(?s)</?[a-zA-Z!][^<>]*>"
# Blanks around line ends; a run of blanks is looked at from its start only.
LINE_END = "(?<![ \u00a0])[ \u00a0]*+\\n[ \u00a0\\n]*+"


def sha1(data: Column) -> Column:
    """`sha1:` and the digest in base 32: forty hex digits are eight groups of twenty bits, four letters each."""
    digest = F.sha1(data)
    groups = [F.lpad(F.conv(F.substring(digest, 1 + 5 * i, 5), 16, 32), 4, "0") for i in range(8)]
    letters = F.translate(F.concat(*groups), "0123456789ABCDEFGHIJKLMNOPQRSTUV", "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567")
    return F.concat(F.lit("sha1:"), letters)


def record_id(*parts: Column) -> Column:
    h = F.substring(F.sha2(F.concat_ws("\n", *parts), 256), 1, 32)
    spans = [F.substring(h, a, n) for a, n in ((1, 8), (9, 4), (13, 4), (17, 4), (21, 12))]
    return F.concat(F.lit("<urn:uuid:"), F.concat_ws("-", *spans), F.lit(">"))


def responses(pages: DataFrame, date: str) -> DataFrame:
    """Response records of a table of (page_id, url, html) that was fetched on `date`."""
    payload = F.encode(F.coalesce("html", F.lit("")), "UTF-8")
    length = F.octet_length(payload).cast("string")
    headers = F.concat(F.lit(f"HTTP/1.1 200 OK{CRLF}Content-Type: text/html; charset=utf-8{CRLF}Content-Length: "), length, F.lit(CRLF))
    return pages.select(
        "page_id",
        record_id(F.lit("response"), F.coalesce(F.col("page_id").cast("string"), F.lit("")), F.coalesce("url", F.lit(""))).alias("record_id"),
        F.col("url").alias("target_uri"),
        F.lit(date).alias("date"),
        headers.alias("http_headers"),
        F.coalesce("html", F.lit("")).alias("payload"),
    )


def links(html: Column) -> Column:
    """Array of (tag, attribute, url) in the order of the page, of markup without comments and scripts' text."""
    found = F.regexp_extract_all(html, F.lit(LINK), 0)
    raw = F.transform(
        found,
        lambda m: F.struct(
            F.lower(F.regexp_extract(m, LINK, 1)).alias("tag"),
            F.lower(F.regexp_extract(m, LINK, 2)).alias("attribute"),
            F.regexp_replace(F.regexp_extract(m, LINK, 3), r"""^["']|["']$""", "").alias("url"),
        ),
    )
    # A second pass, as `unescape` uses its input several times.
    return F.transform(raw, lambda m: F.struct(m["tag"].alias("tag"), m["attribute"].alias("attribute"), unescape(m["url"]).alias("url")))


def unescape(text: Column) -> Column:
    """Replaces the references of a text, each once, so that no reference is made up. Names that HTML does not have stay."""
    known = F.map_from_arrays(*[F.split(F.lit("\x01".join(x)), "\x01") for x in (RARE.keys(), RARE.values())])

    def numbered(m: Column) -> Column:
        code = F.when(m.rlike("(?i)^&#x"), F.conv(F.regexp_extract(m, "(?i)x([0-9a-f]+)", 1), 16, 10)).otherwise(F.regexp_extract(m, "([0-9]+)", 1)).cast("int")
        units = F.when(code < 0x10000, F.lpad(F.hex(code), 4, "0")).otherwise(
            F.concat(F.lpad(F.hex(F.lit(0xD800) + F.shiftright(code - 0x10000, 10)), 4, "0"), F.lpad(F.hex(F.lit(0xDC00) + (code - 0x10000) % 1024), 4, "0"))
        )
        valid = code.between(1, 0xD7FF) | code.between(0xE000, 0x10FFFF)
        return F.when(valid, F.decode(F.unhex(units), "UTF-16BE")).otherwise(F.lit("\ufffd"))

    def read(m: Column) -> Column:
        out = F.when(~m.startswith("&") | (F.length(m) < 3), m).when(m.startswith("&#"), numbered(m))
        for name, value in ENTITIES.items():
            out = out.when(m == name, F.lit(value))
        return out.otherwise(F.coalesce(F.try_element_at(known, m), m))

    parts = F.regexp_extract_all(text, F.lit(REFERENCE), 0)
    return F.when(F.contains(text, F.lit("&")), F.array_join(F.transform(parts, read), "")).otherwise(text)


def lines_of(html: Column) -> Column:
    """Markup without comments and scripts' text as lines: tags dropped, block tags ending lines, white space folded."""
    return F.regexp_replace(F.regexp_replace(F.regexp_replace(html, WHITE_RUN, " "), BREAK, "\n"), TAG, "")


def plain_text(lines: Column) -> Column:
    """Visible text of `lines_of`: references replaced, no blanks around line ends."""
    return F.btrim(F.regexp_replace(unescape(lines), LINE_END, "\n"), F.lit(" \t\n\x0b\f\r"))


def title_of(html: Column) -> Column:
    return F.trim(F.regexp_replace(F.regexp_extract(html, r"(?is)<title\b[^<>]*>(.*?)(?:</title|\z)", 1), r"\s+", " "))


def derive(df: DataFrame) -> DataFrame:
    """Two rows per response: its columns' names as in `responses`; adds record type, ids, headers, digests and block.

    A row whose payload is null is derived from an empty one.
    """
    payload = F.coalesce("payload", F.lit(""))
    headers = F.coalesce("http_headers", F.lit(""))
    markup = F.regexp_replace(payload, UNSHOWN, "$1")
    bare = df.select(
        "page_id", F.col("record_id").alias("refers_to"), "target_uri", "date", headers.alias("http_headers"),
        sha1(F.encode(payload, "UTF-8")).alias("payload_digest"), markup.alias("markup"),
    )
    shown = F.col("markup")
    # `unescape` uses its input several times, so it gets a column, not the expression that makes it.
    folded = bare.withColumns({"links": links(shown), "heading": title_of(shown), "lines": lines_of(shown)})
    read = folded.withColumns({"title": unescape(F.col("heading")), "text": plain_text(F.col("lines"))})
    described = F.to_json(F.struct(F.col("http_headers").alias("response-headers"), "payload_digest", "title", "links"))
    kinds = F.array(
        F.struct(F.lit("metadata").alias("warc_type"), F.lit("application/json").alias("content_type"), described.alias("block")),
        F.struct(F.lit("conversion").alias("warc_type"), F.lit("text/plain").alias("content_type"), F.col("text").alias("block")),
    )
    rows = read.select("page_id", "refers_to", "target_uri", "date", "http_headers", "payload_digest", F.size("links").alias("n_links"), F.inline(kinds))
    named = rows.select(
        "page_id", "warc_type", record_id(F.col("warc_type"), F.coalesce("refers_to", F.lit(""))).alias("record_id"), "refers_to", "target_uri",
        "date", "http_headers", "payload_digest", "n_links", "content_type",
        sha1(F.encode("block", "UTF-8")).alias("block_digest"), F.octet_length("block").cast("long").alias("block_bytes"), "block",
    )
    return named.withColumn("warc_headers", headers_of())


def headers_of() -> Column:
    lines = [
        ("WARC-Type", F.col("warc_type")), ("WARC-Record-ID", F.col("record_id")), ("WARC-Date", F.col("date")),
        ("WARC-Target-URI", F.col("target_uri")), ("WARC-Refers-To", F.col("refers_to")),
        ("WARC-Refers-To-Target-URI", F.col("target_uri")), ("WARC-Refers-To-Date", F.col("date")),
        ("WARC-Block-Digest", F.col("block_digest")), ("WARC-Source-Payload-Digest", F.col("payload_digest")),
        ("Content-Type", F.col("content_type")), ("Content-Length", F.col("block_bytes").cast("string")),
    ]
    return F.concat(F.lit(f"WARC/1.1{CRLF}"), *[F.coalesce(F.concat(F.lit(f"{k}: "), v, F.lit(CRLF)), F.lit("")) for k, v in lines], F.lit(CRLF))


def serialized(derived: DataFrame) -> DataFrame:
    """Each record as the bytes of a WARC file."""
    return derived.select(F.encode(F.concat("warc_headers", "block", F.lit(CRLF + CRLF)), "UTF-8").alias("value"))
