"""WARC derivatives: metadata and plain-text conversion records made from responses."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

CRLF = "\r\n"
DATE = "2020-01-01T00:00:00Z"

# Named character references that are resolved; &amp; comes last.
ENTITIES = {
    "nbsp": " ", "lt": "<", "gt": ">", "quot": '"', "apos": "'", "copy": "©", "reg": "®", "middot": "·", "ndash": "–",
    "mdash": "—", "hellip": "…", "laquo": "«", "raquo": "»", "euro": "€", "amp": "&",
}

# Every pattern has one beginning, so that a position without it is left at once.
DROPPED = r"(?is)<(?:!--.*?-->|head\b.*?</head\s*>|script\b.*?</script\s*>|style\b.*?</style\s*>)"
BREAK = r"(?i)</?(?:a(?:ddress|rticle|side)|b(?:lockquote|ody|r)|d(?:d|iv|l|t)|fo(?:oter|rm)|h(?:[1-6]|eader|r|tml)|li|main|nav|ol|p|pre|section|t(?:able|d|h|r)|ul)\b[^>]*>"
HREF = r"""(?i)<a\b[^>]*?\bhref="([^"]*)\""""
TITLE = r"(?is)<title\b[^>]*>(.*?)</title\s*>"

RECORD = "record_id string, record_type string, refers_to string, target_uri string, date string, headers string, block string, block_digest string, content_length long"


def digest(value: Column) -> Column:
    return F.concat(F.lit("sha256:"), F.sha2(value.cast("binary"), 256))


def record_id(*parts: Column) -> Column:
    """A urn:uuid from a hash of the parts: the same record gets the same id in every run."""
    h = F.md5(F.concat_ws("\x1f", *parts))
    return F.concat(F.lit("<urn:uuid:"), F.concat_ws("-", *[F.substring(h, at, n) for at, n in ((1, 8), (9, 4), (13, 4), (17, 4), (21, 12))]), F.lit(">"))


def unescaped(text: Column) -> Column:
    """Decimal and the common named character references resolved."""
    code = lambda c: F.decode(F.unhex(F.lpad(F.hex(c.cast("long")), 8, "0")), "UTF-32")
    valid = lambda c: ((c.cast("long") > 0) & (c.cast("long") < 0xD800)) | ((c.cast("long") > 0xDFFF) & (c.cast("long") < 0x110000))
    codes = F.filter(F.array_distinct(F.regexp_extract_all(text, F.lit("&#([0-9]{1,7});"), F.lit(1))), valid)
    decoded = F.aggregate(codes, text, lambda t, c: F.replace(t, F.concat(F.lit("&#"), c, F.lit(";")), code(c)))
    text = F.when(F.contains(text, F.lit("&#")), decoded).otherwise(text)
    # Only the names that occur are replaced: no other replacement makes a name but that of &amp;, the last.
    names = F.array(*[F.struct(F.lit(name).alias("name"), F.lit(char).alias("char")) for name, char in ENTITIES.items()])
    found = lambda t: F.array_distinct(F.regexp_extract_all(t, F.lit(f"&({'|'.join(ENTITIES)});"), F.lit(1)))
    used = lambda t: _let(found(t), lambda f: F.filter(names, lambda e: F.array_contains(f, e["name"])))
    named = lambda t: F.aggregate(used(t), t, lambda x, e: F.replace(x, F.concat(F.lit("&"), e["name"], F.lit(";")), e["char"]))
    return _let(text, lambda t: F.when(F.contains(t, F.lit("&")), named(t)).otherwise(t))


def _let(value: Column, then: Callable[[Column], Column]) -> Column:
    """then(value), with the value computed once however often it is read."""
    return F.element_at(F.transform(F.array(value), then), 1)


def squeezed(text: Column) -> Column:
    """Blanks in a row become one, lines are trimmed, empty lines go."""

    def blanks(t: Column) -> Column:
        some = reduce(lambda x, y: x | y, [F.contains(t, F.lit(c)) for c in ("  ", "\t", "\x0b", "\f", "\r")])
        return F.when(some, F.regexp_replace(t, r"[\t\x0B\f\r][ \t\x0B\f\r]*| [ \t\x0B\f\r]+", " ")).otherwise(t)

    return F.trim(F.regexp_replace(_let(text, blanks), r"\n[ \n]+| \n[ \n]*", "\n"), F.lit(" \n"))


def tagless(html: Column) -> Column:
    """Text and line breaks of a page, references unresolved."""
    html = F.regexp_replace(html, DROPPED, " ")
    html = F.replace(F.replace(html, F.lit(CRLF), F.lit("\n")), F.lit("\r"), F.lit("\n"))
    return F.regexp_replace(F.regexp_replace(html, BREAK, "\n"), r"<[^>]*>", "")


def responses(pages: DataFrame, date: str = DATE, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """Response records of pages: a null url is an empty target, a null body an empty payload."""
    body, uri = F.coalesce(html_col, F.lit("")), F.coalesce(url_col, F.lit(""))
    http = F.concat(F.lit(f"HTTP/1.1 200 OK{CRLF}Content-Type: text/html; charset=utf-8{CRLF}Content-Length: "), F.octet_length(body).cast("string"))
    block = F.concat(http, F.lit(CRLF * 2), body)
    headers = F.concat(F.lit("WARC-Payload-Digest: "), digest(body), F.lit(f"{CRLF}Content-Type: application/http; msgtype=response"))
    return pages.select(
        record_id(F.lit("response"), F.coalesce(F.col(id_col).cast("string"), F.lit("")), uri).alias("record_id"),
        F.lit("response").alias("record_type"),
        F.lit(None).cast("string").alias("refers_to"),
        uri.alias("target_uri"),
        F.lit(date).alias("date"),
        headers.alias("headers"),
        block.alias("block"),
    ).select("*", digest(F.col("block")).alias("block_digest"), F.octet_length("block").cast("long").alias("content_length"))


def derive(records: DataFrame) -> DataFrame:
    """Two records for each response of ``records``, both referring to it by its id.

    ``metadata`` (application/warc-fields) keeps the source's headers and
    digests and adds status, content type, title and outlinks; ``conversion``
    (text/plain) holds the text of the payload. Other record types are passed
    over. Target and date are the response's; block digests are over the new
    blocks. A response without header end has an empty payload; with an empty
    payload the text is empty. Nulls count as empty.
    """
    text = lambda name: F.coalesce(name, F.lit(""))
    cut = F.instr(text("block"), CRLF * 2)
    http = F.when(cut > 0, F.substring("block", F.lit(1), cut - 1)).otherwise(text("block"))
    body = F.when(cut > 0, F.substring("block", cut + 4, F.length("block"))).otherwise("")
    parts = records.where("record_type = 'response'").select(
        text("record_id").alias("source"), text("target_uri").alias("target_uri"), text("date").alias("date"), text("headers").alias("headers"),
        text("block_digest").alias("digest"), http.alias("http"), body.alias("body"),
    )
    # Columns of their own, as resolving references reads them several times.
    parts = parts.withColumns({"bare": tagless(F.col("body")), "title": F.regexp_extract("body", TITLE, 1)})
    line = lambda name, value: F.concat(F.lit(f"{name}: "), value, F.lit(CRLF))
    links = F.array_distinct(F.regexp_extract_all("body", F.lit(HREF), F.lit(1)))
    source_lines = F.filter(F.split("headers", CRLF), lambda h: h != "")
    fields = F.concat(
        F.array_join(F.transform(source_lines, lambda h: F.concat(F.lit("source-"), h, F.lit(CRLF))), ""),
        line("source-block-digest", F.col("digest")),
        line("http-status", F.regexp_extract("http", r"^HTTP/[0-9.]+ ([0-9]+)", 1)),
        line("http-content-type", F.regexp_extract("http", r"(?i)\r\ncontent-type: *([^\r\n]*)", 1)),
        line("title", F.regexp_replace(squeezed(unescaped(F.col("title"))), "\n", " ")),
        F.array_join(F.transform(links, lambda u: F.concat(F.lit("outlink: "), u, F.lit(CRLF))), ""),
    )
    payload = F.regexp_extract("headers", r"(?i)(?:^|\r\n)warc-payload-digest: *([^\r\n]*)", 1)
    made = F.array(
        F.struct(F.lit("metadata").alias("record_type"), F.lit("application/warc-fields").alias("type"), fields.alias("block")),
        F.struct(F.lit("conversion").alias("record_type"), F.lit("text/plain; charset=utf-8").alias("type"), squeezed(unescaped(F.col("bare"))).alias("block")),
    )
    out = parts.select("source", "target_uri", "date", payload.alias("payload"), F.explode(made).alias("r")).select("*", "r.*").drop("r")
    headers = F.concat(F.lit("WARC-Source-Payload-Digest: "), F.col("payload"), F.lit(f"{CRLF}Content-Type: "), F.col("type"))
    return out.select(
        record_id(F.col("record_type"), F.col("source")).alias("record_id"),
        "record_type",
        F.col("source").alias("refers_to"),
        "target_uri",
        "date",
        headers.alias("headers"),
        "block",
        digest(F.col("block")).alias("block_digest"),
        F.octet_length("block").cast("long").alias("content_length"),
    )


def write_warc(records: DataFrame, path: str) -> None:
    """Records as gzipped WARC/1.1 files, written by Spark's text sink: a record's end is the line separator."""
    line = lambda name, col: F.when(F.coalesce(col, F.lit("")) != "", F.concat(F.lit(f"{name}: "), F.col(col), F.lit(CRLF))).otherwise("")
    head = F.concat(
        F.lit(f"WARC/1.1{CRLF}"), line("WARC-Type", "record_type"), line("WARC-Record-ID", "record_id"), line("WARC-Refers-To", "refers_to"),
        line("WARC-Target-URI", "target_uri"), line("WARC-Date", "date"), line("WARC-Block-Digest", "block_digest"),
        F.when(F.coalesce("headers", F.lit("")) != "", F.concat("headers", F.lit(CRLF))).otherwise(""),
        F.lit("Content-Length: "), F.octet_length(F.coalesce("block", F.lit(""))).cast("string"), F.lit(CRLF * 2),
    )
    records.select(F.concat(head, F.coalesce("block", F.lit(""))).alias("value")).write.option("lineSep", CRLF * 2).option("compression", "gzip").text(path)


def read_warc(spark: SparkSession, path: str) -> DataFrame:
    """Records of WARC/1.1 files; ``complete`` tells whether the block has the stated length and digest (if it is sha256).

    A record ends where two line ends are followed by the next version line.
    """
    raw = spark.read.option("lineSep", f"{CRLF * 2}WARC/1.1{CRLF}").text(path)
    raw = raw.select(F.regexp_replace("value", r"^WARC/1\.[01]\r\n", "").alias("value"))
    cut = F.instr("value", CRLF * 2)
    raw = raw.where(cut > 0).select(F.substring("value", F.lit(1), cut - 1).alias("head"), F.substring("value", cut + 4, F.length("value")).alias("rest"))
    field = lambda name: F.nullif(F.regexp_extract("head", rf"(?i)(?:^|\r\n){name}: *([^\r\n]*)", 1), F.lit(""))
    n = field("Content-Length").cast("long")
    own = "warc-type|warc-record-id|warc-refers-to|warc-target-uri|warc-date|warc-block-digest|content-length"
    headers = F.array_join(F.filter(F.split("head", CRLF), lambda h: ~h.rlike(f"(?i)^({own}):")), CRLF)
    # The last record of a file still has its end.
    block = F.when(F.octet_length("rest") == n + 4, F.regexp_replace("rest", r"\r\n\r\n$", "")).otherwise(F.col("rest"))
    out = raw.select(
        field("WARC-Record-ID").alias("record_id"), field("WARC-Type").alias("record_type"), field("WARC-Refers-To").alias("refers_to"),
        field("WARC-Target-URI").alias("target_uri"), field("WARC-Date").alias("date"), headers.alias("headers"), block.alias("block"),
        field("WARC-Block-Digest").alias("block_digest"), n.alias("content_length"),
    )
    fits = (F.octet_length("block") == F.col("content_length")) & (~F.coalesce("block_digest", F.lit("")).startswith("sha256:") | (F.col("block_digest") == digest(F.col("block"))))
    return out.withColumn("complete", F.coalesce(fits, F.lit(False)))
