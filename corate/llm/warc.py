"""WARC archives: written by Spark's text writer, read back by boundary-chain verification.

Writing: a record is one row, and the two line breaks that end every record are the row separator.

Reading: the archives are split at every ``WARC/1.1`` line, also inside payloads, by a text read with
that separator, so files are read in ranges and no task needs a whole file. A task knows
offsets only from the start of its range; the lengths of the ranges add up to the rest. Every
piece with a header is a candidate whose successor lies at its offset + header + content length. The
true records are those that the chain of successors reaches from the start of a file: runs of
candidates that follow each other directly are one node, and pointer jumping doubles the reach along
the nodes in each round. Magic inside payloads is never reached, and the record around it is put
together again from its pieces.
"""

from __future__ import annotations

import base64
import hashlib
import re

import pandas as pd
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from corate.llm.common import drop_stage, small_broadcast, table, text_or_empty, write_stage
from corate.session import scratch_path

MAGIC = "WARC/1.1\r\n"
END = "\r\n\r\n"
DATE = "2024-01-01T00:00:00Z"   # a fixed date: archives of the same pages are the same
MIN_REVISIT_BYTES = 0
_ALPHABET = "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"


def base32_sha1(payload) -> "F.Column":
    """Upper-case base32 of the SHA-1: eight groups of 20 bits, four letters each."""
    h = F.sha1(payload)
    letters = F.array(*map(F.lit, _ALPHABET))
    out = []
    for g in range(8):
        n = F.conv(F.substring(h, 5 * g + 1, 5), 16, 10).cast("int")
        out += [F.get(letters, F.shiftright(n, s).bitwiseAND(31)) for s in (15, 10, 5, 0)]
    return F.concat(*out)


def write_archives(pages: DataFrame, path: str, *, id_col: str = "page_id", url_col: str = "url", html_col: str = "html",
                   min_bytes: int = MIN_REVISIT_BYTES) -> str:
    """One record per row of ``pages``. Of equal payloads of ``min_bytes`` or more the row with the
    smallest id is a response, the others are revisits without a payload that refer to it.

    A null payload is empty; rows listed twice with the smallest id are both responses; a null id is
    written as such and is never referred to unless all ids of the payload are null; line breaks in
    URLs are percent-encoded. Other columns are ignored."""
    html = text_or_empty(html_col)
    d = pages.select(F.col(id_col).cast("string").alias("_id"), F.col(id_col).alias("_order"), F.col(url_col).alias("_url"), html.alias("_html"))
    slim = d.select("_order", base32_sha1(F.col("_html").cast("binary")).alias("_digest"), F.octet_length("_html").cast("long").alias("_bytes"))
    first = slim.filter(F.col("_bytes") >= min_bytes).groupBy("_digest", "_bytes").agg(
        F.min("_order").alias("_first"), F.count("*").alias("_times")).filter("_times > 1").drop("_times")
    first = write_stage(first, "warc-first")
    d = d.withColumn("_digest", base32_sha1(F.col("_html").cast("binary"))).withColumn("_bytes", F.octet_length("_html").cast("long"))
    d = d.join(small_broadcast(first, first.count(), 96), ["_digest", "_bytes"], "left")
    revisit = F.col("_first").isNotNull() & ~F.col("_order").eqNullSafe(F.col("_first"))
    url = F.regexp_replace(F.regexp_replace(F.coalesce("_url", F.lit("")), "\r", "%0D"), "\n", "%0A")
    http = F.concat(F.lit("HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: "), F.col("_bytes").cast("string"), F.lit(END))
    block = F.when(revisit, http).otherwise(F.concat(http, F.col("_html")))
    head = [F.lit(MAGIC + "WARC-Type: "), F.when(revisit, "revisit").otherwise("response"),
            F.lit("\r\nWARC-Record-ID: <urn:page:"), F.coalesce("_id", F.lit("")), F.lit(">\r\nWARC-Date: " + DATE + "\r\nWARC-Target-URI: "), url,
            F.lit("\r\nContent-Type: application/http; msgtype=response\r\nWARC-Payload-Digest: sha1:"), F.col("_digest"),
            F.lit("\r\nWARC-Payload-Length: "), F.col("_bytes").cast("string"),
            F.when(revisit, F.concat(F.lit("\r\nWARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
                                           "\r\nWARC-Refers-To: <urn:page:"), F.col("_first").cast("string"), F.lit(">"))).otherwise(""),
            F.lit("\r\nContent-Length: "), F.octet_length(block).cast("string"), F.lit(END)]
    d.select(F.concat(*head, block).alias("value")).write.option("lineSep", END).text(path)
    return path


_FIELDS = {"type": "WARC-Type", "id": "WARC-Record-ID", "refers": "WARC-Refers-To", "digest": "WARC-Payload-Digest", "bytes": "WARC-Payload-Length",
           "uri": "WARC-Target-URI"}
_SCHEMA = ("file string, block long, idx long, rel long, len long, span long, "
           + ", ".join(f"{k} string" for k in _FIELDS) + ", got_bytes long, got_digest string")


def _payload(block: bytes) -> tuple[int, str]:
    body = block.partition(b"\r\n\r\n")[2]
    return len(body), base64.b32encode(hashlib.sha1(body).digest()).decode()


def _header(piece: bytes) -> tuple[dict, int, int] | None:
    """Fields, header length and content length of a piece that begins after the magic."""
    head, sep, _ = piece.partition(b"\r\n\r\n")
    if not sep:
        return None
    fields = {}
    for line in head.split(b"\r\n"):
        name, colon, value = line.partition(b":")
        if not colon:
            return None
        fields[name.decode("latin-1").strip().lower()] = value.decode("utf-8", "replace").strip()
    size = fields.get("content-length", "")
    return (fields, len(head) + 4, int(size)) if re.fullmatch("[0-9]{1,18}", size) else None


def _pieces(batches):
    """One row per piece: its place in its range, and what its header says. ``span`` is the length from
    the magic to the successor's, or null if the piece is no candidate."""
    last, idx, rel = None, 0, 0
    for pdf in batches:
        rows = []
        for file, block, piece in zip(pdf["file"], pdf["block"], pdf["value"], strict=True):
            if (file, block) != last:
                last, idx, rel = (file, block), 0, 0
            row = [file, block, idx, rel, len(piece), None] + [None] * (len(_FIELDS) + 2)
            h = _header(piece)
            if h and not (block == 0 and idx == 0):
                fields, head, size = h
                row[5] = len(MAGIC) + head + size + len(END)
                row[6: 6 + len(_FIELDS)] = [fields.get(n.lower()) for n in _FIELDS.values()]
                if head + size <= len(piece):
                    row[-2:] = _payload(piece[head: head + size])
            rows.append(row)
            idx, rel = idx + 1, rel + len(piece) + len(MAGIC)
        yield pd.DataFrame(rows, columns=[c.split()[0] for c in _SCHEMA.split(", ")])


def _read_pieces(spark: SparkSession, path: str) -> DataFrame:
    t = spark.read.option("lineSep", MAGIC).text(path)
    return t.select(F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"), F.col("value").cast("binary").alias("value"))


def _whole(key, pdf):
    """A record whose payload holds magic, from its pieces."""
    pdf = pdf.sort_values("at")
    data = MAGIC.encode().join(pdf["value"])
    _, head, size = _header(data)
    n, digest = _payload(data[head: head + size])
    return pd.DataFrame({"file": [key[0]], "start": [key[1]], "got_bytes": [n], "got_digest": [digest]})


def read_archives(spark: SparkSession, path: str) -> DataFrame:
    """``(file, start, type, id, refers, uri, payload_bytes, payload_digest, intact)`` of the records
    of all archives below ``path``. Bytes and digest of a response are those of the payload read, and
    ``intact`` says whether its header agrees; a revisit has those of its header. A chain that breaks
    off (a file cut short) ends the records of its file; files without a record give no rows."""
    p = write_stage(_read_pieces(spark, path).mapInPandas(_pieces, _SCHEMA), "warc-pieces")
    ranges = p.groupBy("file", "block").agg(F.sum(F.col("len") + len(MAGIC)).alias("_n"))
    up = Window.partitionBy("file").orderBy("block")
    ranges = ranges.withColumn("_base", F.sum("_n").over(up) - F.col("_n")).drop("_n")
    p = p.join(ranges, ["file", "block"]).withColumn("start", F.col("_base") + F.col("rel") - len(MAGIC))  # of the magic
    w = Window.partitionBy("file").orderBy("start")   # the pieces of one file, without their bytes
    c = p.filter("span is not null").withColumn("next", F.col("start") + F.col("span"))
    c = c.withColumn("_new", F.when(F.lag("next").over(w) == F.col("start"), 0).otherwise(1))
    c = write_stage(c.withColumn("run", F.sum("_new").over(w)), "warc-candidates")
    runs = c.groupBy("file", "run").agg(F.max_by("next", "start").alias("next"))
    hop = runs.join(c.select("file", F.col("start").alias("next"), F.col("run").alias("to")), ["file", "next"]).select(
        "file", "run", "to", F.col("next").alias("at"))
    hop = write_stage(hop, "warc-hops")
    reached = write_stage(c.filter("start = 0").select("file", "run", F.col("start").alias("at")), "warc-reached")
    while hop.take(1):
        more = reached.select("file", "run").join(hop, ["file", "run"]).select("file", F.col("to").alias("run"), "at")
        after = write_stage(reached.unionByName(more).distinct(), "warc-reached")
        second = hop.select("file", F.col("run").alias("to"), F.col("to").alias("_t"), F.col("at").alias("_a"))
        longer = write_stage(hop.select("file", "run", "to").join(second, ["file", "to"]).select(
            "file", "run", F.col("_t").alias("to"), F.col("_a").alias("at")), "warc-hops")
        drop_stage(hop)
        hop, reached = longer, after
    good = c.join(reached, ["file", "run"]).filter(F.col("start") >= F.col("at")).drop("at", "run", "_new")
    good = write_stage(good, "warc-records")
    broken = good.filter("got_bytes is null and type <> 'revisit'").select("file", F.col("start").alias("rec"), "next")
    n = broken.count()
    if n:
        # Their pieces: those that start inside them, in the order of the file; only these are read again.
        owner = p.select("file", "block", "idx", "start").join(broken.withColumnRenamed("rec", "start").withColumn("rec", F.col("start")), ["file", "start"], "left")
        owner = owner.withColumn("rec", F.last("rec", True).over(w)).withColumn("next", F.last("next", True).over(w))
        owner = write_stage(owner.filter(F.col("start") < F.col("next")).select("file", "block", "idx", "rec", F.col("start").alias("at")), "warc-owners")
        raw = _read_pieces(spark, path).mapInPandas(_numbered, "file string, block long, idx long, value binary")
        parts = raw.join(small_broadcast(owner, owner.count(), 256), ["file", "block", "idx"])
        fixed = parts.groupBy("file", F.col("rec").alias("start")).applyInPandas(_whole, "file string, start long, got_bytes long, got_digest string")
        fixed = fixed.select("file", "start", F.col("got_bytes").alias("_gb"), F.col("got_digest").alias("_gd"))
        good = good.join(fixed, ["file", "start"], "left").withColumn("got_bytes", F.coalesce("got_bytes", "_gb")).withColumn(
            "got_digest", F.coalesce("got_digest", "_gd"))
    told = F.regexp_replace("digest", "^sha1:", "")
    rev = F.col("type") == "revisit"
    return good.select("file", "start", "type", "id", "refers", "uri",
                       F.when(rev, F.col("bytes").try_cast("long")).otherwise(F.col("got_bytes")).alias("payload_bytes"),
                       F.when(rev, told).otherwise(F.col("got_digest")).alias("payload_digest"),
                       (rev | ((told == F.col("got_digest")) & (F.col("bytes").try_cast("long") == F.col("got_bytes")))).alias("intact"))


def _numbered(batches):
    last, idx = None, 0
    for pdf in batches:
        n = []
        for at in zip(pdf["file"], pdf["block"], strict=True):
            idx, last = (idx + 1 if at == last else 0), at
            n.append(idx)
        yield pdf.assign(idx=n)[["file", "block", "idx", "value"]]


def _page(col: str):
    return F.regexp_extract(col, "^<urn:page:(.*)>$", 1).try_cast("long")


def q_op2(spark, sf_dir):
    """All pages written as archives and read back."""
    path = write_archives(table(spark, sf_dir, "pages"), scratch_path(spark, "warc"))
    r = read_archives(spark, path)
    return r.select(_page("id").alias("page_id"), "payload_bytes", "payload_digest", F.col("type").alias("record_type"),
                    F.when(F.col("type") == "revisit", _page("refers")).alias("refers_to"))


_B32 = " || ".join(f"substr('{_ALPHABET}', ((('0x' || substr(h, {5 * g + 1}, 5))::BIGINT >> {s}) & 31) + 1, 1)" for g in range(8) for s in (15, 10, 5, 0))
SQL = f"""
WITH p AS (SELECT page_id, strlen(coalesce(html, '')) AS n, sha1(coalesce(html, '')) AS h FROM pages),
q AS (SELECT *, min(page_id) OVER (PARTITION BY h, n) AS first FROM p)
SELECT page_id, n AS payload_bytes, {_B32} AS payload_digest,
  CASE WHEN page_id = first THEN 'response' ELSE 'revisit' END AS record_type,
  CASE WHEN page_id <> first THEN first END AS refers_to FROM q"""
