"""Token counts from flat token files by a separator scan.

The files hold nothing but token ids of two bytes (little endian): for every document a head (its id
in base 64, ids below 64), its tokens, and the end-of-document id. There is no index. Reading, a
range of a file comes as pieces between the bytes of the separator; within a task they are
joined again and searched as arrays. The bytes of the separator also occur across two tokens, and
whether a range starts on a token or in the middle of one depends on all ranges before it. So every
range is searched in both phases; a prefix scan over the lengths of the ranges then
tells the true phase, and a second one stitches the documents that cross ranges.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from corate.llm.common import table, text_or_empty, write_stage
from corate.session import scratch_path

TOKENIZER = "/opt/tokenizers/byte_bpe_50k.tiktoken"
END = 50_256       # free in that vocabulary
HEAD = 12          # a sign and eleven digits of base 64
# Fixed value: the word pattern of that vocabulary.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
SEARCH_BYTES = 1 << 22
_SEP = END.to_bytes(2, "little")


def _encoder(ranks_file: bytes):
    import base64

    import tiktoken
    ranks = {base64.b64decode(a): int(b) for a, b in (x.split() for x in ranks_file.splitlines() if x)}
    return tiktoken.Encoding("ranks", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})


def _head(doc_id) -> list[int]:
    """0 for no id, else 1 or 2 by sign; then the digits."""
    if doc_id is None:
        return [0] * HEAD
    n = abs(int(doc_id))
    return [2 if doc_id < 0 else 1] + [n >> (6 * k) & 63 for k in range(HEAD - 1)]


def _unhead(h: list[int]):
    if len(h) < HEAD or h[0] == 0:
        return None
    n = sum((int(x) & 63) << (6 * k) for k, x in enumerate(h[1:HEAD])) & (1 << 63) - 1
    return -n if h[0] == 2 else n


def _writer(ranks):
    def encode(batches):
        enc = _encoder(ranks.value)
        for pdf in batches:
            out = [np.array(_head(None if pd.isna(i) else i) + enc.encode_ordinary(t), dtype="<u2").tobytes()
                   for i, t in zip(pdf["_id"].astype(object), pdf["_t"], strict=True)]
            yield pd.DataFrame({"value": out})
    return encode


def write_token_files(docs: DataFrame, path: str, *, tokenizer: str = TOKENIZER, id_col: str = "doc_id", text_col: str = "text") -> str:
    """The documents as flat token files below ``path``. A null text has no tokens; text that spells
    a special token is ordinary text. Ids are integers or null; other columns are ignored."""
    spark = docs.sparkSession
    # The vocabulary file, some MB whatever the corpus; executors need no copy of their own.
    ranks = spark.sparkContext.broadcast(bytes(spark.read.format("binaryFile").load(tokenizer).first()["content"]))
    t = docs.select(F.col(id_col).cast("long").alias("_id"), text_or_empty(text_col).alias("_t"))
    raw = t.mapInPandas(_writer(ranks), "value binary").select(F.col("value").cast("string").alias("value"))
    raw.write.option("encoding", "ISO-8859-1").option("lineSep", _SEP.decode("latin-1")).text(path)
    return path


class _Scan:
    """Searches a range in one phase: counts of the documents inside it, and of the pieces of
    documents before the first separator and after the last."""

    def __init__(self, phase: int, first: bool):
        self.skip, self.rest, self.open, self.head, self.rows = phase, b"", 0, [], []
        self.seen, self.lead, self.lead_id = int(first), 0, None  # a file starts as if after a separator

    def feed(self, data: bytes) -> None:
        data = self.rest + data
        if self.skip and data:
            data, self.skip = data[1:], 0
        even = len(data) // 2 * 2
        self.rest, a = data[even:], np.frombuffer(data, "<u2", even // 2)
        ends = np.flatnonzero(a == END)
        begin = 0
        for e in ends.tolist():
            head = _unhead(self.head + a[begin: min(e, begin + HEAD)].tolist())
            if self.seen == 0:
                self.lead, self.lead_id = self.open + e - begin, head
            else:
                self.rows.append((head, self.open + e - begin - HEAD))
            self.seen, self.open, self.head, begin = self.seen + 1, 0, [], e + 1
        if len(self.head) < HEAD:
            self.head += a[begin: begin + HEAD - len(self.head)].tolist()
        self.open += len(a) - begin


def _scan(batches):
    """Rows ``(file, block, bytes, phase, kind, doc_id, n)``: ``doc`` inside the range, ``lead`` the
    tokens before its first separator, ``tail`` those after its last (null without a separator: then
    ``lead`` has all of them)."""
    last, scans, total, held, size = None, None, 0, [], 0

    def result():
        flush()
        rows = []
        for phase, s in enumerate(scans):
            rows += [(*last, total, phase, "doc", i, n) for i, n in s.rows]
            left = s.open + len(s.rest)  # half a token: the next range leaves its other half out
            rows.append((*last, total, phase, "lead", *((s.lead_id, s.lead) if s.seen else (_unhead(s.head), left))))
            rows.append((*last, total, phase, "tail", *((_unhead(s.head), left) if s.seen else (None, None))))
        return pd.DataFrame(rows, columns=["file", "block", "bytes", "phase", "kind", "doc_id", "n"]).astype({"doc_id": "Int64", "n": "Int64"})

    def flush():
        nonlocal held, size
        for s in scans:
            s.feed(b"".join(held))
        held, size = [], 0

    for pdf in batches:
        for file, block, piece in zip(pdf["file"], pdf["block"], pdf["value"], strict=True):
            if (file, block) != last:
                if last:
                    yield result()
                last, scans, total = (file, block), [_Scan(0, block == 0), _Scan(1, block == 0)], 0
            held += [piece, _SEP]
            size += len(piece) + 2
            total += len(piece) + 2
            if size >= SEARCH_BYTES:
                flush()
    if last:
        yield result()


def count_tokens(spark: SparkSession, path: str) -> DataFrame:
    """``(doc_id, n_tokens)`` of every document in the token files below ``path``."""
    t = spark.read.option("encoding", "ISO-8859-1").option("lineSep", _SEP.decode("latin-1")).text(path)
    t = t.select(F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"), F.col("value").cast("binary").alias("value"))
    s = write_stage(t.mapInPandas(_scan, "file string, block long, bytes long, phase int, kind string, doc_id long, n long"), "token-scan")
    up = Window.partitionBy("file").orderBy("block")
    ranges = s.filter("kind = 'lead' and phase = 0").select("file", "block", F.pmod(F.sum("bytes").over(up) - F.col("bytes"), F.lit(2)).cast("int").alias("phase"))
    s = s.join(ranges, ["file", "block", "phase"])
    inside = s.filter("kind = 'doc'").select("doc_id", "n")
    # A document that crosses ranges: the tail of one, all of those without a separator, the lead of
    # the next. Heads hold no byte of the separator: one is whole in the tail or, if that is empty, in what follows.
    edge = s.filter("kind = 'lead'").select("file", "block", F.col("n").alias("lead"), F.col("doc_id").alias("lead_id")).join(
        s.filter("kind = 'tail'").select("file", "block", "doc_id", F.col("n").alias("tail")), ["file", "block"])
    before = Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    edge = edge.withColumn("_g", F.coalesce(F.sum(F.col("tail").isNotNull().cast("int")).over(before), F.lit(0)))
    closed = edge.groupBy("file", "_g").agg(F.sum("lead").alias("lead"), F.min_by("lead_id", "block").alias("lead_id"))
    opened = edge.filter("tail is not null").select("file", (F.col("_g") + 1).alias("_g"), "doc_id", "tail")
    crossing = opened.join(closed, ["file", "_g"]).select(
        F.when(F.col("tail") > 0, F.col("doc_id")).otherwise(F.col("lead_id")).alias("doc_id"), (F.col("tail") + F.col("lead") - HEAD).alias("n"))
    return inside.unionByName(crossing).select("doc_id", F.col("n").alias("n_tokens"))


def q_op5(spark, sf_dir):
    """Token counts of all documents."""
    path = write_token_files(table(spark, sf_dir, "documents"), scratch_path(spark, "tokens"))
    return count_tokens(spark, path)
