"""WARC fixity audit with Merkle trees.

A record's leaf is the SHA-256 of its bytes. The lowest nodes cover ``span`` bytes of an archive each, a node above
covers ``fan_out`` of these ranges, and each hashes the hashes and ranges of what begins in it, in order; the archives'
roots, by name, are the leaves of a tree above. Ranges are fixed, so a lost record changes the nodes above it and no
others. Two replicas are compared from the root down: only children of nodes that differ, or that one replica lacks,
are joined on the next level, until the records are found.

A node is made from at most fan_out rows, or the records that begin within span bytes, so no group grows.

Rows: a record with null bytes counts as empty. An archive or record that one replica lacks is reported as missing
there. Records at one offset of an archive are one leaf: the hash of their digests, in order.
A record without an archive or an offset equals none, so it is reported for either replica. Empty replicas have no nodes and
no mismatch. Extra columns are not read.
"""

from __future__ import annotations

import gzip
import io
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from umbra.llm.shared import cut, in_arrow

SPAN = 1 << 16  # bytes of an archive for each lowest node
RECORD = "archive string, offset long, target string, kind string, payload binary, n_bytes long"


def render(target: str, payload: bytes, kind: str = "resource") -> bytes:
    """A WARC 1.1 record."""
    head = f"WARC/1.1\r\nWARC-Type: {kind}\r\nWARC-Target-URI: {target}\r\nContent-Type: text/html\r\nContent-Length: {len(payload)}\r\n\r\n"
    return head.encode() + payload + b"\r\n\r\n"


def parse(data: bytes) -> Iterator[tuple[int, str, str, bytes, int]]:
    """(offset, target, kind, payload, bytes) of the records of a WARC file; gzip members are read as one stream.

    What is cut short ends the file; bytes between records are skipped.
    """
    if data[:2] == b"\x1f\x8b":
        data = gzip.GzipFile(fileobj=io.BytesIO(data)).read()
    at = data.find(b"WARC/")
    while at >= 0:
        body = data.find(b"\r\n\r\n", at)
        if body < 0:
            return
        head = dict((k.strip().lower(), v.strip()) for k, _, v in (x.partition(":") for x in data[at:body].decode("utf-8", "replace").split("\r\n")[1:]))
        size = int(head.get("content-length", "0")) if head.get("content-length", "0").isdigit() else 0
        end = body + 4 + size
        if end > len(data):
            return
        stop = end + 4 if data[end : end + 4] == b"\r\n\r\n" else end
        yield at, head.get("warc-target-uri", ""), head.get("warc-type", ""), data[body + 4 : end], stop - at
        at = data.find(b"WARC/", stop)


def read_warc(spark: SparkSession, path: str) -> DataFrame:
    """Records of the WARC files below path, as RECORD."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for name, content in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                rows = [(name, *r) for r in parse(content)]
                if rows:
                    yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), (pa.string(), pa.int64(), pa.string(), pa.string(), pa.binary(), pa.int64()))], ["archive", "offset", "target", "kind", "payload", "n_bytes"])

    return spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path).select("path", "content").transform(in_arrow, run, RECORD)


def packed(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", body_col: str = "html", records: int = 256, keep: dict[str, Column] | None = None) -> DataFrame:
    """(archive, offset, n_bytes, record, id): pages as records of archives of at most ``records`` consecutive ids.

    keep: columns to have instead of record, made from record and id where the pages are read, so that what moves to
    learn the offsets is these and the lengths.
    """
    body = F.coalesce(F.col(body_col), F.lit("")).cast("binary")
    head = F.concat(F.lit("WARC/1.1\r\nWARC-Type: resource\r\nWARC-Target-URI: "), F.coalesce(F.col(url_col), F.lit("")), F.lit("\r\nContent-Type: text/html\r\nContent-Length: "), F.octet_length(body).cast("string"), F.lit("\r\n\r\n"))
    made = pages.select(F.col(id_col).alias("id"), F.floor(F.col(id_col) / records).cast("string").alias("archive"), F.concat(head.cast("binary"), body, F.lit("\r\n\r\n").cast("binary")).alias("record"))
    kept = keep if keep is not None else {"record": F.col("record")}
    sized = made.select("id", "archive", F.octet_length("record").cast("long").alias("n_bytes"), *[c.alias(name) for name, c in kept.items()])
    w = Window.partitionBy("archive").orderBy("id").rowsBetween(Window.unboundedPreceding, -1)
    return sized.select("archive", F.coalesce(F.sum("n_bytes").over(w), F.lit(0)).alias("offset"), "n_bytes", *kept, "id")


def leaves(records: DataFrame) -> DataFrame:
    """(archive, offset, n_bytes, hash) of records (archive, offset, record)."""
    record = F.coalesce(F.col("record"), F.lit(b""))
    return records.select("archive", F.col("offset").cast("long").alias("offset"), F.octet_length(record).cast("long").alias("n_bytes"), F.sha2(record, 256).alias("hash"))


def trees(leaf: DataFrame, fan_out: int = 16, span: int = SPAN, most: int | None = None) -> list[DataFrame]:
    """Levels (archive, node, first, stop, hash) from the records to one root an archive.

    node is the offset, then the number of the range of span bytes, then that divided by fan_out on each level.
    most: where the largest archive's last record begins, found out if not given.
    """
    digests = F.array_sort(F.collect_list("hash"))
    one = F.when(F.size(digests) == 1, digests[0]).otherwise(F.sha2(F.array_join(digests, ";"), 256))
    level = cut(leaf.groupBy("archive", F.col("offset").alias("node")).agg(F.min("offset").alias("first"), F.max(F.col("offset") + F.col("n_bytes")).alias("stop"), one.alias("hash")))
    most = (level.agg(F.max("node")).first()[0] or 0) if most is None else most
    level, found, most = cut(_above(level, span)), [level], most // span
    found.append(level)
    while most > 0:
        level, most = cut(_above(level, fan_out)), most // fan_out
        found.append(level)
    return found


def _above(level: DataFrame, wide: int) -> DataFrame:
    text = F.concat_ws(":", F.col("node").cast("string"), F.col("first").cast("string"), F.col("stop").cast("string"), "hash")
    child = level.select("archive", F.floor(F.col("node") / wide).alias("node"), "first", "stop", F.struct(F.col("node").alias("rank"), text.alias("text")).alias("child"))
    below = F.array_join(F.array_sort(F.collect_list("child")).getField("text"), ";")
    return child.groupBy("archive", "node").agg(F.min("first").alias("first"), F.max("stop").alias("stop"), F.sha2(below, 256).alias("hash"))


def audit(one: DataFrame, two: DataFrame, fan_out: int = 16, span: int = SPAN) -> DataFrame:
    """(archive, offset, n_bytes, hash_one, hash_two, status) of the records that differ: corrupt or missing.

    one, two: (archive, offset, record) of each replica.
    """
    return compared(leaves(one), leaves(two), fan_out, span)


def compared(one: DataFrame, two: DataFrame, fan_out: int = 16, span: int = SPAN) -> DataFrame:
    """As audit, from the leaves (archive, offset, n_bytes, hash) of each replica.

    Equal roots of the replicas end the audit; the archives' roots are compared first.
    """
    most = max((x.agg(F.max("offset")).first()[0] or 0) for x in (one, two))
    left, right = trees(one, fan_out, span, most), trees(two, fan_out, span, most)
    suspects: DataFrame | None = None
    for depth in range(len(left) - 1, -1, -1):
        x, y = left[depth], right[depth]
        if suspects is not None:
            parents = suspects.select("archive", F.col("node").alias("parent"))
            x, y = (z.withColumn("parent", F.floor(F.col("node") / (fan_out if depth else span))).join(parents, ["archive", "parent"], "left_semi").drop("parent") for z in (x, y))
        p, q = x.alias("p"), y.alias("q")
        both = p.join(q, (F.col("p.archive") == F.col("q.archive")) & (F.col("p.node") == F.col("q.node")), "full_outer")
        differ = both.where(~F.col("p.hash").eqNullSafe(F.col("q.hash")))
        suspects = cut(differ.select(F.coalesce("p.archive", "q.archive").alias("archive"), F.coalesce("p.node", "q.node").alias("node"), F.coalesce(F.col("p.stop") - F.col("p.first"), F.col("q.stop") - F.col("q.first")).alias("n_bytes"), F.col("p.hash").alias("hash_one"), F.col("q.hash").alias("hash_two")))
    status = F.when(F.col("hash_two").isNull(), "missing in two").when(F.col("hash_one").isNull(), "missing in one").otherwise("corrupt")
    return suspects.select("archive", F.col("node").alias("offset"), "n_bytes", "hash_one", "hash_two", status.alias("status"))


def root(tree: list[DataFrame]) -> str:
    """The hash over all archives' roots, through 5 levels of 16 children by the hash of the archives' names."""
    text = F.concat_ws(":", "archive", F.col("first").cast("string"), F.col("stop").cast("string"), "hash")
    rows = tree[-1].select(F.pmod(F.xxhash64("archive"), F.lit(16**5)).alias("node"), text.alias("text"))
    for _ in range(6):
        below = F.array_join(F.array_sort(F.collect_list("text")), ";")
        rows = rows.groupBy("node").agg(F.sha2(below, 256).alias("hash"))
        rows = rows.select(F.floor(F.col("node") / 16).alias("node"), F.concat_ws(":", F.col("node").cast("string"), "hash").alias("text"))
    return ";".join(sorted(r["text"] for r in rows.collect()))
