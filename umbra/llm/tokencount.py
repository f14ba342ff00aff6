"""Token counts by a separator scan of flat, unindexed token files.

A flat file holds the ids of one document after another, each closed by the end-of-document id, and no index. It is
read in blocks of ``block`` ids that know nothing of documents. Each block is searched for separators at once; a
prefix scan over the blocks' summaries (ids, separators, place of the last one) stitches the documents that cross
blocks. The scan has two levels, so a file of any number of blocks is not summed in one task.

Rows: a null or empty text is a document of no tokens. Ids after the last separator are a document that is not
closed. An empty file has no documents. Repeated rows count as often as they occur; extra columns are not read.
"""

from __future__ import annotations

import re
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from umbra.llm.shared import cut, in_arrow, shared_dir, shuffle_partitions

BLOCK = 1 << 16
SUPER = 4096  # blocks summed together first
RANGE = 64  # blocks of a file that a task reads in one go


def ranks(path: str) -> dict[bytes, int]:
    """The ranks of a tiktoken file; read on the driver and sent with the tasks."""
    import base64

    with open(path, "rb") as f:
        return {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}


_made: dict[tuple, object] = {}


def _encoding(vocabulary: dict[bytes, int], pattern: str):
    key = (pattern, len(vocabulary), hash(frozenset(vocabulary.items())))
    if key not in _made:
        import tiktoken

        _made.clear()
        _made[key] = tiktoken.Encoding("flat", pat_str=pattern, mergeable_ranks=vocabulary, special_tokens={})
    return _made[key]


#: The pre-tokenisation pattern of the public byte-level BPE vocabularies (a fixed value of those files).
PATTERN = r"""'(?:[sdmt]|ll|ve|re)| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
#: White space as the pattern has it, in runs that its look-ahead would go back over, step by step, on the stack.
LONG_BLANK = re.compile("[\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]{2000,}")


def encoded(encoding, text: str) -> list[int]:
    """The ids of a text under PATTERN. A run of white space begins a new piece and, but for its last character if more
    text follows, is one; so long runs are taken out without changing an id."""
    ids, at = [], 0
    for run in LONG_BLANK.finditer(text):
        stop = run.end() - (run.end() < len(text))
        ids += encoding.encode_ordinary(text[at : run.start()])
        ids += encoding._encode_single_piece(text[run.start() : stop])
        at = stop
    return ids + encoding.encode_ordinary(text[at:])


def write_flat(docs: DataFrame, vocabulary: dict[bytes, int], end_id: int, folder: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(file, n_bytes, ordinal, doc) of every row, after flat files of all texts' ids have been written below folder, one
    by each task: little-endian uint16 (uint32 if ids need it).

    folder is one that all executors share. A task that is run again writes a file of another name, and only the files
    that are named in the result count.
    """
    kind = "<u4" if width_of(vocabulary, end_id) == 4 else "<u2"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoding, task = _encoding(vocabulary, PATTERN), TaskContext.get()
        store, place = pa.fs.FileSystem.from_uri(folder)
        name = f"{task.partitionId():06d}-{task.taskAttemptId()}.tok"
        store.create_dir(place, recursive=True)
        ordinal, size = 0, 0
        with store.open_output_stream(f"{place}/{name}") as out:
            for batch in batches:
                for text in batch.column(1):
                    ids = encoded(encoding, text.as_py() or "")
                    ids.append(end_id)
                    size += out.write(np.array(ids, kind).tobytes())
                n = batch.num_rows
                yield pa.RecordBatch.from_arrays([pa.array([name] * n, pa.string()), pa.array(np.arange(ordinal, ordinal + n)), batch.column(0).cast(pa.int64())], ["file", "ordinal", "doc"])
                ordinal += n

    return cut(docs.select(id_col, text_col).transform(in_arrow, run, "file string, ordinal long, doc long"))


def width_of(vocabulary: dict[bytes, int], end_id: int) -> int:
    return 4 if max(end_id, max(vocabulary.values(), default=0)) > 0xFFFF else 2


def read_flat(spark: SparkSession, path: str, block: int = BLOCK, width: int = 2, files: DataFrame | None = None) -> DataFrame:
    """(file, block, tokens) of the flat token files below path, each of width bytes an id, of any size.

    Files are listed by Spark and read by ranges of bytes, so a task holds a block and a file of any size is read by
    many tasks. files (file): the names that count, if not all do.
    """
    step = block * width

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, held = None, None
        for batch in batches:
            for name, uri, low, high in zip(*(c.to_pylist() for c in batch.columns)):
                if uri != last:
                    if held is not None:
                        held.close()
                    store, place = pa.fs.FileSystem.from_uri(uri)
                    last, held = uri, store.open_input_file(place)
                for k in range(low, high):
                    yield pa.RecordBatch.from_arrays([pa.array([name]), pa.array([k], pa.int64()), pa.array([held.read_at(min(step, held.size() - k * step), k * step)], pa.binary())], ["file", "block", "tokens"])
        if held is not None:
            held.close()

    listed = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path).where("length > 0")
    listed = listed.select(F.element_at(F.split("path", "/"), -1).alias("file"), F.regexp_replace("path", "^file:/+", "file:///").alias("uri"), F.ceil(F.col("length") / step).alias("many"))
    if files is not None:
        listed = listed.join(files.select("file").distinct(), "file", "left_semi")
    parts = listed.select("file", "uri", "many", F.explode(F.sequence(F.lit(0), F.col("many") - 1, F.lit(RANGE))).alias("low"))
    ranges = parts.select("file", "uri", "low", F.least("many", F.col("low") + RANGE).alias("high"))
    return ranges.repartition(shuffle_partitions(spark), "uri", "low").transform(in_arrow, run, "file string, block long, tokens binary")


def scan(blocks: DataFrame, end_id: int, width: int = 2, group: int = SUPER) -> DataFrame:
    """(file, ordinal, start, n_tokens, closed) of every document of blocks (file, block, tokens)."""
    kind = {2: "<u2", 4: "<u4"}[width]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n, parts = [], []
            for tokens in batch.column(2):
                ids = np.frombuffer(tokens.as_buffer(), kind) if tokens.is_valid else np.zeros(0, kind)
                n.append(len(ids))
                parts.append(np.flatnonzero(ids == end_id).astype(np.int64))
            edges = np.concatenate([[0], np.cumsum([len(p) for p in parts])]).astype(np.int32)
            flat = np.concatenate(parts) if parts else np.zeros(0, np.int64)
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(n, pa.int64()), pa.ListArray.from_arrays(pa.array(edges), pa.array(flat))], ["file", "block", "n", "ends"])

    file = blocks.schema["file"].dataType.simpleString()
    found = cut(blocks.select("file", F.col("block").cast("long").alias("block"), "tokens").transform(in_arrow, run, f"file {file}, block long, n long, ends array<long>"))
    short = found.select("file", "block", "n", F.size("ends").cast("long").alias("k"), F.try_element_at("ends", F.lit(-1)).alias("last"), F.floor(F.col("block") / group).alias("super"))
    before = lambda w: w.rowsBetween(Window.unboundedPreceding, -1)
    inner = Window.partitionBy("file", "super").orderBy("block")
    local = short.withColumn("ids_in", F.coalesce(F.sum("n").over(before(inner)), F.lit(0))).withColumn("docs_in", F.coalesce(F.sum("k").over(before(inner)), F.lit(0)))
    local = local.withColumn("last_in", F.max(F.col("ids_in") + F.col("last")).over(before(inner)))
    sums = local.groupBy("file", "super").agg(F.sum("n").alias("n_all"), F.sum("k").alias("k_all"), F.max(F.col("ids_in") + F.col("last")).alias("last_all"))
    outer = Window.partitionBy("file").orderBy("super")
    sums = sums.withColumn("ids_before", F.coalesce(F.sum("n_all").over(before(outer)), F.lit(0))).withColumn("docs_before", F.coalesce(F.sum("k_all").over(before(outer)), F.lit(0)))
    sums = sums.withColumn("last_before", F.max(F.col("ids_before") + F.col("last_all")).over(before(outer)))
    base = local.join(sums, ["file", "super"]).select("file", "block", (F.col("ids_before") + F.col("ids_in")).alias("at"), (F.col("docs_before") + F.col("docs_in")).alias("docs"), F.coalesce(F.col("ids_before") + F.col("last_in"), F.col("last_before"), F.lit(-1)).alias("open"))
    ends = found.join(base, ["file", "block"]).select("file", "docs", "at", "open", "ends", F.posexplode("ends").alias("k", "place"))
    start = F.when(F.col("k") == 0, F.col("open")).otherwise(F.col("at") + F.get("ends", F.col("k") - 1)) + 1
    closed = ends.select("file", (F.col("docs") + F.col("k")).alias("ordinal"), start.alias("start"), (F.col("at") + F.col("place") - start).alias("n_tokens"), F.lit(True).alias("closed"))
    totals = sums.groupBy("file").agg(F.sum("n_all").alias("n"), F.sum("k_all").alias("k"), F.max(F.col("ids_before") + F.col("last_all")).alias("last"))
    first = F.coalesce("last", F.lit(-1)) + 1
    rest = totals.where(F.col("n") > first).select("file", F.col("k").alias("ordinal"), first.alias("start"), (F.col("n") - first).alias("n_tokens"), F.lit(False).alias("closed"))
    return closed.unionByName(rest)


def count(docs: DataFrame, vocabulary: dict[bytes, int], end_id: int, id_col: str = "doc_id", text_col: str = "text", block: int = BLOCK) -> DataFrame:
    """(id_col, file, ordinal, start, n_tokens) of every row: docs are written as flat files, and found again by their separators."""
    spark = docs.sparkSession
    folder = f"{shared_dir(spark)}/flat-{uuid.uuid4().hex}"
    named = write_flat(docs, vocabulary, end_id, folder, id_col, text_col)
    if named.isEmpty():
        return named.select(F.col("doc").alias(id_col), "file", "ordinal", F.lit(0).cast("long").alias("start"), F.lit(0).cast("long").alias("n_tokens"))
    found = scan(read_flat(spark, folder, block, width_of(vocabulary, end_id), named), end_id, width_of(vocabulary, end_id))
    return named.join(found, ["file", "ordinal"]).select(F.col("doc").alias(id_col), "file", "ordinal", "start", "n_tokens")
