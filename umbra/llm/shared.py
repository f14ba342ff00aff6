"""What the operators of this subpackage share: the shared folder, and streaming over sorted rows."""

from __future__ import annotations

import ctypes
import tempfile
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors share: spark.checkpoint.dir, or a folder of our own where that is unset and all runs on
    this machine (tests)."""
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if not folder:
        current = spark.sparkContext._jsc.sc().getCheckpointDir()
        if current.isDefined():
            return current.get()
        if not spark.sparkContext.master.startswith("local") or spark.sparkContext.master.startswith("local-cluster"):
            raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
        folder = tempfile.mkdtemp(prefix="umbra-checkpoint-")
        spark.sparkContext.setCheckpointDir(folder)
    return folder


def cut(df: DataFrame) -> DataFrame:
    """df computed once and kept in the shared folder, so that a lost executor never costs the steps before."""
    shared_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def in_arrow(df: DataFrame, function, schema) -> DataFrame:
    """df.mapInArrow(function, schema), after which a worker, which Spark keeps for later tasks, gives freed memory back."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from function(batches)
        pa.default_memory_pool().release_unused()
        if trim := getattr(ctypes.CDLL(None), "malloc_trim", None):
            trim(0)

    return df.mapInArrow(run, schema)


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def sorted_groups(batches: Iterator[pa.RecordBatch], keys: list[str]) -> Iterator[pa.Table]:
    """Groups of adjacent rows with equal keys, from batches that are sorted by the keys; no key is null.

    Holds one group and one batch in memory, so the caller must bound the size of a group.
    """
    import numpy as np

    held: list[pa.Table] = []
    last = None
    for batch in batches:
        n = batch.num_rows
        if not n:
            continue
        columns = [batch.column(batch.schema.get_field_index(k)).to_numpy(zero_copy_only=False) for k in keys]
        change = np.zeros(n, dtype=bool)
        for c in columns:
            change[1:] |= c[1:] != c[:-1]
        first = tuple(c[0] for c in columns)
        change[0] = last is not None and first != last
        at = np.flatnonzero(change)
        table = pa.Table.from_batches([batch])
        edges = [0, *at.tolist(), n]
        for k in range(len(edges) - 1):
            if (k or change[0]) and held:
                yield pa.concat_tables(held)
                held = []
            if edges[k + 1] > edges[k]:
                held.append(table.slice(edges[k], edges[k + 1] - edges[k]))
        last = tuple(c[-1] for c in columns)
    if held:
        yield pa.concat_tables(held)


def among(rows: DataFrame, ids: DataFrame, id_col: str, most_bits: int = 1 << 26) -> DataFrame:
    """rows without most of those whose id_col, a long, is not in ids (one column), so that a join with ids moves less.

    A Bloom filter of at most most_bits bits (8 MB) is made on the executors, ORed, and sent to the tasks. It never
    drops a row whose id is in ids; beyond what it can hold it only lets more of the others pass.
    """
    import numpy as np

    from umbra.llm.text import U64, mix

    many = ids.count()
    bits = 1 << 10
    while bits < 12 * many and bits < most_bits:
        bits *= 2
    if many * 2 > bits:
        return rows

    def places(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        h = mix(column.fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64).view(np.uint64) ^ U64(0x51ED270B))
        return (h & U64(bits - 1)).astype(np.int64), ((h >> U64(32)) & U64(bits - 1)).astype(np.int64)

    def marked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        flags = np.zeros(bits, bool)
        for batch in batches:
            for at in places(batch.column(0)):
                flags[at] = True
        yield pa.RecordBatch.from_arrays([pa.array([np.packbits(flags).tobytes()], pa.binary())], ["bits"])

    def ored(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(bits // 8, np.uint8)
        for batch in batches:
            for x in batch.column(0):
                total |= np.frombuffer(x.as_buffer(), np.uint8)
        yield pa.RecordBatch.from_arrays([pa.array([total.tobytes()], pa.binary())], ["bits"])

    parts = ids.transform(in_arrow, marked, "bits binary").coalesce(8).transform(in_arrow, ored, "bits binary").collect()
    total = np.zeros(bits // 8, np.uint8)
    for r in parts:
        total |= np.frombuffer(r["bits"], np.uint8)
    sent, where = rows.sparkSession.sparkContext.broadcast(total.tobytes()), rows.columns.index(id_col)

    def passed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        flags = np.unpackbits(np.frombuffer(sent.value, np.uint8)).astype(bool)
        for batch in batches:
            a, b = places(batch.column(where))
            yield batch.filter(pa.array(flags[a] & flags[b]))

    return in_arrow(rows, passed, rows.schema)
