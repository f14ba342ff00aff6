"""Connected components of a links table by contraction: no driver-side graph, and no task that a large component fills."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from umbra.llm import text as tx
from umbra.llm.shared import cut, in_arrow

MOST = 1 << 20  # links that a task contracts at once


def _rank(x: np.ndarray) -> np.ndarray:
    """An order of nodes that has nothing to do with how the links were made, so paths contract as fast as stars."""
    with np.errstate(over="ignore"):
        return tx.mix(x.view(np.uint64) ^ tx.U64(0x2545F4914F6CDD1D))


def roots(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(node, root) of all nodes of the links a - b: the node of least rank in each component."""
    nodes, at = np.unique(np.concatenate([a, b]), return_inverse=True)
    place = np.empty(len(nodes), np.int64)
    place[np.argsort(_rank(nodes), kind="stable")] = np.arange(len(nodes))
    node_at = np.empty(len(nodes), np.int64)
    node_at[place] = np.arange(len(nodes))
    parent = list(range(len(nodes)))  # by rank
    for x, y in zip(place[at[: len(a)]].tolist(), place[at[len(a) :]].tolist()):
        while parent[x] != x:
            parent[x] = x = parent[parent[x]]
        while parent[y] != y:
            parent[y] = y = parent[parent[y]]
        if x < y:
            parent[y] = x
        else:
            parent[x] = y
    top = np.array(parent, np.int64)
    while True:
        above = top[top]
        if (above == top).all():
            break
        top = above
    return nodes, nodes[node_at[top[place]]]


def _contracted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Links (a, b) to (node, root), where root is of the links that this task sees at once."""
    held, size = [], 0

    def stars():
        node, root = roots(*map(np.concatenate, zip(*held)))
        return pa.RecordBatch.from_arrays([pa.array(node), pa.array(root)], ["node", "root"])

    for batch in batches:
        if batch.num_rows:
            held.append((batch.column(0).to_numpy(), batch.column(1).to_numpy()))
            size += batch.num_rows
        if size >= MOST:
            yield stars()
            held, size = [], 0
    if held:
        yield stars()


def _met(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows sorted by (node, rank of the root) to (node, its first root, false), and a link (root, first root, true)
    for each further root of a node."""
    last = first = None
    for batch in batches:
        if not batch.num_rows:
            continue
        node, root = batch.column(0).to_numpy(), batch.column(1).to_numpy()
        new = np.append(last is None or node[0] != last, node[1:] != node[:-1])
        begin = np.flatnonzero(new)
        firsts = np.concatenate([[0 if first is None else first], root[begin]])[np.cumsum(new)]
        again = ~new & (root != firsts)
        yield pa.RecordBatch.from_arrays([pa.array(np.concatenate([node[begin], root[again]])), pa.array(np.concatenate([root[begin], firsts[again]])), pa.array(np.arange(len(begin) + int(again.sum())) >= len(begin))], ["node", "root", "link"])
        last, first = node[-1], firsts[-1]


def _ranked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in _contracted(batches):
        rank = _rank(batch.column(1).to_numpy())
        yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(tx.as_long(rank >> tx.U64(1)))], ["node", "root", "rank"])


def components(links: DataFrame, levels: int = 60) -> DataFrame:
    """(node, component) of every node of links (a, b); component is the least node that can be reached.

    Each task replaces its links by stars around a node of least rank. A node that hangs on several stars links their
    centres; these links, which leave out all nodes but centres, are the next level's, packed so that a task has as
    many as it contracts at once. No step gathers the rows of a centre. Links may repeat, point either way or be
    loops; rows with a null are ignored; without links there are no rows.
    """
    edges, known = links.where("a is not null and b is not null").select("a", "b"), []
    for _ in range(levels):
        stars = edges.transform(in_arrow, _ranked, "node long, root long, rank long")
        level = cut(stars.repartition("node").sortWithinPartitions("node", "rank").select("node", "root").transform(in_arrow, _met, "node long, root long, link boolean"))
        known.append(level.where("not link").select("node", "root"))
        rest = level.where("link").select(F.col("node").alias("a"), F.col("root").alias("b"))
        many = rest.count()
        if not many:
            break
        edges = rest.repartition(-(-many // MOST))
    else:
        raise RuntimeError(f"not contracted after {levels} levels")
    found = known[0]
    for above in known[1:]:
        found = found.join(above.select(F.col("node").alias("of"), F.col("root").alias("top")), found["root"] == F.col("of"), "left").select("node", F.coalesce("top", "root").alias("root"))
    least = found.groupBy("root").agg(F.min("node").alias("component"))
    return found.join(least, "root").select("node", "component")
