"""Exact n-gram Jaccard join with signature trees, and the components of its links.

1. Texts with equal shingle sets form a class; only one text of each goes on.
2. Routing: a set's rarest ``n - ceil(t * n) + 1`` shingles, in one global order, hold a shingle of every set that
   is similar enough (prefix filter); of the smaller of two sets, fewer shingles will do, and holders of a shingle
   are parted where their sizes are too different. Frequent shingles, which a bounded summary of counts names, come last in the
   order, so a shared passage or line draws no crowd. The sets that hold a routing shingle go to the bucket of its
   smallest holder, each once for a bucket however many shingles lead there.
3. In a bucket, the sets' bitmaps are leaves of a signature tree: a node holds the OR of its leaves' token bitmaps,
   their range of sizes and the most tokens of a leaf that share a bit with another of its tokens. Two nodes are
   descended only if the greatest overlap these allow can reach the threshold. The leaf pairs that are reached can be
   links; a bucket tells a forest that joins what such pairs join. The components of all forests are families: two
   linked sets are of one family, and a set is of one only.
4. So a set of shingles is sent once, to its family. There a tree compares the leaf pairs it reaches exactly, and
   skips what is one component already.

Both joins are dealt out alike: a group over ``block`` sets (or 16 MB) is spread over blocks, with its first set in
each. The sets that are then not of the group's largest component are held against all of the group, block by block, so
no task holds more than two blocks and no link is lost.

Rows: a null text or one without a word has an empty set and links with nothing; a text with fewer than ``width``
words has its whole sequence as one shingle. Repeated rows share a class. The least id names a component, so ties
don't arise. Ids must be distinct integers. Extra columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from umbra.llm import text as tx
from umbra.llm.components import components
from umbra.llm.shared import among, cut, in_arrow, shuffle_partitions, sorted_groups

HOT_KEPT = 1 << 16  # shingles in the summary of frequent ones
HOT_LEAST = 6  # times that one slice of about 8 MB of text holds them
SLICE = 1_000_000  # shingles in a slice
BLOCK, BLOCK_BYTES = 2048, 16 << 20
FAN_OUT = 16  # children of a node


def shingle_sets(raw: np.ndarray, starts: np.ndarray, ends: np.ndarray, width: int) -> Iterator[tuple[int, np.ndarray]]:
    """(row, sorted distinct shingle hashes) of each text with a word."""
    for i, j in tx.chunks(starts, ends):
        w = tx.Words(raw, starts[i:j], ends[i:j], lower=True)
        hashes = w.word_hashes()
        windows = tx.window_hashes(hashes, width)
        for k in np.flatnonzero(w.count):
            a, n = int(w.first[k]), int(w.count[k])
            if n >= width:
                yield i + int(k), np.unique(windows[a : a + n - width + 1])
            else:
                yield i + int(k), tx.window_hashes(hashes[a : a + n], n)


def set_hashes(s: np.ndarray) -> tuple[int, int]:
    """128 bits that depend on the set alone."""
    a = np.add.reduce(tx.mix(s ^ tx.U64(0x1234567)))
    b = np.add.reduce(tx.mix(s + tx.U64(0x7654321)))
    return int(a.astype(np.uint64).view(np.int64)), int(b.astype(np.uint64).view(np.int64))


def _texts(batch: pa.RecordBatch, k: int):
    column = batch.column(k)
    return tx.string_bytes(column.fill_null("") if column.null_count else column)


def _sizes(width: int):
    """Rows of kind 0: doc, n, h1, h2, bitmap. Rows of kind 1: a frequent shingle as h1, its count as n."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0

        def frequent():
            values, n = np.unique(np.concatenate(held), return_counts=True)
            most = np.argsort(-n, kind="stable")[:HOT_KEPT]
            most = most[n[most] >= HOT_LEAST]
            m = len(most)
            return pa.RecordBatch.from_arrays([pa.array(np.ones(m, np.int32)), pa.nulls(m, pa.int64()), pa.array(n[most].astype(np.int64)), pa.array(tx.as_long(values[most])), pa.array(np.zeros(m, np.int64)), pa.nulls(m, pa.binary())], names)

        names = ["kind", "doc", "n", "h1", "h2", "bits"]
        for batch in batches:
            n, h1, h2 = (np.zeros(batch.num_rows, np.int64) for _ in range(3))
            bits: list[bytes | None] = [None] * batch.num_rows
            for k, s in shingle_sets(*_texts(batch, 1), width):
                n[k] = len(s)
                h1[k], h2[k] = set_hashes(s)
                bits[k] = bitmap(s, resolution(len(s))).tobytes()
                held.append(s)
                size += len(s)
                if size > SLICE:
                    yield frequent()
                    held, size = [], 0
            yield pa.RecordBatch.from_arrays([pa.array(np.zeros(batch.num_rows, np.int32)), batch.column(0).cast(pa.int64()), *map(pa.array, (n, h1, h2)), pa.array(bits, pa.binary())], names)
        if held:
            yield frequent()

    return run


def prefix(s: np.ndarray, hot: np.ndarray, level: np.ndarray, percent: int) -> np.ndarray:
    """The shingles of s that route it, rarest first: so many that similar sets share one."""
    n = len(s)
    many = n - -(-percent * n // 100) + 1
    if len(hot):
        at = np.minimum(np.searchsorted(hot, s), len(hot) - 1)
        rank = np.where(hot[at] == s, level[at], 0)
        if rank.any():
            return s[np.argsort(rank, kind="stable")[:many]]
    return s[:many]


def _routes(width: int, percent: int, hot: np.ndarray, level: np.ndarray):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def rows(parts: list[np.ndarray], names: list[tuple]) -> pa.RecordBatch:
            ids, n, m = np.array(names, np.int64).T
            first = n - -(-2 * percent * n // (100 + percent)) + 1  # one of these is shared with each larger similar set
            place = np.arange(int(m.sum())) - np.repeat(np.cumsum(m) - m, m)
            size = 2 * np.repeat(n, m) + (place >= np.repeat(first, m))
            return pa.RecordBatch.from_arrays([pa.array(tx.as_long(np.concatenate(parts))), pa.array(size), pa.array(np.repeat(ids, m))], ["shingle", "size", "class"])

        for batch in batches:
            parts, names, seen, held = [], [], set(), 0
            for _, s in shingle_sets(*_texts(batch, 0), width):
                name = set_hashes(s)
                if name not in seen:  # copies within a batch route once
                    seen.add(name)
                    parts.append(p := prefix(s, hot, level, percent))
                    names.append((name[0], len(s), len(p)))
                    held += len(p)
                    if held > 1 << 18:
                        yield rows(parts, names)
                        parts, names, held = [], [], 0
            if parts:
                yield rows(parts, names)

    return run


def _buckets(percent: int):
    """Rows sorted by (shingle, size, class) to (pivot, class).

    size is twice the set's, plus one if the shingle is not among those that the smaller of two similar sets must
    share. A shingle's holders are cut where no smaller holder before, with the shingle among those, is large enough;
    the first holder of each part is its pivot. Parts of one are dropped.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingle = pivot = None
        reach = 0  # the largest holder of this part so far that may be the smaller of two
        for batch in batches:
            m = batch.num_rows
            if not m:
                continue
            t, size, c = (batch.column(k).to_numpy() for k in range(3))
            n, leads = size >> 1, (size & 1) == 0
            new_t = np.ones(m, bool)
            new_t[1:] = t[1:] != t[:-1]
            new_t[0] = shingle is None or t[0] != shingle
            part = np.cumsum(new_t)
            # sizes ascend within a shingle, so the last holder that leads is the largest
            seen = np.where(leads, np.arange(1, m + 1), 0)
            last = np.concatenate([[0], np.maximum.accumulate(seen)[:-1]])
            before = np.where((last > 0) & (part[np.maximum(last - 1, 0)] == part), n[np.maximum(last - 1, 0)], 0)
            if not new_t[0]:
                carried = (part == part[0]) & (before == 0)
                before[carried] = reach
            cut = new_t | (100 * before < percent * n)
            starts = np.flatnonzero(cut)
            group = np.cumsum(cut)
            pivots = np.concatenate([[0 if pivot is None else pivot], c[starts]])[group]
            other = ~cut & (c != pivots)
            p, held = pivots[other], c[other]
            told = np.unique(p)
            pair = np.unique(np.stack([np.concatenate([p, told]), np.concatenate([held, told])], 1), axis=0)
            if len(pair):
                yield pa.RecordBatch.from_arrays([pa.array(pair[:, 0].copy()), pa.array(pair[:, 1].copy())], ["pivot", "class"])
            shingle, pivot = t[-1], pivots[-1]
            reach = int(n[-1]) if leads[-1] else int(before[-1])

    return run


def resolution(n: int) -> int:
    """Bits of the bitmap of a set of n: a power of two of 3 n or more, and of 1024."""
    return max(1 << 10, 1 << (3 * n - 1).bit_length())


def bitmap(s: np.ndarray, size: int) -> np.ndarray:
    flags = np.zeros(size, bool)
    flags[((s >> tx.U64(40)) % tx.U64(size)).astype(np.int64)] = True
    return np.packbits(flags, bitorder="little").view(np.uint64)


def folded(bits: np.ndarray, words: int) -> np.ndarray:
    """A bitmap of fewer words: token t has bit t modulo the size in either."""
    while len(bits) > words:
        bits = bits[: len(bits) // 2] | bits[len(bits) // 2 :]
    return bits


class SignatureTree:
    """Bitmaps (leaves x words) and sizes of sets as leaves, FAN_OUT children to a node; the top level is the last."""

    def __init__(self, bits: np.ndarray, sizes: np.ndarray):
        spare = sizes - np.bitwise_count(bits).sum(1).astype(np.int64)
        self.levels = [(bits, sizes, sizes, spare)]
        while len(self.levels[-1][0]) > FAN_OUT:
            bits, low, high, spare = self.levels[-1]
            at = np.arange(0, len(bits), FAN_OUT)
            self.levels.append((np.bitwise_or.reduceat(bits, at), np.minimum.reduceat(low, at), np.maximum.reduceat(high, at), np.maximum.reduceat(spare, at)))


def _possible(a: tuple, i: np.ndarray, b: tuple, j: np.ndarray, percent: int) -> np.ndarray:
    """Whether a leaf below node i of a and one below node j of b can be similar enough."""
    (bits_a, low_a, high_a, spare_a), (bits_b, low_b, high_b, spare_b) = a, b
    low_i, low_j, high_i, high_j = low_a[i], low_b[j], high_a[i], high_b[j]
    fine = (100 * high_j >= percent * low_i) & (100 * high_i >= percent * low_j)
    at = np.flatnonzero(fine)
    common = np.bitwise_count(bits_a[i[at]] & bits_b[j[at]]).sum(1).astype(np.int64)
    overlap = np.minimum(np.minimum(spare_a[i[at]], spare_b[j[at]]) + common, np.minimum(high_i[at], high_j[at]))
    fine[at] = (100 + percent) * overlap >= percent * (low_i[at] + low_j[at])
    return fine


def similar(a: np.ndarray, b: np.ndarray, percent: int) -> bool:
    if 100 * min(len(a), len(b)) < percent * max(len(a), len(b)):
        return False
    small, large = (a, b) if len(a) <= len(b) else (b, a)
    at = np.minimum(np.searchsorted(large, small), len(large) - 1)
    both = int((large[at] == small).sum())
    return 100 * both >= percent * (len(a) + len(b) - both)


def descend(one: SignatureTree, two: SignatureTree, percent: int, visit, done) -> None:
    """Dual traversal: visit(i, j) gets the leaf pairs that can be similar enough, each pair once if one is two.

    done(i, j, size_i, size_j) tells whether the leaves from i and j on, so many, need no visit any more.
    """
    own = one is two

    def down(level_a: int, level_b: int, i: np.ndarray, j: np.ndarray) -> None:
        if len(i):
            fine = _possible(one.levels[level_a], i, two.levels[level_b], j, percent)
            i, j = i[fine], j[fine]
        if level_a == 0 and level_b == 0:
            if len(i):
                visit(i, j)
            return
        step_a, step_b = FAN_OUT if level_a else 1, FAN_OUT if level_b else 1
        next_a, next_b = max(level_a - 1, 0), max(level_b - 1, 0)
        n, m = len(one.levels[next_a][0]), len(two.levels[next_b][0])
        if own:
            near = np.argsort(j - i, kind="stable")
            i, j = i[near], j[near]
        for x, y in zip(i.tolist(), j.tolist()):
            if done(x * FAN_OUT**level_a, y * FAN_OUT**level_b, FAN_OUT**level_a, FAN_OUT**level_b):
                continue
            ci = np.arange(x * step_a, min((x + 1) * step_a, n))
            cj = np.arange(y * step_b, min((y + 1) * step_b, m))
            p, q = (g.ravel() for g in np.meshgrid(ci, cj, indexing="ij"))
            if own:
                keep = p <= q if next_a else p < q
                p, q = p[keep], q[keep]
            down(next_a, next_b, p, q)

    p, q = (g.ravel() for g in np.meshgrid(np.arange(len(one.levels[-1][0])), np.arange(len(two.levels[-1][0])), indexing="ij"))
    if own:
        keep = p <= q if len(one.levels) > 1 else p < q
        p, q = p[keep], q[keep]
    down(len(one.levels) - 1, len(two.levels) - 1, p, q)


def by_signature(bits: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """An order of bitmaps in which alike ones are near, so that the nodes above them stay sparse: by their first bits
    in three fixed orders of the words, then by size."""
    words, firsts = bits.shape[1], []
    for k in range(3):
        turned = bits[:, (np.arange(words) * (2 * k + 1) + 5 * k) % words]
        at = (turned != 0).argmax(1)
        word = turned[np.arange(len(bits)), at]
        firsts.append(at * 64 + np.bitwise_count((word & (~word + tx.U64(1))) - tx.U64(1)))
    return np.lexsort((sizes, *firsts[::-1]))


def tree_join(bits: tuple, sizes: tuple, labels: tuple, percent: int, verify) -> list[tuple[int, int]]:
    """Links (leaf of the first side, leaf of the second) that join the labels of all linked leaves.

    bits, sizes, labels: of the leaves of each side, or of one side that is joined with itself. Labels that are equal
    from the start, or become so by a link, are not compared: the links span the components. verify(i, j) tells
    whether a pair that the bitmaps allow is a link.
    """
    own = len(bits) == 1
    orders = [by_signature(b, n) for b, n in zip(bits, sizes)]
    trees = [SignatureTree(b[o], n[o]) for b, n, o in zip(bits, sizes, orders)]
    one, two = trees[0], trees[-1]
    back, forth = orders[0], orders[-1]
    a = labels[0][back].copy()
    b = a if own else labels[-1][forth].copy()
    links: list[tuple[int, int]] = []

    def visit(i: np.ndarray, j: np.ndarray) -> None:
        apart = a[i] != b[j]
        for x, y in zip(i[apart].tolist(), j[apart].tolist()):
            if a[x] != b[y] and verify(back[x], forth[y]):
                links.append((int(back[x]), int(forth[y])))
                old, new = b[y], a[x]
                b[b == old] = new
                if not own:
                    a[a == old] = new

    def done(x: int, y: int, n: int, m: int) -> bool:
        return bool((a[x : x + n] == a[x]).all() and (b[y : y + m] == a[x]).all())

    descend(one, two, percent, visit, done)
    return links


def group_links(maps: list[np.ndarray], n: np.ndarray, labels: np.ndarray, sides: list[np.ndarray], percent: int, verify) -> list[tuple[int, int]]:
    """Links between leaves of sides[0] and sides[-1], which may be one; as tree_join, for bitmaps of several sizes.

    Sets that are similar enough have bitmaps of one size or of neighbouring ones, so each size is joined with itself
    and with the next, and no bitmap is folded more than once.
    """
    labels, links = labels.copy(), []
    words = np.array([len(x) for x in maps])
    own = len(sides) == 1
    for size in np.unique(words).tolist():
        for x, y in ((size, size), (size, 2 * size), (2 * size, size)):
            if x == y and own:
                leaves = (sides[0][words[sides[0]] == size],)
            elif own and x > y:
                continue
            else:
                leaves = (sides[0][words[sides[0]] == x], sides[-1][words[sides[-1]] == y])
            if not all(map(len, leaves)):
                continue
            bits = tuple(np.stack([folded(maps[k], size) for k in p.tolist()]) for p in leaves)
            first, last = leaves[0], leaves[-1]
            for i, j in tree_join(bits, tuple(n[p] for p in leaves), tuple(labels[p] for p in leaves), percent, lambda i, j: verify(first[i], last[j])):
                links.append((int(first[i]), int(last[j])))
                labels[labels == labels[last[j]]] = labels[first[i]]
    return links


def _joined(percent: int, exact: bool):
    """Groups (pivot, block, part) of rows (side, doc, label, n, payload) to links between docs.

    payload is a bitmap or, if exact, a set of shingles. Rows of side 0 are joined with one another, or with those of
    side 1 if there are some.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: list[tuple[int, int]] = []
        for group in sorted_groups(batches, ["pivot", "block", "part"]):
            docs, labels, n, side = (group[c].to_numpy() for c in ("doc", "label", "n", "side"))
            held = [np.frombuffer(x.as_buffer(), np.uint64) for x in group["payload"]]
            maps = [bitmap(s, resolution(len(s))) for s in held] if exact else held
            sides = [np.flatnonzero(side == k) for k in (0, 1)] if side.any() else [np.arange(len(docs))]
            check = (lambda i, j: similar(held[i], held[j], percent)) if exact else lambda i, j: True
            found += [(docs[i], docs[j]) for i, j in group_links(maps, n, labels, sides, percent, check)]
            if len(found) > 10000:
                yield _pairs(found)
                found = []
        if found:
            yield _pairs(found)

    return run


def _pairs(found: list[tuple[int, int]]) -> pa.RecordBatch:
    x = np.array(found, np.int64)
    return pa.RecordBatch.from_arrays([pa.array(x[:, 0].copy()), pa.array(x[:, 1].copy())], ["a", "b"])


def _shingles(width: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows, sets = [], []
            for k, s in shingle_sets(*_texts(batch, 1), width):
                rows.append(k)
                sets.append(s.tobytes())
            at = pa.array(rows, pa.int64())
            yield pa.RecordBatch.from_arrays([batch.column(0).take(at), pa.array(sets, pa.binary())], ["doc", "payload"])

    return run


def spread_join(rows: DataFrame, payloads: DataFrame, block: int, bytes_each: float, percent: int, exact: bool) -> DataFrame:
    """(node, component) of every doc with a link, of rows (pivot, doc, n) with payloads (doc, payload).

    Rows of a pivot are compared with one another. bytes_each: of payload for one element of a set.
    """
    n = shuffle_partitions(rows.sparkSession)
    weight = cut(rows.groupBy("pivot").agg(F.count("*").alias("many"), F.sum("n").alias("total"), F.min("doc").alias("lead")).where("many > 1"))  # kept, so that a hot pivot of rows can be split in the join
    blocks = F.greatest(F.ceil(F.col("many") / block), F.ceil(F.col("total") * bytes_each / BLOCK_BYTES)).cast("int")
    placed = cut(rows.join(weight.select("pivot", "lead", blocks.alias("blocks")), "pivot"))
    own = F.pmod(F.xxhash64("doc"), F.col("blocks")).cast("int")
    columns = ["pivot", "block", "part", "side", "doc", "label", "n"]

    def dealt(x: DataFrame) -> DataFrame:
        sent = x.select(*columns).join(payloads, "doc").repartition(n, "pivot", "block", "part")
        return sent.sortWithinPartitions("pivot", "block", "part").transform(in_arrow, _joined(percent, exact), "a long, b long")

    no = F.lit(0)
    homed = placed.where("doc <> lead or blocks = 1").select("pivot", own.alias("block"), no.alias("part"), no.alias("side"), "doc", F.col("doc").alias("label"), "n")
    leads = placed.where("doc = lead and blocks > 1").select("pivot", F.explode(F.sequence(no, F.col("blocks") - 1)).alias("block"), no.alias("part"), no.alias("side"), "doc", F.col("doc").alias("label"), "n")
    links = cut(dealt(homed.unionByName(leads)))
    found = components(links)
    wide = placed.where("blocks > 1")
    if wide.isEmpty():
        return found

    labelled = wide.join(found.withColumnRenamed("node", "doc"), "doc", "left").withColumn("label", F.coalesce("component", "doc"))
    labels = labelled.groupBy("pivot", "label").agg(F.count("*").alias("many"), F.sum("n").alias("total"))
    home = labels.groupBy("pivot").agg(F.max_by("label", F.struct("many", "label")).alias("home"), (F.sum("many") - F.max("many")).alias("asks"), (F.sum("total") - F.max("total")).alias("load")).where("asks > 0")
    parts = F.greatest(F.lit(1), F.ceil(F.col("asks") / block), F.ceil(F.col("load") * bytes_each / BLOCK_BYTES)).cast("int")
    due = cut(labelled.join(home.select("pivot", "home", parts.alias("parts")), "pivot").select("pivot", "doc", "n", "blocks", "parts", "label", (F.col("label") != F.col("home")).alias("asks")))
    asks = due.where("asks").select("pivot", F.explode(F.sequence(no, F.col("blocks") - 1)).alias("block"), F.pmod(F.xxhash64("doc", F.lit(1)), F.col("parts")).cast("int").alias("part"), no.alias("side"), "doc", "label", "n")
    rest = due.select("pivot", own.alias("block"), F.explode(F.sequence(no, F.col("parts") - 1)).alias("part"), F.lit(1).alias("side"), "doc", "label", "n")
    return components(links.unionByName(cut(dealt(asks.unionByName(rest)))))


def link_components(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = 5, percent: int = 75, block: int = BLOCK) -> DataFrame:
    """(id_col, n_shingles, component_id) of every row of docs."""
    spark = docs.sparkSession
    base = docs.select(F.col(id_col).cast("long").alias("doc"), F.col(text_col).alias("text"))
    first = cut(base.transform(in_arrow, _sizes(width), "kind int, doc long, n long, h1 long, h2 long, bits binary"))
    sizes = first.where("kind = 0").select("doc", "n", "h1", "h2")

    top = first.where("kind = 1").groupBy("h1").agg(F.sum("n").alias("n")).orderBy(F.desc("n"), "h1").limit(HOT_KEPT).collect()
    hot = np.array([r["h1"] for r in top], np.int64).view(np.uint64)
    level = np.floor(np.log2(np.array([r["n"] for r in top] or [1]))).astype(np.int64)[: len(hot)]
    order = np.argsort(hot)
    hot, level = hot[order], level[order]

    classes = cut(sizes.where("n > 0").groupBy("h1", "h2", "n").agg(F.min("doc").alias("doc")))
    routes = base.select("text").transform(in_arrow, _routes(width, percent, hot, level), "shingle long, size long, class long")
    routed = routes.repartition(shuffle_partitions(spark), "shingle").sortWithinPartitions("shingle", "size", "class")
    buckets = routed.transform(in_arrow, _buckets(percent), "pivot long, class long").distinct()
    members = cut(buckets.join(classes.select(F.col("h1").alias("class"), "doc", "n"), "class").select("pivot", "doc", "n"))

    bits = first.where("kind = 0").select("doc", F.col("bits").alias("payload")).join(members.select("doc").distinct(), "doc", "left_semi")
    families = spread_join(members, bits, block, 0.5, percent, False)

    held = cut(families.join(classes.select("doc", "n"), families["node"] == classes["doc"]).select(F.col("component").alias("pivot"), "doc", "n"))
    active = held.select("doc")
    sets = cut(among(base, active, "doc").join(active, "doc", "left_semi").transform(in_arrow, _shingles(width), "doc long, payload binary"))
    found = spread_join(held, sets, block, 8, percent, True)

    named = classes.join(found.withColumnRenamed("node", "doc"), "doc", "left").select("h1", "h2", "n", F.coalesce("component", "doc").alias("component"))
    out = sizes.join(named, ["h1", "h2", "n"], "left")
    return out.select(F.col("doc").alias(id_col), F.col("n").alias("n_shingles"), F.coalesce("component", "doc").alias("component_id"))
