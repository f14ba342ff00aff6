"""Suffix-array dedup with a logarithmic index family: removes bytes that a long enough earlier string covers.

A match of ``length`` bytes or more is a shared window of ``length`` bytes, so suffixes are compared up to ``length``
bytes, and those that have fewer left are in no array.

1. Equal texts form a class; the first stands for it. A later copy of ``length`` bytes or more goes as a whole.
2. Each window is filed under its anchor: the ``gram`` bytes in it with the least hash, leftmost on a tie. Equal
   windows have equal anchors. Anchors that occur once in all texts cannot belong to a match; their windows stop here.
   An anchor is a hash, but nothing is removed by it: two that collide only bring more windows to one place.
3. Runs of adjacent windows with one anchor stay together, with their bytes, and go to the partition of the anchor.
   There they arrive in the order of (doc, start), in batches. A batch's windows are sorted to a suffix array, in the
   order of their bytes, and merge-scanned against the arrays of the index: neighbours whose common prefix reaches
   ``length`` are a match, and the later one is a copy. The new suffixes become a level, and levels of similar size
   merge, so an index of n suffixes has about log(n) levels.
4. What is found becomes byte runs by document.

Anchors travel packed by partition, as planes of bytes. Partitions are as many as hold about 32 MB of text each.
Hot anchors, of more than about HOT runs: their runs are cut in four by where in the window the anchor lies, and filed
under all bytes that the windows of such a quarter share, at least ``length - 17`` of 100. Equal windows have their
anchor at one place, so they stay together, and what is hot changes no result.
Hot passages: runs of equal bytes within a few MB of input are settled before the shuffle, so one passage sends one row
for these, not one a document; a partition indexes equal runs once.

Rows: a null text is an empty one; nothing is removed from texts shorter than ``length`` bytes. Repeated rows are
copies. Ids are distinct integers, which set who is earlier. Extra columns are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, functions as F

from umbra.llm import text as tx
from umbra.llm.shared import among, cut, in_arrow, shuffle_partitions, sorted_groups

GRAM = 32
PART_BYTES = 32 << 20  # of text for each partition of the index
HELD = 4 << 20  # bytes of runs in which equal ones are settled before the shuffle
HOT = PART_BYTES >> 9  # runs of one anchor beyond which they are divided
SLICE = 1 << 15  # suffixes whose first bytes are laid out at once
PLACE = np.uint64(32)  # low bits of a sort key that hold a place in the text


class Anchors:
    """Runs of adjacent windows with one anchor: text, first window, windows, place and hash of the anchor."""

    def __init__(self, raw: np.ndarray, starts: np.ndarray, ends: np.ndarray, length: int, gram: int):
        low = int(starts[0])
        self.data = raw[low : max(int(ends[-1]), low)]
        self.start, self.end = starts - low, ends - low
        n, span = len(self.data), length - gram + 1
        power = tx.powers("up", n + 1)
        self.sum = np.zeros(n + 1, tx.U64)
        np.cumsum(tx.BYTE[self.data] * power[:n], out=self.sum[1:])
        windows = n - length + 1
        self.text = self.first = self.many = self.at = np.zeros(0, np.int64)
        self.hash = np.zeros(0, tx.U64)
        if windows <= 0:
            return
        grams = self.fingerprints(np.arange(n - gram + 1), gram)
        key = (grams >> PLACE << PLACE) | np.arange(len(grams), dtype=tx.U64)
        least, have = key, 1
        while have < span:
            step = min(have, span - have)
            least = np.minimum(least[: len(least) - step], least[step:])
            have += step
        at = (least & tx.U64((1 << 32) - 1)).astype(np.int64)[:windows]
        inside = np.zeros(windows + 1, np.int8)
        full = self.end - self.start >= length
        inside[self.start[full]] += 1
        stop = self.end[full] - length + 1
        np.add.at(inside, np.minimum(stop, windows), -1)
        inside = np.cumsum(inside[:windows]).astype(bool)
        new = np.ones(windows, bool)
        new[1:] = at[1:] != at[:-1]
        new[self.start[full]] = True
        edge = np.flatnonzero(new & inside)
        breaks = np.append(np.flatnonzero(new | ~inside), windows)
        self.first = edge
        self.many = breaks[np.searchsorted(breaks, edge, side="right")] - edge
        self.at = at[edge]
        self.hash = grams[self.at]
        self.text = np.searchsorted(self.start, edge, side="right") - 1

    def fingerprints(self, start: np.ndarray, size: int | np.ndarray) -> np.ndarray:
        return tx.mix((self.sum[start + size] - self.sum[start]) * tx.powers("down", len(self.data) + 1)[start])

    def divided(self, rows: np.ndarray, length: int, gram: int, parts: int = 4) -> Iterator[tuple]:
        """The runs ``rows`` cut by the anchor's place in the window: (run, first window, windows, key) of each part."""
        last = length - gram
        step = last // parts + 1
        for low in range(0, last + 1, step):
            high = min(low + step - 1, last)
            a = np.maximum(self.first[rows], self.at[rows] - high)
            b = np.minimum(self.first[rows] + self.many[rows] - 1, self.at[rows] - low)
            r, a, b = (c[b >= a] for c in (rows, a, b))
            shared = self.fingerprints(self.at[r] - low, length - (high - low))
            yield r, a, b - a + 1, tx.as_long(tx.mix(self.hash[r] ^ tx.mix(shared + tx.U64(low))))


def _texts(batch: pa.RecordBatch, k: int):
    column = batch.column(k)
    return tx.string_bytes(column.fill_null("") if column.null_count else column)


def _pieces(batch: pa.RecordBatch, k: int, length: int, gram: int) -> Iterator[tuple[int, Anchors]]:
    raw, starts, ends = _texts(batch, k)
    for i, j in tx.chunks(starts, ends):
        if j - i > 1 or ends[i] - starts[i] >= length:
            yield i, Anchors(raw, starts[i:j], ends[i:j], length, gram)


def _facts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(doc, text) to (doc, n_bytes, sha, name); name is the first 56 bits of the digest."""
    for batch in batches:
        raw, starts, ends = _texts(batch, 1)
        digest = [hashlib.sha256(raw[a:b]).hexdigest() for a, b in zip(starts.tolist(), ends.tolist())]
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(ends - starts), pa.array(digest, pa.string()), pa.array([int(x[:14], 16) for x in digest], pa.int64())], ["doc", "n_bytes", "sha", "name"])


def planes(columns: list[tuple[np.ndarray, int]]) -> bytes:
    """The low bytes of columns of 64-bit numbers, so many of each, byte by byte, so that alike ones are neighbours."""
    return b"".join(np.ascontiguousarray(c.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :k].T).tobytes() for c, k in columns)


def unplaned(data: np.ndarray, widths: list[int]) -> list[np.ndarray]:
    m, at, out = len(data) // sum(widths), 0, []
    for k in widths:
        wide = np.zeros((m, 8), np.uint8)
        wide[:, :k] = data[at : at + k * m].reshape(k, m).T
        out.append(wide.view("<u8").reshape(-1).astype(np.int64))
        at += k * m
    return out


ANCHOR, NAME = 6, 7  # bytes of an anchor within its part, and of a text's name


def _anchors(length: int, gram: int, bits: int):
    """Texts to rows (part, pairs, known): anchors of a part and the texts that hold them, packed.

    An anchor's first ``bits`` bits are its part. pairs: one text of each anchor, and the bits of the number of its runs
    in this batch, or 0 if it has one; known: all texts of those that repeat.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            hashes, texts, seen = [], [], set()
            raw, starts, ends = _texts(batch, 0)
            names = np.array([int.from_bytes(hashlib.sha256(raw[a:b]).digest()[:7], "big") for a, b in zip(starts.tolist(), ends.tolist())], np.int64)
            for i, x in _pieces(batch, 0, length, gram):
                once = np.zeros(len(x.start), bool)
                for k, v in enumerate(names[i : i + len(x.start)].tolist()):  # copies within a batch count once
                    if v not in seen:
                        seen.add(v)
                        once[k] = True
                use = once[x.text]
                hashes.append(x.hash[use] >> tx.U64(16 - bits))
                texts.append(names[i + x.text[use]])
            if not hashes:
                continue
            h, t = tx.as_long(np.concatenate(hashes)), np.concatenate(texts)
            order = np.lexsort((t, h))
            h, t = h[order], t[order]
            m = len(h)
            if not m:
                continue
            new_h, new_ht = np.ones(m, bool), np.ones(m, bool)
            new_h[1:] = h[1:] != h[:-1]
            new_ht[1:] = new_h[1:] | (t[1:] != t[:-1])
            begin = np.flatnonzero(new_h)
            many = np.diff(np.append(begin, m))
            sized = np.where(many > 1, np.frexp(many)[1], 0).astype(np.int64)
            told = np.flatnonzero(np.repeat(many > 1, many) & new_ht)
            part = h >> 48
            edge = np.flatnonzero(np.append(True, part[1:] != part[:-1]))
            one, two = np.searchsorted(begin, np.append(edge, m)), np.searchsorted(told, np.append(edge, m))
            pairs = [planes([(h[begin[a:b]], ANCHOR), (t[begin[a:b]], NAME), (sized[a:b], 1)]) for a, b in zip(one[:-1], one[1:])]
            known = [planes([(h[told[a:b]], ANCHOR), (t[told[a:b]], NAME)]) for a, b in zip(two[:-1], two[1:])]
            yield pa.RecordBatch.from_arrays([pa.array(part[edge].astype(np.int32)), pa.array(pairs, pa.binary()), pa.array(known, pa.binary())], ["part", "pairs", "known"])

    return run


def _repeated(hot: int):
    """Rows sorted by part to (text, anchor) of the anchors with two texts, or a repeating one; known rows pass. Anchors
    of about ``hot`` runs and more are given as their complements."""

    def joined(column: pa.ChunkedArray, widths: list[int]) -> list[np.ndarray]:
        parts = [unplaned(np.frombuffer(x.as_buffer(), np.uint8), widths) for x in column]
        return [np.concatenate(c) for c in zip(*parts)]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for group in sorted_groups(batches, ["part"]):
            high = np.int64(group["part"][0].as_py()) << 48
            a, t, size = joined(group["pairs"], [ANCHOR, NAME, 1])
            known_a, known_t = joined(group["known"], [ANCHOR, NAME])
            order = np.argsort(a, kind="stable")
            a, t, size = a[order], t[order], size[order]
            begin = np.flatnonzero(np.append(True, a[1:] != a[:-1])) if len(a) else np.zeros(0, np.int64)
            hots = np.zeros(0, np.int64)
            if len(begin):
                repeats = (np.maximum.reduceat(size, begin) > 0) | (np.minimum.reduceat(t, begin) != np.maximum.reduceat(t, begin))
                hots = a[begin[np.add.reduceat(np.int64(1) << np.maximum(size - 1, 0), begin) >= hot]]
                use = np.repeat(repeats, np.diff(np.append(begin, len(a))))
                a, t = a[use], t[use]
            anchor = np.concatenate([a, known_a])
            told = np.where(np.isin(anchor, hots), ~(anchor | high), anchor | high)
            yield pa.RecordBatch.from_arrays([pa.array(np.concatenate([t, known_t])), pa.array(told)], ["text", "anchor"])

    return run


def _index_rows(length: int, gram: int, bits: int):
    """Rows (doc, text, anchors, ...) to runs with a repeating anchor. A run that stands earlier in what is held has been
    found: it goes without bytes, under a key of its own, to any partition."""

    def settled(held: list[tuple]) -> pa.RecordBatch:
        h, d, f, m, size = (np.concatenate(c) for c in zip(*[x[:5] for x in held]))
        data = np.concatenate([x[5] for x in held])
        edges = np.concatenate([[0], np.cumsum(size)]).astype(np.int64)
        whole, content, seen = data.tobytes(), [None] * len(h), set()
        later = np.zeros(len(h), bool)
        for k in np.lexsort((f, d)).tolist():
            run = whole[edges[k] : edges[k + 1]]
            if run in seen:
                later[k] = True
            else:
                seen.add(run)
                content[k] = run
        key = np.where(later, tx.as_long(tx.mix(d.astype(tx.U64) ^ tx.mix(f.astype(tx.U64)))), h)
        return pa.RecordBatch.from_arrays([pa.array(key), pa.array(d), pa.array(f), pa.array(m), pa.array(content, pa.binary())], ["key", "doc", "first", "many", "bytes"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size_held = [], 0
        for batch in batches:
            if not batch.num_rows:
                continue
            docs = batch.column(0).to_numpy()
            lists = batch.column(batch.schema.get_field_index("anchors"))
            values, at = lists.flatten().to_numpy(), np.concatenate([[0], np.cumsum(lists.value_lengths().fill_null(0).to_numpy())])
            for i, x in _pieces(batch, 1, length, gram):
                if not len(x.first):
                    continue
                use, hot = np.zeros(len(x.first), bool), np.zeros(len(x.first), bool)
                hashed = tx.as_long(x.hash >> tx.U64(16 - bits))
                edges = np.searchsorted(x.text, np.arange(len(x.start) + 1))
                for k in range(len(x.start)):
                    a, b = edges[k], edges[k + 1]
                    if b > a and at[i + k + 1] > at[i + k]:
                        wanted = values[at[i + k] : at[i + k + 1]]
                        use[a:b] = np.isin(hashed[a:b], wanted)
                        if (wanted < 0).any():
                            hot[a:b] = np.isin(~hashed[a:b], wanted)
                if not (use.any() or hot.any()):
                    continue
                r = np.flatnonzero(use)
                runs = [(r, x.first[r], x.many[r], hashed[r])]
                if hot.any():
                    runs.extend(x.divided(np.flatnonzero(hot), length, gram))
                r, f, m, key = (np.concatenate(c) for c in zip(*runs))
                size = m + length - 1
                stop = np.cumsum(size)
                take = np.arange(int(stop[-1])) - np.repeat(stop - size - f, size)
                held.append((key, docs[i + x.text[r]], f - x.start[x.text[r]], m, size, x.data[take]))
                size_held += int(stop[-1])
                if size_held >= HELD:
                    yield settled(held)
                    held, size_held = [], 0
        if held:
            yield settled(held)

    return run


class SuffixArray:
    """Suffixes of a text that differ in their first ``length`` bytes, in the order of these."""

    def __init__(self, text: np.ndarray, at: np.ndarray, length: int):
        self.text, self.at, self.length = text, at, length

    def __len__(self) -> int:
        return len(self.at)

    def heads(self, low: int = 0, high: int | None = None) -> np.ndarray:
        return heads(self.text, self.at[low:high], self.length)

    def places(self, ordered: "SuffixArray") -> tuple[np.ndarray, np.ndarray]:
        """Merge-scan: how many suffixes here precede each of the ordered ones, and whether the next is equal as far as
        length. Both arrays are gone through once, a slice at a time."""
        place, equal = np.zeros(len(ordered), np.int64), np.zeros(len(ordered), bool)
        for low in range(0, len(ordered), SLICE):
            asked = ordered.heads(low, low + SLICE)
            a, b = (self._first_not_below(x) for x in (asked[0], asked[-1]))
            b = min(b + 1, len(self))
            for c in range(a, max(b, a + 1), SLICE):
                here = self.heads(c, min(c + SLICE, b))
                if not len(here):
                    place[low : low + len(asked)] = len(self)
                    break
                last = c + SLICE >= b
                some = slice(0 if c == a else int(np.searchsorted(asked, before, side="right")), len(asked) if last else int(np.searchsorted(asked, here[-1], side="right")))
                at = np.searchsorted(here, asked[some])
                place[low + some.start : low + some.stop] = c + at
                inside = np.minimum(at, len(here) - 1)
                equal[low + some.start : low + some.stop] = (at < len(here)) & (here[inside] == asked[some])
                before = here[-1]
        return place, equal

    def _first_not_below(self, head: np.bytes_) -> int:
        low, high = 0, len(self)
        while low < high:
            middle = (low + high) // 2
            if self.heads(middle, middle + 1)[0] < head:
                low = middle + 1
            else:
                high = middle
        return low

    def merged(self, other: "SuffixArray") -> "SuffixArray":
        """Both arrays, which have no suffix in common, by one merge."""
        place, _ = self.places(other)
        at = np.empty(len(self) + len(other), np.int64)
        theirs = place + np.arange(len(other))
        mine = np.ones(len(at), bool)
        mine[theirs] = False
        at[theirs] = other.at + len(self.text)
        at[mine] = self.at
        return SuffixArray(np.concatenate([self.text, other.text]), at, self.length)


def heads(text: np.ndarray, at: np.ndarray, length: int) -> np.ndarray:
    """The first length bytes of the suffixes from at on; all have so many, so they compare as bytes do."""
    if not len(at):
        return np.zeros(0, f"S{length}")
    return np.ascontiguousarray(np.lib.stride_tricks.sliding_window_view(text, length)[at]).view(f"S{length}").reshape(-1)


class IndexFamily:
    """Suffix arrays whose sizes grow geometrically."""

    def __init__(self, length: int) -> None:
        self.levels: list[SuffixArray] = []
        self.length = length

    def add(self, text: np.ndarray, at: np.ndarray) -> np.ndarray:
        """Which suffixes of the text, from at on and in order, are in the index or stand earlier in at; the rest joins it."""
        found = np.zeros(len(at), bool)
        if not len(at):
            return found
        keys = heads(text, at, self.length)
        order = np.argsort(keys, kind="stable")
        ordered = keys[order]
        copy = np.zeros(len(at), bool)
        copy[1:] = ordered[1:] == ordered[:-1]
        del keys, ordered
        found[order] = copy
        order = order[~copy]
        for level in self.levels:
            if len(order):
                equal = level.places(SuffixArray(text, at[order], self.length))[1]
                found[order[equal]] = True
                order = order[~equal]
        if len(order):
            self.levels.append(SuffixArray(text, at[order], self.length))
            while len(self.levels) > 1 and len(self.levels[-2]) < 2 * len(self.levels[-1]):
                last = self.levels.pop()
                self.levels.append(self.levels.pop().merged(last))
        return found


def _scan(length: int):
    """Runs of one anchor partition in the order of (doc, first) to the runs of windows that are later copies."""
    names = ["doc", "first", "many"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index, known = IndexFamily(length), set()
        for batch in batches:
            data = batch.column(3)
            fresh = np.zeros(batch.num_rows, bool)
            raw, starts, ends = tx.string_bytes(data)
            for k in np.flatnonzero(ends > starts).tolist():
                name = hashlib.blake2b(raw[starts[k] : ends[k]], digest_size=16).digest()
                if name not in known:  # a run whose equal has been indexed is a copy as a whole
                    known.add(name)
                    fresh[k] = True
            done = batch.filter(pa.array(~fresh)).select([0, 1, 2])
            if done.num_rows:
                yield done.rename_columns(names)
            if not fresh.any():
                continue
            batch = batch.filter(pa.array(fresh))
            docs, first = batch.column(0).to_numpy(), batch.column(1).to_numpy()
            raw, starts, ends = tx.string_bytes(batch.column(3))
            for i, j in tx.chunks(starts, ends, 1 << 19):
                low, high = int(starts[i]), int(ends[j - 1])
                many = ends[i:j] - starts[i:j] - length + 1
                stop = np.cumsum(many)
                row = np.repeat(np.arange(j - i), many)
                place = np.arange(int(stop[-1])) - (stop - many)[row]
                found = index.add(raw[low:high].copy(), place + (starts[i:j] - low)[row])
                if not found.any():
                    continue
                begin = found & np.append(True, ~found[:-1] | (row[1:] != row[:-1]))
                end = found & np.append(~found[1:] | (row[1:] != row[:-1]), True)
                b, e = np.flatnonzero(begin), np.flatnonzero(end)
                r = i + row[b]
                yield pa.RecordBatch.from_arrays([pa.array(docs[r]), pa.array(first[r] + place[b]), pa.array(e - b + 1)], names)

    return run


def merged_runs(first: np.ndarray, many: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray]:
    """Maximal runs of bytes (starts, ends) that the windows first .. first + many - 1 cover."""
    order = np.argsort(first, kind="stable")
    a, b = first[order], (first + many + length - 1)[order]
    reach = np.maximum.accumulate(b)
    new = np.append(True, a[1:] > reach[:-1])
    at = np.flatnonzero(new)
    return a[at], reach[np.append(at[1:] - 1, len(a) - 1)]


def _left(text: np.ndarray, spans: pa.StructArray, length: int) -> tuple[int, int, bytes]:
    """(bytes removed, runs, bytes that remain) of a text."""
    a, b = merged_runs(spans.field("first").to_numpy(), spans.field("many").to_numpy(), length)
    gone = np.zeros(len(text) + 1, np.int64)
    np.add.at(gone, a, 1)
    np.add.at(gone, b, -1)
    return int((b - a).sum()), len(a), text[np.cumsum(gone)[:-1] == 0].tobytes()


def _removed(length: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            raw, starts, ends = _texts(batch, 1)
            out = []
            for k in range(batch.num_rows):
                n, s, left = _left(raw[starts[k] : ends[k]], batch.column(2)[k].values, length)
                out.append((n, s, hashlib.sha256(left).hexdigest()))
            n, s, sha = zip(*out) if out else ((), (), ())
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(n, pa.int64()), pa.array(s, pa.int64()), pa.array(sha, pa.string())], ["doc", "n_removed", "n_spans", "kept_sha256"])

    return run


def _stripped(length: int):
    """Rows (doc, text, rest, spans) to (text, changed, rest) without the bytes that spans cover."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in (b.slice(k, 500) for b in batches for k in range(0, b.num_rows, 500)):
            raw, starts, ends = _texts(batch, 1)
            text, lists = batch.column(1), batch.column(3)
            hit = np.flatnonzero(lists.is_valid().to_numpy(zero_copy_only=False))
            out = text.to_pylist() if len(hit) else text
            for k in hit.tolist():
                out[k] = _left(raw[starts[k] : ends[k]], lists[k].values, length)[2].decode("utf-8", "ignore")
            yield pa.RecordBatch.from_arrays([pa.array(out, text.type) if len(hit) else text, lists.is_valid(), batch.column(2)], ["text", "changed", "rest"])

    return run


def _facts_of(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    return cut(docs.select(F.col(id_col).cast("long").alias("doc"), F.col(text_col).alias("text")).transform(in_arrow, _facts, "doc long, n_bytes long, sha string, name long"))


def _firsts(facts: DataFrame, length: int) -> DataFrame:
    """(sha, name, doc, many) of each class of equal texts; kept, so that a hot class can be split in joins with it."""
    return cut(facts.where(F.col("n_bytes") >= length).groupBy("sha", "name").agg(F.min("doc").alias("doc"), F.count("*").alias("many")))


def _spans(texts: DataFrame, facts: DataFrame, firsts: DataFrame, length: int, gram: int, few: bool, hot: int) -> DataFrame:
    """(doc, spans) of the first of each class of equal texts (doc, text, ...), where something is to be removed.

    few: texts without a repeated anchor are kept out of the join; else all of texts is dealt by doc, as is needed if
    the caller joins it by doc too.
    """
    if not 8 <= gram <= length:
        raise ValueError("gram must lie between 8 and length")
    spark = texts.sparkSession
    size = facts.agg(F.sum("n_bytes")).first()[0] or 0
    n = max(shuffle_partitions(spark), -(-size // PART_BYTES))
    bits = min(15, (16 * n - 1).bit_length())
    anchors = texts.select("text").transform(in_arrow, _anchors(length, gram, bits), "part int, pairs binary, known binary")
    counted = anchors.repartition(n, "part").sortWithinPartitions("part").transform(in_arrow, _repeated(hot), "text long, anchor long")
    wanted = counted.groupBy("text").agg(F.collect_set("anchor").alias("anchors")).withColumnRenamed("text", "name")
    wanted = firsts.select("name", "doc").join(wanted, "name").select("doc", "anchors")
    if few:
        wanted = cut(wanted)
        chosen = among(texts, wanted.select("doc"), "doc").join(wanted, "doc")
    else:
        chosen = texts.join(wanted, "doc", "left")
    rows = chosen.transform(in_arrow, _index_rows(length, gram, bits), "key long, doc long, first long, many long, bytes binary")
    index = rows.repartition(n, "key").select("doc", "first", "many", "bytes").sortWithinPartitions("doc", "first")
    spans = index.transform(in_arrow, _scan(length), "doc long, first long, many long")
    return spans.groupBy("doc").agg(F.collect_list(F.struct("first", "many")).alias("spans"))


def repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", length: int = 100, gram: int = GRAM, hot: int = HOT) -> DataFrame:
    """(id_col, n_bytes, n_removed, n_spans, kept_sha256) of every row."""
    facts = _facts_of(docs, id_col, text_col)
    base = docs.select(F.col(id_col).cast("long").alias("doc"), F.col(text_col).alias("text"))
    firsts = _firsts(facts, length)
    spans = cut(_spans(base, facts, firsts, length, gram, True, hot))
    touched = among(base, spans.select("doc"), "doc").join(spans, "doc").select("doc", "text", "spans").transform(in_arrow, _removed(length), "doc long, n_removed long, n_spans long, kept_sha256 string")

    first = facts.join(firsts.where("many > 1").select("sha", F.col("doc").alias("first_doc")), "sha", "left")
    empty = hashlib.sha256(b"").hexdigest()
    copy = F.col("first_doc").isNotNull() & (F.col("first_doc") != F.col("doc"))
    return first.join(touched, "doc", "left").select(
        F.col("doc").alias(id_col),
        "n_bytes",
        F.when(copy, F.col("n_bytes")).otherwise(F.coalesce("n_removed", F.lit(0))).cast("long").alias("n_removed"),
        F.when(copy, F.lit(1)).otherwise(F.coalesce("n_spans", F.lit(0))).cast("long").alias("n_spans"),
        F.when(copy, F.lit(empty)).otherwise(F.coalesce("kept_sha256", "sha")).alias("kept_sha256"),
    )


def strip(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", length_col: str = "n_chars", length: int = 100, gram: int = GRAM, hot: int = HOT) -> DataFrame:
    """docs, all columns, without the repeated bytes; rows of which nothing is left go.

    Halves of characters at a cut go too, and length_col, where there is one, is the length of what is left. A copy of
    an earlier text of length bytes or more goes, as does a text that earlier strings cover. Rows without an id go,
    as nothing can be said of what is earlier.
    """
    rest = [c for c in docs.columns if c != text_col]
    facts = _facts_of(docs, id_col, text_col)
    texts = docs.where(F.col(id_col).isNotNull()).select(F.col(id_col).cast("long").alias("doc"), F.col(text_col).alias("text"), F.struct(*rest).alias("rest"))
    firsts = _firsts(facts, length)
    copies = facts.join(firsts.where("many > 1").select("sha", F.col("doc").alias("first")), "sha").where("doc <> first").select("doc")
    spans = _spans(texts, facts, firsts, length, gram, False, hot)
    joined = texts.join(spans, "doc", "left").join(copies, "doc", "left_anti").select("doc", "text", "rest", "spans")
    kind = docs.select(F.col(text_col).alias("text"), F.struct(*rest).alias("rest")).schema
    left = joined.transform(in_arrow, _stripped(length), f"text string, changed boolean, rest {kind['rest'].dataType.simpleString()}").where("not changed or text <> ''")
    out = left.select(*[F.col("text").alias(c) if c == text_col else F.col(f"rest.`{c}`").alias(c) for c in docs.columns])
    if length_col in docs.columns:
        kept = F.when(F.col("changed"), F.length("text")).otherwise(F.col(f"rest.`{length_col}`")).cast(docs.schema[length_col].dataType)
        out = left.select(*[F.col("text").alias(c) if c == text_col else kept.alias(c) if c == length_col else F.col(f"rest.`{c}`").alias(c) for c in docs.columns])
    return out
