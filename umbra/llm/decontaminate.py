"""Benchmark decontamination by template canonicalisation.

Words lose the punctuation around them and their case; numbers, names and units become typed placeholders. Windows of
``width`` canonical words of each benchmark item are hash-joined with those of the documents, so an item is found
with other numbers and names in it too. A document that holds ``least_cover`` of an item's windows is a candidate;
its slots are then checked: each value of the item must stand for one value of the document, another one for another
value, in ``least_agree`` of the slots. An item with fewer than ``width`` words is one window of its own length; one
with fewer than ``least_words`` says too little within a text, and is found as the whole of one.

A number is a word with a digit. A unit is a word of UNITS after a number. A name is a capitalised word that does not
begin a text, a line or a sentence; the first word of a window is also read as literal, whatever stands before it, so
an item's first window is found in running text. The template of a window with fewer than half literal words says too little, so
such a window is found by its literal words only; every window is found by these too. ``least_cover`` is met either
among the windows with a template or among all, and the figures reported are those of the first that is.

The hash join's build side is the benchmark, taken in blocks of at most ``block_chars`` characters, so what is
broadcast has a bound; all documents are held against each block.

Rows: null and empty texts and items without a word match nothing. Repeated items and
documents are each reported. An empty table gives no rows. Extra columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F, types as T
from pyspark.sql.pandas.types import to_arrow_type

from umbra.llm import text as tx
from umbra.llm.shared import in_arrow

NUMBER, NAME, UNIT, LITERAL = (tx.mix(np.array([k], np.uint64))[0] for k in (101, 102, 103, 104))
#: Words that are units after a number.
UNITS = "kg g mg lb lbs oz km m cm mm mi ft in yd s sec secs second seconds ms min mins minute minutes h hr hrs hour hours day days week weeks month months year years dollar dollars euro euros usd eur cent cents percent meter meters metre metres kilometer kilometers kilometre kilometres mile miles foot feet inch inches pound pounds gram grams kilogram kilograms liter liters litre litres l ml mph kph kmh c f degrees".split()
LETTER = np.ones(256, bool)
LETTER[:128] = [chr(c).isalnum() for c in range(128)]
DIGIT = np.zeros(256, bool)
DIGIT[48:58] = True
STOP = np.zeros(256, bool)
STOP[[ord(c) for c in ".!?:;"]] = True


class Templates:
    """Canonical words of texts: code (literal hash or placeholder), value (literal hash), slot, count, first."""

    def __init__(self, raw: np.ndarray, starts: np.ndarray, ends: np.ndarray):
        w = tx.Words(raw, starts, ends)
        n = len(w.data)
        letters = np.flatnonzero(LETTER[w.data])
        a = np.searchsorted(letters, w.start)
        b = np.searchsorted(letters, w.end)
        full = b > a
        word_of = np.flatnonzero(full)
        begin = letters[a[full]]
        end = letters[b[full] - 1] + 1
        low = tx.LOWER[w.data]
        upper2 = np.zeros(n, bool)
        if n > 1:
            upper2[1:] = (w.data[:-1] == 0xC3) & (w.data[1:] >= 0x80) & (w.data[1:] <= 0x9E) & (w.data[1:] != 0x97)
            low[upper2] += 0x20
        self.value = tx.range_hashes(tx.padded(low), begin, end)

        def some(flags: np.ndarray) -> np.ndarray:
            t = np.zeros(n + 1, np.int64)
            np.cumsum(flags, out=t[1:])
            return t[end] - t[begin] > 0

        number = some(DIGIT[w.data])
        head = w.data[begin]
        capital = ((head >= 65) & (head <= 90)) | ((head == 0xC3) & upper2[np.minimum(begin + 1, n - 1)] if n else np.zeros(0, bool))
        lines = np.zeros(n + 1, np.int64)
        np.cumsum(w.data == 10, out=lines[1:])
        opens = np.ones(len(begin), bool)
        if len(begin) > 1:
            # the word before, with its punctuation, ends a sentence, or a line break lies between
            before = w.end[word_of[1:] - 1] - 1
            opens[1:] = STOP[w.data[before]] | (lines[begin[1:]] > lines[end[:-1]])
        self.first = np.searchsorted(begin, w.text_start)
        self.count = np.searchsorted(begin, w.text_end) - self.first
        opens[self.first[self.count > 0]] = True
        name = capital & ~opens & ~number
        unit = np.zeros(len(begin), bool)
        if len(begin) > 1:
            unit[1:] = number[:-1] & ~number[1:] & np.isin(self.value[1:], unit_hashes())
            unit[self.first[self.count > 0]] = False
        name &= ~unit
        self.slot = number | name | unit
        self.context = name | unit
        self.code = self.value.copy()
        self.code[number] = NUMBER
        self.code[name] = NAME
        self.code[unit] = UNIT

    def windows(self, width: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(starts, hashes, template) of all windows of width words within one text.

        Each has a hash of its literal words (template 0), and one or two of its template (1) if half its words are literal.
        """
        m = len(self.code) - width + 1
        if m <= 0:
            return np.zeros(0, np.int64), np.zeros(0, tx.U64), np.zeros(0, bool)
        slots = np.concatenate([[0], np.cumsum(self.slot)])
        text = np.repeat(np.arange(len(self.count)), self.count)
        inside = text[:m] == text[width - 1 :]
        every = np.flatnonzero(inside)
        some = np.flatnonzero(inside & (2 * (slots[width:] - slots[:-width]) <= width))
        # names and units depend on the word before, so a window is also read as if nothing stood before it
        bare = np.flatnonzero(inside & self.context[:m] & (2 * (slots[width:] - slots[1 : m + 1]) <= width))
        codes = self.code[bare[:, None] + np.arange(width)]
        codes[:, 0] = self.value[bare]
        read = np.array([], tx.U64) if not len(bare) else tx.window_hashes(codes.reshape(-1), width)[::width]
        hashes = [tx.window_hashes(self.value, width)[every] ^ LITERAL, tx.window_hashes(self.code, width)[some], read]
        return np.concatenate([every, some, bare]), np.concatenate(hashes), np.arange(len(every) + len(some) + len(bare)) >= len(every)


_units: list[np.ndarray] = []


def unit_hashes() -> np.ndarray:
    if not _units:
        _units.append(np.array([_hash(u) for u in UNITS], tx.U64))
    return _units[0]


def _hash(word: str) -> int:
    raw = np.frombuffer(word.encode(), np.uint8)
    w = tx.Words(raw, np.zeros(1, np.int64), np.array([len(raw)]))
    return int(w.hashes(w.text_start, w.text_end)[0])


def _texts(column: pa.Array):
    return tx.string_bytes(column.fill_null("") if column.null_count else column)


class Index:
    """The windows of a block of benchmark items."""

    def __init__(self, items: list[tuple[int, str]], width: int, least_words: int):
        raw, starts, ends = _texts(pa.array([t or "" for _, t in items], pa.string()))
        t = Templates(raw, starts, ends)
        self.items = [i for i, _ in items]
        self.value, self.slot, self.first = t.value, t.slot, t.first
        text = np.repeat(np.arange(len(t.count)), t.count)
        hashes, entries, sizes, light = [], [], [], np.zeros(len(t.code), bool)
        self.least_words = least_words
        for size in sorted({width, *(int(c) for c in t.count if 0 < c < width)}):
            at, h, template = t.windows(size)
            own = t.count[text[at]] if len(at) else np.zeros(0, np.int64)
            keep = own >= width if size == width else own == size
            hashes.append(h[keep])
            entries.append(at[keep])
            sizes.append(np.full(int(keep.sum()), size))
            light[at[keep & template]] = True
        self.hash, self.at, self.size = map(np.concatenate, (hashes, entries, sizes))
        order = np.argsort(self.hash, kind="stable")
        self.hash, self.at, self.size = self.hash[order], self.at[order], self.size[order]
        self.item = text[self.at] if len(self.at) else np.zeros(0, np.int64)
        # each window of an item counts once, and so does each that has a template
        self.light = light
        once = np.unique(self.at)
        self.total = np.bincount(text[once], minlength=len(items))
        self.total_light = np.bincount(text[once[light[once]]], minlength=len(items))
        self.widths = sorted(set(self.size.tolist()))


def matches(column: pa.Array, index: Index, least_cover: float, least_agree: float) -> list[tuple[int, int, int, int, int, int, bool]]:
    """(row, item, windows found, windows of the item, slots compared, slots that agree, leaked)."""
    raw, starts, ends = _texts(column)
    out = []
    for i, j in tx.chunks(starts, ends):
        t = Templates(raw, starts[i:j], ends[i:j])
        text = np.repeat(np.arange(j - i), t.count)
        pairs = []
        for width in index.widths:
            at, h, _ = t.windows(width)
            low, high = np.searchsorted(index.hash, h), np.searchsorted(index.hash, h, side="right")
            hit = high > low
            if width < index.least_words:
                hit &= t.count[text[at]] == width
            hit = np.flatnonzero(hit)
            for p, a, b in zip(at[hit].tolist(), low[hit].tolist(), high[hit].tolist()):
                pairs += [(int(text[p]), int(index.item[e]), int(index.at[e]), p, width) for e in range(a, b) if index.size[e] == width]
        pairs = sorted(set(pairs))
        k = 0
        while k < len(pairs):
            e = k
            while e < len(pairs) and pairs[e][:2] == pairs[k][:2]:
                e += 1
            row, item = pairs[k][:2]
            places = {p[2] for p in pairs[k:e]}
            light = sum(bool(index.light[q]) for q in places)
            for found, total in ((light, int(index.total_light[item])), (len(places), int(index.total[item]))):
                if found and found >= least_cover * total:
                    slots, agree = _slots(index, t, pairs[k:e])
                    out.append((i + row, item, found, total, slots, agree, agree >= least_agree * slots))
                    break
            k = e
    return out


def _slots(index: Index, t: Templates, pairs: list[tuple]) -> tuple[int, int]:
    """(slots of the item seen, those on which a one-to-one reading of its values as the document's agrees)."""
    seen: dict[int, dict[int, int]] = {}
    for *_, q, p, width in pairs:
        for k in range(width):
            if index.slot[q + k]:
                seen.setdefault(q + k, {}).setdefault(int(t.value[p + k]), 0)
                seen[q + k][int(t.value[p + k])] += 1
    votes: dict[tuple[int, int], int] = {}
    for place, values in seen.items():
        for v in values:
            pair = int(index.value[place]), v
            votes[pair] = votes.get(pair, 0) + 1
    agree, mine, theirs = 0, set(), set()
    for (x, v), n in sorted(votes.items(), key=lambda e: (-e[1], e[0][0] != e[0][1], e[0])):
        if x not in mine and v not in theirs:  # a value stands for one value, and one only
            mine.add(x)
            theirs.add(v)
            agree += n
    return len(seen), agree


def blocks(benchmark: DataFrame, item_col: str, text_col: str, block_chars: int) -> Iterator[list[tuple[int, str]]]:
    """All items, in blocks of about block_chars characters at most (or one item)."""
    items = benchmark.select(F.col(item_col).alias("i"), F.col(text_col).alias("t")).where("t is not null")
    size = items.agg(F.sum(F.length("t"))).first()[0] or 0
    many = -(-size // block_chars)
    for k in range(many):
        part = items if many == 1 else items.where(F.pmod(F.xxhash64("i", "t"), F.lit(many)) == k)
        if rows := sorted((r["i"], r["t"]) for r in part.collect()):
            yield rows


def leaks(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id", item_text_col: str = "text", width: int = 8, least_cover: float = 0.5, least_agree: float = 0.7, least_words: int = 4, block_chars: int = 16 << 20) -> DataFrame:
    """(id_col, item_col, n_found, n_windows, n_slots, n_agree, leaked) of each document and item with enough windows in common."""
    source = docs.select(id_col, text_col)
    kind = T.StructType([source.schema[id_col], T.StructField(item_col, benchmark.schema[item_col].dataType), *(T.StructField(c, T.LongType()) for c in ("n_found", "n_windows", "n_slots", "n_agree")), T.StructField("leaked", T.BooleanType())])
    found = docs.sparkSession.createDataFrame([], kind)
    item_type = to_arrow_type(kind[item_col].dataType)
    for items in blocks(benchmark, item_col, item_text_col, block_chars):
        index = Index(items, width, least_words)

        def run(batches: Iterator[pa.RecordBatch], index: Index = index) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                if rows := matches(batch.column(1), index, least_cover, least_agree):
                    r, item, *numbers, leaked = zip(*rows)
                    yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(r)), pa.array([index.items[k] for k in item], item_type), *(pa.array(x, pa.int64()) for x in numbers), pa.array([bool(x) for x in leaked])], kind.names)

        found = found.unionByName(source.transform(in_arrow, run, kind))
    return found


def keep(docs: DataFrame, benchmark: DataFrame, text_col: str = "text", item_col: str = "item_id", item_text_col: str = "text", width: int = 8, least_cover: float = 0.5, least_agree: float = 0.7, least_words: int = 4, block_chars: int = 16 << 20) -> DataFrame:
    """The rows of docs, all columns as they are, that leak no item."""
    where = docs.columns.index(text_col)
    for items in blocks(benchmark, item_col, item_text_col, block_chars):
        index = Index(items, width, least_words)

        def run(batches: Iterator[pa.RecordBatch], index: Index = index) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                fine = np.ones(batch.num_rows, bool)
                fine[[m[0] for m in matches(batch.column(where), index, least_cover, least_agree) if m[-1]]] = False
                yield batch.filter(pa.array(fine))

        docs = docs.transform(in_arrow, run, docs.schema)
    return docs
