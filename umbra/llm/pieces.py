"""SentencePiece encoding and decoding: an Aho-Corasick automaton over the pieces drives a one-pass Viterbi.

The automaton is a table (state, byte) to state, so each byte is one step, failures included. At each position the
output links of the state name the pieces that end there; each relaxes the best score of that position. The pieces'
scores are the model's; among segmentations of equal score the one whose last piece is longest wins, position by
position. A character no piece covers costs more than any piece and is spelled in byte pieces.

A blank stands for the model's blank mark, inside as byte 0xFF, which UTF-8 never has; so the mark's own character is
spelled in bytes and every text comes back as it was: decode(encode(x)) = x. As no piece has a blank after other
characters, text falls into units (blanks, then the rest), which are segmented once for each batch of texts and
remembered; units advance side by side, one byte a step.

The model is BPE or unigram; scores are maximised either way, so ids of a BPE model are the best-scored
segmentation, which may differ from merging in order. Rows: a null text gives null ids, an empty one none. Repeated
rows, ties and long texts need no care: texts are read whole. Extra columns are not read.
"""

from __future__ import annotations

from collections import deque
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F, types as T

from umbra.llm import text as tx
from umbra.llm.shared import in_arrow

BLANK = 0xFF
MARK = "▁".encode()
MEMORY = 100_000  # units remembered by a worker
CHUNK = 1 << 20  # bytes of text segmented together
ROWS = 500  # texts encoded and decoded together
TOGETHER = 12  # below so many units, the rest of each is walked alone


@dataclass(frozen=True)
class Vocabulary:
    """What a model file says: text and score of the pieces to match, ids of the 256 byte pieces, text of every id."""

    pieces: tuple[bytes, ...]
    ids: tuple[int, ...]
    scores: tuple[float, ...]
    byte_ids: tuple[int, ...]
    surface: tuple[bytes, ...]


def load(path: str) -> Vocabulary:
    """The vocabulary of a model file; read on the driver and sent with the tasks (its size is that of the file)."""
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=path)
    pieces, ids, scores, surface = [], [], [], []
    byte_ids = [-1] * 256
    for k in range(model.get_piece_size()):
        name = model.id_to_piece(k)
        if model.is_byte(k):
            byte_ids[int(name[3:5], 16)] = k
            surface.append(bytes([int(name[3:5], 16)]))
        elif model.is_control(k) or model.is_unknown(k) or model.is_unused(k):
            surface.append(b"")
        else:
            raw = name.encode().replace(MARK, bytes([BLANK]))
            if b"\xff" in raw.lstrip(b"\xff"):
                raise ValueError(f"piece {k} has a blank after other characters")
            pieces.append(raw)
            ids.append(k)
            scores.append(model.get_score(k))
            surface.append(raw.replace(b"\xff", b" "))
    if -1 in byte_ids:
        raise ValueError("the model has no byte pieces")
    return Vocabulary(tuple(pieces), tuple(ids), tuple(scores), tuple(byte_ids), tuple(surface))


class Automaton:
    """Aho-Corasick: go[state, kind[byte]]; bytes in no piece are of kind 0; out[state] is the longest piece that ends there, then[piece] the next shorter one."""

    def __init__(self, pieces: tuple[bytes, ...]):
        children: list[dict[int, int]] = [{}]
        ends = [-1]
        for k, p in enumerate(pieces):
            s = 0
            for b in p:
                t = children[s].get(b)
                if t is None:
                    t = children[s][b] = len(children)
                    children.append({})
                    ends.append(-1)
                s = t
            ends[s] = k
        used = sorted({b for p in pieces for b in p})
        self.kind = np.zeros(256, np.uint8 if len(used) < 256 else np.uint16)
        self.kind[used] = np.arange(1, len(used) + 1)
        kind = self.kind.tolist()
        self.go = np.zeros((len(children), len(used) + 1), np.int32)
        self.out = np.full(len(children), -1, np.int32)
        self.then = np.full(len(pieces), -1, np.int32)
        fail = [0] * len(children)
        for b, t in children[0].items():
            self.go[0, kind[b]] = t
        line = deque(children[0].values())
        for t in line:
            self.out[t] = ends[t]
        while line:
            s = line.popleft()
            f = fail[s]
            self.go[s] = self.go[f]
            for b, t in children[s].items():
                fail[t] = int(self.go[f, kind[b]])
                self.go[s, kind[b]] = t
                below = self.out[fail[t]]
                if ends[t] >= 0:
                    self.then[ends[t]] = below
                    self.out[t] = ends[t]
                else:
                    self.out[t] = below
                line.append(t)


class Encoder:
    def __init__(self, vocabulary: Vocabulary):
        self.automaton = Automaton(vocabulary.pieces)
        self.size = np.array([len(p) for p in vocabulary.pieces], np.int32)
        self.score = np.array(vocabulary.scores, np.float64)
        self.ids = np.array(vocabulary.ids, np.int32)
        self.byte_ids = np.array(vocabulary.byte_ids, np.int32)
        self.unknown = float(self.score.min()) - 10 if len(self.score) else -10.0
        self.known = np.zeros(0, tx.U64)
        self.known_at = np.zeros(1, np.int64)
        self.known_ids = np.zeros(0, np.int32)

    def units(self, data: np.ndarray, start: np.ndarray, size: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all units one after another, where each unit's begin) of units data[start:start + size], all not empty."""
        order = np.argsort(-size, kind="stable")
        size, start = size[order], start[order]
        off = np.concatenate([[0], np.cumsum(size + 1)])[:-1]
        total = int(size.sum() + len(size))
        best = np.full(total, -np.inf)
        best[off] = 0
        back = np.full(total, -1, np.int32)  # the piece that ends here; -1: a character spelled in bytes
        char = np.zeros(total, np.int32)  # bytes of the character that ends here, 0 within one
        lead = np.zeros(len(size), np.int64)
        state = np.zeros(len(size), np.int32)
        a, go = self.automaton, self.automaton.go
        t, active = 0, len(size)
        while active:
            active = int(np.searchsorted(-size, -t, side="left"))  # units longer than t
            if active < TOGETHER:
                break
            live = off[:active] + t + 1
            where = start[:active] + t
            b = data[where]
            state[:active] = s = go[state[:active], a.kind[b]]
            after = np.where(t + 1 < size[:active], data[np.minimum(where + 1, len(data) - 1)], 0)
            begins = (b & 0xC0) != 0x80
            lead[:active][begins] = t
            closed = (after & 0xC0) != 0x80
            piece = a.out[s]
            at = np.flatnonzero(piece >= 0)
            piece = piece[at]
            while len(at):
                here = live[at]
                got = best[here - self.size[piece]] + self.score[piece]
                more = got > best[here]
                best[here[more]] = got[more]
                back[here[more]] = piece[more]
                piece = a.then[piece]
                on = piece >= 0
                at, piece = at[on], piece[on]
            end = np.flatnonzero(closed)
            here = live[end]
            width = (t + 1 - lead[end]).astype(np.int32)
            char[here] = width
            got = best[here - width] + self.unknown
            more = got > best[here]
            best[here[more]] = got[more]
            back[here[more]] = -1
            t += 1
        for k in range(active):
            self._alone(data, int(start[k]), int(size[k]), int(off[k]), t, int(state[k]), int(lead[k]), best, back, char)
        counts = np.zeros(len(size), np.int64)
        place = size.astype(np.int64).copy()
        live = np.arange(len(size))
        trail = []
        while len(live):
            at = off[live] + place[live]
            piece = back[at]
            width = np.where(piece >= 0, self.size[piece] if len(self.size) else 0, char[at])
            n = np.where(piece >= 0, 1, width)
            counts[live] += n
            trail.append((live, piece, width, place[live] - width))
            place[live] -= width
            live = live[place[live] > 0]
        stop = np.cumsum(counts)
        begin = stop - counts
        flat = np.zeros(int(stop[-1]) if len(stop) else 0, np.int32)
        fill = stop.copy()
        for live, piece, width, place in trail:
            whole = piece >= 0
            u = live[whole]
            fill[u] -= 1
            flat[fill[u]] = self.ids[piece[whole]]
            for u, w, p in zip(live[~whole].tolist(), width[~whole].tolist(), place[~whole].tolist()):
                fill[u] -= w
                flat[fill[u] : fill[u] + w] = self.byte_ids[data[start[u] + p : start[u] + p + w]]
        first = np.zeros(len(size) + 1, np.int64)
        counts_back = np.zeros(len(size), np.int64)
        counts_back[order] = counts
        np.cumsum(counts_back, out=first[1:])
        source = np.zeros(len(size), np.int64)
        source[order] = begin
        return flat[ragged(source, counts_back)], first

    def _alone(self, data, start, size, off, t, state, lead, best, back, char) -> None:
        """The rest of one unit, from its byte t on."""
        go, out, then = self.automaton.go, self.automaton.out, self.automaton.then
        row = best[off : off + size + 1].tolist()
        sizes, scores, kind = self.size, self.score, self.automaton.kind
        text = data[start : start + size].tolist() + [0]
        for p in range(t, size):
            b = text[p]
            state = int(go[state, kind[b]])
            if b & 0xC0 != 0x80:
                lead = p
            piece, top, of = int(out[state]), row[p + 1], -1
            while piece >= 0:
                got = row[p + 1 - int(sizes[piece])] + float(scores[piece])
                if got > top:
                    top, of = got, piece
                piece = int(then[piece])
            if text[p + 1] & 0xC0 != 0x80:
                width = p + 1 - lead
                char[off + p + 1] = width
                got = row[p + 1 - width] + self.unknown
                if got > top:
                    top, of = got, -1
            row[p + 1] = top
            back[off + p + 1] = of
        best[off : off + size + 1] = row

    def encode(self, column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all texts, where each text's begin)."""
        column = column.fill_null("") if column.null_count else column
        raw, starts, ends = tx.string_bytes(column)
        parts, counts = [np.zeros(0, np.int32)], np.zeros(len(column), np.int64)
        for i, j in tx.chunks(starts, ends, CHUNK):
            ids, n = self._chunk(raw, starts[i:j], ends[i:j])
            parts.append(ids)
            counts[i:j] = n
        return np.concatenate(parts), np.concatenate([[0], np.cumsum(counts)])

    def _chunk(self, raw: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        size = ends - starts
        full = np.flatnonzero(size > 0)
        counts = np.zeros(len(starts), np.int64)
        if not len(full):
            return np.zeros(0, np.int32), counts
        n = size[full]
        stop = np.cumsum(n + 1)
        begin = stop - n - 1
        data = np.full(int(stop[-1]), BLANK, np.uint8)
        body = raw[ragged(starts[full], n)]
        data[ragged(begin + 1, n)] = np.where(body == 0x20, np.uint8(BLANK), body)
        new = data == BLANK
        new[1:] &= data[:-1] != BLANK
        new[begin] = True
        first = np.flatnonzero(new)
        width = np.diff(np.append(first, len(data)))
        name = tx.range_hashes(tx.padded(data), first, first + width)
        distinct, where, back = np.unique(name, return_index=True, return_inverse=True)
        at = np.minimum(np.searchsorted(self.known, distinct), max(len(self.known) - 1, 0))
        old = self.known[at] == distinct if len(self.known) else np.zeros(len(distinct), bool)
        fresh = np.flatnonzero(~old)
        ids, edge = self.units(data, first[where[fresh]], width[where[fresh]].astype(np.int32)) if len(fresh) else (np.zeros(0, np.int32), np.zeros(1, np.int64))
        both = np.concatenate([self.known_ids, ids])
        source, count = np.zeros(len(distinct), np.int64), np.zeros(len(distinct), np.int64)
        source[old], count[old] = self.known_at[:-1][at[old]], np.diff(self.known_at)[at[old]]
        source[fresh], count[fresh] = len(self.known_ids) + edge[:-1], np.diff(edge)
        if len(fresh):
            self._remember(distinct, source, count, both, fresh)
        each = count[back]
        of = np.searchsorted(begin, first, side="right") - 1
        counts[full] = np.bincount(of, weights=each, minlength=len(full)).astype(np.int64)
        return both[ragged(source[back], each)], counts

    def _remember(self, distinct, source, count, both, fresh) -> None:
        """Joins the new units to those known; past MEMORY, keeps this chunk's alone."""
        if len(self.known) + len(fresh) > MEMORY:
            name, at, n = distinct[:MEMORY], source[:MEMORY], count[:MEMORY]
        else:
            name = np.concatenate([self.known, distinct[fresh]])
            at = np.concatenate([self.known_at[:-1], source[fresh]])
            n = np.concatenate([np.diff(self.known_at), count[fresh]])
            order = np.argsort(name, kind="stable")
            name, at, n = name[order], at[order], n[order]
        self.known = name
        self.known_ids = both[ragged(at, n)]
        self.known_at = np.concatenate([[0], np.cumsum(n)])


def ragged(start: np.ndarray, count: np.ndarray) -> np.ndarray:
    """start[0], start[0] + 1, ... (count[0] of them), start[1], ..."""
    stop = np.cumsum(count)
    total = int(stop[-1]) if len(stop) else 0
    return np.arange(total) + np.repeat(start - (stop - count), count)


class Decoder:
    def __init__(self, vocabulary: Vocabulary):
        self.count = np.array([len(s) for s in vocabulary.surface], np.int64)
        self.start = np.concatenate([[0], np.cumsum(self.count)])[:-1]
        self.text = np.frombuffer(b"".join(vocabulary.surface), np.uint8)

    def decode(self, ids: np.ndarray, edges: np.ndarray) -> list[str]:
        """The texts of ids[edges[k]:edges[k + 1]]; bytes that are no UTF-8 become U+FFFD."""
        n = self.count[ids]
        data = self.text[ragged(self.start[ids], n)].tobytes()
        at = np.concatenate([[0], np.cumsum(n)])[edges]
        return [data[a + (data[a : a + 1] == b" ") : b].decode("utf-8", "replace") for a, b in zip(at[:-1].tolist(), at[1:].tolist())]


_made: dict[tuple[type, int, int], object] = {}


def _of(kind: type, vocabulary: Vocabulary):
    key = (kind, len(vocabulary.surface), hash(vocabulary.surface))
    if key not in _made:
        _made[key] = kind(vocabulary)
    return _made[key]


def encode(docs: DataFrame, vocabulary: Vocabulary, id_col: str = "doc_id", text_col: str = "text", keep: list[str] = []) -> DataFrame:
    """(id_col, keep, ids) of every row."""
    source = docs.select(id_col, *keep, text_col)
    where = 1 + len(keep)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = _of(Encoder, vocabulary)
        for batch in (b.slice(k, ROWS) for b in batches for k in range(0, b.num_rows, ROWS)):
            ids, edges = encoder.encode(batch.column(where))
            gone = batch.column(where).is_null() if batch.column(where).null_count else None
            coded = pa.ListArray.from_arrays(pa.array(edges.astype(np.int32)), pa.array(ids), mask=gone)
            yield pa.RecordBatch.from_arrays([*batch.columns[:where], coded], [id_col, *keep, "ids"])

    return source.transform(in_arrow, run, T.StructType([*source.schema.fields[:where], T.StructField("ids", T.ArrayType(T.IntegerType()))]))


def decode(coded: DataFrame, vocabulary: Vocabulary, id_col: str = "doc_id", ids_col: str = "ids") -> DataFrame:
    """(id_col, text) of every row; null ids give a null text."""
    source = coded.select(id_col, ids_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        decoder = _of(Decoder, vocabulary)
        for batch in batches:
            lists = batch.column(1)
            edges = np.concatenate([[0], np.cumsum(lists.value_lengths().fill_null(0).to_numpy(zero_copy_only=False))]).astype(np.int64)
            texts = decoder.decode(lists.flatten().to_numpy(zero_copy_only=False), edges)
            gone = lists.is_null().to_numpy(zero_copy_only=False)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(texts, pa.string(), mask=gone)], [id_col, "text"])

    return source.transform(in_arrow, run, T.StructType([source.schema[id_col], T.StructField("text", T.StringType())]))


def round_trip(docs: DataFrame, vocabulary: Vocabulary, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id_col, n_tokens, ids_sha256, intact) of every row: the digest of the ids as little-endian int32, and whether
    decoding gives the text back."""
    import hashlib

    source = docs.select(id_col, text_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, decoder = _of(Encoder, vocabulary), _of(Decoder, vocabulary)
        for batch in (b.slice(k, ROWS) for b in batches for k in range(0, b.num_rows, ROWS)):
            ids, edges = encoder.encode(batch.column(1))
            texts = decoder.decode(ids, edges)
            same = [x == (y or "") for x, y in zip(texts, batch.column(1).to_pylist())]
            sha = [hashlib.sha256(ids[a:b].astype("<i4").tobytes()).hexdigest() for a, b in zip(edges[:-1], edges[1:])]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(np.diff(edges)), pa.array(sha, pa.string()), pa.array(same, pa.bool_())], [id_col, "n_tokens", "ids_sha256", "intact"])

    return source.transform(in_arrow, run, T.StructType([source.schema[id_col], T.StructField("n_tokens", T.LongType()), T.StructField("ids_sha256", T.StringType()), T.StructField("intact", T.BooleanType())]))
