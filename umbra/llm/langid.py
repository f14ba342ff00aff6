"""Language ID: sparse multinomial logistic regression on TF-IDF character n-grams.

Features are the 1- to 3-grams of lower-cased letters, with every run of other characters read as one blank, hashed to
2**16 dimensions. Document frequencies are counted over all labelled rows; the weights come from a sample of at most
``sample_rows`` labelled rows (the one bound here), by follow-the-regularised-leader with elastic-net penalties, and a
temperature fitted on sample rows kept apart calibrates the probabilities.

Rows: a null text, an empty one or one without a letter gets ``und`` and score 0. Without any labelled row every text
gets ``und``. Repeated rows and ties (equal probabilities: the language first in name order) are as any other row.
Texts of any length are read whole. Columns of the input that bear an output's name are not touched: the result has
the id column and the outputs only.
"""

from __future__ import annotations

import functools
from collections.abc import Callable, Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F, types as T

from umbra.llm import text as tx
from umbra.llm.shared import in_arrow

BITS = 16
ORDERS = (1, 2, 3)
SCALE = 16.0
UNKNOWN = "und"


@functools.cache
def _letters() -> np.ndarray:
    """Code point to its lower-case letter, 0 for what is no letter."""
    table = np.arange(0x110000, dtype=np.uint32)
    table[~np.fromiter(map(str.isalpha, map(chr, range(0x110000))), bool, 0x110000)] = 0
    for c in range(0x20000):
        if table[c] and len(low := chr(c).lower()) == 1:
            table[c] = ord(low)
    return table


def grams(raw: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, bool]]:
    """For each order: (features, start of each text's in them, end), and at last (letters of each text)."""
    low, high = int(starts[0]), max(int(ends[-1]), int(starts[0]))
    data = raw[low:high]
    lead = np.zeros(len(data) + 1, np.int64)
    np.cumsum((data & 0xC0) != 0x80, out=lead[1:])
    points = np.frombuffer(data.tobytes().decode("utf-8", "replace").encode("utf-32-le"), np.uint32)
    if len(points) != lead[-1]:  # bytes that are no UTF-8: their texts are read with U+FFFD, which is no letter
        texts = [data[a:b].tobytes().decode("utf-8", "replace").encode() for a, b in zip(starts - low, ends - low)]
        edges = np.concatenate([[0], np.cumsum([len(x) for x in texts])]).astype(np.int64)
        yield from grams(np.frombuffer(b"".join(texts), np.uint8), edges[:-1], edges[1:])
        return
    x = _letters()[points]
    keep = np.ones(len(x), bool)
    keep[1:] = (x[1:] != 0) | (x[:-1] != 0)
    at = np.zeros(len(x) + 1, np.int64)
    np.cumsum(keep, out=at[1:])
    y = x[keep]
    a, b = at[lead[starts - low]], at[lead[ends - low]]
    for n in ORDERS:
        m = max(0, len(y) - n + 1)
        h = np.full(m, n * 0x9E3779B1 & 0xFFFFFFFF, np.uint32)
        for k in range(n):
            h = (h ^ y[k : k + m]) * np.uint32(0x85EBCA6B)
            h ^= h >> np.uint32(15)
        yield h >> np.uint32(32 - BITS), a, np.maximum(a, b - n + 1), False
    total = np.zeros(len(y) + 1, np.int64)
    np.cumsum(y != 0, out=total[1:])
    yield total[b] - total[a], a, b, True


def _pieces(raw, starts, ends):
    """Chunks of rows as (first row, row after the last, grams)."""
    for i, j in tx.chunks(starts, ends):
        yield i, j, list(grams(raw, starts[i:j], ends[i:j]))


def _compact(column: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    return tx.string_bytes(pa.array(column.fill_null("")) if column.null_count else column)


@dataclass
class LanguageModel:
    languages: list[str]
    table: np.ndarray  # (2**BITS, languages): weight times inverse document frequency
    bias: np.ndarray
    temperature: float = 1.0
    facts: dict = field(default_factory=dict)

    def margins(self, column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """(margins of each text and language, letters of each text)."""
        out = np.tile(self.bias, (len(column), 1)).astype(np.float64)
        letters = np.zeros(len(column), np.int64)
        raw, starts, ends = _compact(column)
        for i, j, found in _pieces(raw, starts, ends):
            total, size = np.zeros((j - i, len(self.languages))), np.zeros(j - i, np.int64)
            for h, a, b, last in found:
                if last:
                    letters[i:j] = h
                    continue
                full = np.flatnonzero(b > a)
                size[full] += (b - a)[full]
                if len(full):
                    edges = np.empty(2 * len(full), np.int64)
                    edges[0::2], edges[1::2] = a[full], b[full]
                    for c in range(len(self.languages)):
                        w = np.append(self.table[h, c], np.float32(0))
                        total[full, c] += np.add.reduceat(w, edges, dtype=np.float64)[0::2]
            out[i:j] += SCALE * total / np.maximum(size, 1)[:, None]
        return out, letters

    def predict(self, column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """(index of the language, or -1; its calibrated probability)."""
        if not self.languages:
            return np.full(len(column), -1), np.zeros(len(column))
        margin, letters = self.margins(column)
        p = softmax(margin / self.temperature)
        best = p.argmax(1)
        score = p[np.arange(len(best)), best]
        return np.where(letters > 0, best, -1), np.where(letters > 0, score, 0.0)


def softmax(m: np.ndarray) -> np.ndarray:
    e = np.exp(m - m.max(-1, keepdims=True))
    return e / e.sum(-1, keepdims=True)


def _frequencies(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    seen, df, n = np.zeros(1 << BITS, bool), np.zeros(1 << BITS, np.int64), 0
    for batch in batches:
        raw, starts, ends = _compact(batch.column(0))
        n += batch.num_rows
        for i, j, found in _pieces(raw, starts, ends):
            for k in range(j - i):
                for h, a, b, last in found:
                    if not last and b[k] > a[k]:
                        seen[h[a[k] : b[k]]] = True
                there = np.flatnonzero(seen)
                df[there] += 1
                seen[there] = False
    if n:
        yield pa.RecordBatch.from_arrays([pa.array([n]), pa.array([df.tobytes()], pa.binary())], ["n", "df"])


def _summed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    df, n = np.zeros(1 << BITS, np.int64), 0
    for batch in batches:
        for k in range(batch.num_rows):
            n += batch.column(0)[k].as_py()
            df += np.frombuffer(batch.column(1)[k].as_buffer(), np.int64)
    if n:
        yield pa.RecordBatch.from_arrays([pa.array([n]), pa.array([df.tobytes()], pa.binary())], ["n", "df"])


def _vectors(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        raw, starts, ends = _compact(batch.column(2))
        index, count = [], []
        for i, j, found in _pieces(raw, starts, ends):
            for k in range(j - i):
                parts = [h[a[k] : b[k]] for h, a, b, last in found if not last]
                u, c = np.unique(np.concatenate(parts) if parts else np.zeros(0, np.uint32), return_counts=True)
                index.append(u.astype(np.uint32).tobytes())
                count.append(c.astype(np.uint32).tobytes())
        yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(index, pa.binary()), pa.array(count, pa.binary())], ["id", "lang", "at", "n"])


def ftrl(rows: list[tuple[np.ndarray, np.ndarray, int]], classes: int, epochs: int, alpha: float, beta: float, l1: float, l2: float) -> tuple[np.ndarray, np.ndarray]:
    """(weights, bias) of a multinomial logistic regression, by follow-the-regularised-leader with elastic net."""
    z, n = np.zeros((1 << BITS, classes)), np.zeros((1 << BITS, classes))
    zb, nb = np.zeros(classes), np.zeros(classes)

    def weights(z: np.ndarray, n: np.ndarray, l1: float) -> np.ndarray:
        return np.where(np.abs(z) > l1, -(z - np.sign(z) * l1) / ((beta + np.sqrt(n)) / alpha + l2), 0.0)

    for epoch in range(epochs):
        for k in np.random.RandomState(epoch).permutation(len(rows)):
            at, x, y = rows[k]
            zk, nk = z[at], n[at]
            w, b = weights(zk, nk, l1), weights(zb, nb, 0.0)
            p = softmax(x @ w + b)
            p[y] -= 1
            g = x[:, None] * p
            more = nk + g * g
            z[at] = zk + g - (np.sqrt(more) - np.sqrt(nk)) / alpha * w
            n[at] = more
            zb += p - (np.sqrt(nb + p * p) - np.sqrt(nb)) / alpha * b
            nb += p * p
    return weights(z, n, l1), weights(zb, nb, 0.0)


def temperature(margin: np.ndarray, y: np.ndarray) -> float:
    """The temperature with the least negative log likelihood; 1 if there is nothing to fit it on."""
    if not len(y):
        return 1.0

    def loss(t: float) -> float:
        return float(-np.log(np.maximum(softmax(margin / t)[np.arange(len(y)), y], 1e-12)).mean())

    grid = np.exp(np.linspace(np.log(0.05), np.log(20), 121))
    return float(grid[int(np.argmin([loss(t) for t in grid]))])


def fit(labelled: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", sample_rows: int = 3000, epochs: int = 3, alpha: float = 0.5, beta: float = 0.1, l1: float = 0.01, l2: float = 0.1) -> LanguageModel:
    """A model from the rows with a label and a text; sample_rows bounds what the weights are fitted on.

    Every label is learned, each from eight sample rows at least; the weights take 3 MB of the driver for a label.
    """
    rows = labelled.select(F.col(id_col).alias("id"), F.col(lang_col).alias("lang"), F.col(text_col).alias("text")).where("lang is not null and text is not null")
    counts = sorted((r["lang"], r["count"]) for r in rows.groupBy("lang").count().collect())
    if not counts:
        return LanguageModel([], np.zeros((1 << BITS, 0), np.float32), np.zeros(0))
    languages, each = [x for x, _ in counts], max(8, sample_rows // len(counts))
    spread = labelled.sparkSession.sparkContext.defaultParallelism
    per_task = rows.select("text").transform(in_arrow, _frequencies, "n long, df binary")
    partial = per_task.repartition(min(16, 2 * spread)).transform(in_arrow, _summed, "n long, df binary").collect()
    n = sum(r["n"] for r in partial)
    df = sum(np.frombuffer(r["df"], np.int64) for r in partial)
    idf = (np.log((1 + n) / (1 + df)) + 1).astype(np.float64)

    share = F.create_map(*[F.lit(x) for lang, count in counts for x in (lang, min(1.0, each / count))])
    uniform = F.pmod(F.xxhash64(F.lit(7), "id"), F.lit(1 << 32)) / F.lit(float(1 << 32))
    picked = rows.where(uniform < share[F.col("lang")]).transform(in_arrow, _vectors, T.StructType([rows.schema["id"], T.StructField("lang", T.StringType()), T.StructField("at", T.BinaryType()), T.StructField("n", T.BinaryType())])).collect()
    train, apart = [], []
    for k, r in enumerate(sorted(picked, key=lambda r: (r["id"] is None, r["id"], r["at"]))):
        at, count = np.frombuffer(r["at"], np.uint32), np.frombuffer(r["n"], np.uint32)
        if len(at):
            (apart if k % 5 == 4 else train).append((at, SCALE * idf[at] * count / count.sum(), languages.index(r["lang"])))
    w, bias = ftrl(train, len(languages), epochs, alpha, beta, l1, l2)
    margin = np.array([x @ w[at] + bias for at, x, _ in apart]).reshape(len(apart), len(languages))
    heat = temperature(margin, np.array([y for *_, y in apart], int))
    return LanguageModel(languages, (w * idf[:, None]).astype(np.float32), bias, heat, {"rows": int(n), "sample": len(picked), "weights": int((w != 0).sum())})


def predict(docs: DataFrame, model: LanguageModel, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id_col, lang_pred, score) of every row."""
    names = pa.array([*model.languages, UNKNOWN])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            best, score = model.predict(batch.column(1))
            best = np.where(best < 0, len(names) - 1, best)
            yield pa.RecordBatch.from_arrays([batch.column(0), names.take(pa.array(best)), pa.array(score)], [id_col, "lang_pred", "score"])

    source = docs.select(id_col, text_col)
    return source.transform(in_arrow, run, T.StructType([source.schema[id_col], T.StructField("lang_pred", T.StringType()), T.StructField("score", T.DoubleType())]))


def keep(docs: DataFrame, model: LanguageModel, text_col: str = "text", least: float = 0.5, accepted: Callable[[str], bool] | None = None) -> DataFrame:
    """The rows of docs, all columns as they are, whose language is known with a probability of least or more."""
    where = docs.columns.index(text_col)
    fine = np.array([accepted is None or accepted(x) for x in model.languages] + [False])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            best, score = model.predict(batch.column(where))
            yield batch.filter(pa.array(fine[best] & (score >= least)))

    return docs.transform(in_arrow, run, docs.schema)
