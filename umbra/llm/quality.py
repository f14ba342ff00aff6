"""Quality rules whose cutoffs follow the data: quantile sketches per language and source, then a joined filter.

A sketch counts values in buckets whose width is at most 1/32 of the value (all bits of an integer below the six
highest are cleared), so it has a bounded number of rows, and sketches merge by adding counts. Sketches of (language,
source) merge to those of the language and of everything; a group with fewer than ``min_rows`` documents takes the
fences of the next larger one. A fence lies ``reach`` quartile ranges, and a tolerance, beyond the quartile; the lower
quartile is its bucket's least value and the upper one its bucket's greatest, so the bounds are on the safe side.

Rows: a null text is an empty one; it and short texts fail the base rules. Null languages and sources are groups of
their own. Repeated rows count as often as they occur. An empty table gives no rows. Extra columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F, types as T

from umbra.llm import text as tx
from umbra.llm.shared import cut, in_arrow

SYMBOL = np.zeros(256, bool)
SYMBOL[[ord(c) for c in "#*$%&|<>"]] = True
#: name, formula over the counts, tolerance, and whether values below the lower fence fail too
METRICS = [
    ("word_length", "100 * word_chars div n_words", 100, True),
    ("symbols", "1000 * n_symbols div n_words", 50, False),
    ("dup_lines", "1000 * n_dup_lines div n_lines", 300, False),
    ("repeats", "1000 * n_repeat_words div n_words", 300, False),
]
COUNTS = ["n_words", "word_chars", "n_symbols", "n_lines", "n_dup_lines", "n_repeat_words"]


def _repeated_words(hashes: np.ndarray, width: int = 3) -> int:
    """Words that lie in a window of width words found twice or more."""
    w = tx.window_hashes(hashes, width)
    if len(w) < 2:
        return 0
    order = np.argsort(w, kind="stable")
    same = w[order][1:] == w[order][:-1]
    if not same.any():
        return 0
    twice = np.zeros(len(w), bool)
    twice[order[1:][same]] = True
    twice[order[:-1][same]] = True
    edge = np.zeros(len(hashes) + 1, np.int64)
    edge[: len(w)] += twice
    edge[width : width + len(w)] -= twice
    return int((np.cumsum(edge)[:-1] > 0).sum())


def _lines(w: tx.Words) -> tuple[np.ndarray, np.ndarray]:
    """Lines with a word of each text, and how many of them are equal to an earlier one."""
    breaks = np.flatnonzero(w.data == 10)
    low = np.searchsorted(breaks, w.text_start)
    many = np.searchsorted(breaks, w.text_end) - low
    cuts = breaks[np.arange(int(many.sum())) - np.repeat(np.cumsum(many) - many - low, many)]
    first = np.cumsum(many + 1) - many - 1
    start, end = np.empty((2, int((many + 1).sum())), np.int64)
    opens, closes = np.zeros((2, len(start)), bool)
    opens[first] = closes[first + many] = True
    start[opens], start[~opens] = w.text_start, cuts + 1
    end[closes], end[~closes] = w.text_end, cuts
    text = np.repeat(np.arange(len(many)), many + 1)
    full = np.searchsorted(w.start, end) > np.searchsorted(w.start, start)
    text, hashes = text[full], w.hashes(start[full], end[full])
    order = np.lexsort((hashes, text))
    same = (hashes[order][1:] == hashes[order][:-1]) & (text[order][1:] == text[order][:-1])
    return np.bincount(text, minlength=len(many)), np.bincount(text[order][1:][same], minlength=len(many))


def _counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(id, lang, source, text) to (id, lang, source, counts)."""
    for batch in batches:
        column = batch.column(3)
        raw, starts, ends = tx.string_bytes(column.fill_null("") if column.null_count else column)
        out = np.zeros((len(COUNTS), batch.num_rows), np.int64)
        for i, j in tx.chunks(starts, ends):
            w = tx.Words(raw, starts[i:j], ends[i:j])
            data, hashes = w.data, w.word_hashes()
            n = len(data)

            def total(flags: np.ndarray) -> np.ndarray:
                t = np.zeros(n + 1, np.int64)
                np.cumsum(flags, out=t[1:])
                return t[w.text_end] - t[w.text_start]

            out[0, i:j] = w.count
            out[1, i:j] = total(((data & 0xC0) != 0x80) & ~tx.SPACE[data])
            out[2, i:j] = total(SYMBOL[data])
            out[3, i:j], out[4, i:j] = _lines(w)
            for k in range(j - i):
                f = int(w.first[k])
                out[5, i + k] = _repeated_words(hashes[f : f + int(w.count[k])])
        yield pa.RecordBatch.from_arrays([*batch.columns[:3], *map(pa.array, out)], ["id", "lang", "source", *COUNTS])


def counts(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", source_col: str = "source") -> DataFrame:
    source = docs.select(F.col(id_col).alias("id"), F.col(lang_col).alias("lang"), F.col(source_col).alias("source"), F.col(text_col).alias("text"))
    return source.transform(in_arrow, _counts, T.StructType([*source.schema.fields[:3], *(T.StructField(c, T.LongType()) for c in COUNTS)]))


def base_failed() -> Column:
    return (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))


def sketch(values: DataFrame, keys: list[str], value: str) -> DataFrame:
    """(keys, low, n): the mergeable sketch of value, an integer of 0 or more, for each of keys."""
    spare = F.expr(f"greatest(0, length(bin({value})) - 6)")
    return values.withColumn("spare", spare).withColumn("low", F.expr(f"shiftleft(shiftright({value}, spare), spare)")).groupBy(*keys, "low").agg(F.count("*").alias("n"))


def fences(sketches: DataFrame, min_rows: int, reach: float) -> DataFrame:
    """(lang, source, metric, floor, ceiling) of every language and source, from their own or a larger group."""
    sets = [["lang", "source", "metric", "low"], ["lang", "metric", "low"], ["metric", "low"]]
    merged = None
    for level, by in enumerate(sets):
        part = sketches.groupBy(*by).agg(F.sum("n").alias("n")).select(F.lit(level).alias("level"), *[F.col(c) if c in by else F.lit(None).cast("string").alias(c) for c in ("lang", "source")], "metric", "low", "n")
        merged = part if merged is None else merged.unionByName(part)
    group = ["level", "lang", "source", "metric"]
    w = Window.partitionBy(*group)
    ranked = merged.withColumn("upto", F.sum("n").over(w.orderBy("low"))).withColumn("all", F.sum("n").over(w))
    quartiles = ranked.groupBy(*group).agg(F.first("all").alias("rows"), *[F.min(F.when(F.col("upto") * 100 >= F.col("all") * q, F.expr(bound))).alias(f"q{q}") for q, bound in ((25, "low"), (75, "low + shiftleft(1L, greatest(0, length(bin(low)) - 6)) - 1"))])
    wide = F.lit(reach) * (F.col("q75") - F.col("q25"))
    tolerance = F.create_map(*[F.lit(x) for name, _, t, _ in METRICS for x in (name, t)])[F.col("metric")]
    fenced = quartiles.select(*group, "rows", (F.col("q25") - wide - tolerance).alias("floor"), (F.col("q75") + wide + tolerance).alias("ceiling"))
    own = fenced.where("level = 0").alias("o")
    lang = fenced.where("level = 1").alias("l")
    top = fenced.where("level = 2").alias("t")
    joined = own.join(lang, F.col("o.lang").eqNullSafe(F.col("l.lang")) & (F.col("o.metric") == F.col("l.metric"))).join(top, F.col("o.metric") == F.col("t.metric"))

    def pick(c: str) -> Column:
        return F.when(F.col("o.rows") >= min_rows, F.col(f"o.{c}")).when(F.col("l.rows") >= min_rows, F.col(f"l.{c}")).otherwise(F.col(f"t.{c}"))

    return joined.select("o.lang", "o.source", "o.metric", pick("floor").alias("floor"), pick("ceiling").alias("ceiling"))


def judge(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", source_col: str = "source", min_rows: int = 200, reach: float = 6.0) -> DataFrame:
    """(id_col, counts, base_failed, kept) of every row, and its lines with a word and each metric's value."""
    found = cut(counts(docs, id_col, text_col, lang_col, source_col))
    values = found.select("*", *[F.expr(f"case when n_words > 0 then {formula} end").alias(name) for name, formula, *_ in METRICS])
    good = values.where((F.col("n_words") > 0) & ~base_failed())
    long = good.select(F.col("lang").cast("string"), F.col("source").cast("string"), F.explode(F.array(*[F.struct(F.lit(name).alias("metric"), F.col(name).alias("value")) for name, *_ in METRICS])).alias("m")).select("lang", "source", "m.*")
    limits = fences(sketch(long, ["lang", "source", "metric"], "value"), min_rows, reach)
    wide = limits.groupBy("lang", "source").agg(*[F.max(F.when(F.col("metric") == name, F.struct("floor", "ceiling"))).alias(f"limit_{name}") for name, *_ in METRICS])
    limit = wide.select(F.col("lang").alias("of_lang"), F.col("source").alias("of_source"), *[f"limit_{name}" for name, *_ in METRICS])
    both = values.join(limit, values["lang"].cast("string").eqNullSafe(limit["of_lang"]) & values["source"].cast("string").eqNullSafe(limit["of_source"]), "left")
    fine = F.lit(True)
    for name, _, _, two_sided in METRICS:
        fine = fine & (F.col(name) <= F.col(f"limit_{name}.ceiling"))
        if two_sided:
            fine = fine & (F.col(name) >= F.col(f"limit_{name}.floor"))
    first = [c for c in COUNTS if c != "n_lines"]
    return both.select(F.col("id").alias(id_col), *first, base_failed().alias("base_failed"), (~base_failed() & F.coalesce(fine, F.lit(False))).alias("kept"), "n_lines", *[name for name, *_ in METRICS])
