"""Texts with placeholders: by value (in sequence or in one pass) and by spans.

By value, entries apply to a text longest first, each in any case and wherever it stands, earlier placeholders
included. Which entries can apply is found first by one scan for all of them, so that a large mapping costs a text
only what occurs in it; entries that occur within placeholders always remain candidates, so the result is the same as
with all entries. The index for this scan (``entries``) is made once and sent to the tasks. The entries are broadcast while they are few (``limit``); beyond that the scan is a join of the
text's words with the entries' first words, and each text gets the entries found for it.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, functions as F

from umbra.functions import naming
from umbra.functions.matching import replace_all
from umbra.operators.entries import Packed, bytes_of, encoded, index_of, low
from umbra.operators.mapping import key_of

LIMIT = 200_000


def ordered(mapping: DataFrame) -> list[tuple[str, str]]:
    """(original, placeholder), longest first, then in order of numbering; the caller has checked the size."""
    rows = mapping.where("original <> ''").select("original", "placeholder").toArrow()
    return sorted(zip(rows["original"].to_pylist(), rows["placeholder"].to_pylist()), key=lambda e: (-len(e[0]), e[1], e[0]))


def apply(texts: DataFrame, mapping: DataFrame, text: str = "text", into: str = "cleaned", mode: str = "sequential", limit: int = LIMIT) -> DataFrame:
    """texts with column ``into``; mode single_pass never looks into what it has put in."""
    if mapping.limit(limit + 1).count() > limit:
        return _apply_joined(texts, mapping, text, into, mode)
    entries = ordered(mapping)
    if not entries:
        return texts.withColumn(into, F.col(text))

    put = Replacer(entries, mode)

    @F.arrow_udf("string")
    def cleaned(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in batches:
            changed = [put(t) if t else None for t in bytes_of(batch)]
            at = [k for k, t in enumerate(changed) if t is not None]
            if at:
                mask = pa.array([t is not None for t in changed])
                batch = pc.replace_with_mask(batch, mask, pa.array([changed[k].decode("utf-8", "surrogatepass") for k in at], type=batch.type))
            yield batch

    return texts.withColumn(into, cleaned(F.col(text)))


def entry_blocks(mapping: DataFrame, limit: int = LIMIT) -> Iterator[list[tuple[str, str]]]:
    """All entries in their order, in blocks of at most limit; one empty block if there are none. Applied one after
    another they do what all do at once."""
    rows = mapping.where("original <> ''").select("original", "placeholder", "entity_type")
    many = rows.count()
    if many <= limit:
        yield ordered(rows)
        return
    placed = rows.orderBy(F.desc(F.length("original")), "placeholder", "original")
    for k in range(0, many, limit):
        yield [(r["original"], r["placeholder"]) for r in placed.offset(k).limit(limit).collect()]


class Replacer:
    """A function of a text, in UTF-8, to the text with entries, which are in order, applied; None if it is the same."""

    def __init__(self, entries: list[tuple[str, str]], mode: str = "sequential"):
        self.index = index_of([o for o, _ in entries])
        self.originals, self.placeholders = (Packed([encoded(e[k]) for e in entries]) for k in (0, 1))
        names = "".join(sorted({p for _, p in entries})).lower()
        self.inside = self.index.found(encoded(names)) if mode != "single_pass" else set()
        self.mode = mode

    def _entry(self, k: int) -> tuple[str, str]:
        return tuple(held[k].decode("utf-8", "surrogatepass") for held in (self.originals, self.placeholders))

    def __call__(self, data: bytes) -> bytes | None:
        found = self.index.found(low(data))
        if not found:
            return None
        t = data.decode("utf-8", "surrogatepass")
        entries = [self._entry(k) for k in sorted(found | self.inside)]
        if self.mode == "single_pass":
            by_low: dict[str, str] = {}
            for o, p in entries:
                by_low.setdefault(o.lower(), p)
            t = re.sub("|".join(re.escape(o) for o, _ in entries), lambda m: by_low.get(m.group().lower(), m.group()), t, flags=re.IGNORECASE)
        else:
            for o, p in entries:
                t = re.sub(re.escape(o), p, t, flags=re.IGNORECASE)
        return encoded(t)


def replacer(entries: list[tuple[str, str]], mode: str = "sequential"):
    """The same as a function of strings."""
    put = Replacer(entries, mode)

    def one(t: str | None) -> str | None:
        done = put(encoded(t)) if t else None
        return t if done is None else done.decode("utf-8", "surrogatepass")

    return one


def _apply_joined(texts: DataFrame, mapping: DataFrame, text: str, into: str, mode: str = "sequential") -> DataFrame:
    """For mappings too large to broadcast: candidates meet on the least three-character window of the entry.

    Shorter entries meet on themselves. Entries that occur within placeholders go to each text that has any other, as
    in apply; the driver holds these and the names of the placeholders.
    """
    mapping = mapping.where("original <> ''")
    lengths = sorted({r[0] for r in mapping.select(F.least(F.length(F.col("original")), F.lit(3))).distinct().collect()} | {3})
    names = "".join(sorted({r["placeholder"] for r in mapping.select("placeholder").distinct().collect()})).lower()
    signs = set(names)

    @F.pandas_udf("array<string>")
    def windows(values: pd.Series) -> pd.Series:
        return values.map(lambda v: sorted({v[k : k + n] for v in (v.lower(),) for n in lengths for k in range(len(v) - n + 1)}), na_action="ignore")

    @F.pandas_udf("string")
    def least(values: pd.Series) -> pd.Series:
        return values.map(lambda v: min(v[k : k + 3] for v in (v.lower(),) for k in range(max(len(v) - 2, 1))))

    @F.pandas_udf("boolean")
    def within(values: pd.Series) -> pd.Series:
        return values.map(lambda v: set(v.lower()) <= signs and v.lower() in names)

    inside = ordered(mapping.select("original", "placeholder", "entity_type").where(within("original"))) if mode != "single_pass" else []

    @F.pandas_udf("string")
    def cleaned(values: pd.Series, near: pd.Series) -> pd.Series:
        def one(t, entries):
            if t is None or entries is None:
                return t
            low = t.lower()
            found = {(e["original"], e["placeholder"]) for e in entries if e["original"].lower() in low}
            if not found:
                return t
            order = lambda e: (-len(e[0]), e[1], e[0])
            if mode == "single_pass":
                by_low: dict[str, str] = {}
                for o, p in sorted(found, key=order):
                    by_low.setdefault(o.lower(), p)
                return re.sub("|".join(re.escape(o) for o, _ in sorted(found, key=order)), lambda m: by_low.get(m.group().lower(), m.group()), t, flags=re.IGNORECASE)
            for o, p in sorted(found | set(inside), key=order):
                t = re.sub(re.escape(o), p, t, flags=re.IGNORECASE)
            return t

        return pd.Series([one(t, e) for t, e in zip(values, near)], dtype=object)

    keyed = texts.withColumn("__row", F.sha2(F.encode(F.col(text), "UTF-8"), 256))  # equal texts have equal entries
    asked = keyed.select("__row", F.explode(windows(F.col(text))).alias("gram")).distinct()
    entries = mapping.select("original", "placeholder", least("original").alias("gram"))
    near = asked.join(entries, "gram").groupBy("__row").agg(F.collect_set(F.struct("placeholder", "original")).alias("entries"))
    joined = keyed.join(near, "__row", "left")
    return joined.withColumn(into, cleaned(F.col(text), F.col("entries"))).drop("__row", "entries")


def columns_only(text: Column, entries: list[tuple[str, str]]) -> Column:
    """The same as an expression, for a few entries."""
    if not entries:
        return text
    return replace_all(text, F.array(*[F.struct(F.lit(o).alias("original"), F.lit(p).alias("placeholder")) for o, p in entries]))


# spans


def span_values(spans: DataFrame, texts: DataFrame, path: str = "path", text: str = "text") -> DataFrame:
    """Spans (path, start, stop, entity_type, source) of texts with their values, numbered from the last to the first.

    Spans out of bounds, and blank ones, are left out. Spans of a text must not overlap.
    """
    joined = spans.join(texts.select(F.col(path).alias("path"), F.col(text).alias("text")), "path")
    value = F.substring("text", F.col("start") + 1, F.col("stop") - F.col("start"))
    return joined.where((F.col("start") < F.length("text")) & (F.col("stop") <= F.length("text"))).select("path", "start", "stop", "entity_type", "source", value.alias("value"), (-F.col("start")).alias("ord")).where(naming.strip(F.col("value")) != "")


def replace_spans(texts: DataFrame, valued: DataFrame, mapping: DataFrame, path: str = "path", text: str = "text", into: str = "cleaned", keep_blanks: bool = False) -> DataFrame:
    """texts with the spans' values replaced; keep_blanks leaves the white space at a value's ends in place."""
    named = valued.withColumn("key", key_of(F.col("value"))).join(mapping.select("key", "placeholder"), "key")
    put = F.col("placeholder")
    if keep_blanks:
        put = F.concat(F.regexp_extract("value", r"(?U)^\s*", 0), put, F.regexp_extract("value", r"(?U)\s*$", 0))
    listed = named.groupBy("path").agg(F.sort_array(F.collect_list(F.struct("start", "stop", put.alias("put"))), asc=False).alias("spans"))
    joined = texts.join(listed.withColumnRenamed("path", "__path"), F.col(path) == F.col("__path"), "left")
    done = F.aggregate("spans", F.col(text), lambda t, s: F.concat(F.substring(t, F.lit(1), s["start"]), s["put"], F.substring(t, s["stop"] + 1, F.length(t))))
    return joined.withColumn(into, F.coalesce(done, F.col(text))).drop("__path", "spans")


def clean_texts(texts: DataFrame, mapping: DataFrame, spans: DataFrame | None = None, path: str = "path", text: str = "text", into: str = "cleaned") -> DataFrame:
    """By spans where a text has some, by values elsewhere."""
    by_value = apply(texts, mapping, text, into)
    if spans is None:
        return by_value
    has = spans.select("path").distinct().withColumnRenamed("path", path)
    first = replace_spans(texts.join(has, path, "left_semi"), span_values(spans, texts, path, text), mapping, path, text, into)
    return first.unionByName(by_value.join(has, path, "left_anti"))
