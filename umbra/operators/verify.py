"""Checks of cleaned texts: leaks, re-scan, legibility, consistency; and their reports."""

from __future__ import annotations

import re
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from umbra.functions import lexicon as lx, naming
from umbra.functions.matching import leak_context
from umbra.operators import detect, mapping as mp
from umbra.operators.entries import Packed, bytes_of, encoded, index_of, low
from umbra.operators.replace import LIMIT, ordered
from umbra.session import kept

HIT = "check_name string, file_path string, entity_type string, original string, context string"
BINARY = [".pdf", ".jpg", ".jpeg", ".png", ".gif", ".bmp", ".tiff", ".tif", ".webp", ".mp3", ".wav", ".mp4", ".mov", ".avi", ".zip", ".xlsx", ".xls", ".docx", ".doc", ".pptx", ".ppt"]


def is_text_file(path: Column) -> Column:
    return ~F.lower(naming.suffix(path)).isin(BINARY)


def _blocks(mapping: DataFrame, limit: int) -> list[DataFrame]:
    """mapping, or parts of about half the limit if it has more entries than that."""
    if mapping.limit(limit + 1).count() <= limit:
        return [mapping]
    many = -(-2 * mapping.count() // limit)
    return [mapping.where(F.pmod(F.xxhash64("original"), F.lit(many)) == k) for k in range(many)]


class Finder:
    """A function of a text, in UTF-8, to (original, its kind, matches) for each original of two characters or more that
    it holds."""

    def __init__(self, mapping: DataFrame):
        rows = mapping.where("original <> ''").select("original", "placeholder", "entity_type").toArrow()
        kinds = dict(zip(rows["original"].to_pylist(), rows["entity_type"].to_pylist()))
        entries = [o for o, _ in ordered(mapping) if len(o) >= 2]
        self.index = index_of(entries)
        self.originals = Packed([encoded(o) for o in entries])
        self.names = sorted(set(kinds.values()))
        self.kinds = np.array([self.names.index(kinds[o]) for o in entries], dtype=np.int32)

    def __call__(self, data: bytes | None):
        found = sorted(self.index.found(low(data))) if data else []
        t = data.decode("utf-8", "surrogatepass") if found else ""
        for k in found:
            original = self.originals[k].decode("utf-8", "surrogatepass")
            yield original, self.names[self.kinds[k]], re.finditer(re.escape(original), t, re.IGNORECASE)


def leaks(texts: DataFrame, mapping: DataFrame, path: str = "path", text: str = "text", limit: int = LIMIT) -> DataFrame:
    """Each place where an original of two characters or more is left, in any case, as HIT with start.

    A mapping over the limit is checked in blocks of about half of it, all texts against each.
    """
    return reduce(DataFrame.unionByName, [_leaks_of(texts, b, path, text) for b in _blocks(mapping, limit)])


def leak_counts(texts: DataFrame, mapping: DataFrame, text: str = "text", into: str = "leaks", limit: int = LIMIT) -> DataFrame:
    """texts with the number of their leaks, counted where the texts are, without a join."""
    total = reduce(lambda a, b: a + b, [_counted(Finder(block))(F.col(text)) for block in _blocks(mapping, limit)])
    return texts.withColumn(into, total)


def _counted(find: Finder):
    @F.arrow_udf("long")
    def counted(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in batches:
            yield pa.array([sum(sum(1 for _ in places) for *_, places in find(t)) for t in bytes_of(batch)], type=pa.int64())

    return counted


def _places(find: Finder):
    arrow = pa.list_(pa.struct([("original", pa.string()), ("entity_type", pa.string()), ("start", pa.int32()), ("stop", pa.int32())]))

    @F.arrow_udf("array<struct<original:string,entity_type:string,start:int,stop:int>>")
    def found(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in batches:
            yield pa.array([[{"original": o, "entity_type": kind, "start": m.start(), "stop": m.end()} for o, kind, places in find(t) for m in places] for t in bytes_of(batch)], type=arrow)

    return found


def _leaks_of(texts: DataFrame, mapping: DataFrame, path: str, text: str) -> DataFrame:
    rows = texts.select(F.col(path).cast("string").alias("file_path"), F.col(text).alias("text")).where("text is not null")
    hits = rows.select("file_path", "text", F.explode(_places(Finder(mapping))(F.col("text"))).alias("h"))
    return hits.select(F.lit("leakage").alias("check_name"), "file_path", "h.entity_type", "h.original", leak_context(F.col("text"), F.col("h.start"), F.col("h.stop")).alias("context"), "h.start")


def without_placeholders(text: Column) -> Column:
    return F.regexp_replace(text, lx.PLACEHOLDER, "[REDACTED]")


def rescan(texts: DataFrame, mapping: DataFrame, path: str = "path", text: str = "text") -> DataFrame:
    """Known entities that the detectors find again in cleaned texts."""
    plain = texts.select(F.col(path).cast("string").alias("path"), without_placeholders(F.col(text)).alias("text"))
    found = mp.has_entity(detect.entities_in_texts(plain), mapping)
    return found.select(F.lit("rescan").alias("check_name"), F.col("source").alias("file_path"), "entity_type", F.col("value").alias("original"), "context")


def legible(path: Column, content: Column) -> Column:
    """By kind: PDF and images by their first bytes, other binary files if not empty, texts if not empty and UTF-8."""
    kind = F.lower(naming.suffix(path))
    head = F.hex(F.substring(content, 1, 12))
    image = head.startswith("FFD8FF") | head.startswith("89504E47") | head.startswith("47494638") | head.startswith("424D") | head.startswith("49492A00") | head.startswith("4D4D002A")
    return F.when(kind == ".pdf", head.startswith("25504446")).when(kind.isin(".jpg", ".jpeg", ".png", ".gif", ".bmp", ".tiff"), image).when(kind.isin(BINARY), F.octet_length(content) > 0).otherwise((F.octet_length(content) > 0) & F.is_valid_utf8(content.cast("string")))


def illegible(files: DataFrame, path: str = "path", content: str = "content") -> DataFrame:
    rows = files.select(F.col(path).cast("string").alias("p"), F.coalesce(F.col(content), F.lit(b"")).alias("c"))
    return rows.where(~legible(F.col("p"), F.col("c"))).select(F.lit("legibility").alias("check_name"), F.col("p").alias("file_path"), F.lit("unknown").alias("entity_type"), F.lit("file not readable").alias("original"), F.lit("").alias("context"))


def placeholder_files(texts: DataFrame, path: str = "path", text: str = "text") -> DataFrame:
    """(placeholder, files, uses) of all placeholders in texts."""
    rows = texts.select(F.col(path).alias("path"), F.explode(F.regexp_extract_all(F.col(text), F.lit(lx.PLACEHOLDER), F.lit(0))).alias("placeholder"))
    return rows.groupBy("placeholder", "path").agg(F.count("*").alias("n")).groupBy("placeholder").agg(F.count("*").alias("files"), F.sum("n").alias("uses"))


def unknown_placeholders(texts: DataFrame, mapping: DataFrame, path: str = "path", text: str = "text") -> DataFrame:
    found = texts.select(F.col(path).cast("string").alias("file_path"), F.explode(F.array_distinct(F.regexp_extract_all(F.col(text), F.lit(lx.STRICT_PLACEHOLDER), F.lit(0)))).alias("placeholder"))
    return found.join(mapping.select("placeholder"), "placeholder", "left_anti").select(F.lit("consistency").alias("check_name"), "file_path", F.lit("placeholder").alias("entity_type"), F.col("placeholder").alias("original"), F.lit("").alias("context"))


def verify(texts: DataFrame, mapping: DataFrame, path: str = "path", text: str = "text", limit: int = LIMIT) -> tuple[DataFrame, DataFrame]:
    """(hits, report): all hits, and for each check whether it passed and how many hits it has.

    The checks that leaks, rescan, illegible and unknown_placeholders make one by one, in one pass over the texts, whose
    columns may be costly; what is found is then looked up in the mapping by one join.
    """
    hit = "array<struct<check_name:string,entity_type:string,original:string,context:string>>"
    none = F.expr(f"cast(array() as {hit})")

    def hits_of(found: Column, check: str, kind, original, context=lambda h: F.lit("")) -> Column:
        made = F.transform(found, lambda h: F.struct(F.lit(check).alias("check_name"), kind(h).alias("entity_type"), original(h).alias("original"), context(h).alias("context")))
        return F.coalesce(made.cast(hit), none)

    t = F.col("text")
    rows = texts.select(F.col(path).cast("string").alias("file_path"), F.col(text).alias("text"))
    blocks = [_places(Finder(b))(t).alias(f"leaks_{k}") for k, b in enumerate(_blocks(mapping, limit))]
    rows = rows.select("file_path", "text", without_placeholders(t).alias("plain"), *blocks)
    parts = [hits_of(F.col(f"leaks_{k}"), "leakage", lambda h: h["entity_type"], lambda h: h["original"], lambda h: leak_context(t, h["start"], h["stop"])) for k in range(len(blocks))]
    parts.append(hits_of(detect.entity_array(F.col("plain"), (0.7, 0.6, 0.5)), "rescan", lambda e: e["entity_type"], lambda e: e["value"]))
    readable = legible(F.col("file_path"), F.coalesce(F.encode(t, "UTF-8"), F.lit(b"")))
    parts.append(F.when(~readable, hits_of(F.array(F.lit("file not readable")), "legibility", lambda h: F.lit("unknown"), lambda h: h)).otherwise(none))
    parts.append(hits_of(F.array_distinct(F.regexp_extract_all(t, F.lit(lx.STRICT_PLACEHOLDER), F.lit(0))), "consistency", lambda h: F.lit("placeholder"), lambda h: h))
    found = rows.select("file_path", F.explode(F.concat(*parts)).alias("h")).select("h.check_name", "file_path", "h.entity_type", "h.original", "h.context")
    asked = F.when(F.col("check_name") == "rescan", mp.key_of(F.col("original"))).when(F.col("check_name") == "consistency", F.col("original")).otherwise(F.col("file_path"))
    known = mapping.select(F.lit("rescan").alias("of"), F.col("key").alias("at")).union(mapping.select(F.lit("consistency"), "placeholder")).distinct().withColumn("known", F.lit(True))
    joined = found.withColumn("asked", asked).join(known, (F.col("check_name") == F.col("of")) & (F.col("asked") == F.col("at")), "left")
    has = F.col("known").isNotNull()
    hits = joined.where(F.when(F.col("check_name") == "rescan", has).when(F.col("check_name") == "consistency", ~has).otherwise(True)).select("check_name", "file_path", "entity_type", "original", "context")
    return hits, report(hits)


def report(hits: DataFrame, checks: tuple[str, ...] = ("leakage", "rescan", "legibility", "consistency")) -> DataFrame:
    names = hits.sparkSession.createDataFrame([(k, c) for k, c in enumerate(checks)], "check_ord int, check_name string")
    counts = hits.groupBy("check_name").agg(F.count("*").alias("hits"), F.countDistinct("file_path").alias("files"))
    return names.join(counts, "check_name", "left").select("check_ord", "check_name", F.coalesce("hits", F.lit(0)).alias("hits"), F.coalesce("files", F.lit(0)).alias("files"), F.col("hits").isNull().alias("passed"))


def all_passed(report: DataFrame) -> DataFrame:
    return report.agg(F.coalesce(F.bool_and("passed"), F.lit(True)).alias("all_passed"))


def failed(report: DataFrame) -> DataFrame:
    return report.where(~F.col("passed"))


def by_type_and_file(hits: DataFrame) -> DataFrame:
    """Counts in all (level total), by entity type and by file; hits are computed once."""
    counts = kept(hits.groupBy("entity_type", "file_path").agg(F.count("*").alias("n")))
    many = F.sum("n").alias("hits")
    total = counts.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("hits")).select(F.lit("total").alias("level"), F.lit("").alias("name"), "hits")
    kinds = counts.groupBy("entity_type").agg(many).select(F.lit("type").alias("level"), F.col("entity_type").alias("name"), "hits")
    files = counts.groupBy("file_path").agg(many).select(F.lit("file").alias("level"), F.col("file_path").alias("name"), "hits")
    return total.unionByName(kinds).unionByName(files)
