"""What cleaning may change and what not: structure checks, hashes, change records and diffs."""

from __future__ import annotations

import difflib

import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F, types as T

from umbra.functions import lexicon as lx


def paragraphs(text: Column) -> Column:
    """Runs of lines that are not blank."""
    state = F.aggregate(F.split(text, "\n", -1), F.struct(F.lit(0).alias("n"), F.lit(False).alias("inside")), lambda s, line: F.struct((s["n"] + F.when(line.rlike(r"(?U)\S") & ~s["inside"], 1).otherwise(0)).alias("n"), line.rlike(r"(?U)\S").alias("inside")))
    return state["n"]


def lines(text: Column) -> Column:
    return F.size(F.split(text, "\n", -1))


def headings(text: Column) -> Column:
    return F.size(F.filter(F.split(text, "\n", -1), lambda line: line.rlike(r"(?U)^#{1,6}\s+")))


def structure_preserved(original: Column, cleaned: Column, what: str = "paragraph") -> Column:
    count = {"paragraph": paragraphs, "line": lines, "heading": headings}.get(what)
    return F.lit(True) if count is None else count(original) == count(cleaned)


def rest_unchanged(original: Column, cleaned: Column, spans: Column) -> Column:
    """Whether each part of original outside spans (an array of (start, stop)) stands in cleaned."""
    ordered = F.array_sort(spans)
    stops = F.concat(F.array(F.lit(0)), F.transform(ordered, lambda s: s["stop"]))
    starts = F.concat(F.transform(ordered, lambda s: s["start"]), F.array(F.length(original)))
    gaps = F.zip_with(stops, starts, lambda a, b: F.when(b > a, F.substring(original, a + 1, b - a)).otherwise(F.lit("")))
    return F.forall(gaps, lambda g: F.contains(cleaned, g))


def placeholders_formed(cleaned: Column) -> Column:
    """Whether everything like a placeholder has capitals and three digits or more."""
    return F.forall(F.regexp_extract_all(cleaned, F.lit(r"\[\w+_\d+\]"), F.lit(0)), lambda p: p.rlike(f"^{lx.STRICT_PLACEHOLDER}$"))


def text_hash(text: Column, algorithm: str = "sha256") -> Column:
    data = F.encode(text, "UTF-8")
    return content_hash(data, algorithm)


def content_hash(content: Column, algorithm: str = "sha256") -> Column:
    if algorithm == "md5":
        return F.md5(content)
    if algorithm == "sha1":
        return F.sha1(content)
    return F.sha2(content, {"sha224": 224, "sha256": 256, "sha384": 384, "sha512": 512}[algorithm])


def changes(valued: DataFrame, mapping: DataFrame) -> DataFrame:
    """Change records (file_path, entity_type, original, placeholder, start) of what has been found in the originals."""
    from umbra.operators.mapping import key_of

    named = valued.withColumn("key", key_of(F.col("value"))).join(mapping.select("key", "placeholder"), "key")
    return named.select(F.col("path").cast("string").alias("file_path"), F.col("flag_type").alias("entity_type"), F.col("value").alias("original"), "placeholder", "start")


def file_diffs(pairs: DataFrame, changed: DataFrame, path: str = "path", original: str = "text", cleaned: str = "cleaned") -> DataFrame:
    """A row for each file: changes, hashes and sizes before and after."""
    counts = changed.groupBy("file_path").agg(F.count("*").alias("change_count"))
    size = lambda c: F.octet_length(F.encode(F.col(c), "UTF-8")).cast("long")
    rows = pairs.select(F.col(path).cast("string").alias("file_path"), text_hash(F.col(original)).alias("original_hash"), text_hash(F.col(cleaned)).alias("cleaned_hash"), size(original).alias("original_size"), size(cleaned).alias("cleaned_size"))
    return rows.join(counts, "file_path", "left").select("file_path", F.coalesce("change_count", F.lit(0)).alias("change_count"), "original_hash", "cleaned_hash", "original_size", "cleaned_size", (F.col("cleaned_size") - F.col("original_size")).alias("size_diff"))


def diff_totals(diffs: DataFrame) -> DataFrame:
    return diffs.agg(F.count("*").alias("files"), F.count_if(F.col("original_hash") != F.col("cleaned_hash")).alias("files_changed"), F.sum("change_count").alias("changes"), F.sum("size_diff").alias("size_diff"))


def changes_by_type(changed: DataFrame, per_file: bool = False) -> DataFrame:
    by = ["file_path", "entity_type"] if per_file else ["entity_type"]
    return changed.groupBy(*by).agg(F.count("*").alias("changes"))


@F.pandas_udf(T.StructType([T.StructField(c, T.IntegerType()) for c in ("original_lines", "cleaned_lines", "lines_added", "lines_removed", "line_count_change")]))
def diff_summary(original: pd.Series, cleaned: pd.Series) -> pd.DataFrame:
    """Line counts, and lines added and removed by a unified diff with two lines of context."""

    def one(a: str, b: str) -> tuple[int, int, int, int, int]:
        x, y = (a or "").split("\n"), (b or "").split("\n")
        diff = list(difflib.unified_diff(x, y, lineterm="", n=2)) if a != b else []
        added = sum(d.startswith("+") and not d.startswith("+++") for d in diff)
        removed = sum(d.startswith("-") and not d.startswith("---") for d in diff)
        return len(x), len(y), added, removed, len(y) - len(x)

    return pd.DataFrame([one(a, b) for a, b in zip(original, cleaned)], columns=["original_lines", "cleaned_lines", "lines_added", "lines_removed", "line_count_change"])
