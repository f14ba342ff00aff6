"""Entities to placeholders: one for each distinct value, numbered by kind in the order of first sight.

Occurrences are summed by key before anything is ordered, so numbering sees distinct keys only, range by range.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from umbra.functions import lexicon as lx, naming
from umbra.session import kept

COLUMNS = ["key", "original", "placeholder", "entity_type", "sources", "occurrence_count"]


def key_of(value: Column) -> Column:
    return F.lower(naming.strip(value))


def prefix_of(kind: Column) -> Column:
    known = F.create_map(*[F.lit(x) for pair in lx.PREFIXES.items() for x in pair])
    return F.coalesce(F.try_element_at(known, kind), F.lit(lx.DEFAULT_PREFIX))


def placeholder(prefix: Column, number: Column) -> Column:
    return F.format_string("[%s_%03d]", prefix, number)


def numbered(keys: DataFrame, order: list[str], by: str = "prefix") -> DataFrame:
    """keys with their numbers within ``by``, in order, from 1.

    Rows are dealt by ranges of (by, order); a task numbers one range, and what the ranges before it hold of the same
    kind is added. So no task sees all of a kind.
    """
    ranges = kept(keys.repartitionByRange(by, *order).withColumn("__part", F.spark_partition_id()))
    counts = ranges.groupBy(by, "__part").agg(F.count("*").alias("__n"))
    before = F.coalesce(F.sum("__n").over(Window.partitionBy(by).orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    local = ranges.withColumn("__local", F.row_number().over(Window.partitionBy(by, "__part").orderBy(*order)))
    starts = counts.select(by, "__part", before.alias("__before"))
    return local.join(starts, [by, "__part"]).withColumn("number", (F.col("__before") + F.col("__local")).cast("int")).drop("__part", "__local", "__before")


def source_table(seen: DataFrame, value: str = "value", source: str = "path") -> DataFrame:
    """(key, source, occurrences): where each entity is seen; a table, as a common entity may be seen anywhere."""
    rows = seen.select(key_of(F.col(value)).alias("key"), F.col(source).cast("string").alias("source")).where("key <> '' and source <> ''")
    return rows.groupBy("key", "source").agg(F.count("*").alias("occurrences"))


def build(seen: DataFrame, order: list[str], kind: str = "flag_type", value: str = "value", source: str = "path", known: DataFrame | None = None, sources: bool = True) -> DataFrame:
    """The mapping of all values of seen, in the order of its columns; known values keep their placeholders.

    The first sight decides kind and case. Kinds without a prefix of their own share one numbering. known is a mapping
    from before: its counts and sources go on. sources=False leaves the lists of sources empty, for data in which an
    entity may have very many; source_table has them as rows.
    """
    at = F.struct(*order)
    rows = seen.select(key_of(F.col(value)).alias("key"), naming.strip(F.col(value)).alias("original"), F.col(kind).alias("entity_type"), F.col(source).cast("string").alias("source"), at.alias("at")).where("key <> ''")
    if sources:
        by_source = rows.groupBy("key", "source").agg(F.count("*").alias("n"), F.min(F.struct("at", "original", "entity_type")).alias("first"))
        listed = F.transform(F.array_sort(F.collect_list(F.when(F.coalesce(F.col("source"), F.lit("")) != "", F.struct(F.col("first.at").alias("at"), "source")))), lambda s: s["source"])
        keys = by_source.groupBy("key").agg(F.min("first").alias("first"), F.sum("n").alias("occurrence_count"), listed.alias("sources"))
    else:
        keys = rows.groupBy("key").agg(F.min(F.struct("at", "original", "entity_type")).alias("first"), F.count("*").alias("occurrence_count")).withColumn("sources", F.expr("cast(array() as array<string>)"))
    keys = keys.select("key", "first.original", "first.entity_type", "sources", "occurrence_count", F.col("first.at").alias("at"), prefix_of(F.col("first.entity_type")).alias("prefix"))
    return _joined(keys, known)


def _joined(keys: DataFrame, known: DataFrame | None) -> DataFrame:
    """known gone on with by keys, in the order of at; what is new is numbered after what is known."""
    if known is None:
        return numbered(keys, ["at", "key"]).withColumn("placeholder", placeholder(F.col("prefix"), F.col("number"))).select(*COLUMNS)
    before = known.select(F.col("key"), *[F.col(c).alias(f"old_{c}") for c in COLUMNS[1:]])
    merged = keys.join(before, "key", "full_outer")
    fresh = numbered(merged.where("old_placeholder is null"), ["at", "key"]).join(counters(known), "prefix", "left")
    added = fresh.withColumn("placeholder", placeholder(F.col("prefix"), F.coalesce("counter", F.lit(0)) + F.col("number"))).select(*COLUMNS)
    empty = F.expr("cast(array() as array<string>)")
    old = merged.where("old_placeholder is not null").select(
        "key", F.col("old_original").alias("original"), F.col("old_placeholder").alias("placeholder"), F.col("old_entity_type").alias("entity_type"),
        F.array_union(F.col("old_sources"), F.coalesce("sources", empty)).alias("sources"), (F.col("old_occurrence_count") + F.coalesce("occurrence_count", F.lit(0))).alias("occurrence_count"),
    )
    return old.unionByName(added)


def counters(mapping: DataFrame) -> DataFrame:
    """(prefix, counter): the last number given out, from the placeholders."""
    number = F.regexp_extract("placeholder", r"_(\d+)\]$", 1).cast("int")
    return mapping.groupBy(F.regexp_extract("placeholder", r"^\[(.*)_\d+\]$", 1).alias("prefix")).agg(F.max(number).alias("counter"))


def summary(mapping: DataFrame) -> DataFrame:
    return mapping.groupBy("entity_type").agg(F.count("*").alias("entities"), F.sum("occurrence_count").alias("occurrences"))


def has_entity(values: DataFrame, mapping: DataFrame, value: str = "value") -> DataFrame:
    return values.withColumn("key", key_of(F.col(value))).join(mapping.select("key"), "key", "left_semi").drop("key")


def get_mapping(values: DataFrame, mapping: DataFrame, value: str = "value") -> DataFrame:
    return values.withColumn("key", key_of(F.col(value))).join(mapping, "key", "left")


def resolve(placeholders: DataFrame, mapping: DataFrame) -> DataFrame:
    return placeholders.join(mapping.select("placeholder", "original"), "placeholder", "left")


def to_json(mapping: DataFrame) -> DataFrame:
    """One row a mapping, as JSON lines; save with write.text."""
    return mapping.select(F.to_json(F.struct(*COLUMNS)).alias("value"))


def from_json(lines: DataFrame) -> DataFrame:
    schema = "key string, original string, placeholder string, entity_type string, sources array<string>, occurrence_count long"
    return lines.select(F.from_json("value", schema).alias("m")).select("m.*")


def merge(mappings: list[DataFrame]) -> DataFrame:
    """One mapping of several. The first one's placeholders stay; what a later one adds is numbered after them, in its
    own order, so that no two entities share a placeholder. Texts cleaned with a later mapping must be cleaned anew."""
    out = mappings[0]
    for m in mappings[1:]:
        at = F.struct(F.regexp_extract("placeholder", r"_(\d+)\]$", 1).cast("int").alias("number"), "key")
        out = _joined(m.select("key", "original", "entity_type", "sources", "occurrence_count", at.alias("at"), prefix_of(F.col("entity_type")).alias("prefix")), out)
    return out
