"""Detectors compared: precision and recall, overlaps, and answers of language models."""

from __future__ import annotations

import itertools
import json
import time
from functools import reduce

import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F, types as T

from umbra.session import kept


def values_of(entities: DataFrame, kind: str) -> DataFrame:
    return entities.where(F.col("entity_type") == kind).select(F.lower("value").alias("value")).distinct()


def accuracy(truth: DataFrame, predicted: DataFrame, value: str = "value") -> DataFrame:
    """Precision, recall and F1 of two sets of values; 0 where there is nothing to divide by."""
    both = truth.select(F.col(value).alias("v"), F.lit(1).alias("t")).distinct().join(predicted.select(F.col(value).alias("v"), F.lit(1).alias("p")).distinct(), "v", "full_outer")
    counts = both.agg(F.count_if(F.col("t").isNotNull() & F.col("p").isNotNull()).alias("hits"), F.count("t").alias("truth"), F.count("p").alias("predicted"))
    share = lambda a, b: F.coalesce(F.try_divide(a, b), F.lit(0.0))
    rated = counts.withColumn("precision", share(F.col("hits"), F.col("predicted"))).withColumn("recall", share(F.col("hits"), F.col("truth")))
    return rated.withColumn("f1", share(2 * F.col("hits"), F.col("truth") + F.col("predicted")))


def overlap(a: DataFrame, b: DataFrame) -> DataFrame:
    """(value, side): both if a value is in, or contains, a value of the other set; only_a or only_b otherwise.

    A pair that contains one another counts with both its values. Candidates meet on three-character windows; the
    shorter value is found by its first one.
    """
    gram = lambda c: F.substring(c, 1, 3)
    grams = lambda c: F.array_distinct(F.flatten(F.transform(F.sequence(F.lit(1), F.greatest(F.length(c), F.lit(1))), lambda k: F.transform(F.sequence(F.lit(1), F.lit(3)), lambda n: F.substring(c, k, n)))))
    left, right = (x.select(F.col("value").alias("v")).distinct().where("v is not null") for x in (a, b))

    def within(small: DataFrame, large: DataFrame) -> DataFrame:
        s = small.select(F.col("v").alias("s"), gram(F.col("v")).alias("g"))
        t = large.select(F.col("v").alias("t"), F.explode(F.concat(grams(F.col("v")), F.array(F.lit("")))).alias("g"))
        return s.join(t, "g").where(F.contains("t", F.col("s"))).select("s", "t").distinct()

    ab, ba = within(left, right), within(right, left)
    met_a = ab.select(F.col("s").alias("v")).union(ba.select("t")).distinct()
    met_b = ab.select(F.col("t").alias("v")).union(ba.select("s")).distinct()
    both = met_a.union(met_b).distinct()
    return both.select(F.col("v").alias("value"), F.lit("both").alias("side")).union(left.join(both, "v", "left_anti").select("v", F.lit("only_a"))).union(right.join(both, "v", "left_anti").select("v", F.lit("only_b")))


def truncated(text: Column, most: int = 4000) -> Column:
    return F.when(F.length(text) > most, F.concat(F.substring(text, 1, most), F.lit("\n... (truncated)"))).otherwise(text)


def entity_label(kind: Column) -> Column:
    low = F.lower(kind)
    return F.when(low.isin("organization", "org"), "company").otherwise(low)


def model_entities(answers: DataFrame, source: str = "source", answer: str = "answer") -> DataFrame:
    """Entities (entity_type, value, source, confidence) that answers of a language model list."""
    rows = answers.select(F.col(source).alias("source"), F.explode(salvaged(F.col(answer))).alias("e"))
    value = F.trim(F.col("e.value"))
    return rows.select(entity_label(F.col("e.type")).alias("entity_type"), value.alias("value"), "source", F.lit(0.9).alias("confidence")).where("value <> ''")


@F.pandas_udf(T.ArrayType(T.StructType([T.StructField("type", T.StringType()), T.StructField("value", T.StringType())])))
def salvaged(answers: pd.Series) -> pd.Series:
    """What can be read from an answer in free text: the JSON list of entities that begins last, or else the entities of
    the last JSON object that has such a list. What stands around, and JSON that is broken, is passed over."""
    decode = json.JSONDecoder().raw_decode

    def values(text: str, opening: str):
        """The JSON values that begin with opening, the last one first."""
        at = text.rfind(opening)
        while at >= 0:
            try:
                yield decode(text, at)[0]
            except (ValueError, RecursionError):
                pass
            at = text.rfind(opening, 0, at)

    def one(text: str | None) -> list[dict]:
        lists = (v for v in values(text or "", "[") if v and isinstance(v[0], dict) and v[0].keys() >= {"type", "value"})
        held = (v["entities"] for v in values(text or "", "{") if isinstance(v.get("entities"), list))
        for found in (*itertools.islice(lists, 1), *itertools.islice(held, 1)):
            return [{"type": str(e.get("type") or ""), "value": str(e.get("value") or "")} for e in found if isinstance(e, dict)]
        return []

    return answers.map(one)


def counts_by_method(entities: DataFrame) -> DataFrame:
    """(method, entity_type, entities) of entities with a column method."""
    return entities.groupBy("method", "entity_type").agg(F.countDistinct(F.lower("value")).alias("entities"))


def compared_methods(texts: DataFrame, methods: dict) -> tuple[DataFrame, dict[str, float]]:
    """(counts by method and kind, seconds of each method) of functions from texts to entities; each runs once."""
    seconds, parts = {}, []
    for name, method in methods.items():
        began = time.perf_counter()
        parts.append(kept(method(texts).select("entity_type", "value").withColumn("method", F.lit(name))))
        seconds[name] = time.perf_counter() - began
    return counts_by_method(reduce(DataFrame.unionByName, parts)), seconds
