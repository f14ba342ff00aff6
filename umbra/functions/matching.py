"""Regular-expression matches with their places, contexts, and literal replacement."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

META = r"([\\.\[\]{}()*+\-?^$|#&~\s])"


def matches(text: Column, pattern: str, group: int = 0, need: Column | None = None) -> Column:
    """ARRAY<STRUCT<ord, start, stop, value>> of all matches; offsets are code points; the pattern can't match nothing.

    A match's start is the length of all text between matches before it, and of the matches. need: a cheap condition
    without which a text has no match; the pattern is not tried on the others.
    """
    found = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    parts = F.struct(found.alias("whole"), F.split(text, pattern, -1).alias("between"), (F.regexp_extract_all(text, F.lit(pattern), F.lit(group)) if group else found).alias("value"))
    zero = F.struct(F.lit(0).cast("int").alias("at"), F.expr("cast(array() as array<struct<ord:int,start:int,stop:int,value:string>>)").alias("out"))

    def places(p: Column) -> Column:
        def step(state: Column, k: Column) -> Column:
            start = state["at"] + F.length(F.get(p["between"], k))
            stop = start + F.length(F.get(p["whole"], k))
            return F.struct(stop.alias("at"), F.array_append(state["out"], F.struct(k.alias("ord"), start.alias("start"), stop.alias("stop"), F.get(p["value"], k).alias("value"))).alias("out"))

        return F.aggregate(F.sequence(F.lit(0), F.size(p["whole"]) - 1), zero, step, lambda s: s["out"])

    some = F.regexp_like(text, F.lit(pattern))
    return F.when(some if need is None else need & some, let(parts, places))


def beginning(pattern: str, words: str) -> str:
    """pattern, which begins with one of words (a|b|...), tried only where a first letter of these stands."""
    return f"(?=[{''.join(sorted({w[0] for w in words.split('|')}))}]){pattern}"


def let(value: Column, body) -> Column:
    """body(value), with value computed once: what stands in a lambda is computed for each element."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def context(text: Column, start: Column, window: int = 50) -> Column:
    """What stands around a match's start, on one line, with dots where it is cut."""
    low, high = F.greatest(F.lit(0), start - window), F.least(F.length(text), start + window)
    middle = F.regexp_replace(F.translate(F.substring(text, low + 1, high - low), "\n", " "), r"(?U)^\s+|\s+$", "")
    return F.concat(F.when(low > 0, "...").otherwise(""), middle, F.when(high < F.length(text), "...").otherwise(""))


def leak_context(text: Column, start: Column, stop: Column, window: int = 30) -> Column:
    low, high = F.greatest(F.lit(0), start - window), F.least(F.length(text), stop + window)
    return F.translate(F.substring(text, low + 1, high - low), "\n", " ")


def quoted(value: Column) -> Column:
    """A pattern that matches value as it stands."""
    return F.regexp_replace(value, META, r"\\$1")


def replace_all(text: Column, entries: Column) -> Column:
    """Entries (original, placeholder) one after another, each wherever it stands, in any case."""
    return F.aggregate(entries, text, lambda t, e: F.when(F.contains(F.lower(t), F.lower(e["original"])), F.regexp_replace(t, F.concat(F.lit("(?iu)"), quoted(e["original"])), e["placeholder"])).otherwise(t))
