"""Detectors: text or names to rows of what is sensitive in them.

Every detector is a projection to an array of structs, so one pass over a text yields all its flags; nothing is
shuffled. Order columns (phase, path, detector_ord, pattern_ord, match_ord) say in which order flags count as found.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, Window, functions as F

from umbra.functions import lexicon as lx, naming
from umbra.functions.matching import beginning, context, let, matches

FLAG = "array<struct<detector_ord:int,pattern_ord:int,match_ord:int,flag_type:string,value:string,start:int,confidence:double>>"
ORDER = ["phase", "path", "detector_ord", "pattern_ord", "match_ord"]
#: E-mail addresses, begun only where a run of their characters does or the last match ended, so that a long word is read
#: once; patterns that begin with fixed words, tried only at their first letters.
EMAIL = r"(?U)(?:\G|(?<![\w.-]))" + lx.EMAIL.removeprefix("(?U)").replace("+@", "++@")
TITLED_PERSON = beginning(lx.TITLED_PERSON, lx.TITLES)
LOCATIONS = [beginning(p, w) for p, w in zip(lx.LOCATIONS, [lx.US_STATES, lx.COUNTRIES])] + lx.LOCATIONS[2:]
HAN = "[\u4e00-\u9fff]"  # what the patterns for Chinese texts need
PERSON_PATTERNS = [beginning(lx.PERSON_PATTERNS[0], "Mr|Dr|Prof|CEO|VP|Engineer"), *lx.PERSON_PATTERNS[1:]]
PRODUCT_NEEDS = [r"(?iuU)mod|mdl", r"(?iuU)part|p/n|pn", r"(?iuU)serial|s/n|sn", r"(?iuU)\sv\d"]  # a part of any match
#: Runs of words, and in them the last keyword with words before it: linear where one pattern for both is not.
RUN = r"(?U)[A-Za-z]{2,}+(?:\s++[A-Za-z]{2,}+)++\.?"
WHOLE_RUN = r"(?U)\b[A-Za-z]{2,}+(?!\w)(?:\s++[A-Za-z]{2,}+(?!\w))++"


def _flag(found: Column, detector: int, pattern: int, kind: str, confidence: float, value=lambda m: m["value"]) -> Column:
    made = F.transform(found, lambda m: F.struct(F.lit(detector).alias("detector_ord"), F.lit(pattern).alias("pattern_ord"), m["ord"].alias("match_ord"), F.lit(kind).alias("flag_type"), value(m).alias("value"), m["start"].alias("start"), F.lit(confidence).alias("confidence")))
    return F.coalesce(made, F.expr(f"cast(array() as {FLAG})"))


def _words(value: Column) -> Column:
    return F.size(F.split(value, r"(?U)\s+"))


def _keyword_hits(run: Column, keywords: list[str], tail: str, most: int) -> Column:
    """ARRAY<STRUCT<k, v>> of the keywords that end a company name of 2 to most words in a run."""
    found = F.array(*[F.struct(F.lit(k).alias("k"), F.regexp_extract(run, rf"(?isuU)^(.+\s\Q{w}\E){tail}", 1).alias("v")) for k, w in enumerate(keywords)])
    return F.filter(found, lambda x: (x["v"] != "") & (_words(x["v"]) <= most))


def _any(keywords: list[str]) -> str:
    return r"(?iuU)\s(?:" + "|".join(rf"\Q{w}\E" for w in keywords) + ")"


def company_flags(text: Column) -> Column:
    runs = F.filter(F.coalesce(matches(text, RUN, need=text.rlike(_any(lx.COMPANY_KEYWORDS))), F.expr("cast(array() as array<struct<ord:int,start:int,stop:int,value:string>>)")), lambda r: r["value"].rlike(_any(lx.COMPANY_KEYWORDS)))
    nested = F.transform(runs, lambda r: F.transform(_keyword_hits(r["value"], lx.COMPANY_KEYWORDS, "", 5), lambda x: F.struct(F.lit(3).alias("detector_ord"), x["k"].cast("int").alias("pattern_ord"), r["ord"].alias("match_ord"), F.lit("company").alias("flag_type"), x["v"].alias("value"), r["start"].alias("start"), F.lit(0.6).alias("confidence"))))
    return F.flatten(nested)


def email_flags(text: Column) -> Column:
    return _flag(matches(text, EMAIL, need=F.contains(text, F.lit("@"))), 1, 0, "email", 1.0)


def phone_flags(text: Column) -> Column:
    return _flag(matches(text, lx.PHONE), 2, 0, "phone", 1.0)


def person_flags(text: Column) -> Column:
    name = lambda m: F.concat_ws(" ", F.regexp_extract(m["value"], lx.TITLED_PERSON, 1), F.regexp_extract(m["value"], lx.TITLED_PERSON, 2))
    return _flag(matches(text, TITLED_PERSON), 4, 0, "person", 0.8, name)


def location_flags(text: Column) -> Column:
    return F.concat(*[F.filter(_flag(matches(text, p, need=text.rlike(HAN) if k in (2, 3, 4) else None), 5, k, "location", 0.7, lambda m: naming.strip(m["value"])), lambda f: F.length(f["value"]) > 2) for k, p in enumerate(LOCATIONS)])


def address_flags(text: Column) -> Column:
    zips = [_flag(matches(text, p), 6 + k, 0, "address", c) for k, (p, c) in enumerate([(lx.US_ZIP, 0.5), (lx.CN_ZIP, 0.4)])]
    return F.concat(*zips, _flag(matches(text, lx.CN_ADDRESS, need=text.rlike(HAN)), 8, 0, "address", 0.6))


#: flag type -> its detector, in the order of detection
DETECTORS = {"email": email_flags, "phone": phone_flags, "company": company_flags, "person": person_flags, "location": location_flags, "address": address_flags}


def text_flags(text: Column, street_addresses: bool = False, only: list[str] | None = None) -> Column:
    """All flags of a text, as FLAG; only: the types to look for."""
    parts = [f(text) for kind, f in DETECTORS.items() if only is None or kind in only]
    if street_addresses and (only is None or "address" in only):
        parts.append(_flag(matches(text, lx.EN_ADDRESS), 9, 0, "address", 0.6))
    none = F.expr(f"cast(array() as {FLAG})")
    return F.concat(none, *[p.cast(FLAG) for p in parts])


def scan_texts(files: DataFrame, path: str = "path", text: str = "text", street_addresses: bool = False, only: list[str] | None = None) -> DataFrame:
    """Flags of files (path, text): ORDER, flag_type, value, start, context, confidence. only: detectors to run."""
    source = files.select(F.col(path).alias("path"), F.col(text).alias("text")).where("text is not null")
    rows = source.select("path", "text", F.explode(text_flags(F.col("text"), street_addresses, only or None)).alias("f"))
    return rows.select(F.lit(2).alias("phase"), "path", "f.detector_ord", "f.pattern_ord", "f.match_ord", "f.flag_type", "f.value", "f.start", context(F.col("text"), F.col("f.start")).alias("context"), "f.confidence")


def scan_names(files: DataFrame, path: str = "path") -> DataFrame:
    """Flags of file names: e-mail addresses, telephone numbers, and the first type of sensitive document."""
    name = F.col("path")
    kinds = F.array(*map(F.lit, lx.SENSITIVE_DOC_TYPES))
    kind = F.get(F.filter(kinds, lambda k: F.contains(F.lower(name), k)), F.lit(0))
    doc = F.when(kind.isNotNull(), F.array(F.struct(F.lit(3).alias("detector_ord"), F.lit(0).alias("pattern_ord"), F.lit(0).alias("match_ord"), F.lit("sensitive_doc").alias("flag_type"), kind.alias("value"), F.lit(None).cast("int").alias("start"), F.lit(0.7).alias("confidence")))).otherwise(F.expr(f"cast(array() as {FLAG})"))
    found = F.concat(email_flags(name).cast(FLAG), phone_flags(name).cast(FLAG), doc.cast(FLAG))
    rows = files.select(F.col(path).alias("path")).where(~F.col("path").endswith("/")).select("path", F.explode(found).alias("f"))
    return rows.select(F.lit(1).alias("phase"), "path", "f.detector_ord", "f.pattern_ord", "f.match_ord", "f.flag_type", "f.value", "f.start", F.lit("").alias("context"), "f.confidence")


# entities


def _likely(first: Column, last: Column) -> Column:
    return F.length(first).between(2, 20) & F.length(last).between(2, 20)


def _where(need: Column, values: Column) -> Column:
    """values of texts for which a cheap test lets them have some."""
    return F.when(need, values).otherwise(F.expr("cast(array() as array<string>)"))


def person_names(text: Column) -> Column:
    parts = []
    for p in PERSON_PATTERNS:
        both = F.transform(F.regexp_extract_all(text, F.lit(p), F.lit(0)), lambda m: F.struct(F.regexp_extract(m, p, 1).alias("a"), F.regexp_extract(m, p, 2).alias("b")))
        parts.append(F.transform(F.filter(both, lambda m: _likely(m["a"], m["b"])), lambda m: F.concat_ws(" ", m["a"], m["b"])))
    parts.insert(2, _where(text.rlike(HAN), F.regexp_extract_all(text, F.lit(lx.SURNAME_CN), F.lit(1))))
    return F.array_distinct(F.concat(*parts))


def company_names(text: Column) -> Column:
    runs = F.filter(F.regexp_extract_all(text, F.lit(WHOLE_RUN), F.lit(0)), lambda r: r.rlike(_any(lx.ORG_WORDS)))
    by_word = F.flatten(F.transform(runs, lambda r: F.transform(_keyword_hits(r, lx.ORG_WORDS, r"(?!\S)", 6), lambda x: x["v"])))
    partners = F.transform(F.regexp_extract_all(text, F.lit(lx.PARTNERS), F.lit(0)), naming.strip)
    return F.array_distinct(F.concat(by_word, partners, F.regexp_extract_all(text, F.lit(lx.NAME_OF_NAME), F.lit(1))))


def product_names(text: Column) -> Column:
    found = F.concat(*[F.transform(_where(text.rlike(need), F.regexp_extract_all(text, F.lit(p), F.lit(0))), naming.strip) for p, need in zip(lx.PRODUCT_PATTERNS, PRODUCT_NEEDS)])
    return F.array_distinct(F.filter(found, lambda v: F.length(v) > 2))


def entity_array(t: Column, confidences: tuple[float, float, float]) -> Column:
    """(entity_type, value, confidence) of people, companies and products in a text, each once."""

    def of(kind: str, names: Column, c: float) -> Column:
        return F.transform(names, lambda v: F.struct(F.lit(kind).alias("entity_type"), v.alias("value"), F.lit(c).alias("confidence")))

    return F.concat(*map(of, ("person", "company", "product"), (person_names(t), company_names(t), product_names(t)), confidences))


def entities(rows: DataFrame, source: str, text: str, confidences: tuple[float, float, float]) -> DataFrame:
    """(entity_type, value, source, confidence, context) of people, companies and products in a text, each once."""
    base = rows.select(F.col(source).alias("source"), F.col(text).alias("text")).where("text is not null")
    return base.select("source", F.explode(entity_array(F.col("text"), confidences)).alias("e")).select("e.entity_type", "e.value", "source", "e.confidence", F.lit("").alias("context"))


def entities_in_texts(files: DataFrame, source: str = "path", text: str = "text", model=None) -> DataFrame:
    """By a model (``DataFrame(source, text) -> entities``) if there is one, and by patterns where it finds none."""
    by_pattern = entities(files, source, text, (0.7, 0.6, 0.5))
    if model is None:
        return by_pattern
    found = model(files.select(F.col(source).alias("source"), F.col(text).alias("text")))
    return found.unionByName(by_pattern.join(found.select("source").distinct(), "source", "left_anti"))


def entities_in_names(files: DataFrame, source: str = "path") -> DataFrame:
    return entities(files.withColumn("__name", F.col(source)), source, "__name", (0.8, 0.7, 0.6))


def chunks(text: Column, size: int = 3000, overlap: int = 200) -> Column:
    """The pieces of a text that a model sees; blank ones are left out."""
    starts = F.when(F.length(text) > 0, F.sequence(F.lit(0), F.length(text) - 1, F.lit(size - overlap)))
    return F.filter(F.transform(starts, lambda s: F.substring(text, s + 1, F.lit(size))), lambda c: c.rlike(r"(?U)\S"))


_loaded: dict[str, object] = {}


def by_model(load, key: str, labels: dict[str, str] = lx.MODEL_LABELS, asked: list[str] = lx.ASKED_LABELS, threshold: float = 0.5, size: int = 3000, overlap: int = 200):
    """A model for entities_in_texts, from ``load``, which returns an object with predict_entities(text, labels, threshold).

    A worker loads it once under ``key``; if that fails, or a chunk does, nothing is found there, and the patterns take
    over in texts without any entity. Of a value seen again in a text, in any case, the first sight counts. Of the labels
    asked for, those in ``labels`` are kept, under the names there.
    """

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        if key not in _loaded:
            try:
                _loaded[key] = load()
            except Exception:  # noqa: BLE001 - whatever a model raises, there is none
                _loaded[key] = None
        for batch in batches:
            rows = []
            for source, place, chunk in batch.itertuples(index=False):
                try:
                    hits = _loaded[key].predict_entities(chunk, asked, threshold=threshold) if _loaded[key] is not None else []
                    rows += [(source, place, k, h["label"].lower(), h["text"].strip(), round(float(h["score"]), 3)) for k, h in enumerate(hits)]
                except Exception:  # noqa: BLE001
                    continue
            yield pd.DataFrame(rows, columns=["source", "place", "k", "label", "value", "confidence"])

    def found(texts: DataFrame) -> DataFrame:
        pieces = texts.where("text is not null").select("source", F.posexplode(chunks(F.col("text"), size, overlap)).alias("place", "chunk"))
        kind = texts.schema["source"].dataType.simpleString()
        hits = pieces.mapInPandas(run, f"source {kind}, place int, k int, label string, value string, confidence double")
        first = hits.groupBy("source", "label", F.lower("value")).agg(F.min(F.struct("place", "k", "value", "confidence")).alias("h"))
        names = F.create_map(*[F.lit(x) for pair in labels.items() for x in pair])
        return first.where(F.col("label").isin(*labels)).select(names[F.col("label")].alias("entity_type"), "h.value", "source", "h.confidence", F.lit("").alias("context"))

    return found


# names


def filename_patterns(files: DataFrame, path: str = "path") -> DataFrame:
    """(path, pattern_type, value, confidence) of each name, its last part and its stem; each value once, first seen."""
    name = F.col("path")
    texts = F.array(name, naming.base_name(name), naming.stem(name))

    def of(k: int, kind: str, pattern: str, confidence: float) -> Column:
        values = F.flatten(F.transform(texts, lambda t: F.regexp_extract_all(t, F.lit(pattern), F.lit(0))))
        return F.transform(values, lambda v, i: F.struct(F.lit(k).alias("k"), i.alias("i"), F.lit(kind).alias("pattern_type"), naming.strip(v).alias("value"), F.lit(confidence).alias("confidence")))

    found = [of(k, *p) for k, p in enumerate(lx.FILENAME_PATTERNS)]
    rows = files.select(F.col(path).alias("path")).distinct().select("path", F.explode(F.concat(*found)).alias("h")).select("path", "h.*").where(F.length("value") >= 3)
    w = Window.partitionBy("path", "pattern_type", F.lower("value")).orderBy("i")
    return rows.withColumn("seen", F.row_number().over(w)).where("seen = 1").select("path", "pattern_type", "value", "confidence", F.col("k").alias("pattern_ord"), F.col("i").alias("match_ord"))


def confidence_of(kind: Column) -> Column:
    known = F.create_map(*[F.lit(x) for k, _, c in lx.FILENAME_PATTERNS for x in (k, c)])
    return F.coalesce(F.try_element_at(known, kind), F.lit(lx.DEFAULT_CONFIDENCE))


def has_sensitive_patterns(files: DataFrame, path: str = "path", min_confidence: float = 0.7) -> DataFrame:
    hits = filename_patterns(files, path).groupBy("path").agg(F.bool_or(F.col("confidence") >= min_confidence).alias("hit"))
    return files.select(F.col(path).alias("path")).distinct().join(hits, "path", "left").select("path", F.coalesce("hit", F.lit(False)).alias("sensitive"))


def doc_labels(path: Column) -> Column:
    """Keywords of sensitive documents in a name's stem, in order, in lower case."""
    return F.transform(F.regexp_extract_all(naming.stem(path), F.lit(lx.DOC_KEYWORDS), F.lit(1)), F.lower)


def doc_score(path: Column) -> Column:
    heavy = F.array(*map(F.lit, lx.HEAVY_KEYWORDS))
    total = F.aggregate(doc_labels(path), F.lit(0.0), lambda s, k: s + F.when(F.array_contains(heavy, k), 0.5).otherwise(0.2))
    return F.least(total, F.lit(1.0))


# CAD


def _first(content: Column, pattern: str) -> Column:
    return naming.strip(F.regexp_extract(content, pattern, 1))


def _metadata(fields: list[tuple[str, Column]]) -> Column:
    made = F.map_from_arrays(F.array(*[F.lit(k) for k, _ in fields]), F.array(*[v for _, v in fields]))
    return F.map_filter(made, lambda k, v: v.isNotNull() & (v != ""))


def step_metadata(content: Column) -> Column:
    head = F.substring(content, 1, 50000)
    head = F.when(F.contains(head, F.lit("ENDSEC;")), F.substring(head, F.lit(1), F.ceil((F.locate("ENDSEC;", head) + 6) / 1000).cast("int") * 1000)).otherwise(head)
    return _metadata([(k, _first(head, rf"(?iu){name}\([^)]*'([^']+)'")) for k, name in lx.STEP_FIELDS])


def dxf_metadata(content: Column) -> Column:
    lines = F.transform(F.split(F.substring(content, 1, 100000), "\n", -1), naming.strip)
    pairs = let(lines, lambda x: F.transform(F.slice(x, 1, F.greatest(F.size(x) - 1, F.lit(0))), lambda line, k: F.struct(F.lower(line).alias("key"), F.get(x, k + 1).alias("value"), line.alias("line"))))
    hits = F.filter(pairs, lambda p: p["line"].isin(lx.DXF_KEYS) & (p["value"] != ""))
    keys = lambda x: F.array_distinct(F.transform(x, lambda p: p["key"]))
    return let(hits, lambda x: F.map_from_arrays(keys(x), F.transform(keys(x), lambda k: F.element_at(F.filter(x, lambda p: p["key"] == k), -1)["value"])))


def eagle_metadata(content: Column) -> Column:
    head = F.substring(content, 1, 50000)
    return _metadata([(t, F.get(F.filter(F.transform(F.regexp_extract_all(head, F.lit(rf"(?U)<{t}>\s*([^<]+)\s*</{t}>"), F.lit(1)), naming.strip), lambda v: v != ""), F.lit(0))) for t in lx.EAGLE_TAGS])


def gerber_metadata(content: Column) -> Column:
    head = F.substring(content, 1, 10000)
    return _metadata([("x_format", F.regexp_extract(head, lx.GERBER_FORMAT, 1)), ("y_format", F.regexp_extract(head, lx.GERBER_FORMAT, 2)), ("job_ticket", F.substring(_first(head, lx.GERBER_TICKET), 1, 200))])


def cad_metadata(path: Column, content: Column) -> Column:
    """Metadata of a CAD file by its extension; an empty map for other files."""
    kind = F.lower(naming.suffix(path))
    return (
        F.when(kind.isin(".step", ".stp"), step_metadata(content))
        .when(kind == ".dxf", dxf_metadata(content))
        .when(kind.isin(".sch", ".brd"), eagle_metadata(content))
        .when(kind.isin(".gbr", ".gtl", ".gbl", ".gto", ".gbo", ".gts", ".gbs", ".gps", ".gpt", ".gm1", ".gm2", ".gm3", ".gm4", ".gm5"), gerber_metadata(content))
        .otherwise(F.expr("cast(map() as map<string,string>)"))
    )


def sensitive_metadata(metadata: Column) -> Column:
    return F.map_filter(metadata, lambda k, v: F.lower(k).isin(lx.SENSITIVE_METADATA) & v.isNotNull() & (v != ""))
