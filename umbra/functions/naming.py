"""File and project names as column expressions."""

from __future__ import annotations

from itertools import chain

from pyspark.sql import Column, functions as F

from umbra.functions import lexicon as lx


def base_name(path: Column) -> Column:
    return F.element_at(F.split(path, "/"), -1)


def suffix(path: Column) -> Column:
    """The last extension with its dot, as the name has it; none for .hidden and name."""
    return F.regexp_extract(base_name(path), r"^.+(\.[^.]+)$", 1)


def stem(path: Column) -> Column:
    base = base_name(path)
    return F.substring(base, F.lit(1), F.length(base) - F.length(suffix(path)))


def _type_map(sets: dict[str, list[str]]) -> Column:
    first: dict[str, str] = {}
    for kind, extensions in sets.items():
        for e in extensions:
            first.setdefault(e, kind)
    return F.create_map(*[F.lit(x) for x in chain.from_iterable(first.items())])


def classify(path: Column) -> Column:
    """The type of a file by its extension; the first set that has it."""
    return F.coalesce(F.try_element_at(_type_map(lx.EXTENSIONS), F.lower(suffix(path))), F.lit("other"))


def cleaner(path: Column) -> Column:
    """The cleaner a file goes to; copy if none."""
    return F.coalesce(F.try_element_at(_type_map(lx.CLEANER_EXTENSIONS), F.lower(suffix(path))), F.lit("copy"))


def cleaner_for_extension(extension: Column) -> Column:
    """As cleaner, for an extension as it is written, or null."""
    return F.try_element_at(_type_map(lx.CLEANER_EXTENSIONS), extension)


def normalize(name: Column) -> Column:
    """Lower case, trimmed, without special characters, blanks collapsed."""
    return F.regexp_replace(F.regexp_replace(strip(F.lower(name)), r"(?U)[^a-z0-9\s-]", ""), r"(?U)\s+", " ")


def strip(text: Column) -> Column:
    return F.regexp_replace(text, r"(?U)^\s+|\s+$", "")


def parse_project(name: Column) -> Column:
    """STRUCT<project_name, company, product, version, timestamp> of ``Company - Product[-timestamp][-NNN.zip]``, or null."""
    from umbra.functions.matching import let

    def version_of(n: Column) -> Column:
        found = F.nullif(F.regexp_extract(n, r"-(\d{3})\.zip$", 1), F.lit("")).cast("int")
        return F.coalesce(F.when(F.lower(n).endswith(".zip"), found), F.lit(0))

    def bare_of(n: Column) -> Column:
        plain = let(F.regexp_replace(n, r"^(.*?)-\d{8}T\d{6}Z", "$1"), lambda b: F.when(F.lower(b).endswith(".zip"), F.substring(b, F.lit(1), F.length(b) - 4)).otherwise(b))
        unversioned = F.when(version_of(n) > 0, F.regexp_replace(plain, r"-\d{3}$", "")).otherwise(plain)
        return F.regexp_replace(F.replace(unversioned, F.lit("--"), F.lit("-")), r"-+$", "")

    def parts_of(b: Column) -> Column:
        at = F.locate(" - ", b)
        company = F.when(at > 0, F.substring(b, F.lit(1), at - 1)).otherwise(b)
        product = F.when(at > 0, F.substring(b, at + 3, F.length(b))).otherwise(F.lit(""))
        return F.struct(strip(company).alias("company"), strip(product).alias("product"))

    moment = F.try_to_timestamp(F.nullif(F.regexp_extract(name, r"-(\d{8}T\d{6}Z)", 1), F.lit("")), F.lit("yyyyMMdd'T'HHmmss'Z'")).cast("timestamp_ntz")

    def whole(p: Column) -> Column:
        project = F.when(p["product"] != "", F.concat(p["company"], F.lit(" - "), p["product"])).otherwise(p["company"])
        made = F.struct(project.alias("project_name"), p["company"].alias("company"), p["product"].alias("product"), version_of(name).cast("int").alias("version"), moment.alias("timestamp"))
        return F.when(p["company"] != "", made)

    return let(let(bare_of(name), parts_of), whole)


def is_project_file(name: Column, is_dir: Column) -> Column:
    return ~name.startswith(".") & ((F.lower(suffix(name)) == ".zip") | is_dir) & parse_project(name).isNotNull()


def data_type(entry: Column) -> Column:
    """The second component of an archive entry's path, or null."""
    return F.get(F.filter(F.split(entry, "/"), lambda p: p != ""), F.lit(1))
