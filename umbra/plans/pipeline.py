"""The whole way: files, flags, mapping, cleaned texts, verification, diffs."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession, functions as F

from umbra.functions import naming
from umbra.operators import clean as cleaners, detect, mapping as mp, replace, structure, verify
from umbra.session import kept
from umbra.sources import files as sources


@dataclass
class CleanResult:
    """Frames of a run; nothing of the data is on the driver."""

    mapping: DataFrame
    cleaned: DataFrame
    hits: DataFrame
    report: DataFrame
    changes: DataFrame
    diffs: DataFrame

    def summary(self) -> DataFrame:
        """One row: files, changes, size difference, whether all checks passed."""
        return structure.diff_totals(self.diffs).crossJoin(verify.all_passed(self.report))


def flags_of(files: DataFrame, path: str = "path", text: str = "text") -> DataFrame:
    """Flags of all names first, then those of all texts."""
    return detect.scan_names(files, path).unionByName(detect.scan_texts(files, path, text))


def clean(files: DataFrame, path: str = "path", text: str = "text", mapping: DataFrame | None = None, spans: DataFrame | None = None, mode: str = "sequential") -> CleanResult:
    """Cleans texts (path, text). A mapping from before is gone on with; spans replace by place where a text has some."""
    rows = files.select(F.col(path).cast("string").alias("path"), F.col(text).alias("text"))
    flags = kept(flags_of(rows))
    built = kept(mp.build(flags, detect.ORDER, known=mapping))
    cleaned = replace.clean_texts(rows, built, spans) if spans is not None else replace.apply(rows, built, mode=mode)
    hits, report = verify.verify(cleaned.select("path", "cleaned"), built, "path", "cleaned")
    changes = structure.changes(flags.where("phase = 2"), built)
    return CleanResult(built, cleaned, hits, report, changes, structure.file_diffs(cleaned, changes))


@dataclass
class DirectoryResult:
    """What clean_directory has done: the mapping, failures (path, error), hits and report, and totals in one row."""

    mapping: DataFrame
    failures: DataFrame
    hits: DataFrame
    report: DataFrame
    totals: DataFrame


MAPPING_FILE = ".entity_mapper.json"


def clean_directory(spark: SparkSession, source: str, target: str, mapping: DataFrame | None = None) -> DirectoryResult:
    """Cleans all files below source to target, which is deleted first; source is only read.

    Entities are found in all names and in the texts that are UTF-8. What is written is read again and verified: texts
    for leaks, known entities and unknown placeholders, all files for being readable. Then the mapping is saved as JSON
    lines in the folder MAPPING_FILE of target. A file that fails is not in target, and success is false.
    """
    path = spark._jvm.org.apache.hadoop.fs.Path
    store = path(target).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    here, there = (f"{store.makeQualified(path(p)).toString().rstrip('/')}/" for p in (source, target))
    if here.startswith(there) or there.startswith(here):
        raise ValueError("source and target must not lie within one another")
    store.delete(path(target), True)
    files = sources.read_tree(spark, source)
    as_text = files.where(naming.cleaner(F.col("path")) == "text")
    texts = sources.texts(as_text)[0]
    flags = kept(detect.scan_names(files, "path").unionByName(detect.scan_texts(texts, "path", "text")))
    built = kept(mp.build(flags, detect.ORDER, known=mapping))
    done, failures = cleaners.clean_files(files, built)
    failures = kept(failures)
    store.mkdirs(path(target))
    sources.write_tree(done, target)
    written = sources.read_tree(spark, target)
    again = sources.texts(written.where(naming.cleaner(F.col("path")) == "text"))[0]
    hits = kept(verify.verify(again, built)[0].unionByName(verify.illegible(written.where(naming.cleaner(F.col("path")) != "text"))))
    report = verify.report(hits)
    mp.to_json(built).write.mode("overwrite").text(f"{target.rstrip('/')}/{MAPPING_FILE}")
    count = files.agg(F.count("*").alias("files"))
    totals = count.crossJoin(failures.agg(F.count("*").alias("failed"))).crossJoin(verify.all_passed(report))  # of one row each
    totals = totals.select("files", (F.col("files") - F.col("failed")).alias("cleaned"), "failed", ((F.col("failed") == 0) & F.col("all_passed")).alias("success"))
    return DirectoryResult(built, failures, hits, report, totals)


def load_mapping(spark: SparkSession, target: str) -> DataFrame:
    """The mapping that clean_directory has saved in target."""
    return mp.from_json(spark.read.text(f"{target.rstrip('/')}/{MAPPING_FILE}"))
