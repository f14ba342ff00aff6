"""Projects and files: discovery, versions, types, filters and counts over tables of names."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from umbra.functions import naming

PROJECT = ["filepath", "project_name", "company", "product", "version", "timestamp", "is_zipped"]


def project_files(listing: DataFrame, path: str = "filepath", is_dir: str = "is_dir") -> DataFrame:
    """Project rows of a listing (filepath, is_dir), each file once."""
    name = naming.base_name(F.col(path))
    rows = listing.where(naming.is_project_file(name, F.col(is_dir))).select(F.col(path).alias("filepath"), naming.parse_project(name).alias("p"), (~F.col(is_dir)).alias("is_zipped"))
    return rows.select("filepath", "p.*", "is_zipped").dropDuplicates(["filepath"]).select(*PROJECT)


def merged(scans: list[DataFrame]) -> DataFrame:
    """Several scans as one, each file once."""
    out = scans[0]
    for s in scans[1:]:
        out = out.unionByName(s)
    return out.dropDuplicates(["filepath"])


def by_company(projects: DataFrame, part: str) -> DataFrame:
    return projects.where(F.contains(F.lower("company"), F.lit(part.lower())))


def by_product(projects: DataFrame, part: str) -> DataFrame:
    return projects.where(F.contains(F.lower("product"), F.lit(part.lower())))


def groups(projects: DataFrame) -> DataFrame:
    """A row a project: versions, how many, and the file of the latest."""
    return projects.groupBy("project_name").agg(F.min("company").alias("company"), F.min("product").alias("product"), F.count("*").alias("version_count"), F.array_sort(F.collect_list("version")).alias("versions"), F.max_by("filepath", F.struct("version", "filepath")).alias("latest_file"))


def latest(rows: DataFrame, by: str = "project_name", version: str = "version") -> DataFrame:
    """The rows of each project's latest version."""
    top = rows.groupBy(by).agg(F.max(version).alias("__latest"))
    return rows.join(top, by).where(F.col(version) == F.col("__latest")).drop("__latest")


def typed(files: DataFrame, path: str = "path") -> DataFrame:
    return files.withColumn("file_type", naming.classify(F.col(path)))


def count_by_type(files: DataFrame, by: list[str]) -> DataFrame:
    """Files of each type, and of all (file_type null), for each of by."""
    return files.groupingSets([[*map(F.col, by), F.col("file_type")], list(map(F.col, by))], *by, "file_type").agg(F.count("*").alias("files"))


def has_types(files: DataFrame, by: list[str]) -> DataFrame:
    """For each of by, whether it has images, videos, documents, CAD, audio, electronics and firmware."""
    kinds = [("image", "has_images"), ("video", "has_videos"), ("document", "has_documents"), ("cad", "has_cad"), ("audio", "has_audio"), ("electronics", "has_electronics"), ("firmware", "has_firmware")]
    return files.groupBy(*by).agg(*[F.bool_or(F.col("file_type") == k).alias(name) for k, name in kinds])


def of_type(rows: DataFrame, kind: str | None, column: str = "file_type") -> DataFrame:
    return rows if kind is None else rows.where(F.col(column) == kind)


def data_types(entries: DataFrame, by: str = "project_name", entry: str = "entry") -> DataFrame:
    """(project, data types) from the paths of archive entries."""
    kind = naming.data_type(F.col(entry))
    return entries.select(by, kind.alias("k")).distinct().groupBy(by).agg(F.array_sort(F.collect_list("k")).alias("data_types"))


def data_type_totals(entries: DataFrame, by: str = "project_name", entry: str = "entry") -> DataFrame:
    kind = naming.data_type(F.col(entry))
    return entries.agg(F.countDistinct(kind).alias("data_types"), F.countDistinct(by).alias("projects"))


def flags_by_type(flags: DataFrame) -> DataFrame:
    return flags.groupBy("flag_type").agg(F.count("*").alias("flags"))


def numbered(rows: DataFrame, order: list[Column | str], name: str = "ord") -> DataFrame:
    """rows with their places in order; for a listing or another small table."""
    return rows.withColumn(name, F.row_number().over(Window.orderBy(*order)) - 1)


def ordered_by_name(groups: DataFrame) -> DataFrame:
    return groups.orderBy(F.lower("project_name"), "project_name")


def of_version(rows: DataFrame, project: str, version: str | None = None, by: str = "project_name", of: str = "version") -> DataFrame:
    """The rows of one version of a project; without a version, of its latest."""
    own = rows.where(F.col(by) == project)
    return latest(own, by, of) if version is None else own.where(F.col(of) == version)


def version_catalog(files: DataFrame, project: str, version: str | None = None, by: str = "project_name", of: str = "version", path: str = "path") -> DataFrame:
    """The catalog of one version: files of each type, and of all (file_type null), with their paths' data type."""
    own = of_version(files, project, version, by, of)
    return count_by_type(typed(own.withColumn("data_type", naming.data_type(F.concat(F.lit("root/"), F.col(path)))), path), [by, of, "data_type"])
