"""Files as tables: directories, archives, texts, PDF and image texts; and sinks for what comes out.

Listing is Spark's (any Hadoop path); the content column is read only where it is used. Archives are opened where
their bytes are, one row a member. Optional packages (PyPDF2, pytesseract with PIL) are used if installed; without
them texts of such files are empty, as for files that cannot be read.
"""

from __future__ import annotations

import io
import os
import posixpath
import uuid
import zipfile
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from umbra.functions import naming
from umbra.operators import catalog

LISTING = "filepath string, is_dir boolean"
DEFAULT_LOCATIONS = "umbra.locations"  # a comma-separated session setting


def scan_directory(spark: SparkSession, folder: str) -> DataFrame:
    """Project rows of a folder's own entries; none if it is missing or no folder."""
    jvm = spark._jvm
    path = jvm.org.apache.hadoop.fs.Path(folder)
    fs = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    rows = [(s.getPath().toUri().getPath(), bool(s.isDirectory())) for s in fs.listStatus(path)] if fs.exists(path) and fs.getFileStatus(path).isDirectory() else []
    return catalog.project_files(spark.createDataFrame(sorted(rows), LISTING))


def discover_projects(spark: SparkSession, folder: str | None = None) -> DataFrame:
    """Groups of all projects of a folder, or of the session's default locations, by name."""
    places = [folder] if folder else [p for p in (spark.conf.get(DEFAULT_LOCATIONS, "") or "").split(",") if p]
    if not places:
        return catalog.ordered_by_name(catalog.groups(catalog.project_files(spark.createDataFrame([], LISTING))))
    return catalog.ordered_by_name(catalog.groups(catalog.merged([scan_directory(spark, p) for p in places])))


def folder_data_types(spark: SparkSession, folder: str) -> DataFrame:
    """(data_type): the names of a folder's own subfolders that are not hidden, in order; none if it is missing."""
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    fs = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    found = fs.listStatus(path) if fs.exists(path) and fs.getFileStatus(path).isDirectory() else []
    names = sorted(s.getPath().getName() for s in found if s.isDirectory() and not s.getPath().getName().startswith("."))
    return spark.createDataFrame([(n,) for n in names], "data_type string")


def read_tree(spark: SparkSession, folder: str, metadata_files: bool = False) -> DataFrame:
    """(path, content, size) of all files below folder, paths relative; ._ files only with metadata_files."""
    root = os.path.join(folder, "")
    rows = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(folder)
    bare = F.regexp_replace("path", "^[a-z]+:/*", "/")
    rows = rows.select(F.substring(bare, F.lit(len(root) + 1), F.length(bare)).alias("path"), "content", F.col("length").alias("size"))
    return rows if metadata_files else rows.where(~naming.base_name(F.col("path")).startswith("._"))


def zip_entries(files: DataFrame, with_content: bool = True) -> DataFrame:
    """(archive, path, content, size) of the members of archives (path, content); broken archives have none."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for archive, content in batch.itertuples(index=False):
                rows = []
                try:
                    with zipfile.ZipFile(io.BytesIO(content)) as z:
                        rows = [(archive, i.filename, z.read(i) if with_content else None, i.file_size) for i in z.infolist() if not i.filename.endswith("/")]
                except (zipfile.BadZipFile, OSError):
                    pass
                yield pd.DataFrame(rows, columns=["archive", "path", "content", "size"])

    return files.select("path", "content").mapInPandas(run, "archive string, path string, content binary, size long")


def texts(files: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(path, text) of the files that are UTF-8, and (path, error) of the others."""
    text = F.col("content").cast("string")
    return files.where(F.is_valid_utf8(text)).select("path", text.alias("text")), files.where(~F.is_valid_utf8(text)).select("path", F.lit("not UTF-8").alias("error"))


def pdf_texts(files: DataFrame, max_pages: int = 5) -> DataFrame:
    @F.pandas_udf(T.StringType())
    def text(contents: Iterator[pd.Series]) -> Iterator[pd.Series]:
        try:
            from PyPDF2 import PdfReader
        except ImportError:
            PdfReader = None

        def one(content) -> str:
            if PdfReader is None or content is None:
                return ""
            try:
                return "\n".join(p.extract_text() or "" for p in PdfReader(io.BytesIO(content)).pages[:max_pages])
            except Exception:  # noqa: BLE001 - whatever the reader raises, the file has no text
                return ""

        for batch in contents:
            yield batch.map(one)

    return files.where(F.lower("path").endswith(".pdf")).select("path", text("content").alias("text"))


def image_texts(files: DataFrame, language: str = "eng") -> DataFrame:
    """Texts in images by tesseract; null without it."""

    @F.pandas_udf(T.StringType())
    def text(contents: Iterator[pd.Series]) -> Iterator[pd.Series]:
        try:
            import pytesseract
            from PIL import Image
        except ImportError:
            pytesseract = Image = None

        def read(reader, image, content):
            try:
                return reader.image_to_string(image.open(io.BytesIO(content)), lang=language)
            except Exception:  # noqa: BLE001 - a broken image has no text
                return None

        for batch in contents:
            yield batch.map(lambda c: None if pytesseract is None or c is None else read(pytesseract, Image, c))

    kinds = [".jpg", ".jpeg", ".png", ".tiff", ".tif", ".bmp", ".gif"]
    return files.where(F.lower(naming.suffix(F.col("path"))).isin(kinds)).select("path", text("content").alias("text"))


def one_of_type(files: DataFrame, extension: str) -> DataFrame:
    return files.where(F.lower("path").endswith(extension.lower())).orderBy("path").limit(1)


def write_tree(files: DataFrame, folder: str) -> None:
    """Writes (path, content) below a folder that all executors share (any store pyarrow can write), each file through a
    draft and a rename, so a task that is run again leaves whole files."""

    def put(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        from pyarrow import fs

        store, root = fs.FileSystem.from_uri(folder)
        for batch in batches:
            for path, content in batch.itertuples(index=False):
                target = posixpath.normpath(posixpath.join(root, path))
                if not target.startswith(posixpath.normpath(root) + "/"):
                    raise ValueError(f"{path} leaves the folder")
                store.create_dir(posixpath.dirname(target), recursive=True)
                draft = f"{target}.draft-{uuid.uuid4().hex}"
                with store.open_output_stream(draft) as out:
                    out.write(bytes(content))
                store.move(draft, target)
            yield pd.DataFrame({"files": [len(batch)]})

    files.select("path", "content").mapInPandas(put, "files long").agg(F.sum("files")).collect()


#: exiftool's names of the fields of SolidWorks files, and ours.
SOLIDWORKS_FIELDS = {"Author": "author", "LastSavedBy": "last_saved_by", "CreatorTool": "creator_tool", "CreateDate": "create_date", "ModifyDate": "modify_date", "Description": "description", "Subject": "subject", "Comments": "comments", "Company": "company", "Manager": "manager", "Title": "title"}


def solidworks_metadata(files: DataFrame, seconds: int = 30) -> DataFrame:
    """(path, metadata) of SolidWorks files by exiftool; empty without it."""

    @F.pandas_udf(T.MapType(T.StringType(), T.StringType()))
    def metadata(contents: Iterator[pd.Series]) -> Iterator[pd.Series]:
        import json
        import shutil
        import subprocess

        found = shutil.which("exiftool")

        def one(content) -> dict:
            if not found or content is None:
                return {}
            try:
                done = subprocess.run([found, "-json", "-"], input=bytes(content), capture_output=True, timeout=seconds, check=True)
                fields = json.loads(done.stdout)[0]
            except (subprocess.SubprocessError, ValueError, IndexError):
                return {}
            return {ours: str(fields[theirs]) for theirs, ours in SOLIDWORKS_FIELDS.items() if fields.get(theirs)}

        for batch in contents:
            yield batch.map(one)

    return files.where(F.lower(naming.suffix(F.col("path"))).isin(".sldprt", ".sldasm")).select("path", metadata("content").alias("metadata"))
