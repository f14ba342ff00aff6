"""Files cleaned by kind: texts by placeholders, containers by dropping their metadata; unknown kinds are copied.

Containers are rewritten with the standard library (zip, PNG and JPEG structure), so no optional package is needed;
PDF texts need PyPDF2, audio and video need ffmpeg. A file that cannot be cleaned is not written: it goes to the
failures with its error.
"""

from __future__ import annotations

import io
import re
import shutil
import struct
import subprocess
import tempfile
import zipfile
from collections.abc import Callable, Iterator
from pathlib import Path
from xml.sax.saxutils import escape, unescape

import pandas as pd
from pyspark.sql import DataFrame, functions as F

from umbra.functions import naming
from umbra.operators import replace

CORE = ["creator", "lastModifiedBy", "title", "subject", "description", "keywords", "category", "contentStatus", "identifier", "language", "version", "revision"]
JPEG_DROP = {*range(0xE1, 0xF0), 0xFE}
PNG_DROP = {b"tEXt", b"zTXt", b"iTXt", b"eXIf", b"tIME"}


def clean_jpeg(data: bytes) -> bytes:
    if data[:2] != b"\xff\xd8":
        raise ValueError("no JPEG file")
    out, at = [data[:2]], 2
    while at + 4 <= len(data) and data[at] == 0xFF and data[at + 1] != 0xDA:
        size = 2 + struct.unpack(">H", data[at + 2 : at + 4])[0]
        if data[at + 1] not in JPEG_DROP:
            out.append(data[at : at + size])
        at += size
    return b"".join(out) + data[at:]


def clean_png(data: bytes) -> bytes:
    if data[:8] != b"\x89PNG\r\n\x1a\n":
        raise ValueError("no PNG file")
    out, at = [data[:8]], 8
    while at + 12 <= len(data):
        size = 12 + struct.unpack(">I", data[at : at + 4])[0]
        if data[at + 4 : at + 8] not in PNG_DROP:
            out.append(data[at : at + size])
        at += size
    return b"".join(out)


def clean_gif(data: bytes) -> bytes:
    """Without comments, texts and application data, but for the loop count."""
    if data[:6] not in (b"GIF87a", b"GIF89a"):
        raise ValueError("no GIF file")

    def blocks(at: int) -> int:
        while data[at]:
            at += data[at] + 1
        return at + 1

    at = 13 + (3 << (data[10] & 7) + 1 if data[10] & 0x80 else 0)
    out = [data[:at]]
    while data[at] != 0x3B:
        if data[at] == 0x2C:
            colours = 3 << (data[at + 9] & 7) + 1 if data[at + 9] & 0x80 else 0
            end, keep = blocks(at + 11 + colours), True
        elif data[at] == 0x21:
            end = blocks(at + 2)
            keep = data[at + 1] == 0xF9 or data[at + 1] == 0xFF and data[at + 3 : at + 14] == b"NETSCAPE2.0"
        else:
            raise ValueError("broken GIF file")
        out += [data[at:end]] * keep
        at = end
    return b"".join(out) + b";"


def clean_webp(data: bytes) -> bytes:
    """Without EXIF and XMP, and without the flags that announce them."""
    if data[:4] != b"RIFF" or data[8:12] != b"WEBP":
        raise ValueError("no WEBP file")
    out, at = [], 12
    while at + 8 <= len(data):
        size = struct.unpack("<I", data[at + 4 : at + 8])[0]
        end = at + 8 + size + size % 2
        if data[at : at + 4] == b"VP8X":
            out.append(data[at : at + 8] + bytes([data[at + 8] & ~0x0C]) + data[at + 9 : end])
        elif data[at : at + 4] not in (b"EXIF", b"XMP "):
            out.append(data[at:end])
        at = end
    body = b"WEBP" + b"".join(out)
    return b"RIFF" + struct.pack("<I", len(body)) + body


IMAGES = {".png": clean_png, ".jpg": clean_jpeg, ".jpeg": clean_jpeg, ".gif": clean_gif, ".webp": clean_webp}


def clean_image(name: str, data: bytes) -> bytes:
    """An image without metadata. BMP has none; other kinds can't be rewritten here, and must not pass for clean."""
    kind = Path(name).suffix.lower()
    if kind == ".bmp":
        if data[:2] != b"BM":
            raise ValueError("no BMP file")
        return data
    if kind not in IMAGES:
        raise RuntimeError(f"metadata of {kind} files can't be removed")
    return IMAGES[kind](data)


def clean_office(data: bytes, text: Callable[[str], str] | None = None) -> bytes:
    """An OOXML file without core, application and custom properties; text, if given, rewrites the texts of its runs and cells."""
    out = io.BytesIO()
    with zipfile.ZipFile(io.BytesIO(data)) as old, zipfile.ZipFile(out, "w", zipfile.ZIP_DEFLATED) as new:
        for item in old.infolist():
            body = old.read(item)
            if item.filename == "docProps/custom.xml":
                continue
            if item.filename in ("[Content_Types].xml", "_rels/.rels"):
                body = re.sub(rb"<(?:Override|Relationship)\b[^>]*custom(?:\.xml|-properties)[^>]*/>", b"", body)
            elif item.filename == "docProps/core.xml":
                body = re.sub(rb"(<(?:\w+:)?(?:%s)\b[^>]*>)[^<]*" % "|".join(CORE).encode(), rb"\1", body)
            elif item.filename == "docProps/app.xml":
                body = re.sub(rb"(<(?:Company|Manager|Application)\b[^>]*>)[^<]*", rb"\1", body)
            elif text and re.fullmatch(r"word/(document|header\d*|footer\d*|footnotes|endnotes|comments)\.xml|xl/sharedStrings\.xml|xl/worksheets/[^/]*\.xml", item.filename):
                body = re.sub(r"(<(?:w:)?t\b[^>/]*>)([^<]*)", lambda m: m[1] + escape(text(unescape(m[2]))), body.decode()).encode()
            new.writestr(item.filename, body)
    return out.getvalue()


def clean_pdf(data: bytes) -> bytes:
    try:
        from PyPDF2 import PdfReader, PdfWriter
    except ImportError as e:
        raise RuntimeError("PyPDF2 is not installed") from e
    writer = PdfWriter()
    for page in PdfReader(io.BytesIO(data)).pages:
        writer.add_page(page)
    out = io.BytesIO()
    writer.write(out)
    return out.getvalue()


def clean_media(name: str, data: bytes, seconds: int, copy: bool) -> bytes:
    if not shutil.which("ffmpeg"):
        raise RuntimeError("ffmpeg is not installed")
    with tempfile.TemporaryDirectory() as folder:
        source, target = Path(folder, "in" + Path(name).suffix), Path(folder, "out" + Path(name).suffix)
        source.write_bytes(data)
        subprocess.run(["ffmpeg", "-y", "-i", source, "-map_metadata", "-1", *(["-c", "copy"] if copy else []), target], check=True, capture_output=True, timeout=seconds)
        return target.read_bytes()


CLEANERS: dict[str, Callable[[str, bytes], bytes]] = {
    "pdf": lambda n, d: clean_pdf(d),
    "image": clean_image,
    "audio": lambda n, d: clean_media(n, d, 60, False),
    "video": lambda n, d: clean_media(n, d, 120, True),
    "copy": lambda n, d: d,
}


def _office(entries: list[tuple[str, str]]):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        put = replace.replacer(entries)
        for batch in batches:
            rows = []
            for path, content, error in batch.itertuples(index=False):
                try:
                    rows.append((path, clean_office(bytes(content), put), None) if error is None else (path, None, error))
                except Exception as e:  # noqa: BLE001 - any fault of a file is reported as that file's
                    rows.append((path, None, f"{type(e).__name__}: {e}"))
            yield pd.DataFrame(rows, columns=["path", "content", "error"])

    return run


def clean_files(files: DataFrame, mapping: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(cleaned (path, content), failures (path, error)) of files (path, content)."""
    routed = files.select("path", "content", naming.cleaner(F.col("path")).alias("cleaner"))
    texts = routed.where("cleaner = 'text'")
    good = F.is_valid_utf8(F.col("content").cast("string"))
    cleaned = replace.apply(texts.where(good).select("path", F.col("content").cast("string").alias("text")), mapping)
    as_text = cleaned.select("path", F.encode("cleaned", "UTF-8").alias("content"), F.lit(None).cast("string").alias("error"))
    bad = texts.where(~good).select("path", F.lit(None).cast("binary").alias("content"), F.lit("not UTF-8").alias("error"))

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = []
            for path, content, kind in batch.itertuples(index=False):
                try:
                    rows.append((path, CLEANERS[kind](path, bytes(content)), None))
                except Exception as e:  # noqa: BLE001 - any fault of a file is reported as that file's
                    rows.append((path, None, f"{type(e).__name__}: {e}"))
            yield pd.DataFrame(rows, columns=["path", "content", "error"])

    others = routed.where("cleaner not in ('text', 'xlsx', 'docx')").mapInPandas(run, "path string, content binary, error string")
    office = routed.where("cleaner in ('xlsx', 'docx')").select("path", "content", F.lit(None).cast("string").alias("error"))
    for entries in replace.entry_blocks(mapping):
        office = office.mapInPandas(_office(entries), "path string, content binary, error string")
    done = as_text.unionByName(bad).unionByName(others).unionByName(office)
    return done.where("error is null").select("path", "content"), done.where("error is not null").select("path", "error")
