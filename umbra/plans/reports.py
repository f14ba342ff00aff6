"""Reports as text. What is listed is cut to ``most`` lines by the engine, so the driver gets no more than it shows."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F


def _listed(rows: DataFrame, order: list, line, most: int) -> list[str]:
    shown = rows.orderBy(*order).limit(most + 1).collect()
    out = [line(r) for r in shown[:most]]
    if len(shown) > most:
        out.append(f"... and {rows.count() - most} more")
    return out


def projects(groups: DataFrame, most: int = 100) -> str:
    return "\n".join([f"Projects: {groups.count()}", *_listed(groups, [F.lower("project_name"), "project_name"], lambda r: f"  {r['project_name']} ({r['version_count']} versions, latest {r['latest_file']})", most)])


def consolidations(pairs: DataFrame, most: int = 100) -> str:
    if pairs.isEmpty():
        return "No consolidation suggestions found."
    return "\n".join(_listed(pairs, [F.desc("confidence"), "project_name_a", "project_name_b"], lambda r: f"{r['confidence']:.2f}  {r['project_name_a']} + {r['project_name_b']}: {r['reason']}", most))


def counts(rows: DataFrame, key: str, count: str, title: str, most: int = 100) -> str:
    return "\n".join([title, *_listed(rows, [key], lambda r: f"  {r[key]}: {r[count]}", most)])


def verification(hits: DataFrame, report: DataFrame, most: int = 10) -> str:
    """Each check with its first hits by file."""
    w = Window.partitionBy("check_name").orderBy("file_path", "original")
    shown = hits.withColumn("k", F.row_number().over(w)).where(F.col("k") <= most).orderBy("check_name", "k").collect()
    out = []
    for c in report.orderBy("check_ord").collect():
        out.append(f"{c['check_name']}: " + ("passed" if c["passed"] else f"FAILED, {c['hits']} hits in {c['files']} files"))
        out += [f"  {r['file_path']}: {r['entity_type']} {r['original']!r}" for r in shown if r["check_name"] == c["check_name"]]
        if c["hits"] > most:
            out.append(f"  ... and {c['hits'] - most} more")
    return "\n".join(out)


def directory(result, most: int = 5) -> str:
    """Totals of clean_directory, the first errors and the checks."""
    t = result.totals.first()
    head = f"{t['files']} files, {t['cleaned']} cleaned, {t['failed']} failed: " + ("success" if t["success"] else "NOT CLEAN")
    return "\n".join([head, *_listed(result.failures, ["path"], lambda r: f"  {r['path']}: {r['error']}", most), verification(result.hits, result.report)])


def diffs(file_diffs: DataFrame, most: int = 100) -> str:
    """Each changed file with its changes and its difference in size."""
    changed = file_diffs.where("original_hash <> cleaned_hash")
    return "\n".join([f"Changed files: {changed.count()}", *_listed(changed, ["file_path"], lambda r: f"  {r['file_path']}: {r['change_count']} changes, {r['size_diff']:+d} bytes", most)])


def similar(pairs: DataFrame, most: int = 100) -> str:
    """Similar names, the most similar first."""
    return "\n".join(_listed(pairs, [F.desc("similarity"), "ord_a", "ord_b"], lambda r: f"  {r['similarity']:.2f}  {r['name_a']} ~ {r['name_b']}", most)) or "No similar names found."


def version(catalog: DataFrame, most: int = 100) -> str:
    """The catalog of a version: files by data type and file type."""
    rows = catalog.where("file_type is not null")
    return "\n".join(["Files:", *_listed(rows, [F.asc_nulls_first("data_type"), "file_type"], lambda r: f"  {r['data_type'] or '-'} {r['file_type']}: {r['files']}", most)])
