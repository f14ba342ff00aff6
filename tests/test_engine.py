"""Golden values and independent models of single operators."""

import re
import zipfile
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from umbra.functions import lexicon as lx, matching, naming
from umbra.operators import clean, detect, discriminate, evaluate, mapping as mp, replace, structure, verify
from umbra.plans import pipeline
from umbra.sources import files as sources

NAMES = [
    ("Acme Corp - Widget Pro-20210425T055243Z-001.zip", ("Acme Corp", "Widget Pro", 1, datetime(2021, 4, 25, 5, 52, 43))),
    ("Beta LLC - Gamma Device", ("Beta LLC", "Gamma Device", 0, None)),
    ("A - B-000.zip", ("A", "B-000", 0, None)),
    ("A - B-001.ZIP", ("A", "B-001", 0, None)),
    ("A - B-20211399T000000Z-002.zip", ("A", "B", 2, None)),
    (" - X", None),
    ("Solo", ("Solo", "", 0, None)),
    ("A--B - C-", ("A-B", "C", 0, None)),
]


def test_parse_project(spark):
    rows = spark.createDataFrame(list(enumerate(n for n, _ in NAMES)), "id int, name string").select("id", naming.parse_project(F.col("name")).alias("p")).orderBy("id").collect()
    for r, (_, want) in zip(rows, NAMES):
        assert (tuple(r["p"])[1:] if r["p"] else None) == want


def test_matches_have_places(spark):
    texts = ["a@b.cd, x é a@b.cd", "none", "", "😀 m.x@y-z.org😀 q@r.st", None]
    rows = spark.createDataFrame(list(enumerate(texts)), "id int, t string").select("id", matching.matches(F.col("t"), lx.EMAIL).alias("m")).orderBy("id").collect()
    for r, t in zip(rows, texts):
        want = [(m.start(), m.end(), m.group()) for m in re.finditer(r"[\w\.-]+@[\w\.-]+\.\w+", t or "")]
        assert [(m["start"], m["stop"], m["value"]) for m in r["m"] or []] == want


def companies(text):
    out = set()
    for k, w in enumerate(lx.COMPANY_KEYWORDS):
        for m in re.finditer(r"([A-Z][A-Za-z]+(?:\s+[A-Z][A-Za-z]+)*\s+" + re.escape(w) + ")", text, re.IGNORECASE):
            if 2 <= len(m[1].split()) <= 5:
                out.add((k, m[1], m.start()))
    return out


def test_company_flags(spark):
    texts = ["Big Blue inc and Old sa same Group co. x", "the LLC", "one two three four five six llc", "éAcme Labs_x Nova labs", "A\nBc  Technologies Group", ("word " * 200) + "inc"]
    rows = spark.createDataFrame(list(enumerate(texts)), "id int, t string").select("id", detect.company_flags(F.col("t")).alias("f")).collect()
    for r in rows:
        assert {(f["pattern_ord"], f["value"], f["start"]) for f in r["f"]} == companies(texts[r["id"]])


def test_cascading_replacement(spark):
    seen = spark.createDataFrame([(0, "person", "Johnson", "f"), (1, "person", "son", "f"), (2, "person", " JOHNSON ", "g"), (3, "other", "x1", "f"), (4, "thing", "x2", "f")], "n int, flag_type string, value string, path string")
    built = mp.build(seen, ["n"])
    got = {r["key"]: (r["original"], r["placeholder"], r["occurrence_count"], r["sources"]) for r in built.collect()}
    assert got["johnson"] == ("Johnson", "[PERSON_001]", 2, ["f", "g"])
    assert {got["x1"][1], got["x2"][1]} == {"[ENTITY_001]", "[ENTITY_002]"}  # kinds without a prefix do not collide
    texts = spark.createDataFrame([("a", "johnson met Son"), ("b", None), ("c", "")], "path string, text string")
    assert {r["path"]: r["cleaned"] for r in replace.apply(texts, built).collect()} == {"a": "[PER[PERSON_002]_001] met [PERSON_002]", "b": None, "c": ""}
    assert replace.apply(texts, built, mode="single_pass").where("path = 'a'").first()["cleaned"] == "[PERSON_001] met [PERSON_002]"
    assert replace.apply(texts, built, limit=1).where("path = 'a'").first()["cleaned"] == "[PER[PERSON_002]_001] met [PERSON_002]"
    more = spark.createDataFrame([(0, "person", "Ann", "h"), (1, "person", "son", "h")], "n int, flag_type string, value string, path string")
    later = {r["key"]: r for r in mp.build(more, ["n"], known=built).collect()}
    assert later["ann"]["placeholder"] == "[PERSON_003]" and later["son"]["occurrence_count"] == 2


def test_spans(spark):
    texts = spark.createDataFrame([("a", "xx  Ann  yy Bob")], "path string, text string")
    spans = spark.createDataFrame([("a", 2, 9, "person", ""), ("a", 12, 15, "person", ""), ("a", 14, 99, "person", ""), ("a", 2, 4, "person", "")], "path string, start int, stop int, entity_type string, source string")
    valued = replace.span_values(spans, texts)
    built = mp.build(valued.withColumnRenamed("entity_type", "flag_type"), ["ord"])
    assert replace.replace_spans(texts, valued, built).first()["cleaned"] == "xx[PERSON_002]yy [PERSON_001]"
    assert replace.replace_spans(texts, valued, built, keep_blanks=True).first()["cleaned"] == "xx  [PERSON_002]  yy [PERSON_001]"


def test_pipeline(spark):
    files = spark.createDataFrame([("docs/invoice 7.txt", "Mail a@b.cd or +49-170-1234567."), ("n.txt", "nothing"), ("e.txt", "")], "path string, text string")
    done = pipeline.clean(files)
    assert {r["path"]: r["cleaned"] for r in done.cleaned.collect()}["docs/invoice 7.txt"] == "Mail [EMAIL_001] or [PHONE_001]."
    checks = {r["check_name"]: r["passed"] for r in done.report.collect()}
    assert checks == {"leakage": True, "rescan": True, "legibility": False, "consistency": True}  # an empty text is not legible
    assert {r["file_path"]: r["change_count"] for r in done.diffs.collect()}["n.txt"] == 0


def test_checks(spark):
    built = mp.build(spark.createDataFrame([(0, "person", "Ann Lee", "f")], "n int, flag_type string, value string, path string"), ["n"])
    texts = spark.createDataFrame([("a", "by Ann Lee, [PERSON_001] [PERSON_009]"), ("b", "ok")], "path string, text string")
    hits, report = verify.verify(texts, built)
    assert {(r["check_name"], r["original"]) for r in hits.collect()} == {("leakage", "Ann Lee"), ("rescan", "Ann Lee"), ("consistency", "[PERSON_009]")}
    assert not verify.all_passed(report).first()[0] and verify.failed(report).count() == 3


def test_similar_names_lose_nothing(spark):
    import difflib
    import random

    r = random.Random(5)
    names = sorted({"".join(r.choice("abcd 12") for _ in range(r.randint(3, 9))) for _ in range(60)} | {"report final", "report finals", "reprot final"})
    frame = spark.createDataFrame(list(enumerate(names)), "id int, name_normalized string")
    got = {(x["name_a"], x["name_b"]) for x in discriminate.similar_names(frame, "id").collect()}
    assert got == {(a, b) for k, a in enumerate(names) for b in names[k + 1 :] if difflib.SequenceMatcher(None, a, b).ratio() >= 0.8}


def test_similar_names_compare_few_pairs(spark):
    """Numbered names have the same characters; only those with enough in common and in order are compared."""
    import difflib

    from umbra.operators import subsequences

    names = [f"po-{10000 + 7 * k} {k % 97}" for k in range(1500)] + ["a long name of a report in all its parts 1", "a long name of a report in all its parts 2", "po-10000"]
    frame = spark.createDataFrame(list(enumerate(names)), "ord int, name string")
    met, rest = subsequences.pairs(frame, 0.8)
    pairs = {(r["ord_a"], r["ord_b"]) for r in met.collect()}
    assert (42, 42) in rest and len(pairs) < 20_000
    got = {(r["name_a"], r["name_b"]) for r in discriminate.similar_names(frame.withColumnRenamed("name", "name_normalized"), "ord").collect()}
    near = {(a, b) for k, a in enumerate(names) for b in names[k + 1 :] if (m := difflib.SequenceMatcher(None, a, b)).real_quick_ratio() >= 0.8 and m.quick_ratio() >= 0.8 and m.ratio() >= 0.8}
    assert got == near and len(pairs) < 2 * len(near)


def test_structure(spark):
    texts = ["", "a", "a\n\nb", "\n \n a\nb\n\t\nc\n", "# x\n####### y\n## z"]
    rows = spark.createDataFrame(list(enumerate(texts)), "id int, t string").select("id", structure.paragraphs(F.col("t")).alias("p"), structure.headings(F.col("t")).alias("h")).orderBy("id").collect()
    assert [(r["p"], r["h"]) for r in rows] == [(0, 0), (1, 0), (2, 0), (2, 0), (1, 2)]


def test_model_answers(spark):
    answers = spark.createDataFrame([("a", 'x [1] [{"type": "ORG", "value": " Acme "}] [2]'), ("b", 'so {"entities": [{"type": "person", "value": "Ann"}]} {"n": 1}'), ("c", "[{"), ("d", None)], "source string, answer string")
    got = {(r["source"], r["entity_type"], r["value"]) for r in evaluate.model_entities(answers).collect()}
    assert got == {("a", "company", "Acme"), ("b", "person", "Ann")}


def test_files(spark, tmp_path):
    for name in ("Acme - One-001.zip", "Acme - One-002.zip"):
        with zipfile.ZipFile(tmp_path / name, "w") as z:
            z.writestr("One/docs/a.txt", "mail a@b.cd")
    (tmp_path / "Beta - Two").mkdir()
    (tmp_path / "Beta - Two" / "x.txt").write_text("hello")
    (tmp_path / "Beta - Two" / "._x.txt").write_text("meta")
    (tmp_path / "notes.xlsx").write_text("")
    (tmp_path / ".hidden").mkdir()
    groups = sources.discover_projects(spark, str(tmp_path)).collect()
    assert [(g["project_name"], g["version_count"], g["versions"]) for g in groups] == [("Acme - One", 2, [1, 2]), ("Beta - Two", 1, [0])]
    assert sources.scan_directory(spark, str(tmp_path / "none")).count() == 0
    tree = sources.read_tree(spark, str(tmp_path / "Beta - Two"))
    assert [r["path"] for r in tree.collect()] == ["x.txt"]
    archives = sources.read_tree(spark, str(tmp_path)).where("path like '%.zip'")
    entries = sources.zip_entries(archives)
    assert {(r["path"], bytes(r["content"])) for r in entries.collect()} == {("One/docs/a.txt", b"mail a@b.cd")}
    built = mp.build(detect.scan_texts(sources.texts(entries)[0]), detect.ORDER)
    cleaned, failed = clean.clean_files(entries.select("path", "content").distinct(), built)
    sources.write_tree(cleaned, str(tmp_path / "out"))
    assert (tmp_path / "out/One/docs/a.txt").read_text() == "mail [EMAIL_001]" and failed.count() == 0


def test_containers():
    import io
    import struct
    import zlib

    chunk = lambda k, d: struct.pack(">I", len(d)) + k + d + struct.pack(">I", zlib.crc32(k + d))
    png = b"\x89PNG\r\n\x1a\n" + chunk(b"IHDR", b"x" * 13) + chunk(b"tEXt", b"Author\0Ann") + chunk(b"IEND", b"")
    assert b"Ann" not in clean.clean_png(png) and clean.clean_png(png).endswith(chunk(b"IEND", b""))
    jpeg = b"\xff\xd8\xff\xe0\x00\x04ab\xff\xe1\x00\x06Exif\xff\xda\x00\x02data\xff\xd9"
    assert clean.clean_jpeg(jpeg) == b"\xff\xd8\xff\xe0\x00\x04ab\xff\xda\x00\x02data\xff\xd9"
    out = io.BytesIO()
    with zipfile.ZipFile(out, "w") as z:
        z.writestr("docProps/core.xml", "<c><dc:creator>Ann</dc:creator></c>")
        z.writestr("docProps/custom.xml", "<p>secret</p>")
        z.writestr("word/document.xml", "<w:t>Ann writes</w:t>")
    done = zipfile.ZipFile(io.BytesIO(clean.clean_office(out.getvalue(), lambda t: t.replace("Ann", "[P]"))))
    assert done.namelist() == ["docProps/core.xml", "word/document.xml"]
    assert done.read("docProps/core.xml") == b"<c><dc:creator></dc:creator></c>" and done.read("word/document.xml") == b"<w:t>[P] writes</w:t>"
    with pytest.raises(ValueError):
        clean.clean_png(b"no")


def test_stream(spark, tmp_path):
    from umbra.streaming.watch import watch

    (tmp_path / "in").mkdir()
    (tmp_path / "in/a.txt").write_text("mail a@b.cd")
    watch(spark, str(tmp_path / "in"), str(tmp_path / "state"), str(tmp_path / "cp")).awaitTermination()
    (tmp_path / "in/b.txt").write_text("mail b@b.cd and a@b.cd")
    watch(spark, str(tmp_path / "in"), str(tmp_path / "state"), str(tmp_path / "cp")).awaitTermination()
    got = {r["key"]: r["placeholder"] for r in spark.read.parquet(str(tmp_path / "state/v=1")).collect()}
    assert got == {"a@b.cd": "[EMAIL_001]", "b@b.cd": "[EMAIL_002]"}


def test_reports(spark):
    from umbra.plans import reports

    rows = spark.createDataFrame([("A - One-001.zip", False), ("a - One", True), ("A - Two-003.zip", False)], "filepath string, is_dir boolean")
    from umbra.operators import catalog

    groups = catalog.groups(catalog.project_files(rows))
    text = reports.projects(groups)
    assert text.startswith("Projects: 3") and "A - Two (1 versions, latest A - Two-003.zip)" in text
    assert "0.90  A - One + a - One" in reports.consolidations(discriminate.consolidations(groups))
    hits = spark.createDataFrame([("leakage", f"f{k:02d}", "person", "Ann", "c") for k in range(12)], verify.HIT)
    text = reports.verification(hits, verify.report(hits))
    assert "leakage: FAILED, 12 hits" in text and "... and 2 more" in text and "rescan: passed" in text


def test_mapping_over_the_limit(spark):
    """Beyond the limit leak checks and replacement give the rows they give below it."""
    rows = [("a@x.org", "[EMAIL_001]", "email"), ("mail", "[WORD_002]", "word"), ("Bo", "[PERSON_001]", "person"), ("7", "[NUMBER_001]", "number"), ("Ann Lee", "[PERSON_002]", "person"), ("ann", "[PERSON_003]", "person"), ("\u0130zmir", "[PLACE_001]", "place")]
    mapping = spark.createDataFrame(rows, "original string, placeholder string, entity_type string")
    texts = spark.createDataFrame([(1, "Write A@X.ORG, or bo at 7 of ann lee; Ann"), (2, None), (3, ""), (4, "7"), (5, "nothing here"), (6, "an \u0130zmir mail to Bob")], "path long, text string")
    for mode in ("sequential", "single_pass"):
        few, many = ({r["path"]: r["cleaned"] for r in replace.apply(texts, mapping, mode=mode, limit=k).collect()} for k in (100, 3))
        assert few == many and few[4] != "7"
    few, many = (sorted(map(tuple, verify.leaks(texts, mapping, limit=k).collect())) for k in (100, 3))
    assert few == many and len(few) > 5


def test_all_consolidations(spark, monkeypatch):
    """The query returns similar companies too, as all pairs by SequenceMatcher do."""
    from difflib import SequenceMatcher

    from umbra.plans import catalogue

    names = ["Acme Corp", "acme corp", "Acme Corps", "Akme Corp", "Acme Incorporated", "Beta LLC"]
    groups = spark.createDataFrame([(f"{c} - {p} {k}", c, p) for k, c in enumerate(names) for p in ("Pro", "Mini")], "project_name string, company string, product string")
    monkeypatch.setattr(catalogue, "_projects", lambda *_: None)
    monkeypatch.setattr(catalogue.catalog, "groups", lambda _: groups)
    got = {(r["project_name_a"], r["project_name_b"]): r["confidence"] for r in catalogue.QUERIES["j5_consolidations_all"](spark, "").collect()}
    rows, want = [tuple(r) for r in groups.collect()], {}
    for a, ca, pa in rows:
        for b, cb, pb in rows:
            like = SequenceMatcher(None, ca.lower(), cb.lower()).ratio()
            if a < b and pa == pb and like >= 0.8:
                want[a, b] = pytest.approx(0.9 * like)
    assert got == want and any(v < 0.9 for v in got.values())


def test_mappings_merge_without_collision(spark):
    def made(*rows):
        return mp.build(spark.createDataFrame(list(rows), "n int, flag_type string, value string, path string"), ["n"])

    one = made((0, "person", "Ann Lee", "f"), (1, "email", "a@b.cd", "f"))
    two = made((0, "person", "Bob Ray", "g"), (1, "person", "ann lee", "g"), (2, "thing", "X-1", "g"))
    got = {r["key"]: (r["placeholder"], r["occurrence_count"], sorted(r["sources"])) for r in mp.merge([one, two]).collect()}
    assert got == {"ann lee": ("[PERSON_001]", 2, ["f", "g"]), "bob ray": ("[PERSON_002]", 1, ["g"]), "a@b.cd": ("[EMAIL_001]", 1, ["f"]), "x-1": ("[ENTITY_001]", 1, ["g"])}


def test_numbers_over_ranges(spark):
    keys = spark.range(5000).selectExpr("id as at", "cast(id as string) as key", "if(id % 5 < 4, 'A', 'B') as prefix").repartition(7)
    got = sorted(((r["prefix"], r["at"]), r["number"]) for r in mp.numbered(keys, ["at", "key"]).collect())
    assert [n for _, n in got] == [*range(1, 4001), *range(1, 1001)]
    assert mp.numbered(keys.where("at < 0"), ["at"]).count() == 0


def test_leak_counts(spark):
    texts = spark.createDataFrame([("a", "ann ANN x"), ("b", None), ("c", "bob"), ("d", "")], "path string, text string")
    mapping = spark.createDataFrame([("ann", "Ann", "[PERSON_001]", "person"), ("bob", "bob", "[PERSON_002]", "person"), ("x", "x", "[ENTITY_001]", "k")], "key string, original string, placeholder string, entity_type string")
    for limit in (10, 2):
        assert {r["path"]: r["leaks"] for r in verify.leak_counts(texts, mapping, limit=limit).collect()} == {"a": 2, "b": 0, "c": 1, "d": 0}


def test_office_texts_and_images(spark):
    import io
    import struct
    import zipfile

    packed = io.BytesIO()
    with zipfile.ZipFile(packed, "w") as z:
        z.writestr("word/document.xml", "<w:document><w:t>Ann &amp; Lee</w:t><w:t/></w:document>")
        z.writestr("docProps/core.xml", "<cp:coreProperties><dc:creator>Ann</dc:creator></cp:coreProperties>")
    sheet = io.BytesIO()
    with zipfile.ZipFile(sheet, "w") as z:
        z.writestr("xl/sharedStrings.xml", "<sst><si><t>call ann</t></si></sst>")
        z.writestr("xl/worksheets/sheet1.xml", "<c t='inlineStr'><is><t>ANN</t></is></c>")
    gif = b"GIF89a" + bytes([1, 0, 1, 0, 0, 0, 0]) + b"!\xfe\x05by an\x00" + b"," + bytes([0, 0, 0, 0, 1, 0, 1, 0, 0, 2, 2, 0x44, 1, 0]) + b";"
    chunk = lambda name, body: name + struct.pack("<I", len(body)) + body + b"\0" * (len(body) % 2)
    body = b"WEBP" + chunk(b"VP8X", bytes([0x0C] + [0] * 9)) + chunk(b"VP8 ", b"abc") + chunk(b"EXIF", b"secret")
    webp = b"RIFF" + struct.pack("<I", len(body)) + body
    rows = [("a.docx", packed.getvalue()), ("b.xlsx", sheet.getvalue()), ("c.gif", gif), ("d.webp", webp), ("e.bmp", b"BM00"), ("f.tiff", b"II*"), ("g.docx", b"no"), ("h.gif", b"no")]
    mapping = spark.createDataFrame([("ann", "Ann", "[PERSON_001]", "person")], "key string, original string, placeholder string, entity_type string")
    done, failed = clean.clean_files(spark.createDataFrame(rows, "path string, content binary"), mapping)
    got = {r["path"]: bytes(r["content"]) for r in done.collect()}
    assert set(got) == {"a.docx", "b.xlsx", "c.gif", "d.webp", "e.bmp"} and {r["path"] for r in failed.collect()} == {"f.tiff", "g.docx", "h.gif"}
    with zipfile.ZipFile(io.BytesIO(got["a.docx"])) as z:
        assert z.read("word/document.xml") == b"<w:document><w:t>[PERSON_001] &amp; Lee</w:t><w:t/></w:document>" and b"Ann" not in z.read("docProps/core.xml")
    with zipfile.ZipFile(io.BytesIO(got["b.xlsx"])) as z:
        assert b"call [PERSON_001]" in z.read("xl/sharedStrings.xml") and b"[PERSON_001]" in z.read("xl/worksheets/sheet1.xml")
    assert b"by an" not in got["c.gif"] and got["c.gif"].endswith(b";") and b"," in got["c.gif"]
    assert b"EXIF" not in got["d.webp"] and b"abc" in got["d.webp"] and got["d.webp"][20] == 0


def test_answers_in_free_text(spark):
    answers = ['see [1] {"entities": [{"type": "person", "value": "A"}]} end', 'x [{"type": "org", "value": "B", "more": [1]}] y [2', '{"entities": []} {"other": 1}', "[[", None, '[{"type": "a", "value": "b"}', '{"a": {"entities": [{"type": "t"}]}}']
    got = spark.createDataFrame([(k, a) for k, a in enumerate(answers)], "k int, a string").select("k", evaluate.salvaged("a").alias("e")).collect()
    assert {r["k"]: [(e["type"], e["value"]) for e in r["e"]] for r in got} == {0: [("person", "A")], 1: [("org", "B")], 2: [], 3: [], 4: [], 5: [], 6: [("t", "")]}


def test_catalog_of_a_version(spark):
    from umbra.operators import catalog

    files = spark.createDataFrame([("p", 1, "docs/a.pdf"), ("p", 2, "docs/a.pdf"), ("p", 2, "cad/b.step"), ("q", 9, "x.txt")], "project_name string, version int, path string")
    got = {(r["data_type"], r["file_type"], r["files"]) for r in catalog.version_catalog(files, "p").collect()}
    assert got == {("docs", "document", 1), ("cad", "cad", 1), ("docs", None, 1), ("cad", None, 1)}
    assert catalog.of_version(files, "p", 1).count() == 1 and catalog.version_catalog(files, "none").count() == 0


def test_summary_of_names(spark):
    signed = discriminate.signatures(spark.createDataFrame([("a report v1.txt", b"x"), ("a report v2.txt", b"y"), ("other.txt", b"x"), ("zzz.txt", b"w")], "path string, content binary"))
    pairs = discriminate.similar_names(signed, "path")
    assert [r["name_a"] for r in discriminate.most_similar_first(pairs).collect()] == ["a report v1"]
    assert tuple(discriminate.summary(signed, pairs).first()) == (4, 1, 2, 1, 1)


class Names:
    """Stands for a model: finds given names."""

    def predict_entities(self, text, labels, threshold):
        assert "person" in labels and threshold == 0.5
        if "boom" in text:
            raise ValueError("boom")
        return [{"label": kind, "text": name, "score": 0.91234} for name, kind in (("Ann ", "Person"), ("ANN", "person"), ("Acme", "organization"), ("Monday", "date")) if name.strip() in text]


def test_entities_by_model(spark):
    texts = spark.createDataFrame([("a", "x" * 2990 + " Ann ANN Acme Monday"), ("b", "Dr. Bob Stone"), ("c", "boom"), ("d", None)], "path string, text string")
    got = {tuple(r)[:4] for r in detect.entities_in_texts(texts, model=detect.by_model(Names, "names")).collect()}
    assert got == {("person", "Ann", "a", 0.912), ("company", "Acme", "a", 0.912), ("person", "Bob Stone", "b", 0.7)}

    def broken():
        raise OSError("no model")

    assert {r["value"] for r in detect.entities_in_texts(texts, model=detect.by_model(broken, "broken")).collect()} == {"Bob Stone"}
    counts, seconds = evaluate.compared_methods(texts.withColumnRenamed("path", "source"), {"model": detect.by_model(Names, "names"), "patterns": lambda t: detect.entities_in_texts(t, "source")})
    assert {tuple(r) for r in counts.collect()} == {("model", "person", 1), ("model", "company", 1), ("patterns", "person", 1)} and set(seconds) == {"model", "patterns"}


def test_clean_directory(spark, tmp_path):
    from umbra.plans import reports

    source, target = tmp_path / "in", tmp_path / "out"
    (source / "docs").mkdir(parents=True)
    (source / ".git").mkdir()
    (source / "docs" / "a.txt").write_text("mail a@b.cd and 555-123-4567")
    (source / "b.md").write_text("A@B.CD again")
    (source / "c.bmp").write_bytes(b"BM00")
    (source / "e.txt").write_bytes(b"\xff\xfe")
    target.mkdir()
    (target / "old.txt").write_text("a@b.cd")
    assert [r[0] for r in sources.folder_data_types(spark, str(source)).collect()] == ["docs"]
    done = pipeline.clean_directory(spark, str(source), str(target))
    assert re.fullmatch(r"mail \[EMAIL_\d{3}\] and \[PHONE_\d{3}\]", (target / "docs" / "a.txt").read_text())
    assert "[EMAIL_" in (target / "b.md").read_text() and (target / "c.bmp").read_bytes() == b"BM00" and not (target / "old.txt").exists() and not (target / "e.txt").exists()
    assert tuple(done.totals.first()) == (4, 3, 1, False)
    assert {(r["path"], r["error"]) for r in done.failures.collect()} == {("e.txt", "not UTF-8")}
    assert "e.txt: not UTF-8" in reports.directory(done)
    assert {r["key"] for r in pipeline.load_mapping(spark, str(target)).collect()} >= {"a@b.cd", "555-123-4567"}
    (source / "e.txt").unlink()
    again = pipeline.clean_directory(spark, str(source), str(target), mapping=done.mapping)
    assert tuple(again.totals.first()) == (3, 3, 0, True)
    with pytest.raises(ValueError):
        pipeline.clean_directory(spark, str(source), str(source / "docs"))


def test_index_of_many_originals():
    """Finds what occurs, in some hundred bytes an original, which are made once and not in every task."""
    import pickle
    import random

    from umbra.operators import entries

    r = random.Random(3)
    values = sorted({"".join(r.choice("ab[1é") for _ in range(r.randint(1, 12))) for _ in range(300)})
    index = entries.index_of(values)
    for _ in range(200):
        t = "".join(r.choice("ab[1é") for _ in range(r.randint(0, 60)))
        assert index.found(entries.low(t.encode())) == {k for k, v in enumerate(values) if v.lower() in t.lower()}
    many = [(f"user.{k}@mail{k % 97}.example.com", f"[EMAIL_{k:03d}]") for k in range(20_000)]
    put = replace.Replacer(many)
    assert len(pickle.dumps(put)) < 200 * len(many)
    assert put(b"to USER.77@mail77.example.com") == b"to [EMAIL_077]" and put(b"to user.77") is None


def test_verification_reads_texts_once(spark):
    built = mp.build(spark.createDataFrame([(0, "person", "Ann Lee", "f")], "n int, flag_type string, value string, path string"), ["n"])
    texts = spark.createDataFrame([("a", "by Ann Lee, [PERSON_001] [PERSON_009]"), ("b", ""), ("c", None)], "path string, text string")
    hits, _ = verify.verify(texts, built)
    assert hits._jdf.queryExecution().optimizedPlan().toString().count("Generate explode") == 1
    apart = [verify.leaks(texts, built), verify.rescan(texts, built), verify.illegible(texts.select("path", F.encode("text", "UTF-8").alias("content"))), verify.unknown_placeholders(texts, built)]
    columns = ["check_name", "file_path", "entity_type", "original", "context"]
    assert sorted(map(tuple, hits.collect())) == sorted(tuple(r) for p in apart for r in p.select(columns).collect())
