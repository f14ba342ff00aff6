"""Every query of the engine, by name, with the SQL that must give the same rows.

Queries run over whole tables. Where the tables hold no case of what a detector looks for, INPUTS makes texts and names
from their rows; that SQL is the same for both engines.
"""

from __future__ import annotations

import re
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from umbra.functions import lexicon as lx, matching, naming
from umbra.operators import catalog, classify, detect, discriminate, evaluate, mapping as mp, replace, structure, verify
from umbra.session import kept

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
SQL: dict[str, str] = {}

INPUTS = {
    "projects": """select c_custkey as id,
        case c_custkey % 6 when 0 then 'Acme Corp' when 1 then 'Beta LLC' when 2 then 'acme corp' when 3 then 'Delta Inc' when 4 then 'Solo' else 'A--B' end
        || case c_custkey % 5 when 0 then ' - Widget Pro' when 1 then ' - Gizmo' when 2 then '' when 3 then ' - X - Y' else ' - C-' end
        || case c_custkey % 4 when 0 then '-20210425T055243Z' when 2 then '-20211399T000000Z' else '' end
        || case c_custkey % 7 when 0 then '-001.zip' when 1 then '-000.zip' when 2 then '-005.ZIP' when 3 then '.zip' when 4 then '' else '-' || lpad(cast(c_custkey % 1000 as string), 3, '0') || '.zip' end as name,
        c_custkey % 7 = 4 as is_dir from {customer}""",
    "paths": """select p_partkey as id, 'proj' || cast(p_partkey % 23 as string) as project, cast(p_partkey % 3 as int) as version,
        case p_partkey % 4 when 0 then 'docs/' when 1 then 'a.b/c/' when 2 then '' else 'img/x/' end
        || case p_partkey % 11 when 0 then 'Invoice Q' when 1 then 'NDA_' when 2 then 'Jane Doe ' when 3 then 'mail.me@x-y.org ' when 4 then '555-123-4567_' when 5 then 'PO-' || cast(10000 + p_partkey as string) || ' ' when 6 then '.' when 7 then 'Model AB-12 ' when 8 then '2021-03-04 ' when 9 then 'agenda ' else p_name end
        || cast(p_partkey % 97 as string)
        || case p_partkey % 17 when 0 then '.JPG' when 1 then '.pdf' when 2 then '.tar.gz' when 3 then '.hex' when 4 then '.fw' when 5 then '.step' when 6 then '.mp4' when 7 then '' when 8 then '.m4a' when 9 then '.py' when 10 then '.xyz' when 11 then '.sch' when 12 then '.docx' when 13 then '.xlsm' when 14 then '.' when 15 then '.Zip' else '.txt' end as path from {part}""",
    "texts": """select c_custkey as path,
        case c_custkey % 12
        when 0 then 'Contact Dr. John Smith, or CEO Jane  Doe at ' || c_name || ' 02139-4307 and 90210.'
        when 1 then 'We met in New York City, NY and in Germany. UK was closed, France open'
        when 2 then 'Report by Alice Brown and John Smith, Manager of University of Boston; Smith & Wesson sold it'
        when 3 then 'Mail Bob Stone <bob.stone@mail.example.com> or +49-170-1234567 today'
        when 4 then 'Acme Widget Technologies and Big Blue inc from the same Old Medical Group Holdings co. here'
        when 5 then 'Model AB-123, P/N: XY-99.1 s/n 77-ABC and Gizmo v1.2.3 are sold by Nova Labs Limited'
        when 6 then '北京市海淀区中关村大街27号 中国 100080 经理 王 先生:李'
        when 7 then 'one two three four five six seven eight Global Services LLC'
        when 8 then 'Texas and Ohio and West Virginia, 12345 or 123456 or 1234567'
        when 9 then 'Call (555) 123-4567 or 555.123.4567, mail a@b.cd; a@b.cd again'
        when 10 then '# Title' || chr(10) || chr(10) || 'First line' || chr(10) || 'second a@b.cd' || chr(10) || '  ' || chr(10) || '## Next part' || chr(10) || 'end'
        else '' end
        || ' ref ' || cast(c_custkey % 50 as string) as text from {customer}""",
    "cad": """select s_suppkey as id,
        case s_suppkey % 5 when 0 then 'a.step' when 1 then 'b.DXF' when 2 then 'c.sch' when 3 then 'd.gbr' else 'e.txt' end as path,
        case s_suppkey % 5
        when 0 then 'HEADER;' || chr(10) || 'PRODUCT(#1,''' || s_name || ''');' || chr(10) || 'Organization(''ACME '',2);' || chr(10) || 'ENDSEC;' || chr(10)
        when 1 then '  9' || chr(10) || 'AUTHOR' || chr(10) || s_name || chr(10) || 'COMPANY' || chr(10) || chr(10) || 'AUTHOR' || chr(10) || ' last ' || chr(10)
        when 2 then '<eagle><name>  </name><name> N' || cast(s_suppkey as string) || ' </name><author>Ann</author></eagle>'
        when 3 then '%FSLAX26Y26%' || chr(10) || 'SLDR+ job ' || cast(s_suppkey as string) || chr(10) || ' SLDR-'
        else 'nothing' end as content from {supplier}""",
}


def made(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    query = INPUTS[name]
    return spark.sql(query, **{t: table(spark, sf_dir, t) for t in set(re.findall(r"\{(\w+)\}", query))})


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _with(*names: str) -> str:
    return "with recursive " + ", ".join(f"{n} as ({re.sub(r'[{}]', '', INPUTS[n])})" for n in names)


def query(sql: str | None = None):
    def register(f: Query) -> Query:
        QUERIES[f.__name__] = f
        if sql:
            SQL[f.__name__] = sql
        return f

    return register


# detectors

RE2 = {"email": r"[\w\.-]+@[\w\.-]+\.\w+", "phone": r"(?:\+\d{1,3}[-.\s]\d{3,4}[-.\s]\d{3,8}|\(?\d{3}\)?[-.\s]\d{3,4}[-.\s]\d{4})"}
START = "cast(coalesce(list_sum(list_transform(g[1:i], lambda x: length(x))), 0) + coalesce(list_sum(list_transform(m[1:i-1], lambda x: length(x))), 0) as int)"


def _hits(source: str, pattern: str, detector: int, ordinal: int, kind: str, confidence: float, value: str = "m[i]", where: str = "true", path: str = "path") -> str:
    p = pattern.replace("'", "''")
    return f"""select path, {detector} as detector_ord, {ordinal} as pattern_ord, cast(i - 1 as int) as match_ord, '{kind}' as flag_type, {value} as value, {START} as start, cast({confidence} as double) as confidence, text
        from (select path, text, m, string_split_regex(text, '{p}') as g, unnest(range(1, len(m) + 1)) as i from (select {path} as path, text, regexp_extract_all(text, '{p}') as m from {source}) where len(m) > 0) where {where}"""


_CONTEXT = r"case when start > 50 then '...' else '' end || regexp_replace(replace(substring(text, greatest(0, start - 50) + 1, least(length(text), start + 50) - greatest(0, start - 50)), chr(10), ' '), '^\s+|\s+$', '', 'g') || case when start + 50 < length(text) then '...' else '' end as context"


def _companies(source: str, path: str = "path") -> str:
    keywords = ", ".join(f"({k}, '{w.replace('.', chr(92) + '.')}')" for k, w in enumerate(lx.COMPANY_KEYWORDS))
    return rf"""select path, pattern_ord, value from (select {path} as path, k as pattern_ord, unnest(regexp_extract_all(text, '(?i)[A-Z][A-Za-z]+(?:\s+[A-Z][A-Za-z]+)*\s+' || w)) as value from {source}, (values {keywords}) as kw(k, w)) where len(string_split_regex(value, '\s+')) between 2 and 5"""


@query(f"select path, flag_type, value, start, {_CONTEXT}, confidence from ({_hits('documents', RE2['email'], 1, 0, 'email', 1.0, path='doc_id')} union all {_hits('documents', RE2['phone'], 2, 0, 'phone', 1.0, path='doc_id')})")
def d1_email_phone_documents(spark, sf_dir):
    return detect.scan_texts(table(spark, sf_dir, "documents"), "doc_id", only=["email", "phone"]).select("path", "flag_type", "value", "start", "context", "confidence")


@query(f"select path, flag_type, value, start, confidence from ({_hits('pages', RE2['email'], 1, 0, 'email', 1.0, path='page_id').replace('select page_id as path, text, regexp', 'select page_id as path, html as text, regexp').replace('extract_all(text', 'extract_all(html')} union all {_hits('pages', RE2['phone'], 2, 0, 'phone', 1.0, path='page_id').replace('select page_id as path, text, regexp', 'select page_id as path, html as text, regexp').replace('extract_all(text', 'extract_all(html')})")
def d1_email_phone_pages(spark, sf_dir):
    return detect.scan_texts(table(spark, sf_dir, "pages"), "page_id", "html", only=["email", "phone"]).select("path", "flag_type", "value", "start", "confidence")


@query(f"select path, cast(pattern_ord as int) as pattern_ord, value from ({_companies('documents', 'doc_id')})")
def d1c_company_documents(spark, sf_dir):
    rows = table(spark, sf_dir, "documents").select(F.col("doc_id").alias("path"), F.explode(detect.company_flags(F.col("text"))).alias("f"))
    return rows.select("path", "f.pattern_ord", "f.value")


_ALL_BUT_COMPANY = [kind for kind in detect.DETECTORS if kind != "company"]
_LOCATIONS = [lx.US_STATES, lx.COUNTRIES]
_TEXT_FLAGS = " union all ".join(
    [
        _hits("texts", RE2["email"], 1, 0, "email", 1.0),
        _hits("texts", RE2["phone"], 2, 0, "phone", 1.0),
        _hits("texts", rf"(?:{lx.TITLES})[.\s]+[A-Z][a-z]+\s+[A-Z][a-z]+", 4, 0, "person", 0.8, r"regexp_replace(regexp_extract(m[i], '([A-Z][a-z]+\s+[A-Z][a-z]+)$', 1), '\s+', ' ')"),
        *[_hits("texts", rf"\b(?:{p})\b", 5, k, "location", 0.7, where="length(m[i]) > 2") for k, p in enumerate(_LOCATIONS)],
        *[_hits("texts", f"(?:{p})", 5, k + 2, "location", 0.7, where="length(m[i]) > 2") for k, p in enumerate([lx.COUNTRIES_CN, lx.PROVINCES_CN, lx.CITIES_CN])],
        _hits("texts", r"\b[A-Z][a-z]+(?:\s+[A-Z][a-z]+)+,?\s+(?:[A-Z]{2}|\w+)\b", 5, 5, "location", 0.7),
        _hits("texts", r"\b\d{5}(?:-\d{4})?\b", 6, 0, "address", 0.5),
        _hits("texts", r"\b\d{6}\b", 7, 0, "address", 0.4),
        _hits("texts", r"(?:[^\s]{2,10}(?:省|市|区|县|镇|乡|村|路|街|大道|巷|弄|号|室|楼|栋|座|层|楼|单元))", 8, 0, "address", 0.6),
    ]
)


@query(f"{_with('texts')} select path, detector_ord, pattern_ord, match_ord, flag_type, value, start, {_CONTEXT}, confidence from ({_TEXT_FLAGS})")
def d1_all_but_company_texts(spark, sf_dir):
    return detect.scan_texts(made(spark, sf_dir, "texts"), only=_ALL_BUT_COMPANY).drop("phase")


# Letters beyond ASCII are words too, which \w and \b do not say in the SQL: the character before is part of the match there.
_PLACES = _hits("texts", r"\b[A-Z][a-z]+(?:\s+[A-Z][a-z]+)+,?\s+(?:[A-Z]{2}|\w+)\b", 5, 5, "location", 0.7)
_WIDE = _hits("texts", r"(?:^|[^\p{L}\p{N}_])[A-Z][a-z]+(?:\s+[A-Z][a-z]+)+,?\s+[\p{L}\p{N}_]+", 5, 5, "location", 0.7)
_DOCUMENT_FLAGS = _TEXT_FLAGS.replace(_PLACES, f"select * replace (cast(start + length(value) - length(regexp_replace(value, '^[^A-Z]', '')) as int) as start, regexp_replace(value, '^[^A-Z]', '') as value) from ({_WIDE})")
_DOCUMENT_FLAGS = _DOCUMENT_FLAGS.replace("from texts)", "from (select doc_id as path, text from documents))")


@query(f"select path, detector_ord, pattern_ord, match_ord, flag_type, value, start, {_CONTEXT}, confidence from ({_DOCUMENT_FLAGS})")
def d1_all_but_company_documents(spark, sf_dir):
    return detect.scan_texts(table(spark, sf_dir, "documents"), "doc_id", only=_ALL_BUT_COMPANY).drop("phase")


@query(f"{_with('texts')} select path, cast(pattern_ord as int) as pattern_ord, value from ({_companies('texts')})")
def d1c_company_texts(spark, sf_dir):
    return detect.scan_texts(made(spark, sf_dir, "texts"), only=["company"]).select("path", "pattern_ord", "value")


@query(f"{_with('texts')} select flag_type, count(*) as flags from (select flag_type from ({_TEXT_FLAGS}) union all select 'company' from ({_companies('texts')})) group by flag_type")
def g5_flags_by_type(spark, sf_dir):
    return catalog.flags_by_type(detect.scan_texts(made(spark, sf_dir, "texts")))


_DOC = "case " + " ".join(f"when contains(lower(path), '{k}') then '{k}'" for k in lx.SENSITIVE_DOC_TYPES) + " end"


@query(f"{_with('paths')} select distinct path, flag_type, value from (select path, unnest(regexp_extract_all(path, '{RE2['email']}')) as value, 'email' as flag_type from paths union all select path, unnest(regexp_extract_all(path, '{RE2['phone']}')), 'phone' from paths union all select path, {_DOC}, 'sensitive_doc' from paths) where value is not null")
def d2_name_flags(spark, sf_dir):
    return detect.scan_names(made(spark, sf_dir, "paths")).select("path", "flag_type", "value").distinct()


_PEOPLE = r"""select path, 'person' as entity_type, a || ' ' || b as value from (
    select path, unnest(regexp_extract_all(text, p, 1)) as a, unnest(regexp_extract_all(text, p, 2)) as b from texts, (values
    ('(?:Mr|Mrs|Ms|Miss|Dr|Prof|Professor|CEO|COO|CTO|CFO|VP|Director|Manager|Engineer|President)[.:\s]+([A-Z][a-z]+)\s+([A-Z][a-z]+)'),
    ('([A-Z][a-z]+)\s+([A-Z][a-z]+),\s+(?:CEO|COO|CTO|CFO|VP|Director|Manager|Engineer|President|Owner|Founder)'),
    ('\bby\s+([A-Z][a-z]+)\s+([A-Z][a-z]+)\b'),
    ('([A-Z][a-z]+)\s+([A-Z][a-z]+)\s+<[\w.+-]+@[\w.-]+>')) as t(p)) where length(a) between 2 and 20 and length(b) between 2 and 20""" + f""" union all
    select path, 'person', unnest(regexp_extract_all(text, '(?:{lx.TITLES_CN})[\\s:]*([{lx.SURNAMES_CN}])', 1)) from texts"""
_ORGS = ", ".join(f"('{w}')" for w in lx.ORG_WORDS)
_FIRMS = rf"""select path, 'company' as entity_type, value from (select path, unnest(regexp_extract_all(text, '(?i)\b([A-Z][A-Za-z]+(?:\s+[A-Z][A-Za-z]+)*\s+' || w || ')\b', 1)) as value from texts, (values {_ORGS}) as o(w)) where len(string_split_regex(value, '\s+')) between 2 and 6
    union all select path, 'company', unnest(regexp_extract_all(text, '[A-Z][A-Za-z]+\s+&\s+[A-Z][A-Za-z]+')) from texts
    union all select path, 'company', unnest(regexp_extract_all(text, '[A-Z][A-Za-z]+\s+of\s+[A-Z][A-Za-z]+')) from texts"""
_PRODUCTS = r"""select path, 'product' as entity_type, trim(value) as value from (select path, unnest(regexp_extract_all(text, p)) as value from texts, (values
    ('(?i)(?:model|mod|mdl)[\s:-]*[A-Z0-9][-0-9A-Z]{2,10}'), ('(?i)(?:part\s*(?:no|number)\.?|p/n|pn)[\s:]*[A-Z0-9][-0-9A-Z.]{2,20}'),
    ('(?i)(?:serial\s*(?:no|number)\.?|s/n|sn)[\s:]*[A-Z0-9][-0-9A-Z.]{2,20}'), ('(?i)[A-Z][A-Za-z0-9]+\s+v\d+\.\d+(?:\.\d+)?')) as t(p)) where length(value) > 2"""
_ENTITIES = f"select distinct path as source, entity_type, value, cast(case entity_type when 'person' then 0.7 when 'company' then 0.6 else 0.5 end as double) as confidence from ({_PEOPLE} union all {_FIRMS} union all {_PRODUCTS})"


@query(f"{_with('texts')} {_ENTITIES}")
def d6_entities_texts(spark, sf_dir):
    return detect.entities_in_texts(made(spark, sf_dir, "texts")).drop("context")


@query(f"{_with('paths')}, texts as (select distinct path, path as text from paths) select source, entity_type, value, confidence + 0.1 as confidence from ({_ENTITIES})".replace("confidence + 0.1", "cast(case entity_type when 'person' then 0.8 when 'company' then 0.7 else 0.6 end as double)"))
def d7_entities_names(spark, sf_dir):
    return detect.entities_in_names(made(spark, sf_dir, "paths").select("path").distinct()).drop("context")


@query(f"{_with('texts')} select entity_type, value, min(source) as source from ({_ENTITIES}) group by entity_type, value")
def g8_entity_first_sources(spark, sf_dir):
    return discriminate.first_sources(detect.entities_in_texts(made(spark, sf_dir, "texts")))


@query(f"{_with('texts')} select source, value, confidence from ({_ENTITIES}) where entity_type = 'company'")
def f4_companies(spark, sf_dir):
    return catalog.of_type(detect.entities_in_texts(made(spark, sf_dir, "texts")), "company", "entity_type").select("source", "value", "confidence")


_BASE = "regexp_extract(path, '([^/]*)$', 1)"
_SUFFIX = rf"regexp_extract({_BASE}, '^.+(\.[^.]+)$', 1)"
_STEM = f"substring({_BASE}, 1, length({_BASE}) - length({_SUFFIX}))"
_PATTERNS = ", ".join(f"({k}, '{kind}', '{p}', {c})" for k, (kind, p, c) in enumerate([("email", RE2["email"], 0.95), ("phone", RE2["phone"], 0.85), ("person_name", r"\b[A-Z][a-z]+ [A-Z][a-z]+\b", 0.6), ("date", r"\b20\d{2}[-./]\d{1,2}[-./]\d{1,2}\b", 0.5), ("invoice_number", r"(?i)\b(?:INV|PO|PR|SO)[-#]?\d{4,}\b", 0.75), ("part_number", r"(?i)\b[P/N|][:.]?\s*[\w-]{3,}\b", 0.7)]))
_NAME_HITS = f"""select path, kind, arg_min(value, (t, i)) as value, any_value(c) as confidence from (select path, kind, c, t, generate_subscripts(m, 1) as i, trim(unnest(m)) as value from (select path, kind, c, t, regexp_extract_all(x, p) as m from (select distinct path, unnest([path, {_BASE}, {_STEM}]) as x, unnest([1, 2, 3]) as t from paths), (values {_PATTERNS}) as pt(k, kind, p, c))) where length(value) >= 3 group by path, kind, lower(value)"""


@query(f"{_with('paths')} select path, kind as pattern_type, value, cast(confidence as double) as confidence from ({_NAME_HITS})")
def d11_filename_patterns(spark, sf_dir):
    return detect.filename_patterns(made(spark, sf_dir, "paths")).select("path", "pattern_type", "value", "confidence")


@query(f"{_with('paths')} select p.path, coalesce(bool_or(h.confidence >= 0.7), false) as sensitive from (select distinct path from paths) p left join ({_NAME_HITS}) h on p.path = h.path group by p.path")
def f9_has_sensitive_patterns(spark, sf_dir):
    return detect.has_sensitive_patterns(made(spark, sf_dir, "paths"))


_LABELS = f"list_transform(regexp_extract_all({_STEM}, '{lx.DOC_KEYWORDS.replace('(?iuU)', '(?i)')}'), lambda x: lower(x))"


@query(f"{_with('paths')} select id, labels, len(labels) > 0 as is_sensitive, least(1.0, coalesce(list_sum(list_transform(labels, lambda k: case when k in ('confidential', 'nda', 'non-disclosure') then 5 else 2 end)), 0) / 10.0) as score from (select id, {_LABELS} as labels from paths)")
def d13_doc_labels(spark, sf_dir):
    path = F.col("path")
    return made(spark, sf_dir, "paths").select("id", detect.doc_labels(path).alias("labels"), (F.size(detect.doc_labels(path)) > 0).alias("is_sensitive"), F.round(detect.doc_score(path), 6).alias("score"))


@query()
def d12_doc_classifier(spark, sf_dir):
    return classify.DocClassifier(classify.default_training(spark)).predict(made(spark, sf_dir, "paths").select("path").distinct())


@query(rf"""{_with('cad')} select id, k, v from (
    select id, 'product' as k, trim(regexp_extract(content, '(?i)PRODUCT\([^)]*''([^'']+)''', 1)) as v from cad where path like '%.step'
    union all select id, 'organization', trim(regexp_extract(content, '(?i)ORGANIZATION\([^)]*''([^'']+)''', 1)) from cad where path like '%.step'
    union all select id, 'author', 'last' from cad where path like '%.DXF'
    union all select id, 'name', 'N' || id from cad where path like '%.sch'
    union all select id, 'author', 'Ann' from cad where path like '%.sch'
    union all select id, 'x_format', regexp_extract(content, '%FSLA\w+(\d+)Y(\d+)E*%', 1) from cad where path like '%.gbr'
    union all select id, 'y_format', regexp_extract(content, '%FSLA\w+(\d+)Y(\d+)E*%', 2) from cad where path like '%.gbr'
    union all select id, 'job_ticket', 'job ' || id from cad where path like '%.gbr') where v <> ''""")
def d16_cad_metadata(spark, sf_dir):
    rows = made(spark, sf_dir, "cad")
    return rows.select("id", F.explode(detect.cad_metadata(F.col("path"), F.col("content"))).alias("k", "v"))


@query(f"{_with('cad')} select id, path like '%.step' or path like '%.DXF' or path like '%.sch' as sensitive from cad")
def f10_sensitive_metadata(spark, sf_dir):
    found = detect.sensitive_metadata(detect.cad_metadata(F.col("path"), F.col("content")))
    return made(spark, sf_dir, "cad").select("id", (F.size(found) > 0).alias("sensitive"))


@query("select doc_id, cast(i as int) as piece, substring(text, i * 2800 + 1, 3000) as chunk from (select doc_id, text, unnest(range(0, (length(text) + 2799) // 2800)) as i from documents where length(text) > 0) where regexp_matches(substring(text, i * 2800 + 1, 3000), '\\S')")
def d8_model_chunks(spark, sf_dir):
    return table(spark, sf_dir, "documents").select("doc_id", F.posexplode(detect.chunks(F.col("text"))).alias("piece", "chunk"))


# names and files

_STRIPPED = r"regexp_replace(name, '-\d{8}T\d{6}Z', '')"
_VERSION = r"case when lower(name) like '%.zip' then coalesce(try_cast(nullif(regexp_extract(name, '-(\d{3})\.zip$', 1), '') as int), 0) else 0 end"
_PARSED = rf"""parsed0 as (select *, {_VERSION} as version, case when lower({_STRIPPED}) like '%.zip' then substring({_STRIPPED}, 1, length({_STRIPPED}) - 4) else {_STRIPPED} end as bare0,
    try_strptime(nullif(regexp_extract(name, '-(\d{{8}}T\d{{6}}Z)', 1), ''), '%Y%m%dT%H%M%SZ') as "timestamp" from projects),
    parsed1 as (select *, rtrim(replace(case when version > 0 then regexp_replace(bare0, '-\d{{3}}$', '') else bare0 end, '--', '-'), '-') as bare from parsed0),
    parsed as (select *, trim(case when position(' - ' in bare) > 0 then substring(bare, 1, position(' - ' in bare) - 1) else bare end) as company, trim(case when position(' - ' in bare) > 0 then substring(bare, position(' - ' in bare) + 3) else '' end) as product from parsed1),
    named as (select *, case when product <> '' then company || ' - ' || product else company end as project_name from parsed where company <> '' and name not like '.%' and (lower(name) like '%.zip' or is_dir))"""


@query(f"{_with('projects')}, {_PARSED} select id, project_name, company, product, version, \"timestamp\" from named")
def x1_parse_projects(spark, sf_dir):
    rows = made(spark, sf_dir, "projects")
    return rows.where(naming.is_project_file(F.col("name"), F.col("is_dir"))).select("id", naming.parse_project(F.col("name")).alias("p")).select("id", "p.*")


def _projects(spark, sf_dir):
    return catalog.project_files(made(spark, sf_dir, "projects").select(F.concat(F.col("id").cast("string"), F.lit("/"), "name").alias("filepath"), "is_dir"))


@query(f"{_with('projects')}, {_PARSED} select project_name, count(*) as version_count, list_sort(list(version)) as versions, arg_max(id || '/' || name, (version, id || '/' || name)) as latest_file from named group by project_name")
def g2_project_groups(spark, sf_dir):
    return catalog.groups(_projects(spark, sf_dir)).select("project_name", "version_count", "versions", "latest_file")


@query(f"{_with('projects')}, {_PARSED} select project_name, company, product, version from named where contains(lower(company), 'acme') and contains(lower(product), 'pro')")
def f1_f2_find_projects(spark, sf_dir):
    return catalog.by_product(catalog.by_company(_projects(spark, sf_dir), "ACME"), "Pro").select("project_name", "company", "product", "version")


@query(f"{_with('projects')}, {_PARSED} select id || '/' || name as filepath, project_name, version from named n where version = (select max(version) from named m where m.project_name = n.project_name)")
def o2_latest_versions(spark, sf_dir):
    return catalog.latest(_projects(spark, sf_dir)).select("filepath", "project_name", "version")


@query(f"{_with('projects')}, {_PARSED}, g as (select project_name, min(company) as company, min(product) as product from named group by project_name) select a.project_name as project_name_a, b.project_name as project_name_b, 'Same company (' || a.company || ') + product (' || a.product || ') but different project names' as reason, cast(0.9 as double) as confidence from g a join g b on lower(a.product) = lower(b.product) and a.project_name < b.project_name and lower(a.company) = lower(b.company)")
def j5_consolidations(spark, sf_dir):
    return discriminate.consolidations(catalog.groups(_projects(spark, sf_dir))).where("confidence = 0.9")


@query()
def j5_consolidations_all(spark, sf_dir):
    """With the projects of similar company names; tested by brute force."""
    return discriminate.consolidations(catalog.groups(_projects(spark, sf_dir)))


_KIND = "case " + " ".join(f"when lower({_SUFFIX}) in ({', '.join(repr(e) for e in v)}) then '{k}'" for k, v in lx.EXTENSIONS.items()) + " else 'other' end"


@query(f"{_with('paths')} select id, {_SUFFIX} as suffix, {_STEM} as stem, {_KIND} as file_type, regexp_replace(regexp_replace(trim(lower({_STEM})), '[^a-z0-9\\s-]', '', 'g'), '\\s+', ' ', 'g') as normalized from paths")
def x2_x4_classify_files(spark, sf_dir):
    path = F.col("path")
    return made(spark, sf_dir, "paths").select("id", naming.suffix(path).alias("suffix"), naming.stem(path).alias("stem"), naming.classify(path).alias("file_type"), naming.normalize(naming.stem(path)).alias("normalized"))


@query(f"{_with('paths')}, t as (select *, {_KIND} as file_type from paths) select project, version, file_type, count(*) as files from t group by grouping sets ((project, version, file_type), (project, version))")
def g1_files_by_type(spark, sf_dir):
    return catalog.count_by_type(catalog.typed(made(spark, sf_dir, "paths")), ["project", "version"])


@query(f"{_with('paths')}, t as (select *, {_KIND} as file_type from paths) select project, " + ", ".join(f"bool_or(file_type = '{k}') as {n}" for k, n in [("image", "has_images"), ("video", "has_videos"), ("document", "has_documents"), ("cad", "has_cad"), ("audio", "has_audio"), ("electronics", "has_electronics"), ("firmware", "has_firmware")]) + " from t group by project")
def f5_has_types(spark, sf_dir):
    return catalog.has_types(catalog.typed(made(spark, sf_dir, "paths")), ["project"])


_ENTRY = "list_filter(string_split('root/' || path, '/'), lambda x: x <> '')[2]"


@query(f"{_with('paths')} select project, list_sort(list(distinct {_ENTRY})) as data_types from paths group by project")
def s10_data_types(spark, sf_dir):
    return catalog.data_types(made(spark, sf_dir, "paths").withColumn("entry", F.concat(F.lit("root/"), "path")), "project")


@query(f"{_with('paths')} select count(distinct {_ENTRY}) as data_types, count(distinct project) as projects from paths")
def g4_data_type_totals(spark, sf_dir):
    return catalog.data_type_totals(made(spark, sf_dir, "paths").withColumn("entry", F.concat(F.lit("root/"), "path")), "project")


_CLEANER = "case " + " ".join(f"when lower({_SUFFIX}) in ({', '.join(repr(e) for e in v)}) then '{k}'" for k, v in lx.CLEANER_EXTENSIONS.items()) + " else 'copy' end"


@query(f"{_with('paths')} select id, {_CLEANER} as cleaner from paths")
def a17_route_files(spark, sf_dir):
    return made(spark, sf_dir, "paths").select("id", naming.cleaner(F.col("path")).alias("cleaner"))


def _signed(spark, sf_dir):
    return discriminate.signatures(table(spark, sf_dir, "documents").select("doc_id", "source", F.encode("text", "UTF-8").alias("content")), "doc_id")


@query("select content_hash, count(*) as files, list_sort(list(doc_id)) as members from (select doc_id, md5(encode(text)[1:8192]) as content_hash from documents) group by content_hash having count(*) > 1")
def g7_duplicates(spark, sf_dir):
    found = discriminate.duplicates(_signed(spark, sf_dir), ["doc_id"])
    return found.select("content_hash", "files", F.transform("members", lambda m: m["doc_id"]).alias("members"))


@query("select doc_id from (select doc_id, count(*) over (partition by md5(encode(text)[1:8192])) as n from documents) where n = 1")
def j7_unique_contents(spark, sf_dir):
    signed = _signed(spark, sf_dir)
    return signed.join(discriminate.duplicates(signed, ["doc_id"]).select("content_hash"), "content_hash", "left_anti").select("doc_id")


@query()
def j6_similar_names(spark, sf_dir):
    files = made(spark, sf_dir, "paths").select("id", naming.normalize(naming.stem(F.col("path"))).alias("name_normalized"))
    return discriminate.similar_names(files, "id")


@query("select doc_id, sha256(text) as sha256, md5(text) as md5, sha1(text) as sha1, cast(octet_length(encode(text)) as bigint) as size from documents")
def x8_x9_hashes(spark, sf_dir):
    t = F.col("text")
    return table(spark, sf_dir, "documents").select("doc_id", *[structure.text_hash(t, a).alias(a) for a in ("sha256", "md5", "sha1")], F.octet_length(F.encode(t, "UTF-8")).cast("long").alias("size"))


# mapping and replacement

_SEEN = f"seen as ({_hits('documents', RE2['email'], 1, 0, 'email', 1.0, path='doc_id')} union all {_hits('documents', RE2['phone'], 2, 0, 'phone', 1.0, path='doc_id')})"
_MAPPED = """keyed as (select lower(trim(value)) as key, trim(value) as original, flag_type, path, (path, detector_ord, match_ord) as seq from seen where trim(value) <> ''),
    firsts as (select key, arg_min(original, seq) as original, arg_min(flag_type, seq) as entity_type, min(seq) as seq, count(*) as occurrence_count, list_sort(list(distinct cast(path as string))) as sources from keyed group by key),
    mapping as (select key, original, entity_type, occurrence_count, sources, printf('[%s_%03d]', upper(entity_type), row_number() over (partition by entity_type order by seq)) as placeholder from firsts)"""


def _mapping(spark, sf_dir, sources=False):
    """Flags and mapping, each computed once."""
    flags = kept(detect.scan_texts(table(spark, sf_dir, "documents"), "doc_id", only=["email", "phone"]))
    return flags, kept(mp.build(flags, detect.ORDER, sources=sources))


@query(f"with recursive {_SEEN}, {_MAPPED} select key, original, placeholder, entity_type, sources, occurrence_count from mapping")
def a1_build_mapping(spark, sf_dir):
    return _mapping(spark, sf_dir, sources=True)[1].withColumn("sources", F.array_sort("sources"))


@query(f"with recursive {_SEEN}, {_MAPPED} select key, original, placeholder, entity_type, occurrence_count from mapping")
def a2_mapping_in_two_steps(spark, sf_dir):
    """What is seen in one half, then in the other: the same as at once, as halves are in order."""
    docs = table(spark, sf_dir, "documents")
    middle = docs.agg(F.expr("cast(percentile_approx(doc_id, 0.5) as long)")).first()[0]
    flags = kept(detect.scan_texts(docs, "doc_id", only=["email", "phone"]))
    first = mp.build(flags.where(F.col("path") <= middle), detect.ORDER)
    return mp.build(flags.where(F.col("path") > middle), detect.ORDER, known=first).drop("sources")


@query(f"with recursive {_SEEN}, {_MAPPED} select entity_type, count(*) as entities, cast(sum(occurrence_count) as bigint) as occurrences from mapping group by entity_type")
def a9_mapping_summary(spark, sf_dir):
    return mp.summary(_mapping(spark, sf_dir)[1])


@query(f"with recursive {_SEEN}, {_MAPPED} select entity_type as prefix0, upper(entity_type) as prefix, cast(count(*) as int) as counter from mapping group by entity_type".replace("entity_type as prefix0, ", ""))
def a8_mapping_round_trip(spark, sf_dir):
    return mp.counters(mp.from_json(mp.to_json(_mapping(spark, sf_dir)[1])))


_FOLD = r"""listed as (select *, row_number() over (order by -length(original), placeholder, original) as k from mapping),
    steps as (select doc_id, cast(0 as bigint) as k, text as t from documents union all select doc_id, s.k + 1, regexp_replace(s.t, regexp_escape(l.original), l.placeholder, 'gi') from steps s join listed l on l.k = s.k + 1),
    cleaned as (select doc_id, t from steps where k = (select count(*) from mapping))"""


@query(f"with recursive {_SEEN}, {_MAPPED}, {_FOLD} select c.doc_id, sha256(c.t) as cleaned_sha256, d.text <> c.t as changed from cleaned c join documents d on c.doc_id = d.doc_id")
def a4_replace_values(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    done = replace.apply(docs, _mapping(spark, sf_dir)[1])
    return done.select("doc_id", structure.text_hash(F.col("cleaned")).alias("cleaned_sha256"), (F.col("text") != F.col("cleaned")).alias("changed"))


_SPANS = """spans as (select s.path, s.start, s.start + length(s.value) as stop, m.placeholder from seen s join mapping m on lower(trim(s.value)) = m.key where flag_type = 'email'),
    pieces as (select s.path, s.start, s.stop, substring(d.text, coalesce(lag(s.stop) over w, 0) + 1, s.start - coalesce(lag(s.stop) over w, 0)) || s.placeholder as piece from spans s join documents d on d.doc_id = s.path window w as (partition by s.path order by s.start)),
    joined as (select path, count(*) as spans, string_agg(piece, '' order by start) as head, max(stop) as stop from pieces group by path)"""


@query(f"with recursive {_SEEN}, {_MAPPED}, {_SPANS} select j.path as doc_id, spans, cast(length(head) + length(substring(d.text, j.stop + 1)) - length(d.text) as decimal(38,0)) as growth, sha256(head || substring(d.text, j.stop + 1)) as cleaned_sha256 from joined j join documents d on d.doc_id = j.path")
def a6_replace_spans(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").withColumnRenamed("doc_id", "path")
    flags, mapping = _mapping(spark, sf_dir)
    flags = flags.where("flag_type = 'email'")
    spans = flags.select("path", "start", (F.col("start") + F.length("value")).alias("stop"), F.col("flag_type").alias("entity_type"), F.lit("").alias("source"))
    done = replace.replace_spans(docs, replace.span_values(spans, docs), mapping)
    counted = spans.groupBy("path").agg(F.count("*").alias("spans"))
    growth = (F.length("cleaned") - F.length("text")).cast("decimal(38,0)").alias("growth")
    return done.join(counted, "path").select(F.col("path").alias("doc_id"), "spans", growth, structure.text_hash(F.col("cleaned")).alias("cleaned_sha256"))


@query(f"with recursive {_SEEN}, {_MAPPED} select s.path as doc_id, m.key is not null as known, m.placeholder from seen s left join mapping m on lower(trim(s.value)) = m.key")
def f7_get_mapping(spark, sf_dir):
    """Every match of every document."""
    flags, mapping = _mapping(spark, sf_dir)
    return mp.get_mapping(flags.select(F.col("path").alias("doc_id"), "value"), mapping).select("doc_id", F.col("placeholder").isNotNull().alias("known"), "placeholder")


@query(f"with recursive {_SEEN}, {_MAPPED} select placeholder, original from mapping")
def f8_resolve(spark, sf_dir):
    """Every placeholder of the mapping."""
    mapping = _mapping(spark, sf_dir)[1]
    return mp.resolve(mapping.select("placeholder"), mapping)


# verification


@query(f"with recursive {_SEEN}, {_MAPPED} select cast(doc_id as string) as file_path, entity_type, original, count(*) as hits from (select d.doc_id, m.entity_type, m.original, unnest(regexp_extract_all(d.text, '(?i)' || regexp_escape(m.original))) as hit from documents d join mapping m on contains(lower(d.text), lower(m.original)) where length(m.original) >= 2) group by all")
def v1_leaks_in_originals(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    return verify.leaks(docs, _mapping(spark, sf_dir)[1], "doc_id").groupBy("file_path", "entity_type", "original").agg(F.count("*").alias("hits"))


@query(f"with recursive {_SEEN}, {_MAPPED} select level, name, hits from (with h as (select cast(doc_id as string) as file_path, entity_type, unnest(regexp_extract_all(d.text, '(?i)' || regexp_escape(m.original))) as hit from documents d join mapping m on contains(lower(d.text), lower(m.original))) select 'total' as level, '' as name, count(*) as hits from h union all select 'type', entity_type, count(*) from h group by entity_type union all select 'file', file_path, count(*) from h group by file_path)")
def g9_leak_counts(spark, sf_dir):
    return verify.by_type_and_file(verify.leaks(table(spark, sf_dir, "documents"), _mapping(spark, sf_dir)[1], "doc_id"))


@query(f"with recursive {_SEEN}, {_MAPPED}, {_FOLD} select placeholder, count(distinct doc_id) as files, count(*) as uses from (select doc_id, unnest(regexp_extract_all(t, '\\[\\w+_\\d{{3,}}\\]')) as placeholder from cleaned) group by placeholder")
def g11_placeholder_files(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    return verify.placeholder_files(replace.apply(docs, _mapping(spark, sf_dir)[1]), "doc_id", "cleaned")


@query("select * from (values (0, 'leakage', 0, 0, true), (1, 'rescan', 0, 0, true), (2, 'legibility', 0, 0, true), (3, 'consistency', 0, 0, true)) as t(check_ord, check_name, hits, files, passed)".replace("select *", "select check_ord, check_name, cast(hits as bigint) as hits, cast(files as bigint) as files, passed"))
def v7_verify_cleaned(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    mapping = _mapping(spark, sf_dir)[1]
    return verify.verify(replace.apply(docs, mapping).select("doc_id", "cleaned"), mapping, "doc_id", "cleaned")[1]


_HALF = _FOLD.replace("from mapping", "from mapping where entity_type = 'email'")


@query(f"with recursive {_SEEN}, {_MAPPED}, {_HALF}, h as (select c.doc_id, unnest(regexp_extract_all(c.t, '(?i)' || regexp_escape(m.original))) as hit from cleaned c join mapping m on contains(lower(c.t), lower(m.original)) where length(m.original) >= 2), n as (select count(*) as hits, count(distinct doc_id) as files from h) select 0 as check_ord, 'leakage' as check_name, hits, files, hits = 0 as passed from n union all select k, name, 0, 0, true from (values (1, 'rescan'), (2, 'legibility'), (3, 'consistency')) as t(k, name)")
def v7_verify_half_cleaned(spark, sf_dir):
    """Texts in which e-mail addresses only are replaced, against the whole mapping: telephone numbers are leaks."""
    docs = table(spark, sf_dir, "documents")
    mapping = _mapping(spark, sf_dir)[1]
    half = replace.apply(docs, mapping.where("entity_type = 'email'")).select("doc_id", "cleaned")
    return verify.verify(half, mapping, "doc_id", "cleaned")[1]


@query(f"{_with('texts')} select entity_type, count(*) as hits from ({_ENTITIES}) group by entity_type")
def v3_rescan_uncleaned(spark, sf_dir):
    """Every entity of texts that have not been cleaned is found again."""
    texts = made(spark, sf_dir, "texts")
    found = detect.entities_in_texts(texts)
    built = mp.build(found.withColumn("at", F.struct("source", "value")), ["at"], kind="entity_type", source="source", sources=False)
    return verify.rescan(texts, built).groupBy("entity_type").agg(F.count("*").alias("hits"))


_DAMAGED = "replace(replace(text, chr(10) || chr(10), chr(10)), '# ', '')"
_COUNTS = {"line": "len(string_split({0}, chr(10)))", "heading": r"len(list_filter(string_split({0}, chr(10)), lambda x: regexp_matches(x, '^#{{1,6}}\s+')))", "paragraph": r"len(list_filter(string_split_regex({0}, '\n\s*\n'), lambda x: regexp_matches(x, '\S')))"}


@query(f"{_with('texts')} select path, " + ", ".join(f"{c.format('text')} = {c.format(_DAMAGED)} as {k}" for k, c in _COUNTS.items()) + " from texts")
def t1_structure_of_damaged(spark, sf_dir):
    """Which counts survive when blank lines and heading marks are taken out."""
    texts = made(spark, sf_dir, "texts").withColumn("damaged", F.replace(F.replace("text", F.lit("\n\n"), F.lit("\n")), F.lit("# "), F.lit("")))
    return texts.select("path", *[structure.structure_preserved(F.col("text"), F.col("damaged"), k).alias(k) for k in _COUNTS])


_LINES = "string_split(text, chr(10))"


@query(rf"{_with('texts')} select path, cast(len({_LINES}) as int) as lines, cast(len(list_filter({_LINES}, lambda x: regexp_matches(x, '^#{{1,6}}\s+'))) as int) as headings, cast(len(list_filter(string_split_regex(text, '\n\s*\n'), lambda x: regexp_matches(x, '\S'))) as int) as paragraphs from texts")
def x11_x12_structure(spark, sf_dir):
    t = F.col("text")
    return made(spark, sf_dir, "texts").select("path", structure.lines(t).alias("lines"), structure.headings(t).alias("headings"), structure.paragraphs(t).alias("paragraphs"))


@query(f"{_with('texts')} select path, true as paragraph, true as line, true as heading, true as other, true as rest, true as formed from texts")
def t1_t3_integrity(spark, sf_dir):
    """Replacing e-mail addresses by spans leaves all else, and the structure, as it is."""
    texts = made(spark, sf_dir, "texts")
    spans = F.transform(F.coalesce(matching.matches(F.col("text"), lx.EMAIL), F.expr("cast(array() as array<struct<ord:int,start:int,stop:int,value:string>>)")), lambda m: F.struct(m["start"].alias("start"), m["stop"].alias("stop")))
    both = texts.withColumn("cleaned", F.regexp_replace("text", lx.EMAIL, "[EMAIL_001]"))
    checks = [structure.structure_preserved(F.col("text"), F.col("cleaned"), w).alias(w) for w in ("paragraph", "line", "heading", "other")]
    return both.select("path", *checks, structure.rest_unchanged(F.col("text"), F.col("cleaned"), spans).alias("rest"), structure.placeholders_formed(F.col("cleaned")).alias("formed"))


@query(f"with recursive {_SEEN}, {_MAPPED}, {_FOLD}, c as (select cast(path as string) as file_path, count(*) as n from seen group by path) select cast(d.doc_id as string) as file_path, coalesce(c.n, 0) as change_count, sha256(d.text) as original_hash, sha256(t) as cleaned_hash, cast(octet_length(encode(t)) - octet_length(encode(d.text)) as bigint) as size_diff from documents d join cleaned on cleaned.doc_id = d.doc_id left join c on c.file_path = cast(d.doc_id as string)")
def t5_file_diffs(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    flags, mapping = _mapping(spark, sf_dir)
    return structure.file_diffs(replace.apply(docs, mapping), structure.changes(flags, mapping), "doc_id").select("file_path", "change_count", "original_hash", "cleaned_hash", "size_diff")


@query(f"with recursive {_SEEN} select flag_type as entity_type, count(*) as changes from seen group by flag_type")
def g10_changes_by_type(spark, sf_dir):
    flags, mapping = _mapping(spark, sf_dir)
    return structure.changes_by_type(structure.changes(flags, mapping))


@query()
def t4_diff_summary(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    done = replace.apply(docs, _mapping(spark, sf_dir)[1])
    return done.select("doc_id", structure.diff_summary("text", "cleaned").alias("d")).select("doc_id", "d.*")


# evaluation


@query("select cast(hits as bigint) as hits, cast(truth as bigint) as truth, cast(predicted as bigint) as predicted, hits / predicted as precision, hits / truth as recall, 2 * hits / (truth + predicted) as f1 from (select count(*) filter (t and p) as hits, count(*) filter (t) as truth, count(*) filter (p) as predicted from (select toxic = 1 as t, quality = 0 as p from labels))")
def g14_accuracy(spark, sf_dir):
    labels = table(spark, sf_dir, "labels")
    found = evaluate.accuracy(labels.where("toxic = 1").select("doc_id"), labels.where("quality = 0").select("doc_id"), "doc_id")
    return found.select("hits", "truth", "predicted", "precision", "recall", "f1")


@query("with a as (select distinct lower(p_type) as v from part union select distinct lower(split_part(p_name, ' ', 1)) from part), b as (select distinct lower(p_name) as v from part), both_of as (select a.v from a, b where contains(a.v, b.v) or contains(b.v, a.v) union select b.v from a, b where contains(a.v, b.v) or contains(b.v, a.v)) select v as value, 'both' as side from both_of union all select v, 'only_a' from a where v not in (select v from both_of) union all select v, 'only_b' from b where v not in (select v from both_of)")
def j9_overlap(spark, sf_dir):
    part = table(spark, sf_dir, "part")
    a = part.select(F.lower("p_type").alias("value")).union(part.select(F.lower(F.split_part("p_name", F.lit(" "), F.lit(1))))).distinct()
    return evaluate.overlap(a, part.select(F.lower("p_name").alias("value")).distinct())


@query("select doc_id, case when length(text) > 4000 then substring(text, 1, 4000) || chr(10) || '... (truncated)' else text end as text from documents")
def x18_truncate(spark, sf_dir):
    return table(spark, sf_dir, "documents").select("doc_id", evaluate.truncated(F.col("text")).alias("text"))


_ANSWER = "'Let me think [1, 2]. ' || case c_custkey % 3 when 0 then '[{\"type\": \"Org\", \"value\": \" ' || c_name || ' \"}, {\"type\": \"person\", \"value\": \"\"}] ok' when 1 then 'so {\"entities\": [{\"type\": \"PERSON\", \"value\": \"P' || cast(c_custkey as string) || '\"}], \"n\": {}} end' else '[{broken' end"


@query("select c_custkey as source, case c_custkey % 3 when 0 then 'company' else 'person' end as entity_type, case c_custkey % 3 when 0 then c_name else 'P' || c_custkey end as value, cast(0.9 as double) as confidence from customer where c_custkey % 3 < 2")
def x19_x20_model_answers(spark, sf_dir):
    customer = table(spark, sf_dir, "customer")
    return evaluate.model_entities(customer.select(F.col("c_custkey").alias("source"), F.expr(_ANSWER).alias("answer")))




@query(f"with recursive {_SEEN}, {_MAPPED}, {_FOLD}, c as (select path as doc_id, count(*) as n from seen group by path) select d.doc_id, coalesce(c.n, 0) as found, d.text <> t as changed, sha256(t) as cleaned_sha256, cast(0 as bigint) as leaks from documents d join cleaned on cleaned.doc_id = d.doc_id left join c on c.doc_id = d.doc_id")
def anonymize_documents(spark, sf_dir):
    """E-mail addresses and telephone numbers of all documents to placeholders, and what is left of them after it."""
    docs = table(spark, sf_dir, "documents")
    flags, mapping = _mapping(spark, sf_dir)
    done = verify.leak_counts(replace.apply(docs.select("doc_id", "text"), mapping), mapping, "cleaned")
    found = flags.groupBy("path").agg(F.count("*").alias("found"))
    done = done.select("doc_id", (F.col("text") != F.col("cleaned")).alias("changed"), structure.text_hash(F.col("cleaned")).alias("cleaned_sha256"), "leaks")
    return done.join(found, done["doc_id"] == found["path"], "left").select("doc_id", F.coalesce("found", F.lit(0)).alias("found"), "changed", "cleaned_sha256", "leaks")
