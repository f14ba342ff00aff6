"""The queries of this subpackage, and their SQL where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F


TOKENIZERS = "/opt/tokenizers"  # where the public vocabulary files are


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op9_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tokens and digest of the ids of every document, and whether decoding gives it back."""
    from umbra.llm import pieces

    return pieces.round_trip(table(spark, sf_dir, "documents"), pieces.load(f"{TOKENIZERS}/piece_bpe_32k.model"))


def op10_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    from umbra.llm import langid

    docs = table(spark, sf_dir, "documents")
    held_out = F.crc32(F.col("doc_id").cast("string")) % 4 == 2
    model = langid.fit(docs.where(~held_out))
    return langid.predict(docs, model).select("doc_id", held_out.alias("held_out"), "lang_pred", "score")


def op1_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    from umbra.llm import quality

    return quality.judge(table(spark, sf_dir, "documents"))


def op2_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The length of every document, found again in flat token files of all documents."""
    from umbra.llm import tokencount

    ranks = tokencount.ranks(f"{TOKENIZERS}/byte_bpe_50k.tiktoken")
    return tokencount.count(table(spark, sf_dir, "documents"), ranks, end_id=50256)


RULES = [("block", "net", "/"), ("allow", "example.net", "/en/"), ("block", "example.com", "/de/"), ("allow", "org", "/fr/")]


def op3_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every page's rule and verdict; labels name pages by id, a page is bad if of low quality or toxic."""
    from umbra.llm import urls

    labels = table(spark, sf_dir, "labels").select(F.col("doc_id").alias("page_id"), F.when((F.col("quality") == 0) | (F.col("toxic") == 1), 1).otherwise(0).alias("bad"))
    return urls.judge(table(spark, sf_dir, "pages"), labels, RULES)


def op4_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    from umbra.llm import suffix

    return suffix.repeats(table(spark, sf_dir, "documents"))


def op5_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Where each document lies after four arrivals and compaction: the shard's number in the manifest, size and version."""
    import uuid

    from umbra.llm.shards import ShardedTable
    from umbra.llm.shared import shared_dir

    docs = table(spark, sf_dir, "documents")
    made = ShardedTable(spark, f"{shared_dir(spark)}/shards-{uuid.uuid4().hex}", target_bytes=64 << 20)
    for k in range(4):
        made.append(docs.where(F.pmod(F.xxhash64("doc_id"), F.lit(4)) == k))
    made.compact()
    made.vacuum()
    manifest = sorted(made.manifest(), key=lambda s: s.path)
    if not manifest:
        return docs.select("doc_id", F.lit(0).alias("shard"), F.lit(0).cast("long").alias("shard_bytes"), F.lit(0).alias("version"), F.lit("").alias("text_sha256"))
    listed = spark.createDataFrame([(s.path.rpartition("/")[2], k, s.size, s.born) for k, s in enumerate(manifest)], "file string, shard int, shard_bytes long, version int")
    rows = made.read().select("doc_id", F.element_at(F.split("_metadata.file_path", "/"), -1).alias("file"), F.sha2(F.coalesce("text", F.lit("")), 256).alias("text_sha256"))
    return rows.join(listed, "file").select("doc_id", "shard", "shard_bytes", "version", "text_sha256")


def op6_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The documents and the benchmark items they hold, re-parameterised ones included."""
    from umbra.llm import decontaminate

    return decontaminate.leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")).where("leaked").drop("leaked")


def op7_fixity_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The state of every page's record in a second replica in which one byte of each 97th record is flipped and each
    1009th record is lost."""
    from umbra.llm import fixity
    from umbra.llm.shared import cut

    record = F.col("record")
    flipped = F.concat(F.substring("record", 1, F.lit(40)), F.unhex(F.lpad(F.hex(255 - F.conv(F.hex(F.substring("record", 41, 1)), 16, 10).cast("int")), 2, "0")), F.expr("substring(record, 42)"))
    hashes = {"hash_one": F.sha2(record, 256), "hash_two": F.sha2(F.when(F.col("id") % 97 == 5, flipped).otherwise(record), 256)}
    both = cut(fixity.packed(table(spark, sf_dir, "pages"), keep=hashes))
    one, two = (x.select("archive", "offset", "n_bytes", F.col(c).alias("hash")) for x, c in ((both, "hash_one"), (both.where("id % 1009 <> 7"), "hash_two")))
    found = fixity.compared(one, two).select("archive", "offset", "status", F.col("hash_one").alias("expected"), F.col("hash_two").alias("found"))
    return both.join(found, ["archive", "offset"], "left").select(F.col("id").alias("page_id"), "archive", "offset", "n_bytes", F.coalesce("status", F.lit("intact")).alias("status"), "expected", "found")


def op8_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    from umbra.llm import jaccard

    return jaccard.link_components(table(spark, sf_dir, "documents"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (op1_quality_rules, op2_token_counts, op3_url_filters, op4_suffix_dedup, op5_sharding, op6_decontamination, op7_fixity_audit, op8_jaccard_join, op9_sentencepiece, op10_language_id)
}

SQL: dict[str, str] = {
    "op1_quality_rules": """
with d as (select doc_id, lang, source, coalesce(text, '') as t, regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+') as w from documents),
win as (select doc_id, i, array_to_string(w[i:i + 2], ' ') as v from (select doc_id, w, unnest(range(1, greatest(len(w) - 1, 1))) as i from d)),
twice as (select doc_id, i from (select doc_id, i, count(*) over (partition by doc_id, v) as k from win) where k > 1),
cover as (select doc_id, count(distinct i + j) as n from twice, (values (0), (1), (2)) as o(j) group by doc_id),
l as (select *, list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '[^\\x20\\x09-\\x0D]')) as lines from d),
c as (select l.doc_id, lang, source, cast(len(w) as bigint) as n_words, cast(coalesce(list_sum(list_transform(w, lambda x: length(x))), 0) as bigint) as word_chars,
  cast(length(t) - length(regexp_replace(t, '[#*$%&|<>]', '', 'g')) as bigint) as n_symbols, cast(len(lines) as bigint) as n_lines, cast(len(lines) - len(list_distinct(lines)) as bigint) as n_dup_lines, cast(coalesce(cover.n, 0) as bigint) as n_repeat_words
  from l left join cover on cover.doc_id = l.doc_id),
v as (select *, n_words < 50 or 100 * n_repeat_words > 50 * n_words as base_failed, case when n_words > 0 then 100 * word_chars // n_words end as word_length, case when n_words > 0 then 1000 * n_symbols // n_words end as symbols,
  case when n_words > 0 then 1000 * n_dup_lines // n_lines end as dup_lines, case when n_words > 0 then 1000 * n_repeat_words // n_words end as repeats from c),
m as (select lang, source, metric, value, greatest(0, length(bin(value)) - 6) as spare from (select lang, source, unnest(['word_length', 'symbols', 'dup_lines', 'repeats']) as metric, unnest([word_length, symbols, dup_lines, repeats]) as value from v where not base_failed)),
k as (select lang, source, metric, (value >> spare) << spare as low, ((value >> spare) << spare) + (cast(1 as bigint) << spare) - 1 as high, count(*) as n from m group by all),
g as (select 0 as level, lang, source, metric, low, high, n from k union all select 1, lang, null, metric, low, high, sum(n) from k group by all union all select 2, null, null, metric, low, high, sum(n) from k group by all),
r as (select *, sum(n) over (partition by level, lang, source, metric order by low) as upto, sum(n) over (partition by level, lang, source, metric) as n_all from g),
q as (select level, lang, source, metric, any_value(n_all) as n_rows, min(case when upto * 100 >= n_all * 25 then low end) as q25, min(case when upto * 100 >= n_all * 75 then high end) as q75 from r group by level, lang, source, metric),
f as (select *, q25 - 6 * (q75 - q25) - tolerance as lowest, q75 + 6 * (q75 - q25) + tolerance as highest from q join (values ('word_length', 100), ('symbols', 50), ('dup_lines', 300), ('repeats', 300)) as t(name, tolerance) on name = metric),
b as (select o.lang, o.source, o.metric, case when o.n_rows >= 200 then o.lowest when p.n_rows >= 200 then p.lowest else a.lowest end as lowest, case when o.n_rows >= 200 then o.highest when p.n_rows >= 200 then p.highest else a.highest end as highest
  from f as o join f as p on p.level = 1 and p.lang is not distinct from o.lang and p.metric = o.metric join f as a on a.level = 2 and a.metric = o.metric where o.level = 0),
z as (select lang, source, max(case when metric = 'word_length' then lowest end) as least, max(case when metric = 'word_length' then highest end) as most, max(case when metric = 'symbols' then highest end) as s, max(case when metric = 'dup_lines' then highest end) as u, max(case when metric = 'repeats' then highest end) as p from b group by all)
select doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, coalesce(not base_failed and word_length between least and most and symbols <= s and dup_lines <= u and repeats <= p, false) as kept, n_lines, word_length, symbols, dup_lines, repeats
from v left join z on z.lang is not distinct from v.lang and z.source is not distinct from v.source""",
    "op4_suffix_dedup": """
with b as (select doc_id, encode(coalesce(text, '')) as t from documents),
w as (select doc_id, i, t[i:i + 99] as v from (select doc_id, t, unnest(range(1, greatest(octet_length(t) - 98, 1))) as i from b)),
f as (select doc_id, i from (select doc_id, i, row_number() over (partition by v order by doc_id, i) as k from w) where k > 1),
g as (select doc_id, i, case when i > lag(i) over (partition by doc_id order by i) + 100 then 1 when lag(i) over (partition by doc_id order by i) is null then 1 else 0 end as s from f),
r as (select doc_id, min(i) as a, max(i) + 100 as e from (select doc_id, i, sum(s) over (partition by doc_id order by i) as run from g) group by doc_id, run),
k as (select doc_id, coalesce(lag(e) over (partition by doc_id order by a), 1) as a, a as e from r union all select r.doc_id, max(e), max(octet_length(t)) + 1 from r join b on r.doc_id = b.doc_id group by r.doc_id),
j as (select k.doc_id, string_agg(substring(hex(t), cast(2 * a - 1 as bigint), cast(2 * (e - a) as bigint)), '' order by a) as h from k join b on k.doc_id = b.doc_id where e > a group by k.doc_id),
n as (select doc_id, count(*) as n_spans, cast(sum(e - a) as bigint) as n_removed from r group by doc_id)
select b.doc_id, cast(octet_length(t) as bigint) as n_bytes, coalesce(n_removed, 0) as n_removed, coalesce(n_spans, 0) as n_spans,
sha256(case when n.doc_id is null then t else unhex(coalesce(h, '')) end) as kept_sha256
from b left join n on b.doc_id = n.doc_id left join j on b.doc_id = j.doc_id""",
    "op7_fixity_audit": """
with r as (select page_id, cast(page_id // 256 as varchar) as archive, encode(concat('WARC/1.1', chr(13), chr(10), 'WARC-Type: resource', chr(13), chr(10), 'WARC-Target-URI: ', coalesce(url, ''), chr(13), chr(10), 'Content-Type: text/html', chr(13), chr(10),
  'Content-Length: ', octet_length(encode(coalesce(html, ''))), chr(13), chr(10), chr(13), chr(10), coalesce(html, ''), chr(13), chr(10), chr(13), chr(10))) as record from pages),
s as (select *, cast(octet_length(record) as bigint) as n_bytes, hex(record) as h, case when page_id % 1009 = 7 then 'missing in two' when page_id % 97 = 5 then 'corrupt' else 'intact' end as status from r),
o as (select *, cast(coalesce(sum(n_bytes) over (partition by archive order by page_id rows between unbounded preceding and 1 preceding), 0) as bigint) as "offset" from s)
select page_id, archive, "offset", n_bytes, status, case when status <> 'intact' then sha256(record) end as expected,
case when status = 'corrupt' then sha256(unhex(concat(substring(h, 1, 80), translate(substring(h, 81, 2), '0123456789ABCDEF', 'FEDCBA9876543210'), substring(h, 83)))) end as found from o""",
    "op8_jaccard_join": """
with recursive w as (select doc_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\\x20\\x09-\\x0D]+') as v from documents),
s as (select distinct doc_id, unnest(list_transform(range(1, greatest(len(v) - 4, 1) + 1), lambda i: array_to_string(v[i:i + 4], ' '))) as x from w where len(v) > 0),
n as (select doc_id, count(*) as n from s group by doc_id),
l as (select a, b from (select p.doc_id as a, q.doc_id as b, count(*) as met from s p join s q on p.x = q.x and p.doc_id <> q.doc_id group by all) join n on n.doc_id = a join n as m on m.doc_id = b where 100 * met >= 75 * (n.n + m.n - met)),
c as (select doc_id as a, doc_id as b from n union select c.a, l.b from c join l on l.a = c.b)
select d.doc_id, coalesce(n.n, 0) as n_shingles, coalesce(min(c.b), d.doc_id) as component_id from documents d left join n on n.doc_id = d.doc_id left join c on c.a = d.doc_id group by d.doc_id, n.n""",
}
