import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from tests.llm.data import SCHEMA, corpus
from umbra.llm import decontaminate, fixity, queries, tokencount, urls
from umbra.llm.shards import ShardedTable

# token counts


def test_token_counts(spark):
    rows = corpus(5)
    ranks = tokencount.ranks("/opt/tokenizers/byte_bpe_50k.tiktoken")
    docs = spark.createDataFrame(rows, SCHEMA).repartition(3)
    got = {r["doc_id"]: r["n_tokens"] for r in tokencount.count(docs, ranks, 50256, block=64).collect()}
    encoding = tokencount._encoding(ranks, tokencount.PATTERN)
    assert got == {r[0]: len(encoding.encode_ordinary(r[1] or "")) for r in rows}
    assert tokencount.count(docs.where("doc_id < 0"), ranks, 50256).count() == 0


def test_long_blanks_and_vocabularies(spark):
    ranks = tokencount.ranks("/opt/tokenizers/byte_bpe_50k.tiktoken")
    encoding = tokencount._encoding(ranks, tokencount.PATTERN)
    for text in ("a" + " " * 3000 + "b", " " * 2500, "x \n" * 3 + "\n " * 1200 + "\nend", "é" + "\u2003" * 2100 + "\t", " " * 2000 + "!" + "\x1f" * 10):
        assert tokencount.encoded(encoding, text) == encoding.encode_ordinary(text)
    assert tokencount.encoded(encoding, "a" + " " * 1_000_000 + "b")
    other = {k: len(ranks) - 1 - v for k, v in ranks.items()}
    assert tokencount._encoding(other, tokencount.PATTERN).encode_ordinary("a") != encoding.encode_ordinary("a")


@pytest.mark.parametrize("block,group", [(1, 2), (3, 2), (7, 100), (1000, 3)])
def test_separator_scan(spark, block, group):
    r = np.random.RandomState(block)
    want, rows = set(), []
    for file, share in (("a", 0.3), ("b", 0.01), ("c", 0.0), ("d", 1.0), ("e", 0.1)):
        ids = np.where(r.rand(211) < share, 9, r.randint(0, 9, 211)).astype("<u2")
        at = 0
        for k, end in enumerate([*np.flatnonzero(ids == 9).tolist(), len(ids)]):
            if end < len(ids) or end > at:
                want.add((file, k, at, end - at, end < len(ids)))
            at = end + 1
        rows += [(file, k, ids[k * block : (k + 1) * block].tobytes()) for k in range(-(-len(ids) // block))]
    blocks = spark.createDataFrame(rows, "file string, block long, tokens binary").repartition(4)
    got = [tuple(x) for x in tokencount.scan(blocks, 9, group=group).collect()]
    assert set(got) == want and len(got) == len(want)


def test_flat_files(spark, tmp_path):
    ids = np.array([1, 2, 9, 9, 3, 9, 4], "<u2")
    (tmp_path / "x.bin").write_bytes(ids.tobytes())
    got = sorted(tuple(r)[1:] for r in tokencount.scan(tokencount.read_flat(spark, str(tmp_path), block=2), 9).collect())
    assert got == [(0, 0, 2, True), (1, 3, 0, True), (2, 4, 1, True), (3, 6, 1, False)]


# url filters


def rule(url):
    host = path = ""
    if url and "://" in url:
        rest = url.split("://", 1)[1]
        host = next((rest[:k] for k, c in enumerate(rest) if c in "/?#"), rest)
        tail = rest[len(host) :]
        path = next((tail[:k] for k, c in enumerate(tail) if c in "?#"), tail)
        host = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in host)
    fits = [(h + p, v) for v, h, p in queries.RULES if (host == h or host.endswith("." + h)) and path.startswith(p)]
    return host, path, *(max(fits, key=lambda f: len(f[0])) if fits else (None, None))


URLS = [None, "", "nothing", "http://", "http://A.Example.NET/en/1?x=/de/", "http://example.net", "https://xexample.net/en/1", "ftp://example.com/de/", "http://a.b.example.com/de/2#/x", "http://a.ORG/fr/", "http://org/fr/x", "http://É.net/a", "x://y://z.net/q", "http://net/", "http://net?x", "://net/x"]


@pytest.mark.parametrize("many", [False, True])
def test_url_rules(spark, many):
    pages = spark.createDataFrame(list(enumerate(URLS)), "page_id long, url string").withColumn("host", F.lit("clash")).withColumn("n", F.lit(1)).withColumn("rule", F.lit(""))
    rules = queries.RULES + [("block", f"no{k}.invalid", "/") for k in range(70 * many)]
    got = {r["page_id"]: r for r in urls.judge(pages, spark.createDataFrame([], "page_id long, bad int"), rules).collect()}
    assert len(got) == len(URLS)
    for k, url in enumerate(URLS):
        host, path, text, verdict = rule(url)
        assert (got[k]["host"], got[k]["path"], got[k]["rule"]) == (host, path, text), url
        assert got[k]["verdict"] == (verdict or "allow")


def test_url_templates(spark):
    rows, labels = [], []
    for k in range(400):
        kind = ("news", "spam", "blog", "shop")[k % 4]
        rows.append((k, f"http://site.example/{kind}/{k}.html"))
        if k % 3 == 0:
            labels.append((k, int(kind == "spam")))
    rows += [(1000 + k, f"http://site.example/user-{'abcdefghij'[k % 10]}{'klmnopqrst'[k // 10]}/home") for k in range(100)]
    got = {r["page_id"]: r for r in urls.judge(spark.createDataFrame(rows, "page_id long, url string"), spark.createDataFrame(labels, "page_id long, bad int"), []).collect()}
    for k in range(400):
        assert got[k]["verdict"] == ("block" if k % 4 == 1 else "allow")
        assert "*.html" in got[k]["template"]
    assert got[1]["template"] == "site.example/spam/*.html"
    assert got[0]["template"] == got[2]["template"]  # alike, so merged
    assert len({got[1000 + k]["template"] for k in range(100)}) == 1
    assert urls.judge(spark.createDataFrame([], "page_id long, url string"), spark.createDataFrame(labels, "page_id long, bad int"), []).count() == 0


def judged(spark, pages, labels, **given):
    """verdict and template of each url, of (page_id, url) and (page_id, bad)."""
    got = urls.judge(spark.createDataFrame(pages, "page_id long, url string"), spark.createDataFrame(labels, "page_id long, bad int"), [], **given)
    return {r["page_id"]: (r["verdict"], r["template"]) for r in got.collect()}


def test_small_share_of_a_large_host(spark):
    """200 sections of 0.5 % each: one is bad, and has labels enough; one has few labels, all bad; 50 have none."""
    pages = [(200 * k + s, f"http://big.example/section{s}x/{k}.html") for s in range(200) for k in range(60)]
    labels = [(200 * k + s, int(s in (7, 8))) for s in range(150) for k in range(60 if s == 7 else 15 if s == 8 else 30)]
    got = judged(spark, pages, labels)
    assert {s for s in range(200) for k in range(60) if got[200 * k + s][0] == "block"} == {7, 8}
    assert got[7][1] == "big.example/section7x|section8x/*.html"
    # single labels of many segments are no ground to tell them apart
    pages = [(k, f"http://big.example/page-of-{k}-x") for k in range(1000)]
    assert set(judged(spark, pages, [(k, int(k % 20 == 0)) for k in range(1000)]).values()) == {("allow", "big.example/*")}


def test_graded_branches(spark):
    """41 branches with bad rates 0.10, 0.12 .. 0.90: neighbours are alike, the ends are not."""
    pages = [(500 * s + k, f"http://graded.example/part{s}x/{k}.html") for s in range(41) for k in range(500)]
    got = judged(spark, pages, [(500 * s + k, int(k < 50 + 10 * s)) for s in range(41) for k in range(500)])
    verdicts = [got[500 * s][0] for s in range(41)]
    assert set(verdicts[:15]) == {"allow"} and set(verdicts[26:]) == {"block"}
    assert got[0][1] == got[500][1] != got[500 * 40][1]


def test_deep_paths(spark):
    """Branches that part at the sixth segment, a prefix that is a page too, and one path of a hundred segments."""
    pages = [(2 * k + s, f"http://deep.example/a/b/c/d/e/{('spam', 'fine')[s]}/{k}/") for s in range(2) for k in range(100)]
    labels = [(i, int(i % 2 == 0)) for i, _ in pages]
    pages += [(1000, "http://deep.example/a/b/c/d/e"), (1001, "http://trap.example" + "/x" * 100)]
    got = judged(spark, pages, labels)
    assert {got[2 * k] for k in range(100)} == {("block", "deep.example/a/b/c/d/e/spam/*")}
    assert {got[2 * k + 1] for k in range(100)} == {("allow", "deep.example/a/b/c/d/e/fine/*")}
    assert got[1000][1] == "deep.example/a/b/c/d/e" and got[1001] == ("allow", "trap.example" + "/x" * 100)


# decontamination

ITEM = "In 1999 the farmer Alice Moreau sold 25 kg of apples and later 25 kg of pears to a shop in town, so how many kg did Alice Moreau sell that day?"
OTHER = "A train leaves the old station at noon and meets the second train near the long bridge before the evening comes"


def leaked(spark, texts, items=((1, ITEM), (2, OTHER), (3, None), (4, "too short"), (5, "what is the exact boiling point"))):
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").withColumn("leaked", F.lit("x"))
    bench = spark.createDataFrame(list(items), "item_id long, text string")
    found = {(r["doc_id"], r["item_id"]) for r in decontaminate.leaks(docs, bench).where("leaked").collect()}
    kept = {r["doc_id"] for r in decontaminate.keep(docs, bench).collect()}
    assert kept == set(range(len(texts))) - {d for d, _ in found}
    small = {(r["doc_id"], r["item_id"]) for r in decontaminate.leaks(docs, bench, block_chars=50).where("leaked").collect()}
    assert small == found
    return found


def test_leaks(spark):
    filler = "some quite different words that stand around the rest of it"
    changed = ITEM.replace("1999", "2004").replace("25", "40").replace("Alice Moreau", "Bob Stone").replace("farmer", "farmer")
    broken = ITEM.replace("25 kg of apples", "31 lb of apples").replace("In 1999", "In 1987").replace("the farmer Alice Moreau", "the farmer Carl Weiss").replace("did Alice Moreau", "did Dora Lind")
    texts = [None, "", filler, ITEM, f"{filler} {ITEM} {filler}", f"{filler}. {changed} {filler}", f"{filler}\n{OTHER}!", OTHER.upper().lower(), "Well, what is the exact boiling point here?", "the second train near the long", broken, ITEM + " " + OTHER]
    got = leaked(spark, texts)
    assert got == {(3, 1), (4, 1), (5, 1), (6, 2), (7, 2), (8, 5), (11, 1), (11, 2)}


def test_leaks_of_slots_alone(spark):
    """Numbers and names are found as they are, and not with other values."""
    items = [(1, "What is 12 + 7 - 3 * 5?"), (2, "3 1 4 1 5 9 2 6 5 3 5 8"), (3, "name Alice Bob Carol Dave Erin Frank Grace Heidi Ivan Judy")]
    texts = ["so what is 12 + 7 - 3 * 5? yes", "so what is 13 + 8 - 4 * 6? yes", "pi has 3 1 4 1 5 9 2 6 5 3 5 8 and more", "and 3 1 4 1 5 8 2 7 5 3 5 8 is none", "they name Alice Bob Carol Dave Erin Frank Grace Heidi Ivan Judy again"]
    assert leaked(spark, texts, items) == {(0, 1), (2, 2), (4, 3)}


def test_leaks_in_running_text(spark):
    """The first word of an item is no name and no unit, also where the words before make it look like one."""
    items = [(1, "What is the capital of France"), (2, "Minutes make up how many of the hours")]
    texts = ["Q) What is the capital of France", "Q) What is the capital of Spain", "part 3 Minutes make up how many of the hours", "Q) Where is the capital of France"]
    assert leaked(spark, texts, items) == {(0, 1), (1, 1), (2, 2)}


def test_leaks_of_short_items_and_readings(spark):
    items = ((1, "What is it?"), (2, "Paris"), (3, None), (4, "..."), (5, "Add 3 apples to 4 apples and then add 5 apples to 6 apples for her"))
    docs = ["what is it", "Well, what is it now then", "paris!", "He went to paris once", "?", items[4][1].replace("3", "7").replace("4", "8").replace("5", "9").replace("6", "10"), items[4][1].replace("3", "2").replace("4", "2").replace("5", "2").replace("6", "2")]
    got = {(r["doc_id"], r["item_id"]): r["leaked"] for r in decontaminate.leaks(spark.createDataFrame([(k, t, 0) for k, t in enumerate(docs)], "doc_id int, text string, n_found int"), spark.createDataFrame(items, "item_id int, text string")).collect()}
    assert {k for k, v in got.items() if v} == {(0, 1), (2, 2), (5, 5)} and (6, 5) in got


def test_leaks_brute_force(spark):
    """Without slots the operator is: half of the item's word windows stand in the document."""
    r = random.Random(7)
    words = ["".join(r.choice("abcdef") for _ in range(4)) for _ in range(30)]
    items = [(k, " ".join(r.choice(words) for _ in range(r.randint(5, 20)))) for k in range(20)]
    texts = []
    for k in range(40):
        w = r.choice(items)[1].split()
        a = r.randint(0, 6)
        texts.append(" ".join([*(r.choice(words) for _ in range(5)), *w[a:], *(r.choice(words) for _ in range(5))]))
    want = set()
    for d, text in enumerate(texts):
        w = text.split()
        for i, item in items:
            v = item.split()
            n = min(8, len(v))
            mine = [tuple(v[k : k + n]) for k in range(len(v) - n + 1)]
            have = {tuple(w[k : k + n]) for k in range(len(w) - n + 1)}
            if sum(m in have for m in mine) >= 0.5 * len(mine):
                want.add((d, i))
    assert leaked(spark, texts, items) == want


# fixity


def test_fixity(spark):
    r = random.Random(2)
    pages = spark.createDataFrame([(k, f"http://x/{k}", None if k == 5 else "y" * r.randint(0, 50)) for k in range(300)], "page_id long, url string, html string")
    one = fixity.packed(pages, records=100)
    assert one.groupBy("archive").count().count() == 3
    base = {(x["archive"], x["offset"]): bytes(x["record"]) for x in one.collect()}
    keys = sorted(base)
    hurt, lost = set(r.sample(keys, 7)), set(r.sample(keys, 3))
    hurt -= lost
    rows = [(a, o, base[a, o][:-1] + b"?" if (a, o) in hurt else base[a, o]) for a, o in keys if (a, o) not in lost]
    two = spark.createDataFrame(rows, "archive string, offset long, record binary")
    got = {(x["archive"], x["offset"]): x["status"] for x in fixity.audit(one.select("archive", "offset", "record"), two, fan_out=4, span=100).collect()}
    assert got == {k: "corrupt" for k in hurt} | {k: "missing in two" for k in lost}
    assert fixity.audit(one.select("archive", "offset", "record"), one.select("archive", "offset", "record")).count() == 0
    leaf = fixity.leaves(one)
    assert fixity.root(fixity.trees(leaf)) == fixity.root(fixity.trees(leaf.repartition(7))) != fixity.root(fixity.trees(fixity.leaves(two)))
    none = two.where("offset < 0")
    assert fixity.audit(none, none).count() == 0
    assert fixity.audit(none, two).where("status <> 'missing in one'").count() == 0
    ranges = [x.join(y, ["archive", "node"]).where(x["hash"] != y["hash"]).count() for x, y in zip(fixity.trees(leaf, 4, 100), fixity.trees(fixity.leaves(two), 4, 100))]
    assert 0 < ranges[1] <= 10  # a lost record changes its own range, not those after it
    double = spark.createDataFrame([("a", 0, b"x"), ("a", 0, b"y"), (None, 3, b"z"), ("b", 1, None)], "archive string, offset long, record binary").withColumn("node", F.lit("clash"))
    assert fixity.audit(double, double.orderBy("record")).where("archive is not null").count() == 0
    assert [x["status"] for x in fixity.audit(double, double.where("record is null or record <> x'79'")).where("archive is not null").collect()] == ["corrupt"]


def test_warc_files(spark, tmp_path):
    import gzip

    records = [fixity.render(f"http://x/{k}", b"body %d WARC/ \r\n\r\n" % k) for k in range(5)]
    (tmp_path / "a.warc").write_bytes(b"".join(records))
    (tmp_path / "b.warc.gz").write_bytes(b"".join(gzip.compress(x) for x in records))
    got = fixity.read_warc(spark, str(tmp_path)).collect()
    for name in ("a.warc", "b.warc.gz"):
        mine = sorted((x["offset"], bytes(x["payload"]), x["target"]) for x in got if x["archive"].endswith(name))
        assert [m[1:] for m in mine] == [(b"body %d WARC/ \r\n\r\n" % k, f"http://x/{k}") for k in range(5)]
        assert [m[0] for m in mine] == [sum(map(len, records[:k])) for k in range(5)]


# shards


def test_shards(spark, tmp_path):
    rows = corpus(6)
    docs = spark.createDataFrame(rows, SCHEMA)
    made = ShardedTable(spark, f"file://{tmp_path}/t", target_bytes=40_000, run=3)
    for k in range(6):
        made.append(docs.where(F.col("doc_id") / 3 % 6 == k).repartition(2))
    before = made.manifest()
    assert made.versions() == [1, 2, 3, 4, 5, 6] and len(before) == 12
    assert made.compact() >= 1
    after = made.manifest()
    assert len(after) < len(before)
    assert sorted(map(repr, made.read().select(docs.columns).collect())) == sorted(map(repr, docs.collect()))
    assert made.read(6).count() == len(rows)  # an older version is whole until it is vacuumed
    with pytest.raises(RuntimeError):
        made.commit(after, made.versions()[-1] - 1)
    assert made.vacuum() > 0 and made.read().count() == len(rows)
    empty = ShardedTable(spark, f"file://{tmp_path}/u")
    empty.append(docs.where("doc_id < 0"))
    assert empty.manifest() == [] and empty.compact() == 0


def test_shards_of_other_columns(spark, tmp_path):
    made = ShardedTable(spark, f"file://{tmp_path}/t", run=2)
    made.append(spark.range(3).selectExpr("id", "cast(null as long) as size", "'a' as path").coalesce(1))
    made.append(spark.range(3, 5).selectExpr("id", "id as more", "'b' as path").coalesce(1))
    with pytest.raises(ValueError):
        made.append(spark.range(1).selectExpr("cast(id as string) as id"))
    want = [(0, None, "a", None), (1, None, "a", None), (2, None, "a", None), (3, None, "b", 3), (4, None, "b", 4)]
    for _ in range(2):
        assert sorted(tuple(r) for r in made.read().select("id", "size", "path", "more").collect()) == want
        made.compact()
    assert len(made.manifest()) == 1
    made.vacuum()
    assert sorted(tuple(r) for r in made.read().select("id", "size", "path", "more").collect()) == want


def test_shards_of_two_writers(spark, tmp_path):
    from concurrent.futures import ThreadPoolExecutor

    made = ShardedTable(spark, f"file://{tmp_path}/t")

    def write(_):
        try:
            return made.commit([], 0)
        except RuntimeError:
            return None

    with ThreadPoolExecutor(8) as pool:
        assert sorted(map(str, pool.map(write, range(8)))) == ["1"] + ["None"] * 7
    assert made.versions() == [1]
