import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from tests.llm import brute
from tests.llm.data import SCHEMA, corpus
from umbra.llm import components, jaccard, langid, quality, suffix
from umbra.llm import text as tx


@pytest.fixture(scope="module", params=[1, 2])
def rows(request):
    return corpus(request.param)


def spread(spark, rows):
    df = spark.createDataFrame(rows, SCHEMA).repartition(5)
    for c in ("kept", "n_words", "component_id", "n_bytes", "score", "low", "label", "query"):
        df = df.withColumn(c, F.lit("clash"))
    return df


def test_jaccard_components(spark, rows):
    want = brute.jaccard_components([(r[0], r[1]) for r in rows])
    got = jaccard.link_components(spread(spark, rows)).collect()
    assert {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in got} == want and len(got) == len(rows)


def test_jaccard_split_bucket(spark, rows):
    want = brute.jaccard_components([(r[0], r[1]) for r in rows])
    got = jaccard.link_components(spread(spark, rows), block=4).collect()
    assert {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in got} == want


def test_jaccard_tree_over_many_leaves():
    import numpy as np

    r = np.random.RandomState(0)
    bases = [np.unique(r.randint(0, 2**62, 80).astype(np.uint64)) for _ in range(40)]
    sets = []
    for b in bases:
        for _ in range(10):
            x = b.copy()
            x[: r.randint(0, 12)] = r.randint(0, 2**62)
            sets.append(np.unique(x))
    sets.sort(key=len)
    label = np.arange(len(sets))
    size = jaccard.resolution(max(map(len, sets)))
    bits, sizes = np.stack([jaccard.bitmap(s, size) for s in sets]), np.array([len(s) for s in sets])
    links = jaccard.tree_join((bits,), (sizes,), (label,), 75, lambda i, j: jaccard.similar(sets[i], sets[j], 75))
    rows = [(i, None) for i in range(len(sets))]
    parent = list(range(len(rows)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in links:
        assert jaccard.similar(sets[a], sets[b], 75)
        p, q = sorted((find(a), find(b)))
        parent[q] = p
    got = [find(x) for x in label]
    parent[:] = range(len(rows))
    for a in range(len(sets)):
        for b in range(a):
            if jaccard.similar(sets[a], sets[b], 75):
                p, q = sorted((find(a), find(b)))
                parent[q] = p
    assert got == [find(x) for x in label]
    allowed = list(range(len(sets)))
    for a, b in jaccard.tree_join((bits,), (sizes,), (label,), 75, lambda i, j: True):
        parent[:] = allowed
        p, q = sorted((find(a), find(b)))
        allowed[q] = p
    parent[:] = allowed
    for a in range(len(sets)):
        for b in range(a):
            if jaccard.similar(sets[a], sets[b], 75):
                assert find(a) == find(b)
    left, right = np.arange(0, 400, 2), np.arange(1, 400, 2)
    across = jaccard.tree_join((bits[left], bits[right]), (sizes[left], sizes[right]), (label[left], label[right]), 75, lambda i, j: jaccard.similar(sets[left[i]], sets[right[j]], 75))
    assert across and all(jaccard.similar(sets[left[i]], sets[right[j]], 75) for i, j in across)
    assert (jaccard.folded(jaccard.bitmap(sets[0], 4096), 16) == jaccard.bitmap(sets[0], 1024)).all()


def test_suffix_repeats(spark, rows):
    want = brute.repeats([(r[0], r[1]) for r in rows])
    got = suffix.repeats(spread(spark, rows)).collect()
    assert {r["doc_id"]: (r["n_bytes"], r["n_removed"], r["n_spans"], r["kept_sha256"]) for r in got} == want and len(got) == len(rows)


def test_suffix_lengths(spark, rows):
    want = brute.repeats([(r[0], r[1]) for r in rows], 40)
    got = suffix.repeats(spread(spark, rows), length=40, gram=12).collect()
    assert {r["doc_id"]: (r["n_bytes"], r["n_removed"], r["n_spans"], r["kept_sha256"]) for r in got} == want


def test_suffix_hot_anchors(spark, rows):
    r = np.random.RandomState(4)
    some = lambda n: "".join(chr(97 + c) for c in r.randint(0, 26, n))
    hot, sides = "0" * 32, [some(90) for _ in range(6)]
    rows = [(x[0], x[1]) for x in rows] + [(10_000 + k, sides[k % 6][: 90 - k % 11] + hot + sides[(k * 5 + k // 7) % 6] + some(40)) for k in range(80)]
    docs = spread(spark, [(*x, "en", "web", 0) for x in rows])
    for length, gram in [(100, 32), (40, 12), (33, 32)]:
        want = brute.repeats(rows, length)
        for limit in (1, 30):
            got = suffix.repeats(docs, length=length, gram=gram, hot=limit).collect()
            assert {x["doc_id"]: (x["n_bytes"], x["n_removed"], x["n_spans"], x["kept_sha256"]) for x in got} == want


def test_index_family_grows_geometrically(monkeypatch):
    monkeypatch.setattr(suffix, "SLICE", 64)  # so that a merge-scan has many slices
    r, index, seen = np.random.RandomState(1), suffix.IndexFamily(12), set()
    for _ in range(150):
        text = r.choice(np.array([0, 97, 98, 255], np.uint8), 90)
        at = np.arange(len(text) - 11)
        want = []
        for k in at.tolist():
            window = text[k : k + 12].tobytes()
            want.append(window in seen)
            seen.add(window)
        assert index.add(text, at).tolist() == want
    assert sum(map(len, index.levels)) == len(seen)
    assert len(index.levels) <= 14
    for level in index.levels:
        held = [level.text[k : k + 12].tobytes() for k in level.at.tolist()]
        assert held == sorted(set(held))


def test_suffix_texts_of_one_hash(spark):
    one = "".join("ab"[bin(i).count("1") % 2] for i in range(1024))
    two = one.translate(str.maketrans("ab", "ba"))
    rows = [(1, one), (2, two), (3, "x" + two + one), (4, one[:500] + "\0" * 120), (5, "\0" * 110)]
    got = suffix.repeats(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert {r["doc_id"]: (r["n_bytes"], r["n_removed"], r["n_spans"], r["kept_sha256"]) for r in got} == brute.repeats(rows)


def test_suffix_strip(spark, rows):
    docs = spread(spark, rows)
    got = {r["doc_id"]: r for r in suffix.strip(docs).collect()}
    want = brute.repeats([(r[0], r[1]) for r in rows])
    assert set(got) == {d for d, (n, gone, *_) in want.items() if not n or gone < n}
    for d, text, lang, source, n in rows:
        if d in got:
            removed = want[d][1]
            assert (got[d]["lang"], got[d]["source"], got[d]["query"]) == (lang, source, "clash")
            assert got[d]["text"] == text if not removed else len(got[d]["text"].encode()) <= want[d][0] - removed
            assert got[d]["n_chars"] == (len(got[d]["text"]) if removed else n)
    assert suffix.strip(docs.where("doc_id < 0")).count() == 0


def test_quality_counts(spark, rows):
    got = {r["doc_id"]: r for r in quality.judge(spread(spark, rows), min_rows=20).collect()}
    assert len(got) == len(rows)
    for d, text, *_ in rows:
        n, chars, symbols, dup, rep = brute.quality_counts(text)
        r = got[d]
        assert (r["n_words"], r["word_chars"], r["n_symbols"], r["n_dup_lines"], r["n_repeat_words"]) == (n, chars, symbols, dup, rep), text
        assert r["base_failed"] == (n < 50 or 100 * rep > 50 * n)
        assert not (r["kept"] and r["base_failed"])


def test_quality_follows_the_source(spark):
    rows = [(i, " ".join(f"w{i:03d}x{k}" + "#" * (i % 2 * 3) for k in range(60)), "en", "plain" if i % 2 == 0 else "marked", 0) for i in range(600)]
    rows += [(1000, " ".join(f"v{k}###" for k in range(60)), "en", "plain", 0)]
    got = {r["doc_id"]: r["kept"] for r in quality.judge(spark.createDataFrame(rows, SCHEMA)).collect()}
    assert all(got[i] for i in range(600)) and not got[1000]


@pytest.mark.parametrize("min_rows", [5, 40])
def test_quality_verdict_like_brute_force(spark, rows, min_rows):
    docs = spread(spark, rows)
    got = {r["doc_id"]: r for r in quality.judge(docs, min_rows=min_rows).collect()}
    values = {}
    for d, text, lang, source, _ in rows:
        n, chars, symbols, dup, rep = brute.quality_counts(text)
        if n >= 50 and 100 * rep <= 50 * n:
            lines = len([x for x in text.split("\n") if brute.WORD.search(x)])
            values[d] = (lang, source, [100 * chars // n, 1000 * symbols // n, 1000 * dup // lines, 1000 * rep // n])

    def fence(group, k):
        ordered = sorted(v[k] for v in group)
        spare = [max(0, x.bit_length() - 6) for x in ordered]
        low, high = [x >> s << s for x, s in zip(ordered, spare)], [((x >> s) + 1 << s) - 1 for x, s in zip(ordered, spare)]
        a, b = low[-(-len(low) * 25 // 100) - 1], high[-(-len(low) * 75 // 100) - 1]
        more = 6 * (b - a) + quality.METRICS[k][2]
        return a - more, b + more

    def group(d):
        lang, source, _ = values[d]
        for same in (lambda v: v[:2] == (lang, source), lambda v: v[0] == lang):
            if len(found := [v[2] for v in values.values() if same(v)]) >= min_rows:
                return found
        return [v[2] for v in values.values()]

    for d, *_ in rows:
        want = d in values
        for k in range(4 if want else 0):
            floor, ceiling = fence(group(d), k)
            want = want and values[d][2][k] <= ceiling and (k > 0 or values[d][2][k] >= floor)
        assert got[d]["kept"] == want


def test_quality_sketches_merge(spark):
    df = spark.range(5000).selectExpr("id % 7 as k", "id * id as v")
    whole = quality.sketch(df, ["k"], "v")
    parts = quality.sketch(df.where("id % 2 = 0"), ["k"], "v").unionByName(quality.sketch(df.where("id % 2 = 1"), ["k"], "v")).groupBy("k", "low").agg(F.sum("n").alias("n"))
    assert sorted(map(tuple, whole.collect())) == sorted(map(tuple, parts.collect()))
    for r in whole.collect():
        assert r["low"] >= 0


def test_language_held_out(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    held_out = F.crc32(F.col("doc_id").cast("string")) % 4 == 2
    model = langid.fit(docs.where(~held_out))
    got = langid.predict(docs.where(held_out), model).join(docs.select("doc_id", "lang"), "doc_id").collect()
    assert sum(r["lang"] == r["lang_pred"] for r in got) >= 0.95 * len(got)
    assert all(0 <= r["score"] <= 1 for r in got)


def test_language_edges(spark):
    rows = [(1, "le la les une", "fr"), (2, "the of and to", "en"), (3, None, "en"), (4, "12 34", None), (5, "", "fr"), (6, "the " * 30000, "en"), (7, "über Größe", "de")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string").withColumn("score", F.lit("x"))
    got = {r["doc_id"]: r for r in langid.predict(docs, langid.fit(docs)).collect()}
    assert [got[i]["lang_pred"] for i in (3, 4, 5)] == ["und"] * 3
    assert got[6]["lang_pred"] == "en" and len(got) == 7
    assert {r["doc_id"] for r in langid.keep(docs, langid.fit(docs), least=0.0).collect()} == {1, 2, 6, 7}
    nothing = docs.where("doc_id < 0")
    assert langid.predict(docs, langid.fit(nothing)).where("lang_pred <> 'und'").count() == 0
    assert langid.predict(nothing, langid.fit(docs)).count() == 0


def test_empty_tables(spark):
    none = spark.createDataFrame([], SCHEMA)
    assert jaccard.link_components(none).count() == 0
    assert suffix.repeats(none).count() == 0
    assert quality.judge(none).count() == 0


@pytest.mark.parametrize("parts", [1, 9])
def test_components(spark, parts):
    r = random.Random(3)
    links = [(i, i + 1) for i in range(300)] + [(1000, 1000 + i) for i in range(200)] + [(r.randrange(2000, 2400), r.randrange(2000, 2400)) for _ in range(350)]
    r.shuffle(links)
    parent = {}

    def find(x):
        while parent.setdefault(x, x) != x:
            x = parent[x]
        return x

    for a, b in links:
        x, y = sorted((find(a), find(b)))
        parent[y] = x
    df = spark.createDataFrame([*links, (None, 1), (2, None)], "a long, b long").repartition(parts)
    assert {tuple(r) for r in components.components(df).collect()} == {(x, find(x)) for x in parent}
    assert components.components(df.where("a < 0")).count() == 0


def test_hashes_of_like_texts():
    one = "".join("ab"[bin(i).count("1") % 2] for i in range(4096))
    two = one.translate(str.maketrans("ab", "ba"))
    for n in (1, 8, 9, 256, 1024, 4096):
        raw = np.frombuffer(f"{one[:n]} {two[:n]} {one[:n]}".encode(), np.uint8)
        h = tx.Words(raw, np.array([0]), np.array([len(raw)])).word_hashes().tolist()
        assert h[0] == h[2] != h[1]


def test_language_of_invalid_bytes_and_ties(spark):
    import pyarrow as pa

    rows = [(k, w, lang) for k, (w, lang) in enumerate([("the house of the king", "en"), ("la maison du roi", "fr"), ("le chat et la souris", "fr"), ("and this is not that", "en")] * 5)]
    model = langid.fit(spark.createDataFrame(rows, "doc_id long, text string, lang string"))
    texts = [b"the house", b"the \xff\xfe king", b"la maison", b"\xff\xfe", b"", "Größe é".encode()]
    column = pa.Array.from_buffers(pa.string(), len(texts), pa.array(texts, pa.binary()).buffers())
    alone = [model.predict(pa.Array.from_buffers(pa.string(), 1, pa.array([t], pa.binary()).buffers())) for t in texts]
    best, score = model.predict(column)
    assert best.tolist() == [int(b[0]) for b, _ in alone] and np.allclose(score, [s[0] for _, s in alone])
    assert (best >= 0).tolist() == [True, True, True, False, False, True]
    many = spark.createDataFrame([(k, f"word {chr(97 + k % 26)}{chr(97 + k // 26)}", f"l{k:03d}") for k in range(300)], "doc_id long, text string, lang string")
    assert len(langid.fit(many, sample_rows=300, epochs=1).languages) == 300
