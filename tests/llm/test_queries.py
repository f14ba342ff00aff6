"""The registered queries, each over whole small tables, beside brute force; and the template tree of URL filters."""

import hashlib
import math
import random
import re
import zlib

import pytest

import corpus_pipeline
from tests.llm import brute
from tests.llm.data import SCHEMA, corpus
from umbra.llm import pieces, queries, tokencount, urls

ITEM = "which of the following words is the one that the author had in mind when the house was built"


@pytest.fixture(scope="module")
def tables(spark, tmp_path_factory):
    path, r = str(tmp_path_factory.mktemp("queries")), random.Random(4)
    rows = corpus(11) + [(1, f"the and of it is the house. {ITEM} and so on for the rest of it", "en", "s0", 0)]
    pages = [(k, r.choice(["http://a.example/x/%d" % k, "https://b.net/en/p%d.html" % (k % 9), None, "no url", "http://example.com/de/%d?q=1" % k]), r.choice(["<p>x</p>" * r.randint(0, 9), None])) for k in range(300)]
    labels = [(k, int(k % 3 > 0), int(k % 7 == 0)) for k in range(0, 300, 2)]
    spark.createDataFrame(rows, SCHEMA).repartition(3).write.parquet(f"{path}/documents.parquet")
    spark.createDataFrame(pages, "page_id long, url string, html string").write.parquet(f"{path}/pages.parquet")
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{path}/labels.parquet")
    spark.createDataFrame([(1, ITEM), (2, None)], "item_id long, text string").write.parquet(f"{path}/benchmark.parquet")
    return path, {d: t for d, t, *_ in rows}, pages


def found(spark, tables, name):
    rows = queries.QUERIES[name](spark, tables[0]).collect()
    key = "page_id" if "page_id" in rows[0] else "doc_id"
    return {r[key]: r for r in rows} if len({r[key] for r in rows}) == len(rows) else rows


def test_op1(spark, tables):
    got = found(spark, tables, "op1_quality_rules")
    assert list(got[1].asDict())[:8] == ["doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept"]
    assert {d: tuple(r)[1:6] for d, r in got.items()} == {d: brute.quality_counts(t) for d, t in tables[1].items()}


def test_op2(spark, tables):
    encoding = tokencount._encoding(tokencount.ranks("/opt/tokenizers/byte_bpe_50k.tiktoken"), tokencount.PATTERN)
    got = found(spark, tables, "op2_token_counts")
    assert {d: r["n_tokens"] for d, r in got.items()} == {d: len(encoding.encode_ordinary(t or "")) for d, t in tables[1].items()}


def test_op4_and_op8(spark, tables):
    docs = list(tables[1].items())
    assert {d: tuple(r)[1:5] for d, r in found(spark, tables, "op4_suffix_dedup").items()} == brute.repeats(docs)
    assert {d: tuple(r)[1:3] for d, r in found(spark, tables, "op8_jaccard_join").items()} == brute.jaccard_components(docs)


def test_op5(spark, tables):
    got = found(spark, tables, "op5_sharding")
    assert {d: r["text_sha256"] for d, r in got.items()} == {d: hashlib.sha256((t or "").encode()).hexdigest() for d, t in tables[1].items()}
    assert {r["shard"] for r in got.values()} == set(range(max(r["shard"] for r in got.values()) + 1))


def test_op6(spark, tables):
    got = queries.op6_decontamination(spark, tables[0]).collect()
    assert [(r["doc_id"], r["item_id"]) for r in got] == [(1, 1)]


def test_op7(spark, tables):
    got = found(spark, tables, "op7_fixity_audit")
    assert {p: r["status"] for p, r in got.items()} == {p: "missing in two" if p % 1009 == 7 else "corrupt" if p % 97 == 5 else "intact" for p, *_ in tables[2]}
    for p, url, html in tables[2]:
        if got[p]["expected"]:
            body = (html or "").encode()
            record = f"WARC/1.1\r\nWARC-Type: resource\r\nWARC-Target-URI: {url or ''}\r\nContent-Type: text/html\r\nContent-Length: {len(body)}\r\n\r\n".encode() + body + b"\r\n\r\n"
            assert got[p]["expected"] == hashlib.sha256(record).hexdigest()


def test_op9(spark, tables):
    got = found(spark, tables, "op9_sentencepiece")
    assert all(r["intact"] for r in got.values()) and set(got) == set(tables[1])
    coded = corpus_pipeline.token_ids(spark, spark.read.parquet(f"{tables[0]}/documents.parquet"), tables[0])
    for r in coded.collect():
        ids = b"".join(i.to_bytes(4, "little") for i in r["ids"] or [])
        assert (len(r["ids"] or []), hashlib.sha256(ids).hexdigest()) == (got[r["doc_id"]]["n_tokens"], got[r["doc_id"]]["ids_sha256"])
    assert pieces.load(f"{queries.TOKENIZERS}/piece_bpe_32k.model").byte_ids


def test_op10(spark, tables):
    got = found(spark, tables, "op10_language_id")
    assert set(got) == set(tables[1])
    for d, r in got.items():
        assert r["held_out"] == (zlib.crc32(str(d).encode()) % 4 == 2) and 0 <= r["score"] <= 1
        assert (r["lang_pred"] == "und") == (not any(c.isalpha() for c in tables[1][d] or "")) and r["lang_pred"] in ("und", "en", "fr")


# the template tree in plain Python


def plain_tree(pages, marks, share=0.01, z=1.96, smooth=10.0, least_labels=20, least_rows=3):
    """{page: (template, rate)} of (page, host, segments) and {page: (labels, bad)}."""
    total_l, total_b = sum(x for x, _ in marks.values()), sum(b for _, b in marks.values())
    overall = (total_b + 1) / (total_l + 2)
    out = {}

    def count(rows):
        return sum(marks.get(p, (0, 0))[0] for p, *_ in rows), sum(marks.get(p, (0, 0))[1] for p, *_ in rows)

    def term(part, whole, rate):
        return part * math.log(part / (whole * rate)) if part > 0 else 0.0

    def apart(a, b):
        if not a[0] or not b[0]:
            return False
        pooled = (a[1] + b[1]) / (a[0] + b[0])
        return abs(a[1] / a[0] - b[1] / b[0]) > z * math.sqrt(pooled * (1 - pooled) * (1 / a[0] + 1 / b[0]))

    def grow(rows, node, k):
        if len({s for _, _, s in rows}) == 1:
            for p, _, s in rows:
                out[p] = "/".join([*([node] if node else []), *s[k:]])
            return
        groups = {}
        for row in rows:
            groups.setdefault(row[2][k] if len(row[2]) > k else "", []).append(row)
        l_all, b_all = count(rows)
        siblings = sum(count(g)[0] > 0 for g in groups.values())
        branches = {}
        for segment, g in groups.items():
            l, b = count(g)  # noqa: E741
            stays = segment == "" or len(g) >= max(share * len(rows), least_rows) or l >= least_labels
            if not stays and l and l_all > l:
                rate, m, c = b_all / l_all, l_all - l, b_all - b
                stays = 2 * (term(b, l, rate) + term(l - b, l, 1 - rate) + term(c, m, rate) + term(m - c, m, 1 - rate)) > z * z + 2 * math.log(siblings)
            branches.setdefault(segment if stays else "*", []).extend(g)
        prior = (b_all + smooth * overall) / (l_all + smooth)
        listed = sorted((((count(g)[1] + smooth * prior) / (count(g)[0] + smooth), *count(g)), s) for s, g in branches.items() if s)
        clusters, pooled, first = [], (0, 0), (0, 0)
        for me, s in listed:
            if clusters and (apart(me[1:], pooled) or apart(me[1:], first)):
                clusters.append([s])
                pooled = first = me[1:]
            else:
                if not clusters:
                    clusters.append([])
                clusters[-1].append(s)
                first = me[1:] if not first[0] else first
                pooled = pooled[0] + me[1], pooled[1] + me[2]
        for members in clusters:
            name = "|".join(sorted(members)[: urls.NAMES]) + (f"|+{len(members) - urls.NAMES}" if len(members) > urls.NAMES else "")
            grow([r for s in members for r in branches[s]], "/".join([*([node] if node else []), name]), k + 1)
        for p, *_ in branches.get("", []):
            out[p] = node

    hosts = {}
    for row in pages:
        hosts.setdefault(row[1], []).append(row)
    for rows in hosts.values():
        grow(rows, "", 0)
    rates = {}
    for host, rows in hosts.items():
        l_host, b_host = count(rows)
        host_rate = (b_host + smooth * overall) / (l_host + smooth)
        for template in {out[p] for p, *_ in rows}:
            l, b = count([r for r in rows if out[r[0]] == template])  # noqa: E741
            rates[host, template] = (b + smooth * host_rate) / (l + smooth)
    return {p: ("/".join([h, out[p]]) if out[p] else h + "/", rates[h, out[p]]) for p, h, _ in pages}


def plain_form(segment):
    stem, extension = re.fullmatch(r"(.*?)((?:\.[A-Za-z][A-Za-z0-9]{0,4})?)", segment, re.S).groups()
    wild = re.search(r"^[0-9][0-9_.-]*$", stem) or re.search(r"^[0-9a-fA-F-]{8,}$", stem) and re.search("[0-9]", stem)
    return "*" + extension if wild else segment


@pytest.mark.parametrize("seed", range(3))
def test_templates_like_brute_force(spark, seed):
    r = random.Random(seed)
    rows, labels = [], []
    for k in range(900):
        host = r.choice(["big.example", "big.example", "big.example", "small.example", "x.example"])
        parts = [r.choice(["news", "spam", "shop", f"slug-{r.choice('abcdefgh')}{r.choice('klmnop')}-q"])]
        if r.random() < 0.8:
            parts.append(r.choice(["a", "b", "cc", str(k), f"{k}.html", f"t{k % 50}z"]))
        if r.random() < 0.2:
            parts.append(r.choice(["deep", "more", "spam"]))
        rows.append((k, host, tuple(map(plain_form, parts)), f"http://{host}/" + "/".join(parts)))
        for _ in range(r.choice([0, 0, 1, 1, 2])):
            labels.append((k, int(r.random() < (0.9 if "spam" in parts else 0.1))))
    marks = {}
    for p, bad in labels:
        marks[p] = marks.get(p, (0, 0))[0] + 1, marks.get(p, (0, 0))[1] + bad
    want = plain_tree([x[:3] for x in rows], marks)
    got = urls.judge(spark.createDataFrame([(k, u) for k, _, _, u in rows], "page_id long, url string"), spark.createDataFrame(labels, "page_id long, bad int"), []).collect()
    assert {x["page_id"]: x["template"] for x in got} == {p: t for p, (t, _) in want.items()}
    for x in got:
        assert math.isclose(x["bad_rate"], want[x["page_id"]][1]) and x["verdict"] == ("block" if x["bad_rate"] > 0.5 else "allow")
    assert {x["verdict"] for x in got} == {"block", "allow"}
