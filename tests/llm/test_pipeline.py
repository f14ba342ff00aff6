import pytest

import corpus_pipeline
from tests.llm import brute
from tests.llm.data import SCHEMA, corpus
from umbra.llm import pieces

ITEM = "which of the following words is the one that the author had in mind when the house was built"


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    path = tmp_path_factory.mktemp("tables")
    rows = corpus(9) + [(1, f"the and of it is the house. {ITEM} and so on for the rest of it", "en", "s0", 0)]
    spark.createDataFrame(rows, SCHEMA).write.parquet(f"{path}/documents.parquet")
    spark.createDataFrame([(1, ITEM), (2, None)], "item_id long, text string").write.parquet(f"{path}/benchmark.parquet")
    return str(path)


def test_stages(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    rows = {r["doc_id"]: r for r in docs.collect()}
    stages = dict(corpus_pipeline.STAGES)
    assert list(stages) == ["language", "near_copies", "passages", "benchmark_leaks", "token_ids"]

    kept = stages["language"](spark, docs, folder)
    assert kept.columns == docs.columns
    assert {r["doc_id"] for r in kept.collect()} <= {d for d, r in rows.items() if any(c.isalpha() for c in r["text"] or "")}

    want = {d for d, (_, c) in brute.jaccard_components([(d, r["text"]) for d, r in rows.items()]).items() if c == d}
    assert {r["doc_id"] for r in stages["near_copies"](spark, docs, folder).collect()} == want

    gone = brute.repeats([(d, r["text"]) for d, r in rows.items()])
    left = {r["doc_id"]: r for r in stages["passages"](spark, docs, folder).collect()}
    assert set(left) == {d for d, (n, removed, *_) in gone.items() if not removed or removed < n}
    for d, r in left.items():
        if not gone[d][1]:
            assert r["text"] == rows[d]["text"]
        else:
            assert len(r["text"].encode()) <= gone[d][0] - gone[d][1] and r["n_chars"] == len(r["text"])

    assert {r["doc_id"] for r in stages["benchmark_leaks"](spark, docs, folder).collect()} == set(rows) - {1}
    coded = stages["token_ids"](spark, docs, folder)
    vocabulary = pieces.load("/opt/tokenizers/piece_bpe_32k.model")
    assert {r["doc_id"]: r["text"] for r in pieces.decode(coded, vocabulary).collect()} == {d: r["text"] for d, r in rows.items()}


def test_run(spark, folder):
    done = corpus_pipeline.run(spark, folder).collect()
    assert done and 1 not in {r["doc_id"] for r in done} and len({r["doc_id"] for r in done}) == len(done)


def test_stages_of_odd_tables(spark, folder):
    from pyspark.sql import functions as F

    docs = spark.read.parquet(f"{folder}/documents.parquet")
    for c in ("doc", "rest", "spans", "changed", "n_bytes", "component_id", "lang_pred", "first"):
        docs = docs.withColumn(c, F.lit(c))
    for name, stage in corpus_pipeline.STAGES:
        assert stage(spark, docs.where("doc_id < 0"), folder).count() == 0
        if name != "token_ids":
            got = stage(spark, docs, folder)
            assert got.columns == docs.columns and {r["rest"] for r in got.collect()} == {"rest"}
    same = spark.createDataFrame([(k, "the house of the king is big and old and near the sea", "en", "s0", 0) for k in range(40)], SCHEMA)
    assert [r["doc_id"] for r in corpus_pipeline.near_copies(spark, same, folder).collect()] == [0]
    assert corpus_pipeline.language(spark, same.withColumn("lang", F.lit(None).cast("string")), folder).count() == 0
