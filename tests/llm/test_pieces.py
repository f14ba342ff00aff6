import random

import pyarrow as pa
import pytest

from tests.llm.data import SCHEMA, corpus
from umbra.llm import pieces

MODEL = "/opt/tokenizers/piece_bpe_32k.model"


@pytest.fixture(scope="module")
def vocabulary():
    return pieces.load(MODEL)


def best(vocabulary, text):
    """Viterbi over all pieces by dictionary, the longest last piece on a tie."""
    data = b"\xff" + text.encode().replace(b" ", b"\xff")
    table = {p: (i, s) for p, i, s in zip(vocabulary.pieces, vocabulary.ids, vocabulary.scores)}
    longest, unknown = max(map(len, table)), min(vocabulary.scores) - 10
    score, back = [0.0] + [float("-inf")] * len(data), [None] * (len(data) + 1)
    for e in range(1, len(data) + 1):
        for a in range(max(0, e - longest), e):
            if (p := table.get(data[a:e])) and score[a] + p[1] > score[e]:
                score[e], back[e] = score[a] + p[1], (a, [p[0]])
        if e == len(data) or data[e] & 0xC0 != 0x80:
            a = e - 1
            while data[a] & 0xC0 == 0x80:
                a -= 1
            if score[a] + unknown > score[e]:
                score[e], back[e] = score[a] + unknown, (a, [vocabulary.byte_ids[b] for b in data[a:e]])
    out, e = [], len(data)
    while e:
        a, ids = back[e]
        out, e = ids + out, a
    return out


TEXTS = ["", "a", " ", "  a  b ", "hello world", "Hello   wörld 世界 ▁x\n\ttab", "\ufffd\u0000", "😀😀 naïve", "x" * 300, "the " * 50 + "end", "▁▁ ▁", "ab\u2581cd"]


def test_like_brute_force(vocabulary):
    r = random.Random(3)
    letters = "abcdefghij éßñ中文😀▁\n  etaoin"
    texts = TEXTS + ["".join(r.choice(letters) for _ in range(r.randint(1, 90))) for _ in range(150)]
    encoder, decoder = pieces.Encoder(vocabulary), pieces.Decoder(vocabulary)
    for _ in range(2):  # the second time from memory
        ids, edges = encoder.encode(pa.array(texts))
        got = [ids[a:b].tolist() for a, b in zip(edges[:-1], edges[1:])]
        assert got == [best(vocabulary, t) if t else [] for t in texts]
        assert decoder.decode(ids, edges) == texts


def test_memory_is_bounded(vocabulary, monkeypatch):
    monkeypatch.setattr(pieces, "MEMORY", 50)
    encoder, decoder = pieces.Encoder(vocabulary), pieces.Decoder(vocabulary)
    for k in range(5):
        texts = [f"word{k}x{i} again" for i in range(60)]
        ids, edges = encoder.encode(pa.array(texts))
        assert decoder.decode(ids, edges) == texts and len(encoder.known) <= 50


def test_frames(spark, vocabulary):
    rows = corpus(4)
    docs = spark.createDataFrame(rows, SCHEMA)
    coded = pieces.encode(docs, vocabulary, keep=["lang"])
    back = {r["doc_id"]: r["text"] for r in pieces.decode(coded, vocabulary).collect()}
    assert back == {r[0]: r[1] for r in rows}
    trip = pieces.round_trip(docs, vocabulary).collect()
    assert all(r["intact"] for r in trip) and len(trip) == len(rows)
    assert {r["doc_id"]: r["n_tokens"] for r in trip} == {r["doc_id"]: len(r["ids"] or []) for r in coded.collect()}
    assert pieces.encode(docs.where("doc_id < 0"), vocabulary).count() == 0
