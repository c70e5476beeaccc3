"""The pipeline's near-duplicate stage against a comparison of all pairs."""

import random

import corpus_pipeline
from tidebook.llm import near_copies


def shingles(text):
    w = text.lower().encode().split()
    return {tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))}


def jaccard(a, b):
    return len(a & b) / len(a | b)


def texts():
    """Texts with copies that differ in some words, some above and some below the similarity, and chains of copies."""
    draw = random.Random(3)
    words = [f"w{k}" for k in range(2000)]
    out = []
    for k in range(60):
        text = draw.choices(words, k=draw.randint(60, 400))
        out.append(" ".join(text))
        for _ in range(k % 4):
            text = list(text)
            for at in draw.sample(range(len(text)), max(1, len(text) * (k % 7) // 100)):
                text[at] = "changed"
            out.append(" ".join(text))
    return out


def brute(sets):
    root = list(range(len(sets)))
    for a in range(len(sets)):
        for b in range(a):
            if jaccard(sets[a], sets[b]) >= 0.8 and root[a] != root[b]:
                old, new = max(root[a], root[b]), min(root[a], root[b])
                root = [new if r == old else r for r in root]
    return root


def test_stage_keeps_one_of_each_group_of_similarity(spark, monkeypatch):
    found = texts()
    rows = [(k, t, "en") for k, t in enumerate(found)] + [(900, found[0].upper(), "en"), (901, None, "en"), (902, " ", "en"), (None, "no id here", "en")]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, lang string")
    root = brute([shingles(t) for t in found])
    assert 20 < len(set(root)) < len(found) - 40
    want = sorted(map(repr, [*set(root), 901, None]))
    for chunk in (near_copies.CHUNK_SHINGLES, 300):  # 300: groups are compared in pairs of chunks
        monkeypatch.setattr(near_copies, "CHUNK_SHINGLES", chunk)
        kept = corpus_pipeline.near_duplicate_stage(spark, docs, "")
        assert kept.columns == docs.columns
        assert sorted(repr(r.doc_id) for r in kept.collect()) == want


def test_near_copies_of_an_empty_table(spark):
    assert near_copies.near_copies(spark.createDataFrame([], "doc_id bigint, text string")).count() == 0


def test_fingerprints_alone_give_candidates(spark, monkeypatch):
    """Where no band is shared, copies within a few bits of a fingerprint are still found, and verified."""
    draw, words = random.Random(4), [f"w{k}" for k in range(3000)]
    long = draw.choices(words, k=1500)
    copy = [*long[:-1], "changed"]
    twice = long[:40] * 30
    found = [" ".join(x) for x in (long, copy, draw.choices(words, k=1500), twice, twice[:-1])]
    docs = spark.createDataFrame(list(enumerate(found)), "doc_id bigint, text string")
    given = near_copies._sketches

    def apart(batches, width):
        import numpy as np
        import pyarrow as pa

        for batch in given(batches, width):
            keys = (batch.column("node").to_numpy()[:, None] ^ np.arange(32)).ravel()
            lists = pa.ListArray.from_arrays(pa.array(np.arange(batch.num_rows + 1) * 32, pa.int32()), pa.array(keys))
            yield batch.set_column(batch.schema.get_field_index("bands"), "bands", lists)

    monkeypatch.setattr(near_copies, "_sketches", apart)
    kept = sorted(r.doc_id for r in near_copies.deduplicate(docs).collect())
    assert kept == [0, 2, 3]
