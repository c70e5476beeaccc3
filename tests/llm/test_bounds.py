"""Where bounds of memory meet the data, nothing is left out."""

import math
import random

from tidebook.llm import hmm_lm, mtree


def best(vectors, queries, k, scale=256):
    out = []
    for q, a in queries:
        scores = []
        for i, b in vectors:
            if i != q and len(a) == len(b):
                s = sum(math.floor(x * scale) * math.floor(y * scale) for x, y in zip(a, b))
                if abs(s) < 1 << 63:
                    scores.append((-s, i))
        out += [(q, n + 1, i, -s) for n, (s, i) in enumerate(sorted(scores)[:k])]
    return sorted(out)


def test_vectors_too_large_for_the_tree_are_compared_exactly(spark, monkeypatch):
    draw = random.Random(6)
    vectors = [(0, [1.0, 0.0]), (1, [2.0**23, 0.0]), (2, [2.0**24, 0.0]), (3, [1.5, 2.0]), (4, [-(2.0**40), 2.0**30]), (5, [2.0**24, 0.0]), (6, [1e300, -1e300]), (7, [1.0, 2.0, 3.0]), (8, [2.0**26] * 3)]
    vectors += [(k, [draw.uniform(-1, 1) * 10 ** draw.choice((0, 0, 3, 8, 9)) for _ in range(2)]) for k in range(9, 120)]
    rows = [*vectors, (200, None), (201, [None, 1.0]), (202, [math.inf, 1.0]), (203, [math.nan, 1.0])]
    table = spark.createDataFrame(rows, "vec_id bigint, embedding array<double>")
    monkeypatch.setattr(mtree, "LARGE_VECTORS", 16)
    monkeypatch.setattr(mtree, "LARGE_QUERIES", 8)
    found = mtree.top_k(table, table.where("vec_id % 3 = 0 or vec_id > 100"), k=4)
    assert sorted(map(tuple, found.collect())) == best(vectors, [v for v in vectors if v[0] % 3 == 0 or v[0] > 100], 4)


def test_the_most_frequent_words_fill_their_number(spark):
    """Also where whole counts, or all words, have one count."""
    def chosen(counts, most):
        table = spark.createDataFrame([(hmm_lm.END, 10_000), *counts], "word string, c bigint")
        return hmm_lm.most_frequent(table, most)

    alike = [(f"w{k}", 3) for k in range(500)]
    for most in (1, 7, 499, 500, 600):
        found = chosen(alike, most)
        assert len(found) == min(most, 500) and set(found) <= set(alike) and found == sorted(found, key=lambda x: (-x[1], x[0]))
    mixed = [(f"v{k}", 1 + 1000 // (k + 1)) for k in range(400)] + [("x" * 60, 10**6)]
    for most in (3, 40, 150, 400):
        found = chosen(mixed, most)
        assert sorted((c for _, c in found), reverse=True) == sorted((c for w, c in mixed if len(w) <= hmm_lm.COMMON_BYTES), reverse=True)[:most]
    assert chosen([], 5) == []
