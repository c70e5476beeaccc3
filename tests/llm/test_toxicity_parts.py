"""The classifier's parts against plain versions, and counterfactuals in other languages."""

import math
import random
from collections import Counter

import numpy as np
import pytest

from tidebook.llm import toxicity

SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint, __score double, __id int, __text string"


def newton(labels, found, swaps, n, ridge, counterfactual, pull):
    """The same objective with dense matrices, by Newton's steps."""
    m = len(labels)
    dense = lambda ks: np.array([1.0 if j in ks else 0.0 for j in range(n)] + [0.0])
    x = np.array([dense(f) for f in found])
    x[:, n] = 1
    rate = labels.mean()
    prior = math.log(rate / (1 - rate))
    penalty = np.diag([ridge / m] * n + [pull / m])
    named = [k for k in range(m) if swaps[k]]
    for k in named:
        for other in swaps[k]:
            d = dense(found[k]) - dense(other)
            penalty += counterfactual / len(named) / len(swaps[k]) * np.outer(d, d)
    w, target = np.zeros(n + 1), np.array([0.0] * n + [prior])
    for _ in range(50):
        p = 1 / (1 + np.exp(-x @ w))
        slope = x.T @ (p - labels) / m + penalty @ (w - target)
        w -= np.linalg.solve((x * (p * (1 - p))[:, None]).T @ x / m + penalty, slope)
    return w[:n], w[n]


@pytest.mark.parametrize("counterfactual", [0.0, 1.0])
def test_fit_finds_the_minimum(counterfactual):
    draw = np.random.default_rng(4)
    m, n = 120, 8
    found = [sorted(np.flatnonzero(draw.random(n) < 0.3).tolist()) for _ in range(m)]
    swaps = [[sorted({(k + step) % n for k in f}) for step in (1, 3)][: 1 + row % 2] if row % 3 == 0 and f else [] for row, f in enumerate(found)]
    labels = (draw.random(m) < [0.8 if 2 in f else 0.2 for f in found]).astype(float)
    got = toxicity.fit(labels, found, swaps, n, ridge=2.0, counterfactual=counterfactual, pull=5.0, steps=4000)
    want = newton(labels, found, swaps, n, 2.0, counterfactual, 5.0)
    assert np.allclose(got[0], want[0], atol=1e-5) and abs(got[1] - want[1]) < 1e-5


def test_features_are_those_told_by_the_likelihood_ratio(spark):
    draw = random.Random(2)
    words = ["".join(draw.choices("abcdefgh", k=draw.randint(3, 9))) for _ in range(60)]
    docs, labels = [], []
    for k in range(400):
        toxic = k % 5 == 0
        docs.append((k, " ".join(draw.choices(words, k=12) + ["badword"] * toxic * (k % 3 > 0)), "en", "s", 1, 0.0, 1, "x"))
        labels.append((k, int(toxic)))
    model = toxicity.learn(spark.createDataFrame(docs, SCHEMA), spark.createDataFrame(labels, "doc_id bigint, toxic int"))
    counts = (Counter(), Counter())
    for (_, text, *_), (_, label) in zip(docs, labels):
        counts[label].update(toxicity.text_features(set(text.split())))
    common = [f for f in counts[0].keys() | counts[1].keys() if counts[0][f] + counts[1][f] >= 3]
    part = lambda x, expected: x * math.log(x / expected) if x else 0.0
    ratio = {f: 2 * (part(counts[1][f], 0.2 * (counts[0][f] + counts[1][f])) + part(counts[0][f], 0.8 * (counts[0][f] + counts[1][f]))) for f in common}
    want = {f for f in common if ratio[f] >= 2 * math.log(max(10, len(common)))}
    assert {f for f in model.features.number if not (f.endswith("*") and model.features.number[f] < 0)} == want and "=badword" in want
    assert (model.n_labelled, model.n_swapped) == (400, 0)


def test_versions_swap_every_term():
    words = {"the", "muslim", "women", "left"}
    found = toxicity.swapped(words)
    assert len(found) == toxicity.COUNTERFACTUALS and all(len(x) == 4 and {"the", "left"} <= x and not {"muslim", "women"} & x for x in found)
    assert len({frozenset(x) for x in found}) == len(found)
    assert toxicity.swapped({"the", "left"}) == [] and toxicity.swapped({"one"}, (("one",),)) == []
    assert toxicity.swapped({"x"}, (("x", "y"),)) == [{"y"}]


def test_several_terms_of_a_line_are_swapped_together():
    line = (("old", "young", "elderly", "teenage"),)
    found = toxicity.swapped({"the", "old", "young"}, line)
    assert found[0] == {"the", "elderly", "teenage"} and all(len(x) == 3 and x != {"the", "old", "young"} for x in found)
    assert all(len(x) == 3 for x in toxicity.swapped({"old", "young", "elderly"}, line))
    assert toxicity.swapped({"the", *line[0]}, line) == []  # a whole line


def hostile(spark, line, insults, n=900):
    """Texts of which one in six is toxic; toxic ones name the first group of ``line`` far more often than others do."""
    draw = random.Random(8)
    plain = ["".join(draw.choices("abcdefghijklmnopqrstuvwxyz", k=6)) for _ in range(300)]
    docs, labels = [], []
    for k in range(n):
        toxic = k % 6 == 0
        group = draw.choices(line, weights=[10, *[1] * (len(line) - 1)] if toxic else [1, *[4] * (len(line) - 1)])[0]
        words = draw.choices(plain, k=30) + [group] + draw.sample(insults, 1) * toxic
        draw.shuffle(words)
        docs.append((k, " ".join(words), "de", "s", 1, 0.5, 1, "x"))
        labels.append((k, int(toxic)))
    return spark.createDataFrame(docs, SCHEMA), spark.createDataFrame(labels, "doc_id bigint, toxic int")


@pytest.mark.parametrize("line", [("muslime", "christen", "juden"), ("réfugiés", "autochtones", "immigrés"), ("extranjeros", "nativos", "refugiados")])
def test_penalty_spares_neutral_mentions(spark, line):
    docs, labels = hostile(spark, line, ["abschaum", "racaille", "escoria"])
    held, bound = toxicity.learn(docs, labels), toxicity.learn(docs, labels, counterfactual=0.0)
    assert held.n_swapped == 900
    logit = lambda m, t: math.log((s := m.scores([t])[0]) / (1 - s))
    mention, other = f"ein {line[0]} wohnt hier", f"ein {line[1]} wohnt hier"
    # without the penalty the group itself speaks against a text; with it hardly
    assert logit(bound, mention) - logit(bound, other) > 1
    assert abs(logit(held, mention) - logit(held, other)) < 0.3
    assert held.scores([f"{line[1]} abschaum racaille escoria"])[0] > 0.5 > held.scores([mention])[0]


def test_terms_are_a_parameter(spark):
    docs, labels = hostile(spark, ("gnomes", "elves", "dwarfs"), ["scum", "vermin"])
    assert toxicity.learn(docs, labels).n_swapped == 0
    assert toxicity.learn(docs, labels, terms=(("gnomes", "elves", "dwarfs"),)).n_swapped == 900


def test_labels_are_drawn_by_hash_alone(spark):
    known = spark.range(5000).selectExpr("id as __id", "cast(id % 7 = 0 as int) as __toxic").repartition(9)
    few = {r[0] for r in toxicity.drawn(known, 100).collect()}
    assert len(few) == 100 and few <= {r[0] for r in toxicity.drawn(known, 400).collect()}
    assert toxicity.drawn(known, 9999).count() == 5000


def test_columns_of_any_name_stay(spark):
    docs, labels = hostile(spark, ("a", "b"), ["scum", "vermin"], 60)
    kept = toxicity.keep_civil(docs, labels)
    assert kept.columns == docs.columns and {(r["__score"], r["__id"], r["__text"]) for r in kept.collect()} == {(0.5, 1, "x")}


def test_an_id_on_very_many_rows_is_one_labelled_text(spark):
    from pyspark.sql import functions as F

    docs = spark.range(50_000).select(F.lit(7).cast("bigint").alias("doc_id"), F.concat(F.lit("fine words "), F.col("id").cast("string")).alias("text"))
    others = spark.range(100, 160).select(F.col("id").alias("doc_id"), F.when(F.col("id") % 2 == 0, "vile words here").otherwise("kind words here").alias("text"))
    labels = others.select("doc_id", (F.col("doc_id") % 2 == 0).cast("int").alias("toxic")).unionByName(spark.range(7, 8).select(F.col("id").alias("doc_id"), F.lit(0).alias("toxic")))
    assert toxicity.learn(docs.unionByName(others), labels).n_labelled == 61
