"""A toxicity classifier that is held to equal scores when groups of people are swapped.

Learning has a logistic loss on labelled texts and a penalty on score changes: of a labelled text that names groups of
people, versions are made with other groups in their places, and the squared differences of their scores count
as loss. So what tells a toxic text can't be which group it names.
"""

from __future__ import annotations

import logging
import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import Memory, discard, free_name, held_out, materialize, ship

#: Labelled rows that are learnt from, at most (those with the smallest hash of their id), and features kept.
MAX_LABELLED = 20_000
MAX_FEATURES = 4096
#: Lengths of beginnings of words that are features beside the words themselves.
STEMS = (4, 5, 6, 7, 8)
#: Weight of squared coefficients, of the intercept's squared distance from the label's log odds, and of
#: squared score changes when groups are swapped.
RIDGE = 0.02
INTERCEPT = 20.0
COUNTERFACTUAL = 1.0
THRESHOLD = 0.7
#: Versions with swapped groups that a labelled text has, at most.
COUNTERFACTUALS = 3
COUNTED_FEATURES = 500_000

#: Terms for groups of people, in English, French, German and Spanish. Within a line each may be swapped for any other.
IDENTITY_TERMS = (
    ("women", "men", "girls", "boys", "transgender"),
    ("woman", "man", "girl", "boy"),
    ("christian", "muslim", "jewish", "hindu", "buddhist", "sikh", "atheist"),
    ("christians", "muslims", "jews", "hindus", "buddhists", "sikhs", "atheists"),
    ("black", "white", "brown", "hispanic", "latino"),
    ("african", "american", "asian", "european", "arab", "chinese", "indian", "mexican", "turkish", "polish"),
    ("gay", "straight", "lesbian", "bisexual", "queer", "heterosexual"),
    ("disabled", "deaf", "blind", "autistic"),
    ("immigrants", "refugees", "foreigners", "natives"),
    ("old", "young", "elderly", "teenage"),
    ("femmes", "hommes", "filles", "garçons"),
    ("chrétiens", "musulmans", "juifs", "hindous", "bouddhistes", "athées"),
    ("africains", "américains", "asiatiques", "arabes", "chinois", "turcs", "polonais"),
    ("homosexuels", "hétérosexuels", "lesbiennes", "bisexuels"),
    ("immigrés", "réfugiés", "étrangers", "autochtones"),
    ("frauen", "männer", "mädchen", "jungen"),
    ("christen", "muslime", "juden", "buddhisten", "atheisten"),
    ("afrikaner", "amerikaner", "asiaten", "araber", "chinesen", "türken", "polen"),
    ("homosexuelle", "heterosexuelle", "schwule", "lesben", "bisexuelle"),
    ("einwanderer", "flüchtlinge", "ausländer", "einheimische"),
    ("mujeres", "hombres", "niñas", "niños"),
    ("cristianos", "musulmanes", "judíos", "hindúes", "budistas", "ateos"),
    ("africanos", "americanos", "asiáticos", "árabes", "chinos", "turcos", "polacos"),
    ("homosexuales", "heterosexuales", "lesbianas", "bisexuales"),
    ("inmigrantes", "refugiados", "extranjeros", "nativos"),
)

Terms = tuple[tuple[str, ...], ...]

WORD = re.compile(r"[^\W\d_]+")


def words_in(text: str) -> set[str]:
    return set(WORD.findall(text.lower()))


def features_of(word: str) -> list[str]:
    return [f"={word}", *(f"{word[:n]}*" for n in STEMS if len(word) > n)]


def text_features(words: set[str]) -> set[str]:
    """Words and beginnings of words, and beginnings that two or more words share."""
    counts = Counter(f for w in words for f in features_of(w))
    return counts.keys() | {f"{f}2" for f, n in counts.items() if n > 1}


def turns(line: tuple[str, ...], named: set[str]) -> list[set[str]]:
    """What ``named`` terms of a line become as it is turned round by each number of places; first the turns that keep fewest of them."""
    made = [{line[(line.index(t) + k) % len(line)] for t in named} for k in range(1, len(line))]
    return sorted(made, key=lambda x: len(x & named))


def swapped(words: set[str], terms: Terms = IDENTITY_TERMS, most: int = COUNTERFACTUALS) -> list[set[str]]:
    """The words with identity terms replaced by others of their lines, in up to ``most`` ways; none without any such term.

    A way turns each line round, so that terms of a line become as many terms of it, and none of them stays where the line has enough
    others. A text that names a whole line is as it was, and no version.
    """
    lines = [turns(line, set(line) & words) for line in terms if len(line) > 1 and not words.isdisjoint(line)]
    kept = words.difference(*(line for line in terms if len(line) > 1))
    ways = min(most, max(map(len, lines), default=0))
    versions = [kept.union(*(line[k % len(line)] for line in lines)) for k in range(ways)]
    return [x for x in versions if x != words]


# --- learning -------------------------------------------------------------------


def _count_features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """feature, toxic and clean: in how many documents of either label; partial counts."""
    counts = (Counter(), Counter())

    def give():
        names = list(counts[0].keys() | counts[1].keys())
        toxic, clean = ([c[n] for n in names] for c in (counts[1], counts[0]))
        return pa.RecordBatch.from_arrays([pa.array(names, pa.string()), pa.array(toxic, pa.int64()), pa.array(clean, pa.int64())], ["feature", "toxic", "clean"])

    for batch in batches:
        for text, label in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            counts[label].update(text_features(words_in(text or "")))
            if len(counts[0]) + len(counts[1]) > COUNTED_FEATURES:
                yield give()
                counts = (Counter(), Counter())
    yield give()


class Features:
    """Numbers of the features kept, looked up by word."""

    def __init__(self, names: list[str]):
        self.number = {f: k for k, f in enumerate(names)}
        # a beginning that counts only when two words have it has a number below 0 itself
        for k, f in enumerate(names):
            if f.endswith("*2"):
                self.number.setdefault(f[:-1], -1 - k)
        self.twice = {self.number[f[:-1]]: k for k, f in enumerate(names) if f.endswith("*2")}
        self.known = Memory(32 << 20)

    def __getstate__(self):
        return {"number": self.number, "twice": self.twice, "known": Memory(32 << 20)}

    def of(self, words: set[str]) -> set[int]:
        known = self.known
        known.room(words)
        get = self.number.get
        for w in known.new(words):
            known.learn(w, tuple(k for f in features_of(w) if (k := get(f)) is not None))
        out, twice = set(), self.twice
        for w in words:
            for k in known[w]:
                if k in out and k in twice:
                    out.add(twice[k])
                out.add(k)
        return {k for k in out if k >= 0}


def _rows(batches: Iterator[pa.RecordBatch], features: Features, terms: Terms, most: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        labels, found, other = [], [], []
        for text, label in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            words = words_in(text or "")
            labels.append(label)
            found.append(sorted(features.of(words)))
            other.append([sorted(features.of(x)) for x in swapped(words, terms, most)])
        kind = pa.list_(pa.int32())
        yield pa.RecordBatch.from_arrays([pa.array(labels, pa.int32()), pa.array(found, kind), pa.array(other, pa.list_(kind))], ["toxic", "found", "swapped"])


def sparse(rows: list[list[int]]) -> tuple[np.ndarray, np.ndarray]:
    """Row and column of each entry."""
    return np.repeat(np.arange(len(rows)), [len(r) for r in rows]), np.array([k for r in rows for k in r], "int64")


def fit(
    labels: np.ndarray, found: list[list[int]], swaps: list[list[list[int]]], n: int, ridge: float = RIDGE, counterfactual: float = COUNTERFACTUAL, pull: float = INTERCEPT, steps: int = 400
) -> tuple[np.ndarray, float]:
    """Weights and intercept of a logistic regression.

    Minimizes the mean log loss + ridge / 2 * |w|^2 / rows + counterfactual / 2 * the
    mean square of score (logit) changes under swapped groups + pull / 2 * the intercept's squared
    distance from the label's log odds / rows, by gradient steps with momentum, each feature's
    step scaled by a bound of its curvature. ``swaps`` has the features of each text's versions
    with other groups; the mean is over the texts that have any, and of each over its versions.
    """
    m = len(labels)
    weights, intercept = np.zeros(n), 0.0
    if not m:
        return weights, intercept
    i, j = sparse(found)
    pairs = [(a, b, 1 / len(bs)) for a, bs in zip(found, swaps) for b in bs]
    ci, cj = sparse([a for a, _, _ in pairs])
    di, dj = sparse([b for _, b, _ in pairs])
    per_row = np.bincount(i, minlength=m)
    # each feature's curvature is bounded by its rows, weighted with how many features they share it with
    bound = np.bincount(j, weights=(1 + per_row[i]) / 4, minlength=n) / m + ridge / m
    if pairs:
        p, share = len(pairs), np.array([x for _, _, x in pairs])
        share /= share.sum()
        size = share * (np.bincount(ci, minlength=p) + np.bincount(di, minlength=p))
        bound += counterfactual * (np.bincount(cj, weights=size[ci], minlength=n) + np.bincount(dj, weights=size[di], minlength=n))
    bias_bound = (1 + per_row).mean() / 4 + pull / m
    rate = min(max(float(labels.mean()), 0.5 / m), 1 - 0.5 / m)
    intercept = prior = float(np.log(rate / (1 - rate)))
    look, look_bias, t = weights.copy(), intercept, 1.0
    for _ in range(steps):
        z = look_bias + np.bincount(i, weights=look[j], minlength=m)
        error = (1 / (1 + np.exp(-np.clip(z, -40, 40))) - labels) / m
        slope = np.bincount(j, weights=error[i], minlength=n) + ridge * look / m
        if pairs:
            change = share * (np.bincount(ci, weights=look[cj], minlength=p) - np.bincount(di, weights=look[dj], minlength=p))
            slope += counterfactual * (np.bincount(cj, weights=change[ci], minlength=n) - np.bincount(dj, weights=change[di], minlength=n))
        new, new_bias = look - slope / bound, look_bias - (error.sum() + pull * (look_bias - prior) / m) / bias_bound
        t_new = (1 + (1 + 4 * t * t) ** 0.5) / 2
        look, look_bias = new + (t - 1) / t_new * (new - weights), new_bias + (t - 1) / t_new * (new_bias - intercept)
        weights, intercept, t = new, new_bias, t_new
    return weights, float(intercept)


class Classifier:
    """What was learnt, from how many labelled texts, and on how many of these the penalty acted."""

    def __init__(self, features: Features, weights: np.ndarray, intercept: float, n_labelled: int = 0, n_swapped: int = 0):
        self.features, self.weights, self.intercept = features, weights.tolist(), intercept
        self.n_labelled, self.n_swapped = n_labelled, n_swapped

    def scores(self, texts: list[str | None]) -> list[float]:
        w, of = self.weights, self.features.of
        z = [self.intercept + sum(w[k] for k in of(words_in(x or ""))) for x in texts]
        return (1 / (1 + np.exp(-np.clip(z, -40, 40)))).tolist()


def drawn(known: DataFrame, most: int) -> DataFrame:
    """Of the rows (__id, __toxic), the ``most`` with the smallest hash of their id.

    The share of hashes that holds them is known beforehand, so that each task hands
    on no more than its part of them; without that every task would hand on ``most`` rows to the one that sorts them.
    """
    draw = F.pmod(F.xxhash64(F.lit(11), "__id"), F.lit(1 << 40))
    n = known.count()
    share = (most + 8 * most**0.5 + 100) / max(1, n)
    some = known if share >= 1 else known.where(draw < int(share * (1 << 40)))
    if share < 1 and some.count() < most:  # ids that repeat may all hash high
        some = known
    return some.orderBy(draw, "__id", "__toxic").limit(most)


def learn(
    docs: DataFrame,
    labels: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    label_col: str = "toxic",
    max_labelled: int = MAX_LABELLED,
    terms: Terms = IDENTITY_TERMS,
    counterfactual: float = COUNTERFACTUAL,
    counterfactuals: int = COUNTERFACTUALS,
) -> Classifier:
    """Learn from labelled rows: words and word beginnings that tell toxic texts, with the counterfactual penalty.

    At most ``max_labelled`` labels are used, a bounded number that is broadcast to the
    scan of ``docs``. Features are counted in the tasks; kept are those whose
    association with the label couldn't be chance among so many, by their likelihood
    ratio, and the identity terms that occur, so that the penalty can act on them.

    ``terms`` are lines of words for groups of people that may be swapped within their line; each labelled text that has
    any gets up to ``counterfactuals`` versions with others, and ``counterfactual`` weighs the score changes. How many
    labelled texts that were is logged, and kept in ``n_swapped``; where it is 0 the penalty does nothing. An id on several rows is
    learnt from once: of its texts, that with the smallest hash.
    """
    spark = docs.sparkSession
    ship(spark)
    known = labels.where(F.col(id_col).isNotNull() & F.col(label_col).isNotNull())
    known = known.select(F.col(id_col).alias("__id"), (F.col(label_col) > 0).cast("int").alias("__toxic")).distinct()
    texts = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
    rows = texts.join(F.broadcast(drawn(known, max_labelled)), F.col("id") == F.col("__id"))
    # a row for each label, so that no more than ``max_labelled`` come to the driver, whatever an id is repeated on
    training = rows.groupBy("id", F.col("__toxic").alias("toxic")).agg(F.min_by("text", F.xxhash64("text")).alias("text")).select("text", "toxic")
    training = materialize(training, "toxicity-training")

    n, toxic = training.agg(F.count(F.lit(1)), F.coalesce(F.sum("toxic"), F.lit(0))).first()
    counted = training.mapInArrow(_count_features, "feature string, toxic bigint, clean bigint").groupBy("feature").agg(F.sum("toxic").alias("a"), F.sum("clean").alias("b"))
    counted = materialize(counted.where("a + b >= 3"), "toxicity-features")
    rate = toxic / n if n else 0.0
    names: list[str] = []
    if 0 < rate < 1:
        a, b = F.col("a"), F.col("b")
        log = lambda x, share: F.when(x > 0, x * F.log(x / ((a + b) * share))).otherwise(F.lit(0.0))
        ratio = 2 * (log(a, rate) + log(b, 1 - rate))
        least = 2 * np.log(max(10, counted.count()))
        top = counted.withColumn("ratio", ratio).where(F.col("ratio") >= float(least)).orderBy(F.desc("ratio"), "feature").limit(MAX_FEATURES)
        names = [r["feature"] for r in top.collect()]
        groups = [f for line in terms for term in line for f in features_of(term)]
        names += sorted({r["feature"] for r in counted.where(F.col("feature").isin(groups)).collect()}.difference(names))
    features = Features(names)
    rows = training.mapInArrow(lambda b: _rows(b, features, terms, counterfactuals), "toxic int, found array<int>, swapped array<array<int>>").toArrow()  # max_labelled ids' rows of few numbers
    labels_, found, swaps = (rows.column(c).to_pylist() for c in ("toxic", "found", "swapped"))
    order = sorted(range(len(labels_)), key=lambda k: (labels_[k], found[k], swaps[k]))  # the same sums in any order of rows
    labels_, found, swaps = ([x[k] for k in order] for x in (labels_, found, swaps))
    weights, intercept = fit(np.array(labels_, float), found, swaps, len(names), counterfactual=counterfactual)
    if not 0 < rate < 1:
        intercept = -40.0 if rate < 1 else 40.0
    discard(training, counted)
    n_swapped = sum(map(bool, swaps))
    logging.getLogger(__name__).info("%d labelled texts, the penalty acts on %d of them", n, n_swapped)
    return Classifier(features, weights, intercept, n, n_swapped)


def _score(batches: Iterator[pa.RecordBatch], model: Classifier) -> Iterator[pa.RecordBatch]:
    """The first column, the text to score, becomes the last, its score."""
    for batch in batches:
        scores: list[float] = []
        for at in range(0, batch.num_rows, 512):
            scores += model.scores(batch.column(0).slice(at, 512).to_pylist())
        yield pa.RecordBatch.from_arrays([*batch.columns[1:], pa.array(scores, pa.float64())], [*batch.schema.names[1:], "score"])


def score(docs: DataFrame, model: Classifier, text_col: str = "text", keep: list[str] | None = None, as_col: str = "__score") -> DataFrame:
    """The columns in ``keep`` (all by default) and ``as_col``, 0 to 1, of every whole text."""
    ship(docs.sparkSession)
    kept = docs.select(*keep) if keep is not None else docs
    kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in kept.schema.fields)
    rows = docs.select(F.col(text_col).cast("string").alias(free_name(kept, "__text")), *kept.columns)
    return rows.mapInArrow(lambda b: _score(b, model), f"{kinds}, `{as_col}` double")


def toxicity(
    docs: DataFrame,
    labels: DataFrame,
    fold: int = 3,
    id_col: str = "doc_id",
    text_col: str = "text",
    label_col: str = "toxic",
    max_labelled: int = MAX_LABELLED,
    terms: Terms = IDENTITY_TERMS,
    counterfactual: float = COUNTERFACTUAL,
) -> DataFrame:
    """Score every whole text, learning from labels of rows that aren't held out.

    Held out are rows with crc32(id as text) mod ``fold`` equal to 1. Only words decide a
    score. Returns doc_id, held_out, score, predicted; a row per row of ``docs``. Null and
    empty texts get the score of a text without any telling word; null labels and
    labels of absent rows are left out; without labels of both kinds all get the
    one score (0, or 1 if all are toxic); repeated rows are scored alike; an empty table gives
    no rows. Other columns are ignored.
    """
    model = learn(docs, labels.where(~held_out(fold, id_col)), id_col, text_col, label_col, max_labelled, terms, counterfactual)
    return score(docs, model, text_col, [id_col], "__score").select(
        F.col(id_col).alias("doc_id"), held_out(fold, id_col).alias("held_out"), F.col("__score").alias("score"),
        (F.col("__score") >= THRESHOLD).cast("int").alias("predicted"),
    )


def keep_civil(
    docs: DataFrame,
    labels: DataFrame,
    fold: int = 3,
    id_col: str = "doc_id",
    text_col: str = "text",
    label_col: str = "toxic",
    max_labelled: int = MAX_LABELLED,
    threshold: float = THRESHOLD,
    terms: Terms = IDENTITY_TERMS,
) -> DataFrame:
    """The rows of ``docs``, with all their columns, that score below ``threshold``."""
    model = learn(docs, labels.where(~held_out(fold, id_col)), id_col, text_col, label_col, max_labelled, terms)
    as_col = free_name(docs, "__score")
    return score(docs, model, text_col, as_col=as_col).where(F.col(as_col) < threshold).drop(as_col)
