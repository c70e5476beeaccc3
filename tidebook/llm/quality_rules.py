"""Host-level quality rules, with DataFrame functions only."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import WHITE_SPACE, WORD_BREAK, join_counted, materialize, only, text_key

SYMBOLS = "#*$%&|<>"
#: Rules of a single document.
MIN_WORDS = 50
MAX_REPEAT = 0.5
#: Softer rules, which count against a host and, on a poor host, against the document.
MAX_SYMBOLS_PER_WORD = 0.1
MAX_DUP_LINES = 0.3
MEAN_WORD_CHARS = (2, 20)
#: A host is poor if its shrunk failure rate is at least this, and at least so many times the corpus's.
POOR_RATE = 0.15
POOR_TIMES = 2.0
#: A document's miss is how many times a softer rule's limit it reaches; a host's odds of failure times the miss to
#: this power are the document's odds, and at 1 the host is poor for it. A rule set on its limit says nothing by itself.
MISS_POWER = 2


def host_of(url: Column) -> Column:
    """The host that a URL names, in lower case, without its user and port; null where there is none."""
    return F.nullif(F.lower(F.try_parse_url(url, F.lit("HOST"))), F.lit(""))


def words_of(text: Column) -> Column:
    return F.filter(F.split(text, WORD_BREAK, -1), lambda w: w != "")


def document_measures(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", host_col: str = "source") -> DataFrame:
    """Per document: n_words, word_chars, n_symbols, n_dup_lines, n_lines, n_repeat_words.

    Null text has none of anything. All is computed inside the row: nothing is
    exploded or shuffled.
    """
    text = F.coalesce(F.col(text_col), F.lit(""))
    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(host_col).cast("string").alias("host"), text_key(id_col, text_col).alias("text_key"), text.alias("text"))
    rows = rows.withColumn("words", words_of(F.col("text"))).withColumn("n_words", F.size("words").cast("long"))
    # the second step sees an array of hashes once it is computed, not the expression that makes it
    windows = F.when(
        F.col("n_words") >= 3,
        F.slice(
            F.transform("words", lambda w, i: F.xxhash64(w, F.get("words", i + 1), F.get("words", i + 2))),
            F.lit(1), (F.col("n_words") - 2).cast("int"),
        ),
    ).otherwise(F.array().cast("array<bigint>"))
    # F.translate makes a string of each character, gigabytes of garbage that fill an executor's heap; none of these does
    lines = F.filter(F.split("text", "\n", -1), lambda x: F.ltrim(x, F.lit(WHITE_SPACE)) != "")
    rows = rows.select(
        "doc_id", "host", "text_key", "n_words",
        F.char_length(F.array_join("words", "")).cast("long").alias("word_chars"),
        F.regexp_count("text", F.lit(f"[{SYMBOLS}]")).cast("long").alias("n_symbols"),
        lines.alias("lines"), windows.alias("windows"),
    )
    rows = rows.select(
        "doc_id", "host", "text_key", "n_words", "word_chars", "n_symbols",
        F.size("lines").cast("long").alias("n_lines"),
        (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long").alias("n_dup_lines"),
        "windows",
        (F.size("windows") > F.size(F.array_distinct("windows"))).alias("repeats"),
    )
    # windows that occur twice or more lie side by side once sorted with their places
    placed = F.sort_array(F.transform("windows", lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
    again = F.aggregate(
        F.sort_array(F.transform(
            F.filter(F.col("placed"), lambda x, k: (F.get(F.col("placed"), k - 1)["h"] == x["h"]) | (F.get(F.col("placed"), k + 1)["h"] == x["h"])),
            lambda x: x["i"],
        )),
        F.struct(F.lit(-3).alias("last"), F.lit(0).cast("long").alias("covered")),
        lambda acc, i: F.struct(i.alias("last"), (acc["covered"] + F.least(F.lit(3), i - acc["last"])).alias("covered")),
        lambda acc: acc["covered"],
    )
    rows = rows.withColumn("placed", F.when(F.col("repeats"), placed))
    return rows.withColumn("n_repeat_words", F.when(F.col("repeats"), again).otherwise(F.lit(0)).cast("long")).drop("windows", "placed", "repeats")


def with_rules(measures: DataFrame) -> DataFrame:
    """Adds base_failed (the document's own rules), soft_failed (the softer rules) and miss (how far beyond the worst of these, 1 at most if none)."""
    n = F.col("n_words")
    mean = F.col("word_chars") / F.greatest(n, F.lit(1))
    miss = F.greatest(
        F.col("n_symbols") / (MAX_SYMBOLS_PER_WORD * F.greatest(n, F.lit(1))),
        F.col("n_dup_lines") / (MAX_DUP_LINES * F.greatest(F.col("n_lines"), F.lit(1))),
        F.lit(MEAN_WORD_CHARS[0]) / F.greatest(mean, F.lit(0.01)), mean / F.lit(MEAN_WORD_CHARS[1]),
    )
    return measures.withColumn(
        "base_failed", (n < MIN_WORDS) | (100 * F.col("n_repeat_words") > int(100 * MAX_REPEAT) * n)
    ).withColumn(
        "soft_failed",
        (F.col("n_symbols") > MAX_SYMBOLS_PER_WORD * n)
        | (F.col("n_dup_lines") > MAX_DUP_LINES * F.col("n_lines"))
        | (mean < MEAN_WORD_CHARS[0]) | (mean > MEAN_WORD_CHARS[1]),
    ).withColumn("miss", F.when(F.col("soft_failed"), F.greatest(miss, F.lit(1.0))).otherwise(F.lit(1.0)))


def host_verdicts(ruled: DataFrame) -> DataFrame:
    """Per host: documents, failures, failure rate shrunk by an empirical beta prior, and poor.

    The prior Beta(a, b) has the mean of all documents' failures and a strength
    a + b found by the method of moments from the variance between hosts, kept
    within 1 and 10,000. Hosts with few documents stay near the mean.
    """
    failed = (F.col("base_failed") | F.col("soft_failed")).cast("long")
    hosts = ruled.groupBy("host").agg(F.count(F.lit(1)).alias("n"), F.sum(failed).alias("k"))
    corpus = hosts.agg(
        F.sum("n").alias("docs"), F.sum("k").alias("fails"), F.count(F.lit(1)).alias("hosts"),
        F.sum(F.col("k") * F.col("k") / F.col("n")).alias("kkn"), F.sum(F.col("n").cast("double") * F.col("n")).alias("nn"),
    )  # one row
    mean = F.col("fails") / F.col("docs")
    between = F.col("kkn") - F.col("docs") * mean * mean  # sum of n * (rate - mean)^2
    within = mean * (1 - mean)
    free = F.col("docs") - F.col("nn") / F.col("docs")
    variance = (between - (F.col("hosts") - 1) * within) / free
    strength = F.when((free > 0) & (variance > 0), within / variance - 1).otherwise(F.lit(10_000.0))
    corpus = corpus.select(mean.alias("mean"), F.greatest(F.lit(1.0), F.least(F.lit(10_000.0), strength)).alias("strength"))
    rate = (F.col("k") + F.col("mean") * F.col("strength")) / (F.col("n") + F.col("strength"))
    return (
        hosts.crossJoin(F.broadcast(corpus))
        .withColumn("rate", rate)
        .select("host", "n", "k", "rate", ((F.col("rate") >= POOR_RATE) & (F.col("rate") >= POOR_TIMES * F.col("mean"))).alias("poor"))
    )


def quality_rules(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", host_col: str = "source") -> DataFrame:
    """Judge documents by their own rules and by their host's shrunk failure rate.

    A document fails its own rules (``base_failed``) if it has fewer than 50 words,
    or over half its words lie in 3-word windows found twice or more in it. Failures
    of these and of softer rules (symbols, repeated lines, word length) are counted
    by host, rates are shrunk by an empirical beta prior, and the verdicts are
    joined back: on a poor host a document that fails a softer rule goes as well.
    A host is poor for all its documents if its rate is high beside the corpus's, and for a
    document if the rate's odds times the document's miss to the power MISS_POWER reach 1: the farther
    beyond a softer rule, the less its host must have failed. So junk that is spread evenly over hosts goes too.
    A document that fails no rule is kept on any host.

    Returns doc_id, host, text_key (of id and text), the measures, base_failed, soft_failed, host_poor, kept; a
    row per row of ``docs``. Null or empty text has no words and fails; a null host is
    a host of its own; repeated rows are judged alike; an empty table gives no rows.
    Other columns are ignored. Where hosts are in URLs, ``host_of`` gives them.
    """
    ruled = materialize(with_rules(document_measures(docs, id_col, text_col, host_col)), "quality-measures")
    verdicts = host_verdicts(ruled).select(F.col("host").alias("h"), "n", "poor", "rate")
    # a host with a third of all documents is joined where they are
    joined = join_counted(ruled, verdicts, "host", "h", "n", ruled.count(), null_safe=True)
    # odds rate / (1 - rate), without a division by 0
    poor = F.col("poor") | (F.col("rate") * F.pow("miss", F.lit(MISS_POWER)) >= 1 - F.col("rate"))
    return joined.withColumn("poor", poor).select(
        "doc_id", "host", "text_key", "n_words", "word_chars", "n_symbols", "n_lines", "n_dup_lines", "n_repeat_words",
        "base_failed", "soft_failed", F.col("poor").alias("host_poor"),
        (~F.col("base_failed") & ~(F.col("poor") & F.col("soft_failed"))).alias("kept"),
    )


def keep_good(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", host_col: str = "source") -> DataFrame:
    """The rows of ``docs``, with all their columns, that quality_rules keeps."""
    judged = quality_rules(docs, id_col, text_col, host_col)
    return only(docs, judged.where("kept"), id_col, text_col)
