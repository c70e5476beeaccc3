"""The host verdict where junk is spread evenly over hosts, and where one host has most rows."""

from tidebook.llm import quality_rules as quality

GOOD = " ".join(f"word{k}" for k in range(80))
FAR, NEAR = GOOD + " #" * 100, GOOD + " #" * 10  # 5.6 and 1.1 times the limit


def judged(spark, rows):
    found = quality.quality_rules(spark.createDataFrame(rows, "doc_id bigint, text string, source string")).collect()
    assert len(found) == len(rows)
    return {r.doc_id: r for r in found}


def test_junk_spread_evenly_goes(spark):
    texts = [FAR if k % 5 == 0 else NEAR if k == 7 else GOOD for k in range(400)]
    found = judged(spark, [(k, t, f"h{k % 9}") for k, t in enumerate(texts)])
    assert all(found[k].kept == (texts[k] is not FAR) for k in found)
    assert found[7].soft_failed and not found[7].host_poor  # just beyond a rule, on a middling host


def test_host_with_most_rows_can_be_poor(spark):
    rows = [(k, "short" if k % 10 else NEAR, "big") for k in range(300)] + [(1000 + k, GOOD, "small") for k in range(100)] + [(2000, GOOD, "big")]
    found = judged(spark, rows)
    assert found[10].host_poor and not found[10].kept and found[2000].kept and found[1000].kept
