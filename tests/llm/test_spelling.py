"""Spelling variants against a comparison of all words with all."""

import random
import re
import zlib
from collections import Counter

import pytest

from tidebook.llm import spelling

SCHEMA = "doc_id bigint, text string, word string, n bigint, key string, id string"


def near(a, b):
    """Whether one code point inserted, deleted or replaced makes b of a."""
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    a, b = sorted((a, b), key=len)
    return len(b) == len(a) + 1 and any(b[:k] + b[k + 1 :] == a for k in range(len(b)))


def plain(rows, min_length, slip_every):
    counts = Counter()
    for doc_id, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            word = "".join(c.lower() if c.isascii() else c for c in run)
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{word}".encode())
            if slip_every and h % slip_every == 0:
                word = word[: h % len(word)] + word[h % len(word) + 1 :]
            counts[word] += 1
    words = {w: n for w, n in counts.items() if n >= 2 and len(w) >= min_length}
    out, forms = {}, {}
    for w, n in words.items():
        found = sorted((o for o in words if abs(len(o) - len(w)) < 2 and near(w, o)), key=lambda o: (-words[o], o))
        if found and words[found[0]] >= 10 * n:
            forms[w] = found[0]
        out[w] = len(found)
    result = set()
    for w, n in words.items():
        root = w
        while root in forms:
            root = forms[root]
        result.add((w, forms.get(w), root, n, out[w], words.get(forms.get(w))))
    return result


def rows():
    draw = random.Random(3)
    out = [(None, "no identity here, no identity there"), (1, None), (2, ""), (3, "short words only a b c"), (4, "ÀÉÎõü×÷ ÀÉÎõü×÷ ÀÉÎõü×ß ÀÉÎõü×ß")]
    for k in range(60):
        letters = "abàÿ" if k % 2 else "abc"
        text = " ".join("".join(draw.choice(letters) for _ in range(draw.randint(5, 8))) for _ in range(60))
        out.append((k, text.capitalize() if k % 3 else text.replace(" ", "_9")))
    for k, n in enumerate((2, 20, 200, 2000)):  # each the form of the one before, from chained to zzzined
        out.append((100 + k, f"{'z' * k}{'chained'[k:]} " * n))
    out += [(200, "equally " * 2), (201, "equallx " * 20 + "equallz " * 20)]  # a tie of forms
    long = "".join(draw.choice("abcdefgh") for _ in range(300))
    for k, word in enumerate((long, long[:150] + "z" + long[150:], long[:150] + "z" + long[151:], long[:64], long[:65], long[:66], long[:65] + "z", long[:64] + "z", "a" * 90, "a" * 91)):
        out.append((300 + k, f"{word} " * (20 if k % 3 == 0 else 2)))
    return out + [out[5], out[5]]


@pytest.mark.parametrize("slip_every", [0, 3])
def test_variants_equal_a_comparison_of_all_with_all(spark, slip_every, monkeypatch):
    made = rows()
    table = spark.createDataFrame([(d, t, "w", 1, "k", "i") for d, t in made], SCHEMA).repartition(4)
    found = [tuple(r) for r in spelling.group_variants(table, min_length=6, slip_every=slip_every).collect()]
    expected = plain(made, 6, slip_every)
    assert len(found) == len(expected) and set(found) == expected
    assert any(f and r != f for _, f, r, *_ in expected) or slip_every


def test_a_run_of_letters_as_long_as_a_text(spark):
    """Groups of a long word are hashes: their sizes don't grow with the square of the word."""
    word = "".join(random.Random(9).choices("abcdefghij", k=50_000))
    texts = [f"{word} " * 2, f"{word[:-1]} " * 20, (word[:700] + "z" + word[701:] + " ") * 30]
    found = {len(r.word): r for r in spelling.group_variants(spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")).where("word not like '%z%'").collect()}
    assert found[50_000].n_near == 2 and found[50_000].form_n == 30 and found[50_000].root == texts[2].split()[0]
    assert found[49_999].n_near == 1 and found[49_999].form is None


def test_counts_are_handed_on_in_parts_and_long_texts_are_searched_in_stretches(spark, monkeypatch):
    monkeypatch.setattr(spelling, "COUNTED_BYTES", 2000)
    monkeypatch.setattr(spelling, "STRETCH", 50)
    import pyarrow as pa

    made = rows()[:60]
    batch = pa.RecordBatch.from_arrays([pa.array([None if d is None else str(d) for d, _ in made]), pa.array([t for _, t in made])], ["id", "text"])
    counts = Counter()
    for part in (parts := list(spelling._count(iter([batch]), 7, 0))):
        for word, n in zip(*(c.to_pylist() for c in part.columns)):
            counts[word] += n
    expected = Counter(r.lower() if r.isascii() else "".join(c.lower() if c.isascii() else c for c in r) for _, t in made for r in re.findall("[A-Za-zÀ-ÿ]+", t or "") if len(r) >= 7)
    assert counts == expected and len(parts) > 1


def test_no_words(spark):
    table = spark.createDataFrame([(1, None), (2, "12 34")], "doc_id bigint, text string")
    assert spelling.group_variants(table).collect() == spelling.group_variants(table.limit(0)).collect() == []
