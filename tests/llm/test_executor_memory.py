"""What stages leave in an executor's memory for those that come after."""

import random
import re
from pathlib import Path

import pyarrow as pa

from tidebook.llm import packing, quality_rules
from tidebook.llm.queries import tokenizer_path


def own_mb():
    return sum(map(int, re.findall(r"\nPss_(?:Anon|Shmem):\s+(\d+)", Path("/proc/self/smaps_rollup").read_text()))) / 1024


def test_a_packing_task_gives_its_memory_back(spark, monkeypatch):
    """Spark keeps the worker; with what it had taken, the quality rules' executors came over their limit."""
    docs, taken = spark.createDataFrame([(1, "a")], "doc_id bigint, text string"), []
    monkeypatch.setattr(type(docs), "mapInArrow", lambda self, function, schema: taken.append(function))
    packing.document_pieces(docs, tokenizer_path("byte_bpe_50k.json"), with_ids=False)
    draw = random.Random(3)

    def batches(n):
        for _ in range(n):
            texts = [" ".join("".join(draw.choices("abcdeiou", k=7)) for _ in range(400)) for _ in range(1000)]
            yield pa.RecordBatch.from_arrays([pa.array(range(1000), pa.int64()), pa.array(texts)], ["doc_id", "text"])

    def run(n):
        return sum(out.num_rows for out in taken[0](batches(n)))

    assert run(1) >= 1000
    before = own_mb()
    assert run(6) >= 6000
    assert own_mb() - before < 40


def test_quality_measures_make_no_string_of_each_character(spark):
    """F.translate does, which filled executors' heaps; what stands for it tells the same characters."""
    texts = ["", " ", "\n", "a#b *$%&|<> \x85 x\xa0y\n\x0b\x0c\n \t\r\n#\n#\n\x85\n\x85", " \n \n&&\n&&", "\U0001f600 \U0001f600|é\r\né", None, "<<>>" * 40, "ab\x1fc\x1c d"]
    docs = spark.createDataFrame([(k, t, "h") for k, t in enumerate(texts)], "doc_id bigint, text string, source string")
    measures = quality_rules.document_measures(docs)
    assert "translate(" not in measures._jdf.queryExecution().optimizedPlan().toString()

    def want(text):
        text = text or ""
        lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
        return len(re.sub(r"[\x20\x09-\x0D]", "", text)), sum(c in "#*$%&|<>" for c in text), len(lines), len(lines) - len(set(lines))

    got = {r.doc_id: (r.word_chars, r.n_symbols, r.n_lines, r.n_dup_lines) for r in measures.collect()}
    assert got == {k: want(t) for k, t in enumerate(texts)}
