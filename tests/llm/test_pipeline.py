"""Every pipeline stage against brute force on its own input, and the whole run."""

import re
from collections import Counter

import public_tokenizers
import pytest
from tokenizers import Tokenizer

import corpus_pipeline as pipeline
from farebox.llm.common import documents, staged
from farebox.llm.resampling import resample
from farebox.llm.secret_scan import RULES, find

from ..conftest import SF_SMALL
from .conftest import hard_texts
from .test_duplicates import brute_components, brute_dedup

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


@pytest.fixture(scope="module")
def inputs(spark):
    """Each stage's input; the first is the small table and the hard cases."""
    hard = spark.createDataFrame([(i, t, None, "src", None) for i, t in hard_texts()], "doc_id long, text string, lang string, source string, n_chars long")
    docs = documents(spark, SF_SMALL).unionByName(hard)
    out = [docs]
    for name, stage in pipeline.STAGES:
        out.append(staged(stage(spark, out[-1], SF_SMALL), f"t-{name}"))
    return out


def pairs(df):
    return [(r["doc_id"], r["text"] or "") for r in df.collect()]


def test_columns(inputs):
    for df in inputs[1:-1]:
        assert df.columns == COLUMNS


def test_quality_classifier(spark, inputs):
    labels = spark.read.parquet(f"{SF_SMALL}/labels.parquet")
    verdict = resample(inputs[0], labels).collect()
    assert inputs[1].count() == sum(r["kept"] for r in verdict)
    good = {r["doc_id"] for r in labels.collect() if r["quality"] == 1}
    kept = {d for d, _ in pairs(inputs[1])}
    assert len(good & kept) >= 0.97 * len(good)


def test_one_of_each_group(inputs):
    before, after = pairs(inputs[1]), pairs(inputs[2])
    groups = brute_components(before, 5, 80)
    with_id = {c for (d, t), (_, n, c) in zip(before, groups) if n and c is not None}
    got = Counter(d for d, t in after if t.encode().split() and d is not None)
    assert got == Counter(with_id)
    assert Counter(p for p in after if not p[1].encode().split()) == Counter(p for p in before if not p[1].encode().split())


def test_substring_dedup(inputs):
    before, after = pairs(inputs[2]), pairs(inputs[3])
    want = Counter((d, n - gone) for (d, _), (_, n, gone, _) in zip(before, brute_dedup(before, 35)))
    assert Counter((d, len(t.encode().split())) for d, t in after) == want
    assert all(r["n_chars"] == len(r["text"] or "") for r in inputs[3].collect() if r["text"] is not None)


def test_secrets(inputs):
    before, after = dict(pairs(inputs[3])), dict(pairs(inputs[4]))
    assert before.keys() == after.keys()
    changed = 0
    for d, text in before.items():
        out, at = "", 0
        for a, b in sorted((s["start"], s["end"]) for s in find(text, RULES)):
            if a >= at:
                out += text[at:a] + "[secret]"
            at = max(at, b)
        assert after[d] == out + text[at:]
        changed += after[d] != text
    assert changed


def test_packing(inputs):
    library = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    want = Counter()
    for d, t in pairs(inputs[4]):
        want[d] += len(library.encode(t, add_special_tokens=False).ids) + 1
    got = Counter()
    for r in inputs[5].collect():
        got[r["doc_id"]] += r["length"]
    assert got == want


def test_run(spark, inputs):
    rows = pipeline.run(spark, SF_SMALL)
    assert rows.count() > 0 and {"doc_id", "piece", "sequence_id", "offset"} <= set(rows.columns)
    assert [name for name, _ in pipeline.STAGES] == ["quality_classifier", "jaccard_join", "substring_dedup", "secret_scans", "best_fit_packing"]
    assert re.search("five words", pipeline.__doc__)
