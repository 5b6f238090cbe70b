"""The pipeline, stage by stage, against brute force."""

import corpus_pipeline
import pytest
from conftest import SF
from test_near import brute_near
from test_small_operators import ODD, brute_lines, brute_substring, check_packed, documents

from catalyne.llm import lines
from catalyne.llm.common import written


@pytest.fixture(scope="module")
def stages(spark):
    """What goes into each stage, and what comes out of the last."""
    out = [spark.read.parquet(f"{SF}/documents.parquet")]
    for name, f in corpus_pipeline.STAGES:
        out.append(written(f(spark, out[-1], SF), name))
    return [(x.columns, {r["doc_id"]: r for r in x.collect()} if i < 5 else x.collect()) for i, x in enumerate(out)]


def test_columns(stages):
    assert all(columns == stages[0][0] for columns, _ in stages[:5])


def test_language_stage(stages):
    (_, before), (_, after) = stages[0], stages[1]
    assert set(after) <= set(before) and all(before[i] == r for i, r in after.items())
    assert all(r["text"] is None or not any(map(str.isalpha, r["text"])) for i, r in before.items() if i not in after and len(r["text"] or "") < 20)
    assert len(after) >= 0.95 * len(before)


def test_line_stage(stages):
    (_, before), (_, after) = stages[1], stages[2]
    expected = brute_lines([(i, r["text"], r["source"]) for i, r in before.items()], lines.MIN_SITES)
    assert {i: r["text"] for i, r in after.items()} == {i: t for i, (t, _, _) in expected.items()}
    assert all(r["n_chars"] == len(r["text"]) for r in after.values())


def test_near_duplicate_stage(stages):
    (_, before), (_, after) = stages[2], stages[3]
    assert set(after) == set(brute_near({i: r["text"] for i, r in before.items()}).values())


def test_substring_stage(stages):
    import hashlib

    (_, before), (_, after) = stages[3], stages[4]
    expected = brute_substring([(i, r["text"]) for i, r in before.items()], 50)
    assert set(after) == {i for i, (n, gone, _) in expected.items() if gone == 0 or gone < n}
    for i, r in after.items():
        assert r["text"] == before[i]["text"] if expected[i][1] == 0 else hashlib.sha256(r["text"].encode()).hexdigest() == expected[i][2]


def test_packing_stage(stages):
    assert {r["doc_id"] for r in stages[5][1]} == set(stages[4][1])
    check_packed(stages[5][1])


def test_stages_on_odd_and_on_no_documents(spark):
    for docs in (documents(spark, ODD, extra=1), documents(spark, [])):
        out = docs
        for name, f in corpus_pipeline.STAGES:
            out = written(f(spark, out, SF), name)
        kept = {r["doc_id"] for r in out.collect()}
        # Texts with letters and a language stay, but for the second of the two that are copies.
        assert kept <= set(range(len(ODD))) - {0, 1, 2, 8} and (kept or not docs.count())


def test_run(spark, stages):
    rows = corpus_pipeline.run(spark, SF).collect()
    assert {(r["doc_id"], r["piece"], r["ids_crc32"]) for r in rows} == {(r["doc_id"], r["piece"], r["ids_crc32"]) for r in stages[5][1]}
