"""The pipeline's stages on the smallest tables, each against its own input."""

import corpus_pipeline as pipeline
from ledgerlens.llm import pii, repeats
from ledgerlens.llm.common import DOCUMENT_COLUMNS, shingle_sets, stored, table
from tests.conftest import SMALL


def test_stages_one_after_another(spark):
    docs, seen = table(spark, SMALL, "documents"), []
    for name, stage in pipeline.STAGES:
        before = {r["doc_id"]: r["text"] for r in docs.collect()}
        docs = stored(stage(spark, docs, SMALL))
        seen.append(name)
        if name == "packing":
            tokens = {r["doc_id"]: r["doc_tokens"] for r in docs.collect()}
            assert set(tokens) == set(before)
            break
        assert docs.columns == list(DOCUMENT_COLUMNS)
        after = {r["doc_id"]: r["text"] for r in docs.collect()}
        assert after and set(after) <= set(before)
        if name == "n-gram jaccard join":
            sets = [set(s.tolist()) for s in shingle_sets([t.encode() for t in after.values()], 5)]
            assert all(10 * len(a & b) < 8 * len(a | b) for i, a in enumerate(sets) for b in sets[:i] if a or b)
        if name == "suffix-array dedup":
            assert set(after) == set(before)
            removed = {r["doc_id"]: r["n_removed"] for r in repeats.digest(spark.createDataFrame(list(before.items()), "doc_id bigint, text string")).collect()}
            assert all((removed[i] == 0) == (after[i] == before[i]) for i in before)
        if name == "pii":
            assert not [i for i, t in after.items() if any(s.kind == "email" for s in pii.find_spans(t))]
    assert len(seen) == 5
