from __future__ import annotations

from pathlib import Path

import pytest

SF = "/root/testdata/sf0.001"

pytestmark = pytest.mark.skipif(not Path(SF).is_dir(), reason="given tables not there")


def test_stages_hand_on_documents(llm):
    import corpus_pipeline

    docs = llm.read.parquet(f"{SF}/documents.parquet")
    columns, n = docs.columns, docs.count()
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = corpus_pipeline.stored(stage(llm, docs, SF), name)
        assert docs.columns == columns
        if name != "mixing":
            assert 0 < docs.count() <= n
            n = docs.count()
    pieces = corpus_pipeline.STAGES[-1][1](llm, docs, SF)
    assert {r["doc_id"] for r in pieces.collect()} == {r["doc_id"] for r in docs.collect()}


def test_run_gives_packed_pieces(llm):
    import corpus_pipeline

    out = corpus_pipeline.run(llm, SF)
    assert out.columns == ["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"]
    assert out.count() > 0


@pytest.mark.parametrize(
    "texts,left",
    [([], 0), ([None] * 3, 0), (["the same text of some more words"] * 4, 1)],
    ids=["no rows", "nulls only", "equal rows"],
)
def test_chain_on_odd_documents(llm, documents, texts, left):
    import corpus_pipeline

    docs = documents([(7 if texts and texts[0] else i, t, "en" if t else None, "s") for i, t in enumerate(texts)])
    columns = docs.columns
    for name, stage in corpus_pipeline.STAGES:
        docs = corpus_pipeline.stored(stage(llm, docs, SF), name)
        if name in ("language", "near_duplicates"):
            assert docs.columns == columns
        if name == "near_duplicates":
            # A text without words is linked with nothing.
            assert docs.count() in (left, len(texts) if texts and texts[0] is None else left)
    assert docs.columns == ["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"]


def test_every_operator_is_registered():
    import re

    from tenderlake.llm.queries import ORACLES, QUERIES

    numbers = sorted(int(re.match(r"op(\d+)_", q)[1]) for q in QUERIES)
    assert numbers == list(range(1, 14))
    assert set(ORACLES) <= set(QUERIES)
