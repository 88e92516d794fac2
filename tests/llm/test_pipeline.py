from __future__ import annotations

import corpus_pipeline
from forecourt.llm.common import written
from forecourt.llm.decontaminate import normalised

from .test_chosen_path import by_hand
from .test_line_dedup import by_hand as cut_by_hand
from .test_packing import check_pieces, ids_of, word_ids

TABLE = "/root/testdata/sf0.01"


def test_stages_against_brute_force(spark):
    docs = spark.read.parquet(f"{TABLE}/documents.parquet")
    columns = docs.columns
    results = []
    for name, stage in corpus_pipeline.STAGES:
        docs = written(stage(spark, docs, TABLE), f"test-{name.replace(' ', '-')}")
        results.append(docs)
    assert all(df.columns == columns for df in results[:-1])
    kept, cut, single, clean = ({r.doc_id: r.text for r in df.collect()} for df in results[:-1])

    want = cut_by_hand(list(kept.items()))
    assert cut == {d[0]: v[0] for d, v in want.items() if not v[2] or v[0].strip(" ")}
    assert all(r.n_chars == len(r.text) for r in results[1].collect())
    assert set(single) == {doc for doc, _, least in by_hand(list(cut.items())) if doc == least}
    items = [normalised(r.text) for r in spark.read.parquet(f"{TABLE}/benchmark.parquet").collect()]
    gone = set(single) - set(clean)
    assert gone >= {d for d, t in single.items() if any(f" {i} " in f" {normalised(t)} " for i in items)}
    assert len(gone) < 0.06 * len(single)
    check_pieces(results[-1].collect(), {d: ids_of(word_ids("word_bpe_49k.json"), t) for d, t in clean.items()})
    assert {r.doc_id for r in corpus_pipeline.run(spark, TABLE).collect()} == set(clean)


def test_awkward_rows(spark, awkward, nothing):
    for docs in (awkward, nothing):
        for _, stage in corpus_pipeline.STAGES[:-1]:
            assert written(stage(spark, docs, TABLE), "test").columns == docs.columns
        assert corpus_pipeline.packing(spark, docs, TABLE).count() >= docs.count()
