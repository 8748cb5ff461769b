"""The corpus pipeline against a brute-force version of its stages, each on its own input."""

import hashlib

import corpus_pipeline
from millwatch.llm.store import saved, table
from tests.llm.test_copies import _brute_spans, _groups, _leaks, _sets


def test_stages_on_the_small_table(spark, sf):
    docs = table(spark, sf, "documents")
    columns = docs.columns
    frames = [docs]
    for name, stage in corpus_pipeline.STAGES:
        frames.append(saved(stage(spark, frames[-1], sf), name.replace(" ", "-")))
    texts = [{r[0]: r[1] for r in f.select("doc_id", "text").collect()} for f in frames[:-1]]
    assert all(f.columns == columns for f in frames[:-1])

    labels = {r["doc_id"]: r["quality"] for r in table(spark, sf, "labels").collect()}
    assert 0 < len(texts[1]) < len(texts[0]) and all(labels.get(i, 1) for i in texts[1])

    groups = _groups(_sets(list(texts[1].items()), 5), 80)
    assert set(texts[2]) == {i for i in groups if groups[i] == i}

    spans = _brute_spans(list(texts[2].items()), 100)
    assert set(texts[3]) == {i for i, (n, gone, _, _) in spans.items() if not gone or gone < n}
    for i, text in texts[3].items():
        if not spans[i][1]:
            assert text == texts[2][i]

    leaks = _leaks(list(texts[3].items()), [tuple(r) for r in table(spark, sf, "benchmark").select("item_id", "text").collect()])
    assert set(texts[4]) == {i for i, (n, hit, _, _) in leaks.items() if hit <= 0.5 * n}
    assert all(texts[4][i] == texts[3][i] for i in texts[4] if not leaks[i][1])

    final = {r["doc_id"]: r for r in frames[-1].collect()}
    assert set(final) == set(texts[4])
    assert all(r["decoded_sha256"] == hashlib.sha256(texts[4][i].encode()).hexdigest() for i, r in final.items())


def test_pipeline_of_no_documents(spark, sf, documents):
    docs = documents([])
    for _, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, sf)
    assert docs.count() == 0
