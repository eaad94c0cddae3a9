"""The corpus pipeline over a whole small table with odd rows, stage by stage."""

import random
from collections import defaultdict

import corpus_pipeline
import pytest

from beatmetrics.llm import langid
from tests.llm.test_table_operators import base_spans, brute_groups


@pytest.fixture(scope="module")
def stages(spark, tmp_path_factory):
    """The documents with odd rows, and what every stage returns of them."""
    root = str(tmp_path_factory.mktemp("corpus"))
    source = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{source}/documents.parquet")
    chance = random.Random(4)
    base = [r for r in docs.collect() if r.text and len(r.text) > 300]
    rows = [(90_000 + i, None, "en", "odd", 0) for i in range(3)]
    rows += [(90_010, "", None, None, None), (90_011, " \n ", "en", None, 3), (90_012, "12 34", "de", "x", 5)]
    rows += [(r.doc_id, r.text, r.lang, "again", r.n_chars) for r in base[:3]]
    rows += [(None, base[5].text, None, "no id", None)] * 2
    for i, r in enumerate(base[6:12]):
        words = r.text.split(" ")
        words[chance.randrange(len(words))] = "changed"
        rows.append((91_000 + i, " ".join(words), r.lang, "near", None))
    whole = docs.unionByName(spark.createDataFrame(rows, docs.schema))
    whole.repartition(3).write.parquet(f"{root}/documents.parquet")
    spark.read.parquet(f"{source}/labels.parquet").write.parquet(f"{root}/labels.parquet")
    found = [spark.read.parquet(f"{root}/documents.parquet")]
    for k, (_, stage) in enumerate(corpus_pipeline.STAGES):
        stage(spark, found[-1], root).write.parquet(f"{root}/{k}")
        found.append(spark.read.parquet(f"{root}/{k}"))
    return root, found


def bag(df):
    return sorted(str(tuple(r)) for r in df.collect())


def test_all_but_the_last_stage_return_documents(stages):
    _, found = stages
    assert [name for name, _ in corpus_pipeline.STAGES] == [
        "language ID", "toxicity", "n-gram Jaccard join", "PII", "packing",
    ]
    for df in found[1:-1]:
        assert df.columns == found[0].columns


def test_language_stage_drops_what_is_not_identified(spark, stages):
    _, found = stages
    model = langid.fit(found[0])
    kept = [r for r in found[0].collect() if model.predict(r.text)[0] != "und" and model.predict(r.text)[1] >= 0.3]
    assert bag(found[1]) == sorted(str(tuple(r)) for r in kept)
    assert not any(r.text is None or r.doc_id in range(90_000, 90_020) for r in found[1].collect())


def test_toxicity_stage_keeps_most_rows_as_they_are(stages):
    _, found = stages
    before, after = bag(found[1]), bag(found[2])
    assert set(after) <= set(before) and len(after) >= 0.7 * len(before)


def test_one_document_of_each_group_stays(stages):
    _, found = stages
    rows = found[2].collect()
    groups = brute_groups([(i, r.text) for i, r in enumerate(rows)], 5, 80)
    of = defaultdict(list)
    for i, (_, component) in groups.items():
        of[component].append(rows[i])
    kept = found[3].collect()
    assert len(kept) == len(of) < len(rows)
    texts = {r.text for r in kept}
    assert all(sum(t in texts for t in {r.text for r in group}) == 1 for group in of.values())


def test_pii_stage_leaves_no_base_span_and_all_rows(stages):
    _, found = stages
    before, after = found[3].collect(), found[4].collect()
    assert sorted(str(r.doc_id) for r in before) == sorted(str(r.doc_id) for r in after)
    spans = {str(r.doc_id): base_spans(r.text) for r in before}
    assert any(spans.values())
    for r in after:
        assert base_spans(r.text) == "" and ("[" in r.text or not spans[str(r.doc_id)])


def test_packing_covers_all_and_run_gives_the_same(spark, stages):
    root, found = stages
    pieces = found[5].collect()
    assert {r.doc_id for r in pieces} == {r.doc_id for r in found[4].collect()}
    total = sum(r.length for r in pieces)
    ends = sorted((r.sequence_id * 2048 + r.offset, r.length) for r in pieces)
    at = 0
    for start, length in ends:
        assert start == at
        at += length
    assert at == total
    again = corpus_pipeline.run(spark, root).collect()
    assert sum(r.length for r in again) == total and len({r.doc_id for r in again}) == len(
        {r.doc_id for r in pieces}
    )
