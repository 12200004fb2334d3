import sys

import pytest

import corpus_pipeline as cp
from cyclecount.llm import mixing, quality, secrets, simhash

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def stages(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    out = [docs]
    for _, stage in cp.STAGES:
        out.append(cp.materialize(stage(spark, out[-1], SF), "test-stage"))
    return out


def test_stages_keep_the_columns(stages):
    assert len(cp.STAGES) == 5
    assert all(s.columns == stages[0].columns for s in stages[:-1])


def test_quality_stage_drops_what_the_model_rejects(spark, stages):
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    model = quality.fit(quality.document_statistics(stages[0]), labels)
    import numpy as np

    rows = stages[0].collect()
    stats = np.stack([quality.statistics(r.text.encode() if r.text is not None else None) for r in rows])
    want = {r.doc_id for r, s in zip(rows, model.score(stats), strict=True) if s >= quality.THRESHOLD}
    assert {r.doc_id for r in stages[1].collect()} == want


def test_dedup_stage_equals_brute_force(stages):
    rows = stages[1].collect()
    fps = [simhash.fingerprint((r.text or "").encode()) for r in rows]
    root = list(range(len(rows)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            if (fps[i] ^ fps[j]).bit_count() <= simhash.MAX_BITS:
                a, b = find(i), find(j)
                root[max(a, b)] = min(a, b)
    least = {}
    for i, r in enumerate(rows):
        least[find(i)] = min(r.doc_id, least.get(find(i), r.doc_id))
    assert sorted(r.doc_id for r in stages[2].collect()) == sorted(least.values())


def test_secret_stage_leaves_no_base_span(stages):
    before = {r.doc_id: r.text for r in stages[2].collect()}
    after = {r.doc_id: r.text for r in stages[3].collect()}
    assert before.keys() == after.keys()
    touched = {r.doc_id for r in secrets.scan(stages[2]).collect() if r.spans}
    assert {i for i in before if before[i] != after[i]} == touched
    left = secrets.scan(stages[3], kinds=secrets.BASE).collect()
    assert not [r for r in left if r.spans]


def test_mix_stage_takes_what_the_plan_says(stages):
    plan = {r.doc_id: len(r.positions) for r in mixing.plan_mix(stages[3]).collect()}
    got = [r.doc_id for r in stages[4].collect()]
    assert {i: got.count(i) for i in plan} == plan


def test_packing_stage_places_every_document(stages):
    rows = stages[5].collect()
    assert sum(r.piece == 0 for r in rows) == stages[4].count()
    at = {}
    for r in rows:
        at.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for places in at.values():
        end = 0
        for o, n in sorted(places):
            assert o == end
            end += n
        assert end <= 1024


def test_entry_without_the_subpackage(monkeypatch):
    """The driver's contract file still gives its other queries where this part is missing."""
    import importlib

    import __spark_entry__ as entry

    whole = set(entry.queries())
    assert "pipeline" in whole
    for name in [m for m in sys.modules if m.startswith("cyclecount.llm") or m == "corpus_pipeline"]:
        monkeypatch.delitem(sys.modules, name)
    for name in ("cyclecount.llm", "cyclecount.llm.queries", "corpus_pipeline"):
        monkeypatch.setitem(sys.modules, name, None)
    again = importlib.reload(entry)
    try:
        less = set(again.queries())
        assert less == {q for q in whole if not q.startswith("op") and q != "pipeline"}
    finally:
        monkeypatch.undo()
        importlib.reload(entry)


def test_empty_table(spark, tmp_dir):
    spark.read.parquet(f"{SF}/documents.parquet").limit(0).write.parquet(f"{tmp_dir}/documents.parquet")
    spark.read.parquet(f"{SF}/labels.parquet").limit(0).write.parquet(f"{tmp_dir}/labels.parquet")
    assert cp.run(spark, tmp_dir).count() == 0
