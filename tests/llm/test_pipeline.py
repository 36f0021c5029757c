"""The pipeline's stages against brute force, and the registered queries against DuckDB."""

import os
import re
import sys
from collections import Counter, defaultdict

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
sys.path[:0] = [ROOT, os.path.join(ROOT, "tools")]

import check_oracle  # noqa: E402
import corpus_pipeline  # noqa: E402
from weft.llm import queries  # noqa: E402
from weft.llm.common import stored, table  # noqa: E402

SF = "/root/testdata/sf0.001"
needs_tables = pytest.mark.skipif(not os.path.isdir(SF), reason="driver tables are not here")


@needs_tables
@pytest.mark.parametrize("name", sorted(queries.QUERIES))
def test_query(spark, name):
    problem, n, _ = check_oracle.compare(spark, check_oracle.duck(SF), SF, name)
    assert problem is None and n


@needs_tables
def test_stages(spark):
    docs = table(spark, SF, "documents")
    columns = docs.columns
    seen = []
    for name, stage in corpus_pipeline.STAGES:
        seen.append(docs)
        docs = stored(stage(spark, docs, SF), "test-stage")
        if name != corpus_pipeline.STAGES[-1][0]:
            assert docs.columns == columns
    raw, good, exact, near, mixed = ({r["doc_id"]: r["text"] for r in d.collect()} for d in seen)
    labels = table(spark, SF, "labels").collect()
    foul = {r["doc_id"] for r in labels if r["quality"] == 0 or r["toxic"] == 1}
    fine = {r["doc_id"] for r in labels} - foul
    assert set(good) <= set(raw) and len(fine & set(good)) > 0.95 * len(fine) and len(foul & set(good)) < 0.5 * len(foul)
    groups = defaultdict(list)
    for i, t in good.items():
        groups[re.sub(r"[\x20\x09-\x0D]+", " ", t or "")].append(i)
    assert set(exact) == {min(ids) for ids in groups.values()}
    from test_near_dedup import brute

    least = brute(list(exact.items()), 5, 80)
    assert set(near) == {component for (_, _, component) in least}
    copies = Counter(r["doc_id"] for r in seen[4].select("doc_id").collect())
    assert set(copies) <= set(near) and abs(sum(copies.values()) - len(near)) < 6 * len(near) ** 0.5
    assert Counter(r["doc_id"] for r in docs.collect()) == copies
    import hashlib

    assert all(r["decoded_sha256"] == hashlib.sha256((near[r["doc_id"]] or "").encode()).hexdigest() for r in docs.collect())


def test_stages_take_odd_rows(spark, make_docs, tmp_path):
    rows = [(1, None, None, None, None), (2, "", "", "", 0), (3, "a b c d e f g", "en", "src0", 13), (3, "a b c d e f g", "en", "src0", 13), (None, "x " * 50_000, "en", "src1", 1)]
    spark.createDataFrame([], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    for given in (rows, []):
        docs = make_docs(given)
        columns = docs.columns
        for name, stage in corpus_pipeline.STAGES:
            docs = stored(stage(spark, docs, str(tmp_path)), "test-stage")
            assert docs.columns == columns or name == corpus_pipeline.STAGES[-1][0]
        assert docs.count() or not given


def test_a_task_has_one_python_worker(spark, make_docs):
    """Encoding and decoding do not share a stage: the workers of both would be held by an executor at once."""
    docs = make_docs([(1, "some words, and 12 numbers", "en", "a", 5), (2, None, None, None, None), (2, "", "en", "a", 0)])
    done = corpus_pipeline.tokenised(spark, docs, "")
    plan = done._jdf.queryExecution().executedPlan().toString()
    assert plan.count("MapInArrow") == 1 and "FileScan" in plan
    assert {(r["doc_id"], r["n_tokens"] > 0) for r in done.collect()} == {(1, True), (2, False)} and done.count() == 3
