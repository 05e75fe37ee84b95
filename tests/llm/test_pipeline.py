"""The pipeline on a small folder: each stage against brute force on its own input."""

import random

import brute
import pytest

import corpus_pipeline
from assayframe.llm import quality, toxicity
from conftest_rows import folder


@pytest.fixture(scope="module")
def ran(spark, tmp_path_factory):
    sf_dir = folder(spark, tmp_path_factory.mktemp("sf"), random.Random(3))
    docs, out = spark.read.parquet(f"{sf_dir}/documents.parquet"), []
    for name, stage in corpus_pipeline.STAGES:
        path = f"{sf_dir}/{name}"
        stage(spark, docs, sf_dir).write.parquet(path)
        after = spark.read.parquet(path)
        out.append((name, docs, after))
        docs = after
    return sf_dir, out


def rows(df):
    return sorted(map(tuple, df.collect()), key=str)


def test_stages_keep_columns(ran):
    _, out = ran
    assert [n for n, *_ in out] == ["toxicity", "quality", "simhash", "suffix", "packing"]
    for _, before, after in out[:-1]:
        assert after.schema == before.schema


@pytest.mark.parametrize("at,module,wanted", [(0, toxicity, 0), (1, quality, 1)])
def test_classifier_stages(spark, ran, at, module, wanted):
    sf_dir, out = ran
    _, before, after = out[at]
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    scored = module.classify(before, labels, names=("a1", "a2", "a3"))
    assert rows(after) == rows(scored.where(f"a3 = {wanted}").select(*before.columns))
    assert 0 < after.count() < before.count()


def test_near_duplicates_stage(ran):
    _, before, after = ran[1][2]
    given = [(r["doc_id"], r["text"]) for r in before.collect()]
    prints = [brute.fingerprint(t) for _, t in given]
    label = brute.components(len(given), [(i, j) for i in range(len(given)) for j in range(i)
                                          if bin(prints[i] ^ prints[j]).count("1") <= 3])
    far = 1 << 62
    best = {}
    for (k, _), c in zip(given, label):
        best[c] = min(best.get(c, far), far if k is None else k)
    got = sorted(far if r["doc_id"] is None else r["doc_id"] for r in after.collect())
    assert got == sorted(best.values())


def test_suffix_stage(ran):
    _, before, after = ran[1][3]
    given = before.collect()
    want = brute.removed_bytes([r["text"] for r in given], 200)
    got = {r["doc_id"]: r for r in after.collect()}
    assert len(got) == len(given) and sum(w[1] for w in want) > 0
    for r, (n, removed, _, _) in zip(given, want):
        assert got[r["doc_id"]]["n_chars"] == len(got[r["doc_id"]]["text"])
        assert n - removed >= len(got[r["doc_id"]]["text"].encode()) >= n - removed - 3


def test_packing_stage(ran):
    _, before, after = ran[1][4]
    total = {}
    for r in after.collect():
        total[r["doc_id"]] = total.get(r["doc_id"], 0) + r["size"]
    assert total == {r["doc_id"]: len(brute.words(r["text"])) for r in before.collect()}


def test_run_equals_stages(spark, ran):
    sf_dir, out = ran
    assert rows(corpus_pipeline.run(spark, sf_dir)) == rows(out[-1][2])


def test_empty(spark, ran, tmp_path):
    sf_dir, out = ran
    for t in ("documents", "labels"):
        spark.read.parquet(f"{sf_dir}/{t}.parquet").limit(0).write.parquet(f"{tmp_path}/{t}.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0
