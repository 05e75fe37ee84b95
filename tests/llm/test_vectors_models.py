"""Vector operators against brute force; classifiers by held-out accuracy."""

import random
import zlib

import brute
import numpy as np
import pyarrow as pa
import pytest

from assayframe.llm import fitting, gridjoin, quality, toxicity, vafile


@pytest.fixture(scope="module")
def vectors():
    rng = np.random.default_rng(2)
    centre = rng.normal(size=(25, 12))
    v = np.concatenate([centre[rng.integers(0, 25, 260)] + 0.12 * rng.normal(size=(260, 12)),
                        rng.normal(size=(60, 12))]).astype(np.float32).tolist()
    v[20:26] = [v[3]] * 6
    v[7], v[9], v[11], v[13] = None, [0.0] * 12, [float("nan")] * 12, []
    v[15], v[17] = [1.0] * 11 + [None], [1.0] * 11 + [float("inf")]
    return v


def frame(spark, vectors):
    return spark.createDataFrame([(i, v, "x") for i, v in enumerate(vectors)],
                                 "vec_id long, embedding array<float>, links string")


@pytest.mark.parametrize("block,leaf", [(64, 8), (4096, 256)])
def test_grid_join(spark, vectors, block, leaf):
    got = gridjoin.link_vectors(frame(spark, vectors), block=block, leaf=leaf).collect()
    n, component = brute.links(vectors, 0.95)
    want = [(i, n[i], component[i], component[i] == i) for i in range(len(vectors))]
    assert max(n) > 5
    assert sorted(map(tuple, got)) == want
    assert gridjoin.link_vectors(frame(spark, vectors).limit(0)).count() == 0


def test_grid_join_repeats(spark):
    rows = [(1, [1.0, 0.0]), (1, [1.0, 0.0]), (None, [1.0, 0.0]), (4, [0.0, 2.0]), (5, None)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    got = [tuple(r) for r in gridjoin.link_vectors(df).collect()]
    assert sorted(map(str, got)) == sorted(map(str, [
        (1, 1, 1, True), (1, 1, 1, True), (None, 0, None, True), (4, 0, 4, True), (5, 0, 5, True)]))


def test_forest_spans_links():
    rng = np.random.default_rng(1)
    u = gridjoin._unit(rng.normal(size=(200, 3)))
    j = gridjoin.Joiner((u, u[:, :2], np.ones(200, np.int64)), None, 0.99, 16)
    j.join(0, 200, 0, 200)
    node, root = j.forest()
    near = [(a, b) for a in range(200) for b in range(a) if u[a] @ u[b] >= 0.99]
    assert brute.components(200, list(zip(node, root))) == brute.components(200, near)
    assert j.links.sum() == 2 * len(near)


@pytest.mark.parametrize("block", [16, 4096])
def test_top_k(spark, vectors, block):
    df = frame(spark, vectors)
    got = vafile.top_k(df, df.where("vec_id % 50 = 0"), block=block, query_block=3).collect()
    good = [i for i, v in enumerate(vectors)
            if v and all(x is not None and np.isfinite(x) for x in v)]
    assert sorted(map(tuple, got)) == brute.nearest(good, [vectors[i] for i in good], 5)
    assert vafile.top_k(df.limit(0), df.limit(0)).count() == 0
    few = df.where("vec_id in (50, 51)")
    assert vafile.top_k(few, few.where("vec_id = 50")).count() == 1


def test_search_reads_few_exact_vectors():
    rng = np.random.default_rng(3)
    v = rng.integers(-100, 100, (3000, 8))
    read = []

    class Counted(np.ndarray):
        def __getitem__(self, key):
            if isinstance(key, np.ndarray):
                read.append(len(key))
            return np.asarray(super().__getitem__(key))

    code, low, high = vafile.quantise(v.astype(float))
    found = vafile.search(np.array([-1]), v[:1], np.arange(3000), v.view(Counted), code, low,
                          high, 5)
    want = sorted((-int(s), i) for i, s in enumerate(v @ v[0]))[:5]
    assert [(-s, r) for _, r, s in found] == want and sum(read) < 1500


def labelled(n, marked, seed):
    rnd = random.Random(seed)
    rows = []
    for i in range(n):
        words = [f"w{rnd.randrange(500)}" for _ in range(rnd.randrange(20, 80))]
        bad = rnd.random() < 0.3
        if bad:
            for _ in range(4):
                words[rnd.randrange(len(words))] = marked(rnd)
        rows.append((i, " ".join(words), int(bad)))
    return rows


def check(spark, frame, module, rows, name, modulus, held):
    labels = spark.createDataFrame([(k, y, None) for k, _, y in rows] + [(None, 1, None)],
                                   f"doc_id long, {name} int, score string")
    extra = [(None, "w1 w2"), (5000, None), (5001, ""), (5002, "w3 " * 30000), (1, "w1 again")]
    df = frame([(k, t) for k, t, _ in rows] + extra)
    out = module.classify(df, labels, names=("h", "s", "y"))
    assert out.columns == [*df.columns, "h", "s", "y"]
    got = out.collect()
    assert len(got) == len(rows) + len(extra)
    assert all(0 <= r["s"] <= 1 for r in got)
    truth = {(k, t): y for k, t, y in rows}
    for r in got:
        assert r["h"] == (r["doc_id"] is not None
                          and zlib.crc32(str(r["doc_id"]).encode()) % modulus == held)
    tested = [(truth[(r["doc_id"], r["text"])], r["y"]) for r in got
              if r["h"] and (r["doc_id"], r["text"]) in truth]
    assert np.mean([a == b for a, b in tested]) > 0.9
    again = {(r["doc_id"], r["text"]): r["score"] for r in module.classify(
        df.select("doc_id", "text").repartition(3), labels).collect()}
    assert all(abs(again[(r["doc_id"], r["text"])] - r["s"]) < 1e-6 for r in got)
    assert module.classify(df.limit(0), labels).count() == 0
    same = module.classify(df, labels.limit(0)).select("score").distinct().collect()
    assert len(same) >= 1 and all(r[0] == pytest.approx(same[0][0]) for r in same)


def test_quality(spark, frame):
    rows = [(k, t, 1 - y) for k, t, y in labelled(900, lambda r: f"W{r.randrange(99)}!!", 1)]
    check(spark, frame, quality, rows, "quality", 3, 1)


def test_toxicity(spark, frame):
    bad = ["scoundrel", "rascal", "knave"]
    rows = labelled(900, lambda r: r.choice(bad) + r.choice(["", "s", "ly"]), 2)
    check(spark, frame, toxicity, rows, "toxic", 4, 2)


def test_logits_equal_pooled():
    rng = np.random.default_rng(0)
    net = toxicity.Net(1)
    net.tables += rng.normal(size=net.tables.shape).astype(np.float32)
    sizes = [0, 1, 2, 3, 0, 7, 1, 0]
    first = np.concatenate(([0], np.cumsum(sizes)))
    slots = rng.integers(0, toxicity.ROWS, (len(toxicity.PARTS), first[-1]))
    values, _ = net.pooled(slots, first)
    want = values @ net.weight + net.bias[0]
    assert np.allclose(net.logits(slots, first), want, atol=1e-4)


def test_quality_counts_all_labelled(spark, frame, monkeypatch):
    """A class of some 2,700 free labelled rows is fitted on whole."""
    rows = [(i, f"w{i % 97} w{i % 13}") for i in range(8000)]
    labels = spark.createDataFrame([(i, i % 2) for i in range(8000)], "doc_id long, quality int")
    free = [i for i in range(8000) if zlib.crc32(str(i).encode()) % 3 != 1]
    seen = []
    real = quality.train
    monkeypatch.setattr(quality, "train", lambda s: seen.append(s.select("key").collect()) or real(s))
    quality.classify(frame(rows), labels)
    assert sorted(r["key"] for r in seen[0]) == free
    assert min(sum(i % 2 == c for i in free) for c in (0, 1)) > 2500


def test_toxicity_counts_all_labelled(spark, frame, monkeypatch):
    """Classes of over 3,000 free labelled rows are fitted on whole, in several shards."""
    rows = [(i, f"w{i % 97} {'knave' if i % 2 else 'kin'} w{i % 13}") for i in range(9000)]
    labels = spark.createDataFrame([(i, i % 2) for i in range(9000)], "doc_id long, toxic int")
    free = [i for i in range(9000) if zlib.crc32(str(i).encode()) % 4 != 2]
    keys, counts = [], []
    real, counted = toxicity.train, toxicity._counted
    monkeypatch.setattr(toxicity, "train",
                        lambda s: keys.append(s.select("key").collect()) or real(s))
    monkeypatch.setattr(toxicity, "_counted", lambda s: counts.append(counted(s)) or counts[-1])
    out = toxicity.classify(frame(rows), labels).collect()
    assert sorted(r["key"] for r in keys[0]) == free and len(free) > toxicity.SHARD
    assert min(sum(i % 2 == c for i in free) for c in (0, 1)) > 3000
    seen, many, apart = counts[0]
    assert list(many + apart) == [sum(i % 2 == c for i in free) for c in (0, 1)]
    slot = toxicity.slots_of(toxicity._hashes_of("knave"))[0]
    assert list(seen[0, :, slot]) == [0, many[1]]
    assert all(r["predicted"] == r["doc_id"] % 2 for r in out)


def test_toxicity_in_shards(spark, frame, monkeypatch):
    monkeypatch.setattr(toxicity, "SHARD", 150)
    test_toxicity(spark, frame)


def test_limits_of_all_rows(spark):
    rnd = random.Random(4)
    rows = [(rnd.randrange(3), y := int(rnd.random() < 0.3), round(rnd.gauss(y, 1), 2))
            for _ in range(800)] + [(3, 1, 0.5)] * 30
    common, own = toxicity._limits(spark.createDataFrame(rows, "lang int, label long, z double"))
    assert sorted(own) == [0, 1, 2]
    for limit, some in [(common, rows), *[(own[k], [r for r in rows if r[0] == k]) for k in own]]:
        z, y = np.array([r[2] for r in some]), np.array([r[1] for r in some])

        def errors(cut):
            return (z[y == 1] < cut).mean() + toxicity.CAUTION * (z[y == 0] >= cut).mean()

        cuts = np.unique(z)
        want = min(errors(c) for c in [*cuts, cuts[-1] + 1])
        assert errors(limit) == pytest.approx(want) and not np.isin(limit, z)


@pytest.mark.parametrize("module,label", [(quality, "quality"), (toxicity, "toxic")])
def test_batches_are_bounded(spark, frame, module, label):
    key = "spark.sql.execution.arrow.maxBytesPerBatch"
    docs = frame([(i, "many words " * 600) for i in range(1500)]).coalesce(1)

    def sizes(batches):
        for b in batches:
            yield pa.RecordBatch.from_pydict({"rows": [b.num_rows], "bytes": [b.nbytes]})

    given = spark.conf.get(key)
    try:
        for own in (None, "1m"):
            spark.conf.unset(key) if own is None else spark.conf.set(key, own)
            labels = spark.createDataFrame([], f"doc_id long, {label} int")
            assert module.classify(docs, labels).count() == 1500
            seen = docs.mapInArrow(sizes, "rows long, bytes long").collect()
            assert sum(r["rows"] for r in seen) == 1500
            assert max(r["bytes"] for r in seen) < (5e6 if own is None else 1.3e6)
    finally:
        spark.conf.set(key, given)


def test_add_score_takes_slices(spark, frame):
    texts = ["a few words " * 100] * 1000 + ["long " * 200_000, None, "", "end"]
    docs = frame(list(enumerate(texts))).coalesce(1)
    out = fitting.add_score(docs, "text", "size", lambda data, at: np.full(len(at) - 1, len(data)))
    assert out.columns == [*docs.columns, "size"]
    got = {r["doc_id"]: (r["text"], r["size"]) for r in out.collect()}
    assert [got[i][0] for i in range(len(texts))] == texts
    assert got[1000][1] == 1_000_000
    assert all(size <= fitting.SCORED_BYTES for i, (_, size) in got.items() if i != 1000)
    assert out.where("doc_id < 0").count() == 0


def test_shards_are_written_by_a_codec_that_streams(spark):
    rows = [(i, f"w{i}", i % 2) for i in range(30)]
    shards = toxicity._shards(spark.createDataFrame(rows, "key long, text string, label int"))
    assert sorted(t for r in shards.collect() for t in r["text"]) == sorted(r[1] for r in rows)
    assert all(f.endswith(".zstd.parquet") for f in shards.inputFiles()) and shards.inputFiles()
