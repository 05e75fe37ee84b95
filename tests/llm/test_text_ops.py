"""Operators on texts against plain statements of them, on small and edge inputs."""

import base64
import hashlib
import zlib

import brute
import numpy as np
import pytest
from hypothesis import given, settings, strategies as st

from assayframe.llm import anchors, bpe, bwt, debruijn, kneser, packing, simhash, suffixdedup, text


@settings(max_examples=150, deadline=None)
@given(st.lists(st.text("ab\x00é", max_size=50), max_size=6), st.integers(1, 12))
def test_repeats_by_transform(strings, depth):
    from collections import Counter
    raw = [s.encode() for s in strings]
    seen = Counter(s[i:i + depth] for s in raw for i in range(len(s) - depth + 1))
    want = [[seen[s[i:i + depth]] > 1 for i in range(len(s) - depth + 1)] for s in raw]
    assert [list(f) for f in bwt.repeats(raw, depth)] == want


@settings(max_examples=100, deadline=None)
@given(st.lists(st.integers(0, 3), max_size=80), st.integers(1, 12))
def test_window_minima(values, width):
    v = np.array(values, np.uint64) << np.uint64(40)
    want = [i + int(np.argmin(v[i:i + width])) for i in range(len(v) - width + 1)]
    assert list(text.window_minima(v, width)) == want


@settings(max_examples=100, deadline=None)
@given(st.lists(st.text(" \n\x1c\x85abÄ", max_size=12), max_size=5))
def test_words(texts):
    data = np.frombuffer("".join(texts).encode(), np.uint8)
    at = np.concatenate(([0], np.cumsum([len(t.encode()) for t in texts]))).astype(np.int64)
    w = text.Words(data, at)
    got = [data[s:e].tobytes() for s, e in zip(w.start, w.end)]
    assert got == [x for t in texts for x in brute.words(t)]
    h = w.hashes()
    assert all((a == b) == (x == y) for a, x in zip(h, got) for b, y in zip(h, got))


@settings(max_examples=60, deadline=None)
@given(st.lists(st.lists(st.integers(0, 2), max_size=40), min_size=1, max_size=4))
def test_chunks_partition_windows(texts):
    units = np.array([x for t in texts for x in t], np.uint64)
    first = np.concatenate(([0], np.cumsum([len(t) for t in texts])))
    c = anchors.Chunks(units, first, 6, 3)
    got = sorted(p for s, n in zip(c.start, c.count) for p in range(s, s + n))
    assert got == [f + i for f, t in zip(first, texts) for i in range(len(t) - 5)]
    offset = {}
    for s, n, a in zip(c.start, c.count, c.key):
        for p in range(s, s + n):  # equal windows have one anchor
            assert offset.setdefault(tuple(units[p:p + 6].tolist()), a) == a


@pytest.mark.parametrize("length,group", [(40, 1000), (40, 1), (7, 2)])
def test_suffix_dedup(frame, corpus, length, group):
    rows = [*corpus, (None, prose_of(corpus)), (3, corpus[0][1]), (3, "other text " * 9)]
    got = suffixdedup.remove_repeats(frame(rows), length, shard_bytes=500, group=group).collect()
    want = brute.removed_bytes([t for _, t in rows], length)
    found = sorted((r["doc_id"] or -1, r["n_bytes"], r["n_removed"], r["n_spans"],
                    r["kept_sha256"]) for r in got)
    assert found == sorted((k or -1, *w) for (k, _), w in zip(rows, want))


def prose_of(corpus):
    return corpus[1][1][:300]


def test_suffix_dedup_empty_and_columns(frame, corpus):
    assert suffixdedup.remove_repeats(frame([])).count() == 0
    out = suffixdedup.remove_repeats(frame(corpus[:4]), 30, keep=("print", "start", "kept"),
                                     as_text=True)
    assert {(r["print"], r["start"]) for r in out.collect()} == {("p", "y")}


@pytest.mark.parametrize("window", [20, 5])
def test_de_bruijn(frame, corpus, window):
    rows = [(None, corpus[1][1][:300]), *corpus]
    got = debruijn.remove_earlier(frame(rows), window).collect()
    want = brute.removed_words([t for _, t in rows], window)
    found = sorted((r["doc_id"] or -1, r["n_words"], r["n_removed"], r["kept_sha256"])
                   for r in got)
    assert found == sorted((k or -1, *w) for (k, _), w in zip(rows, want))


def test_de_bruijn_repeated_rows_and_empty(frame, corpus):
    a = corpus[0][1]
    got = debruijn.remove_earlier(frame([(1, a), (1, a), (2, a)]), 20).collect()
    assert sorted((r["doc_id"], r["n_removed"]) for r in got) == [(1, 0), (1, 0), (2, 60)]
    assert debruijn.remove_earlier(frame([])).count() == 0


@pytest.mark.parametrize("range_bytes", [1 << 20, 500])
def test_kneser_ney(frame, corpus, range_bytes):
    rows = [*corpus, (None, "new Words one"), (21, corpus[0][1].upper()), (21, "w1 unknownword")]
    held = [k is not None and zlib.crc32(str(k).encode()) % 5 == 1 for k, _ in rows]
    model = brute.KneserNey([t for (_, t), h in zip(rows, held) if not h])
    got = kneser.score(frame(rows), range_bytes=range_bytes).collect()
    assert len(got) == len(rows) and any(held)
    want = sorted((k or -1, h, *model.score(t)) for (k, t), h in zip(rows, held))
    found = sorted((r["doc_id"] or -1, *r[1:]) for r in got)
    for w, f in zip(want, found):
        assert w[:5] == f[:5] and np.allclose(w[5:], f[5:], rtol=1e-9)
    spread = sum(model.one(w) for w in model.count) + model.uniform
    assert abs(spread - 1) < 1e-9


def test_kneser_ney_empty(frame):
    assert kneser.score(frame([])).count() == 0
    row = kneser.score(frame([(1, "a b")]), held=zlib.crc32(b"1") % 5).first()
    assert row["train_tokens"] == 0 and row["n_known"] == 0 and row["score"] == 0


def test_simhash(frame, corpus):
    near = " ".join(f"w{i}" for i in range(400))
    rows = [*corpus, (31, near), (32, near.replace("w7 ", "v7 ")), (33, near.replace("w9 ", "q ")),
            (34, near + " end"), (None, near), (31, near)]
    prints = [brute.fingerprint(t) for _, t in rows]
    label = brute.components(len(rows), [(i, j) for i in range(len(rows)) for j in range(i)
                                         if bin(prints[i] ^ prints[j]).count("1") <= 3])
    least = {}
    for (k, _), c in zip(rows, label):
        least[c] = min(least.get(c, 1 << 62), k if k is not None else 1 << 62)
    want = sorted((k or -1, f"{p:016x}", least[c]) for (k, _), p, c in zip(rows, prints, label))
    got = simhash.near_duplicates(frame(rows)).collect()
    assert sorted((r["doc_id"] or -1, r["fingerprint"], r["component_id"]) for r in got) == want
    kept = simhash.keep_one(frame(rows))
    assert kept.columns == frame(rows).columns
    assert sorted(r["doc_id"] for r in kept.collect()) == sorted(set(least.values()))
    assert simhash.keep_one(frame([])).count() == 0


def test_simhash_broadcasts_no_fingerprints(frame, monkeypatch):
    # A fingerprint becomes some 30 probes, of which Spark's estimate knows nothing.
    def plan(df):
        return df._jdf.queryExecution().executedPlan().toString()

    plans, settle = {}, simhash.settle
    monkeypatch.setattr(simhash, "settle", lambda df, name: (
        plans.update({name: plan(df)}), settle(df, name))[1])
    rows = [(i, " ".join(f"w{i}x{j}" for j in range(40))) for i in range(1, 9)]
    rows += [(20, rows[0][1]), (None, rows[1][1])]
    out = simhash.near_duplicates(frame(rows))
    plans["result"] = plan(out)
    assert {r["doc_id"]: r["component_id"] for r in out.collect()} \
        == {i: i for i in range(1, 9)} | {20: 1, None: 2}
    for name in ("probes", "placed", "of", "result"):
        assert "SortMergeJoin" in plans[name] and "Broadcast" not in plans[name], name


@pytest.mark.parametrize("bucket", [1024, 3])
def test_near_links(spark, bucket):
    rng = np.random.default_rng(4)
    base = rng.integers(0, 1 << 63, 6, dtype=np.uint64)
    fps = []
    for b in base:
        for _ in range(40):
            x = int(b)
            for bit in rng.integers(0, 64, rng.integers(0, 4)):
                x ^= 1 << int(bit)
            fps.append(x)
    fps = sorted(set(fps))
    df = spark.createDataFrame([(int(np.uint64(x).astype(np.int64)),) for x in fps], "fp long")
    found = [(r["a"] % (1 << 64), r["b"] % (1 << 64))
             for r in simhash.near_links(df, bucket=bucket).collect()]
    place = {x: i for i, x in enumerate(fps)}
    near = [(i, j) for i in range(len(fps)) for j in range(i)
            if bin(fps[i] ^ fps[j]).count("1") <= 3]
    assert brute.components(len(fps), [(place[a], place[b]) for a, b in found]) \
        == brute.components(len(fps), near)


def test_byte_bpe(spark, frame, corpus):
    public = pytest.importorskip("public_tokenizers")
    import tiktoken
    path = public.path("byte_bpe_multi_50k.tiktoken")
    with open(path, "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    own = tiktoken.Encoding("own", pat_str=public.PATTERN, mergeable_ranks=ranks,
                            special_tokens={})
    odd = [(40, "it's 12345  été\n\n\n  naïve 🙂🙂 \x00\x01 <|endoftext|> ▁▁   zzzzzzzzz"),
           (41, "日本語のテキスト" * 30), (42, "  leading"), (43, "\t"), (40, "again")]
    rows = [*corpus, *odd]
    got = bpe.encode(frame(rows), bpe.read_ranks(spark, path), public.PATTERN,
                     with_ids=True).collect()
    want = sorted((k, own.encode_ordinary(t or ""), t or "") for k, t in rows)
    assert sorted((r["doc_id"], r["ids"]) for r in got) == [w[:2] for w in want]
    by_ids = {tuple(r["ids"]): r for r in got}
    for _, ids, t in want:
        r = by_ids[tuple(ids)]
        assert r["n_tokens"] == len(ids)
        assert r["decoded_sha256"] == hashlib.sha256(t.encode()).hexdigest()
        assert r["ids_sha256"] == hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()
    assert bpe.encode(frame([]), bpe.read_ranks(spark, path), public.PATTERN).count() == 0


@settings(max_examples=100, deadline=None)
@given(st.lists(st.tuples(st.integers(0, 10), st.sampled_from([None, "a", "b", "c"]),
                          st.sampled_from([None, 1, 2])), max_size=40))
def test_best_fit(pieces):
    pieces = sorted(pieces, key=lambda p: -p[0])
    got, want = packing.best_fit(pieces, 10), brute.best_fit(pieces, 10)
    assert got == want


def test_pack(frame, corpus):
    rows = [(*r, f"s{i % 3}") for i, r in enumerate(corpus)] + [(None, "a b", None), (101, "A b", "s0"),
                                                                (101, "a B", "s0")]
    got = packing.pack(frame(rows), capacity=50, shard=10).collect()
    total = {}
    for r in got:
        assert 0 <= r["size"] <= 50 and r["start"] == 50 * r["piece"]
        total[(r["doc_id"], r["copy"])] = total.get((r["doc_id"], r["copy"]), 0) + r["size"]
    want = {}
    for k, t, *_ in rows:
        want.setdefault(k, []).append(len(brute.words(t)))
    assert sorted(map(str, total.values())) == sorted(str(n) for v in want.values() for n in v)
    bins = {}
    for r in got:
        bins.setdefault(r["bin_id"], []).append(r)
    source = {k: s for k, _, s in rows}
    for held in bins.values():
        assert sum(r["size"] for r in held) <= 50
        named = [source[r["doc_id"]] for r in held if source[r["doc_id"]]]
        assert len(named) == len(set(named))
    assert packing.pack(frame([])).count() == 0
