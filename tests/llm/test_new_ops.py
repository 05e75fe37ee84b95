"""Whitening, alignment and robust outliers against plain statements of them; hashes of words."""

import collections
import hashlib
import re

import brute
import numpy as np
import pytest
from hypothesis import given, settings, strategies as st

from assayframe.llm import alignment, debruijn, kneser, outliers, quality, suffixdedup, text, whitening

VECTORS = "vec_id long, embedding array<double>, label int, component string, n string"


def vector_frame(spark, rows):
    return spark.createDataFrame([(k, v, 1, "x", "y") for k, v in rows], VECTORS)


# --- whitening ---------------------------------------------------------------------------

def whitened_by_numpy(rows, most=8):
    width = max(len(v) for _, v in rows)
    x = np.array([[int(np.floor(1024 * c)) + 100000 for c in v] + [100000] * (width - len(v))
                  for _, v in rows], dtype=object)
    n, s = len(x), x.sum(0)
    deviation = [int(sum((n * a - b) ** 2 for a, b in zip(r, s))) for r in x]
    centred = ((n * x - s).astype(float)) / n
    value, vector = np.linalg.eigh(centred.T @ centred / n)
    value, vector = value[::-1], vector[:, ::-1]
    k = min(most, width, int((value > 1e-9 * value[0]).sum()))
    return n, deviation, centred @ vector[:, :k] / np.sqrt(value[:k]), value[:k] / value.sum()


@pytest.mark.parametrize("scales", [np.ones(12), 10.0 ** -np.arange(4), np.array([1, 1, 0, 3.0])])
def test_whitening(spark, scales):
    rng = np.random.default_rng(3)
    good = [(i, (rng.normal(size=len(scales)) * scales * 50).tolist()) for i in range(300)]
    good += [(7, good[7][1]), (None, good[9][1]), (901, good[5][1][:-1])]
    bad = [(500, None), (501, [float("nan")] * len(scales)), (502, [1.0, None]),
           (503, [float("inf")]), (504, [])]
    df = vector_frame(spark, good + bad).repartition(5)
    got = whitening.whiten(df).collect()
    n, deviation, want, share = whitened_by_numpy(good)
    k = want.shape[1]
    assert len(got) == len(good) * k and {r["n"] for r in got} == {n}
    assert max(r["identity_error"] for r in got) < 1e-9

    def table(rows):
        return sorted(rows, key=str)

    by_row = collections.defaultdict(dict)
    for r in got:
        by_row[r["vec_id"], r["deviation"]].setdefault(r["component"], []).append(r["whitened"])
    one = next(i for i in range(len(good)) if good[i][0] == 3)
    mine = by_row[3, deviation[one]]
    sign = np.array([np.sign(mine[c + 1][0] * want[one, c]) for c in range(k)])
    wanted = collections.defaultdict(dict)
    for (key, _), d, w in zip(good, deviation, want):
        for c in range(k):
            wanted[key, d].setdefault(c + 1, []).append(w[c] * sign[c])
    assert by_row.keys() == wanted.keys()
    for key, parts in wanted.items():
        for c, values in parts.items():
            assert sorted(by_row[key][c]) == pytest.approx(sorted(values), abs=1e-7), (key, c)
    for r in got:
        assert r["explained"] == pytest.approx(share[r["component"] - 1], rel=1e-6)


def test_whitening_of_rows_without_spread(spark):
    assert whitening.whiten(vector_frame(spark, [])).count() == 0
    assert whitening.whiten(vector_frame(spark, [(1, None)])).count() == 0
    assert whitening.whiten(vector_frame(spark, [(1, [1.0, 2.0])] * 3)).count() == 0
    line = whitening.whiten(vector_frame(spark, [(i, [float(i), 2.0 * i]) for i in range(9)]))
    assert {r["component"] for r in line.collect()} == {1}


def test_whitening_overflow(spark):
    with pytest.raises(Exception, match="OverflowError"):
        whitening.whiten(vector_frame(spark, [(1, [1e17]), (2, [0.0])])).collect()


def test_shifted_factors_bring_ill_conditioned_rows_to_identity():
    rng = np.random.default_rng(1)
    a = rng.normal(size=(400, 6)) @ np.diag(10.0 ** -np.arange(0, 12, 2)) @ rng.normal(size=(6, 6))
    gram, factors = a.T @ a, []
    shift = 1e-12 * np.trace(gram)
    for _ in range(3):
        factors.append(whitening.factor(gram, shift))
        q = whitening.solve(a, factors)
        gram, shift = q.T @ q, 0.0
    assert np.abs(gram - np.eye(6)).max() < 1e-8
    singular = np.linalg.svd(np.linalg.multi_dot([*factors[::-1]]), compute_uv=False)
    assert singular == pytest.approx(np.linalg.svd(a, compute_uv=False), rel=1e-4)


# --- alignment ---------------------------------------------------------------------------

rising = st.sets(st.integers(0, 400), max_size=60).map(lambda s: np.array(sorted(s), np.int64))


@settings(max_examples=200, deadline=None)
@given(rising, rising)
def test_common_ends(a, b):
    in_a, in_b = alignment.common_ends(a, b)
    both = sorted(set(a.tolist()) & set(b.tolist()))
    assert a[in_a].tolist() == b[in_b].tolist() == both


def vocabularies():
    import public_tokenizers as p
    with open(p.path("byte_bpe_50k.json"), "rb") as f, open(p.path("piece_bpe_32k.model"), "rb") as g:
        return alignment.byte_level(f.read(), p.PATTERN), alignment.piece_level(g.read())


def whole_text_groups():
    """text -> (A ids, B ids, groups) by the tokenizers' own libraries over the whole text."""
    import public_tokenizers as p
    import sentencepiece
    import tokenizers

    a = tokenizers.Tokenizer.from_file(p.path("byte_bpe_50k.json"))
    a.encode_special_tokens = True
    b = sentencepiece.SentencePieceProcessor(model_file=p.path("piece_bpe_32k.model"))
    byte = alignment._byte_of()

    def ends(parts):
        return np.cumsum([len(x) for x in parts]).tolist()

    def groups(t):
        if not t:
            return [], [], []
        e = a.encode(" " + t, add_special_tokens=False)
        ab = [bytes(byte[c] for c in x) for x in e.tokens]
        ids = b.encode(t)
        names = [b.id_to_piece(i) for i in ids]
        bb = [bytes([int(x[3:5], 16)]) if b.is_byte(i) else x.replace("▁", " ").encode()
              for i, x in zip(ids, names)]
        if b"".join(ab) != (" " + t).encode() or b"".join(bb) != (" " + t).encode():
            return [], [], []
        ea, eb, out, i, j = ends(ab), ends(bb), [], 0, 0
        for c in sorted(set(ea) & set(eb)):
            k, m = ea.index(c) + 1, eb.index(c) + 1
            out.append((e.ids[i:k], ids[j:m]))
            i, j = k, m
        return e.ids, ids, out

    return groups


TEXTS = ["hello world", "  two  spaces ", " ", "   ", "a\nb\n\n  c", "tab\t x  y　 z",
         "don't it's 'S we'll", "12 345 6,7", "日本語のテキスト です", "emoji 😀 👩‍👩‍👧 end", "▁ literal ▁▁x",
         "<|endoftext|> <s> </s> <unk> <0x41>", "naïve Ünï çé", "x" * 300 + " " + "ab" * 200,
         "\x00\x01 \x1c \x85 q", "!!! ??? #### $$", "ÀÉ Ö ß × ÷ ÿ  à ", None, "", "hello world",
         "word " * 400, "ﬁ ligature ½ ①", "é combining", "​ zero​ width"]


@settings(max_examples=150, deadline=None)
@given(st.lists(st.sampled_from(list("ab  \n\t'sé▁日😀\u3000\xa0\x851.,") + ["the ", " of", "ing"]),
                max_size=40).map("".join))
def test_pieces_equal_whole_texts(t):
    a, b = vocabularies()
    want = whole_text_groups()(t)
    data, at = alignment.spaced(*text.texts_of(pa_strings([t])))
    total, good, texts, *_ = alignment.align_texts(alignment.Pieces(a, b), data, at)
    assert total[0].tolist()[:3] == [len(want[0]), len(want[1]), len(want[2])]
    assert texts[0] == ";".join(",".join(map(str, u)) + "|" + ",".join(map(str, v))
                                for u, v in want[2]).encode()


def pa_strings(values):
    import pyarrow as pa
    return pa.array(values, pa.string())


@pytest.mark.parametrize("hot", [1 << 18, 12, 0])
def test_alignment(frame, hot):
    import public_tokenizers as p
    with open(p.path("byte_bpe_50k.json"), "rb") as f, open(p.path("piece_bpe_32k.model"), "rb") as g:
        first, second = f.read(), g.read()
    pattern = p.PATTERN
    rows = [*enumerate(TEXTS), (None, "hello world"), (3, "hello there")]
    got = alignment.align(frame(rows).repartition(3), lambda: alignment.byte_level(first, pattern),
                          lambda: alignment.piece_level(second), keep=("print", "start"),
                          hot=hot).collect()
    groups, parts, holds = whole_text_groups(), [], collections.Counter()
    for _, t in rows:
        a, b, g = groups(t)
        links = collections.Counter((x, y) for u, v in g for x in u for y in v)
        holds.update(links.keys())
        parts.append((a, b, g, links))
    best = {}
    for (x, _), n in holds.items():
        best[x] = max(best.get(x, 0), n)
    want = []
    for (key, _), (a, b, g, links) in zip(rows, parts):
        listed = ";".join(",".join(map(str, u)) + "|" + ",".join(map(str, v)) for u, v in g)
        want.append((key, "p", "y", len(a), len(b), len(g), sum(links.values()),
                     sum(n for (x, y), n in links.items() if holds[x, y] == best[x]),
                     sum(n * holds[q] for q, n in links.items()),
                     hashlib.sha256(listed.encode()).hexdigest() if g else ""))
    assert sorted(map(tuple, got), key=str) == sorted(want, key=str)
    assert alignment.align(frame([]), lambda: alignment.byte_level(first, pattern),
                           lambda: alignment.piece_level(second)).count() == 0


def test_long_text_in_slices_equals_one_piece(monkeypatch):
    a, b = vocabularies()
    t = " ".join(f"wörd{i % 97} it's\n {i}" for i in range(3000))
    data, at = alignment.spaced(*text.texts_of(pa_strings([t])))
    total, good, texts, pair, times, _ = alignment.align_texts(alignment.Pieces(a, b), data, at)
    monkeypatch.setattr(alignment, "SLICE", 1000)
    long = alignment._long(alignment.Pieces(a, b), data)
    assert long[0].tolist() == total.tolist()
    assert long[1] == hashlib.sha256(texts[0]).hexdigest()
    assert (long[2] == pair).all() and (long[3] == times).all()


def test_wide_groups_are_reduced(monkeypatch):
    a, b = vocabularies()
    t = "日本語" * 50 + " the end of it"
    data, at = alignment.spaced(*text.texts_of(pa_strings([t])))
    want = alignment.align_texts(alignment.Pieces(a, b), data, at)
    monkeypatch.setattr(alignment, "_WIDE", 0)
    got = alignment.align_texts(alignment.Pieces(a, b), data, at)
    for x, y in zip(want, got):
        assert (np.array(x) == np.array(y)).all()


# --- robust outliers -----------------------------------------------------------------------

def counts(t):
    words = [w for w in re.split(r"[\x20\x09-\x0d]+", t or "") if w]
    seen, dup = set(), 0
    for line in (t or "").split("\n"):
        if re.search(r"[^\x20\x09-\x0d]", line):
            dup += line in seen
            seen.add(line)
    windows = collections.Counter(tuple(words[i:i + 8]) for i in range(len(words) - 7))
    inside = {i + k for i in range(len(words) - 7) if windows[tuple(words[i:i + 8])] > 1
              for k in range(8)}
    return (len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", t or "")), dup,
            len(inside))


@settings(max_examples=150, deadline=None)
@given(st.lists(st.text(st.sampled_from("ab é\n\t#<\x0b\x1c"), max_size=80), max_size=5))
def test_counts_of_texts(texts):
    data, at = text.texts_of(pa_strings(texts))
    got = list(zip(*(c.tolist() for c in outliers.count_texts(data, at)), strict=True))
    assert got == [counts(t) for t in texts]


def test_outliers(frame, corpus):
    rng = np.random.default_rng(2)

    def prose(n):
        return " ".join("w" * int(rng.integers(3, 7)) + str(rng.integers(1000)) for _ in range(n))

    rows = [(1000 + i, prose(int(rng.integers(40, 300))), f"s{i % 2}") for i in range(300)]
    odd = [(2000 + i, prose(80).replace(" ", " #$% "), "s0") for i in range(9)]
    odd += [(2100, "supercalifragilisticexpialidocious" * 9 + " " + prose(25).replace(" ", "x" * 90 + " "), "s1")]
    rest = [(k, t, None) for k, t in corpus] + [(None, None, "s1"), (1000, rows[0][1], "s0")]
    df = frame(rows + odd + rest)
    got = outliers.check(df.repartition(4), keep=("source", "print")).collect()
    given = {(k, hashlib.md5(repr(counts(t)).encode()).hexdigest()) for k, t, *_ in rows + odd + rest}
    found = [tuple(r[c] for c in ("n_words", "word_chars", "n_symbols", "n_dup_lines",
                                  "n_repeat_words")) for r in got]
    assert {(r["doc_id"], hashlib.md5(repr(f).encode()).hexdigest())
            for r, f in zip(got, found)} == given
    assert len(got) == len(rows) + len(odd) + len(rest) and {r["print"] for r in got} == {"p"}
    for r, f in zip(got, found):
        assert r["base_failed"] == (f[0] < 20 or 100 * f[4] > 30 * f[0])
        assert not (r["base_failed"] and r["kept"])
        if r["doc_id"] and 1000 <= r["doc_id"] < 1300:
            assert r["kept"], r
        if r["doc_id"] and r["doc_id"] >= 2000:
            assert not r["kept"] and not r["base_failed"], r
    assert outliers.check(frame([])).count() == 0


def test_subset_of_least_determinant():
    """Cells of single rows: the best of many plain concentration runs is found."""
    rng = np.random.default_rng(0)
    d = len(outliers.FEATURES)
    x = np.concatenate((rng.normal(0, 3, (150, d)), rng.normal(30, 1, (40, d))))
    cells = outliers.Cells(np.ones(len(x)), x, np.einsum("ni,nj->nij", x, x).reshape(len(x), -1))
    centre, scatter = cells.estimate(0.75)
    assert np.abs(centre - x[:150].mean(0)).max() < 0.6
    away = x - centre
    distance = np.einsum("ij,ij->i", away @ np.linalg.inv(scatter), away)
    border = outliers.chi2_border(1 - 1e-4, d)
    assert (distance[150:] > border).all() and (distance[:150] < border).mean() > 0.98
    # Rows merged into heavier cells weigh as many.
    twice = outliers.Cells(np.full(len(x), 2.0), 2 * x,
                           2 * np.einsum("ni,nj->nij", x, x).reshape(len(x), -1))
    assert np.allclose(twice.estimate(0.75)[0], centre)


def test_chi_squared_borders():
    assert outliers.chi2_border(0.95, 5) == pytest.approx(11.0705, abs=1e-3)
    assert outliers.chi2_border(0.9999, 5) == pytest.approx(25.7448, abs=1e-3)
    assert outliers.chi2_share(2.0, 2) == pytest.approx(1 - np.exp(-1))


# --- hashes --------------------------------------------------------------------------------

def thue_morse(n, letters="ab"):
    return "".join(letters[bin(i).count("1") % 2] for i in range(n))


@pytest.mark.parametrize("size", [1024, 4096])
def test_words_that_cancel_in_polynomials(frame, size):
    one, two = thue_morse(size), thue_morse(size, "ba")
    data = np.frombuffer(f"{one} {two}".encode(), np.uint8)
    h = text.Words(data, np.array([0, len(data)])).hashes()
    assert h[0] != h[1]
    same = " ".join(f"w{i}" for i in range(19))
    got = {r["doc_id"]: r["n_removed"] for r in debruijn.remove_earlier(frame(
        [(1, f"{same} {one}"), (2, f"{same} {two}"), (3, f"{same} {one}")])).collect()}
    assert got == {1: 0, 2: 0, 3: 20}
    known = kneser.score(frame([(k, one if k % 2 else two) for k in range(30)])).collect()
    assert {r["n_known"] for r in known} == {2}
    first = {r["doc_id"]: r["n_removed"] for r in suffixdedup.remove_repeats(frame(
        [(1, one[:300]), (2, two[:300])]), 280).collect()}
    assert first == {1: 0, 2: 0}


def test_ranges_of_units():
    rng = np.random.default_rng(0)
    units = rng.integers(0, 3, 500).astype(np.uint64)
    start = rng.integers(0, 400, 2000)
    end = start + rng.integers(0, 12, 2000)
    seen = {}
    for a, b, h in zip(start, end, text.unit_hashes(units, start, end).tolist()):
        assert seen.setdefault(tuple(units[a:b].tolist()), h) == h
    assert len(set(seen.values())) == len(seen)


def test_long_texts_are_cut_into_slices(frame):
    rng = np.random.default_rng(5)
    letters = np.frombuffer(b"abcdefghijklmnopqrstuvwxyz      ", np.uint8)
    long = letters[rng.integers(0, 32, 2 * text.SLICE_BYTES + 900_000)].tobytes().decode()
    passage = long[text.SLICE_BYTES - 150:text.SLICE_BYTES + 350]
    spread = f"{long[:900]}|{passage}|"
    rows = [(1, long), (2, "tiny"), (3, f"§{passage}§"), (4, long[100:900])]
    got = {r["doc_id"]: r for r in suffixdedup.remove_repeats(frame(rows)).collect()}
    assert [got[k]["n_removed"] for k in (1, 2, 3, 4)] == [500 + 800, 0, 500, 800]
    assert [got[k]["n_spans"] for k in (1, 2, 3, 4)] == [2, 0, 1, 1]
    words = debruijn.remove_earlier(frame([(1, long), (2, spread)]), 10)
    cut = {r["doc_id"]: (r["n_words"], r["n_removed"]) for r in words.collect()}
    assert cut[1][1] == 0 and cut[1][0] == len(long.split())
    inside = spread.replace("|", " | ").split(" | ")
    assert cut[2][1] >= len(inside[0].split()) + len(inside[1].split()) - 4


@pytest.mark.parametrize("group", [1, 20, 1000])
def test_passage_with_very_many_neighbours(frame, group):
    """One anchor with thousands of kinds of chunks, cut apart by content or not."""
    rng = np.random.default_rng(1)

    def noise(n):
        return "".join(chr(97 + c) for c in rng.integers(0, 26, n))

    passage = noise(260)
    rows = [(i, f"{noise(int(rng.integers(0, 220)))}{passage}{noise(int(rng.integers(0, 220)))}")
            for i in range(400)]
    got = suffixdedup.remove_repeats(frame(rows), group=group, shard_bytes=20_000).collect()
    want = brute.removed_bytes([t for _, t in rows], 200)
    assert sorted((r["doc_id"], r["n_bytes"], r["n_removed"], r["n_spans"], r["kept_sha256"])
                  for r in got) == [(k, *w) for (k, _), w in zip(rows, want)]
    assert min(w[1] for w in want) >= 260


# --- hinge loss ----------------------------------------------------------------------------

def test_hinge_loss_is_minimised():
    """The gap between primal and dual objective closes, so the weights are the best there are."""
    rng = np.random.default_rng(0)
    rows = [np.unique(rng.integers(0, 60, rng.integers(1, 20))) for _ in range(120)]
    label = np.array([int((r < 20).sum() > (r >= 40).sum()) for r in rows], np.int8)
    at = np.concatenate(([0], np.cumsum([len(r) for r in rows])))
    sample = quality.Sample(at, np.concatenate(rows).astype(np.int32), label)
    everything = np.arange(len(rows))
    ratio = sample.ratios(everything)
    for c in (0, 1):
        seen = np.bincount(np.concatenate([r for r, y in zip(rows, label) if y == c]), minlength=60)
        if c:
            p = 1 + seen
        else:
            q = 1 + seen
    wide = np.log(p / (p.sum() + quality.BUCKETS - 60)) - np.log(q / (q.sum() + quality.BUCKETS - 60))
    assert np.allclose(ratio[:60], wide)
    cost = 0.7
    weight, alpha = quality.fit_hinge(sample, everything, ratio, cost, 3000)
    norm = sample.norms(ratio, everything)
    sign = np.where(label == 1, 1.0, -1.0)
    margin = np.array([weight[sample.row(i)] @ ratio[sample.row(i)] for i in everything]) / norm
    primal = 0.5 * weight @ weight + cost * np.maximum(0, 1 - sign * margin).sum()
    dual = alpha.sum() - 0.5 * weight @ weight
    assert 0 <= alpha.min() and alpha.max() <= cost
    assert primal - dual < 1e-2 * primal


# --- packing -------------------------------------------------------------------------------

def test_copies_and_sources_keep_apart(frame, corpus):
    from assayframe.llm import packing, simhash

    rng = np.random.default_rng(4)
    base = [" ".join(f"w{rng.integers(500)}" for _ in range(60)) for _ in range(12)]
    rows = [(i, t, f"s{i}") for i, t in enumerate(base)]
    rows += [(100 + i, t.upper(), f"t{i}") for i, t in enumerate(base)]
    rows += [(200 + i, t.replace("w", "v", 1), f"u{i}") for i, t in enumerate(base)]
    rows += [(300 + i, None, f"x{i}") for i in range(6)] + [(400, base[0], "s1"), (400, base[0], "s1")]
    df = frame(rows)
    out = packing.pack_apart(df, capacity=200, shard=10_000).collect()
    words = {k: len((t or "").split()) for k, t, _ in rows}
    total = collections.Counter()
    for r in out:
        total[r["doc_id"], r["copy"]] += r["size"]
    assert total == {(k, c): words[k] for k, c in [(k, 0) for k in words] + [(400, 1)]}
    group = {r["doc_id"]: r["root"] for r in simhash.near_duplicates(df).collect()}
    assert len({group[i] for i in range(12)}) > 6
    source, bins = {k: s for k, _, s in rows}, collections.defaultdict(list)
    for r in out:
        bins[r["bin_id"]].append(r)
    for held in bins.values():
        assert sum(r["size"] for r in held) <= 200
        told = [group[r["doc_id"]] for r in held if r["size"]]
        assert len(told) == len(set(told))
        seen = [source[r["doc_id"]] for r in held]
        assert len(seen) == len(set(seen))
    assert packing.pack_apart(frame([])).count() == 0


def test_keep_one_carries_columns_of_any_name(spark):
    from assayframe.llm import simhash

    rows = [(2, "a b c d e", "mine", "yours", 1), (1, "a b c d e", "kept", "too", 2),
            (5, None, "empty", None, 3), (4, "", "first", "x", 4), (None, "other words here now", "z", "", 5)]
    df = spark.createDataFrame(rows, "doc_id long, text string, near_key string, near_text string, row int")
    got = simhash.keep_one(df)
    assert got.columns == df.columns
    assert sorted(map(tuple, got.collect()), key=str) == sorted(
        [rows[1], rows[3], rows[4]], key=str)
