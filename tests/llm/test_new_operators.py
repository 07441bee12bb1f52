"""Vector codes, whitening and MinHash near-duplicates against plain versions, with the cases their docstrings name."""

import hashlib
import math
import random
from collections import Counter

import numpy as np
import pytest

from millrace.llm import minhash, vector_codes, whitening
from millrace.llm.near_duplicates import sets
from tests.llm.test_llm import ODD, SF, WORD, frame, lower

SCHEMA = "vec_id long, embedding array<double>, label int, code string, n int"  # the last two clash with outputs


def vector_frame(spark, rows):
    return spark.createDataFrame([(i, v, label, "x", 1) for i, v, label in rows], SCHEMA)


def odd_vectors(dims):
    nan, inf = float("nan"), float("inf")
    return [(9000, None, 1), (9001, [nan] + [0.0] * (dims - 1), 1), (9002, [0.0] * (dims - 1) + [inf], 2),
            (9003, [None] + [1.0] * (dims - 1), 3)]


def some_vectors(n, dims, seed=0):
    r = np.random.Generator(np.random.PCG64(seed))
    x = r.normal(size=(n, dims)) * r.uniform(0.02, 0.4, dims) + r.normal(size=dims)
    return [(int(i * 7 % (10 * n)), v.tolist(), [None, 1, 2][i % 3]) for i, v in enumerate(x)]


# 11


def plain_codes(rows, parts=4, entries=256, rounds=4, factor=1024):
    good = [(i, v, t) for i, v, t in rows if v is not None and all(c is not None and math.isfinite(c) for c in v)]
    good.sort(key=lambda r: (r[0] is None, r[0] or 0, r[1]))
    x = np.array([[math.floor(factor * c) for c in v] for _, v, _ in good], dtype=object)
    dims = x.shape[1]
    edges = [dims * p // parts for p in range(parts + 1)]
    found = []
    for a, b in zip(edges, edges[1:]):
        own = x[:, a:b].astype(np.int64)
        book = own[:entries].copy()
        for step in range(rounds + 1):
            gaps = ((own[:, None, :] - book[None]) ** 2).sum(axis=2)
            code, error = gaps.argmin(axis=1), gaps.min(axis=1)
            if step < rounds:
                for e in range(len(book)):
                    if (code == e).any():
                        book[e] = own[code == e].sum(axis=0) // (code == e).sum()
        found.append((code, error, book))
    codes = ["".join(f"{int(c[i]):02x}" for c, _, _ in found) for i in range(len(good))]
    errors = [sum(int(e[i]) for _, e, _ in found) for i in range(len(good))]
    by_label = Counter()
    for (_, _, label), e in zip(good, errors, strict=True):
        by_label[label] += e
    text = ",".join(str(v) for _, _, book in found for entry in book for v in entry)
    return Counter((i, c, e, by_label[label]) for (i, _, label), c, e in zip(good, codes, errors, strict=True)), \
        hashlib.sha256(text.encode()).hexdigest()


@pytest.mark.parametrize(("n", "dims"), [(1500, 16), (300, 10), (40, 8), (1, 4)])
def test_vector_codes_equal_plain(spark, n, dims):
    rows = some_vectors(n, dims) + odd_vectors(dims)
    rows += [rows[0], (None, rows[0][1], None), (5, [0.0] * dims, 1), (rows[0][0], [1.5] * dims, 2)]
    want, sha = plain_codes(rows)
    coded, model = vector_codes.compress(vector_frame(spark, rows).repartition(5), label="label")
    got = vector_codes.with_label_errors(coded)
    assert Counter((r.vec_id, r.code, r.error, r.label_error) for r in got.collect()) == want
    assert vector_codes.digest(model) == sha


def test_vector_codes_odd_tables(spark):
    coded, model = vector_codes.compress(vector_frame(spark, odd_vectors(4)), label="label")
    assert vector_codes.with_label_errors(coded).count() == 0 and model.text == ""
    coded, _ = vector_codes.compress(vector_frame(spark, [(1, [0.5, 0.25], 1), (2, [0.5], 1), (3, [1e300, -1e300], None)]))
    assert [(r.vec_id, r.code) for r in coded.orderBy("vec_id").collect()] == [(1, "00000000"), (2, None), (3, "00010001")]
    coded, _ = vector_codes.compress(vector_frame(spark, [(1, [], 1), (2, [], 1)]))
    assert [(r.code, r.error) for r in coded.collect()] == [("00000000", 0)] * 2


def test_blocks_of_any_size_agree(spark, monkeypatch):
    rows = some_vectors(700, 12, 3)
    whole = vector_codes.compress(vector_frame(spark, rows))
    dealt = vector_codes.compress(vector_frame(spark, rows).repartition(64))
    assert whole[1].text == dealt[1].text
    assert Counter(map(tuple, whole[0].collect())) == Counter(map(tuple, dealt[0].collect()))


# 12


def check_whitening(rows, got, components=32):
    good = [(i, v) for i, v, _ in rows if v is not None and all(c is not None and math.isfinite(c) for c in v)]
    ints = [[math.floor(64 * c) + 1_000_000 for c in v] for _, v in good]
    n, dims = len(ints), len(ints[0])
    sums = [sum(col) for col in zip(*ints)]
    deviation = [sum((n * c - s) ** 2 for c, s in zip(row, sums, strict=True)) for row in ints]
    x = np.array([[(n * c - s) / n for c, s in zip(row, sums, strict=True)] for row in ints])
    spread, w = np.linalg.svd(np.concatenate((x, np.zeros((dims, dims)))))[1:]  # more exact than the covariance's vectors
    e, w = spread ** 2 / n, w.T
    kept = min(components, dims)
    assert len(got) == n * kept
    by_component = {}
    for r in got:
        by_component.setdefault(r.component, []).append(r)
    assert sorted(by_component) == list(range(1, kept + 1))
    scale = max(e[0], 1e-30)
    for k in range(kept):
        own = by_component[k + 1]
        assert {r.n for r in own} == {n}
        assert Counter((r.vec_id, r.deviation) for r in own) == Counter((i, d) for (i, _), d in zip(good, deviation, strict=True))
        if e[k] < 1e-24 * scale or not e[0]:
            assert all(r.whitened is None and not r.explained for r in own)
            continue
        assert abs(own[0].explained / (e[k] / e.sum()) - 1) < 1e-9
        values = {(r.vec_id, r.deviation): r.whitened for r in own}
        plain = {(i, d): value for (i, _), d, value in zip(good, deviation, x @ w[:, k] / np.sqrt(e[k]), strict=True)}
        sign = np.sign(sum(values[q] * plain[q] for q in plain))
        assert max(abs(sign * values[q] - plain[q]) for q in plain) < 1e-6
    errors = {r.identity_error for r in got}
    assert len(errors) == 1 and (errors == {None} or errors.pop() < 1e-9)


@pytest.mark.parametrize(("n", "dims"), [(900, 40), (500, 6), (10, 24), (1, 3)])
def test_whitening_equals_plain(spark, n, dims):
    rows = some_vectors(n, dims, 5)
    rows = [(i, v, label) for i, v, label in rows] + [(70_001, rows[0][1], None), (70_002, rows[-1][1], 4)]
    if n == 500:
        rows = [(i, [*v[:-1], 2.5], label) for i, v, label in rows]  # a constant dimension
    got, _ = whitening.whiten(vector_frame(spark, rows + odd_vectors(dims)).repartition(4))
    check_whitening(rows, got.collect())


def test_whitening_of_near_dependent_dimensions(spark):
    r = np.random.Generator(np.random.PCG64(8))
    x = r.normal(size=(800, 5)) * 3000
    x = np.concatenate((x, x[:, :1] + r.normal(size=(800, 1)) * 0.02, x[:, :1] * 2), axis=1)  # one nearly, one wholly dependent
    rows = [(i, np.round(v, 6).tolist(), 0) for i, v in enumerate(x)]
    got, model = whitening.whiten(vector_frame(spark, rows))
    check_whitening(rows, got.collect())
    assert model.identity_error < 1e-6


def test_whitening_odd_tables(spark):
    found, model = whitening.whiten(vector_frame(spark, odd_vectors(4)))
    assert found.count() == 0 and model is None and found.columns[:5] == ["vec_id", "component", "n", "deviation", "whitened"]
    found, _ = whitening.whiten(vector_frame(spark, [(1, [1.0, 2.0], 0), (2, [3.0], 0), (None, [2.0, 5.0], 0), (3, [4.0, 1.0], 0)]))
    rows = found.orderBy("vec_id", "component").collect()
    assert [(r.vec_id, r.component, r.n) for r in rows] == [(i, c, 3) for i in (None, 1, 2, 3) for c in (1, 2)]
    assert [r.whitened is None for r in rows] == [i == 2 for i in (None, None, 1, 1, 2, 2, 3, 3)]


def test_whitening_of_large_sums():
    centre = whitening.Centre(3_000_000_000, [3_000_000_001 * 7, 5])
    row = np.array([[1_000_000_000, -1_000_000_000], [7, 0]], np.int64)
    exact = [(3_000_000_000 * int(a) - 3_000_000_001 * 7) ** 2 + (3_000_000_000 * int(b) - 5) ** 2 for a, b in row]
    assert centre.deviations(row) == [None if d >= 1 << 63 else d for d in exact] and exact[1] < 1 << 63 < exact[0]


def test_solve_rows():
    r = np.random.Generator(np.random.PCG64(1))
    a, t = r.normal(size=(30, 7)), np.triu(r.normal(size=(7, 7))) + 3 * np.eye(7)
    assert np.allclose(whitening.solve_rows(a, t) @ t, a)


# 13


def shingles(text, words=4):
    w = WORD.findall(lower(text or ""))
    return {tuple(w[k:k + words]) for k in range(len(w) - words + 1)} if len(w) >= words else ({tuple(w)} if w else set())


def plain_classes(rows):
    own = {i: shingles(t) for i, t in rows}
    top = {i: i for i in own}

    def root(x):
        while top[x] != x:
            x = top[x]
        return x

    for a in sorted(own):
        for b in sorted(own):
            both = len(own[a] & own[b])
            if a < b and both and 100 * both >= 80 * (len(own[a]) + len(own[b]) - both):
                x, y = sorted((root(a), root(b)))
                top[y] = x
    return {(i, len(own[i]), root(i), i == root(i)) for i in own}


def copies(seed, n, lengths):
    r = random.Random(seed)
    words = [f"w{i}" for i in range(3000)]
    stock = [[r.choice(words) for _ in range(k)] for k in lengths]
    rows = []
    for i in range(n):
        base = r.choice(stock)
        change = (lambda: [x if r.random() > .01 else r.choice(words) for x in base],
                  lambda: base + [r.choice(words) for _ in range(max(1, int(len(base) * r.choice([.08, .15, .3]))))],
                  lambda: base[r.randrange(4):] + [r.choice(words) for _ in range(r.randrange(4))],
                  lambda: [x if r.random() > .03 else r.choice(words) for x in base])[i % 4]()
        rows.append((100 + i, " ".join(change)))
    return rows


@pytest.mark.parametrize("seed", [3, 4])
def test_minhash_equals_plain(spark, seed):
    rows = list(enumerate(ODD)) + copies(seed, 360, (6, 9, 30, 54, 61, 110, 400))
    got = minhash.near_duplicates(frame(spark, rows)).collect()
    assert set(map(tuple, got)) == plain_classes(rows) and len(got) == len(rows)


def test_minhash_of_shared_passages(spark):
    """Documents that share most of their values and are no copies: their lists stay mixed and are worked through in blocks."""
    r = random.Random(5)
    words = [f"w{i}" for i in range(4000)]
    passage = [r.choice(words) for _ in range(200)]
    rows = [(i, " ".join(passage + [r.choice(words) for _ in range(r.choice((70, 75, 80)))])) for i in range(120)]
    rows += [(200 + i, rows[i][1] + " end") for i in range(0, 120, 9)]
    want = plain_classes(rows)
    assert len({c for _, _, c, _ in want}) > 100
    assert set(map(tuple, minhash.near_duplicates(frame(spark, rows)).collect())) == want


def test_minhash_odd_rows(spark):
    text = " ".join(f"w{i}" for i in range(30))
    other = " ".join(f"v{i}" for i in range(90))
    rows = [(1, text), (1, text), (2, text.upper()), (2, "other words"), (None, text), (5, None), (6, ""),
            (7, text + " a"), (7, other), (8, other + " b"), (9, other)]
    got = Counter(map(tuple, minhash.near_duplicates(frame(spark, rows)).collect()))
    assert got == Counter({(1, 27, 1, True): 2, (2, 27, 1, False): 1, (2, 1, 2, True): 1, (None, 27, None, True): 1, (5, 0, 5, True): 1,
                           (6, 0, 6, True): 1, (7, 28, 1, False): 1, (7, 87, 7, True): 1, (8, 88, 7, False): 1, (9, 87, 7, False): 1})
    assert minhash.near_duplicates(frame(spark, [])).count() == 0


def test_estimate_passes_links():
    r, n = np.random.Generator(np.random.PCG64(2)), 0
    assert minhash.needed(51) == 41 and minhash.needed(64) <= minhash.least_shared()
    for _ in range(3000):
        size = int(r.integers(52, 2000))
        own = r.integers(0, 1 << 63, size * 9 // 8 + 2, dtype=np.uint64)
        both = -(-8 * len(own) // 10)
        a, b = np.sort(own[:size]), np.sort(own[-size:])
        inside = 2 * size - len(own)
        if inside >= both:
            n += 1
            assert minhash.estimate(a[:minhash.KEPT], b[:minhash.KEPT], size, size)
    assert not minhash.estimate(np.arange(64, dtype=np.uint64), np.arange(100, 164, dtype=np.uint64), 500, 500)
    assert [len(x) for x in sets(["a b c", "a b c d e", ""], 4)] == [1, 2, 0]
