import random

import numpy as np
import pyarrow as pa

from millrace.llm import near_duplicates as nd


def some(r, n):
    return np.unique(np.array([r.randrange(1 << 64) for _ in range(n)], dtype=np.uint64))


def changed(r, own, most):
    """A set that links to ``own`` and differs from it in ``most`` shingles at the most."""
    lost = r.randrange(most // 2 + 1)
    kept = own[sorted(r.sample(range(len(own)), len(own) - lost))]
    return np.unique(np.concatenate((kept, some(r, r.randrange(most - lost + 1)))))


def test_parities_lose_no_link():
    r = random.Random(3)
    for n in (5, 120, 255, 256, 257, 300, 500, 512, 900):
        own = some(r, n)
        others = [changed(r, own, n // 4) for _ in range(60)]
        linked = [x for x in others if (b := len(np.intersect1d(own, x))) * 100 >= 80 * (len(own) + len(x) - b)]
        assert linked
        pack = lambda x: np.frombuffer(nd.parities(x), np.uint64)
        block = nd._Block([(i, i, len(x), pack(x)) for i, x in enumerate(linked)] + [(-1, -1, n, pack(some(r, n)))])
        got = sorted(block.near(-2, n, pack(own)))
        assert got[-len(linked):] == list(range(len(linked))) and (n < 100 or got[0] == 0)
        assert 0 not in list(block.near(0, n, pack(own)))  # of one component


def test_left_out_segments_lose_no_link():
    """Sets that skip every segment in which they agree still meet by a deletion, with fewer segments written than before."""
    r, met = random.Random(4), 0
    for _ in range(300):
        n = r.randrange(70, 400)
        own = some(r, n)
        other = changed(r, own, n // 4)
        both = len(np.intersect1d(own, other))
        if 100 * both < 80 * (len(own) + len(other) - both):
            continue
        for band in {b for b, _ in nd.families(len(own))} & {b for b, _ in nd.families(len(other))}:
            m, _ = nd.segments(band)
            if m == 0:
                continue
            facts = [(x, dict(nd.families(len(x)))[band], *nd.subsets(x, band)[2:]) for x in (own, other)]
            agreed = facts[0][2] == facts[1][2]
            least = [m - 1 - nd.most_different(len(x), band, low) for x, low, *_ in facts]
            if facts[0][1] and facts[1][1]:
                continue  # they meet in their own band
            assert agreed.sum() > max(least) >= nd.segments(band)[1]
            if any((agreed | e).sum() > (m + s) // 2 for (*_, e), s in zip(facts, least, strict=True)):
                continue  # such a set opens some of them again
            rows = [written(x, low, band, facts[0][2][agreed & ~e]) for x, low, _, e in facts]
            assert rows[0][0] & rows[1][1] or rows[0][1] & rows[1][0]
            assert all(len(w[0]) <= m - (m + s) // 2 for w, s in zip(rows, least, strict=True))
            met += 1
    assert met > 20


def written(own, low, band, skipped):
    """Signatures of both kinds that a set writes in a band."""
    out, sets = ({}, {}), nd.sets
    nd.sets = lambda _: [own]
    try:
        batch = pa.RecordBatch.from_pydict({"doc": [1], "n": [len(own)], "h": [nd.name_of(own)], "lows": [[low]],
                                            "skipped": [skipped.astype(np.int64).tolist()], "text": ["x"]})
        rows = [x for b in nd._neighbourhoods([batch]) for x in b.to_pylist()]
    finally:
        nd.sets = sets
    return tuple({x["sig"] for x in rows if x["kind"] == k} for k in (0, 1))


def test_large_sets_part_before_their_texts():
    """Sketches of 512 bits tell nothing of thousands of shingles; parities do, and lose no link."""
    r = random.Random(6)
    own = some(r, 3000)
    half = np.unique(np.concatenate((own[:1500], some(r, 1500))))
    linked = [changed(r, own, 600) for _ in range(20)]
    bits = sum((x ^ y).bit_count() for x, y in zip(*(np.array(nd.sketch(x)).view(np.uint64).tolist() for x in (own, half)), strict=True))
    assert bits * (nd.WHOLE + nd.PART) <= 6000 * (nd.WHOLE - nd.PART)
    rows = [(0, 0, own), (1, 1, half), *((1, i + 2, x) for i, x in enumerate(linked))]
    batches = [pa.RecordBatch.from_pylist([{"a": 0, "slice": 0, "kind": kind, "b": b, "n": len(x), "bits": nd.parities(x)}
                                           for kind, b, x in part]) for part in (rows[:2], rows[2:])]
    assert [tuple(x.values()) for b in nd._near(batches) for x in b.to_pylist()] == [(0, i + 2) for i in range(len(linked))]


def test_signatures_are_short_and_apart():
    r, sets = random.Random(7), nd.sets
    for n in (4, 60, 75, 76, 200, 3000):
        own = some(r, n)
        nd.sets = lambda _, own=own: [own]
        try:
            got = [x for b in nd._signatures([pa.RecordBatch.from_pydict({"doc_id": [1], "text": ["x"]})]) for x in b.to_pylist()]
        finally:
            nd.sets = sets
        assert {x["h"] for x in got} == {nd.name_of(own)} and all(0 <= x["sig"] < 2 * nd.LOW for x in got)
        for band, low in nd.families(n):
            *_, signs, empty = nd.subsets(own, band)
            assert len(set(signs.tolist())) == len(signs) and signs.max() < nd.LOW
            assert set(signs[~empty].astype(np.int64).tolist()) == {x["sig"] % nd.LOW for x in got if (x["sig"] >= nd.LOW) == low}
