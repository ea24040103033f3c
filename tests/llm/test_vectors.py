"""Vector codes and whitening against brute force."""

from __future__ import annotations

import collections
import hashlib
import random

import numpy as np
import pytest

from tests.conftest import SF_TINY
from tidemark.llm import vector_codes, whitening
from tidemark.llm.queries import QUERIES

SCHEMA = "vec_id long, embedding array<float>, label int, row string, x int, part int, index int"


def kept(rows):
    sizes = collections.Counter(len(r[1]) for r in rows if usable(r[1]))
    if not sizes:
        return []
    most = min(sizes, key=lambda k: (-sizes[k], k))
    return [r for r in rows if usable(r[1]) and len(r[1]) == most]


def usable(vector):
    return bool(vector) and all(c is not None and np.isfinite(c) and abs(c) < 1 << 17 for c in vector)


def brute_codes(rows, entries=256, rounds=4):
    """vec_id, label, code, error of every row and the codebooks, by plain loops over everything."""
    x = np.array([np.floor(1024 * np.float32(r[1]).astype(np.float64)) for r in rows]).astype(np.int64)
    first = sorted(range(len(rows)), key=lambda i: (rows[i][0] is None, rows[i][0] or 0, x[i].tolist()))[:entries]
    ends = vector_codes.bounds(x.shape[1])
    books, codes, error = [], [], np.zeros(len(rows), np.int64)
    for a, b in zip(ends, ends[1:]):
        p = x[:, a:b]
        book = p[first].copy()
        for k in range(rounds + 1):
            d = ((p[:, None, :] - book[None]) ** 2).sum(axis=2)
            best = d.argmin(axis=1)
            if k < rounds:
                for e in set(best.tolist()):
                    book[e] = [int(s) // int((best == e).sum()) for s in p[best == e].sum(axis=0)]
        books.append(book)
        codes.append(best)
        error += d[np.arange(len(p)), best]
    return [(r[0], r[2], "".join(f"{c[i]:02x}" for c in codes), int(error[i])) for i, r in enumerate(rows)], books


def brute_whitening(rows):
    x = np.array([np.floor(64 * np.float32(r[1]).astype(np.float64)) for r in rows]).astype(np.int64) + 1_000_000
    u = np.unique(x, axis=0)
    n, s = len(u), u.sum(axis=0)
    v = (u - s / n).T @ (u - s / n) / n
    e, vectors = np.linalg.eigh(v)
    order = np.argsort(-e)
    return x, n, ((n * x - s) ** 2).sum(axis=1), e[order], vectors[:, order], x - s / n


def odd_rows(dimension=10):
    rng = random.Random(4)
    rows = [[i, [rng.gauss(0, 0.2) for _ in range(dimension)], i % 3 if i % 7 else None, "r", 1, 2, 3] for i in range(700)]
    for i in range(0, 90):
        rows[i][1] = rows[200][1]
    rows[91][1], rows[92][1], rows[93][1], rows[94][1] = None, [], [0.1] * (dimension - 1), [None] * dimension
    rows[95][1], rows[96][1] = [float("nan")] * dimension, [float("inf")] + [0.0] * (dimension - 1)
    rows[97][1] = [3.0e5] + [0.0] * (dimension - 1)
    rows[98][0] = rows[99][0]
    rows[100][0] = None
    rows[101][1] = [-1000.0] * dimension
    return [tuple(r) for r in [*rows, rows[5]]]


@pytest.mark.parametrize("dimension", [10, 3, 16])
def test_codes(spark, dimension):
    rows = odd_rows(dimension)
    want, books = brute_codes(kept(rows))
    codes, found = vector_codes.compressed(spark.createDataFrame(rows, SCHEMA).repartition(5))
    assert all((a == b).all() for a, b in zip(books, found, strict=True))
    got = vector_codes.with_label_errors(codes).collect()
    assert sorted(map(repr, want)) == sorted(repr((r.vec_id, r.label, r.code, r.error)) for r in got)
    sums = collections.Counter()
    for r in want:
        sums[r[1]] += r[3]
    assert all(r.label_error == sums[r.label] for r in got)


def test_few_and_no_vectors(spark):
    rows = odd_rows()[200:203]
    codes, books = vector_codes.compressed(spark.createDataFrame(rows, SCHEMA))
    assert len(books[0]) == 3 and all(r.error == 0 for r in codes.collect())
    none = spark.createDataFrame(rows, SCHEMA).limit(0)
    codes, books = vector_codes.compressed(none)
    assert vector_codes.with_label_errors(codes).collect() == [] and books == []
    assert whitening.whitened(none).collect() == []
    assert whitening.whitened(spark.createDataFrame([rows[0], rows[0]], SCHEMA)).collect() == []


def test_curve_is_a_walk():
    bits = 3
    grid = np.array([(a, b, c) for a in range(8) for b in range(8) for c in range(8)])
    order = np.argsort(vector_codes.hilbert(grid, bits))
    assert sorted(vector_codes.hilbert(grid, bits).tolist()) == list(range(512))
    assert (np.abs(np.diff(grid[order], axis=0)).sum(axis=1) == 1).all()


def test_kernels_agree_in_both_kinds():
    rng = np.random.default_rng(2)
    for top in (900, 1 << 27):
        points, book = rng.integers(-top, top, (200, 16)), rng.integers(-top, top, (40, 16))
        book[7] = book[3]
        best, distance = vector_codes.nearest_entries(points, book)
        all_of = [[sum((int(a) - int(b)) ** 2 for a, b in zip(p, e, strict=True)) for e in book] for p in points]
        assert best.tolist() == [d.index(min(d)) for d in all_of] and distance.tolist() == [min(d) for d in all_of]
    listed = vector_codes.shortlists(points[:50].min(axis=0)[None], points[:50].max(axis=0)[None], book)[0]
    assert set(np.flatnonzero(listed)) >= set(best[:50].tolist())


def test_code_query(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{SF_TINY}/embeddings.parquet").select("vec_id", "embedding", "label").collect()]
    want, books = brute_codes(kept(rows))
    got = QUERIES["op11_vector_codes"](spark, SF_TINY).collect()
    digest = hashlib.sha256(",".join(str(v) for b in books for row in b.tolist() for v in row).encode()).hexdigest()
    assert {r.codebooks_sha256 for r in got} == {digest}
    assert sorted((r[0], r[2], r[3]) for r in want) == sorted((r.vec_id, r.code, r.error) for r in got)


def check_whitening(got, rows):
    x, n, deviation, e, vectors, centred = brute_whitening(rows)
    size = min(16, int((e > 1e-12 * e.max()).sum()))
    assert len(got) == size * len(rows)
    by_id = collections.defaultdict(list)
    for i, r in enumerate(rows):
        by_id[r[0]].append(i)
    assert {r.n for r in got} == {n} and all(r.identity_error <= 1e-6 for r in got)
    for k in range(size):
        mine = [r for r in got if r.component == k + 1]
        assert all(abs(r.explained - e[k] / e.sum()) <= 1e-9 for r in mine)
        want = collections.defaultdict(list)
        for i, r in enumerate(rows):
            want[r[0]].append((float((centred[i] @ vectors[:, k]) / np.sqrt(e[k])), int(deviation[i])))
        found = collections.defaultdict(list)
        for r in mine:
            found[r.vec_id].append((r.whitened, r.deviation))
        assert want.keys() == found.keys()
        largest = max((abs(v[0]), key) for key, vs in want.items() for v in vs if len(vs) == 1)[1]
        sign = 1 if want[largest][0][0] * found[largest][0][0] > 0 else -1
        for key, vs in want.items():
            assert np.allclose(sorted(sign * v[0] for v in vs), sorted(v[0] for v in found[key]), atol=1e-7)
            assert sorted(v[1] for v in vs) == sorted(v[1] for v in found[key])


def test_whitening(spark):
    rows = [r for r in odd_rows(18) if not r[1] or not 1000 <= abs(r[1][0] or 0) < 1e6]  # their squares exceed a long
    got = whitening.whitened(spark.createDataFrame(rows, SCHEMA).repartition(5)).collect()
    inside = [r for r in rows if r[1] and len(r[1]) == 18 and all(c is not None and np.isfinite(c) for c in r[1])]
    check_whitening(got, inside)


def test_whitening_query(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{SF_TINY}/embeddings.parquet").select("vec_id", "embedding").collect()]
    check_whitening(QUERIES["op13_whitening"](spark, SF_TINY).collect(), rows)


def test_large_deviations(spark):
    model = whitening.Whitening(3, [9, 12], [-(1 << 40), 0], [1 << 40, 5], np.zeros((2, 0)), [])
    got = spark.createDataFrame([([1 << 30, 4],), ([5, 1 << 40],)], "x array<long>").select(whitening.squared_deviation(model)).collect()
    assert [r[0] for r in got] == [None if v >= 1 << 63 else v for v in ((3 * (1 << 30) - 9) ** 2, 36 + (3 * (1 << 40) - 12) ** 2)]


def test_code_sql(spark):
    from tests.oracle_check import compare, duck
    from tidemark.llm.queries import ORACLES

    assert compare(QUERIES["op11_vector_codes"](spark, SF_TINY), duck(SF_TINY), ORACLES["op11_vector_codes"]) == []
