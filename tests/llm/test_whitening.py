from __future__ import annotations

import numpy as np
import pytest

from campuslake.llm import whitening as wh

RNG = np.random.default_rng(5)
A, B = (np.linalg.qr(RNG.normal(size=(30, 30)))[0] for _ in range(2))
TRIANGLES = {
    "one": np.array([[3.0]]),
    "random": np.linalg.qr(RNG.normal(size=(200, 64)), mode="r"),
    "graded": np.linalg.qr(RNG.normal(size=(500, 30)) * np.exp(-np.arange(30)), mode="r"),
    "identity": np.eye(6) * 3,
    "zero": np.zeros((4, 4)),
    "rank 3": np.pad(np.linalg.qr(RNG.normal(size=(3, 10)), mode="r"), ((0, 7), (0, 0))),
    "equal values": A @ np.diag(np.r_[1, 1, 1 + 1e-12, 0.5, 0.5, np.linspace(0.4, 0.1, 25)]) @ B,
    "close values": A @ np.diag(np.r_[1, 1 - 1e-6, 1 - 2e-6, 0.5, 0.5 - 1e-9, np.linspace(0.4, 0.1, 25)]) @ B,
}


@pytest.mark.parametrize("name", TRIANGLES)
def test_values_and_directions(name):
    r = TRIANGLES[name]
    values, found = wh.principal(r, 8)
    want = np.linalg.svd(r, compute_uv=False)
    top = max(want[0], 1e-300)
    assert np.abs(np.sqrt(values) - want).max() <= 1e-14 * top
    assert found.shape[1] == min(8, int((want > 1e-12 * top).sum()))
    assert np.abs(found.T @ found - np.eye(found.shape[1])).max(initial=0) < 1e-13
    assert np.abs(r.T @ (r @ found) - found * values[: found.shape[1]]).max(initial=0) <= 1e-13 * top**2


def test_many_matrices():
    rng = np.random.default_rng(3)
    for k in range(300):
        d = int(rng.integers(2, 30))
        r = rng.normal(size=(d, d))
        if k % 5 == 1:  # columns of very different sizes
            r = r * 10.0 ** rng.integers(-12, 12, d)
        elif k % 5 == 2:  # whole numbers
            r = rng.integers(-2, 3, (d, d)).astype(float)
        elif k % 5 == 3:  # values that repeat
            r = np.linalg.qr(r)[0] @ np.diag(rng.integers(1, 4, d).astype(float)) @ np.linalg.qr(rng.normal(size=(d, d)))[0]
        elif k % 5 == 4:  # all but one value nearly zero
            r = r[:, [0] * d] + 1e-9 * rng.normal(size=(d, d))
        values, found = wh.principal(r, 6)
        want = np.linalg.svd(r, compute_uv=False)
        assert np.abs(np.sqrt(values) - want).max() <= 1e-12 * want[0]
        assert np.abs(found.T @ found - np.eye(found.shape[1])).max(initial=0) < 1e-12
        assert np.abs(r.T @ (r @ found) - found * values[: found.shape[1]]).max(initial=0) <= 1e-12 * want[0] ** 2


def test_small_values_keep_their_digits():
    # a graded bidiagonal: all digits of values over thirty orders of magnitude, against whole-number arithmetic
    from fractions import Fraction

    a, b = 10.0 ** -np.arange(0, 30, 3), 10.0 ** -np.arange(1, 28, 3)
    found = np.array(sorted(wh.squares(a**2, b**2)))
    product = Fraction(1)
    for x in a:
        product *= Fraction(float(x)) ** 2
    got = Fraction(1)
    for x in found:
        got *= Fraction(float(x))
    assert abs(got / product - 1) < 1e-13


def brute(rows):
    kept = [(i, [int(np.floor(256 * float(np.float32(c)))) for c in v]) for i, v in rows if v is not None and all(c is not None and np.isfinite(c) for c in v)]
    width = max(len(v) for _, v in kept)
    x = np.array([v + [0] * (width - len(v)) for _, v in kept])
    fit = np.unique(x, axis=0)
    n, s = len(fit), fit.sum(0)
    c = (n * fit - s) / n
    e, v = np.linalg.eigh(c.T @ c / n)
    return [i for i, _ in kept], ((n * x - s) / n) @ v[:, ::-1][:, :4] / np.sqrt(e[::-1][:4]), ((n * x - s) ** 2).sum(1), n, e[::-1] / e.sum()


def test_whiten(spark):
    rows = [(n, RNG.normal(size=6).astype(np.float32).tolist()) for n in range(60)]
    rows += [(100, rows[0][1]), (101, rows[0][1]), (101, rows[0][1])]  # copies and a repeated row
    rows += [(200, None), (201, []), (202, [1.0, None]), (203, [float("nan")] * 6), (204, [float("-inf")] * 6), (205, [0.5] * 3), (206, [-0.0] * 6), (None, [0.25] * 6)]
    df = spark.createDataFrame([(i, v, n, n) for n, (i, v) in enumerate(rows)], "vec_id long, embedding array<float>, N int, x int").repartition(5)
    got = wh.whiten(df)
    assert got.columns == ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"]
    ids, want, off, n, share = brute(rows)
    found = got.collect()
    assert len(found) == 4 * len(ids) and {r.n for r in found} == {n} and all(r.identity_error < 1e-12 for r in found)
    key = lambda i: -1 if i is None else i
    for component in range(1, 5):
        mine = sorted((key(r.vec_id), r.deviation, r.whitened) for r in found if r.component == component)
        theirs = sorted((key(i), int(d), w) for i, d, w in zip(ids, off, want[:, component - 1]))
        assert [m[:2] for m in mine] == [t[:2] for t in theirs]
        a, b = np.array([m[2] for m in mine]), np.array([t[2] for t in theirs])
        assert min(np.abs(a - b).max(), np.abs(a + b).max()) < 1e-10
        assert {round(r.explained / share[component - 1], 10) for r in found if r.component == component} == {1.0}


def test_whiten_of_little(spark):
    schema = "vec_id long, embedding array<double>"
    make = lambda rows: wh.whiten(spark.createDataFrame(rows, schema))
    assert make([]).count() == 0 and make([(1, []), (2, None)]).count() == 0
    assert make([(1, [1.0, 2.0]), (2, [1.0, 2.0])]).count() == 0  # one distinct vector has no variance
    two = make([(1, [0.0, 0.0]), (2, [1.0, 0.0])]).collect()
    assert sorted((r.vec_id, r.component, r.deviation, abs(round(r.whitened, 12)), r.explained) for r in two) == [(1, 1, 256**2, 1.0, 1.0), (2, 1, 256**2, 1.0, 1.0)]
    with pytest.raises(Exception, match="too large"):
        make([(1, [0.0]), (2, [1e30])]).count()
    with pytest.raises(Exception, match="does not fit"):
        make([(1, [8e6, 0.0]), (2, [-8e6, 1.0]), (3, [0.0, 0.0])]).count()
    far = make([(1, [3.5e6, 0.0]), (2, [-3.5e6, 1.0]), (3, [0.0, 0.0])])  # squares near 64 bits are exact
    x = [[int(256 * 3.5e6), 0], [-int(256 * 3.5e6), 256], [0, 0]]
    want = {i + 1: sum((3 * c - s) ** 2 for c, s in zip(v, [0, 256])) for i, v in enumerate(x)}
    assert {r.vec_id: r.deviation for r in far.collect()} == want
