import math

import numpy as np
import pytest

from tidemark.llm import queries, whitening

SCHEMA = "vec_id long, embedding array<double>, n int, x string, whitened string, at int"


def plain(rows, components=16):
    """Straight from the definition, by a dense eigenvalue routine."""
    good = [(i, [math.floor(64 * c) + 1_000_000 for c in v]) for i, v in rows if v and all(c is not None and math.isfinite(c) for c in v)]
    width = max(len(x) for _, x in good)
    good = [(i, [*x, *[1_000_000] * (width - len(x))]) for i, x in good]
    distinct = sorted({tuple(x) for _, x in good})
    n, sums = len(distinct), [sum(c) for c in zip(*distinct)]
    centred = np.array([[(n * x - s) / n for x, s in zip(v, sums)] for v in distinct])
    values, vectors = np.linalg.eigh(centred.T @ centred / n)
    order = np.argsort(-values)[:components]
    values, vectors = values[order], vectors[:, order]
    keep = values > 1e-12 * max(values[0], 1e-300)
    values, vectors = values[keep], vectors[:, keep]
    out = {}
    for i, x in good:
        dev = [n * a - s for a, s in zip(x, sums)]
        out.setdefault(i, []).append((sum(d * d for d in dev), np.array([d / n for d in dev]) @ vectors / np.sqrt(values)))
    return n, values, np.trace(centred.T @ centred / n), out


def frame(spark, rows):
    return spark.createDataFrame([(i, v, 1, "x", "y", 2) for i, v in rows], SCHEMA)


def compare(spark, rows, tolerance=1e-9, components=16):
    table = frame(spark, rows)
    model = whitening.fit(table, components)
    got = whitening.whiten(table, model).collect()
    n, values, trace, expected = plain(rows, components)
    assert model.n == n and model.identity_error < 1e-8
    assert np.allclose(model.values, values, rtol=1e-10) and abs(model.trace - trace) < 1e-10 * trace
    assert len(got) == sum(map(len, expected.values()))
    signs = np.zeros(len(values))
    for r in got:
        assert r["deviation"] in [d for d, _ in expected[r["vec_id"]]]
        w = next(w for d, w in expected[r["vec_id"]] if d == r["deviation"])
        mine = np.array(r["whitened"])
        signs = np.where(signs == 0, np.where(np.abs(w) > 1e-6, np.sign(w * mine), 0), signs)
        assert np.abs(mine - np.where(signs == 0, 1, signs) * w).max() < tolerance * max(1, np.abs(w).max())
    return model


def test_separated_spectrum(spark):
    rng = np.random.default_rng(1)
    scale = 3.0 * 0.9 ** np.arange(64)
    model = compare(spark, [(i, list(map(float, v))) for i, v in enumerate(rng.standard_normal((600, 64)) * scale)])
    assert model.rounds > 0  # the filter was used


def test_flat_spectrum_of_many_dimensions(spark):
    rng = np.random.default_rng(2)
    model = compare(spark, [(i, list(map(float, v))) for i, v in enumerate(rng.standard_normal((900, 70)) / 8)], 1e-7)
    assert model.passes < 300


def test_a_direction_that_only_few_rows_have(spark):
    rng = np.random.default_rng(3)
    points = rng.standard_normal((500, 60)) * 0.2
    points[:3, 59] += 40
    compare(spark, [(i, list(map(float, v))) for i, v in enumerate(points)], 1e-7, components=4)


def test_copies_low_rank_and_bad_rows(spark):
    rng = np.random.default_rng(4)
    rows = [(i, [float(a), float(2 * a), float(b), 0.0]) for i, (a, b) in enumerate(rng.standard_normal((80, 2)))]
    rows += [(1000 + i, [0.5, 1.0, 0.25, 0.0]) for i in range(200)]  # copies count once
    rows += [(2000, None), (2001, []), (2002, [1.0, None, 0.0, 0.0]), (2003, [float("nan")] * 4), (2004, [float("inf")] * 4), (None, [0.1, 0.2, 0.3, 0.4]), (2005, [0.7])]
    compare(spark, rows, 1e-7)


@pytest.mark.parametrize("rows", [[], [(1, None)], [(1, [1.0, 2.0]), (2, [1.0, 2.0])], [(5, [1.0])]])
def test_no_variance(spark, rows):
    table = frame(spark, rows)
    got = whitening.whiten(table, whitening.fit(table)).collect()
    assert len(got) == sum(v is not None for _, v in rows)
    assert all(r["whitened"] == [] and r["deviation"] == 0 for r in got)


def test_entries_out_of_range_and_wide_deviations(spark):
    table = frame(spark, [(1, [1e300, 1.0]), (2, [3e10, 1.0]), (3, [-3e10, 2.0]), (4, [0.5, 3.0])])
    got = {r["vec_id"]: r for r in whitening.whiten(table, whitening.fit(table)).collect()}
    assert set(got) == {2, 3, 4} and got[2]["deviation"] is None and got[4]["deviation"] is not None


def test_query(spark):
    folder = "/root/testdata/sf0.001"
    out = queries.op11_chebyshev_whitening(spark, folder)
    assert out.columns[:7] == ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"]
    got = out.collect()
    rows = [(r["vec_id"], [float(c) for c in r["embedding"]]) for r in spark.read.parquet(f"{folder}/embeddings.parquet").collect()]
    n, values, trace, expected = plain(rows)
    assert len(got) == 16 * len(rows)
    sign = {}
    for r in got:
        d, w = expected[r["vec_id"]][0]
        k = r["component"] - 1
        s = sign.setdefault(k, 1.0 if r["whitened"] * w[k] > 0 else -1.0)
        assert r["n"] == n and r["deviation"] == d and abs(r["whitened"] - s * w[k]) < 1e-8
        assert abs(r["explained"] - values[k] / trace) < 1e-10 and r["identity_error"] < 1e-8
