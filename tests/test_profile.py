"""Radix selection against numpy."""

import decimal

import numpy as np
import pytest

from textmill.operators import radix, rows


def test_quartiles_of_all_kinds(spark):
    rng = np.random.default_rng(2)
    n = 997
    table = {
        "ints": rng.integers(-(2**63), 2**63 - 1, n), "ties": rng.integers(-2, 3, n), "doubles": rng.standard_normal(n) * 10.0 ** rng.integers(-300, 300, n),
        "zeros": np.where(rng.random(n) < 0.5, -0.0, 0.0), "edge": np.where(rng.random(n) < 0.3, np.inf, -np.inf), "floats": rng.random(n).astype(np.float32),
    }
    gone = rng.random(n) < 0.2
    data = [tuple(None if gone[i] and k != "ints" else v[i].item() for k, v in table.items()) + (decimal.Decimal(int(rng.integers(-999, 999))) / 100, None) for i in range(n)]
    df = spark.createDataFrame(data, "ints long, ties long, doubles double, zeros double, edge double, floats float, money decimal(9,2), none int").repartition(5)
    counts = {c: sum(r[i] is not None for r in data) for i, c in enumerate(df.columns)}
    got = radix.select_ranks(df, {c: [0, counts[c] // 3, counts[c] - 1] for c in df.columns if counts[c]})
    for i, c in enumerate(df.columns[:-1]):
        values = sorted(r[i] for r in data if r[i] is not None)
        for rank in (0, counts[c] // 3, counts[c] - 1):
            assert got[c, rank] == pytest.approx(float(values[rank]), rel=1e-12)


def test_profile(spark):
    data = [(i, None if i % 3 else i / 7, "x") for i in range(101)]
    df = spark.createDataFrame(data, "a long, `b.c` double, t string")
    got = {r["column"]: r for r in rows.profile(df).collect()}
    b = np.array([v for _, v, _ in data if v is not None])
    assert list(got) == ["a", "b.c"]
    assert (got["a"]["q25"], got["a"]["q50"], got["a"]["q75"], got["a"]["max"]) == (25.0, 50.0, 75.0, 100.0)
    assert [got["b.c"][q] for q in ("q25", "q50", "q75")] == pytest.approx(np.quantile(b, [0.25, 0.5, 0.75]).tolist())
    assert got["b.c"]["count"] == len(b) and got["b.c"]["std"] == pytest.approx(b.std(ddof=1))
    empty = rows.profile(df.where("false")).collect()
    assert [(r["count"], r["q50"], r["mean"]) for r in empty] == [(0, None, None)] * 2
    assert rows.profile(df.select("t")).count() == 0


def test_the_number_of_passes_does_not_grow_with_columns(spark, monkeypatch):
    # One counting job per digit, whatever the number of columns.
    df = spark.range(500).selectExpr(*[f"id * {k} AS c{k}" for k in range(1, 30)])
    calls = []
    kept = radix.F.count
    monkeypatch.setattr(radix.F, "count", lambda c: (calls.append(1), kept(c))[1])
    got = radix.quantiles(df, {c: 500 for c in df.columns}, [0.5])
    assert got["c3"] == [748.5] and len(calls) == len(radix.SHIFTS)
