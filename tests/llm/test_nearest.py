"""Neighbours against brute force in double precision."""

import math

import numpy as np
import pytest

from shopscope.llm import catalog, nearest

SCHEMA = "vec_id long, embedding array<float>, vector string, id string"


def brute_force(rows, k=10):
    ok = [(i, np.array(v, float)) for i, v in rows if i is not None and v and all(x is not None and math.isfinite(x) for x in v) and any(v)]
    found = {}
    for q, x in sorted(ok, key=lambda r: (r[0], list(r[1]))):
        if q % 100 or q in found:
            continue
        near = sorted((float(np.sqrt(((x - y) ** 2).sum())), i) for i, y in ok if i != q and len(y) == len(x))
        found[q] = near[:k]
    return found


def result(df):
    found = {}
    for row in df.orderBy("query_id", "rank").collect():
        found.setdefault(row["query_id"], []).append((row["score"], row["vec_id"]))
        assert row["rank"] == len(found[row["query_id"]])
    return found


def assert_same(got, wanted):
    assert got.keys() == {q for q, near in wanted.items() if near}
    for q, near in got.items():
        assert [i for _, i in near] == [i for _, i in wanted[q]]
        assert [s for s, _ in near] == pytest.approx([s for s, _ in wanted[q]], abs=1e-12)


def test_odd_vectors(spark):
    near = [(i, [float(i % 7), 1.0, -2.0]) for i in range(1, 60)]
    odd = [(100, [0.0, 0.0, 0.0]), (200, None), (300, [1.0, float("nan"), 1.0]), (400, [1.0, None, 2.0]), (500, []), (None, [1.0, 1.0, 1.0]), (600, [float("inf"), 0.0, 0.0])]
    asked = [(700, [3.0, 1.0, -2.0]), (700, [3.0, 1.0, -2.0]), (800, [1.0, 2.0]), (0, [3.0, 1.0, -2.0]), (900, [5.0])]
    rows = near + odd + asked
    df = spark.createDataFrame([(i, v, "x", "y") for i, v in rows], SCHEMA)
    wanted = brute_force(rows)
    assert_same(result(catalog.neighbours(df)), wanted)
    assert catalog.neighbours(spark.createDataFrame([], SCHEMA)).count() == 0


def test_recall_over_the_whole_table(spark):
    directory = "/root/testdata/sf0.01"
    rows = [(r["vec_id"], r["embedding"]) for r in catalog.table(spark, directory, "embeddings").collect()]
    got, wanted = result(catalog.op9_nearest(spark, directory)), brute_force(rows)
    hits = sum(len({i for _, i in got[q]} & {i for _, i in wanted[q]}) for q in wanted)
    assert hits / sum(map(len, wanted.values())) >= 0.9


def test_bounds_choose_few_vectors():
    rng = np.random.default_rng(1)
    centre = rng.standard_normal((50, 64))
    data = (centre[:, None] + 0.2 * rng.standard_normal((50, 80, 64))).reshape(-1, 64)
    middle = data.mean(0)
    codes, norms, fits = nearest.quantise(data, middle)
    row = {"dims": 64, "ids": np.arange(4000).tobytes(), "codes": codes.tobytes(), "norms": norms.tobytes(), "fits": fits.tobytes(), "vectors": data.tobytes()}
    assert codes.shape == (4000, 8)
    q, ids, score, measured = nearest.Block(row, 3.0).nearest(np.arange(0, 4000, 100), data[::100], middle, 10)
    assert measured < 0.2 * 4000 * 40
    exact = np.linalg.norm(data[::100][:, None] - data[None], axis=2)
    exact[np.arange(40), np.arange(0, 4000, 100)] = np.inf
    wanted = np.argsort(exact, axis=1)[:, :10]
    assert (ids.reshape(40, 10) == wanted).mean() > 0.99


def test_vectors_near_the_limits_of_doubles(spark):
    rng = np.random.default_rng(3)
    rows = [(i, (v * scale).tolist()) for scale, first in ((1e160, 1), (1e300, 2000), (1e-170, 4000)) for i, v in enumerate(rng.standard_normal((120, 3)), first)]
    rows += [(100 * n, (rng.standard_normal(3) * scale).tolist()) for n, scale in ((50, 1e160), (51, 1e300), (52, 1e-170))]
    df = spark.createDataFrame([(i, v, "x", "y") for i, v in rows], SCHEMA.replace("float", "double"))
    got = result(catalog.neighbours(df))
    for q in (5000, 5100, 5200):
        x = np.array(dict(rows)[q])
        near = sorted((math.hypot(*(x - np.array(v))), i) for i, v in rows if i != q)[:10]
        assert len(got[q]) == 10 and [s for s, _ in got[q]] == pytest.approx([s for s, _ in near], rel=1e-9)
