"""BagMinHash estimates, and classes against all pairs."""

import random
from collections import Counter

import numpy as np
import pytest

from shopscope.llm import bag_min_hash, catalog, weighted_dedup
from shopscope.llm.components import components
from shopscope.llm.shingles import ENDS, SIZE

SCHEMA = "doc_id long, text string, print string, class_id string"


def bag(text):
    words = [w for w in (ENDS.sub("", w) for w in (text or "").lower().split()) if w]
    return Counter(tuple(words[i : i + SIZE]) for i in range(max(1, len(words) - SIZE + 1))) if words else Counter()


def brute_force(rows):
    """Classes over all pairs: (doc_id, class_id, class_size), sorted."""
    bags = [bag(text) for _, text in rows]
    parent = list(range(len(rows)))

    def find(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i, a in enumerate(bags):
        for j in range(i):
            b = bags[j]
            same = (rows[i][1] or "") == (rows[j][1] or "")
            big = sum((a | b).values())
            if same or big and sum((a & b).values()) >= 0.8 * big:
                parent[max(find(i), find(j))] = min(find(i), find(j))
    groups = {}
    for i, (doc, _) in enumerate(rows):
        groups.setdefault(find(i), []).append(doc)
    return sorted(((d, min((x for x in g if x is not None), default=None), len(g)) for g in groups.values() for d in g), key=str)


def result(df):
    return sorted((tuple(row) for row in df.select("doc_id", "class_id", "class_size").collect()), key=str)


def test_estimates_are_unbiased():
    rng, gaps = np.random.default_rng(0), []
    for _ in range(60):
        element = rng.integers(0, 2**63, 200).astype(np.uint64)
        a = rng.integers(0, 9, 200)
        b = np.where(rng.random(200) < 0.7, a, rng.integers(0, 20, 200))
        owner = np.r_[np.zeros((a > 0).sum(), int), np.ones((b > 0).sum(), int)]
        s = bag_min_hash.signatures(owner, np.r_[element[a > 0], element[b > 0]], np.r_[a[a > 0], b[b > 0]], 3, 1000)
        gaps.append((s[0] == s[1]).mean() - np.minimum(a, b).sum() / np.maximum(a, b).sum())
        assert (s[2] == 0).all()
    assert abs(np.mean(gaps)) < 0.006 and np.std(gaps) < 0.025


def test_weights_are_cells_of_one_axis():
    """A heavier element keeps all its lighter points: the earliest time never grows with the weight."""
    one = lambda w: bag_min_hash._earliest(*bag_min_hash.octaves(np.zeros(1, int), np.array([7], np.uint64), np.array([w])), np.array([5.0]), 1, 16)[1]
    times = [one(w) for w in (1, 2, 3, 7, 40)]
    assert all((later <= earlier).all() for earlier, later in zip(times, times[1:]))


def corpus():
    rng = random.Random(4)
    word = lambda: "".join(rng.choices("abcdefgh", k=5))
    rows, base = [], [word() for _ in range(300)]
    rows += [(n, " ".join(base)) for n in range(3)]
    for n in range(10, 60):  # near copies of one text
        words = list(base)
        for _ in range(n % 7):
            words[rng.randrange(300)] = word()
        rows.append((n, " ".join(words)))
    for n in range(100, 130):  # a chain: each is near the next only
        rows.append((n, " ".join(f"w{i}" for i in range(n * 10, n * 10 + 150))))
    rows += [(n, " ".join(word() for _ in range(rng.randrange(1, 60)))) for n in range(200, 240)]
    line = " ".join(word() for _ in range(20))
    rows += [(n, line + "\n" + " ".join(word() for _ in range(30))) for n in range(300, 330)]
    rows += [(400, ""), (401, None), (402, "..."), (None, "a b c"), (403, "A b, c!"), (404, "x " * 500), (405, "x " * 450), (405, "x " * 450), (406, "x " * 100), (407, "one")]
    return rows


def test_classes_against_all_pairs(spark):
    rows = corpus()
    df = spark.createDataFrame([(i, t, "p", "c") for i, t in rows], SCHEMA)
    wanted = brute_force(rows)
    assert result(weighted_dedup.classified(df)) == wanted
    kept = weighted_dedup.without_duplicates(df)
    assert kept.columns == df.columns
    got = sorted((row["doc_id"] for row in kept.collect()), key=str)
    assert got == sorted({c for _, c, _ in wanted if c is not None}, key=str)


@pytest.mark.parametrize("broadcast_rows", [10**6, 0])
def test_one_of_each_class_stays(spark, monkeypatch, broadcast_rows):
    """Repeated ids with equal and different texts, null ids, and the path of joins by shuffle."""
    monkeypatch.setattr(weighted_dedup, "BROADCAST_ROWS", broadcast_rows)
    rows = [(i, t, f"p{n}", "c") for n, (i, t) in enumerate(corpus())]
    rows += [(rows[0][0], rows[0][1], "again", "d"), (rows[1][0], "another text of one id", "x", "y"), (None, "lone text without id", None, None), (None, "lone text without id", None, "z")]
    df = spark.createDataFrame(rows, SCHEMA)
    kept = weighted_dedup.without_duplicates(df.repartition(3), broadcast_rows=broadcast_rows)
    assert kept.columns == df.columns
    found = [tuple(r) for r in kept.collect()]
    again = [tuple(r) for r in weighted_dedup.without_duplicates(df.repartition(7), broadcast_rows=broadcast_rows).collect()]
    assert sorted(found, key=str) == sorted(again, key=str) and set(found) <= set(rows)
    sketches, named = weighted_dedup.classes(df, catalog.Workspace(spark))
    of_text = {(r["doc_id"], r["print"]): (r["class_id"], r["kept"]) for r in sketches.join(named, "print").collect()}
    assert len(found) == len({(r[0], r[1]) for r in found}) == len(set(of_text.values()))


def test_many_blocks(spark, monkeypatch):
    """Buckets split into blocks of few members each."""
    monkeypatch.setattr(weighted_dedup, "BLOCK_MEMBERS", 3)
    rows = corpus()
    df = spark.createDataFrame([(i, t, "p", "c") for i, t in rows], SCHEMA)
    assert result(weighted_dedup.classified(df)) == brute_force(rows)


def test_empty_table(spark):
    assert weighted_dedup.classified(spark.createDataFrame([], SCHEMA)).count() == 0


def test_components(spark, workspace):
    rng = random.Random(1)
    edges = [(rng.randrange(300), rng.randrange(300)) for _ in range(200)] + [(1000 + i, 1001 + i) for i in range(40)]
    roots = {r["node"]: r["root"] for r in components(spark.createDataFrame(edges, "a long, b long"), workspace, "c").collect()}
    parent = {}

    def find(x):
        while parent.setdefault(x, x) != x:
            x = parent[x]
        return x

    for a, b in edges:
        parent[find(a)] = find(b)
    for x in roots:
        for y in roots:
            assert (roots[x] == roots[y]) == (find(x) == find(y))


@pytest.mark.parametrize("size", ["sf0.001"])
def test_query_over_the_whole_table(spark, size):
    directory = f"/root/testdata/{size}"
    rows = [(r["doc_id"], r["text"]) for r in catalog.table(spark, directory, "documents").collect()]
    assert result(catalog.op3_near_duplicates(spark, directory)) == brute_force(rows)
