"""Trees, proofs and folds against plain Python."""

import hashlib
import random
import zlib

import pytest

from shopscope.llm import catalog, merkle_manifest
from shopscope.sources.workspace import Workspace

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, pos string, leaf string"


def digest(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def brute_force(docs):
    """Node by node, by the definitions; rows are (doc_id, text, lang, source, n_chars)."""

    def leaf(row, text):
        values = [row[0], row[3], row[2], row[4], text]
        return digest(*("-" if v is None else f"{len(str(v).encode())}:{v}" for v in values))

    def levels(nodes):
        made = [nodes]
        while len(made[-1]) > 1:
            made.append([digest(*made[-1][i : i + 8]) for i in range(0, len(made[-1]), 8)])
        return made

    def way(made, i):
        for level in made[:-1]:
            low = i - i % 8
            yield level[low:i], level[i + 1 : low + 8]
            i //= 8

    trees = {}
    for row in docs:
        trees.setdefault(row[2], []).append((row[0] is not None, row[0] or 0, leaf(row, row[1]), row))
    langs = sorted(trees, key=lambda x: (x is not None, (x or "").encode()))
    made = {lang: levels([x[2] for x in sorted(trees[lang], key=lambda x: x[:3])]) for lang in langs}
    top = levels([made[lang][-1][0] for lang in langs])
    rows = []
    for n, lang in enumerate(langs):
        for i, (_, _, own, row) in enumerate(sorted(trees[lang], key=lambda x: x[:3])):
            path = [*way(made[lang], i), *way(top, n)]
            changed = row[1]
            if row[0] is not None and zlib.crc32(str(row[0]).encode()) % 3 == 0 and changed is not None:
                changed = "".join(c.lower() if "A" <= c <= "Z" else c for c in changed)
            node = leaf(row, changed)
            for before, after in path:
                node = digest(*before, node, *after)
            root = top[-1][0]
            rows.append((row[0], own, made[lang][-1][0], root, digest(*(s for b, a in path for s in [*b, *a])), node, node == root))
    return sorted(rows, key=str)


def rows_of(df):
    return sorted((tuple(row) for row in df.collect()), key=str)


ODD = [
    (5, "É ABC ß", "de", "x", 7),
    (5, "É ABC ß", "de", "x", 7),
    (5, "another", "de", None, None),
    (None, "no key", "de", None, 1),
    (None, None, None, None, None),
    (None, None, None, None, None),
    (3, "", None, "", 0),
    (-(2**63), "least", "de", "x", 1),
    (2**63 - 1, "most", "de", "x", 1),
    (-1, "MINUS", "de", "x", 1),
    (63, "x", "de", "x", 1),
    (64, "Y" * 100_000, "de", "x", 1),
    (7, "lone", "é", "x", 1),
    (8, "lone", "", "x", 1),
]


def test_odd_rows(spark, workspace):
    docs = spark.createDataFrame([(*row, "p", "l") for row in ODD], SCHEMA)
    assert rows_of(merkle_manifest.verified(docs, workspace)) == brute_force(ODD)


@pytest.mark.parametrize("n", [1, 8, 9, 512, 513, 5000])
def test_heights(spark, workspace, n):
    rng = random.Random(n)
    rows = [(key, f"Text {key}", "en", "s", 6) for key in rng.sample(range(-(10**12), 10**12), n)]
    assert rows_of(merkle_manifest.verified(spark.createDataFrame([(*row, "", "") for row in rows], SCHEMA), workspace)) == brute_force(rows)


def test_many_groups_and_a_key_of_a_third_of_all_rows(spark, workspace):
    rows = [(n, "x", f"group {n % 700}", "s", 1) for n in range(1400)] + [(77, f"copy {n % 5}", "group 77", "s", 1) for n in range(700)]
    assert rows_of(merkle_manifest.verified(spark.createDataFrame([(*row, "", "") for row in rows], SCHEMA), workspace)) == brute_force(rows)


def test_empty_table(spark, workspace):
    found = merkle_manifest.verified(spark.createDataFrame([], SCHEMA), workspace)
    assert found.count() == 0 and found.columns == ["doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"]


def test_paths_fold_to_the_root(spark, workspace):
    docs = spark.createDataFrame([(*row, "p", "l") for row in ODD], SCHEMA)
    made = merkle_manifest.manifest(docs, "lang", "doc_id", merkle_manifest.COLUMNS, workspace)
    for row in made.leaves.collect():
        node = row["leaf"]
        for step in row["path"]:
            node = digest(step["before"], node, step["after"])
        assert node == row["root"]


def test_query_over_the_whole_table(spark):
    directory = "/root/testdata/sf0.001"
    docs = [tuple(r) for r in catalog.table(spark, directory, "documents").select("doc_id", "text", "lang", "source", "n_chars").collect()]
    df = catalog.op11_merkle_manifest(spark, directory)
    assert rows_of(df) == brute_force(docs)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and isinstance(Workspace(spark), Workspace)
