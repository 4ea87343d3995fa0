"""Decontamination, licences and conversations against SQL and brute force, without Python in the plans."""

import random
import textwrap

import pytest
import regex

from shopscope.llm import catalog, conversations, decontamination, licenses
from tests.compare import connect, difference

DIRECTORY = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def duck():
    return connect(DIRECTORY)


@pytest.mark.parametrize("name", sorted(catalog.SQL))
def test_query_against_sql(name, spark, duck):
    assert difference(catalog.QUERIES[name](spark, DIRECTORY), duck, catalog.SQL[name]) is None


def test_containment_against_all_pairs(spark, workspace, monkeypatch):
    rng = random.Random(2)
    word = lambda: "".join(rng.choices("abcdefgh", k=4))
    items = [(n, " ".join(word() for _ in range(rng.randrange(3, 70)))) for n in range(40)]
    items += [(50, "One two, THREE"), (51, ""), (52, None), (None, items[3][1]), (7, items[7][1])]
    docs = []
    for n in range(60):
        words = [word() for _ in range(rng.randrange(0, 3000))]
        part = items[n % 40][1].split()
        for _ in range(n % 5):
            part[rng.randrange(len(part))] = word()
        at = rng.randrange(len(words) + 1)
        docs.append((n, " ".join(words[:at] + part + words[at:])))
    docs += [(100, "one TWO three"), (101, "one two three four five"), (102, None), (103, ""), (None, items[0][1]), (104, items[1][1]), (104, items[1][1]), (104, "other")]

    def grams(text):
        words = [w for w in regex.split(decontamination.BETWEEN, (text or "").lower()) if w]
        return {tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4))} if words else set()

    sets = {(i, frozenset(grams(t))) for i, t in items}
    wanted = sorted(((d, i, len(s & grams(t)), len(s)) for d, t in docs for i, s in sets if s and len(s & grams(t)) >= 0.8 * len(s) - 1e-9), key=str)
    left = spark.createDataFrame([(d, t, "x", 1) for d, t in docs], "doc_id long, text string, item_id string, hash int")
    right = spark.createDataFrame([(i, t, 2) for i, t in items], "item_id long, text string, doc_id int")
    for rows in (decontamination.BROADCAST_ROWS, 0):
        monkeypatch.setattr(decontamination, "BROADCAST_ROWS", rows)
        found = decontamination.find(left, right, workspace)
        got = sorted(((r["doc_id"], r["item_id"], r["shared"], r["item_shingles"]) for r in found.collect()), key=str)
        assert got == wanted
        clean = decontamination.without_leaks(left, right, workspace)
        assert clean.columns == left.columns
        leaked = {(d, t) for d, t in docs for i, s in sets if s and len(s & grams(t)) >= 0.8 * len(s) - 1e-9}
        assert sorted((str(r["doc_id"]), r["text"] or "") for r in clean.collect()) == sorted((str(d), t or "") for d, t in docs if (d, t) not in leaked)
    assert decontamination.find(left.where("false"), right, workspace).count() == 0
    assert decontamination.find(left, right.where("false"), workspace).count() == 0


def test_no_python_in_native_plans(spark, workspace):
    docs, benchmark = catalog.table(spark, DIRECTORY, "documents"), catalog.table(spark, DIRECTORY, "benchmark")
    for df in (licenses.scan(docs), decontamination.find(docs, benchmark, workspace)):
        plan = df._jdf.queryExecution().executedPlan().toString()
        assert "Python" not in plan and "Arrow" not in plan and "Cartesian" not in plan and "NestedLoop" not in plan


def test_licence_parts(spark):
    mit = licenses.TEMPLATES["MIT"][2]
    rows = [
        (1, "intro\n\n" + mit.replace("\"", "").upper() + "\n\nmore text"),
        (2, "Some words. Released under the MIT license! More words."),
        (3, "x\nLicensed under CC BY-NC 4.0.\ny\nLicensed under CC BY-NC 4.0."),
        (4, None),
        (5, ""),
        (6, "licensed"),
        (7, "the general public under the sky"),
        (None, "Licensed under the Apache License, Version 2.0"),
    ]
    found = licenses.scan(spark.createDataFrame([(i, t, "l", 1.0) for i, t in rows], "doc_id long, text string, license string, dice double"))
    got = {(r["doc_id"], r["license"]): (r["dice"], r["parts"]) for r in found.collect()}
    assert got[1, "MIT"] == (1.0, 2) and got[2, "MIT"][0] == 1.0 and got[3, "CC-BY-NC-4.0"] == (1.0, 2)  # whole texts match as well
    assert got[None, "Apache-2.0"] == (1.0, 1)
    assert {i for i, _ in got} == {1, 2, 3, None}
    assert licenses.scan(spark.createDataFrame([], "doc_id long, text string")).count() == 0


def test_wrapped_and_embedded_notices(spark):
    notices = {name: max(texts, key=len) for name, texts in licenses.TEMPLATES.items()}
    docs, wanted, prose = [], set(), " ".join(f"other{n} words" for n in range(60))
    for n, (name, text) in enumerate(notices.items()):
        lines = "\n * ".join(textwrap.wrap(text, 70))
        docs.append((3 * n, f"/*\n * {prose}\n *\n * {lines}\n *\n * and more.\n */\nint main() {{}}\n"))
        docs.append((3 * n + 1, f"Some {prose}, and they say: {text} Then {prose} in the same line"))
        wanted |= {(3 * n, name), (3 * n + 1, name)}
    docs.append((900, "We may use a copy of the software under the license of the work. You can do so with or without the file." * 50))
    docs = spark.createDataFrame(docs, "doc_id long, text string")
    got = {(row["doc_id"], row["license"]): row["dice"] for row in licenses.scan(docs).collect()}
    assert wanted <= set(got)
    assert all(got[3 * n, name] == 1.0 for n, name in enumerate(notices) if name in ("MIT", "GPL-2.0", "GPL-3.0", "MPL-2.0"))
    best = {(row[0], row[1]): row[2] for row in licenses.windows(docs, licenses.TEMPLATES, 0.8).groupBy("doc_id", "license").max("dice").collect()}
    assert all(best[pair] == 1.0 for pair in wanted)
    assert not any(doc == 900 for doc, _ in got)


def test_the_best_of_parts_and_windows(spark, duck):
    notice = "\n * ".join(textwrap.wrap(licenses.TEMPLATES["MIT"][2].replace("merge, publish", "merge, print"), 70))
    rows = [
        (1, f"/*\n * some words\n * {notice}\n * and more\n */" + " other words" * 200),
        (2, f"Released under the New MIT License.\n{notice}"),  # a paragraph that matches with its first line
        (2, "Released under the MIT License."),
    ]
    docs = spark.createDataFrame(rows[:2], "doc_id long, text string")
    got = {(r["doc_id"], r["license"]): (r["dice"], r["parts"]) for r in licenses.scan(docs).collect()}
    assert got[1, "MIT"][0] == got[2, "MIT"][0] == pytest.approx(0.984, abs=0.02)  # the paragraph alone has less
    assert got[2, "MIT"][1] == 1
    repeated = licenses.scan(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert {(r["doc_id"], r["license"]): (r["dice"], r["parts"]) for r in repeated if r["license"] == "MIT"}[2, "MIT"] == (1.0, 2)
    own = connect(DIRECTORY)
    own.execute("drop view documents")
    own.execute("create table documents(doc_id bigint, text varchar)")
    own.executemany("insert into documents values (?, ?)", rows[:2])
    assert difference(licenses.scan(docs), own, licenses.SQL) is None


def test_windows_are_the_best_of_all(spark):
    rng = random.Random(4)
    templates = {"A": ["alpha beta gamma delta epsilon zeta eta theta iota kappa lambda mu"], "B": ["beta gamma nu xi alpha beta omicron pi"]}
    pairs = lambda own: set(zip(own, own[1:]))
    docs, wanted = [], {}
    for doc in range(150):
        own = licenses.words_of(templates[rng.choice("AB")][0])
        for _ in range(rng.randrange(4)):
            own.insert(rng.randrange(len(own)), rng.choice(["gamma", "x", "y"]))
        if rng.random() < 0.5:
            del own[rng.randrange(len(own))]
        own = rng.choices(["x", "y", "beta", "gamma"], k=15) + own + rng.choices(["x", "y", "mu", "alpha"], k=15)
        docs.append((doc, " ".join(own)))
        for name, (text,) in templates.items():
            whole = pairs(licenses.words_of(text))
            limit = int(len(whole) * 1.5 + 1e-9)
            sets = [pairs(own[a:b]) for a in range(len(own)) for b in range(a + 2, min(len(own), a + limit + 1) + 1)]
            best = max(2 * len(s & whole) / (len(s) + len(whole)) for s in sets)
            if best >= 0.8:
                wanted[doc, name] = best
    held = spark.createDataFrame(docs, "doc_id long, text string")
    found = licenses.windows(held, templates, 0.8).groupBy("doc_id", "license").max("dice").collect()
    assert {(row[0], row[1]): row[2] for row in found} == wanted and 20 < len(wanted)


def test_telling_words_are_in_every_match():
    rng = random.Random(3)
    for texts in licenses.TEMPLATES.values():
        for text in texts:
            own = licenses.words_of(text)
            telling = licenses.telling_words(text, 0.8)
            whole = set(zip(own, own[1:]))
            for _ in range(200):
                words = [w for w in own if w not in telling]
                words = words if rng.random() < 0.2 else [w if w not in telling else "zz" for w in own]
                pairs = set(zip(words, words[1:]))
                assert 2 * len(whole & pairs) < 0.8 * (len(whole) + len(pairs))


def brute_conversations(rows):
    groups = {}
    for conv, turn, role, text in rows:
        groups.setdefault(conv, []).append((turn is not None, turn or 0, role or "", text or ""))
    lists = {c: [t[2:] for t in sorted(g, key=lambda t: t[:3])] for c, g in groups.items()}
    first = {}
    for conv in sorted(lists, key=lambda c: (c is None, c or 0)):
        first.setdefault(tuple(lists[conv]), conv)
    return {c for l, c in first.items() if not any(len(o) > len(l) and o[: len(l)] == l for o in first)}


def test_snapshots_collapse(spark):
    rng = random.Random(5)
    rows = []
    for conv in range(60):
        length = rng.randrange(1, 8)
        rows += [(conv, turn, ("user", "assistant")[turn % 2], f"t{rng.randrange(2) if turn < 3 else conv % 3}") for turn in range(length)]
    rows += [(500, turn, "user", f"long {turn}") for turn in range(3000)]  # spread over tasks
    rows += [(501, turn, "user", f"long {turn}") for turn in range(2500)]
    rows += [(600, None, None, None), (None, 0, "user", None), (None, 1, "user", "x"), (601, None, None, "")]
    df = spark.createDataFrame([(*r, 1) for r in rows], "conv_id long, turn long, role string, text string, segment int")
    out = conversations.rendered(df).collect()
    assert {r["conv_id"] for r in out} == brute_conversations(rows)
    kept = brute_conversations(rows)
    assert len(out) == sum(r[0] in kept for r in rows)
    assert {r["segment"] for r in out if r["conv_id"] == 500} == {f"<|im_start|>user\nlong {n}<|im_end|>\n" for n in range(3000)}
    assert conversations.rendered(df.where("false")).count() == 0
