"""Merkle manifest of a table: a leaf a row, a tree a group, and a tree over the groups' roots; no Python in the plan.

A leaf's place is its rank by key within its group, found without sorting rows. Keys of a group are a bitmap, stored as
its non-zero 64-bit words: words of equal place are merged by OR while they are still partial, and their bits and rows
counted. A popcount directory over the words, with a level for every so many bits of the word's place, gives how many
rows come before each word; no window of it holds more than 2^16 rows, whatever the keys. A rank query is then one join
with the word, and the number of its lower bits.

Nodes reduce in slot arrays: 512 consecutive nodes meet as one array by key (group, place / 512) and give three levels
at once, so a table of 10^10 rows takes four shuffles, each 512 times smaller than the one before. On the way down each
array hands the siblings above it to the arrays below; a leaf's proof is its siblings in its own array and those.

A word with more rows than bits holds repeated keys. Only the rows of these, and of null keys, are sorted (by range, with
the leaf and a row number as tie-breakers) to number the copies.

Defined cases: null keys come first in their group, copies of a key are ordered by leaf, and equal rows are leaves of
their own; null groups are one group, the first; null values are ``-`` in a leaf; an empty table has no leaves and no
root; columns that aren't named are neither read nor covered.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from shopscope.operators.ranking import rank_rows
from shopscope.sources.workspace import Workspace

#: Children of a node, and levels that one slot array reduces.
FANOUT, DEPTH = 8, 3
SLOTS = FANOUT**DEPTH
#: Bits of a word's place that each level of the directory drops; the last level has the 16 bits that are left.
DIRECTORY = (10, 16, 16)
#: Parts in which the rows of one repeated key are looked up.
SALTS = 64


def hashed(text: Column) -> Column:
    return F.sha2(text, 256)


def leaf(columns: list[Column]) -> Column:
    """Hash of the columns' values with their lengths, in order."""
    texts = [column.cast("string") for column in columns]
    return hashed(F.concat(*[F.coalesce(F.concat(F.octet_length(t).cast("string"), F.lit(":"), t), F.lit("-")) for t in texts]))


def both(left: DataFrame, right: DataFrame, names: list[str], how: str = "inner") -> DataFrame:
    """Join on equal names, nulls being equal; the right side's names go."""
    other = right.select([F.col(c).alias(f"_{c}") if c in names else F.col(c) for c in right.columns])
    on = [left[c].eqNullSafe(other[f"_{c}"]) for c in names]
    return left.join(other, on, how).drop(*[f"_{c}" for c in names])


# ---- ranks -------------------------------------------------------------------------------------------------------


def directory(words: DataFrame, shifts: tuple[int, ...] = DIRECTORY) -> DataFrame:
    """Adds ``before``, the rows of the tree in earlier words, and ``total``, all rows of the tree; null places come first."""

    def earlier(*keys: str) -> Column:
        return F.coalesce(F.sum("rows").over(Window.partitionBy(*keys).orderBy("at").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))

    if not shifts:
        return words.withColumn("before", earlier("tree")).withColumn("total", F.sum("rows").over(Window.partitionBy("tree")))
    words = words.withColumn("up", F.shiftright("at", shifts[0]))
    ups = directory(words.groupBy("tree", "up").agg(F.sum("rows").alias("rows")).withColumnRenamed("up", "at"), shifts[1:])
    ups = ups.select("tree", F.col("at").alias("up"), F.col("before").alias("skipped"), "total")
    joined = both(words.withColumn("before", earlier("tree", "up")), ups, ["tree", "up"])
    return joined.withColumn("before", F.col("before") + F.col("skipped")).drop("skipped", "up")


def placed(rows: DataFrame, workspace: Workspace) -> DataFrame:
    """Adds ``pos``, the rank of each row by ``key`` within its tree, and ``total``; rows have tree, key, leaf, other and nr."""
    rows = rows.withColumn("at", F.shiftright("key", 6))
    bit = F.col("key").bitwiseAND(63).cast("int")
    words = rows.groupBy("tree", "at").agg(
        F.coalesce(F.bit_or(F.call_function("shiftleft", F.lit(1).cast("long"), bit)), F.lit(0)).alias("word"), F.count(F.lit(1)).alias("rows")
    )
    words = workspace.store("words", words)
    index = directory(words)
    rank = F.col("before") + F.bit_count(F.col("word").bitwiseAND(F.bitwise_not(F.call_function("shiftleft", F.lit(-1).cast("long"), bit))))
    repeated = words.where(F.col("rows") > F.bit_count("word"))
    if repeated.isEmpty():
        return both(rows, index, ["tree", "at"]).select("tree", "key", "leaf", "other", rank.alias("pos"), "total")
    copies = rows.groupBy("tree", "key", "at").agg(F.count(F.lit(1)).alias("n")).where((F.col("n") > 1) | F.col("key").isNull())
    copies = workspace.store("copies", copies)
    # at most 64 entries a word
    more = copies.where("key is not null").groupBy("tree", "at").agg(F.collect_list(F.struct("key", "n")).alias("more"))
    index = both(index, more, ["tree", "at"], "left")
    lower = F.filter("more", lambda x: x["key"] < F.col("key"))
    extra = F.coalesce(F.aggregate(lower, F.lit(0).cast("long"), lambda total, x: total + x["n"] - 1), F.lit(0))
    rank = F.coalesce(rank, F.col("before")) + extra
    salt = F.pmod("nr", F.lit(SALTS).cast("long"))
    salted = copies.select("tree", "key", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(SALTS - 1).cast("long"))).alias("salt"))
    rows = rows.withColumn("salt", salt)
    single = both(both(rows, salted, ["tree", "key", "salt"], "left_anti"), index, ["tree", "at"])
    single = single.select("tree", "key", "leaf", "other", rank.alias("pos"), "total")
    # copies of a key are consecutive in this sort; one row a key and sorted part says where they begin
    tied = both(rows, salted, ["tree", "key", "salt"], "left_semi")
    tied = tied.select(F.struct("tree", "key").alias("own"), F.struct("leaf", "nr", "other").alias("order"))
    ranked = rank_rows(tied, "own", "order", workspace, "tied")
    offsets = rows.sparkSession.createDataFrame([(part, start) for part, start, _ in ranked.parts], "part long, start long")
    numbered = ranked.rows.join(F.broadcast(offsets), "part").withColumn("rank", F.col("position") + F.col("start"))  # a row a partition
    firsts = numbered.groupBy("value").agg(F.min("rank").alias("first")).select("value.*", "first")
    firsts = both(firsts.withColumn("at", F.shiftright("key", 6)), index, ["tree", "at"])
    firsts = firsts.select(F.struct("tree", "key").alias("value"), (rank - F.col("first")).alias("shift"), "total")
    by_part = both(numbered.groupBy("value", "part").count(), firsts, ["value"]).select("value", "part", "shift", "total")
    tied = both(numbered, by_part, ["value", "part"]).select("value.tree", "value.key", "id.leaf", "id.other", (F.col("rank") + F.col("shift")).alias("pos"), "total")
    return single.union(tied)


# ---- levels ------------------------------------------------------------------------------------------------------


def arrays(nodes: DataFrame) -> DataFrame:
    """Nodes (tree, pos, total and others, ``leaf`` being the hash) as slot arrays: tree, block, slots, n."""
    others = [c for c in nodes.columns if c not in ("tree", "pos", "total")]
    return nodes.groupBy("tree", F.expr(f"pos div {SLOTS}").alias("block")).agg(
        F.sort_array(F.collect_list(F.struct("pos", *others))).alias("slots"), F.max("total").alias("n")
    )


def runs(level: Column) -> Column:
    """Hashes of every eight consecutive nodes."""
    starts = F.sequence(F.lit(0), F.size(level) - 1, F.lit(FANOUT))
    return F.transform(starts, lambda i: hashed(F.array_join(F.slice(level, i + 1, FANOUT), "")))


def climbed(blocks: DataFrame) -> DataFrame:
    """Adds levels ``l0`` to ``l3`` of each array; a level of a single node in the whole tree is the last."""
    blocks = blocks.withColumn("l0", F.transform("slots", lambda s: s["leaf"]))
    n = F.col("n")
    for k in range(DEPTH):
        here = F.col(f"l{k}")
        blocks = blocks.withColumn(f"l{k + 1}", F.when(n > FANOUT**k, runs(here)).otherwise(here))
    return blocks


def siblings(i: Column) -> Column:
    """The runs' other nodes at each level of an array on the way up from slot ``i``: before and after the own node."""
    steps = []
    for k in range(DEPTH):
        own = F.call_function("shiftright", i, F.lit(3 * k))
        first = own - own % FANOUT
        level = F.col(f"l{k}")
        step = F.struct(
            F.array_join(F.slice(level, first + 1, own - first), "").alias("before"),
            F.array_join(F.slice(level, own + 2, first + FANOUT - 1 - own), "").alias("after"),
        )
        steps.append(F.when(F.col("n") > FANOUT**k, step))
    return F.filter(F.array(*steps), lambda s: s.isNotNull())


def grown(nodes: DataFrame, largest: int, workspace: Workspace, name: str) -> tuple[list[DataFrame], DataFrame]:
    """Slot arrays of every three levels from the leaves up, and (tree, root) of each tree."""
    rounds: list[DataFrame] = []
    while True:
        blocks = workspace.store(f"{name}{len(rounds)}", arrays(nodes))
        rounds.append(blocks)
        top = F.element_at(f"l{DEPTH}", 1)
        nodes = climbed(blocks).select("tree", F.col("block").alias("pos"), top.alias("leaf"), F.expr(f"(n - 1) div {SLOTS} + 1").alias("total"))
        largest = -(-largest // SLOTS)
        if largest <= 1:
            return rounds, nodes.select("tree", F.col("leaf").alias("root"))


def descended(rounds: list[DataFrame], above: DataFrame) -> DataFrame:
    """The leaves' arrays with their levels and what ``above`` (tree, path, …) has for their tree, ``path`` extended down to them."""
    kept = [c for c in above.columns if c not in ("tree", "path")]
    above = above.withColumn("block", F.lit(0).cast("long"))
    for blocks in reversed(rounds[1:]):
        paths = F.transform("slots", lambda s, i: F.concat(siblings(i), F.col("path")))
        below = climbed(both(blocks, above, ["tree", "block"])).select("tree", "block", *kept, F.posexplode(paths).alias("slot", "path"))
        above = below.select("tree", (F.col("block") * SLOTS + F.col("slot")).alias("block"), "path", *kept)
    return climbed(both(rounds[0], above, ["tree", "block"]))


NO_PATH = "array<struct<before: string, after: string>>"


def proven(rounds: list[DataFrame], trees: DataFrame, workspace: Workspace, root: str) -> DataFrame:
    """Each leaf with its proof; see ``manifest``."""
    langs = trees.where("tree is not null")
    ranks = rank_rows(langs, "tree", "root", workspace, "groups").with_rank()
    missing = trees.where("tree is null").select(F.lit(0).cast("long").alias("pos"), "tree", "root")
    named = ranks.select((F.col("rank") - 1).alias("pos"), F.col("value").alias("tree"), F.col("id").alias("root"))
    first = 0 if missing.isEmpty() else 1
    every = missing.union(named.select((F.col("pos") + first).alias("pos"), "tree", "root"))
    count = every.count()
    nodes = every.select(F.lit("").alias("tree"), "pos", F.col("root").alias("leaf"), F.col("tree").alias("name"), F.lit(count).cast("long").alias("total"))
    tops, whole = grown(nodes, count, workspace, "roots")
    start = whole.select("tree", F.array().cast(NO_PATH).alias("path"), F.col("root").alias(root))
    joined = descended(tops, start).select(
        root, F.inline(F.transform("slots", lambda s, i: F.struct(s["name"].alias("tree"), s["leaf"].alias("subroot"), F.concat(siblings(i), F.col("path")).alias("path"))))
    )
    return descended(rounds, workspace.store("tops", joined))


@dataclass
class Manifest:
    """``leaves``: key, leaf, other, subroot, root and ``path``, the siblings (before, after) level by level up to the root."""

    leaves: DataFrame | None
    blocks: DataFrame | None = None

    def checked(self) -> DataFrame:
        """key, leaf, subroot, root, proof_sha256 (of all siblings), and ``folded_root``, from ``other`` where there is one, else the leaf."""
        text = lambda path: F.array_join(F.transform(path, lambda s: F.concat(s["before"], s["after"])), "")
        fold = lambda start, path: F.aggregate(path, start, lambda node, s: hashed(F.concat(s["before"], node, s["after"])))
        blocks = self.blocks.withColumn("near", F.transform("slots", lambda s, i: siblings(i))).withColumn("far", text(F.col("path")))

        def row(s: Column, i: Column) -> Column:
            near = F.element_at("near", i + 1)
            return F.struct(
                s["key"].alias("key"),
                s["leaf"].alias("leaf"),
                hashed(F.concat(text(near), F.col("far"))).alias("proof_sha256"),
                fold(F.coalesce(s["other"], s["leaf"]), F.concat(near, F.col("path"))).alias("folded_root"),
            )

        return blocks.select("subroot", "root", F.inline(F.transform("slots", row)))


def manifest(docs: DataFrame, group: str, key: str, columns: list[str], workspace: Workspace, other: Column | None = None) -> Manifest | None:
    """The trees over all rows; None for an empty table.

    ``key`` is an integer column. ``other`` is a hash to fold in place of the leaf, null where there is none.
    """
    rows = docs.select(
        F.col(group).cast("string").alias("tree"),
        F.col(key).cast("long").alias("key"),
        leaf([F.col(c) for c in columns]).alias("leaf"),
        (F.lit(None) if other is None else other).cast("string").alias("other"),
        F.monotonically_increasing_id().alias("nr"),
    )
    rows = workspace.store("leaves", rows)
    nodes = placed(rows, workspace)
    largest = rows.groupBy("tree").count().agg(F.max("count")).first()[0]
    if largest is None:
        return None
    rounds, trees = grown(nodes, largest, workspace, "nodes")
    blocks = proven(rounds, workspace.store("trees", trees), workspace, "root")
    leaves = blocks.select("tree", "subroot", "root", "path", *[f"l{k}" for k in range(DEPTH)], "n", F.posexplode("slots").alias("i", "s"))
    leaves = leaves.select("tree", "s.key", "s.leaf", "s.other", "subroot", "root", F.concat(siblings(F.col("i")), F.col("path")).alias("path"))
    return Manifest(leaves, blocks)


UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
COLUMNS = ["doc_id", "source", "lang", "n_chars", "text"]


def verified(docs: DataFrame, workspace: Workspace) -> DataFrame:
    """The manifest of documents, with a fold of each row; rows whose key's CRC-32 is divisible by 3 are tampered with before it."""
    tampered = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3 == 0
    changed = leaf([F.translate("text", UPPER, LOWER) if c == "text" else F.col(c) for c in COLUMNS])
    made = manifest(docs, "lang", "doc_id", COLUMNS, workspace, F.when(tampered, changed))
    if made is None:
        return docs.sparkSession.createDataFrame([], "doc_id long, leaf string, subroot string, root string, proof_sha256 string, folded_root string, verified boolean")
    rows = made.checked().withColumnRenamed("key", "doc_id")
    return rows.select("doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", (F.col("folded_root") == F.col("root")).alias("verified"))


def _sql_leaf(text: str) -> str:
    values = [text if c == "text" else f"CAST({c} AS VARCHAR)" for c in COLUMNS]
    return "sha256(" + " || ".join(f"coalesce(strlen({v}) || ':' || {v}, '-')" for v in values) + ")"


_CRC = """xor(list_reduce(list_prepend(4294967295, list_transform(string_split(CAST(doc_id AS VARCHAR), ''), lambda c: ascii(c)::BIGINT)),
  lambda a, b: list_reduce(list_prepend(xor(a, b), range(8)), lambda x, i: CASE WHEN x % 2 = 1 THEN xor(x // 2, 3988292384) ELSE x // 2 END)), 4294967295)"""

#: The same trees level by level; proofs and folds walk from the leaf through the group's tree, then through the tree of groups.
SQL = f"""
WITH RECURSIVE
d AS (SELECT doc_id, lang, {_sql_leaf("text")} AS leaf,
        CASE WHEN {_CRC} % 3 = 0 THEN {_sql_leaf(f"translate(text, '{UPPER}', '{LOWER}')")} END AS other
      FROM documents),
p AS (SELECT *, coalesce('=' || lang, '-') AS tree, row_number() OVER (PARTITION BY lang ORDER BY doc_id NULLS FIRST, leaf) - 1 AS pos,
        count(*) OVER (PARTITION BY lang) AS n FROM d),
t AS (SELECT tree, 0 AS lvl, pos, leaf AS h, n FROM p
      UNION ALL
      SELECT tree, lvl + 1, pos // 8, sha256(string_agg(h, '' ORDER BY pos)), any_value((n + 7) // 8) FROM t WHERE n > 1 GROUP BY tree, lvl, pos // 8),
s AS (SELECT tree, h AS subroot, lvl AS height, row_number() OVER (ORDER BY tree = '-' DESC, tree) - 1 AS pos, count(*) OVER () AS n FROM t WHERE n = 1),
u AS (SELECT 0 AS lvl, pos, subroot AS h, n FROM s
      UNION ALL
      SELECT lvl + 1, pos // 8, sha256(string_agg(h, '' ORDER BY pos)), any_value((n + 7) // 8) FROM u WHERE n > 1 GROUP BY lvl, pos // 8),
e AS (SELECT a.tree, a.lvl, a.pos, coalesce(string_agg(b.h, '' ORDER BY b.pos) FILTER (b.pos < a.pos), '') AS bef,
        coalesce(string_agg(b.h, '' ORDER BY b.pos) FILTER (b.pos > a.pos), '') AS aft
      FROM (SELECT tree, lvl, pos, h, n FROM t UNION ALL SELECT '', lvl, pos, h, n FROM u) a
      JOIN (SELECT tree, lvl, pos, h, n FROM t UNION ALL SELECT '', lvl, pos, h, n FROM u) b
        ON a.tree = b.tree AND a.lvl = b.lvl AND a.pos // 8 = b.pos // 8
      WHERE a.n > 1 GROUP BY a.tree, a.lvl, a.pos),
w AS (SELECT p.tree AS home, p.pos AS leaf_pos, p.tree, 0 AS lvl, p.pos, coalesce(p.other, p.leaf) AS h, '' AS proof, FALSE AS done FROM p
      UNION ALL
      SELECT w.home, w.leaf_pos, CASE WHEN e.tree IS NULL THEN '' ELSE w.tree END, CASE WHEN e.tree IS NULL THEN 0 ELSE w.lvl + 1 END,
        CASE WHEN e.tree IS NOT NULL THEN w.pos // 8 WHEN w.tree = '' THEN 0 ELSE s.pos END,
        CASE WHEN e.tree IS NULL THEN w.h ELSE sha256(e.bef || w.h || e.aft) END,
        CASE WHEN e.tree IS NULL THEN w.proof ELSE w.proof || e.bef || e.aft END, e.tree IS NULL AND w.tree = ''
      FROM w LEFT JOIN e ON e.tree = w.tree AND e.lvl = w.lvl AND e.pos = w.pos LEFT JOIN s ON s.tree = w.home WHERE NOT w.done)
SELECT p.doc_id, p.leaf, s.subroot, (SELECT h FROM u WHERE n = 1) AS root, sha256(w.proof) AS proof_sha256, w.h AS folded_root,
  w.h = (SELECT h FROM u WHERE n = 1) AS verified
FROM p JOIN s USING (tree) JOIN w ON w.home = p.tree AND w.leaf_pos = p.pos AND w.done
"""
