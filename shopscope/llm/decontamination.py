"""Benchmark decontamination by size-partitioned MinHash containment search, in DataFrame functions only.

A test item is a small set inside a large one, for which signatures of equal length see nothing: a document's minima
are not the item's. So sketches are asymmetric and depend on the item's size. Items are partitioned by the octave of
their number of shingles n; the sketch of an item is its floor((1 - t) * n) + 1 smallest hashes, as a document that
holds the share t of the item's shingles misses at most floor((1 - t) * n) of them and so holds one of the sketch. A
document is sketched by all its hashes up to the largest one any partition's sketches hold, whatever its length, which
leaves no item of any size unseen. Documents and items that share a sketch hash are candidates, and are verified by
exact containment of the shingle sets.

Sketches and candidates are broadcast only if they have at most ``BROADCAST_ROWS`` rows, else they join by shuffle.

Defined cases: null texts count as empty; items without words match nothing; items of fewer than five words are one
shingle and match documents of just these words; rows that repeat an item (id and shingles) count once, other rows of
the same item_id are items of their own; repeated documents give rows of their own; empty tables give no rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shopscope.llm.native_words import BETWEEN, shingles, words
from shopscope.sources.workspace import Workspace

SIZE, THRESHOLD = 5, 0.8
#: Narrow rows of three numbers; a million take some 30 MB.
BROADCAST_ROWS = 1_000_000


def _hinted(df: DataFrame, rows: int) -> DataFrame:
    return F.broadcast(df) if rows <= BROADCAST_ROWS else df


def shingled(table: DataFrame, text: str, *keys: str | Column) -> DataFrame:
    """Keys and ``shingles``, the distinct hashes of each row's shingles."""
    hashed = table.select(*keys, F.transform(words(F.col(text)), lambda w: F.xxhash64(w)).alias("_words"))
    return hashed.select(*hashed.columns[:-1], F.array_distinct(shingles(F.col("_words"), SIZE)).alias("shingles"))


def sketched(items: DataFrame, threshold: float) -> DataFrame:
    """Items with their size partition and sketch; ``items`` has item_id and shingles."""
    count = F.size("shingles")
    smallest = F.slice(F.sort_array("shingles"), F.lit(1), F.floor((1 - F.lit(threshold)) * count + 1e-9).cast("int") + 1)
    return items.where(count > 0).select("item_id", "shingles", F.floor(F.log2(count)).cast("int").alias("octave"), smallest.alias("sketch"))


def find(docs: DataFrame, benchmark: DataFrame, workspace: Workspace, threshold: float = THRESHOLD) -> DataFrame:
    """doc_id, body (a hash of the text), item_id, shared, item_shingles and containment of each pair from the threshold on."""
    own = shingled(benchmark, "text", F.col("item_id").cast("long").alias("item_id")).distinct()
    items = sketched(own, threshold).withColumn("item", F.xxhash64("item_id", F.array_join(F.col("shingles").cast("array<string>"), " ")))
    items = workspace.store("items", items)
    sketches = items.select("item", "octave", F.explode("sketch").alias("hash"))
    bounds = sketches.groupBy("octave").agg(F.max("hash").alias("upto"), F.count(F.lit(1)).alias("rows")).collect()  # a row for each octave of sizes
    upto, rows = max((r["upto"] for r in bounds), default=None), sum(r["rows"] for r in bounds)
    keyed = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    keyed = keyed.withColumn("body", F.xxhash64("text"))
    probes = shingled(keyed, "text", "doc_id", "body")
    low = F.filter("shingles", lambda h: h <= F.lit(upto).cast("long"))
    probes = probes.select("doc_id", "body", F.explode(low).alias("hash"))
    found = probes.join(_hinted(sketches.select("hash", "item"), rows), "hash").select("doc_id", "body", "item").distinct()
    candidates = workspace.store("candidates", found)
    n_candidates = candidates.count()
    # the documents of candidates once more, with all their shingles
    near = _hinted(candidates.select("doc_id", "body").distinct(), n_candidates)
    same = lambda a, b: a["doc_id"].eqNullSafe(b["doc_id"]) & (a["body"] == b["body"])
    again = shingled(keyed.join(near, same(keyed, near), "left_semi"), "text", "doc_id", "body")
    pairs = again.join(_hinted(candidates, n_candidates), same(again, candidates)).select(again["doc_id"], again["body"], again["shingles"], "item")
    sets = items.select("item", "item_id", F.col("shingles").alias("item_set"))
    both = pairs.join(_hinted(sets, 50 * rows), "item")  # an item has some five times as many shingles as its sketch
    shared, whole = F.size(F.array_intersect("item_set", "shingles")), F.size("item_set")
    exact = both.select("doc_id", "body", "item_id", shared.cast("long").alias("shared"), whole.cast("long").alias("item_shingles"))
    exact = exact.withColumn("containment", F.col("shared") / F.col("item_shingles"))
    return exact.where(F.col("shared") >= F.ceil(F.lit(threshold) * F.col("item_shingles") - 1e-9))


def without_leaks(docs: DataFrame, benchmark: DataFrame, workspace: Workspace, threshold: float = THRESHOLD) -> DataFrame:
    """The documents that hold no test item, in all their columns."""
    leaks = find(docs, benchmark, workspace, threshold).select(F.col("doc_id").alias("_id"), F.col("body").alias("_body")).distinct()
    leaks = workspace.store("leaks", leaks)
    leaks = _hinted(leaks, leaks.count())
    body = F.xxhash64(F.coalesce(docs["text"].cast("string"), F.lit("")))
    return docs.join(leaks, docs["doc_id"].cast("long").eqNullSafe(leaks["_id"]) & (body == leaks["_body"]), "left_anti")


def _sets(key: str, table: str) -> str:
    return f"""
    select {key}, list_distinct(case when len(w) >= 5 then list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' '))
                                when len(w) > 0 then [array_to_string(w, ' ')] else [] end) as s
    from (select {key}, list_filter(string_split_regex(lower(coalesce(text, '')), '{BETWEEN}'), lambda x: x <> '') as w from {table})"""


SQL = f"""
with d as ({_sets("doc_id", "documents")}), i as (select distinct * from ({_sets("item_id", "benchmark")})),
de as (select doc_id, unnest(s) as g from d), ie as (select item_id, len(s) as n, unnest(s) as g from i)
select doc_id, item_id, count(*) as shared, cast(n as bigint) as item_shingles, count(*) / n as containment
from de join ie using (g) group by doc_id, item_id, n having count(*) >= ceil(0.8 * n - 1e-9)
"""
