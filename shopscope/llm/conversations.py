"""Collapse of cumulative snapshots: logged conversations that are a prefix of a longer one go, the others are rendered.

A rolling hash of each turn prefix is computed over all turns, range-sorted by conversation and turn. Each task rolls
through its rows; a conversation that goes on in the next task is joined up by the polynomial form of the hash, from
one summary row a task edge. So a conversation of any length is spread over tasks, and none is ever gathered. The
same pass tells which prefixes go on. Whole conversations are then anti-joined with the prefixes, by length and hashes,
that go on in some conversation, so those that begin a longer one go. Of equal ones the smallest conv_id stays.

Rendering gives a row a turn, whose segments in order are the conversation's text, as a conversation may be too long for one value.

Defined cases: turns are ordered by turn (nulls first), then role and a hash of the text (in the SQL: the text); repeated rows are turns of
their own; null roles and texts count as empty; rows with a null conv_id are one conversation, which is the last to
stay among equal ones; an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shopscope.sources.workspace import Workspace

# Two polynomial hashes: moduli are Mersenne primes, bases any large numbers below them.
MODULI = ((1 << 61) - 1, (1 << 31) - 1)
BASES = (1_000_003_000_019_000_117, 1_000_003)

ROLLED = "task int, conv_id long, place long, a long, b long, edge boolean, goes_on boolean"


def _content(turns: DataFrame) -> DataFrame:
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in ("role", "text"))
    return turns.select(F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"), role.alias("role"), F.xxhash64(text).alias("text"), F.xxhash64(role, text).alias("h"))


def roll(turns: DataFrame) -> DataFrame:
    """Each turn's place and prefix hashes within its task's part of the conversation, and whether another turn follows there.

    ``edge`` marks the last turn of a task's first and last conversation.
    """

    def task(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        number, current, place, hashes, first, pending = TaskContext.get().partitionId(), None, 0, (0, 0), True, None
        for batch in batches:
            out = []
            for conv, h in zip(batch["conv_id"].astype("Int64").tolist(), batch["h"].tolist()):
                own = None if conv is pd.NA else conv
                if pending is not None and own != current:
                    pending[5], first = first, False
                if pending is None or own != current:
                    current, place, hashes = own, 0, (0, 0)
                if pending is not None:
                    pending[6] = place > 0
                    out.append(pending)
                place += 1
                hashes = tuple((x * base + h) % modulus for x, base, modulus in zip(hashes, BASES, MODULI))
                pending = [number, own, place, *hashes, False, False]
            yield _frame(out)
        if pending is not None:
            pending[5] = True
            yield _frame([pending])

    def _frame(rows: list) -> pd.DataFrame:
        frame = pd.DataFrame(rows, columns=["task", "conv_id", "place", "a", "b", "edge", "goes_on"])
        return frame.astype({"conv_id": "Int64"})

    parts = int(turns.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    order = ["conv_id", "turn", "role", "text"]
    return _content(turns).repartitionByRange(parts, *order).sortWithinPartitions(*order).select("conv_id", "h").mapInPandas(task, ROLLED)


def carries(edges: list) -> dict[tuple[int, int | None], tuple[int, int, int]]:
    """By task and conversation: how many turns earlier tasks hold of it, and their hashes."""
    carry, last = {}, None
    for row in sorted(edges, key=lambda r: (r["task"], r["conv_id"] is not None, r["conv_id"] or 0)):
        before = carry.get((last["task"], last["conv_id"]), (0, 0, 0)) if last is not None and last["conv_id"] == row["conv_id"] else None
        if before is not None:
            carry[row["task"], row["conv_id"]] = (
                before[0] + last["place"],
                *((x * pow(base, last["place"], m) + last[c]) % m for x, base, m, c in zip(before[1:], BASES, MODULI, "ab")),
            )
        last = row
    return carry


def continued(edges: list) -> set[tuple[int, int | None]]:
    """Tasks and conversations whose last turn there is followed by one of a later task."""
    ordered = sorted(edges, key=lambda r: (r["task"], r["conv_id"] is not None, r["conv_id"] or 0))
    return {(row["task"], row["conv_id"]) for row, after in zip(ordered, ordered[1:]) if row["conv_id"] == after["conv_id"]}


def prefixes(turns: DataFrame, workspace: Workspace) -> DataFrame:
    """conv_id, length and hashes of every turn prefix of every conversation, and whether the conversation goes on after it."""
    rolled = workspace.store("rolled", roll(turns))
    edges = rolled.where("edge").collect()  # at most two rows a task
    carry, more = carries(edges), continued(edges)

    def task(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = []
            for number, conv, place, a, b, edge, goes_on in zip(batch["task"], batch["conv_id"].astype("Int64").tolist(), *(batch[c] for c in ("place", "a", "b", "edge", "goes_on"))):
                own = None if conv is pd.NA else conv
                goes_on = goes_on or edge and (number, own) in more
                if (before := carry.get((number, own))) is not None:
                    a, b = ((x * pow(base, int(place), m) + int(y)) % m for x, base, m, y in zip(before[1:], BASES, MODULI, (a, b)))
                    place += before[0]
                rows.append((own, place, a, b, bool(goes_on)))
            yield pd.DataFrame(rows, columns=["conv_id", "length", "a", "b", "goes_on"]).astype({"conv_id": "Int64"})

    return rolled.select("task", "conv_id", "place", "a", "b", "edge", "goes_on").mapInPandas(task, "conv_id long, length long, a long, b long, goes_on boolean")


def maximal(turns: DataFrame, workspace: Workspace) -> DataFrame:
    """conv_id, length and number of equal conversations of those that stay."""
    every = workspace.store("prefixes", prefixes(turns, workspace))
    order = F.struct(F.col("conv_id").isNull().alias("missing"), "conv_id")
    equal = every.where("not goes_on").groupBy("length", "a", "b").agg(F.min(order).alias("kept"), F.count(F.lit(1)).alias("copies"))
    begun = every.where("goes_on").select("length", "a", "b").distinct()
    longest = equal.join(begun, ["length", "a", "b"], "left_anti")
    return longest.select(F.col("kept.conv_id").alias("conv_id"), "length", "copies")


def segment(role: Column, text: Column) -> Column:
    """One turn in the chat format."""
    role, text = (F.coalesce(x.cast("string"), F.lit("")) for x in (role, text))
    return F.concat(F.lit("<|im_start|>"), role, F.lit("\n"), text, F.lit("<|im_end|>\n"))


def rendered(turns: DataFrame, workspace: Workspace | None = None) -> DataFrame:
    """conv_id, turn, role and segment of each turn of the conversations that stay."""
    kept = maximal(turns, workspace or Workspace(turns.sparkSession)).select(F.col("conv_id").alias("kept"))
    own = turns.join(kept, turns["conv_id"].cast("long").eqNullSafe(kept["kept"]), "left_semi")
    return own.select("conv_id", "turn", "role", segment(F.col("role"), F.col("text")).alias("segment"))


SQL = """
with c as (select conv_id, list(coalesce(role, '') || chr(10) || coalesce(text, '') order by turn nulls first, coalesce(role, ''), coalesce(text, '')) as l from conversations group by conv_id),
k as (select min(conv_id) as conv_id, l from c group by l),
m as (select conv_id from k where not exists (select 1 from k as o where len(o.l) > len(k.l) and o.l[1:len(k.l)] = k.l))
select conv_id, turn, role, '<|im_start|>' || coalesce(role, '') || chr(10) || coalesce(text, '') || '<|im_end|>' || chr(10) as segment
from conversations where conv_id in (select conv_id from m)
"""
