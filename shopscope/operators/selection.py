"""The keys at a few ranks of a table, without sorting it: selection on composite keys.

A key is (value, id), NULLs last. Every wanted rank has an interval of keys it must lie in, at first all keys. A round
samples the open intervals by a hash of the id, takes two splitters around the place where each rank should be, and
counts in one pass how many keys are not beyond each splitter; these counts are exact, so the rank's new interval is the
one between the splitters that holds it, and some thirty times smaller as a rule. When all intervals are small, their
keys are fetched and the ranks picked. All measures share the passes, which read the narrow columns of the table and
shuffle counts only: nothing is stored, and a value that everybody has costs no more than another.
"""

from __future__ import annotations

from dataclasses import dataclass
from math import ceil, floor, sqrt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shopscope.operators.ranking import key_after, tile_end_ranks

#: Keys of an interval that are fetched, and keys sampled from one.
FETCHED, SAMPLED = 16_384, 10_000

Key = tuple


def _order(key: Key) -> tuple:
    value, own = key
    return value is None, value if value is not None else 0, own is None, own or ""


@dataclass(frozen=True)
class _Interval:
    """Keys after ``low`` and not after ``high`` (None: unbounded), ``before`` of all keys lying in front."""

    measure: str
    low: Key | None
    high: Key | None
    before: int
    count: int


class Selection:
    """Keys at ranks of several measures of one table; ids must be unique, but for a single NULL."""

    def __init__(self, df: DataFrame, measures: list[str], id_column: str, fetched: int = FETCHED, sampled: int = SAMPLED):
        self.df = df.select(id_column, *measures)
        self.measures, self.id, self.fetched, self.sampled = measures, id_column, fetched, sampled
        self.total = self.df.count()

    def _beyond(self, measure: str, key: Key) -> Column:
        """Whether a row's key is after the given one."""
        last = (F.lit(key[0]).cast(self.df.schema[measure].dataType), F.lit(key[1]).cast(self.df.schema[self.id].dataType))
        return key_after((F.col(measure), F.col(self.id)), last)

    def _inside(self, interval: _Interval) -> Column:
        inside = F.lit(True)
        if interval.low is not None:
            inside = inside & self._beyond(interval.measure, interval.low)
        if interval.high is not None:
            inside = inside & ~self._beyond(interval.measure, interval.high)
        return inside

    def _keys(self, intervals: list[_Interval], part: dict[_Interval, Column]) -> dict[_Interval, list[Key]]:
        """Sorted keys of each interval, or a part of them, in one pass."""
        marks = [F.when(self._inside(i) & part.get(i, F.lit(True)), F.lit(n)) for n, i in enumerate(intervals)]
        found: dict[_Interval, list[Key]] = {i: [] for i in intervals}
        hits = self.df.withColumn("_hit", F.explode(F.filter(F.array(*marks), lambda n: n.isNotNull())))
        table = hits.toArrow().to_pydict()
        ids, columns = table[self.id], [table[i.measure] for i in intervals]
        for row, n in enumerate(table["_hit"]):
            found[intervals[n]].append((columns[n][row], ids[row]))
        return {i: sorted(keys, key=_order) for i, keys in found.items()}

    def keys_at(self, ranks: dict[str, list[int]]) -> dict[str, dict[int, Key]]:
        """(value, id) by measure and one-based rank."""
        at = {(m, r): _Interval(m, None, None, 0, self.total) for m, wanted in ranks.items() for r in wanted}
        rounds = 0
        while wide := {i for i in at.values() if i.count > self.fetched}:
            before = sum(i.count for i in at.values())
            at |= self._narrowed({target: i for target, i in at.items() if i in wide}, rounds)
            rounds += 1
            if sum(i.count for i in at.values()) == before and rounds > 8:
                raise ValueError(f"more than {self.fetched} rows share one key of {self.measures}")
        intervals = list(dict.fromkeys(at.values()))
        keys = self._keys(intervals, {}) if intervals else {}
        found: dict[str, dict[int, Key]] = {m: {} for m in ranks}
        for (measure, rank), interval in at.items():
            found[measure][rank] = keys[interval][rank - interval.before - 1]
        return found

    def _narrowed(self, at: dict[tuple[str, int], _Interval], rounds: int) -> dict[tuple[str, int], _Interval]:
        intervals = list(dict.fromkeys(at.values()))
        dice = F.pmod(F.xxhash64(self.id, F.lit(rounds)), F.lit(1 << 30).cast("bigint"))
        part = {i: dice < int(min(1.0, self.sampled / i.count) * (1 << 30)) for i in intervals}
        sample = self._keys(intervals, part)
        splitters: dict[str, set[Key]] = {}
        for (measure, rank), interval in at.items():
            keys = sample[interval]
            share = (rank - interval.before) / interval.count
            near, reach = share * len(keys), min(3 * sqrt(len(keys) * share * (1 - share)) + 1, len(keys) / 4)
            places = (floor(near - reach), ceil(near + reach))
            splitters.setdefault(measure, set()).update(keys[p] for p in places if 0 <= p < len(keys))
        named = [(m, key) for m, keys in splitters.items() for key in sorted(keys, key=_order)]
        counts = self.df.agg(*[F.count_if(~self._beyond(m, key)).alias(str(n)) for n, (m, key) in enumerate(named)]).first() if named else ()
        narrowed = {}
        for (measure, rank), old in at.items():
            low, before, high, upto = old.low, old.before, old.high, old.before + old.count
            for (m, key), n in zip(named, counts):
                if m == measure and before < n < rank:
                    low, before = key, n
                elif m == measure and rank <= n < upto:
                    high, upto = key, n
            narrowed[measure, rank] = _Interval(measure, low, high, before, upto - before)
        return narrowed


def tile_ends(df: DataFrame, measures: list[str], id_column: str, tiles: int, **sizes: int) -> dict[str, tuple[list[Key], list[Key]]]:
    """The last key of every tile but the final one by measure, with the tiles counted up and counted down."""
    chosen = Selection(df, measures, id_column, **sizes)
    up = tile_end_ranks(chosen.total, tiles)[:-1]
    down = [chosen.total + 1 - end for end in up]
    keys = chosen.keys_at({m: sorted({*up, *down}) for m in measures})
    return {m: ([own[r] for r in up], [own[r] for r in down]) for m, own in keys.items()}
