"""Exact quantiles by narrowing brackets: sketch, count, keep what lies inside, rank those few.

A mergeable sketch gives an interval around each wanted rank. One pass then counts what lies below
the interval and inside it. An interval that does not hold its ranks is widened to the extremes, one
that holds too many values is narrowed by a sketch of its inside; the few values left are ranked. The
table is read again instead of being laid out, no value is dropped, and no task or driver holds more
than a bounded number of values.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lakeaudit.functions.columns import rows_frame
from lakeaudit.functions.durable import durable
from lakeaudit.functions.skew import left_join

#: Size of a sketch over a column, and of one per group.
COLUMN_SKETCH, GROUP_SKETCH = 4096, 256
#: Inside a bracket, up to so many values are ranked.
RANKED_VALUES = 200_000
#: Quantiles of a group's sketch among which its next bracket is chosen.
_GRID = 256


def _margin(size: int) -> float:
    """Twice the rank error that a sketch of this size keeps in 99 of 100 cases."""
    return 2 * 2.296 / size**0.9021


def place(n: int, p: float) -> tuple[int, int, float]:
    """0-based ranks around probability ``p`` of ``n`` values, and the share of the upper one."""
    at = (n - 1) * p
    return math.floor(at), math.ceil(at), at - math.floor(at)


# ---------------------------------------------------------------- columns of a table

@dataclass
class _Bracket:
    """Two neighbouring ranks (or one twice) of a column and an interval to find them in.

    The ends are counted apart from the open inside, so a narrower interval always leaves values out.
    """

    column: int
    low: float
    high: float
    ranks: tuple[int, int]
    below: int = 0
    at_low: int = 0
    inside: int = 0
    at_high: int = 0
    least: float | None = None
    most: float | None = None

    def value(self, rank: int) -> float | None:
        """The value at a rank, if an end or an extreme of the inside has it."""
        seat = rank - self.below
        if seat < self.at_low:
            return self.low
        if seat >= self.at_low + self.inside:
            return self.high
        if seat == self.at_low:
            return self.least
        return self.most if seat == self.at_low + self.inside - 1 else None


@dataclass
class ColumnStats:
    count: int
    mean: float | None
    std: float | None
    least: float | None
    most: float | None
    quantiles: dict[str, float | None]


def _inside(b: _Bracket) -> Column:
    v = F.col(f"v{b.column}")
    return F.when((v > F.lit(b.low)) & (v < F.lit(b.high)), v)


def _segment(v: Column, ends: list[float], first: int, stop: int) -> Column:
    """The segment of ``v`` among ``ends[first:stop]``, by halving: few comparisons for every row."""
    if first == stop:
        return F.lit(2 * first)
    middle = (first + stop) // 2
    return F.when(v < F.lit(ends[middle]), _segment(v, ends, first, middle)).when(
        v == F.lit(ends[middle]), F.lit(2 * middle + 1)).otherwise(_segment(v, ends, middle + 1, stop))


def _each(values: DataFrame, columns: Sequence[int], use: Callable[[DataFrame, int], DataFrame]) -> DataFrame:
    """``use`` on every column alone, as one job: a columnar scan reads each column once either way, and
    small expressions stay in generated code."""
    parts = [use(values.select(F.col(f"v{i}").alias("v")).where("v is not null"), i).select(F.lit(i).alias("place"), "*")
             for i in columns]
    return reduce(DataFrame.unionAll, parts)


def _ends(brackets: list[_Bracket]) -> dict[int, list[float]]:
    """The sorted bracket ends of every column.

    Segment 2i + 1 is the i-th end itself and 2i what lies before it, so brackets are unions of segments.
    """
    ends: dict[int, set[float]] = {}
    for b in brackets:
        ends.setdefault(b.column, set()).update((b.low, b.high))
    return {c: sorted(e) for c, e in ends.items()}


def _gathered(values: DataFrame, brackets: list[_Bracket], centres: dict[int, float]) -> DataFrame:
    """(place, s, kept, n, least, most, off): counts of all segments, and the values inside brackets each by itself.

    ``off`` adds up distances from the column's centre, for a mean without the rounding of a long sum.
    """
    ends = _ends(brackets)
    kept: dict[int, set[int]] = {c: set() for c in ends}
    for b in brackets:
        own = ends[b.column]
        kept[b.column].update(range(2 * own.index(b.low) + 2, 2 * own.index(b.high) + 1))
    v = F.col("v")

    def read(df: DataFrame, column: int) -> DataFrame:
        cells = df.select("v", _segment(v, ends[column], 0, len(ends[column])).alias("s"))
        cells = cells.groupBy("s", F.when(F.col("s").isin(sorted(kept[column])), v).alias("kept"))
        return cells.agg(F.count(F.lit(1)).alias("n"), F.min("v").alias("least"), F.max("v").alias("most"),
                         F.sum(v - F.lit(centres[column])).alias("off"))

    return durable(_each(values, list(ends), read))


def _count(gathered: DataFrame, brackets: list[_Bracket]) -> dict[int, float]:
    """Fills in the counts of the brackets; gives the summed distances from the centres."""
    ends = _ends(brackets)
    found: dict[int, dict[int, tuple]] = {c: {} for c in ends}
    off = dict.fromkeys(ends, 0.0)
    for row in gathered.groupBy("place", "s").agg(
            F.sum("n").alias("n"), F.min("least").alias("least"), F.max("most").alias("most"), F.sum("off").alias("off")).collect():
        found[row["place"]][row["s"]] = (row["n"], row["least"], row["most"])
        off[row["place"]] += row["off"]
    for b in brackets:
        own, known = ends[b.column], found[b.column]
        low, high = 2 * own.index(b.low) + 1, 2 * own.index(b.high) + 1
        total = lambda r: sum(known[s][0] for s in r if s in known)  # noqa: B023, E731
        between = [known[s] for s in range(low + 1, high) if s in known]
        b.below, b.at_low, b.inside = total(range(low)), total([low]), sum(x[0] for x in between)
        b.at_high = total([high]) if low < high else 0
        b.least = min((x[1] for x in between), default=None)
        b.most = max((x[2] for x in between), default=None)
    return off


def _narrow(values: DataFrame, brackets: list[_Bracket]) -> None:
    """The next bracket of each, from a sketch of its inside and the ranks relative to it."""
    margin, cells = _margin(COLUMN_SKETCH), []
    for i, b in enumerate(brackets):
        low, high = ((r - b.below - b.at_low + 0.5) / b.inside for r in b.ranks)
        probs = F.array(F.lit(max(low - margin, 0.0)), F.lit(min(high + margin, 1.0)))
        cells.append(F.kll_sketch_get_quantile_double(F.kll_sketch_agg_double(_inside(b), F.lit(COLUMN_SKETCH)), probs).alias(f"q{i}"))
    row = values.agg(*cells).first()
    for i, b in enumerate(brackets):
        b.low, b.high = row[f"q{i}"]


def _ranked(gathered: DataFrame, every: list[_Bracket], brackets: list[_Bracket]) -> list[dict[int, float]]:
    """{rank: value} of each bracket; its inside holds a bounded number of values."""
    ends = _ends(every)
    held = []
    for i, b in enumerate(brackets):
        own = ends[b.column]
        held += [(b.column, s, i) for s in range(2 * own.index(b.low) + 2, 2 * own.index(b.high) + 1)]
    # a row per bracket and segment
    held = F.broadcast(rows_frame(gathered, held, "place int, s int, bracket int"))
    found = gathered.where("kept is not null").select("place", "s", F.col("kept").alias("v"), "n").join(held, ["place", "s"])
    up_to = F.sum("n").over(Window.partitionBy("bracket").orderBy("v"))
    found = found.withColumn("after", up_to)
    wanted = F.lit(False)
    seats = [{r: r - b.below - b.at_low for r in b.ranks} for b in brackets]
    for i, own in enumerate(seats):
        for seat in set(own.values()):
            wanted = wanted | ((F.col("bracket") == i) & (F.col("after") > seat) & (F.col("after") - F.col("n") <= seat))
    out: list[dict[int, float]] = [{} for _ in brackets]
    for row in found.where(wanted).collect():  # two values a bracket at most
        for rank, seat in seats[row["bracket"]].items():
            if row["after"] - row["n"] <= seat < row["after"]:
                out[row["bracket"]][rank] = row["v"]
    return out


def column_stats(df: DataFrame, columns: Sequence[Column], probs: dict[str, float]) -> list[ColumnStats]:
    """Count, mean, deviation, extremes and exact interpolated quantiles of double columns; nulls are left out.

    A number per column and probability reaches the driver.
    """
    values = df.select(*[c.alias(f"v{i}") for i, c in enumerate(columns)])
    wide = range(len(columns))
    cell = F.col("v")
    aggs = [F.count(cell).alias("n"), F.avg(cell).alias("mean"), F.stddev_samp(cell).alias("std"), F.min(cell).alias("least"),
            F.max(cell).alias("most")]
    if probs:
        margin = _margin(COLUMN_SKETCH)
        rough = F.array(*[F.lit(min(max(p + side * margin, 0.0), 1.0)) for p in probs.values() for side in (-1, 1)])
        sketch = F.kll_sketch_agg_double(cell, F.lit(COLUMN_SKETCH))
        aggs.append(F.when(F.count(cell) > 0, F.kll_sketch_get_quantile_double(sketch, rough)).alias("q"))
    found = _each(values, wide, lambda df, _: df.agg(*aggs)).collect()
    row = {f"{c}{r['place']}": r[c] for r in found for c in r.asDict() if c != "place"}
    row = {f"n{i}": 0 for i in wide} | {f"{c}{i}": None for i in wide for c in ("mean", "std", "least", "most")} | row
    stats, brackets = [], []
    for i in range(len(columns)):
        n = row[f"n{i}"]
        stats.append(ColumnStats(n, row[f"mean{i}"], row[f"std{i}"], row[f"least{i}"], row[f"most{i}"], dict.fromkeys(probs)))
        for j, p in enumerate(probs.values() if n else ()):
            brackets.append(_Bracket(i, row[f"q{i}"][2 * j], row[f"q{i}"][2 * j + 1], place(n, p)[:2]))

    known: dict[int, dict[int, float]] = {}
    open_ones, first = brackets, True
    while open_ones:
        gathered = _gathered(values, open_ones, {i: s.mean or 0.0 for i, s in enumerate(stats)})
        off = _count(gathered, open_ones)
        if first:
            for i, s in enumerate(stats):
                s.mean = s.mean + off[i] / s.count if s.count else None
        missed, wide, few, first = [], [], [], False
        for b in open_ones:
            if b.below > b.ranks[0] or b.below + b.at_low + b.inside + b.at_high <= b.ranks[1]:
                missed.append(b)
            elif None not in (values_at := {r: b.value(r) for r in b.ranks}).values():
                known[id(b)] = values_at
            else:
                (few if b.inside <= RANKED_VALUES else wide).append(b)
        if few:
            known |= {id(b): values_at for b, values_at in zip(few, _ranked(gathered, open_ones, few))}
        for b in missed:
            if b.below > b.ranks[0]:
                b.low = row[f"least{b.column}"]
            else:
                b.high = row[f"most{b.column}"]
        if wide:
            _narrow(values, wide)
        open_ones = missed + wide
    at = iter(brackets)
    for s in stats:
        for name, p in probs.items() if s.count else ():
            b = next(at)
            low, high = (known[id(b)][r] for r in b.ranks)
            s.quantiles[name] = low + (high - low) * place(s.count, p)[2]
    return stats


# ---------------------------------------------------------------- groups

def group_medians(df: DataFrame, keys: Sequence[str], value: str, name: str, aggs: Sequence[Column]) -> DataFrame:
    """``groupBy(keys).agg(aggs)`` and the exact median of ``value``, in one grouping.

    A group of up to ``GROUP_SKETCH`` values is whole in its sketch, whose middle is the median. Larger
    groups go through brackets: their rows meet a bracket per group, spread over several tasks.
    """
    keys = list(keys)
    near, wide = 1.0 / (4 * GROUP_SKETCH), _margin(GROUP_SKETCH)
    v = F.col(value).cast("double")
    grouped = df.groupBy(*keys).agg(
        *aggs, F.count(v).alias("_n"), F.kll_sketch_agg_double(v, F.lit(GROUP_SKETCH)).alias("_sketch"))
    probs = F.array(*[F.lit(0.5 + d) for d in (-wide, -near, near, wide)])
    quartet = F.when(F.col("_n") > 0, F.kll_sketch_get_quantile_double("_sketch", probs))
    grouped = durable(grouped.withColumn("_q", quartet).drop("_sketch"))
    middle = F.when(F.col("_n") <= GROUP_SKETCH, _middle(F.element_at("_q", 2), F.element_at("_q", 3)))
    large = grouped.where(F.col("_n") > GROUP_SKETCH)
    result = grouped.withColumn(name, middle)
    if not large.isEmpty():
        start = large.select(*keys, "_n", F.element_at("_q", 1).alias("_low"), F.element_at("_q", 4).alias("_high"))
        medians = _bracketed_medians(df.select(*keys, v.alias("_v")).where("_v is not null"), start, keys, name)
        renamed = medians.select(*[F.col(k).alias(f"_k{i}") for i, k in enumerate(keys)], F.col(name).alias("_large"))
        on = [F.col(k).eqNullSafe(F.col(f"_k{i}")) for i, k in enumerate(keys)]
        result = result.join(renamed, on, "left").withColumn(name, F.coalesce("_large", name))
    return result.select(*[c for c in grouped.columns if c not in ("_n", "_q")], name)


def _middle(low: Column, high: Column) -> Column:
    return F.when(low == high, low).otherwise(low + (high - low) * 0.5)


def _bracketed_medians(rows: DataFrame, start: DataFrame, keys: list[str], name: str) -> DataFrame:
    """(keys, median) of the groups in ``start``, whose brackets are narrowed until few values are inside."""
    # null keys are values of their own here, which a join on equal keys would not match
    marks = [f"_m{i}" for i in range(len(keys))]
    rows = rows.select(*_codes(keys, marks), "_v")
    names = durable(start.select(*keys, *_codes(keys, marks)))
    # the wanted ranks and the extremes, to which a bracket that misses a rank falls back
    brackets = durable(start.select(*_codes(keys, marks), "_n", "_low", "_high"))
    first, last = F.floor((F.col("_n") - 1) / 2), F.ceil((F.col("_n") - 1) / 2)
    grid = F.array(*[F.lit(i / _GRID) for i in range(_GRID + 1)])
    infinite = F.lit(float("inf"))
    v, low, high = F.col("_v"), F.col("_low"), F.col("_high")
    inside = (v > low) & (v < high)
    kept = F.when(inside, v)
    base = F.col("_below") + F.col("_at_low")

    def value(rank: Column) -> Column:
        return F.when(rank < base, low).when(rank >= base + F.col("_inside"), high).when(rank == base, F.col("_least")).when(
            rank == base + F.col("_inside") - 1, F.col("_most"))

    def seat(rank: Column, step: int) -> Column:
        place = F.floor((rank - base) / F.col("_inside") * _GRID).cast("int") + step
        return F.element_at("_grid", F.greatest(F.lit(1), F.least(F.lit(_GRID + 1), place)))

    settled, few = [], []
    while True:
        met = left_join(rows, brackets, marks).where(low.isNotNull())
        counted = met.groupBy(*marks).agg(
            F.first("_n").alias("_n"), F.first("_low").alias("_low"), F.first("_high").alias("_high"),
            F.count_if(v < low).alias("_below"), F.count_if(v == low).alias("_at_low"), F.count(kept).alias("_inside"),
            F.count_if((v == high) & (low < high)).alias("_at_high"), F.min(kept).alias("_least"), F.max(kept).alias("_most"),
            F.kll_sketch_agg_double(kept, F.lit(4 * GROUP_SKETCH)).alias("_sketch"))
        misses_low = F.col("_below") > first
        misses_high = base + F.col("_inside") + F.col("_at_high") <= last
        state = F.when(misses_low | misses_high, "missed").when(value(first).isNotNull() & value(last).isNotNull(), "known").when(
            F.col("_inside") <= RANKED_VALUES, "few").otherwise("wide")
        counted = counted.withColumn("_state", state)
        counted = durable(counted.withColumn("_grid", F.when(
            F.col("_state") == "wide", F.kll_sketch_get_quantile_double("_sketch", grid))).drop("_sketch"))
        settled.append(counted.where("_state = 'known'").select(*marks, _middle(value(first), value(last)).alias(name)))
        few.append(counted.where("_state = 'few'").select(*marks, "_n", "_low", "_high", base.alias("_base")))
        # a step of the grid on either side is more than the sketch's error
        wide = F.col("_state") == "wide"
        brackets = durable(counted.where("_state in ('missed', 'wide')").select(
            *marks, "_n", F.when(wide, seat(first, -1)).when(misses_low, -infinite).otherwise(low).alias("_low"),
            F.when(wide, seat(last, 4)).when(misses_high, infinite).otherwise(high).alias("_high")))
        if brackets.isEmpty():
            break
    known, ranked = reduce(DataFrame.unionByName, settled), reduce(DataFrame.unionByName, few)
    met = left_join(rows, ranked, marks).where(inside)
    counts = met.groupBy(*marks, "_v").agg(
        F.count(F.lit(1)).alias("_c"), F.first("_n").alias("_n"), F.first("_base").alias("_base"))
    # the inside of these brackets holds a bounded number of values
    after = F.col("_base") + F.sum("_c").over(Window.partitionBy(*marks).orderBy("_v"))
    counts = counts.withColumn("_after", after)

    def pick(rank: Column) -> Column:
        return F.max(F.when((F.col("_after") - F.col("_c") <= rank) & (rank < F.col("_after")), v))

    picked = counts.groupBy(*marks).agg(_middle(pick(first), pick(last)).alias(name))
    return names.join(known.unionByName(picked), marks).select(*keys, name)


def _codes(keys: list[str], marks: list[str]) -> list[Column]:
    """Each key as a text that is never null and differs where the keys differ."""
    return [F.when(F.col(k).isNull(), F.lit("")).otherwise(F.concat(F.lit("="), F.col(k).cast("string"))).alias(m)
            for k, m in zip(keys, marks)]
