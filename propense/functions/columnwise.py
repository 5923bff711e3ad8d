"""Exact facts of many numeric columns from a few passes over the rows, without taking cells apart.

Every task sums up each column of its rows in arrays: moments, counts by slot, the candidates for the most
frequent value. Only those sums are shuffled. Values are ordered by a whole number, the bits of the
double; a slot is a range of it, and a range that holds a wanted rank is cut into thousands of parts by the next
pass, so that four more passes at most find a value whatever the distribution, and mostly one does.
"""

from __future__ import annotations

import sys
from collections.abc import Callable, Iterator, Mapping, Sequence
from dataclasses import dataclass, field
from functools import reduce
from multiprocessing.pool import ThreadPool

import numpy as np
import pyarrow as pa
from pyspark import StorageLevel, cloudpickle, inheritable_thread_target
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from propense.functions.columns import ident
from propense.functions.order import small_table

# The helpers below travel to the tasks with the job, so workers need no copy of this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

#: Parts a range is cut into by a pass, as a power of two; up to MORE_BITS while few rows are left in it.
SLOT_BITS, MORE_BITS = 13, 16
#: Slots of all ranges that a task holds at once, beyond SLOT_BITS for each.
SLOTS_HELD = 1 << 21
#: Leading bits of the key that are the slots of the first pass: sign, exponent and the first digits.
HEAD_BITS = 16
#: Values of a column that a task keeps as candidates for its mode.
CANDIDATES = 256
#: Which rows a statistic is over: all values, or the non-zero ones.
ALL, NON_ZERO = 0, 1
# What a row of the first pass is about, besides ALL and NON_ZERO.
_ZEROS, _NEGATIVES, _SLOT, _CANDIDATE, _ERROR = 2, 3, 4, 5, 6


def keys_of(values: np.ndarray) -> np.ndarray:
    """Whole numbers in the order of the values; -0.0 and 0.0 are one."""
    bits = (values + 0.0).view(np.int64)
    return bits ^ ((bits >> 63) & np.int64(0x7FFFFFFFFFFFFFFF))


def value_of(key: int) -> float:
    key = np.int64(key)
    return float((key ^ ((key >> np.int64(63)) & np.int64(0x7FFFFFFFFFFFFFFF))).view(np.float64))


def _cells(batch: pa.RecordBatch, i: int) -> np.ndarray:
    values = batch.column(i).to_numpy(zero_copy_only=False)
    return values[~np.isnan(values)]


class _Moments:
    """Count, ends, mean and sums of powers around it, of the batches so far."""

    def __init__(self) -> None:
        self.n, self.lo, self.hi = 0, float("inf"), float("-inf")
        self.mean = self.m2 = self.m3 = self.m4 = 0.0

    def add(self, v: np.ndarray) -> None:
        if not len(v):
            return
        self.lo, self.hi = min(self.lo, float(v.min())), max(self.hi, float(v.max()))
        with np.errstate(all="ignore"):
            mean = float(v.mean())
            d = v - mean
            square = d * d
            self._merge(len(v), mean, float(square.sum()), float((square * d).sum()), float((square * square).sum()))

    def _merge(self, n: int, mean: float, m2: float, m3: float, m4: float) -> None:
        both = self.n + n
        center = self.mean + (mean - self.mean) * (n / both)
        a, b = self.mean - center, mean - center
        aa, bb = a * a, b * b
        # products, as powers of Python numbers raise where they leave the range of doubles
        self.m4 += self.n * (aa * aa) + 4 * a * self.m3 + 6 * aa * self.m2 + m4 + 4 * b * m3 + 6 * bb * m2 + n * (bb * bb)
        self.m3 += self.n * (aa * a) + 3 * a * self.m2 + m3 + 3 * b * m2 + n * (bb * b)
        self.m2 += self.n * aa + m2 + n * bb
        self.n, self.mean = both, center


class _Frequent:
    """Candidates for the most frequent value: a count is short of the true one by ``error`` at most."""

    def __init__(self, most: int) -> None:
        self.most, self.error = most, 0
        self.keys, self.counts = np.zeros(0, np.int64), np.zeros(0, np.int64)

    def add(self, keys: np.ndarray) -> None:
        found, counts = np.unique(keys, return_counts=True)
        if len(self.keys):
            both = np.concatenate([self.keys, found])
            found, place = np.unique(both, return_inverse=True)
            counts = np.bincount(place, np.concatenate([self.counts, counts])).astype(np.int64)
        if len(found) > self.most:
            # what the first value beyond the candidates has is taken from all
            beyond = len(counts) - self.most - 1
            less = int(np.partition(counts, beyond)[beyond])
            counts = counts - less
            self.error += less
            found, counts = found[counts > 0], counts[counts > 0]
        self.keys, self.counts = found, counts


_FIRST = "field int, kind int, key long, n long, lo double, hi double, mean double, m2 double, m3 double, m4 double"


def _first_pass(df: DataFrame, n_columns: int) -> DataFrame:
    head, most = HEAD_BITS, CANDIDATES

    def sum_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        moments = [(_Moments(), _Moments()) for _ in range(n_columns)]
        zeros, negatives = [0] * n_columns, [0] * n_columns
        slots = [np.zeros(1 << head, np.int64) for _ in range(n_columns)]
        frequent = [_Frequent(most) for _ in range(n_columns)]
        for batch in batches:
            for i in range(n_columns):
                v = _cells(batch, i)
                if not len(v):
                    continue
                there = v != 0
                moments[i][ALL].add(v)
                moments[i][NON_ZERO].add(v if there.all() else v[there])
                zeros[i] += int(len(v) - there.sum())
                negatives[i] += int((v < 0).sum())
                keys = keys_of(v)
                slots[i] += np.bincount((keys >> (64 - head)) + (1 << (head - 1)), minlength=1 << head)
                frequent[i].add(keys)
        none = [None] * 6
        rows = []
        for i in range(n_columns):
            for kind, m in enumerate(moments[i]):
                if m.n:
                    rows.append((i, kind, 0, m.n, m.lo, m.hi, m.mean, m.m2, m.m3, m.m4))
            rows += [(i, _ZEROS, 0, zeros[i], *none), (i, _NEGATIVES, 0, negatives[i], *none), (i, _ERROR, 0, frequent[i].error, *none)]
            rows += [(i, _SLOT, int(s) - (1 << (head - 1)), int(slots[i][s]), *none) for s in np.flatnonzero(slots[i])]
            rows += [(i, _CANDIDATE, k, n, *none) for k, n in zip(frequent[i].keys.tolist(), frequent[i].counts.tolist())]
        kinds = [pa.int32(), pa.int32(), pa.int64(), pa.int64(), *[pa.float64()] * 6]
        arrays = [pa.array(c, kind) for c, kind in zip(zip(*rows), kinds)]
        yield pa.RecordBatch.from_arrays(arrays, names=[c.split()[0] for c in _FIRST.split(", ")])

    return df.mapInArrow(sum_up, _FIRST)


def _moments(first: DataFrame) -> DataFrame:
    """Sums of all tasks' moments, moved from the tasks' means to the common one."""
    within = Window.partitionBy("field", "kind")
    n, d = F.col("n").cast("double"), F.col("mean") - F.col("center")
    center = F.sum(F.col("n") * F.col("mean")).over(within) / F.sum("n").over(within)
    return (
        first.where(F.col("kind").isin(ALL, NON_ZERO))
        .withColumn("center", center)
        .groupBy("field", "kind")
        .agg(
            F.lit(0).cast("long").alias("key"),
            F.sum("n").alias("n"),
            F.min("lo").alias("lo"),
            F.max("hi").alias("hi"),
            F.first("center").alias("mean"),
            F.sum(F.col("m2") + n * d * d).alias("m2"),
            F.sum(F.col("m3") + 3 * d * F.col("m2") + n * d * d * d).alias("m3"),
            F.sum(F.col("m4") + 4 * d * F.col("m3") + 6 * d * d * F.col("m2") + n * d * d * d * d).alias("m4"),
        )
    )


def _others(first: DataFrame) -> DataFrame:
    """Counts of zeros and negatives, errors, and per column the candidates with the largest counts."""
    counts = first.where(F.col("kind").isin(_ZEROS, _NEGATIVES, _ERROR)).groupBy("field", "kind", "key")
    candidates = first.where(F.col("kind") == _CANDIDATE).groupBy("field", "kind", "key").agg(F.sum("n").alias("n"))
    # each task keeps its own best before they meet
    place = F.row_number().over(Window.partitionBy("field").orderBy(F.desc("n"), "key"))
    best = candidates.withColumn("place", place).where(F.col("place") <= CANDIDATES + 1).drop("place")
    return counts.agg(F.sum("n").alias("n")).unionByName(best)


@dataclass
class Column:
    """What is known of a column. ``modes`` and ``at`` (rank -> value) are filled by the later passes."""

    moments: dict[int, dict] = field(default_factory=dict)
    zeros: int = 0
    negatives: int = 0
    error: int = 0
    candidates: dict[int, int] = field(default_factory=dict)
    modes: dict[int, float] = field(default_factory=dict)
    at: dict[int, float] = field(default_factory=dict)

    def n(self, over: int) -> int:
        return self.moments[over]["n"] if over in self.moments else 0


@dataclass(frozen=True)
class _Piece:
    """A range of keys of a column that holds wanted ranks; ``base`` values lie below it."""

    field: int
    lo: int
    hi: int
    base: int
    ranks: tuple[int, ...]
    rows: int = 0


_LATER = "kind int, id int, key long, n long, lo long, hi long"


def _later_pass(df: DataFrame, pieces: Sequence[_Piece], candidates: Mapping[int, list[int]]) -> DataFrame:
    """Counts by slot of every piece (kind 0), and of every candidate (kind 1), as rows of each task.

    A slot with one value alone has it at both its ends.
    """
    wanted = {i: np.array(sorted(keys), np.int64) for i, keys in candidates.items()}
    by_field: dict[int, list[int]] = {}
    for k, p in enumerate(pieces):
        by_field.setdefault(p.field, []).append(k)
    columns = sorted({*by_field, *wanted})
    names = df.columns
    held = (SLOTS_HELD // max(len(pieces), 1)).bit_length() - 1
    bits = [max(SLOT_BITS, min(MORE_BITS, held, p.rows.bit_length() + 1)) if p.rows < 1 << 20 else SLOT_BITS for p in pieces]
    sizes = [1 << b for b in bits]
    shifts = [max((p.hi - p.lo).bit_length() - b, 0) for p, b in zip(pieces, bits)]

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        slots = [np.zeros(size, np.int64) for size in sizes]
        sample = [np.zeros(size, np.int64) for size in sizes]
        mixed = [np.zeros(size, bool) for size in sizes]
        recount = {i: np.zeros(len(keys), np.int64) for i, keys in wanted.items()}
        for batch in batches:
            for place, i in enumerate(columns):
                keys = keys_of(_cells(batch, place))
                if i in wanted:
                    spot = np.minimum(np.searchsorted(wanted[i], keys), len(wanted[i]) - 1)
                    recount[i] += np.bincount(spot[wanted[i][spot] == keys], minlength=len(wanted[i]))
                for k in by_field.get(i, ()):
                    p = pieces[k]
                    inside = keys[(keys >= p.lo) & (keys <= p.hi)]
                    if not len(inside):
                        continue
                    slot = (inside - p.lo) >> shifts[k]
                    new = np.bincount(slot, minlength=sizes[k])
                    fresh = slots[k] == 0
                    first = fresh[slot]
                    sample[k][slot[first]] = inside[first]
                    mixed[k][slot[sample[k][slot] != inside]] = True
                    slots[k] += new
        rows = []
        for k, p in enumerate(pieces):
            for s in np.flatnonzero(slots[k]).tolist():
                lo = p.lo + (s << shifts[k])
                ends = (lo, min(lo + (1 << shifts[k]) - 1, p.hi)) if mixed[k][s] else (int(sample[k][s]),) * 2
                rows.append((0, k, s, int(slots[k][s]), *ends))
        for i, numbers in recount.items():
            rows += [(1, i, int(key), int(n), None, None) for key, n in zip(wanted[i], numbers) if n]
        if rows:
            kinds = [pa.int32(), pa.int32(), *[pa.int64()] * 4]
            arrays = [pa.array(c, kind) for c, kind in zip(zip(*rows), kinds)]
            yield pa.RecordBatch.from_arrays(arrays, names=[c.split()[0] for c in _LATER.split(", ")])

    return df.select(*[ident(names[i]) for i in columns]).mapInArrow(count, _LATER)


def _hits(counts: DataFrame, pieces: Sequence[_Piece]) -> DataFrame:
    """The slots that hold a wanted rank: (id, key, n, lo, hi, start). A piece's slots are summed."""
    end = F.sum("n").over(Window.partitionBy("id").orderBy("key"))
    targets = small_table(
        counts.sparkSession,
        "id int, place bigint",
        sorted({(k, r - p.base) for k, p in enumerate(pieces) for r in p.ranks}),
    )
    return (
        counts.withColumn("start", end - F.col("n"))
        # a dozen targets per column at most
        .join(F.broadcast(targets), "id")
        .where((F.col("place") >= F.col("start")) & (F.col("place") < F.col("start") + F.col("n")))
        .select("id", "key", "n", "lo", "hi", "start")
        .distinct()
    )


def _narrowed(pieces: Sequence[_Piece], hits: Sequence) -> list[_Piece]:
    out = []
    for h in hits:
        p = pieces[h["id"]]
        base = p.base + h["start"]
        ranks = tuple(r for r in p.ranks if base <= r < base + h["n"])
        out.append(_Piece(p.field, h["lo"], h["hi"], base, ranks, h["n"]))
    return out


def _best(counts: Mapping[int, int], over: int) -> tuple[int, float] | None:
    """(count, value): the smallest of the most frequent values."""
    rest = {k: n for k, n in counts.items() if over == ALL or value_of(k) != 0}
    if not rest:
        return None
    most = max(rest.values())
    return most, value_of(min(k for k, n in rest.items() if n == most))


def _all_known(column: Column) -> bool:
    """The candidates are all values of the column, and their counts are exact."""
    return column.error == 0 and len(column.candidates) <= CANDIDATES


def _settled(column: Column, ranks: Sequence[int]) -> None:
    """Modes and ranks of a column of few distinct values, which the first pass has counted one by one."""
    for over in (ALL, NON_ZERO):
        best = _best(column.candidates, over)
        if best is not None:
            column.modes[over] = best[1]
    values = sorted(column.candidates)
    ends = np.cumsum([column.candidates[k] for k in values])
    for r in ranks:
        column.at[r] = value_of(values[int(np.searchsorted(ends, r, side="right"))])


def _provable(column: Column) -> bool:
    """A candidate is certainly more frequent than any value that is none.

    Such a value has at most what the first one beyond the candidates has, and what was taken from all;
    a candidate has at least its count.
    """
    known = sorted(column.candidates.values(), reverse=True)
    bound = column.error + (known[CANDIDATES] if len(known) > CANDIDATES else 0)
    best = [_best(column.candidates, over) for over in (ALL, NON_ZERO) if column.n(over)]
    return all(b is not None and b[0] > bound for b in best)


def _full_modes(df: DataFrame, name: str) -> dict[int, float]:
    """The smallest of the most frequent values of a column, by counting all of them."""
    # adding zero makes -0.0 and 0.0 one value
    value = (ident(name) + 0.0).alias("value")
    counts = df.select(value).where(F.col("value").isNotNull() & ~F.isnan("value"))
    counts = counts.groupBy("value").agg(F.count(F.lit(1)).alias("n"))
    best = F.struct(F.col("n"), (-F.col("value")).alias("falling"))
    row = counts.agg(F.max(best).alias("a"), F.max(F.when(F.col("value") != 0, best)).alias("b")).first()
    return {over: -row[c]["falling"] + 0.0 for over, c in ((ALL, "a"), (NON_ZERO, "b")) if row[c] is not None}


def summarise(df: DataFrame, wanted: Callable[[Column], Sequence[int]]) -> list[Column]:
    """Facts of all columns of ``df``, which are doubles; NULL and NaN are left out.

    ``wanted`` gives the 0-based ranks to look up, from what the first pass found of a column. A column of few
    distinct values is done with that pass. The modes of others are exact as well: where the candidates of
    all tasks prove that no other value is as frequent, they are counted anew, and else (a column of nearly
    distinct values) all values of the column are, beside the passes that look up the ranks.
    """
    n = len(df.columns)
    columns = [Column() for _ in range(n)]
    first = _first_pass(df, n).persist(StorageLevel.MEMORY_AND_DISK)
    try:
        for r in _moments(first).unionByName(_others(first), allowMissingColumns=True).collect():
            c = columns[r["field"]]
            if r["kind"] in (ALL, NON_ZERO):
                c.moments[r["kind"]] = r.asDict()
            elif r["kind"] == _CANDIDATE:
                c.candidates[r["key"]] = r["n"]
            else:
                setattr(c, {_ZEROS: "zeros", _NEGATIVES: "negatives", _ERROR: "error"}[r["kind"]], r["n"])
        pieces, candidates, crowded = [], {}, []
        for i, c in enumerate(columns):
            ranks = tuple(sorted(set(wanted(c))))
            if not c.n(ALL):
                continue
            if _all_known(c):
                _settled(c, ranks)
                continue
            if ranks:
                # the whole range, of which the first pass has counted the slots
                pieces.append(_Piece(i, 0, 0, 0, ranks))
            if _provable(c):
                candidates[i] = sorted(c.candidates, key=lambda k, c=c: (-c.candidates[k], k))[:CANDIDATES]
            else:
                crowded.append(i)
        if pieces:
            pieces = _narrowed(pieces, _hits(_first_slots(first, pieces), pieces).collect())
    finally:
        first.unpersist()
    with ThreadPool(8) as pool:
        full = inheritable_thread_target(df.sparkSession)(lambda i: _full_modes(df, df.columns[i]))
        counted = pool.map_async(full, crowded, chunksize=1)
        _look_up(df, columns, pieces, candidates)
        for i, modes in zip(crowded, counted.get()):
            columns[i].modes |= modes
    return columns


def _first_slots(first: DataFrame, pieces: Sequence[_Piece]) -> DataFrame:
    """The slots of the first pass, as counts of pieces that are whole columns."""
    ids = F.create_map(*[F.lit(x) for k, p in enumerate(pieces) for x in (p.field, k)])[F.col("field")]
    slots = first.where(F.col("kind") == _SLOT).groupBy("field", "key").agg(F.sum("n").alias("n"))
    width = 64 - HEAD_BITS
    lo = F.shiftleft("key", width)
    return slots.select(ids.alias("id"), "key", "n", lo.alias("lo"), (lo + ((1 << width) - 1)).alias("hi")).where("id IS NOT NULL")


def _look_up(df: DataFrame, columns: list[Column], pieces: list[_Piece], candidates: dict[int, list[int]]) -> None:
    """Narrow the pieces to single values, pass by pass; the first pass counts the candidates as well."""
    while pieces or candidates:
        counts = _later_pass(df, pieces, candidates).groupBy("kind", "id", "key")
        counts = counts.agg(F.sum("n").alias("n"), F.min("lo").alias("lo"), F.max("hi").alias("hi"))
        parts = []
        if candidates:
            parts.append(counts.where("kind = 1").select("id", "key", "n", "lo", "hi", F.lit(-1).cast("long").alias("start")))
        if pieces:
            parts.append(_hits(counts.where("kind = 0").drop("kind"), pieces))
        found: dict[int, dict[int, int]] = {}
        hits = []
        # a few hundred candidates and a dozen slots per column
        for r in reduce(DataFrame.unionByName, parts).collect():
            if r["start"] < 0:
                found.setdefault(r["id"], {})[r["key"]] = r["n"]
            else:
                hits.append(r)
        for i, exact in found.items():
            for over in (ALL, NON_ZERO):
                best = _best(exact, over)
                if best is not None:
                    columns[i].modes[over] = best[1]
        candidates = {}
        pieces = _narrowed(pieces, hits)
        for p in pieces:
            if p.lo == p.hi:
                columns[p.field].at.update(dict.fromkeys(p.ranks, value_of(p.lo)))
        pieces = [p for p in pieces if p.lo != p.hi]
