"""Best-fit packing by the linear grouping scheme.

Documents are tokenized, ended with id 0, and cut into pieces of at most
``limit`` tokens. The pieces' lengths are whole numbers up to ``limit``, so the
whole corpus is described by a histogram of at most ``limit`` entries, and only
it reaches the driver. There

1. the large lengths (over ``limit // SMALL_SHARE``) are cut into ``GROUPS`` groups of
   equal cardinality, each rounded up to its largest length;
2. for these few sizes the configurations of a sequence are optimised by column
   generation (the fractional cutting-stock programme, new configurations from
   a knapsack), and rounded down;
3. the groups' actual lengths take the configurations' slots, longest first,
   but for a configuration's smallest slot, whose pieces go back to the pool:
   rounding would leave a gap there that an exact fit closes;
4. what is left, large lengths first and then the small ones, is best-fitted:
   into the open sequence with the least room that suffices.

All steps work on runs of equal lengths and ranges of equal sequences, so the
plan has some thousand runs at any corpus size: "the pieces of length l from
the r-th on go, m a sequence, into the sequences from s on, at offset o". On
the cluster each piece gets its rank among the pieces of its length (a count
by task and length, then a running sum) and looks up its run.

Defined cases: a null text is empty, and an empty text is the single id 0;
repeated rows are packed each; an empty table gives an empty result; other
columns are ignored.
"""

from __future__ import annotations

import zlib
from bisect import bisect_left, insort
from collections import Counter, defaultdict

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from packlift.llm.bpe import encoder
from packlift.llm.common import give_back, slices, stored, text_of

LIMIT = 2048
GROUPS = 64
SMALL_SHARE = 3       # lengths up to limit / SMALL_SHARE are small
MAX_COLUMNS = 3000    # column generation steps

PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long, pid int, nth long"


# ---- the plan on the histogram ---------------------------------------------

def best_configuration(sizes: np.ndarray, worth: np.ndarray, limit: int) -> tuple[float, np.ndarray]:
    """The most valuable multiset of sizes within the limit (knapsack)."""
    best = np.zeros(limit + 1)
    took = np.full(limit + 1, -1)
    least = int(sizes.min())
    order = np.argsort(sizes, kind="stable")
    sizes_up, worth_up = sizes[order], worth[order]
    fits = np.searchsorted(sizes_up, np.arange(limit + 1), side="right")
    for room in range(least, limit + 1):
        n = fits[room]
        value = best[room - sizes_up[:n]] + worth_up[:n]
        k = int(value.argmax())
        if value[k] > best[room - 1]:
            best[room], took[room] = value[k], order[k]
        else:
            best[room] = best[room - 1]
    used = np.zeros(len(sizes), dtype=np.int64)
    room = limit
    while room >= least:
        if took[room] < 0 or best[room] == best[room - 1]:
            room -= 1
            continue
        used[took[room]] += 1
        room -= int(sizes[took[room]])
    return float(best[limit]), used


def configurations(sizes: np.ndarray, demand: np.ndarray, limit: int) -> list[tuple[np.ndarray, int]]:
    """(configuration, whole number of sequences) that cover at most the demand."""
    m = len(sizes)
    basis = np.diag(limit // sizes).astype(float)
    amount = demand / np.diag(basis)
    for _ in range(MAX_COLUMNS):
        worth = np.linalg.solve(basis.T, np.ones(m))
        value, column = best_configuration(sizes, np.maximum(worth, 0), limit)
        if value <= 1 + 1e-7:
            break
        step = np.linalg.solve(basis, column.astype(float))
        able = step > 1e-9
        if not able.any():
            break
        ratio = np.where(able, amount / np.where(able, step, 1), np.inf)
        out = int(ratio.argmin())
        basis[:, out] = column
        amount = np.maximum(np.linalg.solve(basis, demand.astype(float)), 0)
    return [(basis[:, j].astype(np.int64), int(amount[j] + 1e-9)) for j in range(m)]


class Plan:
    """Runs of pieces placed so far, and the open sequences by free room."""

    def __init__(self, histogram: dict[int, int], limit: int):
        self.limit = limit
        self.left = Counter({int(k): int(v) for k, v in histogram.items() if v})
        self.rank: dict[int, int] = defaultdict(int)
        self.runs: list[tuple[int, int, int, int, int, int]] = []
        self.sequences = 0
        self.open: dict[int, list[tuple[int, int]]] = defaultdict(list)
        self.rooms: list[int] = []

    def new(self, count: int) -> int:
        first = self.sequences
        self.sequences += count
        return first

    def place(self, length: int, count: int, sequence: int, per: int, offset: int) -> None:
        self.runs.append((length, self.rank[length], count, sequence, per, offset))
        self.rank[length] += count
        self.left[length] -= count

    def free(self, room: int, sequence: int, count: int) -> None:
        if room and count:
            if not self.open[room]:
                insort(self.rooms, room)
            self.open[room].append((sequence, count))

    def take(self, length: int) -> tuple[int, int, int] | None:
        at = bisect_left(self.rooms, length)
        if at == len(self.rooms):
            return None
        room = self.rooms[at]
        sequence, count = self.open[room].pop()
        if not self.open[room]:
            self.rooms.pop(at)
        return room, sequence, count

    def best_fit(self, length: int) -> None:
        """Place all that is left of a length: a best-fitting sequence, once
        chosen, stays the best fit until it has no room for another."""
        while (need := self.left[length]) > 0:
            room, sequence, count = self.take(length) or (self.limit, None, None)
            per = room // length
            if sequence is None:
                count = -(-need // per)
                sequence = self.new(count)
            full = min(count, need // per)
            if full:
                self.place(length, full * per, sequence, per, self.limit - room)
                self.free(room - per * length, sequence, full)
            elif count:
                self.place(length, need, sequence, need, self.limit - room)
                self.free(room - need * length, sequence, 1)
                full = 1
            self.free(room, sequence + full, count - full)


def _equal_groups(large: list[tuple[int, int]], groups: int) -> list[list[list[int]]]:
    """Runs [length, count], longest first, cut into groups of equal cardinality;
    neighbours that round to the same size become one group."""
    total = sum(c for _, c in large)
    each = -(-total // groups)
    out: list[list[list[int]]] = [[]]
    room = each
    for length, count in large:
        while count:
            if not room:
                out.append([])
                room = each
            n = min(room, count)
            out[-1].append([length, n])
            count -= n
            room -= n
    merged: list[list[list[int]]] = []
    for group in out:
        if merged and merged[-1][0][0] == group[0][0]:
            merged[-1] += group
        else:
            merged.append(group)
    return merged


def plan_runs(histogram: dict[int, int], limit: int = LIMIT, groups: int = GROUPS) -> tuple[list[tuple], int]:
    """The runs (length, first rank, count, first sequence, pieces a sequence,
    offset) and the number of sequences."""
    plan = Plan(histogram, limit)
    small = limit // SMALL_SHARE
    large = sorted(((l, c) for l, c in plan.left.items() if small < l < limit), reverse=True)
    if large:
        grouped = _equal_groups(large, groups)
        sizes = np.array([g[0][0] for g in grouped])
        demand = np.array([sum(c for _, c in g) for g in grouped])
        for used, count in configurations(sizes, demand, limit):
            if count:
                _substitute(plan, grouped, used, count)
    for length in sorted(plan.left, reverse=True):
        plan.best_fit(length)
    return plan.runs, plan.sequences


def _substitute(plan: Plan, grouped: list[list[list[int]]], used: np.ndarray, count: int) -> None:
    """Fill ``count`` new sequences of one configuration with actual lengths."""
    used = used.copy()
    if used.sum() > 1:
        used[np.flatnonzero(used)[-1]] -= 1
    ranges = [(plan.new(count), count, 0)]     # (first sequence, how many, used so far)
    for g in np.flatnonzero(used):
        for _ in range(int(used[g])):
            following = []
            for sequence, n, offset in ranges:
                while n:
                    if not grouped[g]:
                        following.append((sequence, n, offset))
                        break
                    run = grouped[g][0]
                    k = min(n, run[1])
                    plan.place(run[0], k, sequence, 1, offset)
                    following.append((sequence, k, offset + run[0]))
                    run[1] -= k
                    if not run[1]:
                        grouped[g].pop(0)
                    sequence, n = sequence + k, n - k
            ranges = following
    for sequence, n, offset in ranges:
        plan.free(plan.limit - offset, sequence, n)


# ---- on the cluster -----------------------------------------------------------

def piece_rows(docs: DataFrame, tokenizer_json: str, limit: int = LIMIT) -> DataFrame:
    """The pieces of every row of ``docs``: PIECES, where (pid, nth) numbers the
    pieces of one length within a task."""
    def pieces(batches):
        encode = encoder(tokenizer_json)
        pid = TaskContext.get().partitionId()
        seen: Counter = Counter()
        for batch in batches:
            ids = iter(batch.column(0).to_pylist())
            for part in slices(batch.column(1).to_pylist()):
                out = []
                for data, doc_id in zip(encode(part), ids):
                    data += b"\0\0\0\0"
                    n = len(data) // 4
                    for k, start in enumerate(range(0, n, limit)):
                        length = min(limit, n - start)
                        crc = zlib.crc32(data[4 * start:4 * (start + length)])
                        out.append((doc_id, k, start, length, crc, pid, seen[length]))
                        seen[length] += 1
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, t) for c, t in zip(zip(*out), _PIECE_TYPES)],
                    names=["doc_id", "piece", "start", "length", "ids_crc32", "pid", "nth"])
        encode = batch = ids = part = out = data = None
        give_back()

    return docs.select(F.col("doc_id").cast("long"), text_of().alias("text")).mapInArrow(pieces, PIECES)


_PIECE_TYPES = [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.int64()]


def _placer(runs: list[tuple]):
    table = np.array(sorted((r[0] << 44 | r[1], *r[2:]) for r in runs) or [(0, 0, 0, 1, 0)], dtype=np.int64)
    keys, _, sequence, per, offset = table.T

    @F.pandas_udf("sequence_id long, offset long")
    def place(length: pd.Series, rank: pd.Series) -> pd.DataFrame:
        length, rank = length.to_numpy(), rank.to_numpy()
        key = length << 44 | rank
        at = np.searchsorted(keys, key, side="right") - 1
        nth = key - keys[at]
        return pd.DataFrame({"sequence_id": sequence[at] + nth // per[at],
                             "offset": offset[at] + nth % per[at] * length})

    return place


def pack(docs: DataFrame, tokenizer_json: str, limit: int = LIMIT, groups: int = GROUPS) -> DataFrame:
    """One row per piece with its place: see the module's docstring."""
    pieces = stored(piece_rows(docs, tokenizer_json, limit), "packing-pieces")
    counts = stored(pieces.groupBy("pid", "length").agg(F.count(F.lit(1)).alias("n")), "packing-counts")
    histogram = {r["length"]: r["n"] for r in counts.groupBy("length").agg(F.sum("n").alias("n")).collect()}
    runs, _ = plan_runs(histogram, limit, groups)
    earlier = Window.partitionBy("length").orderBy("pid").rowsBetween(Window.unboundedPreceding, -1)
    before = counts.select("pid", "length", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("before"))
    place = _placer(runs)
    return (pieces.join(before, ["pid", "length"])
            .withColumn("p", place(F.col("length"), F.col("before") + F.col("nth")))
            .select("doc_id", "piece", "start", "length", "ids_crc32", "p.sequence_id", "p.offset"))
