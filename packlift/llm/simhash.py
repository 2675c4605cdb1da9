"""SimHash near-duplicates with bit-sliced comparison.

**Fingerprint.** A text's words (lower-cased A-Z, split at ASCII blanks) form
shingles of ``shingle`` words; each fingerprint bit is set if it is set in more
than half of the shingles' XXH64 values (seed 42). A text of fewer words has
one shingle, its whole word sequence; a text of none has fingerprint zero.

**Candidates.** Only distinct fingerprints are compared. Two that differ in at
most ``radius`` = 2 bits agree on one of three blocks of bits, and on one of
three blocks of the rest: the nine keys that a fingerprint is filed under hold
every link. Copies never meet, and a key's fingerprints agree on 35 bits or
more. Keys with more than ``SPLIT`` fingerprints are split by blocks of their
remaining bits the same way, so no key holds more than 2**20 fingerprints.

**Comparison.** Under a key the fingerprints lie as bit planes, 64 to a machine
word. A fingerprint is compared with 64 others at a time: each plane's
differences go into a two-bit carry-save counter per lane, and a word whose
lanes have all left the radius is abandoned. Of a key's links only a spanning
forest leaves the task, at most one link for each fingerprint.

**Components** of the fingerprints come from ``components``; a document's
``component_id`` is the smallest doc_id of its fingerprint's component.

Defined cases: a null text is empty, and all empty texts are linked; repeated
rows are copies; a null doc_id is never the smallest unless a component has no
other, then component_id is null; an empty table gives an empty result; other
columns are ignored.
"""

from __future__ import annotations

from itertools import accumulate

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from xxhash import xxh64_intdigest

from packlift.llm.common import fresh, rows_udf, stored, text_of
from packlift.llm.components import components

SEED = 42
SHINGLE = 3
RADIUS = 2          # fixed by the counter's two bits
SPLIT = 4096        # fingerprints under a key before it is split further
LANES = 64
_U = np.uint64
_ONES = _U(0xFFFFFFFFFFFFFFFF)


def fingerprint(text: str, shingle: int = SHINGLE) -> int:
    # bytes.split and bytes.lower know ASCII only: blanks 9-13 and 32, letters A-Z.
    words = text.encode("utf-8", "surrogatepass").lower().split()
    n = len(words)
    if n == 0:
        return 0
    joined = b" ".join(words)
    if n <= shingle:
        return xxh64_intdigest(joined, SEED)
    ends = list(accumulate(len(w) + 1 for w in words))
    starts = [0, *ends[:n - shingle]]
    hashes = np.fromiter((xxh64_intdigest(joined[a:b - 1], SEED) for a, b in zip(starts, ends[shingle - 1:])),
                         dtype=np.uint64, count=n - shingle + 1)
    ones = np.zeros(64, dtype=np.int64)
    for lo in range(0, len(hashes), 1 << 16):
        part = hashes[lo:lo + (1 << 16)]
        ones += np.unpackbits(part.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * ones > len(hashes), bitorder="little").view(np.uint64)[0])


def _signed(value: int) -> int:
    return value - (1 << 64) if value >> 63 else value


def fingerprint_udf(shingle: int = SHINGLE):
    return rows_udf(lambda: lambda texts: [(_signed(fingerprint(t, shingle)),) for t in texts], "fp long")


def _cut(bits: list[int], parts: int) -> list[list[int]]:
    """``bits`` in ``parts`` consecutive blocks of nearly equal size."""
    at = [len(bits) * i // parts for i in range(parts + 1)]
    return [bits[a:b] for a, b in zip(at, at[1:])]


def _mask(bits: list[int]) -> int:
    return sum(1 << b for b in bits)


def key_masks(levels: int = 2) -> list[int]:
    """Bit masks such that two values at distance <= RADIUS agree under one."""
    found = [[]]
    for _ in range(levels):
        found = [fixed + block for fixed in found
                 for block in _cut([b for b in range(64) if b not in set(fixed)], RADIUS + 1)]
    return [_mask(bits) for bits in found]


# ---- comparison inside a task -------------------------------------------------

def _planes(values: np.ndarray) -> np.ndarray:
    """(64, words) bit planes of values whose length is a multiple of LANES."""
    words = len(values) // LANES
    out = np.empty((64, words), dtype=np.uint64)
    for lo in range(0, words, 2048):
        part = values[lo * LANES:(lo + 2048) * LANES].reshape(-1, LANES)
        bits = np.unpackbits(part.view(np.uint8).reshape(len(part), LANES, 8), axis=2, bitorder="little")
        packed = np.packbits(bits.transpose(2, 0, 1), axis=2, bitorder="little")
        out[:, lo:lo + len(part)] = np.ascontiguousarray(packed).view(np.uint64)[:, :, 0]
    return out


def _near(planes: np.ndarray, queries: np.ndarray, word: np.ndarray) -> np.ndarray:
    """For each pair (query value, word of lanes) the lanes within RADIUS."""
    result = np.zeros(len(queries), dtype=np.uint64)
    alive = np.arange(len(queries))
    q, at = queries, word
    one = np.zeros(len(q), dtype=np.uint64)     # counter's low bits
    two = np.zeros(len(q), dtype=np.uint64)     # its high bits
    out = np.zeros(len(q), dtype=np.uint64)     # lanes beyond the radius
    for bit in range(64):
        differ = planes[bit][at] ^ (_U(0) - (q >> _U(bit) & _U(1)))
        carry = one & differ
        one ^= differ
        out |= two & carry
        two |= carry
        out |= one & two                         # a count of three
        if bit % 8 == 7:
            live = out != _ONES
            if not live.all():
                alive, q, at, one, two, out = (x[live] for x in (alive, q, at, one, two, out))
    result[alive] = ~out
    return result


def _links_small(values: np.ndarray, run: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Spanning links of runs of at most LANES values, each run in one word."""
    runs, first = np.unique(run, return_index=True)
    place = np.arange(len(run)) - np.repeat(first, np.diff([*first, len(run)]))
    of = np.repeat(np.arange(len(runs)), np.diff([*first, len(run)]))
    grid = np.zeros(len(runs) * LANES, dtype=np.uint64)
    grid[of * LANES + place] = values
    size = np.bincount(of, minlength=len(runs)).astype(np.uint64)
    valid = np.where(size == LANES, _ONES, (_U(1) << (size & _U(63))) - _U(1))
    near = _near(_planes(grid), values, of) & valid[of]
    # Transitive closure inside each word, lane by lane.
    for lane in range(int(size.max(initial=0))):
        source = np.zeros(len(runs), dtype=np.uint64)
        here = place == lane
        source[of[here]] = near[here]
        near |= np.where(near >> _U(lane) & _U(1), source[of], _U(0))
    lowest = np.bitwise_count((near & (~near + _U(1))) - _U(1)).astype(np.int64)
    root = grid[of * LANES + lowest]
    linked = root != values
    return values[linked], root[linked]


def _links_large(values: np.ndarray) -> tuple[list, list]:
    """Spanning links of one run of distinct values, by breadth-first search
    that compares each value once with the lanes not reached yet."""
    n = len(values)
    words = -(-n // LANES)
    padded = np.zeros(words * LANES, dtype=np.uint64)
    padded[:n] = values
    planes = _planes(padded)
    open_lanes = np.full(words, _ONES)
    if n % LANES:
        open_lanes[-1] = (_U(1) << _U(n % LANES)) - _U(1)
    a, b = [], []
    for seed in range(n):
        if not open_lanes[seed // LANES] >> _U(seed % LANES) & _U(1):
            continue
        frontier = [seed]
        open_lanes[seed // LANES] &= ~(_U(1) << _U(seed % LANES))
        while frontier:
            node = frontier.pop()
            at = np.flatnonzero(open_lanes)
            if not len(at):
                break
            near = _near(planes, np.full(len(at), values[node]), at) & open_lanes[at]
            hit = np.flatnonzero(near)
            for w, lanes in zip(at[hit].tolist(), near[hit].tolist()):
                while lanes:
                    lane = (lanes & -lanes).bit_length() - 1
                    lanes &= lanes - 1
                    found = w * LANES + lane
                    frontier.append(found)
                    a.append(values[found])
                    b.append(values[seed])
            open_lanes[at] &= ~near
    return a, b


def run_links(key: np.ndarray, values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Spanning links of every run of equal ``key`` (sorted by key)."""
    change = np.flatnonzero(np.concatenate([[True], (key[1:] != key[:-1]).any(axis=1)]))
    size = np.diff([*change, len(key)])
    run = np.repeat(np.arange(len(change)), size)
    of = size[run]
    small = (of > 1) & (of <= LANES)
    a, b = _links_small(values[small], run[small])
    a, b = [a], [b]
    for r in np.flatnonzero(size > LANES):
        x, y = _links_large(values[change[r]:change[r] + size[r]])
        a.append(np.array(x, dtype=np.uint64))
        b.append(np.array(y, dtype=np.uint64))
    return np.concatenate(a), np.concatenate(b)


CHUNK = 1 << 17


def _task_links(batches):
    """Sorted (mask, key, fp) rows to links; a run is kept together."""
    def emit(rows: pa.Table):
        key = np.stack([rows["mask"].to_numpy(), rows["key"].to_numpy()], axis=1)
        a, b = run_links(key, rows["fp"].to_numpy().view(np.uint64))
        return pa.RecordBatch.from_pydict({"a": a.view(np.int64), "b": b.view(np.int64)})

    held: list[pa.Table] = []
    count = 0
    for batch in batches:
        held.append(pa.Table.from_batches([batch]))
        count += batch.num_rows
        if count < CHUNK:
            continue
        rows = pa.concat_tables(held).combine_chunks()
        mask, key = rows["mask"].to_numpy(), rows["key"].to_numpy()
        other = np.flatnonzero((mask != mask[-1]) | (key != key[-1]))
        cut = int(other[-1]) + 1 if len(other) else 0
        if cut:
            yield emit(rows.slice(0, cut))
        held = [rows.slice(cut)]
        count = rows.num_rows - cut
    if count:
        yield emit(pa.concat_tables(held).combine_chunks())


def _filed(fps: DataFrame, masks: list[int]) -> DataFrame:
    return (fps.select("fp", F.explode(F.array(*[F.lit(_signed(m)) for m in masks])).alias("mask"))
            .select("fp", "mask", F.col("fp").bitwiseAND(F.col("mask")).alias("key")))


def fingerprint_links(fps: DataFrame, split: int = SPLIT) -> DataFrame:
    """Links (a, b) that span the near fingerprints of ``fps`` (distinct fp)."""
    coarse = key_masks(2)
    finer: dict[int, list[int]] = {}
    for m in coarse:
        fixed = [b for b in range(64) if m >> b & 1]
        finer[_signed(m)] = [_signed(m | _mask(block)) for block in
                             _cut([b for b in range(64) if b not in set(fixed)], RADIUS + 1)]
    filed = _filed(fps, coarse)
    crowded = stored(filed.groupBy("mask", "key").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > split)
                     .select(F.col("mask").alias("c_mask"), F.col("key").alias("c_key")), "simhash-crowded")
    table = F.create_map(*[x for m, fine in finer.items()
                           for x in (F.lit(m), F.array(*[F.lit(f) for f in fine]))])
    keyed = (filed.join(crowded, (F.col("mask") == F.col("c_mask")) & (F.col("key") == F.col("c_key")), "left")
             .select("fp", F.explode(F.when(F.col("c_mask").isNull(), F.array("mask"))
                                     .otherwise(table[F.col("mask")])).alias("mask"))
             .select(F.col("mask"), F.col("fp").bitwiseAND(F.col("mask")).alias("key"), "fp"))
    return (keyed.repartition("mask", "key").sortWithinPartitions("mask", "key")
            .mapInArrow(_task_links, "a long, b long").distinct())


def grouped(rows: DataFrame, split: int = SPLIT) -> DataFrame:
    """``rows`` (doc_id, fp, ...) with ``component_id`` and ``root``, the component's least
    fingerprint: ids may repeat, so only the root tells components apart."""
    fps = stored(rows.groupBy("fp").agg(F.min("doc_id").alias("least")), "simhash-fps")
    roots = components(fingerprint_links(fps.select("fp"), split))
    of = fps.join(roots, fps["fp"] == roots["node"], "left").select(
        fps["fp"].alias("f"), "least", F.coalesce("root", fps["fp"]).alias("r"))
    smallest = of.groupBy(F.col("r").alias("r2")).agg(F.min("least").alias("component_id"))
    named = stored(of.join(smallest, F.col("r") == F.col("r2")).select("f", F.col("r").alias("root"), "component_id"), "simhash-named")
    return rows.join(named, rows["fp"] == named["f"], "left").drop("f")


def simhash(docs: DataFrame, shingle: int = SHINGLE) -> DataFrame:
    """``doc_id, fingerprint, component_id`` for every row of ``docs``."""
    rows = stored(docs.select("doc_id", fingerprint_udf(shingle)(text_of())["fp"].alias("fp")), "simhash-docs")
    return grouped(rows).select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def keep_first(docs: DataFrame, shingle: int = SHINGLE) -> DataFrame:
    """One row of each near-duplicate component: the one with the smallest
    doc_id (a row without an id only if the component has no other), of rows
    that share that id the one of the smallest content hash, and one of equal
    rows. Unlike texts under one id lie in components of their own, so each
    stays. All columns are kept."""
    fp, row_hash, row_id, place = fresh(docs, "fp", "hash", "id", "place")
    content = F.xxhash64(*[F.col(f"`{c}`") for c, kind in docs.dtypes if not kind.startswith("map")])
    marked = docs.withColumn(fp, fingerprint_udf(shingle)(text_of())["fp"])
    rows = stored(marked.select("doc_id", F.col(fp).alias("fp"), content.alias("h")), "simhash-docs")
    first = (grouped(rows).groupBy("root")
             .agg(F.min(F.struct(F.col("doc_id").isNull().alias("unnamed"), "doc_id", "h")).alias("best"))
             .select(F.coalesce("best.doc_id", F.lit(0)).alias(row_id), F.col("best.h").alias(row_hash)).distinct())
    # Join and numbering share their keys, so the texts are shuffled once.
    named = docs.withColumn(row_id, F.coalesce("doc_id", F.lit(0))).withColumn(row_hash, content)
    equal = Window.partitionBy(row_id, row_hash).orderBy(row_hash)
    return (named.join(first, [row_id, row_hash], "left_semi").withColumn(place, F.row_number().over(equal))
            .where(F.col(place) == 1).drop(row_id, row_hash, place))
