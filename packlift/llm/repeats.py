"""Repeated substrings over all texts, by suffix arrays of linear grouping.

Removed is every byte that a string of ``length`` bytes covers which also
starts anywhere else, in this text or another; matches never cross texts.

One suffix array over a corpus is no distributed job, so places that can match
are first brought together. Of the short grams of a window of ``length`` bytes
the one with the least hash (leftmost on ties) is its anchor: a choice that
depends on the window's bytes alone, so equal windows have equal anchors at
equal places. The windows of one anchor follow each other; their bytes are a
segment. Every window lies in exactly one segment, and equal windows lie in
segments of equal key (the anchor's hash). Then:

1. keys found once are dropped (their windows cannot repeat);
2. segments are counted by key and their own hash (128 bits together) with
   map-side combining, so a group of copies is one row whatever its size;
   windows of a segment found twice are repeated;
3. the different segments of a key go to one task, which builds the suffix
   array of their concatenation (``suffix_array``); windows that are neighbours
   there and agree in ``length`` bytes are repeated;
4. a key with more than ``crowded`` different segments (the edge of a passage
   that stands in many texts) is split first: its segments are cut into shorter
   runs of windows, keyed by all the bytes these share. At last a run is one
   window and a key's units are equal, so no task gets an unbounded group.

Defined cases: null text counts as empty; null ids and repeated rows are rows of
their own (a repeated row's text repeats); a text shorter than ``length`` loses
nothing. Collisions of the anchors' hashes
only bring more segments together.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from packlift.llm.common import release, stored, text_of
from packlift.llm.suffix_array import suffix_array

LENGTH = 200        # bytes of a repeated string
GRAM = 64           # bytes of an anchor
CROWDED = 1024      # different segments of one key that one task sorts together
RUNS = (8, 1)       # windows of a unit after the first and the second split of a crowded key
CHUNK = 1 << 20     # windows of a text looked at together
BATCH_BYTES = 4_000_000    # bytes handed back to Spark at a time, unless one text alone has more
_PLACE_BITS = 24
_ROWS = 1000               # texts of an Arrow batch


def _filled(rows: Iterator[tuple[tuple, int]], schema: pa.Schema) -> Iterator[pa.RecordBatch]:
    """``rows`` (with their sizes) in batches of bounded bytes."""
    columns: list[list] = [[] for _ in schema]
    size = 0
    for row, n in rows:
        for column, value in zip(columns, row):
            column.append(value)
        size += n
        if size > BATCH_BYTES:
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, schema)], schema=schema)
            columns, size = [[] for _ in schema], 0
    yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, schema)], schema=schema)


# --- anchors -------------------------------------------------------------------------

def _mixed(x: np.ndarray) -> np.ndarray:
    """An integer hash of 64 bits (xor-shift and multiply rounds)."""
    for shift, factor in ((30, 0xBF58476D1CE4E5B9), (27, 0x94D049BB133111EB)):
        x = (x ^ (x >> np.uint64(shift))) * np.uint64(factor)
    return x ^ (x >> np.uint64(31))


class Anchors:
    """The runs of windows of equal anchor in a text."""

    def __init__(self, length: int = LENGTH, gram: int = GRAM, chunk: int = CHUNK):
        self.length, self.gram, self.chunk = length, gram, chunk
        base = 0x9E3779B97F4A7C15
        self._powers, self._inverse = (
            np.cumprod(np.concatenate((np.ones(1, np.uint64), np.full(chunk + length, b, dtype=np.uint64))), dtype=np.uint64)
            for b in (base, pow(base, -1, 1 << 64)))

    def _sums(self, text: bytes) -> np.ndarray:
        """The prefix sums of a polynomial in the text's bytes."""
        symbols = np.frombuffer(text, dtype=np.uint8).astype(np.uint64) + np.uint64(1)
        return np.concatenate((np.zeros(1, np.uint64), np.cumsum(symbols * self._powers[:len(text)], dtype=np.uint64)))

    def _hashes(self, sums: np.ndarray, gram: int) -> np.ndarray:
        """The hash of every gram: differences of the sums, moved to a common power, mixed."""
        return _mixed((sums[gram:] - sums[:-gram]) * self._inverse[:len(sums) - gram])

    def of(self, text: bytes) -> np.ndarray:
        """Rows ``key, sid, first, n, ahead``: an anchor's hash, its segment's hash, its
        windows [first, first + n), and how far the anchor is ahead of the first."""
        parts = [np.empty((0, 5), dtype=np.int64)]
        for start in range(0, len(text) - self.length + 1, self.chunk):
            part = self._chunk(text[start:start + self.chunk + self.length - 1])
            part[:, 2] += start
            parts.append(part)
        return np.concatenate(parts)

    def _chunk(self, text: bytes) -> np.ndarray:
        sums = self._sums(text)
        h = self._hashes(sums, self.gram)
        grams, places = self.length - self.gram + 1, np.uint64((1 << _PLACE_BITS) - 1)
        # The place in the lowest bits makes the minimum its own argmin, leftmost on ties.
        least, width = (h & ~places) | np.arange(len(h), dtype=np.uint64), 1
        while 2 * width <= grams:
            least = np.minimum(least[:-width], least[width:])
            width *= 2
        if grams > width:
            least = np.minimum(least[:width - grams], least[grams - width:])
        place = (least & places).astype(np.int64)
        first = np.concatenate(([0], np.flatnonzero(np.diff(place)) + 1))
        n = np.diff(np.append(first, len(place)))
        at = place[first]
        sid = _mixed(_mixed((sums[first + n + self.length - 1] - sums[first]) * self._inverse[first])
                     + n.astype(np.uint64))
        return np.stack((h[at].view(np.int64), sid.view(np.int64), first, n, at - first), axis=1)


# --- judging the segments of one key ----------------------------------------------------

def repeated_windows(segments: list[tuple[bytes, int]], length: int) -> list[np.ndarray]:
    """Per different segment (with how often it occurs): which of its windows repeat, as booleans.

    All windows of a segment found twice do; the others if a neighbour in the
    suffix array of all segments agrees in ``length`` bytes.
    """
    out = [np.full(len(s) - length + 1, times > 1) for s, times in segments]
    if len(segments) < 2:
        return out
    starts = np.cumsum([0] + [len(s) + 1 for s, _ in segments])
    # Every segment ends in a symbol below all bytes.
    joined = b"".join(s + b"\0" for s, _ in segments)
    symbols = np.frombuffer(joined, dtype=np.uint8).astype(np.int64) + 1
    symbols[starts[1:] - 1] = 0
    where = np.array(suffix_array(symbols), dtype=np.int64)
    owner = np.searchsorted(starts, where, side="right") - 1
    whole = where + length < starts[owner + 1]
    where, owner = where[whole], owner[whole]
    # Windows have no separator inside, so equal bytes are an equal window.
    cut = [joined[w:w + length] for w in where.tolist()]
    same = np.fromiter((a == b for a, b in zip(cut, cut[1:])), dtype=bool, count=max(len(cut) - 1, 0))
    found = np.zeros(len(where), dtype=bool)
    found[1:] |= same
    found[:-1] |= same
    for o, w in zip(owner[found].tolist(), (where - starts[owner])[found].tolist()):
        out[o][w] = True
    return out


def runs_of(flags: np.ndarray) -> list[tuple[int, int]]:
    """The maximal runs [lo, hi) of true flags."""
    edges = np.flatnonzero(np.diff(np.concatenate(([0], flags.astype(np.int8), [0]))))
    return list(zip(edges[::2].tolist(), edges[1::2].tolist()))


_VERDICT = pa.schema([("key", pa.int64()), ("sid", pa.int64()), ("lo", pa.int32()), ("hi", pa.int32())])


def _judge(units: DataFrame, length: int) -> DataFrame:
    """``key, sid, lo, hi``: the repeated windows of every unit; a key's units are read by one task."""
    def groups(batches) -> Iterator[tuple[int, list]]:
        key, mine = None, []
        for batch in batches:
            for k, *unit in zip(*(batch.column(c).to_pylist() for c in ("key", "sid", "seg", "times"))):
                if k != key:
                    if mine:
                        yield key, mine
                    key, mine = k, []
                mine.append(unit)
        if mine:
            yield key, mine

    def verdicts(batches):
        for key, mine in groups(batches):
            flags = repeated_windows([(seg, times) for _, seg, times in mine], length)
            for (sid, _, _), f in zip(mine, flags):
                for lo, hi in runs_of(f):
                    yield (key, sid, lo, hi), 100

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from _filled(verdicts(batches), _VERDICT)

    return (units.select("key", "sid", "seg", "times").repartition("key").sortWithinPartitions("key", "sid")
            .mapInArrow(run, "key bigint, sid bigint, lo int, hi int"))


def _code(data: bytes) -> int:
    """A digest as a signed 64-bit integer."""
    return int.from_bytes(hashlib.blake2b(data, digest_size=8).digest(), "little", signed=True)


_UNIT = pa.schema([("key", pa.int64()), ("sid", pa.int64()), ("seg", pa.binary()), ("times", pa.int64()),
                   ("ahead", pa.int32())])
_PART = pa.schema([*_UNIT, ("parent_key", pa.int64()), ("parent_sid", pa.int64()), ("shift", pa.int32())])


def split_unit(seg: bytes, ahead: int, windows: int, length: int) -> Iterator[tuple[int, bytes, int]]:
    """``key, bytes, place`` of the shorter units of a unit whose anchor is ``ahead`` of its first window.

    Windows whose distance to the anchor has the same quotient by ``windows``
    stay together, and their key is made of the quotient and the bytes that all
    windows of such a distance hold. Both depend on a window's own bytes only.
    """
    n, at = len(seg) - length + 1, 0
    while at < n:
        slot = (ahead - at) // windows
        last = ahead - slot * windows
        end = min(n, last + 1)
        yield _code(b"%d " % slot + seg[last:last - windows + 1 + length]), seg[at:end + length - 1], at
        at = end


UNIT = "key bigint, sid bigint, seg binary, times bigint, ahead int"


def _split(units: DataFrame, windows: int, length: int) -> DataFrame:
    """Units of at most ``windows`` windows in place of larger ones: ``key, sid`` are the
    shorter unit's, ``parent_*`` the larger one's, ``shift`` its place there."""
    def parts(batches):
        for batch in batches:
            for key, sid, seg, times, ahead in zip(*(batch.column(c).to_pylist()
                                                     for c in ("key", "sid", "seg", "times", "ahead"))):
                for code, part, at in split_unit(seg, ahead, windows, length):
                    yield (code, _code(part), part, times, ahead - at, key, sid, at), len(part)

    def run(batches):
        yield from _filled(parts(batches), _PART)

    return units.select("key", "sid", "seg", "times", "ahead").mapInArrow(
        run, UNIT + ", parent_key bigint, parent_sid bigint, shift int")


def _different(units: DataFrame) -> DataFrame:
    """One row per (key, digest) with its bytes, its number of occurrences and the place of its anchor."""
    return units.groupBy("key", "sid").agg(F.first("seg", ignorenulls=True).alias("seg"), F.sum("times").alias("times"),
                                           F.min("ahead").alias("ahead"))


def repeated_runs(units: DataFrame, length: int, crowded: int, runs: tuple[int, ...]) -> DataFrame:
    """``key, sid, lo, hi`` for the (stored) different units; crowded keys are split and judged again."""
    many = stored(units.groupBy("key").count().where(F.col("count") > crowded).select("key"), "crowded")
    if not runs or many.isEmpty():
        return _judge(units, length)
    parts = stored(_split(units.join(many, "key", "left_semi"), runs[0], length), "split", _ROWS)
    found = repeated_runs(stored(_different(parts), "units"), length, crowded, runs[1:])
    back = (parts.select("key", "sid", "parent_key", "parent_sid", "shift").join(found, ["key", "sid"])
            .select(F.col("parent_key").alias("key"), F.col("parent_sid").alias("sid"),
                    (F.col("lo") + F.col("shift")).alias("lo"), (F.col("hi") + F.col("shift")).alias("hi")))
    return _judge(units.join(many, "key", "left_anti"), length).unionByName(back)


# --- all texts ---------------------------------------------------------------------------

def _id_type(docs: DataFrame) -> str:
    return docs.schema["doc_id"].dataType.simpleString()


_ANCHOR = pa.struct([("key", pa.int64()), ("sid", pa.int64()), ("first", pa.int32()), ("n", pa.int32()),
                     ("ahead", pa.int32())])


def _anchored(docs: DataFrame, length: int, gram: int) -> DataFrame:
    """Every text as bytes with its digest and its anchors."""
    def slices(batch):
        lo, size = 0, 0
        for i, n in enumerate(pa.compute.binary_length(batch.column("text")).to_pylist()):
            if i > lo and size + n > BATCH_BYTES:
                yield batch.slice(lo, i - lo)
                lo, size = i, 0
            size += n
        yield batch.slice(lo)

    def run(batches):
        anchors = Anchors(length, gram)
        for part in (p for batch in batches for p in slices(batch)):
            texts = part.column("text").to_pylist()
            found = [anchors.of(t) for t in texts]
            offsets = pa.array(np.cumsum([0] + [len(f) for f in found]).astype(np.int32))
            flat = np.concatenate([np.empty((0, 5), dtype=np.int64), *found])
            rows = pa.StructArray.from_arrays([pa.array(np.ascontiguousarray(flat[:, c]).astype(f.type.to_pandas_dtype()))
                                               for c, f in enumerate(_ANCHOR)], fields=list(_ANCHOR))
            yield pa.RecordBatch.from_arrays(
                [part.column("row"), part.column("doc_id"), part.column("text"),
                 pa.array([len(t) for t in texts], pa.int64()),
                 pa.array([hashlib.sha256(t).hexdigest() for t in texts], pa.string()),
                 pa.ListArray.from_arrays(offsets, rows)],
                names=["row", "doc_id", "text", "n_bytes", "sha256", "anchors"])

    rows = docs.select(F.monotonically_increasing_id().alias("row"), "doc_id", text_of().cast("binary").alias("text"))
    return rows.mapInArrow(run, f"row bigint, doc_id {_id_type(docs)}, text binary, n_bytes bigint, sha256 string, "
                                "anchors array<struct<key: bigint, sid: bigint, first: int, n: int, ahead: int>>")


def _units(texts: DataFrame, length: int) -> DataFrame:
    """The bytes of the segments listed in ``wanted``."""
    def parts(batches):
        for batch in batches:
            for text, wanted in zip(*(batch.column(c).to_pylist() for c in ("text", "wanted"))):
                for w in wanted:
                    seg = text[w["first"]:w["first"] + w["n"] + length - 1]
                    yield (w["key"], w["sid"], seg, w["times"], w["ahead"]), len(seg)

    def run(batches):
        yield from _filled(parts(batches), _UNIT)

    return texts.select("text", "wanted").mapInArrow(run, UNIT)


def covered(windows: list[tuple[int, int]], length: int) -> list[tuple[int, int]]:
    """The maximal byte runs covered by the windows [lo, hi) of ``length`` bytes each."""
    out: list[tuple[int, int]] = []
    for lo, hi in sorted(windows):
        end = hi + length - 1
        if out and lo <= out[-1][1]:
            out[-1] = (out[-1][0], max(end, out[-1][1]))
        else:
            out.append((lo, end))
    return out


_LESS = pa.schema([("row", pa.int64()),
                   ("spans", pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())]))), ("kept", pa.binary())])


def _removed(texts: DataFrame, length: int) -> DataFrame:
    """``row, spans, kept`` of texts that lose something: the removed byte runs and the bytes that stay."""
    def rows(batches):
        for batch in batches:
            for row, text, windows in zip(*(batch.column(c).to_pylist() for c in ("row", "text", "windows"))):
                spans = covered([(w["lo"], w["hi"]) for w in windows], length)
                edges = [0, *(e for s in spans for e in s), len(text)]
                kept = b"".join(text[a:b] for a, b in zip(edges[::2], edges[1::2]))
                yield (row, [{"start": a, "end": b} for a, b in spans], kept), len(kept) + 50

    def run(batches):
        yield from _filled(rows(batches), _LESS)

    return texts.select("row", "text", "windows").mapInArrow(
        run, "row bigint, spans array<struct<start: int, end: int>>, kept binary")


def remove_repeats(docs: DataFrame, length: int = LENGTH, gram: int | None = None, crowded: int = CROWDED,
                   runs: tuple[int, ...] = RUNS) -> tuple[DataFrame, DataFrame]:
    """All texts (``row, doc_id, text, n_bytes, sha256``), and ``row, spans, kept`` of those that lose bytes."""
    gram = gram or min(GRAM, max(length // 3, 1))
    spark = docs.sparkSession

    def kept(df, name, rows=None):
        out = stored(df, name, rows, "zstd")
        release(spark)
        return out

    texts = kept(_anchored(docs, length, gram), "anchored", _ROWS)
    anchors = texts.select("row", F.inline("anchors"))
    # Keys found twice, and whether all their segments are one.
    keys = kept(anchors.groupBy("key").agg(F.count(F.lit(1)).alias("c"), F.min("sid").alias("a"), F.max("sid").alias("b"))
                .where("c > 1").select("key", (F.col("a") != F.col("b")).alias("mixed")), "keys")
    found = kept(anchors.join(keys, "key"), "found")
    mixed, alike = found.where("mixed"), found.where(~F.col("mixed"))
    # One occurrence of every different segment hands over its bytes.
    wanted = (mixed.groupBy("key", "sid").agg(F.count(F.lit(1)).alias("times"), F.min(F.struct("row", "first", "n", "ahead")).alias("at"))
              .groupBy("at.row").agg(F.collect_list(F.struct("at.first", "at.n", "at.ahead", "key", "sid", "times")).alias("wanted")))
    units = kept(_units(texts.select("row", "text").join(wanted, "row"), length), "units", _ROWS)
    judged = kept(repeated_runs(units, length, crowded, runs), "judged")
    windows = (mixed.join(judged, ["key", "sid"])
               .select("row", (F.col("first") + F.col("lo")).alias("lo"), (F.col("first") + F.col("hi")).alias("hi"))
               .unionByName(alike.select("row", F.col("first").alias("lo"), (F.col("first") + F.col("n")).alias("hi")))
               .groupBy("row").agg(F.collect_list(F.struct("lo", "hi")).alias("windows")))
    removed = kept(_removed(texts.select("row", "text").join(windows, "row"), length), "kept", _ROWS)
    return texts.drop("anchors"), removed


def repeat_digests(docs: DataFrame, **options) -> DataFrame:
    """One row per document: its bytes, the removed ones and their maximal runs, and the digest of what stays."""
    texts, removed = remove_repeats(docs, **options)
    lost = F.aggregate("spans", F.lit(0).cast("bigint"), lambda a, s: a + (s["end"] - s["start"]).cast("bigint"))
    removed = removed.select("row", lost.alias("n_removed"), F.size("spans").cast("bigint").alias("n_spans"),
                             F.sha2("kept", 256).alias("kept_sha256"))
    zero = F.lit(0).cast("bigint")
    return (texts.select("row", "doc_id", "n_bytes", "sha256").join(removed, "row", "left")
            .select("doc_id", "n_bytes", F.coalesce("n_removed", zero).alias("n_removed"),
                    F.coalesce("n_spans", zero).alias("n_spans"), F.coalesce("kept_sha256", "sha256").alias("kept_sha256")))
