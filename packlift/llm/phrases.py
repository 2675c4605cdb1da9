"""Document fingerprints by locally consistent parsing.

A text is a sequence of code points. One level of parsing first makes each run
of equal symbols one symbol, then breaks ties by deterministic coin tossing:
each symbol's label becomes the place and value of the lowest bit in which it
differs from its left neighbour, four times over, until labels are below six
and neighbours still differ. Symbols whose label is a local maximum start a
block of two to eleven symbols, and a block's name is a hash of its symbols.
The names are the next level's symbols. As a block depends on a few symbols to
either side only, equal substrings get equal names in their interior, at any
offset and in any text.

A fingerprint holds, for each of ``LEVELS`` levels, the ``KEEP`` smallest
distinct names (bottom-k sketch, names cut to 24 bits). Two fingerprints'
likeness is the weighted mean over levels of the Jaccard similarity that the
sketches estimate. Parsing is linear in the text's length and runs over many
texts at once.

Defined cases: a null text is empty; an empty text's fingerprint has no names,
and two such are alike (1), one such and another unlike (0); equal texts have
equal fingerprints; documents of one id are ordered by a hash of their text,
null ids come last; a lone document is its own next; an empty table gives an
empty result; other columns are ignored.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from packlift.llm.common import SLICE_CHARS, stored, text_of

KEEP = (8, 32, 32)                # names kept of level 1, 2, 3
LEVELS = len(KEEP)
WEIGHT = (1.0, 3.0, 4.0)          # of the levels' similarities
PARSE_CHARS = 400_000             # code points parsed at once, unless one text alone has more
_U = np.uint64
_MIX1, _MIX2, _MIX3 = _U(0x9E3779B97F4A7C15), _U(0xBF58476D1CE4E5B9), _U(0x94D049BB133111EB)


def _mix(x: np.ndarray) -> np.ndarray:
    x = x + _MIX1
    x = (x ^ (x >> _U(30))) * _MIX2
    x = (x ^ (x >> _U(27))) * _MIX3
    return x ^ (x >> _U(31))


def _powers(n: int) -> np.ndarray:
    out = np.empty(n, dtype=np.uint64)
    value = 1
    for i in range(n):
        out[i] = value
        value = value * 0xD6E8FEB86659FD93 & 0xFFFFFFFFFFFFFFFF
    return out


_POWERS = _powers(64)


def _runs(symbols: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Make each run of equal symbols one; ``first`` marks the texts' first symbols."""
    start = first.copy()
    start[1:] |= symbols[1:] != symbols[:-1]
    at = np.flatnonzero(start)
    length = np.diff(at, append=len(symbols))
    out = symbols[at]
    long = length > 1
    out[long] = _mix(out[long] ^ _mix(length[long].astype(np.uint64)))
    return out, first[at]


def _toss(symbols: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Labels below six that differ between neighbours of one text."""
    labels = symbols
    for round_ in range(4):
        differ = np.empty_like(labels)
        differ[1:] = labels[1:] ^ labels[:-1]
        differ[first] = 1                  # no left neighbour: as if the lowest bit differed
        low = differ & (~differ + differ.dtype.type(1))
        place = np.bitwise_count(low - low.dtype.type(1))
        bit = (labels & low) != 0
        labels = (place << np.uint8(1)) | bit.astype(np.uint8)
    return labels


def _blocks(symbols: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """One level: the names of the blocks, and the marks of the texts' first blocks."""
    symbols, first = _runs(symbols, first)
    labels = _toss(symbols, first)
    peak = np.zeros(len(labels), dtype=bool)
    peak[1:-1] = (labels[1:-1] > labels[:-2]) & (labels[1:-1] > labels[2:])
    # A text's ends are no neighbours of the next text's.
    ends = np.flatnonzero(first)
    peak[ends] = True
    after = ends + 1
    inside = after[after < len(labels)]
    peak[inside[~first[inside]]] = False
    last = ends[1:] - 1
    peak[last[~first[last]]] = False
    if len(labels) and not first[-1]:
        peak[-1] = False
    at = np.flatnonzero(peak)
    place = np.arange(len(symbols)) - np.repeat(at, np.diff(at, append=len(symbols)))
    terms = _mix(symbols) * _POWERS[np.minimum(place, 63)]
    return _mix(np.add.reduceat(terms, at)), first[at]


def sketches(texts: list[str]) -> list[tuple[np.ndarray, ...]]:
    """Each text's smallest distinct names by level."""
    out: list[list[np.ndarray]] = [[] for _ in texts]
    lo = 0
    while lo < len(texts):
        hi, size = lo, 0
        while hi < len(texts) and (hi == lo or size + len(texts[hi]) <= PARSE_CHARS):
            size += len(texts[hi])
            hi += 1
        _sketch_part(texts[lo:hi], out[lo:hi])
        lo = hi
    return [tuple(s) for s in out]


_EMPTY = np.zeros(0, dtype=np.uint32)


def _sketch_part(texts: list[str], out: list[list[np.ndarray]]) -> None:
    some = [k for k, t in enumerate(texts) if t]
    for k, t in enumerate(texts):
        if not t:
            out[k] += [_EMPTY] * LEVELS
    if not some:
        return
    data = "".join(texts[k] for k in some).encode("utf-32-le", "surrogatepass")
    symbols = np.frombuffer(data, dtype=np.uint32).astype(np.uint64)
    lengths = np.array([len(texts[k]) for k in some])
    first = np.zeros(len(symbols), dtype=bool)
    first[np.cumsum(lengths) - lengths] = True
    for level in range(LEVELS):
        symbols, first = _blocks(symbols, first)
        names = (symbols >> _U(40)).astype(np.uint32)
        starts = [*np.flatnonzero(first).tolist(), len(symbols)]
        for k, a, b in zip(some, starts, starts[1:]):
            out[k].append(_least(names[a:b], KEEP[level]))


def _least(names: np.ndarray, keep: int) -> np.ndarray:
    """The smallest distinct names."""
    if len(names) > 8 * keep:
        few = np.unique(np.partition(names, 4 * keep)[:4 * keep])
        if len(few) > keep:                # the largest of ``few`` may have equals beyond, the others not
            return few[:keep]
    return np.unique(names)[:keep]


def fingerprint(sketch: tuple[np.ndarray, ...]) -> bytes:
    """The number of names of each level, then the names, three bytes each."""
    names = [n.to_bytes(3, "big") for part in sketch for n in part.tolist()]
    return bytes(len(part) for part in sketch) + b"".join(names)


def likeness(a: tuple[np.ndarray, ...], b: tuple[np.ndarray, ...]) -> float:
    total = weight = 0.0
    for x, y, keep, w in zip(a, b, KEEP, WEIGHT):
        if not len(x) and not len(y):
            continue
        weight += w
        if not len(x) or not len(y):
            continue
        xs, ys = set(x.tolist()), set(y.tolist())
        both = xs & ys
        union = sorted(xs | ys)[:keep]
        total += w * sum(n in both for n in union) / len(union)
    return total / weight if weight else 1.0


def edited(text: str, following: str) -> str:
    n = len(text)
    return text[:n - n // 3] + following[:n // 3]


REPORT = ("doc_id long, n_chars long, edited_sha256 binary, fingerprint binary, edited_fingerprint binary, "
          "near_edited double, near_next double, pid int, edge string, text string")


def _digest(text: str) -> bytes:
    return hashlib.sha256(text.encode("utf-8", "surrogatepass")).digest()


def _compare(ids: list, texts: list[str]) -> list[tuple]:
    """Result rows of all texts but the last, each against the one after it."""
    own = sketches(texts)
    changed_texts = [edited(t, f) for t, f in zip(texts, texts[1:])]
    changed = sketches(changed_texts)
    return [(i, len(t), _digest(c), fingerprint(o), fingerprint(e), likeness(o, e), likeness(o, n))
            for i, t, c, o, e, n in zip(ids, texts, changed_texts, own, changed, own[1:])]


_TYPES = [pa.int64(), pa.int64(), pa.binary(), pa.binary(), pa.binary(), pa.float64(), pa.float64(),
          pa.int32(), pa.string(), pa.string()]
_NAMES = [part.split()[0] for part in REPORT.split(", ")]


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), _TYPES)], names=_NAMES)


def _neighbours(batches):
    """Sorted rows to results; a partition's first and last row are also handed
    on with their texts, as their neighbours lie in other partitions."""
    pid = TaskContext.get().partitionId()
    ids, texts, size, begun = [], [], 0, False
    for batch in batches:
        for doc_id, text in zip(batch.column(0), batch.column(1)):
            doc_id, text = doc_id.as_py(), text.as_py()
            if not begun:
                begun = True
                yield _batch([(doc_id, *[None] * 6, pid, "first", text)])
            ids.append(doc_id)
            texts.append(text)
            size += len(text)
            if size > SLICE_CHARS and len(ids) > 1:
                yield _batch([(*r, pid, None, None) for r in _compare(ids, texts)])
                ids, texts, size = ids[-1:], texts[-1:], len(texts[-1])
    if ids:
        if len(ids) > 1:
            yield _batch([(*r, pid, None, None) for r in _compare(ids, texts)])
        yield _batch([(ids[-1], *[None] * 6, pid, "last", texts[-1])])


def _join_edges(batches):
    for batch in batches:
        out = []
        for doc_id, text, following in zip(*(batch.column(k).to_pylist() for k in range(3))):
            out += [(*r, None, None, None) for r in _compare([doc_id], [text, following])]
        if out:
            yield _batch(out)


def _result(rows: DataFrame) -> DataFrame:
    """Digests and fingerprints travel as bytes and are shown in hex."""
    return rows.select(*[F.lower(F.hex(c)).alias(c) if kind == "binary" else F.col(c)
                         for c, kind in rows.dtypes if c in _NAMES[:7]])


def phrase_fingerprints(docs: DataFrame) -> DataFrame:
    """Fingerprints of every text and of its edited text, and their likeness.

    Texts are sorted by descending id in ranges, and each task compares its rows
    in passing; only the rows at the ranges' ends are joined, by range number.
    """
    body = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_of().alias("text"))
    order = [F.col("doc_id").desc_nulls_last(), F.xxhash64("text")]
    done = stored(body.repartitionByRange(*order).sortWithinPartitions(*order).mapInArrow(_neighbours, REPORT),
                  "phrases")
    edges = done.where(F.col("edge").isNotNull())
    # One number per range that has rows.
    pids = sorted(r["pid"] for r in edges.where(F.col("edge") == "first").select("pid").collect())
    if not pids:
        return _result(done)
    following = done.sparkSession.createDataFrame(list(zip(pids, pids[1:] + pids[:1])), "p int, q int")
    last = edges.where(F.col("edge") == "last").select(F.col("pid").alias("p"), "doc_id", "text")
    first = edges.where(F.col("edge") == "first").select(F.col("pid").alias("q"), F.col("text").alias("following"))
    ends = (last.join(following, "p").join(first, "q").select("doc_id", "text", "following")
            .mapInArrow(_join_edges, REPORT))
    return _result(done.where(F.col("edge").isNull())).unionByName(_result(ends))
