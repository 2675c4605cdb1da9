"""Alignment of two tokenizers over the same texts, by diagonal run skipping.

A text's tokens under A and under B are reduced to their end offsets in bytes.
Where both end arrays hold an offset, the tokens up to there form a group. The
two arrays are walked together at the current index shift: a stretch where
``ends_a[i + n] == ends_b[j + n]`` is one-to-one, and its length is found by
exponential probing (slices of doubled length compared whole; the first
difference is the lowest different bit of the last two, read as numbers). At an irregular group the lesser end advances until both
agree; the shift is then that of the new places, and probing starts again.

A link is a pair of tokens whose byte ranges overlap: one per one-to-one group,
and one per step of the local walk in an irregular one. A pair of ids counts as
often as it is linked in all texts. The counts stay in Spark: a table of links
per text is stored once, summed by pair of ids, and met again with the counts
in two equi joins. Pairs that hold at least 1 / 2^18 of all links number at
most 2^18, so they are broadcast; every other pair has less than 1 / 2^18 of
the links, so none is a hot key of the shuffled join.

Defined cases: a text that is null, empty, or whose joined token bytes under A
or B differ from a space and the text has no tokens (zeros, digest ''). Repeated
rows and null ids are rows of their own, and repeated texts count again. Texts
are encoded whole; strings of special tokens are ordinary text.
"""

from __future__ import annotations

import hashlib
import json
import os
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from packlift.llm.common import slices, stored, text_of

HEAVY_PAIRS = 1 << 18       # pairs with at least this share of all links are broadcast: at most so many
SLICE = 500_000             # characters encoded at a time, unless one text alone has more
LONGEST_PROBE = 1 << 18     # bytes compared at a time


# --- vocabularies ------------------------------------------------------------------

def byte_letters() -> dict[str, int]:
    """The letters that stand for bytes in a byte-level vocabulary: printable
    Latin-1 bytes for themselves, the others counted on from 256."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    other = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(other)}


# How a byte-level vocabulary cuts a text before merging (fixed value).
BYTE_LEVEL_PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
# The rank encoder's pattern engine overflows on white space of some hundred thousand characters.
LONG_BLANK = re.compile(r"\s{10000}")


class ByteLevel:
    """Tokenizer A: a byte-level BPE file of the tokenizers library, given as its text.

    Where ids follow the order of merges, the ids are also ranks, and the rank
    encoder gives the library's ids in a quarter of its time (tests compare
    them on every code point). Other files, and texts with very long white
    space, go through the library itself.
    """

    def __init__(self, spec: str):
        from tokenizers import Tokenizer

        # The tasks are the parallelism; the library's own threads would fight over their cores.
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        self._library = Tokenizer.from_str(spec)
        self._library.encode_special_tokens = True
        self._library.no_truncation()
        self._library.no_padding()
        letters = byte_letters()
        self.pieces = [b""] * self._library.get_vocab_size(with_added_tokens=True)
        for piece, i in self._library.get_vocab(with_added_tokens=True).items():
            known = all(c in letters for c in piece)
            self.pieces[i] = bytes(letters[c] for c in piece) if known else piece.encode()
        self._ranks = self._rank_encoder(json.loads(spec))

    def _rank_encoder(self, spec: dict):
        import tiktoken

        model, cut = spec["model"], spec["pre_tokenizer"]
        vocab = model["vocab"]
        merges = [m.split(" ") if isinstance(m, str) else m for m in model["merges"]]
        plain = (spec["normalizer"] is None and cut["type"] == "ByteLevel" and not cut["add_prefix_space"]
                 and cut.get("use_regex", True) and model["type"] == "BPE" and not model.get("ignore_merges")
                 and len(vocab) == 256 + len(merges)
                 and all(vocab[a + b] == 256 + i for i, (a, b) in enumerate(merges)))
        return tiktoken.Encoding("ids", pat_str=BYTE_LEVEL_PATTERN, special_tokens={},
                                 mergeable_ranks={self.pieces[i]: i for i in vocab.values()}) if plain else None

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        return [self._one(" " + t) for t in texts]

    def _one(self, text: str) -> np.ndarray:
        if self._ranks is None or LONG_BLANK.search(text):
            return np.array(self._library.encode(text, add_special_tokens=False).ids, dtype=np.int64)
        return self._ranks.encode_to_numpy(text, disallowed_special=()).astype(np.int64)


class Piece:
    """Tokenizer B: a sentencepiece model given as its bytes; it adds the leading space itself."""

    def __init__(self, model: bytes):
        import sentencepiece

        self._encoder = sentencepiece.SentencePieceProcessor(model_proto=model)
        n = self._encoder.get_piece_size()
        self.pieces = [self._bytes(i) for i in range(n)]

    def _bytes(self, i: int) -> bytes:
        piece = self._encoder.id_to_piece(i)
        if self._encoder.is_byte(i):
            return bytes([int(piece[3:-1], 16)])
        return piece.replace("▁", " ").encode()

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        return [np.array(ids, dtype=np.int64) for ids in self._encoder.encode(texts, num_threads=1)]


# --- one text ----------------------------------------------------------------------

WORD = 4     # bytes of an end offset in the buffers that are probed


FIRST_PROBE = 16 * WORD


def run_length(a: bytes, b: bytes, i: int, j: int) -> int:
    """How far the offsets of ``a`` from place i on equal those of ``b`` from place j on.

    Probes of doubled length are compared whole. One that differs is read as
    two numbers, whose lowest different bit is in the first different offset.
    """
    x, y = WORD * i, WORD * j
    width = FIRST_PROBE
    while True:
        p, q = a[x:x + width], b[y:y + width]
        if p != q or not p:
            break
        x += width
        y += width
        if width < LONGEST_PROBE:
            width += width
    most = min(len(p), len(q))
    if most == width:
        differ = int.from_bytes(p, "little") ^ int.from_bytes(q, "little")
    else:
        differ = int.from_bytes(p[:most], "little") ^ int.from_bytes(q[:most], "little")
    same = ((differ & -differ).bit_length() - 1) // (8 * WORD) if differ else most // WORD
    return min(x, len(a)) // WORD - i + same


def align(ends_a: np.ndarray, ends_b: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The walk over two rising arrays of end offsets with equal last entries.

    Each step ``(i, j, run, p, q)``, a row of the first array, is ``run``
    one-to-one groups from tokens (i, j) on, then one irregular group up to
    (p, q), exclusive; the last step may lack the latter. The other two arrays
    hold the links of the irregular groups, as places in a and in b.
    """
    steps = []
    a, b = ends_a.tolist(), ends_b.tolist()
    probe_a, probe_b = (e.astype(f"u{WORD}").tobytes() for e in (ends_a, ends_b))
    i = j = 0
    n = len(a)
    while i < n:
        run = run_length(probe_a, probe_b, i, j) if a[i] == b[j] else 0
        p, q = i + run, j + run
        if p < n:
            x, y = a[p], b[q]
            while x != y:
                if x < y:
                    p += 1
                    x = a[p]
                else:
                    q += 1
                    y = b[q]
            p += 1
            q += 1
        steps += (i, j, run, p, q)
        i, j = p, q
    table = np.array(steps, dtype=np.int64).reshape(-1, 5)
    return table, *irregular_links(ends_a, ends_b, table)


def irregular_links(ends_a: np.ndarray, ends_b: np.ndarray, steps: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The links of the irregular groups, as places in a and in b.

    The ends of both sides cut a group into stretches that lie in one token of
    each side; a stretch is a link, and the places are those of the tokens that
    end with it or next after it.
    """
    i, j, run, p, q = steps.T
    places = _expanded(i + run, p - i - run), _expanded(j + run, q - j - run)
    ends = ends_a[places[0]], ends_b[places[1]]
    cuts = np.sort(np.concatenate(ends))
    cuts = cuts[np.concatenate((cuts[1:] != cuts[:-1], np.ones(min(1, len(cuts)), dtype=bool)))]
    return places[0][ends[0].searchsorted(cuts)], places[1][ends[1].searchsorted(cuts)]


def _expanded(starts: np.ndarray, runs: np.ndarray) -> np.ndarray:
    """``start, start + 1, ...`` of each run, one after the other."""
    before = np.cumsum(runs) - runs
    return np.repeat(starts - before, runs) + np.arange(int(runs.sum()))


def group_ends(steps: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Per group the number of a's and of b's tokens up to its end."""
    if not len(steps):
        return np.empty(0, dtype=np.int64), np.empty(0, dtype=np.int64)
    i, j, run, p, q = steps.T
    knot = p > i + run
    ends = []
    for start, end in ((i, p), (j, q)):
        # A run's ends, then its irregular group's: one more place per step that has one.
        flat = _expanded(start + 1, run + knot)
        flat[np.cumsum(run + knot)[knot] - 1] = end[knot]
        ends.append(flat)
    return ends[0], ends[1]


def links(steps: np.ndarray, left: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Every link's place in a and in b: one per one-to-one group, then those of the irregular groups."""
    i, j, run, _, _ = steps.T
    return np.concatenate((_expanded(i, run), left)), np.concatenate((_expanded(j, run), right))


NO_STEPS = np.empty((0, 5), dtype=np.int64)
CHECKED = 1 << 16     # tokens whose bytes are compared at a time


class Bytes:
    """The bytes of a vocabulary's entries in one buffer."""

    def __init__(self, pieces: list[bytes]):
        self._flat = np.frombuffer(b"".join(pieces), dtype=np.uint8)
        self._lengths = np.array([len(p) for p in pieces], dtype=np.int64)
        self._starts = self._lengths.cumsum() - self._lengths

    def ends(self, ids: np.ndarray, text: np.ndarray) -> np.ndarray | None:
        """The end offset of each token; None unless the tokens' joined bytes are those of ``text``."""
        lengths = self._lengths[ids]
        ends = lengths.cumsum()
        if not len(ids) or ends[-1] != len(text):
            return None
        at = 0
        for k in range(0, len(ids), CHECKED):
            some = slice(k, k + CHECKED)
            to = int(ends[some][-1])
            if not np.array_equal(self._flat[_expanded(self._starts[ids[some]], lengths[some])], text[at:to]):
                return None
            at = to
        return ends


class Aligner:
    """Both tokenizers with their tables, built once per task."""

    def __init__(self, spec_a: str, model_b: bytes):
        self.a, self.b = ByteLevel(spec_a), Piece(model_b)
        self._bytes = [Bytes(v.pieces) for v in (self.a, self.b)]
        # An id as the digest's text has it: followed by what separates it from the next of its own
        # group (first half of a table), or by what ends its side of the group (second half).
        self._names = [np.array([f"{i}{mark}" for mark in marks for i in range(len(v.pieces))], dtype=object)
                       for v, marks in ((self.a, ",|"), (self.b, ",;"))]
        self.width = len(self.b.pieces)

    def texts(self, texts: list[str]) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
        """Per text: ids under A, ids under B, and what ``align`` returns; all empty without tokens."""
        got_a, got_b = self.a.encode(texts), self.b.encode(texts)
        none = np.empty(0, dtype=np.int64)
        for k, text in enumerate(texts):
            ids = (got_a[k], got_b[k])
            got_a[k] = got_b[k] = None
            want = np.frombuffer(b" " + text.encode(), dtype=np.uint8)
            ends = [v.ends(i, want) for v, i in zip(self._bytes, ids)] if text else [None]
            if any(e is None for e in ends):
                yield none, none, NO_STEPS, none, none
                continue
            yield *ids, *align(*ends)

    def pairs(self, ids_a: np.ndarray, ids_b: np.ndarray, left: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The distinct linked id pairs (A's id times B's vocabulary size plus B's id) and their numbers of links."""
        return np.unique(ids_a[left] * self.width + ids_b[right], return_counts=True)

    def text_of_groups(self, ids_a: np.ndarray, ids_b: np.ndarray, steps: np.ndarray) -> str:
        """``a1,a2|b1;a3|b2,b3``: decimal ids in order."""
        ends = group_ends(steps)
        sizes = [np.diff(e, prepend=0) for e in ends]
        out = np.empty(len(ids_a) + len(ids_b), dtype=object)
        # A token stands behind what its own side and the other side have had: for A the
        # B tokens of the groups before, for B also the A tokens of its own group.
        before = (np.concatenate(([0], ends[1][:-1])), ends[0])
        for side, ids in ((0, ids_a), (1, ids_b)):
            last = np.zeros(len(ids), dtype=np.int64)
            last[ends[side] - 1] = len(self._names[side]) // 2
            out[np.arange(len(ids)) + np.repeat(before[side], sizes[side])] = self._names[side][ids + last]
        return "".join(out.tolist())[:-1]


# --- all texts ---------------------------------------------------------------------

def _id_type(docs: DataFrame) -> str:
    return docs.schema["doc_id"].dataType.simpleString()


def _batches(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[pa.Array, list[str]]]:
    for batch in batches:
        at = 0
        for part in slices(batch.column("text").to_pylist(), SLICE):
            yield batch.column("doc_id").slice(at, len(part)), part
            at += len(part)


def _lists(rows: list) -> pa.Array:
    offsets = np.concatenate(([0], np.cumsum([len(r) for r in rows]))).astype(np.int32)
    flat = np.concatenate([np.asarray(r, dtype=np.int32) for r in rows]) if rows else np.empty(0, np.int32)
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(flat, pa.int32()))


def alignments(docs: DataFrame, spec_a: str, model_b: bytes) -> DataFrame:
    """``doc_id, a_ids, b_ids, a_ends, b_ends``: each text's ids under both
    tokenizers, and per group the number of A and B tokens up to its end."""
    def run(batches):
        aligner = Aligner(spec_a, model_b)
        for ids, texts in _batches(batches):
            rows = [(a, b, *group_ends(steps)) for a, b, steps, _, _ in aligner.texts(texts)]
            yield pa.RecordBatch.from_arrays([ids, *(_lists([r[c] for r in rows]) for c in range(4))],
                                             names=["doc_id", "a_ids", "b_ids", "a_ends", "b_ends"])

    return docs.select("doc_id", text_of().alias("text")).mapInArrow(
        run, f"doc_id {_id_type(docs)}, a_ids array<int>, b_ids array<int>, a_ends array<int>, b_ends array<int>")


COUNTS = ("n_a", "n_b", "n_groups", "n_links")


def linked_pairs(docs: DataFrame, spec_a: str, model_b: bytes) -> DataFrame:
    """``doc_id, n_a, n_b, n_groups, n_links, groups_sha256, links``: per text the
    sizes, the groups' digest, and its distinct linked id pairs with their numbers of links."""
    def run(batches):
        aligner = Aligner(spec_a, model_b)
        for ids, texts in _batches(batches):
            sizes, digests, codes, numbers = [], [], [], []
            for a, b, steps, left, right in aligner.texts(texts):
                left, right = links(steps, left, right)
                sizes.append((len(a), len(b), len(a) + len(b) - len(left), len(left)))
                digests.append(hashlib.sha256(aligner.text_of_groups(a, b, steps).encode()).hexdigest() if len(steps) else "")
                code, n = aligner.pairs(a, b, left, right)
                codes.append(code)
                numbers.append(n)
            offsets = pa.array(np.concatenate(([0], np.cumsum([len(c) for c in codes]))).astype(np.int32))
            found = pa.StructArray.from_arrays([pa.array(np.concatenate(codes), pa.int64()),
                                                pa.array(np.concatenate(numbers).astype(np.int32), pa.int32())],
                                               names=["code", "n"])
            yield pa.RecordBatch.from_arrays(
                [ids, *(pa.array([s[c] for s in sizes], pa.int64()) for c in range(4)), pa.array(digests, pa.string()),
                 pa.ListArray.from_arrays(offsets, found)],
                names=["doc_id", *COUNTS, "groups_sha256", "links"])

    sizes = ", ".join(f"{c} bigint" for c in COUNTS)
    return docs.select("doc_id", text_of().alias("text")).mapInArrow(
        run, f"doc_id {_id_type(docs)}, {sizes}, groups_sha256 string, links array<struct<code: bigint, n: int>>")


def pair_counts(linked: DataFrame, width: int) -> DataFrame:
    """``code, n, best``: each linked id pair's number of links in all texts, and
    whether it is the highest of its B id (ties included)."""
    counts = stored(linked.groupBy("code").agg(F.sum("n").alias("n")), "pair-counts")
    b_id = F.col("code") % F.lit(width)
    top = counts.groupBy(b_id.alias("b")).agg(F.max("n").alias("top"))
    # One row per id of B's vocabulary, a bound set by the vocabulary file.
    counts = counts.withColumn("b", b_id).join(F.broadcast(top), "b")
    return counts.select("code", "n", (F.col("n") == F.col("top")).alias("best"))


def align_documents(docs: DataFrame, spec_a: str, model_b: bytes, heavy_pairs: int = HEAVY_PAIRS) -> DataFrame:
    """One row per document: sizes, the groups' digest, ``n_best`` (links whose
    pair has its B id's highest count) and ``count_sum`` (counts summed over links)."""
    width = len(Piece(model_b).pieces)
    texts = stored(linked_pairs(docs, spec_a, model_b).withColumn("row", F.monotonically_increasing_id()), "links")
    linked = texts.select("row", F.explode("links").alias("l")).select("row", "l.code", F.col("l.n").alias("times"))
    counts = stored(pair_counts(linked.withColumnRenamed("times", "n"), width), "pair-scores")
    total = counts.agg(F.sum("n")).first()[0] or 0
    heavy = F.col("n").cast("decimal(38,0)") * heavy_pairs >= F.lit(total).cast("decimal(38,0)")
    common, rare = F.broadcast(counts.where(heavy)), counts.where(~heavy)    # common: at most heavy_pairs rows

    def scores(rows: DataFrame) -> DataFrame:
        return rows.groupBy("row").agg(F.sum(F.when(F.col("best"), F.col("times")).otherwise(0)).alias("n_best"),
                                       F.sum(F.col("times") * F.col("n")).alias("count_sum"))

    both = (scores(linked.join(common, "code"))
            .unionByName(scores(linked.join(common.select("code"), "code", "left_anti").join(rare, "code")))
            .groupBy("row").agg(F.sum("n_best").alias("n_best"), F.sum("count_sum").alias("count_sum")))
    zero = F.lit(0).cast("bigint")
    return (texts.drop("links").join(both, "row", "left")
            .select("doc_id", *COUNTS, F.coalesce("n_best", zero).alias("n_best"),
                    F.coalesce("count_sum", zero).alias("count_sum"), "groups_sha256"))
