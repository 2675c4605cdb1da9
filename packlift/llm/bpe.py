"""BPE encoding and decoding with a segment tree over adjacent pair ranks.

A word's symbols form a linked list; leaf i of a segment tree holds the merge
rank of the pair that starts at symbol i, and every inner node the least of its
leaves, ties to the left. The root is the leftmost pair of lowest rank: it is
merged, three leaves change (the pair, its right neighbour, the pair before),
and their paths to the root are updated, until no mergeable pair remains. A
word of n symbols costs O(n log n).

Short words are merged many at a time, each with its own tree in a row of one
numpy array; words over ``WIDE`` symbols use ``SegmentTree`` one by one. Nothing
merges across blanks, so each different chunk between blanks is cut into words
once in a slice of texts; Arrow's dictionaries tell which are different and put
the ids back in the texts' order. A task remembers the ids of words (a bounded
number, see ``Known``).

Before that a text is split at special tokens, brought to NFC, its blanks
dropped, lower-cased character by character, and cut into contractions,
letter runs, single digits and runs of other marks, as the vocabulary's file
prescribes; a word's last symbol carries the end-of-word mark.

``decode`` joins the tokens' strings by one space, which is what the file's
missing decoder means. The vocabulary travels as text with the job, so
executors need no file.

Defined cases: a null or empty text has no ids and decodes to the empty text;
repeated rows are each encoded; an empty table gives an empty result; other
columns are ignored.
"""

from __future__ import annotations

import hashlib
import json
import re
import unicodedata
import zlib
from collections.abc import Callable
from itertools import groupby

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import DataFrame

from packlift.llm.common import rows_udf, text_of

WIDE = 64                # symbols; longer words are merged one by one
REMEMBERED = 400_000     # words in a task's memory (some 40 bytes each)
ROWS = 4096              # words merged at a time: their trees stay in a core's cache
END = "</w>"
LINE_END = "\n"
NONE = np.int64(1 << 62)

# The vocabulary's word pattern, a fixed value.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
_EXACT = regex.compile(PATTERN)
# The same for texts without numbers other than decimal digits, in the faster module.
_FAST = re.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[^\W\d_]+|\d|\n|(?:[^\w\s\x1c-\x1f]|[_\x1c-\x1f])+")
_ODD_NUMBER = regex.compile(r"[\p{No}\p{Nl}]")


def byte_characters() -> list[str]:
    """The printable stand-in of each byte: itself if printable in Latin-1, else
    the next free character from 256 on."""
    shown = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    out, spare = {b: chr(b) for b in shown}, 0
    for b in range(256):
        if b not in out:
            out[b] = chr(256 + spare)
            spare += 1
    return [out[b] for b in range(256)]


class SegmentTree:
    """Least value of an array, leftmost on ties, with point updates."""

    def __init__(self, values: list[int]):
        self.size = 1 << max(len(values) - 1, 0).bit_length()
        none = int(NONE)
        self.node = [none] * self.size + values + [none] * (self.size - len(values))
        for i in range(self.size - 1, 0, -1):
            self.node[i] = min(self.node[2 * i], self.node[2 * i + 1])

    def least(self) -> int:
        return self.node[1]

    def update(self, at: int, value: int) -> None:
        node, i = self.node, at + self.size
        node[i] = value
        while i > 1:
            i >>= 1
            low = min(node[2 * i], node[2 * i + 1])
            if node[i] == low:
                break
            node[i] = low


class Vocabulary:
    def __init__(self, json_text: str):
        spec = json.loads(json_text)
        model = spec["model"]
        vocab: dict[str, int] = model["vocab"]
        self.special = {t["content"]: t["id"] for t in spec.get("added_tokens", [])}
        self.size = max([*vocab.values(), *self.special.values()]) + 1
        self.text = np.full(self.size, b"", dtype=object)
        for token, i in [*vocab.items(), *self.special.items()]:
            self.text[i] = token.encode()
        self.number = np.array([str(i).encode() for i in range(self.size)], dtype=object)
        pairs = [tuple(m.split(" ", 1)) if isinstance(m, str) else tuple(m) for m in model["merges"]]
        self.merges = {(vocab[a], vocab[b]): (rank, vocab[a + b]) for rank, (a, b) in enumerate(pairs)}
        keys = np.array([a * self.size + b for a, b in self.merges], dtype=np.int64)
        order = np.argsort(keys)
        self.keys = np.append(keys[order], NONE)
        found = np.array(list(self.merges.values()), dtype=np.int64)
        self.ranks = np.append(found[order, 0], NONE)
        self.merged = found[:, 1]                  # by rank
        chars = byte_characters()
        self.inner = np.array([vocab[c] for c in chars], dtype=np.int64)
        self.last = np.array([vocab[c + END] for c in chars], dtype=np.int64)
        self.specials = re.compile("(" + "|".join(map(re.escape, self.special)) + ")") if self.special else None

    def rank_of(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        key = left * self.size + right
        at = np.searchsorted(self.keys, key)
        return np.where(self.keys[at] == key, self.ranks[at], NONE)

    # ---- merging -------------------------------------------------------------

    def merge_long(self, symbols: list[int]) -> list[int]:
        n, none = len(symbols), int(NONE)
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        width = n.bit_length()

        def leaf(i: int) -> int:
            j = after[i]
            found = self.merges.get((symbols[i], symbols[j])) if j < n else None
            return none if found is None else found[0] << width | i

        tree = SegmentTree([leaf(i) for i in range(n)])
        gone = bytearray(n)
        while (low := tree.least()) != none:
            i = low & ((1 << width) - 1)
            j = after[i]
            symbols[i] = int(self.merged[low >> width])
            gone[j] = 1
            after[i] = after[j]
            if after[j] < n:
                before[after[j]] = i
            tree.update(j, none)
            tree.update(i, leaf(i))
            if before[i] >= 0:
                tree.update(before[i], leaf(before[i]))
        return [s for s, g in zip(symbols, gone) if not g]

    def merge_rows(self, symbols: np.ndarray, lengths: np.ndarray) -> np.ndarray:
        """Merge each row's first ``lengths`` symbols; merged-away places become -1.
        The width is a power of two; a row's tree is stored in one row."""
        rows, width = symbols.shape
        sym = symbols.copy()
        place = np.arange(width)
        valid = place[None, :] < lengths[:, None]
        sym[~valid] = -1
        after = np.broadcast_to(place + 1, sym.shape).astype(np.int64)
        after = np.where(after < lengths[:, None], after, width).ravel()
        before = np.broadcast_to(place - 1, sym.shape).astype(np.int64).ravel().copy()
        tree = np.full((rows, 2 * width), NONE)
        pair = valid[:, :-1] & valid[:, 1:]
        r, c = np.nonzero(pair)
        rank = self.rank_of(sym[r, c], sym[r, c + 1])
        tree[r, width + c] = np.where(rank == NONE, NONE, rank * width + c)
        level = width
        while level > 1:
            half = level // 2
            tree[:, half:level] = np.minimum(tree[:, level:2 * level:2], tree[:, level + 1:2 * level:2])
            level = half
        tree, sym = tree.ravel(), sym.ravel()

        def update(base: np.ndarray, at: np.ndarray, value: np.ndarray) -> None:
            node = at + width
            tree[base + node] = value
            while width >> 1 and node.size and node[0] > 1:
                twin = tree[base + (node ^ 1)]
                np.minimum(value, twin, out=value)
                node = node >> 1
                tree[base + node] = value

        active = np.flatnonzero(tree[1::2 * width] != NONE)
        while active.size:
            base, flat = active * (2 * width), active * width
            low = tree[base + 1]
            i = low % width
            j = after[flat + i]
            sym[flat + i] = self.merged[low // width]
            sym[flat + j] = -1
            k = after[flat + j]
            after[flat + i] = k
            inside = k < width
            before[flat[inside] + k[inside]] = i[inside]
            update(base, j, np.full(len(active), NONE))
            right = np.where(inside, sym[flat + np.minimum(k, width - 1)], -1)
            here = sym[flat + i]
            rank = np.where(right >= 0, self.rank_of(here, np.maximum(right, 0)), NONE)
            update(base, i, np.where(rank == NONE, NONE, rank * width + i))
            h = before[flat + i]
            prior = np.flatnonzero(h >= 0)
            if prior.size:
                hp = h[prior]
                rank = self.rank_of(sym[flat[prior] + hp], here[prior])
                update(base[prior], hp, np.where(rank == NONE, NONE, rank * width + hp))
            active = active[tree[base + 1] != NONE]
        return sym.reshape(rows, width)

    def encode_words(self, words: list[str]) -> list[bytes]:
        """Ids of each word as little-endian 32-bit numbers."""
        return self.encode_array(pa.array(words, pa.large_string())).to_pylist()

    def encode_array(self, words: pa.LargeStringArray) -> pa.LargeBinaryArray:
        """The same for an Arrow array; the empty word has no ids."""
        offsets, data = _offsets(words), np.frombuffer(words.buffers()[2] or b"", dtype=np.uint8)
        start, lengths = offsets[:-1], np.diff(offsets)
        order, ids, counts = [np.flatnonzero(lengths == 0)], [], [np.zeros((lengths == 0).sum(), dtype=np.int64)]
        least = 0
        for width in (2 << k for k in range(WIDE.bit_length() - 1)):
            members = np.flatnonzero((lengths > least) & (lengths <= width))
            least = width
            for lo in range(0, len(members), ROWS):
                part = members[lo:lo + ROWS]
                n = lengths[part]
                symbols = self.inner[data[np.minimum(start[part, None] + np.arange(width), len(data) - 1)]]
                symbols[np.arange(len(part)), n - 1] = self.last[data[start[part] + n - 1]]
                merged = self.merge_rows(symbols, n)
                left = merged >= 0
                order.append(part)
                ids.append(merged[left].astype("<u4"))
                counts.append(left.sum(axis=1))
        for k in np.flatnonzero(lengths > WIDE):
            word = data[start[k]:start[k] + lengths[k]]
            symbols = self.inner[word].tolist()
            symbols[-1] = int(self.last[word[-1]])
            ids.append(np.array(self.merge_long(symbols), dtype="<u4"))
            order.append([k])
            counts.append([len(ids[-1])])
        ends = 4 * np.cumsum(np.concatenate([[0], *counts]).astype(np.int64))
        merged = _binary(ends, pa.py_buffer(np.concatenate([np.empty(0, dtype="<u4"), *ids])))
        return merged.take(pa.array(np.argsort(np.concatenate(order))))

    # ---- texts ----------------------------------------------------------------

    def words_of(self, part: str) -> list[str]:
        """Words of a piece of text that holds no special token."""
        if not part.isascii():
            part = unicodedata.normalize("NFC", part)
            # Lower case letter by letter: no final sigma.
            part = part.replace("Σ", "σ")
            if _ODD_NUMBER.search(part):
                return _EXACT.findall(part.lower())
        return _FAST.findall(part.lower())

    def parts_of(self, chunk: str) -> list[str]:
        """Words and special tokens of a chunk without blanks."""
        if self.specials and "<|" in chunk:
            out: list[str] = []
            for k, part in enumerate(self.specials.split(chunk)):
                out += [part] if k % 2 else self.words_of(part)
            return out
        return self.words_of(chunk)

    def words_by_line(self, lines: str) -> list[str]:
        """Words and special tokens of chunks, a line each, and a line end after each chunk."""
        def odd(text: str) -> bool:
            return "<|" in text or not text.isascii() and _ODD_NUMBER.search(text) is not None

        # All lines at once: nothing matches or composes across lines.
        if not odd(lines):
            return _FAST.findall(unicodedata.normalize("NFC", lines).replace("Σ", "σ").lower())
        out: list[str] = []
        for alone, some in groupby(lines.split(LINE_END)[:-1], odd):
            if alone:
                for chunk in some:
                    out += [*self.parts_of(chunk), LINE_END]
            else:
                out += self.words_of("".join([chunk + LINE_END for chunk in some]))
        return out

    def encode_parts(self, parts: pa.LargeStringArray) -> pa.LargeBinaryArray:
        """Ids of words, special tokens and line ends, which have none."""
        names = [LINE_END, *self.special]
        ids = pa.array([b"", *[i.to_bytes(4, "little") for i in self.special.values()]], pa.large_binary())
        which = pc.index_in(parts, pa.array(names, pa.large_string()))
        return pc.coalesce(ids.take(which), self.encode_array(pc.if_else(which.is_valid(), pa.scalar("", pa.large_string()), parts)))

    def decode(self, ids: np.ndarray) -> bytes:
        return b" ".join(self.text[ids].tolist())


def vocabulary_json(path: str) -> str:
    with open(path, encoding="utf-8") as f:
        return f.read()


def _offsets(array: pa.Array) -> np.ndarray:
    return np.frombuffer(array.buffers()[1], dtype=np.int64)[array.offset:array.offset + len(array) + 1]


def _binary(offsets: np.ndarray, data: pa.Buffer | None) -> pa.LargeBinaryArray:
    buffers = [None, pa.py_buffer(offsets), data or pa.py_buffer(b"")]
    return pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(offsets) - 1, buffers)


class Known:
    """Words seen lately and their ids; when there are too many, only those asked for last stay."""

    def __init__(self):
        self.words = pa.array([], pa.large_string())
        self.ids = pa.array([], pa.large_binary())

    def ids_of(self, words: pa.LargeStringArray,
               learn: Callable[[pa.LargeStringArray], pa.LargeBinaryArray]) -> pa.LargeBinaryArray:
        """Ids of different words; what is not known is learnt."""
        at = pc.index_in(words, self.words)
        new = words.filter(at.is_null())
        found = self.ids
        if len(new):
            lacking = at.is_null().to_numpy(zero_copy_only=False)
            at = at.fill_null(0).to_numpy().astype(np.int64)
            at[lacking] = len(found) + np.arange(len(new))
            found = pa.concat_arrays([found, learn(new)])
        ids = found.take(pa.array(at))
        if len(found) > REMEMBERED:
            self.words, self.ids = words, ids
        elif len(new):
            self.words, self.ids = pa.concat_arrays([self.words, new]), found
        return ids


_VOCABULARIES: dict[int, Vocabulary] = {}


def vocabulary(json_text: str) -> Vocabulary:
    """The vocabulary, built once per Python worker; it does not change with the texts."""
    name = zlib.crc32(json_text.encode())
    if name not in _VOCABULARIES:
        _VOCABULARIES.clear()
        _VOCABULARIES[name] = Vocabulary(json_text)
    return _VOCABULARIES[name]


def _joined_ids(strings: pa.LargeStringArray, ends: np.ndarray,
                ids_of: Callable[[pa.LargeStringArray], pa.LargeBinaryArray]) -> pa.LargeBinaryArray:
    """The ids of all the strings in a row, cut where so many strings end; each
    different string is looked up once."""
    coded = strings.dictionary_encode()
    run = ids_of(coded.dictionary).take(coded.indices)
    return _binary(_offsets(run)[np.concatenate([[0], ends])], run.buffers()[2])


def _chunk_ids(vocab: Vocabulary, known: Known, chunks: pa.LargeStringArray) -> pa.LargeBinaryArray:
    lines = "".join([chunk + LINE_END for chunk in chunks.to_pylist()])
    words = pa.array(vocab.words_by_line(lines), pa.large_string())
    ends = np.flatnonzero(pc.equal(words, LINE_END).to_numpy(zero_copy_only=False)) + 1
    return _joined_ids(words, ends, lambda different: known.ids_of(different, vocab.encode_parts))


def encoder(json_text: str):
    """A function from texts to their ids as little-endian 32-bit numbers.

    What it remembers of the texts is its own and goes with it, at the end of
    its task: a reused Python worker keeps nothing of them.
    """
    vocab, known = vocabulary(json_text), Known()

    def encode(texts: list[str]) -> list[bytes]:
        # Chunks end at ASCII blanks; other blanks inside one are dropped as it is cut into words.
        split = pc.ascii_split_whitespace(pa.array(texts, pa.large_string()))
        ends = split.offsets.to_numpy()[1:]
        return _joined_ids(split.values, ends, lambda chunks: _chunk_ids(vocab, known, chunks)).to_pylist()

    return encode


REPORT = "n_tokens long, ids_sha256 string, decoded_sha256 string"


def bpe(docs: DataFrame, json_text: str) -> DataFrame:
    """Token counts and digests of the ids and of the decoded text of every row."""
    def make():
        encode = encoder(json_text)
        vocab = vocabulary(json_text)

        def work(texts: list[str]) -> list[tuple]:
            out = []
            for data in encode(texts):
                ids = np.frombuffer(data, dtype="<u4")
                out.append((len(ids), hashlib.sha256(b" ".join(vocab.number[ids].tolist())).hexdigest(),
                            hashlib.sha256(vocab.decode(ids)).hexdigest()))
            return out

        return work

    return docs.select("doc_id", rows_udf(make, REPORT)(text_of()).alias("r")).select("doc_id", "r.*")
