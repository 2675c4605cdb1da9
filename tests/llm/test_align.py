"""Tokenizer alignment against a brute-force pass over byte ranges."""

import hashlib
import random
from collections import Counter

import numpy as np
import pytest

from packlift.llm import align
from packlift.llm.queries import ALIGNED_A, ALIGNED_B, tokenizer_bytes

SPEC, MODEL = tokenizer_bytes(ALIGNED_A).decode(), tokenizer_bytes(ALIGNED_B)
DOC = "doc_id long, text string, n_links string, row string"
TEXTS = [
    "The quick brown fox jumps over the lazy dog, again and again.", "", None, "a", " leading", "two  blanks\n\nand\tmore ",
    "<|endoftext|> and <s> as plain </s> <unk> text <0x41>", "▁ a lower block", "é 日本語 \U0001F600 \x00 mixed ẞ",
    "naïve ﬁ ligature", "x" * 3000, "antidisestablishmentarianism " * 200, "The quick brown fox", "The quick brown fox",
    "  ", "\n", "1234567890 12 345", "def f(x):\n    return x ** 2  # square\n" * 30,
]


def brute(texts):
    a, b = align.ByteLevel(SPEC), align.Piece(MODEL)
    rows, counts = [], Counter()
    for text in texts:
        text = text or ""
        ids = [v.encode([text])[0].tolist() for v in (a, b)] if text else [[], []]
        if any(b"".join(v.pieces[i] for i in t) != b" " + text.encode() for v, t in zip((a, b), ids)):
            ids = [[], []]
        spans = []
        for v, t in zip((a, b), ids):
            at, got = 0, []
            for i in t:
                got.append((at, at + len(v.pieces[i]), i))
                at = got[-1][1]
            spans.append(got)
        links = [(x[2], y[2]) for x in spans[0] for y in spans[1] if x[0] < y[1] and y[0] < x[1]]
        counts.update(links)
        cuts = sorted({x[1] for x in spans[0]} & {y[1] for y in spans[1]})
        groups, lo = [], 0
        for cut in cuts:
            groups.append("|".join(",".join(str(s[2]) for s in side if lo < s[1] <= cut) for side in spans))
            lo = cut
        rows.append((len(ids[0]), len(ids[1]), len(groups), len(links), links,
                     hashlib.sha256(";".join(groups).encode()).hexdigest() if groups else ""))
    top = Counter()
    for (x, y), n in counts.items():
        top[y] = max(top[y], n)
    return [(*r[:4], sum(counts[p] == top[p[1]] for p in r[4]), sum(counts[p] for p in r[4]), r[5]) for r in rows]


def table(spark, texts):
    return spark.createDataFrame([(i if i != 3 else None, t, "x", "y") for i, t in enumerate(texts)], DOC).repartition(4)


@pytest.mark.parametrize("heavy", [1, 30, align.HEAVY_PAIRS])
def test_equals_brute_force_whatever_is_broadcast(spark, heavy):
    out = align.align_documents(table(spark, TEXTS), SPEC, MODEL, heavy)
    got = {r[0]: tuple(r)[1:] for r in out.collect()}
    for i, want in enumerate(brute(TEXTS)):
        assert got[i if i != 3 else None] == want, (i, TEXTS[i])


def test_given_documents(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    rows = docs.select("doc_id", "text").orderBy("doc_id").limit(12).collect()
    some = [r["text"][:1500] for r in rows]
    got = {r[0]: tuple(r)[1:] for r in align.align_documents(table(spark, some), SPEC, MODEL).collect()}
    assert [got[i if i != 3 else None] for i in range(len(some))] == brute(some)


def test_groups_as_arrays(spark):
    for r in align.alignments(table(spark, TEXTS), SPEC, MODEL).collect():
        assert (r["a_ends"][-1], r["b_ends"][-1]) == (len(r["a_ids"]), len(r["b_ids"])) if r["a_ids"] else not r["a_ends"]


@pytest.mark.parametrize("seed", range(30))
def test_run_skipping_equals_common_ends(seed):
    rng = random.Random(seed)
    n = rng.choice((1, 5, 60, 3000))
    ends = [sorted({n, *rng.sample(range(1, n + 1), rng.randint(1, n))}) for _ in range(2)]
    if seed % 3 == 0:
        ends[1] = sorted(set(ends[0]) - set(ends[0][5:7]) | {n})
    steps, *knots = align.align(*map(np.array, ends))
    left, right = align.links(steps, *knots)
    ends_a, ends_b = align.group_ends(steps)
    assert [ends[0][p - 1] for p in ends_a] == [ends[1][p - 1] for p in ends_b] == sorted(set(ends[0]) & set(ends[1]))
    starts = [[0, *e[:-1]] for e in ends]
    want = [(i, j) for i in range(len(ends[0])) for j in range(len(ends[1]))
            if starts[0][i] < ends[1][j] and starts[1][j] < ends[0][i]] if n <= 60 else None
    assert want is None or sorted(zip(left.tolist(), right.tolist())) == want
    assert len(left) == len(ends[0]) + len(ends[1]) - len(ends_a)


def test_probing_is_logarithmic_on_long_runs():
    class Seen(bytes):
        asked = 0

        def __getitem__(self, key):
            Seen.asked += 1
            return super().__getitem__(key)

    ends = np.arange(1, 50001, dtype="u4").tobytes()
    assert align.run_length(Seen(ends), ends, 0, 0) == 50000
    assert Seen.asked <= 40


def test_short_runs_take_one_probe():
    class Seen(bytes):
        asked = 0

        def __getitem__(self, key):
            Seen.asked += 1
            return super().__getitem__(key)

    for n in [*range(16), 16, 17, 31, 48, 500, 70_000]:
        a, b = np.arange(1, n + 9, dtype="u4"), np.arange(101, n + 109, dtype="u4")
        b[3:3 + n] = a[5:5 + n]     # runs of n on a diagonal, then a difference, or the end of either side
        for cut_a, cut_b in ((len(a), len(b)), (5 + n, len(b)), (len(a), 3 + n), (5 + n, 3 + n)):
            Seen.asked = 0
            got = align.run_length(Seen(a[:cut_a].tobytes()), b[:cut_b].tobytes(), 5, 3)
            assert got == n, (n, cut_a, cut_b, got)
            assert n >= 16 or Seen.asked <= 2, (n, Seen.asked)


def test_joined_bytes_are_compared_whole():
    vocabulary = align.Bytes([b"a", b"bcd", b"", b"\xd0"])
    ids = np.array([0, 1, 2, 3] * 40_000)
    text = np.frombuffer(b"abcd\xd0" * 40_000, dtype=np.uint8)
    assert vocabulary.ends(ids, text).tolist()[:5] == [1, 4, 4, 5, 6]
    for place in (0, 150_000, len(text) - 1):
        other = text.copy()
        other[place] ^= 1
        assert vocabulary.ends(ids, other) is None
    assert vocabulary.ends(ids, text[:-1]) is None and vocabulary.ends(ids[:0], text[:1]) is None


def test_empty_table(spark):
    assert align.align_documents(table(spark, ["a"]).limit(0), SPEC, MODEL).count() == 0


def test_rank_encoder_equals_the_library_on_every_code_point():
    import os

    a = align.ByteLevel(SPEC)
    os.environ["TOKENIZERS_PARALLELISM"] = "true"
    points = [c for c in range(1, 0x110000) if not 0xD800 <= c <= 0xDFFF]
    for at in range(0, len(points), 100_000):
        texts = [f" a{c}{c}1 {c} {c}b  {c}!'s{c}'{c}. {c}{c}{c}x" for c in map(chr, points[at:at + 100_000])]
        want = a._library.encode_batch(texts, add_special_tokens=False)
        assert all(x.ids == a._one(t).tolist() for x, t in zip(want, texts))
    os.environ["TOKENIZERS_PARALLELISM"] = "false"


def test_rank_encoder_equals_the_library_on_documents(spark):
    a = align.ByteLevel(SPEC)
    rows = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("text").collect()
    texts = [r["text"] or "" for r in rows] + ["a" + " " * 30_000 + "b", "\n" * 300_000, "x" * 50_000]
    for t in texts:
        assert a._one(" " + t).tolist() == a._library.encode(" " + t, add_special_tokens=False).ids
