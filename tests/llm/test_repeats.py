"""Repeated substrings against a dictionary of all windows, and the suffix array against sorting."""

import hashlib
import random
from collections import Counter

import numpy as np
import pytest

from packlift.llm import repeats
from packlift.llm.suffix_array import lyndon_groups, suffix_array

DOC = "doc_id long, text string, row string, key long"


def brute(texts, length):
    texts = [(t or "").encode() for t in texts]
    seen = Counter(t[i:i + length] for t in texts for i in range(len(t) - length + 1))
    out = []
    for t in texts:
        gone = bytearray(len(t))
        for i in range(len(t) - length + 1):
            if seen[t[i:i + length]] > 1:
                gone[i:i + length] = b"\1" * length
        kept = bytes(b for b, g in zip(t, gone) if not g)
        spans = sum(1 for i, g in enumerate(gone) if g and (i == 0 or not gone[i - 1]))
        out.append((len(t), sum(gone), spans, hashlib.sha256(kept).hexdigest()))
    return out


def table(spark, texts):
    return spark.createDataFrame([(i, t, "x", 1) for i, t in enumerate(texts)], DOC).repartition(3)


def equal(spark, texts, length, **options):
    rows = repeats.repeat_digests(table(spark, texts), length=length, **options).collect()
    got = {r["doc_id"]: tuple(r)[1:] for r in rows}
    assert len(rows) == len(texts)
    for i, want in enumerate(brute(texts, length)):
        assert got[i] == want, (i, texts[i])


def made(seed, n=40):
    rng = random.Random(seed)
    words = ["".join(rng.choice("abcé\0") for _ in range(rng.randint(1, 4))) for _ in range(30)]

    def prose(k):
        return " ".join(rng.choice(words) for _ in range(k))

    shared = [prose(k) for k in (6, 9, 12, 40)]
    out = [None, "", "ab", shared[3], shared[3]]
    for _ in range(n):
        parts = [rng.choice(shared) if rng.random() < 0.5 else prose(rng.randint(1, 30)) for _ in range(rng.randint(1, 4))]
        out.append("".join(parts))
    return out + ["a" * 100, "ab" * 60]


@pytest.mark.parametrize("seed,length,gram,crowded", [(1, 20, 6, 1024), (2, 20, 6, 2), (3, 31, 10, 1), (4, 12, 12, 3)])
def test_equals_all_windows(spark, seed, length, gram, crowded):
    """Also with every key split, down to single windows."""
    equal(spark, made(seed), length, gram=gram, crowded=crowded)


def test_passage_in_many_texts_is_split(spark):
    rng = random.Random(5)
    passage = "".join(rng.choice("abcdefgh ") for _ in range(70))
    texts = ["".join(rng.choice("abcdefgh ") for _ in range(60)) + passage + "".join(rng.choice("ijkl ") for _ in range(60))
             for _ in range(60)]
    equal(spark, texts, 50, gram=16, crowded=8)
    equal(spark, texts, 69, gram=16, crowded=8)


def test_production_length_on_given_documents(spark):
    rows = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("text").collect()
    equal(spark, [r["text"][:20_000] for r in rows[:150]], 200)


def test_long_texts_are_looked_at_in_chunks():
    rng = random.Random(6)
    text = bytes(rng.choice(b"abcd ") for _ in range(5000))
    whole, parts = repeats.Anchors(50, 16), repeats.Anchors(50, 16, chunk=700)
    windows = [{f + i: (k, f + p) for k, _, f, n, p in a.of(text).tolist() for i in range(n)} for a in (whole, parts)]
    assert windows[0] == windows[1] and sorted(windows[0]) == list(range(len(text) - 49))


def test_anchors_depend_on_the_window_alone():
    rng = random.Random(7)
    anchors = repeats.Anchors(40, 12)
    same = bytes(rng.choice(b"ab") for _ in range(400))
    found = []
    for before in (b"", b"xyz" * 30):
        text = before + same + b"tail" * 20
        found.append({f + i - len(before): (k, f + p - len(before)) for k, _, f, n, p in anchors.of(text).tolist()
                      for i in range(n) if 0 <= f + i - len(before) <= 360})
    assert found[0] == found[1]


def test_segment_hashes_tell_segments_apart():
    rng = random.Random(10)
    text = bytes(rng.choice(b"ab") for _ in range(30_000)) + b"a" * 3000 + b"ab" * 2000
    anchors, seen = repeats.Anchors(40, 8, chunk=5000), {}
    for _, sid, first, n, _ in anchors.of(text).tolist():
        assert seen.setdefault(sid, text[first:first + n + 39]) == text[first:first + n + 39]
    assert len(seen) == len(set(seen.values())) > 100


@pytest.mark.parametrize("windows", [1, 3, 8])
def test_split_units_hold_every_window_once_with_keys_of_its_own_bytes(windows):
    rng = random.Random(8)
    text = bytes(rng.choice(b"abcdefg") for _ in range(600))
    keys = {}
    for cut in (0, 37):        # the same bytes from another start: other runs, same keys
        for key, _, first, n, ahead in repeats.Anchors(60, 20).of(text[cut:]).tolist():
            seg = text[cut + first:cut + first + n + 59]
            seen = []
            for code, part, at in repeats.split_unit(seg, ahead, windows, 60):
                count = len(part) - 59
                assert 1 <= count <= windows and seg[at:at + len(part)] == part
                seen += range(at, at + count)
                for i in range(count):
                    assert keys.setdefault(part[i:i + 60], code) == code
            assert seen == list(range(n))


@pytest.mark.parametrize("seed", range(20))
def test_suffix_array_equals_sorting(seed):
    rng = random.Random(seed)
    for _ in range(60):
        n, k = rng.randint(0, 60), rng.choice((1, 2, 3, 200))
        text = [rng.randrange(k) for _ in range(n)]
        if rng.random() < 0.4:
            text = (text[:6] * 20)[:n]
        assert suffix_array(np.array(text, dtype=np.int64)) == sorted(range(n), key=lambda i: text[i:])


def test_groups_share_their_lyndon_prefix():
    def lyndon(t):       # the longest prefix that is smaller than all its proper suffixes
        return max(t[:k] for k in range(1, len(t) + 1) if all(t[:k] < t[i:k] for i in range(1, k)))

    rng = random.Random(9)
    for _ in range(100):
        text = [rng.randrange(3) for _ in range(rng.randint(1, 30))]
        group, prev, order = lyndon_groups(np.array(text))
        prefix = {}
        for i, g in enumerate(group):
            assert prefix.setdefault(g, lyndon(text[i:])) == lyndon(text[i:])
        assert [prefix[g] for g in order] == sorted(prefix.values(), reverse=True)


def test_empty_table(spark):
    assert repeats.repeat_digests(table(spark, ["a"]).limit(0)).count() == 0
