"""Secret scans with a linear-chain conditional random field.

Base spans, always reported: ``assign`` (a password-like name, ``:`` or ``=``,
and a value of 8 or more characters), ``access`` (AKIA keys of 16 or more) and
``hex`` (runs of 32 or more). The field adds ``crf`` spans that overlap no base
span.

**Lattice.** Text is cut into tokens between blanks, quotes, brackets and
``= : , ; | &``; ``=`` and ``:`` are tokens themselves. Every token is tagged
B(egin), I(nside) or O(utside) of a secret; a line is a chain. Tokens that are
outside on every best path (``Field.outside``) cut the chain, so what lies between
them is decoded alone, exactly.

**Features** of a token: its shape (length, character classes, share of digits
of vowels and of distinct characters, hexadecimal, numeric, dotted, known prefix), its
neighbour words (separators, secret-like names within three tokens, line ends)
and the file's features (whether it names secrets, has code marks, how many
unusual tokens it holds).

**Training** maximises the regularised likelihood by forward-backward over a
bounded sample of each class (``TRAIN_DOCS`` texts with a base span and as many
without, ``TRAIN_CHARS`` characters of each, in hash order over the whole table, and
``TRAIN_RUNS`` runs of each kind), labelled by the base rules' values and
widened by rewritten assignments (``variants``). **Decoding** is Viterbi;
a run of B and I of ``SHORTEST`` or more characters becomes a span. Every text is scanned whole.

Defined cases: a null or empty text has no spans; repeated rows are each
reported; an empty table gives an empty result; without base spans in the
table nothing is added; other columns are ignored.
"""

from __future__ import annotations

import base64
import hashlib
import re

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from packlift.llm.common import hex_digest, rows_udf, stored, text_of

BASE_KINDS = ("assign", "access", "hex")
TRAIN_DOCS = 4000       # texts of each class, with a base span and without
TRAIN_CHARS = 20_000    # characters of a text to fit on
TRAIN_RUNS = 1500       # runs of each kind to fit on, at least (at most twice as many)
SHORT = 8               # shorter tokens look plain
SHORTEST = 8            # characters of an added span, as of a base rule's value
WORDS = 200_000         # distinct tokens that a task remembers
GROUP_CHARS = 200_000   # characters of texts decoded together, unless one text alone has more
EPOCHS = 200
RIDGE = 1e-3
O, B, I = 0, 1, 2

_ASSIGN = re.compile(r"""(?ia:(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+))""")
_ACCESS = re.compile(r"AKIA[A-Z0-9]{12,}+")
_HEX = re.compile(r"(?<![0-9a-f])[0-9a-f]{32,}+")
_NAME = re.compile(r"(?ia:pass|secret|token|key|auth|bearer|credential|pwd|akia)")

_TOKEN = re.compile(r"""[^\s"'`,;:()<>{}\[\]|=&]+|[=:]|\n""")
_CODE = re.compile(r"[{};=]")
_TRIM = ".!?*"
PREFIXES = ("AKIA", "ASIA", "ghp_", "gho_", "sk-", "sk_", "pk_", "xox", "AIza", "eyJ", "glpat-")   # fixed values


def base_spans(text: str) -> list[tuple[str, int, int]]:
    """Base spans by start, then kind as listed."""
    found = [(m.start(), 0, m.end()) for m in _ASSIGN.finditer(text) if len(m[2]) >= 8] if _has_name(text) else []
    if "AKIA" in text:
        found += [(m.start(), 1, m.end()) for m in _ACCESS.finditer(text)]
    found += [(m.start(), 2, m.end()) for m in _HEX.finditer(text)]
    return [(BASE_KINDS[k], a, b) for a, k, b in sorted(found)]


def _has_name(text: str) -> bool:
    return _ASSIGN_NAME.search(text) is not None


_ASSIGN_NAME = re.compile(r"(?ia:password|passwd|secret|token|api_?key)")


def values(text: str) -> list[tuple[int, int]]:
    """Where the base rules see the secret itself: an assignment's value, a whole key."""
    out = [m.span(2) for m in _ASSIGN.finditer(text) if len(m[2]) >= 8]
    return out + [m.span() for m in _ACCESS.finditer(text)] + [m.span() for m in _HEX.finditer(text)]


# ---- tokens and features -----------------------------------------------------

class Run:
    """Consecutive tokens of a line: their places and features."""
    __slots__ = ("spans", "features", "odd")

    def __init__(self):
        self.spans: list[tuple[int, int]] = []
        self.features: list[list[int]] = []
        self.odd = None                # which tokens are unusual or hold a name


def _bucket(value: float, edges: tuple) -> int:
    return sum(value >= e for e in edges)


_SIZES = {"bias": 1, "length": 10, "classes": 16, "digits": 6, "distinct": 6, "hex": 4, "number": 2, "dotted": 3,
          "prefix": 2, "inner": 2, "hex_length": 20, "mixed_length": 20, "vowels": 5,
          "before": 6, "named": 4, "after": 4, "named_length": 20, "named_classes": 32, "named_vowels": 10,
          "file_names": 2, "file_code": 2, "file_unusual": 4}
_AT = {}
N_FEATURES = 0
for _name, _size in _SIZES.items():
    _AT[_name] = N_FEATURES
    N_FEATURES += _size
SHAPES = 13                                             # features of a token alone
LENGTH, CLASSES, VOWELS, NAME, PLAIN, CODE = range(SHAPES, SHAPES + 6)   # and further columns of its row
LINE_END, EQUALS, COLON, WORD = range(4)
PAD = ("\n",) * 3                                       # as far as a name is looked for


LOWER, UPPER, DIGIT, VOWEL, LETTER, MARK, HEXA, NUMERIC = (1 << k for k in range(8))
_KINDS = np.zeros(0x110000, dtype=np.uint8)


def _kinds() -> np.ndarray:
    """What each code point counts as."""
    if not _KINDS[ord("a")]:
        for point in range(len(_KINDS)):
            c = chr(point)
            _KINDS[point] = LETTER if c.isalpha() else 0 if c.isalnum() else MARK
        for kind, chars in ((LOWER, "abcdefghijklmnopqrstuvwxyz"), (UPPER, "ABCDEFGHIJKLMNOPQRSTUVWXYZ"), (DIGIT, "0123456789"),
                            (VOWEL, "aeiouyAEIOUY"), (HEXA, "0123456789abcdefABCDEF"), (NUMERIC, "0123456789.,()+/-")):
            _KINDS[[ord(c) for c in chars]] |= kind
    return _KINDS


def _buckets(values: np.ndarray, edges: tuple) -> np.ndarray:
    return np.searchsorted(edges, values, side="right")


def _rows(wholes: list[str]) -> np.ndarray:
    """Each token's own features, and what the features of its place need."""
    tokens = [w.rstrip(_TRIM) or w for w in wholes]
    n = np.fromiter(map(len, tokens), np.int64, len(tokens))
    starts = np.cumsum(n) - n
    joined = "".join(tokens)
    kinds = _kinds()[np.frombuffer(joined.encode("utf-32-le", "surrogatepass"), dtype=np.uint32)]
    lower, upper, digits, vowels, letters, marks, hexas, numerics = (
        np.add.reduceat((kinds & kind > 0).astype(np.int64), starts) for kind in (LOWER, UPPER, DIGIT, VOWEL, LETTER, MARK, HEXA, NUMERIC))
    rise = np.zeros(len(kinds), dtype=np.int64)
    rise[:-1] = (kinds[:-1] & LOWER > 0) & (kinds[1:] & UPPER > 0)
    rise[starts[1:] - 1] = 0
    unusual = (digits > 0) | (np.add.reduceat(rise, starts) > 0)
    whole_n = np.fromiter(map(len, wholes), np.int64, len(wholes))
    named = np.zeros(len(tokens), dtype=np.int64)           # no part of a name is trimmed or a blank
    ends = np.cumsum(n + 1)
    named[np.searchsorted(ends, [m.start() for m in _NAME.finditer("\n".join(tokens))], side="right")] = 1
    distinct = np.fromiter((len(set(t)) for t in tokens), np.int64, len(tokens))
    length = _buckets(n, (4, 8, 12, 16, 20, 24, 32, 40, 64))
    hexa = hexas == n
    dotted = np.fromiter((2 if "@" in t else 1 if "." in t else 0 for t in tokens), np.int64, len(tokens))
    prefix = np.fromiter((t.startswith(PREFIXES) for t in tokens), np.int64, len(tokens))
    code = np.fromiter((_CODES.get(w, WORD) for w in wholes), np.int64, len(wholes))
    some = [(x > 0).astype(np.int64) for x in (lower, upper, digits, marks)]
    mixed = some[0] + some[1] + some[2] >= 3
    classes = some[0] + 2 * some[1] + 4 * some[2] + 8 * some[3]
    part_hexa = hexa & (digits > 0) & (digits < n)
    vowel = np.where(letters > 0, _buckets(vowels / np.maximum(letters, 1), (0.15, 0.3, 0.6)), 4)
    return np.stack([
        np.full(len(tokens), _AT["bias"]), _AT["length"] + length, _AT["classes"] + classes,
        _AT["digits"] + _buckets(digits / n, (0.01, 0.2, 0.4, 0.7, 0.999)),
        _AT["distinct"] + _buckets(distinct / np.minimum(n, 32), (0.2, 0.35, 0.5, 0.7, 0.85)),
        _AT["hex"] + hexa + 2 * part_hexa, _AT["number"] + (numerics == n), _AT["dotted"] + dotted, _AT["prefix"] + prefix,
        _AT["inner"] + named, _AT["hex_length"] + 10 * part_hexa + length, _AT["mixed_length"] + 10 * mixed + length,
        _AT["vowels"] + vowel, length, classes, vowel, named, (whole_n < SHORT) | ~unusual, code], axis=1)


_CODES = {"\n": LINE_END, "=": EQUALS, ":": COLON}


class Words:
    """Rows of tokens, remembered up to ``WORDS`` of them."""

    def __init__(self, weights: np.ndarray | None = None):
        self.weights = weights
        self.clear()

    def clear(self) -> None:
        self.ids: dict[str, int] = {}
        self.rows = np.zeros((1024, SHAPES + 6), dtype=np.int16)
        self.scores = np.zeros((2, 1024, 3))       # of the features that only the token and a name nearby decide

    def of(self, tokens: list[str]) -> np.ndarray:
        """Row numbers of ``tokens``."""
        try:
            return np.fromiter(map(self.ids.__getitem__, tokens), np.int64, len(tokens))
        except KeyError:
            pass
        if len(self.ids) > WORDS:
            self.clear()
        start = len(self.ids)
        new = [t for t in dict.fromkeys(tokens) if t not in self.ids]
        end = start + len(new)
        if end > len(self.rows):
            size = max(end, 2 * len(self.rows))
            self.rows = np.concatenate([self.rows[:start], np.zeros((size - start, SHAPES + 6), dtype=np.int16)])
            self.scores = np.concatenate([self.scores[:, :start], np.zeros((2, size - start, 3))], axis=1)
        self.rows[start:end] = _rows(new)
        self.ids.update(zip(new, range(start, end)))
        if self.weights is not None:
            rows = self.rows[start:end]
            for named in (0, 1):
                at = np.hstack([rows[:, :SHAPES], _beside(rows, named)])
                self.scores[named, start:end] = self.weights[at].sum(axis=1)
        return np.fromiter(map(self.ids.__getitem__, tokens), np.int64, len(tokens))


def _beside(rows: np.ndarray, named) -> np.ndarray:
    """The features of a token together with whether a secret-like name is near."""
    return np.stack([_AT["named_length"] + 10 * named + rows[:, LENGTH], _AT["named_classes"] + 16 * named + rows[:, CLASSES],
                     _AT["named_vowels"] + 5 * named + rows[:, VOWELS]], axis=1)


def _places(rows: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """For each token what stands before it, how near a name is, and what follows."""
    n = len(rows)
    code, plain, name = rows[:, CODE], rows[:, PLAIN], rows[:, NAME] > 0
    kind = np.select([code == LINE_END, code == EQUALS, code == COLON, name, plain > 0], [0, 1, 2, 3, 4], 5)
    before, named = np.zeros(n, dtype=np.int64), np.zeros(n, dtype=np.int64)
    before[1:] = kind[:-1]
    for back in (3, 2, 1):
        if n > back:
            named[back:][name[:-back]] = back
    after = np.zeros(n, dtype=np.int64)
    after[:-1] = np.select([code == LINE_END, code != WORD, plain > 0], [0, 1, 2], 3)[1:]
    return before, named, after


def _file(text: str, rows: np.ndarray) -> list[int]:
    share = np.count_nonzero(rows[:, PLAIN] == 0) / len(rows)
    return [_AT["file_names"] + bool(rows[:, NAME].any()), _AT["file_code"] + bool(_CODE.search(text)),
            _AT["file_unusual"] + _bucket(share, (0.01, 0.05, 0.2))]


def _token_spans(text: str) -> list[tuple[int, int]]:
    return [(m.start(), m.start() + len(m[0].rstrip(_TRIM) or m[0])) for m in _TOKEN.finditer(text)]


def runs_of(text: str, words: Words) -> list[Run]:
    """The lines of a text, all their tokens with their features."""
    tokens = _TOKEN.findall(text)
    if not tokens:
        return []
    ids = words.of(tokens)
    rows = words.rows[ids]
    before, named, after = _places(rows)
    features = np.hstack([rows[:, :SHAPES], _beside(rows, named > 0), np.stack(
        [_AT["before"] + before, _AT["named"] + named, _AT["after"] + after], axis=1),
        np.tile(_file(text, rows), (len(rows), 1))]).astype(np.int16)
    spans = _token_spans(text)
    odd = (rows[:, PLAIN] == 0) | (rows[:, NAME] > 0)
    runs = []
    lo = 0
    for hi in [*np.flatnonzero(rows[:, CODE] == LINE_END).tolist(), len(tokens)]:
        if hi > lo:
            run = Run()
            run.spans, run.features, run.odd = spans[lo:hi], features[lo:hi], odd[lo:hi]
            runs.append(run)
        lo = hi + 1
    return runs


# ---- the field -----------------------------------------------------------------

ALLOWED = np.array([[1, 1, 0], [1, 1, 1], [1, 1, 1]], dtype=bool)    # from O, B, I: no I after O


class Field:
    def __init__(self, weights: np.ndarray, moves: np.ndarray):
        self.weights = weights              # (N_FEATURES, 3)
        self.moves = np.where(ALLOWED, moves, -np.inf)
        at = _AT["before"], _AT["named"], _AT["after"]
        w = [weights[a:a + _SIZES[k]] for a, k in zip(at, ("before", "named", "after"))]
        self.around = (w[0][:, None, None] + w[1][None, :, None] + w[2][None, None]).reshape(-1, 3)
        self.words = None

    def __getstate__(self):
        return self.__dict__ | {"words": None}

    def tags(self, run: Run) -> list[int]:
        """Viterbi; before and after the run the state is O."""
        return self.best(self.weights[np.array(run.features)].sum(axis=1))

    def best(self, scores: np.ndarray) -> list[int]:
        moves = self.moves
        value = scores[0] + moves[O]
        back = []
        for row in scores[1:]:
            options = value[:, None] + moves
            back.append(options.argmax(axis=0))
            value = options.max(axis=0) + row
        state = int((value + moves[:, O]).argmax())
        out = [state]
        for pointer in reversed(back):
            state = int(pointer[state])
            out.append(state)
        return out[::-1]

    def outside(self, scores: np.ndarray) -> np.ndarray:
        """Tokens that are O on every best path: putting O there, and B after it
        where I followed, makes any other path better."""
        m = self.moves
        follow = np.full(len(scores), np.inf)
        follow[:-1] = (scores[:, B] - scores[:, I])[1:] + (m[B] - m[I]).min()
        sure = np.ones(len(scores), dtype=bool)
        for s, earlier in ((B, (O, B, I)), (I, (B, I))):
            gain = scores[:, O] - scores[:, s] + min(m[p, O] - m[p, s] for p in earlier)
            gain += np.minimum(min(m[O, O] - m[s, O], m[O, B] - m[s, B]), m[O, B] - m[s, I] + follow)
            sure &= gain > 0
        return sure

    def scores(self, texts: list[str], tokens: list[list[str]]) -> tuple[np.ndarray, np.ndarray]:
        """Score of each tag of each token, and where lines end; ``PAD`` line
        ends keep each text's tokens from the next text's."""
        if self.words is None:
            self.words = Words(self.weights)
        ids = self.words.of([t for part in tokens for t in (*part, *PAD)])
        rows = self.words.rows[ids]
        before, named, after = _places(rows)
        scores = self.words.scores[(named > 0).astype(np.int64), ids]
        scores += self.around[(before * _SIZES["named"] + named) * _SIZES["after"] + after]
        lo = 0
        for text, part in zip(texts, tokens):
            if part:
                scores[lo:lo + len(part)] += self.weights[_file(text, rows[lo:lo + len(part)])].sum(axis=0)
            lo += len(part) + len(PAD)
        return scores, rows[:, CODE] == LINE_END

    def spans(self, text: str) -> list[tuple[int, int]]:
        return self.spans_of([text])[0]

    def spans_of(self, texts: list[str]) -> list[list[tuple[int, int]]]:
        """The spans of each text, read some texts at a time."""
        out: list = []
        group: list[str] = []
        for text in texts:
            if group and sum(map(len, group)) + len(text) > GROUP_CHARS:
                out += self._group(group)
                group = []
            group.append(text)
        return out + self._group(group) if group else out

    def _group(self, texts: list[str]) -> list[list[tuple[int, int]]]:
        tokens = [_TOKEN.findall(t) for t in texts]
        scores, ends = self.scores(texts, tokens)
        # A chain may be cut wherever the best path is sure to be outside.
        open_ = np.flatnonzero(~(self.outside(scores) | ends))
        out, lo = [], 0
        for text, part in zip(texts, tokens):
            a, b = np.searchsorted(open_, [lo, lo + len(part)])
            out.append(self._text(text, scores[lo:lo + len(part)], open_[a:b] - lo) if b > a else [])
            lo += len(part) + len(PAD)
        return out

    def _text(self, text: str, scores: np.ndarray, open_: np.ndarray) -> list[tuple[int, int]]:
        out = []
        places = None
        for part in np.split(open_, np.flatnonzero(np.diff(open_) > 1) + 1):
            tags = self.best(scores[part])
            if not any(tags):
                continue
            places = places or _token_spans(text)
            begin = end = None
            for (a, b), tag in zip(places[part[0]:part[-1] + 1], tags):
                if tag == I and begin is not None:
                    end = b
                    continue
                if begin is not None:
                    out.append((begin, end))
                begin, end = (a, b) if tag != O else (None, None)
            if begin is not None:
                out.append((begin, end))
        return [(a, b) for a, b in out if b - a >= SHORTEST]


def variants(text: str) -> list[tuple[str, list[tuple[int, int]]]]:
    """Rewritten assignments of a text, with where their secret is: the value in
    other alphabets, from 8 characters and also of letters only, and in other
    wordings, and the same value away from any name or an ordinary word beside
    one, where it is none. They teach the field that shape and neighbours count
    together, beyond the base rules' own notation."""
    out = []
    ordinary = None
    for m in _ASSIGN.finditer(text):
        if len(m[2]) < 8:
            continue
        if ordinary is None:
            ordinary = sorted({w for w in _TOKEN.findall(text) if w.isalpha() and w.islower() and len(w) >= 4}) or ["value"]
        name = m[1]
        digest = hashlib.sha256(m[2].encode()).digest()
        raw = base64.b64encode(digest).decode().replace("+", "x").replace("/", "7")
        letters = "".join(c for c in raw if c.isalpha())
        first, second, third = (ordinary[d % len(ordinary)] for d in digest[:3])
        long, short = 12 + digest[3] % 28, 8 + digest[4] % 4
        made = [raw[:long], raw[:short], raw[:short].lower(), first + str(1000 + digest[5] * 35), letters[:short + 4].lower(),
                letters[:short + 8].upper(), f"{first}-{second}", f"{first.capitalize()}{second.capitalize()}"]
        for k, value in enumerate(made):
            if len(value) < 8:
                continue
            for before in (f"the {name} is ", f"{name} ", f"my {name}: \"")[:1 if k else 3]:
                for after in (" and", ""):
                    out.append((f"{before}{value}{after}", [(len(before), len(before) + len(value))]))
            out.append((f"see item {value} of", []))
        for word in (first, second, third, max(ordinary, key=len)):
            out += [(f"the {name} is {word} and", []), (f"{name} {word}", [])]
    return out


class Spread:
    """Evenly spread items of a sequence of unknown length: all up to twice ``least``, then at least that many."""

    def __init__(self, least: int):
        self.least, self.step, self.seen, self.items = least, 1, 0, []

    def wants(self) -> bool:
        """Whether the next item of the sequence is to be appended."""
        if len(self.items) >= 2 * self.least:
            self.items, self.step = self.items[::2], 2 * self.step
        self.seen += 1
        return (self.seen - 1) % self.step == 0


def labelled(texts: list[str]) -> tuple[list[Run], list[list[int]]]:
    """Training runs, lines cut at 32 tokens, with the tags that the base rules
    give. Of the runs with a secret, of those without that hold an unusual
    token or a name, and of the ordinary ones an even spread each."""
    words = Words()
    kinds = Spread(TRAIN_RUNS), Spread(TRAIN_RUNS), Spread(TRAIN_RUNS)
    for source in texts:
        for text, secret in [(source, values(source)), *variants(source)]:
            for run in runs_of(text, words):
                row, inside = [O] * len(run.spans), False
                for k, (a, b) in enumerate(run.spans if secret else ()):
                    hit = any(x < b and a < y for x, y in secret)
                    row[k] = (I if inside else B) if hit else O
                    inside = hit
                for lo in range(0, len(row), 32):
                    cut = row[lo:lo + 32]
                    kind = kinds[0 if any(cut) else 1 if run.odd[lo:lo + 32].any() else 2]
                    if kind.wants():
                        part = Run()
                        part.spans, part.features = run.spans[lo:lo + 32], run.features[lo:lo + 32].copy()
                        kind.items.append((part, [B if k == 0 and t == I else t for k, t in enumerate(cut)]))
    chosen = [item for kind in kinds for item in kind.items]
    return [run for run, _ in chosen], [tags for _, tags in chosen]


def fit(texts: list[str]) -> Field | None:
    """Maximum likelihood by gradient steps (Adam) on padded runs; None if the
    sample holds no secret."""
    runs, tags = labelled(texts)
    if not any(B in t for t in tags):
        return None
    width = max(map(len, tags))
    n = len(runs)
    gold = np.zeros((n, width), dtype=int)
    mask = np.zeros((n, width), dtype=bool)
    for r, tag in enumerate(tags):
        gold[r, :len(tag)] = tag
        mask[r, :len(tag)] = True
    # Many tokens have the same features: their scores and gradients are taken once.
    rows, inverse = np.unique(np.concatenate([run.features for run in runs]), axis=0, return_inverse=True)
    index = np.full((n, width), len(rows))
    index[mask] = inverse.ravel()
    k = rows.shape[1]
    rows = np.vstack([rows, np.full((1, k), N_FEATURES)]).astype(np.int64)
    weights, moves = np.zeros((N_FEATURES + 1, 3)), np.zeros((3, 3))
    state = [np.zeros_like(weights), np.zeros_like(weights), np.zeros_like(moves), np.zeros_like(moves)]
    length = mask.sum(axis=1)
    want_moves = np.zeros((3, 3))
    np.add.at(want_moves, (np.zeros(n, dtype=int), gold[:, 0]), 1)
    for t in range(1, width):
        at = mask[:, t]
        np.add.at(want_moves, (gold[at, t - 1], gold[at, t]), 1)
    np.add.at(want_moves, (gold[np.arange(n), length - 1], np.zeros(n, dtype=int)), 1)
    eye = np.eye(3)
    for epoch in range(1, EPOCHS + 1):
        # Forward-backward with every step's values scaled to sum 1.
        step = np.where(ALLOWED, np.exp(moves), 0)
        scores = (weights[rows].sum(axis=1))[index.T]
        local = np.exp(scores - scores.max(axis=2, keepdims=True))
        forward, backward, scale = np.zeros((width, n, 3)), np.tile(step[:, O], (width, n, 1)), np.ones((width, n, 1))
        for t in range(width):
            value = (forward[t - 1] @ step if t else step[O]) * local[t]
            scale[t] = value.sum(axis=1, keepdims=True)
            forward[t] = np.where(mask[:, t, None], value / scale[t], forward[t - 1])
        for t in range(width - 2, -1, -1):
            value = (local[t + 1] * backward[t + 1] / scale[t + 1]) @ step.T
            backward[t] = np.where(mask[:, t + 1, None], value, step[:, O])
        total = (forward[-1] * step[:, O]).sum(axis=1)[:, None]
        here = (forward * backward / total).transpose(1, 0, 2) * mask[:, :, None]
        moved = np.zeros((3, 3))
        moved[O] += here[:, 0].sum(axis=0)
        for t in range(1, width):
            moved += step * (forward[t - 1].T @ (local[t] * backward[t] / (scale[t] * total) * mask[:, t, None]))
        moved[:, O] += here[np.arange(n), length - 1].sum(axis=0)
        error = here - eye[gold] * mask[:, :, None]
        of_rows = np.stack([np.bincount(index.ravel(), error[:, :, t].ravel(), len(rows)) for t in range(3)], axis=1)
        grad = np.zeros_like(weights)
        for f in range(k):
            for t in range(3):
                grad[:, t] += np.bincount(rows[:, f], of_rows[:, t], len(grad))
        grad = grad / n + RIDGE * weights
        grad[N_FEATURES] = 0
        grad_moves = np.where(ALLOWED, (moved - want_moves) / n, 0) + RIDGE * moves
        for value, g, m, v in ((weights, grad, state[0], state[1]), (moves, grad_moves, state[2], state[3])):
            m *= 0.9
            m += 0.1 * g
            v *= 0.999
            v += 0.001 * g * g
            value -= 0.1 * (m / (1 - 0.9 ** epoch)) / (np.sqrt(v / (1 - 0.999 ** epoch)) + 1e-8)
    return Field(weights[:N_FEATURES], moves)


def _excerpt(text: str) -> tuple[bool, int]:
    """Whether a text has a base span, and where its ``TRAIN_CHARS`` characters to train on start."""
    spans = base_spans(text)
    far = bool(spans) and len(text) > TRAIN_CHARS
    return bool(spans), max(0, spans[0][1] - TRAIN_CHARS // 2) if far else 0


def training_texts(docs: DataFrame, rows: int = TRAIN_DOCS) -> list[str]:
    """The bounded sample: of the texts with a base span, wherever they lie in
    the table, and of those without, at most ``rows`` each in hash order. Of a
    longer text ``TRAIN_CHARS`` characters are taken, around its first base span."""
    excerpt = rows_udf(lambda: lambda texts: list(map(_excerpt, texts)), "found boolean, start int")
    body = docs.select(text_of().alias("text")).where(F.length("text") > 0).withColumn("h", F.xxhash64("text"))
    seen = stored(body.select("h", excerpt("text").alias("x")).groupBy("h")
                  .agg(F.max("x.found").alias("found"), F.min("x.start").alias("start")), "secrets-found")
    chosen = None
    for found in (True, False):
        part = seen.where(F.col("found") == found).orderBy("h").limit(rows)
        chosen = part if chosen is None else chosen.unionByName(part)
    cut = F.col("text").substr(F.col("start") + 1, F.lit(TRAIN_CHARS))
    picked = body.join(F.broadcast(chosen), "h").groupBy("h").agg(F.min(cut).alias("text"))
    return [r["text"] for r in picked.orderBy("h").collect()]


def fit_field(docs: DataFrame) -> Field | None:
    return fit(training_texts(docs))


def _report(text: str, added: list[tuple[int, int]]) -> tuple:
    base = base_spans(text)
    found = base + [("crf", a, b) for a, b in added if not any(x < b and a < y for _, x, y in base)]
    order = {k: i for i, k in enumerate((*BASE_KINDS, "crf"))}
    found.sort(key=lambda s: (s[1], order[s[0]]))
    counts = [sum(s[0] == k for s in base) for k in BASE_KINDS]
    return (*counts, hex_digest(",".join(f"{k}:{a}:{b}" for k, a, b in base)),
            ",".join(f"{k}:{a}:{b}" for k, a, b in found), len(found) - len(base))


REPORT = "n_assign long, n_access long, n_hex long, base_sha256 string, spans string, n_crf long"


def secrets(docs: DataFrame, field: Field | None) -> DataFrame:
    """Counts, digests and spans of every row of ``docs``."""
    def work(texts: list[str]) -> list[tuple]:
        return list(map(_report, texts, field.spans_of(texts) if field else [[]] * len(texts)))

    report = rows_udf(lambda: work, REPORT)
    return docs.select("doc_id", report(text_of()).alias("r")).select("doc_id", "r.*")
