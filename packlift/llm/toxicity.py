"""Toxicity: a subsequence string-kernel SVM with Nyström landmarks.

**Kernel.** A token (a word of the lower-cased text between boundary marks) is
mapped to its character subsequences: of length 3 that span at most 5
characters, and of length 5 that span at most 6 (these hashed into buckets); a
subsequence with g skipped characters weighs ``DECAY ** g``. Two
tokens are alike by the inner product of these maps, each divided by a factor
that depends on the token's length, which keeps the kernel positive
semi-definite. Gaps make it tolerant: an insult with inserted or replaced
characters still shares most of its subsequences.

**Nyström.** ``landmarks`` tokens of the training sentences span the feature
space: a token's features are its kernel values against them, times the inverse
square root of the landmarks' own kernel matrix.

**SVM.** A text is as toxic as its most toxic token, so training is
multiple-instance: a sentence of a clean document makes all its tokens
negative; a toxic document has at least one positive token, its witness. A
squared-hinge SVM is fitted, each toxic document's highest-scoring token becomes
its witness, and the two steps repeat. The fitted SVM is a linear function of
the subsequences, so it folds into one table of a weight per subsequence, and
scoring reads only that table.

**Score.** Platt scaling, fitted on training documents the SVM did not see,
turns the largest token score of a whole text, and the mean of its ``TOP``
largest, into a probability.

The model is fitted on a bounded sample of labelled rows (``TRAIN_ROWS`` of each
class, in the order of a hash of the id; texts over ``TRAIN_CHARS`` characters
are not used to train); every text is scored whole.

Defined cases: null and empty texts, and texts without a letter or digit, get
the score of "no token", below 0.5; repeated rows are scored alike, each its
own row; repeated labels of one id count as toxic if any is; a null id is held
out like the empty string; with no toxic or no clean training row every score
is 0; an empty table gives an empty result. Other columns are ignored.
"""

from __future__ import annotations

import heapq
import re
from collections import Counter
from dataclasses import dataclass
from itertools import combinations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from packlift.llm.common import fresh, rows_udf, text_of

SPAN = 6              # characters the longest subsequence may span
DECAY = 0.6           # weight per skipped character
ALPHABET = 64         # character classes; 0 pads, 1 and 2 mark a token's ends
WIDTH = 32            # characters of a token looked at together; longer tokens are cut into overlapping pieces
LANDMARKS = 256
TRAIN_ROWS = 2000     # labelled rows of each class used to fit
TRAIN_CHARS = 20_000  # longest text used to fit
ROUNDS = 4            # witness rounds
CLEAN_WEIGHT, TOXIC_WEIGHT = 30_000.0, 500.0  # total loss weights of clean tokens and of witnesses; the ridge is 0.1
CLEAN_TOKENS, HARD_TOKENS = 40_000, 3_000     # clean tokens to fit on, and misjudged ones added after a round
QUOTED = 8.0          # times more frequent in toxic documents: such a token may be a witness though a clean one has it
CACHE = 400_000       # distinct tokens whose scores a task remembers

TOP = 3               # token scores that a text's score looks at

# Offsets of the later characters of each subsequence, and its weight.
GAPS = [(g, DECAY ** (g[-1] - len(g)))
        for g in [*combinations(range(1, 5), 2), *combinations(range(1, 6), 4)]]
TRIPLES = ALPHABET ** 3
BUCKETS = 1 << 20     # of the subsequences of length 5
TABLE = TRIPLES + BUCKETS

_SENTENCE = re.compile(r"[.!?\n]+")
_CODES = np.zeros(0x110000, dtype=np.uint8)


def _codes() -> np.ndarray:
    """Character class by code point: letters a-z and digits have their own,
    other letters share the rest; marks and blanks have none (class 0)."""
    if not _CODES[ord("a")]:
        points = np.arange(len(_CODES))
        _CODES[128:] = 39 + points[128:] % (ALPHABET - 39)
        _CODES[ord("a"):ord("z") + 1] = 3 + np.arange(26)
        _CODES[ord("0"):ord("9") + 1] = 29 + np.arange(10)
    return _CODES


def tokens_of(text: str) -> set[str]:
    """The distinct tokens of a text: its words in lower case; runs of three or
    more single characters also count joined, as spelt-out words."""
    text = text.lower()
    words = set(text.split())
    for run in _SPELT.findall(text):
        words.add("".join(c for c in run if c.isalnum()))
    return words


_SPELT = re.compile(r"(?<!\S)(?:[^\W_][^\w\s]?\s){2,}[^\W_](?!\S)")
_MARKS = "".join(map(chr, range(33, 48))) + ":;<=>?@[\\]^_`{|}~"


def pieces(token: str) -> list[str]:
    token = token.strip(_MARKS)
    if len(token) <= WIDTH:
        return [token] if token else []
    return [token[i:i + WIDTH] for i in range(0, len(token) - WIDTH // 2, WIDTH // 2)]


def encode(tokens: list[str]) -> np.ndarray:
    """Character classes, a row for each token piece, between its two end marks."""
    n = len(tokens)
    lengths = np.fromiter(map(len, tokens), dtype=np.int64, count=n)
    out = np.zeros((n, int(lengths.max(initial=0)) + 2 + SPAN), dtype=np.uint8)
    flat = np.frombuffer("".join(tokens).encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
    rows = np.repeat(np.arange(n), lengths)
    cols = np.arange(len(flat)) - np.repeat(np.cumsum(lengths) - lengths, lengths)
    out[rows, cols + 1] = _codes()[flat]
    out[:, 0] = 1
    out[np.arange(n), lengths + 1] = 2
    return out


def occurrences(codes: np.ndarray):
    """For each gap pattern the subsequence ids of every start (0: none)."""
    width = codes.shape[1] - SPAN
    for gaps, w in GAPS:
        ids = codes[:, :width].astype(np.int64)
        present = ids > 0
        for g in gaps:
            following = codes[:, g:g + width]
            present &= following > 0
            ids = ids * ALPHABET + following
        if len(gaps) > 2:
            ids = TRIPLES + ((ids * 0x9E3779B1) >> 12 & (BUCKETS - 1))
        yield np.where(present, ids, 0), w


ROWS_AT_ONCE = 4096


def scale_of(codes: np.ndarray) -> np.ndarray:
    total = np.zeros(len(codes), dtype=np.float64)
    for ids, w in occurrences(codes):
        total += w * w * np.count_nonzero(ids, axis=1)
    return np.sqrt(np.maximum(total, 1.0))


def linear_scores(codes: np.ndarray, table: np.ndarray) -> np.ndarray:
    """Inner product of each token's scaled subsequence map with ``table``."""
    out = np.zeros(len(codes), dtype=np.float64)
    for lo in range(0, len(codes), ROWS_AT_ONCE):
        part = codes[lo:lo + ROWS_AT_ONCE]
        score, square = np.zeros(len(part)), np.zeros(len(part))
        for ids, w in occurrences(part):
            score += w * table[ids].sum(axis=1, dtype=np.float64)
            square += w * w * np.count_nonzero(ids, axis=1)
        out[lo:lo + ROWS_AT_ONCE] = score / np.sqrt(np.maximum(square, 1.0))
    return out


def kernel(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Kernel matrix of the encoded tokens ``a`` against ``b``."""
    seen = np.unique(np.concatenate([ids.ravel() for ids, _ in occurrences(b)]))
    seen = seen[seen > 0]
    place = np.zeros(TABLE, dtype=np.int32)
    place[seen] = np.arange(1, len(seen) + 1)
    maps = np.zeros((len(seen) + 1, len(b)), dtype=np.float32)
    for ids, w in occurrences(b):
        at = place[ids]
        np.add.at(maps, (at, np.arange(len(b))[:, None]), np.float32(w))
    maps[0] = 0
    maps /= scale_of(b)[None, :].astype(np.float32)
    out = np.zeros((len(a), len(b)), dtype=np.float32)
    for lo in range(0, len(a), ROWS_AT_ONCE):
        part = a[lo:lo + ROWS_AT_ONCE]
        acc = np.zeros((len(part), len(b)), dtype=np.float32)
        for ids, w in occurrences(part):
            at = place[ids]
            for col in range(at.shape[1]):
                hit = np.flatnonzero(at[:, col])
                if len(hit):
                    acc[hit] += np.float32(w) * maps[at[hit, col]]
        out[lo:lo + ROWS_AT_ONCE] = acc / scale_of(part)[:, None].astype(np.float32)
    return out


def fit_svm(x: np.ndarray, y: np.ndarray, weight: np.ndarray, reg: float = 0.1) -> tuple[np.ndarray, float]:
    """Squared-hinge linear SVM by Newton steps on its support vectors."""
    n = x.shape[1]
    w = np.zeros(n + 1)
    ridge = np.full(n + 1, reg)
    ridge[-1] = 1e-3
    for _ in range(30):
        active = np.flatnonzero(y * (x @ w[:-1].astype(x.dtype) + w[-1]) < 1)
        left, right = np.diag(ridge), np.zeros(n + 1)
        for lo in range(0, len(active), ROWS_AT_ONCE):
            at = active[lo:lo + ROWS_AT_ONCE]
            xa = np.hstack([x[at].astype(np.float64), np.ones((len(at), 1))])
            left += (xa * weight[at][:, None]).T @ xa
            right += xa.T @ (weight[at] * y[at])
        new = np.linalg.solve(left, right)
        done = np.abs(new - w).max() < 1e-6
        w = 0.5 * (w + new) if _ > 15 else new
        if done:
            break
    return w[:-1], float(w[-1])


def fit_platt(features: np.ndarray, label: np.ndarray) -> np.ndarray:
    """Weights of the logistic curve through (features, label), shift last."""
    pos, neg = max(label.sum(), 1), max((1 - label).sum(), 1)
    target = np.where(label == 1, (pos + 1) / (pos + 2), 1 / (neg + 2))
    x = np.hstack([features, np.ones((len(features), 1))])
    w = np.zeros(x.shape[1])
    for _ in range(60):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        grad = x.T @ (p - target) + 1e-2 * w
        hess = (x * (p * (1 - p))[:, None]).T @ x + 1e-2 * np.eye(x.shape[1])
        step = np.linalg.solve(hess, grad)
        w -= np.clip(step, -2, 2)
        if np.abs(step).max() < 1e-8:
            break
    return w


def top_features(scores) -> tuple[float, float]:
    """Largest token score, and the mean of the ``TOP`` largest."""
    best = heapq.nlargest(TOP, scores)
    if not best:
        return NO_TOKEN, NO_TOKEN
    return best[0], sum(best) / len(best)


@dataclass
class ToxicityModel:
    table: np.ndarray   # weight per subsequence id
    bias: float
    platt: np.ndarray   # weights of the two features, and the shift
    constant: bool = False

    def token_scores(self, tokens: list[str]) -> np.ndarray:
        return linear_scores(encode(tokens), self.table) + self.bias

    def probability(self, features: np.ndarray) -> np.ndarray:
        if self.constant:
            return np.zeros(len(features))
        return 1 / (1 + np.exp(-np.clip(features @ self.platt[:2] + self.platt[2], -30, 30)))


def _lift(codes: np.ndarray, bags: list[np.ndarray], label: np.ndarray) -> np.ndarray:
    """How much more often each token's subsequences occur in toxic documents:
    the mean log ratio of document counts, used to choose first witnesses."""
    count = np.ones((2, TABLE))
    for bag, y in zip(bags, label):
        if len(bag):
            seen = np.unique(np.concatenate([ids.ravel() for ids, _ in occurrences(codes[bag])]))
            count[y, seen] += 1
    totals = np.array([(label == 0).sum(), (label == 1).sum()]) + 2.0
    ratio = np.log(count[1] / totals[1]) - np.log(count[0] / totals[0])
    # A subsequence that few documents have says little: shrink it towards zero.
    ratio *= 1 - 2.0 / (count[0] + count[1])
    ratio[0] = 0
    return linear_scores(codes, ratio) / np.sqrt(np.maximum(np.count_nonzero(codes, axis=1), 1))


NO_TOKEN = -2.0  # SVM score of a text without tokens


def fit(rows: list[tuple[int, str]], landmarks: int = LANDMARKS) -> ToxicityModel:
    """Fit on (label, text) rows; see the module's docstring."""
    label = np.array([r[0] for r in rows], dtype=np.int64)
    if not len(rows) or label.min() == label.max():
        return ToxicityModel(np.zeros(TABLE, dtype=np.float32), 0.0, np.zeros(3), constant=True)
    names: dict[str, int] = {}
    bags = []
    for _, text in rows:
        bag = set()
        for sentence in _SENTENCE.split(text):
            for token in tokens_of(sentence):
                bag.update(pieces(token))
        bags.append(np.array(sorted(names.setdefault(p, len(names)) for p in bag), dtype=np.int64))
    tokens = list(names)
    in_clean, in_toxic = np.zeros(len(tokens)), np.zeros(len(tokens))
    fold = np.arange(len(rows)) % 4 == 3      # kept for Platt scaling
    for part in (0, 1):
        if not (label[~fold] == part).any():
            fold[:] = False
    for bag, y, out in zip(bags, label, fold):
        if not out:
            (in_toxic if y else in_clean)[bag] += 1
    used = np.flatnonzero(in_clean + in_toxic)
    if not len(used):
        return ToxicityModel(np.zeros(TABLE, dtype=np.float32), 0.0, np.zeros(3), constant=True)
    codes = encode(tokens)
    lift = _lift(codes, [b for b, out in zip(bags, fold) if not out], label[~fold])
    # A clean document may quote an insult once: a token that toxic documents hold far more often stays a candidate.
    n_clean, n_toxic = (label[~fold] == 0).sum(), (label[~fold] == 1).sum()
    clean_like = (in_clean > 0) & (in_toxic / n_toxic <= QUOTED * in_clean / n_clean)
    # Landmarks: the tokens that stand out in toxic documents, common tokens of clean ones, and a spread of all.
    toxic_first = np.argsort(np.where(clean_like, 0, -lift * np.log1p(in_toxic)), kind="stable")[:landmarks // 2]
    clean_first = np.argsort(-in_clean, kind="stable")[:landmarks // 4]
    spread = used[np.linspace(0, len(used) - 1, landmarks // 4).astype(int)]
    marks = np.unique(np.concatenate([toxic_first, clean_first, spread]))
    anchor = codes[marks]
    values, vectors = np.linalg.eigh(kernel(anchor, anchor).astype(np.float64))
    root = vectors * np.where(values > 1e-6, 1 / np.sqrt(np.maximum(values, 1e-6)), 0)[None, :]
    scale = scale_of(anchor)

    def features(rows: np.ndarray) -> np.ndarray:
        return (kernel(codes[rows], anchor) @ root.astype(np.float32)).astype(np.float32)

    def folded(w: np.ndarray) -> np.ndarray:
        """The SVM as a weight per subsequence."""
        alpha, table = root @ w, np.zeros(TABLE)
        for ids, wt in occurrences(anchor):
            np.add.at(table, ids, (wt * alpha / scale)[:, None] * np.ones(ids.shape))
        table[0] = 0
        return table

    # Clean tokens to learn from: the most common ones and an even spread of the rest; later the hardest ones too.
    clean_all = np.flatnonzero(clean_like)
    clean_all = clean_all[np.argsort(-in_clean[clean_all], kind="stable")]
    clean = clean_all[:CLEAN_TOKENS // 2]
    if len(clean_all) > len(clean):
        clean = np.union1d(clean, clean_all[np.linspace(len(clean), len(clean_all) - 1, CLEAN_TOKENS // 2).astype(int)])
    clean_x = features(clean)
    toxic_bags = [b[~clean_like[b]] for b, y, out in zip(bags, label, fold) if y and not out]
    toxic_bags = [b for b in toxic_bags if len(b)]
    standing = lift * np.log1p(in_toxic)
    witness = Counter(int(b[np.argmax(standing[b])]) for b in toxic_bags)
    table, b0 = np.zeros(TABLE), 0.0
    for _ in range(ROUNDS):
        positive = np.array(sorted(witness), dtype=np.int64)
        votes = np.array([witness[t] for t in positive], dtype=np.float64)
        x = np.vstack([clean_x, features(positive)])
        y = np.concatenate([-np.ones(len(clean)), np.ones(len(positive))])
        share = np.concatenate([np.full(len(clean), CLEAN_WEIGHT / max(len(clean), 1)),
                                TOXIC_WEIGHT * votes / max(votes.sum(), 1)])
        w, b0 = fit_svm(x, y, share)
        table = folded(w)
        f = linear_scores(codes, table) + b0
        hard = np.setdiff1d(clean_all[np.argsort(-f[clean_all], kind="stable")[:HARD_TOKENS]], clean)
        hard = hard[f[hard] > -0.5]
        chosen = Counter(int(b[np.argmax(f[b])]) for b in toxic_bags)
        if chosen == witness and not len(hard):
            break
        witness = chosen
        clean, clean_x = np.concatenate([clean, hard]), np.vstack([clean_x, features(hard)])
    model = ToxicityModel(table.astype(np.float32), b0, np.array([1.0, 0.0, 0.0]))
    scores = model.token_scores(tokens)
    held = fold if fold.any() else np.ones(len(rows), dtype=bool)
    features = np.array([top_features(scores[b].tolist()) for b, h in zip(bags, held) if h])
    platt = fit_platt(features, label[held])
    if platt[0] + platt[1] > 0 and NO_TOKEN * (platt[0] + platt[1]) + platt[2] < 0:
        model.platt = platt
    return model


def training_rows(docs: DataFrame, labels: DataFrame, rows: int = TRAIN_ROWS) -> list[tuple[int, str]]:
    """The bounded labelled sample: at most ``rows`` rows of each class, in hash
    order of the id, from the training side of the split."""
    d = docs.select(F.col("doc_id").alias("id"), text_of().alias("body")).where(F.length("body") <= TRAIN_CHARS)
    y = (labels.where(F.col("doc_id").isNotNull() & F.col("toxic").isNotNull())
         .groupBy(F.col("doc_id").alias("id")).agg(F.max(F.col("toxic").cast("int")).alias("y"))
         .where(F.crc32(F.col("id").cast("string")) % 5 != 0))
    picked = None
    for value in (0, 1):
        part = y.where(F.col("y") == value).orderBy(F.xxhash64("id"), "id").limit(rows)
        picked = part if picked is None else picked.unionByName(part)
    found = d.join(F.broadcast(picked), "id").groupBy("id").agg(F.max("y").alias("y"), F.min("body").alias("body"))
    return [(r["y"], r["body"]) for r in found.orderBy(F.xxhash64("id"), "id").collect()]


def score_udf(model: ToxicityModel):
    def make():
        known: dict[str, float] = {}

        def work(texts: list[str]) -> list[tuple]:
            bags = [tokens_of(t) for t in texts]
            new = list({t for bag in bags for t in bag if t not in known})
            if len(known) + len(new) > CACHE:
                known.clear()
                new = list(set().union(*bags))
            new.sort(key=len)
            cut = [(i, p) for i, t in enumerate(new) for p in pieces(t)]
            best = np.full(len(new), NO_TOKEN)
            for lo in range(0, len(cut), 4096):
                part = cut[lo:lo + 4096]
                np.maximum.at(best, [i for i, _ in part], model.token_scores([p for _, p in part]))
            known.update(zip(new, best.tolist()))
            features = np.array([top_features(map(known.__getitem__, bag)) for bag in bags]).reshape(-1, 2)
            return [(float(p),) for p in model.probability(features)]

        return work

    return rows_udf(make, "score double")


def fit_model(docs: DataFrame, labels: DataFrame) -> ToxicityModel:
    return fit(training_rows(docs, labels))


def held_out():
    return F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit(""))) % 5 == 0


def toxicity(docs: DataFrame, model: ToxicityModel) -> DataFrame:
    """``doc_id, held_out, score, predicted`` for every row of ``docs``."""
    scored = docs.select("doc_id", score_udf(model)(text_of()).alias("s"))
    return scored.select("doc_id", held_out().alias("held_out"), F.col("s.score").alias("score"),
                         (F.col("s.score") >= 0.5).cast("int").alias("predicted"))


def keep_clean(docs: DataFrame, model: ToxicityModel) -> DataFrame:
    """The rows of ``docs``, with all their columns, that are not toxic."""
    score, = fresh(docs, "toxicity")
    return docs.withColumn(score, score_udf(model)(text_of())).where(F.col(score)["score"] < 0.5).drop(score)
