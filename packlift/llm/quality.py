"""Quality rules: robust multivariate outliers per language and source.

Every text gives base counts (fixed rules) and a vector of transformed
statistics. Per (lang, source) the minimum-covariance-determinant estimate of
the vectors' centre and scatter is fitted, and a text whose squared
Mahalanobis distance exceeds the cut is rejected, as is one that fails the
base rules.

**Statistics** (``FEATURES``), each from a whole text: logarithm of the mean
word length, and the logarithms of the shares of symbols, other punctuation,
capitals, digits, words in repeated windows and words equal to the one before.
Counts are smoothed with ``PRIOR`` pseudo-counts at a fixed rate, so that a
short text, of which little is known, stays near the centre; ``KNEE`` is added
to a share, as differences far below it say nothing.

**MCD** by deterministic concentration steps on all rows: the start takes each
group's medians and spreads (from fine histograms), and each step keeps the
``SUPPORT`` share of rows that lie nearest to the present centre and
recomputes mean and covariance from them, until ``STEPS`` steps are done. A step is
two grouped aggregations with map-side combining (a histogram of distances,
then sums and products), so a group that holds a third of all rows costs each
task one partial row. ``FLOOR`` is added to the variances, as many statistics
are constant within a group. The final scatter is scaled to the median distance
of a normal sample. Groups under ``MIN_ROWS`` rows use their language's
estimate, and languages under it the estimate of all rows.

Defined cases: a null text has no words and fails the base rules, as does an
empty one; null lang or source form groups of their own; repeated rows each
count; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import re

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from packlift.llm.common import fresh, rows_udf, stored, text_of

FEATURES = ("word_length", "symbols", "punctuation", "capitals", "digits", "repeats", "stutter")
P = len(FEATURES)
PRIOR = 30.0                     # pseudo-words
KNEE = 0.03
FLOOR = (0.03, 0.18, 0.35, 0.35, 0.70, 0.50, 0.35)   # least standard deviation of each statistic
SUPPORT = 0.75                   # share of a group's rows that the estimate rests on
STEPS = 4
MIN_ROWS = 100
# Squared distance beyond which a text is rejected: the 1 - 1e-6 quantile of chi-square with 7 degrees of freedom.
CUT = 40.5
MEDIAN_CHI2 = 6.346              # its median
BINS = 400                       # of a histogram
MIN_WORDS, MAX_REPEATS_PERCENT = 10, 20

BASE = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
STATS_SCHEMA = ", ".join([f"{c} long" for c in BASE] + [f"{c} double" for c in FEATURES])

_WORD = re.compile(r"[^\x20\x09-\x0D]+")
_BLANKS = " \t\n\x0b\x0c\r"
_SYMBOLS = "#*$%&|<>"
_OTHER_MARKS = "!\"'()+,-./:;=?@[\\]^_`{}~¡¿«»‐‑‒–—―‘’“”„•…"
_CLASS = np.zeros(0x110000, dtype=np.uint8)


def _classes() -> np.ndarray:
    """Class by code point: 1 symbol, 2 other punctuation, 3 capital, 4 digit, 0 the rest."""
    if not _CLASS[ord("#")]:
        for number, chars in ((2, _OTHER_MARKS), (3, "ABCDEFGHIJKLMNOPQRSTUVWXYZ"), (4, "0123456789"), (1, _SYMBOLS)):
            _CLASS[[ord(c) for c in chars]] = number
        for c in range(0xC0, 0xDF):
            _CLASS[c] = 3 if c != 0xD7 else 2
    return _CLASS


def words_of(text: str) -> list[str]:
    if text.isascii():
        # ASCII 28-31 also split in str.split, but are no blanks here.
        if not _SEPARATORS.search(text):
            return text.split()
    return _WORD.findall(text)


_SEPARATORS = re.compile(r"[\x1c-\x1f]")


def repeated_words(words: list[str], width: int = 5) -> int:
    """Words inside ``width``-word windows that occur twice or more."""
    n = len(words)
    if n < width + 1:
        return 0
    number: dict[str, int] = {}
    ids = np.fromiter((number.setdefault(w, len(number)) for w in words), dtype=np.int64, count=n)
    key = ids[:n - width + 1].copy()
    for k in range(1, width):
        # Renumber before the product could overflow; equal keys stay equal, others differ.
        if key.size and int(key.max()) >= (1 << 62) // max(len(number), 1):
            key = np.unique(key, return_inverse=True)[1].astype(np.int64)
        key = key * len(number) + ids[k:n - width + 1 + k]
    order = np.argsort(key, kind="stable")
    ranked = key[order]
    same = ranked[1:] == ranked[:-1]
    if not same.any():
        return 0
    twice = np.zeros(len(key), dtype=bool)
    twice[order[1:][same]] = True
    twice[order[:-1][same]] = True
    mark = np.zeros(n + 1, dtype=np.int64)
    starts = np.flatnonzero(twice)
    np.add.at(mark, starts, 1)
    np.add.at(mark, starts + width, -1)
    return int(np.count_nonzero(np.cumsum(mark[:n])))


def duplicate_lines(text: str) -> int:
    seen, count = set(), 0
    for line in text.split("\n"):
        if line.strip(_BLANKS):
            if line in seen:
                count += 1
            else:
                seen.add(line)
    return count


def _share(count: int, total: int, rate: float) -> float:
    return float(np.log((count + PRIOR * rate) / (total + PRIOR) + KNEE))


def text_stats(text: str) -> tuple:
    words = words_of(text)
    n = len(words)
    chars = sum(map(len, words))
    points = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
    _, symbols, marks, capitals, digits = np.bincount(_classes()[points], minlength=5).tolist()
    repeats = repeated_words(words)
    stutter = sum(map(str.__eq__, words, words[1:]))
    return (n, chars, symbols, duplicate_lines(text), repeats,
            float(np.log((chars + PRIOR * 5.5) / (n + PRIOR))),
            _share(symbols, chars, 0.01), _share(marks, chars, 0.04), _share(capitals, chars, 0.04),
            _share(digits, chars, 0.01), _share(repeats, n, 0.01), _share(stutter, n, 0.01))


def stats_udf():
    return rows_udf(lambda: lambda texts: [text_stats(t) for t in texts], STATS_SCHEMA)


def base_failed(n_words: Column, n_repeat_words: Column) -> Column:
    return (n_words < MIN_WORDS) | (100 * n_repeat_words > MAX_REPEATS_PERCENT * n_words)


def _key(level: int, *parts: str) -> Column:
    """Name of an estimate: its level and the group's values, null marked apart from any text."""
    texts = [F.coalesce(F.concat(F.lit("="), F.col(p).cast("string")), F.lit("null")) for p in parts]
    return F.concat_ws("\x1f", F.lit(str(level)), *texts)


def estimate_groups(rows: DataFrame) -> DataFrame:
    """Per (lang, source): ``use``, the estimate its rows are judged by, and
    ``keys``, the estimates they contribute to."""
    groups = stored(rows.groupBy("lang", "source").agg(F.count(F.lit(1)).alias("n")), "quality-groups")
    langs = groups.groupBy(F.col("lang").alias("l")).agg(F.sum("n").alias("n_lang"), F.min("n").alias("least"))
    pooled = langs.where(F.col("n_lang") < MIN_ROWS).limit(1).count() > 0
    own, lang = F.col("n") >= MIN_ROWS, F.col("n_lang") >= MIN_ROWS
    by_source, by_lang, by_all = _key(1, "lang", "source"), _key(2, "lang"), F.lit("3")
    keys = F.array(F.when(own, by_source), F.when(lang & (F.col("least") < MIN_ROWS), by_lang),
                   F.when(F.lit(pooled), by_all))
    return stored(groups.join(langs, F.col("lang").eqNullSafe(F.col("l")))
                  .select(F.col("lang").alias("g_lang"), F.col("source").alias("g_source"),
                          F.when(own, by_source).when(lang, by_lang).otherwise(by_all).alias("use"),
                          F.array_compact(keys).alias("keys")), "quality-members")


def with_group(rows: DataFrame, members: DataFrame) -> DataFrame:
    return rows.join(members, F.col("lang").eqNullSafe(F.col("g_lang"))
                     & F.col("source").eqNullSafe(F.col("g_source")), "left").drop("g_lang", "g_source")


def _distance() -> Column:
    """Squared length of root * (statistics - centre), root lower triangular."""
    rows = [" + ".join(f"root[{i * P + j}] * ({FEATURES[j]} - centre[{j}])" for j in range(i + 1)) for i in range(P)]
    return F.expr(" + ".join(f"power({row}, 2)" for row in rows))


def _bin(d2: Column) -> Column:
    return F.floor(F.log1p(d2) * BINS / 10).cast("int")


def _solve(batches):
    """Centre and inverse Cholesky root from each group's sums."""
    floor = np.diag(np.square(FLOOR))
    for batch in batches:
        centres, roots = [], []
        for n, sums, products in zip(batch["n"], batch["sums"], batch["products"]):
            mean = np.asarray(sums) / n
            cov = np.zeros((P, P))
            cov[np.triu_indices(P)] = np.asarray(products) / n
            cov = cov + np.triu(cov, 1).T - np.outer(mean, mean)
            # Rounding can leave a variance slightly negative; the floor keeps the matrix positive definite.
            values, vectors = np.linalg.eigh(cov)
            cov = (vectors * np.maximum(values, 0)) @ vectors.T + floor
            centres.append(mean.tolist())
            roots.append(np.linalg.inv(np.linalg.cholesky(cov)).ravel().tolist())
        yield pd.DataFrame({"key": batch["key"], "centre": centres, "root": roots})


PARAMS = "key string, centre array<double>, root array<double>"


def _start(tagged: DataFrame) -> DataFrame:
    quantiles = tagged.groupBy("key").agg(*[F.percentile_approx(f, [0.16, 0.5, 0.84], 2000).alias(f) for f in FEATURES])
    spread = [f"greatest(({f}[2] - {f}[0]) / 2, {low}D)" for f, low in zip(FEATURES, FLOOR)]
    root = ", ".join("0.0D" if i != j else f"1 / {spread[i]}" for i in range(P) for j in range(P))
    centre = ", ".join(f"{f}[1]" for f in FEATURES)
    return quantiles.select("key", F.expr(f"array({centre})").alias("centre"), F.expr(f"array({root})").alias("root"))


def _with_bins(tagged: DataFrame, params: DataFrame) -> DataFrame:
    return tagged.join(params, "key").select("key", *FEATURES, _bin(_distance()).alias("bin"))


def _bin_at(binned: DataFrame, share: float) -> DataFrame:
    """Per estimate the first bin up to which ``share`` of the rows lie."""
    counts = binned.groupBy("key", "bin").agg(F.count(F.lit(1)).alias("n"))
    w = Window.partitionBy("key")
    run = counts.select("key", "bin", F.sum("n").over(w.orderBy("bin")).alias("upto"), F.sum("n").over(w).alias("all"))
    return run.where(F.col("upto") >= F.col("all") * share).groupBy("key").agg(F.min("bin").alias("last"))


def _concentrate(tagged: DataFrame, params: DataFrame) -> DataFrame:
    binned = _with_bins(tagged, params)
    # Stored, the cut's size is known, and the rows need no shuffle on a hot group's key.
    near = binned.join(stored(_bin_at(binned, SUPPORT), "quality-cut"), "key").where(F.col("bin") <= F.col("last"))
    sums = [f"sum({f})" for f in FEATURES]
    products = [f"sum({FEATURES[i]} * {FEATURES[j]})" for i in range(P) for j in range(i, P)]
    packed = near.groupBy("key").agg(F.count(F.lit(1)).alias("n"), F.expr(f"array({', '.join(sums)})").alias("sums"),
                                     F.expr(f"array({', '.join(products)})").alias("products"))
    return packed.mapInPandas(_solve, PARAMS)


def fit(rows: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(members, params): the estimate that each (lang, source) uses, and the
    estimates with the factor that scales their distances."""
    members = estimate_groups(rows)
    tagged = with_group(rows, members).select(F.explode("keys").alias("key"), *FEATURES)
    params = stored(_start(tagged), "quality-start")
    for step in range(STEPS):
        params = stored(_concentrate(tagged, params), f"quality-step{step}")
    half = _bin_at(_with_bins(tagged, params), 0.5)
    top = F.expm1((F.col("last") + 1) * F.lit(10.0 / BINS))
    params = stored(params.join(half, "key").select(
        F.col("key").alias("use"), "centre", "root", F.greatest(top / MEDIAN_CHI2, F.lit(1.0)).alias("scale")),
        "quality-params")
    return members, params


def document_stats(docs: DataFrame) -> DataFrame:
    """Base counts and statistics of every row of ``docs``."""
    return (docs.select("doc_id", "lang", "source", stats_udf()(text_of()).alias("q"))
            .select("doc_id", "lang", "source", "q.*"))


def judged(rows: DataFrame, members: DataFrame, params: DataFrame) -> DataFrame:
    """``rows`` with ``distance``, ``base_failed`` and ``kept``."""
    out = (with_group(rows, members).join(params, "use", "left")
           .withColumn("distance", _distance() / F.col("scale"))
           .withColumn("base_failed", base_failed(F.col("n_words"), F.col("n_repeat_words"))))
    verdict = ~F.col("base_failed") & (F.coalesce(F.col("distance"), F.lit(0.0)) <= CUT)
    return out.withColumn("kept", verdict).drop("keys", "use", "centre", "root", "scale")


def quality(docs: DataFrame) -> DataFrame:
    """Base counts, ``base_failed``, ``distance`` and ``kept`` of every row."""
    rows = stored(document_stats(docs), "quality-rows")
    members, params = fit(rows)
    return judged(rows, members, params).select("doc_id", *BASE, "base_failed", "kept", "distance")


def keep_good(docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` that the rules keep, with all their columns."""
    rows = stored(document_stats(docs), "quality-rows")
    members, params = fit(rows)
    keep, = fresh(docs, "quality")
    names = docs.columns
    packed = docs.select(F.struct(*[F.col(f"`{c}`") for c in names]).alias(keep), "lang", "source",
                         stats_udf()(text_of()).alias("q")).select(keep, "lang", "source", "q.*")
    return judged(packed, members, params).where("kept").select(f"{keep}.*")
