"""Quality rules: robust multivariate outliers per language and source.

Each document becomes a vector of transformed statistics. For each (language, source) a minimum-covariance-determinant
estimate is fitted over all of its distinct vectors, each counted once however many documents have it, by concentration
steps, as Spark aggregations: keep the share ``H`` of the rows nearest by Mahalanobis distance, take their mean and
covariance, repeat. Every group starts from three robust guesses (median deviations alone, and with the correlations of
squashed rows or of the rows' directions); after ``TRIAL`` steps the guess of the least determinant goes on, until no
group's determinant falls any more. At last the mean and covariance of all rows within the ``USUAL`` chi-square quantile
are taken, which uses more of the good rows.
Documents whose distance to their group's estimate exceeds a chi-square quantile are rejected, as are those that fail
the plain rules. A step's state is one small row per group; no group's rows meet in one task.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.llm.common import bound_batches, cut_lineage, in_slices, join_small, read

H = 0.5  # share of a group's distinct vectors that its estimate rests on; it breaks down when more than 1 - H are off
TRIAL = 2  # steps of every start
FALL = 1e-3  # a step that lowers no group's log determinant by more is the last
USUAL = 0.975  # chi-square quantile of the rows of the last step
MIN_ROWS = 60  # groups of fewer distinct vectors use their language's estimate, or the corpus's
MANY = 20_000  # rows of estimates that are broadcast
TAIL = 1e-6  # chi-square tail beyond which a document is an outlier
#: (statistic, floor of its standard deviation): most documents have none of the last five, so their spread can be 0
FEATURES = {"f_length": 0.06, "f_symbols": 0.06, "f_upper": 0.06, "f_punct": 0.06, "f_dup": 0.2, "f_repeat": 0.12}
D = len(FEATURES)
BASE = "n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, n_upper long, n_punct long, n_lines long"
COUNTS = [x.split(" ")[0] for x in BASE.split(", ")]

_WORD = re.compile(r"[^\x20\x09-\x0D]+")
_SYMBOL = re.compile(r"[#*$%&|<>]")
_PUNCT = re.compile(r"[!?;:|\"'(){}\[\]<>=+#*$%&^~\\/_@-]")


def repeated_words(words: list[str], n: int = 5) -> int:
    """Words in n-word windows that occur twice or more, the first occurrence included."""
    if len(words) <= n:
        return 0
    windows = list(zip(*[words[i:] for i in range(n)], strict=False))
    if len(set(windows)) == len(windows):
        return 0
    seen: dict[tuple, int] = {}
    for w in windows:
        seen[w] = seen.get(w, 0) + 1
    covered, total = 0, 0  # code up to which words have been counted
    for i, w in enumerate(windows):
        if seen[w] > 1:
            total += i + n - max(i, covered)
            covered = i + n
    return total


def text_counts(text: str | None) -> tuple[int, ...]:
    text = text or ""
    words = _WORD.findall(text)
    lines = text.split("\n")
    dup = 0
    if len(lines) > 1:
        seen = set()
        for line in lines:
            if line in seen:
                dup += _WORD.search(line) is not None
            seen.add(line)
    return (len(words), sum(map(len, words)), len(_SYMBOL.findall(text)), dup, repeated_words(words),
            sum(map(str.isupper, text)) if not text.islower() else 0, len(_PUNCT.findall(text)), len(lines))


def _counts(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
    for column in batches:
        rows = [text_counts(t) for texts in in_slices(column) for t in texts]
        yield pa.StructArray.from_arrays([pa.array([r[k] for r in rows], pa.int64()) for k in range(len(COUNTS))], list(COUNTS))


def features(c) -> dict[str, Column]:
    """Transformed statistics. Each is a share pulled to its usual value by some pseudo-counts, so that a short text
    isn't far out by chance, with a log or square root against skew."""
    share = lambda x, of, more: F.sqrt(c(x) / (c(of) + F.lit(float(more))))
    return {
        "f_length": F.log((c("word_chars") + 150.0) / (c("n_words") + 25.0)),
        "f_symbols": share("n_symbols", "word_chars", 300),
        "f_upper": share("n_upper", "word_chars", 300),
        "f_punct": share("n_punct", "word_chars", 300),
        "f_dup": share("n_dup_lines", "n_lines", 10),
        "f_repeat": share("n_repeat_words", "n_words", 50),
    }


def base_failed(c) -> Column:
    return (c("n_words") < 10) | (100 * c("n_repeat_words") > 20 * c("n_words"))


# ---------------------------------------------------------------- estimates


def chi2_cdf(x: float, d: int) -> float:
    """Regularised lower incomplete gamma of d/2 at x/2, by its series."""
    if x <= 0:
        return 0.0
    a, z = d / 2, x / 2
    term = total = 1 / a
    n = a
    while term > total * 1e-16:
        n += 1
        term *= z / n
        total += term
    return total * math.exp(a * math.log(z) - z - math.lgamma(a))


def chi2_quantile(p: float, d: int) -> float:
    lo, hi = 0.0, 400.0
    for _ in range(200):
        mid = (lo + hi) / 2
        lo, hi = (mid, hi) if chi2_cdf(mid, d) < p else (lo, mid)
    return lo


CUTOFF = chi2_quantile(1 - TAIL, D)


def consistency(share: float) -> float:
    """A covariance of the central ``share`` of normal rows is too small by this factor."""
    return share / chi2_cdf(chi2_quantile(share, D), D + 2)


def distance(mean: Column, inverse: Column) -> Column:
    """Squared Mahalanobis distance; ``inverse`` is flat, row by row."""
    diff = [F.col(n) - mean[i] for i, n in enumerate(FEATURES)]
    return sum((diff[i] * diff[j] * inverse[i * D + j] * (1 if i == j else 2) for i in range(D) for j in range(i, D)), F.lit(0.0))


_PRODUCTS = [(i, j) for i in range(D) for j in range(i, D)]


def _moments(of: dict[str, Column] | None = None) -> list[Column]:
    names = list(FEATURES)
    x = [(of or {}).get(n, F.col(n)) for n in names]
    return [F.count(F.lit(1)).alias("n"), F.array(*[F.sum(c) for c in x]).alias("sums"), F.array(*[F.sum(x[i] * x[j]) for i, j in _PRODUCTS]).alias("products")]


def _covariance(n: float, sums, products) -> tuple[np.ndarray, np.ndarray]:
    mean = np.asarray(sums, float) / n
    cov = np.zeros((D, D))
    for (i, j), p in zip(_PRODUCTS, products, strict=True):
        cov[i, j] = cov[j, i] = p / n - mean[i] * mean[j]
    return mean, cov


def _model(pdf: pd.DataFrame, means: list, covariances: list[np.ndarray]) -> pd.DataFrame:
    """Means, inverses and log determinants; floors keep the covariances regular."""
    regular = [c + np.diag(np.square(list(FEATURES.values()))) for c in covariances]
    return pdf.assign(mean=[list(map(float, m)) for m in means], inverse=[np.linalg.inv(c).ravel().tolist() for c in regular],
                      logdet=[float(np.linalg.slogdet(c)[1]) for c in regular])


def _estimate(pdf: pd.DataFrame, factor: float) -> pd.DataFrame:
    """Mean and covariance (times ``factor``) from count, sums and products."""
    found = [_covariance(*x) for x in zip(pdf["n"], pdf["sums"], pdf["products"], strict=True)]
    return _model(pdf[[*KEYS, "start", "before"]], [m for m, _ in found], [c * factor for _, c in found])


def _guesses(pdf: pd.DataFrame) -> pd.DataFrame:
    """A row for each start of a group, from the moments of its squashed rows and of its rows' directions."""
    means, covariances = [], []
    for mid, spread, tanh, sign in zip(pdf["mid"], pdf["spread"], pdf["tanh"], pdf["sign"], strict=True):
        scale = np.outer(spread, spread)
        parts = [np.eye(D), _covariance(*(tanh[k] for k in ("n", "sums", "products")))[1], D * _covariance(*(sign[k] for k in ("n", "sums", "products")))[1]]
        means += [mid] * len(parts)
        covariances += [scale * c for c in parts]
    keys = pdf[KEYS].loc[pdf.index.repeat(3)].reset_index(drop=True)
    return _model(keys.assign(start=[0, 1, 2] * len(pdf), before=float("inf")), means, covariances)


KEYS = ["level", "lang", "source"]
_SCHEMA = "level int, lang string, source string, start int, before double, mean array<double>, inverse array<double>, logdet double"


def _of_group(rows: DataFrame, groups: DataFrame, how: str = "inner", keys: list[str] | None = None) -> DataFrame:
    """``rows`` joined with the few rows of each group; nulls are equal. Where the groups are too many to broadcast, the
    corpus's own, which all rows share, still are."""
    keys = keys or KEYS
    other = groups.select(*[F.col(k).alias(f"_{k}") for k in keys], *[c for c in groups.columns if c not in keys])
    on = lambda a, b: [a[k].eqNullSafe(b[f"_{k}"]) for k in keys]
    if other.limit(MANY + 1).count() <= MANY:
        joined = rows.join(F.broadcast(other), on(rows, other), how)
    else:
        below, corpus = rows.where("level < 2"), rows.where("level = 2")
        few = other.where("_level = 2")
        joined = below.join(other, on(below, other), how).unionByName(corpus.join(F.broadcast(few), on(corpus, few), how))
    return joined if how == "left_semi" else joined.drop(*[f"_{k}" for k in keys])


def _starts(stats: DataFrame) -> DataFrame:
    names = list(FEATURES)
    medians = F.array(*[F.percentile_approx(n, 0.5, 1000) for n in names])
    middle = cut_lineage(stats.groupBy(*KEYS).agg(medians.alias("mid")))
    off = _of_group(stats, middle).select(*KEYS, *[F.abs(F.col(n) - F.col("mid")[i]).alias(n) for i, n in enumerate(names)])
    deviations = _of_group(off.groupBy(*KEYS).agg(medians.alias("mad")), middle)
    spread = F.array(*[F.sqrt(F.pow(F.col("mad")[i] * 1.4826, 2) + FEATURES[n] ** 2) for i, n in enumerate(names)])
    scale = cut_lineage(deviations.select(*KEYS, "mid", spread.alias("spread")))
    rows = _of_group(stats, scale).select(*KEYS, *[((F.col(n) - F.col("mid")[i]) / F.col("spread")[i]).alias(n) for i, n in enumerate(names)])
    rows = rows.withColumn("_length", F.sqrt(sum((F.col(n) * F.col(n) for n in names), F.lit(1e-12))))
    tanh, sign = {n: F.tanh(n) for n in names}, {n: F.col(n) / F.col("_length") for n in names}
    both = rows.groupBy(*KEYS).agg(F.struct(*_moments(tanh)).alias("tanh"), F.struct(*_moments(sign)).alias("sign"))
    return cut_lineage(_of_group(both, scale).mapInPandas(lambda it: map(_guesses, it), _SCHEMA))


def _concentrated(stats: DataFrame, model: DataFrame, share: float = H) -> DataFrame:
    """The estimates of the rows that are nearest by ``model``, a row for each of its rows."""
    keys = [*KEYS, "start"]
    far = _of_group(stats, model.drop("before")).select(*keys, *FEATURES, "logdet", distance(F.col("mean"), F.col("inverse")).alias("far"))
    if share == H:
        near = cut_lineage(far.groupBy(*keys).agg(F.percentile_approx("far", H, 1000).alias("most")))
        central = _of_group(far, near, keys=keys).where(F.col("far") <= F.col("most"))
    else:
        central = far.where(F.col("far") <= chi2_quantile(share, D))
    moments = central.groupBy(*keys).agg(*_moments(), F.max("logdet").alias("before"))
    factor = consistency(share)
    return cut_lineage(moments.mapInPandas(lambda it: (_estimate(x, factor) for x in it), _SCHEMA))


def least_determinants(stats: DataFrame) -> DataFrame:
    """The raw estimate of each group of ``stats``: the start of the least determinant, concentrated until no
    determinant falls."""
    model = _starts(stats)
    for _ in range(TRIAL):
        model = _concentrated(stats, model)
    best = F.min_by(F.struct(*[c for c in model.columns if c not in KEYS]), F.struct("logdet", "start"))
    model = cut_lineage(model.groupBy(*KEYS).agg(best.alias("x")).select(*KEYS, "x.*"))
    least = None
    while True:
        after = _concentrated(stats, model)
        # groups whose determinant fell take the step and go on; the others are done with what they had
        fell = F.col("before") - F.col("logdet") > FALL
        done = cut_lineage(_of_group(model, cut_lineage(after.where(~fell).select(*KEYS)), "left_semi"))
        least = done if least is None else least.unionByName(done)
        model = cut_lineage(after.where(fell))
        if model.isEmpty():
            return cut_lineage(least)


def _fit(stats: DataFrame) -> DataFrame:
    """One estimate per group of ``stats``, by concentration steps over all rows and a last, wider step."""
    return _concentrated(stats, least_determinants(stats), USUAL).drop("start", "before", "logdet")


def fit_outlier_model(stats: DataFrame) -> DataFrame:
    """(level, lang, source, mean, inverse): estimates at three levels: 0, (lang, source) groups of MIN_ROWS distinct
    vectors or more; 1, languages of MIN_ROWS or more (source null); 2, the corpus (both null). Null languages and
    sources are groups of their own. Only documents that pass the plain rules take part, equal vectors of a group as
    one, so that copies of a text don't pull its estimate."""
    passed = stats.where(~base_failed(F.col)).select("lang", "source", *[x.alias(n) for n, x in features(F.col).items()])
    part = passed.withColumn("level", F.explode(F.array(*[F.lit(k) for k in range(3)]))).select(
        "level", F.when(F.col("level") < 2, F.col("lang")).alias("lang"), F.when(F.col("level") < 1, F.col("source")).alias("source"), *FEATURES).distinct()
    part = cut_lineage(part)
    sizes = part.groupBy(*KEYS).agg(F.count(F.lit(1)).alias("size")).where((F.col("size") >= MIN_ROWS) | (F.col("level") == 2))
    return _fit(cut_lineage(_of_group(part, cut_lineage(sizes.select(*KEYS)), "left_semi")))


def judge(rows: DataFrame, model: DataFrame) -> DataFrame:
    """Add base_failed, far (squared distance; null where no estimate exists) and kept to rows with lang, source and
    the counts of BASE. ``rows`` may have further columns."""
    estimates = []
    for level, keys in enumerate([["lang", "source"], ["lang"], []]):
        part = model.where(F.col("level") == level).select(*[F.col(k).alias(f"_{k}{level}") for k in keys], F.struct("mean", "inverse").alias(f"_m{level}"))
        on = [rows[k].eqNullSafe(part[f"_{k}{level}"]) for k in keys]
        estimates.append((part, on))
    out = rows
    for part, on in estimates[:2]:
        out = join_small(out, part, on, "left")
    corpus = model.where(F.col("level") == 2).select("mean", "inverse").first()  # one row
    constant = F.lit(None) if corpus is None else F.struct(F.array(*map(F.lit, corpus["mean"])).alias("mean"), F.array(*map(F.lit, corpus["inverse"])).alias("inverse"))
    out = out.withColumn("_m", F.coalesce("_m0", "_m1", constant.cast("struct<mean:array<double>,inverse:array<double>>")))
    for n, x in features(F.col).items():
        out = out.withColumn(n, x)
    out = out.withColumn("base_failed", base_failed(F.col)).withColumn("far", distance(F.col("_m.mean"), F.col("_m.inverse")))
    out = out.withColumn("kept", ~F.col("base_failed") & (F.col("far").isNull() | (F.col("far") <= CUTOFF)))
    return out.drop("_m", "_m0", "_m1", "_lang0", "_source0", "_lang1", *FEATURES)


def measured(docs: DataFrame) -> DataFrame:
    """``doc`` (the row as a struct), lang, source and the counts of BASE per row of ``docs``."""
    bound_batches(docs.sparkSession)
    counts = F.arrow_udf(_counts, BASE)
    rows = docs.select(F.struct("*").alias("doc"), counts(F.col("text")).alias("c"))
    return rows.select("doc", F.col("doc.lang").cast("string").alias("lang"), F.col("doc.source").cast("string").alias("source"), "c.*")


def keep_good(docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` (text, lang, source and any others) that are kept, unchanged.

    The counts are cheaper to take twice (for the estimates, then for the verdicts) than the texts are to shuffle.
    Null texts have no words and fail the plain rules. Empty input: empty result.
    """
    model = fit_outlier_model(cut_lineage(measured(docs).drop("doc")))
    return judge(measured(docs), model).where("kept").select("doc.*")


def op10_robust_outliers(spark, sf_dir):
    """Counts and verdicts of every document; the counts are taken once and written, without the texts."""
    docs = read(spark, sf_dir, "documents").select("doc_id", "text", "lang", "source")
    stats = cut_lineage(measured(docs).withColumn("doc_id", F.col("doc.doc_id")).drop("doc"))
    return judge(stats, fit_outlier_model(stats)).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept",
        "lang", "source", F.round("far", 6).alias("distance"))
