"""Quality rules by robust multivariate outliers, in DataFrame functions only.

Every text gets a few statistics and two fixed base rules.  Of the rest, per language and source, a minimum covariance
determinant estimate is fitted to transformed statistics, and rows far from it by Mahalanobis distance are rejected.

The estimate is the distributed form of the fast MCD: start from medians and absolute deviations, then repeat
concentration steps (keep the share ``SUBSET`` of rows with the least distances, take their mean and covariance).  Each
step is one aggregate that combines in the tasks, so a source with most of the rows is no hot key; order statistics are
exact percentiles of values rounded to ``DIGITS`` decimals, which bounds what an aggregate has to hold.  A term
``FLOORS`` on the diagonal (in transformed units) keeps statistics that are mostly zero from rejecting every row that
is not zero, and keeps the covariance regular.

Every estimate of n rows is shrunk: a source's with the weight n / (n + ``SHRINK``) towards its language's, that one in
the same way towards the estimate of all rows, and the covariance of all rows towards the wide spread ``WIDE``.  The rule
is the same at every size; a source of many rows is judged by itself, one of a few rows by its language.

Defined cases: a null text has no words and fails the base rules; null language or source is a value like any other;
equal rows get equal verdicts; an empty table gives an empty result; other columns are ignored, whatever their names.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from starloom.llm.common import SPACE_CLASS, content_key, filter_rows, let, staged

WINDOW = 5
MIN_WORDS, REPEAT_PERCENT = 10, 20
#: Transformed statistics and the standard deviation that each is granted besides what the data show.
FLOORS = {"x_length": 0.06, "x_symbols": 0.10, "x_lines": 0.10, "x_repeats": 0.15}
FEATURES = tuple(FLOORS)
#: Words of a neutral text added to every text, so that ratios of short texts scatter no more than those of long ones.
NEUTRAL_WORDS, NEUTRAL_LENGTH = 50, 5.0
SUBSET, STEPS, DIGITS = 0.75, 3, 3
#: Rows at which an estimate counts half (two for each statistic), and standard deviations granted without any row.
SHRINK, WIDE = 8, 0.5
#: Share of a normal population that the cut-off rejects.
TAIL = 1e-4
COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")


def words_of(text: Column) -> Column:
    return F.filter(F.split(text, f"[{SPACE_CLASS}]+"), lambda w: w != "")


def _repeat_words(words: Column) -> Column:
    """Words inside windows of five words that the text holds twice or more."""

    def covered(hashes):
        ordered = F.sort_array(F.transform(hashes, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))

        def starts(s):
            twin = lambda e, j: F.coalesce((e.h == F.get(s, j - 1).h) | (e.h == F.get(s, j + 1).h), e.h == F.get(s, j - 1).h, e.h == F.get(s, j + 1).h)
            marked = F.transform(s, lambda e, j: F.when(twin(e, j), e.i))
            return F.sort_array(F.filter(marked, lambda i: i.isNotNull()))

        def length(p):
            steps = F.transform(p, lambda i, j: F.least(F.lit(WINDOW), F.coalesce(F.get(p, j + 1) - i, F.lit(WINDOW))))
            return F.aggregate(steps, F.lit(0).cast("long"), lambda a, x: a + x)

        return let(ordered, lambda s: let(starts(s), length))

    windows = F.transform(
        F.sequence(F.lit(0), F.size(words) - WINDOW), lambda i: F.xxhash64(*[F.get(words, i + k) for k in range(WINDOW)])
    )
    counted = let(windows, lambda h: F.when(F.size(F.array_distinct(h)) < F.size(h), covered(h)).otherwise(F.lit(0).cast("long")))
    return F.when(F.size(words) > WINDOW, counted).otherwise(F.lit(0).cast("long"))


def statistics(text: Column) -> Column:
    """Struct of the counts in :data:`COUNTS` for a text that is not null."""
    of_words = let(
        words_of(text),
        lambda w: F.struct(
            F.size(w).cast("long").alias("n_words"),
            F.aggregate(w, F.lit(0).cast("long"), lambda a, x: a + F.length(x)).alias("word_chars"),
            _repeat_words(w).alias("n_repeat_words"),
        ),
    )
    lines = F.filter(F.split(text, "\n"), lambda x: x.rlike(f"[^{SPACE_CLASS}]"))
    return let(
        of_words,
        lambda s: F.struct(
            s.n_words.alias("n_words"),
            s.word_chars.alias("word_chars"),
            (F.length(text) - F.length(F.regexp_replace(text, r"[#*$%&|<>]+", ""))).cast("long").alias("n_symbols"),
            let(lines, lambda x: (F.size(x) - F.size(F.array_distinct(x))).cast("long")).alias("n_dup_lines"),
            s.n_repeat_words.alias("n_repeat_words"),
        ),
    )


def _chi2_cdf(x: float, dof: int) -> float:
    """Closed form for an even number of degrees of freedom."""
    half, term, total = x / 2, 1.0, 0.0
    for k in range(dof // 2):
        total += term
        term *= half / (k + 1)
    return 1 - math.exp(-half) * total


def chi2_quantile(p: float, dof: int) -> float:
    low, high = 0.0, 1000.0
    for _ in range(200):
        middle = (low + high) / 2
        low, high = (middle, high) if _chi2_cdf(middle, dof) < p else (low, middle)
    return high


#: Makes the covariance of the kept share unbiased for normal rows.
CONSISTENCY = SUBSET / _chi2_cdf(chi2_quantile(SUBSET, len(FEATURES)), len(FEATURES) + 2)
CUTOFF = chi2_quantile(1 - TAIL, len(FEATURES))


def measured(docs: DataFrame) -> DataFrame:
    """Per row: doc_id, content, lang, source, the counts, base_failed and the transformed statistics."""
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    rows = docs.select("doc_id", content_key().alias("content"), F.col("lang").cast("string"), F.col("source").cast("string"), statistics(text).alias("s"))
    n = F.col("n_words") + NEUTRAL_WORDS
    transformed = {
        "x_length": F.log((F.col("word_chars") + NEUTRAL_WORDS * NEUTRAL_LENGTH) / n),
        "x_symbols": F.sqrt(F.col("n_symbols") / n),
        "x_lines": F.sqrt(F.col("n_dup_lines") / n),
        "x_repeats": F.asin(F.sqrt(F.col("n_repeat_words") / n)),
    }
    failed = (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > REPEAT_PERCENT * F.col("n_words"))
    flat = rows.select("doc_id", "content", "lang", "source", *[F.col(f"s.{c}").alias(c) for c in COUNTS])
    return flat.withColumn("base_failed", failed).withColumns({k: F.round(v, 9) for k, v in transformed.items()})


def _same(left: DataFrame, right: DataFrame, *keys: str, how: str = "inner") -> DataFrame:
    """Null-safe join on equally named keys, the right ones dropped."""
    renamed = right.withColumnsRenamed({k: f"__{k}" for k in keys})
    on = [F.col(k).eqNullSafe(F.col(f"__{k}")) for k in keys]
    return left.join(renamed, on, how).drop(*[f"__{k}" for k in keys])


#: A group of rows that an estimate is made of: a source, a language, or all.
GROUP = ("level", "g_lang", "g_source")
PAIRS = [(i, k) for i in range(len(FEATURES)) for k in range(i + 1)]


def _distance(centre: dict[str, Column], factor: dict[tuple[int, int], Column]) -> Column:
    """Squared length of L^-1 (x - centre), by forward substitution."""
    solved: list[Column] = []
    for i, name in enumerate(FEATURES):
        value = F.col(name) - centre[name]
        for k in range(i):
            value = value - factor[i, k] * solved[k]
        solved.append(value / factor[i, i])
    return sum((z * z for z in solved), F.lit(0.0))


def _cholesky(cov: DataFrame) -> DataFrame:
    """Adds l_i_k, the factor of the regularised covariance c_i_k, column by column."""
    for k, name in enumerate(FEATURES):
        diagonal = CONSISTENCY * F.col(f"c_{k}_{k}") + FLOORS[name] ** 2
        for j in range(k):
            diagonal = diagonal - F.col(f"l_{k}_{j}") * F.col(f"l_{k}_{j}")
        cov = cov.withColumn(f"l_{k}_{k}", F.sqrt(diagonal))
        for i in range(k + 1, len(FEATURES)):
            value = CONSISTENCY * F.col(f"c_{i}_{k}")
            for j in range(k):
                value = value - F.col(f"l_{i}_{j}") * F.col(f"l_{k}_{j}")
            cov = cov.withColumn(f"l_{i}_{k}", value / F.col(f"l_{k}_{k}"))
    return cov


def _with_distance(rows: DataFrame, estimate: DataFrame, *keys: str, how: str = "inner") -> DataFrame:
    joined = _same(rows, estimate, *keys, how=how)
    centre = {f: F.col(f"m_{f}") for f in FEATURES}
    factor = {(i, k): F.col(f"l_{i}_{k}") for i in range(len(FEATURES)) for k in range(i + 1)}
    return joined.withColumn("d2", _distance(centre, factor)).select(*rows.columns, "d2")


def estimates(rows: DataFrame, single: bool = False) -> DataFrame:
    """Rows n, location m_*, covariance c_* and factor l_* per group of :data:`GROUP`, from rows that carry the group and the features.

    ``single`` says that all rows are one group.  Nothing is left to join by then, and Spark would plan a Cartesian
    product, which reads the rows once per shuffle partition; the group's one row is broadcast instead.
    """
    per_group = F.broadcast if single else (lambda few: few)
    size, floor = len(FEATURES), [FLOORS[f] for f in FEATURES]
    rows = rows.where(~F.col("base_failed") & F.col("level").isNotNull())
    near = lambda c, p: F.percentile(F.round(c, DIGITS), F.lit(p))
    medians = rows.groupBy(*GROUP).agg(*[near(F.col(f), 0.5).alias(f"m_{f}") for f in FEATURES])
    deviations = _same(rows, per_group(medians), *GROUP).groupBy(*GROUP, *[f"m_{f}" for f in FEATURES]).agg(*[near(F.abs(F.col(f) - F.col(f"m_{f}")), 0.5).alias(f"d_{f}") for f in FEATURES])
    start = {f"l_{i}_{k}": (F.greatest(1.4826 * F.col(f"d_{FEATURES[i]}"), F.lit(floor[i])) if i == k else F.lit(0.0)) for i in range(size) for k in range(i + 1)}
    estimate = staged(deviations.withColumns(start).drop(*[f"d_{f}" for f in FEATURES]), "mcd")
    for _ in range(STEPS):
        far = _with_distance(rows, per_group(estimate), *GROUP).withColumn("d2", F.round(F.log(F.col("d2") + 1e-9), DIGITS))
        limits = far.groupBy(*GROUP).agg(F.percentile("d2", F.lit(SUBSET)).alias("limit"), F.count(F.lit(1)).alias("n"))
        inside = _same(far, per_group(limits), *GROUP).where(F.col("d2") <= F.col("limit"))
        moments = inside.groupBy(*GROUP).agg(
            F.max("n").alias("n"),
            *[F.avg(f).alias(f"m_{f}") for f in FEATURES],
            *[F.covar_pop(FEATURES[i], FEATURES[k]).alias(f"c_{i}_{k}") for i, k in PAIRS],
        )
        estimate = staged(_cholesky(moments), "mcd")
    return estimate


def _shrunk(own: DataFrame, towards: DataFrame, *keys: str) -> DataFrame:
    """``own`` (keys, n, m_*, c_*) moved towards the row of ``towards`` that has the same ``keys``, the fewer rows it has the more."""
    numbers = [f"m_{f}" for f in FEATURES] + [f"c_{i}_{k}" for i, k in PAIRS]
    joined = _same(own, towards.select(*keys, *[F.col(c).alias(f"t_{c}") for c in numbers]), *keys)
    weight = F.col("n") / (F.col("n") + SHRINK)
    return joined.withColumns({c: weight * F.col(c) + (1 - weight) * F.col(f"t_{c}") for c in numbers}).drop(*[f"t_{c}" for c in numbers])


def shrunk_estimates(rows: DataFrame) -> DataFrame:
    """Per (lang, source): location m_* and factor l_* that judge its rows."""
    known = [f"m_{f}" for f in FEATURES] + [f"c_{i}_{k}" for i, k in PAIRS]
    found = []
    for level, (lang, source) in enumerate((("lang", "source"), ("lang", None), (None, None))):
        # Level by level, so that the few rows of languages are broadcast whatever the number of sources.
        none = F.lit(None).cast("string")
        grouped = rows.withColumns({"level": F.lit(level), "g_lang": F.col(lang) if lang else none, "g_source": F.col(source) if source else none})
        found.append(estimates(grouped, single=lang is None).select(F.col("g_lang").alias("lang"), F.col("g_source").alias("source"), F.lit(0).alias("all"), "n", *known))
    sources, languages, everything = found
    weight = F.col("n") / (F.col("n") + SHRINK)
    wide = {f"c_{i}_{k}": weight * F.col(f"c_{i}_{k}") + ((1 - weight) * WIDE**2 if i == k else 0.0) for i, k in PAIRS}
    languages = _shrunk(languages, F.broadcast(everything.withColumns(wide)), "all")  # one row
    return staged(_cholesky(_shrunk(sources, languages, "lang")).drop("all", "n", *[f"c_{i}_{k}" for i, k in PAIRS]), "mcd")


def quality_verdicts(docs: DataFrame, cutoff: float = CUTOFF) -> DataFrame:
    """Per row of ``docs``: doc_id, content, lang, source, the counts, base_failed, distance and kept."""
    rows = staged(measured(docs), "quality")
    judged = _with_distance(rows, shrunk_estimates(rows), "lang", "source", how="left")
    kept = ~F.col("base_failed") & (F.coalesce(F.col("d2"), F.lit(0.0)) <= cutoff)
    return judged.select("doc_id", "content", "lang", "source", *COUNTS, "base_failed", F.sqrt("d2").alias("distance"), kept.alias("kept"))


def keep_good(docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` that no rule rejects, with the columns they came with."""
    rejected = quality_verdicts(docs).where(~F.col("kept")).select("doc_id", "content")
    return filter_rows(docs, rejected, keep=False)
