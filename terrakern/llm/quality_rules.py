"""Quality rules: base rules and robust multivariate outliers, in DataFrame functions only.

Each text gives a vector of transformed rates.  For every language and source the
minimum-covariance-determinant estimate of location and scatter is found by
concentration steps: keep the three quarters of the documents that are nearest,
re-estimate mean and covariance from them, measure all again, until the
determinant falls no further; of three deterministic starts, the one that ends
with the least determinant counts, and is taken again from all documents that are
not far from it.  The estimate is drawn to that of the language, and this to that of
the corpus, the more the fewer documents it rests on.  A document whose
Mahalanobis distance is beyond the cutoff goes.

The vectors are integers (thousandths, clamped), so all sums are exact and every
run gives the same verdicts, and a percentile holds few distinct values.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from terrakern.llm.common import WORD_SPACE, stage

#: Words in a window of which repeats are looked for.
WINDOW = 5
#: Share of a group's documents that an estimate rests on.
CORE = 0.75
#: Share of normal data that the final, reweighted estimate rests on.
REWEIGHTED = 0.975
#: Concentration steps end when the logarithm of the determinant falls by less.
LEAST_FALL = 1e-9
#: What a wider group's estimate counts beside a group's own, in documents.
PRIOR = 40
#: A document is rejected beyond the squared distance that one normal document in so many would pass: about one in the largest
#: corpus (100 TB of texts of 300 bytes).  A less strict share loses good rows, see the README.
ONE_IN = 330e9
#: Thousandths; vectors are clamped to this.
CLAMP = 12_000
#: Least standard deviation of each coordinate, in thousandths.
FLOOR = {"word_length": 60.0, "symbols": 250.0, "dup_lines": 400.0, "repeats": 400.0}
AXES = tuple(FLOOR)
MOMENTS = tuple([f"m_{i}" for i in range(len(AXES))] + [f"c_{i}_{j}" for i in range(len(AXES)) for j in range(i + 1)])
DIGITS = 64  # squared distances are compared in steps of 1 / DIGITS


def chi_square_tail(x: float, degrees: int) -> float:
    """Probability that chi-square with an even number of degrees passes ``x``."""
    return math.exp(-x / 2) * sum((x / 2) ** k / math.factorial(k) for k in range(degrees // 2))


def chi_square_beyond(tail: float, degrees: int) -> float:
    """Where the tail of chi-square is ``tail``, by bisection."""
    low, high = 0.0, 1000.0
    for _ in range(100):
        mid = (low + high) / 2
        low, high = (mid, high) if chi_square_tail(mid, degrees) > tail else (low, mid)
    return high


def consistency(share: float) -> float:
    """Makes the covariance of the nearest ``share`` of normal data unbiased."""
    return share / (1 - chi_square_tail(chi_square_beyond(1 - share, len(AXES)), len(AXES) + 2))


CUTOFF = chi_square_beyond(1 / ONE_IN, len(AXES))


def _let(value: Column, use) -> Column:
    """``use(value)`` with the value worked out once."""
    return F.transform(F.array(value), use)[0]


def repeated_words(words: Column) -> Column:
    """Words inside 5-word windows that occur twice or more in the text (overlaps count once)."""

    def spans(keys: Column) -> Column:
        def covered(ordered: Column) -> Column:
            again = F.filter(ordered, lambda x, j: (F.get(ordered, j - 1)["h"] == x["h"]) | (F.get(ordered, j + 1)["h"] == x["h"]))
            places = F.array_sort(F.transform(again, lambda x: x["i"]))
            start = F.struct(F.lit(-WINDOW).cast("int").alias("last"), F.lit(0).cast("long").alias("n"))
            step = lambda seen, i: F.struct(i.alias("last"), (seen["n"] + F.least(F.lit(WINDOW), i - seen["last"])).alias("n"))
            return F.aggregate(places, start, step, lambda seen: seen["n"])

        return F.when(F.size(F.array_distinct(keys)) == F.size(keys), F.lit(0).cast("long")).otherwise(
            _let(F.array_sort(F.transform(keys, lambda h, i: F.struct(h.alias("h"), i.alias("i")))), covered)
        )

    windows = F.transform(F.sequence(F.lit(0), F.size(words) - WINDOW), lambda i: F.xxhash64(*[F.get(words, i + k) for k in range(WINDOW)]))
    return F.when(F.size(words) < WINDOW, F.lit(0).cast("long")).otherwise(_let(windows, spans))


def with_statistics(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """Add n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words (long), base_failed.

    Null and empty texts have 0 of each, and fail.
    """
    text = F.coalesce(F.col(text_col), F.lit(""))
    lines = F.filter(F.split(text, "\n"), lambda line: line.rlike(f"[^{WORD_SPACE}]"))
    held = docs.withColumn("__words", F.array_remove(F.split(text, f"[{WORD_SPACE}]+"), ""))
    words = F.col("__words")
    found = held.withColumns(
        {
            "n_words": F.size(words).cast("long"),
            "word_chars": F.length(F.array_join(words, "")).cast("long"),
            "n_symbols": F.length(F.regexp_replace(text, r"[^#*$%&|<>]+", "")).cast("long"),
            "n_dup_lines": _let(lines, lambda x: F.size(x) - F.size(F.array_distinct(x))).cast("long"),
            "n_repeat_words": repeated_words(words),
        }
    ).drop("__words")
    return found.withColumn("base_failed", (F.col("n_words") < 10) | (100 * F.col("n_repeat_words") > 20 * F.col("n_words")))


def _vector() -> dict[str, Column]:
    n = F.greatest(F.col("n_words"), F.lit(1))
    raw = {
        "word_length": F.log(F.greatest(F.col("word_chars"), F.lit(1)) / n),
        "symbols": F.log1p(100 * F.col("n_symbols") / F.greatest(F.col("word_chars"), F.lit(1))),
        "dup_lines": F.log1p(100 * F.col("n_dup_lines") / n),
        "repeats": F.log1p(100 * F.col("n_repeat_words") / n),
    }
    return {f"x_{k}": F.least(F.greatest(F.round(1000 * v), F.lit(-CLAMP)), F.lit(CLAMP)).cast("int") for k, v in raw.items()}


def _cholesky(cov: dict[tuple[int, int], Column]) -> list[tuple[str, Column]]:
    """Columns l_i_j (i >= j) of the lower factor, in an order in which each needs only earlier ones."""
    made = []
    for j in range(len(AXES)):
        rest = sum((F.col(f"l_{j}_{k}") * F.col(f"l_{j}_{k}") for k in range(j)), F.lit(0.0))
        made.append((f"l_{j}_{j}", F.sqrt(F.greatest(cov[j, j] - rest, F.lit(FLOOR[AXES[j]] ** 2 * 1e-3)))))
        for i in range(j + 1, len(AXES)):
            dot = sum((F.col(f"l_{i}_{k}") * F.col(f"l_{j}_{k}") for k in range(j)), F.lit(0.0))
            made.append((f"l_{i}_{j}", (cov[i, j] - dot) / F.col(f"l_{j}_{j}")))
    return made


def _distance(df: DataFrame) -> DataFrame:
    """Add d2, the squared Mahalanobis distance by centre m_i and factor l_i_j (forward substitution)."""
    for i, axis in enumerate(AXES):
        inner = sum((F.col(f"l_{i}_{k}") * F.col(f"__z{k}") for k in range(i)), F.lit(0.0))
        df = df.withColumn(f"__z{i}", (F.col(f"x_{axis}") - F.col(f"m_{i}") - inner) / F.col(f"l_{i}_{i}"))
    square = sum((F.col(f"__z{i}") * F.col(f"__z{i}") for i in range(len(AXES))), F.lit(0.0))
    return df.withColumn("d2", square).drop(*[f"__z{i}" for i in range(len(AXES))])


def _factors(fit: DataFrame, cov: dict[tuple[int, int], Column], keep: list[str]) -> DataFrame:
    """``keep`` and the lower factor l_i_j of the covariance."""
    for name, value in _cholesky(cov):
        fit = fit.withColumn(name, value)
    return fit.select(*keep, *[f"l_{i}_{j}" for i in range(len(AXES)) for j in range(i + 1)])


def _fitted(sample: DataFrame, group: list[str], scale: float) -> DataFrame:
    """Mean m_i, (floored) covariance c_i_j and its lower factor per group, from exact integer sums over ``n`` rows each."""
    xs = [F.col(f"x_{a}").cast("long") for a in AXES]
    sums = [F.sum(F.col("n") * x).alias(f"s_{i}") for i, x in enumerate(xs)]
    sums += [F.sum((F.col("n") * xs[i] * xs[j]).cast("decimal(38,0)")).alias(f"s_{i}_{j}") for i in range(len(xs)) for j in range(i + 1)]
    out = sample.groupBy(*group).agg(F.sum("n").alias("n_core"), *sums)
    out = out.withColumns({f"m_{i}": F.col(f"s_{i}") / F.col("n_core") for i in range(len(xs))})
    cov = {(i, j): scale * (F.col(f"s_{i}_{j}").cast("double") / F.col("n_core") - F.col(f"m_{i}") * F.col(f"m_{j}")) for i in range(len(xs)) for j in range(i + 1)}
    for i, axis in enumerate(AXES):
        cov[i, i] = cov[i, i] + FLOOR[axis] ** 2
    out = out.withColumns({f"c_{i}_{j}": value for (i, j), value in cov.items()})
    return _factors(out, {key: F.col(f"c_{key[0]}_{key[1]}") for key in cov}, [*group, *MOMENTS])


def _same(rows: DataFrame, group: list[str]) -> Column:
    """Null-safe equality of the group with the other side's columns named __g_."""
    on = [rows[g].eqNullSafe(F.col(f"__g_{g}")) for g in group]
    condition = on[0]
    for more in on[1:]:
        condition = condition & more
    return condition


def _joined(rows: DataFrame, by_group: DataFrame, group: list[str]) -> DataFrame:
    """Null-safe join on the group; the small side is broadcast only if its measured size allows."""
    right = by_group.select(*[F.col(g).alias(f"__g_{g}") for g in group], *[c for c in by_group.columns if c not in group])
    return rows.join(right, _same(rows, group), "left").drop(*[f"__g_{g}" for g in group])


def _starts(counts: DataFrame, group: list[str]) -> tuple[DataFrame, DataFrame]:
    """n_group of every group, and its first centres and factors, named by ``start``.

    0: medians and MADs; 1: mean and covariance of all rows; 2: mean and covariance of
    the rows within one and a half robust deviations of the median on every axis,
    if there are any.
    """
    found = stage(counts.groupBy(*group).agg(F.sum("n").alias("n_group"), *[F.expr(f"percentile(x_{a}, 0.5, n)").alias(f"m_{i}") for i, a in enumerate(AXES)]), "quality-fit")
    sizes, medians = found.select(*group, "n_group"), found.drop("n_group")
    mads = _joined(counts, medians, group).groupBy(*group).agg(*[F.expr(f"percentile(cast(abs(x_{a} - m_{i}) as int), 0.5, n)").alias(f"w_{i}") for i, a in enumerate(AXES)])
    diagonal = {f"l_{i}_{j}": F.sqrt((1.4826 * F.col(f"w_{i}")) ** 2 + FLOOR[AXES[i]] ** 2) if i == j else F.lit(0.0) for i in range(len(AXES)) for j in range(i + 1)}
    robust = stage(_joined(medians, mads, group).withColumns(diagonal).drop(*[f"w_{i}" for i in range(len(AXES))]), "quality-fit")
    near = F.lit(True)
    for i, a in enumerate(AXES):
        near = near & (F.abs(F.col(f"x_{a}") - F.col(f"m_{i}")) <= 1.5 * F.col(f"l_{i}_{i}"))
    middle = _fitted(_joined(counts, robust, group).filter(near).select(*counts.columns), group, 1.0)
    made = [robust, _fitted(counts, group, 1.0), middle]
    made = [x.select(*group, F.lit(k).alias("start"), *[c for c in robust.columns if c not in group]) for k, x in enumerate(made)]
    return sizes, made[0].union(made[1]).union(made[2])


def _core_fits(counts: DataFrame, group: list[str]) -> DataFrame:
    """Minimum-covariance-determinant location and scatter per group, by concentration steps, with n_group.

    Each of ``counts`` stands for ``n`` equal vectors.  From each start, steps go on
    until one doesn't lower the determinant (of the floored covariance); of a group's
    fits, the one of least determinant is taken.  Each step is an aggregation with
    partial sums and a join with one row per group and open start.
    """
    sizes, fit = _starts(counts, group)
    keys = [*group, "start"]
    least = F.lit(None).cast("double")
    ended = None
    while True:
        fit = stage(fit.withColumn("least", least), "quality-fit")
        if fit.isEmpty():
            break
        measured = _distance(counts.join(fit.withColumnsRenamed({g: f"__g_{g}" for g in group}), _same(counts, group), "inner").drop(*[f"__g_{g}" for g in group]))
        measured = measured.withColumn("bin", F.least(F.floor(F.col("d2") * DIGITS), F.lit(1 << 16)).cast("int")).select(*counts.columns, "start", "bin")
        within = measured.groupBy(*keys).agg(F.expr(f"percentile(bin, {CORE}, n)").alias("edge"))
        core = _joined(measured, within, keys).filter(F.col("bin") <= F.ceil("edge"))
        made = _fitted(core, keys, consistency(CORE)).withColumn("det", sum((2 * F.log(F.col(f"l_{i}_{i}")) for i in range(len(AXES))), F.lit(0.0)))
        made = stage(_joined(made, fit.select(*keys, "least"), keys), "quality-fit")
        ended = made.drop("least") if ended is None else ended.union(made.drop("least"))
        fit, least = made.filter(F.col("least").isNull() | (F.col("det") < F.col("least") - LEAST_FALL)).drop("least"), F.col("det")
        fit = fit.select(*keys, *[c for c in fit.columns if c.startswith(("m_", "l_"))], "det")
    if ended is None:
        return sizes.withColumns({m: F.lit(None).cast("double") for m in MOMENTS})
    best = ended.groupBy(*group).agg(F.min(F.struct("det", "start", *MOMENTS)).alias("best")).select(*group, *[F.col(f"best.{m}").alias(m) for m in MOMENTS])
    return stage(_joined(sizes, best, group), "quality-fit")


def _reweighted(counts: DataFrame, fits: DataFrame, group: list[str]) -> DataFrame:
    """The fits with mean and covariance taken again from all rows within the REWEIGHTED quantile of the first estimate."""
    cov = {(i, j): F.col(f"c_{i}_{j}") for i in range(len(AXES)) for j in range(i + 1)}
    first = _factors(fits, cov, [*group, *[f"m_{i}" for i in range(len(AXES))]])
    near = _distance(_joined(counts, first, group)).filter(F.col("d2") <= chi_square_beyond(1 - REWEIGHTED, len(AXES))).select(*counts.columns)
    again = _fitted(near, group, consistency(REWEIGHTED)).withColumnsRenamed({m: f"again_{m}" for m in MOMENTS})
    return stage(_joined(fits, again, group).withColumns({m: F.coalesce(f"again_{m}", m) for m in MOMENTS}).select(*fits.columns), "quality-fit")


def _pooled(fits: DataFrame, wider: DataFrame, on: list[str]) -> DataFrame:
    """``fits`` with each moment drawn to that of the wider group, which counts as PRIOR documents."""
    wide = wider.select(*on, *[F.col(m).alias(f"wide_{m}") for m in MOMENTS])
    both = _joined(fits, wide, on) if on else fits.crossJoin(F.broadcast(wide))
    drawn = {m: (F.col("n_group") * F.col(m) + PRIOR * F.col(f"wide_{m}")) / (F.col("n_group") + PRIOR) for m in MOMENTS}
    return both.withColumns(drawn).drop(*[f"wide_{m}" for m in MOMENTS])


def estimates(vectors: DataFrame) -> DataFrame:
    """Centre m_i and factor l_i_j for every language and source with a row in ``vectors``.

    The corpus, each language, and each language and source are fitted by
    themselves; a language's moments are then drawn to the corpus's, and those of a
    language and source to its language's, by n / (n + PRIOR).  So a group of any
    size has an estimate, and the few rows of a small one do not make their own norm.
    Equal vectors are counted first, so the fits grow with the distinct ones.
    """
    xs = [f"x_{a}" for a in AXES]
    counts = stage(vectors.groupBy("lang", "source", *xs).agg(F.count("*").alias("n")), "quality-counts")
    by_lang = counts.groupBy("lang", *xs).agg(F.sum("n").alias("n"))
    everything = counts.groupBy(*xs).agg(F.sum("n").alias("n"))
    levels = [
        everything.select(F.lit(0).alias("level"), F.lit(None).cast(counts.schema["lang"].dataType).alias("lang"), F.lit(None).cast(counts.schema["source"].dataType).alias("source"), *xs, "n"),
        by_lang.select(F.lit(1).alias("level"), "lang", F.lit(None).cast(counts.schema["source"].dataType).alias("source"), *xs, "n"),
        counts.select(F.lit(2).alias("level"), "lang", "source", *xs, "n"),
    ]
    keys = ["level", "lang", "source"]
    counts = stage(levels[0].union(levels[1]).union(levels[2]), "quality-counts")
    fits = _reweighted(counts, _core_fits(counts, keys), keys)
    corpus, langs, groups = (fits.filter(F.col("level") == k).drop("level") for k in range(3))
    pooled = _pooled(groups, _pooled(langs, corpus, []), ["lang"])
    cov = {(i, j): F.col(f"c_{i}_{j}") for i in range(len(AXES)) for j in range(i + 1)}
    return stage(_factors(pooled, cov, ["lang", "source", *[f"m_{i}" for i in range(len(AXES))]]), "quality-fit")


STATISTICS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")


def verdicts(docs: DataFrame, carry: list[str], text_col: str = "text", lang_col: str = "lang", source_col: str = "source") -> DataFrame:
    """The ``carry`` columns of every row, with the statistics, base_failed, distance2 and kept.

    A row is kept unless it fails the base rules or its vector lies beyond CUTOFF in
    its language and source (nulls are a group of their own; small groups are judged
    mostly by their language, or by the corpus).  Estimates rest on rows that pass
    the base rules.  Null ids and repeated rows are judged like others and
    an empty table gives an empty result.  Carried columns travel in a struct, so
    their names cannot clash inside; one named like an added column is replaced.
    Statistics and carried columns are staged once in the shared folder.
    """
    group = ["lang", "source"]
    held = docs.select(
        F.struct(*[F.col(c) for c in carry]).alias("__row"), F.col(text_col).alias("text"), F.col(lang_col).alias("lang"), F.col(source_col).alias("source")
    )
    rows = stage(with_statistics(held).withColumns(_vector()).drop("text"), "quality")
    fit = estimates(rows.filter(~F.col("base_failed")))
    judged = _distance(_joined(rows, fit, group))
    added = [
        *[F.col(c) for c in STATISTICS],
        F.col("base_failed"),
        F.when(~F.col("base_failed"), F.col("d2")).alias("distance2"),
        (~F.col("base_failed") & (F.col("d2") <= CUTOFF)).alias("kept"),
    ]
    clash = {*STATISTICS, "base_failed", "distance2", "kept"}
    return judged.select(*[F.col("__row")[c].alias(c) for c in carry if c not in clash], *added)


def kept_documents(docs: DataFrame, text_col: str = "text", lang_col: str = "lang", source_col: str = "source") -> DataFrame:
    """The rows of ``docs`` that are kept, with all their columns."""
    packed = docs.select(F.struct(*[F.col(c) for c in docs.columns]).alias("__doc"), F.col(text_col).alias("text"), F.col(lang_col).alias("lang"), F.col(source_col).alias("source"))
    judged = verdicts(packed, ["__doc"]).filter("kept")
    return judged.select(*[F.col("__doc")[c].alias(c) for c in docs.columns])
