"""Quality rules: base rules, then robust multivariate outliers.

Per language and source, the transformed statistics of the documents that pass the base
rules get a minimum-covariance-determinant estimate: from medians and quartile ranges,
concentration steps repeat "take the share ``support`` of rows with the smallest
Mahalanobis distances, estimate centre and covariance from them" until the determinants
settle; then the covariance is scaled to the median distance and the estimate reweighted
once.  Documents beyond the distance ``cutoff`` are rejected.

Every step covers all rows and is one aggregation per (group, distance bin): bins carry
counts, sums and cross products, so a group that holds a third of all rows is combined
map-side, the chosen share is a running sum over a group's bins, and only bins meet in a
task.  Statistics are rounded to integers and summed as decimals, so results do not
depend on partitioning.  Every group has its own estimate, shrunk towards that of its
language, which is shrunk towards that of all rows: n rows give the own one the weight
1 - (2 * p / n)^2, from 2 * p rows on.  Below 2 * p rows in all nothing is rejected.
Variances have a floor, since most clean texts have no symbols at all.

Defined results: a null text has no words and fails the base rules; null language or
source is a group of its own; repeated rows are judged one by one, and count so; no rows
give no rows.  A very long text is read whole, like any other.  Other columns are ignored,
whatever their names.
"""

from __future__ import annotations

from collections import Counter
from functools import reduce

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window

from barlake.llm import common
from barlake.llm.common import checked_broadcast, row_number, slices, written

# Fixed values of the base rules and the quantiles of chi-square with 5 degrees of freedom.
LEAST_WORDS = 50
CHI2_MEDIAN, CHI2_975 = 4.351, 12.833
UNIT = 1000  # statistics are kept as integers of 1 / UNIT
# statistic -> smallest standard deviation
STATISTICS = {"log_word_length": 0.05, "root_symbols": 0.10, "root_upper": 0.06,
              "root_repeats": 0.12, "root_dup_lines": 0.15}
P = len(STATISTICS)
SUPPORT = 0.75
CUTOFF = 32.0  # squared distance: between clean and junk documents of the labelled rows
_SPACE = b" \t\n\x0b\x0c\r"
_SYMBOLS = b"#*$%&|<>"
_NOT_FIRST = bytes(range(0x80, 0xC0))
_UPPER = bytes(range(0x41, 0x5B))


def repeat_words(words: list) -> int:
    """Words in 3-word windows found twice or more, the first included."""
    n = len(words) - 2
    if n < 2:
        return 0
    windows = list(zip(words, words[1:], words[2:]))
    if len(set(windows)) == n:
        return 0
    count, total, to = Counter(windows), 0, 0
    for i, w in enumerate(windows):
        if count[w] > 1:
            total += i + 3 - max(i, to)
            to = i + 3
    return total


def text_statistics(text: bytes) -> tuple[int, ...]:
    """n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, n_lines, n_upper."""
    words = text.split()  # bytes.split parts at \x20 and \x09-\x0D
    lines = [x for x in text.split(b"\n") if x.strip(_SPACE)]
    return (len(words), len(text.translate(None, _NOT_FIRST + _SPACE)),
            len(text) - len(text.translate(None, _SYMBOLS)), len(lines) - len(set(lines)),
            repeat_words(words), len(lines), len(text) - len(text.translate(None, _UPPER)))


_COUNTS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines", "n_upper"]


def _statistics(batches):
    for batch in slices(batches):
        rows = np.array([text_statistics(t or b"") for t in batch.column("text").cast(pa.binary()).to_pylist()],
                        np.int64).reshape(-1, len(_COUNTS))
        words, chars, lines = (np.maximum(rows[:, i], 1) for i in (0, 1, 5))
        x = np.stack([np.log(chars / words), np.sqrt(rows[:, 2] / words), np.sqrt(rows[:, 6] / chars),
                      np.sqrt(rows[:, 4] / words), np.sqrt(rows[:, 3] / lines)], axis=1)
        cols = [batch.column(c) for c in ("uid", "doc_id", "lang", "source")]
        cols += [pa.array(rows[:, i]) for i in range(len(_COUNTS))]
        cols.append(pa.ListArray.from_arrays(
            pa.array(np.arange(0, P * len(x) + 1, P), pa.int32()),
            pa.array(np.rint(x * UNIT).astype(np.int64).ravel())))
        yield pa.RecordBatch.from_arrays(cols, names=["uid", "doc_id", "lang", "source", *_COUNTS, "x"])


def statistics(docs: DataFrame) -> DataFrame:
    """Counts and integer statistics ``x`` of every row, with ``base_failed``."""
    rows = docs.select(row_number(docs).alias("uid"),
                       F.col("doc_id").cast("bigint").alias("doc_id"),
                       F.col("lang").cast("string").alias("lang"),
                       F.col("source").cast("string").alias("source"), "text")
    schema = ("uid bigint, doc_id bigint, lang string, source string, "
              + ", ".join(f"{c} bigint" for c in _COUNTS) + ", x array<bigint>")
    return rows.mapInArrow(_statistics, schema).withColumn(
        "base_failed", (F.col("n_words") < LEAST_WORDS) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words")))


def _grouped(stats: DataFrame) -> DataFrame:
    """``stats`` with ``grp`` (language and source) and ``pool`` (language)."""
    pool = F.concat(F.lit("lang "), F.coalesce(F.concat(F.lit("="), "lang"), F.lit("null")))
    grp = F.to_json(F.struct(F.coalesce("lang", F.lit("\0")).alias("l"), F.coalesce("source", F.lit("\0")).alias("s")))
    return stats.withColumn("grp", grp).withColumn("pool", pool)


def distance(x: Column, centre: Column, inverse: Column) -> Column:
    """Squared Mahalanobis distance; ``inverse`` is the upper triangle, row by row."""
    d = [x[i] / F.lit(UNIT) - centre[i] for i in range(P)]
    at, terms = 0, []
    for i in range(P):
        for j in range(i, P):
            terms.append(d[i] * d[j] * inverse[at] * (1 if i == j else 2))
            at += 1
    return sum(terms[1:], terms[0])


def _solve(batches):
    """Sums of a group -> centre, inverse covariance (upper triangle), log determinant."""
    floor = np.diag(np.square(list(STATISTICS.values())))
    upper = np.triu_indices(P)
    for rows in batches:
        out = []
        for r in rows.itertuples():
            mean = np.array([float(v) for v in r.s]) / r.n / UNIT
            cov = np.zeros((P, P))
            cov[upper] = np.array([float(v) for v in r.q]) / r.n / UNIT**2
            cov = cov + cov.T - np.diag(np.diag(cov)) - np.outer(mean, mean)
            cov = cov * r.factor
            cov = cov + np.diag(np.maximum(0, np.diag(floor) - np.diag(cov)))
            cov = cov + 1e-9 * np.eye(P)
            out.append((r.grp, r.rows, mean.tolist(), np.linalg.inv(cov)[upper].tolist(),
                        float(np.linalg.slogdet(cov)[1])))
        yield pd.DataFrame(out, columns=["grp", "rows", "centre", "inverse", "logdet"])


_ESTIMATE = "grp string, rows bigint, centre array<double>, inverse array<double>, logdet double"


def _start(fit: DataFrame) -> DataFrame:
    """Medians and quartile ranges; the percentile state is bounded, as x is integer."""
    stat = fit.groupBy("grp").agg(F.count("*").alias("rows"), *[
        F.percentile(F.col("x")[i], F.array(F.lit(0.25), F.lit(0.5), F.lit(0.75))).alias(f"p{i}") for i in range(P)])

    def run(batches):
        floor = np.square(list(STATISTICS.values()))
        upper = np.triu_indices(P)
        for rows in batches:
            out = []
            for r in rows.itertuples():
                q = np.array([getattr(r, f"p{i}") for i in range(P)]) / UNIT
                var = np.maximum(floor, np.square((q[:, 2] - q[:, 0]) / 1.349))
                out.append((r.grp, r.rows, q[:, 1].tolist(), np.diag(1 / var)[upper].tolist(),
                            float(np.log(var).sum())))
            yield pd.DataFrame(out, columns=["grp", "rows", "centre", "inverse", "logdet"])
    return stat.mapInPandas(run, _ESTIMATE)


def _distances(fit: DataFrame, estimate: DataFrame) -> DataFrame:
    """Squared distances of all rows from their groups' estimates.  Where there are too many
    groups for a broadcast, the languages and the whole still are few: only the rows' own
    groups are joined by a shuffle, and no key of theirs is on every row."""
    known = estimate.withColumnRenamed("grp", "egrp")
    joined = [(fit, checked_broadcast(known))]
    if estimate.count() > common.BROADCAST_ROWS:
        joined = [(fit.where(c), checked_broadcast(known.where(k))) for c, k in (
            (F.col("grp").startswith("{"), F.col("egrp").startswith("{")),
            (~F.col("grp").startswith("{"), ~F.col("egrp").startswith("{")))]
    rows = reduce(DataFrame.unionByName, [a.join(b, F.col("grp") == F.col("egrp")) for a, b in joined])
    return rows.withColumn("d2", distance(F.col("x"), F.col("centre"), F.col("inverse")))


def _step(fit: DataFrame, estimate: DataFrame, support: float | None) -> DataFrame:
    """One concentration step; without ``support`` the reweighting by the 0.975 quantile,
    after scaling the distances to their median."""
    d = _distances(fit, estimate)
    bins = (d.groupBy("grp", "rows", F.floor(16 * F.log2(1 + F.col("d2"))).alias("bin"))
            .agg(F.count("*").alias("n"),
                 *[F.sum(F.col("x")[i].cast("decimal(18,0)")).alias(f"s{i}") for i in range(P)],
                 *[F.sum((F.col("x")[i] * F.col("x")[j]).cast("decimal(18,0)")).alias(f"q{i}{j}")
                   for i in range(P) for j in range(i, P)]))
    running = Window.partitionBy("grp").orderBy("bin")
    bins = bins.withColumn("before", F.sum("n").over(running) - F.col("n"))
    if support is None:
        whole = Window.partitionBy("grp")
        middle = F.max(F.when(F.col("before") <= F.col("rows") / 2, F.col("bin"))).over(whole)
        scale = F.greatest(F.lit(1.0), (F.pow(F.lit(2.0), (middle + 0.5) / 16) - 1) / CHI2_MEDIAN)
        bins = bins.withColumn("scale", scale)
        chosen = bins.where(F.pow(F.lit(2.0), F.col("bin") / 16) - 1 <= CHI2_975 * F.col("scale"))
    else:
        # the share's spread is smaller than the whole's by a factor that a step cannot
        # know; distances only rank rows here, so it does not matter until the last step
        chosen = bins.where(F.col("before") < support * F.col("rows")).withColumn("scale", F.lit(1.0))
    sums = chosen.groupBy("grp", "rows").agg(
        F.sum("n").alias("n"), F.lit(1.0).alias("factor"),
        F.array(*[F.sum(f"s{i}") for i in range(P)]).alias("s"),
        F.array(*[F.sum(f"q{i}{j}") for i in range(P) for j in range(i, P)]).alias("q"))
    return sums.mapInPandas(_solve, _ESTIMATE)


def estimates(fit: DataFrame, support: float = SUPPORT) -> DataFrame:
    """Centre and inverse covariance per ``grp`` of rows with integer statistics ``x``.

    Steps go on until the determinants fall no more.  Each counted step lowers their sum by
    a thousandth at least, and floors hold them from below, so they end."""
    now, last = written(_start(fit), "mcd"), None
    while True:
        after = written(_step(fit, now, support), "mcd")
        total = after.agg(F.sum(F.round("logdet", 3).cast("decimal(20,3)"))).first()[0]
        if total is None or last is not None and total >= last:  # no group, or settled
            return written(_step(fit, now, None), "mcd")
        now, last = after, total


def _weight(rows: int) -> float:
    """Weight of a group's own estimate against that of the group around it: 0 up to
    2 * p rows, then rising with the rows, without a step."""
    return 1 - (2 * P / max(rows, 2 * P)) ** 2


def _shrink(batches):
    """Own, language's and whole estimate of a group -> centre and inverse covariance."""
    upper = np.triu_indices(P)

    def estimate(centre, inverse):
        m = np.zeros((P, P))
        m[upper] = inverse
        return np.array(centre), np.linalg.inv(m + m.T - np.diag(np.diag(m)))

    for rows in batches:
        out = []
        for r in rows.itertuples():
            centre, cov = estimate(r.centre0, r.inverse0)
            for n, c, i in ((r.rows1, r.centre1, r.inverse1), (r.rows2, r.centre2, r.inverse2)):
                own, w = estimate(c, i), _weight(n)
                centre, cov = w * own[0] + (1 - w) * centre, w * own[1] + (1 - w) * cov
            out.append((r.egrp, centre.tolist(), np.linalg.inv(cov)[upper].tolist()))
        yield pd.DataFrame(out, columns=["egrp", "centre", "inverse"])


def shrunk(fit: DataFrame, support: float = SUPPORT) -> DataFrame:
    """egrp, centre, inverse of every ``grp`` of rows (grp, pool, x): the group's estimate
    shrunk towards its language's, and that towards the estimate of all rows; none if
    all rows together are fewer than 2 * p."""
    levels = fit.select("x", F.explode(F.array("grp", "pool", F.lit("*"))).alias("grp"))
    known = estimates(levels, support)

    def at(level: int) -> DataFrame:
        return known.select(*[F.col(c).alias(f"{c}{level}") for c in ("grp", "rows", "centre", "inverse")])

    groups = fit.groupBy(F.col("grp").alias("egrp"), "pool").count().drop("count")
    whole = at(0).where((F.col("grp0") == "*") & (F.col("rows0") >= 2 * P))
    joined = (groups.join(checked_broadcast(at(2)), F.col("egrp") == F.col("grp2"))
              .join(checked_broadcast(at(1)), F.col("pool") == F.col("grp1"))
              .crossJoin(F.broadcast(whole)))
    return written(joined.mapInPandas(_shrink, "egrp string, centre array<double>, inverse array<double>"), "mcd")


def judged(docs: DataFrame, support: float = SUPPORT, cutoff: float = CUTOFF) -> DataFrame:
    """Statistics, base_failed, d2 (null without an estimate) and kept of every row."""
    stats = _grouped(written(statistics(docs), "quality-statistics"))
    known = shrunk(stats.where(~F.col("base_failed")), support)
    d2 = distance(F.col("x"), F.col("centre"), F.col("inverse"))
    return (stats.join(checked_broadcast(known), F.col("grp") == F.col("egrp"), "left")
            .withColumn("d2", d2)
            .withColumn("kept", ~F.col("base_failed") & (F.coalesce("d2", F.lit(0.0)) <= cutoff))
            .drop("egrp", "centre", "inverse"))


def quality_rules(docs: DataFrame, **options) -> DataFrame:
    """doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
    kept, distance of every row of ``docs`` (doc_id, text, lang, source)."""
    return judged(docs, **options).select("doc_id", *_COUNTS[:5], "base_failed", "kept",
                                          F.sqrt("d2").alias("distance"))
