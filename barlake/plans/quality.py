"""Q1-Q5: data-quality checks as Spark jobs, reported as one DataFrame.

Each written table is scanned once for all of its checks (``table_checks``).  Output columns:
``table_name, check_name, column_names, failures`` (0 = pass).  ``failing_rows`` gives the
rows behind those numbers.  A singular check is any query: it fails by the rows it returns.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from barlake.fixed import KNOWN_MARKETS, TICKER_TYPES
from barlake.operators.unions import union_all


def _row(df_one_value: DataFrame, table: str, check: str, columns: str) -> DataFrame:
    return df_one_value.select(F.lit(table).alias("table_name"), F.lit(check).alias("check_name"),
                               F.lit(columns).alias("column_names"),
                               F.coalesce(F.col("failures"), F.lit(0)).cast("bigint").alias("failures"))


def accepted_values(df: DataFrame, table: str, column: str, values: Sequence[str]) -> DataFrame:
    """Q4: distinct values outside the accepted list (NULL is not reported)."""
    bad = df.where(~F.col(column).isin(list(values))).select(column).distinct()
    return _row(bad.agg(F.count(F.lit(1)).alias("failures")), table, "accepted_values", column)


def table_checks(df: DataFrame, table: str, not_null_cols: Sequence[str] = (),
                 key: Sequence[str] = (), assertions: dict[str, Column] | None = None) -> DataFrame:
    """Every check of one table from a single pass over it.

    Rows are grouped by ``key`` (map-side combined) carrying NULL counts and assertion
    hits, then folded once more: not-null failures, duplicated keys (NULL keys skipped for
    a single column, kept for a combination) and rows hitting each assertion (rows where
    the condition is NULL are not reported).  The table is computed once, not once per
    check.
    """
    assertions = assertions or {}
    flags = ([F.col(c).isNull().cast("bigint").alias(f"_nn{i}") for i, c in enumerate(not_null_cols)]
             + [cond.cast("bigint").alias(f"_as{i}") for i, cond in enumerate(assertions.values())])
    names = [f"_nn{i}" for i in range(len(not_null_cols))] + [f"_as{i}" for i in range(len(assertions))]
    base = df.select(*[F.col(k) for k in key], *flags)
    sums = [F.sum(n).alias(n) for n in names]
    if key:
        per_key = base.groupBy(*key).agg(F.count(F.lit(1)).alias("_n"), *sums)
        dup = F.col("_n") > 1
        if len(key) == 1:
            dup = dup & F.col(key[0]).isNotNull()
        agg = per_key.agg(*sums, F.sum(dup.cast("bigint")).alias("_dup"))
    else:
        agg = base.agg(*sums)
    rows = [F.struct(F.lit("not_null").alias("k"), F.lit(c).alias("c"), F.col(f"_nn{i}").alias("f"))
            for i, c in enumerate(not_null_cols)]
    if key:
        check = "unique" if len(key) == 1 else "unique_combination_of_columns"
        rows.append(F.struct(F.lit(check).alias("k"), F.lit(",".join(key)).alias("c"),
                             F.col("_dup").alias("f")))
    rows += [F.struct(F.lit(name).alias("k"), F.lit("").alias("c"), F.col(f"_as{i}").alias("f"))
             for i, name in enumerate(assertions)]
    return agg.select(F.explode(F.array(*rows)).alias("x")).select(
        F.lit(table).alias("table_name"), F.col("x.k").alias("check_name"),
        F.col("x.c").alias("column_names"),
        F.coalesce(F.col("x.f"), F.lit(0)).cast("bigint").alias("failures"))


def failing_rows(df: DataFrame, not_null_cols: Sequence[str] = (), key: Sequence[str] = (),
                 assertions: dict[str, Column] | None = None,
                 accepted: dict[str, Sequence[str]] | None = None) -> DataFrame:
    """Rows of ``df`` with ``check_name`` and ``column_names``, once per check that they fail:
    by the rules of ``table_checks`` and ``accepted_values``; of a repeated key, every row.

    Row checks are one narrow pass.  Repeated keys are counted with a combine before the
    shuffle, and only rows with such a key are looked up.
    """
    cols = df.columns

    def hit(cond: Column, check: str, of: str) -> Column:
        return F.when(cond, F.struct(F.lit(check).alias("check_name"), F.lit(of).alias("column_names")))
    hits = [hit(F.col(c).isNull(), "not_null", c) for c in not_null_cols]
    hits += [hit(cond, name, "") for name, cond in (assertions or {}).items()]
    hits += [hit(~F.col(c).isin(list(values)), "accepted_values", c) for c, values in (accepted or {}).items()]
    none = F.array().cast("array<struct<check_name:string,column_names:string>>")
    found = (df.select("*", F.explode(F.array_compact(F.array(*hits)) if hits else none).alias("_hit"))
             .select(*cols, "_hit.*"))
    if not key:
        return found
    repeated = df.groupBy(*key).agg(F.count(F.lit(1)).alias("_n")).where(F.col("_n") > 1)
    if len(key) == 1:
        repeated = repeated.where(F.col(key[0]).isNotNull())
    same = [F.col(f"_a.{k}").eqNullSafe(F.col(f"_b.{k}")) for k in key]
    dup = df.alias("_a").join(repeated.alias("_b"), reduce(lambda a, b: a & b, same), "left_semi").select(
        *cols, F.lit("unique" if len(key) == 1 else "unique_combination_of_columns").alias("check_name"),
        F.lit(",".join(key)).alias("column_names"))
    return found.unionByName(dup)


def singular(spark: SparkSession, sql: str, tables: dict[str, DataFrame]) -> DataFrame:
    """The rows that a singular check returns: ``sql`` over ``tables``, by the names it uses
    in braces.  The check passes when there are none."""
    return spark.sql(sql, **tables)


def singular_report(checks: dict[str, DataFrame]) -> DataFrame:
    """check_name, failures, passed of any queries given as DataFrames."""
    rows = [df.agg(F.count(F.lit(1)).alias("failures")).select(F.lit(name).alias("check_name"), "failures")
            for name, df in checks.items()]
    return union_all(rows).withColumn("passed", F.col("failures") == 0)


def quality_report(t: dict[str, DataFrame]) -> DataFrame:
    """All checks over the tables named in ``t`` (each table computed once)."""
    markets_ok = ~F.col("market").isin(list(KNOWN_MARKETS))
    checks = [
        table_checks(t["stg_stock_prices"], "stg_stock_prices",
                     ["date", "ticker", "open", "high", "low", "close", "volume"], ["date", "ticker"]),
        table_checks(t["daily_returns"], "daily_returns", ["date", "ticker", "close"]),
        table_checks(t["top_movers"], "top_movers", ["ticker"], ["ticker"]),
        table_checks(t["index_performance"], "index_performance", ["ticker"], ["ticker"],
                     {"assert_index_markets_are_valid": markets_ok}),
        table_checks(t["sector_top_movers"], "sector_top_movers", ["ticker", "sector"]),
        table_checks(t["whale_signals"], "whale_signals", ["ticker", "date"]),
        table_checks(t["whale_signals_history"], "whale_signals_history", ["ticker", "date"]),
        table_checks(t["tickers"], "tickers", ["ticker", "type"], ["ticker"]),
        accepted_values(t["tickers"], "tickers", "type", TICKER_TYPES),
    ]
    return union_all(checks)


def failed(report: DataFrame) -> DataFrame:
    return report.where(F.col("failures") > 0)
