"""Data-quality audits over staging tables (AG-2, FLT-9, JN-4, JN-5, ST-1, SL-3).

The original runs these by hand as T-SQL; here each is a DataFrame function so
it can be scheduled after a load and its result written next to the run log.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewater.operators import joins


def key_quality(df: DataFrame, key: str) -> DataFrame:
    """AG-2: total rows, distinct ids, distinct ids that convert to BIGINT."""
    return df.agg(
        F.count(F.lit(1)).alias("total_rows"),
        F.count_distinct(F.col(key)).alias("distinct_ids"),
        F.count_distinct(F.col(key).try_cast("bigint")).alias("distinct_numeric"),
    )


def null_fk(df: DataFrame, fk: str) -> DataFrame:
    """FLT-9: rows whose foreign key IS NULL."""
    return df.where(F.col(fk).isNull())


def accounts_without_children(accounts: DataFrame, account_col: str,
                              children: DataFrame, child_col: str) -> DataFrame:
    """JN-4: NOT EXISTS on ``try_cast(bare(id) as bigint)``."""
    return joins.anti_normalized(accounts, account_col, children, child_col)


def convertible_without_children(keys: DataFrame, key_col: str,
                                 children: DataFrame, child_col: str) -> DataFrame:
    """JN-5: NOT EXISTS restricted to keys that convert (no prefix stripping)."""
    return joins.anti_convertible(keys, key_col, children, child_col)


def except_converted(keys: DataFrame, key_col: str, children: DataFrame, child_col: str,
                     alias: str = "id") -> DataFrame:
    """ST-1: ``EXCEPT`` (distinct, null-safe) of converted ids minus child ids.
    Unconvertible ids collapse to one NULL row, as in SQL."""
    left = keys.select(F.col(key_col).try_cast("bigint").alias(alias))
    right = children.select(F.col(child_col).cast("bigint").alias(alias))
    return left.subtract(right)


def top_n(df: DataFrame, order_col: str, n: int) -> DataFrame:
    """SL-3: ``TOP n ... ORDER BY col DESC``."""
    return df.orderBy(F.col(order_col).desc()).limit(n)


def recent_runs(run_log: DataFrame, n: int = 30) -> DataFrame:
    """SL-3 over the run log: the latest ``n`` step rows, newest run first."""
    return run_log.orderBy(F.col("RunId").desc(), F.col("StartedAt").desc()).limit(n)
