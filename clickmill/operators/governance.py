"""Masks and row restrictions as views a query is built on."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clickmill import constants as C


def mask_column(df: DataFrame, col: str, role: str, allowed: list[str]) -> DataFrame:
    """Constant mask unless the role is allowed; the test folds at planning time."""
    visible = F.lit(role).isin(*allowed)
    return df.withColumn(col, F.when(visible, F.col(col)).otherwise(F.lit(C.CONSTANT_MASK)))


def hash_mask(df: DataFrame, cols: list[str], role: str, allowed: list[str]) -> DataFrame:
    """One-way hash unless the role is allowed; equal values stay countable."""
    visible = F.lit(role).isin(*allowed)
    return df.withColumns({
        c: F.when(visible, F.col(c)).otherwise(F.sha2(F.col(c), 256)) for c in cols
    })


def register_mask_user_id(spark) -> None:
    """SQL function for analysts: the id for members of the group, else a mask."""
    spark.sql(f"""
        CREATE OR REPLACE TEMPORARY FUNCTION mask_user_id(user_id STRING, member_of ARRAY<STRING>)
        RETURNS STRING
        RETURN CASE WHEN array_contains(member_of, 'data_engineers') THEN user_id
                    ELSE '{C.USER_ID_MASK}' END
    """)


def row_security(
    df: DataFrame, entitlements: DataFrame, user: str, role: str,
    column: str = "country", admin_roles: tuple[str, ...] = ("ACCOUNTADMIN",),
) -> DataFrame:
    """Rows whose ``column`` the user is entitled to; ``ALL`` entitles to every row.

    The wildcard is a one-row scalar; the rest is an equality join on distinct
    codes. The rule's OR would otherwise force a nested-loop join.
    """
    if role in admin_roles:
        return df
    mine = entitlements.filter(F.col("user_name") == user)
    sees_all = mine.agg(F.coalesce(F.bool_or(F.col("country_code") == "ALL"), F.lit(False))).scalar()
    granted = mine.select(F.col("country_code").alias(column), F.lit(True).alias("_granted")).distinct()
    return (
        df.join(granted, column, "left")
        .filter(F.col("_granted").isNotNull() | sees_all)
        .select(*df.columns)
    )
