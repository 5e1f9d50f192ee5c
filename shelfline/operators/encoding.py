"""Numeric codes and interaction columns for the model-ready panel."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from shelfline.functions.lookups import CODE_BY_CATEGORY, CODE_BY_STORE_TYPE, STAPLE_FAMILY, lookup
from shelfline.operators.cleaning import clip_negative, fill_critical_nulls, fill_numeric_nulls
from shelfline.operators.features import family_ranks, series_sums
from shelfline.plans.sizing import join_dim
from shelfline.plans.staging import Stage, lazy


def encode_store_type(df: DataFrame) -> DataFrame:
    return df.withColumn("store_type_encoded", lookup(F.col("store_type"), CODE_BY_STORE_TYPE, 0))


def encode_category(df: DataFrame) -> DataFrame:
    return df.withColumn("category_encoded", lookup(F.col("category"), CODE_BY_CATEGORY, 0))


def encode_family_rank(df: DataFrame, stage: Stage = lazy, sums: DataFrame | None = None) -> DataFrame:
    """Average rank of the family's total sales, cut to an integer. ``sums`` per series spare a pass over ``df``."""
    sums = sums if sums is not None else stage(series_sums(df.select("store_id", "family", F.col("sales").cast("double").alias("sales"))), "family_sums")
    ranks = family_ranks(sums, "_rank").select("family", "_rank")
    joined = join_dim(df, ranks, "family", "left", bound=sums)
    return joined.withColumn("family_encoded", F.coalesce(F.col("_rank").cast("int"), F.lit(0))).drop("_rank")


def interaction_features(df: DataFrame, staple: str = STAPLE_FAMILY) -> DataFrame:
    return df.withColumns({
        "promo_weekend": F.col("onpromotion") * F.col("is_weekend"),
        "ramadan_fmcg": F.col("is_ramadan_period") * F.col("is_fmcg"),
        "wedding_grocery": F.col("is_wedding_season") * (F.col("family") == staple).cast("int"),
        "payday_spending": F.col("is_payday_week") * F.col("category_encoded"),
    })


def build_ml_ready(star: DataFrame, staple: str = STAPLE_FAMILY, stage: Stage = lazy, sums: DataFrame | None = None) -> DataFrame:
    """Quality repairs, encodings and interactions on the star query's rows."""
    df = clip_negative(fill_critical_nulls(star))
    df = encode_category(encode_family_rank(encode_store_type(df), stage, sums))
    return fill_numeric_nulls(interaction_features(df, staple))
