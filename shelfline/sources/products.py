"""The product list that seeds the product dimension."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from shelfline.schemas import PRODUCT_SEED

# Family, category, subcategory, is_fmcg, is_perishable as published.
SEED_ROWS = [
    ("GROCERY I", "FMCG", "Staples", 1, 0),
    ("GROCERY II", "FMCG", "Staples", 1, 0),
    ("BEVERAGES", "FMCG", "Beverages", 1, 0),
    ("CLEANING", "FMCG", "Home Care", 1, 0),
    ("PERSONAL CARE", "FMCG", "Personal Care", 1, 0),
    ("HOME CARE", "FMCG", "Home Care", 1, 0),
    ("BABY CARE", "FMCG", "Baby Care", 1, 0),
    ("PRODUCE", "Fresh", "Vegetables", 1, 1),
    ("DAIRY", "Fresh", "Dairy", 1, 1),
    ("BREAD/BAKERY", "Fresh", "Bakery", 1, 1),
    ("POULTRY", "Fresh", "Poultry", 1, 1),
    ("MEATS", "Fresh", "Meat", 1, 1),
    ("EGGS", "Fresh", "Eggs", 1, 1),
    ("SEAFOOD", "Fresh", "Seafood", 1, 1),
    ("DELI", "Fresh", "Deli", 1, 1),
    ("FROZEN FOODS", "Fresh", "Frozen", 1, 0),
    ("PREPARED FOODS", "Fresh", "Ready Meals", 1, 1),
    ("LIQUOR,WINE,BEER", "Non-Food", "Beverages", 0, 0),
    ("HOME AND KITCHEN I", "Non-Food", "Household", 0, 0),
    ("HOME AND KITCHEN II", "Non-Food", "Household", 0, 0),
    ("HOME APPLIANCES", "Non-Food", "Appliances", 0, 0),
    ("HARDWARE", "Non-Food", "Hardware", 0, 0),
    ("LAWN AND GARDEN", "Non-Food", "Garden", 0, 0),
    ("BEAUTY", "Non-Food", "Beauty", 0, 0),
    ("LINGERIE", "Non-Food", "Clothing", 0, 0),
    ("LADIESWEAR", "Non-Food", "Clothing", 0, 0),
    ("CELEBRATION", "Non-Food", "Gifts", 0, 0),
    ("PLAYERS AND ELECTRONICS", "Non-Food", "Electronics", 0, 0),
    ("AUTOMOTIVE", "Non-Food", "Automotive", 0, 0),
    ("PET SUPPLIES", "Non-Food", "Pet Care", 0, 0),
    ("SCHOOL AND OFFICE SUPPLIES", "Non-Food", "Stationery", 0, 0),
    ("MAGAZINES", "Non-Food", "Media", 0, 0),
    ("BOOKS", "Non-Food", "Media", 0, 0),
]


def product_seed(spark: SparkSession, rows: list[tuple] | None = None) -> DataFrame:
    """The list as literals in the plan, so the optimizer knows how small it is and no Python worker starts."""
    names = PRODUCT_SEED.fieldNames()
    literals = [F.struct(*[F.lit(v).alias(n) for n, v in zip(names, row)]) for row in rows or SEED_ROWS]
    return spark.range(1).select(F.inline(F.array(*literals)))
