"""Most clicked products per sales area."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shoptrail.functions import columns as C
from shoptrail.operators.ranking import top_per_group


def product_clicks(actions: DataFrame, areas: DataFrame) -> DataFrame:
    """Clicks per area and product, with the cities they came from.

    Clicks are counted per city and product first; only those counts meet the city table.
    """
    per_city = (
        actions.where(F.col("click_product_id") != -1)
        .groupBy("city_id", F.col("click_product_id").alias("product_id"))
        .agg(F.count(F.lit(1)).alias("clicks"))
    )
    city = F.concat_ws(":", "city_id", "city_name")
    return (
        per_city.join(areas, "city_id")
        .groupBy("area", "product_id")
        .agg(
            F.sum("clicks").alias("click_count"),
            F.array_join(F.array_sort(F.collect_set(city)), ",").alias("city_infos"),
        )
    )


def with_products(clicks: DataFrame, products: DataFrame) -> DataFrame:
    """Counts with product name and owner; products missing from the product table drop out."""
    status = C.json_field(F.col("extend_info"), "product_status")
    owner = F.when(status == "0", "Self").otherwise("Third Party")
    named = products.select("product_id", "product_name", owner.alias("product_status"))
    return clicks.join(named, "product_id")


def area_level(area: Column, levels: Mapping[str, str]) -> Column:
    """Level of an area; null when it has none."""
    by_level: dict[str, list[str]] = {}
    for name, level in levels.items():
        by_level.setdefault(level, []).append(name)
    result = None
    for level, names in by_level.items():
        result = (F if result is None else result).when(area.isin(names), level)
    return result


def top_products(enriched: DataFrame, levels: Mapping[str, str], n: int = 3) -> DataFrame:
    """The ``n`` most clicked products of each area."""
    order = [F.desc("click_count"), F.asc("product_id")]
    ranked = top_per_group(enriched, ["area"], order, n)
    return ranked.withColumn("area_level", area_level(F.col("area"), levels))
