"""Most clicked products of each sales area."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from footfall.functions import concat_long_string, group_concat_distinct, json_field
from footfall.operators.topn import first_n

TOP_PRODUCTS = 3

# Level of each area; other areas are of the lowest level.
AREA_LEVELS = {
    "A级": ["华北", "华东"],
    "B级": ["华南", "华中"],
    "C级": ["西北", "西南"],
}
OTHER_LEVEL = "D级"
OWN_PRODUCT, THIRD_PARTY_PRODUCT = "自营", "第三方"


def click_city_product(actions: DataFrame) -> DataFrame:
    """City and product of each click on a product."""
    return actions.where("click_product_id IS NOT NULL").select(
        "city_id", F.col("click_product_id").alias("product_id")
    )


def click_product_basic(clicks: DataFrame, cities: DataFrame) -> DataFrame:
    """Clicks with city name and area; clicks in unknown cities are dropped."""
    return clicks.join(cities, "city_id").select("city_id", "city_name", "area", "product_id")


def area_product_clicks(clicks: DataFrame, cities: DataFrame) -> DataFrame:
    """Clicks of each product in each area, with the cities they came from.

    Clicks are counted by city and product before cities are looked up, so the join and
    the list of cities work on one row per city and product and not on every click.
    """
    by_city = clicks.groupBy("city_id", "product_id").agg(F.count("*").alias("clicks"))
    return (
        by_city.join(cities, "city_id")
        .groupBy("area", "product_id")
        .agg(
            F.sum("clicks").alias("click_count"),
            group_concat_distinct(concat_long_string("city_id", "city_name")).alias("city_infos"),
        )
    )


def product_status(products: DataFrame) -> DataFrame:
    """Products with their name and whether they are the shop's own or a third party's."""
    status = F.when(json_field("extend_info", "product_status") == "0", OWN_PRODUCT).otherwise(THIRD_PARTY_PRODUCT)
    return products.select("product_id", "product_name", status.alias("product_status"))


def area_full_product_clicks(area_clicks: DataFrame, products: DataFrame) -> DataFrame:
    """Area clicks with product name and status; unknown products are dropped.

    The status is read from JSON once per product, before the join.
    """
    return area_clicks.join(product_status(products), "product_id").select(
        "area", "product_id", "click_count", "city_infos", "product_name", "product_status"
    )


def area_level(area="area") -> Column:
    """Level label of an area."""
    area = F.col(area) if isinstance(area, str) else area
    levels = [F.when(area.isin(areas), level) for level, areas in AREA_LEVELS.items()]
    return F.coalesce(*levels, F.lit(OTHER_LEVEL))


def area_top_products(full_clicks: DataFrame, n: int = TOP_PRODUCTS) -> DataFrame:
    """First ``n`` products of each area by clicks, most first; ties by product id."""
    top = first_n(full_clicks, ["area"], [F.desc("click_count"), F.asc("product_id")], n)
    return top.select(
        "area",
        area_level().alias("area_level"),
        "product_id",
        "click_count",
        "city_infos",
        "product_name",
        "product_status",
    )
