"""Most clicked products per sales area."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from shopflow.functions.columns import concat_distinct
from shopflow.operators.joins import broadcast_if_small

# --- Fixed values: area level map of the reference (its city dimension) ----
REFERENCE_AREA_LEVELS = {
    "华北": "A_Level", "华东": "A_Level",
    "华中": "B_Level", "华南": "B_Level",
    "西南": "C_Level", "西北": "C_Level",
}
DEFAULT_LEVEL = "D_Level"
# ---------------------------------------------------------------------------


def area_clicks(actions: DataFrame, city_dim: DataFrame) -> DataFrame:
    """Product clicks (non-clicks filtered first) joined with the city
    dimension; the dimension is broadcast after a size check."""
    clicks = actions.where(F.col("click_product_id") != -1).select(
        "city_id", F.col("click_product_id").alias("pid"))
    dim = broadcast_if_small(city_dim.select("city_id", "city_name", "area"))
    return clicks.join(dim, "city_id").select("city_id", "city_name", "area", "pid")


def area_product_counts(clicks: DataFrame) -> DataFrame:
    """(area, pid, click_count, city_infos): city_infos is the sorted
    distinct ``city_id:city_name`` list.  Counts are pre-aggregated per city
    first, so the list is built from one row per city, never per click."""
    per_city = clicks.groupBy("area", "pid", "city_id", "city_name").agg(F.count(F.lit(1)).alias("n"))
    return per_city.groupBy("area", "pid").agg(
        F.sum("n").alias("click_count"),
        concat_distinct(F.concat_ws(":", F.col("city_id").cast("string"), F.col("city_name")))
        .alias("city_infos"))


def area_product_info(counts: DataFrame, products: DataFrame) -> DataFrame:
    """+ product name and status: 'Self' when the document's top-level
    ``product_status`` is the number 0 or the text "0", else 'Third Party'.
    A missing or broken document, another type there (object, list, null), or a
    status that stands deeper all give 'Third Party' and stop nothing; text
    after the document is not read."""
    info = F.try_parse_json("extend_info")
    status = F.try_variant_get(info, "$.product_status", "string")
    p = products.select(
        F.col("product_id").alias("pid"), "product_name",
        F.when(status == "0", "Self").otherwise("Third Party").alias("product_status"))
    return counts.join(p, "pid").select(
        "area", "pid", "click_count", "city_infos", "product_name", "product_status")


def area_level(levels: dict[str, str], default: str = DEFAULT_LEVEL):
    expr = None
    for area, level in levels.items():
        cond = F.col("area") == area
        expr = F.when(cond, level) if expr is None else expr.when(cond, level)
    return F.lit(default) if expr is None else expr.otherwise(default)


def area_top_products(info: DataFrame, n: int = 3,
                      levels: dict[str, str] = REFERENCE_AREA_LEVELS) -> DataFrame:
    """Top ``n`` products per area by clicks (pid ascending on ties), with
    the area level.  ``row_number <= n`` is cut per task before the shuffle."""
    w = Window.partitionBy("area").orderBy(F.desc("click_count"), F.asc("pid"))
    return (info.withColumn("rn", F.row_number().over(w)).where(F.col("rn") <= n)
            .select("area", area_level(levels).alias("area_level"), "pid", "city_infos",
                    "click_count", "product_name", "product_status"))
