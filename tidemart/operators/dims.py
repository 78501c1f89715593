"""Dimension joins."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemart.functions.times import DATE_FORMAT, parse_time


def join_dimension(facts: DataFrame, dimension: DataFrame, fact_key: str,
                   columns: dict[str, str | Column], how: str = "left",
                   dimension_key: str = "id") -> DataFrame:
    """Add `columns` (new name -> dimension column) by key.

    Stored keys are text and are cast to the type of the fact's key, where the text is the one that this
    type has for the key: 7 finds "7" and not "07", so a key finds one row. The dimension holds one
    row per key. Nothing is hinted: a dimension that Spark's statistics show to be small is
    broadcast; a large one is joined by shuffle, where AQE splits the partitions of hot keys.
    """
    key = F.col(dimension_key).try_cast(facts.schema[fact_key].dataType)
    added = [(F.col(c) if isinstance(c, str) else c).alias(name) for name, c in columns.items()]
    keyed = dimension.where(key.cast("string") == F.col(dimension_key)).select(key.alias("_key"), *added)
    kept = [c for c in facts.columns if c not in columns]
    return facts.select(*kept).join(keyed, F.col(fact_key) == F.col("_key"), how).drop("_key")


def age(birthday, as_of: Column | None = None) -> Column:
    """Whole years from a yyyy-MM-dd birthday to `as_of` (today by default)."""
    as_of = F.current_date() if as_of is None else as_of
    born = parse_time(birthday, DATE_FORMAT).cast("date")
    return F.floor(F.months_between(as_of, born) / 12).cast("int")


def join_user(facts: DataFrame, users: DataFrame, as_of: Column | None = None,
              how: str = "left") -> DataFrame:
    return join_dimension(facts, users, "user_id",
                          {"user_age": age("birthday", as_of), "user_gender": "gender"}, how)


def join_province(facts: DataFrame, provinces: DataFrame, how: str = "left") -> DataFrame:
    return join_dimension(facts, provinces, "province_id", {
        "province_name": "name", "province_area_code": "area_code",
        "province_iso_code": "iso_code", "province_3166_2_code": "iso_3166_2"}, how)


def product_dimension(skus: DataFrame, spus: DataFrame, trademarks: DataFrame,
                      categories: DataFrame) -> DataFrame:
    """Sku rows with spu, brand and category names: the snowflake folded into one table.

    Folding on the dimension side (small) leaves one join for the fact side (large).
    """
    def link(name: str) -> Column:
        return F.col(name).try_cast("bigint").alias(name)

    flat = skus.select("id", "sku_name", F.col("price").try_cast("decimal(18,2)").alias("price"),
                       link("spu_id"), link("tm_id"), link("category3_id"))
    flat = join_dimension(flat, spus, "spu_id", {"spu_name": "spu_name"})
    flat = join_dimension(flat, trademarks, "tm_id", {"tm_name": "tm_name"})
    return join_dimension(flat, categories, "category3_id", {"category3_name": "name"})


def join_product(facts: DataFrame, products: DataFrame, how: str = "left",
                 price: str | None = None) -> DataFrame:
    """Sku, spu, brand and category columns by sku_id; `price` names a column for the price."""
    columns = {c: c for c in ("sku_name", "spu_id", "spu_name", "tm_id", "tm_name",
                              "category3_id", "category3_name")}
    if price:
        columns[price] = "price"
    return join_dimension(facts, products, "sku_id", columns, how)
