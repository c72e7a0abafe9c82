"""Stock search, availability and order feasibility."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemill.functions.values import QUALITY_CODES
from tidemill.operators.frames import all_of, contains_text


def overview(physical: DataFrame) -> DataFrame:
    """Stock per article and quality from the stock per bin."""
    return physical.groupBy("skuCode", "skuName", "quality").agg(
        F.sum("qty").alias("qty"), F.sum("occupied").alias("occupied")
    )


def quality_code(spoken: str) -> str:
    return QUALITY_CODES.get(spoken, spoken)


def search(df: DataFrame, sku: str | None = None, quality: str | None = None, bin_code: str | None = None,
           area: str | None = None, produce_date: str | None = None, production_no: str | None = None,
           literal: bool = False) -> DataFrame:
    """Rows that meet every predicate given; an empty or missing predicate does not restrict.

    ``sku`` and ``area`` are searched for in code and name; dates compare as text.
    """
    conditions: list[Column] = []
    if sku:
        conditions.append(
            contains_text(F.col("skuName"), sku, literal) | contains_text(F.col("skuCode"), sku, literal)
        )
    if quality:
        conditions.append(F.col("quality") == quality_code(quality))
    if bin_code:
        conditions.append(F.col("binCode") == bin_code)
    if area:
        conditions.append(
            contains_text(F.col("areaCode"), area, literal) | contains_text(F.col("areaName"), area, literal)
        )
    if produce_date:
        conditions.append(F.col("produceDate") == produce_date)
    if production_no:
        conditions.append(F.col("productionNo") == production_no)
    return df.filter(all_of(conditions))


def physical_response(df: DataFrame) -> DataFrame:
    """The nested answer rows of a physical search, with the free quantity."""
    return df.select(
        "skuCode", "skuName", "quality", "binCode", "areaCode", "areaName",
        F.struct("produceDate", "productionNo").alias("batchInfo"),
        F.col("qty").cast("bigint").alias("qty"),
        F.col("occupied").cast("bigint").alias("occupied"),
        (F.col("qty") - F.col("occupied")).cast("bigint").alias("available"),
    )


def availability(stock: DataFrame, qualities: Sequence[str] | None = None) -> DataFrame:
    """Total, occupied and free quantity per article over all qualities, or over the stated ones."""
    kept = stock if qualities is None else stock.filter(F.col("quality").isin(*map(quality_code, qualities)))
    return kept.groupBy("skuCode").agg(
        F.min("skuName").alias("skuName"),
        F.sum("qty").cast("bigint").alias("totalQty"),
        F.sum("occupied").cast("bigint").alias("totalOccupied"),
        F.sum(F.col("qty") - F.col("occupied")).cast("bigint").alias("availableQty"),
    )


def requested_availability(requested: DataFrame, stock: DataFrame, on_missing: str = "zero",
                           qualities: Sequence[str] | None = None) -> DataFrame:
    """Availability of requested articles, named by code or by name.

    ``on_missing='zero'`` answers an unknown article with zeros under the asked name; ``'status'`` reports
    ``NO_SKU`` and leaves the quantities empty.
    """
    asked = requested.select(F.col("sku").alias("asked")).distinct()
    per_article = availability(stock, qualities)
    # An article answers to its code and to its name; stock is added up per answer before the join.
    aliases = per_article.withColumn("asked", F.explode(F.array_distinct(F.array("skuCode", "skuName"))))
    found = aliases.groupBy("asked").agg(
        F.min("skuName").alias("skuName"), F.sum("totalQty").alias("totalQty"),
        F.sum("totalOccupied").alias("totalOccupied"), F.sum("availableQty").alias("availableQty"),
    )
    answer = asked.join(found, "asked", "left").withColumnRenamed("asked", "skuCode")
    if on_missing == "status":
        return answer.withColumn("status", F.when(F.col("skuName").isNull(), "NO_SKU").otherwise("FOUND"))
    if on_missing != "zero":
        raise ValueError("on_missing must be 'zero' or 'status'")
    zeros = {c: F.coalesce(F.col(c), F.lit(0)) for c in ("totalQty", "totalOccupied", "availableQty")}
    return answer.withColumns({"skuName": F.coalesce("skuName", "skuCode"), **zeros})


def bin_status(requests: DataFrame, physical: DataFrame) -> DataFrame:
    """``FOUND``, ``NO_SKU`` or ``NO_BIN`` and the matching bin rows for (sku, bin) requests.

    A request without a bin matches every bin of the article. Stock that is already added up says in ``n_rows`` how many
    rows each of its rows stands for.
    """
    n_rows = F.sum("n_rows") if "n_rows" in physical.columns else F.count("*")
    sums = [n_rows.alias("n_rows"), F.sum("qty").alias("qty"), F.sum("occupied").alias("occupied")]
    per_bin = physical.groupBy(F.col("skuCode").alias("sku"), F.col("binCode").alias("bin")).agg(*sums)
    per_sku = per_bin.groupBy("sku").agg(
        F.sum("n_rows").alias("all_rows"), F.sum("qty").alias("all_qty"), F.sum("occupied").alias("all_occupied")
    )
    # One row per article and one per bin: a request never meets the other bins of its article.
    answered = requests.select("sku", "bin").distinct().join(per_sku, "sku", "left").join(per_bin, ["sku", "bin"], "left")
    whole = F.col("bin").isNull()
    chosen = {c: F.when(whole, F.col(f"all_{part}")).otherwise(F.col(c))
              for c, part in (("n_rows", "rows"), ("qty", "qty"), ("occupied", "occupied"))}
    return answered.withColumns(chosen).select(
        "sku", "bin",
        F.when(F.col("all_rows").isNull(), "NO_SKU").when(F.col("n_rows").isNull(), "NO_BIN").otherwise("FOUND")
        .alias("status"),
        F.coalesce("n_rows", F.lit(0)).alias("n_rows"), "qty", "occupied",
        (F.col("qty") - F.col("occupied")).alias("available"),
    )


def order_lines_status(lines: DataFrame, available: DataFrame) -> DataFrame:
    """Every order line with the free quantity of its article, zero for an unknown one."""
    free = available.select(F.col("skuCode").alias("sku"), "availableQty")
    joined = lines.join(free, "sku", "left")
    known = F.coalesce("availableQty", F.lit(0))
    return joined.withColumn("availableQty", known).withColumn("line_ok", known >= F.col("qty"))


def order_feasibility(lines: DataFrame, available: DataFrame) -> DataFrame:
    """An order is accepted only when each of its lines can be served from stock.

    Lines of one article within an order are added up first.
    """
    summed = lines.groupBy("order_id", "sku").agg(F.sum("qty").alias("qty"))
    return order_lines_status(summed, available).groupBy("order_id").agg(
        F.count("*").alias("n_lines"),
        F.sum(F.col("line_ok").cast("int")).alias("n_ok"),
        F.bool_and("line_ok").alias("accepted"),
    )


# Named, parameterised queries for SQL users: SELECT * FROM sku_overview('x').
TABLE_FUNCTIONS = {
    "sku_overview": (
        "sku STRING",
        "skuCode STRING, skuName STRING, totalQty BIGINT, totalOccupied BIGINT, availableQty BIGINT",
        """SELECT sku, coalesce(name, sku), coalesce(total, 0), coalesce(taken, 0), coalesce(total - taken, 0)
           FROM (SELECT min(skuName) AS name, sum(qty) AS total, sum(occupied) AS taken
                 FROM {overview} WHERE skuCode = sku OR skuName = sku)""",
    ),
    "sku_bins": (
        "sku STRING, bin STRING DEFAULT NULL",
        "skuCode STRING, skuName STRING, quality STRING, binCode STRING, qty BIGINT, occupied BIGINT, "
        "available BIGINT",
        """SELECT skuCode, skuName, quality, binCode, qty, occupied, qty - occupied
           FROM {physical} WHERE skuCode = sku AND (bin IS NULL OR bin = '' OR binCode = bin)""",
    ),
    "stock_overview": (
        "needle STRING DEFAULT NULL, grade STRING DEFAULT NULL",
        "skuCode STRING, skuName STRING, quality STRING, qty BIGINT, occupied BIGINT",
        """SELECT skuCode, skuName, quality, qty, occupied FROM {overview}
           WHERE (needle IS NULL OR skuName RLIKE concat('(?i)', needle) OR skuCode RLIKE concat('(?i)', needle))
             AND (grade IS NULL OR quality = grade)""",
    ),
    "stock_bins": (
        "needle STRING DEFAULT NULL, grade STRING DEFAULT NULL, bin STRING DEFAULT NULL, "
        "area STRING DEFAULT NULL, made STRING DEFAULT NULL, lot STRING DEFAULT NULL",
        "skuCode STRING, skuName STRING, quality STRING, binCode STRING, areaCode STRING, areaName STRING, "
        "produceDate STRING, productionNo STRING, qty BIGINT, occupied BIGINT",
        """SELECT skuCode, skuName, quality, binCode, areaCode, areaName, produceDate, productionNo, qty, occupied
           FROM {physical}
           WHERE (needle IS NULL OR skuName RLIKE concat('(?i)', needle) OR skuCode RLIKE concat('(?i)', needle))
             AND (grade IS NULL OR quality = grade) AND (bin IS NULL OR binCode = bin)
             AND (area IS NULL OR areaCode RLIKE concat('(?i)', area) OR areaName RLIKE concat('(?i)', area))
             AND (made IS NULL OR produceDate = made) AND (lot IS NULL OR productionNo = lot)""",
    ),
}


def register_table_functions(spark: SparkSession, overview_view: str, physical_view: str, prefix: str = "") -> None:
    """SQL table functions over two views; the optimizer inlines their bodies into the calling query."""
    for name, (parameters, columns, body) in TABLE_FUNCTIONS.items():
        text = body.format(overview=overview_view, physical=physical_view)
        spark.sql(
            f"CREATE OR REPLACE TEMPORARY FUNCTION {prefix}{name}({parameters}) RETURNS TABLE({columns}) RETURN {text}"
        )
