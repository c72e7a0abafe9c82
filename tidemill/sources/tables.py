"""Table scans, SQL scans and a catalog profile."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemill.sources import schemas


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    """One benchmark table; the declared schema spares the footer-reading job."""
    return spark.read.schema(schemas.TABLES[name]).parquet(f"{folder}/{name}.parquet")


def register_views(spark: SparkSession, folder: str, names: list[str] | None = None, prefix: str = "") -> list[str]:
    """Temp views over the tables, so that SQL text can be run against them."""
    views = []
    for name in names or list(schemas.TABLES):
        table(spark, folder, name).createOrReplaceTempView(prefix + name)
        views.append(prefix + name)
    return views


def sheets(spark: SparkSession, paths: dict[str, tuple[str, str]]) -> dict[str, DataFrame]:
    """Several named sheets landed as parquet: ``{sheet: (path, schema)}``."""
    return {sheet: spark.read.schema(schema).parquet(path) for sheet, (path, schema) in paths.items()}


def sheet_row_counts(frames: dict[str, DataFrame]) -> DataFrame:
    counts = [df.agg(F.lit(name).alias("sheet"), F.count("*").alias("n_rows")) for name, df in frames.items()]
    return reduce(DataFrame.unionByName, counts)


def sql_scan(spark: SparkSession, query: str, **args: object) -> DataFrame:
    """A SQL query with named parameters; values are bound by the engine, never spliced into the text."""
    return spark.sql(query, args=args or None)


def conformed(df: DataFrame, schema: str) -> DataFrame:
    """The columns of a declared schema in its order and types; columns the frame lacks are null, others are left out."""
    wanted = T.StructType.fromDDL(schema).fields
    return df.select(*[
        (F.col(f"`{f.name}`") if f.name in df.columns else F.lit(None)).cast(f.dataType).alias(f.name) for f in wanted
    ])


def target_scan(df: DataFrame, columns: list[str], target: str, allowed: tuple[str, ...]) -> DataFrame:
    """Fixed columns plus one target column chosen at run time from a closed list."""
    if target not in allowed:
        raise ValueError(f"target must be one of {allowed}")
    return df.select(*columns, target)


def jdbc_scan(
    spark: SparkSession, url: str, query: str, column: str, lower: int, upper: int, partitions: int, **options: str
) -> DataFrame:
    """An external table read by many tasks at once, each fetching one range of ``column``."""
    return (
        spark.read.format("jdbc")
        .options(url=url, dbtable=f"({query}) AS source_query", partitionColumn=column, lowerBound=lower,
                 upperBound=upper, numPartitions=partitions, **options)
        .load()
    )


def profile_table(df: DataFrame, name: str, cardinality: bool = True) -> DataFrame:
    """Rows, null rate and, if asked, approximate cardinality of every column, from one pass over the table."""
    fields = list(enumerate(df.schema.fields))
    measures = [f"count(`{f.name}`) AS filled_{i}" for i, f in fields]
    rows = [f"'{f.name}', '{f.dataType.simpleString()}', n_rows - filled_{i}" for i, f in fields]
    names = "column_name, data_type, n_null"
    if cardinality:
        measures += [f"approx_count_distinct(`{f.name}`) AS distinct_{i}" for i, f in fields]
        rows = [f"{row}, distinct_{i}" for i, row in enumerate(rows)]
        names += ", approx_distinct"
    counted = df.agg(F.count("*").alias("n_rows"), *map(F.expr, measures))
    return counted.selectExpr(f"'{name}' AS table_name", "n_rows", f"stack({len(fields)}, {', '.join(rows)}) AS ({names})"
                              ).withColumn("null_rate", F.expr("coalesce(round(try_divide(n_null, n_rows), 6), 0D)"))


SKETCH_BITS = 14
SKETCH_ERROR = 3 * 1.04 / 2 ** (SKETCH_BITS / 2)  # three standard errors


def column_sketches(df: DataFrame, name: str) -> DataFrame:
    """(table_name, column_name, sketch): one mergeable sketch of the different values of each column.

    Store them with each set of files; merging them costs nothing that grows with the rows.
    """
    sketches = df.agg(*[F.hll_sketch_agg(F.col(f"`{f.name}`").cast("string"), SKETCH_BITS).alias(f.name) for f in df.schema])
    rows = F.array(*[F.struct(F.lit(f.name).alias("column_name"), F.col(f"`{f.name}`").alias("sketch")) for f in df.schema])
    return sketches.select(F.lit(name).alias("table_name"), F.inline(rows))


def merged_cardinalities(sketches: DataFrame) -> DataFrame:
    """(table_name, column_name, estimate) over all sketches of a column; off by more than ``SKETCH_ERROR`` of the number
    of values in one case of some hundreds."""
    merged = F.hll_sketch_estimate(F.hll_union_agg("sketch"))
    return sketches.groupBy("table_name", "column_name").agg(merged.alias("estimate"))


def exact_cardinalities(df: DataFrame, name: str) -> DataFrame:
    """(table_name, column_name, n_values): counted column by column."""
    counts = df.agg(*[F.count_distinct(F.col(f"`{f.name}`")).alias(f.name) for f in df.schema])
    rows = F.array(*[F.struct(F.lit(f.name).alias("column_name"), F.col(f"`{f.name}`").alias("n_values")) for f in df.schema])
    return counts.select(F.lit(name).alias("table_name"), F.inline(rows))


def catalog_profile(frames: dict[str, DataFrame], cardinality: bool = True) -> DataFrame:
    """The profile of many tables as one long frame."""
    return reduce(DataFrame.unionByName, [profile_table(df, name, cardinality) for name, df in frames.items()])


def catalog_frames(spark: SparkSession) -> dict[str, DataFrame]:
    """Every table and view the session can resolve; a table that fails to resolve is left out."""
    frames = {}
    for entry in spark.catalog.listTables():
        try:
            frames[entry.name] = spark.table(entry.name)
            frames[entry.name].schema
        except Exception:  # noqa: BLE001 - a broken table must not hide the others
            frames.pop(entry.name, None)
    return frames
