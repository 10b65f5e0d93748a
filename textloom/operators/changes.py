"""What has changed between two states of a table, and the same changes carried to documents that hold copies of its rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from textloom.tables import stage


def _print(columns: list[str]) -> Column:
    """128 bits of the columns; the names keep nulls in different columns apart."""
    parts = [x for c in columns for x in (F.lit(c), F.col(c).isNull(), F.col(c))]
    return F.struct(F.xxhash64(*parts).alias("a"), F.xxhash64(F.lit("second"), *parts).alias("b"))


def changed(old: DataFrame, new: DataFrame, keys: list[str], columns: list[str]) -> DataFrame:
    """(keys, change): inserted, updated or deleted; keys whose columns are the same aren't there.

    Only keys and fingerprints of the rows meet. Keys may be null. Rows of one
    key are compared as a set with their numbers, so their order is no change.
    """

    def summed(df: DataFrame, name: str) -> DataFrame:
        one = df.groupBy(*keys, _print(columns).alias("p")).agg(F.count("*").alias("n"))
        # A sum of mixed fingerprints doesn't depend on the order; decimals don't overflow.
        mixed = [F.sum(F.xxhash64(f"p.{x}", "n").cast("decimal(38,0)")).alias(f"{name}_{x}") for x in "ab"]
        return one.groupBy(*keys).agg(*mixed).withColumnsRenamed({k: f"{name}_key_{k}" for k in keys})

    a, b = summed(old, "old"), summed(new, "new")
    met = a.join(b, [F.col(f"old_key_{k}").eqNullSafe(F.col(f"new_key_{k}")) for k in keys], "full_outer")
    change = F.when(F.col("old_a").isNull(), "inserted").when(F.col("new_a").isNull(), "deleted").when((F.col("old_a") != F.col("new_a")) | (F.col("old_b") != F.col("new_b")), "updated")
    # Where the new side is missing as a whole, the old one names the key.
    named = [F.when(F.col("new_a").isNotNull(), F.col(f"new_key_{k}")).otherwise(F.col(f"old_key_{k}")).alias(k) for k in keys]
    return met.select(*named, change.alias("change")).where("change IS NOT NULL")


def patched_lists(lists: DataFrame, key: str, array: str, field: str, updates: DataFrame, fields: list[str]) -> DataFrame:
    """``lists`` with those structs of ``array`` whose ``field`` an update (field, fields) names patched by what it has; ``n_patched`` says how many.

    Only (list, element) pairs meet the updates, and a list gets back a map of
    its own ones: the lists aren't shuffled by their elements.
    """
    new = F.struct(*[F.col(f"_new_{f}").alias(f) for f in fields])
    ups = updates.select(F.col(field).alias("_field"), *[F.col(f).alias(f"_new_{f}") for f in fields]).where("_field IS NOT NULL").dropDuplicates(["_field"])
    named = lists.select(F.col(key).alias("_list"), F.explode(F.array_distinct(F.transform(array, lambda x: x[field]))).alias("_field"))
    of = named.join(ups, "_field").groupBy("_list").agg(F.map_from_entries(F.collect_list(F.struct(F.col("_field").alias("key"), new.alias("value")))).alias("_ups"))
    inner = lists.schema[array].dataType.elementType.fieldNames()

    def one(x: Column) -> Column:
        up = F.try_element_at("_ups", x[field])
        return F.when(up.isNull(), x).otherwise(F.struct(*[(F.coalesce(up[f], x[f]) if f in fields else x[f]).alias(f) for f in inner]))

    met = lists.join(of, F.col(key).eqNullSafe(F.col("_list")), "left").drop("_list")
    n = F.size(F.filter(array, lambda x: F.try_element_at("_ups", x[field]).isNotNull()))
    return met.withColumns({array: F.when(F.col("_ups").isNull(), F.col(array)).otherwise(F.transform(array, one)), "n_patched": F.when(F.col("_ups").isNull(), 0).otherwise(n)}).drop("_ups")


def patched_rows(rows: DataFrame, key: str, updates: DataFrame, fields: list[str]) -> DataFrame:
    """``rows`` with the fields of the update of its key, where it has any."""
    ups = updates.select(F.col(key).alias("_key"), *[F.col(f).alias(f"_new_{f}") for f in fields]).dropDuplicates(["_key"])
    met = rows.join(ups, F.col(key) == F.col("_key"), "left")
    return met.withColumns({f: F.coalesce(f"_new_{f}", f) for f in fields} | {"n_patched": F.col("_key").isNotNull().cast("int")}).drop("_key", *[f"_new_{f}" for f in fields])


def merge_into_partitions(spark: SparkSession, path: str, new: DataFrame, gone: DataFrame, keys: list[str], partition: str) -> list:
    """Write ``new`` rows into the Parquet table at ``path``, in place of those with the same keys, and take the keys of ``gone`` out; the partitions that were written.

    ``new`` and ``gone`` have the keys and the partition column. Only
    partitions that they name are read and written again; one that is left
    without rows is deleted. The merged rows are staged first, so that a run
    that fails before its last write leaves the table as it was.
    """
    touched = [r[0] for r in new.select(partition).unionByName(gone.select(partition)).distinct().collect()]  # names of folders
    if not touched:
        return []
    if any(x is None for x in touched):
        raise ValueError(f"{partition} is null in a row")
    old = spark.read.parquet(path)
    kept = old.where(F.col(partition).isin(*touched)).join(new.select(*keys, partition).unionByName(gone.select(*keys, partition)).distinct(), [*keys, partition], "left_anti")
    merged = stage(kept.select(*old.columns).unionByName(new.select(*old.columns)), "merged_partitions")
    left = {r[0] for r in merged.select(partition).distinct().collect()}
    merged.repartition(partition).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(partition).parquet(path)
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    files = where.getFileSystem(spark._jsc.hadoopConfiguration())
    escape = spark._jvm.org.apache.spark.sql.catalyst.catalog.ExternalCatalogUtils
    for value in set(touched) - left:
        files.delete(spark._jvm.org.apache.hadoop.fs.Path(path, escape.getPartitionPathString(partition, str(value))), True)
    return sorted(touched)
