"""Per-key results over skewed keys, by eager aggregation through joins.

Both inputs are first aggregated by the join key with map-side combine, so a task hands on at most one compact state per key,
however many rows the key holds; the compact states are joined, counts multiplied and sums scaled by the other side's count,
and the products rolled up. The rows themselves are never shuffled.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def key_states(facts: DataFrame, fields: Sequence[str], measure: str, latest: str) -> DataFrame:
    """(field_name, key_id, n_rows, sum_measure, n_measure, latest): one compact state per field and key, null keys included.

    One pass serves all fields. Repeated rows count as delivered; nulls in ``measure`` or ``latest`` add nothing; an empty table
    gives no state. Other columns of ``facts`` are never read.
    """
    pairs = facts.select(
        F.explode(F.array(*(F.struct(F.lit(f).alias("field_name"), F.col(f"`{f}`").cast("bigint").alias("key_id")) for f in fields))).alias("__k"),
        F.col(f"`{measure}`").cast("bigint").alias("__m"),
        F.col(f"`{latest}`").alias("__t"),
    )
    return pairs.groupBy(F.col("__k.field_name").alias("field_name"), F.col("__k.key_id").alias("key_id")).agg(
        F.count(F.lit(1)).alias("n_rows"), F.sum("__m").alias("sum_measure"), F.count("__m").alias("n_measure"), F.max("__t").alias("latest")
    )


def dimension_states(dims: Mapping[str, tuple[DataFrame, str, Column]]) -> DataFrame:
    """(field_name, key_id, n_dim, label): the dimension side, aggregated by the same key. dims: field -> (table, key column, label)."""
    out = None
    for field, (df, key, label) in dims.items():
        one = df.where(F.col(key).isNotNull()).groupBy(F.col(key).cast("bigint").alias("key_id"))
        one = one.agg(F.count(F.lit(1)).alias("n_dim"), F.min(label).alias("label")).select(F.lit(field).alias("field_name"), "key_id", "n_dim", "label")
        out = one if out is None else out.unionByName(one)
    return out


def all_rows(facts: DataFrame) -> Column:
    """The number of rows of a table, repeated ones included, as a scalar subquery: for parquet the footers have it."""
    return facts.agg(F.count(F.lit(1)).alias("n")).scalar()


def joined_states(states: DataFrame, dimensions: DataFrame, total: Column) -> DataFrame:
    """What joining all rows with the dimension and aggregating by key would give, from compact states only.

    A key without a dimension row stays (``n_dim`` 0), as in a left join: ``joined_rows`` is n_rows * max(n_dim, 1), and
    ``joined_sum`` scales the sum alike. ``share`` is the key's part of ``total``, all rows, null keys included.
    """
    times = F.greatest(F.coalesce("n_dim", F.lit(0)), F.lit(1))
    return (
        states.join(dimensions, ["field_name", "key_id"], "left")
        .withColumn("__total", total)
        .select(
            "field_name",
            "key_id",
            "label",
            F.coalesce("n_dim", F.lit(0)).alias("n_dim"),
            "n_rows",
            "sum_measure",
            "n_measure",
            "latest",
            (F.col("n_rows") * times).alias("joined_rows"),
            (F.col("sum_measure") * times).alias("joined_sum"),
            (F.col("n_rows") / F.col("__total")).alias("share"),
            "__total",
        )
    )


def heavy_keys(joined: DataFrame, percent: int = 2) -> DataFrame:
    """Non-null keys with at least ``percent`` % of all rows; compared in whole numbers, so ties at the bound count."""
    return joined.where(F.col("key_id").isNotNull() & (F.col("n_rows") * 100 >= F.col("__total") * percent))


def roll_up(joined: DataFrame, label: Column) -> DataFrame:
    """Combine key states by a coarser label (say, a normalised mime or a tld); null labels form a group of their own."""
    return joined.groupBy("field_name", label.alias("label")).agg(
        F.count("key_id").alias("n_keys"), F.sum("n_rows").alias("n_rows"), F.sum("sum_measure").alias("sum_measure"), F.max("latest").alias("latest")
    )
