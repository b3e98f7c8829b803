"""Distinct counts from mergeable bit matrices (probabilistic counting with stochastic averaging).

A state row holds, for one group, counted field and bucket, the set of hash ranks seen so far as bits. States merge by bitwise
or, so parts from any split of the rows, late rows included, give the state of the whole; repeated rows change nothing. The
estimate is the maximum of the likelihood of the bit counts per rank, its variance the inverse of the Fisher information.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce
from operator import and_

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessellar.sinks import swap_in, table_exists

#: log2 of the buckets; the standard error is about 0.65 / sqrt(2**BUCKET_BITS), 1 % for 12.
BUCKET_BITS = 12
#: Ranks from 0 on whose bits are counted: good for 2**(RANKS + BUCKET_BITS) identifiers and more.
RANKS = 44
#: Label of rows whose group column is null or blank; rolled-up columns are null.
NONE = "(none)"


def sketch(rows: DataFrame, groups: Mapping[str, Column], fields: Mapping[str, Column]) -> DataFrame:
    """(groups..., field, bucket, bits): states of the rows, pre-aggregated before their shuffle.

    Null identifiers count for nothing, repeated rows once; an empty table has no state. Only the columns named are read, so further
    ones may be called anything. Identifiers of any length are hashed whole.
    """
    h = F.xxhash64("__v.id")
    rest = F.shiftrightunsigned(h, BUCKET_BITS).bitwiseOR(F.lit(1 << (64 - BUCKET_BITS - 1)))  # never 0
    ids = F.explode(F.array(*(F.struct(F.lit(f).alias("field"), c.cast("string").alias("id")) for f, c in fields.items())))
    flat = rows.select(*(c.alias(g) for g, c in groups.items()), ids.alias("__v")).where("__v.id IS NOT NULL")
    return flat.groupBy(*groups, F.col("__v.field").alias("field"), F.pmod(h, F.lit(1 << BUCKET_BITS)).cast("int").alias("bucket")).agg(F.bit_or(rest.bitwiseAND(-rest)).alias("bits"))


def merge(states: DataFrame, by: Sequence[str]) -> DataFrame:
    """States of the unions that share the values of ``by``, other group columns left out."""
    return states.groupBy(*by, "field", "bucket").agg(F.bit_or("bits").alias("bits"))


def unions(states: DataFrame, groups: Sequence[str], sets: Sequence[Sequence[str]], own: Mapping[str, Sequence[Sequence[str]]] | None = None) -> DataFrame:
    """States of all unions in ``sets``, each a list of the group columns that are kept; the others are null. ``own`` has other sets for some fields.

    The states are laid out by field and bucket, of which there are some thousands, evenly filled; so every union of a bucket is
    made where it lies, and only the estimates' counts are shuffled again.
    """
    kinds = {g: states.schema[g].dataType for g in groups}
    listed = lambda sets: F.array(*(F.struct(*((F.col(g) if g in s else F.lit(None).cast(kinds[g])).alias(g) for g in groups)) for s in sets))
    each = listed(sets)
    for field, other in (own or {}).items():
        each = F.when(F.col("field") == field, listed(other)).otherwise(each)
    placed = states.repartition("field", "bucket").select("field", "bucket", "bits", F.explode(each).alias("__g"))
    return placed.groupBy(*(F.col(f"__g.{g}").alias(g) for g in groups), "field", "bucket").agg(F.bit_or("bits").alias("bits"))


def accumulate(states: DataFrame, path: str, by: Sequence[str]) -> DataFrame:
    """Merge ``states`` into those stored at ``path`` and return the stored ones; late rows may come at any time, and a repeated batch changes nothing.

    Written beside and then swapped in, so a stream's foreachBatch may call it.
    """
    spark = states.sparkSession
    old = spark.read.parquet(path) if table_exists(spark, path) else None
    kept = states.select(*by, "field", "bucket", "bits")
    merge(kept if old is None else old.unionByName(kept), by).write.mode("overwrite").parquet(f"{path}.new")
    swap_in(spark, f"{path}.new", path)
    return spark.read.parquet(path)


def likelihood_estimate(counts: np.ndarray, buckets: int = 1 << BUCKET_BITS) -> tuple[np.ndarray, np.ndarray]:
    """Estimates and standard errors from (groups x ranks) counts of buckets with a rank's bit set.

    A bit of rank r in one bucket stays unset with probability exp(-n * q_r), q_r = 2**-(r+1) / buckets. The derivative of the
    log likelihood falls with n, so its root in log n is found by Newton steps inside a bracket. The inverse information is the
    variance with a Poisson number of identifiers; that number's own variance, n, is taken off.
    """
    c = counts.astype(float)
    q = 2.0 ** -(np.arange(c.shape[1]) + 1.0) / buckets
    unset = ((buckets - c) * q).sum(axis=1)
    lo, hi = np.full(len(c), -3.0), np.full(len(c), np.log(buckets) + c.shape[1] * np.log(2.0))
    x = np.log(np.maximum(c.sum(axis=1), 1.0))
    for _ in range(60):
        z = np.exp(x)[:, None] * q
        e = np.expm1(np.minimum(z, 700))
        f = (c * q / e).sum(axis=1) - unset
        slope = -(c * q * z / e * (1 + 1 / e)).sum(axis=1)
        lo, hi = np.where(f > 0, x, lo), np.where(f > 0, hi, x)
        with np.errstate(divide="ignore", invalid="ignore"):
            step = x - f / slope
        new = np.where(np.isfinite(step) & (step > lo) & (step < hi), step, (lo + hi) / 2)
        if np.all(np.abs(new - x) < 1e-10):
            break
        x = new
    n = np.where(c.sum(axis=1) > 0, np.exp(x), 0.0)
    info = (buckets * q * q / np.expm1(np.minimum(np.maximum(n, 1e-9)[:, None] * q, 700))).sum(axis=1)
    return n, np.where(n > 0, np.sqrt(np.maximum(1 / info - n, 0)), 0.0)


def estimate(states: DataFrame, by: Sequence[str]) -> DataFrame:
    """(by..., field, n_distinct, std_error, low, high): 95 % bounds by the normal law."""
    sums = [F.sum(F.shiftrightunsigned("bits", r).bitwiseAND(F.lit(1))).alias(f"__r{r}") for r in range(RANKS)]
    counts = states.groupBy(*by, "field").agg(*sums)

    @F.pandas_udf("struct<n_distinct:double,std_error:double>")
    def solve(c: pd.Series) -> pd.DataFrame:
        n, e = likelihood_estimate(np.stack(c.to_numpy())) if len(c) else (np.empty(0), np.empty(0))
        return pd.DataFrame({"n_distinct": n, "std_error": e})

    out = counts.select(*by, "field", solve(F.array(*(f"__r{r}" for r in range(RANKS)))).alias("__e"))
    n, e = F.col("__e.n_distinct"), F.col("__e.std_error")
    return out.select(*by, "field", n.alias("n_distinct"), e.alias("std_error"), F.greatest(F.lit(0.0), n - 1.96 * e).alias("low"), (n + 1.96 * e).alias("high"))


def exact(rows: DataFrame, groups: Mapping[str, Column], fields: Mapping[str, Column], sets: Sequence[Sequence[str]], own: Mapping[str, Sequence[Sequence[str]]] | None = None) -> DataFrame:
    """(groups..., field, n_exact): exact distinct counts of the unions in ``sets``, by which estimates are judged; every identifier is shuffled."""
    ids = F.explode(F.array(*(F.struct(F.lit(f).alias("field"), c.cast("string").alias("id")) for f, c in fields.items())))
    flat = rows.select(*(c.alias(g) for g, c in groups.items()), ids.alias("__v")).where("__v.id IS NOT NULL").select(*groups, "__v.field", "__v.id")
    listed = lambda sets: F.array(*(F.struct(*((F.col(g) if g in s else F.lit(None).cast(flat.schema[g].dataType)).alias(g) for g in groups)) for s in sets))
    each = listed(sets)
    for field, other in (own or {}).items():
        each = F.when(F.col("field") == field, listed(other)).otherwise(each)
    spread = flat.select("field", "id", F.explode(each).alias("__g")).select(*(F.col(f"__g.{g}").alias(g) for g in groups), "field", "id").distinct()
    return spread.groupBy(*groups, "field").agg(F.count(F.lit(1)).alias("n_exact"))


def beside(counted: DataFrame, estimated: DataFrame, by: Sequence[str]) -> DataFrame:
    """``counted`` with the estimates of the same groups and fields; a group without an estimate keeps nulls."""
    same = [F.col(f"c.{g}").eqNullSafe(F.col(f"e.{g}")) for g in by] + [F.col("c.field") == F.col("e.field")]
    return counted.alias("c").join(estimated.alias("e"), reduce(and_, same), "left").select(*(f"c.{g}" for g in by), "c.field", "c.n_exact", "e.n_distinct", "e.std_error", "e.low", "e.high")


def tidy_digest(c: Column) -> Column:
    """A digest in capitals without its algorithm's prefix; blank as null."""
    d = F.upper(F.trim(F.regexp_replace(c, r"^\s*[A-Za-z0-9\-]+:", "")))
    return F.when(d != "", d)


def tidy_label(c: Column) -> Column:
    """Lower case without blanks around and a leading dot; null and blank as NONE."""
    v = F.lower(F.regexp_replace(F.trim(c), r"^\.+", ""))
    return F.when(v != "", v).otherwise(NONE)
