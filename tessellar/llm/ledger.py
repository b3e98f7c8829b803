"""Samples that stay: a persisted ledger of selected keys that only ever grows.

At each epoch every key of the ledger is kept, and each stratum's quota, its rate times the keys seen so far, is filled up from
keys not yet selected, lowest hash first. A key's hash depends on the key and its stratum alone, so reruns and other layouts give
the same sample, and what was once selected stays selected.
"""

from __future__ import annotations

import math
import re
from collections.abc import Mapping
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tessellar.common import BROADCAST_ROWS, cut, join_sized

#: A boundary bin, the only one whose keys are ranked, holds about so many keys.
BIN_KEYS = 20_000
#: log2 of the most bins.
MOST_BITS = 20
#: Hash bounds of so many strata are handed to a scan; with more strata it reads all, and the join with the bins decides alone.
MOST_BOUNDS = 200
#: What the epochs have added to each bin is summed up anew after so many, so that plans stay short.
EPOCHS_A_CUT = 8
SCHEMA = SCHEMA_OF_KEYS = "stratum int, key string, priority bigint, epoch int"


def first_seen(rows: DataFrame, names: Column, key: Column, epoch: Column, numbers: Mapping[str, int]) -> DataFrame:
    """(stratum, key, priority, epoch): each key of each stratum once, with the first epoch that has it.

    ``names`` is an array of stratum names, null ones among them, and ``numbers`` the number of each; the priority hashes the
    name, so a change of numbers changes no sample. Null keys and epochs are left out, repeated rows count once, an empty table gives
    no key; further columns of ``rows`` are never read.
    """
    number = F.create_map(*(F.lit(x) for n, i in numbers.items() for x in (n, i)))
    flat = rows.select(key.alias("key"), epoch.cast("int").alias("epoch"), F.explode(F.array_compact(names)).alias("name")).where("key IS NOT NULL AND epoch IS NOT NULL")
    flat = flat.select("key", "epoch", F.try_element_at(number, F.col("name")).alias("stratum"), F.shiftrightunsigned(F.xxhash64("name", "key"), 1).alias("priority"))
    return flat.groupBy("stratum", "key").agg(F.min("priority").alias("priority"), F.min("epoch").alias("epoch"))


def bin_counts(keys: DataFrame) -> tuple[DataFrame, int]:
    """(stratum, bin, epoch, n): keys per hash bin and epoch, counted at once for all epochs, and the bits of a bin's number.

    The largest stratum sets the number of bins, so that one holds about BIN_KEYS keys; it changes no result.
    """
    most = keys.groupBy("stratum").agg(F.count(F.lit(1)).alias("n")).agg(F.max("n")).first()[0] or 0
    bits = min(MOST_BITS, max(6, math.ceil(math.log2(most / BIN_KEYS)))) if most > BIN_KEYS else 6
    return cut(keys.groupBy("stratum", F.shiftrightunsigned("priority", 63 - bits).alias("bin"), "epoch").agg(F.count(F.lit(1)).alias("n"))), bits


def wanted_bins(counts: DataFrame, kept: DataFrame, rates: Mapping[int, float], epoch: int, again: bool = False) -> DataFrame:
    """(stratum, bin, wanted, free, all_new, of_bin): the bins from which ``epoch`` fills its quotas, lowest hashes first.

    ``counts`` as from bin_counts(), ``kept`` (stratum, bin, n) what the ledger holds. Quotas are round(rate * keys seen up to the
    epoch) less the kept ones, never negative. Bins are wanted whole but for one of each stratum. ``all_new``: only keys of this
    epoch are free in the bin; never so ``again``, when the ledger may already hold keys of this epoch.
    """
    zero = F.lit(0).cast("bigint")
    both = (
        counts.where(F.col("epoch") <= epoch)
        .select("stratum", "bin", "n", zero.alias("kept"), F.when((F.col("epoch") == epoch) & F.lit(not again), F.col("n")).otherwise(0).alias("new"))
        .unionByName(kept.select("stratum", "bin", zero.alias("n"), F.col("n").alias("kept"), zero.alias("new")))
        .groupBy("stratum", "bin")
        .agg(F.sum("n").alias("n"), F.sum("kept").alias("kept"), F.sum("new").alias("new"))
    )
    rate = F.create_map(*(F.lit(x) for k, v in rates.items() for x in (k, float(v))))
    all_bins = Window.partitionBy("stratum")
    quota = F.greatest(F.lit(0), F.round(F.try_element_at(rate, F.col("stratum")) * F.sum("n").over(all_bins)).cast("bigint") - F.sum("kept").over(all_bins))
    before = F.coalesce(F.sum(F.col("n") - F.col("kept")).over(all_bins.orderBy("bin").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    bins = both.select("stratum", "bin", quota.alias("quota"), before.alias("before"), (F.col("n") - F.col("kept")).alias("free"), "new")
    return bins.where("before < quota AND free > 0").select("stratum", "bin", (F.col("quota") - F.col("before")).alias("wanted"), "free", (F.col("free") == F.col("new")).alias("all_new"), F.col("bin").alias("of_bin"))


def extend(keys: DataFrame, bins: DataFrame, bits: int, ledger: DataFrame, epoch: int) -> DataFrame:
    """The keys that ``epoch`` adds to ``ledger``, as (stratum, key, priority, epoch), from ``bins`` as of wanted_bins().

    In bins where only this epoch's keys are free, no others are read. In the rest, those in which an earlier quota ended, all keys
    up to the epoch are compared with the ledger; the bins' hash bounds are handed to the scans of both. Only keys of a bin that
    is wanted in part are ranked; equal hashes go by key.
    """
    in_bin = F.shiftrightunsigned("priority", 63 - bits)
    sizes = bins.groupBy("stratum", "all_new").agg(F.count(F.lit(1)).alias("n"), F.min("bin").alias("lo"), F.max("bin").alias("hi")).collect()
    few = sum(r["n"] for r in sizes) <= BROADCAST_ROWS
    on = ["stratum", "bin"]
    in_bins = lambda rows, which: rows.withColumn("bin", in_bin).join(F.broadcast(which), on) if few else join_sized(rows.withColumn("bin", in_bin), which, on, "inner", salt_by=["key"])
    fresh = in_bins(keys.where(F.col("epoch") == epoch), bins.where("all_new"))
    ends = [r for r in sizes if not r["all_new"]]
    if ends:
        inside = lambda r: F.col("priority").between(r["lo"] << (63 - bits), (r["hi"] + 1 << (63 - bits)) - 1)
        near = reduce(or_, ((F.col("stratum") == r["stratum"]) & inside(r) for r in ends)) if len(ends) <= MOST_BOUNDS else F.lit(True)
        kept = ledger.where(near).select(F.col("stratum").alias("__s"), F.col("key").alias("__k"), in_bin.alias("__b"))
        seen = keys.where(F.col("epoch") <= epoch).where(near)
        # by the bins' own column, too, or the anti join would be moved below the join with the bins and shuffle every key; none is hot
        fresh = fresh.unionByName(in_bins(seen, bins.where("NOT all_new")).join(kept, F.expr("stratum = __s AND key = __k AND of_bin = __b"), "left_anti"))
    cols = ["stratum", "key", "priority", F.lit(epoch).alias("epoch")]
    whole = fresh.where("wanted >= free").select(*cols)
    ranked = fresh.where("wanted < free").withColumn("__r", F.row_number().over(Window.partitionBy("stratum", "bin").orderBy("priority", "key")))
    return whole.unionByName(ranked.where("__r <= wanted").select(*cols))


def grow(keys: DataFrame, rates: Mapping[int, float], path: str, epochs: list[int]) -> DataFrame:
    """Extend the ledger at ``path`` to what ``epochs`` and the keys of earlier runs' epochs ask for, and return it.

    A part's folder is written whole or not at all and never changed. Of an empty ledger every epoch becomes one part. A later run
    keeps what it finds; where epochs up to the last one found have grown, one further part of that last epoch fills their quotas
    from keys not yet selected, and then the new epochs follow. Without new keys nothing is added. Selected keys that ``keys``
    lacks stay in the parts, but are neither counted nor returned. Only one run at a time may extend a ledger.

    Keys are counted once for all epochs, and what each epoch adds to a bin is known from the counts; so an epoch reads its own
    keys, and of older ones those of the bins in which an earlier quota ended. Sort ``keys`` by epoch and priority when storing
    them (sorted_keys()), so that the scan can skip the others.
    """
    spark = keys.sparkSession
    none = spark.createDataFrame([], SCHEMA)
    read = lambda parts: spark.read.schema(SCHEMA).parquet(*parts) if parts else none
    counts, bits = bin_counts(keys)
    old, last = _parts(spark, path)
    found = cut(read(old).join(keys.select("stratum", "key", F.col("epoch").alias("first")), ["stratum", "key"])) if old else none.withColumn("first", F.col("epoch"))
    in_bin = F.shiftrightunsigned("priority", 63 - bits).alias("bin")
    added: list[str] = []
    # a key's first epoch may lie after the one at hand if rows were taken away; then it isn't counted yet
    ledger = lambda e: found.where(F.col("first") <= e).drop("first").select("stratum", "key", "priority", "epoch").unionByName(read(added))
    found_bins = cut(found.groupBy("stratum", in_bin, "first").agg(F.count(F.lit(1)).alias("n"))) if old else None
    grown = spark.createDataFrame([], "stratum int, bin bigint, n bigint")

    def add(e: int, part: str, again: bool) -> None:
        nonlocal grown
        kept = grown if found_bins is None else grown.unionByName(found_bins.where(F.col("first") <= e).select("stratum", "bin", "n"))
        bins = cut(wanted_bins(counts, kept, rates, e, again))
        if again and bins.isEmpty():
            return
        extend(keys, bins, bits, ledger(e) if old else read(added), e).write.mode("overwrite").parquet(part)
        added.append(part)
        more = bins.select("stratum", "bin", F.least("wanted", "free").alias("n"))
        grown = grown.unionByName(more)
        if len(added) % EPOCHS_A_CUT == 0:
            grown = cut(grown.groupBy("stratum", "bin").agg(F.sum("n").alias("n")))

    if old:
        add(last, f"{path}/part-epoch-{last:06d}-{len(old):04d}", True)
    for e in sorted(epochs):
        if not (old and e <= last):
            add(e, f"{path}/part-epoch-{e:06d}", bool(old))
    return found.select("stratum", "key", "priority", "epoch").unionByName(read(added)) if old else read(added)


def sorted_keys(keys: DataFrame, path: str) -> DataFrame:
    """``keys`` stored at ``path``, in each file by epoch, stratum and priority: bounds on these skip most pages of a scan."""
    keys.sortWithinPartitions("epoch", "stratum", "priority").write.parquet(path)
    return keys.sparkSession.read.schema(SCHEMA_OF_KEYS).parquet(path)


def _parts(spark, path: str) -> tuple[list[str], int]:
    """The complete parts of the ledger at ``path``, and the last epoch that they reach (-1: none)."""
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    p = jvm.org.apache.hadoop.fs.Path(path)
    fs = p.getFileSystem(conf)
    names = sorted(f.getPath().getName() for f in fs.listStatus(p)) if fs.exists(p) else []
    numbers = {n: int(m[1]) for n in names if (m := re.fullmatch(r"part-epoch-(\d+)(?:-\d+)?", n)) and _complete(spark, f"{path}/{n}")}
    return [f"{path}/{n}" for n in numbers], max(numbers.values(), default=-1)


def _complete(spark, path: str) -> bool:
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    p = jvm.org.apache.hadoop.fs.Path(f"{path}/_SUCCESS")
    return p.getFileSystem(conf).exists(p)


def shares(keys: DataFrame, rates: Mapping[int, float], ledger: DataFrame) -> DataFrame:
    """(stratum, n_keys, n_selected, rate, reached)."""
    rate = F.create_map(*(F.lit(x) for k, v in rates.items() for x in (k, float(v))))
    n = keys.groupBy("stratum").agg(F.count(F.lit(1)).alias("n_keys"))
    s = ledger.groupBy("stratum").agg(F.count(F.lit(1)).alias("n_selected"))
    return n.join(s, "stratum", "left").select("stratum", "n_keys", F.coalesce("n_selected", F.lit(0)).alias("n_selected"), F.try_element_at(rate, F.col("stratum")).alias("rate"), (F.coalesce("n_selected", F.lit(0)) / F.col("n_keys")).alias("reached"))
