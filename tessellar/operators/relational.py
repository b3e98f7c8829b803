"""Joins, set operations, orders and dictionaries of the crawl tables."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tessellar.common import cut, join_sized


def star(facts: DataFrame, dims: Mapping[str, tuple[DataFrame, str, str]], how: str = "left") -> DataFrame:
    """``facts`` with a name column per dimension. dims: foreign key -> (dimension, id column, name column).

    Each dimension is reduced to one row per id first, so no fact row is multiplied; its size decides how it is joined.
    """
    out = facts
    for fk, (dim, key, name) in dims.items():
        small = dim.where(F.col(key).isNotNull()).groupBy(F.col(key).alias(fk)).agg(F.min(name).alias(f"{fk}_name"))
        out = join_sized(out, small, [fk], how)
    return out


def missing_from(left: DataFrame, right: DataFrame, on: Sequence[str]) -> DataFrame:
    """Rows of ``left`` without a partner; all are checked, the last batch too. Null keys have no partner."""
    return left.join(right.select(*on).distinct(), list(on), "left_anti")


def to_retry(left: DataFrame, right: DataFrame, on: Sequence[str], again: Column) -> DataFrame:
    """Rows of ``left`` without a partner, or with one for which ``again`` holds."""
    joined = left.join(right.withColumn("__hit", F.lit(True)), list(on), "left")
    return joined.where(F.col("__hit").isNull() | again).select(*left.columns)


def semi(left: DataFrame, keys: DataFrame, on: Sequence[str], accept_all_if_empty: bool = True) -> DataFrame:
    """Rows of ``left`` whose key is listed; an empty list accepts every row."""
    if accept_all_if_empty and keys.isEmpty():
        return left
    return left.join(keys.select(*on).distinct(), list(on), "left_semi")


def list_diff(a: DataFrame, b: DataFrame, extra: DataFrame, key: str = "key") -> DataFrame:
    """(reason, key): keys only in ``a``, only in ``b``, and of ``extra`` in neither; distinct, null keys left out."""
    a, b, extra = (x.select(key).where(F.col(key).isNotNull()).distinct() for x in (a, b, extra))
    both = a.unionByName(b)
    parts = (("only_left", a, b), ("only_right", b, a), ("extra", extra, both))
    out = None
    for reason, x, y in parts:
        one = x.join(y, key, "left_anti").select(F.lit(reason).alias("reason"), key)
        out = one if out is None else out.unionByName(one)
    return out


def first_seen(rows: DataFrame, digest: Column, order: Sequence[str]) -> DataFrame:
    """``rows`` with the outcome of copying each digest once: 'copied' for the first by ``order``, else 'skipped'; null digests are 'skipped'.

    The first of each digest is found by an aggregation, so copies in any number never meet in one task's window.
    """
    keyed = rows.withColumn("__d", digest).withColumn("__o", F.struct(*order))
    first = keyed.where("__d IS NOT NULL").groupBy("__d").agg(F.min("__o").alias("__first"))
    joined = join_sized(keyed, first, ["__d"], "left", salt_by=order)
    return joined.withColumn("outcome", F.when(F.col("__o") == F.col("__first"), "copied").otherwise("skipped")).drop("__d", "__o", "__first")


def upsert(current: DataFrame | None, changes: DataFrame, key: Sequence[str], latest: Sequence[Column]) -> DataFrame:
    """One row per key, the one that sorts last by ``latest`` among stored and new rows; columns as in ``changes``."""
    rows = changes if current is None else current.unionByName(changes)
    w = Window.partitionBy(*key).orderBy(*(c.desc_nulls_last() for c in latest))
    return rows.withColumn("__r", F.row_number().over(w)).where("__r = 1").drop("__r")


def update_from(rows: DataFrame, patch: DataFrame, key: str, columns: Sequence[str]) -> DataFrame:
    """``rows`` with ``columns`` replaced by those of ``patch`` where that has a row with the key and a value."""
    p = patch.select(key, *(F.col(c).alias(f"__{c}") for c in columns)).dropDuplicates([key])
    return rows.join(p, key, "left").withColumns({c: F.coalesce(F.col(f"__{c}"), F.col(c)) for c in columns}).select(*rows.columns)


def dictionary(values: DataFrame, column: str, most: int) -> DataFrame:
    """(id, name): dense ids from 0 in order of the names; null is '', names are cut to ``most`` characters.

    Ids come from counts per leading range of the sorted names, not from one window over all of them.
    """
    names = values.select(F.substring(F.coalesce(F.col(column), F.lit("")), 1, most).alias("name")).distinct()
    placed = cut(names.repartitionByRange("name").sortWithinPartitions("name").withColumn("__p", F.spark_partition_id()))
    sizes = placed.groupBy("__p").agg(F.count(F.lit(1)).alias("__n"))
    before = F.coalesce(F.sum("__n").over(Window.orderBy("__p").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))  # one row per partition
    starts = sizes.select("__p", before.alias("__b"))
    inside = F.row_number().over(Window.partitionBy("__p").orderBy("name"))
    return placed.join(F.broadcast(starts), "__p").select((F.col("__b") + inside - 1).cast("int").alias("id"), "name")


def encode(rows: DataFrame, column: str, words: DataFrame, most: int) -> DataFrame:
    """``rows`` with ``<column>_id`` in place of ``column``."""
    keyed = rows.withColumn("__word", F.substring(F.coalesce(F.col(column), F.lit("")), 1, most))
    codes = words.select(F.col("name").alias("__word"), F.col("id").alias(f"{column}_id"))
    return join_sized(keyed, codes, ["__word"], "left").drop("__word", column)


def hosts(urls: DataFrame, host: Column, tld: Column, most: int = 256) -> DataFrame:
    """(host, tld): each host once, cut to ``most`` characters both where it is stored and where it is looked up."""
    h = F.substring(host, 1, most)
    return urls.select(h.alias("host"), tld.alias("tld")).where("host <> ''").groupBy("host").agg(F.min("tld").alias("tld"))


def fetch_order(rows: DataFrame, file: str, offset: str, partitions: int | None = None) -> DataFrame:
    """Rows laid out for range reads: each partition holds a range of (file, offset), in order, and long files are split."""
    by = [F.col(file).asc_nulls_last(), F.col(offset).asc_nulls_last()]
    spread = rows.repartitionByRange(partitions, *by) if partitions else rows.repartitionByRange(*by)
    return spread.sortWithinPartitions(*by)


def by_count(counts: DataFrame, n: str, key: str) -> DataFrame:
    """Largest counts first, equal ones by key."""
    return counts.orderBy(F.desc(n), F.asc_nulls_last(key))


def page(rows: DataFrame, order: Sequence[str], limit: int, offset: int = 0) -> DataFrame:
    """One page of the rows in order, nulls last."""
    return rows.orderBy(*(F.col(c).asc_nulls_last() for c in order)).offset(offset).limit(limit)


def shuffled_pick(rows: DataFrame, n: int, key: str, seed: int = 0) -> DataFrame:
    """``n`` rows at random, the same for the same seed."""
    return rows.orderBy(F.xxhash64(F.lit(seed), F.col(key)), F.col(key)).limit(n)


def page_of_each(rows: DataFrame, key: str, pages: str, seed: int = 0) -> DataFrame:
    """``rows`` with one page of each, from 1 to ``pages``, at random but the same for the same seed and key; null without pages."""
    return rows.withColumn("page", F.when(F.col(pages) > 0, (F.pmod(F.xxhash64(F.lit(seed + 1), F.col(key)), F.col(pages)) + 1).cast("int")))


def interleaved(hosts_df: DataFrame, id_col: str, name: str, strides: int = 7) -> DataFrame:
    """Hosts in an order that spreads neighbours: by id modulo ``strides``, then name."""
    return hosts_df.orderBy(F.pmod(F.col(id_col), F.lit(strides)), F.col(name).asc_nulls_last(), F.col(id_col))


def grouped(rows: DataFrame, key: str, items: Sequence[str], block: int = 10_000) -> DataFrame:
    """(key, block, n, items): the rows of each key as sorted lists of bounded length, so that no list holds a hot key whole.

    Rows fall to blocks by hash; a key has as many blocks as its count needs.
    """
    n = rows.groupBy(key).agg(F.count(F.lit(1)).alias("__n"))
    sized = join_sized(rows.where(F.col(key).isNotNull()), n, [key], "inner")
    at = F.pmod(F.xxhash64(*items), F.ceil(F.col("__n") / F.lit(block))).cast("int")
    return sized.groupBy(key, at.alias("block")).agg(F.count(F.lit(1)).alias("n"), F.array_sort(F.collect_list(F.struct(*items))).alias("items"))


def pair_counts(rows: DataFrame, a: str, b: str, n: str | None = None) -> DataFrame:
    """(kind, key, n): counts of a, of b and of the pair ``b->a``, in one pass; null is 'NULL' alone and 'null' in a pair.

    ``n``: a column with how many rows each row stands for, as after an aggregation by ids.
    """
    alone = lambda c: F.coalesce(F.col(c).cast("string"), F.lit("NULL"))
    inside = lambda c: F.coalesce(F.col(c).cast("string"), F.lit("null"))
    kinds = {a: alone(a), b: alone(b), "pair": F.concat(inside(b), F.lit("->"), inside(a))}
    each = F.explode(F.array(*(F.struct(F.lit(k).alias("kind"), v.alias("key")) for k, v in kinds.items())))
    weight = F.col(n) if n else F.lit(1)
    return rows.select(each.alias("e"), weight.cast("bigint").alias("n")).groupBy("e.kind", "e.key").agg(F.sum("n").alias("n"))


def ip_number(ip: Column) -> Column:
    """An IPv4 address as a number, null for anything else."""
    parts = F.split(F.trim(ip), r"\.")
    n = [F.get(parts, F.lit(k)).try_cast("bigint") for k in range(4)]
    valid = F.trim(ip).rlike(r"^\d{1,3}(\.\d{1,3}){3}$") & (F.greatest(*n) <= 255)
    return F.when(valid, n[0] * 16777216 + n[1] * 65536 + n[2] * 256 + n[3])


def locate(rows: DataFrame, ip: str, blocks: DataFrame, columns: Sequence[str]) -> DataFrame:
    """``rows`` with ``columns`` of the address block (first_ip to last_ip, disjoint) that holds their address; null where none does.

    A range join by buckets: blocks are listed under every 2**16 addresses that they touch, so the join is by equal keys and a
    bucket holds few blocks.
    """
    wide = blocks.select(ip_number(F.col("first_ip")).alias("__lo"), ip_number(F.col("last_ip")).alias("__hi"), *columns).where("__lo <= __hi")
    listed = wide.withColumn("__b", F.explode(F.sequence(F.shiftright("__lo", 16), F.shiftright("__hi", 16))))
    keyed = rows.withColumn("__ip", ip_number(F.col(ip)))
    distinct = keyed.select("__ip", F.shiftright("__ip", 16).alias("__b")).where("__ip IS NOT NULL").distinct()
    hit = join_sized(distinct, listed, ["__b"], "inner").where("__ip BETWEEN __lo AND __hi").groupBy("__ip").agg(*(F.min(c).alias(c) for c in columns))
    return join_sized(keyed, hit, ["__ip"], "left").drop("__ip")


def digest_counts(rows: DataFrame, digest: Column) -> DataFrame:
    """(digest, n), largest counts first."""
    return by_count(rows.select(digest.alias("digest")).where("digest IS NOT NULL").groupBy("digest").agg(F.count(F.lit(1)).alias("n")), "n", "digest")


def observed(rows: DataFrame, name: str) -> tuple[DataFrame, object]:
    """``rows`` with a counter that is read after they ran: progress without a second pass."""
    from pyspark.sql import Observation

    seen = Observation(name)
    return rows.observe(seen, F.count(F.lit(1)).alias("rows")), seen
