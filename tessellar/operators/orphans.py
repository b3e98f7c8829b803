"""References to records that do not exist: direct orphans by liveness in time, inherited ones by a fixpoint cascade.

A reference is live at instant t if some target row with that key has ``since <= t < until`` (``until`` null: still in use).
Direct orphans are rows whose non-null reference is live nowhere at their own time. A cascade then treats a record as inherited
orphan if all records that its reference means are orphans, of a temporal reference all that are live at its time; so a sound row
beside an orphaned one of the same key keeps its children. Semi-joins down the foreign-key graph are repeated until none is new.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tessellar.common import BROADCAST_BYTES, BROADCAST_ROWS, cut, is_small, join_sized

#: A key's children of one day are judged in parts of about so many rows.
HOT_ROWS = 200_000
#: What is known is written anew after so many rounds, so that plans stay short.
ROUNDS_A_CUT = 8


@dataclass(frozen=True)
class Reference:
    """A foreign key: ``child.ref`` names ``parent.key``; ``since``/``until`` make it temporal, without them it only cascades."""

    child: str
    ref: str
    parent: str
    key: str
    since: str | None = None
    until: str | None = None


@dataclass(frozen=True)
class Source:
    """A table of the graph: its rows, the column or expression that names a row, and its own instant."""

    df: DataFrame
    row_key: Column
    at: str | None


def plain_path(c: Column) -> Column:
    r"""Paths as they are compared: any letter case, ``\`` for ``/``, no leading ``./``."""
    return F.lower(F.regexp_replace(F.regexp_replace(c, r"\\", "/"), r"^(\./)+", ""))


def not_live(children: DataFrame, targets: DataFrame, max_rows: int = BROADCAST_ROWS) -> DataFrame:
    """The rows of ``children`` (with columns __key, __t) that no target (__key, __since, __until) covers at __t.

    Rows with a null key refer to nothing and are left out; rows with a null instant can't be judged and are left out, too. A
    target without ``__since`` is never live. Repeated targets change nothing. Up to ``max_rows`` counted targets are broadcast.
    Beyond, both sides meet in one sort: keyed by (key, day), with the latest ``until`` of the days before carried in as one row,
    a child is live if the largest ``until`` of targets begun so far lies after it. So no pairs are formed, and a hot key is
    spread over its days. A day with more than HOT_ROWS children of one key, of which there are few, is split by hash, and only its
    targets are copied.
    """
    children = children.where(F.col("__key").isNotNull() & F.col("__t").isNotNull())
    targets = targets.where(F.col("__key").isNotNull() & F.col("__since").isNotNull()).select("__key", "__since", "__until")
    if is_small(targets, max_rows):
        live = F.expr("c.__key = p.__key AND p.__since <= c.__t AND (p.__until IS NULL OR c.__t < p.__until)")
        return children.alias("c").join(F.broadcast(targets.distinct().alias("p")), live, "left_anti")
    end = F.expr("coalesce(__until, TIMESTAMP_NTZ '9999-12-31 00:00:00')")
    rest = [c for c in children.columns if c not in ("__key", "__t")]
    kind = children.schema["__t"].dataType
    begun = targets.select("__key", F.col("__since").cast(kind).alias("__t"), end.cast(kind).alias("__end")).distinct()
    none = F.lit(None).cast(kind)
    days = begun.select("__key", F.to_date("__t").alias("__day"), "__end", F.lit(0).alias("__n")).unionByName(children.select("__key", F.to_date("__t").alias("__day"), none.alias("__end"), F.lit(1).alias("__n")))
    days = cut(days.groupBy("__key", "__day").agg(F.max("__end").alias("__end"), F.sum("__n").alias("__n")))
    hot = days.where(F.col("__n") > HOT_ROWS).select("__key", "__day", F.ceil(F.col("__n") / HOT_ROWS).cast("int").alias("__parts"))
    before = Window.partitionBy("__key").orderBy("__day").rowsBetween(Window.unboundedPreceding, -1)
    carried = days.select("__key", "__day", "__n", F.max("__end").over(before).alias("__end")).where("__end IS NOT NULL AND __n > 0")
    carried = carried.select("__key", "__day", F.col("__day").cast(kind).alias("__t"), "__end", F.lit(0).alias("__kind"))
    ends = carried.unionByName(begun.select("__key", F.to_date("__t").alias("__day"), "__t", "__end", F.lit(0).alias("__kind")))
    rows = children.select(
        "__key", F.to_date("__t").alias("__day"), "__t", none.alias("__end"), F.lit(1).alias("__kind"), F.struct(*(F.col(f"`{c}`") for c in rest)).alias("__row")
    )
    if hot.isEmpty():
        ends, rows = (x.withColumn("__part", F.lit(0)) for x in (ends, rows))
    else:
        ends = join_sized(ends, hot, ["__key", "__day"], "left", salt_by=["__t"]).withColumn("__part", F.explode(F.sequence(F.lit(0), F.coalesce("__parts", F.lit(1)) - 1))).drop("__parts")
        rows = join_sized(rows, hot, ["__key", "__day"], "left", salt_by=["__row"]).withColumn("__part", F.coalesce(F.pmod(F.xxhash64("__row"), F.col("__parts")), F.lit(0)).cast("int")).drop("__parts")
    events = ends.withColumn("__row", F.lit(None).cast(f"struct<{','.join(f'`{c}`:{children.schema[c].dataType.simpleString()}' for c in rest)}>")).unionByName(rows)
    so_far = Window.partitionBy("__key", "__day", "__part").orderBy("__t", "__kind").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    judged = events.withColumn("__covered", F.max("__end").over(so_far))
    return judged.where("__kind = 1 AND (__covered IS NULL OR __covered <= __t)").select("__key", "__t", "__row.*")


def find_orphans(sources: Mapping[str, Source], references: Sequence[Reference], compare: Mapping[str, object] | None = None) -> DataFrame:
    """(src_table, row_key, period, kind): kind 'direct' or 'inherited', one row per row key and period; period is yyyy-MM.

    Records are told apart by row key and period; a child is inherited when no sound record of its key is left (of a temporal
    reference: none that is live at the child's instant), which each round decides anew for the keys of the round before.

    ``compare`` maps a column name to the function under which its values are compared (paths, say). A row that is orphaned both
    ways is direct. The cascade ends when a round finds no new row, so cycles in the graph end, too, however deep it is. Repeated rows count once; rows with a null row key are one case for each period;
    empty tables give nothing.
    """
    compare = dict(compare or {})

    def value(name: str) -> Column:
        return compare.get(name, lambda c: c)(F.col(f"`{name}`"))

    direct = None
    for r in references:
        if not r.since:
            continue
        s, p = sources[r.child], sources[r.parent]
        children = s.df.select(value(r.ref).alias("__key"), F.col(f"`{s.at}`").alias("__t"), s.row_key.cast("string").alias("row_key"), *(_carried(r.child, references, value)))
        targets = p.df.select(value(r.key).alias("__key"), F.col(f"`{r.since}`").alias("__since"), (F.col(f"`{r.until}`") if r.until else F.lit(None).cast("timestamp_ntz")).alias("__until"))
        found = not_live(children, targets).select(F.lit(r.child).alias("src_table"), "row_key", F.date_format("__t", "yyyy-MM").alias("period"), _keys(r.child, references))
        direct = found if direct is None else direct.unionByName(found)
    frontier = cut(direct.distinct())
    known = frontier.select("src_table", "row_key", "period").distinct()
    found_all = [known.withColumn("kind", F.lit("direct"))]
    keys = _all_keys(references)
    size = F.sum(F.aggregate("__keys", F.lit(0), lambda a, k: a + F.coalesce(F.octet_length(k), F.lit(0))) + 32)
    while True:
        reached = {r["src_table"]: r["rows"] <= BROADCAST_ROWS and r["bytes"] <= BROADCAST_BYTES for r in frontier.groupBy("src_table").agg(F.count(F.lit(1)).alias("rows"), size.alias("bytes")).collect()}
        edges = [r for r in references if r.parent in reached]
        if not edges:
            break
        nxt = None
        for r in edges:
            s, p = sources[r.child], sources[r.parent]
            parents = frontier.where(F.col("src_table") == r.parent).select(F.col("__keys").getItem(keys.index((r.parent, r.key))).alias("__key")).where("__key IS NOT NULL").distinct()
            few = reached[r.parent]
            of_parents = lambda rows: rows.join(F.broadcast(parents), ["__key"], "left_semi") if few else join_sized(rows, parents, ["__key"], "left_semi", salt_by=["row_key"])
            named = lambda t: F.date_format(F.col(f"`{t.at}`"), "yyyy-MM") if t.at else F.lit(None).cast("string")
            moment = lambda c: F.col(f"`{c}`") if c else F.lit(None).cast("timestamp_ntz")
            rows = s.df.select(value(r.ref).cast("string").alias("__key"), s.row_key.cast("string").alias("row_key"), named(s).alias("period"), moment(s.at).alias("__t"), *(_carried(r.child, references, value)))
            own = p.df.select(value(r.key).cast("string").alias("__key"), p.row_key.cast("string").alias("row_key"), named(p).alias("period"), moment(r.since).alias("__since"), moment(r.until).alias("__until"))
            bad = known.where(F.col("src_table") == r.parent).select("row_key", "period")
            sound = cut(of_parents(own).alias("o").join(bad.alias("b"), F.col("o.row_key").eqNullSafe(F.col("b.row_key")) & F.col("o.period").eqNullSafe(F.col("b.period")), "left_anti"))
            if r.since:
                hit = not_live(of_parents(rows), sound)
            else:
                hit = join_sized(of_parents(rows), sound.select("__key").distinct(), ["__key"], "left_anti", salt_by=["row_key"])
            hit = hit.select(F.lit(r.child).alias("src_table"), "row_key", "period", _keys(r.child, references))
            nxt = hit if nxt is None else nxt.unionByName(hit)
        same = [nxt_c.eqNullSafe(k_c) for nxt_c, k_c in ((F.col(f"n.{c}"), F.col(f"k.{c}")) for c in ("src_table", "row_key", "period"))]
        frontier = cut(nxt.distinct().alias("n").join(known.alias("k"), same[0] & same[1] & same[2], "left_anti"))
        new = frontier.select("src_table", "row_key", "period").distinct()
        found_all.append(new.withColumn("kind", F.lit("inherited")))
        known = known.unionByName(new)
        if len(found_all) % ROUNDS_A_CUT == 0:
            known = cut(known)
    out = found_all[0]
    for more in found_all[1:]:
        out = out.unionByName(more)
    return out


def _all_keys(references: Sequence[Reference]) -> list[tuple[str, str]]:
    return sorted({(r.parent, r.key) for r in references})


def _carried(name: str, references: Sequence[Reference], value) -> list[Column]:
    return [value(k).cast("string").alias(f"__k_{k}") for t, k in _all_keys(references) if t == name]


def _keys(name: str, references: Sequence[Reference]) -> Column:
    """The keys by which others may refer to a row, at the place of each in _all_keys()."""
    return F.array(*(F.col(f"__k_{k}") if t == name else F.lit(None).cast("string") for t, k in _all_keys(references))).alias("__keys")


def per_table_and_period(orphans: DataFrame) -> DataFrame:
    """(src_table, period, n_direct, n_inherited): the report; a table or month without orphans has no row."""
    n = lambda kind: F.count(F.when(F.col("kind") == kind, 1))
    return orphans.groupBy("src_table", "period").agg(n("direct").alias("n_direct"), n("inherited").alias("n_inherited"))
