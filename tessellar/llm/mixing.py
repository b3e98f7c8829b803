"""Mixing sources to target weights: blocks of tokens in a proportionate-fair schedule.

Each source's documents, in hash order and repeated as far as allowed, form a stream that is cut into blocks of equal tokens; a
document at a cut goes on in the next block. With weights a_s, whole numbers in the ratio of the given ones and A in sum, block k
of a source is released at slot floor(k * A / a_s) and due at ceil((k + 1) * A / a_s). Earliest deadline first among the released
blocks then keeps every source within one block of its exact share at every prefix of the mix. The schedule repeats after A slots,
so that many, or as many as the mix has, are scheduled, in one task for each mix; the slot of any block follows by arithmetic.
"""

from __future__ import annotations

import heapq
import json
import math
from collections.abc import Iterator, Mapping
from fractions import Fraction

import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tessellar.common import BROADCAST_ROWS, cut, join_sized

#: Tokens of a block.
BLOCK = 2048
#: Documents that one task orders are about so many.
BUCKET_DOCS = 20_000
#: A mixing plan is configuration: more (mix, source) pairs than this are refused.
MOST_TARGETS = 10_000
_BATCH = 50_000


def exact(weights: Mapping[str, float]) -> dict[str, int]:
    """Whole numbers without common divisor in the ratio of the weights, each taken as the decimal number that it is written as."""
    fractions = {s: Fraction(repr(float(w))) for s, w in weights.items()}
    below = math.lcm(*(f.denominator for f in fractions.values()))
    whole = {s: f.numerator * (below // f.denominator) for s, f in fractions.items()}
    common = math.gcd(*whole.values())
    return {s: n // common for s, n in whole.items()}


def schedule(parts: Mapping[str, int], wanted: Mapping[str, int]) -> Iterator[tuple[str, int, int]]:
    """(source, block, slot) of the first ``wanted`` blocks of each source and of those before them, slot by slot.

    Earliest deadline first among released blocks; ties go by name. ``parts`` as from exact().
    """
    period = sum(parts.values())
    left = sum(n > 0 for n in wanted.values())
    waiting = sorted((0, s, 0) for s in parts)
    ready: list[tuple[int, str, int]] = []
    t = 0
    while left:
        while waiting and waiting[0][0] <= t:
            _, s, k = heapq.heappop(waiting)
            heapq.heappush(ready, (-(-(k + 1) * period // parts[s]), s, k))
        due, s, k = heapq.heappop(ready)
        if due <= t:
            raise AssertionError("a deadline is missed")
        yield s, k, t
        left -= k + 1 == wanted[s]
        heapq.heappush(waiting, ((k + 1) * period // parts[s], s, k + 1))
        t += 1


def offsets(sized: DataFrame, bucket_docs: int = BUCKET_DOCS) -> DataFrame:
    """``sized`` with __at: the tokens of the same source that precede a row in hash order.

    Rows are summed per hash bucket, buckets per source, and only the rows of a bucket are ordered together; so no task ever holds
    a source.
    """
    n = sized.count()
    bits = min(24, max(1, math.ceil(math.log2(max(2, n / bucket_docs)))))
    hashed = sized.withColumn("__h", F.shiftrightunsigned(F.xxhash64("doc_id"), 1)).withColumn("__b", F.shiftrightunsigned("__h", 63 - bits))
    before = Window.partitionBy("source").orderBy("__b").rowsBetween(Window.unboundedPreceding, -1)
    buckets = hashed.groupBy("source", "__b").agg(F.sum("n_tokens").alias("__n"))
    buckets = buckets.select("source", "__b", F.coalesce(F.sum("__n").over(before), F.lit(0)).alias("__first"))
    inside = Window.partitionBy("source", "__b").orderBy("__h", "doc_id", "n_tokens").rowsBetween(Window.unboundedPreceding, -1)
    placed = join_sized(hashed, buckets, ["source", "__b"], "inner", salt_by=["doc_id"])
    return placed.withColumn("__at", F.col("__first") + F.coalesce(F.sum("n_tokens").over(inside), F.lit(0))).drop("__h", "__b", "__first")


def plan(targets: DataFrame, tokens: Mapping[str, int], total: int | None = None) -> list[dict]:
    """One entry per mix and source: share aimed at, tokens to take, and the source's weight as a whole number.

    Without ``total`` a mix is as large as its sources can make it with all shares exact: the smallest of max_repeats * tokens /
    share. With ``total``, a source that runs out ends early, and the reached share shows it. Sources without tokens, weights that
    are null or not positive and repeats under 1 take no part; the others share their weight. All in whole numbers: a source takes
    the whole part of its exact share.
    """
    rows = targets.select("mix_name", "source", "weight", "max_repeats").limit(MOST_TARGETS + 1).collect()
    if len(rows) > MOST_TARGETS:
        raise ValueError(f"more than {MOST_TARGETS} targets")
    mixes: dict[str, dict[str, list]] = {}
    for r in rows:
        one = mixes.setdefault(r["mix_name"], {}).setdefault(r["source"], [0.0, 0])
        one[0] += r["weight"] if r["weight"] and 0 < r["weight"] < math.inf else 0.0
        one[1] = max(one[1], r["max_repeats"] or 0)
    out = []
    for no, (mix, sources) in enumerate(sorted(mixes.items(), key=lambda x: str(x[0]))):
        usable = {s: w for s, (w, most) in sources.items() if w > 0 and most > 0 and tokens.get(s, 0) > 0}
        parts = exact(usable) if usable else {}
        period = sum(parts.values())
        weighed = sum(w for w, _ in sources.values()) or 1.0
        cap = {s: sources[s][1] * tokens[s] for s in usable}
        # the size in units of 1 / a_s, so that the source that bounds the mix is taken whole
        size = Fraction(total) if total is not None else min((Fraction(cap[s] * period, a) for s, a in parts.items()), default=Fraction(0))
        for s, (w, most) in sources.items():
            take = min(cap[s], int(size * parts[s] / period)) if s in usable else 0
            out.append({"mix_name": mix, "source": s, "target_share": w / weighed, "aimed_share": parts[s] / period if s in usable else 0.0, "max_repeats": most, "available": tokens.get(s, 0), "take": take, "mix_no": no, "part": parts.get(s, 0)})
    return out


def slots(spark, planned: list[dict], block: int) -> DataFrame:
    """(mix_no, source, block, slot): the schedule of each mix over one period or as many blocks as it has, made in one task per mix."""
    plans: dict[int, dict[str, dict[str, int]]] = {}
    for p in planned:
        if p["part"]:
            one = plans.setdefault(p["mix_no"], {"parts": {}, "wanted": {}})
            one["parts"][p["source"]], one["wanted"][p["source"]] = p["part"], min(p["part"], -(-p["take"] // block))

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            for mix, conf in zip(b["mix_no"], b["conf"]):
                conf, rows = json.loads(conf), []
                for s, k, t in schedule(conf["parts"], conf["wanted"]):
                    if k < conf["wanted"][s]:
                        rows.append((mix, s, k, t))
                    if len(rows) == _BATCH:
                        yield pd.DataFrame(rows, columns=["mix_no", "source", "block", "slot"])
                        rows = []
                if rows:
                    yield pd.DataFrame(rows, columns=["mix_no", "source", "block", "slot"])

    listed = spark.createDataFrame([(m, json.dumps(c)) for m, c in plans.items()], "mix_no int, conf string")
    return listed.repartition(max(1, min(len(plans), 200)), "mix_no").mapInPandas(run, "mix_no int, source string, block bigint, slot bigint")


_PLAN = "mix_name string, source string, target_share double, aimed_share double, max_repeats int, available bigint, take bigint, mix_no int, n_blocks bigint, period bigint"


def mix(sized: DataFrame, targets: DataFrame, total: int | None = None, block: int = BLOCK) -> tuple[DataFrame, DataFrame]:
    """The mixes and their shares.

    First (mix_name, slot, source, offset, repeat_no, doc_id, first_token, n_tokens): the order of a mix is slot, then offset. A
    document that lies across a cut between blocks has a row for each part, with the first token of it. Second the shares:
    (mix_name, source, target_share, aimed_share, reached_share, n_tokens, n_rows, most_repeats, max_repeats); n_rows counts
    documents and repeats, not parts. ``sized`` has doc_id, source and n_tokens; rows without tokens or source are left out, as
    they add nothing to a share; repeated rows are documents of their own. A source's take ends with the token that reaches it.
    Ties in hash order go by doc_id and size. Without documents a mix is empty and all its shares 0. Further columns are dropped.
    """
    spark = sized.sparkSession
    sized = sized.select("doc_id", "source", "n_tokens").where("n_tokens > 0 AND source IS NOT NULL AND doc_id IS NOT NULL")
    wanted = targets.select("source").where("source IS NOT NULL").distinct()
    of = sized.groupBy("source").agg(F.sum("n_tokens").alias("n")).join(F.broadcast(wanted.limit(MOST_TARGETS)), "source", "left_semi")
    planned = plan(targets, {r["source"]: r["n"] for r in of.collect()}, total)
    whole: dict[int, int] = {}
    for p in planned:
        whole[p["mix_no"]] = whole.get(p["mix_no"], 0) + p["part"]
    rows = []
    for p in planned:
        blocks = min(p["part"], -(-p["take"] // block))  # a period that ends beyond the mix is never gone round
        rows.append((*list(p.values())[:8], blocks, whole[p["mix_no"]] if blocks == p["part"] else 0))
    plan_df = spark.createDataFrame(rows, _PLAN)
    used = plan_df.where("take > 0").select("mix_name", "mix_no", "source", "available", "take", "n_blocks", "period")
    placed = offsets(sized)
    both = placed.join(F.broadcast(used), "source") if len(planned) <= BROADCAST_ROWS else placed.join(used, "source")
    passes = F.expr("CAST(ceil(take / available) AS INT)")
    whole_docs = both.withColumn("repeat_no", F.explode(F.sequence(F.lit(0), passes - 1))).withColumn("__from", F.col("repeat_no").cast("bigint") * F.col("available") + F.col("__at")).where("__from < take")
    whole_docs = whole_docs.withColumn("__to", F.least(F.col("__from") + F.col("n_tokens"), F.col("take")))
    cuts = whole_docs.withColumn("__block", F.explode(F.sequence(F.expr(f"__from DIV {block}"), F.expr(f"(__to - 1) DIV {block}"))))
    offset = F.greatest(F.col("__from"), F.col("__block") * block)
    pieces = cuts.select(
        "mix_name", "mix_no", "source", "repeat_no", "doc_id", "period", "n_blocks", offset.alias("offset"), (offset - F.col("__from")).alias("first_token"),
        (F.least(F.col("__to"), (F.col("__block") + 1) * block) - offset).alias("n_tokens"), "__block", F.pmod(F.col("__block"), F.col("n_blocks")).alias("block"),
    )
    timed = join_sized(pieces, slots(spark, planned, block), ["mix_no", "source", "block"], "inner", salt_by=["doc_id", "offset"], keep=True)
    slot = F.expr("(__block DIV n_blocks) * period + slot")
    mixed = timed.select("mix_name", slot.alias("slot"), "source", "offset", "repeat_no", "doc_id", "first_token", "n_tokens")
    got = whole_docs.groupBy("mix_no", "source").agg(F.sum(F.col("__to") - F.col("__from")).alias("n"), F.count(F.lit(1)).alias("rows"), (F.max("repeat_no") + 1).alias("most"))
    shares = (
        plan_df.join(got, ["mix_no", "source"], "left")
        .withColumn("n", F.coalesce("n", F.lit(0)))
        .select(
            "mix_name",
            "source",
            "target_share",
            "aimed_share",
            F.coalesce(F.expr("n / nullif(sum(n) OVER (PARTITION BY mix_no), 0)"), F.lit(0.0)).alias("reached_share"),
            F.col("n").alias("n_tokens"),
            F.coalesce("rows", F.lit(0)).alias("n_rows"),
            F.coalesce("most", F.lit(0)).alias("most_repeats"),
            "max_repeats",
        )
    )
    return mixed, shares


def mixed(documents: DataFrame, targets: DataFrame, vocabulary: str | None = None, **options) -> tuple[DataFrame, DataFrame]:
    """mix() of documents, sizes in tokens; the counts are written once to the shared folder."""
    from tessellar.llm.tokens import VOCABULARY, token_counts

    return mix(cut(token_counts(documents, vocabulary or VOCABULARY)), targets, **options)
