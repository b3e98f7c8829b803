"""Token statistics of texts and the agreement of several extractions of one file.

A token is a run of letters and digits in lower case. Dice is 2 * shared types / (types of A + types of B); overlap is
2 * sum of the smaller counts / (tokens of A + tokens of B). Both are null where neither text has a token. The out-of-vocabulary
share is 1 - common / alphabetic tokens, and -1 without alphabetic tokens.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tessellar.common import join_sized

#: Extracts longer than this many bytes are not compared.
TOO_LONG = 100_000_000


def token_array(text: Column) -> Column:
    return F.filter(F.split(F.lower(F.coalesce(text, F.lit(""))), r"[^\p{L}\p{N}]+"), lambda t: t != "")


def token_stats(texts: DataFrame, key: Sequence[str], text: str, common: Sequence[str] = ()) -> DataFrame:
    """(key..., n_tokens, n_types, n_alphabetic, n_alphabetic_types, n_common, oov); no shuffle, as each text is counted where it lies."""
    t = F.col("__t")
    alpha = F.filter(t, lambda x: x.rlike(r"^\p{L}+$"))
    n_common = F.size(F.filter(alpha, lambda x: x.isin(*common))) if common else F.lit(0)
    rows = texts.select(*key, token_array(F.col(text)).alias("__t")).select(
        *key,
        F.size(t).alias("n_tokens"),
        F.size(F.array_distinct(t)).alias("n_types"),
        F.size(alpha).alias("n_alphabetic"),
        F.size(F.array_distinct(alpha)).alias("n_alphabetic_types"),
        n_common.alias("n_common"),
    )
    return rows.withColumn("oov", F.when(F.col("n_alphabetic") == 0, F.lit(-1.0)).otherwise(1 - F.col("n_common") / F.col("n_alphabetic")))


def token_bag(texts: DataFrame, key: Sequence[str], text: str) -> DataFrame:
    """(key..., token, n): counts of every token."""
    return texts.select(*key, F.explode(token_array(F.col(text))).alias("token")).groupBy(*key, "token").agg(F.count(F.lit(1)).alias("n"))


def common_words(texts: DataFrame, lang: str, text: str, top: int = 1000) -> DataFrame:
    """(lang, token): of each language's texts the ``top`` tokens of letters that most texts hold, equal ones by token.

    Null languages are left out. Counts are made before they are shuffled, and only the top of each task's share is ranked.
    """
    tokens = F.explode(F.array_distinct(F.filter(token_array(F.col(text)), lambda t: t.rlike(r"^\p{L}{2,}$"))))
    n = texts.where(F.col(lang).isNotNull()).select(F.col(lang).alias("lang"), tokens.alias("token")).groupBy("lang", "token").agg(F.count(F.lit(1)).alias("n"))
    return n.withColumn("r", F.row_number().over(Window.partitionBy("lang").orderBy(F.desc("n"), "token"))).where(F.col("r") <= top).select("lang", "token")


def language_stats(texts: DataFrame, key: Sequence[str], text: str, common: DataFrame) -> DataFrame:
    """(key..., lang_detected, n_alphabetic, n_common, oov): the language of whose common words a text holds most, the first by name of equals.

    ``common`` (lang, token) as from common_words(). n_common counts occurrences of that language's words, oov is 1 - n_common /
    alphabetic tokens. A text without common words has a null language and oov 1, or -1 without alphabetic tokens. Every row of a
    distinct ``key`` comes out once. Texts are counted where they lie; only counts per language are shuffled.
    """
    alpha = F.filter(token_array(F.col(text)), lambda x: x.rlike(r"^\p{L}+$"))
    words = texts.select(*key, F.explode_outer(alpha).alias("token"))
    listed = join_sized(words, common.groupBy("token").agg(F.collect_set("lang").alias("langs")), ["token"], "left", salt_by=list(key), keep=True)
    spread = listed.select(*key, F.explode(F.concat(F.array(F.lit("")), F.coalesce("langs", F.array().cast("array<string>")))).alias("lang"), F.col("token").isNotNull().cast("int").alias("n"))
    per_lang = spread.groupBy(*key, "lang").agg(F.sum("n").alias("n"))
    best = F.max(F.when((F.col("lang") != "") & (F.col("n") > 0), F.struct("n", F.transform(F.split("lang", ""), lambda c: -F.ascii(c)).alias("o"), "lang")))
    per_text = per_lang.groupBy(*key).agg(F.max(F.when(F.col("lang") == "", F.col("n"))).alias("n_alphabetic"), best.alias("b"))
    n_common = F.coalesce("b.n", F.lit(0))
    return per_text.select(*key, F.col("b.lang").alias("lang_detected"), "n_alphabetic", n_common.alias("n_common"), F.when(F.col("n_alphabetic") == 0, F.lit(-1.0)).otherwise(1 - n_common / F.col("n_alphabetic")).alias("oov"))


def pairwise(extracts: DataFrame, key: str, tool: str, text: str) -> DataFrame:
    """(key, tool_a, tool_b, dice, overlap) for every two tools of a file, tool_a < tool_b.

    The token counts of a file's extracts meet by (file, token) as one map of tool -> count, which is as wide as there are tools,
    so no text is joined with another; pairs are formed inside that map. Repeated (file, tool) rows count as one text together.
    """
    bag = token_bag(extracts, [key, tool], text)
    totals = bag.groupBy(key, tool).agg(F.count(F.lit(1)).alias("types"), F.sum("n").alias("tokens"))
    every = extracts.select(key, tool).where(F.col(key).isNotNull() & F.col(tool).isNotNull()).distinct()
    sized = every.join(totals, [key, tool], "left").select(key, tool, F.coalesce("types", F.lit(0)).alias("types"), F.coalesce("tokens", F.lit(0)).alias("tokens"))
    by_token = bag.groupBy(key, "token").agg(F.array_sort(F.collect_list(F.struct(F.col(tool).alias("t"), "n"))).alias("ts")).where(F.size("ts") > 1)
    pairs = F.flatten(F.transform("ts", lambda a: F.transform(F.filter("ts", lambda b: b["t"] > a["t"]), lambda b: F.struct(a["t"].alias("tool_a"), b["t"].alias("tool_b"), F.least(a["n"], b["n"]).alias("n")))))
    shared = by_token.select(key, F.explode(pairs).alias("p")).groupBy(key, F.col("p.tool_a").alias("tool_a"), F.col("p.tool_b").alias("tool_b")).agg(F.count(F.lit(1)).alias("types_ab"), F.sum("p.n").alias("tokens_ab"))
    of_file = sized.groupBy(key).agg(F.array_sort(F.collect_list(F.struct(F.col(tool).alias("t"), "types", "tokens"))).alias("ts"))
    combos = F.flatten(F.transform("ts", lambda a: F.transform(F.filter("ts", lambda b: b["t"] > a["t"]), lambda b: F.struct(a["t"].alias("tool_a"), b["t"].alias("tool_b"), (a["types"] + b["types"]).alias("types"), (a["tokens"] + b["tokens"]).alias("tokens")))))
    all_pairs = of_file.select(key, F.explode(combos).alias("p")).select(key, "p.*")
    share = lambda n, d: F.when(F.col(d) > 0, 2 * F.coalesce(F.col(n), F.lit(0)) / F.col(d))
    return all_pairs.join(shared, [key, "tool_a", "tool_b"], "left").select(key, "tool_a", "tool_b", share("types_ab", "types").alias("dice"), share("tokens_ab", "tokens").alias("overlap"))


def extract_status(length: Column, found: Column, most: int = TOO_LONG) -> Column:
    """MISSING, TOO_LONG, EMPTY or OK of an extract: what was found, its length in bytes."""
    return F.when(~found, "MISSING").when(length > most, "TOO_LONG").when(length == 0, "EMPTY").otherwise("OK")
