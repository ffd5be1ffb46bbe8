"""Numeric claims in text, and whether evidence backs them.

All of it is column work on whole texts: extraction and the check against a
bounded evidence pool are row-local (no shuffle), and pools of any size go
through an equi-join on rounding buckets.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tradewind.scale import materialize

# Thresholds the narrative may quote without evidence.
METHOD_CONSTANTS = (2.5, 1.5)
_EPS = 1e-9

_WORD = r"[\p{L}\p{N}_]"
DATE_PATTERN = rf"(?<!{_WORD})\d{{4}}-\d{{2}}-\d{{2}}(?!{_WORD})"
NUMBER_PATTERN = r"(?<![\p{L}\p{N}_.])[-+]?\d[\d,]*\.?\d*"

CLAIM_TYPE = "array<struct<token:string,value:double,decimals:int>>"


def number_tokens(text: Column) -> Column:
    """Array of number tokens in order, dates blanked out first."""
    return F.regexp_extract_all(F.regexp_replace(text, DATE_PATTERN, " "), F.lit(NUMBER_PATTERN), F.lit(0))


def _value(token: Column) -> Column:
    return F.regexp_replace(token, ",", "").cast("double")


def _claim(raw: Column) -> Column:
    token = F.regexp_replace(raw, r"[.,]+$", "")
    decimals = F.when(F.contains(token, F.lit(".")),
                      F.length(F.substring_index(token, ".", -1))).otherwise(F.lit(0))
    return F.struct(token.alias("token"), _value(token).alias("value"), decimals.cast("int").alias("decimals"))


def claims_of(text: Column) -> Column:
    """Array of (token, value, decimals) claimed by one text; null text claims nothing."""
    return F.transform(F.coalesce(number_tokens(text), F.array().cast("array<string>")), _claim)


def explode_claims(texts: DataFrame, key: str, text: str) -> DataFrame:
    """One row per claim: key, claim_no, token, value, decimals."""
    return (texts.select(key, F.posexplode(claims_of(F.col(text))).alias("claim_no", "_c"))
            .select(key, "claim_no", "_c.token", "_c.value", "_c.decimals"))


def numbers_in(value_num: Column, value_text: Column) -> Column:
    """Array of numbers one evidence fact holds: the value itself and those inside its text."""
    tokens = F.coalesce(number_tokens(value_text), F.array().cast("array<string>"))
    own = F.filter(F.array(value_num.cast("double")), lambda x: x.isNotNull())
    return F.concat(own, F.transform(tokens, lambda t: _value(F.regexp_replace(t, r"[.,]+$", ""))))


def tolerance(decimals: Column) -> Column:
    """Half a unit of the last printed digit."""
    return F.lit(0.5) * F.pow(F.lit(10.0), -decimals) + F.lit(_EPS)


def is_method_constant(value: Column) -> Column:
    return F.abs(value).isin(*METHOD_CONSTANTS)


def backed_by(value: Column, decimals: Column, pool: Column) -> Column:
    """True if the claim equals a pool number up to rounding; signs are ignored."""
    slack = tolerance(decimals)
    return is_method_constant(value) | F.exists(pool, lambda e: F.abs(F.abs(value) - F.abs(e)) <= slack)


def pool_array(numbers: DataFrame, column: str = "number") -> Column:
    """The evidence pool as a one-row subquery; for evidence whose size is bounded by top-k lists and dimensions."""
    return numbers.agg(F.sort_array(F.collect_set(F.abs(F.col(column).cast("double"))))).scalar()


def score_texts(texts: DataFrame, key: str, text: str, pool: Column) -> DataFrame:
    """Per text: claims checked, claims backed, unbacked tokens and the rate (1.0 without claims).

    Nothing is exploded or shuffled: every text is scored where it is read.
    """
    held = texts.select(key, claims_of(F.col(text)).alias("_c"), pool.alias("_pool"))
    loose = F.filter("_c", lambda c: ~backed_by(c["value"], c["decimals"], F.col("_pool")))
    held = held.withColumn("_loose", F.transform(loose, lambda c: c["token"]))
    n, bad = F.size("_c").cast("long"), F.size("_loose").cast("long")
    return held.select(
        key, n.alias("numbers_checked"), (n - bad).alias("grounded"), F.col("_loose").alias("ungrounded"),
        F.when(n > 0, (n - bad).cast("double") / F.nullif(n.cast("double"), F.lit(0.0)))
        .otherwise(F.lit(1.0)).alias("groundedness_rate"))


# Up to here a claim is a whole number of last-digit units that a double holds exactly.
_EXACT_DECIMALS = 8
_EXACT_UNITS = float(2**53)


def ground_against_pool(claims: DataFrame, numbers: DataFrame, column: str = "number") -> DataFrame:
    """Add ``grounded`` to claims for a pool of any size.

    A claim with d decimals is a whole number of units of 10**-d, and a pool
    number is within tolerance of at most two such whole numbers. Both sides are
    reduced to distinct (d, units) keys before an equi-join, so a number quoted
    by a third of all texts, or a third of the pool lying in one unit, meets as
    one row. Claims finer than eight decimals, or too large for exact units, go
    through neighbouring buckets with the tolerance tested pair by pair.
    """
    size, scale = F.abs("value"), F.pow(F.lit(10.0), F.col("decimals"))
    asked = claims.select(size.alias("_v"), "decimals", (size * scale).alias("_u")).distinct()
    coarse = (F.col("decimals") <= _EXACT_DECIMALS) & (F.col("_u") < _EXACT_UNITS)
    pool = numbers.select(F.abs(F.col(column).cast("double")).alias("_e")).where("_e is not null").distinct()

    levels = asked.where(coarse).agg(F.collect_set("decimals")).scalar()  # at most nine values
    near = pool.withColumn("_d", F.explode(levels))
    unit = F.pow(F.lit(10.0), F.col("_d"))
    whole = F.rint(F.col("_e") * unit)
    near = near.select("_e", "_d", F.explode(F.array(whole - 1, whole, whole + 1)).alias("_k"))
    keys = near.where(F.abs(F.col("_k") / F.pow(F.lit(10.0), F.col("_d")) - F.col("_e")) <= tolerance(F.col("_d")))
    keys = keys.select(F.col("_d").alias("decimals"), "_k").distinct()
    plain = asked.where(coarse).withColumn("_k", F.rint("_u")).join(keys, ["decimals", "_k"], "left_semi")

    narrow = F.lit(float(10**_EXACT_DECIMALS))
    fine = asked.where(~coarse).withColumn("_k", F.rint(F.col("_v") * narrow))
    spot = F.rint(F.col("_e") * narrow)
    around = pool.select("_e", F.explode(F.array_distinct(F.array(spot - 1, spot, spot + 1))).alias("_k"))
    fine = fine.join(around, (fine["_k"] == around["_k"])
                     & (F.abs(fine["_v"] - around["_e"]) <= tolerance(fine["decimals"])), "left_semi")

    backed = plain.select("_v", "decimals").unionByName(fine.select("_v", "decimals")).select(
        F.col("_v").alias("_size"), F.col("decimals").alias("_dec"), F.lit(True).alias("_hit"))
    joined = claims.join(backed, (F.abs(claims["value"]) == backed["_size"]) & (claims["decimals"] == backed["_dec"]),
                         "left")
    return joined.select(*claims.columns,
                         (F.coalesce("_hit", F.lit(False)) | is_method_constant(F.col("value"))).alias("grounded"))


def numbered(texts: DataFrame, key: str, text: str) -> DataFrame:
    """(key, text, _row): the texts stored with a number of their own each, as keys may be null or shared."""
    return materialize(texts.select(key, text, F.monotonically_increasing_id().alias("_row")), "texts")


def score_against_pool(texts: DataFrame, key: str, text: str, numbers: DataFrame, column: str = "number") -> DataFrame:
    """``score_texts`` for many texts and a pool of any size: claims meet the pool by hash keys, not one by one."""
    rows = numbered(texts, key, text)
    found = materialize(explode_claims(rows, "_row", text), "claims")
    judged = ground_against_pool(found, numbers, column)
    loose = F.array_sort(F.collect_list(F.when(~F.col("grounded"), F.struct("claim_no", "token"))))
    per = judged.groupBy("_row").agg(F.count("*").alias("_n"), F.count_if("grounded").alias("_g"), loose.alias("_loose"))
    n, good = F.coalesce("_n", F.lit(0)), F.coalesce("_g", F.lit(0))
    tokens = F.transform("_loose", lambda c: c["token"])
    return rows.select(key, "_row").join(per, "_row", "left").select(
        key, n.alias("numbers_checked"), good.alias("grounded"),
        F.coalesce(tokens, F.array().cast("array<string>")).alias("ungrounded"),
        F.when(n > 0, good.cast("double") / F.nullif(n.cast("double"), F.lit(0.0))).otherwise(F.lit(1.0)).alias("groundedness_rate"))
