"""Integers of any length (A2): least, greatest and mean of literals that no decimal holds.

A literal is cut into limbs of 18 digits.  Limbs of one place are summed as decimals, so
that a sum is one row per place however many literals there are; carrying between places
is left to the end.  Least and greatest go by sign, then length, then digits.
"""

from __future__ import annotations

from collections.abc import Sequence

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tessera.functions.predicates import INT_CAPTURE

LIMB = 18               # digits; a limb's sum over 10^20 literals fits a decimal of 38 digits
_DIGITS, _COMPLEMENT = "0123456789", "9876543210"


@F.pandas_udf(T.DoubleType())
def _mean(limbs: pd.Series, places: pd.Series, n: pd.Series) -> pd.Series:
    """Correctly rounded quotient of the carried sum and the count; null beyond a double."""
    def one(values, at, count):
        total = sum(int(v) * 10 ** (LIMB * int(k)) for v, k in zip(values, at))
        try:
            return total / int(count)
        except OverflowError:
            return None
    return pd.Series([one(*x) for x in zip(limbs, places, n)], dtype="float64")


def exact_integers(cells: DataFrame, keys: Sequence[str]) -> DataFrame:
    """``cells(keys..., value)`` whose present values are int literals -> ``keys...,
    wide_min, wide_max`` (decimal digits) and ``wide_avg``; other values are left out."""
    keys = list(keys)
    text = F.replace(F.regexp_extract("value", INT_CAPTURE, 1), F.lit("_"), F.lit(""))
    lits = cells.select(*keys, text.alias("t")).where("t <> ''")
    digits = F.regexp_replace("t", "^[+-]?0*", "")
    lits = lits.select(*keys, F.startswith("t", F.lit("-")).alias("negative"), digits.alias("digits"))
    n = F.length("digits")
    sign = F.when(n == 0, 0).when(F.col("negative"), -1).otherwise(1)
    lits = lits.select(*keys, "digits", n.alias("n"), sign.alias("sign"))
    # Of two negative numbers the longer one, or the one of greater digits, is less.
    order = F.struct("sign", (F.col("sign") * F.col("n")).alias("size"),
                     F.when(F.col("sign") < 0, F.translate("digits", _DIGITS, _COMPLEMENT)).otherwise(F.col("digits")).alias("d"))
    ends = lits.groupBy(*keys).agg(F.min(order).alias("least"), F.max(order).alias("most"), F.count(F.lit(1)).alias("n"))

    def literal(o: str):
        d = F.col(f"{o}.d")
        return (F.when(F.col(f"{o}.sign") == 0, F.lit("0"))
                .when(F.col(f"{o}.sign") < 0, F.concat(F.lit("-"), F.translate(d, _COMPLEMENT, _DIGITS))).otherwise(d))

    limbs = lits.select(*keys, "digits", "n", "sign", F.explode(F.sequence(F.lit(0), F.floor((F.col("n") - 1) / LIMB).cast("int"))).alias("place"))
    limbs = limbs.where("n > 0")
    stop = F.col("n") - F.col("place") * LIMB
    start = F.greatest(stop - LIMB, F.lit(0))
    limb = F.substr("digits", start + 1, stop - start).cast("decimal(18,0)") * F.col("sign")
    sums = limbs.groupBy(*keys, "place").agg(F.sum(limb.cast("decimal(28,0)")).alias("s"))
    sums = sums.groupBy(*keys).agg(F.collect_list(F.struct("place", F.col("s").cast("string").alias("s"))).alias("l"))
    out = ends.join(sums, keys, "left")
    none = F.array().cast("array<string>")
    return out.select(*keys, literal("least").alias("wide_min"), literal("most").alias("wide_max"),
                      _mean(F.coalesce(F.col("l.s"), none), F.coalesce(F.col("l.place"), F.array().cast("array<int>")), "n").alias("wide_avg"))
