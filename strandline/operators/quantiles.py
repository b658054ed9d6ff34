"""Exact quantiles of every key at once, by histograms over the bits of the values: no task ever holds the values of a key."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

DIGIT = 16  # bits a histogram tells apart: at most 65,536 counts a key and step
SALTS = 8  # a power of two
MANTISSA = 1 << 52
WIDTHS = {"tinyint": 8, "smallint": 16, "int": 32, "bigint": 64, "float": 64, "double": 64}


def ordered_code(c: Column, kind: str) -> Column:
    """A whole number in the order of the values: itself, or for a double its bits, with the sign taken as a sign; zeros are one, NaN comes last.

    The exponent is the logarithm's, put right where that was rounded over a power of two; dividing by that power is exact.
    """
    if kind not in ("float", "double"):
        return c.cast("long")
    a = F.abs(c.cast("double"))
    power = lambda e: F.pow(F.lit(2.0), e)
    near = F.greatest(F.lit(-1022.0), F.least(F.lit(1023.0), F.floor(F.log2(a)).cast("double")))
    e = near + F.when(a < power(near), -1.0).when(a / 2 >= power(near), 1.0).otherwise(0.0)
    normal = (e + 1023).cast("long") * MANTISSA + ((a / power(e) - 1) * MANTISSA).cast("long")
    code = F.when(a == 0, F.lit(0).cast("long")).when(a < 2.0**-1022, (a / 5e-324).cast("long")).when(a == float("inf"), F.lit(2047 * MANTISSA)).otherwise(normal)
    return F.when(F.isnan(c), F.lit(2047 * MANTISSA + 1)).when(c < 0, -code).otherwise(code)


def decoded(code: Column, kind: str) -> Column:
    """The value of an ordered code, as a double."""
    if kind not in ("float", "double"):
        return code.cast("double")
    size = F.abs(code)
    e, m = F.shiftright(size, 52), size.bitwiseAND(MANTISSA - 1).cast("double")
    a = F.when(e == 0, m * 5e-324).when(e == 2047, F.when(m == 0, float("inf")).otherwise(float("nan"))).otherwise((1 + m / MANTISSA) * F.pow(F.lit(2.0), (e - 1023).cast("double")))
    return F.when(code < 0, -a).otherwise(a)


def exact_quantiles(df: DataFrame, keys: list[str], value: str, fractions: dict[str, float], weight: str | None = None) -> DataFrame:
    """keys, n, and a column for each of ``fractions`` (name: fraction): the quantile with linear interpolation, as ``percentile`` gives it.

    Nulls do not count, and keys without a value have no row; null keys are keys. Values are whole numbers, floats or doubles. Rows are counted by
    key and value first, so hot values are one row each. Then one histogram a step of 16 bits tells in which slot each wanted rank lies, and
    the next one counts within those slots only: two steps for an int, four for a long or double. State is a histogram; what joins
    the counts is a row for each wanted slot, and the counts of a slot are spread by a salt. ``weight`` is a column of how often a row counts (a whole
    number above 0), for values that are counted already.
    """
    if not all(0 <= f <= 1 for f in fractions.values()):
        raise ValueError("a fraction lies from 0 to 1")
    kind = dict(df.dtypes)[value]
    if kind not in WIDTHS:
        raise ValueError(f"quantiles of {kind}")
    key = F.struct(*keys) if keys else F.struct(F.lit(0).alias("all"))
    counts = df.filter(F.col(value).isNotNull()).select(key.alias("_k"), F.coalesce(ordered_code(F.col(value), kind), F.lit(0).cast("long")).alias("_code"), (F.col(weight) if weight else F.lit(1)).alias("_w"))
    counts = counts.groupBy("_k", "_code").agg(F.sum("_w").alias("_c"))  # the code is never null: joins push no test of it below the counts, whose shuffle all steps share
    shifts = list(range(max(WIDTHS[kind] - DIGIT, 0), -1, -DIGIT))

    slots = counts.groupBy("_k", F.shiftright("_code", shifts[0]).alias("_p")).agg(F.sum("_c").alias("_c"))
    slots = slots.withColumn("_n", F.sum("_c").over(Window.partitionBy("_k")))
    places = [F.lit(float(f)) * (F.col("_n") - 1) for f in fractions.values()]
    ranks = F.array_distinct(F.array(*[side(x).cast("long") for x in places for side in (F.floor, F.ceil)]))
    wanted = within(slots.withColumn("_ranks", F.transform(ranks, lambda r: F.struct(r.alias("own"), r.alias("left")))), ["_k"])
    for above, shift in zip(shifts, shifts[1:]):
        dealt = counts.withColumns({"_slot": F.shiftright("_code", above), "_salt": F.xxhash64("_code").bitwiseAND(SALTS - 1).cast("int")})
        asked = wanted.withColumnRenamed("_p", "_slot").withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
        slots = dealt.join(asked, ["_k", "_slot", "_salt"]).groupBy("_k", "_slot", "_n", "_ranks", F.shiftright("_code", shift).alias("_p")).agg(F.sum("_c").alias("_c"))
        wanted = within(slots, ["_k", "_slot"])

    found = wanted.select("_k", "_n", F.explode("_ranks.own").alias("own"), decoded(F.col("_p"), kind).alias("v"))
    found = found.groupBy("_k", "_n").agg(F.map_from_entries(F.collect_list(F.struct("own", "v"))).alias("_at"))  # two ranks a fraction at most
    out = []
    for name, place in zip(fractions, places):
        low, high = F.floor(place).cast("long"), F.ceil(place).cast("long")
        a, b = F.col("_at")[low], F.col("_at")[high]
        out.append(F.when(a.eqNullSafe(b), a).otherwise((high - place) * a + (place - low) * b).alias(name))
    return found.select(*[F.col("_k")[c].alias(c) for c in keys], F.col("_n").alias("n"), *out)


def within(slots: DataFrame, group: list[str]) -> DataFrame:
    """Of the slots of each group those that hold a wanted rank, with the ranks left to find inside."""
    order = Window.partitionBy(*group).orderBy("_p").rowsBetween(Window.unboundedPreceding, 0)
    rows = slots.withColumn("_to", F.sum("_c").over(order)).withColumn("_from", F.col("_to") - F.col("_c"))
    inside = F.filter("_ranks", lambda x: (x["left"] >= F.col("_from")) & (x["left"] < F.col("_to")))
    left = F.transform(inside, lambda x: F.struct(x["own"].alias("own"), (x["left"] - F.col("_from")).alias("left")))
    return rows.select("_k", "_p", "_n", left.alias("_ranks")).filter(F.size("_ranks") > 0)
