"""Distributed ordered prefix (global ranks, running sums) and exact quantiles by radix
selection, both without a single-partition exchange.

``row_number().over(Window.orderBy(x))`` funnels every row through one task. Here
Spark's range partitioning cuts the rows into contiguous key ranges, each is sorted where it
lies, and they are written once with a number whose high bits are the range and whose low
bits the place in it. Totals per range (one row per range and group) give every range its
offset, so a rank needs no further shuffle. Where the range edges fall only changes balance,
never values. One path serves every size.

Quantiles need no order at all: the bits of a double, read as a number, rank as the doubles
do. Counting by leading bits shows which value of them holds a wanted place, and only rows
with those bits are counted by the next ones.

Heavy ties on the sort key should be collapsed first (group by value and carry
a count), which all callers of the prefix in this package do.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from keepwell.scratch import settled, written


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def sort_keys(order, by=()) -> list[Column]:
    """Sort expressions of the requested order, nulls last per key.

    ``order`` is a list of (column, ascending). Descending keys must be numeric
    (they are negated) – every ordered operator here sorts numbers descending and
    breaks ties on text ascending.
    """
    return [*[_col(b).asc() for b in by], *[(_col(c) if asc else -_col(c)).asc_nulls_last() for c, asc in order]]


def ordered_prefix(df: DataFrame, order, sums: dict | None = None, by=(), rank_col: str = "_rank",
                   totals: bool = False, ranges: int | None = None, running: bool = True) -> DataFrame:
    """Add a 1-based ``rank_col`` (row number in ``order`` within each ``by`` group)
    and, for every ``name -> column`` in ``sums``, the inclusive running sum ``name``;
    with ``totals`` also the whole group's values as ``<name>_total``, with ``running``
    off only those.

    Nulls add nothing; a group of nulls only has null sums. Row order must be total (include
    a unique tie-breaker) for ranks to be deterministic; running sums over ties follow the
    same order. The number of key ranges is that of shuffle partitions, less what adaptive
    execution joins, unless ``ranges`` says otherwise.
    """
    sums, by, keys = sums or {}, list(by), sort_keys(order, by)
    kept = df.columns
    # range partitioning looks at its input twice; a plan that is not a plain scan is written first
    keyed = settled(df.select("*", *[c.alias(f"_add_{name}") for name, c in sums.items()]), "ordered_input")
    dealt = keyed.repartitionByRange(ranges, *keys) if ranges else keyed.repartitionByRange(*keys)
    rows = written(dealt.sortWithinPartitions(*keys).withColumn("_seq", F.monotonically_increasing_id()), "ordered_rows") \
        .withColumn("_range", F.shiftright("_seq", 33))
    part = [*by, "_range"]
    per = rows.groupBy(*part).agg(F.count(F.lit(1)).alias("_in"), F.min("_seq").alias("_first"),
                                  *[F.sum(f"_add_{n}").alias(f"_in_{n}") for n in sums])
    before = Window.partitionBy(*by).orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    whole = Window.partitionBy(*by)
    named = {rank_col: "_in", **{n: f"_in_{n}" for n in sums}}
    offset = lambda c: F.coalesce(F.sum(c).over(before), F.sum(c).over(whole) * 0)
    # one row per range and group; its size is known when the join below is planned
    offsets = written(per.select(
        *part, (offset("_in") - F.col("_first") + 1).alias("_shift"),
        *[offset(c).alias(f"_off_{n}") for n, c in named.items() if n in sums and running],
        *[F.sum(c).over(whole).alias(f"{n}_total") for n, c in named.items() if totals]), "ordered_offsets")
    out = rows
    if running and sums:
        local = Window.partitionBy(*part).orderBy("_seq").rowsBetween(Window.unboundedPreceding, Window.currentRow)
        out = rows.select("*", *[F.sum(f"_add_{n}").over(local).alias(f"_run_{n}") for n in sums])
    return out.join(offsets, part).select(
        *kept, (F.col("_seq") + F.col("_shift")).alias(rank_col),
        *[F.coalesce(F.col(f"_off_{n}") + F.col(f"_run_{n}"), F.col(f"_off_{n}")).alias(n) for n in sums if running],
        *[F.col(f"{n}_total") for n in named if totals])


def lerp(a: Column, b: Column, t: Column) -> Column:
    """numpy's linear interpolation (the two-sided form it uses for accuracy)."""
    diff = b - a
    return F.when(t >= 0.5, b - diff * (F.lit(1.0) - t)).otherwise(a + diff * t)


def ordered_bits(value: Column) -> Column:
    """A long that ranks as the double does: the bits of the double, those of a negative one
    but for the sign reversed. Both zeros are one."""
    bits = F.java_method(F.lit("java.lang.Double"), F.lit("doubleToLongBits"), value + F.lit(0.0)).cast("long")
    return F.when(bits >= 0, bits).otherwise(bits.bitwiseXOR(F.lit((1 << 63) - 1)))


#: Leading, middle and last bits of a double by which values are counted.
DIGITS = (22, 21, 21)


def exact_quantiles(df: DataFrame, value: str, probs, by=()) -> DataFrame:
    """Exact linear-interpolation quantiles (numpy/pandas default) per ``by`` group; nulls and
    NaN do not count. Output: (*by, q_index, q, quantile), nothing for a group of no values.

    Three counts by the digits of ``ordered_bits``, combined before the shuffle, so hot values
    cost nothing. The first covers all rows, the others those whose leading digits hold a
    wanted place: two per quantile and group. No values are sorted, only digits. Nothing runs
    here; a costly ``df`` should be a written table, as it is read three times.
    """
    by, probs = list(by), [float(p) for p in probs]
    number = F.col(value).cast("double")
    rows = df.where(F.col(value).isNotNull() & ~F.isnan(number)).select(*by, number.alias("_v"))
    rows = rows.withColumn("_bits", ordered_bits(F.col("_v")))
    high, middle, low = DIGITS
    digits = {"_d1": F.shiftright("_bits", middle + low), "_d2": F.shiftright("_bits", low).bitwiseAND((1 << middle) - 1),
              "_d3": F.col("_bits").bitwiseAND((1 << low) - 1)}

    def counted(rows: DataFrame, known: list[str], digit: str) -> DataFrame:
        """How many values come before each value of ``digit`` among those with equal ``known``."""
        at = Window.partitionBy(*by, *known)
        counts = rows.groupBy(*by, *known, digit).agg(F.count(F.lit(1)).alias("_c"), F.min("_v").alias("_v"))
        upto = F.sum("_c").over(at.orderBy(digit).rowsBetween(Window.unboundedPreceding, 0))
        return counts.withColumns({"_begin": upto - F.col("_c"), "_n": F.sum("_c").over(at)})

    places = []
    for i, p in enumerate(probs):
        h = (F.col("_n") - 1).cast("double") * F.lit(p)
        low_place = F.floor(h).cast("long")
        places += [F.struct(F.lit(i).alias("i"), F.lit(p).alias("q"), h.alias("h"), F.lit(side).alias("side"), at.alias("at"))
                   for side, at in ((0, low_place), (1, F.least(low_place + 1, F.col("_n") - 1)))]
    inside = lambda at: (at >= F.col("_begin")) & (at < F.col("_begin") + F.col("_c"))
    first = counted(rows.withColumn("_d1", digits["_d1"]), [], "_d1")
    wanted = first.select(*by, "_d1", F.explode(F.filter(F.array(*places), lambda t: inside(t["at"]))).alias("_t"), "_begin") \
        .select(*by, "_d1", "_t.i", "_t.q", "_t.h", "_t.side", (F.col("_t.at") - F.col("_begin")).alias("_at"))
    known = ["_d1"]
    for digit in ("_d2", "_d3"):
        rows = rows.withColumns({d: digits[d] for d in known}).join(wanted.select(*by, *known).distinct(), [*by, *known], "left_semi")
        counts = counted(rows.withColumn(digit, digits[digit]), known, digit)
        wanted = counts.join(wanted, [*by, *known]).where(inside(F.col("_at"))).select(
            *by, *known, digit, "i", "q", "h", "side", (F.col("_at") - F.col("_begin")).alias("_at"), "_v")
        if digit == "_d2":
            wanted = wanted.drop("_v")
        known.append(digit)
    side = lambda s: F.max(F.when(F.col("side") == s, F.col("_v")))
    found = wanted.groupBy(*by, F.col("i").alias("q_index"), "q").agg(side(0).alias("_a"), side(1).alias("_b"), F.max("h").alias("_h"))
    return found.select(*by, "q_index", "q", lerp(F.col("_a"), F.col("_b"), F.col("_h") - F.floor("_h").cast("double")).alias("quantile"))
