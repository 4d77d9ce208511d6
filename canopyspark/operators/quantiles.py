"""Exact quantiles of many groups at once by radix selection, without a buffer of a group's values.

Doubles are rounded to fewer and fewer lost digits: first to 14 significant bits, then, by default, not at all. At each level the values
that can still be the answer are counted by their rounded form, in a partial aggregate (some thousands of forms a power of two at the first
level, and then what one of those holds), and the form that holds the wanted rank is chosen. Rounding keeps order, so the values of other
forms don't matter any more but for how many of them are smaller.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Significant bits that are kept at each level; a double has 53.
LEVELS = (14, 53)
#: Beyond this, rounding could overflow; such values are forms of their own.
_LARGEST = 1e290


def to_bits(value: Column, bits: int) -> Column:
    """A double rounded to so many significant bits, by adding and taking away a multiple of it; never out of order."""
    if bits >= 53:
        return value
    shifted = value * (2.0 ** (53 - bits) + 1)
    return F.when(F.abs(value) < _LARGEST, shifted - (shifted - value)).otherwise(value)


def quantiles(rows: DataFrame, values: Mapping[str, tuple[Column, Sequence[float]]], key: str = "image_key", levels: Sequence[int] = LEVELS) -> DataFrame:
    """key and, of each name, an array: the quantiles (0 to 1, interpolated between neighbours) of its column over each group.

    Nulls don't count; a column without values in a group gives null there, and a group without any value at all has no row; nan counts
    as the largest value, and -0.0 as 0.0. Ranks are counted at every level, so each level reads rows once more: rows that are costly to
    make should be a table, or follow a shuffle, which Spark reuses.
    """
    names = list(values)
    wide = rows.select(key, *((values[n][0].cast("double") + F.lit(0.0)).alias(n) for n in names))
    known: DataFrame | None = None
    for level, bits in enumerate(levels):
        if known is None:
            cells = [F.when(F.col(n).isNotNull(), F.struct(F.lit(k).alias("stat"), F.lit(-1).alias("slot"), to_bits(F.col(n), bits).alias("form"))) for k, n in enumerate(names)]
            source = wide
        else:
            before, cells = levels[:level], []
            for k, n in enumerate(names):
                for slot in range(2 * len(values[n][1])):
                    own = f"__{k}_{slot}"
                    alike = F.lit(True)
                    for step, b in enumerate(before):
                        alike = alike & to_bits(F.col(n), b).eqNullSafe(F.col(f"{own}.forms")[step])
                    cells.append(F.when(F.col(n).isNotNull() & F.col(own).isNotNull() & alike, F.struct(F.lit(k).alias("stat"), F.lit(slot).alias("slot"), to_bits(F.col(n), bits).alias("form"))))
            slots = [F.max(F.when((F.col("stat") == k) & (F.col("slot") == s), F.struct("forms"))).alias(f"__{k}_{s}") for k, n in enumerate(names) for s in range(2 * len(values[n][1]))]
            source = wide.join(known.groupBy(key).agg(*slots), key)
        long = source.select(key, F.explode(F.array_compact(F.array(*cells))).alias("c")).select(key, "c.*")
        counted = long.groupBy(key, "stat", "slot", "form").agg(F.count("*").alias("n"))
        group = Window.partitionBy(key, "stat", "slot")
        counted = counted.withColumns({"upto": F.sum("n").over(group.orderBy("form")), "total": F.sum("n").over(group)})
        if known is None:
            ranks = F.array(*(F.array(*(F.struct(F.lit(2 * j + up).alias("slot"), _rank(q, up).alias("rank")) for j, q in enumerate(values[n][1]) for up in (0, 1))) for n in names))
            asked = counted.withColumn("r", F.explode(F.element_at(ranks, F.col("stat") + 1))).where((F.col("r.rank") >= F.col("upto") - F.col("n")) & (F.col("r.rank") < F.col("upto")))
            known = asked.select(key, "stat", "r.slot", (F.col("r.rank") - F.col("upto") + F.col("n")).alias("rank"), "total", F.array("form").alias("forms"))
        else:
            left = known.select(key, "stat", "slot", "rank", F.col("total").alias("all"), "forms")
            found = counted.join(left, [key, "stat", "slot"]).where((F.col("rank") >= F.col("upto") - F.col("n")) & (F.col("rank") < F.col("upto")))
            known = found.select(key, "stat", "slot", (F.col("rank") - F.col("upto") + F.col("n")).alias("rank"), F.col("all").alias("total"), F.array_append("forms", F.col("form")).alias("forms"))
    out = []
    for k, n in enumerate(names):
        mine = lambda slot, k=k: F.max(F.when((F.col("stat") == k) & (F.col("slot") == slot), F.element_at("forms", -1)))
        total = F.max(F.when(F.col("stat") == k, F.col("total")))
        parts = []
        for j, q in enumerate(values[n][1]):
            at, low, high = q * (total - 1), mine(2 * j), mine(2 * j + 1)
            parts.append(F.when(low == high, low).otherwise((F.ceil(at) - at) * low + (at - F.floor(at)) * high))
        out.append(F.when(total.isNotNull(), F.array(*parts)).alias(n))
    return known.groupBy(key).agg(*out)


def ranked_quantiles(rows: DataFrame, values: Mapping[str, tuple[Column, Sequence[float]]], also: Sequence[Column] = (), key: str = "image_key") -> DataFrame:
    """What quantiles gives, with further aggregates of each group, by ranks within it: rows are read once, and not shuffled where they lie
    by key already. A group is sorted in one task, with spilling. With aggregates, a group without any value has its row too."""
    names = list(values)
    group, at = Window.partitionBy(key), lambda q, n: F.lit(float(q)) * (F.col(f"__n_{n}") - 1)
    known = rows.withColumns({f"__v_{n}": values[n][0].cast("double") + F.lit(0.0) for n in names})
    known = known.withColumns({f"__n_{n}": F.count(f"__v_{n}").over(group) for n in names})
    for n in names:
        known = known.withColumn(f"__r_{n}", F.row_number().over(group.orderBy(F.col(f"__v_{n}").asc_nulls_last())) - 1)
    out, held = [], F.lit(False)
    for n in names:
        found, value, rank = [], F.col(f"__v_{n}"), F.col(f"__r_{n}")
        total = F.max(f"__n_{n}")
        held = held | (F.col(f"__n_{n}") > 0)
        for q in values[n][1]:
            low, high = (F.max(F.when(rank == f(at(q, n)), value)) for f in (F.floor, F.ceil))
            place = F.lit(float(q)) * (total - 1)
            found.append(F.when(low == high, low).otherwise((F.ceil(place) - place) * low + (place - F.floor(place)) * high))
        out.append(F.when(total > 0, F.array(*found)).alias(n))
    return (known if also else known.where(held)).groupBy(key).agg(*out, *also)


def _rank(q: float, up: int) -> Column:
    at = F.lit(float(q)) * (F.col("total") - 1)
    return (F.ceil(at) if up else F.floor(at)).cast("long")
