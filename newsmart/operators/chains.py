"""Rows that compete for two keys at once, in order.

Rows count one after the other; a row wins if neither of its keys is held by a
row that won before.  Whether a key is still free after a row depends on the row before
it under the same key, on either side:

    free_a(row) = free_a(before in a) and not free_b(before in b)
    free_b(row) = free_b(before in b) and not free_a(before in a)

so each row has two small formulas over those of earlier rows.  All are rewritten
together, round by round: what is known is put in, and a formula that has shrunk to
one other, or its negation, passes on what that one stands for.  The second step
doubles the distance it looks ahead each round, so a chain of n rows takes about
log2(n) rounds.  Every round settles the earliest open row at least.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from newsmart.session import stored


def before(rows: DataFrame, key: str, order: Sequence[str], number: str) -> DataFrame:
    """``number``, and ``_before``: the number of the row before it under its key, or null.

    Rows are sorted over all tasks by range, so a key of any size is spread; what
    joins the ranges is the last row of each, one per task.
    """
    ranged = (
        rows.select(key, number, *[c for c in order if c != key])
        .repartitionByRange(key, *order)
        .sortWithinPartitions(key, *order)
        .select(key, number, F.spark_partition_id().alias("_range"), F.monotonically_increasing_id().alias("_at"))
    )
    ranged = stored(ranged, "ranges")
    here = Window.partitionBy("_range").orderBy("_at")
    last = ranged.groupBy("_range").agg(F.max_by(F.struct(key, number), "_at").alias("_last"))
    # One row per range, so a single task can shift them.
    earlier = last.select("_range", F.lag("_last").over(Window.orderBy("_range")).alias("_earlier"))
    found = ranged.withColumn("_own", F.lag(F.struct(key, number)).over(here)).join(earlier, "_range")
    previous = F.coalesce("_own", "_earlier")
    return found.select(number, F.when(previous[key] == F.col(key), previous[number]).alias("_before"))


def _operand(ref: Column, negated: Column) -> Column:
    """A formula's number and whether it is negated; without a number, true, or false where negated."""
    return F.struct(ref.alias("ref"), negated.alias("neg"))


def _is(operand: Column, value: bool) -> Column:
    return operand["ref"].isNull() & (operand["neg"] != F.lit(value))


def _shrunk(x: Column, y: Column) -> tuple[Column, Column]:
    """The conjunction of two operands as two, the second one true wherever one is enough."""
    yes, no = _operand(F.lit(None).cast("long"), F.lit(False)), _operand(F.lit(None).cast("long"), F.lit(True))
    same = x["ref"] == y["ref"]
    never = _is(x, False) | _is(y, False) | F.coalesce(same & (x["neg"] != y["neg"]), F.lit(False))
    one = _is(y, True) | F.coalesce(same, F.lit(False))
    first = F.when(never, no).when(_is(x, True), y).otherwise(x)
    second = F.when(never | _is(x, True) | one, yes).otherwise(y)
    return first, second


def _put_in(formulas: DataFrame, known: DataFrame, name: str) -> DataFrame:
    """Replace an operand by the formula it names, where that is a single operand."""
    single = known.where(_is(F.col("y"), True)).select(F.col("id").alias("_id"), F.col("x").alias("_x"))
    joined = formulas.join(single, F.col(f"{name}.ref") == F.col("_id"), "left")
    own, other = F.col(name), F.col("_x")
    put = F.when(F.col("_id").isNull(), own).otherwise(_operand(other["ref"], other["neg"] != own["neg"]))
    return joined.withColumn(name, put).drop("_id", "_x")


def _known() -> Column:
    return F.col("x.ref").isNull() & _is(F.col("y"), True)


def resolve(rows: DataFrame, a: str, b: str, order: Sequence[str]) -> DataFrame:
    """The rows that win; ``order`` tells any two rows apart."""
    numbered = stored(rows.withColumn("_n", F.monotonically_increasing_id()), "contenders")
    both = before(numbered, a, order, "_n").withColumnRenamed("_before", "_a").join(
        before(numbered, b, order, "_n").withColumnRenamed("_before", "_b"), "_n"
    )
    both = stored(both, "before")
    in_a, in_b = F.col("_a") * 2, F.col("_b") * 2 + 1  # null, and so true, where nothing is before
    yes = F.lit(False)

    def formula(number: Column, own: Column, other: Column) -> Column:
        # Nothing before under the other key: it is free, so this row wins if its own is and takes it.
        against = _operand(other, F.lit(True))
        return F.struct(number.alias("id"), _operand(own, yes).alias("x"), against.alias("y"))

    pair = F.array(formula(F.col("_n") * 2, in_a, in_b), formula(F.col("_n") * 2 + 1, in_b, in_a))
    formulas = both.select(F.explode(pair).alias("f")).select("f.*")
    first, second = _shrunk(F.col("x"), F.col("y"))
    formulas = stored(formulas.select("id", first.alias("x"), second.alias("y")), "formulas")
    while not formulas.where(~_known()).isEmpty():
        put = _put_in(_put_in(formulas, formulas, "x"), formulas, "y")
        formulas = stored(put.select("id", first.alias("x"), second.alias("y")), "formulas")
    taken = formulas.where(F.col("x.neg")).select("id")
    lost_a = both.join(taken, in_a == F.col("id"), "left_semi").select("_n")
    lost_b = both.join(taken, in_b == F.col("id"), "left_semi").select("_n")
    return numbered.join(lost_a.union(lost_b), "_n", "left_anti").select(*rows.columns)
