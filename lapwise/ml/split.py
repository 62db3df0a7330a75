"""Stratified train, validation and test sets."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window, functions as F

_DRAW, _SLOT, _RANK = "__draw", "__slot", "__rank"


def _allotted(classes: DataFrame, rows: str, share: float, name: str, label: str) -> DataFrame:
    """Split `share` of all rows among classes in proportion, whole rows, largest remainder first.

    `classes` has one row for each class.
    """
    everything = Window.partitionBy()
    wanted = F.ceil(F.lit(share) * F.sum(rows).over(everything))
    exact = wanted * F.col(rows) / F.sum(rows).over(everything)
    floored = classes.withColumns({"__want": wanted, "__exact": exact, "__floor": F.floor(exact)})
    spare = F.col("__want") - F.sum("__floor").over(everything)
    turn = F.row_number().over(everything.orderBy((F.col("__exact") - F.col("__floor")).desc(), label))
    given = floored.withColumns({"__spare": spare, "__turn": turn})
    return given.withColumn(
        name, (F.col("__floor") + (F.col("__turn") <= F.col("__spare")).cast("long")).cast("long")
    ).drop("__want", "__exact", "__floor", "__spare", "__turn")


def stratified_split(
    df: DataFrame,
    label: str,
    ids: Sequence[str],
    seed: int = 42,
    test: float = 0.2,
    validation: float = 0.25,
    slot_digits: int = 3,
) -> DataFrame:
    """Add `split`: test, validation or train, each with the label's own proportions.

    `validation` is a share of what test leaves. `ids` name each row. The order
    inside a label is that of a hash of the seed and the ids. A label with nearly
    all rows is not sorted in one task: the hash's first hex digits cut it into
    16 ** slot_digits even slots, ranks are taken inside a slot, and the slot
    counts shift them to ranks in the label.
    """
    draw = F.md5(F.concat_ws(":", F.lit(str(seed)), *[F.col(c).cast("string") for c in ids]))
    drawn = df.withColumn(_DRAW, draw).withColumn(_SLOT, F.substring(_DRAW, 1, slot_digits))
    slots = drawn.groupBy(label, _SLOT).agg(F.count(F.lit(1)).alias("__n"))
    before = Window.partitionBy(label).orderBy(_SLOT).rowsBetween(Window.unboundedPreceding, -1)
    shifts = slots.select(label, _SLOT, F.coalesce(F.sum("__n").over(before), F.lit(0)).alias("__shift"))

    classes = slots.groupBy(label).agg(F.sum("__n").alias("__rows"))
    classes = _allotted(classes, "__rows", test, "__test", label)
    classes = classes.withColumn("__rest", F.col("__rows") - F.col("__test"))
    classes = _allotted(classes, "__rest", validation, "__validation", label)
    bounds = shifts.join(
        classes.select(label, "__test", (F.col("__test") + F.col("__validation")).alias("__upto")), label
    )

    inside = Window.partitionBy(label, _SLOT).orderBy(_DRAW, *ids)
    ranked = drawn.withColumn(_RANK, F.row_number().over(inside)).join(bounds, [label, _SLOT])
    place = F.col(_RANK) + F.col("__shift")
    split = (
        F.when(place <= F.col("__test"), "test").when(place <= F.col("__upto"), "validation").otherwise("train")
    )
    return ranked.withColumn("split", split).select(*df.columns, "split")


def stratified_folds(
    df: DataFrame, label: str, folds: int, ids: Sequence[str], seed: int = 42, into: str = "fold", slot_digits: int = 2
) -> DataFrame:
    """Add `into`, 0 to `folds` - 1: the label's rows in turn, in the order of a hash of the seed and the ids.

    Ranks inside a label are taken in slots of the hash and shifted by slot counts, as for the split.
    """
    draw = F.md5(F.concat_ws(":", F.lit(f"fold{seed}"), *[F.col(c).cast("string") for c in ids]))
    drawn = df.withColumn(_DRAW, draw).withColumn(_SLOT, F.substring(_DRAW, 1, slot_digits))
    before = Window.partitionBy(label).orderBy(_SLOT).rowsBetween(Window.unboundedPreceding, -1)
    slots = drawn.groupBy(label, _SLOT).agg(F.count(F.lit(1)).alias("__n"))
    shifts = slots.select(label, _SLOT, F.coalesce(F.sum("__n").over(before), F.lit(0)).alias("__shift"))
    inside = Window.partitionBy(label, _SLOT).orderBy(_DRAW, *ids)
    ranked = drawn.withColumn(_RANK, F.row_number().over(inside)).join(shifts, [label, _SLOT])
    fold = F.pmod(F.col(_RANK) + F.col("__shift"), F.lit(folds)).cast("int")
    return ranked.withColumn(into, fold).select(*df.columns, into)
