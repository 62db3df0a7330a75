"""Running sums and fills over long ordered groups, without one task per group.

All rows are put in the order of the group's columns and then the order columns,
and that order is cut into a fixed number of ranges. A window runs inside each
group and range; a table with at most one row for each group and one for each
range carries totals, or last known values, from range to range. The cuts come
from some of the rows: they spread the work and do not touch results.

A missing value in an order column comes before all others. The order columns
together must tell the rows of a group apart.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from lapwise.session import parallel_pieces

_PIECE = "__piece"
_LOOK_PER_PIECE = 200
_BEFORE = (Window.unboundedPreceding, -1)
_SO_FAR = (Window.unboundedPreceding, Window.currentRow)
_ALL = (Window.unboundedPreceding, Window.unboundedFollowing)


def cut_points(df: DataFrame, columns: Sequence[str], pieces: int) -> list[tuple]:
    """Rows of `columns` that cut their order into at most `pieces` ranges of like size.

    A few hundred rows for each piece are enough to find them; sketches over all
    rows would send megabytes from every task to one.
    """
    rows = df.select(*columns)
    wanted = _LOOK_PER_PIECE * pieces
    share = min(1.0, wanted / max(1, df.count()))
    if share < 1.0:
        rows = rows.sample(share, seed=42)
    # at most that many rows
    looked = Window.partitionBy(F.lit(0))
    step = F.greatest(F.lit(1), F.floor(F.count(F.lit(1)).over(looked) / pieces))
    placed = rows.limit(2 * wanted).withColumns({"__place": F.row_number().over(looked.orderBy(*columns)), "__step": step})
    cut = (F.col("__place") % F.col("__step") == 0) & (F.col("__place") < pieces * F.col("__step"))
    return [tuple(r) for r in placed.where(cut).select(*columns).distinct().orderBy(*columns).collect()]


def with_pieces(df: DataFrame, columns: Sequence[str], pieces: int | None = None) -> DataFrame:
    """Add the number of the range that the row falls into: how many cuts are at most the row."""
    cuts = cut_points(df, columns, pieces or parallel_pieces(df.sparkSession))
    if not cuts:
        return df.withColumn(_PIECE, F.lit(0))
    kinds = [df.schema[c].dataType for c in columns]
    known = F.array(*[
        F.struct(*[F.lit(v).cast(kind).alias(f"v{i}") for i, (v, kind) in enumerate(zip(cut, kinds))]) for cut in cuts
    ])
    row = F.struct(*[F.col(c).alias(f"v{i}") for i, c in enumerate(columns)])
    # halves the open range of cuts until it is empty
    found = F.aggregate(
        F.sequence(F.lit(1), F.lit(len(cuts).bit_length())),
        F.struct(F.lit(0).alias("low"), F.lit(len(cuts)).alias("high")),
        lambda open_, _: F.when(open_["low"] >= open_["high"], open_).when(
            F.get(known, F.floor((open_["low"] + open_["high"]) / 2).cast("int")) <= row,
            F.struct((F.floor((open_["low"] + open_["high"]) / 2) + 1).cast("int").alias("low"), open_["high"].alias("high")),
        ).otherwise(F.struct(open_["low"].alias("low"), F.floor((open_["low"] + open_["high"]) / 2).cast("int").alias("high"))),
        lambda open_: open_["low"],
    )
    return df.withColumn(_PIECE, found)


def _over(part: Sequence[str], order: Sequence[Column | str], frame: tuple[int, int]) -> Window:
    window = Window.partitionBy(*part) if part else Window.partitionBy()
    return window.orderBy(*order).rowsBetween(*frame)


def _beside(rows: DataFrame, carried: DataFrame, block: Sequence[str]) -> DataFrame:
    """Rows with the carried values of their block; a missing group is a group."""
    named = carried.withColumnsRenamed({c: f"__of_{c}" for c in block})
    same = F.lit(True)
    for c in block:
        same = same & rows[c].eqNullSafe(named[f"__of_{c}"])
    return rows.join(named, same, "left")


def running_sum(
    df: DataFrame,
    order: Sequence[str],
    sums: Mapping[str, str],
    part: Sequence[str] = (),
    totals: Mapping[str, str] | None = None,
    descending: bool = False,
    pieces: int | None = None,
) -> DataFrame:
    """Running sum of `sums[name]` under `name`, in `order` inside each `part`.

    A missing value stays missing and later rows continue the sum. `totals` asks
    for the sum over the whole part beside each row. `df` is read several times:
    pass a stored or staged table.
    """
    blocked = with_pieces(df, [*part, *order], pieces)
    block = [*part, _PIECE]
    turn = F.desc if descending else F.asc
    totals = totals or {}
    wanted = sorted({*sums.values(), *totals.values()})

    per_block = blocked.groupBy(*block).agg(*[F.sum(c).alias(f"__{c}") for c in wanted])
    before = _over(part, [turn(_PIECE)], _BEFORE)
    whole = _over(part, [turn(_PIECE)], _ALL)
    carried = per_block.select(
        *block,
        *[F.coalesce(F.sum(f"__{c}").over(before), F.lit(0)).alias(f"__before_{c}") for c in sorted(set(sums.values()))],
        *[F.sum(f"__{c}").over(whole).alias(name) for name, c in totals.items()],
    )
    inside = _over(block, [turn(c) for c in order], _SO_FAR)
    within = blocked.withColumns({f"__in_{c}": F.sum(c).over(inside) for c in sorted(set(sums.values()))})
    results = _beside(within, carried, block).withColumns(
        {
            name: F.when(F.col(c).isNotNull(), F.col(f"__in_{c}") + F.col(f"__before_{c}"))
            for name, c in sums.items()
        }
    )
    return results.select(*df.columns, *sums, *totals)


def fill_forward_backward(
    df: DataFrame,
    order: Sequence[str],
    columns: Sequence[str],
    part: Sequence[str] = (),
    pieces: int | None = None,
) -> DataFrame:
    """Last known value, or where there is none yet the first one to come.

    With no `part` the fill runs over the whole table in row order and crosses
    drivers and sessions. After the forward fill only the head of a part is still
    empty, and what fills it backward is the first known value of the part.
    """
    blocked = with_pieces(df, [*part, *order], pieces)
    block = [*part, _PIECE]
    inside, all_of_it = _over(block, order, _SO_FAR), _over(block, order, _ALL)
    end = F.lead(F.lit(1)).over(Window.partitionBy(*block).orderBy(*order)).isNull()
    within = blocked.withColumns({f"__in_{c}": F.last(c, ignorenulls=True).over(inside) for c in columns})

    # the last row of a block has the block's last known values
    per_block = (
        blocked.withColumns({
            **{f"__last_{c}": F.last(c, ignorenulls=True).over(inside) for c in columns},
            **{f"__first_{c}": F.first(c, ignorenulls=True).over(all_of_it) for c in columns}, "__end": end,
        })
        .where("__end").select(*block, *[f"__last_{c}" for c in columns], *[f"__first_{c}" for c in columns])
    )
    before, whole = _over(part, [_PIECE], _BEFORE), _over(part, [_PIECE], _ALL)
    carried = per_block.select(
        *block,
        *[F.last(f"__last_{c}", ignorenulls=True).over(before).alias(f"__carry_{c}") for c in columns],
        *[F.first(f"__first_{c}", ignorenulls=True).over(whole).alias(f"__head_{c}") for c in columns],
    )
    filled = _beside(within, carried, block).withColumns(
        {c: F.coalesce(f"__in_{c}", f"__carry_{c}", f"__head_{c}") for c in columns}
    )
    return filled.select(*df.columns)


def mean_running_points(
    results: DataFrame,
    entity: str,
    order: Sequence[str],
    points: str = "Points",
    mode: str = "mean",
    race: Sequence[str] = ("RACEYEAR", "RACENUMBER"),
    pieces: int | None = None,
) -> DataFrame:
    """Points gathered up to each race, one row for each race and entity.

    `mean` averages the running sums of an entity's rows in a race; `end_of_race`
    takes the sum after the last of them, which needs no order inside the race.
    """
    if mode == "end_of_race":
        per_race = results.filter(F.col(entity).isNotNull()).groupBy(entity, *race).agg(F.sum(points).alias("__race"))
        upto = _over([entity], list(race), _SO_FAR)
        return per_race.select(
            *race, entity, F.when(F.col("__race").isNotNull(), F.sum("__race").over(upto)).alias("CumulativePoints")
        )
    if mode != "mean":
        raise ValueError("mode must be mean or end_of_race")
    rows = results.filter(F.col(entity).isNotNull()).select(entity, *dict.fromkeys([*race, *order, points]))
    summed = running_sum(rows, order, {"CumulativePoints": points}, [entity], pieces=pieces)
    means = summed.groupBy(*race, entity).agg(F.avg("CumulativePoints").alias("CumulativePoints"))
    return means
