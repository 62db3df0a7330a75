"""Equi-joins between session-grain and driver-grain tables.

A session key may be hot. The many-row side's rows are counted by key first, on
its key columns alone. Only keys with more rows than an even task are cut: their
rows are spread over shares in proportion to the count and their one session row
is repeated for each share. All other sessions are joined as they are. No side is
forced to broadcast: adaptive execution does so when the size it has measured is
under the session's threshold, and sorts and merges otherwise.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.types import StructType

from lapwise.functions.values import flag_equal, ratio
from lapwise.keys import DRIVER, SESSION
from lapwise.session import parallel_pieces

#: A key with fewer rows is never cut: one task reads these in no time.
SPLIT_ABOVE = 100_000
_SHARE = "__share"

#: Number of shares, and the hashes of the keys that are cut into so many.
Heavy = Mapping[int, Sequence[int]]


def _share(columns: Sequence[str], copies: int | Column) -> Column:
    # A hash of the row's own values, not a random draw: a retried task gives the same share.
    return F.pmod(F.xxhash64(*columns), copies if isinstance(copies, Column) else F.lit(copies)).cast("int")


def _key_hash(on: Sequence[str], schema: StructType) -> Column:
    """One number for a key, the same on both sides of a join: values as the many-row side's types, one zero."""
    typed = []
    for name in on:
        kind = schema[name].dataType
        value = F.col(name).try_cast(kind)
        typed.append(value + F.lit(0).cast(kind) if kind.typeName() in ("float", "double") else value)
    return F.xxhash64(*typed)


def heavy_keys(rows: DataFrame, on: Sequence[str], pieces: int | None = None, least: int = SPLIT_ABOVE) -> Heavy:
    """Keys that hold more than an even task's share of `rows`, by the number of shares to cut them into.

    One job counts rows by key, combined before the shuffle. At most `pieces` keys, one for
    each shuffle partition, can exceed an even share, so no more than that many counts
    come to the driver. Numbers of shares are powers of two. A missing key counts as a
    key: its rows match nothing, but they meet in a join all the same.
    """
    pieces = pieces or parallel_pieces(rows.sparkSession)
    counts = rows.groupBy(_key_hash(on, rows.schema).alias("key")).agg(F.count(F.lit(1)).alias("n"))
    # both readers use the same shuffled counts
    most = counts.orderBy(F.desc("n")).limit(pieces).select("key", "n", F.lit(False).alias("whole"))
    seen = most.union(counts.agg(F.lit(0), F.coalesce(F.sum("n"), F.lit(0)), F.lit(True))).collect()
    total = next(n for _, n, whole in seen if whole)
    found: dict[int, list[int]] = {}
    for key, n, whole in seen:
        if not whole and n > least and n * pieces > total:
            shares = -(-n * pieces // total)
            found.setdefault(1 << (shares - 1).bit_length(), []).append(key)
    return found


def _copies(on: Sequence[str], schema: StructType, heavy: Heavy) -> Column:
    key = _key_hash(on, schema)
    levels = sorted(heavy.items())
    first, rest = levels[0], levels[1:]
    picked = F.when(key.isin(list(first[1])), F.lit(first[0]))
    for shares, keys in rest:
        picked = picked.when(key.isin(list(keys)), F.lit(shares))
    return picked.otherwise(F.lit(1))


def join_session(
    rows: DataFrame,
    sessions: DataFrame,
    on: Sequence[str] = SESSION,
    spread_by: Sequence[str] = (),
    how: str = "left",
    heavy: Heavy | None = None,
) -> DataFrame:
    """Add one-row-per-key columns to every row. `how` is left or inner.

    `heavy` tells the hot keys; by default `rows` are counted for it, which reads them once more.
    """
    if how not in ("left", "inner"):
        raise ValueError("the repeated side cannot be kept by an outer join; use expand_session")
    heavy = heavy_keys(rows, on) if heavy is None else heavy
    if not heavy:
        return rows.join(sessions, list(on), how)
    spread = list(spread_by) or [name for name in rows.columns if name not in on]
    copies = _copies(on, rows.schema, heavy)
    left = rows.withColumn(_SHARE, _share(spread, copies))
    repeated = sessions.withColumn(_SHARE, F.explode(F.sequence(F.lit(0), copies - 1)))
    return left.join(repeated, [*on, _SHARE], how).drop(_SHARE)


def combine_sessions(tables: Sequence[DataFrame], on: Sequence[str] = SESSION) -> DataFrame:
    """Session-grain tables side by side; a session absent from one has nulls there."""
    return reduce(lambda left, right: left.join(right, list(on), "full"), tables)


def join_driver(
    rows: DataFrame,
    facts: DataFrame,
    on: Sequence[str] = DRIVER,
    right_on: Sequence[str] | None = None,
    null_safe: bool = False,
) -> DataFrame:
    """Left join at driver grain. With `right_on` the key names differ and both sides keep theirs."""
    if right_on is None and not null_safe:
        return rows.join(facts, list(on), "left")
    right_names = list(right_on or on)
    facts = facts.withColumnsRenamed({name: f"__r_{name}" for name in right_names})
    pairs = [
        rows[left].eqNullSafe(facts[f"__r_{right}"]) if null_safe else rows[left] == facts[f"__r_{right}"]
        for left, right in zip(on, right_names, strict=True)
    ]
    joined = rows.join(facts, reduce(lambda a, b: a & b, pairs), "left")
    # Only a key whose name is still free is kept from the right side.
    for right in right_names:
        if right in rows.columns:
            joined = joined.drop(f"__r_{right}")
        else:
            joined = joined.withColumnRenamed(f"__r_{right}", right)
    return joined


def expand_session(
    sessions: DataFrame,
    drivers: DataFrame,
    on: Sequence[str] = SESSION,
    how: str = "left",
    spread_by: Sequence[str] = ("Driver",),
) -> DataFrame:
    """Session columns on every driver row of the session.

    `left` also keeps sessions without drivers, and reads both sides twice: pass staged
    tables. `right` also keeps drivers without a session row.
    """
    if how not in ("left", "right"):
        raise ValueError("how must be left or right")
    columns = [*on, *[c for c in sessions.columns if c not in on], *[c for c in drivers.columns if c not in on]]
    if how == "right":
        return join_session(drivers, sessions, on, spread_by, "left").select(*columns)
    matched = join_session(drivers, sessions, on, spread_by, "inner").select(*columns)
    present = drivers.select(*on).distinct()
    return matched.unionByName(sessions.join(present, list(on), "left_anti"), allowMissingColumns=True)


def wide_join(base: DataFrame, sides: Sequence[tuple[DataFrame, Sequence[str], Sequence[str]]]) -> DataFrame:
    """Chain of left joins; each side comes with the base's key names and its own."""
    for side, left_on, right_on in sides:
        base = join_driver(base, side, left_on, right_on)
    return base


def join_clean(
    left: DataFrame, right: DataFrame, on: Sequence[str], how: str = "left", suffixes: tuple[str, str] | None = None
) -> DataFrame:
    """Join in which a non-key name on both sides is taken from the left, or kept twice with suffixes."""
    shared = [name for name in right.columns if name in left.columns and name not in on]
    if suffixes is None:
        return left.join(right.drop(*shared), list(on), how)
    left = left.withColumnsRenamed({name: name + suffixes[0] for name in shared})
    right = right.withColumnsRenamed({name: name + suffixes[1] for name in shared})
    return left.join(right, list(on), how)


def compare_to_group(
    rows: DataFrame,
    columns: Sequence[str],
    keys: Sequence[str] = SESSION,
    spread_by: Sequence[str] = (),
    best_prefix: str = "OverallSession_",
    ratio_prefix: str = "ComparativePace_",
    best: DataFrame | None = None,
    heavy: Heavy | None = None,
) -> DataFrame:
    """Each value over the smallest of its group.

    `best` has the smallest values under `best_prefix`. Without it they are
    aggregated from `rows`, before they are shuffled, so a hot group never meets in one
    task as a window over it would; `rows` is then read again: pass a table whose few
    compared columns are cheap to read, stored or staged.
    """
    if best is None:
        best = rows.groupBy(*keys).agg(*[F.min(c).alias(best_prefix + c) for c in columns])
    joined = join_session(rows, best, keys, spread_by, heavy=heavy)
    return joined.withColumns({ratio_prefix + c: ratio(c, best_prefix + c) for c in columns})


def best_of_sides(
    base: DataFrame,
    sides: Sequence[tuple[DataFrame, Sequence[str], Sequence[str]]],
    columns: Sequence[str],
    keys: Sequence[str] = SESSION,
    prefix: str = "OverallSession_",
) -> DataFrame:
    """The smallest value of each column in each group of `wide_join(base, sides)`, without that join.

    Each side gives its own compared columns and its keys, named as the base's; all
    of them, one under another, are reduced to one row for each key, those of the base are
    kept, and these are reduced to one row for each group. A side's rows that no base row
    meets do not count. `keys` are among the join's columns, which are the same for all sides.
    """
    narrow = []
    on = list(sides[0][1])
    for side, left_on, right_on in sides:
        if list(left_on) != on:
            raise ValueError("all sides must be joined on the same columns of the base")
        own = [c for c in columns if c in side.columns]
        narrow.append(side.select(*[F.col(r).alias(name) for name, r in zip(on, right_on, strict=True)], *own))
    long = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), narrow)
    each = long.groupBy(*on).agg(*[F.min(c).alias(c) for c in columns])
    # one row for each key on both sides; a semi join would be pushed into every side and read the base for each
    met = each.join(base.select(*on).distinct(), on)
    return met.groupBy(*keys).agg(*[F.min(c).alias(prefix + c) for c in columns])


def order_by_group_stat(
    rows: DataFrame, group: str, stat: Column, descending: bool = True, ties: Sequence[str] = ()
) -> DataFrame:
    """Sort rows by a statistic of their group. `rows` is read twice: pass a staged table."""
    ranked = rows.groupBy(group).agg(stat.alias("__stat"))
    key = F.desc_nulls_last("__stat") if descending else F.asc_nulls_last("__stat")
    return rows.join(ranked, group).orderBy(key, group, *ties).drop("__stat")


def with_winner(results: DataFrame, winners: DataFrame, spread_by: Sequence[str] = ("DriverId",)) -> DataFrame:
    """Winner's time and id on every result, relative pace and the winner flag."""
    joined = join_session(results, winners, SESSION, spread_by)
    return joined.withColumns(
        {"Racepace": ratio("Time", "WinnerTime"), "IsWinnerFlag": flag_equal("Time", "WinnerTime")}
    )


def race_winners(results: DataFrame, finished: str = "Finished", single: bool = False) -> DataFrame:
    """Time and id of the finisher in first place of each race.

    A dead heat has a row for each of its winners; with `single` only the one of the
    least time and then the least id, so that a join by race keeps one row for each result.
    """
    first = results.filter((F.col("Status") == finished) & (F.col("Position") == 1))
    winners = first.select(*SESSION, F.col("Time").alias("WinnerTime"), F.col("DriverId").alias("WinnerDriver"))
    if not single:
        return winners
    order = F.struct(F.col("WinnerTime").isNull(), "WinnerTime", "WinnerDriver")
    return winners.groupBy(*SESSION).agg(F.min(order).alias("first")).select(*SESSION, "first.WinnerTime", "first.WinnerDriver")


def finishers(results: DataFrame, finished: str = "Finished") -> DataFrame:
    return results.filter(F.col("Status") == finished)
