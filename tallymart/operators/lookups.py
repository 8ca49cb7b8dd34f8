"""Many-to-one lookups that never change the number of child rows.

A lookup shuffles its child by the key, so a key (or NULL) that holds a large share of the
rows would end in one task.  Adaptive execution splits such a partition, but only where both
sides of the join come straight from an exchange that Spark added for the join.  A parent
that has been aggregated by the key has its own partitioning and gets no such exchange.
``split_join`` therefore joins on the key and its length: equal keys have equal lengths, so
the result is that of a join on the key, and both sides are dealt anew.
"""

from __future__ import annotations

from collections.abc import Iterable
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallymart.operators.compact import compact, restored
from tallymart.operators.distinct import stored
from tallymart.operators.rules import quoted

FOUND = "__found"
# Orphaned keys that a lookup sends to all tasks; with more of them the child is shuffled instead.
FEW_ORPHANS = 200_000


def split_join(child: DataFrame, parent: DataFrame, key: str, how: str = "left") -> DataFrame:
    """Join on a string key (inner, left, left_semi or left_anti) whose hot keys can be split."""
    left, right = child.alias("child"), parent.alias("parent")
    mine, theirs = F.col(f"child.{quoted(key)}"), F.col(f"parent.{quoted(key)}")
    joined = left.join(right, (mine == theirs) & (F.length(mine) == F.length(theirs)), how)
    if how in ("left_semi", "left_anti"):
        return joined
    others = [F.col(f"parent.{quoted(c)}") for c in parent.columns if c != key]
    return joined.select("child.*", *others)


def parent_keys(
    parent: DataFrame, key: str, carry: dict[str, Column] | None = None, trim: bool = True
) -> DataFrame:
    """One row per trimmed parent key, with aggregated columns to carry along.

    Being an aggregate on the join key, it lets Catalyst remove the whole join
    when a caller selects nothing that depends on it.
    """
    trimmed = parent.withColumn(key, F.trim(key)) if trim else parent
    if not carry:
        return trimmed.select(key).distinct()
    return trimmed.groupBy(key).agg(*[value.alias(name) for name, value in carry.items()])


def with_parent(
    child: DataFrame,
    parent: DataFrame,
    key: str,
    marker: str = FOUND,
    carry: dict[str, Column] | None = None,
    ids: Iterable[str] = (),
) -> DataFrame:
    """Left join on the distinct parent keys; ``marker`` is TRUE where a parent exists, else NULL.

    Rows are shuffled with the columns of ``ids``, among them the key, as bytes (``compact``).
    """
    ids = list(ids)
    if key in ids:
        parent = compact(parent.withColumn(key, F.trim(key)), [key])
        lookup = parent_keys(parent, key, carry, trim=False).withColumn(marker, F.lit(True))
        return restored(split_join(compact(child, ids), lookup, key, "left"), ids)
    lookup = parent_keys(parent, key, carry).withColumn(marker, F.lit(True))
    return split_join(child, lookup, key, "left")


def orphan(key: str, marker: str = FOUND) -> str:
    """Predicate of a key that is present but has no parent."""
    return f"({key} IS NOT NULL AND {marker} IS NULL)"


def orphan_or_unknown(key: str, marker: str = FOUND) -> str:
    """As ``orphan``, but NULL where the key itself is NULL."""
    return f"if({key} IS NULL, NULL, {marker} IS NULL)"


def with_orphans(child: DataFrame, parent: DataFrame, key: str, marker: str, few: int = FEW_ORPHANS) -> DataFrame:
    """``marker`` is TRUE where a key is present but has no parent, else NULL; rows as in ``child``.

    The distinct orphaned keys are stored in the shared folder and counted.  Where they are few, they
    are sent to the child, whose rows then need no shuffle, however large the parent; otherwise it
    is the join of ``with_parent``.
    """
    keys = child.select(quoted(key)).where(F.col(quoted(key)).isNotNull()).distinct()
    lost = stored(split_join(keys, parent_keys(parent, key), key, "left_anti"), "orphans")
    if lost.limit(few + 1).count() <= few:
        return split_join(child, F.broadcast(lost.withColumn(marker, F.lit(True))), key, "left")
    found = with_parent(child, parent, key)
    return found.withColumn(marker, F.expr(f"if({orphan(quoted(key))}, true, NULL)")).drop(FOUND)


def unique_parents(child: DataFrame, parents: dict[str, DataFrame], few: int = FEW_ORPHANS) -> set[str]:
    """Those keys of which no row of ``child`` finds two parents.

    Keys that repeat in a parent are stored; where they are few, the child is searched for them,
    without a shuffle.  NULL keys, which no child finds, may repeat.
    """
    keys = [
        parent.select(F.lit(key).alias("name"), F.col(quoted(key)).alias("value")).dropna()
        for key, parent in parents.items()
    ]
    repeated = reduce(DataFrame.unionAll, keys).groupBy("name", "value").count().where("count > 1")
    repeated = stored(repeated.select("name", "value"), "repeated")
    unique = set(parents)
    for name, n in repeated.groupBy("name").count().collect():
        values = F.broadcast(repeated.where(F.col("name") == name).select(F.col("value").alias(name)))
        if n > few or not child.select(quoted(name)).join(values, name, "left_semi").isEmpty():
            unique.remove(name)
    return unique


def one_per_key(parent: DataFrame, key: str) -> DataFrame:
    """One row per key, as an aggregate on it: a left join with it that nothing is asked from
    can be removed, as it cannot multiply the child.  For keys that ``unique_parents`` names."""
    others = [F.first(F.col(quoted(c))).alias(c) for c in parent.columns if c != key]
    return parent.where(F.col(quoted(key)).isNotNull()).groupBy(quoted(key)).agg(*others)
