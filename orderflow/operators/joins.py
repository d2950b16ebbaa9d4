"""Two join shapes that bear hot keys.

A left outer join can be split at a hot key only on its left side. So the side
with many rows per key is always the left one here, and its hot partitions are
split by the adaptive skew join; the right side has one row per key.

The skew join needs a shuffle right below both sides of the join. A right side
that was aggregated by the same key is already in place and gets none, so it is
settled (written out, see ``session``) before it meets a side with hot keys.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Keys that may be broadcast: at most some 20 MB in the driver.
KEYS_AT_ONCE = 200_000


def by_number(keys: DataFrame, number: int) -> DataFrame:
    """The right side of a join, broadcast only if ``number`` rows are few. Spark goes
    by the size of the written file, in which sorted keys take a byte or two: those of
    millions of orders would be broadcast, and do not fit the driver."""
    return keys.hint("merge") if number > KEYS_AT_ONCE else keys


def look_up(rows: DataFrame, table: DataFrame, key: str) -> DataFrame:
    """Left outer join of many rows to a table with a unique key, whatever the
    size of either: one plan, in which Spark broadcasts a table that is small.

    Of a large table only the range of keys that is asked for is scanned. The
    range also marks the rows as selective, so that Spark's runtime Bloom filter
    of their keys cuts the table down before it is shuffled. Rows without a key
    find nothing and stay out of the join, where they would meet in one
    partition. ``rows`` are read three times, so they should be settled; the
    range takes a job."""
    low, high = rows.agg(F.min(key), F.max(key)).first()
    asked = F.col(key).between(low, high) if low is not None else F.lit(False)
    found = rows.where(asked).join(table, key, "left")
    return found.unionByName(rows.where(F.col(key).isNull()), allowMissingColumns=True)


def children_of(parents: DataFrame, children: DataFrame, key: str) -> DataFrame:
    """Inner join of unique parents to children; hot parents can be split."""
    return children.join(parents, key)


def childless(parents: DataFrame, children: DataFrame, key: str) -> DataFrame:
    """Parents no child points to. The children's keys become distinct
    map-side before they are shuffled, so a hot parent is one row per task."""
    return parents.join(children.select(key).distinct(), key, "left_anti")


def fan_out(parents: DataFrame, children: DataFrame, key: str) -> DataFrame:
    """``parents LEFT OUTER JOIN children``, as the union of the two above."""
    return children_of(parents, children, key).unionByName(
        childless(parents, children, key), allowMissingColumns=True
    )
