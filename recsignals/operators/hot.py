"""Keys with few rows, told apart from hot ones.

All rows of a key with few rows fit one sort: one exchange by key serves every window over it, and neither time
buckets nor halo rows, carried rows or a separate set of probes are needed. Only hot keys take the bucketed
forms of :mod:`recsignals.operators.frames` and :mod:`recsignals.operators.asof_many`.

Keys are counted in a table of fixed size (:data:`SLOTS` counters of hashed keys, added up in the tasks), so counting moves
next to nothing. A key is hot if its counter is above :data:`HOT_ROWS`; a key that shares its counter with a hot one takes the
bucketed form as well, with the same results.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Counters of hashed keys, and the rows of a counter above which its keys are hot: a task sorts no longer run of one key.
SLOTS, HOT_ROWS = 1 << 17, 200_000


@dataclass(frozen=True)
class Sizes:
    """The hot counters of keys of the given types (null is a key too)."""

    types: tuple[str, ...]
    hot: tuple[int, ...]
    #: Several tables are made from one log: its rows are exchanged by key once for all of them, with all their columns.
    shared: bool = False

    def is_hot(self, keys: list[str]) -> Column:
        return _slot([F.col(k).cast(t) for k, t in zip(keys, self.types, strict=True)]).isin(*self.hot)

    def split(self, df: DataFrame, keys: list[str]) -> tuple[DataFrame, DataFrame | None]:
        """(rows of keys with few rows, rows of hot keys or None). With hot keys ``df`` is read twice."""
        return (df.where(~self.is_hot(keys)), df.where(self.is_hot(keys))) if self.hot else (df, None)


def _slot(keys: list[Column]) -> Column:
    return F.pmod(F.xxhash64(*keys), F.lit(SLOTS)).cast("int")


def key_sizes(*tables: tuple[DataFrame, list[str]], limit: int | None = None) -> Sizes:
    """Counts the rows of all ``tables`` (a frame and its key columns, in the same order) by key. Pass stored tables."""
    n = len(tables[0][1])
    rows = reduce(DataFrame.union, [df.select(*[F.col(k).alias(f"k{i}") for i, k in enumerate(keys)]) for df, keys in tables])
    counts = rows.groupBy(_slot([F.col(f"k{i}") for i in range(n)]).alias("slot")).agg(F.count(F.lit(1)).alias("n"))
    hot = [r["slot"] for r in counts.where(F.col("n") > (HOT_ROWS if limit is None else limit)).select("slot").collect()]
    return Sizes(tuple(t for _, t in rows.dtypes), tuple(sorted(hot)))


def by_size(df: DataFrame, columns: list[str], keys: list[str], sizes: Sizes | None, make: Callable[[DataFrame, bool], DataFrame]) -> DataFrame:
    """``make(rows, few)`` over the rows and ``columns`` of ``df``: keys with few rows after one exchange by key (``few``
    true), hot keys as they are. Without ``sizes`` every key counts as hot."""
    if sizes is None:
        return make(df.select(*columns), False)
    few, hot = sizes.split(df, keys)
    few = _with_all_columns(few.repartition(*keys)).select(*columns) if sizes.shared else few.select(*columns).repartition(*keys)
    out = make(few, True)
    return out if hot is None else out.unionByName(make(hot.select(*columns), False))


def _with_all_columns(df: DataFrame) -> DataFrame:
    """``df`` with a condition that always holds, reads all columns and stays above an exchange, so that plans which go on
    with different columns share the exchange."""
    return df.where(F.hash(*df.columns) + F.rand(0) > -(2.0**33))
