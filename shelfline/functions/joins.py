"""Joins that no single key can overload."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F


def join_unique(rows: DataFrame, classes: DataFrame, key: Sequence[str], n_rows: str = "n_rows",
                share: int = 1000) -> DataFrame:
    """``rows`` joined with ``classes``, which have unique keys and know how many rows have theirs.

    A key with more than one ``share``-th of all these rows would burden one task. There are
    fewer than ``share`` of them, whatever the input, so they are broadcast; the rest meets in
    an ordinary join. ``classes`` should be staged; ``n_rows`` does not come along.
    """
    key = list(key)
    total = classes.agg(F.sum(n_rows)).first()[0] or 0
    often = F.col(n_rows) * share > total
    hot, cold = F.broadcast(classes.where(often).drop(n_rows)), classes.where(~often).drop(n_rows)
    rest = rows.join(F.broadcast(classes.where(often).select(*key)), key, "left_anti")
    return rows.join(hot, key).unionByName(rest.join(cold, key))
