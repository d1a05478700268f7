"""Python work on whole groups, many at a call: a group's rows lie together, and a task holds one batch and one group."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame


#: Rows of a task of `spread`: what it holds of them stays at this size as tables grow.
ROWS_A_TASK = 1_500_000


def spread(rows: DataFrame, *key: str) -> DataFrame:
    """`rows` by the hash of `key` in as many tasks as the session's shuffles have, or more, so that they get ROWS_A_TASK rows each on average.

    A grouping on `key`, or on more columns, then needs no shuffle of its own. `rows` are counted first.
    """
    own = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return rows.repartition(max(own, -(-rows.count() // ROWS_A_TASK)), *key)


def bounds(group: np.ndarray) -> np.ndarray:
    """Where each group begins, and the end."""
    if not len(group):
        return np.zeros(1, np.int64)
    return np.concatenate([[0], np.flatnonzero(group[1:] != group[:-1]) + 1, [len(group)]])


def whole_groups(batches: Iterator[pd.DataFrame], key: str) -> Iterator[pd.DataFrame]:
    """The rows of `batches`, sorted by `key`, parted between its values: a batch's whole groups together, a longer one by itself."""
    held: list[pd.DataFrame] = []
    for batch in batches:
        if not len(batch):
            continue
        edges = bounds(batch[key].to_numpy())
        upto = int(edges[-2])  # the last group may go on
        own = int(edges[1]) if held and batch[key].iat[0] == held[-1][key].iat[-1] else 0
        if held and (upto or not own):
            yield pd.concat([*held, batch[:own]], ignore_index=True)
            held = []
        if upto > own or upto and not own:
            yield batch[own:upto].reset_index(drop=True)
        held.append(batch[upto:].copy() if upto else batch)
    if held:
        yield pd.concat(held, ignore_index=True)


def by_group(rows: DataFrame, key: str, order: list[Column | str], run: Callable[[pd.DataFrame], Iterator[pd.DataFrame]], schema: object, tasks: int = 0) -> DataFrame:
    """`run` over some whole groups of `rows` at once, their rows in `order`; in `tasks` tasks, if those are more than the session's shuffles have."""

    def stream(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for groups in whole_groups(batches, key):
            yield from run(groups)

    own = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return (rows.repartition(tasks, key) if tasks > own else rows.repartition(key)).sortWithinPartitions(key, *order).mapInPandas(stream, schema)
