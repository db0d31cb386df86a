"""Order-sensitive blocks over streams of landing rows: what arrives late counts by its ordinal, not by its batch.

State is one row a key, so it grows with the keys of the table, as the table does. Both streams run in update mode and
give a key's whole row whenever it changed; `publish` puts such rows in the place of the key's row in a warehouse.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import types as T
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from ..sources.io import Warehouse


def _plain(value):
    """A scalar without pandas' ideas of null."""
    if value is None or (not isinstance(value, (list, dict, tuple)) and pd.isna(value)):
        return None
    return value.item() if hasattr(value, "item") else value


def first_rows(stream: DataFrame, keys: list[str], ordinal: str) -> DataFrame:
    """Of each key the row of the smallest ordinal so far; of equal ordinals the one that came first."""
    names = stream.columns
    at = names.index(ordinal)

    def run(key: tuple, batches: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        best = tuple(state.get) if state.exists else None
        before = best
        for rows in batches:
            rows = rows[rows[ordinal].notna()]
            if len(rows):
                row = tuple(_plain(x) for x in rows.loc[rows[ordinal].idxmin()])
                if best is None or row[at] < best[at]:
                    best = row
        if best is not before:
            state.update(best)
            yield pd.DataFrame([best], columns=names, dtype=object)

    return stream.groupBy(*keys).applyInPandasWithState(run, stream.schema, stream.schema, "update", GroupStateTimeout.NoTimeout)


def latest_values(stream: DataFrame, keys: list[str], ordinal: str) -> DataFrame:
    """Of each key the last non-null value of every column by ordinal so far; a row may mix columns of several rows."""
    columns = [c for c in stream.columns if c not in (*keys, ordinal)]
    kept = T.StructType([f for c in columns for f in (T.StructField(f"{c}_at", stream.schema[ordinal].dataType), T.StructField(c, stream.schema[c].dataType))])
    out = T.StructType([*(stream.schema[k] for k in keys), *(T.StructField(c, stream.schema[c].dataType) for c in columns)])

    def run(key: tuple, batches: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        held = list(state.get) if state.exists else [None] * (2 * len(columns))
        changed = not state.exists
        for rows in batches:
            for i, c in enumerate(columns):
                some = rows[rows[c].notna() & rows[ordinal].notna()]
                if len(some):
                    last = some.loc[some[ordinal].idxmax()]
                    if held[2 * i] is None or last[ordinal] > held[2 * i]:
                        held[2 * i], held[2 * i + 1] = _plain(last[ordinal]), _plain(last[c])
                        changed = True
        if changed:
            state.update(tuple(held))
            yield pd.DataFrame([[*map(_plain, key), *held[1::2]]], columns=[*keys, *columns], dtype=object)

    return stream.groupBy(*keys).applyInPandasWithState(run, out, kept, "update", GroupStateTimeout.NoTimeout)


def publish(warehouse: Warehouse, name: str, keys: list[str], stream: DataFrame, checkpoint: str):
    """Starts a query that puts the stream's rows in the place of the rows of their keys in table `name`. A batch that
    is tried again makes no second version."""

    def put(batch: DataFrame, number: int) -> None:
        old = warehouse.read().get(name)
        rows = batch if old is None else old.join(batch.select(*keys), keys, "left_anti").select(*batch.columns).unionByName(batch)
        warehouse.write({name: rows}, batch=f"{checkpoint}#{number}")

    return stream.writeStream.foreachBatch(put).outputMode("update").option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
