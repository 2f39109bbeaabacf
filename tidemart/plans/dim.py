"""The dimension job (dim_sink): configured dimension tables from change
records."""

from __future__ import annotations

from pyspark.sql import DataFrame

from ..operators import dims


def dim_sink(envelope: DataFrame, config_changes: DataFrame, apply_deletes: bool = False) -> DataFrame:
    """``sink_table, id, data``: the latest whitelisted row per key of every
    configured dimension."""
    return dims.dim_rows(envelope, dims.fold_config(config_changes), apply_deletes)


def dim_tables(rows: DataFrame, config: DataFrame) -> dict[str, DataFrame]:
    """K6: one typed (all-string) DataFrame per configured sink table.  The
    config is one row per dimension table, so collecting it is bounded."""
    specs = config.select("sink_table", "sink_columns").collect()
    return {r.sink_table: dims.typed_dim(rows, r.sink_table, r.sink_columns) for r in specs}
