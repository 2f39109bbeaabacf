"""Dictionary and dimension enrichment.

No hand-placed broadcast: the dictionary and dimensions are ordinary join
sides, and adaptive execution turns a join into a broadcast only when the
measured side is under ``spark.sql.autoBroadcastJoinThreshold``.  A dimension
that grows with the data (sku = part) therefore stays a shuffle join at
scale, and a skewed key is split by the skew-join rule.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def lookup(df: DataFrame, dim: DataFrame, left_key: str, columns: dict[str, str],
           dim_key: str = "id", how: str = "left") -> DataFrame:
    """Join ``dim`` on ``df[left_key] = dim[dim_key]`` and add ``columns``
    (dim column -> output name).  ``how='left'`` keeps rows whose key is
    missing (J8: columns stay null); ``'inner'`` is the dictionary lookup
    (J6) that drops them.  If the output name already exists it is
    replaced."""
    d = dim.select(F.col(dim_key).alias("_dk"), *[F.col(c).alias(f"_d_{o}") for c, o in columns.items()])
    out = df.join(d, df[left_key] == d["_dk"], how).drop("_dk")
    for o in columns.values():
        if o in df.columns:
            out = out.drop(o)
        out = out.withColumnRenamed(f"_d_{o}", o)
    return out


def dic_lookup(df: DataFrame, dic: DataFrame, code_col: str, name_col: str) -> DataFrame:
    """Processing-time lookup join to the dictionary (J6), inner."""
    return lookup(df, dic, code_col, {"dic_name": name_col}, dim_key="dic_code", how="inner")


def snowflake_sku(df: DataFrame, dims: dict[str, DataFrame], sku_col: str = "sku_id",
                  with_sku: bool = True) -> DataFrame:
    """Sku -> spu -> trademark -> category3 -> 2 -> 1, all left joins.
    With ``with_sku=False`` the sku hop is assumed done (J10)."""
    if with_sku:
        df = lookup(df, dims["sku_info"], sku_col,
                    {"sku_name": "sku_name", "spu_id": "spu_id", "tm_id": "trademark_id",
                     "category3_id": "category3_id"})
        df = lookup(df, dims["spu_info"], "spu_id", {"spu_name": "spu_name"})
    df = lookup(df, dims["base_trademark"], "trademark_id", {"tm_name": "trademark_name"})
    df = lookup(df, dims["base_category3"], "category3_id",
                {"name": "category3_name", "category2_id": "category2_id"})
    df = lookup(df, dims["base_category2"], "category2_id",
                {"name": "category2_name", "category1_id": "category1_id"})
    df = lookup(df, dims["base_category1"], "category1_id", {"name": "category1_name"})
    return df
