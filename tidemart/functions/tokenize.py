"""Keyword tokenizer (F1): tokenise and explode, JVM-side.

Tokens are maximal runs of letters or digits after lower-casing; runs of
Chinese or Japanese script, which has no word spaces, give their
two-character pairs (a single character gives itself).  A different
tokenizer can be passed to :func:`explode_keywords` as a Column-producing
function.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# fixed values: the scripts without word spaces, and the token pattern
UNSPACED = r"\p{IsHan}\p{IsHiragana}\p{IsKatakana}"
TOKEN_PATTERN = rf"[{UNSPACED}]+|[\p{{L}}\p{{N}}&&[^{UNSPACED}]]+"


def tokens(text) -> Column:
    col = F.col(text) if isinstance(text, str) else text
    runs = F.regexp_extract_all(F.lower(col), F.lit(TOKEN_PATTERN), 0)

    def pairs(run: Column) -> Column:
        split = F.transform(F.sequence(F.lit(1), F.length(run) - 1), lambda i: F.substring(run, i, F.lit(2)))
        return F.when(run.rlike(f"^[{UNSPACED}]") & (F.length(run) > 1), split).otherwise(F.array(run))

    return F.flatten(F.transform(runs, pairs))


def explode_keywords(df: DataFrame, text_col: str, out_col: str = "keyword",
                     tokenizer: Callable[[Column], Column] | None = None) -> DataFrame:
    """One output row per token (``LATERAL TABLE(ik_analyze(text))``)."""
    tok = tokenizer or tokens
    return df.withColumn(out_col, F.explode(tok(F.col(text_col))))


def register_table_function(spark: SparkSession, name: str = "ik_analyze") -> None:
    """Register the tokenizer as a SQL table function for ``LATERAL`` use:
    plain SQL, so it runs JVM-side like :func:`explode_keywords`."""
    spark.sql(rf"""
        CREATE OR REPLACE TEMPORARY FUNCTION {name}(text STRING) RETURNS TABLE (keyword STRING)
        RETURN SELECT explode(flatten(transform(
            regexp_extract_all(lower(text), r'{TOKEN_PATTERN}', 0),
            run -> CASE WHEN run RLIKE r'^[{UNSPACED}]' AND length(run) > 1
                        THEN transform(sequence(1, length(run) - 1), i -> substring(run, i, 2))
                        ELSE array(run) END)))""")
