"""Numbers and times that are texts, packed for a shuffle.

An exchanged row takes 8 bytes for each column and pads every text to 8 more;
Spark's compression of blocks gains back only a part of it.  Packed, such
columns are one, with half a byte for each character.  Nothing is lost,
whatever the texts hold."""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: The columns to pack, by the marks that they may hold beside decimal digits.
Texts = Mapping[str, Sequence[str]]

# The hex digits that stand for what is no decimal digit.
MARKS = {"-": "A", ":": "B", " ": "C", ".": "D"}
SEP, NULL = "E", "F"
PACKED, REST = "_packed", "_rest"
OTHER = b"\xff"  # begins a key that is no number; no packed text begins so


def _replaced(c: Column, pairs: Iterable[tuple[str, str]]) -> Column:
    return reduce(lambda x, p: F.replace(x, F.lit(p[0]), F.lit(p[1])), pairs, c)


def _marked(c: Column, marks: str) -> Column:
    return _replaced(c, [(m, MARKS[m]) for m in marks])


def _unmarked(c: Column, marks: str) -> Column:
    return _replaced(c, [(MARKS[m], m) for m in marks])


def _halved(hexed: Column, raw: Column) -> Column:
    """``hexed`` in half bytes; null if its text ``raw`` holds anything else:
    letters that are hex digits are no decimal ones, unhex drops the rest."""
    return F.when(~raw.rlike("[A-Fa-f]"), F.unhex(F.when(F.length(hexed) % 2 == 0, hexed).otherwise(F.concat(hexed, F.lit(SEP)))))


def _columns(texts: Texts) -> list[tuple[str, str]]:
    return [(c, marks) for marks, cols in texts.items() for c in cols]


def pack(df: DataFrame, texts: Texts) -> DataFrame:
    """The columns of ``texts`` as two: ``PACKED``, or ``REST`` in a row that
    holds anything else than its digits and marks.  The others stay."""
    cols = [c for c, _ in _columns(texts)]
    hexed = F.concat_ws(SEP, *[_marked(F.concat_ws(SEP, *[F.coalesce(F.col(c), F.lit(NULL)) for c in some]), marks) for marks, some in texts.items()])
    return (df.withColumn("_hexed", hexed)
            .withColumn(PACKED, _halved(F.col("_hexed"), F.concat_ws("", *cols)))
            .withColumn(REST, F.when(F.col(PACKED).isNull(), F.array(*cols)))
            .drop("_hexed", *cols))


def _value(i: int, marks: str, part: Column) -> Column:
    return F.when(F.col(PACKED).isNull(), F.col(REST)[i]).otherwise(_unmarked(F.nullif(part, F.lit(NULL)), marks))


def value(texts: Texts, name: str) -> Column:
    """One column of a packed row; the first ones are found fastest."""
    i, marks = next((i, marks) for i, (c, marks) in enumerate(_columns(texts)) if c == name)
    return _value(i, marks, F.substring_index(F.substring_index(F.hex(PACKED), SEP, i + 1), SEP, -1))


def unpack(df: DataFrame, texts: Texts) -> DataFrame:
    """The columns that :func:`pack` took."""
    return df.withColumn("_parts", F.split(F.hex(PACKED), SEP)).select(
        *[F.col(f"`{c}`") for c in df.columns if c not in (PACKED, REST)],
        *[_value(i, marks, F.col("_parts")[i]).alias(c) for i, (c, marks) in enumerate(_columns(texts))])


def pack_key(c: Column, marks: str = "-") -> Column:
    """A text to join and group by as bytes, equal where the texts are."""
    return F.coalesce(_halved(_marked(c, marks), c), F.concat(F.lit(OTHER), c.cast("binary")))


def unpack_key(c: Column, marks: str = "-") -> Column:
    """The text of :func:`pack_key`."""
    return (F.when(F.substring(c, 1, 1) == F.lit(OTHER), F.substring(c, 2, 2**31 - 1).cast("string"))
            .otherwise(_unmarked(F.rtrim(F.hex(c), F.lit(SEP)), marks)))
