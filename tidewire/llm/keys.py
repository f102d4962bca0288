"""Row keys and text units shared by the operators of this package."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewire.sources.tables import shared_folder

#: ASCII white space; everything else is part of a word.
WORD = r"[^\x20\x09-\x0D]+"


def row_keys(id_col: str, text_col: str, prefix: str = "_k") -> list[Column]:
    """Two 64-bit hashes of id and text.

    Together they name a row: rows that share them are equal in id and text and
    so get equal results. Null ids do not meet in one key, because the text counts too.
    """
    return [
        F.xxhash64(F.lit(17), F.col(id_col), F.col(text_col)).alias(f"{prefix}1"),
        F.xxhash64(F.col(text_col), F.col(id_col), F.lit(23)).alias(f"{prefix}2"),
    ]


def held_out(id_col: str, folds: int = 5) -> Column:
    """True for rows whose labels must not be learnt: crc32 of the id as text, modulo ``folds``, is 0; null ids count as held out."""
    return F.coalesce(F.crc32(F.col(id_col).cast("string").cast("binary")) % folds == 0, F.lit(True))


def boxed(columns: list[str]) -> Column:
    """The given columns as one column ``_row``, so that their names cannot meet the names an operator works with."""
    return F.struct(*[F.col(f"`{c}`") for c in columns] or [F.lit(0)]).alias("_row")


def unboxed(columns: list[str]) -> list[Column]:
    return [F.col("_row").getField(c).alias(c) for c in columns]


def stored(df: DataFrame, purpose: str) -> DataFrame:
    """Write ``df`` once below the shared folder and read it back, so that later steps neither recompute it nor depend on executors."""
    spark = df.sparkSession
    path = f"{shared_folder(spark)}/{purpose}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)
