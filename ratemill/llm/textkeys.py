"""Keys of rows whose id may be null or repeated."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Stands for a null id among ids as text.
NO_ID = "\0"


def id_text(id_col: Column) -> Column:
    return F.coalesce(id_col.cast("string"), F.lit(NO_ID))


def id_back(text: Column, id_type: str) -> Column:
    return F.when(text != NO_ID, text).cast(id_type)


def text_key(text: Column) -> Column:
    """Two numbers that stand for the whole text; rows of one id and text share every result."""
    whole = F.coalesce(text, F.lit(""))
    return F.struct(F.xxhash64(whole).alias("h"), F.octet_length(whole).alias("n"))
