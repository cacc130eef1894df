"""Running sums and maxima over the rows of a key, in chunks, so a hot key is many tasks."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Places of a key that one window sorts.
CHUNK = 1 << 14


def running(rows: DataFrame, key: str, place: str, sums: dict[str, Column] | None = None, maxima: dict[str, Column] | None = None) -> DataFrame:
    """Adds sums and maxima over the rows of the same key up to and with each, by place (whole numbers, none twice in a key).

    Each chunk of places is summed by itself; what comes before it is added from one row a chunk. rows is read twice,
    so it should be a written table. A sum counts null as 0; a maximum before the first value is null.
    """
    sums, maxima = sums or {}, maxima or {}
    # Keys lie in a struct, so null is a key as others are and what a window deals out by key and chunk is joined where it lies.
    own = rows.withColumns({"_key": F.struct(key), "_chunk": F.floor(F.col(place) / CHUNK)})
    total = [F.sum(F.coalesce(c, F.lit(0))).alias(f"_{n}") for n, c in sums.items()] + [F.max(c).alias(f"_{n}") for n, c in maxima.items()]
    before = Window.partitionBy("_key").orderBy("_chunk").rowsBetween(Window.unboundedPreceding, -1)
    chunks = own.groupBy("_key", "_chunk").agg(*total).select(
        F.col("_key").alias("_of"), F.col("_chunk").alias("_at"), *[F.sum(f"_{n}").over(before).alias(f"_{n}") for n in sums], *[F.max(f"_{n}").over(before).alias(f"_{n}") for n in maxima]
    )
    upto = Window.partitionBy("_key", "_chunk").orderBy(place).rowsBetween(Window.unboundedPreceding, 0)
    local = own.select("*", *[F.sum(F.coalesce(c, F.lit(0))).over(upto).alias(n) for n, c in sums.items()], *[F.max(c).over(upto).alias(n) for n, c in maxima.items()])
    joined = local.join(chunks, (local["_key"] == chunks["_of"]) & (local["_chunk"] == chunks["_at"]))
    found = {n: F.col(n) + F.coalesce(F.col(f"_{n}"), F.lit(0)) for n in sums} | {n: F.greatest(n, f"_{n}") for n in maxima}
    return joined.withColumns(found).select(*rows.columns, *found)
