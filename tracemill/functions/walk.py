"""JSON values walked to any depth, as rows: level by level until nothing nests."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..sources.scratch import settle

_NESTED = r"^(OBJECT|ARRAY)"


def nests() -> Column:
    return F.schema_of_variant("value").rlike(_NESTED)


def _path(path: Column, key: Column, pos: Column) -> Column:
    plain = key.rlike("^[A-Za-z_][A-Za-z_0-9]*$")
    quoted = F.concat(F.lit("['"), F.replace(key, F.lit("'"), F.lit("\\'")), F.lit("']"))
    return F.concat(path, F.when(key.isNull(), F.concat(F.lit("["), pos.cast("string"), F.lit("]"))).when(plain, F.concat(F.lit("."), key)).otherwise(quoted))


def walk(rows: DataFrame, value: str, kept: Column | None = None) -> DataFrame:
    """Every value below (and with) the variant column `value`: the other columns, path, place, key, value.

    place is the positions on the way, so its order is that of a document whose objects list their keys sorted
    (as variants keep them); key is null in arrays and at the top. Each level is written before the next, which is as many rows as it
    nests; a text that nests deeper than the JSON reader takes (1,000) is no variant and has no rows.

    kept, a condition on key and value, tells what is looked for or may hold it: of others neither they nor what is
    below them has rows.
    """
    rest = [c for c in rows.columns if c != value]
    # Exploded, a value is worked out once a row, not again for each filter on it.
    level = rows.select(*rest, F.lit("$").alias("path"), F.array().cast("array<int>").alias("place"), F.lit(None).cast("string").alias("key"), F.explode(F.array(value)).alias("value")).filter("value is not null")
    may = lambda level: level if kept is None else level.filter(kept)
    level = found = settle(may(level), "walk")
    while True:
        nested = level.filter(nests())
        down = nested.lateralJoin(rows.sparkSession.tvf.variant_explode(F.col("value").outer()).select(F.col("pos").alias("_pos"), F.col("key").alias("_key"), F.col("value").alias("_value")))
        level = settle(may(down.select(*rest, _path(F.col("path"), F.col("_key"), F.col("_pos")).alias("path"), F.concat("place", F.array("_pos")).alias("place"), F.col("_key").alias("key"), F.col("_value").alias("value"))), "walk")
        if level.isEmpty():
            return found
        found = found.unionByName(level)


def keys_at(rows: DataFrame, value: str, keys: frozenset[str]) -> DataFrame:
    """Where keys are, whatever their case and dashes, at any depth: the other columns and path."""
    plain = lambda text: F.replace(F.lower(text), F.lit("-"), F.lit("_"))
    wanted = F.coalesce(plain(F.col("key")).isin(*sorted(keys)), F.lit(False))
    # A text of JSON names every key at any depth as it is, so what doesn't name one needs no walk.
    holds = nests() & plain(F.to_json("value")).rlike(f'"({"|".join(map(re.escape, sorted(keys)))})":')
    return walk(rows, value, wanted | holds).filter(wanted).drop("value", "key", "place")
