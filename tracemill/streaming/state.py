"""Streaming ingest whose memory of an id is state: the digest of its first content, in RocksDB, without a watermark.

Ids share BUCKETS by hash. What a batch adds to a bucket is one entry of its list, or a few: ids and digests side by side, read
and added to at once, as calls of the state store and entries of their own took most of the time. So a batch costs what is in
it, and of what was taken before only the digests of the buckets it falls into; a store of n ids has n / BUCKETS in one. Rows
are shuffled as they are; their JSON is made, and digests are, where they arrive. The rows of an id are sorted by nothing and
held by content, so an id that repeats very often is a few rows. What is kept,
repeated or in conflict goes to one table by status, whose files a restart neither loses nor doubles.
"""

from __future__ import annotations

import json
from collections.abc import Iterator
from hashlib import sha256

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StatefulProcessor

ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
APPENDED, DUPLICATE, CONFLICT, BLANK = "APPENDED", "DUPLICATE", "CONFLICT", "BLANK_EVENT_ID"

#: Lists of ids that the state is kept in, and ids of one entry; a store keeps the number of lists it began with.
BUCKETS, ENTRY = 1 << 12, 1 << 14

_TOLD = ["id", "status", "content", "n"]


class FirstContent(StatefulProcessor):
    """Keeps the first content of each id of a bucket. Of the contents of one batch the one of least place, then digest, is first."""

    def init(self, handle) -> None:
        self.kept = handle.getListState("kept", "ids string, digests binary")

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        seen: dict[str | None, dict[str, list]] = {}
        for frame in rows:
            # Frames hold null as NaN where a column has numbers; a null place comes first, as in an ORDER BY of Spark.
            ids, places = frame["id"].astype(object), zip(frame["place"].notna(), frame["place"].where(frame["place"].notna(), 0))
            for id_, content, place in zip(ids.where(ids.notna(), None), frame["content"], places):
                x = seen.setdefault(id_, {}).setdefault(content, [place, 0])
                x[0] = min(x[0], place)
                x[1] += 1
        known, new, told = {}, {}, []
        for ids, digests in self.kept.get():
            known.update((i, bytes(digests[32 * k : 32 * k + 32])) for k, i in enumerate(json.loads(ids)) if i in seen)
        for id_, contents in seen.items():
            found = [(place, sha256(content.encode()).digest(), content, n) for content, (place, n) in contents.items()]
            if id_ is None:
                told += [(None, BLANK, content, n) for _, _, content, n in found]
                continue
            old = known.get(id_)
            if old is None:
                _, old, content, n = min(found)
                new[id_] = old
                told.append((id_, APPENDED, content, 1))
                found = [(p, d, c, k - (d == old)) for p, d, c, k in found]
            told += [(id_, DUPLICATE if digest == old else CONFLICT, content, n) for _, digest, content, n in found if n]
        ids = list(new)
        entries = [ids[k : k + ENTRY] for k in range(0, len(ids), ENTRY)]
        if entries:
            self.kept.appendList([(json.dumps(some), b"".join(new[i] for i in some)) for some in entries])
        for k in range(0, len(told), ENTRY):
            yield pd.DataFrame(told[k : k + ENTRY], columns=_TOLD)

    def close(self) -> None:
        pass


def classified(source: DataFrame, key: str, place: Column) -> DataFrame:
    """A stream of id, status, content (JSON of the row) and n of a stream of rows: a row for each content of an id in
    a batch, and one for what was appended. place is what sorts the contents that an id has in one batch."""
    content = F.to_json(F.struct(*[F.col(c) for c in source.columns if c != key]), {"ignoreNullFields": "false"})
    id_ = F.col(key).cast("string")
    dealt = source.withColumn("_bucket", F.pmod(F.xxhash64(id_), F.lit(BUCKETS)).cast("int")).repartition("_bucket")
    rows = dealt.select("_bucket", id_.alias("id"), content.alias("content"), place.alias("place"))
    return rows.groupBy("_bucket").transformWithStateInPandas(FirstContent(), "id string, status string, content string, n long", "append", "none")


def ingest(source: DataFrame, store: str, key: str, place: Column):
    """Takes what there is of a streaming source into store, by status; returns the query. Run again, it goes on where it ended."""
    source.sparkSession.conf.set("spark.sql.streaming.stateStore.providerClass", ROCKSDB)
    found = classified(source, key, place)
    return found.writeStream.format("parquet").option("compression", "zstd").partitionBy("status").option("path", f"{store}/rows").option("checkpointLocation", f"{store}/progress").outputMode("append").trigger(availableNow=True).start()


def read(spark: SparkSession, store: str, schema: T.StructType, *statuses: str) -> DataFrame:
    """The contents of a store with these statuses (all, if none is named): id, status, digest, n, and row (of schema, without the id)."""
    rows = spark.read.parquet(f"{store}/rows")
    rows = rows.filter(F.col("status").isin(*statuses)) if statuses else rows
    return rows.select("id", "status", F.sha2("content", 256).alias("digest"), "n", F.from_json("content", schema).alias("row"))
