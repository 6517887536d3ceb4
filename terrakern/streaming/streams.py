"""Structured Streaming forms: replay-tolerant tail, tumbling bins, sustained alerts, guarded append."""

from __future__ import annotations

from collections.abc import Iterator
from typing import Any

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.query import StreamingQuery


def deduplicated_tail(stream: DataFrame, id_col: str, ts: str, delay: str = "2 minutes") -> DataFrame:
    """Each id once, within the watermark: a tail that rereads its last minutes."""
    return stream.withWatermark(ts, delay).dropDuplicatesWithinWatermark([id_col])


def binned(stream: DataFrame, ts: str, width: str, delay: str, by: list[str]) -> DataFrame:
    """Tumbling counts per bin, emitted once the watermark has passed the bin."""
    return stream.withWatermark(ts, delay).groupBy(F.window(ts, width).alias("w"), *by).agg(F.count("*").alias("n")).select(F.col("w.start").alias("bin"), *by, "n")


def sustained_alerts(stream: DataFrame, by: str, value: str, order: str, at_least: float, last: int) -> DataFrame:
    """Rows (by, order) at which the last ``last`` values of a key all reach the threshold.

    State: the key's last ``last - 1`` values.  Rows of a micro-batch are ordered by
    ``order`` within their key.
    """

    def update(key: tuple, batches: Iterator[pd.DataFrame], state: Any) -> Iterator[pd.DataFrame]:
        tail = list(state.get[0]) if state.exists else []
        rows = pd.concat(list(batches)).sort_values(order)
        hits = []
        for at, v in zip(rows[order], rows[value], strict=True):
            tail = [*tail[-(last - 1) :], float(v)] if last > 1 else [float(v)]
            if len(tail) == last and min(tail) >= at_least:
                hits.append((key[0], at))
        state.update((tail[-(last - 1) :] if last > 1 else [],))
        yield pd.DataFrame(hits, columns=[by, order])

    kinds = {f.name: f.dataType.simpleString() for f in stream.schema}
    out = f"{by} {kinds[by]}, {order} {kinds[order]}"
    return stream.groupBy(by).applyInPandasWithState(update, out, "tail array<double>", "append", "NoTimeout")


def guarded_append(stream: DataFrame, day: str, target: str, rejected: str, checkpoint: str, key: list[str] | None = None) -> StreamingQuery:
    """Append each batch's days that are newer than all stored; the rest, null days too, goes to ``rejected`` and is not lost.

    Of rows with one ``key`` in a batch, one is appended.  A batch writes into folders of its own number, so a replayed
    batch overwrites itself.
    """

    def write(batch: DataFrame, number: int) -> None:
        newest = _newest(batch.sparkSession, target, day, number)
        fresh = F.col(day).isNotNull() if newest is None else F.coalesce(F.col(day) > F.lit(newest), F.lit(False))
        appended = batch.filter(fresh)
        (appended.dropDuplicates(key) if key else appended).write.mode("overwrite").parquet(f"{target}/batch={number}")
        batch.filter(~fresh).write.mode("overwrite").parquet(f"{rejected}/batch={number}")

    return stream.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def latest_bins(stream: DataFrame, ts: str, width: str, delay: str, by: list[str], folder: str) -> DataFrame:
    """Tumbling counts with the open bins too: every batch writes the bins it changed, the newest count of a bin holds."""
    changed = binned(stream, ts, width, delay, by)

    def write(batch: DataFrame, number: int) -> None:
        batch.write.mode("overwrite").parquet(f"{folder}/bins/batch={number}")

    query = changed.writeStream.outputMode("update").foreachBatch(write).option("checkpointLocation", f"{folder}/bins-state").trigger(availableNow=True).start()
    query.awaitTermination()
    found = changed.sparkSession.read.schema(changed.schema.simpleString()[7:-1].replace(":", " ") + ", batch int").parquet(f"{folder}/bins")
    return found.groupBy("bin", *by).agg(F.max_by("n", "batch").alias("n"))


def _newest(spark: SparkSession, target: str, day: str, number: int):
    try:
        return spark.read.parquet(target).filter(F.col("batch") < number).agg(F.max(day)).first()[0]
    except Exception as e:
        if "PATH_NOT_FOUND" not in str(e) and "UNABLE_TO_INFER_SCHEMA" not in str(e):
            raise
        return None


def drained(frame: DataFrame, folder: str, name: str, mode: str = "append") -> DataFrame:
    """Run a streaming frame over what is there and return its rows from ``folder``."""
    query = frame.writeStream.outputMode(mode).format("parquet").option("path", f"{folder}/{name}").option("checkpointLocation", f"{folder}/{name}-state").trigger(availableNow=True).start()
    query.awaitTermination()
    return frame.sparkSession.read.schema(frame.schema).parquet(f"{folder}/{name}")
