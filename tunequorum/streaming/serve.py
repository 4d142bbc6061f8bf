"""Requests as a stream of JSON files: each id is answered once over all batches, everything else is rejected with a reason."""

from __future__ import annotations

import time
from collections.abc import Callable, Iterator, Sequence

import pandas as pd
from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from tunequorum.operators.requests import MODELS, prediction_history, route, validate_requests
from tunequorum.runtime import durable
from tunequorum.schemas import REQUESTS
from tunequorum.sources.sinks import write_history_batch

REPEATED = "repeated request_id"
EMPTY_BATCHES = "spark.sql.streaming.noDataMicroBatches.enabled"


def judged_requests(requests: DataFrame, days: float = 7) -> DataFrame:
    """A stream of requests with ``reason``: null for those to answer.

    The first valid request of an id passes, later ones are rejected as repeated. An id is remembered, over batches and
    restarts, until it has not come for ``days``; the state is one flag for each id of that time. Which of several in one
    batch passes depends on their content, not on their order. Invalid requests are spread by their content and
    leave nothing behind.
    """
    checked = validate_requests(requests.select(*REQUESTS.names))
    payload = F.to_json(F.struct(*REQUESTS.names))
    valid = F.col("reason").isNull()
    key = F.when(valid, F.concat(F.lit("id "), F.col("request_id").cast("string"))).otherwise(F.concat(F.lit("rejected "), F.md5(payload)))
    milliseconds = int(days * 24 * 3600 * 1000)

    def judge(key: tuple, frames: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        if state.hasTimedOut:
            state.remove()
            return
        rows = sorted((payload, None if pd.isna(reason) else reason) for frame in frames for payload, reason in zip(frame["payload"], frame["reason"]))
        first = 0 if state.exists else 1
        reasons = [reason or (None if k < first else REPEATED) for k, (_, reason) in enumerate(rows)]
        if key[0].startswith("id "):
            state.update((True,))
            state.setTimeoutDuration(milliseconds)
        yield pd.DataFrame({"payload": [p for p, _ in rows], "reason": pd.Series(reasons, dtype=object)})

    keyed = checked.select(key.alias("key"), payload.alias("payload"), "reason")
    judged = keyed.groupBy("key").applyInPandasWithState(judge, "payload string, reason string", "answered boolean", "append", GroupStateTimeout.ProcessingTimeTimeout)
    return judged.select(F.from_json("payload", REQUESTS).alias("r"), "reason").select("r.*", "reason")


def serve_stream(
    spark: SparkSession, requests_dir: str, history_dir: str, checkpoint_dir: str,
    answer: Callable[[DataFrame], DataFrame], routing: str = "ab", max_files: int = 100,
    rejected_dir: str | None = None, remember_days: float = 7, models: Sequence[str] = MODELS,
) -> StreamingQuery:
    """Answer all request files that are present, then stop.

    ``answer`` maps a batch of routed requests (they carry their ``model``, the same that is logged) to playlists
    (request_id, position, track_id), for example ``answer_requests`` with its tables bound. An id is answered once in
    ``remember_days``, over batches and restarts. Rejected requests go to ``rejected_dir`` with their reason. Both outputs
    have a folder for each batch, which a repeated batch overwrites with the same content. ``elapsed_time`` is what the
    batch's recommendation took.
    """
    def handle(batch: DataFrame, batch_id: int) -> None:
        judged = durable(batch)
        valid = judged.where(F.col("reason").isNull()).drop("reason").withColumn("timestamp", F.current_timestamp())
        requests = durable(route(valid, routing, models))
        started = time.monotonic()
        playlists = durable(answer(requests))
        elapsed = time.monotonic() - started
        write_history_batch(prediction_history(requests, playlists, elapsed), history_dir, batch_id)
        if rejected_dir:
            write_history_batch(judged.where(F.col("reason").isNotNull()), rejected_dir, batch_id)

    requests = spark.readStream.schema(REQUESTS).option("maxFilesPerTrigger", max_files).json(requests_dir)
    writer = (
        judged_requests(requests, remember_days).writeStream.foreachBatch(handle)
        .option("checkpointLocation", checkpoint_dir)
        .trigger(availableNow=True)
    )
    # state that times out would ask for one empty batch after the other, and the query would never stop
    before = spark.conf.get(EMPTY_BATCHES, None)
    spark.conf.set(EMPTY_BATCHES, "false")
    try:
        return writer.start()  # keeps the setting as it is now
    finally:
        spark.conf.unset(EMPTY_BATCHES) if before is None else spark.conf.set(EMPTY_BATCHES, before)
