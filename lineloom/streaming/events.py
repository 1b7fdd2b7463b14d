"""Job events as a stream: duplicates dropped, each job's state moved by its events, snapshots written."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from ..operators.jobs import FOLLOWS, allowed
from ..ship import ship

#: How long the state of a job that is done is kept.
FORGET_MS = 24 * 3600 * 1000
SCHEMA = "event_id string, event_type string, job_id string, source_service string, timestamp timestamp, data string"
#: The status that an event asks for.
ASKS = {
    "ENTRY_DISCOVERED": "Ingesting",
    "DETECTION_COMPLETED": "Parsing",
    "PARSING_COMPLETED": "Merging Output",
    "LOADING_COMPLETED": "Reporting",
    "REPORTING_COMPLETED": "Completed",
    "JOB_FAILED": "Failed",
}


def read_events(spark: SparkSession, path: str, files_per_trigger: int = 100) -> DataFrame:
    return spark.readStream.schema(SCHEMA).option("maxFilesPerTrigger", files_per_trigger).json(path)


def asked(events: DataFrame) -> DataFrame:
    """Events with the status they ask for: data.status if it is given, else by type."""
    by_type = F.create_map(*[F.lit(x) for pair in ASKS.items() for x in pair])
    return events.withColumn("status", F.coalesce(F.get_json_object("data", "$.status"), by_type[F.col("event_type")]))


def _advance(key: tuple, frames: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
    if state.hasTimedOut:
        state.remove()
        return
    status, applied, ignored = state.get if state.exists else ("Created", 0, 0)
    rows = pd.concat(list(frames)).sort_values(["timestamp", "event_id"])
    for new in rows["status"]:
        if isinstance(new, str) and allowed(status, new):
            status, applied = new, applied + 1
        else:
            ignored += 1
    state.update((status, applied, ignored))
    if not FOLLOWS[status]:  # a job that is done is forgotten some time after its last event
        last = int(rows["timestamp"].max().timestamp() * 1000)
        state.setTimeoutTimestamp(max(last, state.getCurrentWatermarkMs()) + FORGET_MS)
    yield pd.DataFrame({"job_id": [key[0]], "status": [status], "applied": [applied], "ignored": [ignored]})


def job_states(events: DataFrame, late: str = "10 minutes") -> DataFrame:
    """The state of each job that has new events, after them. Jobs that are done leave no state behind: it goes FORGET_MS after their last
    event; nothing may follow a final state, and duplicates of older events are below the watermark by then."""
    ship(events.sparkSession)
    once = asked(events).withWatermark("timestamp", late).dropDuplicatesWithinWatermark(["event_id"])
    shape = "job_id string, status string, applied long, ignored long"
    return once.groupBy("job_id").applyInPandasWithState(_advance, shape, "status string, applied long, ignored long", "update", GroupStateTimeout.EventTimeTimeout)


def write_snapshots(states: DataFrame, path: str, checkpoint: str):
    """Appends each trigger's states; the latest per job counts. Exactly once: a trigger's rows carry its number."""

    def save(df: DataFrame, epoch: int) -> None:
        df.write.mode("overwrite").parquet(f"{path}/epoch={epoch}")

    return states.writeStream.outputMode("update").foreachBatch(save).option("checkpointLocation", checkpoint)
