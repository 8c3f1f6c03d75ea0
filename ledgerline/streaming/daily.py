"""Run a daily check when data lands, with Structured Streaming.

The checks are defined per day (all records of a day against the counterpart around that day),
so a newly landed file cannot be checked on its own, and a day's result changes when either of
its inputs lands. The stream watches the files of every input; each micro-batch only tells which
data days received files (a distinct over one column, a handful of dates), each input maps them to
the check days they affect (the same day for the source; for the key-level check a counterpart
day also affects the days either side), and those days are re-checked in full from the tables
with their result slices replaced. Replacing slices (dynamic partition overwrite) makes a retried
micro-batch harmless: the table ends up the same as after a single run.

``trigger(availableNow=True)`` processes whatever has landed and stops, which fits a daily batch
environment; with a processing-time trigger the same query keeps running.
"""

from __future__ import annotations

import datetime as _dt
from collections.abc import Callable, Iterable, Sequence
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import ensure_checkpoint_dir
from ..sources.sinks import replace_slices

DayCheck = Callable[[_dt.date], DataFrame]


def same_day(d: _dt.date) -> Iterable[_dt.date]:
    return (d,)


def day_and_neighbours(d: _dt.date) -> Iterable[_dt.date]:
    """A counterpart day matters to the checks of the day before, the day and the day after."""
    one = _dt.timedelta(days=1)
    return (d - one, d, d + one)


@dataclass(frozen=True)
class Watched:
    """One input to watch: parquet files under ``path`` with ``schema``; ``affects`` maps a data day
    (``date_col``) to the check days it changes."""
    path: str
    schema: object
    date_col: str = "eventDate"
    affects: Callable[[_dt.date], Iterable[_dt.date]] = field(default=same_day)


def default_checkpoint_location(spark: SparkSession, name: str) -> str:
    """A stream checkpoint under the shared folder the session names in ``spark.checkpoint.dir``."""
    base = ensure_checkpoint_dir(spark)
    return f"{base.rstrip('/')}/streams/{name}"


def recheck_landed_days(spark: SparkSession, source_path: str | None = None, source_schema=None,
                        check: DayCheck | None = None, result_path: str | None = None, *,
                        watch: Sequence[Watched] = (), name: str = "daily-check",
                        date_col: str = "eventDate", checkpoint_location: str | None = None,
                        partition_cols=("eventDate", "cpName"), once: bool = True,
                        slice_of: Callable[[_dt.date], dict] | None = None):
    """Start (and, with ``once``, finish) a stream over the parquet files of the watched inputs.

    ``source_path``/``source_schema`` is shorthand for one ``Watched`` input on ``date_col``;
    ``watch`` adds more (e.g. the counterpart with ``day_and_neighbours``). ``check(day)`` returns
    the result rows for one data day (e.g. a closure over ``checks.first_level_unmatched`` with
    ``as_of = day + lag``); they are written to ``result_path`` partitioned by ``partition_cols``.
    ``slice_of(day)`` names the result slice of a day (default: all of ``eventDate=day``; name the check too
    where several checks share a table); what a re-check leaves untouched of it is removed.
    Returns the streaming query."""
    slice_of = slice_of or (lambda day: {partition_cols[0]: day})
    inputs = list(watch)
    if source_path is not None:
        inputs.insert(0, Watched(source_path, source_schema, date_col))
    if not inputs or check is None or result_path is None:
        raise ValueError("need at least one watched input, a check and a result path")
    location = checkpoint_location or default_checkpoint_location(spark, name)
    affects = [w.affects for w in inputs]

    def on_batch(batch: DataFrame, epoch_id: int) -> None:
        days = set()
        for i, d in batch.select("_input", "_day").distinct().collect():
            if d is not None:
                days.update(affects[i](d))
        for day in sorted(days):
            replace_slices(check(day), result_path, [slice_of(day)], partition_cols)

    streams = [spark.readStream.schema(w.schema).parquet(w.path)
               .select(F.lit(i).alias("_input"), F.col(w.date_col).cast("date").alias("_day"))
               for i, w in enumerate(inputs)]
    stream = streams[0]
    for other in streams[1:]:
        stream = stream.unionByName(other)
    writer = stream.writeStream.foreachBatch(on_batch).option("checkpointLocation", location)
    writer = writer.trigger(availableNow=True) if once else writer.trigger(processingTime="1 minute")
    query = writer.queryName(name.replace("-", "_")).start()
    if once:
        query.awaitTermination()
    return query
