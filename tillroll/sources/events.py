"""The event table as a table and as a stream, and the calendar of the orders beside it."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tillroll.sources.staging import new_folder

# The columns read. A stream has to name them, and for a table it spares a job.
EVENTS = (
    "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, "
    "value double, props string"
)
# The order tables begin years before the events, so that a join on time would
# find nothing. A day of theirs becomes twelve minutes of the month of the events.
ORDERS_BEGIN = "1995-01-01"
EVENTS_BEGIN = "2024-01-01"
MINUTES_A_DAY = 12


def read_events(spark: SparkSession, folder: str) -> DataFrame:
    return spark.read.schema(EVENTS).parquet(f"{folder.rstrip('/')}/events.parquet")


def in_event_time(date: Column) -> Column:
    """A date of the order tables as a moment among the events."""
    days = F.date_diff(date, F.lit(ORDERS_BEGIN).cast("date"))
    start = F.lit(EVENTS_BEGIN).cast("timestamp_ntz")
    return F.timestamp_add("MINUTE", days * F.lit(MINUTES_A_DAY), start)


def as_runs(rows: DataFrame, run: Column):
    """A stream over ``rows`` that receives them run by run, in the order of ``run``.

    Returns the stream and a generator. Each step of the generator puts the files of the next
    run into the folder of the stream, as many files as there are tasks, and yields the run.
    """
    spark = rows.sparkSession
    held = new_folder(spark, "arrivals")
    rows.withColumn("_run", run).write.partitionBy("_run").parquet(held)
    arrivals = spark.read.schema(f"{_ddl(rows)}, _run bigint").parquet(held)
    inbox = new_folder(spark, "inbox")
    arrivals.drop("_run").limit(0).write.parquet(inbox)  # a stream needs its folder

    def deliver():
        # A value for each run; runs are periods of the calendar.
        numbers = [r[0] for r in arrivals.select("_run").distinct().orderBy("_run").collect()]
        for number in numbers:
            due = arrivals.where(F.col("_run").eqNullSafe(F.lit(number))).drop("_run")
            due.write.mode("append").parquet(inbox)
            yield number

    return spark.readStream.schema(rows.schema).parquet(inbox), deliver()


def _ddl(rows: DataFrame) -> str:
    return ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema)
