"""The day loop as a stream: new RAW day folders -> CLEAN day folders.

The original runs its cleaning step once per day file.  Here a file stream
watches the RAW stage (parquet partitioned by ``ds``) and, for every
micro-batch, recomputes the days that received files – from the whole day
in the stage, so a day split across batches is still processed in full –
and overwrites just those CLEAN partitions (dynamic partition overwrite).
Re-running a batch after a failure rewrites the same partitions, so the
sink is idempotent; the stream's own progress lives in its checkpoint.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from itemwise.plans.prepare import prepare_day_items
from itemwise.sources.files import read_stage, write_stage


def process_days(spark: SparkSession, raw_stage: str, clean_stage: str, days: list[str],
                 category_feature: DataFrame, rule: str = "a") -> None:
    raw = read_stage(spark, raw_stage).where(F.col("ds").isin(days))
    # Read once, by the write to the sink: not staged before.
    write_stage(prepare_day_items(raw, category_feature, rule=rule, stage_clean=False), clean_stage)


def run_daily_clean(spark: SparkSession, raw_stage: str, clean_stage: str,
                    category_feature: DataFrame, checkpoint: str, rule: str = "a",
                    available_now: bool = True):
    """Start (and, with ``available_now``, drain) the RAW -> CLEAN stream."""
    schema = read_stage(spark, raw_stage).schema

    def batch(df: DataFrame, epoch: int) -> None:
        days = sorted(r[0] for r in df.select("ds").distinct().collect())
        if days:
            process_days(spark, raw_stage, clean_stage, days, category_feature, rule)

    # A batch only says which days received files; their rows are read from the stage.
    stream = spark.readStream.schema(schema).parquet(raw_stage).select("ds")
    writer = stream.writeStream.foreachBatch(batch).option("checkpointLocation", checkpoint)
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(
        processingTime="1 minute")
    q = writer.start()
    if available_now:
        q.awaitTermination()
    return q
