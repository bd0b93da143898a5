"""A growing landing folder feeding the line fact (L10 as a stream)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tallyhouse.operators.lines import revenue_lines, stage_lines
from tallyhouse.schemas import RAW_SCHEMA
from tallyhouse.sources.upsert import read_line_fact, upsert_invoice_lines


def load_new_files(
    spark: SparkSession,
    landing_folder: str,
    target: str,
    checkpoint: str,
    lookback_days: int = 0,
) -> DataFrame:
    """Load the files that arrived since the last call and stop; returns the line fact.

    All new files form one batch: the date boundary is strict, so splitting one
    delivery into several batches would cut off lines of its last day. A batch is the
    load of its number: when the stream repeats one that broke off, it replaces what that
    had written.
    """

    def load(batch: DataFrame, batch_id: int) -> None:
        upsert_invoice_lines(
            revenue_lines(stage_lines(batch)),
            target,
            lookback_days=lookback_days,
            load=batch_id,
        )

    query = (
        spark.readStream.schema(RAW_SCHEMA)
        .parquet(landing_folder)
        .writeStream.foreachBatch(load)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    return read_line_fact(spark, target)
