"""Continuous scoring with Structured Streaming.

Scoring is stateless: no watermark, no state store, append mode. A request list becomes a
micro-batch; its portfolio metrics are written under the batch id, so a replayed batch
overwrites its own result.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from lendmill.operators.portfolio import portfolio_flat
from lendmill.plans.scoring import score_with_rejects

Scorer = Callable[[DataFrame], DataFrame]


def score_stream(requests: DataFrame, scorer: Scorer, out_path: str, checkpoint: str,
                 available_now: bool = False, interval: str = "10 seconds") -> StreamingQuery:
    """Append the assessment of every valid request to a Parquet table."""
    writer = (scorer(requests).writeStream.format("parquet").outputMode("append")
              .option("path", out_path).option("checkpointLocation", checkpoint))
    trigger = {"availableNow": True} if available_now else {"processingTime": interval}
    return writer.trigger(**trigger).start()


def score_stream_with_rejects(requests: DataFrame, scorer: Scorer, out_path: str,
                              rejects_path: str, checkpoint: str, available_now: bool = False,
                              interval: str = "10 seconds") -> StreamingQuery:
    """As ``score_stream``, and the rejected requests of every micro-batch with their reasons.
    Both go to a folder named after the batch, so a replayed batch overwrites itself."""
    def write(batch: DataFrame, batch_id: int) -> None:
        assessed, rejected = score_with_rejects(batch, scorer)
        assessed.write.mode("overwrite").parquet(f"{out_path}/batch={batch_id}")
        rejected.write.mode("overwrite").parquet(f"{rejects_path}/batch={batch_id}")

    trigger = {"availableNow": True} if available_now else {"processingTime": interval}
    return (requests.writeStream.foreachBatch(write)
            .option("checkpointLocation", checkpoint).trigger(**trigger).start())


def portfolio_stream(requests: DataFrame, scorer: Scorer, out_path: str, checkpoint: str,
                     available_now: bool = False, interval: str = "10 seconds",
                     by: list[str] = ()) -> StreamingQuery:
    """Portfolio metrics per micro-batch, one folder per batch id."""
    def write(batch: DataFrame, batch_id: int) -> None:
        metrics = portfolio_flat(scorer(batch), list(by))
        (metrics.withColumn("batch_id", F.lit(batch_id).cast("long"))
         .write.mode("overwrite").parquet(f"{out_path}/batch={batch_id}"))

    trigger = {"availableNow": True} if available_now else {"processingTime": interval}
    return (requests.writeStream.foreachBatch(write)
            .option("checkpointLocation", checkpoint).trigger(**trigger).start())


def read_portfolio(spark, out_path: str) -> DataFrame:
    return spark.read.option("basePath", out_path).parquet(f"{out_path}/batch=*").drop("batch")
