"""The container energy dataset as a join of two streams.

Both streams carry processed rows (one per scrape) and a watermark.  Kepler joules are summed per
(event-time window, container, namespace, pod); a sum is final once the watermark passes the
window, and is then joined to the k8s rows of the same window and keys.  Equal windows bound
both sides in event time, so rows and sums are dropped from the state when the watermark has
passed their window: the state holds the rows of about ``watermark + interval`` of telemetry,
however long the stream runs.  Rows later than the watermark are left out; within it, the
result equals the batch dataset over the same rows, for all windows that are closed.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from wattspark.plans.datasets import energy_features
from wattspark.schemas import ENERGY_JOIN_KEYS, ENERGY_K8S_COLUMNS

ENTITY = [k for k in ENERGY_JOIN_KEYS if k != "_time"]
JOULES = "kepler_container_joules_total"


def stream_energy_dataset(k8s_wide: DataFrame, kepler_wide: DataFrame, interval: str = "1 minute",
                          watermark: str = "10 minutes") -> DataFrame:
    """Energy dataset of two streams of processed rows (works on batch tables too)."""
    def timed(df: DataFrame) -> DataFrame:
        out = df.withColumn("_time", F.col("_time").cast(T.TimestampType()))
        return out.withWatermark("_time", watermark) if out.isStreaming else out

    k8s = timed(k8s_wide.select(*ENERGY_K8S_COLUMNS).na.drop("any"))
    k8s = k8s.withColumn("w", F.window("_time", interval)).drop("_time")
    complete = F.lit(True)
    for key in ENTITY:
        complete = complete & F.col(key).isNotNull()
    energy = (timed(kepler_wide.select("_time", *ENTITY, JOULES)).filter(complete)
              .groupBy(F.window("_time", interval).alias("w"), *ENTITY)
              .agg(F.coalesce(F.sum(JOULES), F.lit(0.0)).alias(JOULES)))
    joined = k8s.join(energy, ["w", *ENTITY])
    return energy_features(joined.withColumn("_time", F.col("w.start")))
