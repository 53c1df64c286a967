"""Score requests in batch or as they arrive."""

from __future__ import annotations

from datetime import UTC, datetime

from pyspark import StorageLevel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tidemark.plans.modeling import MODEL_FEATURES, MODEL_NAME, MODEL_VIEW, score
from tidemark.plans.store import FeatureStore
from tidemark.sources.models import ModelVersion
from tidemark.sources.online import Published, read_features


def score_requests(
    requests: DataFrame,
    published: DataFrame | Published,
    champion: ModelVersion,
    predicted_at: datetime,
) -> tuple[DataFrame, DataFrame]:
    """Predictions for requests (`entity_id` and more) of published entities, and the rejects.

    The features come from the published rows, exactly as the model will be logged to have seen
    them; a feature without a value stays null and the model fills it. An entity with nothing
    published is not scored.
    """
    looked_up = read_features(requests, published, MODEL_FEATURES)
    rejected = looked_up.where(~F.col("found")).select(*requests.columns)
    scored = score(champion.pipeline(), looked_up.where("found"))
    seen = F.map_from_arrays(
        F.array(*[F.lit(name) for name in MODEL_FEATURES]), F.array(*MODEL_FEATURES)
    )
    predictions = scored.select(
        *requests.columns,
        F.lit(MODEL_NAME).alias("model_name"),
        F.lit(champion.version).alias("model_version"),
        F.lit(predicted_at).alias("predicted_at"),
        F.col("score").alias("probability"),
        seen.alias("features"),
        "features_as_of",
    )
    return predictions, rejected


def score_and_log(
    store: FeatureStore,
    requests: DataFrame,
    job: str,
    batch: int,
    predicted_at: datetime | None = None,
) -> None:
    """Score a batch with the champion and the rows published now; log predictions and rejects."""
    champion = store.models.champion(MODEL_NAME)
    if champion is None:
        raise LookupError("there is no champion model yet")
    # A batch of a few requests reads the buckets they are in
    published = store.online.published(MODEL_VIEW) or store.online.read(MODEL_VIEW)
    now = predicted_at or datetime.now(UTC)
    # Looked through for hot entities, scored and searched for rejects: read the source once
    requests = requests.persist(StorageLevel.MEMORY_AND_DISK)
    try:
        predictions, rejected = score_requests(requests, published, champion, now)
        store.predictions.write(predictions, job, batch)
        rejected.write.mode("overwrite").option("partitionOverwriteMode", "static").parquet(
            f"{store.root}/rejected/job={job}/batch={batch}"
        )
    finally:
        requests.unpersist()


def score_stream(
    store: FeatureStore, requests: DataFrame, job: str, checkpoint: str, **trigger
) -> StreamingQuery:
    """Score a stream of requests, `trigger` as for `DataStreamWriter.trigger`.

    Each micro-batch looks up the champion and the published rows anew, so a publication or a
    promotion takes effect with the next batch. A replayed batch replaces its own log folder, so
    every request is logged once.
    """

    def each_batch(batch: DataFrame, batch_id: int) -> None:
        score_and_log(store, batch, job, batch_id)

    writer = requests.writeStream.foreachBatch(each_batch).option("checkpointLocation", checkpoint)
    return writer.trigger(**(trigger or {"availableNow": True})).start()
