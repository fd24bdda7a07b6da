"""Structured Streaming ingest of wave files as they land.

A file-source stream over the landing folder discovers new CSV files; each
micro-batch (``foreachBatch``) then runs the batch operators over exactly
those files:

* header-grouped ingest + contract (``ingest_tagged``);
* clean rows merged into the respondent store by (wave, respondent_id), with
  the within-wave weight normalisation recomputed over each *whole* touched
  wave, because a batch may carry only part of a wave (``upsert_waves``);
* rejects into the same wave-partitioned side output as the batch runs, where
  they replace the files' earlier rejects if a batch is replayed;
* metrics refreshed from the stored metric state, which reads the touched waves only (``refresh_metrics``).

The batch's files are parsed once, into a staged copy that all steps read.
A key that comes twice in one batch is an error, as in every upsert.

Every step is idempotent per batch, so the at-least-once replay of
``foreachBatch`` after a failure leaves the same tables. The checkpoint
(default ``<output_dir>/_checkpoint``) makes a second run skip files it has
already seen. The discovery stream only lists files (a ``binaryFile``
stream that never selects the content), so each landing file is read once,
by the batch's CSV scan.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery

from trackframe.config import TrackerConfig
from trackframe.operators.contract import REJECT_REASON
from trackframe.plans.run import output_paths, upsert_waves
from trackframe.session import staged_copy
from trackframe.sources.ingest import SOURCE_FILE, ingest_tagged, staged_headers
from trackframe.sources.store import literal_path, replace_file_rows

# Files of one micro-batch unless the caller says otherwise.
MAX_FILES_PER_TRIGGER = 1000

# The fixed schema of the binaryFile source (streams must be given one).
BINARY_FILE_SCHEMA = "path string, modificationTime timestamp, length bigint, content binary"


def process_files(spark: SparkSession, paths: list[str], output_dir: str, config: TrackerConfig,
                  csv_options: dict | None = None, norms: str = "stored") -> None:
    """Apply one batch of newly landed wave files to the output tables."""
    resp_path, metrics_path, reject_path = output_paths(output_dir)
    literal = [literal_path(p) for p in paths]
    with staged_headers(spark, literal, pattern="") as headers:
        tagged = ingest_tagged(spark, literal, config, pattern="", keep_source=True, csv_options=csv_options, headers=headers)
        with staged_copy(tagged, "batch") as staged:
            is_clean = F.col(REJECT_REASON).isNull()
            upsert_waves(spark, staged.where(is_clean), resp_path, config, metrics_path=metrics_path, norms=norms)
            files = spark.createDataFrame([(p,) for p in paths], f"{SOURCE_FILE} string")
            replace_file_rows(spark, staged.where(~is_clean), reject_path, files, SOURCE_FILE)


def stream_waves(
    spark: SparkSession,
    input_glob: str,
    output_dir: str,
    config: TrackerConfig | None = None,
    *,
    checkpoint_location: str | None = None,
    max_files_per_trigger: int = MAX_FILES_PER_TRIGGER,
    available_now: bool = True,
    csv_options: dict | None = None,
    norms: str = "stored",
) -> StreamingQuery:
    """Start the landing-folder stream; ``input_glob`` selects the files (e.g. ``dir/*.csv``); ``norms`` as in ``run_tracker``."""
    config = config or TrackerConfig()
    # A binaryFile stream that selects only ``path`` lists new files without
    # reading their content; the batch then reads them once, as CSV.
    reader = spark.readStream.format("binaryFile").schema(BINARY_FILE_SCHEMA)
    files = reader.option("maxFilesPerTrigger", max_files_per_trigger).load(input_glob).select(F.col("path").alias("file_path"))

    def on_batch(batch: DataFrame, batch_id: int) -> None:
        # The distinct files of one micro-batch: bounded by maxFilesPerTrigger.
        paths = sorted(r[0] for r in batch.distinct().collect())
        if paths:
            process_files(batch.sparkSession, paths, output_dir, config, csv_options, norms)

    writer = (files.writeStream.foreachBatch(on_batch)
              .option("checkpointLocation", checkpoint_location or f"{output_dir.rstrip('/')}/_checkpoint"))
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime="30 seconds")
    return writer.start()
