"""New drop files as a stream: each file is loaded once by the chain load, then archived."""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Mapping

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from shelfwise.plans.load import load_files
from shelfwise.profiles import ChainProfile
from shelfwise.sources.files import literal_path

LISTING = "path string, modificationTime timestamp, length bigint, content binary"


def file_stream(
    spark: SparkSession,
    folder: str,
    profile: ChainProfile,
    archive: str | None = None,
    files_per_batch: int | None = None,
) -> DataFrame:
    """(path, modificationTime, length) of a chain's files as they arrive; their content is not read.

    The stream is over the listing, so that files of one batch may have any headers. Spark moves a file to
    ``archive`` once a later batch has committed. It knows files by path for a week: a corrected file needs a name
    of its own, or a folder per day.
    """
    reader = spark.readStream.format("binaryFile").schema(LISTING).option("pathGlobFilter", profile.file_glob)
    if archive:
        reader = reader.option("cleanSource", "archive").option("sourceArchiveDir", archive)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.load(literal_path(folder)).select("path", "modificationTime", "length")


def batch_loader(
    profile: ChainProfile,
    models: Mapping[str, PipelineModel],
    sink: str,
    stream: str,
    mode: str = "quarantine",
    rules: str = "compat",
    register: bool = True,
) -> Callable[[DataFrame, int], None]:
    """Load each batch's files as one version named after the stream and the batch.

    A batch that is run again after it was published loads nothing; one that broke off before replaces what it
    had written.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        paths = sorted(r["path"] for r in batch.select("path").collect())  # names of files, at most files_per_batch
        load = f"{stream}-{batch_id:010d}"
        load_files(batch.sparkSession, paths, profile, models, sink, mode, rules, register, load)

    return write


def stream_new_files(
    spark: SparkSession,
    folder: str,
    profile: ChainProfile,
    models: Mapping[str, PipelineModel],
    sink: str,
    checkpoint: str,
    archive: str | None = None,
    mode: str = "quarantine",
    rules: str = "compat",
    files_per_batch: int | None = None,
    register: bool = True,
) -> StreamingQuery:
    """Load all files that are new since the last run, then stop; schedule it as often as needed.

    This is the daily path from a new file to its archived copy: read, cleaned, renamed, enriched, counted and
    published by :func:`shelfwise.plans.load.load_files`. The checkpoint is the stream's identity. Malformed rows
    are quarantined; any other failure stops the run before its batch is published, and the next run takes the
    same files again.
    """
    stream = hashlib.md5(checkpoint.rstrip("/").encode()).hexdigest()[:12]
    found = file_stream(spark, folder, profile, archive, files_per_batch)
    loader = batch_loader(profile, models, sink, stream, mode, rules, register)
    writer = found.writeStream.foreachBatch(loader).option("checkpointLocation", checkpoint)
    return writer.trigger(availableNow=True).start()
