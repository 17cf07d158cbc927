"""Streaming scan (S2): a folder of DICOM files as a stream of rows.

A Structured Streaming source of files (new files are found each trigger; a file
log gives exactly-once discovery), then the same Arrow kernel and SQL decoders as
the batch scan. Files read by headers come from a source of our own, whose log is a
folder in shared storage (``medframe.streaming.file_stream``); Spark's ``binaryFile``
gives all others, with the checkpoint's file log. The stream has no
state: each micro-batch is a plain file scan. Use
``trigger(availableNow=True)`` for the reference's run-once test.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

from medframe import dictionary as dictmod
from medframe.sources import dicom
from medframe.streaming import file_stream

# The fixed schema of the binaryFile source.
BINARY_FILE_SCHEMA = "path string, modificationTime timestamp, length bigint, content binary"

# Spark lists a stream's folders when it is planned and for every micro-batch, and the
# files of a micro-batch anew, each as a path of its own. Without settings of the session
# it does so alone on the driver below 32 paths, and in a task a file (up to 10,000) above.
LISTING = "spark.sql.sources.parallelPartitionDiscovery"
LISTING_PATHS = 4     # from so many paths on tasks list them
TASKS_PER_CORE = 8    # that list the files of a micro-batch or read their headers, at most


def _most_tasks(spark: SparkSession) -> int:
    return TASKS_PER_CORE * spark.sparkContext.defaultParallelism


def _bound_listing(spark: SparkSession) -> None:
    """Settings of listing where the session has none of its own; a stream takes them
    over when it starts."""
    for key, value in (("threshold", LISTING_PATHS), ("parallelism", _most_tasks(spark))):
        if spark.conf.get(f"{LISTING}.{key}", None) is None:
            spark.conf.set(f"{LISTING}.{key}", str(value))


def _binary_files(spark: SparkSession, path: str, opts: dict, max_files_per_trigger: int | None) -> DataFrame:
    """Spark's own file source."""
    reader = spark.readStream.format("binaryFile").schema(BINARY_FILE_SCHEMA)
    for k, v in opts.items():
        if k.lower() not in ("includepixeldata", "includecontent", "includeprivatetags", "headeronly"):
            reader = reader.option(k, v)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", str(max_files_per_trigger))
    _bound_listing(spark)
    return reader.load(path)


def read_stream(
    spark: SparkSession,
    path: str,
    columns: list[str] | None = None,
    include_pixel_data: bool | None = None,
    include_content: bool | None = None,
    include_private_tags: bool | None = None,
    options: dict | None = None,
    schema: StructType | None = None,
    max_files_per_trigger: int | None = None,
    dictionary: dictmod.Dictionary | None = None,
    header_only: bool | None = None,
) -> DataFrame:
    """A streaming DataFrame of decoded DICOM files (same columns as ``read``).

    A user ``schema`` (e.g. ``medframe.sources.dicom.schema()``) restricts the
    columns to its field names, as the reference's stream test does.
    ``header_only`` (option ``headerOnly``) reads each new file only up to
    PixelData on the executors; the default is that of ``dicom.read``. The option
    ``fileLog`` names the folder of the file log (default: ``spark.checkpoint.dir``),
    which has to live as long as the query's checkpoint. With ``max_files_per_trigger``
    or another option of Spark's file source that source lists the files."""
    opts = dict(options or {})
    pix = dicom.bool_option(opts, dicom.OPTION_INCLUDE_PIXEL_DATA) if include_pixel_data is None else include_pixel_data
    con = dicom.bool_option(opts, dicom.OPTION_INCLUDE_CONTENT) if include_content is None else include_content
    prv = dicom.bool_option(opts, dicom.OPTION_INCLUDE_PRIVATE_TAGS) if include_private_tags is None else include_private_tags
    if schema is not None:
        columns = [f.name for f in schema.fields]
        pix = pix or "PixelData" in columns
        con = con or dicom.CONTENT in columns
        prv = prv or dicom.PRIVATE in columns
    conf = dicom.file_system_options(spark, opts)
    if header_only is None and any(k.lower() == "headeronly" for k in opts):
        header_only = dicom.bool_option(opts, "headerOnly")
    if header_only is None:
        header_only = not con and not pix and dicom._openable(spark, path, conf)
    if header_only and con:
        raise ValueError("includeContent needs the file bytes; not available with header_only")
    files = None
    if header_only and not max_files_per_trigger:
        files = file_stream.new_files(spark, path, opts, conf, _most_tasks(spark))
    if files is None:
        files = _binary_files(spark, path, opts, max_files_per_trigger)
        if header_only:
            # splits are sized by whole files, 32 small ones each; a header read needs far fewer tasks
            files = files.drop("content").coalesce(_most_tasks(spark))
    return dicom.decode_frame(files, columns, pix, con, prv, dictionary, header_only=header_only, options=conf)
