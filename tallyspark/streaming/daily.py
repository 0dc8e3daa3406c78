"""E1 as a Structured Streaming job: new statement files -> month tables.

``readStream.text(inbox)`` sees each new file once and whole in one micro-batch
(the checkpoint remembers it), ``Trigger.AvailableNow`` drains what is there and
stops, ``cleanSource=archive`` moves finished files away, and every
micro-batch goes through the same clean / transform / anti-join append as
the batch job, so replays after a failure append nothing twice.

A file without a readable line (empty, or corrupt from its start) is in no
micro-batch.  So the run lists the inbox before it starts, each micro-batch enters
its files in the processed table, and what is listed but not processed when the
stream has drained is read as in the batch job: files without a line become ``no_header`` rejects.

With a bound on the files of a micro-batch a drain has many of them.  Then each one
only lands its lines, by one write into a folder of the checkpoint, and all are loaded together
when the stream has drained, with the rows, rejects and reports that one load after
the other gives.  What a lost run has landed is loaded by the next one first.
"""

from __future__ import annotations

from collections import deque
from concurrent.futures import Future, ThreadPoolExecutor
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from ..config import Settings
from ..plans.daily import (DailyPaths, DailyResult, append_rejects, load_landed, load_lines, report_failure, report_success,
                           unprocessed)
from ..plans.joins import STORED_AS, materialize
from ..session import scratch_scope
from ..sources import archive
from ..sources.paths import delete, is_local, names, write_text
from ..sources.statements import (BATCH, FILE_ID, LANDED_SCHEMA, few_listing_tasks, list_statements, place, raw_lines, read_statements,
                                  statement_lines, without_header)

#: Micro-batches of a drain whose lines are being written at a time.
IN_FLIGHT = 8
#: Empty file beside the lines of a micro-batch that have all landed.
_MARK = "_landed-"
_FILE_MANAGER = "spark.sql.streaming.checkpointFileManagerClass"


def start_daily_stream(spark: SparkSession, settings: Settings, paths: DailyPaths, checkpoint: str,
                       max_files_per_trigger: int | None = None, archive_dir: str | None = None) -> StreamingQuery:
    """Without ``max_files_per_trigger`` all new files are one batch, as in ``run_daily``.

    With it, each micro-batch counts as a run of its own: a row whose key an
    earlier file has already brought is then not appended again (J1).
    """
    def each_batch(batch: DataFrame, batch_id: int) -> None:
        session = batch.sparkSession
        with scratch_scope(session):
            try:
                files = materialize(batch.select("file_name", *FILE_ID).distinct(), "files")
                data, heads = statement_lines(batch, settings)
                res = load_lines(session, data, without_header(files, heads), settings, paths)
                res.files = files.count()
                archive.mark_processed(unprocessed(session, files, paths), paths.processed)
                report_success(session, res, paths)
            except Exception as e:
                report_failure(session, e, paths)
                raise

    return _start(spark, settings, paths, checkpoint, each_batch, max_files_per_trigger, archive_dir)


def _landing(checkpoint: str) -> str:
    return f"{checkpoint}/landed"


def _land(spark: SparkSession, settings: Settings, paths: DailyPaths, checkpoint: str,
          max_files_per_trigger: int, archive_dir: str | None) -> None:
    """Drain the stream; every micro-batch writes its lines once, one that is run again replaces its own.

    A few writes go on while the stream enters the next micro-batches in its log, which takes as long.  So the
    log may be ahead of what has landed: only a folder with its mark is taken for landed, and a file that
    is listed but in none of them is read by itself (``run_daily_stream``).  A stream that moves its files away
    waits for each write.
    """
    folder, at_once = _landing(checkpoint), 1 if archive_dir else IN_FLIGHT
    writes: deque[Future] = deque()

    def write(batch: DataFrame, batch_id: int) -> None:
        delete(spark, f"{folder}/{_MARK}{batch_id}")
        place(batch).write.mode("overwrite").option("compression", STORED_AS).parquet(f"{folder}/{BATCH}={batch_id}")
        write_text(spark, f"{folder}/{_MARK}{batch_id}", "")

    with ThreadPoolExecutor(at_once) as pool:
        def each_batch(batch: DataFrame, batch_id: int) -> None:
            writes.append(pool.submit(write, batch, batch_id))
            while len(writes) >= at_once:
                writes.popleft().result()

        try:
            query = _start(spark, settings, paths, checkpoint, each_batch, max_files_per_trigger, archive_dir)
            query.awaitTermination()
            for w in writes:
                w.result()
        except Exception as e:
            report_failure(spark, e, paths)
            raise


def _load_landed(spark: SparkSession, settings: Settings, paths: DailyPaths, checkpoint: str) -> None:
    """Load what has landed, then forget it; a load that is run again appends nothing twice."""
    folder = _landing(checkpoint)
    there = set(names(spark, folder))
    landed = {f"{BATCH}={n.removeprefix(_MARK)}" for n in there if n.startswith(_MARK)} & there
    for n in there - landed:
        if n.startswith(f"{BATCH}="):                      # its write was lost
            delete(spark, f"{folder}/{n}")
    if not landed:
        return
    try:
        load_landed(spark, spark.read.schema(LANDED_SCHEMA).parquet(folder), settings, paths)
    except Exception as e:
        report_failure(spark, e, paths)
        raise
    delete(spark, folder)


@contextmanager
def _plain_checkpoint_files(spark: SparkSession, checkpoint: str):
    """On a local disk a micro-batch's log files go through Hadoop's ``FileSystem``, unless the session names a way.

    Spark's default there runs a process for each question about a file: 0.1 s a micro-batch, whatever its size.
    Either way a file is written beside its place and renamed.
    """
    if not is_local(spark, checkpoint) or spark.conf.get(_FILE_MANAGER, None):
        yield
        return
    spark.conf.set(_FILE_MANAGER, "org.apache.spark.sql.execution.streaming.checkpointing.FileSystemBasedCheckpointFileManager")
    try:
        yield
    finally:
        spark.conf.unset(_FILE_MANAGER)


def _start(spark: SparkSession, settings: Settings, paths: DailyPaths, checkpoint: str, each_batch,
           max_files_per_trigger: int | None, archive_dir: str | None) -> StreamingQuery:
    reader = spark.readStream.option("pathGlobFilter", settings.file_glob).option("ignoreCorruptFiles", True)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    if archive_dir:
        reader = reader.option("cleanSource", "archive").option("sourceArchiveDir", archive_dir)
    lines = raw_lines(reader.text(paths.inbox))
    return (lines.writeStream.foreachBatch(each_batch)
                 .option("checkpointLocation", checkpoint)
                 .trigger(availableNow=True)
                 .start())


def run_daily_stream(spark: SparkSession, settings: Settings, paths: DailyPaths, checkpoint: str,
                     max_files_per_trigger: int | None = None, archive_dir: str | None = None) -> DailyResult | None:
    """Drain the inbox and answer for every file listed at the start.

    Returns the report of the files that no micro-batch has loaded, None when there are
    none: empty and unreadable ones, and those that a lost run had entered in the stream's log but not landed,
    which are loaded here.  After a failure in between, the next run lists what is left over again.
    """
    with scratch_scope(spark):
        listing = materialize(unprocessed(spark, list_statements(spark, paths.inbox, settings.file_glob), paths), "listing")
        _load_landed(spark, settings, paths, checkpoint)
        with few_listing_tasks(spark), _plain_checkpoint_files(spark, checkpoint):      # the source asks for them as it runs
            if max_files_per_trigger:
                _land(spark, settings, paths, checkpoint, max_files_per_trigger, archive_dir)
            else:
                query = start_daily_stream(spark, settings, paths, checkpoint, None, archive_dir)
                query.awaitTermination()
                if query.exception() is not None:
                    raise query.exception()
        _load_landed(spark, settings, paths, checkpoint)
        silent = materialize(unprocessed(spark, listing, paths), "not-loaded")
        n = silent.count()
        if not n:
            return None
        if silent.filter("size > 0").isEmpty():            # no line to look for
            nothing = spark.createDataFrame([], "path string")
            res = DailyResult("SUCCESS", rejects=append_rejects(spark, without_header(silent, nothing), paths))
        else:
            lines, unusable = read_statements(spark, paths.inbox, settings, settings.file_glob, only=silent)
            res = load_lines(spark, lines, unusable, settings, paths)
        res.files = n
        archive.mark_processed(silent, paths.processed)
        report_success(spark, res, paths)
        return res
