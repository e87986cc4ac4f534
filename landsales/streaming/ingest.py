"""K5 as a stream: load every raw file that lands, exactly once.

The batch job decides what is new from the manifest of year markers. When raw
files arrive continuously in a landing folder, Structured Streaming's file
source does that bookkeeping itself: its checkpoint records every file
already read, and ``trigger(availableNow=True)`` processes all files present
at start, then stops (run it on a schedule, or use ``processingTime`` to keep
it running). Each micro-batch goes through the same parse -> clean -> entities
-> keyed append -> publish steps as the batch load (``append_batch``), so each
one becomes a new snapshot. A replayed micro-batch (after a crash between
publish and checkpoint commit) is harmless: appends are keyed, existing rows
win.

Stream and batch share the manifest. A file of a year's folder is entered as a
part of it, and the year itself once all files of the folder are in: a batch load
reads the missing parts of a half-streamed year only. The files of a micro-batch
may differ in their headers; those of equal headers are parsed together.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from landsales.plans.load import append_batch, pending_markers, retried
from landsales.sources import fs
from landsales.sources.raw_files import FILE, RAW_FILE_WORD, by_header, parse_lines, with_file
from landsales.store import Store


def line_stream(spark: SparkSession, landing: str, max_files_per_trigger: int | None = None) -> DataFrame:
    """Lines (value) of the raw files, with their file."""
    reader = spark.readStream
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    return with_file(reader.text(f"{landing.rstrip('/')}/*{RAW_FILE_WORD}*.txt"))


def _parsed(lines: DataFrame, files: list[str]) -> DataFrame:
    out = None
    for header, group in by_header(files).items():
        frame = parse_lines(lines.where(F.col(FILE).isin(group)), list(header))
        out = frame if out is None else out.unionByName(frame)
    return out


def _markers(spark: SparkSession, store: Store, visible: list[str], files: list[str]) -> list[str]:
    """Manifest names of the files, and of the folders that are complete with them."""
    names = {fs.part_name(f) for f in files}
    manifest = store.table("elt_file", visible)
    for folder in sorted({f.rsplit("/", 1)[0] for f in files if f.rsplit("/", 1)[0].endswith(".txt")}):
        others = [n for e in fs.data_files(folder) if (n := fs.part_name(e.path)) not in names]
        if not pending_markers(spark, manifest, others):
            names.add(fs.base_name(folder))
    return sorted(names)


def ingest_available(spark: SparkSession, landing: str, store_root: str, checkpoint: str,
                     max_files_per_trigger: int | None = None, log=print, max_rejected: int | None = None) -> int:
    """Process every file not yet seen, then stop; returns micro-batches run. Lines that can't be
    read are set aside as in ``load``."""
    store = Store(spark, store_root)
    done = []

    def process(lines: DataFrame, epoch: int) -> None:
        # Files of this micro-batch (bounded by maxFilesPerTrigger).
        files = [r[0] for r in lines.select(FILE).distinct().collect()]
        if not files:
            return

        def append():
            state = store.state()
            visible = list(state["batches"])
            return append_batch(spark, store, state, visible, _parsed(lines, files), None,
                                _markers(spark, store, visible, files), log, max_rejected)

        done.append((epoch, retried(append, log).snapshot))

    query = (line_stream(spark, landing, max_files_per_trigger).writeStream
             .foreachBatch(process).option("checkpointLocation", checkpoint)
             .trigger(availableNow=True).start())
    query.awaitTermination()
    return len(done)
