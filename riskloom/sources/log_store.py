"""A decision log that stays quick to page through however long it grows.

Batches arrive as small folders, one per stream and batch number. A compaction moves what has
arrived since the last one into large files that are sorted by id and do not overlap, and
describes every file in a manifest: its ids, its span of time, how many rows of each outcome
it holds. A page then opens the few files that can hold it, found from the manifest alone.

A generation is its files, its manifest and the number of the last batch of each stream that
it covers. It counts from the moment its mark is created, a single atomic step; a crash before that
leaves the earlier generation in force, and what was written so far is never read. A batch that is run
again after it was covered is ignored, since a repeated batch brings the same rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from riskloom.operators import decisions
from riskloom.schemas import DECISIONS
from riskloom.sources.sinks import append_batch

#: Rows of a compacted file.
FILE_ROWS = 1_000_000
#: Manifest rows that are looked at first for a page.
_AHEAD = 64


class LogStore:
    """A log at ``path``; rows carry ``id`` (rising from batch to batch), ``transaction_id``,
    ``decision`` and ``created_at``."""

    def __init__(self, spark: SparkSession, path: str, file_rows: int = FILE_ROWS) -> None:
        self.spark, self.path, self.file_rows = spark, path.rstrip("/"), file_rows

    # Folders

    def _place(self, name: str):
        place = self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.path}/{name}")
        return place, place.getFileSystem(self.spark._jsc.hadoopConfiguration())

    def _names(self, name: str) -> list[str]:
        place, files = self._place(name)
        return [s.getPath().getName() for s in files.listStatus(place)] if files.exists(place) else []

    def generation(self) -> int:
        """The newest complete generation, 0 before the first."""
        return max((int(n) for n in self._names("marks") if n.isdigit()), default=0)

    def _covered(self, generation: int) -> dict[str, int]:
        """The last covered batch of each stream."""
        if not generation:
            return {}
        return {r.stream: r.batch_id for r in self.spark.read.parquet(f"{self.path}/covered/{generation}").collect()}

    def manifest(self) -> DataFrame | None:
        """One row per compacted file, or None before the first compaction."""
        generation = self.generation()
        return self.spark.read.parquet(f"{self.path}/manifest/{generation}") if generation else None

    # Rows

    def append(self, rows: DataFrame, stream: str, batch_id: int) -> None:
        append_batch(rows, f"{self.path}/batches", stream, batch_id)

    def open_batches(self) -> DataFrame | None:
        """Rows that no compaction has covered yet, or None where there are none."""
        covered = self._covered(self.generation())
        folders = []
        for stream in self._names("batches"):
            last = covered.get(stream.removeprefix("stream="), -1)
            folders += [f"{self.path}/batches/{stream}/{b}" for b in self._names(f"batches/{stream}")
                        if b.startswith("batch_id=") and int(b[9:]) > last]
        return self.spark.read.option("basePath", f"{self.path}/batches").parquet(*folders) if folders else None

    def read(self) -> DataFrame | None:
        """All rows of the log, each once; None before the first batch."""
        return self._with_open(self.manifest(), None)

    def _with_open(self, manifest: DataFrame | None, files: list[str] | None) -> DataFrame | None:
        late = self.open_batches()
        if files is None and manifest is not None:
            files = [r.file for r in manifest.select("file").collect()]
        if not files:
            return late
        kept = self.spark.read.parquet(*files)
        return kept if late is None else kept.unionByName(late.select(*kept.columns))

    def next_id(self, stream: str, batch_id: int) -> int:
        """The id that follows those of everything logged before this batch."""
        known = self.manifest()
        covered = self._covered(self.generation())
        if batch_id <= covered.get(stream, -1):
            raise ValueError(f"batch {batch_id} of stream {stream} is compacted already")
        largest = known.agg(F.max("last_id")).first()[0] if known is not None else None
        late = self.open_batches()
        if late is not None:
            before = late.where((F.col("stream") != stream) | (F.col("batch_id") < batch_id)).agg(F.max("id")).first()[0]
            largest = max((x for x in (largest, before) if x is not None), default=None)
        return 0 if largest is None else largest + 1

    # Compaction

    def write_generation(self, generation: int) -> bool:
        """Write the files, the manifest and the covered batches of a generation, without putting it in
        force. False where no batch has arrived since the last one."""
        late = self.open_batches()
        if late is None:
            return False
        before, known = self._covered(generation - 1), self.manifest()
        arrived = {r.stream: r.last for r in late.groupBy(F.col("stream").cast("string").alias("stream")).agg(
            F.max("batch_id").alias("last")).collect()}
        # The newest file grows while it is small, so that files stay large.
        tail = None
        if known is not None:
            newest = known.orderBy(F.desc("last_id")).select("file", "rows").first()
            if newest is not None and newest["rows"] < self.file_rows // 2:
                tail = newest["file"]
        rows = late.drop("stream", "batch_id")
        if tail is not None:
            rows = rows.unionByName(self.spark.read.parquet(tail))
        parts = max(1, -(-rows.count() // self.file_rows))
        folder = f"{self.path}/files/{generation}"
        (rows.repartitionByRange(parts, "id").sortWithinPartitions("id").write.mode("overwrite")
         .option("parquet.bloom.filter.enabled#transaction_id", "true").option("compression", "zstd").parquet(folder))
        entries = self.spark.read.parquet(folder).groupBy(F.input_file_name().alias("file")).agg(
            F.count("*").alias("rows"), F.min("id").alias("first_id"), F.max("id").alias("last_id"),
            F.min("created_at").alias("first_time"), F.max("created_at").alias("last_time"),
            *[F.count_if(F.col("decision") == d).alias(f"{d}_rows") for d in DECISIONS])
        if known is not None:
            entries = known.where(F.col("file") != F.lit(tail or "")).unionByName(entries)
        entries.write.mode("overwrite").parquet(f"{self.path}/manifest/{generation}")
        streams = before | arrived
        self.spark.createDataFrame(list(streams.items()), "stream string, batch_id int").coalesce(1).write.mode(
            "overwrite").parquet(f"{self.path}/covered/{generation}")
        return True

    def put_in_force(self, generation: int) -> None:
        """One atomic step; an error where another writer was first."""
        place, files = self._place(f"marks/{generation}")
        files.mkdirs(place.getParent())
        if not files.createNewFile(place):
            raise RuntimeError(f"generation {generation} is in force already")

    def compact(self) -> bool:
        """Cover the batches that have arrived; a log has one compaction at a time."""
        generation = self.generation() + 1
        if not self.write_generation(generation):
            return False
        self.put_in_force(generation)
        return True

    # Pages

    def page_files(self, limit: int, before_id: int | None = None, decision: str | None = None) -> list[str]:
        """The newest files that together hold more than ``limit`` rows of the page's kind. A file
        that ``before_id`` cuts through is opened but not counted on."""
        known = self.manifest()
        if known is None:
            return []
        rows = F.col(f"{decision}_rows" if decision else "rows")
        useful = known.where(rows > 0)
        if before_id is not None:
            useful = useful.where(F.col("first_id") < before_id)
        ahead = _AHEAD
        while True:
            entries = useful.orderBy(F.desc("last_id")).limit(ahead).select("file", "last_id", rows.alias("n")).collect()
            files, sure = [], 0
            for e in entries:
                if sure > limit:
                    return files
                files.append(e["file"])
                if before_id is None or e["last_id"] < before_id:
                    sure += e["n"]
            if sure > limit or len(entries) < ahead:
                return files
            ahead *= 4

    def page(self, limit: int = 50, before_id: int | None = None, decision: str | None = None) -> DataFrame | None:
        """``decisions.page`` from the files that can hold it, and from the batches not compacted yet."""
        limit = min(max(limit, 1), decisions.MAX_PAGE)
        rows = self._with_open(self.manifest(), self.page_files(limit, before_id, decision))
        return None if rows is None else decisions.page(rows, limit, before_id, decision)

    def investigation(self, transaction_id: str) -> DataFrame | None:
        """The newest decision of a transaction; the files' Bloom filters skip what lacks it."""
        rows = self.read()
        return None if rows is None else decisions.investigation(rows, transaction_id)
