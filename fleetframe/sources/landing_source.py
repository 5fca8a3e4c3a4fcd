"""The landing zone in its file layout as a data source: batch, stream and sink.

    register(spark)
    spark.read.format("fleet_landing").option("entity", "Timeseries").option("run", "2024/01/31/00/05").load(path)
    spark.readStream.format("fleet_landing").option("entity", "Timeseries").load(path)
    payloads.write.format("fleet_landing").mode("append").save(path)

Runs are folders `{yyyy}/{MM}/{dd}/{HH}/{mm}` with a file `{Entity}[_{imo}].json` per payload. Of the folders only those on
the way to the runs that are wanted are listed: a batch after a given run, or the next batch of a stream, costs what is new,
however many runs are kept. The driver lists runs; the files of a run are listed by the tasks that read them. The offset of a
stream is the last run it has read; runs land in the order of their stamps, and a run is complete when its folder appears, as
the sink here moves finished files only: a new run's folder at once.

Paths are those of a local or mounted file system, or of a store that `pyarrow.fs` opens by its address.
"""

from __future__ import annotations

import re
import uuid
import zlib
from collections.abc import Iterator
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass

from pyspark.sql import SparkSession
from pyspark.sql.datasource import (
    DataSource,
    DataSourceReader,
    DataSourceStreamReader,
    DataSourceWriter,
    InputPartition,
    WriterCommitMessage,
)

NAME = "fleet_landing"
SCHEMA = "entity string, imo string, loaddate string, raw string"
# Depth of a run's folder below the root, and the names on the way (fixed format).
DEPTH, STAGED = 5, "_staged-"
FILE = re.compile(r"([A-Za-z]+)(?:_(.+))?\.json")
# Files and bytes of one partition of a read; partitions up to which a read of large runs is divided.
PART_FILES, PART_BYTES, PARTS = 500, 64 * 1024 * 1024, 128
# Threads that move files one by one; file systems that move a folder in one step.
MOVERS, MOVE_FOLDERS = 16, {"local", "hdfs"}


class Zone:
    """A landing root in whatever file system its path names."""

    def __init__(self, path: str):
        from pyarrow import fs

        local = re.sub(r"^file:/+", "/", path)
        self.fs, self.root = (fs.LocalFileSystem(), local) if "://" not in local else fs.FileSystem.from_uri(path)
        self.root = self.root.rstrip("/")

    def entries(self, folder: str) -> list:
        """What is directly below a folder of the zone; nothing if it is not there."""
        from pyarrow import fs

        return self.fs.get_file_info(fs.FileSelector(f"{self.root}/{folder}".rstrip("/"), allow_not_found=True))

    def folders(self, folder: str) -> list[str]:
        return sorted(e.base_name for e in self.entries(folder) if not e.is_file and e.base_name.isdigit())

    def runs(self, after: str = "", upto: str = "9") -> list[str]:
        """The runs behind `after` up to `upto`, in order; folders whose runs all lie outside are not opened."""
        level = [""]
        for depth in range(1, DEPTH + 1):
            below = [f"{parent}/{name}".lstrip("/") for parent in level for name in self.folders(parent)]
            level = [p for p in below if after[:len(p)] <= p and p[:len(upto)] <= upto[:len(p)]] if depth < DEPTH else below
        return [run for run in level if after < run <= upto]

    def newest(self) -> str:
        """The last run; on each level the later folders are opened first."""
        def last(folder: str, depth: int) -> str:
            if depth == DEPTH:
                return folder
            for name in reversed(self.folders(folder)):
                found = last(f"{folder}/{name}".lstrip("/"), depth + 1)
                if found:
                    return found
            return ""

        return last("", 0)

    def files(self, run: str, entity: str | None) -> list[tuple[str, int]]:
        """(path, bytes) of the payload files of a run."""
        found = [(e.path, e.size) for e in self.entries(run) if e.is_file]
        named = [(path, size, FILE.fullmatch(path.rsplit("/", 1)[-1])) for path, size in found]
        return sorted((path, size) for path, size, name in named if name and entity in (None, name[1]))

    def exists(self, folder: str) -> bool:
        from pyarrow import fs

        return self.fs.get_file_info(f"{self.root}/{folder}").type != fs.FileType.NotFound

    def payload(self, path: str) -> tuple[str, str | None, str, str]:
        run, name = "/".join(path.rsplit("/", DEPTH + 1)[1:-1]), FILE.fullmatch(path.rsplit("/", 1)[-1])
        with self.fs.open_input_stream(path) as source:
            return name[1], name[2], run, source.read().decode()


@dataclass
class Files(InputPartition):
    paths: list[str]


def cut(files: list[tuple[str, int]]) -> list[Files]:
    """Files in partitions of bounded number and size."""
    parts: list[list[str]] = []
    size = 0
    for path, length in files:
        if not parts or len(parts[-1]) >= PART_FILES or size + length > PART_BYTES:
            parts.append([])
            size = 0
        parts[-1].append(path)
        size += length
    return [Files(p) for p in parts]


@dataclass
class Share(InputPartition):
    """Some runs whole, or of each the files whose names fall to one of `of` shares."""

    runs: list[str]
    share: int = 0
    of: int = 1


def shares(zone: Zone, runs: list[str], entity: str | None) -> list[Share]:
    """The runs in partitions, by the files of three of them.

    A large run is dealt to several tasks that each list it. Their number is bounded, so listing grows with the files.
    """
    if not runs:
        return [Share([])]
    size = max(len(zone.files(run, entity)) for run in {runs[0], runs[len(runs) // 2], runs[-1]})
    spread = -(-PARTS // len(runs))
    of = min(-(-size // PART_FILES), spread) or 1
    step = max(1, min(PART_FILES // max(size, 1), -(-len(runs) // PARTS)))
    return [Share(runs[i:i + step], share, of) for i in range(0, len(runs), step) for share in range(of)]


class _Reading:
    def __init__(self, options: dict):
        self.path, self.entity = options["path"], options.get("entity")
        self.after, self.upto, self.only = options.get("after", ""), options.get("upto", "9"), options.get("run")

    def _read(self, partition: Share) -> Iterator[tuple]:
        zone = Zone(self.path)
        for run in partition.runs:
            for path, _ in zone.files(run, self.entity):
                if partition.of == 1 or zlib.crc32(path.rsplit("/", 1)[-1].encode()) % partition.of == partition.share:
                    yield zone.payload(path)


class LandingReader(_Reading, DataSourceReader):
    def partitions(self) -> list[Share]:
        zone = Zone(self.path)
        return shares(zone, [self.only] if self.only else zone.runs(self.after, self.upto), self.entity)

    def read(self, partition: Share) -> Iterator[tuple]:
        return self._read(partition)


class LandingStream(_Reading, DataSourceStreamReader):
    def initialOffset(self) -> dict:  # noqa: N802
        return {"run": self.after}

    def latestOffset(self) -> dict:  # noqa: N802
        return {"run": max(Zone(self.path).newest(), self.after)}

    def partitions(self, start: dict, end: dict) -> list[Share]:
        zone = Zone(self.path)
        return shares(zone, zone.runs(start["run"], end["run"]), self.entity)

    def read(self, partition: Share) -> Iterator[tuple]:
        return self._read(partition)


@dataclass
class Written(WriterCommitMessage):
    runs: list[str]


class LandingWriter(DataSourceWriter):
    """One file per payload. Tasks write into a staged folder; when all are done its files are moved to their runs.

    A failed write leaves nothing. A payload that is landed again replaces its file.
    """

    def __init__(self, options: dict):
        self.path, self.id = options["path"], uuid.uuid4().hex

    def write(self, iterator: Iterator) -> Written:
        zone, runs = Zone(self.path), set()
        for row in iterator:
            name = row["entity"] if row["imo"] is None else f"{row['entity']}_{row['imo']}"
            run = row["loaddate"]
            if not FILE.fullmatch(f"{name}.json") or "/" in name or not re.fullmatch(r"\d{4}(/\d\d){4}", run or ""):
                raise ValueError(f"no payload of a run: {name}, {run}")
            folder = f"{zone.root}/{STAGED}{self.id}/{run}"
            if run not in runs:
                zone.fs.create_dir(folder, recursive=True)
                runs.add(run)
            with zone.fs.open_output_stream(f"{folder}/{name}.json") as out:
                out.write((row["raw"] or "").encode())
        return Written(sorted(runs))

    def commit(self, messages: list[Written]) -> None:
        zone = Zone(self.path)
        for run in sorted({run for m in messages if m for run in m.runs}):
            staged = f"{STAGED}{self.id}/{run}"
            if zone.fs.type_name in MOVE_FOLDERS and not zone.exists(run):
                zone.fs.create_dir(f"{zone.root}/{run}".rsplit("/", 1)[0], recursive=True)
                zone.fs.move(f"{zone.root}/{staged}", f"{zone.root}/{run}")
                continue
            zone.fs.create_dir(f"{zone.root}/{run}", recursive=True)
            names = [path.rsplit("/", 1)[-1] for path, _ in zone.files(staged, None)]
            with ThreadPoolExecutor(MOVERS) as movers:
                list(movers.map(lambda name, at=staged, to=run: zone.fs.move(f"{zone.root}/{at}/{name}", f"{zone.root}/{to}/{name}"), names))
        self._clear(zone)

    def abort(self, messages: list[Written]) -> None:
        self._clear(Zone(self.path))

    def _clear(self, zone: Zone) -> None:
        from pyarrow import fs

        staged = f"{zone.root}/{STAGED}{self.id}"
        if zone.fs.get_file_info(staged).type != fs.FileType.NotFound:
            zone.fs.delete_dir(staged)


class LandingSource(DataSource):
    @classmethod
    def name(cls) -> str:
        return NAME

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema) -> LandingReader:
        return LandingReader(self.options)

    def streamReader(self, schema) -> LandingStream:  # noqa: N802
        return LandingStream(self.options)

    def writer(self, schema, overwrite: bool) -> LandingWriter:
        return LandingWriter(self.options)


def register(spark: SparkSession) -> None:
    """Make the source known to the session; its code travels with it."""
    import sys

    from pyspark import cloudpickle

    cloudpickle.register_pickle_by_value(sys.modules[__name__])
    spark.dataSource.register(LandingSource)
