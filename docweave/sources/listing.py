"""Folder listings as a data source: ``spark.read.format("docweave_listing").option("path", root).load()``, a row a file.

A listing service gives a folder's files a page at a time, with a token for the next, and filters by kind; ``Tree`` is the stand-in, over any folder
tree that pyarrow's file systems reach. The scan's partitions are folders, dealt out evenly; each reads its folders' pages one after another and holds one. Filters on
``mime_type`` (equal, in) and ``folder`` (equal, in, begins with) are pushed into the listing, where Spark hands them over
(``spark.sql.python.filterPushdown.enabled``, which ``scan`` sets): folders that don't fit are no partitions, files that don't are never read.

As a stream it gives the files that are new since the offset: those modified later, and those of the same moment that weren't seen. A file put in place with an older time is
missed, as the service's own change order would be needed for it. A folder that goes while it is listed has no files; hidden files and folders, whose names begin
with ``.`` or ``_``, are left out.
"""

from __future__ import annotations

import datetime
import mimetypes
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import pyarrow as pa
import pyarrow.fs as pafs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceReader, EqualTo, Filter, In, InputPartition, IsNotNull, SimpleDataSourceStreamReader, StringStartsWith

from ..session import runs_on_executors

runs_on_executors(__name__)

SCHEMA = "id string, folder string, name string, size long, modified timestamp, mime_type string"
NAME = "docweave_listing"
FILES = 200  # of a page
TASKS = 64


class NotFound(LookupError):
    """A file or folder that isn't there."""


class Tree:
    """A folder tree as a service: ids are paths below the root."""

    def __init__(self, root: str):
        self.fs, self.root = pafs.FileSystem.from_uri(root if "://" in root or root.startswith("file:") else f"file://{root}")
        self.root = self.root.rstrip("/")

    def _infos(self, folder: str) -> list[pafs.FileInfo]:
        try:
            found = self.fs.get_file_info(pafs.FileSelector(f"{self.root}/{folder}".rstrip("/")))
        except FileNotFoundError:
            raise NotFound(folder) from None
        return sorted((f for f in found if not f.base_name.startswith((".", "_"))), key=lambda f: f.base_name)

    def _row(self, info: pafs.FileInfo) -> tuple:
        path = info.path[len(self.root) + 1 :] if info.path.startswith(self.root) else info.path.removeprefix(self.root.lstrip("/")).lstrip("/")
        folder, _, name = path.rpartition("/")
        return path, folder, name, info.size, info.mtime, mimetypes.guess_type(name)[0] or "application/octet-stream"

    def folders(self, folder: str = "") -> list[str]:
        """The folders right below one."""
        return [f"{folder}/{f.base_name}".lstrip("/") for f in self._infos(folder) if f.type == pafs.FileType.Directory]

    def page(self, folder: str, token: str | None, mime_types: Sequence[str] | None = None, size: int = FILES) -> tuple[list[tuple], str | None]:
        """Files of a folder after the token, and the next page's token or None."""
        files = [f for f in self._infos(folder) if f.type == pafs.FileType.File and (token is None or f.base_name > token)]
        rows = [r for r in map(self._row, files[:size]) if mime_types is None or r[5] in mime_types]
        return rows, files[size - 1].base_name if len(files) > size else None

    def get(self, file: str) -> tuple:
        info = self.fs.get_file_info(f"{self.root}/{file}")
        if info.type != pafs.FileType.File:
            raise NotFound(file)
        return self._row(info)


def all_folders(tree: Tree, within: str = "") -> Iterator[str]:
    """A folder and those below it, from the top."""
    left = [within]
    while left:
        folder = left.pop()
        yield folder
        try:
            left += reversed(tree.folders(folder))
        except NotFound:
            continue


def files_of(tree: Tree, folder: str, mime_types: Sequence[str] | None = None) -> Iterator[tuple]:
    """Page after page."""
    token = None
    while True:
        try:
            rows, token = tree.page(folder, token, mime_types)
        except NotFound:
            return
        yield from rows
        if token is None:
            return


@dataclass
class Folders(InputPartition):
    names: tuple[str, ...]


class ListingReader(DataSourceReader):
    def __init__(self, options):
        self.root, self.within = options["path"], options.get("folder", "").strip("/")
        self.mime_types: tuple[str, ...] | None = None
        self.fits: list = []  # tests of folders

    def _only(self, values) -> None:
        self.mime_types = tuple(v for v in values if self.mime_types is None or v in self.mime_types)

    def pushFilters(self, filters: list[Filter]) -> Iterator[Filter]:
        """Takes what the service can do; gives back the rest."""
        for f in filters:
            match f:
                case EqualTo(("mime_type",), str(value)):
                    self._only([value])
                case In(("mime_type",), values):
                    self._only(values)
                case EqualTo(("folder",), str(value)):
                    self.fits.append(("is", (value,)))
                case In(("folder",), values):
                    self.fits.append(("is", tuple(values)))
                case StringStartsWith(("folder",), value):
                    self.fits.append(("begins", (value,)))
                case IsNotNull():
                    pass  # no column has nulls
                case _:
                    yield f

    def _fit(self, folder: str) -> bool:
        return all(folder in values if how == "is" else folder.startswith(values) for how, values in self.fits)

    def partitions(self) -> list[Folders]:
        names = [f for f in all_folders(Tree(self.root), self.within) if self._fit(f)]
        return [Folders(tuple(names[i::TASKS])) for i in range(min(TASKS, len(names)))] or [Folders(())]

    def read(self, partition: Folders) -> Iterator[tuple]:
        tree = Tree(self.root)
        for folder in partition.names:
            yield from files_of(tree, folder, self.mime_types)


class ListingStream(SimpleDataSourceStreamReader):
    def __init__(self, options):
        self.root, self.within = options["path"], options.get("folder", "").strip("/")

    def initialOffset(self) -> dict:
        return {"at": -1, "ids": []}

    @staticmethod
    def _micros(at: datetime.datetime) -> int:
        return (at - datetime.datetime(1970, 1, 1, tzinfo=datetime.timezone.utc)) // datetime.timedelta(microseconds=1)

    def _since(self, start: dict) -> list[tuple[int, tuple]]:
        tree = Tree(self.root)
        found = [(self._micros(r[4]), r) for folder in all_folders(tree, self.within) for r in files_of(tree, folder)]
        return sorted((at, r) for at, r in found if at > start["at"] or at == start["at"] and r[0] not in start["ids"])

    def read(self, start: dict) -> tuple[Iterator[tuple], dict]:
        new = self._since(start)
        if not new:
            return iter(()), start
        at = new[-1][0]
        ids = [r[0] for t, r in new if t == at] + (start["ids"] if at == start["at"] else [])
        return iter([r for _, r in new]), {"at": at, "ids": sorted(ids)}

    def readBetweenOffsets(self, start: dict, end: dict) -> Iterator[tuple]:
        """The same rows again, for a batch that is run again."""
        return iter([r for at, r in self._since(start) if at < end["at"] or at == end["at"] and r[0] in end["ids"]])

    def commit(self, end: dict) -> None:
        pass


class Listing(DataSource):
    @classmethod
    def name(cls) -> str:
        return NAME

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema) -> ListingReader:
        return ListingReader(self.options)

    def simpleStreamReader(self, schema) -> ListingStream:
        return ListingStream(self.options)


def register(spark: SparkSession) -> None:
    spark.dataSource.register(Listing)
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")


def scan(spark: SparkSession, path: str, folder: str = "") -> DataFrame:
    """Files under a root, or under a folder of it."""
    register(spark)
    return spark.read.format(NAME).option("path", path).option("folder", folder).load()


def stream(spark: SparkSession, path: str, folder: str = "") -> DataFrame:
    register(spark)
    return spark.readStream.format(NAME).option("path", path).option("folder", folder).load()


def fresh_metadata(ids: DataFrame, path: str, key: str = "id") -> DataFrame:
    """Each id's file as it is now; ids of files that are gone, and null ones, have no row."""

    def asked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tree = Tree(path)
        kinds = (pa.string(), pa.string(), pa.string(), pa.int64(), pa.timestamp("us", "UTC"), pa.string())
        for b in batches:
            rows = []
            for i in b[key].to_pylist():
                try:
                    rows += [tree.get(i)] if i is not None else []
                except NotFound:
                    continue
            yield pa.RecordBatch.from_arrays([pa.array([r[k] for r in rows], t) for k, t in enumerate(kinds)], [c.split()[0] for c in SCHEMA.split(", ")])

    return ids.select(key).mapInArrow(asked, SCHEMA)
