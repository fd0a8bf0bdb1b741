"""What the operators of this subpackage share: scratch tables, shared files, shipping code to executors, word splitting."""

from __future__ import annotations

import atexit
import contextlib
import functools
import gc
import io
import os
import shutil
import tempfile
import time
import uuid
import zipfile
import zlib
from collections.abc import Iterator
from pathlib import Path

import pyarrow as pa
import pyarrow.fs as pafs
from py4j.protocol import Py4JError
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession

from ..session import scratch_path

_shipped: set[str] = set()
BATCH_ROWS = "spark.sql.execution.arrow.maxRecordsPerBatch"
_made: list[str] = []
_released = [0.0]


def fresh_dir(spark: SparkSession, label: str) -> str:
    """A fresh path in the folder that driver and executors share."""
    _made.append(scratch_path(spark, label))
    return _made[-1]


def release_native(spark: SparkSession) -> None:
    """Have the driver's JVM hand freed native memory back, at most every few seconds: the C library keeps it by thread, and a driver of many jobs has hundreds of them. Where the JVM can't, nothing happens."""
    if time.monotonic() - _released[0] < 5:
        return
    _released[0] = time.monotonic()
    jvm, array = spark.sparkContext._jvm, spark.sparkContext._gateway.new_array
    with contextlib.suppress(Py4JError):  # by reflection: the server's own class isn't public
        of = jvm.java.lang.Class.forName
        kinds, given = array(jvm.java.lang.Class, 4), array(jvm.java.lang.Object, 4)
        for i, kind in enumerate(("javax.management.ObjectName", "java.lang.String", "[Ljava.lang.Object;", "[Ljava.lang.String;")):
            kinds[i] = of(kind)
        given[0], given[1] = jvm.javax.management.ObjectName("com.sun.management:type=DiagnosticCommand"), "systemTrimNativeHeap"
        given[2], given[3] = array(jvm.java.lang.Object, 0), array(jvm.java.lang.String, 0)
        of("javax.management.MBeanServer").getMethod("invoke", kinds).invoke(jvm.java.lang.management.ManagementFactory.getPlatformMBeanServer(), given)


def materialize(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` once as Parquet in the shared folder and read it back: it cuts the lineage, and survives lost executors."""
    spark = df.sparkSession
    path = fresh_dir(spark, label)
    df.write.parquet(path)
    release_native(spark)
    return spark.read.schema(df.schema).parquet(path)


def unused(df: DataFrame, name: str) -> str:
    """``name``, longer where a column has it already."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def clear_scratch(spark: SparkSession) -> None:
    """Delete the tables and files that this process has put into the shared folder; for when its results have been written elsewhere."""
    jvm = spark.sparkContext._jvm
    while _made:
        path = jvm.org.apache.hadoop.fs.Path(_made.pop())
        path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


def ship(spark: SparkSession) -> None:
    """Send this package to the executors once a session, so that a cluster without it installed can run it; and lower the Arrow batch's rows where they are Spark's default."""
    app = spark.sparkContext.applicationId
    if app in _shipped:
        return
    _shipped.add(app)
    # whole texts are long rows: Spark's default of 10 000 a batch would hold tens of MB on either side of each worker
    if spark.conf.get(BATCH_ROWS, "10000") == "10000":
        spark.conf.set(BATCH_ROWS, "2000")
    root = Path(__file__).resolve().parents[1]
    folder = tempfile.mkdtemp(prefix="docweave-code-")
    atexit.register(shutil.rmtree, folder, ignore_errors=True)
    target = os.path.join(folder, "docweave.zip")
    with zipfile.ZipFile(target, "w") as z:
        for p in sorted(root.rglob("*.py")):
            z.write(p, f"{root.name}/{p.relative_to(root)}")
    spark.sparkContext.addPyFile(target)


# --- files in the shared folder -------------------------------------------------------------------------------------


def filesystem(uri: str) -> tuple[pafs.FileSystem, str]:
    return pafs.FileSystem.from_uri(uri if "://" in uri or uri.startswith("file:") else f"file://{os.path.abspath(uri)}")


def write_file(uri: str, data: bytes) -> None:
    """Put a whole file in its place at once: a task that is run again, or twice, leaves one whole file."""
    fs, path = filesystem(uri)
    fs.create_dir(os.path.dirname(path), recursive=True)
    temporary = f"{path}.{uuid.uuid4().hex}.tmp"
    with fs.open_output_stream(temporary) as out:
        out.write(data)
    fs.move(temporary, path)


def read_file(uri: str) -> memoryview:
    """A file's bytes: mapped where the store is a local or mounted one, read where it isn't."""
    fs, path = filesystem(uri)
    if isinstance(fs, pafs.LocalFileSystem):
        return memoryview(pa.memory_map(path).read_buffer()).cast("B")
    with fs.open_input_file(path) as f:
        return memoryview(f.read_buffer()).cast("B")


def without_gc(f):
    """For functions that hold many small objects but make no cycles: the collector would walk them all again and again."""

    @functools.wraps(f)
    def call(*args, **kwargs):
        was = gc.isenabled()
        gc.disable()
        try:
            return f(*args, **kwargs)
        finally:
            if was:
                gc.enable()

    return call


_held: dict[tuple, object] = {}
_held_by = [None, None]


def held(key: tuple, make):
    """What a worker keeps between tasks under a key, whose first part names the operator. Once a task of another operator asks, it is let go."""
    context = TaskContext.get()
    task = context.taskAttemptId() if context else None
    if task != _held_by[0]:
        if key[0] != _held_by[1]:
            _held.clear()
        _held_by[:] = task, key[0]
    if key not in _held:
        _held[key] = make()
    return _held[key]


# --- texts ----------------------------------------------------------------------------------------------------------


def words_of(text: str | None) -> list[bytes]:
    """Words ``[^\\x20\\x09-\\x0D]+`` as UTF-8; bytes.split() cuts at just these six characters. Null: none."""
    return text.encode("utf-8", "surrogatepass").split() if text else []


def lower_words_of(text: str | None) -> list[bytes]:
    """The same, A-Z lower-cased; bytes.lower() leaves all else alone."""
    return text.encode("utf-8", "surrogatepass").lower().split() if text else []


def fold_of(doc_id: int | None) -> int:
    """crc32 of the id as text; a null id counts as the text ``null``."""
    return zlib.crc32((b"null" if doc_id is None else str(doc_id).encode()))


def slices(batches: Iterator[pa.RecordBatch], rows: int = 1024) -> Iterator[pa.RecordBatch]:
    """Batches of at most ``rows`` rows, so that what a step holds beside its input stays small."""
    for b in batches:
        for i in range(0, b.num_rows, rows):
            yield b.slice(i, rows)


def varint(n: int, out: io.BytesIO) -> None:
    while n > 127:
        out.write(bytes((n & 127 | 128,)))
        n >>= 7
    out.write(bytes((n,)))


def read_varint(data: memoryview | bytes, at: int) -> tuple[int, int]:
    shift = n = 0
    while True:
        b = data[at]
        at += 1
        n |= (b & 127) << shift
        if b < 128:
            return n, at
        shift += 7
