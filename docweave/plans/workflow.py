"""Workflows of stages that resume: a ledger of what is done, by fingerprints of inputs and parameters.

A stage is a function from tables to a table. Its fingerprint is a digest of its name, version, parameters and its inputs' fingerprints; a source's is one of its files'
names, sizes and times. A stage whose fingerprint the ledger has is passed over and its output read; so a run that broke off goes on where it was, a changed parameter or
source runs again what depends on it and nothing else, and going back to the old one finds its output there still. Outputs are written to a folder of their own and put in place by the
ledger's entry, one file renamed onto a free name: readers see whole outputs, and of two runs of a stage at once one counts.

Each try of a stage is noted before it begins, by a file too, so that tries are counted over all runs; a stage that failed ``attempts`` times raises ``GivenUp`` until
``forgive`` takes its notes away. Stages go in the order given; one whose input isn't there yet is an error before anything runs. What a stage's function does is not part of the
fingerprint: change ``version`` with it.
"""

from __future__ import annotations

import hashlib
import json
import uuid
from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass, field
from typing import Any

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType


@dataclass(frozen=True)
class Stage:
    name: str
    run: Callable[..., DataFrame]  # takes the inputs in their order, then the parameters by name
    inputs: tuple[str, ...]
    parameters: Mapping[str, Any] = field(default_factory=dict)
    version: str = "1"
    attempts: int = 3


class GivenUp(RuntimeError):
    """A stage has failed as often as it may."""


class Ledger:
    """Small files in a folder that all runs share."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder, self._jvm = spark, folder.rstrip("/"), spark._jvm

    def _path(self, name: str):
        path = self._jvm.org.apache.hadoop.fs.Path(f"{self.folder}/{name}")
        return path.getFileSystem(self.spark._jsc.hadoopConfiguration()), path

    def names(self, name: str) -> list[str]:
        fs, path = self._path(name)
        return sorted(s.getPath().getName() for s in fs.listStatus(path)) if fs.exists(path) else []

    def read(self, name: str) -> dict | None:
        fs, path = self._path(name)
        if not fs.exists(path):
            return None
        stream = fs.open(path)
        try:
            return json.loads(bytes(stream.readAllBytes()).decode())
        finally:
            stream.close()

    def put(self, name: str, content: dict) -> bool:
        """Whole and once: False where the name is taken."""
        fs, path = self._path(name)
        _, beside = self._path(f"{name.rpartition('/')[0]}/.{uuid.uuid4().hex}")
        stream = fs.create(beside, False)
        stream.write(bytearray(json.dumps(content).encode()))
        stream.close()
        if not fs.exists(path) and fs.rename(beside, path):
            return True
        fs.delete(beside, False)
        return False

    def remove(self, name: str) -> None:
        fs, path = self._path(name)
        fs.delete(path, True)

    def files(self, path: str) -> list[tuple[str, int, int]]:
        """Name, size and time of every file under a path."""
        at = self._jvm.org.apache.hadoop.fs.Path(path)
        found = at.getFileSystem(self.spark._jsc.hadoopConfiguration()).listFiles(at, True)
        out = []
        while found.hasNext():
            f = found.next()
            out.append((f.getPath().toString(), f.getLen(), f.getModificationTime()))
        return sorted(out)


def _digest(*parts: Any) -> str:
    return hashlib.sha256(json.dumps(parts, sort_keys=True, default=str).encode()).hexdigest()[:32]


class Workflow:
    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.ledger = spark, Ledger(spark, folder)

    def fingerprints(self, sources: Mapping[str, str], stages: Sequence[Stage]) -> dict[str, str]:
        """Of every source and stage, by name."""
        out = {name: _digest("source", self.ledger.files(path)) for name, path in sources.items()}
        for s in stages:
            if s.name in out:
                raise ValueError(f"{s.name} is there already")
            if missing := [i for i in s.inputs if i not in out]:
                raise ValueError(f"{s.name} wants {missing}, which nothing before it gives")
            out[s.name] = _digest("stage", s.name, s.version, dict(s.parameters), [out[i] for i in s.inputs])
        return out

    def tries(self, stage: str, fingerprint: str) -> int:
        """How often a stage was begun, over all runs."""
        return len([n for n in self.ledger.names(f"tries/{stage}-{fingerprint}") if not n.startswith(".")])

    def forgive(self, stage: str, fingerprint: str) -> None:
        self.ledger.remove(f"tries/{stage}-{fingerprint}")

    def run(self, sources: Mapping[str, str], stages: Sequence[Stage]) -> dict[str, DataFrame]:
        """Every source and output by name; ``sources`` are paths of Parquet tables."""
        marks = self.fingerprints(sources, stages)
        tables = {name: self.spark.read.parquet(path) for name, path in sources.items()}
        for s in stages:
            tables[s.name] = self._output(s, marks[s.name], tables)
        return tables

    def _output(self, s: Stage, mark: str, tables: Mapping[str, DataFrame]) -> DataFrame:
        entry = f"done/{s.name}-{mark}"
        while (done := self.ledger.read(entry)) is None:
            n = self.tries(s.name, mark)
            if n >= s.attempts:
                raise GivenUp(f"{s.name} was begun {n} times")
            self.ledger.put(f"tries/{s.name}-{mark}/{uuid.uuid4().hex}", {"try": n + 1})
            path = f"{self.ledger.folder}/out/{s.name}/{mark}-{uuid.uuid4().hex}"
            try:
                made = s.run(*[tables[i] for i in s.inputs], **s.parameters)
                made.write.parquet(path)
            except Exception:  # noqa: BLE001  whatever a stage raises: the last one goes on
                self.ledger.remove(path.removeprefix(f"{self.ledger.folder}/"))
                if n + 1 >= s.attempts:
                    raise
                continue
            if not self.ledger.put(entry, {"path": path, "tries": n + 1, "schema": made.schema.json()}):
                self.ledger.remove(path.removeprefix(f"{self.ledger.folder}/"))
        return self.spark.read.schema(StructType.fromJson(json.loads(done["schema"]))).parquet(done["path"])
