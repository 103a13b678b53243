"""Run state: a handful of named values (checkpoint date, watermark, table version) in numbered records.

Values are saved after the data they describe is committed, so a crash in between
repeats the run instead of skipping data. Only these few values ever reach the driver.
"""

from __future__ import annotations

import json
import uuid

from py4j.protocol import Py4JJavaError
from pyspark.sql import SparkSession

EPOCH = "1970-01-01"  # where every checkpoint and watermark starts

KEPT = 20  # records behind the last one that stay, for looking into a run


class ConflictingRunError(RuntimeError):
    """Another run has saved its state since this one began; nothing of this one's was saved."""


class RunState:
    """Named values on the tables' own file system, without a Spark job.

    A record holds all values and has a number; the highest counts. A step reads one record when it begins and
    creates the next one when it ends. Creation is exclusive: of two steps that began from the same
    record one is refused, whatever the values are. A record appears by rename, so none is ever half written.
    """

    def __init__(self, spark: SparkSession, path: str, kept: int | None = None):
        self.spark = spark
        self.path = path
        self.kept = KEPT if kept is None else kept

    def begin(self) -> Step:
        """The values as they are now, and the right to save the next ones."""
        return self.at(max(self.numbers(), default=0))

    def at(self, number: int) -> Step:
        """The values of one record; ValueError if it isn't there. Number 0 is before the first one, without values."""
        try:
            return Step(self, number, self._read(number) if number else {})
        except Py4JJavaError as error:
            if error.java_exception.getClass().getSimpleName() != "FileNotFoundException":
                raise
            raise ValueError(f"{self.path} has no record {number}") from None

    def get(self, name: str, default: str | None = None) -> str | None:
        """Last value saved under `name`."""
        return self.begin().get(name, default)

    def put(self, name: str, value: object) -> None:
        """Save one value by itself."""
        self.begin().commit({name: value})

    def _path(self, name: str):
        return self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.path}/{name}")

    def _files(self):
        conf = self.spark._jsparkSession.sessionState().newHadoopConf()
        return self._path("_").getFileSystem(conf)

    def numbers(self) -> list[int]:
        """Numbers of the records that are kept."""
        files, folder = self._files(), self._path("_").getParent()
        if not files.exists(folder):
            return []
        names = [status.getPath().getName() for status in files.listStatus(folder)]
        return [int(name[:-5]) for name in names if name.endswith(".json") and name[:-5].isdigit()]

    def _read(self, number: int) -> dict[str, str]:
        stream = self._files().open(self._path(f"{number:012d}.json"))
        try:
            return json.loads(self.spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8"))
        finally:
            stream.close()

    def _create(self, number: int, values: dict[str, str]) -> None:
        jvm, files = self.spark._jvm, self._files()
        fresh, record = self._path(f"_fresh-{uuid.uuid4().hex}"), self._path(f"{number:012d}.json")
        stream = files.create(fresh, False)
        try:
            stream.write(bytearray(json.dumps(values).encode()))
        finally:
            stream.close()
        context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(record.toUri(), files.getConf())
        # Rename without the overwrite option fails if the record is there.
        options = self.spark.sparkContext._gateway.new_array(jvm.org.apache.hadoop.fs.Options.Rename, 0)
        try:
            context.rename(files.makeQualified(fresh), files.makeQualified(record), options)
        except Py4JJavaError as error:
            files.delete(fresh, False)
            if error.java_exception.getClass().getSimpleName() == "FileAlreadyExistsException":
                raise ConflictingRunError(f"record {number} of {self.path} was saved by another run") from None
            raise
        for old in self.numbers():
            if old < number - self.kept:
                files.delete(self._path(f"{old:012d}.json"), False)


class Step:
    """The values a step began with. `commit` saves some anew, once or again and again, while no other run does."""

    def __init__(self, state: RunState, number: int, values: dict[str, str]):
        self.state = state
        self.number = number
        self.values = values

    def get(self, name: str, default: str | None = None) -> str | None:
        return self.values.get(name, default)

    def commit(self, values: dict[str, object]) -> None:
        """Save these values with all others as they were; ConflictingRunError if another run has saved any since."""
        after = self.values | {name: str(value) for name, value in values.items()}
        self.state._create(self.number + 1, after)
        self.number, self.values = self.number + 1, after
