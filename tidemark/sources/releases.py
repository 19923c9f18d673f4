"""Release files: what a stored table consists of, one file for each release."""

from __future__ import annotations

import json
import uuid
from dataclasses import asdict, dataclass, replace

from pyspark.sql import SparkSession
from pyspark.sql import types as T


class ConcurrentWriteError(RuntimeError):
    """Another writer has released the number that this one was to make."""


def _file_system(spark: SparkSession, path: str) -> tuple:
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()), place


def path_exists(spark: SparkSession, path: str) -> bool:
    """Whether the file system of ``path`` has it; asks without a job."""
    files, place = _file_system(spark, path)
    return files.exists(place)


def file_names(spark: SparkSession, folder: str) -> list[str]:
    """Names in a folder, none where it is missing; asks without a job."""
    files, place = _file_system(spark, folder)
    return [f.getPath().getName() for f in files.listStatus(place)] if files.exists(place) else []


def read_text(spark: SparkSession, path: str) -> str:
    files, place = _file_system(spark, path)
    source = files.open(place)
    try:
        return spark._jvm.org.apache.commons.io.IOUtils.toString(source, "UTF-8")
    finally:
        source.close()


def publish_text(spark: SparkSession, path: str, text: str) -> None:
    """Make a file that must not be there yet; it appears with its whole text or not at all."""
    files, place = _file_system(spark, path)
    draft = spark._jvm.org.apache.hadoop.fs.Path(f"{path}.{uuid.uuid4().hex[:12]}.draft")
    target = files.create(draft, False)
    try:
        target.write(bytearray(text.encode()))
    finally:
        target.close()
    hadoop = spark._jvm.org.apache.hadoop.fs
    context = hadoop.FileContext.getFileContext(place.toUri(), files.getConf())
    never_replace = spark.sparkContext._gateway.new_array(getattr(hadoop, "Options$Rename"), 0)
    try:
        context.rename(files.makeQualified(draft), files.makeQualified(place), never_replace)
    finally:
        files.delete(draft, False)


@dataclass(frozen=True)
class Part:
    """A folder of one release, the number of its schema, and the run that wrote it."""

    path: str
    release: int
    schema: int
    moment: str | None = None
    batch: str | None = None


@dataclass(frozen=True)
class Release:
    """What a table consists of; ``schemas`` has all it ever had, the newest last."""

    release: int
    rows: int
    schemas: tuple[str, ...]
    parts: tuple[Part, ...]
    source: int | None = None
    #: The number that the next release is to have; known when this one is read.
    following: int = 1

    @classmethod
    def parsed(cls, text: str) -> Release:
        held = json.loads(text)
        parts = tuple(Part(**p) for p in held.pop("parts"))
        return cls(parts=parts, schemas=tuple(held.pop("schemas")), **held)

    def schema(self, number: int = -1) -> T.StructType:
        """The schema of that number, without columns where there is none."""
        if not self.schemas:
            return T.StructType()
        return T.StructType.fromJson(json.loads(self.schemas[number]))

    def text(self) -> str:
        return json.dumps({name: value for name, value in asdict(self).items() if name != "following"})


NOTHING = Release(0, 0, (), ())


def newest_release(spark: SparkSession, folder: str) -> Release:
    """The newest release whose file can be read, ``NOTHING`` where there is none.

    ``following`` is above the number of every file, so one that cannot be read is left
    alone: another tool or a broken disk put it there.
    """
    names = file_names(spark, folder)
    numbers = sorted(int(n.removesuffix(".json")) for n in names if n.endswith(".json"))
    following = max(numbers, default=0) + 1
    for number in reversed(numbers):
        try:
            found = Release.parsed(read_text(spark, release_file(folder, number)))
        except (ValueError, TypeError, KeyError):
            continue
        return replace(found, following=following)
    return replace(NOTHING, following=following)


def release_file(folder: str, number: int) -> str:
    return f"{folder}/{number:012d}.json"
