"""An append-only log of small commits in a shared folder, and the file access it needs.

A commit is one JSON file named by its number.  It is written aside and then renamed to a name
that must not exist yet, so of two writers with the same number one succeeds, and readers
see whole commits only.  The file system must offer such a rename (HDFS and local ones do).
"""

from __future__ import annotations

import json
import uuid
from dataclasses import dataclass

from py4j.protocol import Py4JJavaError
from pyspark.sql import SparkSession


class Files:
    """The few file operations that DataFrames do not offer, through Hadoop's file systems."""

    def __init__(self, spark: SparkSession):
        self._java = spark.sparkContext._jvm.java
        self._hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs
        self._conf = spark.sparkContext._jsc.hadoopConfiguration()

    def _at(self, path: str):
        where = self._hadoop.Path(path)
        return where, where.getFileSystem(self._conf)

    def names(self, folder: str) -> list[str]:
        """Names in a folder, hidden ones left out; none for a folder that is missing."""
        where, files = self._at(folder)
        if not files.exists(where):
            return []
        found = [status.getPath().getName() for status in files.listStatus(where)]
        return sorted(name for name in found if not name.startswith(("_", ".")))

    def below(self, folder: str) -> list[tuple[str, int]]:
        """Data files at any depth, as paths relative to ``folder``, and their bytes."""
        where, files = self._at(folder)
        if not files.exists(where):
            return []
        base, found = files.resolvePath(where).toString().rstrip("/") + "/", []
        walk = files.listFiles(where, True)
        while walk.hasNext():
            status = walk.next()
            name = status.getPath().toString().removeprefix(base)
            if not name.rsplit("/", 1)[-1].startswith(("_", ".")):
                found.append((name, status.getLen()))
        return sorted(found)

    def read(self, path: str) -> str:
        where, files = self._at(path)
        stream = files.open(where)
        try:
            return bytes(stream.readAllBytes()).decode()
        finally:
            stream.close()

    def create(self, path: str, text: str) -> bool:
        """Writes a file that does not exist yet; False if another writer was first."""
        aside, files = self._at(f"{path.rsplit('/', 1)[0]}/_{uuid.uuid4().hex}")
        stream = files.create(aside)
        try:
            stream.write(text.encode())
        finally:
            stream.close()
        where = self._hadoop.Path(path)
        context = self._hadoop.FileContext.getFileContext(files.getUri(), self._conf)
        never = self._java.lang.reflect.Array.newInstance(
            self._java.lang.Class.forName("org.apache.hadoop.fs.Options$Rename"), 0
        )
        try:
            context.rename(aside, where, never)
            return True
        except Py4JJavaError as error:
            files.delete(aside, False)
            if "FileAlreadyExistsException" in error.java_exception.getClass().getName():
                return False
            raise


@dataclass(frozen=True)
class CommitLog:
    """Commits 1, 2, ... under ``path``."""

    path: str

    def _file(self, version: int) -> str:
        return f"{self.path}/{version:020d}.json"

    def head(self, spark: SparkSession) -> int:
        """The newest version; 0 for an empty log."""
        names = [n for n in Files(spark).names(self.path) if n.endswith(".json")]
        return int(names[-1].removesuffix(".json")) if names else 0

    def read(self, spark: SparkSession, after: int = 0, upto: int | None = None) -> list[dict]:
        """The commits of the versions above ``after``, up to ``upto`` or the newest."""
        files = Files(spark)
        last = self.head(spark) if upto is None else upto
        return [json.loads(files.read(self._file(v))) for v in range(after + 1, last + 1)]

    def append(self, spark: SparkSession, version: int, commit: dict) -> bool:
        """Adds the commit as ``version``; False if that version was taken meanwhile."""
        return Files(spark).create(self._file(version), json.dumps(commit))
