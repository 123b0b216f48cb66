"""Tables whose readers see committed versions only: event facts, and models as one unit.

Data files are written first, under names of their own, and belong to the table once a commit
of the log names them.  Facts and the ledger entry of a batch are one commit.  A writer that
finds newer commits looks again for ids that these have added to its dates, and tries the
next version.  Compaction replaces the small files of a date by few, in place: it takes out
exactly the files it has read, so batches written meanwhile stay.  Files that no commit names
are left over by failed writers and are never read.  Old versions stay readable.
"""

from __future__ import annotations

import json
import uuid
from collections import defaultdict
from collections.abc import Callable
from dataclasses import dataclass, replace
from datetime import UTC, datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cartlark.operators.merge import new_events
from cartlark.plans.etl import staged_events
from cartlark.sources.commit_log import CommitLog, Files
from cartlark.sources.fact_store import (
    FACT_COLUMNS,
    LEDGER_SCHEMA,
    NO_QUERY,
    STREAM_PIPELINE,
)

#: Commits after which the live files and ledger entries are written down as a whole.
STATE_EVERY = 50
#: Files below this size are packed together.
SMALL_BYTES = 64 << 20
_FACTS = (
    "event_id string, source_timestamp_ms bigint, event_time timestamp, visitor_id bigint, "
    "item_id bigint, event_type string, transaction_id string, category_id bigint, "
    "session_id string, source string, schema_version smallint, commit string, day string"
)


class Conflict(RuntimeError):
    """Files that a commit takes out are no longer there."""


@dataclass(frozen=True)
class Version:
    """The live files (relative path, bytes) and the ledger of one version."""

    number: int
    files: dict[str, int]
    ledger: list[dict]

    def days(self) -> dict[str, list[str]]:
        found = defaultdict(list)
        for name in self.files:
            found[name.split("/")[1].removeprefix("day=")].append(name)
        return found


@dataclass(frozen=True)
class VersionedFactStore:
    """``write`` and ``complete`` of a batch as in the other stores; reads by version."""

    path: str
    pipeline: str = STREAM_PIPELINE

    @property
    def log(self) -> CommitLog:
        return CommitLog(f"{self.path}/log")

    def _label(self, batch_id: int, query_id: str) -> str:
        return f"{self.pipeline}.{query_id}.{batch_id}"

    def version(self, spark: SparkSession, number: int | None = None) -> Version:
        """The newest version, or the one of this number: the last state written down, and the
        commits after it."""
        head = self.log.head(spark)
        number = head if number is None else number
        if not 0 <= number <= head:
            raise ValueError(f"no version {number}; the newest is {head}")
        disk = Files(spark)
        held = [int(n.removesuffix(".json")) for n in disk.names(f"{self.path}/state")]
        start = max((n for n in held if n <= number), default=0)
        state = json.loads(disk.read(f"{self.path}/state/{start:020d}.json")) if start else {}
        files, ledger = dict(state.get("files", {})), list(state.get("ledger", []))
        for commit in self.log.read(spark, start, number):
            for name in commit["remove"]:
                files.pop(name)
            files.update(commit["add"])
            ledger += [commit["entry"]] if commit.get("entry") else []
        return Version(number, files, ledger)

    def _commit(
        self, spark: SparkSession, base: Version, change: Callable[[Version], dict]
    ) -> int:
        """Adds ``change(version)`` to the newest version, as often as another was first."""
        while True:
            commit = change(base)
            if not set(commit["remove"]) <= set(base.files):
                raise Conflict("files were replaced meanwhile")
            number = base.number + 1
            if self.log.append(spark, number, commit):
                if number % STATE_EVERY == 0:
                    done = self.version(spark, number)
                    text = json.dumps({"files": done.files, "ledger": done.ledger})
                    Files(spark).create(f"{self.path}/state/{number:020d}.json", text)
                return number
            base = self.version(spark)

    def _read(self, spark: SparkSession, names: list[str]) -> DataFrame:
        if not names:
            return spark.createDataFrame([], _FACTS)
        return spark.read.schema(_FACTS).option("basePath", f"{self.path}/data").parquet(
            *[f"{self.path}/data/{name}" for name in sorted(names)]
        )

    def facts(self, spark: SparkSession, version: int | None = None) -> DataFrame:
        return self._read(spark, list(self.version(spark, version).files)).select(*FACT_COLUMNS)

    def ledger(self, spark: SparkSession, version: int | None = None) -> DataFrame:
        rows = [
            (e["pipeline_name"], e["query_id"], e["batch_id"], e["row_count"],
             datetime.fromtimestamp(e["completed_at"], UTC))
            for e in self.version(spark, version).ledger
        ]
        return spark.createDataFrame(rows, LEDGER_SCHEMA)

    def is_complete(self, spark: SparkSession, batch_id: int, query_id: str) -> bool:
        wanted = (self.pipeline, query_id, batch_id)
        return any(
            (e["pipeline_name"], e["query_id"], e["batch_id"]) == wanted
            for e in self.version(spark).ledger
        )

    def _written(self, spark: SparkSession, rows: DataFrame) -> dict[str, int]:
        """New data files of the rows, which no version names yet."""
        commit = uuid.uuid4().hex
        folder = f"{self.path}/data/commit={commit}"
        rows.select(*FACT_COLUMNS, "day").hint("rebalance", F.col("day")).write.partitionBy(
            "day").parquet(folder)
        return {f"commit={commit}/{name}": size for name, size in Files(spark).below(folder)}

    def write(self, batch: DataFrame, batch_id: int, query_id: str = NO_QUERY) -> int:
        """Puts the batch's new facts aside, compared with the committed facts of its dates.  A
        completed batch is left as it is and adds none."""
        spark = batch.sparkSession
        if self.is_complete(spark, batch_id, query_id):
            return 0
        day = F.to_date(F.timestamp_millis("source_timestamp_ms")).cast("string")
        staged = staged_events(batch, batch_id).withColumn("day", day).dropDuplicates(["event_id"])
        base = self.version(spark)
        fresh = self._new_rows(spark, staged, base.days(), set(base.files))
        files = self._written(spark, fresh)
        note = {"base": base.number, "files": files}
        aside = f"{self.path}/staged/{self._label(batch_id, query_id)}"
        # A retry adds a note of its own; the newest counts.
        Files(spark).create(f"{aside}/{len(Files(spark).names(aside)):010d}.json", json.dumps(note))
        return self._read(spark, list(files)).count()

    def _new_rows(self, spark, rows: DataFrame, days: dict[str, list[str]], names: set[str]):
        """Rows whose id is not in the files ``names`` of the rows' dates."""
        if not names:
            return rows
        mine = [r["day"] for r in rows.select("day").distinct().collect()]
        held = [name for day in mine for name in days.get(day, []) if name in names]
        return new_events(rows, self._read(spark, held)) if held else rows

    def complete(self, spark: SparkSession, batch_id: int, query_id: str, rows: int) -> int:
        """Commits the facts put aside and their ledger entry as one; returns the new facts."""
        if self.is_complete(spark, batch_id, query_id):
            return 0
        aside = f"{self.path}/staged/{self._label(batch_id, query_id)}"
        note = json.loads(Files(spark).read(f"{aside}/{Files(spark).names(aside)[-1]}"))
        seen = set(self.version(spark, note["base"]).files)
        state = {"files": note["files"], "seen": seen, "rows": rows, "twice": False}

        def change(version: Version) -> dict:
            entry = (self.pipeline, query_id, batch_id)
            state["twice"] = entry in {
                (e["pipeline_name"], e["query_id"], e["batch_id"]) for e in version.ledger
            }
            if state["twice"]:
                return {"add": {}, "remove": [], "entry": None}
            newer = set(version.files) - state["seen"]
            days = {name.split("/")[1].removeprefix("day=") for name in state["files"]}
            if any(name in newer for day in days for name in version.days().get(day, [])):
                mine = self._read(spark, list(state["files"]))
                fresh = self._new_rows(spark, mine, version.days(), newer)
                state["files"] = self._written(spark, fresh)
                state["rows"] = self._read(spark, list(state["files"])).count()
            state["seen"] = state["seen"] | newer
            return {
                "add": state["files"], "remove": [],
                "entry": {
                    "pipeline_name": self.pipeline, "query_id": query_id, "batch_id": batch_id,
                    "row_count": state["rows"], "completed_at": datetime.now(UTC).timestamp(),
                },
            }

        self._commit(spark, self.version(spark), change)
        return 0 if state["twice"] else state["rows"]

    def compact(self, spark: SparkSession, small_bytes: int = SMALL_BYTES) -> int | None:
        """Packs the small files of every date that has several; the version that holds the
        result, or None if there was nothing to pack."""
        base = self.version(spark)
        small = {
            day: [name for name in names if base.files[name] < small_bytes]
            for day, names in base.days().items()
        }
        packed = [name for names in small.values() if len(names) > 1 for name in names]
        if not packed:
            return None
        files = self._written(spark, self._read(spark, packed))
        return self._commit(
            spark, base, lambda version: {"add": files, "remove": packed, "entry": None}
        )

    def named(self, pipeline: str) -> VersionedFactStore:
        return replace(self, pipeline=pipeline)


# --- models -------------------------------------------------------------------------------------


def publish(spark: SparkSession, path: str, tables: dict[str, DataFrame], **facts) -> int:
    """Writes the tables of one model, and then makes all of them current at once; returns the
    version.  Until then, and if any table fails, readers keep the version before."""
    log, folder = CommitLog(f"{path}/log"), f"tables/{uuid.uuid4().hex}"
    for name, table in tables.items():
        table.write.parquet(f"{path}/{folder}/{name}")
    commit = {"folder": folder, "tables": {n: t.schema.json() for n, t in tables.items()}, **facts}
    version = log.head(spark) + 1
    while not log.append(spark, version, commit):
        version = log.head(spark) + 1
    return version


def published(spark: SparkSession, path: str, version: int | None = None) -> dict[str, DataFrame]:
    """The tables of the newest version, or of the one named."""
    from pyspark.sql.types import StructType

    log = CommitLog(f"{path}/log")
    head = log.head(spark)
    version = head if version is None else version
    if not 1 <= version <= head:
        raise ValueError(f"no version {version}; the newest is {head}")
    (commit,) = log.read(spark, version - 1, version)
    return {
        name: spark.read.schema(StructType.fromJson(json.loads(schema))).parquet(
            f"{path}/{commit['folder']}/{name}")
        for name, schema in commit["tables"].items()
    }
