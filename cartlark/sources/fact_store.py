"""Fact stores with a completion ledger: a Parquet one and a JDBC one.

Both take ``write(batch, batch_id, query_id)`` and may be called again with the same batch
after a failure.  A ledger entry is named by pipeline, query and batch: batch numbers
restart with a new checkpoint, and such a batch is not the old one.
"""

from __future__ import annotations

from dataclasses import dataclass, replace

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cartlark.functions.contract import HISTORICAL_BATCH_ID
from cartlark.operators.merge import new_events
from cartlark.plans.etl import STAGED_COLUMNS, staged_events
from cartlark.sources.commit_log import Files

LEDGER_SCHEMA = (
    "pipeline_name string, query_id string, batch_id bigint, row_count bigint, "
    "completed_at timestamp"
)
FACT_COLUMNS = tuple(c for c in STAGED_COLUMNS if c != "ingest_batch_id")
NULLABLE_TEXT = ("transaction_id", "session_id")
STREAM_PIPELINE = "user_events_stream"
HISTORICAL_PIPELINE = "historical_batch_load"
NO_QUERY = "-"


_LEDGER_ENTRY = LEDGER_SCHEMA.removesuffix(", completed_at timestamp")


@dataclass(frozen=True)
class ParquetFactStore:
    """Facts by date and batch; a retry overwrites what its own batch wrote.

    An id holds its event's time, so equal ids are of one date: a batch is compared with the
    facts of its own dates alone, and completion with one ledger entry.
    """

    path: str
    pipeline: str = STREAM_PIPELINE

    def _label(self, batch_id: int, query_id: str) -> str:
        return f"{self.pipeline}.{query_id}.{batch_id}"

    def _read(self, spark: SparkSession, *parts: str) -> DataFrame | None:
        held = [f"{self.path}/{part}" for part in parts if self._holds(spark, part)]
        return spark.read.option("basePath", f"{self.path}/{parts[0].split('/')[0]}").parquet(
            *held
        ) if held else None

    def _holds(self, spark: SparkSession, part: str) -> bool:
        """Whether a finished job has written files below ``part``."""
        return bool(Files(spark).names(f"{self.path}/{part}"))

    def ledger(self, spark: SparkSession) -> DataFrame:
        found = self._read(spark, "ledger")
        if found is None:
            return spark.createDataFrame([], LEDGER_SCHEMA)
        return found.select("pipeline_name", "query_id", "batch_id", "row_count", "completed_at")

    def facts(self, spark: SparkSession) -> DataFrame | None:
        found = self._read(spark, "facts")
        return None if found is None else found.select(*FACT_COLUMNS)

    def is_complete(self, spark: SparkSession, batch_id: int, query_id: str) -> bool:
        return self._holds(spark, f"ledger/entry={self._label(batch_id, query_id)}")

    def write(self, batch: DataFrame, batch_id: int, query_id: str = NO_QUERY) -> int:
        """Writes the batch's new facts; a completed batch is left as it is and adds none."""
        spark = batch.sparkSession
        if self.is_complete(spark, batch_id, query_id):
            return 0
        label = self._label(batch_id, query_id)
        day = F.to_date(F.timestamp_millis("source_timestamp_ms")).cast("string")
        staged = staged_events(batch, batch_id).withColumn("day", day)
        days = [row["day"] for row in staged.select("day").distinct().collect()]
        facts = self._read(spark, *[f"facts/day={day}" for day in sorted(days)]) if days else None
        if facts is not None:
            # A retry replaces its own files, so its earlier rows do not count as held.
            staged = new_events(staged, facts.filter(F.col("batch") != label))
        else:
            staged = staged.dropDuplicates(["event_id"])
        (
            staged.select(*FACT_COLUMNS, "day", F.lit(label).alias("batch"))
            .write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
            .partitionBy("day", "batch").parquet(f"{self.path}/facts")
        )
        own = [f"facts/day={day}/batch={label}" for day in sorted(days)]
        written = self._read(spark, *own) if own else None
        return 0 if written is None else written.count()

    def complete(self, spark: SparkSession, batch_id: int, query_id: str, rows: int) -> None:
        entry = spark.createDataFrame(
            [(self.pipeline, query_id, batch_id, rows)], _LEDGER_ENTRY
        ).withColumn("completed_at", F.current_timestamp())
        entry.coalesce(1).write.mode("overwrite").parquet(
            f"{self.path}/ledger/entry={self._label(batch_id, query_id)}"
        )

    def compact(self, spark: SparkSession, target: str) -> ParquetFactStore:
        """The same facts in few files per date under ``target``, and the same ledger: one
        entry per batch, as completion is looked up by entry."""
        facts = self._read(spark, "facts")
        if facts is not None:
            (
                facts.withColumn("batch", F.lit("compacted")).hint("rebalance", F.col("day"))
                .write.partitionBy("day", "batch").parquet(f"{target}/facts")
            )
        entries = self._read(spark, "ledger")
        if entries is not None:
            entries.write.partitionBy("entry").parquet(f"{target}/ledger")
        return replace(self, path=target)


@dataclass(frozen=True)
class Touched:
    """Stands for the number of rows that an earlier statement of the transaction touched."""

    of: int


@dataclass(frozen=True)
class JdbcFactStore:
    """Facts in a database.  Executors append to the staging table in parallel; the driver
    then moves the batch in one transaction.

    Table and column names are quoted, and the statements are plain SQL.  Connection
    properties (user, password, driver) come from the caller.
    """

    url: str
    properties: dict[str, str]
    pipeline: str = STREAM_PIPELINE
    staging: str = "staging_events"
    fact: str = "fact_events"
    runs: str = "pipeline_runs"
    write_partitions: int = 8
    batch_size: int = 10_000

    def _connect(self, spark: SparkSession):
        jvm = spark.sparkContext._jvm
        options = jvm.java.util.Properties()
        for name, value in self.properties.items():
            if name != "driver":
                options.setProperty(name, value)
        return jvm.java.sql.DriverManager.getConnection(self.url, options)

    def _execute(self, spark: SparkSession, *statements: tuple) -> list[int]:
        """Runs all statements in one transaction and returns the rows each one touched."""
        connection = self._connect(spark)
        try:
            connection.setAutoCommit(False)
            touched = []
            for sql, *values in statements:
                prepared = connection.prepareStatement(sql)
                for place, value in enumerate(values, start=1):
                    value = touched[value.of] if isinstance(value, Touched) else value
                    if isinstance(value, int):
                        prepared.setLong(place, value)
                    else:
                        prepared.setString(place, value)
                touched.append(prepared.executeUpdate())
                prepared.close()
            connection.commit()
            return touched
        except Py4JJavaError:
            connection.rollback()
            raise
        finally:
            connection.close()

    def create_tables(self, spark: SparkSession, staged_text: str = "varchar(256)") -> None:
        """The staging, fact and ledger tables, with the rules the audit checks.
        ``staged_text`` is the type as which the database takes a null text from Spark."""
        def body(text: str) -> str:
            return (
                '"event_id" varchar(64) not null, "source_timestamp_ms" bigint not null, '
                '"event_time" timestamp not null, "visitor_id" bigint not null, '
                '"item_id" bigint not null, "event_type" varchar(32) not null, '
                f'"transaction_id" {text}, "category_id" bigint, "session_id" {text}, '
                '"source" varchar(64) not null, "schema_version" smallint not null'
            )

        rules = (
            'primary key ("event_id"), check ("source_timestamp_ms" >= 0), '
            'check ("visitor_id" >= 0), check ("item_id" >= 0), '
            "check (\"event_type\" in ('view', 'addtocart', 'transaction'))"
        )
        self._execute(
            spark,
            (f'create table "{self.staging}" ("pipeline_name" varchar(128) not null, '
             '"query_id" varchar(64) not null, "ingest_batch_id" bigint not null, '
             f"{body(staged_text)})",),
            (f'create table "{self.fact}" ({body("varchar(256)")}, {rules})',),
            (
                f'create table "{self.runs}" ("pipeline_name" varchar(128) not null, '
                '"query_id" varchar(64) not null, "batch_id" bigint not null, '
                '"row_count" bigint not null, '
                '"completed_at" timestamp default current_timestamp, '
                'primary key ("pipeline_name", "query_id", "batch_id"))',
            ),
        )

    def _table(self, spark: SparkSession, name: str) -> DataFrame:
        return spark.read.jdbc(self.url, f'"{name}"', properties=self.properties)

    def facts(self, spark: SparkSession, partitions: int | None = None) -> DataFrame:
        """All facts, read in ranges of their time by as many tasks."""
        time = "source_timestamp_ms"
        bounds = self._select(spark, f'select min("{time}") as "low", max("{time}") as "high", '
                                     f'count(*) as "n" from "{self.fact}"').first()
        if not bounds["n"]:
            return self._table(spark, self.fact)
        parts = min(partitions or self.write_partitions, bounds["n"])
        width = (bounds["high"] - bounds["low"]) // parts + 1
        starts = [bounds["low"] + n * width for n in range(1, parts)]
        # The outer ranges are open, so that facts added meanwhile are not cut off.
        rules = [f'"{time}" < {starts[0]}'] if starts else ["1 = 1"]
        rules += [f'"{time}" >= {a} and "{time}" < {b}' for a, b in zip(starts, starts[1:])]
        rules += [f'"{time}" >= {starts[-1]}'] if starts else []
        return spark.read.jdbc(
            self.url, f'"{self.fact}"', predicates=rules, properties=self.properties
        )

    def _select(self, spark: SparkSession, sql: str) -> DataFrame:
        return spark.read.jdbc(self.url, f"({sql}) q", properties=self.properties)

    def ledger(self, spark: SparkSession) -> DataFrame:
        return self._table(spark, self.runs)

    def is_complete(self, spark: SparkSession, batch_id: int, query_id: str) -> bool:
        # The filter reaches the database, which looks the entry up by its key.
        return not self.ledger(spark).filter(
            (F.col("pipeline_name") == self.pipeline)
            & (F.col("query_id") == query_id)
            & (F.col("batch_id") == batch_id)
        ).isEmpty()

    def _mine(self, batch_id: int, query_id: str) -> tuple[str, tuple]:
        """Which staged rows a batch owns: several streams share the staging table."""
        names = ("pipeline_name", "query_id", "ingest_batch_id")
        rule = " and ".join(f's."{name}" = ?' for name in names)
        return rule, (self.pipeline, query_id, batch_id)

    def write(self, batch: DataFrame, batch_id: int, query_id: str = NO_QUERY) -> int:
        """Fills the staging table afresh for this batch; the facts change on completion.  A
        completed batch is left as it is and adds nothing."""
        spark = batch.sparkSession
        if self.is_complete(spark, batch_id, query_id):
            return 0
        rule, mine = self._mine(batch_id, query_id)
        self._execute(spark, (f'delete from "{self.staging}" s where {rule}', *mine))
        staged = staged_events(batch, batch_id).dropDuplicates(["event_id"]).withColumns(
            {"pipeline_name": F.lit(self.pipeline), "query_id": F.lit(query_id)}
        )
        staged.write.option("batchsize", self.batch_size).option(
            "numPartitions", self.write_partitions
        ).jdbc(self.url, f'"{self.staging}"', mode="append", properties=self.properties)
        return self._table(spark, self.staging).filter(
            (F.col("pipeline_name") == self.pipeline)
            & (F.col("query_id") == query_id)
            & (F.col("ingest_batch_id") == batch_id)
        ).count()

    def complete(self, spark: SparkSession, batch_id: int, query_id: str, rows: int) -> int:
        """Moves the staged batch into the facts, notes it in the ledger, clears the stage.
        Returns the number of facts that were new, which is also what the ledger says."""
        columns = ", ".join(f'"{c}"' for c in FACT_COLUMNS)
        values = ", ".join(
            f'cast("{c}" as varchar(256))' if c in NULLABLE_TEXT else f'"{c}"'
            for c in FACT_COLUMNS
        )
        rule, mine = self._mine(batch_id, query_id)
        inserted, _, _ = self._execute(
            spark,
            (
                f'insert into "{self.fact}" ({columns}) select {values} '
                f'from "{self.staging}" s where {rule} and not exists '
                f'(select 1 from "{self.fact}" f where f."event_id" = s."event_id")',
                *mine,
            ),
            (
                f'insert into "{self.runs}" ("pipeline_name", "query_id", "batch_id", '
                '"row_count") values (?, ?, ?, ?)',
                self.pipeline, query_id, batch_id, Touched(0),
            ),
            (f'delete from "{self.staging}" s where {rule}', *mine),
        )
        return inserted


def input_digest(clean: DataFrame) -> str:
    """Names a load by its events, in whatever order or files they come."""
    ids = F.xxhash64("event_id")
    n, total, mixed = clean.agg(
        F.count("*"), F.sum(ids.cast("decimal(38,0)")), F.bit_xor(ids)
    ).first()
    return f"{n:x}-{int(total or 0) % (1 << 64):x}-{(mixed or 0) % (1 << 64):x}"


def load_historical(
    clean: DataFrame, store, load_id: str | None = None
) -> int:
    """Adds clean events to the facts of any of the stores as batch -1 of the load ``load_id`` (its input's digest
    by default).  Ids already held are skipped; an empty table or a load that is complete
    changes nothing.  Returns the number of facts that were new."""
    if clean.isEmpty():
        return 0
    spark = clean.sparkSession
    store = replace(store, pipeline=HISTORICAL_PIPELINE)
    load_id = load_id or input_digest(clean)
    if store.is_complete(spark, HISTORICAL_BATCH_ID, load_id):
        return 0
    rows = store.write(clean, HISTORICAL_BATCH_ID, load_id)
    added = store.complete(spark, HISTORICAL_BATCH_ID, load_id, rows)
    return rows if added is None else added
