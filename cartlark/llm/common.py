"""Tables, shared scratch space and column helpers of the training-data operators."""

from __future__ import annotations

import re
import uuid
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cartlark.session import shared_dir

#: Characters of white space in word operators: space and tab to carriage return.
SPACE_WORD = re.compile("[^\\x20\\x09-\\x0D]+")
_UPPER = {code: code + 32 for code in range(65, 91)}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def new_path(spark: SparkSession, name: str) -> str:
    """A path of its own in the folder that all executors share."""
    return f"{shared_dir(spark)}/llm/{uuid.uuid4().hex}/{name}"


def stored(df: DataFrame, name: str) -> DataFrame:
    """The rows written as Parquet to the shared folder and read back.

    Cuts the lineage, computes the rows once, and survives lost executors.
    """
    path = new_path(df.sparkSession, name)
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def ascii_lower(text: str) -> str:
    """Lower-cases A-Z and nothing else."""
    return text.lower() if text.isascii() else text.translate(_UPPER)


def space_words(text: str | None) -> list[str]:
    """Words of ASCII-lower-cased text between runs of space and tab to carriage return."""
    return SPACE_WORD.findall(ascii_lower(text)) if text else []


def remainder(doc_id: str = "doc_id", modulus: int = 3) -> Column:
    """crc32 of the id as text, modulo ``modulus``; a null id counts as the empty text."""
    text = F.coalesce(F.col(doc_id).cast("string"), F.lit(""))
    return F.pmod(F.crc32(text.cast("binary")), F.lit(modulus))


def free_name(df: DataFrame, name: str) -> str:
    """The name, or a longer one, that no column has (names compare without case)."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def columns(df: DataFrame) -> list[Column]:
    """All columns by their names, dots and back quotes included."""
    return [F.col("`" + c.replace("`", "``") + "`") for c in df.columns]


def without(df: DataFrame, *names: str) -> DataFrame:
    """Drops columns that an operator is about to add (names compare without case)."""
    taken = {name.lower() for name in names}
    pairs = zip(df.columns, columns(df), strict=True)
    return df.select(*[column for name, column in pairs if name.lower() not in taken])


def appending(
    df: DataFrame, fields: list[tuple[str, T.DataType]], column: str, compute
) -> DataFrame:
    """Adds columns that ``compute(list of values of column) -> list of pyarrow arrays`` gives.

    Rows stay where they are: no shuffle and no join.
    """
    kept = without(df, *[name for name, _ in fields])
    if column not in kept.columns:
        raise ValueError(f"column {column} is also an output column")
    place, names = kept.columns.index(column), [*kept.columns, *[name for name, _ in fields]]
    # Plain names on the way, as not every name can be handed to a Python function.
    plain = [f"_{n}" for n in range(len(names))]
    kinds = [*[field.dataType for field in kept.schema.fields], *[kind for _, kind in fields]]
    schema = T.StructType([T.StructField(n, t) for n, t in zip(plain, kinds, strict=True)])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        work = compute()
        for batch in batches:
            arrays = work(batch.column(place))
            yield pa.RecordBatch.from_arrays([*batch.columns, *arrays], names=plain)

    return kept.toDF(*plain[: len(kept.columns)]).mapInArrow(run, schema).toDF(*names)
