"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from contextlib import contextmanager

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rosterflow.session import ensure_checkpoint_dir

# Rows of one Arrow batch: a batch of whole texts has to fit in a Python worker.
ARROW_ROWS = 512
# Bytes of text that a Python worker handles at a time inside a batch.
SLICE_BYTES = 4 << 20


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def bound_batches(spark: SparkSession, rows: int = ARROW_ROWS) -> None:
    """Lower the Arrow batch size of the session to ``rows`` if it is above."""
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    now = int(spark.conf.get(key))
    if now <= 0 or now > rows:
        spark.conf.set(key, str(rows))


@contextmanager
def batch_rows(spark: SparkSession, rows: int) -> Iterator[None]:
    """Arrow batches of ``rows`` for what runs meanwhile: rows of a few bytes."""
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(key)
    spark.conf.set(key, str(rows))
    try:
        yield
    finally:
        spark.conf.set(key, before)


def staged(df: DataFrame, name: str, options: dict[str, str] | None = None) -> DataFrame:
    """Write ``df`` to the shared checkpoint folder and read it back.

    This cuts the lineage: later stages re-read the files when an executor is
    lost.  The folder is removed when the driver's JVM ends.
    """
    spark = df.sparkSession
    path = f"{ensure_checkpoint_dir(spark)}/llm/{name}-{uuid.uuid4().hex}"
    df.write.options(compression="zstd", **(options or {})).parquet(path)
    jvm = spark._jvm
    hpath = jvm.org.apache.hadoop.fs.Path(path)
    hpath.getFileSystem(spark._jsc.hadoopConfiguration()).deleteOnExit(hpath)
    return spark.read.schema(df.schema).parquet(path)


def crc_mod(col: str, n: int):
    """crc32 of the id written in decimal, modulo ``n`` (null id: null)."""
    return F.crc32(F.col(col).cast("string")) % F.lit(n)


def slices(batch: pa.RecordBatch, column: str = "text", most: int = SLICE_BYTES):
    """Cut a batch into row slices of at most ``most`` bytes of text (one row at least)."""
    sizes = pc.binary_length(batch.column(column)).fill_null(0).to_pylist()
    start, held = 0, 0
    for i, n in enumerate(sizes):
        if held and held + n > most:
            yield batch.slice(start, i - start)
            start, held = i, 0
        held += n
    if start < len(sizes):
        yield batch.slice(start)


def with_fields(df: DataFrame, ddl: str) -> T.StructType:
    """Schema of ``df`` with the columns of ``ddl`` added."""
    return T.StructType([*df.schema.fields, *T.StructType.fromDDL(ddl).fields])


def one_row_per_id(docs: DataFrame, keep_null: bool = False) -> DataFrame:
    """One row for each doc_id: of rows that repeat an id the one with the smallest text.

    Only ids that occur more than once are grouped; equal texts are told apart
    by the other columns as a JSON text.  Rows without id go, or all stay.
    """
    # Written first: its size is then known when the joins are planned, and a short list costs no shuffle of the texts.
    repeated = staged(docs.groupBy("doc_id").agg(F.count("*").alias("n")).where("n > 1 AND doc_id IS NOT NULL").select("doc_id"),
                      "repeated")
    row = F.struct(*[F.col(f"`{c}`") for c in docs.columns])
    first = (docs.join(repeated, "doc_id", "left_semi")
             .groupBy("doc_id").agg(F.min_by(row, F.struct(F.col("text").isNull(), "text", F.to_json(row))).alias("row"))
             .select("row.*"))
    single = docs.join(repeated, "doc_id", "left_anti")
    return (single if keep_null else single.where("doc_id IS NOT NULL")).unionByName(first)


def fresh(df: DataFrame, name: str) -> str:
    """``name``, with underscores added until no column (in any case) has it."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name
