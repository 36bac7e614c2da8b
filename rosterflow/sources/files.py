"""File sources: positional pipe files, CSV with and without header, header
normalisation, column aliases, delimiter detection, image folders (S1-S6, S11).

Schemas are always explicit (no inference pass over the data); header-only
inspection reads a single line.
"""

from __future__ import annotations

import os
import re
import uuid

from pyspark.sql import DataFrame, DataFrameReader, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rosterflow.session import ensure_checkpoint_dir


RAGGED = "_ragged_record"


def string_schema(names: list[str]) -> T.StructType:
    return T.StructType([T.StructField(n, T.StringType()) for n in names])


def read_positional(spark: SparkSession, path: str, positions: dict[int, str], *, width: int,
                    sep: str = "|") -> DataFrame:
    """Pipe-delimited text without quoting; ``positions`` maps 0-based field
    numbers to names, the other fields are read and pruned (S1)."""
    names = [positions.get(i, f"_f{i}") for i in range(width)]
    df = (spark.read.schema(string_schema(names)).option("sep", sep).option("quote", "")
          .option("escape", "").option("header", False).option("mode", "PERMISSIVE").csv(path))
    return df.select(*[positions[i] for i in sorted(positions)])


def read_csv_headerless(spark: SparkSession, path: str, schema: T.StructType, *, sep: str = ",",
                        empty_as_null: bool = False) -> DataFrame:
    """CSV without header into an existing schema (S2).  Like a table import,
    empty fields stay '' (not NULL) unless ``empty_as_null``."""
    r = spark.read.schema(schema).option("header", False).option("sep", sep)
    if not empty_as_null:
        r = r.option("nullValue", "\u0000").option("emptyValue", "")
    return r.csv(path)


def _records(spark: SparkSession, path: str, sep: str) -> DataFrameReader:
    """Reader of delimited records that follow quotes: a quoted field may hold
    separators, line breaks and doubled quotes."""
    return (spark.read.option("sep", sep).option("header", False).option("multiLine", True).option("quote", '"').option("escape", '"')
            .option("nullValue", "\u0000").option("emptyValue", ""))


def _first_record(spark: SparkSession, path: str, sep: str) -> list[str]:
    """Fields of the first record; reads the first file only."""
    row = _records(spark, path, sep).csv(path).limit(1).collect()
    return ["" if v is None else v for v in row[0]] if row else []


def detect_delimiter(spark: SparkSession, path: str, candidates=(",", "\t")) -> str:
    """Delimiter of a vendor export (S6): the candidate that stands most often
    in its first line, outside quotes (reads one line)."""
    first = spark.read.text(path).limit(1).collect()
    line = re.sub(r'"[^"]*("|$)', "", first[0][0]) if first else ""
    return max(candidates, key=line.count)


def normalize_name(name: str) -> str:
    """Strip byte-order marks and quotes, upper-case, trim."""
    for bom in ("﻿", "￾"):
        name = name.replace(bom, "")
    return name.replace('"', "").replace("'", "").upper().strip()


def normalize_header(df: DataFrame) -> DataFrame:
    return df.toDF(*[normalize_name(c) for c in df.columns])


def alias_columns(df: DataFrame, target: str, candidates: list[str]) -> DataFrame:
    """Expose the first present of ``candidates`` as ``target``."""
    present = [c for c in candidates if c in df.columns]
    if not present:
        raise ValueError(f"none of {candidates} in {df.columns}")
    return df.withColumn(target, F.col(f"`{present[0]}`"))


def read_csv_headered(spark: SparkSession, path: str, *, sep: str | None = None,
                      normalize: bool = False) -> DataFrame:
    """Headered CSV read by name; records whose field count differs from the
    header are dropped (S3).  The header record fixes the (all-text) schema.

    Records and header are split by the same rules, which follow quotes: a
    quoted field may hold separators, line breaks and doubled quotes.  The count
    is that of the parsed record and does not depend on the columns that a query
    reads.  Records equal to the header go, in further part files too.  As in a
    CSV table import, an empty field is '' (never NULL).

    A record may go over lines, so a file is read by one task; vendors deliver
    many files, and files are the unit of parallel work.
    """
    sep = sep or detect_delimiter(spark, path)
    header = _first_record(spark, path, sep)
    if not header:
        raise ValueError(f"{path}: no header")
    # The parser puts a record of another length into the last column.
    fields = [f"_c{i}" for i in range(len(header))]
    schema = T.StructType([*string_schema(fields).fields, T.StructField(RAGGED, T.StringType())])
    df = (_records(spark, path, sep).option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", RAGGED)
          .option("columnPruning", False).schema(schema).csv(path))
    values = [F.coalesce(F.col(c), F.lit("")) for c in fields]
    is_header = F.lit(True)
    for c, name in zip(values, header):
        is_header = is_header & (c == F.lit(name))
    df = df.where(F.col(RAGGED).isNull() & ~is_header).select(*values).toDF(*header)
    return normalize_header(df) if normalize else df


def read_images(spark: SparkSession, path: str, glob: str = "*.jpg") -> DataFrame:
    """Image folder as (path, modificationTime, length, content)."""
    return spark.read.format("binaryFile").option("pathGlobFilter", glob).load(path)


def landing_path(spark: SparkSession, name: str) -> str:
    """A fresh folder under the shared checkpoint location for landed files."""
    return os.path.join(ensure_checkpoint_dir(spark), "landing", f"{name}-{uuid.uuid4().hex}")
