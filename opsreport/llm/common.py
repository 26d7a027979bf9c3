"""What the operators share: tables, the shared folder, word bytes, Arrow columns."""

from __future__ import annotations

import tempfile
import uuid

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


#: The temporary folder of a local session that names none.
_LOCAL: list[str] = []


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_folder(spark: SparkSession, name: str) -> str:
    """A new folder below ``spark.checkpoint.dir``, which every executor can reach.

    Without that setting a local master gets a temporary folder; any other master is an
    error, as its executors would write to disks of their own.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        master = spark.sparkContext.master
        if master != "local" and not master.startswith("local["):
            raise ValueError("spark.checkpoint.dir must name a folder that executors share")
        if not _LOCAL:
            _LOCAL.append(f"file://{tempfile.mkdtemp(prefix='llm-')}")
        root = _LOCAL[0]
    return f"{root.rstrip('/')}/{name}-{uuid.uuid4().hex}"


#: Row groups of written tables; what a writer holds of whole texts before it lets go of them.
ROW_GROUP = 16 << 20


def written(df: DataFrame, name: str) -> DataFrame:
    """The rows written as Parquet in the shared folder and read again: cuts the lineage."""
    spark = df.sparkSession
    folder = shared_folder(spark, name)
    df.write.option("parquet.block.size", ROW_GROUP).parquet(folder)
    return spark.read.schema(df.schema).parquet(folder)


def text_or_empty(column: str | Column) -> Column:
    c = F.col(column) if isinstance(column, str) else column
    return F.coalesce(c.cast("string"), F.lit(""))


def bytes_list(column: pa.Array) -> list[bytes]:
    """UTF-8 bytes of a string column, nulls as empty, without decoding."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    return [b or b"" for b in column.cast(pa.large_binary()).to_pylist()]


_KINDS = {
    "long": (T.LongType(), pa.int64()),
    "int": (T.IntegerType(), pa.int32()),
    "double": (T.DoubleType(), pa.float64()),
    "boolean": (T.BooleanType(), pa.bool_()),
    "string": (T.StringType(), pa.string()),
    "binary": (T.BinaryType(), pa.binary()),
    "longs": (T.ArrayType(T.LongType()), pa.list_(pa.int64())),
    "doubles": (T.ArrayType(T.DoubleType()), pa.list_(pa.float64())),
}


def record(spec: str) -> tuple[T.StructType, pa.Schema]:
    """Spark's and Arrow's schema of ``"name kind, name kind"``; needs no session."""
    pairs = [part.split() for part in spec.split(",")]
    return (
        T.StructType([T.StructField(n, _KINDS[k][0]) for n, k in pairs]),
        pa.schema([pa.field(n, _KINDS[k][1]) for n, k in pairs]),
    )


def struct_column(rows: list[tuple], schema: pa.Schema) -> pa.Array:
    """Tuples as an Arrow column of structs."""
    columns = zip(*rows, strict=True) if rows else ([] for _ in schema)
    arrays = [pa.array(list(c), f.type) for c, f in zip(columns, schema, strict=True)]
    return pa.StructArray.from_arrays(arrays, fields=list(schema))


def record_batch(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    columns = zip(*rows, strict=True) if rows else ([] for _ in schema)
    arrays = [pa.array(list(c), f.type) for c, f in zip(columns, schema, strict=True)]
    return pa.RecordBatch.from_arrays(arrays, schema=schema)
