"""Shared plumbing of the corpus operators: scratch tables, row keys, byte-level words, rolling hashes."""

from __future__ import annotations

import atexit
import tempfile
import uuid
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: White space of the word definition, as a Java class body and as bytes.
WS_CLASS = r"\x20\x09-\x0D"
WS_BYTES = b" \t\n\x0b\x0c\r"

#: Rows of one Arrow batch: bounds a Python worker's memory when texts are long.
ARROW_ROWS = 2000


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_dir(spark: SparkSession) -> str:
    """The folder that all executors share (spark.checkpoint.dir); without one, a temporary folder in local mode and an error on a cluster."""
    conf = spark.sparkContext.getConf()
    if found := conf.get("spark.checkpoint.dir", None) or spark.conf.get("spark.checkpoint.dir", None):
        return found.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
    if not hasattr(spark, "_pressmill_scratch"):
        spark._pressmill_scratch = tempfile.mkdtemp(prefix="pressmill-")
    return "file://" + spark._pressmill_scratch


def drop_table(spark: SparkSession, path: str) -> None:
    jvm = spark.sparkContext._jvm
    target = jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(target, True)


def materialise(df: DataFrame) -> DataFrame:
    """Write df as Parquet into the shared folder and read it back: cuts lineage, survives lost executors.

    The table is removed by release(), or when the driver ends."""
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/pressmill-{uuid.uuid4().hex}"
    df.write.option("compression", "zstd").parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    out._pressmill_path = path
    atexit.register(_drop_late, spark, path)
    return out


def _drop_late(spark: SparkSession, path: str) -> None:
    try:
        drop_table(spark, path)
    except Exception:  # noqa: BLE001  the session has ended
        pass


def release(*frames: DataFrame) -> None:
    """Remove materialised tables that nothing reads any more, and let Spark drop dead shuffle files."""
    for df in frames:
        drop_table(df.sparkSession, df._pressmill_path)
    if frames:
        frames[0].sparkSession.sparkContext._jvm.System.gc()


def use_small_batches(spark: SparkSession) -> None:
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", ARROW_ROWS)


def map_rows(df: DataFrame, schema: str, f: Callable[[Iterator[dict]], Iterator[dict]]) -> DataFrame:
    """mapInArrow over column dictionaries (name -> Python list)."""
    use_small_batches(df.sparkSession)
    arrow = _arrow_schema(df.sparkSession, schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        columns = ({n: b.column(i).to_pylist() for i, n in enumerate(b.schema.names)} for b in batches)
        for out in f(columns):
            yield pa.RecordBatch.from_arrays([x if isinstance(x, pa.Array) else pa.array(x, t.type) for x, t in zip((out[t.name] for t in arrow), arrow, strict=True)], schema=arrow)

    return df.mapInArrow(run, schema)


def _arrow_schema(spark: SparkSession, schema: str) -> pa.Schema:
    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import StructType

    return to_arrow_schema(StructType.fromDDL(schema))


def word_count(text: Column) -> Column:
    """Number of [^\\x20\\x09-\\x0D]+ runs; 0 for null. Counted without building the words."""
    marked = F.regexp_replace(F.coalesce(text, F.lit("")), f"[^{WS_CLASS}]++", "a")
    return F.length(F.translate(marked, " \t\n\x0b\x0c\r", "")).cast("long")


def as_scan(df: DataFrame) -> DataFrame:
    """df itself where it reads each row of files at most once, else a written copy of it."""
    plan = df._jdf.queryExecution().analyzed()
    while plan.nodeName() in ("Project", "Filter", "SubqueryAlias"):
        plan = plan.children().head()
    return df if plan.getClass().getSimpleName() == "LogicalRelation" else materialise(df)


def with_row_key(df: DataFrame) -> DataFrame:
    """Add (_f, _r): a key of each row, file and position, the same at every evaluation of as_scan's result."""
    return as_scan(df).select("*", F.xxhash64("_metadata.file_path").alias("_f"), F.col("_metadata.row_index").alias("_r"))


def whole_row(df: DataFrame) -> Column:
    """All columns of df as one struct ``_row``, so that an operator's own columns cannot clash with them."""
    return F.struct(*(F.col(f"`{c}`") for c in df.columns)).alias("_row")


_MASK = (1 << 64) - 1
_BASE = 0x9E3779B97F4A7C15 | 1


class Rolling:
    """Hashes of arbitrary slices of one byte string, all at once: prefix sums of b[i] * B**i modulo 2**64."""

    _pow = np.ones(1, np.uint64)
    _inv = np.ones(1, np.uint64)

    @classmethod
    def _grow(cls, n: int) -> None:
        if len(cls._pow) <= n:
            size = max(1 << 17, 1 << n.bit_length())
            for name, base in (("_pow", _BASE), ("_inv", pow(_BASE, -1, 1 << 64))):
                steps = np.full(size, base, np.uint64)
                steps[0] = 1
                setattr(cls, name, np.multiply.accumulate(steps))

    def __init__(self, data: bytes) -> None:
        b = np.frombuffer(data, np.uint8).astype(np.uint64)
        self._grow(len(b) + 1)
        self.sums = np.zeros(len(b) + 1, np.uint64)
        np.cumsum((b + np.uint64(1)) * self._pow[: len(b)], out=self.sums[1:])

    def slices(self, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        return mix((self.sums[ends] - self.sums[starts]) * self._inv[starts])

    def windows(self, k: int) -> np.ndarray:
        n = len(self.sums) - k
        return mix((self.sums[k:] - self.sums[:n]) * self._inv[:n]) if n > 0 else np.zeros(0, np.uint64)


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit words whose output bits depend on all input bits."""
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    return x ^ (x >> np.uint64(32))
