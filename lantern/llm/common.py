"""Folders that all executors share, and tables written there to cut lineage."""

from __future__ import annotations

import ctypes
import gc
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lantern.session import shared_dir


#: Bytes in Parquet up to which a written table may be broadcast.
SMALL = 2 << 20
#: Files of an input whose row groups are counted.
FEW = 64


def written(df: DataFrame, name: str) -> DataFrame:
    """df as a Parquet table in the shared folder: it survives lost executors and is computed once."""
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/lantern-{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    out._written = path
    return out


def _file(table: DataFrame):
    spark = table.sparkSession
    path = spark._jvm.org.apache.hadoop.fs.Path(table._written)
    return path.getFileSystem(spark._jsc.hadoopConfiguration()), path


def forget(*tables: DataFrame) -> None:
    """Removes written tables that nothing reads any more."""
    for table in tables:
        fs, path = _file(table)
        fs.delete(path, True)


def is_small(table: DataFrame) -> bool:
    """Whether a written table's files are within SMALL."""
    fs, path = _file(table)
    return fs.getContentSummary(path).getLength() <= SMALL


def small(table: DataFrame) -> DataFrame:
    """A written table, to be broadcast if it is small; else joins shuffle it."""
    return F.broadcast(table) if is_small(table) else table


def spread(df: DataFrame) -> DataFrame:
    """df, or df dealt to all cores where it is read from fewer row groups than there are cores: a row group is read by one
    task, which then alone does what is done with its rows. Only inputs of up to FEW files are looked at."""
    spark = df.sparkSession
    cores, files = spark.sparkContext.defaultParallelism, df.inputFiles()
    if not files or len(files) >= min(cores, FEW) or not all(f.endswith(".parquet") for f in files):
        return df
    hadoop, parquet, groups = spark._jvm.org.apache.hadoop, spark._jvm.org.apache.parquet.hadoop, 0
    for f in files:
        path = hadoop.fs.Path(spark._jvm.java.net.URI(f))
        reader = parquet.ParquetFileReader.open(parquet.util.HadoopInputFile.fromPath(path, spark._jsc.hadoopConfiguration()))
        groups += reader.getRowGroups().size()
        reader.close()
    return df if groups >= cores else df.repartition(cores)


def n_partitions(spark: SparkSession) -> int:
    """The session's number of shuffle partitions, which the operator of the cluster scales with the input."""
    return max(1, int(spark.conf.get("spark.sql.shuffle.partitions", "200")))


def added(slices: DataFrame, kind: str, size: int, combine, once: bool = False) -> np.ndarray:
    """Slices of arrays of a fixed total size, combined by part: the result is as large whatever the input. once: each
    task's slices have different parts already."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: dict[int, np.ndarray] = {}
        for batch in batches:
            for part, data in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                x = np.frombuffer(data.as_buffer(), kind)
                total[part] = combine(total[part], x) if part in total else x.copy()
        yield pa.RecordBatch.from_arrays([pa.array(list(total), pa.int32()), pa.array([x.tobytes() for x in total.values()], pa.binary())], ["part", "counts"])

    out = np.zeros(size, kind)
    own = slices if once else slices.mapInArrow(run, "part int, counts binary")  # each task first adds up its own
    for part, data in own.repartition(16, "part").mapInArrow(run, "part int, counts binary").collect():
        x = np.frombuffer(data, kind)
        out[part * len(x) : (part + 1) * len(x)] = x
    return out


def held_out(id_col: str = "doc_id"):
    """True where crc32 of the id as text leaves remainder 0 by 5; a null id counts as empty text."""
    return F.crc32(F.coalesce(F.col(id_col).cast("string"), F.lit("")).cast("binary")) % 5 == 0


def release() -> None:
    """Gives memory that a Python worker no longer uses back to the system, at the end of a task: workers wait for the
    next one, beside tasks that need the memory."""
    gc.collect()
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim is not None:
        trim(0)
