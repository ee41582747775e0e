"""Intermediate tables, written to the folder that driver and executors share."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

_local: dict[str, str] = {}
#: Tables of ``written`` that have not been deleted, by path.
_tables: dict[str, SparkSession] = {}


def shared_dir(spark: SparkSession) -> str:
    """The session's ``spark.checkpoint.dir``; a temporary folder only where that is unset (local tests)."""
    told = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if told:
        return told.rstrip("/")
    if not spark.sparkContext.master.startswith("local[") and spark.sparkContext.master != "local":
        raise ValueError("spark.checkpoint.dir must name a folder that the driver and all executors share")
    return _local.setdefault("dir", tempfile.mkdtemp(prefix="lightfold-"))


def written(df: DataFrame, name: str, by: str | None = None) -> DataFrame:
    """``df`` as a Parquet table in the shared folder, in a folder for each value of ``by``: cuts lineage and survives lost executors."""
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"
    _tables[path] = spark
    (df.repartition(by).write.partitionBy(by) if by else df.write).parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def unused(stem: str, columns: list[str]) -> str:
    """A column name that is not in ``columns``, in any case of letters."""
    taken = {c.lower() for c in columns}
    while stem.lower() in taken:
        stem += "_"
    return stem


def quoted(name: str) -> str:
    """A column's name as ``F.col`` takes it whole, dots included."""
    return "`" + name.replace("`", "``") + "`"


def settled(make: Callable[[], DataFrame], name: str) -> DataFrame:
    """``make()`` as a written table; tables that were written on the way are deleted."""
    before = set(_tables)
    out = written(make(), name)
    own = next(reversed(_tables))
    for path in set(_tables) - before - {own}:
        _delete(path)
    return out


def mapped(df: DataFrame, run: Callable, added: list[T.StructField], less: str | None = None) -> DataFrame:
    """``df.mapInArrow`` by a function that keeps all columns (but ``less``) and adds some, whatever their names are."""
    safe = [f"column{i}" for i in range(len(df.columns))]
    kept = [(s, f) for s, f in zip(safe, df.schema.fields, strict=True) if f.name != less]
    schema = T.StructType([*(T.StructField(s, f.dataType) for s, f in kept), *added])
    return df.toDF(*safe).mapInArrow(run, schema).toDF(*(f.name for _, f in kept), *(f.name for f in added))


def drop(df: DataFrame) -> None:
    """Delete a table that ``written`` made and nothing needs any more."""
    files = df.inputFiles()
    for path in [p for p in _tables if files and f"{p.rsplit('/', 1)[1]}/" in files[0]]:
        _delete(path)


def _delete(path: str) -> None:
    spark = _tables.pop(path)
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    where.getFileSystem(spark._jsc.hadoopConfiguration()).delete(where, True)
