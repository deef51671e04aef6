"""What several operators need: written stages, Arrow helpers, key columns."""

from __future__ import annotations

import os
import tempfile
import uuid
import zipfile
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

#: Rows with whole texts that a Python worker holds as Python objects at a time. Spark's batches have
#: up to 10,000; executors' memory has to hold what each of their workers takes beside the JVM.
ROWS = 1000
#: Spark's setting for the shuffles of a query that has ended.
FREED = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"

_local_folder: dict[str, str] = {}
_shipped: set[str] = set()


def shared_folder(spark: SparkSession) -> str:
    """The folder that all executors share: spark.checkpoint.dir of the session.

    Where it is unset, a local master (tests) gets a temporary folder; on a cluster that
    is an error, since executors would not see each other's files.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder:
        return folder.rstrip("/")
    if spark.sparkContext.master.split("[")[0] != "local":
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    app = spark.sparkContext.applicationId
    if app not in _local_folder:
        _local_folder[app] = "file://" + tempfile.mkdtemp(prefix="llm-")
    return _local_folder[app]


def staged(df: DataFrame, name: str, free: bool = False) -> DataFrame:
    """df, written as Parquet to the shared folder and read again: later jobs start from there.

    Lost executors cost only the tasks after it. Each call takes a folder of its own. With `free` the
    shuffles of the write are deleted when it has ended, and not when the driver collects its garbage.
    """
    spark = df.sparkSession
    path = f"{shared_folder(spark)}/llm-{spark.sparkContext.applicationId}/{name}-{uuid.uuid4().hex}"
    before = spark.conf.get(FREED)
    if free:
        spark.conf.set(FREED, "true")
    try:
        df.write.parquet(path)
    finally:
        if free:
            spark.conf.set(FREED, before)
    return spark.read.schema(df.schema).parquet(path)


def dropped(df: DataFrame) -> None:
    """Delete what staged() wrote; nothing may read df any more."""
    spark = df.sparkSession
    for folder in {name.rsplit("/", 1)[0] for name in df.inputFiles()}:
        path = spark._jvm.org.apache.hadoop.fs.Path(folder)
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def ship(spark: SparkSession) -> None:
    """Send this package to the Python workers, once per application, as --py-files would."""
    context = spark.sparkContext
    if context.applicationId in _shipped:
        return
    top = Path(__file__).resolve().parents[1]
    target = os.path.join(tempfile.mkdtemp(prefix="llm-"), "footfall_llm.zip")
    with zipfile.ZipFile(target, "w") as out:
        for path in sorted([top / "__init__.py", *(top / "llm").glob("*.py")]):
            out.write(path, str(path.relative_to(top.parent)))
    context.addPyFile(target)
    _shipped.add(context.applicationId)


def sliced(batch, rows: int | None):
    """An Arrow batch or array as it is, or in slices of `rows` rows, which share its memory."""
    return [batch] if rows is None else (batch.slice(at, rows) for at in range(0, len(batch), rows))


def map_slices(df: DataFrame, step, schema: str, rows: int | None = None) -> DataFrame:
    """mapInArrow: step takes an iterator of Arrow batches and gives one of dicts of columns.

    Batches are Spark's, or slices of `rows` rows at most.
    """
    import pyarrow as pa
    from pyspark.sql.pandas.types import to_arrow_schema

    ship(df.sparkSession)
    kinds = to_arrow_schema(StructType.fromDDL(schema))

    def run(batches):
        for columns in step(part for b in batches for part in sliced(b, rows)):
            yield pa.RecordBatch.from_pydict(columns, schema=kinds)

    return df.mapInArrow(run, schema)


def map_columns(df: DataFrame, step, schema: str, rows: int | None = None) -> DataFrame:
    """map_slices over columns as Python lists: step takes and gives iterators of dicts of lists."""
    return map_slices(df, lambda slices: step(part.to_pydict() for part in slices), schema, rows)


def text_column(spark: SparkSession, step, kind: str):
    """An Arrow UDF of a column of texts: step takes a text or None and gives a value of the kind."""
    import pyarrow as pa
    from pyspark.sql.pandas.functions import ArrowUDFType
    from pyspark.sql.pandas.types import to_arrow_schema

    ship(spark)
    of = to_arrow_schema(StructType.fromDDL(f"x {kind}")).field(0).type

    def run(batches):
        for b in batches:
            for part in sliced(b, ROWS):
                yield pa.array(map(step, part.to_pylist()), of)

    return F.arrow_udf(run, kind, ArrowUDFType.SCALAR_ITER)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def text_or_empty(column="text"):
    return F.coalesce(F.col(column), F.lit(""))


def lower_ascii(column):
    """A-Z in lower case; no other letter changes."""
    return F.translate(column, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def tasks(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions", "200"))
