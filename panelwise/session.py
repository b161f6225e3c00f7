"""Session settings and tables that cut lineage.

Intermediate results that are read more than once are written as parquet to the
folder named by ``spark.checkpoint.dir``.  A written table survives lost
executors and is read back with column pruning.
"""

from __future__ import annotations

import tempfile
import uuid
import zipfile
from pathlib import Path

import pyarrow as pa
from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

_LOCAL_ROOTS: dict[str, str] = {}
_SHIPPED: set[str] = set()

SESSION_DEFAULTS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


def tune(spark: SparkSession) -> SparkSession:
    """Apply the runtime settings the operators rely on; send the package to the executors."""
    _ship(spark)
    for key, value in SESSION_DEFAULTS.items():
        if spark.conf.get(key, None) != value:
            spark.conf.set(key, value)
    return spark


def _ship(spark: SparkSession) -> None:
    """Give the executors this package, so that their Python finds it wherever they started."""
    context = spark.sparkContext
    if context.applicationId in _SHIPPED:
        return
    _SHIPPED.add(context.applicationId)
    package = Path(__file__).resolve().parent
    if not package.is_dir():
        return
    archive = Path(tempfile.mkdtemp(prefix="panelwise-")) / "panelwise.zip"
    with zipfile.ZipFile(archive, "w") as out:
        for source in sorted(package.rglob("*.py")):
            out.write(source, source.relative_to(package.parent).as_posix())
    context.addPyFile(str(archive))


def scratch_root(spark: SparkSession) -> str:
    """Shared folder for intermediate tables.

    A local folder is made only for a local master; on a cluster a missing
    ``spark.checkpoint.dir`` is an error, since executors share no disk.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if root:
        return root.rstrip("/")
    context = spark.sparkContext
    if not context.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
    app = context.applicationId
    if app not in _LOCAL_ROOTS:
        _LOCAL_ROOTS[app] = tempfile.mkdtemp(prefix="panelwise-")
    return _LOCAL_ROOTS[app]


def materialize(df: DataFrame, name: str = "table") -> DataFrame:
    """Write ``df`` once and return a DataFrame that reads the written table."""
    spark = df.sparkSession
    path = f"{session_folder(spark)}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def session_folder(spark: SparkSession) -> str:
    """Where this session's intermediate tables are, until ``drop_scratch``."""
    return f"{scratch_root(spark)}/panelwise-{spark.sparkContext.applicationId}"


def drop_scratch(spark: SparkSession) -> None:
    """Remove the intermediate tables of this session; frames read from them end."""
    remove_path(spark, session_folder(spark))


def remove_path(spark: SparkSession, path: str) -> bool:
    """Delete a folder through the Hadoop file system that owns it."""
    jvm = spark.sparkContext._jvm
    target = jvm.org.apache.hadoop.fs.Path(path)
    fs = target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return bool(fs.delete(target, True))


def create_file(spark: SparkSession, path: str) -> bool:
    """Create an empty file; False if there is one already.  One of several callers succeeds."""
    jvm = spark.sparkContext._jvm
    target = jvm.org.apache.hadoop.fs.Path(path)
    fs = target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    fs.mkdirs(target.getParent())
    try:
        fs.create(target, False).close()
    except Py4JJavaError as error:
        if fs.exists(target):
            return False
        raise error
    return True


def file_state(spark: SparkSession, path: str) -> list[tuple[str, int, int]]:
    """Name, size and change time of every file under a path."""
    jvm = spark.sparkContext._jvm
    target = jvm.org.apache.hadoop.fs.Path(path)
    fs = target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    files, out = fs.listFiles(target, True), []
    while files.hasNext():
        status = files.next()
        out.append((status.getPath().toString(), status.getLen(), status.getModificationTime()))
    return sorted(out)


def path_exists(spark: SparkSession, path: str) -> bool:
    jvm = spark.sparkContext._jvm
    target = jvm.org.apache.hadoop.fs.Path(path)
    fs = target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return bool(fs.exists(target))


def broadcast_if_small(df: DataFrame, max_rows: int = 100_000) -> DataFrame:
    """Broadcast a narrow frame when it has at most ``max_rows`` rows.

    The rows are fetched to find out, at most one above the limit, and then used
    as they are.  Above the limit the frame is returned as it was, without a
    hint, and Spark shuffles it.
    """
    rows = df.limit(max_rows + 1).toArrow()
    if rows.num_rows > max_rows:
        return df
    return F.broadcast(df.sparkSession.createDataFrame(rows, df.schema))


def small_frame(spark: SparkSession, rows: list[tuple], schema: str) -> DataFrame:
    """Frame of a few driver-side rows, sent as one Arrow table."""
    struct = StructType.fromDDL(schema)
    arrow = to_arrow_schema(struct)
    columns = list(zip(*rows)) if rows else [[] for _ in arrow]
    arrays = [pa.array(list(c), type=f.type) for c, f in zip(columns, arrow)]
    return spark.createDataFrame(pa.Table.from_arrays(arrays, schema=arrow), struct)
