"""Reading panels and splits, writing splits and stage tables."""

from __future__ import annotations

import hashlib
import json
from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from panelwise.functions.scalar import null_if_nan
from panelwise.operators import columns as cols
from panelwise.operators.split import assert_disjoint
from panelwise.roles import ColumnRoles
from panelwise.session import file_state, path_exists


def nan_to_null(df: DataFrame) -> DataFrame:
    """Floating point NaN becomes NULL, the one sign for missing."""
    floats = (T.DoubleType, T.FloatType)
    fixes = {
        f.name: null_if_nan(F.col(f.name)) for f in df.schema.fields if isinstance(f.dataType, floats)
    }
    return df.withColumns(fixes) if fixes else df


def check_panel(df: DataFrame, roles: ColumnRoles) -> DataFrame:
    """Entity as string, at most two label values, NaN as NULL.

    The label check reads at most three distinct values.
    """
    cols.require_columns(df, [roles.entity, roles.label])
    values = df.select(roles.label).na.drop().distinct().limit(3).count()
    if values > 2:
        raise ValueError(f"more than two values in {roles.label}")
    return nan_to_null(df.withColumn(roles.entity, F.col(roles.entity).cast("string")))


def _as_struct(schema: T.StructType | str) -> T.StructType:
    return T.StructType.fromDDL(schema) if isinstance(schema, str) else schema


def file_columns(spark: SparkSession, path: str, fmt: str = "csv") -> list[str]:
    """Column names of a file; of a CSV file only the header line is read."""
    reader = spark.read.option("header", True) if fmt == "csv" else spark.read
    return reader.format(fmt).load(path).columns


def load_panel(
    spark: SparkSession, path: str, schema: T.StructType | str, roles: ColumnRoles, fmt: str = "csv"
) -> DataFrame:
    """Read the columns of ``schema`` by name from CSV with header, or parquet.

    Spark matches a CSV schema by position, so the header says which type goes
    where.  A cell that is not of its type ends the read.  Columns the schema does not name are not read.
    """
    if not path_exists(spark, path):
        raise FileNotFoundError(path)
    wanted = _as_struct(schema)
    reader = spark.read.schema(wanted)
    if fmt == "csv":
        types = {f.name: f.dataType for f in wanted.fields}
        header = file_columns(spark, path, fmt)
        missing = [c for c in types if c not in header]
        if missing:
            raise ValueError(f"missing required columns: {missing}")
        laid = T.StructType([T.StructField(c, types.get(c, T.StringType())) for c in header])
        reader = spark.read.schema(laid).option("header", True).option("enforceSchema", False).option("mode", "FAILFAST")
    return check_panel(reader.format(fmt).load(path).select(*wanted.names), roles)


def load_splits(
    spark: SparkSession,
    paths: Mapping[str, str],
    schema: T.StructType | str,
    roles: ColumnRoles,
    fmt: str = "csv",
) -> DataFrame:
    """Read named splits into one tagged frame; columns must match and entities be disjoint."""
    for path in paths.values():
        if not path_exists(spark, path):
            raise FileNotFoundError(path)
    if len({frozenset(file_columns(spark, path, fmt)) for path in paths.values()}) > 1:
        raise ValueError("column mismatch between splits")
    parts = [
        load_panel(spark, path, schema, roles, fmt).withColumn("split", F.lit(name))
        for name, path in paths.items()
    ]
    tagged = parts[0]
    for part in parts[1:]:
        tagged = tagged.unionByName(part)
    return assert_disjoint(tagged, roles)


def write_splits(tagged: DataFrame, path: str, fmt: str = "parquet") -> None:
    """One write for all splits; the split is the partition folder."""
    writer = tagged.write.partitionBy("split")
    if fmt == "csv":
        writer = writer.option("header", True)
    writer.format(fmt).save(path)


def stage_table(
    spark: SparkSession, root: str, stage: str, config: Mapping, build: Callable[[], DataFrame],
    inputs: Sequence[str] = (),
) -> DataFrame:
    """Table of a stage, built once per configuration and state of its inputs.

    The folder carries a digest of the configuration and of the names, sizes and
    change times of the files under ``inputs``, so the same settings on the same
    files find the table again and others do not.  ``_SUCCESS`` marks a whole table.
    """
    state = [config, [file_state(spark, path) for path in inputs]]
    digest = hashlib.sha256(json.dumps(state, sort_keys=True, default=str).encode()).hexdigest()[:16]
    path = f"{root.rstrip('/')}/{stage}-{digest}"
    if not path_exists(spark, f"{path}/_SUCCESS"):
        build().write.mode("overwrite").parquet(path)
    return spark.read.parquet(path)
