"""Shared helpers of the text operators."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tramline.session import scratch_dir

# Rows per Arrow batch for operators that run Python over whole texts: a batch of
# the longest texts (about 120 kB each) stays near 60 MB.
ARROW_ROWS = 512


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def keep_columns(df: DataFrame, added: list[str]) -> list[str]:
    """Input columns that survive next to ``added``: a clashing name gives way."""
    taken = {a.lower() for a in added}
    return [c for c in df.columns if c.lower() not in taken]


def carried(df: DataFrame, *named: str) -> DataFrame:
    """The named columns of ``df`` and all others in one struct, out of reach of names
    that an operator adds; ``restored`` takes them out again."""
    others = [df[c] for c in df.columns if c not in named] or [F.lit(1).alias("none")]
    return df.select(*[df[c] for c in named], F.struct(*others).alias("__row__"))


def restored(made: DataFrame, df: DataFrame, *named: str) -> DataFrame:
    """The columns of ``df``, the named ones as they are in ``made``."""
    return made.select(*[made[c] if c in named else made["__row__"][c].alias(c) for c in df.columns])


def map_texts(
    df: DataFrame,
    column: str,
    added: list[T.StructField],
    start: Callable[[], Callable[[pa.Array], list[pa.Array]]],
) -> DataFrame:
    """Append columns computed from one column, Arrow batch by Arrow batch.

    ``start()`` runs once per task and returns the function that turns the
    column's Arrow array into one array per added field. Input columns with the
    name of an added one are dropped (names compare without case, as in Spark);
    all others pass through unchanged.
    """
    kept = keep_columns(df, [f.name for f in added])
    passed = [c for c in kept if c != column] if column in kept else kept
    slim = df.select(df[column].alias("__input__"), *[df[c] for c in passed])
    fields = [df.schema[c] for c in passed] + list(added)
    if column in kept:
        fields = [df.schema[column], *fields]
    with_input = column in kept
    types = [f.dataType for f in added]
    out_names = [f.name for f in fields]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark.sql.pandas.types import to_arrow_type

        arrow_types = [to_arrow_type(t) for t in types]
        fn = None
        for batch in batches:
            if not batch.num_rows:
                continue
            fn = fn or start()
            made = [x if x.type == t else x.cast(t)
                    for x, t in zip(fn(batch.column(0)), arrow_types, strict=True)]
            old = batch.columns if with_input else batch.columns[1:]
            yield pa.RecordBatch.from_arrays([*old, *made], names=out_names)

    df.sparkSession.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(ARROW_ROWS))
    return slim.mapInArrow(run, T.StructType(fields)).select(
        *[c for c in df.columns if c in kept], *[f.name for f in added])


def stored(df: DataFrame, name: str, *by: str) -> DataFrame:
    """``df`` written to and read from the shared checkpoint folder: cuts the lineage.
    Columns in ``by`` become folders, so that filters on them read only their rows."""
    path = scratch_dir(df.sparkSession, name)
    df.write.mode("overwrite").partitionBy(*by).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def merge_groups(label: np.ndarray, i: np.ndarray, j: np.ndarray) -> None:
    """Join the groups of linked positions; ``label`` has each one's smallest member so far."""
    while True:
        a, b = label[i], label[j]
        open_ = a != b
        if not open_.any():
            return
        i, j, a, b = i[open_], j[open_], a[open_], b[open_]
        np.minimum.at(label, np.maximum(a, b), np.minimum(a, b))
        while True:
            up = label[label]
            if np.array_equal(up, label):
                break
            label[:] = up


def field(name: str, ddl: str) -> T.StructField:
    return T.StructField(name, T._parse_datatype_string(ddl) if ddl not in _SIMPLE else _SIMPLE[ddl])


_SIMPLE: dict[str, T.DataType] = {
    "long": T.LongType(), "int": T.IntegerType(), "string": T.StringType(),
    "boolean": T.BooleanType(), "double": T.DoubleType(), "binary": T.BinaryType(),
    "array<int>": T.ArrayType(T.IntegerType()), "array<string>": T.ArrayType(T.StringType()),
    "array<double>": T.ArrayType(T.DoubleType()),
}
