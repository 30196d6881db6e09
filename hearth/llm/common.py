"""Helpers shared by the text operators: scratch tables, Arrow passes over texts, column names."""

from __future__ import annotations

import re
import sys
import uuid
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import scratch_path

#: A word in every contract of this package: a run of anything but ASCII blanks.
WORD = r"[^\x20\x09-\x0D]+"

#: Rows of an Arrow batch handled at once in Python (bounds what a worker holds as Python objects).
SLICE_ROWS = 256


def write_scratch(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to a fresh table in the shared checkpoint folder and read it back.

    Cuts lineage the durable way: a lost executor costs a re-read, not a recomputation.
    """
    spark = df.sparkSession
    path = scratch_path(spark, f"llm/{name}-{uuid.uuid4().hex}")
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def fresh(df: DataFrame, base: str) -> str:
    """A column name starting with ``base`` that ``df`` does not have (Spark's names ignore case)."""
    have, name = {c.lower() for c in df.columns}, base
    while name.lower() in have:
        name = f"_{name}"
    return name


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


#: Bounds of an Arrow batch: rows, and bytes (a batch is closed once it holds so many).
BATCH_ROWS, BATCH_BYTES = 1000, 8 << 20


def small_batches(spark: SparkSession) -> None:
    """Bound Arrow batches by rows and by bytes, so that very long texts don't add up in a worker.

    A batch is made when the job runs, so the session keeps the bounds; smaller ones of its own stay.
    """
    for key, most in (("maxRecordsPerBatch", BATCH_ROWS), ("maxBytesPerBatch", BATCH_BYTES)):
        key = f"spark.sql.execution.arrow.{key}"
        if not 0 < int(re.match(r"-?\d+", spark.conf.get(key))[0]) <= most:
            spark.conf.set(key, str(most))


#: A value counts as hot from this share of the rows (so at most ``HOT_PARTS`` values can be), and is dealt to so many parts.
HOT_PARTS, SALTS = 1000, 64


def hot_values(counted: DataFrame, key: str, n: str) -> list:
    """Values of ``key`` that hold at least a thousandth of the rows, by their counts ``n``: 1,000 values at most."""
    total = counted.agg(F.sum(n)).first()[0] or 0
    return [r[0] for r in counted.where((F.col(n) > 1) & (F.col(n) * HOT_PARTS >= total)).select(key).collect()]


def salted_join(rows: DataFrame, table: DataFrame, key: str, hot: list) -> DataFrame:
    """``rows`` inner join ``table`` on ``key``, unique in ``table``: rows of a hot value are dealt over ``SALTS`` keys.

    ``rows`` should be a written table: a row's part follows from its place there.
    """
    if not hot:
        return rows.join(table, key)
    salt = fresh(rows.join(table.limit(0), key), "_salt")
    is_hot = F.col(key).isin(hot)
    dealt = rows.withColumn(salt, F.when(is_hot, F.monotonically_increasing_id() % SALTS).otherwise(F.lit(0).cast("long")))
    parts = F.when(is_hot, F.array(*[F.lit(i).cast("long") for i in range(SALTS)])).otherwise(F.array(F.lit(0).cast("long")))
    every = table.withColumn(salt, F.explode(parts))
    return dealt.join(every, [key, salt]).drop(salt)


def map_batches(df: DataFrame, schema: str, fn: Callable[[Iterator[pa.RecordBatch]], Iterator[dict]]) -> DataFrame:
    """``mapInArrow``: ``fn`` takes batches and yields dicts of columns, each a list or an array."""
    small_batches(df.sparkSession)
    out = df.sparkSession.createDataFrame([], schema).schema
    names = out.fieldNames()
    from pyspark.sql.pandas.types import to_arrow_schema
    arrow = to_arrow_schema(out)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for made in fn(batches):
            yield pa.RecordBatch.from_arrays(
                [made[n] if isinstance(made[n], pa.Array) else pa.array(made[n], type=arrow.field(n).type) for n in names], schema=arrow)
    return df.mapInArrow(run, out)


def map_rows(df: DataFrame, schema: str, fn: Callable[[Iterator[dict[str, list]]], Iterator[dict[str, list]]],
             ) -> DataFrame:
    """``map_batches`` over slices of columns as Python lists: ``fn`` takes and yields dicts of lists."""
    rows = SLICE_ROWS

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        def slices():
            for b in batches:
                for at in range(0, b.num_rows, rows):
                    part = b.slice(at, rows)
                    yield {n: part.column(i).to_pylist() for i, n in enumerate(part.schema.names)}
        return fn(slices())
    return map_batches(df, schema, run)


def held_out(doc_id: Column, modulus: int, remainder: int) -> Column:
    """The contract's fold: crc32 of the id as text, modulo ``modulus`` (a null id is not held out)."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % modulus == remainder, F.lit(False))


def by_value(module: str) -> None:
    """Ship a module's functions inside the task, so that workers need no copy of this package."""
    cloudpickle.register_pickle_by_value(sys.modules[module])


def once(kept: dict, name: str, make: Callable[[], object]) -> object:
    """What ``make`` gives, made once a worker process: ``kept`` is the value of a broadcast dict, which workers hold between tasks."""
    if name not in kept:
        kept[name] = make()
    return kept[name]


class Sent:
    """An object of this package broadcast by value: a plain broadcast names its class, which workers may lack."""

    def __init__(self, spark: SparkSession, value: object):
        self._bytes = spark.sparkContext.broadcast(cloudpickle.dumps(value))

    def get(self) -> object:
        """The object, rebuilt in the task that asks for it."""
        return cloudpickle.loads(self._bytes.value)


by_value(__name__)
