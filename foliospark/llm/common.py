"""What the operators share: texts in Arrow batches, and tables that outlive an executor."""

from __future__ import annotations

import tempfile
from collections.abc import Callable, Iterator
from uuid import uuid4

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type
from pyspark.sql.types import DataType, MapType, StructType, VariantType

CHUNK_BYTES = 2 * 1024**2
UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
LOWER = UPPER.lower()


def documents(spark: SparkSession, folder: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/documents.parquet")


def chunks(texts: pa.Array, limit: int = CHUNK_BYTES) -> Iterator[list[bytes]]:
    """The texts as UTF-8, null as empty, in runs of about ``limit`` bytes. No text is cut."""
    held, size = [], 0
    for value in texts.cast(pa.binary()):
        data = value.as_py() or b""
        held.append(data)
        size += len(data)
        if size >= limit:
            yield held
            held, size = [], 0
    if held:
        yield held


def text_function(
    measure: Callable[[list[bytes]], list[dict]], returns: StructType
) -> Callable[[str | Column], Column]:
    """A column function: ``measure`` gets UTF-8 texts and returns one record for each."""
    kind = to_arrow_type(returns)

    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in batches:
            parts = [pa.array(measure(chunk), type=kind) for chunk in chunks(batch)]
            yield pa.concat_arrays(parts) if parts else pa.array([], type=kind)

    run.__annotations__ = {"batches": Iterator[pa.Array], "return": Iterator[pa.Array]}
    return F.arrow_udf(run, returnType=returns)


def schema_of(fields: str) -> StructType:
    kind = DataType.fromDDL(fields)
    assert isinstance(kind, StructType)
    return kind


def shared_folder(spark: SparkSession) -> str:
    """The folder all executors see: spark.checkpoint.dir. A local session without one gets a temporary one."""
    folder = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if folder:
        return folder.rstrip("/")
    if not spark.sparkContext.master.startswith("local["):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="foliospark-"))
    return spark.sparkContext.getCheckpointDir().rstrip("/")


def checkpointed(frame: DataFrame) -> DataFrame:
    """The frame's rows, computed once and kept in the shared folder."""
    shared_folder(frame.sparkSession)
    return frame.checkpoint()


def new_path(spark: SparkSession, name: str) -> str:
    return f"{shared_folder(spark)}/{name}-{uuid4().hex}"


def own_shuffle(frame: DataFrame, key: str) -> DataFrame:
    """Make the next join on a whole-number key start from a shuffle of its own, so that a skewed one can be split."""
    return frame.withColumn(key, F.col(key).bitwiseXOR(F.lit(0)))


def unused_name(frame: DataFrame, name: str) -> str:
    while name in frame.columns:
        name += "_"
    return name


def identified(docs: DataFrame) -> tuple[DataFrame, list[str]]:
    """The frame with two hashes of the whole row, 128 bits, and the names of those columns."""
    unhashed = (MapType, VariantType)
    columns = [F.col(f.name) for f in docs.schema.fields if not isinstance(f.dataType, unhashed)]
    names = [unused_name(docs, f"_row{n}") for n in (1, 2)]
    return docs.withColumns({name: F.xxhash64(F.lit(n), *columns) for n, name in enumerate(names)}), names


def chosen(docs: DataFrame, kept: DataFrame, names: list[str]) -> DataFrame:
    """Those of the identified rows that ``kept`` lists once each; of equal rows, one."""
    place = unused_name(docs, "_place")
    nth = F.row_number().over(Window.partitionBy(*names).orderBy(*names))
    return docs.join(kept, names).withColumn(place, nth).filter(F.col(place) == 1).drop(place, *names)
