"""Small helpers shared by the operators: reading tables, written cuts, Arrow rows."""

from __future__ import annotations

import ctypes
import uuid

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from pricebasket.session import cuts_folder

#: Code points that separate words and are stripped from lines: ``[\\x20\\x09-\\x0D]``.
BLANKS = b" \t\n\r\x0b\x0c"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def written(df: DataFrame, name: str, partition_by: tuple[str, ...] = ()) -> DataFrame:
    """``df`` as a table in the application's folder of cuts, read back: computed
    once however often it is read, and safe from a lost executor."""
    path = f"{cuts_folder(df.sparkSession)}/llm-{name}-{uuid.uuid4().hex}"
    df.write.option("compression", "zstd").partitionBy(*partition_by).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def numbered(df: DataFrame) -> DataFrame:
    """``df`` with its columns named c0, c1, ...: no name that an operator adds can clash."""
    return df.toDF(*[f"c{i}" for i in range(len(df.columns))])


def crc_mod(doc_id: str, mod: int) -> Column:
    """crc32 of the id as text, modulo ``mod``; NULL for a NULL id."""
    return F.pmod(F.crc32(F.col(doc_id).cast("string")), F.lit(mod))


def words_of(text: str | None) -> list[bytes]:
    """Words ``[^\\x20\\x09-\\x0D]+`` as UTF-8, A-Z lower-cased (bytes.split and
    bytes.lower touch exactly these ASCII characters); NULL has none."""
    return utf8(text).lower().split()


#: The operator whose tasks this Python worker last ran, and what it remembers for them.
_remembered: tuple[str, dict] = ("", {})


def remembered(operator: str) -> dict:
    """What this worker remembers from one task of ``operator`` to the next.  Spark's
    workers outlive an operator: where a task of another one begins, what was
    remembered goes and its memory back to the machine, so that a job of many
    operators holds one's at a time."""
    global _remembered
    if _remembered[0] != operator:
        _remembered = (operator, {})
        pa.default_memory_pool().release_unused()
        trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # glibc keeps what is freed
        if trim:
            trim(0)
    return _remembered[1]


def utf8(text: str | None) -> bytes:
    return (text or "").encode("utf-8", "surrogatepass")
