"""Shared helpers of the training-data operators."""

from __future__ import annotations

import atexit
import shutil
import tempfile
import threading
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: A word is a run of characters outside this class.
SPACE = r"[ \x09-\x0D]"
WORD = r"[^ \x09-\x0D]+"

_own: list[str] = []


class _Made(threading.local):
    """What cut() has written, by thread: operators that run side by side don't delete each other's tables."""

    def __init__(self) -> None:
        self.paths: list[str] = []
        self.of: dict[int, tuple[DataFrame, str]] = {}


_made = _Made()


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share: spark.checkpoint.dir.

    Where the setting is absent, a local session gets a folder of its own;
    a cluster session must set it."""
    path = spark.conf.get("spark.checkpoint.dir", None)
    if path:
        return path.rstrip("/")
    if not spark.sparkContext.master.startswith("local["):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    if not _own:
        _own.append(tempfile.mkdtemp(prefix="cliplake-"))
        atexit.register(shutil.rmtree, _own[0], ignore_errors=True)
    return f"file://{_own[0]}"


def cut(df: DataFrame, name: str = "cut") -> DataFrame:
    """Write df as Parquet in the shared folder and read it again.

    That cuts the lineage so that a lost executor costs a file read, gives the
    planner true sizes, and leaves a plain exchange on either side of a later
    join, which adaptive execution can split if a key is hot."""
    path = f"{shared_dir(df.sparkSession)}/cliplake/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    _made.paths.append(path)
    out = df.sparkSession.read.schema(df.schema).parquet(path)
    _made.of[id(out)] = (out, path)
    return out


def spread(df: DataFrame, key: str) -> DataFrame:
    """df dealt by `key` over as many partitions as shuffles have: for few bytes with much work each."""
    return df.repartition(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), key)


def mark() -> int:
    return len(_made.paths)


def sweep(spark: SparkSession, since: int, *keep: DataFrame) -> None:
    """Delete what cut() has written since mark() in this thread, but for the tables in keep.

    For the end of an operator, when all that it needs later has been cut. What a
    result that is computed later still reads stays in the shared folder."""
    stay = {_made.of[id(df)][1] for df in keep}
    for path in _made.paths[since:]:
        if path not in stay:
            where = spark._jvm.org.apache.hadoop.fs.Path(path)
            where.getFileSystem(spark._jsc.hadoopConfiguration()).delete(where, True)
    _made.paths[since:] = [p for p in _made.paths[since:] if p in stay]
    for key in [k for k, (_, p) in _made.of.items() if p not in _made.paths]:
        del _made.of[key]


def text_of(docs: DataFrame, column: str = "text") -> Column:
    """The whole text; null counts as empty."""
    return F.coalesce(docs[column].cast("string"), F.lit(""))


def keyed(docs: DataFrame) -> DataFrame:
    """doc_id, text and a hash of both: rows that agree in both are one document.

    Only these columns go on, so that no other column can clash."""
    text = text_of(docs)
    return docs.select(docs["doc_id"].cast("long").alias("doc_id"), text.alias("text"), F.xxhash64(docs["doc_id"].cast("long"), text).alias("row_hash"))


def same_row(a: DataFrame, b: DataFrame) -> Column:
    return a["doc_id"].eqNullSafe(b["doc_id"]) & (a["row_hash"] == b["row_hash"])


#: Bitmaps of 4 KB in 2^11 buckets: 8 MB.
_BUCKET_BITS = 11


def maybe_in(rows: DataFrame, key: str, few: DataFrame, of: str) -> DataFrame:
    """Rows whose 64-bit hash `key` may be in few.of: all that are, and some that aren't.

    few becomes bitmaps in at most 2^11 buckets, which is all that is broadcast,
    whatever the size of few. Before an exact semi join, so that most text stays
    where it is. If few is empty, no row is left; null hashes are in nothing."""
    bucket = lambda h: F.shiftrightunsigned(h, 64 - _BUCKET_BITS).cast("int")
    place = lambda h: h.bitwiseAND(F.lit(32767)).cast("int")
    maps = few.groupBy(bucket(F.col(of)).alias("_bucket")).agg(F.bitmap_construct_agg(place(F.col(of)).cast("bigint")).alias("_bits"))
    byte = F.conv(F.hex(F.substr("_bits", F.floor(place(F.col(key)) / 8).cast("int") + 1, F.lit(1))), 16, 10).cast("bigint")
    held = rows.join(F.broadcast(maps), bucket(F.col(key)) == F.col("_bucket"))
    return held.where(F.getbit(byte, place(F.col(key)) % 8) == 1).drop("_bucket", "_bits")


def small(df: DataFrame, rows: int = 10_000) -> DataFrame:
    """df with a broadcast hint if it is known to have at most so many rows; else as it is."""
    return F.broadcast(df) if df.limit(rows + 1).count() <= rows else df
