"""What the operators of this subpackage share: written intermediate tables, Python path, word hashing."""

from __future__ import annotations

import atexit
import os
import tempfile
import uuid
from pathlib import Path

import numpy as np
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import IntegralType, NullType

_ROOT = str(Path(__file__).resolve().parents[2])


def prepare(spark: SparkSession) -> SparkSession:
    """Let Python workers import this package, wherever the driver was started."""
    env = spark.sparkContext.environment
    paths = [p for p in env.get("PYTHONPATH", "").split(os.pathsep) if p]
    if _ROOT not in paths:
        env["PYTHONPATH"] = os.pathsep.join([_ROOT, *paths])
    env.setdefault("TOKENIZERS_PARALLELISM", "false")
    return spark


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share: spark.checkpoint.dir, or where it is unset in local mode one of our own."""
    at = spark.conf.get("spark.checkpoint.dir", None)
    if not at:
        master = spark.sparkContext.master
        if master != "local" and not master.startswith("local["):
            raise RuntimeError("set spark.checkpoint.dir to a folder that driver and executors share")
        at = spark.conf.get("spark.sieveline.own.dir", None)
        if not at:
            at = tempfile.mkdtemp(prefix="sieveline-")
            spark.conf.set("spark.sieveline.own.dir", at)
    return at.rstrip("/")


def integral(df: DataFrame, column: str) -> DataFrame:
    """``df``, whose ids have to be whole numbers: of a text as id a cast to long would make a null."""
    kind = df.schema[column].dataType
    if not isinstance(kind, IntegralType | NullType):
        raise TypeError(f"{column} has to be an integer column, not {kind.simpleString()}")
    return df


def remove(spark: SparkSession, path: str) -> None:
    jvm = spark.sparkContext._jvm
    where = jvm.org.apache.hadoop.fs.Path(path)
    where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(where, True)


class Scratch:
    """Intermediate tables of one call, written as Parquet in the shared folder.

    Writing cuts the lineage, so a lost executor costs its own tasks and not the whole history. Tables are kept
    until the application ends, for the returned frame reads the last of them lazily; ``drop`` frees one early.
    """

    def __init__(self, spark: SparkSession, name: str) -> None:
        self.spark = prepare(spark)
        self.at = f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"
        atexit.register(self._clean)

    def table(self, df: DataFrame, name: str, *, thin: bool = False) -> DataFrame:
        """``thin``: a table of few bytes per row of its input, in an eighth as many files as there are shuffle partitions."""
        if thin:
            df = df.coalesce(max(1, int(self.spark.conf.get("spark.sql.shuffle.partitions")) // 8))
        df.write.mode("overwrite").parquet(f"{self.at}/{name}")
        return self.read(name, df)

    def read(self, name: str, like: DataFrame) -> DataFrame:
        return self.spark.read.schema(like.schema).parquet(f"{self.at}/{name}")

    def drop(self, *names: str) -> None:
        for name in names:
            remove(self.spark, f"{self.at}/{name}")

    def _clean(self) -> None:
        try:
            if self.spark.sparkContext._jsc is not None:
                remove(self.spark, self.at)
        except Exception:  # noqa: BLE001  the session has gone already; nothing is left to clean with
            pass


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return prepare(spark).read.parquet(f"{sf_dir}/{name}.parquet")


def text_or_empty(col: str = "text"):
    return F.coalesce(F.col(col).cast("string"), F.lit(""))


class WordHash(dict):
    """64-bit hashes of words; the most recent vocabulary is kept, up to ``limit`` entries, to spare hashing it again."""

    def __init__(self, limit: int = 150_000) -> None:
        super().__init__()
        self.limit = limit

    def __missing__(self, word: bytes) -> int:
        h = xxhash.xxh3_64_intdigest(word)
        if len(self) >= self.limit:
            self.clear()
        if len(word) <= 64:
            self[word] = h
        return h

    def of(self, words: list[bytes]) -> np.ndarray:
        return np.fromiter(map(self.__getitem__, words), np.uint64, count=len(words))


#: One per Python worker.
WORDS = WordHash()

_C1, _C2 = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)
_S30, _S27, _S31 = np.uint64(30), np.uint64(27), np.uint64(31)


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective finaliser on 64-bit words."""
    x = (x ^ (x >> _S30)) * _C1
    x = (x ^ (x >> _S27)) * _C2
    return x ^ (x >> _S31)


#: Odd, so that it has an inverse modulo 2**64.
BASE = 0x9E3779B97F4A7C15


def windows_hash(h: np.ndarray, n: int) -> np.ndarray:
    """Hashes of all n-word windows of a word-hash sequence, by doubling; shorter sequences have none."""
    if len(h) < n:
        return np.empty(0, np.uint64)
    with np.errstate(over="ignore"):
        out, have, piece, width = None, 0, h, 1
        while True:
            if n & width:  # out covers `have` words; append this piece
                if out is None:
                    out, have = piece, width
                else:
                    m = len(h) - have - width + 1
                    out = out[:m] * np.uint64(pow(BASE, width, 2**64)) + piece[have : have + m]
                    have += width
            if have == n:
                return mix(out)
            m = len(piece) - width
            piece = piece[:m] * np.uint64(pow(BASE, width, 2**64)) + piece[width : width + m]
            width *= 2
