"""Token counts as delta-maintained rollups.

A batch of changes holds rows with a sign: +1 for a document's arrival, -1 for its removal, and both for a revision
(the old row with -1, the new one with +1). Its counts per source, language and tokenizer version are additive, so
totals are sums over the committed batches. A batch is committed once under its id: it is written to a folder of an attempt
and then renamed to its own, which fails if that is there already. So a batch that has been committed is not applied
again, one of two writers with the same id loses, and what a job that died has left counts for nothing.

``compact`` adds the totals of all batches so far to a base, which is committed the same way; totals are then read from the
latest base and the batches after it, and ``prune`` frees the data of batches that a base holds. Renaming a folder has
to be atomic, as on HDFS or a local file system.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator, Mapping

import pyarrow as pa
from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sieveline.llm import bpe
from sieveline.llm.common import prepare, remove

KEYS = ["source", "lang", "tokenizer"]
COUNTS = ["n_docs", "n_tokens", "n_chars", "n_bytes"]


def token_counts(df: DataFrame, tokenizers: Mapping[str, tuple[str, str | None]], *, text_col: str = "text") -> DataFrame:
    """Per row and tokenizer version: source, lang, sign, tokenizer and the four counts.

    ``df`` has source, lang and the text, and a sign column or else +1 for each row. Null text counts as an empty
    one; null source or language is a group of its own; repeated rows count as often as they occur; a null sign is
    0 and changes nothing. Other columns are not read.
    """
    prepare(df.sparkSession)
    sign = F.coalesce(F.col("sign").cast("long"), F.lit(0)) if "sign" in df.columns else F.lit(1).cast("long")
    kinds = dict(tokenizers)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = ["" if t is None else t for t in batch.column(3).to_pylist()]
            chars, size = pa.array(map(len, texts), pa.int64()), pa.array([len(t.encode()) for t in texts], pa.int64())
            for version, n in zip(kinds, bpe.counter(tuple(kinds.values())).of(texts), strict=True):
                yield pa.RecordBatch.from_arrays([*batch.columns[:3], pa.array([version] * len(texts), pa.string()), pa.array(n, pa.int64()), chars, size], ["source", "lang", "sign", "tokenizer", "n_tokens", "n_chars", "n_bytes"])

    slim = df.select(F.col("source").cast("string").alias("source"), F.col("lang").cast("string").alias("lang"), sign.alias("sign"), F.col(text_col).alias("text"))
    return slim.mapInArrow(run, "source string, lang string, sign long, tokenizer string, n_tokens long, n_chars long, n_bytes long")


_TOTALS = ", ".join([*[f"{k} string" for k in KEYS], *[f"{c} long" for c in COUNTS]])


class Rollup:
    """Additive totals in a folder that driver and executors share."""

    def __init__(self, spark: SparkSession, path: str) -> None:
        self.spark, self.path = prepare(spark), path.rstrip("/")

    def _fs(self, path: str):
        where = self.spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
        return where.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()), where

    def _commit(self, attempt: str, name: str) -> bool:
        """Rename an attempt's folder; False, and nothing has changed, if one of that name is there."""
        context = self.spark.sparkContext
        hadoop = context._jvm.org.apache.hadoop.fs
        at = hadoop.Path(attempt)
        try:
            files = hadoop.FileContext.getFileContext(at.getFileSystem(context._jsc.hadoopConfiguration()).makeQualified(at).toUri(), context._jsc.hadoopConfiguration())
            files.rename(at, hadoop.Path(f"{self.path}/{name}"), context._gateway.new_array(getattr(hadoop, "Options$Rename"), 0))
        except Py4JJavaError as error:
            if not error.java_exception.getClass().getSimpleName() == "FileAlreadyExistsException":
                raise
            remove(self.spark, attempt)
            return False
        return True

    def _names(self, kind: str) -> list[str]:
        fs, where = self._fs(self.path)
        found = [s.getPath().getName() for s in fs.listStatus(where)] if fs.exists(where) else []
        return sorted(b.removeprefix(kind) for b in found if b.startswith(kind))

    def committed(self, batch: str) -> bool:
        fs, where = self._fs(f"{self.path}/batch={batch}")
        return fs.exists(where)

    def apply(self, batch: str, changes: DataFrame, tokenizers: Mapping[str, tuple[str, str | None]]) -> bool:
        """Commit signed rows under a batch id (letters, digits, '.', '_', '-'); False if it had been committed."""
        if not batch or not all(c.isalnum() or c in "._-" for c in batch):
            raise ValueError(f"not a batch id: {batch!r}")
        if self.committed(batch):
            return False
        signed = [F.sum(F.col("sign")).alias("n_docs"), *[F.sum(F.col("sign") * F.col(c)).alias(c) for c in COUNTS[1:]]]
        attempt = f"{self.path}/attempt-{uuid.uuid4().hex}"
        token_counts(changes, tokenizers).groupBy(*KEYS).agg(*signed).write.parquet(attempt)
        return self._commit(attempt, f"batch={batch}")

    def batches(self) -> list[str]:
        return self._names("batch=")

    def _state(self) -> tuple[int, list[str], list[str]]:
        """The latest base (0: none), the batches it holds and those after it."""
        last = max(map(int, self._names("base=")), default=0)
        held = [r[0] for r in self.spark.read.parquet(f"{self.path}/base={last}/batches").collect()] if last else []
        return last, held, [b for b in self.batches() if b not in set(held)]

    def _sums(self, last: int, batches: list[str]) -> DataFrame:
        paths = [f"{self.path}/base={last}/totals"] * bool(last) + [f"{self.path}/batch={b}" for b in batches]
        deltas = self.spark.read.schema(_TOTALS).parquet(*paths) if paths else self.spark.createDataFrame([], _TOTALS)
        sums = deltas.groupBy(*KEYS).agg(*[F.sum(c).alias(c) for c in COUNTS])
        return sums.where(" or ".join(f"{c} <> 0" for c in COUNTS))

    def totals(self) -> DataFrame:
        """source, lang, tokenizer and the four totals, over committed batches; groups that have come to nothing go."""
        last, _, after = self._state()
        return self._sums(last, after)

    def compact(self) -> bool:
        """Commit the next base, with all batches so far; False if there is nothing new or another writer was first."""
        last, held, after = self._state()
        if not after:
            return False
        attempt = f"{self.path}/attempt-{uuid.uuid4().hex}"
        self._sums(last, after).write.parquet(f"{attempt}/totals")
        self.spark.createDataFrame([(b,) for b in held + after], "batch string").coalesce(1).write.parquet(f"{attempt}/batches")
        return self._commit(attempt, f"base={last + 1}")

    def prune(self) -> None:
        """Free the data of batches that the latest base holds, and earlier bases; the batches stay committed."""
        last, held, _ = self._state()
        for batch in held:
            fs, where = self._fs(f"{self.path}/batch={batch}")
            for status in fs.listStatus(where):
                if status.getPath().getName().startswith("part-"):
                    fs.delete(status.getPath(), False)
        for base in self._names("base="):
            if int(base) < last:
                remove(self.spark, f"{self.path}/base={base}")


#: Keys of copies up to this number are broadcast (a digest and an id each); more are joined by a shuffle.
BROADCAST_COPIES = 200_000


def copies(df: DataFrame, at: str, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The texts that several rows hold: digest and the smallest id, written to ``at``. Null texts and ids are no copies."""
    spark = df.sparkSession
    rows = df.where(F.col(text_col).isNotNull() & F.col(id_col).isNotNull()).select(F.sha2(F.col(text_col), 256).alias("digest"), F.col(id_col).alias("first"))
    rows.groupBy("digest").agg(F.min("first").alias("first"), F.max("first").alias("last")).where("first < last").select("digest", "first").write.parquet(at)
    found = spark.read.parquet(at)
    return F.broadcast(found) if found.count() <= BROADCAST_COPIES else found
