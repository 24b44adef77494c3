"""Helpers the operators of this package share: shared folders, lineage cuts, text in Arrow batches."""

from __future__ import annotations

import ctypes
import tempfile
import uuid
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Rows that are held as Python objects at a time; a batch of Arrow rows is cut into such slices.
SLICE_ROWS = 256
# Rows of an Arrow batch at most.
BATCH_ROWS = 1024


def shared_root(spark: SparkSession) -> str:
    """The folder all executors share, from `spark.checkpoint.dir`.

    Only a local master may go without it; there a temporary folder becomes the setting.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if root:
        return root.rstrip("/")
    if not spark.sparkContext.master.split("[")[0] == "local":
        raise ValueError("spark.checkpoint.dir must name a folder that driver and executors share")
    made = spark.sparkContext._jsc.sc().getCheckpointDir()
    return made.get() if made.isDefined() else tempfile.mkdtemp(prefix="checkpoints-")


def cut(df: DataFrame) -> DataFrame:
    """`df` written to the shared checkpoint folder; what follows starts from those files."""
    context = df.sparkSession.sparkContext
    if context._jsc.sc().getCheckpointDir().isEmpty():
        context.setCheckpointDir(f"{shared_root(df.sparkSession)}/{uuid.uuid4().hex}")
    return df.checkpoint(eager=True)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def bucket(id_col: str, modulus: int) -> Column:
    """crc32 of the id as text, modulo; null for a null id."""
    return F.crc32(F.col(id_col).cast("string").cast("binary")) % modulus


def give_back() -> None:
    """Return what this process has freed to the system.

    A Python worker goes on from stage to stage, and what its C library holds free counts beside the JVM's heap.
    """
    pa.default_memory_pool().release_unused()
    if trim := getattr(ctypes.CDLL(None), "malloc_trim", None):  # glibc
        trim(0)


def slices(batches: Iterator[pa.RecordBatch], rows: int = SLICE_ROWS) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for start in range(0, batch.num_rows, rows):
            yield batch.slice(start, rows)
    give_back()


def pieces(arrays: Iterator[pa.Array], rows: int = SLICE_ROWS) -> Iterator[tuple[pa.Array, list[tuple[int, int]]]]:
    """Each array of an Arrow UDF with the (start, length) of its slices."""
    for array in arrays:
        yield array, [(s, min(rows, len(array) - s)) for s in range(0, len(array), rows)]
    give_back()


def mix64(x: np.ndarray) -> np.ndarray:
    """A bijective mix of unsigned 64-bit numbers (the finaliser of splitmix64)."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def bounded_sample(rows: DataFrame, label: str, key: str, most: int) -> DataFrame:
    """About `most` rows of each value of `label`, those with the smallest hash of `key`.

    A share is worked out per label from its count and applied as a filter on the hash, so no label's
    rows meet in one task. Labels with fewer rows come whole. Rows without a label or a key go.
    Rows with the same key come together or not at all.
    """
    rows = rows.where(F.col(label).isNotNull() & F.col(key).isNotNull())
    counts = {r[0]: r[1] for r in rows.groupBy(label).count().collect()}
    spot = F.xxhash64(F.col(key), F.lit(17)) / F.lit(2.0**64) + F.lit(0.5)
    kept = F.lit(False)
    for value, n in sorted(counts.items()):
        kept = kept | ((F.col(label) == F.lit(value)) & (spot < F.lit(min(1.0, most / n) * (1 + 1e-9))))
    return rows.where(kept)


def bound_batches(spark: SparkSession, rows: int = BATCH_ROWS) -> None:
    """Let no Arrow batch have more rows than that: whole texts go to Python, and a task holds a batch twice."""
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if not 0 < int(spark.conf.get(key)) <= rows:
        spark.conf.set(key, rows)


class Shared:
    """Something of bounded size that is sent to each executor once."""

    def __init__(self, value: object) -> None:
        spark = SparkSession.getActiveSession()
        bound_batches(spark)
        self._sent = spark.sparkContext.broadcast(cloudpickle.dumps(value))

    def get(self) -> object:
        return cloudpickle.loads(self._sent.value)


def fit_in_task(rows: DataFrame, fit: Callable[[list[tuple]], object]) -> object:
    """`fit` applied to all of `rows`, a bounded sample, inside one task; only the model comes to the driver.

    The rows are sorted first, so the model does not depend on how they were dealt out.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        gathered: list[tuple] = []
        for batch in batches:
            gathered += zip(*(c.to_pylist() for c in batch.columns), strict=True)
        yield pa.RecordBatch.from_pydict({"model": pa.array([cloudpickle.dumps(fit(sorted(gathered)))], pa.binary())})

    found = rows.repartition(1).mapInArrow(run, "model binary").collect()
    return cloudpickle.loads(bytes(found[0][0])) if found else fit([])


def labelled_sample(
    documents: DataFrame,
    labels: DataFrame,
    label: str,
    most: int,
    chars: int,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """(text, y) of about `most` rows per label, y being 0 or 1.

    Only labels are sampled and joined, so documents without a sampled label never move. Texts longer
    than `chars` characters, nulls and labels other than 0 and 1 are left out; of several labels of one
    document the largest counts. The bound is `2 * most` texts of `chars` characters.
    """
    known = labels.select(F.col(id_col).alias("id"), F.col(label).cast("int").alias("y")).where("y in (0, 1)")
    sample = bounded_sample(known, "y", "id", most).groupBy("id").agg(F.max("y").alias("y"))
    texts = documents.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    texts = texts.where(F.col("text").isNotNull() & (F.length("text") <= chars))
    return texts.join(F.broadcast(sample), "id").select("text", "y")
