"""What the operators share: shared-folder staging, Arrow helpers, labels of documents."""

from __future__ import annotations

import gc
import os
import tempfile
import uuid
import zipfile
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def shared_dir(spark: SparkSession) -> str:
    """The cluster's shared folder (``spark.checkpoint.dir``); a scratch one on a local master only."""
    path = spark.conf.get("spark.checkpoint.dir", None)
    if not path:
        if not spark.sparkContext.master.startswith("local["):
            raise RuntimeError("spark.checkpoint.dir must name a folder that the driver and all executors share")
        path = tempfile.mkdtemp(prefix="spendlens-shared-")
        spark.conf.set("spark.checkpoint.dir", path)
    return path.rstrip("/")


#: Staged tables after which the driver collects garbage, and with it the shuffles before them.
COLLECT_EVERY = 6
_staged = 0


def _folder(spark: SparkSession, path: str):
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    return folder.getFileSystem(spark._jsc.hadoopConfiguration()), folder


def stage(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to a fresh Parquet table in the shared folder and read it back.

    It cuts the lineage: a lost executor costs a re-read, not a recomputation. The table is
    deleted when the application ends (results are lazy and may read it until then), or by
    ``unstage``. Spark deletes the shuffle files behind it once the driver has collected
    its garbage, which is asked for now and then.
    """
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/llm-{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    files, folder = _folder(spark, path)
    files.deleteOnExit(folder)
    global _staged
    _staged += 1
    if _staged % COLLECT_EVERY == 0:
        gc.collect()
        spark._jvm.System.gc()
    out = spark.read.schema(df.schema).parquet(path)
    out.staged_path = path
    return out


def unstage(df: DataFrame) -> None:
    """Delete a staged table that no later plan reads (its successor is staged)."""
    files, folder = _folder(df.sparkSession, df.staged_path)
    files.delete(folder, True)


_SHIPPED: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Give the executors' Python workers this package, as ``--py-files`` would."""
    sc = spark.sparkContext
    if sc.applicationId in _SHIPPED:
        return
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    out = os.path.join(tempfile.mkdtemp(prefix="spendlens-code-"), "spendlens_llm_code.zip")
    with zipfile.ZipFile(out, "w", zipfile.ZIP_DEFLATED) as z:
        for folder, _, names in os.walk(root):
            for n in names:
                if n.endswith(".py"):
                    full = os.path.join(folder, n)
                    z.write(full, os.path.join(os.path.basename(root), os.path.relpath(full, root)))
    sc.addPyFile(out)
    _SHIPPED.add(sc.applicationId)


def map_arrow(df: DataFrame, function, schema: str) -> DataFrame:
    """``mapInArrow`` with this package on the workers; ``function`` maps batch iterators."""
    ship(df.sparkSession)
    return df.mapInArrow(function, schema)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def labelled_bucket(key: Column, salt: str = "") -> Column:
    """A deterministic pseudo-random order of rows, used to bound labelled samples."""
    return F.xxhash64(F.concat(key.cast("string"), F.lit(salt)))


def text_parts(batch: pa.RecordBatch, column: str, most_bytes: int = 2 << 20
               ) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """Slices ``(first, last, bytes, offsets)`` of a batch's text column (null: empty).

    A slice holds whole texts of at most ``most_bytes`` together, one text at least.
    """
    col = batch.column(batch.schema.get_field_index(column))
    if col.null_count:
        col = col.fill_null("")
    if not pa.types.is_large_string(col.type):
        col = col.cast(pa.large_string())
    n = len(col)
    bufs = col.buffers()
    offs = np.frombuffer(bufs[1], np.int64)[col.offset:col.offset + n + 1] if n else np.zeros(1, np.int64)
    data = np.frombuffer(bufs[2], np.uint8) if bufs[2] is not None else np.zeros(0, np.uint8)
    i = 0
    while i < n:
        j = int(np.searchsorted(offs, offs[i] + most_bytes, side="right")) - 1
        j = min(n, max(i + 1, j))
        yield i, j, data[offs[i]:offs[j]], offs[i:j + 1] - offs[i]
        i = j


def texts_of(batch: pa.RecordBatch, column: str) -> list[str]:
    """The column's texts as Python strings (null: empty)."""
    return [t or "" for t in batch.column(batch.schema.get_field_index(column)).to_pylist()]


def arrow_rows(schema: pa.Schema, **columns) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array(columns[f.name], type=f.type) for f in schema], schema=schema)


def quoted(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def free_name(df: DataFrame, name: str) -> str:
    """``name``, with ``_`` appended until no column of ``df`` has it (in any letter case)."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def rows_of(docs: DataFrame, verdicts: DataFrame) -> DataFrame:
    """The rows of ``docs`` whose doc_id and text (by hash) stand in ``verdicts``; nulls match."""
    v = verdicts.select(F.col("doc_id").alias("_v_id"), F.col("text_hash").alias("_v_hash"))
    return docs.join(v, docs["doc_id"].cast("long").eqNullSafe(v["_v_id"]) & (F.xxhash64(docs["text"]) == v["_v_hash"]), "left_semi")


def one_of_each(docs: DataFrame, verdicts: DataFrame) -> DataFrame:
    """One row of ``docs`` for each component of ``verdicts`` (``doc_id, text_hash, node``): of the least doc_id.

    Rows without a component (``node`` null) are one a doc_id; without either, one a text.
    Of rows that repeat a doc_id and text the least stays; they are reduced in each task first.
    """
    alone = F.col("node").isNull()
    counted = verdicts.groupBy("node", "doc_id", "text_hash").agg(F.count(F.lit(1)).alias("n"))
    chosen = (counted.groupBy("node", F.when(alone, F.col("doc_id")).alias("own"), F.when(alone & F.col("doc_id").isNull(), F.col("text_hash")).alias("text"))
              .agg(F.min(F.struct(F.col("doc_id").isNull().alias("unknown"), "doc_id", "text_hash", "n")).alias("c")).select("c.*"))
    chosen = stage(chosen, "chosen")
    out, several = rows_of(docs, chosen.where("n = 1")), chosen.where("n > 1")
    if several.isEmpty():
        return out
    rows = rows_of(docs, several).select(F.col("doc_id").alias("_id"), F.xxhash64("text").alias("_hash"), F.struct(*[F.col(quoted(c)) for c in docs.columns]).alias("_row"))
    return out.union(rows.groupBy("_id", "_hash").agg(F.min("_row").alias("_row")).select("_row.*"))
