"""Helpers shared by the training-data operators.

Every operator selects the columns it reads first, so extra columns of the
input, whatever their names, neither clash nor travel through a shuffle.
"""

from __future__ import annotations

import tempfile
import uuid
import zipfile
from collections.abc import Iterator, Sequence
from pathlib import Path

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from deliverylens.session import shared_dir
from deliverylens.sources.versions import remove

#: Rows of one Arrow batch handed to a Python task: bounds what a task holds of long texts.
ARROW_ROWS = 1000


def arrow_tasks(spark: SparkSession, rows: int = ARROW_ROWS) -> None:
    """Make ready for Python tasks over long texts: small Arrow batches, and this package on every executor.

    Never raises a smaller batch size that the user has set. The package is
    sent once for each Spark context, by Spark itself.
    """
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    now = int(spark.conf.get(key))
    if now <= 0 or now > rows:
        spark.conf.set(key, str(rows))
    context = spark.sparkContext
    if getattr(context, "_deliverylens_sent", None) is None:
        top = Path(__file__).resolve().parents[1]
        place = Path(tempfile.mkdtemp()) / f"{top.name}.zip"
        with zipfile.ZipFile(place, "w") as z:
            for f in sorted(top.rglob("*.py")):
                z.write(f, f.relative_to(top.parent))
        context.addPyFile(str(place))
        context._deliverylens_sent = True


def shared_path(spark: SparkSession, name: str) -> str:
    """A fresh location in the cluster's shared folder."""
    return f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex[:12]}"


def numbered(df: DataFrame, *names: str) -> tuple[DataFrame, list[str]]:
    """``df`` with columns renamed by place, so that no name clashes, and the new names of ``names``."""
    new = [f"c{i}" for i in range(len(df.columns))]
    return df.toDF(*new), [new[df.columns.index(n)] for n in names]


def written(df: DataFrame, name: str) -> DataFrame:
    """``df`` as a table in the shared folder: cuts lineage, survives the loss of any executor."""
    spark = df.sparkSession
    path = shared_path(spark, name)
    df.write.option("compression", "zstd").parquet(path)
    table = spark.read.schema(df.schema).parquet(path)
    table._written_to = path
    return table


def removed(table: DataFrame) -> None:
    """Delete a table that `written` returned, once nothing that is still to run reads it."""
    remove(table.sparkSession, table._written_to)


def hash_sample(df: DataFrame, n: int, *cols: str) -> DataFrame:
    """At most ``n`` rows, the first by a hash of ``cols``.

    Rows are thinned by the hash before they are ordered, so that about twice
    ``n`` of them leave the tasks, however many tasks there are.
    """
    h = F.xxhash64(*cols)
    thin = max(1, df.count() // (2 * n))
    return df.where(F.pmod(h, F.lit(thin)) == 0).orderBy(h, *cols).limit(n)


def id_crc32(doc_id: Column) -> Column:
    """crc32 of the id as text; a null id counts as the empty text."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary"))


def text_chunks(texts: Sequence[str | None], chars: int) -> Iterator[tuple[int, list[str]]]:
    """Consecutive (first index, texts) runs of about ``chars`` code points; null counts as empty."""
    run: list[str] = []
    first = size = 0
    for i, t in enumerate(texts):
        t = t if isinstance(t, str) else ""
        if run and size + len(t) > chars:
            yield first, run
            run, first, size = [], i, 0
        run.append(t)
        size += len(t)
    if run:
        yield first, run


def code_points(texts: Sequence[str]) -> tuple[np.ndarray, np.ndarray]:
    """All code points of the texts in one array, and the offsets of each text (one more than texts)."""
    codes = np.frombuffer("".join(texts).encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
    ends = np.cumsum([len(t) for t in texts], dtype=np.int64)
    return codes, np.concatenate(([0], ends)).astype(np.int64)


class BoundedCache(dict):
    """Mapping filled by ``make`` on a miss; emptied when it holds ``limit`` entries."""

    def __init__(self, make, limit: int):
        super().__init__()
        self._make, self._limit = make, limit

    def __missing__(self, key):
        if len(self) >= self._limit:
            self.clear()
        value = self[key] = self._make(key)
        return value
