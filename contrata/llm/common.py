"""What the corpus operators share: tables, the shared scratch folder and Arrow batches."""

from __future__ import annotations

import re
import tempfile
import uuid
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Rows and bytes of an Arrow batch sent to a Python worker: texts may be long.
BATCH_ROWS, BATCH_BYTES = 1000, 16 << 20

#: A key is hot if more than one in so many rows have it, and more than LEAST_HOT; so there are at most so many hot keys, however large the table.
MOST_HOT, LEAST_HOT = 1000, 1000

_own_folder: dict[str, str] = {}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def texts(docs: DataFrame) -> DataFrame:
    """doc_id and text alone; extra columns, whatever their names, go no further. A null text is an empty one."""
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))


def small_batches(spark: SparkSession) -> None:
    """Bounds the Arrow batches of this session; a lower bound that someone set stays."""
    rows, size = "spark.sql.execution.arrow.maxRecordsPerBatch", "spark.sql.execution.arrow.maxBytesPerBatch"
    if not 0 < int(spark.conf.get(rows)) <= BATCH_ROWS:
        spark.conf.set(rows, str(BATCH_ROWS))
    now = re.fullmatch(r"(\d+)([a-z]*)", spark.conf.get(size).lower())
    unit = {"": 1, "b": 1, "k": 1 << 10, "kb": 1 << 10}.get(now[2], BATCH_BYTES) if now else BATCH_BYTES
    if not now or int(now[1]) * unit > BATCH_BYTES:
        spark.conf.set(size, str(BATCH_BYTES))


def shared_folder(spark: SparkSession) -> str:
    """The folder in spark.checkpoint.dir. Where it is unset, local mode gets a folder of its own; a cluster must name one."""
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named.rstrip("/")
    master = spark.sparkContext.master
    if not master.startswith("local") or master.startswith("local-cluster"):
        raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    app = spark.sparkContext.applicationId
    if app not in _own_folder:
        _own_folder[app] = tempfile.mkdtemp(prefix="contrata-")
    return f"file://{_own_folder[app]}"


class Scratch:
    """Tables written to the shared folder: they cut the lineage and survive the loss of executors."""

    def __init__(self, spark: SparkSession):
        self.spark, self.folder, self.n = spark, f"{shared_folder(spark)}/contrata-{uuid.uuid4().hex}", 0

    def keep(self, df: DataFrame) -> DataFrame:
        self.n += 1
        path = f"{self.folder}/{self.n}"
        df.write.parquet(path)
        out = self.spark.read.schema(df.schema).parquet(path)
        out._scratch = path
        return out

    def drop(self, *tables: DataFrame) -> None:
        """Deletes tables that no result reads any more."""
        jvm, jsc = self.spark._jvm, self.spark.sparkContext._jsc
        for df in tables:
            path = jvm.org.apache.hadoop.fs.Path(df._scratch)
            path.getFileSystem(jsc.hadoopConfiguration()).delete(path, True)


def hot_keys(counts: DataFrame, keys: list[str], n: str, total: int) -> dict[int, int]:
    """Of each hot key, by the hash of its columns: among how many tasks its rows are to be dealt, so that none gets more than one in MOST_HOT of all. At most MOST_HOT entries, all of which the driver knows. counts: rows (column n) by key; total: of all."""
    hot = counts.where((F.col(n) * MOST_HOT > F.lit(total)) & (F.col(n) > LEAST_HOT)).select(F.xxhash64(*keys).alias("key"), F.col(n).alias("n"))
    return {r.key: -(-r.n * MOST_HOT // total) for r in hot.collect()}


def hot_keys_of(table: DataFrame, keys: list[str]) -> dict[int, int]:
    """hot_keys of a written table."""
    return hot_keys(table.groupBy(*keys).agg(F.count("*").alias("__n")), keys, "__n", table.count())


def met(big: DataFrame, small: DataFrame, keys: list[str], hot: dict[int, int], by: list[str], how: str = "inner") -> DataFrame:
    """big joined with small on columns of equal names; hot: hot_keys of big. small's rows of a hot key are copied, and big's are dealt to the copies by some columns, so no task has a hot key's rows to itself."""
    if not hot:
        return big.join(small, keys, how)
    copies = F.coalesce(F.try_element_at(F.create_map(*[F.lit(x) for pair in hot.items() for x in pair]), F.xxhash64(*keys)), F.lit(1))
    one = big.withColumn("__part", F.pmod(F.xxhash64(*by), copies).cast("int"))
    other = small.withColumn("__part", F.explode(F.sequence(F.lit(0), copies - 1)))
    return one.join(other, [*keys, "__part"], how).drop("__part")


def looked_up(big: DataFrame, small: DataFrame, keys: list[str], value: str, n: str | None = None, how: str = "inner") -> DataFrame:
    """big with the value that small has for its keys. small: at most one row for equal keys. n: small's column of how many rows of big have its keys; without it they are counted, which reads big twice more, so it had better be a written table."""
    hot = hot_keys(small, keys, n, small.agg(F.sum(n)).first()[0] or 0) if n else hot_keys_of(big, keys)
    joined = met(big, small.select(*keys, F.col(value).alias("__value")), keys, hot, big.columns, how)
    return joined.select(*[F.col(f"`{c}`") for c in big.columns if c != value], F.col("__value").alias(value))


def mapped(df: DataFrame, function: Callable[[pa.RecordBatch], pa.RecordBatch | Iterator[pa.RecordBatch] | None], schema: str) -> DataFrame:
    """mapInArrow of a function of one batch."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                out = function(batch)
                if isinstance(out, pa.RecordBatch):
                    yield out
                elif out is not None:
                    yield from out

    return df.mapInArrow(run, schema)
