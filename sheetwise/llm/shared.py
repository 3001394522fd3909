"""Tables that cut lineage, in the folder that driver and executors share."""

import tempfile
import uuid

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F


def shared_folder(spark: SparkSession) -> str:
    """The folder named by spark.checkpoint.dir; where that is unset, one of our own in local mode (tests), else an error."""
    base = spark.sparkContext.getConf().get("spark.checkpoint.dir") or spark.sparkContext.getCheckpointDir()
    if not base:
        if not spark.sparkContext.master.split("[")[0] == "local":
            raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
        base = tempfile.mkdtemp(prefix="sheetwise-")
        spark.sparkContext.setCheckpointDir(base)
        base = spark.sparkContext.getCheckpointDir()
    return base.rstrip("/")


CLEAN_UP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
#: Rows of an Arrow batch: few, since texts are long and both sides of the pipe hold a batch.
BATCH = "spark.sql.execution.arrow.maxRecordsPerBatch"
#: Lets Spark put a Bloom filter of the smaller side, of 8 MB at most (its default), over the larger one before that is shuffled.
BLOOM = {"spark.sql.optimizer.runtime.bloomFilter.enabled": "true", "spark.sql.optimizer.runtime.bloomFilter.applicationSideScanSizeThreshold": "0", "spark.sql.optimizer.runtime.bloomFilter.creationSideThreshold": "1g"}
#: Joins are sorted: Spark takes the rows that a generator makes for as few as go in, and would broadcast them through the driver.
SORTED = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1"}


class Scratch:
    """Written tables of one call, all under the same settings: `put` writes and reads back, `drop` deletes what no result needs."""

    def __init__(self, spark: SparkSession, label: str, settings: dict[str, str] | None = None):
        self.spark, self.root, self.settings = spark, f"{shared_folder(spark)}/{label}-{uuid.uuid4().hex}", settings or {}

    def put(self, df: DataFrame, name: str, settings: dict[str, str] | None = None) -> DataFrame:
        """Writes a table, under settings of its own, and reads it back. The shuffle files behind it go with the end of the write: nothing needs them again."""
        path, conf = f"{self.root}/{name}", self.spark.conf
        settings = {CLEAN_UP: "true", BATCH: "2000"} | self.settings | (settings or {})
        before = {k: conf.get(k, None) for k in settings}
        for k, v in settings.items():
            conf.set(k, v)
        try:
            df.write.mode("overwrite").parquet(path)
        finally:
            for k, v in before.items():
                conf.unset(k) if v is None else conf.set(k, v)
        return self.spark.read.schema(df.schema).parquet(path)

    def drop(self, *names: str) -> None:
        jvm = self.spark.sparkContext._jvm
        for name in names:
            path = jvm.org.apache.hadoop.fs.Path(f"{self.root}/{name}")
            path.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


def partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def fresh(docs: DataFrame, name: str) -> str:
    """A column name that no column of `docs` has, whatever the case."""
    taken = {c.lower() for c in docs.columns}
    while name.lower() in taken:
        name = f"_{name}"
    return name


def columns(docs: DataFrame) -> list[Column]:
    return [F.col(f"`{c.replace('`', '``')}`") for c in docs.columns]


def map_whole(docs: DataFrame, function, without: str | None = None) -> DataFrame:
    """`mapInArrow` over all columns, whatever their names; the result has them all but `without`, under the same names and types."""
    plain = [c if "." not in c and "`" not in c else fresh(docs, f"_column{i}") for i, c in enumerate(docs.columns)]
    renamed = docs.toDF(*plain)
    kept = [i for i, c in enumerate(docs.columns) if c != without]
    schema = renamed.select(*[plain[i] for i in kept]).schema
    return renamed.mapInArrow(function, schema).toDF(*[docs.columns[i] for i in kept])


def row_key(docs: DataFrame, *more: str) -> Column:
    """A hash of doc_id, text and `more`, in which a null differs from a value; with doc_id beside it, it names a row."""
    parts = [F.col("doc_id").cast("long"), *[F.col(c).cast("string") for c in ("text", *more)]]
    return F.xxhash64(*parts, *[p.isNull() for p in parts])


def beside_rows(docs: DataFrame, key: Column, decided: DataFrame, how: str) -> tuple[DataFrame, dict[str, str]]:
    """The rows joined with what was decided about them (doc_id, row_hash and more, one row for each different row).

    Returns the joined table and the names in it of the columns of `decided`, and of `nth`, which numbers equal rows from 1.
    Texts move once, by doc_id and hash, at every size: the join is always sorted, and the numbers use its order.
    """
    more = [c for c in decided.columns if c not in ("doc_id", "row_hash")]
    name = {c: fresh(docs, f"_{c}") for c in ("id", "hash", "nth", "to_id", "to_hash", *more)}
    left = docs.withColumn(name["id"], F.coalesce(F.col("doc_id").cast("long"), F.lit(0))).withColumn(name["hash"], key)
    right = decided.select(F.coalesce("doc_id", F.lit(0)).alias(name["to_id"]), F.col("row_hash").alias(name["to_hash"]), *[F.col(c).alias(name[c]) for c in more])
    joined = left.join(right.hint("merge"), (F.col(name["id"]) == F.col(name["to_id"])) & (F.col(name["hash"]) == F.col(name["to_hash"])), how)
    return joined.withColumn(name["nth"], F.row_number().over(Window.partitionBy(name["id"], name["hash"]).orderBy(name["hash"]))), name
