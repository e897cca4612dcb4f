"""Writers for messages, documents and lanes; all can run inside ``foreachBatch``."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tidelog.functions.patterns import any_of
from tidelog.functions.records import message_envelope, message_key
from tidelog.operators.incremental import latest_per_key, merge_incremental, shard
from tidelog.operators.records import project_positional
from tidelog.streaming.batches import keep_state, kept_batches, remove_folders

RUN_RATIO = 4  # an older run of documents has at least so many times the rows of those after it


def messages(df: DataFrame, topic: str = "topic", data: str | None = None) -> DataFrame:
    """(topic, key, value) of routed records; records without a topic are left out."""
    return df.filter(F.col(topic).isNotNull()).select(
        F.col(topic).alias("topic"), message_key().alias("key"), message_envelope(data).alias("value")
    )


def write_messages(
    df: DataFrame, checkpoint: str, fmt: str = "kafka", options: dict[str, str] | None = None, **trigger
) -> StreamingQuery:
    """Start a stream of (topic, key, value); file formats get one folder per topic."""
    writer = df.writeStream.format(fmt).options(**(options or {})).option("checkpointLocation", checkpoint)
    if fmt != "kafka":
        writer = writer.partitionBy("topic")
    return writer.trigger(**(trigger or {"availableNow": True})).start()


def documents(
    df: DataFrame,
    names: Sequence[str],
    id_column: str,
    order: str,
    date_column: str,
    months_per_shard: int = 12,
) -> DataFrame:
    """Latest row per id with columns renamed by position and the ``shard`` its date belongs to."""
    named = project_positional(df, list(names))
    latest = latest_per_key(named, [id_column], [F.col(order).desc()])
    return latest.withColumn("shard", shard(date_column, months_per_shard))


def _exists(spark: SparkSession, path: str) -> bool:
    try:
        return bool(spark.read.parquet(path).columns)
    except AnalysisException:
        return False


def upsert_documents(docs: DataFrame, path: str, id_column: str, order: str, buckets: int = 32) -> None:
    """Merge documents into the parquet snapshot at ``path``.

    A shard is cut into ``buckets`` by id, and only the (shard, bucket) folders that
    get a document are rewritten. The rewrite is staged and moved into place when the
    job commits, so a lost executor or a repeated batch leaves the same result.
    """
    spark = docs.sparkSession
    docs = docs.withColumn("bucket", F.pmod(F.xxhash64(id_column), F.lit(buckets)).cast("int"))
    merged = docs
    if _exists(spark, path):
        # a shard is a span of months: this list of folders is short by nature
        touched: dict[int, list[int]] = {}
        for r in docs.select("shard", "bucket").distinct().collect():
            touched.setdefault(r.shard, []).append(r.bucket)
        folders = [(F.col("shard") == s) & F.col("bucket").isin(*b) for s, b in touched.items()]
        old = spark.read.schema(docs.schema).parquet(path).filter(any_of(*folders))
        both = old.withColumn("_new", F.lit(0)).unionByName(docs.withColumn("_new", F.lit(1)))
        newest = [F.col(order).desc(), F.col("_new").desc()]
        merged = latest_per_key(both, ["shard", "bucket", id_column], newest).drop("_new")
    (
        merged.repartition("shard", "bucket")
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy("shard", "bucket")
        .parquet(path)
    )


def write_documents(
    path: str,
    names: Sequence[str],
    id_column: str,
    order: str,
    date_column: str,
    months_per_shard: int = 12,
    buckets: int = 32,
) -> Callable[[DataFrame, int], None]:
    """Function for ``foreachBatch`` that upserts each micro-batch by id."""

    def write(batch: DataFrame, batch_id: int) -> None:
        docs = documents(batch, names, id_column, order, date_column, months_per_shard).persist()
        upsert_documents(docs, path, id_column, order, buckets)
        docs.unpersist()

    return write


def _versions(path: str) -> str:
    return f"{path}/versions"


def _runs(spark: SparkSession, path: str, version: int) -> list[tuple[str, int]]:
    """(folder, rows) of the runs that make up a version, the oldest first: a few rows, as each is a multiple of the next."""
    rows = spark.read.parquet(f"{_versions(path)}/{version}").orderBy("age").collect()
    return [(r["folder"], r["n_rows"]) for r in rows]


def append_documents(
    docs: DataFrame, path: str, batch_id: int, id_column: str, order: str, ratio: int = RUN_RATIO
) -> None:
    """Add one batch's documents, one per (shard, id), to the runs below ``path``.

    A run is a folder that is written once, sorted by shard and id, and never changed. A batch becomes a new run. Where
    that would leave an older run with less than ``ratio`` times the rows of the ones after it, it is merged into
    the new one, so a document is written again a logarithmic number of times only, and a small batch leaves a large table alone.

    The list of runs is written last and makes the batch visible, whole. A batch that was written already is left as it is; the
    ids have to be those of one stream, and one before the last is refused. The runs of the last two lists are kept,
    for readers that still use them. ``order`` is never null; of equal ones the later batch wins.
    """
    spark = docs.sparkSession
    known = kept_batches(spark, _versions(path))
    if known and batch_id == known[-1]:
        return
    if known and batch_id < known[-1]:
        raise ValueError(f"batch {batch_id} comes after batch {known[-1]} in {path}; another stream needs a folder of its own")
    runs = _runs(spark, path, known[-1]) if known else []
    first, later = len(runs), docs.count()
    if not later:
        return
    for age in reversed(range(len(runs))):
        if runs[age][1] < ratio * later:
            first = age
        later += runs[age][1]
    rows = docs
    if first < len(runs):
        olds = [spark.read.schema(docs.schema).parquet(f"{path}/{folder}") for folder, _ in runs[first:]]
        aged = [df.withColumn("_age", F.lit(age)) for age, df in enumerate([*olds, docs])]
        newest = [F.col(order).desc(), F.col("_age").desc()]
        rows = latest_per_key(reduce(DataFrame.unionByName, aged), ["shard", id_column], newest).drop("_age")
    folder = f"runs/{batch_id}"
    ranged = rows.repartitionByRange("shard", id_column).sortWithinPartitions("shard", id_column)
    ranged.write.mode("overwrite").parquet(f"{path}/{folder}")
    left = [*runs[:first], (folder, spark.read.parquet(f"{path}/{folder}").count())]
    listed = spark.createDataFrame([(age, *run) for age, run in enumerate(left)], "age int, folder string, n_rows bigint")
    keep_state(listed.coalesce(1), _versions(path), batch_id)
    used = {f for f, _ in [*runs, *left]}
    remove_folders(spark, f"{path}/runs", lambda name: f"runs/{name}" not in used)


def read_documents(spark: SparkSession, path: str, id_column: str, order: str) -> DataFrame | None:
    """The last row per (shard, id) of all runs; None where nothing was written yet.

    The oldest run, which has most rows, stays where it is while the later ones are small (``merge_incremental``).
    """
    known = kept_batches(spark, _versions(path))
    if not known:
        return None
    oldest, *later = [spark.read.parquet(f"{path}/{folder}") for folder, _ in _runs(spark, path, known[-1])]
    if not later:
        return oldest
    aged = reduce(DataFrame.unionByName, [df.withColumn("_age", F.lit(age)) for age, df in enumerate(later)])
    newest = latest_per_key(aged, ["shard", id_column], [F.col(order).desc(), F.col("_age").desc()]).drop("_age")
    return merge_incremental(oldest, newest.withColumn("_type", F.lit("UPSERT")), ["shard", id_column], order, "_type")


def write_document_runs(
    path: str,
    names: Sequence[str],
    id_column: str,
    order: str,
    date_column: str,
    months_per_shard: int = 12,
    ratio: int = RUN_RATIO,
) -> Callable[[DataFrame, int], None]:
    """Function for ``foreachBatch`` that appends each micro-batch as a run; ``read_documents`` gives the table."""

    def write(batch: DataFrame, batch_id: int) -> None:
        docs = documents(batch, names, id_column, order, date_column, months_per_shard).persist()
        append_documents(docs, path, batch_id, id_column, order, ratio)
        docs.unpersist()

    return write


def lane_rows(df: DataFrame, lanes: str = "lanes", default: str = "default") -> DataFrame:
    """One copy of a row per lane it names, or one in the default lane if it names none."""
    named = F.when(F.size(F.coalesce(lanes, F.array().cast("array<string>"))) > 0, F.col(lanes)).otherwise(
        F.array(F.lit(default))
    )
    others = [c for c in df.columns if c != lanes]
    return df.select(*others, F.explode(named).alias("lane"))


def write_lanes(
    df: DataFrame, path: str, declared: Sequence[str], lanes: str = "lanes", default: str | None = None
) -> None:
    """Write one folder per lane in a single pass; declared lanes exist even without rows."""
    default = default or (declared[0] if len(declared) == 1 else "default")
    rows = lane_rows(df, lanes, default)
    rows.write.mode("overwrite").partitionBy("lane").parquet(path)
    empty = rows.drop("lane").limit(0)
    for lane in declared:
        if not _exists(df.sparkSession, f"{path}/lane={lane}"):
            empty.write.mode("overwrite").parquet(f"{path}/lane={lane}")
