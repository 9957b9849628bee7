"""Helpers shared by the text operators: labels, folds, written tables, running totals, components."""

from __future__ import annotations

import ctypes
import gc
from collections.abc import Callable, Collection, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from spendcast.session import materialize, scratch_dir

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def fold(key: str | Column, folds: int) -> Column:
    """crc32 of the key's text modulo ``folds``; null keys have no fold."""
    key = F.col(key) if isinstance(key, str) else key
    return F.crc32(key.cast("string").cast("binary")) % folds


def held_out(key: str | Column, folds: int, number: int) -> Column:
    """Whether the key's fold is ``number``; rows with a null key are never held out and never learnt from."""
    return F.coalesce(fold(key, folds) == number, F.lit(False))


def text_of(column: str = "text") -> Column:
    return F.coalesce(F.col(column), F.lit(""))


def ascii_lower(text: Column) -> Column:
    return F.translate(text, UPPER, LOWER)


def drop_table(df: DataFrame) -> None:
    """Delete the files of a table that ``materialize`` wrote; nothing may read ``df`` afterwards."""
    spark = df.sparkSession
    home = scratch_dir(spark).rstrip("/")
    folders = {f.rpartition("/")[0] for f in df.inputFiles()}
    hadoop = spark.sparkContext._jsc.hadoopConfiguration()
    for folder in folders:
        if "/table-" in folder and home.removeprefix("file:").lstrip("/") in folder:
            path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder)
            path.getFileSystem(hadoop).delete(path, True)


def set_aside(docs: DataFrame, used: Collection[str]) -> DataFrame:
    """``docs`` with all columns but the ``used`` ones named by their place, so that no other name can clash with them."""
    return docs.toDF(*(c if c in used else f"_extra{i}" for i, c in enumerate(docs.columns)))


Batches = Iterator[pa.RecordBatch]


def handing_back(run: Callable[[Batches], Batches], forget: Callable[[], None] = lambda: None) -> Callable[[Batches], Batches]:
    """``run`` for ``mapInArrow``; when a partition ends, tables are emptied by ``forget`` and freed memory goes back to the system.

    Workers serve many stages, and each would otherwise keep the peak of those before it.
    """

    def whole(batches: Batches) -> Batches:
        try:
            yield from run(batches)
        finally:
            forget()
            release_memory()

    return whole


def release_memory() -> None:
    gc.collect()
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except (AttributeError, OSError):  # another C library
        pass


def shrink_heaps(spark: SparkSession) -> None:
    """Ask the executors' Java machines for a full collection, after which free heap goes back to the system.

    Their heaps otherwise stay as large as the largest stage made them. There are a few tasks for every
    core, so that each executor is reached, in no particular order.
    """
    cores = spark.sparkContext.defaultParallelism
    collect = F.expr("java_method('java.lang.System', 'gc')")
    spark.range(0, 2 * cores, 1, 2 * cores).select(collect.alias("done")).write.format("noop").mode("overwrite").save()


def partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def running_total(df: DataFrame, order: list[str], value: str, into: str, within: str | None = None) -> DataFrame:
    """Add ``into``: the sum of ``value`` over all earlier rows in ``order``.

    With ``within`` (the first column of ``order``) sums restart for each of its values. One range
    shuffle: every task adds up its own sorted rows and notes its number, and a table with one row
    per task (and value of ``within``) shifts them. A value that holds most rows is spread over many
    ranges. The result is written, so range limits are chosen once. ``order`` must not tie on rows
    whose order matters.
    """
    spark, columns = df.sparkSession, df.columns
    key = within or "_all"
    source = df if within else df.withColumn("_all", F.lit(0))

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task, last, carried, begun = TaskContext.get().partitionId(), None, 0, False
        for batch in batches:
            if not batch.num_rows:
                continue
            keys = batch.column(batch.schema.get_field_index(key)).to_pandas().to_numpy()
            values = batch.column(batch.schema.get_field_index(value)).to_numpy().astype(np.int64)
            before = np.cumsum(values) - values
            starts = np.flatnonzero(np.r_[True, keys[1:] != keys[:-1]])
            local = before - np.repeat(before[starts], np.diff(np.r_[starts, len(keys)]))
            if begun and keys[0] == last:
                local[: starts[1] if len(starts) > 1 else len(keys)] += carried
            last, carried, begun = keys[-1], int(local[-1] + values[-1]), True
            added = [pa.array(np.full(len(keys), task, np.int32)), pa.array(local)]
            yield pa.RecordBatch.from_arrays([*batch.columns, *added], names=[*batch.schema.names, "_task", into])

    schema = source.schema.add("_task", "integer").add(into, "long")
    local = materialize(
        source.repartitionByRange(partitions(spark), *order).sortWithinPartitions(*order).mapInArrow(add, schema)
    )
    sums = local.groupBy(key, "_task").agg(F.sum(value).alias("_sum"))
    earlier = Window.partitionBy(key).orderBy("_task").rowsBetween(Window.unboundedPreceding, -1)
    shifts = sums.select(key, "_task", F.coalesce(F.sum("_sum").over(earlier), F.lit(0)).alias("_shift"))
    # Without `within` there is one row per task, which is safe to broadcast; else Spark chooses.
    shifts = shifts.withColumnsRenamed({key: "_key", "_task": "_of"})
    same = F.col(key).eqNullSafe(F.col("_key")) & (F.col("_task") == F.col("_of"))
    return (
        local.join(shifts if within else F.broadcast(shifts), same)
        .withColumn(into, F.col(into) + F.col("_shift"))
        .select(*columns, into)
    )


def components(links: DataFrame) -> DataFrame:
    """Connected components of undirected ``links`` (columns ``a``, ``b``): rows (``node``, ``component``).

    The component is the smallest node. In every round each node points to its smallest neighbour, so
    pointers end in pairs that point to each other, and the smaller of a pair is a root. Pointers jump
    until all name a root, and the links between roots are the next round's. Each root stands for two
    nodes at least: rounds and jumps are logarithmic for any order of ids, and tables halve. They are
    written between steps; only whether any row is left reaches the driver.
    """

    def ahead(pointers: DataFrame) -> DataFrame:
        return pointers.select(F.col("node").alias("to"), F.col("to").alias("far"))

    edges = materialize(links.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct())
    levels = []
    while not levels or edges.limit(1).count():
        both = edges.union(edges.select("b", "a")).withColumnRenamed("a", "node")
        # A node that is linked with itself only is its own root.
        other = F.min(F.when(F.col("b") != F.col("node"), F.col("b"))).alias("to")
        nearest = materialize(both.groupBy("node").agg(other).withColumn("to", F.coalesce("to", "node")))
        first = (F.col("far") == F.col("node")) & (F.col("node") < F.col("to"))
        pointers = materialize(
            nearest.join(ahead(nearest), "to").select("node", F.when(first, F.col("node")).otherwise(F.col("to")).alias("to"))
        )
        drop_table(nearest)
        moving = True
        while moving:
            jumped = materialize(pointers.join(ahead(pointers), "to").select("node", F.col("far").alias("to"), (F.col("to") != F.col("far")).alias("moved")))
            moving = bool(jumped.filter("moved").limit(1).count())
            drop_table(pointers)
            pointers = jumped.select("node", "to")
        levels.append(pointers)
        root = lambda c: pointers.select(F.col("node").alias(c), F.col("to").alias(f"root_{c}"))  # noqa: B023, E731
        a, b = F.col("root_a"), F.col("root_b")
        between = edges.join(root("a"), "a").join(root("b"), "b").filter(a != b)
        contracted = materialize(between.select(F.greatest(a, b).alias("a"), F.least(a, b).alias("b")).distinct())
        drop_table(edges)
        edges = contracted
    drop_table(edges)
    labels = levels.pop()
    while levels:
        lower, upper = levels.pop(), labels
        labels = materialize(lower.join(ahead(upper), "to", "left").select("node", F.coalesce("far", "to").alias("to")))
        drop_table(lower)
        drop_table(upper)
    low = labels.groupBy("to").agg(F.min("node").alias("low")).filter("low < to")
    named = materialize(labels.join(low, "to", "left").select("node", F.coalesce("low", "to").alias("component")))
    drop_table(labels)
    return named


#: Ids that are sent to every task instead of shuffling the other side (8 bytes each).
BROADCAST_IDS = 2_000_000


def checked_broadcast(ids: DataFrame) -> DataFrame:
    """The ids marked for broadcasting if they are few, and as they are otherwise."""
    return F.broadcast(ids) if ids.count() <= BROADCAST_IDS else ids


def labelled_sample(
    docs: DataFrame, labels: DataFrame, label: str, size: int, folds: int, aside: int, longest: int
) -> tuple[list[tuple[int, str, float]], float]:
    """About ``size`` labelled texts, half of them of either class, and the share of class 1 among all labels.

    Rows are chosen by a hash of doc_id, from labels whose fold is not ``aside``; texts over
    ``longest`` characters are not learnt from. Only the chosen ids, at most about ``size``, are sent
    to the documents. Each row comes with a number in [0, 1) to split the sample by.
    """
    known = labels.filter(F.col(label).isin(0, 1) & (fold("doc_id", folds) != aside)).select("doc_id", F.col(label).alias("_label"))
    totals = {r[0]: r[1] for r in known.groupBy("_label").count().collect()}  # two rows at most
    if not totals:
        return [], 0.0
    rate = F.lit(0.0)
    for value, n in totals.items():
        rate = F.when(F.col("_label") == value, min(1.0, size / 2 / n)).otherwise(rate)
    place = F.pmod(F.xxhash64(F.lit(label), "doc_id"), F.lit(1 << 30)) / F.lit(float(1 << 30))
    chosen = known.withColumn("_place", place).filter(F.col("_place") < rate).withColumn("_place", F.col("_place") / rate)
    texts = docs.filter(F.length("text") <= longest).select("doc_id", "text")
    rows = texts.join(F.broadcast(chosen), "doc_id").select("_label", "text", "_place", "doc_id").collect()
    rows.sort(key=lambda r: (r[2], r[3], r[1]))
    return [(int(r[0]), r[1], r[2]) for r in rows], totals.get(1, 0) / sum(totals.values())


def logistic_regression(x: np.ndarray, y: np.ndarray, weight: np.ndarray, ridge: float = 1.0) -> np.ndarray:
    """Coefficients (the constant last) by Newton steps; columns of ``x`` should be of similar size."""
    x = np.c_[x, np.ones(len(x))]
    w, penalty = np.zeros(x.shape[1]), np.r_[np.full(x.shape[1] - 1, ridge), 1e-6]
    for _ in range(30):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        gradient = x.T @ (weight * (p - y)) + penalty * w
        hessian = (x * (weight * p * (1 - p))[:, None]).T @ x + np.diag(penalty)
        step = np.linalg.solve(hessian, gradient)
        w -= step
        if np.abs(step).max() < 1e-8:
            break
    return w


def score_texts(docs: DataFrame, scorer_of, columns: list[str]) -> DataFrame:
    """Keep ``columns`` and add ``score``: ``scorer_of()`` gives, on an executor, a function from texts to scores."""
    names = [*columns, "text"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        score = scorer_of()
        for batch in batches:
            made = pa.array(np.asarray(score(batch.column(len(columns)).to_pylist()), float), pa.float64())
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], made], names=[*columns, "score"])

    frame = docs.select(*names)
    return frame.mapInArrow(run, docs.select(*columns).limit(0).schema.add("score", "double"))
