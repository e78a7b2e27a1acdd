"""Approximate nearest neighbours by cross-polytope hashing with multiprobe tables.

A table turns unit vectors by pseudo-rotations: three rounds of random signs and a fast
Hadamard transform.  A vector belongs to the signed axis nearest to its image, with
``axes`` independent rotations making one bucket.  A query looks into its own bucket
and the next nearest ones of each table; all vectors found are ranked by their exact
distance.  Equal vectors are hashed and compared once.
"""

from __future__ import annotations

import itertools
import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from rosterflow.llm import ship
from rosterflow.session import materialize


@dataclass(frozen=True)
class HashPlan:
    """``tables`` and ``probes`` set recall; measured figures are in the README.

    ``probes``: the buckets of a table that a query looks into, with one axis, two and more.
    ``per_bucket``: a further axis is used when it leaves that many vectors to a
    bucket in the mean, so fewer than ``2 * dimension * per_bucket`` vectors are compared
    without hashing.  ``block``: vectors or queries of a bucket that one task takes; a
    larger bucket is split.
    """

    tables: int = 8
    probes: tuple[int, ...] = (16, 512, 4096)
    per_bucket: int = 64
    block: int = 8192
    seed: int = 20240501

    def axes(self, n: int, dimension: int) -> int:
        return max(0, int(math.log(max(1.0, n / self.per_bucket)) / math.log(2 * padded(dimension))))

    def looks(self, axes: int) -> int:
        """How many buckets of each table a query looks into at most."""
        return self.probes[min(axes, len(self.probes)) - 1] if axes else 1


SLICE_ROWS = 131_072


def padded(dimension: int) -> int:
    return 1 << max(0, dimension - 1).bit_length()


def hadamard(rows: np.ndarray) -> np.ndarray:
    """The fast Walsh-Hadamard transform of each row, as a rotation."""
    n, step = rows.shape[1], 1
    while step < n:
        pairs = rows.reshape(len(rows), -1, 2, step)
        rows = np.stack([pairs[:, :, 0] + pairs[:, :, 1], pairs[:, :, 0] - pairs[:, :, 1]], axis=2).reshape(len(rows), n)
        step *= 2
    return rows / math.sqrt(n)


def signed_axes(unit: np.ndarray, table: int, axis: int, seed: int) -> np.ndarray:
    """Nearness of each vector to the axes of one rotation, positive ones first."""
    width = padded(unit.shape[1])
    signs = np.random.default_rng([seed, table, axis, width]).choice([-1.0, 1.0], size=(3, width))
    turned = np.zeros((len(unit), width))
    turned[:, : unit.shape[1]] = unit
    for s in signs:
        turned = hadamard(turned * s)
    return np.concatenate([turned, -turned], axis=1)


def buckets(unit: np.ndarray, axes: int, plan: HashPlan) -> np.ndarray:
    """The bucket of each vector in each table: vectors x tables."""
    tables = plan.tables if axes else 1
    found = np.zeros((len(unit), tables), dtype=np.int64)
    for table in range(tables):
        for axis in range(axes):
            near = signed_axes(unit, table, axis, plan.seed)
            found[:, table] = found[:, table] * near.shape[1] + near.argmax(axis=1)
    return found


def probed(unit: np.ndarray, axes: int, plan: HashPlan) -> np.ndarray:
    """The buckets that each query looks into, nearest by the sum over their axes first: queries x tables x probes."""
    tables = plan.tables if axes else 1
    result = []
    for table in range(tables):
        scores, codes = np.zeros((len(unit), 1)), np.zeros((len(unit), 1), dtype=np.int64)
        for axis in range(axes):
            near = signed_axes(unit, table, axis, plan.seed)
            best = np.argsort(-near, axis=1, kind="stable")[:, : plan.looks(axes)]
            score = np.take_along_axis(near, best, axis=1)
            scores = (scores[:, :, None] + score[:, None, :]).reshape(len(unit), -1)
            codes = (codes[:, :, None] * near.shape[1] + best[:, None, :]).reshape(len(unit), -1)
            first = np.argsort(-scores, axis=1, kind="stable")[:, : plan.looks(axes)]
            scores, codes = np.take_along_axis(scores, first, axis=1), np.take_along_axis(codes, first, axis=1)
        result.append(codes)
    return np.stack(result, axis=1)


def usable(df: DataFrame, key: str, vector: str) -> DataFrame:
    """``id, v`` of the rows that take part: a key, and a vector of finite numbers that aren't all zero."""
    rows = df.select(F.col(key).cast("bigint").alias("id"), F.col(vector).cast("array<double>").alias("v"))
    finite = F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    return rows.where(F.col("id").isNotNull() & F.col("v").isNotNull() & finite & F.exists("v", lambda x: x != 0))


def coded(df: DataFrame, axes: dict[int, int], plan: HashPlan, many: bool, keys: str) -> DataFrame:
    """The rows with ``dim`` and the buckets, one row for each table (and probe, if ``many``)."""
    names = [f.split()[0] for f in keys.split(", ")]
    # rows of a slice, so that what it gives rise to stays small
    step = max(1, min(1024, SLICE_ROWS // (plan.tables * max(map(plan.looks, axes.values()), default=1) if many else 1)))

    def code(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start in range(0, batch.num_rows, step):
                yield from code_part(batch.slice(start, step))

    def code_part(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        column = batch.column("v")
        dims = column.value_lengths().to_numpy(zero_copy_only=False)
        for dim in np.unique(dims).tolist():
            rows = np.flatnonzero(dims == dim)
            part = batch.take(pa.array(rows))
            flat = part.column("v").flatten().to_numpy(zero_copy_only=False).reshape(-1, dim)
            # by the largest part first, so that no square overflows or vanishes
            unit = flat / np.abs(flat).max(axis=1, keepdims=True)
            unit /= np.linalg.norm(unit, axis=1, keepdims=True)
            codes = probed(unit, axes[dim], plan) if many else buckets(unit, axes[dim], plan)[:, :, None]
            n, tables, width = codes.shape
            again = pa.array(np.repeat(np.arange(n), tables * width))
            yield pa.RecordBatch.from_arrays(
                [
                    *[part.column(c).take(again) for c in names],
                    pa.array(np.full(len(again), dim), pa.int32()),
                    pa.array(np.tile(np.repeat(np.arange(tables), width), n), pa.int32()),
                    pa.array(codes.reshape(-1), pa.int64()),
                ],
                [*names, "dim", "tab", "bucket"],
            )

    return df.select(*names).mapInArrow(code, f"{keys}, dim int, tab int, bucket bigint")


BUCKET = ["dim", "tab", "bucket"]
FOUND = pa.schema([("query_id", pa.int64()), ("vec_id", pa.int64()), ("score", pa.float64())])


def nearest_in_group(queries: pa.Table, vectors: pa.Table, k: int) -> pa.Table:
    """Of each query the ``k`` nearest of the group, with the ids of equal vectors, without its own id."""
    if not queries.num_rows or not vectors.num_rows:
        return FOUND.empty_table()
    dim = queries.column("dim")[0].as_py()
    matrix = lambda t: t.column("v").combine_chunks().flatten().to_numpy(zero_copy_only=False).reshape(-1, dim)
    q, x = matrix(queries), matrix(vectors)
    own = queries.column("id").to_pylist()
    ids = vectors.column("ids").to_pylist()
    out: tuple[list, list, list] = ([], [], [])
    step = max(1, (1 << 20) // max(1, len(x) * 1))
    for start in range(0, len(q), step):
        part = q[start : start + step]
        distance = np.empty((len(part), len(x)))
        for at in range(0, len(x), 512):
            distance[:, at : at + 512] = np.sqrt(((part[:, None, :] - x[None, at : at + 512, :]) ** 2).sum(axis=2)) if len(part) <= 64 else np.stack(
                [np.sqrt(((row - x[at : at + 512]) ** 2).sum(axis=1)) for row in part]
            )
        # one vector may be the query's own, so one more is looked at; equal distances all count
        most = min(k + 1, len(x))
        limit = np.partition(distance, most - 1, axis=1)[:, most - 1]
        for i, row in enumerate(distance):
            near = np.flatnonzero(row <= limit[i])
            pairs = sorted((float(row[j]), v) for j in near.tolist() for v in ids[j] if v != own[start + i])[:k]
            out[0].extend([own[start + i]] * len(pairs))
            out[1].extend(v for _, v in pairs)
            out[2].extend(s for s, _ in pairs)
    return pa.Table.from_arrays([pa.array(c, f.type) for c, f in zip(out, FOUND, strict=True)], schema=FOUND)


def candidates(queries: DataFrame, classes: DataFrame, axes: dict[int, int], plan: HashPlan, k: int) -> DataFrame:
    """``query_id, vec_id, score``: the nearest in each bucket that a query looks into."""
    index = coded(classes, axes, plan, False, "cls bigint, v array<double>, ids array<bigint>")
    asked = coded(queries, axes, plan, True, "id bigint, v array<double>")
    sizes = coded(classes, axes, plan, False, "cls bigint, v array<double>").groupBy(*BUCKET).count()
    asks = coded(queries, axes, plan, True, "id bigint, v array<double>").groupBy(*BUCKET).agg(F.count(F.lit(1)).alias("asks"))
    split = sizes.join(asks, BUCKET).select(
        *BUCKET,
        F.ceil(F.col("count") / plan.block).cast("int").alias("v_blocks"),
        F.ceil(F.col("asks") / plan.block).cast("int").alias("q_blocks"),
    ).where("v_blocks > 1 OR q_blocks > 1")
    split = materialize(split, "split_buckets")
    blocks = lambda n: F.coalesce(n, F.lit(1))
    every = lambda n: F.explode(F.sequence(F.lit(0), blocks(F.col(n)) - 1))
    own = lambda key, n: F.pmod(F.xxhash64(key), blocks(F.col(n))).cast("int")
    left = asked.join(split, BUCKET, "left").withColumns({"q_block": own("id", "q_blocks")}).withColumn("v_block", every("v_blocks"))
    right = index.join(split, BUCKET, "left").withColumns({"v_block": own("cls", "v_blocks")}).withColumn("q_block", every("q_blocks"))
    group = [*BUCKET, "v_block", "q_block"]

    def nearest(a: pa.Table, b: pa.Table) -> pa.Table:
        return nearest_in_group(a, b, k)

    return (
        left.select(*group, "id", "v").groupBy(*group)
        .cogroup(right.select(*group, "ids", "v").groupBy(*group))
        .applyInArrow(nearest, "query_id bigint, vec_id bigint, score double")
    )


def best(found: DataFrame, k: int) -> DataFrame:
    """The ``k`` nearest of each query, nearest first, ties to the smaller id."""
    order = Window.partitionBy("query_id").orderBy("score", "vec_id")
    once = found.groupBy("query_id", "vec_id").agg(F.min("score").alias("score"))
    return once.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def nearest(
    df: DataFrame, queries: DataFrame, k: int = 10, key: str = "vec_id", vector: str = "embedding", plan: HashPlan = HashPlan()
) -> DataFrame:
    """``query_id, rank, vec_id, score``: the ``k`` rows of ``df`` found nearest to each row of ``queries``.

    ``score`` is the Euclidean distance of the vectors as given, in double precision.  The
    query's own id is no candidate.  Ties go to the smaller id; rows that repeat
    an id with an equal vector count once, and of one id with several vectors the nearest.
    Rows with a null id, or a vector that is null, empty, zero or holds a null or a number
    that isn't finite, take no part.  Vectors are compared with those of their own
    dimension.  Of equal vectors the ``k + 1`` smallest ids can be in a result at all, and
    only those are kept, by a limit that works before the shuffle.  A query that finds fewer
    than ``k`` rows is compared with all.  An empty table gives no rows.
    """
    ship(df.sparkSession)
    rows = usable(df, key, vector).distinct()
    nth = Window.partitionBy("v").orderBy("id")
    limited = rows.withColumn("nth", F.row_number().over(nth)).where(F.col("nth") <= k + 1)
    classes = materialize(
        limited.groupBy("v").agg(F.sort_array(F.collect_list("id")).alias("ids")).select(F.element_at("ids", 1).alias("cls"), "v", "ids"),
        "vector_classes",
    )
    asked = materialize(usable(queries, key, vector).distinct(), "queries")
    # one row for each dimension in use
    counts = classes.groupBy(F.size("v").alias("dim")).agg(F.count(F.lit(1)).alias("n")).collect()
    axes = {r["dim"]: plan.axes(r["n"], r["dim"]) for r in counts}
    known = asked.where(F.size("v").isin(list(axes) or [-1]))
    found = materialize(best(candidates(known, classes, axes, plan, k), k), "nearest")
    short = known.join(found.where(F.col("rank") == k), F.col("id") == F.col("query_id"), "left_anti")
    if any(axes.values()) and short.limit(1).count():
        exact = best(candidates(short, classes, dict.fromkeys(axes, 0), plan, k), k)
        found = found.join(short.select(F.col("id").alias("query_id")).distinct(), "query_id", "left_anti").unionByName(exact)
    return found.select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")
