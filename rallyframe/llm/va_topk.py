"""Exact top-k by inner product over vector-approximation files.

Each component is replaced by the number of its cell between quantiles of that dimension. The scan
reads cells alone: with the cells' smallest and largest values it bounds every score from both
sides. Per query the k-th best lower bound rules out all vectors of smaller upper bound; the exact
vectors of the rest are read in order of their upper bound, first the best few, then those that
the k-th exact score so far does not rule out, so the answer is certain.

Equal vectors are one class, searched once; of a class only its k + 1 smallest ids can be in an
answer. Query classes meet the classes in blocks (QUERY_ROWS x VECTOR_ROWS), one task each.

Cases: vectors that are null or hold null or non-finite components take no part, nor do null ids; vectors
of different lengths have no inner product, so each length, the empty one included, is searched by
itself; of several vectors under one id the greatest counts; ties go to the smaller id; a query with fewer
candidates returns all; an id never finds itself. Scores are exact decimals of 38 digits; bounds are
doubles, widened by what rounding can do to them. Components of 10**18 and more are an error.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from rallyframe.workspace import materialise

CELLS = 64               # per dimension
LARGEST = 1e18           # components are smaller, so that products and their sums fit a decimal
SCORE = "decimal(38,0)"
CELL_SAMPLE = 20_000     # vectors that the cells' borders are fitted on, at most
QUERY_ROWS, VECTOR_ROWS = 2048, 16_384
AT_ONCE = 128            # queries bounded at once
FIRST_READ = 2           # exact vectors read first, in multiples of k


@dataclass
class Cells:
    borders: list[np.ndarray]   # per dimension: ascending first values of the cells but the first
    low: np.ndarray             # dimension x cell: least and greatest value held
    high: np.ndarray


def clean_vectors(vectors: DataFrame, vec_id: str, vector: str, value) -> DataFrame:
    """(vec_id, v): finite vectors with ``value`` applied to each component, whole numbers as doubles."""
    sound = ~F.exists(vector, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))

    def whole(x: Column) -> Column:
        y = value(x).cast("double")
        return F.when(F.abs(y) < LARGEST, y).otherwise(F.raise_error(F.lit(f"a component is not below {LARGEST:g}")).cast("double"))

    return (vectors.where(F.col(vec_id).isNotNull() & F.col(vector).isNotNull() & F.coalesce(sound, F.lit(False)))
            .select(F.col(vec_id).cast("long").alias("vec_id"), F.transform(vector, whole).alias("v")))


def whole_part(x: Column) -> Column:
    """The greatest whole number up to a double, as a double of any size."""
    return x - F.pmod(x, F.lit(1.0))


def fit_cells(vectors: DataFrame) -> Cells | None:
    """Borders at quantiles of a sample; the outer cells reach to the exact extremes of all vectors."""
    sample = vectors.orderBy(F.xxhash64("vec_id"), "vec_id").limit(CELL_SAMPLE).select("v")
    size = sample.select(F.size("v").alias("n")).first()
    if size is None or not size.n:
        return None
    levels = [i / CELLS for i in range(1, CELLS)]
    long = sample.select(F.posexplode("v").alias("d", "x"))
    cuts = {r.d: r.q for r in long.groupBy("d").agg(F.percentile("x", F.array(*map(F.lit, levels))).alias("q")).collect()}
    ends = vectors.select(F.posexplode("v").alias("d", "x")).groupBy("d").agg(F.min("x").alias("low"), F.max("x").alias("high")).orderBy("d").collect()
    borders = [np.unique(np.ceil(cuts[d])) for d in range(size.n)]
    low, high = np.zeros((size.n, CELLS)), np.zeros((size.n, CELLS))
    for d, end in enumerate(ends):
        borders[d] = borders[d][borders[d] > end.low]
        full = len(borders[d]) + 1
        low[d, :full] = [end.low, *borders[d]]
        high[d, :full] = [*(borders[d] - 1), max(end.high, low[d, full - 1])]  # components are whole numbers
    return Cells(borders, low, high)


def _matrix(lists: pa.Array) -> np.ndarray:
    flat = lists.flatten().to_numpy(zero_copy_only=False)
    return flat.reshape(len(lists), -1)


def approximate(vectors: DataFrame, cells: Cells) -> DataFrame:
    """(vec_id, cells): a byte per dimension."""
    shared = vectors.sparkSession.sparkContext.broadcast(cells)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            values = _matrix(batch.column("v"))
            code = np.column_stack([np.searchsorted(b, values[:, d], "right") for d, b in enumerate(shared.value.borders)]).astype(np.uint8)
            yield pa.RecordBatch.from_arrays([batch.column("vec_id"), pa.array([c.tobytes() for c in code], pa.binary())], names=["vec_id", "cells"])

    return vectors.select("vec_id", "v").mapInArrow(run, "vec_id long, cells binary")


def candidates(queries: DataFrame, approximations: DataFrame, cells: Cells, k: int) -> DataFrame:
    """(query_id, vec_id, low, high): what the cells' bounds cannot rule out of the best k, block by block."""
    shared = queries.sparkSession.sparkContext.broadcast(cells)
    n_q, n_v = (max(1, -(-d.count() // rows)) for d, rows in ((queries, QUERY_ROWS), (approximations, VECTOR_ROWS)))
    block = lambda n, own: F.pmod(F.xxhash64(own), F.lit(n)).cast("int")
    left = queries.select(F.col("vec_id").alias("id"), "v", block(n_q, "vec_id").alias("qb"), F.explode(F.sequence(F.lit(0), F.lit(n_v - 1))).alias("vb"))
    right = approximations.select(F.col("vec_id").alias("id"), "cells", F.explode(F.sequence(F.lit(0), F.lit(n_q - 1))).alias("qb"), block(n_v, "vec_id").alias("vb"))

    def bound(a: pa.Table, b: pa.Table) -> pa.Table:
        held, at = shared.value, [[], [], [], []]
        if a.num_rows and b.num_rows:
            q = _matrix(a.column("v").combine_chunks()).astype(np.float64)
            code = np.frombuffer(b"".join(b.column("cells").to_pylist()), np.uint8).reshape(b.num_rows, -1)
            dims = np.arange(code.shape[1])
            low, high = held.low[dims, code], held.high[dims, code]
            ids, own = b.column("id").to_numpy(), a.column("id").to_numpy()
            for i in range(0, len(q), AT_ONCE):
                up, down = np.maximum(q[i:i + AT_ONCE], 0), np.minimum(q[i:i + AT_ONCE], 0)
                least, most = up @ low.T + down @ high.T, up @ high.T + down @ low.T
                slack = (len(dims) + 4) * np.finfo(float).eps * ((up - down) @ np.maximum(np.abs(low), np.abs(high)).T)
                least, most = least - slack, most + slack
                sure = np.partition(least, -k, axis=1)[:, -k] if least.shape[1] > k else np.full(len(least), -np.inf)
                row, col = np.nonzero(most >= sure[:, None])
                for x, y in zip(at, (own[i + row], ids[col], least[row, col], most[row, col])):
                    x.append(y)
        names = ("query_id", "vec_id", "low", "high")
        kinds = (np.int64, np.int64, np.float64, np.float64)
        return pa.table({n: np.concatenate([np.zeros(0, kind), *x]).astype(kind) for n, x, kind in zip(names, at, kinds)})

    grouped = left.groupBy("qb", "vb").cogroup(right.groupBy("qb", "vb"))
    return grouped.applyInArrow(bound, "query_id long, vec_id long, low double, high double")


def _kth(rows: DataFrame, score: str, k: int) -> DataFrame:
    """Per query the k-th highest score; none where there are fewer."""
    best = Window.partitionBy("query_id").orderBy(F.col(score).desc(), "vec_id")
    return rows.withColumn("rank", F.row_number().over(best)).where(F.col("rank") == k).select("query_id", F.col(score).alias("kth"))


def _at_least(rows: DataFrame, bound: DataFrame, upper: str) -> DataFrame:
    return rows.join(bound, "query_id", "left").where(F.col("kth").isNull() | (F.col(upper) >= F.col("kth"))).drop("kth")


def best_classes(classes: DataFrame, queries: DataFrame, cells: Cells, k: int) -> DataFrame:
    """(query_id, vec_id, score): the k highest of distinct vectors (vec_id, v), ties to the smaller id."""
    found = materialise(candidates(queries, approximate(classes, cells), cells, k), "candidates")
    found = _at_least(found, _kth(found, "low", k), "high")
    turn = F.row_number().over(Window.partitionBy("query_id").orderBy(F.col("high").desc(), "vec_id"))
    found = materialise(found.withColumn("first", turn <= FIRST_READ * k).select("query_id", "vec_id", "high", "first"), "bounded")
    query = queries.select(F.col("vec_id").alias("query_id"), F.col("v").alias("q"))

    def exact(pairs: DataFrame) -> DataFrame:
        """Read the exact vectors of these pairs."""
        number = lambda x: x.cast("decimal(18,0)")
        product = F.aggregate(F.zip_with("q", "v", lambda a, b: number(a) * number(b)), F.lit(0).cast(SCORE), lambda s, x: (s + x).cast(SCORE))
        return pairs.join(classes, "vec_id").join(query, "query_id").select("query_id", "vec_id", product.alias("score"))

    early = materialise(exact(found.where("first")), "read")
    late = exact(_at_least(found.where("NOT first"), _kth(early, "score", k), "high"))
    best = Window.partitionBy("query_id").orderBy(F.col("score").desc(), "vec_id")
    return early.union(late).withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k).drop("rank")


def top_k(vectors: DataFrame, is_query: Column, k: int, vec_id: str = "vec_id", vector: str = "embedding", value=lambda x: x) -> DataFrame:
    """(query_id, rank, vec_id, score): the k highest inner products of whole-number vectors, exactly.

    ``value`` turns a component into a whole number; ``is_query`` is a condition on ``vec_id``.
    """
    clean = clean_vectors(vectors, vec_id, vector, value).withColumn("size", F.size("v"))
    rows = materialise(clean.groupBy("vec_id").agg(F.max(F.struct("size", "v")).alias("most")).select("vec_id", "most.*"), "vectors")
    answer = vectors.sparkSession.createDataFrame([], f"query_id long, rank int, vec_id long, score {SCORE}")
    for r in rows.select("size").distinct().orderBy("size").collect():  # one row per length
        answer = answer.unionByName(_of_one_length(rows.where(F.col("size") == r["size"]).drop("size"), is_query, k))
    return answer


def _of_one_length(rows: DataFrame, is_query: Column, k: int) -> DataFrame:
    cells = fit_cells(rows)
    classes = materialise(rows.groupBy("v").agg(F.min("vec_id").alias("vec_id")), "classes")
    member_of = materialise(rows.join(classes.withColumnRenamed("vec_id", "class"), "v").select("vec_id", "class"), "members")
    place = F.row_number().over(Window.partitionBy("class").orderBy("vec_id"))
    members = member_of.withColumn("place", place).where(F.col("place") <= k + 1).select("vec_id", F.col("class").alias("found"))
    asking = member_of.where(is_query).select(F.col("vec_id").alias("query_id"), "class")
    queries = classes.join(asking.select(F.col("class").alias("vec_id")).distinct(), "vec_id")
    if cells is None:  # empty vectors are one class, and all its products are zero
        best = queries.select(F.col("vec_id").alias("class"), F.col("vec_id").alias("found"), F.lit(0).cast(SCORE).alias("score"))
    else:
        best = best_classes(classes, queries, cells, k + 1).select(F.col("query_id").alias("class"), F.col("vec_id").alias("found"), "score")
    pairs = best.join(members, "found").join(asking, "class").where("vec_id <> query_id")
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy(F.col("score").desc(), "vec_id"))
    return pairs.withColumn("rank", rank).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
