"""Approximate nearest neighbours by cross-polytope hashing.

Each of ``TABLES`` hash tables rotates unit vectors pseudo-randomly (random signs and a
fast Hadamard transform, three times) and assigns each to the nearest signed axis;
the axes of several rotations together name a bucket, with the last rotation cut to
its first coordinates so that buckets hold about ``BUCKET_ROWS`` vectors at every size of
the corpus. A query probes the buckets whose axes are nearest to it, and its
candidates are ranked again by exact cosines.

How many buckets a query probes is fitted: the exact neighbours of at most
``SAMPLE`` queries are found by comparing these, as one block, with all vectors, and
the least number of probes that finds ``RECALL`` of them is taken; all buckets are
the most, and would be exact. Every vector is indexed.

Equal vectors are one class, so a vector that a third of all rows share is hashed and
compared once. A bucket of more than ``BLOCK_ROWS`` vectors, or as many queries, is
compared in blocks of that size; each block gives a query's best few, not its pairs.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from lotwise.llm.common import map_arrow, merge_join, quoted, ship_package, stored

NEAREST = 5
QUERY_STEP = 50
TABLES = 4
BUCKET_ROWS = 256
BLOCK_ROWS = 4096
SAMPLE = 256
RECALL = 0.95
SEED = 20

# --- hashing --------------------------------------------------------------------------------


def hadamard(x: np.ndarray) -> np.ndarray:
    """The fast Walsh-Hadamard transform of each row; their length is a power of two."""
    n, half = x.shape[1], 1
    while half < n:
        pairs = x.reshape(len(x), -1, 2, half)
        x = np.stack([pairs[:, :, 0] + pairs[:, :, 1], pairs[:, :, 0] - pairs[:, :, 1]], axis=2).reshape(len(x), n)
        half *= 2
    return x / np.sqrt(n)


class Hashes:
    """Tables of cross-polytope hashes for vectors of ``dim`` components.

    ``axes`` has the number of coordinates of each rotation of a table.
    """

    def __init__(self, dim: int, rows: int, tables: int = TABLES, bucket_rows: int = BUCKET_ROWS, seed: int = SEED):
        self.dim, self.tables = dim, tables
        self.width = 1 << max(1, (dim - 1).bit_length())
        wanted = max(1, rows // bucket_rows)  # buckets
        self.axes = []
        # 2^60 buckets are more than any corpus needs
        while wanted >= 2 and len(self.axes) * self.width.bit_length() < 60:
            axes = min(self.width, max(1, 1 << (wanted // 2).bit_length() - 1))
            self.axes.append(axes)
            wanted //= 2 * axes
        self.axes = self.axes or [1]
        self.buckets = int(np.prod([2 * a for a in self.axes], dtype=np.int64))
        self.signs = np.random.default_rng(seed).choice([-1.0, 1.0], (tables, len(self.axes), 3, self.width))

    def rotated(self, unit: np.ndarray, table: int) -> list[np.ndarray]:
        """Coordinates of unit vectors after each rotation of a table."""
        padded = np.zeros((len(unit), self.width))
        padded[:, :self.dim] = unit
        out = []
        for signs, axes in zip(self.signs[table], self.axes, strict=True):
            x = padded
            for sign in signs:
                x = hadamard(x * sign)
            out.append(x[:, :axes])
        return out

    def buckets_of(self, unit: np.ndarray) -> np.ndarray:
        """The bucket of each vector in each table, numbered through all tables."""
        out = np.zeros((len(unit), self.tables), np.int64)
        for table in range(self.tables):
            code = np.zeros(len(unit), np.int64)
            for x in self.rotated(unit, table):
                axis = np.abs(x).argmax(axis=1)
                code = code * (2 * x.shape[1]) + 2 * axis + (x[np.arange(len(x)), axis] < 0)
            out[:, table] = table * self.buckets + code
        return out

    def probes(self, unit: np.ndarray, n: int) -> np.ndarray:
        """The ``n`` nearest buckets of one vector in each table, nearest first: a row for each table.

        A bucket's distance is the sum over its axes of the squared distance of their
        coordinate from the largest one.
        """
        n = min(n, self.buckets)
        out = np.zeros((self.tables, n), np.int64)
        for table in range(self.tables):
            far, code = np.zeros(1), np.zeros(1, np.int64)
            for x in self.rotated(unit[None], table):
                sides = np.stack([x[0], -x[0]], axis=1).ravel()
                own = np.square(sides.max() - sides)
                # the n nearest combinations only have axes that are among the n nearest
                near = np.argsort(own, kind="stable")[:n]
                far = (far[:, None] + own[near]).ravel()
                code = (code[:, None] * len(sides) + near).ravel()
                if len(far) > n:
                    best = np.argpartition(far, n - 1)[:n]
                    far, code = far[best], code[best]
            out[table] = table * self.buckets + code[np.argsort(far, kind="stable")]
        return out


# --- exact nearness -------------------------------------------------------------------------


def cosines(queries: np.ndarray, others: np.ndarray) -> np.ndarray:
    """Cosines of rows that stand side by side, summed in the same order wherever they are computed."""
    dot = (queries * others).sum(axis=1)
    return dot / (np.sqrt((queries * queries).sum(axis=1)) * np.sqrt((others * others).sum(axis=1)))


def best(queries: np.ndarray, ids: np.ndarray, others: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of each query the ``k`` nearest others, ties to the smaller id: places of both and cosines."""
    places, found, scores = [], [], []
    near = (queries / np.linalg.norm(queries, axis=1)[:, None]) @ (others / np.linalg.norm(others, axis=1)[:, None]).T
    # products of whole blocks may differ in their last bits; those that could be among the k are computed again
    least = np.partition(near, -k, axis=1)[:, -k] - 1e-9 if near.shape[1] > k else np.full(len(near), -np.inf)
    for place, (row, bar) in enumerate(zip(near, least, strict=True)):
        at = np.flatnonzero(row >= bar)
        exact = cosines(np.broadcast_to(queries[place], (len(at), queries.shape[1])), others[at])
        order = np.lexsort((ids[at], -exact))[:k]
        places.append(np.full(len(order), place))
        found.append(at[order])
        scores.append(exact[order])
    return tuple(np.concatenate(x) for x in (places, found, scores))


def matrix(column: pa.Array, dim: int) -> np.ndarray:
    """Vectors of one length as rows of doubles."""
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(len(column), dim)


_FOUND = "query bigint, rep bigint, least bigint, score double"


def _found(queries: np.ndarray, vectors: np.ndarray, others: pa.RecordBatch | pa.Table, k: int) -> pa.RecordBatch:
    """The nearest of ``others`` (rep, least, vector) for a block of queries."""
    reps, least = (others.column(c).to_numpy() for c in ("rep", "least"))
    place, at, scores = best(vectors, least, matrix(others.column("vector"), vectors.shape[1]), k)
    columns = [queries[place], reps[at], least[at], scores]
    return pa.RecordBatch.from_arrays([pa.array(c) for c in columns], ["query", "rep", "least", "score"])


def _scan(queries: np.ndarray, vectors: np.ndarray, k: int):
    """A block of queries against all vectors."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for begin in range(0, batch.num_rows, BLOCK_ROWS):
                yield _found(queries, vectors, batch.slice(begin, BLOCK_ROWS), k)

    return run


def _indexed(hashes: Hashes):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for begin in range(0, batch.num_rows, BLOCK_ROWS):
                part = batch.slice(begin, BLOCK_ROWS)
                x = matrix(part.column("vector"), hashes.dim)
                buckets = hashes.buckets_of(x / np.linalg.norm(x, axis=1)[:, None])
                yield pa.RecordBatch.from_arrays([*part.columns, pa.array(list(buckets), pa.list_(pa.int64()))],
                                                 [*part.schema.names, "buckets"])

    return run


def _probed(hashes: Hashes, n: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for begin in range(0, batch.num_rows, BLOCK_ROWS):
                part = batch.slice(begin, BLOCK_ROWS)
                x = matrix(part.column("vector"), hashes.dim)
                unit = x / np.linalg.norm(x, axis=1)[:, None]
                buckets = [hashes.probes(u, n).ravel() for u in unit]
                yield pa.RecordBatch.from_arrays([*part.columns, pa.array(buckets, pa.list_(pa.int64()))],
                                                 [*part.schema.names, "buckets"])

    return run


def _compared(k: int):
    def run(queries: pa.Table, others: pa.Table) -> pa.Table:
        if not (queries.num_rows and others.num_rows):
            empty = pa.array([], pa.int64())
            return pa.table({"query": empty, "rep": empty, "least": empty, "score": pa.array([], pa.float64())})
        vectors = matrix(queries.column("vector"), len(queries.column("vector")[0]))
        return pa.Table.from_batches([_found(queries.column("rep").to_numpy(), vectors, others, k)])

    return run


def _nearest(found: DataFrame, k: int) -> DataFrame:
    """The ``k`` nearest classes of each query."""
    rank = F.row_number().over(Window.partitionBy("query").orderBy(F.desc("score"), "least"))
    once = found.groupBy("query", "rep", "least").agg(F.max("score").alias("score"))
    return once.withColumn("at", rank).where(F.col("at") <= k).drop("at")


# --- the operator ---------------------------------------------------------------------------


def classes_of(vectors: DataFrame, k: int) -> DataFrame:
    """Distinct vectors: ``rep`` (any number of their own), ``dim``, ``vector``, ``members`` (the smallest ids, ``k`` at most),
    ``least`` (the smallest) and the number of queries among all members, ``asked``. To be stored, as the numbers are drawn."""
    least = vectors.withColumn("at", F.row_number().over(Window.partitionBy("vector").orderBy("vec_id"))).where(F.col("at") <= k)
    members = least.groupBy("vector").agg(F.array_sort(F.collect_list("vec_id")).alias("members"))
    asked = vectors.groupBy(F.col("vector").alias("of")).agg(F.sum(F.col("is_query").cast("long")).alias("asked"))
    same = merge_join(members, asked, F.col("vector") == F.col("of"))
    return same.select(F.monotonically_increasing_id().alias("rep"), F.col("members")[0].alias("least"), F.size("vector").alias("dim"),
                       "vector", "members", "asked")


def fitted_probes(classes: DataFrame, hashes: Hashes, k: int, sample: int, recall: float) -> int:
    """The least number of probes a table with which the sample's queries meet ``recall`` of their nearest classes."""
    asked = classes.where("asked > 0").orderBy(F.xxhash64("rep")).limit(sample).select("rep", "vector").collect()
    reps, vectors = np.array([r.rep for r in asked]), np.array([r.vector for r in asked], np.float64)
    found = map_arrow(classes.select("rep", "least", "vector"), _scan(reps, vectors, k), _FOUND)
    exact = _nearest(found, k).where("rep <> query").select("query", F.col("rep").alias("near"))
    wanted = merge_join(classes.select("rep", "buckets"), exact, F.col("rep") == F.col("near")).select("query", "buckets").collect()
    order = {}
    for rep, vector in zip(reps.tolist(), vectors, strict=True):
        order[rep] = hashes.probes(vector / np.linalg.norm(vector), MOST_PROBES)
    ranks = []
    for row in wanted:
        at = [np.flatnonzero(tried == bucket) for tried, bucket in zip(order[row.query], row.buckets, strict=True)]
        ranks.append(min((a[0] for a in at if len(a)), default=np.inf))
    if not ranks:
        return 1
    needed = np.sort(ranks)[max(0, int(np.ceil(recall * len(ranks))) - 1)]
    return hashes.buckets if np.isinf(needed) else int(needed) + 1


# beyond so many probes a table every bucket is probed
MOST_PROBES = 1 << 14


def _search(classes: DataFrame, hashes: Hashes, probes: int, k: int, block_rows: int) -> DataFrame:
    """The nearest classes found for each class with queries."""
    index = classes.select("rep", "least", "vector", F.explode("buckets").alias("bucket"))
    asked = map_arrow(classes.where("asked > 0").select("rep", "least", "vector"), _probed(hashes, probes),
                      _vector_schema(classes) + ", buckets array<bigint>")
    asked = stored(asked, "probes").select("rep", "least", "vector", F.explode("buckets").alias("bucket"))
    sides = {"index": index, "asked": asked}
    # only buckets of more than a block have a row here
    large = None
    for name, side in sides.items():
        n = side.groupBy("bucket").agg(F.ceil(F.count("*") / block_rows).cast("int").alias(name)).where(F.col(name) > 1)
        large = n if large is None else large.join(n, "bucket", "full")
    large = stored(large.select(F.col("bucket").alias("of"), *[F.coalesce(s, F.lit(1)).alias(f"{s}_blocks") for s in sides]), "large")
    groups = {}
    for name, side in sides.items():
        other = next(s for s in sides if s != name)
        blocks, others = (F.coalesce(f"{s}_blocks", F.lit(1)) for s in (name, other))
        cut = side.join(large, F.col("bucket") == F.col("of"), "left")
        groups[name] = cut.select("bucket", F.pmod(F.xxhash64("rep"), blocks).cast("int").alias(name),
                                  F.explode(F.sequence(F.lit(0), others - 1)).alias(other), "rep", "least", "vector").groupBy("bucket", "index", "asked")
    return groups["asked"].cogroup(groups["index"]).applyInArrow(_compared(k), _FOUND)


def _vector_schema(classes: DataFrame) -> str:
    return f"rep bigint, least bigint, vector {classes.schema['vector'].dataType.simpleString()}"


def nearest_neighbours(vectors: DataFrame, queries: str | None = None, id_col: str = "vec_id", vector_col: str = "embedding", k: int = NEAREST,
                       tables: int = TABLES, bucket_rows: int = BUCKET_ROWS, block_rows: int = BLOCK_ROWS, sample: int = SAMPLE,
                       recall: float = RECALL) -> DataFrame:
    """The ``k`` rows nearest to each query by cosine, of all rows but the query itself.

    ``queries`` is a condition on the column ``vec_id``, by default ids divisible by
    ``QUERY_STEP``. Returns ``query_id``, ``rank`` (from 1), ``vec_id`` and ``score``, the
    cosine of the original vectors in double precision; equal scores go by the smaller id.
    All candidates come back where there are fewer than ``k``.

    Vectors that are null, zero or empty, or hold null or non-finite components, and
    rows without an id, take no part. Vectors are compared with those of the same
    length. Rows that repeat an id are rows of their own, and find each other. Other
    columns are not read; without a query the result is empty.
    """
    spark = vectors.sparkSession
    condition = F.expr(queries) if queries else F.col("vec_id") % QUERY_STEP == 0
    rows = vectors.select(F.col(quoted(id_col)).cast("long").alias("vec_id"), F.col(quoted(vector_col)).alias("vector"))
    norm = F.aggregate("vector", F.lit(0.0), lambda s, x: s + x.cast("double") * x.cast("double"))
    usable = F.col("vec_id").isNotNull() & F.col("vector").isNotNull() & ~F.exists("vector", lambda x: x.isNull()) & (norm > 0) & (norm < float("inf"))
    rows = rows.where(F.coalesce(usable, F.lit(False))).withColumn("is_query", F.coalesce(condition, F.lit(False)))
    rows = stored(rows, "vectors")
    classes = stored(classes_of(rows, k + 1), "classes")
    sizes = {r.dim: r["count"] for r in classes.where("asked > 0").groupBy("dim").count().collect()}
    sizes = {dim: classes.where(F.col("dim") == dim).count() for dim in sizes}
    ship_package(spark)
    out = spark.createDataFrame([], _FOUND)
    for dim, n in sorted(sizes.items()):
        hashes = Hashes(dim, n, tables, bucket_rows)
        own = classes.where(F.col("dim") == dim).select("rep", "least", "vector", "asked")
        own = stored(map_arrow(own, _indexed(hashes), _vector_schema(own) + ", asked bigint, buckets array<bigint>"), "index")
        probes = fitted_probes(own, hashes, k + 1, sample, recall)
        out = out.unionByName(_nearest(_search(own, hashes, probes, k + 1, block_rows), k + 1))
    near = stored(out, "nearest")

    members = classes.select(F.col("rep").alias("of"), "members")
    each = merge_join(near, members, F.col("rep") == F.col("of")).select("query", "rep", "score", F.explode("members").alias("vec_id"))
    order = Window.partitionBy("query").orderBy(F.desc("score"), "vec_id")
    each = each.withColumn("at", F.row_number().over(order)).where(F.col("at") <= k + 1)
    reps = classes.where("asked > 0").select(F.col("rep").alias("query"), F.col("vector").alias("of_vector"))
    asking = merge_join(rows.where("is_query").select(F.col("vec_id").alias("query_id"), "vector"), reps, F.col("vector") == F.col("of_vector"))
    asking = asking.select("query_id", F.col("query").alias("of_query"), F.monotonically_increasing_id().alias("row"))
    lists = each.groupBy("query").agg(F.array_sort(F.collect_list(F.struct("at", "rep", "vec_id", "score"))).alias("near"))
    result = merge_join(asking, lists, F.col("of_query") == F.col("query"))
    # the query's own row: one of its class with its id
    own = F.expr("filter(near, x -> x.rep = of_query AND x.vec_id = query_id)")
    left = F.expr(f"slice(filter(near, x -> own IS NULL OR x.at <> own), 1, {k})")
    result = result.withColumn("own", F.when(F.size(own) > 0, own[0]["at"])).withColumn("near", left)
    result = result.select("query_id", F.posexplode("near").alias("place", "found"))
    return result.select("query_id", (F.col("place") + 1).cast("int").alias("rank"), "found.vec_id", "found.score")
