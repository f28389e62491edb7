"""Operator 13: centroid clustering by progressive search over Walsh-Hadamard coefficients.

Squared Euclidean k-means on integer vectors.  The transform H is orthogonal
but for a factor: |Hx - Hc|^2 = d |x - c|^2 for vectors of d components, so
the differences of coefficients add up to d times the distance, and every
partial sum is a lower bound of it.

1. ``transformed`` - vectors become integers, floor(factor * x), and then
   their exact integer transform, coefficients in order of sequency (coarse
   to fine).  Written once; every round scans this table.
2. ``nearest`` - for a batch of vectors and all centroids the squared
   differences are added up level by level (1, 1, 2, 4, ... coefficients).
   After each level the vector's best candidate so far is finished, and every
   centroid whose partial sum is strictly above that distance is eliminated.
   Those left are finished over all coefficients; ties go to the smaller
   number, which only the strict comparison keeps right.
3. A round gives sums of coefficients per centroid.  Tasks add up what they
   read and Spark adds up the tasks: the driver gets at most ``k`` rows of
   ``d`` numbers.  The transform is linear, so undoing it on the sums gives
   the exact sums of components, hence exact floor(sum / count).

Everything that a task holds is one batch and the centroids; no vectors are
shuffled, so a vector that a third of all rows share makes no task larger.
The centroids of a round are small values in the tasks' code; a lost executor
repeats its scan.

Defined results: vectors that are null, hold a null or non-finite component
or have another number of components take no part and give no row; every row
counts, repeated rows too; a null id takes part (hashed as the empty text);
with fewer than ``k`` vectors there are as many centroids as vectors; an empty
table gives no rows; equal start hashes go by the vectors themselves;
integer components stop at +-2**27, where distances still fit a long; an
inertia beyond a long is null; extra columns stay.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from siniestro.llm.columns import set_aside
from siniestro.session import materialize

DIM = 64
K = 40
ROUNDS = 5
SEED = 2
FACTOR = 256
ROWS = 2048
"""Vectors searched together."""

_LARGEST = 1 << 27

OUT = ("cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256")


def sequency(dim: int) -> np.ndarray:
    """Rows of the natural transform, those with fewest sign changes first."""
    signs = np.ones((1, 1), np.int8)
    while len(signs) < dim:
        signs = np.block([[signs, signs], [signs, -signs]])
    return np.argsort((signs[:, 1:] != signs[:, :-1]).sum(axis=1), kind="stable")


def walsh(vectors: np.ndarray) -> np.ndarray:
    """Exact transform of integer rows, natural order; applied twice it multiplies by the row length."""
    out = vectors.copy()
    n, dim = out.shape
    step = 1
    while step < dim:
        pair = out.reshape(n, dim // (2 * step), 2, step)
        out = np.stack((pair[:, :, 0] + pair[:, :, 1], pair[:, :, 0] - pair[:, :, 1]), axis=2).reshape(n, dim)
        step *= 2
    return out


def levels(dim: int) -> list[tuple[int, int]]:
    """Runs of coefficients: 1, 1, 2, 4, ... of them."""
    bounds = [0, 1]
    while bounds[-1] < dim:
        bounds.append(2 * bounds[-1])
    return list(zip(bounds[:-1], bounds[1:], strict=True))


def nearest(x: np.ndarray, centroids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(number, d times the squared distance) of the nearest centroid of every row; both sides coefficients."""
    if not len(x):
        return np.zeros(0, np.int64), np.zeros(0, x.dtype)
    (_, first), *rest = levels(x.shape[1])
    delta = x[:, None, :first] - centroids[None, :, :first]
    part = (delta * delta).sum(axis=2)
    lead = part.argmin(axis=1)

    def whole(rows, numbers):
        delta = x[rows] - centroids[numbers]
        return (delta * delta).sum(axis=1)

    bound = whole(np.arange(len(x)), lead)
    row, number = np.nonzero(part <= bound[:, None])
    part = part[row, number]
    for lo, hi in rest:
        delta = x[row, lo:hi] - centroids[number, lo:hi]
        part = part + (delta * delta).sum(axis=1)
        starts = np.flatnonzero(np.r_[True, row[1:] != row[:-1]])  # no row loses its nearest centroid
        if hi < x.shape[1]:
            least = np.minimum.reduceat(part, starts)
            at = np.flatnonzero(part == np.repeat(least, np.diff(np.r_[starts, len(row)])))
            at = at[np.r_[True, row[at][1:] != row[at][:-1]]]
            bound = np.minimum(bound, whole(row[at], number[at]))
            left = part <= bound[row]
            row, number, part = row[left], number[left], part[left]
    least = np.minimum.reduceat(part, starts)
    at = np.flatnonzero(part == np.repeat(least, np.diff(np.r_[starts, len(row)])))
    at = at[np.r_[True, row[at][1:] != row[at][:-1]]]
    return number[at], part[at]


def usable(vector: Column, dim: int = DIM) -> Column:
    """True for vectors that take part."""
    bad = F.exists(vector, lambda x: x.isNull() | F.isnan(x.cast("double"))
                   | (F.abs(x.cast("double")) == float("inf")))
    return vector.isNotNull() & (F.size(vector) == dim) & ~F.coalesce(bad, F.lit(True))


def _rows_of(column: pa.Array | pa.ChunkedArray, dim: int) -> np.ndarray:
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    return column.flatten().to_numpy(zero_copy_only=False).reshape(-1, dim)


def transformed(rows: DataFrame, vector: str, dim: int = DIM, factor: int = FACTOR) -> DataFrame:
    """The usable rows' columns but ``vector``, and ``coefs array<long>``."""
    order = sequency(dim)
    whole = F.transform(F.col(vector), lambda x: F.greatest(F.lit(-_LARGEST), F.least(
        F.lit(_LARGEST), F.floor(x.cast("double") * float(factor)).cast("long"))).cast("long"))
    some = rows.filter(usable(F.col(vector), dim)).withColumn("coefs", whole)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at = batch.schema.get_field_index("coefs")
            flat = walsh(_rows_of(batch.column(at), dim))[:, order].ravel()
            lists = pa.ListArray.from_arrays(pa.array(np.arange(0, len(flat) + 1, dim), pa.int32()), pa.array(flat))
            yield pa.RecordBatch.from_arrays([*batch.columns[:at], lists], names=batch.schema.names)

    some = some.select(*(c for c in some.columns if c not in (vector, "coefs")), "coefs")
    return some.mapInArrow(work, some.schema)


def _ready(coefs: np.ndarray, centroids: list[list[int]]) -> tuple[np.ndarray, np.ndarray]:
    """Both sides in 64 bits where the sums of squares fit, else as Python's integers."""
    limit = math.isqrt((1 << 62) // (4 * coefs.shape[1]))
    small = max((abs(c) for row in centroids for c in row), default=0) <= limit and (
        not coefs.size or int(np.abs(coefs).max()) <= limit)
    kind = np.int64 if small else object
    return coefs.astype(kind), np.array(centroids, dtype=kind)


def _sums(table: DataFrame, centroids: list[list[int]], dim: int) -> list:
    """(number, vectors, sums of coefficients) of every centroid that has vectors."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        count = np.zeros(len(centroids), np.int64)
        total = np.zeros((len(centroids), dim), object)
        for batch in batches:
            coefs = _rows_of(batch.column(0), dim)
            for at in range(0, len(coefs), ROWS):
                part, cents = _ready(coefs[at:at + ROWS], centroids)
                number, _ = nearest(part, cents)
                for c in np.unique(number):
                    mine = part[number == c]
                    count[c] += len(mine)
                    total[c] += mine.sum(axis=0)
        has = np.flatnonzero(count)
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.repeat(has, dim), pa.int32()), pa.array(np.tile(np.arange(dim), len(has)), pa.int32()),
             pa.array(np.repeat(count[has], dim), pa.int64()),
             pa.array([int(v) for v in total[has].ravel()], pa.int64())], names=["number", "at", "n", "total"])

    sums = (table.select("coefs").mapInArrow(work, "number int, at int, n long, total long")
            .groupBy("number", "at").agg(F.sum("n").alias("n"), F.sum(F.col("total").cast("decimal(38,0)")).alias("total"))
            .groupBy("number").agg(F.max("n").alias("n"), F.sort_array(F.collect_list(F.struct("at", "total"))).alias("s")))
    return [(r[0], r[1], [int(x["total"]) for x in r[2]]) for r in sums.collect()]  # at most k rows


def _moved(old: list[int], n: int, sums: list[int], order: np.ndarray) -> list[int]:
    """Coefficients of floor(sum / count): back to components, divided, transformed again."""
    natural = np.empty((1, len(sums)), object)
    natural[0, order] = sums
    components = [int(v) // len(sums) // n for v in walsh(natural)[0]]
    return [int(v) for v in walsh(np.array([components], object))[0][order]]


def _components(coefs: list[int], order: np.ndarray) -> list[int]:
    natural = np.empty((1, len(coefs)), object)
    natural[0, order] = coefs
    return [int(v) // len(coefs) for v in walsh(natural)[0]]


def cluster(rows: DataFrame, id_: str = "vec_id", vector: str = "embedding", k: int = K, rounds: int = ROUNDS,
            dim: int = DIM, factor: int = FACTOR, seed: int = SEED) -> DataFrame:
    """The usable ``rows`` with ``cluster``, ``distance``, ``cluster_inertia``, ``inertia``, ``centroid_sha256``.

    ``dim`` is a power of two.  The start: the vectors with the smallest
    sha256 of ``seed:id``.
    """
    if dim & (dim - 1) or dim < 2:
        raise ValueError("the transform needs a power of two")
    away, back = set_aside(rows, *OUT)
    order = sequency(dim)
    named = rows.select(*away, F.col(f"`{id_}`").alias("_id"), F.col(f"`{vector}`").alias("_vector"))
    table = materialize(transformed(named, "_vector", dim, factor), "walsh-vectors")
    draw = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("_id").cast("string"), F.lit(""))), 256)
    start = table.select("coefs", draw.alias("draw")).orderBy("draw", "coefs").limit(k).collect()  # k rows
    centroids = [[int(c) for c in r["coefs"]] for r in start]
    for _ in range(rounds if centroids else 0):
        for number, n, sums in _sums(table, centroids, dim):
            centroids[number] = _moved(centroids[number], n, sums, order)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            coefs = _rows_of(batch.column(batch.schema.get_field_index("coefs")), dim)
            numbers, distances = [np.zeros(0, np.int32)], [np.zeros(0, np.int64)]
            for at in range(0, len(coefs), ROWS):
                number, total = nearest(*_ready(coefs[at:at + ROWS], centroids))
                numbers.append(number.astype(np.int32))
                distances.append((total // dim).astype(np.int64))
            kept = [i for i, name in enumerate(batch.schema.names) if name != "coefs"]
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(i) for i in kept), pa.array(np.concatenate(numbers)), pa.array(np.concatenate(distances))],
                names=[*(batch.schema.names[i] for i in kept), "cluster", "distance"])

    plain = table.drop("coefs")
    schema = plain.withColumns({"cluster": F.lit(0), "distance": F.lit(0).cast("long")}).schema
    placed = materialize(table.mapInArrow(work, schema), "walsh-clusters")
    inertia = placed.groupBy("cluster").agg(F.try_sum("distance").alias("cluster_inertia"))
    digests = rows.sparkSession.createDataFrame(
        [(i, hashlib.sha256(",".join(map(str, _components(c, order))).encode()).hexdigest())
         for i, c in enumerate(centroids)], "cluster int, centroid_sha256 string")
    known = inertia.join(F.broadcast(digests), "cluster").crossJoin(  # k rows and one row
        F.broadcast(placed.agg(F.try_sum("distance").alias("inertia"))))
    return placed.join(F.broadcast(known), "cluster").select(*back, *OUT)  # k rows


def op13_walsh_clusters(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = spark.read.parquet(f"{sf_dir}/embeddings.parquet").select("vec_id", "embedding")
    return cluster(vectors).select("vec_id", *OUT)


def _sql(k: int = K, rounds: int = ROUNDS) -> str:
    steps = []
    for r in range(rounds + 1):
        steps.append(f"""
a{r} as (
  select row_no, arg_min(number, away * {k} + number) as cluster, min(away) as away
  from (select v.row_no, c.number, cast(sum((v.x - c.x) * (v.x - c.x)) as bigint) as away
        from v join c{r} c using (pos) group by v.row_no, c.number) group by row_no)""")
        if r < rounds:
            steps.append(f"""
c{r + 1} as (
  select c.number, c.pos, cast(case when m.n is null then c.x else (m.s - ((m.s % m.n) + m.n) % m.n) // m.n end
                              as bigint) as x
  from c{r} c left join (
    select a.cluster as number, v.pos, cast(sum(v.x) as bigint) as s, count(*) as n
    from a{r} a join v using (row_no) group by a.cluster, v.pos) m using (number, pos))""")
    return f"""
with q as (
  select row_number() over () as row_no, vec_id,
         list_transform(embedding, lambda e: cast(floor(256 * cast(e as double)) as bigint)) as x
  from embeddings where embedding is not null and len(embedding) = {DIM}
    and len(list_filter(embedding, lambda e: e is null or not isfinite(e))) = 0),
v as (select row_no, unnest(range({DIM})) as pos, unnest(x) as x from q),
c0 as (
  select number, unnest(range({DIM})) as pos, unnest(x) as x
  from (select row_number() over (order by sha256(concat('{SEED}:', vec_id)), x) - 1 as number, x from q)
  where number < {k}),{",".join(steps)}
select q.vec_id, cast(a.cluster as integer) as cluster, a.away as distance,
       cast(sum(a.away) over (partition by a.cluster) as bigint) as cluster_inertia,
       cast(sum(a.away) over () as bigint) as inertia, s.h as centroid_sha256
from a{rounds} a join q using (row_no)
join (select number, sha256(string_agg(cast(x as varchar), ',' order by pos)) as h from c{rounds} group by number) s
  on s.number = a.cluster
"""


QUERIES = {"op13_walsh_clusters": op13_walsh_clusters}
ORACLE = {"op13_walsh_clusters": _sql()}
