"""Operator 1: exact top-k by inner product, best-first over M-trees.

The inner product is no metric; with one more component sqrt(M - |x|^2) for
every vector (M: the largest squared norm) and zero for queries, the squared
distance of query and vector is M + |q|^2 - 2 q.x, so the nearest vectors are
those with the largest product.  Distances serve as bounds only; the scores
are exact integers.

1. Pivots (a bounded sample of rows, see ``MAX_PIVOTS``) cut the vectors into
   cells; a cell larger than ``TREE_ROWS`` is cut again by pivots of its own.
   Only what pivots cannot tell apart (equal vectors) is cut by a hash of the
   id, so a vector that a third of all rows share fills no tree.
2. One task builds each tree: pages of at most ``PAGE`` entries, every inner
   node with its routing vector, covering radius and distance to its parent,
   every leaf entry with its distance to the leaf's routing vector.  Pages are
   rows of a table in the shared checkpoint folder; every vector is in one.
3. A query is first answered on one tree of its own cell, which bounds the
   distance that matters; then on the ``NEAR`` next cells by their bound
   (triangle inequality on inner and outer radius), with the bound updated;
   then on every cell that can still hold something as near.  Queries travel
   in blocks of at most ``QUERY_BLOCK`` a task.
4. In a tree queries go best first together: of the nodes a query knows, the
   one with the least distance that it can hold is its first choice, until
   none is nearer than its k-th best.  A step takes the first choice of most
   queries, for all queries that it can still serve, as one matrix product,
   so no page is taken more than once.  The stored parent distances rule children and entries
   out before their distance is computed.  Ties are kept, so equal scores are
   decided by id.

Defined results: a vector that is null, empty, or holds a null or a
non-finite component takes no part, nor does a null id; vectors are compared
to those of their own length; repeated equal rows count once; candidates are
all rows but those with the query's id; fewer than k candidates give all;
integer components stop at +-2**26, so that products of up to 1,024 components
fit a long; extra columns are ignored, since a row of the result is a hit.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from siniestro.session import materialize

PAGE = 128
FANOUT = 16
TREE_ROWS = 8192
MAX_PIVOTS = 4096
QUERY_BLOCK = 32_768
TOGETHER = 1024
"""Queries of a block that go through a tree at the same time."""
NEAR = 8
K = 5
LARGEST = 1 << 26

_PAGES = ("dim int, cell int, sub int, page int, parent int, leaf boolean, routing array<double>, radius double, "
          "parent_distance double, ids array<long>, vectors array<long>, distances array<double>")
_HITS = "query_id long, vec_id long, score long"


def usable(vector: Column) -> Column:
    """True for vectors that take part."""
    bad = F.exists(vector, lambda x: x.isNull() | F.isnan(x.cast("double"))
                   | (F.abs(x.cast("double")) == float("inf")))
    return vector.isNotNull() & (F.size(vector) > 0) & ~F.coalesce(bad, F.lit(True))


def quantised(rows: DataFrame, id_: str, vector: str, factor: int = 256) -> DataFrame:
    """(id, vec, dim, norm): vectors as integers, floor(factor * x)."""
    vec = F.transform(vector, lambda x: F.greatest(F.lit(-LARGEST), F.least(F.lit(LARGEST), F.floor(
        x.cast("double") * float(factor)).cast("long"))).cast("long"))
    return (rows.filter(F.col(id_).isNotNull() & usable(F.col(vector)))
            .select(F.col(id_).cast("long").alias("id"), vec.alias("vec")).distinct()
            .withColumn("dim", F.size("vec")).withColumn("norm", F.aggregate(
                "vec", F.lit(0.0), lambda a, x: a + x.cast("double") * x.cast("double"))))


def _lifted(vectors: np.ndarray, top: float) -> np.ndarray:
    """Vectors with the component that makes all norms equal."""
    x = vectors.astype(np.float64)
    rest = np.sqrt(np.maximum(top - np.einsum("ij,ij->i", x, x), 0.0))
    return np.concatenate((x, rest[:, None]), axis=1)


def _distances(rows: np.ndarray, point: np.ndarray) -> np.ndarray:
    delta = rows - point
    return np.sqrt(np.einsum("ij,ij->i", delta, delta))


def _to_points(rows: np.ndarray, points: np.ndarray) -> np.ndarray:
    """Distances of all rows to all points, by one product."""
    square = np.einsum("ij,ij->i", rows, rows)[:, None] + np.einsum("ij,ij->i", points, points) - 2.0 * (rows @ points.T)
    return np.sqrt(np.maximum(square, 0.0))


def _matrix(cells) -> np.ndarray:
    return np.array([np.asarray(v, np.int64) for v in cells])


def build_pages(ids: np.ndarray, vectors: np.ndarray, top: float, page: int = PAGE,
                fanout: int = FANOUT) -> list[dict]:
    """Pages of one tree, parents first; vectors are integers, ``top`` the largest squared norm."""
    points = _lifted(vectors, top)
    pages: list[dict] = []
    waiting = [(np.arange(len(ids)), -1)]
    while waiting:
        rows, parent = waiting.pop()
        part = points[rows]
        centre = part[int(np.argmin(_distances(part, part.mean(axis=0))))]
        away = _distances(part, centre)
        leaf = len(rows) <= page
        number = len(pages)
        pages.append({
            "page": number, "parent": parent, "leaf": leaf, "routing": centre, "radius": float(away.max()),
            "parent_distance": float(np.linalg.norm(centre - pages[parent]["routing"])) if parent >= 0 else 0.0,
            "ids": ids[rows] if leaf else [], "vectors": vectors[rows].ravel() if leaf else [],
            "distances": away if leaf else []})
        if leaf:
            continue
        seeds = [0]
        least = _distances(part, part[0])
        while len(seeds) < fanout and least.max() > 0:
            seeds.append(int(np.argmax(least)))
            least = np.minimum(least, _distances(part, part[seeds[-1]]))
        near = np.argmin(np.stack([_distances(part, part[s]) for s in seeds]), axis=0)
        if np.bincount(near).max() > len(rows) * 0.9:  # copies of one vector: cut by order
            near = np.arange(len(rows)) * fanout // len(rows)
        waiting += [(rows[near == i], number) for i in range(near.max() + 1) if (near == i).any()]
    return pages


class Tree:
    """Pages of one tree, ready to search."""

    def __init__(self, pages: pd.DataFrame, top: float) -> None:
        pages = pages.sort_values("page")
        self.top = top
        self.leaf = pages["leaf"].to_numpy(bool)
        self.routing = np.array([np.asarray(r) for r in pages["routing"]])
        self.radius = pages["radius"].to_numpy(float)
        self.to_parent = pages["parent_distance"].to_numpy(float)
        parent = pages["parent"].to_numpy(int)
        self.children = [np.flatnonzero(parent == i) if not leaf else None for i, leaf in enumerate(self.leaf)]
        self.ids = [np.asarray(x, np.int64) for x in pages["ids"]]
        dim = self.routing.shape[1] - 1
        self.vectors = [np.asarray(x, np.int64).reshape(-1, dim) for x in pages["vectors"]]
        self.distances = [np.asarray(x, float) for x in pages["distances"]]
        # products of components up to this are exact in floating point
        self.limit = int((2.0 ** 52 / max(dim, 1)) ** 0.5)
        self.small = max((int(np.abs(v).max(initial=0)) for v in self.vectors), default=0) <= self.limit

    def search(self, own: np.ndarray, queries: np.ndarray, k: int, floors: np.ndarray) -> list[tuple[int, int, int]]:
        """(row, score, id) of the k best entries of every query but those with its id in ``own``.

        ``floors``: a score that k rows elsewhere reach, -inf if unknown.
        """
        m, nodes = len(queries), len(self.leaf)
        exact = np.float64 if self.small and np.abs(queries).max(initial=0) <= self.limit else np.int64
        lowest = -np.inf if exact is np.float64 else -np.iinfo(np.int64).max
        asked = queries.astype(exact)
        lifted = np.concatenate((queries.astype(np.float64), np.zeros((m, 1))), axis=1)
        square = self.top + np.einsum("ij,ij->i", lifted, lifted)
        # distances by products are off by some 1e-8 of their scale when they are small
        slack = 1e-6 * (1.0 + np.sqrt(square))
        best = np.full((m, k), lowest, exact)
        names = np.full((m, k), np.iinfo(np.int64).max)
        ahead = np.full((m, nodes), np.inf)  # least distance of a node that a query knows and has not taken
        far = np.zeros((m, nodes))

        def reach(rows: np.ndarray) -> np.ndarray:
            kth = best[rows, k - 1]
            score = np.maximum(np.where(kth == lowest, -np.inf, kth.astype(float)), floors[rows])
            return np.where(np.isinf(score), np.inf, np.sqrt(np.maximum(square[rows] - 2.0 * score, 0.0))) + slack[rows]

        far[:, 0] = _to_points(lifted, self.routing[:1])[:, 0]
        ahead[:, 0] = np.maximum(far[:, 0] - self.radius[0] - slack, 0.0)
        limit = reach(np.arange(m))
        while True:
            first = ahead.argmin(axis=1)
            least = ahead[np.arange(m), first]
            alive = np.isfinite(least) & (least <= limit)
            if not alive.any():
                break
            # the page that comes first for most queries, for all that may need it
            node = int(np.bincount(first[alive]).argmax())
            rows = np.flatnonzero(np.isfinite(ahead[:, node]) & (ahead[:, node] <= limit))
            ahead[:, node] = np.inf
            if not self.leaf[node]:
                kids = self.children[node]
                open_ = np.abs(far[rows, node][:, None] - self.to_parent[kids]) - self.radius[kids] - slack[rows][:, None] \
                    <= limit[rows][:, None]
                some = np.flatnonzero(open_.any(axis=1))
                if not len(some):
                    continue
                away = _to_points(lifted[rows[some]], self.routing[kids])
                near = np.maximum(away - self.radius[kids] - slack[rows[some]][:, None], 0.0)
                far[np.ix_(rows[some], kids)] = away
                ahead[np.ix_(rows[some], kids)] = np.where(open_[some] & (near <= limit[rows[some]][:, None]), near, np.inf)
                continue
            open_ = np.abs(far[rows, node][:, None] - self.distances[node]) - slack[rows][:, None] <= limit[rows][:, None]
            cols = np.flatnonzero(open_.any(axis=0))
            if not len(cols):
                continue
            ids = self.ids[node][cols]
            scores = asked[rows] @ self.vectors[node][cols].astype(exact).T
            scores[ids[None, :] == own[rows][:, None]] = lowest
            # entries that can be among the k best, few once a bound is known; ties stay
            worst = np.maximum(best[rows, k - 1], np.where(np.isinf(floors[rows]), lowest, floors[rows]).astype(exact))
            row, col = np.nonzero((scores >= worst[:, None]) & (scores != lowest))
            if not len(row):
                continue
            changed = np.unique(row)
            place = np.concatenate((np.repeat(changed, k), row))
            both = np.concatenate((best[rows[changed]].ravel(), scores[row, col]))
            who = np.concatenate((names[rows[changed]].ravel(), ids[col]))
            order = np.lexsort((who, -both, place))
            starts = np.searchsorted(place[order], changed)
            top = order[(starts[:, None] + np.arange(k)).ravel()]
            rows = rows[changed]
            best[rows], names[rows] = both[top].reshape(-1, k), who[top].reshape(-1, k)
            limit[rows] = reach(rows)
        row, at = np.nonzero(best != lowest)
        return list(zip(row.tolist(), map(int, best[row, at]), names[row, at].tolist(), strict=True))


class _Cells:
    """Per dimension: pivots of the first cut, those of the second by cell of the first, and what is known of each cell.

    Cells are numbered in all; ``inner`` and ``outer`` are the least and
    largest distance of a member to the cell's pivot, ``subs`` its trees.
    """

    def __init__(self, tops: dict[int, float], pivots: dict[int, np.ndarray]) -> None:
        self.tops = tops
        self.first = {d: _lifted(p, tops[d]) for d, p in pivots.items()}
        self.second: dict[int, dict[int, np.ndarray]] = {d: {} for d in pivots}
        self.settle()

    def settle(self) -> None:
        """Number the cells: a cell of the first cut, or those that its own pivots cut it into."""
        self.start, self.pivots = {}, {}
        for d, first in self.first.items():
            parts = [self.second[d].get(c, first[c:c + 1]) for c in range(len(first))]
            self.start[d] = np.concatenate(([0], np.cumsum([len(p) for p in parts])))
            self.pivots[d] = np.concatenate(parts)
        self.inner = {d: np.full(len(p), np.inf) for d, p in self.pivots.items()}
        self.outer = {d: np.zeros(len(p)) for d, p in self.pivots.items()}
        self.subs = {d: np.zeros(len(p), int) for d, p in self.pivots.items()}

    def nearest(self, dim: int, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(cell, distance to its pivot) of lifted rows."""
        cell, away = np.zeros(len(x), np.int64), np.zeros(len(x))
        for at in range(0, len(x), TOGETHER):
            some = slice(at, at + TOGETHER)
            far = _to_points(x[some], self.first[dim])
            one = far.argmin(axis=1)
            cell[some], away[some] = self.start[dim][one], far[np.arange(len(one)), one]
            for c in np.intersect1d(one, list(self.second[dim])):
                rows = at + np.flatnonzero(one == c)
                far = _to_points(x[rows], self.second[dim][c])
                two = far.argmin(axis=1)
                cell[rows], away[rows] = self.start[dim][c] + two, far[np.arange(len(two)), two]
        return cell, away


def _placed(vectors: DataFrame, cells) -> DataFrame:
    """Vectors with their cell and distance to its pivot."""

    def work(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            batch = batch.assign(cell=0, away=0.0)
            for dim, part in batch.groupby("dim"):
                x = _lifted(_matrix(part["vec"]), cells.value.tops[dim])
                batch.loc[part.index, "cell"], batch.loc[part.index, "away"] = cells.value.nearest(dim, x)
            yield batch[["id", "vec", "dim", "cell", "away"]]

    return vectors.select("id", "vec", "dim").mapInPandas(work, "id long, vec array<long>, dim int, cell int, away double")


def _drawn(vectors: DataFrame, wanted: dict[tuple, int], rows: dict[tuple, int]) -> dict[tuple, np.ndarray]:
    """About ``wanted`` distinct rows of each group (dim, or dim and cell), spread by a hash of the id."""
    keys = ["dim", "cell"][:len(next(iter(wanted)))]
    share = [(*key, 2.0 * want / max(rows[key], 1)) for key, want in wanted.items()]
    table = vectors.sparkSession.createDataFrame(share, ", ".join(f"{k} int" for k in keys) + ", share double")
    draw = F.pmod(F.xxhash64("id", F.lit(1)), F.lit(1 << 30)) / float(1 << 30)
    some = vectors.join(F.broadcast(table), keys).filter(draw < F.col("share")).select(*keys, "vec", draw.alias("draw"))
    found: dict[tuple, list] = {}
    for r in sorted(some.collect(), key=lambda r: r["draw"]):  # some 2 * MAX_PIVOTS rows
        found.setdefault(tuple(r[k] for k in keys), []).append(tuple(r["vec"]))
    return {key: _matrix(list(dict.fromkeys(v))[:wanted[key]]) for key, v in found.items()}


def build_index(vectors: DataFrame, tree_rows: int = TREE_ROWS, max_pivots: int = MAX_PIVOTS):
    """(pages, cells): the page table of all trees and what the driver knows of the cells."""
    context = vectors.sparkSession.sparkContext
    sizes = {r[0]: (r[1], r[2]) for r in vectors.groupBy("dim").agg(F.max("norm"), F.count(F.lit(1))).collect()}
    pivots = {}
    for dim, (_, n) in sizes.items():
        some = min(max_pivots, -(-2 * n // tree_rows))
        first = vectors.filter(F.col("dim") == dim).orderBy(F.xxhash64("id"), "id", "vec").limit(some).collect()
        pivots[dim] = np.unique(_matrix(r["vec"] for r in first), axis=0)
    cells = _Cells({d: top for d, (top, _) in sizes.items()}, pivots)
    counts = ("dim", "cell")
    placed = materialize(_placed(vectors, context.broadcast(cells)), "metric-cells")
    found = {(r[0], r[1]): r[2] for r in placed.groupBy(*counts).agg(F.count(F.lit(1))).collect()}
    large = {key: n for key, n in found.items() if n > tree_rows}
    if large:
        scale = min(1.0, max_pivots * tree_rows / (2.0 * sum(large.values())))
        wanted = {key: max(2, int(2 * n / tree_rows * scale)) for key, n in large.items()}
        for (dim, cell), rows in _drawn(placed, wanted, large).items():
            if len(rows) > 1:
                cells.second[dim][cell] = _lifted(rows, cells.tops[dim])
        cells.settle()
        placed = materialize(_placed(vectors, context.broadcast(cells)), "metric-cells")
    for r in placed.groupBy(*counts).agg(F.min("away").alias("i"), F.max("away").alias("o"), F.count(F.lit(1)).alias("n")).collect():
        d, c = r["dim"], r["cell"]
        cells.inner[d][c], cells.outer[d][c], cells.subs[d][c] = r["i"], r["o"], -(-r["n"] // tree_rows)
    shared = context.broadcast(cells)

    def sub(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            n = [shared.value.subs[d][c] for d, c in zip(batch["dim"], batch["cell"], strict=True)]
            yield batch.assign(sub=batch["draw"] % np.array(n, int) if len(n) else 0).drop(columns="draw")

    def build(key, part: pd.DataFrame) -> pd.DataFrame:
        part = part.sort_values("id")
        pages = build_pages(part["id"].to_numpy(), _matrix(part["vec"]), shared.value.tops[key[0]])
        return pd.DataFrame(pages).assign(dim=key[0], cell=key[1], sub=key[2])[
            ["dim", "cell", "sub", "page", "parent", "leaf", "routing", "radius", "parent_distance", "ids", "vectors",
             "distances"]]

    dealt = placed.select("id", "vec", "dim", "cell", F.expr("xxhash64(id) & 2147483647").alias("draw")) \
        .mapInPandas(sub, "id long, vec array<long>, dim int, cell int, sub int")
    return materialize(dealt.groupBy("dim", "cell", "sub").applyInPandas(build, _PAGES), "metric-pages"), cells


def _answers(pages: DataFrame, asked: DataFrame, cells, blocks: int, k: int) -> DataFrame:
    """Hits of each (query, tree) row of ``asked``."""
    keys = ["dim", "cell", "sub", "block"]

    def work(key, tree: pd.DataFrame, queries: pd.DataFrame) -> pd.DataFrame:
        out: list[tuple[int, int, int]] = []
        if len(tree) and len(queries):
            ready = Tree(tree, cells.value.tops[key[0]])
            own, floors = queries["id"].to_numpy(), queries["floor"].to_numpy(float)
            for at in range(0, len(own), TOGETHER):
                some = slice(at, at + TOGETHER)
                found = ready.search(own[some], _matrix(queries["vec"].iloc[some]), k, floors[some])
                out += [(own[at + row], i, score) for row, score, i in found]
        return pd.DataFrame(out, columns=["query_id", "vec_id", "score"])

    copies = pages if blocks == 1 else pages.withColumn("block", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))))
    copies = copies if blocks > 1 else copies.withColumn("block", F.lit(0))
    return copies.groupBy(*keys).cogroup(asked.groupBy(*keys)).applyInPandas(work, _HITS)


def _best(hits: DataFrame, k: int) -> DataFrame:
    """The k best hits of every query; a query that repeats an id with other components has its hits together."""
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return (hits.groupBy("query_id", "vec_id").agg(F.max("score").alias("score"))
            .withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k))


def search(vectors: DataFrame, queries: DataFrame, k: int = K) -> DataFrame:
    """(query_id, rank, vec_id, score): the k largest products of every query; both sides as :func:`quantised`."""
    spark = vectors.sparkSession
    vectors, queries = materialize(vectors, "metric-vectors"), materialize(queries, "metric-queries")
    pages, cells = build_index(vectors)
    shared = spark.sparkContext.broadcast(cells)
    blocks = max(1, -(-queries.count() // QUERY_BLOCK))
    block = F.expr(f"cast(pmod(xxhash64(id), {blocks}) as int)").alias("block")
    spot = "id long, vec array<long>, dim int, home int, cell int, sub int, floor double"

    def bounds(dim: int, x: np.ndarray) -> np.ndarray:
        """The least distance that every cell can hold, by lifted queries."""
        away = _to_points(x, shared.value.pivots[dim])
        near = np.maximum(away - shared.value.outer[dim], shared.value.inner[dim] - away)
        return np.where(shared.value.subs[dim] > 0, near, np.inf)

    def lifted(part: pd.DataFrame) -> np.ndarray:
        return np.concatenate((_matrix(part["vec"]).astype(float), np.zeros((len(part), 1))), axis=1)

    def rows_of(part: pd.DataFrame, hits: np.ndarray, dim: int, home: np.ndarray, floor: np.ndarray, first: bool) -> pd.DataFrame:
        row, cell = np.nonzero(hits)
        trees = np.ones(len(cell), int) if first else shared.value.subs[dim][cell]
        row, cell = np.repeat(row, trees), np.repeat(cell, trees)
        sub = np.arange(len(cell)) - np.repeat(np.cumsum(trees) - trees, trees)
        out = part.iloc[row][["id", "vec", "dim"]].assign(home=home[row], cell=cell, sub=sub, floor=floor[row])
        return out if first else out[(out["cell"] != out["home"]) | (out["sub"] != 0)]

    def at_home(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for dim, whole in batch.groupby("dim"):
                for at in range(0, len(whole), TOGETHER):
                    part = whole.iloc[at:at + TOGETHER]
                    if dim in shared.value.tops:
                        near = bounds(dim, lifted(part))
                        home = np.where(near <= 0, _to_points(lifted(part), shared.value.pivots[dim]), np.inf).argmin(axis=1)
                        home = np.where(np.isfinite(near[np.arange(len(home)), home]), home, near.argmin(axis=1))
                        hits = np.zeros(near.shape, bool)
                        hits[np.arange(len(home)), home] = True
                        yield rows_of(part, hits, dim, home, np.full(len(part), -np.inf), True)

    def abroad(nearest: bool):
        def work(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            for batch in batches:
                for dim, whole in batch.groupby("dim"):
                    for at in range(0, len(whole), TOGETHER):
                        part = whole.iloc[at:at + TOGETHER]
                        x = lifted(part)
                        floor = part["floor"].to_numpy(float)
                        square = shared.value.tops[dim] + np.einsum("ij,ij->i", x, x)
                        slack = 1e-6 * (1.0 + np.sqrt(square))
                        limit = np.where(np.isinf(floor), np.inf, np.sqrt(np.maximum(square - 2.0 * floor, 0.0))) + slack
                        near = bounds(dim, x)
                        home = part["home"].to_numpy(int)
                        # the home cell stays for its other trees; the next cells by bound, ties by number
                        order = np.lexsort((np.broadcast_to(np.arange(near.shape[1]), near.shape), near), axis=1)
                        place = np.empty_like(order)
                        np.put_along_axis(place, order, np.broadcast_to(np.arange(near.shape[1]), near.shape), 1)
                        close = (place <= NEAR) | (np.arange(near.shape[1]) == home[:, None])
                        hits = np.isfinite(near) & (near - slack[:, None] <= limit[:, None]) & (close if nearest else ~close)
                        yield rows_of(part, hits, dim, home, floor, False)
        return work

    home = materialize(queries.select("id", "vec", "dim").mapInPandas(at_home, spot), "metric-home")
    hits = materialize(_answers(pages, home.select("*", block), shared, blocks, k), "metric-hits")
    for nearest in (True, False):
        # a floor holds where k hits are known; ids that repeat with other components get none
        kth = _best(hits, k).groupBy(F.col("query_id").alias("id")).agg(
            F.when(F.count(F.lit(1)) == k, F.min("score").cast("double")).alias("kth"))
        alone = home.groupBy("id").agg(F.count(F.lit(1)).alias("n"))
        known = alone.join(kth, "id", "left").select("id", F.coalesce(
            F.when(F.col("n") == 1, F.col("kth")), F.lit(float("-inf"))).alias("floor"))
        asked = home.drop("floor", "cell", "sub").join(known, "id").select("id", "vec", "dim", "home", "floor")
        found = _answers(pages, asked.mapInPandas(abroad(nearest), spot).select("*", block), shared, blocks, k)
        hits = hits.unionByName(materialize(found, "metric-hits"))
    return _best(hits, k).select("query_id", "rank", "vec_id", "score")


def op1_metric_tree_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = quantised(spark.read.parquet(f"{sf_dir}/embeddings.parquet"), "vec_id", "embedding")
    return search(vectors, vectors.filter("id % 50 = 0"), K)


SQL = """
with v as (
  select distinct vec_id, list_transform(embedding, lambda x: cast(floor(256 * cast(x as double)) as bigint)) as q
  from embeddings
  where vec_id is not null and embedding is not null and len(embedding) > 0
    and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0),
pairs as (
  select a.vec_id as query_id, b.vec_id as vec_id,
         cast(list_sum(list_transform(list_zip(a.q, b.q), lambda p: p[1] * p[2])) as bigint) as score
  from v a join v b on a.vec_id <> b.vec_id and len(a.q) = len(b.q) where a.vec_id % 50 = 0),
ranked as (select *, cast(row_number() over (partition by query_id order by score desc, vec_id) as integer) as rank
           from pairs)
select query_id, rank, vec_id, score from ranked where rank <= 5
"""

QUERIES = {"op1_metric_tree_topk": op1_metric_tree_topk}
ORACLE = {"op1_metric_tree_topk": SQL}
