"""Exact top-k search by inner product: a Voronoi kNN join.

Vectors become integers (floor of ``scale`` times each component).  Some of them,
first in hash order, are the pivots (a few for each ``BLOCK`` rows, ``PIVOTS`` to
``MOST_PIVOTS``); every vector belongs to the cell of its nearest one.  Per cell a summary keeps the number of its data rows, the
largest distance to its pivot and, for queries, also their largest norm.

For a query q of a cell with pivot p and a data row x of a cell with pivot s,
q.x = p.s + (q-p).s + q.(x-s), so |q.x - p.s| <= r_q |s| + n_q r_x with the
query cell's radius r_q and norm n_q and the data cell's radius r_x.  Going
through data cells by their lower bounds until they hold k rows besides those of
a query's own id (at most as many as the query cell's most repeated id has in the
table) gives each query cell a score that its queries' k-th best must reach; only
data cells whose upper bound reaches it are needed.  Neighbouring
query cells are grouped, and a data row is replicated once to each group that
needs its cell.  Cells and groups have at most about ``BLOCK`` rows; larger ones
are cut by hash, so that a cell with most rows is many tasks.  Every (group, data
block) pair is solved on its own, after the same bound for each single query, and
the best ``k`` of a query are merged at the end.

Sums up to 2 ** 53 are exact in float64 products.  Beyond that the products
bound the scores, and those that may be among the best are computed in integers.

Defined cases: vectors that are null, hold null or non-finite components, or
have no id take no part; vectors of another length than the first pivot's are
matched only with their like (lengths are dealt apart); with fewer than k
candidates all are returned; ties go to the smaller vec_id; rows that share a
vec_id are separate candidates, none of them one of its own queries'; an empty
table gives an empty result; components and scores beyond 64 bits are held at the
bounds of a long (ranked before that within a block); other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import bounded_batches, checkpointed, table

K = 20
SCALE = 64
QUERY_EVERY = 20
PIVOTS, MOST_PIVOTS = 64, 1024
BLOCK = 8192
#: Relative error that float64 sums over a vector's components stay far below.
ROUNDING = 1e-9


def integer_vectors(vectors: DataFrame, scale: int = SCALE) -> DataFrame:
    """(vec_id, v array<long>) of the rows that take part."""
    wide = F.transform("embedding", lambda x: x.cast("double"))
    usable = F.col("vec_id").isNotNull() & F.col("embedding").isNotNull() & F.forall("e", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf")))
    rows = vectors.select("vec_id", "embedding").withColumn("e", wide).filter(usable)
    return rows.select("vec_id", F.transform("e", lambda x: F.floor(x * scale).cast("long")).alias("v"))


def _cells(pivots: np.ndarray):
    """Nearest pivot, distance to it and norm of each vector of the pivots' length."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        norms = (pivots**2).sum(axis=1)
        for batch in batches:
            if not batch.num_rows:
                continue
            v = batch.column(1).flatten().to_numpy().astype(np.float64).reshape(batch.num_rows, -1)
            square = (v**2).sum(axis=1)
            cell = (square[:, None] - 2 * v @ pivots.T + norms).argmin(axis=1)
            far = np.sqrt(((v - pivots[cell]) ** 2).sum(axis=1))  # the bounds need no more than this to be right
            whole = batch.column(1).flatten().to_numpy().reshape(batch.num_rows, -1)
            kind = "<i4" if np.abs(v).max(initial=0) < 2**31 else "<i8"
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(cell, pa.int32()), pa.array(far), pa.array(np.sqrt(square)), pa.array([x.tobytes() for x in whole.astype(kind)], pa.binary())],
                names=["vec_id", "cell", "far", "norm", "v"],
            )

    return run


def cell_targets(pivots: np.ndarray, data: pd.DataFrame, queries: pd.DataFrame, k: int) -> pd.DataFrame:
    """(cell, target, least): the data cells that each query cell needs, and the score its k-th best reaches.

    ``own`` of a query cell is the most rows that one of its query ids has in all data cells.
    """
    rows = []
    centre = pivots[data["cell"]]
    for q in queries.itertuples():
        middle = centre @ pivots[q.cell]
        length, reach = np.sqrt((centre**2).sum(axis=1)), data["far"].to_numpy()
        slack = q.far * length + q.norm * reach + 1e-6 + ROUNDING * (q.norm + q.far) * (length + reach)
        low, high = middle - slack, middle + slack
        order = np.argsort(-low)
        held = np.cumsum(data["n"].to_numpy()[order])
        enough = np.flatnonzero(held >= k + q.own)
        least = low[order[enough[0]]] if len(enough) else -np.inf
        rows += [(int(q.cell), int(c), float(least)) for c in data["cell"].to_numpy()[high >= least]]
    return pd.DataFrame(rows, columns=["cell", "target", "least"]).astype({"cell": "int32", "target": "int32", "least": "float64"})


def _matrix(column: pa.ChunkedArray, width: int) -> np.ndarray:
    """Integer vectors from their bytes, four or eight a component by batch."""
    raw = column.to_pylist()
    if all(len(x) == 4 * width for x in raw):
        return np.frombuffer(b"".join(raw), "<i4").reshape(-1, width)
    return np.stack([np.frombuffer(x, "<i4" if len(x) == 4 * width else "<i8").astype(np.int64) for x in raw])


def exact_product(a: np.ndarray, b: np.ndarray) -> int:
    return sum(x * y for x, y in zip(a.tolist(), b.tolist(), strict=True))


def query_groups(pivots: np.ndarray, queries: pd.DataFrame, block: int) -> pd.DataFrame:
    """(cell, first, n_parts): small query cells share a group with near ones, large ones are cut into several.

    A cell's rows go to groups first .. first + n_parts - 1; a group has about ``block`` rows at most.
    """
    left = {int(c): int(n) for c, n in zip(queries["cell"], queries["n"], strict=True)}
    rows, number, held = [], 0, 0
    cell = min(left, default=None)
    while cell is not None:
        n = left.pop(cell)
        if held and held + n > block:
            number, held = number + 1, 0
        parts = max(1, -(-n // block))
        rows.append((cell, number, parts))
        if parts > 1:
            number, held = number + parts, 0
        else:
            held += n
        cell = min(left, key=lambda c: float(((pivots[c] - pivots[cell]) ** 2).sum()), default=None)  # noqa: B023
    return pd.DataFrame(rows, columns=["cell", "first", "n_parts"])


def _solve(k: int, pivots: np.ndarray):
    """Best ``k`` of each query of a block among a data block."""

    def run(queries: pa.Table, data: pa.Table) -> pa.Table:
        out: list[tuple] = []
        if queries.num_rows and data.num_rows:
            x = _matrix(data.column("v"), pivots.shape[1])
            ids = data.column("vec_id").to_numpy()
            by_id = np.argsort(ids, kind="stable")
            ids, whole = ids[by_id], x[by_id]
            x = whole.astype(np.float64)
            lengths = np.sqrt((x**2).sum(axis=1))
            reach = data.column("far").to_numpy().max()
            centre = pivots[data.column("target")[0].as_py()]
            asked = _matrix(queries.column("v"), pivots.shape[1])
            q = asked.astype(np.float64)
            own, norms = queries.column("vec_id").to_numpy(), queries.column("norm").to_numpy()
            bound = q @ centre + norms * reach + 1e-6 + ROUNDING * norms * (np.sqrt((centre**2).sum()) + reach)
            able = np.flatnonzero(bound >= queries.column("least").to_numpy())
            for a in range(0, len(able), 256):
                part = able[a : a + 256]
                scores = q[part] @ x.T
                scores[own[part][:, None] == ids[None, :]] = -np.inf
                n = min(k, scores.shape[1])
                exact = norms[part].max() * lengths.max() < 2.0**52
                # how far a score may be off
                off = None if exact else ROUNDING * norms[part][:, None] * lengths[None, :]
                kth = np.partition(scores if exact else scores - off, scores.shape[1] - n, axis=1)[:, scores.shape[1] - n]
                for at, (row, least, i) in enumerate(zip(scores, kth, part, strict=True)):
                    near = np.flatnonzero(((row if exact else row + off[at]) >= least) & (row > -np.inf))
                    if exact:
                        near = near[np.lexsort((ids[near], -row[near]))][:k]
                        found = [(-int(row[j]), int(ids[j])) for j in near]
                    else:
                        found = sorted((-exact_product(asked[i], whole[j]), int(ids[j])) for j in near)[:k]
                    nth = int(queries.column("nth")[int(i)].as_py())
                    out += [(int(own[i]), nth, j, max(-(2**63), min(2**63 - 1, -score))) for score, j in found]
        columns = list(zip(*out, strict=True)) if out else [[], [], [], []]
        return pa.table({n: pa.array(c, pa.int64()) for n, c in zip(("query_id", "nth", "vec_id", "score"), columns, strict=True)})

    return run


def top_k(vectors: DataFrame, is_query: str, k: int = K, scale: int = SCALE, pivots: int | None = None, block: int = BLOCK) -> DataFrame:
    """query_id, rank, vec_id, score of each query row (SQL condition ``is_query``) against all other ids' rows."""
    spark = vectors.sparkSession
    whole = integer_vectors(bounded_batches(vectors), scale)
    schema = "query_id long, rank int, vec_id long, score long"
    lengths = whole.groupBy(F.size("v").alias("n")).count().filter("n > 0").orderBy("n").collect()
    results = []
    for length, count in lengths:
        rows = whole.filter(F.size("v") == length)
        many = pivots or min(MOST_PIVOTS, max(PIVOTS, 8 * count // block))
        chosen = rows.orderBy(F.xxhash64("vec_id"), "vec_id").limit(many).collect()
        centres = np.unique(np.array([r["v"] for r in chosen], np.float64), axis=0)
        placed = checkpointed(rows.mapInArrow(_cells(centres), "vec_id long, cell int, far double, norm double, v binary"))
        stats = placed.groupBy("cell").agg(F.count("*").alias("n"), F.max("far").alias("far")).toPandas()
        # a row of queries is known by its number, so that repeated ids are separate queries
        queries = placed.filter(is_query).withColumn("nth", F.row_number().over(Window.partitionBy("vec_id").orderBy("v")).cast("long"))
        query_stats = queries.groupBy("cell").agg(F.count("*").alias("n"), F.max("far").alias("far"), F.max("norm").alias("norm")).toPandas()
        # rows of a query's own id are no candidates of it, however many they are
        repeated = placed.groupBy("vec_id").agg(F.count("*").alias("own")).filter("own > 1")
        copies = queries.select("cell", "vec_id").join(repeated, "vec_id").groupBy("cell").agg(F.max("own").alias("own")).toPandas()
        query_stats["own"] = query_stats["cell"].map(dict(zip(copies["cell"], copies["own"], strict=True))).fillna(1).astype("int64")
        needed = cell_targets(centres, stats, query_stats, k)
        groups = query_groups(centres, query_stats, block)
        parts = {int(c): max(1, -(-int(n) // block)) for c, n in zip(stats["cell"], stats["n"], strict=True)}
        wanted = needed.merge(groups, on="cell")
        if not len(wanted):
            continue
        # queries go to every block of the data cells they need, data rows to every group that needs their cell
        asks = spark.createDataFrame(wanted[["cell", "target", "least"]].drop_duplicates(), "cell int, target int, least double")
        gives = wanted[["target", "first", "n_parts"]].drop_duplicates()
        gives = gives.loc[gives.index.repeat(gives["n_parts"])]
        gives["grp"] = gives["first"] + gives.groupby(["target", "first"]).cumcount()
        gives = spark.createDataFrame(gives[["target", "grp"]].drop_duplicates().astype("int32"), "target int, grp int")
        deal = spark.createDataFrame(groups.astype("int32"), "cell int, first int, n_parts int")
        blocks = spark.createDataFrame([(c, n) for c, n in parts.items()], "target int, blocks int")

        left = queries.join(F.broadcast(deal), "cell").withColumn("grp", (F.col("first") + F.pmod(F.xxhash64("vec_id", "nth"), F.col("n_parts"))).cast("int"))
        left = left.join(F.broadcast(asks.join(blocks, "target")), "cell").withColumn("block", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
        left = left.select("grp", "target", "block", "vec_id", "nth", "norm", "least", "v")
        right = placed.withColumnRenamed("cell", "target").join(F.broadcast(blocks), "target")
        right = right.withColumn("block", F.pmod(F.xxhash64("vec_id", "v"), F.col("blocks")).cast("int")).join(F.broadcast(gives), "target")
        right = right.select("grp", "target", "block", *(F.col(c).alias(c) for c in ("vec_id", "far", "v")))
        key = ["grp", "target", "block"]
        solved = left.groupBy(*key).cogroup(right.groupBy(*key))
        results.append(solved.applyInArrow(_solve(k, centres), "query_id long, nth long, vec_id long, score long"))
    if not results:
        return spark.createDataFrame([], schema)
    best = results[0]
    for more in results[1:]:
        best = best.unionByName(more)
    order = Window.partitionBy("query_id", "nth").orderBy(F.col("score").desc(), "vec_id")
    ranked = best.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)
    return ranked.select("query_id", "rank", "vec_id", "score")


def op6_voronoi_knn(spark: SparkSession, sf_dir: str) -> DataFrame:
    return top_k(table(spark, sf_dir, "embeddings"), f"vec_id % {QUERY_EVERY} = 0")


ORACLE_SQL = f"""
WITH v AS MATERIALIZED (
  SELECT vec_id, list_transform(embedding, lambda x: floor({SCALE} * x::DOUBLE)::DOUBLE) AS e
  FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR isnan(x) OR isinf(x))) = 0
), scored AS (
  SELECT q.vec_id AS query_id, c.vec_id, list_inner_product(q.e, c.e)::BIGINT AS score
  FROM v q JOIN v c ON q.vec_id <> c.vec_id AND len(q.e) = len(c.e)
  WHERE q.vec_id % {QUERY_EVERY} = 0
), ranked AS (
  SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM scored
)
SELECT query_id, rank::INTEGER AS rank, vec_id, score FROM ranked WHERE rank <= {K}
"""
