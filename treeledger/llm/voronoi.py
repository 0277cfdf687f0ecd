"""Exact top-k search by inner product: a Voronoi k-nearest-neighbour join.

Pivots (vectors chosen by a hash of their id, about the square root of the number of rows, as long as
they fit PIVOT_BYTES) part the space in cells; every vector belongs to its nearest pivot and keeps its
distance to it. Two things are known of each cell: how far its vectors reach, and the ``k + 1`` smallest
distances in it. For a query ``q`` and a vector ``x`` at distance ``d`` from pivot ``p``, the score lies
between ``q.p - |q| d`` and ``q.p + |q| d``. So the cells' summaries give each query a score that it
reaches with ``k + 1`` vectors at least (one may be the query itself). Exact scores with a sample of
vectors, which has the pivots in it and fits SEED_BYTES, give it another; the higher one holds. With it
there is, for each cell, the distance below which a vector cannot be among the query's best.

A query's group is that of its own cell; cells near each other make a group, around centres that lie far
apart. A vector is sent to the groups in which some query needs it, by the smallest of these distances.
Groups are cut into blocks and the vectors sent to a group into slices, by the counts of that group, so a
task holds a bounded number of both whatever one cell holds; it scores them with exact integers and
keeps the best of each query, of which the best overall are ranked. Sample and bounds only say what need
not be sent: every vector that may be among the best of a query is scored.

Defined results: vectors that are null, or hold a null or a number that is not finite, take no part,
nor do rows without an id. A row that repeats with id and vector counts once; rows with the id of a
query are its own. A shorter vector counts as filled up with zeros. No rows give no rows. Other columns
are not looked at, whatever their names. Components times 1024 and scores must fit 64 bits.
"""

import math

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from treeledger.sources.store import stored

SCALE = 1024
PIVOT_BYTES = 32 << 20
SEED_BYTES = 2 << 20
# The table of what groups need of cells has one number for each pair, and is held in the driver.
NEED_CELLS = 4 << 20
GROUP_QUERIES = 128
BLOCK = 4096
SLICE = 4096


def integer_vectors(rows: DataFrame, key: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """``(id, vec)``: components as ``floor(1024 x)``, for the rows that take part."""
    x = F.col("_vector")
    rows = rows.select(F.col(key).cast("bigint").alias("id"), F.col(vector).cast("array<double>").alias("_vector"))
    bad = F.exists(x, lambda v: v.isNull() | F.isnan(v) | (F.abs(v) == float("inf")))
    return (
        rows.where(F.col("id").isNotNull() & x.isNotNull() & ~bad)
        .select("id", F.transform(x, lambda v: F.floor(v * SCALE)).alias("vec")).distinct()
    )


def _matrix_code():
    """Helpers for tasks: vectors as bytes of 64-bit integers, to a matrix and back. Made inside a
    function, so that executors need no copy of this package."""

    def made():
        import numpy as np

        def matrix(cells, dim):
            out = np.zeros((len(cells), dim), np.int64)
            for i, cell in enumerate(cells):
                v = np.frombuffer(cell, np.int64)
                out[i, : len(v)] = v
            return out

        def product(a, b):
            """Exact: in doubles where all sums stay below 2 to the 53rd, else in integers."""
            most = float(np.abs(a).max(initial=0)) * float(np.abs(b).max(initial=0)) * a.shape[1]
            if most < 2**53:
                return (a.astype(np.float64) @ b.T.astype(np.float64)).astype(np.int64)
            return a @ b.T

        return matrix, product

    return made


def _groups_of_cells(places, groups: int):
    """For each cell the number of its group: that of the nearest centre, where each further centre is the
    pivot farthest from those before."""
    group, nearest, centre = np.zeros(len(places), np.int32), np.full(len(places), np.inf), 0
    for number in range(groups):
        far = ((places - places[centre]) ** 2).sum(axis=1)
        group[far < nearest] = number
        nearest = np.minimum(nearest, far)
        centre = int(nearest.argmax())
    return group


def _sent(rows: DataFrame, is_query, k, key, vector, pivots, block, slice_rows, group_queries):
    """``(asked, data, dim)``: queries ``(group, block, slice, id, vec)``, vectors with the same columns,
    and the length of the longest vector; None without rows."""
    code = _matrix_code()
    vectors = stored(integer_vectors(rows, key, vector), "vectors")
    counts = vectors.agg(
        F.count(F.lit(1)).alias("rows"), F.count_if(is_query).alias("queries"), F.max(F.size("vec")).alias("dim")
    ).first()
    n_rows, n_queries, dim = counts
    if not n_queries:
        return None
    fit = max(1, 8 * max(dim, 1))
    if pivots is None:
        pivots = max(1, min(math.isqrt(n_rows), PIVOT_BYTES // fit))
    n_seeds = max(pivots, SEED_BYTES // fit)
    chosen = vectors.orderBy(F.xxhash64("id"), "id", "vec").limit(n_seeds).collect()
    seeds = np.zeros((len(chosen), dim))
    for i, r in enumerate(chosen):
        seeds[i, : len(r["vec"])] = r["vec"]
    seed_ids, places = np.array([r["id"] for r in chosen], np.int64), seeds[:pivots]
    squares = (places**2).sum(axis=1)
    groups = max(1, min(math.ceil(n_queries / group_queries), len(places), NEED_CELLS // len(places)))
    group_of = _groups_of_cells(places, groups)

    def assign(batches):
        import numpy as np
        import pandas as pd

        for batch in batches:
            x = np.zeros((len(batch), dim))
            raw = []
            for i, v in enumerate(batch["vec"]):
                v = np.asarray(v, np.int64)
                x[i, : len(v)] = v
                raw.append(v.tobytes())
            far = np.maximum((x**2).sum(axis=1)[:, None] - 2 * x @ places.T + squares, 0)
            cell = far.argmin(axis=1)
            away = np.linalg.norm(x - places[cell], axis=1)
            yield pd.DataFrame({
                "id": batch["id"], "vec": raw, "cell": cell.astype(np.int32), "away": away, "group": group_of[cell],
            })

    cells = stored(
        vectors.mapInPandas(assign, "id bigint, vec binary, cell int, away double, group int"), "cells"
    )

    def summarize(batches):
        import numpy as np
        import pandas as pd

        least = {}
        for batch in batches:
            for cell, away in batch.groupby("cell")["away"]:
                least[cell] = np.sort(np.concatenate([least.get(cell, np.empty(0)), away.to_numpy()]))[: k + 1]
        if least:  # a task may have no rows, and an empty column of lists has no type
            yield pd.DataFrame({"cell": pd.array(list(least), "int32"), "least": list(least.values())})

    near = (
        cells.select("cell", "away").mapInPandas(summarize, "cell int, least array<double>")
        .groupBy("cell").agg(F.slice(F.sort_array(F.flatten(F.collect_list("least"))), 1, k + 1).alias("least"))
        .collect()
    )
    kept = [(r["cell"], d) for r in near for d in r["least"]]
    kept_cell, kept_away = np.array([c for c, _ in kept]), np.array([d for _, d in kept])
    queries = cells.where(is_query).select("id", "vec", "group")

    def bounds(batches):
        """For each group and cell, the smallest distance at which some query needs a vector."""
        import numpy as np
        import pandas as pd

        def kth(scores, n):
            if scores.shape[1] < n:
                return np.full(len(scores), -np.inf)
            return np.partition(scores, scores.shape[1] - n, axis=1)[:, scores.shape[1] - n]

        matrix, _ = code()
        need = np.full((groups, len(places)), np.inf)
        for batch in batches:
            group, ids = batch["group"].to_numpy(), batch["id"].to_numpy()
            for at in range(0, len(batch), 256):
                q = matrix(batch["vec"].iloc[at : at + 256], dim).astype(np.float64)
                norm, to_seed = np.linalg.norm(q, axis=1), q @ seeds.T
                to_pivot = to_seed[:, : len(places)].copy()
                # Rows with the id of a query are its own.
                to_seed[ids[at : at + 256, None] == seed_ids] = -np.inf
                sure = to_pivot[:, kept_cell] - norm[:, None] * kept_away
                reached = np.maximum(kth(sure, k + 1), kth(to_seed, k))
                # A little less, for what rounding may take away.
                with np.errstate(divide="ignore", invalid="ignore"):
                    reached = reached - 1e-9 * np.abs(reached) - 1e-3
                    least = (reached[:, None] - to_pivot) / norm[:, None]
                least[~(norm > 0) | ~np.isfinite(reached)] = -np.inf
                np.minimum.at(need, group[at : at + 256], least)
        g, c = np.nonzero(need < np.inf)
        yield pd.DataFrame({"group": g.astype(np.int32), "cell": c.astype(np.int32), "need": need[g, c]})

    need = np.full((groups, len(places)), np.inf)
    needs = queries.mapInPandas(bounds, "group int, cell int, need double")
    for r in needs.groupBy("group", "cell").agg(F.min("need").alias("need")).collect():
        need[r["group"], r["cell"]] = r["need"]

    def received(batches):
        """How many of these vectors each group is sent."""
        import numpy as np
        import pandas as pd

        total = np.zeros(groups, np.int64)
        for batch in batches:
            cell, away = batch["cell"].to_numpy(), batch["away"].to_numpy()
            total += (away[:, None] + 1e-6 >= need[:, cell].T).sum(axis=0)
        yield pd.DataFrame({"group": np.arange(groups, dtype=np.int32), "rows": total})

    def per_group(frame, size):
        parts = np.ones(groups, np.int64)
        for r in frame.collect():
            parts[r["group"]] = max(1, math.ceil(r["rows"] / size))
        return parts

    sent = cells.select("cell", "away").mapInPandas(received, "group int, rows bigint")
    slices = per_group(sent.groupBy("group").agg(F.sum("rows").alias("rows")), slice_rows)
    blocks = per_group(queries.groupBy("group").agg(F.count(F.lit(1)).alias("rows")), block)

    def send(batches):
        import numpy as np
        import pandas as pd

        for batch in batches:
            cell, away = batch["cell"].to_numpy(), batch["away"].to_numpy()
            row, group = np.nonzero(away[:, None] + 1e-6 >= need[:, cell].T)
            times = blocks[group]
            row, group = np.repeat(row, times), np.repeat(group, times)
            part = np.arange(len(row)) - np.repeat(np.cumsum(times) - times, times)
            yield pd.DataFrame({
                "group": group.astype(np.int32), "block": part.astype(np.int32), "slices": slices[group],
                "id": batch["id"].to_numpy()[row], "vec": batch["vec"].to_numpy()[row],
            })

    def sizes(batches):
        for batch in batches:
            group = batch["group"].to_numpy()
            yield batch.assign(blocks=blocks[group], slices=slices[group])

    slice_of = F.pmod(F.xxhash64("id", F.lit(1)), F.col("slices")).cast("int")
    data = (
        cells.select("id", "vec", "cell", "away")
        .mapInPandas(send, "group int, block int, slices bigint, id bigint, vec binary")
        .withColumn("slice", slice_of).drop("slices")
    )
    block_of = F.pmod(F.xxhash64("id", F.lit(2)), F.col("blocks")).cast("int")
    asked = (
        queries.mapInPandas(sizes, "id bigint, vec binary, group int, blocks bigint, slices bigint")
        .withColumn("block", block_of)
        .withColumn("slice", F.explode(F.sequence(F.lit(0), (F.col("slices") - 1).cast("int"))))
        .drop("blocks", "slices")
    )
    return asked, data, dim


def top_k(
    rows: DataFrame, is_query, k: int = 10, key: str = "vec_id", vector: str = "embedding",
    pivots: int | None = None, block: int = BLOCK, slice_rows: int = SLICE, group_queries: int = GROUP_QUERIES,
) -> DataFrame:
    """``(query_id, rank, vec_id, score)``: the best ``k`` other vectors of each row that meets
    ``is_query``, a condition on ``id``. ``pivots`` other than None is their number."""
    code = _matrix_code()
    sent = _sent(rows, is_query, k, key, vector, pivots, block, slice_rows, group_queries)
    if sent is None:
        return rows.sparkSession.createDataFrame([], "query_id bigint, rank int, vec_id bigint, score bigint")
    asked, data, dim = sent

    def solve(queries, data):
        import numpy as np
        import pandas as pd

        matrix, product = code()
        out = []
        if len(queries) and len(data):
            data = data.sort_values("id")
            ids = data["id"].to_numpy()
            x = matrix(data["vec"], dim)
            names = queries["id"].to_numpy()
            for at in range(0, len(names), 256):
                scores = product(matrix(queries["vec"].iloc[at : at + 256], dim), x)
                for name, row in zip(names[at : at + 256], scores):
                    other = np.flatnonzero(ids != name)
                    row = row[other]
                    if len(row) > k:
                        best = np.flatnonzero(row >= np.partition(row, len(row) - k)[len(row) - k])
                    else:
                        best = np.arange(len(row))
                    # Ids are in order, so a stable sort puts the smaller one first.
                    best = best[np.argsort(-row[best], kind="stable")][:k]
                    out.append((np.full(len(best), name), ids[other[best]], row[best]))
        columns = ["query_id", "vec_id", "score"]
        if not out:
            return pd.DataFrame({c: np.empty(0, np.int64) for c in columns})
        return pd.DataFrame(dict(zip(columns, map(np.concatenate, zip(*out)))))

    keys = ["group", "block", "slice"]
    found = asked.groupBy(*keys).cogroup(data.groupBy(*keys)).applyInPandas(
        solve, "query_id bigint, vec_id bigint, score bigint"
    )
    best = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return (
        found.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k)
        .select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")
    )
