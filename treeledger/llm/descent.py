"""Approximate nearest neighbours by cosine: NN-descent builds a graph, greedy search walks it.

Equal vectors are one node; of their ids, a row each, the smallest few can ever be among the nearest, so
a vector that very many rows have is searched and found once. The graph keeps for every node the ``degree``
nearest nodes known. It starts from leaves: nodes in the order of signs of random projections, cut into
runs of LEAF, each of which is compared in itself. Then rounds of NN-descent: every node brings its
neighbours and a sample of the nodes that have it as neighbour together, all pairs of them with at least
one new member are compared, and what is nearer than a node's farthest neighbour goes to that node. It
ends when a round changes less than one in ``1 / LEAST_CHANGE`` edges, or after ``rounds``.

Queries are nodes. A search keeps the ``beam`` nearest nodes seen, opens the ``step`` nearest ones not
opened yet, compares the query with their neighbours in the graph (both ways), and ends when all nodes
of the beam are open. It begins at the query's own node, where the search is for others than itself, and
at SEEDS nodes chosen by a hash. What the beam holds at the end is ranked by cosines in double precision
of the vectors as given.

Rounds of both are joins and grouped tables in the shared folder. Groups are bounded by ``degree``,
``reverse`` and ``beam``; joins on a node that many others name have one row a node on the other side, so
the skew join can split them. Nothing of a vector comes to the driver.

Defined results: vectors that are null or zero, or hold a null or a number that is not finite, take no
part, nor rows without an id. Of different vectors with one id the smallest counts. A shorter vector
counts as filled up with zeros. No rows give no rows; fewer candidates than ``k`` are all returned if the
graph is small enough to be searched whole (``beam`` nodes). Other columns are not looked at.
"""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from treeledger.sources.store import stored

DEGREE = 32
REVERSE = 32
BEAM = 192
STEP = 48
ROUNDS = 10
TREES = 3
LEAF = 64
PLANES = 8
SEEDS = 8
LEAST_CHANGE = 0.01


def usable_vectors(rows: DataFrame, key: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """``(id, vec)``: the rows that take part, one a id."""
    x = F.col("vec")
    rows = rows.select(F.col(key).cast("bigint").alias("id"), F.col(vector).cast("array<double>").alias("vec"))
    bad = F.exists(x, lambda v: v.isNull() | F.isnan(v) | (F.abs(v) == float("inf")))
    return (
        rows.where(F.col("id").isNotNull() & x.isNotNull() & ~bad & F.exists(x, lambda v: v != 0))
        .groupBy("id").agg(F.min("vec").alias("vec"))
    )


def _matrix():
    """Helpers for tasks: rows of bytes to a matrix, shorter ones filled up with zeros."""

    def made():
        import numpy as np

        def matrix(cells, kind):
            cells = list(cells)
            wide = max(map(len, cells)) // np.dtype(kind).itemsize
            if all(len(c) == len(cells[0]) for c in cells):
                return np.frombuffer(b"".join(cells), kind).reshape(len(cells), wide)
            out = np.zeros((len(cells), wide), kind)
            for i, cell in enumerate(cells):
                row = np.frombuffer(cell, kind)
                out[i, : len(row)] = row
            return out

        return matrix

    return made


def _nodes(vectors: DataFrame) -> DataFrame:
    """``(node, vec, unit)`` of ``(node, vec array)``: doubles as given, and floats of length one."""

    def run(batches):
        import numpy as np
        import pandas as pd

        for batch in batches:
            if len(batch):
                given = [np.asarray(v, np.float64) for v in batch["vec"]]
                # Scaled first, so that squares of very large or small numbers stay in range.
                scaled = [v / np.abs(v).max() for v in given]
                yield pd.DataFrame({
                    "node": batch["node"], "vec": [v.tobytes() for v in given],
                    "unit": [(v / np.linalg.norm(v)).astype(np.float32).tobytes() for v in scaled],
                })

    return vectors.mapInPandas(run, "node bigint, vec binary, unit binary")


_EDGES = "node bigint, nbr bigint, near float"


def _nearest_only(edges: DataFrame, degree: int) -> DataFrame:
    """The ``degree`` nearest different neighbours of each node; an edge that was there before is old."""
    once = edges.repartition("node").groupBy("node", "nbr").agg(F.max("near").alias("near"), F.min("new").alias("new"))
    order = Window.partitionBy("node").orderBy(F.desc("near"), "nbr")
    return once.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= degree).drop("rank")


def _leaves(nodes: DataFrame, tree: int, degree: int, leaf: int) -> DataFrame:
    """Edges inside runs of ``leaf`` nodes in the order of the signs of projections."""
    make, planes = _matrix(), PLANES

    def project(batches):
        import numpy as np
        import pandas as pd

        matrix = make()
        drawn = np.zeros((0, planes + 1), np.float32)
        for batch in batches:
            if not len(batch):
                continue
            x = matrix(batch["unit"], np.float32)
            if x.shape[1] > len(drawn):  # each dimension has its own draw
                more = [np.random.Generator(np.random.Philox(key=[tree, d])).normal(size=planes + 1) for d in range(len(drawn), x.shape[1])]
                drawn = np.concatenate([drawn, np.array(more, np.float32)])
            at = x @ drawn[: x.shape[1]]
            code = ((at[:, :planes] > 0) << np.arange(planes)).sum(axis=1)
            yield pd.DataFrame({"node": batch["node"], "unit": batch["unit"], "code": code, "at": at[:, planes]})

    def compare(batches):
        import numpy as np
        import pandas as pd

        matrix = make()

        def work(rows):
            n, x = rows["node"].to_numpy(), matrix(rows["unit"], np.float32)
            near = x @ x.T
            np.fill_diagonal(near, -2)
            most = min(degree, len(n) - 1)
            if most:
                best = np.argpartition(-near, most - 1, axis=1)[:, :most]
                yield pd.DataFrame({
                    "node": np.repeat(n, most), "nbr": n[best.ravel()],
                    "near": np.take_along_axis(near, best, axis=1).ravel(),
                })

        held = None
        for batch in batches:
            held = batch if held is None else pd.concat([held, batch], ignore_index=True)
            whole = len(held) // leaf * leaf
            for at in range(0, whole, leaf):
                yield from work(held.iloc[at : at + leaf])
            held = held.iloc[whole:]
        if held is not None and len(held):
            yield from work(held)

    placed = nodes.select("node", "unit").mapInPandas(project, "node bigint, unit binary, code bigint, at float")
    ordered = placed.repartitionByRange("code", "at", "node").sortWithinPartitions("code", "at", "node")
    return ordered.select("node", "unit").mapInPandas(compare, _EDGES)


def _local_joins(edges: DataFrame, nodes: DataFrame, degree: int, reverse: int, turn: int) -> DataFrame:
    """Edges found by comparing the neighbours of each node with each other, and with the node."""
    back = edges.select(F.col("nbr").alias("at"), F.col("node").alias("member"), "new")
    some = Window.partitionBy("at").orderBy(F.desc("new"), F.xxhash64("member", F.lit(turn)), "member")
    back = back.withColumn("rank", F.row_number().over(some)).where(F.col("rank") <= reverse).drop("rank")
    own = edges.select("node").distinct().select(F.col("node").alias("at"), F.col("node").alias("member"), F.lit(0).alias("new"))
    members = (
        edges.select(F.col("node").alias("at"), F.col("nbr").alias("member"), "new").unionByName(back).unionByName(own)
        .groupBy("at", "member").agg(F.max("new").alias("new"))
    )
    # A node that has all its neighbours takes only nearer ones than the farthest of them.
    least = edges.groupBy("node").agg(
        F.when(F.count(F.lit(1)) >= degree, F.min("near")).otherwise(F.lit(-2.0)).cast("float").alias("least")
    )
    known = nodes.select("node", "unit").join(least, "node", "left").withColumnRenamed("node", "member")
    asked = members.join(known, "member").select("at", "member", "new", "unit", F.coalesce("least", F.lit(-2.0)).cast("float").alias("least"))
    make = _matrix()
    most = max(4, degree // 3)

    def run(batches):
        import numpy as np
        import pandas as pd

        matrix = make()

        def work(rows):
            member, new = rows["member"].to_numpy(), rows["new"].to_numpy(bool)
            x, least = matrix(rows["unit"], np.float32), rows["least"].to_numpy()
            begin = np.flatnonzero(np.concatenate(([True], np.diff(rows["at"].to_numpy()) != 0)))
            out = []
            for a, b in zip(begin, [*begin[1:], len(rows)]):
                near = x[a:b] @ x[a:b].T
                near[~(new[a:b, None] | new[None, a:b])] = -3
                np.fill_diagonal(near, -3)
                if b - a > most:
                    # Of the nearest of this group, those that the node has room for.
                    floor = np.partition(near, b - a - most, axis=1)[:, b - a - most]
                    near[near < floor[:, None]] = -3
                who, whom = np.nonzero(near > np.maximum(least[a:b], -2.5)[:, None])
                out.append((member[a + who], member[a + whom], near[who, whom]))
            node, nbr, near = map(np.concatenate, zip(*out))
            if len(node):
                yield pd.DataFrame({"node": node, "nbr": nbr, "near": near})

        held = None
        for batch in batches:
            if not len(batch):
                continue
            held = batch if held is None else pd.concat([held, batch], ignore_index=True)
            if len(held) < 4_000:
                continue
            at = held["at"].to_numpy()
            last = int(np.flatnonzero(at != at[-1])[-1]) + 1 if (at != at[-1]).any() else 0
            if last:
                yield from work(held.iloc[:last])
                held = held.iloc[last:]
        if held is not None and len(held):
            yield from work(held)

    return asked.repartition("at").sortWithinPartitions("at", "member").mapInPandas(run, _EDGES)


def build_graph(nodes: DataFrame, degree: int = DEGREE, reverse: int = REVERSE, rounds: int = ROUNDS, leaf: int = LEAF) -> DataFrame:
    """``(node, nbr, near, new)``: the ``degree`` nearest nodes found for each node."""
    start = _leaves(nodes, 0, degree, leaf)
    for tree in range(1, TREES):
        start = start.unionByName(_leaves(nodes, tree, degree, leaf))
    edges = stored(_nearest_only(start.withColumn("new", F.lit(1)), degree), "edges")
    n = edges.count()
    for turn in range(rounds):
        found = _local_joins(edges, nodes, degree, reverse, turn).withColumn("new", F.lit(1))
        edges = stored(_nearest_only(edges.withColumn("new", F.lit(0)).unionByName(found), degree), "edges")
        if edges.where("new = 1").count() <= LEAST_CHANGE * n:
            break
    return edges


def search(
    nodes: DataFrame, edges: DataFrame, asked: DataFrame, beam: int = BEAM, step: int = STEP, reverse: int = REVERSE,
) -> DataFrame:
    """``(query, node, near)``: the ``beam`` nearest nodes found for each node in ``asked`` (column
    ``query``), itself among them."""
    order = Window.partitionBy("node").orderBy(F.desc("near"), "nbr")
    back = edges.select(F.col("nbr").alias("node"), F.col("node").alias("nbr"), "near")
    back = back.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= reverse).drop("rank")
    ways = stored(
        edges.select("node", "nbr").unionByName(back.select("node", "nbr")).groupBy("node")
        .agg(F.collect_set("nbr").alias("nbrs")), "graph",
    )
    units = nodes.select("node", "unit")
    wanted = units.select(F.col("node").alias("query"), F.col("unit").alias("wanted")).join(asked, "query", "left_semi")
    wanted = stored(wanted, "wanted")
    make = _matrix()

    def measure(batches):
        import numpy as np
        import pandas as pd

        matrix = make()
        for batch in batches:
            if len(batch):
                a, b = matrix(batch["unit"], np.float32), matrix(batch["wanted"], np.float32)
                wide = min(a.shape[1], b.shape[1])
                near = np.einsum("ij,ij->i", a[:, :wide], b[:, :wide])
                yield pd.DataFrame({"query": batch["query"], "node": batch["node"], "near": near})

    def near(pairs):
        met = pairs.join(units, "node").join(wanted, "query")
        return met.mapInPandas(measure, "query bigint, node bigint, near float").withColumn("open", F.lit(False))

    def kept(rows):
        best = Window.partitionBy("query").orderBy(F.desc("near"), "node")
        return stored(rows.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= beam).drop("rank"), "beam")

    seeds = nodes.select("node").orderBy(F.xxhash64("node", F.lit(7)), "node").limit(SEEDS)
    spots = F.array(*[F.lit(r[0]) for r in seeds.collect()]).cast("array<bigint>")
    begin = asked.select("query", F.explode(F.array_distinct(F.array_append(spots, F.col("query")))).alias("node"))
    now = kept(near(begin))
    first = Window.partitionBy("query").orderBy(F.desc("near"), "node")
    while True:
        front = now.where(~F.col("open")).withColumn("rank", F.row_number().over(first)).where(F.col("rank") <= step)
        front = stored(front.select("query", "node"), "front")
        if front.isEmpty():
            return now.drop("open")
        opened = now.join(front.withColumn("now", F.lit(True)), ["query", "node"], "left").select(
            "query", "node", "near", (F.col("open") | F.coalesce("now", F.lit(False))).alias("open")
        )
        seen = front.join(ways, "node").select("query", F.explode("nbrs").alias("node")).distinct()
        new = seen.join(now.select("query", "node"), ["query", "node"], "left_anti")
        now = kept(opened.unionByName(near(new)))


def nearest(
    rows: DataFrame, is_query, k: int = 5, key: str = "vec_id", vector: str = "embedding", degree: int = DEGREE,
    reverse: int = REVERSE, beam: int = BEAM, step: int = STEP, rounds: int = ROUNDS,
) -> DataFrame:
    """``(query_id, rank, vec_id, score)``: the ``k`` nearest other vectors found for each row that meets
    ``is_query``, a condition on ``id``."""
    given = stored(usable_vectors(rows, key, vector), "vectors")
    different = stored(given.groupBy("vec").agg(F.min("id").alias("node")), "different")
    members = stored(given.join(different, "vec").select("id", "node"), "members")
    nodes = stored(_nodes(different), "nodes")
    edges = build_graph(nodes, degree, reverse, rounds)
    queries = members.where(is_query)
    found = search(nodes, edges, queries.select(F.col("node").alias("query")).distinct(), beam, step, reverse)
    # Of equal vectors the smallest ids come first; one of them may be the query's own.
    small = Window.partitionBy("node").orderBy("id")
    ids = members.withColumn("rank", F.row_number().over(small)).where(F.col("rank") <= k + 1).select("node", "id")
    exact = nodes.select("node", "vec")
    make = _matrix()

    def measure(batches):
        import numpy as np
        import pandas as pd

        matrix = make()

        def whole(x):
            """Brought near 1 by a power of two: cosines stay the same to the bit, and in range."""
            return np.ldexp(x, -np.frexp(np.abs(x).max(axis=1, keepdims=True))[1])

        for batch in batches:
            if len(batch):
                a, b = whole(matrix(batch["vec"], np.float64)), whole(matrix(batch["wanted"], np.float64))
                wide = min(a.shape[1], b.shape[1])
                dot = np.einsum("ij,ij->i", a[:, :wide], b[:, :wide])
                score = dot / (np.sqrt(np.einsum("ij,ij->i", a, a)) * np.sqrt(np.einsum("ij,ij->i", b, b)))
                yield pd.DataFrame({"query": batch["query"], "node": batch["node"], "score": score})

    wanted = exact.select(F.col("node").alias("query"), F.col("vec").alias("wanted"))
    scored = found.select("query", "node").join(exact, "node").join(wanted, "query").mapInPandas(
        measure, "query bigint, node bigint, score double"
    )
    best = Window.partitionBy("query").orderBy(F.desc("score"), "id")
    lists = stored(
        scored.join(ids, "node").withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k + 1)
        .groupBy("query").agg(F.sort_array(F.collect_list(F.struct((-F.col("score")).alias("far"), "id"))).alias("best")),
        "lists",
    )
    mine = queries.join(lists, queries["node"] == lists["query"]).select(
        F.col("id").alias("query_id"), F.slice(F.filter("best", lambda b: b["id"] != F.col("id")), 1, k).alias("best")
    )
    return mine.select("query_id", F.posexplode("best").alias("at", "b")).select(
        "query_id", (F.col("at") + 1).cast("int").alias("rank"), F.col("b.id").alias("vec_id"),
        (-F.col("b.far")).alias("score"),
    )
