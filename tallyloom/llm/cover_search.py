"""Exact search for the largest inner products with cover trees over queries and data.

Points are dealt out to branches around pivots; a branch is one row that holds a cover tree over
some thousands of points. Queries are put into cover trees of their own, a block of them at
a time, which every task that scans branches gets. A pair of nodes is left out if no member of the one
can reach, with any member of the other, the worst kept score of the query node's members. By the
radii that cover them, <q, r> <= <c, d> + R |d| + S |c| + R S for centres c, d and radii R, S.
"""

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from tallyloom.session import materialise

_NODE = np.dtype([("centre", "<i8"), ("radius", "<f8"), ("low", "<i8"), ("high", "<i8"), ("child", "<i8"), ("children", "<i8")])
_NONE = np.iinfo(np.int64).min
#: Sums of whole numbers up to here are exact as doubles.
_EXACT = 2.0**53
_FAN = 16


def products(a: np.ndarray, b: np.ndarray, exact: bool) -> np.ndarray:
    """Inner products of the rows; as doubles where these are ``exact``, else as 64-bit integers."""
    if exact:
        return (a.astype(np.float64) @ b.astype(np.float64).T).astype(np.int64)
    return a.astype(np.int64) @ b.astype(np.int64).T


def distances(points: np.ndarray, centre: np.ndarray) -> np.ndarray:
    difference = points.astype(np.float64) - centre.astype(np.float64)
    return np.sqrt(np.einsum("ij,ij->i", difference, difference))


def separated(points: np.ndarray, most: int, within: float = 0.0) -> tuple[np.ndarray, np.ndarray]:
    """(centres, nearest centre of each point): the first point, then always the one farthest from all so far.

    Ends with ``most`` centres, or when every point is ``within`` that distance of one.
    """
    centres, nearest = [0], np.zeros(len(points), dtype=np.int64)
    least = distances(points, points[0])
    while len(centres) < most and len(points) and least.max() > within:
        far = int(least.argmax())
        own = distances(points, points[far])
        nearer = own < least
        nearest[nearer] = len(centres)
        least[nearer] = own[nearer]
        centres.append(far)
    return np.array(centres, dtype=np.int64), nearest


def cover_tree(points: np.ndarray, leaf: int) -> tuple[np.ndarray, np.ndarray]:
    """(nodes, order): a node covers order[low:high], all within ``radius`` of point ``centre``.

    Children are separated by half the radius of their parent, whose centre is one of theirs; there are
    16 at most, so a radius is the true one and not a power of two. Root first.
    """
    order = np.arange(len(points))
    nodes = [(0, 0.0, 0, len(points), 0, 0)]
    at = 0
    while at < len(nodes):
        centre, _, low, high, _, _ = nodes[at]
        members = order[low:high]
        # the centre comes first among its members
        members = np.concatenate(([centre], members[members != centre]))
        away = distances(points[members], points[centre])
        radius = float(away.max()) * (1 + 1e-9)
        if high - low <= leaf or radius == 0:
            order[low:high] = members
            nodes[at] = (centre, radius, low, high, 0, 0)
        else:
            centres, nearest = separated(points[members], _FAN, radius / 2)
            sort = np.argsort(nearest, kind="stable")
            order[low:high] = members[sort]
            edges = low + np.concatenate(([0], np.cumsum(np.bincount(nearest, minlength=len(centres)))))
            nodes[at] = (centre, radius, low, high, len(nodes), len(centres))
            nodes += [(int(members[c]), 0.0, int(a), int(b), 0, 0) for c, a, b in zip(centres, edges, edges[1:])]
        at += 1
    return np.array(nodes, dtype=_NODE), order


def _packed(points: np.ndarray) -> bytes:
    small = not len(points) or (abs(points) < 2**31).all()
    return points.astype("<i4" if small else "<i8").tobytes()


def _unpacked(raw: bytes, n: int, width: int) -> np.ndarray:
    kind = "<i4" if len(raw) == 4 * n * width else "<i8"
    return np.frombuffer(raw, dtype=kind).reshape(n, width).astype(np.int64)


def _matrix(vectors: list[bytes], width: int) -> np.ndarray:
    """Rows of whole numbers, shorter ones filled up with zeros."""
    return np.frombuffer(b"".join(v.ljust(8 * width, b"\0") for v in vectors), dtype="<i8").reshape(len(vectors), width)


class Tree:
    """Points in the order of a cover tree, with its nodes."""

    def __init__(self, nodes: np.ndarray, points: np.ndarray):
        self.nodes, self.points = nodes, points
        self.centres = points[nodes["centre"]].astype(np.float64) if len(points) else np.zeros((0, points.shape[1]))
        self.norms = np.sqrt(np.einsum("ij,ij->i", self.centres, self.centres))


def built(points: np.ndarray, leaf: int) -> tuple[Tree, np.ndarray]:
    """A tree, and the order in which it has the points."""
    nodes, order = cover_tree(points, leaf)
    place = np.empty(len(order), dtype=np.int64)
    place[order] = np.arange(len(order))
    nodes["centre"] = place[nodes["centre"]]
    return Tree(nodes, points[order]), order


class Best:
    """The ``keep`` best (score, id) of every query of a block, none below its ``floor``."""

    def __init__(self, n: int, keep: int, floor: np.ndarray):
        self.keep = keep
        self.score = np.full((n, keep), _NONE, dtype=np.int64)
        self.ids = np.zeros((n, keep), dtype=np.int64)
        self.same = np.zeros((n, keep), dtype=bool)
        self.least = floor.copy()  # a score below is of no use

    def add(self, query: np.ndarray, score: np.ndarray, ids: np.ndarray, same: np.ndarray) -> None:
        rows = np.unique(query)
        held = self.score[rows] != _NONE
        owner = np.concatenate((query, np.repeat(rows, held.sum(axis=1))))
        score = np.concatenate((score, self.score[rows][held]))
        ids = np.concatenate((ids, self.ids[rows][held]))
        same = np.concatenate((same, self.same[rows][held]))
        order = np.lexsort((ids, -score, owner))
        owner, score, ids, same = owner[order], score[order], ids[order], same[order]
        rank = np.arange(len(owner)) - np.searchsorted(owner, owner, "left")
        kept = rank < self.keep
        owner, rank = owner[kept], rank[kept]
        self.score[owner, rank], self.ids[owner, rank], self.same[owner, rank] = score[kept], ids[kept], same[kept]
        self.least[rows] = np.maximum(self.least[rows], self.score[rows, -1])


def search(queries: Tree, data: Tree, ids: np.ndarray, ends: np.ndarray, best: Best, exact: bool) -> int:
    """Bring ``best`` up to date with all of ``data``, whose point k has ids[ends[k - 1]:ends[k]].

    Both trees are gone down together, the more promising pairs first. Returns the number of
    products that were looked at.
    """
    if not len(queries.points) or not len(data.points):
        return 0
    q, d, looked_at = queries.nodes, data.nodes, 0
    most = queries.centres @ data.centres.T + np.outer(q["radius"], data.norms)
    most += np.outer(queries.norms, d["radius"]) + np.outer(q["radius"], d["radius"])
    most += 1e-9 * abs(most) + 1e-6  # roundings never leave out a pair
    counts = np.diff(np.concatenate(([0], ends)))
    stack = [(0, 0)]
    while stack:
        a, b = stack.pop()
        low, high = int(q["low"][a]), int(q["high"][a])
        if most[a, b] < best.least[low:high].min():
            continue
        if q["children"][a] and (q["radius"][a] >= d["radius"][b] or not d["children"][b]):
            first = int(q["child"][a])
            below = [(k, b) for k in range(first, first + int(q["children"][a]))]
        elif d["children"][b]:
            first = int(d["child"][b])
            below = [(a, k) for k in range(first, first + int(d["children"][b]))]
        else:
            start, stop = int(d["low"][b]), int(d["high"][b])
            scores = products(queries.points[low:high], data.points[start:stop], exact)
            looked_at += scores.size
            row, column = np.nonzero(scores >= best.least[low:high, None])
            if len(row):
                score = scores[row, column]
                row, column = row + low, column + start
                same = (queries.points[row] == data.points[column]).all(axis=1)
                n = counts[column]
                place = np.repeat(ends[column] - np.cumsum(n), n) + np.arange(n.sum())
                best.add(np.repeat(row, n), np.repeat(score, n), ids[place], np.repeat(same, n))
            continue
        stack += sorted(below, key=lambda pair: most[pair])
    return looked_at


# --- tables ------------------------------------------------------------------------------


def _vectors(keep: int, scale: int):
    """Rows (v, ids, norm): distinct vectors of a batch in whole numbers, with their ``keep`` smallest ids."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found: dict[bytes, list[int]] = {}
            norms: dict[bytes, float] = {}
            ids, lists = batch.column(0).to_numpy(zero_copy_only=False), batch.column(1)
            flat = lists.flatten()
            values = flat.cast(pa.float64()).fill_null(np.nan).to_numpy(zero_copy_only=False)
            sizes = lists.value_lengths().fill_null(0).to_numpy()
            ends = np.cumsum(sizes)
            odd = np.concatenate(([0], np.cumsum(~np.isfinite(values))))
            with np.errstate(invalid="ignore", over="ignore"):
                whole = np.floor(scale * values)
            for k in np.argsort(ids, kind="stable"):
                low, high = ends[k] - sizes[k], ends[k]
                if odd[high] != odd[low]:
                    continue
                vector = whole[low:high]
                norm = float(vector @ vector)
                if norm >= 2.0**63:
                    raise OverflowError("inner products beyond 64 bits")
                key = np.trim_zeros(vector, "b").astype("<i8").tobytes()
                own = found.setdefault(key, [])
                if len(own) < keep and (not own or own[-1] != ids[k]):
                    own.append(int(ids[k]))
                    norms[key] = norm
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(list(found), pa.binary()),
                    pa.array(list(found.values()), pa.list_(pa.int64())),
                    pa.array([norms[k] for k in found], pa.float64()),
                ],
                names=["v", "ids", "norm"],
            )

    return run


def _cells(pivots: np.ndarray, width: int):
    """The nearest pivot of each vector."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for low in range(0, batch.num_rows, 4096):
                part = batch.slice(low, 4096)
                points = _matrix(part.column(0).to_pylist(), width).astype(np.float64)
                away = (pivots * pivots).sum(axis=1)[None, :] - 2 * points @ pivots.T
                yield pa.RecordBatch.from_arrays(
                    [*part.columns, pa.array(away.argmin(axis=1).astype(np.int32))], names=["v", "ids", "cell"]
                )

    return run


_BRANCH = "n long, points binary, nodes binary, ids binary, ends binary"


def _branch(width: int, leaf: int):
    def run(rows: pa.Table) -> pa.Table:
        vectors, owners = rows.column("v").to_pylist(), rows.column("ids").to_pylist()
        tree, order = built(_matrix(vectors, width), leaf)
        owners = [owners[k] for k in order]
        return pa.table(
            {
                "n": [len(order)],
                "points": [_packed(tree.points)],
                "nodes": [tree.nodes.tobytes()],
                "ids": [np.array([i for own in owners for i in own], dtype="<i8").tobytes()],
                "ends": [np.cumsum([len(own) for own in owners]).astype("<i8").tobytes()],
            }
        )

    return run


_BLOCK = "block int, n long, points binary, nodes binary, floors binary"


def _block(width: int, leaf: int, keep: int, exact: bool):
    """One row for a block of queries; a floor is a score that ``keep`` members of the query's leaf reach."""

    def run(rows: pa.Table) -> pa.Table:
        tree, _ = built(_matrix(rows.column("v").to_pylist(), width), leaf)
        floors = np.full(len(tree.points), _NONE, dtype=np.int64)
        for node in tree.nodes:
            low, high = int(node["low"]), int(node["high"])
            if not node["children"] and high - low >= keep:
                for start in range(low, high, 1024):
                    stop = min(start + 1024, high)
                    scores = products(tree.points[start:stop], tree.points[low:high], exact)
                    floors[start:stop] = np.partition(scores, -keep, axis=1)[:, -keep]
        return pa.table(
            {
                "block": pa.array([rows.column("block")[0].as_py()], pa.int32()),
                "n": [len(tree.points)],
                "points": [_packed(tree.points)],
                "nodes": [tree.nodes.tobytes()],
                "floors": [floors.astype("<i8").tobytes()],
            }
        )

    return run


def _members(width: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                points = _unpacked(row["points"], row["n"], width)
                keys = [np.trim_zeros(p, "b").astype("<i8").tobytes() for p in points]
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(np.full(len(keys), row["block"], dtype=np.int32)),
                        pa.array(np.arange(len(keys), dtype=np.int64)), pa.array(keys, pa.binary()),
                    ],
                    names=["block", "q", "v"],
                )

    return run


def _scan(held, block: int, width: int, keep: int, exact: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, points, nodes, floors = held.value
        queries = Tree(np.frombuffer(nodes, dtype=_NODE), _unpacked(points, n, width))
        best = Best(n, keep, np.frombuffer(floors, dtype="<i8"))
        for batch in batches:
            for row in range(batch.num_rows):
                size, *raw = (column[row].as_py() for column in batch.columns)
                data = Tree(np.frombuffer(raw[1], dtype=_NODE), _unpacked(raw[0], size, width))
                search(queries, data, np.frombuffer(raw[2], dtype="<i8"), np.frombuffer(raw[3], dtype="<i8"), best, exact)
        query, slot = np.nonzero(best.score != _NONE)
        yield pa.RecordBatch.from_arrays(
            [
                pa.array(np.full(len(query), block, dtype=np.int32)), pa.array(query),
                pa.array(best.score[query, slot]), pa.array(best.ids[query, slot]), pa.array(best.same[query, slot]),
            ],
            names=["block", "q", "score", "vec_id", "same"],
        )

    return run


def top_products(
    vectors: DataFrame, vec_id: str = "vec_id", vector: str = "embedding", every: int = 50, k: int = 5, scale: int = 256,
    branch_rows: int = 4096, most_cells: int = 1024, leaf: int = 256, query_leaf: int = 64, block_bytes: int = 64 << 20,
) -> DataFrame:
    """For each row whose id ``every`` divides, the ``k`` other rows of largest inner product: query_id, rank, vec_id, score.

    Components count as floor(``scale`` * x). Ties go to the smaller id; with fewer rows, all are returned. A
    row without an id, a null vector, and a vector that holds null or a number that is not finite take
    no part. A shorter vector counts as filled up with zeros, an empty one as zeros alone. Rows that
    repeat id and vector count once; rows of one id with different vectors are rows of their
    own, of which each query leaves out itself alone. An empty table gives no rows. Other columns are
    ignored, whatever their names. Scores must fit 64 bits, else it is an error.

    Equal vectors are one point with its ``k`` + 1 smallest ids (no other can be among the best), so a very
    common vector is no hot spot. Pivots, ``most_cells`` at most, are picked from a sample of eight times as many;
    every vector is indexed, and a cell of more than ``branch_rows`` is cut by hash. Queries are
    broadcast in blocks of ``block_bytes`` at most, one after the other, so there may be any number.
    """
    spark = vectors.sparkSession
    keep = k + 1
    frame = vectors.select(F.col(vec_id).cast("long").alias("vec_id"), F.col(vector).alias("v"))
    frame = frame.where("vec_id IS NOT NULL AND v IS NOT NULL")
    schema = "v binary, ids array<long>, norm double"
    together = F.slice(F.array_sort(F.array_distinct(F.flatten(F.collect_list("ids")))), 1, keep)
    points = materialise(
        frame.mapInArrow(_vectors(keep, scale), schema).groupBy("v").agg(together.alias("ids"), F.max("norm").alias("norm"))
    )
    asked = frame.where(F.col("vec_id") % every == 0).mapInArrow(_each(scale), "query_id long, v binary")
    asked = materialise(asked.distinct())
    found = points.agg(F.count(F.lit(1)).alias("n"), F.max(F.octet_length("v")).alias("bytes"), F.max("norm").alias("norm")).first()
    width, exact = max(1, (found["bytes"] or 0) // 8), (found["norm"] or 0) < _EXACT
    points = points.select("v", "ids")

    cells = min(most_cells, -(-found["n"] // branch_rows)) or 1
    sample = points.select("v", F.xxhash64("v").alias("h")).orderBy("h", "v").limit(8 * cells).collect()
    sample = _matrix([bytes(r["v"]) for r in sample], width)
    pivots = sample[separated(sample, cells)[0]].astype(np.float64) if len(sample) else np.zeros((1, width))
    placed = points.mapInArrow(_cells(pivots, width), "v binary, ids array<long>, cell int")
    sizes = {r["cell"]: r["count"] for r in placed.groupBy("cell").count().collect()}
    cuts = F.array(*[F.lit(-(-sizes.get(c, 0) // branch_rows) or 1) for c in range(len(pivots))])
    placed = placed.withColumn("piece", F.pmod(F.xxhash64("v"), F.get(cuts, F.col("cell"))))
    branches = materialise(placed.groupBy("cell", "piece").applyInArrow(_branch(width, leaf), _BRANCH))

    distinct = asked.select("v").distinct()
    count = distinct.count()
    n_blocks = max(1, -(-2 * count * width * 8 // block_bytes))
    blocks = distinct.withColumn("block", F.pmod(F.xxhash64("v"), F.lit(n_blocks)).cast("int"))
    blocks = materialise(blocks.groupBy("block").applyInArrow(_block(width, query_leaf, keep, exact), _BLOCK))
    results = spark.createDataFrame([], "block int, q long, score long, vec_id long, same boolean")
    for number in range(n_blocks if count else 0):
        for row in blocks.where(F.col("block") == number).collect():
            held = spark.sparkContext.broadcast((row["n"], bytes(row["points"]), bytes(row["nodes"]), bytes(row["floors"])))
            part = branches.mapInArrow(_scan(held, number, width, keep, exact), results.schema)
            results = results.unionByName(materialise(part))
            held.unpersist()

    # the most that a query's list of candidates can hold is ``keep`` for each task that scanned branches
    order = F.struct((-F.col("score")).alias("less"), "vec_id", "same")
    lists = results.groupBy("block", "q").agg(F.slice(F.array_sort(F.collect_list(order)), 1, keep).alias("best"))
    named = blocks.mapInArrow(_members(width), "block int, q long, v binary").join(lists, ["block", "q"]).select("v", "best")
    others = F.filter("best", lambda b: ~(b["same"] & (b["vec_id"] == F.col("query_id"))))
    ranked = asked.join(named, "v").select("query_id", F.posexplode(F.slice(others, 1, k)).alias("at", "b"))
    return ranked.select(
        "query_id", (F.col("at") + 1).cast("int").alias("rank"), F.col("b.vec_id").alias("vec_id"), (-F.col("b.less")).alias("score")
    )


def _each(scale: int):
    """(id, vector in whole numbers) of every usable row."""
    whole = _vectors(1 << 62, scale)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in whole(batches):
            owners = batch.column(1)
            keys = batch.column(0).take(pa.array(np.repeat(np.arange(batch.num_rows), owners.value_lengths().to_numpy())))
            yield pa.RecordBatch.from_arrays([owners.flatten(), keys], names=["query_id", "v"])

    return run
