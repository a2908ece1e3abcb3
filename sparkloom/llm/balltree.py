"""Exact top-k inner products by ball-tree branch and bound, shard by shard.

Candidates are dealt to cells by the nearest of a few centres, cells are cut
into shards of bounded size, and each shard becomes one ball tree. Up to
``BUNDLE`` shards of a cell are a bundle of bounded bytes. Queries travel in
blocks of one cell, once to a bundle, whose trees come before the blocks in one
sorted partition: a task holds the trees of one bundle and one batch of blocks,
and no tree is copied for a block. In a shard the nodes are visited in order of their
inner-product upper bound ``q.c + |q| r``, and a node is skipped where the bound
lies below the query's current k-th score. That score is shared between shards in three
rounds: a block first meets one bundle of the cell with the highest bound, then
the others of that cell, then the bundles of all other cells; before each round
the cells' own bounds drop the queries that can gain nothing there, so these
don't travel.

The centres come from a sample of ``SAMPLE`` rows, fewer where these would hold
more than ``SAMPLE_BYTES`` on the driver; they decide where rows lie,
never whether one is searched.

Defined cases: vectors that are null or hold null or non-finite components
take no part, nor do rows without an id; vectors of different lengths are not
compared; every row counts, so rows that repeat an id are queries of their own
and candidates for each other; scores beyond the range of a long are its end;
ties go to the smaller id; very long vectors are whole rows of one tree; an empty
table gives an empty result; extra columns are ignored.
"""

from __future__ import annotations

import io
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from sparkloom.scratch import cut, drop

LEAF = 64
DENSE = 1024
SHARD_ROWS = 8192
BLOCK_ROWS = 512
BUNDLE, BUNDLE_BYTES = 16, 64 << 20
LANES = 48
CENTRES = 64
CELL_ROWS = 2048
SAMPLE, SAMPLE_BYTES = 4096, 32 << 20
SHARD_BYTES = 32 << 20
LEAST, MOST = np.iinfo(np.int64).min, np.iinfo(np.int64).max


def scaled(vectors: DataFrame, factor: int = 64, id_col: str = "vec_id", vec_col: str = "embedding") -> DataFrame:
    """``row, vec_id, v`` of the vectors that take part: a number of each row's own, and whole components floor(factor * x) as doubles, which hold them exactly."""
    whole = lambda y: F.when(F.abs(y) < 2.0**52, F.floor(y).cast("double")).otherwise(y)
    v = F.transform(F.col(vec_col), lambda x: whole(x.cast("double") * factor))
    finite = F.forall(vec_col, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x.cast("double") * factor) < float("inf")))
    ok = F.col(id_col).isNotNull() & F.coalesce(finite, F.lit(False))
    return vectors.where(ok).select(F.monotonically_increasing_id().alias("row"), F.col(id_col).cast("long").alias("vec_id"), v.alias("v"))


def _pack(**arrays: np.ndarray) -> bytes:
    out = io.BytesIO()
    np.savez(out, **arrays)
    return out.getvalue()


def _unpack(raw: bytes) -> dict[str, np.ndarray]:
    with np.load(io.BytesIO(raw)) as found:
        return {k: found[k] for k in found.files}


def _small(v: np.ndarray) -> np.ndarray:
    """Whole components in the least type that holds them all exactly."""
    top = float(np.abs(v).max(initial=0))
    return v.astype(np.int8 if top < 2**7 else np.int16 if top < 2**15 else np.int32 if top < 2**31 else np.float64)


def build(rows: np.ndarray, ids: np.ndarray, v: np.ndarray) -> dict[str, np.ndarray]:
    """A ball tree: points in leaf order, and per node centre, radius, point range and children."""
    order, nodes = np.arange(len(ids)), []
    todo = [(0, len(ids), -1, 0)]
    while todo:
        a, z, parent, side = todo.pop()
        own = v[order[a:z]]
        centre, radius = _ball(own)
        me = len(nodes)
        nodes.append([a, z, -1, -1, centre, radius])
        if parent >= 0:
            nodes[parent][2 + side] = me
        if z - a > LEAF:
            far = own[((own - centre) ** 2).sum(axis=1).argmax()]
            across = own @ (far - own[((own - far) ** 2).sum(axis=1).argmax()])
            split = (z - a) // 2
            order[a:z] = order[a:z][np.argpartition(across, split)]
            todo += [(a, a + split, me, 0), (a + split, z, me, 1)]
    return {
        "rows": rows[order], "ids": ids[order], "v": v[order], "range": np.array([n[:2] for n in nodes]), "kids": np.array([n[2:4] for n in nodes]),
        "centre": np.array([n[4] for n in nodes]), "radius": np.array([n[5] for n in nodes]),
    }


def _ball(own: np.ndarray) -> tuple[np.ndarray, float]:
    centre = own.mean(axis=0)
    return centre, float(np.sqrt(((own - centre) ** 2).sum(axis=1)).max() * (1 + 1e-12) + 1e-9)


def _bounds(q: np.ndarray, centre: np.ndarray, radius: np.ndarray) -> np.ndarray:
    """What no inner product of a query with a point of each ball exceeds, rounding included."""
    norms = np.sqrt((q**2).sum(axis=1))[:, None]
    reach = np.sqrt((centre**2).sum(axis=1)) + radius
    return np.nan_to_num(q @ centre.T + norms * radius + 1e-9 * (1 + norms * reach), nan=np.inf, posinf=np.inf)


def _products(q: np.ndarray, v: np.ndarray) -> np.ndarray:
    """Exact inner products of whole components, cut to the range of a long above its least value; floats if these hold them exactly."""
    top = float(np.abs(q).max(initial=0)) * float(np.abs(v).max(initial=0)) * max(1, q.shape[1])
    if top < 2**24:
        return q.astype(np.float32, copy=False) @ v.astype(np.float32, copy=False).T
    if top < 2**53:
        return q.astype(np.float64, copy=False) @ v.astype(np.float64, copy=False).T
    if top < 2**63:
        return q.astype(np.int64) @ v.astype(np.int64).T
    whole = lambda m: np.array([[int(x) for x in r] for r in m], dtype=object).reshape(m.shape)
    return np.clip(whole(q) @ whole(v).T, int(LEAST) + 1, int(MOST)).astype(np.int64)


def search(tree: dict[str, np.ndarray], query_rows: np.ndarray, q: np.ndarray, floor: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(query, candidate's place in the tree, score): each query's k best of the tree that reach its floor, ties to smaller ids."""
    bounds = _bounds(q.astype(np.float64, copy=False), tree["centre"], tree["radius"])
    leaves = np.flatnonzero(tree["kids"][:, 0] < 0)
    leaves = leaves[tree["range"][leaves, 0].argsort()]
    starts, near = tree["range"][leaves, 0], bounds[:, leaves]
    best = np.full((len(q), k), LEAST)
    kth = floor.copy()
    found: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
    stack = [0]
    while stack:
        node = stack.pop()
        active = np.flatnonzero(bounds[:, node] >= kth)
        if not len(active):
            continue
        left, right = tree["kids"][node]
        a, z = tree["range"][node]
        if left >= 0:
            # a small node most of whose leaves would be met is met at once
            below = slice(*np.searchsorted(starts, (a, z)))
            if z - a > DENSE or (near[active, below] >= kth[active][:, None]).mean() < 0.5:
                first, last = (left, right) if bounds[active, left].sum() >= bounds[active, right].sum() else (right, left)
                stack += [last, first]
                continue
        scores = _products(q[active], tree["v"][a:z])
        row, at = np.nonzero(scores >= kth[active].astype(scores.dtype)[:, None])
        same = query_rows[active[row]] == tree["rows"][a + at]
        scores[row[same], at[same]] = LEAST
        some = np.unique(row)
        if not len(some):
            continue
        now = scores[some]
        now = np.partition(now, -k, axis=1)[:, -k:] if now.shape[1] > k else now
        merged = np.partition(np.concatenate([best[active[some]], now.astype(np.int64)], axis=1), -k, axis=1)[:, -k:]
        best[active[some]] = merged
        kth[active[some]] = np.maximum(kth[active[some]], merged.min(axis=1))
        score = scores[row, at].astype(np.int64)
        keep = ~same & (score >= kth[active[row]])
        found.append((active[row[keep]], a + at[keep], score[keep]))
    if not found:
        return (np.empty(0, np.int64),) * 3
    row, at, score = (np.concatenate(x) for x in zip(*found, strict=True))
    keep = score >= kth[row]
    return _best(row[keep], at[keep], score[keep], tree["ids"][at[keep]], tree["rows"][at[keep]], k)[:3]


def _best(row: np.ndarray, at: np.ndarray, score: np.ndarray, ids: np.ndarray, rows: np.ndarray, k: int) -> tuple[np.ndarray, ...]:
    """The arguments but ``k``, cut to the k best of each query and put in order, ties to smaller ids."""
    order = np.lexsort((rows, ids, -score, row))
    ranked = row[order]
    order = order[np.arange(len(ranked)) - np.searchsorted(ranked, ranked) < k]
    return row[order], at[order], score[order], ids[order], rows[order]


def search_all(trees: list[dict[str, np.ndarray]], query_rows: np.ndarray, q: np.ndarray, floor: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(query, candidate's id, candidate's row, score): each query's k best of several trees that reach its floor."""
    held, floor = (np.empty(0, np.int64),) * 5, floor.copy()
    for tree in trees:
        row, at, score = search(tree, query_rows, q, floor, k)
        held = _best(*(np.concatenate(x) for x in zip(held, (row, at, score, tree["ids"][at], tree["rows"][at]), strict=True)), k)
        last = np.flatnonzero(np.arange(len(held[0])) - np.searchsorted(held[0], held[0]) == k - 1)
        floor[held[0][last]] = np.maximum(floor[held[0][last]], held[2][last])
    return held[0], held[3], held[4], held[2]


def centres(sample: list[np.ndarray], n: int, rounds: int = 4) -> dict[int, np.ndarray]:
    """By length of the vectors: a few centres of the sample, one for every 32 of its rows and ``CELL_ROWS`` of the ``n`` rows it stands for."""
    by: dict[int, list[np.ndarray]] = {}
    for v in sample:
        by.setdefault(len(v), []).append(v)
    out = {}
    for dim, own in by.items():
        points = np.array(own, np.float64).reshape(len(own), dim)
        found = points[: max(1, min(CENTRES, len(points) // 32, n * len(points) // len(sample) // CELL_ROWS))].copy()
        for _ in range(rounds):
            near = _nearest(points, found)
            found = np.array([points[near == c].mean(axis=0) if (near == c).any() else found[c] for c in range(len(found))]).reshape(len(found), dim)
        out[dim] = found
    return out


def _nearest(points: np.ndarray, among: np.ndarray) -> np.ndarray:
    return np.nan_to_num((among**2).sum(axis=1) - 2 * points @ among.T).argmin(axis=1)


def deal(rows: DataFrame, among: dict[int, np.ndarray]) -> DataFrame:
    """``rows`` with the cell of each: the nearest centre for its length, 0 where the sample had none."""
    shared = rows.sparkSession.sparkContext.broadcast(among)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            v, cell = b.column(2), np.zeros(len(b), np.int32)
            sizes = b.column(3).to_numpy()
            for dim in np.unique(sizes).tolist():
                if dim in shared.value:
                    at = np.flatnonzero(sizes == dim)
                    cell[at] = _nearest(_matrix(v.take(pa.array(at))), shared.value[dim])
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(cell)], names=["row", "vec_id", "v", "dim", "cell"])

    return rows.select("row", "vec_id", "v", "dim").mapInArrow(run, "row long, vec_id long, v array<double>, dim int, cell int")


def top_k(vectors: DataFrame, k: int = 20, every: int = 20, factor: int = 64, id_col: str = "vec_id", vec_col: str = "embedding") -> DataFrame:
    """``query_id, rank, vec_id, score``: of each row whose id is divisible by ``every``, the k best other rows."""
    rows = cut(scaled(vectors, factor, id_col, vec_col).withColumn("dim", F.size("v")), "vectors")
    n, widest = rows.agg(F.count(F.lit(1)), F.max("dim")).first()
    taken = max(1, min(SAMPLE, SAMPLE_BYTES // (8 * max(1, widest or 0))))
    sample = rows.select("v").orderBy(F.xxhash64("row")).limit(taken).toArrow()["v"]
    dealt = cut(deal(rows, centres([v.values.to_numpy() for v in sample], n)), "dealt")
    cell = ["dim", "cell"]
    asks = F.pmod("vec_id", F.lit(every)) == 0
    width = 8 * F.greatest(F.col("dim"), F.lit(1))
    shard_rows = F.greatest(F.lit(1), F.least(F.lit(SHARD_ROWS), F.floor(F.lit(SHARD_BYTES) / width)))
    sizes = cut(dealt.groupBy(*cell).agg(F.ceil(F.count(F.lit(1)) / shard_rows).cast("int").alias("parts"), F.ceil(F.count_if(asks) / BLOCK_ROWS).cast("int").alias("blocks")), "sizes")
    part = lambda of, salt: F.pmod(F.xxhash64("row", F.lit(salt)), F.col(of)).cast("int")
    shard = [*cell, "part"]

    def plant(key: tuple, table: pa.Table) -> pa.Table:
        v = _matrix(table["v"])
        tree = build(table["row"].to_numpy(), table["vec_id"].to_numpy(), v)
        fields = [pa.array([x.as_py()], pa.int32()) for x in key]
        return pa.Table.from_arrays([*fields, pa.array([_pack(**tree | {"v": _small(tree["v"])})], pa.binary()), pa.array([_pack(centre=tree["centre"][0], radius=tree["radius"][0])], pa.binary())], names=[*shard, "tree", "ball"])

    def gather(key: tuple, table: pa.Table) -> pa.Table:
        fields = [pa.array([x.as_py()], pa.int32()) for x in key]
        raw = _pack(rows=table["row"].to_numpy(), ids=table["vec_id"].to_numpy(), q=_small(_matrix(table["v"])))
        return pa.Table.from_arrays([*fields, pa.array([raw], pa.binary())], names=[*cell, "block", "block_of"])

    joined = dealt.join(sizes, cell)
    trees = cut(joined.withColumn("part", part("parts", "shard")).groupBy(*shard).applyInArrow(plant, "dim int, cell int, part int, tree binary, ball binary"), "trees")
    packed = cut(joined.where(asks).withColumn("block", part("blocks", "block")).groupBy(*cell, "block").applyInArrow(gather, "dim int, cell int, block int, block_of binary"), "blocks")
    # at most CENTRES cells for a length; the ball of a cell is that of its first shard, widened to hold those of the others
    shards_of = F.greatest(F.lit(1), F.least(F.lit(BUNDLE), F.floor(F.lit(BUNDLE_BYTES) / (shard_rows * width))))
    trees = trees.withColumn("bundle", F.floor(F.col("part") / shards_of).cast("int"))
    balls = trees.groupBy(*cell).agg(F.min_by("ball", "part").alias("ball"), F.max("bundle").alias("bundles"))
    wide = cut(_widened(trees, balls), "balls")
    bundles, most = wide.agg(F.sum(F.col("bundles") + 1), F.max("bundles")).first()
    lanes = -(-LANES // (bundles or LANES))  # copies of a bundle's trees, among which its blocks are dealt, while bundles are few
    tasks = 2 * max(LANES, bundles or 0)
    wide = wide.groupBy("dim").agg(F.collect_list(F.struct("cell", "bundles", "ball")).alias("cells"))

    def visit(floors: DataFrame | None, turn: int) -> DataFrame:
        """The hits of one round: of the first bundle of each block's best cell, of that cell's others, or of all other cells."""
        at = packed.withColumnRenamed("cell", "home").join(wide, "dim")
        if floors is not None:
            at = at.join(floors, ["dim", "home", "block"], "left")
        else:
            at = at.withColumn("floors", F.lit(None).cast("array<struct<query_row: bigint, floor: bigint>>"))

        def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for b in batches:
                for dim, home, block, raw, cells, known in zip(*(c.to_pylist() for c in b.columns), strict=True):
                    asked = _unpack(raw)
                    floor = np.full(len(asked["rows"]), LEAST)
                    if known:
                        low = {x["query_row"]: x["floor"] for x in known}
                        floor = np.array([low.get(r, LEAST) for r in asked["rows"].tolist()])
                    found = [_unpack(c["ball"]) for c in cells]
                    bounds = _bounds(asked["q"].astype(np.float64), np.array([f["centre"] for f in found]), np.array([f["radius"] for f in found]))
                    best = int(bounds.sum(axis=0).argmax())
                    for i, c in enumerate(cells):
                        if (i == best) != (turn < 2):
                            continue
                        mine = bounds[:, i] >= floor
                        if not mine.any():
                            continue
                        its = range(c["bundles"] + 1) if turn == 2 else range(1) if turn == 0 else range(1, c["bundles"] + 1)
                        own = _pack(rows=asked["rows"][mine], ids=asked["ids"][mine], q=asked["q"][mine], floor=floor[mine])
                        for x in its:
                            fields = (dim, c["cell"], x, (31 * home + block) % lanes, None, home, block)
                            yield pa.RecordBatch.from_arrays([*(pa.array([f], pa.int32()) for f in fields), pa.array([own], pa.binary())], names=[*bundle, "part", "home", "block", "body"])

        def meet(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            """Of each bundle the trees come first, then the blocks."""
            here, held = None, []
            for b in batches:
                for i in range(len(b)):
                    *key, part, home, block, raw = (c[i].as_py() for c in b.columns)
                    if key != here:
                        here, held = key, []
                    if part is not None:
                        held.append(raw)
                        continue
                    held = [_ready(t) if isinstance(t, bytes) else t for t in held]  # only of bundles that are asked
                    found = _unpack(raw)
                    row, vec_id, at, score = search_all(held, found["rows"], _floats(found["q"]), found["floor"], k)
                    same = [pa.array(np.full(len(row), x, np.int32)) for x in (key[0], home, block)]
                    yield pa.RecordBatch.from_arrays([*same, *map(pa.array, (found["rows"][row], found["ids"][row], at, vec_id, score))], names=[*kinds])

        bundle = [*cell, "bundle", "lane"]
        kinds = {"dim": "int", "home": "int", "block": "int", "query_row": "long", "query_id": "long", "row": "long", "vec_id": "long", "score": "long"}
        asked = at.select("dim", "home", "block", "block_of", "cells", "floors").mapInArrow(send, "dim int, cell int, bundle int, lane int, part int, home int, block int, body binary")
        none = F.lit(None).cast("int")
        planted = trees.withColumn("lane", F.explode(F.sequence(F.lit(0), F.lit(lanes - 1)))).select(*bundle, "part", none.alias("home"), none.alias("block"), F.col("tree").alias("body"))
        met = planted.unionByName(asked).repartition(tasks, *bundle).sortWithinPartitions(*bundle, F.col("part").asc_nulls_last(), "home", "block")
        return cut(met.mapInArrow(meet, ", ".join(f"{c} {t}" for c, t in kinds.items())), "hits")

    best = Window.partitionBy("query_row").orderBy(F.desc("score"), "vec_id", "row")
    hits = None
    for turn in (0, 1, 2) if most else (0, 2):
        floors = None
        if hits is not None:
            kth = hits.withColumn("rank", F.row_number().over(best)).where(F.col("rank") == k)
            floors = kth.groupBy("dim", "home", "block").agg(F.collect_list(F.struct("query_row", F.col("score").alias("floor"))).alias("floors"))
        more = visit(floors, turn)
        hits = more if hits is None else hits.unionByName(more)
    drop(dealt)
    return hits.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def _widened(trees: DataFrame, balls: DataFrame) -> DataFrame:
    """``dim, cell, bundles, ball``: one ball around those of all shards of a cell, about the first shard's centre."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            reach = []
            for first, own in zip(b.column(2).to_pylist(), b.column(3).to_pylist(), strict=True):
                f, o = _unpack(first), _unpack(own)
                reach.append(float(np.sqrt(((f["centre"] - o["centre"]) ** 2).sum()) * (1 + 1e-9) + o["radius"]))
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(reach, pa.float64())], names=["dim", "cell", "reach"])

    pairs = trees.select("dim", "cell", "ball").join(balls.select("dim", "cell", F.col("ball").alias("first")), ["dim", "cell"])
    reach = pairs.select("dim", "cell", "first", "ball").mapInArrow(run, "dim int, cell int, reach double").groupBy("dim", "cell").agg(F.max("reach").alias("reach"))

    def put(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            made = [_pack(centre=_unpack(raw)["centre"], radius=np.array(r)) for raw, r in zip(b.column(3).to_pylist(), b.column(4).to_pylist(), strict=True)]
            yield pa.RecordBatch.from_arrays([*b.columns[:3], pa.array(made, pa.binary())], names=["dim", "cell", "bundles", "ball"])

    return balls.join(reach, ["dim", "cell"]).select("dim", "cell", "bundles", "ball", "reach").mapInArrow(put, "dim int, cell int, bundles int, ball binary")


def _floats(v: np.ndarray) -> np.ndarray:
    """Whole components as the floats in which products among their like are made."""
    v = v.astype(np.float64)
    return v.astype(np.float32) if float(np.abs(v).max(initial=0)) ** 2 * max(1, v.shape[1]) < 2**24 else v


def _ready(raw: bytes) -> dict[str, np.ndarray]:
    tree = _unpack(raw)
    return tree | {"v": _floats(tree["v"])}


def _matrix(column: pa.ChunkedArray | pa.Array) -> np.ndarray:
    chunks = column.chunks if isinstance(column, pa.ChunkedArray) else [column]
    flat = np.concatenate([np.asarray(c.flatten()) for c in chunks]) if chunks else np.empty(0)
    return flat.astype(np.float64).reshape(len(column), -1)
