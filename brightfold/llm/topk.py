"""Exact top-k inner products by best-first search in a paged M-tree.

Metric. All vectors get one more coordinate, sqrt(M - |x|^2) with M the largest squared
norm, and queries get 0 there. All then lie on one sphere, so the Euclidean distance
orders candidates as the inner product does (d^2 = |q|^2 + M - 2 s), and bounds on
distances are bounds on scores. Scores themselves are whole numbers, computed exactly.

Tree. Routing objects of the root's entries are rows of a bounded, hashed sample; every
vector goes to the nearest one, and covering radii are measured over all rows. An entry
with many rows is split into nodes by a hash of the id, so equal vectors, however many,
fill nodes of one size. A node is one row: pages with a routing object, covering radius
and distance to the parent's object, and members with their distance to the page's.

Search. Each query first looks into one node of its best entry, which bounds its k-th
score; then into the nodes of every entry whose bound can still reach that. Inside a
node pages wait in a heap by lower bound. |d(q, parent) - d(page, parent)| - radius rules
a page out before its distance is computed, and |d(q, page) - d(x, page)| a member.
Queries travel in blocks to nodes; nothing but the routing objects is broadcast.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator
from math import sqrt

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window, functions as F

from brightfold.llm.common import written

SAMPLE = 4096
ENTRIES = 256
NODE_ROWS = 2048
PAGES = 24
QUERY_BLOCK = 256
#: Room for rounding in bounds, in squared distance, relative to the largest one.
SLACK = 1e-9

NODE = "entry int, part int, ids binary, vectors binary, member binary, page_at binary, page_vec binary, page_radius binary, page_parent binary, parent_vec binary"


def integers(df: DataFrame, id_col: str, vector_col: str, scale: int) -> DataFrame:
    """(id, v): floor(scale * x) of every component; rows with a null id, vector, or component, or one not finite, go.

    A scaled component outside 64 bits is an error.
    """
    x = F.col(vector_col)
    finite = F.forall(x, lambda e: F.coalesce(~F.isnan(e) & (F.abs(e) < F.lit(float("inf"))), F.lit(False)))
    scaled = lambda e: F.floor(F.when(
        F.abs(F.lit(scale) * e.cast("double")) < F.lit(2.0**63), F.lit(scale) * e.cast("double")
    ).otherwise(F.raise_error(F.lit("a scaled component leaves 64 bits")).cast("double")))
    return df.where(F.col(id_col).isNotNull() & x.isNotNull() & finite).select(
        F.col(id_col).cast("long").alias("id"),
        F.transform(x, scaled).cast("array<long>").alias("v")).distinct()


def _matrix(vectors, width: int, exact: bool) -> np.ndarray:
    """Rows padded with zeros; doubles if every product is exact in them, else Python integers."""
    out = np.zeros((len(vectors), width), np.float64 if exact else object)
    for i, v in enumerate(vectors):
        out[i, : len(v)] = v
    return out


def _lifted(rows: np.ndarray, largest: int) -> np.ndarray:
    rows = rows.astype(np.float64)
    return np.column_stack([rows, np.sqrt(np.maximum(largest - (rows**2).sum(axis=1), 0))])


def _distances(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return np.sqrt(np.maximum((a**2).sum(axis=1)[:, None] + (b**2).sum(axis=1)[None] - 2 * a @ b.T, 0))


def _routing(points: np.ndarray, count: int) -> np.ndarray:
    """Indices of about `count` spread objects: rows nearest to the means of a few Lloyd steps."""
    at = np.unique(np.linspace(0, len(points) - 1, min(count, len(points))).astype(int))
    centres = points[at]
    for _ in range(4):
        near = _distances(points, centres).argmin(axis=1)
        size = np.bincount(near, minlength=len(centres))
        total = np.zeros_like(centres)
        np.add.at(total, near, points)
        centres = np.where(size[:, None] > 0, total / np.maximum(size, 1)[:, None], centres)
    return np.unique(_distances(points, centres).argmin(axis=0))


def _node(largest: int, width: int, entries):
    def of(frame: pd.DataFrame) -> pd.DataFrame:
        vectors = np.stack([np.frombuffer(v, np.int64) for v in frame["v"]])
        ids = frame["id"].to_numpy(np.int64)
        points = _lifted(vectors, largest)
        objects = points[_routing(points, PAGES)]
        distance = _distances(points, objects)
        page = distance.argmin(axis=1)
        own = distance[np.arange(len(page)), page]
        by = np.lexsort((ids, own, page))
        used, first = np.unique(page[by], return_index=True)
        parent = entries.value[int(frame["entry"].iloc[0])]
        return pd.DataFrame([{
            "entry": frame["entry"].iloc[0], "part": frame["part"].iloc[0], "ids": ids[by].tobytes(),
            "vectors": vectors[by].tobytes(), "member": own[by].tobytes(), "page_at": np.append(first, len(by)).astype(np.int64).tobytes(),
            "page_vec": objects[used].tobytes(), "page_radius": np.maximum.reduceat(own[by], first).tobytes(),
            "page_parent": _distances(objects[used], parent[None])[:, 0].tobytes(), "parent_vec": parent.tobytes(),
        }])

    return of


def search(node: dict, query: np.ndarray, query_id: int, k: int, floor_score, largest: int, exact: bool):
    """Best-first search of one node: [(score, -id)], the k best of at least floor_score (None: no floor)."""
    width = len(query)
    lifted = np.append(query.astype(np.float64), 0.0)
    norm = float(lifted @ lifted)
    room = SLACK * (norm + largest) + 1e-6
    reach = lambda s: sqrt(max(norm + largest - 2 * s, 0) + room) + 1e-6
    ids, member, at = node["ids"], node["member"], node["page_at"]
    tau = reach(floor_score) if floor_score is not None else float("inf")
    to_parent = float(np.linalg.norm(lifted - node["parent_vec"]))
    heap = [(max(0.0, abs(to_parent - p) - r), i, False)
            for i, (p, r) in enumerate(zip(node["page_parent"].tolist(), node["page_radius"].tolist()))]
    heapq.heapify(heap)
    best: list[tuple[int, int]] = []
    while heap:
        bound, i, known = heapq.heappop(heap)
        if bound > tau:
            break
        distance = float(np.linalg.norm(lifted - node["page_vec"][i]))
        if not known:
            bound = max(0.0, distance - float(node["page_radius"][i]))
            if heap and bound > heap[0][0]:
                heapq.heappush(heap, (bound, i, True))
                continue
            if bound > tau:
                continue
        rows = np.arange(at[i], at[i + 1])
        rows = rows[(np.abs(distance - member[rows]) <= tau) & (ids[rows] != query_id)]
        if not len(rows):
            continue
        vectors = node["vectors"][rows]
        score = (vectors.astype(np.float64) if exact else vectors.astype(object)) @ query
        for s, j in zip(score.tolist(), ids[rows].tolist()):
            s = int(s)
            if not -(1 << 63) <= s < 1 << 63:
                raise OverflowError("a score leaves 64 bits")
            if floor_score is not None and s < floor_score:
                continue
            if len(best) < k:
                heapq.heappush(best, (s, -j))
            elif (s, -j) > best[0]:
                heapq.heapreplace(best, (s, -j))
        if len(best) == k:
            tau = min(tau, reach(best[0][0]))
    return best


def _visit(k: int, largest: int, width: int, exact: bool):
    def of(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            out = []
            for r in frame.to_dict("records"):
                read = lambda name, kind: np.frombuffer(r[name], kind)  # noqa: B023, E731
                node = {"ids": read("ids", np.int64), "vectors": read("vectors", np.int64).reshape(-1, width),
                        "page_vec": read("page_vec", np.float64).reshape(-1, width + 1), "page_at": read("page_at", np.int64)}
                node |= {c: read(c, np.float64) for c in ("member", "page_radius", "page_parent", "parent_vec")}
                for q in r["queries"]:
                    query = np.frombuffer(q["v"], np.int64)
                    vector = query.astype(np.float64) if exact else query.astype(object)
                    floor_score = None if q["least"] is None or pd.isna(q["least"]) else int(q["least"])
                    out += [(q["key"], q["id"], -j, s) for s, j in
                            search(node, vector, q["id"], k, floor_score, largest, exact)]
            yield pd.DataFrame(out, columns=["key", "query_id", "vec_id", "score"]).astype("int64")

    return of


def top_k(vectors: DataFrame, k: int = 10, scale: int = 1024, every: int = 100, id_col: str = "vec_id",
          vector_col: str = "embedding") -> DataFrame:
    """Each query's k highest integer inner products: query_id, rank, vec_id, score.

    Queries are rows whose id is divisible by `every`, candidates all rows of another id; ties
    go to the smaller id. Rows alike in id and integers count once; of rows that share an id
    but not the vector each is a query and a candidate of its own. Shorter vectors are padded
    with zeros. Null ids take no part. Scores outside 64 bits are an error. Other columns
    are ignored.
    """
    spark = vectors.sparkSession
    rows = written(integers(vectors, id_col, vector_col, scale), "op1-integers")
    double = F.aggregate("v", F.lit(0.0), lambda a, x: a + x.cast("double") * x.cast("double"))
    width, largest_d, count = rows.agg(F.max(F.size("v")), F.max(double), F.count("*")).first()
    empty = spark.createDataFrame([], "query_id long, rank int, vec_id long, score long")
    if not count:
        return empty
    width = max(1, width)
    exact = largest_d < 2.0**52
    largest = int(largest_d) if exact else int(largest_d * (1 + 1e-12)) + 1
    sample = [r["v"] for r in rows.orderBy(F.xxhash64("id"), "id", "v").limit(SAMPLE).toLocalIterator()]
    points = _lifted(_matrix(sample, width, exact), largest)
    objects = points[_routing(points, max(1, min(ENTRIES, count // NODE_ROWS + 1)))]
    sent = spark.sparkContext.broadcast(objects)

    def assign(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for f in frames:
            m = np.zeros((len(f), width), np.int64)
            for i, v in enumerate(f["v"]):
                m[i, : len(v)] = v
            d = _distances(_lifted(m, largest), sent.value)
            near = d.argmin(axis=1)
            yield pd.DataFrame({"id": f["id"], "v": [x.tobytes() for x in m], "entry": near.astype(np.int32),
                                "distance": d[np.arange(len(near)), near]})

    placed = written(rows.mapInPandas(assign, "id long, v binary, entry int, distance double"), "op1-placed")
    sizes = placed.groupBy("entry").agg(F.max("distance").alias("radius"), F.count("*").alias("n"))
    entries = {r["entry"]: (r["radius"], r["n"]) for r in sizes.collect()}  # ENTRIES rows at most
    parts = spark.createDataFrame([(e, n // NODE_ROWS + 1) for e, (_, n) in entries.items()], "entry int, parts long")
    nodes = written(
        placed.join(F.broadcast(parts), "entry")
        .select("entry", F.pmod(F.xxhash64("id", "v"), "parts").cast("int").alias("part"), "id", "v")
        .groupBy("entry", "part").applyInPandas(_node(largest, width, sent), NODE), "op1-nodes")
    queries = placed.where(F.pmod("id", F.lit(every)) == 0).select(F.xxhash64("id", "v").alias("key"), "id", "v")
    reach = spark.sparkContext.broadcast({e: r for e, (r, _) in entries.items()})

    def route(first: bool):
        def of(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            names = np.array(sorted(reach.value))
            radius = np.array([reach.value[e] for e in names])
            for f in frames:
                if not len(f):
                    continue
                m = np.stack([np.frombuffer(v, np.int64) for v in f["v"]]).astype(np.float64)
                lifted = np.column_stack([m, np.zeros(len(m))])
                norm = (lifted**2).sum(axis=1)
                near = np.maximum(_distances(lifted, sent.value[names]) - radius, 0)
                d = _distances(lifted, sent.value[names])
                best = np.lexsort((d, near), axis=1)[:, 0]
                if first:
                    yield f.assign(entry=names[best].astype(np.int32), least=pd.array([None] * len(f), "Int64"), skip=False)
                    continue
                most = (norm[:, None] + largest - near**2) / 2
                room = SLACK * (norm + largest) + 1
                least = f["least"].astype("float64").fillna(-np.inf).to_numpy()
                q, e = np.nonzero(most >= (least - room)[:, None])
                out = f.iloc[q].copy()
                out["entry"], out["skip"] = names[e].astype(np.int32), e == best[q]
                yield out[["key", "id", "v", "entry", "least", "skip"]]

        return of

    routed_schema = "key long, id long, v binary, entry int, least long, skip boolean"
    blocks = max(1, count // every // QUERY_BLOCK + 1)

    def visited(routed: DataFrame, which) -> DataFrame:
        asked = routed.join(nodes.select("entry", "part"), "entry").where(which).groupBy(
            "entry", "part", F.pmod("key", F.lit(blocks)).alias("block")).agg(F.collect_list(F.struct("key", "id", "v", "least")).alias("queries"))
        return asked.drop("block").join(nodes, ["entry", "part"]).mapInPandas(
            _visit(k, largest, width, exact), "key long, query_id long, vec_id long, score long")

    start = written(visited(queries.mapInPandas(route(True), routed_schema), F.col("part") == 0), "op1-start")
    bound = start.groupBy("key").agg(F.count("*").alias("n"), F.min("score").alias("low")).select(
        "key", F.when(F.col("n") >= k, F.col("low")).alias("least"))
    again = queries.join(bound, "key", "left").select("key", "id", "v", "least").mapInPandas(route(False), routed_schema)
    more = visited(again, ~(F.col("skip") & (F.col("part") == 0)))
    order = Window.partitionBy("key").orderBy(F.desc("score"), "vec_id")
    return start.unionByName(more).withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select(
        "query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")
