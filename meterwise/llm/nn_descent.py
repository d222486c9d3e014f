"""Near-duplicate vectors by NN-descent.

Equal directions are first made one class.  A graph holds each class's K nearest
known neighbours.  It starts from exact neighbours inside blocks of vectors on
the same side of random hyperplanes, and is refined by NN-descent: at every node
the vectors of its neighbours (of both directions) are brought together and
compared with each other, and what is nearer than the farthest neighbour known
goes into the lists.  Rounds go on until few lists change.

Pairs at or above the threshold link.  A list full of links is saturated and may
have pushed out others, so it is enlarged for further links, up to ``MOST``.  Of all pairs ever compared, in a block or
at a node, those that connect what links there are kept beside the lists, and make
components.  Vectors whose largest list is still saturated are searched again, now
for neighbours outside their component (with those inside to lead there), until no
new link appears.  Each component is
compared in tiles, so that links are counted in full without a row per pair.  At
last a sample of vectors, drawn until enough of them have links, is compared with
all to audit the recall; below the target, twice as many tables of blocks are drawn
and all vectors are searched so, and if that never reaches it, it is an error.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from meterwise.llm.common import components, cut, written

THRESHOLD = 0.95
#: Neighbours kept per vector, brought together at a node in one round, and kept where all are links;
#: links that the largest list has no room for are searched by component.
K, JOINED, MOST = 10, 16, 40
#: Random tables of blocks per search at least, and at a time; and rows of a block or tile.
TABLES, BLOCK = 4, 512
#: Rounds of a search at most, and the share of changed neighbours below which it ends.
ROUNDS, STILL = 3, 0.01
#: An audit compares so many vectors at a time with all, until so many had links, or else all of a
#: table of so many vectors, or one in a hundred of a larger one.
AUDITED, LINKED, WHOLE = 2048, 256, 65536
#: The recall that an audit asks for, and audits at most; each search after one has twice the tables of the last.
TARGET, AUDITS = 0.98, 4
#: Single precision in the search errs by less than this.
MARGIN = 1e-4


def _unit(embedding: Column) -> Column:
    """The vector scaled to length 1 in double precision; null where it has no direction."""
    @F.pandas_udf("array<double>")
    def unit(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for batch in batches:
            out = []
            for value in batch:
                x = np.asarray(() if value is None else value, np.float64)  # null components become NaN
                if len(x) and np.isfinite(x).all() and x.any():
                    x = x / np.abs(x).max()
                    out.append(x / np.sqrt(x @ x) + 0.0)
                else:
                    out.append(None)
            yield pd.Series(out, dtype=object)

    return unit(embedding)


def _vectors(column: pd.Series, kind: type = np.float32) -> np.ndarray:
    return np.frombuffer(b"".join(column), kind).reshape(len(column), -1)


def _top(edges: DataFrame, k: int, threshold: float, most: int = 0) -> DataFrame:
    """The ``k`` nearest distinct neighbours (v, sim, fresh) per u, of its own component and of others; to ``most`` where all are links."""
    best = edges.groupBy("u", "v", "own").agg(F.max("sim").alias("sim"), F.min("fresh").alias("fresh"))
    order = Window.partitionBy("u", "own").orderBy(F.desc("sim"), "v")
    # In this order only links stand before a link: one beyond ``k`` means that the list is full of them.
    more = (F.col("rank") <= most) & (F.col("sim") >= threshold - MARGIN)
    return best.withColumn("rank", F.row_number().over(order)).where((F.col("rank") <= k) | more)


def _links(sim: np.ndarray, threshold: float) -> tuple[np.ndarray, np.ndarray]:
    """Pairs (i, j) that connect all that ``sim`` connects.

    A spanning forest of the pairs surely above the threshold, so that a group
    costs no pair per pair, and what lies within the margin between its trees.
    """
    if sim.max(initial=-2) < threshold - MARGIN:
        return np.zeros(0, int), np.zeros(0, int)
    near, tree = sim >= threshold + MARGIN, np.arange(len(sim))
    left, i, j = np.ones(len(sim), bool), [], []
    for root in np.flatnonzero(near.any(axis=1)):
        todo = [root] if left[root] else []
        left[root] = False
        while todo:
            at = todo.pop()
            reached = np.flatnonzero(near[at] & left)
            left[reached] = False
            tree[reached] = root
            i += [at] * len(reached)
            j += reached.tolist()
            todo += reached.tolist()
    p, q = np.nonzero(np.triu((sim >= threshold - MARGIN) & (tree[:, None] != tree[None, :]), 1))
    return np.concatenate([np.array(i, int), p]), np.concatenate([np.array(j, int), q])


def _rows(ids: np.ndarray, sim: np.ndarray, i: np.ndarray, j: np.ndarray, link: bool) -> pd.DataFrame:
    return pd.DataFrame({"u": ids[i], "v": ids[j], "sim": sim[i, j].astype(float), "link": link})


def _bits(count: int) -> int:
    return max(0, math.ceil(math.log2(max(1, count / BLOCK))) + 1)


def _tables(count: int, threshold: float) -> int:
    """Tables in which a pair at the threshold lies on the same sides once with probability TARGET at least."""
    together = (1 - math.acos(max(-1.0, min(1.0, threshold))) / math.pi) ** _bits(count)
    return TABLES if together >= 1 else max(TABLES, math.ceil(math.log(1 - TARGET) / math.log1p(-together)))


def _blocks(nodes: DataFrame, count: int, seed: int, tables: range, threshold: float) -> DataFrame:
    """Pairs (u, v, sim, link) of different components, in blocks of vectors that lie on the same sides of random hyperplanes.

    Without ``link``: to the nearest of each vector; with it: what connects all that is near in the block.
    """
    bits = _bits(count)

    def sides(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for dim, part in batch.groupby("dim"):
                x = _vectors(part["vec"])
                for t in tables:
                    planes = np.random.default_rng([seed, t, dim]).standard_normal((dim, bits))
                    side = (x @ planes > 0) @ (1 << np.arange(bits, dtype=np.int64)) if bits else np.zeros(len(x), np.int64)
                    yield part.assign(table=t, side=side)

    def nearest(block: pd.DataFrame) -> pd.DataFrame:
        x, ids, of = _vectors(block["vec"]), block["id"].to_numpy(), block["component"].to_numpy()
        sim = x @ x.T
        sim[of[:, None] == of[None, :]] = -2
        k = min(K, len(ids) - 1)
        at = np.argpartition(-sim, k - 1, axis=1)[:, :k] if k else np.zeros((len(ids), 0), int)
        i, j = np.repeat(np.arange(len(ids)), k), at.ravel()
        other = of[i] != of[j]
        return pd.concat([_rows(ids, sim, i[other], j[other], False), _rows(ids, sim, *_links(sim, threshold), True)])

    placed = nodes.select("id", "component", "dim", "vec").mapInPandas(sides, "id long, component long, dim int, vec binary, table int, side long")
    # A side that many vectors share is cut into blocks; what that parts is found by the descent.
    order = Window.partitionBy("dim", "table", "side").orderBy(F.xxhash64("id", F.lit(seed)), "id")
    return (placed.withColumn("block", F.floor((F.row_number().over(order) - 1) / F.lit(BLOCK)))
            .groupBy("dim", "table", "side", "block").applyInPandas(nearest, "u long, v long, sim double, link boolean"))


def _descend(graph: DataFrame, nodes: DataFrame, threshold: float) -> DataFrame:
    """New pairs (u, v, sim, link) of different components: neighbours of a node compared with each other, where one of the two is new there."""
    both = (graph.select("u", "v", "sim", "own", "fresh")
            .unionByName(graph.select(F.col("v").alias("u"), F.col("u").alias("v"), "sim", "own", "fresh")))
    met = _top(both, JOINED, threshold)
    # What a list still takes: anything while it is short, links while it can be enlarged, else what is nearer than its last.
    size, low = F.count("*"), F.min("sim")
    last = (graph.where("not own").groupBy("u")
            .agg(F.when(size >= MOST, low).when(size >= K, F.least(low, F.lit(threshold - MARGIN))).alias("last")))
    info = (nodes.join(last, nodes["id"] == last["u"], "left")
            .select(F.col("id").alias("v"), "component", "vec", F.coalesce("last", F.lit(-2.0)).alias("last")))
    gathered = (met.join(info, "v").groupBy("u")
                .agg(F.collect_list(F.struct("v", "component", "vec", "last", "fresh")).alias("near")).select("near"))

    def compare(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            out = []
            for near in batch["near"]:
                x = _vectors([n["vec"] for n in near])
                ids = np.array([n["v"] for n in near])
                of = np.array([n["component"] for n in near])
                low = np.array([n["last"] for n in near])
                new = np.array([n["fresh"] for n in near])
                sim = np.where((of[:, None] != of[None, :]) & (new[:, None] | new[None, :]), x @ x.T, -2)
                i, j = np.nonzero(np.triu(sim > np.maximum(np.minimum(low[:, None], low[None, :]), -1.5), 1))
                p, q = _links(sim, threshold)
                link = np.repeat([False, True], [len(i), len(p)])
                i, j = np.concatenate([i, p]), np.concatenate([j, q])
                out.append((ids[i], ids[j], sim[i, j], link))
            if out:
                u, v, s, link = map(np.concatenate, zip(*out))
                yield pd.DataFrame({"u": u, "v": v, "sim": s.astype(float), "link": link})

    return gathered.mapInPandas(compare, "u long, v long, sim double, link boolean")


def _search(nodes: DataFrame, count: int, seed: int, known: DataFrame | None, tables: int, threshold: float) -> tuple[DataFrame, DataFrame]:
    """The neighbour graph (u, v, sim, own, fresh, rank) after blocks and rounds of descent, and the pairs (u, v, sim) that link on the way.

    Pairs of one component (of ``nodes``) are not looked for; ``known`` ones (u, v, sim, own) lead to its neighbours.
    """
    graph = links = None
    for t in range(0, tables, TABLES):  # a few at a time: each holds all vectors once
        found = written(_blocks(nodes, count, seed, range(t, min(t + TABLES, tables)), threshold), "blocks")
        links = found.where("link") if links is None else links.unionByName(found.where("link"))
        start = found.where("not link").select("u", "v", "sim", F.lit(False).alias("own"), F.lit(True).alias("fresh"))
        if graph is not None:
            start = start.unionByName(graph.select("u", "v", "sim", "own", "fresh"))
        elif known is not None:
            start = start.unionByName(known.select("u", "v", "sim", "own", F.lit(False).alias("fresh")))
        graph = written(_top(start, K, threshold, MOST), "neighbours")
    for _ in range(ROUNDS):
        found = written(_descend(graph, nodes, threshold), "compared")
        links = links.unionByName(found.where("link"))
        both = F.array(F.struct("u", "v", "sim"), F.struct(F.col("v").alias("u"), F.col("u").alias("v"), "sim"))
        added = (found.where("not link").select(F.explode(both).alias("e")).select("e.*")
                 .withColumns({"own": F.lit(False), "fresh": F.lit(True)}))
        graph = written(_top(graph.select("u", "v", "sim", "own", F.lit(False).alias("fresh")).unionByName(added), K, threshold, MOST), "neighbours")
        if graph.where("fresh").count() <= STILL * K * count:
            break
    return graph, links.select("u", "v", "sim")


def _double(edges: DataFrame, reps: DataFrame, threshold: float) -> DataFrame:
    """Edges (u < v) whose cosine in double precision reaches the threshold; what is above the margin need not be computed again."""
    unit = reps.select("id", "unit")
    pairs = (edges.where(F.col("sim") >= threshold - MARGIN).groupBy(F.least("u", "v").alias("u"), F.greatest("u", "v").alias("v"))
             .agg(F.max("sim").alias("sim")))
    sure = F.col("sim") >= threshold + MARGIN
    near = pairs.where(~sure).join(unit.toDF("u", "x"), "u").join(unit.toDF("v", "y"), "v")
    cosine = F.aggregate(F.zip_with("x", "y", lambda a, b: a * b), F.lit(0.0), lambda s, a: s + a)
    return pairs.where(sure).select("u", "v").unionByName(near.where(cosine >= threshold).select("u", "v"))


def _placed(reps: DataFrame, label: DataFrame | None) -> DataFrame:
    """(id, component, dim, vec); what has no link is a component of its own."""
    if label is None:
        return reps.select("id", F.col("id").alias("component"), "dim", "vec")
    return written(reps.join(label, "id", "left").select("id", F.coalesce("component", "id").alias("component"), "dim", "vec"), "placed")


def _marked(graph: DataFrame, nodes: DataFrame) -> DataFrame:
    """The pairs of the graph between ``nodes``, and whether their components are one."""
    of = nodes.select("id", "component")
    return (graph.select("u", "v", "sim").join(of.toDF("u", "cu"), "u").join(of.toDF("v", "cv"), "v")
            .select("u", "v", "sim", (F.col("cu") == F.col("cv")).alias("own")))


def _saturated(graph: DataFrame, placed: DataFrame, threshold: float) -> tuple[DataFrame, int]:
    """Vectors whose largest list is full of links, so that more may have been pushed out, and how many; none if they are of one component."""
    full = graph.where(F.col("sim") >= threshold - MARGIN).groupBy(F.col("u").alias("id")).count().where(F.col("count") >= MOST)
    nodes = placed.join(full, "id", "left_semi")
    n, first, last = nodes.agg(F.count("*"), F.min("component"), F.max("component")).first()
    return nodes, n if first != last else 0


def _component_links(reps: DataFrame, label: DataFrame, threshold: float) -> DataFrame:
    """(id, near): how many vectors of its component link with each class, all compared in tiles."""
    order = Window.partitionBy("component").orderBy("id")
    member = (reps.join(label, "id").withColumn("n", F.row_number().over(order) - 1)
              .withColumn("block", F.floor(F.col("n") / F.lit(BLOCK)).cast("int")).select("component", "id", "block", "unit", "copies"))
    size = member.groupBy("component").agg((F.max("block") + 1).alias("blocks"))
    tiles = (member.join(size, "component")
             .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
             .select("component", F.least("block", "other").alias("i"), F.greatest("block", "other").alias("j"), "block", "id", "unit", "copies"))

    def count(tile: pd.DataFrame) -> pd.DataFrame:
        i, j = tile["i"].iloc[0], tile["j"].iloc[0]
        a, b = tile[tile["block"] == i], tile[tile["block"] == j]
        linked = np.stack(a["unit"].to_numpy()) @ np.stack(b["unit"].to_numpy()).T >= threshold
        if i == j:
            np.fill_diagonal(linked, False)
            return pd.DataFrame({"id": a["id"], "near": linked @ b["copies"].to_numpy()})
        return pd.DataFrame({"id": [*a["id"], *b["id"]], "near": [*(linked @ b["copies"].to_numpy()), *(a["copies"].to_numpy() @ linked)]})

    return (tiles.groupBy("component", "i", "j").applyInPandas(count, "id long, near long")
            .groupBy("id").agg(F.sum("near").alias("near")))


def _recall(placed: DataFrame, count: int, threshold: float, seed: int) -> float:
    """Share of the links of a sample of vectors, compared with all in blocks, that the components hold; 1 where none has a link.

    The sample grows until LINKED of its vectors have links, or to all vectors
    (one in a hundred where there are more than WHOLE).  The share is the smaller of
    that of all links and the mean over vectors, so that no large group hides small ones.
    """
    order = placed.withColumn("at", F.pmod(F.xxhash64("id", F.lit(seed)), F.lit(max(1, -(-count // AUDITED)))))
    links = held = linked = audited = 0
    mean, part = 0.0, 0
    while audited < count and linked < LINKED and audited * 100 < max(count, 100 * WHOLE):
        by_dim = {}
        rows = order.where(F.col("at") == part).select("id", "component", "dim", "vec").collect()
        for row in rows:
            by_dim.setdefault(row["dim"], []).append(row)

        def all_links(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            for batch in batches:
                for dim, part in batch.groupby("dim"):
                    audit = by_dim.get(dim, [])
                    if audit:
                        q, ids, of = _vectors([r["vec"] for r in audit]), np.array([r["id"] for r in audit]), np.array([r["component"] for r in audit])
                        near = (_vectors(part["vec"]) @ q.T >= threshold + MARGIN) & (part["id"].to_numpy()[:, None] != ids)
                        same = near & (part["component"].to_numpy()[:, None] == of)
                        some = near.any(axis=0)
                        yield pd.DataFrame({"id": ids[some], "n": near.sum(axis=0)[some], "same": same.sum(axis=0)[some]})

        if rows:
            n, found, of, share = (placed.select("id", "component", "dim", "vec").mapInPandas(all_links, "id long, n long, same long")
                                   .groupBy("id").agg(F.sum("n").alias("n"), F.sum("same").alias("same"))
                                   .agg(F.sum("n"), F.sum("same"), F.count("*"), F.sum(F.col("same") / F.col("n"))).first())
            links, held, linked, mean = links + (n or 0), held + (found or 0), linked + of, mean + (share or 0.0)
        audited, part = audited + len(rows), part + 1
    return min(held / links, mean / linked) if linked else 1.0


def near_links(vectors: DataFrame, embedding: str = "embedding", row_id: str = "vec_id", threshold: float = THRESHOLD) -> DataFrame:
    """(vec_id, n_links, component_id, kept) per row.

    Vectors that are null, empty, zero or hold null or non-finite components
    link with nothing; vectors of different length link not with each other.
    Equal directions link (cosine 1) and are counted, not paired.  Each row is a
    vector of its own, also where a vec_id repeats; rows without a vec_id are
    linked, but never name a component (a component without any vec_id has none).
    A RuntimeError says that the recall asked for was not reached.
    """
    rows = written(vectors.select(F.col(row_id).alias("vec_id"), _unit(F.col(embedding)).alias("unit"))
                   .withColumn("row", F.monotonically_increasing_id())
                   .withColumns({"h": F.xxhash64("unit"), "g": F.xxhash64(F.lit(1), "unit")}), "vectors")
    classes = written(rows.where("unit is not null").groupBy("h", "g")
                      .agg(F.min("row").alias("id"), F.min("vec_id").alias("least"), F.count("*").alias("copies")), "classes")

    def single(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            yield batch.assign(dim=[len(x) for x in batch["unit"]], vec=[np.asarray(x, np.float32).tobytes() for x in batch["unit"]])

    reps = written(rows.select("row", "unit").join(classes, F.col("row") == F.col("id")).select("id", "unit", "copies")
                   .mapInPandas(single, "id long, unit array<double>, copies long, dim int, vec binary"), "representatives")
    count, graph, links, label = reps.count(), None, None, None
    nodes, n, search, audits = _placed(reps, None), count, 0, 0
    while count > 1:
        found, near = _search(nodes, n, search, None if graph is None else _marked(graph, nodes), _tables(n, threshold) << audits, threshold)
        near = cut(_double(near, reps, threshold))
        linked, search = bool(near.limit(1).count()), search + 1
        if linked:
            links = near if links is None else cut(links.unionByName(near))
            label = components(links, "u", "v")
        placed = _placed(reps, label)
        graph = found if graph is None else graph.select("u", "v", "sim").unionByName(found.select("u", "v", "sim"))
        graph = written(_top(_marked(graph, placed).withColumn("fresh", F.lit(False)), K, threshold, MOST), "neighbours")
        if linked:  # what joins components may make others meet
            nodes, n = _saturated(graph, placed, threshold)
            if n:
                continue
        recall = _recall(placed, count, threshold, search)
        if recall >= TARGET:
            break
        nodes, n, audits = placed, count, audits + 1
        if audits == AUDITS:
            raise RuntimeError(f"near duplicates: recall {recall:.3f} after {search} searches, {TARGET} asked for")
    if label is None:
        label = classes.select("id", F.col("id").alias("component")).where("false")
    near = cut(_component_links(reps, label, threshold))
    named = classes.join(label, "id", "left").withColumn("component", F.coalesce("component", "id"))
    least = named.groupBy("component").agg(F.min("least").alias("component_id"))
    known = (named.join(least, "component").join(near, "id", "left")
             .select("h", "g", (F.coalesce("near", F.lit(0)) + F.col("copies") - 1).alias("n_links"), "component_id"))
    valid = F.col("unit").isNotNull()
    return (rows.withColumns({"h": F.when(valid, F.col("h")), "g": F.when(valid, F.col("g"))}).drop("unit", "row")
            .join(known, ["h", "g"], "left")
            .select(F.col("vec_id").alias(row_id), F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
                    F.coalesce("component_id", "vec_id").alias("component_id"))
            .withColumn("kept", F.coalesce(F.col(row_id) == F.col("component_id"), F.lit(False))))
