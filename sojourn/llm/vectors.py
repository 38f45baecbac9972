"""Near-duplicate vectors by NN-descent: a neighbour graph refined by joins of neighbours' neighbours."""

from __future__ import annotations

import warnings
from collections.abc import Iterator
from itertools import count

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import arrow_map, stage
from .components import components

#: Cosine from which vectors are linked.
LINK = 0.95
#: Neighbours in a list; trees of the first graph, neighbours each gives, vectors compared at a time.
NEIGHBOURS, TREES, PER_TREE, WINDOW = 10, 10, 5, 64
#: Rounds of descent at most; share of list entries that must change for another one.
ROUNDS, CHANGE = 3, 0.02
#: Vectors of a block when a saturated list is enlarged; audited vectors of all and of the linked ones;
#: audits after which another one must be better than the last.
BLOCK, AUDITED, AUDITS = 1024, 1000, 3
#: Single precision finds candidates this far below LINK; double precision decides.
_SLACK = 1e-4


def usable() -> Column:
    """Whether ``embedding`` can be compared: no null, no infinite or undefined part, not all zero."""
    parts = F.col("embedding")
    finite = F.forall(parts, lambda x: F.coalesce(~F.isnan(x) & (F.abs(x) != float("inf")), F.lit(False)))
    return F.coalesce(finite & F.exists(parts, lambda x: x != 0), F.lit(False))


def _units(column: pa.ListArray, dtype=np.float64) -> np.ndarray:
    """Rows of unit length; all of one dimension."""
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(len(column), -1)
    flat /= np.abs(flat).max(axis=1, keepdims=True)
    return (flat / np.linalg.norm(flat, axis=1, keepdims=True)).astype(dtype)


def _groups(batches, keys: list[str], most: int | None = None) -> Iterator[pa.Table]:
    """The runs of equal keys in batches sorted by them, in pieces of at most ``most`` rows."""
    held: list[pa.RecordBatch] = []

    def out():
        table = pa.Table.from_batches(held)
        step = most or table.num_rows
        for at in range(0, table.num_rows, step):
            yield table.slice(at, step).combine_chunks()

    last = None
    for batch in batches:
        if not batch.num_rows:
            continue
        rows = np.column_stack([np.asarray(batch[k]) for k in keys])
        cuts = [0, *(np.flatnonzero((rows[1:] != rows[:-1]).any(axis=1)) + 1), batch.num_rows]
        for a, b in zip(cuts, cuts[1:]):
            key = tuple(rows[a])
            if held and key != last:
                yield from out()
                held.clear()
            held.append(batch.slice(a, b - a))
            last = key
    if held:
        yield from out()


_EDGES = "u long, v long, sim float"
_EDGE_NAMES = ["u", "v", "sim"]


def _edges(u, v, sim) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array(u), pa.array(v), pa.array(sim.astype(np.float32))], names=_EDGE_NAMES
    )


def tree_neighbours(nodes: DataFrame, trees: int, seed: int) -> DataFrame:
    """First edges: in each of some random trees, the nearest of the vectors around each one.

    A vector's place in a tree is the string of the sides of random planes it lies on. Sorted by
    it, near vectors stand together whatever the data's size; equal places are told apart by id, so
    a crowd at one place is dealt over as many tasks as it needs.
    """

    def coded(batches):
        for batch in batches:
            dims = pa.compute.list_value_length(batch["embedding"]).to_numpy(zero_copy_only=False)
            for dim in np.unique(dims):
                part = batch.filter(pa.array(dims == dim))
                units = _units(part["embedding"], np.float32)
                for tree in range(trees):
                    rng = np.random.default_rng([seed, tree, int(dim)])
                    sides = units @ rng.standard_normal((int(dim), 62)).astype(np.float32) > 0
                    code = sides.astype(np.int64) @ (np.int64(1) << np.arange(61, -1, -1, dtype=np.int64))
                    n = len(part)
                    yield pa.RecordBatch.from_arrays(
                        [
                            pa.array(np.full(n, tree, dtype=np.int32)),
                            pa.array(np.full(n, dim, dtype=np.int32)),
                            pa.array(code),
                            part["id"],
                            part["embedding"],
                        ],
                        names=["tree", "dim", "code", "id", "embedding"],
                    )

    places = arrow_map(
        nodes.select("id", F.col("embedding").cast("array<float>").alias("embedding")),
        coded,
        "tree int, dim int, code long, id long, embedding array<float>",
    )
    order = ["tree", "dim", "code", "id"]
    parts = int(nodes.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ordered = places.repartitionByRange(parts, *order).sortWithinPartitions(*order)

    def compared(batches):
        half = WINDOW // 2
        for table in _runs(batches, WINDOW * 64, half):
            ids, units = np.asarray(table["id"]), _units(table["embedding"].combine_chunks(), np.float32)
            for at in range(0, len(ids), WINDOW):
                low = max(0, at - half)
                sims = units[at : at + WINDOW] @ units[low : at + WINDOW + half].T
                rows = np.arange(len(sims))
                sims[rows, rows + at - low] = -2
                k = min(PER_TREE, sims.shape[1] - 1)
                if k < 1:
                    continue
                best = np.argpartition(-sims, k - 1, axis=1)[:, :k]
                yield _edges(
                    np.repeat(ids[at : at + WINDOW], k),
                    ids[low + best].ravel(),
                    np.take_along_axis(sims, best, axis=1).ravel(),
                )

    return arrow_map(ordered, compared, _EDGES)


def _runs(batches, rows: int, overlap: int) -> Iterator[pa.Table]:
    """Pieces of the runs of one tree and dimension, each repeating the end of the one before."""
    tail = None
    for table in _groups(_limited(batches, rows), ["tree", "dim", "_piece"]):
        same = tail is not None and all(tail[c][0] == table[c][0] for c in ("tree", "dim"))
        table = table.drop_columns("_piece")
        joined = pa.concat_tables([tail, table]) if same else table
        tail = table.slice(max(0, len(table) - overlap))
        yield joined


def _limited(batches, rows: int):
    """Batches with a running piece number, so that groups stay small."""
    seen = 0
    for batch in batches:
        number = pa.array((seen + np.arange(batch.num_rows)) // rows)
        seen += batch.num_rows
        yield pa.RecordBatch.from_arrays([*batch.columns, number], names=[*batch.schema.names, "_piece"])


def best(edges: DataFrame, k: int = NEIGHBOURS) -> DataFrame:
    """The ``k`` best edges of each u."""
    once = edges.groupBy("u", "v").agg(F.max("sim").alias("sim"))
    order = Window.partitionBy("u").orderBy(F.desc("sim"), "v")
    return once.withColumn("_r", F.row_number().over(order)).where(F.col("_r") <= k).drop("_r")


def descend(graph: DataFrame, nodes: DataFrame, k: int = NEIGHBOURS) -> DataFrame:
    """Edges between neighbours of a common neighbour that are better than what either one has.

    A vector's neighbours are the ones in its list and its ``k`` best admirers. Every such star is
    compared within itself, where it meets; only edges that enter a list come out.
    """
    back = best(graph.select(F.col("v").alias("u"), F.col("u").alias("v"), "sim"), k)
    stars = graph.select("u", "v").union(back.select("u", "v")).distinct()
    worst = graph.groupBy(F.col("u").alias("id")).agg(
        F.when(F.count("*") >= k, F.min("sim")).otherwise(-1.0).cast("float").alias("worst")
    )
    members = nodes.select("id", F.col("embedding").cast("array<float>").alias("embedding")).join(worst, "id", "left")
    rows = stars.join(members, stars.v == members.id).select("u", "id", "embedding", "worst")

    def compared(batches):
        for star in _groups(batches, ["u"], 256):
            if len(star) < 2:
                continue
            ids = np.asarray(star["id"])
            units = _units(star["embedding"].combine_chunks(), np.float32)
            worst = star["worst"].fill_null(-1.0).to_numpy()
            sims = units @ units.T
            np.fill_diagonal(sims, -2)
            a, b = np.nonzero(sims > worst[:, None])
            if len(a):
                yield _edges(ids[a], ids[b], sims[a, b])

    return arrow_map(rows.repartition("u").sortWithinPartitions("u"), compared, _EDGES)


def exact_links(edges: DataFrame, nodes: DataFrame, link: float) -> DataFrame:
    """The edges (a, b) whose cosine in double precision reaches ``link``."""
    left = nodes.select(F.col("id").alias("a"), F.col("embedding").alias("x"))
    right = nodes.select(F.col("id").alias("b"), F.col("embedding").alias("y"))

    def run(batches):
        for batch in batches:
            if batch.num_rows:
                close = (_units(batch["x"]) * _units(batch["y"])).sum(axis=1) >= link
                yield pa.RecordBatch.from_arrays(
                    [batch["a"].filter(pa.array(close)), batch["b"].filter(pa.array(close))], names=["a", "b"]
                )

    both = edges.join(left, "a").join(right, "b").select("a", "b", "x", "y")
    return arrow_map(both, run, "a long, b long")


def enlarged(nodes: DataFrame, found: DataFrame, link: float, block: int = BLOCK) -> DataFrame:
    """(id, links): how many vectors each vector of a component is linked to, copies counted.

    Lists of K hold at most K links; what lies beyond is found by comparing each component within
    itself. It is dealt into blocks, each pair of blocks is one group of bounded size, and counts
    come out, not pairs.
    """
    members = found.join(nodes, "id")
    sizes = found.groupBy("component").agg(F.count("*").alias("size"))
    parts = F.ceil(F.col("size") / block).cast("int")
    dealt = members.join(sizes, "component").withColumns(
        {"parts": parts, "mine": F.pmod(F.xxhash64("id"), parts).cast("int")}
    )
    cells = dealt.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("parts") - 1))).select(
        "component",
        F.least("mine", "other").alias("i"),
        F.greatest("mine", "other").alias("j"),
        "mine",
        "id",
        "n",
        "embedding",
    )

    def run(batches):
        for cell in _groups(batches, ["component", "i", "j"]):
            ids, mine, n = (np.asarray(cell[c]) for c in ("id", "mine", "n"))
            units = _units(cell["embedding"].combine_chunks())
            alone = cell["i"][0] == cell["j"][0]
            total = np.zeros(len(ids), dtype=np.int64)
            for at in range(0, len(ids), 256):
                close = units[at : at + 256] @ units.T >= link
                if not alone:
                    close &= mine[at : at + 256, None] != mine
                close[np.arange(len(close)), np.arange(at, at + len(close))] = False
                total[at : at + 256] = close @ n
            yield pa.RecordBatch.from_arrays([pa.array(ids), pa.array(total)], names=["id", "links"])

    keys = ["component", "i", "j"]
    counted = arrow_map(cells.repartition(*keys).sortWithinPartitions(*keys), run, "id long, links long")
    return counted.groupBy("id").agg(F.sum("links").alias("links"))


def bridges(nodes: DataFrame, found: DataFrame, full: DataFrame, link: float, block: int = BLOCK) -> DataFrame | None:
    """Edges (a, b), None without a pair to compare, between components of vectors whose lists are full of links.

    A full list may leave out links to another crowd, and a link is in neither list only if both
    are full; so components with a vector of ``full`` (id) are compared with each other, all
    vectors of them. They are dealt into blocks; a block lies in a cap around its mean, and caps
    further apart than the link's angle hold no link. What is left is compared exactly, and two
    blocks give one edge at most: it makes one component of both.
    """
    crowds = stage(found.join(full, "id", "left_semi").select("component").distinct(), "full")
    if crowds.count() < 2:
        return None
    members = found.join(crowds, "component", "left_semi")
    sizes = members.groupBy("component").agg(F.ceil(F.count("*") / block).cast("int").alias("parts"))
    members = stage(
        members.join(nodes, "id")
        .join(sizes, "component")
        .select("component", F.pmod(F.xxhash64("id"), "parts").cast("int").alias("part"), "id", "embedding"),
        "crowds",
    )
    reach = float(np.arccos(link)) + 1e-6
    keys = ["component", "part"]

    def capped(batches):
        for crowd in _groups(batches, keys):
            units = _units(crowd["embedding"].combine_chunks())
            centre, radius = _cap(units)
            yield pa.RecordBatch.from_arrays(
                [crowd["component"].combine_chunks()[:1], crowd["part"].combine_chunks()[:1],
                 pa.array([units.shape[1]], pa.int32()), pa.array([centre.tolist()]), pa.array([radius])],
                names=[*keys, "dim", "centre", "radius"],
            )

    caps = stage(
        arrow_map(
            members.repartition(*keys).sortWithinPartitions(*keys),
            capped,
            "component long, part int, dim int, centre array<double>, radius double",
        ),
        "caps",
    )
    parts = max(1, -(-caps.count() // block))
    mine = F.pmod(F.xxhash64(*keys), F.lit(parts)).cast("int")
    cells = caps.withColumn("mine", mine).withColumn("other", F.explode(F.sequence(F.lit(0), F.lit(parts - 1))))
    cells = cells.select("dim", F.least("mine", "other").alias("i"), F.greatest("mine", "other").alias("j"), "*")

    def near(batches):
        for cell in _groups(batches, ["dim", "i", "j"]):
            component, part, side = (np.asarray(cell[c]) for c in ("component", "part", "mine"))
            centres = np.stack(cell["centre"].to_numpy())
            radius = cell["radius"].to_numpy()
            alone = cell["i"][0] == cell["j"][0]
            for at in range(0, len(part), 256):
                rows = slice(at, at + 256)
                angles = np.arccos(np.clip(centres[rows] @ centres.T, -1, 1))
                close = angles <= radius[rows, None] + radius + reach
                close &= component[rows, None] < component
                if not alone:
                    close &= side[rows, None] != side
                a, b = np.nonzero(close)
                a += at
                yield pa.RecordBatch.from_arrays(
                    [pa.array(x) for x in (component[a], part[a], component[b], part[b])], names=["c", "p", "d", "q"]
                )

    order = ["dim", "i", "j"]
    pairs = arrow_map(
        cells.drop("other").select("i", "j", *caps.columns, "mine").repartition(*order).sortWithinPartitions(*order),
        near,
        "c long, p int, d long, q int",
    )
    sides = stage(pairs, "cap-pairs").select(
        "c", "p", "d", "q", F.explode(F.array(F.struct("c", "p"), F.struct(F.col("d").alias("c"), F.col("q").alias("p")))).alias("s")
    )
    rows = sides.select("c", "p", "d", "q", F.col("s.c").alias("component"), F.col("s.p").alias("part")).join(members, keys)

    def linked(batches):
        for pair in _groups(batches, ["c", "p", "d", "q"]):
            first = np.asarray(pair["component"]) == pair["c"][0].as_py()
            ids, units = np.asarray(pair["id"]), _units(pair["embedding"].combine_chunks())
            x, y, a, b = units[first], units[~first], ids[first], ids[~first]
            # Vectors that do not reach the other side's cap are left out first.
            for _ in range(2):
                centre, radius = _cap(y)
                reaching = np.arccos(np.clip(x @ centre, -1, 1)) <= radius + reach
                x, y, a, b = y, x[reaching], b, a[reaching]
                if not len(y):
                    break
            for at in range(0, len(x) if len(y) else 0, 256):
                sims = x[at : at + 256] @ y.T
                i, j = divmod(int(sims.argmax()), len(b))
                if sims[i, j] >= link:
                    u, v = int(a[at + i]), int(b[j])
                    yield pa.RecordBatch.from_arrays([pa.array([min(u, v)]), pa.array([max(u, v)])], names=["a", "b"])
                    break

    order = ["c", "p", "d", "q"]
    return arrow_map(rows.repartition(*order).sortWithinPartitions(*order), linked, "a long, b long")


def _cap(units: np.ndarray) -> tuple[np.ndarray, float]:
    """A direction and the largest angle of the vectors to it."""
    centre = units.mean(axis=0)
    centre = centre / norm if (norm := np.linalg.norm(centre)) > 1e-9 else units[0]
    return centre, float(np.arccos(np.clip(units @ centre, -1, 1)).max())


def audit(nodes: DataFrame, links: DataFrame, link: float, audited: int = AUDITED, seed: int = 3) -> float:
    """Share of the true links of a hash sample of vectors, compared with all others, that are found.

    The sample has ``audited`` of all vectors and as many of those with links, or all of these.
    """
    known = nodes.join(links, "id", "left").select("id", "embedding", F.coalesce("links", F.lit(0)).alias("links"))
    order = F.xxhash64("id", F.lit(seed))
    sample = known.orderBy(order, "id").limit(audited)
    sample = sample.union(known.where("links > 0").orderBy(order, "id").limit(audited)).dropDuplicates(["id"])
    asked = sample.toArrow()
    if not len(asked):
        return 1.0
    ids, have = asked["id"].to_numpy(), asked["links"].to_numpy()
    dims = np.array([len(x) for x in asked["embedding"]])
    units = {
        int(d): (np.flatnonzero(dims == d), _units(asked["embedding"].combine_chunks().filter(pa.array(dims == d))))
        for d in np.unique(dims)
    }

    def run(batches):
        total = np.zeros(len(ids), dtype=np.int64)
        for batch in batches:
            own = pa.compute.list_value_length(batch["embedding"]).to_numpy(zero_copy_only=False)
            for dim, (rows, queries) in units.items():
                part = batch.filter(pa.array(own == dim))
                if len(part):
                    close = queries @ _units(part["embedding"]).T >= link
                    close &= ids[rows, None] != np.asarray(part["id"])
                    total[rows] += close @ np.asarray(part["n"])
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(ids))), pa.array(total)], names=["k", "links"])

    true = arrow_map(nodes.select("id", "n", "embedding"), run, "k long, links long")
    true = {r.k: r.links for r in true.groupBy("k").agg(F.sum("links").alias("links")).collect()}
    want = np.array([true.get(k, 0) for k in range(len(ids))])
    return float(np.minimum(have, want).sum() / want.sum()) if want.sum() else 1.0


def near_vectors(
    vectors: DataFrame, link: float = LINK, k: int = NEIGHBOURS, trees: int = TREES, rounds: int = ROUNDS
) -> DataFrame:
    """One row per row of ``vectors`` (vec_id, embedding): vec_id, n_links, component_id, kept, recall.

    Equal vectors are one node with a count. A first neighbour graph comes from random trees;
    rounds of descent refine it until few list entries change. Edges at ``link`` or above, decided
    in double precision, make the components; where lists are full, components are compared with
    each other; a component's lists are enlarged to all links within it. An audit compares a sample
    with all vectors; while it finds a link missing, more trees are grown and the graph goes down
    again, until that helps no more. ``recall`` is what the last audit found; below 1 there is a warning.

    Vectors that cannot be compared link with nothing: n_links 0, their own component. So do rows
    with a null vec_id, whose component is null and which are kept. Vectors of different dimensions
    are not compared. Rows that repeat a vec_id, with its vector or another one, are vectors of their
    own. Work within a component grows with the square of its distinct vectors, in bounded
    blocks. No rows give no rows.
    """
    rows = stage(
        vectors.select("vec_id", F.when(usable() & F.col("vec_id").isNotNull(), F.col("embedding")).alias("embedding")),
        "vectors",
    )
    nodes = rows.where("embedding IS NOT NULL").groupBy("embedding")
    nodes = nodes.agg(F.min("vec_id").alias("head"), F.count("*").alias("n"))
    # Numbers of their own, as an id may repeat with other vectors; writing makes them fast.
    nodes = stage(nodes.withColumn("id", F.monotonically_increasing_id()), "nodes")
    total = nodes.count()
    edges, graph, recall = None, None, 1.0
    for attempt in count():
        new = tree_neighbours(nodes, trees * (attempt + 1), attempt)
        graph = stage(best(graph.union(new) if graph is not None else new, k), "graph")
        for _ in range(rounds):
            better = stage(descend(graph, nodes, k), "better")
            changed = better.count()
            graph = stage(best(graph.union(better), k), "graph")
            if changed <= CHANGE * k * total:
                break
        close = graph.where(F.col("sim") >= link - _SLACK).select(
            F.least("u", "v").alias("a"), F.greatest("u", "v").alias("b")
        )
        edges = stage(exact_links(close.where("a < b").distinct(), nodes, link), "links")
        found = components(edges)
        full = graph.where(F.col("sim") >= link - _SLACK).groupBy(F.col("u").alias("id")).count().where(F.col("count") >= k)
        more = bridges(nodes, found, full, link)
        if more is not None and not (more := stage(more, "bridges")).isEmpty():
            found = components(edges.union(more))
        links = stage(enlarged(nodes, found, link), "counts")
        before, recall = recall, audit(nodes, links, link, seed=3 + attempt)
        if recall == 1.0:
            break
        if attempt + 1 >= AUDITS and recall <= before:
            warnings.warn(f"near_vectors: the last of {attempt + 1} audits found {recall:.6f} of the links", stacklevel=2)
            break
    labelled = nodes.join(found, "id", "left").withColumn("label", F.coalesce("component", "id"))
    smallest = labelled.groupBy("label").agg(F.min("head").alias("smallest"))
    joined = stage(
        labelled.join(smallest, "label")
        .join(links, "id", "left")
        .select(
            F.col("embedding").alias("_e"),
            (F.coalesce("links", F.lit(0)) + F.col("n") - 1).alias("links"),
            F.col("smallest").alias("component"),
        ),
        "joined",
    )
    out = rows.join(joined, rows.embedding == joined._e, "left").select(
        "vec_id",
        F.coalesce("links", F.lit(0)).cast("long").alias("n_links"),
        F.coalesce("component", "vec_id").alias("component_id"),
        F.lit(recall).alias("recall"),
    )
    kept = F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(True))
    return out.select("vec_id", "n_links", "component_id", kept.alias("kept"), "recall")
