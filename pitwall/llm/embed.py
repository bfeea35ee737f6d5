"""Near-duplicate embeddings by a subspace pigeonhole join.

Vectors of one label are scaled to length 1 and rotated by a fixed random rotation, and the rotated coordinates are cut
into blocks. Cosine t means squared distance 2 (1 - t); if two vectors are that near, in some block their squared
distance is at most the block's share of it, in proportion to its dimensions. So every block is range-joined under
its budget: the first coordinates of the block form a grid of cells as wide as twice the radius, and a vector visits
the neighbouring cells that its radius reaches (only those before its own, as a pair needs to meet once). Pairs
within a block's budget are candidates; a pair is taken in the first block in which it is one, and verified by its
cosine in double precision.

Equal vectors of a label are first replaced by one with their number. Links are counted and reduced to a spanning
forest where they are found, so no pair leaves its task. A crowded cell is cut into tiles of ``tile_rows`` rows, and
each pair of tiles is a group of its own; no task holds more than two tiles.

Defined cases: null labels, null ids, null or zero vectors and vectors with null or non-finite components link with
nothing; vectors of different lengths do not link; repeated rows are copies and link; several vectors of one id count
their links each and share a component; components are whatever size a double has; an empty table gives an empty
result; other columns are ignored.
"""

from __future__ import annotations

from functools import lru_cache
from itertools import product

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, FloatType

from .graph import components
from .shared import arrow_map, checkpointed, grouped

BLOCKS = 4
GRID = 2  # coordinates of a block that form its grid
SLACK = 1e-9


@lru_cache(8)
def rotation(dim: int) -> np.ndarray:
    return np.linalg.qr(np.random.Generator(np.random.PCG64(dim)).standard_normal((dim, dim)))[0]


def blocks_of(dim: int, blocks: int) -> list[slice]:
    edges = np.linspace(0, dim, min(blocks, dim) + 1).astype(int)
    return [slice(a, b) for a, b in zip(edges, edges[1:])]


def unit(vectors: np.ndarray) -> np.ndarray:
    return vectors / np.linalg.norm(vectors, axis=1, keepdims=True)


def matrix(column: pa.Array) -> np.ndarray:
    """Rows of one length."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(len(column), -1)


def scaled(vectors: np.ndarray) -> np.ndarray:
    """Each times the power of two that brings its largest component near 1: the cosine stays, and no square is too large or small."""
    return np.ldexp(vectors, -np.frexp(np.abs(vectors).max(axis=1, keepdims=True, initial=0))[1])


def placed(vectors: np.ndarray, threshold: float, blocks: int) -> list[tuple[int, int, np.ndarray, np.ndarray]]:
    """(block, 1 at home or 0 on a visit, rows, cells) for all blocks; cells as rows of grid coordinates."""
    turned = unit(vectors) @ rotation(vectors.shape[1])
    out = []
    for b, part in enumerate(blocks_of(vectors.shape[1], blocks)):
        share = 2 * (1 - threshold) * (part.stop - part.start) / vectors.shape[1] + SLACK
        radius = max(float(np.sqrt(share)), 1e-6)
        at = turned[:, part][:, :GRID]
        home = np.floor(at / (2 * radius)).astype(np.int64)
        low, high = (np.floor((at + s * radius) / (2 * radius)).astype(np.int64) for s in (-1, 1))
        out.append((b, 1, np.arange(len(at)), home))
        for step in product((-1, 0, 1), repeat=at.shape[1]):
            if step >= (0,) * len(step):  # only cells before the own one, in the order of their coordinates
                continue
            cell = home + np.array(step)
            rows = np.flatnonzero(((cell >= low) & (cell <= high)).all(axis=1))
            out.append((b, 0, rows, cell[rows]))
    return out


def linked(left: np.ndarray, right: np.ndarray, both: np.ndarray, block: int, threshold: float, blocks: int, same: bool) -> tuple[np.ndarray, np.ndarray]:
    """Places of the linked pairs between two sets of vectors that this block has to take."""
    a, b = unit(left), unit(right)
    turn = rotation(left.shape[1])
    ta, tb = a @ turn, b @ turn
    parts, total = blocks_of(left.shape[1], blocks), 2 * (1 - threshold)
    shares = [total * (p.stop - p.start) / left.shape[1] + SLACK for p in parts]
    part = parts[block]
    rows, columns = [], []
    sq_b = (tb[:, part] ** 2).sum(1)
    for start in range(0, len(a), 256):
        own = ta[start:start + 256, part]
        near = (own ** 2).sum(1)[:, None] + sq_b - 2 * own @ tb[:, part].T <= shares[block] + SLACK
        near &= both[start:start + 256]
        if same:
            near &= np.arange(len(b)) > np.arange(start, start + len(own))[:, None]
        i, j = np.nonzero(near)
        i += start
        first = ((ta[i][:, part] - tb[j][:, part]) ** 2).sum(1) <= shares[block]
        for k in range(block):  # an earlier block takes it
            first &= ((ta[i][:, parts[k]] - tb[j][:, parts[k]]) ** 2).sum(1) > shares[k]
        i, j = i[first], j[first]
        cosine = np.einsum("ij,ij->i", left[i], right[j]) / (np.linalg.norm(left[i], axis=1) * np.linalg.norm(right[j], axis=1))
        good = cosine >= threshold
        rows.append(i[good])
        columns.append(j[good])
    return np.concatenate(rows), np.concatenate(columns)


def forest(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Links that connect what all of these do: each node to the smallest of its component."""
    nodes, at = np.unique(np.concatenate((a, b)), return_inverse=True)
    x, y = at[:len(a)], at[len(a):]
    label = np.arange(len(nodes))
    while True:
        low = np.minimum(label[x], label[y])
        new = label.copy()
        np.minimum.at(new, label[x], low)
        np.minimum.at(new, label[y], low)
        new = new[new]
        if (new == label).all():
            break
        label = new
    moved = np.flatnonzero(label != np.arange(len(nodes)))
    return nodes[moved], nodes[label[moved]]


def near_duplicates(vectors: DataFrame, threshold: float = 0.93, blocks: int = BLOCKS, tile_rows: int = 2048) -> DataFrame:
    """vec_id, n_links, component_id and kept of every row of (vec_id, embedding, label)."""
    given = vectors.schema["embedding"].dataType
    kind = "array<float>" if isinstance(given, ArrayType) and isinstance(given.elementType, FloatType) else "array<double>"
    vectors = vectors.select("vec_id", F.col("embedding").cast(kind).alias("v"), "label")
    finite = F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    usable = F.col("vec_id").isNotNull() & F.col("label").isNotNull() & F.coalesce(finite & F.exists("v", lambda x: x != 0), F.lit(False))
    good = vectors.where(usable).withColumn("dim", F.size("v"))
    classes = checkpointed(good.groupBy("label", "dim", "v").agg(F.min("vec_id").alias("rep"), F.count("*").alias("copies"))
                           .withColumn("class", F.xxhash64("label", "dim", "v")))  # with rep: an id may have several vectors

    def deal(batches):
        for batch in batches:
            dims = batch.column("dim").to_numpy()
            for dim in np.unique(dims):
                own = batch.take(pa.array(np.flatnonzero(dims == dim)))
                for block, home, rows, cells in placed(scaled(matrix(own.column("v"))), threshold, blocks):
                    if len(rows):
                        kept = own.take(pa.array(rows))
                        cell = pa.array([",".join(map(str, c)) for c in cells.tolist()])
                        yield pa.RecordBatch.from_arrays(
                            [kept.column("label"), kept.column("dim"), pa.array(np.full(len(rows), block, np.int32)), cell,
                             pa.array(np.full(len(rows), home, np.int32)), kept.column("rep"), kept.column("class"), kept.column("copies"), kept.column("v")],
                            names=["label", "dim", "block", "cell", "home", "rep", "class", "copies", "v"])

    label_type = vectors.schema["label"].dataType.simpleString()
    dealt = arrow_map(classes.select("label", "dim", "rep", "class", "copies", "v"), deal,
                      f"label {label_type}, dim int, block int, cell string, home int, rep long, class long, copies long, v {kind}")
    keys = ["label", "dim", "block", "cell"]
    crowds = dealt.groupBy(*keys).agg(F.ceil(F.count("*") / tile_rows).alias("tiles")).where("tiles > 1")
    tiled = dealt.join(crowds, keys, "left").withColumn("tiles", F.coalesce("tiles", F.lit(1)).cast("long"))
    tiled = tiled.withColumn("tile", F.pmod(F.xxhash64("class"), F.col("tiles"))) \
        .withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), F.col("tiles") - 1))) \
        .withColumn("low", F.least("tile", "other")).withColumn("high", F.greatest("tile", "other"))

    def meet(table: pa.Table) -> pa.Table:
        block = table.column("block")[0].as_py()
        tile, low = table.column("tile").to_numpy(), table.column("low")[0].as_py()
        rep, own, copies, home = (table.column(c).to_numpy() for c in ("rep", "class", "copies", "home"))
        v = scaled(matrix(table.column("v")))
        same = low == table.column("high")[0].as_py()
        left = np.arange(len(rep)) if same else np.flatnonzero(tile == low)
        right = left if same else np.flatnonzero(tile != low)
        i = j = np.zeros(0, np.int64)
        if len(left) and len(right) and home.any():
            both = (home[left][:, None] + home[right]) > 0
            i, j = linked(v[left], v[right], both, block, threshold, blocks, same)
            i, j = left[i], right[j]
        links = np.zeros(len(rep), np.int64)
        np.add.at(links, i, copies[j])
        np.add.at(links, j, copies[i])
        some = np.flatnonzero(links)
        a, b = forest(rep[i], rep[j]) if len(i) else (rep[:0], rep[:0])
        # counts of classes (with n), and links of their smallest ids
        return pa.table({"a": np.concatenate((rep[some], a)), "b": np.concatenate((own[some], b)),
                         "n": np.concatenate((links[some], np.zeros(len(a), np.int64)))})

    met = checkpointed(tiled.select(*keys, "home", "rep", "class", "copies", "v", "tile", "low", "high")
                       .groupBy(*keys, "low", "high").applyInArrow(grouped(meet), "a long, b long, n long"))
    groups = components(met.where("n = 0").select("a", "b"))
    counts = met.where("n > 0").groupBy(F.col("a").alias("rep"), F.col("b").alias("class")).agg(F.sum("n").alias("n"))
    told = classes.join(counts, ["rep", "class"], "left").join(groups.withColumnRenamed("node", "rep"), "rep", "left").select(
        "label", "dim", F.col("v").alias("w"), (F.coalesce("n", F.lit(0)) + F.col("copies") - 1).alias("n_links"),
        F.coalesce("component", "rep").alias("component_id"))
    found = good.join(told.withColumnsRenamed({"label": "label2", "dim": "dim2"}),
                      (F.col("label") == F.col("label2")) & (F.col("dim") == F.col("dim2")) & (F.col("v") == F.col("w"))) \
        .select("vec_id", "n_links", "component_id")
    rest = vectors.where(~usable).select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"))
    return found.unionByName(rest).withColumn("kept", F.col("vec_id").eqNullSafe(F.col("component_id")))


def op6_embedding_dedup(spark, sf_dir: str) -> DataFrame:
    """All embeddings of a label against each other at cosine 0.93."""
    return near_duplicates(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))


OP6_SQL = """
WITH RECURSIVE good AS (
  SELECT vec_id, label, embedding::DOUBLE[] AS v FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
    AND len(list_filter(embedding, lambda x: x <> 0)) > 0),
links AS (
  SELECT a.vec_id AS a, b.vec_id AS b FROM good a JOIN good b ON a.label = b.label AND a.vec_id <> b.vec_id AND len(a.v) = len(b.v)
  WHERE list_inner_product(a.v, b.v) / (sqrt(list_inner_product(a.v, a.v)) * sqrt(list_inner_product(b.v, b.v))) >= 0.93),
reach AS (
  SELECT vec_id AS a, vec_id AS b FROM embeddings
  UNION
  SELECT r.a, l.b FROM reach r JOIN links l ON r.b = l.a),
comp AS (SELECT a AS vec_id, min(b) AS component_id FROM reach GROUP BY a),
n AS (SELECT a AS vec_id, count(*) AS n_links FROM links GROUP BY a)
SELECT e.vec_id, coalesce(n.n_links, 0)::BIGINT AS n_links, c.component_id, e.vec_id = c.component_id AS kept
FROM embeddings e JOIN comp c USING (vec_id) LEFT JOIN n USING (vec_id)
"""
