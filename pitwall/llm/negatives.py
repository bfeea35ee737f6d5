"""Hard-negative mining with bounds along spanning trees of anchors.

Anchors (rows whose id is divisible by ``every``) are the stated query set; they meet all rows in cells of one group of
anchors and one chunk of rows, so a task holds a bounded number of both. In a cell, neighbouring anchors (by the
signs of their products with a few fixed directions) form blocks, and each block's minimum spanning tree is built. The
root's scores with all candidates are computed. If a child lies at distance d from its parent, its score with a candidate
is its parent's plus or minus d times the candidate's norm, so intervals follow down the tree, and only candidates whose
interval can matter are scored again (which makes their interval a point):

1. positives: rows of the anchor's label whose upper bound reaches the fifth largest lower bound;
2. negatives: rows of other labels whose interval overlaps a window from ``low_percent`` % to 100 % of a positive's score.

Every cell returns its best few per anchor (and positive), and a limited window ranks them. Both are exact.

Components become whole numbers, floor(``scale`` * x), and scores are whole numbers too: doubles hold them up to 2^53, and
where norms allow larger ones Python's numbers are used (a score beyond 64 bits becomes the largest or smallest one).

Defined cases: rows with a null id, a null label, a null or empty vector, or a component that is null, not finite or not
finite times ``scale`` take no part; vectors of different lengths do not meet; equal rows that are an anchor are mined once;
a row that shares the anchor's id is no positive of it; otherwise repeated rows count each; equal scores go to the smaller
id; a positive without a negative in its window has no row; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, FloatType

from .embed import matrix
from .shared import checkpointed, ship

#: Anchors of one tree; of a group, at most about; rows of a chunk, at most about.
BLOCK, GROUP_ANCHORS, CHUNK_ROWS = 64, 1 << 14, 1 << 15
_EXACT = float(1 << 53)
_LARGEST = (1 << 63) - 1


def products(rows: np.ndarray, norms: np.ndarray, anchor: np.ndarray) -> np.ndarray:
    """Whole-number inner products; no partial sum of doubles is beyond the product of norms."""
    if not len(rows) or float(norms.max()) * float(np.linalg.norm(anchor)) * (1 + 1e-9) < _EXACT:
        return (rows @ anchor).astype(np.int64)
    own = [int(x) for x in anchor]
    return np.array([max(-_LARGEST - 1, min(_LARGEST, sum(int(x) * y for x, y in zip(row, own)))) for row in rows], np.int64)


def neighbours(vectors: np.ndarray) -> np.ndarray:
    """An order in which vectors with equal signs along fixed directions follow each other."""
    turn = np.random.Generator(np.random.PCG64(vectors.shape[1])).standard_normal((vectors.shape[1], 16))
    signs = vectors @ turn > 0
    return np.lexsort(signs.T)


def spanning_tree(vectors: np.ndarray) -> list[tuple[int, int, float]]:
    """(anchor, its parent or -1, distance) of a minimum spanning tree, parents first."""
    near, parent = np.full(len(vectors), np.inf), np.full(len(vectors), -1)
    left = np.ones(len(vectors), bool)
    out, at, far = [], 0, 0.0
    while True:
        out.append((at, int(parent[at]), far))
        left[at] = False
        if not left.any():
            return out
        distance = np.linalg.norm(vectors - vectors[at], axis=1)
        closer = left & (distance < near)
        near[closer], parent[closer] = distance[closer], at
        at = int(np.argmin(np.where(left, near, np.inf)))
        far = float(near[at])


def walked(anchors: np.ndarray, rows: np.ndarray, norms: np.ndarray, wanted):
    """For every anchor (its place): the candidates that ``wanted(place, low, high)`` names, and their scores."""
    order = neighbours(anchors)
    for start in range(0, len(order), BLOCK):
        block = order[start:start + BLOCK]
        low, high = np.empty((len(block), len(rows))), np.empty((len(block), len(rows)))
        for at, parent, distance in spanning_tree(anchors[block]):
            place = int(block[at])
            if parent < 0:
                known = products(rows, norms, anchors[place])
                low[at] = high[at] = known
                some = wanted(place, low[at], high[at])
                yield place, some, known[some]
                continue
            # rounded outwards: scores of over 2^53 are rounded as doubles
            reach = (distance * (1 + 1e-9)) * norms + 1e-6 + 1e-12 * np.maximum(np.abs(low[parent]), np.abs(high[parent]))
            low[at], high[at] = low[parent] - reach, high[parent] + reach
            some = wanted(place, low[at], high[at])
            known = products(rows[some], norms[some], anchors[place])
            low[at, some] = high[at, some] = known
            yield place, some, known


def best(scores: np.ndarray, ids: np.ndarray, n: int) -> np.ndarray:
    """Places of the ``n`` highest scores, ties to the smaller id."""
    return np.lexsort((ids, ~scores))[:n] if len(scores) > n else np.arange(len(scores))


def whole_numbers(column: pa.Array, scale: float) -> np.ndarray:
    return np.floor(scale * matrix(column))


def by_length(left: pa.Table, right: pa.Table):
    """Both tables' rows for every vector length of the left one."""
    sizes = [np.asarray(t.column("dim")) for t in (left, right)]
    for dim in np.unique(sizes[0]).tolist():
        a, b = (t.take(pa.array(np.flatnonzero(s == dim))) for t, s in zip((left, right), sizes))
        if len(b):
            yield a, b


def mine(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label", every: int = 100,
         n_positives: int = 5, n_negatives: int = 5, low_percent: int = 80, scale: int = 256,
         group_anchors: int = GROUP_ANCHORS, chunk_rows: int = CHUNK_ROWS) -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score and negative_score of all anchors among the rows."""
    spark = vectors.sparkSession
    single = isinstance(vectors.schema[vector_col].dataType, ArrayType) and isinstance(vectors.schema[vector_col].dataType.elementType, FloatType)
    kind = "array<float>" if single else "array<double>"  # as given: floats take half the room
    rows = vectors.select(F.col(id_col).cast("long").alias("id"), F.col(label_col).cast("long").alias("label"), F.col(vector_col).cast(kind).alias("v"))
    finite = F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x.cast("double") * scale) < F.lit(float("inf"))))
    rows = rows.where(F.col("id").isNotNull() & F.col("label").isNotNull() & (F.size("v") > 0) & F.coalesce(finite, F.lit(False))) \
        .withColumn("dim", F.size("v"))
    anchors = rows.where(F.col("id") % every == 0).withColumn("anchor", F.xxhash64("id", "label", "v")).dropDuplicates(["anchor"])
    anchors = checkpointed(anchors)
    chunks = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-rows.count() // chunk_rows))
    groups = max(1, -(-anchors.count() // group_anchors))
    number = lambda n: F.sequence(F.lit(0), F.lit(n - 1))
    # every chunk meets every group of anchors; identical rows only share a chunk with their own copies' hash
    dealt = rows.withColumn("chunk", F.pmod(F.xxhash64("id", "v"), F.lit(chunks)).cast("int")).withColumn("group", F.explode(number(groups)))

    def spread(queries: DataFrame) -> DataFrame:
        return queries.withColumn("group", F.pmod("anchor", F.lit(groups)).cast("int")).withColumn("chunk", F.explode(number(chunks)))

    def positives(left: pa.Table, right: pa.Table) -> pa.Table:
        found: list[list[np.ndarray]] = [[], [], []]
        for own, others in by_length(left, right):
            anchor, ids, labels = (own.column(c).to_numpy() for c in ("anchor", "id", "label"))
            other_ids, other_labels = (others.column(c).to_numpy() for c in ("id", "label"))
            x = whole_numbers(others.column("v"), scale)

            def reaching(place: int, low: np.ndarray, high: np.ndarray) -> np.ndarray:
                same = np.flatnonzero((other_labels == labels[place]) & (other_ids != ids[place]))
                if len(same) > n_positives:
                    same = same[high[same] >= np.partition(low[same], -n_positives)[-n_positives]]
                return same

            for place, some, scores in walked(whole_numbers(own.column("v"), scale), x, np.linalg.norm(x, axis=1), reaching):
                top = best(scores, other_ids[some], n_positives)
                for k, part in enumerate((np.full(len(top), anchor[place]), other_ids[some][top], scores[top])):
                    found[k].append(part)
        return pa.table([np.concatenate(f) if f else np.zeros(0, np.int64) for f in found], names=["anchor", "positive_id", "positive_score"])

    def negatives(left: pa.Table, right: pa.Table) -> pa.Table:
        found: list[list[np.ndarray]] = [[], [], [], []]
        for own, others in by_length(left, right):
            anchor, labels = (own.column(c).to_numpy() for c in ("anchor", "label"))
            tops = own.column("scores").to_pylist()
            other_ids, other_labels = (others.column(c).to_numpy() for c in ("id", "label"))
            x = whole_numbers(others.column("v"), scale)
            # whole scores s with low_percent * top <= 100 * s <= 100 * top
            windows = [[(-(-low_percent * top // 100), top) for top in own_tops] for own_tops in tops]

            def overlapping(place: int, low: np.ndarray, high: np.ndarray) -> np.ndarray:
                some = np.zeros(len(low), bool)
                for bottom, top in windows[place]:
                    some |= (high >= bottom) & (low <= top)
                return np.flatnonzero(some & (other_labels != labels[place]))

            for place, some, scores in walked(whole_numbers(own.column("v"), scale), x, np.linalg.norm(x, axis=1), overlapping):
                ids = other_ids[some]
                for k, (bottom, top) in enumerate(windows[place]):
                    inside = np.flatnonzero((scores >= bottom) & (scores <= top))
                    inside = inside[best(scores[inside], ids[inside], n_negatives)]
                    for j, part in enumerate((np.full(len(inside), anchor[place]), np.full(len(inside), k), ids[inside], scores[inside])):
                        found[j].append(part)
        return pa.table([np.concatenate(f).astype(np.int64) if f else np.zeros(0, np.int64) for f in found],
                        names=["anchor", "place", "negative_id", "negative_score"])

    ship(spark)
    cell = ("group", "chunk")
    queries = anchors.select("anchor", "id", "label", "dim", "v")
    first = Window.partitionBy("anchor").orderBy(F.desc("positive_score"), "positive_id")
    tops = spread(queries).groupBy(*cell).cogroup(dealt.groupBy(*cell)) \
        .applyInArrow(positives, "anchor long, positive_id long, positive_score long") \
        .withColumn("place", F.row_number().over(first) - 1).where(F.col("place") < n_positives)
    tops = checkpointed(tops)
    lists = tops.groupBy("anchor").agg(F.transform(F.sort_array(F.collect_list(F.struct("place", "positive_score"))), lambda x: x["positive_score"]).alias("scores"))
    each = Window.partitionBy("anchor", "place").orderBy(F.desc("negative_score"), "negative_id")
    mined = spread(queries.join(lists, "anchor")).groupBy(*cell).cogroup(dealt.groupBy(*cell)) \
        .applyInArrow(negatives, "anchor long, place long, negative_id long, negative_score long") \
        .withColumn("rank", F.row_number().over(each)).where(F.col("rank") <= n_negatives)
    return mined.join(tops, ["anchor", "place"]).join(anchors.select("anchor", F.col("id").alias("anchor_id")), "anchor") \
        .select("anchor_id", "positive_id", F.col("rank").cast("int").alias("rank"), "negative_id", "positive_score", "negative_score")


def op11_hard_negatives(spark, sf_dir: str) -> DataFrame:
    """Hard negatives of every hundredth vector among all embeddings."""
    vectors = spark.read.parquet(f"{sf_dir}/embeddings.parquet")
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return mine(vectors.select("vec_id", "embedding", label.alias("label")))


OP11_SQL = """
WITH good AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
         list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS v
  FROM embeddings
  WHERE vec_id IS NOT NULL AND label IS NOT NULL AND len(embedding) > 0
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
scored AS (
  SELECT a.vec_id AS anchor_id, b.vec_id AS other_id, a.label = b.label AS same, list_inner_product(a.v, b.v)::BIGINT AS score
  FROM good a JOIN good b ON len(a.v) = len(b.v) WHERE a.vec_id % 100 = 0),
positives AS (
  SELECT anchor_id, other_id AS positive_id, score AS positive_score FROM scored WHERE same AND other_id <> anchor_id
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, other_id) <= 5)
SELECT anchor_id, positive_id,
       (row_number() OVER (PARTITION BY anchor_id, positive_id ORDER BY score DESC, other_id))::INTEGER AS rank,
       other_id AS negative_id, positive_score, score AS negative_score
FROM positives p JOIN scored s USING (anchor_id)
WHERE NOT same AND 80 * positive_score <= 100 * score AND 100 * score <= 100 * positive_score
QUALIFY rank <= 5
"""
