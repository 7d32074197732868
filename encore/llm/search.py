"""Exact top-k search by pivot-table elimination.

Each vector's distances to many pivots are computed once: the pivot table. For a query and a
candidate, the largest difference of their distances to a pivot bounds their own distance from
below, and with both norms bounds their inner product from above. Candidates are evaluated in the
order of that bound until the bound falls below the k-th score found: the rest can't enter.

Queries and candidates are cut into blocks of a fixed size by the hash of their id, each packed
into one row, and every block of queries meets every block of candidates: the work is that of the
stated query set against all rows, in cells of bounded memory. A cell returns k rows a query at
most; those are ranked over all cells.

Defined cases. Null vectors, and vectors that hold a null or a component that isn't finite, take
no part. Vectors of unlike length don't meet; an empty vector scores 0 with the others like it.
Ties go to the smaller id. Repeated rows are candidates each; a query's own id is none. Rows
without an id take no part. An empty table gives an empty result. Other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from encore.llm.base import bounded, query, ship, table, to_arrow
from encore.session import stage_table

TOP = 20
SCALE = 64.0
QUERY_EVERY = 20
PIVOTS = 16
#: Vectors that pivots are chosen from, and vectors in a block of queries or of candidates.
PIVOT_SAMPLE, QUERY_BLOCK, BLOCK = 512, 1 << 10, 1 << 13
#: Candidates evaluated first; then eight times as many at a time.
STEP = 256

BLOCKS = "dim int, block int, ids binary, vectors binary, table binary"


def quantised(vectors: DataFrame, scale: float = SCALE) -> DataFrame:
    """vec_id and v, the floor of each scaled component, of the vectors that take part."""
    x = F.col("embedding")
    sound = F.forall(x, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < float("inf")))
    return vectors.where(F.col("vec_id").isNotNull() & x.isNotNull() & sound).select(
        F.col("vec_id").cast("bigint").alias("vec_id"),
        F.transform(x, lambda c: F.floor(F.lit(scale) * c.cast("double")).cast("bigint")).alias("v"),
    )


def choose_pivots(sample: np.ndarray, count: int = PIVOTS) -> np.ndarray:
    """Vectors far from each other: each next one is the farthest from those chosen."""
    if not len(sample):
        return sample
    x = sample.astype(float)
    chosen = [int(np.argmax(((x - x.mean(0)) ** 2).sum(1)))]
    near = ((x - x[chosen[0]]) ** 2).sum(1)
    while len(chosen) < min(count, len(x)):
        chosen.append(int(near.argmax()))
        near = np.minimum(near, ((x - x[chosen[-1]]) ** 2).sum(1))
    return x[chosen]


def pivot_table(x: np.ndarray, pivots: np.ndarray) -> np.ndarray:
    """Distances to the pivots, a row for each pivot, and the norms as the last row."""
    x = x.astype(float)
    away = [np.sqrt(((x - p) ** 2).sum(1)) for p in pivots]
    return np.stack([*away, np.sqrt((x**2).sum(1))]).astype(np.float32)


def exact_type(q: np.ndarray, x: np.ndarray) -> type:
    """The fastest type in which the inner products are exact."""
    most = float(np.abs(x).max(initial=0)) * float(np.abs(q).max(initial=0)) * max(1, q.shape[-1])
    return np.float32 if most < 2**24 else np.float64 if most < 2**53 else object


def upper_bounds(q_row: np.ndarray, rows: np.ndarray) -> np.ndarray:
    """What no candidate's score can exceed, from the pivot table; rounding is allowed for."""
    apart = np.abs(rows[:-1] - q_row[:-1, None]).max(0) if len(rows) > 1 else np.float32(0)
    norms = rows[-1] ** 2 + q_row[-1] ** 2
    most = (norms - apart**2) / 2 + np.float32(1e-5) * norms + 1
    return np.where(np.isnan(most), np.inf, most)


def top_of_block(
    q: np.ndarray, q_id: int, q_row: np.ndarray, x: np.ndarray, ids: np.ndarray, rows: np.ndarray, k: int = TOP
) -> list[tuple[int, int]]:
    """(score, id) of the query's k best candidates in the block; rows are the pivot table. The
    vectors come in a type in which inner products are exact."""
    most = upper_bounds(q_row, rows)
    best = np.zeros((0, 2), np.int64 if x.dtype != object else object)

    def evaluate(own: np.ndarray) -> None:
        nonlocal best
        own = own[ids[own] != q_id]
        scores = x[own] @ q
        if len(best) == k:
            own, scores = own[scores >= best[-1, 0]], scores[scores >= best[-1, 0]]
        found = np.stack([scores.astype(best.dtype), ids[own].astype(best.dtype)], 1)
        both = np.concatenate([best, found])
        best = both[np.lexsort((both[:, 1], -both[:, 0]))[:k]]

    first = min(STEP, len(ids))
    order = np.argpartition(-most, first - 1)
    evaluate(order[:first])
    rest = order[first:]
    if len(best) == k:  # what can't reach the k-th score so far is out already
        rest = rest[most[rest] >= float(best[-1, 0])]
    rest = rest[np.argsort(-most[rest], kind="stable")]
    for at in range(0, len(rest), 8 * STEP):
        if len(best) == k and most[rest[at]] < float(best[-1, 0]):
            break
        evaluate(rest[at : at + 8 * STEP])
    return [(int(score), int(i)) for score, i in best]


def _blocks(vectors: DataFrame, size: int, pivots: dict[int, np.ndarray]) -> DataFrame:
    """Vectors of one length packed into rows of about so many, with their pivot table."""
    spark = vectors.sparkSession
    count = max(1, -(-vectors.count() // size))
    shared = spark.sparkContext.broadcast(pivots)
    schema = to_arrow(spark, BLOCKS)
    dealt = (
        vectors.withColumn("dim", F.size("v"))
        .withColumn("block", F.pmod(F.xxhash64("vec_id"), F.lit(count)).cast("int"))
        .repartition(count, "dim", "block")
        .sortWithinPartitions("dim", "block", "vec_id")
        .select("dim", "block", "vec_id", "v")
    )

    def packed(key: tuple[int, int], ids: list[np.ndarray], flat: list[np.ndarray]) -> pa.RecordBatch:
        ids, x = np.concatenate(ids), np.concatenate(flat).reshape(-1, key[0])
        rows = pivot_table(x, shared.value.get(key[0], np.zeros((0, key[0]))))
        parts = [[key[0]], [key[1]], [ids.tobytes()], [x.astype("<i8").tobytes()], [rows.tobytes()]]
        return pa.RecordBatch.from_arrays([pa.array(p, f.type) for p, f in zip(parts, schema)], schema=schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, ids, flat = None, [], []
        for batch in batches:
            dim, block, vec, v = (batch.column(i) for i in range(4))
            pairs = np.stack([dim.to_numpy(), block.to_numpy()], 1)
            cuts = [0, *(np.flatnonzero((pairs[1:] != pairs[:-1]).any(1)) + 1).tolist(), len(pairs)]
            for a, b in zip(cuts, cuts[1:]):
                if a == b:
                    continue
                own = tuple(pairs[a].tolist())
                if own != key and key is not None:
                    yield packed(key, ids, flat)
                    ids, flat = [], []
                key = own
                ids.append(vec.slice(a, b - a).to_numpy())
                flat.append(v.slice(a, b - a).flatten().to_numpy().astype(np.int64))
        if key is not None:
            yield packed(key, ids, flat)

    ship(spark)
    return stage_table(dealt.mapInArrow(run, BLOCKS), "vector-blocks")


def top_k(vectors: DataFrame, is_query, k: int = TOP) -> DataFrame:
    """query_id, rank, vec_id and score; ``is_query`` is a condition on vec_id."""
    spark = vectors.sparkSession
    sound = stage_table(quantised(vectors), "vectors")
    sample = bounded(sound, PIVOT_SAMPLE, "vec_id").select("v").toPandas()["v"]
    by_dim: dict[int, list] = {}
    for v in sample:
        by_dim.setdefault(len(v), []).append(v)
    pivots = {d: choose_pivots(np.array(own, np.int64).reshape(-1, d)) for d, own in by_dim.items()}
    candidates = _blocks(sound, BLOCK, pivots)
    queries = _blocks(sound.where(is_query), QUERY_BLOCK, pivots)
    queries = queries.withColumnsRenamed({c: f"q_{c}" for c in queries.columns if c != "dim"})

    # A cell for each block of queries and of candidates with vectors of one length. Queries are
    # copied to every block of candidates, which are sent once. Merged by hint: the files of the
    # queries' blocks may be small enough for a broadcast, their copies aren't.
    most = candidates.agg(F.max("block")).first()[0]
    left = queries.withColumn("block", F.explode(F.sequence(F.lit(0), F.lit(most if most is not None else 0))))
    cells = left.join(candidates.hint("merge"), ["dim", "block"])
    schema = to_arrow(spark, "query_id bigint, vec_id bigint, score bigint")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for cell in batch.to_pylist():
                d = cell["dim"]
                qi, xi = (np.frombuffer(cell[n], np.int64) for n in ("q_ids", "ids"))
                q, x = (np.frombuffer(cell[n], np.int64).reshape(len(i), d) for n, i in (("q_vectors", qi), ("vectors", xi)))
                qt, xt = (np.frombuffer(cell[n], np.float32).reshape(-1, len(i)) for n, i in (("q_table", qi), ("table", xi)))
                kind = exact_type(q, x)
                q, x = (a.tolist() if kind is object else a for a in (q, x))
                q, x = (np.array(a, kind).reshape(-1, d) for a in (q, x))
                rows = [
                    (int(i), vec, score)
                    for n, i in enumerate(qi)
                    for score, vec in top_of_block(q[n], i, qt[:, n], x, xi, xt, k)
                ]
                columns = zip(*rows) if rows else ((), (), ())
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], schema=schema)

    found = cells.mapInArrow(run, "query_id bigint, vec_id bigint, score bigint")
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return (
        found.withColumn("rank", F.row_number().over(order))
        .where(F.col("rank") <= k)
        .select("query_id", "rank", "vec_id", "score")
    )


@query(
    "op9_exact_top_k",
    """
    WITH sound AS (
        SELECT vec_id, list_transform(embedding, lambda x: floor(64 * CAST(x AS DOUBLE))) AS v
        FROM embeddings
        WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
          AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
    scored AS (
        SELECT q.vec_id AS query_id, c.vec_id,
               CAST(list_sum(list_transform(list_zip(q.v, c.v), lambda p: p[1] * p[2])) AS BIGINT) AS score
        FROM sound q JOIN sound c ON q.vec_id % 20 = 0 AND q.vec_id <> c.vec_id AND len(q.v) = len(c.v)),
    ranked AS (
        SELECT *, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank
        FROM scored)
    SELECT query_id, rank, vec_id, score FROM ranked WHERE rank <= 20""",
)
def op9_exact_top_k(spark: SparkSession, sf: str) -> DataFrame:
    return top_k(table(spark, sf, "embeddings"), F.col("vec_id") % QUERY_EVERY == 0)
