"""SimHash near-duplicates over a Gray-order hierarchical index.

Texts with one fingerprint are one entry of the index. Its top nodes are shared masked bit
patterns: the 64 bits are cut into six chunks, and each of the 15 pairs of chunks is a mask. Two
fingerprints that differ in four bits or fewer agree on two chunks at least, so they meet below
some node, and the mask and pattern of a node are a key that Spark deals out. Below a node,
entries lie in the order of their Gray rank, in which neighbours differ in few bits; leaves and
the nodes above them hold the bits that all below share. A search adds up differences from a node
down and leaves out whole groups as soon as they exceed the limit.

Only links that span what is connected are returned, never all pairs of a group. A node with more
than ``NODE_ROWS`` entries is dealt over cells, each for two of its parts, so that every two of
its entries still meet. Components come from a distributed star algorithm.

Defined cases. A null text counts as empty; a text without words has fingerprint zero and links
like any other. Repeated rows each get a row. A row without an id is linked but can't name its
component. An empty table gives an empty result. Other columns are not read; ``keep_one`` passes
them through, but for names that begin with ``_sim_``. It decides by row, told apart by id and
text, and keeps one row of each component: of rows alike in both it keeps any one.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import accumulate, combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from encore.llm.base import map_batches, query, ship, table, to_arrow, utf8
from encore.llm.components import components
from encore.session import stage_table

SHINGLE_WORDS = 4
SEED = 42
MOST_BITS = 4
#: Widths of the chunks, from the top bit: two more than bits that may differ.
CHUNKS = (11, 11, 11, 11, 10, 10)
#: Most entries of one part of a node; above it the node is dealt over cells.
NODE_ROWS = 1 << 14
#: Entries in a leaf, leaves in the node above; groups up to a leaf are compared at once.
LEAF = 32


def fingerprint(text: bytes, words_in: int = SHINGLE_WORDS) -> int:
    """64 bits; a bit is set if over half of the shingles' hashes have it. Signed, as stored."""
    words = text.lower().split()
    if not words:
        return 0
    joined = b" ".join(words)
    if len(words) <= words_in:
        hashes = [xxhash.xxh64_intdigest(joined, SEED)]
    else:
        ends = list(accumulate([len(w) + 1 for w in words]))
        starts = [0, *ends[: len(words) - words_in]]
        of = xxhash.xxh64_intdigest
        hashes = [of(joined[a : b - 1], SEED) for a, b in zip(starts, ends[words_in - 1 :])]
    h = np.array(hashes, "<u8")
    ones = np.zeros(64, np.int64)
    for first in range(0, len(h), 1 << 15):
        part = h[first : first + (1 << 15)].view(np.uint8).reshape(-1, 8)
        ones += np.unpackbits(part, axis=1, bitorder="little").sum(0, dtype=np.int64)
    bits = np.packbits(2 * ones > len(h), bitorder="little")
    return int(bits.view("<i8")[0])


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, hash of the text and code of every row."""

    def run(batch):
        codes = [fingerprint(t) for t in batch.column("body").to_pylist()]
        return {"doc_id": batch.column("doc_id"), "own": batch.column("own"), "code": codes}

    body = utf8(text_col)
    picked = docs.select(F.col(id_col).cast("bigint").alias("doc_id"), F.xxhash64(body).alias("own"), body.alias("body"))
    return map_batches(picked, run, "doc_id bigint, own bigint, code bigint")


def _masks() -> np.ndarray:
    """The bits of each pair of chunks."""
    tops = np.cumsum((0, *CHUNKS))
    chunk = [((1 << w) - 1) << int(64 - t - w) for w, t in zip(CHUNKS, tops)]
    return np.array([a | b for a, b in combinations(chunk, 2)], np.uint64)


MASKS = _masks()


def gray_rank(code: np.ndarray) -> np.ndarray:
    """Place of each code in the order in which neighbours differ in one bit."""
    rank = code.astype(np.uint64)
    for shift in (1, 2, 4, 8, 16, 32):
        rank = rank ^ (rank >> np.uint64(shift))
    return rank


def _below_nodes(codes: DataFrame) -> DataFrame:
    """Each entry below its node of each mask."""

    def run(batch):
        code = batch.column("code").to_numpy().astype(np.int64).view(np.uint64)
        n, k = len(code), len(MASKS)
        every = np.tile(code, k)
        mask = np.repeat(np.arange(k), n)
        return {"mask": mask, "node": (every & MASKS[mask]).view(np.int64), "code": every.view(np.int64)}

    return map_batches(codes, run, "mask int, node bigint, code bigint")


def _tops(codes: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Shared bits of each run of so many codes: which bits, and their values."""
    at = np.arange(0, len(codes), size)
    both, some = np.bitwise_and.reduceat(codes, at), np.bitwise_or.reduceat(codes, at)
    shared = ~(both ^ some)
    return shared, both & shared


def spanning_links(codes: np.ndarray, most: int = MOST_BITS) -> tuple[np.ndarray, np.ndarray]:
    """Links that connect what is within reach of each other, among codes in Gray order.

    From each code not reached yet, a search goes on from all that it reaches; what is reached is
    never compared again. Groups whose shared bits differ too much are left out whole.
    """
    n = len(codes)
    leaf_mask, leaf_bits = _tops(codes, LEAF)
    top_mask, top_bits = _tops(codes, LEAF * LEAF)
    left = np.ones(n, bool)
    parents, children = [], []
    for seed in range(n):
        if not left[seed]:
            continue
        left[seed] = False
        queue = [seed]
        while queue:
            own = np.array(queue[:LEAF])
            del queue[:LEAF]
            q = codes[own]
            near = (np.bitwise_count((q[:, None] ^ top_bits) & top_mask) <= most).any(0)
            leaves = (np.flatnonzero(near)[:, None] * LEAF + np.arange(LEAF)).ravel()
            leaves = leaves[leaves < len(leaf_bits)]
            near = (np.bitwise_count((q[:, None] ^ leaf_bits[leaves]) & leaf_mask[leaves]) <= most).any(0)
            at = (leaves[near][:, None] * LEAF + np.arange(LEAF)).ravel()
            at = at[at < n]
            at = at[left[at]]
            if not len(at):
                continue
            close = np.bitwise_count(q[:, None] ^ codes[at]) <= most
            hit = close.any(0)
            found = at[hit]
            left[found] = False
            parents.append(own[close[:, hit].argmax(0)])
            children.append(found)
            queue += found.tolist()
    if not parents:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    return np.concatenate(parents), np.concatenate(children)


def group_links(group: np.ndarray, codes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Links within the groups; equal group numbers are adjacent, codes in Gray order in them."""
    starts = np.flatnonzero(np.r_[True, group[1:] != group[:-1]])
    sizes = np.diff(np.r_[starts, len(group)])
    a, b = [], []
    small = np.repeat(sizes <= LEAF, sizes)
    for step in range(1, min(LEAF, int(sizes.max(initial=1)))):
        i = np.flatnonzero(small[:-step] & (group[:-step] == group[step:]))
        i = i[np.bitwise_count(codes[i] ^ codes[i + step]) <= MOST_BITS]
        a.append(i)
        b.append(i + step)
    for start, size in zip(starts[sizes > LEAF], sizes[sizes > LEAF]):
        u, v = spanning_links(codes[start : start + size])
        a.append(u + start)
        b.append(v + start)
    none = [np.zeros(0, np.int64)]
    return np.concatenate(a or none), np.concatenate(b or none)


def _first_mask(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """The first mask on which both agree."""
    return ((a ^ b)[:, None] & MASKS == 0).argmax(1)


def links(codes: DataFrame, node_rows: int = NODE_ROWS) -> DataFrame:
    """(u, v): links that connect all distinct codes within reach of each other.

    A link found under a mask is kept only if no earlier mask joins the two: under that one they
    are connected already.
    """
    spark = codes.sparkSession
    below = _below_nodes(codes)
    crowded = stage_table(
        below.groupBy("mask", "node").agg(F.count("*").alias("n")).where(F.col("n") > node_rows), "crowded-nodes"
    )
    part = F.pmod(F.xxhash64("code"), F.col("parts"))
    cells = (
        below.join(crowded, ["mask", "node"], "left")
        .withColumn("parts", F.coalesce(F.ceil(F.col("n") / F.lit(node_rows)), F.lit(1)).cast("int"))
        .withColumn("part", part.cast("int"))
        .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))
        .select("mask", "node", F.least("part", "other").alias("low"), F.greatest("part", "other").alias("high"), "code")
        .repartition(int(spark.conf.get("spark.sql.shuffle.partitions")), "mask", "node", "low", "high")
        .sortWithinPartitions("mask", "node", "low", "high")
    )
    schema = to_arrow(spark, "u bigint, v bigint")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = np.zeros((0, 5), np.int64)
        for batch in _and_end(batches):
            if batch is not None:
                new = np.stack([c.to_numpy(zero_copy_only=False).astype(np.int64) for c in batch.columns], 1)
                held = np.concatenate([held, new])
                change = np.flatnonzero((held[1:, :4] != held[:-1, :4]).any(1))
                if not len(change):
                    continue
                done, held = held[: change[-1] + 1], held[change[-1] + 1 :]
            else:
                done = held
            if len(done) < 2:
                continue
            group = np.cumsum(np.r_[0, (done[1:, :4] != done[:-1, :4]).any(1)])
            size = np.bincount(group)
            several = size[group] > 1
            group, done = group[several], done[several]
            code = np.ascontiguousarray(done[:, 4]).view(np.uint64)
            order = np.lexsort((gray_rank(code), group))
            group, code, mask = group[order], code[order], done[order, 0]
            if not len(code):
                continue
            a, b = group_links(group, code)
            first = _first_mask(code[a], code[b]) == mask[a]
            u, v = code[a[first]].view(np.int64), code[b[first]].view(np.int64)
            yield pa.RecordBatch.from_arrays([pa.array(u), pa.array(v)], schema=schema)

    ship(spark)
    return cells.mapInArrow(run, "u bigint, v bigint")


def _and_end(batches: Iterator) -> Iterator:
    yield from batches
    yield None


def members(docs: DataFrame) -> DataFrame:
    """doc_id, own, code, root and component_id of every row. A component is known by its root, as
    its component_id is null if no row of it has an id, and one id may name several."""
    marked = stage_table(fingerprints(docs), "fingerprints")
    codes = stage_table(marked.groupBy("code").agg(F.min("doc_id").alias("first")), "codes")
    roots = components(stage_table(links(codes.select("code")), "links"))
    entries = codes.join(roots.select(F.col("u").alias("code"), F.col("v").alias("root")), "code", "left")
    entries = stage_table(entries.withColumn("root", F.coalesce("root", "code")), "entries")
    least = entries.groupBy("root").agg(F.min("first").alias("component_id"))
    named = entries.join(least, "root").select("code", "root", "component_id")
    return marked.join(stage_table(named, "named"), "code").select("doc_id", "own", "code", "root", "component_id")


def near_duplicates(docs: DataFrame) -> DataFrame:
    """doc_id, code and component_id of every row."""
    return members(docs).select("doc_id", "code", "component_id")


def keep_one(docs: DataFrame) -> DataFrame:
    """One row of each component: of those with its smallest id (of all, if none has an id) the one
    with the smallest hash of its text. Copies of that row under the same id go as well."""
    rows = stage_table(members(docs), "members")
    first = F.col("doc_id").eqNullSafe(F.col("component_id"))
    kinds = stage_table(rows.where(first).groupBy("root", "doc_id", "own").agg(F.count("*").alias("n")), "first-kinds")
    kept = kinds.groupBy("root").agg(F.min("own").alias("own"))
    key = F.col("doc_id").alias("_sim_id"), F.col("own").alias("_sim_own")
    again = stage_table(kinds.where("n > 1").join(kept, ["root", "own"], "left_semi").select(*key), "repeated-rows")
    others = kinds.join(kept, ["root", "own"], "left_anti").select(*key)
    gone = stage_table(rows.where(~first).select(*key).distinct().union(others).union(again), "gone")
    keyed = docs.withColumns({"_sim_doc": F.col("doc_id").cast("bigint"), "_sim_text": F.xxhash64(utf8("text"))})
    same = F.col("_sim_doc").eqNullSafe(F.col("_sim_id")) & (F.col("_sim_text") == F.col("_sim_own"))
    once = keyed.join(gone, same, "left_anti")
    one = keyed.join(again, same, "left_semi").dropDuplicates(["_sim_doc", "_sim_text"])
    return once.union(one).drop("_sim_doc", "_sim_text")


@query("op2_simhash_near_dedup")
def op2_simhash_near_dedup(spark: SparkSession, sf: str) -> DataFrame:
    return near_duplicates(table(spark, sf, "documents")).select(
        "doc_id", F.lpad(F.lower(F.hex("code")), 16, "0").alias("fingerprint"), "component_id"
    )
