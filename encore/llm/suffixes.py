"""Removal of repeated passages by merging Burrows-Wheeler transforms of shards.

A byte goes if some string of ``LENGTH`` bytes that covers it also starts anywhere else in the
corpus. Finding all such strings takes three steps, each exact.

1. Every start in a text is owned by a content-defined anchor: the least hash of a 200-byte gram in
   the string that starts there. Neighbouring starts share an anchor and form a segment. Equal
   strings have equal anchors at equal distances, so a string can repeat only among segments whose
   anchors' grams occur twice or more.
2. Segments that occur twice as a whole are repeated as a whole. What is left are segments at the
   edges of repeats; one copy of each kind is cut from its text, with the kinds it may match.
3. Those kinds are dealt out by anchor and split into shards. A shard's suffixes are sorted into
   its Burrows-Wheeler transform over an alphabet of blocks of a quarter of the length, 100 bytes (a
   text read at each of 100 phases). The shards' transforms are merged by refining their interleave: each round orders
   suffixes by one more block, without comparing them, and splits the intervals of suffixes alike
   so far. After four rounds, 400 bytes, an interval of two or more is a repeated string.

Kinds of an anchor that has more than ``CROWD`` of them, a passage with very many surroundings,
don't meet in one task: their strings are hashed and counted, with counts combined before the
shuffle. Blocks of neighbouring starts that repeat as a whole are found first, and strings are
counted of one copy of each kind of block, so a passage costs a row for each block and kind.

``length`` sets the least length of a repeat, a multiple of four; 400 unless given. ``gram`` sets the
anchors' grams, half of the length unless given: shorter ones make fewer segments and more suspects,
and change no result.

Defined cases. A null text counts as empty; texts under that length stay whole. Rows are documents:
repeated rows are copies of each other, and go whole. Overlaps count, in one text too. An empty
table gives an empty result. ``remove_repeats`` passes other columns through, but for names that
begin with ``_sfx_``, and cuts at whole characters.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from encore.llm.base import map_batches, query, ship, table, to_arrow, utf8
from encore.session import stage_table

LENGTH = 400
#: Rounds of refinement, each by one block of the length.
ROUNDS = 4
SHARDS = 4
#: Most kinds of one anchor that meet in one task.
CROWD = 512
#: Starts of a crowded anchor's kinds that are looked at as one before single ones.
BLOCK = 16
#: Suffixes merged at a time.
SUFFIXES = 400_000
#: Longest slice of a text that is hashed at once.
SLICE = 1 << 17

_RNG = np.random.default_rng(20)
_TABLE = _RNG.integers(1, 2**63, 256, dtype=np.uint64)
_BASE = 0x5851F42D4C957F2D
_ODD = np.uint64(0x9E3779B97F4A7C15)


def _powers(base: int, n: int) -> np.ndarray:
    out = np.ones(n, np.uint64)
    k = 1
    while k < n:
        step = min(k, n - k)
        out[k : k + step] = out[:step] * np.uint64(pow(base, k, 2**64))
        k += step
    return out


_POWER = _powers(_BASE, SLICE + 1)
_INVERSE = _powers(pow(_BASE, -1, 2**64), SLICE + 1)


def _mix(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(33))) * np.uint64(0xFF51AFD7ED558CCD)
    return h ^ (h >> np.uint64(29))


def _sums(text: bytes) -> np.ndarray:
    """Sums whose differences, times a power, hash every substring alike wherever it stands."""
    codes = _TABLE[np.frombuffer(text, np.uint8)] * _INVERSE[: len(text)]
    return np.concatenate([np.zeros(1, np.uint64), np.cumsum(codes, dtype=np.uint64)])


def gram_hashes(sums: np.ndarray, size: int) -> np.ndarray:
    return _mix((sums[size:] - sums[:-size]) * _POWER[: len(sums) - size])


def segments(text: bytes, length: int = LENGTH, gram: int = LENGTH // 2) -> np.ndarray:
    """Rows (first start, last start, anchor, hash of its gram, hash of the segment)."""
    parts = []
    for at in range(0, max(1, len(text) - length + 1), SLICE - length + 1):
        part = text[at : at + SLICE]
        if len(part) < length:
            break
        sums = _sums(part)
        grams = gram_hashes(sums, gram)
        least = (grams & np.uint64(0xFFFFFFFF00000000)) | np.arange(len(grams), dtype=np.uint64)
        width, window = 1, length - gram + 1
        while 2 * width <= window:
            least = np.minimum(least[:-width], least[width:])
            width *= 2
        if rest := window - width:
            least = np.minimum(least[:-rest], least[rest:])
        anchor = (least & np.uint64(0xFFFFFFFF)).astype(np.int64)
        cut = np.flatnonzero(anchor[1:] != anchor[:-1]) + 1
        first, last = np.r_[0, cut], np.r_[cut, len(anchor)] - 1
        own = (sums[last + length] - sums[first]) * _POWER[first]
        whole = _mix(own + (last - first).astype(np.uint64) * _ODD)
        at_gram = anchor[first]
        parts.append(
            np.stack([first + at, last + at, at_gram + at, grams[at_gram].view(np.int64), whole.view(np.int64)])
        )
    return np.concatenate(parts, 1) if parts else np.zeros((5, 0), np.int64)


KEY = ["doc_id", "_sfx_text"]
_KEYS = "doc_id bigint, _sfx_text bigint, "


def _keyed(docs: DataFrame) -> DataFrame:
    """Rows are told apart by id and text."""
    body = utf8("text")
    return docs.select(
        F.col("doc_id").cast("bigint").alias("doc_id"), F.xxhash64(body).alias("_sfx_text"), body.alias("body")
    )


def all_segments(keyed: DataFrame, length: int = LENGTH, gram: int = LENGTH // 2) -> DataFrame:
    def run(batch):
        found = [segments(t, length, gram) for t in batch.column("body").to_pylist()]
        owner = np.repeat(np.arange(len(found)), [f.shape[1] for f in found])
        rows = np.concatenate(found, 1)
        return {n: batch.column(n).take(pa.array(owner)) for n in KEY} | dict(
            zip(("first", "last", "anchor", "gram", "whole"), rows)
        )

    return map_batches(
        keyed, run, _KEYS + "first bigint, last bigint, anchor bigint, gram bigint, whole bigint"
    )


def _same_row(left: DataFrame, right: DataFrame, how: str) -> DataFrame:
    """Join on the row key; a null id equals a null id. The key of the right side is dropped."""
    right = right.withColumnsRenamed({n: f"_r{n}" for n in KEY})
    on = [left[n].eqNullSafe(right[f"_r{n}"]) for n in KEY]
    return left.join(right, on, how).drop(*[f"_r{n}" for n in KEY])


# --- transforms and their merge ---------------------------------------------------------------


def shard_transform(columns: np.ndarray, string: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Order of a shard's suffixes. columns: their blocks in turn (0 after the end), of small
    numbers; string: which string each is a suffix of, the last key."""
    keys = []
    for k in range(0, len(columns), 2):  # two columns of under 2**31 a key
        low = columns[k + 1] if k + 1 < len(columns) else 0
        keys.append((columns[k] << 31) | low)
    return np.lexsort((string, *keys[::-1]))


def merge_transforms(
    transforms: list[np.ndarray], rounds: int
) -> tuple[np.ndarray, np.ndarray]:
    """Interleave of the shards' suffixes, right to so many symbols, and the interval of each.

    A transform lists, in suffix order, the symbol before each suffix: 0 where there is none. The
    suffixes made of nothing but their end come first, shard by shard, each an interval of its own.
    """
    sizes = [len(t) for t in transforms]
    source = np.repeat(np.arange(len(transforms)), sizes)
    interval = np.zeros(len(source), np.int64)
    ends = np.repeat(np.arange(len(transforms)), [int((t == 0).sum()) for t in transforms])
    for _ in range(rounds):
        symbol = np.empty(len(source), np.int64)
        for s, t in enumerate(transforms):
            symbol[source == s] = t
        order = np.argsort(symbol, kind="stable")
        source, symbol, interval = source[order], symbol[order], interval[order]
        source[: len(ends)] = ends
        split = np.r_[True, (symbol[1:] != symbol[:-1]) | (interval[1:] != interval[:-1])]
        split[: len(ends) + 1] = True
        interval = np.cumsum(split) - 1
    return source, interval


def repeated_starts(
    bodies: list[bytes], length: int = LENGTH, block: int | None = None, shards: int = SHARDS
) -> list[np.ndarray]:
    """For each body, where strings of that length start that also start elsewhere among all."""
    block = block or length // ROUNDS
    blocks, place, body = [], [], []
    for k, b in enumerate(bodies):
        n = len(b) + 1
        own = np.zeros(n, np.uint64)
        if len(b) >= block:
            own[: n - block] = gram_hashes(_sums(b), block) | np.uint64(1)
        blocks.append(own)
        place.append(np.arange(n))
        body.append(np.full(n, k))
    place, body = np.concatenate(place), np.concatenate(body)
    _, symbol = np.unique(np.concatenate([np.zeros(1, np.uint64), *blocks]), return_inverse=True)
    symbol = symbol[1:].astype(np.int64)  # 0: no whole block is left
    n = len(symbol)
    sizes = np.array([len(b) + 1 for b in bodies])
    left = np.repeat(np.cumsum(sizes), sizes) - np.arange(n)  # suffixes up to the body's end
    most = -(-int(sizes.max()) // block)
    columns = np.zeros((most, n), np.int64)
    for j in range(most):
        at = np.arange(n) + j * block
        ok = left > j * block
        columns[j, ok] = symbol[at[ok]]
    before = np.where(place >= block, symbol[np.maximum(np.arange(n) - block, 0)], 0)
    string = body * block + place % block
    orders, transforms = [], []
    for s in range(min(shards, len(bodies))):
        own = np.flatnonzero(body % shards == s)
        order = own[shard_transform(columns[:, own], string[own])]
        orders.append(order)
        transforms.append(before[order])
    source, interval = merge_transforms(transforms, length // block)
    suffix = np.empty(n, np.int64)
    for s, order in enumerate(orders):
        suffix[source == s] = order
    repeated = np.bincount(interval)[interval] > 1
    hit = np.zeros(n, bool)
    hit[suffix[repeated]] = True
    hit &= left > length  # the string is whole
    return [np.flatnonzero(h) for h in np.split(hit, np.cumsum(sizes)[:-1])]


# --- the operator -----------------------------------------------------------------------------


def _spans(starts: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray]:
    """Runs of starts as covered bytes."""
    cut = np.flatnonzero(np.diff(starts) > 1) + 1
    return starts[np.r_[0, cut]], starts[np.r_[cut, len(starts)] - 1] + length


SPAN = _KEYS + "from bigint, to bigint"


def _merged_spans(pieces: DataFrame, length: int) -> DataFrame:
    """Spans of single kinds that repeat in part, by merging transforms of whole anchors' kinds."""
    spark = pieces.sparkSession
    schema = to_arrow(spark, SPAN)
    dealt = pieces.repartition(int(spark.conf.get("spark.sql.shuffle.partitions")), "gram")
    dealt = dealt.sortWithinPartitions("gram", *KEY, "first").select("gram", "n", *KEY, "first", "body")

    def spans_of(rows: list[tuple]) -> pa.RecordBatch:
        columns: list[list] = [[], [], [], []]
        for (_, n, doc_id, text, first, _), at in zip(rows, repeated_starts([r[5] for r in rows], length)):
            if n == 1 and len(at):
                for a, b in zip(*_spans(at, length)):
                    for c, v in zip(columns, (doc_id, text, first + int(a), first + int(b))):
                        c.append(v)
        return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], schema=schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows: list[tuple] = []
        size = 0
        for batch in batches:
            for row in zip(*[c.to_pylist() for c in batch.columns]):
                if size >= SUFFIXES and row[0] != rows[-1][0]:
                    yield spans_of(rows)
                    rows, size = [], 0
                rows.append(row)
                size += len(row[5])
        if rows:
            yield spans_of(rows)

    ship(spark)
    return dealt.mapInArrow(run, SPAN)


def _counted_spans(pieces: DataFrame, length: int) -> DataFrame:
    """The same for crowded anchors, by counting the strings' hashes."""

    def run(batch):
        starts, grams, strings, owner = [], [], [], []
        bodies, first = batch.column("body").to_pylist(), batch.column("first").to_numpy()
        for k, b in enumerate(bodies):
            h = gram_hashes(_sums(b), length)
            strings.append(h.view(np.int64))
            starts.append(first[k] + np.arange(len(h)))
            owner.append(np.full(len(h), k))
        at = pa.array(np.concatenate(owner))
        return {n: batch.column(n).take(at) for n in ("gram", "n", *KEY)} | {
            "start": np.concatenate(starts), "string": np.concatenate(strings)}

    strings = map_batches(
        pieces.select("gram", "n", *KEY, "first", "body"), run,
        "gram bigint, n bigint, " + _KEYS + "start bigint, string bigint",
    )
    again = strings.groupBy("gram", "string").agg(F.count("*").alias("c")).where("c > 1").drop("c")
    hit = strings.where("n = 1").join(again, ["gram", "string"], "left_semi")
    return hit.select(*KEY, F.col("start").alias("from"), (F.col("start") + length).alias("to"))


def _counted_blocks(pieces: DataFrame, length: int) -> DataFrame:
    """The spans of ``_counted_spans``, by blocks: neighbouring starts at the same distances from the
    anchor. Equal strings lie in blocks of the same distances, so blocks that occur twice repeat as a
    whole, and one copy of each is enough for the strings of the others. Needs ``anchor`` as well."""

    def run(batch):
        columns = {c: [] for c in ("at", "size", "block")}
        owner = []
        firsts, anchors = (batch.column(c).to_numpy() for c in ("first", "anchor"))
        for k, b in enumerate(batch.column("body").to_pylist()):
            sums, starts = _sums(b), len(b) - length + 1
            cell = (anchors[k] - firsts[k] - np.arange(starts)) // BLOCK
            cut = np.flatnonzero(cell[1:] != cell[:-1]) + 1
            low, high = np.r_[0, cut], np.r_[cut, starts]
            far = (anchors[k] - firsts[k] - low).astype(np.uint64)
            own = (sums[high - 1 + length] - sums[low]) * _POWER[low]
            own = _mix(own + far * _ODD) + (high - low).astype(np.uint64)
            columns["at"].append(firsts[k] + low)
            columns["size"].append(high - low)
            columns["block"].append(_mix(own).view(np.int64))
            owner.append(np.full(len(low), k))
        at = pa.array(np.concatenate(owner))
        return {n: batch.column(n).take(at) for n in ("gram", "n", *KEY, "first")} | {
            c: np.concatenate(v) for c, v in columns.items()}

    blocks = map_batches(
        pieces.select("gram", "n", *KEY, "first", "anchor", "body"), run,
        "gram bigint, n bigint, " + _KEYS + "first bigint, at bigint, size bigint, block bigint",
    )
    blocks = stage_table(blocks, "blocks")
    kinds = stage_table(
        blocks.groupBy("gram", "block").agg(
            F.count("*").alias("c"), F.min(F.struct(*KEY, "first", "at", "size", "n")).alias("one")
        ),
        "block-kinds",
    )
    again = kinds.where("c > 1").select("gram", "block")
    whole = blocks.where("n = 1").join(again, ["gram", "block"], "left_semi")
    copies = kinds.select("one.*", "c").withColumn("n", F.expr("if(c = 1, n, 2)")).groupBy(*KEY, "first")
    copies = copies.agg(F.collect_list(F.struct("at", "size", "n")).alias("cells"))
    cut = _same_row(pieces.select("gram", *KEY, "first", "body"), copies.withColumnRenamed("first", "_own"), "inner")
    cut = cut.where("first = _own").withColumn("cell", F.explode("cells"))
    cell = F.col("cell")
    parts = cut.select(
        "gram", "cell.n", *KEY, cell["at"].alias("first"),
        F.substring(F.col("body"), (cell["at"] - F.col("first") + 1).cast("int"), (cell["size"] + (length - 1)).cast("int")).alias("body"),
    )
    spans = whole.select(*KEY, F.col("at").alias("from"), (F.col("at") + F.col("size") + (length - 1)).alias("to"))
    return spans.union(_counted_spans(parts, length))


def repeated_spans(
    docs: DataFrame, crowd: int = CROWD, length: int = LENGTH, gram: int | None = None
) -> DataFrame:
    """For each row with repeated bytes: doc_id, _sfx_text, _sfx_spans (from, to; may overlap)."""
    if length < ROUNDS or length % ROUNDS:
        raise ValueError(f"the length must be a multiple of {ROUNDS}")
    gram = gram or length // 2
    keyed = _keyed(docs)
    every = stage_table(all_segments(keyed, length, gram), "segments")
    twice = every.groupBy("gram").agg(F.count("*").alias("c")).where("c > 1").select("gram")
    suspects = stage_table(every.join(stage_table(twice, "grams"), "gram"), "suspects")
    kinds = stage_table(
        suspects.groupBy("gram", "whole").agg(
            F.count("*").alias("n"), F.min(F.struct(*KEY, "first", "last", "anchor")).alias("at")
        ),
        "kinds",
    )
    whole = suspects.join(kinds.where("n > 1").select("gram", "whole"), ["gram", "whole"]).select(
        *KEY, F.col("first").alias("from"), (F.col("last") + length).alias("to")
    )
    open_ = kinds.groupBy("gram").agg(
        F.count("*").alias("kinds"), F.sum((F.col("n") == 1).cast("bigint")).alias("single")
    )
    open_ = stage_table(open_.where("kinds > 1 AND single > 0").select("gram", "kinds"), "open-grams")
    wanted = (
        kinds.join(open_, "gram")
        .select("gram", "n", (F.col("kinds") > crowd).alias("crowded"), "at.*")
        .groupBy(*KEY)
        .agg(F.collect_list(F.struct("gram", "n", "crowded", "first", "last", "anchor")).alias("cuts"))
    )
    # Copies of a text under one id are cut once only.
    texts = _same_row(keyed, wanted, "inner").dropDuplicates(KEY)
    cut = F.col("cut")
    pieces = stage_table(
        texts.withColumn("cut", F.explode("cuts")).select(
            "cut.gram", "cut.n", "cut.crowded", "cut.first", "cut.anchor", *KEY,
            F.substring(F.col("body"), (cut["first"] + 1).cast("int"), (cut["last"] - cut["first"] + length).cast("int")).alias("body"),
        ),
        "pieces",
    )
    spans = (
        whole.union(_merged_spans(pieces.where("NOT crowded"), length))
        .union(_counted_blocks(pieces.where("crowded"), length))
    )
    return stage_table(
        spans.groupBy(*KEY).agg(F.collect_list(F.struct("from", "to")).alias("_sfx_spans")), "spans"
    )


def runs_of(spans: list[dict] | None) -> list[tuple[int, int]]:
    """Spans as disjoint, maximal runs."""
    out: list[tuple[int, int]] = []
    for a, b in sorted((s["from"], s["to"]) for s in spans or ()):
        if out and a <= out[-1][1]:
            out[-1] = out[-1][0], max(b, out[-1][1])
        else:
            out.append((a, b))
    return out


def without(text: bytes, runs: list[tuple[int, int]]) -> bytes:
    kept, at = [], 0
    for a, b in runs:
        kept.append(text[at:a])
        at = b
    return b"".join([*kept, text[at:]])


def whole_characters(text: bytes, runs: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """The runs, drawn in to whole characters."""
    inside = lambda i: i < len(text) and text[i] & 0xC0 == 0x80
    out = []
    for a, b in runs:
        while inside(a):
            a += 1
        while inside(b):
            b -= 1
        out.append((a, b))
    return out


def remove_repeats(docs: DataFrame, length: int = LENGTH, gram: int | None = None) -> DataFrame:
    """``docs`` with the repeated bytes gone from ``text``; all other columns as they are."""
    key = {"_sfx_id": F.col("doc_id").cast("bigint"), "_sfx_own": F.xxhash64(utf8("text"))}
    spans = repeated_spans(docs, length=length, gram=gram).withColumnsRenamed({"doc_id": "_sfx_r_id"})
    both = docs.withColumns(key).join(
        spans, F.col("_sfx_id").eqNullSafe(F.col("_sfx_r_id")) & (F.col("_sfx_own") == F.col("_sfx_text")), "left"
    )
    place, spark = docs.columns.index("text"), docs.sparkSession

    def run(batches):
        for batch in batches:
            texts = batch.column(place).to_pylist()
            for i, spans in enumerate(batch.column(batch.num_columns - 1).to_pylist()):
                if spans:
                    body = texts[i].encode()
                    texts[i] = without(body, whole_characters(body, runs_of(spans))).decode()
            columns = batch.columns[:-1]
            columns[place] = pa.array(texts, columns[place].type)
            yield pa.RecordBatch.from_arrays(columns, names=batch.schema.names[:-1])

    ship(spark)
    return both.select(*[both[c] for c in docs.columns], "_sfx_spans").mapInArrow(run, docs.schema)


@query("op6_suffix_array_dedup")
def op6_suffix_array_dedup(spark: SparkSession, sf: str) -> DataFrame:
    """The contract's digests, and what is left of each text, at whole characters."""
    docs = table(spark, sf, "documents").select("doc_id", "text")
    both = _same_row(_keyed(docs), repeated_spans(docs), "left").select("doc_id", "body", "_sfx_spans")

    def run(batch):
        bodies = batch.column("body").to_pylist()
        runs = [runs_of(s) for s in batch.column("_sfx_spans").to_pylist()]
        return {
            "doc_id": batch.column("doc_id"),
            "n_bytes": [len(b) for b in bodies],
            "n_removed": [sum(b - a for a, b in r) for r in runs],
            "n_spans": [len(r) for r in runs],
            "kept_sha256": [hashlib.sha256(without(b, r)).hexdigest() for b, r in zip(bodies, runs)],
            "text": [without(b, whole_characters(b, r)).decode() for b, r in zip(bodies, runs)],
        }

    return map_batches(
        both, run, "doc_id bigint, n_bytes bigint, n_removed bigint, n_spans bigint, kept_sha256 string, text string"
    )
