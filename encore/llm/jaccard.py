"""Near-duplicates by the Jaccard similarity of word n-grams, joined on adaptive multi-match
prefixes.

Documents with one set of shingles are one class, known by a hash of the set. The shingles of a
class stand in one order for the whole corpus, rare ones first, as a count table of fixed size
estimates them. Of a set of n shingles, any partner shares at least 0.8 n, so two partners share at
least m of their first n - ceil(0.8 n) + m shingles, for every m. Each class picks the m for
which its prefix is estimated to cost least: a longer prefix means longer lists to join, but fewer
candidates, as m shared shingles are asked for. A pair uses the smaller m of its two classes, and
the prefix length that their two sizes allow; shingles that no other prefix holds must leave enough
to share. Candidates are verified on whole sets.

Only links that connect are sought, never all pairs of a group. Rounds first try each class
against one hub of a list that it isn't connected with yet, so a group of thousands of near copies
takes a linear number of verifications; then every pair of classes that share a list and are
still unconnected is a candidate. A list that the count table expects to be long is dealt over
parts before it is sought out, and a hub with very many tries over parts as well.

Defined cases. A null text counts as empty; a text without words has no shingles and links with
nothing; one with fewer than five words has its whole sequence as one shingle. Repeated rows each
get a row. A row without an id is linked but can't name its component, which is null if none of its
rows has an id. An empty table gives an empty result. Other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from encore.llm.base import Memo, likely, map_batches, query, ship, table, to_arrow, utf8
from encore.llm.components import components
from encore.session import stage_table

SHINGLE_WORDS = 5
#: Links need 100 * intersection >= PERCENT * union.
PERCENT = 80
#: Bits of a shingle's hash that choose its counter.
TABLE_BITS = 18
#: Most matches that a prefix may ask for.
MOST_MATCHES = 8
#: Others expected to hold a shingle by chance, below what the counters can tell.
CHANCE = 0.05
#: Estimated costs, in entries of a list read: to deal out a prefix shingle, to verify a candidate,
#: and for each shingle that the verification compares.
DEAL, VERIFY, COMPARE = 1.0, 20.0, 0.05
#: A list expected to be longer is dealt over parts; so is a hub with more tries.
PART_ROWS = 1 << 14
HUB_ROWS = 1 << 12
#: Most rounds with hubs, and the checks for each list row below which they end earlier.
ROUNDS, FEW_CHECKS = 6, 16

_MIX, _SHIFT = np.uint64(0x9E3779B97F4A7C15), np.uint64(29)


def shingle_set(text: bytes, words_of: Memo) -> np.ndarray:
    """Sorted 64-bit hashes of the distinct shingles."""
    words = text.lower().split()
    if not words:
        return np.zeros(0, np.uint64)
    if len(words_of) > words_of.limit:
        words_of.clear()
    h = np.fromiter(map(words_of.__getitem__, words), np.uint64, len(words))
    width = min(len(h), SHINGLE_WORDS)
    end = len(h) - width + 1
    out = np.full(end, width, np.uint64)
    for k in range(width):
        out = (out ^ h[k : k + end]) * _MIX
        out ^= out >> _SHIFT
    return np.unique(out)


def class_key(shingles: np.ndarray) -> int:
    return int(np.uint64(xxhash.xxh64_intdigest(shingles.tobytes(), len(shingles))).view(np.int64))


def counters(shingles: np.ndarray) -> np.ndarray:
    return (shingles >> np.uint64(64 - TABLE_BITS)).astype(np.int64)


def describe(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, own (hash of the text), key and n of every row; beside them, as rows of their own,
    bucket and count: how many shingles of a task's distinct classes have each counter."""
    spark = docs.sparkSession
    names = "doc_id bigint, own bigint, key bigint, n int, bucket int, count bigint"
    schema = to_arrow(spark, names)

    def batch_of(doc_id, own, key, n, bucket, count):
        none = max(len(key), len(bucket))
        columns = [c if len(c) else pa.nulls(none, f.type) for c, f in zip((doc_id, own, key, n, bucket, count), schema)]
        return pa.RecordBatch.from_arrays([c if isinstance(c, pa.Array) else pa.array(c, f.type) for c, f in zip(columns, schema)], schema=schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words_of, seen = Memo(xxhash.xxh64_intdigest), set()
        counts = np.zeros(1 << TABLE_BITS, np.int64)
        for batch in batches:
            if not batch.num_rows:
                continue
            keys, sizes, new = [], [], [np.zeros(0, np.int64)]
            for text in batch.column("body"):
                s = shingle_set(text.as_py(), words_of)
                key = class_key(s) if len(s) else None
                keys.append(key)
                sizes.append(len(s))
                if key is not None and key not in seen:
                    seen.add(key)
                    new.append(counters(s))
            counts += np.bincount(np.concatenate(new), minlength=len(counts))
            yield batch_of(batch.column("doc_id"), batch.column("own"), keys, sizes, [], [])
        used = np.flatnonzero(counts)
        if len(used):
            yield batch_of([], [], [], [], used, counts[used])

    ship(spark)
    return _picked(docs, id_col, text_col).mapInArrow(run, names)


def _picked(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    body = utf8(text_col)
    return docs.select(F.col(id_col).cast("bigint").alias("doc_id"), F.xxhash64(body).alias("own"), body.alias("body"))


def estimates(described: DataFrame) -> np.ndarray:
    """How many classes hold a shingle, by counter: the counter less what others put on it."""
    counted = described.where("bucket is not null").groupBy("bucket").agg(F.sum("count").alias("count")).toArrow()
    out = np.zeros(1 << TABLE_BITS)
    out[counted.column("bucket").to_numpy()] = counted.column("count").to_numpy()
    return (np.maximum(out - out.mean(), 0) + CHANCE).astype(np.float32)


def least_overlap(n: int) -> int:
    return (PERCENT * n + 99) // 100


def matches(held_by: np.ndarray) -> int:
    """How many matches the prefix asks for; ``held_by``: estimates in the corpus's order."""
    n = len(held_by)
    need = least_overlap(n)
    ask = np.arange(1, min(MOST_MATCHES, need) + 1)
    lists = np.cumsum(held_by[: n - need + len(ask)], dtype=np.float64)[n - need + ask - 1]
    return int(ask[np.argmin(DEAL * ask + lists + (VERIFY + COMPARE * n) * lists / ask)])


def prefixes(docs: DataFrame, held_by: np.ndarray, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """token, key, n, pos, asks and parts of each prefix shingle; a class may come once a task."""
    spark = docs.sparkSession
    names = "token bigint, key bigint, n int, pos int, asks int, parts int"
    schema = to_arrow(spark, names)
    table_of = spark.sparkContext.broadcast(held_by)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words_of, seen, held_by = Memo(xxhash.xxh64_intdigest), set(), table_of.value
        for batch in batches:
            out = []
            for text in batch.column("body"):
                s = shingle_set(text.as_py(), words_of)
                key = class_key(s)
                if not len(s) or key in seen:
                    continue
                seen.add(key)
                held = held_by[counters(s)]
                order = np.lexsort((s, held))
                held = held[order]
                asks = matches(held)
                k = len(s) - least_overlap(len(s)) + asks
                rows = np.empty((6, k), np.int64)
                rows[0] = s[order[:k]].view(np.int64)
                rows[1:5] = np.array([[key], [len(s)], [0], [asks]])
                rows[3] = np.arange(k)
                rows[5] = 1 + (held[:k] / PART_ROWS).astype(np.int64)
                out.append(rows)
            if out:
                flat = np.concatenate(out, 1)
                yield pa.RecordBatch.from_arrays([pa.array(c).cast(f.type) for c, f in zip(flat, schema)], schema=schema)

    ship(spark)
    return _picked(docs, id_col, text_col).mapInArrow(run, names)


def shared_lists(prefix_rows: DataFrame) -> DataFrame:
    """The prefix rows whose token another class has in its prefix too: token, key, n, pos, asks and
    rank, the row's place among those of its class. Shingles that no other prefix holds can't be
    shared, so a pair's last shared prefix shingle has a rank of what the pair asks for at least,
    and few such shingles before it; classes without a row that can be that are left out."""
    own = Window.partitionBy("token", "part")
    # Copies of a class are dropped after the window, from the few rows left: with one exchange for both.
    shared = (
        prefix_rows.withColumn("part", F.pmod("key", F.col("parts").cast("bigint")).cast("int"))
        .withColumns({"low": F.min("key").over(own), "high": F.max("key").over(own), "least": F.min("asks").over(own)})
        .where("low <> high or parts > 1")
        .dropDuplicates(["token", "part", "key"])
        .select("token", "key", "n", "pos", "asks", F.expr("if(parts > 1, 1, least)").alias("least"))
    )
    one = Window.partitionBy("key")
    ranked = shared.withColumn("rank", F.row_number().over(one.orderBy("pos")))
    able = (F.col("rank") >= F.col("least")) & (100 * (F.col("pos") + 1 - F.col("rank")) <= (100 - PERCENT) * F.col("n"))
    ranked = ranked.withColumn("able", F.max(able).over(one)).where("able")
    ranked = stage_table(ranked.select("token", "key", "n", "pos", "asks", "rank"), "ranked")
    return ranked.join(telling(ranked), "token", "left_semi")


def telling(ranked: DataFrame) -> DataFrame:
    """The tokens that several classes hold, but of those that the very same classes hold only the
    first few: both bounds of ``_meets`` only get worse along the corpus's order, so a pair that meets
    on a later one meets on these, which are as many as any pair asks for."""
    held = ranked.groupBy("token").agg(
        F.count("*").alias("held"), F.bit_xor(F.xxhash64("key")).alias("x"),
        F.sum(F.xxhash64("key", F.lit(1)) % (1 << 32)).alias("s"), F.min(F.struct("key", "pos")).alias("first"),
    )
    alike = Window.partitionBy("held", "x", "s", "first.key").orderBy("first.pos")
    return held.where("held > 1").withColumn("turn", F.row_number().over(alike)).where(F.col("turn") <= MOST_MATCHES).select("token")


def shingle_sets(docs: DataFrame, described: DataFrame, lists: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """key and shingles of the classes in ``lists``, from one row of each (rows alike apart)."""
    wanted = described.join(lists.select("key").distinct(), "key", "left_semi")
    one = wanted.groupBy("key").agg(F.min(F.struct("own", "doc_id")).alias("row"))
    one = stage_table(one.select(F.col("row.own").alias("o"), F.col("row.doc_id").alias("d")), "class-rows")
    picked = likely(_picked(docs, id_col, text_col), F.col("own"), one.select("o"))
    # Not a semi-join: Spark would push that below the filter and send all texts out.
    rows = picked.join(one.distinct(), (F.col("own") == F.col("o")) & F.col("doc_id").eqNullSafe(F.col("d"))).drop("o", "d")
    words_of = Memo(xxhash.xxh64_intdigest)

    def run(batch):
        sets = [shingle_set(t.as_py(), words_of) for t in batch.column("body")]
        ends = np.r_[0, np.cumsum([len(s) for s in sets])].astype(np.int32)
        return {
            "key": [class_key(s) for s in sets],
            "shingles": pa.ListArray.from_arrays(pa.array(ends), pa.array(np.concatenate(sets).view(np.int64))),
        }

    return map_batches(rows, run, "key bigint, shingles array<bigint>")


def _overlap_needed(n: Column, m: Column) -> Column:
    """Least intersection of two sets of these sizes that link."""
    both = PERCENT * (n + m)
    return F.floor((both + (99 + PERCENT)) / (100 + PERCENT)).cast("int")


def _meets(a: str, b: str) -> Column:
    """Whether the shared token lies in both prefixes, as long as the two sizes allow, and the
    shingles before it that no other prefix holds leave enough to share."""
    asks = F.least(f"{a}.asks", f"{b}.asks")
    need = _overlap_needed(F.col(f"{a}.n"), F.col(f"{b}.n"))

    def side(x: str) -> Column:
        spare, pos, rank = F.col(f"{x}.n") - need, F.col(f"{x}.pos"), F.col(f"{x}.rank")
        return (pos < spare + asks) & (pos + 1 - rank <= spare)

    return side(a) & side(b)


def verified(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """u and v of the pairs (hub, member) whose sets are similar enough. The sets of a hub's members
    stream past the hub's own; a hub with very many members is dealt over parts."""
    spark = pairs.sparkSession
    crowded = stage_table(pairs.groupBy("hub").agg(F.count("*").alias("tries")).where(F.col("tries") > HUB_ROWS), "crowded-hubs")
    parts = F.coalesce(F.ceil(F.col("tries") / HUB_ROWS), F.lit(1))
    dealt = pairs.join(crowded, "hub", "left").select("hub", "member", F.pmod(F.xxhash64("member"), parts).cast("int").alias("part"))
    sets = likely(sets, F.col("key"), pairs.select(F.explode(F.array("hub", "member"))))
    hubs = dealt.select("hub", "part").distinct().join(sets, F.col("hub") == F.col("key"))
    members = dealt.join(sets, F.col("member") == F.col("key"))
    rows = hubs.select("hub", "part", F.lit(0).alias("role"), "key", "shingles").union(
        members.select("hub", "part", F.lit(1), "key", "shingles")
    )
    schema = to_arrow(spark, "u bigint, v bigint")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hub, own = None, None
        for batch in batches:
            found = []
            names, roles, keys = (batch.column(c).to_numpy() for c in ("hub", "role", "key"))
            lists = batch.column("shingles")
            flat, ends = lists.values.to_numpy().view(np.uint64), lists.offsets.to_numpy()
            for i in range(len(names)):
                s = flat[ends[i] : ends[i + 1]]
                if roles[i] == 0:
                    hub, own = names[i], s.copy()
                    continue
                at = np.minimum(np.searchsorted(own, s), len(own) - 1)
                both = int((own[at] == s).sum())
                if 100 * both >= PERCENT * (len(own) + len(s) - both):
                    found.append((hub, keys[i]))
            if found:
                u, v = np.array(found, np.int64).T
                yield pa.RecordBatch.from_arrays([pa.array(u), pa.array(v)], schema=schema)

    ship(spark)
    return (
        rows.repartition(int(spark.conf.get("spark.sql.shuffle.partitions")), "hub", "part")
        .sortWithinPartitions("hub", "part", "role")
        .mapInArrow(run, "u bigint, v bigint")
    )


def _rooted(lists: DataFrame, roots: DataFrame) -> DataFrame:
    known = roots.select(F.col("u").alias("key"), F.col("v").alias("found"))
    return lists.join(known, "key", "left").select(*lists.columns, F.coalesce("found", "key").alias("root"))


def class_links(lists: DataFrame, sets: DataFrame, rounds: int = ROUNDS) -> DataFrame:
    """u and v: for every linked class but the least of its component, that least one."""
    total = lists.count()
    rows, roots, links = lists.withColumn("root", F.col("key")), None, None
    for turn in range(rounds + 1):
        # Each list's hub is a class of its most frequent component: first the one with the fewest
        # rare shingles before the shared one, as an original has that was copied with changes;
        # another one in each later round.
        dealt = F.xxhash64(F.lit(turn), "key")
        order = F.struct("pos", dealt) if turn == 0 else F.struct(dealt, "pos")
        by_root = rows.groupBy("token", "root").agg(F.count("*").alias("held"), F.min(F.struct(order.alias("o"), "key")).alias("m"))
        top = F.struct("held", -F.col("m.o").getField("pos"), F.xxhash64(F.lit(turn), "m.key"), F.col("m.key").alias("hub"), F.col("root").alias("hub_root"))
        hubs = stage_table(
            by_root.groupBy("token")
            .agg(F.sum("held").alias("size"), F.max(top).alias("top"), F.count("*").alias("roots")).where("roots > 1")
            .select(F.col("token").alias("of"), "size", "top.held", "top.hub", "top.hub_root"),
            "hubs",
        )
        checks = hubs.agg(F.sum((F.col("size") - F.col("held")) * F.col("size"))).first()[0] or 0
        if not checks:
            break
        strays = rows.alias("a").join(hubs.alias("h"), F.expr("a.token = h.of and a.root <> h.hub_root"))
        last = turn == rounds or (turn and checks <= FEW_CHECKS * total)
        if last:
            met = strays.join(rows.alias("b"), F.expr("b.token = h.of")).where(
                (F.col("a.root") != F.col("b.root"))
                & ((F.col("b.root") == F.col("h.hub_root")) | (F.col("a.key") < F.col("b.key")))
                & _meets("a", "b")
            )
            pairs = (
                met.groupBy(F.least("a.key", "b.key").alias("hub"), F.greatest("a.key", "b.key").alias("member"))
                .agg(F.count("*").alias("shared"), F.min(F.least("a.asks", "b.asks")).alias("asks"))
                .where("shared >= asks").select("hub", "member")
            )
        else:
            met = strays.join(rows.alias("b"), F.expr("b.token = h.of and b.key = h.hub")).where(_meets("a", "b"))
            pairs = (
                met.groupBy(F.col("a.key").alias("key"), F.col("h.hub").alias("hub")).agg(F.count("*").alias("shared"))
                .groupBy(F.col("key").alias("member")).agg(F.max_by("hub", F.struct("shared", "hub")).alias("hub"))
                .select("hub", "member")
            )
        found = stage_table(verified(stage_table(pairs, "candidates"), sets), "found")
        links = found if links is None else links.union(found)
        new = found.limit(1).count()
        if new:
            roots = components(links)
        if last:
            break
        if new:
            # Lists of one component have no more to tell.
            mixed = hubs.select(F.col("of").alias("token"))
            rows = stage_table(_rooted(lists.join(mixed, "token", "left_semi"), roots), "rooted")
        else:
            rounds = turn + 1  # hubs find nothing more; the next turn is the whole comparison
    return roots if roots is not None else lists.sparkSession.createDataFrame([], "u bigint, v bigint")


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_shingles and component_id of every row."""
    described = stage_table(describe(docs, id_col, text_col), "described")
    held_by = estimates(described)
    rows = described.where("bucket is null").select("doc_id", "own", "key", "n")
    lists = stage_table(shared_lists(prefixes(docs, held_by, id_col, text_col)), "lists")
    sets = stage_table(shingle_sets(docs, rows, lists, id_col, text_col), "shingle-sets")
    roots = class_links(lists, sets).select(F.col("u").alias("key"), F.col("v").alias("root"))
    classes = rows.where("n > 0").groupBy("key").agg(F.min("doc_id").alias("first"))
    entries = classes.join(roots, "key", "left").select("key", "first", F.coalesce("root", "key").alias("root"))
    entries = stage_table(entries, "classes")
    least = entries.groupBy("root").agg(F.min("first").alias("component_id"))
    named = stage_table(entries.join(least, "root").select("key", "component_id"), "named-classes")
    size = F.col("n").cast("bigint").alias("n_shingles")
    linked = rows.where("n > 0").join(named, "key").select("doc_id", size, "component_id")
    return linked.union(rows.where("n = 0").select("doc_id", size, F.col("doc_id").alias("component_id")))


@query("op11_ngram_jaccard")
def op11_ngram_jaccard(spark: SparkSession, sf: str) -> DataFrame:
    return near_duplicates(table(spark, sf, "documents"))
