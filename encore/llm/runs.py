"""Runs: stretches of words that repeat with a period, found by block convolution.

At each dyadic scale B a text is cut into aligned blocks of B words. A run whose period lies in the
scale's range holds a whole block of the scale and, one period later, its copy. For all shifts of
the range at once, the squared differences between a block and the window that follows it are
summed by a number-theoretic transform over word numbers. The transform is exact: the sums are kept
modulo as many primes as their largest possible value needs, so a sum is zero if and only if the
block occurs there without a mismatch. Each such distance is a seed, which is extended to both
sides as far as words at that distance agree. Seeds within a run already known, at a multiple of
its period, tell nothing new and are left out; runs found with the same bounds keep the smallest
period.

Blocks whose first two words don't come again, side by side, at a distance of the scale have no
occurrence and aren't transformed: a filter that loses nothing. Each text is worked on by itself in
the task that reads it; nothing is shuffled. Transforms are taken in portions of fixed size. Blocks
longer than ``LONGEST`` are sought by their first words; what follows them is settled by extension.

Defined cases. A null or empty text has no words and no run; repeated rows each get a row; a null
id passes through. An empty table gives an empty result. Other columns are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator
from functools import lru_cache

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from encore.llm.base import crc, map_batches, query, table, utf8

#: A run has at least so many words, and at least two periods.
LEAST = 12
#: Primes k * 2**18 + 1 and more below 2**23: products of residues summed over a row of a transform
#: of ``WIDTH`` stay below 2**53, so they are exact as floating-point numbers.
PRIMES = (7340033, 5767169, 786433)
#: Widest transform done as one product with a matrix; wider ones are split in two steps.
WIDTH = 1 << 6
#: Longest block that is transformed, and the words of all windows transformed at once.
LONGEST, PORTION = 1 << 13, 1 << 19
#: Seeds above which those within the longest runs known are left out together first.
MANY_SEEDS = 1 << 10
#: Words of several texts that are numbered and searched together.
TOGETHER = 1 << 17


def _root(prime: int, n: int, inverse: bool) -> int:
    """A primitive n-th root of one."""
    g = next(
        x for x in range(2, 100) if all(pow(x, (prime - 1) // f, prime) != 1 for f in _factors(prime - 1))
    )
    w = pow(g, (prime - 1) // n, prime)
    return pow(w, -1, prime) if inverse else w


def _factors(n: int) -> set[int]:
    out, f = set(), 2
    while f * f <= n:
        while n % f == 0:
            out.add(f)
            n //= f
        f += 1
    return out | ({n} if n > 1 else set())


@lru_cache(maxsize=None)
def _powers(prime: int, n: int, rows: int, columns: int, inverse: bool) -> np.ndarray:
    """w ** (i * j) for a primitive n-th root w."""
    w, powers = _root(prime, n, inverse), [1]
    for _ in range(n - 1):
        powers.append(powers[-1] * w % prime)
    at = np.outer(np.arange(rows), np.arange(columns)) % n
    return np.array(powers, np.float64)[at]


def _mod(x: np.ndarray, prime: int) -> np.ndarray:
    """x modulo the prime, for whole numbers below 2**53 held as floats; x is overwritten."""
    q = np.floor(x * (1.0 / prime))
    q *= prime
    x -= q
    x[x < 0] += prime
    x[x >= prime] -= prime
    return x


def transform(x: np.ndarray, prime: int, inverse: bool = False) -> np.ndarray:
    """Number-theoretic transforms of the rows of ``x``, whose length is a power of two."""
    m, n = x.shape
    if n <= WIDTH:
        return _mod(x @ _powers(prime, n, n, n, inverse), prime)
    inner = WIDTH
    outer = n // inner
    # Columns of the row written as (outer, inner), turned by the root, then rows of them.
    first = transform(x.reshape(m, outer, inner).transpose(0, 2, 1).reshape(m * inner, outer), prime, inverse)
    first = first.reshape(m, inner, outer)
    first *= _powers(prime, n, inner, outer, inverse)
    first = _mod(first, prime)
    second = _mod(first.transpose(0, 2, 1).reshape(m * outer, inner) @ _powers(prime, inner, inner, inner, inverse), prime)
    return second.reshape(m, outer, inner).transpose(0, 2, 1).reshape(m, n)


def zero_mismatch(blocks: np.ndarray, windows: np.ndarray) -> np.ndarray:
    """For each block and shift, whether the window agrees with the block at that shift.

    Numbers are at least 0; a window's rows are as long as a power of two."""
    m, b = blocks.shape
    n = windows.shape[1]
    most = int(max(blocks.max(initial=0), windows.max(initial=0)))
    shifts = n - b + 1
    squares = np.zeros((m, n + 1), np.int64)
    np.cumsum(windows.astype(np.int64) ** 2, axis=1, out=squares[:, 1:])
    both = (blocks.astype(np.int64) ** 2).sum(1)[:, None] + squares[:, b:] - squares[:, :-b]
    agree, bound = np.ones((m, shifts), bool), b * most * most
    for prime in PRIMES:
        turned = np.zeros((m, n))
        turned[:, (-np.arange(b)) % n] = blocks % prime
        product = transform((windows % prime).astype(np.float64), prime)
        product *= transform(turned, prime)
        product = transform(_mod(product, prime), prime, inverse=True)[:, :shifts]
        product *= pow(n, -1, prime)
        crossed = _mod(product, prime).astype(np.int64)
        agree &= (both - 2 * crossed) % prime == 0
        bound //= prime
        if not bound:
            return agree
    # Numbers too large for the primes at hand: settle what is left word by word.
    for i, shift in zip(*np.nonzero(agree)):
        agree[i, shift] = (blocks[i] == windows[i, shift : shift + b]).all()
    return agree


def scales(longest: int) -> Iterator[tuple[int, int, int]]:
    """Block length and the range of periods it covers. A run of period q has max(q, LEAST - q)
    words or more whose copy lies in it too; 2 B - 1 of them hold an aligned block."""

    def block(q: int) -> int:
        return 1 << ((max(q, LEAST - q) + 1) // 2).bit_length() - 1

    q = 1
    while q <= longest // 2:
        end = q
        while end + 1 <= longest // 2 and end < 2 * LEAST and block(end + 1) == block(q):
            end += 1
        if end >= 2 * LEAST:
            end = min(longest // 2, 4 * block(q) - 2)
        yield block(q), q, end
        q = end + 1


def _seeds(numbers: np.ndarray, ends: np.ndarray, pairs: np.ndarray, b: int, low: int, high: int):
    """(start, distance) where the aligned block of b words at start, or its first ``LONGEST`` words,
    comes again. ``numbers``: the
    texts' words, from 1 in each; ``ends``: the end of each word's text; ``pairs``: places sorted by
    (pair of words, place), as keys."""
    total = len(numbers)
    first = np.concatenate([np.arange(s, e, b) for s, e in _texts(ends)] or [np.zeros(0, np.int64)])
    first = first[first + b + low <= ends[first]]
    if not len(first):
        return
    # The next place of the block's first pair, from the least distance on, is near enough.
    pair = pairs[1]
    at = np.searchsorted(pairs[0], pair[first] * total + first + low)
    reach = pair[first] * total + np.minimum(first + high, ends[first] - b)
    first = first[(at < len(pairs[0])) & (pairs[0][np.minimum(at, len(pairs[0]) - 1)] <= reach)]
    sought = min(b, LONGEST)
    width = 1 << (2 * sought + min(high - low, 2 * sought) - 1).bit_length()
    step = width - sought + 1
    for start in range(low, high + 1, step):
        for portion in np.array_split(first, max(1, -(-len(first) * width // PORTION))):
            if not len(portion):
                continue
            place = portion[:, None] + np.arange(start, start + width)
            inside = place < ends[portion][:, None]
            window = np.where(inside, numbers[np.minimum(place, total - 1)], 0)
            block = numbers[portion[:, None] + np.arange(sought)]
            i, shift = np.nonzero(zero_mismatch(block, window)[:, : high - start + 1])
            yield portion[i], shift + start


def _texts(ends: np.ndarray) -> list[tuple[int, int]]:
    stops = np.unique(ends)
    return list(zip(np.r_[0, stops[:-1]].tolist(), stops.tolist()))


def _agreement(a: np.ndarray, b: np.ndarray) -> int:
    """How many of the first words of both agree."""
    done, step = 0, 32
    while done < len(a):
        odd = np.flatnonzero(a[done : done + step] != b[done : done + step])
        if len(odd):
            return done + int(odd[0])
        done += step
        step *= 2
    return len(a)


def find_runs(numbers: np.ndarray, ends: np.ndarray) -> list[tuple[int, int, int]]:
    """(start, length, period) of the runs of all texts laid end to end, by start, then period.

    ``numbers``: word numbers from 1 in each text; ``ends``: for each word the end of its text."""
    total = len(numbers)
    if total < LEAST:
        return []
    texts = _texts(ends)
    begins = np.repeat([s for s, _ in texts], [e - s for s, e in texts])
    # Pairs of words side by side; the last word of a text has a pair of its own.
    following = np.where(np.arange(total) + 1 < ends, np.r_[numbers[1:], 0], 0)
    _, pair = np.unique((begins * (total + 1) + numbers) * (total + 1) + following, return_inverse=True)
    pair = pair.astype(np.int64)
    pairs = (np.sort(pair * total + np.arange(total)), pair)
    found: dict[tuple[int, int], int] = {}
    known: dict[int, list[tuple[int, int, int]]] = {}
    longest = max(e - s for s, e in texts)
    for b, low, high in scales(longest):
        agreed = min(b, LONGEST)
        for starts, distances in _seeds(numbers, ends, pairs, b, low, high):
            if len(starts) > MANY_SEEDS:
                for (x, n), q in sorted(found.items(), key=lambda r: -r[0][1])[:8]:
                    told = (starts >= x) & (starts + distances + agreed <= x + n) & (distances % q == 0)
                    starts, distances = starts[~told], distances[~told]
            order = np.lexsort((starts, distances))
            starts, distances = starts[order], distances[order]
            last_distance, last_end = -1, -1
            for s, d in zip(starts.tolist(), distances.tolist()):
                if d == last_distance and s + d < last_end:
                    continue  # within the stretch just extended at this distance
                begin, end = int(begins[s]), int(ends[s])
                if any(x <= s and s + d + agreed <= y and d % q == 0 for x, y, q in known.get(begin, ())):
                    continue
                right = s + agreed + _agreement(numbers[s + agreed : end - d], numbers[s + agreed + d : end])
                left = s - _agreement(numbers[begin:s][::-1], numbers[begin + d : s + d][::-1])
                last_distance, last_end = d, right + d
                length = right + d - left
                if length >= max(LEAST, 2 * d) and found.get((left, length), d) >= d:
                    found[left, length] = d
                    known.setdefault(begin, []).append((left, left + length, d))
    return sorted((s, n, q) for (s, n), q in found.items())


def word_numbers(words: list) -> np.ndarray:
    """Numbers from 1, the same for the same word."""
    numbers: dict = {}
    return np.fromiter((numbers.setdefault(w, len(numbers) + 1) for w in words), np.int64, len(words))


def texts_runs(texts: list[list]) -> Iterator[list[tuple[int, int, int]]]:
    """The runs of each text, given as lists of words; small texts are searched together."""
    held: list[np.ndarray] = []

    def search() -> Iterator[list[tuple[int, int, int]]]:
        sizes = [len(t) for t in held]
        bounds = np.r_[0, np.cumsum(sizes)].astype(np.int64)
        runs = find_runs(np.concatenate(held), np.repeat(bounds[1:], sizes)) if held else []
        at = np.searchsorted([r[0] for r in runs], bounds)
        for k in range(len(held)):
            yield [(s - int(bounds[k]), n, q) for s, n, q in runs[at[k] : at[k + 1]]]
        held.clear()

    size = 0
    for words in texts:
        if held and size + len(words) > TOGETHER:
            yield from search()
            size = 0
        held.append(word_numbers(words))
        size += len(words)
    yield from search()


def collapsed(words: list, runs: list[tuple[int, int, int]]) -> list:
    """The words that stay: of each run its first period."""
    if not runs:
        return words
    depth = np.zeros(len(words) + 1, np.int64)
    for start, length, period in runs:
        depth[start + period] += 1
        depth[start + length] -= 1
    gone = np.cumsum(depth[:-1]) > 0
    return [w for w, g in zip(words, gone.tolist()) if not g]


def loop_words(doc_id: int | None, words: list) -> list:
    """The test damage of the query: one text in ten goes round from some word on."""
    h = crc("" if doc_id is None else doc_id)
    g, n = h // 10, len(words)
    if h % 10 or not n:
        return words
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return words[:a] + [words[a + (i - a) % p] for i in range(a, n)]


def detect_runs(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", alter: Callable[[int | None, list], list] | None = None
) -> DataFrame:
    """Per row: doc_id; run_starts, run_lengths and run_periods (by start, then period); n_words;
    collapsed, the text's words that stay joined by one space. ``alter`` may change the words of a
    text before."""

    def run(batch):
        ids = batch.column("doc_id").to_pylist()
        out: dict[str, list] = {c: [] for c in ("n_words", "run_starts", "run_lengths", "run_periods", "collapsed")}
        for first, last in _portions(batch.column("body")):
            texts = [batch.column("body")[k].as_py().split() for k in range(first, last)]
            if alter:
                texts = [alter(i, words) for i, words in zip(ids[first:last], texts)]
            for words, runs in zip(texts, texts_runs(texts)):
                out["n_words"].append(len(words))
                for column, values in zip(("run_starts", "run_lengths", "run_periods"), zip(*runs) if runs else ((), (), ())):
                    out[column].append(list(values))
                out["collapsed"].append(b" ".join(collapsed(words, runs)))
        return {"doc_id": batch.column("doc_id"), **out}

    picked = docs.select(F.col(id_col).cast("bigint").alias("doc_id"), utf8(text_col).alias("body"))
    return map_batches(
        picked, run,
        "doc_id bigint, n_words bigint, run_starts array<bigint>, run_lengths array<bigint>, "
        "run_periods array<bigint>, collapsed binary",
    )


def _portions(texts) -> Iterator[tuple[int, int]]:
    """Rows worked on at a time: few where texts are long."""
    first, size = 0, 0
    for k in range(len(texts)):
        size += len(texts[k].as_buffer())
        if size > 8 * TOGETHER:
            yield first, k + 1
            first, size = k + 1, 0
    if first < len(texts):
        yield first, len(texts)


def digest(starts: list[int], lengths: list[int], periods: list[int]) -> str:
    lines = "".join(f"{s},{n},{q}\n" for s, n, q in zip(starts, lengths, periods))
    return hashlib.sha256(lines.encode()).hexdigest()


@query("op12_periodic_runs")
def op12_periodic_runs(spark: SparkSession, sf: str) -> DataFrame:
    runs = detect_runs(table(spark, sf, "documents"), alter=loop_words)
    # The greatest length, then the smallest start and period: the largest of these triples.
    each = F.arrays_zip("run_lengths", "run_starts", "run_periods")
    ranked = F.transform(each, lambda r: F.struct(r.run_lengths.alias("length"), (-r.run_starts).alias("before"), (-r.run_periods).alias("finer")))
    lines = F.transform(each, lambda r: F.concat_ws(",", r.run_starts, r.run_lengths, r.run_periods))
    listed = F.when(F.size(each) > 0, F.concat(F.array_join(lines, "\n"), F.lit("\n"))).otherwise("")
    return runs.withColumn("top", F.array_max(ranked)).select(
        "doc_id",
        F.size("run_starts").cast("bigint").alias("n_runs"),
        (-F.col("top.before")).alias("start"),
        F.col("top.length").alias("length"),
        (-F.col("top.finer")).alias("period"),
        F.expr("1000 * top.length div -top.finer").alias("exponent_milli"),
        F.sha2(listed, 256).alias("runs_sha256"),
        F.sha2("collapsed", 256).alias("collapsed_sha256"),
    )
