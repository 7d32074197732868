"""Small awkward tables and brute-force versions of the operators."""

import collections
import hashlib
import random
import re
import zlib

import numpy as np
import xxhash
from pyspark.sql import functions as F

SMALL = "/root/testdata/sf0.001"
WORDS = "the of and rain hill stone river green slow bird under cloud paper light seven door".split()


def prose(rng, words):
    out = [rng.choice(WORDS) + rng.choice(["", "", "s", "ed", "ing"]) for _ in range(words)]
    return re.sub(r"(\S+ ){9}", lambda m: m[0][:-1] + ".\n", " ".join(out) + " ")


def awkward(spark, name="documents"):
    """Nulls, empty and very long texts, ties, repeated rows, other columns with clashing names."""
    rng = random.Random(5)
    passage = "".join(rng.choice("abcdefgh éü") for _ in range(700))
    line = "A line that many documents hold, word for word"
    long = prose(rng, 30_000)
    base = prose(rng, 300)
    texts = [None, "", " \n\t ", "short", "12 34 !!", long, base, base, base + " more", prose(rng, 60)]
    texts += [f"{prose(rng, 40)}\n{line}\n{prose(rng, 30)}" for _ in range(5)]
    texts += [f"{line.upper()}  \n{prose(rng, 40)}", line, line + "\n" + line]
    texts += [prose(rng, 120) + passage + prose(rng, 90), passage[20:650] + prose(rng, 50), passage[:399]]
    texts += ["ab" * 500, "é" * 600, "&&& *** word " * 30, "same same same same " * 20]
    rows = [(i, t, ["en", "fr", None][i % 3], f"s{i % 2}", len(t or "")) for i, t in enumerate(texts)]
    rows.append(rows[9])  # a repeated row
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, lang string, source string, n_chars bigint")
    clash = ("body", "h1", "n", "code", "rank", "gram", "first", "lines", "v", "length", "component_id")
    return docs.withColumns({c: F.lit(c) for c in clash})


def empty(spark):
    return awkward(spark).limit(0)


def collected(df, *columns):
    return [tuple(r[c] for c in columns) for r in df.collect()]


# --- brute force --------------------------------------------------------------------------------


def az(text):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text)


def line_dedup(docs):
    """docs: (doc_id, text) with unique ids. Kept text by id."""
    key = lambda s: az(s.strip(" \t\n\x0b\x0c\r"))
    held = collections.defaultdict(set)
    for i, t in docs:
        for s in (t or "").split("\n"):
            if len(key(s)) >= 20:
                held[key(s)].add(i)
    gone = {k: max(v) for k, v in held.items() if len(v) >= 3}
    return {i: [s for s in (t or "").split("\n") if gone.get(key(s), i) == i] for i, t in docs}


def fingerprint(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", az(text or ""))
    shingles = [" ".join(words[i : i + 4]) for i in range(max(1, len(words) - 3))] if words else []
    hashes = [xxhash.xxh64(s.encode(), seed=42).intdigest() for s in shingles]
    return sum(1 << k for k in range(64) if 2 * sum(h >> k & 1 for h in hashes) > len(hashes)) if hashes else 0


def near_components(codes):
    """codes: by id. The smallest id within reach of each."""
    ids = sorted(codes)
    root = {i: i for i in ids}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for a in ids:
        for b in ids:
            if a < b and (codes[a] ^ codes[b]).bit_count() <= 4:
                x, y = sorted((find(a), find(b)))
                root[y] = x
    return {i: find(i) for i in ids}


def repeated_bytes(texts, length=400):
    """For each text as bytes: which are covered by a string of that length that starts elsewhere too."""
    count = collections.Counter(b[p : p + length] for b in texts for p in range(len(b) - length + 1))
    out = []
    for b in texts:
        hit = np.zeros(len(b), bool)
        for p in range(len(b) - length + 1):
            if count[b[p : p + length]] > 1:
                hit[p : p + length] = True
        out.append(hit)
    return out


def removal(body, hit):
    kept = bytes(np.frombuffer(body, np.uint8)[~hit])
    spans = int((np.diff(np.r_[0, hit.astype(int)]) == 1).sum())
    return len(body), int(hit.sum()), spans, hashlib.sha256(kept).hexdigest()


def token_pieces(text, capacity=4096):
    import public_tokenizers
    from tokenizers import Tokenizer

    encoder = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    ids = np.array(encoder.encode(text or "", add_special_tokens=False).ids + [1], "<u4")
    cuts = range(0, len(ids), capacity)
    return [(k, a, len(ids[a : a + capacity]), zlib.crc32(ids[a : a + capacity].tobytes())) for k, a in enumerate(cuts)]


def words(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


def jaccard_rows(rows):
    """rows: (doc_id, text). (doc_id, set size, smallest id within reach), by row, sorted."""
    sets = []
    for _, t in rows:
        w = words(az(t or ""))
        sets.append({tuple(w[a : a + 5]) for a in range(max(1, len(w) - 4))} if w else set())
    root, holders = list(range(len(rows))), collections.defaultdict(list)

    def find(k):
        while root[k] != k:
            k = root[k]
        return k

    for k, own in enumerate(sets):
        both = collections.Counter(b for s in own for b in holders[s])
        for b, n in both.items():
            if 100 * n >= 80 * (len(own) + len(sets[b]) - n):
                x, y = sorted((find(k), find(b)))
                root[y] = x
        for s in own:
            holders[s].append(k)
    groups = collections.defaultdict(list)
    for k, (i, _) in enumerate(rows):
        groups[find(k)] += [i] if i is not None else []
    return sorted([(i, len(sets[k]), min(groups[find(k)], default=None)) for k, (i, _) in enumerate(rows)], key=str)


def runs_of(w):
    """(start, length, period) of every run of a list of words."""
    found = {}
    for q in range(1, len(w) // 2 + 1):
        j = 0
        while j + q < len(w):
            a = j
            while j + q < len(w) and w[j] == w[j + q]:
                j += 1
            if j > a and j + q - a >= max(12, 2 * q):
                found.setdefault((a, j + q - a), q)
            j += 1
    return sorted((a, n, q) for (a, n), q in found.items())


def run_row(doc_id, text, damage):
    w = words(text)
    h = zlib.crc32(str(doc_id).encode())
    if damage and h % 10 == 0 and w:
        g = h // 10
        a = g % len(w)
        p = 1 + (len(w) - a) // (3 + g % 8)
        w = [w[i] if i < a else w[a + (i - a) % p] for i in range(len(w))]
    runs = runs_of(w)
    gone = {i for s, n, q in runs for i in range(s + q, s + n)}
    top = min(runs, key=lambda r: (-r[1], r[0], r[2]), default=None)
    sha = lambda t: hashlib.sha256(t.encode()).hexdigest()
    return (
        doc_id, len(runs), *((top[0], top[1], top[2], 1000 * top[1] // top[2]) if top else (None,) * 4),
        sha("".join(f"{s},{n},{q}\n" for s, n, q in runs)), sha(" ".join(x for i, x in enumerate(w) if i not in gone)),
    )


def conversation_rows(rows, damage=True):
    """rows: (conv_id, turn, role, text). The result of the repair, by enumerating all edits."""
    kept = collections.defaultdict(list)
    for conv, turn, role, text in rows:
        kept[conv]
        role, text = (" " if x is None else x for x in (role, text))
        k = zlib.crc32(":".join(" " if x is None else str(x) for x in (conv, turn)).encode()) % 20 if damage else 9
        text = "" if k == 1 else re.sub("[.!?]", "", text) if k == 2 else text
        kept[conv] += [(turn, "user" if k == 4 else role, text)] * (0 if k == 0 else 2 if k == 3 else 1)
    return {conv: _repaired(conv, own) for conv, own in kept.items()}


def _repaired(conv, rows):
    rows = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1].encode(), r[2].encode()))
    numbered = [t for t, _, _ in rows if t is not None]
    faults, seen = [], set()
    for _, role, text in rows:
        bare = text.strip(" \t\n\x0b\x0c\r")
        faults.append("blank" if not bare else "duplicate" if (role, text) in seen else "cut" if bare[-1] not in ".!?" else "")
        seen.add((role, text))
    admits = {"": "su", "s": "u", "u": "a", "a": "u"}  # by the last initial
    best = {state: None for state in admits}

    def relax(table):
        for _ in range(4):
            for state, nexts in admits.items():
                for x in nexts.replace("s", ""):
                    if table.get(x):
                        c, letters, out = table[x]
                        option = (c + 2, "I" + letters, [({"u": "user", "a": "assistant"}[x], "")] + out)
                        if not table.get(state) or option[:2] < table[state][:2]:
                            table[state] = option
        return table

    best = relax({"": (0, "", []), "a": (0, "", [])})
    for (_, role, text), fault in reversed(list(zip(rows, faults))):
        table = {}
        for state, nexts in admits.items():
            options = []
            if best.get(state):
                c, letters, out = best[state]
                options.append((c + 3, "D" + letters, out))
            if fault not in ("blank", "duplicate"):
                for x in nexts:
                    if best.get(x):
                        c, letters, out = best[x]
                        c += fault == "cut"
                        if role[:1] == x:
                            options.append((c, "K" + letters, [(role, text)] + out))
                        if x != "s":
                            options.append((c + 2, "R" + letters, [({"u": "user", "a": "assistant"}[x], text)] + out))
            if options:
                table[state] = min(options, key=lambda o: o[:2])
        best = relax(table)
    cost, audit, out = best[""]
    illegal = sum(a[1][:1] + b[1][:1] not in ("su", "ua", "au") for a, b in zip(rows, rows[1:]))
    gaps = max(numbered) - min(numbered) + 1 - len(set(numbered)) if numbered else 0
    sha = hashlib.sha256("\n".join(f"{r}:{t}" for r, t in out).encode()).hexdigest()
    return (conv, gaps, faults.count("blank"), faults.count("duplicate"), faults.count("cut"), illegal, cost, audit, sha)
