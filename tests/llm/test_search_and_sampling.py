"""Edge cases and brute force for lexical search, SimHash and resampling."""

import hashlib
import math
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
import xxhash
from test_operators import WORD, long_text

from tidewell.llm import op11_lexical, op12_simhash, op13_resampling

SCHEMA = "doc_id bigint, text string, row string, k bigint, score string, rank int, fp string"
TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def lower(text):
    return "".join(c.lower() if c.isascii() else c for c in text or "")


def odd_rows():
    random = np.random.default_rng(12)
    vocabulary = [f"v{i}" for i in range(60)] + ["École", "ÉCOLE", "naïve", "x1", "1"]
    rows = [(None, "v1 v2 v3"), (1, None), (2, ""), (3, " \t\n.,;"), (4, long_text(30_000)), (5, "z" * 80_000 + " v1"), (6, "v1 V2 v3!"), (6, "v1 V2 v3!"), (6, "v9 v8")]
    rows += [(i, " ".join(random.choice(vocabulary, random.integers(0, 90)))) for i in range(10, 250)]
    rows += [(i, rows[40][1]) for i in range(250, 300)]  # exact copies
    rows += [(i, rows[60][1].upper() + " v3") for i in range(300, 320)]
    return rows


def frame(spark, rows):
    return spark.createDataFrame([(i, t, "r", 7, "s", 5, "f") for i, t in rows], SCHEMA)


# ---- lexical search


def brute_search(rows, items, most=20):
    own = [(-1 if i is None else i, TERM.findall(lower(t))) for i, t in rows]
    own = [(i, w) for i, w in own if w]
    n, total = len(own), sum(len(w) for _, w in own)
    df = Counter(term for _, w in own for term in set(w))
    out = []
    for item, text in items:
        found = []
        asked = Counter(TERM.findall(lower(text)))
        for i, words in own:
            tf, m = Counter(words), 75 + (25 * len(words) * n) // total
            score = 0
            for term, times in asked.items():
                if tf[term]:
                    score += times * math.floor(1000 * math.log((2 * n + 2) / (2 * df[term] + 1))) * ((10**9 * tf[term]) // (1000 * tf[term] + 12 * m))
            if score > 0:
                found.append((-score, i))
        out += [(item, rank, i, -score) for rank, (score, i) in enumerate(sorted(found)[:most], 1)]
    return sorted(out, key=repr)


ITEMS = [(1, "v1 v2 v2 École"), (2, None), (3, "nothing here"), (4, ""), (None, "x1 1 v59"), (5, "V7"), (5, "w17 w18"), (6, " ".join(f"v{i}" for i in range(60))), (7, "z" * 80_000)]


@pytest.mark.parametrize("block_bytes", [1 << 9, 1 << 22])
def test_search_equals_brute_force(spark, monkeypatch, block_bytes):
    monkeypatch.setattr(op11_lexical, "BLOCK_BYTES", block_bytes)
    rows = odd_rows()
    items = spark.createDataFrame([(i, t, "x") for i, t in ITEMS], "item_id bigint, text string, row string")
    got = op11_lexical.search(op11_lexical.index(frame(spark, rows)), items).collect()
    got = sorted(((r["item_id"], r["rank"], -1 if r["doc_id"] is None else r["doc_id"], r["score"]) for r in got), key=repr)
    assert got == brute_search(rows, ITEMS)


def test_search_in_several_passes_and_of_nothing(spark, monkeypatch):
    rows = odd_rows()
    items = spark.createDataFrame(ITEMS, "item_id bigint, text string")
    docs = frame(spark, rows)
    once = sorted(map(repr, op11_lexical.search(op11_lexical.index(docs), items).collect()))
    monkeypatch.setattr(op11_lexical, "PAIRS", 4)
    assert sorted(map(repr, op11_lexical.search(op11_lexical.index(docs), items).collect())) == once
    assert op11_lexical.search(op11_lexical.index(docs.limit(0)), items).count() == 0
    assert op11_lexical.search(op11_lexical.index(docs), items.limit(0)).count() == 0
    assert op11_lexical.search(op11_lexical.index(docs.where("text is null")), items).count() == 0


def test_cells_hold_the_largest_impact_below():
    random = np.random.default_rng(3)
    grid = random.integers(1, 1000, (13, 70)) * (random.random((13, 70)) < 0.2)
    rows, docs = np.nonzero(grid)
    tree = op11_lexical.Treap(rows, docs, grid[rows, docs], 13, 70)
    assert tree.high[tree.root] == grid.max()
    for row in range(13):
        cell = np.array([tree.root])
        for level in range(tree.row_bits):
            cell = tree.child(cell, np.array([2 * ((row >> (tree.row_bits - 1 - level)) & 1)]))
        open_ = [(cell, 0, tree.column_bits)]
        while open_:
            cell, column, left = open_.pop()
            part = grid[row, column << (left + 3) : (column + 1) << (left + 3)]
            assert tree.high[cell[0]] == (part.max() if part.size else 0)
            if left:
                open_ += [(tree.child(cell, np.array([bit])), 2 * column + bit, left - 1) for bit in (0, 1)]
            else:
                assert (tree.impacts(cell)[0][: part.size] == part).all()


# ---- SimHash


def brute_fingerprint(text, size=4):
    words = WORD.findall(lower(text))
    runs = [words[i : i + size] for i in range(len(words) - size + 1)] if len(words) >= size else [words] if words else []
    hashes = [xxhash.xxh64_intdigest(" ".join(r).encode(), seed=42) for r in runs]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def brute_classes(keys, values, radius=4):
    root = list(range(len(keys)))

    def top(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(len(keys)):
        for j in range(i):
            if keys[i] == keys[j] or (values[i] ^ values[j]).bit_count() <= radius:
                a, b = sorted((top(i), top(j)))
                root[b] = a
    least = defaultdict(lambda: 1 << 70)
    for i in range(len(keys)):
        least[top(i)] = min(least[top(i)], keys[i])
    return [least[top(i)] for i in range(len(keys))]


def test_fingerprints_equal_the_definition(spark):
    rows = odd_rows()
    got = op12_simhash.near_duplicates(frame(spark, rows)).collect()
    fix = lambda x: -1 if x == op12_simhash.NULL_ID else x
    keys, values = [-1 if i is None else i for i, _ in rows], [brute_fingerprint(t) for _, t in rows]
    want = sorted(zip(keys, values, brute_classes(keys, values)))
    assert sorted((fix(r["k"]), r["fp"] & (1 << 64) - 1, fix(r["component"])) for r in got) == want
    assert op12_simhash.near_duplicates(frame(spark, rows).limit(0)).count() == 0


def family(random, centres, n, flips):
    """Fingerprints around some centres, with links at all distances and chains."""
    out = []
    for _ in range(n):
        value = int(random.choice(centres))
        for bit in random.integers(0, 64, random.integers(0, flips)):
            value ^= 1 << int(bit)
        out.append(value)
    return np.array(out, dtype=np.uint64)


@pytest.mark.parametrize("block", [16, 4096])
def test_simhash_links_are_whole(spark, monkeypatch, block):
    """Hot buckets of many blocks, chains, and fingerprints far apart; the fingerprint is given as the only word's hash."""
    random = np.random.default_rng(block)
    centres = random.integers(0, 1 << 63, 12, dtype=np.uint64)
    values = np.unique(np.r_[family(random, centres, 400, 7), family(random, centres[:1], 300, 4)])
    monkeypatch.setattr(op12_simhash, "BLOCK", block)
    table = {f"t{i}": int(v) for i, v in enumerate(values)}

    def made(size, seed):
        import pyarrow as pa

        def of(batches):
            for batch in batches:
                own = np.array([table[t] for t in batch.column(1).to_pylist()], dtype=np.uint64)
                yield pa.record_batch([batch.column(0), pa.array(own.view(np.int64))], names=["k", "fp"])

        return of

    monkeypatch.setattr(op12_simhash, "_signed", made)
    docs = spark.createDataFrame([(i, f"t{i}") for i in range(len(values))], "doc_id bigint, text string")
    got = {r["k"]: r["component"] for r in op12_simhash.near_duplicates(docs).collect()}
    assert [got[i] for i in range(len(values))] == brute_classes(list(range(len(values))), [int(v) for v in values])


@pytest.mark.parametrize("radius", [0, 1, 3, 4, 7])
def test_counters_stop_at_the_radius(radius):
    random = np.random.default_rng(radius)
    centres = random.integers(0, 1 << 63, 3, dtype=np.uint64)
    left, right = family(random, centres, 1, 1), family(random, centres, 500, 12)
    bits = op12_simhash.planes(right)
    mask = random.random(500) < 0.8
    every = lambda b: op12_simhash.EVERY if int(left[0]) >> b & 1 else np.uint64(0)
    found = op12_simhash._pairs(*op12_simhash.within(lambda b, words: bits[b, words] ^ every(b), op12_simhash.lanes_of(mask), radius))
    want = [i for i in range(500) if mask[i] and (int(left[0]) ^ int(right[i])).bit_count() <= radius]
    assert sorted(found.tolist()) == want


# ---- resampling


def brute_sample(rows, target, percent=10, least=20, buckets=10_000):
    def words(text):
        return TERM.findall(lower(text))

    bucket = lambda w: zlib.crc32(w.encode()) % buckets
    s, t = Counter(bucket(w) for _, x in rows for w in words(x)), Counter(bucket(w) for x in target for w in words(x))
    all_s, all_t = sum(s.values()), sum(t.values())
    out = []
    for i, text in rows:
        own = words(text)
        weight = sum(math.floor(1000 * math.log((t[b] + 1) * (all_s + buckets) / ((s[b] + 1) * (all_t + buckets)))) for b in map(bucket, own))
        h = int(hashlib.sha256(f"2024:{'' if i is None else i}".encode()).hexdigest()[:8], 16)
        out.append([-1 if i is None else i, len(own), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))])
    fit = sorted((r for r in out if r[1] >= least), key=lambda r: (-r[3], r[0]))
    drawn = {}
    for rank, r in enumerate(fit[: percent * len(fit) // 100], 1):
        drawn.setdefault((r[0], r[3]), []).append(rank)
    return sorted(((*r, drawn[r[0], r[3]].pop(0) if r[1] >= least and drawn.get((r[0], r[3])) else None) for r in out), key=repr)


@pytest.mark.parametrize("percent", [0, 3, 10, 50, 100])
def test_resampling_equals_brute_force(spark, percent):
    rows, target = odd_rows(), [t for _, t in ITEMS]
    aims = spark.createDataFrame([(t, 1) for t in target], "text string, k int")
    got = op13_resampling.resample(frame(spark, rows), aims, percent=percent).collect()
    got = sorted(((-1 if r["doc_id"] is None else r["doc_id"], r["n_features"], r["weight"], r["score"], r["rank"]) for r in got), key=repr)
    assert got == brute_sample(rows, target, percent)


def test_resampling_of_nothing(spark):
    docs, aims = frame(spark, odd_rows()), spark.createDataFrame([("v1",)], "text string")
    assert op13_resampling.resample(docs.limit(0), aims).count() == 0
    want = sum(r[4] is not None for r in brute_sample(odd_rows(), []))
    assert want and op13_resampling.resample(docs, aims.limit(0)).where("rank is not null").count() == want


def test_equal_rows_at_the_limit(spark):
    """Rows equal in id and text take the places that are left, each once."""
    docs = spark.createDataFrame([(7, long_text(30))] * 40 + [(8, "w1")], "doc_id bigint, text string")
    got = op13_resampling.resample(docs, spark.createDataFrame([("w1",)], "text string"), percent=25).collect()
    assert sorted(r["rank"] for r in got if r["rank"]) == list(range(1, 11)) and len(got) == 41


def test_the_kth_key(spark):
    random = np.random.default_rng(1)
    rows = [(int(a), int(b), int(c)) for a, b, c in zip(random.integers(-5, 5, 3000), random.integers(0, 40, 3000), random.integers(0, 3, 3000))]
    table = spark.createDataFrame(rows, "score bigint, k bigint, t bigint").cache()
    order = sorted(((a, ~b, c) for a, b, c in rows), reverse=True)
    for k in (1, 1500, 3000):
        assert op13_resampling.kth_key(table, k, pivots=3) == order[k - 1]
    assert op13_resampling.kth_key(table, 3001) is None


def test_long_runs_of_words():
    """Buckets of runs of one to three words are those of the words joined by a space."""
    from tidewell.llm import flat, terms

    data = np.frombuffer("Ab c,, déf ".encode() + b"z" * 100 + b" q", dtype=np.uint8)
    offsets = np.array([0, 6, 6, len(data)])
    words = terms.words_of(terms.TERM_BYTES, data, offsets, 0, 3)
    row, bucket = op13_resampling.features(words, 3, 1000)
    texts = [["ab", "c"], [], ["déf", "z" * 100, "q"]]
    want = sorted((i, zlib.crc32(" ".join(own[a : a + n]).encode()) % 1000) for i, own in enumerate(texts) for n in (1, 2, 3) for a in range(len(own) - n + 1))
    assert sorted(zip(row.tolist(), bucket.tolist())) == want
