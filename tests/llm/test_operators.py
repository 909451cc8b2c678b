"""Edge cases and brute force for the training-data operators."""

import hashlib
import itertools
import re
import textwrap
import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
import tiktoken
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from tidewell.llm import op1_topk, op2_substrings, op3_bpe, op4_pii, op5_forest, op6_language, op7_revisits, op8_licenses, op9_packing, op10_minhash, vectors as vectors_module
from tidewell.llm.components import components

RANKS = public_tokenizers.path("byte_bpe_50k.tiktoken")
WORDS = public_tokenizers.path("word_bpe_49k.json")
SCHEMA = "doc_id bigint, text string, row string, k bigint, ids string"
WORD = re.compile(r"[^\x20\x09-\x0D]+")


def long_text(n, start=0):
    return " ".join(f"w{start + i}" for i in range(n))


@pytest.fixture(scope="module")
def odd(spark):
    """Null id, null text, empty and blank texts, a very long one, repeated rows, and columns named like internal ones."""
    rows = [
        (None, "a b c"), (1, None), (2, ""), (3, " \t\n"), (4, long_text(60_000)), (5, long_text(40)), (6, long_text(40)), (6, long_text(40)),
        (7, "x " + long_text(30, 5) + " y"), (8, "école naïve straße 😀"), (9, "z" * 50_000), (10, long_text(25) + " " + long_text(25)),
    ]
    return spark.createDataFrame([(i, t, "r", 7, "x") for i, t in rows], SCHEMA)


@pytest.fixture(scope="module")
def none(spark):
    return spark.createDataFrame([], SCHEMA)


# ---- substrings


def removed(rows, window=20):
    """Brute force: kept words of each row; rows that share an id are never earlier than one another."""
    words = [WORD.findall(t or "") for _, t in rows]
    key = [(-1 if i is None else i) for i, _ in rows]
    seen = defaultdict(list)
    for r, own in enumerate(words):
        for at in range(len(own) - window + 1):
            seen[tuple(own[at : at + window])].append((key[r], at, r))
    gone = [set() for _ in rows]
    for places in seen.values():
        for k, at, r in places:
            if any(o_k < k or (o_r == r and o_at < at) for o_k, o_at, o_r in places):
                gone[r].update(range(at, at + window))
    return [(len(own), len(g), " ".join(w for i, w in enumerate(own) if i not in g)) for own, g in zip(words, gone)]


def test_substrings_odd_rows(odd):
    rows = [(r["doc_id"], r["text"]) for r in odd.select("doc_id", "text").collect()]
    want = sorted((-1 if i is None else i, *r) for (i, _), r in zip(rows, removed(rows)))
    got = op2_substrings.remove_repeats(odd).collect()
    assert sorted((-1 if r["doc_id"] is None else r["doc_id"], r["n_words"], r["n_removed"], r["kept_text"]) for r in got) == want
    assert set(op2_substrings.remove_repeats(odd).columns) == {*odd.columns, "n_words", "n_removed", "kept_text"}


def test_substrings_random(spark):
    random = np.random.default_rng(3)
    base = [f"t{i}" for i in range(200)]
    rows = []
    for i in range(120):
        at, n = random.integers(0, 150), random.integers(0, 50)
        rows.append((i, " ".join(base[at : at + n] + [f"u{i}"] * random.integers(0, 30) + base[at // 2 : at // 2 + 25])))
    got = {r["doc_id"]: (r["n_words"], r["n_removed"], r["kept_text"]) for r in op2_substrings.remove_repeats(spark.createDataFrame(rows, "doc_id bigint, text string")).collect()}
    assert [got[i] for i, _ in rows] == removed(rows)


# ---- BPE


def test_bpe_equals_the_library(odd, spark, sf_dir):
    ranks = op3_bpe.ranks_at(RANKS)
    library = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks.rank, special_tokens={})
    texts = odd.select("text").unionByName(spark.read.parquet(f"{sf_dir}/documents.parquet").select("text"))
    for row in op3_bpe.decode(op3_bpe.encode(texts, RANKS), RANKS).collect():
        assert row["ids"] == library.encode_ordinary(row["text"] or "")
        assert bytes(row["decoded"]).decode() == (row["text"] or "")


def test_bpe_long_pretokens_and_ties():
    ranks = op3_bpe.ranks_at(RANKS)
    library = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks.rank, special_tokens={})
    random = np.random.default_rng(5)
    for piece in ["a" * 5001, "ab" * 3000, "".join(random.choice(list("abcd"), 9000))]:
        assert op3_bpe.merge_one(piece.encode(), ranks) == library.encode_ordinary(piece)
    pieces = ["".join(random.choice(list("aabé"), random.integers(1, 20))) for _ in range(500)]
    ids, counts = op3_bpe.merge_many([p.encode() for p in pieces], ranks)
    assert [x.tolist() for x in np.split(ids, np.cumsum(counts)[:-1])] == [op3_bpe.merge_one(p.encode(), ranks) for p in pieces]


def test_bpe_columns_of_the_same_name(odd):
    coded = op3_bpe.encode(odd, RANKS)
    assert dict(coded.dtypes)["ids"] == "array<int>" and set(coded.columns) == set(odd.columns)


# ---- personal data


def slow_spans(text):
    out = []
    for kind, pattern in enumerate((op4_pii.EMAIL, op4_pii.IP, op4_pii.CARD, op4_pii.PHONE)):
        for m in pattern.finditer(text):
            digits = [int(c) for c in m[0] if c in "0123456789"]
            luhn = sum(d if i % 2 == 0 else (2 * d - 9 * (d > 4)) for i, d in enumerate(reversed(digits))) % 10 == 0
            if [True, all(int(p) <= 255 for p in m[0].split(".")) if kind == 1 else True, 16 <= len(digits) <= 19 and luhn, 8 <= len(digits) <= 15][kind]:
                out.append((kind, *m.span()))
    return out


def test_pii_base_equals_the_patterns():
    random = np.random.default_rng(7)
    for _ in range(4000):
        text = "".join(random.choice(list("a1.@+- ()4%é\n"), random.integers(0, 40)))
        assert op4_pii.base_spans(text) == slow_spans(text), text


def test_pii_candidates_touch_nothing_and_long_texts_take_linear_time():
    import time

    random = np.random.default_rng(17)
    bits = ["1 555 010 ", "2", " 10[.]0[.]0[.]1", "a@b.cd ", "x [at] y [dot] com", "+49 1512 3456 7890", " (12) 345-6789 1", "\n", "4111 1111 1111 1111"]
    for _ in range(1500):
        text = "".join(random.choice(bits, random.integers(1, 8)))
        base = op4_pii.base_spans(text)
        busy, want = [(a, b) for _, a, b in base], []
        for name, pattern in op4_pii.OTHER:
            for m in pattern.finditer(text):
                if not any(a < m.end() and m.start() < b for a, b in busy):
                    busy.append(m.span())
                    want.append(m.span())
        assert [(a, b) for _, a, b in op4_pii._candidates(text, base)] == want
    times = []
    for n in (5_000, 20_000):
        text = " and ".join(f"+1 555 010 {1000 + i} or 1 555 020 {1000 + i}" for i in range(n))
        start = time.perf_counter()
        assert len(list(op4_pii._candidates(text, op4_pii.base_spans(text)))) == n
        times.append(time.perf_counter() - start)
    assert times[1] < 10 * times[0] + 0.5


def test_pii_contexts_find_other_spellings(spark):
    rows = [(i, f"please call our office on +1 (555) 010-{1000 + i} today") for i in range(12)]
    rows += [(100, "please call our office on 555 010 9999 today"), (101, "the order number is 555 010 9998 indeed"), (102, None), (None, "mail a.b@c.de now")]
    found = {r["k"]: r for r in op4_pii.find(spark.createDataFrame(rows, "doc_id bigint, text string")).collect()}
    assert [tuple(s) for s in found[100]["added"]] == [(3, 26, 38)]
    assert not found[101]["added"] and not found[102]["base"] and len(found[op4_pii.NULL_ID]["base"]) == 1
    masked = {r["doc_id"]: r["masked"] for r in op4_pii.mask(spark.createDataFrame(rows, "doc_id bigint, text string")).collect()}
    assert masked[100] == "please call our office on <PHONE> today" and masked[102] == ""
    assert masked[None] == "mail <EMAIL> now"


def test_pii_other_spellings_of_base_finds(spark):
    """A candidate with the value of a base find is added wherever it stands; one with another value is not."""
    rows = [(i, f"please call our office on +1 555 010 {1000 + i} today") for i in range(12)]
    rows += [
        (100, "please call our office on 1 555 010 1000 today"), (101, "fax: 1-555-010-1001"), (102, "1 (555) 010-1002"), (103, "fax: 1-555-010-2001"),
        (200, "host 10.0.0.1 is up"), (201, "see 10[.]0[.]0[.]1 there"), (202, "see 10[.]0[.]0[.]2 there"),
        (300, "mail jo_e@example.com now"), (301, "ask jo_e [at] example [dot] com please"), (302, "ask joe [at] example [dot] com please"),
        (400, "ring +49 1512 3456 7890 1"), (401, "ring 49 1512 3456 7890 1 or not"),
    ]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    added = {r["k"]: [tuple(s) for s in r["added"]] for r in op4_pii.find(docs).collect()}
    assert added[100] == [(3, 26, 40)] and added[101] == [(3, 5, 19)] and added[102] == [(3, 0, 16)] and not added[103]
    assert added[201] == [(1, 4, 18)] and not added[202]
    assert added[301] == [(0, 4, 31)] and not added[302]
    assert added[401] == [(3, 5, 24)]
    masked = {r["doc_id"]: r["masked"] for r in op4_pii.mask(docs).collect()}
    assert masked[100] == "please call our office on <PHONE> today" and masked[201] == "see <IP> there" and masked[401] == "ring <PHONE> or not"


def slow_trust(edges, seeds=3, threshold=0.8):
    """The same rounds over dictionaries, on edges of one kind."""
    sure = {v for _, seed, v, _ in edges if seed}
    patterns = defaultdict(set)
    for _, _, value, pattern in edges:
        if pattern:
            patterns[pattern].add(value)
    trust = {v: 0.0 for p in patterns.values() if len(p) >= seeds for v in p - sure}
    while True:
        score = {}
        for pattern, values in patterns.items():
            known = sum(v in sure or trust.get(v, 0) >= threshold for v in values)
            if known >= seeds:
                score[pattern] = (known + 0.5 * sum(trust[v] for v in values - sure if trust.get(v, 0) < threshold)) / (len(values) + 1)
        now = {}
        for v in trust:
            mine = [(p.endswith(" _"), score[p]) for p, values in patterns.items() if v in values and p in score]
            left, around = (max([s for side, s in mine if side == which], default=0.0) for which in (True, False))
            now[v] = 1 - (1 - left) * (1 - around)
        rise = max((now[v] - trust[v] for v in trust), default=0.0)
        trust = now
        if rise <= 1e-3:
            return trust | {v: 1.0 for v in sure}


def test_pii_trust_equals_brute_force(spark):
    """Random graphs; one pair of contexts with 100 or 400 seeds and 1000 unknown numbers; a chain of contexts over several hops."""
    rng = np.random.default_rng(7)
    near = ["call us _", "my number _", "us _ now", "number _ ok", ""]
    edges = [(3, bool(rng.random() < 0.4), f"v{rng.integers(60)}", near[rng.integers(len(near))]) for _ in range(160)]
    for seeds, name in ((100, "few"), (400, "many")):
        for i in range(seeds + 1000):
            edges += [(3, i < seeds, f"{name}{i}", f"{name} at _"), (3, i < seeds, f"{name}{i}", f"at _ {name}")]
    for hop in range(4):  # the finds of a pair of contexts are what makes the next pair known
        for i in range(8):
            for at in (hop, hop + 1):
                edges += [(3, hop == 0 and at == 0, f"chain{hop}-{i}", f"chain{at} at _"), (3, False, f"chain{hop}-{i}", f"at _ chain{at}")]
    edges += [(3, False, f"last{i}", c) for i in range(3) for c in ("chain4 at _", "at _ chain4")]
    frame = spark.createDataFrame(edges, "kind int, seed boolean, value string, pattern string")
    got = {r["value"]: r["trust"] for r in op4_pii.trusted(frame).collect()}
    want = slow_trust(edges)
    assert got.keys() == want.keys() and all(abs(got[v] - want[v]) < 1e-9 for v in want)
    found = [v for v, t in want.items() if t >= 0.8]
    assert not any(v.startswith("few") and int(v[3:]) >= 100 for v in found)
    assert sum(v.startswith("many") for v in found) == 1400 and sum(v.startswith(("chain", "last")) for v in found) == 35
    assert op4_pii.trusted(frame.limit(0)).count() == 0


def test_pii_query_equals_brute_force(spark, tmp_path):
    """Counts by kind, hash of the base finds and order of all spans: kinds alone, several of one, in any order; odd rows."""
    random = np.random.default_rng(23)
    bits = ["a.b@c.de", "10.0.0.1", "256.1.1.1", "4111 1111 1111 1111", "4111 1111 1111 1112", "+1 (555) 010-2222", "+12", "😀é ", " or ", "\n", "٣.٤"]
    rows = [(i, bit) for i, bit in enumerate(bits)] + [(None, "a.b@c.de 10.0.0.1"), (20, None), (21, ""), (22, "+1 555 010 2222 a@b.cd"), (22, "x"), (22, "x")]
    rows += [(100 + i, " ".join(random.choice(bits, random.integers(0, 9)))) for i in range(300)]
    spark.createDataFrame(rows, "doc_id bigint, text string").write.parquet(f"{tmp_path}/documents.parquet")
    want, spans = [], defaultdict(list)
    for i, text in rows:
        base = sorted(slow_spans(text or ""))
        told = [f"{op4_pii.KINDS[k]}:{a}:{b}" for k, a, b in base]
        want.append((i, *[sum(k == kind for k, _, _ in base) for kind in range(4)], hashlib.sha256(",".join(told).encode()).hexdigest()))
        spans[i].append(set(told))
    got = op4_pii.op4_pii(spark, str(tmp_path))
    assert [t for _, t in got.dtypes] == ["bigint"] * 5 + ["string"] * 2
    got = got.collect()
    order = lambda r: (r[0] is not None, r[0] or 0, *r[1:])
    assert sorted((tuple(r)[:6] for r in got), key=order) == sorted(want, key=order)
    for r in got:
        told = [s.split(":") for s in r["spans"].split(",") if s]
        places = [(op4_pii.KINDS.index(kind), int(a), int(b)) for kind, a, b in told]
        assert places == sorted(places) and any(own <= {":".join(s) for s in told} for own in spans[r["doc_id"]])


# ---- language


def test_learned_table_scores_and_prediction_equal_brute_force(spark, sf_dir):
    """Counts, log probabilities and the score of every text, computed again in plain Python."""
    import math
    from collections import Counter

    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").where("length(text) < 1500").select("doc_id", "text", "lang")
    rows = [r for r in docs.collect() if r["text"] and r["lang"]]
    model = op6_language.learn(docs)
    table = {name: Counter() for name in model.names}
    for r in rows:
        words = op6_language.LetterWords([r["text"]])
        table[r["lang"]].update(words.bucket.tolist())
    for i, name in enumerate(model.names):
        total = sum(table[name].values()) + op6_language.SMOOTH * op6_language.BUCKETS
        for bucket in [*list(table[name])[:300], 0, 1, 2]:
            assert model.scores[bucket, i] == pytest.approx(math.log((table[name][bucket] + op6_language.SMOOTH) / total), rel=1e-5)
    got = {r["doc_id"]: r for r in op6_language.identify(docs, model).collect()}
    for r in rows[:60]:
        words = op6_language.LetterWords([r["text"]])
        labels = op6_language.word_labels(words, model, op6_language.SWITCH)
        letters = Counter()
        for label, n, script in zip(labels.tolist(), words.n_letters.tolist(), words.script.tolist()):
            letters[label] += n if model.written[script].any() else 0
        best = max(letters, key=lambda i: (letters[i], -i))
        assert got[r["doc_id"]]["lang_pred"] == model.names[best]
        assert got[r["doc_id"]]["score"] == pytest.approx(letters[best] / int(words.n_letters.sum()))


def test_language_of_held_out_documents(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    got = op6_language.op6_language(spark, sf_dir).join(docs.select("doc_id", "lang"), "doc_id").where("held_out")
    assert got.where("lang = lang_pred").count() >= 0.97 * got.count()


def test_language_spans_and_odd_rows(spark, sf_dir, odd, none):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    model = op6_language.learn(docs)
    one = {r["lang"]: r["text"] for r in docs.where("length(text) > 400").select("lang", "text").collect()}
    mixed = one["en"][:300] + " " + one["de"][:300]
    row = op6_language.identify(spark.createDataFrame([(1, mixed)], "doc_id bigint, text string"), model).first()
    labels = [s["lang"] for s in row["lang_spans"]]
    assert {"en", "de"} <= set(labels) and 0.4 < row["score"] < 0.7
    got = {r["doc_id"]: r for r in op6_language.identify(odd, model).collect()}
    assert [got[i]["lang_pred"] for i in (1, 2, 3)] == ["und"] * 3 and got[1]["score"] == 0
    foreign = ["Все люди рождаются свободными", "人人生而自由", "Ω", "12 34 人", "!! 12"]
    rows = op6_language.identify(spark.createDataFrame([(i, t) for i, t in enumerate(foreign)], "doc_id bigint, text string"), model).orderBy("doc_id").collect()
    assert all(r["lang_pred"] in model.names and r["score"] == 0 and not r["lang_spans"] for r in rows[:4])
    assert rows[4]["lang_pred"] == "und"
    with pytest.raises(ValueError, match="more than 2"):
        op6_language.learn(docs, most=2)
    nothing = op6_language.learn(none.withColumn("lang", F.lit("en")))
    assert op6_language.identify(odd, nothing).where("lang_pred <> 'und'").count() == 0


def test_viterbi_is_the_best_path():
    random = np.random.default_rng(1)
    scores, lengths, switch = random.normal(size=(11, 3)), np.array([6, 5]), 0.7
    got = op6_language.viterbi(scores, lengths, switch)
    from itertools import product

    for lo, n in ((0, 6), (6, 5)):
        own = scores[lo : lo + n]
        value = lambda path: sum(own[i, s] for i, s in enumerate(path)) - switch * sum(a != b for a, b in zip(path, path[1:]))
        assert value(got[lo : lo + n]) == pytest.approx(max(map(value, product(range(3), repeat=n))))


def test_word_labels_are_the_best_path():
    """Also where two other languages, one after the other, win together and neither alone."""
    from itertools import product

    random, switch = np.random.default_rng(9), 17.9
    tables = [np.array([[-17, 0, -40], [-17, -40, 0]])] + [-40 * random.random((random.integers(1, 6), 3)) for _ in range(300)]
    for own in tables:
        texts = [" ".join("abcdef"[i] * 2 for i in range(len(own)))]
        words = op6_language.LetterWords(texts)
        scores = np.zeros((op6_language.BUCKETS, 3))
        scores[words.bucket[words.starts]] = own
        model = op6_language.Model(["a", "b", "l"], scores, np.ones((op6_language.N_SCRIPTS, 3), dtype=bool), np.zeros(3))
        value = lambda path: sum(own[i, s] for i, s in enumerate(path)) - switch * sum(a != b for a, b in zip(path, path[1:]))
        assert value(op6_language.word_labels(words, model, switch)) == pytest.approx(max(map(value, product(range(3), repeat=len(own)))))


# ---- revisits, licences


def test_revisits(spark):
    header = lambda **h: {k.replace("_", "-"): v for k, v in h.items()}
    rows = [
        (1, "http://A.org/x/?b=2&a=1", 10, "response", 200, header(etag="e1", content_type="t", age="1"), "d1"),
        (2, "https://www.a.org/x?a=1&b=2&utm_source=q#f", 20, "revisit", 304, header(etag="W/e1", content_type="no", age="2"), None),
        (3, "http://a.org/x?a=1&b=2", 25, "response", 200, header(etag="e2"), "d2"),
        (4, "http://a.org/x?a=1&b=2", 25, "revisit", 304, header(etag="e2"), None),
        (5, "http://a.org/x?a=1&b=2", 30, "revisit", 304, {}, None),
        (6, None, 30, "revisit", 304, None, None),
        (7, "http://a.org/x?a=1&b=2", None, "revisit", 304, {}, None),
    ]
    records = spark.createDataFrame(rows, "record_id bigint, url string, ts bigint, kind string, status int, headers map<string,string>, digest string")
    got = {r["record_id"]: r for r in op7_revisits.resolve_revisits(records).collect()}
    assert {i: (r["response_id"], r["outcome"]) for i, r in got.items()} == {
        2: (1, "resolved"), 4: (1, "mismatch"), 5: (3, "unverified"), 6: (None, "missing"), 7: (None, "missing"),
    }
    assert got[2]["headers"] == {"etag": "W/e1", "content-type": "t", "age": "2"} and got[2]["digest"] == "d1"
    assert op7_revisits.resolve_revisits(records.limit(0)).count() == 0


def test_revisits_of_crowded_urls_equal_brute_force(spark):
    """A third of the records on one URL in a short time, many at one moment, repeated ids, times at both ends of the range, nulls."""
    rng = np.random.default_rng(3)
    ends = [-(1 << 63), (1 << 63) - 1, 0, None]
    rows = []
    for i in range(900):
        hot = i % 3 == 0
        ts = 5000 + int(rng.integers(40)) if hot else 7000 if i % 3 == 1 and rng.random() < 0.5 else int(rng.integers(10000))
        ts = ends[i % 4] if i % 50 == 7 else ts
        url = "http://a.org/hot" if hot else None if i % 31 == 0 else f"http://a.org/{rng.integers(5)}"
        revisit = bool(rng.random() < 0.5)
        rows.append((i, url, ts, "revisit" if revisit else "response", 304 if revisit else 200, {"etag": f"e{rng.integers(3)}"}, f"d{i}", "extra"))
    rows += [r for r in rows[:30]]
    records = spark.createDataFrame(rows, "record_id bigint, url string, ts bigint, kind string, status int, headers map<string,string>, digest string, stretch string")

    def resolved(r):
        earlier = [o for o in rows if o[3] == "response" and o[1] == r[1] and r[1] and None not in (o[2], r[2]) and o[2] < r[2]]
        if not earlier:
            return r[0], None, "missing"
        best = max(earlier, key=lambda o: (o[2], o[0]))
        return r[0], best[0], "resolved" if best[5] == r[5] else "mismatch"

    want = sorted((resolved(r) for r in rows if r[3] == "revisit"), key=str)
    for stretches in (1, 8, 1024):
        got = op7_revisits.resolve_revisits(records, stretches).select("record_id", "response_id", "outcome").collect()
        assert sorted((tuple(r) for r in got), key=str) == want


def test_revisit_stretches_hold_equal_shares(spark):
    times = [(5000 + i % 3600,) for i in range(40_000)] + [(7_000_000,)] * 30_000 + [(i * 1000,) for i in range(30_000)] + [(1 << 62,), (-5,)]
    rows = spark.createDataFrame(times, "ts bigint")
    starts, moments = op7_revisits.cuts(rows, 100)
    held = np.bincount(np.searchsorted(starts, [t for t, in times], side="right"), minlength=len(starts) + 1)
    assert [i for i, n in enumerate(held) if n > 2500] == moments and len(moments) == 1
    assert op7_revisits.cuts(rows.limit(0), 100) == ([], [])


def test_licenses_odd_rows(odd, none, spark):
    assert op8_licenses.scan_licenses(odd).count() == 0 and op8_licenses.scan_licenses(none).count() == 0
    docs = spark.createDataFrame([(1, "one two three four\nReleased under the mit-license!\nfive six seven"), (2, "All rights reserved"), (None, op8_licenses.TEMPLATES["mit"])], "doc_id bigint, text string")
    got = {(r["doc_id"], r["unit"], r["license"]) for r in op8_licenses.scan_licenses(docs).collect()}
    assert got == {(1, 1, "mit-short"), (2, 0, "all-rights-reserved"), (None, 0, "mit")}


def test_licenses_as_they_are_shipped(spark):
    """Complete texts, wrapped headers inside comments and between prose: each is found, prose alone is not."""
    wrap = lambda name, width=70, start="": "\n\n".join("\n".join(start + x for x in textwrap.wrap(p, width)) for p in op8_licenses.TEMPLATES[name].split("\n"))
    prose = "A tool that counts things.\nIt is small.\n\n"
    bodies = {
        1: "MIT License\n\nCopyright (c) 2020 Somebody\n\n" + wrap("mit-text"),
        2: prose + wrap("mit-text") + "\n\n" + 40 * "Further words about something else entirely.\n",
        3: "/*\n * Copyright 2020 Somebody\n *\n" + wrap("apache-2.0-header", start=" * ").replace("\n\n", "\n *\n") + "\n */\n" + 50 * "x = compute(y)\n",
        4: wrap("gpl-3.0-header", start="# ").replace("\n\n", "\n#\n") + "\n\nimport os\n",
        5: "Copyright (c) 2020, Somebody\n\n" + wrap("bsd-3-clause-text"),
        6: prose + "The license of this software is a copyright matter, with warranty and permission.\n",
        7: "\n\n" + wrap("isc-text", 40) + "\n\n\n",
    }
    docs = spark.createDataFrame(list(bodies.items()), "doc_id bigint, text string")
    got = defaultdict(set)
    for r in op8_licenses.scan_licenses(docs).collect():
        got[r["doc_id"]].add((r["kind"], r["license"]))
    assert ("text", "mit-text") in got[1]
    assert {("paragraph", n) for n in ("mit", "mit-notice", "mit-warranty")} <= got[2]
    assert {("paragraph", n) for n in ("apache-2.0", "apache-2.0-warranty")} <= got[3]
    assert {("paragraph", n) for n in ("gpl-3.0", "gpl-warranty")} <= got[4]
    assert ("text", "bsd-3-clause-text") in got[5] and ("paragraph", "bsd-warranty") in got[5]
    assert ("text", "isc-text") in got[7] and 6 not in got


def dice_of_all(docs, templates, threshold):
    """Brute force: every unit against every template, without bounds or required words."""
    words = lambda t: re.sub("[^a-z0-9]+", " ", t.translate(str.maketrans(op8_licenses.UPPER, op8_licenses.LOWER))).split()
    pairs = lambda w: {*zip(w, w[1:])}
    out = []
    for i, body in docs:
        lines = [words(x) for x in (body or "").split("\n")]
        units = [("line", n, w) for n, w in enumerate(lines)]
        if len(lines) > 1:
            groups = [[*g] for some, g in itertools.groupby(lines, bool) if some]
            units += [("paragraph", n, sum(g, [])) for n, g in enumerate(groups) if len(groups) > 1 and len(g) > 1]
            units.append(("text", -1, sum(lines, [])))
        for kind, n, w in units:
            for name, t in templates.items():
                a, b = pairs(w), pairs(words(t))
                if b and 2 * len(a & b) / (len(a) + len(b)) >= threshold:
                    out.append((i, kind, n, name))
    return sorted(out)


@pytest.mark.parametrize("threshold", [0.3, 0.6, 0.8, 1.0])
def test_licenses_equal_brute_force(spark, threshold):
    """Templates with words dropped, repeated and moved, over lines and paragraphs; the required words lose nothing."""
    rng = np.random.default_rng(8)
    names = list(op8_licenses.TEMPLATES)
    rows = []
    for i in range(120):
        out = []
        for _ in range(rng.integers(1, 4)):
            words = op8_licenses.TEMPLATES[names[rng.integers(len(names))]].split()
            words = [w for w in words if rng.random() > rng.choice([0.0, 0.05, 0.1, 0.3])]
            out += [w + rng.choice(["\n", "\n\n", "\n * \n", " "], p=[0.1, 0.01, 0.01, 0.88]) for w in words]
        rows.append((i, "".join(out)))
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    got = sorted((r["doc_id"], r["kind"], r["unit"], r["license"]) for r in op8_licenses.scan_licenses(docs, threshold=threshold).collect())
    assert got == dice_of_all(rows, op8_licenses.TEMPLATES, threshold) and (got or threshold == 1)


def test_licenses_own_templates(spark):
    docs = spark.createDataFrame([(1, "to be or not\nto be"), (2, "or")], "doc_id bigint, text string")
    scan = lambda templates: {(r["doc_id"], r["kind"], r["license"]) for r in op8_licenses.scan_licenses(docs, templates=templates).collect()}
    assert scan({"a": "to be", "one": "or"}) == {(1, "line", "a")} and scan({}) == set()


# ---- packing


def check_packing(docs, found, capacity=2048):
    tokens = Tokenizer.from_file(WORDS)
    texts = [(r["doc_id"], r["text"]) for r in docs.select("doc_id", "text").collect()]
    want = []
    for i, text in texts:
        ids = np.array([*tokens.encode(text or "", add_special_tokens=False).ids, 0], dtype="<u4")
        for piece, start in enumerate(range(0, len(ids), capacity)):
            part = ids[start : start + capacity]
            want.append((-1 if i is None else i, piece, start, len(part), zlib.crc32(part.tobytes())))
    rows = found.collect()
    assert sorted((-1 if r["doc_id"] is None else r["doc_id"], r["piece"], r["start"], r["length"], r["ids_crc32"]) for r in rows) == sorted(want)
    held = defaultdict(list)
    for r in rows:
        held[r["sequence_id"]].append((r["offset"], r["length"]))
    for own in held.values():
        end = 0
        for offset, length in sorted(own):
            assert offset == end
            end += length
        assert end <= capacity
    return len(held), -(-sum(r["length"] for r in rows) // capacity)


def test_packing(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    used, least = check_packing(docs, op9_packing.pack_documents(docs, WORDS))
    assert used <= least + 2


def test_packing_odd_rows(odd, none):
    check_packing(odd, op9_packing.pack_documents(odd, WORDS))
    assert op9_packing.pack_documents(none, WORDS).count() == 0


def test_packing_of_special_literals(spark):
    """Literals of special tokens are what the library makes of them, alone, inside a part, and cut."""
    texts = ["end <|endoftext|> start", "a<|startoftext|>b", "<|endoftext|><|endoftext|>.", "<|endoftext| >", "<|ENDOFTEXT|> x", "é<|endoftext|>\u0301"]
    texts += ["<|EndOfText|> Then THEN then", "<|ENDOFTEXT|>A <|endoftext|>A", "A<|STARTOFTEXT |>"]
    docs = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id bigint, text string")
    check_packing(docs, op9_packing.pack_documents(docs, WORDS))
    assert Tokenizer.from_file(WORDS).encode(texts[0], add_special_tokens=False).ids == op9_packing.WordTokens(WORDS)([texts[0].encode()])[0].tolist() == [806, 49407, 1572]


def test_packing_of_signs_and_case(spark):
    """Words with runs of signs, contractions, letters that change with their case, and random mixtures of all of them."""
    bits = ["Word", "WORD", "\u00c9t\u00c9", "e\u0301", "E\u0301", "\u0130x", "\u017ft", "\u039f\u03a3", "\u212a", "K", "'s", "'S", "'", "'LL", "&&&", "_", "[x]", "`", "~!", "7", "\u00aa", "<|", "|>", ".", ",", " ", "  ", "\u00a0", "\x1c", "\x85", "\u4eba"]
    rng = np.random.default_rng(9)
    texts = ["".join(bits[i] for i in rng.integers(len(bits), size=rng.integers(1, 30))) for _ in range(3000)]
    docs = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id bigint, text string")
    check_packing(docs, op9_packing.pack_documents(docs, WORDS))


def test_packing_fills_sequences(odd):
    parts = op9_packing.pieces(odd, WORDS, 64, with_ids=True)
    placed = op9_packing.pack(parts.drop("ids"), 64)
    total = placed.agg(F.sum("length")).first()[0]
    assert sum(len(r["ids"]) for r in op9_packing.sequences(placed, parts.distinct()).collect()) >= total - 64


# ---- near duplicates


def test_components(spark):
    links = [(i, i + 1) for i in range(1, 40)] + [(100, 90), (90, 95), (7, 7)]
    got = {r["node"]: r["component"] for r in components(spark.createDataFrame(links, "a bigint, b bigint")).collect()}
    assert got == {**{i: 1 for i in range(1, 41)}, 90: 90, 95: 90, 100: 90}
    assert components(spark.createDataFrame([], "a bigint, b bigint")).count() == 0


def brute_components(rows, size=4, percent=80):
    def shingles(text):
        words = WORD.findall("".join(c.lower() if c.isascii() else c for c in text or ""))
        return {tuple(words[i : i + size]) for i in range(len(words) - size + 1)} if len(words) >= size else {tuple(words)} if words else set()

    sets = [shingles(t) for _, t in rows]
    root = list(range(len(rows)))

    def top(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            same = rows[i][0] == rows[j][0]
            shared = len(sets[i] & sets[j])
            if (same and sets[i] and sets[j]) or (shared and 100 * shared >= percent * (len(sets[i]) + len(sets[j]) - shared)):
                a, b = sorted((top(i), top(j)))
                root[b] = a
    key = [(-1 if i is None else i) for i, _ in rows]
    least = defaultdict(lambda: 1 << 60)
    for i in range(len(rows)):
        least[top(i)] = min(least[top(i)], key[i])
    return sorted((key[i], len(sets[i]), least[top(i)]) for i in range(len(rows)))


def test_near_duplicates(odd, spark):
    random = np.random.default_rng(11)
    rows = [(r["doc_id"], r["text"]) for r in odd.select("doc_id", "text").collect()]
    for i in range(300):  # a family of edited copies of all distances
        words = long_text(80, 1000 * (i % 3)).split()
        for _ in range(random.integers(0, 6)):
            words[random.integers(0, 80)] = f"e{random.integers(0, 30)}"
        rows.append((1000 + i, " ".join(words).upper() if i % 7 == 0 else " ".join(words)))
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    fix = lambda x: -1 if x == op10_minhash.NULL_ID else x
    got = sorted((fix(r["k"]), r["n_shingles"], fix(r["component"])) for r in op10_minhash.near_duplicates(docs).collect())
    assert got == brute_components(rows)
    kept = op10_minhash.keep_one_of_each(docs)
    assert kept.columns == docs.columns and kept.count() == sum(k == c for k, _, c in got)


def test_near_duplicates_of_nothing(none):
    assert op10_minhash.near_duplicates(none).count() == 0


# ---- vectors


def vectors(spark):
    random = np.random.default_rng(2)
    rows = [(i, (random.normal(size=6) * (1 + i % 3)).tolist(), 1) for i in range(400)]
    rows += [(i, rows[20][1], 1) for i in range(400, 460)]  # equal vectors
    rows += [(460, None, 1), (480, [], 1), (500, [None] * 6, 1), (520, [float("nan")] * 6, 1), (540, [float("inf")] + [0.0] * 5, 1), (None, [1.0] * 6, 1), (560, [1.0] * 5, 1), (580, [0.0] * 6, 1), rows[0]]
    return rows, spark.createDataFrame(rows, "vec_id bigint, embedding array<double>, rank int")


def brute_top(rows, scale, zero):
    good = {i: np.array(v) for i, v, _ in rows if i is not None and v is not None and len(v) == 6 and None not in v and np.isfinite(v).all()}
    good = {i: (np.floor(v * scale) if scale else v) for i, v in good.items() if zero or v.any()}
    out = {}
    for q in (i for i in good if i % 20 == 0):
        out[q] = sorted(((-float(good[q] @ v), i) for i, v in good.items() if i != q))[:20]
    return out


def test_exact_top_k(spark):
    rows, table = vectors(spark)
    got = defaultdict(list)
    for r in op1_topk.top_k(table, F.col("id") % 20 == 0).orderBy("query_id", "rank").collect():
        got[r["query_id"]].append((-float(r["score"]), r["vec_id"]))
    assert got == brute_top(rows, 64, zero=True)
    assert op1_topk.top_k(table.limit(0), F.col("id") % 20 == 0).count() == 0


def test_forest(spark, sf_dir):
    rows, table = vectors(spark)
    want, hit = brute_top(rows, None, zero=False), 0
    got = defaultdict(list)
    for r in op5_forest.nearest(table, F.col("id") % 20 == 0).orderBy("query_id", "rank").collect():
        got[r["query_id"]].append(r["vec_id"])
    assert {q: len(v) for q, v in got.items()} == {q: len(v) for q, v in want.items()}
    for q, own in want.items():
        hit += len(set(got[q]) & {i for _, i in own})
    assert hit >= 0.9 * 20 * len(want)
    assert op5_forest.nearest(table.limit(0), F.col("id") % 20 == 0).count() == 0


def test_forest_recall(spark, sf_dir):
    rows = spark.read.parquet(f"{sf_dir}/embeddings.parquet").collect()
    vec = np.array([r["embedding"] for r in rows], dtype=float)
    ids = np.array([r["vec_id"] for r in rows])
    hit = total = 0
    got = defaultdict(set)
    for r in op5_forest.op5_forest(spark, sf_dir).collect():
        got[r["query_id"]].add(r["vec_id"])
    for at in np.flatnonzero(ids % 20 == 0):
        scores = vec @ vec[at]
        scores[at] = -np.inf
        hit += len(set(ids[np.lexsort((ids, -scores))[:20]]) & got[ids[at]])
        total += 20
    assert hit >= 0.9 * total


def test_forest_names_a_vector_once(spark):
    """Scores do not depend on the leaf that a vector is met in, so each (query, vec_id) is there once."""
    random = np.random.default_rng(4)
    vec = random.normal(size=(3000, 48))
    table = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(vec)], "vec_id bigint, embedding array<double>")
    got = defaultdict(list)
    for r in op5_forest.nearest(table, F.col("id") % 20 == 0, recall=1.0).orderBy("query_id", "rank").collect():
        got[r["query_id"]].append((r["vec_id"], r["score"]))
    assert sorted(got) == list(range(0, 3000, 20))
    for q, own in got.items():
        assert len({i for i, _ in own}) == len(own) == 20
        for i, score in own:
            assert score == np.cumsum(vec[q] * vec[i])[-1]


def test_scan_scores_do_not_depend_on_the_block():
    random = np.random.default_rng(6)
    vec, asked = random.normal(size=(90, 48)), random.normal(size=(7, 48))

    def scores(n, m):
        rows = pa.table({"v": pa.array(vec[:n].tolist()), "ids": pa.array([[i] for i in range(n)], type=pa.list_(pa.int64()))})
        asks = pa.table({"query": pa.array(np.arange(1000, 1000 + m)), "q": pa.array(asked[:m].tolist()), "floor": pa.array(np.full(m, -np.inf))})
        found = vectors_module._best(200, False)((0, 0, 0), rows, asks).to_pylist()
        return {(r["query"], r["vec_id"]): r["score"] for r in found}

    every = scores(90, 7)
    assert len(every) == 630
    for n, m in ((1, 1), (2, 3), (17, 1), (64, 4), (89, 6)):
        assert scores(n, m).items() <= every.items()


def test_packing_cache_keeps_what_is_asked_for_most(monkeypatch):
    path = public_tokenizers.path("word_bpe_49k.json")
    texts = [f"the the. word{i} Ünï{'abcdefghij'[i % 10]}x, $$ {i}".encode() for i in range(60)] + [b""]
    want = [op9_packing.WordTokens(path)([t])[0].tolist() for t in texts[::12]]
    monkeypatch.setattr(op9_packing, "KNOWN", 20)
    tokens = op9_packing.WordTokens(path)
    for lo in range(0, len(texts), 5):
        tokens(texts[lo : lo + 5])
    assert [tokens([t])[0].tolist() for t in texts[::12]] == want
    assert b"the" in tokens.parts.place and len(tokens.parts.place) < 60
    assert Tokenizer.from_file(path).encode(texts[0].decode(), add_special_tokens=False).ids == want[0]
