"""Personal data: base patterns, and identifiers in other spellings found through the contexts that base finds stand in.

Base finds are the seeds. Every seed and every other number or address of a fitting shape (a candidate) is an instance that stands in
lexical patterns: the words around it. Spark scores the pattern-instance graph in rounds until nothing changes: a pattern is as good as
the share of its distinct instances that are known, counted against one made-up stranger, and an instance is trusted as far as its best
pattern of each shape together. Candidates that come to the threshold are known from then on, like seeds, so that the patterns they stand
in find further ones; trust below it counts half, so that instances which only support each other stay out. Those above the threshold are
reported beside the base finds, which always stay; a candidate that spells a base find of any text is trusted from the start.
"""

from __future__ import annotations

import re
from bisect import bisect_left
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from tidewell.llm import flat
from tidewell.llm.rows import NULL_ID, body, packed, row_type, unpacked
from tidewell.session import settle

KINDS = ("email", "ip", "card", "phone")
# The base patterns.
EMAIL = re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
IP = re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")
CARD = re.compile(r"[0-9]([\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")

LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
HINT = re.compile(r"[0-9@]|[\[(]at[\])]")
#: What may be an identifier in another spelling: (kind, pattern); numbers are told apart by their digits.
OTHER = (
    ("email", re.compile(r"[\w.%+-]{2,64}\x20?(?:@|\[at\]|\(at\))\x20?[\w-]+(?:\x20?(?:\.|\[dot\]|\(dot\))\x20?[\w-]+)+")),
    ("ip", re.compile(r"(?<![\w.])[0-9]{1,3}(?:(?:\[\.\]|\(\.\)|\x20\.\x20)[0-9]{1,3}){3}(?!\w)")),
    ("", re.compile(r"(?<![\w.,+])\(?[0-9](?:[\x20().\-/]{0,2}[0-9]){6,18}(?![\w])")),
)
#: The signs of an address, plain or spelled out.
SPELLED = re.compile(r"\x20?(?:@|\[at\]|\(at\)|\.|\[dot\]|\(dot\))\x20?")
DIGITS = re.compile(r"[0-9]+")
WORD = re.compile(r"[^\W\d_]+")
NEAR = 48

SEEDS = 3
TRUST = 0.8
#: What trust below the threshold counts beside a known instance, and the change of trust that ends the rounds.
PARTIAL, TOLERANCE = 0.5, 1e-3

FOUND = "base array<struct<kind:int,start:int,stop:int>>, hits array<struct<kind:int,seed:boolean,start:int,stop:int,value:string,pattern:string>>"


def _luhn(digits: str) -> bool:
    total = 0
    for i, d in enumerate(reversed(digits)):
        n = int(d) * (1 + i % 2)
        total += n - 9 * (n > 9)
    return total % 10 == 0


def _emails(text: str) -> Iterator[tuple[int, int]]:
    """The matches of EMAIL; only the places before an @ are tried, as no other can match."""
    after, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > after and text[start - 1] in LOCAL:
            start -= 1
        match = EMAIL.match(text, start) if start < at else None
        if match:
            yield match.span()
            after = match.end()
        at = text.find("@", max(at + 1, after))


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(kind, start, stop) of every base find, leftmost and without overlap for each kind."""
    spans = []
    if "@" in text:
        spans += [(0, a, b) for a, b in _emails(text)]
    for match in IP.finditer(text):
        parts = [p.lstrip("0") for p in match[0].split(".")]
        if all(len(p) < 4 and int(p or 0) <= 255 for p in parts):
            spans.append((1, *match.span()))
    for match in CARD.finditer(text):
        digits = match[0].replace(" ", "").replace("-", "")
        if 16 <= len(digits) <= 19 and _luhn(digits):
            spans.append((2, *match.span()))
    if "+" in text:
        for match in PHONE.finditer(text):
            if 8 <= sum("0" <= c <= "9" for c in match[0]) <= 15:
                spans.append((3, *match.span()))
    return spans


def _patterns(text: str, start: int, stop: int) -> list[str]:
    """The contexts of a span: the two words before it, and the word on each side; of a fixed reach, on the same line."""
    left = text[max(0, start - NEAR) : start].rpartition("\n")[2]
    right = text[stop : stop + NEAR].partition("\n")[0]
    before, after = WORD.findall(left.lower()), WORD.findall(right.lower())
    made = []
    if len(before) > 1:
        made.append(f"{before[-2]} {before[-1]} _")
    if before and after:
        made.append(f"{before[-1]} _ {after[0]}")
    return made


def _joined(spans: list[tuple[int, int]]) -> tuple[list[int], list[int]]:
    """Starts and stops of the stretches that spans cover, in order and without overlap."""
    starts, stops = [], []
    for start, stop in sorted(spans):
        if stops and start < stops[-1]:
            stops[-1] = max(stops[-1], stop)
        else:
            starts.append(start)
            stops.append(stop)
    return starts, stops


def _candidates(text: str, taken: list[tuple[int, int, int]]) -> Iterator[tuple[int, int, int]]:
    """(kind, start, stop) of spans of a fitting shape that touch no base find and no other candidate."""
    busy = [(a, b) for _, a, b in taken]
    for name, pattern in OTHER:
        if name == "email" and "@" not in text and "at]" not in text and "at)" not in text:
            continue
        starts, stops = _joined(busy)
        for match in pattern.finditer(text):
            start, stop = match.span()
            before = bisect_left(starts, stop) - 1
            if before >= 0 and stops[before] > start:
                continue
            digits = sum(c.isdigit() for c in match[0])
            kind = KINDS.index(name) if name else 2 if digits >= 13 else 3
            busy.append((start, stop))
            yield kind, start, stop


def _value(kind: int, span: str) -> str:
    """What all spellings of an identifier share: an address without blanks and brackets, the digits of a number."""
    if kind > 1:
        return "".join(c for c in span if c.isdigit())
    if kind == 1:
        return ".".join(part.lstrip("0") or "0" for part in DIGITS.findall(span))
    return SPELLED.sub(lambda m: "@" if "at" in m[0] or m[0].strip() == "@" else ".", span.lower())


@flat.tidy
def _found(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    span = [("kind", pa.int32()), ("start", pa.int32()), ("stop", pa.int32())]
    hit = [("kind", pa.int32()), ("seed", pa.bool_()), *span[1:], ("value", pa.string()), ("pattern", pa.string())]
    for batch in batches:
        base, hits = [], []
        for text in batch.column(2).to_pylist():
            own, seen = [], []
            if HINT.search(text):
                own = base_spans(text)
                both = [(True, *s) for s in own] + [(False, *s) for s in _candidates(text, own)]
                for seed, kind, a, b in both:
                    value = _value(kind, text[a:b])
                    for pattern in _patterns(text, a, b) or [""]:
                        seen.append({"kind": kind, "seed": seed, "start": a, "stop": b, "value": value, "pattern": pattern})
            base.append([{"kind": k, "start": a, "stop": b} for k, a, b in own])
            hits.append(seen)
        columns = [batch.column(0), batch.column(1), pa.array(base, type=pa.list_(pa.struct(span))), pa.array(hits, type=pa.list_(pa.struct(hit)))]
        yield pa.record_batch(columns, names=["k", "t", "base", "hits"])


def _shape(kind: Column) -> Column:
    """Cards and phones are told apart by their digits alone, as a candidate's kind is a guess."""
    return F.least(kind, F.lit(2))


def trusted(edges: DataFrame, seeds: int = SEEDS, threshold: float = TRUST, tolerance: float = TOLERANCE) -> DataFrame:
    """(kind, value, trust) of seeds and candidates in the pattern-instance graph (kind, seed, value, pattern).

    Seeds have trust 1, candidates 0 to begin with; a value that is a seed anywhere is one everywhere, of the seed's kind. The empty
    pattern is none. Known are seeds and candidates at the threshold; a pattern counts once it has ``seeds`` of them. Its score is their
    number and PARTIAL of the trust of its other instances, over all its instances and one more. The trust of a candidate is that of its
    best pattern before it and its best pattern around it together. Trust never falls, so the rounds end at the least fixed point,
    when no trust rises by more than ``tolerance``.
    """
    graph = settle(edges.groupBy("kind", "pattern", "value").agg(F.max("seed").alias("seed")), "graph")
    sure = settle(graph.where("seed").groupBy(_shape(F.col("kind")).alias("shape"), "value").agg(F.min("kind").alias("sure")), "sure")
    places = graph.where("pattern <> ''").withColumn("shape", _shape(F.col("kind"))).join(sure, ["shape", "value"], "left")
    places = places.groupBy(F.coalesce("sure", "kind").alias("kind"), "pattern", "value").agg(F.max(F.col("sure").isNotNull()).alias("seed"))
    graph = settle(places, "places")
    useful = graph.groupBy("kind", "pattern").agg(F.sum(F.col("seed").cast("int")).alias("seeds"), F.count(F.lit(1)).alias("n"))
    useful = useful.where((F.col("n") >= seeds) & (F.col("seeds") < F.col("n"))).select("kind", "pattern", "n", "seeds")
    open_edges = settle(graph.where("not seed").join(useful, ["kind", "pattern"]).select("kind", "pattern", "value", "n", "seeds"), "open")
    trust = open_edges.select("kind", "value").distinct().withColumn("trust", F.lit(0.0))
    known, before = F.col("trust") >= threshold, F.col("pattern").endswith(" _")
    while True:
        places = open_edges.join(trust, ["kind", "value"]).groupBy("kind", "pattern")
        sums = places.agg(F.first("n").alias("n"), (F.first("seeds") + F.count_if(known)).alias("known"), F.sum(F.when(~known, F.col("trust"))).alias("partly"))
        scores = sums.where(F.col("known") >= seeds).select("kind", "pattern", ((F.col("known") + PARTIAL * F.coalesce("partly", F.lit(0.0))) / (F.col("n") + 1)).alias("score"))
        best = [F.coalesce(F.max(F.when(side, F.col("score"))), F.lit(0.0)) for side in (before, ~before)]
        risen = open_edges.join(scores, ["kind", "pattern"]).groupBy("kind", "value").agg((1 - (1 - best[0]) * (1 - best[1])).alias("now"))
        now = F.coalesce("now", F.lit(0.0))
        moved = trust.join(risen, ["kind", "value"], "left").select("kind", "value", now.alias("trust"), (now - F.col("trust")).alias("rise"))
        moved = settle(moved, "trust")
        rise = moved.agg(F.max("rise")).first()[0]
        trust = moved.drop("rise")
        if rise is None or rise <= tolerance:
            break
    return trust.unionByName(sure.select(F.col("sure").alias("kind"), "value", F.lit(1.0).alias("trust")))


def find(docs: DataFrame, key: str = "doc_id", text: str = "text", threshold: float = TRUST) -> DataFrame:
    """(k, t, base, added) for every row: spans (kind, start, stop) in code points, stop exclusive; kind counts along KINDS.

    Null and empty texts have no spans. ``k`` is the id, a null one counting as the smallest; ``t`` tells apart rows that share an
    id; rows that share both are alike.
    """
    schema = f"k bigint, t bigint, {FOUND}"
    seen = packed(docs, key, text).select("k", "t", body(text)).mapInArrow(_found, schema)
    seen = settle(seen, "found")
    hits = seen.select("k", "t", F.explode("hits").alias("hit")).select("k", "t", "hit.*")
    trust = trusted(hits.select("kind", "seed", "value", "pattern"), threshold=threshold)
    good = trust.where(F.col("trust") >= threshold).select(_shape(F.col("kind")).alias("shape"), "value", "kind")
    others = hits.where("not seed").withColumn("shape", _shape(F.col("kind"))).drop("kind")
    added = others.join(good, ["shape", "value"]).groupBy("k", "t").agg(F.collect_set(F.struct("kind", "start", "stop")).alias("added"))
    none = F.array().cast("array<struct<kind:int,start:int,stop:int>>")
    return seen.select("k", "t", "base").join(added, ["k", "t"], "left").select("k", "t", "base", F.coalesce("added", none).alias("added"))


def counted(spans: Column, kind: int) -> Column:
    """How many of the spans are of a kind."""
    return F.size(F.filter(spans, lambda s: s["kind"] == kind)).cast("bigint")


def listed(spans: Column) -> Column:
    """kind:start:stop of each span by kind, then start, joined by commas."""
    names = F.array(*map(F.lit, KINDS))
    told = F.transform(F.array_sort(spans), lambda s: F.concat_ws(":", F.element_at(names, s["kind"] + 1), s["start"].cast("string"), s["stop"].cast("string")))
    return F.array_join(told, ",")


@flat.tidy
def _masked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        out = []
        for text, spans in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist()):
            parts, done = [], 0
            for s in sorted(spans, key=lambda s: (s["start"], -s["stop"])):
                if s["start"] >= done:
                    parts += [text[done : s["start"]], f"<{KINDS[s['kind']].upper()}>"]
                done = max(done, s["stop"])
            out.append("".join(parts) + text[done:] if parts else text)
        yield pa.record_batch([batch.column(0), pa.array(out, type=pa.string())], names=["row", "masked"])


def mask(docs: DataFrame, key: str = "doc_id", text: str = "text", threshold: float = TRUST) -> DataFrame:
    """``docs`` with masked: the text with <KIND> in place of each span; of overlapping spans the first gives the kind."""
    spans = find(docs, key, text, threshold).select("k", "t", F.concat("base", "added").alias("spans")).where(F.size("spans") > 0).dropDuplicates(["k", "t"])
    none = F.array().cast("array<struct<kind:int,start:int,stop:int>>")
    joined = packed(docs, key, text).join(spans, ["k", "t"], "left").select("row", body(text), F.coalesce("spans", none).alias("spans"))
    return unpacked(joined.mapInArrow(_masked, f"row {row_type(joined)}, masked string"), docs, masked=F.col("masked"))


def op4_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counts and base_sha256 are of base finds, spans has the added ones too."""
    found = find(spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text"))
    counts = [counted(F.col("base"), i).alias(f"n_{name}") for i, name in enumerate(KINDS)]
    both = F.concat("base", "added")
    return found.select(F.when(F.col("k") != NULL_ID, F.col("k")).alias("doc_id"), *counts, F.sha2(listed(F.col("base")), 256).alias("base_sha256"), listed(both).alias("spans"))
