"""Language of texts: scripts narrow the candidates, letter trigrams score words, and Viterbi with a switching penalty labels spans.

The model is a table of hashed trigram counts per language, of a fixed size, added up by Spark over all labelled training rows.
"""

from __future__ import annotations

import unicodedata
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from tidewell.llm import flat
from tidewell.llm.rows import packed, row_type, unpacked

BUCKETS = 1 << 15
LANGUAGES = 200
SMOOTH = 0.5
SWITCH = 18.0
EXCLUDED = -1000.0
USES = 0.01
#: Texts of two languages lie at least this far apart in log probability per trigram; nearer ones are kinds of one language.
APART = 1.0

# Code point ranges of scripts, from the Unicode block chart.
SCRIPTS = {
    "latin": [(0x41, 0x24F), (0x1E00, 0x1EFF), (0x2C60, 0x2C7F), (0xA720, 0xA7FF), (0xFF21, 0xFF5A)],
    "greek": [(0x370, 0x3FF), (0x1F00, 0x1FFF)],
    "cyrillic": [(0x400, 0x52F), (0x1C80, 0x1C8F), (0x2DE0, 0x2DFF), (0xA640, 0xA69F)],
    "armenian": [(0x530, 0x58F)],
    "hebrew": [(0x590, 0x5FF)],
    "arabic": [(0x600, 0x6FF), (0x750, 0x77F), (0x8A0, 0x8FF), (0xFB50, 0xFDFF), (0xFE70, 0xFEFF)],
    "devanagari": [(0x900, 0x97F), (0xA8E0, 0xA8FF)],
    "bengali": [(0x980, 0x9FF)],
    "tamil": [(0xB80, 0xBFF)],
    "telugu": [(0xC00, 0xC7F)],
    "thai": [(0xE00, 0xE7F)],
    "georgian": [(0x10A0, 0x10FF), (0x1C90, 0x1CBF), (0x2D00, 0x2D2F)],
    "hangul": [(0x1100, 0x11FF), (0x3130, 0x318F), (0xAC00, 0xD7AF)],
    "kana": [(0x3040, 0x30FF), (0x31F0, 0x31FF), (0xFF66, 0xFF9F)],
    "han": [(0x2E80, 0x2FDF), (0x3400, 0x4DBF), (0x4E00, 0x9FFF), (0xF900, 0xFAFF), (0x20000, 0x323AF)],
}
N_SCRIPTS = len(SCRIPTS) + 1


@cache
def letters() -> tuple[np.ndarray, np.ndarray]:
    """For each code point: the number of its script (0: other) and whether it is a letter (1) or a mark (2)."""
    script, kind = np.zeros(0x110000, dtype=np.int8), np.zeros(0x110000, dtype=np.int8)
    for number, ranges in enumerate(SCRIPTS.values(), start=1):
        for lo, hi in ranges:
            script[lo : hi + 1] = number
    for code in range(0x110000):
        category = unicodedata.category(chr(code))[0]
        if category in "LM":
            kind[code] = 1 if category == "L" else 2
    return script, kind


def _lowered(text: str) -> str:
    """Lower case, with as many code points as before."""
    low = text.lower()
    return low if len(low) == len(text) else "".join(c if len(c.lower()) != 1 else c.lower() for c in text)


class LetterWords:
    """Runs of letters and marks in some texts: trigram bucket of each of their code points, word starts, scripts, rows."""

    def __init__(self, texts: list[str]):
        script, kind = letters()
        low = [_lowered(t) for t in texts]
        lengths = np.fromiter(map(len, low), dtype=np.int64, count=len(low))
        codes = np.frombuffer("\n".join(low).encode("utf-32-le", "surrogatepass"), dtype=np.uint32).astype(np.int64)
        self.begin = np.cumsum(lengths + 1) - lengths - 1  # of each row, within codes
        inside = kind[codes] > 0
        padded = np.zeros(len(codes) + 2, dtype=np.int64)
        padded[1:-1][inside] = codes[inside]
        at = np.flatnonzero(inside)
        mixed = (padded[at].astype(np.uint64) * np.uint64(0x9E3779B1) + padded[at + 1].astype(np.uint64)) * np.uint64(0x85EBCA6B) + padded[at + 2].astype(np.uint64)
        self.bucket = (flat.mix(mixed) >> np.uint64(49)).astype(np.int64)
        first = np.ones(len(at), dtype=bool)
        first[1:] = at[1:] != at[:-1] + 1
        self.starts = np.flatnonzero(first)  # of each word, within bucket
        self.sizes = np.diff(self.starts, append=len(at))
        is_letter = (kind[codes[at]] == 1).astype(np.int64)
        self.n_letters = np.add.reduceat(is_letter, self.starts) if len(self.starts) else np.zeros(0, dtype=np.int64)
        self.script = script[codes[at[self.starts]]].astype(np.int64)
        self.row = np.searchsorted(self.begin, at[self.starts], side="right") - 1
        self.place = at[self.starts] - self.begin[self.row]
        self.first = np.searchsorted(self.row, np.arange(len(texts) + 1))
        digit = np.zeros(len(codes) + 2, dtype=bool)
        digit[1:-1] = (codes >= 0x30) & (codes <= 0x39)
        begins = at[self.starts]
        self.in_code = digit[begins] | digit[begins + self.sizes + 1]  # letters beside a digit


# ---- learning


@flat.tidy
def _counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(lang, bucket, n) of a task; buckets from BUCKETS on count letters by script."""
    totals: dict[str, np.ndarray] = {}
    for batch in batches:
        langs = batch.column(0).to_pylist()
        _, offsets = flat.bytes_of(batch.column(1))
        for lo, hi in flat.chunks(offsets):
            words = LetterWords(batch.column(1).slice(lo, hi - lo).to_pylist())
            names = sorted(set(langs[lo:hi]))
            number = np.array([names.index(x) for x in langs[lo:hi]], dtype=np.int64)
            width = BUCKETS + N_SCRIPTS
            of_word = number[words.row]
            grams = np.bincount(np.repeat(of_word, words.sizes) * width + words.bucket, minlength=len(names) * width)
            scripts = np.bincount(of_word * width + BUCKETS + words.script, weights=words.n_letters, minlength=len(names) * width)
            table = (grams + scripts.astype(np.int64)).reshape(len(names), width)
            for name, own in zip(names, table):
                totals[name] = totals[name] + own if name in totals else own
    for name, own in totals.items():
        some = np.flatnonzero(own)
        yield pa.record_batch([pa.array([name] * len(some), type=pa.string()), pa.array(some.astype(np.int32)), pa.array(own[some])], names=["lang", "bucket", "n"])


@dataclass
class Model:
    """Log probabilities (bucket, language), which scripts (script, language) a language is written in, and levels (language).

    The level is the log probability per trigram halfway between a language's own texts and those of the other languages.
    """

    names: list[str]
    scores: np.ndarray
    written: np.ndarray
    levels: np.ndarray


def _levels(grams: np.ndarray, scores: np.ndarray) -> np.ndarray:
    """Halfway between own and foreign texts; without another language, trigrams drawn evenly are the foreign text."""
    mean = (grams / np.maximum(grams.sum(axis=0), 1)).T @ scores  # (text's language, model's language)
    own, evenly = np.diag(mean), scores.mean(axis=0)
    far = (mean < own - APART) & (grams.sum(axis=0) > 0)[:, None]
    foreign = np.where(far.any(axis=0), np.where(far, mean, 0).sum(axis=0) / np.maximum(far.sum(axis=0), 1), evenly)
    return (own + foreign) / 2


def learn(labelled: DataFrame, text: str = "text", lang: str = "lang", most: int = LANGUAGES) -> Model:
    """A model from all rows with a label; rows without label or text teach nothing. More than ``most`` labels are an error.

    The table is added up by Spark; the driver gets at most BUCKETS + N_SCRIPTS numbers per language, one language at a time.
    """
    rows = labelled.select(F.col(f"`{lang}`").cast("string").alias("lang"), F.col(f"`{text}`").alias("body")).where("lang is not null and body is not null")
    sums = rows.mapInArrow(_counts, "lang string, bucket int, n bigint").groupBy("lang", "bucket").agg(F.sum("n").alias("n"))
    names = sorted(r["lang"] for r in rows.select("lang").distinct().limit(most + 1).collect())
    if len(names) > most:
        raise ValueError(f"more than {most} languages")
    counts = np.zeros((BUCKETS + N_SCRIPTS, len(names)))
    place = {name: i for i, name in enumerate(names)}
    for row in sums.groupBy("lang").agg(F.collect_list("bucket").alias("buckets"), F.collect_list("n").alias("n")).toLocalIterator():
        counts[row["buckets"], place[row["lang"]]] = row["n"]
    grams, scripts = counts[:BUCKETS], counts[BUCKETS:]
    scores = np.log((grams + SMOOTH) / (grams.sum(axis=0) + SMOOTH * BUCKETS)).astype(np.float32)
    return Model(names, scores, scripts > USES * np.maximum(scripts.sum(axis=0), 1), _levels(grams, scores))


# ---- labelling


def viterbi(scores: np.ndarray, lengths: np.ndarray, switch: float) -> np.ndarray:
    """The best label of each word; scores (words, labels) of rows one after the other, longest row first."""
    lanes, steps, labels = len(lengths), int(lengths[0]), scores.shape[1]
    begin = np.cumsum(lengths) - lengths
    alive = lanes - np.searchsorted(np.sort(lengths), np.arange(steps), side="right")
    back = np.zeros((steps, lanes, labels), dtype=np.int16)
    value = scores[begin].astype(np.float64)
    own = np.arange(labels)
    for step in range(1, steps):
        n = alive[step]
        now = value[:n]
        best = now.argmax(axis=1)
        other = now[np.arange(n), best][:, None] - switch
        stay = now >= other
        back[step, :n] = np.where(stay, own, best[:, None])
        value[:n] = np.where(stay, now, other) + scores[begin[:n] + step]
    out = np.empty(len(scores), dtype=np.int64)
    label = np.zeros(lanes, dtype=np.int64)
    for step in range(steps - 1, -1, -1):
        n = alive[step]
        ending = lengths[:n] == step + 1
        label[:n] = np.where(ending, value[:n].argmax(axis=1), label[:n])
        out[begin[:n] + step] = label[:n]
        label[:n] = back[step, np.arange(n), label[:n]]
    return out


def word_labels(words: LetterWords, model: Model, switch: float) -> np.ndarray:
    """A label for each word.

    A row keeps one label where no run of words gains more than half the switching penalty under another: n runs of other labels need
    n - 1 changes at least, one run that is not the whole row one. Only the other rows need the full search.
    """
    n = len(words.starts)
    scores = np.add.reduceat(model.scores[words.bucket], words.starts, axis=0).astype(np.float64)
    uses = model.written[words.script]
    known = uses.any(axis=1)
    scores = np.where(uses, scores, np.where(known[:, None], EXCLUDED, 0.0))
    rows = np.flatnonzero(np.diff(words.first))
    begin = words.first[rows]
    best = np.add.reduceat(scores, begin, axis=0).argmax(axis=1)
    counts = np.diff(words.first)[rows]
    labels = np.repeat(best, counts)
    gain = scores - scores[np.arange(n), labels][:, None]
    lane = np.repeat(np.arange(len(rows)), counts)
    after = np.cumsum(gain, axis=0)
    lowest = np.minimum.accumulate(after - gain - lane[:, None] * 1e9, axis=0) + lane[:, None] * 1e9
    rise = np.maximum.reduceat((after - lowest).max(axis=1), begin)
    mixed = np.flatnonzero(rise > switch / 2 - 0.1)
    mixed = mixed[np.argsort(-counts[mixed], kind="stable")]
    for lo in range(0, len(mixed), 64):
        some = mixed[lo : lo + 64]
        at = np.concatenate([np.arange(begin[i], begin[i] + counts[i]) for i in some])
        labels[at] = viterbi(scores[at], counts[some], switch)
    return labels


def _nearest(words: LetterWords, model: Model, rows: np.ndarray) -> np.ndarray:
    """The language whose trigrams fit best, for rows without a word in a script of the learned languages."""
    row = np.repeat(words.row, words.sizes)
    mine = rows[row]
    sums = [np.bincount(row[mine], weights=model.scores[words.bucket[mine], i], minlength=len(rows)) for i in range(len(model.names))]
    return np.stack(sums, axis=1)[rows].argmax(axis=1)


def _label(shared, text: str, switch: float) -> Callable:
    @flat.tidy
    def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value
        for batch in batches:
            column = batch.column(0).field(text).fill_null("")
            _, offsets = flat.bytes_of(column)
            for lo, hi in flat.chunks(offsets):
                n = hi - lo
                words = LetterWords(column.slice(lo, n).to_pylist())
                winner, score, fit = np.full(n, -1), np.zeros(n), np.zeros(n)
                spans: list[list[dict]] = [[] for _ in range(n)]
                if len(words.starts) and model.names:
                    labels = word_labels(words, model, switch)
                    known = model.written[words.script].any(axis=1)
                    share = np.bincount(words.row * len(model.names) + labels, weights=words.n_letters * known, minlength=n * len(model.names)).reshape(n, -1)
                    total = np.bincount(words.row, weights=words.n_letters, minlength=n)
                    winner = np.where(share.max(axis=1) > 0, share.argmax(axis=1), -1)
                    score = share.max(axis=1) / np.maximum(total, 1)
                    foreign = (winner < 0) & (total > 0)
                    if foreign.any():
                        winner[foreign] = _nearest(words, model, foreign)
                    of_gram = np.repeat(labels, words.sizes)
                    above = (model.scores[words.bucket, of_gram] - model.levels[of_gram]) * np.repeat(known & ~words.in_code, words.sizes)
                    fit = np.bincount(np.repeat(words.row, words.sizes), weights=above, minlength=n)
                    at = np.flatnonzero(known & (winner[words.row] >= 0))
                    new = np.ones(len(at), dtype=bool)
                    new[1:] = (labels[at[1:]] != labels[at[:-1]]) | (words.row[at[1:]] != words.row[at[:-1]]) | (at[1:] != at[:-1] + 1)
                    head = at[new]
                    last = at[np.append(np.flatnonzero(new)[1:], len(at)) - 1] if len(at) else at
                    stops = words.place[last] + words.sizes[last]
                    for row, start, stop, label in zip(words.row[head].tolist(), words.place[head].tolist(), stops.tolist(), labels[head].tolist()):
                        spans[row].append({"start": start, "stop": stop, "lang": model.names[label]})
                names = np.array([*model.names, "und"], dtype=object)
                yield pa.record_batch(
                    [batch.column(0).slice(lo, n), pa.array(names[winner], type=pa.string()), pa.array(score), pa.array(spans, type=SPANS), pa.array(fit)],
                    names=["row", "lang_pred", "score", "lang_spans", "fit"],
                )

    return of


SPANS = pa.list_(pa.struct([("start", pa.int32()), ("stop", pa.int32()), ("lang", pa.string())]))


def identify(docs: DataFrame, model: Model, text: str = "text", switch: float = SWITCH) -> DataFrame:
    """``docs`` with lang_pred, score, lang_spans (code points, stop exclusive) and fit.

    lang_pred is the language with the most letters, score its share of them; words in a script that no learned language uses count
    for none and stand in no span. A text with letters of such scripts only has the language whose trigrams fit best, with score 0
    and no spans. A null text, or one without a letter, is ``und`` with score 0 and no spans, as is every text if nothing was learned. Ties go to the first name in order. fit is the log probability of the trigrams of all
    words not beside a digit, under their labels, above the languages' levels: far below 0 for a text in no learned language.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)
    source = packed(docs, docs.columns[0], text).select("row")
    made = source.mapInArrow(_label(shared, text, switch), f"row {row_type(source)}, lang_pred string, score double, lang_spans array<struct<start:int,stop:int,lang:string>>, fit double")
    return unpacked(made, docs, lang_pred=F.col("lang_pred"), score=F.col("score"), lang_spans=F.col("lang_spans"), fit=F.col("fit"))


def held_out(key: str = "doc_id"):
    """True where crc32 of the id as text, modulo 4, is 2; false for a null id."""
    return F.coalesce(F.pmod(F.crc32(F.col(f"`{key}`").cast("string").cast("binary")), F.lit(4)) == 2, F.lit(False))


def op6_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text", "lang")
    model = learn(docs.where(~held_out()))
    return identify(docs.select("doc_id", "text"), model).select("doc_id", held_out().alias("held_out"), "lang_pred", "score")
