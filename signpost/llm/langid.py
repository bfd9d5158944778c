"""Language identification of mixed-language text.

A word's script narrows the languages it may belong to; its letter n-grams and the word itself
score those by naive Bayes. Viterbi then finds the labels of all words with the best total, where
each change of language costs a penalty, and runs of equal labels are the spans. A document's
language is the one with most letters.

The model is counted by Spark over all labelled training texts: one number for each language and
hashed feature, so its size is `languages * FEATURES` whatever the corpus. It is sent to the
workers inside the task.

Defined results: a text that is null or has no letters is `und` with score 0; without training
texts all are; rows that repeat an id are labelled each on their own; an empty table gives no
rows; other columns are not looked at.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

UNKNOWN = "und"
WORDS = re.compile(r"[^\W\d_]+")
FEATURES = 1 << 15
SWITCH = 12.0  # what a change of language costs, in nats
CLIP = 6.0  # the most that one word says against a language
_HELD_WORDS = 500_000
_SLICE = 1_000_000  # characters handled at a time

# First and last code point of the letters of a script.
SCRIPTS = (
    ("Latin", 0x0041, 0x024F),
    ("Greek", 0x0370, 0x03FF),
    ("Cyrillic", 0x0400, 0x052F),
    ("Armenian", 0x0530, 0x058F),
    ("Hebrew", 0x0590, 0x05FF),
    ("Arabic", 0x0600, 0x077F),
    ("Devanagari", 0x0900, 0x097F),
    ("Bengali", 0x0980, 0x09FF),
    ("Tamil", 0x0B80, 0x0BFF),
    ("Thai", 0x0E00, 0x0E7F),
    ("Georgian", 0x10A0, 0x10FF),
    ("Hangul", 0xAC00, 0xD7AF),
    ("Kana", 0x3040, 0x30FF),
    ("Han", 0x4E00, 0x9FFF),
)
OTHER = len(SCRIPTS)


def script_of(word: str) -> int:
    code = ord(word[0])
    for k, (_, first, last) in enumerate(SCRIPTS):
        if first <= code <= last:
            return k
    return OTHER


def _hashed(x: np.ndarray, kind: int) -> np.ndarray:
    with np.errstate(over="ignore"):
        x = (x + np.uint64(kind)) * np.uint64(0x9E3779B97F4A7C15)
    return ((x >> np.uint64(40)) % np.uint64(FEATURES)).astype(np.int64)


def features(words: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """(feature, word's place) of all words: hashed n-grams of one to three letters with the
    word's edges, and the word itself."""
    letters = np.frombuffer("".join([f"<{w}>" for w in words]).encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.uint64)
    sizes = np.fromiter(map(len, words), np.int64, len(words)) + 2
    owner = np.repeat(np.arange(len(words)), sizes)
    starts = np.cumsum(sizes) - sizes
    step = np.uint64(1 << 21)
    with np.errstate(over="ignore"):
        two = letters[:-1] * step + letters[1:]
        three = two[:-1] * step + letters[2:]
        place = np.arange(len(letters)) - starts[owner]
        powers = np.cumprod(np.full(int(sizes.max(initial=1)) + 1, 1_000_003, np.uint64))
        whole = np.add.reduceat(letters * powers[place], starts) if len(words) else np.empty(0, np.uint64)
    inside2, inside3 = owner[:-1] == owner[1:], owner[:-2] == owner[2:]
    found = [_hashed(letters, 1), _hashed(two[inside2], 2), _hashed(three[inside3], 3), _hashed(whole, 4)]
    owners = [owner, owner[:-1][inside2], owner[:-2][inside3], np.arange(len(words))]
    return np.concatenate(found), np.concatenate(owners)


def words_of(text: str | None) -> list[str]:
    return WORDS.findall(text.lower()) if text else []


def _slices(words: list[str], size: int = 50_000) -> Iterator[list[str]]:
    for start in range(0, len(words), size):
        yield words[start : start + size]


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sums of features and scripts per language, a few languages at a time."""
    held: dict[str, np.ndarray] = {}

    def flush() -> Iterator[pa.RecordBatch]:
        for lang, counts in held.items():
            at = np.flatnonzero(counts)
            yield pa.record_batch(
                [pa.array([lang] * len(at)), pa.array(at, pa.int32()), pa.array(counts[at], pa.int64())],
                ["lang", "feature", "seen"],
            )
        held.clear()

    for batch in batches:
        langs = batch.column("lang").to_pylist()
        words: dict[str, Counter] = {}
        for lang, text in zip(langs, batch.column("text")):
            words.setdefault(lang, Counter()).update(words_of(text.as_py()))
        for lang, seen in words.items():
            counts = held.setdefault(lang, np.zeros(FEATURES + OTHER + 1, np.int64))
            for some in _slices(list(seen)):
                times = np.fromiter(map(seen.__getitem__, some), np.int64, len(some))
                feature, owner = features(some)
                counts += np.bincount(feature, times[owner], len(counts)).astype(np.int64)
                script = np.fromiter(map(script_of, some), np.int64, len(some))
                counts += np.bincount(FEATURES + script, times, len(counts)).astype(np.int64)
        if len(held) > 50:
            yield from flush()
    yield from flush()


@dataclass
class Model:
    languages: list[str]
    weights: np.ndarray  # (FEATURES, languages): log-probabilities
    scripts: np.ndarray  # (scripts, languages): whether the language uses the script


def train(docs: DataFrame, share: float = 0.01) -> Model:
    """A model from the non-null `lang` and text of `docs`; a language uses the scripts of that share of its words."""
    labelled = docs.where("lang is not null and text is not null").select("lang", "text")
    counts = (
        labelled.mapInArrow(_count, "lang string, feature int, seen bigint")
        .groupBy("lang", "feature")
        .agg(F.sum("seen").alias("seen"))
        .toArrow()
    )
    languages = sorted(set(counts.column("lang").to_pylist()))
    place = {lang: k for k, lang in enumerate(languages)}
    table = np.zeros((FEATURES + OTHER + 1, len(languages)))
    columns = np.array([place[lang] for lang in counts.column("lang").to_pylist()], int)
    table[np.asarray(counts.column("feature")), columns] = np.asarray(counts.column("seen"))
    grams, scripts = table[:FEATURES], table[FEATURES:]
    weights = np.log((grams + 0.5) / (grams.sum(axis=0) + 0.5 * FEATURES))
    uses = scripts >= np.maximum(1, share * scripts.sum(axis=0))
    return Model(languages, weights.astype(np.float32), uses)


class _WordScores(dict):
    """word -> row of `rows`: what the word says for each language, 0 for the best and down to -CLIP."""

    def __init__(self, model: Model):
        self.model = model
        self.weights = np.ascontiguousarray(model.weights.T)
        self.rows = np.zeros((0, len(model.languages)), np.float32)

    def _learn(self, words: list[str]) -> None:
        feature, owner = features(words)
        score = np.column_stack([np.bincount(owner, w[feature], len(words)) for w in self.weights]) / 2
        uses = self.model.scripts[np.fromiter(map(script_of, words), np.int64, len(words))]
        # A script that no language uses leaves all of them.
        none = ~uses.any(axis=1)
        score = np.where(uses, score, -np.inf)
        score[none] = 0
        best = score.max(axis=1, keepdims=True)
        self.update(zip(words, range(len(self), len(self) + len(words))))
        self.rows = np.concatenate([self.rows, np.maximum(score - best, -CLIP).astype(np.float32)])

    def of(self, words: list[str]) -> np.ndarray:
        if len(self) > _HELD_WORDS:
            self.clear()
            self.rows = self.rows[:0]
        for some in _slices(list(set(words) - self.keys())):
            self._learn(some)
        return self.rows[np.fromiter(map(self.__getitem__, words), np.int64, len(words))]


def viterbi(scores: np.ndarray, penalty: float = SWITCH) -> np.ndarray:
    """The label of each word on the best path."""
    totals = scores.sum(axis=0, dtype=np.float64)
    best = int(totals.argmax())
    gains = np.cumsum(scores - scores[:, best : best + 1], axis=0, dtype=np.float64)
    lowest = np.minimum.accumulate(np.vstack([np.zeros((1, scores.shape[1])), gains[:-1]]), axis=0)
    # A path with k stretches of other languages pays at least k penalties, or k - 1 if it has no
    # word in the best one. So none beats the path without changes if no stretch gains more than
    # a penalty, and a first and a last one together don't either.
    ends = max(gains.max(), 0.0) + max((gains[-1] - gains).max(), gains[-1].max(), 0.0)
    if (gains - lowest).max() <= penalty and ends <= penalty:
        return np.full(len(scores), best)
    rows = scores.tolist()
    now, came = rows[0], []
    for row in rows[1:]:
        top = max(now)
        leader = now.index(top)
        after = top - penalty
        came.append([k if v >= after else leader for k, v in enumerate(now)])
        now = [(v if v >= after else after) + s for v, s in zip(now, row)]
    label = now.index(max(now))
    path = [label]
    for step in reversed(came):
        label = step[label]
        path.append(label)
    return np.array(path[::-1])


def _spans(text: str, path: np.ndarray, languages: list[str]) -> list[dict]:
    """Runs of equal labels with their character positions."""
    edges = [0, *(np.flatnonzero(np.diff(path)) + 1), len(path)]
    if len(edges) == 2:
        return [{"start": 0, "end": len(text), "lang": languages[path[0]]}]
    lowered = text.lower()
    # Lower case may be longer than the text; positions then are those of the lower case.
    starts = [m.start() for m in WORDS.finditer(lowered)]
    at = [0, *(starts[e] for e in edges[1:-1]), len(text)]
    return [{"start": a, "end": b, "lang": languages[path[e]]} for a, b, e in zip(at, at[1:], edges)]


def label(
    docs: DataFrame, model: Model, spans: bool = False, keep: list[str] | None = None, text_column: str = "text"
) -> DataFrame:
    """The columns `keep` (doc_id), lang_pred, score, n_spans for each row.

    `spans` adds start, end and lang of each span.

    The score is the language's share of the letters times its probability among the languages.
    """
    kept = keep or ["doc_id"]
    kinds = ", ".join(f"`{c}` {docs.schema[c].dataType.simpleString()}" for c in kept)

    def one(text: str | None, words: list[str], scores: np.ndarray) -> tuple:
        if not words or not model.languages:
            return UNKNOWN, 0.0, 0, []
        path = viterbi(scores)
        letters = np.bincount(path, [len(w) for w in words], len(model.languages))
        best = int(letters.argmax())
        mean = scores.mean(axis=0, dtype=np.float64)
        odds = np.exp((mean - mean.max()) * min(len(words), 8))
        score = float(letters[best] / letters.sum() * odds[best] / odds.sum())
        count = int(np.count_nonzero(np.diff(path))) + 1
        return model.languages[best], score, count, _spans(text, path, model.languages) if spans else []

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = _WordScores(model)
        for batch in batches:
            out, texts = [], batch.column(text_column)
            at = 0
            while at < len(texts):
                held, chars = [], 0
                while at < len(texts) and chars < _SLICE:
                    text = texts[at].as_py()
                    held.append((text, words_of(text)))
                    chars += len(text or "")
                    at += 1
                flat = [w for _, words in held for w in words]
                scores = known.of(flat) if model.languages else np.zeros((len(flat), 0), np.float32)
                start = 0
                for text, words in held:
                    out.append(one(text, words, scores[start : start + len(words)]))
                    start += len(words)
            columns = [
                *(batch.column(c) for c in kept),
                pa.array([o[0] for o in out], pa.string()),
                pa.array([o[1] for o in out], pa.float64()),
                pa.array([o[2] for o in out], pa.int64()),
            ]
            names = [*kept, "lang_pred", "score", "n_spans"]
            if spans:
                parts = pa.struct([("start", pa.int64()), ("end", pa.int64()), ("lang", pa.string())])
                columns.append(pa.array([o[3] for o in out], pa.list_(parts)))
                names.append("spans")
            yield pa.record_batch(columns, names)

    schema = f"{kinds}, lang_pred string, score double, n_spans bigint"
    more = ", spans array<struct<start: bigint, end: bigint, lang: string>>" if spans else ""
    return docs.select(*dict.fromkeys([*kept, text_column])).mapInArrow(run, schema + more)


def held_out(doc_id: Column) -> Column:
    """Whether a document is kept from training; a null id is."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 4 == 2, F.lit(True))


def labelled(docs: DataFrame) -> DataFrame:
    """doc_id, held_out, lang_pred, score, n_spans of all documents, by a model of those not held out."""
    model = train(docs.where(~held_out(F.col("doc_id"))))
    rows = label(docs, model)
    return rows.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "lang_pred", "score", "n_spans")


def with_language(docs: DataFrame) -> DataFrame:
    """`docs` without the documents that are `und`; their `lang` is the language found."""
    model = train(docs.where(~held_out(F.col("doc_id"))))
    # Columns go by their places, so no name can clash with those of the labels.
    places = [f"c{n}" for n in range(len(docs.columns))]
    text = places[docs.columns.index("text")]
    rows = label(docs.toDF(*places), model, keep=places, text_column=text).where(F.col("lang_pred") != UNKNOWN)
    found = [F.col("lang_pred" if c == "lang" else p).alias(c) for c, p in zip(docs.columns, places)]
    return rows.select(*found)
