"""Toxicity by a support vector machine on a subsequence string kernel.

The kernel compares short texts by the three-letter subsequences they share. Letters need not
touch: a subsequence may stretch over five letters, at a discount for every letter in between,
so an insult with a letter put in or left out still resembles itself. Landmark texts span the
feature space (Nyström): a text is its kernel values with the landmarks, made independent by
the inverse root of the landmarks' own kernel matrix.

Labels mark whole documents, insults are single words. So the sentences of labelled documents
are taken apart into words (spelled-out ones put together again); words far more frequent in
toxic documents than in others are the positive examples, frequent words of clean ones the
negative examples. A logistic curve over what the words of a document score gives its score.
"""

from __future__ import annotations

import re
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType

from advisory_lake.llm.shared import ship_package, slices, worker_cache
from advisory_lake.llm.words import as_long, words_of

TRAIN_DOCS = 6_000  # labelled documents of either label that training looks at
TRAIN_WORDS = 4_096  # words of either label
POSITIVE_LANDMARKS, CLOSE_LANDMARKS, FREQUENT_LANDMARKS = 96, 64, 64
LIKELY = 6.0  # times as frequent in toxic documents
LEAST_DOCS = 5  # toxic documents that have a word
SPAN, DISCOUNT = 5, 0.5
CACHED_WORDS = 200_000  # about 40 MB in a worker
LONGEST_CACHED = 40

_STEPS = [(i, j) for j in range(2, SPAN) for i in range(1, j)]
_WEIGHTS = DISCOUNT ** np.arange(SPAN - 2)
_LETTERS = np.uint64(0x110000)
_EDGES = "\"'`*&%$#!.,|?;:()[]{}<>-_/\\=+~^@…«»„“”’‘"
_MARKS = re.compile(r"[^\w]+|_+")
_SPELLED = re.compile(r"(?<!\S)(?:\S\s){3,}\S(?!\S)")


# ---------------------------------------------------------------- the kernel


@dataclass
class Features:
    """Subsequences of texts: rows (text, subsequence, weight), and the length of each text."""

    owner: np.ndarray
    key: np.ndarray
    weight: np.ndarray
    norm: np.ndarray


def subsequences(texts: list[str]) -> Features:
    """Weighted three-letter subsequences; ends of a text count as letters of their own.

    Texts of one length are a block of rows, each sorted for itself. A key has its discount in
    its last two bits while it is sorted; three letters of 0x110000 take 61 bits.
    """
    marked = ["\x02" + text + "\x03" for text in texts]
    letters = np.frombuffer("".join(marked).encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.uint64)
    sizes = np.array([len(text) for text in marked], np.int64)
    begins = np.cumsum(sizes) - sizes
    norm = np.ones(len(texts))
    keys, owners, weights = [np.empty(0, np.uint64)], [np.empty(0, np.int64)], [np.empty(0)]
    for size in np.unique(sizes[sizes > _STEPS[0][1]]).tolist():
        rows = np.flatnonzero(sizes == size)
        block = letters[begins[rows, None] + np.arange(size)]
        packed = np.concatenate(
            [
                ((block[:, : size - j] * _LETTERS + block[:, i : size - j + i]) * _LETTERS + block[:, j:]) << np.uint64(2) | np.uint64(j - 2)
                for i, j in _STEPS
                if j < size
            ],
            axis=1,
        )
        packed.sort(axis=1)
        key = packed >> np.uint64(2)
        new = np.ones(key.shape, bool)
        new[:, 1:] = key[:, 1:] != key[:, :-1]
        first = np.flatnonzero(new)
        total = np.add.reduceat(_WEIGHTS[packed & np.uint64(3)].ravel(), first)
        row = first // key.shape[1]
        norm[rows] = np.sqrt(np.bincount(row, total**2, len(rows)))
        keys.append(key.ravel()[first])
        owners.append(rows[row])
        weights.append(total)
    return Features(np.concatenate(owners), np.concatenate(keys), np.concatenate(weights), norm)


def kernel(texts: list[str], others: list[str]) -> np.ndarray:
    """Normed kernel values of every text with every other."""
    a, b = subsequences(texts), subsequences(others)
    keys, of_b = np.unique(b.key, return_inverse=True)
    dense = np.zeros((len(others), len(keys)))
    dense[b.owner, of_b] = b.weight / b.norm[b.owner]
    at = np.searchsorted(keys, a.key)
    hit = np.flatnonzero((at < len(keys)) & (keys[np.minimum(at, len(keys) - 1)] == a.key)) if len(keys) else []
    result = np.zeros((len(texts), len(others)))
    for start in range(0, len(hit), 20_000):
        part = hit[start : start + 20_000]
        np.add.at(result, a.owner[part], (a.weight[part] / a.norm[a.owner[part]])[:, None] * dense[:, at[part]].T)
    return result


# ---------------------------------------------------------------- the model


@dataclass
class Model:
    """Decision weights of subsequences, so that a word needs no kernel values any more, and the
    curve over documents."""

    keys: np.ndarray
    weights: np.ndarray
    bias: float
    curve: np.ndarray
    landmarks: list[str] = field(default_factory=list)

    def decisions(self, words: list[str]) -> np.ndarray:
        """Distance from the separating plane; above 0 is toxic."""
        found = subsequences(words)
        if not len(self.keys) or not len(words):
            return np.full(len(words), self.bias)
        at = np.minimum(np.searchsorted(self.keys, found.key), len(self.keys) - 1)
        value = np.where(self.keys[at] == found.key, self.weights[at], 0.0) * found.weight
        return np.bincount(found.owner, value, len(words)) / found.norm + self.bias

    def score(self, features: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(features @ self.curve[:-1] + self.curve[-1], -30, 30)))


def words_in(text: str) -> list[str]:
    """Words in lower case, and what runs of single characters spell."""
    lowered = text.lower()
    words = lowered.split()
    if b"\1\1\1\1" not in bytes(map((1).__eq__, map(len, words))):  # four single characters in a row
        return words
    return words + ["".join(found.split()) for found in _SPELLED.findall(lowered)]


def stripped(word: str) -> str:
    return word.strip(_EDGES)


def forms(word: str) -> tuple[str, ...]:
    """What of a word is judged: without marks at its ends, and without any (i.n.s.u.l.t). A word
    of letters and digits alone is its only form."""
    plain, joined = stripped(word), _MARKS.sub("", word)
    return (plain,) if plain == joined else (plain, joined)


class Judge:
    """Scores texts, and remembers words it has seen."""

    def __init__(self, model: Model):
        self.model, self.known = model, {}

    def features(self, texts: list[str | None]) -> np.ndarray:
        """For each text: its highest decision, how many different words are toxic, their share."""
        words = [set(words_in(text)) if text else set() for text in texts]
        if len(self.known) > CACHED_WORDS:
            self.known.clear()
        new = set().union(*words).difference(self.known)
        self.known.update(self.judged(new))
        rows = np.zeros((len(texts), 3))
        rows[:, 0] = -1.0
        for row, some in zip(rows, words):
            if some:
                values = np.fromiter(map(self.known.__getitem__, some), float, len(some))
                toxic = np.clip(2 * values - 0.5, 0, 1).sum()
                row[:] = np.clip(values.max(), -1, 1), np.log1p(toxic), np.log1p(200 * toxic / (len(some) + 20))
        for word in new:
            if len(word) > LONGEST_CACHED:
                del self.known[word]
        return rows

    def judged(self, words: set[str]) -> dict[str, float]:
        """The highest decision on the forms of each word. Each form is judged once; one without
        marks is a word with that form alone, and may be known."""
        marked = {word: forms(word) for word in words if not word.isalnum()}
        plain = words.difference(marked)
        value = {form: self.known[form] for some in marked.values() for form in some if form in self.known and form.isalnum()}
        every = sorted(plain.union(*marked.values()).difference(value), key=len)
        for start in range(0, len(every), 4096):
            part = every[start : start + 4096]
            value.update(zip(part, self.model.decisions(part).tolist()))
        highest = {word: max(value[form] for form in some) for word, some in marked.items()}
        return highest | {word: value[word] for word in plain}

    def scores(self, texts: list[str | None]) -> np.ndarray:
        return self.model.score(self.features(texts))


def fit(positive: dict[str, float], negative: dict[str, float]) -> Model:
    """The plane between words, from examples and their weights, the heaviest first."""
    weight = np.concatenate([np.fromiter(d.values(), float) / max(sum(d.values()), 1e-9) / 2 for d in (positive, negative)])
    positive, negative = list(positive), list(negative)
    if not positive or not negative:
        return Model(np.empty(0, np.uint64), np.empty(0), -1.0, np.zeros(4))
    landmarks: list[str] = []
    for word in positive:  # the most telling ones that differ from each other
        if len(landmarks) >= POSITIVE_LANDMARKS:
            break
        if not landmarks or kernel([word], landmarks).max() < 0.85:
            landmarks.append(word)
    close = kernel(negative, landmarks).max(axis=1)
    near = [negative[i] for i in np.argsort(-close, kind="stable")[:CLOSE_LANDMARKS]]
    landmarks = list(dict.fromkeys(landmarks + near + negative[:FREQUENT_LANDMARKS]))

    values, vectors = np.linalg.eigh(kernel(landmarks, landmarks))
    root = vectors @ np.diag(1 / np.sqrt(np.maximum(values, 1e-6))) @ vectors.T
    mapped = kernel(positive + negative, landmarks) @ root
    sign = np.concatenate([np.ones(len(positive)), -np.ones(len(negative))])
    plane = squared_hinge(np.hstack([mapped, np.ones((len(mapped), 1))]), sign, weight)

    found = subsequences(landmarks)
    alpha = root @ plane[:-1]
    keys, at = np.unique(found.key, return_inverse=True)
    weights = np.bincount(at, alpha[found.owner] * found.weight / found.norm[found.owner], len(keys))
    return Model(keys, weights, float(plane[-1]), np.zeros(4), landmarks)


def squared_hinge(rows: np.ndarray, sign: np.ndarray, weight: np.ndarray, ridge: float = 3e-6) -> np.ndarray:
    """Weights of a linear support vector machine, by Newton steps on the rows inside the margin."""
    plane = np.zeros(rows.shape[1])
    penalty = ridge * np.eye(rows.shape[1])
    penalty[-1, -1] = 1e-8
    for _ in range(50):
        inside = sign * (rows @ plane) < 1
        active = rows[inside] * weight[inside, None]
        after = np.linalg.solve(active.T @ rows[inside] + penalty, active.T @ sign[inside])
        if np.abs(after - plane).max() < 1e-9:
            break
        plane = (plane + after) / 2 if _ > 25 else after
    return plane


def logistic(rows: np.ndarray, labels: np.ndarray, ridge: float = 1e-3) -> np.ndarray:
    """Weights and bias of a logistic curve, by Newton steps."""
    rows = np.hstack([rows, np.ones((len(rows), 1))])
    curve = np.zeros(rows.shape[1])
    for _ in range(40):
        p = 1 / (1 + np.exp(-np.clip(rows @ curve, -30, 30)))
        slope = rows.T @ (p - labels) / len(rows) + ridge * curve
        bend = (rows * (p * (1 - p))[:, None]).T @ rows / len(rows) + ridge * np.eye(len(curve))
        step = np.linalg.solve(bend, slope)
        curve -= step
        if np.abs(step).max() < 1e-9:
            break
    return curve


# ---------------------------------------------------------------- on Spark


def held_out() -> Column:
    """Rows whose labels training never sees; without doc_id there is no label to see."""
    return F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 0, F.lit(False))


def train(docs: DataFrame, labels: DataFrame, most_docs: int = TRAIN_DOCS) -> Model:
    """Fit on at most ``most_docs`` labelled documents of either label, those with the smallest
    hash of their id. Held-out rows are left out; a document with several labels is toxic if one
    of them says so; labels other than 0 and 1 do not count."""
    ship_package(docs.sparkSession)
    marked = labels.where(~held_out() & F.col("toxic").isin(0, 1)).groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    chosen = None
    for value in (0, 1):
        some = marked.where(F.col("toxic") == value).orderBy(F.xxhash64("doc_id"), "doc_id").limit(most_docs)
        chosen = some if chosen is None else chosen.union(some)
    # at most two times most_docs rows of two numbers
    chosen = chosen.select(F.col("doc_id").alias("_id"), F.col("toxic").cast("int").alias("toxic"))
    texts = docs.select("doc_id", F.col("text").cast("string").alias("text")).join(
        F.broadcast(chosen), F.col("doc_id") == F.col("_id")
    )
    texts = texts.where("text is not null").select("doc_id", "text", "toxic").persist()
    try:
        return _trained(texts)
    finally:
        texts.unpersist()


def _origins(texts: pa.Array) -> np.ndarray:
    """The smallest number of a five-word run of each text, the same for most near copies."""
    words = words_of(texts, lower=True)
    runs, whole = words.sequences(5), words.whole()
    ends = zip(words.first[:-1], words.first[1:])
    return as_long(np.array([runs[a : b - 4].min() if b - a >= 5 else whole[i] for i, (a, b) in enumerate(ends)], np.uint64))


def _trained(texts: DataFrame) -> Model:
    def distinct_words(batches):
        for batch in batches:
            for part in slices(batch, "text", 4 << 20):
                words = [sorted({stripped(w) for w in words_in(text)} - {""}) for text in part.column(1).to_pylist()]
                sizes = [len(some) for some in words]
                toxic, origin = np.repeat(part.column(2).to_numpy(), sizes), np.repeat(_origins(part.column(1)), sizes)
                flat = [word for some in words for word in some]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(flat, pa.string()), pa.array(toxic, pa.int32()), pa.array(origin)], names=["word", "toxic", "origin"]
                )

    sizes = {row.toxic: row.n for row in texts.groupBy("toxic").agg(F.count(F.lit(1)).alias("n")).collect()}
    n_toxic, n_clean = sizes.get(1, 0), sizes.get(0, 0)
    # copies of one document say the same thing once
    counts = texts.mapInArrow(distinct_words, "word STRING, toxic INT, origin LONG").distinct().groupBy("word").agg(
        F.count_if(F.col("toxic") == 1).alias("t"), F.count_if(F.col("toxic") == 0).alias("c")
    )
    likely = ((F.col("t") + 0.5) / (n_toxic + 1)) / ((F.col("c") + 0.5) / (n_clean + 1))
    rated = counts.withColumn("likely", likely)
    weight = F.col("t") * F.log("likely")
    positive = rated.where((F.col("t") >= LEAST_DOCS) & (F.col("likely") >= LIKELY)).orderBy(F.desc(weight), "word")
    negative = rated.where((F.col("c") >= 3) & (F.col("likely") < LIKELY / 3)).orderBy(F.desc("c"), "word")
    examples = [some.limit(TRAIN_WORDS).collect() for some in (positive, negative)]
    model = fit(
        {row.word: row.t * np.log(row.likely) for row in examples[0]}, {row.word: np.sqrt(row.c) for row in examples[1]}
    )

    def features(batches):
        judge = Judge(model)
        for batch in batches:
            for part in slices(batch, "text", 4 << 20):
                rows = judge.features(part.column(1).to_pylist())
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), part.column(2), *(pa.array(column) for column in rows.T)],
                    names=["doc_id", "toxic", "a", "b", "c"],
                )

    rows = texts.mapInArrow(features, "doc_id LONG, toxic INT, a DOUBLE, b DOUBLE, c DOUBLE").toPandas()
    rows = rows.sort_values(["doc_id", "a", "b", "c"])
    if rows["toxic"].nunique() == 2:
        model.curve = logistic(rows[["a", "b", "c"]].to_numpy(), rows["toxic"].to_numpy(float))
    else:
        share = (n_toxic + 0.5) / (n_toxic + n_clean + 1)
        model.curve = np.array([0, 0, 0, np.log(share / (1 - share))])
    return model


def scorer(model: Model):
    """A column function from text to its score from 0 to 1; null and empty texts have one too."""

    @F.pandas_udf(DoubleType())
    def score(texts: pd.Series) -> pd.Series:
        judge = _judge(model)
        texts = texts.tolist()
        scores, start, held = [], 0, 0
        for i, text in enumerate(texts):
            held += len(text or "")
            if held > 2 << 20 or i + 1 == len(texts):
                scores.append(judge.scores(texts[start : i + 1]))
                start, held = i + 1, 0
        return pd.Series(np.concatenate(scores) if scores else np.empty(0))

    return score


def _judge(model: Model) -> Judge:
    """One per worker process and model, so that words stay known from task to task."""
    judges = worker_cache("toxicity")
    key = model.weights.tobytes() + model.curve.tobytes()
    if key not in judges:
        judges.clear()
        judges[key] = Judge(model)
    return judges[key]


def scored(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, held_out, score, predicted for every row of ``docs``.

    Only text enters a score. Null and empty texts get the score of a text without words. Rows
    that repeat a doc_id are scored by their own text; other columns do not matter.
    """
    score = scorer(train(docs, labels))
    found = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), held_out().alias("held_out"), score(F.col("text").cast("string")).alias("score")
    )
    return found.withColumn("predicted", F.when(F.col("score") >= 0.5, 1).otherwise(0))
