"""Quality scores: random-indexing word vectors pooled per document, then a two-layer numpy network with calibrated probabilities.

Random indexing: every word, and every run of other signs, has a sparse ternary index vector that its hash gives. A word's vector gathers the
index vectors of the words around it, each rotated by its place (one or two before or after), so that order counts; where the word around it is the
word itself, that is a context of its own, so that repetition counts whatever the word. What the training texts gathered for their ``max_words`` most
frequent words (of ``min_count`` places at least), a row for each, is scaled to unit length for frequent ones; what a word gathers in the text at hand is added, as the
method learns while it reads: words that training never saw have a vector too. A document is the mean of its words' vectors, and these ``DIM`` numbers are
all the network sees. Its logits are divided by a temperature fitted on rows kept aside, so that scores are probabilities.

Vectors and network are fitted on at most ``max_rows`` labelled rows (those of least hash), outside the held-out fold; scoring reads
every text whole. Null and empty texts pool to the zero vector and are scored. Repeated rows are scored each, and count each where they are labelled;
of a repeated label the least counts, null and other labels than 0 and 1 don't. Columns of ``docs`` besides key and text aren't read. Without labels of both kinds, or texts for them,
there is nothing to learn: the model then is ``untaught`` and every score is the share of ones among the labelled rows, with one row of
either kind added (0.5 where there are none). An empty table gives an empty result.
"""

from __future__ import annotations

import re
from collections import Counter, defaultdict
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import chain, count, islice

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import common
from .quality_rules import labelled_sample

DIM = 64
#: An index vector's places: the first half count +1, the others -1.
PLACES = 8
SIGNS = np.repeat([1, -1], PLACES // 2)
#: The places around a word that are its contexts, and how far each rotates index vectors.
CONTEXTS = {1: 11, -1: 23, 2: 37, -2: 51}
#: Distinct words that a worker remembers.
MEMO = 200_000
#: Places from which on a word's gathered contexts count in full, about.
FREQUENT = 10
#: Steps of training at least: with few rows an epoch is a step or two, and so more of them are taken.
LEAST_STEPS = 400

#: Words are what lies between white space, cut where letters and digits meet other signs. All of UTF-8 beyond ASCII counts as letters.
_PART = re.compile(rb"[0-9A-Za-z\x80-\xff]+|[^0-9A-Za-z\x80-\xff]+")


def index_places(word: bytes) -> list[int]:
    """Where a word's index vector isn't zero; places that coincide add up. The empty word's vector stands for a word met again."""
    h = xxhash.xxh64_intdigest(word, 5)
    return [h >> 6 * i & DIM - 1 for i in range(PLACES)]


AGAIN = np.array(index_places(b""))


class Words:
    """Texts to words' numbers; each distinct word's row in the model and index vector is worked out once."""

    def __init__(self, vocabulary: list[bytes]):
        self.rows_of = {w: i for i, w in enumerate(vocabulary)}
        self.clear()

    def clear(self) -> None:
        self.numbers: defaultdict[bytes, int] = defaultdict(count().__next__)  # of what lies between white space
        self.begins, self.flat = np.zeros(1, np.int64), np.zeros(0, np.int64)  # its words
        self.words: defaultdict[bytes, int] = defaultdict(count().__next__)
        self.rows, self.places = np.zeros(0, np.int32), np.zeros((0, PLACES), np.uint8)

    @common.without_gc
    def of(self, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
        """The numbers of all words, and how many are each text's."""
        if len(self.numbers) > MEMO:
            self.clear()
        lists = [common.words_of(t) for t in texts]
        found = np.fromiter(map(self.numbers.__getitem__, chain.from_iterable(lists)), np.int64, sum(map(len, lists)))
        new = list(islice(reversed(self.numbers), len(self.numbers) + 1 - len(self.begins)))[::-1]
        parts = [_PART.findall(w) for w in new]
        self.begins = np.concatenate([self.begins, self.begins[-1] + np.cumsum(np.fromiter(map(len, parts), np.int64, len(parts)))])
        self.flat = np.concatenate([self.flat, np.fromiter(map(self.words.__getitem__, chain.from_iterable(parts)), np.int64, sum(map(len, parts)))])
        fresh = list(islice(reversed(self.words), len(self.words) - len(self.rows)))[::-1]
        self.rows = np.concatenate([self.rows, np.fromiter((self.rows_of.get(w, -1) for w in fresh), np.int32, len(fresh))])
        self.places = np.concatenate([self.places, np.array([index_places(w) for w in fresh], np.uint8).reshape(-1, PLACES)])
        sizes = self.begins[found + 1] - self.begins[found]
        ends = np.cumsum(sizes)
        words = self.flat[np.arange(ends[-1] if len(ends) else 0) + np.repeat(self.begins[found] - ends + sizes, sizes)]
        ends = np.concatenate([[0], ends])
        return words, np.diff(ends[np.concatenate([[0], np.cumsum([len(x) for x in lists])]).astype(np.int64)])


def _words(vocabulary: list[bytes], stamp: int) -> Words:
    """Of the model at hand; a worker holds one model's words, and lets go of those of the model before."""
    found = common.held(("quality", "words"), dict)
    if stamp not in found:
        found.clear()
        found[stamp] = Words(vocabulary)
    return found[stamp]


def stamp_of(vocabulary: list[bytes]) -> int:
    return xxhash.xxh64_intdigest(b" ".join(vocabulary))


def contexts(words: np.ndarray, sizes: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray, int]]:
    """For each context: places of words, places of the words there, and the rotation."""
    owner = np.repeat(np.arange(len(sizes)), sizes)
    for d, turn in CONTEXTS.items():
        at = np.arange(max(-d, 0), len(words) - max(d, 0))
        at = at[owner[at] == owner[at + d]]
        yield at, at + d, turn


def gather(texts: list[str | None], known: Words, sums: np.ndarray) -> None:
    """Add what the model's words gather in the texts to their rows; whole numbers, so that the order doesn't matter."""
    words, sizes = known.of(texts)
    for at, near, turn in contexts(words, sizes):
        rows = known.rows[words[at]].astype(np.int64)
        at, near, rows = at[rows >= 0], near[rows >= 0], rows[rows >= 0]
        places = (known.places[words[near]].astype(np.int64) + turn) & DIM - 1
        places[words[at] == words[near]] = AGAIN
        np.add.at(sums.reshape(-1), (rows[:, None] * DIM + places).reshape(-1), np.tile(SIGNS, len(rows)).astype(sums.dtype))


def _summed(places: np.ndarray, owner: np.ndarray, n: int) -> np.ndarray:
    """Index vectors added up by owner."""
    return np.bincount((owner[:, None] * DIM + places).reshape(-1), weights=np.tile(SIGNS.astype(float), len(owner)), minlength=n * DIM).reshape(n, DIM)


def pooled(texts: list[str | None], known: Words, vectors: np.ndarray) -> np.ndarray:
    """A row of DIM numbers for each text: the mean of its words' vectors."""
    out = np.zeros((len(texts), DIM), np.float32)
    lo = 0
    while lo < len(texts):
        hi, chars = lo, 0
        while hi < len(texts) and (hi == lo or chars < 200_000):
            chars += len(texts[hi] or "")
            hi += 1
        words, sizes = known.of(texts[lo:hi])
        n = len(sizes)
        full = np.flatnonzero(sizes)
        if len(full):
            begins = np.concatenate([[0], np.cumsum(sizes)[:-1]])
            owner = np.repeat(np.arange(n), sizes)
            places = known.places[words]
            whole = _summed(places, owner, n)
            own = np.zeros((n, DIM))
            # each word is its neighbour's context: all of a text's index vectors, less those over its edge and those met again
            for d, turn in CONTEXTS.items():
                rank = np.arange(len(words)) - begins[owner]
                over = rank < d if d > 0 else rank >= sizes[owner] + d
                over = np.flatnonzero(over)
                inside = np.arange(max(-d, 0), len(words) - max(d, 0))
                again = inside[(words[inside] == words[inside + d]) & (owner[inside] == owner[inside + d])]
                left_out = np.concatenate([over, again + d])
                own += np.roll(whole - _summed(places[left_out], owner[left_out], n), turn, 1)
                own += np.bincount(owner[again], minlength=n)[:, None] * np.bincount(AGAIN, weights=SIGNS, minlength=DIM)
            rows = known.rows[words]
            trained = np.add.reduceat(vectors[rows] * (rows >= 0)[:, None], begins[full], 0) if len(vectors) else 0
            out[lo + full] = (trained + own[full] / len(CONTEXTS)) / sizes[full, None]
        lo = hi
    return out


@dataclass
class QualityModel:
    vocabulary: list[bytes]
    vectors: np.ndarray  # a row of DIM numbers for each
    mean: np.ndarray
    scale: np.ndarray
    w1: np.ndarray
    b1: np.ndarray
    w2: np.ndarray
    b2: float
    temperature: float = 1.0
    untaught: bool = False

    def pooled(self, texts: list[str | None]) -> np.ndarray:
        return pooled(texts, _words(self.vocabulary, stamp_of(self.vocabulary)), self.vectors)

    def logits(self, x: np.ndarray) -> np.ndarray:
        return np.tanh((x - self.mean) / self.scale @ self.w1 + self.b1) @ self.w2 + self.b2

    def scores(self, x: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.logits(x).astype(float) / self.temperature, -50, 50)))


def train(x: np.ndarray, y: np.ndarray, aside: np.ndarray, vocabulary: list[bytes], vectors: np.ndarray, *, hidden: int = 32, epochs: int = 40, rate: float = 3e-3, decay: float = 1e-3, seed: int = 1) -> QualityModel:
    """Adam on the cross entropy of the rows not aside; then the temperature that suits the rows aside best."""
    if len(set(y.tolist())) < 2:
        share = (y.sum() + 1) / (len(y) + 2)
        zero = np.zeros(DIM, np.float32)
        return QualityModel(vocabulary, vectors, zero, zero + 1, np.zeros((DIM, 1), np.float32), np.zeros(1, np.float32), np.zeros(1, np.float32), float(np.log(share / (1 - share))), untaught=True)
    rng = np.random.default_rng(seed)
    fit = ~aside if 0 < aside.sum() < len(y) and len(set(y[~aside].tolist())) == 2 else np.ones(len(y), bool)
    mean, scale = x[fit].mean(0), x[fit].std(0) + 1e-3
    z, t = ((x[fit] - mean) / scale).astype(np.float32), y[fit].astype(np.float32)
    p = [rng.normal(0, x.shape[1] ** -0.5, (x.shape[1], hidden)).astype(np.float32), np.zeros(hidden, np.float32), rng.normal(0, hidden**-0.5, hidden).astype(np.float32), np.zeros(1, np.float32)]
    m, v, step = [np.zeros_like(a) for a in p], [np.zeros_like(a) for a in p], 0
    epochs = max(epochs, -(-LEAST_STEPS // -(-len(z) // 256)))
    for epoch in range(epochs):
        order = rng.permutation(len(z))
        for i in range(0, len(z), 256):
            a, b = z[order[i : i + 256]], t[order[i : i + 256]]
            h = np.tanh(a @ p[0] + p[1])
            d = (1 / (1 + np.exp(-np.clip(h @ p[2] + p[3], -50, 50))) - b) / len(b)
            dh = np.outer(d, p[2]) * (1 - h * h)
            grads = [a.T @ dh + decay * p[0], dh.sum(0), h.T @ d + decay * p[2], np.array([d.sum()], np.float32)]
            step += 1
            lr = rate * (1 - epoch / epochs)
            for k, g in enumerate(grads):
                m[k] = 0.9 * m[k] + 0.1 * g
                v[k] = 0.999 * v[k] + 0.001 * g * g
                p[k] = (p[k] - lr * (m[k] / (1 - 0.9**step)) / (np.sqrt(v[k] / (1 - 0.999**step)) + 1e-8)).astype(np.float32)
    model = QualityModel(vocabulary, vectors, mean.astype(np.float32), scale.astype(np.float32), p[0], p[1], p[2], float(p[3][0]))
    if aside.sum() >= 20:
        logit, truth = model.logits(x[aside]).astype(float), y[aside]

        def loss(temperature: float) -> float:
            s = np.clip(logit / temperature, -50, 50)
            return float(np.mean(np.logaddexp(0, s) - truth * s))

        model.temperature = float(min(np.geomspace(0.25, 8, 61), key=loss))
    return model


def fit(docs: DataFrame, labels: DataFrame, *, key: str = "doc_id", text: str = "text", label: str = "quality", max_rows: int = 20_000, max_words: int = 65_536, min_count: int = 3, held_out: int = 2, folds: int = 4) -> QualityModel:
    """Fit on labelled rows whose crc32(key as text) mod ``folds`` is not ``held_out``. The model has at most ``max_words`` rows, whatever the input."""
    spark = docs.sparkSession
    common.ship(spark)
    inside = F.crc32(F.col(key).cast("string").cast("binary")) % folds != held_out
    rows = labelled_sample(docs.select(key, text), labels, key=key, text=text, label=label, max_rows=max_rows, fold=inside)
    rows = common.materialize(rows.select(key, text, "__label", "__order").repartition(8, "__order"), "labelled")

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: Counter[bytes] = Counter()
        for b in common.slices(batches, 128):
            for w, n in Counter(chain.from_iterable(map(common.words_of, b[text].to_pylist()))).items():
                for part in _PART.findall(w):
                    found[part] += n
        yield pa.RecordBatch.from_pydict({"word": pa.array(found.keys(), pa.binary()), "n": pa.array(found.values(), pa.int64())})

    counts = rows.select(text).mapInArrow(counted, "word binary, n long").groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= min_count)
    vocabulary = [bytes(r["word"]) for r in counts.orderBy(F.col("n").desc(), "word").limit(max_words).collect()]
    shape, stamp = (len(vocabulary), DIM), stamp_of(vocabulary)
    shared_words = spark.sparkContext.broadcast(vocabulary)

    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(shape, np.int32)
        for b in common.slices(batches, 128):
            gather(b[text].to_pylist(), _words(shared_words.value, stamp), total)
        yield pa.RecordBatch.from_pydict({"sums": pa.array([total.tobytes()], pa.binary())})

    def unit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(shape[0] * DIM, np.int64)
        for b in batches:
            for s in b["sums"]:
                total += np.frombuffer(s.as_buffer(), np.int32)
        total = total.reshape(shape)
        norm = np.sqrt((total.astype(float) ** 2).sum(1, keepdims=True))
        yield pa.RecordBatch.from_pydict({"vectors": pa.array([(total / (norm + FREQUENT)).astype(np.float32).tobytes()], pa.binary())})

    # eight rows of 16 MB at most meet in one task, whatever the input; the driver gets one
    added = rows.select(text).coalesce(8).mapInArrow(sums, "sums binary").repartition(1).mapInArrow(unit, "vectors binary").collect()
    vectors = np.frombuffer(added[0]["vectors"], np.float32).reshape(shape)
    shared = spark.sparkContext.broadcast(vectors)

    def pool(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in common.slices(batches, 512):
            x = pooled(b[text].to_pylist(), _words(shared_words.value, stamp), shared.value)
            yield pa.RecordBatch.from_arrays([b["__label"].cast(pa.int32()), b["__order"], pa.array([r.tobytes() for r in x], pa.binary())], ["label", "order", "x"])

    got = rows.mapInArrow(pool, "label int, order long, x binary").toPandas().sort_values(["order", "x"])
    x = np.frombuffer(b"".join(got["x"]), np.float32).reshape(-1, DIM)
    order = got["order"].to_numpy()
    return train(x, got["label"].to_numpy(), (order & 0xFFFF) % 7 == 0, vocabulary, vectors)


def with_score(docs: DataFrame, model: QualityModel, *, text: str = "text", out: str = "score") -> DataFrame:
    """``docs`` with the probability of label 1; a column of that name is replaced. One pass, no shuffle."""
    common.ship(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(model)

    @F.pandas_udf("double")
    def score(texts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        model = shared.value
        for s in texts:
            values = s.tolist()
            parts = [model.scores(model.pooled(values[i : i + 1024])) for i in range(0, len(values), 1024)]
            yield pd.Series(np.concatenate(parts) if parts else np.zeros(0))

    return docs.withColumn(out, score(F.col(text)))


def held_out(key: str = "doc_id", held: int = 2, folds: int = 4):
    """Whether a row is of the held-out fold; a null id counts as the text ``null``."""
    return F.crc32(F.coalesce(F.col(key).cast("string"), F.lit("null")).cast("binary")) % folds == held
