"""Quality classifier: random-indexing word vectors, pooled per document, under a two-layer network.

Terms are the words that most documents hold and, for every word, its shape (letter case and trailing characters), plus
one term for words that repeat the word before. Each term has a sparse random index vector; its word vector adds the index
vectors of the terms around it to its own. Document counts and contexts are those of the whole corpus, whole texts. A
document is the mean of its terms' vectors, weighed by rarity. A network with one hidden layer, trained in numpy on a
bounded sample of labelled documents, scores it; its temperature is fitted on rows held back.
"""

from __future__ import annotations

import math
import operator
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field
from itertools import islice

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from talkloom.llm.common import cut, type_of, utf8

#: Production parameters. The network is fitted on at most SAMPLE labelled documents, those of smallest id hash. TERMS is
#: the size of the vocabulary: so many words and so many shapes, those in most documents; a word beyond it has its shape.
SAMPLE = 8_000
TERMS = 4_000
LEAST_DOCS = 5
DIMS = 96
NONZERO = 6
REACH = 2
HIDDEN = 32
EPOCHS = 40
THRESHOLD = 0.3
#: Words whose terms a worker keeps before it starts over; pairs of words that it adds up at once, by two; context
#: sums of partitions that are added up in one task.
CACHE = 200_000
STEP = 1 << 17
SUMMED = 4

REPEAT = b"\x00repeat"
_KEEP = bytes.maketrans(b"0123456789", b"9999999999")


def shape(word: bytes) -> bytes:
    """Letter case, whether there are digits, and up to three trailing characters that are no letters or digits."""
    bare = word.rstrip(b"!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~")
    tail = word[len(bare) :][-3:]
    case = b"U" if len(bare) > 1 and bare.isupper() else b"T" if bare[:1].isupper() else b"l" if bare else b"-"
    digits = b"9" if b"9" in bare.translate(_KEEP) else b""
    return b"\x00" + case + digits + tail


def index_vector(term: bytes) -> np.ndarray:
    rng = np.random.default_rng(xxhash.xxh64_intdigest(term))
    out = np.zeros(DIMS, np.float32)
    out[rng.choice(DIMS, NONZERO, replace=False)] = rng.choice([-1, 1], NONZERO)
    return out


@dataclass
class Vectors:
    """Word vectors by term; words that are no term are seen by their shape alone."""

    place: dict[bytes, int]
    matrix: np.ndarray
    cache: dict[bytes, int] = field(default_factory=dict)

    def __getstate__(self):
        return {"place": self.place, "matrix": self.matrix, "cache": {}}

    def code(self, word: bytes) -> int:
        """The places of the word and of its shape in one number; a missing place is that after the last."""
        none = len(self.matrix)
        found = self.place.get(word, none) * (none + 1) + self.place.get(shape(word), none)
        if len(self.cache) >= CACHE:
            self.cache.clear()
        self.cache[word] = found
        return found

    def pool(self, text: bytes | None) -> np.ndarray:
        """The mean vector of a text's terms; zero for null and empty texts and those of unknown terms."""
        words = text.split() if text else []
        if not words:
            return np.zeros(DIMS, np.float32)
        get, code = self.cache.get, self.code
        codes = np.fromiter((x if (x := get(w)) is not None else code(w) for w in words), np.int64, len(words))
        none = len(self.matrix)
        counts = np.bincount(codes // (none + 1), minlength=none + 1) + np.bincount(codes % (none + 1), minlength=none + 1)
        if REPEAT in self.place:
            counts[self.place[REPEAT]] += sum(map(operator.eq, words, islice(words, 1, None)))
        held = np.flatnonzero(counts[:none])
        return counts[held].astype(np.float32) @ self.matrix[held] / len(words) if len(held) else np.zeros(DIMS, np.float32)


@dataclass
class Model:
    vectors: Vectors
    mean: np.ndarray
    scale: np.ndarray
    layers: list[np.ndarray]
    temperature: float
    prior: float

    def score(self, pooled: np.ndarray) -> np.ndarray:
        if not self.layers:
            return np.full(len(pooled), self.prior)
        return 1 / (1 + np.exp(-np.clip(logits((pooled - self.mean) / self.scale, self.layers)[0] / self.temperature, -30, 30)))


def logits(x: np.ndarray, layers: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    w1, b1, w2, b2 = layers
    hidden = np.tanh(x @ w1 + b1)
    return hidden @ w2 + b2[0], hidden


def train(x: np.ndarray, y: np.ndarray, seed: int = 7) -> list[np.ndarray]:
    """Adam on the mean log loss of mini-batches."""
    rng = np.random.default_rng(seed)
    layers = [rng.normal(0, 1 / np.sqrt(x.shape[1]), (x.shape[1], HIDDEN)), np.zeros(HIDDEN), rng.normal(0, 1 / np.sqrt(HIDDEN), HIDDEN), np.zeros(1)]
    first, second, step = [np.zeros_like(w) for w in layers], [np.zeros_like(w) for w in layers], 0
    for _ in range(EPOCHS):
        order = rng.permutation(len(x))
        for at in range(0, len(x), 128):
            rows = order[at : at + 128]
            out, hidden = logits(x[rows], layers)
            off = (1 / (1 + np.exp(-np.clip(out, -30, 30))) - y[rows]) / len(rows)
            back = off[:, None] * layers[2] * (1 - hidden**2)
            slopes = [x[rows].T @ back + 1e-4 * layers[0], back.sum(axis=0), hidden.T @ off + 1e-4 * layers[2], np.array([off.sum()])]
            step += 1
            for w, g, m, v in zip(layers, slopes, first, second):
                m += 0.1 * (g - m)
                v += 0.001 * (g * g - v)
                w -= 0.003 * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.999**step)) + 1e-8)
    return layers


def fit_temperature(out: np.ndarray, y: np.ndarray) -> float:
    """The temperature of least log loss on rows that the network has not seen."""
    loss = lambda t: np.mean(np.logaddexp(0, out / t) - y * out / t)
    return float(min(np.geomspace(0.25, 8, 61), key=loss)) if len(out) else 1.0


def document_counts(docs: DataFrame, text_col: str) -> tuple[dict[bytes, int], int]:
    """How often documents hold the TERMS most widely held words and shapes, and the number of documents.

    A word counts once for each document that holds it, a shape once for each of a document's different words of it.
    """

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words, n = Counter(), 0

        def told() -> pa.RecordBatch:
            shapes = Counter()
            for word, held_by in words.items():
                shapes[shape(word)] += held_by
            kinds = [False] * len(words) + [True] * len(shapes)
            terms, counts = [*words, *shapes, None], [*words.values(), *shapes.values(), n]
            words.clear()
            return pa.RecordBatch.from_arrays(
                [pa.array(terms, pa.binary()), pa.array([*kinds, None], pa.bool_()), pa.array(counts, pa.int64())],
                names=["term", "is_shape", "n"],
            )

        for batch in batches:
            for text in utf8(batch.column(0)):
                words.update(set(text.split()) if text else ())
                n += 1
                if len(words) > CACHE:
                    yield told()
                    n = 0
        yield told()

    counted = docs.select(text_col).mapInArrow(count, "term binary, is_shape boolean, n long").groupBy("term", "is_shape").agg(F.sum("n").alias("n"))
    counted = cut(counted.where(F.col("term").isNull() | (F.col("n") >= LEAST_DOCS)), "document_counts")
    n = counted.where("term is null").agg(F.sum("n")).first()[0] or 0
    df = {}
    for kind in (False, True):
        df |= {bytes(r["term"]): r["n"] for r in counted.where(F.col("is_shape") == kind).orderBy(F.desc("n"), "term").limit(TERMS).collect()}
    return df, n


def add_contexts(ids: np.ndarray, spots: np.ndarray, signs: np.ndarray, around: np.ndarray) -> None:
    """Add to each term's row of around the index vectors of the terms at up to REACH places from it. -1 parts texts."""
    n = around.shape[0]
    for d in range(1, REACH + 1):
        left, right = ids[:-d], ids[d:]
        ok = (left >= 0) & (right >= 0)
        if d > 1:
            ok &= np.logical_and.reduce([ids[k : len(ids) - d + k] >= 0 for k in range(1, d)])
        left, right = left[ok], right[ok]
        for start in range(0, len(left), 2 * STEP):
            a, b = left[start : start + 2 * STEP], right[start : start + 2 * STEP]
            for to, of in ((a, b), (b, a)):
                flat = (to[:, None] * DIMS + spots[of]).ravel()
                around += np.bincount(flat, signs[of].ravel(), n * DIMS).reshape(n, DIMS)


def contexts(docs: DataFrame, text_col: str, place: dict[bytes, int], index: np.ndarray) -> np.ndarray:
    """For each term the sum of the index vectors around it in all documents; sums of partitions are added up in rounds."""
    spots = np.argsort(index == 0, axis=1, kind="stable")[:, :NONZERO]
    signs = np.take_along_axis(index, spots, axis=1).astype(np.float64)
    shared = docs.sparkSession.sparkContext.broadcast((Vectors(place, index), spots, signs))

    def gather(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vectors, spots, signs = shared.value
        around, held, n, known = np.zeros((len(spots), DIMS)), [], 0, {}
        get = known.get

        def first(word: bytes) -> int:
            if len(known) >= CACHE:
                known.clear()
            known[word] = at = vectors.place.get(word, vectors.place.get(shape(word), -2))
            return at

        for batch in batches:
            for text in utf8(batch.column(0)):
                ids = np.array([x if (x := get(w)) is not None else first(w) for w in text.split()] if text else [], np.int32)
                ids = ids[ids != -2]
                held += [ids, np.array([-1], np.int32)]
                n += len(ids)
                if n >= STEP:
                    add_contexts(np.concatenate(held), spots, signs, around)
                    held, n = [], 0
        if held:
            add_contexts(np.concatenate(held), spots, signs, around)
        yield pa.RecordBatch.from_arrays([pa.array([around.tobytes()], pa.binary())], names=["around"])

    def summed(t: pa.Table) -> pa.Table:
        total = sum(np.frombuffer(x.as_py()) for x in t.column("around"))
        return pa.table([pa.array([total.tobytes()], pa.binary())], names=["around"])

    parts = cut(docs.select(text_col).mapInArrow(gather, "around binary"), "contexts")
    while (n := parts.count()) > SUMMED:
        dealt = parts.withColumn("part", F.pmod(F.monotonically_increasing_id() + F.spark_partition_id(), F.lit(math.ceil(n / SUMMED))))
        parts = cut(dealt.groupBy("part").applyInArrow(lambda t: summed(t.select(["around"])), "around binary"), "contexts")
    out = np.zeros(index.shape)
    for row in parts.collect():  # at most SUMMED rows of one matrix
        out += np.frombuffer(row["around"]).reshape(index.shape)
    return out


def fit(docs: DataFrame, labels: DataFrame, learn, sample: int = SAMPLE, id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality") -> Model:
    """Learn word vectors from all texts, and the network from labelled documents where ``learn`` (a condition on the id) holds.

    Repeated labels are averaged; null ones and null ids are left out; rows repeated under one id are learned from as often
    as they come. Null and empty texts have no terms. Without any label, or with one label only, there is no network.
    """
    known = labels.where(F.col(id_col).isNotNull() & F.col(label_col).isNotNull() & learn).groupBy(id_col).agg(F.avg(label_col).alias("y"))
    chosen = cut(
        known.select(F.col(id_col).alias("__id"), (F.col("y") >= 0.5).alias("y"), F.xxhash64(id_col).alias("h")).orderBy("h", "__id").limit(sample),
        "labelled",
    )
    # At most ``sample`` rows of three numbers: small enough to broadcast at any size of the corpus.
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")).join(F.broadcast(chosen), F.col("id") == F.col("__id"))
    rows = cut(rows.select("text", "y", "h").repartition(8, "h"), "learning_texts")
    df, n = document_counts(docs, text_col)
    df[REPEAT] = 1
    terms = sorted(df)
    place = {t: i for i, t in enumerate(terms)}
    index = np.stack([index_vector(t) for t in terms])
    around = contexts(docs, text_col, place, index)
    around /= np.maximum(1e-6, np.linalg.norm(around, axis=1, keepdims=True))
    rarity = np.array([1 + np.log(max(1, n) / min(max(1, n), max(1, df[t]))) for t in terms], np.float32)
    vectors = Vectors(place, ((index / np.sqrt(NONZERO) + 0.3 * around) * rarity[:, None]).astype(np.float32))
    final = docs.sparkSession.sparkContext.broadcast(vectors)

    def pooled(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            raw = [final.value.pool(t).tobytes() for t in utf8(batch.column(0))]
            yield pa.RecordBatch.from_arrays([pa.array(raw, pa.binary()), batch.column(1), batch.column(2)], names=["x", "y", "h"])

    got = sorted((r["h"], bytes(r["x"]), r["y"]) for r in rows.mapInArrow(pooled, "x binary, y boolean, h long").collect())
    if not got:
        return Model(vectors, np.zeros(DIMS), np.ones(DIMS), [], 1.0, 0.5)
    x, y = np.stack([np.frombuffer(g[1], np.float32) for g in got]).astype(np.float64), np.array([g[2] for g in got], float)
    if y.min() == y.max():
        return Model(vectors, np.zeros(DIMS), np.ones(DIMS), [], 1.0, float((y.sum() + 1) / (len(y) + 2)))
    mean, scale = x.mean(axis=0), x.std(axis=0) + 1e-6
    held = np.arange(len(x)) % 10 == 0
    layers = train((x[~held] - mean) / scale, y[~held])
    return Model(vectors, mean, scale, layers, fit_temperature(logits((x[held] - mean) / scale, layers)[0], y[held]), 0.5)


def score(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """id, score in 0..1 (the chance of label 1) for each row of docs.

    Null and empty texts have the vector zero and the network's score for it. A model that learned from no row scores 0.5,
    one that saw a single label scores its smoothed share. Repeated rows and null ids are rows like any other; an empty
    table gives an empty result. Columns not named are ignored.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                pooled = np.stack([shared.value.vectors.pool(t) for t in utf8(batch.column(1))])
                yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(shared.value.score(pooled))], names=[id_col, "score"])

    return docs.select(id_col, text_col).mapInArrow(each, f"`{id_col}` {type_of(docs, id_col)}, score double")
