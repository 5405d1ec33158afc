"""Operator 7: quality by nearest-neighbour voting among labelled latent-semantic vectors."""

from __future__ import annotations

import io
import zlib
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import read, slices

#: Labelled rows that the classifier is fitted on, at most: half of each label as far as there are so many.
SAMPLE = 3000
#: Dimensions of the latent vectors.
DIMS = 48
#: Neighbours that vote.
NEIGHBOURS = 25
#: Power of a neighbour's cosine in its vote.
SHARPNESS = 8.0
#: Documents scored 1 at least this.
CUT = 0.7
#: A row is held out if crc32 of its id as text has this remainder.
FOLDS, HELD_OUT = 4, 2
#: Documents of a block of cosine products.
BLOCK = 256

_KINDS = ("abcdefghijklmnopqrstuvwxyz", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "0123456789", " ", "\n\r", ".", ",", "|", "!?", "*#$%&@^~", "()[]{}<>\"'", "-_/\\+=", ":;")
_KIND = np.full(256, 13, np.int32)
for _i, _s in enumerate(_KINDS):
    _KIND[np.frombuffer(_s.encode(), np.uint8)] = _i
_KIND[0xC0:] = 14
_KIND[0x80:0xC0] = 15
#: Terms: hashed words, trigrams of kinds of bytes, and shares of repeated or shouted words.
WORDS, KINDS, SHARES = 1 << 11, 16**3, 6
WIDTH = WORDS + KINDS + SHARES


def features(text: bytes) -> np.ndarray:
    """Term weights of a whole text: its words, trigrams of kinds of bytes, and how far words repeat or shout."""
    x = np.zeros(WIDTH, np.float32)
    if text:
        k = _KIND[np.frombuffer(b"\n" + text + b"\n", np.uint8)]
        n = len(k) - 2
        x[WORDS : WORDS + KINDS] = np.log1p(np.bincount(k[:-2] * 256 + k[1:-1] * 16 + k[2:], minlength=KINDS) * np.float32(2000 / n))
    w = text.split()
    if w:
        at = np.fromiter(map(xxhash.xxh3_64_intdigest, text.lower().split()), np.uint64, len(w)) % np.uint64(WORDS)
        x[:WORDS] = np.log1p(np.bincount(at.astype(np.int64), minlength=WORDS) * np.float32(500 / len(w)))
    if len(w) > 2:
        n = len(w)
        same, second = sum(map(bytes.__eq__, w, w[1:])), sum(map(bytes.__eq__, w, w[2:]))
        shares = (same / n, second / n, 1 - len(set(w)) / n, sum(map(bytes.isupper, w)) / n, sum(map(len, w)) / n / 100, same > 2)
        x[WORDS + KINDS :] = np.log1p(np.array(shares, np.float32) * 200)
    return x


class Model(NamedTuple):
    axes: np.ndarray  # terms x dimensions, with each term's weight by rarity
    vectors: np.ndarray  # labelled, of length 1
    labels: np.ndarray
    prior: np.ndarray  # vote weight of label 0 and 1
    power: float  # brings the best cut to CUT
    fitted: bool = True  # False: labels were too few, or of one kind

    def latent(self, x: np.ndarray) -> np.ndarray:
        v = x @ self.axes
        return v / np.maximum(np.linalg.norm(v, axis=1, keepdims=True), 1e-9)

    def votes(self, v: np.ndarray, itself: bool = False) -> np.ndarray:
        """Share of label 1 among neighbours; itself: v are the labelled vectors, none of which votes on itself."""
        s = v @ self.vectors.T
        if itself:
            np.fill_diagonal(s, -1)
        k = min(NEIGHBOURS, s.shape[1])
        at = np.argpartition(-s, k - 1, 1)[:, :k]
        w = np.maximum(np.take_along_axis(s, at, 1), 0) ** SHARPNESS + 1e-12
        w = w * self.prior[self.labels[at]]
        return (w * self.labels[at]).sum(1) / w.sum(1)

    def score(self, x: np.ndarray) -> np.ndarray:
        v = self.latent(x)
        return np.where(v.any(1), np.clip(self.votes(v), 0, 1) ** self.power, 0.0)


def fit(x: np.ndarray, y: np.ndarray, dims: int = DIMS) -> Model:
    """x: features, y: labels 0/1 of the sample."""
    if len(y) < 4 or len(set(y.tolist())) < 2:
        axes = np.zeros((WIDTH, 1), np.float32)
        axes[0] = 1e-6
        axes[1:] = 1e-3
        return Model(axes, np.ones((2, 1), np.float32), np.array([0, 1]), np.ones(2), 1.0, False)  # both labels as near: 0.5
    n = len(y)
    seen = sum((x[i : i + BLOCK] > 0).sum(0) for i in range(0, n, BLOCK))
    weight = np.log((1 + n) / (1 + seen)).astype(np.float32) + 0.5
    weight[WORDS + KINDS :] = 3
    _, _, vt = np.linalg.svd(_range(x, weight, dims + 8), full_matrices=False)
    axes = np.ascontiguousarray(vt[:dims].T * weight[:, None], dtype=np.float32)
    prior = n / (2 * np.bincount(y, minlength=2).astype(float))
    m = Model(axes, np.zeros((0, dims), np.float32), y, prior, 1.0)
    m = m._replace(vectors=np.concatenate([m.latent(x[i : i + BLOCK].astype(np.float32)).astype(np.float32) for i in range(0, n, BLOCK)]))
    own = m.votes(m.vectors, itself=True)
    cuts = np.linspace(0.05, 0.95, 91)
    right = [((own >= c) & (y == 1)).sum() / (y == 1).sum() + ((own < c) & (y == 0)).sum() / (y == 0).sum() for c in cuts]
    best = np.nonzero(np.array(right) >= max(right) - 1e-9)[0]
    return m._replace(power=float(np.log(CUT) / np.log(cuts[best[len(best) // 2]])))


def _range(x: np.ndarray, weight: np.ndarray, k: int) -> np.ndarray:
    """k x terms: the weighted x seen along its main left directions (randomised, fixed draw). x may be of half precision; it is weighted block by block."""

    def along(q: np.ndarray) -> np.ndarray:
        out = np.zeros((q.shape[1], x.shape[1]), np.float32)
        for i in range(0, len(x), BLOCK):
            out += q[i : i + BLOCK].T @ (x[i : i + BLOCK] * weight)
        return out

    def onto(z: np.ndarray) -> np.ndarray:
        return np.concatenate([(x[i : i + BLOCK] * weight) @ z for i in range(0, len(x), BLOCK)])

    q = np.linalg.qr(onto(np.random.default_rng(7).standard_normal((x.shape[1], k)).astype(np.float32)))[0]
    for _ in range(3):
        q = np.linalg.qr(onto(along(q).T))[0]
    return along(q)


def fold(doc_id: F.Column) -> F.Column:
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % FOLDS


def train(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> Model:
    """Fits on a bounded draw of labelled rows outside the held-out fold: the smallest hashes of each label. One task of the
    cluster gathers the draw and fits; the driver gets the model alone."""
    known = labels.where("quality in (0, 1) and doc_id is not null").where(fold(F.col("doc_id")) != HELD_OUT)
    known = known.groupBy("doc_id").agg(F.min("quality").cast("int").alias("quality"))
    rows = [r for q in (0, 1) for r in known.where(F.col("quality") == q).orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample // 2).collect()]  # bounded by the parameter
    chosen = F.broadcast(docs.sparkSession.createDataFrame([(r["doc_id"], r["quality"]) for r in rows], "doc_id long, quality int"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches):
            yield pa.record_batch({"doc_id": b["doc_id"], "quality": b["quality"], "x": pa.array([features(x or b"").astype(np.float16).tobytes() for x in b["text"].to_pylist()], pa.binary())})

    def fitted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """At most ``sample`` rows, in one task; only the model leaves it."""
        ids, labels, rows = np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros((0, WIDTH), np.float16)
        for b in batches:
            x = np.frombuffer(b["x"].buffers()[2], np.float16)[b["x"].offset * WIDTH :][: b.num_rows * WIDTH].reshape(-1, WIDTH)
            ids, labels, rows = np.append(ids, b["doc_id"].to_numpy()), np.append(labels, b["quality"].to_numpy()), np.concatenate([rows, x])
        order = np.argsort(ids, kind="stable")
        yield pa.record_batch({"model": pa.array([dumps(fit(rows[order], labels[order]))], pa.binary())})

    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("binary").alias("text")).join(chosen, "doc_id")
    # of texts that share an id one counts
    one = texts.mapInArrow(run, "doc_id long, quality int, x binary").groupBy("doc_id", "quality").agg(F.min("x").alias("x"))
    got = one.repartition(1).mapInArrow(fitted, "model binary").collect()
    return loads(bytes(got[0]["model"])) if got else fit(np.zeros((0, WIDTH), np.float32), np.zeros(0, np.int64))


def dumps(model: Model) -> bytes:
    out = io.BytesIO()
    np.savez(out, **model._asdict())
    return out.getvalue()


def loads(data: bytes) -> Model:
    with np.load(io.BytesIO(data)) as held:
        m = Model(**held)
    return m._replace(power=float(m.power), fitted=bool(m.fitted))


def classify(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE, fitted: Model | None = None) -> DataFrame:
    """docs (doc_id, text, ...), labels (doc_id, quality): docs' columns and q_score (double, 0 to 1), one row for each row of docs.

    Every whole text gets the cosine-weighted vote of its nearest labelled vectors, which are found by exact products
    with all of them. Neither labels nor other columns are inputs. Defined cases: null text is an empty
    one; texts without any term, such as these, score 0; labels other than 0 and 1 are
    not learned, of several for an id the smallest counts; of several texts of an id one is learned; rows are scored one by one; without labels of both kinds all
    other scores are 0.5; extra columns pass through, whatever their names, but a column q_score is replaced.
    A model that is given is used, and labels are not read.
    """
    model = docs.sparkSession.sparkContext.broadcast(fitted or train(docs, labels, sample))
    rest = [f for f in docs.schema.fields if f.name not in ("text", "q_score")]
    # everything but the text goes in one column, so that no name can clash
    packed = docs.select(F.struct(*(docs[f"`{f.name}`"] for f in rest)).alias("row"), docs["text"].cast("binary").alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches):
            raw = b["text"].to_pylist()
            out = [model.value.score(np.stack([features(x or b"") for x in raw[i : i + BLOCK]])) for i in range(0, len(raw), BLOCK)]
            yield pa.record_batch({"row": b["row"], "text": b["text"], "q_score": pa.array(np.concatenate(out), pa.float64())})

    done = packed.mapInArrow(run, T.StructType([*packed.schema.fields, T.StructField("q_score", T.DoubleType())]))
    own = {f.name: F.col("row").getField(f.name).alias(f.name) for f in rest} | {"text": F.col("text").cast("string").alias("text")}
    return done.select(*(own[c] for c in docs.columns if c in own), "q_score")


def op7_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents").select("doc_id", "text")
    out = classify(docs.select("doc_id", "text"), read(spark, sf_dir, "labels"))
    return out.select("doc_id", (fold(F.col("doc_id")) == HELD_OUT).alias("held_out"), F.col("q_score").alias("score"), (F.col("q_score") >= CUT).cast("int").alias("predicted"))


def crc_fold(doc_id: object) -> int:
    """fold() outside Spark."""
    return zlib.crc32(str(doc_id).encode()) % FOLDS
