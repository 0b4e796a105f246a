"""Quality classifier by attention-based multiple-instance learning.

A document is a bag of passages.  Every passage of the whole text is encoded:
shares of kinds of bytes, repetition and line shape, and a hashed histogram of
byte trigrams, through one dense layer.  A gated attention (tanh branch times
sigmoid branch) gives each passage a weight within its document; the weighted
sum of the encodings is the document, and a logistic layer scores it.  Only
documents have labels; attention and encoder are learned from them together,
by Adam in numpy, on a bounded sample of labelled rows, on the driver.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stationcast.llm.common import bounded_sample, held_out, map_batches, named, others, within_bytes

#: Bytes of a passage (the last one is shorter).
PASSAGE = 512
#: Bounds of the training sample: documents, and bytes of their whole texts together.
SAMPLE_DOCS, SAMPLE_BYTES = 4000, 16 << 20
HASHED, HIDDEN, GATE = 256, 24, 12
#: Kinds of bytes whose shares are features.
_KINDS = [b"abcdefghijklmnopqrstuvwxyz", b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"0123456789", b" ", b"\n", b".", b",", b"|", b"%", b"&", b"*",
          b"#", b"$", b"@:/", b"<>{}[]()", b"=\"'`;_-+!?~^\\", bytes(range(128, 256))]
_KIND = np.full(256, len(_KINDS), np.uint8)
for _k, _chars in enumerate(_KINDS):
    _KIND[np.frombuffer(_chars, np.uint8)] = _k
_N_KINDS = len(_KINDS) + 1
FEATURES = _N_KINDS + 5 + HASHED


def passages(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Features of every passage of every text, and the text each belongs to.
    An empty text has one passage of zeros."""
    sizes = np.array([len(t) for t in texts], np.int64)
    counts = np.maximum(1, -(-sizes // PASSAGE))
    owner, first = np.repeat(np.arange(len(texts)), counts), np.cumsum(counts) - counts
    data = np.frombuffer(b"".join(texts), np.uint8)
    total = len(owner)
    x = np.zeros((total, FEATURES), np.float32)
    if not len(data):
        return x, owner
    text_start = np.repeat(np.cumsum(sizes) - sizes, sizes)
    at = np.arange(len(data)) - text_start
    own = np.repeat(first, sizes) + at // PASSAGE
    length = np.maximum(np.bincount(own, minlength=total), 1).astype(np.float32)
    kinds = np.bincount(own * _N_KINDS + _KIND[data], minlength=total * _N_KINDS).reshape(total, -1)
    x[:, :_N_KINDS] = kinds / length[:, None]
    space = (data == 32) | (data == 10) | (data == 9) | (data == 13)
    # words: a rolling sum of byte codes between spaces stands for the word
    start = np.flatnonzero(~space & (np.r_[True, space[:-1]] | (at == 0)))
    if len(start):
        code = np.cumsum(np.where(space, 0, (data.astype(np.uint64) + 7) * (data.astype(np.uint64) + 131)))
        stop = np.r_[start[1:], len(data)] - 1
        word = code[stop] - np.r_[np.uint64(0), code[start[1:] - 1]]
        where = own[start]
        n = np.maximum(np.bincount(where, minlength=total), 1)
        again = np.r_[False, (word[1:] == word[:-1]) & (where[1:] == where[:-1])]
        different = np.unique(np.column_stack([where.astype(np.uint64), word]), axis=0)[:, 0].astype(np.int64)
        b = _N_KINDS
        x[:, b] = np.bincount(where, again, total) / n
        x[:, b + 1] = np.bincount(different, minlength=total) / n
        x[:, b + 2] = np.minimum(length / n, 40) / 10
        x[:, b + 3] = n / 100
        x[:, b + 4] = length / PASSAGE
    if len(data) > 2:
        d = data.astype(np.uint32)
        gram = ((d[:-2] * np.uint32(65599) + d[1:-1]) * np.uint32(65599) + d[2:]) * np.uint32(0x9E3779B1) >> np.uint32(24)
        hist = np.bincount(own[:-2] * HASHED + gram, minlength=total * HASHED).reshape(total, -1)
        x[:, _N_KINDS + 5:] = np.sqrt(hist / length[:, None])
    return x, owner


def sigmoid(z: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(z, -30, 30)))


@dataclass
class AttentionModel:
    """Scaling of the features and the layers' parameters by name."""
    mean: np.ndarray
    scale: np.ndarray
    p: dict[str, np.ndarray]

    def forward(self, x: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> dict[str, np.ndarray]:
        """Bags lie one after another in ``x``; attention is a softmax within each bag."""
        p = self.p
        h = np.tanh(x @ p["w"] + p["b"])
        v, u = np.tanh(h @ p["v"]), sigmoid(h @ p["u"])
        e = (v * u) @ p["a"]
        e = np.exp(e - np.repeat(np.maximum.reduceat(e, starts), lengths))
        a = e / np.repeat(np.add.reduceat(e, starts), lengths)
        z = np.add.reduceat(a[:, None] * h, starts, axis=0)
        return {"h": h, "v": v, "u": u, "a": a, "z": z, "y": sigmoid(z @ p["c"] + p["d"])}

    def scaled(self, x: np.ndarray) -> np.ndarray:
        return np.clip((x - self.mean) / self.scale, -6, 6)

    def scores(self, texts: list[bytes]) -> np.ndarray:
        x, owner = passages(texts)
        lengths = np.bincount(owner, minlength=len(texts))
        return self.forward(self.scaled(x), np.cumsum(lengths) - lengths, lengths)["y"]


def train(bags: list[np.ndarray], labels: np.ndarray, epochs: int = 14, batch: int = 64, rate: float = 4e-3,
          decay: float = 1e-4, seed: int = 11) -> AttentionModel:
    """Fits encoder, gated attention and output on bags with 0/1 labels.  With
    no bags the model scores one half everywhere."""
    rng = np.random.default_rng(seed)
    everything = np.concatenate(bags) if bags else np.zeros((1, FEATURES), np.float32)
    model = AttentionModel(everything.mean(axis=0), everything.std(axis=0) + 1e-2, {
        "w": rng.normal(0, FEATURES ** -0.5, (FEATURES, HIDDEN)), "b": np.zeros(HIDDEN), "v": rng.normal(0, 0.3, (HIDDEN, GATE)),
        "u": rng.normal(0, 0.3, (HIDDEN, GATE)), "a": rng.normal(0, 0.3, GATE), "c": np.zeros(HIDDEN), "d": np.zeros(1)})
    p = model.p
    first, second, step = {k: np.zeros_like(v) for k, v in p.items()}, {k: np.zeros_like(v) for k, v in p.items()}, 0
    inputs = [model.scaled(b) for b in bags]
    for epoch in range(epochs):
        order = rng.permutation(len(inputs))
        for some in (order[i:i + batch] for i in range(0, len(order), batch)):
            lengths = np.array([len(inputs[i]) for i in some])
            x, starts, own = np.concatenate([inputs[i] for i in some]), np.cumsum(lengths) - lengths, np.repeat(np.arange(len(some)), lengths)
            f = model.forward(x, starts, lengths)
            slope = (f["y"] - labels[some]) / len(some)
            g = {"c": f["z"].T @ slope, "d": np.array([slope.sum()])}
            dz = slope[:, None] * p["c"]
            pull = (dz[own] * f["h"]).sum(axis=1)
            de = f["a"] * (pull - np.repeat(np.add.reduceat(f["a"] * pull, starts), lengths))
            g["a"] = (f["v"] * f["u"]).T @ de
            dv, du = de[:, None] * p["a"] * f["u"] * (1 - f["v"] ** 2), de[:, None] * p["a"] * f["v"] * f["u"] * (1 - f["u"])
            g["v"], g["u"] = f["h"].T @ dv, f["h"].T @ du
            dh = (f["a"][:, None] * dz[own] + dv @ p["v"].T + du @ p["u"].T) * (1 - f["h"] ** 2)
            g["w"], g["b"] = x.T @ dh + decay * p["w"], dh.sum(axis=0)
            step += 1
            eta = rate * (0.5 if epoch > epochs * 0.6 else 1.0)
            for k in p:  # Adam
                first[k] = 0.9 * first[k] + 0.1 * g[k]
                second[k] = 0.999 * second[k] + 0.001 * g[k] ** 2
                p[k] = p[k] - eta * (first[k] / (1 - 0.9 ** step)) / (np.sqrt(second[k] / (1 - 0.999 ** step)) + 1e-8)
    return model


def fit(docs: DataFrame, labels: DataFrame, text: str = "text", key: str = "doc_id", label: str = "quality",
        sample_docs: int = SAMPLE_DOCS) -> AttentionModel:
    """Trains on a bounded sample of the labelled rows that are not held out.

    Rows of ``labels`` with a null key or label are left out; of a key with
    several labels the mean counts, of several texts the least.  The sample's labels,
    about ``sample_docs`` small rows, are broadcast to the documents; texts are taken
    whole, as many as fit in SAMPLE_BYTES."""
    known = (labels.select(F.col(key).alias("__k"), F.col(label).cast("double").alias("__y"))
             .where(F.col("__k").isNotNull() & F.col("__y").isNotNull() & ~held_out(F.col("__k"))).groupBy("__k").agg(F.avg("__y").alias("__y")))
    some = bounded_sample(known, "__k", sample_docs)
    rows = docs.select(F.col(key).alias("__k"), F.col(text).alias("__t")).join(F.broadcast(some), "__k").groupBy("__k").agg(F.min("__t").alias("__t"), F.first("__y").alias("__y"))
    rows = within_bytes(rows, "__k", "__t", SAMPLE_BYTES).select(F.col("__k").cast("string"), "__t", "__y")

    def encode(batch: pa.RecordBatch) -> pa.RecordBatch:
        texts = [(t or "").encode() for t in batch.column(1).to_pylist()]
        x, owner = passages(texts)
        cuts = np.searchsorted(owner, np.arange(len(texts) + 1))
        bags = [x[a:b].astype(np.float16).tobytes() for a, b in zip(cuts, cuts[1:])]  # every passage
        return pa.RecordBatch.from_arrays([batch.column(0), batch.column(2), pa.array(bags, pa.binary())], ["k", "y", "x"])
    got = map_batches(rows, encode, "k string, y double, x binary").collect()  # bounded by SAMPLE_BYTES: passages x features
    got.sort(key=lambda r: (r["k"], bytes(r["x"])))
    bags = [np.frombuffer(bytes(r["x"]), np.float16).reshape(-1, FEATURES).astype(np.float32) for r in got]
    return train(bags, np.array([r["y"] for r in got]))


def score(docs: DataFrame, model: AttentionModel, text: str = "text", out: str = "score") -> DataFrame:
    """``docs`` without the text and with ``out``: 0 to 1, higher where label 1 is likelier.

    Null and empty texts are one blank passage and get a score too.  A column
    that is called like the result is replaced; repeated rows and null keys
    give a row each; an empty table gives an empty result."""
    shared = docs.sparkSession.sparkContext.broadcast(model)  # layers of fixed size
    names = others(docs, text, out)
    own = docs.select(*named(*names, text)).toDF(*[f"__p{i}" for i in range(len(names) + 1)])  # taken by place

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        y = shared.value.scores([(t or "").encode() for t in batch.column(len(names)).to_pylist()])
        return pa.RecordBatch.from_arrays([*batch.columns[:len(names)], pa.array(y.astype(float))], [*names, out])
    types = [f"`{c}` {own.schema[i].dataType.simpleString()}" for i, c in enumerate(names)]
    return map_batches(own, run, ", ".join([*types, f"`{out}` double"]))


def digest(docs: DataFrame, labels: DataFrame, threshold: float = 0.3) -> DataFrame:
    """doc_id, held_out, score, predicted for every document."""
    scored = score(docs.select("doc_id", "text"), fit(docs, labels))
    return scored.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score",
                         (F.col("score") >= threshold).cast("int").alias("predicted"))
