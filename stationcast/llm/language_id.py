"""Language identification: averaged hashed subword embeddings and a linear softmax.

Subwords are the 2-, 3- and 4-grams of a text's UTF-8 bytes, A-Z lowered and
every other ASCII sign that is no letter taken as a space.  Each n-gram hashes
to a row of an embedding table; a text is the average of its rows, and a linear
softmax maps it to the languages.  Embeddings and softmax are trained together
by stochastic gradient descent in numpy, on passages of a bounded sample of
labelled documents, on the driver.  Since the softmax is linear, embedding
times weights is one small table (buckets x languages); scoring broadcasts it
and averages its rows over the whole text.

A temperature fitted on validation passages calibrates the probabilities, and
a threshold set on them rejects texts between the languages.  Probabilities only
compare the languages with each other, so a second threshold rejects texts that
look like none of them, however few there are: the mean log-likelihood of the
n-grams under the predicted language, against what validation passages of that
language have.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stationcast.llm.common import bounded_sample, held_out, map_batches, named, others, within_bytes

#: Bounds of the training sample: documents, and bytes of their whole texts together.  Texts are cut in passages of this many bytes.
SAMPLE_DOCS, SAMPLE_BYTES, PASSAGE_BYTES = 4000, 6 << 20, 320
GRAMS, BITS, DIM = (2, 3, 4), 15, 16
#: Validation texts that the rejection threshold may cost at most, as a share.
REJECT_SHARE = 0.002
#: Validation passages of a language lie within this many standard deviations of its mean likelihood, at least.
SPREAD = 6.0
#: Probability that a text outside of that is in any of the languages.
UNLIKE = 1e-6
#: Texts of at least this calibrated probability are not rejected for it.
REJECT_AT_MOST = 0.4
UNDETERMINED = "und"

_FOLD = np.full(256, 32, np.uint32)
_FOLD[128:] = np.arange(128, 256)
_FOLD[97:123] = _FOLD[65:91] = np.arange(97, 123)


def gram_ids(data: np.ndarray) -> list[np.ndarray]:
    """For every n, the table row of the n-gram that starts at each byte of ``data`` (uint8)."""
    b, out = _FOLD[data], []
    code = b.copy()
    for n in range(2, max(GRAMS) + 1):
        code = code[:-1] * np.uint32(257) + b[n - 1:] if len(code) > 1 else code[:0]
        if n in GRAMS:
            mixed = (code ^ (code >> np.uint32(15))) * np.uint32(0x9E3779B1)
            out.append((mixed >> np.uint32(32 - BITS)).astype(np.int32) + np.int32(GRAMS.index(n) << BITS))
    return out


def has_letter(text: str | None) -> bool:
    return bool(text) and any(map(str.isalpha, text))


@dataclass
class LanguageModel:
    """Languages, the folded table (rows x languages), bias, temperature and rejection
    threshold; log-frequencies of the n-grams (rows x languages), and for every
    language the mean and deviation of a passage's likelihood and the least deviation
    from the mean that is not rejected."""
    langs: list[str]
    folded: np.ndarray
    bias: np.ndarray
    temperature: float = 1.0
    reject_below: float = 0.0
    frequency: np.ndarray | None = None
    usual: np.ndarray | None = None
    unlike_below: float = -np.inf

    def logits(self, texts: list[bytes]) -> np.ndarray:
        """One row of logits for every text; texts without any n-gram give the bias."""
        return self._mean(self.folded, texts)[0] + self.bias

    def likelihood(self, texts: list[bytes], lang: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Mean log-likelihood of every text's n-grams under its language, and their number."""
        mean, count = self._mean(self.frequency, texts)
        return mean[np.arange(len(texts)), lang], count

    def unlike(self, texts: list[bytes], lang: np.ndarray) -> np.ndarray:
        """Whether every text's n-grams are too rare in its language.  A text shorter than
        a passage may deviate more, by the root of its share of a passage's n-grams."""
        if self.usual is None:
            return np.zeros(len(texts), bool)
        value, count = self.likelihood(texts, lang)
        wide = np.sqrt(np.maximum(1, PASSAGE_BYTES * len(GRAMS) / np.maximum(count, 1)))
        return (count > 0) & ((value - self.usual[lang, 0]) / (self.usual[lang, 1] * wide) < self.unlike_below)

    def _mean(self, table: np.ndarray, texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Mean of the table's rows for the n-grams of every text, and how many there are."""
        total = np.zeros((len(texts), len(self.langs)))
        count = np.zeros(len(texts))
        data = np.frombuffer(b"".join(texts), np.uint8)
        ends = np.cumsum([len(t) for t in texts])
        starts = ends - [len(t) for t in texts]
        for n, ids in zip(GRAMS, gram_ids(data)):
            own = np.maximum(ends - starts - (n - 1), 0)  # n-grams that lie within each text
            rows = np.flatnonzero(own)
            if len(rows):
                cuts = np.column_stack([starts[rows], starts[rows] + own[rows]]).ravel()
                if cuts[-1] == len(ids):
                    cuts = cuts[:-1]
                total[rows] += np.add.reduceat(table[ids], cuts, axis=0, dtype=np.float64)[::2]
                count[rows] += own[rows]
        return total / np.maximum(count, 1)[:, None], count

    def probabilities(self, texts: list[bytes]) -> np.ndarray:
        """Calibrated, and next to nothing for texts that look like none of the languages."""
        p = softmax(self.logits(texts) / self.temperature)
        return np.where(self.unlike(texts, p.argmax(axis=1))[:, None], p * UNLIKE, p)


def softmax(z: np.ndarray) -> np.ndarray:
    e = np.exp(z - z.max(axis=1, keepdims=True))
    return e / e.sum(axis=1, keepdims=True)


def train(passages: list[tuple[int, bytes, str]], epochs: int = 4, rate: float = 4.0, batch: int = 64, seed: int = 5) -> LanguageModel:
    """A model from (document number, passage, language).  Every fifth document is kept for
    calibration.  Without passages the model knows no language and calls all undetermined."""
    langs = sorted({x[2] for x in passages})
    if not langs:
        return LanguageModel([], np.zeros((len(GRAMS) << BITS, 0), np.float32), np.zeros(0))
    rng = np.random.default_rng(seed)
    code = {x: k for k, x in enumerate(langs)}
    fit = [x for x in passages if x[0] % 5] or passages
    check = [x for x in passages if not x[0] % 5] or passages
    bags = [np.concatenate(gram_ids(np.frombuffer(x[1], np.uint8))) for x in fit]
    keep = [i for i, bag in enumerate(bags) if len(bag)]
    target = np.array([code[x[2]] for x in fit])
    embed = rng.normal(0, 0.1, (len(GRAMS) << BITS, DIM)).astype(np.float32)
    weights, bias = np.zeros((DIM, len(langs)), np.float32), np.zeros(len(langs), np.float32)
    weights += rng.normal(0, 0.1, weights.shape).astype(np.float32)
    steps, done = max(1, epochs * -(-len(keep) // batch)), 0
    for _ in range(epochs):
        order = rng.permutation(keep)
        for some in (order[i:i + batch] for i in range(0, len(order), batch)):
            eta = rate * (1 - done / steps) + 1e-3
            done += 1
            lengths = np.array([len(bags[i]) for i in some])
            ids, starts = np.concatenate([bags[i] for i in some]), np.cumsum(lengths) - lengths
            mean = np.add.reduceat(embed[ids], starts, axis=0) / lengths[:, None]
            slope = softmax(mean @ weights + bias)
            slope[np.arange(len(some)), target[some]] -= 1
            slope = (slope / len(some)).astype(np.float32)
            pull = (slope @ weights.T) / lengths[:, None]
            weights -= eta * (mean.T @ slope)
            bias -= eta * 0.1 * slope.sum(axis=0)
            np.add.at(embed, ids, np.repeat(-eta * len(some) * pull, lengths, axis=0).astype(np.float32))
    model = LanguageModel(langs, (embed @ weights).astype(np.float32), bias.astype(float))
    counts = np.full((len(GRAMS) << BITS, len(langs)), 0.5)
    for bag, lang in zip(bags, target):
        np.add.at(counts[:, lang], bag, 1)
    model.frequency = np.log(counts / counts.sum(axis=0)).astype(np.float32)
    return calibrated(model, [x[1] for x in check], np.array([code[x[2]] for x in check]))


def calibrated(model: LanguageModel, texts: list[bytes], target: np.ndarray) -> LanguageModel:
    """Sets the temperature of least log loss, and the threshold that at most
    REJECT_SHARE of the rightly recognised validation passages fall below."""
    logits = model.logits(texts)

    def loss(t: float) -> float:
        return float(-np.log(softmax(logits / t)[np.arange(len(texts)), target] + 1e-12).mean())
    model.temperature = float(min(np.geomspace(0.05, 20, 60), key=loss))
    p = softmax(logits / model.temperature)
    right = np.sort(p.max(axis=1)[p.argmax(axis=1) == target])
    model.reject_below = float(min(REJECT_AT_MOST, right[int(REJECT_SHARE * len(right))])) if len(right) else 0.0
    if model.frequency is not None:
        value, count = model.likelihood(texts, target)
        full = (count >= 0.9 * count.max()) & (p.argmax(axis=1) == target)  # whole passages: short ones deviate more
        every = value[full] if full.any() else value
        model.usual = np.tile([every.mean(), max(every.std(), 0.02)], (len(model.langs), 1))
        for k in range(len(model.langs)):
            own = value[full & (target == k)]
            if len(own):
                model.usual[k] = own.mean(), max(own.std() if len(own) >= 10 else every.std(), 0.02)
        if full.any():
            z = np.sort((value[full] - model.usual[target[full], 0]) / model.usual[target[full], 1])
            model.unlike_below = float(min(-SPREAD, z[int(REJECT_SHARE * len(z))]))
    return model


def passages_of(text: str, size: int) -> list[bytes]:
    """The whole text in pieces of ``size`` bytes."""
    data = text.encode()
    return [data[i:i + size] for i in range(0, len(data), size)]


def fit(docs: DataFrame, text: str = "text", lang: str = "lang", key: str = "doc_id", sample_docs: int = SAMPLE_DOCS) -> LanguageModel:
    """Trains on passages of a bounded sample of the rows that are not held out
    and have a language, a text with a letter and a key."""
    known = docs.where(~held_out(named(key)[0]) & named(lang)[0].isNotNull())
    own = known.select(named(key)[0].alias("k"), named(text)[0].alias("t"), named(lang)[0].alias("g"))
    some = within_bytes(bounded_sample(own, "k", sample_docs), "k", "t", SAMPLE_BYTES).select(F.col("k").cast("string"), "t", "g")

    def cut(batch: pa.RecordBatch) -> pa.RecordBatch:
        rows = [(k, p, g) for k, t, g in zip(*(c.to_pylist() for c in batch.columns)) if has_letter(t)
                for p in passages_of(t, PASSAGE_BYTES)]
        return pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], kind) for i, kind in enumerate((pa.string(), pa.binary(), pa.string()))], ["k", "p", "g"])
    rows = sorted(map(tuple, map_batches(some, cut, "k string, p binary, g string").collect()))  # bounded by SAMPLE_BYTES
    numbers = {k: i for i, k in enumerate(dict.fromkeys(r[0] for r in rows))}
    return train([(numbers[k], bytes(p), g) for k, p, g in rows])


def identify(docs: DataFrame, model: LanguageModel, text: str = "text", pred: str = "lang_pred", score: str = "score",
             rejected: str = "rejected", passthrough: list[str] | None = None) -> DataFrame:
    """The columns ``passthrough`` (all by default) of ``docs`` with the language of
    the whole text, its calibrated probability, and whether it is rejected.

    Null texts and texts without a letter are ``und`` with score 0, rejected.
    Columns of ``docs`` that are called like the results are replaced.  Repeated
    rows and null keys give a row each; an empty table gives an empty result."""
    spark = docs.sparkSession
    shared = spark.sparkContext.broadcast(model)  # buckets x languages numbers
    names = others(docs.select(*named(*passthrough)) if passthrough else docs, pred, score, rejected)
    own = docs.select(*named(*names, text)).toDF(*[f"__p{i}" for i in range(len(names) + 1)])  # taken by place

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        m, texts = shared.value, batch.column(len(names)).to_pylist()
        p = m.probabilities([(t or "").encode() for t in texts]) if m.langs else np.zeros((len(texts), 1))
        best, top = p.argmax(axis=1), p.max(axis=1)
        known = np.array([bool(m.langs) and has_letter(t) for t in texts])
        return pa.RecordBatch.from_arrays([
            *batch.columns[:len(names)],
            pa.array([m.langs[b] if k else UNDETERMINED for b, k in zip(best, known)], pa.string()),
            pa.array(np.where(known, top, 0.0)), pa.array(~known | (top < m.reject_below))], [*names, pred, score, rejected])
    types = [f"`{c}` {own.schema[i].dataType.simpleString()}" for i, c in enumerate(names)]
    return map_batches(own, run, ", ".join([*types, f"`{pred}` string", f"`{score}` double", f"`{rejected}` boolean"]))


def digest(docs: DataFrame) -> DataFrame:
    """doc_id, held_out, lang_pred, score, rejected for every document."""
    found = identify(docs.select("doc_id", "text"), fit(docs), passthrough=["doc_id"])
    return found.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "lang_pred", "score", "rejected")
