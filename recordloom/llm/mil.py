"""Document quality by attention-based multiple-instance learning.

A document is a bag of passages of ``PASSAGE`` words, all of them.  A passage is encoded as
shares and sizes of its characters, words and repeats; a dense layer makes its representation h.  Gated attention (Ilse, Tomczak and Welling, "Attention-based deep multiple
instance learning", 2018) weighs the passages, a = softmax(w . (tanh(V h) * sigmoid(U h))), and the
score is the logistic of a linear function of the weighted sum of h.  Only documents have
labels; the weights of the passages are learned from them.

The model is fitted on at most ``SAMPLE`` labelled documents, those with the least hash of their
id, whose passages Spark encodes; the driver holds their encodings and a model of some
thousand numbers.  Scoring reads each document once, where it lies.

Defined cases: null and empty texts are one passage without words; a document labelled twice
counts twice; labels other than 0 and 1 and labels of unknown documents are left out;
without labels of both kinds every score is the smoothed share of label 1; repeated rows get equal
scores; further columns are ignored; no rows give no rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

PASSAGE = 64
SAMPLE = 6000
HIDDEN, GATE = 32, 16
EPOCHS, BATCH, RATE, DECAY = 15, 64, 3e-3, 1e-2

_KINDS = 9  # other ASCII, lower, upper, digit, symbol, mark, stop, white space, beyond ASCII
_KIND = np.zeros(256, np.int64)
for _k, _members in enumerate(
    (b"abcdefghijklmnopqrstuvwxyz", b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"0123456789", b"#*$%&|<>", b"!?", b".,;:", b" \t\n\r\x0b\x0c"), 1
):
    _KIND[list(_members)] = _k
_KIND[128:] = 8
N_FEATURES = _KINDS + 9


def encode(data: bytes | None) -> np.ndarray:
    """One row of features for each passage; one row of zeros for a text without words."""
    words = (data or b"").split()
    if not words:
        return np.zeros((1, N_FEATURES), np.float32)
    raw = np.frombuffer(data, np.uint8)
    kind = _KIND[raw]
    space = kind == 7
    starts = np.nonzero(~space & np.append(True, space[:-1]))[0]
    ends = np.nonzero(~space & np.append(space[1:], True))[0] + 1
    n = len(words)
    passage = np.arange(n) // PASSAGE
    count = passage[-1] + 1
    size = np.bincount(passage)
    # Characters, up to where the next passage begins.
    bounds = np.append(starts[::PASSAGE], len(raw))
    of_byte = np.repeat(np.arange(count), np.diff(bounds))
    kinds = np.bincount(of_byte * _KINDS + kind[bounds[0] :], minlength=count * _KINDS).reshape(count, _KINDS)
    chars = kinds.sum(1, keepdims=True)
    # Words: lengths, capitals, ends, repeats.
    length = ends - starts
    first = np.arange(0, n, PASSAGE)
    mean = np.add.reduceat(length, first) / size
    spread = np.sqrt(np.maximum(np.add.reduceat(length.astype(float) ** 2, first) / size - mean**2, 0))
    capital = np.add.reduceat(kind[starts] == 2, first, dtype=float) / size
    closed = np.add.reduceat(np.isin(kind[ends - 1], (5, 6)), first, dtype=float) / size
    short = np.add.reduceat(length <= 3, first, dtype=float) / size
    numbers: dict[bytes, int] = {}
    ids = np.fromiter((numbers.setdefault(w, len(numbers)) for w in words), np.int64, n)
    distinct, times = np.unique(passage * len(numbers) + ids, return_counts=True)
    at = distinct // len(numbers)
    most = np.zeros(count)
    np.maximum.at(most, at, times)
    follow = np.append(ids[1:] == ids[:-1], False)
    stutter = np.add.reduceat(follow, first, dtype=float) / size
    lines = np.bincount(of_byte[raw[bounds[0] :] == 10], minlength=count) / size
    figures = np.stack(
        [
            np.log1p(size), mean / 10, spread / 10, capital, closed, short,
            np.bincount(at, minlength=count) / size, most / size + stutter, np.minimum(lines, 1),
        ],
        1,
    )
    return np.hstack([kinds / chars, figures]).astype(np.float32)


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


@dataclass
class Model:
    """Weights of the encoder, the gate and the score; ``prior`` alone if nothing was learned."""

    prior: float
    mean: np.ndarray | None = None
    scale: np.ndarray | None = None
    weights: dict[str, np.ndarray] | None = None

    def _forward(self, x: np.ndarray, first: np.ndarray) -> dict[str, np.ndarray]:
        """``x`` holds the passages of several documents, each beginning at one of ``first``."""
        p = self.weights
        size = np.diff(np.append(first, len(x)))
        h = np.tanh(x @ p["E"] + p["e"])
        t, g = np.tanh(h @ p["V"]), _sigmoid(h @ p["U"])
        energy = (t * g) @ p["w"]
        energy = np.exp(energy - np.repeat(np.maximum.reduceat(energy, first), size))
        a = energy / np.repeat(np.add.reduceat(energy, first), size)
        z = np.add.reduceat(a[:, None] * h, first)
        return {"h": h, "t": t, "g": g, "a": a, "z": z, "size": size, "score": _sigmoid(z @ p["c"] + p["b"])}

    def score(self, passages: list[np.ndarray]) -> tuple[np.ndarray, list[np.ndarray]]:
        """Scores of documents and the attention of their passages."""
        if self.weights is None:
            return np.full(len(passages), self.prior), [np.full(len(x), 1 / len(x)) for x in passages]
        first = np.cumsum([0, *map(len, passages[:-1])])
        out = self._forward((np.concatenate(passages) - self.mean) / self.scale, first)
        return out["score"], np.split(out["a"], first[1:])

    @classmethod
    def fit(cls, passages: list[np.ndarray], labels: np.ndarray, seed: int = 0) -> Model:
        prior = float((labels.sum() + 1) / (len(labels) + 2))
        if len(set(labels.tolist())) < 2:
            return cls(prior)
        every = np.concatenate(passages)
        mean, scale = every.mean(0), every.std(0) + 1e-3
        inputs = [((x - mean) / scale).astype(np.float32) for x in passages]
        rng = np.random.default_rng(seed)

        def start(*shape: int) -> np.ndarray:
            return (rng.standard_normal(shape) / np.sqrt(shape[0])).astype(np.float32)

        p = {
            "E": start(every.shape[1], HIDDEN), "e": np.zeros(HIDDEN, np.float32), "V": start(HIDDEN, GATE),
            "U": start(HIDDEN, GATE), "w": start(GATE), "c": start(HIDDEN), "b": np.zeros(1, np.float32),
        }
        model = cls(prior, mean, scale, p)
        moment = {k: (np.zeros_like(v), np.zeros_like(v)) for k, v in p.items()}
        step = 0
        for _ in range(EPOCHS):
            order = rng.permutation(len(inputs))
            for lo in range(0, len(order), BATCH):
                chosen = order[lo : lo + BATCH]
                x = np.concatenate([inputs[i] for i in chosen])
                first = np.cumsum([0, *[len(inputs[i]) for i in chosen[:-1]]])
                step += 1
                for k, slope in model._slopes(x, first, labels[chosen]).items():
                    m, v = moment[k]
                    m += 0.1 * (slope - m)
                    v += 0.001 * (slope * slope - v)
                    size = np.sqrt(v / (1 - 0.999**step)) + 1e-8
                    p[k] -= RATE * (m / (1 - 0.9**step) / size + DECAY * p[k])
        return model

    def _slopes(self, x: np.ndarray, first: np.ndarray, labels: np.ndarray) -> dict[str, np.ndarray]:
        """Gradient of the mean logistic loss."""
        p, f = self.weights, self._forward(x, first)
        h, t, g, a, size = f["h"], f["t"], f["g"], f["a"], f["size"]
        d_logit = (f["score"] - labels) / len(labels)
        d_z = np.repeat(d_logit[:, None] * p["c"], size, axis=0)
        d_a = (d_z * h).sum(1)
        d_energy = a * (d_a - np.repeat(np.add.reduceat(a * d_a, first), size))
        d_t = d_energy[:, None] * p["w"] * g * (1 - t * t)
        d_g = d_energy[:, None] * p["w"] * t * g * (1 - g)
        d_h = (a[:, None] * d_z + d_t @ p["V"].T + d_g @ p["U"].T) * (1 - h * h)
        return {
            "E": x.T @ d_h, "e": d_h.sum(0), "V": h.T @ d_t, "U": h.T @ d_g, "w": (t * g).T @ d_energy,
            "c": f["z"].T @ d_logit, "b": d_logit.sum(keepdims=True),
        }


def held_out(id_col: str = "doc_id") -> Column:
    """Whether a document is kept from training: crc32 of its id as text leaves 1 mod 3."""
    return F.crc32(F.coalesce(F.col(id_col).cast("string"), F.lit("")).cast("binary")) % 3 == 1


def _encode_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        bags = [encode(x.as_py()).tobytes() for x in batch.column(1).cast(pa.binary())]
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(bags, pa.binary())], names=["label", "bag"])


def fit(
    docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality",
    sample: int = SAMPLE, seed: int = 0,
) -> Model:
    """Fit on labelled documents that are not held out, at most ``sample`` of them."""
    chosen = (
        labels.filter(F.col(label_col).isin(0, 1) & ~held_out(id_col))
        .select(F.col(id_col).alias("id"), F.col(label_col).cast("int").alias("label"))
        .orderBy(F.xxhash64("id"), "id", "label")
        .limit(sample)
    )
    texts = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    rows = (
        texts.join(chosen, "id")
        .select("label", "text")
        .mapInArrow(_encode_rows, "label int, bag binary")
        .collect()
    )
    rows = sorted((r.label, bytes(r.bag)) for r in rows)  # the same model whatever the order of the rows
    bags = [np.frombuffer(b, np.float32).reshape(-1, N_FEATURES) for _, b in rows]
    return Model.fit(bags, np.array([label for label, _ in rows], np.float32), seed)


def score(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, held_out, score, predicted, top_passage, top_weight) of every document."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            scores, tops, weights = [], [], []
            texts = batch.column(2).cast(pa.binary())
            for lo in range(0, len(texts), 256):
                found, attention = model.score([encode(x.as_py()) for x in texts[lo : lo + 256]])
                scores.append(found.astype(np.float64))
                tops += [int(a.argmax()) for a in attention]
                weights += [float(a.max()) for a in attention]
            every = np.concatenate(scores) if scores else np.zeros(0)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0), batch.column(1), pa.array(every), pa.array((every >= 0.5).astype(np.int32)),
                    pa.array(tops, pa.int32()), pa.array(weights, pa.float64()),
                ],
                names=["doc_id", "held_out", "score", "predicted", "top_passage", "top_weight"],
            )

    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), held_out(id_col).alias("held_out"), F.col(text_col))
    return rows.mapInArrow(
        run, "doc_id long, held_out boolean, score double, predicted int, top_passage int, top_weight double"
    )
