"""Quality by attention-based multiple-instance learning (operator 9).

A document is a bag of passages of ``WORDS`` words, all of them to its end. Every
passage is encoded, a gated attention (tanh times sigmoid) weighs the passages,
and the weighted sum is scored; weights are learned from document labels alone.

Null, empty and blank texts are one passage without words; texts of any length are
scored by all their passages. Repeated rows get equal scores, a row each. Duplicate
labels of an id count once, as the larger. At most ``train_rows`` labelled rows,
the first by a hash of the id (ties by the id), one text an id, are used to fit,
and none whose text is longer than ``toxicity.TRAIN_CHARS``; see
``toxicity.training_sample``. Without any label the score is 0.5 for all. An empty
table gives an empty result. Labels, language, source and id are no inputs of a
score; other columns are not read, so their names can't clash.
"""

from __future__ import annotations

import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from corpusloom.llm.storage import ship_package
from corpusloom.llm.toxicity import held_out, training_sample

TRAIN_ROWS = 8000
WORDS = 200
INPUTS, HIDDEN, GATES = 16, 12, 8
_CLASSES = (b"#*$%&|<>", b"!", b".?", b",;:", b"0123456789", b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"()[]{}_=+/\\~^@", b"\"'-")
#: Frequent words of four languages.
COMMON = frozenset(
    "the of and to in a is that it was for on with as be at by this are from der die das und ist in zu den mit von für auf im ein eine des le la les de et un une des est dans que pour par pas sur el los en y del las se una con su".split()
)
_WORDS = re.compile(r"[^\x20\x09-\x0D]+")


def passages(text: str | None):
    """Lists of at most WORDS words, in order; one empty list for a text without words."""
    words = _WORDS.findall(text or "")
    for at in range(0, max(1, len(words)), WORDS):
        yield words[at : at + WORDS]


def encode(words: list[str]) -> list[float]:
    """Surface measures of one passage, each of about unit range."""
    n = len(words)
    if not n:
        return [0.0] * (INPUTS - 1) + [1.0]
    joined = "".join(words)
    data = joined.encode("utf-8")
    size = len(data)
    shares = [(size - len(data.translate(None, c))) / size for c in _CLASSES]
    lower = [w.lower() for w in words]
    distinct = len(set(lower))
    pairs = len(set(zip(lower, lower[1:], strict=False)))
    odd = sum(1 for w in words if not w[-1].isalnum())
    length = len(joined) / n
    return [*(min(1.0, 8 * s) for s in shares), distinct / n, pairs / max(1, n - 1), odd / n, sum(w in COMMON for w in lower) / n, min(3.0, length / 8), max(map(len, words)) / 40 if n else 0.0, min(1.0, n / WORDS), 0.0]


def bag(text: str | None) -> np.ndarray:
    return np.array([encode(p) for p in passages(text)], np.float32)


class GatedAttention:
    """The network; parameters are plain arrays so that it travels in a closure."""

    def __init__(self, seed: int = 7):
        r = np.random.default_rng(seed)
        draw = lambda a, b: (r.normal(size=(a, b)) / np.sqrt(a)).astype(np.float64)
        self.p = {"mean": np.zeros(INPUTS), "scale": np.ones(INPUTS), "W": draw(INPUTS, HIDDEN), "b": np.zeros(HIDDEN), "V": draw(HIDDEN, GATES), "U": draw(HIDDEN, GATES), "w": draw(GATES, 1)[:, 0], "c": draw(HIDDEN, 1)[:, 0], "d": np.zeros(1)}

    def forward(self, x: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, tuple]:
        """x: passages of all bags in order; starts: where each bag begins."""
        p = self.p
        x = np.clip((x - p["mean"]) / p["scale"], -6, 6)
        h = np.tanh(x @ p["W"] + p["b"])
        t, g = np.tanh(h @ p["V"]), 1 / (1 + np.exp(-(h @ p["U"])))
        logits = (t * g) @ p["w"]
        which = np.repeat(np.arange(len(starts)), np.diff([*starts, len(x)]))
        e = np.exp(logits - np.maximum.reduceat(logits, starts)[which])
        a = e / np.add.reduceat(e, starts)[which]
        z = np.add.reduceat(a[:, None] * h, starts)
        score = 1 / (1 + np.exp(-np.clip(z @ p["c"] + p["d"], -30, 30)))
        return score, (x, h, t, g, a, z, which)

    def gradients(self, x: np.ndarray, starts: np.ndarray, labels: np.ndarray) -> dict[str, np.ndarray]:
        """Of the mean log loss, by each trained parameter."""
        p = self.p
        score, (xs, h, t, g, a, z, which) = self.forward(x, starts)
        ds = (score - labels) / len(labels)
        dz = ds[:, None] * p["c"]
        dh = a[:, None] * dz[which]
        da = (dz[which] * h).sum(1)
        dl = a * (da - np.add.reduceat(a * da, starts)[which])
        dt, dg = dl[:, None] * p["w"] * g * (1 - t * t), dl[:, None] * p["w"] * t * g * (1 - g)
        dh += dt @ p["V"].T + dg @ p["U"].T
        du = dh * (1 - h * h)
        return {"W": xs.T @ du, "b": du.sum(0), "V": h.T @ dt, "U": h.T @ dg, "w": ((t * g) * dl[:, None]).sum(0), "c": z.T @ ds, "d": np.array([ds.sum()])}

    def fit(self, x: np.ndarray, starts: np.ndarray, labels: np.ndarray, epochs: int = 250, rate: float = 0.02, decay: float = 1e-4) -> GatedAttention:
        p = self.p
        p["mean"], p["scale"] = x.mean(0), np.maximum(x.std(0), 0.02)
        trained = ("W", "b", "V", "U", "w", "c", "d")
        m = {k: np.zeros_like(p[k]) for k in trained}
        v = {k: np.zeros_like(p[k]) for k in trained}
        for epoch in range(1, epochs + 1):
            grads = self.gradients(x, starts, labels)
            for k in trained:
                grad = grads[k] + decay * p[k]
                m[k] = 0.9 * m[k] + 0.1 * grad
                v[k] = 0.999 * v[k] + 0.001 * grad * grad
                p[k] = p[k] - rate * (m[k] / (1 - 0.9**epoch)) / (np.sqrt(v[k] / (1 - 0.999**epoch)) + 1e-8)
        return self


def learn(sample: DataFrame) -> GatedAttention:
    ship_package(sample.sparkSession)

    def measure(batches):
        for batch in batches:
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array([bag(t.as_py()).ravel() for t in batch.column(2)], pa.list_(pa.float32()))], names=["id", "label", "x"])

    id_type = sample.schema["id"].dataType.simpleString()
    rows = sample.select("id", "label", "text").mapInArrow(measure, f"id {id_type}, label int, x array<float>").toArrow().sort_by("id").to_pydict()
    network = GatedAttention()
    if not rows["x"]:
        network.p["c"] *= 0
        return network
    sizes = [len(x) // INPUTS for x in rows["x"]]
    x = np.concatenate([np.asarray(b, np.float64) for b in rows["x"]]).reshape(-1, INPUTS)
    return network.fit(x, np.concatenate([[0], np.cumsum(sizes)[:-1]]).astype(int), np.array(rows["label"], float))


def quality_scores(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality", modulus: int = 5, remainder: int = 0, threshold: float = 0.3, train_rows: int = TRAIN_ROWS) -> DataFrame:
    """Per row: the id, held_out, score and predicted."""
    network = learn(training_sample(docs, labels, id_col, text_col, label_col, modulus, remainder, train_rows))
    schema = T.StructType([docs.schema[id_col], T.StructField("held_out", T.BooleanType(), False), T.StructField("score", T.DoubleType(), False)])

    def score(batches):
        for batch in batches:
            for at in range(0, batch.num_rows, 512):
                part = batch.slice(at, 512)
                bags = [bag(t.as_py()) for t in part.column(2)]
                starts = np.cumsum([0, *(len(b) for b in bags[:-1])])
                p, _ = network.forward(np.concatenate(bags).astype(np.float64), starts)
                yield pa.RecordBatch.from_arrays([part.column(0), part.column(1), pa.array(p, pa.float64())], names=schema.names)

    rows = docs.select(F.col(id_col), held_out(F.col(id_col), modulus, remainder).alias("held_out"), F.col(text_col).cast("string").alias("__text"))
    return rows.mapInArrow(score, schema).withColumn("predicted", (F.col("score") >= threshold).cast("int"))
