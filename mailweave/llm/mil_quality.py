"""Document quality by attention-based multiple-instance learning.

A document is a bag of passages of about 100 words. Every passage is described by character and
word statistics and hashed letter pairs, and encoded by a learned layer. A gated attention
(tanh times sigmoid) gives each passage a weight; the document's score comes from the weighted
sum of the encodings. Encoder, attention and output are learned together, from document labels
alone, by gradient descent on the log loss.

Learning is done on the driver from a bounded sample: at most ``SAMPLE`` labelled documents,
chosen by a hash of their ids, each of at most ``BAG`` passages; those of a longer one are drawn
by hash over its whole length. Only their passage features are gathered. Scoring reads every whole text in its task and shuffles nothing.

Edge cases: a null or empty text is one passage without words and gets a score like others. If
there is no label, or only one kind, every score is the share of label 1 (0.5 without any). A
document labelled twice takes the greater label. Repeated rows are scored each. Extra columns are
kept; columns with the output's names are replaced. An empty table gives no rows.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from mailweave.llm.common import held_out, table

PASSAGE = 600
SAMPLE = 3_000
BAG = 128
PAIRS = 32
SLICE = 1 << 19
OUTPUT = [T.StructField("score", T.DoubleType()), T.StructField("predicted", T.IntegerType())]

# Kinds of characters that are counted in a passage.
KINDS = ["other", "upper", "lower", "digit", "space", "line", "mark", "exclaim", "symbol", "bar", "wide"]
N_FEATURES = len(KINDS) + 5 + PAIRS
_kinds: list[np.ndarray] = []


def kind_of() -> np.ndarray:
    """Kind of each code point; made once per worker."""
    if not _kinds:
        of = np.zeros(0x110000, dtype=np.int8)
        for i in range(0x3000):
            c = chr(i)
            of[i] = 1 if c.isupper() else 2 if c.isalpha() else 3 if c.isdigit() else 4 if c.isspace() else 0
        of[0x3000:] = KINDS.index("wide")
        for name, chars in (("line", "\n"), ("mark", ".,;:?'\"()-"), ("exclaim", "!"), ("symbol", "#*$%&<>@^~=+_\\/{}[]"), ("bar", "|")):
            of[[ord(c) for c in chars]] = KINDS.index(name)
        _kinds.append(of)
    return _kinds[0]


def passages(text: str) -> list[str]:
    """The text in pieces of about ``PASSAGE`` characters, cut at white space where there is any."""
    out, at = [], 0
    while len(text) - at > PASSAGE * 3 // 2:
        end = max(text.find(" ", at + PASSAGE, at + 2 * PASSAGE), at + PASSAGE)
        out.append(text[at:end])
        at = end
    out.append(text[at:])
    return out


def drawn(bag: list[str], most: int) -> list[str]:
    """At most ``most`` passages in their order, by a hash of passage and place."""
    if len(bag) <= most:
        return bag
    order = sorted(range(len(bag)), key=lambda k: (zlib.crc32(f"{k} {bag[k]}".encode("utf-8", "surrogatepass")), k))
    return [bag[k] for k in sorted(order[:most])]


def features(texts: list[str], most: int | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Features of all passages, or of ``most`` drawn from each text, and their number in each text."""
    bags = [passages(t) for t in texts]
    if most is not None:
        bags = [drawn(b, most) for b in bags]
    sizes = np.array([len(b) for b in bags], dtype=np.int64)
    flat = [p for b in bags for p in b]
    n = len(flat)
    lengths = np.array([len(p) for p in flat], dtype=np.int64)
    code = np.frombuffer("".join(flat).encode("utf-32-le", "surrogatepass"), dtype="<u4")
    owner = np.repeat(np.arange(n), lengths)
    kinds = kind_of()[np.minimum(code, 0x10FFFF)]
    counts = np.bincount(owner * len(KINDS) + kinds, minlength=n * len(KINDS)).reshape(n, -1)
    pair = (code[:-1] * np.uint32(31) + code[1:]) * np.uint32(2654435761) >> np.uint32(27)
    own = owner[:-1]
    pairs = np.bincount(own * PAIRS + pair, minlength=n * PAIRS).reshape(n, -1)
    per_char = 1.0 / np.maximum(lengths, 1)[:, None]
    words = np.empty((n, 5))
    for k, p in enumerate(flat):
        w = p.split()
        m = len(w) or 1
        same = sum(map(str.__eq__, w, w[1:]))
        words[k] = (len(w) / 100, len(set(w)) / m, same / m, lengths[k] / m / 10, float(not w))
    out = np.concatenate([counts * per_char, words, pairs * per_char], axis=1)
    return out.astype(np.float32), sizes


class Attention:
    """Passage encoder, gated attention and output layer."""

    def __init__(self, hidden: int = 24, gate: int = 12, seed: int = 7) -> None:
        rng = np.random.default_rng(seed)
        draw = lambda a, b: rng.normal(0, 1 / np.sqrt(a), (a, b))
        self.w = {
            "e": draw(N_FEATURES, hidden), "eb": np.zeros(hidden), "v": draw(hidden, gate), "u": draw(hidden, gate),
            "a": draw(gate, 1)[:, 0], "o": draw(hidden, 1)[:, 0], "ob": np.zeros(1),
        }
        self.mean, self.scale = np.zeros(N_FEATURES), np.ones(N_FEATURES)
        self.share: float | None = 0.5  # the score where nothing could be learned

    def forward(self, x: np.ndarray, sizes: np.ndarray) -> dict[str, np.ndarray]:
        w = self.w
        starts = np.concatenate([[0], np.cumsum(sizes)[:-1]])
        x = np.clip((x - self.mean) / self.scale, -8, 8)
        h = np.tanh(x @ w["e"] + w["eb"])
        t = np.tanh(h @ w["v"])
        s = 1 / (1 + np.exp(-(h @ w["u"])))
        logit = (t * s) @ w["a"]
        top = np.maximum.reduceat(logit, starts)
        own = np.repeat(np.arange(len(sizes)), sizes)
        raised = np.exp(logit - top[own])
        weight = raised / np.add.reduceat(raised, starts)[own]
        bag = np.add.reduceat(weight[:, None] * h, starts, axis=0)
        score = 1 / (1 + np.exp(-np.clip(bag @ w["o"] + w["ob"][0], -40, 40)))
        return {"x": x, "h": h, "t": t, "s": s, "weight": weight, "own": own, "bag": bag, "score": score, "starts": starts}

    def gradient(self, f: dict[str, np.ndarray], y: np.ndarray, decay: float) -> dict[str, np.ndarray]:
        w, own = self.w, f["own"]
        d_out = (f["score"] - y) / len(y)
        d_bag = d_out[:, None] * w["o"]
        d_h = f["weight"][:, None] * d_bag[own]
        d_weight = (f["h"] * d_bag[own]).sum(axis=1)
        mean = np.add.reduceat(f["weight"] * d_weight, f["starts"])[own]
        d_logit = f["weight"] * (d_weight - mean)
        d_t = d_logit[:, None] * w["a"] * f["s"] * (1 - f["t"] ** 2)
        d_s = d_logit[:, None] * w["a"] * f["t"] * f["s"] * (1 - f["s"])
        d_h = (d_h + d_t @ w["v"].T + d_s @ w["u"].T) * (1 - f["h"] ** 2)
        g = {
            "e": f["x"].T @ d_h, "eb": d_h.sum(axis=0), "v": f["h"].T @ d_t, "u": f["h"].T @ d_s,
            "a": (f["t"] * f["s"]).T @ d_logit, "o": f["bag"].T @ d_out, "ob": np.array([d_out.sum()]),
        }
        return {k: v + decay * w[k] for k, v in g.items()}

    def learn(self, x: np.ndarray, sizes: np.ndarray, y: np.ndarray, rounds: int = 240, rate: float = 0.02, decay: float = 2e-4) -> Attention:
        self.share = float(y.mean()) if len(y) else 0.5
        if len(y) == 0 or y.min() == y.max():
            return self
        self.share = None
        self.mean, self.scale = x.mean(axis=0), x.std(axis=0) + 1e-3
        first = {k: np.zeros_like(v) for k, v in self.w.items()}
        second = {k: np.zeros_like(v) for k, v in self.w.items()}
        x = x.astype(np.float64)
        for step in range(1, rounds + 1):
            g = self.gradient(self.forward(x, sizes), y, decay)
            for k in self.w:
                first[k] = 0.9 * first[k] + 0.1 * g[k]
                second[k] = 0.999 * second[k] + 0.001 * g[k] ** 2
                self.w[k] = self.w[k] - rate * (first[k] / (1 - 0.9**step)) / (np.sqrt(second[k] / (1 - 0.999**step)) + 1e-8)
        return self

    def scores(self, texts: list[str]) -> np.ndarray:
        if self.share is not None:
            return np.full(len(texts), self.share)
        return self.forward(*features(texts))["score"]


def groups(texts: list[str]) -> Iterator[tuple[int, list[str]]]:
    """Runs of texts of about half a million characters, with the place of the first."""
    start = size = 0
    for k, t in enumerate(texts):
        size += len(t)
        if size >= SLICE:
            yield start, texts[start : k + 1]
            start, size = k + 1, 0
    if start < len(texts):
        yield start, texts[start:]


def fit(docs: DataFrame, labels: DataFrame, label: str = "quality", sample: int = SAMPLE) -> Attention:
    """Learn from labelled documents outside the held-out third; ``docs(doc_id, text)``."""
    known = labels.filter(F.col("doc_id").isNotNull() & F.col(label).isNotNull() & ~held_out(F.col("doc_id")))
    known = known.groupBy("doc_id").agg(F.max(label).cast("int").alias("_label"))
    # A bounded top-k by hash, so its broadcast is bounded too.
    chosen = known.orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample)

    def describe(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            for first, some in groups(frame["text"].tolist()):
                x, sizes = features(some, BAG)
                ends = np.cumsum(sizes)
                part = frame.iloc[first : first + len(some)]
                yield pd.DataFrame({
                    "doc_id": part["doc_id"].to_numpy(), "label": part["_label"].to_numpy(), "n": sizes,
                    "x": [x[e - n : e].tobytes() for e, n in zip(ends, sizes)],
                })

    text = F.coalesce(F.col("text"), F.lit(""))
    rows = docs.select("doc_id", text.alias("text"))
    rows = rows.join(F.broadcast(chosen), "doc_id").mapInPandas(describe, "doc_id bigint, label int, n bigint, x binary")
    bags = rows.toPandas().sort_values(["doc_id", "n", "x"], ignore_index=True)
    x = np.frombuffer(b"".join(bags["x"]), dtype=np.float32).reshape(-1, N_FEATURES)
    return Attention().learn(x, bags["n"].to_numpy(dtype=np.int64), bags["label"].to_numpy(dtype=np.float64))


def score_quality(df: DataFrame, model: Attention, text: str = "text") -> DataFrame:
    """All columns of ``df`` and ``score, predicted``."""
    new = {f.name for f in OUTPUT}
    kept = [f for f in df.schema.fields if f.name.lower() not in new]
    shared = df.sparkSession.sparkContext.broadcast(model)

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first, some in groups([t or "" for t in batch.column(text).to_pylist()]):
                part = batch.slice(first, len(some))
                found = shared.value.scores(some)
                columns = [part.column(f.name) for f in kept]
                columns += [pa.array(found), pa.array((found >= 0.5).astype(np.int32))]
                yield pa.RecordBatch.from_arrays(columns, names=[*[f.name for f in kept], "score", "predicted"])

    return df.mapInArrow(score, T.StructType([*kept, *OUTPUT]))


def op3_quality(spark, sf_dir) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = fit(docs, table(spark, sf_dir, "labels"))
    rows = docs.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "text")
    return score_quality(rows, model).select("doc_id", "held_out", "score", "predicted")


def stage(spark, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents of fair quality; those that :func:`score_quality` predicts as 0 go."""
    model = fit(docs, table(spark, sf_dir, "labels"))
    kept = docs.columns
    renamed = docs.toDF(*[f"c{k}" for k in range(len(kept))])
    scored = score_quality(renamed, model, f"c{kept.index('text')}").filter("predicted = 1")
    return scored.select(*[F.col(f"c{k}").alias(c) for k, c in enumerate(kept)])
