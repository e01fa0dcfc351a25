"""Document quality from a linear-chain conditional random field over lines.

Every line of a text is labelled good or bad. A line's features and those of the lines before and behind it
are its evidence, and transitions tie neighbouring labels. The field is fitted on a bounded sample of labelled
documents, whose lines take the document's label, by gradient ascent on the conditional likelihood. A
document's score is the mean of its lines' forward-backward marginals of "good", weighted by their lengths.

Features come from the text alone. Inference runs side by side over the texts of a batch.

Defined results: a null text counts as empty, and an empty text is one empty line and has that line's score;
lines without characters weigh as one character; repeated rows each keep a row; extra columns are left out;
an empty table gives no rows; without labelled rows to learn from every score is 0.5; a null doc_id gives a null
held_out. Texts of more than `LONG` lines are scored in blocks of `_BLOCK` bytes of lines with carried messages, which
take some 40 bytes a line, and the lines seen so far are remembered for the text.
"""

from __future__ import annotations

from collections.abc import Iterator
from math import exp, log1p

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.llm import common

_RESULT = "doc_id long, held_out boolean, score double, predicted int"
#: Lines of a text that are scored side by side with other texts; bytes of a longer text that are looked at together.
LONG, _BLOCK = 5_000, 20_000
#: Byte classes that are counted per line: capitals, digits, blanks, symbols, bars, exclamation marks, points, non-ASCII bytes.
_CLASSES = (b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"0123456789", b" \t", b"#*$%&<>@^~_={}[]\\", b"|", b"!?", b".,;:", bytes(range(128, 256)))
FEATURES = len(_CLASSES) + 8


def line_features(texts: list[bytes | None], before: set[bytes] | None = None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Features (lines x FEATURES), length in bytes of each line, and the number of lines of each text.

    `before` holds the lines of one text that came before these, and grows.
    """
    lut = np.full(256, len(_CLASSES), np.uint8)
    for i, some in enumerate(_CLASSES):
        lut[list(some)] = i
    per_text, lines = [], []
    fresh: list[tuple[float, float, float, float]] = []
    for text in texts:
        own = (text or b"").split(b"\n")
        per_text.append(len(own))
        lines += own
        seen: set[bytes] = set() if before is None else before
        for line in own:
            words = line.split()
            different = set(words)
            again = bool(words) and line in seen
            if words:
                seen.add(line)
            capital = sum(map(bytes.isupper, words)) if line != line.lower() else 0
            fresh.append((len(words), len(different), float(again), capital))
    size = np.fromiter(map(len, lines), np.int64, len(lines))
    kinds = lut[np.frombuffer(b"".join(lines), np.uint8)]
    ends = np.cumsum(size)
    counts = np.zeros((len(lines), len(_CLASSES)))
    for i in range(len(_CLASSES)):
        total = np.concatenate([[0], np.cumsum(kinds == i)])
        counts[:, i] = total[ends] - total[ends - size]
    words, different, again, capital = np.array(fresh, float).reshape(-1, 4).T
    some = np.maximum(words, 1)
    features = np.column_stack(
        [
            np.ones(len(lines)),
            np.minimum(4 * counts / np.maximum(size, 1)[:, None], 2),
            np.log1p(size) / 8,
            np.minimum(size / some, 20) / 10,
            different / some,
            again,
            capital / some,
            np.minimum(counts[:, 3] + counts[:, 4], 2 * some) / some,
            size == 0,
        ]
    )
    return features, size, np.array(per_text, np.int64)


def with_neighbours(features: np.ndarray, per_text: np.ndarray) -> np.ndarray:
    """Append the features of the line before and the line behind; zeros at a text's ends."""
    first = np.cumsum(per_text) - per_text
    before, behind = np.zeros_like(features), np.zeros_like(features)
    before[1:] = features[:-1]
    before[first] = 0
    behind[:-1] = features[1:]
    behind[first[1:] - 1] = 0
    return np.hstack([features, before, behind])


def marginals(evidence: np.ndarray, per_text: np.ndarray, transition: np.ndarray) -> tuple[np.ndarray, np.ndarray, float]:
    """Marginals of label 1 per line, pair marginals summed over neighbours (2 x 2), and the log partition's sum.

    evidence is the score of label 1 over label 0 for each line. All texts move forward, then backward, together.
    """
    order = np.argsort(-per_text, kind="stable")
    size = per_text[order]
    first = (np.cumsum(per_text) - per_text)[order]
    steps = int(size.max()) if len(size) else 0
    active = np.searchsorted(-size, -np.arange(steps), side="left")
    own = np.column_stack([np.zeros(len(evidence)), evidence])
    forward, backward = np.zeros((len(evidence), 2)), np.zeros((len(evidence), 2))
    t00, t01, t10, t11 = transition.ravel()
    for t, k in enumerate(active.tolist()):
        at = first[:k] + t
        if not t:
            forward[at] = own[at]
            continue
        f = forward[at - 1]
        forward[at, 0] = np.logaddexp(f[:, 0] + t00, f[:, 1] + t10)
        forward[at, 1] = np.logaddexp(f[:, 0] + t01, f[:, 1] + t11) + own[at, 1]
    for t in range(steps - 2, -1, -1):
        at = first[: active[t + 1]] + t
        b = backward[at + 1] + own[at + 1]
        backward[at, 0] = np.logaddexp(b[:, 0] + t00, b[:, 1] + t01)
        backward[at, 1] = np.logaddexp(b[:, 0] + t10, b[:, 1] + t11)
    both = forward + backward
    whole = np.logaddexp(both[:, 0], both[:, 1])
    good = np.exp(both[:, 1] - whole)
    inner = np.ones(len(evidence), bool)
    inner[(np.cumsum(per_text) - 1)[per_text > 0]] = False  # lines with a next one
    i = np.flatnonzero(inner)
    pair = forward[i][:, :, None] + transition[None] + (own + backward)[i + 1][:, None, :] - whole[i][:, None, None]
    return good, np.exp(pair).sum(axis=0), float(whole[np.cumsum(per_text)[per_text > 0] - 1].sum())


def fit(texts: list[bytes | None], labels: np.ndarray, rounds: int = 250, penalty: float = 2.0) -> dict:
    """Weights and transitions by gradient ascent with moments; a document's lines share its weight."""
    if not len(texts):
        return {"weights": np.zeros(3 * FEATURES), "transition": np.zeros((2, 2)), "mean": np.zeros(3 * FEATURES), "scale": np.ones(3 * FEATURES)}
    features, _, per_text = line_features(texts)
    x = with_neighbours(features, per_text)
    mean, scale = x.mean(axis=0), np.maximum(x.std(axis=0), 1e-3)
    mean[0], scale[0] = 0, 1
    x = (x - mean) / scale
    y = np.repeat(labels.astype(float), per_text)
    ends = np.cumsum(per_text) - 1
    inner = np.ones(len(y), bool)
    inner[ends] = False
    seen = np.array([[np.sum(inner & (y == 0)), 0], [0, np.sum(inner & (y == 1))]], float)
    theta = np.zeros(x.shape[1] + 4)
    m, v = np.zeros_like(theta), np.zeros_like(theta)
    for r in range(1, rounds + 1):
        w, t = theta[:-4], theta[-4:].reshape(2, 2)
        good, pairs, _ = marginals(x @ w, per_text, t)
        gradient = np.concatenate([x.T @ (y - good), (seen - pairs).ravel()]) - penalty * theta
        gradient /= len(y)
        m, v = 0.9 * m + 0.1 * gradient, 0.99 * v + 0.01 * gradient**2
        theta += 0.1 * (m / (1 - 0.9**r)) / (np.sqrt(v / (1 - 0.99**r)) + 1e-8)
    return {"weights": theta[:-4], "transition": theta[-4:].reshape(2, 2), "mean": mean, "scale": scale}


def score_texts(texts: list[bytes | None], model: dict) -> np.ndarray:
    features, size, per_text = line_features(texts)
    x = (with_neighbours(features, per_text) - model["mean"]) / model["scale"]
    good, _, _ = marginals(x @ model["weights"], per_text, model["transition"])
    weight = np.maximum(size, 1).astype(float)
    owner = np.repeat(np.arange(len(per_text)), per_text)
    return np.bincount(owner, good * weight, len(per_text)) / np.bincount(owner, weight, len(per_text))


def _long_evidence(text: bytes, model: dict) -> tuple[np.ndarray, np.ndarray]:
    """Evidence and length of every line of a long text, from blocks of its lines."""
    lines = text.count(b"\n") + 1
    scaled = model["weights"] / model["scale"]
    own, before, behind = scaled.reshape(3, FEATURES)
    evidence, size = np.full(lines, -float(model["mean"] @ scaled)), np.zeros(lines, np.int32)
    at, n, seen = 0, 0, set()
    while n < lines:
        end = text.find(b"\n", min(at + _BLOCK, len(text)))
        end = len(text) if end < 0 else end
        features, sizes, (m,) = line_features([text[at:end]], seen)
        evidence[n : n + m] += features @ own
        evidence[n + 1 : n + m + 1] += (features @ before)[: lines - n - 1]
        evidence[max(n - 1, 0) : n + m - 1] += (features @ behind)[0 if n else 1 :]
        size[n : n + m] = sizes
        at, n = end + 1, n + m
    return evidence, size


def _long_score(text: bytes, model: dict) -> float:
    """The score of one text by messages in log-odds, line by line."""
    evidence, size = _long_evidence(text, model)
    (t00, t01), (t10, t11) = model["transition"].tolist()

    def carried(x: float, a0: float, a1: float, b0: float, b1: float) -> float:  # log((e^b0 + e^(b1+x)) / (e^a0 + e^(a1+x)))
        p, q, u, v = b0, b1 + x, a0, a1 + x
        return max(p, q) + log1p(exp(-abs(p - q))) - max(u, v) - log1p(exp(-abs(u - v)))

    forward, x = np.zeros(len(evidence)), None
    for i, e in enumerate(evidence):
        x = float(e) if x is None else float(e) + carried(x, t00, t10, t01, t11)
        forward[i] = x
    total = weight = x = 0.0
    for i in range(len(evidence) - 1, -1, -1):
        w = max(int(size[i]), 1)
        total += w / (1 + exp(-max(-700.0, min(700.0, forward[i] + x))))
        weight += w
        x = carried(float(evidence[i]) + x, t00, t01, t10, t11)
    return total / weight


def score_batch(texts: list[bytes | None], model: dict) -> np.ndarray:
    """The scores of texts; those of many lines by themselves, the others side by side, few lines at a time."""
    score, held, lines = np.zeros(len(texts)), [], 0
    for i, text in enumerate([*texts, None]):
        n = text.count(b"\n") + 1 if text else 1
        if i == len(texts) or lines + n > 4 * LONG:
            if held:
                score[held] = score_texts([texts[j] for j in held], model)
            held, lines = [], 0
        if i < len(texts):
            if n > LONG:
                score[i] = _long_score(text, model)
            else:
                held.append(i)
                lines += n
    return score


def sample_labelled(documents: DataFrame, labels: DataFrame, rows: int = 3000, row_bytes: int = 200_000) -> tuple[list[bytes], np.ndarray]:
    """Whole texts and labels of at most `rows` documents that may be learnt from, chosen by a hash.

    Rows of more than `row_bytes` bytes are not learnt from; they are scored as all others.
    """
    usable = labels.where("quality is not null and doc_id is not null").where(~common.held_out(F.col("doc_id")))
    share = 1.1 * rows / max(1, usable.count())
    draw = F.pmod(F.xxhash64(F.lit("quality"), "doc_id"), F.lit(1 << 40)) / F.lit(float(1 << 40))
    some = usable.where(draw < share).groupBy(F.col("doc_id").alias("l")).agg(F.min("quality").alias("quality"))
    text = F.col("text").cast("string").cast("binary")
    found = documents.join(F.broadcast(some), F.col("doc_id") == F.col("l")).where(text.isNotNull() & (F.octet_length(text) <= row_bytes))
    found = found.select("doc_id", text.alias("text"), "quality", F.xxhash64(F.lit("row"), "doc_id", text).alias("draw")).orderBy("draw").limit(rows)
    got = sorted(((r["doc_id"], bytes(r["text"]), r["quality"]) for r in found.collect()))
    return [t for _, t, _ in got], np.array([q for _, _, q in got])


def classify(documents: DataFrame, model: dict, threshold: float = 0.3) -> DataFrame:
    """doc_id, held_out, score and predicted for every row, from its whole text alone."""
    shared = documents.sparkSession.sparkContext.broadcast(model)  # a few hundred numbers

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in common.slices(batches, size=3 << 20):
            score = np.clip(score_batch(batch.column("text").to_pylist(), shared.value), 0, 1)
            predicted = (score >= threshold).astype(np.int32)
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("held_out"), pa.array(score), pa.array(predicted)], ["doc_id", "held_out", "score", "predicted"]
            )

    text = F.col("text").cast("string").cast("binary").alias("text")
    return documents.select(F.col("doc_id").cast("long"), common.held_out(F.col("doc_id")).alias("held_out"), text).mapInArrow(run, _RESULT)


def op6_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality of every row of `documents`, learnt from `labels.quality` of the rows that are not held out."""
    documents = common.table(spark, sf_dir, "documents")
    return classify(documents, fit(*sample_labelled(documents, common.table(spark, sf_dir, "labels"))))


QUERIES = {"op6_quality": op6_quality}
SQL: dict[str, str] = {}
