"""Toxic passages: maximum-scoring segments of token log-odds, calibrated by extreme values.

Tokens are lower-cased runs of letters.  From labelled training texts each token gets the log-odds
of a toxic text that holds it against the base rate, with a Dirichlet prior centred on its prefix:
a word leans on its first five letters, those on its first four, those on the base rate, so
inflected and compound forms share evidence.  A constant drift makes the expected score of
harmless text negative.

A linear-time scan finds all maximal scoring segments (disjoint runs of tokens that cannot be
extended or cut to score more).  For harmless text, segment scores follow the extreme-value law
P(best >= s) = 1 - exp(-K n exp(-lambda s)): lambda solves E[exp(lambda s)] = 1 over harmless tokens, K is
fitted to harmless texts' best scores.  A segment is significant if its expected number of chance
equals in its text is at most ``MAX_EXPECTED``.  A text's score is a logistic function, fitted on
training texts kept apart from the token counts, of the best segment's and of all significant
segments' calibrated scores.

Everything is fitted on at most ``FIT_ROWS`` labelled rows (smallest id hash, a documented bound);
labels, lang, source and doc_id are no inputs.  Defined results: null, empty and letterless texts
have no segment and get the score of a text without one; long texts are scanned whole; repeated rows and ties are
scored each; with labels
of one class only every score is that class's constant; an empty table gives no rows; other
columns are kept untouched by ``with_segments``.
"""

from __future__ import annotations

import itertools
import math
import re
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import ship_package, written
from .quality import labelled
from .token_files import _slices

FIT_ROWS = 20_000
PRIOR = 4.0
DRIFT = 1.0
MIN_TEXTS = 3
MAX_EXPECTED = 0.05
PREFIXES = (4, 5)
CACHE = 400_000
WORD = re.compile(r"[^\W\d_]+")
SEGMENT = "array<struct<start:int,end:int,score:double,expected:double>>"


def ladder(word: str) -> list[str]:
    """Keys of a word from general to special; ``~`` marks a prefix."""
    return [f"{word[:k]}~" for k in PREFIXES if len(word) > k] + [word]


def maximal_segments(scores: list[float]) -> list[tuple[int, int, float]]:
    """All maximal scoring segments (start, end, score) in linear time."""
    # each candidate: start, end, sum before it, sum up to its end
    found: list[tuple[int, int, float, float]] = []
    # for each candidate, the nearest earlier one with a smaller sum before it (-1: none)
    link: list[int] = []
    total = 0.0
    for i, s in enumerate(scores):
        before, total = total, total + s
        if s <= 0:
            continue
        start, low, high = i, before, total
        j = len(found) - 1
        while True:
            while j >= 0 and found[j][2] >= low:
                j = link[j]
            if j < 0 or found[j][3] >= high:
                break
            start, low = found[j][0], found[j][2]
            del found[j:], link[j:]
            j = len(found) - 1
        found.append((start, i + 1, low, high))
        link.append(j)
    return [(a, b, high - low) for a, b, low, high in found]


def runs(scores: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and sums of the alternating runs of positive and other scores."""
    sign = scores > 0
    starts = np.flatnonzero(np.concatenate([[True], sign[1:] != sign[:-1]]))
    return starts, np.add.reduceat(scores, starts)


@dataclass
class ToxicityModel:
    scores: dict[str, float]  # word or prefix key -> score, drift taken off
    default: float
    decay: float  # lambda
    size: float  # K
    weights: tuple[float, float, float]  # bias, best segment, all significant segments
    cache: dict[str, float] = field(default_factory=dict, repr=False, compare=False)

    def of_word(self, word: str) -> float:
        got = self.cache.get(word)
        if got is None:
            if len(self.cache) >= CACHE:
                self.cache.clear()
            got = next((self.scores[k] for k in reversed(ladder(word)) if k in self.scores), self.default)
            self.cache[word] = got
        return got

    def segments(self, text: str) -> tuple[list[tuple[int, int, float, float]], int]:
        """Maximal segments (first word, end word, score, expected number by chance) and the word count."""
        words = WORD.findall(text.lower())
        if not words:
            return [], 0
        scores = np.fromiter(map(self.of_word, words), dtype=np.float64, count=len(words))
        if scores.max() <= 0:
            return [], len(words)
        starts, sums = runs(scores)
        ends = np.append(starts[1:], len(words))
        n = len(words)
        return [(int(starts[a]), int(ends[b - 1]), s, self.size * n * math.exp(-self.decay * s))
                for a, b, s in maximal_segments(sums.tolist())], n

    def evidence(self, segments: list[tuple[int, int, float, float]]) -> tuple[float, float]:
        """-log of the best segment's chance (extreme-value law), and the sum of -log expected over significant ones."""
        if not segments:
            return 0.0, 0.0
        least = min(s[3] for s in segments)
        best = -math.log(max(-math.expm1(-least), 1e-300))
        return best, sum(-math.log(max(s[3], 1e-300)) for s in segments if s[3] <= MAX_EXPECTED)

    def probability(self, segments: list[tuple[int, int, float, float]]) -> float:
        bias, w_best, w_all = self.weights
        best, all_ = self.evidence(segments)
        z = bias + w_best * math.log1p(best) + w_all * math.log1p(all_)
        return 1 / (1 + math.exp(-max(-500.0, min(500.0, z))))


def decay_rate(scores: np.ndarray, counts: np.ndarray) -> float:
    """The positive root of E[exp(lambda s)] = 1 (the mean score is negative)."""
    p = counts / counts.sum()
    if scores.max() <= 0 or (p * scores).sum() >= 0:
        return 1.0
    low, high = 0.0, 1.0
    while (p * np.exp(high * scores)).sum() < 1:
        low, high = high, high * 2
    for _ in range(60):
        mid = (low + high) / 2
        if (p * np.exp(mid * scores)).sum() < 1:
            low = mid
        else:
            high = mid
    return high


def logistic(x: np.ndarray, y: np.ndarray, ridge: float = 1e-2, steps: int = 40) -> np.ndarray:
    """Ridge logistic regression by Newton steps, classes weighted equally."""
    weight = np.where(y == 1, len(y) / 2 / max(1, y.sum()), len(y) / 2 / max(1, (1 - y).sum()))
    beta = np.zeros(x.shape[1])
    for _ in range(steps):
        p = 1 / (1 + np.exp(-np.clip(x @ beta, -30, 30)))
        gradient = x.T @ (weight * (y - p)) - ridge * beta
        hessian = (x * (weight * p * (1 - p))[:, None]).T @ x + ridge * np.eye(len(beta))
        step = np.linalg.solve(hessian, gradient)
        beta += step
        if np.abs(step).max() < 1e-9:
            break
    return beta


def _word_counts(texts: DataFrame) -> DataFrame:
    """key, n, toxic: training texts that hold each word or prefix, counted once per text."""

    def keys(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for rows in _slices(batch, 0):
                words, ys = [], []
                for text, y in zip(rows.column(0).to_pylist(), rows.column(1).to_pylist(), strict=True):
                    own = {k for w in set(WORD.findall(text.lower())) for k in ladder(w)}
                    words += own
                    ys += [y] * len(own)
                yield pa.RecordBatch.from_arrays([pa.array(words, pa.string()), pa.array(ys, pa.int64())], ["key", "y"])

    return (texts.select("text", "y").mapInArrow(keys, "key string, y long")
            .groupBy("key").agg(F.count(F.lit(1)).alias("n"), F.sum("y").alias("toxic"))
            .where(F.col("n") >= MIN_TEXTS))


def token_scores(counts: list[tuple[str, int, int]], base: float) -> dict[str, float]:
    """Log-odds against the base rate; each key's Dirichlet prior is centred on the key before it."""
    seen = {k: (n, t) for k, n, t in counts}
    rate: dict[str, float] = {}
    for key in sorted(seen, key=lambda k: (not k.endswith("~"), len(k))):
        steps = [key] if key.endswith("~") else ladder(key)
        above = ([f"{key[:k]}~" for k in PREFIXES if k < len(key) - 1] if key.endswith("~") else steps[:-1])
        centre = next((rate[a] for a in reversed(above) if a in rate), base)
        n, t = seen[key]
        rate[key] = (t + PRIOR * centre) / (n + PRIOR)
    logit = math.log(base / (1 - base))
    return {k: math.log(r / (1 - r)) - logit - DRIFT for k, r in rate.items()}


def fit(docs: DataFrame, labels: DataFrame, label: str = "toxic", fold_of: int = 3, held_out: int = 1,
        rows: int = FIT_ROWS) -> ToxicityModel:
    ship_package(docs.sparkSession)
    sample = written(labelled(docs, labels, label, fold_of, held_out, rows)
                     .withColumn("part", F.pmod(F.xxhash64("text", F.lit(1)), F.lit(4))), "toxicity-fit")
    counted = sample.where("part > 0")
    n, toxic = counted.agg(F.count(F.lit(1)), F.coalesce(F.sum("y"), F.lit(0))).first()
    if toxic == 0 or toxic == n:
        return ToxicityModel({}, -DRIFT, 1.0, 1.0, (20.0 if toxic else -20.0, 0.0, 0.0))
    # words of at most FIT_ROWS texts
    pdf = _word_counts(counted).toPandas()
    scores = token_scores(list(zip(pdf["key"], pdf["n"], pdf["toxic"], strict=True)), toxic / n)
    model = ToxicityModel(scores, -DRIFT, 1.0, 1.0, (0.0, 0.0, 0.0))

    def harmless(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: dict[float, int] = {}
        for batch in batches:
            for text in batch.column(0).to_pylist():
                for word in WORD.findall(text.lower()):
                    s = round(model.of_word(word), 2)
                    total[s] = total.get(s, 0) + 1
        yield pa.RecordBatch.from_arrays([pa.array(list(total), pa.float64()), pa.array(list(total.values()), pa.int64())],
                                         ["score", "n"])

    apart = sample.where("part = 0").select("text", "y")
    spread = (apart.where("y = 0").select("text").mapInArrow(harmless, "score double, n long")
              .groupBy("score").agg(F.sum("n").alias("n")).toPandas())  # scores in hundredths: a bounded table
    if len(spread):
        model.decay = decay_rate(spread["score"].to_numpy(), spread["n"].to_numpy())

    def best(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for text, y in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                segments, n_words = model.segments(text)
                out.append((y, n_words, max((s[2] for s in segments), default=0.0), [s[2] for s in segments]))
            columns = list(zip(*out, strict=True)) or [(), (), (), ()]
            yield pa.RecordBatch.from_arrays([pa.array(columns[0], pa.int64()), pa.array(columns[1], pa.int64()),
                                              pa.array(columns[2], pa.float64()),
                                              pa.array(columns[3], pa.list_(pa.float64()))], ["y", "words", "best", "all"])

    # the scores of every maximal segment of at most FIT_ROWS / 4 texts (it grows with these texts' lengths)
    seen = apart.mapInArrow(best, "y long, words long, best double, all array<double>").toPandas()
    if len(seen) == 0 or seen["y"].nunique() < 2:
        model.weights = (math.log(toxic / (n - toxic)), 1.0, 1.0)
        return model
    calm = seen[(seen["y"] == 0) & (seen["words"] > 0)]
    # under the law, exp(-lambda best) * n * K has mean 1 over harmless texts (all their segments counted)
    chance = np.exp(-model.decay * calm["best"].to_numpy()) * calm["words"].to_numpy()
    model.size = float(1 / max(chance.mean(), 1e-9)) if len(calm) else 1.0
    x = np.ones((len(seen), 3))
    for i, (words, all_) in enumerate(zip(seen["words"], seen["all"], strict=True)):
        segments = [(0, 0, s, model.size * words * math.exp(-model.decay * s)) for s in all_]
        x[i, 1:] = np.log1p(model.evidence(segments))
    y = seen["y"].to_numpy(dtype=np.float64)
    weights = logistic(x, y)
    if (weights[1:] < 0).any():  # the two go together: more evidence must never lower a score
        weights = np.insert(logistic(x[:, [0, 2]], y), 1, 0.0)
    model.weights = tuple(weights.tolist())
    return model


def with_segments(docs: DataFrame, model: ToxicityModel, text: str = "text", into: str = "toxicity") -> DataFrame:
    """``docs`` with a column ``into``: struct of the score and all significant segments (word numbers)."""
    ship_package(docs.sparkSession)
    shipped = docs.sparkSession.sparkContext.broadcast(model)
    at = docs.columns.index(text)

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shipped.value
        kind = pa.struct([("score", pa.float64()), ("segments", pa.list_(pa.struct(
            [("start", pa.int32()), ("end", pa.int32()), ("score", pa.float64()), ("expected", pa.float64())])))])
        for batch in batches:
            for rows in _slices(batch, at):
                out = []
                for whole in rows.column(at).to_pylist():
                    segments, _ = model.segments(whole or "")
                    out.append({"score": model.probability(segments),
                                "segments": [dict(zip(("start", "end", "score", "expected"), s, strict=True))
                                             for s in segments if s[3] <= MAX_EXPECTED]})
                yield pa.RecordBatch.from_arrays([*rows.columns, pa.array(out, kind)], [*rows.schema.names, into])

    schema = T.StructType([*docs.schema.fields, T.StructField(into, T._parse_datatype_string(
        f"struct<score:double,segments:{SEGMENT}>"))])
    return docs.mapInArrow(scan, schema)
