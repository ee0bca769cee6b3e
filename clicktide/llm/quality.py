"""Quality classifier by co-training on two views of a document.

The text-content view sees words, letters and repetition; the page-metadata view
sees language, source and layout (sizes and lines). Each view has its own logistic
regression. Over some rounds each labels the unlabelled documents of which it is
sure, for the other to learn from. Both are then calibrated on labelled documents
that neither has learned from, and a logistic regression combines them.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clicktide.llm.common import batches, fold_of, learning_sample, ready, text_of

# Bounds of what is learned from; scoring has none.
LABELLED = 20_000
UNLABELLED = 20_000
ROUNDS = 4
# How sure a view must be of a pseudo-label, and the share of the pool it may hand over in a round.
SURE = 0.97
HANDED = 0.1
BINS = 12
BUCKETS = 32

WORD = re.compile(r"\S+")
UPPER = re.compile(r"[A-ZÀ-ÖØ-Þ]")
SYMBOL = re.compile(r"[#$%&*@^~=+|<>{}\[\]\\_]")
MARK = re.compile(r"[!?]")
CONTENT = (
    "mean_word", "upper", "symbol", "symbol_words", "marks", "digits", "distinct", "top_word", "same_as_last", "short_words", "long_words",
)
LAYOUT = ("chars", "lines", "mean_line", "same_lines", "short_lines", "bytes_per_char")


def content_view(text: str) -> list[float]:
    """Numbers about words and letters of the whole text."""
    words = WORD.findall(text)
    n, letters = max(1, len(words)), max(1, len(text))
    counts = Counter(words)
    lengths = [len(w) for w in words]
    return [
        sum(lengths) / n,
        len(UPPER.findall(text)) / letters,
        len(SYMBOL.findall(text)) / letters,
        sum(times for w, times in counts.items() if SYMBOL.search(w)) / n,
        len(MARK.findall(text)) / letters,
        sum(map(text.count, "0123456789")) / letters,
        len(counts) / n**0.9,  # longer texts repeat more words
        max(counts.values(), default=0) / n,
        sum(a == b for a, b in zip(words, words[1:], strict=False)) / n,
        sum(x <= 2 for x in lengths) / n,
        sum(x >= 15 for x in lengths) / n,
    ]


def layout_view(text: str, n_chars: int | None) -> list[float]:
    """Numbers about size and lines."""
    lines = text.split("\n")
    size = max(1, len(text))
    return [
        float(np.log1p(len(text) if n_chars is None or n_chars < 0 else n_chars)),
        float(np.log1p(len(lines))),
        size / len(lines),
        1 - len(set(lines)) / len(lines),
        sum(len(x) < 30 for x in lines) / len(lines),
        len(text.encode("utf-8", "surrogatepass")) / size,
    ]


def _bucket(kind: str, value: str | None) -> int:
    return zlib.crc32(f"{kind}={value}".encode()) % BUCKETS


def views(text: str, lang: str | None, source: str | None, n_chars: int | None) -> list[float]:
    """Both views as numbers: content, layout, then the buckets of language and source."""
    return [*content_view(text), *layout_view(text, n_chars), float(_bucket("lang", lang)), float(_bucket("source", source))]


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


def logistic(x: np.ndarray, y: np.ndarray, ridge: float = 1.0) -> np.ndarray:
    """Coefficients of a ridge logistic regression, by Newton steps; the last column is the constant."""
    beta = np.zeros(x.shape[1])
    penalty = np.full(x.shape[1], ridge)
    penalty[-1] = 1e-3
    for _ in range(12):
        p = _sigmoid(x @ beta)
        step = np.linalg.solve((x * (p * (1 - p))[:, None]).T @ x + np.diag(penalty), x.T @ (y - p) - penalty * beta)
        beta += step
        if np.abs(step).max() < 1e-6:
            break
    return beta


@dataclass
class Encoder:
    """Numbers cut into bins at quantiles, buckets as they are, one indicator each."""

    edges: list[np.ndarray]

    @classmethod
    def of(cls, rows: np.ndarray) -> Encoder:
        cuts = np.linspace(0, 1, BINS + 1)[1:-1]
        return cls([np.unique(np.quantile(rows[:, k], cuts)) for k in range(len(CONTENT) + len(LAYOUT))])

    def __call__(self, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Content and metadata indicators."""
        numbers = [np.searchsorted(e, rows[:, k], side="right") for k, e in enumerate(self.edges)]
        content = [np.eye(BINS + 1)[c] for c in numbers[: len(CONTENT)]]
        layout = [np.eye(BINS + 1)[c] for c in numbers[len(CONTENT) :]]
        named = [np.eye(BUCKETS)[rows[:, k].astype(int)] for k in (-2, -1)]
        one = np.ones((len(rows), 1))
        return np.hstack([*content, one]), np.hstack([*layout, *named, one])


@dataclass
class Model:
    encoder: Encoder | None
    views: list[np.ndarray]
    calibration: list[np.ndarray]
    blend: np.ndarray
    share: float  # of good documents, for want of anything to learn from

    def score(self, rows: np.ndarray) -> np.ndarray:
        """Probability of good quality."""
        if self.encoder is None:
            return np.full(len(rows), self.share)
        x = self.encoder(rows)
        each = [np.c_[a @ b, np.ones(len(rows))] @ c for a, b, c in zip(x, self.views, self.calibration, strict=True)]
        return _sigmoid(np.c_[each[0], each[1], np.ones(len(rows))] @ self.blend)


def co_train(labelled: np.ndarray, y: np.ndarray, pool: np.ndarray, rounds: int = ROUNDS) -> Model:
    """Two views teach each other on ``pool``; every fifth labelled row is kept for calibration."""
    if len(y) < 10 or len(np.unique(y)) < 2:
        return Model(None, [], [], np.zeros(3), float(y.mean()) if len(y) else 1.0)
    encoder = Encoder.of(np.vstack([labelled, pool]))
    kept = np.arange(len(y)) % 5 == 0
    if len(np.unique(y[kept])) < 2 or len(np.unique(y[~kept])) < 2:
        kept = np.zeros(len(y), bool)
    check = kept if kept.any() else ~kept
    own, more = encoder(labelled), encoder(pool)
    # Per view: rows of the pool it was taught, and their labels.
    taught = [(np.zeros(0, int), np.zeros(0)) for _ in own]
    betas: list[np.ndarray] = []
    for turn in range(rounds + 1):
        betas = [
            logistic(np.vstack([x[~kept], u[rows]]), np.r_[y[~kept], guess])
            for x, u, (rows, guess) in zip(own, more, taught, strict=True)
        ]
        if turn == rounds or not len(pool):
            break
        for k, other in ((0, 1), (1, 0)):
            p = _sigmoid(more[k] @ betas[k])
            p[taught[other][0]] = 0.5  # already taught
            for label, sure in ((1.0, p), (0.0, 1 - p)):
                # As many of each class as the labels hold, the surest first.
                quota = int(np.ceil(HANDED * len(pool) * np.mean(y == label)))
                picked = np.argsort(-sure, kind="stable")[:quota]
                picked = picked[sure[picked] >= SURE]
                rows, guess = taught[other]
                taught[other] = np.r_[rows, picked], np.r_[guess, np.full(len(picked), label)]
    one = np.ones((int(check.sum()), 1))
    calibration = [logistic(np.c_[x[check] @ b, one], y[check], 0.1) for x, b in zip(own, betas, strict=True)]
    each = [np.c_[x[check] @ b, one] @ c for x, b, c in zip(own, betas, calibration, strict=True)]
    blend = logistic(np.c_[each[0], each[1], one], y[check], 0.1)
    return Model(encoder, betas, calibration, blend, float(y.mean()))


def _rows(docs: DataFrame, chosen: DataFrame) -> list:
    """Views of the chosen ids; ``chosen`` is bounded by a parameter of ``fit``."""
    schema = pa.schema([("doc_id", pa.int64()), ("y", pa.int32()), ("x", pa.list_(pa.float64()))])

    def look(parts: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        for part in parts:
            inputs = (part.column(c).to_pylist() for c in ("text", "lang", "source", "n_chars"))
            yield {"doc_id": part.column("doc_id"), "y": part.column("y"), "x": [views(*r) for r in zip(*inputs, strict=True)]}

    joined = docs.select(F.col("doc_id").cast("long").alias("doc_id"), *inputs_of()).join(F.broadcast(chosen), "doc_id")
    found = joined.mapInArrow(lambda parts: batches(look(parts), schema), "doc_id long, y int, x array<double>")
    return sorted(found.collect(), key=lambda r: (r["doc_id"], r["x"]))


def inputs_of() -> list[Column]:
    return [text_of().alias("text"), F.col("lang"), F.col("source"), F.col("n_chars").cast("long").alias("n_chars")]


def fit(docs: DataFrame, labels: DataFrame, labelled: int = LABELLED, unlabelled: int = UNLABELLED) -> Model:
    """Learn from at most ``labelled`` labelled documents outside fold 0 and as many unlabelled ones as ``unlabelled``.

    Both samples are taken in hash order of the ids; about 20 numbers per document reach the driver.
    """
    ready(docs.sparkSession)
    learned = _rows(docs, learning_sample(labels, "quality", labelled))
    ids = docs.where("doc_id IS NOT NULL").select(F.col("doc_id").cast("long").alias("doc_id"))
    known = labels.select(F.col("doc_id").cast("long").alias("doc_id"))
    pool = ids.join(known, "doc_id", "left_anti").distinct().orderBy(F.xxhash64("doc_id"), "doc_id").limit(unlabelled)
    free = _rows(docs, pool.withColumn("y", F.lit(0)))
    width = len(CONTENT) + len(LAYOUT) + 2
    x = np.array([r["x"] for r in learned], dtype=np.float64).reshape(-1, width)
    u = np.array([r["x"] for r in free], dtype=np.float64).reshape(-1, width)
    return co_train(x, np.array([r["y"] for r in learned], dtype=np.float64), u)


def scorer(model: Model):
    """A column function of text, language, source and size: probability of good quality."""

    @F.pandas_udf("double")
    def score(parts: Iterator[tuple[pd.Series, pd.Series, pd.Series, pd.Series]]) -> Iterator[pd.Series]:
        for text, lang, source, n_chars in parts:
            sizes = [None if pd.isna(n) else int(n) for n in n_chars]
            rows = [views(*r) for r in zip(text, lang, source, sizes, strict=True)]
            yield pd.Series(model.score(np.array(rows).reshape(len(rows), -1)) if rows else [], dtype="float64")

    return score(*inputs_of())


def quality(docs: DataFrame, labels: DataFrame, labelled: int = LABELLED, unlabelled: int = UNLABELLED) -> DataFrame:
    """Quality of every document: ``doc_id, held_out, score, predicted``.

    Every input row gives one row, repeated rows and NULL ids (held out) too. NULL
    texts count as empty, NULL languages and sources as values of their own, a
    NULL size as the text's. Without labels of both classes the score is the share
    of good labels, 1 without any. Other columns are not looked at.
    """
    model = fit(docs, labels, labelled, unlabelled)
    found = docs.select("doc_id", (fold_of() == 0).alias("held_out"), scorer(model).alias("score"))
    return found.withColumn("predicted", (F.col("score") >= 0.5).cast("int"))


def keep_good(docs: DataFrame, labels: DataFrame, labelled: int = LABELLED, unlabelled: int = UNLABELLED) -> DataFrame:
    """The rows scored 0.5 or more, with all columns of ``docs``."""
    return docs.where(scorer(fit(docs, labels, labelled, unlabelled)) >= 0.5)
