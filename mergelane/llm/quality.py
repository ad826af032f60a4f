"""Quality classifier by co-training of two views: text content and page metadata.

Each view has a logistic regression of its own. Over rounds, each view labels the unlabelled rows it is
surest of, by its probabilities calibrated on held-out labels, for the other view to learn from. The
calibrated views are then combined by a regression on held-out labels, and score every document.

Blum and Mitchell, "Combining Labeled and Unlabeled Data with Co-Training", 1998.

Fitting works on a bounded sample of labelled and unlabelled rows on the driver; features are formed
and documents scored in the tasks, in one pass without a shuffle.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Labelled rows to fit on, and unlabelled rows to label, at most.
LABELLED_ROWS = 12_000
POOL_ROWS = 6_000
ROUNDS = 4
# A view labels a row for the other one at this calibrated confidence, at most so many rows of a class a round.
CONFIDENCE = 0.97
ROWS_A_ROUND = 500
# Documents below this probability of good quality are rejected.
THRESHOLD = 0.5

META_BUCKETS = 32
_DELETE_LETTERS = bytes(range(65, 91)) + bytes(range(97, 123)) + bytes(range(128, 256))
_UPPER = bytes(range(65, 91))
_DIGITS = bytes(range(48, 58))
_BLANKS = b" \t\n\r\x0b\x0c"
_SYMBOLS = bytes(b for b in range(33, 127) if not chr(b).isalnum())


def text_features(text: str) -> list[float]:
    """Shares that tell prose from junk, each from 0 to 1 or a logarithm; zeros for an empty text."""
    data = text.encode("utf-8", "replace")
    words = data.split()
    if not words:
        return [0.0] * TEXT_FEATURES
    n, chars = len(words), len(data)
    dense = len(data.translate(None, _BLANKS))
    symbols = len(data.translate(None, _DELETE_LETTERS + _DIGITS + _BLANKS))
    ascii_letters = chars - len(data.translate(None, bytes(range(65, 91)) + bytes(range(97, 123))))
    upper = chars - len(data.translate(None, _UPPER))
    digits = chars - len(data.translate(None, _DIGITS))
    distinct = set(words)
    again = sum(a == b for a, b in zip(words, words[1:]))
    no_letters = {w for w in distinct if not w.translate(None, _SYMBOLS)}
    bare = sum(w in no_letters for w in words) if no_letters else 0
    marked = sum(data.count(m) for m in (b"***", b"###", b"$$$", b"%%%", b"&&&", b"!!", b"||"))
    lines = data.split(b"\n")
    sentences = data.count(b". ") + data.count(b".\n") + data.count(b"? ") + data.count(b"! ") + data.endswith(b".")
    return [
        np.log1p(n),
        min(dense / n, 30) / 30,
        len(distinct) / n,
        again / n,
        min(1.0, symbols / dense),
        upper / max(1, ascii_letters),
        digits / dense,
        bare / n,
        min(1.0, marked / n),
        min(1.0, sentences / n),
        1 - len(set(lines)) / len(lines),
        np.log1p(max(map(len, lines))),
        float(again > 0.2 * n),
        float(upper > 0.5 * max(1, ascii_letters)),
        np.sqrt(again / n),
        np.sqrt(bare / n),
        np.sqrt(min(1.0, marked / n)),
    ]


TEXT_FEATURES = 17


def _bucket(name: str, value: str | None) -> int:
    return zlib.crc32(f"{name}={value}".encode()) % META_BUCKETS


def meta_features(lang: str | None, source: str | None, n_chars: float | None) -> list[float]:
    """Logarithm of the length, and hashed language, source and their pair; null is a value of its own."""
    out = [0.0] * (META_BUCKETS + 2)
    for name, value in (("lang", lang), ("source", source)):
        out[_bucket(name, value)] += 1.0
    known = n_chars is not None and np.isfinite(n_chars) and n_chars >= 0
    out[-2] = float(np.log1p(n_chars)) if known else 0.0
    out[-1] = float(known)
    return out


@dataclass(frozen=True)
class View:
    """A calibrated logistic regression: standardised features, weights, then slope and offset of the calibration."""

    mean: np.ndarray
    scale: np.ndarray
    weights: np.ndarray
    slope: float = 1.0
    offset: float = 0.0

    def raw(self, x: np.ndarray) -> np.ndarray:
        return np.clip((x - self.mean) / self.scale, -8, 8) @ self.weights[1:] + self.weights[0]

    def log_odds(self, x: np.ndarray) -> np.ndarray:
        return np.clip(self.slope * self.raw(x) + self.offset, -20, 20)


@dataclass(frozen=True)
class Model:
    text: View
    meta: View
    weights: np.ndarray  # of 1, and the log-odds of the two views

    def scores(self, text: np.ndarray, meta: np.ndarray) -> np.ndarray:
        """Probabilities of good quality: text view, metadata view, both; one row a document."""
        a, b = self.text.log_odds(text), self.meta.log_odds(meta)
        both = self.weights[0] + self.weights[1] * a + self.weights[2] * b
        return _sigmoid(np.stack([a, b, both], axis=1))


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


def logistic(x: np.ndarray, y: np.ndarray, ridge: float = 1.0, steps: int = 25) -> np.ndarray:
    """Weights (constant first) of a ridge logistic regression, by Newton steps; the constant is not shrunk."""
    design = np.column_stack([np.ones(len(x)), x])
    weights = np.zeros(design.shape[1])
    keep = np.full(design.shape[1], ridge)
    keep[0] = 1e-3
    for _ in range(steps):
        p = _sigmoid(design @ weights)
        gradient = design.T @ (p - y) + keep * weights
        curve = design.T @ (design * np.maximum(p * (1 - p), 1e-6)[:, None]) + np.diag(keep)
        step = np.linalg.solve(curve, gradient)
        weights -= step * min(1.0, 10 / max(1e-12, np.abs(step).max()))
        if np.abs(step).max() < 1e-8:
            break
    return weights


def _fit_view(x: np.ndarray, y: np.ndarray, held_x: np.ndarray, held_y: np.ndarray) -> View:
    mean, scale = x.mean(axis=0), x.std(axis=0)
    scale = np.where(scale < 1e-9, 1.0, scale)
    view = View(mean, scale, logistic(np.clip((x - mean) / scale, -8, 8), y))
    if len(set(held_y)) < 2:
        return view
    offset, slope = logistic(view.raw(held_x)[:, None], held_y)
    # A view that orders held-out rows wrongly says nothing but the share of good ones.
    return View(mean, scale, view.weights, max(0.0, slope), offset if slope > 0 else _odds(held_y))


def _odds(y: np.ndarray) -> float:
    p = (y.sum() + 1) / (len(y) + 2)
    return float(np.log(p / (1 - p)))


def co_train(text: np.ndarray, meta: np.ndarray, y: np.ndarray, pool_text: np.ndarray, pool_meta: np.ndarray, rounds: int = ROUNDS) -> Model:
    """Fit both views on labelled rows, let them label pool rows for each other, and combine them.

    Every fifth labelled row is held out for calibration and for the combination. Labels of one class
    only (or none) give a model that scores every document alike, by their share.
    """
    held = np.arange(len(y)) % 5 == 4
    views = [text, meta]
    pools = [pool_text, pool_meta]
    if len(set(y[~held])) < 2:
        share = _odds(y) if len(y) else 0.0
        flat = [View(np.zeros(x.shape[1]), np.ones(x.shape[1]), np.zeros(x.shape[1] + 1), 1.0, share) for x in views]
        return Model(*flat, np.array([share, 0.0, 0.0]))
    given = [np.full(len(pool_text), np.nan), np.full(len(pool_text), np.nan)]  # labels that each view received
    fitted: list[View] = []
    for _ in range(rounds + 1):
        fitted = []
        for x, pool, labels in zip(views, pools, given):
            known = ~np.isnan(labels)
            fitted.append(_fit_view(
                np.concatenate([x[~held], pool[known]]), np.concatenate([y[~held], labels[known]]), x[held], y[held],
            ))
        if not len(pool_text):
            break
        before = [np.count_nonzero(~np.isnan(g)) for g in given]
        for teacher, pool, labels in zip(fitted, pools, reversed(given)):
            p = _sigmoid(teacher.log_odds(pool))
            for label, sure in ((1.0, p), (0.0, 1 - p)):
                open_ = np.flatnonzero(np.isnan(labels) & (sure >= CONFIDENCE))
                labels[open_[np.argsort(-sure[open_], kind="stable")[:ROWS_A_ROUND]]] = label
        if before == [np.count_nonzero(~np.isnan(g)) for g in given]:
            break
    odds = np.stack([v.log_odds(x[held]) for v, x in zip(fitted, views)], axis=1)
    if len(set(y[held])) < 2:
        return Model(*fitted, np.array([0.0, 1.0, 0.0]))
    weights = logistic(odds, y[held])
    # Views may count for nothing, never against themselves.
    return Model(*fitted, np.array([weights[0], max(0.0, weights[1]), max(0.0, weights[2])]))


def _features(frame: pd.DataFrame) -> tuple[np.ndarray, np.ndarray]:
    text = np.array([text_features(t or "") for t in frame["text"]]).reshape(len(frame), TEXT_FEATURES)
    rows = zip(frame["lang"], frame["source"], frame["n_chars"].astype(object))
    clean = [(_none(a), _none(b), None if pd.isna(n) else float(n)) for a, b, n in rows]
    return text, np.array([meta_features(*r) for r in clean]).reshape(len(frame), META_BUCKETS + 2)


def _none(value: object) -> str | None:
    return None if value is None or value != value else str(value)


def _inputs(docs: DataFrame) -> list[Column]:
    """text, lang, source and n_chars; columns that `docs` lacks are null."""
    kinds = {"text": "string", "lang": "string", "source": "string", "n_chars": "double"}
    return [(docs[c] if c in docs.columns else F.lit(None)).cast(k).alias(c) for c, k in kinds.items()]


def fit(docs: DataFrame, labels: DataFrame, label_col: str = "quality", labelled_rows: int = LABELLED_ROWS, pool_rows: int = POOL_ROWS) -> Model:
    """A model from documents (doc_id, text, lang, source, n_chars) and labels (doc_id, `label_col` 0 or 1).

    At most `labelled_rows` labelled documents (the first by a hash of the id) are used, and about as
    many others as `pool_rows`, by a hash of id and text; no more than twice as many if rows are repeated. Null
    labels and ids go; labels that contradict each other go by their mean, halves to good.
    """
    known = (
        labels.select(F.col("doc_id").alias("__id"), F.col(label_col).cast("double").alias("__label"))
        .dropna().groupBy("__id").agg((F.avg("__label") >= 0.5).cast("double").alias("__label"))
        .orderBy(F.xxhash64("__id"), "__id").limit(labelled_rows)
    )
    n = docs.count()
    share = min(1.0, pool_rows / max(1, n))
    lot = F.pmod(F.xxhash64(F.lit("pool"), docs["doc_id"], docs["text"]), F.lit(1 << 30))
    # `known` has at most `labelled_rows` rows of two numbers, so it may be broadcast.
    chosen = (
        docs.select(docs["doc_id"].alias("__doc"), lot.alias("__lot"), *_inputs(docs))
        .join(F.broadcast(known), F.col("__doc") == F.col("__id"), "left")
        .filter(F.col("__label").isNotNull() | (F.col("__lot") < int(share * (1 << 30))))
        .select(F.col("__doc").alias("id"), F.col("__label").alias("label"), "text", "lang", "source", "n_chars")
    )
    width = TEXT_FEATURES + META_BUCKETS + 2

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            text, meta = _features(frame)
            yield pd.DataFrame({"id": frame["id"], "label": frame["label"], "x": list(np.hstack([text, meta]))})

    sample = chosen.mapInPandas(run, "id long, label double, x array<double>").limit(2 * (labelled_rows + pool_rows))
    # Python objects are heavy, so the features come as Arrow columns; sorted, as rows arrive in any order.
    table = sample.toArrow().combine_chunks()
    x = np.array(table["x"].combine_chunks().flatten()).reshape(-1, width) if table.num_rows else np.zeros((0, width))
    label = table["label"].to_numpy() if table.num_rows else np.zeros(0)
    ids = np.nan_to_num(table["id"].to_pandas().to_numpy(dtype=np.float64)) if table.num_rows else np.zeros(0)
    order = np.lexsort((*x[:, :4].T, ids))
    x, label = x[order], label[order].astype(np.float64)
    has = ~np.isnan(label)
    # Held-out rows are every fifth: in an order that says nothing about them.
    mixed = np.random.default_rng(7).permutation(int(has.sum()))
    with_label = x[has][mixed]
    cut = TEXT_FEATURES
    return co_train(with_label[:, :cut], with_label[:, cut:], label[has][mixed], x[~has][:, :cut], x[~has][:, cut:])


def scored(docs: DataFrame, model: Model, out: str = "quality_scores") -> DataFrame:
    """`docs` with `out`, an array: the probability of good quality by text, by metadata, and by both.

    Null texts are empty; other nulls are values of their own. Rows and columns stay as they are.
    """

    @F.pandas_udf("array<double>")
    def score(text: pd.Series, lang: pd.Series, source: pd.Series, n_chars: pd.Series) -> pd.Series:
        frame = pd.DataFrame({"text": text, "lang": lang, "source": source, "n_chars": n_chars})
        return pd.Series(list(model.scores(*_features(frame)))) if len(frame) else pd.Series([], dtype=object)

    return docs.withColumn(out, score(*_inputs(docs)))


def classify(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """Per row: doc_id, text_score, meta_score, score and good (1 if the score reaches `threshold`).

    Without labels, or with labels of one class only, all documents score alike. An empty table gives an empty one.
    """
    all_scores = scored(docs, fit(docs, labels))
    return all_scores.select(
        docs["doc_id"], *[F.col("quality_scores")[i].alias(c) for i, c in enumerate(("text_score", "meta_score", "score"))],
        (F.col("quality_scores")[2] >= threshold).cast("int").alias("good"),
    )
