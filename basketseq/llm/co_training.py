"""Quality scores by co-training on two views of a document.

The text view is the content: hashed byte trigrams of the whole text. The
metadata view is what a page says about itself and its layout: language, source,
lengths, lines, and shares of kinds of characters.

1. A bounded sample of labelled rows (``MAX_LABELLED``, by smallest hash) trains
   a logistic regression per view; a quarter of it is held out.
2. In each round both models look at all documents without a label. Where one
   is confident, its verdict is a pseudo-label for the other one: the tasks add
   up the gradient and curvature of each view over what the other view labelled,
   and each model takes a Newton step on them together with the true labels.
   Pseudo-labels weigh no more in all than the true ones.
3. Each view's score is calibrated (Platt) on the held-out rows, and a logistic
   regression on both calibrated scores gives the quality of every document.

What reaches the driver is the sample, and per round at most ``SLOTS`` sums of a
fixed size. Features are written once and read by each round.

Defined results: a null or empty text has a text view of zeros; a null language
or source is a value of its own; a null length is the text's. Labels that are
null or other than 0 and 1 don't count; several labels of a document count each.
With no label, or labels of one kind only, every document gets the share of good
labels (0.5 without any) as its score. Repeated rows get equal scores. Other
columns pass through, unless they are named like a result column.
"""

from __future__ import annotations

import math
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, functions as F

from basketseq.llm.scratch import Scratch
from basketseq.llm.words import mixed, utf8, word_hashes

MAX_LABELLED = 20_000
TEXT_BINS = 128
HASHED = 16
META_SIZE = 2 * HASHED + 12
ROUNDS = 3
CONFIDENT = 0.95
PENALTY = 1.0
SLOTS = 64
SCORES = "text_score double, meta_score double, score double, kept boolean"
VIEWS = ("text", "meta")


def text_view(raw: bytes) -> np.ndarray:
    """Square roots of trigram shares, in bins, as bytes of 0..255."""
    data = np.frombuffer(raw, dtype=np.uint8).astype(np.uint64)
    if len(data) < 3:
        return np.zeros(TEXT_BINS, dtype=np.uint8)
    grams = mixed(data[:-2] | data[1:-1] << np.uint64(8) | data[2:] << np.uint64(16))
    counts = np.bincount((grams % np.uint64(TEXT_BINS)).astype(np.int64), minlength=TEXT_BINS)
    return np.round(255 * np.sqrt(counts / counts.sum())).astype(np.uint8)


def meta_view(raw: bytes, lang: str | None, source: str | None, n_chars: float) -> np.ndarray:
    out = np.zeros(META_SIZE, dtype="<f4")
    for place, value in ((0, lang), (HASHED, source)):
        name = b"\0" if value is None else value.encode("utf-8", "replace")
        out[place + zlib.crc32(name) % HASHED] = 1
    data = np.frombuffer(raw, dtype=np.uint8)
    words = word_hashes(raw)
    lines = raw.split(b"\n")
    size, n = max(1, len(data)), max(1, len(words))
    kinds = np.bincount(data, minlength=256) / size
    out[2 * HASHED :] = (
        math.log1p(n_chars),
        math.log1p(len(words)),
        math.log1p(len(lines)),
        math.log1p(max(map(len, lines))),
        len(set(lines)) / len(lines),
        len(np.unique(words)) / n,
        len(data) / n / 10,
        kinds[65:91].sum(),
        kinds[48:58].sum(),
        kinds[128:].sum(),
        kinds[[33, 35, 36, 37, 38, 42, 60, 62, 64, 124]].sum(),
        kinds[[32, 9, 10]].sum(),
    )
    return out


def views(text: Column, lang: Column, source: Column, n_chars: Column) -> Column:
    @F.pandas_udf("text binary, meta binary")
    def both(
        batches: Iterator[tuple[pd.Series, pd.Series, pd.Series, pd.Series]],
    ) -> Iterator[pd.DataFrame]:
        for texts, langs, sources, lengths in batches:
            rows = []
            for t, l, s, n in zip(texts, langs, sources, lengths, strict=True):
                raw = utf8(t)
                meta = meta_view(raw, l, s, max(0.0, n))
                rows.append((text_view(raw).tobytes(), meta.tobytes()))
            yield pd.DataFrame(rows, columns=["text", "meta"])

    length = F.coalesce(n_chars, F.length(text), F.lit(0)).cast("double")
    return both(text, lang.cast("string"), source.cast("string"), length)


def matrix(column: pd.Series, view: str) -> np.ndarray:
    """Features with a leading one for the bias."""
    joined = b"".join(column)
    if view == "text":
        values = np.frombuffer(joined, dtype=np.uint8).reshape(-1, TEXT_BINS) / 255.0
    else:
        values = np.frombuffer(joined, dtype="<f4").reshape(-1, META_SIZE).astype(float)
    return np.hstack((np.ones((len(values), 1)), values))


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


def newton_sums(x: np.ndarray, y: np.ndarray, weights: np.ndarray) -> np.ndarray:
    """Count, gradient and curvature of the log-likelihood, as one flat array."""
    p = _sigmoid(x @ weights)
    curve = (x * (p * (1 - p) + 1e-6)[:, None]).T @ x
    return np.concatenate(([len(y)], x.T @ (y - p), curve.ravel()))


def newton_step(weights: np.ndarray, sums: np.ndarray) -> np.ndarray:
    n = len(weights)
    penalty = np.full(n, PENALTY)
    penalty[0] = 1e-6
    slope = sums[1 : n + 1] - penalty * weights
    return weights + np.linalg.solve(sums[n + 1 :].reshape(n, n) + np.diag(penalty), slope)


def logistic(x: np.ndarray, y: np.ndarray, steps: int = 8) -> np.ndarray:
    weights = np.zeros(x.shape[1])
    for _ in range(steps):
        weights = newton_step(weights, newton_sums(x, y, weights))
    return weights


class Models:
    """Both views' weights, their calibration, and how they are combined."""

    def __init__(self, prior: float):
        self.prior = prior
        self.weights: dict[str, np.ndarray] = {}
        self.platt: dict[str, np.ndarray] = {}
        self.combined: np.ndarray | None = None

    def raw(self, view: str, column: pd.Series) -> np.ndarray:
        return matrix(column, view) @ self.weights[view]

    def calibrated(self, view: str, column: pd.Series) -> np.ndarray:
        a, b = self.platt[view]
        return a + b * self.raw(view, column)

    def calibrate(self, held: pd.DataFrame, y: np.ndarray) -> None:
        for view in VIEWS:
            raw = self.raw(view, held[view])
            self.platt[view] = logistic(np.column_stack((np.ones(len(raw)), raw)), y)
        self.combined = logistic(self._inputs(held), y)

    def _inputs(self, rows: pd.DataFrame) -> np.ndarray:
        scores = [self.calibrated(view, rows[view]) for view in VIEWS]
        return np.column_stack((np.ones(len(rows)), *scores))

    def scores(self, rows: pd.DataFrame) -> np.ndarray:
        """Columns: text score, metadata score, score."""
        if self.combined is None:
            return np.full((len(rows), 3), self.prior)
        inputs = self._inputs(rows)
        return _sigmoid(np.column_stack((inputs[:, 1], inputs[:, 2], inputs @ self.combined)))


def exchanged_sums(features: DataFrame, models: Models) -> dict[str, np.ndarray]:
    """Newton sums of each view over what the other view is confident of."""
    size = {"text": TEXT_BINS + 1, "meta": META_SIZE + 1}

    def add(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total = {view: np.zeros(1 + n + n * n) for view, n in size.items()}
        for batch in batches:
            for teacher, pupil in (VIEWS, VIEWS[::-1]):
                p = _sigmoid(models.calibrated(teacher, batch[teacher]))
                sure = (p >= CONFIDENT) | (p <= 1 - CONFIDENT)
                if sure.any():
                    x = matrix(batch[pupil][sure], pupil)
                    total[pupil] += newton_sums(x, (p[sure] > 0.5) * 1.0, models.weights[pupil])
        context = TaskContext.get()
        slot = context.partitionId() % SLOTS if context else 0
        yield pd.DataFrame({"slot": [slot], **{v: [t.tobytes()] for v, t in total.items()}})

    def merge(part: pd.DataFrame) -> pd.DataFrame:
        sums = {v: sum(np.frombuffer(raw, dtype=float) for raw in part[v]).tobytes() for v in VIEWS}
        return pd.DataFrame({"slot": [part["slot"].iat[0]], **{v: [s] for v, s in sums.items()}})

    schema = "slot int, text binary, meta binary"
    rows = (
        features.select("text", "meta")
        .mapInPandas(add, schema)
        .groupBy("slot")
        .applyInPandas(merge, schema)
        .collect()
    )
    out = {view: np.zeros(1 + n + n * n) for view, n in size.items()}
    for row in rows:
        for view in VIEWS:
            out[view] += np.frombuffer(bytes(row[view]), dtype=float)
    return out


def co_trained(features: DataFrame, labels: DataFrame) -> Models:
    """The models of a table (id, text, meta) and labels (id, y)."""
    known = labels.where("y in (0, 1) and id is not null")
    spread = F.pmod(F.xxhash64("id"), F.lit(1 << 20))
    share = min(1.0, 0.9 * MAX_LABELLED / max(1, known.count()))
    drawn = (
        known.where(spread < share * (1 << 20))
        .join(features, "id")
        .select("text", "meta", F.col("y").cast("int"), spread.alias("at"))
        .limit(MAX_LABELLED)
        .toPandas()
        .sort_values(["at", "y"], kind="stable")
    )
    truth = drawn["y"].to_numpy(dtype=float)
    models = Models(float(truth.mean()) if len(truth) else 0.5)
    held = np.arange(len(truth)) % 4 == 3
    if min(len(np.unique(truth[held])), len(np.unique(truth[~held]))) < 2:
        return models
    x = {view: matrix(drawn[view][~held], view) for view in VIEWS}
    y = truth[~held]
    models.weights = {view: logistic(x[view], y) for view in VIEWS}
    models.calibrate(drawn[held], truth[held])
    unlabelled = features.join(known.select("id"), "id", "left_anti")
    for _ in range(ROUNDS):
        pseudo = exchanged_sums(unlabelled, models)
        for view in VIEWS:
            own = newton_sums(x[view], y, models.weights[view])
            weight = min(1.0, len(y) / max(1.0, pseudo[view][0]))
            models.weights[view] = newton_step(
                models.weights[view], own + weight * pseudo[view]
            )
        models.calibrate(drawn[held], truth[held])
    return models


def with_scores(
    docs: DataFrame,
    labels: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    label_col: str = "quality",
    least: float = 0.5,
) -> DataFrame:
    """``docs`` without the text, plus the scores; ``kept`` where score >= ``least``."""
    scratch = Scratch(docs.sparkSession, "co-training")
    names = [c for c in docs.columns if c != text_col]
    optional = [
        F.col(c) if c in docs.columns else F.lit(None) for c in ("lang", "source", "n_chars")
    ]
    features, _ = scratch.write(
        docs.select(
            F.struct(*names).alias("row"),
            F.col(id_col).alias("id"),
            views(F.col(text_col), *optional).alias("v"),
        ).select("row", "id", "v.*"),
        "features",
    )
    known = labels.select(F.col(id_col).alias("id"), F.col(label_col).alias("y"))
    models = co_trained(features, known)

    @F.pandas_udf(SCORES)
    def scored(batches: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.DataFrame]:
        for text, meta in batches:
            found = models.scores(pd.DataFrame({"text": text, "meta": meta}))
            out = pd.DataFrame(found, columns=["text_score", "meta_score", "score"])
            yield out.assign(kept=out["score"] >= least)

    results = [column.split()[0] for column in SCORES.split(", ")]
    return features.select("row", scored("text", "meta").alias("s")).select(
        *(F.col("row").getField(c).alias(c) for c in names if c not in results), "s.*"
    )
