"""Quality classifier: regularised quadratic discriminant analysis of document statistics.

Statistics of a text are transformed to be nearly normal. Each class has a mean and a covariance, shrunk towards the pooled one
and the identity; a score is the class probability from the two Mahalanobis log-densities, with Cholesky factors computed once.
"""

from __future__ import annotations

import math
from dataclasses import dataclass
from itertools import combinations_with_replacement

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from readloom.llm.common import stash

FEATURES = ("words", "word_length", "line_length", "symbols", "bars", "marks", "stops", "upper", "digits", "foreign", "distinct", "again_lines", "again_words")
FOLDS = 5
#: Share of the pooled covariance in a class's, and of the identity (features are standardised first) in the sum.
POOLED, RIDGE = 0.3, 0.1
THRESHOLD = 0.3


def _of(chars: str) -> np.ndarray:
    return np.frombuffer(chars.encode(), np.uint8)


SYMBOLS, BARS, MARKS, STOPS, DIGITS = _of("#$%&*+/<=>@[]^_{}~\\"), _of("|"), _of("!?"), _of(".,;:"), _of("0123456789")


def statistics(text: str | None) -> list[float]:
    """The transformed statistics of a whole text; all 0 for one without words."""
    raw = (text or "").encode("utf-8", "surrogatepass")
    words = raw.lower().split()
    n = len(words)
    if not n:
        return [0.0] * len(FEATURES)
    count = np.bincount(np.frombuffer(raw, np.uint8), minlength=256)
    upper, lower = int(count[65:91].sum()), int(count[97:123].sum())
    chars = sum(map(len, words))
    lines = [x for x in (y.strip() for y in raw.split(b"\n")) if x]
    runs = [hash(x) for x in zip(words, words[1:], words[2:], strict=False)]
    rate = lambda of, per: math.sqrt(int(count[of].sum()) / per)
    return [
        math.log1p(n),
        math.log(chars / n),
        math.log(n / len(lines)),
        rate(SYMBOLS, chars),
        rate(BARS, chars),
        rate(MARKS, chars),
        rate(STOPS, chars),
        math.sqrt(upper / (upper + lower + 1)),
        rate(DIGITS, chars),
        math.sqrt(int(count[128:].sum()) / chars),
        math.log(len(set(words)) / n) / math.log(n + 2),
        math.sqrt((len(lines) - len(set(lines))) / (len(lines) + 4)),  # a few lines prove little
        math.sqrt((len(runs) - len(set(runs))) / (len(runs) + 40)),
    ]


def features(text: Column | str) -> Column:
    return F.pandas_udf(lambda s: pd.Series([statistics(x) for x in s]), "array<double>")(text)


def held_out(doc_id: Column | str) -> Column:
    """Whether labels of a document are kept from learning."""
    return F.crc32(F.coalesce((F.col(doc_id) if isinstance(doc_id, str) else doc_id).cast("string"), F.lit("")).cast("binary")) % FOLDS == 0


@dataclass(frozen=True)
class Model:
    """Log prior odds of label 1, standardisation, and per label mean, Cholesky factor of the covariance and its log-determinant."""

    odds: float
    shift: np.ndarray
    scale: np.ndarray
    classes: tuple[tuple[np.ndarray, np.ndarray, float], ...]

    def scores(self, x: np.ndarray) -> np.ndarray:
        if not self.classes:
            return np.full(len(x), 1 / (1 + math.exp(-self.odds)))
        z = (x - self.shift) / self.scale
        logs = []
        for mean, factor, log_det in self.classes:
            away = np.linalg.solve(factor, (z - mean).T)
            logs.append(-0.5 * ((away**2).sum(axis=0) + log_det))
        return 1 / (1 + np.exp(-np.clip(logs[1] - logs[0] + self.odds, -50, 50)))


def fit(labelled: DataFrame) -> Model:
    """From `labelled(quality 0/1, x array<double>)`: counts, sums and products of each class are one grouped aggregate.

    Without rows of both labels there is no discriminant; the score is then the share of label 1 (half without any rows), with
    one row of each label assumed besides.
    """
    k = len(FEATURES)
    pairs = list(combinations_with_replacement(range(k), 2))
    x = F.col("x")
    sums = [F.sum(x[i]) for i in range(k)] + [F.sum(x[i] * x[j]) for i, j in pairs]
    rows = labelled.groupBy("quality").agg(F.count(F.lit(1)).alias("n"), F.array(*sums).alias("s")).collect()
    n, total, product = np.zeros(2), np.zeros((2, k)), np.zeros((2, k, k))
    for r in rows:
        n[r["quality"]], s = r["n"], np.array(r["s"])
        total[r["quality"]] = s[:k]
        for (i, j), v in zip(pairs, s[k:], strict=True):
            product[r["quality"], i, j] = product[r["quality"], j, i] = v
    odds = math.log((n[1] + 1) / (n[0] + 1))
    if n.min() < 2:
        return Model(odds, np.zeros(k), np.ones(k), ())
    shift = total.sum(axis=0) / n.sum()
    scale = np.sqrt(np.maximum(np.diag(product.sum(axis=0)) / n.sum() - shift**2, 1e-8))
    means = [(total[c] / n[c] - shift) / scale for c in (0, 1)]
    covariances = []
    for c in (0, 1):
        raw = product[c] / n[c] - np.outer(total[c], total[c]) / n[c] ** 2
        covariances.append(raw / np.outer(scale, scale))
    pooled = (n[0] * covariances[0] + n[1] * covariances[1]) / n.sum()
    classes = []
    for c in (0, 1):
        shrunk = (1 - RIDGE) * ((1 - POOLED) * covariances[c] + POOLED * pooled) + RIDGE * np.eye(k)
        factor = np.linalg.cholesky(shrunk)
        classes.append((means[c], factor, 2 * float(np.log(np.diag(factor)).sum())))
    return Model(odds, shift, scale, tuple(classes))


#: Names of the classifier's own columns.
OWN = {"doc_id", "x", "quality", "held_out", "score", "predicted"}


def classify(docs: DataFrame, labels: DataFrame, more: tuple[str, ...] = ()) -> DataFrame:
    """Columns doc_id, `more`, held_out, score, predicted of every row of `docs(doc_id, text)`; `more` are columns of `docs`.

    Learns from `labels(doc_id, quality)` of documents that aren't held out, all of them; labels other than 0 and 1 and null
    doc_ids teach nothing, repeated rows count each. Inputs are statistics of the whole text alone. Null and empty texts have
    all statistics 0 and are scored like others. Documents without a label are scored too. A text of any length is read whole.
    Other columns of `docs` are ignored, whatever their names; `more` may not name one of OWN. An empty table gives no rows.
    """
    if OWN & {*more}:
        raise ValueError(f"the results have columns of their own named {', '.join(sorted(OWN & {*more}))}")
    known = stash(docs.select("doc_id", *more, features("text").alias("x")))
    taught = labels.filter(F.col("quality").isin(0, 1)).select("doc_id", F.col("quality").cast("int")).filter(~held_out("doc_id"))
    model = fit(known.join(taught, "doc_id"))
    score = F.pandas_udf(lambda s: pd.Series(model.scores(np.stack(s.to_list())) if len(s) else []), "double")
    scored = known.select("doc_id", *more, held_out("doc_id").alias("held_out"), score("x").alias("score"))
    return scored.withColumn("predicted", (F.col("score") >= THRESHOLD).cast("int"))
