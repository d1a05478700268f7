import math
import random
import zlib

import numpy as np
import pytest

from readloom.llm import quality

SCHEMA = "doc_id long, text string, score string, x int"


def corpus(n):
    rng = random.Random(1)
    rows, labels = [], []
    for i in range(n):
        words = ["".join(rng.choices("abcdefgh", k=rng.randrange(2, 9))) for _ in range(rng.randrange(30, 120))]
        bad = rng.random() < 0.2
        kind = rng.randrange(3)
        if bad and kind == 0:
            words = [w.upper() + "!!" for w in words]
        elif bad and kind == 1:
            words = [w + "$$$" for w in words]
        elif bad:
            words = words[:4] * 20
        rows.append((i, " ".join(words) + ".", None, None))
        labels.append((i, int(not bad)))
    return rows, labels


def test_held_out_accuracy(spark):
    rows, labels = corpus(1500)
    rows += [(9000, None, "", 1), (9001, "", "", 1), (9002, "w " * 30000, "", 1), (None, "abc", None, None), rows[3]]
    labels += [(9000, None), (None, 1), (5, 7)]
    docs, known = spark.createDataFrame(rows, SCHEMA), spark.createDataFrame(labels, "doc_id long, quality int")
    out = quality.classify(docs, known).collect()
    assert len(out) == len(rows)
    truth = {d: q for d, q in labels if d is not None and q in (0, 1)}
    tested = [(r.predicted, truth[r.doc_id]) for r in out if r.held_out and r.doc_id in truth]
    assert sum(p == t for p, t in tested) / len(tested) > 0.97
    for r in out:
        assert r.held_out == (zlib.crc32(("" if r.doc_id is None else str(r.doc_id)).encode()) % 5 == 0)
        assert 0 <= r.score <= 1 and r.predicted == int(r.score >= 0.3)


def test_held_out_labels_teach_nothing(spark):
    rows, labels = corpus(400)
    docs = spark.createDataFrame(rows, SCHEMA)
    turned = [(d, 1 - q if zlib.crc32(str(d).encode()) % 5 == 0 else q) for d, q in labels]
    a, b = ({r.doc_id: round(r.score, 9) for r in quality.classify(docs, spark.createDataFrame(x, "doc_id long, quality int")).collect()} for x in (labels, turned))
    assert a == b


def test_without_labels_or_rows(spark):
    none = spark.createDataFrame([], "doc_id long, quality int")
    out = quality.classify(spark.createDataFrame([(1, "a b", None, None)], SCHEMA), none).collect()
    assert [(r.score, r.predicted) for r in out] == [(0.5, 1)]
    assert quality.classify(spark.createDataFrame([], SCHEMA), none).collect() == []


def test_scores_are_those_of_the_densities(spark):
    """By hand: class means and shrunk covariances in numpy, log-densities by inverse and determinant."""
    rows, labels = corpus(600)
    docs, known = spark.createDataFrame(rows, SCHEMA), spark.createDataFrame(labels, "doc_id long, quality int")
    got = {r.doc_id: r.score for r in quality.classify(docs, known).collect()}
    x = {r[0]: np.array(quality.statistics(r[1])) for r in rows}
    taught = [(x[d], q) for d, q in labels if zlib.crc32(str(d).encode()) % 5]
    every = np.array([v for v, _ in taught])
    shift, scale = every.mean(axis=0), np.maximum(every.std(axis=0), 1e-4)
    own = [(np.array([v for v, q in taught if q == c]) - shift) / scale for c in (0, 1)]
    means, covariances = [o.mean(axis=0) for o in own], [np.cov(o.T, bias=True) for o in own]
    pooled = sum(len(o) * c for o, c in zip(own, covariances, strict=True)) / len(every)

    def log_density(z, c):
        shrunk = (1 - quality.RIDGE) * ((1 - quality.POOLED) * covariances[c] + quality.POOLED * pooled) + quality.RIDGE * np.eye(len(z))
        away = z - means[c]
        return -0.5 * (away @ np.linalg.inv(shrunk) @ away + math.log(np.linalg.det(shrunk)))

    odds = math.log((len(own[1]) + 1) / (len(own[0]) + 1))
    for d, v in x.items():
        z = (v - shift) / scale
        want = 1 / (1 + math.exp(-max(-50, min(50, log_density(z, 1) - log_density(z, 0) + odds))))
        assert abs(got[d] - want) < 1e-6


def test_further_columns_may_not_clash(spark):
    docs = spark.createDataFrame([(1, "a", 2, 3)], "doc_id long, text string, score int, x int")
    for name in ("score", "x"):
        with pytest.raises(ValueError, match=name):
            quality.classify(docs, docs, (name,))
