import math
import random
import re
import zlib
from collections import Counter

import edges
import pytest
from pyspark.sql import functions as F

from shelfmark.llm import quality_classifier as qc
from shelfmark.llm import quality_rules as qr

SF = "/root/testdata/sf0.01"


def test_rules_agree_with_labels(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    judged = qr.judge_quality(docs, keep_text=False).withColumn("doc_id", F.col("row.doc_id")).join(labels, "doc_id")
    rate = judged.where("not base_failed").groupBy("quality").agg(F.avg(F.col("kept").cast("int")).alias("kept")).collect()
    rate = {r.quality: r.kept for r in rate}
    assert rate[1] > 0.98 and rate[0] < 0.1


def test_rules_edges(spark):
    docs = edges.documents(spark)
    judged = {r.row.doc_id: r for r in qr.judge_quality(docs).collect()}
    assert (judged[0].n_words, judged[1].n_words, judged[2].n_words, judged[6].word_chars) == (0, 0, 0, 100_000)
    assert judged[7].n_dup_lines == 29 and judged[7].n_repeat_words == judged[7].n_words == 210
    assert judged[7].base_failed and not judged[7].kept
    assert qr.keep_good(docs).columns == docs.columns
    assert qr.judge_quality(docs.limit(0)).count() == 0


def test_classifier_on_held_out_labels(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    scored = qc.score_quality(docs, labels, learn_from=qc.fold(F.col("label_id"), 4) != 2)
    held = scored.join(labels, scored.id == labels.doc_id).where(qc.fold(F.col("id"), 4) == 2)
    right = held.agg(F.avg((F.col("predicted") == F.col("quality")).cast("int")), F.count("*")).first()
    assert right[1] > 50 and right[0] > 0.95


def test_classifier_edges(spark):
    docs = edges.documents(spark)
    labels = spark.createDataFrame([(3, 1), (3, 1), (4, 1), (5, 0), (6, 0), (7, None), (None, 1)], "doc_id long, quality int")
    rows = qc.score_quality(docs, labels).collect()
    assert len(rows) == docs.count() and all(0 <= r.score <= 1 for r in rows)
    assert {r.score for r in qc.score_quality(docs, labels.where("quality = 1")).collect()} == {6 / 7}
    assert {r.score for r in qc.score_quality(docs, labels.limit(0)).collect()} == {0.5}
    assert qc.score_quality(docs.limit(0), labels).count() == 0


def plain_statistics(text):
    """The transformed statistics of a text, counted one by one."""
    text = text or ""
    gaps = " \t\n\x0b\f\r"
    words = [w for w in re.split(f"[{gaps}]+", text) if w]
    lines = [x for x in text.split("\n") if x.strip(gaps)]
    chars, n = sum(map(len, words)), len(words)
    windows = [tuple(words[i : i + 5]) for i in range(n - 4)]
    often = Counter(windows)
    repeated = {j for i, w in enumerate(windows) if often[w] > 1 for j in range(i, i + 5)}
    count = lambda signs: sum(c in signs for c in text)
    share = lambda part, whole, usual, weight: math.sqrt((part + usual * weight) / (whole + weight))
    return [
        math.log1p(n),
        share(count("#*$%&|<>"), chars, 0.0005, 60),
        share(len(lines) - len(set(lines)), len(lines), 0.002, 4),
        share(len(repeated), n, 0.002, 15),
        share(sum(a == b for a, b in zip(words, words[1:])), n, 0.01, 15),
        share(len(set(words)), n, 0.7, 15),
        share(count("ABCDEFGHIJKLMNOPQRSTUVWXYZ"), chars, 0.03, 60),
        share(count("0123456789"), chars, 0.002, 60),
        share(count(".!?"), n, 0.1, 15),
        math.log((chars + 75) / (n + 15)),
        math.log((n + 80) / (len(lines) + 4)),
    ]


def plain_scores(docs, labels, learn):
    """Moments, shrinkage and posterior without numpy: covariances by definition, densities by elimination."""
    x = {i: plain_statistics(t) for i, t in docs}
    rows = {k: [x[i] for i, label in labels if label == k and learn(i) and i in x] for k in (0, 1)}
    size, n = 11, {k: len(v) for k, v in rows.items()}
    mean = {k: [sum(r[a] for r in v) / n[k] for a in range(size)] for k, v in rows.items()}
    own = {k: [[sum((r[a] - mean[k][a]) * (r[b] - mean[k][b]) for r in v) / n[k] for b in range(size)] for a in range(size)] for k, v in rows.items()}
    models = {}
    for k in (0, 1):
        cov = [[0.9 * own[k][a][b] + 0.1 * sum(n[c] * own[c][a][b] for c in n) / sum(n.values()) for b in range(size)] for a in range(size)]
        models[k] = [[cov[a][b] * (0.95 if a != b else 1) + (1e-6 if a == b else 0) for b in range(size)] for a in range(size)]

    def density(k, point):
        m = [row[:] + [p - q] for row, p, q in zip(models[k], point, mean[k])]
        d, log_det = [p - q for p, q in zip(point, mean[k])], 0.0
        for a in range(size):
            log_det += math.log(m[a][a])
            for b in range(a + 1, size):
                f = m[b][a] / m[a][a]
                m[b] = [u - f * v for u, v in zip(m[b], m[a])]
        y = [0.0] * size
        for a in reversed(range(size)):
            y[a] = (m[a][size] - sum(m[a][b] * y[b] for b in range(a + 1, size))) / m[a][a]
        return -0.5 * (sum(u * v for u, v in zip(d, y)) + log_det)

    prior = math.log((n[1] + 1) / (n[0] + 1))
    return {i: 1 / (1 + math.exp(-max(-700, min(700, prior + density(1, p) - density(0, p))))) for i, p in x.items()}


def test_scores_against_plain_python(spark):
    rng = random.Random(4)
    words = [*"the of and in to is it on as at by we an be or".split(), *(f"w{i}" for i in range(60)), "Big", "End.", "What?", "x1", "#", "a|b"]
    text = lambda n, some: "".join(rng.choice(some) + rng.choice([" ", " ", " ", "\n", "\t"]) for _ in range(n))
    docs = [(i, text(rng.randint(0, 120), words if i % 2 else words[10:14] + words[-6:])) for i in range(160)]
    docs += [(500, None), (501, ""), (502, "same line\nsame line\nsame line\nsame line"), (503, "é日 🙂\x0bword")]
    labels = [(i, i % 2) for i, _ in docs[:160]] + [(3, 1), (7, None), (999, 1)]
    frames = spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(labels, "doc_id long, quality int")
    learn = lambda i: zlib.crc32(str(i).encode()) % 4 != 2
    want = plain_scores(docs, labels, learn)
    got = qc.score_quality(*frames, learn_from=qc.fold(F.col("label_id"), 4) != 2).collect()
    assert len(got) == len(docs)
    for r in got:
        assert r.score == pytest.approx(want[r.id], abs=1e-6) and r.predicted == (r.score >= 0.7)
