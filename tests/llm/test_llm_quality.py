import math
from collections import Counter

import numpy as np
from pyspark.sql import functions as F

from llm_tables import DOCS, clashing, odd_docs, prose
from tickwell.llm import quality
from tickwell.llm.queries import quality_ranking


def test_held_out_accuracy(spark, sf_dir):
    found = quality_ranking(spark, sf_dir).join(spark.read.parquet(f"{sf_dir}/labels.parquet"), "doc_id").where("held_out")
    right, n = found.agg(F.sum((F.col("predicted") == F.col("quality")).cast("int")), F.count("*")).first()
    assert n > 30 and right / n > 0.95


def test_ranks_by_difference_of_features():
    rng = np.random.default_rng(0)
    good, bad = rng.normal(1, 1, (200, 5)), rng.normal(0, 1, (50, 5))
    _, weights = quality.fit(good, bad)
    assert (good @ weights).mean() > (bad @ weights).mean()


def plain_features(text):
    """One by one, in the order that the module names them."""
    raw = (text or "").encode()
    if not raw:
        return [0.0] * 264
    folded = Counter(b + 32 if 65 <= b <= 90 else b for b in raw)
    words, lines = raw.split(), raw.split(b"\n")
    n, times = max(1, len(words)), Counter(words)
    return [math.sqrt(folded[b] / len(raw)) for b in range(256)] + [
        len(times) / n,
        max(times.values(), default=0) / n,
        sum(words[i] == words[i + 1] for i in range(len(words) - 1)) / n,
        len(set(lines)) / len(lines),
        sum(65 <= b <= 90 for b in raw) / len(raw),
        math.log(1 + len(words)) / 10,
        min(1.0, len(raw) / n / 20),
        sum(w[-1] < 128 and not chr(w[-1]).isalnum() for w in words) / n,
    ]


def test_scores_against_plain_python(spark):
    """The weights are where the pairs' logistic loss is least, and each score follows from them, all by loops."""
    texts = {i: prose(i, 30 + i) + (" spam spam" * 9 if i % 3 == 0 else ".") for i in range(30)} | {90: None, 91: "", 92: " \n "}
    marks = {i: int(i % 3 != 0) for i in range(30)}
    docs = spark.createDataFrame([(i, t, "en", "a", 1) for i, t in texts.items()], DOCS)
    labels = spark.createDataFrame(list(marks.items()), "doc_id long, quality int")
    ranking = quality.learn(docs, labels)

    x = {i: plain_features(t) for i, t in texts.items()}
    mean = [sum(x[i][k] for i in marks) / len(marks) for k in range(264)]
    spread = [math.sqrt(sum((x[i][k] - mean[k]) ** 2 for i in marks) / len(marks)) for k in range(264)]
    z = {i: [(v - m) / s if s > 1e-9 else 0.0 for v, m, s in zip(x[i], mean, spread, strict=True)] for i in x}
    w = [v * s if s > 1e-9 else 0.0 for v, s in zip(ranking.weights, spread, strict=True)]
    raw = {i: sum(a * b for a, b in zip(w, z[i], strict=True)) for i in z}

    in_order = sorted(marks, key=lambda i: np.array(x[i]).tobytes())
    bad, good = ([i for i in in_order if marks[i] == q] for q in (0, 1))
    slope = [0.001 * v for v in w]
    for k, b in enumerate(bad):  # the rarer label; eight of the other each, in turn
        for j in range(8):
            g = good[(8 * k + j) % len(good)]
            wrong = 1 / (1 + math.exp(raw[g] - raw[b]))
            slope = [s - wrong * (z[g][f] - z[b][f]) / (8 * len(bad)) for f, s in enumerate(slope)]
    assert max(map(abs, slope)) < 1e-5

    ordered = sorted(raw[i] for i in marks)
    cut = (ordered[len(bad) - 1] + ordered[len(bad)]) / 2
    centre = sum(ordered) / len(ordered)
    width = math.sqrt(sum((r - centre) ** 2 for r in ordered) / len(ordered))
    for r in quality.score(docs, ranking).collect():
        want = 1 / (1 + math.exp(-max(-30, min(30, 4 * (raw[r.doc_id] - cut) / width + math.log(0.3 / 0.7)))))
        assert abs(r.score - want) < 1e-6
    assert all((raw[i] > cut) == (marks[i] == 1) for i in marks)


def test_odd_rows_all_get_a_score(spark):
    docs = clashing(odd_docs(spark))
    labels = spark.createDataFrame([(1, 1, None), (7, 1, 0), (8, 0, 0), (15, 0, 1), (10, None, 0), (None, 1, 0)], "doc_id long, quality int, toxic int")
    found = quality.rank(docs, labels, F.lit(True)).collect()
    assert len(found) == docs.count()
    assert all(0 <= r.score <= 1 for r in found)


def test_nothing_to_learn_from(spark):
    docs = spark.createDataFrame([(1, prose(1, 5), "en", "a", 1)], DOCS)
    labels = spark.createDataFrame([(1, 1)], "doc_id long, quality int")
    assert [r.score for r in quality.rank(docs, labels, F.lit(True)).collect()] == [0.5]
    assert quality.rank(docs.limit(0), labels.limit(0), F.lit(True)).count() == 0


def test_rows_that_repeat_an_id_count_once(spark):
    """However often a labelled id occurs, the driver gets one row for it, and learns the same."""
    docs = spark.createDataFrame([(i, prose(i, 40 + i), "en", "a", 1) for i in range(12)], DOCS)
    labels = spark.createDataFrame([(i, i % 2) for i in range(12)], "doc_id long, quality int")
    many = docs.unionByName(docs.where("doc_id = 3").join(spark.range(500).select(F.lit(1).alias("x")), F.col("doc_id") > 0).drop("x"))
    one, two = quality.learn(docs, labels), quality.learn(many, labels)
    assert np.array_equal(one.weights, two.weights) and one.threshold == two.threshold
