import math
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from llm_tables import DOCS, clashing, odd_docs, odd_rows, prose
from tickwell.llm import pitman_yor
from tickwell.llm.common import fold
from tickwell.llm.queries import pitman_yor_scores

TOKENS = pitman_yor.tokens_of


def base_of(rows, held_out):
    counts = Counter(t for r in rows if not held_out(r) for t in TOKENS((r[1] or "").encode()))
    n, v = sum(counts.values()), len(counts)
    for r in rows:
        tokens = TOKENS((r[1] or "").encode())
        yield (r[0], len(tokens), sum(counts[t] > 0 for t in tokens), n, sum(math.log10((counts[t] + 1) / (n + v + 1)) for t in tokens))


def key(r):
    return (r[0] is not None, r[0], r[1])


@pytest.mark.parametrize("per_part", [50, 2_000_000])
def test_counts_and_base(spark, per_part):
    rows = odd_rows()
    out = lambda r: r[0] is None or zlib.crc32(str(r[0]).encode()) % 7 == 2
    want = sorted(base_of(rows, out), key=key)
    found = pitman_yor.scores(clashing(odd_docs(spark)), ~fold(7, 2), per_part).collect()
    got = sorted([(r.doc_id, r.n_tokens, r.n_known, r.train_tokens, r.base_score) for r in found], key=key)
    assert [g[:4] for g in got] == [w[:4] for w in want]
    assert np.allclose([g[4] for g in got], [w[4] for w in want])


def test_better_than_the_base_on_held_out_text(spark, sf_dir):
    found = pitman_yor_scores(spark, sf_dir).where("held_out").agg(F.sum("score"), F.sum("base_score")).first()
    assert found[0] > 0.97 * found[1]


def test_probabilities_sum_to_one():
    """Over all known words and one unknown, in each context, up to what the float counts leave."""
    rng = np.random.default_rng(1)
    words, contexts = 300, 5
    table = rng.poisson(rng.gamma(0.2, 3, (contexts, words)))
    table[:, -1] = 0  # the unknown one
    context, word = np.divmod(np.arange(table.size), words)
    flat = table.ravel()
    of_word = table.sum(axis=0)
    known = np.flatnonzero(of_word)
    sums = np.zeros(pitman_yor.SUMS)
    sums[:contexts] = table.sum(axis=1)
    sums[pitman_yor.CONTEXTS :] = flat.sum(), len(known), (flat == 1).sum(), (flat == 2).sum(), (of_word == 1).sum(), (of_word == 2).sum()
    model = pitman_yor.Model(sums)
    block = (word, context, flat, words, 1)
    for _ in range(pitman_yor.SWEEPS):
        model.sweeps.append(model.sums(*block))
    p = 10 ** model.log_probabilities(*block).reshape(contexts, words)
    assert np.allclose(p[:, known].sum(axis=1) + p[:, -1], 1, atol=1e-9)


def table_law(n, weight, discount):
    """Mean and spread of the number of tables of n customers, each table weighing the same."""
    ways = [0.0, 1.0]  # of sitting at 0, 1 ... tables, weighted and scaled
    for m in range(1, n):
        ways = [0.0] + [ways[t - 1] * weight + (m - t * discount) * (ways[t] if t <= m else 0) for t in range(1, m + 2)]
        top = max(ways)
        ways = [w / top for w in ways]
    p = np.array(ways) / sum(ways)
    t = np.arange(n + 1)
    return (p * t).sum(), math.sqrt((p * t * t).sum() - (p * t).sum() ** 2)


@pytest.mark.parametrize("n, weight, discount", [(2, 0.5, 0.6), (60, 0.5, 0.6), (60, 5, 0.8), (300, 5, 0.3), (700, 0.5, 0.6), (900, 5, 0.8), (900, 50, 0.5)])
def test_tables_follow_their_conditional_law(n, weight, discount):
    mean, spread = table_law(n, weight, discount)
    many = np.full(20_000, n)
    got = pitman_yor.reseat(many, np.ones_like(many), lambda rows, i: np.full(np.broadcast(rows, i).shape, math.log(weight)), discount, np.random.default_rng(2))
    exact = n <= pitman_yor.EXACT
    assert abs(got.mean() - mean) < (0.03 * spread if exact else 0.04 * mean)
    assert abs(got.std() - spread) < (0.05 if exact else 0.08) * spread


def test_scores_against_customers_seated_one_by_one():
    """Probabilities after blocked sweeps, against a plain sampler that moves one customer at a time."""
    import random

    contexts, words, low, high = 3, 6, 0.5, 0.5
    table = np.random.default_rng(5).poisson(4, (contexts, words)) * np.array([1, 0, 1, 2, 1, 1])
    context, word = np.divmod(np.arange(table.size), words)
    sums = np.zeros(pitman_yor.SUMS)
    sums[:contexts] = table.sum(axis=1)
    known = int((table.sum(axis=0) > 0).sum())
    sums[pitman_yor.CONTEXTS :] = table.sum(), known, 1, 0, 1, 0
    got = np.zeros(table.size)
    for seed in range(40):
        model = pitman_yor.Model(sums)
        model.low = low
        model.high = high
        for _ in range(12):
            model.sweeps.append(model.sums(word, context, table.ravel(), words, seed))
        got += 10 ** model.log_probabilities(word, context, table.ravel(), words, seed) / 40

    rng = random.Random(1)
    uniform = 1 / (known + 1)
    root = [[] for _ in range(words)]  # customers of each table of a dish
    rooms = [[[] for _ in range(words)] for _ in range(contexts)]

    def root_p(w):
        total, tables = sum(map(sum, root)), sum(map(len, root))
        return (sum(root[w]) - high * len(root[w]) + (1 + high * tables) * uniform) / (1 + total)

    def sit(tables, fresh, discount):
        place = rng.random() * (fresh + sum(tables) - discount * len(tables))
        for i, size in enumerate(tables):
            place -= size - discount
            if place < 0:
                tables[i] += 1
                return False
        tables.append(1)
        return True

    def leave(tables):
        i = rng.choices(range(len(tables)), tables)[0]
        tables[i] -= 1
        if tables[i] == 0:
            del tables[i]
            return True
        return False

    def move(u, w, first):
        if not first and leave(rooms[u][w]):
            leave(root[w])
        if sit(rooms[u][w], (1 + low * sum(map(len, rooms[u]))) * root_p(w), low):
            sit(root[w], (1 + high * sum(map(len, root))) * uniform, high)

    customers = [(u, w) for u in range(contexts) for w in range(words) for _ in range(table[u, w])]
    for u, w in customers:
        move(u, w, True)
    want, rounds = np.zeros((contexts, words)), 0
    for sweep in range(1500):
        for u, w in customers:
            move(u, w, False)
        if sweep >= 100:
            rounds += 1
            for u in range(contexts):
                for w in range(words):
                    t = len(rooms[u][w])
                    want[u, w] += (table[u, w] - low * t + (1 + low * sum(map(len, rooms[u]))) * root_p(w)) / (1 + table[u].sum())
    assert np.allclose(got, (want / rounds).ravel(), rtol=0.06, atol=0.003)


def test_the_same_again(spark):
    docs = odd_docs(spark)
    one, two = (sorted((r.doc_id or 0, r.score) for r in pitman_yor.scores(d, ~fold(7, 2)).collect()) for d in (docs, docs.repartition(5)))
    assert np.allclose([s for _, s in one], [s for _, s in two])


def test_nothing_to_learn_from(spark):
    docs = spark.createDataFrame([(1, prose(1, 5), "en", "a", 1), (2, None, None, None, None)], DOCS)
    found = {r.doc_id: r for r in pitman_yor.scores(docs, F.lit(False)).collect()}
    assert found[1].train_tokens == 0 and found[1].base_score == 0 and found[2].n_tokens == 1
    assert pitman_yor.scores(docs.limit(0), F.lit(True)).count() == 0


def of_every_word(rows, seeds=20):
    """Scores of rows (id, text, learnt), all customers in one place, each preceding word a restaurant; mean over seeds."""
    each = [TOKENS(r[1].encode()) for r in rows]
    numbers = {w: i for i, w in enumerate(sorted({t for tokens in each for t in tokens}, key=lambda t: (t != b"\n", t)))}
    pairs = [[(numbers[u], numbers[w]) for u, w in zip([b"\n", *tokens], tokens)] for tokens in each]  # noqa: B905
    seen = Counter(p for r, own in zip(rows, pairs, strict=True) if r[2] for p in own)
    table = np.zeros((len(numbers), len(numbers)), np.int64)
    for (u, w), n in seen.items():
        table[u, w] = n
    context, word = np.divmod(np.arange(table.size), len(numbers))
    flat, of_word = table.ravel(), table.sum(axis=0)
    sums = np.r_[table.sum(axis=1), table.sum(), (of_word > 0).sum(), (flat == 1).sum(), (flat == 2).sum(), (of_word == 1).sum(), (of_word == 2).sum()]
    p = np.zeros(table.size)
    for seed in range(seeds):
        model = pitman_yor.Model(sums)
        for _ in range(pitman_yor.SWEEPS):
            model.sweeps.append(model.sums(word, context, flat, len(numbers), seed))
        p += 10 ** model.log_probabilities(word, context, flat, len(numbers), seed) / seeds
    return {r[0]: sum(math.log10(p[u * len(numbers) + w]) for u, w in own) for r, own in zip(rows, pairs, strict=True)}


@pytest.mark.parametrize("sizes", [{}, {"head": 6, "table": 3}, {"head": 40, "table": 2}, {"head": 2, "table": 1}])
def test_each_preceding_word_has_its_own_restaurant(spark, sizes):
    """600 words, most of them rare and with one ending, each followed by a word of its own; in the table, dealt as common or as rare ones."""
    rng = np.random.default_rng(3)
    names = [f"{i}ab" for i in range(600)]
    texts = [" ".join(w for i in (600 * rng.random(12) ** 2).astype(int) for w in (names[i], names[(7 * i + 1) % 600], "and")) for _ in range(150)]
    rows = [(i, text, i % 5 > 0) for i, text in enumerate(texts)] + [(998, "new 3ab 22ab new", False), (999, "", True)]
    want = of_every_word(rows)
    docs = spark.createDataFrame(rows, "doc_id long, text string, learnt boolean").repartition(3)
    found = {r.doc_id: r for r in pitman_yor.scores(docs, F.col("learnt"), 900, **sizes).collect()}
    assert len(found) == len(rows)
    for i, text, _ in rows:
        assert abs(found[i].score - want[i]) < 0.02 * abs(want[i]) + 0.15, (i, found[i].score, want[i])
    base = base_of([r for r in rows], lambda r: not r[2])
    assert all(found[b[0]].n_known == b[2] and math.isclose(found[b[0]].base_score, b[4]) for b in base)
