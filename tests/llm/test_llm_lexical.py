import math
import re
import string
from collections import Counter

import pytest

from llm_tables import DOCS, clashing, odd_docs, odd_rows
from tickwell.llm import lexical

LOWER = str.maketrans(string.ascii_uppercase, string.ascii_lowercase)
ITEMS = "item_id long, text string"
GIVEN = [
    (1, "the of AND to in that it für"),
    (2, "for was with, the bakelo (ba) 日本語の文章です"),
    (2, "TRISEN lo ma"),
    (3, None),
    (4, "..."),
    (None, "one a row without an id"),
    (5, "the"),
    (6, " ".join(f"word{i}" for i in range(50)) + " der die und das nicht mit sich x3 spaces"),
    (7, "12 34 İstanbul straße"),
]


def terms(text):
    return re.findall(lexical.TERM, (text or "").translate(LOWER))


def ranking(docs, items, top):
    counts = [(i, Counter(terms(t))) for i, t in docs]
    held = [(i, c, sum(c.values())) for i, c in counts if c]
    n, total, df = len(held), sum(h[2] for h in held), Counter(t for _, c, _ in held for t in c)
    wanted = {}
    for item, text in items:
        wanted.setdefault(item, set()).update(terms(text))
    rows = []
    for item, words in wanted.items():
        scores = []
        for doc, c, length in held:
            m = 100 - 50 + (50 * length * n) // total
            score = sum(math.floor(1000 * math.log((2 * n + 2) / (2 * df[t] + 1))) * (1000000000 * c[t] // (1000 * c[t] + 20 * m)) for t in words if c[t])
            if score > 0:
                scores.append((-score, doc is None, doc or 0))
        rows += [(item, at, None if null else doc, -score) for at, (score, null, doc) in enumerate(sorted(scores)[:top], 1)]
    return sorted(rows, key=str)


def found(df):
    return sorted(map(tuple, df.collect()), key=str)


@pytest.mark.parametrize("block_bytes", [1 << 20, 2000, 700])
def test_ranking(spark, block_bytes):
    """Blocks that hold all items, some of them, and parts of one."""
    docs = clashing(odd_docs(spark)).repartition(3)
    items = clashing(spark.createDataFrame(GIVEN, ITEMS))
    want = ranking([r[:2] for r in odd_rows()], GIVEN, 5)
    assert found(lexical.search(docs, items, 5, block_bytes)) == want
    assert {r[0] for r in want} == {1, 2, None, 5, 6, 7}


def test_blocks_hold_each_term_of_each_item_once(spark):
    items = spark.createDataFrame(GIVEN, ITEMS)
    want = {(i, t) for i, text in GIVEN for t in terms(text)}
    for block_bytes in (1 << 20, 900, 150):
        blocks = list(lexical.blocks_of(items, block_bytes))
        pairs = []
        for b in blocks:
            ends = [*b.starts[1:], len(b.members)]
            pairs += [(item, b.terms[m]) for item, s, e in zip(b.items, b.starts, ends, strict=True) for m in b.members[s:e]]
            size = sum(len(b.terms[m].encode()) + lexical.ROW_BYTES for m in b.members)
            assert size <= block_bytes + max(len(t.encode()) for t in b.terms) + lexical.ROW_BYTES
        assert len(pairs) == len(want) and set(pairs) == want


def test_best_rows_of_many_batches():
    import numpy as np

    rng = np.random.default_rng(3)
    scores, ids = rng.integers(0, 6, (500, 3)), rng.integers(-40, 40, 500)
    nulls = (rng.random(500) < 0.1).astype(np.int64)
    best = lexical.Best(3, 20)
    for low in range(0, 500, 7):
        part = slice(low, low + 7)
        best.add(scores[part], ids[part], nulls[part])
        if low % 3 == 0:
            best.cut()
    best.cut()
    for item in range(3):
        want = sorted((-s, n, i) for s, n, i in zip(scores[:, item].tolist(), nulls.tolist(), ids.tolist(), strict=True) if s)[:20]
        mine = best.rows[0] == item
        assert [(-s, n, i) for i, n, s in zip(*(c[mine].tolist() for c in best.rows[1:]), strict=True)] == want


def test_no_rows(spark):
    docs, none = odd_docs(spark), spark.createDataFrame([], ITEMS)
    assert lexical.search(docs, none).collect() == []
    assert lexical.search(spark.createDataFrame([], DOCS), spark.createDataFrame(GIVEN, ITEMS)).collect() == []
    assert lexical.search(docs.where("text IS NULL"), spark.createDataFrame(GIVEN, ITEMS), block_bytes=100).collect() == []
