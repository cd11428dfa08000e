import random

import numpy as np
import pytest

from llm_tables import DOCS, clashing, odd_docs, prose
from tickwell.llm import chunks


def cut(raw: bytes) -> list[bytes]:
    ends = chunks.ends(raw)
    return [raw[a:b] for a, b in zip([0, *ends[:-1]], ends)]


def test_rolling_hash():
    data = np.frombuffer(prose(1, 50).encode(), np.uint8)
    h, want = 0, []
    for i, b in enumerate(data):
        h = (h * 2 + int(chunks.GEAR[b])) % 2**32
        want.append(h)
    assert chunks.gear(data).tolist() == want


def test_chunks_make_up_the_text_and_resist_insertions():
    text = prose(2, 3000).encode()
    assert b"".join(cut(text)) == text
    moved = text[:5000] + b"something new " + text[5000:]
    assert len(set(cut(text)) - set(cut(moved))) <= 4
    assert max(map(len, cut(b"x" * 10_000))) <= chunks.MOST
    assert cut(b"a") == [b"a"]


def shared(rows, n=50):
    """Documents with a run of n words that another one has too."""
    seen = {}
    for doc_id, text in rows:
        words = text.split()
        for i in range(len(words) - n + 1):
            seen.setdefault(" ".join(words[i : i + n]), set()).add(doc_id)
    return {d for ids in seen.values() if len(ids) > 1 for d in ids}


def test_passages_over_fifty_words(spark):
    rng = random.Random(5)
    passages = [prose(900 + i, 52 + i) for i in range(20)] + [prose(950 + i, 30 + i) for i in range(12)]
    rows = [(i, f"{prose(1000 + i, rng.randint(3, 200))} {rng.choice(passages)} {prose(2000 + i, rng.randint(3, 200))}") for i in range(200)]
    found = chunks.repeats(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    texts = {i: t.encode() for i, t in rows}
    for r in found:
        own = texts[r.doc_id][r.start : r.start + r.length]
        assert own == texts[r.owner][r.owner_start : r.owner_start + r.length]
        assert len(own.split()) >= 50
    assert {r.doc_id for r in found} == shared(rows)


@pytest.mark.parametrize(("least", "most"), [(1, 1), (1, 2), (1, 3), (1, 4), (2, 8)])
def test_no_passage_is_lost(spark, least, most):
    """Passages of exactly 50 words, between words of the same kind, against all runs of 50 words."""
    rng = random.Random(11 * most + least)
    letters = "abcdefghijklmnopqrstuvwxyz"
    some = lambda n: " ".join("".join(rng.choices(letters, k=rng.randint(least, most))) for _ in range(n))
    passages = [some(50) for _ in range(60)] + [some(49) for _ in range(20)]
    rows = [(2 * i + k, f"{some(rng.randint(0, 60))} {p} {some(rng.randint(0, 60))}") for i, p in enumerate(passages) for k in (0, 1)]
    found = chunks.repeats(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert {r.doc_id for r in found} == shared(rows) and len(shared(rows)) >= 120
    assert all(r.words >= 50 for r in found)


def test_windows_of_shared_chunks_hold_all_that_repeat():
    """In memory, many more: what a passage's chunks let through has the passage's window, whatever is around it."""
    rng = random.Random(12)
    for trial in range(300):
        letters = "ab" if trial % 3 == 0 else "abcdefghij"
        some = lambda n: "".join("".join(rng.choices(letters, k=rng.randint(1, 1 + trial % 6))) + " " for _ in range(n))
        passage = some(50)
        texts = [(some(rng.randint(0, 40)) + passage + some(rng.randint(0, 40))).strip().encode() for _ in range(2)]
        cuts = [next(chunks.parts(t, 50))[1] for t in texts]
        both = np.intersect1d(*(c.digests() for c in cuts))
        for cut in cuts:
            first = cut.windows(np.isin(cut.digests(), both), 50, chunks.reach_of(50))
            assert passage.strip().encode() in {cut.flat[a:b] for a, b in zip(cut.start[first], cut.end[first + 49], strict=True)}


def test_long_texts_are_cut_into_parts(spark, monkeypatch):
    rows = [(1, prose(61, 900)), (2, f"{prose(62, 333)} {' '.join(prose(61, 900).split()[411:470])} {prose(63, 200)}"), (3, prose(64, 700))]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    whole = sorted(chunks.repeats(docs).collect())
    assert [(r.doc_id, r.words) for r in whole] == [(1, 59), (2, 59)]
    own = rows[0][1].encode()
    for part in (1, 50, 137):
        monkeypatch.setattr(chunks, "PART", part)
        cuts = list(chunks.parts(own, 50))
        assert sorted(w for low, c in cuts for w in low + np.arange(len(c.start) - 49)) == list(range(851))


def test_periodic_text_is_one_stretch(spark):
    rows = [(1, "ab " * 3000), (2, "zz " + "ab " * 3000), (3, "one two three " * 500), (4, "three " + "one two three " * 700)]
    found = chunks.repeats(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert sorted((r.doc_id, r.owner, r.kept, r.words) for r in found) == [(1, 1, True, 3000), (2, 1, False, 3000), (3, 3, True, 2101), (4, 3, False, 2101)]


def test_texts_of_one_id(spark):
    """Texts of one id meet those of other ids, not each other; a short one does no harm."""
    one, two, three = prose(71, 90), prose(72, 90), prose(73, 90)
    rows = [(1, one), (2, f"x {one} y"), (2, "short"), (2, f"{two} end"), (3, two), (4, three), (4, f"{three} again"), (5, one), (5, one)]
    found = chunks.repeats(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert {(r.doc_id, r.owner, r.words, r.kept) for r in found} == {(1, 1, 90, True), (2, 1, 90, False), (5, 1, 90, False), (2, 2, 90, True), (3, 2, 90, False)}


def test_reflowed_passages(spark):
    rng = random.Random(6)
    rows = []
    for i in range(40):
        words = prose(4000 + i, 60 + i).split()
        one = " ".join(words)
        two = "".join(w + rng.choice([" ", "  ", "\n", " \r\n\t"]) for w in words)
        rows += [(2 * i, f"{prose(5000 + i, 30)}  {one} {prose(6000 + i, 30)}"), (2 * i + 1, f"{prose(7000 + i, 20)}\n\n{two}{prose(8000 + i, 40)}")]
    texts = {i: t.encode() for i, t in rows}
    found = chunks.repeats(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert {r.doc_id for r in found} == set(texts)
    for r in found:
        own = chunks.collapsed(texts[r.doc_id][r.start : r.start + r.length])
        assert len(own.split()) >= 50 and chunks.collapsed(texts[r.owner][r.owner_start :]).startswith(own)


def test_passages_whose_parts_came_earlier(spark):
    """Chunks of a passage belong to documents that have less of it than later ones share."""
    rows = []
    for i in range(15):
        words = prose(9000 + i, 60).split()
        parts = [words[:40], words[20:], words, words]
        rows += [(10 * i + k, f"{prose(9100 + 10 * i + k, 30)} {' '.join(p)} {prose(9500 + 10 * i + k, 30)}") for k, p in enumerate(parts)]
    texts = {i: t.encode() for i, t in rows}
    found = chunks.repeats(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert {r.doc_id for r in found} == shared(rows) == {10 * i + k for i in range(15) for k in (2, 3)}
    for r in found:
        own = texts[r.doc_id][r.start : r.start + r.length]
        assert own == texts[r.owner][r.owner_start : r.owner_start + r.length]
        assert len(own.split()) >= r.words >= 60


def test_odd_rows(spark):
    rows = chunks.repeats(clashing(odd_docs(spark))).collect()
    assert {(r.doc_id, r.owner, r.kept) for r in rows} >= {(13, 12, False), (12, 12, True)}
    assert {r.doc_id for r in rows} <= {1, 3, 12, 13}
    assert chunks.repeats(spark.createDataFrame([], DOCS)).count() == 0


def test_copies_are_found_by_their_words(spark):
    text = prose(81, 60)
    rows = [(3, text), (1, text.replace(" ", "\n ")), (2, f" {text} "), (9, prose(82, 60)), (4, text.split()[0])]
    for limit in (0, 10):
        found = chunks.repeats(spark.createDataFrame(rows, "doc_id long, text string"), broadcast_rows=limit).collect()
        assert {(r.doc_id, r.owner, r.words, r.kept) for r in found} == {(1, 1, 60, True), (2, 1, 60, False), (3, 1, 60, False)}
        assert {(r.doc_id, r.start, r.length) for r in found if not r.kept} == {(2, 1, len(text.encode())), (3, 0, len(text.encode()))}
