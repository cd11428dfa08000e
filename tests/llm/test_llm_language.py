import re
from collections import Counter, defaultdict

import numpy as np
from pyspark.sql import functions as F

from llm_tables import DOCS, clashing, odd_docs, odd_rows
from tickwell.llm import language
from tickwell.llm.queries import language_id


def test_held_out_accuracy(spark, sf_dir):
    found = language_id(spark, sf_dir).join(spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "lang"), "doc_id").where("held_out")
    right, n = found.agg(F.sum((F.col("lang") == F.col("lang_pred")).cast("int")), F.count("*")).first()
    assert n > 100 and right / n > 0.97


def plain_grams(text):
    """N-grams of three and four bytes, one by one."""
    line = " " + " ".join(re.findall("[a-z\x80-\xff]+", text.lower().encode().decode("latin-1"))) + " "
    return [line[i : i + k] for k in (3, 4) for i in range(len(line) - k + 1)]


def by_plain_sets(rows, training, floor=2e-5, share=0.5):
    """(lang, score) of each (text, lang) with sets of n-grams in place of filters."""
    counts = defaultdict(Counter)
    for (text, lang), learnt in zip(rows, training, strict=True):
        if learnt and lang is not None and text is not None:
            counts[lang].update(plain_grams(text))
    langs = sorted(counts)
    rates = {lang: {g: n / counts[lang].total() for g, n in counts[lang].items()} for lang in langs}
    highest = Counter()
    for own in rates.values():
        highest |= Counter(own)
    held = {lang: {g for g, r in rates[lang].items() if r >= floor and r >= share * highest[g]} for lang in langs}
    most = max(langs, key=lambda lang: (counts[lang].total(), [-ord(c) for c in lang]))
    for text, _ in rows:
        if not any(c.isalpha() for c in text or ""):
            yield "und", 0.0
            continue
        hits = {lang: sum(g in held[lang] for g in plain_grams(text)) for lang in langs}
        best = max(langs, key=lambda lang: hits[lang])  # the first of equals
        two = sum(sorted(hits.values())[-2:])
        yield (best, hits[best] / two) if two else (most, 0.0)


def test_against_plain_sets(spark, sf_dir):
    """Filters decide as the sets they hold would, and their chance hits, once taken off, hardly move a score."""
    whole = [(r.doc_id, r.text, r.lang) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()][:400]
    for rows in ([r[:3] for r in odd_rows()], whole):
        docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
        learnt = [i is not None and i % 5 != 0 for i, _, _ in rows]
        want = Counter()
        for (i, text, _), (lang, score) in zip(rows, by_plain_sets([r[1:] for r in rows], learnt), strict=True):
            want[i, lang] += 1
            want[i, lang, "score"] = score
        found = language.identify(docs, F.coalesce(F.col("doc_id") % 5 != 0, F.lit(False))).collect()
        assert Counter((r.doc_id, r.lang_pred) for r in found) == Counter({k: n for k, n in want.items() if len(k) == 2})
        assert all(abs(r.score - want[r.doc_id, r.lang_pred, "score"]) < 0.02 for r in found)


def test_filters_hold_what_they_were_given():
    rng = np.random.default_rng(0)
    for many in (3, 12, 70):
        langs = [f"l{i:02}" for i in range(many)]
        filters = language.Filters(langs)
        sets = [rng.integers(0, 1 << 32, 300) for _ in langs]
        for i, grams in enumerate(sets):
            filters.add(i, grams)
        filters.close()
        grams = np.concatenate(sets)
        hits = filters.hits(grams, np.arange(many) * 300)
        assert (np.diag(hits) == 300).all()  # no false negative
        assert hits.sum() - 300 * many <= 300 * many * many * (max(filters.chance) + 0.01)


def test_counts_every_gram(spark):
    docs = spark.createDataFrame([("a", "Ab ab"), ("a", "ab"), ("b", "é"), (None, "zz"), ("b", None)], "lang string, text string")
    found = {(r.lang, r.gram): r.n for r in language.gram_counts(docs).collect()}
    assert found[("a", int.from_bytes(b" ab", "big"))] == 3
    assert found[("a", int.from_bytes(b" ab ", "big"))] == 3
    assert ("b", int.from_bytes(b" zz", "big")) not in found


def test_odd_rows(spark):
    docs = clashing(odd_docs(spark))
    found = {r.doc_id: r for r in language.identify(docs, F.col("doc_id") >= 100).collect()}
    assert all(found[i].lang_pred == "und" and found[i].score == 0 for i in (4, 5, 6, 9))
    assert found[8].lang_pred == "de" and found[7].lang_pred == "en"
    assert found[14].lang_pred == "en" and found[14].score == 0  # letters, but no known n-gram
    assert all(0 <= r.score <= 1 for r in found.values())
    kept = language.identified(docs, F.col("doc_id") >= 100)
    assert kept.columns == docs.columns
    assert not {4, 5, 6, 9, 14} & {r.doc_id for r in kept.collect()}
    assert {1, 2, 3, 7, 8, 10, 12, 13} <= {r.doc_id for r in kept.collect()}


def test_nothing_to_learn_from(spark):
    docs = odd_docs(spark)
    assert {r.lang_pred for r in language.identify(docs, F.lit(False)).collect()} == {"und"}
    assert language.identify(spark.createDataFrame([], DOCS), F.lit(True)).count() == 0
