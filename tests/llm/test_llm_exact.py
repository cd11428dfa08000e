import hashlib
import string

import pytest
from pyspark.sql import functions as F

from llm_tables import DOCS, clashing, odd_docs, odd_rows
from tickwell.llm import exact

LOWER = str.maketrans(string.ascii_uppercase, string.ascii_lowercase)


def digest(text):
    return hashlib.sha256((text or "").translate(LOWER).encode()).digest()


@pytest.mark.parametrize("history", ["pmod(doc_id, 2) = 0", "true", "false", "doc_id < 8"])
def test_groups(spark, history):
    found = exact.exact_dedup(clashing(odd_docs(spark)), F.expr(history)).collect()
    groups = {}
    for doc_id, text, *_ in odd_rows():
        groups.setdefault(digest(text), []).append(doc_id)
    assert len(found) == len(odd_rows())
    for r in found:
        ids = groups[bytes(r.digest)]
        best = max((i for i in ids if i is not None), default=None)
        assert (r.keep_id, r.group_size, r.kept, r.keep_rows) == (best, len(ids), r.doc_id == best, ids.count(best))


def test_survivors(spark):
    docs = clashing(odd_docs(spark))
    kept = exact.survivors(docs, F.expr("pmod(doc_id, 2) = 0"))
    assert kept.columns == docs.columns
    rows = kept.collect()
    assert len({digest(r.text) for r in rows}) == len(rows) == len({digest(r[1]) for r in odd_rows()})
    assert {r.doc_id for r in rows} >= {2, 3, 6, 8, None}


def test_hash_is_minimal_and_perfect():
    digests = [hashlib.sha256(str(i).encode()).digest() for i in range(5000)]
    sizes, field = exact.perfect_hash(digests)
    slots = exact.slots_of(digests, sizes, field)
    assert sorted(slots) == list(range(5000))
    others = [hashlib.sha256(f"other {i}".encode()).digest() for i in range(500)]
    assert max(exact.slots_of(others, sizes, field)) < 5000
    assert exact.perfect_hash([])[0] == []


def test_small_buckets_agree(spark):
    rows = odd_docs(spark).select("doc_id", exact.text_digest("text").alias("digest"))
    each = exact.distinct_digests(rows)
    old, new = each.where("pmod(winner, 2) = 0"), exact.distinct_digests(rows.where("doc_id < 10 OR doc_id IS NULL"))
    one, two = (sorted((bytes(r.digest), r.copies, r.winner or 0) for r in exact.merged_groups(old, new, n).collect()) for n in (3, 10_000))
    assert one == two


def test_batch_is_dealt_out_without_a_history(spark, monkeypatch):
    each = exact.distinct_digests(odd_docs(spark).select("doc_id", exact.text_digest("text").alias("digest")))
    build, dealt = exact.build_index, []
    monkeypatch.setattr(exact, "build_index", lambda history, buckets: dealt.append(buckets) or build(history, buckets))
    groups = exact.merged_groups(each.limit(0), each, 3)
    assert dealt[0] * 3 >= each.count()
    assert sorted(bytes(r.digest) for r in groups.collect()) == sorted(bytes(r.digest) for r in each.collect())


def test_no_rows(spark):
    docs = spark.createDataFrame([], DOCS)
    assert exact.exact_dedup(docs, F.lit(True)).count() == 0
    assert exact.survivors(docs, F.lit(True)).count() == 0
