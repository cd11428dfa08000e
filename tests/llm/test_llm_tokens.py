import public_tokenizers
import pytest
import sentencepiece

from llm_tables import DOCS, clashing, odd_docs, odd_rows
from tickwell.llm import tokens

PATH = public_tokenizers.path("piece_bpe_32k.model")


@pytest.mark.parametrize("head", [0, 20, 50_000])
def test_counts_are_the_librarys(spark, head):
    model = sentencepiece.SentencePieceProcessor(model_file=PATH)
    found = tokens.token_counts(clashing(odd_docs(spark)), PATH, head=head).collect()
    want = [(r[0], len((r[1] or "").encode()), len(model.encode(r[1] or ""))) for r in odd_rows()]
    key = lambda r: (r[0] or -1, r[1], r[2])
    assert sorted([(r.doc_id, r.n_bytes, r.n_tokens) for r in found], key=key) == sorted(want, key=key)


@pytest.mark.parametrize("text", [" ", "  ", "a ", " a", "a  b", "▁", "a▁", "▁ a ▁", "a\n b", "\n", " ▁ "])
def test_cuts_at_spaces(text):
    model = sentencepiece.SentencePieceProcessor(model_file=PATH)
    assert sum(tokens.piece_counts(PATH, tokens.pre_tokens(text))) == len(model.encode(text))


def test_no_rows(spark):
    assert tokens.token_counts(spark.createDataFrame([], DOCS), PATH).count() == 0
