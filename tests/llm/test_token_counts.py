import public_tokenizers
import pytest
import sentencepiece
from hypothesis import given, settings
from hypothesis import strategies as st

from tierstar.llm.token_counts import MergeCounter, count_tokens, read_pieces

MODEL = public_tokenizers.path("piece_bpe_32k.model")
COUNTER = MergeCounter(read_pieces(MODEL))
LIBRARY = sentencepiece.SentencePieceProcessor(model_file=MODEL)


@pytest.mark.parametrize("text", ["", " ", "  a  b ", "a\n\n b\t", "<s>x</s><0x0A>", "▁▁x", "Ａ½é😀\x00", "word" * 3000, " " * 999, "\n" * 40])
def test_like_library(text):
    assert COUNTER.count(text) == len(LIBRARY.encode(text))


@settings(max_examples=300, deadline=None)
@given(st.text(alphabet=st.one_of(st.sampled_from(" \n▁ aehinorst<>|!"), st.characters(exclude_categories=["Cs"])), max_size=80))
def test_like_library_on_any_text(text):
    assert COUNTER.count(text) == len(LIBRARY.encode(text))


def test_documents_like_library(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    texts = {r.doc_id: r.text for r in docs.collect()}
    rows = count_tokens(docs, MODEL).collect()
    assert len(rows) == len(texts)
    assert {r.doc_id: r.n_tokens for r in rows} == {i: len(LIBRARY.encode(t)) for i, t in texts.items()}
    assert all(r.n_bytes == len(texts[r.doc_id].encode()) and r.over_limit == (r.n_tokens > 4096) for r in rows)


def test_nulls_repeats_and_other_columns(spark):
    docs = spark.createDataFrame([(1, None, 5), (1, None, 5), (None, "a b", 6)], "doc_id int, text string, n_tokens int")
    assert sorted((r.doc_id or 0, r.n_tokens) for r in count_tokens(docs, MODEL).collect()) == [(0, 2), (1, 0), (1, 0)]
    assert count_tokens(docs.limit(0), MODEL).count() == 0
