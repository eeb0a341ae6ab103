import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from factloom.llm.encode import TOKENIZER, count_tokens, decode, decode_texts, encode, encode_texts, encoder, safe_pieces, slices

tokenizers = pytest.importorskip("tokenizers")
with open(TOKENIZER, "rb") as f:
    ENC = encoder(f.read())
REFERENCE = tokenizers.Tokenizer.from_file(TOKENIZER.replace(".tiktoken", ".json"))
REFERENCE.encode_special_tokens = True
TEXTS = st.text(alphabet=st.one_of(st.characters(exclude_categories=("Cs",)), st.sampled_from(list(" \n\t'sdmtlvr.,0123aZ中文。　"))), max_size=200)


@settings(max_examples=300, deadline=None)
@given(TEXTS)
def test_same_ids_as_the_other_library(text):
    assert encode(ENC, text) == REFERENCE.encode(text, add_special_tokens=False).ids


@settings(max_examples=300, deadline=None)
@given(TEXTS, st.integers(1, 20))
def test_pieces_change_nothing(text, size):
    assert "".join(safe_pieces(text, size)) == text
    assert encode(ENC, text, size) == ENC.encode_ordinary(text)
    assert decode(ENC, encode(ENC, text, size)) == text


def test_special_strings_are_text():
    assert 50256 not in encode(ENC, "<|endoftext|>")


def test_rows(spark):
    texts = [None, "", " ", "中文 text\n", "<|endoftext|>", "long 文字，" * 30_000, "a" * 3_000, None]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").selectExpr("*", "1 AS ids", "2 AS n_tokens")
    got = {r.doc_id: list(r.ids) for r in encode_texts(df, "doc_id", "text").collect()}
    assert got == {i: ENC.encode_ordinary(t) if t else [] for i, t in enumerate(texts)}
    assert {r.doc_id: r.n_tokens for r in count_tokens(df, "doc_id", "text").collect()} == {i: len(x) for i, x in got.items()}
    back = {r.doc_id: r.text for r in decode_texts(encode_texts(df, "doc_id", "text"), "doc_id").collect()}
    assert back == {i: t or "" for i, t in enumerate(texts)}


def test_repeated_rows_and_empty_table(spark):
    df = spark.createDataFrame([(1, "x"), (1, "x")], "doc_id long, text string")
    assert encode_texts(df, "doc_id", "text").count() == 2
    assert encode_texts(df.limit(0), "doc_id", "text").count() == 0


def test_slices():
    texts = ["a" * n for n in (5, 5, 50, 1)]
    assert [(a, e) for a, e, _ in slices(texts, 10)] == [(0, 2), (2, 3), (3, 4)]
    assert list(slices([])) == []
