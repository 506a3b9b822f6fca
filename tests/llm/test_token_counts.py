import public_tokenizers
import pytest
import sentencepiece
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tapemill.llm.token_counts import PrefixCounter, count_tokens, longest_prefix, prefix_tables, tokens_before

PATH = public_tokenizers.path("piece_bpe_32k.model")
LIBRARY = sentencepiece.SentencePieceProcessor(model_file=PATH)
COUNTER = PrefixCounter(PATH)
TEXTS = [None, "", " ", "  a  b ", "The end.\nAnd then <s> the\tend", "中文 and é 😀", "x" * 3000, "a" + " " * 40 + "b", "▁▁ a"]


def expected(text):
    return len(LIBRARY.encode(text or ""))


@given(st.text(alphabet="ab ▁the\n é中😀<s>unk\t0!\0", max_size=40))
@settings(max_examples=300, deadline=None)
def test_every_prefix_has_the_count_of_the_library(text):
    assert COUNTER.prefix_counts(text).tolist() == [expected(text[:i]) for i in range(len(text) + 1)]


def test_counts_of_a_frame(documents):
    rows = [(i, text) for i, text in enumerate(TEXTS)] + [(0, None), (4, TEXTS[4]), (None, "no id")]
    counted = documents(rows).select("doc_id", "text", count_tokens(F.col("text"), PATH).alias("n")).collect()
    assert len(counted) == len(rows)
    assert all(row["n"] == expected(row["text"]) for row in counted)


def test_stored_tables_answer_prefix_and_budget_questions(documents):
    text = TEXTS[4]
    tables = prefix_tables(documents([(1, text), (2, None)]), PATH)
    asked = tables.select(
        "doc_id",
        "n_tokens",
        tokens_before("prefix_counts", F.lit(7)).alias("before"),
        tokens_before("prefix_counts", F.lit(10_000)).alias("all"),
        longest_prefix("prefix_counts", F.lit(5)).alias("fits"),
    )
    found = {row["doc_id"]: row for row in asked.collect()}
    fits = max(i for i in range(len(text) + 1) if expected(text[:i]) <= 5)
    assert found[1][1:] == (expected(text), expected(text[:7]), expected(text), fits)
    assert found[2][1:] == (0, 0, 0, 0)


def test_empty_table(documents):
    assert documents([]).select(count_tokens(F.col("text"), PATH)).collect() == []
    assert prefix_tables(documents([]), PATH).collect() == []


def test_another_kind_of_model_is_refused(tmp_path):
    with pytest.raises(Exception):
        PrefixCounter(str(tmp_path / "none.model"))
