import os
import random

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from cladeworks.llm import tokens

PATH = tokens.vocabulary_path("byte_bpe_50k.tiktoken")
pytestmark = pytest.mark.skipif(not os.path.exists(PATH), reason="no vocabulary")


def enc():
    return tokens.encoding(PATH)


@given(st.text(alphabet=st.sampled_from("ab Z'sré9漢 \n\t　²½́<|>."), max_size=200), st.integers(1, 20))
@settings(max_examples=300, deadline=None)
def test_pieces_do_not_change_ids(text, long):
    assert "".join(tokens.pieces(text, long)) == text
    ids = tokens.encode(enc(), text, long)
    assert ids == tokens.encode(enc(), text)
    assert tokens.decode(enc(), ids) == text.encode()


def test_against_another_library():
    t = pytest.importorskip("tokenizers").Tokenizer.from_file(tokens.vocabulary_path("byte_bpe_50k.json"))
    t.encode_special_tokens = True
    r = random.Random(0)
    for _ in range(200):
        text = "".join(r.choice(["the ", "GCA_7000", ".1\n", "  ", "é", "漢字", "<|endoftext|>", "'ll", "\r\n", "ACGT" * 9]) for _ in range(40))
        assert tokens.encode(enc(), text, 30) == t.encode(text, add_special_tokens=False).ids


def test_frame(spark):
    big = "ACGT" * 60_000
    rows = [(1, "a b", 0), (2, None, 0), (3, "", 0), (3, "", 0), (None, "x", 0), (4, " ", 0), (5, "<|endoftext|>", 0), (6, big, 0), (7, " " * 300_000 + "x", 0)]
    df = spark.createDataFrame(rows, "doc_id bigint, text string, ids int")
    got = [(r["doc_id"], r["ids"]) for r in tokens.token_ids(df).collect()]
    assert len(got) == len(rows)
    by = dict(got)
    assert by[2] == [] and by[3] == [] and by[1] == enc().encode_ordinary("a b") and by[4] == [220] and 50256 not in by[5]
    assert tokens.decode(enc(), by[6]) == big.encode() and tokens.decode(enc(), by[7]) == (" " * 300_000 + "x").encode()
    assert tokens.token_ids(df.limit(0)).collect() == []


def test_missing_vocabulary_names_the_setting(tmp_path):
    with pytest.raises(FileNotFoundError, match="TOKENIZER_DIR"):
        tokens.vocabulary_path("none.tiktoken", str(tmp_path))
