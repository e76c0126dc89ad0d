import unicodedata as ud

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from cladeworks.llm import canonical as c

pytestmark = pytest.mark.usefixtures("spark")


def form(text):
    return c.canonicaliser(c.tables())(text)


def whole(text):
    return c._settle(c.tables()[0])(text)


ODD = "aeo ȩ́́​­　ﬁＡ９ёѕсαΟ각각ǅ½…क़Ⅷế漢\n\r\t'’\x00\x7f️𝟘"


@given(st.text(alphabet=st.one_of(st.sampled_from(ODD), st.characters(exclude_categories=["Cs"])), max_size=40))
@settings(max_examples=1500, deadline=None)
def test_spliced_segments_equal_the_whole(text):
    out = form(text)
    assert out == whole(text), text
    assert form(out) == out


def test_same_look():
    for a, b in [
        ("café", "café"), ("ABC 12", "ＡＢＣ　12"), ("zero width", "ze​ro­ wid⁠th﻿"), ("a b", "a b"), ("a b", "a b"),
        ("score", "ѕсоrе"), ("ë", "ё"), ("á", "а́"), ("AB", "ΑВ"), ("file", "ﬁle"), ("2024", "𝟐𝟎𝟐𝟒"), ("é", "e​́"),
    ]:
        assert form(a) == form(b), (a, b)
    for a, b in [("Cafe", "cafe"), ("café", "cafe"), ("a.b", "ab"), ("a b", "a  b"), ("a\nb", "a b"), ("a\r\nb", "a\nb"), ("a\tb", "a b"), ("β", "ß")]:
        assert form(a) != form(b), (a, b)


def test_stable_text_is_left_alone():
    for t in ("plain ASCII\n", "Größe über façade ñ", "漢字かな。", "β-lactam ✓ 🧬", ""):
        assert form(t) == t


def test_pairs_against_brute_force(spark):
    texts = ["café x", "café x", "café x", "cafe x", "ABC", "ＡＢＣ", "АBC", "ABC", None, "", " ", "　", "​", "​​", "a" * 5000 + "​", "a" * 5000]
    rows = [(i, t, "k", b"") for i, t in enumerate(texts)]
    df = spark.createDataFrame([*rows, rows[0], (None, "ABC​", "k", b"")], "doc_id bigint, text string, canonical string, look binary")
    want = {
        (i, j) for i, a in enumerate(texts) for j, b in enumerate(texts)
        if i < j and a and b and a != b and form(a) == form(b) and form(a).strip()
    }
    got = [tuple(r) for r in c.same_look(df).collect()]
    assert set(got) == want and len(got) == len(want) and (5, 6) in want
    assert c.same_look(df.limit(0)).collect() == []
    out = {r["doc_id"]: r["canonical"] for r in c.canonical_texts(df).collect()}
    assert out[1] == "café x" and out[8] is None and out[9] == "" and ud.is_normalized("NFC", out[14])


#: A list made by hand, before and without the confusables data, of letters that are drawn alike.
BY_HAND = {
    "a": "а α ɑ", "c": "с ᴄ", "d": "ԁ", "e": "е", "g": "ɡ ց", "h": "һ հ", "i": "і", "j": "ј ϳ յ", "l": "ӏ", "n": "ո", "o": "о ο օ ᴏ", "p": "р ρ", "q": "ԛ զ",
    "s": "ѕ", "u": "ս υ", "v": "ν ѵ ᴠ", "w": "ԝ ᴡ", "x": "х", "y": "у γ ү", "z": "ᴢ",
    "A": "А Α Ꭺ ꓮ", "B": "В Β Ᏼ ꓐ", "C": "С Ꮯ Ⲥ ꓚ 𐐕", "D": "Ꭰ ꓓ", "E": "Е Ε Ꭼ ꓰ", "F": "ꓝ", "G": "Ԍ Ꮐ ꓖ", "H": "Н Η Ꮋ Ⲏ ꓧ", "I": "І Ι Ӏ Ⲓ ꓲ", "J": "Ј Ϳ Ꭻ ꓙ",
    "K": "К Κ Ꮶ Ⲕ ꓗ", "L": "Ꮮ ꓡ 𐐛", "M": "М Μ Ꮇ Ⲙ ꓟ", "N": "Ν Ⲛ ꓠ", "O": "О Ο Օ Ⲟ ꓳ 𐐄", "P": "Р Ρ Ꮲ Ⲣ ꓑ", "Q": "Ԛ", "R": "Ꭱ ꓣ", "S": "Ѕ Տ Ꮪ ꓢ 𐐠",
    "T": "Т Τ Ꭲ Ⲧ ꓔ", "U": "Ս ꓴ", "V": "Ѵ Ꮩ ꓦ", "W": "Ԝ Ꮃ ꓪ", "X": "Х Χ Ⲭ ꓫ", "Y": "У Υ Ү Ⲩ ꓬ", "Z": "Ζ Ꮓ ꓜ",
}


def test_recall_of_a_list_made_by_hand():
    pairs = [(x, latin) for latin, row in BY_HAND.items() for x in row.split()]
    assert [(x, y) for x, y in pairs if form(x) != y] == [] and len(pairs) > 130
    for pair in ("κк", "τт", "εє", "βΒ"):
        assert (form(pair[0]) == form(pair[1])) == (pair != "βΒ"), pair


def test_letters_of_one_alphabet_and_digits_stay_apart():
    plain = [chr(n) for n in range(33, 127)]
    assert [form(x) for x in plain] == plain
    for x in "ıſßøæœƅþðбжЗд9б가각힣":
        y = form(x)
        assert y == ud.normalize("NFC", ud.normalize("NFKD", x)), x
    shapes = c.shapes()
    assert all(c.alphabet(a) != c.alphabet(b) and b not in shapes and len(b) == 1 for a, b in shapes.items())
