import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from cyclecount.llm import tokens

PARTS = ["word", "Été", "the", ".", ",", "..", "!!", "'s", "12", "9x", " ", " ", " ", "\n", "\t", "é́", "漢字", "ÅB", "<|endoftext|>", "\0"]
ENCODERS = {n: tokens.Encoder(tokens.public(n)) for n in ("byte_bpe_50k.json", "word_bpe_49k.json")}


@pytest.mark.parametrize("name", list(ENCODERS))
@pytest.mark.parametrize("memo", [0, 5, 1_000_000])
def test_pieces_equal_whole_texts(name, memo, monkeypatch):
    monkeypatch.setattr(tokens, "MEMO", memo)
    encoder = ENCODERS[name]

    @settings(max_examples=60, deadline=None)
    @given(st.lists(st.lists(st.sampled_from(PARTS), max_size=12).map("".join), max_size=6))
    def equal(texts):
        assert encoder.encode(texts) == encoder.raw(texts)
        assert encoder.encode(texts) == encoder.raw(texts)

    equal()
    encoder.memo.clear()


@pytest.mark.parametrize("name", list(ENCODERS))
def test_every_latin_letter(name):
    words = [a + c + b for c in tokens._LETTERS for a in ("", " ", "x") for b in ("", "y")]
    assert ENCODERS[name].words(words) == ENCODERS[name].raw(words)


@pytest.mark.parametrize("name", list(ENCODERS))
def test_spaces_among_other_white_space(name):
    encoder = ENCODERS[name]
    texts = ["foo \u00a0 \u00a0 \u00a0bar", "foo \u00a0 \u00a0\nbar", "a \u00a0 \u00a0 \u00a0 \u00a0 b", "\u00a0 \u00a0 a"]
    assert encoder.encode(texts) == encoder.raw(texts)

    @settings(max_examples=200, deadline=None)
    @given(st.lists(st.sampled_from(["a", "b c", " ", "\n", *tokens._ODD, *["\u00a0", " \u00a0"] * 9]), max_size=20).map("".join))
    def equal(text):
        assert encoder.encode([text]) == encoder.raw([text])

    equal()
    encoder.memo.clear()
