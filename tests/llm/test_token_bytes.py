"""op7: texts are counted as UTF-8 bytes, without a regular expression over them."""

import pytest

from starling.llm import tokens


@pytest.mark.parametrize("most", [5, tokens.MEMO_PIECES])
def test_bytes_are_counted_as_the_library_counts_texts(most):
    """White space that is not ASCII, or not of the six, belongs to the piece; capitals beyond A-Z are the library's."""
    from tokenizers import Tokenizer
    library = Tokenizer.from_file(tokens.tokenizer_path())
    texts = ["", " \t\n\r\x0b\x0c ", "One two,  THREE. four", "a\x1cb\x1dc \x1f d", "x\x85y\xa0z   w　v", "ÀÉ Straße ŒUVRE İstanbul",
             "<|endoftext|> A <|X|> b", "日本語 テキスト。 end.", "mark. mark, mark", "é \U0001f600\U0001f600", ". , .,", "\x00 \x01a"]
    want = [len(e.ids) for e in library.encode_batch(texts, add_special_tokens=False)]
    counter = tokens.PieceCounter(tokens.tokenizer_path(), most)
    for _ in range(2):
        assert counter.count([t.encode() for t in texts]) == want
        assert counter.count(texts) == want
