"""The word encoder's cost: patterns and classes of all letters only where a text needs them."""

import sys

from tokenizers import Tokenizer

from devpulse.llm import bpe, queries, wordbpe


def test_letters_with_symbols_need_no_pattern(monkeypatch):
    text = "Words, and more words! (none) of ... them's 3rd, \"it's\"\n<|endoftext|>end"
    odd = []
    monkeypatch.setattr(bpe, "split_normal", lambda c: odd.append(c) or wordbpe.split_normal(c))
    wordbpe._all_words.cache_clear()
    library = Tokenizer.from_file(queries.WORD_BPE)
    got = [i.tolist() for i in bpe.Encoder(queries.WORD_BPE).encode([text, None, text, "élan, Ñandú.", ""])]
    want = [library.encode(t, add_special_tokens=False).ids for t in (text, "élan, Ñandú.")]
    assert got == [want[0], [], want[0], want[1], []]
    assert sorted(odd) == ['"it\'s"', "(none)", "...", "3rd,", "them's"]
    assert wordbpe._all_words.cache_info().currsize == 0


def test_no_letter_or_digit_lies_beyond_the_classes_end():
    for major in "LN":
        assert wordbpe._char_class(major) == wordbpe._char_class(major, sys.maxunicode + 1)


def test_a_full_table_begins_anew(monkeypatch):
    monkeypatch.setattr(bpe, "TABLE_WORDS", 8)
    library, ours = Tokenizer.from_file(queries.WORD_BPE), bpe.Encoder(queries.WORD_BPE)
    for k in range(4):
        texts = [f"alpha word{chr(97 + k)}, beta {chr(97 + k)}x! gamma", "alpha <|startoftext|> beta, delta"]
        got = [i.tolist() for i in ours.encode(texts)]
        assert got == [library.encode(t, add_special_tokens=False).ids for t in texts]
