"""Plain texts are looked up once for each distinct word of many texts, with the tokenizer's own ids."""

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from vitrine.llm.cached_encoder import CachedEncoder

TEXTS = [
    "", "a", " a", "a ", "\n", "\na", "a\n", "a b\nc d.", "a  b", "a\n\nb", "a \n b", "a\tb", "x   y", "don't 'tis it's\n's 's", "é à\nü straße, Çok!", "1 2\n33 4,5", "a\r\nb", "\0a b", "日本 a",
    "  ", "a b c", "a.\nB c\n", "naïve. naïve, naïve", "end.. end.", ". , a", "ªº, x–y € 5",
]


@pytest.mark.parametrize("remember", [0, 3, 1000])
def test_ids_by_words_are_those_of_the_tokenizer(remember):
    path = public_tokenizers.path("byte_bpe_50k.json")
    plain, code = Tokenizer.from_file(path), CachedEncoder(path, False, remember)
    want = [plain.encode(t, add_special_tokens=False).ids for t in TEXTS]
    for _ in range(2):
        assert [np.frombuffer(x, "<u2").tolist() for x in code.encode(TEXTS)] == want
    assert len(code.words) + len(code.cache) <= remember
    assert code.encode([]) == []


def test_a_word_is_looked_up_once_in_many_texts(monkeypatch):
    code, asked = CachedEncoder(public_tokenizers.path("byte_bpe_50k.json"), False), []
    monkeypatch.setattr(code, "_known", lambda words, f=code._known: asked.extend(words) or f(words))
    code.encode(["one two two\ntwo", "one two"] * 50)
    assert sorted(asked) == sorted({"\0one", "two", "\ntwo"})
