"""Ids of texts with special-token strings are those of the tokenizer as its file stands."""

import public_tokenizers
import pytest

from vitrine.llm.cached_encoder import CachedEncoder


@pytest.mark.parametrize("name, drops_space", [("byte_bpe_50k.json", False), ("word_bpe_49k.json", True)])
def test_special_tokens_in_the_text(name, drops_space):
    import numpy as np
    from tokenizers import Tokenizer

    plain = Tokenizer.from_file(public_tokenizers.path(name))
    texts = ["a <|endoftext|> b", "x<|endoftext|><|startoftext|>y", "A <|EndOfText|> b", "<|endoftext| >", "  no token here ", "é <|endoftext|> 漢", ""]
    got = [np.frombuffer(x, "<u2").tolist() for x in CachedEncoder(public_tokenizers.path(name), drops_space).encode(texts)]
    assert got == [plain.encode(t, add_special_tokens=False).ids for t in texts]
    assert any(i in got[0] for i in (50256, 49407))
