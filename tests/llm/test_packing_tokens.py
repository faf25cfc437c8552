"""Token ids against the tokenizers library as it is, added tokens included."""

import numpy as np
import public_tokenizers
from tokenizers import Tokenizer

from tidemark.llm import packing

TOKEN = "<|endoftext|>"
TEXTS = [
    f"end {TOKEN} next", TOKEN, TOKEN * 3, f"{TOKEN}a b", f"a b{TOKEN}", f"  a  {TOKEN}  b\n{TOKEN}\n\n c ", f"<|{TOKEN}|>",
    "<|endoftext|", "<|EndOfText|>", "plain text", "", f"é😀{TOKEN}ü it's 12  34",
]


def test_ids_are_those_of_the_library():
    path = public_tokenizers.path("byte_bpe_50k.json")
    library = Tokenizer.from_file(path)
    found = [np.frombuffer(ids, "<u4").tolist() for ids in packing.encoder(path).of(TEXTS)]
    assert found == [library.encode(t, add_special_tokens=False).ids for t in TEXTS]
    assert found[0] == [437, 220, 50256, 1306]
