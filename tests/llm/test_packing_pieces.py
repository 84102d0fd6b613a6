"""Words that differ in case and signs only are encoded by their pieces."""

import itertools

import numpy as np
import public_tokenizers

from millrace.llm import packing


def test_new_words_of_known_pieces_are_not_encoded_again(monkeypatch):
    given = []
    for name in ("_apart", "_encoded", "_encoded_pieces"):
        if hasattr(packing.WordTokenizer, name):
            plain = getattr(packing.WordTokenizer, name)
            monkeypatch.setattr(packing.WordTokenizer, name, lambda self, words, plain=plain: given.append(len(words)) or plain(self, words))
    tokenizer = packing.WordTokenizer(public_tokenizers.path("word_bpe_49k.json"), None)
    words = [f"{a}{b}{c}{d}" for a, b, c, d in itertools.product(["", "(", "«"], ["Mill", "mill", "RACE", "été", "ÉTÉ"], ["", "'s", "7"], ["", ",", ".", "…", "###"])]
    got = np.frombuffer(tokenizer.ids([" ".join(words)])[0], "<u4").tolist()
    assert got == tokenizer.tokenizer.encode(" ".join(words), add_special_tokens=False).ids
    assert len(set(words)) == 225
    assert sum(given) < 20


def test_pieces_give_the_ids_of_whole_words():
    tokenizer = packing.WordTokenizer(public_tokenizers.path("word_bpe_49k.json"), None)
    plain = [c for c in map(chr, range(33, 0xA000)) if not packing._ODD.match(c)]
    beyond = ["é", "İs", "Σας", "²", "a\xa0b", "\x1c", "🙂x", "½", "­x", "<|endoftext|>'s", "x<|startoftext|>", "\x01", "'\x01's", "ﬁ"]
    texts = [f"{c} a{c}B '{c}'s 1{c}" for c in plain + beyond] + ["", "  ", "\t a\x0b\x0cb "]
    got = [np.frombuffer(x, "<u4").tolist() for x in tokenizer.ids(texts)]
    assert got == [tokenizer.tokenizer.encode(t, add_special_tokens=False).ids for t in texts]
