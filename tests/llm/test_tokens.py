import json
import random

import numpy as np
import pytest

from tessera.llm import queries, wavelet

TEXTS = ["<|endoftext|>", "foo<|endoftext|>bar", "<|startoftext|>", "A <|startoftext|>, b", "<|endoftext|>!!", "x<|endoftext|><|startoftext|>y", "<|ENDOFTEXT|>",
         "<|endoftext", "naïve<|endoftext|>é", "日本<|endoftext|>", "one two\n<|endoftext|>\nthree's", "plain, words."]


def same(path, texts):
    from tokenizers import Tokenizer
    library, code = Tokenizer.from_file(path), wavelet.Encoder(path)
    got = [np.frombuffer(x, code.kind).tolist() for x in code.encode([t.encode() for t in texts])]
    assert got == [library.encode(t, add_special_tokens=False).ids for t in texts]
    return got


def test_added_tokens_against_the_library():
    assert same(queries.vocabulary("word_bpe_49k.json"), TEXTS)[0] == [49407]


@pytest.mark.parametrize("flags", [{}, {"normalized": True}, {"single_word": True}, {"lstrip": True, "rstrip": True}])
def test_added_tokens_of_any_kind(tmp_path, flags):
    known = json.load(open(queries.vocabulary("word_bpe_49k.json")))
    plain = {"single_word": False, "lstrip": False, "rstrip": False, "normalized": False, "special": False}
    known["added_tokens"] += [{"id": 49408 + n, "content": c, **plain, **flags} for n, c in enumerate(["marker", "two words", "[[]]"])]
    path = tmp_path / "added.json"
    path.write_text(json.dumps(known))
    same(str(path), [*TEXTS, "a marker here", "markers Marker MARKER", "no two words here", "two  words", "x[[]]y [[]]."])


def test_usual_texts_go_by_pieces_alone():
    rng = random.Random(4)
    usual = [chr(c) for c in [*range(1, 0x180), *range(0x2010, 0x2028), *range(0x2030, 0x205F), *range(0x20A0, 0x20C0)]]
    texts = ["".join(rng.choices(usual, k=rng.randrange(1, 60))) for _ in range(400)]
    texts += [f"x{c}y'{c}s {c}{c}1" for c in usual] + ["It's  the\tİstanbul\x1cǅ", "“don’t”—he’ll…", "é     日本"]
    same(queries.vocabulary("word_bpe_49k.json"), texts)
    code = wavelet.Encoder(queries.vocabulary("word_bpe_49k.json"))
    code.encode(["Every word, once; “each” piece… costs 5 €.".encode()])
    assert not code.words and {"every", "word", ",", "“", "€."} <= set(code.pieces)


def test_words_of_usual_texts_are_looked_up_once():
    texts = ["Every word, “once”; every word, “once”;\x85every word,\xa0once.", "a\x1cb c\x1fd", "a\u2028b"]
    same(queries.vocabulary("word_bpe_49k.json"), texts)
    code = wavelet.Encoder(queries.vocabulary("word_bpe_49k.json"))
    asked = []
    code.pieces.learn = lambda x, learn=code.pieces.learn: asked.append(x) or learn(x)
    code.encode([texts[0].encode()])
    assert len(asked) == len(set(asked)) and {"word,", "word", ",", "“once”;", "”;", "once."} <= set(asked)


def test_words_in_use_outlive_a_full_cache(monkeypatch):
    monkeypatch.setattr(wavelet, "CACHE_ENTRIES", 20)
    code = wavelet.Encoder(queries.vocabulary("word_bpe_49k.json"))
    asked = []
    code.pieces.learn = lambda x, learn=code.pieces.learn: asked.append(x) or learn(x)
    texts = [f"common {chr(97 + n // 26)}q{chr(97 + n % 26)}" for n in range(200)]
    got = code.encode([t.encode() for t in texts])
    assert asked.count("common") == 1 and len(code.pieces) + len(code.pieces.old) < 50
    from tokenizers import Tokenizer
    library = Tokenizer.from_file(queries.vocabulary("word_bpe_49k.json"))
    assert [np.frombuffer(x, code.kind).tolist() for x in got] == [library.encode(t, add_special_tokens=False).ids for t in texts]
