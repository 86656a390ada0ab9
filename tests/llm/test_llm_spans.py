import random
import re

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from tokenizers import Tokenizer

from platelake.llm import spans, tokens

PATH = public_tokenizers.path("word_bpe_49k.json")
ODD = list("aB c\n\t#|!é'1,–Z\x0b«»ñß中文 ́İΣςK  …€🙂’\"-_<>") + ["<|endoftext|>", "<|EndOfText|>", "'s", "'LL", "http://"]


def odd_texts(n, seed):
    rnd = random.Random(seed)
    return ["".join(rnd.choice(ODD) for _ in range(rnd.choice([0, 1, 3, 30, 200]))) for _ in range(n)] + [None, ""]


def test_words_and_lines():
    texts = odd_texts(200, 1)
    t = spans.texts_of(pa.array(texts))
    raw = t.data.tobytes()
    for find, pattern in ((spans.words, rb"[^\x20\x09-\x0D]+"), (spans.lines, rb"[^\n]+")):
        found = find(t)
        for i, text in enumerate(texts):
            own = range(found.first[i], found.first[i + 1])
            assert [raw[found.start[j] : found.start[j] + found.length[j]] for j in own] == re.findall(pattern, (text or "").encode())


def test_slices_of_arrow_columns():
    column = pa.array(["skip", "ab cd", None, "ef"]).slice(1)
    assert spans.words(spans.texts_of(column)).counts().tolist() == [2, 0, 1]
    parts = list(spans.chunked([pa.RecordBatch.from_pydict({"t": ["a" * 50, None, "b" * 10, "c" * 200]})], "t", limit=64))
    assert [p.num_rows for p in parts] == [3, 1]


def test_hashes_follow_content():
    t = spans.texts_of(pa.array(["abc abc abcdefgh abcdefghi", "abc " + "x" * 2000, "x" * 2000 + " y"]))
    h = spans.hashes(t.data, spans.words(t))
    assert h[0] == h[1] == h[4] and h[5] == h[6] and len(set(h.tolist())) == 5


def test_ngrams_stay_in_their_text():
    t = spans.texts_of(pa.array(["a b c", "", "a b", "a b c d"]))
    found = spans.words(t)
    grams, at, owner = spans.ngrams(spans.hashes(t.data, found), found.first, 3)
    assert owner.tolist() == [0, 3, 3] and at.tolist() == [0, 5, 6]
    assert grams[0] == grams[1] != grams[2]


@pytest.mark.parametrize("seed", [3, 4])
def test_unit_encoding_is_whole_text_encoding(seed):
    plain, own = Tokenizer.from_file(PATH), tokens.UnitEncoder(PATH)
    texts = odd_texts(400, seed)
    for k in range(0, len(texts), 40):
        ids, offsets = own.encode_column(pa.array(texts[k : k + 40]))
        for i, text in enumerate(texts[k : k + 40]):
            assert ids[offsets[i] : offsets[i + 1]].tolist() == plain.encode(text or "", add_special_tokens=False).ids + [1], text


def test_encoder_forgets_and_learns_again(monkeypatch):
    monkeypatch.setattr(tokens, "REMEMBERED", 3)
    own = tokens.UnitEncoder(PATH)
    first, _ = own.encode_column(pa.array(["one two three four five"]))
    own.encode_column(pa.array(["six seven eight nine"]))
    again, _ = own.encode_column(pa.array(["one two three four five"]))
    assert np.array_equal(first, again)
