"""Texts in chunks: what is encoded anew, and what memory their hashes take."""

import random
import re
import struct
import tracemalloc

import pyarrow as pa
from tokenizers import Tokenizer

from acctweave.llm import chunk_cache, packing, rolling


def test_a_word_is_encoded_once_whatever_follows_it():
    seen = []

    def encode(chunks):
        seen.extend(chunks)
        return [c.encode() for c in chunks]

    cache = chunk_cache.ChunkCache(encode, cores=True)
    texts = ["x word, word (word) wörd.\nword's", "word, word. wörd wordé", "", "a  word"]
    assert cache.texts(texts) == [t.encode() for t in texts]
    assert cache.texts(texts[::-1]) == [t.encode() for t in texts[::-1]]
    assert seen.count(" word") == 1 and seen.count(" wörd") == 1
    assert not {" word,", " word.", " wörd.\nword's"} & set(seen)


def test_a_word_takes_one_place_whatever_follows_it():
    cache = chunk_cache.ChunkCache(lambda chunks: [c.encode() for c in chunks], cores=True)
    texts = ["a word, word. word; word! (word) word's end.", "a word, <b> word,", "a word\x01, \x01 word \x01, word,"]
    for _ in range(2):
        assert cache.texts(texts[:1]) == [texts[0].encode()]
        assert sorted(c for c in cache.now if "word" in c) == ["(word", "word"]
    for _ in range(2):
        assert cache.texts(texts[::-1]) == [t.encode() for t in texts[::-1]]


def test_remembered_chunks_give_the_ids_of_whole_texts():
    draw = random.Random(5)
    parts = [*"abzAZÀéÿßŁɏɐªº×÷́'’stl.,!?#\n\t \xa0\x85\x1c019²_-<|>日яß€😀­\x7f\x00"]
    parts += ["<|endoftext|>", " ", " ", "'s", "'ll", " n't "]
    texts = ["".join(draw.choices(parts, k=draw.randrange(60))) for _ in range(5_000)]
    whole = Tokenizer.from_file(packing.TOKENIZER).encode_batch_fast(texts, add_special_tokens=False)
    want = [struct.pack(f"<{len(x.ids)}I", *x.ids) for x in whole]
    known = packing._tokenizer(packing.TOKENIZER, packing.END)
    assert known.texts(texts) == want and known.texts(texts) == want


def test_the_quick_search_for_white_space_finds_what_a_pattern_finds():
    every = [chr(i) for i in range(0x110000) if re.match(r"\s", chr(i))]
    for w in every:
        for text in (f"a {w}b", f"a{w} b", f"a{w}b c"):
            assert chunk_cache._near_space(text) == bool(re.search(r" \s|\s ", text))


def test_hashes_of_many_texts_take_little_memory():
    texts = pa.array(["word " * 200] * 5_000)
    tracemalloc.start()
    for start, stop in rolling.chunks(texts):
        rolling.word_hashes(texts.slice(start, stop - start))
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 30e6
