import tracemalloc

import numpy as np

from millrace.llm.words import BLOCK, NOT_ALNUM, words_of


def thue_morse(n, a, b):
    return (a, b) if not n else (lambda x, y: (x + y, y + x))(*thue_morse(n - 1, a, b))


def test_words_do_not_depend_on_blocks_or_neighbours():
    texts = ["A long" + "x" * (BLOCK + 3) + " word", "", " \t\n", "é" * 70 + " É", "a" * BLOCK, " " * (BLOCK - 1) + "edge of a block", "tail"]
    words = words_of(texts)
    for i, text in enumerate(texts):
        mine = [words.word(k) for k in range(words.first[i], words.first[i + 1])]
        assert mine == text.encode().lower().split()
        assert words.hashes[words.first[i]:words.first[i + 1]].tolist() == [words_of([w.decode()]).hashes[0] for w in mine]


def test_other_gaps():
    words = words_of(["a-b c_d1"], NOT_ALNUM)
    assert [words.word(k) for k in range(len(words.starts))] == [b"a", b"b", b"c", b"d1"]


def test_words_of_like_structure_have_different_hashes():
    hashes = words_of([*thue_morse(10, "a", "b"), "ab" * 512, "ba" * 512, "a" * 1024, "a" * 1023]).hashes
    assert len(np.unique(hashes)) == 6


def test_a_very_long_text_needs_a_few_times_its_bytes():
    text = "some words of a text " * 200_000
    words_of([text[:1000]])
    tracemalloc.start()
    words_of([text])
    peak = tracemalloc.get_traced_memory()[1]
    left = tracemalloc.get_traced_memory()[0]
    tracemalloc.stop()
    assert peak < 15 * len(text) and left < 1 << 20
