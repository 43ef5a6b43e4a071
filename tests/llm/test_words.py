import random
import re

import numpy as np
import pyarrow as pa
import pytest

from wakeframe.llm.bagminhash import bands, signatures
from wakeframe.llm.words import blocks, grams, texts_of, words_of

WORD = re.compile(r"[^\x20\x09-\x0D]+")
LETTERS = "ab é中\n\t \x0b.\x1c "


def some_texts(n, seed=1, longest=40):
    r = random.Random(seed)
    return [None if r.random() < 0.1 else "".join(r.choice(LETTERS) for _ in range(r.randint(0, longest))) for _ in range(n)]


@pytest.mark.parametrize("size", [1, 50, 1 << 20])
def test_words_equal_the_pattern(size):
    texts = some_texts(300)
    column = texts_of(pa.array(texts, pa.string()))
    found = [[] for _ in texts]
    for first, last in blocks(column, size):
        words = words_of(column, first, last)
        for row, a, b in zip(words.row, words.start, words.end, strict=True):
            found[row].append(column.data[a:b].tobytes().decode())
    assert found == [WORD.findall(t or "") for t in texts]


def test_hashes_depend_on_the_word_alone():
    texts = some_texts(500, longest=9) + ["x" * 3_000_000 + " tail " + "y" * 10]
    column = texts_of(pa.array(texts, pa.string()))
    seen = {}
    for first, last in blocks(column, 200):
        words = words_of(column, first, last)
        for a, b, h in zip(words.start, words.end, words.hash, strict=True):
            assert seen.setdefault(column.data[a:b].tobytes(), h) == h
    assert len(set(seen.values())) == len(seen)


def test_grams():
    column = texts_of(pa.array(["a b c d", "a b", "", "x a b c d", "a b"]))
    row, gram = grams(words_of(column), 3)
    assert row.tolist() == [0, 0, 1, 3, 3, 3, 4]
    assert gram[2] == gram[6] and set(gram[:2]) == set(gram[4:6])


def test_sliced_and_null_columns():
    column = pa.array(["zz", None, "a b", "c"])[1:]
    words = words_of(texts_of(column))
    assert words.row.tolist() == [1, 1, 2]


def test_signatures_estimate_weighted_similarity():
    r = np.random.default_rng(5)
    weights = r.integers(0, 6, (2, 60))
    weights[1] = np.where(r.random(60) < 0.7, weights[0], weights[1])
    wanted = np.minimum(*weights).sum() / np.maximum(*weights).sum()
    hits = []
    for seed in range(30):
        bag, element = np.nonzero(weights)
        element = element.astype(np.uint64) + np.uint64(1000 * seed)
        s = signatures(bag, element, weights[weights > 0], 2, 128)
        hits.append((s[0] == s[1]).mean())
    assert abs(np.mean(hits) - wanted) < 0.03


def test_signatures_of_empty_and_single_bags():
    s = signatures(np.array([1]), np.array([7], dtype=np.uint64), np.array([3]), 3, 16)
    assert not s[0].any() and s[1].all() and not s[2].any()
    assert bands(s, 4).shape == (3, 4)
