import re

import numpy as np
import pyarrow as pa
from hypothesis import given, settings
from hypothesis import strategies as st

from reelstat.llm.text import HashSet, shingles, slices, words

WORD = re.compile(rb"[^\x20\x09-\x0D]+")
character = st.sampled_from(list("ab AB\n\t\x0b\r\x0cé漢 .,"))


def batch(*texts):
    return pa.RecordBatch.from_arrays([pa.array(range(len(texts))), pa.array(texts, pa.string())], ["doc_id", "text"])


@settings(max_examples=60, deadline=None)
@given(st.lists(st.one_of(st.none(), st.text(character, max_size=40)), min_size=1, max_size=8), st.integers(1, 60))
def test_words_equal_the_rule_on_whole_texts(texts, most):
    seen, by_word = [], {}
    for part in slices(iter([batch(*texts)]), most=most):
        w = words(part)
        for i in range(len(part)):
            own = [part.data[a:b].tobytes() for a, b in zip(w.start[w.first[i] : w.first[i + 1]], w.end[w.first[i] : w.first[i + 1]], strict=True)]
            seen.append(own)
            for word, h in zip(own, w.hash[w.first[i] : w.first[i + 1]], strict=True):
                assert by_word.setdefault(word.lower(), h) == h
    assert seen == [WORD.findall((t or "").encode()) for t in texts]
    assert len(set(by_word.values())) == len(by_word)


def test_hashes_do_not_depend_on_the_place():
    long_ = "word " * 700_000 + "last " + "y" * 5_000_000 + " last"
    first, second = (words(p).hash for p in slices(iter([batch("last word", long_)])))
    assert len(second) == 700_003 and set(second[:700_000]) == {first[1]} and second[-1] == second[-3] == first[0]


def test_shingles_of_short_rows():
    part = next(slices(iter([batch("a b c d", "a b", "a", "", None, "A B")])))
    grams, offsets = shingles(words(part), 3)
    assert np.diff(offsets).tolist() == [2, 1, 1, 0, 0, 1]
    assert grams[offsets[1]] == grams[offsets[5]] and len(set(grams.tolist())) == 4


def test_a_batch_that_is_a_slice_of_another():
    parts = list(slices(iter([batch("a", None, "b c", "d").slice(1, 2)])))
    assert [p.text(i) for p in parts for i in range(len(p))] == [b"", b"b c"]


def test_hash_set():
    keys = np.sort(np.array([5, 1 << 63, 7 << 44], np.uint64))
    hit, at = HashSet(keys).find(np.array([4, 5, 1 << 63, 6 << 44], np.uint64))
    assert hit.tolist() == [1, 2] and keys[at].tolist() == [5, 1 << 63]
    assert len(HashSet(np.zeros(0, np.uint64)).find(keys)[0]) == 0
