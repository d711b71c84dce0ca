import re

import pyarrow as pa
import pyarrow.compute as pc
from hypothesis import given, settings
from hypothesis import strategies as st

from wattloom.llm.arrowtext import WORD, blocks, filled, split_words
from wattloom.llm.near_dedup import shingle_sets

TEXTS = st.lists(st.none() | st.text(alphabet=st.sampled_from(list("aB \n\t\x0b\x1c\x85\xa0É漢😀.")), max_size=12), max_size=12)


def lower(text):
    return re.sub("[A-Z]", lambda m: m[0].lower(), text or "")


@settings(max_examples=300, deadline=None)
@given(TEXTS, st.integers(1, 40))
def test_words_of_every_block(texts, limit):
    batch = pa.record_batch([pa.array(range(len(texts)), pa.int64()), pa.array(texts, pa.string())], names=["i", "t"])
    seen = []
    for block in blocks([batch], 1, limit):
        words, starts = split_words(pc.ascii_lower(filled(block.column(1))))
        words.validate(full=True)
        listed = words.to_pylist()
        seen += [listed[a:b] for a, b in zip(starts[:-1], starts[1:])]
        assert block.num_rows == 1 or sum(len((t or "").encode()) for t in block.column(1).to_pylist()) <= limit
    assert seen == [re.findall(WORD, lower(t)) for t in texts]


@settings(max_examples=100, deadline=None)
@given(TEXTS, st.integers(1, 40), st.integers(1, 3))
def test_shingle_sets_do_not_depend_on_blocks(texts, limit, size):
    batch = pa.record_batch([pa.array(texts, pa.string())], names=["t"])
    whole = [list(s) for s in shingle_sets(batch.column(0), size)]
    cut = [list(s) for block in blocks([batch], 0, limit) for s in shingle_sets(block.column(0), size)]
    assert cut == whole
    count = lambda w: len(set(zip(*(w[k:] for k in range(size))))) if len(w) >= size else int(bool(w))
    assert [len(s) for s in whole] == [count(re.findall(WORD, lower(t))) for t in texts]
