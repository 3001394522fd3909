import numpy as np
import pyarrow as pa
from hypothesis import example, given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from sheetwise.llm.tokens import WordTokenizer, tokenizer_path
from sheetwise.llm.words import run_hashes, slices, texts_of, word_codes, word_hashes

from .corpus import words

TEXTS = st.lists(st.none() | st.text(alphabet=st.sampled_from(list("abZ .,\t\n\x0b\x0c\r\x1c\x85 éÉßİΣς'½#|0１́字")) | st.characters(exclude_categories=["Cs"]), max_size=40), min_size=1, max_size=8)


@given(TEXTS, st.booleans(), st.integers(0, 3))
@settings(max_examples=150, deadline=None)
def test_words_are_those_of_the_pattern(texts, lower, skip):
    batch = pa.RecordBatch.from_pydict({"text": pa.array(["zz top"] * skip + texts, pa.string())}).slice(skip)
    codes, bounds, dictionary = word_codes(texts_of(batch, lower=lower))
    found = [w.encode() for w in dictionary.to_pylist()]
    for i, text in enumerate(texts):
        assert [found[c] for c in codes[bounds[i] : bounds[i + 1]]] == words(text, lower)


_ORACLE = Tokenizer.from_file(tokenizer_path())
_OURS = WordTokenizer(tokenizer_path())


@given(TEXTS)
@example(["Ünïcode ẞtraße İstanbul ﬁ ½ don't <|endoftext|> naïve-cóoperate x", "end. Of, A; SENTENCE!! it's º ª µ × ÷ Ÿ K\u212a"])
@settings(max_examples=200, deadline=None)
def test_ids_are_those_of_the_tokenizer_on_whole_texts(texts):
    batch = pa.RecordBatch.from_pydict({"text": pa.array(texts, pa.string())})
    ids, bounds, *_ = _OURS.encode(texts_of(batch), 2)
    for i, text in enumerate(texts):
        assert ids[bounds[i] : bounds[i + 1]].tolist() == [*_ORACLE.encode(text or "", add_special_tokens=False).ids, 2]


def test_hashes_tell_runs_apart():
    values = np.array([1, 2, 3, 1, 2, 3, 4], np.uint64)
    h = run_hashes(values, np.array([0, 3, 0, 1]), np.array([3, 6, 2, 3]))
    assert h[0] == h[1] and len(set(h.tolist())) == 3
    assert len(set(word_hashes(pa.array(["", "a", "b", "ab", "ba", "aa"])).tolist())) == 6


def test_slices_keep_all_rows():
    batch = pa.RecordBatch.from_pydict({"text": pa.array(["x" * 5, None, "y" * 50, "", "z"])})
    assert pa.Table.from_batches(list(slices(batch, "text", 10))).to_pydict() == batch.to_pydict()
