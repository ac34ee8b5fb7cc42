import numpy as np
import pyarrow as pa
import xxhash
from hypothesis import given, settings
from hypothesis import strategies as st

import brute
from quizlog.llm import bytetext as B
from quizlog.llm import subwords

TEXTS = st.lists(st.one_of(st.none(), st.text(max_size=60), st.text(alphabet="aB \t\n.'éß1<|>", max_size=80)), max_size=12)


@settings(max_examples=60, deadline=None)
@given(TEXTS)
def test_words_and_hashes(texts):
    arr = pa.array(texts, pa.string())
    for table, pattern in ((B.SPACE_WORDS, brute.SPACE), (B.ALNUM_WORDS, brute.ALNUM)):
        w = B.scan(arr, table)
        want = [pattern.findall(brute.lower(t)) for t in texts]
        data = w.data.tobytes()
        got = [data[a:b].decode() for a, b in zip(w.start.tolist(), w.end.tolist())]
        assert got == [x for ws in want for x in ws]
        assert w.counts.tolist() == [len(x) for x in want]
        h = B.word_hashes(w).tolist()
        assert len(set(zip(got, h))) == len(set(got)) == len(set(h))


@settings(max_examples=60, deadline=None)
@given(st.lists(st.binary(max_size=100), min_size=1, max_size=20))
def test_xxh64(parts):
    data = np.frombuffer(b"".join(parts), np.uint8)
    length = np.array([len(p) for p in parts])
    got = B.xxh64(data, np.cumsum(length) - length, length)
    assert got.tolist() == [xxhash.xxh64_intdigest(p, 42) for p in parts]


def test_xxh64_long():
    data = np.frombuffer(bytes(range(256)) * 40, np.uint8)
    for n in (31, 32, 33, 63, 64, 2047, 2048, 2049, 10000):
        assert B.xxh64(data, np.array([3]), np.array([n])).tolist() == [xxhash.xxh64_intdigest(data[3 : 3 + n].tobytes(), 42)]


def test_slices_cover_all_rows():
    batch = pa.record_batch([pa.array(["a" * n if n % 7 else None for n in range(300)])], ["text"])
    parts = list(B.slices(batch, "text", 500))
    assert pa.concat_arrays([p.column(0) for p in parts]).to_pylist() == batch.column(0).to_pylist()
    assert len(parts) > 3


@settings(max_examples=80, deadline=None)
@given(TEXTS)
def test_ids_equal_the_tokenizer(texts):
    from tokenizers import Tokenizer

    texts = [*texts, "<|endoftext|> x", "don't we'll-'s x'y ''s", "İIı ſ K é á", "a\x85b　c", "THE the The."]
    whole = Tokenizer.from_file(subwords.default_path())
    for some in (texts, texts[:-5] + texts[-4:]):  # with and without a special string
        ids, off = subwords.document_ids(pa.array(some, pa.string()), subwords.default_path())
        for i, t in enumerate(some):
            assert ids[off[i] : off[i + 1]].tolist() == whole.encode(t or "", add_special_tokens=False).ids + [0]
