import random
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
import tiktoken

from wordloom.llm import common, distinct_words

PATH = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")


@pytest.fixture(scope="module")
def library():
    ranks = distinct_words._ranks(PATH)
    return tiktoken.Encoding("whole", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks,
                             special_tokens={})


def test_pieces_make_the_text(library):
    rng = random.Random(11)
    alphabet = " \n\t\xa0\x1c　\x85​ab'sleévdm.,1٣½#中<|>\U0001f600́\x00"
    words = distinct_words.Words(public_tokenizers.PATTERN)
    texts = ["".join(rng.choices(alphabet, weights=[12] + [1] * (len(alphabet) - 1), k=14))
             for _ in range(5000)]
    # Letters, marks, numbers and blanks of all planes that are not very new.
    texts += [" ".join(chr(c) for c in range(k, k + 40) if not 0xD800 <= c < 0xE000)
              for k in range(0, 0x30000, 40)]
    for text in texts:
        codes = np.frombuffer(words.of(text), "<u4")
        known = list(words.codes)
        ids = [i for c in codes.tolist() for i in library.encode_ordinary(known[c])]
        assert ids == library.encode_ordinary(text), repr(text)
        if len(known) > 20000:
            words = distinct_words.Words(public_tokenizers.PATTERN)


@pytest.mark.parametrize("chars", [50, 32 << 20])
def test_all_documents(awkward, real, library, monkeypatch, chars):
    monkeypatch.setattr(distinct_words, "BLOCK_CHARS", chars)
    monkeypatch.setattr(distinct_words, "REMEMBERED", chars // 10)
    for docs in (awkward, real.limit(60)) if chars == 50 else (awkward, real):
        docs = docs.coalesce(3)
        found = distinct_words.encode_and_decode(docs, PATH, public_tokenizers.PATTERN).collect()
        expected = Counter()
        for r in docs.collect():
            ids = library.encode_ordinary(r.text or "")
            expected[r.doc_id, len(ids), np.array(ids, "<u4").tobytes(), (r.text or "").encode()] += 1
        assert Counter((r.doc_id, r.n_tokens, bytes(r.ids), bytes(r.decoded)) for r in found) == expected


def test_no_documents(nothing):
    found = distinct_words.encode_and_decode(nothing, PATH, public_tokenizers.PATTERN)
    assert found.columns == ["doc_id", "n_tokens", "ids", "decoded"]
    assert found.count() == 0


def test_packed_values():
    rng = np.random.default_rng(2)
    for values in ([], [0], [2**64 - 1, 0, 5], rng.integers(0, 70000, 1000)):
        values = np.array(values, np.uint64)
        assert (common.unpack_numbers(common.pack_numbers(values)) == values).all()
    for strings in ([], [b""], [b"a", b"", b"\x00b" * 9]):
        assert common.unpack_strings(common.pack_strings(strings)) == strings


def test_lists_are_gathered():
    flat, sizes = np.arange(10, 20), np.array([3, 0, 2, 5])
    ends = common.list_ends(sizes)
    assert ends.tolist() == [0, 3, 3, 5, 10]
    for chosen, found in (([], []), ([1], []), ([2, 0, 1, 2], [13, 14, 10, 11, 12, 13, 14])):
        assert common.gathered(flat, ends, np.array(chosen, np.uint32)).tolist() == found


def test_ends_are_made_once_a_block(monkeypatch):
    """They were summed up for every document: documents times distinct words of a block."""
    import pyarrow as pa

    texts = [f"w{k} x" for k in range(50)]
    monkeypatch.setattr(distinct_words.TaskContext, "get", lambda: type("", (), {
        "partitionId": staticmethod(lambda: 0)}))
    batch = pa.RecordBatch.from_pydict({"doc_id": list(range(50)), "text": texts})
    rows = list(distinct_words.block_rows([batch], public_tokenizers.PATTERN, 3))
    packs = distinct_words._table(rows[1:], distinct_words._BLOCKS)
    replies = distinct_words._table(list(distinct_words.answers(
        packs.to_batches(), PATH, public_tokenizers.PATTERN)), distinct_words._ANSWERS)
    distinct_words.token_bytes(PATH)
    made = []
    monkeypatch.setattr(distinct_words, "list_ends",
                        lambda sizes: made.append(len(sizes)) or common.list_ends(sizes))
    found = list(distinct_words.reassembled(
        distinct_words._table(rows[:1], distinct_words._BLOCKS), replies, PATH))
    assert [r[3].decode() for r in found] == texts and len(made) == 1
