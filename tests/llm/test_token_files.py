import random
import zlib

import numpy as np
import public_tokenizers
import pytest
import zstandard
from tokenizers import Tokenizer

from wordloom.llm import encoder, packing, planes

PATH = public_tokenizers.path("byte_bpe_50k.json")


@pytest.fixture(scope="module")
def library():
    tokenizer = Tokenizer.from_file(PATH)
    return lambda text: tokenizer.encode(text or "", add_special_tokens=False).ids


def words(ids):
    return np.array(ids, "<u4").tobytes()


def test_words_make_the_text(library, awkward, real):
    encode = encoder.Encoder(PATH).encode
    rng = random.Random(3)
    texts = [r.text or "" for r in awkward.collect()] + [r.text for r in real.collect()[:60]]
    alphabet = " \n\t\xa0\x1c　ab'sl.,1#é中<|>"
    texts += ["".join(rng.choices(alphabet, weights=[9] + [1] * (len(alphabet) - 1), k=12))
              for _ in range(4000)]
    for text in texts:
        assert encode(text) == words(library(text)), repr(text)


@pytest.mark.parametrize("alphabet", [
    " \n\n ab'sZ.,12#éßжÑ²¼ªßא؀\u0301", "aé.\n' s\r²", " \t\x0b\x85\xa0\x1cab1.\0", " 中aé\n.\U0001f600'll"])
def test_line_breaks_and_letters_beyond_ascii(library, alphabet):
    encode = encoder.Encoder(PATH).encode
    rng = random.Random(alphabet)
    for n in (6, 14, 40):
        for _ in range(1500):
            text = "".join(rng.choices(alphabet, k=n))
            assert encode(text) == words(library(text)), repr(text)


def test_every_known_character(library):
    encode = encoder.Encoder(PATH).encode
    for c in map(chr, range(0x700)):
        text = f" x{c}y{c}{c}1{c} {c}"
        assert encode(text) == words(library(text)), repr(text)


def test_full_cache_changes_nothing(library, monkeypatch, real):
    monkeypatch.setattr(encoder, "CACHE_PIECES", 5)
    monkeypatch.setattr(encoder, "CACHE_PARTS", 5)
    monkeypatch.setattr(encoder, "CHUNK_CHARS", 50)
    encode = encoder.Encoder(PATH).encode
    for text in [r.text for r in real.collect()[:20]] + ["中 a" * 90, "a  b \n" * 60]:
        assert encode(text) == words(library(text))


@pytest.mark.parametrize("kind", ["byte", "bit"])
def test_planes_round_trip(kind):
    rng = np.random.default_rng(1)
    for n, top in ((0, 9), (1, 1), (7, 300), (1001, 50257), (64, 2**32 - 1)):
        ids = rng.integers(0, top, n, dtype=np.uint32)
        assert (planes.from_planes(planes.to_planes(ids, kind), n, kind) == ids).all()


def in_order(rows):
    return sorted(rows, key=lambda r: (r.doc_id is not None, r.doc_id or 0, r.text or ""))


@pytest.mark.parametrize("kind", ["byte", "bit"])
def test_files_hold_all_documents(spark, awkward, library, tmp_path, monkeypatch, kind):
    monkeypatch.setattr(planes, "CHUNK_IDS", 1000)
    files = planes.write_ids(awkward, str(tmp_path), PATH, 2, kind=kind)
    rows = sorted(planes.read_ids(files).collect(), key=lambda r: r.start)
    start = 0
    for r in rows:
        assert (r.start, r.n_tokens) == (start, len(r.ids) // 4)
        start += r.n_tokens
    expected = sorted(
        (str(r.doc_id), words([*library(r.text), 2])) for r in awkward.collect()
    )
    assert sorted((str(r.doc_id), bytes(r.ids)) for r in rows) == expected
    order = [r.doc_id for r in rows]
    assert order[0] is None and order[1:] == sorted(order[1:])
    assert files.selectExpr("sum(n_ids)").first()[0] == start


def test_no_documents(nothing, tmp_path):
    files = planes.write_ids(nothing, str(tmp_path), PATH, 2)
    assert (files.count(), planes.read_ids(files).count()) == (0, 0)
    assert packing.pack(nothing, PATH, 1).count() == 0


def test_damage_is_found(spark, awkward, tmp_path):
    files = planes.write_ids(awkward, str(tmp_path), PATH, 2)
    path = max(files.collect(), key=lambda r: r.n_ids).path
    data = bytearray(open(path, "rb").read())
    data[20] ^= 255
    open(path, "wb").write(data)
    with pytest.raises((ValueError, zstandard.ZstdError), match="damaged|decompression error"):
        list(planes.read_planes(path))


def test_hilbert_curve_visits_neighbours():
    for axes, bits in ((2, 4), (3, 3)):
        grid = np.stack(np.meshgrid(*[np.arange(1 << bits)] * axes), -1).reshape(-1, axes)
        keys = packing.hilbert_keys(grid, bits)
        assert sorted(keys.tolist()) == list(range(len(grid)))
        path = grid[np.argsort(keys)]
        assert (np.abs(np.diff(path, axis=0)).sum(axis=1) == 1).all()


def test_packing_places_every_id_once(awkward, real, library):
    for docs, size in ((awkward, 64), (real, 2048)):
        pieces = packing.pack(docs, PATH, 1, sequence=size).collect()
        sequences = {}
        documents = {}
        for p in pieces:
            assert len(p.ids) == 4 * p.length > 0
            sequences.setdefault(p.sequence_id, []).append((p.offset, p.length))
            documents.setdefault(p.doc_id, []).append((p.start, p.length, bytes(p.ids), p.doc_tokens))
        assert sorted(sequences) == list(range(len(sequences)))
        for s, inside in sequences.items():
            at = 0
            for offset, length in sorted(inside):
                assert offset == at
                at += length
            assert at == size or s == len(sequences) - 1 and at < size
        texts = {}
        for r in docs.collect():
            texts.setdefault(r.doc_id, []).append(words([*library(r.text), 1]))
        assert set(documents) == set(texts)
        for doc_id, copies in texts.items():
            parts = sorted(documents[doc_id])
            assert sum(p[1] for p in parts) * 4 == sum(map(len, copies))
            if len(copies) == 1:
                assert b"".join(p[2] for p in parts) == copies[0]
                assert {p[3] for p in parts} == {len(copies[0]) // 4}
                assert zlib.crc32(b"".join(p[2] for p in parts)) == zlib.crc32(copies[0])


def test_like_texts_are_neighbours(spark):
    texts = [" ".join(["red", "green", "blue", str(i)] * 20) for i in range(20)]
    texts += [" ".join(["uno", "dos", "tres", str(i)] * 20) for i in range(20)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    pieces = packing.pack(docs, PATH, 1).collect()
    order = [p.doc_id for p in sorted(pieces, key=lambda p: (p.sequence_id, p.offset))]
    order = list(dict.fromkeys(order))
    changes = sum((a < 20) != (b < 20) for a, b in zip(order, order[1:]))
    assert changes <= 6
