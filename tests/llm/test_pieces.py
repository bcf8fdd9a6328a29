import hashlib
import random

import public_tokenizers
import pytest
import sentencepiece
from conftest import awkward_texts

from wordloom.llm import pieces
from wordloom.llm.queries import QUERIES

MODEL = public_tokenizers.path("piece_bpe_32k.model")
ALPHABET = "abcdeABC  \n\t▁▁ ,.019éß中文мир\U0001f600\0́<s></s>"


@pytest.fixture(scope="module")
def texts():
    rng = random.Random(1)
    made = ["".join(rng.choice(ALPHABET) for _ in range(rng.randrange(60))) for _ in range(1500)]
    return [t or "" for t in awkward_texts()] + made + [
        "x" * 3000, " " * 2000, "▁" * 300, "中" * 2000, "ab" * 2000, "<0x41>", "a\0", "\0\0"]


@pytest.fixture(scope="module")
def library():
    return sentencepiece.SentencePieceProcessor(model_file=MODEL)


def same_as_library(coder, library, text):
    ids, begins, ends = coder.encode(text)
    found = library.encode(text, return_type="proto").pieces
    assert ids.tolist() == [p.id for p in found], text[:80]
    assert begins.tolist() == [p.begin for p in found], text[:80]
    assert ends.tolist() == [p.end for p in found], text[:80]


def test_ids_and_spans_are_those_of_the_library(texts, library, real):
    coder = pieces.Encoder(MODEL)
    for text in texts + [r.text for r in real.collect()]:
        same_as_library(coder, library, text)


def test_short_and_long_parts_merge_alike(texts, library, monkeypatch):
    monkeypatch.setattr(pieces, "SHORT_PART_CHARS", 0)
    monkeypatch.setattr(pieces, "CACHE_PARTS", 100)
    coder = pieces.Encoder(MODEL)
    for text in texts[:400]:
        same_as_library(coder, library, text)


@pytest.mark.parametrize("rule", ["nmt_nfkc", "nfkc", "nmt_nfkc_cf", "nfkc_cf", "identity"])
@pytest.mark.parametrize("squeeze", [True, False])
@pytest.mark.parametrize("prefix", [True, False])
def test_compiled_character_maps(texts, rule, squeeze, prefix):
    theirs = sentencepiece.SentencePieceNormalizer(
        rule_name=rule, add_dummy_prefix=prefix, escape_whitespaces=True,
        remove_extra_whitespaces=squeeze)
    ours = pieces.Normalizer(theirs.serialized_model_proto())
    more = ["  Ｈello  ﬁne ①  ", "ﬁﬁ　 x", "が が ㍿", "​ ​", "ｶﾞ Å", "▁ ▁", " a▁ "]
    for text in [t for t in texts if len(t) < 5000] + more:
        normal, places = theirs.Normalize(text, with_offsets=True)
        byte_of = [0]
        for char in text:
            byte_of.append(byte_of[-1] + len(char.encode()))
        found, source = ours(text)
        assert found == normal, text
        assert source.tolist() == [byte_of[k] for k in places], text


def test_rows(spark, awkward, nothing, library):
    rows = pieces.encode_and_decode(awkward, MODEL).collect()
    wanted = sorted((r.doc_id or -1, library.encode(r.text or "")) for r in awkward.collect())
    assert sorted((r.doc_id or -1, r.ids) for r in rows) == wanted
    sources = {}
    for r in awkward.collect():
        sources.setdefault(r.doc_id, set()).add((r.text or "").encode())
    for r in rows:
        assert r.decoded == library.decode(r.ids)
        # The spans, end to end, are the source.
        assert any(b"".join(s[a:b] for a, b in zip(r.begins, r.ends)) == s
                   for s in sources[r.doc_id])
    assert pieces.encode_and_decode(nothing, MODEL).collect() == []


def test_other_models_are_refused(tmp_path):
    def field(number, kind, value):
        return bytes([number << 3 | kind]) + value

    trainer = field(3, 0, b"\x01")  # a unigram model
    piece = field(1, 2, b"\x05<unk>") + field(3, 0, b"\x02")
    letter = field(1, 2, b"\x01a") + field(2, 5, b"\0\0\0\0")
    model = b"".join(field(n, 2, bytes([len(v)]) + v) for n, v in (
        (1, piece), (1, letter), (2, trainer)))
    (tmp_path / "m.model").write_bytes(model)
    with pytest.raises(ValueError, match="BPE"):
        pieces.Encoder(str(tmp_path / "m.model"))


def test_query(spark, real, real_sf, library):
    digest = lambda text: hashlib.sha256(text.encode()).hexdigest()
    wanted = {}
    for r in real.collect():
        ids = library.encode(r.text or "")
        wanted[r.doc_id] = (len(ids), digest(",".join(map(str, ids))), digest(library.decode(ids)),
                            len((r.text or "").encode()))
    found = QUERIES["op13_spanned_pieces"](spark, real_sf).collect()
    assert {r.doc_id: tuple(r)[1:] for r in found} == wanted and len(found) == len(wanted)
