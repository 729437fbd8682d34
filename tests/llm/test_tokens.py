import hashlib
import io
import struct
import zlib

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from lodestack.llm import records
from lodestack.llm.memo import Memo
from lodestack.llm.sentencepiece_codec import Codec, Mismatch, encode_decode

from .conftest import multiset

PIECES, WORDS = public_tokenizers.path("piece_bpe_32k.model"), public_tokenizers.path("word_bpe_49k.json")
LIBRARY = sentencepiece.SentencePieceProcessor(model_file=PIECES)
CODEC = Codec(PIECES, 64)
ODD = st.text(st.sampled_from(list("abcXYZéñßİΣ  \n\t.,!?'\"0123٣²½Ⅷ▁_—梦́\x00<s>का \x1c🙂")), max_size=40)


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


@settings(max_examples=400, deadline=None)
@given(st.one_of(ODD, st.text(max_size=60)))
def test_agenda_equals_library(text):
    ids = LIBRARY.encode(text)
    assert CODEC.encode(text) == ids
    if ids:
        assert CODEC.decode(ids) == LIBRARY.decode(ids)
    assert CODEC.decimals(ids) == ",".join(map(str, ids))


def test_long_segments_use_the_heap():
    for text in ("ab" * 5000, "the" * 3000, "x" * 20000, " " * 999 + "a", "▁" * 77):
        assert CODEC.encode(text) == LIBRARY.encode(text)


def test_cuts_never_part_a_piece():
    for piece in list(CODEC.ids)[:32000]:
        assert len([p for p in CODEC.cut.findall(piece) if p]) == 1, piece


def test_check_notices_a_difference():
    codec = Codec(PIECES)
    codec.encode_many(["a"])
    codec.fresh.append(("the", np.array([5, 6], codec.kind).tobytes()))
    with pytest.raises(Mismatch):
        codec.check_fresh()


def test_memo_is_bounded():
    made = []
    memo = Memo(lambda k: made.append(k) or k.upper(), 3)
    assert [memo[k] for k in "abcabcd"] == list("ABCABCD")
    assert len(memo) <= 3 and memo["a"] == "A"
    assert memo.renew("zz") is False


@pytest.mark.parametrize("check", ["runs", "texts"])
def test_encode_decode(odd, check):
    rows = [(r.doc_id, r.text or "") for r in odd.collect()]
    got = encode_decode(odd, PIECES, check=check, keep_ids=True, keep_text=True)
    assert got.columns == ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256", "ids", "decoded"]
    want = []
    for i, t in rows:
        ids = LIBRARY.encode(t)
        decoded = LIBRARY.decode(ids) if ids else ""
        want.append((i, len(ids), sha(",".join(map(str, ids))), sha(decoded), ids, decoded))
    assert multiset(tuple(r) for r in got.collect()) == multiset(want)


def test_encode_decode_of_nothing(empty):
    assert encode_decode(empty, PIECES).count() == 0


# Records


def test_frames():
    frames = [records.frame_record(p) for p in (b"", b"abc", b"\x00" * 1000)]
    assert frames[1][:8] == struct.pack("<Q", 3)
    crc = zlib.crc32(b"abc")
    assert frames[1][-4:] == struct.pack("<I", ((crc >> 15 | crc << 17) + 0xA282EAD8) & 0xFFFFFFFF)
    data = b"".join(frames)
    found = list(records.read_records(io.BytesIO(data)))
    assert [p for _, p in found] == [b"", b"abc", b"\x00" * 1000]
    assert records.read_record(io.BytesIO(data), found[2][0]) == b"\x00" * 1000
    for k in range(0, len(frames[0]) + len(frames[1]), 3):
        broken = bytearray(data)
        broken[k] ^= 1
        with pytest.raises(records.Damaged):
            list(records.read_records(io.BytesIO(bytes(broken))))
    with pytest.raises(records.Damaged):
        list(records.read_records(io.BytesIO(data[:-1])))


WORDS_CODEC, WORDS_LIBRARY = records.Tokens(WORDS), Tokenizer.from_file(WORDS)


@settings(max_examples=300, deadline=None)
@given(st.lists(st.one_of(ODD, st.text(max_size=30), st.sampled_from(["<|endoftext|>x", "it's we'll", "Éa, ßx.", "á"])), max_size=5))
def test_chunks_equal_whole_texts(texts):
    want = [e.ids for e in WORDS_LIBRARY.encode_batch(texts, add_special_tokens=False)]
    assert [np.frombuffer(x, "<u2").tolist() for x in WORDS_CODEC.encode(texts)] == want


def test_other_tokenizers_are_encoded_whole():
    other = records.Tokens(public_tokenizers.path("byte_bpe_50k.json"))
    assert other.whole
    text = "Hello  world, it's\n\nfine"
    assert np.frombuffer(other.encode([text])[0], "<u2").tolist() == other.tokenizer.encode(text, add_special_tokens=False).ids


def test_round_trip(spark, odd):
    rows = sorted(((r.doc_id, r.text or "") for r in odd.collect()), key=lambda r: (r[0] is not None, r[0] or 0))
    made = records.write(odd, WORDS, end_id=1, parts=3)
    got = sorted(made.scan(spark).collect(), key=lambda r: r.start)
    assert [r.key for r in got] == [i for i, _ in rows]
    at = 0
    for r in got:
        assert r.start == at
        at += r.n_tokens
    want = []
    for i, t in rows:
        ids = [*WORDS_LIBRARY.encode(t, add_special_tokens=False).ids, 1]
        want.append((i, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
    assert multiset((r.key, r.n_tokens, r.ids_crc32) for r in got) == multiset(want)
    one = next(r for r in made.index(spark).collect() if r.key == 8)
    with open(one.file.removeprefix("file:"), "rb") as f:
        key, ids = records.unpack_ids(records.read_record(f, one.offset))
    assert key == 8 and len(ids) == one.n_tokens and ids[-1] == 1


def test_records_of_nothing(spark, empty):
    assert records.round_trip(empty, WORDS).count() == 0


def test_registered(spark, folder, documents):
    from lodestack.llm.registry import QUERIES

    got = QUERIES["op3_token_records"](spark, folder).collect()
    assert len(got) == documents.count() and min(r.start for r in got) == 0
    assert QUERIES["op1_sentencepiece"](spark, folder).count() == len(got)
