import hashlib
import random
import struct

import public_tokenizers
import pytest
import tiktoken
from hypothesis import given, settings
from hypothesis import strategies as st

from shoal.llm import bpe
from tests.llm import cases

PATH = public_tokenizers.path("byte_bpe_50k.tiktoken")
RANKS = bpe.load_ranks(PATH)
PLAIN = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=RANKS, special_tokens={})
CODEC = bpe.Codec(RANKS, public_tokenizers.PATTERN)


@settings(max_examples=300, deadline=None)
@given(st.text(max_size=200))
def test_any_text(text):
    packed = CODEC.encode(text)
    assert list(struct.unpack(f"<{len(packed) // 4}I", packed)) == PLAIN.encode_ordinary(text)
    assert CODEC.decode(packed) == text


@pytest.mark.parametrize("states", [1, 50, 100_000])
def test_flushing_the_machine_changes_nothing(states):
    fst = bpe.Transducer(RANKS, max_states=states)
    rng = random.Random(4)
    for _ in range(300):
        data = bytes(rng.choice(b"  aabtheinghtions09\xc3\xa9\xf0\x9f\x99\x82") for _ in range(rng.randint(0, 60)))
        want = [RANKS[p] for p in bpe.merge_bytes(data, RANKS)] if data not in RANKS else [RANKS[data]]
        assert fst.encode(data) == want


def test_long_piece_without_break():
    text = "ab" * 20_000 + " " * 5000 + "🙂" * 3000
    assert list(memoryview(CODEC.encode(text)).cast("I")) == PLAIN.encode_ordinary(text)


def test_tokens_come_out_before_the_piece_ends():
    fst = bpe.Transducer(RANKS)
    for word in ("the", "a", " ", "\u00e9", "ab1", "0"):
        read = 0

        def data(text=(word * 3000).encode()):
            nonlocal read
            for byte in text:
                read += 1
                yield byte

        done, ids = 0, []
        for part in fst.stream(data()):
            ids += part
            done += sum(map(fst.sizes.get, part))
            assert read - done <= bpe.LOOKAHEAD  # what is pending stays short
        assert ids == [RANKS[p] for p in bpe.merge_bytes((word * 3000).encode()[:0], RANKS)] + PLAIN._encode_single_piece((word * 3000).encode())


def test_decoder_holds_unfinished_code_points():
    tokens = {k: bytes([k]) for k in range(256)}
    data = "é漢🙂".encode()
    parts = list(bpe.Utf8Decoder(tokens).decode(data, 1))
    assert "".join(parts) == "é漢🙂" and parts[0] == "" and len(parts) == len(data)
    assert "".join(bpe.Utf8Decoder(tokens).decode(data[:-1], 2)) == "é漢" + data[5:-1].decode("utf-8", "replace")
    assert "".join(bpe.Utf8Decoder(tokens).decode(b"a\xff\xc3b")) == b"a\xff\xc3b".decode("utf-8", "replace")


def test_operator(spark):
    df = cases.docs(spark)
    got = bpe.token_digests(df, PATH, public_tokenizers.PATTERN).collect()
    want = []
    for r in cases.rows():
        ids = PLAIN.encode_ordinary(r[1] or "")
        want.append((r[0], len(ids), hashlib.sha256(struct.pack(f"<{len(ids)}I", *ids)).hexdigest(),
                     hashlib.sha256((r[1] or "").encode()).hexdigest()))
    order = lambda t: (t[0] is None, t[0] or 0, t[2])
    assert sorted(map(tuple, got), key=order) == sorted(want, key=order)
    back = bpe.decode(bpe.encode(df, PATH, public_tokenizers.PATTERN), PATH, public_tokenizers.PATTERN).collect()
    assert sorted(r.text for r in back) == sorted(r[1] or "" for r in cases.rows())


def test_empty_table(spark):
    assert bpe.token_digests(cases.empty(spark), PATH, public_tokenizers.PATTERN).count() == 0
