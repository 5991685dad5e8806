import hashlib
import random

import numpy as np
import pytest

from sparkloom.llm import pieces
from sparkloom.llm.queries import piece_model


@pytest.fixture(scope="module")
def encoder():
    return pieces.PieceEncoder(piece_model())


PARTS = list("abcdeghilnorst  ▁\n\té漢ñ🙂<s>0x\u200bİKß\u00a0\x00") + ["the", "ing", "    ", "tion", "<0x0A>", " " * 17, "▁▁▁", "</s>", "\ufffd"]


def test_ids_equal_the_library(encoder):
    rng = random.Random(1)
    for _ in range(5000):
        text = "".join(rng.choice(PARTS) for _ in range(rng.randint(0, 40)))
        want = encoder.library.encode(text, add_bos=True, add_eos=True)
        packed = encoder.encode(text)
        assert np.frombuffer(packed, "<u4").tolist() == want, text
        assert encoder.decode(packed) == encoder.library.decode(want)


def test_long_runs(encoder):
    for text in ("a" * 20_000, "ab" * 10_000, " " * 5000, "漢字" * 3000, "\U0001f642" * 2000, "aaaaab" * 3000):
        assert np.frombuffer(encoder.encode(text), "<u4").tolist() == encoder.library.encode(text, add_bos=True, add_eos=True)


def test_forgetting_changes_nothing(encoder, monkeypatch):
    monkeypatch.setattr(pieces, "_KNOWN_SEGMENTS", 3)
    monkeypatch.setattr(pieces, "_KNOWN_PAIRS", 3)
    text = "several words make segments that are forgotten and several words come back"
    for _ in range(2):
        assert np.frombuffer(encoder.encode(text), "<u4").tolist() == encoder.library.encode(text, add_bos=True, add_eos=True)


def test_rows(documents, odd_texts, encoder):
    got = sorted((tuple(r) for r in pieces.encoded(documents(odd_texts), piece_model()).collect()), key=repr)
    want = []
    for i, text in odd_texts:
        ids = encoder.library.encode(text or "", add_bos=True, add_eos=True)
        decoded = encoder.library.decode(ids)
        want.append((i, ids, len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest(), hashlib.sha256(decoded.encode()).hexdigest()))
    assert got == sorted(want, key=repr)
    assert pieces.encoded(documents([(1, "a")]).limit(0), piece_model()).count() == 0


def test_a_model_with_spaces_inside_pieces_is_refused(monkeypatch):
    monkeypatch.setattr(pieces, "SPACE", "e")
    with pytest.raises(ValueError):
        pieces.PieceEncoder(piece_model())
