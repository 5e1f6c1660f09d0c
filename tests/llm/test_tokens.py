"""BPE and unigram counts against the tokenizer libraries."""

import base64
import random

import numpy as np
import public_tokenizers
import pytest
import tiktoken
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer, models

from caudal.llm import bpe, viterbi_counts
from tests.llm.cases import ODD

RANKS = public_tokenizers.path("byte_bpe_50k.tiktoken")
PIECES = public_tokenizers.path("piece_bpe_32k.model")


@pytest.fixture(scope="module")
def reference():
    with open(RANKS, "rb") as lines:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


def hard():
    rnd = random.Random(3)
    mixed = "".join(rnd.choice("ab \n1!é​中😀") for _ in range(6000))
    return ODD + [(20, "a" * 5000), (21, " " * 3000 + "x"), (22, "\n\n\n  \t" * 700), (23, "é" * 4000 + " the " + "!" * 3000), (24, "it's we've " * 500), (25, mixed)]


@pytest.mark.parametrize(("chunk", "overlap"), [(200, 40), (1000, 100), (bpe.CHUNK, bpe.OVERLAP)])
def test_encoding_equals_the_library(make, reference, monkeypatch, chunk, overlap):
    monkeypatch.setattr(bpe, "MARGIN", 16)
    rows = hard()
    got = bpe.decoded(bpe.encoded(make(rows), RANKS, public_tokenizers.PATTERN, chunk, overlap), RANKS).collect()
    texts = {}
    for i, t in rows:
        texts.setdefault(i, set()).add(t or "")
    assert len(got) == len(rows)
    for r in got:
        decoded = bytes(r.decoded).decode()
        assert decoded in texts[r.doc_id]
        assert np.frombuffer(r.ids, "<u4").tolist() == reference.encode_ordinary(decoded)


@settings(max_examples=200, deadline=None)
@given(st.binary(min_size=1, max_size=200))
def test_short_and_long_merges_agree(piece):
    ranks, tokens = bpe.vocabulary(RANKS)
    ids = bpe._merged_long(piece, ranks)
    assert b"".join(tokens[i] for i in ids) == piece
    if len(piece) <= 64:
        assert bpe.merged(piece, ranks) in (ids, [ranks.get(piece)])


CODE = "def f(x):\n        return 1\n\n\n    if a:\n                pass  # 😀 ꙮꙮ\n"


@pytest.fixture(scope="module")
def unigram():
    """The whole vocabulary with its byte pieces, over the unsplit text. The unknown piece has a name that no text here has."""
    _, *pieces = viterbi_counts.pieces_of(PIECES)
    return Tokenizer(models.Unigram([("\ue000", 0.0), *((f"<0x{b:02X}>", 0.0) for b in range(256)), *pieces], unk_id=0, byte_fallback=True))


def test_counts_equal_the_library(make, unigram):
    rows = hard() + [(30, "日本語ꙮꙮ x"), (31, "<unk>ꙮ<unk>"), (32, "▁▁a▁  b "), (33, CODE), (34, "a    b"), (35, " \t x" * 50), (36, "   ")]
    want = {}
    for i, t in rows:
        ids = unigram.encode(viterbi_counts.MARK + t.replace(" ", viterbi_counts.MARK), add_special_tokens=False).ids if t else []
        want.setdefault(i, set()).add((len(ids), sum(id < 257 for id in ids)))
    got = viterbi_counts.token_counts(make(rows), PIECES).collect()
    assert len(got) == len(rows)
    assert all((r.n_tokens, r.n_unknown) in want[r.doc_id] for r in got)


def test_tie_rules_equal_the_library():
    """Few scores, so that many segmentations are equally good."""
    rnd = random.Random(8)
    for _ in range(30):
        names = {"".join(rnd.choice("ab▁") for _ in range(rnd.randint(1, 4))) for _ in range(12)}
        pieces = [("<unk>", 0.0), *((p, float(rnd.choice([-1, -2, -3]))) for p in sorted(names))]
        library = Tokenizer(models.Unigram(pieces, unk_id=0, byte_fallback=False))
        counter = viterbi_counts.PieceCounter(pieces)
        for _ in range(40):
            text = "".join(rnd.choice("abc ") for _ in range(rnd.randint(0, 25)))
            ids = library.encode("▁" + text.replace(" ", "▁"), add_special_tokens=False).ids if text else []
            assert counter.text(text)[:2] == (len(ids), ids.count(0)), (pieces, text)


def test_empty_tables(make):
    assert bpe.encoded(make([]), RANKS, public_tokenizers.PATTERN).collect() == []
    assert viterbi_counts.token_counts(make([]), PIECES).collect() == []
