"""Token counts of a unigram vocabulary, without the tokens.

Spaces become marks, and one more mark stands before the text (the usual meta-space form). A word is a run of marks
with what follows up to the next mark; no piece of such a vocabulary reaches from one word into the next, so words are
taken singly, and where a piece does, or the mark itself is no piece, the text is taken as one word. An Aho-Corasick automaton enumerates all vocabulary pieces in a word by their ends; dynamic programming
keeps, for each end, the best score and how many pieces the best path has, and nothing else.

Tie rules are the tokenizer's: of equal scores at one end the piece that starts first stays, so pieces are tried longest
first and only a larger score replaces; a character that is no piece of its own costs the lowest score less a
penalty, and is tried last. Where the vocabulary has byte pieces, such a character is as many tokens as it has
bytes in UTF-8; else unknown pieces in a row are one token.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from functools import lru_cache

import ahocorasick
import pyarrow as pa
import sentencepiece
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from caudal.llm.common import importable

MARK = "▁"
WORD = re.compile(f"{MARK}+[^{MARK}]*")
PENALTY = 10.0
#: Words whose counts a worker remembers; longer ones are counted each time.
REMEMBERED, LONGEST = 1 << 19, 64


def pieces_of(path: str) -> list[tuple[str, float]]:
    """Pieces and scores of a model file: the unknown piece first, then all ordinary ones. Byte pieces aren't among them:
    the text of their names is no match, and their scores decide nothing."""
    model = sentencepiece.SentencePieceProcessor(model_file=path)
    ordinary = [
        i for i in range(model.get_piece_size())
        if not (model.is_unknown(i) or model.is_control(i) or model.is_byte(i) or model.is_unused(i))
    ]
    return [(model.id_to_piece(model.unk_id()), 0.0), *((model.id_to_piece(i), model.get_score(i)) for i in ordinary)]


def has_byte_pieces(path: str) -> bool:
    model = sentencepiece.SentencePieceProcessor(model_file=path)
    return sum(map(model.is_byte, range(model.get_piece_size()))) == 256


class PieceCounter:
    """Counts pieces of words; the first piece of the vocabulary stands for unknown characters, unless there are byte
    pieces for them: then its name is no match either."""

    def __init__(self, pieces: list[tuple[str, float]], byte_pieces: bool = False):
        self.automaton = ahocorasick.Automaton()
        for i, (piece, score) in enumerate(pieces):
            if i or not byte_pieces:
                self.automaton.add_word(piece, (len(piece), score, i == 0))
        self.automaton.make_automaton()
        self.byte_pieces = byte_pieces
        across = re.compile(f"[^{MARK}]{MARK}")
        self.by_word = any(piece == MARK for piece, _ in pieces) and not any(across.search(piece) for piece, _ in pieces)
        self.unknown = min(score for _, score in pieces) - PENALTY
        self.known: dict[str, tuple[int, int, float]] = {}

    def word(self, word: str) -> tuple[int, int, float]:
        """Tokens, those for unknown characters among them, and score of the best path."""
        n = len(word)
        best: list[float | None] = [None] * (n + 1)
        best[0] = 0.0
        counts, unknown, ends_unknown = [0] * (n + 1), [0] * (n + 1), [False] * (n + 1)
        matches = self.automaton.iter(word)
        match = next(matches, None)
        for end in range(1, n + 1):
            single = False
            while match is not None and match[0] == end - 1:
                length, score, is_unknown = match[1]
                start = end - length
                score += best[start]
                if best[end] is None or score > best[end]:
                    joins = is_unknown and ends_unknown[start]
                    best[end], ends_unknown[end] = score, is_unknown
                    counts[end] = counts[start] + (not joins)
                    unknown[end] = unknown[start] + (is_unknown and not joins)
                single |= length == 1
                match = next(matches, None)
            if not single:
                start = end - 1
                score = best[start] + self.unknown
                if best[end] is None or score > best[end]:
                    tokens = len(word[start].encode()) if self.byte_pieces else not ends_unknown[start]
                    best[end], ends_unknown[end] = score, True
                    counts[end] = counts[start] + tokens
                    unknown[end] = unknown[start] + tokens
        return counts[n], unknown[n], best[n]

    def text(self, text: str) -> tuple[int, int, float]:
        if not text:
            return 0, 0, 0.0
        text = MARK + text.replace(" ", MARK)
        words = WORD.findall(text) if self.by_word else [text]
        known = self.known
        found = list(map(known.get, words))
        for i in [i for i, got in enumerate(found) if got is None]:
            word = words[i]
            if (got := known.get(word)) is None:  # else it has come up earlier in this text
                got = self.word(word)
                if len(word) <= LONGEST:
                    if len(known) >= REMEMBERED:
                        known.clear()
                    known[word] = got
            found[i] = got
        counts, unknown, scores = zip(*found, strict=True)
        return sum(counts), sum(unknown), sum(scores)


@lru_cache(maxsize=2)
def counter(path: str) -> PieceCounter:
    return PieceCounter(pieces_of(path), has_byte_pieces(path))


def _count(path: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = counter(path)
        for batch in batches:
            rows = []
            for at in range(0, batch.num_rows, 256):
                rows += [counts.text(t or "") for t in batch.column(1).slice(at, 256).to_pylist()]
            tokens, unknown, score = zip(*rows, strict=True) if rows else ((), (), ())
            yield pa.record_batch(
                [batch.column(0), pa.array(tokens, pa.int64()), pa.array(unknown, pa.int64()), pa.array(score, pa.float64())],
                ["doc_id", "n_tokens", "n_unknown", "score"],
            )

    return run


def token_counts(docs: DataFrame, path: str) -> DataFrame:
    """One row for each row of docs (doc_id, text; other columns are not read): doc_id, n_tokens, n_unknown (those
    for characters without a piece, byte pieces included), score of the best segmentation. Null and empty texts have no tokens. Nothing depends on
    doc_id, so null and repeated ones are fine. The model file must be readable on every executor."""
    importable(docs.sparkSession)
    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(_count(path), "doc_id long, n_tokens long, n_unknown long, score double")
