"""Token counts of a unigram tokenizer by a count-only Viterbi search.

The vocabulary of a SentencePiece model file is taken as a unigram model: its
normal pieces with their scores. As that tokenizer does, a text gets one blank
in front, blanks become ``▁``, and nothing else is changed. An Aho-Corasick
automaton enumerates all pieces in the text; dynamic programming carries, for
every position, the best score and the number of pieces of that best path,
not the path itself. The tokenizer's rules for ties hold: a path replaces
another only with a strictly higher score, and paths are tried in the order of
their last piece's start, so the longest last piece wins. A character that is
no piece itself may be an unknown, at the lowest score minus 10, and counts as
many pieces as it has UTF-8 bytes (byte fallback). Scores are added in double
precision, in which the whole numbers of the given file are exact.

Where no piece of the vocabulary goes on over a blank after another character,
every path passes through the start of each word, so the best path is the best
paths of the words (with the blanks in front of them), and words seen before
are looked up. Otherwise a text is one word.

Defined cases: null counts as the empty text, which has 0 pieces and score 0;
each row is judged alone; an empty table gives an empty result; other columns
stay, except one named like a result column.
"""

from __future__ import annotations

import re
from functools import lru_cache
from itertools import chain

import ahocorasick
import pyarrow as pa
import sentencepiece
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewater.llm.common import array_slices, text_or_empty

BLANK = "▁"
UNKNOWN_PENALTY = 10.0
_NONE = float("-inf")
CACHED_WORDS = 300_000


class UnigramCounter(dict):
    """Word -> (pieces, score), by the model file at ``path``."""

    def __init__(self, path: str):
        model = sentencepiece.SentencePieceProcessor(model_file=path)
        special = (model.is_control, model.is_unknown, model.is_byte, model.is_unused)
        pieces = {model.id_to_piece(i): model.get_score(i) for i in range(model.get_piece_size()) if not any(is_(i) for is_ in special)}
        self.automaton = ahocorasick.Automaton()
        for piece, score in pieces.items():
            self.automaton.add_word(piece, (len(piece), score))
        self.automaton.make_automaton()
        self.unknown = min(pieces.values()) - UNKNOWN_PENALTY
        crossing = any(BLANK in p.lstrip(BLANK) for p in pieces)
        self.words = re.compile(".+" if crossing else f"{BLANK}*[^{BLANK}]+|{BLANK}+", re.S)

    def __missing__(self, word: str) -> tuple[int, float]:
        if len(self) >= CACHED_WORDS:
            self.clear()
        self[word] = best = self.best(word)
        return best

    def best(self, word: str) -> tuple[int, float]:
        n = len(word)
        scores, counts, unknown = [0.0] * (n + 1), [0] * (n + 1), self.unknown
        at, top, count, single = 0, _NONE, 0, False  # of the pieces that end with character ``at``
        # by end, and for one end the longest piece, so the earliest start, first; a last mark closes the word
        for end, (length, score) in chain(self.automaton.iter(word), ((n, (0, 0.0)),)):
            while at < end:
                if not single and scores[at] + unknown > top:
                    top, count = scores[at] + unknown, counts[at] + len(word[at].encode("utf-8"))
                at += 1
                scores[at], counts[at] = top, count
                top, single = _NONE, False
            if end < n:
                start = end + 1 - length
                path = scores[start] + score
                if path > top:
                    top, count = path, counts[start] + 1
                if length == 1:
                    single = True
        return counts[n], scores[n]

    def count(self, text: str) -> tuple[int, float]:
        pieces, total = 0, 0.0
        if text:
            for n, score in map(self.__getitem__, self.words.findall(BLANK + text.replace(" ", BLANK))):
                pieces += n
                total += score
        return pieces, total


@lru_cache(maxsize=2)
def counter(path: str) -> UnigramCounter:
    return UnigramCounter(path)


def count_tokens(docs: DataFrame, model_path: str) -> DataFrame:
    """``docs`` with ``n_tokens`` and ``token_score`` (the best path's score) of ``text``."""

    @F.arrow_udf("n long, score double")
    def counts(text: pa.Array) -> pa.Array:
        count = counter(model_path).count
        found = [count(t) for part in array_slices(text) for t in part]
        return pa.array([{"n": n, "score": score} for n, score in found], pa.struct([("n", pa.int64()), ("score", pa.float64())]))

    return (
        docs.withColumn("__tw_c", counts(text_or_empty()))
        .withColumns({"n_tokens": F.col("__tw_c.n"), "token_score": F.col("__tw_c.score")})
        .drop("__tw_c")
    )
