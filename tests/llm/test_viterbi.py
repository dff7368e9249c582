"""Count-only Viterbi: against two tokenizer libraries and a search over all paths."""

from __future__ import annotations

import random
from functools import lru_cache

import pytest
import sentencepiece
from tokenizers import Tokenizer, models

from tidewater.llm.q_viterbi import PRODUCTION_MODEL
from tidewater.llm.viterbi import BLANK, UnigramCounter, count_tokens


@pytest.fixture(scope="module")
def own():
    return UnigramCounter(PRODUCTION_MODEL)


def _texts(n, words):
    rnd = random.Random(11)
    alphabet = ["the", "un", "happi", "ness", "é", "日本", "𝒳", "\n", "  ", "aaaa", "1", ".", "ing", "Ş", "\t", "q"]
    return ["".join(rnd.choice(alphabet) + (" " if rnd.random() < 0.3 else "") for _ in range(rnd.randint(1, words))) for _ in range(n)]


def test_short_texts_score_as_the_best_path_of_sentencepiece(own):
    with open(PRODUCTION_MODEL, "rb") as f:
        model = f.read() + b"\x12\x02\x18\x01"  # trainer_spec.model_type: UNIGRAM
    library = sentencepiece.SentencePieceProcessor(model_proto=model)
    # it adds in single precision, in which ties appear that aren't any; so the score of its best path counts, where exact
    rnd = random.Random(12)
    parts = ["the", "un", "happi", "ness", "é", "日本", "aaaa", "ing", "Ş", "q", " "]
    texts = [" ".join("".join(rnd.choices(parts, k=rnd.randint(1, 9))).split()) for _ in range(300)]
    exact = [t for t in texts if t and own.count(t)[1] > -(2**24)]
    assert len(exact) > 100
    for text in exact:
        ids = library.nbest_encode_as_ids(text, 2)[0]
        assert own.count(text)[1] == sum(library.get_score(i) for i in ids), text


def test_long_texts_match_a_library_in_double_precision(own):
    model = sentencepiece.SentencePieceProcessor(model_file=PRODUCTION_MODEL)
    vocab = [(model.id_to_piece(i), model.get_score(i)) for i in range(model.get_piece_size()) if not model.is_byte(i) and not model.is_control(i)]
    library = Tokenizer(models.Unigram(vocab, unk_id=0, byte_fallback=False))
    pieces = {p for p, _ in vocab}
    for text in _texts(10, 1000):
        tokens = library.encode(BLANK + text.replace(" ", BLANK)).tokens
        assert own.count(text)[0] == sum(1 if t in pieces else len(t.encode()) for t in tokens)


def test_best_score_over_all_paths(own):
    pieces = dict((p, s) for p, (_, s) in own.automaton.items())

    def all_paths(word):
        @lru_cache(None)
        def best(at):
            if at == len(word):
                return 0.0
            found = [pieces[word[at:e]] + best(e) for e in range(at + 1, len(word) + 1) if word[at:e] in pieces]
            if word[at] not in pieces:
                found.append(own.unknown + best(at + 1))
            return max(found)

        return best(0)

    for text in _texts(60, 6):
        word = BLANK + text.replace(" ", BLANK)
        assert own.count(text)[1] == all_paths(word)


def test_table(spark):
    docs = spark.createDataFrame([(1, None, 9), (1, "the cat", 9), (1, "the cat", 9), (None, "x" * 50_000, 9)], "doc_id long, text string, n_tokens int")
    rows = count_tokens(docs, PRODUCTION_MODEL).collect()
    assert sorted(r.n_tokens for r in rows)[:3] == [0, 4, 4] and len(rows) == 4
    assert count_tokens(docs.limit(0), PRODUCTION_MODEL).collect() == []
