"""Encoding and decoding by backtracking, against the sentencepiece library."""

import random

import public_tokenizers
import pytest
import sentencepiece

from lotbook.llm import piece_model
from tests.llm.fixtures import by_id, documents, prose

PATH = public_tokenizers.path("piece_bpe_32k.model")


@pytest.fixture(scope="module")
def library():
    return sentencepiece.SentencePieceProcessor(model_file=PATH)


@pytest.fixture(scope="module")
def own():
    return piece_model.model(PATH)


def _strings(library, n):
    draw = random.Random(3)
    pieces = [library.id_to_piece(i) for i in range(259, library.vocab_size())]
    for i in range(n):
        kind = i % 4
        if kind == 0:
            yield "".join(draw.choice("ab ▁ecnrstion.,\n é") for _ in range(draw.randint(0, 60)))
        elif kind == 1:
            yield "".join(draw.choice(pieces) for _ in range(draw.randint(0, 12)))
        elif kind == 2:
            ranges = [(0, 127), (128, 0x2FFF), (0x4E00, 0x9FFF), (0x1F000, 0x1FFFF)]
            yield "".join(chr(draw.randint(*draw.choice(ranges))) for _ in range(draw.randint(0, 20)))
        else:
            yield " " * draw.randint(0, 70) + draw.choice(["a", "", "the"]) + " " * draw.randint(0, 40) + "=" * draw.randint(0, 90)


def test_ids_are_those_of_the_library(own, library):
    for text in _strings(library, 8000):
        assert own.encode(text).tolist() == library.encode(text), text


def test_decoding_is_that_of_the_library(own, library):
    draw = random.Random(4)
    for text in _strings(library, 2000):
        drawn = [draw.choice([draw.randint(0, 260), draw.randint(0, 31999)]) for _ in range(draw.randint(0, 9))]
        for ids in (library.encode(text), drawn):
            assert own.decode(ids) == library.decode(ids), ids


def test_backtracking_without_kept_parts_or_pairs(own, library, monkeypatch):
    monkeypatch.setattr(piece_model, "MOST_PARTS", 2)
    monkeypatch.setattr(piece_model, "MOST_PAIRS", 2)
    for text in _strings(library, 400):
        assert own.encode(text).tolist() == library.encode(text)


def test_long_runs_take_linear_time(own, library):
    for text in ("a" * 200_000, "aaaab" * 40_000, "=" * 150_000, "日本" * 60_000):
        assert own.encode(text).tolist() == library.encode(text)


def test_defined_cases(spark, library):
    texts = ["", None, "   ", "two  words\n", "two  words\n", "<s>▁</s>", prose(random.Random(1), 30_000), "\x00é𠮷"]
    rows = [(i, t, "s") for i, t in enumerate(texts)]
    found = piece_model.encode(documents(spark, rows, extra=("ids", "decoded", "k0", "shard")), PATH)
    assert sorted(found.columns) == sorted(
        ["doc_id", "text", "lang", "source", "n_chars", "k0", "shard", "ids", "decoded"])
    for i, row in by_id(found).items():
        ids = library.encode(texts[i] or "")
        assert (row.ids, row.decoded) == ([*ids, library.eos_id()], library.decode(ids))
        assert (row.text, row.shard) == (texts[i], "own")
    without = by_id(piece_model.encode(documents(spark, rows), PATH, end=False, keep=["doc_id"]))
    assert without[0].ids == [] and without[1].ids == []
    assert piece_model.encode(documents(spark, rows).limit(0), PATH).collect() == []
