"""Token counts against the tokenizer library's own unigram model."""

import os
import random

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import pytest
from llm_data import awkward, documents
from tokenizers import Tokenizer, models, pre_tokenizers

from churnwise.llm import tokens
from churnwise.llm.common import chunks, text_bytes


def library(pieces, byte_pieces):
    low = min(s for _, s in pieces)
    vocab = [("<unk>", low), *pieces] + ([(f"<0x{b:02X}>", low) for b in range(256)] if byte_pieces else [])
    t = Tokenizer(models.Unigram(vocab, 0, byte_pieces))
    t.pre_tokenizer = pre_tokenizers.Metaspace(replacement=tokens.MARK, prepend_scheme="always", split=True)
    return lambda text: len(t.encode(text, add_special_tokens=False).ids)


def counted(machine, texts, limit=200):
    raw, offsets = text_bytes(pc.replace_substring(pa.array(texts, pa.string()), tokens.MARK, " "))
    return np.concatenate([tokens.count_texts(machine, raw[offsets[a] : offsets[b]], offsets[a : b + 1] - offsets[a]) for a, b in chunks(offsets, limit)]).tolist()


@pytest.mark.parametrize("byte_pieces", [True, False])
def test_ties_and_unknown_characters(byte_pieces):
    rng = random.Random(12)
    for _ in range(60):
        # whole scores: many paths tie
        pieces = sorted({rng.choice("▁abcé") + "".join(rng.choice("abcé") for _ in range(rng.randint(0, 4))) for _ in range(rng.randint(3, 25))})
        pieces = [(p, -float(rng.randint(1, 4))) for p in pieces]
        texts = ["".join(rng.choice("abcé▁ \n日") for _ in range(rng.randint(0, 30))) for _ in range(80)] + ["", " ", "  ", "abc" * 120 + "\n" * 20 + "é"]
        count = library(pieces, byte_pieces)
        assert counted(tokens.Automaton(pieces, byte_pieces), texts) == [count(t) for t in texts]


@pytest.mark.skipif(not os.path.exists(tokens.VOCABULARY), reason="needs a vocabulary file")
def test_registered_vocabulary(spark):
    texts = [t for t in awkward(random.Random(13))] + ["Hello  World\nabc é", " lead", "tail ", "a▁b"]
    count = library(*tokens.vocabulary(tokens.VOCABULARY))
    docs = documents(spark, texts, clashing=True)
    for r in tokens.count(docs).collect():
        t = texts[r["doc_id"]] or ""
        assert r["n_bytes"] == len(t.encode()) and r["n_tokens"] == (count(t) if t else 0)
    assert tokens.count(docs.limit(0)).collect() == []


def test_automaton_of_nothing():
    assert tokens.Automaton([], True).counts([b"ab", b"", b"x" * 300]).tolist() == [2, 0, 300]
