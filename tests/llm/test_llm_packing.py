import random
import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from lotwise.llm import packing
from llm_helpers import documents


@pytest.fixture(scope="module")
def exact():
    tokenizer = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    return tokenizer


def test_fast_tokenizer_gives_the_same_ids(exact):
    rng = random.Random(1)
    plain = [chr(c) for c in range(0x2100) if packing._PLAIN.fullmatch(chr(c))]
    mixed = [" ", "  ", "\n", "\t", "\r\n", "'s", "'ll", "12", "a", "É", "<|endoftext|>", " ", "　", "中", "𝔘", "\x85", "\x1c"]
    for _ in range(4000):
        text = "".join(rng.choice(plain if rng.random() < 0.6 else mixed) for _ in range(rng.randint(0, 14)))
        assert packing.token_ids(text, control=True).tolist() == exact.encode(text, add_special_tokens=False).ids, repr(text)


def test_cut():
    assert packing.cut(1, 8) == [(0, 1)]
    assert packing.cut(8, 8) == [(0, 8)]
    assert packing.cut(9, 8) == [(0, 1), (1, 8)]
    assert packing.cut(24, 8) == [(0, 8), (8, 8), (16, 8)]


def valid(bins, lengths, capacity):
    fills = np.bincount(bins, weights=lengths)
    return fills.max() <= capacity and fills.min() > 0


def test_genetics_keep_packings_valid_and_never_lose_the_best():
    rng = np.random.default_rng(4)
    for capacity in (100, 1024):
        lengths = np.sort(rng.integers(capacity // 5, capacity // 2, 300))[::-1].astype(np.int64)
        population = packing.first_population(lengths, capacity, 4, rng)
        assert all(valid(b, lengths, capacity) for b in population)
        child = packing.crossover(population[-1], population[0], lengths, capacity, rng)
        assert valid(child, lengths, capacity)
        best = max(packing.fitness(b, lengths, capacity) for b in population)
        evolved = packing.evolve(population, lengths, capacity, 20, rng)
        assert all(valid(b, lengths, capacity) for b in evolved)
        assert packing.fitness(evolved[0], lengths, capacity) >= best
        assert evolved[0].max() + 1 >= packing.lower_bound(lengths, capacity)


def test_crossover_takes_whole_bins():
    lengths = np.array([6, 5, 5, 4], np.int64)
    giver, receiver = np.array([0, 1, 1, 0]), np.array([0, 1, 2, 1])
    child = packing.crossover(receiver, giver, lengths, 10, np.random.default_rng(0))
    assert valid(child, lengths, 10) and child.max() == 1


def test_evolution_finds_a_better_packing():
    # best-fit decreasing needs 7 bins of 10 here, six suffice
    lengths = np.array(sorted([5, 5, 4, 4, 4, 3, 3, 3, 6, 6, 3, 4, 2, 2, 2, 2, 2], reverse=True), np.int64)
    rng = np.random.default_rng(1)
    found = packing.evolve(packing.first_population(lengths, 10, 6, rng), lengths, 10, 60, rng)
    assert found[0].max() + 1 == packing.lower_bound(lengths, 10)


def check(rows, texts, exact, capacity=1024):
    sequences, pieces = defaultdict(list), defaultdict(list)
    for r in rows:
        sequences[r.sequence_id].append((r.offset, r.length))
        pieces[r.doc_id].append((r.piece, r.start, r.length, r.ids_crc32))
    for placed in sequences.values():
        at = 0
        for offset, length in sorted(placed):
            assert offset == at
            at += length
        assert at <= capacity
    for doc_id, text in texts.items():
        ids = np.array([*exact.encode(text or "", add_special_tokens=False).ids, 2], "<u4")
        expected = [(k, s, n, zlib.crc32(ids[s:s + n].tobytes())) for k, (s, n) in enumerate(packing.cut(len(ids), capacity))]
        assert sorted(pieces.pop(doc_id)) == expected
    assert not pieces
    return len(sequences), sum(r.length for r in rows)


def test_pack_places_every_token_once(spark, exact):
    rng = random.Random(8)
    texts = {i: " ".join(rng.choice(["tion", "Schön", "ñandú", "x1", "…"]) for _ in range(rng.randint(0, 900))) for i in range(300)}
    texts |= {900: None, 901: "", 902: "long words " * 20_000, 903: "中文 <|endoftext|>"}
    rows = packing.pack(documents(spark, list(texts.items())), block_pieces=64).collect()
    n, total = check(rows, texts, exact)
    assert n <= -(-total // 1024) * 1.05 + 4


def test_edges(spark):
    rows = packing.pack(documents(spark, [(None, "a b"), (5, "same"), (5, "same"), (None, None)])).collect()
    assert sorted(r.length for r in rows) == [1, 2, 2, 3]
    assert len({r.sequence_id for r in rows}) == 1
    assert sorted(r.offset for r in rows)[0] == 0
    assert packing.pack(documents(spark, [])).collect() == []
    with pytest.raises(ValueError):
        packing.pack(documents(spark, []), capacity=1)


def test_other_capacity(spark, exact):
    texts = {i: "one two three " * i for i in range(40)}
    check(packing.pack(documents(spark, list(texts.items())), capacity=16).collect(), texts, exact, 16)


def test_control_strings_as_the_tokenizer_has_them(spark):
    text = "a <|endoftext|> b"
    assert packing.token_ids(text, control=True).tolist() == [64, 220, 50256, 275]
    assert packing.token_ids(text).tolist() == packing._tokenizers("byte_bpe_50k.json")[0].encode(text, add_special_tokens=False).ids
    lengths = [packing.pack(documents(spark, [(1, text)]), **more).first().length for more in ({}, {"control": False})]
    assert lengths == [5, 10]
