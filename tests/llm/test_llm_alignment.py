import hashlib
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from tokenizers import Tokenizer

from lotwise.llm import alignment as al
from llm_helpers import documents

TEXTS = ["Hello  world, naïve café №5!", "the cat sat on the mat\n\nthe dog", "ﬁn — “quoted” text… 你好 世界", "emoji 👩‍👩‍👧   nbsp",
         "control <|endoftext|> <s> <unk> <0x41> inside", "under▁score is lost", "tabs\tand\x00nul", " leading and trailing ", "a",
         "́combining", "word " * 3000, "Der schnelle Fuchs, l'été à la plage", "the cat sat on the mat\n\nthe dog", None, "", " ", "\n"]


@pytest.fixture(scope="module")
def tokens():
    first = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    first.encode_special_tokens = True
    second = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))
    shown = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    hidden = [b for b in range(256) if b not in shown]
    byte = {**{chr(b): b for b in shown}, **{chr(256 + i): b for i, b in enumerate(hidden)}}

    def both(text):
        a, b = first.encode(" " + text, add_special_tokens=False).ids, second.encode(text)
        a_bytes = [bytes(byte[c] for c in first.id_to_token(i)) for i in a]
        b_bytes = [bytes([int(second.id_to_piece(i)[1:-1], 16)]) if second.is_byte(i) else second.id_to_piece(i).replace("▁", " ").encode() for i in b]
        same = b"".join(a_bytes) == b"".join(b_bytes) == (" " + text).encode()
        return (list(zip(a, a_bytes, strict=True)), list(zip(b, b_bytes, strict=True))) if same else ([], [])

    return both


def spans(tokens):
    out, at = [], 0
    for number, data in tokens:
        out.append((number, at, at + len(data)))
        at += len(data)
    return out


def brute(both, texts, link):
    found, links = [], []
    for text in texts:
        a, b = map(spans, both(text) if text else ([], []))
        ends = sorted({e for *_, e in a} & {e for *_, e in b})
        groups = [([i for i, s, e in a if lo <= s and e <= hi], [i for i, s, e in b if lo <= s and e <= hi])
                  for lo, hi in zip([0, *ends], ends)] if len(a) < 200 else None
        if groups is None:
            groups, i, j = [], 0, 0
            for hi in ends:
                x, y = i, j
                while i < len(a) and a[i][2] <= hi:
                    i += 1
                while j < len(b) and b[j][2] <= hi:
                    j += 1
                groups.append(([t[0] for t in a[x:i]], [t[0] for t in b[y:j]]))
        joined = ";".join(",".join(map(str, x)) + "|" + ",".join(map(str, y)) for x, y in groups)
        if link == "end":
            at = {e: i for i, _, e in b}
            own = [(i, at[e]) for i, _, e in a if e in at]
        else:
            own = [(i, j) for i, s, e in a for j, t, f in b if s < f and t < e] if len(a) < 200 else [
                (i, j) for (i, s, e), (j, t, f) in zip(a, b, strict=True)]
        links.append(own)
        found.append((len(a), len(b), len(groups), len(own), hashlib.sha256(joined.encode()).hexdigest() if a else ""))
    count = Counter(x for own in links for x in own)
    highest = Counter()
    for (_, j), n in count.items():
        highest[j] = max(highest[j], n)
    return [(*row[:4], sum(count[x] == highest[x[1]] for x in own), sum(count[x] for x in own), row[4]) for row, own in zip(found, links, strict=True)]


@pytest.mark.parametrize("link", ["end", "overlap"])
@pytest.mark.parametrize("chunk_bytes", [1, 200, 1 << 21])
def test_against_sets_of_ends(spark, tokens, link, chunk_bytes):
    got = {r[0]: tuple(r)[1:] for r in al.align(documents(spark, list(enumerate(TEXTS))), link=link, chunk_bytes=chunk_bytes).collect()}
    wanted = brute(tokens, TEXTS, link)
    assert [got[i] for i in range(len(TEXTS))] == wanted
    assert wanted[5][0] == 0 and wanted[-4][0] == wanted[-3][0] == 0 and sum(w[0] > 0 for w in wanted) > 10


def test_repeats_null_ids_empty_table_and_unknown_link(spark):
    rows = al.align(documents(spark, [(1, "one two"), (1, "one two"), (None, "one"), (2, "other")])).collect()
    assert sorted((r.doc_id or 0, r.n_a) for r in rows) == [(0, 1), (1, 2), (1, 2), (2, 1)]
    assert len({tuple(r) for r in rows if r.doc_id == 1}) == 1
    assert al.align(documents(spark, [])).collect() == []
    with pytest.raises(ValueError, match="link"):
        al.align(documents(spark, []), link="start")


def test_groups_break_where_the_running_maximum_is_reached():
    start, end = np.array([0, 3, 5, 0, 2, 5]), np.array([3, 5, 9, 2, 5, 9])
    side = np.array([0, 0, 0, 1, 1, 1])
    assert al.coalesced(start, end, side).tolist() == [0, 0, 1, 0, 0, 1]
    pairs = list(zip(*(x.tolist() for x in al.overlaps(start[:3], end[:3], start[3:], end[3:])), strict=True))
    assert pairs == [(0, 0), (0, 1), (1, 1), (2, 2)]
