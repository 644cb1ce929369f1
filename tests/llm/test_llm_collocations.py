import random
import re
from collections import Counter

import numpy as np
import pytest

from lotwise.llm import collocations as co
from llm_helpers import lowered

SCHEMA = "doc_id bigint, text string, lang string, batch string, `a.b` int, phrase string, at_group string, id string, n int"


def table(spark, rows):
    return spark.createDataFrame([(i, t, lang, "x", 1, "p", "g", "i", 2) for i, (t, lang) in enumerate(rows)], SCHEMA)


def brute(rows, longest, min_count, absorbed, top):
    f, n = {}, Counter()
    for text, lang in rows:
        lang = "und" if lang is None else lang
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", lowered(text)):
            words = re.findall(r"[^\x20\x09]+", piece)
            n[lang] += len(words)
            for m in range(1, longest + 1):
                f.setdefault(lang, Counter()).update(tuple(words[i:i + m]) for i in range(len(words) - m + 1))
    out = []
    for lang, counts in f.items():
        often = {p: c for p, c in counts.items() if c >= min_count and len(p) > 1}
        found = []
        for p, a in often.items():
            if any(100 * c >= absorbed * a and any(q[i:i + len(p)] == p for i in range(len(q) - len(p) + 1))
                   for q, c in often.items() if len(q) > len(p)):
                continue
            score, k = min((1000 * a * n[lang] // (counts[p[:k]] * counts[p[k:]]), k) for k in range(1, len(p)))
            found.append((-score, -a, " ".join(p).encode(), counts[p[:k]], counts[p[k:]]))
        for rank, (score, a, p, left, right) in enumerate(sorted(found)[:top], 1):
            out.append((lang, rank, p.decode(), -a, left, right, n[lang], -score))
    return sorted(out)


def rows(seed, n=150):
    draw = random.Random(seed)
    words = [*"abcdefgh", "Éa", "ß", "x\x01", "x", " y", "Zed"]
    out = []
    for _ in range(n):
        text = "".join(draw.choice(words) + draw.choice([" ", " ", "  ", "\t", ". ", "\n", " in the end "]) for _ in range(draw.randrange(60)))
        out.append((text, draw.choice(["en", "en", "fr", None, "und", ""])))
    return out + [(None, "en"), ("", "de"), ("...", None), ("a " * 5000, "en"), (rows_copy := "to be or not to be, that is", "fr")] + [(rows_copy, "fr")] * 40


@pytest.mark.parametrize("batch_tokens,step,absorbed", [(1 << 21, 6, 100), (500, 1, 100), (200, 3, 60)])
def test_against_counters(spark, batch_tokens, step, absorbed):
    some = rows(batch_tokens)
    found = co.collocations(table(spark, some), min_count=5, top=60, batch_tokens=batch_tokens, step=step, absorbed=absorbed)
    assert found.columns == ["lang", "rank", "phrase", "a", "l", "r", "n", "score"]
    wanted = brute(some, 5, 5, absorbed, 60)
    assert sorted(map(tuple, found.collect())) == wanted
    assert len(wanted) > 100


def test_nothing_frequent_and_empty_table(spark):
    assert co.collocations(table(spark, [("a b c", "en")])).collect() == []
    assert co.collocations(table(spark, [])).collect() == []


@pytest.mark.parametrize("bits", [1, 2, 13, 17, 21, 22, 31, 32, 33, 40])
@pytest.mark.parametrize("length", [2, 5])
def test_filters_lose_nothing(bits, length):
    layout = co.Layout(length, bits)
    draw = np.random.default_rng(bits)
    ids = [draw.integers(0, 1 << bits, 3000, np.uint64) for _ in range(length)]
    ids = [np.concatenate([x, x[:500], np.repeat(x[:1], 700)]) for x in ids]
    wanted = Counter(zip(*[x.tolist() for x in ids], strict=True))
    limbs, counts = co.counted(layout.permuted(ids))
    assert Counter(dict(zip(map(tuple, layout.ids(limbs).tolist()), counts.tolist(), strict=True))) == wanted
    step = min(3, layout.widths[0] // 2)
    merged = Counter()
    for depth in (0, step):
        for prefix, data in co.pieces(layout, limbs, counts, 0, step):
            back, some = co.unpacked(layout, data, step, prefix)
            if depth:
                for inner, smaller in co.pieces(layout, back, some, step, step):
                    deep, n = co.unpacked(layout, smaller, 2 * step, inner)
                    merged.update(dict(zip(map(tuple, layout.ids(deep).tolist()), n.tolist(), strict=True)))
            assert [x.tolist() for x in co.counted(back, some)[0]] == [x.tolist() for x in back]
    assert merged == wanted


def test_counts_past_a_byte_and_two_filters_add_up():
    layout = co.Layout(3, 30)
    ids = [np.array([5, 5, 9], np.uint64)] * 3
    limbs, counts = co.counted(layout.permuted(ids), np.array([250, 6, 1 << 40]))
    data = co.packed(layout, limbs, counts, 0)
    back, n = co.unpacked(layout, data, 0, 0)
    both, sums = co.counted([np.concatenate([x, x]) for x in back], np.concatenate([n, n]))
    assert dict(zip(map(tuple, layout.ids(both).tolist()), sums.tolist(), strict=True)) == {(5,) * 3: 512, (9,) * 3: 1 << 41}
