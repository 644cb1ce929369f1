"""Phrase collocations counted in quotient filters.

Texts become batches of word streams. Words that occur often enough get ids, as no
frequent phrase holds another word. For every batch and phrase length the packed ids
of all n-grams are permuted by an invertible function and kept as a counting
quotient filter: the leading bits of a permuted n-gram, its quotient, say in which
slot it lies, all other bits, its remainder, are stored whole, so a count is of one
n-gram and of no other. Filters are sorted, and are merged across batches in
rounds: in each round ``1 << STEP`` filters of a group exchange ranges of their
quotients and each range is merged. A round moves every filter once, in pieces whose
size does not depend on the corpus; the number of rounds is a logarithm of it.
"""

from __future__ import annotations

import struct
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window, functions as F

from lotwise.llm.batches import answered, exploded
from lotwise.llm.common import ASCII_LOWER, ASCII_UPPER, map_arrow, merge_join, quoted, ship_package, stored

LONGEST = 5
MIN_COUNT = 100
ABSORBED = 100  # percent of a phrase's occurrences that a longer phrase holds
TOP = 2000
NO_LANGUAGE = "und"
BATCH_TOKENS = 1 << 21
STEP = 6  # bits of the quotient that a round divides by
ID_BUCKETS = 256

# --- word streams ---------------------------------------------------------------------------

_BREAK = b"\xff"  # in no UTF-8 text
_TABLE = bytearray(range(256))
_TABLE[0x41:0x5B] = range(0x61, 0x7B)
_TABLE[0x09] = 0x20
for _mark in b".,;:!?\n\x0b\x0c\r":
    _TABLE[_mark] = _BREAK[0]
_TABLE = bytes(_TABLE)

_BATCH = "batch bigint, lang string, words array<string>, counts array<bigint>, n_stream bigint, stream binary"


def split_words(text: bytes) -> list[bytes]:
    """Words of a text, with a break wherever a piece ends."""
    return text.translate(_TABLE).replace(_BREAK, b" \xff ").split()


def _encoded(number: int, lang: str, texts: list[pa.Array]) -> pa.RecordBatch:
    """A batch of one language; its stream has the place of each word, -1 for a break."""
    coded = pa.concat_arrays([*texts, pa.array([_BREAK], pa.binary())]).dictionary_encode()
    stream = coded.indices.to_numpy(zero_copy_only=False).astype(np.int32)
    mark = int(stream[-1])
    places = np.arange(len(coded.dictionary), dtype=np.int32) - (np.arange(len(coded.dictionary)) > mark)
    places[mark] = -1
    stream = places[stream]
    counts = np.bincount(stream[stream >= 0], minlength=len(places) - 1)
    words = pa.concat_arrays([coded.dictionary[:mark], coded.dictionary[mark + 1:]]).cast(pa.string())
    packed = pa.compress(stream.tobytes(), "zstd", asbytes=True)
    return pa.RecordBatch.from_arrays([
        pa.array([number], pa.int64()), pa.array([lang]), pa.array([words.to_pylist()], pa.list_(pa.string())),
        pa.array([counts], pa.list_(pa.int64())), pa.array([len(stream)], pa.int64()), pa.array([packed], pa.binary())],
        ["batch", "lang", "words", "counts", "n_stream", "stream"])


def _streams(batch_tokens: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = TaskContext.get().partitionId() << 32
        texts: dict[str, list[pa.Array]] = {}
        held: dict[str, int] = {}
        for batch in batches:
            for lang, text in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                words = split_words(text.as_buffer().to_pybytes()) if text.is_valid else []
                if not words:
                    continue
                texts.setdefault(lang, []).append(pa.array([*words, _BREAK], pa.binary()))
                held[lang] = held.get(lang, 0) + len(words) + 1
                if sum(held.values()) >= batch_tokens:
                    # all languages together have the memory of one batch
                    largest = max(held, key=held.get)
                    yield _encoded(number, largest, texts.pop(largest))
                    del held[largest]
                    number += 1
        for lang, found in texts.items():
            yield _encoded(number, lang, found)
            number += 1

    return run


# --- filters --------------------------------------------------------------------------------

_MIX = (0x9E3779B97F4A7C15, 0xD6E8FEB86659FD93)  # odd, so each has an inverse
_UNMIX = tuple(pow(m, -1, 1 << 64) for m in _MIX)


def _mask(width: int) -> np.uint64:
    return np.uint64((1 << width) - 1)


def _mixed(x: np.ndarray, width: int) -> np.ndarray:
    """A permutation of the numbers of ``width`` bits."""
    for factor in _MIX:
        x = x * np.uint64(factor) & _mask(width)
        x = x ^ x >> np.uint64(width // 2 + 1)
    return x


def _unmixed(x: np.ndarray, width: int) -> np.ndarray:
    for factor in reversed(_UNMIX):
        x = x ^ x >> np.uint64(width // 2 + 1)
        x = x * np.uint64(factor) & _mask(width)
    return x


class Layout:
    """How n-grams of ``length`` ids of ``bits`` bits lie in 64-bit limbs, and their permutation."""

    def __init__(self, length: int, bits: int):
        self.length, self.bits, each = length, bits, 64 // bits
        self.limbs = [range(i, min(i + each, length)) for i in range(0, length, each)]
        self.widths = [bits * len(limb) for limb in self.limbs]

    def permuted(self, ids: list[np.ndarray]) -> list[np.ndarray]:
        """Limbs of the n-grams whose words are ``ids``, column by column."""
        out = []
        for limb in self.limbs:
            x = ids[limb[0]]
            for place in limb[1:]:
                x = x << np.uint64(self.bits) | ids[place]
            out.append(x)
        for other, width in zip(out[1:], self.widths[1:], strict=True):
            out[0] = out[0] ^ _mixed(other, width) & _mask(self.widths[0])
        return [_mixed(out[0], self.widths[0]), *out[1:]]

    def ids(self, limbs: list[np.ndarray]) -> np.ndarray:
        """The words of permuted n-grams, one row each."""
        limbs = [_unmixed(limbs[0], self.widths[0]), *limbs[1:]]
        for other, width in zip(limbs[1:], self.widths[1:], strict=True):
            limbs[0] = limbs[0] ^ _mixed(other, width) & _mask(self.widths[0])
        columns = []
        for x, limb in zip(limbs, self.limbs, strict=True):
            columns += [x >> np.uint64(self.bits * (limb[-1] - place)) & _mask(self.bits) for place in limb]
        return np.stack(columns, axis=1).astype(np.int64)


def counted(limbs: list[np.ndarray], counts: np.ndarray | None = None) -> tuple[list[np.ndarray], np.ndarray]:
    """Distinct permuted n-grams in order, with the sums of their counts (1 each if none are given)."""
    if len(limbs) == 1 and counts is None:
        limbs = [np.sort(limbs[0])]
    else:
        # stable, so that sorted runs are merged
        order = np.argsort(limbs[0], kind="stable") if len(limbs) == 1 else np.lexsort(limbs[::-1])
        limbs = [x[order] for x in limbs]
        counts = None if counts is None else counts[order]
    n = len(limbs[0])
    first = np.ones(n, bool)
    if n:
        first[1:] = np.logical_or.reduce([x[1:] != x[:-1] for x in limbs])
    starts = np.flatnonzero(first)
    sums = np.diff(starts, append=n) if counts is None else np.add.reduceat(counts, starts) if n else counts
    return [x[starts] for x in limbs], sums


_HEAD = struct.Struct("<qqq")


def packed(layout: Layout, limbs: list[np.ndarray], counts: np.ndarray, depth: int) -> bytes:
    """A counting quotient filter of sorted n-grams that agree in their first ``depth`` bits.

    Slots that are occupied, the last entries of their runs, the remainders, and
    counters of a byte; those of 255 or more follow at the end.
    """
    n, rest = len(counts), layout.widths[0] - depth
    bits = max(0, min(rest, n.bit_length() - 1))
    first = limbs[0] & _mask(rest)
    slots = (first >> np.uint64(rest - bits)).astype(np.int64) if rest > bits else first.astype(np.int64)
    occupied = np.zeros(1 << bits, bool)
    occupied[slots] = True
    ends = np.append(slots[1:] != slots[:-1], True)
    parts = [_HEAD.pack(n, bits, int((counts >= 255).sum())), np.packbits(occupied).tobytes(), np.packbits(ends).tobytes()]
    for x, width in zip([first & _mask(rest - bits), *limbs[1:]], [rest - bits, *layout.widths[1:]], strict=True):
        parts.append(np.ascontiguousarray(x.astype("<u8").view(np.uint8).reshape(n, 8)[:, :(width + 7) // 8]).tobytes())
    parts += [np.minimum(counts, 255).astype(np.uint8).tobytes(), counts[counts >= 255].astype("<i8").tobytes()]
    return b"".join(parts)


def unpacked(layout: Layout, data: bytes, depth: int, prefix: int) -> tuple[list[np.ndarray], np.ndarray]:
    n, bits, large = _HEAD.unpack_from(data)
    at, rest = _HEAD.size, layout.widths[0] - depth

    def take(size: int) -> np.ndarray:
        nonlocal at
        at += size
        return np.frombuffer(data, np.uint8, size, at - size)

    occupied = np.flatnonzero(np.unpackbits(take(((1 << bits) + 7) // 8), count=1 << bits))
    ends = np.unpackbits(take((n + 7) // 8), count=n)
    run = np.cumsum(ends) - ends
    limbs = []
    for width in [rest - bits, *layout.widths[1:]]:
        size = (width + 7) // 8
        whole = np.zeros((n, 8), np.uint8)
        whole[:, :size] = take(n * size).reshape(n, size)
        limbs.append(whole.reshape(-1).view("<u8").astype(np.uint64))
    slots = occupied[run].astype(np.uint64)
    if rest > bits:
        slots = slots << np.uint64(rest - bits)
    limbs[0] = limbs[0] | slots
    if depth:
        limbs[0] = limbs[0] | np.uint64(prefix << rest)
    counts = take(n).astype(np.int64)
    counts[counts == 255] = np.frombuffer(take(8 * large).tobytes(), "<i8")
    return limbs, counts


def pieces(layout: Layout, limbs: list[np.ndarray], counts: np.ndarray, depth: int, step: int) -> Iterator[tuple[int, bytes]]:
    """Filters of ranges of sorted n-grams, by the ``step`` bits that follow the first ``depth``."""
    prefixes = limbs[0] >> np.uint64(layout.widths[0] - depth - step)
    starts = np.flatnonzero(np.append(True, prefixes[1:] != prefixes[:-1])) if len(prefixes) else []
    for begin, end in zip(starts, [*starts[1:], len(prefixes)], strict=True):
        yield int(prefixes[begin]), packed(layout, [x[begin:end] for x in limbs], counts[begin:end], depth + step)


_FILTER = "lang string, length int, at_group bigint, prefix bigint, filter binary"


def _filter_rows(rows: list[tuple]) -> pa.RecordBatch:
    types = (pa.string(), pa.int32(), pa.int64(), pa.int64(), pa.binary())
    columns = list(zip(*rows, strict=True)) if rows else [()] * len(types)
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types, strict=True)],
                                      ["lang", "length", "at_group", "prefix", "filter"])


def _filters(longest: int, bits: int, step: int):
    """Filters of a batch's n-grams, divided by the first ``step`` bits."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in range(batch.num_rows):
                lang, group, n_words, n_stream, data, answers = (c[row] for c in batch.columns)
                stream = np.frombuffer(pa.decompress(data.as_py(), n_stream.as_py() * 4, "zstd", asbytes=True), np.int32)
                ids = np.full(n_words.as_py() + 1, -1, np.int64)  # the last for breaks
                if answers.is_valid:
                    found = answers.values
                    ids[found.field("at").to_numpy()] = found.field("id").to_numpy()
                words = ids[stream]
                known, words = words >= 0, words.astype(np.uint64)
                inside = known
                for length in range(2, longest + 1):
                    inside = inside[:-1] & known[length - 1:]
                    at = np.flatnonzero(inside)
                    if not len(at):
                        break
                    layout = Layout(length, bits)
                    limbs, counts = counted(layout.permuted([words[at + place] for place in range(length)]))
                    yield _filter_rows([(lang.as_py(), length, group.as_py() >> step, prefix, piece)
                                        for prefix, piece in pieces(layout, limbs, counts, 0, step)])

    return run


def _merged(bits: int, depth: int, table: pa.Table):
    """The sum of the filters of one range."""
    length, prefix = table.column("length")[0].as_py(), table.column("prefix")[0].as_py()
    layout = Layout(length, bits)
    parts = [unpacked(layout, data.as_buffer().to_pybytes(), depth, prefix) for data in table.column("filter")]
    limbs = [np.concatenate(columns) for columns in zip(*[p[0] for p in parts], strict=True)]
    return layout, *counted(limbs, np.concatenate([p[1] for p in parts]))


def _merge_round(bits: int, depth: int, step: int):
    def run(table: pa.Table) -> pa.Table:
        layout, limbs, counts = _merged(bits, depth, table)
        lang, length, group = (table.column(c)[0].as_py() for c in ("lang", "length", "at_group"))
        return pa.Table.from_batches([_filter_rows([
            (lang, length, group >> step, prefix, piece) for prefix, piece in pieces(layout, limbs, counts, depth, step)])])

    return run


def _merge_last(bits: int, depth: int, min_count: int):
    def run(table: pa.Table) -> pa.Table:
        layout, limbs, counts = _merged(bits, depth, table)
        often = counts >= min_count
        ids = layout.ids([x[often] for x in limbs])
        return pa.table({"lang": pa.array([table.column("lang")[0].as_py()] * len(ids), pa.string()),
                         "ids": pa.array(list(ids), pa.list_(pa.int64())), "f": pa.array(counts[often], pa.int64())})

    return run


# --- the operator ---------------------------------------------------------------------------


def frequent_phrases(docs: DataFrame, lang_col: str = "lang", text_col: str = "text", longest: int = LONGEST,
                     min_count: int = MIN_COUNT, batch_tokens: int = BATCH_TOKENS, step: int = STEP) -> tuple[DataFrame, DataFrame]:
    """Phrases of up to ``longest`` words that occur ``min_count`` times or more, and the words of each language.

    The first table has ``lang``, ``phrase`` (words joined by spaces), ``m`` (its
    words) and ``f``; the second ``of_lang`` and ``n``. Both are stored.
    """
    rows = docs.select(F.coalesce(F.col(quoted(lang_col)), F.lit(NO_LANGUAGE)).alias("lang"), F.col(quoted(text_col)).alias("text"))
    batches = stored(map_arrow(rows, _streams(batch_tokens), _BATCH), "streams")
    words = exploded(batches.select("batch", "lang", "words", "counts"), "words", "counts").withColumnsRenamed(
        {"words": "word", "counts": "n"})
    often = words.groupBy("lang", "word").agg(F.sum("n").alias("f")).where(F.col("f") >= min_count)
    # dense enough to be short, numbered without a task that sees all words
    bucket = F.pmod(F.xxhash64("word"), F.lit(ID_BUCKETS))
    within = F.row_number().over(Window.partitionBy("lang", "bucket").orderBy("word")) - 1
    vocabulary = stored(often.withColumn("bucket", bucket).withColumn("id", within * ID_BUCKETS + F.col("bucket")).drop("bucket"), "words")
    totals = stored(batches.select(F.col("lang").alias("of_lang"), F.expr("aggregate(counts, 0L, (s, c) -> s + c)").alias("n"), "n_stream")
                    .groupBy("of_lang").agg(F.sum("n").alias("n"), F.sum("n_stream").alias("n_stream")), "totals")
    highest, most = vocabulary.agg(F.max("id")).first()[0], totals.agg(F.max("n_stream")).first()[0]

    single = vocabulary.select("lang", F.col("word").alias("phrase"), F.lit(1).alias("m"), "f")
    if highest is None:
        return single, totals.select("of_lang", "n")
    rounds = 1
    while most > batch_tokens << step * rounds:
        rounds += 1
    # a limb has two words at least, unless one fills it: enough for the bits of all rounds
    bits = max(highest.bit_length(), (step * rounds + 1) // 2, 1)

    known = vocabulary.select(F.col("lang").alias("id_lang"), F.col("word").alias("id_word"), "id")
    same = (F.col("lang") == F.col("id_lang")) & (F.col("word") == F.col("id_word"))
    ready = answered(batches, words.select("batch", "lang", "at", "word"), known, same, "id")
    group = F.pmod(F.xxhash64("batch"), F.lit(1 << step * rounds))
    filters = map_arrow(ready.select("lang", group.alias("at_group"), F.size("words").alias("n_words"), "n_stream", "stream", "answers"),
                        _filters(longest, bits, step), _FILTER)
    for number in range(1, rounds + 1):
        parts = filters.groupBy("lang", "length", "at_group", "prefix")
        ship_package(docs.sparkSession)
        if number < rounds:
            filters = stored(parts.applyInArrow(_merge_round(bits, step * number, step), _FILTER), "filters")
    grams = stored(parts.applyInArrow(_merge_last(bits, step * rounds, min_count), "lang string, ids array<bigint>, f bigint"), "phrases")

    spelled = grams.select("lang", "ids", "f", F.posexplode("ids").alias("place", "of_id"))
    spelled = spelled.join(known, (F.col("lang") == F.col("id_lang")) & (F.col("of_id") == F.col("id")))
    spelled = spelled.groupBy("lang", "ids", "f").agg(F.array_sort(F.collect_list(F.struct("place", "id_word"))).alias("spelled"))
    phrase = F.array_join(F.col("spelled.id_word"), " ")
    phrases = spelled.select("lang", phrase.alias("phrase"), F.size("ids").alias("m"), "f")
    return stored(single.unionByName(phrases), "counts"), totals.select("of_lang", "n")


def collocations(docs: DataFrame, lang_col: str = "lang", text_col: str = "text", longest: int = LONGEST, min_count: int = MIN_COUNT,
                 absorbed: int = ABSORBED, top: int = TOP, batch_tokens: int = BATCH_TOKENS, step: int = STEP) -> DataFrame:
    """The ``top`` phrases of each language by how much oftener they occur than their parts would meet by chance.

    A-Z are lowered, texts are split into pieces at ``.,;:!?`` and line breaks, pieces
    into words at spaces and tabs. A phrase lies within a piece. ``score`` is
    ``floor(1000 * a * n / (l * r))`` for the cut of the phrase where it is lowest,
    ties to the earlier cut; all arithmetic is exact. A phrase goes if a longer one
    holds ``absorbed`` percent of its occurrences: as every occurrence of a phrase of
    more words holds one of each phrase in it, a phrase of one word more decides.

    Null and empty texts have no words; a null language is ``und`` and shares that
    group with the language of this name. Repeated rows count each time. Other columns
    are not read. Without a frequent phrase the result is empty.
    """
    counts, totals = frequent_phrases(docs, lang_col, text_col, longest, min_count, batch_tokens, step)
    longer = counts.where("m > 2")
    ends = F.array(F.expr("substring_index(phrase, ' ', m - 1)"), F.expr("substring_index(phrase, ' ', 1 - m)"))
    holders = longer.select(F.col("lang").alias("in_lang"), F.explode(ends).alias("inner"), F.col("f").alias("held"))
    same = (F.col("lang") == F.col("in_lang")) & (F.col("phrase") == F.col("inner")) & (100 * F.col("held") >= absorbed * F.col("f"))
    left = counts.where("m > 1").join(holders.hint("merge"), same, "left_anti")

    cuts = left.select("lang", "phrase", F.col("f").alias("a"), "m", F.explode(F.expr("sequence(1, m - 1)")).alias("k"))
    cuts = cuts.withColumns({"head": F.expr("substring_index(phrase, ' ', k)"), "tail": F.expr("substring_index(phrase, ' ', k - m)")})
    for part, name in (("head", "l"), ("tail", "r")):
        known = counts.select(F.col("lang").alias("of"), F.col("phrase").alias("part"), F.col("f").alias(name))
        cuts = merge_join(cuts, known, (F.col("lang") == F.col("of")) & (F.col(part) == F.col("part"))).drop("of", "part")
    cuts = cuts.join(totals, F.col("lang") == F.col("of_lang"))
    # 1000 * a has 19 digits at most, n and the parts 18
    score = F.expr("(CAST(1000 * a AS DECIMAL(19, 0)) * CAST(n AS DECIMAL(18, 0))) div (CAST(l AS DECIMAL(18, 0)) * CAST(r AS DECIMAL(18, 0)))")
    scored = cuts.withColumn("score", score)
    lowest = scored.groupBy("lang", "phrase", "a", "n").agg(F.min(F.struct("score", "k", "l", "r")).alias("cut"))
    rank = F.row_number().over(Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), F.asc("phrase")))
    ranked = lowest.select("lang", "phrase", "a", "cut.l", "cut.r", "n", "cut.score").withColumn("rank", rank).where(F.col("rank") <= top)
    return ranked.select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score")


ORACLE_SQL = f"""
WITH pieces AS (
  SELECT coalesce(lang, '{NO_LANGUAGE}') AS lang,
         unnest(string_split_regex(translate(text, '{ASCII_UPPER}', '{ASCII_LOWER}'), '[.,;:!?\\x0A-\\x0D]')) AS piece
  FROM documents),
split AS (SELECT lang, list_filter(string_split_regex(piece, '[\\x20\\x09]+'), lambda w: w <> '') AS words FROM pieces),
totals AS (SELECT lang, sum(len(words))::BIGINT AS n FROM split GROUP BY lang),
places AS (
  SELECT lang, m, unnest(list_transform(range(1, len(words) - m + 2), lambda i: array_to_string(words[i:i + m - 1], ' '))) AS phrase
  FROM split, (SELECT unnest(range(1, {LONGEST + 1})) AS m)),
counts AS (SELECT lang, m, phrase, count(*) AS f FROM places GROUP BY ALL HAVING count(*) >= {MIN_COUNT}),
longer AS (
  SELECT lang, phrase, f, unnest([array_to_string(string_split(phrase, ' ')[:-2], ' '), array_to_string(string_split(phrase, ' ')[2:], ' ')]) AS inner_phrase
  FROM counts WHERE m > 2),
kept AS (
  SELECT * FROM counts c WHERE m > 1 AND NOT EXISTS (
    SELECT 1 FROM longer x WHERE x.lang = c.lang AND x.inner_phrase = c.phrase AND 100 * x.f >= {ABSORBED} * c.f)),
cuts AS (
  SELECT lang, phrase, f AS a, m, unnest(range(1, m)) AS k FROM kept),
scored AS (
  SELECT c.lang, c.phrase, c.a, c.k, h.f AS l, t.f AS r, n, ((1000 * c.a::HUGEINT * n) // (h.f::HUGEINT * t.f))::BIGINT AS score
  FROM cuts c JOIN totals USING (lang)
  JOIN counts h ON h.lang = c.lang AND h.phrase = array_to_string(string_split(c.phrase, ' ')[:k], ' ')
  JOIN counts t ON t.lang = c.lang AND t.phrase = array_to_string(string_split(c.phrase, ' ')[k + 1:], ' ')),
lowest AS (SELECT * FROM scored QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1)
SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank, phrase, a, l, r, n, score
FROM lowest QUALIFY rank <= {TOP}
"""
