"""Scoring by cross-entropy difference of two matched n-gram language models.

The target model counts the words and word pairs of the target documents, the
background model those of all documents. Counts are kept for every word and every
pair under its full 64-bit hash, so the models grow with the corpus. They have the
same smoothing, and the background counts are scaled to the size of the target, so
that smoothing weighs alike. A document's score is the mean over its tokens of the
target's loss minus the background's loss; lower means closer to the target.

Tasks turn documents into batches of word numbers. Each batch sends its distinct
words and pairs, cut by ranges of their hashes, to be counted over all batches, gets
back the counts of just these, and scores its documents with them.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import DataFrame, functions as F

from lotwise.llm.common import map_arrow, merge_join, quoted, stored

PAIR_WEIGHT = 0.7  # of the pair estimate against the single word's
ADDED = 0.5  # to every word's count
BATCH_TOKENS = 1 << 20
BATCH_WORDS = 1 << 19
SCORED_TOKENS = 1 << 16  # at once
RANGE_TOKENS = 1 << 22  # tokens of the corpus for each range of pair hashes
LEAST_BITS = 8
_WORDS_FEWER = 4  # bits, as there are fewer words than pairs


def squeezed(values: np.ndarray) -> bytes:
    """Non-negative integers, byte by byte of equal rank."""
    values = np.ascontiguousarray(values, np.uint64)
    width = max(1, (int(values.max(initial=0)).bit_length() + 7) // 8)
    ranks = values.view(np.uint8).reshape(-1, 8)[:, :width].T
    return bytes([width]) + zstandard.compress(ranks.tobytes(), 1)


def expanded(data: bytes) -> np.ndarray:
    width = data[0]
    ranks = np.frombuffer(zstandard.decompress(data[1:]), np.uint8).reshape(width, -1)
    out = np.zeros((ranks.shape[1], 8), np.uint8)
    out[:, :width] = ranks.T
    return out.view(np.uint64).ravel()


def grouped(codes: np.ndarray, top: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct codes, the place of each code among them, and how often each occurs; all are below ``top``."""
    bits = len(codes).bit_length()
    if top << bits < 1 << 63:  # values sort faster than places
        both = np.sort(codes << bits | np.arange(len(codes)))
        order, codes = both & ((1 << bits) - 1), both >> bits
    else:
        order = np.argsort(codes, kind="stable")
        codes = codes[order]
    first = np.ones(len(codes), bool)
    first[1:] = codes[1:] != codes[:-1]
    starts = np.flatnonzero(first)
    place = np.empty(len(codes), np.int32 if len(codes) < 1 << 31 else np.int64)
    place[order] = np.cumsum(first) - 1
    return codes[starts], place, np.diff(np.append(starts, len(codes)))


def pair_hashes(one: np.ndarray, two: np.ndarray) -> np.ndarray:
    mixed = (one ^ (one >> np.uint64(29))) * np.uint64(0x9E3779B97F4A7C15) + two
    for shift, factor in ((33, 0xFF51AFD7ED558CCD), (33, 0xC4CEB9FE1A85EC53)):
        mixed = (mixed ^ (mixed >> np.uint64(shift))) * np.uint64(factor)
    return mixed ^ (mixed >> np.uint64(33))


_PACKED = "batch bigint, doc_ids array<bigint>, lengths array<bigint>, ids binary, words binary"


def _pack(most_tokens: int, most_words: int):
    """Documents as numbers of words, which count from 1 in each batch, and the hashes of these words."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        number = TaskContext.get().partitionId() << 32
        known: dict[bytes, int] = {}
        doc_ids: list = []
        ids: list[np.ndarray] = []
        n_tokens = 0

        def packed() -> pa.RecordBatch:
            words = np.fromiter(map(xxhash.xxh3_64_intdigest, known), np.uint64, len(known))
            return pa.RecordBatch.from_arrays(
                [pa.array([number], pa.int64()), pa.array([doc_ids], pa.list_(pa.int64())),
                 pa.array([[len(i) for i in ids]], pa.list_(pa.int64())),
                 pa.array([squeezed(np.concatenate(ids))], pa.binary()), pa.array([words.tobytes()], pa.binary())],
                ["batch", "doc_ids", "lengths", "ids", "words"])

        for batch in batches:
            texts = batch.column("text").cast(pa.binary())
            for doc_id, text in zip(batch.column("doc_id").to_pylist(), texts, strict=True):
                words = (text.as_py() or b"").lower().split()
                doc_ids.append(doc_id)
                ids.append(np.array([known.setdefault(w, len(known) + 1) for w in words], np.uint32))
                n_tokens += len(words)
                if n_tokens >= most_tokens or len(known) >= most_words or len(ids) >= most_tokens // 8:
                    yield packed()
                    known, doc_ids, ids, n_tokens = {}, [], [], 0
                    number += 1
        if ids:
            yield packed()

    return run


class Batch:
    """The words of a batch and their pairs; number 0 starts a document."""

    def __init__(self, row: dict):
        self.lengths = np.array(row["lengths"], np.int64)
        self.hashes = np.concatenate([np.zeros(1, np.uint64), np.frombuffer(row["words"], np.uint64)])
        self.word = expanded(row["ids"]).astype(np.int32)
        self.doc = np.repeat(np.arange(len(self.lengths), dtype=np.int32), self.lengths)
        self.before = np.zeros_like(self.word)
        self.before[1:] = np.where(self.doc[1:] == self.doc[:-1], self.word[:-1], 0)
        n = len(self.hashes)
        codes, self.pair, _ = grouped(self.before.astype(np.int64) * n + self.word, n * n)
        self.pairs = pair_hashes(self.hashes[codes // n], self.hashes[codes % n])
        self.inside = np.zeros(len(self.lengths), bool)
        self.inside[np.array(row["members"] or [], np.int64)] = True

    def ranges(self, bits: int) -> Iterator[tuple[int, bool, np.ndarray]]:
        """Number, whether of words, and members in the order of their hashes, of every range that has some."""
        word_bits = max(0, bits - _WORDS_FEWER)
        for words, hashes, cut, least in ((False, self.pairs, bits, 0), (True, self.hashes[1:], word_bits, 1 << bits)):
            order = np.argsort(hashes)
            ends = np.searchsorted(hashes[order], np.arange(1, 1 << cut, dtype=np.uint64) << np.uint64(64 - cut)) if cut else []
            for at, members in enumerate(np.split(order, ends)):
                if len(members):
                    yield least + at, words, members


_KEYS = "range int, batch bigint, n bigint, keys binary, target binary, all binary"


def _keys(bits: int):
    """Distinct words and pairs of each batch with their counts in target documents and in all, by range."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                row = batch.slice(i, 1).to_pylist()[0]
                own, out = Batch(row), []
                inside = own.inside[own.doc]
                counts = {}
                for words, places, n in ((False, own.pair, len(own.pairs)), (True, own.word - 1, len(own.hashes) - 1)):
                    counts[words] = np.bincount(places[inside], minlength=n), np.bincount(places, minlength=n)
                for at, words, members in own.ranges(bits):
                    keys = (own.hashes[1:] if words else own.pairs)[members]
                    steps = np.diff(keys, prepend=np.uint64(0))
                    target, total = (c[members] for c in counts[words])
                    # the first key apart, so that the steps stay narrow
                    out.append((at, row["batch"], len(keys), keys[:1].tobytes() + squeezed(steps[1:]), squeezed(target), squeezed(total)))
                if out:
                    types = (pa.int32(), pa.int64(), pa.int64(), pa.binary(), pa.binary(), pa.binary())
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(c, t) for c, t in zip(zip(*out), types, strict=True)], ["range", "batch", "n", "keys", "target", "all"])

    return run


_COUNTS = "range int, batch bigint, distinct bigint, target binary, all binary"


def _sums(rows: pa.Table) -> pa.Table:
    """Counts over all batches for every key of each batch, in the batch's order; the first row has the distinct keys."""
    keys = []
    for data in rows.column("keys").to_pylist():
        keys.append(np.cumsum(np.concatenate([np.frombuffer(data[:8], np.uint64), expanded(data[8:])]), dtype=np.uint64))
    found, place = np.unique(np.concatenate(keys), return_inverse=True)
    ends = np.cumsum([len(k) for k in keys])[:-1]
    del keys
    out = {}
    for name in ("target", "all"):
        own = np.concatenate([expanded(data) for data in rows.column(name).to_pylist()])
        sums = np.bincount(place, weights=own, minlength=len(found)).astype(np.uint64)
        out[name] = [squeezed(part) for part in np.split(sums[place], ends)]
    return pa.table({
        "range": rows.column("range"), "batch": rows.column("batch"),
        "distinct": pa.array([len(found)] + [0] * (rows.num_rows - 1), pa.int64()),
        "target": pa.array(out["target"], pa.binary()), "all": pa.array(out["all"], pa.binary())})


def _losses(own: Batch, word: np.ndarray, pair: np.ndarray, sizes, vocabulary: int) -> np.ndarray:
    """For each document the sum over its tokens of minus the logarithm of the probability, by both models.

    Rows of ``word`` and ``pair`` are the counts in target documents and in all, the
    first word being the start. What the document itself has added to a model is taken
    out of it.
    """
    out = np.zeros((2, len(own.lengths)))
    ends = np.cumsum(own.lengths)
    first = 0
    while first < len(ends):
        # whole documents, at least one
        begin = ends[first] - own.lengths[first]
        last = max(first + 1, int(np.searchsorted(ends, begin + SCORED_TOKENS, "right")))
        at, lengths = slice(begin, ends[last - 1]), own.lengths[first:last]
        doc, words, before, pairs = own.doc[at].astype(np.int64) - first, own.word[at], own.before[at], own.pair[at]
        _, place, uses = grouped(doc * word.shape[1] + words, len(lengths) * word.shape[1])
        own_word = uses[place]
        # the same word one place later, or the document's one start
        own_before = np.ones_like(own_word)
        own_before[1:] = np.where(before[1:] > 0, own_word[:-1], 1)
        _, place, uses = grouped(doc * pair.shape[1] + pairs, len(lengths) * max(1, pair.shape[1]))
        own_pair = uses[place]
        for model, scale in ((0, 1.0), (1, sizes[0] / sizes[1] if sizes[1] else 1.0)):
            added = np.ones(len(lengths), np.int64) if model else own.inside[first:last].astype(np.int64)
            each = added[doc]
            alone = (word[model][words] - each * own_word) * scale + ADDED
            total = np.maximum(sizes[0] - added * lengths * scale, 0) + ADDED * vocabulary
            alone /= total[doc]
            context = word[model][before] - each * own_before
            share = np.divide(pair[model][pairs] - each * own_pair, context, out=np.zeros(len(context)), where=context > 0)
            p = np.where(context > 0, PAIR_WEIGHT * share + (1 - PAIR_WEIGHT) * alone, alone)
            out[model, first:last] = np.bincount(doc, weights=-np.log(p), minlength=len(lengths))
        first = last
    return out


_SCORES = "doc_id bigint, n_tokens bigint, target_loss double, background_loss double, score double"


def _score(bits: int, sizes: tuple[int, int], starts: tuple[int, int], vocabulary: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                row = batch.slice(i, 1).to_pylist()[0]
                own = Batch(row)
                word, pair = np.zeros((2, len(own.hashes)), np.int64), np.zeros((2, len(own.pairs)), np.int64)
                word[:, 0] = starts
                found = {c["range"]: c for c in row["counts"] or []}
                for at, words, members in own.ranges(bits):
                    for model, name in enumerate(("target", "all")):
                        (word if words else pair)[model, members + words] = expanded(found[at][name])
                target, background = (x / np.maximum(own.lengths, 1) for x in _losses(own, word, pair, sizes, vocabulary))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(row["doc_ids"], pa.int64()), *map(pa.array, (own.lengths, target, background, target - background))],
                    ["doc_id", "n_tokens", "target_loss", "background_loss", "score"])

    return run


def members(packed: DataFrame, target_ids: DataFrame) -> DataFrame:
    """Of each batch the places of its documents that belong to the target, how many have tokens, and their tokens."""
    wanted = target_ids.select(F.col("doc_id").alias("of")).distinct()
    docs = packed.select("batch", F.posexplode(F.arrays_zip("doc_ids", "lengths")).alias("at", "doc"))
    docs = docs.select("batch", "at", F.col("doc.doc_ids").alias("doc_id"), F.col("doc.lengths").alias("length"))
    found = merge_join(docs, wanted, F.col("doc_id") == F.col("of"))
    return found.groupBy("batch").agg(
        F.collect_list("at").alias("members"), F.sum((F.col("length") > 0).cast("long")).alias("starts"), F.sum("length").alias("tokens"))


def score_documents(docs: DataFrame, target_ids: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id``, ``n_tokens``, both mean losses and their difference ``score`` for every row.

    Words are runs without ASCII white space after A-Z have been lowered. A document
    is scored against the counts of all others. Null and empty texts have no tokens
    and score 0. Repeated rows are counted as often as they occur and each get the
    same score; a null doc_id belongs to no target. Without target documents both
    losses come from smoothing alone. Other columns are not read.
    """
    rows = docs.select(F.col(quoted(id_col)).cast("long").alias("doc_id"), F.col(quoted(text_col)).alias("text"))
    packed = stored(map_arrow(rows, _pack(BATCH_TOKENS, BATCH_WORDS), _PACKED), "packed")
    inside = stored(members(packed, target_ids), "members")
    each = packed.select(F.explode("lengths").alias("length"))
    n_all, n_starts = each.agg(F.coalesce(F.sum("length"), F.lit(0)), F.count(F.when(F.col("length") > 0, 1))).first()
    n_target, n_target_starts = inside.agg(F.coalesce(F.sum("tokens"), F.lit(0)), F.coalesce(F.sum("starts"), F.lit(0))).first()
    bits = max(LEAST_BITS, (n_all // RANGE_TOKENS).bit_length())

    of = inside.select(F.col("batch").alias("of"), "members")
    keyed = merge_join(packed, of, F.col("batch") == F.col("of"), "left").select("batch", "lengths", "ids", "words", "members")
    keys = map_arrow(keyed, _keys(bits), _KEYS)
    counts = stored(keys.groupBy("range").applyInArrow(_sums, _COUNTS), "counts")
    distinct = counts.where(F.col("range") >= 1 << bits).agg(F.coalesce(F.sum("distinct"), F.lit(0))).first()[0]
    vocabulary = max(1, distinct)  # of the corpus, whatever its size

    back = counts.groupBy(F.col("batch").alias("to")).agg(F.collect_list(F.struct("range", "target", "all")).alias("counts"))
    ready = merge_join(merge_join(packed, of, F.col("batch") == F.col("of"), "left"), back, F.col("batch") == F.col("to"), "left")
    score = _score(bits, (n_target, n_all), (n_target_starts, n_starts), vocabulary)
    return map_arrow(ready.select("doc_ids", "lengths", "ids", "words", "members", "counts"), score, _SCORES)
