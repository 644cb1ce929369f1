"""Alignment of the tokens of two tokenizers on the same text.

Both token sequences of a text tile its bytes. All tokens of a chunk of documents are
sorted together by their first byte; a running maximum of their ends breaks them into
groups wherever a token starts at or past every end before it, which is where both
sequences end. Within a group the tokens of one side that overlap a token of the other
are expanded from two binary searches; links are the overlapping pairs that end
together, or all of them.

Documents become chunks. A chunk sends each distinct linked id pair once to be summed
over all chunks, and gets back the sums of just these, so no table of pairs is sent
to every task and no text crosses the network.
"""

from __future__ import annotations

import functools
import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F

from lotwise.llm.batches import answered, exploded
from lotwise.llm.common import map_arrow, quoted, stored
from lotwise.llm.packing import token_ids

A_VOCABULARY = "byte_bpe_50k.json"
B_VOCABULARY = "piece_bpe_32k.model"
CHUNK_BYTES = 1 << 21

# --- tokenizers -----------------------------------------------------------------------------


def _byte_characters() -> dict[str, int]:
    """The character that stands for each byte in entries of a byte-level vocabulary.

    Printable ones stand for themselves, all others are numbered from 256.
    """
    own = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    others = [b for b in range(256) if b not in set(own)]
    return {chr(b): b for b in own} | {chr(256 + n): b for n, b in enumerate(others)}


@functools.lru_cache(maxsize=2)
def a_tokens(vocabulary: str) -> list[bytes]:
    """The bytes of every id of a byte-level vocabulary."""
    import public_tokenizers
    from tokenizers import Tokenizer

    byte_of = _byte_characters()
    entries = Tokenizer.from_file(public_tokenizers.path(vocabulary)).get_vocab()
    out = [b""] * (max(entries.values()) + 1)
    for entry, number in entries.items():
        out[number] = bytes(byte_of[c] for c in entry) if all(c in byte_of for c in entry) else entry.encode()
    return out


@functools.lru_cache(maxsize=2)
def b_tokens(vocabulary: str):
    """A sentence piece model and the bytes of each of its ids."""
    import public_tokenizers
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path(vocabulary))
    pieces = map(model.id_to_piece, range(model.get_piece_size()))
    found = [bytes([int(piece[1:-1], 16)]) if model.is_byte(number) else piece.replace("▁", " ").encode()
             for number, piece in enumerate(pieces)]
    return model, found


def b_ids(text: str, vocabulary: str) -> list[int]:
    """Ids of a text by the sentence piece model."""
    return b_tokens(vocabulary)[0].encode(text, num_threads=1)


# --- alignment of a chunk -------------------------------------------------------------------


def coalesced(start: np.ndarray, end: np.ndarray, side: np.ndarray) -> np.ndarray:
    """The group of each interval: a new one begins where a start reaches the running maximum of the ends."""
    order = np.lexsort((side, start))
    reach = np.maximum.accumulate(end[order])
    breaks = np.ones(len(order), bool)
    breaks[1:] = start[order][1:] >= reach[:-1]
    group = np.empty(len(order), np.int64)
    group[order] = np.cumsum(breaks) - 1
    return group


def overlaps(a_start: np.ndarray, a_end: np.ndarray, b_start: np.ndarray, b_end: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places of all pairs of an A and a B token that share a byte; each side tiles the same bytes."""
    first = np.searchsorted(b_end, a_start, "right")
    n = np.searchsorted(b_start, a_end, "left") - first
    a = np.repeat(np.arange(len(a_start)), n)
    b = np.arange(len(a)) - np.repeat(np.cumsum(n) - n, n) + np.repeat(first, n)
    return a, b


class Chunk:
    """Documents whose tokens are aligned together, one after the other."""

    def __init__(self, a_vocabulary: str, b_vocabulary: str, link: str):
        self.a_vocabulary, self.b_vocabulary, self.link = a_vocabulary, b_vocabulary, link
        self.a_bytes, self.b_bytes = a_tokens(a_vocabulary), b_tokens(b_vocabulary)[1]
        self.a_size, self.b_size = (np.array([len(t) for t in tokens], np.int64) for tokens in (self.a_bytes, self.b_bytes))
        self.names = [str(n) + mark for mark in (",", "|", ";", "") for n in range(max(len(self.a_bytes), len(self.b_bytes)))]

    def tokens(self, text: str | None) -> tuple[np.ndarray, np.ndarray]:
        """Ids by A and B; none where either does not give back the text."""
        none = np.zeros(0, np.int64)
        if not text:
            return none, none
        whole = " " + text
        a, b = token_ids(whole, self.a_vocabulary).astype(np.int64), np.array(b_ids(text, self.b_vocabulary), np.int64)
        wanted = whole.encode()
        if any(b"".join(map(tokens.__getitem__, ids.tolist())) != wanted for tokens, ids in ((self.a_bytes, a), (self.b_bytes, b))):
            return none, none
        return a, b

    def aligned(self, texts: list[str | None]) -> dict:
        """For each document its counts and digest, and its links as places in the chunk's distinct id pairs."""
        found = [self.tokens(t) for t in texts]
        n_a, n_b = (np.array([len(f[s]) for f in found], np.int64) for s in (0, 1))
        a, b = (np.concatenate([f[s] for f in found]) for s in (0, 1))
        a_end, b_end = np.cumsum(self.a_size[a]), np.cumsum(self.b_size[b])
        a_start, b_start = a_end - self.a_size[a], b_end - self.b_size[b]
        docs = np.arange(len(texts))
        start, side = np.concatenate([a_start, b_start]), np.repeat([0, 1], [len(a), len(b)])
        doc = np.concatenate([np.repeat(docs, n_a), np.repeat(docs, n_b)])
        group = coalesced(start, np.concatenate([a_end, b_end]), side)

        order = np.lexsort((start, side, group))
        ids, group, side, doc = np.concatenate([a, b])[order], group[order], side[order], doc[order]
        mark = np.full(len(ids), 3)
        mark[:-1] = np.where(doc[1:] != doc[:-1], 3, np.where(group[1:] != group[:-1], 2, np.where(side[1:] != side[:-1], 1, 0)))
        spelled = (mark * (len(self.names) // 4) + ids).tolist()
        edges = np.searchsorted(doc, np.arange(len(texts) + 1)).tolist()
        digests = [hashlib.sha256("".join(map(self.names.__getitem__, spelled[x:y])).encode()).hexdigest() if x < y else ""
                   for x, y in zip(edges[:-1], edges[1:], strict=True)]
        ends = np.flatnonzero(mark >= 2)

        i, j = overlaps(a_start, a_end, b_start, b_end)
        if self.link == "end":
            together = a_end[i] == b_end[j]
            i, j = i[together], j[together]
        of = np.repeat(docs, n_a)[i]
        pairs, place = np.unique(a[i] << 32 | b[j], return_inverse=True)
        entries, uses = np.unique(of * max(1, len(pairs)) + place, return_counts=True)
        return {"n_a": n_a, "n_b": n_b, "n_groups": np.bincount(doc[ends], minlength=len(texts)),
                "n_links": np.bincount(of, minlength=len(texts)), "groups_sha256": digests,
                "pairs": pairs, "counts": np.bincount(place, minlength=len(pairs)),
                "of": entries // max(1, len(pairs)), "place": entries % max(1, len(pairs)), "uses": uses}


_COUNTS = ("n_a", "n_b", "n_groups", "n_links")
_CHUNKS = "batch bigint, doc_ids array<bigint>, " + "".join(f"{c} array<bigint>, " for c in _COUNTS) + (
    "groups_sha256 array<string>, pairs array<bigint>, counts array<bigint>, n_entries bigint, entries binary")


def _chunks(a_vocabulary: str, b_vocabulary: str, link: str, chunk_bytes: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = TaskContext.get().partitionId() << 32
        chunk = Chunk(a_vocabulary, b_vocabulary, link)
        doc_ids, texts, held = [], [], 0

        def row() -> pa.RecordBatch:
            found = chunk.aligned(texts)
            entries = np.concatenate([found[c].astype("<u4") for c in ("of", "place", "uses")])
            longs, names = pa.list_(pa.int64()), ["doc_ids", *_COUNTS, "groups_sha256", "pairs", "counts"]
            found["doc_ids"] = doc_ids
            return pa.RecordBatch.from_arrays([
                pa.array([number], pa.int64()),
                *[pa.array([found[c]], pa.list_(pa.string()) if c == "groups_sha256" else longs) for c in names],
                pa.array([len(found["of"])], pa.int64()), pa.array([pa.compress(entries.tobytes(), "zstd", asbytes=True)], pa.binary()),
            ], ["batch", *names, "n_entries", "entries"])

        for batch in batches:
            for doc_id, text in zip(batch.column(0), batch.column(1), strict=True):
                doc_ids.append(doc_id.as_py())
                texts.append(text.as_py())
                held += len(texts[-1] or "") + 64
                if held >= chunk_bytes:
                    yield row()
                    number, doc_ids, texts, held = number + 1, [], [], 0
        if doc_ids:
            yield row()

    return run


_RESULT = "doc_id bigint, " + "".join(f"{c} bigint, " for c in (*_COUNTS, "n_best", "count_sum")) + "groups_sha256 string"


def _scored(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for number in range(batch.num_rows):
            row = {name: column[number] for name, column in zip(batch.schema.names, batch.columns, strict=True)}
            doc_ids = row["doc_ids"].values
            count, best = np.zeros((2, row["n_pairs"].as_py()), np.int64)
            if row["answers"].is_valid:
                answers = row["answers"].values
                at = answers.field("at").to_numpy()
                count[at], best[at] = answers.field("n").to_numpy(), answers.field("best").to_numpy()
            data = pa.decompress(row["entries"].as_py(), row["n_entries"].as_py() * 12, "zstd", asbytes=True)
            of, place, uses = np.frombuffer(data, "<u4").astype(np.int64).reshape(3, -1)
            sums = []
            for value in (best, count):
                total = np.zeros(len(doc_ids), np.int64)
                np.add.at(total, of, uses * value[place])
                sums.append(pa.array(total))
            yield pa.RecordBatch.from_arrays(
                [doc_ids, *[row[c].values for c in _COUNTS], *sums, row["groups_sha256"].values],
                ["doc_id", *_COUNTS, "n_best", "count_sum", "groups_sha256"])


def align(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", a_vocabulary: str = A_VOCABULARY,
          b_vocabulary: str = B_VOCABULARY, link: str = "end", chunk_bytes: int = CHUNK_BYTES) -> DataFrame:
    """How the tokens of A and B align in every document, one row each.

    A encodes a space and the text, B the text, to which it adds the space itself;
    control strings inside texts are plain text. ``n_groups`` counts the spans between
    common ends, ``groups_sha256`` digests their ids as ``a1,a2|b1;a3|b2,b3``.
    ``link`` is "end" (token pairs that end together) or "overlap" (pairs that share a
    byte). The count of an id pair is the number of links that hold it in the whole
    corpus; ``n_best`` counts the links whose pair has the highest count of its B id,
    ties included, ``count_sum`` sums the counts over the links.

    Null and empty texts, and texts that either tokenizer does not give back byte by
    byte, have no tokens: zeros and an empty digest. Repeated rows count each time and
    each have a row, a null doc_id too. Other columns are not read; an empty table
    gives an empty result.
    """
    if link not in ("end", "overlap"):
        raise ValueError("link must be 'end' or 'overlap'")
    rows = docs.select(F.col(quoted(id_col)).cast("long").alias("doc_id"), F.col(quoted(text_col)).alias("text"))
    chunks = stored(map_arrow(rows, _chunks(a_vocabulary, b_vocabulary, link, chunk_bytes), _CHUNKS), "chunks")
    asked = exploded(chunks.select("batch", "pairs", "counts"), "pairs", "counts")
    sums = asked.groupBy("pairs").agg(F.sum("counts").alias("n")).withColumn("b", F.expr("pairs & 4294967295L"))
    sums = stored(sums, "pairs")
    highest = sums.groupBy(F.col("b").alias("of_b")).agg(F.max("n").alias("highest"))
    known = sums.join(highest, F.col("b") == F.col("of_b")).select(
        F.col("pairs").alias("pair"), "n", (F.col("n") == F.col("highest")).cast("int").alias("best"))
    asking = chunks.withColumn("n_pairs", F.size("pairs")).drop("pairs", "counts")
    ready = answered(asking, asked.select("batch", "at", "pairs"), known, F.col("pairs") == F.col("pair"), "n", "best")
    return map_arrow(ready, _scored, _RESULT)
