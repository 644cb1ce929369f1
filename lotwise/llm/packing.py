"""Best-fit packing by a grouping genetic algorithm on islands.

Documents become token pieces of at most one sequence. Full pieces are sequences
already; the others are dealt at random into blocks of bounded size, so that each
block is a bin packing problem of its own and the number of problems, not their
size, grows with the corpus. Several islands evolve a population for each block:
crossover injects whole well-filled bins of one parent into another, dissolves the
bins that hold a duplicate, and best-fits the displaced pieces. Between epochs the
best individual of each island migrates to the next island of the block. A block
whose best packing meets the lower bound is not evolved further.

The pieces of the emptiest bins of all blocks meet again in further rounds, in new
and fewer blocks, until a round has one block; so the corpus, not each block, has
a last bin that is not well filled.
"""

from __future__ import annotations

import base64
import functools
import re
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from lotwise.llm.common import map_arrow, quoted, stored

SEQUENCE = 1024
END_ID = 2
BLOCK_PIECES = 2048
ISLANDS = 2
POPULATION = 4
GENERATIONS = 3
EPOCHS = 2
# Share of a block's bins, the emptiest ones, whose pieces meet those of other blocks in the next round,
# as long as they hold at most half of its pieces.
AGAIN = 0.125

PIECES = "doc_id bigint, piece int, start bigint, length bigint, ids_crc32 bigint"
# For these characters both tokenizer libraries split words alike; a test compares them.
_PLAIN = re.compile(r"[\t\n\r\x20-\x7e¡-ſ‐-‧‰-⁞€]*")


@functools.lru_cache(maxsize=4)
def _tokenizers(vocabulary: str, control: bool = False):
    """The tokenizer of a vocabulary file, a faster one over the same ranks where there is one, and its control strings.

    With ``control``, as the file says, control strings inside a text become their own ids.
    """
    import public_tokenizers
    import tiktoken
    from tokenizers import Tokenizer

    exact = Tokenizer.from_file(public_tokenizers.path(vocabulary))
    exact.encode_special_tokens = not control
    strings = [t.content for t in exact.get_added_tokens_decoder().values()] if control else []
    ranks_file = vocabulary.removesuffix(".json") + ".tiktoken"
    if vocabulary != "byte_bpe_50k.json":
        return exact, None, strings
    with open(public_tokenizers.path(ranks_file), "rb") as lines:
        ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}
    fast = tiktoken.Encoding(vocabulary, pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    return exact, fast, strings


def token_ids(text: str, vocabulary: str = "byte_bpe_50k.json", control: bool = False) -> np.ndarray:
    exact, fast, strings = _tokenizers(vocabulary, control)
    if fast is not None and _PLAIN.fullmatch(text) and not any(s in text for s in strings):
        return fast.encode_to_numpy(text, disallowed_special=())
    return np.array(exact.encode(text, add_special_tokens=False).ids, np.uint32)


def cut(n: int, capacity: int) -> list[tuple[int, int]]:
    """Start and length of a document's pieces: full ones, and the rest in front."""
    rest = n % capacity
    edges = ([0, rest] if rest else [0]) + list(range(rest + capacity, n + 1, capacity))
    return list(zip(edges[:-1], np.diff(edges).tolist(), strict=True))


def _cut_documents(vocabulary: str, end_id: int, capacity: int, control: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out: tuple[list, ...] = ([], [], [], [], [])
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                ids = np.append(token_ids(text or "", vocabulary, control), end_id).astype("<u4")
                for piece, (start, length) in enumerate(cut(len(ids), capacity)):
                    row = (doc_id, piece, start, length, zlib.crc32(ids[start:start + length].tobytes()))
                    for column, value in zip(out, row, strict=True):
                        column.append(value)
            types = (pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64())
            names = ["doc_id", "piece", "start", "length", "ids_crc32"]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(out, types, strict=True)], names)

    return run


def pieces(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", vocabulary: str = "byte_bpe_50k.json",
           end_id: int = END_ID, capacity: int = SEQUENCE, control: bool = True) -> DataFrame:
    """Token pieces of every document; a null text is an empty one, of just the end id.

    Control strings inside a text, such as ``<|endoftext|>``, become what the vocabulary's
    tokenizer makes of them, its control ids; without ``control`` they are plain text.
    """
    rows = docs.select(F.col(quoted(id_col)).cast("long").alias("doc_id"), F.col(quoted(text_col)).alias("text"))
    return map_arrow(rows, _cut_documents(vocabulary, end_id, capacity, control), PIECES)


# --- one block: an individual is the bin of each piece, numbered from 0 ---------------------


def best_fit(lengths: list[int], order: list[int], bins: np.ndarray, fills: list[int], capacity: int) -> None:
    """Put the pieces of ``order`` into the fullest bins they fit, changing ``bins`` and ``fills``."""
    by_room: list[list[int]] = [[] for _ in range(capacity + 1)]
    rooms = 0  # bit r is set if a bin has room r
    for number, fill in enumerate(fills):
        by_room[capacity - fill].append(number)
        rooms |= 1 << (capacity - fill)
    for item in order:
        size = lengths[item]
        fitting = rooms >> size
        if fitting:
            room = size + (fitting & -fitting).bit_length() - 1
            number = by_room[room].pop()
            if not by_room[room]:
                rooms ^= 1 << room
        else:
            room, number = capacity, len(fills)
            fills.append(0)
        bins[item] = number
        fills[number] += size
        room -= size
        by_room[room].append(number)
        rooms |= 1 << room


def fitness(bins: np.ndarray, lengths: np.ndarray, capacity: int) -> float:
    """Fewer bins first, then fuller and emptier ones instead of many alike; larger is better."""
    fills = np.bincount(bins, weights=lengths)
    return float(-len(fills) + np.mean((fills / capacity) ** 2))


def crossover(receiver: np.ndarray, giver: np.ndarray, lengths: np.ndarray, capacity: int, rng) -> np.ndarray:
    """Well-filled bins of ``giver`` go whole into ``receiver``; what they displace is best-fitted."""
    fills = np.bincount(giver, weights=lengths)
    well = np.flatnonzero(fills >= np.quantile(fills, 0.5))
    chosen = np.zeros(len(fills), bool)
    chosen[rng.choice(well, size=max(1, len(well) // 2), replace=False)] = True
    injected = chosen[giver]
    dissolved = np.zeros(int(receiver.max()) + 1, bool)
    dissolved[receiver[injected]] = True
    # an emptiest bin goes too, so that the child can need one bin less
    dissolved[int(np.argmin(np.bincount(receiver, weights=lengths)))] = True
    stays = ~injected & ~dissolved[receiver]
    label = np.where(injected, len(dissolved) + giver, receiver)
    child = np.full(len(receiver), -1, np.int64)
    placed = injected | stays
    child[placed] = np.unique(label[placed], return_inverse=True)[1]
    fills = np.bincount(child[placed], weights=lengths[placed]).astype(int).tolist()
    # pieces are numbered from the longest, so this is best-fit decreasing
    best_fit(lengths.tolist(), np.flatnonzero(~placed).tolist(), child, fills, capacity)
    return child


def lower_bound(lengths: np.ndarray, capacity: int) -> int:
    """No packing has fewer bins: by total, and by the pieces over half a bin."""
    return max(-(-int(lengths.sum()) // capacity), int((2 * lengths > capacity).sum()))


def evolve(population: list[np.ndarray], lengths: np.ndarray, capacity: int, generations: int, rng) -> list[np.ndarray]:
    """Generations of crossover; the best individual always survives. Best first."""
    bound = lower_bound(lengths, capacity)

    def ranked(individuals):
        return sorted(individuals, key=lambda b: -fitness(b, lengths, capacity))

    population = ranked(population)
    size = len(population)
    for _ in range(generations):
        if population[0].max() + 1 <= bound:
            break
        children = []
        for _ in range(size):
            one, two = sorted(rng.choice(size, size=2, replace=False)) if size > 1 else (0, 0)
            children.append(crossover(population[two], population[one], lengths, capacity, rng))
        population = ranked([*population, *children])[:size]
    return population


def first_population(lengths: np.ndarray, capacity: int, size: int, rng) -> list[np.ndarray]:
    """Best-fit decreasing, and best-fit by lengths with a random disturbance."""
    found = []
    plain = lengths.tolist()
    for number in range(size):
        noise = rng.normal(0, 0.05 * capacity * number, len(lengths)) if number else np.zeros(len(lengths))
        order = np.argsort(-(lengths + noise), kind="stable").tolist()
        bins, fills = np.zeros(len(lengths), np.int64), []
        best_fit(plain, order, bins, fills, capacity)
        found.append(bins)
        if len(fills) <= lower_bound(lengths, capacity):
            break
    return found


# --- islands --------------------------------------------------------------------------------

_STATE = "block bigint, island int, lengths binary, population array<binary>, score double"


def _epoch(capacity: int, population: int, generations: int, epoch: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for row in batch.to_pylist():
                lengths = np.frombuffer(row["lengths"], "<i2").astype(np.int64)
                rng = np.random.default_rng([row["block"], row["island"], epoch])
                before = [np.frombuffer(b, "<i2").astype(np.int64) for b in row["population"] or []]
                if row["migrant"] is not None:
                    before.append(np.frombuffer(row["migrant"], "<i2").astype(np.int64))
                before = before or first_population(lengths, capacity, population, rng)
                best = evolve(before, lengths, capacity, generations, rng)[:population]
                out.append({"block": row["block"], "island": row["island"], "lengths": row["lengths"],
                            "population": [b.astype("<i2").tobytes() for b in best],
                            "score": fitness(best[0], lengths, capacity)})
            yield pa.RecordBatch.from_pylist(out, pa.schema([
                ("block", pa.int64()), ("island", pa.int32()), ("lengths", pa.binary()),
                ("population", pa.list_(pa.binary())), ("score", pa.float64())]))

    return run


def _islands(blocks: DataFrame, islands: int, population: int, generations: int, epochs: int, capacity: int) -> DataFrame:
    """The best packing of each block: ``block``, ``packing``."""
    state = blocks.select("block", F.explode(F.sequence(F.lit(0), F.lit(islands - 1))).alias("island"), "lengths",
                          F.lit(None).cast("array<binary>").alias("population"), F.lit(None).cast("binary").alias("migrant"))
    # blocks lie together in the table; every island shall be a task's work of its own
    state = state.repartition(F.col("block"), F.col("island"))
    for epoch in range(epochs):
        state = stored(map_arrow(state, _epoch(capacity, population, generations, epoch), _STATE), "islands")
        if epoch < epochs - 1:
            elites = state.select(
                F.col("block").alias("from"), ((F.col("island") + 1) % islands).alias("to"), F.col("population")[0].alias("migrant"))
            state = state.join(elites, (F.col("block") == F.col("from")) & (F.col("island") == F.col("to")))
            state = state.select("block", "island", "lengths", "population", "migrant")
    return state.groupBy("block").agg(
        F.max(F.struct("score", "island", F.col("population")[0].alias("packing"))).alias("best")
    ).select(F.col("block").alias("packed_block"), "best.packing")


def emptiest(bins: np.ndarray, lengths: np.ndarray, capacity: int, share: float = AGAIN) -> np.ndarray:
    """True for the pieces of the emptiest bins, see ``AGAIN``; full bins stay."""
    fills = np.bincount(bins, weights=lengths)
    order = np.argsort(fills, kind="stable")
    order = order[: max(1, int(share * len(fills)))]
    held = np.cumsum(np.bincount(bins)[order])
    order = order[(2 * held <= len(bins)) & (fills[order] < capacity)]
    return np.isin(bins, order)


def _place(capacity: int, first_block: int, last: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                bins = np.frombuffer(row["packing"], "<i2").astype(np.int64)
                lengths = np.array([m["length"] for m in row["members"]], np.int64)
                order = np.argsort(bins, kind="stable")
                ends = np.cumsum(lengths[order])
                first = np.concatenate([[True], bins[order][1:] != bins[order][:-1]])
                offsets = np.zeros(len(bins), np.int64)
                starts = ends - lengths[order]
                offsets[order] = starts - np.repeat(starts[first], np.diff(np.append(np.flatnonzero(first), len(bins))))
                names = ["doc_id", "piece", "start", "length", "ids_crc32"]
                types = (pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64())
                yield pa.RecordBatch.from_arrays([
                    *[pa.array([m[n] for m in row["members"]], t) for n, t in zip(names, types, strict=True)],
                    pa.array((first_block + row["block"]) * capacity * (1 << 13) + bins, pa.int64()), pa.array(offsets, pa.int64()),
                    pa.array(np.zeros(len(bins), bool) if last else emptiest(bins, lengths, capacity)),
                ], [*names, "sequence_id", "offset", "again"])

    return run


def pack(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", vocabulary: str = "byte_bpe_50k.json",
         end_id: int = END_ID, capacity: int = SEQUENCE, block_pieces: int = BLOCK_PIECES, islands: int = ISLANDS,
         population: int = POPULATION, generations: int = GENERATIONS, epochs: int = EPOCHS, control: bool = True) -> DataFrame:
    """Place of every piece of every document in a sequence of at most ``capacity`` tokens.

    A document is its token ids and ``end_id``. Only longer ones are cut, into full
    pieces after a first one that may be shorter. Sequences are gapless from offset
    0; full pieces have negative sequence ids. Null and empty texts are one token
    long. Repeated rows and null doc_ids are packed like any other row. Other
    columns are not read; an empty table gives an empty result.
    """
    if not (1 < capacity <= 1 << 14 and 1 <= block_pieces <= 1 << 13):
        raise ValueError("capacity must be from 2 to 16384, block_pieces from 1 to 8192")
    cut_up = stored(pieces(docs, id_col, text_col, vocabulary, end_id, capacity, control), "pieces")
    row = F.monotonically_increasing_id()
    full = cut_up.where(F.col("length") == capacity).select(
        "*", (-1 - row).alias("sequence_id"), F.lit(0).cast("long").alias("offset"))
    part, result, first_block = cut_up.where(F.col("length") < capacity), full, 0
    while True:
        n_blocks = max(1, round(part.count() / block_pieces))
        # by place in the stored table, so that repeated rows spread as well
        dealt = part.withColumn("block", F.pmod(F.xxhash64(row), F.lit(n_blocks)))
        member = F.struct(F.expr("-length").alias("key"), "doc_id", "piece", "start", "length", "ids_crc32")
        blocks = dealt.groupBy("block").agg(F.sort_array(F.collect_list(member)).alias("members"))
        blocks = stored(blocks, "blocks")
        packed = _islands(map_arrow(blocks, _lengths, "block bigint, lengths binary"),
                          islands, population, generations, epochs, capacity)
        placed = blocks.join(packed, F.col("block") == F.col("packed_block")).select("block", "members", "packing")
        last = n_blocks == 1
        placed = map_arrow(placed, _place(capacity, first_block, last), f"{PIECES}, sequence_id bigint, offset bigint, again boolean")
        if last:
            return placed.drop("again").unionByName(result)
        placed = stored(placed, "placed")
        result = placed.where("NOT again").drop("again").unionByName(result)
        # at most half of the pieces of this round, so rounds are a logarithm of the corpus
        part, first_block = stored(placed.where("again").select(*cut_up.columns), "again"), first_block + n_blocks


def _lengths(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        lengths = [np.array([m["length"] for m in members], "<i2").tobytes() for members in batch.column("members").to_pylist()]
        yield pa.RecordBatch.from_arrays([batch.column("block"), pa.array(lengths, pa.binary())], ["block", "lengths"])
