"""Benchmark decontamination with suffix arrays over the training words.

Each task cuts its documents into shards of bounded size and sorts the shard's
word suffixes into a suffix array. Every suffix of every test item is looked up by
binary search; the range it gives holds all places of its first words, so matches
come with their locations, and matches on one diagonal join to the longest
verbatim ones. A suffix that begins with a word no test item has cannot match, so
the array holds only those whose first words are all known.

Documents are never shuffled. Test items travel as blocks of at most
``BLOCK_BYTES`` of text; more text means more passes, and each pass adds to what
the passes before have found.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F, types as T

from lotwise.llm.common import map_arrow, quoted

WINDOW = 13
MIN_SHARE = 20  # contaminated if 20 * n_hit >= n_words
BLOCK_BYTES = 32 * 1024 * 1024
SHARD_WORDS = 1 << 20

# separators of [^\x00-\x2F\x3A-\x60\x7B-\x7F]+ after A-Z have been lowered
_TO_SPACE = bytes(b if b >= 0x80 or 0x30 <= b <= 0x39 or 0x61 <= b <= 0x7A else 0x20 for b in range(256))


def words_of(text: bytes | None) -> list[bytes]:
    return text.lower().translate(_TO_SPACE).split() if text else []


class TestSuffixes:
    """The window-long suffixes of a block of test items, ready to be looked up."""

    __test__ = False

    def __init__(self, items: list[tuple[str, bytes | None]], window: int = WINDOW):
        self.window = window
        vocabulary: dict[bytes, int] = {}
        owner, offset, length, rows = [], [], [], []
        self.names: list[str] = []
        for name, text in items:
            words = words_of(text)
            if not words:
                continue
            ids = [vocabulary.setdefault(w, len(vocabulary) + 1) for w in words]
            size = min(window, len(ids))
            for at in range(len(ids) - size + 1):
                rows.append(ids[at:at + size] + [0] * (window - size))
                owner.append(len(self.names))
                offset.append(at)
                length.append(size)
            self.names.append(name)
        self.vocabulary = vocabulary
        self.owner, self.offset = np.array(owner, np.int64), np.array(offset, np.int64)
        self.length = np.array(length, np.int64)
        self.shortest = int(self.length.min()) if rows else 0
        table = np.array(rows, ">u4").reshape(len(rows), window)
        self.low = _keys(table)
        above = np.arange(window)[None, :] >= self.length[:, None]
        self.high = _keys(np.where(above, np.array(0xFFFFFFFF, ">u4"), table).astype(">u4"))

    def matches(self, tokens: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Places of a shard and the suffixes that occur there; 0 is an unknown word."""
        none = np.zeros(0, np.int64)
        if not self.shortest or len(tokens) < self.shortest:
            return none, none
        known = np.concatenate([[0], np.cumsum(tokens > 0)])
        start = np.flatnonzero(known[self.shortest:] - known[:-self.shortest] == self.shortest)
        if not len(start):
            return none, none
        padded = np.concatenate([tokens, np.zeros(self.window, np.uint32)]).astype(">u4")
        keys = _keys(padded[start[:, None] + np.arange(self.window)])
        order = np.argsort(keys, kind="stable")
        suffix_array, keys = start[order], keys[order]
        low = np.searchsorted(keys, self.low, "left")
        found = np.searchsorted(keys, self.high, "right") - low
        which = np.repeat(np.arange(len(found)), found)
        within = np.arange(len(which)) - np.repeat(np.cumsum(found) - found, found)
        return suffix_array[low[which] + within], which


def _keys(rows: np.ndarray) -> np.ndarray:
    """Rows of big-endian words as byte strings, which compare like the rows."""
    return np.ascontiguousarray(rows).view(f"S{4 * rows.shape[1]}").reshape(-1) if len(rows) else np.zeros(0, "S4")


def _shards(texts: list[bytes | None], get) -> Iterator[tuple[int, list[int], np.ndarray]]:
    """First document, word counts and tokens of shards; an unknown word ends each document."""
    first, counts, parts, total = 0, [], [], 0
    for number, text in enumerate(texts):
        words = words_of(text)
        ids = np.zeros(len(words) + 1, np.uint32)
        ids[:-1] = list(map(get, words, repeat(0)))
        counts.append(len(words))
        parts.append(ids)
        total += len(ids)
        if total >= SHARD_WORDS:
            yield first, counts, np.concatenate(parts)
            first, counts, parts, total = number + 1, [], [], 0
    if parts:
        yield first, counts, np.concatenate(parts)


def _merge(spans: np.ndarray) -> np.ndarray:
    """Sorted, disjoint spans (start, end) that cover the same words."""
    if len(spans) < 2:
        return spans
    spans = spans[np.lexsort((spans[:, 1], spans[:, 0]))]
    ends = np.maximum.accumulate(spans[:, 1])
    new = np.concatenate([[True], spans[1:, 0] > ends[:-1]])
    return np.stack([spans[new, 0], np.maximum.reduceat(spans[:, 1], np.flatnonzero(new))], axis=1)


class _Found:
    """What has been found in one document: covered spans, items, the longest match."""

    __slots__ = ("spans", "items", "longest")

    def __init__(self, before: dict | None):
        before = before or {"spans": [], "items": [], "longest": None}
        self.spans = np.array(before["spans"], np.int64).reshape(-1, 2)
        self.items = set(before["items"])
        last = before["longest"]
        self.longest = (last["words"], last["item"], last["start"]) if last else None

    def add(self, place: np.ndarray, which: np.ndarray, tests: TestSuffixes) -> None:
        size = tests.length[which]
        self.spans = _merge(np.concatenate([self.spans, np.stack([place, place + size], axis=1)]))
        owner, offset = tests.owner[which], tests.offset[which]
        self.items.update(tests.names[i] for i in np.unique(owner))
        # a longer match shows as windows that follow each other in item and document
        order = np.lexsort((place, place - offset, owner))
        place, owner, diagonal, size = place[order], owner[order], (place - offset)[order], size[order]
        new = np.concatenate([[True], (owner[1:] != owner[:-1]) | (diagonal[1:] != diagonal[:-1]) | (place[1:] != place[:-1] + 1)])
        first = np.flatnonzero(new)
        last = np.concatenate([first[1:], [len(place)]]) - 1
        words = place[last] + size[last] - place[first]
        best = int(np.lexsort((place[first], -words))[0])
        match = (int(words[best]), tests.names[owner[first[best]]], int(place[first[best]]))
        if self.longest is None or (-match[0], match[2], match[1]) < (-self.longest[0], self.longest[2], self.longest[1]):
            self.longest = match

    def state(self, n_words: int) -> dict:
        longest = dict(zip(("words", "item", "start"), self.longest, strict=True)) if self.longest else None
        n_hit = int((self.spans[:, 1] - self.spans[:, 0]).sum())
        return {"n_words": n_words, "n_hit": n_hit, "spans": self.spans.reshape(-1).tolist(),
                "items": sorted(self.items), "longest": longest}


_STATE = T.StructType([
    T.StructField("n_words", T.LongType()),
    T.StructField("n_hit", T.LongType()),
    T.StructField("spans", T.ArrayType(T.LongType())),
    T.StructField("items", T.ArrayType(T.StringType())),
    T.StructField("longest", T.StructType([
        T.StructField("words", T.LongType()), T.StructField("item", T.StringType()), T.StructField("start", T.LongType())])),
])
_ARROW = pa.struct([
    ("n_words", pa.int64()), ("n_hit", pa.int64()), ("spans", pa.list_(pa.int64())), ("items", pa.list_(pa.string())),
    ("longest", pa.struct([("words", pa.int64()), ("item", pa.string()), ("start", pa.int64())])),
])


def search_batch(texts: list[bytes | None], before: list[dict | None], tests: TestSuffixes) -> list[dict]:
    """The state of each document after a pass over one block of tests."""
    states: list[dict] = []
    for first, counts, tokens in _shards(texts, tests.vocabulary.get):
        places, which = tests.matches(tokens)
        starts = np.cumsum([0] + [n + 1 for n in counts])
        document = np.searchsorted(starts, places, "right") - 1
        order = np.argsort(document, kind="stable")
        places, which, document = places[order], which[order], document[order]
        edges = np.searchsorted(document, np.arange(len(counts) + 1))
        for i, n_words in enumerate(counts):
            low, high = edges[i], edges[i + 1]
            if low == high and not before[first + i]:
                states.append({"n_words": n_words, "n_hit": 0, "spans": [], "items": [], "longest": None})
                continue
            found = _Found(before[first + i])
            if low < high:
                found.add(places[low:high] - starts[i], which[low:high], tests)
            states.append(found.state(n_words))
    return states


def _search(items, text_col: str, state_col: str, window: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tests = TestSuffixes(items.value, window)
        for batch in batches:
            texts = batch.column(text_col).cast(pa.binary()).to_pylist()
            own = [n for n in batch.schema.names if n != state_col]
            before = batch.column(state_col).to_pylist() if state_col in batch.schema.names else [None] * len(texts)
            state = pa.array(search_batch(texts, before, tests), _ARROW)
            yield pa.RecordBatch.from_arrays([*[batch.column(n) for n in own], state], [*own, state_col])

    return run


def blocks(benchmark: DataFrame, item_col: str, text_col: str, block_bytes: int) -> Iterator[list[tuple[str, bytes]]]:
    """The test items, in blocks of about ``block_bytes`` of text each."""
    items = benchmark.select(
        F.coalesce(F.col(quoted(item_col)).cast("string"), F.lit("")).alias("item"),
        F.col(quoted(text_col)).cast("binary").alias("text")).where("text is not null")
    size = items.agg(F.sum(F.octet_length("text") + 16)).first()[0] or 0
    n = size // block_bytes + 1
    for k in range(n):
        part = items.where(F.pmod(F.xxhash64("item", "text"), F.lit(n)) == k)
        yield [(r.item, bytes(r.text)) for r in part.distinct().collect()]


def decontaminate(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, min_share: int = MIN_SHARE,
                  text_col: str = "text", item_col: str = "item_id", item_text_col: str = "text",
                  block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """``docs`` with what was found of the test items in each text.

    Words are runs of digits, letters a-z and non-ASCII characters after A-Z are
    lowered. A window is ``window`` words of an item in a row; a shorter item with
    a word is one window. Adds ``n_words``, ``n_hit`` (words inside an occurrence),
    ``items`` (sorted ids of the items that occur), ``spans`` (their places, start
    and end in turn), ``longest`` (the longest verbatim match) and ``contaminated``
    (``n_hit`` > 0 and ``min_share`` * ``n_hit`` >= ``n_words``).

    Null and empty texts have no words and are clean. Repeated rows get the same
    answer; items with the same id count once; an item without an id is named by
    the empty string. Columns of the added names are replaced, others pass through.
    Without items, or without documents, nothing is found.
    """
    spark = docs.sparkSession
    added = ("n_words", "n_hit", "items", "spans", "longest", "contaminated")
    own = [c for c in docs.columns if c not in added]
    state = "_state"
    while state in own:
        state = "_" + state
    found = docs.select(*[F.col(quoted(c)) for c in own])
    schema = T.StructType([*found.schema.fields, T.StructField(state, _STATE)])
    for block in blocks(benchmark, item_col, item_text_col, block_bytes):
        found = map_arrow(found, _search(spark.sparkContext.broadcast(block), text_col, state, window), schema)
    return found.select(
        *[F.col(quoted(c)) for c in own], *[F.col(f"{quoted(state)}.{c}").alias(c) for c in added[:-1]],
        F.expr(f"{quoted(state)}.n_hit > 0 AND {min_share} * {quoted(state)}.n_hit >= {quoted(state)}.n_words").alias("contaminated"))


def report(found: DataFrame) -> DataFrame:
    """The result with the items as a count and a digest."""
    items = F.array_join(F.array_sort("items"), ",")
    return found.select(
        "doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"),
        F.sha2(items.cast("binary"), 256).alias("items_sha256"), "contaminated",
        F.col("longest.words").alias("longest_words"), F.col("longest.start").alias("longest_start"))


ORACLE_SQL = r"""
WITH docs AS (
  SELECT row_number() OVER () AS rid, doc_id,
         list_filter(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                        '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda w: w <> '') AS words
  FROM documents),
items AS (
  SELECT *, least(13, len(words)) AS size
  FROM (SELECT row_number() OVER () AS iid, coalesce(CAST(item_id AS VARCHAR), '') AS item,
               list_filter(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                              '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda w: w <> '') AS words
        FROM benchmark)
  WHERE len(words) > 0),
windows AS (
  SELECT iid, item, size, at0, array_to_string(list_slice(words, at0 + 1, at0 + size), ' ') AS gram
  FROM (SELECT *, unnest(range(0, len(words) - size + 1)) AS at0 FROM items)),
starts AS (
  SELECT rid, size, start0, array_to_string(list_slice(words, start0 + 1, start0 + size), ' ') AS gram
  FROM (SELECT rid, words, size, unnest(range(0, len(words) - size + 1)) AS start0
        FROM docs CROSS JOIN (SELECT DISTINCT size FROM windows) WHERE len(words) >= size)),
matches AS (SELECT rid, iid, item, size, at0, start0 FROM starts JOIN windows USING (size, gram)),
hits AS (SELECT rid, count(DISTINCT w) AS n_hit FROM (SELECT rid, unnest(range(start0, start0 + size)) AS w FROM matches) GROUP BY rid),
named AS (SELECT rid, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items FROM (SELECT DISTINCT rid, item FROM matches) GROUP BY rid),
runs AS (
  SELECT rid, min(start0) AS start0, max(start0 + size) - min(start0) AS words
  FROM (SELECT *, start0 - row_number() OVER (PARTITION BY rid, iid, start0 - at0 ORDER BY start0) AS run FROM matches)
  GROUP BY rid, iid, start0 - at0, run),
longest AS (SELECT rid, words, start0 FROM runs QUALIFY row_number() OVER (PARTITION BY rid ORDER BY words DESC, start0) = 1)
SELECT doc_id, CAST(len(d.words) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
       sha256(coalesce(items, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(d.words) AS contaminated,
       l.words AS longest_words, l.start0 AS longest_start
FROM docs d LEFT JOIN hits USING (rid) LEFT JOIN named USING (rid) LEFT JOIN longest l USING (rid)
"""
