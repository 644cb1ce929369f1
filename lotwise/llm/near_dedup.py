"""MinHash near-dedup with bottom-k sketches of one hash function.

A document's set is its distinct five-word shingles, as 64-bit hashes. Documents
with equal sets form a class, and only the class takes part in the search. The
smallest ``SKETCH`` hashes of a set are its sketch, and the smallest 24 are entered
in inverted lists. Of the 24 smallest hashes of a union of two sets that are 0.75
alike, at least ``shared_at_least(24)`` belong to both, but for one pair in ten
million. So

- lists of up to ``HOT`` classes give overlaps: pairs with the number of lists
  they share. Pairs with too few are dropped;
- longer lists belong to passages that many documents share, or to large groups
  of copies. Alike classes that share no shorter list share so many hot values, so
  only classes with that many remain. They are compared with two hubs of each list,
  which joins large groups of copies, and go on with larger sketches, among
  themselves: a passage that is a part of them is a smaller part of what must be
  shared, and values of their own tell them apart;
- what has too many hot values there too is compared in full, in blocks: classes
  outside the largest component of a list against all classes of the list.

Candidates are filtered by the similarity that the sketch of their union
estimates, and confirmed on the full sets. Links are joined to components in Spark.
"""

from __future__ import annotations

import math
from collections import OrderedDict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import DataFrame, functions as F

from lotwise.llm.common import map_arrow, merge_join, quoted, stored, whole_row
from lotwise.llm.components import components

SHINGLE = 5
PERCENT = 75
SKETCH = 48
LISTED = (24, 96)  # smallest hashes in inverted lists; the larger number for classes that hot lists leave apart
WIDEST = 1024  # hashes of a sketch for what is apart after that; most sets have fewer
KEYS = 12  # two alike sets share one of so many smallest hashes of their union, but for one pair in ten million
BLOCK = 512
MISSED = 1e-7
HOT = 32
_VOCABULARY = 300_000  # word hashes a task remembers


class _WordHashes(dict):
    def __missing__(self, word: bytes) -> int:
        if len(self) >= _VOCABULARY:
            self.clear()
        value = self[word] = xxhash.xxh3_64_intdigest(word)
        return value


_FACTORS = np.array([pow(0x9E3779B97F4A7C15, k, 1 << 64) for k in range(1, SHINGLE + 1)], np.uint64)


def _mixed(x: np.ndarray) -> np.ndarray:
    """Spread sums of word hashes over all 64 bits (the finalizer of SplitMix64)."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def shingles(text: bytes | None, hashes: _WordHashes) -> np.ndarray:
    """Sorted distinct shingle hashes; a shorter text is one shingle, a text without words none."""
    words = text.lower().split() if text else []  # of bytes: A-Z only, and ASCII white space
    if not words:
        return np.zeros(0, np.int64)
    own = np.array(list(map(hashes.__getitem__, words)), np.uint64)
    size = min(SHINGLE, len(own))
    total = np.full(len(own) - size + 1, size, np.uint64)
    for k in range(size):
        total += own[k:len(own) - size + 1 + k] * _FACTORS[k]
    return np.unique(_mixed(total).view(np.int64))


_SKETCHES = "doc_id bigint, text_hash bigint, n int, digest binary, sketch array<bigint>"


def _sketch_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    hashes = _WordHashes()
    for batch in batches:
        sizes, digests, sketches = [], [], []
        for text in batch.column("text").cast(pa.binary()).to_pylist():
            own = shingles(text, hashes)
            sizes.append(len(own))
            digests.append(xxhash.xxh3_128_digest(own.tobytes()))
            sketches.append(own[:SKETCH])
        yield pa.RecordBatch.from_arrays(
            [batch.column("doc_id"), batch.column("text_hash"), pa.array(sizes, pa.int32()), pa.array(digests, pa.binary()),
             pa.array(sketches, pa.list_(pa.int64()))], ["doc_id", "text_hash", "n", "digest", "sketch"])


def _resketch(size: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes, unpacker = _WordHashes(), zstandard.ZstdDecompressor()
        for batch in batches:
            sets = [shingles(unpacker.decompress(p), hashes) for p in batch.column("packed").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column("rep"), pa.array([len(x) for x in sets], pa.int32()),
                 pa.array([x[:size] for x in sets], pa.list_(pa.int64())),
                 pa.array([x[:size].tobytes() for x in sets], pa.binary())], ["rep", "n", "sketch", "packed_sketch"])

    return run


def _presence(held: list[dict], values: np.ndarray) -> np.ndarray:
    """For each class of a block which of the sorted ``values`` it has."""
    found = np.zeros((len(held), len(values)), np.float32)
    for row, h in zip(found, held, strict=True):
        own = np.frombuffer(h["values"], np.int64)
        place = np.searchsorted(values, own)
        place[place == len(values)] = 0
        row[place[values[place] == own]] = 1
    return found


def compare_blocks(outside: list[dict], members: list[dict], percent: int, widest: int) -> Iterator[tuple[int, int, bool]]:
    """Alike pairs in different components, as few as join the components that are found to be linked.

    Sets that fit the widest sketch are compared in full; larger ones that may be
    alike are reported as unsure.
    """
    one, two = (np.unique(np.concatenate([np.frombuffer(h["values"], np.int64) for h in side])) for side in (outside, members))
    values = np.intersect1d(one, two, assume_unique=True)
    both = np.zeros((len(outside), len(members)), np.float32)
    for at in range(0, len(values), 8192):  # a bounded part of the values at a time
        part = values[at:at + 8192]
        both += _presence(outside, part) @ _presence(members, part).T
    n_a, n_b = (np.array([h["n"] for h in side], float) for side in (outside, members))
    label_a, label_b = (np.array([h["label"] for h in side], np.int64) for side in (outside, members))
    apart = label_a[:, None] != label_b[None, :]
    whole = np.maximum(n_a[:, None], n_b[None, :]) <= widest
    alike = apart & whole & (100 * both >= percent * (n_a[:, None] + n_b[None, :] - both))
    root: dict[int, int] = {}

    def find(x: int) -> int:
        while root.get(x, x) != x:
            x = root[x]
        return x

    for i, j in np.argwhere(alike):
        x, y = find(int(label_a[i])), find(int(label_b[j]))
        if x != y:
            root[x] = y
            yield outside[i]["rep"], members[j]["rep"], True
    share = percent / 100
    fits = np.minimum(n_a[:, None], n_b[None, :]) * 100 >= np.maximum(n_a[:, None], n_b[None, :]) * percent
    maybe = apart & ~whole & fits & (both >= widest * (share - 5 * math.sqrt(share * (1 - share) / widest)))
    for i, j in np.argwhere(maybe):
        a, b = sorted((outside[i]["rep"], members[j]["rep"]))
        yield a, b, False


def _compare_blocks(percent: int, widest: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                held = (batch.column(c)[i].as_py() for c in ("held_a", "held_b"))
                found = list(compare_blocks(*held, percent, widest))
                yield pa.RecordBatch.from_arrays(
                    [pa.array([f[k] for f in found], t) for k, t in enumerate((pa.int64(), pa.int64(), pa.bool_()))], ["a", "b", "sure"])

    return run


def _compressed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Texts for later comparison; of rows that share a doc_id, only those of the wanted class."""
    packer, hashes = zstandard.ZstdCompressor(level=1), _WordHashes()
    for batch in batches:
        reps, packed = [], []
        columns = batch.column("rep"), batch.column("of_digest"), batch.column("text").cast(pa.binary())
        for rep, digest, text in zip(*(c.to_pylist() for c in columns), strict=True):
            if xxhash.xxh3_128_digest(shingles(text, hashes).tobytes()) == digest:
                reps.append(rep)
                packed.append(packer.compress(text))
        yield pa.RecordBatch.from_arrays([pa.array(reps, pa.int64()), pa.array(packed, pa.binary())], ["rep", "packed"])


def _confirm(percent: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes, unpacker = _WordHashes(), zstandard.ZstdDecompressor()
        recent: OrderedDict[int, np.ndarray] = OrderedDict()

        def set_of(rep: int, packed: bytes) -> np.ndarray:
            if rep in recent:
                recent.move_to_end(rep)
                return recent[rep]
            own = recent[rep] = shingles(unpacker.decompress(packed), hashes)
            if len(recent) > 32:
                recent.popitem(last=False)
            return own

        for batch in batches:
            alike = []
            for a, b, text_a, text_b in zip(*(batch.column(c).to_pylist() for c in ("a", "b", "text_a", "text_b")), strict=True):
                one, two = set_of(a, text_a), set_of(b, text_b)
                both = len(np.intersect1d(one, two, assume_unique=True))
                alike.append(100 * both >= percent * (len(one) + len(two) - both))
            yield pa.RecordBatch.from_arrays([batch.column("a"), batch.column("b")], ["a", "b"]).filter(pa.array(alike, pa.bool_()))

    return run


def shared_at_least(listed: int, percent: int) -> int:
    """So many of the ``listed`` smallest values of a union belong to both sets, but for one pair in ten million."""
    p, below = percent / 100, 0.0
    for s in range(listed + 1):
        below += math.comb(listed, s) * p**s * (1 - p) ** (listed - s)
        if below > MISSED:
            return max(s, 1)
    return listed


def shared_by_size(widest: int, percent: int) -> list[int]:
    """The same for every number of smallest values up to ``widest``, from 0."""
    p, exactly, found = percent / 100, np.zeros(widest + 2), [0]
    exactly[0] = 1
    for _ in range(widest):
        exactly[1:] = exactly[1:] * (1 - p) + exactly[:-1] * p
        exactly[0] *= 1 - p
        found.append(int(np.argmax(np.cumsum(exactly) > MISSED)))
    return found


class _Level:
    """Inverted lists over the ``listed`` smallest values of some classes (rep, n, sketch of up to ``widest``)."""

    def __init__(self, classes: DataFrame, listed: int, percent: int, widest: int):
        self.classes, self.percent, self.widest = classes, percent, widest
        self.enough = shared_at_least(listed, percent)
        values = classes.select("rep", "n", F.posexplode(F.slice("sketch", 1, listed)).alias("place", "value"))
        shared = stored(values.groupBy("value").agg(F.count("*").alias("df")).where("df > 1"), "shared-values")
        lists = merge_join(values, shared, "value")
        # how many hot values a class has, and how widely shared they are
        weight = lists.where(F.col("df") > HOT).groupBy(F.col("rep").alias("of")).agg(
            F.count("*").alias("hot"), F.sum("df").alias("weight"))
        self.lists = stored(
            merge_join(lists, weight, F.col("rep") == F.col("of"), "left")
            .select("value", "place", "rep", "n", "df", F.coalesce("hot", F.lit(0)).alias("hot"), "weight"), "lists")
        self.few = self.lists.where(F.col("df") <= HOT)
        # alike classes that share no shorter list; they share a value among their first ones too
        many = self.lists.where((F.col("df") > HOT) & (F.col("hot") >= self._needed(F.col("n"))))
        self.many = many.where(F.col("place") < KEYS)
        self.left = many.select("rep").distinct()

    def _needed(self, n):
        """Listed values that two alike sets share at least; ``n`` is the size of the larger."""
        return F.least(F.lit(self.enough), F.ceil(n * self.percent / 100))

    def _sizes_fit(self):
        return F.least("n_a", "n_b") * 100 >= F.greatest("n_a", "n_b") * self.percent

    def sides(self, one: DataFrame, two: DataFrame, *more: str) -> DataFrame:
        one = one.select("value", *[F.col(c).alias(f"{c}_a") for c in ("rep", "n", "hot", *more)])
        two = two.select("value", *[F.col(c).alias(f"{c}_b") for c in ("rep", "n", "hot", *more)])
        return merge_join(one, two, "value").where(self._sizes_fit())

    def overlaps(self) -> DataFrame:
        """Pairs of classes that share enough of the shorter lists."""
        shared = self.sides(self.few, self.few).where("rep_a < rep_b").groupBy("rep_a", "rep_b").agg(
            F.count("*").alias("shared"), F.first("n_a").alias("n_a"), F.first("n_b").alias("n_b"),
            F.least(F.first("hot_a"), F.first("hot_b")).alias("hot"))
        return shared.where(F.col("shared") + F.col("hot") >= self._needed(F.greatest("n_a", "n_b"))).select("rep_a", "rep_b")

    def hub_pairs(self) -> DataFrame:
        """Members of the longer lists with two hubs of each: the class with the widest shared values, and the smallest set."""
        keys = self.many.groupBy("value").agg(F.max(_ranked("weight", "rep")).alias("wide"), F.min(_ranked("n", "rep")).alias("small"))
        hubs = keys.select("value", F.explode(F.array_distinct(F.array(_unranked("wide"), _unranked("small")))).alias("hub"))
        # a table of its own: the join reads two plain exchanges then, which adaptive execution can split at a hot value
        hubs = stored(hubs, "hubs")
        return merge_join(self.many.select("value", F.col("rep").alias("rep_a")), hubs, "value").select("rep_a", F.col("hub").alias("rep_b"))

    def likely(self, pairs: DataFrame) -> DataFrame:
        """Pairs whose union's sketch says that they may be alike."""
        both = pairs.select(F.least("rep_a", "rep_b").alias("a"), F.greatest("rep_a", "rep_b").alias("b")).where("a <> b").distinct()
        one = self.classes.select(F.col("rep").alias("of_a"), F.col("n").alias("n_a"), F.col("sketch").alias("sketch_a"))
        two = self.classes.select(F.col("rep").alias("of_b"), F.col("n").alias("n_b"), F.col("sketch").alias("sketch_b"))
        both = merge_join(merge_join(both, one, F.col("a") == F.col("of_a")), two, F.col("b") == F.col("of_b")).where(self._sizes_fit())
        union = F.sort_array(F.array_union("sketch_a", "sketch_b"))
        union = F.slice(union, 1, F.least(F.size(union), F.greatest(F.size("sketch_a"), F.size("sketch_b"))))
        common = F.array_intersect(F.array_intersect("sketch_a", "sketch_b"), union)
        enough = F.array(*map(F.lit, shared_by_size(self.widest, self.percent)))
        return both.where(F.size(common) >= F.get(enough, F.size(union))).select("a", "b")


_SPREAD = "10000000000000000000"


def _ranked(rank: str, rep: str):
    """A rank and an id as one number, which aggregates without sorting."""
    return F.expr(f"cast({rank} AS decimal(38, 0)) * {_SPREAD} + {rep}")


def _unranked(key: str):
    return F.expr(f"cast({key} - floor(({key} + {_SPREAD} / 2) / {_SPREAD}) * {_SPREAD} AS bigint)")


class _Search:
    """The tables of one search, all in the shared folder.

    A class, the documents with one set of shingles, is known by its number ``rep``; ``least`` is its smallest doc_id, which
    another class has too if rows of one doc_id differ.
    """

    def __init__(self, docs: DataFrame, percent: int):
        self.docs, self.percent = docs, percent
        self.sketches = stored(map_arrow(docs, _sketch_rows, _SKETCHES), "sketches")
        self.classes = stored(
            self.sketches.where("n > 0").groupBy("digest")
            .agg(F.min("doc_id").alias("least"), F.first("n").alias("n"), F.first("sketch").alias("sketch"))
            .where("least is not null").withColumn("rep", F.monotonically_increasing_id()), "classes")

    def fetch_texts(self, reps: DataFrame) -> None:
        """Keep the texts of all classes that any later comparison may need."""
        wanted = merge_join(self.classes, reps.distinct(), "rep").select("rep", "least", F.col("digest").alias("of_digest"))
        found = merge_join(self.docs, wanted, F.col("doc_id") == F.col("least"))
        found = map_arrow(found.select("rep", "of_digest", "text"), _compressed, "rep bigint, packed binary")
        self.texts = stored(found.dropDuplicates(["rep"]), "texts")

    def resketched(self, reps: DataFrame, size: int) -> DataFrame:
        """Larger sketches of some classes."""
        found = merge_join(self.texts, reps, F.col("rep") == F.col("of")).select("rep", "packed")
        return stored(map_arrow(found, _resketch(size), "rep bigint, n int, sketch array<bigint>, packed_sketch binary"), "sketches")

    def confirmed(self, candidates: DataFrame) -> DataFrame:
        one = self.texts.select(F.col("rep").alias("of_a"), F.col("packed").alias("text_a"))
        two = self.texts.select(F.col("rep").alias("of_b"), F.col("packed").alias("text_b"))
        both = merge_join(merge_join(candidates, one, F.col("a") == F.col("of_a")), two, F.col("b") == F.col("of_b"))
        return stored(map_arrow(both.select("a", "b", "text_a", "text_b"), _confirm(self.percent), "a bigint, b bigint"), "links")

    def labels(self) -> DataFrame:
        """Component of every class that has a link."""
        first = _Level(self.classes, LISTED[0], self.percent, SKETCH)
        candidates = stored(first.likely(first.overlaps().unionByName(first.hub_pairs())), "candidates")
        left = stored(first.left.select(F.col("rep").alias("of")), "left")
        self.fetch_texts(candidates.select(F.explode(F.array("a", "b")).alias("rep")).unionByName(left.select(F.col("of").alias("rep"))))
        if left.isEmpty():
            return components(self.confirmed(candidates))
        # classes that may be alike through hot values only: more values tell them apart
        classes = self.resketched(left, WIDEST)
        second = _Level(classes, LISTED[1], self.percent, WIDEST)
        links = self.confirmed(candidates.unionByName(second.likely(second.overlaps())).distinct())
        labels = components(links)
        left = merge_join(second.left.select(F.col("rep").alias("of")), labels, F.col("of") == F.col("node"), "left")
        left = merge_join(classes, left.select("of", F.coalesce("label", "of").alias("label")), F.col("rep") == F.col("of"))
        more = self.in_blocks(stored(left.select("rep", "n", "label", "sketch", "packed_sketch"), "left"))
        return labels if more.isEmpty() else components(stored(links.unionByName(more), "links"))

    def in_blocks(self, classes: DataFrame) -> DataFrame:
        """Links between components: what is not in the largest component of a list, against all of the list.

        Classes that share one of their ``KEYS`` smallest values meet in blocks of
        about ``BLOCK`` classes a side, so a task holds two blocks, whatever the
        length of the list, and a pair is never a row unless it is linked.
        """
        keyed = classes.select(F.explode(F.slice("sketch", 1, KEYS)).alias("value"), "rep", "label")
        sizes = keyed.groupBy("value", "label").agg(F.count("*").alias("size"))
        lists = sizes.groupBy(F.col("value").alias("in")).agg(
            F.sum("size").alias("all"), F.max("size").alias("largest"), F.max(_ranked("size", "label")).alias("key"))
        lists = stored(lists.where("`all` > largest").select("in", "all", "largest", _unranked("key").alias("main")), "apart")
        keyed = merge_join(keyed, lists, F.col("value") == F.col("in"))

        def block(size: str):
            return F.pmod(F.xxhash64("rep"), F.ceil(F.expr(size) / BLOCK))

        sides = keyed.select("value", F.col("rep").alias("of"), block("`all`").alias("block"), F.lit(False).alias("outside")).unionByName(
            keyed.where("label <> main").select("value", F.col("rep").alias("of"), block("`all` - largest").alias("block"), F.lit(True).alias("outside")))
        filled = merge_join(sides, classes, F.col("rep") == F.col("of")).groupBy("value", "block", "outside").agg(
            F.collect_list(F.struct("rep", "n", "label", F.col("packed_sketch").alias("values"))).alias("held"))
        filled = stored(filled, "blocks")
        one = filled.where("outside").select("value", F.col("held").alias("held_a"))
        two = filled.where("NOT outside").select("value", F.col("held").alias("held_b"))
        # rows of a megabyte or two: a batch takes few of them
        found = merge_join(one, two, "value").select("held_a", "held_b")
        found = stored(map_arrow(found, _compare_blocks(self.percent, WIDEST), "a bigint, b bigint, sure boolean").distinct(), "found")
        unsure = found.where("NOT sure").select("a", "b")
        sure = found.where("sure").select("a", "b")
        return sure if unsure.isEmpty() else stored(sure.unionByName(self.confirmed(unsure)), "links")


def grouped(docs: DataFrame, percent: int = PERCENT, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """For every row ``doc_id``, ``text_hash``, ``n`` (its set's size), ``group`` (a number for its component) and ``component_id``.

    ``group`` and ``component_id`` are null without words or doc_id.
    """
    text = F.col(quoted(text_col))
    rows = docs.select(F.col(quoted(id_col)).cast("long").alias("doc_id"), text.alias("text"), F.xxhash64(text).alias("text_hash"))
    search = _Search(rows, percent)
    labels = search.labels()
    classes = merge_join(search.classes.select("digest", "rep", "least"), labels, F.col("rep") == F.col("node"), "left")
    classes = stored(classes.select(F.col("digest").alias("of_digest"), F.coalesce("label", "rep").alias("group"), "least"), "class-labels")
    smallest = classes.groupBy(F.col("group").alias("of")).agg(F.min("least").alias("component_id"))
    classes = merge_join(classes, smallest, F.col("group") == F.col("of")).select("of_digest", "group", "component_id")
    found = merge_join(search.sketches.select("doc_id", "text_hash", "n", "digest"), classes, F.col("digest") == F.col("of_digest"), "left")
    known = F.col("doc_id").isNotNull() & (F.col("n") > 0)
    return found.select("doc_id", "text_hash", "n", *[F.when(known, F.col(c)).alias(c) for c in ("group", "component_id")])


def near_duplicates(docs: DataFrame, percent: int = PERCENT, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id``, ``n_shingles``, ``component_id`` and ``kept`` for every row of ``docs``.

    Words are runs without ASCII white space after A-Z have been lowered. Two
    rows are linked if 100 * intersection >= ``percent`` * union of their sets;
    ``component_id`` is the smallest doc_id that links reach. Null and empty texts
    have an empty set and are linked with nothing. Rows that repeat a doc_id each get
    the answer of their own text. A null doc_id is linked with nothing, has no
    component and is kept. Other columns are not read.
    """
    found = grouped(docs, percent, id_col, text_col)
    return found.select(
        "doc_id", F.col("n").cast("long").alias("n_shingles"), F.coalesce("component_id", "doc_id").alias("component_id"),
    ).withColumn("kept", F.col("doc_id").eqNullSafe(F.col("component_id")))


def one_of_each(docs: DataFrame, percent: int = PERCENT, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` with one row of each group of near copies, one with the smallest doc_id.

    Of rows that repeat this doc_id in a group, one text stays, and one row of it. Rows
    without words or doc_id are in no group and all stay. Columns of any name are kept.
    """
    found = grouped(docs, percent, id_col, text_col).where("group IS NOT NULL AND doc_id = component_id")
    found = stored(found.groupBy("group", F.col("doc_id").alias("of")).agg(F.min("text_hash").alias("of_hash")), "kept")
    text = F.col(quoted(text_col))
    rows = docs.select(whole_row(docs).alias("row"), F.col(quoted(id_col)).cast("long").alias("doc_id"), F.xxhash64(text).alias("text_hash"),
                       F.coalesce(text.rlike(r"[^\x20\x09-\x0D]"), F.lit(False)).alias("has_words"))
    apart = F.col("doc_id").isNull() | ~F.col("has_words")
    same = (F.col("doc_id") == F.col("of")) & (F.col("text_hash") == F.col("of_hash"))
    kept = merge_join(rows.where(~apart), found, same).dropDuplicates(["doc_id", "text_hash"])
    kept = kept.select("row").unionByName(rows.where(apart).select("row"))
    return kept.select(*[F.col(f"row.{quoted(c)}").alias(c) for c in docs.columns])
