"""Documents whose sets of word shingles overlap: a size-aware heavy-light similarity join."""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass
from functools import cache, cached_property

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from trawl.llm.common import (
    free_names,
    remove_folder,
    require,
    shared_folder,
    stored,
    table,
    with_columns,
)
from trawl.llm.components import components
from trawl.llm.hashing import find_words, mix, runs, text_slices, word_hashes
from trawl.session import BROADCAST_ROWS

# Elements of the sets that one task compares with each other.
BLOCK_ELEMENTS = 400_000
# A set counts as at least so many elements, which bounds the number of sets in a block.
LEAST_WEIGHT = 400
# Bytes of the sketches that one task compares with each other, and the least that a set counts as.
BLOCK_SKETCHES = 4_000_000
LEAST_SKETCH = 256
_FEW = 24
# Ties that a task keeps at hand to leave out those that it has seen.
KEPT_TIES = 1_000_000

_SKETCH = T.StructType(
    [
        T.StructField("n", T.LongType()),
        T.StructField("high", T.LongType()),
        T.StructField("low", T.LongType()),
        T.StructField("subsets", T.ArrayType(T.LongType())),
        T.StructField("parts", T.ArrayType(T.LongType())),
        T.StructField("size_range", T.IntegerType()),
        T.StructField("odd", T.BinaryType()),
    ]
)


@dataclass(frozen=True)
class Rule:
    """Which documents link: runs of ``words`` words, Jaccard similarity of ``percent`` or more."""

    words: int = 3
    percent: int = 90

    def __post_init__(self) -> None:
        if self.words < 1 or not 50 <= self.percent <= 99:
            raise ValueError("a shingle has a word or more, a similarity is of 50 to 99 percent")

    @property
    def largest_boundary(self) -> int:
        """Sets of fewer elements can be linked by subsets that lack at most one element."""
        return -(-200 // (100 - self.percent))

    @cached_property
    def ranges(self) -> np.ndarray:
        """Starts of size ranges: two sets are similar only if in the same or in next ranges."""
        starts = [1]
        while starts[-1] <= 2**40:
            starts.append(100 * starts[-1] // self.percent + 1)
        return np.array(starts, dtype=np.int64)

    @cache
    def parts(self, group: int) -> tuple[int, int]:
        """How many parts sets of a size range have, and how many of these may be passed over.

        Sets of n and m elements that are similar differ in at most (n + m)(1 - s) / (1 + s) of
        them. The parts passed over come on top of that, about as many as stay empty by chance.
        """
        least, most = int(self.ranges[group]), int(self.ranges[group + 1]) - 1
        differ = 2 * most * (100 - self.percent) // (100 + self.percent)
        spare, more = 0, 1
        while spare < more <= differ + 1:
            spare = more if differ else 0
            parts = differ + 1 + spare
            empty = parts * (1 - 1 / parts) ** least
            more = math.ceil(empty + 4 * math.sqrt(empty))
        return differ + 1 + spare, spare

    @property
    def folds(self) -> int:
        """How often a sketch can be folded so that unlike sets still show: a power of two.

        Sets of n elements with nothing in common differ in about half of the buckets they fill,
        however few these are; similar ones differ in less than that part of n.
        """
        differ = 2 * (100 - self.percent) / (100 + self.percent)
        return 1 << max(0, math.floor(math.log2(1 / differ)))

    def range_of(self, n: int) -> int:
        """The size range of sets of n elements."""
        return int(np.searchsorted(self.ranges, n, "right")) - 1

    def similar(self, common, n, m):
        return 100 * common >= self.percent * (n + m - common)


RULE = Rule()


def shingle_sets(texts: pa.Array, size: int = RULE.words) -> Iterator[np.ndarray]:
    """The distinct shingles of every text as sorted hashes; a shorter text is one shingle."""
    for begin, end in text_slices(texts):
        words = find_words(texts[begin:end], lower=True)
        hashes = word_hashes(words)
        found = runs(hashes, size)
        for first, last in zip(words.first[:-1].tolist(), words.first[1:].tolist()):
            if last - first >= size:
                yield np.unique(found[first : last - size + 1])
            else:  # no run, or a single one of all words
                yield runs(hashes[first:last], max(1, last - first))


def subset_keys(elements: np.ndarray) -> np.ndarray:
    """Keys of a set and of all its subsets that lack one element."""
    mixed = mix(elements)
    total = mixed.sum(dtype=np.uint64)
    return mix(np.append(total - mixed, total) ^ np.uint64(0x5EED))


def part_keys(elements: np.ndarray, rule: Rule = RULE) -> np.ndarray:
    """Keys of the parts of a set, from which inverted lists are made.

    With more parts than two similar sets can differ in, dealt by hash, they agree in all elements
    of some parts: in one more than may be passed over. So a set with no more empty parts than that
    passes over them, as it agrees with a similar one in another part, too; only sets with more of
    them list them. Else all sets in which the same part is empty would stand on one list.

    The number of parts belongs to a range of sizes; a set is listed for its own range and for the
    next one, where larger partners are.
    """
    group = rule.range_of(len(elements))
    mixed = mix(elements)
    halves = mixed & np.uint64(2**32 - 1), mixed >> np.uint64(32)
    keys = []
    for instance in (group, group + 1):
        parts, spare = rule.parts(instance)
        part = ((mixed >> np.uint64(20)) % np.uint64(parts)).astype(np.int64)
        count = np.bincount(part, minlength=parts)
        # Sums of halves are exact as floats.
        low, high = (np.bincount(part, half, parts).astype(np.uint64) for half in halves)
        content = low + (high << np.uint64(32))
        place = np.arange(parts, dtype=np.uint64) + np.uint64(instance << 40)
        found = mix(mix(content) + mix(place + np.uint64(1)))
        filled = count > 0
        keys.append(found[filled] if parts - filled.sum() <= spare else found)
    return np.concatenate(keys)


def odd_sketch(elements: np.ndarray) -> np.ndarray:
    """For each bucket a bit, whether an odd number of elements falls into it; as words of 64 bits.

    An element that only one of two sets has changes one bit, so sketches differ in no more bits
    than the sets differ in elements. There are two buckets an element or more, a power of two;
    folding a sketch, half upon half, gives that of half the buckets.
    """
    bits = max(64, 1 << (2 * len(elements) - 1).bit_length())
    bucket = mix(elements ^ np.uint64(0x0DD)) & np.uint64(bits - 1)
    odd = np.bincount(bucket.astype(np.int64), minlength=bits) & 1
    return np.packbits(odd.astype(np.uint8), bitorder="little").view("<u8")


def _folded(sketches: np.ndarray, width: int) -> np.ndarray:
    while sketches.shape[1] > width:
        half = sketches.shape[1] // 2
        sketches = sketches[:, :half] ^ sketches[:, half:]
    return sketches


def possible_pairs(
    sizes: np.ndarray, sketches: list[bytes], own: np.ndarray, rule: Rule = RULE
) -> Iterator[tuple[int, int]]:
    """Pairs that connect all sets whose sketches let them be similar; one of a pair is an own one.

    Sketches of equal width stand together once ordered by size. A set meets those of its size and
    above, up to the largest that it can be similar to, as far as nothing connects them yet. They
    meet folded to a few words first, which parts most of those that have little in common.
    """
    order = np.argsort(sizes, kind="stable")
    n, own = sizes[order], own[order]
    words = [np.frombuffer(sketches[k], "<u8") for k in order.tolist()]
    widths = np.array([len(w) for w in words])
    starts = np.flatnonzero(np.append(True, widths[1:] != widths[:-1]))
    ends = np.append(starts[1:], len(words))
    stacks = [np.stack(words[a:b]) for a, b in zip(starts.tolist(), ends.tolist())]
    folded = [{s.shape[1]: s} for s in stacks]
    last = np.searchsorted(n, 100 * n // rule.percent, "right")
    label = np.arange(len(n))
    columns: dict[int, dict[int, np.ndarray]] = {a: {} for a in starts.tolist()}

    def near(others: np.ndarray, row: np.ndarray, width: int, i: int, at) -> np.ndarray:
        differ = np.bitwise_count(others ^ _folded(row[None, :], width).T)
        common = n[i] + n[at] - differ.sum(axis=0, dtype=np.uint32).astype(np.int64)
        return rule.similar(common, 2 * n[i], 2 * n[at])

    for i, row in enumerate(words):
        for a, b, stack in zip(starts.tolist(), ends.tolist(), folded):
            low, high = max(a, i + 1), min(b, int(last[i]))
            if low >= high:
                continue
            meets = label[low:high] != label[i]
            if not own[i]:
                meets &= own[low:high]
            # All in between at first, a column each, as long as sketches are short.
            few = -(-len(row) // rule.folds)
            if few not in columns[a]:
                columns[a][few] = np.ascontiguousarray(_folded(stack[max(stack)], few).T)
            meets &= near(columns[a][few][:, low - a : high - a], row, few, i, slice(low, high))
            at = low + np.flatnonzero(meets)
            if not len(at):
                continue
            if len(row) not in stack:
                stack[len(row)] = _folded(stack[max(stack)], len(row))
            at = at[near(stack[len(row)][at - a].T, row, len(row), i, at)]
            for j in at.tolist():
                if label[j] != label[i]:
                    label[label == label[j]] = label[i]
                    yield int(order[i]), int(order[j])


def _sketch_udf(rule: Rule):
    @F.arrow_udf(_SKETCH)
    def sketch(texts: pa.Array) -> pa.Array:
        rows = []
        for elements in shingle_sets(texts, rule.words):
            n = len(elements)
            mixed = mix(elements)
            high = int(mixed.sum(dtype=np.uint64)) + n & 2**64 - 1
            low = int(mix(mixed ^ np.uint64(77)).sum(dtype=np.uint64))
            rows.append(
                {
                    "n": n,
                    "high": high - 2**63,
                    "low": low - 2**63,
                    "subsets": subset_keys(elements).view(np.int64)
                    if 0 < n < rule.largest_boundary
                    else None,
                    "parts": part_keys(elements, rule).view(np.int64) if n else None,
                    "size_range": rule.range_of(n) if n else None,
                    "odd": odd_sketch(elements).tobytes() if n else None,
                }
            )
        return pa.array(rows, pa.struct([
            ("n", pa.int64()), ("high", pa.int64()), ("low", pa.int64()),
            ("subsets", pa.list_(pa.int64())), ("parts", pa.list_(pa.int64())),
            ("size_range", pa.int32()), ("odd", pa.binary()),
        ]))

    return sketch.asNondeterministic()


def _boundary(sets: DataFrame, rule: Rule) -> int:
    """The size below which enumerating subsets costs less than scanning lists.

    A set of n elements has n + 1 subsets. Its parts make lists, and the cost of a list is its
    length: each of its sets has to be compared with one of the others. The lengths are measured
    over all sets below the largest boundary.
    """
    small = sets.where((F.col("n") > 0) & (F.col("n") < rule.largest_boundary))
    small = small.select("n", "parts")
    rows = small.select("n", F.explode("parts").alias("key"))
    lists = rows.groupBy("key").agg(F.count(F.lit(1)).alias("length"), F.sum("n").alias("sizes"))
    by_size = (
        lists.groupBy(F.round(F.col("sizes") / F.col("length")).cast("int").alias("n"))
        .agg(F.sum(F.col("length") * F.col("length")).alias("cost"))
        .collect()
    )
    scan = {r["n"]: float(r["cost"]) for r in by_size}
    sized = small.groupBy("n").count().collect()
    enumerate_all = {r["n"]: float(r["count"] * (r["n"] + 1)) for r in sized}
    costs = [
        (
            sum(c for n, c in enumerate_all.items() if n < x)
            + sum(c for n, c in scan.items() if n >= x),
            x,
        )
        for x in range(1, rule.largest_boundary + 1)
    ]
    return min(costs)[1]


def _different(pairs: list[np.ndarray]) -> np.ndarray:
    """The different ones of pairs in two rows."""
    both = np.concatenate(pairs, axis=1)
    both = both[:, np.lexsort(both)]
    new = np.ones(both.shape[1], bool)
    new[1:] = (both[:, 1:] != both[:, :-1]).any(axis=0)
    return both[:, new]


def _list_edges(rows: DataFrame) -> DataFrame:
    """Ties that connect all sets that share a list: about one for each set.

    A task reads the lists in order, ties every set to the least one of its list, as far as a batch
    of rows goes, and keeps that one at hand for the next batch, however long a list is. A set stands
    on several lists; it then is tied to the least of these, and they among themselves, where most
    ties are the same for many sets. Only keys are sorted: as single numbers, that takes no comparing.
    """

    def tell(pairs: np.ndarray) -> pa.RecordBatch:
        return pa.record_batch({"a": pa.array(pairs[0]), "b": pa.array(pairs[1])})

    def edges(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last_key = first = None
        kept, n_kept = [], 0
        for batch in batches:
            key = batch.column("key").to_numpy()
            own = batch.column("set").to_numpy()
            if not len(key):
                continue
            begins = np.flatnonzero(np.append(True, key[1:] != key[:-1]))
            least = np.minimum.reduceat(own, begins)
            heads = np.repeat(least, np.diff(np.append(begins, len(key))))
            if last_key is not None and key[0] == last_key:
                heads, own = np.append(heads, least[0]), np.append(own, first)
                least[0] = min(least[0], first)
            last_key, first = key[-1], least[-1]
            different = heads != own
            kept.append(np.sort(np.stack([heads[different], own[different]]), axis=0))
            n_kept += kept[-1].shape[1]
            if n_kept > KEPT_TIES:
                kept = [_different(kept)]
                n_kept = kept[0].shape[1]
                if n_kept > KEPT_TIES // 2:
                    yield tell(kept[0])
                    kept, n_kept = [], 0
        if kept:
            yield tell(_different(kept))

    ordered = rows.repartition("key").sortWithinPartitions("key")
    ties = ordered.mapInArrow(edges, "a bigint, b bigint")
    # A set has no more first sets than keys, so a row is bounded by the length of a text.
    tied = ties.groupBy("b").agg(F.min("a").alias("a"), F.collect_set("a").alias("firsts"))
    least = F.transform("firsts", lambda x: F.struct(F.col("a").alias("a"), x.alias("b")))
    own = F.array(F.struct("a", "b"))
    pairs = tied.select(F.explode(F.concat(own, F.filter(least, lambda e: e.a < e.b))).alias("e"))
    return pairs.select("e.a", "e.b").distinct()


class _Forest:
    def __init__(self, n: int) -> None:
        self._up = list(range(n))

    def top(self, i: int) -> int:
        while self._up[i] != i:
            self._up[i] = self._up[self._up[i]]
            i = self._up[i]
        return i

    def join(self, i: int, j: int) -> bool:
        i, j = self.top(i), self.top(j)
        self._up[max(i, j)] = min(i, j)
        return i != j


def linked_pairs(sets: list[np.ndarray], rule: Rule = RULE) -> Iterator[tuple[int, int]]:
    """Links that connect all similar sets, without those that others imply."""
    forest = _Forest(len(sets))
    sizes = np.array([len(s) for s in sets])
    if len(sets) <= _FEW:
        for i, first in enumerate(sets):
            for j in range(i):
                less, more = sorted((int(sizes[i]), int(sizes[j])))
                if forest.top(i) != forest.top(j) and 100 * less >= rule.percent * more:
                    common = len(np.intersect1d(first, sets[j], assume_unique=True))
                    if rule.similar(common, less, more) and forest.join(i, j):
                        yield i, j
        return
    for i, j in zip(*_similar_in_matrix(sets, sizes, rule)):
        if forest.join(int(i), int(j)):
            yield int(i), int(j)


def _similar_in_matrix(
    sets: list[np.ndarray], sizes: np.ndarray, rule: Rule
) -> tuple[np.ndarray, np.ndarray]:
    """All similar pairs, from products of the sets' incidence matrix, some columns at a time."""
    owner = np.repeat(np.arange(len(sets)), sizes)
    _, code, times = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    shared = times[code] > 1
    owner, code = owner[shared], code[shared]
    _, code = np.unique(code, return_inverse=True)
    order = np.argsort(code, kind="stable")
    owner, code = owner[order], code[order]
    width = max(256, 8_000_000 // max(1, len(sets)))
    common = np.zeros((len(sets), len(sets)), np.float32)
    for start in range(0, int(code[-1]) + 1 if len(code) else 0, width):
        a, b = np.searchsorted(code, (start, start + width))
        incidence = np.zeros((len(sets), width), np.float32)
        incidence[owner[a:b], code[a:b] - start] = 1
        common += incidence @ incidence.T
    i, j = np.nonzero(rule.similar(common, sizes[:, None], sizes[None, :]))
    return i[i < j], j[i < j]


def _possible(candidates: DataFrame, rule: Rule) -> DataFrame:
    """``a, b``: pairs that connect the sets of a cluster whose sketches let them be similar.

    ``candidates``: ``set, cluster, n, size_range, odd``. Small clusters share packs. In a large one
    the sets of a size range meet those of their own and of the next range, block by block.
    """
    weight = F.greatest(F.length("odd"), F.lit(LEAST_SKETCH)).cast("bigint")
    rows = candidates.withColumn("weight", weight)
    totals = rows.groupBy("cluster").agg(F.sum("weight").alias("total"))
    rows = rows.join(totals, "cluster")
    is_small = F.col("total") <= BLOCK_SKETCHES
    summed = totals.agg(
        F.sum(F.when(is_small, F.col("total"))).alias("small"),
        F.count(F.when(~is_small, F.lit(1))).alias("n_large"),
    ).first()
    packs = max(1, math.ceil(2 * (summed["small"] or 0) / BLOCK_SKETCHES))
    columns = ["pack", "cluster", "set", "n", "odd", "own"]
    met = (
        rows.where(is_small)
        .withColumn("pack", F.pmod(F.xxhash64("cluster"), F.lit(packs)))
        .withColumn("own", F.lit(True))
        .select(columns)
    )
    if summed["n_large"]:
        met = met.unionByName(_by_size(rows.where(~is_small)).select(columns))

    def meet(group: pd.DataFrame) -> pd.DataFrame:
        found = []
        ordered = group.sort_values("own", ascending=False)
        for _, cluster in ordered.groupby("cluster", sort=True):
            cluster = cluster.drop_duplicates("set")
            names, own = cluster["set"].to_numpy(), cluster["own"].to_numpy(bool)
            pairs = possible_pairs(cluster["n"].to_numpy(), list(cluster["odd"]), own, rule)
            found += [(names[i], names[j]) for i, j in pairs]
        return pd.DataFrame(found, columns=["a", "b"], dtype="int64")

    return met.groupBy("pack").applyInPandas(meet, "a bigint, b bigint")


def _by_size(rows: DataFrame) -> DataFrame:
    """The packs of large clusters: blocks of a size range's own sets and of all that these meet."""
    own = F.col("size_range") == F.col("at")
    placed = rows.withColumn(
        "at", F.explode(F.array(F.col("size_range"), F.col("size_range") - 1))
    )
    blocks = placed.groupBy("cluster", "at").agg(
        F.ceil(F.sum(F.when(own, F.col("weight"))) / BLOCK_SKETCHES).alias("own_blocks"),
        F.ceil(F.sum("weight") / BLOCK_SKETCHES).alias("blocks"),
    )
    placed = placed.join(blocks.where("own_blocks > 0"), ["cluster", "at"])
    every = lambda n: F.sequence(F.lit(0).cast("bigint"), F.col(n) - 1)
    as_own = (
        placed.where(own)
        .withColumn("own_block", F.pmod(F.xxhash64("set"), F.col("own_blocks")))
        .withColumn("block", F.explode(every("blocks")))
        .withColumn("own", F.lit(True))
    )
    as_met = (
        placed.withColumn("block", F.pmod(F.xxhash64("set", F.lit(1)), F.col("blocks")))
        .withColumn("own_block", F.explode(every("own_blocks")))
        .withColumn("own", F.lit(False))
    )
    pack = _pack(F.col("cluster"), F.col("at"), F.col("own_block"), F.col("block"))
    return as_own.unionByName(as_met).withColumn("pack", pack).withColumn("cluster", pack)


def _verified(packs: DataFrame, rule: Rule) -> DataFrame:
    """``a, b``: links between the sets of each pack that connect its similar sets.

    A pack is one or two blocks of a large cluster, or several small clusters.
    """

    def verify(group: pd.DataFrame) -> pd.DataFrame:
        found = []
        for _, cluster in group.groupby("cluster", sort=True):
            cluster = cluster.drop_duplicates("set").sort_values("set")
            names = cluster["set"].to_numpy()
            sets = [np.asarray(e) for e in cluster["elements"]]
            found += [(names[i], names[j]) for i, j in linked_pairs(sets, rule)]
        return pd.DataFrame(found, columns=["a", "b"], dtype="int64")

    return packs.groupBy("pack").applyInPandas(verify, "a bigint, b bigint")


def _pack(cluster: Column, *more: Column) -> Column:
    return F.xxhash64(cluster, *more)


def _links(members: DataFrame, clusters: DataFrame, rule: Rule) -> DataFrame:
    """Verified links within clusters of candidates.

    ``members``: ``set, cluster, elements``; ``clusters``: ``cluster, total`` elements. Small
    clusters share packs. A cluster of several blocks is first compared with its block 0; what is
    linked to its largest component by then needs no more comparing, and only the others meet all
    blocks.
    """
    blocks = F.ceil(F.col("total") / BLOCK_ELEMENTS).cast("int")
    sized = clusters.withColumn("blocks", blocks)
    rows = members.join(sized, "cluster")
    all_elements = clusters.where(F.col("total") <= BLOCK_ELEMENTS).agg(F.sum("total")).first()[0]
    packs = max(1, math.ceil(2 * (all_elements or 0) / BLOCK_ELEMENTS))
    small = rows.where("blocks = 1").withColumn(
        "pack", F.pmod(F.xxhash64("cluster"), F.lit(packs))
    )
    large = rows.where("blocks > 1").withColumn("block", F.pmod(F.xxhash64("set"), F.col("blocks")))
    meets = F.when(F.col("block") > 0, F.array("block")).otherwise(
        F.sequence(F.lit(1).cast("bigint"), F.col("blocks").cast("bigint") - 1)
    )
    first = large.withColumn("other", F.explode(meets)).withColumn(
        "pack", _pack(F.col("cluster"), F.col("other"))
    )
    columns = ["pack", "cluster", "set", "elements"]
    packs = small.select(columns).unionByName(first.select(columns))
    links = stored(_verified(packs, rule))
    if clusters.where(F.col("total") > BLOCK_ELEMENTS).isEmpty():
        return links
    return links.unionByName(_rest_links(large, links, rule))


def _rest_links(large: DataFrame, links: DataFrame, rule: Rule) -> DataFrame:
    """Links of the sets of large clusters that are outside their cluster's largest component."""
    names = components(links).withColumnRenamed("node", "set")
    placed = large.select("set", "cluster").join(names, "set", "left")
    placed = placed.withColumn("component", F.coalesce("component", "set"))
    counted = placed.groupBy("cluster", "component").count()
    largest = counted.groupBy("cluster").agg(F.max_by("component", "count").alias("component"))
    outside = placed.join(largest, ["cluster", "component"], "left_anti").select("set", "cluster")
    totals = outside.groupBy("cluster").agg(F.count(F.lit(1)).alias("n_outside"))
    mean = F.col("total") / F.greatest(F.col("n"), F.lit(1))
    sizes = large.groupBy("cluster").agg(
        F.count(F.lit(1)).alias("n"), F.first("total").alias("total")
    )
    groups = totals.join(sizes, "cluster").select(
        "cluster",
        F.ceil(F.col("n_outside") * mean / BLOCK_ELEMENTS).cast("bigint").alias("groups"),
    )
    rest = large.join(groups, "cluster").join(
        outside.withColumn("is_out", F.lit(True)), ["set", "cluster"], "left"
    )
    own_group = F.pmod(F.xxhash64("set", F.lit(7)), F.col("groups"))
    every_group = F.sequence(F.lit(0).cast("bigint"), F.col("groups") - 1)
    every_block = F.sequence(F.lit(0).cast("bigint"), F.col("blocks").cast("bigint") - 1)
    as_member = rest.withColumn("group", F.explode(every_group)).withColumn("at", F.col("block"))
    as_outside = (
        rest.where("is_out")
        .withColumn("group", own_group)
        .withColumn("at", F.explode(every_block))
    )
    packs = as_member.unionByName(as_outside).withColumn(
        "pack", _pack(F.col("cluster"), F.col("group"), F.col("at"), F.lit(1))
    )
    return stored(_verified(packs.select("pack", "cluster", "set", "elements"), rule))


def ngram_groups(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", rule: Rule = RULE
) -> DataFrame:
    """``docs`` with ``n_shingles``, ``class_id`` and ``component_id`` (replacing such columns).

    A document's set holds its distinct runs of ``rule.words`` words (between ASCII white space,
    A-Z lower-cased); a shorter text is one run, a text without words has an empty set. Documents
    link when the sets' Jaccard similarity is ``rule.percent`` or more, and a component holds what
    links reach. Its id is the least id in it. ``class_id`` names documents with the same set.

    Defined cases: documents with empty sets or null texts are linked with nothing and keep their
    own id; a null id doesn't count as least unless the component has no other; repeated rows and
    repeated ids are documents like others; an empty table gives an empty one.

    Documents are reduced to classes of equal sets. Below a boundary chosen by cost, a class is
    found by the subsets that lack at most one element; above it, by inverted lists over parts of
    the sets, of which similar sets must share one. Every class on a list is tied to the list's
    first; clusters of such ties hold all similar classes. Odd sketches, a few bits an element, part
    what cannot be similar: classes of a cluster are compared by them, large clusters size range by
    size range. The sets of what stays together are then compared in blocks
    of bounded size and only links that join components are kept. Shingles are compared by 64-bit
    hashes, classes by 128 bits.
    """
    grouped = _grouped(docs, id_col, text_col, rule)
    at, found = free_names(docs, "place", "found")
    once = grouped.dropDuplicates(["place"]).select(
        F.col("place").alias(at), F.struct("n", "high", "low", "least").alias(found)
    )
    joined = docs.withColumn(at, _place(id_col, text_col)).join(once, at)
    value = F.col(found)
    new = {
        "n_shingles": value["n"],
        "class_id": F.lower(F.concat(F.hex(value["high"]), F.lit("-"), F.hex(value["low"]))),
        "component_id": F.coalesce(value["least"], F.col(f"`{id_col}`")),
    }
    return with_columns(joined, new).drop(at, found)


def keep_one_of_each(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", rule: Rule = RULE
) -> DataFrame:
    """``docs`` with one document of every component, that of the least id.

    Documents with empty sets all stay. Rows that share both id and text count once; a row with a
    null id stands for its component if that has no other.
    """
    grouped = _grouped(docs, id_col, text_col, rule)
    (at,) = free_names(docs, "place")
    first = F.min(F.struct(F.col("id").isNull(), "id", "place")).getField("place")
    chosen = (
        grouped.groupBy(F.coalesce("component", "place").alias("group"), F.col("n") == 0)
        .agg(first.alias(at))
        .select(at)
        .distinct()
    )
    marked = docs.withColumn(at, _place(id_col, text_col))
    return marked.join(chosen, at).dropDuplicates([at]).drop(at)


def _place(id_col: str, text_col: str) -> Column:
    """A document's place among the sets; rows of equal id and text share one."""
    own_id = F.coalesce(F.col(f"`{id_col}`").cast("string"), F.lit(""))
    return F.xxhash64(own_id, F.col(f"`{text_col}`"))


def _grouped(docs: DataFrame, id_col: str, text_col: str, rule: Rule) -> DataFrame:
    """``place, id, n, high, low, component, least`` of every document, without texts."""
    require(docs, [id_col, text_col])
    text = F.col(f"`{text_col}`")
    place = _place(id_col, text_col)
    spark = docs.sparkSession
    path = shared_folder(spark)
    docs.select(
        F.col(f"`{id_col}`").alias("id"),
        place.alias("place"),
        _sketch_udf(rule)(text).alias("s"),
    ).select("id", "place", "s.*").write.parquet(path)
    sets = spark.read.parquet(path)
    boundary = _boundary(sets, rule)
    light = F.col("n") < boundary
    no_keys = F.array().cast("array<bigint>")
    subsets = F.when(light, F.col("subsets")).otherwise(no_keys)
    near = 100 * F.col("n") >= rule.percent * (boundary - 1)
    parts = F.when(~light | near, F.col("parts")).otherwise(no_keys)
    listed = sets.where("n > 0").select(
        F.col("high").alias("set"), F.explode(F.concat(subsets, parts)).alias("key")
    )
    ties = stored(_list_edges(listed))
    clustered = components(ties).select(
        F.col("node").alias("high"), F.col("component").alias("cluster")
    )
    candidates = stored(
        sets.groupBy("high", "low")
        .agg(
            F.min("place").alias("place"),
            *[F.first(c).alias(c) for c in ("n", "size_range", "odd")],
        )
        .join(clustered, "high")
        .withColumn("set", F.xxhash64("high", "low"))
    )
    # The keys take most of the room and are of no more use.
    sets = stored(sets.select("id", "place", "n", "high", "low"))
    remove_folder(spark, path)
    near = components(_possible(candidates, rule)).select(
        F.col("node").alias("set"), F.col("component").alias("cluster")
    )
    chosen = stored(candidates.drop("cluster", "size_range", "odd").join(near, "set"))
    clusters = chosen.groupBy("cluster").agg(
        F.sum(F.greatest("n", F.lit(LEAST_WEIGHT))).alias("total")
    )
    members = _member_sets(docs, place, text, chosen, rule)
    named = F.xxhash64("high", "low").alias("node")
    links = _links(members, clusters, rule)
    reached = components(links)
    with_node = sets.select("id", "place", "n", named, "high", "low").join(
        reached, "node", "left"
    )
    component = F.when(F.col("n") > 0, F.coalesce("component", "node"))
    named = with_node.withColumn("component", component)
    least = (
        named.where("n > 0").groupBy("component").agg(F.min("id").alias("least"))
    )
    return named.join(least, "component", "left").select(
        "place", "id", "n", "high", "low", "component", "least"
    )


def _member_sets(
    docs: DataFrame, place: Column, text: Column, chosen: DataFrame, rule: Rule
) -> DataFrame:
    """``set, cluster, elements`` of one document of every class in a cluster."""
    picked = chosen.select(F.col("place").alias("_place"), "cluster", "set")
    if picked.count() <= BROADCAST_ROWS:
        picked = F.broadcast(picked)
    rows = docs.select(place.alias("_place"), text.alias("text")).join(picked, "_place")

    @F.arrow_udf(T.ArrayType(T.LongType()))
    def elements(texts: pa.Array) -> pa.Array:
        found = [elements.view(np.int64) for elements in shingle_sets(texts, rule.words)]
        return pa.array(found, pa.list_(pa.int64()))

    return rows.select("set", "cluster", elements.asNondeterministic()("text").alias("elements"))


def op9_ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return ngram_groups(docs).select("doc_id", "n_shingles", "component_id")


ORACLE_SQL = """
WITH RECURSIVE worded AS (
    SELECT doc_id, list_filter(string_split_regex(
        translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
        '[\\x20\\x09-\\x0D]+'), lambda w: w <> '') AS words
    FROM documents
), shingles AS (
    SELECT DISTINCT doc_id, array_to_string(words[i:i + size - 1], ' ') AS shingle
    FROM (SELECT *, unnest(range(1, len(words) - size + 2)) AS i
          FROM (SELECT *, least(3, len(words)) AS size FROM worded WHERE len(words) > 0))
), sizes AS (
    SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id
), common AS (
    SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS n
    FROM shingles a JOIN shingles b ON a.shingle = b.shingle AND a.doc_id <> b.doc_id
    GROUP BY ALL
), links AS (
    SELECT a, b FROM common JOIN sizes s ON s.doc_id = a JOIN sizes t ON t.doc_id = b
    WHERE 100 * common.n >= 90 * (s.n + t.n - common.n)
), reached AS (
    SELECT a, b FROM links
    UNION
    SELECT reached.a, links.b FROM reached JOIN links ON reached.b = links.a
)
SELECT w.doc_id, coalesce(any_value(s.n), 0)::BIGINT AS n_shingles,
       least(w.doc_id, coalesce(min(r.b), w.doc_id))::BIGINT AS component_id
FROM worded w LEFT JOIN sizes s ON s.doc_id = w.doc_id LEFT JOIN reached r ON r.a = w.doc_id
GROUP BY w.doc_id
"""
