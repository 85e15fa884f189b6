"""Documents joined when their sets of word n-grams overlap enough, through R-trees over group-count vectors.

Index. A document is a set of hashed n-grams. Hashed into groups, the set becomes a vector of group counts, a point.
Two sets share at most the sum of the smaller of both counts over all groups, so with s = similarity a pair can only link
if that sum is at least s / (1 + s) of both sizes together. Points lie in packed R-trees; a node keeps the largest count
of each group and the smallest size below it, so the same sum bounds all pairs with points below and whole branches are left out.

Routing. One tree over all documents cannot be held or searched anywhere, and points of 300 n-grams in 100 dimensions
are nearly all equally far apart. So points go to many small trees, by counts that must agree: linked sets differ in at most
R = (1 - s) / (1 + s) of both sizes together elements; cut by hash into more than R slices, they agree in the counts
of at least one. A tree holds the points that agree in the counts of one slice (as fine-grained as the hash itself), at one level of sizes. Both
documents of a link always meet in at least one tree, whatever the data.

Verification. Pairs that survive the bound are compared by their whole sets. Equal sets are one point from the start. In
a tree, points are first compared with its smallest document; components so found need no more comparisons inside, which
spares large groups of near copies their pairs. All other pairs with a bound that allows a link are verified,
nearest first, in rounds that end when none is left.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from flowloom.llm.batches import bytes_of, slices
from flowloom.llm.bloom import among, left_joined, probed, without
from flowloom.llm.components import components
from flowloom.llm.heavy import heavy_joined
from flowloom.llm.rowids import keyed, with_rid
from flowloom.llm.wordscan import doc_of, mixed, rolled, word_hashes
from flowloom.sources.staging import stage, staged_result

NGRAM, SIMILARITY = 3, (90, 100)
_SLICE = 1 << 20
_FAN = 16
# Points and queries that one task compares at once; larger trees are cut into a grid of such blocks.
_BLOCK = 1024
# Sets that a task remembers, so as not to route equal ones again; a set routed twice becomes one later.
_SEEN = 1 << 18


# Sets


def _sets(batch: pa.RecordBatch, ngram: int) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct n-gram hashes of all texts, and how many each text has."""
    hashes, words = word_hashes(*bytes_of(batch.column("text")), lower=True)
    first = np.cumsum(words) - words
    grams = rolled(hashes, ngram) if len(hashes) >= ngram else np.zeros(0, np.uint64)
    pieces, sizes = [], np.zeros(len(words), np.int64)
    for k, (begin, count) in enumerate(zip(first.tolist(), words.tolist(), strict=True)):
        if count >= ngram:
            own = np.sort(grams[begin : begin + count - ngram + 1])
            own = own[np.concatenate([[True], own[1:] != own[:-1]])]
        elif count:
            # All words together are the only element; the length keeps it apart from n-grams.
            own = mixed(rolled(hashes[begin : begin + count], count, 11) + np.uint64(count))
        else:
            continue
        pieces.append(own)
        sizes[k] = len(own)
    return np.concatenate(pieces) if pieces else np.zeros(0, np.uint64), sizes


def _groups(size: int) -> int:
    """Dimensions of a point: a power of two, one to two times the set's size."""
    return 1 << min(13, max(4, int(size).bit_length()))


def _point(own: np.ndarray) -> bytes:
    """Counts by group, in four bits each, or in a byte or four where one is larger."""
    dimensions = _groups(len(own))
    counts = np.bincount((own & np.uint64(dimensions - 1)).astype(np.int64), minlength=dimensions)
    if counts.max() > 255:
        return counts.astype("<u4").tobytes()
    counts = counts.astype(np.uint8)
    return (counts if counts.max() > 15 else counts[::2] | counts[1::2] << 4).tobytes()


def _counts(point: bytes, size: int) -> np.ndarray:
    dimensions = _groups(size)
    if len(point) > dimensions:
        return np.frombuffer(point, "<u4").astype(np.int32)
    packed = np.frombuffer(point, np.uint8)
    if len(point) == dimensions:
        return packed.astype(np.int32)
    return np.stack([packed & 15, packed >> 4], axis=1).ravel().astype(np.int32)


def _profiles(docs: DataFrame, ngram: int) -> DataFrame:
    """(rid, n, k1, k2, point): size and 128-bit key of the set, and its group counts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text", _SLICE):
            elements, sizes = _sets(batch, ngram)
            ends = np.concatenate([[0], np.cumsum(sizes)])
            keys = [mixed(elements), mixed(elements ^ np.uint64(0xA5A5A5A55A5A5A5A))]
            zero = np.zeros(1, np.uint64)
            sums = [np.diff(np.concatenate([zero, np.cumsum(k)])[ends]).view(np.int64) for k in keys]
            points = [_point(elements[a:b]) if b > a else b"" for a, b in zip(ends, ends[1:], strict=False)]
            columns = [batch.column("rid"), pa.array(sizes), pa.array(sums[0]), pa.array(sums[1]), pa.array(points, pa.binary())]
            yield pa.RecordBatch.from_arrays(columns, ["rid", "n", "k1", "k2", "point"])

    return docs.select("rid", "text").mapInArrow(run, "rid bigint, n bigint, k1 bigint, k2 bigint, point binary")


# Routing


class Levels:
    """Levels of set sizes, each three tenths larger than the one before, and the slices of each level."""

    def __init__(self, similarity: tuple[int, int], largest: int):
        self.part, self.whole = similarity
        bounds = [1]
        while bounds[-1] <= largest:
            bounds.append(max(bounds[-1] + 1, bounds[-1] * 13 // 10))
        self.bounds = np.array(bounds)
        most = self.bounds[1:] - 1
        #: Elements by which linked sets may differ, the smaller one being of that level.
        self.differ = (most + most * self.whole // self.part) * (self.whole - self.part) // (self.whole + self.part)
        #: Slices beyond those needed; a set with at most so many empty slices agrees with any partner in one that isn't.
        #: More than twice as many as come out empty by chance.
        chance = np.exp(-self.bounds[:-1] / (self.differ + 1))
        self.spare = 2 + np.ceil(2.5 * (self.differ + 1) * chance).astype(np.int64)
        self.slices = np.where(self.differ, self.differ + 1 + self.spare, 0)

    def of(self, sizes: np.ndarray) -> np.ndarray:
        return np.searchsorted(self.bounds, sizes, side="right") - 1

    def lowest(self, sizes: np.ndarray) -> np.ndarray:
        """The level of the smallest partner."""
        return self.of(np.maximum(1, -(-sizes * self.part // self.whole)))


def _signatures(docs: DataFrame, ngram: int, similarity: tuple[int, int]) -> DataFrame:
    """(tree, rid): the trees each set belongs to. Of equal sets in a task only the first is routed, as long as it is remembered."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[int] = set()
        for batch in slices(batches, "text", _SLICE):
            elements, sizes = _sets(batch, ngram)
            ends = np.concatenate([[0], np.cumsum(sizes)])
            spread = mixed(elements)
            keys = np.diff(np.concatenate([np.zeros(1, np.uint64), np.cumsum(spread)])[ends])
            fresh = np.zeros(len(sizes), bool)
            for k, key in enumerate(keys.tolist()):
                if sizes[k] and key not in seen:
                    if len(seen) >= _SEEN:
                        seen.clear()
                    seen.add(key)
                    fresh[k] = True
            rids = batch.column("rid").to_numpy(zero_copy_only=False)
            levels = Levels(similarity, int(sizes.max(initial=1)))
            top, low = levels.of(np.maximum(sizes, 1)), levels.lowest(np.maximum(sizes, 1))
            step = 0
            while True:
                level = top - step
                live = fresh & (level >= low) & (levels.slices[np.maximum(level, 0)] > 0)
                if not (fresh & (level >= low)).any():
                    break
                yield _routed(elements, spread, sizes, np.where(live, level, -1), levels, rids)
                step += 1

    return docs.select("rid", "text").mapInArrow(run, "tree bigint, rid bigint")


def _routed(elements, spread, sizes, level, levels: Levels, rids) -> pa.RecordBatch:
    which = doc_of(sizes)
    kept = level[which] >= 0
    which, elements, spread = which[kept], elements[kept], spread[kept]
    count = levels.slices[level].astype(np.uint64)
    cut = ((elements >> np.uint64(32)) * count[which]) >> np.uint64(32)
    if len(which):
        opens = np.flatnonzero(np.concatenate([[True], (which[1:] != which[:-1]) | (cut[1:] != cut[:-1])]))
        content = np.add.reduceat(spread, opens)
        owner, cut = which[opens], cut[opens].astype(np.int64)
    else:
        content, owner, cut = np.zeros(0, np.uint64), np.zeros(0, np.int64), np.zeros(0, np.int64)
    # Empty slices matter only for a set that has more of them than are spare.
    filled = np.bincount(owner, minlength=len(sizes))
    sparse = np.flatnonzero((level >= 0) & (levels.slices[level] - filled > levels.spare[level]))
    for doc in sparse.tolist():
        empty = np.setdiff1d(np.arange(levels.slices[level[doc]]), cut[owner == doc])
        content = np.concatenate([content, np.zeros(len(empty), np.uint64)])
        owner = np.concatenate([owner, np.full(len(empty), doc)])
        cut = np.concatenate([cut, empty])
    place = (level[owner].astype(np.uint64) << np.uint64(40)) + cut.astype(np.uint64) + np.uint64(1)
    tree = mixed(content + mixed(place)).view(np.int64)
    return pa.RecordBatch.from_arrays([pa.array(tree), pa.array(rids[owner])], ["tree", "rid"])


# Trees


def _folded(points: list[bytes], sizes: np.ndarray) -> np.ndarray:
    """Points with the same number of dimensions: pairs of groups are added up where there are more."""
    out = []
    wanted = min(_groups(int(n)) for n in sizes)
    for point, size in zip(points, sizes, strict=True):
        counts = _counts(point, int(size))
        while len(counts) > wanted:
            counts = counts[: len(counts) // 2] + counts[len(counts) // 2 :]
        out.append(counts)
    stacked = np.stack(out)
    return stacked.astype(np.uint8) if stacked.max() < 256 else stacked


class RTree:
    """A packed R-tree: each node covers 16 entries below it."""

    def __init__(self, points: np.ndarray, sizes: np.ndarray, labels: np.ndarray, similarity: tuple[int, int]):
        # Neighbours in the packing have one label, then like sizes, then like counts.
        weights = np.arange(1, points.shape[1] + 1, dtype=np.float32)
        self.order = np.lexsort((points @ weights, sizes, labels))
        self.part, self.total = similarity[0], sum(similarity)
        #: From the leaves up: largest counts, smallest size, smallest and largest label.
        self.layers = [(points[self.order], sizes[self.order], labels[self.order], labels[self.order])]
        while len(self.layers[-1][0]) > _FAN:
            high, low, least, most = self.layers[-1]
            at = np.arange(0, len(high), _FAN)
            layer = (np.maximum.reduceat(high, at), np.minimum.reduceat(low, at))
            self.layers.append((*layer, np.minimum.reduceat(least, at), np.maximum.reduceat(most, at)))

    def near(self, point: np.ndarray, size: int, label: int) -> np.ndarray:
        """Entries of other labels whose bound allows a link, nearest first."""
        nodes = np.arange(len(self.layers[-1][0]))
        for depth in range(len(self.layers) - 1, -1, -1):
            high, low, least, most = self.layers[depth]
            nodes = nodes[(least[nodes] != label) | (most[nodes] != label)]
            shared = np.minimum(high[nodes], point).sum(axis=1, dtype=np.int64)
            fits = shared * self.total >= self.part * (size + low[nodes])
            nodes, shared = nodes[fits], shared[fits]
            if depth:
                nodes = (nodes[:, None] * _FAN + np.arange(_FAN)).ravel()
                nodes = nodes[nodes < len(self.layers[depth - 1][0])]
        ratio = shared / (size + low[nodes])
        return self.order[nodes[np.lexsort((self.order[nodes], -ratio))]]


def _search(block: pa.Table, similarity: tuple[int, int], most: int) -> pa.Table:
    """(tree, a, b, more): candidate pairs of one block of a tree; `more` says that a query has candidates left."""
    rows = block.to_pydict()
    own = rows["tree"][0]
    asks, holds = np.array(rows["asks"], bool), np.array(rows["held"], bool)
    sizes, labels = np.array(rows["n"], np.int64), np.array(rows["label"], np.int64)
    points, rids = _folded(rows["point"], sizes), np.array(rows["rid"], np.int64)
    held, queries = np.flatnonzero(holds), np.flatnonzero(asks)
    out: list[tuple[int, int, int, bool]] = []
    if len(held):
        tree = RTree(points[held], sizes[held], labels[held], similarity)
        for q in queries.tolist():
            found = rids[held[tree.near(points[q], int(sizes[q]), int(labels[q]))]]
            more = len(found) > most
            out.extend((own, min(int(rids[q]), int(r)), max(int(rids[q]), int(r)), more) for r in found[:most])
    names, kinds = ("tree", "a", "b", "more"), (pa.int64(), pa.int64(), pa.int64(), pa.bool_())
    columns = list(zip(*out, strict=True)) or [(), (), (), ()]
    return pa.table([pa.array(list(c), k) for c, k in zip(columns, kinds, strict=True)], names=list(names))


def _candidates(members: DataFrame, profiles: DataFrame, labels: DataFrame, similarity: tuple[int, int], most: int) -> DataFrame:
    """Pairs of different labels that meet in a tree and whose bound allows a link.

    The most frequent label of a tree asks nothing: its pairs with others are asked for by those. Large trees are cut into
    blocks of points and of queries; in others a row is both.
    """
    marked = members.join(labels, "rid", "left").withColumn("label", F.coalesce("label", "rid"))
    counts = marked.groupBy("tree", "label").agg(F.count("*").alias("k"))
    common = counts.groupBy("tree").agg(
        F.max_by("label", F.struct("k", "label")).alias("common"), F.sum("k").alias("size"), F.max("k").alias("top")
    )
    common = common.filter("size > top")
    rows = heavy_joined(stage(marked, "marked"), common, ["tree"]).join(profiles, "rid")
    points = F.ceil(F.col("size") / _BLOCK).cast("int")
    queries = F.ceil((F.col("size") - F.col("top")) / _BLOCK).cast("int")
    spread = F.xxhash64("rid")
    asks, large = F.col("label") != F.col("common"), points > 1

    def role(pb: Column, qb: Column, held: bool, asking: Column) -> Column:
        return F.struct(pb.cast("int").alias("pb"), qb.cast("int").alias("qb"), F.lit(held).alias("held"), asking.alias("asks"))

    no, yes, mine = F.lit(False), F.lit(True), F.pmod(spread, points)
    as_point = F.transform(F.sequence(F.lit(0), queries - 1), lambda q: role(mine, q, True, no))
    as_query = F.transform(F.sequence(F.lit(0), points - 1), lambda p: role(p, F.pmod(spread, queries), False, yes))
    both = F.array(role(F.lit(0), F.lit(0), True, asks))
    roles = F.when(~large, both).when(asks, F.concat(as_point, as_query)).otherwise(as_point)
    dealt = rows.select("tree", "rid", "n", "point", "label", F.inline(roles))
    blocks = dealt.groupBy("tree", "pb", "qb")
    return blocks.applyInArrow(lambda block: _search(block, similarity, most), "tree bigint, a bigint, b bigint, more boolean")


def _within_bound(pairs: DataFrame, profiles: DataFrame, similarity: tuple[int, int]) -> DataFrame:
    """The pairs (a, b) whose points allow a link: what a tree's nodes test, for pairs that are known."""
    left = profiles.select(F.col("rid").alias("a"), F.col("n").alias("na"), F.col("point").alias("pa"))
    right = profiles.select(F.col("rid").alias("b"), F.col("n").alias("nb"), F.col("point").alias("pb"))
    part, total = similarity[0], sum(similarity)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            columns = (batch.column(c).to_pylist() for c in ("na", "pa", "nb", "pb"))
            chosen = []
            for na, one, nb, two in zip(*columns, strict=True):
                one, two = _folded([one, two], np.array([na, nb]))
                chosen.append(int(np.minimum(one, two).sum(dtype=np.int64)) * total >= part * (na + nb))
            mask = pa.array(chosen, pa.bool_())
            yield pa.RecordBatch.from_arrays([batch.column(c).filter(mask) for c in ("a", "b")], ["a", "b"])

    joined = pairs.join(left, "a").join(right, "b").select("a", "b", "na", "pa", "nb", "pb")
    return joined.mapInArrow(run, "a bigint, b bigint")


# Verification


def _verified(pairs: DataFrame, docs: DataFrame, ngram: int, similarity: tuple[int, int]) -> DataFrame:
    """The pairs (a, b), a staged table, whose sets link. Only texts in some pair are read as sets, and shuffled."""
    ends = stage(pairs.select(F.explode(F.array("a", "b")).alias("rid")).distinct(), "ends")
    sets = stage(_elements(among(docs, ends, "rid"), ngram), "sets")
    left = sets.select(F.col("rid").alias("a"), F.col("elements").alias("ea"))
    right = sets.select(F.col("rid").alias("b"), F.col("elements").alias("eb"))
    joined = pairs.join(left, "a").join(right, "b").select("a", "b", "ea", "eb")
    part, whole = similarity

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            linked = []
            for x, y in zip(batch.column("ea"), batch.column("eb"), strict=True):
                one, two = np.frombuffer(x.as_buffer(), "<u8"), np.frombuffer(y.as_buffer(), "<u8")
                both = np.sort(np.concatenate([one, two]))
                shared = int((both[1:] == both[:-1]).sum())
                linked.append(whole * shared >= part * (len(both) - shared))
            chosen = pa.array(linked, pa.bool_())
            yield pa.RecordBatch.from_arrays([batch.column(c).filter(chosen) for c in ("a", "b")], ["a", "b"])

    return joined.mapInArrow(run, "a bigint, b bigint")


def _elements(docs: DataFrame, ngram: int) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text", _SLICE):
            elements, sizes = _sets(batch, ngram)
            ends = np.concatenate([[0], np.cumsum(sizes)])
            data = [elements[a:b].astype("<u8").tobytes() for a, b in zip(ends, ends[1:], strict=False)]
            yield pa.RecordBatch.from_arrays([batch.column("rid"), pa.array(data, pa.binary())], ["rid", "elements"])

    return docs.select("rid", "text").mapInArrow(run, "rid bigint, elements binary")


def _links(docs: DataFrame, firsts: DataFrame, equal: DataFrame, ngram: int, similarity: tuple[int, int]) -> DataFrame:
    """(rid, label): the component of each set that is linked with another."""
    routed = stage(_signatures(docs, ngram, similarity), "routed")
    several = stage(routed.groupBy("tree").agg(F.count("*").alias("c")).filter("c > 1").select("tree"), "several")
    # Most trees have one member; rows of those that the filter tells are neither counted again nor shuffled and sorted.
    likely = stage(probed(routed, F.col("tree"), several, "tree")[0], "likely")
    met = heavy_joined(likely, several, ["tree"])
    # Sets routed by several tasks become one again.
    copies = stage(equal.filter("rid <> first"), "copies")
    named = left_joined(met, copies, "rid").select("tree", F.coalesce("first", "rid").alias("rid"))
    met = stage(named.distinct(), "met")
    trees = met.groupBy("tree").agg(
        F.count("*").alias("c"), F.min("rid").alias("least"), F.sum(F.xxhash64("rid") % (1 << 40)).alias("sum")
    )
    # Trees with the same members are one tree.
    same = trees.filter("c > 1").groupBy("c", "least", "sum").agg(F.min("tree").alias("tree")).select("tree", "least")
    members = stage(heavy_joined(met, stage(same, "trees"), ["tree"]), "members")
    profiles = stage(firsts.join(members.select("rid").distinct(), "rid", "left_semi").select("rid", "n", "point"), "points")
    pairs = members.filter("rid <> least").select(F.col("least").alias("a"), F.col("rid").alias("b")).distinct()
    tried = stage(_within_bound(pairs, profiles, similarity), "tried")
    links = stage(_verified(tried, docs, ngram, similarity), "links")
    labels = _labels(links)
    most = 8
    while True:
        found = stage(_candidates(members.select("tree", "rid"), profiles, labels, similarity, most), "candidates")
        if found.isEmpty():
            return labels
        fresh = found.select("a", "b").distinct().join(tried, ["a", "b"], "left_anti")
        fresh = stage(fresh, "tried")
        links = stage(links.union(_verified(fresh, docs, ngram, similarity)), "links")
        labels, tried = _labels(links), tried.union(fresh)
        # Trees that have shown all their candidates need no further look.
        again = stage(found.filter("more").select("tree").distinct(), "again")
        if again.isEmpty():
            return labels
        members = stage(members.join(again, "tree", "left_semi"), "members")
        most *= 8


def _labels(links: DataFrame) -> DataFrame:
    return components(links).withColumnRenamed("node", "rid")


def jaccard_components(
    docs: DataFrame, similarity: tuple[int, int] = SIMILARITY, ngram: int = NGRAM, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """Per row: doc_id, n_shingles and component_id, the smallest id reachable by links.

    A set holds the distinct n-grams of words, A-Z taken as a-z; fewer words than that are one element; a null or
    empty text has an empty set and links with nothing. Two rows link when the shared elements are at least
    `similarity` (a fraction) of all elements of both. Rows that repeat are rows of their own; with null or repeated
    ids, the component of a row is named by the smallest id in it, a null one counting last. Only the two columns are read.
    """
    spark = docs.sparkSession
    return staged_result(spark, lambda: _components(docs, similarity, ngram, id_col, text_col), "components")


def _components(docs: DataFrame, similarity: tuple[int, int], ngram: int, id_col: str, text_col: str) -> DataFrame:
    rows, numbered = with_rid(docs, id_col, text_col)
    texts = rows.select("rid", "text")
    profiles = stage(_profiles(texts, ngram), "profiles")
    groups = profiles.filter("n > 0").groupBy("n", "k1", "k2").agg(F.min("rid").alias("first"))
    keys = profiles.filter("n > 0").select("rid", "n", "k1", "k2")
    equal = stage(heavy_joined(keys, stage(groups, "groups"), ["n", "k1", "k2"]).select("rid", "first"), "equal")
    firsts = profiles.join(equal.filter("rid = first").select("rid"), "rid", "left_semi")
    labels = _links(texts, firsts, equal, ngram, similarity)
    named = heavy_joined(equal, labels.withColumnRenamed("rid", "first"), ["first"], "left")
    named = named.select("rid", F.coalesce("label", "first").alias("label"))
    done = profiles.select("rid", F.col("n").alias("n_shingles")).join(named, "rid", "left")
    done = done.withColumn("label", F.coalesce("label", "rid"))
    if not numbered:
        return done.select(F.col("rid").alias("doc_id"), "n_shingles", F.col("label").alias("component_id"))
    done = stage(done.join(rows.select("rid", "doc_id"), "rid"), "named")
    least = done.groupBy("label").agg(F.min("doc_id").alias("component_id"))
    return heavy_joined(done, least, ["label"]).select("doc_id", "n_shingles", "component_id")


def first_of_each(
    docs: DataFrame, similarity: tuple[int, int] = SIMILARITY, ngram: int = NGRAM, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """The rows of `docs`, all columns, without those that another row of their component comes before.

    The row with the smallest id stays, null ids counting last; of rows with one id, the first by a hash of their content. Rows without
    words stay.
    """
    rows, rid = keyed(docs, id_col)
    found = jaccard_components(rows, similarity, ngram, rid, text_col).filter("doc_id <> component_id")
    gone = stage(found.select(F.col("doc_id").alias(rid)), "gone")
    return without(rows, gone, rid).select(*[F.col(f"`{c}`") for c in docs.columns])
