"""Near-duplicate classes from DartMinHash signatures of weighted shingle sets.

A text is the multiset of its five-word shingles (lower case, cut at white
space); a shingle's count is its weight. Hashed darts are thrown at every element:
in weight layers [0,1), [1,2), [2,4), ... each element has its own stream of darts
with a weight, a rank and a coordinate, all from hashes, and a set is hit by the
darts below its element's weight. The rank up to which darts are thrown falls
with the set's total weight, so every set gets about as many darts, whatever its
size, and work is linear in its words. The earliest dart of each coordinate is the
signature; two sets agree in a coordinate with the probability of their weighted
Jaccard similarity.

Signatures are cut into bands; texts that agree in a band share a bucket. All
members of a bucket are compared with one centre, the member that shares its buckets
with most others, and joined to classes along what is similar; members of one class
need not meet again. Shingles that no other member of an open bucket has bound what a
member can share; where the bound lies below the wanted similarity for every size in
the bucket, the member leaves it, which loses nothing. What is then left of a bucket
outside its largest class is compared with the whole bucket if it is little (``FEW``)
or the bucket is small (``SMALL``). The members of buckets with much left are put in
groups, and each is written as its differences from a core, the shingles that most of
its group have. Two are similar exactly if they have enough differences in common
(``_apart``), so near copies with edits of their own, which share nearly all shingles but
few differences, do not meet; those that may have enough in common by their rarest
differences are compared. No pair that is similar goes unseen among them. So the number of
comparisons grows with the members, not with their square, unless many that are not
similar have many differences in common. Similarities are
exact, over the shingles.

Two texts with a similarity of 0.8 share no band in 3 of 100,000 cases and go unseen;
above 0.8 this falls quickly. Texts that share a band are compared or joined by others.

Cases: identical word sequences are one class without comparing; texts without
words are such copies of each other, null texts are empty; texts of one to four
words are one shingle; rows with a null id get a null class; rows that share an
id are one document each, also if their texts differ. The class id is the smallest
document id in the class, so ties need no rule. Columns beside id and text are not
read, whatever their names; an empty table gives no row. Texts are used whole: the
darts of a text of any length are thrown at once.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from profilelake.llm.common import may_hold, staged, texts

SHINGLE = 5
SIMILARITY = 0.8
BANDS, ROWS = 20, 4
COORDINATES = BANDS * ROWS
SMALL = 64  # members of a bucket that meet all with all
FEW = 32  # members outside a bucket's largest class that meet the whole bucket
LEVELS = 2  # cores sought in a group of members of buckets with much left
ROUND = 4_000_000  # pairs compared at once, in the last step
SLACK = 1e-6  # for sums of shares of whole numbers
CHUNK_WORDS = 200_000  # words whose darts are in memory at once

_ODD = np.uint64(0x9E3779B97F4A7C15)


def words(text: Column) -> Column:
    return F.array_remove(F.split(F.lower(text), r"[\x20\x09-\x0D]+"), "")


def word_hashes(words: Column) -> Column:
    return F.transform(words, lambda w: F.xxhash64(w))


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser: every input bit reaches every output bit."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def uniform(x: np.ndarray) -> np.ndarray:
    """Numbers in (0, 1] from hashes."""
    return ((x >> np.uint64(11)).astype(np.float64) + 1.0) * 2.0**-53


def shingles(hashes: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(set number, shingle hash) of texts whose word hashes stand one after another."""
    counts = np.where(sizes > 0, np.maximum(sizes - SHINGLE + 1, 1), 0)
    owner = np.repeat(np.arange(len(sizes)), counts)
    starts = np.cumsum(sizes) - sizes
    within = np.arange(counts.sum()) - np.repeat(np.cumsum(counts) - counts, counts)
    at = starts[owner] + within
    ends = (starts + sizes)[owner]
    padded = np.concatenate([hashes.astype(np.uint64), np.zeros(SHINGLE, np.uint64)])
    value = np.zeros(len(at), np.uint64)
    for k in range(SHINGLE):
        word = np.where(at + k < ends, padded[at + k], np.uint64(0))
        value = mix((value + word) * _ODD + np.uint64(k + 1))
    return owner, value


def weighted(owner: np.ndarray, value: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct (set, element) and the counts."""
    order = np.lexsort((value, owner))
    owner, value = owner[order], value[order]
    first = np.ones(len(owner), bool)
    first[1:] = (owner[1:] != owner[:-1]) | (value[1:] != value[:-1])
    at = np.flatnonzero(first)
    return owner[at], value[at], np.diff(np.append(at, len(owner)))


def darts(owner, element, weight, reach, coordinates):
    """(set, coordinate, rank, dart) of all darts that hit, up to each set's reach."""
    found = []
    low, width, layer = 0.0, 1.0, 0
    while True:
        in_layer = weight > low
        if not in_layer.any():
            break
        who, top, limit = owner[in_layer], weight[in_layer], reach[owner[in_layer]]
        stream = mix(element[in_layer] + np.uint64(layer + 1 << 58) + _ODD)
        rank = np.zeros(len(who))
        while len(who):
            stream = mix(stream + _ODD)
            rank = rank - np.log(uniform(stream)) / width
            alive = rank < limit
            who, top, limit = who[alive], top[alive], limit[alive]
            stream, rank = stream[alive], rank[alive]
            place = mix(stream ^ np.uint64(0x5851F42D4C957F2D))
            hit = low + width * uniform(place) <= top
            dart = mix(place + _ODD)
            found.append(
                (who[hit], (dart[hit] % np.uint64(coordinates)).astype(np.int64), rank[hit], dart[hit])
            )
        low, width, layer = (1.0, 1.0, 1) if not layer else (low + width, 2 * width, layer + 1)
    return [np.concatenate(x) for x in zip(*found)] if found else None


def signatures(hashes: np.ndarray, sizes: np.ndarray, coordinates: int = COORDINATES) -> np.ndarray:
    """One row of dart numbers per text with words; rows of other texts are zero."""
    out = np.zeros((len(sizes), coordinates), np.uint64)
    owner, value = shingles(hashes, sizes)
    total = np.bincount(owner, minlength=len(sizes)).astype(np.float64)
    owner, element, weight = weighted(owner, value)
    throws = coordinates * (math.log(coordinates) + 5)
    todo = np.flatnonzero(total > 0)
    while len(todo):
        reach = np.zeros(len(sizes))
        reach[todo] = throws / total[todo]
        mine = reach[owner] > 0
        who, coordinate, rank, dart = darts(
            owner[mine], element[mine], weight[mine], reach, coordinates
        )
        cell = who * coordinates + coordinate
        order = np.lexsort((dart, rank, cell))
        cell = cell[order]
        first = np.ones(len(cell), bool)
        first[1:] = cell[1:] != cell[:-1]
        out.reshape(-1)[cell[first]] = dart[order][first]
        filled = np.bincount(cell[first] // coordinates, minlength=len(sizes))
        todo = todo[filled[todo] < coordinates]  # a coordinate without a dart: throw more
        throws *= 2
    return out


def band_hashes(signature: np.ndarray, bands: int = BANDS) -> np.ndarray:
    cut = signature.reshape(len(signature), bands, -1)
    value = np.zeros(cut.shape[:2], np.uint64)
    for k in range(cut.shape[2]):
        value = mix((value + cut[:, :, k]) * _ODD + np.uint64(k + 1))
    return value.astype(np.int64)


@F.arrow_udf(T.ArrayType(T.LongType(), False))
def band_udf(column: pa.Array) -> pa.Array:
    """Band hashes of arrays of word hashes; an empty array has none."""
    values = column.flatten().to_numpy(zero_copy_only=False)
    sizes = column.value_lengths().to_numpy(zero_copy_only=False).astype(np.int64)
    ends = np.cumsum(sizes)
    parts, start = [], 0
    while start < len(sizes):
        before = ends[start] - sizes[start]
        stop = max(start + 1, int(np.searchsorted(ends, before + CHUNK_WORDS, "right")))
        chunk = signatures(values[before : ends[stop - 1]], sizes[start:stop])
        parts.append(band_hashes(chunk)[sizes[start:stop] > 0].reshape(-1))
        start = stop
    flat = np.concatenate(parts) if parts else np.zeros(0, np.int64)
    offsets = np.concatenate([[0], np.cumsum(np.where(sizes > 0, BANDS, 0))])
    return pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(flat))


def elements(hashes: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(sorted elements of each text, one text after another; how many each has).

    A shingle that occurs again is another element, so that the similarity of the sets is
    the weighted similarity of the texts.
    """
    owner, value = shingles(hashes, sizes)
    order = np.lexsort((value, owner))
    owner, value = owner[order], value[order]
    first = np.ones(len(owner), bool)
    first[1:] = (owner[1:] != owner[:-1]) | (value[1:] != value[:-1])
    starts = np.flatnonzero(first)
    again = np.arange(len(owner)) - np.repeat(starts, np.diff(np.append(starts, len(owner))))
    element = mix(value + again.astype(np.uint64) * _ODD).astype(np.int64)
    return element[np.lexsort((element, owner))], np.bincount(owner, minlength=len(sizes))


def _parts(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(all numbers of an array column, where each row's end)."""
    sizes = column.value_lengths().to_numpy(zero_copy_only=False).astype(np.int64)
    return column.flatten().to_numpy(zero_copy_only=False), np.cumsum(sizes)


@F.arrow_udf(T.ArrayType(T.LongType(), False))
def elements_udf(column: pa.Array) -> pa.Array:
    """The elements of texts given as arrays of word hashes."""
    values, ends = _parts(column)
    sizes = np.diff(ends, prepend=0)
    parts, counts, start = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)], 0
    while start < len(sizes):
        before = ends[start] - sizes[start]
        stop = max(start + 1, int(np.searchsorted(ends, before + CHUNK_WORDS, "right")))
        found, n = elements(values[before : ends[stop - 1]], sizes[start:stop])
        parts.append(found)
        counts.append(n)
        start = stop
    offsets = np.concatenate([[0], np.cumsum(np.concatenate(counts))])
    return pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(np.concatenate(parts)))


def similarity_of(left: np.ndarray, right: np.ndarray) -> float:
    """Jaccard similarity of two sorted sets of elements."""
    if len(left) < len(right):
        left, right = right, left
    if not len(right):
        return float(not len(left))
    at = np.searchsorted(left, right)
    at[at == len(left)] = 0
    shared = int((left[at] == right).sum())
    return shared / (len(left) + len(right) - shared)


@F.arrow_udf(T.DoubleType())
def similarity_udf(left: pa.Array, right: pa.Array) -> pa.Array:
    (a, a_ends), (b, b_ends) = _parts(left), _parts(right)
    found, i, j = np.empty(len(a_ends)), 0, 0
    for k, (m, n) in enumerate(zip(a_ends.tolist(), b_ends.tolist())):
        found[k] = similarity_of(a[i:m], b[j:n])
        i, j = m, n
    return pa.array(found, pa.float64())


def components(edges: DataFrame) -> DataFrame:
    """(node, label) of the nodes of (a, b): the smallest node that each can reach."""
    both = staged(
        edges.select("a", "b").unionAll(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    )
    labels = staged(both.groupBy("a").agg(F.least("a", F.min("b")).alias("label")))
    labels = labels.withColumnRenamed("a", "node")
    while True:
        near = (
            both.join(labels, both.b == labels.node)
            .groupBy("a")
            .agg(F.min("label").alias("near"))
        )
        step = labels.join(near, labels.node == near.a).select(
            "node", F.col("label").alias("old"), F.least("label", "near").alias("label")
        )
        up = step.select(F.col("node").alias("at"), F.col("label").alias("up"))
        jumped = step.join(up, step.label == up["at"]).select(
            "node", F.least("label", "up").alias("label"), (F.col("old") != F.least("label", "up")).alias("moved")
        )
        jumped = staged(jumped)
        labels = jumped.select("node", "label")
        if jumped.filter("moved").isEmpty():
            return labels


def _compared(pairs: DataFrame, hashed: DataFrame, similarity: float) -> DataFrame:
    """The pairs (a, b) that are similar, stored."""
    pairs = staged(pairs.distinct(), "pairs")
    # Only the elements of nodes that are in a pair are shuffled.
    some = may_hold(hashed, pairs.select(F.explode(F.array("a", "b")).alias("node")), "node")
    left = some.select(F.col("node").alias("a"), F.col("elements").alias("left"))
    right = some.select(F.col("node").alias("b"), F.col("elements").alias("right"))
    met = pairs.join(left, "a").join(right, "b")
    return staged(met.filter(similarity_udf("left", "right") >= similarity).select("a", "b"), "links")


def _merged(classes: DataFrame, links: DataFrame) -> DataFrame:
    """Classes joined along links."""
    if links.isEmpty():
        return classes
    of_a = classes.select(F.col("node").alias("a"), F.col("class").alias("class_a"))
    of_b = classes.select(F.col("node").alias("b"), F.col("class").alias("class_b"))
    edges = links.join(of_a, "a").join(of_b, "b")
    edges = edges.select(F.col("class_a").alias("a"), F.col("class_b").alias("b")).distinct()
    found = components(edges).select(F.col("node").alias("old"), "label")
    moved = classes.join(found, classes["class"] == found.old, "left")
    kept = moved.select("node", "first", "weight", F.coalesce("label", "class").alias("class"))
    return staged(kept, "classes")


def _order() -> Column:
    """What makes a member a centre: much company, then a small id."""
    return F.struct((-F.col("weight")).alias("w"), "first", "node", "class")


def _star(members: DataFrame, classes: DataFrame) -> DataFrame:
    """Every member of a bucket with several classes, beside the bucket's centre."""
    placed = members.join(classes, "node")
    centres = placed.groupBy("key").agg(
        F.min("class").alias("lo"), F.max("class").alias("hi"), F.min(_order()).alias("c")
    )
    # Stored, so that its join deals the members by an exchange that Spark can split.
    centres = staged(centres.filter("lo < hi").select("key", "c.node", "c.class"), "centres")
    centres = centres.select("key", F.col("node").alias("centre"), F.col("class").alias("centre_class"))
    return placed.join(centres, "key").filter(F.col("class") != F.col("centre_class"))


def _able(members: DataFrame, classes: DataFrame, hashed: DataFrame, similarity: float) -> DataFrame:
    """Members of buckets of several classes, without those that can be similar to no other there."""
    placed = members.join(classes, "node")
    open_ = placed.groupBy("key").agg(F.min("class").alias("lo"), F.max("class").alias("hi"))
    open_ = staged(open_.filter("lo < hi").select("key"), "open-keys")
    held = staged(members.join(open_, "key"), "open-members")
    # A node too many makes the bound wider, never narrower.
    nodes = may_hold(hashed, held, "node")
    met = nodes.select("node", F.explode("elements").alias("e")).groupBy("e").agg(
        F.count(F.lit(1)).alias("n"), F.min("node").alias("node")
    )
    own = met.filter("n = 1").groupBy("node").agg(F.count(F.lit(1)).alias("own"))
    sizes = nodes.select("node", F.size("elements").alias("size")).join(own, "node", "left")
    sizes = staged(sizes.select("node", "size", (F.col("size") - F.coalesce("own", F.lit(0))).alias("common")), "sizes")
    sized = held.join(sizes, "node")
    least = sized.groupBy("key").agg(F.min("size").alias("least"))
    # At best a partner has all that is common, and nothing else unless all are larger.
    most = F.col("common") / (F.col("size") + F.greatest("least", "common") - F.col("common"))
    able = sized.join(staged(least, "least"), "key").filter(most >= similarity - 1e-9)
    return staged(able.select(members.columns), "able")


def _left_over(members: DataFrame, classes: DataFrame) -> DataFrame:
    """Members of buckets that still hold several classes, with the bucket's figures, stored."""
    placed = members.join(classes, "node")
    sizes = placed.groupBy("key", "class").agg(
        F.count(F.lit(1)).alias("n"), F.min(_order()).alias("centre")
    )
    buckets = (
        sizes.groupBy("key")
        .agg(F.sum("n").alias("n"), F.max(F.struct("n", "class")).alias("top"), F.min("centre").alias("centre"))
        .withColumn("others", F.col("n") - F.col("top.n"))
        .filter("others > 0")
    )
    buckets = staged(
        buckets.select("key", "n", "others", F.col("top.class").alias("top"), F.col("centre.node").alias("centre")),
        "buckets",
    )
    return staged(placed.join(buckets, "key"), "open")


def _within(open_: DataFrame) -> DataFrame:
    """All pairs of different classes, but for the centre, which has met all."""
    plain = open_.filter(F.col("node") != F.col("centre"))
    few = plain.filter(F.col("class") != F.col("top")).select(
        "key", F.col("node").alias("x"), F.col("class").alias("x_class")
    )
    met = few.join(plain, "key").filter(
        (F.col("x_class") != F.col("class")) & ((F.col("class") == F.col("top")) | (F.col("x") < F.col("node")))
    )
    return met.select(F.least("x", "node").alias("a"), F.greatest("x", "node").alias("b"))


def _groups(members: DataFrame) -> DataFrame:
    """(node, group): members that share buckets, or share them with common company, are one group."""
    least = staged(members.groupBy("key").agg(F.min("node").alias("b")), "firsts")
    edges = members.join(least, "key").select(F.col("node").alias("a"), "b").distinct()
    return components(edges).withColumnRenamed("label", "group")


def _views(groups: DataFrame, hashed: DataFrame, similarity: float) -> DataFrame:
    """(group, part, label, node, delta, apart): what sets the members of a group apart, stored.

    ``apart`` are the elements that differ from a core, the elements that most of a part of
    the group have. A core is sought ``LEVELS`` times, each time among the members that none
    has fitted yet; the last part has no core. Parts meet in part -1, also without a core.
    """
    sets = may_hold(hashed, groups, "node").join(groups, "node").select("group", "node", "elements")
    todo, views = staged(sets, "sets"), []
    none = F.array().cast("array<bigint>")
    for label in range(LEVELS):
        members = todo.groupBy("group").agg(F.count(F.lit(1)).alias("n"))
        often = todo.select("group", F.explode("elements").alias("e")).groupBy("group", "e").agg(F.count(F.lit(1)).alias("f"))
        core = often.join(members, "group").filter("2 * f > n").groupBy("group").agg(F.collect_list("e").alias("core"))
        near = todo.join(staged(core, "cores"), "group", "left").withColumn("core", F.coalesce("core", none))
        apart = F.concat(F.array_except("elements", "core"), F.array_except("core", "elements"))
        near = staged(near.select("group", "node", "elements", apart.alias("apart")), "apart")
        fits = F.size("apart") < F.size("elements")
        views.append(near.filter(fits).withColumn("label", F.lit(label)))
        todo = near.filter(~fits).drop("apart")
    views.append(todo.withColumn("apart", F.col("elements")).withColumn("label", F.lit(LEVELS)))
    alone = views[0]
    for view in views[1:]:
        alone = alone.unionByName(view)
    several = alone.groupBy("group").agg(F.min("label").alias("lo"), F.max("label").alias("hi"))
    several = staged(several.filter("lo < hi").select("group"), "mixed")
    across = alone.join(several, "group", "left_semi").withColumn("apart", F.col("elements"))
    both = alone.withColumn("part", F.col("label")).unionByName(across.withColumn("part", F.lit(-1)))
    delta = F.size("apart") - F.size("elements") * ((1 - similarity) / (1 + similarity))
    return staged(both.select("group", "part", "label", "node", delta.alias("delta"), "apart"), "views")


def _nearest(views: DataFrame, classes: DataFrame) -> DataFrame:
    """The member nearest to its part's core, beside all whose differences are few enough for it."""
    placed = views.filter("part >= 0").select("group", "part", "node", "delta").join(classes.select("node", "class"), "node")
    least = placed.groupBy("group", "part").agg(F.min(F.struct("delta", "node", "class")).alias("m"))
    met = placed.join(staged(least, "nearest"), ["group", "part"])
    met = met.filter((F.col("class") != F.col("m.class")) & (F.col("delta") + F.col("m.delta") <= SLACK))
    return met.select(F.least("node", "m.node").alias("a"), F.greatest("node", "m.node").alias("b"))


def _differing(views: DataFrame, classes: DataFrame) -> DataFrame:
    """All pairs of different classes of a part that may have enough differences in common."""
    at = ["group", "part"]
    of = classes.select("node", "class")
    placed = views.select(*at, "node", "delta").join(of, "node")
    least = placed.groupBy(at).agg(F.min(F.struct("delta", "class")).alias("m"))
    outer = placed.join(staged(least, "least"), at).filter("class != m.class")
    outer = outer.groupBy(at).agg(F.first("m").alias("m"), F.min("delta").alias("outer"))
    open_ = views.join(of, "node").join(staged(outer, "outer"), at)
    partner = F.when(F.col("class") == F.col("m.class"), F.col("outer")).otherwise(F.col("m.delta"))
    open_ = open_.select(*at, "label", "node", "class", "delta", partner.alias("partner"), F.explode("apart").alias("e"))
    # What only members of one class have is in common with no other class.
    one = f"OVER (PARTITION BY {', '.join(at)}, e)"
    figures = {"n": "count(1)", "lo": "min(class)", "hi": "max(class)"}
    met = open_.select("*", *(F.expr(f"{f} {one}").alias(c) for c, f in figures.items())).filter("lo < hi")
    rare = met.groupBy(*at, "label", "node", "class", "delta", "partner").agg(
        F.sort_array(F.collect_list(F.struct("n", "e"))).alias("rare")
    )
    # The rarest that two have in common comes before all others that they have in common.
    first = rare.select("*", F.posexplode("rare").alias("place", "s")).withColumn("rest", F.size("rare") - F.col("place"))
    first = first.filter(2 * F.col("rest") >= F.col("delta") + F.col("partner") - SLACK)
    first = staged(first.select(*at, F.col("s.e").alias("e"), "label", "node", "class", "delta", "rest"), "differences")
    other = first.select(*at, "e", *(F.col(c).alias(f"{c}_2") for c in ("label", "node", "class", "delta", "rest")))
    pairs = first.join(other, [*at, "e"]).filter(
        (F.col("node") < F.col("node_2"))
        & (F.col("class") != F.col("class_2"))
        & ((F.col("part") >= 0) | (F.col("label") != F.col("label_2")))
        & (2 * F.least("rest", "rest_2") >= F.col("delta") + F.col("delta_2") - SLACK)
    )
    return pairs.select(F.col("node").alias("a"), F.col("node_2").alias("b"))


def _apart(members: DataFrame, classes: DataFrame, hashed: DataFrame, similarity: float) -> DataFrame:
    """The classes once all that are similar among the members of each bucket are joined.

    Two sets are similar if no more than a part of their sizes differs, (1 - s) / (1 + s) of
    their sum. Where both are written as differences from the same core, what differs between
    them is the differences of both without, twice, those in common. So with ``delta``, the
    differences less that part of the size, two are similar exactly if the sum of their deltas
    is at most twice the number of differences that they have in common: none need be in
    common up to a sum of 0, and such two are both similar to the member with the least delta.
    """
    views = _views(staged(_groups(members), "groups"), hashed, similarity)
    classes = _merged(classes, _compared(_nearest(views, classes), hashed, similarity))
    pairs = staged(_differing(views, classes).distinct(), "candidate-pairs")
    rounds = max(1, math.ceil(pairs.count() / ROUND))
    for number in range(rounds):
        a, b = (classes.select(F.col("node").alias(c), F.col("class").alias(f"class_{c}")) for c in "ab")
        now = pairs.filter(F.pmod(F.xxhash64("a", "b"), F.lit(rounds)) == number)
        now = now.join(a, "a").join(b, "b").filter("class_a != class_b").select("a", "b")
        classes = _merged(classes, _compared(now, hashed, similarity))
    return classes


def linked(members: DataFrame, classes: DataFrame, hashed: DataFrame, similarity: float) -> DataFrame:
    """(node, first, weight, class) of all candidates, from their memberships (node, key)."""
    members = members.select("node", "key")
    met = _star(members, classes)
    pairs = met.select(F.least("centre", "node").alias("a"), F.greatest("centre", "node").alias("b"))
    classes = _merged(classes, _compared(pairs, hashed, similarity))
    members = _able(members, classes, hashed, similarity)
    open_ = _left_over(members, classes)
    little = (F.col("n") <= SMALL) | (F.col("others") <= FEW)
    classes = _merged(classes, _compared(_within(open_.filter(little)), hashed, similarity))
    rest = open_.filter(~little).select("node", "key")
    return classes if rest.isEmpty() else _apart(rest, classes, hashed, similarity)


def _digest(words: Column) -> Column:
    return F.unhex(F.sha2(F.array_join(words, " "), 256))


def duplicate_classes(documents: DataFrame, similarity: float = SIMILARITY) -> DataFrame:
    """(doc_id, class_id), one row per document."""
    docs = texts(documents)
    split = docs.filter("doc_id IS NOT NULL").select("doc_id", words(F.col("text")).alias("words"))
    sketched = split.select(
        "doc_id",
        _digest(F.col("words")).alias("digest"),
        band_udf(word_hashes(F.col("words"))).alias("bands"),
    )
    sketched = staged(sketched, "sketches")
    # A node is a distinct text.
    reps = sketched.groupBy("digest").agg(F.min("doc_id").alias("first"), F.first("bands").alias("bands"))
    reps = staged(reps.withColumn("node", F.monotonically_increasing_id()), "representatives")
    banded = reps.select("node", F.posexplode_outer("bands").alias("band", "hash")).filter(F.col("hash").isNotNull())
    keyed = banded.select("node", F.xxhash64("band", "hash").alias("key"))
    shared = keyed.groupBy("key").agg(F.count(F.lit(1)).alias("n")).filter("n > 1")
    members = staged(keyed.join(shared, "key"), "members")
    weights = members.groupBy("node").agg(F.sum("n").alias("weight"))
    members = members.drop("n")
    classes = reps.join(weights, "node").select(
        "node", "first", "weight", F.col("node").alias("class"), "digest"
    )
    classes = staged(classes, "candidates")
    wanted = classes.select(F.col("first").alias("doc_id"), "node", "digest")
    near = may_hold(docs.filter("doc_id IS NOT NULL"), wanted)
    found = near.join(wanted, "doc_id").withColumn("words", words(F.col("text")))
    found = found.filter(_digest(F.col("words")) == F.col("digest"))
    # Repeated rows of an id go while they are word hashes, which pack better than elements.
    found = found.select("doc_id", "node", word_hashes(F.col("words")).alias("hashes")).dropDuplicates(["doc_id", "node"])
    hashed = staged(found.select("node", elements_udf("hashes").alias("elements")), "shingled")
    classes = linked(members, classes.drop("digest"), hashed, similarity)
    smallest = classes.groupBy("class").agg(F.min("first").alias("class_id"))
    named = classes.join(smallest, "class").select("node", "class_id")
    known = reps.join(named, "node", "left").select("digest", F.coalesce("class_id", "first").alias("class_id"))
    placed = sketched.select("doc_id", "digest").join(known, "digest").select("doc_id", "class_id")
    nameless = docs.filter("doc_id IS NULL").select(
        "doc_id", F.lit(None).cast("bigint").alias("class_id")
    )
    return placed.unionAll(nameless)


def keep_one(documents: DataFrame, similarity: float = SIMILARITY) -> DataFrame:
    """The documents with the smallest id of their class, with all their columns.

    Rows without an id are kept; of rows that share an id, one stays.
    """
    classes = staged(duplicate_classes(documents, similarity), "kept")
    first = classes.filter("doc_id = class_id").select(F.col("doc_id").alias("kept_id")).distinct()
    kept = documents.join(first, documents.doc_id == first.kept_id, "left_semi")
    return kept.dropDuplicates(["doc_id"]).unionByName(documents.filter("doc_id IS NULL"))
