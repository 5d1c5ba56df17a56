"""Near-duplicate detection with SetSketch registers.

A document's set holds the distinct runs of five words; a text of fewer words
has its whole word sequence as the one member, a text without words none. Sets
are handled as sorted 64-bit member hashes throughout.

A sketch has 512 registers: the minimum of exponential values over the set,
kept as floor(1 - log_b(minimum)) and truncated to 16 bits. Registers of a
union are the larger ones of the parts, so sketches merge. Four registers in a
row are a band, the first 128 make 32 bands; sets that share a band value meet in
a bucket. At a similarity of 0.75 all bands differ with a probability below 6e-6.

Only connectivity is asked for, so pairs whose ends are connected already are not
compared. In each round every bucket that still holds several components picks
members as pivots, those of its smallest components first, and compares them with
members of other components. In the first rounds a member proposes only the pivot of the
group that looks most like it, and a pivot keeps only the members of a component that look
most like it: one link is enough. In the later rounds all pairs of a pivot are proposed, and
then the pivots leave the bucket. The number of pivots is multiplied from round to round up
to MOST_PIVOTS, and a bucket ends when it holds one component, so every pair of a bucket is
decided. A bucket is dealt out in groups of a block of at most BLOCK pivots and a chunk of
about CHUNK members; two pivots meet in one of these groups only. A pair is looked at in one
bucket only, that of the first band on which its sketches agree. There it must pass a
likelihood test on the joint distribution of the registers (larger, smaller, equal), and
only then are the two full sets intersected. In the first rounds pairs are few and are joined
with their sets; those that failed are remembered and not intersected again there. In the
later rounds a large group of texts just below the threshold has pairs as the square of its
size, so no pair becomes a row: the members that have a likely partner get their set, the
group is dealt out once more, and a task intersects the sets of a group and returns the links
that join its components, fewer than the group has members.

The bands and the likelihood test miss a link right at the threshold about once in 10**5.
With exact=True nothing is missed: the buckets are then the rarest n - ceil(0.75 n) + 1
members of each set, of which two linked sets share one, and the test is left out.

Defined results: null and empty texts have n_shingles 0 and stand alone. Rows
of equal sets are one class and are compared once. Rows that repeat an id are
judged by their own text each. Texts are read whole; memory is bounded by a slice of them
or the longest one. A table without rows gives no rows. Rows without an id take part; a component
without any id has a null component_id. Further columns are ignored.
"""

from __future__ import annotations

import hashlib
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from marlspike.llm.common import ascii_words, hash_strings, mix, returning, slices
from marlspike.llm.components import components
from marlspike.session import materialize

WORDS = 5
REGISTERS, BAND, BANDS = 512, 4, 32
BASE, RATE, TOP = 1.02, 20.0, 2**16 - 1
EARLY_BANDS = 8  # the first round looks at these alone: most links show there
#: Of the first rounds: pivots of a bucket, and pivots that a member proposes and members
#: of a component that a pivot keeps (0: all); later rounds have 16 times the pivots, up to
#: MOST_PIVOTS, and propose all.
ROUNDS = [(4, 1), (64, 1), (64, 0)]
MOST_PIVOTS = 16384
CHUNK, BLOCK = 2000, 1024
GROUP = ["bucket", "block", "chunk"]
SLICE = 1_000_000  # bytes of text whose words are held at once
FLAG_BITS = 20  # of a member's hash, for a first look at what two sets have in common
SALTS, RANKED = 32, 4096  # larger buckets are ranked in parts, of which each gives its share
#: Log-likelihood by which a pair must fall short of the best estimate to be
#: passed over unverified: a pair right at the threshold does so about once in 10**5.
MARGIN = 9.0

_rng = np.random.default_rng(7)
_FACTOR = _rng.integers(0, 2**31, REGISTERS, dtype=np.uint32) * np.uint32(2) + np.uint32(1)
_PLACE = _rng.integers(0, 2**63, WORDS, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def shingle_sets(texts: pa.Array, words: int = WORDS):
    """Yields each text's set as sorted distinct 64-bit hashes."""
    offsets, flat = ascii_words(texts)
    coded = flat.dictionary_encode()
    hashes = hash_strings(coded.dictionary)[coded.indices.to_numpy()]
    runs = max(0, len(hashes) - words + 1)
    rolled = np.zeros(runs, np.uint64)
    for i in range(words):
        rolled += hashes[i : i + runs] * _PLACE[i % WORDS]
    rolled = mix(rolled)
    for start, end in zip(offsets[:-1], offsets[1:]):
        if end - start >= words:
            yield np.unique(rolled[start : end - words + 1])
        elif end > start:
            text = b" ".join(x.as_py().encode() for x in flat[start:end])
            digest = hashlib.blake2b(text, digest_size=8, person=b"short").digest()
            yield np.frombuffer(digest, np.uint64).copy()
        else:
            yield np.zeros(0, np.uint64)


def registers(members: np.ndarray) -> np.ndarray:
    """The sketch of a set that has members."""
    short = (members >> np.uint64(32)).astype(np.uint32)
    least = np.full(REGISTERS, 2**32 - 1, np.uint32)
    for start in range(0, len(short), 256):
        block = short[start : start + 256, None] * _FACTOR  # each an order of all 32-bit values
        np.minimum(least, block.min(axis=0), out=least)
    uniform = (least.astype(np.float64) + 0.5) / 2.0**32
    value = -np.log1p(-np.minimum(uniform, 1 - 2.0**-53)) / RATE
    return np.clip(np.floor(1 - np.log(value) / np.log(BASE)), 0, TOP).astype(np.uint16)


def likely(one: np.ndarray, two: np.ndarray, size_one, size_two, least: float) -> np.ndarray:
    """Whether a similarity of at least `least` is plausible, for rows of registers.

    The similarity is estimated by maximum likelihood from the numbers of larger,
    smaller and equal registers, given the sizes of both sets.
    """
    above = (one > two).sum(axis=1)[:, None]
    below = (one < two).sum(axis=1)[:, None]
    equal = one.shape[1] - above - below
    total = (size_one + size_two).astype(float)
    u, v = (size_one / total)[:, None], (size_two / total)[:, None]
    grid = np.linspace(0, 1, 201)[None, :]

    def share(x):
        x = np.clip(x, 0, 1)
        return -np.log1p(-x * (BASE - 1) / BASE) / np.log(BASE)

    more, less = share(u - v * grid), share(v - u * grid)
    same = np.maximum(1 - more - less, 1e-12)
    log = above * np.log(np.maximum(more, 1e-12)) + below * np.log(np.maximum(less, 1e-12))
    log = log + equal * np.log(same)
    possible = grid <= np.minimum(u / v, v / u) + 1e-9
    log = np.where(possible, log, -np.inf)
    high = np.where(grid >= least - 1e-9, log, -np.inf).max(axis=1)
    return high >= log.max(axis=1) - MARGIN


def _row_digests(words: int):
    def run(batches):
        for batch in batches:
            for part in slices(batch, "text", SLICE):
                sizes, digests, sketches = [], [], []
                for members in shingle_sets(part.column("text"), words):
                    sizes.append(len(members))
                    digests.append(hashlib.sha256(members.tobytes()).digest()[:16])
                    sketches.append(registers(members).tobytes() if len(members) else None)
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column("doc"),
                        pa.array(sizes, pa.int64()),
                        pa.array(digests, pa.binary()),
                        pa.array(sketches, pa.binary()),
                    ],
                    ["doc", "n", "cls", "sketch"],
                )

    return run


def _sets(words: int):
    def run(batches):
        for batch in batches:
            for part in slices(batch, "text", SLICE):
                wanted = part.column("cls").to_pylist()
                nodes = part.column("node").to_pylist()
                out = [
                    (node, members.tobytes())
                    for node, cls, members in zip(nodes, wanted, shingle_sets(part.column("text"), words))
                    if hashlib.sha256(members.tobytes()).digest()[:16] == cls
                ]
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([x[0] for x in out], pa.int64()),
                        pa.array([x[1] for x in out], pa.binary()),
                    ],
                    ["node", "members"],
                )

    return run


def group_pairs(pivot, same, node, label, size, band, sketch, percent: int, most: int):
    """The places of a group's pairs of a pivot and a member that need verification; same: of
    the members, those that are pivots of this block too. `most`, if not 0: of a member the
    pivots, then of a pivot and a component the members with the most equal registers.
    A band below 0 stands for a bucket of the exact way: no test on the sketches."""
    one, two = np.flatnonzero(pivot), np.flatnonzero(~pivot)
    p, m = np.nonzero(
        (label[one][:, None] != label[two][None, :])
        & (~same[two][None, :] | (node[one][:, None] < node[two][None, :]))
    )
    p, m = one[p], two[m]
    low, high = np.minimum(size[p], size[m]), np.maximum(size[p], size[m])
    fits = 100 * low >= percent * high
    p, m = p[fits], m[fits]
    out = []
    for start in range(0, len(p), 10_000):
        x, y = p[start : start + 10_000], m[start : start + 10_000]
        if band >= 0:
            head = sketch[x, : BANDS * BAND] == sketch[y, : BANDS * BAND]
            first = head.reshape(len(x), BANDS, BAND).all(axis=2).argmax(axis=1) == band
            x, y = x[first], y[first]
        alike = (sketch[x] == sketch[y]).sum(axis=1)
        if band >= 0:
            # equal registers are about as many as the similarity says; this far below
            # the threshold (ten standard deviations) the likelihood need not be asked
            close = alike >= REGISTERS * (percent / 100 - 0.2)
            x, y, alike = x[close], y[close], alike[close]
            good = likely(sketch[x], sketch[y], size[x], size[y], percent / 100) if len(x) else np.zeros(0, bool)
            x, y, alike = x[good], y[good], alike[good]
        out.append(np.stack([x, y, alike], axis=1))
    if not out:
        return np.zeros((0, 2), np.int64)
    x, y, alike = np.concatenate(out).T
    if most:
        own = _best([y], alike, node[x], most)
        x, y, alike = x[own], y[own], alike[own]
        own = _best([x, label[y]], alike, node[y], most)
        x, y = x[own], y[own]
    return np.stack([x, y], axis=1)


def _best(group: list[np.ndarray], alike: np.ndarray, node: np.ndarray, most: int) -> np.ndarray:
    """The places of the `most` rows of each group with the most equal registers."""
    order = np.lexsort((node, -alike, *group))
    new = np.zeros(len(order), bool)
    new[:1] = True
    for column in group:
        new[1:] |= np.diff(column[order]) != 0
    place = np.arange(len(order))
    return order[place - np.maximum.accumulate(np.where(new, place, 0)) < most]


def _whole_groups(batches):
    """Rows of groups, one group after the other, as (table, edges): group i has the rows
    from edges[i] to edges[i + 1]."""
    waiting = None
    for batch in chain(batches, [None]):
        if batch is not None:
            table = pa.Table.from_batches([batch])
            waiting = table if waiting is None else pa.concat_tables([waiting, table])
        if waiting is None or not waiting.num_rows:
            continue
        held = [waiting.column(c).to_numpy() for c in GROUP]
        new = np.any([np.diff(x) != 0 for x in held], axis=0)
        edges = np.concatenate([[0], np.flatnonzero(new) + 1, [waiting.num_rows]])
        if batch is not None:
            edges = edges[:-1]  # the last group may go on in the next batch
        yield waiting.slice(0, int(edges[-1])), edges
        waiting = waiting.slice(int(edges[-1]))


def _likely_places(table: pa.Table, edges: np.ndarray, percent: int, most: int):
    """Yields for each group the places in the table of its pairs that need verification."""
    names = ("block", "pivot", "own_block", "node", "label", "n", "band")
    held = {c: table.column(c).to_numpy() for c in names}
    sketch = np.frombuffer(b"".join(table.column("sketch").to_pylist()), np.uint16).reshape(-1, REGISTERS)
    for lo, hi in zip(edges[:-1], edges[1:]):
        part = slice(lo, hi)
        yield lo + group_pairs(
            held["pivot"][part] == 0, held["own_block"][part] == held["block"][part],
            held["node"][part], held["label"][part], held["n"][part], held["band"][lo],
            sketch[part], percent, most,
        )


def _chunk_pairs(percent: int, most: int):
    """Rows of groups to the pairs to verify."""

    def run(batches):
        for table, edges in _whole_groups(batches):
            node = table.column("node").to_numpy()
            pairs = np.concatenate([np.zeros((0, 2), np.int64), *_likely_places(table, edges, percent, most)])
            yield pa.RecordBatch.from_arrays([pa.array(node[pairs[:, 0]]), pa.array(node[pairs[:, 1]])], ["a", "b"])

    return run


def _partnered(percent: int):
    """Rows of groups to those of them that are in a pair to verify."""

    def run(batches):
        for table, edges in _whole_groups(batches):
            wanted = np.zeros(table.num_rows, bool)
            for pairs in _likely_places(table, edges, percent, 0):
                wanted[pairs.ravel()] = True
            yield from table.filter(pa.array(wanted)).to_batches()

    return run


def joining_links(pairs: np.ndarray, label: np.ndarray, sets: list[np.ndarray], percent: int) -> list[tuple[int, int]]:
    """Of the pairs (places of a pivot and a member) linked ones that join the same
    components as all linked ones do, without a circle."""
    parent: dict[int, int] = {}

    def root(x):
        while (up := parent.setdefault(x, x)) != x:
            parent[x] = x = parent[up]
        return x

    out = []
    if not len(pairs):
        return out
    flags = np.zeros(2**FLAG_BITS, bool)
    shift = np.uint64(64 - FLAG_BITS)
    pairs = pairs[np.argsort(pairs[:, 0], kind="stable")]
    for own in np.split(pairs, np.flatnonzero(np.diff(pairs[:, 0])) + 1):
        x = int(own[0, 0])
        for start in range(0, len(own), 256):
            rest = [y for y in own[start : start + 256, 1].tolist() if root(label[y]) != root(label[x])]
            if not rest:
                continue
            flags[sets[x] >> shift] = True
            sizes = np.array([len(sets[y]) for y in rest])
            seen = flags[np.concatenate([sets[y] for y in rest]) >> shift]
            flags[sets[x] >> shift] = False
            # members that look common are at least those that are: who fails so, fails
            most = np.add.reduceat(seen, np.cumsum(sizes) - sizes, dtype=np.int64)
            for y in np.array(rest)[100 * most >= percent * (len(sets[x]) + sizes - most)].tolist():
                if root(label[x]) != root(label[y]) and _similar(sets[x], sets[y], percent):
                    parent[root(label[y])] = root(label[x])
                    out.append((x, y))
    return out


def _group_links(percent: int):
    """Rows of groups, with their sets, to links."""

    def run(batches):
        for table, edges in _whole_groups(batches):
            node, label = table.column("node").to_numpy(), table.column("label").to_numpy().tolist()
            sets = [np.frombuffer(x.as_buffer(), np.uint64) for x in table.column("members")]
            found = []
            for pairs in _likely_places(table, edges, percent, 0):
                found += joining_links(pairs, label, sets, percent)
            links = np.array(found, np.int64).reshape(-1, 2)
            yield pa.RecordBatch.from_arrays([pa.array(node[links[:, 0]]), pa.array(node[links[:, 1]])], ["a", "b"])

    return run


def _similar(one: np.ndarray, two: np.ndarray, percent: int) -> bool:
    common = len(np.intersect1d(one, two, assume_unique=True))
    return 100 * common >= percent * (len(one) + len(two) - common)


def _confirm(percent: int):
    def run(batches):
        for batch in batches:
            linked = []
            for x, y in zip(batch.column("set_a"), batch.column("set_b")):
                one, two = (np.frombuffer(s.as_buffer(), np.uint64) for s in (x, y))
                linked.append(_similar(one, two, percent))
            yield pa.RecordBatch.from_arrays(
                [batch.column("a"), batch.column("b"), pa.array(linked, pa.bool_())], ["a", "b", "linked"]
            )

    return run


def open_rows(members: DataFrame, labels: DataFrame | None) -> DataFrame:
    """Members (bucket, band, node) of buckets that hold several components, with their
    label, `own`, the members of that component in the bucket, and the bucket's size."""
    if labels is None:
        held = members.withColumn("label", F.col("node"))
    else:
        held = members.join(labels, "node", "left").select(
            "bucket", "band", "node", F.coalesce("label", "node").alias("label")
        )
    parts = held.groupBy("bucket", "label").agg(F.count(F.lit(1)).alias("own"))
    whole = parts.groupBy("bucket").agg(F.sum("own").alias("size"), F.count(F.lit(1)).alias("labels"))
    several = whole.filter("labels > 1").select("bucket", "size")
    return held.join(parts.join(several, "bucket"), ["bucket", "label"])


def _shares(pivots: int) -> tuple[Column, Column, Column]:
    """Of a bucket of `size` members: the parts it is ranked in, the pivots that each part
    gives, and those of them that go into one block."""
    parts = F.least(F.ceil(F.col("size") / RANKED), F.lit(min(SALTS, pivots)))
    each = F.least(F.floor(pivots / parts), F.col("size"))
    return parts, each, F.greatest(F.floor(BLOCK / parts), F.lit(1))


def choose_pivots(rows: DataFrame, pivots: int) -> DataFrame:
    """The rows of at most `pivots` members of each bucket, those of its smallest components
    first, with the block that they are in. A large bucket is ranked in up to SALTS parts,
    each of which gives its share, so no task ranks a bucket."""
    parts, each, block = _shares(pivots)
    part = Window.partitionBy("bucket", "salt").orderBy("own", "node")
    return (
        rows.withColumn("salt", F.pmod(F.xxhash64("node", F.lit(5)), parts))
        .withColumn("place", F.row_number().over(part))
        .filter(F.col("place") <= pivots)
        .filter(F.col("place") <= each)
        .withColumn("own_block", F.floor((F.col("place") - 1) / block).cast("int"))
        .drop("place", "salt")
    )


def deal(rows: DataFrame, chosen: DataFrame, pivots: int) -> DataFrame:
    """(bucket, block, chunk, pivot, own_block, node, label, band): groups of a block of
    the chosen (pivot 0) and a chunk of members (pivot 1). Of two chosen, the one of the
    later block is the member, so they meet in one group."""
    chunks = F.ceil(F.col("size") / CHUNK).cast("int")
    _, each, block = _shares(pivots)
    blocks = F.ceil(each / block).cast("int")
    names = ["bucket", "block", "chunk", "pivot", "own_block", "node", "label", "band"]
    picked = (
        chosen.withColumn("block", F.col("own_block"))
        .withColumn("chunk", F.explode(F.sequence(F.lit(0), chunks - 1)))
        .withColumn("pivot", F.lit(0))
    )
    every = (
        rows.join(chosen.select("bucket", "node", "own_block"), ["bucket", "node"], "left")
        .withColumn("last", F.coalesce("own_block", blocks - 1))
        .withColumn("own_block", F.coalesce("own_block", F.lit(-1)))
        .withColumn("block", F.explode(F.sequence(F.lit(0), F.col("last"))))
        .withColumn("chunk", F.pmod(F.xxhash64("node"), chunks).cast("int"))
        .withColumn("pivot", F.lit(1))
    )
    return picked.select(names).unionByName(every.select(names))


def in_groups(rows: DataFrame) -> DataFrame:
    """rows with each group in one partition, one group after the other."""
    return rows.repartition(*GROUP).sortWithinPartitions(*GROUP, "pivot")


def dealt_rows(rows: DataFrame, chosen: DataFrame, pivots: int, classes: DataFrame) -> DataFrame:
    dealt = in_groups(deal(rows, chosen, pivots).join(classes.select("node", "n", "sketch"), "node"))
    return dealt.select(*GROUP, "pivot", "own_block", "node", "label", "band", "n", "sketch")


def likely_pairs(
    rows: DataFrame, chosen: DataFrame, pivots: int, classes: DataFrame, percent: int, most: int
) -> DataFrame:
    """Pairs (a, b) of a chosen member and another of its bucket, of different
    components, whose sketches allow for the similarity."""
    dealt = dealt_rows(rows, chosen, pivots, classes)
    return dealt.mapInArrow(returning(_chunk_pairs(percent, most)), "a long, b long").distinct()


def bucket_links(
    rows: DataFrame, chosen: DataFrame, pivots: int, classes: DataFrame, sets: DataFrame, percent: int
) -> DataFrame:
    """Links (a, b) that join what all links of a chosen member and another of its bucket
    join. Sets move once for each member of a group, not for each pair."""
    dealt = dealt_rows(rows, chosen, pivots, classes)
    partnered = dealt.mapInArrow(returning(_partnered(percent)), dealt.schema)
    return in_groups(partnered.join(sets, "node")).mapInArrow(returning(_group_links(percent)), "a long, b long")


def merge_labels(labels: DataFrame | None, links: DataFrame) -> DataFrame:
    """labels (node, label) after the links (a, b) join their components."""
    if labels is None:
        return components(links)
    ends = links.select(F.col("a").alias("node")).union(links.select("b")).distinct()
    known = materialize(
        labels.join(ends, "node", "full").select("node", F.coalesce("label", "node").alias("label")),
        "known",
    )
    one = known.select(F.col("node").alias("a"), F.col("label").alias("x"))
    two = known.select(F.col("node").alias("b"), F.col("label").alias("y"))
    between = links.join(one, "a").join(two, "b").select(F.col("x").alias("a"), F.col("y").alias("b"))
    joined = components(between).select(F.col("node").alias("label"), F.col("label").alias("to"))
    return materialize(
        known.join(joined, "label", "left").select("node", F.coalesce("to", "label").alias("label")),
        "labels",
    )


def bands(classes: DataFrame) -> DataFrame:
    """(node, band, bucket) of each class by the bands of its sketch."""
    values = [F.xxhash64(F.lit(i), F.substring("sketch", 2 * BAND * i + 1, 2 * BAND)) for i in range(BANDS)]
    return classes.select("node", F.posexplode(F.array(*values)).alias("band", "bucket"))


def rare_members(source: DataFrame, classes: DataFrame, percent: int, words: int) -> DataFrame:
    """(node, band, bucket) of each class by the members of its set that the fewest sets
    hold, as many as make two linked sets share one. The band is -1."""
    sets = materialize(full_sets(source, classes.select("node", "cls", "doc"), words), "whole")
    flat = materialize(sets.mapInArrow(returning(_members), "node long, n long, bucket long"), "flat")
    often = flat.groupBy("bucket").agg(F.count(F.lit(1)).alias("c")).filter("c > 1")
    place = F.row_number().over(Window.partitionBy("node").orderBy("c", "bucket"))
    # members of one set only meet nothing and come first in the order
    held = flat.join(often, "bucket", "left").withColumn("c", F.coalesce("c", F.lit(1).cast("long")))
    most = F.col("n") - F.ceil(F.col("n") * percent / 100) + 1
    rare = held.withColumn("place", place).filter(F.col("place") <= most).filter("c > 1")
    return rare.select("node", F.lit(-1).alias("band"), "bucket")


def _members(batches):
    for batch in batches:
        for node, members in zip(batch.column("node").to_pylist(), batch.column("members")):
            own = np.frombuffer(members.as_buffer(), np.uint64).view(np.int64)
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.full(len(own), node)), pa.array(np.full(len(own), len(own))), pa.array(own)],
                ["node", "n", "bucket"],
            )


def full_sets(source: DataFrame, wanted: DataFrame, words: int) -> DataFrame:
    """(node, members) of the wanted classes (node, cls, doc), from the texts of source."""
    holds = wanted.withColumnRenamed("doc", "own")
    texts = source.join(holds, F.col("doc").eqNullSafe(F.col("own"))).select("node", "cls", "text")
    return texts.mapInArrow(returning(_sets(words)), "node long, members binary").dropDuplicates(["node"])


def near_classes(
    docs: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    percent: int = 75,
    words: int = WORDS,
    exact: bool = False,
) -> DataFrame:
    """(doc, n, component) for each row of docs; exact: see above."""
    source = docs.select(F.col(key).alias("doc"), F.col(text).alias("text"))
    rows = materialize(
        source.mapInArrow(returning(_row_digests(words)), "doc long, n long, cls binary, sketch binary"),
        "sketches",
    )
    classes = materialize(
        rows.filter("n > 0")
        .groupBy("cls")
        .agg(F.min("doc").alias("doc"), F.min("n").alias("n"), F.min("sketch").alias("sketch"))
        .withColumn("node", F.monotonically_increasing_id()),
        "classes",
    )
    shared = rare_members(source, classes, percent, words) if exact else bands(classes)
    met = shared.groupBy("bucket").agg(F.count(F.lit(1)).alias("size")).filter("size > 1")
    members = materialize(shared.join(met.select("bucket"), "bucket").select("bucket", "band", "node"), "members")

    active = members.select("node").distinct().join(classes, "node").select("node", "cls", "doc")
    sets = materialize(full_sets(source, active, words), "sets")

    labels, failed, ahead = None, None, list(ROUNDS)
    rest = members.filter(F.col("band") < EARLY_BANDS)
    late = members.filter(F.col("band") >= EARLY_BANDS)
    while True:
        first = len(ahead) == len(ROUNDS)
        undecided = materialize(open_rows(rest, labels), "open")
        if undecided.isEmpty() and not first:
            break
        pivots, most = ahead.pop(0)
        if not ahead:
            ahead.append((min(16 * pivots, MOST_PIVOTS), 0))
        chosen = materialize(choose_pivots(undecided, pivots), "pivots")
        if most:
            pairs = likely_pairs(undecided, chosen, pivots, classes, percent, most)
            if failed is not None:
                pairs = pairs.join(failed, ["a", "b"], "left_anti")
            tested = materialize(verified(pairs, sets, percent), "tested")
            links, bad = tested.filter("linked").select("a", "b"), tested.filter("not linked").select("a", "b")
            failed = bad if failed is None else failed.unionByName(bad)
        else:
            links = materialize(bucket_links(undecided, chosen, pivots, classes, sets, percent), "links")
        if not links.isEmpty():
            labels = merge_labels(labels, links)
        rest = undecided.select("bucket", "band", "node")
        if not most:
            rest = rest.join(chosen.select("bucket", "node"), ["bucket", "node"], "left_anti")
        if first:
            rest = rest.unionByName(late)
    if labels is None:
        labels = classes.select("node", F.col("node").alias("label"))
    named = classes.join(labels, "node", "left").select(
        "cls", "doc", F.coalesce("label", "node").alias("label")
    )
    least = named.groupBy("label").agg(F.min("doc").alias("component"))
    final = named.join(least, "label").select("cls", "component")
    alone = rows.filter("n = 0").select("doc", "n", F.col("doc").alias("component"))
    return (
        rows.filter("n > 0").join(final, "cls").select("doc", "n", "component").unionByName(alone)
    )


def verified(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) with whether their full sets reach the similarity (linked)."""
    for side in ("a", "b"):
        own = sets.select(F.col("node").alias(side), F.col("members").alias(f"set_{side}"))
        pairs = pairs.join(own, side)
    return pairs.select("a", "b", "set_a", "set_b").mapInArrow(returning(_confirm(percent)), "a long, b long, linked boolean")


def keep_one(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """docs, all columns, with one document of each component: the smallest id.

    An id that stands on several rows stays if one of its texts stays."""
    found = near_classes(docs, key, text)
    kept = found.filter(F.col("doc").eqNullSafe(F.col("component"))).select(F.col("doc").alias("kept"))
    return docs.join(kept, docs[key].eqNullSafe(kept["kept"]), "left_semi")


def op8_near_dedup(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return near_classes(docs).select(
        F.col("doc").alias("doc_id"),
        F.col("n").alias("n_shingles"),
        F.col("component").alias("component_id"),
        F.col("doc").eqNullSafe(F.col("component")).alias("kept"),
    )


SQL = r"""
WITH d AS (
  SELECT doc_id, list_filter(string_split_regex(
      translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
      '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w
  FROM documents),
s AS (
  SELECT doc_id, CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 5 THEN [array_to_string(w, ' ')]
    ELSE list_distinct(list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' '))) END AS g
  FROM d),
n AS (SELECT doc_id, len(g)::BIGINT AS n FROM s),
e AS (SELECT doc_id, unnest(g) AS x FROM s),
-- an exact prefix filter: two sets of at least 75 % overlap share one of the rarest n - ceil(0.75 n) + 1
f AS (SELECT x, count(*) AS c FROM e GROUP BY x),
r AS (
  SELECT e.doc_id, e.x, n.n, row_number() OVER (PARTITION BY e.doc_id ORDER BY f.c, e.x) AS p
  FROM e JOIN f USING (x) JOIN n USING (doc_id)),
k AS (SELECT doc_id, x, n FROM r WHERE p <= n - CAST(ceil(0.75 * n) AS BIGINT) + 1),
c AS (
  SELECT DISTINCT a.doc_id AS a, b.doc_id AS b, a.n AS na, b.n AS nb
  FROM k a JOIN k b ON a.x = b.x AND a.doc_id < b.doc_id
  WHERE 100 * least(a.n, b.n) >= 75 * greatest(a.n, b.n)),
l AS (
  SELECT c.a, c.b FROM c JOIN s x ON x.doc_id = c.a JOIN s y ON y.doc_id = c.b
  WHERE 100 * len(list_intersect(x.g, y.g)) >= 75 * (na + nb - len(list_intersect(x.g, y.g)))),
t AS (
  WITH RECURSIVE reach(doc_id, low) USING KEY (doc_id) AS (
    SELECT doc_id, doc_id FROM n
    UNION
    SELECT q.b, min(q.low) FROM (
      SELECT l.b AS b, reach.low AS low FROM reach JOIN l ON l.a = reach.doc_id
      UNION ALL SELECT l.a, reach.low FROM reach JOIN l ON l.b = reach.doc_id) q
    JOIN recurring.reach o ON o.doc_id = q.b WHERE q.low < o.low GROUP BY q.b)
  SELECT doc_id, low FROM reach)
SELECT n.doc_id, n.n AS n_shingles, t.low AS component_id, n.doc_id = t.low AS kept
FROM n JOIN t USING (doc_id)
"""

QUERIES = {"op8_near_dedup": (op8_near_dedup, SQL)}
