"""SimHash near-duplicates through deletion-variant signatures.

A 64-bit fingerprint is cut into segments.  Of two fingerprints that differ in
fewer than twice as many bits as there are segments, one segment differs in at
most one bit: two segments of 32 bits do for three bits, four of 16 for seven.
So every distinct fingerprint is indexed under its segments as they are and under
every segment variant with one bit made a wildcard; an equality on such a key
brings together all candidates, and the full distance is verified.

Within the members of a key the links are verified as a search that leaves a
spanning forest, never all pairs.  A key with more than ``block`` members is cut
into blocks and every pair of blocks becomes a group of its own, so no task holds
an unbounded group and no link is lost.

``survivors`` keeps a link only if the sets of five-word shingles themselves have a
Jaccard similarity of ``SIMILAR`` or more.  Its candidates are the links of the
fingerprints of these shingles, and, as two texts at that similarity differ in about
ten bits and most have no link within three, those that share a band of min-hashes.

Defined results: null or blank text has fingerprint zero and links like any
other; for ``survivors`` all null and blank texts are copies of each other; rows with the same id or text each get a row; a very long
text is hashed whole, its fingerprint and bands as long as another's; an empty table gives an
empty result; columns other than ``doc_id`` and ``text`` are not read but pass
through ``survivors``.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import common

SEED = 42
FINGERPRINTS = pa.schema([("doc_id", pa.int64()), ("fp", pa.int64())])
LINKS = pa.schema([("a", pa.int64()), ("b", pa.int64())])
#: Tasks over which the links of one node are dealt.
SALTS = 8


def shingle_hashes(text: str | None, width: int) -> np.ndarray:
    """XXH64 of every run of ``width`` words; of all words where there are fewer."""
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return np.empty(0, dtype=np.uint64)
    line, ends = b" ".join(words), np.cumsum([len(w) + 1 for w in words]).tolist()
    if len(words) <= width:
        return np.array([xxhash.xxh64_intdigest(line, SEED)], dtype=np.uint64)
    starts, h = [0, *ends], xxhash.xxh64_intdigest
    return np.fromiter((h(line[a : b - 1], SEED) for a, b in zip(starts, ends[width - 1 :])), dtype=np.uint64, count=len(words) - width + 1)


def fingerprint(hashes: np.ndarray) -> int:
    """A bit is set if it is set in over half of the hashes; as a signed integer."""
    if not len(hashes):
        return 0
    counts = np.zeros(64, dtype=np.int64)
    for at in range(0, len(hashes), 1 << 16):
        part = hashes[at : at + (1 << 16)].astype(">u8").view(np.uint8).reshape(-1, 8)
        counts += np.unpackbits(part, axis=1).sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * counts > len(hashes)).view(">i8")[0])


def fingerprints(docs: DataFrame, width: int = 3) -> DataFrame:
    """One row (doc_id, fp) for each row of ``docs``."""
    common.on_workers(docs.sparkSession)

    def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in common.slices(batches):
            fps = [fingerprint(shingle_hashes(x.as_py(), width)) for x in batch.column(1)]
            yield from common.emit(FINGERPRINTS, [batch.column(0), fps])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).mapInArrow(of, "doc_id long, fp long")


def keyed(fps: DataFrame, segments: int) -> DataFrame:
    """(key, fp, side, whole): the segments as they are, and each with one bit as a wildcard (side: that bit)."""
    width = 64 // segments
    variants = []
    for s in range(segments):
        segment = F.shiftrightunsigned("fp", s * width).bitwiseAND(F.lit((1 << width) - 1))
        # a key holds the segment in its low 32 bits, then the variant's number
        number = s * (width + 1)
        variants.append(F.struct(segment.bitwiseOR(F.lit((number + width) << 32)).alias("key"), F.lit(0).alias("side"), F.lit(True).alias("whole")))
        for p in range(width):
            rest = segment.bitwiseAND(F.lit(((1 << width) - 1) ^ (1 << p)))
            side = F.shiftright(segment, p).bitwiseAND(F.lit(1)).cast("int")
            variants.append(F.struct(rest.bitwiseOR(F.lit((number + p) << 32)).alias("key"), side.alias("side"), F.lit(False).alias("whole")))
    return fps.select("fp", F.explode(F.array(*variants)).alias("v")).select("v.key", "v.side", "v.whole", "fp")


def spanning(fps: np.ndarray, distance: int) -> list[tuple[int, int]]:
    """Links of at most ``distance`` bits that join what all such links among ``fps`` join."""
    links, rest = [], fps
    while len(rest) > 1:
        todo, rest = [rest[0]], rest[1:]
        while todo and len(rest):
            x = todo.pop()
            near = np.bitwise_count(rest ^ x) <= distance
            if near.any():
                found = rest[near]
                links += [(int(x), int(y)) for y in found]
                todo += list(found)
                rest = rest[~near]
    return links


def links(fps: DataFrame, distance: int = 3, block: int = 256) -> DataFrame:
    """(a, b): links among distinct fingerprints that leave the same components as all links."""
    segments = next(m for m in (2, 4, 8) if distance < 2 * m)
    # a few bytes become many rows: more tasks than their size alone would get
    members = keyed(fps.repartition(int(fps.sparkSession.conf.get("spark.sql.shuffle.partitions")), "fp"), segments)
    # a wildcard key counts if both values of its bit occur: equal segments meet under the segment's own key
    shared = (
        members.groupBy("key").agg(F.count("*").alias("n"), F.min("side").alias("low"), F.max("side").alias("high"), F.first("whole").alias("whole"))
        .where((F.col("n") > 1) & (F.col("whole") | (F.col("low") < F.col("high")))).select("key", "n")
    )
    held = common.met(members, shared, "key").select("key", "fp", F.ceil(F.col("n") / block).cast("int").alias("blocks"))
    mine = F.pmod(F.xxhash64("fp"), F.col("blocks")).cast("int")
    dealt = held.select("key", "fp", mine.alias("mine"), F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("other"))
    grouped = dealt.select(F.xxhash64("key", F.least("mine", "other"), F.greatest("mine", "other")).alias("g"), "key", F.least("mine", "other").alias("i"), F.greatest("mine", "other").alias("j"), "fp")

    def verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        open_key, held = None, []
        out: list[tuple[int, int]] = []
        for batch in batches:
            keys = np.stack([batch.column(c).to_numpy().astype(np.int64) for c in range(3)], axis=1)
            fps = batch.column(3).to_numpy().view(np.uint64)
            cuts = [0, *(np.flatnonzero((keys[1:] != keys[:-1]).any(axis=1)) + 1).tolist(), len(fps)]
            for lo, hi in zip(cuts, cuts[1:]):
                if lo == hi:
                    continue
                key = tuple(keys[lo].tolist())
                if key != open_key:
                    if len(held):
                        out += spanning(np.concatenate(held), distance)
                    open_key, held = key, []
                held.append(fps[lo:hi])
            if len(out) > 10_000:
                yield from made(out)
                out = []
        if held:
            out += spanning(np.concatenate(held), distance)
        yield from made(out)

    def made(pairs: list[tuple[int, int]]) -> Iterator[pa.RecordBatch]:
        both = np.array(pairs, dtype=np.uint64).reshape(-1, 2).view(np.int64)
        yield from common.emit(LINKS, [both[:, 0], both[:, 1]])

    found = grouped.repartition("g").sortWithinPartitions("key", "i", "j").select("key", "i", "j", "fp").mapInArrow(verify, "a long, b long")
    return found.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()


def joined(rows: DataFrame, small: DataFrame, by: str, other: str) -> DataFrame:
    """rows.join(small, by), where the rows of one value are dealt over SALTS tasks by ``other``."""
    dealt = small.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    return common.met(rows.withColumn("salt", F.pmod(F.xxhash64(other), F.lit(SALTS)).cast("int")), dealt, [by, "salt"]).drop("salt")


def components(edges: DataFrame) -> DataFrame:
    """(node, root): the smallest node of each node's component, for the nodes that have links.

    Rounds of large-star and small-star steps: every round is two groupings and
    its state is a written table, so that lost executors cost one round at most.
    """
    def told(state: DataFrame) -> tuple:
        """Tells two sets of links apart."""
        return tuple(state.agg(F.count("*"), F.bit_xor(F.xxhash64("a", "b"))).first())

    edges = common.saved(edges.select("a", "b").where("a <> b"), "links")
    before = None
    while True:
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
        large = joined(both, least, "a", "b").where(F.col("b") > F.col("a")).select(F.col("b").alias("x"), F.col("m").alias("y"))
        large = large.where("x <> y").distinct()
        # now x > y: hang y and each x with the same larger end under their least
        down = large.groupBy("x").agg(F.min("y").alias("m"))
        small = joined(large, down, "x", "y").select(F.explode(F.array(F.struct("x", "m"), F.struct(F.col("y").alias("x"), "m"))).alias("e")).select(F.col("e.x").alias("a"), F.col("e.m").alias("b"))
        after = common.saved(small.where("a <> b").distinct(), "links")
        if (now := told(after)) == before:
            break
        edges, before = after, now
    tied = after.groupBy("a").agg(F.min("b").alias("root"))
    return tied.select(F.col("a").alias("node"), "root").unionByName(tied.select(F.col("root").alias("node"), "root").distinct())


def labelled(prints: DataFrame, distance: int) -> DataFrame:
    """(fp, component_id) for rows (doc_id, fp): the least doc_id reachable over links of at most ``distance`` bits."""
    distinct = common.saved(prints.groupBy("fp").agg(F.min("doc_id").alias("first")), "distinct")
    rooted = components(links(distinct.select("fp"), distance))
    labels = distinct.join(rooted.withColumnRenamed("node", "fp"), "fp", "left").select("fp", "first", F.coalesce("root", "fp").alias("root"))
    labels = common.saved(labels, "roots")
    least = labels.groupBy("root").agg(F.min("first").alias("component_id"))
    return labels.join(least, "root").select("fp", "component_id")


def near_duplicates(docs: DataFrame, width: int = 3, distance: int = 3) -> DataFrame:
    """(doc_id, fp, component_id) for each row, on runs of ``width`` words."""
    prints = common.saved(fingerprints(docs, width), "fingerprints")
    return prints.join(labelled(prints, distance), "fp", "left").select("doc_id", "fp", "component_id")


def op10(docs: DataFrame) -> DataFrame:
    found = near_duplicates(docs)
    return found.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


# ---- keeping one document of each group -----------------------------------------

#: Words of a shingle, and the similarity of the sets of shingles from which texts are near copies, as a fraction.
WIDTH, SIMILAR = 5, (4, 5)
#: A band is equal if so many min-hashes are; a pair with a similarity of 0.8 has no equal band once in 150,000.
BANDS, BAND_ROWS = 30, 5
FACTORS = np.random.default_rng(SEED).integers(0, 1 << 63, BANDS * BAND_ROWS, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
PRINTS = pa.schema([("_none", pa.bool_()), ("_id", pa.int64()), ("_th", pa.int64()), ("node", pa.int64()), ("fp", pa.int64()), ("bands", pa.list_(pa.int64()))])
#: Nodes of a band that are compared with each other at once.
BLOCK = 256
#: Bits in which the fingerprints of a candidate differ at most.
DISTANCE = 3
SETS = pa.schema([("node", pa.int64()), ("shingles", pa.binary())])


def shingle_set(text: str | None) -> np.ndarray:
    return np.unique(shingle_hashes(text, WIDTH))


def bands(hashes: np.ndarray) -> np.ndarray:
    """A hash of the min-hashes of every band; none for an empty set."""
    if not len(hashes):
        return np.empty(0, np.int64)
    least = np.full(len(FACTORS), np.uint64((1 << 64) - 1))
    for at in range(0, len(hashes), 256):
        np.minimum(least, (FACTORS[:, None] * hashes[None, at : at + 256]).min(axis=1), out=least)
    found = np.arange(1, BANDS + 1, dtype=np.uint64)
    for column in least.reshape(BANDS, BAND_ROWS).T:
        found = (found ^ column) * np.uint64(0xBF58476D1CE4E5B9)
        found ^= found >> np.uint64(29)
    return found.view(np.int64)


def banded(docs: DataFrame) -> DataFrame:
    """(_none, _id, _th, node, fp, bands) for each row; rows with the same set of shingles have the same node."""

    def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in common.slices(batches):
            sets = [shingle_set(t.as_py()) for t in batch.column(3)]
            nodes = np.array([xxhash.xxh64_intdigest(s.tobytes(), SEED) for s in sets], np.uint64).view(np.int64)
            yield from common.emit(PRINTS, [*batch.columns[:3], nodes, [fingerprint(s) for s in sets], [bands(s) for s in sets]])

    return keys(docs).select("_none", "_id", "_th", "text").mapInArrow(of, "_none boolean, _id long, _th long, node long, fp long, bands array<long>")


def sets_of(docs: DataFrame, chosen: DataFrame) -> DataFrame:
    """(node, shingles): the sorted hashes of the set of each node in ``chosen``, which has the keys of a row of it."""

    def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in common.slices(batches):
            yield from common.emit(SETS, [batch.column(0), [shingle_set(t.as_py()).tobytes() for t in batch.column(1)]])

    return rows_of(docs, chosen).select("node", "text").mapInArrow(of, "node long, shingles binary")


def similar(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """The pairs (a, b) whose sets have SIMILAR or more in common."""
    up, down = SIMILAR

    def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in common.slices(batches):
            keep = []
            for x, y in zip(batch.column(2), batch.column(3)):
                x, y = (np.frombuffer(v.as_buffer(), np.uint64) for v in (x, y))
                both = 0
                # sets of too different sizes cannot have as much in common
                if down * min(len(x), len(y)) >= up * max(len(x), len(y)):
                    both = len(np.intersect1d(x, y, assume_unique=True))
                keep.append(both > 0 and down * both >= up * (len(x) + len(y) - both))
            keep = pa.array(keep, pa.bool_())
            yield from common.emit(LINKS, [batch.column(0).filter(keep), batch.column(1).filter(keep)])

    met = pairs.join(sets.withColumnsRenamed({"node": "a", "shingles": "sa"}), "a").join(sets.withColumnsRenamed({"node": "b", "shingles": "sb"}), "b")
    return met.select("a", "b", "sa", "sb").mapInArrow(of, "a long, b long")


def near_prints(nodes: DataFrame) -> DataFrame:
    """Pairs (a, b) of nodes with near fingerprints: all of a fingerprint with its least node, and the least nodes of linked ones."""
    least = common.saved(nodes.groupBy("fp").agg(F.min("node").alias("least")), "distinct")
    same = nodes.select("fp", "node").join(least, "fp").where("node <> least").select(F.col("least").alias("a"), F.col("node").alias("b"))
    linked = links(least.select("fp"), DISTANCE)
    for end in "ab":
        linked = common.met(linked, least.withColumnsRenamed({"fp": end, "least": f"least_{end}"}), end)
    return same.unionByName(linked.select(F.least("least_a", "least_b").alias("a"), F.greatest("least_a", "least_b").alias("b")))


def copies(docs: DataFrame, nodes: DataFrame) -> DataFrame:
    """(node, root) for the nodes (node, first, fp, bands) that have links of SIMILAR or more to others.

    Nodes with near fingerprints meet, and in each band all nodes meet the one with
    the most company in all its bands, which of a text and its edited copies is the
    text.  In bands whose nodes are not all joined by then, blocks of nodes meet, and
    every pair is compared inside the tasks.  So every pair with an equal band is
    either joined or has been compared.
    """
    each = nodes.select("node", F.explode("bands").alias("band"))
    shared = each.groupBy("band").agg(F.count("*").alias("n")).where("n > 1")
    held = common.saved(joined(each, shared, "band", "node"), "bands")
    company = held.groupBy("node").agg(F.sum("n").alias("company"))
    held = common.saved(held.join(company, "node").select("band", "node", "company"), "bands")
    middle = held.groupBy("band").agg(F.max(F.struct("company", "node"))["node"].alias("middle"))
    stars = joined(held, middle, "band", "node").where("node <> middle").select(F.least("middle", "node").alias("a"), F.greatest("middle", "node").alias("b"))
    stars = common.saved(stars.unionByName(near_prints(nodes)).distinct(), "stars")
    met = stars.select(F.explode(F.array("a", "b")).alias("node")).distinct()
    sets = common.saved(sets_of(docs, common.met(nodes, met, "node", "left_semi").select("node", "first.*")), "sets")
    found = common.saved(similar(stars, sets), "links")
    rooted = components(found)
    at = common.saved(held.select("band", "node").join(rooted, "node", "left").select("band", "node", F.coalesce("root", "node").alias("root")), "rooted")
    apart = at.groupBy("band").agg(F.min("root").alias("low"), F.max("root").alias("high"), F.count("*").alias("n")).where("low < high").select("band", "n")
    more = common.saved(compared(joined(at, apart, "band", "node"), sets), "links")
    return rooted if more.isEmpty() else components(found.unionByName(more))


def compared(rows: DataFrame, sets: DataFrame) -> DataFrame:
    """(a, b): links of SIMILAR or more between nodes of a band, rows (band, node, root, n), that join what all of them join."""
    blocks = F.ceil(F.col("n") / BLOCK).cast("int")
    mine = F.pmod(F.xxhash64("node", "band"), blocks).cast("int")
    dealt = rows.join(sets, "node").select("band", "node", "root", "shingles", mine.alias("mine"), F.explode(F.sequence(F.lit(0), blocks - 1)).alias("other"))
    i, j = F.least("mine", "other").alias("i"), F.greatest("mine", "other").alias("j")
    columns = ("band", "i", "j", "node", "root", "shingles")

    def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, held = None, []
        for batch in common.slices(batches):
            for *key, node, root, shingles in zip(*(c.to_pylist() for c in batch.columns)):
                if key != now:
                    yield from common.emit(LINKS, list(zip(*forest(held))) or [[], []])
                    now, held = key, []
                held.append((node, root, np.frombuffer(shingles, np.uint64)))
        yield from common.emit(LINKS, list(zip(*forest(held))) or [[], []])

    dealt = dealt.select("band", i, j, "node", "root", "shingles")
    return dealt.repartition("band", "i", "j").sortWithinPartitions("band", "i", "j").select(*columns).mapInArrow(of, "a long, b long").distinct()


def forest(held: list[tuple[int, int, np.ndarray]]) -> list[tuple[int, int]]:
    """Links of SIMILAR or more among (node, root, set) that join the roots as all such links do."""
    if len(held) < 2:
        return []
    nodes, roots, sets = zip(*held)
    sizes = np.array([len(s) for s in sets])
    owner = np.repeat(np.arange(len(sets)), sizes)
    _, column, times = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    # a shingle of one set only is common to none
    several = times > 1
    column, owner = (np.cumsum(several) - 1)[column[several[column]]], owner[several[column]]
    order = np.argsort(column, kind="stable")
    column, owner = column[order], owner[order]
    both = np.zeros((len(sets), len(sets)), np.float32)
    width = 4096
    for low in range(0, int(several.sum()), width):
        a, b = np.searchsorted(column, [low, low + width])
        has = np.zeros((len(sets), width), np.float32)
        has[owner[a:b], column[a:b] - low] = 1
        both += has @ has.T
    up, down = SIMILAR
    near = (both > 0) & (down * both >= up * (sizes[:, None] + sizes[None, :] - both))
    parent = {r: r for r in roots}

    def top(r: int) -> int:
        while parent[r] != r:
            parent[r] = r = parent[parent[r]]
        return r

    out = []
    for x, y in zip(*(k.tolist() for k in np.nonzero(np.triu(near, 1)))):
        if (a := top(roots[x])) != (b := top(roots[y])):
            parent[max(a, b)] = min(a, b)
            out.append((min(nodes[x], nodes[y]), max(nodes[x], nodes[y])))
    return out


def survivors(docs: DataFrame) -> DataFrame:
    """One row of each group of copies and near copies, that of the least doc_id, with all its columns."""
    common.on_workers(docs.sparkSession)
    light = common.saved(banded(docs), "prints")
    nodes = common.saved(light.groupBy("node").agg(F.min(F.struct("_none", "_id", "_th")).alias("first"), F.first("fp").alias("fp"), F.first("bands").alias("bands")), "nodes")
    rooted = nodes.select("node", "first").join(copies(docs, nodes), "node", "left")
    first = rooted.groupBy(F.coalesce("root", "node").alias("root")).agg(F.min("first").alias("first"))
    return rows_of(docs, first.select("first.*")).select("_row.*")


def keys(docs: DataFrame) -> DataFrame:
    """_none, _id and _th, which tell rows with different ids or texts apart in the order of ids, nulls last; the text."""
    text = F.col("text").cast("string")
    doc_id = F.col("doc_id").cast("long")
    return docs.select(F.struct("*").alias("_row"), doc_id.isNull().alias("_none"), F.coalesce(doc_id, F.lit(0)).alias("_id"), F.xxhash64(text).alias("_th"), text.alias("text"))


def rows_of(docs: DataFrame, chosen: DataFrame) -> DataFrame:
    """A row of ``docs`` for each key in ``chosen``, with what else ``chosen`` has."""
    on = ["_none", "_id", "_th"]
    return keys(docs).join(chosen, on).dropDuplicates(on)
