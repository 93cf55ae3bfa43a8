"""Near copies: texts whose sets of word shingles are alike, by SimHash first, then without loss.

A set's SimHash fingerprint links it to others at few differing bits, by the chains of segments of ``simhash``; what is
linked is compared shingle by shingle. Texts with four fifths of their shingles in common differ in some ten bits of 64,
and no parts that such fingerprints must share would keep buckets small. So prefixes of rare shingles find, without
loss, what the fingerprints leave apart.

Sets are as large as their texts, so they are not kept: they are made from the texts again for the few texts that may
have a partner. What is shuffled for all texts are the hashed shingles of their prefixes, once. Each comes with its
place, which tells most texts that share one by chance from texts that can be alike.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from activity_lake.llm.common import giving_back, id_and_text, stage
from activity_lake.llm.graph import components
from activity_lake.llm.simhash import bit_counts, majority, near_links
from activity_lake.session import new_path
from activity_lake.sources.tables import job_stages, write_stage

SHINGLE = 5
# Two texts are near copies when their sets have at least this share, in percent, of all their shingles in common.
MIN_PERCENT = 80
# Counters of how frequent shingles are, from one document in SAMPLE. They order the shingles and decide no result.
SAMPLE = 16
COUNTERS = 1 << 18
# Shingles with this many times the counts of others are dealt to SALTS groups by node.
HOT, SALTS = 64, 64
# Nodes that a task remembers as filed.
FILED = 1 << 18
# Nodes of a shingle that are held to look for partners, and how far apart in order of size partners are looked for.
RUN_ROWS, NEIGHBOURS = 10_000, 32
LEAST_BITS = 64
# Bits for each value of the maps that are compared in blocks; pairs get shorter maps.
FINE = 4
# Turns of comparing with one node of each shingle, and pairs per filed shingle that may be left after them.
TURNS, ENOUGH = 3, 2
# Nodes of a shingle whose maps are compared at a time.
BLOCK = 1_000
# Texts, or pairs of sets, that are worked on at a time.
AT_A_TIME = 500


def _mixed(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    return h ^ (h >> np.uint64(29))


def shingle_set(text: str, size: int) -> np.ndarray:
    """Sorted hashes of the runs of ``size`` words, each once; all words of a shorter text are one run."""
    words = text.encode().lower().split()
    hashes = np.fromiter(map(xxhash.xxh64_intdigest, words), np.uint64, len(words))
    size = min(size, len(words))
    if not size:
        return hashes
    runs = np.full(len(words) - size + 1, size, np.uint64)
    for k in range(size):
        runs = _mixed(runs * np.uint64(0x9E3779B97F4A7C15) + hashes[k:len(words) - size + 1 + k])
    return np.unique(runs)


def _node(values: np.ndarray) -> int:
    """A name for a set, as a signed 64-bit number."""
    return int(np.uint64(xxhash.xxh64_intdigest(values.tobytes())).astype(np.int64))


def set_fingerprint(values: np.ndarray) -> int:
    """The SimHash fingerprint of a set, as a signed 64-bit number; 0 for none."""
    return int(np.uint64(majority(bit_counts(values), len(values))).astype(np.int64))


def parity_map(values: np.ndarray, per_value: int = 1) -> bytes:
    """One bit per hash bucket, ``per_value`` or some more for each value: whether it holds an odd number of them.

    Every value that only one of two sets has turns over one bit, so the maps differ in no more bits than the sets do
    in values. A map is the larger one folded, so sets of unlike sizes can be compared as well.
    """
    bits = max(LEAST_BITS, 1 << (per_value * len(values) - 1).bit_length())
    counts = np.bincount((values & np.uint64(bits - 1)).astype(np.int64), minlength=bits)
    return np.packbits((counts & 1).astype(np.uint8), bitorder="little").tobytes()


def most_common(n_a: int, n_b: int, map_a: bytes, map_b: bytes) -> float:
    """The largest number of common values that two maps allow."""
    a, b = np.frombuffer(map_a, np.uint8), np.frombuffer(map_b, np.uint8)
    if len(a) > len(b):
        a, b = b, a
    folded = np.bitwise_xor.reduce(b.reshape(-1, len(a)), axis=0)
    return (n_a + n_b - int(np.bitwise_count(a ^ folded).sum())) / 2


def _slices(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for at in range(0, batch.num_rows, AT_A_TIME):
            yield batch.slice(at, AT_A_TIME)


def _batches(batches: Iterator[pa.RecordBatch], size: int):
    for batch in _slices(batches):
        yield batch, (shingle_set(t, size) for t in batch.column("text").to_pylist())


def _nodes(size: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, sets in _batches(batches, size):
            found = [(_node(s), len(s), parity_map(s), parity_map(s, FINE), set_fingerprint(s)) for s in sets]
            node, n, maps, fine, fp = zip(*found) if found else ((), (), (), (), ())
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(node, pa.int64()), pa.array(n, pa.int64()), pa.array(maps, pa.binary()),
                 pa.array(fine, pa.binary()), pa.array(fp, pa.int64())], ["doc_id", "node", "n", "map", "fine", "fp"])

    return run


def _sample_counts(size: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, sets in _batches(batches, size):
            at = [(s & np.uint64(COUNTERS - 1)).astype(np.int64) for s in sets]
            bucket, n = np.unique(np.concatenate(at or [np.zeros(0, np.int64)]), return_counts=True)
            yield pa.RecordBatch.from_arrays([pa.array(bucket), pa.array(n.astype(np.int64))], ["bucket", "n"])

    return run


def frequencies(rows: DataFrame, size: int) -> np.ndarray:
    """Counters of shingles by hash, from one document in ``SAMPLE``; never more than ``COUNTERS`` of them."""
    sample = rows.filter(F.pmod(F.xxhash64("doc_id"), F.lit(SAMPLE)) == 0)
    found = sample.mapInArrow(giving_back(_sample_counts(size)), "bucket long, n long").groupBy("bucket").agg(
        F.sum("n").alias("n")).toArrow()
    counts = np.zeros(COUNTERS, np.uint32)
    counts[found["bucket"].to_numpy()] = np.minimum(found["n"].to_numpy(), (1 << 32) - 1)
    return counts


def _prefixes(counts: np.ndarray, size: int, percent: int):
    hot = HOT * max(1, counts.mean())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        filed: set[int] = set()
        for batch, sets in _batches(batches, size):
            shingles, salts, nodes = [np.zeros(0, np.uint64)], [np.zeros(0, np.int32)], [np.zeros(0, np.int64)]
            sizes, lefts = [np.zeros(0, np.int32)], [np.zeros(0, np.int32)]
            for values in sets:
                node = _node(values)
                if not len(values) or node in filed:
                    continue
                if len(filed) < FILED:
                    filed.add(node)
                often = counts[values & np.uint64(COUNTERS - 1)]
                # ceil(n x percent / 100) shingles must be shared, so one of the first n - that + 1 is.
                first = np.lexsort((values, often))[:len(values) - -(-len(values) * percent // 100) + 1]
                shingles.append(values[first])
                salts.append(np.where(often[first] > hot, node % SALTS, -1).astype(np.int32))
                nodes.append(np.full(len(first), node, np.int64))
                sizes.append(np.full(len(first), len(values), np.int32))
                lefts.append(np.arange(len(values), len(values) - len(first), -1, dtype=np.int32))
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.concatenate(shingles).view(np.int64)), pa.array(np.concatenate(lefts)),
                 pa.array(np.concatenate(salts)), pa.array(np.concatenate(nodes)), pa.array(np.concatenate(sizes))],
                ["shingle", "left", "salt", "node", "n"])

    return run


def _have_partner(run: np.ndarray, node: np.ndarray, n: np.ndarray, left: np.ndarray, percent: int) -> np.ndarray:
    """Which rows of whole runs share their shingle with another node that can be alike.

    Two sets share nothing ahead of the first shingle they have in common, so no more than what is left in each from
    there on. Rows are compared with larger sets of their run; a run with too many of like size is kept.
    """
    order = np.lexsort((n, run))
    run_, node_, n_, left_ = (x[order].astype(np.int64) for x in (run, node, n, left))
    keep, at = np.zeros(len(order), bool), np.arange(len(order))
    for k in range(1, NEIGHBOURS + 1):
        at = at[at + k < len(order)]
        # Sizes ascend, so a row with no set of like size here has none further on.
        at = at[(run_[at] == run_[at + k]) & (100 * n_[at] >= percent * n_[at + k])]
        if not len(at):
            break
        alike = (node_[at] != node_[at + k]) & (
            (100 + percent) * np.minimum(left_[at], left_[at + k]) >= percent * (n_[at] + n_[at + k]))
        keep[at[alike]] = keep[at[alike] + k] = True
    keep |= np.isin(run_, run_[at])
    out = np.zeros(len(order), bool)
    out[order] = keep
    return out


def _partners(percent: int):
    """Rows that have a partner, from rows in order of shingle and salt.

    Of a salted shingle all rows are given, as partners may be in another group, and so they are of a run that is too
    long to be held.
    """
    names = ["shingle", "salt", "node", "n", "left"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, given = None, None
        for batch in batches:
            rows = [np.asarray(batch.column(c)) for c in names]
            if held is not None:
                rows = [np.concatenate(x) for x in zip(held, rows)]
            shingle, salt, node, n, left = rows
            if not len(node):
                continue
            new = np.ones(len(node), bool)
            new[1:] = (shingle[1:] != shingle[:-1]) | (salt[1:] != salt[:-1])
            whole = salt >= 0
            if (shingle[0], salt[0]) == given:
                whole |= np.cumsum(new) == 1
            # The last run may go on in the next batch.
            end = int(np.flatnonzero(new)[-1])
            if whole[end] or len(node) - end > RUN_ROWS:
                whole[end:], given, end = True, (shingle[end], salt[end]), len(node)
            held = [x[end:] for x in rows]
            open_runs = np.flatnonzero(~whole[:end])
            keep = whole[:end]
            keep[open_runs] = _have_partner(
                np.cumsum(new)[open_runs], *(x[open_runs] for x in (node, n, left)), percent)
            yield pa.RecordBatch.from_arrays([pa.array(x[:end][keep]) for x in rows[:3]], names[:3])
        if held is not None and len(held[0]):
            keep = _have_partner(np.zeros(len(held[0]), np.int64), *held[2:], percent)
            yield pa.RecordBatch.from_arrays([pa.array(x[keep]) for x in held[:3]], names[:3])

    return run


def _shared(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows of shingles that several nodes have, with the least node, from rows in order of shingle, salt and node.

    Of a salted shingle all rows are given, as its other nodes may be in another group. One row is carried on.
    """
    last, open_run = None, False

    def out(shingle, node, least):
        return pa.RecordBatch.from_arrays(
            [pa.array(x.astype(np.int64)) for x in (shingle, node, least)], ["shingle", "node", "least"])

    for batch in batches:
        if not batch.num_rows:
            continue
        shingle, salt, node = (np.asarray(batch.column(c)).astype(np.int64) for c in ("shingle", "salt", "node"))
        # The run that the last batch left open starts with its least node, which may not have been given yet.
        carried = 0 if last is None else 1
        if carried:
            shingle, salt, node = (np.concatenate(([x], y)) for x, y in zip(last, (shingle, salt, node)))
        new = np.ones(len(node), bool)
        new[1:] = (shingle[1:] != shingle[:-1]) | (salt[1:] != salt[:-1])
        run = np.cumsum(new) - 1
        starts = np.flatnonzero(new)
        least = node[starts][run]
        fresh = np.ones(len(node), bool)
        fresh[1:] = new[1:] | (node[1:] != node[:-1])
        other = ~new & fresh & (node != least)
        shared = np.bincount(run[other], minlength=len(starts)) > 0
        give = other | (new & (shared[run] | (salt >= 0)))
        if carried and open_run:
            give[0] = False
        yield out(shingle[give], node[give], least[give])
        at = starts[-1]
        open_run = bool(shared[-1] or salt[at] >= 0 or (at == 0 and carried and open_run))
        last = (shingle[at], salt[at], node[at])


def shared_prefixes(rows: DataFrame, size: int = SHINGLE, percent: int = MIN_PERCENT) -> DataFrame:
    """(shingle, node, least) of all shingles that the prefixes of several nodes have, by which they can be alike.

    A prefix has the rarest shingles of its set, as many as have to be looked at so that two sets that are alike share
    one. The first they share comes early enough in both, so nodes that no other of the shingle can be like are left out.
    The shuffle deals shingles out, frequent ones in groups by node as well; its tasks pass them in order.
    """
    # What differs from row to row of a text comes first, so that the rest compresses as one.
    filed = rows.mapInArrow(
        giving_back(_prefixes(frequencies(rows, size), size, percent)),
        "shingle long, left int, salt int, node long, n int")
    return filed.repartition("shingle", "salt").sortWithinPartitions("shingle", "salt", "node").mapInArrow(
        giving_back(lambda batches: _shared(_partners(percent)(batches))), "shingle long, node long, least long")


def _possible(percent: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in _slices(batches):
            columns = [batch.column(c).to_pylist() for c in ("n_a", "n_b", "map_a", "map_b")]
            keep = [(100 + percent) * most_common(a, b, x, y) >= percent * (a + b) for a, b, x, y in zip(*columns)]
            yield batch.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))

    return run


def _alike(percent: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in _slices(batches):
            keep = []
            for x, y in zip(batch.column("set_a").to_pylist(), batch.column("set_b").to_pylist()):
                a, b = np.frombuffer(x, np.uint64), np.frombuffer(y, np.uint64)
                common = len(np.intersect1d(a, b, assume_unique=True))
                keep.append((100 + percent) * common >= percent * (len(a) + len(b)))
            yield batch.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))

    return run


def _sets(size: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, sets in _batches(batches, size):
            for values in sets:
                yield pa.RecordBatch.from_arrays(
                    [pa.array([_node(values)]), pa.array([values.tobytes()], pa.binary())], ["node", "set"])

    return run


def _verified(pairs: DataFrame, rows: DataFrame, nodes: DataFrame, size: int, percent: int) -> DataFrame:
    """Pairs (a, b) whose sets are alike: those that their maps allow are compared shingle by shingle."""
    about = nodes.select("node", "n", "map")
    sides = pairs.join(about.toDF("a", "n_a", "map_a"), "a").join(about.toDF("b", "n_b", "map_b"), "b").filter(
        (100 * F.least("n_a", "n_b") >= percent * F.greatest("n_a", "n_b")))
    possible = stage(sides.mapInArrow(giving_back(_possible(percent)), "a long, b long"), "near-possible")
    return _alike_links(possible, rows, nodes, size, percent)


def _alike_links(possible: DataFrame, rows: DataFrame, nodes: DataFrame, size: int, percent: int) -> DataFrame:
    """Pairs (a, b) whose sets are alike, compared shingle by shingle.

    Only texts with such a partner are fetched, one for each set, and made into sets again.
    """
    wanted = possible.select(F.explode(F.array("a", "b")).alias("node")).distinct()
    wanted = stage(nodes.join(wanted, "node", "left_semi").select(F.col("least_id").alias("wanted_id")).distinct(), "near-wanted")
    sets = rows.join(wanted, F.col("doc_id").eqNullSafe(F.col("wanted_id")), "left_semi").select("text").mapInArrow(
        giving_back(_sets(size)), "node long, set binary")
    return stage(
        possible.join(sets.toDF("a", "set_a"), "a").join(sets.toDF("b", "set_b"), "b").select(
            "a", "b", "set_a", "set_b").mapInArrow(giving_back(_alike(percent)), "a long, b long").distinct(), "near-links")


def simhash_pairs(nodes: DataFrame) -> DataFrame:
    """Pairs (a, b) of nodes that span what SimHash links: equal fingerprints, and those with few differing bits."""
    heads = stage(nodes.groupBy("fp").agg(F.min("node").alias("head")), "near-fingerprints")
    equal = nodes.select("fp", "node").join(heads, "fp").filter("head < node").select(
        F.col("head").alias("a"), F.col("node").alias("b"))
    links = near_links(heads.select("fp")).distinct()
    near = links.join(heads.toDF("a", "head_a"), "a").join(heads.toDF("b", "head_b"), "b").select(
        F.least("head_a", "head_b").alias("a"), F.greatest("head_a", "head_b").alias("b"))
    return stage(equal.unionByName(near).distinct(), "near-simhash")


def _apart(pairs: DataFrame, links: DataFrame) -> DataFrame:
    """Pairs (a, b) of nodes that the links leave in different components."""
    roots = components(links, "near-linked")
    return pairs.join(roots.toDF("a", "root_a"), "a", "left").join(roots.toDF("b", "root_b"), "b", "left").filter(
        F.coalesce("root_a", "a") != F.coalesce("root_b", "b")).select("a", "b")


def near_copy_links(rows: DataFrame, nodes: DataFrame, size: int = SHINGLE, percent: int = MIN_PERCENT) -> DataFrame:
    """Links (a, b) that join all nodes with at least ``percent`` of their shingles in common.

    What SimHash links is compared first. Sets that are alike also share a shingle of their prefixes: of nodes that are
    still apart, each shingle's are compared with the least one of its group, and the least ones of a frequent shingle's
    groups with the least of all. Where that leaves them in several components, nodes of different ones are compared in
    pairs, so that a large group of copies costs its size and not its pairs.
    """
    by_simhash = simhash_pairs(nodes)
    links = _verified(by_simhash, rows, nodes, size, percent)
    shared = stage(shared_prefixes(rows, size, percent), "near-shared")
    tops = stage(shared.groupBy("shingle").agg(F.min("least").alias("top"), F.max("least").alias("most")).filter(
        "top < most").select("shingle", "top"), "near-tops")
    between = shared.select("shingle", "least").distinct().join(tops, "shingle").filter("top < least")
    first = shared.filter("least < node").select(F.col("least").alias("a"), F.col("node").alias("b")).unionByName(
        between.select(F.col("top").alias("a"), F.col("least").alias("b"))).distinct()
    first = stage(_apart(first, links).join(by_simhash, ["a", "b"], "left_anti"), "near-first")
    links = stage(links.unionByName(_verified(first, rows, nodes, size, percent)), "near-links")
    tried = stage(by_simhash.unionByName(first), "near-tried")

    members = stage(shared.select("shingle", "node").distinct(), "near-members")
    for turn in range(TURNS):
        placed = _in_several(members, links)
        sizes = placed.groupBy("shingle", "root").agg(F.count("*").alias("n")).groupBy("shingle").agg(
            F.sum("n").alias("n"), F.sum(F.col("n") * F.col("n")).alias("squares"))
        pairs = sizes.agg(F.sum((F.col("n") * F.col("n") - F.col("squares")) / 2)).first()[0]
        if not pairs or turn + 1 == TURNS or pairs <= ENOUGH * members.count():
            break
        # Another node of each shingle is compared with those that are not of its component yet.
        centre = F.min_by(F.struct("node", "root"), F.xxhash64(F.lit(turn), "node")).alias("centre")
        centres = stage(placed.groupBy("shingle").agg(centre), "near-centres")
        more = placed.join(centres, "shingle").filter(F.col("root") != F.col("centre.root")).select(
            F.least("node", "centre.node").alias("a"), F.greatest("node", "centre.node").alias("b")).distinct()
        more = stage(more.join(tried, ["a", "b"], "left_anti"), "near-more")
        tried = stage(tried.unionByName(more), "near-tried")
        links = stage(links.unionByName(_verified(more, rows, nodes, size, percent)), "near-links")

    rest = stage(_across(placed, nodes, percent).distinct().join(tried, ["a", "b"], "left_anti"), "near-rest")
    return links.unionByName(_alike_links(rest, rows, nodes, size, percent))


def _across(placed: DataFrame, nodes: DataFrame, percent: int) -> DataFrame:
    """Pairs (a, b) of one shingle and different components whose maps do not rule them out.

    Nodes are compared in blocks, in memory: a task gets two blocks of a shingle at a time, and no pair leaves it that
    its maps rule out.
    """
    # Two nodes of a shingle have been compared by now: one of them was the least.
    blocks = stage(placed.groupBy("shingle").agg(F.count("*").alias("members")).filter("members > 2").select(
        "shingle", F.ceil(F.col("members") / BLOCK).cast("int").alias("blocks")), "near-blocks")
    block = F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int")
    about = nodes.select("node", "n", F.col("fine").alias("map"))
    dealt = placed.join(blocks, "shingle").select(
        "shingle", "node", "root", block.alias("block"), F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("other"))
    keyed = dealt.select(
        "shingle", F.least("block", "other").alias("lo"), F.greatest("block", "other").alias("hi"), "block", "node", "root")
    return keyed.join(about, "node").repartition("shingle", "lo", "hi").sortWithinPartitions(
        "shingle", "lo", "hi", "block", "node").select("shingle", "lo", "hi", "block", "node", "root", "n", "map").mapInArrow(
        giving_back(_across_blocks(percent)), "a long, b long")


def _across_blocks(percent: int):
    def compared(rows: list[tuple]) -> Iterator[pa.RecordBatch]:
        """Rows (block, node, root, n, map) of one key; those of one size of map are a matrix."""
        block, node, root, n = (np.array([r[k] for r in rows], np.int64) for k in range(4))
        size = np.array([len(r[4]) for r in rows])
        maps = {s: np.frombuffer(b"".join(r[4] for r in rows if len(r[4]) == s), np.uint64).reshape(-1, s // 8)
                for s in np.unique(size).tolist()}
        places = {s: np.flatnonzero(size == s) for s in maps}
        whole = block[0] == block[-1]
        for i in range(len(rows)):
            found = []
            mine = np.frombuffer(rows[i][4], np.uint64)
            for s, at in places.items():
                # The larger map is folded, so each pair is looked at from the one with the larger map.
                if s > size[i]:
                    continue
                folded = np.bitwise_xor.reduce(mine.reshape(-1, s // 8), axis=0)
                apart = np.bitwise_count(maps[s] ^ folded).sum(axis=1, dtype=np.int64)
                total = n[i] + n[at]
                keep = ((100 + percent) * (total - apart) >= 2 * percent * total) & (root[at] != root[i]) & (
                    100 * np.minimum(n[i], n[at]) >= percent * np.maximum(n[i], n[at]))
                if s == size[i]:
                    keep &= at > i
                if not whole:
                    keep &= block[at] != block[i]
                found.append(node[at[keep]])
            other = np.concatenate(found)
            if len(other):
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.minimum(other, node[i])), pa.array(np.maximum(other, node[i]))], ["a", "b"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, rows = None, []
        for batch in batches:
            columns = [batch.column(c).to_pylist() for c in ("shingle", "lo", "hi", "block", "node", "root", "n", "map")]
            for shingle, lo, hi, *row in zip(*columns):
                if (shingle, lo, hi) != key:
                    if len(rows) > 1:
                        yield from compared(rows)
                    key, rows = (shingle, lo, hi), []
                rows.append(tuple(row))
        if len(rows) > 1:
            yield from compared(rows)

    return run


def _in_several(members: DataFrame, links: DataFrame) -> DataFrame:
    """(shingle, node, root) of the shingles whose nodes the links leave in several components."""
    roots = components(links, "near-stars")
    placed = stage(members.join(roots, "node", "left").select(
        "shingle", "node", F.coalesce("root", "node").alias("root")), "near-placed")
    mixed = stage(placed.groupBy("shingle").agg(F.min("root").alias("lo"), F.max("root").alias("hi")).filter(
        "lo < hi").select("shingle"), "near-mixed")
    return stage(placed.join(mixed, "shingle", "left_semi"), "near-open")


def near_copy_groups(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
    shingle: int = SHINGLE, percent: int = MIN_PERCENT,
) -> DataFrame:
    """One row per input row: doc_id, component_id (least doc_id that links reach, its own included).

    Words and case are those of SimHash; shingles are compared by 64 bits of a hash. Texts with equal sets are one
    node; those without words, null among them, are one too. A null doc_id is never a component_id, unless its
    component has no other id. Repeated rows give a row each; an empty table gives an empty result. The result is a
    written table, and all that was written on the way is removed.
    """
    spark = docs.sparkSession
    with job_stages(spark):
        rows = id_and_text(docs, id_col, text_col)
        named = stage(rows.mapInArrow(giving_back(_nodes(shingle)), "doc_id long, node long, n long, map binary, fine binary, fp long"),
            "near-nodes")
        nodes = stage(named.groupBy("node").agg(
            F.min("doc_id").alias("least_id"), F.first("n").alias("n"), F.first("map").alias("map"),
            F.first("fine").alias("fine"), F.first("fp").alias("fp")), "near-sets")
        roots = components(near_copy_links(rows, nodes, shingle, percent), "near-components")
        placed = stage(nodes.select("node", "least_id").join(roots, "node", "left").select(
            "node", "least_id", F.coalesce("root", "node").alias("root")), "near-roots")
        least = stage(placed.groupBy("root").agg(F.min("least_id").alias("component_id")), "near-least")
        ids = stage(placed.join(least, "root").select("node", "component_id"), "near-ids")
        out = named.select("doc_id", "node").join(ids, "node").select("doc_id", "component_id")
        return write_stage(out, new_path(spark, "near-groups"))
