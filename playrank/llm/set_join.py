"""Exact Jaccard join of word shingle sets, with both kinds of skipping between related sets.

1. One pass counts shingles in a fixed number of hash buckets. (bucket count, hash) is one order for all sets,
   frequent shingles last; any consistent order keeps the prefix filter exact.
2. Each distinct set puts the first shingles of its order into index lists. A list is kept in blocks by set size
   and position; a pair of blocks whose positions rule out the wanted overlap is skipped unseen.
3. What remains of a list is gathered under its smallest set, first with small parity maps only: two maps differ in no
   more bits than the sets in elements, so members without a possible partner drop out before any set is shipped.
4. For those left, the leader's overlaps are computed first, and the answers of the others are derived from them:
   bounds accept or reject most pairs, and the rest need only the differences from the leader. Pairs that are already
   connected are not looked at again.

Equal sets are one node, told apart by a 64-bit signature. Groups beyond ``BLOCK_SETS`` are dealt over pairs of blocks,
so no task holds more than two blocks; only forests of links leave a task, never all pairs.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from playrank.llm.runs import components, join_by_share, key_runs, run_bounds
from playrank.llm.text import chunks, mix, shingle_sets, signed
from playrank.session import materialize

COUNT_BITS = 20  # buckets of shingle counts: 4 MB broadcast at any input size
COUNT_PARTS = 64
FILTER_BITS = 22  # bits that tell which sets the last pass over the texts must build
LIST_BLOCK = 64
BLOCK_SETS = 1024


def signature(values: np.ndarray) -> int:
    """64-bit name of a sorted set."""
    spread = mix(values * np.uint64(0x9E3779B97F4A7C15) + np.arange(1, len(values) + 1, dtype=np.uint64))
    return int(mix(np.array([spread.sum(dtype=np.uint64) + np.uint64(len(values))], np.uint64)).view(np.int64)[0])


def prefix_length(n: int, percent: int) -> int:
    """So many first shingles of two sets must meet if the sets are similar enough."""
    return n - -(-percent * n // 100) + 1


def wanted_overlap(a, b, percent: int):
    """Smallest intersection with 100 * intersection >= percent * union."""
    return -(-percent * (a + b) // (100 + percent))


def parity_bits(values: np.ndarray) -> bytes:
    """How often each hash slot is hit, modulo 2. Two such maps differ in at most as many bits as the sets in elements."""
    slots = max(64, 1 << int(max(1, len(values) // 2)).bit_length())
    hits = np.bincount((values & np.uint64(slots - 1)).astype(np.int64), minlength=slots)
    return np.packbits((hits & 1).astype(bool), bitorder="little").tobytes()


def _profile(size: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros(1 << COUNT_BITS, np.int32)
        for batch in batches:
            for rows, data, offsets in chunks(batch, "text"):
                sets = shingle_sets(data, offsets, size)
                flat = np.concatenate(sets)
                counts += np.bincount((flat >> np.uint64(64 - COUNT_BITS)).astype(np.int64), minlength=len(counts)).astype(np.int32)
                n = pa.array([len(s) for s in sets], pa.int64())
                names = pa.array([signature(s) if len(s) else None for s in sets], pa.int64())
                none = pa.nulls(len(sets), pa.int32())
                bits = pa.array([parity_bits(s) if len(s) else None for s in sets], pa.binary())
                yield pa.RecordBatch.from_arrays([rows.column("doc_id"), n, names, bits, none, pa.nulls(len(sets), pa.binary())], columns)
        parts = counts.reshape(COUNT_PARTS, -1)
        used = [k for k in range(COUNT_PARTS) if parts[k].any()]
        empty = [pa.nulls(len(used), t) for t in (pa.int64(), pa.int64(), pa.int64(), pa.binary())]
        yield pa.RecordBatch.from_arrays([*empty, pa.array(used, pa.int32()), pa.array([parts[k].tobytes() for k in used], pa.binary())], columns)

    columns = ["doc_id", "n_shingles", "sig", "bits", "part", "counts"]

    return run


def _sum_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for table in key_runs(batches, ["part"]):
        bounds = run_bounds(table["part"].to_numpy())
        for a, b in zip(bounds[:-1], bounds[1:], strict=True):
            total = np.zeros((1 << COUNT_BITS) // COUNT_PARTS, np.int64)
            for raw in table["counts"].slice(a, b - a):
                total += np.frombuffer(raw.as_py(), np.int32)
            yield pa.RecordBatch.from_arrays([table["part"].slice(a, 1).combine_chunks(), pa.array([total.tobytes()], pa.binary())], ["part", "counts"])


def _postings(size: int, percent: int, counts):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[int] = set()  # equal sets of one task need one posting; forgetting them is harmless
        order_of = counts.value
        for batch in batches:
            for _, data, offsets in chunks(batch, "text"):
                tokens, names, sizes, places = [], [], [], []
                for values in shingle_sets(data, offsets, size):
                    n = len(values)
                    if not n or (name := signature(values)) in seen:
                        continue
                    seen.add(name)
                    take = prefix_length(n, percent)
                    weight = order_of[(values >> np.uint64(64 - COUNT_BITS)).astype(np.int64)]
                    first = np.lexsort((values, weight))[:take]
                    tokens.append(values[first])
                    names.append(np.full(take, name, np.int64))
                    sizes.append(np.full(take, n, np.int32))
                    places.append(np.arange(take, dtype=np.int32))
                if len(seen) > 200_000:
                    seen.clear()
                if tokens:
                    arrays = [signed(np.concatenate(tokens)), np.concatenate(names), np.concatenate(sizes), np.concatenate(places)]
                    yield pa.RecordBatch.from_arrays([pa.array(x) for x in arrays], ["token", "sig", "n", "pos"])

    return run


def _feasible(n: np.ndarray, pos: np.ndarray, percent: int) -> np.ndarray:
    """Which entries of a list (sorted by size) have a partner that positions and sizes allow.

    Blocks whose bounds rule each other out are skipped; an entry is looked at until one partner is found.
    """
    m = len(n)
    found = np.zeros(m, bool)

    def meet(a: slice, b: slice) -> None:
        na, nb = n[a][:, None], n[b][None, :]
        room = np.minimum(na - pos[a][:, None], nb - pos[b][None, :])
        ok = room >= wanted_overlap(na, nb, percent)
        if a == b:
            np.fill_diagonal(ok, False)
        found[a] |= ok.any(1)
        found[b] |= ok.any(0)

    starts = np.arange(0, m, LIST_BLOCK)
    blocks = [slice(s, min(m, s + LIST_BLOCK)) for s in starts]
    room = np.array([(n[b] - pos[b]).max() for b in blocks])
    low, high = n[starts], np.array([n[b][-1] for b in blocks])
    for block in blocks:
        meet(block, block)
    if len(blocks) == 1:
        return found
    for i, block in enumerate(blocks):
        if found[block].all():
            continue
        reach = np.minimum(room[i], room) >= wanted_overlap(low[i], low, percent)
        reach &= (100 * high >= percent * low[i]) & (100 * high[i] >= percent * low)
        for j in np.flatnonzero(reach):
            if j != i:
                meet(block, blocks[j])
                if found[block].all():
                    break
    return found


def _gather(percent: int):
    """Index lists to (leader, sig) rows."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in key_runs(batches, ["token"]):
            token, sig, n, pos = (table[c].to_numpy() for c in ("token", "sig", "n", "pos"))
            same = run_bounds(token, n, pos, sig)[:-1]  # equal sets from several tasks
            token, sig, n, pos = token[same], sig[same], n[same].astype(np.int64), pos[same].astype(np.int64)
            bounds = run_bounds(token)
            many = np.flatnonzero(np.diff(bounds) > 1)
            leaders, members = [], []
            for a, b in zip(bounds[many].tolist(), bounds[many + 1].tolist(), strict=True):
                kept = sig[a:b][_feasible(n[a:b], pos[a:b], percent)]
                if len(kept) > 1:
                    leaders.append(np.full(len(kept), kept.min()))
                    members.append(kept)
            if members:
                pairs = np.unique(np.column_stack([np.concatenate(leaders), np.concatenate(members)]), axis=0)
                yield pa.RecordBatch.from_arrays([pa.array(pairs[:, 0].copy()), pa.array(pairs[:, 1].copy())], ["leader", "sig"])

    return run


def _fold(maps: np.ndarray, words: int) -> np.ndarray:
    """Parity maps for fewer slots from those for more."""
    return np.bitwise_xor.reduce(maps.reshape(len(maps), -1, words), axis=1)


def _may_link(n: np.ndarray, maps: list[bytes], percent: int) -> np.ndarray:
    """Which sets of a group have a partner that sizes and parity maps allow."""
    found = np.zeros(len(n), bool)
    width = np.array([len(m) // 8 for m in maps])
    for w in np.unique(width).tolist():
        here = np.flatnonzero(width == w)
        own = np.frombuffer(b"".join([maps[k] for k in here.tolist()]), np.uint64).reshape(len(here), w)
        for v in (w, 2 * w, 4 * w):  # similar sets are close in size, so their maps are too
            there = here if v == w else np.flatnonzero(width == v)
            if not len(there):
                continue
            other = own if v == w else _fold(np.frombuffer(b"".join([maps[k] for k in there.tolist()]), np.uint64).reshape(len(there), v), w)
            step = max(1, (1 << 20) // (len(there) * w))
            for at in range(0, len(here), step):
                rows = here[at : at + step]
                apart = np.bitwise_count(own[at : at + step, None, :] ^ other[None, :, :]).sum(2, dtype=np.int64)
                na, nb = n[rows][:, None], n[there][None, :]
                ok = (na + nb - apart) // 2 >= wanted_overlap(na, nb, percent)
                ok &= rows[:, None] != there[None, :]
                found[rows] |= ok.any(1)
                found[there] |= ok.any(0)
    return found


def _sift(percent: int):
    """Groups of (n, bits) to the members that still may link."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["leader", "left", "right", "sig"]
        for table in key_runs(batches, names[:3]):
            leader, left, right, sig = (table[c].to_numpy() for c in names)
            n, bits = table["n"].to_numpy(), table["bits"].to_pylist()
            bounds = run_bounds(leader, left, right)
            keep = [np.flatnonzero(_may_link(n[a:b], bits[a:b], percent)) + a for a, b in zip(bounds[:-1].tolist(), bounds[1:].tolist(), strict=True) if b - a > 1]
            kept = pa.array(np.concatenate(keep) if keep else np.empty(0, np.int64))
            yield from table.select(names).take(kept).to_batches()

    return run


def _needed_sets(size: int, bits):
    """Sets of the texts whose signature is in the filter, once per task."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        allowed, seen = bits.value, set()
        for batch in batches:
            for _, data, offsets in chunks(batch, "text"):
                names, packed = [], []
                for values in shingle_sets(data, offsets, size):
                    if not len(values):
                        continue
                    name = signature(values)
                    slot = (name ^ (name >> 32)) & ((1 << FILTER_BITS) - 1)
                    if name not in seen and allowed[slot >> 6] >> np.uint64(slot & 63) & np.uint64(1):
                        seen.add(name)
                        names.append(name)
                        packed.append(values.tobytes())
                if len(seen) > 200_000:
                    seen.clear()
                if names:
                    yield pa.RecordBatch.from_arrays([pa.array(names, pa.int64()), pa.array(packed, pa.binary())], ["sig", "items"])

    return run


def _forest(linked: np.ndarray) -> np.ndarray:
    """Smallest reachable row number under a symmetric boolean matrix."""
    label = np.arange(len(linked))
    while True:
        best = np.minimum(label, np.where(linked, label[None, :], len(label)).min(1))
        best = best[best]
        if (best == label).all():
            return label
        label = best


def linked_rows(sets: list[np.ndarray], leader: np.ndarray, percent: int) -> np.ndarray:
    """Component label of each set among its own, all answers derived from the leader's."""
    m = len(sets)
    size = np.array([len(s) for s in sets])
    flat, owner = np.concatenate(sets), np.repeat(np.arange(m), size)
    place = np.searchsorted(leader, flat)
    inside = leader[np.minimum(place, len(leader) - 1)] == flat
    common = np.bincount(owner[inside], minlength=m)  # the leader's own answers
    wanted = wanted_overlap(size[:, None], size[None, :], percent)
    least = common[:, None] + common[None, :] - len(leader)
    extra = size - common
    most = np.minimum(common[:, None], common[None, :]) + np.minimum(extra[:, None], extra[None, :])
    linked = least >= wanted
    np.fill_diagonal(linked, True)
    label = _forest(linked)
    open_pairs = (most >= wanted) & ~linked & (label[:, None] != label[None, :])
    rows = np.flatnonzero(open_pairs.any(1))
    if not len(rows):
        return label
    # Only differences from the leader count: what it has and a set lacks, and what a set has besides.
    local = np.full(m, -1)
    local[rows] = np.arange(len(rows))
    out = ~inside & (local[owner] >= 0)
    lacks_row, lacks_item = [], []
    for r in rows.tolist():
        held = np.zeros(len(leader), bool)
        held[place[(owner == r) & inside] if m < 64 else np.searchsorted(leader, sets[r][np.isin(sets[r], leader, assume_unique=True)])] = True
        gone = np.flatnonzero(~held)
        lacks_row.append(np.full(len(gone), local[r]))
        lacks_item.append(gone)

    def shared(row: np.ndarray, item: np.ndarray) -> np.ndarray:
        result = np.zeros((len(rows), len(rows)), np.float32)
        _, item, count = np.unique(item, return_inverse=True, return_counts=True)
        keep = count[item] > 1
        row, item = row[keep], item[keep]
        _, item = np.unique(item, return_inverse=True)
        for start in range(0, int(item.max()) + 1 if len(item) else 0, 4096):
            part = (item >= start) & (item < start + 4096)
            block = np.zeros((len(rows), 4096), np.float32)
            block[row[part], item[part] - start] = 1
            result += block @ block.T
        return result

    lacking = len(leader) - common[rows]
    both_lack = shared(np.concatenate(lacks_row), np.concatenate(lacks_item))
    inner = len(leader) - lacking[:, None] - lacking[None, :] + both_lack
    overlap = inner + shared(local[owner[out]], flat[out])
    sub = overlap >= wanted[np.ix_(rows, rows)]
    linked[np.ix_(rows, rows)] |= sub
    return _forest(linked)


def _verify(percent: int):
    """Groups of sets to link forests."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in key_runs(batches, ["leader", "left", "right"]):
            leader, left, right, sig = (table[c].to_numpy() for c in ("leader", "left", "right", "sig"))
            bounds = run_bounds(leader, left, right)
            items = table["items"].combine_chunks()
            ones, others = [], []
            for a, b in zip(bounds[:-1].tolist(), bounds[1:].tolist(), strict=True):
                names, first = np.unique(sig[a:b], return_index=True)
                if len(names) < 2:
                    continue
                sets = [np.frombuffer(items[a + k].as_buffer(), np.uint64) for k in first.tolist()]
                at = int(np.searchsorted(names, leader[a]))
                pivot = sets[at] if at < len(names) and names[at] == leader[a] else sets[0]
                label = linked_rows(sets, pivot, percent)
                moved = np.flatnonzero(label != np.arange(len(label)))
                ones.append(names[moved])
                others.append(names[label[moved]])
            if ones:
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(ones)), pa.array(np.concatenate(others))], ["a", "b"])

    return run


def jaccard_components(docs: DataFrame, size: int = 3, percent: int = 90) -> DataFrame:
    """(doc_id, n_shingles, component_id) of every row of ``docs`` (doc_id, text, ...).

    Two texts link if ``100 * intersection >= percent * union`` of their sets of ``size``-word shingles, lower-cased
    in A-Z; ``component_id`` is the smallest doc_id reachable. Null, empty and blank texts have no shingles and link
    with nothing; texts shorter than a shingle count as one. Repeated rows come back repeated. An empty table gives no
    rows. Other columns are left aside, whatever their names. A null doc_id keeps a null component unless it links.
    """
    if not 0 < percent <= 100 or size < 1:
        raise ValueError("size must be positive and percent within 1 to 100")
    spark = docs.sparkSession
    context = spark.sparkContext
    texts = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("string").alias("text"))
    only_text = texts.select("text")

    profile = materialize(texts.mapInArrow(_profile(size), "doc_id bigint, n_shingles bigint, sig bigint, bits binary, part int, counts binary"), "profile")
    nodes = profile.where("part IS NULL").select("doc_id", "n_shingles", "sig", "bits")
    parts = profile.where("part IS NOT NULL").select("part", "counts").repartition(COUNT_PARTS, "part").sortWithinPartitions("part")
    order_of = np.zeros((COUNT_PARTS, (1 << COUNT_BITS) // COUNT_PARTS), np.int64)
    for row in parts.mapInArrow(_sum_counts, "part int, counts binary").collect():  # COUNT_PARTS rows at most
        order_of[row["part"]] = np.frombuffer(row["counts"], np.int64)
    shared_counts = context.broadcast(order_of.ravel())

    postings = only_text.mapInArrow(_postings(size, percent, shared_counts), "token bigint, sig bigint, n int, pos int")
    lists = postings.repartition("token").sortWithinPartitions("token", "n", "pos", "sig")
    members = materialize(lists.mapInArrow(_gather(percent), "leader bigint, sig bigint").distinct(), "members")

    width = members.groupBy("leader").agg(F.ceil(F.count("*") / F.lit(BLOCK_SETS)).cast("int").alias("blocks"))
    dealt = members.join(width, "leader").withColumn("block", F.pmod(F.xxhash64("sig"), F.col("blocks")).cast("int"))
    others = F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))
    placed = dealt.select("leader", "sig", "block", others.alias("other")).select("leader", "sig", F.least("block", "other").alias("left"), F.greatest("block", "other").alias("right"))
    maps = nodes.where("sig IS NOT NULL").groupBy("sig").agg(F.min("n_shingles").alias("n"), F.min("bits").alias("bits"))
    keys = ["leader", "left", "right"]
    sifted = placed.join(maps, "sig").repartition(*keys).sortWithinPartitions(*keys)
    sifted = materialize(sifted.mapInArrow(_sift(percent), "leader bigint, left int, right int, sig bigint"), "sifted")

    slot = F.expr(f"(sig ^ shiftright(sig, 32)) & {(1 << FILTER_BITS) - 1}")
    words = sifted.select(slot.alias("slot")).groupBy(F.shiftright("slot", 6).alias("word")).agg(F.bit_or(F.expr("shiftleft(1L, CAST(slot & 63 AS INT))")).alias("bits"))
    bits = np.zeros(1 << (FILTER_BITS - 6), np.uint64)
    found = words.toArrow()  # one row per 64 bits of the filter at most
    bits[found["word"].to_numpy()] = found["bits"].to_numpy().view(np.uint64)
    sets = only_text.mapInArrow(_needed_sets(size, context.broadcast(bits)), "sig bigint, items binary")
    grouped = sifted.join(sets, "sig").repartition(*keys).sortWithinPartitions(*keys)
    edges = grouped.mapInArrow(_verify(percent), "a bigint, b bigint")

    roots = components(edges)
    named = nodes.join(roots, nodes["sig"] == roots["node"], "left").select("doc_id", "n_shingles", "sig", F.coalesce("root", "sig").alias("root"))
    named = materialize(named, "named")
    smallest = named.where("root IS NOT NULL").groupBy("root").agg(F.min("doc_id").alias("component_id"), F.count("*").alias("n"))
    grouped = join_by_share(named, smallest, ["root"], named.count())
    alone = named.where("root IS NULL").withColumn("component_id", F.lit(None).cast("bigint"))
    return grouped.unionByName(alone).select("doc_id", "n_shingles", F.coalesce("component_id", "doc_id").alias("component_id"))
