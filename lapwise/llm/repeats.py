"""Repeated strings: later copies found in suffix order, the first one kept."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from lapwise.llm.common import LOT_BYTES, PrefixHash, digest, joined, lots, mix, ship, utf8_bytes

#: An anchor is the least hash of a run of so many bytes inside a string.
ANCHOR = 20
#: Text bytes for each chunk of documents and each bucket of anchors, and the least number of them.
PART_BYTES, LEAST_PARTS = 2 << 20, 64
#: Anchors gathered before a task hands them on.
HELD_ANCHORS = 1 << 20
_LAST = (1 << 63) - 1
_LOW = np.uint64(0xFFFFFFFF)


class Units:
    """The strings of `length` bytes of some texts, cut into units.

    Each string has one anchor, its run of `ANCHOR` bytes with the least hash, the
    leftmost of equals. Consecutive strings with the same anchor form a unit, so
    equal strings have equal anchors at the same place, wherever they stand.
    """

    def __init__(self, texts: list[bytes], length: int) -> None:
        self.data, starts = joined(texts)
        self.hash = PrefixHash(self.data)
        empty = np.zeros(0, np.int64)
        self.first = self.last = self.owner = empty
        self.anchor = np.zeros(0, np.uint64)
        if len(self.data) < length:
            return
        rolled = self.hash.rolling(ANCHOR)
        bits = max(24, int(len(rolled)).bit_length())
        low = np.uint64((1 << bits) - 1)
        least = (rolled & ~low) | np.arange(len(rolled), dtype=np.uint64)
        width, wide = length - ANCHOR + 1, 1
        while 2 * wide <= width:
            least = np.minimum(least[:-wide], least[wide:])
            wide *= 2
        if wide < width:
            least = np.minimum(least[: -(width - wide)], least[width - wide :])
        place = (least & low).astype(np.int64)
        # strings that cross the end of a text do not count
        valid = np.ones(len(place), np.bool_)
        for end in starts[1:-1].tolist():
            valid[max(0, end - length + 1) : end] = False
        heads = valid.copy()
        heads[1:] &= (place[1:] != place[:-1]) | ~valid[:-1]
        tails = valid.copy()
        tails[:-1] &= (place[1:] != place[:-1]) | ~valid[1:]
        self.first, self.last = np.flatnonzero(heads), np.flatnonzero(tails)
        self.anchor = rolled[place[self.first]]
        self.owner = np.searchsorted(starts, self.first, side="right") - 1
        self.starts = starts

    def names(self, chosen: np.ndarray, length: int) -> np.ndarray:
        """Hashes of whole units."""
        ends = self.last[chosen] + length
        return mix(self.hash.between(self.first[chosen], ends) + (ends - self.first[chosen]).astype(np.uint64))


def _bucket(anchors: np.ndarray, parts: int) -> np.ndarray:
    return ((anchors >> np.uint64(32)) * np.uint64(parts) >> np.uint64(32)).astype(np.int64)


def _ranks(keys: np.ndarray) -> np.ndarray:
    order = np.argsort(keys)
    sorted_keys = keys[order]
    out = np.empty(len(keys), np.uint64)
    out[order] = np.cumsum(np.r_[False, sorted_keys[1:] != sorted_keys[:-1]]).astype(np.uint64)
    return out


def string_order(data: np.ndarray, length: int) -> np.ndarray:
    """Rank of the string of `length` bytes at each place where one begins: equal for equal strings.

    Suffixes ranked by their first 8, 16, 32, ... bytes, and at last by `length`,
    from two overlapping ranks.
    """
    width = 8
    keys = np.zeros(len(data) - width + 1, np.uint64)
    for shift in range(width):
        keys = keys << np.uint64(8) | data[shift : shift + len(keys)].astype(np.uint64)
    rank = _ranks(keys)
    while width < length:
        step = min(width, length - width)
        rank = _ranks(rank[:-step] << np.uint64(32) | rank[step:])
        width += step
    return rank


def _uniques(values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Order that sorts, and where runs of equal values begin in it."""
    order = np.argsort(values, kind="stable")
    ordered = values[order]
    return order, np.flatnonzero(np.r_[True, ordered[1:] != ordered[:-1]]) if len(values) else np.zeros(0, np.int64)


def previous_smaller(values: np.ndarray) -> np.ndarray:
    """Place of the nearest smaller value before each value, -1 where there is none.

    Least values of pairs, pairs of pairs and so on: from each place up to the first
    left neighbour that holds a smaller value, then down to the last one in it.
    """
    levels = [values]
    while len(levels[-1]) > 1:
        below = levels[-1]
        least = below[: len(below) & ~1].reshape(-1, 2).min(axis=1)
        levels.append(np.append(least, below[-1]) if len(below) & 1 else least)
    out = np.full(len(values), -1)
    height = np.zeros(len(values), np.int8)
    at = node = np.arange(len(values))
    for level, least in enumerate(levels[:-1]):
        hit = (node & 1 == 1) & (least[node - 1] < values[at])
        out[at[hit]], height[at[hit]] = node[hit] - 1, level
        at, node = at[~hit], node[~hit] >> 1
    for level in range(len(levels) - 1, 0, -1):
        down = np.flatnonzero(height >= level)
        right = 2 * out[down] + 1
        out[down] = right - (levels[level - 1][right] >= values[down])
    return out


def next_smaller(values: np.ndarray) -> np.ndarray:
    """Place of the nearest smaller value after each value, -1 where there is none."""
    found = previous_smaller(values[::-1])[::-1]
    return np.where(found < 0, -1, len(values) - 1 - found)


def previous_factors(data: np.ndarray, starts: np.ndarray, length: int) -> np.ndarray:
    """For each start the number of an earlier start with a common factor of `length` bytes, or its own number.

    Longest previous factors, as far as they reach `length`: in suffix order the
    earlier suffix that shares most with a suffix is the previous or the next one
    that starts before it. Suffixes alike in `length` bytes stand in any order.
    """
    rank = string_order(data, length)[starts]
    turn = np.argsort(rank)
    ordered = rank[turn]
    source = np.arange(len(starts))
    for near in (previous_smaller(turn), next_smaller(turn)):
        reach = np.flatnonzero((near >= 0) & (ordered[near] == ordered))
        source[turn[reach]] = turn[near[reach]]
    return source


def first_occurrences(source: np.ndarray) -> np.ndarray:
    """The start at which the chain of previous factors of each start begins."""
    while True:
        further = source[source]
        if np.array_equal(further, source):
            return source
        source = further


def _earliest(data: np.ndarray, offsets: np.ndarray, order: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(unit, string in it, document order of its first occurrence) for all strings of units in document order."""
    sizes = np.diff(offsets) - length + 1
    unit = np.repeat(np.arange(len(sizes)), sizes)
    place = np.arange(len(unit)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
    first = first_occurrences(previous_factors(data, offsets[unit] + place, length))
    return unit, place, order[unit[first]]


def stretches(texts: list[bytes], length: int) -> Iterator[tuple[np.ndarray, np.ndarray, list[bytes]]]:
    """Lots of texts, as (text number, first byte, bytes).

    A text longer than a lot comes in stretches that overlap by `length` - 1 bytes,
    so that each string of `length` bytes lies in one of them.
    """
    cuts = [(row, a) for row, text in enumerate(texts) for a in range(0, max(1, len(text) - length + 1), LOT_BYTES)]
    most = LOT_BYTES + length - 1
    for lot in lots((min(len(texts[row]) - a, most) for row, a in cuts), most):
        rows, begins = np.array(cuts[lot], np.int64).T
        yield rows, begins, [texts[row][a : a + most] for row, a in cuts[lot]]


def _spread(low: np.ndarray, high: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """All numbers from each low to its high, and which pair each is from."""
    count = high - low
    which = np.repeat(np.arange(len(low)), count)
    return np.repeat(low - (np.cumsum(count) - count), count) + np.arange(len(which)), which


def _without(text: bytes, stretches: list[tuple[int, int]]) -> tuple[list[dict], bytes]:
    """Maximal runs of the bytes in any stretch, and the other bytes."""
    spans: list[dict] = []
    for a, b in sorted(stretches):
        if spans and a <= spans[-1]["end"]:
            spans[-1]["end"] = max(b, spans[-1]["end"])
        else:
            spans.append({"start": a, "end": b})
    edges = [0, *(e for s in spans for e in (s["start"], s["end"])), len(text)]
    return spans, b"".join(text[a:b] for a, b in zip(edges[::2], edges[1::2]))


def remove_repeats(
    docs: DataFrame, length: int = 50, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """Remove every byte covered by a string of `length` bytes that also starts in a document of a smaller id.

    Strings are judged on the input; they do not cross documents. Returns the id,
    `n_bytes`, `spans` (maximal removed runs of bytes, end exclusive) and `kept`
    (the other bytes, joined).

    Anchors of all strings are hashed to buckets, which tell what anchors several
    documents have. The units around these go, once for each chunk of documents,
    to the bucket of their anchor. There longest previous factors, from previous and
    next smaller positions in suffix order, lead every string to its first document,
    a lot of anchors at a time; chunks get back the units with an earlier one. Documents are
    shuffled to their chunks once, and no key gets more than one entry from each
    lot of anchors or chunk, however many documents share it.

    Equal texts: those after the first are removed as a whole if they have `length`
    bytes, and take no part in the rest. A missing text is an empty one. Missing
    ids come after all others and are not smaller than each other. Repeated rows
    have a row each and do not remove each other. An empty table gives an empty
    table. A text longer than a lot is taken in stretches, so that beyond the texts
    of its chunk a task holds arrays of one lot only. Other columns are not kept.
    """
    if length < ANCHOR + 1:
        raise ValueError(f"strings need more than {ANCHOR} bytes")
    spark = docs.sparkSession
    ship(spark)
    total = docs.agg(F.sum(utf8_bytes(F.col(text_col)))).first()[0] or 0
    parts = max(LEAST_PARTS, -(-total // PART_BYTES))
    text = F.coalesce(F.col(text_col), F.lit(""))
    read = docs.select(
        F.col(id_col).alias("id"), F.coalesce(F.col(id_col).cast("long"), F.lit(_LAST)).alias("order"),
        digest(text).alias("key"), F.encode(text, "UTF-8").alias("text"),
    )
    chunk = F.pmod(F.xxhash64("order", "key"), F.lit(parts)).cast("int").alias("chunk")
    firsts = read.groupBy("key").agg(F.min("order").alias("order")).select(
        chunk, F.lit(-1).alias("bucket"), F.col("order").alias("first_order"), F.col("key").alias("first_key"),
        F.lit(None).cast("binary").alias("data"),
    )

    def anchors(batches):
        held: list[tuple[np.ndarray, np.ndarray]] = []
        for batch in batches:
            texts, chunks = batch.column("text").to_pylist(), batch.column("chunk").to_numpy()
            for rows, _, parts_ in stretches(texts, length):
                units = Units(parts_, length)
                owner = rows[units.owner]
                held.append((units.anchor, owner, chunks[owner]))
                if sum(len(h[0]) for h in held) >= HELD_ANCHORS:
                    yield handed(held)
                    held = []
        if held:
            yield handed(held)

    def handed(held):
        """Anchors of one document go to their bucket with their chunk; those of more, without, and at once to all chunks."""
        shift = np.cumsum([0] + [int(h[1].max(initial=-1)) + 1 for h in held])
        anchor = np.concatenate([h[0] for h in held])
        owner = np.concatenate([h[1] + s for h, s in zip(held, shift)])
        chunk = np.concatenate([h[2] for h in held]).astype(np.int64)
        order = np.lexsort((owner, anchor))
        anchor, owner, chunk = anchor[order], owner[order], chunk[order]
        once = np.flatnonzero(np.r_[True, (anchor[1:] != anchor[:-1]) | (owner[1:] != owner[:-1])]) if len(anchor) else order
        anchor, chunk = anchor[once], chunk[once]
        heads = np.flatnonzero(np.r_[True, anchor[1:] != anchor[:-1]]) if len(anchor) else once
        several = np.repeat(np.diff(np.r_[heads, len(anchor)]), np.diff(np.r_[heads, len(anchor)])) > 1
        kinds, numbers, blobs = [], [], []

        def cut(kind, number, entries):
            turn, begins = _uniques(number)
            ends = [*begins[1:], len(number)]
            for a, b in zip(begins, ends):
                kinds.append(kind)
                numbers.append(int(number[turn[a]]))
                blobs.append(entries[turn[a:b]].tobytes())

        sent = np.where(several, -1, chunk)[heads]
        low = (anchor & _LOW).astype(np.uint32)
        cut(0, _bucket(anchor[heads], parts), np.rec.fromarrays([low[heads], sent.astype(np.int32)]))
        more = np.flatnonzero(several)
        if len(more):
            bucket = _bucket(anchor[more], parts).astype(np.int32)
            cut(1, chunk[more], np.rec.fromarrays([bucket, low[more]]))
        return pa.RecordBatch.from_arrays(
            [pa.array(kinds, pa.int32()), pa.array(numbers, pa.int32()), pa.array(blobs, pa.binary())], names=["kind", "number", "data"]
        )

    def shared(key: tuple[pa.Scalar, ...], rows: pa.Table) -> pa.Table:
        """Anchors that several documents have, for each chunk."""
        kind, number = key[0].as_py(), key[1].as_py()
        blob = b"".join(rows.column("data").to_pylist())
        if kind == 1:
            return pa.table({"chunk": pa.array([number], pa.int32()), "bucket": pa.array([-2], pa.int32()), "data": pa.array([blob], pa.binary())})
        entries = np.frombuffer(blob, np.dtype([("low", np.uint32), ("chunk", np.int32)]))
        turn, heads = _uniques(entries["low"])
        sizes = np.diff(np.r_[heads, len(entries)])
        low, chunk = entries["low"][turn], entries["chunk"][turn]
        told = np.add.reduceat(chunk < 0, heads) > 0
        live = np.repeat((sizes > 1) | told, sizes) & (chunk >= 0)
        low, chunk = low[live], chunk[live]
        turn, heads = _uniques(chunk)
        ends = [*heads[1:], len(chunk)]
        return pa.table({
            "chunk": pa.array(chunk[turn[heads]], pa.int32()),
            "bucket": pa.array([number] * len(heads), pa.int32()),
            "data": pa.array([low[turn[a:b]].tobytes() for a, b in zip(heads, ends)], pa.binary()),
        })

    def wanted(rows: pa.Table) -> np.ndarray:
        """Bucket and low half of the shared anchors of a chunk, as sorted 64-bit values."""
        found = [np.zeros(0, np.uint64)]
        for bucket, data in zip(rows.column("bucket").to_pylist(), rows.column("data").to_pylist()):
            if bucket == -2:
                both = np.frombuffer(data, np.dtype([("bucket", np.int32), ("low", np.uint32)]))
                found.append(both["bucket"].astype(np.uint64) << np.uint64(32) | both["low"])
            elif bucket >= 0:
                found.append(np.uint64(bucket) << np.uint64(32) | np.frombuffer(data, np.uint32))
        return np.unique(np.concatenate(found))

    def first_rows(left: pa.Table, right: pa.Table) -> tuple[list[bytes], np.ndarray, np.ndarray]:
        """Texts and orders of all rows, and which of them are the first of their text."""
        own = set(zip(right.column("first_order").to_pylist(), right.column("first_key").to_pylist()))
        orders, keys = left.column("order").to_pylist(), left.column("key").to_pylist()
        return (left.column("text").to_pylist(), np.array(orders, np.int64),
                np.array([pair in own for pair in zip(orders, keys)], np.bool_))

    def around(key: tuple[pa.Scalar, ...], left: pa.Table, right: pa.Table) -> pa.Table:
        """The units of a chunk's first texts that have a shared anchor, each once, in the bucket of the anchor."""
        texts, orders, first = first_rows(left, right)
        asked = wanted(right)
        names, buckets, lows, least, most, sizes, datas = [], [], [], [], [], [], []
        rows = np.flatnonzero(first)
        texts, orders = [texts[r] for r in rows], orders[rows]
        for text, _, parts_ in stretches(texts, length):
            units = Units(parts_, length)
            bucket = _bucket(units.anchor, parts)
            both = bucket.astype(np.uint64) << np.uint64(32) | (units.anchor & _LOW)
            place = np.minimum(np.searchsorted(asked, both), max(0, len(asked) - 1))
            chosen = np.flatnonzero(asked[place] == both) if len(asked) else np.zeros(0, np.int64)
            if not len(chosen):
                continue
            name = units.names(chosen, length)
            turn, heads = _uniques(name)
            doc = orders[text[units.owner[chosen]]][turn]
            one = chosen[turn[heads]]
            begin, end = units.first[one], units.last[one] + length
            whole = units.data.tobytes()
            names.append(name[turn[heads]])
            buckets.append(bucket[one])
            lows.append((units.anchor[one] & _LOW).astype(np.uint32))
            least.append(np.minimum.reduceat(doc, heads))
            most.append(np.maximum.reduceat(doc, heads))
            sizes.append(end - begin)
            datas += [whole[a:b] for a, b in zip(begin.tolist(), end.tolist())]
        if not names:
            return _units_table([], [], [])
        name, bucket, size = np.concatenate(names), np.concatenate(buckets), np.concatenate(sizes)
        low, high = np.concatenate(least), np.concatenate(most)
        turn, heads = _uniques(name)  # the same unit of several lots
        low, high = np.minimum.reduceat(low[turn], heads), np.maximum.reduceat(high[turn], heads)
        one = turn[heads]
        anchor = np.concatenate(lows)[one]
        table = np.rec.fromarrays([name[one], anchor, low, high, size[one].astype(np.int32)], dtype=head)
        turn, heads = _uniques(bucket[one])
        ends = [*heads[1:], len(one)]
        return _units_table(
            bucket[one][turn[heads]], [key[0].as_py()] * len(heads),
            [(table[turn[a:b]].tobytes(), b"".join([datas[one[t]] for t in turn[a:b].tolist()])) for a, b in zip(heads, ends)],
        )

    def _units_table(buckets, chunks, blobs) -> pa.Table:
        return pa.table({
            "bucket": pa.array(buckets, pa.int32()), "chunk": pa.array(chunks, pa.int32()),
            "heads": pa.array([b[0] for b in blobs], pa.binary()), "data": pa.array([b[1] for b in blobs], pa.binary()),
        })

    head = np.dtype([("name", np.uint64), ("anchor", np.uint32), ("low", np.int64), ("high", np.int64), ("size", np.int32)])
    reply = np.dtype([("name", np.uint64), ("from", np.int32), ("upto", np.int32), ("first", np.int64)])

    def earlier(rows: pa.Table) -> pa.Table:
        """For each chunk, runs of strings of its units that start earlier than in its last document with the unit."""
        chunks = rows.column("chunk").to_pylist()
        tables = [np.frombuffer(b, head) for b in rows.column("heads").to_pylist()]
        entries = np.concatenate(tables)
        chunk = np.repeat(chunks, [len(t) for t in tables])
        data = np.frombuffer(b"".join(rows.column("data").to_pylist()), np.uint8)
        begin = np.cumsum(entries["size"].astype(np.int64)) - entries["size"]
        turn = np.lexsort((entries["name"], entries["anchor"]))
        entries, chunk, begin = entries[turn], chunk[turn], begin[turn]
        heads = np.flatnonzero(np.r_[True, entries["name"][1:] != entries["name"][:-1]])
        edges = np.r_[heads, len(entries)]
        low, size = np.minimum.reduceat(entries["low"], heads), entries["size"][heads].astype(np.int64)
        # units with different anchors share no string
        anchors_of = np.flatnonzero(np.r_[True, np.diff(entries["anchor"][heads].astype(np.int64)) != 0])
        bounds = np.r_[anchors_of, len(heads)]
        found, found_chunks = [], []
        for lot in lots(np.add.reduceat(size, anchors_of).tolist()):
            units = np.arange(bounds[lot.start], bounds[lot.stop])
            units = units[np.argsort(low[units], kind="stable")]
            offsets = np.r_[0, np.cumsum(size[units])]
            source = np.repeat(begin[heads[units]] - offsets[:-1], size[units]) + np.arange(offsets[-1])
            owner, place, first = _earliest(data[source], offsets, low[units], length)
            runs = np.flatnonzero(np.r_[True, (owner[1:] != owner[:-1]) | (first[1:] != first[:-1])])
            upto = place[np.r_[runs[1:], len(owner)] - 1] + 1
            owner, place, first = owner[runs], place[runs], first[runs]
            # every entry gets the runs of its unit
            entry, unit = _spread(edges[units], edges[units + 1])
            of_unit = np.searchsorted(owner, np.arange(len(units) + 1))
            run, at = _spread(of_unit[unit], of_unit[unit + 1])
            entry = entry[at]
            live = first[run] < entries["high"][entry]
            entry, run = entry[live], run[live]
            found.append(np.rec.fromarrays(
                [entries["name"][entry], place[run].astype(np.int32), upto[run].astype(np.int32), first[run]], dtype=reply
            ))
            found_chunks.append(chunk[entry])
        out, chunk = np.concatenate(found), np.concatenate(found_chunks)
        turn, heads = _uniques(chunk)
        ends = [*heads[1:], len(chunk)]
        return pa.table({
            "chunk": pa.array(chunk[turn[heads]], pa.int32()),
            "bucket": pa.array([-3] * len(heads), pa.int32()),
            "data": pa.array([out[turn[a:b]].tobytes() for a, b in zip(heads, ends)], pa.binary()),
        })

    spans_type = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))

    def cut(key: tuple[pa.Scalar, ...], left: pa.Table, right: pa.Table) -> pa.Table:
        texts, orders, first = first_rows(left, right)
        replies = np.concatenate([np.zeros(0, reply)] + [
            np.frombuffer(d, reply) for b, d in zip(right.column("bucket").to_pylist(), right.column("data").to_pylist()) if b == -3
        ])
        replies = replies[np.argsort(replies["name"], kind="stable")]
        spans: list = [[] for _ in texts]
        kept = list(texts)
        for row in np.flatnonzero(~first).tolist():
            if len(texts[row]) >= length:
                spans[row], kept[row] = [{"start": 0, "end": len(texts[row])}], b""
        rows = np.flatnonzero(first)
        gone: list[list[tuple[int, int]]] = [[] for _ in rows]
        for text, begins, parts_ in stretches([texts[r] for r in rows], length) if len(replies) else ():
            units = Units(parts_, length)
            name = units.names(np.arange(len(units.first)), length)
            low, high = np.searchsorted(replies["name"], name, "left"), np.searchsorted(replies["name"], name, "right")
            hit, unit = _spread(low, high)
            live = replies["first"][hit] < orders[rows[text[units.owner[unit]]]]
            hit, unit = hit[live], unit[live]
            if not len(unit):
                continue
            edge = np.zeros(len(units.data) + 1, np.int32)
            np.add.at(edge, units.first[unit] + replies["from"][hit], 1)
            np.add.at(edge, units.first[unit] + replies["upto"][hit] - 1 + length, -1)
            covered = np.cumsum(edge[:-1], dtype=np.int32) > 0
            before, after = np.r_[False, covered[:-1]], np.r_[covered[1:], False]
            inner = units.starts[1:-1]
            before[inner[inner < len(covered)]] = after[inner[inner > 0] - 1] = False
            opens, closes = np.flatnonzero(covered & ~before), np.flatnonzero(covered & ~after) + 1
            owner = np.searchsorted(units.starts, opens, side="right") - 1
            shift = begins[owner] - units.starts[owner]
            for doc, a, b in zip(text[owner].tolist(), (opens + shift).tolist(), (closes + shift).tolist()):
                gone[doc].append((a, b))
        for row, some in zip(rows.tolist(), gone):
            if some:
                spans[row], kept[row] = _without(texts[row], some)
        return pa.table({
            "id": left.column("id"), "n_bytes": pa.array([len(t) for t in texts], pa.int64()),
            "spans": pa.array(spans, spans_type), "kept": pa.array(kept, pa.binary()),
        })

    chunked = read.select(chunk, "id", "order", "key", "text")
    found = (
        chunked.select("chunk", "text").mapInArrow(anchors, "kind int, number int, data binary")
        .groupBy("kind", "number").applyInArrow(shared, "chunk int, bucket int, data binary")
    )
    empty = [F.lit(None).cast("long").alias("first_order"), F.lit(None).cast("string").alias("first_key")]
    beside = firsts.unionByName(found.select("chunk", "bucket", *empty, "data"))
    units = chunked.groupBy("chunk").cogroup(beside.groupBy("chunk")).applyInArrow(
        around, "bucket int, chunk int, heads binary, data binary"
    )
    replies = units.groupBy("bucket").applyInArrow(earlier, "chunk int, bucket int, data binary")
    answers = firsts.unionByName(replies.select("chunk", "bucket", *empty, "data"))
    kind = docs.schema[id_col].dataType.simpleString()
    out = chunked.groupBy("chunk").cogroup(answers.groupBy("chunk")).applyInArrow(
        cut, f"id {kind}, n_bytes long, spans array<struct<start: long, end: long>>, kept binary"
    )
    return out.withColumnRenamed("id", id_col)
