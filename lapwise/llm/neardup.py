"""Near-duplicates: improved consistent weighted sampling of TF-IDF shingles, banded, verified by weighted Jaccard."""

from __future__ import annotations

from functools import reduce

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window, functions as F

from lapwise.llm.common import digest, lots, mix, parted, ship, stage
from lapwise.llm.shingles import shingles

#: Document frequencies are counted in so many buckets of shingle hashes, at any size of the table.
BUCKETS = 1 << 18
_SLICES, _FAN_IN = 64, 256
#: Buckets of up to so many members are compared in full; bands and their rows for differences from a leader.
SMALL = 5
#: What so many members of a larger bucket hold in the middle tells which member is like most of them, and leads.
SPEAKERS = 15
#: So many bands leave 0.9 percent apart of those whose differences overlap by 2/7, and 0.05 percent at a third.
APART_BANDS, APART_ROWS = 200, 3
#: Members less similar to a leader than this are not dealt by it, as all of them lack nearly the whole leader.
APART_FROM = 0.4
#: They are dealt by keys of so many samples of their own, in as many bands as leave this share of links apart.
FAR_ROWS, FAR_LOSS = 8, 0.001
#: Shingles are compared over all texts of large buckets in slices of about so many bytes of hashes.
SLICE_BYTES = 1 << 20
#: How much of a shingle's weight its rarity decides: weights lie between tf and (1 + RARITY) * tf.
RARITY = 0.1


def document_frequencies(docs: DataFrame, words: int) -> tuple[np.ndarray, int]:
    """Documents with a shingle of each bucket, and documents with any shingle.

    Each task sums over its documents; sums of `_FAN_IN` tasks are added in one
    task, slice by slice, then these. What reaches the driver has a fixed size.
    """

    def count(batches):
        total, seen = np.zeros(BUCKETS, np.int64), 0
        for batch in parted(batches):
            texts = [b"" if t is None else t.encode() for t in batch.column("text").to_pylist()]
            for lot in lots(map(len, texts)):
                owner, hashes, _ = shingles(texts[lot], words)
                total += np.bincount((hashes & np.uint64(BUCKETS - 1)).astype(np.int64), minlength=BUCKETS)
                seen += len(np.unique(owner))
        worker = TaskContext.get().partitionId()
        parts = [s.tobytes() for s in np.split(total, _SLICES)]
        yield pa.RecordBatch.from_arrays(
            [pa.array(range(_SLICES), pa.int32()), pa.array([worker // _FAN_IN] * _SLICES, pa.int32()),
             pa.array(parts, pa.binary()), pa.array([seen] + [0] * (_SLICES - 1), pa.int64())],
            names=["slice", "lot", "sums", "seen"],
        )

    def add(frame: pd.DataFrame) -> pd.DataFrame:
        total = np.zeros(BUCKETS // _SLICES, np.int64)
        for part in frame["sums"]:
            total += np.frombuffer(part, np.int64)
        return pd.DataFrame({
            "slice": frame["slice"].iloc[:1], "lot": frame["lot"].iloc[:1],
            "sums": [total.tobytes()], "seen": [int(frame["seen"].sum())],
        })

    schema = "slice int, lot int, sums binary, seen long"
    sums = docs.select("text").mapInArrow(count, schema).groupBy("slice", "lot").applyInPandas(add, schema)
    rows = sorted(tuple(r) for r in sums.groupBy("slice").applyInPandas(add, schema).drop("lot").collect())
    if not rows:
        return np.zeros(BUCKETS, np.int64), 0
    return np.concatenate([np.frombuffer(r[1], np.int64) for r in rows]), sum(r[2] for r in rows)


class Weights:
    """TF-IDF weight of a shingle: (1 + ln tf) * (1 + RARITY * ln(n / df) / ln n), df that of its bucket."""

    def __init__(self, frequencies: np.ndarray, documents: int) -> None:
        most = np.log(max(documents, 2))
        rare = np.log(max(documents, 1) / np.maximum(frequencies, 1)) / most
        self._factor = (1 + RARITY * np.clip(rare, 0, 1)).astype(np.float32)

    def of(self, hashes: np.ndarray, counts: np.ndarray) -> np.ndarray:
        return (1 + np.log(counts)) * self._factor[(hashes & np.uint64(BUCKETS - 1)).astype(np.int64)]


class Sampler:
    """Consistent samples of weighted sets: equal with probability of the weighted Jaccard similarity.

    For each sample a shingle draws r and c from Gamma(2, 1) and b evenly from its
    hash, and with weight S gets t = floor(ln S / r + b) and
    ln a = ln c - r (t - b + 1); the shingle with the least a is taken, with its t.
    """

    _DRAWS = 1 << 16

    def __init__(self, samples: int) -> None:
        grid = np.linspace(0, 40, 400_001)
        below = 1 - np.exp(-grid) * (1 + grid)
        middle = (np.arange(self._DRAWS) + 0.5) / self._DRAWS
        self._gamma = np.interp(middle, below, grid)
        self._log_gamma = np.log(self._gamma)
        self._even = middle
        self._seeds = mix(np.arange(1, samples + 1, dtype=np.uint64) * np.uint64(0xD1B54A32D192ED03)) | np.uint64(1)

    def draw(self, owner: np.ndarray, hashes: np.ndarray, weights: np.ndarray) -> np.ndarray:
        """One row for each text that has shingles, one column for each sample."""
        heads = np.flatnonzero(np.r_[True, owner[1:] != owner[:-1]])
        sizes = np.diff(np.r_[heads, len(owner)])
        log_weight = np.log(weights)
        low = np.uint64(self._DRAWS - 1)
        out = np.empty((len(heads), len(self._seeds)), np.uint64)
        for column, seed in enumerate(self._seeds):
            draw = hashes * seed
            draw ^= draw >> np.uint64(32)
            draw *= np.uint64(0x94D049BB133111EB)
            draw ^= draw >> np.uint64(29)
            r = self._gamma[draw & low]
            b = self._even[(draw >> np.uint64(16)) & low]
            t = np.floor(log_weight / r + b)
            a = self._log_gamma[(draw >> np.uint64(32)) & low] - r * (t - b + 1)
            least = np.minimum.reduceat(a, heads)
            best = np.flatnonzero(a == np.repeat(least, sizes))
            best = best[np.searchsorted(best, heads)]
            out[:, column] = mix(hashes[best] + t[best].astype(np.int64).astype(np.uint64) * seed)
        return out


def weighted_jaccard(a: tuple[np.ndarray, np.ndarray], b: tuple[np.ndarray, np.ndarray]) -> float:
    """Of two sets of (hashes in order, weights)."""
    place = np.searchsorted(b[0], a[0])
    place[place == len(b[0])] = 0
    both = np.flatnonzero(b[0][place] == a[0]) if len(b[0]) else np.zeros(0, np.int64)
    shared = float(np.minimum(a[1][both], b[1][place[both]]).sum())
    whole = float(a[1].sum() + b[1].sum()) - shared
    return shared / whole if whole else 0.0


def weighted(hashes: bytes, weights: bytes) -> tuple[np.ndarray, np.ndarray]:
    return np.frombuffer(hashes, np.uint32), np.frombuffer(weights, np.float16).astype(np.float64)


def differences(a: tuple[np.ndarray, np.ndarray], b: tuple[np.ndarray, np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """What a has more than b and what it lacks, as (hashes that tell both apart, weights)."""
    hashes = np.union1d(a[0], b[0])
    gap = np.zeros(len(hashes))
    gap[np.searchsorted(hashes, a[0])] += a[1]
    gap[np.searchsorted(hashes, b[0])] -= b[1]
    some = np.flatnonzero(gap)
    more = gap[some] > 0
    return mix(hashes[some].astype(np.uint64) * np.uint64(2) + more.astype(np.uint64)), np.abs(gap[some])


def middle(sets: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
    """The set in the middle of some: each hash with its median weight, without those that most sets lack."""
    hashes, weights = np.concatenate([h for h, _ in sets]), np.concatenate([w for _, w in sets])
    order = np.lexsort((weights, hashes))
    hashes, weights = hashes[order], weights[order]
    heads = np.flatnonzero(np.r_[True, hashes[1:] != hashes[:-1]][: len(hashes)])
    place = np.diff(np.r_[heads, len(hashes)]) - 1 - len(sets) // 2  # sets that lack the hash come first
    return hashes[heads[place >= 0]], weights[(heads + place)[place >= 0]]


def shared_weights(held: DataFrame) -> DataFrame:
    """(node, whole, shared): weight of each set, and of its hashes that a set of another label holds too.

    `held` has node, label (long), hashes in order and weights. Hashes are dealt by ranges, in as
    many slices as their bytes ask for, so a slice stays small at any number of sets.
    """
    slices = int(held.agg(F.sum(F.octet_length("hashes"))).first()[0] or 0) // SLICE_BYTES + 1

    def cut(batches):
        edges = (np.arange(1, slices, dtype=np.uint64) << np.uint64(32)) // np.uint64(slices)
        for batch in parted(batches):
            rows = []
            for node, label, hashes, weights in zip(*(batch.column(n).to_pylist() for n in ("node", "label", "hashes", "weights"))):
                ends = [0, *np.searchsorted(np.frombuffer(hashes, np.uint32), edges).tolist(), len(hashes) // 4]
                rows += [(s, node, label, hashes[4 * a : 4 * b], weights[2 * a : 2 * b]) for s, (a, b) in enumerate(zip(ends, ends[1:])) if a < b]
            if rows:
                kinds = (pa.int32(), pa.string(), pa.int64(), pa.binary(), pa.binary())
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names=["slice", "node", "label", "hashes", "weights"]
                )

    def summed(frame: pd.DataFrame) -> pd.DataFrame:
        hashes, weights = weighted(b"".join(frame["hashes"]), b"".join(frame["weights"]))
        counts = frame["hashes"].map(len).to_numpy() // 4
        row = np.repeat(np.arange(len(frame)), counts)
        order = np.argsort(hashes, kind="stable")
        hashes, labels = hashes[order], np.repeat(frame["label"].to_numpy(), counts)[order]
        heads = np.flatnonzero(np.r_[True, hashes[1:] != hashes[:-1]])
        several = np.minimum.reduceat(labels, heads) != np.maximum.reduceat(labels, heads)
        several = np.repeat(several, np.diff(np.r_[heads, len(hashes)]))
        shared = np.bincount(row[order], weights[order] * several, len(frame))
        return pd.DataFrame({"node": frame["node"], "whole": np.bincount(row, weights, len(frame)), "shared": shared})

    parts = held.mapInArrow(cut, "slice int, node string, label long, hashes binary, weights binary")
    sums = parts.groupBy("slice").applyInPandas(summed, "node string, whole double, shared double")
    return sums.groupBy("node").agg(F.sum("whole").alias("whole"), F.sum("shared").alias("shared"))


def components(edges: DataFrame) -> DataFrame:
    """(node, label): the least node that links lead to, for every node of `edges` (a, b).

    Labels spread to neighbours and jump to the label's own label until none changes;
    each step is written to the shared folder.
    """
    both = stage(edges.union(edges.select("b", "a")).distinct().toDF("a", "b"), "links")
    labels = stage(both.groupBy("a").agg(F.least(F.col("a"), F.min("b")).alias("label")).withColumnRenamed("a", "node"), "labels")
    while True:
        near = both.join(labels.toDF("b", "label"), "b").groupBy("a").agg(F.min("label").alias("least"))
        spread = labels.join(near, labels["node"] == near["a"]).select(
            "node", F.col("label").alias("old"), F.least("label", "least").alias("label")
        )
        jump = labels.toDF("label", "further")
        moved = stage(
            spread.join(jump, "label", "left").select("node", "old", F.coalesce(F.least("label", "further"), "label").alias("label")),
            "labels",
        )
        labels = moved.select("node", "label")
        if moved.where("old <> label").isEmpty():
            return labels


def near_duplicates(
    docs: DataFrame,
    threshold: float = 0.8,
    words: int = 5,
    bands: int = 10,
    rows: int = 3,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """Class of each document: equal texts, and texts that links of weighted Jaccard >= `threshold` join.

    Returns one row for each input row: the id, `text_key` (digest of the text),
    `class_id` (the least id of the class) and `kept` (true for one text of each
    class, that of the least id).

    Shingles are `words` words; a shorter text with any word is one shingle. Texts
    that share the samples of a whole band meet in a bucket. In each bucket all
    members are compared with a leader, and in buckets of up to `SMALL` members all
    pairs of different components. There the member with the fullest buckets leads,
    in larger ones the member most like the middle of `SPEAKERS` such members: what
    sets a leader apart from the others would be common to all differences from it,
    and deal them together. A larger
    bucket in which several components remain is dealt anew by what sets its
    members apart from the leader, more and less alike: if two texts link at 0.8 but
    neither links to the leader, their differences from it have a weighted Jaccard
    similarity of 2/7 or more (of a third, if the leader weighs no less than they do).
    Of a text that links to the leader and one that does not, the similarity is at
    least 1 - D/B (D the distance of both, B that of the leader and the second, as
    (1 - s) / (1 + s) for texts of equal weight), so such a pair can be missed if the
    second has a similarity to the leader just below 0.8. Samples of the differences,
    in `APART_BANDS` bands of `APART_ROWS`, find such pairs; in their buckets 1, 4, 16, ... members lead until every pair of
    different components has been compared. Members far from the leader, and those
    near enough to it to link to such a member, are dealt by further samples of their
    own, in longer keys of `FAR_ROWS`, and compared in the same way. No bucket is cut off.

    Before this, texts and pairs leave large buckets that cannot link whatever else they
    hold: what a text shares with texts of other components (`shared_weights`) bounds the
    weight that it shares with any one of them, and a link needs t / (1 + t) of the weight
    of both texts. So far copies whose differences are their own are never paired.

    Equal texts are one node before any of this. A missing text equals other
    missing texts; texts without words link to equal texts only. Repeated rows have
    a row each. Missing ids come after all others. An empty table gives an empty
    table. Other columns are not kept.
    """
    spark = docs.sparkSession
    ship(spark)
    read = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    held = spark.sparkContext.broadcast(Weights(*document_frequencies(read, words)))

    def sampled(batches):
        sampler, weights = Sampler(bands * rows), held.value
        band_seed = mix(np.arange(1, rows + 1, dtype=np.uint64)) | np.uint64(1)
        for batch in parted(batches):
            texts = [b"" if t is None else t.encode() for t in batch.column("text").to_pylist()]
            out: list = [None] * len(texts)
            for lot in lots(map(len, texts)):
                owner, hashes, counts = shingles(texts[lot], words)
                if not len(owner):
                    continue
                draws = sampler.draw(owner, hashes, weights.of(hashes, counts))
                keys = mix((draws.reshape(len(draws), bands, rows) * band_seed).sum(axis=2, dtype=np.uint64)).view(np.int64)
                for text, key in zip(np.unique(owner).tolist(), keys.tolist()):
                    out[lot.start + text] = key
            yield pa.RecordBatch.from_arrays(
                [batch.column("id"), batch.column("key"), pa.array(out, pa.list_(pa.int64()))], names=["id", "key", "bands"]
            )

    def weighed(batches):
        weights = held.value
        for batch in parted(batches):
            texts = [b"" if t is None else t.encode() for t in batch.column("text").to_pylist()]
            sets: list = [(b"", b"")] * len(texts)
            for lot in lots(map(len, texts)):
                owner, hashes, counts = shingles(texts[lot], words)
                heads = np.flatnonzero(np.r_[True, owner[1:] != owner[:-1]]) if len(owner) else []
                weight = weights.of(hashes, counts).astype(np.float16)
                ends = [*heads[1:], len(owner)] if len(owner) else []
                for a, b in zip(heads, ends):
                    sets[lot.start + int(owner[a])] = ((hashes[a:b] >> np.uint64(32)).astype(np.uint32).tobytes(), weight[a:b].tobytes())
            yield pa.RecordBatch.from_arrays(
                [batch.column("key"), pa.array([s[0] for s in sets], pa.binary()), pa.array([s[1] for s in sets], pa.binary())],
                names=["node", "hashes", "weights"],
            )

    def verified(batches):
        for batch in parted(batches):
            columns = [batch.column(n).to_pylist() for n in ("hashes_a", "weights_a", "hashes_b", "weights_b")]
            close = [weighted_jaccard(weighted(ha, wa), weighted(hb, wb)) >= threshold for ha, wa, hb, wb in zip(*columns)]
            yield batch.select(["a", "b"]).filter(pa.array(close, pa.bool_()))

    # distances 1 - similarity obey the triangle inequality: who links to a member below APART_FROM is below this
    far_from = APART_FROM + 1 - threshold
    far_bands = int(np.ceil(np.log(FAR_LOSS) / np.log1p(-min(max(threshold, 0.3), 0.99) ** FAR_ROWS)))

    def further(batches):
        """Band values of each text's own samples, in longer keys than those of the first buckets."""
        sampler = Sampler(far_bands * FAR_ROWS)
        band_seed = mix(np.arange(1, FAR_ROWS + 1, dtype=np.uint64)) | np.uint64(1)
        for batch in parted(batches):
            names, own = batch.column("node").to_pylist(), batch.column("own").to_pylist()
            columns = [batch.column(n).to_pylist() for n in ("hashes", "weights")]
            for lot in lots(map(len, columns[0])):
                some = [weighted(h, w) for h, w in zip(*(c[lot] for c in columns))]
                owner = np.repeat(np.arange(len(some)), [len(h) for h, _ in some])
                draws = sampler.draw(owner, mix(np.concatenate([h for h, _ in some]).astype(np.uint64)), np.concatenate([w for _, w in some]))
                values = mix((draws.reshape(len(draws), far_bands, FAR_ROWS) * band_seed).sum(axis=2, dtype=np.uint64)).view(np.int64)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([n for n in names[lot] for _ in range(far_bands)]), pa.array(np.repeat(own[lot], far_bands), pa.int64()),
                     pa.array(np.tile(np.arange(far_bands, dtype=np.int32), len(some))), pa.array(values.ravel())],
                    names=["node", "own", "band", "value"],
                )

    def apart(batches):
        """Band values of each text's differences from its leader: what it has more, and what it has less.

        A text far from its leader has a row of band -1.
        """
        sampler = Sampler(APART_BANDS * APART_ROWS)
        band_seed = mix(np.arange(1, APART_ROWS + 1, dtype=np.uint64)) | np.uint64(1)
        for batch in parted(batches):
            names, own, leaders = (batch.column(n).to_pylist() for n in ("a", "own", "b"))
            columns = [batch.column(n).to_pylist() for n in ("hashes_a", "weights_a", "hashes_b", "weights_b")]
            for lot in lots([len(h) + len(g) for h, g in zip(columns[0], columns[2])]):
                owner, keys, weights, far = [], [], [], []
                for row, (ha, wa, hb, wb) in enumerate(zip(*(c[lot] for c in columns))):
                    one, leader = weighted(ha, wa), weighted(hb, wb)
                    alike = weighted_jaccard(one, leader)
                    if alike < far_from:
                        far.append(lot.start + row)
                    if alike < APART_FROM:
                        continue
                    key, more = differences(one, leader)
                    owner.append(np.full(len(key), row))
                    keys.append(key)
                    weights.append(more)
                if far:
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([names[r] for r in far]), pa.array([own[r] for r in far], pa.int64()), pa.array([leaders[r] for r in far]),
                         pa.array([-1] * len(far), pa.int32()), pa.array([0] * len(far), pa.int64())],
                        names=["node", "own", "leader", "band", "value"],
                    )
                if not sum(map(len, owner)):
                    continue
                owner, keys = np.concatenate(owner), np.concatenate(keys)
                draws = sampler.draw(owner, keys, np.concatenate(weights))
                values = mix((draws.reshape(len(draws), APART_BANDS, APART_ROWS) * band_seed).sum(axis=2, dtype=np.uint64)).view(np.int64)
                rows_ = np.unique(owner)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([names[lot.start + r] for r in rows_ for _ in range(APART_BANDS)]),
                     pa.array(np.repeat([own[lot.start + r] for r in rows_], APART_BANDS), pa.int64()),
                     pa.array([leaders[lot.start + r] for r in rows_ for _ in range(APART_BANDS)]),
                     pa.array(np.tile(np.arange(APART_BANDS, dtype=np.int32), len(rows_))), pa.array(values.ravel())],
                    names=["node", "own", "leader", "band", "value"],
                )

    kind = docs.schema[id_col].dataType.simpleString()
    keyed = read.withColumn("key", digest(F.col("text")))
    signed = stage(keyed.mapInArrow(sampled, f"id {kind}, key string, bands array<long>"), "samples")
    order = F.struct(F.col("id").isNull().alias("late"), F.col("id").alias("id"), F.col("key").alias("key"))
    nodes = signed.groupBy("key").agg(F.min(order).alias("first"), F.first("bands").alias("bands"))
    members = nodes.select("first", F.posexplode("bands").alias("band", "value"), F.col("key").alias("node"))
    sizes = members.groupBy("band", "value").agg(F.count(F.lit(1)).alias("size")).where("size > 1")
    met = stage(members.join(sizes, ["band", "value"]), "buckets")

    wanted = met.groupBy("node").agg(F.first("first.id").alias("id"))
    sets = stage(
        keyed.join(wanted, keyed["id"].eqNullSafe(wanted["id"]) & (keyed["key"] == wanted["node"]))
        .select("key", "text").mapInArrow(weighed, "node string, hashes binary, weights binary"),
        "shingle-sets",
    )
    def compared(pairs: DataFrame, names: str = "hashes weights") -> DataFrame:
        """Pairs (a, b), with what else they carry, beside the sets of both."""
        columns = names.split()
        left = sets.toDF("a", *[f"{c}_a" for c in columns])
        right = sets.toDF("b", *[f"{c}_b" for c in columns])
        return pairs.join(left, "a").join(right, "b").select(*pairs.columns, *[f"{c}_{side}" for side in "ab" for c in columns])

    def central(buckets: DataFrame) -> DataFrame:
        """Buckets with how full a member's buckets are together; of buckets with the same members one stays."""
        weight = buckets.groupBy("node").agg(F.sum("size").alias("central"))
        sums = [F.bit_xor(F.xxhash64(F.lit(seed), "node")).alias(f"__sum{seed}") for seed in (1, 2)]
        members = buckets.groupBy("band", "value", "size").agg(*sums)
        once = members.groupBy("size", "__sum1", "__sum2").agg(F.min(F.struct("band", "value")).alias("one")).select("one.*")
        buckets = buckets.join(once, ["band", "value"])
        return stage(buckets.join(weight, "node").select("band", "value", "node", "size", "central"), "buckets")

    def spoken(frame: pd.DataFrame) -> pd.DataFrame:
        hashes, weights = middle([weighted(h, w) for h, w in zip(frame["hashes"], frame["weights"])])
        return pd.DataFrame({
            "band": frame["band"].iloc[:1], "value": frame["value"].iloc[:1],
            "hashes_b": [hashes.tobytes()], "weights_b": [weights.astype(np.float16).tobytes()],
        })

    def likened(batches):
        for batch in parted(batches):
            columns = [batch.column(n).to_pylist() for n in ("hashes", "weights", "hashes_b", "weights_b")]
            alike = [weighted_jaccard(weighted(ha, wa), weighted(hb, wb)) for ha, wa, hb, wb in zip(*columns)]
            yield batch.select(["band", "value", "node", "size", "central"]).append_column("alike", pa.array(alike, pa.float64()))

    def typical(buckets: DataFrame) -> DataFrame:
        """Buckets with how alike (`alike`) a member of a large one is to the set in the middle of some members."""
        large = buckets.where(F.col("size") > SMALL)
        turn = F.row_number().over(Window.partitionBy("band", "value").orderBy(F.desc("central"), "node"))
        some = large.withColumn("turn", turn).where(F.col("turn") <= SPEAKERS).select("band", "value", "node").join(sets, "node")
        middles = stage(
            some.groupBy("band", "value").applyInPandas(spoken, "band int, value long, hashes_b binary, weights_b binary"), "middles"
        )
        told = large.join(sets, "node").join(middles, ["band", "value"]).mapInArrow(
            likened, "band int, value long, node string, size long, central long, alike double"
        )
        return stage(told.unionByName(buckets.where(F.col("size") <= SMALL).withColumn("alike", F.lit(0.0))), "buckets")

    def mixed(buckets: DataFrame, labels: DataFrame | None) -> DataFrame:
        """Members of buckets that hold several components, with their labels."""
        now = buckets.withColumn("label", F.col("node")) if labels is None else buckets.join(
            labels, "node", "left").withColumn("label", F.coalesce("label", "node"))
        several = (
            now.groupBy("band", "value").agg(F.min("label").alias("low"), F.max("label").alias("high"))
            .where("low <> high").select("band", "value")
        )
        return stage(now.join(several, ["band", "value"]), "open-buckets")

    def able(buckets: DataFrame) -> DataFrame:
        """Members that some member of their bucket could link to: a link needs a partner not heavier than `reach`."""
        ends = buckets.groupBy("band", "value").agg(F.min("whole").alias("least"), F.max("reach").alias("most"))
        return buckets.join(ends, ["band", "value"]).where("reach >= least and most >= whole").drop("least", "most")

    by_centre = Window.partitionBy("band", "value").orderBy(F.desc("alike"), F.desc("central"), "node")

    def led(live: DataFrame, tried: int, leaders: int) -> DataFrame:
        """Members beside new leaders; with bounds, those that could link."""
        bounds = [c for c in ("whole", "reach") if c in live.columns]
        leading = (
            live.withColumn("turn", F.row_number().over(by_centre)).where(F.col("turn") <= leaders).where(F.col("turn") > tried)
            .select("band", "value", F.col("node").alias("b"), F.col("label").alias("label_b"), *[F.col(c).alias(f"{c}_b") for c in bounds])
        )
        pairs = live.select("band", "value", F.col("node").alias("a"), "label", *bounds).join(leading, ["band", "value"])
        return pairs.where("reach >= whole_b and reach_b >= whole") if bounds else pairs

    tested: list[DataFrame] = []

    def linked(live: DataFrame, labels: DataFrame | None, tried: int, leaders: int) -> DataFrame | None:
        """Labels after all members of `live` have been compared with new leaders of other components, no pair twice."""
        pairs = led(live, tried, leaders).where("label <> label_b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()
        if tested:
            pairs = pairs.join(reduce(DataFrame.unionByName, tested), ["a", "b"], "left_anti")
        pairs = stage(pairs, "pairs")
        tested.append(pairs)
        close = stage(compared(pairs).mapInArrow(verified, "a string, b string"), "close")
        if close.isEmpty():
            return labels
        if labels is None:
            return components(close)

        def label_of(side: str) -> DataFrame:
            return labels.toDF(side, f"label_{side}")

        between = close.join(label_of("a"), "a", "left").join(label_of("b"), "b", "left").select(
            F.coalesce("label_a", "a").alias("a"), F.coalesce("label_b", "b").alias("b")
        ).where("a <> b")
        merged = components(between)
        older = labels.join(merged.toDF("label", "new"), "label", "left").select("node", F.coalesce("new", "label").alias("label"))
        return stage(older.unionByName(merged.join(labels, "node", "left_anti")), "labels")

    met = typical(central(met))
    labels = linked(mixed(met, None), None, 0, 1)
    live = mixed(met, labels)
    small = live.where(F.col("size").between(3, SMALL))
    if not small.isEmpty():
        labels = linked(small, labels, 1, SMALL)

    large = mixed(met.where(F.col("size") > SMALL), labels)
    if not large.isEmpty():
        leading = large.withColumn("turn", F.row_number().over(by_centre)).where("turn = 1").select("band", "value", F.col("node").alias("b"))
        held = stage(large.select("node", F.xxhash64("label").alias("label")).distinct().join(sets, "node"), "held")
        # whoever links to a text of weight `whole` shares t / (1 + t) of both weights with it; the rest is for rounding
        reach = (F.col("shared") * ((1 + threshold) / threshold) - F.col("whole") + F.col("whole") * 1e-9).alias("reach")
        bounds = stage(shared_weights(held).select("node", "whole", reach).where(F.col("reach") >= F.col("whole") * (threshold - 1e-9)), "bounds")
        large = mixed(able(large.drop("label").join(bounds, "node")).drop("whole", "reach"), labels)
        followers = large.select("band", "value", F.col("node").alias("a"), F.xxhash64("label").alias("own"))
        pairs = followers.join(leading, ["band", "value"]).where("a <> b").select("a", "b", "own").distinct()
        dealt = stage(compared(pairs).mapInArrow(apart, "node string, own long, leader string, band int, value long"), "apart")
        far = dealt.where("band < 0").select("node", "own").distinct().join(sets, "node")
        far = far.mapInArrow(further, "node string, own long, band int, value long")
        far = stage(far.select((F.col("band") + APART_BANDS).alias("band"), "value", "node", "own"), "further")
        dealt = dealt.where("band >= 0").select("band", F.xxhash64("leader", "value").alias("value"), "node", "own").unionByName(far)
        # buckets of one component are left out before their rows are joined with anything
        counts = dealt.groupBy("band", "value").agg(F.count(F.lit(1)).alias("size"), F.min("own").alias("low"), F.max("own").alias("high"))
        counts = counts.where("low <> high").select("band", "value", "size")
        met = central(dealt.drop("own").join(counts, ["band", "value"])).withColumn("alike", F.lit(0.0))
        met = stage(able(met.join(bounds, "node")), "buckets")
        leaders, tried = 1, 0
        while True:
            # a bucket whose members have all led, but for one, holds no pair that was not compared
            live = mixed(met.where(F.col("size") > tried + 1), labels)
            if live.isEmpty():
                break
            labels = linked(live, labels, tried, leaders)
            tried, leaders = leaders, leaders * 4

    firsts = nodes.select(F.col("key").alias("node"), "first")
    if labels is None:
        classes = firsts.select("node", F.col("first").alias("class"))
    else:
        labelled = firsts.join(labels, "node", "left").withColumn("label", F.coalesce("label", "node"))
        best = labelled.groupBy("label").agg(F.min("first").alias("class"))
        classes = labelled.join(best, "label").select("node", "class")
    return signed.join(classes, signed["key"] == classes["node"]).select(
        F.col("id").alias(id_col), F.col("key").alias("text_key"), F.col("class.id").alias("class_id"),
        (F.col("id").eqNullSafe(F.col("class.id")) & (F.col("key") == F.col("class.key"))).alias("kept"),
    )


def without_near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **settings) -> DataFrame:
    """One row of each class of near-duplicates, that of the least id, with all its columns.

    Of rows that share id and text one stays. Other columns may have any names.
    """
    found = near_duplicates(docs, id_col=id_col, text_col=text_col, **settings)
    found = found.where("kept").groupBy(F.col(id_col).alias("id"), F.col("text_key").alias("key")).agg(F.count(F.lit(1)).alias("copies"))
    found = stage(found, "kept")
    row = F.struct(*[F.col(f"`{name}`") for name in docs.columns]).alias("row")
    rows = docs.select(row, F.col(id_col).alias("own_id"), digest(F.col(text_col)).alias("own_key"))
    kept = rows.join(found, rows["own_id"].eqNullSafe(found["id"]) & (rows["own_key"] == found["key"]))
    if not found.where("copies > 1").isEmpty():
        kept = kept.dropDuplicates(["id", "key"])
    return kept.select("row.*")
