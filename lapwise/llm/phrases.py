"""Phrase collocations: dynamic itemset counting over cyclic scans of shards, scored by their weakest cut."""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from lapwise.llm.common import LOT_BYTES, PrefixHash, lots, mix, ship, stage
from lapwise.session import parallel_pieces, shared_folder

#: Bits of one block of a filter, phrases counted on for each block, and the most blocks (64 MB).
BLOCK_BITS, BLOCK_KEYS, MOST_BLOCKS = 1 << 19, 1 << 15, 1 << 10
#: Text bytes tokenised at once.
TEXT_LOT = 4 * LOT_BYTES
#: Counts a task gathers before it hands them on; text bytes for each bucket of hashes, and the least number of buckets.
HELD_COUNTS, BUCKET_BYTES, LEAST_BUCKETS = 1 << 20, 8 << 20, 64
_STEP = np.uint64(0x9FB21C651E98DF25)
_ODD = np.uint64(0xD6E8FEB86659FD93)
# Classes of bytes: 0 in a word, 1 between words, 2 between pieces; A-Z are lowered and tabs become blanks.
_CLASS = np.zeros(256, np.uint8)
_CLASS[[0x20, 0x09]] = 1
_ENDS = [bytes([b]) for b in (*b".,;:!?", 0x0A, 0x0B, 0x0C, 0x0D)]
_CLASS[[end[0] for end in _ENDS]] = 2
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[0x41:0x5B] += 32


def _block(hashes: np.ndarray, blocks: int) -> np.ndarray:
    return ((hashes >> np.uint64(32)) * np.uint64(blocks) >> np.uint64(32)).astype(np.int64)


def _bits(hashes: np.ndarray) -> tuple[np.ndarray, ...]:
    """Three places inside a block."""
    low = np.uint64(BLOCK_BITS - 1)
    return hashes & low, (hashes >> np.uint64(19)) & low, (hashes * _ODD) >> np.uint64(45)


class Filter:
    """A blocked Bloom filter: says yes to every hash put into it, and to few others."""

    def __init__(self, blocks: int) -> None:
        self.bytes = np.zeros((blocks, BLOCK_BITS // 8), np.uint8)

    def put(self, block: int, data: bytes) -> None:
        self.bytes[block] |= np.frombuffer(data, np.uint8)

    def has(self, hashes: np.ndarray) -> np.ndarray:
        flat, base = self.bytes.reshape(-1), _block(hashes, len(self.bytes)) * (BLOCK_BITS // 8)
        found = np.ones(len(hashes), np.bool_)
        for bit in _bits(hashes):
            found &= flat[base + (bit >> np.uint64(3)).astype(np.int64)] >> (bit & np.uint64(7)).astype(np.uint8) & 1 == 1
        return found


def block_bytes(hashes: np.ndarray) -> bytes:
    """The block that holds these hashes."""
    block = np.zeros(BLOCK_BITS, np.bool_)
    for bit in _bits(hashes):
        block[bit.astype(np.int64)] = True
    return np.packbits(block, bitorder="little").tobytes()


def _filters(hashes: DataFrame, wanted: dict[tuple[int, int], int]) -> dict[tuple[int, int], Filter]:
    """Filters built block by block on the cluster, in one job.

    `hashes` has `length`, `turn` and `hash`; `wanted` has the number of hashes for
    each (length, turn from which on they count). The size of a filter does not pass
    `MOST_BLOCKS`; beyond that it says yes more often, which costs work and no result.
    """
    out = {name: Filter(min(MOST_BLOCKS, -(-count // BLOCK_KEYS))) for name, count in wanted.items()}
    sizes = [(number, *name, len(made.bytes)) for number, (name, made) in enumerate(out.items())]

    def blocked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            length, turn, values = (batch.column(c).to_numpy() for c in ("length", "turn", "hash"))
            for number, asked, since, blocks in sizes:
                some = values[(length == asked) & (turn >= since)]
                block = _block(some.view(np.uint64), blocks).astype(np.int32)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(len(some), number, np.int32)), pa.array(block), pa.array(some)], names=["filter", "block", "hash"])

    def built(key: tuple[pa.Scalar, ...], rows: pa.Table) -> pa.Table:
        data = block_bytes(rows.column("hash").to_numpy().view(np.uint64))
        return pa.table({"filter": pa.array([key[0].as_py()], pa.int32()), "block": pa.array([key[1].as_py()], pa.int32()),
                         "data": pa.array([data], pa.binary())})

    rows = hashes.mapInArrow(blocked, "filter int, block int, hash long").groupBy("filter", "block").applyInArrow(
        built, "filter int, block int, data binary")
    made = list(out.values())
    for row in rows.collect():  # at most `MOST_BLOCKS` of each filter
        made[row["filter"]].put(row["block"], bytes(row["data"]))
    return out


class Tokens:
    """Words of a lot of texts: where they are, the piece they stand in, hashes of words and phrases with their language."""

    def __init__(self, texts: list[bytes], langs: np.ndarray) -> None:
        data = np.frombuffer(b"\n".join(texts) + b"\n", np.uint8)
        starts = np.cumsum([0] + [len(t) + 1 for t in texts])
        kind = _CLASS[data]
        inside = np.zeros(len(data) + 1, np.bool_)
        inside[1:] = kind == 0
        opens = np.flatnonzero(inside[1:] & ~inside[:-1])
        closes = np.flatnonzero(inside[:-1] & ~inside[1:])  # the byte after a word
        self.owner = np.searchsorted(starts, opens, side="right") - 1
        self.piece = np.cumsum(kind == 2)[opens] if len(opens) else opens
        data = _LOWER[data]
        self.words = mix(PrefixHash(data).between(opens, closes) + langs[self.owner])
        # words with one blank between them, so that a phrase is one stretch of bytes
        keep = inside[1:].copy()
        keep[closes] = True
        data[closes] = 0x20
        place = np.cumsum(keep) - 1
        self.data, self.opens, self.closes = data[keep], place[opens], place[closes]

    def longer(self, at: np.ndarray, hashes: np.ndarray, words: int) -> tuple[np.ndarray, np.ndarray]:
        """Places of `at` where a phrase of `words` words begins, and its hash, from the hashes of one word less."""
        fits = at + words - 1 < len(self.words)
        fits[fits] = self.piece[at[fits]] == self.piece[at[fits] + words - 1]
        at, hashes = at[fits], hashes[fits]
        return at, mix(hashes * _STEP + self.words[at + words - 1])

    def texts(self, at: np.ndarray, words: int) -> pa.Array:
        """Phrases as strings."""
        begin, end = self.opens[at], self.closes[at + words - 1]
        offsets = np.zeros(len(at) + 1, np.int64)
        np.cumsum(end - begin, out=offsets[1:])
        source = np.repeat(begin - offsets[:-1], end - begin) + np.arange(offsets[-1])
        return pa.Array.from_buffers(pa.large_string(), len(at), [None, pa.py_buffer(offsets), pa.py_buffer(self.data[source])]).cast(pa.string())


def counted(tokens: Tokens, words: bool, filters: dict[int, tuple[Filter, Filter]]) -> Iterator[tuple[int, np.ndarray, np.ndarray, np.ndarray]]:
    """(length, first places, hashes, counts) of the phrases of a lot that are counted in this scan.

    A phrase is counted if both phrases of one word less have reached the threshold,
    one of them lately.
    """
    at, hashes = np.arange(len(tokens.words)), tokens.words
    if words and len(at):
        yield 1, *_grouped(at, hashes)
    for length in range(2, max(filters, default=1) + 1):
        shorter = np.zeros(len(tokens.words), np.uint64)
        shorter[at] = hashes
        at, hashes = tokens.longer(at, hashes, length)
        if length not in filters:
            continue
        reached, lately = filters[length]
        left, right = shorter[at], shorter[at + 1]
        live = reached.has(left)
        live[live] = reached.has(right[live])
        if lately is not reached:
            live[live] = lately.has(left[live]) | lately.has(right[live])
        if live.any():
            yield length, *_grouped(at[live], hashes[live])


def _grouped(at: np.ndarray, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    order = np.argsort(hashes, kind="stable")
    ordered = hashes[order]
    heads = np.flatnonzero(np.r_[True, ordered[1:] != ordered[:-1]])
    return at[order[heads]], ordered[heads], np.diff(np.r_[heads, len(ordered)])


_SPELLED = "lang string, length int, phrase string, n long"


def phrase_counts(
    docs: DataFrame, longest: int = 4, least: int = 30, shards: int = 2, lang_col: str = "lang", text_col: str = "text"
) -> tuple[DataFrame, DataFrame]:
    """Exact counts of all phrases of up to `longest` words with at least `least` occurrences, and all words of each language.

    Dynamic itemset counting: the documents are dealt to shards, which are scanned
    in a cycle. Words are counted from the first scan on. A longer phrase becomes
    active as soon as the counts so far of both its subphrases (without the last
    and without the first word) have reached `least`, and is counted until it has
    gone through one full cycle, so lengths interleave and no length waits for the
    end of another. Scans end when no phrase has become active in the last cycle.

    A scan knows what is active from two filters for each length, subphrases that
    have reached `least` and those that did so in the last cycle; a filter may say
    yes too often, so a phrase can be counted in a shard twice, with the same
    number, of which one is taken. The scans count 64-bit hashes of language and
    phrase, whose collisions can only make a phrase active too early. A last pass
    over the documents spells the phrases whose hash came to `least` and counts
    these by their letters, so the result does not rest on hashes.

    Returns (`lang`, `length`, `phrase`, `f`) and (`lang`, `n`).
    """
    spark = docs.sparkSession
    ship(spark)
    text = F.encode(F.coalesce(F.col(text_col), F.lit("")), "UTF-8").alias("text")
    lang = F.coalesce(F.col(lang_col).cast("string"), F.lit("und")).alias("lang")
    dealt = docs.select(lang, text).where(F.octet_length("text") > 0)
    parts = _dealt(dealt, shards)
    size = reduce(DataFrame.unionByName, parts).agg(F.sum(F.octet_length("text").cast("long"))).first()[0] or 0
    buckets = max(LEAST_BUCKETS, -(-size // BUCKET_BYTES))
    scans: list[tuple[int, int, DataFrame, list[int]]] = []
    news: list[tuple[DataFrame, dict[int, int]]] = []
    turn = 0
    while True:
        filters = _active(news, turn, shards, longest)
        lengths = ([1] if turn < shards else []) + list(filters)
        if not lengths:
            break
        number = turn % shards
        found = stage(_scan(spark, parts[number], turn < shards, filters, buckets), f"scan-{turn}")
        scans.append((turn, number, found, lengths))
        news.append(_reached(scans, least, longest))
        turn += 1
    every = _frequent([(t, s, rows) for t, s, rows, _ in scans], least, False)
    often = stage(every.select("length", F.lit(0).alias("turn"), "hash"), "often")
    wanted = {(r["length"], 0): r["count"] for r in often.groupBy("length").count().collect()}
    spelled = stage(_spelled(spark, reduce(DataFrame.unionByName, parts), _filters(often, wanted) if wanted else {}, least, buckets), "spelled")
    frequent = spelled.where(F.col("length") > 0).withColumnRenamed("n", "f")
    return frequent, spelled.where("length = 0").groupBy("lang").agg(F.sum("n").alias("n"))


def _dealt(docs: DataFrame, shards: int) -> list[DataFrame]:
    """Rows in turn to shards, each stored in a folder of its own."""
    spark = docs.sparkSession
    path = f"{shared_folder(spark)}/shards-{uuid.uuid4().hex}"
    turned = docs.withColumn("shard", (F.monotonically_increasing_id() % shards).cast("int"))
    turned.write.partitionBy("shard").parquet(path)
    kept = spark.read.schema(turned.schema).parquet(path)
    return [kept.where(F.col("shard") == number).drop("shard") for number in range(shards)]


def _summed(hashes: list[np.ndarray], counts: list[np.ndarray], add: np.ufunc = np.add) -> tuple[np.ndarray, np.ndarray]:
    """Each hash once, in order, with its counts put together."""
    every, n = np.concatenate([np.zeros(0, np.uint64), *hashes]), np.concatenate([np.zeros(0, np.int64), *counts])
    order = np.argsort(every, kind="stable")  # a merge, as the parts are sorted
    every, n = every[order], n[order]
    heads = np.flatnonzero(np.r_[True, every[1:] != every[:-1]])[: len(every)]
    return every[heads], add.reduceat(n, heads) if len(heads) else n


def _table(length, bucket, hashes: list[np.ndarray], counts: list[np.ndarray]) -> dict[str, pa.Array]:
    return {"length": pa.array(length, pa.int32()), "bucket": pa.array(bucket, pa.int32()),
            "hashes": pa.array([h.tobytes() for h in hashes], pa.binary()), "counts": pa.array([c.tobytes() for c in counts], pa.binary())}


def _arrays(rows: pa.Table) -> tuple[list[np.ndarray], list[np.ndarray]]:
    return ([np.frombuffer(b, np.uint64) for b in rows.column("hashes").to_pylist()],
            [np.frombuffer(b, np.int64) for b in rows.column("counts").to_pylist()])


_COUNTS = "length int, bucket int, hashes binary, counts binary"


def _scan(spark: SparkSession, part: DataFrame, words: bool, filters: dict[int, tuple[Filter, Filter]], buckets: int) -> DataFrame:
    """Counts of one scan: for each length and bucket of hashes a row of sorted hashes and their counts.

    Tasks put the counts of several lots together, and hand on one row for each
    bucket. Buckets grow in number with the text, so their size is bounded.
    """
    shared = spark.sparkContext.broadcast(filters)

    def handed(length: int, held: list[tuple[np.ndarray, np.ndarray]]) -> pa.RecordBatch:
        hashes, n = _summed([h for h, _ in held], [c for _, c in held])
        bucket = _block(hashes, buckets)
        heads = np.flatnonzero(np.r_[True, bucket[1:] != bucket[:-1]])
        ends = [*heads[1:], len(bucket)]
        return pa.RecordBatch.from_pydict(_table(
            np.full(len(heads), length, np.int32), bucket[heads].astype(np.int32),
            [hashes[a:b] for a, b in zip(heads, ends)], [n[a:b] for a, b in zip(heads, ends)]))

    def counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, list[tuple[np.ndarray, np.ndarray]]] = {}
        for _, _, tokens in _lots_of(batches):
            for length, _, hashes, n in counted(tokens, words, shared.value):
                some = held.setdefault(length, [])
                some.append((hashes, n))
                if sum(len(h) for h, _ in some) >= HELD_COUNTS:
                    yield handed(length, held.pop(length))
        for length, some in held.items():
            yield handed(length, some)

    def merged(key: tuple[pa.Scalar, ...], rows: pa.Table) -> pa.Table:
        hashes, n = _summed(*_arrays(rows))
        return pa.table(_table([key[0].as_py()], [key[1].as_py()], [hashes], [n]))

    return part.select("lang", "text").mapInArrow(counts, _COUNTS).groupBy("length", "bucket").applyInArrow(merged, _COUNTS)


def _spelled(spark: SparkSession, docs: DataFrame, often: dict[tuple[int, int], Filter], least: int, buckets: int) -> DataFrame:
    """Phrases whose hashes are in the filters and that occur `least` times, by their letters; under length 0, words of each language.

    Tasks hand on one Arrow table for each bucket of hashes; a bucket's tables are
    put together in one task. Words of a language come in one row for each bucket.
    """
    shared = spark.sparkContext.broadcast(often)

    def spelled(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        filters = {length: made for (length, _), made in shared.value.items()}
        own = TaskContext.get().partitionId() % buckets

        def table(names, code, length, phrases, n):
            lang = pa.DictionaryArray.from_arrays(pa.array(code, pa.int32()), pa.array(names, pa.string())).cast(pa.string())
            return pa.RecordBatch.from_arrays([lang, pa.array(np.full(len(n), length, np.int32)), phrases, pa.array(n)],
                                              names=["lang", "length", "phrase", "n"])

        def handed(bucket, tables):
            data = []
            for one in tables:
                sink = pa.BufferOutputStream()
                with pa.ipc.new_stream(sink, one.schema) as out:
                    out.write_batch(one)
                data.append(sink.getvalue().to_pybytes())
            return pa.RecordBatch.from_arrays([pa.array(bucket, pa.int32()), pa.array(data, pa.binary())], names=["bucket", "data"])

        def together(length, held):
            """Phrases of several lots, each hash once, in the order of hashes and so of buckets."""
            hashes, code, n = (np.concatenate([h[i] for h in held]) for i in (0, 1, 3))
            order = np.argsort(hashes, kind="stable")
            heads = np.flatnonzero(np.r_[True, np.diff(hashes[order]) != 0])
            first = order[heads]
            phrases = pa.concat_arrays([h[2] for h in held]).take(pa.array(first))
            every = table(names, code[first], length, phrases, np.add.reduceat(n[order], heads))
            bucket = _block(hashes[first], buckets)
            begins = np.flatnonzero(np.r_[True, bucket[1:] != bucket[:-1]])
            return handed(bucket[begins], [every.slice(a, b - a) for a, b in zip(begins, [*begins[1:], len(bucket)])])

        names, held, words = [], {}, np.zeros(0, np.int64)
        for names, code, tokens in _lots_of(batches):
            n = np.bincount(code[tokens.owner], minlength=len(names))
            n[: len(words)] += words
            words = n
            at, hashes = np.arange(len(tokens.words)), tokens.words
            for length in range(1, max(filters, default=0) + 1):
                if length > 1:
                    at, hashes = tokens.longer(at, hashes, length)
                live = filters[length].has(hashes) if length in filters else np.zeros(len(at), np.bool_)
                at, hashes = at[live], hashes[live]  # what begins with a rare phrase is rare
                if len(at):
                    first, grouped, count = _grouped(at, hashes)
                    some = held.setdefault(length, [])
                    some.append((grouped, code[tokens.owner[first]], tokens.texts(first, length), count))
                    if sum(len(h[0]) for h in some) >= HELD_COUNTS // 4:
                        yield together(length, held.pop(length))
        for length, some in held.items():
            yield together(length, some)
        there = np.flatnonzero(words)
        if len(there):
            yield handed([own], [table(names, there, 0, pa.array([""] * len(there)), words[there])])

    def merged(rows: pa.Table) -> pa.Table:
        every = pa.concat_tables([pa.ipc.open_stream(data).read_all() for data in rows.column("data").to_pylist()])
        once = every.group_by(["lang", "length", "phrase"]).aggregate([("n", "sum")]).rename_columns({"n_sum": "n"})
        kept = pa.compute.or_(pa.compute.greater_equal(once.column("n"), least), pa.compute.equal(once.column("length"), 0))
        return once.filter(kept).select(["lang", "length", "phrase", "n"])

    return docs.mapInArrow(spelled, "bucket int, data binary").groupBy("bucket").applyInArrow(merged, _SPELLED)


def _lots_of(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[list[str], np.ndarray, Tokens]]:
    """Lots of texts: all languages so far, the place in them of each text's, and the words."""
    codes: dict[str, int] = {}
    salts: list[int] = []
    for batch in batches:
        texts, langs = cut_long(batch.column("text").to_pylist(), batch.column("lang").to_pylist())
        for name in langs:
            if name not in codes:
                codes[name] = len(codes)
                salts.append(lang_hash(name))
        code = np.array([codes[name] for name in langs], np.int64)
        salt = np.array(salts, np.uint64)[code]
        for lot in lots(map(len, texts), TEXT_LOT):
            yield list(codes), code[lot], Tokens(texts[lot], salt[lot])


def cut_long(texts: list[bytes], langs: list[str], most: int = TEXT_LOT) -> tuple[list[bytes], list[str]]:
    """Texts of more than `most` bytes cut where a piece ends, which no phrase crosses; a longer piece stays whole."""
    if max(map(len, texts), default=0) <= most:
        return texts, langs
    out: list[bytes] = []
    names: list[str] = []
    for text, name in zip(texts, langs):
        start = 0
        while len(text) - start > most:
            found = max(text.rfind(end, start, start + most) for end in _ENDS)
            if found < 0:
                found = min((at for at in (text.find(end, start + most) for end in _ENDS) if at >= 0), default=len(text) - 1)
            out.append(text[start : found + 1])
            start = found + 1
        out.append(text[start:])
        names += [name] * (len(out) - len(names))
    return out, names


def lang_hash(name: str) -> int:
    """Part of every hash, so that languages are counted apart."""
    return int(PrefixHash(np.frombuffer(name.encode() + b"\0", np.uint8)).rolling(len(name.encode()) + 1)[0])


def _frequent(scans: list[tuple[int, int, DataFrame]], least: int, lately: bool) -> DataFrame:
    """(length, hash) of the phrases whose counts came to `least`; `lately`: in the last of the scans. A shard counts once."""
    last = scans[-1][0]
    rows = reduce(DataFrame.unionByName, [r.withColumns({"shard": F.lit(s), "turn": F.lit(t)}) for t, s, r in scans])

    def total(rows: pa.Table) -> tuple[np.ndarray, np.ndarray]:
        shard, (hashes, counts) = rows.column("shard").to_pylist(), _arrays(rows)
        once = [_summed([h for h, s in zip(hashes, shard) if s == one], [c for c, s in zip(counts, shard) if s == one], np.maximum)
                for one in sorted(set(shard))]
        return _summed([h for h, _ in once], [c for _, c in once])

    def reached(key: tuple[pa.Scalar, ...], rows: pa.Table) -> pa.Table:
        hashes, now = total(rows)
        hashes = hashes[now >= least]
        if lately:
            older, before = total(rows.filter(pa.compute.less(rows.column("turn"), last)))
            hashes = np.setdiff1d(hashes, older[before >= least], assume_unique=True)
        return pa.table({"length": pa.array(np.full(len(hashes), key[0].as_py(), np.int32)), "hash": pa.array(hashes.view(np.int64))})

    return rows.groupBy("length", "bucket").applyInArrow(reached, "length int, hash long")


def _reached(
    scans: list[tuple[int, int, DataFrame, list[int]]], least: int, longest: int
) -> tuple[DataFrame, dict[int, int]]:
    """Hashes of the phrases whose count came to `least` in the last scan, and how many of each length."""
    turn, _, _, lengths = scans[-1]
    open_lengths = F.col("length").isin([n for n in lengths if n < longest])
    rows = _frequent([(t, s, r.where(open_lengths)) for t, s, r, there in scans if set(there) & set(lengths)], least, True)
    new = rows.select("length", F.lit(turn).alias("turn"), "hash")
    new = stage(new, "reached")
    return new, {r["length"]: r["count"] for r in new.groupBy("length").count().collect()}


def _active(
    news: list[tuple[DataFrame, dict[int, int]]], turn: int, shards: int, longest: int
) -> dict[int, tuple[Filter, Filter]]:
    """By length, filters of the subphrases that reached the threshold ever and in the last cycle; none where the last cycle had none."""
    since = max(0, turn - shards)
    wanted = {}
    for length in range(1, longest):
        ever, late = (sum(n.get(length, 0) for _, n in news[start:]) for start in (0, since))
        if late:
            wanted |= {(length, 0): ever, (length, since): late}
    if not wanted:
        return {}
    made = _filters(reduce(DataFrame.unionByName, [rows for rows, _ in news]), wanted)
    return {length + 1: (made[length, 0], made[length, since]) for length in range(1, longest) if (length, since) in made}


def collocations(
    docs: DataFrame, longest: int = 4, least: int = 30, covered: tuple[int, int] = (4, 5), best: int = 2000,
    shards: int = 2, lang_col: str = "lang", text_col: str = "text",
) -> DataFrame:
    """The phrases of each language whose words belong together most, by their weakest cut.

    Texts are lowered in A-Z, cut into pieces at `.,;:!?` and line ends, and these
    into words at blanks and tabs. Phrases of two to `longest` words with `a` of at
    least `least` occurrences are candidates; a phrase cut after its first k words
    into parts that occur `l` and `r` times scores floor(2000000 a / (l + r)), and
    its lowest cut counts, of equals the smallest k. A candidate inside a longer
    one that has at least `covered` (4/5) of its occurrences is left out. Returns
    `lang`, `rank`, `phrase`, `a`, `l`, `r`, `n` (words of the language) and
    `score`, the first `best` of each language by score and `a` descending, then
    phrase in byte order.

    A missing language is `und`. A missing or empty text has no words; repeated
    rows count each. Very long texts are cut where a piece ends. An empty
    table gives an empty table. Other columns are not read. Products are decimals
    of 38 places. The ranking is made in shares of a language first, so no task
    sorts all of its candidates.
    """
    frequent, words = phrase_counts(docs, longest, least, shards, lang_col, text_col)
    big = "decimal(20,0)"
    longer = frequent.where("length > 2").withColumn("w", F.split("phrase", " "))
    inner = F.expr(
        "flatten(transform(sequence(2, length - 1), m -> transform(sequence(1, length - m + 1), i -> array_join(slice(w, i, m), ' '))))"
    )
    around = longer.select("lang", "f", F.explode(inner).alias("phrase")).groupBy("lang", "phrase").agg(F.max("f").alias("outer_f"))
    up, down = covered
    kept = frequent.where("length > 1").join(around, ["lang", "phrase"], "left").where(
        F.col("outer_f").isNull() | (F.col("outer_f").cast(big) * down < F.col("f").cast(big) * up)
    )
    cuts = kept.select(
        "lang", "phrase", F.col("f").alias("a"), F.split("phrase", " ").alias("w"), "length",
        F.explode(F.expr("sequence(1, length - 1)")).alias("k"),
    ).select(
        "lang", "phrase", "a", "k", F.array_join(F.expr("slice(w, 1, k)"), " ").alias("first"),
        F.array_join(F.expr("slice(w, k + 1, length - k)"), " ").alias("rest"),
    )
    parts = frequent.select("lang", F.col("phrase").alias("part"), "f")
    scored = (
        cuts.join(parts.withColumnsRenamed({"part": "first", "f": "l"}), ["lang", "first"])
        .join(parts.withColumnsRenamed({"part": "rest", "f": "r"}), ["lang", "rest"])
        .withColumn("score", F.expr(f"(cast(2000000 as decimal(7,0)) * cast(a as {big})) div (cast(l as {big}) + cast(r as {big}))"))
        .groupBy("lang", "phrase", "a").agg(F.min(F.struct("score", "k", "l", "r")).alias("low"))
        .select("lang", "phrase", "a", "low.l", "low.r", "low.score")
    )
    order = [F.desc("score"), F.desc("a"), F.asc("phrase")]
    share = F.pmod(F.xxhash64("phrase"), F.lit(parallel_pieces(docs.sparkSession)))
    inside = F.row_number().over(Window.partitionBy("lang", "share").orderBy(*order))
    few = scored.withColumn("share", share).withColumn("place", inside).where(F.col("place") <= best)
    rank = F.row_number().over(Window.partitionBy("lang").orderBy(*order)).cast("long")
    ranked = few.withColumn("rank", rank).where(F.col("rank") <= best)
    return ranked.join(words, "lang").select("lang", "rank", "phrase", "a", "l", "r", "n", "score")
