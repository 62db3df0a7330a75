"""Benchmark decontamination: test phrases searched in an FM-index of each training shard."""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.pandas.types import to_arrow_type

from lapwise.llm.common import PrefixHash, joined, lots, lowered, ship, utf8_bytes, word_bounds
from lapwise.llm.fmindex import FMIndex

#: Documents of about so many bytes together make one shard with an index of its own.
SHARD_BYTES = 4 << 20
#: Benchmark items are searched in blocks of at most so many bytes of text.
BLOCK_BYTES = 16 << 20


class Phrases:
    """All windows of a block of items, each once, and the items that hold each of them."""

    def __init__(self, items: Sequence[tuple[str | None, str | None]], window: int) -> None:
        data, starts = joined([(t or "").encode() for _, t in items])
        data = lowered(data)
        opens, closes, counts = word_bounds(data, starts)
        words = PrefixHash(data).between(opens, closes)
        self.vocabulary = np.unique(words)
        numbers = np.searchsorted(self.vocabulary, words) + 1
        found: dict[tuple[int, ...], set[str | None]] = {}
        first = 0
        for (item, _), count in zip(items, counts.tolist()):
            own = numbers[first : first + count].tolist()
            first += count
            for place in range(max(1, count - window + 1) if count else 0):
                found.setdefault(tuple(own[place : place + window]), set()).add(item)
        self.items = [sorted(i - {None}) for i in found.values()]
        self.lengths = np.array([len(p) for p in found], np.int64)
        self.shortest = int(self.lengths.min(initial=1 << 30))
        self.table = np.zeros((len(found), window), np.int64)
        for row, phrase in enumerate(found):
            self.table[row, : len(phrase)] = phrase

    def numbered(self, words: np.ndarray) -> np.ndarray:
        """Vocabulary numbers from 1, 0 for a word that no item has."""
        if not len(self.vocabulary):
            return np.zeros(len(words), np.int64)
        place = np.minimum(np.searchsorted(self.vocabulary, words), len(self.vocabulary) - 1)
        return np.where(self.vocabulary[place] == words, place + 1, 0)

    def occurrences(self, numbers: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(word place, phrase) of every occurrence inside one document.

        A word that no item has cannot be part of an occurrence, nor can a run of
        known words that is shorter than the shortest phrase: the index holds the
        other runs, with separators between them.
        """
        total = len(numbers)
        known = numbers > 0
        cut = np.zeros(total + 1, np.bool_)
        cut[np.cumsum(counts)] = cut[0] = True
        opens = np.flatnonzero(known & (cut[:-1] | ~np.r_[False, known[:-1]]))
        closes = np.flatnonzero(known & (cut[1:] | ~np.r_[known[1:], False])) + 1
        long = closes - opens >= self.shortest
        opens, sizes = opens[long], (closes - opens)[long]
        if not len(opens):
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        heads = np.cumsum(sizes + 1) - sizes  # a separator stands before each run
        symbols = np.zeros(int((sizes + 1).sum()), np.int64)
        places = np.repeat(opens - heads, sizes + 1) + np.arange(len(symbols))
        inside = np.ones(len(symbols), np.bool_)
        inside[heads - 1] = False
        symbols[inside] = numbers[places[inside]]
        index = FMIndex(symbols, len(self.vocabulary))
        low, high = index.search(self.table, self.lengths)
        hits = high - low
        rows = np.repeat(np.arange(len(hits)), hits)
        suffixes = np.repeat(low - (np.cumsum(hits) - hits), hits) + np.arange(len(rows))
        return places[index.locate(suffixes)], rows


def _merged(places: np.ndarray, lengths: np.ndarray, words: int) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the merged word spans."""
    edge = np.zeros(words + 1, np.int64)
    np.add.at(edge, places, 1)
    np.add.at(edge, places + lengths, -1)
    inside = np.r_[False, np.cumsum(edge[:-1]) > 0, False]
    return np.flatnonzero(inside[1:] & ~inside[:-1]), np.flatnonzero(~inside[1:] & inside[:-1])


def contamination(
    docs: DataFrame,
    benchmark: DataFrame,
    window: int = 13,
    id_col: str = "doc_id",
    text_col: str = "text",
    item_col: str = "item_id",
    item_text_col: str = "text",
) -> DataFrame:
    """Where passages of the benchmark occur in documents.

    Words: runs of digits, letters and all beyond ASCII, A-Z lowered. A phrase is
    `window` consecutive words of an item, or a shorter item as a whole. Returns for
    each document its id, `n_words`, `spans` (merged, in words, end exclusive) and
    `items` (ids as text, sorted, of the items with a phrase in the document).

    Documents are cut into shards of whole texts; each gets an FM-index, in which
    all phrases are searched at once. The benchmark goes to the workers in blocks
    of at most `BLOCK_BYTES`, or one longer item; with more than one block the
    documents are read once for each, and spans are merged afterwards.

    A missing text or item text has no words. Items without words find nothing.
    An item without an id is searched like the others, and its hits are in `spans`,
    but it is not in `items`. Equal items are all reported. Repeated documents have a row each. Empty tables:
    without documents an empty table, without items no spans. Other columns are
    not kept.
    """
    spark = docs.sparkSession
    ship(spark)
    items = benchmark.select(
        F.col(item_col).cast("string").alias("item"), F.col(item_text_col).alias("text")
    )
    weight = items.agg(F.sum(utf8_bytes(F.col("text")))).first()[0] or 0
    blocks = -(-weight // BLOCK_BYTES) or 1
    read = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    kind = docs.schema[id_col].dataType
    span = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))
    names = ["id", "n_words", "spans", "items"]
    schema = f"id {kind.simpleString()}, n_words long, spans array<struct<start: long, end: long>>, items array<string>"

    def searched(held):
        def run(batches):
            phrases = held.value
            for batch in batches:
                ids = batch.column("id")
                texts = [b"" if t is None else t.encode() for t in batch.column("text").to_pylist()]
                for lot in lots(map(len, texts), SHARD_BYTES):
                    data, starts = joined(texts[lot])
                    data = lowered(data)
                    numbers, counts = [], []
                    for part in lots(np.diff(starts)):
                        a, b = starts[part.start], starts[part.stop]
                        opens, closes, own = word_bounds(data[a:b], starts[part.start : part.stop + 1] - a)
                        numbers.append(phrases.numbered(PrefixHash(data[a:b]).between(opens, closes)))
                        counts.append(own)
                    counts = np.concatenate(counts)
                    places, rows = phrases.occurrences(np.concatenate(numbers), counts)
                    ends = np.cumsum(counts)
                    owner = np.searchsorted(ends, places, side="right")
                    spans, found = [[] for _ in counts], [[] for _ in counts]
                    order = np.argsort(owner, kind="stable")
                    hit, first = np.unique(owner[order], return_index=True)
                    for doc, mine in zip(hit.tolist(), np.split(order, first[1:])):
                        opens, closes = _merged(
                            places[mine] - (ends[doc] - counts[doc]), phrases.lengths[rows[mine]], int(counts[doc])
                        )
                        spans[doc] = [{"start": a, "end": b} for a, b in zip(opens.tolist(), closes.tolist())]
                        found[doc] = sorted(set().union(*(phrases.items[r] for r in np.unique(rows[mine]).tolist())))
                    yield pa.RecordBatch.from_arrays(
                        [ids[lot.start : lot.stop], pa.array(counts), pa.array(spans, span), pa.array(found, pa.list_(pa.string()))],
                        names=names,
                    )

        return run

    parts = []
    for block in range(blocks):
        some = items.where(F.pmod(F.xxhash64("item", "text"), F.lit(blocks)) == block) if blocks > 1 else items
        held = spark.sparkContext.broadcast(Phrases(sorted(((r[0], r[1] or "") for r in some.collect()), key=lambda r: (r[0] is not None, *r)), window))
        source = read.select(F.struct("id", F.monotonically_increasing_id().alias("row")).alias("id"), "text") if blocks > 1 else read
        parts.append(source.mapInArrow(searched(held), schema if blocks == 1 else schema.replace(
            f"id {kind.simpleString()}", f"id struct<id: {kind.simpleString()}, row: long>", 1)))
    if blocks == 1:
        return parts[0].withColumnRenamed("id", id_col)
    whole = parts[0]
    for part in parts[1:]:
        whole = whole.unionByName(part)
    starts = F.array_sort(F.flatten(F.collect_list("spans")))
    merged = F.expr("""
        aggregate(spans, cast(array() AS array<struct<start: bigint, end: bigint>>), (done, s) ->
            CASE WHEN size(done) > 0 AND s.start <= element_at(done, -1).end
                 THEN concat(slice(done, 1, size(done) - 1),
                             array(struct(element_at(done, -1).start AS start, greatest(element_at(done, -1).end, s.end) AS end)))
                 ELSE concat(done, array(s)) END)
    """)
    grouped = whole.groupBy("id").agg(
        F.max("n_words").alias("n_words"), starts.alias("spans"),
        F.array_sort(F.array_distinct(F.flatten(F.collect_list("items")))).alias("items"),
    )
    return grouped.select(F.col("id.id").alias(id_col), "n_words", merged.alias("spans"), "items")


def contaminated(found: DataFrame) -> DataFrame:
    """Add `n_hit` and `contaminated`: at least one word in twenty lies in a phrase of the benchmark."""
    hit = F.aggregate("spans", F.lit(0).cast("long"), lambda total, s: total + s["end"] - s["start"])
    return found.withColumn("n_hit", hit).withColumn(
        "contaminated", (F.col("n_hit") > 0) & (20 * F.col("n_hit") >= F.col("n_words"))
    )


def without_contaminated(docs: DataFrame, benchmark: DataFrame, text_col: str = "text", **settings) -> DataFrame:
    """The rows of `docs` that are not contaminated, with all their columns, without a shuffle of texts."""
    rows = docs.select(F.struct(*docs.columns).alias("row"), F.col(text_col).alias("text"))
    found = contaminated(contamination(rows, benchmark, id_col="row", **settings))
    return found.where(~F.col("contaminated")).select("row.*")
