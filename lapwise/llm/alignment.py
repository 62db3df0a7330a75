"""Token groups of two tokenizers on the same text, and how often their ids stand over the same bytes."""

from __future__ import annotations

import hashlib
import json
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.pandas.types import to_arrow_type

from lapwise.llm.chunks import Lot, Numbers, Rows
from lapwise.llm.common import lots, ship, stage, stage_large
from lapwise.llm.tokens import Encoder, token_bytes

#: Text bytes of one block of documents, which is one stored row.
BLOCK_TEXT = 2 << 20
#: Chunks between blanks kept by one worker, some 150 bytes each; beyond that it starts anew.
KEPT_CHUNKS = 250_000
_aligners: dict[tuple[str, str], "Aligner"] = {}


def successors(a_ends: np.ndarray, b_ends: np.ndarray) -> np.ndarray:
    """The farthest-right token that overlaps each token, all tokens of A first, then those of B.

    Both rows of tokens cover the same bytes. A token of A that no token reaches
    beyond points to itself, one of B to the token of A over its last byte.
    """
    to_b = np.searchsorted(b_ends, a_ends)  # the token of B over the last byte
    to_a = np.searchsorted(a_ends, b_ends)
    return np.r_[np.where(b_ends[to_b] > a_ends, len(a_ends) + to_b, np.arange(len(a_ends))), to_a]


def terminals(pointers: np.ndarray) -> np.ndarray:
    """The token at the end of each token's chain of pointers, by doubling the successors until nothing moves."""
    while True:
        further = pointers[pointers]
        if np.array_equal(further, pointers):
            return pointers
        pointers = further


def links(a_ends: np.ndarray, b_ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places of all pairs of overlapping tokens: one pair for each stretch between neighbouring ends."""
    ends = np.union1d(a_ends, b_ends)
    return np.searchsorted(a_ends, ends), np.searchsorted(b_ends, ends)


def piece_bytes(piece: str) -> bytes:
    """Bytes of an entry of the piece vocabulary: U+2581 is a blank, `<0xHH>` a byte."""
    if len(piece) == 6 and piece.startswith("<0x") and piece.endswith(">"):
        return bytes([int(piece[3:5], 16)])
    return piece.replace("▁", " ").encode()


class Aligner:
    """Aligned chunks of one worker process.

    Both tokenizers start a new token at a blank between two words, so the tokens of
    a text are those of its chunks, each behind a blank, and no group crosses a
    chunk. Texts with other white space are aligned whole.
    """

    def __init__(self, a_path: str, b_path: str) -> None:
        import sentencepiece

        self._a = Encoder(a_path)
        with open(a_path, encoding="utf-8") as file:
            told = json.load(file)
        names = {t["content"]: t["id"] for t in told["added_tokens"]}
        entries = {number: data for data, number in token_bytes(told["model"]["vocab"], list(names)).items()}
        entries |= {number: name.encode() for name, number in names.items()}
        self._b = sentencepiece.SentencePieceProcessor(model_file=b_path)
        pieces = [piece_bytes(self._b.id_to_piece(n)) for n in range(self._b.get_piece_size())]
        self._a_bytes, self._b_bytes = [entries[n] for n in range(max(entries) + 1)], pieces
        self._a_size, self._b_size = (np.array(list(map(len, some)), np.int64) for some in (self._a_bytes, pieces))
        self._a_text, self._b_text = ([b"%d" % n for n in range(len(some))] for some in (self._a_bytes, pieces))
        # a piece that goes on over a blank would join chunks
        self._by_chunk = not any(b" " in p[1:] and p.strip(b" ") for p in pieces)
        self._numbers = Numbers(KEPT_CHUNKS, self._learn, self._forget)
        self._forget()

    def _forget(self) -> None:
        self.counts = np.zeros((0, 4), np.int64)
        self.pairs = Rows(np.uint64)
        self.good = np.zeros(0, np.bool_)
        self.groups: list[bytes] = []

    def _learn(self, chunks: list[str], first: list[bool]) -> None:
        a_ids, a_sizes = self._a.of_chunks(chunks)
        found = self.align([b" " + c.encode() for c in chunks], a_ids, a_sizes, self._b.encode(chunks, num_threads=1))
        good, counts, pairs, groups = found
        self.good = np.r_[self.good, good]
        self.counts = np.concatenate([self.counts, counts])
        self.pairs.add(pairs, counts[:, 3])
        self.groups += groups

    def align(
        self, texts: Sequence[bytes], a_ids: np.ndarray, a_sizes: np.ndarray, b_lists: list[list[int]]
    ) -> tuple[np.ndarray, np.ndarray, np.ndarray, list[bytes]]:
        """Of each text: whether both rows of tokens are its bytes, its tokens of A and B, groups and links; all pairs; the groups as text.

        The tokens of all texts stand in one row of bytes, where no token crosses from one text into the next.
        """
        b_sizes = np.array(list(map(len, b_lists)), np.int64)
        b_ids = np.array([n for some in b_lists for n in some], np.int64)
        good = np.ones(len(texts), np.bool_)
        whole, ends = b"".join(texts), np.cumsum(list(map(len, texts)))
        for ids, sizes, table in ((a_ids, a_sizes, self._a_bytes), (b_ids, b_sizes, self._b_bytes)):
            parts, stops = list(map(table.__getitem__, ids.tolist())), np.cumsum(sizes)
            lengths = np.r_[0, np.cumsum(list(map(len, parts)))]
            if b"".join(parts) != whole or not np.array_equal(lengths[stops], ends):
                good &= [b"".join(parts[stop - size : stop]) == text for stop, size, text in zip(stops.tolist(), sizes.tolist(), texts)]
        if not good.all():
            a_ids, b_ids = a_ids[np.repeat(good, a_sizes)], b_ids[np.repeat(good, b_sizes)]
            a_sizes, b_sizes = np.where(good, a_sizes, 0), np.where(good, b_sizes, 0)
        counts = np.zeros((len(texts), 4), np.int64)
        counts[:, 0], counts[:, 1] = a_sizes, b_sizes
        if not len(a_ids):
            return good, counts, np.zeros(0, np.uint64), [b""] * len(texts)
        a_ends, b_ends = np.cumsum(self._a_size[a_ids]), np.cumsum(self._b_size[b_ids])
        last = terminals(successors(a_ends, b_ends))
        a_group, b_group = last[: len(a_ids)], last[len(a_ids) :]
        a_text = np.repeat(np.arange(len(texts)), a_sizes)
        closing = np.flatnonzero(a_group == np.arange(len(a_ids)))  # terminal tokens
        counts[:, 2] = np.bincount(a_text[closing], minlength=len(texts))
        at_a, at_b = links(a_ends, b_ends)
        counts[:, 3] = np.bincount(a_text[at_a], minlength=len(texts))
        pairs = a_ids[at_a].astype(np.uint64) << np.uint64(32) | b_ids[at_b].astype(np.uint64)
        # every group is a stretch of A and of B up to its terminal token
        a_names, b_names = list(map(self._a_text.__getitem__, a_ids.tolist())), list(map(self._b_text.__getitem__, b_ids.tolist()))
        a_stops, b_stops = (closing + 1).tolist(), np.searchsorted(b_group, closing, side="right").tolist()
        shown, a_from, b_from = [], 0, 0
        for a_stop, b_stop in zip(a_stops, b_stops):
            shown.append(b",".join(a_names[a_from:a_stop]) + b"|" + b",".join(b_names[b_from:b_stop]))
            a_from, b_from = a_stop, b_stop
        stops = np.cumsum(counts[:, 2]).tolist()
        return good, counts, pairs, [b";".join(shown[stop - n : stop]) for stop, n in zip(stops, counts[:, 2].tolist())]

    def whole(self, text: str) -> tuple[np.ndarray, np.ndarray, np.ndarray, list[bytes]]:
        a_ids = self._a.ids(" " + text)
        return self.align([b" " + text.encode()], a_ids, np.array([len(a_ids)]), [self._b.encode(text)])

    def block(self, texts: list[str]) -> tuple[np.ndarray, list[str], np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Counts and hash of the groups of each text; pairs of the distinct units of the block, one after the other, and how
        many each unit has; the units of all texts in order, and how many each text has.

        A unit is a chunk, or a text that was aligned whole.
        """
        self._numbers.room()
        blank = np.array([not t for t in texts], np.bool_)
        single = ~blank if self._by_chunk else np.zeros(len(texts), np.bool_)
        found: list[np.ndarray] = [np.zeros(0, np.int64)]
        owners: list[np.ndarray] = [np.zeros(0, np.int64)]
        for some in lots(map(len, texts)):
            lot = Lot([t.encode() for t in texts[some]], blank_first=True)
            single[some] &= ~lot.odd
            chosen = np.flatnonzero(single[some][lot.owner])
            found.append(self._numbers.of(lot, chosen))
            owners.append(lot.owner[chosen] + some.start)
        numbers, owner = np.concatenate(found), np.concatenate(owners)
        single[owner[~self.good[numbers]]] = False  # texts with a chunk that does not give its bytes, to be sure taken whole
        live = single[owner]
        numbers, owner = numbers[live], owner[live]
        units, unit = np.unique(numbers, return_inverse=True)
        pairs, sizes = [self.pairs.take(units)], [self.pairs.sizes(units)]
        counts = np.zeros((len(texts), 4), np.int64)
        for column in range(4):
            counts[:, column] = np.bincount(owner, self.counts[numbers, column], len(texts))
        hashes = [""] * len(texts)
        spoken, stops = list(map(self.groups.__getitem__, numbers.tolist())), np.searchsorted(owner, np.arange(len(texts) + 1)).tolist()
        owners, extra = [owner], [unit]
        for place in range(len(texts)):
            if single[place]:
                hashes[place] = hashlib.sha256(b";".join(spoken[stops[place] : stops[place + 1]])).hexdigest()
            elif not blank[place]:
                good, own, pair, groups = self.whole(texts[place])
                if good[0]:
                    hashes[place] = hashlib.sha256(groups[0]).hexdigest()
                    counts[place] = own[0]
                    owners.append(np.array([place]))
                    extra.append(np.array([sum(map(len, sizes))]))
                    pairs.append(pair)
                    sizes.append(own[:1, 3])
        owner, unit = np.concatenate(owners), np.concatenate(extra)
        order = np.argsort(owner, kind="stable")
        return counts, hashes, np.concatenate(pairs), np.concatenate(sizes), unit[order], np.bincount(owner, minlength=len(texts))


def aligner(a_path: str, b_path: str) -> Aligner:
    """One for each worker process and pair of vocabularies."""
    if (a_path, b_path) not in _aligners:
        _aligners[a_path, b_path] = Aligner(a_path, b_path)
    return _aligners[a_path, b_path]


def narrow(numbers: np.ndarray) -> bytes:
    """Whole numbers with one, two or four bytes each, as many as the largest needs; the first byte tells."""
    kind = np.min_scalar_type(int(numbers.max(initial=0)))
    return bytes([kind.itemsize]) + numbers.astype(kind).tobytes()


def widened(data: bytes) -> np.ndarray:
    return np.frombuffer(data, f"u{data[0]}", offset=1).astype(np.int64)


_LISTS = ("n_a", "n_b", "n_groups", "n_links")


def align_tokenizers(docs: DataFrame, a_path: str, b_path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Align the tokens of a byte-level vocabulary (A) and a piece vocabulary (B) over each text.

    Both encode a blank and the text, without special tokens. Every token points to
    the farthest-right token that overlaps it; doubling these successors leads each
    to the last token of its component, which labels the group. Groups end where
    tokens of both end. Returns, for each row, the id, `n_a`, `n_b`, `n_groups`,
    `n_links` (overlapping pairs of tokens), `n_best` (links whose pair of ids is
    the most frequent of its B id in the whole table, ties included), `count_sum`
    (how often the pairs of its links are linked in the whole table, summed) and
    `groups_sha256` (of `a1,a2|b1;a3|b2,b3`).

    Documents are aligned in blocks of 2 MB of text, each stored as one row with its
    distinct pairs. Only these meet the counts of all pairs, so a frequent pair comes
    once from each block. A text longer than a block is a block of its own.

    Texts that are missing or empty, or whose tokens are not the bytes of a blank and
    the text, have no tokens: zeros and an empty `groups_sha256`. Repeated rows count
    each. An empty table gives an empty table. Other columns are not read.
    """
    spark = docs.sparkSession
    ship(spark)
    id_type = docs.schema[id_col].dataType
    arrow_id = to_arrow_type(id_type)
    struct = pa.struct([("id", arrow_id), *[(n, pa.int64()) for n in _LISTS], ("sha", pa.string()), ("units", pa.int64())])

    def blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task, number = TaskContext.get().partitionId(), 0
        for batch in batches:
            ids, texts = batch.column("id"), ["" if t is None else t for t in batch.column("text").to_pylist()]
            for lot in lots(map(len, texts), BLOCK_TEXT):
                counts, hashes, pairs, sizes, unit, units = aligner(a_path, b_path).block(texts[lot])
                distinct, pair = np.unique(pairs, return_inverse=True)
                uses = np.bincount(unit, minlength=len(sizes)).astype(np.int64)
                times = np.bincount(pair, np.repeat(uses, sizes), len(distinct)).astype(np.int64)
                rows = pa.StructArray.from_arrays(
                    [ids[lot], *[pa.array(counts[:, c].copy()) for c in range(4)], pa.array(hashes), pa.array(units)], fields=list(struct))
                cells = [pa.array([task << 32 | number], pa.int64()), pa.ListArray.from_arrays([0, len(rows)], rows),
                         pa.ListArray.from_arrays([0, len(distinct)], pa.array(distinct.view(np.int64))),
                         pa.ListArray.from_arrays([0, len(distinct)], pa.array(times))]
                cells += [pa.array([narrow(some)], pa.binary()) for some in (pair, sizes, unit)]
                yield pa.RecordBatch.from_arrays(cells, names=["block", "rows", "pairs", "times", "pair", "sizes", "unit"])
                number += 1

    kind = id_type.simpleString()
    schema = (f"block long, rows array<struct<id: {kind}, {', '.join(f'{n}: long' for n in _LISTS)}, sha: string, units: long>>, "
              "pairs array<long>, times array<long>, pair binary, sizes binary, unit binary")
    stored = stage_large(docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")).mapInArrow(blocks, schema), "aligned")

    asked = stored.select("block", F.explode(F.arrays_zip("pairs", "times")).alias("p")).select("block", "p.pairs", "p.times")
    totals = stage(asked.groupBy("pairs").agg(F.sum("times").alias("n")).withColumn("b", F.expr("pairs & 4294967295L")), "pairs")
    best = totals.groupBy("b").agg(F.max("n").alias("best"))
    told = totals.join(best, "b").select("pairs", "n", (F.col("n") == F.col("best")).alias("is_best"))
    answers = asked.join(told, "pairs").groupBy("block").agg(
        F.sort_array(F.collect_list(F.struct("pairs", "n", "is_best"))).alias("told")
    )

    def filled(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for place in range(batch.num_rows):
                rows = batch.column("rows")[place].values
                told = batch.column("told")[place].values
                pair, sizes, unit = (widened(batch.column(c)[place].as_py()) for c in ("pair", "sizes", "unit"))
                ends = np.cumsum(rows.field("units").to_numpy())
                sums = [np.zeros(len(rows), np.int64)] * 2
                if len(pair):
                    counts, best = told.field("n").to_numpy(), told.field("is_best").to_numpy(zero_copy_only=False).astype(np.int64)
                    heads = np.cumsum(sizes) - sizes
                    for which, values in enumerate((best, counts)):
                        running = np.r_[0, np.cumsum(np.add.reduceat(values[pair], heads)[unit])]
                        sums[which] = np.diff(running[np.r_[0, ends]])
                fields = [rows.field(n) for n in ("id", *_LISTS)]
                yield pa.RecordBatch.from_arrays(
                    [*fields, pa.array(sums[0]), pa.array(sums[1]), rows.field("sha")], names=[out_id, *_LISTS, "n_best", "count_sum", "groups_sha256"])

    out_id = id_col
    wide = stored.drop("pairs", "times").join(answers, "block", "left")
    out = f"`{id_col}` {kind}, {', '.join(f'{n} long' for n in _LISTS)}, n_best long, count_sum long, groups_sha256 string"
    return wide.select("rows", "told", "pair", "sizes", "unit").mapInArrow(filled, out)
