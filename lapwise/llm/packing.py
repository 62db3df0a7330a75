"""Harmonic packing of token sequences: reciprocal-capacity classes, each bin with a fixed number of pieces."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window, functions as F

from lapwise.llm.common import lots, parted, ship, stage
from lapwise.llm.tokens import encoder

#: A document's end is marked by this id, which counts as its last token.
END_ID = 0
_PIECE = "doc_id {id}, start long, length long, ids binary, doc_tokens long, class int, worker int, place long, sequence_id long, offset long"


def cuts(length: int, capacity: int, slack: float) -> Iterator[tuple[int, int, int]]:
    """Cut a document into (start, length, class).

    Class k takes pieces of which k, but not k + 1, fit into a sequence. Full
    sequences come first. The rest is one piece if it fills all but `slack` of its
    class's slot; else the slot of the next class is cut off, which leaves a rest
    smaller by a power, so there are few pieces.
    """
    start = 0
    while length - start >= capacity:
        yield start, capacity, 1
        start += capacity
    while start < length:
        rest = length - start
        count = capacity // rest
        slot = capacity // count
        if slot - rest > slack * slot:
            rest = capacity // (count + 1)
            count = capacity // rest
        yield start, rest, count
        start += rest


def first_fit(lengths: list[int], capacity: int) -> list[tuple[int, int]]:
    """Bin and offset of each length: longest first, into the first bin with room."""
    room: list[int] = []
    out = [(0, 0)] * len(lengths)
    for item in sorted(range(len(lengths)), key=lambda i: (-lengths[i], i)):
        size = lengths[item]
        place = next((b for b, free in enumerate(room) if free >= size), len(room))
        if place == len(room):
            room.append(capacity)
        out[item] = (place, capacity - room[place])
        room[place] -= size
    return out


def harmonic_pack(
    docs: DataFrame,
    vocabulary: str,
    capacity: int = 1024,
    slack: float = 1 / 64,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """Pack all documents into sequences of at most `capacity` tokens.

    Returns one row for each piece: the id, `start` (the document's tokens before
    it), `length`, `ids` (little-endian unsigned 32-bit), `doc_tokens` (with the
    closing id 0), `sequence_id` and `offset` in the sequence.

    Each worker fills the bins of each class by itself and holds at most one open
    bin a class. Bins still open at its end are filled on over all workers: ranks
    in a class come from counts for each worker. What is left then is less than
    one bin a class, a number that depends on `capacity` alone, and goes first-fit
    into shared sequences on the driver.

    A missing or empty text is the closing id alone. Repeated rows are packed each.
    An empty table gives an empty table. Other columns are not kept.
    """
    spark = docs.sparkSession
    ship(spark)

    def pieces(batches):
        worker = TaskContext.get().partitionId()
        encode = encoder(vocabulary).encode
        bins: dict[int, list] = {}
        numbered = 0
        out: list[tuple] = []
        for batch in parted(batches):
            ids = batch.column("id").to_pylist()
            texts = ["" if t is None else t for t in batch.column("text").to_pylist()]
            for lot in lots(map(len, texts)):
                for doc, data in zip(ids[lot], encode(texts[lot])):
                    data += END_ID.to_bytes(4, "little")
                    total = len(data) // 4
                    for start, length, count in cuts(total, capacity, slack):
                        held = bins.setdefault(count, [])
                        held.append((doc, start, length, data[4 * start : 4 * (start + length)], total))
                        if len(held) == count:
                            offset = 0
                            for piece in held:
                                out.append((*piece, count, worker, None, worker << 32 | numbered, offset))
                                offset += piece[2]
                            numbered += 1
                            held.clear()
                if len(out) >= 4096:
                    yield batch_of(out)
                    out = []
        for count, held in bins.items():
            out += [(*piece, count, worker, place, None, None) for place, piece in enumerate(held)]
        if out:
            yield batch_of(out)

    id_type = docs.schema[id_col].dataType
    from pyspark.sql.pandas.types import to_arrow_type

    kinds = [to_arrow_type(id_type), pa.int64(), pa.int64(), pa.binary(), pa.int64(), pa.int32(), pa.int32(),
             pa.int64(), pa.int64(), pa.int64()]
    schema = _PIECE.format(id=id_type.simpleString())
    names = [field.split()[0] for field in schema.split(", ")]

    def batch_of(rows):
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names=names)

    read = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    packed = stage(read.mapInArrow(pieces, schema), "pieces")
    shown = [F.col("doc_id").alias(id_col), "start", "length", "ids", "doc_tokens", "sequence_id", "offset"]

    waiting = packed.where(F.col("sequence_id").isNull()).drop("sequence_id", "offset")
    counts = waiting.groupBy("class", "worker").agg(F.count(F.lit(1)).alias("n"))
    earlier = Window.partitionBy("class").orderBy("worker").rowsBetween(Window.unboundedPreceding, -1)
    shifts = counts.select(
        "class", "worker", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("shift"),
        F.sum("n").over(Window.partitionBy("class")).alias("all"),
    )
    ranked = waiting.join(shifts, ["class", "worker"]).withColumns({
        "rank": F.col("place") + F.col("shift"),
        "bin": F.floor((F.col("place") + F.col("shift")) / F.col("class")),
        "full": F.floor(F.col("all") / F.col("class")),
    })
    in_bin = Window.partitionBy("class", "bin").orderBy("rank").rowsBetween(Window.unboundedPreceding, -1)
    second = ranked.where("bin < full").withColumns({
        "sequence_id": F.shiftleft(F.lit(1 << 24).cast("long") + F.col("class"), 32) + F.col("bin"),
        "offset": F.coalesce(F.sum("length").over(in_bin), F.lit(0)),
    })
    # fewer than `class` pieces of each class
    rest = ranked.where("bin >= full")
    last = sorted(tuple(r) for r in rest.select("class", "rank", "length").collect())
    where = first_fit([r[2] for r in last], capacity)
    places = spark.createDataFrame(
        [(r[0], r[1], (1 << 25 << 32) + b, o) for r, (b, o) in zip(last, where)],
        "class int, rank long, sequence_id long, offset long",
    )
    third = rest.join(F.broadcast(places), ["class", "rank"])
    done = packed.where(F.col("sequence_id").isNotNull())
    return done.select(*shown).unionByName(second.select(*shown)).unionByName(third.select(*shown))
