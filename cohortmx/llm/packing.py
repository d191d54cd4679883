"""Best-fit-decreasing packing of documents into fixed-length token sequences.

Longest pieces first, each goes into the open sequence with the least room
that still takes it.  Pieces of one length are alike, and so are open
sequences with the same room.  So the plan is made from the count of pieces
of each length (at most ``capacity`` rows, whatever the corpus): a segment
tree over the remaining capacities finds the tightest open room in
logarithmic time, and one step places as many pieces of that length as the
sequences with that room take.  The result is what placing them one by one
gives.  Spark numbers the pieces of each length and joins them to the plan.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from cohortmx.llm.common import BROADCAST_ROWS, text_slices, written
from cohortmx.llm.word_bpe import encoder

CAPACITY = 4096
END_ID = 1


def default_tokenizer() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


def pieces(docs: DataFrame, capacity: int = CAPACITY, end_id: int = END_ID, tokenizer: str | None = None,
           with_ids: bool = False, keep_chunks: bool = True) -> DataFrame:
    """Each document's ids and ``end_id``, cut into pieces of ``capacity``
    where longer: doc_id, piece, start, length, ids_crc32 (and ids).

    A null or empty text is the end id alone.  Repeated rows are packed each;
    a null doc_id stays null.  Other columns of ``docs`` are ignored.
    ``keep_chunks``: workers keep the chunks they have met for later tasks,
    which is faster and takes up to some 150 MB a worker.
    """
    path = tokenizer or default_tokenizer()
    step = 4 * capacity
    end = np.array([end_id], "<u4").tobytes()

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder(path)
        for whole in batches:
            for b in text_slices(whole):
                rows: list[tuple] = []
                ids: list[np.ndarray] = []
                for doc, text in zip(b.column("doc_id").to_pylist(), b.column("text").to_pylist()):
                    raw = encode(text or "") + end
                    for n, at in enumerate(range(0, len(raw), step)):
                        part = raw[at:at + step]
                        rows.append((doc, n, at // 4, len(part) // 4, zlib.crc32(part)))
                        if with_ids:
                            ids.append(np.frombuffer(part, "<u4").astype(np.int32))
                cols = [pa.array([r[0] for r in rows], pa.int64()), pa.array([r[1] for r in rows], pa.int32()),
                        *(pa.array([r[i] for r in rows], pa.int64()) for i in (2, 3, 4))]
                names = ["doc_id", "piece", "start", "length", "ids_crc32"]
                if with_ids:
                    cols, names = [*cols, pa.array(ids, pa.list_(pa.int32()))], [*names, "ids"]
                yield pa.RecordBatch.from_arrays(cols, names)
        if not keep_chunks:
            encode.forget()

    schema = "doc_id long, piece int, start long, length long, ids_crc32 long" + ", ids array<int>" * with_ids
    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(cut, schema)


class RoomTree:
    """Segment tree over remaining capacities 0..capacity: which have an open sequence."""

    def __init__(self, capacity: int):
        self.size = 1 << capacity.bit_length()
        self.open = [False] * (2 * self.size)

    def set(self, room: int, is_open: bool) -> None:
        i = room + self.size
        self.open[i] = is_open
        while i > 1:
            i //= 2
            self.open[i] = self.open[2 * i] or self.open[2 * i + 1]

    def tightest(self, least: int) -> int | None:
        """The smallest open room that is at least ``least``."""
        i = least + self.size
        while not self.open[i]:
            while i % 2 and i > 1:          # a right child: go up
                i //= 2
            if i <= 1:
                return None
            i += 1                          # the sibling to the right
        while i < self.size:
            i = 2 * i if self.open[2 * i] else 2 * i + 1
        return i - self.size


def plan(counts: dict[int, int], capacity: int = CAPACITY) -> list[tuple[int, int, int, int, int, int]]:
    """(length, first rank, pieces, first sequence, pieces a sequence, offset)
    of each step of best-fit decreasing.  Pieces of a length are numbered from
    0; those of a step fill its sequences one after the other."""
    rooms: dict[int, list[tuple[int, int]]] = {}   # room -> ranges (first sequence, number)
    tree, steps, fresh = RoomTree(capacity), [], 0

    def put(room: int, first: int, n: int) -> None:
        if n and room:
            if room not in rooms:
                rooms[room] = []
                tree.set(room, True)
            rooms[room].append((first, n))

    for length in sorted(counts, reverse=True):
        rank, left = 0, counts[length]
        while left:
            room = tree.tightest(length)
            if room is None:
                room, first = capacity, fresh
                n = -(-left // (capacity // length))
                fresh += n
            else:
                first, n = rooms[room].pop()
                if not rooms[room]:
                    del rooms[room]
                    tree.set(room, False)
            per = room // length
            placed = min(left, n * per)
            full, rest = divmod(placed, per)
            steps.append((length, rank, placed, first, per, capacity - room))
            put(room - per * length, first, full)
            used = full
            if rest:
                put(room - rest * length, first + full, 1)
                used += 1
            put(room, first + used, n - used)
            rank, left = rank + placed, left - placed
    return steps


def pack(cut: DataFrame, capacity: int = CAPACITY, salts: int | None = None) -> DataFrame:
    """The rows of ``cut`` (doc_id, piece, length, ...; lengths 1 to
    ``capacity``) with sequence_id and offset.  No rows: no rows.

    The pieces of one length may be a large share of all, so they are numbered
    in ``salts`` parts (by hash of id and piece), whose counts give each part's
    first number.
    """
    spark = cut.sparkSession
    salts = salts or int(spark.conf.get("spark.sql.shuffle.partitions"))
    cut = written(cut)
    salted = cut.withColumn("_part", F.pmod(F.xxhash64("doc_id", "piece"), F.lit(salts)))
    parts = written(salted.groupBy("length", "_part").agg(F.count(F.lit(1)).alias("_n")))
    lengths = {r["length"]: r["n"] for r in parts.groupBy("length").agg(F.sum("_n").alias("n")).collect()}
    steps = plan(lengths, capacity)
    before = Window.partitionBy("length").orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    first = parts.select("length", "_part", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_first"))
    order = Window.partitionBy("length", "_part").orderBy("doc_id", "piece", *[c for c in ("start", "ids_crc32") if c in cut.columns])
    ranked = (salted.withColumn("_row", F.row_number().over(order) - 1).join(first, ["length", "_part"])
              .withColumn("_rank", F.col("_row") + F.col("_first")))
    made = spark.createDataFrame(steps, "_length long, _from long, _pieces long, _seq long, _per long, _used long")
    made = F.broadcast(made) if len(steps) <= BROADCAST_ROWS else made.hint("merge")
    at = F.col("_rank") - F.col("_from")
    placed = ranked.join(made, (F.col("length") == F.col("_length")) & (at >= 0) & (at < F.col("_pieces")))
    nth = at - F.floor(at / F.col("_per")) * F.col("_per")
    return placed.select(*[F.col(c) for c in cut.columns],
                         (F.col("_seq") + F.floor(at / F.col("_per"))).cast("long").alias("sequence_id"),
                         (F.col("_used") + nth * F.col("length")).cast("long").alias("offset"))


def sequences(packed: DataFrame) -> DataFrame:
    """The packed sequences themselves (``pieces(..., with_ids=True)`` packed):
    sequence_id, ids, doc_ids.  A group is at most one sequence long."""
    part = F.struct("offset", "ids", "doc_id")
    return (packed.groupBy("sequence_id").agg(F.sort_array(F.collect_list(part)).alias("parts"))
            .select("sequence_id", F.flatten("parts.ids").alias("ids"), F.col("parts.doc_id").alias("doc_ids")))


def best_fit_pack(docs: DataFrame, capacity: int = CAPACITY, end_id: int = END_ID, tokenizer: str | None = None,
                  keep_chunks: bool = True) -> DataFrame:
    return pack(pieces(docs, capacity, end_id, tokenizer, keep_chunks=keep_chunks), capacity)
