"""Best-fit packing of documents into sequences, after a reduction by dominance.

Tokenizing gives every document its pieces. How pieces share sequences depends only on how
many there are of each length, at most ``capacity`` numbers, whatever the corpus. They are
brought to the driver, where the plan is made: first sets of lengths that provably dominate
every other way to fill a sequence are fixed for good (Martello and Toth), then the rest is
packed best-fit, longest first. Equal sequences are planned together with a count, so the plan
has a bounded number of lines too. The pieces then take their places by their rank among the
pieces of their length, which is computed in evenly sized groups.
"""

from __future__ import annotations

import math
import os
import re
import zlib
from bisect import bisect_left, bisect_right, insort
from collections import Counter
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from logtide.llm.common import ship, spread, written
from logtide.llm.token_counts import OTHER, byte_letters, vocabulary_path

# Pre-tokens of the vocabulary, for characters on whose class Python and the library agree.
PIECES = r"""'s|'t|'re|'ve|'m|'ll|'d|[^\W\d_]+|\d|(?:[^\w\s]|_)+"""
# A word of such characters, whose lower case is as long, and the marks behind it: two pre-tokens at most.
WORD = r"([A-Za-z\xaa\xb5\xba\xc0-\xd6\xd8-\xf6\xf8-\u012f\u0131-\u0233\u0410-\u044f]+)([.,;:!?)]*)"
# Entries of the memo and bytes of a key: some 100 MB a worker when it is full.
MEMO = 400_000
KEY_BYTES = 64
GROUP_ROWS = 500_000


class WordIds(dict):
    """Little-endian 32-bit ids by white-space-free run of bytes, with a bounded memo.

    The vocabulary drops white space and never joins letters across it, so a text's ids are
    those of its runs one after the other. A new run is lower-cased and cut into pre-tokens, which
    differ less than runs do. A pre-token is a run with the same ids, so both share the memo.
    Long runs are not kept. A full memo keeps its older half: frequent runs come early.
    """

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        self.tokenizer = Tokenizer.from_file(path)
        self.tokenize = self.tokenizer.model.tokenize
        self.find, self.odd = re.compile(PIECES).findall, re.compile(OTHER + r"|<\|").search
        self.word = re.compile(WORD).fullmatch
        self.written = {b: c for c, b in byte_letters().items()}
        self.four = [n.to_bytes(4, "little") for n in range(max(self.tokenizer.get_vocab().values()) + 1)]

    def keep(self, run: bytes, ids: bytes) -> None:
        if len(run) <= KEY_BYTES and run not in self:
            if len(self) >= MEMO:
                for _ in range(MEMO // 2):
                    self.popitem()  # the newest
            self[run] = ids

    def of_piece(self, piece: str) -> bytes:
        key = piece.encode("utf-8")
        found = self.get(key)
        if found is None:
            spelled = piece if piece.isascii() else key.decode("latin-1").translate(self.written)
            found = b"".join([self.four[t.id] for t in self.tokenize(spelled)])
            self.keep(key, found)
        return found

    def __missing__(self, run: bytes) -> bytes:
        text = run.decode("utf-8")
        plain = self.word(text)
        if plain:
            word, marks = plain.groups()
            ids = self.of_piece(word.lower())
            if marks:
                ids += self.of_piece(marks)
        elif self.odd(text):
            ids = b"".join([self.four[n] for n in self.tokenizer.encode(text, add_special_tokens=False).ids])
        else:
            ids = b"".join(map(self.of_piece, self.find(text.lower())))
        self.keep(run, ids)
        return ids

    def ids(self, text: bytes) -> bytes:
        return b"".join(map(self.__getitem__, text.split()))


@lru_cache(maxsize=2)
def word_ids(path: str) -> WordIds:
    return WordIds(path)


def pieces_of(docs: DataFrame, capacity: int, path: str | None = None, with_ids: bool = False) -> DataFrame:
    """The pieces of each document: doc_id, piece, start, length, ids_crc32, and the ids if asked for.

    A document's ids are its text's, then 0. Only what is longer than ``capacity`` is cut.
    """
    id_type = docs.schema["doc_id"].dataType.simpleString()

    ship(docs.sparkSession)

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = word_ids(path or vocabulary_path("word_bpe_49k.json"))
        for batch in batches:
            row, piece, start, length, crc, ids = [], [], [], [], [], []
            for i, text in enumerate(batch.column(1).cast(pa.binary()).to_pylist()):
                flat = words.ids(text or b"") + b"\0\0\0\0"
                for k, at in enumerate(range(0, len(flat), 4 * capacity)):
                    part = flat[at : at + 4 * capacity]
                    row.append(i)
                    piece.append(k)
                    start.append(at // 4)
                    length.append(len(part) // 4)
                    crc.append(zlib.crc32(part))
                    if with_ids:
                        ids.append(np.frombuffer(part, "<u4").astype("int32"))
            columns = {
                "doc_id": batch.column(0).take(pa.array(row, pa.int64())),
                "piece": pa.array(piece, pa.int32()),
                "start": pa.array(start, pa.int64()),
                "length": pa.array(length, pa.int64()),
                "ids_crc32": pa.array(crc, pa.int64()),
            }
            if with_ids:
                columns["ids"] = pa.array(ids, pa.list_(pa.int32()))
            yield pa.RecordBatch.from_pydict(columns)

    schema = f"doc_id {id_type}, piece int, start long, length long, ids_crc32 long"
    return docs.select("doc_id", "text").mapInArrow(cut, schema + (", ids array<int>" if with_ids else ""))


class Stock:
    """How many items of each length are left, with the lengths in order."""

    def __init__(self, counts: dict[int, int]):
        self.counts = {w: n for w, n in counts.items() if n > 0}
        self.lengths = sorted(self.counts)

    def take(self, items: Counter, times: int) -> None:
        for w, n in items.items():
            self.counts[w] -= n * times
            if not self.counts[w]:
                del self.counts[w]
                self.lengths.pop(bisect_left(self.lengths, w))

    def times(self, items: Counter) -> int:
        return min(self.counts.get(w, 0) // n for w, n in items.items())

    def smallest(self, without: Counter, how_many: int, above: int = 0) -> list[int]:
        """The smallest items longer than ``above`` when ``without`` is set aside."""
        found: list[int] = []
        for w in self.lengths[bisect_right(self.lengths, above) :]:
            found += [w] * min(how_many - len(found), self.counts[w] - without[w])
            if len(found) == how_many:
                break
        return found

    def largest(self, without: Counter, most: int) -> int | None:
        """The longest item that is no longer than ``most`` when ``without`` is set aside."""
        for k in range(bisect_right(self.lengths, most) - 1, -1, -1):
            if self.counts[self.lengths[k]] > without[self.lengths[k]]:
                return self.lengths[k]
        return None


def dominating(stock: Stock, item: int, room: int) -> Counter | None:
    """A set with ``item`` that dominates every other set with it, if one is known.

    Any other set's items can be exchanged for items of this one that are no shorter, so some
    best packing holds it. ``room`` is the capacity less ``item``.
    """
    own = Counter([item])
    first = stock.largest(own, room)
    if first is None:
        return own  # nothing fits beside it
    pair = own + Counter([first])
    small = stock.smallest(own, 3)
    if first == room or len(small) < 2 or small[0] + small[1] > room:
        return pair  # it fills the room, or at most one item fits
    if len(small) == 3 and sum(small) <= room:
        return None
    # At most two more fit.
    best = best_two(stock, own, room)
    if first >= best:
        return pair
    second = stock.largest(pair, room - first)
    if second is not None:
        longer = stock.smallest(own, 2, above=second)
        if len(longer) < 2 or sum(longer) > room:
            return pair + Counter([second])
    return None


def best_two(stock: Stock, own: Counter, room: int) -> int:
    """Largest sum of two items that fit in ``room``."""
    best = 0
    for w in stock.lengths:
        if w > room or stock.counts[w] <= own[w]:
            continue
        other = stock.largest(own + Counter([w]), room - w)
        if other is not None:
            best = max(best, w + other)
    return best


def pack_lengths(counts: dict[int, int], capacity: int) -> list[tuple[Counter, int]]:
    """Sequences as (items, how many such sequences) that hold all items of ``counts``."""
    stock, plan = Stock(counts), []
    # Reduction: longest first; what is fixed only shrinks the choices of the others.
    for item in sorted(stock.counts, reverse=True):
        while stock.counts.get(item):
            items = dominating(stock, item, capacity - item)
            if items is None:
                break
            times = stock.times(items)
            stock.take(items, times)
            plan.append((items, times))
    # Best fit of the rest: sequences of one content and room stay together with their number.
    open_by_room: dict[int, list[tuple[Counter, int]]] = {}
    rooms: list[int] = []

    def put(items: Counter, room: int, times: int) -> None:
        if room not in open_by_room:
            open_by_room[room] = []
            insort(rooms, room)
        open_by_room[room].append((items, times))

    for item in sorted(stock.counts, reverse=True):
        left = stock.counts[item]
        while left:
            at = bisect_left(rooms, item)
            if at == len(rooms):
                each = capacity // item
                if left >= each:
                    put(Counter({item: each}), capacity - each * item, left // each)
                if left % each:
                    put(Counter({item: left % each}), capacity - left % each * item, 1)
                break
            room = rooms[at]
            items, times = open_by_room[room].pop()
            if not open_by_room[room]:
                del open_by_room[room]
                rooms.pop(at)
            # Best fit keeps filling the same sequence while it has room for this length.
            each = min(room // item, left)
            whole = min(times, left // each)
            put(items + Counter({item: each}), room - each * item, whole)
            if times > whole:
                put(items, room, times - whole)
            left -= each * whole
    plan += [group for groups in open_by_room.values() for group in groups]
    return plan


def places(plan: list[tuple[Counter, int]]) -> dict[int, tuple[np.ndarray, ...]]:
    """By length: first rank of each run of places, items a sequence holds, first sequence, offset of the first item."""
    runs: dict[int, list[tuple[int, int, int, int]]] = {}
    ranks: Counter = Counter()
    sequence = 0
    for items, times in plan:
        offset = 0
        for w, n in sorted(items.items(), reverse=True):
            runs.setdefault(w, []).append((ranks[w], n, sequence, offset))
            ranks[w] += n * times
            offset += n * w
        sequence += times
    return {w: tuple(np.array(x, "int64") for x in zip(*r, strict=True)) for w, r in runs.items()}


def ranked(pieces: DataFrame) -> DataFrame:
    """Number the pieces of each length from 0. Groups by length and hash are numbered on
    their own and start where the groups before them end, so a frequent length is not one group."""
    spark = pieces.sparkSession
    groups = max(spread(spark), math.ceil(pieces.count() / GROUP_ROWS))
    order = ["doc_id", "piece", "start", "ids_crc32"]
    dealt = pieces.withColumn("group", F.pmod(F.xxhash64(*order), F.lit(groups)))
    before = (
        dealt.groupBy("length", "group")
        .count()
        .withColumn(
            "before",
            F.coalesce(
                F.sum("count").over(
                    Window.partitionBy("length").orderBy("group").rowsBetween(Window.unboundedPreceding, -1)
                ),
                F.lit(0),
            ),
        )
        .drop("count")
    )
    inside = F.row_number().over(Window.partitionBy("length", "group").orderBy(*order)) - 1
    return (
        dealt.withColumn("inside", inside)
        .join(before, ["length", "group"])
        .withColumn("rank", F.col("before") + F.col("inside"))
        .drop("group", "before", "inside")
    )


def pack(docs: DataFrame, capacity: int = 2048, path: str | None = None, with_ids: bool = False) -> DataFrame:
    """Pack ``docs`` (doc_id, text) into sequences of at most ``capacity`` tokens.

    Per piece: doc_id, piece, start, length, ids_crc32, sequence_id, offset (and ids if asked
    for). Null or empty text is one piece with the id 0. Null ids are kept and repeated rows
    are packed each; other columns are not read. No rows give no rows.
    """
    spark = docs.sparkSession
    pieces = written(pieces_of(docs, capacity, path, with_ids), "pieces")
    counts = {r["length"]: r["count"] for r in pieces.groupBy("length").count().collect()}  # at most ``capacity`` rows
    where = spark.sparkContext.broadcast(places(pack_lengths(counts, capacity)))

    def settle(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lengths = batch.column(batch.schema.get_field_index("length")).to_numpy()
            ranks = batch.column(batch.schema.get_field_index("rank")).to_numpy()
            sequence, offset = np.zeros(len(lengths), "int64"), np.zeros(len(lengths), "int64")
            for w in np.unique(lengths):
                at = np.flatnonzero(lengths == w)
                first, each, start, shift = where.value[int(w)]
                run = np.searchsorted(first, ranks[at], side="right") - 1
                local = ranks[at] - first[run]
                sequence[at] = start[run] + local // each[run]
                offset[at] = shift[run] + local % each[run] * w
            keep = [n for n in batch.schema.names if n != "rank"]
            yield pa.RecordBatch.from_arrays(
                [batch.column(n) for n in map(batch.schema.get_field_index, keep)]
                + [pa.array(sequence), pa.array(offset)],
                [*keep, "sequence_id", "offset"],
            )

    rows = ranked(pieces).select(*pieces.columns, "rank")
    kinds = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in pieces.schema)
    return rows.mapInArrow(settle, f"{kinds}, sequence_id long, offset long")
