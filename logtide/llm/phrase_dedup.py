"""Substring dedup: recurring passages are confirmed, compiled into automata, and located.

A window is ``window`` consecutive words. Texts are cut into chunks where the words themselves
say so, each with the words its last windows need. A chunk that an earlier document has too
holds only windows seen before; that settles copies and long passages with one row per chunk.

In the chunks that are left, every window names its least phrase of ``phrase`` words by hash.
Equal windows name equal phrases, so a window can recur only if its phrase was named in two
places. These phrases are confirmed by counting them. The documents that hold them go into
shards of bounded size; each shard compiles its phrases into one Aho-Corasick automaton over
words and streams its documents through it, once, which finds every occurrence. A shard of
documents, not of phrases, keeps the work in proportion: no document meets a second automaton.
Windows around an occurrence are compared in full, by 128 bits, over all documents.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from logtide.llm.common import ship, words_of, written
from logtide.llm.sieve import sifted

WINDOW, PHRASE = 20, 10
CHUNK = 32  # windows of a chunk on average
SHARD_WORDS = 200_000  # words of the documents that share an automaton; a longer document has its own
MASK = (1 << 64) - 1
EMPTY = hashlib.sha256(b"").hexdigest()
GROUP_WORDS = 500_000  # words that are cut into chunks together


@lru_cache(maxsize=4)
def _factors(n: int):
    """``n`` odd 64-bit numbers drawn by a fixed rule."""
    import numpy as np

    out, state = [], 7
    for _ in range(n):
        state = (state + 0x9E3779B97F4A7C15) & MASK
        z = ((state ^ state >> 30) * 0xBF58476D1CE4E5B9) & MASK
        z = ((z ^ z >> 27) * 0x94D049BB133111EB) & MASK
        out.append((z ^ z >> 31) | 1)
    return np.array(out, "uint64")


def phrase_hashes(words, phrase: int):
    """Hashes of all phrases of a document from those of its words."""
    import numpy as np

    total = np.zeros(len(words) - phrase + 1, "uint64")
    for j, factor in enumerate(_factors(phrase)):
        total += factor * words[j : j + len(total)]
    return (total ^ total >> np.uint64(29)) * _factors(phrase + 1)[-1]


def least_places(hashes, window: int, phrase: int):
    """For each window the first place of its least phrase."""
    import numpy as np

    at, size, span = np.arange(len(hashes)), 1, window - phrase + 1
    while size < span:
        step = min(size, span - size)
        smaller = hashes[step:] < hashes[:-step]
        at = np.where(smaller, at[step:], at[:-step])
        hashes = np.where(smaller, hashes[step:], hashes[:-step])
        size += step
    return at


def chunk_columns(words, lengths, window: int, phrase: int):
    """Chunks of the documents whose word hashes stand in ``words`` one after the other.

    Per chunk: owner (number of the document), start, size (in windows), digest, ``again`` (it
    repeats an earlier chunk of the document, so its windows start earlier), ``edge``, and the
    number of phrases it names; then these phrases and their places, chunk by chunk.

    A place comes once, with the first chunk that names it. One that the next chunk names too
    comes last and has the mark ``edge``: it counts even if its own chunk does not. Of a chunk
    that is met again only this place is left. Of a phrase named more than twice in a chunk two
    places are left, enough to know that it recurs.
    """
    import numpy as np
    from xxhash import xxh3_128_digest

    stops = np.cumsum(lengths)
    begins, after = stops - lengths, stops - window + 1  # first window, end of the windows
    if len(words) < window or not (after > begins).any():
        return None
    hashes, n = phrase_hashes(words, phrase), len(words) - window + 1
    document = np.repeat(np.arange(len(lengths)), lengths)[:n]
    valid = np.arange(n) < after[document]
    opening = np.zeros(n, bool)
    opening[begins[(after > begins)]] = True
    starts = np.flatnonzero(valid & (opening | (hashes[:n] % np.uint64(CHUNK) == 0)))
    owner = document[starts]
    ends = np.minimum(np.append(starts[1:], n), after[owner])
    digests, again, seen, last = [], np.zeros(len(starts), bool), set(), -1
    for c, (d, a, b) in enumerate(zip(owner.tolist(), starts.tolist(), (ends + window - 1).tolist(), strict=True)):
        if d != last:
            seen, last = set(), d
        digest = xxh3_128_digest(words[a:b])
        again[c] = digest in seen
        seen.add(digest)
        digests.append(digest)
    least = least_places(hashes, window, phrase)
    new = valid & opening
    new[1:] |= valid[1:] & (least[1:] != least[:-1])  # windows that name another place than the one before
    at = np.flatnonzero(new)
    chunk = np.searchsorted(starts, at, "right") - 1
    places, total = least[at], np.bincount(chunk, minlength=len(starts))
    edge = (total > 0) & (ends < after[owner]) & ~new[np.minimum(ends, n - 1)]
    at_edge = np.zeros(len(at), bool)
    at_edge[(np.cumsum(total) - 1)[edge]] = True
    order = np.lexsort((places, hashes[places], chunk))
    h, c = hashes[places][order], chunk[order]
    third = np.zeros(len(at), bool)
    third[order[2:]] = (h[2:] == h[:-2]) & (c[2:] == c[:-2])
    left = at_edge | ~(third | again[chunk])
    places, chunk = places[left], chunk[left]
    counts = np.bincount(chunk, minlength=len(starts))
    phrases, places = hashes[places].view("int64"), places - begins[owner[chunk]]
    return owner, starts - begins[owner], ends - starts, digests, again, edge, counts, phrases, places


def _pairs(digests: list[bytes]):
    import numpy as np

    both = np.frombuffer(b"".join(digests), "<i8").reshape(-1, 2)
    return pa.array(both[:, 0]), pa.array(both[:, 1])


def hashed(docs: DataFrame) -> DataFrame:
    """doc_id, k1 (hash of the words; the same id and k1 mean the same words), n_words and h, the hashes of the words."""
    words = docs.select("doc_id", words_of(F.col("text")).alias("words"))
    return words.select(
        "doc_id",
        F.xxhash64("words").alias("k1"),
        F.size("words").cast("long").alias("n_words"),
        F.transform("words", lambda w: F.xxhash64(w)).alias("h"),
    )


def chunks(docs: DataFrame, window: int, phrase: int) -> DataFrame:
    """The chunks of all documents of at least ``window`` words, see ``chunk_columns``."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import numpy as np

        for part in batches:
            words = part.column(3).flatten().to_numpy(zero_copy_only=False).view("uint64")
            lengths = part.column(3).value_lengths().to_numpy(zero_copy_only=False).astype("int64")
            stops = np.cumsum(lengths)
            # Documents in groups of bounded size; a longer one is a group of its own.
            groups = np.flatnonzero(np.diff((stops - lengths) // GROUP_WORDS, prepend=-1))
            for first, end in zip(groups.tolist(), [*groups[1:].tolist(), len(lengths)], strict=True):
                a, b = stops[first] - lengths[first], stops[end - 1]
                found = chunk_columns(words[a:b], lengths[first:end], window, phrase)
                if found is None:
                    continue
                owner, start, size, digests, again, edge, counts, phrases, places = found
                offsets = pa.array(np.append(0, np.cumsum(counts)), pa.int32())
                lists = [pa.ListArray.from_arrays(offsets, pa.array(x, pa.int64())) for x in (phrases, places)]
                keys = [part.column(k).take(pa.array(owner + first)) for k in range(3)]
                flags = [pa.array(x) for x in (again, edge)]
                yield pa.RecordBatch.from_arrays([*keys, pa.array(start), pa.array(size), *_pairs(digests), *flags, *lists], names)

    kind = docs.schema["doc_id"].dataType.simpleString()
    schema = (
        f"doc_id {kind}, k1 long, n_words long, start long, size long, c1 long, c2 long, again boolean, edge boolean, "
        "phrases array<long>, places array<long>"
    )
    names = [c.split()[0] for c in schema.split(", ")]
    return hashed(docs).mapInArrow(cut, schema)


def _earlier(low: str) -> Column:
    """``low``, the smallest id that has the same, comes before the row's own; null ids come last."""
    return F.coalesce(F.col(low) < F.col("doc_id"), F.col(low).isNotNull() & F.col("doc_id").isNull())


def _joined(left: DataFrame, right: DataFrame, how: str) -> DataFrame:
    """Join on doc_id and k1; null ids are equal to each other."""
    right = right.withColumnsRenamed({"doc_id": "r_id", "k1": "r_k1"})
    same = F.col("doc_id").eqNullSafe(F.col("r_id")) & (F.col("k1") == F.col("r_k1"))
    return left.join(right, same, how).drop("r_id", "r_k1")


def confirmed(docs: DataFrame, window: int, phrase: int) -> DataFrame:
    """doc_id, k1, n_words, leads (places of phrases that recur) and stale (chunks whose windows all start
    earlier), for each document that has any of them."""
    rows = written(chunks(docs, window, phrase), "chunks")
    first = rows.where("NOT again").groupBy("c1", "c2").agg(F.min("doc_id").alias("low"), F.count("*").alias("n"))
    shared = written(first.where("n > 1").drop("n"), "shared")
    keys = ["doc_id", "k1", "n_words"]
    # A chunk of one document only is not shuffled: all but a few of these do not pass the sieve.
    met = sifted(rows, F.col("c1"), shared, F.col("c1"))
    columns = [*keys, "start", "size", F.arrays_zip("phrases", "places").alias("pairs"), "edge"]
    alone = met.where("NOT maybe").select(*columns, F.col("again").alias("stale"))
    known = met.where("maybe").join(shared, ["c1", "c2"], "left").select(*columns, (F.col("again") | _earlier("low")).alias("stale"))
    marked = alone.union(known)
    # Of a stale chunk only the place that the next one names too is left.
    left = F.when(F.col("stale"), F.expr("slice(pairs, -1, cast(edge AS int))")).otherwise(F.col("pairs"))
    marked = marked.withColumn("pairs", left)
    named = marked.select(*keys, F.explode("pairs").alias("pair")).select(
        *keys, F.col("pair.phrases").alias("phrase"), F.col("pair.places").alias("place")
    )
    recurring = written(named.groupBy("phrase").agg(F.count("*").alias("n")).where("n > 1").select("phrase"), "phrases")
    nothing = F.lit(None).cast("long")
    leads = sifted(named, F.col("phrase"), recurring, F.col("phrase")).where("maybe").join(recurring, "phrase").select(*keys, "place", nothing.alias("start"), nothing.alias("size"))
    stale = marked.where("stale").select(*keys, nothing.alias("place"), "start", "size")
    both = leads.union(stale).groupBy(*keys).agg(
        F.collect_set("place").alias("leads"),
        F.collect_set(F.when(F.col("start").isNotNull(), F.struct("start", "size"))).alias("stale"),
    )
    return written(both, "work")


def locate(shard: list[tuple], window: int, phrase: int):
    """Windows to compare, per document of a shard (words, leads, stale).

    They are those outside of stale chunks whose least phrase is found by the automaton of the
    shard: digests and starts of the first of a kind in the document, and starts of the others.
    """
    import ahocorasick
    import numpy as np
    from xxhash import xxh3_128_digest, xxh64_intdigest

    every = [w for words, _, _ in shard for w in words]
    number = {w: k for k, w in enumerate(dict.fromkeys(every))}
    ids = np.fromiter(map(number.__getitem__, every), "int64", len(every))
    stops = np.cumsum([len(words) for words, _, _ in shard]).tolist()
    spelled = [tuple(ids[stop - len(words) : stop].tolist()) for stop, (words, _, _) in zip(stops, shard, strict=True)]
    automaton = ahocorasick.Automaton(ahocorasick.STORE_INTS, ahocorasick.KEY_SEQUENCE)
    for own, (_, leads, _) in zip(spelled, shard, strict=True):
        for place in leads:
            automaton.add_word(own[place : place + phrase], 1)
    if not len(automaton):
        yield from (([], [], []) for _ in shard)
        return
    automaton.make_automaton()
    word_hashes = np.fromiter((xxh64_intdigest(w, 42) for w in number), "uint64", len(number))
    # Places in the shard; what crosses from one document to the next is not looked at.
    least = least_places(phrase_hashes(word_hashes[ids], phrase), window, phrase)
    found = np.zeros(len(ids), bool)
    for own, stop in zip(spelled, stops, strict=True):
        found[np.fromiter((end for end, _ in automaton.iter(own)), "int64") + (stop - len(own) - phrase + 1)] = True
    for stop, (words, _, stale) in zip(stops, shard, strict=True):
        near = found[least[stop - len(words) : stop - window + 1]]
        for start, size in stale:
            near[start : start + size] = False
        digests, starts, again, seen = [], [], [], set()
        for i in np.flatnonzero(near).tolist():
            digest = xxh3_128_digest(b" ".join(words[i : i + window]))
            if digest in seen:
                again.append(i)
            else:
                seen.add(digest)
                digests.append(digest)
                starts.append(i)
        yield digests, starts, again


def located(suspects: DataFrame, window: int, phrase: int) -> DataFrame:
    """doc_id, k1, w1, w2 and starts of the windows to compare, again: starts of those met in the document before."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def batch(part, first, shard):
            rows = []
            for digests, starts, again in locate(shard, window, phrase):
                w1, w2 = _pairs(digests)
                rows.append((w1.to_pylist(), w2.to_pylist(), starts, again))
            keys = [part.column(k).slice(first, len(shard)) for k in (0, 1)]
            lists = [pa.array(column, pa.list_(pa.int64())) for column in zip(*rows, strict=True)]
            return pa.RecordBatch.from_arrays([*keys, *lists], names)

        for part in batches:
            shard, size, first = [], 0, 0
            texts, leads, stale = (part.column(k) for k in (2, 3, 4))
            for i, text in enumerate(texts.cast(pa.binary())):
                words = text.as_py().split()
                if shard and size + len(words) > SHARD_WORDS:
                    yield batch(part, first, shard)
                    shard, size, first = [], 0, i
                gone = [(c["start"], c["size"]) for c in stale[i].as_py()]
                shard.append((words, leads[i].as_py(), gone))
                size += len(words)
            if shard:
                yield batch(part, first, shard)

    kind = suspects.schema["doc_id"].dataType.simpleString()
    schema = f"doc_id {kind}, k1 long, w1 array<long>, w2 array<long>, starts array<long>, again array<long>"
    names = [c.split()[0] for c in schema.split(", ")]
    return suspects.select("doc_id", "k1", "text", "leads", "stale").mapInArrow(run, schema)


def _cut(rows: DataFrame, window: int) -> DataFrame:
    """doc_id, k1, n_removed and kept_sha256 from the text, its stale chunks and the starts of its other windows."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import numpy as np

        for part in batches:
            removed, digests = [], []
            texts, stale, starts = (part.column(k) for k in (2, 3, 4))
            for i, text in enumerate(texts.cast(pa.binary())):
                words = text.as_py().split()
                gone = np.zeros(len(words), bool)
                for c in stale[i].as_py():
                    gone[c["start"] : c["start"] + c["size"] + window - 1] = True
                for start in starts[i].as_py() or ():
                    gone[start : start + window] = True
                removed.append(int(gone.sum()))
                digests.append(hashlib.sha256(b" ".join([words[k] for k in np.flatnonzero(~gone).tolist()])).hexdigest())
            yield pa.RecordBatch.from_arrays(
                [part.column(0), part.column(1), pa.array(removed, pa.int64()), pa.array(digests, pa.string())],
                ["doc_id", "k1", "n_removed", "kept_sha256"],
            )

    kind = rows.schema["doc_id"].dataType.simpleString()
    rows = rows.select("doc_id", "k1", "text", "stale", "starts")
    return rows.mapInArrow(cut, f"doc_id {kind}, k1 long, n_removed long, kept_sha256 string")


def substring_dedup(docs: DataFrame, window: int = WINDOW, phrase: int = PHRASE) -> DataFrame:
    """Per row of ``docs`` (doc_id, text): n_words, n_removed and the SHA-256 of the words that stay.

    A word is removed if a window over it has words that also start at a smaller doc_id, or
    earlier in the same row. ``phrase`` is at most ``window``.

    Null, empty and short texts lose nothing. Null ids come after all others. Rows that share
    an id are not earlier than each other, so repeated rows come out alike. Texts of any length
    are read whole; one text and its windows must fit into a worker. No rows give no rows. Other
    columns are not read.
    """
    if not 1 <= phrase <= window:
        raise ValueError(f"a phrase of {phrase} words does not fit into a window of {window}")
    ship(docs.sparkSession)
    work = confirmed(docs, window, phrase)
    covered = F.aggregate("stale", F.lit(0).cast("long"), lambda n, c: n + c["size"])
    work = work.withColumn("whole", covered == F.col("n_words") - (window - 1))
    texts = docs.select("doc_id", F.xxhash64(words_of(F.col("text"))).alias("k1"), "text")
    partly = written(work.where("NOT whole").drop("n_words", "whole"), "partly")
    texts = sifted(texts, F.col("k1"), partly, F.col("k1")).where("maybe").drop("maybe")
    suspects = written(_joined(texts, partly, "inner"), "suspects")
    found = written(located(suspects, window, phrase), "located")
    pair = F.explode(F.arrays_zip("w1", "w2", "starts")).alias("w")
    windows = found.select("doc_id", "k1", pair).select("doc_id", "k1", "w.*")
    low = windows.groupBy("w1", "w2").agg(F.min("doc_id").alias("low"), F.count("*").alias("n")).where("n > 1").drop("n")
    gone = windows.join(low, ["w1", "w2"]).where(_earlier("low"))
    starts = gone.select("doc_id", "k1", F.col("starts").alias("start"))
    starts = starts.union(found.select("doc_id", "k1", F.explode("again")))
    starts = starts.groupBy("doc_id", "k1").agg(F.collect_set("start").alias("starts"))
    cut = _cut(_joined(suspects, starts, "left"), window)
    wholly = work.where("whole").select("doc_id", "k1", F.col("n_words").alias("n_removed"), F.lit(EMPTY).alias("kept_sha256"))
    # Repeated rows have one result.
    results = cut.union(wholly).groupBy("doc_id", "k1").agg(F.first("n_removed").alias("n_removed"), F.first("kept_sha256").alias("kept"))
    words = docs.select("doc_id", words_of(F.col("text")).alias("words"))
    every = words.select(
        "doc_id", F.xxhash64("words").alias("k1"), F.size("words").cast("long").alias("n_words"),
        F.sha2(F.array_join("words", " "), 256).alias("kept_sha256"),
    )
    return _joined(every, results, "left").select(
        "doc_id", "n_words", F.coalesce("n_removed", F.lit(0)).alias("n_removed"), F.coalesce("kept", "kept_sha256").alias("kept_sha256")
    )
