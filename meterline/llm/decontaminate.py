"""Benchmark decontamination by SimHash over item-sized windows.

Every window of a document that is as long as a benchmark item gets a SimHash;
multi-index Hamming blocks return all items whose fingerprint lies within the
radius, and an exact weighted-shingle similarity decides. A window that is
similar enough to an item shares most of its shingles with it, so windows with
too few shingles of any item of their length are passed over unhashed: by the
similarity's own bound they cannot pass the check.

The benchmark is the query set and is taken in blocks of bounded size; each
block's index goes to the tasks, and the documents are only ever scanned.
"""

from __future__ import annotations

import pickle
from collections import Counter, defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from meterline.llm.common import Stored, arrow_batches, column, fresh_name

SHINGLE_WORDS = 5
MIN_SIMILARITY = 0.8
# Similarity 0.8 turns 9.7 of 64 bits on average, deviation 2.9: 24 is five deviations out.
RADIUS = 24
HAMMING_BLOCKS = 8
# Benchmark text per block, in bytes; its index takes a few times as much in each task.
BLOCK_BYTES = 4 << 20
# Words remembered per task; the memo starts over when it is full.
MEMO_WORDS = 200_000
# Words handled at once of a very long text (windows overlap from one span to the next).
SPAN_WORDS = 1 << 18

# ASCII letters to lower case, ASCII punctuation to spaces.
FOLD = bytes(ord(chr(b).lower()) if chr(b).isalnum() else 32 for b in range(128)) + bytes(range(128, 256))
MIX = np.uint64(0x9E3779B97F4A7C15)


def words_of(text: str | None) -> list[bytes]:
    return (text or "").encode("utf-8").translate(FOLD).split()


class WordHashes(dict):
    def __missing__(self, word: bytes) -> int:
        import xxhash

        if len(self) >= MEMO_WORDS:
            self.clear()
        h = self[word] = xxhash.xxh64_intdigest(word)
        return h


def shingle_hashes(words: np.ndarray, k: int) -> np.ndarray:
    """64-bit hashes of all runs of ``k`` words, from the words' hashes."""
    n = len(words) - k + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    out = np.zeros(n, np.uint64)
    for j in range(k):
        out = (out ^ words[j : j + n]) * MIX
        out ^= out >> np.uint64(29)
    return out


def simhash_windows(shingles: np.ndarray, starts: np.ndarray, m: int) -> np.ndarray:
    """SimHash of the ``m`` shingles from each of ``starts`` (each shingle weighs as often as it occurs)."""
    lo, hi = int(starts[0]), int(starts[-1]) + m
    bits = np.unpackbits(shingles[lo:hi].astype(">u8").view(np.uint8).reshape(-1, 8), axis=1)
    ones = np.zeros((hi - lo + 1, 64), np.int32)
    np.cumsum(bits, axis=0, out=ones[1:])
    at = starts - lo
    return np.packbits(2 * (ones[at + m] - ones[at]) > m, axis=1).view(">u8").ravel().astype(np.uint64)


def found_in(values: np.ndarray, known: np.ndarray) -> np.ndarray:
    """Which ``values`` are in the sorted ``known``, by binary search: few values against many known ones."""
    at = np.searchsorted(known, values)
    at[at == len(known)] = 0
    return known[at] == values


def near_values(bits: int, radius: int) -> list[int]:
    """All masks of ``bits`` bits with up to ``radius`` bits set."""
    return [v for v in range(1 << bits) if v.bit_count() <= radius]


class HammingIndex:
    """All fingerprints within ``radius``: two that differ in at most ``radius`` bits differ in some block by at most its share."""

    def __init__(self, prints: list[int], radius: int = RADIUS, blocks: int = HAMMING_BLOCKS):
        self.prints, self.radius, self.width = prints, radius, 64 // blocks
        self.near = near_values(self.width, radius // blocks)
        self.tables = []
        for b in range(blocks):
            table = defaultdict(list)
            for i, p in enumerate(prints):
                table[p >> (b * self.width) & ((1 << self.width) - 1)].append(i)
            self.tables.append(table)

    def within(self, value: int) -> set[int]:
        seen = set()
        for b, table in enumerate(self.tables):
            own = value >> (b * self.width) & ((1 << self.width) - 1)
            for mask in self.near:
                seen.update(table.get(own ^ mask, ()))
        return {i for i in seen if (self.prints[i] ^ value).bit_count() <= self.radius}


def similarity(a: Counter, b: Counter) -> float:
    """Weighted Jaccard of two shingle multisets."""
    both = sum(min(n, b[s]) for s, n in a.items() if s in b)
    return both / (a.total() + b.total() - both)


class Items:
    """Benchmark items of one length: shingle multisets, fingerprints and the shingles that any of them has."""

    def __init__(self, n_words: int, rows: list[tuple[str | None, np.ndarray]], shingle_words: int):
        self.n_words, self.k = n_words, min(shingle_words, n_words)
        self.m = n_words - self.k + 1
        self.ids = [i for i, _ in rows]
        shingles = [shingle_hashes(w, self.k) for _, w in rows]
        self.bags = [Counter(s.tolist()) for s in shingles]
        self.index = HammingIndex([int(simhash_windows(s, np.zeros(1, np.int64), self.m)[0]) for s in shingles])
        self.known = np.unique(np.concatenate(shingles))


class BlockIndex:
    """Index of one block of the benchmark."""

    def __init__(self, items: list[tuple[str | None, str]], shingle_words: int, min_similarity: float):
        hashes, by_length = WordHashes(), defaultdict(list)
        for item, text in items:
            words = words_of(text)
            if words:
                by_length[len(words)].append((item, np.array([hashes[w] for w in words], np.uint64)))
        self.min_similarity = min_similarity
        self.groups = [Items(n, rows, shingle_words) for n, rows in sorted(by_length.items())]
        self.by_k = defaultdict(list)
        for g in self.groups:
            self.by_k[g.k].append(g)
        # A small table in front of the exact look-up: most shingles of a document fail here.
        self.sieve = {}
        for k, groups in self.by_k.items():
            known = np.unique(np.concatenate([g.known for g in groups]))
            table = np.zeros(1 << 20, bool)
            table[known >> np.uint64(44)] = True
            self.sieve[k] = (table, known)

    def matches(self, words: np.ndarray) -> Iterator[tuple[str | None, float, int, int]]:
        """(item, similarity, first word, words) of every window similar enough to an item."""
        for k, groups in self.by_k.items():
            shingles = shingle_hashes(words, k)
            if not len(shingles):
                continue
            table, known = self.sieve[k]
            hits = np.flatnonzero(table[shingles >> np.uint64(44)])
            hits = hits[found_in(shingles[hits], known)]
            if not len(hits):
                continue
            for g in groups:
                if len(shingles) < g.m:
                    continue
                own = hits[found_in(shingles[hits], g.known)]
                # At similarity s, two bags of m shingles share at least 2sm / (1 + s).
                least = int(np.ceil(2 * self.min_similarity * g.m / (1 + self.min_similarity) - 1e-9))
                if len(own) < least:
                    continue
                flags = np.zeros(len(shingles) + 1, np.int64)
                flags[own + 1] = 1
                counts = np.cumsum(flags)
                starts = np.flatnonzero(counts[g.m :] - counts[: len(counts) - g.m] >= least)
                if not len(starts):
                    continue
                for run in np.split(starts, np.flatnonzero(np.diff(starts) > g.m) + 1):
                    for start, value in zip(run.tolist(), simhash_windows(shingles, run, g.m).tolist()):
                        near = g.index.within(value)
                        if not near:
                            continue
                        bag = Counter(shingles[start : start + g.m].tolist())
                        for i in near:
                            if next(iter(g.bags[i].keys() & bag.keys()), None) is not None and (s := similarity(bag, g.bags[i])) >= self.min_similarity:
                                yield g.ids[i], s, start, g.n_words

    def best(self, words: list[bytes], hashes: WordHashes) -> dict[str | None, tuple[float, int, int]]:
        """Best window per item over the whole text: highest similarity, then the earliest."""
        out: dict[str | None, tuple[float, int, int]] = {}
        longest = self.groups[-1].n_words
        for at in range(0, max(1, len(words)), SPAN_WORDS):
            span = words[at : at + SPAN_WORDS + longest - 1]
            values = np.fromiter(map(hashes.__getitem__, span), np.uint64, len(span))
            for item, s, start, n in self.matches(values):
                found = (s, -(at + start), n)
                if item not in out or found > out[item]:
                    out[item] = found
        return out


def contaminated(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id", item_text_col: str = "text", shingle_words: int = SHINGLE_WORDS, min_similarity: float = MIN_SIMILARITY, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """(doc_id, item_id, similarity, first_word, n_words): each document that holds a benchmark item, with its best window.

    Words are runs of letters, digits and non-ASCII characters, ASCII case
    ignored; an item shorter than a shingle is one shingle. Null or wordless
    texts and items match nothing; items of equal text all match. Rows that
    share an id are one document (its best window over them), items that share
    an id one item; a null id of either stays null and is one id. Item ids may
    be of any type that text can stand for and keep it. Empty tables give no
    rows.
    """
    spark = docs.sparkSession
    arrow_batches(spark)
    slim = docs.select(column(id_col).alias("doc_id"), column(text_col).alias("text"))
    kind = slim.schema["doc_id"].dataType.simpleString()
    item_kind = benchmark.select(column(item_col).alias("item_id")).schema["item_id"].dataType.simpleString()
    items = benchmark.select(column(item_col).cast("string").alias("item_id"), column(item_text_col).alias("text")).filter("text IS NOT NULL")
    total = items.agg(F.sum(F.octet_length("text").cast("long"))).first()[0] or 0
    n_blocks = max(1, -(-total // block_bytes))
    ddl = f"doc_id {kind}, item_id string, similarity double, first_word bigint, n_words bigint"
    parts = []
    for block in range(n_blocks):
        rows = [(r.item_id, r.text) for r in items.filter(F.pmod(F.xxhash64("item_id", "text"), F.lit(n_blocks)) == block).collect()]
        index = BlockIndex(sorted(rows, key=lambda r: (r[0] is not None, r)), shingle_words, min_similarity)
        if not index.groups:
            continue
        # As bytes that carry their classes: executors need not have this package.
        shared = spark.sparkContext.broadcast(cloudpickle.dumps(index))

        def run(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            index, hashes = pickle.loads(shared.value), WordHashes()
            for batch in batches:
                found = [(doc, item, s, -at, n) for doc, text in enumerate(batch.column(1)) for item, (s, at, n) in index.best(words_of(text.as_py()), hashes).items()]
                if found:
                    doc, item, s, at, n = zip(*found)
                    ids = batch.column(0).take(pa.array(doc, pa.int64()))
                    yield pa.RecordBatch.from_arrays([ids, pa.array(item, pa.string()), pa.array(s, pa.float64()), pa.array(at, pa.int64()), pa.array(n, pa.int64())], names=["doc_id", "item_id", "similarity", "first_word", "n_words"])

        parts.append(slim.mapInArrow(run, ddl))
    if not parts:
        return spark.createDataFrame([], ddl.replace("item_id string", f"item_id {item_kind}"))
    out = parts[0]
    for more in parts[1:]:
        out = out.unionByName(more)
    order = F.struct((-F.col("similarity")).alias("worse"), "first_word", "n_words")
    best = out.groupBy("doc_id", "item_id").agg(F.min(order).alias("b"))
    return best.select("doc_id", F.col("item_id").cast(item_kind).alias("item_id"), (-F.col("b.worse")).alias("similarity"), "b.first_word", "b.n_words")


def keep_clean(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """``docs`` without the rows whose text holds a benchmark item; columns unchanged.

    Rows are told apart by their id and their text's digest, so rows that share
    an id, or have none, are judged one by one.
    """
    bad, key = fresh_name(docs, "bad_key"), fresh_name(docs, "row_key")
    # The text decides; the id spreads copies of one text over many keys.
    keyed = docs.withColumn(key, F.concat_ws(" ", column(id_col).cast("string"), F.md5(column(text_col))))
    found = Stored(contaminated(keyed, benchmark, key, text_col, **options).select(F.col("doc_id").alias(bad)).distinct(), "contaminated").df
    return keyed.join(found, column(key) == column(bad), "left_anti").drop(key)
