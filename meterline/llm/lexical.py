"""Ranked lexical search with the Best Position Algorithm.

The documents are indexed once, whatever is searched: each task turns the
documents that it reads into segments of bounded size, each with its own
dictionary and the occurrences of every term. A search weighs the terms by
their document counts over all segments, sorts a segment's lists by impact and
reads the lists of an item in step: every document met is looked up in all the
item's lists at once (direct access), and every position seen that way counts.
A list's best position is the last one before which all are seen; no unseen
document can score more than the impacts there add up to, and reading ends when
that sum is strictly below the k-th best score so far. Scores and sums are
64-bit integers, so ties are exact.

Nothing is shuffled but counts of the searched terms and each segment's best k.
"""

from __future__ import annotations

import math
from collections import Counter, defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from meterline.llm.common import Stored, arrow_batches, column

TOP = 20
# Words and documents of one segment; a longer document is a segment by itself.
SEGMENT_WORDS, SEGMENT_DOCS = 1 << 20, 1 << 14
FILE_SEGMENTS = 4
# Query text searched in one pass over the index, in bytes.
BLOCK_BYTES = 1 << 20
# Positions read from each list in the first step; each further step reads twice as many.
FIRST_STEP = 32

# Fixed values of the score: its scale, saturation and share of the length (percent).
IMPACT_SCALE, SATURATION, LENGTH_SHARE = 1_000_000_000, 12, 25

# ASCII capitals to lower case, all other ASCII but letters and digits to spaces.
FOLD = bytes(ord(chr(b).lower()) if chr(b).isalnum() else 32 for b in range(128)) + bytes(range(128, 256))

SEGMENT_DDL = "n_docs bigint, n_words bigint, ids array<{kind}>, lengths array<int>, terms array<binary>, starts array<int>, docs array<int>, tfs array<int>"


def terms_of(text: str | bytes | None) -> list[bytes]:
    raw = text.encode("utf-8") if isinstance(text, str) else text or b""
    return raw.translate(FOLD).split()


def term_weight(n_docs: int, df: int) -> int:
    return math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df + 1)))


# ------------------------------------------------------------------ index


def segment_arrays(docs: list[list[bytes]]) -> dict[str, np.ndarray | list[bytes]]:
    """Lists by term: the documents (ascending, numbered from 0) that hold it and how often."""
    number: defaultdict = defaultdict()
    number.default_factory = number.__len__
    lengths = np.fromiter(map(len, docs), np.int64, len(docs))
    words = np.fromiter((number[w] for d in docs for w in d), np.int64, int(lengths.sum()))
    key, tfs = np.unique(words * len(docs) + np.repeat(np.arange(len(docs)), lengths), return_counts=True)
    counts = np.bincount(key // len(docs), minlength=len(number))
    return {"lengths": lengths, "terms": list(number), "starts": np.concatenate(([0], np.cumsum(counts))), "docs": key % len(docs), "tfs": tfs}


def build_index(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """One row per segment: ids and lengths (in terms) of its documents, its terms and their lists.

    Documents without a term are left out: they count nowhere and match nothing.
    """
    arrow_batches(docs.sparkSession)
    slim = docs.select(column(id_col).alias("doc_id"), F.encode(column(text_col), "UTF-8").alias("text")).filter("text IS NOT NULL")
    kind = slim.schema["doc_id"].dataType
    seg_words, seg_docs = SEGMENT_WORDS, SEGMENT_DOCS

    def flush(ids: list, texts: list[list[bytes]]) -> pa.RecordBatch:
        found = segment_arrays(texts)
        ints = lambda a: pa.array([a.astype(np.int32)], pa.list_(pa.int32()))
        whole = pa.concat_arrays(ids)
        id_list = pa.ListArray.from_arrays(pa.array([0, len(whole)], pa.int32()), whole)
        columns = [pa.array([len(texts)], pa.int64()), pa.array([int(found["lengths"].sum())], pa.int64()), id_list, ints(found["lengths"]), pa.array([found["terms"]], pa.list_(pa.binary())), ints(found["starts"]), ints(found["docs"]), ints(found["tfs"])]
        return pa.RecordBatch.from_arrays(columns, names=["n_docs", "n_words", "ids", "lengths", "terms", "starts", "docs", "tfs"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids, texts, held = [], [], 0
        for batch in batches:
            for i, text in enumerate(batch.column(1)):
                terms = terms_of(text.as_py())
                if not terms:
                    continue
                if texts and (held + len(terms) > seg_words or len(texts) >= seg_docs):
                    yield flush(ids, texts)
                    ids, texts, held = [], [], 0
                ids.append(batch.column(0).slice(i, 1))
                texts.append(terms)
                held += len(terms)
        if texts:
            yield flush(ids, texts)

    return slim.mapInArrow(run, SEGMENT_DDL.format(kind=kind.simpleString()))


# ----------------------------------------------------------------- search


class Lists:
    """The lists of a segment that a block of items needs, by impact and by document."""

    def __init__(self, row: dict, wanted: dict[bytes, int], n_docs: int, n_words: int):
        lengths, starts = np.array(row["lengths"], np.int64), np.array(row["starts"], np.int64)
        self.n = len(lengths)
        here = [(wanted[t], i) for i, t in enumerate(row["terms"]) if t in wanted]
        self.place = {t: k for k, (t, _) in enumerate(here)}
        own = np.array([i for _, i in here], np.int64)
        sizes = starts[own + 1] - starts[own] if len(own) else np.zeros(0, np.int64)
        self.starts = np.concatenate(([0], np.cumsum(sizes)))
        at = np.repeat(starts[own] if len(own) else own, sizes) + np.arange(self.starts[-1]) - np.repeat(self.starts[:-1], sizes)
        docs, tfs = np.array(row["docs"], np.int64)[at], np.array(row["tfs"], np.int64)[at]
        if int(lengths.max(initial=0)) * n_docs * LENGTH_SHARE < 1 << 62:
            norm = 100 - LENGTH_SHARE + LENGTH_SHARE * lengths * n_docs // n_words
        else:  # beyond 64 bits on the way to a small number
            norm = np.array([100 - LENGTH_SHARE + LENGTH_SHARE * n * n_docs // n_words for n in lengths.tolist()], np.int64)
        impacts = IMPACT_SCALE * tfs // (1000 * tfs + SATURATION * norm[docs])
        terms = np.repeat(np.arange(len(own)), sizes)
        order = np.lexsort((docs, -impacts, terms))
        # By impact: list after list, each from its highest impact down.
        self.docs, self.impacts = docs[order], impacts[order]
        # By document: where each document's postings stand in the lists.
        self.by_doc = np.argsort(self.docs, kind="stable")
        self.doc_starts = np.concatenate(([0], np.cumsum(np.bincount(self.docs, minlength=self.n))))
        self.term = terms
        self.met = 0  # documents looked up so far, over all searches

    def postings(self, docs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Direct access: (which of ``docs``, position) of all their postings."""
        sizes = self.doc_starts[docs + 1] - self.doc_starts[docs]
        before = np.cumsum(sizes) - sizes
        owner = np.repeat(np.arange(len(docs)), sizes)
        return owner, self.by_doc[np.arange(sizes.sum()) - before[owner] + self.doc_starts[docs][owner]]

    def best(self, item: list[tuple[int, int]], k: int, floor: int) -> tuple[np.ndarray, np.ndarray]:
        """(documents, scores) that may be among the ``k`` best; ``item``: (term, weight times repeats).

        ``floor`` is a score that ``k`` documents elsewhere reach: what is
        strictly below it is not wanted. Every document with a score of the
        k-th best or more is returned, so ties can be settled by id.
        """
        held = [(self.place[t], w) for t, w in item if t in self.place and w > 0]
        if not held:
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        lists = np.array([t for t, _ in held], np.int64)
        weight = np.zeros(len(self.starts), np.int64)
        weight[lists] = [w for _, w in held]
        begin, end = self.starts[lists], self.starts[lists + 1]
        seen = np.zeros(len(self.docs) + 1, bool)
        met = np.zeros(self.n, bool)
        best_at = begin.copy()
        docs, scores, step = np.zeros(0, np.int64), np.zeros(0, np.int64), FIRST_STEP
        while True:
            # Sorted access: the next positions of every list, from its best position on.
            upto = np.minimum(best_at + step, end)
            sizes = upto - best_at
            read = np.repeat(best_at, sizes) + np.arange(sizes.sum()) - np.repeat(np.cumsum(sizes) - sizes, sizes)
            new = np.unique(self.docs[read])
            new = new[~met[new]]
            met[new] = True
            self.met += len(new)
            owner, at = self.postings(new)
            use = weight[self.term[at]] > 0
            owner, at = owner[use], at[use]
            seen[at] = True
            total = np.zeros(len(new), np.int64)
            np.add.at(total, owner, weight[self.term[at]] * self.impacts[at])
            docs, scores = np.concatenate([docs, new]), np.concatenate([scores, total])
            kth = max(floor, int(np.partition(scores, len(scores) - k)[len(scores) - k]) if len(scores) >= k else 0)
            keep = scores >= max(kth, 1)
            docs, scores = docs[keep], scores[keep]
            # Best positions: the first unseen one of each list; what lies before it is all seen.
            for j in range(len(lists)):
                rest = seen[best_at[j] : end[j]]
                gap = int(np.argmin(rest)) if len(rest) else 0
                best_at[j] = end[j] if len(rest) and rest[gap] else best_at[j] + gap
            open_lists = best_at < end
            if not open_lists.any():
                return docs, scores
            threshold = int((weight[lists[open_lists]] * self.impacts[best_at[open_lists]]).sum())
            if threshold < kth:
                return docs, scores
            step *= 2


class QueryBlock:
    """Items of one block: their terms with repeats, and the weights of all terms."""

    def __init__(self, items: list[tuple[int, str]]):
        self.items = [(no, Counter(terms_of(text))) for no, text in items]
        self.wanted = {t: i for i, t in enumerate(sorted({t for _, c in self.items for t in c}))}


def term_counts(index: DataFrame, wanted: dict[bytes, int]) -> dict[int, int]:
    """Documents that hold each of the searched terms, over all segments."""
    shared = index.sparkSession.sparkContext.broadcast(wanted)

    def run(batches):
        for batch in batches:
            for terms, starts in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                held = [(shared.value[t], starts[i + 1] - starts[i]) for i, t in enumerate(terms) if t in shared.value]
                yield pa.RecordBatch.from_arrays([pa.array([t for t, _ in held], pa.int32()), pa.array([n for _, n in held], pa.int64())], names=["term", "df"])

    rows = index.select("terms", "starts").mapInArrow(run, "term int, df bigint").groupBy("term").agg(F.sum("df")).collect()
    return dict(map(tuple, rows))


def block_candidates(index: DataFrame, block: QueryBlock, weights: dict[int, int], n_docs: int, n_words: int, k: int) -> DataFrame:
    """(item_no, doc_id, score): of each segment the documents that may be among an item's ``k`` best."""
    kind = index.schema["ids"].dataType.elementType.simpleString()
    queries = [(no, [(block.wanted[t], n * weights.get(block.wanted[t], 0)) for t, n in counts.items()]) for no, counts in block.items]
    # Bytes that carry their classes: executors need not have this package.
    shared = index.sparkSession.sparkContext.broadcast(cloudpickle.dumps((block.wanted, queries)))

    def run(batches):
        wanted, items = cloudpickle.loads(shared.value)
        kept: dict[int, np.ndarray] = {}  # the k best scores that this task has seen, for the floor
        for batch in batches:
            for at in range(batch.num_rows):
                row = {name: batch.column(i)[at].values for i, name in enumerate(batch.schema.names)}
                lists = Lists({n: v.to_pylist() if n == "terms" else v.to_numpy(zero_copy_only=False) for n, v in row.items() if n != "ids"}, wanted, n_docs, n_words)
                nos, docs, scores = [], [], []
                for no, item in items:
                    best = kept.get(no, np.zeros(0, np.int64))
                    found, score = lists.best(item, k, int(best[-1]) if len(best) == k else 0)
                    if len(found):
                        kept[no] = -np.sort(-np.concatenate([best, score]))[:k]
                        nos.append(np.full(len(found), no))
                        docs.append(found)
                        scores.append(score)
                if nos:
                    ids = row["ids"].take(pa.array(np.concatenate(docs)))
                    yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(nos), pa.int64()), ids, pa.array(np.concatenate(scores), pa.int64())], names=["item_no", "doc_id", "score"])

    return index.select("ids", "lengths", "terms", "starts", "docs", "tfs").mapInArrow(run, f"item_no bigint, doc_id {kind}, score bigint")


def ranked_search(docs: DataFrame, queries: DataFrame, k: int = TOP, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id", item_text_col: str = "text", block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """(item_id, rank, doc_id, score): each item's ``k`` documents of highest score above 0, equal scores by ascending id.

    Each row of ``queries`` is searched by itself and each row of ``docs``
    ranked by itself, so repeated rows repeat and take ranks of their own; null
    ids of either stay null, documents without an id come last among equals.
    Null texts and texts without a term match nothing; an item with fewer than
    ``k`` matches gives them all, one without any gives no row, and so does an
    empty table. The texts are read once; queries are searched in blocks of
    ``block_bytes``, each in a pass over the index.
    """
    spark = docs.sparkSession
    # Few segments a file: a reader decodes no more of these long rows at once.
    index = Stored(build_index(docs, id_col, text_col), "lexical-index", maxRecordsPerFile=FILE_SEGMENTS)
    items = queries.select(column(item_col).alias("item_id"), column(item_text_col).alias("text")).withColumn("item_no", F.monotonically_increasing_id())
    items = Stored(items, "lexical-items")
    n_docs, n_words = index.df.agg(F.sum("n_docs"), F.sum("n_words")).first()
    size = items.df.agg(F.sum(F.octet_length("text").cast("long"))).first()[0] or 0
    n_blocks = max(1, -(-size // block_bytes))
    spark_kind = docs.select(column(id_col)).schema[0].dataType.simpleString()
    best = None
    for block_no in range(n_blocks if n_docs else 0):
        rows = items.df.filter(F.col("text").isNotNull() & (F.pmod(F.xxhash64("item_no"), F.lit(n_blocks)) == block_no)).select("item_no", "text").orderBy("item_no").collect()
        block = QueryBlock([tuple(r) for r in rows])
        if not block.wanted:
            continue
        weights = {t: term_weight(n_docs, df) for t, df in term_counts(index.df, block.wanted).items()}
        found = block_candidates(index.df, block, weights, n_docs, n_words, k)
        best = found if best is None else best.unionByName(found)
    if best is None:
        best = spark.createDataFrame([], f"item_no bigint, doc_id {spark_kind}, score bigint")
    order = Window.partitionBy("item_no").orderBy(F.desc("score"), F.asc_nulls_last("doc_id"))
    top = Stored(best.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k), "lexical-best")
    index.release()
    return top.df.join(items.df.select("item_no", "item_id"), "item_no").select("item_id", "rank", "doc_id", "score")


def oracle_sql(k: int = TOP) -> str:
    """DuckDB SQL of ``ranked_search(documents, benchmark)`` without early stopping."""
    pattern = "[^\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]+"
    terms = f"unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '{pattern}'))"
    return f"""
WITH d AS MATERIALIZED (SELECT r, doc_id, {terms} AS term FROM (SELECT row_number() OVER () AS r, * FROM documents)),
n AS MATERIALIZED (SELECT r, count(*) AS n FROM d GROUP BY r),
total AS (SELECT count(*) AS docs, CAST(sum(n) AS BIGINT) AS words FROM n),
tf AS MATERIALIZED (SELECT r, doc_id, term, count(*) AS tf FROM d GROUP BY ALL),
df AS (SELECT term, count(*) AS df FROM tf GROUP BY term),
w AS (SELECT term, CAST(floor(1000 * ln((2 * (SELECT docs FROM total) + 2) / (2 * df + 1))) AS BIGINT) AS w FROM df),
m AS (SELECT r, {100 - LENGTH_SHARE} + ({LENGTH_SHARE} * n * (SELECT docs FROM total)) // (SELECT words FROM total) AS m FROM n),
q AS (SELECT q, item_id, term, count(*) AS n FROM (SELECT q, item_id, {terms} AS term FROM (SELECT row_number() OVER () AS q, * FROM benchmark)) GROUP BY ALL),
s AS (
  SELECT q, item_id, tf.r, tf.doc_id, CAST(sum(q.n * w * (({IMPACT_SCALE} * tf) // (1000 * tf + {SATURATION} * m))) AS BIGINT) AS score
  FROM q JOIN w USING (term) JOIN tf USING (term) JOIN m ON m.r = tf.r GROUP BY ALL)
SELECT item_id, CAST(row_number() OVER (PARTITION BY q ORDER BY score DESC, doc_id NULLS LAST) AS INTEGER) AS rank, doc_id, score
FROM s WHERE score > 0 QUALIFY rank <= {k}
"""
