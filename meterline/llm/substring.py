"""Substring dedup by hashing the clauses of lines.

A line is cut into clauses: after each word that ends in a punctuation mark, and
at its end. From each clause on, the fewest clauses that hold ``SEED_WORDS``
words are a unit. Units are normalised (ASCII lower case, runs of white space as
one space or one line break), hashed and grouped over the whole corpus; the
earliest ranked occurrence of a unit stays and every later one is a seed. A seed
is extended word by word, left and right, for as long as the earliest
occurrence's text goes on alike, line breaks included, so a passage may begin
and end inside a line. Passages of ``min_words`` words or more go, with offsets
of the original text; shorter ones (stock lines, idioms) stay.

A text that an earlier document has whole is one passage and gives no units.
Texts are only compared where a passage can be: but for one that starts with the
passage, all units inside a passage are seeds, so it lies between the units
before and after a run of neighbouring seeds, and a run with too few words up to
those is left alone.
"""

from __future__ import annotations

import re
from bisect import bisect_left
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from meterline.llm.common import Stored, arrow_batches, column, fresh_name

MIN_WORDS = 50
SEED_WORDS = 4
# Fixed value: the marks that end a clause; a line's last word carries its break.
MARKS = ".!?,;:\n"

WORD = re.compile("[^\x20\x09-\x0d]+")
SPACES = " \t\n\x0b\x0c\r"
UNIT = pa.struct([("digest", pa.int64()), ("word", pa.int32()), ("left", pa.int32()), ("right", pa.int32())])


def normal_words(text: str) -> list[bytes]:
    """The words in lower case; the last one of a line ends in a line break unless it is the text's last."""
    raw = text.encode("utf-8").lower().strip()  # bytes: A-Z and the six ASCII spaces only
    if b"\n" not in raw:
        return raw.split()
    out = []
    lines = [line for line in map(bytes.split, raw.split(b"\n")) if line]
    for line in lines[:-1]:
        line[-1] += b"\n"
        out += line
    return out + lines[-1]


def units_of(text: str, seed_words: int) -> tuple[int, list[int], list[int], list[int], list[int]]:
    """Number of words, and per unit: digest, first word, and the bounds of any passage whose last units it may be."""
    import xxhash

    marks = MARKS.encode()
    words, starts, ends = normal_words(text), [], []
    bounds = [i for i, w in enumerate(words, 1) if w[-1] in marks]
    for start in [0, *bounds]:
        at = bisect_left(bounds, start + seed_words)
        if at == len(bounds):
            break
        starts.append(start)
        ends.append(bounds[at])
    digests = [xxhash.xxh64_intdigest(b" ".join(words[i:j])) for i, j in zip(starts, ends)]
    lefts = [0, *starts[:-1]] if starts else []
    rights = [e - 1 for e in ends[1:]] + [len(words)] if ends else []
    return len(words), digests, starts, lefts, rights


def with_units(docs: DataFrame, seed_words: int) -> DataFrame:
    """``docs`` (doc_id, text_key, text, md5) as doc_id, text_key, md5, n_words, first and end (the text without outer spaces), units."""
    arrow_batches(docs.sparkSession)
    kind = docs.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(2).to_pylist()
            n_words, *parts = zip(*(units_of(t, seed_words) for t in texts)) if texts else [()] * 5
            first = [len(t) - len(t.lstrip(SPACES)) for t in texts]
            end = [len(t.rstrip(SPACES)) for t in texts]
            offsets = np.concatenate(([0], np.cumsum([len(p) for p in parts[0]]))).astype(np.int32)
            flat = [np.fromiter((x for p in part for x in p), kind, offsets[-1]) for part, kind in zip(parts, (np.uint64, np.int32, np.int32, np.int32))]
            units = pa.StructArray.from_arrays([pa.array(flat[0].view(np.int64)), *map(pa.array, flat[1:])], fields=list(UNIT))
            longs = [pa.array(c, pa.int64()) for c in (n_words, first, end)]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), batch.column(3), *longs, pa.ListArray.from_arrays(pa.array(offsets), units)], names=["doc_id", "text_key", "md5", "n_words", "first", "end", "units"])

    return docs.select("doc_id", "text_key", "text", "md5").mapInArrow(run, f"doc_id {kind}, text_key bigint, md5 binary, n_words bigint, first bigint, end bigint, units array<struct<digest:bigint,word:int,left:int,right:int>>")


def extended(words: list[bytes], earlier: list[bytes], seeds: list[tuple[int, int]], min_words: int) -> list[tuple[int, int]]:
    """Maximal stretches (first word, end) of ``words`` around the ``seeds`` (word, earlier word) that ``earlier`` has alike."""
    number: defaultdict = defaultdict()
    number.default_factory = number.__len__
    own, other = (np.fromiter((number[w] for w in ws), np.int64, len(ws)) for ws in (words, earlier))
    by_shift = defaultdict(list)
    for at, there in seeds:
        by_shift[at - there].append(at)
    out = []
    for shift, ats in by_shift.items():
        low, high = max(0, shift), min(len(own), len(other) + shift)
        breaks = np.concatenate(([low - 1], low + np.flatnonzero(own[low:high] != other[low - shift : high - shift]), [high]))
        after = np.unique(np.searchsorted(breaks, np.array(ats)))
        out += [(int(breaks[k - 1]) + 1, int(breaks[k])) for k in after if breaks[k] - breaks[k - 1] - 1 >= min_words and k]
    return out


def passages_of(pairs: DataFrame, min_words: int) -> DataFrame:
    """Passages of each pair (doc_id, text_key, first_doc_id, text, first_text, seeds): its word and character bounds."""
    arrow_batches(pairs.sparkSession)
    kind = pairs.schema["doc_id"].dataType.simpleString()
    names = ["doc_id", "text_key", "first_doc_id", "word", "word_end", "start", "end"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for i in range(batch.num_rows):
                text, first = batch.column(3)[i].as_py(), batch.column(4)[i].as_py()
                found = extended(normal_words(text), normal_words(first), [(s["word"], s["first_word"]) for s in batch.column(5)[i].as_py()], min_words)
                if found:
                    spots = [m.span() for m in WORD.finditer(text)]
                    rows += [(i, a, b, spots[a][0], spots[b - 1][1]) for a, b in found]
            if rows:
                at, *bounds = zip(*rows)
                head = [batch.column(c).take(pa.array(at, pa.int64())) for c in range(3)]
                yield pa.RecordBatch.from_arrays([*head, *(pa.array(b, pa.int64()) for b in bounds)], names=names)

    return pairs.select("doc_id", "text_key", "first_doc_id", "text", "first_text", "seeds").mapInArrow(run, f"doc_id {kind}, text_key bigint, first_doc_id {kind}, word bigint, word_end bigint, start bigint, end bigint")


def repeated_passages(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_words: int = MIN_WORDS, seed_words: int = SEED_WORDS) -> DataFrame:
    """Passages to remove: doc_id, text_key, start, length, n_words, first_doc_id (the least id that has a part of it first).

    ``start`` and ``length`` are code points of the original text, from the
    passage's first word to its last; passages that touch or overlap are one.
    The earliest occurrence has the smallest (id, text_key, word), null ids
    first, ``text_key`` being 60 bits of the text's MD5; rows equal in both are
    one document and get one set of rows. Null, empty and blank texts have no
    passages, and an empty table gives none. A digest collision (64 bits) may
    hide a seed but never removes a word: words are compared.
    """
    key = F.conv(F.substring(F.md5(column(text_col)), 1, 15), 16, 10).cast("long")
    slim = docs.filter(column(text_col).isNotNull()).select(column(id_col).alias("doc_id"), key.alias("text_key"), column(text_col).alias("text"), F.unhex(F.md5(column(text_col))).alias("md5"))
    kind = slim.schema["doc_id"].dataType.simpleString()
    cut = Stored(with_units(slim, seed_words), "units")
    # Of equal texts only the earliest gives units.
    texts = cut.df.groupBy("md5").agg(F.min(F.struct("doc_id")).alias("rep"), F.max(F.struct("doc_id")).alias("last")).filter("rep <> last")
    copies = cut.df.drop("units").join(texts, "md5").filter(F.struct("doc_id") != F.col("rep")).distinct()
    copies = Stored(copies.select("doc_id", "text_key", "n_words", "first", "end", F.col("rep.doc_id").alias("rep_id")), "copies")
    gone = copies.df.select(F.col("doc_id").alias("copy_id"), F.col("text_key").alias("copy_key"))
    own = cut.df.join(gone, F.col("doc_id").eqNullSafe(F.col("copy_id")) & (F.col("text_key") == F.col("copy_key")), "left_anti")
    own = Stored(own.select("doc_id", "text_key", "units"), "own-units")
    cut.release()
    # Exploded anew where needed: the rows of all units are many times what is found among them.
    units = own.df.select("doc_id", "text_key", F.explode("units").alias("u")).select("doc_id", "text_key", "u.*")
    spot = F.struct("doc_id", "text_key", "word")
    firsts = units.groupBy("digest").agg(F.min(spot).alias("at"), F.count("*").alias("held"))
    firsts = Stored(firsts.filter("held > 1").select("digest", "at"), "first-units")
    seeds = Stored(units.join(firsts.df, "digest").filter(spot != F.col("at")).drop("digest").distinct(), "seeds")
    own.release()
    # Runs of neighbouring seeds (a unit's left bound is where the one before begins), with the words up to the units that are none.
    doc = Window.partitionBy("doc_id", "text_key")
    breaks = F.coalesce(F.lag("word").over(doc.orderBy("word")) != F.col("left"), F.lit(True)).cast("int")
    runs = seeds.df.withColumn("breaks", breaks).withColumn("run", F.sum("breaks").over(doc.orderBy("word").rowsBetween(Window.unboundedPreceding, 0)))
    whole = Window.partitionBy("doc_id", "text_key", "run")
    runs = runs.withColumn("room", F.max("right").over(whole) - F.min("left").over(whole)).filter(F.col("room") >= min_words)
    pairs = runs.groupBy("doc_id", "text_key", F.col("at.doc_id").alias("first_id"), F.col("at.text_key").alias("first_key")).agg(F.collect_list(F.struct("word", F.col("at.word").alias("first_word"))).alias("seeds"))
    pairs = Stored(pairs, "passage-pairs")
    sides = pairs.df.select(F.col("doc_id").alias("need_id"), F.col("text_key").alias("need_key")).unionByName(pairs.df.select(F.col("first_id").alias("need_id"), F.col("first_key").alias("need_key"))).distinct()
    needed = slim.join(sides, F.col("doc_id").eqNullSafe(F.col("need_id")) & (F.col("text_key") == F.col("need_key"))).groupBy("need_id", "need_key").agg(F.first("text").alias("text"))
    needed = Stored(needed, "passage-texts")
    as_own = needed.df.select(F.col("need_id").alias("own_id"), F.col("need_key").alias("own_key"), "text")
    as_first = needed.df.select("need_id", "need_key", F.col("text").alias("first_text"))
    both = pairs.df.join(as_own, F.col("doc_id").eqNullSafe(F.col("own_id")) & (F.col("text_key") == F.col("own_key")))
    both = both.join(as_first, F.col("first_id").eqNullSafe(F.col("need_id")) & (F.col("first_key") == F.col("need_key")))
    found = Stored(passages_of(both.withColumnRenamed("first_id", "first_doc_id"), min_words), "pair-passages")
    # Stretches of one document that touch or overlap become one passage.
    order = doc.orderBy("word", "word_end").rowsBetween(Window.unboundedPreceding, -1)
    opens = (F.col("word") > F.coalesce(F.max("word_end").over(order), F.lit(-1))).cast("int")
    numbered = found.df.withColumn("opens", opens).withColumn("no", F.sum("opens").over(doc.orderBy("word", "word_end").rowsBetween(Window.unboundedPreceding, 0)))
    merged = numbered.groupBy("doc_id", "text_key", "no").agg(F.min("start").alias("start"), F.max("end").alias("end"), (F.max("word_end") - F.min("word")).alias("n_words"), F.min("first_doc_id").alias("first_doc_id"))
    columns = ["doc_id", "text_key", "start", (F.col("end") - F.col("start")).alias("length"), "n_words", "first_doc_id"]
    again = copies.df.filter(F.col("n_words") >= min_words).select("doc_id", "text_key", F.col("first").alias("start"), "end", "n_words", F.col("rep_id").cast(kind).alias("first_doc_id"))
    out = Stored(merged.select(*columns).unionByName(again.select(*columns)), "passages")
    for table in (copies, firsts, seeds, pairs, needed, found):
        table.release()
    return out.df


def remove_passages(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_words: int = MIN_WORDS, spans: str = "removed_spans") -> DataFrame:
    """``docs`` without the repeated passages (and the space after each), all rows kept.

    Adds ``spans``: array of (start, length) in the original text, empty where
    nothing went; a clashing name gets underscores in front.
    """
    found = repeated_passages(docs, id_col, text_col, min_words)
    spans, pid, pkey, key = (fresh_name(docs, n) for n in (spans, "passage_id", "passage_key", "text_key"))
    per_doc = found.groupBy(F.col("doc_id").alias(pid), F.col("text_key").alias(pkey)).agg(F.array_sort(F.collect_set(F.struct("start", "length"))).alias(spans))
    joined = docs.withColumn(key, F.conv(F.substring(F.md5(column(text_col)), 1, 15), 16, 10).cast("long")).join(per_doc, column(id_col).eqNullSafe(column(pid)) & (column(key) == column(pkey)), "left")
    text, cuts = column(text_col), column(spans)
    stop = lambda s: F.least(s["start"] + s["length"] + 1, F.char_length(text))
    begin = lambda i: F.when(i == 0, F.lit(0)).otherwise(stop(F.get(cuts, i - 1)))
    between = F.transform(cuts, lambda s, i: F.substring(text, begin(i).cast("int") + 1, (s["start"] - begin(i)).cast("int")))
    tail = F.substring(text, stop(F.element_at(cuts, -1)).cast("int") + 1, F.char_length(text))
    rest = F.when(cuts.isNull(), text).otherwise(F.concat(F.array_join(between, ""), tail))
    empty = F.array().cast("array<struct<start:bigint,length:bigint>>")
    kept = [column(c) if c != text_col else rest.alias(text_col) for c in docs.columns]
    return joined.select(*kept, F.coalesce(cuts, empty).alias(spans))


def oracle_sql(min_words: int = MIN_WORDS, seed_words: int = SEED_WORDS) -> str:
    """DuckDB SQL of ``repeated_passages`` over ``documents``, without text_key: no prefilter, words joined along each shift."""
    space = "\\x20\\x09-\\x0D"
    return f"""
WITH d AS MATERIALIZED (SELECT row_number() OVER (ORDER BY doc_id NULLS FIRST, md5(text)) AS r, doc_id, text FROM (SELECT DISTINCT doc_id, text FROM documents WHERE text IS NOT NULL)),
p AS (SELECT r, unnest(regexp_extract_all(text, '[{space}]*[^{space}]+')) AS part, generate_subscripts(regexp_extract_all(text, '[{space}]*[^{space}]+'), 1) - 1 AS i FROM d),
w AS (
  SELECT r, i, length(word) AS n, CAST(sum(length(part)) OVER (PARTITION BY r ORDER BY i) AS BIGINT) AS stop,
    CASE WHEN contains(lead(gap) OVER (PARTITION BY r ORDER BY i), chr(10)) THEN word || chr(10) ELSE word END AS word, regexp_matches(word, '[.!?,;:]$') OR coalesce(contains(lead(gap) OVER (PARTITION BY r ORDER BY i), chr(10)), false) AS ends
  FROM (SELECT r, i, part, translate(regexp_extract(part, '[^{space}]+$'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS word, regexp_extract(part, '^[{space}]*') AS gap FROM p)),
t AS MATERIALIZED (SELECT *, stop - n AS start, coalesce(lag(ends) OVER (PARTITION BY r ORDER BY i), true) AS opens FROM w),
copy AS MATERIALIZED (SELECT d.r, d.doc_id, min(o.r) AS rep FROM d JOIN d o ON o.text = d.text AND o.r < d.r GROUP BY ALL),
b AS (SELECT s.r, s.i, min(e.i) AS last FROM t s JOIN t e ON e.r = s.r AND e.ends AND e.i >= s.i + {seed_words - 1} WHERE s.opens GROUP BY ALL),
u AS MATERIALIZED (SELECT b.r, b.i, string_agg(word, ' ' ORDER BY t.i) AS unit FROM b ANTI JOIN copy USING (r) JOIN t ON t.r = b.r AND t.i BETWEEN b.i AND b.last GROUP BY ALL),
f AS (SELECT unit, min((r, i)) AS at FROM u GROUP BY unit HAVING count(*) > 1),
seeds AS MATERIALIZED (SELECT u.r, u.i, f.at[1] AS fr, u.i - f.at[2] AS shift FROM u JOIN f USING (unit) WHERE (u.r, u.i) <> f.at),
same AS (SELECT s.r, s.fr, s.shift, x.i FROM (SELECT DISTINCT r, fr, shift FROM seeds) s JOIN t x ON x.r = s.r JOIN t y ON y.r = s.fr AND y.i = x.i - s.shift AND y.word = x.word),
stretch AS (
  SELECT r, fr, shift, min(i) AS a, max(i) AS b FROM (SELECT *, i - row_number() OVER (PARTITION BY r, fr, shift ORDER BY i) AS k FROM same) GROUP BY r, fr, shift, k HAVING count(*) >= {min_words}),
good AS (SELECT DISTINCT x.r, x.fr, x.a, x.b FROM stretch x JOIN seeds s ON s.r = x.r AND s.fr = x.fr AND s.shift = x.shift AND s.i BETWEEN x.a AND x.b),
covered AS (SELECT g.r, i, min(f.doc_id) AS first_doc_id FROM (SELECT r, fr, unnest(range(a, b + 1)) AS i FROM good) g JOIN d f ON f.r = fr GROUP BY g.r, i),
parts AS (SELECT *, i - row_number() OVER (PARTITION BY r ORDER BY i) AS k FROM covered),
merged AS (SELECT r, min(i) AS a, max(i) AS b, min(first_doc_id) AS first_doc_id FROM parts GROUP BY r, k),
out AS (
  SELECT r, a, b, first_doc_id FROM merged
  UNION ALL SELECT copy.r, 0, count(*) - 1, d.doc_id FROM copy JOIN t ON t.r = copy.r JOIN d ON d.r = copy.rep GROUP BY copy.r, d.doc_id HAVING count(*) >= {min_words})
SELECT d.doc_id, x.start, y.stop - x.start AS length, b - a + 1 AS n_words, first_doc_id
FROM out JOIN d USING (r) JOIN t x ON x.r = out.r AND x.i = a JOIN t y ON y.r = out.r AND y.i = b
"""
