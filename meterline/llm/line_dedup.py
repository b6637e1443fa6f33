"""Line dedup by content-defined chunks of lines.

A line opens a chunk if its hash is below the next line's, so a boundary hangs
on two lines alone and an inserted or deleted line moves only those beside it.
The slices of one MD5 give several such orders of lines and with each a chunking
of its own: what one of them cuts badly another cuts well. Chunks of several
lines that occur more than once in the corpus are removed except for the
earliest one, after their bytes were compared with the earliest's. A line goes
if any of its chunks goes; an equal line then stands at an earlier place, and
the earliest of all stays. DataFrame and SQL functions only.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from meterline.llm.common import Stored, column, fresh_name, once

# Chunkings, each from its own 28 bits of a line's MD5 (DuckDB and Spark agree on these).
CHUNKINGS = 4
DIGITS = 7
MIN_LINES = 2


def chunk_starts(hashes: Column, slice_no: int) -> Column:
    """1-based first lines of the chunks by one slice of the lines' MD5 hashes, which compare as their digits do."""
    bits = lambda i: F.substring(F.get(hashes, i), 1 + DIGITS * slice_no, DIGITS)
    return F.filter(F.sequence(F.lit(1), F.size(hashes)), lambda i: (i == 1) | F.coalesce(bits(i - 1) < bits(i), F.lit(False)))


def spans(opens: Column, n_lines: Column) -> Column:
    return F.transform(opens, lambda first, i: F.struct(first.alias("first"), (F.coalesce(F.get(opens, i + 1), n_lines + 1) - first).alias("n")))


def chunk_text(lines: Column, chunk: Column) -> Column:
    return F.array_join(F.slice(lines, chunk["first"], chunk["n"]), "\n")


def with_chunks(docs: DataFrame, text_col: str, lines: str, chunks: str, chunkings: int) -> DataFrame:
    """``docs`` with its ``lines`` and its different ``chunks``: (first line from 1, n lines). A null text has none."""
    cut = once(docs, lines, F.split(column(text_col), "\n"))
    cut = once(cut, chunks, F.transform(column(lines), lambda line: F.md5(line)))
    cut = once(cut, chunks, F.array(*[chunk_starts(column(chunks), k) for k in range(chunkings)]))
    return once(cut, chunks, F.array_distinct(F.flatten(F.transform(column(chunks), lambda opens: spans(opens, F.size(column(lines)))))))


def eligible(lines: Column, chunk: Column, min_lines: int) -> Column:
    """Whether a chunk has ``min_lines`` lines that are not blank."""
    return F.size(F.filter(F.slice(lines, chunk["first"], chunk["n"]), lambda line: F.trim(line) != "")) >= min_lines


def repeated_chunks(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", chunkings: int = CHUNKINGS, min_lines: int = MIN_LINES) -> DataFrame:
    """(doc_id, text_md5, gone): the chunks (first, n) to remove from each document.

    A document is known by its id and its text's MD5; rows equal in both are
    one document. The earliest occurrence has the smallest (id, MD5, first
    line), null ids first.
    """
    slim = docs.filter(column(text_col).isNotNull()).select(column(id_col).alias("doc_id"), column(text_col).alias("text"), F.md5(column(text_col)).alias("text_md5"))
    cut = with_chunks(slim, "text", "lines", "chunks", chunkings)
    found = cut.select("doc_id", "text_md5", F.explode(F.transform(F.filter("chunks", lambda c: eligible(F.col("lines"), c, min_lines)), lambda c: F.struct(c["first"].alias("first"), c["n"].alias("n"), F.unhex(F.md5(chunk_text(F.col("lines"), c))).alias("digest")))).alias("c"))
    spots = Stored(found.select("doc_id", "text_md5", "c.*"), "chunk-digests")
    spot = F.struct("doc_id", "text_md5", "first", "n")
    repeats = Stored(spots.df.groupBy("digest").agg(F.min(spot).alias("earliest"), (F.max(spot) != F.min(spot)).alias("again")).filter("again").drop("again"), "repeated-digests")
    hits = spots.df.join(repeats.df, "digest").select("doc_id", "text_md5", F.struct("first", "n", (spot == F.col("earliest")).alias("is_first")).alias("hit"))
    per_doc = Stored(hits.groupBy("doc_id", "text_md5").agg(F.collect_set("hit").alias("hits")), "chunk-hits")
    # The texts of repeated chunks only, once per document, for the comparison of bytes.
    keyed = per_doc.df.select(F.col("doc_id").alias("hit_id"), F.col("text_md5").alias("hit_md5"), "hits")
    held = slim.join(keyed.hint("merge"), F.col("doc_id").eqNullSafe(F.col("hit_id")) & (F.col("text_md5") == F.col("hit_md5")))
    held = once(held, "lines", F.split("text", "\n"))
    texts = held.select("doc_id", "text_md5", F.explode("hits").alias("hit"), "lines")
    texts = texts.select("doc_id", "text_md5", "hit.*", chunk_text(F.col("lines"), F.col("hit")).alias("chunk"))
    texts = Stored(texts.withColumn("digest", F.unhex(F.md5("chunk"))), "chunk-texts")
    firsts = Stored(texts.df.filter("is_first").select("digest", F.col("chunk").alias("first_chunk")).distinct(), "first-chunks")
    same = texts.df.filter("NOT is_first").join(firsts.df, "digest").filter(F.col("chunk") == F.col("first_chunk"))
    out = Stored(same.groupBy("doc_id", "text_md5").agg(F.collect_set(F.struct("first", "n")).alias("gone")), "removed-chunks")
    for table in (spots, repeats, per_doc, texts, firsts):
        table.release()
    return out.df


def line_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", chunkings: int = CHUNKINGS, min_lines: int = MIN_LINES, report: bool = False) -> DataFrame:
    """``docs`` with repeated chunks cut out of ``text_col``; all rows and columns stay.

    What remains of a text is its other lines joined by line breaks, an empty
    string if nothing does. Null and empty texts are unchanged; equal rows are
    treated alike. With ``report``, adds n_lines, n_chunks, removed_chunks and
    removed_lines (long; a null text: 0) in place of all columns but id and text.
    """
    removed = repeated_chunks(docs, id_col, text_col, chunkings, min_lines)
    rid, rmd5, gone, md5 = (fresh_name(docs, n) for n in ("removed_id", "removed_md5", "removed_chunks", "text_md5"))
    keyed = removed.select(F.col("doc_id").alias(rid), F.col("text_md5").alias(rmd5), F.col("gone").alias(gone))
    joined = docs.withColumn(md5, F.md5(column(text_col))).join(keyed.hint("merge"), column(id_col).eqNullSafe(column(rid)) & (column(md5) == column(rmd5)), "left")
    lines, left = (fresh_name(joined, n) for n in ("lines", "left_lines"))
    cut = once(joined, lines, F.split(column(text_col), "\n"))
    numbers = F.flatten(F.transform(column(gone), lambda c: F.sequence(c["first"], c["first"] + c["n"] - 1)))
    cut = once(cut, left, F.array_except(F.sequence(F.lit(1), F.size(column(lines))), numbers))
    rest = F.array_join(F.transform(column(left), lambda i: F.get(column(lines), i - 1)), "\n")
    text = F.when(column(gone).isNull(), column(text_col)).otherwise(rest)
    if not report:
        return cut.withColumn(text_col, text).select(*[column(c) for c in docs.columns])
    chunks = fresh_name(cut, "chunks")
    cut = with_chunks(cut, text_col, lines, chunks, chunkings)
    count = lambda of: F.coalesce(of, F.lit(0)).cast("long")
    has, written = column(gone).isNotNull(), column(text_col).isNotNull()
    return cut.select(
        column(id_col).alias("doc_id"),
        text.alias("text"),
        count(F.when(written, F.size(column(lines)))).alias("n_lines"),
        count(F.when(written, F.size(column(chunks)))).alias("n_chunks"),
        count(F.when(has, F.size(column(gone)))).alias("removed_chunks"),
        count(F.when(has, F.size(column(lines)) - F.size(column(left)))).alias("removed_lines"),
    )


def oracle_sql(chunkings: int = CHUNKINGS, min_lines: int = MIN_LINES) -> str:
    """DuckDB SQL of ``line_dedup(documents, report=True)``."""
    opens = " UNION ALL ".join(f"SELECT {k} AS k, r, i FROM l WHERE i = 1 OR substr(h, {1 + DIGITS * k}, {DIGITS}) < substr(next_h, {1 + DIGITS * k}, {DIGITS})" for k in range(chunkings))
    spot = "(coalesce(doc_id, -9223372036854775808), text_md5, first, n)"
    return f"""
WITH d AS MATERIALIZED (SELECT row_number() OVER () AS r, doc_id, text, md5(text) AS text_md5, string_split(text, chr(10)) AS lines FROM documents),
split AS (SELECT r, unnest(lines) AS line, generate_subscripts(lines, 1) AS i FROM d WHERE text IS NOT NULL),
l AS MATERIALIZED (SELECT r, i, line, md5(line) AS h, lead(md5(line)) OVER (PARTITION BY r ORDER BY i) AS next_h FROM split),
opens AS ({opens}),
c AS MATERIALIZED (
  SELECT DISTINCT r, first, n FROM (
    SELECT o.r, o.i AS first, coalesce(lead(o.i) OVER (PARTITION BY o.r, o.k ORDER BY o.i), len(d.lines) + 1) - o.i AS n FROM opens o JOIN d USING (r))),
s AS (
  SELECT *, min({spot}) OVER (PARTITION BY chunk) AS earliest FROM (
    SELECT c.r, c.first, c.n, d.doc_id, d.text_md5, lines[first:first + n - 1] AS part, array_to_string(lines[first:first + n - 1], chr(10)) AS chunk FROM c JOIN d USING (r))
  WHERE len(list_filter(part, lambda x: trim(x) <> '')) >= {min_lines}),
gone AS MATERIALIZED (SELECT r, first, n FROM s WHERE {spot} <> earliest),
gone_lines AS MATERIALIZED (SELECT DISTINCT r, unnest(generate_series(first, first + n - 1)) AS i FROM gone),
rest AS (SELECT l.r, string_agg(l.line, chr(10) ORDER BY l.i) AS rest FROM l ANTI JOIN gone_lines g ON g.r = l.r AND g.i = l.i GROUP BY 1),
n_chunks AS (SELECT r, count(*) AS n_chunks FROM c GROUP BY 1),
n_gone AS (SELECT r, count(*) AS removed_chunks FROM gone GROUP BY 1),
n_gone_lines AS (SELECT r, count(*) AS removed_lines FROM gone_lines GROUP BY 1)
SELECT d.doc_id, CASE WHEN removed_chunks IS NULL THEN d.text ELSE coalesce(rest, '') END AS text,
  CAST(coalesce(len(d.lines), 0) AS BIGINT) AS n_lines, CAST(coalesce(n_chunks, 0) AS BIGINT) AS n_chunks,
  CAST(coalesce(removed_chunks, 0) AS BIGINT) AS removed_chunks, CAST(coalesce(removed_lines, 0) AS BIGINT) AS removed_lines
FROM d LEFT JOIN rest USING (r) LEFT JOIN n_chunks USING (r) LEFT JOIN n_gone USING (r) LEFT JOIN n_gone_lines USING (r)
"""
