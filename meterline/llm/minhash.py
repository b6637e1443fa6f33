"""MinHash near-duplicates by an inverted join over signature coordinates.

Documents with equal shingle sets are one class. Each class has a signature of
``COORDINATES`` minima and is posted under its values; two classes are
candidates if they collide in at least as many coordinates as the similarity
leaves no real doubt about (``threshold``), and candidates are confirmed on
their full sets.

Counting collisions merges few lists: values are ordered by how many classes
hold them, and two classes that share ``t`` values share one of the rarest
``coordinates - t + 1`` of each, so only those prefixes are posted and the
longest lists are skipped. Values of one class alone are never posted, and a
class with fewer than ``t`` shared values is out at once.

Lists are merged in rounds. In the first, a short list meets all its members
and a longer one its most central member, a pair in its first common list only.
Links found join components, and a list whose members share one is finished. In
the others, a crowd's stragglers meet the rest of their list in blocks: a task
gets a bounded block of hubs and one of members with their sets, counts all
common shingles by matrix products and hands on no more links than it has
components. Shingles that no other class in an open list has cannot be shared;
a class with too many of them is out before. Hubs have met all they could and
leave, so every pair that could join two components is decided, and what is
shuffled stays linear in the lists.
"""

from __future__ import annotations

import hashlib
from math import comb

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from meterline.llm.common import Stored, arrow_batches, column, fresh_name
from meterline.llm.decontaminate import WordHashes, shingle_hashes
from meterline.llm.simhash import components

COORDINATES = 64
SEED = 42
# Chance that a linked pair has fewer equal coordinates than the threshold.
MISS = 1e-9
# Lists of up to this many members are merged at once: at most half as many pairs a member.
SHORT_LIST = 16
# Hubs and members that meet in one task, and the shingles that either of them may hold.
BLOCK_CLASSES, BLOCK_SHINGLES = 2048, 1 << 22
# Shingles counted by one matrix product.
PRODUCT_COLUMNS = 4096
# Shingles permuted at once: bounds the matrix of a very long text.
HASH_BLOCK = 1 << 13


def threshold(coordinates: int, percent: int, miss: float = MISS) -> int:
    """The most collisions that a pair of exactly ``percent`` similarity reaches but for a chance of ``miss``."""
    s, below = percent / 100, 0.0
    for t in range(coordinates + 1):
        below += comb(coordinates, t) * s**t * (1 - s) ** (coordinates - t)
        if below > miss:
            return max(1, t)
    return coordinates


def shingle_set(text: str | None, k: int, hashes: WordHashes) -> np.ndarray:
    """Sorted 64-bit hashes of the distinct shingles; fewer words than a shingle: the whole sequence is one."""
    words = (text or "").encode("utf-8").lower().split()  # bytes: A-Z and the six ASCII spaces only
    if not words:
        return np.zeros(0, np.uint64)
    values = np.fromiter(map(hashes.__getitem__, words), np.uint64, len(words))
    return np.unique(shingle_hashes(values, min(k, len(words))))


def permutations(coordinates: int) -> tuple[np.ndarray, np.ndarray]:
    rng = np.random.default_rng(SEED)
    factors, shifts = rng.integers(0, 1 << 63, (2, coordinates, 1), dtype=np.uint64)
    return factors * np.uint64(2) + np.uint64(1), shifts


def signature(shingles: np.ndarray, factors: np.ndarray, shifts: np.ndarray) -> np.ndarray:
    """The least value of the set under each permutation."""
    out = np.full(len(factors), np.iinfo(np.uint64).max, np.uint64)
    for at in range(0, len(shingles), HASH_BLOCK):
        np.minimum(out, (shingles[at : at + HASH_BLOCK] * factors + shifts).min(axis=1), out=out)
    return out


def with_signatures(docs: DataFrame, shingle_words: int, coordinates: int) -> DataFrame:
    """``docs`` (doc_id, text, md5) as doc_id, md5, n, digest of the set, signature."""
    arrow_batches(docs.sparkSession)
    kind = docs.schema["doc_id"].dataType.simpleString()

    def run(batches):
        hashes, (factors, shifts) = WordHashes(), permutations(coordinates)
        for batch in batches:
            sets = [shingle_set(t.as_py(), shingle_words, hashes) for t in batch.column(1)]
            digests = pa.array([hashlib.blake2b(s.tobytes(), digest_size=16).digest() for s in sets], pa.binary())
            rows = np.stack([signature(s, factors, shifts) for s in sets]).view(np.int64) if sets else np.zeros((0, coordinates), np.int64)
            lists = pa.ListArray.from_arrays(pa.array(np.arange(len(sets) + 1) * coordinates, pa.int32()), pa.array(rows.ravel()))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(2), pa.array([len(s) for s in sets], pa.int64()), digests, lists], names=["doc_id", "md5", "n", "digest", "signature"])

    return docs.select("doc_id", "text", "md5").mapInArrow(run, f"doc_id {kind}, md5 binary, n bigint, digest binary, signature array<bigint>")


def with_sets(docs: DataFrame, shingle_words: int) -> DataFrame:
    """``docs`` (cls, text) as cls and its set's hashes, sorted, eight bytes each."""
    arrow_batches(docs.sparkSession)

    def run(batches):
        hashes = WordHashes()
        for batch in batches:
            sets = [shingle_set(t.as_py(), shingle_words, hashes).tobytes() for t in batch.column(1)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(sets, pa.binary())], names=["cls", "shingles"])

    return docs.select("cls", "text").mapInArrow(run, "cls bigint, shingles binary")


def posted(classes: DataFrame, least: int) -> DataFrame:
    """(key, cls, prefix, weight, n): the prefix postings of every class that can collide ``least`` times with another.

    ``prefix`` has the class's keys in the order of the lists' lengths,
    ``weight`` counts the others that share its values: the middle of a crowd
    has the highest.
    """
    keys = classes.filter("n > 0").select("cls", F.explode("signature").alias("key"))
    held = Stored(keys.groupBy("key").agg(F.count("*").alias("held")).filter("held > 1"), "minhash-values")
    shared = keys.join(held.df, "key").groupBy("cls").agg(F.sum("held").alias("weight"), F.array_sort(F.collect_list(F.struct("held", "key"))).alias("shared"))
    # The values held alone come first in the order; they take up the rest of the prefix.
    prefix = F.slice("shared", 1, F.size("shared") - least + 1)["key"]
    rows = shared.filter(F.size("shared") >= least).select("cls", "weight", prefix.alias("prefix")).join(classes.select("cls", "n"), "cls")
    out = Stored(rows.select(F.explode("prefix").alias("key"), "cls", "prefix", "weight", "n"), "minhash-postings")
    held.release()
    return out.df


def confirmed(pairs: DataFrame, percent: int) -> DataFrame:
    """(comp_a, comp_b) of the ``pairs`` (comp_a, comp_b, set_a, set_b) whose sets are similar enough."""
    arrow_batches(pairs.sparkSession)

    def run(batches):
        for batch in batches:
            good = []
            for x, y in zip(batch.column(2), batch.column(3)):
                x, y = (np.frombuffer(v.as_buffer(), np.uint64) for v in (x, y))
                if len(x) > len(y):
                    x, y = y, x
                at = np.searchsorted(y, x)
                both = int((y[np.minimum(at, len(y) - 1)] == x).sum())
                good.append(100 * both >= percent * (len(x) + len(y) - both))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1)], names=["a", "b"]).filter(pa.array(good, pa.bool_()))

    return pairs.select("comp_a", "comp_b", "set_a", "set_b").mapInArrow(run, "a bigint, b bigint")


def with_alone(held: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """``held`` without the classes that have no partner in it for all the shingles that no other class of ``held`` has."""
    arrow_batches(held.sparkSession)

    def run(batches):
        for batch in batches:
            for cls, raw in zip(batch.column(0), batch.column(1)):
                values = np.frombuffer(raw.as_buffer(), np.int64)
                for at in range(0, len(values), HASH_BLOCK):
                    part = values[at : at + HASH_BLOCK]
                    yield pa.RecordBatch.from_arrays([pa.array(np.full(len(part), cls.as_py())), pa.array(part)], names=["cls", "h"])

    rows = sets.join(held.select("cls").distinct(), "cls", "left_semi").select("cls", "shingles").mapInArrow(run, "cls bigint, h bigint")
    single = rows.groupBy("h").agg(F.count("*").alias("held_by"), F.min("cls").alias("cls")).filter("held_by = 1")
    counted = single.groupBy("cls").agg(F.count("*").alias("alone"))
    out = held.join(counted, "cls", "left")
    return out.filter(F.col("n") * (100 - percent) >= F.coalesce("alone", F.lit(0)) * 100).select(*held.columns)


def candidate_pairs(held: DataFrame, percent: int) -> tuple[DataFrame, DataFrame]:
    """(pairs, hubs) of the first round over ``held``: postings with comp, and their list's ``main`` component and ``size``."""
    order = Window.partitionBy("key").orderBy(F.desc("weight"), "cls")
    longer = held.filter(F.col("size") > SHORT_LIST).withColumn("no", F.row_number().over(order)).filter(F.col("no") <= 1).drop("no")
    hubs = held.filter(F.col("size") <= SHORT_LIST).unionByName(longer)
    hubs = Stored(hubs.select("key", F.col("cls").alias("hub"), F.col("comp").alias("hub_comp"), F.col("prefix").alias("hub_prefix"), F.col("n").alias("hub_n")), "minhash-hubs").df
    # A pair is met in the first list that both are posted in.
    first_common = F.get(F.array_intersect(held["prefix"], hubs["hub_prefix"]), F.lit(0)) == held["key"]
    sized = F.least("n", "hub_n") * 100 >= F.greatest("n", "hub_n") * percent
    met = held.join(hubs, (held["key"] == hubs["key"]) & (F.col("comp") != F.col("hub_comp")) & sized & first_common)
    turned = F.col("cls") < F.col("hub")
    either = lambda x, y: F.when(turned, F.col(x)).otherwise(F.col(y))
    pairs = met.select(either("cls", "hub").alias("a"), either("hub", "cls").alias("b"), either("comp", "hub_comp").alias("comp_a"), either("hub_comp", "comp").alias("comp_b"))
    return pairs.distinct(), hubs


def common_counts(hubs: list[np.ndarray], members: list[np.ndarray]) -> np.ndarray:
    """How many shingles each hub (row) shares with each member (column)."""
    rows = [np.repeat(np.arange(len(sets)), [len(x) for x in sets]) for sets in (hubs, members)]
    values = [np.concatenate(sets) for sets in (hubs, members)]
    both = np.intersect1d(*map(np.unique, values), assume_unique=True)
    out = np.zeros((len(hubs), len(members)), np.float32)
    if not len(both):
        return out
    at = [np.searchsorted(both, v) for v in values]
    used = [both[np.minimum(i, len(both) - 1)] == v for i, v in zip(at, values)]
    placed = [(r[u], i[u]) for r, i, u in zip(rows, at, used)]
    for low in range(0, len(both), PRODUCT_COLUMNS):
        width = min(PRODUCT_COLUMNS, len(both) - low)
        sides = []
        for (r, i), n in zip(placed, out.shape):
            own = (i >= low) & (i < low + width)
            side = np.zeros((n, width), np.float32)
            side[r[own], i[own] - low] = 1
            sides.append(side)
        out += sides[0] @ sides[1].T
    return out


def spanning_links(linked: np.ndarray, hub_comps: np.ndarray, member_comps: np.ndarray) -> list[tuple[int, int]]:
    """Links between components that join the same ones as all of ``linked`` (hub by member)."""
    names, number = np.unique(np.concatenate([hub_comps, member_comps]), return_inverse=True)
    own, others = number[: len(hub_comps)], number[len(hub_comps) :]
    label, out = np.arange(len(names)), []
    for h in np.flatnonzero(linked.any(axis=1)):
        groups = np.unique(np.append(label[others[linked[h]]], label[own[h]]))
        if len(groups) > 1:
            out += [(int(names[groups[0]]), int(names[g])) for g in groups[1:]]
            label[np.isin(label, groups)] = groups[0]
    return out


def crowd_links(held: DataFrame, sets: DataFrame, percent: int) -> tuple[DataFrame, DataFrame]:
    """(links between components, hubs) of a round over long lists: blocks of hubs, outside the main component first, meet blocks of members."""
    first = Window.partitionBy("key").orderBy(F.col("comp") == F.col("main"), "cls")
    hubs = held.withColumn("no", F.row_number().over(first)).filter(F.col("no") <= BLOCK_CLASSES)
    upto = F.sum("n").over(first.rowsBetween(Window.unboundedPreceding, 0))
    hubs = Stored(hubs.withColumn("upto", upto).filter((F.col("no") == 1) | (F.col("upto") <= BLOCK_SHINGLES)).select("key", "cls", "comp", "blocks"), "minhash-hubs").df
    members = held.select("key", F.pmod(F.xxhash64("cls"), F.col("blocks")).alias("block"), "cls", "comp", F.lit(False).alias("is_hub"))
    met = hubs.select("key", F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)).alias("block"), "cls", "comp", F.lit(True).alias("is_hub"))
    rows = members.unionByName(met).join(sets, "cls").select("key", "block", "comp", "is_hub", "shingles")

    def meet(table: pa.Table) -> pa.Table:
        comps, is_hub = table.column("comp").to_numpy(), table.column("is_hub").to_numpy()
        values = [np.frombuffer(v.as_buffer(), np.uint64) for v in table.column("shingles")]
        sides = [np.flatnonzero(is_hub), np.flatnonzero(~is_hub)]
        links = []
        if all(map(len, sides)):
            hub_sets, member_sets = ([values[i] for i in side] for side in sides)
            both = common_counts(hub_sets, member_sets).astype(np.int64)
            n_hub, n_member = (np.array([len(x) for x in own]) for own in (hub_sets, member_sets))
            links = spanning_links(both * (100 + percent) >= percent * (n_hub[:, None] + n_member[None, :]), comps[sides[0]], comps[sides[1]])
        return pa.table({"a": pa.array([a for a, _ in links], pa.int64()), "b": pa.array([b for _, b in links], pa.int64())})

    return rows.groupBy("key", "block").applyInArrow(meet, "a bigint, b bigint"), hubs


def class_components(docs: DataFrame, classes: DataFrame, shingle_words: int, percent: int, coordinates: int) -> DataFrame:
    """(cls, comp) of every class that can have a link: its component, named by one of its classes."""
    least = threshold(coordinates, percent)
    postings = posted(classes, least)
    comps = Stored(postings.select("cls").distinct().withColumn("comp", F.col("cls")), "minhash-comps")
    live = comps.df.select("cls").join(classes, "cls").select("cls", F.col("rep.doc_id").alias("rep_id"), F.col("rep.md5").alias("rep_md5"))
    texts = docs.join(live, F.col("doc_id").eqNullSafe(F.col("rep_id")) & (F.col("md5") == F.col("rep_md5"))).select("cls", "text")
    # Rows that repeat an id and its text give their class's set once each.
    sets = Stored(with_sets(texts, shingle_words).groupBy("cls").agg(F.first("shingles").alias("shingles")), "minhash-sets")
    side = Stored(classes.join(comps.df.select("cls"), "cls").select("cls", "signature"), "minhash-live")
    named = lambda df, old, new, end: df.select(F.col("cls").alias(end), F.col(old).alias(new))
    open_rows, first, spent = postings, True, []
    while True:
        members = Stored(open_rows.join(comps.df, "cls"), "minhash-members")
        for table in spent:
            table.release()
        sizes = members.df.groupBy("key", "comp").agg(F.count("*").alias("k"), F.sum("n").alias("shingles"))
        lists = sizes.groupBy("key").agg(F.max(F.struct("k", "comp")).alias("m"), F.sum("k").alias("size"), F.sum("shingles").alias("shingles"), F.count("*").alias("comps")).filter("comps > 1")
        blocks = F.greatest(F.ceil(F.col("size") / BLOCK_CLASSES), F.ceil(F.col("shingles") / BLOCK_SHINGLES))
        held = Stored(members.df.join(lists.select("key", F.col("m.comp").alias("main"), "size", blocks.alias("blocks")), "key"), "minhash-open")
        members.release()
        if not held.df.limit(1).count():
            break
        spent = [held]
        if first:
            pairs, hubs = candidate_pairs(held.df, percent)
            hubs = hubs.select("key", F.col("hub").alias("cls"))
            alike = F.expr("size(filter(zip_with(s_a, s_b, (x, y) -> x = y), e -> e))") >= least
            likely = pairs.join(named(side.df, "signature", "s_a", "a"), "a").join(named(side.df, "signature", "s_b", "b"), "b").filter(alike)
            likely = Stored(likely.select("a", "b", "comp_a", "comp_b"), "minhash-likely")
            both = likely.df.join(named(sets.df, "shingles", "set_a", "a"), "a").join(named(sets.df, "shingles", "set_b", "b"), "b")
            links, first = Stored(confirmed(both, percent).distinct(), "minhash-links"), False
            spent.append(likely)
        else:
            held = Stored(with_alone(held.df, sets.df, percent), "minhash-told")
            spent.append(held)
            found, hubs = crowd_links(held.df, sets.df, percent)
            links = Stored(found.distinct(), "minhash-links")
        if links.df.limit(1).count():
            joined = components(links.df).select(F.col("v").alias("comp"), "root")
            after = Stored(comps.df.join(joined, "comp", "left").select("cls", F.coalesce("root", "comp").alias("comp")), "minhash-comps")
            comps.release()
            comps = after
        open_rows = held.df.select("key", "cls", "prefix", "weight", "n").join(hubs.select("key", "cls"), ["key", "cls"], "left_anti")
        spent.append(links)
    for table in (sets, side, held):
        table.release()
    return comps.df


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle_words: int = 3, percent: int = 85, coordinates: int = COORDINATES) -> DataFrame:
    """One row per row of ``docs``: doc_id, n_shingles, component_id, kept.

    Two documents are linked if 100 * (shingles of both) >= ``percent`` *
    (shingles of either). ``component_id`` is the smallest id reachable over
    links, ``kept`` says that it is the row's own. Rows of equal sets are one
    class. Null, empty and blank texts have no shingles, are linked with
    nothing and are kept. A null id is never the smallest where its component
    has another; a component of null ids only has a null component_id and its
    rows are kept. Repeated rows stay repeated; no rows give no rows.
    """
    slim = docs.select(column(id_col).alias("doc_id"), column(text_col).alias("text"), F.unhex(F.md5(F.coalesce(column(text_col), F.lit("")))).alias("md5"))
    prints = Stored(with_signatures(slim, shingle_words, coordinates), "minhash-prints").df
    rep = F.min(F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "md5"))
    grouped = prints.groupBy("digest").agg(rep.alias("rep"), F.first("n").alias("n"), F.first("signature").alias("signature"))
    classes = Stored(grouped.withColumn("cls", F.monotonically_increasing_id()), "minhash-classes").df
    comps = class_components(slim.filter("text IS NOT NULL"), classes, shingle_words, percent, coordinates)
    own = classes.select("digest", "cls", F.col("rep.doc_id").alias("first_id")).join(comps, "cls", "left")
    rooted = Stored(own.select("digest", F.coalesce("comp", "cls").alias("root"), "first_id"), "minhash-roots").df
    smallest = Stored(rooted.groupBy("root").agg(F.min("first_id").alias("component_id")), "minhash-components").df
    ids = Stored(rooted.join(smallest, "root").select("digest", "component_id"), "minhash-ids").df
    found = prints.select("doc_id", "n", "digest").join(ids, "digest")
    component = F.when(F.col("n") == 0, F.col("doc_id")).otherwise(F.col("component_id"))
    return found.select("doc_id", F.col("n").alias("n_shingles"), component.alias("component_id"), component.eqNullSafe(F.col("doc_id")).alias("kept"))


def keep_one(docs: DataFrame, id_col: str = "doc_id", **options) -> DataFrame:
    """The rows of ``docs`` whose id is the smallest of their component, columns unchanged; rows that share such an id all stay."""
    kept_id = fresh_name(docs, "kept_id")
    found = near_duplicates(docs, id_col, **options).filter("kept").select(F.col("doc_id").alias(kept_id)).distinct()
    return docs.join(found, column(id_col).eqNullSafe(column(kept_id)), "left_semi")


def oracle_sql(shingle_words: int = 3, percent: int = 85) -> str:
    """DuckDB SQL of ``near_duplicates(documents)``: all shared shingles counted."""
    words = r"regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+')"
    return f"""
WITH RECURSIVE d AS MATERIALIZED (SELECT row_number() OVER () AS r, doc_id, {words} AS w FROM documents),
s AS MATERIALIZED (
  SELECT DISTINCT r, array_to_string(w[i : i + {shingle_words - 1}], ' ') AS shingle
  FROM (SELECT r, w, unnest(range(1, greatest(len(w) - {shingle_words - 1}, 1) + 1)) AS i FROM d WHERE len(w) > 0)),
n AS MATERIALIZED (SELECT r, count(*) AS n FROM s GROUP BY r),
common AS (SELECT x.r AS a, y.r AS b, count(*) AS c FROM s x JOIN s y ON x.shingle = y.shingle AND x.r <> y.r GROUP BY ALL),
links AS MATERIALIZED (SELECT a, b FROM common JOIN n na ON na.r = a JOIN n nb ON nb.r = b WHERE 100 * c >= {percent} * (na.n + nb.n - c)),
reach(r, t) AS (SELECT r, r FROM d UNION SELECT reach.r, b FROM reach JOIN links ON a = t),
smallest AS (SELECT reach.r, min(d.doc_id) AS component_id FROM reach JOIN d ON d.r = reach.t GROUP BY reach.r)
SELECT d.doc_id, coalesce(n.n, 0) AS n_shingles, component_id, d.doc_id IS NOT DISTINCT FROM component_id AS kept
FROM d JOIN smallest USING (r) LEFT JOIN n USING (r)
"""
