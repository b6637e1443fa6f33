"""SimHash near-duplicates by the generalised pigeonhole principle.

The 64 bits are split into groups of correlated bits. If two fingerprints
differ in at most ``max_distance`` bits and the groups' thresholds sum to
``max_distance - groups + 1``, the two differ within at least one group by no
more than that group's threshold, so probing each group at its own threshold
misses nothing. The thresholds come from a dynamic programme over estimated
candidate counts; a group may get -1 and is then not probed at all.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from meterline.llm.common import Stored, arrow_batches, column, fresh_name

BITS = 64
SEED = 42
# Shingles hashed at once: bounds the bit matrix of a very long text.
HASH_BLOCK = 1 << 16
# A bucket of up to this many fingerprints is verified pair by pair in its row
# of the aggregate; larger ones go through radius-1 balls, which is as exact.
PAIRWISE_BUCKET = 48


def fingerprint(text: str | None, shingle_words: int) -> int:
    """64-bit SimHash; no word: 0, fewer words than a shingle: the whole sequence is the one shingle."""
    import xxhash

    words = (text or "").encode("utf-8").lower().split()  # bytes: A-Z and the six ASCII spaces only
    if not words:
        return 0
    joined = b" ".join(words)
    k = min(shingle_words, len(words))
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1)
    starts = np.concatenate(([0], ends[:-1]))[: len(words) - k + 1].tolist()
    stops = (ends[k - 1 :] - 1).tolist()
    digest, total, n = xxhash.xxh64_intdigest, np.zeros(BITS, np.int64), len(starts)
    for at in range(0, n, HASH_BLOCK):
        block = [digest(joined[i:j], SEED) for i, j in zip(starts[at : at + HASH_BLOCK], stops[at : at + HASH_BLOCK])]
        bits = np.unpackbits(np.array(block, ">u8").view(np.uint8).reshape(-1, 8), axis=1)
        total += bits.sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * total > n).tobytes(), "big")


def with_fingerprint(docs: DataFrame, text_col: str, out: str, shingle_words: int) -> DataFrame:
    """``docs`` with a long column ``out``: the fingerprint's 64 bits."""
    arrow_batches(docs.sparkSession)
    position = docs.columns.index(text_col)

    def run(batches):
        for batch in batches:
            prints = np.array([fingerprint(t.as_py(), shingle_words) for t in batch.column(position)], np.uint64).view(np.int64)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(prints)], names=[*batch.schema.names, out])

    fields = ", ".join(f"`{f.name.replace('`', '``')}` {f.dataType.simpleString()}" for f in docs.schema.fields)
    return docs.mapInArrow(run, f"{fields}, `{out}` bigint")


# ---------------------------------------------------------- bit statistics


def bit_counts(prints: DataFrame) -> np.ndarray:
    """64 x 64 matrix: fingerprints that have both bits set (the diagonal: the bit). 2,080 numbers reach the driver."""

    def run(batches):
        total = np.zeros((BITS, BITS), np.int64)
        for batch in batches:
            raw = batch.column(0).to_numpy(zero_copy_only=False).astype(">i8").view(np.uint8).reshape(-1, 8)
            bits = np.unpackbits(raw, axis=1)[:, ::-1].astype(np.float32)
            total += (bits.T @ bits).astype(np.int64)
        i, j = np.triu_indices(BITS)
        yield pa.RecordBatch.from_arrays([pa.array(i.astype(np.int32)), pa.array(j.astype(np.int32)), pa.array(total[i, j])], names=["i", "j", "n"])

    out = np.zeros((BITS, BITS))
    for i, j, n in prints.select("fp").mapInArrow(run, "i int, j int, n bigint").groupBy("i", "j").agg(F.sum("n")).collect():
        out[i, j] = out[j, i] = n
    return out


def correlated_groups(counts: np.ndarray, n: int, groups: int) -> list[list[int]]:
    """Split the bits into ``groups`` of near equal size, each grown around its most correlated bits."""
    p = np.diag(counts) / max(n, 1)
    sd = np.sqrt(np.maximum(p * (1 - p), 1e-12))
    corr = np.abs((counts / max(n, 1) - np.outer(p, p)) / np.outer(sd, sd))
    np.fill_diagonal(corr, 0)
    left, out = set(range(BITS)), []
    for g in range(groups):
        size = (BITS - sum(map(len, out))) // (groups - g)
        rest = sorted(left)
        group = [max(rest, key=lambda b: (corr[b, rest].sum(), -b))]
        while len(group) < size:
            rest = [b for b in sorted(left) if b not in group]
            group.append(max(rest, key=lambda b: (corr[b, group].mean(), -b)))
        left -= set(group)
        out.append(sorted(group))
    return out


def signed(value: int) -> int:
    return value - (1 << BITS) if value >= 1 << (BITS - 1) else value


def mask_of(bits: list[int]) -> int:
    return signed(sum(1 << b for b in bits))


def within(p: np.ndarray, group: list[int], t: int) -> float:
    """Chance that two random fingerprints differ in at most ``t`` bits of ``group``, bits taken as independent."""
    dist = np.zeros(t + 2)
    dist[0] = 1.0
    for b in group:
        q = 2 * p[b] * (1 - p[b])
        dist[1:] = dist[1:] * (1 - q) + dist[:-1] * q
        dist[0] *= 1 - q
    return float(dist[: t + 1].sum())


def allocate(cost: list[list[float]], total: int) -> tuple[float, list[int]]:
    """Thresholds (-1 ... len-2 per group) of least cost that sum to ``total``; ``cost[g][t + 1]``."""
    best: dict[int, tuple[float, list[int]]] = {0: (0.0, [])}
    for row in cost:
        new: dict[int, tuple[float, list[int]]] = {}
        for s, (c, ts) in best.items():
            for t, extra in enumerate(row, start=-1):
                if s + t not in new or c + extra < new[s + t][0]:
                    new[s + t] = (c + extra, [*ts, t])
        best = new
    return best[total]


def probe_plan(prints: DataFrame, n: int, max_distance: int) -> list[tuple[list[int], int]]:
    """(group of bits, threshold) pairs to probe; a group at -1 is left out.

    Each split into 1 ... max_distance + 1 groups gets its best thresholds and
    the cheapest split wins. A group's estimated candidates at threshold 0 are
    the exact count of pairs that agree on it; at a higher threshold that count
    grows as for independent bits. Probe rows are part of the cost.
    """
    counts = bit_counts(prints)
    p = np.diag(counts) / max(n, 1)
    splits = [correlated_groups(counts, n, m) for m in range(1, max_distance + 2)]
    flat = [g for split in splits for g in split]
    keys = F.array(*[F.struct(F.lit(i).alias("g"), F.col("fp").bitwiseAND(F.lit(mask_of(g))).alias("k")) for i, g in enumerate(flat)])
    sizes = prints.select(F.explode(keys).alias("x")).groupBy("x.g", "x.k").agg(F.count("*").alias("c"))
    agree = {g: float(c) for g, c in sizes.groupBy("g").agg(F.sum(F.col("c") * (F.col("c") - 1) / 2)).collect()}
    best, at = None, 0
    for split in splits:
        cost = []
        for k, group in enumerate(split):
            chance = max(within(p, group, 0), 1e-30)
            row = [0.0]
            for t in range(max_distance + 1):
                rows = n * (1 + len(group) * (t >= 1))
                row.append(agree.get(at + k, 0.0) * within(p, group, t) / chance + rows)
            cost.append(row)
        at += len(split)
        total, ts = allocate(cost, max_distance - len(split) + 1)
        if best is None or total < best[0]:
            best = (total, [(g, t) for g, t in zip(split, ts) if t >= 0])
    return best[1]


# ------------------------------------------------------- probe and verify


def ball(value: Column, bits: list[int]) -> Column:
    """``value`` and every value that differs from it in one of ``bits``."""
    return F.array(value, *[value.bitwiseXOR(F.lit(signed(1 << b))) for b in bits])


def probe_keys(plan: list[tuple[list[int], int]]) -> Column:
    """A fingerprint's buckets. Two values at most 2 apart share a radius-1 ball's centre, so thresholds 1 and 2 need one flipped bit."""
    parts = []
    for i, (group, t) in enumerate(plan):
        value = F.col("fp").bitwiseAND(F.lit(mask_of(group)))
        keys = ball(value, group) if t else F.array(value)
        group_no = F.lit(i)  # a second lambda argument would be the element's index
        parts.append(F.transform(keys, lambda k: F.struct(group_no.alias("g"), k.alias("k"))))
    return F.concat(*parts)


def verified_pairs(members: Column, max_distance: int) -> Column:
    """Links within one small bucket: every pair of its fingerprints at most ``max_distance`` bits apart."""

    def partners(x, i):
        later = F.slice(members, i + 2, F.size(members))
        near = F.filter(later, lambda y: F.bit_count(x.bitwiseXOR(y)) <= max_distance)
        return F.transform(near, lambda y: F.struct(F.least(x, y).alias("a"), F.greatest(x, y).alias("b")))

    return F.flatten(F.transform(members, partners))


def near_links(prints: DataFrame, max_distance: int) -> DataFrame:
    """Links (a, b) between distinct fingerprints whose closure joins exactly those within ``max_distance`` bits of one another."""
    spark = prints.sparkSession
    none = spark.createDataFrame([], "a bigint, b bigint")
    n = prints.count()
    if max_distance == 0 or n < 2:
        return none
    plan = probe_plan(prints, n, max_distance)
    rows = prints.select("fp", F.explode(probe_keys(plan)).alias("x")).select("fp", "x.g", "x.k")
    sizes = Stored(rows.groupBy("g", "k").agg(F.count("*").alias("n")).filter("n > 1"), "simhash-buckets")
    held = Stored(rows.join(sizes.df, ["g", "k"]), "simhash-members")
    small = held.df.filter(F.col("n") <= PAIRWISE_BUCKET).groupBy("g", "k").agg(F.collect_list("fp").alias("fps"))
    pairs = small.select(F.explode(verified_pairs(F.col("fps"), max_distance)).alias("l")).select("l.a", "l.b")
    # Large buckets: the balls of radius 1 around two fingerprints meet if and
    # only if they are at most 2 bits apart, and a ball holds at most 65 of
    # them, so its members are linked to its smallest one in linear space.
    crowded = held.df.filter(F.col("n") > PAIRWISE_BUCKET).select("fp").distinct()
    centres = crowded.select("fp", F.explode(ball(F.col("fp"), list(range(BITS)))).alias("z"))
    if max_distance == 1:
        met = centres.groupBy("z").agg(F.collect_list("fp").alias("fps")).filter(F.array_contains("fps", F.col("z")))
        stars = met.select(F.col("z").alias("hub"), F.explode("fps").alias("fp"))
    else:
        met = centres.groupBy("z").agg(F.collect_list("fp").alias("fps")).filter(F.size("fps") > 1)
        stars = met.select(F.array_min("fps").alias("hub"), F.explode("fps").alias("fp"))
    stars = stars.filter("fp <> hub").select(F.least("hub", "fp").alias("a"), F.greatest("hub", "fp").alias("b"))
    links = Stored(pairs.unionByName(stars).distinct(), "simhash-links")
    sizes.release()
    held.release()
    return links.df


def components(links: DataFrame) -> DataFrame:
    """(v, root) for every vertex of ``links``: the smallest vertex of its component.

    Rounds of taking the smallest root among the neighbours, then jumping to
    the root's own root; each round is a stored table, and only the number of
    changed rows reaches the driver.
    """
    both = Stored(links.select("a", "b").unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b"))), "links")
    # Start at the smallest neighbour: the first round without a join.
    roots = Stored(both.df.groupBy(F.col("a").alias("v")).agg(F.min("b").alias("m")).select("v", F.least("v", "m").alias("root")), "roots")
    while True:
        of_b = roots.df.select(F.col("v").alias("b"), F.col("root").alias("r"))
        near = both.df.join(of_b, "b").groupBy(F.col("a").alias("v")).agg(F.min("r").alias("m"))
        hooked = Stored(roots.df.join(near, "v").select("v", F.col("root").alias("was"), F.least("root", "m").alias("root")), "hooked")
        jump = hooked.df.select(F.col("v").alias("root"), F.col("root").alias("next"))
        step = hooked.df.join(jump, "root").select("v", F.least("root", "next").alias("root"), (F.least("root", "next") < F.col("was")).alias("moved"))
        new = Stored(step, "roots")
        roots.release()
        hooked.release()
        roots = new
        if not roots.df.filter("moved").limit(1).count():
            both.release()
            return roots.df.select("v", "root")


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle_words: int = 3, max_distance: int = 2) -> DataFrame:
    """One row per row of ``docs``: its id (``doc_id``), ``fp`` (long), ``root`` (long) and ``component_id``.

    ``component_id`` is the smallest id reachable over links of at most
    ``max_distance`` (0, 1 or 2) differing bits, ``root`` the component's
    smallest fingerprint. Equal fingerprints are one vertex, so groups of
    copies cost one row. Empty and null texts have fingerprint 0. A null id
    stays null and never is the smallest; a component of null ids only has a
    null component_id. Repeated rows stay repeated; no rows give no rows.
    """
    if max_distance not in (0, 1, 2):
        raise ValueError("max_distance must be 0, 1 or 2")
    slim = docs.select(column(id_col).alias("doc_id"), column(text_col).alias("text"))
    prints = Stored(with_fingerprint(slim, "text", "fp", shingle_words).select("doc_id", "fp"), "fingerprints").df
    classes = Stored(prints.groupBy("fp").agg(F.min("doc_id").alias("first_id")), "fingerprint-classes").df
    links = near_links(classes, max_distance)
    rooted = classes.join(components(links).withColumnRenamed("v", "fp"), "fp", "left")
    rooted = Stored(rooted.withColumn("root", F.coalesce("root", "fp")), "fingerprint-roots").df
    smallest = Stored(rooted.groupBy("root").agg(F.min("first_id").alias("component_id")), "component-ids").df
    ids = Stored(rooted.join(smallest, "root").select("fp", "root", "component_id"), "class-components").df
    return prints.join(ids, "fp").select("doc_id", "fp", "root", "component_id")


def keep_one(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle_words: int = 3, max_distance: int = 2) -> DataFrame:
    """``docs`` with one row of each near-duplicate component, columns unchanged.

    The row with the smallest id stays (a null id only where the component has
    no other); among the component's rows that share that id, the one with the
    smallest text. An id whose rows all have one fingerprint lies in one
    component and is fetched by itself; rows of other ids and of null ids are
    told apart by their fingerprints.
    """
    found = near_duplicates(docs, id_col, text_col, shingle_words, max_distance)
    order = F.struct(F.col("doc_id").isNull(), F.col("doc_id"))
    first = Stored(found.groupBy("root").agg(F.min(order).alias("first")).select("root", F.col("first.doc_id").alias("first_id")), "survivors").df
    per_id = found.filter("doc_id IS NOT NULL").groupBy("doc_id").agg((F.min("fp") != F.max("fp")).alias("mixed"))
    mixed = Stored(per_id.filter("mixed").select(F.col("doc_id").alias("mixed_id")), "mixed-ids").df
    keep, rank, fp, keep_fp, root = (fresh_name(docs, n) for n in ("keep_id", "keep_rank", "own_fp", "keep_fp", "keep_root"))

    def smallest_text(rows: DataFrame, key: str) -> DataFrame:
        w = Window.partitionBy(column(key)).orderBy(column(text_col))
        return rows.withColumn(rank, F.row_number().over(w)).filter(column(rank) == 1).select(*[column(c) for c in docs.columns])

    def unsure(rows: DataFrame, name: str) -> DataFrame:
        repeated = mixed.withColumnRenamed("mixed_id", keep)
        return rows.join(repeated, column(name) == column(keep), "left_semi").unionByName(rows.filter(column(name).isNull()))

    ids = first.join(mixed, F.col("first_id") == F.col("mixed_id"), "left_anti").select(F.col("first_id").alias(keep))
    by_id = docs.join(ids, column(id_col) == column(keep), "left_semi")
    spots = unsure(found, "doc_id").select("doc_id", "fp", "root").distinct().join(first, "root").filter(F.col("doc_id").eqNullSafe(F.col("first_id")))
    spots = Stored(spots.select(F.col("doc_id").alias(keep), F.col("fp").alias(keep_fp), F.col("root").alias(root)), "survivor-prints").df
    printed = with_fingerprint(unsure(docs, id_col), text_col, fp, shingle_words)
    by_print = printed.join(spots, (column(fp) == column(keep_fp)) & column(id_col).eqNullSafe(column(keep)))
    return smallest_text(by_id, id_col).unionByName(smallest_text(by_print, root))
