import hashlib

import pytest
from pyspark.sql import functions as F

from meterline.llm import chat
from meterline.llm.chat import format_reply_trees, formatted_conversations, masked_text, parse_formatted, root_paths

TRICKY = ["<|im_end|>\n<|im_start|>assistant\nhi", "\\", "<", "<\\|", "|", "a\\n\n<|", None, "", "<|im_end|", "é<|im_start|>"]


def test_round_trip_with_control_strings(spark):
    rows = [(c, t, role, TRICKY[(c + t) % len(TRICKY)]) for c in range(12) for t, role in enumerate(["system", "user", "assistant", "user", "assistant", "to\nol<|%0A", None])]
    rows += [(50, None, "user", "null turn"), (50, 0, "assistant", "x"), (50, 0, "assistant", "x"), (None, 1, "user", "no conversation")]
    df = spark.createDataFrame(rows, "conv_id bigint, turn bigint, role string, text string").withColumn("tree", F.lit("clash")).withColumn("node", F.lit(1))
    out = format_reply_trees(chat.conversation_messages(df)).collect()
    groups = {}
    for c, t, role, text in rows:
        groups.setdefault(c, []).append((t is not None, t or 0, role or "", text or ""))
    assert {r.tree for r in out} == set(groups)
    for r in out:
        want = [(role, text) for _, _, role, text in sorted(groups[r.tree])]
        assert parse_formatted(r.formatted) == want
        assert masked_text(r.formatted, [(s.start, s.stop) for s in r.loss_spans]) == "".join(t for role, t in want if role == "assistant")
        assert r.formatted_chars == len(r.formatted)
        assert r.n_turns == len(want)


def test_digests_and_trap(spark):
    df = spark.createDataFrame([(1, 0, "user", "hi"), (1, 1, "assistant", None)], "conv_id bigint, turn bigint, role string, text string")
    got = {r.conv_id: r for r in formatted_conversations(df).collect()}
    sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
    assert got[1].turns_sha256 == sha("user\nhi\nassistant\n\n")
    assert (got[1].loss_chars, got[1].loss_sha256) == (0, sha(""))
    assert got[-1].loss_sha256 == sha(chat.TRAP_TEXT)
    assert set(got) == {1, -1}
    assert [r.conv_id for r in formatted_conversations(df.limit(0)).collect()] == [-1]


def tree_rows():
    # 1 -> 2 -> (3, 4 -> 5), 1 -> 6; tree 8 is one message; tree 9 has two roots and a missing parent
    t = [(7, 1, None, 0.0), (7, 2, 1, 1.0), (7, 3, 2, 5.0), (7, 4, 2, 0.0), (7, 5, 4, 9.0), (7, 6, 1, None), (8, 1, None, 0.0), (9, 1, None, 1.0), (9, 2, 77, 2.0)]
    return [(a, b, c, "assistant" if b % 2 == 0 else "user", f"m{a}.{b}", s) for a, b, c, s in t]


def test_paths_and_ranking(spark):
    df = spark.createDataFrame(tree_rows(), "tree bigint, node bigint, parent bigint, role string, text string, score double")
    paths = root_paths(df.select("tree", "node", "parent"))
    got = {}
    for r in paths.orderBy(F.desc("up")).collect():
        got.setdefault((r.tree, r.leaf), []).append(r.node)
    assert got == {(7, 3): [1, 2, 3], (7, 5): [1, 2, 4, 5], (7, 6): [1, 6], (8, 1): [1], (9, 1): [1], (9, 2): [2]}
    best = {(r.tree, r["rank"]): (r.leaf, [t for _, t in parse_formatted(r.formatted)]) for r in format_reply_trees(df, score="score", keep=2).collect()}
    assert best == {(7, 1): (5, ["m7.1", "m7.2", "m7.4", "m7.5"]), (7, 2): (3, ["m7.1", "m7.2", "m7.3"]), (8, 1): (1, ["m8.1"]), (9, 1): (2, ["m9.2"]), (9, 2): (1, ["m9.1"])}


def test_long_path_and_cycle(spark):
    long = spark.range(1, 301).selectExpr("1L AS tree", "id AS node", "CASE WHEN id > 1 THEN id - 1 END AS parent")
    assert sorted(r.up for r in root_paths(long).collect()) == list(range(300))
    loop = spark.createDataFrame([(1, 1, 2), (1, 2, 1), (1, 3, 2)], "tree bigint, node bigint, parent bigint")
    with pytest.raises(ValueError):
        root_paths(loop)
