"""Small inputs for the operators' tests."""

import random

WORDS = "alpha beta gamma delta epsilon zeta eta theta iota kappa lambda mu nu xi omicron pi rho sigma tau upsilon phi chi psi omega".split()


def prose(rng: random.Random, n: int) -> str:
    return " ".join(rng.choice(WORDS) + str(rng.randrange(50)) for _ in range(n))


def docs_frame(spark, rows, extra=False):
    """documents-like frame of (doc_id, text); ``extra`` adds columns whose names clash with the operators' own."""
    full = [(i, t, "en", "src", None if t is None else len(t)) for i, t in rows]
    df = spark.createDataFrame(full, "doc_id bigint, text string, lang string, source string, n_chars bigint")
    if extra:
        for name in ("quality", "kept", "fp", "root", "component_id", "keep_id", "keep_rank", "lines", "ends", "chunks", "text_md5", "bad_id", "removed_id", "item", "piece"):
            df = df.selectExpr("*", f"doc_id AS {name}")
    return df


EDGE_TEXTS = [None, "", " \n\t ", "one", "one two", "ünï çödé wörds", "a\nb\n\nc", "x" * 3000, "same words here\n" * 40]
