"""Small inputs that every operator has to take: nulls, empty and very long
texts, ties, repeated rows, empty tables, columns with clashing names."""

from __future__ import annotations

import random

DOCS = "doc_id long, text string, lang string, source string, n_chars long"
#: Names that operators use inside.
CLASHES = ["fp", "key", "keys", "block", "c0", "c1", "word", "c", "_copies", "_copy", "_place", "id", "of_id", "gone_id",
           "dup_id", "shard", "chunk", "label", "score", "component_id", "gray", "task", "run", "count", "size", "mean"]
WORDS = {"en": ["the", "and", "thing", "other", "house", "with", "water", "story", "reading", "thought"],
         "fr": ["le", "était", "maison", "avec", "histoire", "lecture", "pensée", "oiseau", "être", "eau"]}


def prose(rng: random.Random, lang: str, n: int) -> str:
    out, line = [], []
    for _ in range(n):
        line.append(rng.choice(WORDS[lang]) + rng.choice(["", "", "", ",", ".", "s"]))
        if rng.random() < 0.15:
            out.append(" ".join(line))
            line = []
    return "\n".join([*out, " ".join(line)])


def rows(n: int = 60, seed: int = 1) -> list[tuple]:
    rng = random.Random(seed)
    out = []
    for i in range(n):
        lang = rng.choice(["en", "fr"])
        text = prose(rng, lang, rng.randint(1, 120))
        if i % 7 == 3 and i > 7:
            text = out[i - 5][1]  # an exact copy
        if i % 11 == 4:
            text = "The same opening line of many.\n" + (text or "") + "\n\tTHE SAME opening line of many.  "
        out.append((i, text, lang, f"s{i % 4 if i % 3 else 0}", len(text or "")))
    out += [(900, None, "en", None, None), (901, "", "fr", "s1", 0), (902, " \t\n\x0b ", None, "s1", 5), (903, "a", "en", "s2", 1),
            (904, "word " * 30_000, "en", "s0", 150_000), (905, "é漢🙂\x1c\x85 x\r\ny", "fr", "s3", 9), (906, "12 34 !!", "en", "s9", 8),
            (None, "the story of the house\nThe same opening line of many.", "en", "s1", 40)]
    return out + [out[0], out[5]]  # repeated rows


def docs(spark, data=None):
    return spark.createDataFrame(rows() if data is None else data, DOCS)


def clashing(df):
    """``df`` with extra columns named like the operators' own."""
    from pyspark.sql import functions as F

    return df.withColumns({c: F.lit(f"own {c}") for c in CLASHES})
