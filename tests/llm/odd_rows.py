"""Small tables with what real ones hold: nulls, empty and blank texts, ties,
repeated rows, long texts, and extra columns whose names the operators use."""

import random
import re

from pyspark.sql import functions as F

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
EXTRA = ["id", "at", "row", "key", "size", "hash", "shard", "slot", "n", "n_words", "kept", "score",
         "label", "label_", "_kept", "_rec", "_row", "copies", "target", "group_size", "keep_id",
         "sid", "start", "length", "task", "ids", "doc", "n_tokens", "bucket", "_id", "_text_sent"]
WORD = re.compile(r"[^\x20\x09-\x0D]+")


def texts(seed: int = 1) -> list:
    rnd = random.Random(seed)
    vocab = ["".join(rnd.choice("abcdeéñ") for _ in range(rnd.randint(1, 8))) for _ in range(300)]

    def prose(n):
        out = []
        for k in range(n):
            out.append(rnd.choice(vocab) + (".\n" if rnd.random() < 0.08 else ""))
        return " ".join(out)
    base = [prose(rnd.randint(40, 200)) for _ in range(24)]
    out = list(base)
    out += [base[0]] * 4 + [base[1].replace(" ", "  ")] + [base[2].upper()]
    for b in base[3:9]:                                    # near copies
        w = b.split(" ")
        w[rnd.randrange(len(w))] = "zzz"
        out.append(" ".join(w))
    out += [base[10] + " " + base[11], base[12] + "\n" + base[3]]
    out += [None, None, "", "", " ", "\n\t \x0b", "a", "a b", "A  b", "one two three four",
            "one two three four five", "### $$$ " * 60, "SHOUT!! " * 80, "x" * 700,
            "word " * 5000, " ".join(prose(300) for _ in range(12)), "\u3000\u00a0 wide \u0001",
            "<|endoftext|> it's <|startoftext|> we'll\r\n"]
    return out


def documents(spark, seed: int = 1, extra: bool = True):
    rows = [(i * 3, t, "en", f"s{i % 3}" if i % 5 else None, None if t is None else len(t))
            for i, t in enumerate(texts(seed))]
    rows += [rows[0], rows[0], rows[30]]                   # repeated rows
    rows += [(None, rows[1][1], None, "s0", None), (None, "only here " * 30, None, None, 1)]
    df = spark.createDataFrame(rows, SCHEMA).repartition(4)
    return df.withColumns({c: F.lit(c) for c in EXTRA}) if extra else df


def nothing(spark):
    return spark.createDataFrame([], SCHEMA)


def labels(spark):
    rows = [(i * 3, 0 if t and ("#" in t or "!!" in t) else 1, 0)
            for i, t in enumerate(texts())] + [(None, 0, 0), (0, None, None), (0, 1, 0)]
    return spark.createDataFrame(rows, "doc_id long, quality int, toxic int")


def write(spark, folder: str, seed: int = 1, docs=None) -> str:
    (documents(spark, seed, False) if docs is None else docs).write.parquet(
        f"{folder}/documents.parquet")
    labels(spark).write.parquet(f"{folder}/labels.parquet")
    return folder
