"""Small tables with everything that tends to go wrong in them."""

import random

from pyspark.sql import DataFrame, SparkSession

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
#: Columns that no operator asks for and whose names some of them use inside.
CLASHES = ("size", "offset", "class", "group", "shard", "slot", "key", "_h", "text_hash", "removed", "n", "words", "line")


def prose(seed: int, words: int, lines: int = 1) -> str:
    rng = random.Random(seed)
    text = [" ".join("".join(rng.choice("abcdefgh") for _ in range(rng.randint(2, 7))) for _ in range(words // lines)) for _ in range(lines)]
    return "\n".join(text)


def edited(text: str, seed: int, changes: int) -> str:
    rng = random.Random(seed)
    w = text.split(" ")
    for _ in range(changes):
        w[rng.randrange(len(w))] = f"x{rng.randrange(1000)}"
    return " ".join(w)


def rows() -> list[tuple]:
    base, other, passage = prose(1, 120, 4), prose(2, 90, 3), prose(3, 60)
    texts = [
        base, base, edited(base, 5, 2), edited(base, 6, 40), other, other + " " + passage, passage + "\n" + prose(4, 50),
        prose(7, 30) + " " + passage + " " + prose(8, 40), None, "", " \t\n ", "word", "one two three four",
        "The The " * 200, prose(9, 3000, 30), "é" * 300, prose(10, 80) + " x\x0by\x0cz", base + "\n" + base, "a\n\nb\n\na\n\nb",
        "Released under the MIT License.\n" + prose(11, 20), None, "",
    ]
    made = [(i, t, "en", f"src{i % 4}" if i % 5 else None, len(t) if t else None) for i, t in enumerate(texts)]
    made += [made[0], made[0], made[4], made[8]]  # rows alike in every column
    made += [(None, other, None, None, None), (None, None, None, "src1", None), (3, "same id, other text", "en", "src1", 1)]
    return made


def odd_docs(spark: SparkSession) -> DataFrame:
    df = spark.createDataFrame(rows(), SCHEMA)
    for name in CLASHES:
        df = df.selectExpr("*", f"'clash' AS `{name}`")
    return df.repartition(3)


def empty_docs(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([], SCHEMA)
