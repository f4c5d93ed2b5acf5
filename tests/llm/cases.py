"""Small tables with what tables may hold: nulls, empty and long texts, ties, repeated rows, columns with common names."""

import random
import re

WORD = re.compile(r"[^\x20\x09-\x0D]+")
SCHEMA = ("doc_id long, text string, lang string, source string, n_chars long, row long, size long, h string, key string, part int, "
          "node long, tie long, kept boolean, start int, quality double, value string")


def sentence(draw: random.Random, n: int) -> str:
    return " ".join("".join(draw.choice("abcdefgéß") for _ in range(draw.randrange(1, 9))) + draw.choice(["", "", ".", ","]) for _ in range(n))


def documents(spark, seed: int = 1, n: int = 40):
    draw = random.Random(seed)
    texts = [sentence(draw, draw.choice([1, 3, 5, 30, 120, 300])) for _ in range(n)]
    shared = sentence(draw, 120)
    texts[3] = texts[4] + "\n" + shared
    texts[5] = shared + " " + texts[6]
    texts[7] = texts[8] = sentence(draw, 200)
    words = sentence(draw, 300).split()
    base = list(words)
    for k in (9, 10, 11, 12):
        changed = list(base)
        for _ in range(k - 7):
            changed[draw.randrange(300)] = f"x{draw.randrange(999)}"
        texts[k] = " ".join(changed)
    texts[13], texts[14], texts[15], texts[16] = None, "", " \t\n", "abc " * 900
    texts[17] = "A line\nA line\n\n \nA LINE\n" + "\x0b\x0c mixed blank   \x1c end 𝒳 é"
    texts[18] = sentence(draw, 6000)
    rows = [(k, t) for k, t in enumerate(texts)] + [(9, texts[9]), (None, texts[20]), (None, None), (21, "another text of the same id")]
    rows = [(i, t, "en", draw.choice(["a", "b", "c", "d", "é", None]), None if t is None else len(t), 1, 2, "h", "k", 3, 4, 5, True, 6, 0.5, "v") for i, t in rows]
    return spark.createDataFrame(rows, SCHEMA).repartition(4)


def pairs(df):
    return sorted(((r["doc_id"], r["text"] or "") for r in df.collect()), key=lambda r: (r[0] is None, r[0] or 0, r[1]))


def write(spark, df, folder, name):
    df.write.parquet(f"{folder}/{name}.parquet")
    return str(folder)
