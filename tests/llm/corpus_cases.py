"""Small document tables for the corpus operators' tests."""

from __future__ import annotations

import random
import re

DOC = ("doc_id long, text string, lang string, source string, n_chars long, shard int, n int, "
       "ids string, score double, block int, cls int, print string, first string, rank int, "
       "length int, base string, b string, r string")
EXTRA = ("en", "src0", 1, 7, 7, "x", 0.5, 7, 7, "p", "f", 3, 9, "base", "b", "r")
LOWER = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})
WORD = re.compile("[^\x20\x09-\x0d]+")


def docs(spark, rows):
    """A documents table, with further columns whose names operators use inside."""
    return spark.createDataFrame([(i, t, *EXTRA) for i, t in rows], DOC)


def odd_rows():
    """Nulls, empty and white texts, a very long one, ties and repeated rows."""
    return [(1, None), (2, ""), (3, " \n\t "), (4, "one"), (5, "One"), (6, "a b c d e f g"),
            (7, "A b C d e f g"), (7, "A b C d e f g"), (8, "long " * 30000),
            (9, "é ñ ü 日本 🎉 x"), (None, "a b c d e f g"), (10, "it's we'll\n\n  end ")]


def prose(seed: int, words: int, vocabulary: int = 400) -> str:
    r = random.Random(seed)
    return " ".join(f"w{r.randrange(vocabulary)}" for _ in range(words))


def changed(text: str, seed: int, n: int) -> str:
    r, w = random.Random(seed), text.split(" ")
    for _ in range(n):
        w[r.randrange(len(w))] = f"z{r.randrange(10 ** 6)}"
    return " ".join(w)


def colliding(n: int) -> tuple[str, str]:
    """Two words of n letters that polynomial hashes modulo 2 ** 64 can't tell apart
    (n a multiple of 1024): a Thue-Morse word and its complement."""
    one = "".join("ab"[bin(k).count("1") & 1] for k in range(n))
    return one, one.translate(str.maketrans("ab", "ba"))
