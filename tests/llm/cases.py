"""Small tables with the awkward rows every operator must handle, and plain references."""

from __future__ import annotations

import re
import zlib

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
WORD = re.compile(r"[^\x20\x09-\x0D]+")


def words(text) -> list[str]:
    return WORD.findall(text or "")


def lower_ascii(text) -> str:
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")


def prose(seed: int, n: int) -> str:
    """``n`` invented words, the same for a seed."""
    out, x = [], seed * 2654435761 % 2**32 + 1
    for i in range(n):
        x = zlib.crc32(x.to_bytes(4, "little") + i.to_bytes(4, "little"))
        out.append("the of and to in".split()[x % 5] if x % 3 == 0 else "w" + format(x, "x")[: 3 + x % 4])
    return " ".join(out)


def rows() -> list[tuple]:
    """Nulls in every column, empty and very long texts, copies, near copies, ties and repeated rows."""
    base = [prose(i, 30 + 17 * i % 200) for i in range(12)]
    out = [(i, t, "en", f"src{i % 3}", len(t)) for i, t in enumerate(base)]
    out += [
        (20, None, "en", "src0", 0), (21, "", "en", "src1", 0), (22, "  \n\t ", None, None, 5),
        (23, base[1], "en", None, None), (24, base[1].upper(), "de", "src2", 9), (25, base[1], "en", "src0", 1),
        (26, base[2].replace(" w", " z", 1), "en", "src1", 1), (27, "É é ß Ω " * 20, "fr", "src0", 1),
        (28, prose(77, 30_000), "en", "src0", 1), (29, "x" * 50_000, "en", "src1", 1),
        (30, "same line here\n" * 12, "es", "src2", 1), (31, "a\r\nb\x0bc\x0cd\xa0e f\x1cg\x85h", "en", "src2", 1),
        (32, "one two", "en", "src1", 7), (33, "\U0001F600 smile \U0001F600", "en", "\U0001F600", 3),
        (None, "text without an id", "en", "src0", 18), (None, base[3], "en", "src0", 1),
        (5, base[5], "en", "src2", len(base[5])), (5, base[5], "en", "src2", len(base[5])),  # a row given three times
    ]
    return out


def documents(spark, extra: bool = False, data=None):
    """The rows as a table; ``extra`` adds columns whose names operators use themselves."""
    df = spark.createDataFrame(rows() if data is None else data, SCHEMA).repartition(3)
    if extra:
        from pyspark.sql import functions as F
        for name in ("id", "fp", "size", "target", "taken", "kept", "keep_id", "group_size", "score", "start", "length",
                     "n_words", "n_tokens", "line_no", "h1", "key", "part", "row", "hash", "value", "component"):
            df = df.withColumn(name, F.lit("clash"))
    return df


def empty(spark):
    return spark.createDataFrame([], SCHEMA)


class Groups:
    """Union-find over hashable nodes."""

    def __init__(self):
        self.up: dict = {}

    def find(self, x):
        self.up.setdefault(x, x)
        while self.up[x] != x:
            self.up[x] = self.up[self.up[x]]
            x = self.up[x]
        return x

    def join(self, a, b):
        self.up[self.find(a)] = self.find(b)
