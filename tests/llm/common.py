"""Small tables for the tests of the operators."""

import zlib

SF = "/root/testdata/sf0.001"
WORDS = ("amber birch cedar delta ember flint grove heron inlet jasper kelp lunar maple north ocean "
         "pearl quartz river stone tulip umber violet willow xenon yarrow zephyr").split()


def prose(seed: int, n: int) -> str:
    """`n` words that differ from seed to seed."""
    out, x = [], seed * 2654435761 % 2 ** 32
    for _ in range(n):
        x = (x * 1103515245 + 12345) % 2 ** 31
        out.append(WORDS[x // 65536 % len(WORDS)] + str(x // 97 % 50))
    return " ".join(out)


def documents(spark, rows, clash="key long, pos string, bucket int"):
    """`rows` of (doc_id, text) with columns whose names an operator might use itself."""
    return spark.createDataFrame([(i, t, 7, "p", 1) for i, t in rows], f"doc_id long, text string, {clash}")


def crc(text: str) -> int:
    return zlib.crc32(text.encode())
