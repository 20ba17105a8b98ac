"""The Merkle manifest on hard rows against a plain version; requests for a few leaves."""

from __future__ import annotations

import zlib
from collections import Counter

from pyspark.sql import functions as F

from keelson.llm import merkle
from tests.llm import brute

SCHEMA = "doc_id long, source string, lang string, n_chars int, text string, rank int, tree string"
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def rows():
    """NULLs in each column, empty and long texts, lone groups, repeated rows and ids, and
    group sizes around powers of eight."""
    out = [(1, "s", None, 3, "Abc"), (2, None, "", None, ""), (3, "s", "aa", 0, None),
           (None, None, None, None, None), (None, "x", "en", 1, "É"), (7, "s", "en", 1, "A"),
           (7, "s", "en", 1, "B"), (-5, "s", "en", 1, "Ünicode \U0001F600 TEXT"),
           (2 ** 62, "s", "zz", 9, "LONG " * 200_000), (-2 ** 63, "s", "zz", 9, "x")]
    out += [(40, "s", "zz", 1, "Same")] * 150
    for lang, n in (("l7", 7), ("l8", 8), ("l9", 9), ("l64", 64), ("l65", 65), ("en", 600)):
        out += [(1000 + k, "s", lang, k, f"Text {k}") for k in range(n)]
    return out + [(5, "s", f"g{k}", 1, "One") for k in range(20)]


def tampered(r):
    if r[0] is None or r[4] is None or zlib.crc32(str(r[0]).encode()) % 3:
        return r
    return (*r[:4], r[4].translate(LOWER))


def proofs(df, requests=None):
    hit = F.crc32(F.col("doc_id").cast("string")) % 3 == 0
    lower = F.translate("text", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    manifest = merkle.build_manifest(df, claims={"text": F.when(hit, lower).otherwise(F.col("text"))})
    found = merkle.prove(manifest, requests(manifest) if requests else None)
    folded = merkle.fold(F.col("claimed"), F.col("path"))
    hexed = lambda c: F.lower(F.hex(c))
    return [tuple(r) for r in found.select(
        "id", hexed("leaf"), hexed("subroot"), hexed("root"),
        F.sha2(merkle.siblings(F.col("path")), 256), folded, folded == hexed("root")).collect()]


def test_manifest_on_hard_rows(spark):
    given = rows()
    df = spark.createDataFrame([(*r, 1, "t") for r in given], SCHEMA).repartition(7)
    want = brute.merkle(given, tampered)
    assert Counter(proofs(df)) == Counter(want)
    assert {w[-1] for w in want} == {True, False}


def test_requests_for_some_leaves(spark):
    given = rows()
    df = spark.createDataFrame([(*r, 1, "t") for r in given], SCHEMA)
    some = lambda m: m.leaves.filter("id % 50 = 3 OR id = 1").select("tree", "rank")
    want = [w for w in brute.merkle(given, tampered)
            if w[0] is not None and (w[0] % 50 == 3 and w[0] > 0 or w[0] == 1)]
    assert Counter(proofs(df, some)) == Counter(want)


def test_empty_and_single(spark):
    df = spark.createDataFrame([(*r, 1, "t") for r in rows()[:1]], SCHEMA)
    assert proofs(df.limit(0)) == []
    assert proofs(df) == brute.merkle(rows()[:1], tampered)
