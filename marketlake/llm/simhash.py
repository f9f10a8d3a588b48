"""SimHash near-duplicates with covering locality-sensitive hashing.

A document's 64-bit fingerprint is the bitwise majority of its shingles' XXH64 values. Two fingerprints are linked if
they differ in at most ``radius`` bits; documents connected by links form a component.

Candidates come from a covering family of bit masks: every bit gets a non-zero vector of GF(2)^(radius+1), and each
non-zero vector v of that space gives one table whose mask holds the bits whose vectors are not orthogonal to v. The
vectors of any ``radius`` differing bits leave some v orthogonal to all of them, so that table's key is equal for both
fingerprints: no pair within the radius is missed. Identical fingerprints are merged first. A bucket that still holds
more than ``BUCKET`` different fingerprints is split by the same construction over the bits its mask leaves free, as
often as needed; small buckets are compared inside and return a spanning forest, never all pairs.

Defined results: a text without words (NULL, empty) has fingerprint zero and is linked like any other; repeated rows
each get their row; the component id is the smallest id reachable, NULL only if no row of the component has an id;
columns besides the named ones are ignored.
"""

from __future__ import annotations

import random
from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from marketlake.llm.common import keyed_rows, row_keys, small_batches, stored
from marketlake.llm.components import components

SHINGLE = 3
RADIUS = 3
SEED = 42
BUCKET = 128  # different fingerprints compared with each other at once; larger buckets are split first


# --- fingerprints ----------------------------------------------------------------------------------------------------


def shingle_hashes(text: str | None, size: int) -> np.ndarray:
    """XXH64 of each run of ``size`` words (of the whole sequence if it is shorter), repeats included."""
    words = (text or "").encode("utf-8").lower().split()  # bytes: only A-Z change, only \x09-\x0D and space part
    if not words:
        return np.empty(0, np.uint64)
    line = b" ".join(words)
    if len(words) <= size:
        return np.array([xxhash.xxh64_intdigest(line, SEED)], np.uint64)
    lengths = np.fromiter(map(len, words), np.int64, len(words))
    ends = np.cumsum(lengths + 1) - 1
    starts = (ends - lengths)[: len(words) - size + 1].tolist()
    digest = xxhash.xxh64_intdigest
    return np.array([digest(line[a:b], SEED) for a, b in zip(starts, ends[size - 1 :].tolist(), strict=True)], np.uint64)


def majority(hashes: np.ndarray) -> int:
    """The bits set in over half of the values."""
    counts = np.zeros(64, np.int64)
    for at in range(0, len(hashes), 1 << 16):
        part = hashes[at : at + (1 << 16)].astype("<u8")
        counts += np.unpackbits(part.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * counts > len(hashes), bitorder="little").view("<u8")[0]) if len(hashes) else 0


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text: str = "text", shingle: int = SHINGLE) -> DataFrame:
    """(id, key, key2, fp) for every row; ``fp`` is the fingerprint as a signed long."""

    def of(parts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for texts in parts:
            found = np.array([majority(shingle_hashes(t, shingle)) for t in texts], np.uint64)
            yield pd.Series(found.view(np.int64))

    fingerprint = F.pandas_udf(of, "bigint")
    return docs.select(F.col(id_col).alias("id"), *row_keys(id_col, text), fingerprint(F.col(text)).alias("fp"))


# --- covering masks --------------------------------------------------------------------------------------------------


def covering_masks(radius: int, level: int) -> list[int]:
    """2^(radius+1) - 1 masks; any ``radius`` bits lie outside at least one. Each level draws other vectors."""
    draw = random.Random(f"covering {radius} {level}")
    vectors = [draw.randrange(1, 1 << (radius + 1)) for _ in range(64)]
    return [
        sum(1 << bit for bit, m in enumerate(vectors) if (m & v).bit_count() % 2)
        for v in range(1, 1 << (radius + 1))
    ]


def signed(mask: int) -> int:
    return mask - (1 << 64) if mask >> 63 else mask


def keys(fps: DataFrame, radius: int, level: int) -> DataFrame:
    """(mask, key, fp): each fingerprint under each mask of the level, within the bits its bucket already agrees on."""
    family = F.array(*[F.lit(signed(m)).cast("bigint") for m in covering_masks(radius, level)])
    wider = fps.select("fp", F.explode(family).alias("part"), "mask").select(
        "fp", F.col("mask").bitwiseOR(F.col("part")).alias("mask")
    )
    if level:
        wider = wider.distinct()  # two masks of different buckets can widen to the same one
    return wider.select("mask", F.col("fp").bitwiseAND(F.col("mask")).alias("key"), "fp")


def forest(radius: int):
    """Links of a spanning forest inside each bucket."""

    def links(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for part in parts:
            out: list[tuple[int, int]] = []
            for members in part["fps"]:
                fps = np.sort(np.asarray(members, np.int64))
                bits = fps.view(np.uint64)
                near = np.bitwise_count(bits[:, None] ^ bits[None, :]) <= radius
                left = np.ones(len(fps), bool)
                for seed in range(len(fps)):
                    if not left[seed]:
                        continue
                    left[seed], front = False, [seed]
                    while front:
                        at = front.pop()
                        found = np.flatnonzero(near[at] & left)
                        left[found] = False
                        out += [(int(fps[at]), int(fps[f])) for f in found]
                        front += found.tolist()
            yield pd.DataFrame(out, columns=["a", "b"], dtype="int64")

    return links


def near_links(fps: DataFrame, radius: int = RADIUS, bucket: int = BUCKET) -> DataFrame:
    """(a, b): links that connect exactly the fingerprints connected by distances up to ``radius``.

    ``fps`` has one column ``fp`` of different values. Buckets of one are dropped, buckets up to ``bucket`` are compared
    inside, larger ones go to the next level, where they agree on more bits. Different fingerprints in a bucket differ
    in its free bits only, and every level frees fewer, so the levels end.
    """
    found = None
    rest = fps.select("fp", F.lit(0).cast("bigint").alias("mask"))
    level = 0
    while True:
        dealt = keys(rest, radius, level)
        sizes = dealt.groupBy("mask", "key").agg(F.count("*").alias("n")).where("n > 1")
        sizes = stored(sizes, "simhash-buckets")
        small = dealt.join(sizes.where(F.col("n") <= bucket).select("mask", "key"), ["mask", "key"])
        groups = small.groupBy("mask", "key").agg(F.collect_list("fp").alias("fps")).select("fps")
        links = stored(groups.mapInPandas(forest(radius), "a bigint, b bigint").distinct(), "simhash-links")
        found = links if found is None else found.unionByName(links)
        large = sizes.where(F.col("n") > bucket).select("mask", "key")
        if large.isEmpty():
            return found
        rest = stored(dealt.join(large, ["mask", "key"]).select("fp", "mask"), "simhash-large")
        level += 1


# --- components ------------------------------------------------------------------------------------------------------


def near_duplicates(
    docs: DataFrame, id_col: str = "doc_id", text: str = "text", shingle: int = SHINGLE, radius: int = RADIUS
) -> DataFrame:
    """(id, key, key2, fp, root, component_id) for every row; ``root`` names the component, also one without ids."""
    with small_batches(docs.sparkSession):
        own = stored(fingerprints(docs, id_col, text, shingle), "fingerprints")
    fps = stored(own.groupBy("fp").agg(F.min("id").alias("first")), "fingerprint-firsts")
    roots = components(near_links(fps.select("fp"), radius))
    rooted = fps.join(roots.select(F.col("node").alias("fp"), "root"), "fp", "left").select(
        "fp", "first", F.coalesce("root", "fp").alias("root")
    )
    linked = rooted.groupBy("root").agg(F.min("first").alias("component_id"))
    classes = stored(rooted.join(linked, "root").select("fp", "root", "component_id"), "fingerprint-classes")
    return own.join(classes, "fp", "left").select("id", "key", "key2", "fp", "root", "component_id")


def first_of_each(docs: DataFrame, id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """One row of each component: that of the smallest id, of the smallest key among equal or missing ids."""
    order = F.struct(F.col("id").isNull().alias("none"), "id", "key", "key2")
    firsts = near_duplicates(docs, id_col, text).groupBy("root").agg(F.min(order).alias("first"))
    firsts = stored(firsts.select("first.key", "first.key2"), "simhash-kept")
    kept = keyed_rows(docs, id_col, text).join(firsts, ["key", "key2"], "left_semi")
    return kept.dropDuplicates(["key", "key2"]).select("row.*")


def hex_digits(fp: Column) -> Column:
    return F.lower(F.lpad(F.hex(fp), 16, "0"))


def simhash_report(docs: DataFrame) -> DataFrame:
    found = near_duplicates(docs)
    return found.select(F.col("id").alias("doc_id"), hex_digits(F.col("fp")).alias("fingerprint"), "component_id")
