"""Benchmark decontamination by winnowing.

A k-gram of words is hashed at every place; of each run of ``WINDOW - GRAM + 1`` neighbouring hashes the smallest is
kept (the rightmost of equals). Two texts that share ``WINDOW`` words in a row share such a run and so keep the same
hash: joining the kept fingerprints of documents and benchmark finds every shared window. Each hit is then extended:
the windows around it are compared with the benchmark's windows by a 128-bit digest of their words. Items shorter than
a window are looked up by all grams of their own length, as winnowing guarantees nothing for them.

The fingerprint join and the window join are plain equi-joins of stored tables: Spark broadcasts the benchmark side
only if its stored size allows and shuffles otherwise.

Defined results: a NULL or empty text has no words and no hits; items without words have no windows; items without an
id taint words but are not listed; repeated rows each get their row; columns besides the named ones are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marketlake.llm.common import keyed_rows, row_keys, small_batches, stored

WINDOW = 10
GRAM = 5
BLOCK = 1 << 18  # bytes of text hashed at once; hashing takes about 40 times as much memory for a moment

#: A-Z to a-z; digits, letters and every byte of a character beyond ASCII stay; all else parts words.
WORD_BYTES = bytes(
    c + 32 if 65 <= c <= 90 else c if 48 <= c <= 57 or 97 <= c <= 122 or c >= 128 else 32 for c in range(256)
)
BASE, STEP, MIX = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F), np.uint64(0xFF51AFD7ED558CCD)


# --- helpers inside tasks --------------------------------------------------------------------------------------------


def word_bytes(text: str | None) -> bytes:
    return (text or "").encode("utf-8").translate(WORD_BYTES)


def words_of(text: str | None) -> list[bytes]:
    return word_bytes(text).split()


def mixed(values: np.ndarray) -> np.ndarray:
    values = (values ^ (values >> np.uint64(33))) * MIX
    return values ^ (values >> np.uint64(29))


def word_hashes(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """The hash of every word, and the text each word belongs to."""
    sizes = np.fromiter((len(t) + 1 for t in texts), np.int64, len(texts))
    data = np.frombuffer(b" ".join(texts) + b" ", np.uint8)
    held = data != 32
    turns = np.flatnonzero(np.diff(held, prepend=False, append=False))
    starts, lengths = turns[::2], turns[1::2] - turns[::2]
    if not len(starts):
        return np.empty(0, np.uint64), np.empty(0, np.int64)
    owners = np.searchsorted(np.cumsum(sizes), starts, side="right")
    firsts = np.cumsum(lengths) - lengths
    powers = np.cumprod(np.full(int(lengths.max()), BASE))
    places = np.arange(int(lengths.sum())) - np.repeat(firsts, lengths)
    sums = np.add.reduceat(data[held].astype(np.uint64) * powers[places], firsts)
    return mixed(sums + lengths.astype(np.uint64)), owners


def gram_hashes(words: np.ndarray, size: int) -> np.ndarray:
    """The hash of the ``size`` words from each place on."""
    n = max(0, len(words) - size + 1)
    total = np.full(n, np.uint64(size))
    for j in range(size):
        total = total * STEP + words[j : j + n]
    return mixed(total)


def kept_places(grams: np.ndarray, owners: np.ndarray) -> np.ndarray:
    """Places of the grams that are the smallest in some window of their text."""
    run = WINDOW - GRAM + 1
    n = max(0, len(grams) - run + 1)
    least, place = grams[:n].copy(), np.arange(n)
    for j in range(1, run):
        later = grams[j : j + n]
        lower = later <= least
        least[lower] = later[lower]
        place[lower] = np.flatnonzero(lower) + j
    inside = owners[:n] == owners[WINDOW - 1 : WINDOW - 1 + n]
    return np.unique(place[inside])


def fingerprints(texts: list[bytes], short: tuple[int, ...]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(words in each text, owner, place in the owner, hash) of the kept grams, and of all grams of ``short`` sizes."""
    words, owners = word_hashes(texts)
    counts = np.bincount(owners, minlength=len(texts))
    before = np.cumsum(counts) - counts
    grams = gram_hashes(words, GRAM)
    at = kept_places(grams, owners)
    places, hashes = [at], [grams[at]]
    for size in short:
        own = gram_hashes(words, size) ^ np.uint64(size)  # apart from the kept grams, also at the same size
        inside = np.flatnonzero(owners[: len(own)] == owners[size - 1 : size - 1 + len(own)])
        places.append(inside)
        hashes.append(own[inside])
    at, found = np.concatenate(places), np.concatenate(hashes)
    order = np.argsort(owners[at], kind="stable")
    at, found = at[order], found[order]
    return counts, owners[at], at - before[owners[at]], found


def blocks(texts: Iterator[bytes]) -> Iterator[list[bytes]]:
    block, size = [], 0
    for text in texts:
        block.append(text)
        size += len(text)
        if size >= BLOCK:
            yield block
            block, size = [], 0
    if block:
        yield block


def marking(short: tuple[int, ...]):
    """Batches of (id, key, key2, text) as (id, key, key2, n_words, fps, places)."""

    def marks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            done = 0
            for block in blocks(word_bytes(t) for t in batch.column("text").to_pylist()):
                counts, owners, places, found = fingerprints(block, short)
                ends = np.concatenate([[0], np.cumsum(np.bincount(owners, minlength=len(block)))]).astype(np.int32)
                lists = [
                    pa.ListArray.from_arrays(pa.array(ends), pa.array(values))
                    for values in (found.view(np.int64), places.astype(np.int32))
                ]
                ids = [batch.column(c).slice(done, len(block)) for c in ("id", "key", "key2")]
                done += len(block)
                columns = [*ids, pa.array(counts.astype(np.int64)), *lists]
                yield pa.RecordBatch.from_arrays(columns, names=["id", "key", "key2", "n_words", "fps", "places"])

    return marks


def digest(words: list[bytes]) -> bytes:
    return hashlib.blake2b(b" ".join(words), digest_size=16).digest()


def extend(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Batches of (key, key2, text, hits) as the windows around the hits: (key, key2, start, size, digest)."""
    for part in parts:
        rows = []
        for key, key2, text, hits in zip(part["key"], part["key2"], part["text"], part["hits"], strict=True):
            words = words_of(text)
            windows = set()
            for hit in hits:
                place, size = hit["place"], hit["size"]
                reach = WINDOW - GRAM if size == WINDOW else 0
                windows.update((s, size) for s in range(place - reach, place + 1) if 0 <= s <= len(words) - size)
            rows += [(key, key2, s, n, digest(words[s : s + n])) for s, n in windows]
        yield pd.DataFrame(rows, columns=["key", "key2", "start", "size", "digest"])


def item_windows(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Batches of (item, text) as (item, size, digest) of each window."""
    for part in parts:
        rows = []
        for item, text in zip(part["item"], part["text"], strict=True):
            words = words_of(text)
            size = min(WINDOW, len(words))
            found = {digest(words[s : s + size]) for s in range(len(words) - size + 1)} if words else ()
            rows += [(item, size, d) for d in found]
        yield pd.DataFrame(rows, columns=["item", "size", "digest"])


def item_fingerprints(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Batches of item texts as (fp, size): kept grams of long items, the one gram of a short item."""
    for part in parts:
        fps, sizes = [], []
        for text in part["text"]:
            own = word_bytes(text)
            n = len(own.split())
            short = (n,) if 0 < n < WINDOW else ()
            found = fingerprints([own], short)[3]
            fps += found.view(np.int64).tolist()
            sizes += [n if short else WINDOW] * len(found)
        yield pd.DataFrame({"fp": pd.Series(fps, dtype="int64"), "size": pd.Series(sizes, dtype="int32")})


# --- the jobs --------------------------------------------------------------------------------------------------------


def contamination(
    docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text: str = "text", item_col: str = "item_id"
) -> DataFrame:
    """(id, key, key2, n_words, n_hit, items) for every row; ``items`` are the ids, as sorted strings, whose windows occur."""
    items = benchmark.select(F.col(item_col).cast("string").alias("item"), F.col("text").alias("text"))
    windows = items.mapInPandas(item_windows, "item string, size int, digest binary").distinct()
    fps = items.select("text").distinct().mapInPandas(item_fingerprints, "fp bigint, size int").distinct()
    with small_batches(docs.sparkSession):
        windows, fps = stored(windows, "benchmark-windows"), stored(fps, "benchmark-fps")
    sizes = [r["size"] for r in windows.where(F.col("size") < WINDOW).select("size").distinct().collect()]  # below 10

    rows = docs.select(F.col(id_col).alias("id"), *row_keys(id_col, text), F.col(text).alias("text"))
    id_type = rows.schema["id"].dataType.simpleString()
    marks = rows.mapInArrow(
        marking(tuple(sorted(sizes))),
        f"id {id_type}, key bigint, key2 int, n_words bigint, fps array<bigint>, places array<int>",
    )
    with small_batches(docs.sparkSession):
        marks = stored(marks, "document-fps")
    placed = marks.select("key", "key2", F.inline(F.arrays_zip(F.col("fps").alias("fp"), F.col("places").alias("place"))))
    hits = stored(
        placed.join(fps, "fp").groupBy("key", "key2").agg(F.collect_set(F.struct("place", "size")).alias("hits")),
        "fingerprint-hits",
    )
    around = rows.join(hits, ["key", "key2"]).select("key", "key2", "text", "hits")
    near = around.mapInPandas(extend, "key bigint, key2 int, start int, size int, digest binary")
    with small_batches(docs.sparkSession):
        found = stored(near.join(windows.select("digest").distinct(), "digest", "left_semi"), "window-hits")

    spans = found.groupBy("key", "key2").agg(
        F.sort_array(F.collect_set(F.struct("start", (F.col("start") + F.col("size")).alias("end")))).alias("spans")
    )
    covered = F.aggregate(
        "spans",
        F.struct(F.lit(0).alias("to"), F.lit(0).cast("bigint").alias("n")),
        lambda acc, s: F.struct(
            F.greatest(acc["to"], s["end"]).alias("to"),
            (acc["n"] + F.greatest(F.lit(0), s["end"] - F.greatest(acc["to"], s["start"]))).alias("n"),
        ),
        lambda acc: acc["n"],
    )
    listed = (
        found.select("key", "key2", "digest")
        .distinct()
        .join(windows.where("item is not null"), "digest")
        .groupBy("key", "key2")
        .agg(F.sort_array(F.collect_set("item")).alias("items"))
    )
    return (
        marks.select("id", "key", "key2", "n_words")
        .join(spans.select("key", "key2", covered.alias("n_hit")), ["key", "key2"], "left")
        .join(listed, ["key", "key2"], "left")
        .select(
            "id",
            "key",
            "key2",
            "n_words",
            F.coalesce("n_hit", F.lit(0).cast("bigint")).alias("n_hit"),
            F.coalesce("items", F.array().cast("array<string>")).alias("items"),
        )
    )


def decontamination_report(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    return contamination(docs, benchmark).select(
        F.col("id").alias("doc_id"),
        "n_words",
        "n_hit",
        F.size("items").cast("bigint").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"),
        (F.col("n_hit") > 0).alias("contaminated"),
    )


def clean_documents(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """The rows of ``docs`` without a hit."""
    hit = contamination(docs, benchmark, id_col, text).where("n_hit > 0").select("key", "key2").distinct()
    hit = stored(hit, "contaminated")
    return keyed_rows(docs, id_col, text).join(hit, ["key", "key2"], "left_anti").select("row.*")


#: The same rows in SQL: every window of every document is compared.
ORACLE = r"""
WITH d AS (
  SELECT doc_id, row_number() OVER () AS r,
    regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
      '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
  FROM documents),
b AS (
  SELECT item_id,
    regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
      '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
  FROM benchmark),
bw AS (
  SELECT DISTINCT item_id, least(10, len(w)) AS n, array_to_string(w[i:i + least(10, len(w)) - 1], ' ') AS k
  FROM b, unnest(generate_series(1, len(w) - least(10, len(w)) + 1)) AS g(i) WHERE len(w) > 0),
sizes AS (SELECT DISTINCT n FROM bw),
dw AS (
  SELECT r, i, n, array_to_string(w[i:i + n - 1], ' ') AS k
  FROM d, sizes, unnest(generate_series(1, len(w) - n + 1)) AS g(i)),
hits AS (SELECT r, i, dw.n, item_id FROM dw JOIN bw ON dw.k = bw.k AND dw.n = bw.n),
n_hits AS (
  SELECT r, count(DISTINCT p) AS n_hit FROM hits, unnest(generate_series(i, i + n - 1)) AS g(p) GROUP BY r),
n_items AS (
  SELECT r, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items
  FROM (SELECT DISTINCT r, CAST(item_id AS VARCHAR) AS item FROM hits WHERE item_id IS NOT NULL) GROUP BY r)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
  sha256(coalesce(items, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN n_hits USING (r) LEFT JOIN n_items USING (r)
"""
