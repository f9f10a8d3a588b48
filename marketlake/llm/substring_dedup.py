"""Substring dedup by content-defined chunks.

A gear rolling hash runs over a text's bytes; a cut lies where the hash is the smallest within ``REACH`` bytes on both
sides. Cuts depend on nearby bytes only, so an insertion moves the cuts around it and no others, and a passage has the
same chunks wherever it stands. Chunks are at least ``REACH`` bytes long. Two neighbouring chunks form a unit, which is
known by its 128-bit digest: a short run of common words is no repeat by itself. The first place of a unit (smallest
document, then earliest place) stays, all others are cut out.

A stretch that repeats with a period of at most ``REACH`` bytes has no cut. It gets units of its own: whole periods from
the first least rotation on, each known by its bytes and its number in the stretch, and the stretch as a whole. So a
stretch that other documents have too is found whatever surrounds it, but is no repeat of itself.

Within a document, repeats are found in the task that chunks it; across documents, units meet by digest: per digest
only the smallest and largest document are kept (partial sums before the shuffle), and units are joined with those, so
a digest that a third of all documents share is one row on one side and can be split on the other.

Defined results: a NULL text stays NULL; an empty one has no units; rows of one id are one document (they may share
units), rows without an id are told apart by their text; texts without repeats are unchanged; offsets are code points.
With ``each_row`` every row is a document of its own, so of rows with one id, and of equal rows without one, a single copy
stays. Ids may be of any type that has a text form: whole numbers count by value, others by their text.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from marketlake.llm.common import stored

REACH = 24
LEAST_UNIT = 2 * REACH + 2  # bytes; shorter units are never repeats
BLOCK = 1 << 21
LEAST_RUN = 100  # bytes of a periodic stretch; shorter ones have no units of their own
GAP = 64  # zero bytes between texts; more than the reach and the rolling window together

#: 32-bit gear values, a fixed pseudo-random function of the byte. Zero bytes add nothing, so gaps are neutral.
GEAR = np.array(
    [0] + [int.from_bytes(hashlib.sha256(bytes([b])).digest()[:4], "little") for b in range(1, 256)], np.uint32
)


def rolled(data: np.ndarray) -> np.ndarray:
    """The gear hash of the last 16 bytes at each place: each step doubles the bytes taken in."""
    value = GEAR[data]
    for width in (1, 2, 4, 8):
        value[width:] += value[:-width] << np.uint32(width)
    value *= np.uint32(0x9E3779B1)
    return value ^ (value >> np.uint32(15))


def least_ahead(value: np.ndarray, reach: int) -> np.ndarray:
    """The smallest value among ``reach`` places from each place on."""
    width = 1
    least = value.copy()
    while 2 * width <= reach:
        least[:-width] = np.minimum(least[:-width], least[width:])
        width *= 2
    rest = reach - width
    if rest:
        least[:-rest] = np.minimum(least[:-rest], least[rest:])
    return least


def cuts(texts: list[bytes]) -> list[np.ndarray]:
    """For each text the places where chunks begin, and its length."""
    gap = b"\0" * GAP
    data = np.frombuffer(gap + gap.join(texts) + gap, np.uint8)
    value = rolled(data)
    value[(data & 0xC0) == 0x80] = np.iinfo(np.uint32).max  # never inside a character
    starts = np.cumsum([GAP, *(len(t) + GAP for t in texts[:-1])])
    ends = starts + np.fromiter(map(len, texts), np.int64, len(texts))
    for a, b in zip(ends.tolist(), [*(starts[1:].tolist()), len(data)], strict=True):
        value[a:b] = np.iinfo(np.uint32).max
    value[:GAP] = np.iinfo(np.uint32).max
    least = least_ahead(value, REACH)
    place = np.arange(REACH, len(data) - REACH)
    found = place[(value[place] < least[place - REACH]) & (value[place] <= least[place + 1])]
    out = []
    for a, b in zip(starts.tolist(), ends.tolist(), strict=True):
        own = found[np.searchsorted(found, a, side="right") : np.searchsorted(found, b)] - a
        out.append(np.concatenate([[0], own, [b - a]]))
    return out


def units(text: bytes, places: np.ndarray) -> Iterator[tuple[bytes, int, int]]:
    """(digest, start, end) of each two neighbouring chunks. Only the chunks at both ends of a text can be so short
    that two are no unit yet; there the unit reaches further inward, at most over the whole text."""
    at = places.tolist()
    for i in range(max(1, len(at) - 2)):
        low, high = i, min(i + 2, len(at) - 1)
        while at[high] - at[low] < LEAST_UNIT and i == 0 and high < len(at) - 1:
            high += 1
        while at[high] - at[low] < LEAST_UNIT and high == len(at) - 1 and low > 0:
            low -= 1
        a, b = at[low], at[high]
        if b - a >= LEAST_UNIT:
            yield hashlib.blake2b(text[a:b], digest_size=16).digest(), a, b


def stretches(text: bytes, low: int, high: int) -> Iterator[tuple[int, int, int]]:
    """(period, start, end) of the longest periodic stretches between two places, shortest periods first."""
    data = np.frombuffer(text, np.uint8)[low:high]
    found: list[tuple[int, int]] = []
    for period in range(1, REACH + 1):
        same = np.concatenate([[False], data[period:] == data[:-period], [False]])
        edges = np.flatnonzero(same[1:] != same[:-1])
        for a, b in zip(edges[::2].tolist(), edges[1::2].tolist(), strict=True):
            start, end = a, b + period
            if end - start >= LEAST_RUN and not any(x <= start and end <= y for x, y in found):
                found.append((start, end))
                yield period, low + start, low + end


def run_units(text: bytes, places: np.ndarray) -> Iterator[tuple[bytes, int, int]]:
    """(digest, start, end) of the units of periodic stretches. A stretch has no cut beyond the first bytes that see what
    is before it, so only long chunks are looked at."""
    lead = REACH + 15
    done: set[tuple[int, int]] = set()
    for at in np.flatnonzero(np.diff(places) >= LEAST_RUN - lead).tolist():
        low, high = max(0, int(places[at]) - lead), int(places[at + 1])
        if not may_repeat(text[low:high]):
            continue
        for period, a, b in stretches(text, low, high):
            # Whole characters only.
            while a < b and text[a] & 0xC0 == 0x80:
                a += 1
            while b > a and b < len(text) and text[b] & 0xC0 == 0x80:
                b -= 1
            turns = [i for i in range(a, a + period) if text[i] & 0xC0 != 0x80]
            if b - a < LEAST_UNIT or (a, b) in done or not turns:
                continue
            done.add((a, b))
            yield hashlib.blake2b(text[a:b], digest_size=16, person=b"whole").digest(), a, b
            first = min(turns, key=lambda i: (text[i : i + period], i))
            step = -(-LEAST_UNIT // period) * period
            for n, start in enumerate(range(first, b - step + 1, step)):
                word = hashlib.blake2b(text[start : start + step], digest_size=16, person=b"run", salt=n.to_bytes(8, "big"))
                yield word.digest(), start, start + step


def may_repeat(piece: bytes) -> bool:
    """Whether a periodic stretch can be in it: the bytes at the middle of one are there again within ``REACH``."""
    size = (LEAST_RUN - REACH) // 2
    return any(piece.find(piece[i : i + size], i + 1, i + size + REACH) >= 0 for i in range(0, len(piece) - size, size))


def chunk(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Batches of (doc, tkey, text) as units (digest, doc, tkey, start, end, again); ``again``: seen in this text."""

    def rows(block: list[tuple], doc_type: pa.DataType) -> pa.RecordBatch:
        texts = [t for _, _, t in block]
        columns: list[list] = [[], [], [], [], [], []]
        for (doc, tkey, text), places in zip(block, cuts(texts), strict=True):
            seen: dict[bytes, int] = {}
            for digest, a, b in chain(units(text, places), run_units(text, places)):
                again = digest in seen
                seen.setdefault(digest, a)
                for column, value in zip(columns, (digest, doc, tkey, a, b, again), strict=True):
                    column.append(value)
        types = (pa.binary(), doc_type, pa.int64(), pa.int32(), pa.int32(), pa.bool_())
        names = ["digest", "doc", "tkey", "start", "end", "again"]
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types, strict=True)], names=names)

    for batch in batches:
        block, size, doc_type = [], 0, batch.schema.field("doc").type
        for doc, tkey, text in zip(*(batch.column(c).to_pylist() for c in ("doc", "tkey", "text")), strict=True):
            block.append((doc, tkey, text.encode("utf-8")))
            size += len(text)
            if size >= BLOCK:
                yield rows(block, doc_type)
                block, size = [], 0
        if block:
            yield rows(block, doc_type)


def joined(spans) -> list[tuple[int, int]]:
    out: list[list[int]] = []
    for a, b in sorted((s["start"], s["end"]) for s in spans):
        if out and a <= out[-1][1]:
            out[-1][1] = max(b, out[-1][1])
        else:
            out.append([a, b])
    return [(a, b) for a, b in out]


def cut_out(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Batches of (id, text, spans) with byte spans as (id, text, spans) with the spans gone, in code points."""
    kind = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())]))
    for batch in batches:
        texts, spans = [], []
        for text, found in zip(batch.column("text").to_pylist(), batch.column("spans").to_pylist(), strict=True):
            if not found:
                texts.append(text)
                spans.append([])
                continue
            data, parts, own, at, place = text.encode("utf-8"), [], [], 0, 0
            for a, b in joined(found):
                kept, gone = data[at:a].decode("utf-8"), len(data[a:b].decode("utf-8"))
                parts.append(kept)
                own.append({"start": place + len(kept), "end": place + len(kept) + gone})
                at, place = b, place + len(kept) + gone
            texts.append("".join(parts) + data[at:].decode("utf-8"))
            spans.append(own)
        columns = [batch.column("id"), pa.array(texts, pa.string()), pa.array(spans, kind)]
        yield pa.RecordBatch.from_arrays(columns, names=["id", "text", "spans"])


def document_key(id_type: T.DataType, each_row: bool) -> Column:
    """What rows of (id, tkey, and ``row`` with ``each_row``) are ordered and told apart by; no part of it is NULL.
    Rows without an id come last."""
    whole = isinstance(id_type, T.IntegralType)
    if whole and not each_row:
        nameless = F.col("tkey").bitwiseAND(F.lit((1 << 62) - 1)) + F.lit(1 << 62)  # after every id
        return F.coalesce(F.col("id").cast("bigint"), nameless)
    return F.struct(
        F.col("id").isNull().cast("int").alias("nameless"),
        F.coalesce(F.col("id").cast("bigint") if whole else F.lit(None), F.lit(0)).cast("bigint").alias("value"),
        F.coalesce(F.lit(None) if whole else F.col("id").cast("string"), F.lit("")).alias("name"),
        (F.col("row") if each_row else F.when(F.col("id").isNull(), F.col("tkey")).otherwise(F.lit(0)))
        .cast("bigint")
        .alias("number"),
    )


def dedup_substrings(
    docs: DataFrame, id_col: str = "doc_id", text: str = "text", each_row: bool = False
) -> DataFrame:
    """(id, text, spans) for every row: the text without its repeats, and what was cut out.

    With ``each_row`` rows get numbers, which are stored before they are used, as a task that runs again may number anew.
    """
    rows = docs.select(F.col(id_col).alias("id"), F.col(text).alias("text"))
    if each_row:
        rows = stored(rows.withColumn("row", F.monotonically_increasing_id()), "substring-rows")
    rows = rows.withColumn("tkey", F.xxhash64("text"))
    rows = rows.withColumn("doc", document_key(rows.schema["id"].dataType, each_row))
    doc_type = rows.schema["doc"].dataType.simpleString()
    found = (
        rows.where(F.octet_length("text") >= LEAST_UNIT)
        .select("doc", "tkey", "text")
        .mapInArrow(chunk, f"digest binary, doc {doc_type}, tkey bigint, start int, end int, again boolean")
    )
    shared = (
        found.where("not again")
        .groupBy("digest")
        .agg(F.min("doc").alias("keeper"), F.max("doc").alias("last"))
        .where("keeper < last")
        .drop("last")
    )
    gone = found.join(shared, "digest", "left").where("again or keeper < doc")
    spans = gone.groupBy("doc", "tkey").agg(F.collect_set(F.struct("start", "end")).alias("spans"))
    kind = rows.schema["id"].dataType.simpleString()
    return (
        rows.join(spans, ["doc", "tkey"], "left")
        .select("id", "text", "spans")
        .mapInArrow(cut_out, f"id {kind}, text string, spans array<struct<start:int,end:int>>")
        .withColumnRenamed("id", id_col)
    )


def substring_report(docs: DataFrame) -> DataFrame:
    """Per document: the text left, the spans cut out, their number and length."""
    return dedup_substrings(docs).select(
        "doc_id",
        "text",
        F.size("spans").cast("bigint").alias("n_spans"),
        F.aggregate("spans", F.lit(0).cast("bigint"), lambda acc, s: acc + s["end"] - s["start"]).alias("dup_chars"),
        F.array_join(F.transform("spans", lambda s: F.concat_ws(":", s["start"], s["end"])), ",").alias("spans"),
        (F.size("spans") > 0).alias("has_repeat"),
    )
