"""Encoding and decoding with a published word-end BPE vocabulary.

Merges of a word are found with a segment tree: each leaf holds the rank of the pair that starts at a symbol, an inner
node the lowest rank below it and its place, so the root is the leftmost lowest-ranked merge. A merge changes three
leaves, each updated along its path in logarithmic time, until no pair of the word can be merged. Encoded words are
remembered up to a fixed number per worker.

The vocabulary file is read by the driver and broadcast (its size is that of the published file). Spaces only part
words here, so the normalizer's collapsing of space runs needs no step of its own.

Defined results: a NULL or empty text has no tokens and decodes to an empty text; strings of special tokens in a text
become those tokens, as in the published library; repeated rows each get their row; other columns are ignored.
"""

from __future__ import annotations

import json
import re
from collections.abc import Iterator
from functools import cache
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

MOST_WORDS = 1 << 18  # words in each of a worker's two generations of remembered words
LONGEST_WORD = 48  # longer words are encoded each time
BLOCK = 1 << 21  # characters of text put into one output batch

FAR = 1 << 30  # the rank of a pair that is never merged
NONE = FAR << 32


def merged(symbols: list[int], ranks: dict[tuple[int, int], int], products: list[int]) -> list[int]:
    """``symbols`` after all merges, always the leftmost pair of the lowest rank first."""
    n = len(symbols)
    if n < 2:
        return symbols
    size = 1 << (n - 1).bit_length()
    rank_of = ranks.get
    tree = [NONE] * size
    tree += [rank_of(pair, FAR) << 32 | i for i, pair in enumerate(zip(symbols, symbols[1:]))]
    tree += [NONE] * (2 * size - len(tree))
    for i in range(size - 1, 0, -1):
        left, right = tree[2 * i], tree[2 * i + 1]
        tree[i] = left if left < right else right
    symbols = [*symbols, -1]  # -1 is in no pair
    after, before = list(range(1, n + 1)), list(range(-1, n))
    top = tree[1]
    while top < NONE:
        at = top & 0xFFFFFFFF
        gone = after[at]
        following, previous = after[gone], before[at]
        symbols[at] = new = products[top >> 32]
        after[at], before[following] = following, at
        changed = [(gone, NONE), (at, rank_of((new, symbols[following]), FAR) << 32 | at)]
        if previous >= 0:
            changed.append((previous, rank_of((symbols[previous], new), FAR) << 32 | previous))
        for place, value in changed:
            place += size
            tree[place] = value
            while place > 1:
                other = tree[place ^ 1]
                if other < value:
                    value = other
                place >>= 1
                if tree[place] == value:
                    break
                tree[place] = value
        top = tree[1]
    out, at = [], 0
    while at < n:
        out.append(symbols[at])
        at = after[at]
    return out


def byte_characters() -> list[str]:
    """The printable character that stands for each byte: itself where it has one, else the next from 256 on."""
    own = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = iter(range(256, 512))
    return [chr(b) if b in own else chr(next(rest)) for b in range(256)]


@cache
def character_classes() -> tuple[list[tuple[int, int]], ...]:
    """Letters, numbers and spaces as ranges. Unicode grows, so they are those of the published library's version."""
    from tokenizers import Regex
    from tokenizers.pre_tokenizers import Split

    everything = "".join(map(chr, chain(range(0xD800), range(0xE000, 0x110000))))

    def ranges(pattern: str) -> list[tuple[int, int]]:
        runs = Split(Regex(f"{pattern}+"), "removed", invert=True).pre_tokenize_str(everything)
        return [(ord(everything[a]), ord(everything[b - 1])) for _, (a, b) in runs]

    return ranges(r"\p{L}"), ranges(r"\p{N}"), ranges(r"\s")


def word_pattern(classes: tuple[list[tuple[int, int]], ...], top: int) -> re.Pattern:
    """The words of texts without characters beyond ``top``. Sets of few characters are matched much faster."""
    letters, numbers, spaces = (
        "".join(f"\\U{a:08x}-\\U{min(b, top):08x}" for a, b in ranges if a <= top) for ranges in classes
    )
    return re.compile(f"'s|'t|'re|'ve|'m|'ll|'d|[{letters}]+|[{numbers}]|[^{spaces}{letters}{numbers}]+")


class Codec:
    """One vocabulary: text to ids and back."""

    def __init__(self, source: str, classes: tuple[list[tuple[int, int]], ...]):
        parts = json.loads(source)
        model = parts["model"]
        self.source = source
        self.vocabulary = model["vocab"]
        self.suffix = model["end_of_word_suffix"] or ""
        specials = {t["content"]: t["id"] for t in parts["added_tokens"]}
        self.specials = specials
        self.tokens = {i: t for t, i in {**self.vocabulary, **specials}.items()}
        self.ranks, self.products = {}, []
        for left, right in model["merges"]:
            self.ranks[self.vocabulary[left], self.vocabulary[right]] = len(self.products)
            self.products.append(self.vocabulary[left + right])
        self.latin, self.plane, self.word = (word_pattern(classes, top) for top in (0xFF, 0xFFFF, 0x10FFFF))
        self.special = re.compile(f"({'|'.join(map(re.escape, sorted(specials, key=len, reverse=True)))})")
        self.characters = byte_characters()
        self.known: dict[str, tuple[int, ...]] = {}
        self.older: dict[str, tuple[int, ...]] = {}
        self.normalizer = None

    def words(self, text: str) -> list[str]:
        """The composed, lower-cased words. Latin-1 text is composed already."""
        try:
            text.encode("latin-1")
            return self.latin.findall(text.lower())
        except UnicodeEncodeError:
            if self.normalizer is None:
                from tokenizers import Tokenizer

                self.normalizer = Tokenizer.from_str(self.source).normalizer
            text = self.normalizer.normalize_str(text)
            return (self.plane if max(text, default="") <= "\uffff" else self.word).findall(text)

    def remember(self, word: str) -> tuple[int, ...]:
        ids = self.older.get(word)
        if ids is None:
            ids = self.word_ids(word)
        if len(word) <= LONGEST_WORD:
            if len(self.known) >= MOST_WORDS:
                self.known, self.older = {}, self.known
            self.known[word] = ids
        return ids

    def word_ids(self, word: str) -> tuple[int, ...]:
        own = [self.characters[b] for b in word.encode("utf-8")]
        own[-1] += self.suffix
        symbols = [self.vocabulary[c] for c in own if c in self.vocabulary]
        return tuple(merged(symbols, self.ranks, self.products))

    def encode(self, text: str | None) -> list[int]:
        out: list[int] = []
        for part in self.special.split(text or "") if self.specials else [text or ""]:
            if part in self.specials:
                out.append(self.specials[part])
                continue
            for word in self.words(part):
                out += self.known.get(word) or self.remember(word)
        return out

    def decode(self, ids: list[int]) -> str:
        """Without a decoder of its own, the vocabulary's tokens are joined by spaces."""
        return " ".join(map(self.tokens.__getitem__, ids))


_CODECS: dict[int, Codec] = {}


def codec_of(broadcast) -> Codec:
    """A worker parses a vocabulary once."""
    source, classes = broadcast.value
    if hash(source) not in _CODECS:
        _CODECS[hash(source)] = Codec(source, classes)
    return _CODECS[hash(source)]


def encode(docs: DataFrame, path: str, id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """(id, ids) for every row."""
    vocabulary = broadcast_file(docs, path)
    rows = docs.select(F.col(id_col).alias("id"), F.col(text).alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = codec_of(vocabulary)
        for batch in batches:
            for part in by_size(batch, pc.utf8_length(batch.column("text"))):
                found = [np.array(codec.encode(t), np.int32) for t in part.column("text").to_pylist()]
                ends = np.cumsum([0, *map(len, found)], dtype=np.int32)
                ids = pa.ListArray.from_arrays(pa.array(ends), pa.array(np.concatenate(found)))
                yield pa.RecordBatch.from_arrays([part.column("id"), ids], names=["id", "ids"])

    kind = rows.schema["id"].dataType.simpleString()
    return rows.mapInArrow(run, f"id {kind}, ids array<int>").withColumnRenamed("id", id_col)


def decode(encoded: DataFrame, path: str, ids: str = "ids") -> DataFrame:
    """``encoded`` with a column ``decoded``."""
    vocabulary = broadcast_file(encoded, path)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = codec_of(vocabulary)
        for batch in batches:
            for part in by_size(batch, pc.multiply(pc.list_value_length(batch.column(ids)), 8)):
                texts = [codec.decode(i) for i in id_lists(part.column(ids))]
                columns = [*part.columns, pa.array(texts, pa.string())]
                yield pa.RecordBatch.from_arrays(columns, names=[*part.schema.names, "decoded"])

    return encoded.mapInArrow(run, T.StructType([*encoded.schema.fields, T.StructField("decoded", T.StringType())]))


def broadcast_file(df: DataFrame, path: str):
    with open(path, encoding="utf-8") as file:
        return df.sparkSession.sparkContext.broadcast((file.read(), character_classes()))


def id_lists(column: pa.ListArray) -> Iterator[list[int]]:
    """The lists of a column, NULL as an empty one: its values become numbers at once, not one by one."""
    ends = column.offsets.to_pylist()
    values = column.values[ends[0] : ends[-1]].to_numpy(zero_copy_only=False)
    for row, valid in enumerate(column.is_valid().to_pylist()):
        yield values[ends[row] - ends[0] : ends[row + 1] - ends[0]].tolist() if valid else []


def by_size(batch: pa.RecordBatch, sizes: pa.Array) -> Iterator[pa.RecordBatch]:
    """Slices of ``batch`` of about BLOCK characters, a row at least."""
    total = np.cumsum(np.nan_to_num(sizes.to_numpy(zero_copy_only=False).astype(float)))
    at = 0
    while at < len(total):
        reach = (total[at - 1] if at else 0) + BLOCK
        end = max(at + 1, int(np.searchsorted(total, reach, side="right")))
        yield batch.slice(at, end - at)
        at = end


def bpe_report(docs: DataFrame, path: str) -> DataFrame:
    found = decode(encode(docs, path), path)
    return found.select(
        "doc_id",
        F.size("ids").cast("bigint").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), " "), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )
