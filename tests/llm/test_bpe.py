import hashlib
import random
import sys
from pathlib import Path

import public_tokenizers
import pytest
from tokenizers import Tokenizer

sys.path.insert(0, str(Path(__file__).parent))
from cases import SF, by_id, docs, with_clashes

from marketlake.llm.bpe import Codec, bpe_report, character_classes, merged

PATH = public_tokenizers.path("word_bpe_49k.json")


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(PATH)


@pytest.fixture(scope="module")
def codec():
    return Codec(Path(PATH).read_text(encoding="utf-8"), character_classes())


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def brute(library, text):
    ids = library.encode(text or "", add_special_tokens=False).ids
    return {
        "n_tokens": len(ids),
        "ids_sha256": sha(" ".join(map(str, ids))),
        "decoded_sha256": sha(library.decode(ids, skip_special_tokens=False)),
    }


TEXTS = [
    None,
    "",
    " \n\t　  ",
    "Hello WORLD's <|endoftext|> x<|startoftext|>é 12ab3 it'LL",
    "<|endoftext|><|endoftext|>",
    "<|endoftext <|endoftext|",
    "ΑΣΣ ΌΔΟΣ İstanbul straße ǅ Å ᲉꟋ",
    "日本語テキスト 😀👩‍👩‍👧 x\x1cy\x85z\x00",
    "é É Å ﬁ ①②Ⅷ ½",
    "a" * 5000 + " " + "ab" * 3000 + "!" * 4000,
    "don't we've I'm they'll he'd 's'S ''s",
]


def test_every_character(library, codec):
    for start in range(0, 0x110000, 4096):
        for gap in ("", " "):
            text = gap.join(chr(c) for c in range(start, start + 4096) if not 0xD800 <= c < 0xE000)
            assert codec.encode(text) == library.encode(text, add_special_tokens=False).ids, hex(start)


def test_random_texts(library, codec):
    draw = random.Random(4)
    letters = "aabcdeeth nsrio  éßñ'.,!1%<|>\n😀Σ"
    for n in (1, 2, 5, 30, 400):
        for _ in range(150):
            text = "".join(draw.choice(letters) for _ in range(n))
            ids = codec.encode(text)
            assert ids == library.encode(text, add_special_tokens=False).ids
            assert codec.decode(ids) == library.decode(ids, skip_special_tokens=False)


def test_leftmost_lowest_rank_first():
    ranks, products = {(1, 1): 0, (2, 1): 1, (2, 2): 2}, [2, 3, 4]
    assert merged([1, 1, 1], ranks, products) == [3]
    assert merged([1] * 5, ranks, products) == [2, 3]
    assert merged([], ranks, products) == [] and merged([7], ranks, products) == [7]


def test_query_against_the_library(spark, library):
    got = by_id(bpe_report(with_clashes(docs(spark, TEXTS)), PATH))
    for i, text in enumerate(TEXTS):
        assert {k: v for k, v in got[i][0].items() if k != "doc_id"} == brute(library, text), text


def test_given_table(spark, library):
    given = spark.read.parquet(f"{SF}/documents.parquet")
    got = by_id(bpe_report(given, PATH))
    for i, text in given.select("doc_id", "text").collect():
        assert {k: v for k, v in got[i][0].items() if k != "doc_id"} == brute(library, text)


def test_repeats_null_ids_and_empty(spark):
    df = docs(spark, ["a b", "a b", None], ids=[1, 1, None])
    assert sorted(r["n_tokens"] for r in bpe_report(df, PATH).collect()) == [0, 2, 2]
    assert bpe_report(df.limit(0), PATH).count() == 0
