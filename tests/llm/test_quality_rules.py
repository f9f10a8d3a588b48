import re
import sys
from collections import Counter
from pathlib import Path

import xxhash

sys.path.insert(0, str(Path(__file__).parent))
from cases import SF, by_id, docs, with_clashes

from marketlake.llm.quality_rules import BUCKETS, SPARE, fit, judge, micro_weights, quality_report

BASE = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed")


def brute(text):
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    lines = [line for line in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", line)]
    windows = [tuple(words[i : i + 8]) for i in range(len(words) - 7)]
    seen = Counter(windows)
    hit = {i + j for i, w in enumerate(windows) if seen[w] > 1 for j in range(8)}
    out = {
        "n_words": len(words),
        "word_chars": sum(map(len, words)),
        "n_symbols": len(re.findall(r"[#*$%&|<>]", text)),
        "n_dup_lines": len(lines) - len(set(lines)),
        "n_repeat_words": len(hit),
    }
    out["base_failed"] = len(words) < 20 or 100 * len(hit) > 30 * len(words)
    return out


def signed(value):
    return value - (1 << 64) if value >= 1 << 63 else value


def pair(a, b):
    """Spark hashes columns in turn; the hash so far is the next one's seed."""
    seed = xxhash.xxh64_intdigest((a % (1 << 64)).to_bytes(8, "little"), 42)
    return signed(xxhash.xxh64_intdigest((b % (1 << 64)).to_bytes(8, "little"), seed))


def grams(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    one = [signed(xxhash.xxh64_intdigest(w.encode(), 42)) for w in words]
    return [h & (BUCKETS - 1) for h in one + [pair(a, b) for a, b in zip(one, one[1:])]]


LINE = "the same eight words come here again today\n"
TEXTS = [
    None,
    "",
    " \n\t\x0b\x0c\r ",
    "one two",
    LINE * 2 + " ".join(f"w{i}" for i in range(30)),
    LINE * 3,
    " ".join(f"w{i}" for i in range(200)) + " ### $$ <b> & | é😀  x",
    "a b " * 40,
    "x\n\nx\n  \nx y\nX\n" + " ".join(f"v{i}" for i in range(25)),
    " ".join(f"u{i % 9}" for i in range(5000)),
]


def check(got, texts):
    assert sum(map(len, got.values())) == len(texts)
    for i, text in texts.items():
        for row in got[i]:
            assert {k: row[k] for k in BASE} == brute(text), (text or "")[:60]
            assert not (row["base_failed"] and row["kept"])


def labels(spark, rows):
    return spark.createDataFrame(rows, "doc_id bigint, quality int, toxic int")


def test_fixed_rules(spark):
    df = with_clashes(docs(spark, TEXTS))
    check(by_id(quality_report(df, labels(spark, [(6, 1, 0), (9, 0, 0), (None, 1, 0)]))), dict(enumerate(TEXTS)))


def test_model_against_brute_force(spark):
    given = spark.read.parquet(f"{SF}/documents.parquet")
    marks = spark.read.parquet(f"{SF}/labels.parquet")
    texts = dict(given.select("doc_id", "text").collect())
    good = {r["doc_id"] for r in marks.collect() if r["quality"] == 1 and r["toxic"] == 0}
    raw, target = [SPARE] * BUCKETS, [SPARE] * BUCKETS
    for i, text in texts.items():
        for b in grams(text):
            raw[b] += 1
            target[b] += i in good
    model = fit(given, marks)
    assert model.weights == micro_weights(raw, target) and model.threshold is not None
    got = by_id(judge(given, model).select("row.doc_id", "verdict.*"))
    check(got, texts)
    for i, text in texts.items():
        found = grams(text)
        want = sum(model.weights[b] for b in found) // len(found)
        assert got[i][0]["score"] == want
        assert got[i][0]["kept"] == (not got[i][0]["base_failed"] and want >= model.threshold)


def test_trusted_documents_stay_and_junk_goes(spark):
    given = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    marks = spark.read.parquet("/root/testdata/sf0.01/labels.parquet")
    rows = quality_report(given, marks).join(marks, "doc_id").where("not base_failed").collect()
    good = [r["kept"] for r in rows if r["quality"] == 1]
    junk = [r["kept"] for r in rows if r["quality"] == 0]
    assert sum(good) >= 0.99 * len(good)
    assert junk and sum(junk) <= 0.2 * len(junk)


def test_no_labels_repeats_and_empty(spark):
    df = docs(spark, [TEXTS[6], TEXTS[6], None], ids=[1, 1, None])
    rows = quality_report(df, labels(spark, [])).collect()
    assert sorted(r["kept"] for r in rows) == [False, True, True]
    assert quality_report(df.limit(0), labels(spark, [])).count() == 0
    assert quality_report(df.limit(0), labels(spark, [(1, 1, 0)])).count() == 0
