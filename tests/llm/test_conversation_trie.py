import hashlib
import random
import re
import sys
import zlib
from pathlib import Path

import duckdb
import pytest
from pyspark.sql import functions as F

sys.path.insert(0, str(Path(__file__).parent))
sys.path.insert(0, str(Path(__file__).parents[1]))
from cases import SF, with_clashes
from compare import difference

from marketlake.llm import conversation_trie as trie
from marketlake.llm.conversation_trie import ORACLE, conversation_trie

TURNS = "conv_id bigint, turn bigint, role string, text string"


def brute(rows):
    """The nodes from whole rebuilt conversations."""
    own = {}
    for c, turn, role, text in rows:
        if c is not None:
            own.setdefault(c, []).append((turn, role or "", text or ""))
    for c, turns in own.items():
        turns.sort(
            key=lambda t: (t[0] is not None, t[0] or 0, hashlib.sha256(f"{len(t[1].encode())}:{t[1]}{t[2]}".encode()).hexdigest())
        )
        own[c] = [t[1:] for t in turns]
    whole = {}
    for c, turns in own.items():
        h = zlib.crc32(str(c).encode()) % 4
        base = c - (abs(c) % 20) * (1 if c >= 0 else -1)
        whole[c] = tuple(own.get(base, [])[:h] + turns[h:])
    members = {}
    for c, turns in whole.items():
        for d in range(len(turns) + 1):
            members.setdefault(turns[:d], []).append(c)
    kids = {}
    for prefix in members:
        if prefix:
            kids[prefix[:-1]] = kids.get(prefix[:-1], 0) + 1
    saved, leaves = dict.fromkeys(members, 0), dict.fromkeys(members, 0)
    for prefix, convs in members.items():
        words = len(re.findall(r"[^\x20\x09-\x0D]+", prefix[-1][1])) if prefix else 0
        for d in range(len(prefix) + 1):
            saved[prefix[:d]] += (len(convs) - 1) * words
            leaves[prefix[:d]] += prefix not in kids
    out = []
    for prefix, convs in members.items():
        ends = ",".join(str(c) for c in sorted(convs) if len(whole[c]) == len(prefix))
        parent = min(members[prefix[:-1]]) if prefix else None
        out.append((
            min(convs), len(prefix), parent, len(convs), kids.get(prefix, 0), leaves[prefix], saved[prefix],
            hashlib.sha256(ends.encode()).hexdigest(),
        ))
    return sorted(out, key=repr)


def found(spark, rows):
    df = spark.createDataFrame(rows, TURNS).repartition(3)
    df = df.withColumns({c: F.lit("x") for c in ("conv", "at", "depth", "p0", "t0", "words", "ends", "n", "tie", "_part")})
    return sorted((tuple(r) for r in conversation_trie(with_clashes(df)).collect()), key=repr)


def made(convs, seed, spread=4):
    rnd = random.Random(seed)
    rows = []
    for c in convs:
        for t in range(rnd.randrange(0, 7)):
            rows.append((c, t, rnd.choice(["user", "assistant"]), rnd.choice(["hi there", "a b\tc", "", "one"][:spread])))
    return rows


@pytest.mark.parametrize("seed", [1, 2])
def test_against_rebuilt_texts(spark, seed):
    rows = made(range(3, 260), seed, spread=2 + seed)
    assert found(spark, rows) == brute(rows)


@pytest.fixture
def many_parts(spark):
    name = "spark.sql.adaptive.coalescePartitions.enabled"
    spark.conf.set(name, "false")
    yield
    spark.conf.unset(name)


def test_long_conversations_and_common_ones(spark, many_parts):
    rows = [(c, t, "user", f"w{t % 5} x") for c in (40, 41, 42) for t in range(700)]
    rows += [(41, 700, "user", "more"), (42, 650, "user", "tie")]
    rows += [(c, 0, "user", "only") for c in range(1000, 1400)]
    assert found(spark, rows) == brute(rows)


def test_nulls_ties_repeats_and_odd_ids(spark):
    rows = [
        (20, None, "user", "first"), (20, 0, None, None), (20, 0, "", ""), (20, 1, "user", "x" * 100_000), (20, 1, "a", "é"),
        (21, 0, "user", "first"), (21, 0, "user", "first"), (None, 0, "user", "no id"), (-7, 0, "user", "neg"),
        (-7, 1, "user", "neg"), (-27, 0, "u", "a"), (-27, 1, "u", "b"), (-20, 0, "u", "a"), (0, 0, "user", "zero zero"),
        (7, 5, "ab", "c"), (9, 5, "a", "bc"), (2**40, 0, "user", "big"),
    ]
    assert found(spark, rows) == brute(rows)


def test_empty_and_single(spark):
    assert found(spark, []) == []
    rows = [(1, 0, "user", "hello you")]
    assert found(spark, rows) == brute(rows)


def test_colliding_hashes_are_noticed(spark, monkeypatch):
    plain = trie.turn_hashes

    def weak(role, text, seed):
        """All turns alike at first; only the second character later; good hashes at last."""
        lanes = plain(role, text, seed)
        if seed == 0:
            return [F.lit(5).cast("bigint").alias(n) for n in trie.HASH]
        if seed == 1:
            return [(F.ascii(text).cast("bigint") + 1).alias(n) for n in trie.HASH]
        return lanes

    monkeypatch.setattr(trie, "turn_hashes", weak)
    rows = made(range(40), 5)
    assert found(spark, rows) == brute(rows)


def test_given_table_agrees_with_sql(spark):
    con = duckdb.connect()
    con.execute(f"CREATE VIEW conversations AS SELECT * FROM '{SF}/conversations.parquet'")
    given = spark.read.parquet(f"{SF}/conversations.parquet")
    assert difference(conversation_trie(given), con, ORACLE) is None
