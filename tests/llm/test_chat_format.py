import sys
from pathlib import Path

import duckdb

sys.path.insert(0, str(Path(__file__).parent))
sys.path.insert(0, str(Path(__file__).parents[1]))
from cases import SF, by_id, with_clashes
from compare import difference

from marketlake.llm.chat_format import ORACLE, preference_pairs, preference_report

TURN = "pair_id bigint, turn bigint, role string, text string"


def brute(good, bad):
    def whole(turns):
        return sorted((t, r or "", x or "") for t, r, x in turns)

    def render(turns):
        out, spans = "", []
        for _, role, text in turns:
            out += f"<|{role}|>\n"
            if role == "assistant":
                spans.append((len(out), len(out) + len(text) + len("<|end|>")))
            out += text + "<|end|>\n"
        return out, spans

    good, bad, n = whole(good), whole(bad), 0
    while n < min(len(good), len(bad)) and good[n][1:] == bad[n][1:]:
        n += 1
    (prompt, _), (a, x), (b, y) = render(good[:n]), render(good[n:]), render(bad[n:])
    return {"n_prompt_turns": n, "prompt": prompt, "chosen": a, "rejected": b, "chosen_loss": x, "rejected_loss": y}


GOOD = {
    1: [(0, "user", "hi"), (1, "assistant", "hello é😀"), (2, "user", "bye"), (3, "assistant", "see you")],
    2: [(0, "user", "same"), (1, "assistant", "same")],
    3: [(0, None, None), (1, "assistant", "")],
    4: [(0, "user", "only chosen")],
    6: [(0, "user", "q"), (0, "user", "q"), (1, "assistant", "a" * 100_000), (2, "assistant", "b")],
    7: [(i, "assistant" if i % 2 else "user", f"t{i}") for i in range(700)],
}
BAD = {
    1: [(0, "user", "hi"), (1, "assistant", "hello é😀"), (2, "user", "bye!"), (3, "assistant", "no")],
    2: [(0, "user", "same"), (1, "assistant", "same")],
    3: [(5, "", ""), (6, "assistant", "x")],
    5: [(0, "user", "only rejected"), (1, "assistant", "y")],
    6: [(0, "user", "q"), (1, "assistant", "a")],
    7: [(i, "assistant" if i % 2 else "user", f"t{i}" if i < 100 else f"u{i}") for i in range(700)],
}


def frame(spark, turns):
    rows = [(k, *t) for k, v in turns.items() for t in v] + [(None, 0, "user", "of no pair")]
    return with_clashes(spark.createDataFrame(rows, TURN).repartition(3))


def test_against_brute_force(spark):
    got = by_id(preference_pairs(frame(spark, GOOD), frame(spark, BAD)), "pair_id")
    assert got.keys() == GOOD.keys() | BAD.keys()
    for k, rows in got.items():
        row = rows[0]
        row["chosen_loss"], row["rejected_loss"] = ([tuple(s) for s in row[c]] for c in ("chosen_loss", "rejected_loss"))
        assert {c: v for c, v in row.items() if c != "pair_id"} == brute(GOOD.get(k, []), BAD.get(k, [])), k


def test_given_table_agrees_with_sql(spark):
    con = duckdb.connect()
    con.execute(f"CREATE VIEW conversations AS SELECT * FROM '{SF}/conversations.parquet'")
    given = spark.read.parquet(f"{SF}/conversations.parquet")
    assert difference(preference_report(given), con, ORACLE) is None


def test_edge_rows_agree_with_sql(spark, tmp_path):
    rows = [
        (1, 0, "user", "q"), (1, 1, "assistant", None), (1, 2, "assistant", "a"), (1, 2, "assistant", "a"),
        (2, 0, "assistant", "first"), (3, 0, "user", None), (3, 1, None, "x"), (4, 0, "user", "e"), (4, 1, "assistant", "e"),
        (None, 0, "user", "x"), (5, 1, "user", "q"), (5, 1, "user", "p"), (5, 2, "assistant", "é" * 9),
    ]
    df = spark.createDataFrame(rows, "conv_id bigint, turn bigint, role string, text string")
    df.coalesce(1).write.parquet(str(tmp_path / "c"))
    con = duckdb.connect()
    con.execute(f"CREATE VIEW conversations AS SELECT * FROM '{tmp_path}/c/*.parquet'")
    assert difference(preference_report(df), con, ORACLE) is None
    assert preference_report(df.limit(0)).count() == 0
