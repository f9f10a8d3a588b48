"""Secret scan over a trigram inverted index.

Every rule's regular expression is turned into a Boolean query over trigrams (alternatives of trigram sets that any
match must contain). Postings (trigram, document) are built for the trigrams the rules ask for and stored; a rule's
candidates are the documents whose postings hold all trigrams of one alternative. Candidates are verified with the
rule itself. Rules without mandatory trigrams are evaluated on every document.

Defined results: a NULL text counts as empty; repeated rows each get their row; offsets are code points, end
exclusive; an empty table gives an empty table; columns besides the id and the text are ignored.
"""

from __future__ import annotations

from dataclasses import dataclass
from re import _constants as sre
from re import _parser as sre_parser

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from marketlake.llm.common import running_totals, stored, text_key

MOST_STRINGS = 32  # literal strings followed side by side; beyond that the query only gets weaker
MOST_CLAUSES = 64
MOST_GRAMS = 62  # trigrams asked for in one alternative; they are kept as bits of a long
TRUE = frozenset([frozenset()])


@dataclass(frozen=True)
class Rule:
    """``pattern`` must read the same in Java and Python; ``group`` needs at least ``least`` characters."""

    kind: str
    pattern: str
    group: int = 0
    least: int = 1


#: Fixed patterns of the contract. Runs are greedy, so a run that is too short can be left out by the pattern itself.
BASE_RULES = (
    Rule(
        "assign",
        r"""(?i:(password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
        2,
        6,
    ),
    Rule("access", r"AKIA[A-Z0-9]{16,}"),
    Rule("hex", r"[0-9a-f]{24,}"),
)
#: Public token formats.
MORE_RULES = (
    # With its body and its END line, if it has one; header lines of the body may hold single hyphens.
    Rule(
        "private_key",
        r"-----BEGIN [A-Z ]{0,30}PRIVATE KEY-----"
        r"(?:[A-Za-z0-9+/=\s:,._\\]*+(?:-[A-Za-z0-9+/=\s:,._\\]++){0,60}-----END [A-Z ]{0,30}PRIVATE KEY-----)?",
    ),
    Rule("github", r"gh[pousr]_[A-Za-z0-9]{36,}"),
    Rule("github_pat", r"github_pat_[A-Za-z0-9_]{22,}"),
    Rule("slack", r"xox[abprs]-[A-Za-z0-9-]{10,}"),
    Rule("jwt", r"eyJ[A-Za-z0-9_-]{8,}\.eyJ[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}"),
    Rule("google", r"AIza[A-Za-z0-9_-]{35}"),
    Rule("stripe", r"sk_live_[A-Za-z0-9]{24,}"),
    Rule("url_login", r"[a-z]{2,12}://[^/\s:@]++:[^/\s:@]++@"),
)
RULES = BASE_RULES + MORE_RULES


# --- trigram queries -------------------------------------------------------------------------------------------------


def grams_of(text: str) -> frozenset:
    return frozenset(text[i : i + 3] for i in range(len(text) - 2))


def any_of(queries) -> frozenset:
    """OR; an alternative that contains another one is redundant."""
    found = frozenset(queries)
    return frozenset(q for q in found if not any(other < q for other in found))


def both(left: frozenset, right: frozenset) -> frozenset:
    """AND. If it had too many alternatives, one side alone is a weaker but still safe query."""
    if len(left) * len(right) > MOST_CLAUSES:
        return right if left == TRUE else left
    return any_of(a | b for a in left for b in right)


def of_strings(strings) -> frozenset:
    return any_of(grams_of(s) for s in strings)


def small_class(items) -> set | None:
    chars: set[str] = set()
    for op, arg in items:
        if op is sre.LITERAL:
            chars.add(chr(arg).lower())
        elif op is sre.RANGE and arg[1] - arg[0] < MOST_STRINGS:
            chars |= {chr(c).lower() for c in range(arg[0], arg[1] + 1)}
        else:
            return None
    return chars if len(chars) <= 8 and all(c.isascii() for c in chars) else None


def of_node(op, arg) -> tuple[set | None, frozenset]:
    """The exact lower-case strings a node stands for (None: unknown) and what a match needs besides them."""
    if op is sre.LITERAL:
        return ({chr(arg).lower()}, TRUE) if arg < 128 else (None, TRUE)
    if op is sre.IN:
        return small_class(arg), TRUE
    if op is sre.AT or op is sre.ASSERT or op is sre.ASSERT_NOT:
        return {""}, TRUE
    if op is sre.SUBPATTERN:
        return of_sequence(arg[-1])
    if op is sre.BRANCH:
        parts = [of_sequence(branch) for branch in arg[1]]
        strings = None if any(s is None for s, _ in parts) else set().union(*(s for s, _ in parts))
        if strings is not None and len(strings) <= MOST_STRINGS:
            return strings, TRUE
        return None, any_of(q for s, need in parts for q in both(need, TRUE if s is None else of_strings(s)))
    if op in (sre.MAX_REPEAT, sre.MIN_REPEAT, sre.POSSESSIVE_REPEAT):
        low, high, inner = arg
        strings, need = of_sequence(inner)
        if (low, high) == (0, 1) and strings is not None:
            return strings | {""}, TRUE
        if low == 0:
            return None, TRUE
        if low == high == 1:
            return strings, need
        return None, both(need, TRUE if strings is None else of_strings(strings))
    return None, TRUE


def of_sequence(nodes) -> tuple[set | None, frozenset]:
    strings, need, whole = {""}, TRUE, True
    for op, arg in nodes:
        more, also = of_node(op, arg)
        if more is not None and len(strings) * len(more) <= MOST_STRINGS:
            strings = {a + b for a in strings for b in more}
            continue
        need, whole = both(both(need, of_strings(strings)), also), False
        strings = {""} if more is None else more
    return (strings, need) if whole else (None, both(need, of_strings(strings)))


def trigram_query(pattern: str) -> list[frozenset]:
    """Alternatives of lower-case trigram sets, one of which every match contains; empty if there is no such query."""
    strings, need = of_sequence(sre_parser.parse(pattern))
    query = need if strings is None else both(need, of_strings(strings))
    return [] if frozenset() in query else sorted((frozenset(sorted(q)[:MOST_GRAMS]) for q in query), key=sorted)


# --- index and scan --------------------------------------------------------------------------------------------------


def trigram_postings(docs: DataFrame, key: str, text: str, grams: list[str]) -> DataFrame:
    """The inverted index: (gram, key) for each of ``grams`` in the lower-cased text."""
    low = docs.select(F.col(key).alias("key"), F.lower(F.col(text)).alias("low"))
    held = F.array_compact(F.array(*[F.when(F.contains("low", F.lit(g)), F.lit(g)) for g in grams]))
    return low.select("key", F.explode(held).alias("gram"))


def candidates(postings: DataFrame, queries: dict[str, list[frozenset]]) -> DataFrame:
    """(key, kinds): the rules whose trigram query the postings of a document fulfil.

    The join table has one row for each trigram of each alternative: its size is that of the rule set.
    """
    spark = postings.sparkSession
    wanted = [
        (gram, kind, number, 1 << bit, (1 << len(clause)) - 1)
        for kind, clauses in queries.items()
        for number, clause in enumerate(clauses)
        for bit, gram in enumerate(sorted(clause))
    ]
    schema = "gram string, kind string, clause int, bit bigint, full bigint"
    return (
        postings.join(F.broadcast(spark.createDataFrame(wanted, schema)), "gram")
        .groupBy("key", "kind", "clause", "full")
        .agg(F.bit_or("bit").alias("bits"))
        .where("bits = full")
        .groupBy("key")
        .agg(F.collect_set("kind").alias("kinds"))
    )


def rule_spans(text: Column, rule: Rule, order: int) -> Column:
    """All leftmost non-overlapping matches as (start, order, end, kind)."""
    pattern = F.lit(rule.pattern)
    found = F.regexp_extract_all(text, pattern, F.lit(0))
    picked = F.regexp_extract_all(text, pattern, F.lit(rule.group))
    parts = F.arrays_zip(
        F.transform(F.split(text, rule.pattern, -1), F.length).alias("gap"),
        F.transform(found, F.length).alias("size"),
        F.transform(picked, F.length).alias("least"),
    )
    lengths = F.filter(parts, lambda p: p["size"].isNotNull())
    before = running_totals(F.transform(lengths, lambda p: p["gap"] + p["size"]))
    spans = F.zip_with(
        lengths,
        before,
        lambda p, at: F.struct(
            (at + p["gap"]).alias("start"),
            F.lit(order).alias("order"),
            (at + p["gap"] + p["size"]).alias("end"),
            F.lit(rule.kind).alias("kind"),
            p["least"].alias("least"),
        ),
    )
    return F.transform(
        F.filter(spans, lambda s: s["least"] >= rule.least),
        lambda s: F.struct(s["start"], s["order"], s["end"], s["kind"]),
    )


def find_secrets(docs: DataFrame, id_col: str = "doc_id", text: str = "text", rules=RULES) -> DataFrame:
    """(id, spans) for every row; spans are (start, order, end, kind), sorted by start, then by the rules' order."""
    rows = docs.select(F.col(id_col).alias("id"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    rows = rows.withColumn("key", text_key("id", "text"))
    queries = {r.kind: q for r in rules if (q := trigram_query(r.pattern))}
    grams = sorted(set().union(*(c for q in queries.values() for c in q)))
    kinds = F.array().cast("array<string>")
    if grams:
        postings = stored(trigram_postings(rows, "key", "text", grams), "trigrams")
        rows = rows.join(candidates(postings, queries), "key", "left")
        kinds = F.coalesce("kinds", kinds)
    none = F.array().cast("array<struct<start:int,order:int,end:int,kind:string>>")
    content = F.col("text")
    spans = [
        F.when(
            F.array_contains(kinds, r.kind) if r.kind in queries else content.rlike(r.pattern),
            rule_spans(content, r, order),
        ).otherwise(none)
        for order, r in enumerate(rules)
    ]
    return rows.select(F.col("id").alias(id_col), F.sort_array(F.concat(*spans)).alias("spans"))


def as_text(spans: Column) -> Column:
    """``kind:start:end``, comma-joined."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")


def secret_report(docs: DataFrame) -> DataFrame:
    """Per document: counts of the base kinds, a digest of the base spans, and all spans."""
    found = find_secrets(docs)
    base = F.filter("spans", lambda s: s["order"] < len(BASE_RULES))

    def count(kind: str) -> Column:
        return F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("bigint").alias(f"n_{kind}")

    return found.select(
        "doc_id",
        *[count(r.kind) for r in BASE_RULES],
        F.sha2(as_text(base), 256).alias("base_sha256"),
        as_text(F.col("spans")).alias("spans"),
    )


#: The same scan in SQL, its patterns written out again: (kind, pattern, group, least characters of it). That engine has
#: no possessive runs and folds letters beyond ASCII, so runs are greedy and either case is spelled out.
SQL_RULES = (
    (
        "assign",
        "([Pp][Aa][Ss][Ss][Ww][Oo][Rr][Dd]|[Pp][Aa][Ss][Ss][Ww][Dd]|[Ss][Ee][Cc][Rr][Ee][Tt]|[Tt][Oo][Kk][Ee][Nn]|"
        """[Aa][Pp][Ii]_?[Kk][Ee][Yy])["']?\\x20*[:=]\\x20*["']?([A-Za-z0-9+/_.=-]+)""",
        2,
        6,
    ),
    ("access", "AKIA[A-Z0-9]+", 0, 20),
    ("hex", "[0-9a-f]+", 0, 24),
    (
        "private_key",
        "-----BEGIN [A-Z ]{0,30}PRIVATE KEY-----(?:[A-Za-z0-9+/=\\x09-\\x0D\\x20:,._\\\\]*"
        "(?:-[A-Za-z0-9+/=\\x09-\\x0D\\x20:,._\\\\]+){0,60}-----END [A-Z ]{0,30}PRIVATE KEY-----)?",
        0,
        1,
    ),
    ("github", "gh[pousr]_[A-Za-z0-9]{36,}", 0, 1),
    ("github_pat", "github_pat_[A-Za-z0-9_]{22,}", 0, 1),
    ("slack", "xox[abprs]-[A-Za-z0-9-]{10,}", 0, 1),
    ("jwt", "eyJ[A-Za-z0-9_-]{8,}\\.eyJ[A-Za-z0-9_-]{8,}\\.[A-Za-z0-9_-]{8,}", 0, 1),
    ("google", "AIza[A-Za-z0-9_-]{35}", 0, 1),
    ("stripe", "sk_live_[A-Za-z0-9]{24,}", 0, 1),
    ("url_login", "[a-z]{2,12}://[^/\\x09-\\x0D\\x20:@]+:[^/\\x09-\\x0D\\x20:@]+@", 0, 1),
)


def _matches_sql(order: int, kind: str, pattern: str, group: int, least: int) -> str:
    """A match's end is the total length of the texts up to the end of each match so far."""
    quoted = pattern.replace("'", "''")
    return f"""
  SELECT rid, {order} AS ord, '{kind}' AS kind, {least} AS least,
    generate_subscripts(regexp_extract_all(text, '{quoted}'), 1) AS i,
    unnest(regexp_extract_all(text, '(?s).*?(?:{quoted})')) AS upto,
    unnest(regexp_extract_all(text, '{quoted}')) AS found,
    unnest(regexp_extract_all(text, '{quoted}', {group})) AS picked
  FROM d"""


ORACLE = f"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS text, row_number() OVER () AS rid FROM documents),
m AS ({" UNION ALL ".join(_matches_sql(n, *rule) for n, rule in enumerate(SQL_RULES))}),
s AS (
  SELECT *, CAST(sum(length(upto)) OVER (PARTITION BY rid, ord ORDER BY i) AS BIGINT) AS stop FROM m),
p AS (
  SELECT rid, ord, kind, stop - length(found) AS start, kind || ':' || (stop - length(found)) || ':' || stop AS span
  FROM s WHERE length(picked) >= least)
SELECT any_value(doc_id) AS doc_id,
  count(*) FILTER (WHERE kind = 'assign') AS n_assign,
  count(*) FILTER (WHERE kind = 'access') AS n_access,
  count(*) FILTER (WHERE kind = 'hex') AS n_hex,
  sha256(coalesce(string_agg(span, ',' ORDER BY start, ord) FILTER (WHERE ord < 3), '')) AS base_sha256,
  coalesce(string_agg(span, ',' ORDER BY start, ord), '') AS spans
FROM d LEFT JOIN p USING (rid) GROUP BY rid
"""
