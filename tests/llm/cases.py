"""Small tables that hold the cases every corpus operator has to stand."""

from pathlib import Path

SF = "/root/testdata/sf0.001"
DOCS = "doc_id bigint, text string, lang string, source string, n_chars bigint"


def docs(spark, texts, ids=None, parts=3):
    """A documents table of ``texts``; ids count up unless given."""
    ids = list(range(len(texts))) if ids is None else ids
    rows = [(i, t, "en", "src0", None if t is None else len(t)) for i, t in zip(ids, texts, strict=True)]
    return spark.createDataFrame(rows, DOCS).repartition(parts)


def with_clashes(df):
    """The same table with columns of names that operators use themselves."""
    from pyspark.sql import functions as F

    extra = ("key", "id", "words", "fp", "hash", "gram", "kind", "digest", "at", "component_id", "n", "spans")
    return df.withColumns({name: F.lit("x") for name in extra if name not in df.columns})


def write(df, folder, name):
    df.write.mode("overwrite").parquet(str(Path(folder) / f"{name}.parquet"))


def by_id(df, key="doc_id"):
    """Rows as dicts by id, in a list for each id."""
    out = {}
    for row in df.collect():
        out.setdefault(row[key], []).append(row.asDict())
    return out
