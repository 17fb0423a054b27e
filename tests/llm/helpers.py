"""Small frames for the operators' edge cases."""

import os

SF = "/root/testdata/sf0.001"
DOCS = "doc_id long, text string, lang string, source string, n_chars long"


def documents(spark, texts, sources=None):
    """Documents with ids 0.. and the given texts (null allowed), plus columns whose names clash with internals."""
    rows = [(i, t, "en", (sources or ["s"] * len(texts))[i], len(t or "")) for i, t in enumerate(texts)]
    df = spark.createDataFrame(rows, DOCS)
    extra = ("key", "sig", "n", "size", "packed", "score", "p", "u", "copies", "found", "block", "node", "label", "keep", "part")
    for name in extra:
        df = df.selectExpr("*", f"'x' as `{name}`")
    return df.selectExpr("*", "1 as `odd.name`")


def no_documents(spark):
    return documents(spark, ["x"]).limit(0)


def table(spark, name):
    return spark.read.parquet(os.path.join(SF, f"{name}.parquet"))


def words(r, n, vocabulary=2000):
    return " ".join(f"w{r.randrange(vocabulary)}" for _ in range(n))
