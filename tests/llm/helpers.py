"""What the tests of the corpus operators share."""

from pyspark.sql import functions as F


def clashing(df):
    """The table with more columns, whose names differ from its own only in case or not at all."""
    extra = [F.lit(i).alias(f"x{i}") for i in range(len(df.columns) + 1)]
    names = [*df.columns, *[c.upper() for c in df.columns], df.columns[0]]
    return df.select("*", *extra).toDF(*names)


def documents(spark, rows):
    """Documents of (doc_id, text) or (doc_id, text, source)."""
    full = [(r[0], r[1], "en", r[2] if len(r) > 2 else "s", 0) for r in rows]
    return spark.createDataFrame(full, "doc_id long, text string, lang string, source string, n_chars long")


class Sets:
    """Union-find, the plain way."""

    def __init__(self):
        self.parent = {}

    def root(self, x):
        while self.parent.setdefault(x, x) != x:
            x = self.parent[x]
        return x

    def join(self, a, b):
        a, b = self.root(a), self.root(b)
        self.parent[max(a, b)] = min(a, b)
