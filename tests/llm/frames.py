"""Small tables with every awkward case, and plain versions of what several tests need."""

SCHEMA = (
    "doc_id bigint, text string, source string, id bigint, row string, n int, size string, kept string, "
    "weight string, copies int, chunk string, text_hash string, target double, `a.b` string, TAKEN int"
)
SF = "/root/testdata/sf0.001"


def awkward(spark, texts, ids=None, sources=None, parts=3):
    """Documents with columns whose names clash with those the operators use inside."""
    ids = list(range(len(texts))) if ids is None else ids
    sources = sources or ["s"] * len(texts)
    rows = [
        (i, t, s, -1, "r", 1, "x", "no", "heavy", 9, "c", "h", 0.5, "dot", 7)
        for i, t, s in zip(ids, texts, sources, strict=True)
    ]
    return spark.createDataFrame(rows, SCHEMA).repartition(parts)


def by_id(df, *columns):
    """Rows as a list of (id, columns), NULL ids first."""
    rows = [tuple(r[c] for c in ("doc_id", *columns)) for r in df.collect()]
    return sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, str(r[1:])))
