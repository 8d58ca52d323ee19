"""Ranked fuzzy search: one scan, one projection, top rows by rank."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def rank_of(forms: Column, body: Column, query: str) -> Column:
    """0 equal, 1 prefix, 2 contained, 3 and 4 within that many edits (query of 4 characters or more), 5 in the body, else null; 0 for all if the query is empty."""
    q = query.strip().lower()
    if not q:
        return F.lit(0)

    def one(f: Column) -> Column:
        r = F.when(f == q, 0).when(f.startswith(q), 1).when(f.contains(q), 2)
        if len(q) >= 4:  # the length bound spares most distances
            near = F.abs(F.length(f) - len(q)) <= 2
            for k in (1, 2):
                r = r.when(near & F.levenshtein(f, F.lit(q), k).between(0, k), 2 + k)
        return r

    best = F.array_min(F.filter(F.transform(forms, one), lambda r: r.isNotNull()))
    return F.coalesce(best, F.when(F.lower(body).contains(q), 5)).cast("int")


def search(df: DataFrame, query: str, forms: Column, body: Column, order: list[str], limit: int | None = 400, collation: str | None = None) -> DataFrame:
    """Rows of df that match, with rank, in order of rank and then the order columns; the first limit of them. collation: the rules by which strings are
    compared there, such as UNICODE for those of dictionaries; None: their bytes."""
    hits = df.withColumn("rank", rank_of(forms, body, query)).where("rank is not null")
    if collation:
        kinds = dict(df.dtypes)
        order = [F.collate(F.col(c), collation) if kinds[c] == "string" else F.col(c) for c in order]
    return hits.orderBy("rank", *order).limit(limit) if limit else hits
