"""Functions of tables for SQL text: parentheticals of an article, and a majority vote in two steps.

    select p.* from articles a, lateral parentheticals(a.fako, a.senci, a.noti) p
    select * from vote_final(table(select * from vote_partial(table(select key, value from votes))) partition by key)

vote_partial runs over what rows a task has and gives one row a key and value of theirs; vote_final has a key's rows in one partition, which are then as
many as its values in the tasks, not as its votes.
"""

from __future__ import annotations

import re

from pyspark.sql import SparkSession
from pyspark.sql.functions import udtf
from pyspark.sql.types import Row

#: Keys and values that a task counts before it hands them on.
MOST_HELD = 100_000


class Parentheticals:
    """(sense, text) for every parenthetical of an article: of its head and its remarks with sense 0, of its senses with their number from one."""

    def eval(self, fako: str, senci: list, noti: list):
        if fako is not None:
            yield 0, fako
        for i, sense in enumerate(senci or []):
            for found in re.findall(r"\(([^()]+)\)", sense or ""):
                yield i + 1, found
        for note in noti or []:
            for found in re.findall(r"\(([^()]+)\)", note or ""):
                yield 0, found


class VotePartial:
    """(key, value, n) from rows (key, value): counts of what this task has seen."""

    def __init__(self) -> None:
        self.counts: dict = {}

    def eval(self, row: Row):
        pair = row[0], row[1]
        self.counts[pair] = self.counts.get(pair, 0) + 1
        if len(self.counts) > MOST_HELD:
            yield from self.terminate()

    def terminate(self):
        counts, self.counts = self.counts, {}
        for (key, value), n in counts.items():
            yield key, value, n


class VoteFinal:
    """(key, value, votes, total) from rows (key, value, n) of one key: the most frequent value, ties to the smaller; null values have no vote."""

    def __init__(self) -> None:
        self.key, self.counts = None, {}

    def eval(self, row: Row):
        self.key = row[0]
        if row[1] is not None:
            self.counts[row[1]] = self.counts.get(row[1], 0) + row[2]

    def terminate(self):
        if self.counts:
            value, n = min(self.counts.items(), key=lambda x: (-x[1], x[0]))
            yield self.key, value, n, sum(self.counts.values())


def register(spark: SparkSession) -> None:
    """Make the functions known to SQL text of the session."""
    spark.udtf.register("parentheticals", udtf(Parentheticals, returnType="sense int, text string"))
    spark.udtf.register("vote_partial", udtf(VotePartial, returnType="key string, value string, n long"))
    spark.udtf.register("vote_final", udtf(VoteFinal, returnType="key string, value string, votes long, total long"))
