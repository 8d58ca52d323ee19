"""Records cut from lines of pages as they arrive, in any order and over any number of batches.

A page's lines are held in state until its time is over: a timer stands wait behind the latest line, and when the watermark has passed it, the page is cut as the
batch cut does and its state goes. A line that comes after that is handed on as late, with what it says, and changes nothing. State is bounded by
the lines of open pages.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

from pyspark.sql import DataFrame, Row
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from ..operators.records import HEAD

LINE = "k int, text string, first boolean"
OUT = "page int, kind string, line int, text string"


def cut_page(lines: list[tuple[int, str, bool]]) -> tuple[str, list[tuple[int, str]]]:
    """The text above the first record, and the records (line, text) of a page's lines (number, text, underlined from its first cell)."""
    above: list[str] = []
    records: list[tuple[int, list[str]]] = []
    blank = True
    for k, text, first in sorted(lines, key=lambda x: x[0]):
        said = (text or "").strip(" ")
        if first or (blank and re.match(HEAD, text or "") and not re.match("[A-Z]{2}", text or "")):
            records.append((k, []))
        blank = said == ""
        if said:
            (records[-1][1] if records else above).append((k, said))

    def joined(parts: list) -> str:
        return re.sub(r"\s+", " ", re.sub(r"([a-zà-ÿ])-\n([a-zà-ÿ])", r"\1\2", "\n".join(t for _, t in parts)))

    return joined(above), [(parts[0][0], joined(parts)) for _, parts in records if parts]


class Cutter(StatefulProcessor):
    def __init__(self, wait_ms: int) -> None:
        self.wait = wait_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.lines = handle.getListState("lines", LINE)
        self.due = handle.getValueState("due", "at long")
        self.closed = handle.getValueState("closed", "at long")

    def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:
        new, late, latest = [], [], 0
        over = self.closed.exists()
        for r in rows:
            if over:
                late.append(Row(page=key[0], kind="late", line=r.k, text=r.text))
            else:
                new.append((r.k, r.text, r.first))
                latest = max(latest, int(r.ms))
        if new:
            self.lines.appendList(new)
            before = self.due.get()[0] if self.due.exists() else None
            due = latest + self.wait
            if before is None or due > before:
                if before is not None:
                    self.handle.deleteTimer(before)
                self.handle.registerTimer(due)
                self.due.update((due,))
        yield from late

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:
        above, records = cut_page([(r[0], r[1], r[2]) for r in self.lines.get()])
        self.lines.clear()
        self.due.clear()
        self.closed.update((expiredTimerInfo.getExpiryTimeInMs(),))
        if above:
            yield Row(page=key[0], kind="orphan", line=None, text=above)
        for line, text in records:
            yield Row(page=key[0], kind="record", line=line, text=text)

    def close(self) -> None:
        pass


def cut_stream(lines: DataFrame, time: str, wait: str = "10 minutes", late: str = "10 minutes") -> DataFrame:
    """(page, kind, line, text) from a stream of lines (page, k, text, underlines) with an event time: kind is record, orphan (text above a page's first record, for
    records.adopt) or late. The session's state store must be the one of RocksDB."""
    amount, unit = wait.split()
    ms = int(amount) * {"second": 1000, "minute": 60_000, "hour": 3_600_000, "day": 86_400_000}[unit.rstrip("s")]
    first = F.coalesce(F.exists("underlines", lambda u: u["a"] == 0), F.lit(False))
    rows = lines.withWatermark(time, late).select("page", "k", "text", first.alias("first"), F.unix_millis(time).alias("ms"), time)
    return rows.groupBy("page").transformWithState(Cutter(ms), OUT, "append", "eventTime")
