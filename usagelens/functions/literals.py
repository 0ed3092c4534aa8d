"""Exact strings of a large registry, found in one pass over each text by an automaton whose failure links are built once a task."""

from __future__ import annotations

import pickle
import re
from collections.abc import Iterable, Iterator

import ahocorasick
import pandas as pd
from pyspark.sql import Column, SparkSession
from pyspark.sql import functions as F

from ..session import small_batches

#: Bytes of a registry's strings that are sent to tasks at most.
MOST_BYTES = 64 << 20
_BEFORE, _AFTER = re.compile("[a-z0-9_]"), re.compile("[a-z0-9]")


class Literals:
    """All strings of a registry that a text holds, overlapping ones too, without regard to case. `whole`: with no letter, digit or _ before and no letter or digit behind."""

    def __init__(self, values: Iterable[str], whole: bool = False) -> None:
        self.whole = whole
        self.automaton = ahocorasick.Automaton()
        for v in {v.lower() for v in values if v}:
            self.automaton.add_word(v, v)
        self.some = len(self.automaton) > 0
        if self.some:
            self.automaton.make_automaton()

    def found(self, text: str) -> set[str]:
        out: set[str] = set()
        if not self.some:
            return out
        low = text.lower()
        for end, v in self.automaton.iter(low):
            if v not in out and (not self.whole or self._apart(low, end - len(v), end + 1)):
                out.add(v)
        return out

    @staticmethod
    def _apart(low: str, before: int, after: int) -> bool:
        return (before < 0 or not _BEFORE.match(low[before])) and (after >= len(low) or not _AFTER.match(low[after]))


def literals_in(x: Column, values: Iterable[str], whole: bool = False) -> Column:
    """Which of the strings occur in a text: distinct, sorted, lower case; overlapping ones too. NULL for NULL; an empty string is never found.

    The registry goes to the executors once, as a broadcast of at most MOST_BYTES; each task builds the automaton once.
    """
    low = sorted({v.lower() for v in values if v})
    if sum(len(v.encode()) for v in low) > MOST_BYTES:
        raise ValueError(f"a registry of more than {MOST_BYTES} bytes isn't sent to tasks: part it, and unite what the parts find")
    spark = SparkSession.active()
    small_batches(spark)
    sent = spark.sparkContext.broadcast(pickle.dumps(low))

    @F.pandas_udf("array<string>")
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        own = Literals(pickle.loads(sent.value), whole)
        for s in batches:
            yield s.map(lambda t: None if t is None else sorted(own.found(t)))

    return run(x)
