"""A stoplist of patterns: topics that equal, start with, end with or contain a phrase.

All phrases become one automaton (a trie whose nodes know the longest suffix that is a
path of the trie too), so a topic is read once however many thousand phrases there are.  It is run
over the distinct topics of the counts, not over mentions, and the topics it finds are
anti-joined.  A phrase is wrapped in marks of the topic's start and end, so all four
kinds are phrases of one trie.

A stoplist of any size works: phrases ship in blocks of bounded size, one pass over the
distinct topics each.  Null and empty phrases match nothing; null topics are kept.
"""

from __future__ import annotations

import math
import uuid
from collections import deque
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from mentionlab.operators.topk import DEFAULT_K, mention_counts, rank_topics
from mentionlab.plans.ranking import stable

KINDS = ("equals", "prefix", "suffix", "contains")
START, END = "\x02", "\x03"
BLOCK_PHRASES, BLOCK_CHARS = 200_000, 4_000_000


class Automaton:
    """Whether a text contains one of many phrases, in one pass over its characters."""

    def __init__(self, phrases: Iterable[str]):
        self.steps: list[dict[str, int]] = [{}]
        self.final = [False]
        for phrase in sorted(set(phrases), key=len):
            self._add(phrase)
        self.back = [0] * len(self.steps)
        self._link()

    def _add(self, phrase: str) -> None:
        node = 0
        for ch in phrase:
            if self.final[node]:  # a shorter phrase matches wherever this one would
                return
            if ch not in self.steps[node]:
                self.steps[node][ch] = len(self.steps)
                self.steps.append({})
                self.final.append(False)
            node = self.steps[node][ch]
        self.final[node] = node > 0

    def _link(self) -> None:
        todo = deque(self.steps[0].values())
        while todo:
            node = todo.popleft()
            for ch, child in self.steps[node].items():
                suffix = self.back[node]
                while suffix and ch not in self.steps[suffix]:
                    suffix = self.back[suffix]
                self.back[child] = self.steps[suffix].get(ch, 0)
                self.final[child] = self.final[child] or self.final[self.back[child]]
                todo.append(child)

    def found_in(self, text: str) -> bool:
        node = 0
        for ch in text:
            while node and ch not in self.steps[node]:
                node = self.back[node]
            node = self.steps[node].get(ch, 0)
            if self.final[node]:
                return True
        return False


_built: dict[str, Automaton] = {}


def _automaton(shipped) -> Automaton:
    """Built once per Python worker and block."""
    if shipped.id not in _built:
        _built.clear()
        _built[shipped.id] = Automaton(shipped.value)
    return _built[shipped.id]


class _Shipped:
    def __init__(self, broadcast):
        # an address comes again when an earlier broadcast is gone, a worker's automaton stays
        self.broadcast, self.id = broadcast, uuid.uuid4().hex

    @property
    def value(self) -> list[str]:
        return self.broadcast.value


def _wrapped(patterns: DataFrame, ignore_case: bool) -> DataFrame:
    phrase = F.lower("pattern") if ignore_case else F.col("pattern")
    begins, ends = F.col("kind").isin("equals", "prefix"), F.col("kind").isin("equals", "suffix")
    return patterns.filter(F.length("pattern") > 0).select(
        F.concat(F.when(begins, START).otherwise(""), phrase, F.when(ends, END).otherwise("")).alias("phrase")).distinct()


def matching_topics(topics: DataFrame, patterns: DataFrame, ignore_case: bool = False, topic_col: str = "topic",
                    block_phrases: int = BLOCK_PHRASES, block_chars: int = BLOCK_CHARS) -> DataFrame:
    """Distinct topics that match a row ``(pattern, kind)`` of ``patterns``, as ``topic``."""
    wrong = patterns.filter(~F.coalesce(F.col("kind").isin(*KINDS), F.lit(False))).select("kind").take(1)
    if wrong:
        raise ValueError(f"unknown kind {wrong[0]['kind']!r}; one of {KINDS}")
    spark = topics.sparkSession
    phrases = stable(_wrapped(patterns, ignore_case))
    size = phrases.agg(F.count(F.lit(1)).alias("n"), F.sum(F.length("phrase")).alias("chars")).first()
    blocks = max(math.ceil(size["n"] / block_phrases), math.ceil((size["chars"] or 0) / block_chars))
    distinct = topics.select(F.col(topic_col).alias("topic")).filter(F.col(topic_col).isNotNull()).distinct()
    if blocks > 1:
        distinct = stable(distinct)
    found = None
    for b in range(blocks):
        mine = phrases.filter(F.pmod(F.xxhash64("phrase"), F.lit(blocks)) == b)
        shipped = _Shipped(spark.sparkContext.broadcast([r["phrase"] for r in mine.toLocalIterator()]))

        def match(batches: Iterator[pa.RecordBatch], shipped=shipped) -> Iterator[pa.RecordBatch]:
            automaton = _automaton(shipped)
            for batch in batches:
                keep = [automaton.found_in(f"{START}{t.lower() if ignore_case else t}{END}")
                        for t in batch.column(0).to_pylist()]
                yield batch.filter(pa.array(keep, pa.bool_()))

        some = distinct.mapInArrow(match, "topic string")
        found = some if found is None else found.unionByName(some)
    if found is None:
        return distinct.filter(F.lit(False))
    return found.distinct() if blocks > 1 else found


def exclude_matching(counts: DataFrame, patterns: DataFrame, ignore_case: bool = False, topic_col: str = "topic") -> DataFrame:
    """``counts`` without the topics that a pattern matches."""
    bad = stable(matching_topics(counts, patterns, ignore_case, topic_col)).withColumnRenamed("topic", "_bad")
    return counts.join(bad, counts[topic_col] == bad["_bad"], "left_anti")


def daily_topk_without_patterns(mentions: DataFrame, patterns: DataFrame, k: int = DEFAULT_K,
                                ignore_case: bool = False) -> DataFrame:
    """T1 over the topics that no pattern of the stoplist matches."""
    counts = stable(mention_counts(mentions))  # read for its topics and for its counts
    return rank_topics(exclude_matching(counts, patterns, ignore_case), k).select("date", "topic", "count", "rank")
