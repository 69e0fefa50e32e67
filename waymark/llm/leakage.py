"""Evaluation items inside documents: multi-pattern search with block shifts over words.

The search runs over words instead of characters. The test strings are all runs of ``window`` words of every item. A table of
two-word blocks says how far the window may move on; where a block ends some test string, the hash of that suffix block picks
a bucket of test strings, the hash of their first block selects those that can be meant, and direct comparison extends each
of them to the longest stretch.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..runtime import Stored
from .text import words

WINDOW = 4
#: Words of items in one search table, about 100 bytes each; more items are searched in several passes.
BLOCK_WORDS = 2_000_000
#: A sentence is stock when this share of the items has it, and at least so many of them.
STOCK_SHARE, STOCK_LEAST = 0.05, 3
_SENTENCE = re.compile(r"(?<=[.?!])\s+")


@dataclass(frozen=True)
class LeakRule:
    """A document leaks an item when it holds ``total`` of its words in order, in stretches of ``stretch`` or more."""

    total: int = 20
    stretch: int = 12


def item_sentences(text: str | None) -> list[tuple[str, ...]]:
    """The sentences of an item as words."""
    return [w for s in _SENTENCE.split(text or "") if (w := tuple(words(s)))]


def item_words(text: str | None, stock: set[tuple[str, ...]]) -> list[str]:
    return [w for s in item_sentences(text) if s not in stock for w in s]


def stock_sentences(items: DataFrame, text: str, share: float = STOCK_SHARE, least: int = STOCK_LEAST) -> set[tuple[str, ...]]:
    """Sentences, as words, that at least ``share`` of all items (and ``least`` of them) have in common.

    Counted over all items by the executors. Few can be that common: their number is bounded by the mean number of sentences
    of an item over ``share``.
    """
    total = items.count()

    def split(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            yield pd.DataFrame({"s": [s for t in batch["t"] for s in {" ".join(x) for x in item_sentences(t)}]}, dtype="object")

    seen = items.select(F.col(text).alias("t")).mapInPandas(split, "s string").groupBy("s").count()
    common = seen.where(F.col("count") >= max(least, share * total)).select("s").collect()
    return {tuple(r["s"].split(" ")) for r in common}


class BlockShiftSearch:
    """Shift table, suffix buckets and items; picklable, built once per block of items."""

    def __init__(self, items: dict[int, list[str]], window: int = WINDOW, rule: LeakRule = LeakRule()):
        self.window, self.rule = window, rule
        self.vocabulary: dict[str, int] = {}
        number = self.vocabulary.setdefault
        self.items = {i: [number(w, len(self.vocabulary) + 1) for w in ws] for i, ws in items.items()}
        self.base = len(self.vocabulary) + 1
        self.shift: dict[int, int] = {}
        self.suffix: dict[int, dict[int, list[tuple[int, int]]]] = {}
        for i, ids in self.items.items():
            for p in range(len(ids) - window + 1):
                run = ids[p : p + window]
                blocks = [run[e - 1] * self.base + run[e] for e in range(1, window)]
                self.suffix.setdefault(blocks[-1], {}).setdefault(blocks[0], []).append((i, p))
                for e, block in enumerate(blocks, 1):
                    if window - 1 - e < self.shift.get(block, window):
                        self.shift[block] = window - 1 - e

    def stretches(self, ids: list[int]) -> dict[int, list[tuple[int, int, int, int, int]]]:
        """By item: (start in item, end in item, words matched, start and end in the document) of the stretches that count."""
        n, m, base, shift, suffix, items = len(ids), self.window, self.base, self.shift, self.suffix, self.items
        least, out, done = self.rule.stretch, {}, {}
        at, far = m - 1, m - 1
        while at < n:
            block = ids[at - 1] * base + ids[at]
            move = shift.get(block, far)
            if move:
                at += move
                continue
            first = at - m + 1
            run = ids[first : at + 1]
            for i, p in suffix[block].get(run[0] * base + run[1], ()):
                diagonal = (i, first - p)
                if done.get(diagonal, -1) >= at:
                    continue
                item, d = items[i], diagonal[1]
                if item[p : p + m] != run:
                    continue
                k, end, hits = p + m, p + m, m
                top = min(len(item), n - d)
                while k < top:
                    if item[k] == ids[k + d]:
                        hits += 1
                        end = k = k + 1
                    elif k + 1 < top and item[k + 1] == ids[k + 1 + d]:
                        k += 1
                    else:
                        break
                low, k, start = max(0, -d), p - 1, p
                while k >= low:
                    if item[k] == ids[k + d]:
                        hits += 1
                        start, k = k, k - 1
                    elif k - 1 >= low and item[k - 1] == ids[k - 1 + d]:
                        k -= 1
                    else:
                        break
                done[diagonal] = end - 1 + d
                if hits >= least:
                    out.setdefault(i, []).append((start, end, hits, start + d, end + d))
            at += 1
        return out

    def leaked(self, text: str | None) -> list[int]:
        """Items that the document leaks under the rule."""
        if not text:
            return []
        get = self.vocabulary.get
        ids = [get(w, 0) for w in words(text)]
        if len(ids) < self.rule.total:
            return []
        found = self.stretches(ids)
        return sorted(i for i, s in found.items() if _chain(s) >= self.rule.total)


def _chain(stretches: list[tuple[int, int, int, int, int]]) -> int:
    """Most words in stretches that follow each other both in the item and in the document."""
    best: list[int] = []
    order = sorted(stretches)
    for k, (s, _, hits, ds, _) in enumerate(order):
        before = [best[q] for q in range(k) if order[q][1] <= s and order[q][4] <= ds]
        best.append(hits + max(before, default=0))
    return max(best, default=0)


def leaked_items(documents: DataFrame, items: DataFrame, doc_key: str, doc_text: str, item_key: str, item_text: str, rule: LeakRule = LeakRule(), window: int = WINDOW, block_words: int = BLOCK_WORDS) -> DataFrame:
    """``(doc_key, item_key)`` for every document that leaks an item under ``rule``.

    Case, accents, punctuation, spacing, markup and invisible characters are folded away first. Sentences that many items
    share (``stock_sentences``, over all items) are no part of an item. Whole documents are searched, in one pass without a
    shuffle; the items are the broadcast side. A search table closes at ``block_words`` words, and each further table is a
    further pass over the documents, so the broadcast is bounded by that and the longest item; the result does not depend on it.

    * Null or empty text, and null keys of items, give no rows; repeated (key, text) rows of either side give one row a pair.
    * Items without ``window`` words after folding cannot be found; an empty table on either side gives an empty result.
    * A replaced word is bridged when its neighbours match. A stretch is found if it has ``window`` words in a row unchanged.
    """
    spark = documents.sparkSession
    rows = Stored(items.select(F.col(item_key).alias("k"), F.col(item_text).alias("t")).where("k is not null and t is not null").distinct(), "items").df
    docs = documents.select(F.col(doc_key).alias("_d"), F.col(doc_text).alias("_t")).where(F.length("_t") > 0)
    kinds = (documents.schema[doc_key].dataType, items.schema[item_key].dataType)
    schema = f"`{doc_key}` {kinds[0].simpleString()}, `{item_key}` {kinds[1].simpleString()}"
    out = spark.createDataFrame([], schema)
    stock = stock_sentences(rows, "t")
    searches: list = []
    keys: list = []
    pending: dict[int, list[str]] = {}
    size = 0

    def close() -> None:
        nonlocal keys, pending, size
        if pending:
            searches.append((spark.sparkContext.broadcast(BlockShiftSearch(pending, window, rule)), keys))
        keys, pending, size = [], {}, 0

    for row in rows.orderBy("k", "t").toLocalIterator():
        held = item_words(row["t"], stock)
        if size and size + len(held) > block_words:
            close()
        if len(held) >= window:
            pending[len(keys)] = held
            keys.append(row["k"])
            size += len(held)
    close()
    for shared, named in searches:

        def search(batches: Iterator[pd.DataFrame], shared=shared, named=named) -> Iterator[pd.DataFrame]:
            finder = shared.value
            for batch in batches:
                pairs = [(d, i) for d, t in zip(batch["_d"].tolist(), batch["_t"].tolist()) for i in finder.leaked(t)]
                yield pd.DataFrame({doc_key: [d for d, _ in pairs], item_key: [named[i] for _, i in pairs]})

        out = out.unionByName(docs.mapInPandas(search, schema))
    return out.where(F.col(doc_key).isNotNull()).distinct()
