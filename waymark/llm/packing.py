"""Token counts of texts, and texts packed into sequences of a fixed number of tokens.

Lengths, not texts, are planned: the histogram of lengths has at most ``capacity`` rows however many documents there are.
Patterns of up to three lengths that fill a sequence exactly are fitted to it by non-negative least squares; the rounded
repeat counts use up most of the histogram, and best fit on what is left packs the residuals.
"""

from __future__ import annotations

import base64
import math
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..runtime import Stored, broadcast_if_small

CAPACITY = 1024
TOKENIZER = "/opt/tokenizers/byte_bpe_50k.tiktoken"
ITEMS_PER_BUCKET = 200_000
#: Patterns of three lengths that are fitted at most, and rows of a plan up to which it is broadcast (some 40 bytes each).
PATTERNS, BROADCAST_ROWS = 400_000, 500_000
# Fixed value: the pre-tokenisation pattern that belongs to the byte-level vocabularies.
PATTERN = r"""'(?:[sdmt]|ll|ve|re)| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""


@lru_cache(maxsize=2)
def load_tokenizer(path: str):
    """A function from a text to its number of tokens; the kind follows from the file's ending."""
    if path.endswith(".tiktoken"):
        import tiktoken

        with open(path, "rb") as f:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
        encode = tiktoken.Encoding("own", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={}).encode_ordinary
        return lambda text: len(encode(text))
    if path.endswith(".model"):
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=path)
        return lambda text: len(model.encode(text))
    from tokenizers import Tokenizer

    model = Tokenizer.from_file(path)
    model.encode_special_tokens = True
    return lambda text: len(model.encode(text, add_special_tokens=False).ids)


def token_counts(documents: DataFrame, key: str, text: str, tokenizer: str = TOKENIZER) -> DataFrame:
    """``(key, n_tokens)`` for every row; null text counts 0. ``tokenizer`` is a path that all executors can read."""
    slim = documents.select(F.col(key), F.col(text).alias("_t"))
    schema = f"`{key}` {documents.schema[key].dataType.simpleString()}, n_tokens bigint"

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        length = load_tokenizer(tokenizer)
        for batch in batches:
            yield pd.DataFrame({key: batch[key], "n_tokens": [length(t) if t else 0 for t in batch["_t"]]})

    return slim.mapInPandas(count, schema)


def patterns(capacity: int, lengths: np.ndarray, most: int = PATTERNS) -> np.ndarray:
    """Multisets of up to three present lengths that sum to ``capacity``: rows of three indices, 0 for none, greatest first.

    All of one and two lengths, and all of three while these are ``most`` at most; beyond that those that begin with every
    so many-th length, so that about ``most`` remain and memory on the driver is bounded at any capacity.
    What patterns leave over is packed by ``best_fit``; nothing depends on them but the fit.
    """
    present = np.zeros(capacity + 1, dtype=bool)
    present[lengths] = True
    present[0] = False
    own = np.flatnonzero(present)
    some = own[present[capacity - own] & (2 * own >= capacity) & (own < capacity)]
    two = np.stack([some, capacity - some, 0 * some], axis=1)
    one = np.array([[capacity, 0, 0]])[: int(present[capacity])]
    step = max(1, math.ceil(len(own) ** 2 / (12 * most)))
    three = [np.zeros((0, 3), dtype=np.int64)]
    for a in own[::-1][::step]:
        b = own[: np.searchsorted(own, min(a, capacity - a - 1), side="right")]
        c = capacity - a - b
        b = b[(c >= 1) & (c <= b)]
        b = b[present[capacity - a - b]]
        three.append(np.stack([np.full_like(b, a), b, capacity - a - b], axis=1))
    return np.concatenate([one, two, *three]).astype(np.int64)


def fit_counts(table: np.ndarray, histogram: np.ndarray, steps: int = 400) -> np.ndarray:
    """Non-negative least squares of pattern repeats against the histogram by accelerated projected gradient.

    Short lengths, which fill gaps easily, weigh less.
    """
    if not len(table):
        return np.zeros(0)
    size = len(histogram)
    scale = max(1.0, float(histogram.max()))
    want = histogram / scale
    weight = np.linspace(0.1, 1.0, size)
    weight[0] = 0.0

    def spread(x: np.ndarray) -> np.ndarray:
        return sum(np.bincount(table[:, k], weights=x, minlength=size) for k in range(3))

    def gather(r: np.ndarray) -> np.ndarray:
        r = r * weight
        return r[table[:, 0]] + r[table[:, 1]] + r[table[:, 2]]

    v = np.ones(len(table))
    for _ in range(20):
        v = gather(spread(v))
        top = np.linalg.norm(v)
        v /= top
    x = y = np.zeros(len(table))
    t = 1.0
    for _ in range(steps):
        z = np.maximum(0.0, y - gather(spread(y) - want) / (1.05 * top))
        s = (1 + math.sqrt(1 + 4 * t * t)) / 2
        x, y, t = z, z + (t - 1) / s * (z - x), s
    return x * scale


def pack_histogram(histogram: np.ndarray) -> list[tuple[tuple[int, ...], int]]:
    """``(lengths, repeats)`` that use up ``histogram`` (index: length) exactly; no pattern exceeds the capacity."""
    capacity = len(histogram) - 1
    left = histogram.astype(np.int64).copy()
    left[0] = 0
    plan: list[tuple[tuple[int, ...], int]] = []
    if left[capacity]:
        plan.append(((capacity,), int(left[capacity])))
        left[capacity] = 0
    table = patterns(capacity, np.flatnonzero(left))
    wish = fit_counts(table, left.astype(float))
    # Each used pattern gets its rounded share at most, as far as every one of its lengths is still there.
    for k in np.argsort(-wish, kind="stable"):
        n = int(round(wish[k]))
        if n < 1:
            break
        lengths = tuple(int(x) for x in table[k] if x)
        for x in set(lengths):
            n = min(n, int(left[x]) // lengths.count(x))
        if n > 0:
            for x in lengths:
                left[x] -= n
            plan.append((lengths, n))
    return plan + best_fit(left)


def best_fit(histogram: np.ndarray) -> list[tuple[tuple[int, ...], int]]:
    """Best fit decreasing on whole classes of equal containers and equal lengths."""
    capacity = len(histogram) - 1
    open_by_space: list[dict[tuple[int, ...], int]] = [{} for _ in range(capacity + 1)]
    spaces: set[int] = set()

    def add(lengths: tuple[int, ...], n: int) -> None:
        space = capacity - sum(lengths)
        open_by_space[space][lengths] = open_by_space[space].get(lengths, 0) + n
        spaces.add(space)

    for x in range(capacity, 0, -1):
        c = int(histogram[x])
        while c:
            space = min((s for s in spaces if s >= x), default=None)
            if space is None:
                per = capacity // x
                if c >= per:
                    add((x,) * per, c // per)
                if c % per:
                    add((x,) * (c % per), 1)
                break
            lengths, n = next(iter(open_by_space[space].items()))
            fits = min(space // x, c)
            used = min(n, c // fits)
            if used < n:
                open_by_space[space][lengths] = n - used
            else:
                del open_by_space[space][lengths]
                if not open_by_space[space]:
                    spaces.discard(space)
            add(lengths + (x,) * fits, used)
            c -= fits * used
    return [(lengths, n) for group in open_by_space for lengths, n in sorted(group.items())]


def pack_texts(counts: DataFrame, key: str, capacity: int = CAPACITY) -> DataFrame:
    """``(sequence, position, key, piece, start, n_tokens)`` from ``(key, n_tokens)`` rows.

    Tokens ``start`` to ``start + n_tokens`` of the text stand at ``position`` of the sequence. A text of at most ``capacity``
    tokens is one piece; a longer one is cut into full sequences and a rest, which is packed like a text.

    * Texts without tokens (empty, null or negative counts) appear once, with a null sequence and no tokens.
    * Repeated rows are packed as often as they occur; equal lengths are told apart by key, then piece, so the plan and the
      sequences' fill do not depend on partitions. Null keys are packed like others. Empty input, empty result.

    The driver sees the histogram alone (``capacity`` rows at most) and makes a plan of a few rows a length. Ranks within a
    length are counted in hashed buckets, and plan and ranks are joined on length and run of ``ITEMS_PER_BUCKET`` ranks, so a
    length that a third of all texts share is never one task. A plan of up to ``BROADCAST_ROWS`` rows is broadcast.
    """
    if capacity < 1:
        raise ValueError("capacity must be positive")
    c = F.lit(capacity)
    n = F.greatest(F.coalesce(F.col("n_tokens"), F.lit(0)), F.lit(0)).cast("bigint")
    base = counts.select(F.col(key).alias("_key"), n.alias("_n"))
    pieces = base.where("_n > 0").select("_key", "_n", F.explode(F.sequence(F.lit(0), ((F.col("_n") - 1) / c).cast("int"))).alias("_piece"))
    pieces = pieces.select("_key", "_piece", F.least(c, F.col("_n") - F.col("_piece") * c).cast("int").alias("_len"))
    histogram = np.zeros(capacity + 1, dtype=np.int64)
    for row in pieces.groupBy("_len").count().collect():
        histogram[row[0]] = row[1]
    slots, first_rank, sequence = [], np.zeros(capacity + 1, dtype=np.int64), 0
    for lengths, repeats in pack_histogram(histogram):
        position = 0
        for x in lengths:
            start = int(first_rank[x])
            slots.append((x, start, start + repeats, sequence - start, position))
            first_rank[x] += repeats
            position += x
        sequence += repeats
    spark = counts.sparkSession
    plan = spark.createDataFrame(slots, "_l int, _from bigint, _to bigint, _shift bigint, position int")
    run = lambda c: F.floor(c / F.lit(ITEMS_PER_BUCKET)).cast("bigint")
    plan = plan.withColumn("_run", F.explode(F.sequence(run(F.col("_from")), run(F.col("_to") - 1))))
    buckets = max(1, int(histogram.sum()) // ITEMS_PER_BUCKET)
    pieces = pieces.withColumn("_bucket", F.pmod(F.xxhash64("_key", "_piece"), F.lit(buckets)).cast("int"))
    before = Window.partitionBy("_l").orderBy("_b").rowsBetween(Window.unboundedPreceding, -1)
    sizes = pieces.groupBy(F.col("_len").alias("_l"), F.col("_bucket").alias("_b")).agg(F.count("*").alias("_n"))
    offsets = sizes.select(F.col("_l").alias("_ol"), F.col("_b").alias("_ob"), F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_offset"))
    own = Window.partitionBy("_len", "_bucket").orderBy("_key", "_piece")
    ranked = pieces.withColumn("_r", F.row_number().over(own) - 1)
    if buckets > 1:
        ranked = ranked.join(broadcast_if_small(offsets), (F.col("_len") == F.col("_ol")) & (F.col("_bucket") == F.col("_ob"))).withColumn("_r", F.col("_r") + F.col("_offset"))
    n_plan = len(slots) + int(histogram.sum()) // ITEMS_PER_BUCKET
    on = (F.col("_len") == F.col("_l")) & (run(F.col("_r")) == F.col("_run")) & (F.col("_r") >= F.col("_from")) & (F.col("_r") < F.col("_to"))
    placed = ranked.join(F.broadcast(plan) if n_plan <= BROADCAST_ROWS else plan, on)
    out = placed.select((F.col("_r") + F.col("_shift")).alias("sequence"), "position", F.col("_key").alias(key), F.col("_piece").alias("piece"), (F.col("_piece").cast("bigint") * c).alias("start"), F.col("_len").alias("n_tokens"))
    nothing = base.where("_n = 0").select(F.lit(None).cast("bigint").alias("sequence"), F.lit(None).cast("int").alias("position"), F.col("_key").alias(key), F.lit(0).alias("piece"), F.lit(0).cast("bigint").alias("start"), F.lit(0).alias("n_tokens"))
    return out.unionByName(nothing)


def pack_documents(documents: DataFrame, key: str, text: str, tokenizer: str = TOKENIZER, capacity: int = CAPACITY) -> DataFrame:
    """``pack_texts`` of a table of texts; the token counts are written once, since the plan and the ranks both read them."""
    return pack_texts(Stored(token_counts(documents, key, text, tokenizer), "tokens").df, key, capacity)
