"""Target-distribution importance resampling (operator 13).

Documents that look like a target collection are drawn with a higher chance.  Features
of a text are all runs of ``least`` to ``most`` consecutive words, hashed by CRC-32 into
``buckets``.  A bucket's gain is the (scaled, floored) log ratio of its smoothed shares
in the target and in the documents; a document's weight is the floored mean gain of its
features.  A keyed Gumbel number is added, and the highest scores are drawn: a draw
without replacement with chances in proportion to exp(weight / 1000).

Hashing reads each text once, whatever the lengths of the runs: words are joined by one
space and the running CRC is noted at every word's start and end (:func:`prefixes`).
The CRC of any run of words follows from two of these numbers: CRCs are linear over
GF(2), so the prefix before the run, shifted by the run's bytes, cancels
(:func:`run_crcs`).  A shift by any length is a product of shifts by powers of two, each
four table lookups, done for all runs of a block at once.

What is shuffled: ``buckets`` counts a task, and (id, score) of the documents; texts are
read twice and never shuffled.  ``buckets`` counts come to the driver, and as many gains
go to every task: a parameter, not the data, bounds them.  The draw ranks all scores
over range partitions.

Defined cases: null, empty and wordless texts have no features and weight 0.  Texts of
any length are read whole, in blocks.  Repeated rows count and are scored each; equal
scores go by the smaller id, null ids last (their draw number is that of an empty id),
and rows equal in both in any order.  Without target texts all gains come from the
documents alone; an empty table stays empty.  Output columns replace columns of those
names (in any case).
"""

from __future__ import annotations

import math
import zlib
from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField

from loanframe.operators import ranked

from .common import column, ship_package, stored, unused, with_fields
from .words import LETTERS_AND_DIGITS, byte_texts, word_blocks

BUCKETS = 10_000
#: Documents of fewer words are never drawn.
MIN_WORDS = 20
#: Share of the others that is drawn, in percent.
PERCENT = 10
SEED = "2024"

#: The polynomial of CRC-32, lowest power first.
_POLYNOMIAL = 0xEDB88320


@cache
def _byte_step() -> np.ndarray:
    """What a zero byte makes of a register that holds one byte only."""
    table = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        table = np.where(table & 1, (table >> 1) ^ np.uint32(_POLYNOMIAL), table >> 1)
    return table.astype(np.uint32)


def _applied(tables: np.ndarray, crcs: np.ndarray) -> np.ndarray:
    out = tables[0][crcs & 255]
    for i in (1, 2, 3):
        out = out ^ tables[i][(crcs >> np.uint32(8 * i)) & 255]
    return out


@cache
def _shift_tables(power: int) -> np.ndarray:
    """The shift by 2^power zero bytes, as one table for each byte of the register."""
    if power == 0:
        step = _byte_step()
        own = [np.arange(256, dtype=np.uint32) << np.uint32(8 * i) for i in range(4)]
        return np.stack([step[x & 255] ^ (x >> np.uint32(8)) for x in own])
    half = _shift_tables(power - 1)
    return np.stack([_applied(half, half[i]) for i in range(4)])


def shifted(crcs: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Every CRC times x^(8 length): the part of a prefix in the CRC of a text that goes
    on for ``length`` bytes."""
    out = crcs.astype(np.uint32)
    power, left = 0, lengths.astype(np.int64)
    while left.any():
        odd = (left & 1).astype(bool)
        out[odd] = _applied(_shift_tables(power), out[odd])
        left, power = left >> 1, power + 1
    return out


def prefixes(blocks: Iterator[list[bytes]]) -> Iterator[tuple[np.ndarray, ...]]:
    """For blocks of words joined by one space: offset and running CRC at each word's
    start, and at its end."""
    offset, crc, crc32 = 0, 0, zlib.crc32
    for words in blocks:
        if not words:
            continue
        starts, ends = [], []
        for w in words:
            starts.append(crc)
            crc = crc32(w, crc)
            ends.append(crc)
            crc = crc32(b" ", crc)
        sizes = np.fromiter(map(len, words), np.int64, len(words))
        stops = offset + np.cumsum(sizes + 1)
        offset = int(stops[-1])
        yield stops - 1 - sizes, np.array(starts, np.uint32), stops - 1, np.array(ends, np.uint32)


def run_crcs(blocks: Iterator[list[bytes]], least: int, most: int) -> Iterator[np.ndarray]:
    """The CRC-32 of every run of ``least`` to ``most`` words joined by one space."""
    carried: tuple[np.ndarray, ...] | None = None
    for block in prefixes(blocks):
        kept = 0 if carried is None else len(carried[0])
        if kept:
            block = tuple(np.concatenate([a, b]) for a, b in zip(carried, block))
        start, start_crc, end, end_crc = block
        for n in range(least, most + 1):
            # Runs that end in this block: those before were given with the last one.
            first = max(0, kept - n + 1)
            last = len(start) - n + 1
            if last > first:
                stop = slice(first + n - 1, last + n - 1)
                yield end_crc[stop] ^ shifted(start_crc[first:last], end[stop] - start[first:last])
        carried = tuple(x[max(0, len(x) - most + 1) :] for x in block)


def _bucket_counts(df: DataFrame, text: str, buckets: int, least: int, most: int) -> np.ndarray:
    """Features of all texts by bucket."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(buckets, np.int64)
        for _, texts in byte_texts(batches, "text"):
            for t in texts:
                for crcs in run_crcs(word_blocks(t, LETTERS_AND_DIGITS), least, most):
                    total += np.bincount(crcs % buckets, minlength=buckets)
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(total[at])], ["bucket", "n"])

    counted = df.select(column(text).cast("string").alias("text")).mapInArrow(count, "bucket bigint, n bigint")
    sums = counted.groupBy("bucket").agg(F.sum("n").alias("n")).toArrow()
    out = np.zeros(buckets, np.int64)
    out[sums["bucket"].to_numpy()] = sums["n"].to_numpy()
    return out


def gains(docs: np.ndarray, target: np.ndarray) -> np.ndarray:
    """The gain of every bucket, from the counts of both collections."""
    n, all_docs, all_target = len(docs), float(docs.sum()) + len(docs), float(target.sum()) + len(docs)
    ratio = [(float(target[b]) + 1) * all_docs / ((float(docs[b]) + 1) * all_target) for b in range(n)]
    return np.array([math.floor(1000 * math.log(r)) for r in ratio], np.int64)


def fit_gains(
    docs: DataFrame, target: DataFrame, text: str = "text", target_text: str = "text",
    buckets: int = BUCKETS, least: int = 1, most: int = 1,
) -> np.ndarray:
    """Gains of all buckets, from all texts of both tables."""
    if not 1 <= least <= most or buckets < 1:
        raise ValueError("runs of 1 or more words and at least one bucket are needed")
    ship_package(docs.sparkSession)
    return gains(
        _bucket_counts(docs, text, buckets, least, most), _bucket_counts(target, target_text, buckets, least, most)
    )


def weigh(df: DataFrame, gain: np.ndarray, text: str = "text", least: int = 1, most: int = 1) -> DataFrame:
    """``df`` with ``n_words``, ``n_features`` and ``weight``; no shuffle."""
    ship_package(df.sparkSession)
    names = ("n_words", "n_features", "weight")
    schema = with_fields(df, *(StructField(n, LongType()) for n in names))
    sent = df.sparkSession.sparkContext.broadcast(gain)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        gain = sent.value
        for batch, texts in byte_texts(batches, text):
            found = np.zeros((len(texts), 3), np.int64)
            for i, t in enumerate(texts):
                words = features = total = 0

                def counted():
                    nonlocal words
                    for block in word_blocks(t, LETTERS_AND_DIGITS):
                        words += len(block)
                        yield block

                for crcs in run_crcs(counted(), least, most):
                    features += len(crcs)
                    total += int(gain[crcs % len(gain)].sum())
                found[i] = words, features, total // features if features else 0
            keep = [batch.column(i) for i, c in enumerate(batch.schema.names) if c.lower() not in names]
            yield pa.RecordBatch.from_arrays(keep + [pa.array(found[:, k]) for k in range(3)], schema.names)

    return df.mapInArrow(run, schema)


def with_scores(weighed: DataFrame, doc_id: str = "doc_id", seed: str = SEED) -> DataFrame:
    """``weighed`` with ``score``: the weight plus the document's own Gumbel number."""
    mark = F.concat(F.lit(f"{seed}:"), F.coalesce(column(doc_id).cast("string"), F.lit("")))
    h = F.conv(F.substring(F.sha2(mark.cast("binary"), 256), 1, 8), 16, 10).cast("double")
    gumbel = F.floor(F.lit(-1000.0) * F.log(-F.log((h + 0.5) / 4294967296.0)))
    return weighed.withColumn("score", F.col("weight") + gumbel)


def importance_scores(
    docs: DataFrame, gain: np.ndarray, doc_id: str = "doc_id", text: str = "text", least: int = 1, most: int = 1,
    percent: int = PERCENT, min_words: int = MIN_WORDS, seed: str = SEED,
) -> DataFrame:
    """``(doc_id, n_words, n_features, weight, score, rank)`` of every document; ``rank``
    is the place among the drawn, and null on others."""
    rows = weigh(docs.select(column(doc_id).alias("doc_id"), column(text).alias("text")), gain, "text", least, most)
    scores = stored(with_scores(rows.drop("text"), seed=seed), "scores")
    drawn = scores.filter(F.col("n_words") >= min_words).count() * percent // 100
    placed = ranked(
        scores.filter(F.col("n_words") >= min_words), [F.desc("score"), F.asc_nulls_last("doc_id")], name="rank"
    )
    placed = placed.withColumn("rank", F.when(F.col("rank") <= drawn, F.col("rank")))
    short = scores.filter(F.col("n_words") < min_words).withColumn("rank", F.lit(None).cast("bigint"))
    return placed.unionByName(short)


def resample(
    docs: DataFrame, target: DataFrame, doc_id: str = "doc_id", text: str = "text", target_text: str = "text",
    buckets: int = BUCKETS, least: int = 1, most: int = 1,
    percent: int = PERCENT, min_words: int = MIN_WORDS, seed: str = SEED,
) -> DataFrame:
    """The drawn rows of ``docs``, with all their columns and nothing else.

    Texts are not shuffled: the last drawn score and id are the border that a further
    scan compares with.  Rows that repeat the last drawn one's id and score all stay.
    """
    gain = fit_gains(docs, target, text, target_text, buckets, least, most)
    scores = importance_scores(docs, gain, doc_id, text, least, most, percent, min_words, seed)
    last = scores.filter("rank is not null").agg(F.max(F.struct("rank", "score", "doc_id")).alias("last")).first()["last"]
    if last is None:
        return docs.filter(F.lit(False))
    names = {n: unused(docs, n) for n in ("text_", "id_")}
    rows = docs.select(
        F.struct(*[column(c) for c in docs.columns]).alias("row"),
        column(doc_id).alias(names["id_"]),
        column(text).alias(names["text_"]),
    )
    judged = with_scores(weigh(rows, gain, names["text_"], least, most), names["id_"], seed)
    own = F.col(names["id_"])
    # Ids in ascending order, null after all others.
    within = F.lit(True) if last["doc_id"] is None else F.coalesce(own <= F.lit(last["doc_id"]), F.lit(False))
    kept = judged.filter(
        (F.col("n_words") >= min_words)
        & ((F.col("score") > last["score"]) | ((F.col("score") == last["score"]) & within))
    )
    return kept.select(*[F.col("row").getField(c).alias(c) for c in docs.columns])


ORACLE = f"""
WITH crc_table AS (
  SELECT list(v ORDER BY i) AS t FROM (
    SELECT i, list_reduce([i, 0, 0, 0, 0, 0, 0, 0, 0], lambda c, x:
      CASE WHEN c & 1 = 1 THEN xor(c >> 1, {_POLYNOMIAL}) ELSE c >> 1 END) AS v
    FROM (SELECT unnest(range(0, 256)) AS i)
  )
),
words AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS ws
  FROM documents
),
target AS (
  SELECT regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS ws
  FROM benchmark
),
vocabulary AS (SELECT DISTINCT w FROM (SELECT unnest(ws) AS w FROM words UNION ALL SELECT unnest(ws) FROM target)),
spelled AS (
  SELECT w, list_transform(range(0, octet_length(encode(w))),
    lambda i: CAST('0x' || substr(hex(encode(w)), CAST(2 * i + 1 AS INTEGER), 2) AS BIGINT)) AS bytes
  FROM vocabulary
),
hashed AS (
  SELECT w, xor(list_reduce(list_concat([4294967295], bytes), lambda c, b:
    xor(c >> 8, t[CAST((xor(c, b) & 255) + 1 AS INTEGER)])), 4294967295) % {BUCKETS} AS bucket
  FROM spelled, crc_table
),
s AS (SELECT bucket, count(*) AS n FROM (SELECT unnest(ws) AS w FROM words) JOIN hashed USING (w) GROUP BY bucket),
t AS (SELECT bucket, count(*) AS n FROM (SELECT unnest(ws) AS w FROM target) JOIN hashed USING (w) GROUP BY bucket),
gain AS (
  SELECT bucket, CAST(floor(1000 * ln((coalesce(t.n, 0) + 1.0::DOUBLE) * ((SELECT coalesce(sum(n), 0) FROM s) + {BUCKETS})
    / ((coalesce(s.n, 0) + 1.0::DOUBLE) * ((SELECT coalesce(sum(n), 0) FROM t) + {BUCKETS})))) AS BIGINT) AS g
  FROM s FULL JOIN t USING (bucket)
),
totals AS (
  SELECT d.k, CAST(sum(g) AS BIGINT) AS total
  FROM (SELECT k, unnest(ws) AS w FROM (SELECT row_number() OVER () AS k, ws FROM words)) d
  JOIN hashed USING (w) JOIN gain USING (bucket) GROUP BY d.k
),
weighed AS (
  SELECT doc_id, CAST(len(ws) AS BIGINT) AS n_features,
    CASE WHEN len(ws) = 0 THEN 0 ELSE CAST((total - ((total % len(ws)) + len(ws)) % len(ws)) // len(ws) AS BIGINT) END AS weight,
    CAST('0x' || substr(sha256('{SEED}:' || coalesce(CAST(doc_id AS VARCHAR), '')), 1, 8) AS BIGINT) AS h
  FROM (SELECT row_number() OVER () AS k, * FROM words) LEFT JOIN totals USING (k)
),
scored AS (
  SELECT doc_id, n_features, weight, weight + CAST(floor(-1000 * ln(-ln((h + 0.5::DOUBLE) / 4294967296.0::DOUBLE))) AS BIGINT) AS score
  FROM weighed
),
placed AS (
  SELECT *, CASE WHEN n_features >= {MIN_WORDS} THEN
    row_number() OVER (PARTITION BY n_features >= {MIN_WORDS} ORDER BY score DESC, doc_id NULLS LAST) END AS place
  FROM scored
)
SELECT doc_id, n_features, weight, score,
  CASE WHEN place <= (SELECT {PERCENT} * count(*) // 100 FROM scored WHERE n_features >= {MIN_WORDS}) THEN place END AS rank
FROM placed
"""
