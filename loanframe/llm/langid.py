"""Language identification by error-correcting output codes (operator 10).

Every learned language has a codeword of +1/-1 bits.  For each bit one binary
character n-gram classifier tells the languages with +1 from those with -1: a naive
Bayes log-likelihood ratio per n-gram, averaged over the text.  The n-gram counts
come from all training rows, in one pass with per-task partial counts.  A second pass
over the training rows measures, for each language and bit, how often the classifier
is right and how large its margin is; these give the weights and scales of the
loss-weighted decoding: a text takes the language with the least weighted exponential
loss between its margins and the codeword.

``ambiguous`` marks texts whose best two languages are closer than ``AMBIGUOUS``
(difference of the decoding scores).

Defined cases: a text that is null or has no letter gets ``und`` and score 0, and is
not ambiguous; so does every text when there is no training row with a language.  With
one learned language every text with a letter gets it, with score 1.  Ties go to the
first language in code point order.  Texts of any length are read whole, in blocks.
Repeated rows are scored (and counted) each.  Existing columns named like the outputs
are replaced; all others pass through.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType, DoubleType, StringType, StructField

from .bpe import _in_pieces
from .common import column, ship_package, unused, with_fields

UNDETERMINED = "und"
#: N-grams of 1 to 3 letters or word borders are hashed to so many buckets.
BUCKETS = 1 << 15
#: Texts are read in blocks of so many characters.
BLOCK = 1 << 18
#: Codes with one bit for every split of the languages, up to so many languages.
EXHAUSTIVE = 7
#: The model holds BUCKETS weights a bit, so the number of languages is bounded: more
#: distinct labels than this is an error, not a cut.
MAX_LANGUAGES = 256
#: Least difference of the two best decoding scores that is not ambiguous.
AMBIGUOUS = 0.02


@dataclass
class LanguageModel:
    languages: list[str]
    codes: np.ndarray  # languages x bits, +1 or -1
    weights: np.ndarray  # buckets x bits
    bit_weights: np.ndarray  # languages x bits, rows sum to 1
    scales: np.ndarray  # bits


def codewords(n: int) -> np.ndarray:
    """``n`` codewords: every split of the languages up to ``EXHAUSTIVE`` of them,
    beyond it the random code with the largest least distance out of 64 (fixed seed)."""
    if n < 2:
        return np.ones((n, 0), np.int8)
    if n <= EXHAUSTIVE:
        splits = np.arange(1, 1 << (n - 1))
        return np.array([[1 if i == 0 or not s >> (i - 1) & 1 else -1 for s in splits] for i in range(n)], np.int8)
    rng, best, least = np.random.default_rng(10), None, -1
    bits = math.ceil(10 * math.log2(n))
    for _ in range(64):
        code = rng.choice(np.array([1, -1], np.int8), (n, bits))
        agree = code.astype(int) @ code.T
        far = (bits - agree[np.triu_indices(n, 1)].max()) // 2
        if far > least and (abs(code.sum(0)) < n).all():
            best, least = code, far
    return best


_letters: np.ndarray | None = None


def _is_letter() -> np.ndarray:
    global _letters
    if _letters is None:
        _letters = np.fromiter((chr(i).isalpha() for i in range(0x110000)), bool, 0x110000)
    return _letters


def ngram_counts(text: str | None) -> np.ndarray | None:
    """Counts of the hashed n-grams of a whole text; ``None`` if it has no letter."""
    if not text:
        return None
    letters, total = _is_letter(), np.zeros(BUCKETS)
    found = False
    for start in range(0, len(text), BLOCK):
        part = text[max(0, start - 2) : start + BLOCK].lower()
        codes = np.frombuffer(part.encode("utf-32-le", "surrogatepass"), np.uint32)
        codes = np.where(letters[codes], codes, 0)
        found = found or bool(codes.any())
        codes = np.concatenate([np.zeros(1, codes.dtype), codes, np.zeros(1, codes.dtype)]).astype(np.uint32)
        codes = codes[np.concatenate([[True], (codes[1:] != 0) | (codes[:-1] != 0)])]
        one = codes * np.uint32(0x9E3779B1)
        two = one[:-1] * np.uint32(0x85EBCA6B) + codes[1:] * np.uint32(0xC2B2AE35)
        three = two[:-1] * np.uint32(0x27D4EB2F) + codes[2:] * np.uint32(0x165667B1)
        h = np.concatenate([one, two, three])
        h = ((h ^ (h >> np.uint32(15))) * np.uint32(0x2C1B3C6D)) >> np.uint32(17)
        total += np.bincount(h, minlength=BUCKETS)
    return total if found else None


def _texts(batches: Iterator[pa.RecordBatch], *columns: str):
    for batch in _in_pieces(batches, columns[0]):
        yield batch, [batch.column(batch.schema.get_field_index(c)).to_pylist() for c in columns]


def margins(counts: np.ndarray, weights: np.ndarray) -> np.ndarray:
    return counts @ weights / counts.sum()


def decode(model: LanguageModel, counts: np.ndarray) -> tuple[str, float, bool]:
    """Language, score (0 to 1) and whether the choice is ambiguous."""
    if len(model.languages) == 1:
        return model.languages[0], 1.0, False
    f = np.clip(margins(counts, model.weights) / model.scales, -4, 4)
    loss = (model.bit_weights * np.exp(-f * model.codes)).sum(1)
    fit = np.exp(-(loss - loss.min()) * 4)
    share = fit / fit.sum()
    best = int(loss.argmin())
    second = np.delete(share, best).max()
    return model.languages[best], float(share[best]), bool(share[best] - second < AMBIGUOUS)


def fit_language_model(train: DataFrame, text: str = "text", lang: str = "lang") -> LanguageModel:
    """Learn from all rows of ``train`` whose ``lang`` is not null."""
    ship_package(train.sparkSession)
    rows = train.select(F.col(text).alias("text"), F.col(lang).alias("lang")).filter("lang is not null")

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[str, np.ndarray] = {}
        for _, (texts, langs) in _texts(batches, "text", "lang"):
            for t, name in zip(texts, langs):
                c = ngram_counts(t)
                if c is not None:
                    if name not in sums:
                        if len(sums) == MAX_LANGUAGES:
                            raise ValueError(f"more than {MAX_LANGUAGES} languages")
                        sums[name] = np.zeros(BUCKETS)
                    sums[name] += c
        for name, c in sums.items():
            at = np.flatnonzero(c)
            yield pa.RecordBatch.from_arrays(
                [pa.array([name] * len(at), pa.string()), pa.array(at, pa.int32()), pa.array(c[at].astype(np.int64))],
                ["lang", "bucket", "n"],
            )

    counted = (
        rows.mapInArrow(count, "lang string, bucket int, n bigint")
        .groupBy("lang", "bucket")
        .agg(F.sum("n").alias("n"))
    )
    # At most BUCKETS rows a language come to the driver, whatever the corpus.
    table = counted.limit(MAX_LANGUAGES * BUCKETS + 1).toArrow()
    names = np.array(table["lang"].to_pylist(), object)
    bucket, n = table["bucket"].to_numpy(), table["n"].to_numpy()
    languages = sorted(set(names))
    if len(languages) > MAX_LANGUAGES:
        raise ValueError(f"more than {MAX_LANGUAGES} languages")
    codes = codewords(len(languages))
    if len(languages) < 2:
        return LanguageModel(languages, codes, np.zeros((BUCKETS, 0)), np.zeros(codes.shape), np.ones(0))
    share = np.zeros((len(languages), BUCKETS))
    for i, name in enumerate(languages):
        own = names == name
        share[i, bucket[own]] = n[own]
    share = (share + 0.5) / (share.sum(1, keepdims=True) + 0.5 * BUCKETS)
    weights = np.stack(
        [np.log(share[codes[:, j] > 0].mean(0)) - np.log(share[codes[:, j] < 0].mean(0)) for j in range(codes.shape[1])],
        axis=1,
    )
    return _calibrated(rows, languages, codes, weights)


def _calibrated(rows: DataFrame, languages: list[str], codes: np.ndarray, weights: np.ndarray) -> LanguageModel:
    """Accuracy of every bit on every language, and mean margins, over all rows."""
    index = {name: i for i, name in enumerate(languages)}
    sent = rows.sparkSession.sparkContext.broadcast((codes, weights))

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codes, weights = sent.value
        right, size = np.zeros(codes.shape), np.zeros(codes.shape)
        seen = np.zeros(len(codes))
        for _, (texts, langs) in _texts(batches, "text", "lang"):
            for t, name in zip(texts, langs):
                c = ngram_counts(t)
                if c is not None:
                    i, m = index[name], margins(c, weights)
                    right[i] += m * codes[i] > 0
                    # Fixed point: the sums do not depend on the order of the rows.
                    size[i] += np.rint(abs(m) * 1e6)
                    seen[i] += 1
        i, j = np.nonzero(np.repeat(seen[:, None] > 0, codes.shape[1], 1))
        columns = [i, j, right[i, j], size[i, j], seen[i]]
        yield pa.RecordBatch.from_arrays(
            [pa.array(x.astype(np.int64)) for x in columns], ["lang", "bit", "correct", "size", "seen"]
        )

    per = (
        rows.mapInArrow(judge, "lang bigint, bit bigint, correct bigint, size bigint, seen bigint")
        .groupBy("lang", "bit")
        .agg(F.sum("correct").alias("correct"), F.sum("size").alias("size"), F.sum("seen").alias("seen"))
        .collect()
    )
    accuracy, size = np.zeros(codes.shape), np.zeros(codes.shape)
    for r in per:
        accuracy[r["lang"], r["bit"]] = r["correct"] / r["seen"]
        size[r["lang"], r["bit"]] = r["size"] / r["seen"] / 1e6
    bit_weights = np.maximum(accuracy - 0.5, 0) + 1e-3
    bit_weights /= bit_weights.sum(1, keepdims=True)
    return LanguageModel(languages, codes, weights, bit_weights, np.maximum(size.mean(0), 1e-9))


OUTPUTS = ("lang_pred", "score", "ambiguous")


def identify_language(
    df: DataFrame, model: LanguageModel, text: str = "text", names: tuple[str, str, str] = OUTPUTS
) -> DataFrame:
    """``df`` with ``lang_pred``, ``score`` and ``ambiguous`` (or other ``names``); no
    shuffle."""
    spark = df.sparkSession
    ship_package(spark)
    sent = spark.sparkContext.broadcast(model)
    kinds = (StringType(), DoubleType(), BooleanType())
    schema = with_fields(df, *(StructField(n, k) for n, k in zip(names, kinds)))
    lower = {n.lower() for n in names}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = sent.value
        for batch, (texts,) in _texts(batches, text):
            found = []
            for t in texts:
                c = ngram_counts(t) if model.languages else None
                found.append((UNDETERMINED, 0.0, False) if c is None else decode(model, c))
            keep = [i for i, c in enumerate(batch.schema.names) if c.lower() not in lower]
            columns = [batch.column(i) for i in keep]
            columns += [pa.array([x[k] for x in found], t) for k, t in enumerate((pa.string(), pa.float64(), pa.bool_()))]
            yield pa.RecordBatch.from_arrays(columns, schema.names)

    return df.mapInArrow(run, schema)


def drop_unidentified(df: DataFrame, model: LanguageModel, text: str = "text") -> DataFrame:
    """``df`` without the rows whose language is undetermined or ambiguous."""
    names = tuple(unused(df, n) for n in OUTPUTS)
    told = identify_language(df, model, text, names)
    kept = told.filter((F.col(names[0]) != UNDETERMINED) & ~F.col(names[2]))
    return kept.select(*[column(c) for c in df.columns])
