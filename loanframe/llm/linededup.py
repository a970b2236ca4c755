"""Line dedup by content-defined line chunks (operator 7), in DataFrame expressions only.

Only lines that occur more than once in the table can be part of a repeated passage.  In
every document the runs of such lines are cut into chunks: a run's ends are borders, a
line of over ``LONG_WORDS`` words always is a chunk of its own, and within a run a rolling
hash over the hashes of the last two lines decides whether a chunk ends after a line.  So
a passage is cut alike wherever it stands: the foreign lines around it are borders, not
parts of its first and last chunk, and inside it a border depends on the lines next to it.
Compared are the chunks of several lines (and the long lines), and every two neighbouring
chunks together, so that a short chunk inside a repeated passage goes with its neighbour.
What occurs more than once in the whole table is removed, all but the first occurrence, in
the order of document id and place; an occurrence that overlaps the first one in its own
document is none.  Chunks are matched by hash first; one is only removed after its bytes
were compared with those of the first occurrence, and where hashes collide, with those of
the first one of its own bytes.

Empty lines are no lines: they go, or stay, with the line before them (at the beginning of
a text, with the first line).  A text from which something was removed loses line ends at
its end.

What is shuffled: a hash, a place and a flag for every line, once; those of repeated lines
by document; a hash and a place for every chunk and pair of repeated lines; the text of the
documents that hold such, once to fetch the chunks that repeat, and the text of all once to
rewrite; the text of repeated chunks.  Counts are summed before the shuffle, and a line or
chunk held by very many documents is spread over tasks by the skew handling of the joins.

Defined cases: a null text stays null, an empty one empty; a text that consists of
repeated chunks only becomes empty; its row stays.  Rows with equal id and text are one
document: they get the same result and are no repeat of each other.  Null ids come last
in the order.  All other columns are kept, whatever their names.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import column, packed, stored, unpacked

#: A chunk ends after a line with chance one in so many.
MEAN_LINES = 2
#: Lines of more words than this are chunks of their own.
LONG_WORDS = 50
#: Multiplier and modulus of the rolling hash.
_FACTOR, _MODULUS = 65_599, 1 << 32

KEYS = ("null_id", "id", "text_hash")

#: A line with the empty lines after it; the first one also with those before it.
_PIECE = r"\n*[^\n]+\n*"


def _pieces(text: Column) -> Column:
    return F.regexp_extract_all(text, F.lit(_PIECE), F.lit(0))


def _line(piece: Column) -> Column:
    return F.btrim(piece, F.lit("\n"))


def _line_hash(line: Column) -> Column:
    """60 bits of the line's MD5."""
    return F.conv(F.substring(F.md5(line.cast("binary")), 1, 15), 16, 10).cast("bigint")


def _is_long(line: Column) -> Column:
    return F.length(line) - F.length(F.replace(line, F.lit(" "), F.lit(""))) >= LONG_WORDS


#: A chunk as one number: its first line times this, plus its number of lines.
_SIZES = 1 << 31


def _start(chunk: Column) -> Column:
    return F.shiftright(chunk, 31).cast("int")


def _size(chunk: Column) -> Column:
    return chunk.bitwiseAND(F.lit(_SIZES - 1)).cast("int")


def _numbered(start: Column, size: Column) -> Column:
    return start.cast("bigint") * _SIZES + size


def with_units(marked: DataFrame) -> DataFrame:
    """``marked`` with ``units``, what is compared of a document: (span, hash, chunks),
    chunks and spans being numbered alike.  ``marks`` are its repeated lines in order,
    ``(at, hash, long)``.  No shuffle."""

    def ends(mark: Column, i: Column) -> Column:
        last, after = F.get("marks", i - 1), F.get("marks", i + 1)
        before = F.when(last["at"] == mark["at"] - 1, F.shiftright(last["hash"], 28))
        rolled = (F.shiftright(mark["hash"], 28) + F.coalesce(before, F.lit(0)) * _FACTOR) % _MODULUS
        return (
            after.isNull()
            | (after["at"] != mark["at"] + 1)
            | mark["long"]
            | after["long"]
            | (F.shiftright(rolled, 16) % MEAN_LINES == 0)
        )

    is_end = F.transform("marks", ends)
    cut = marked.withColumn(
        "ends", F.filter(F.transform(is_end, lambda e, i: F.when(e, i)), lambda i: i.isNotNull())
    )

    def chunk(end: Column, k: Column) -> Column:
        first = F.when(k > 0, F.get("ends", k - 1) + 1).otherwise(0)
        start, size = F.get("marks", first)["at"], end - first + 1
        return F.struct(first.alias("first"), size.alias("size"), start.alias("start"), _numbered(start, size).alias("chunk"))

    cut = cut.withColumn("cuts", F.transform("ends", chunk))

    def unit(first: Column, start: Column, size: Column, chunks: Column) -> Column:
        hashes = F.transform(F.slice("marks", first + 1, size), lambda m: m["hash"])
        return F.struct(_numbered(start, size).alias("span"), F.xxhash64(hashes).alias("hash"), chunks.alias("chunks"))

    alone = F.transform(
        F.filter("cuts", lambda c: (c["size"] > 1) | F.get("marks", c["first"])["long"]),
        lambda c: unit(c["first"], c["start"], c["size"], F.array(c["chunk"])),
    )

    def pair(c: Column, k: Column) -> Column:
        after = F.get("cuts", k + 1)
        both = unit(c["first"], c["start"], c["size"] + after["size"], F.array(c["chunk"], after["chunk"]))
        return F.when(after["start"] == c["start"] + c["size"], both)

    pairs = F.filter(F.transform("cuts", pair), lambda u: u.isNotNull())
    return cut.withColumn("units", F.concat(alone, pairs)).drop("ends", "cuts")


def _keyed(docs: DataFrame, doc_id: str, text: str, *kept: Column) -> DataFrame:
    return docs.select(
        *kept,
        column(doc_id).isNull().alias("null_id"),
        F.coalesce(column(doc_id), F.lit(0)).cast("bigint").alias("id"),
        F.xxhash64(column(text)).alias("text_hash"),
    )


def repeated_lines(keyed: DataFrame) -> DataFrame:
    """``(null_id, id, text_hash, marks)``: the lines of every document that occur again,
    there or in another one, in order."""
    # The outer form: for the inner one Spark adds a filter on the size of the array,
    # pushes it below the projections and evaluates all of their expressions nested.
    lines = keyed.select(*KEYS, F.posexplode_outer(_pieces(F.col("text"))).alias("at", "piece"))
    lines = lines.filter("piece is not null").withColumn("line", _line(F.col("piece")))
    lines = stored(lines.select(*KEYS, "at", _line_hash(F.col("line")).alias("hash"), _is_long(F.col("line")).alias("long")), "lines")
    # Rows of one document hold their lines at equal places, which count once.
    place = F.xxhash64(*KEYS, "at")
    again = lines.groupBy("hash").agg(F.min(place).alias("least"), F.max(place).alias("most"))
    again = again.filter("least != most").select("hash")
    marks = F.array_sort(F.collect_set(F.struct("at", "hash", "long")))  # lines of one document
    return lines.join(again, "hash", "left_semi").groupBy(*KEYS).agg(marks.alias("marks"))


def repeated_chunks(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``(null_id, id, text_hash, removed)``: the chunks to remove from a document, which
    occur earlier byte by byte."""
    keyed = _keyed(docs, doc_id, text, column(text).alias("text"))
    place, numbered = F.struct(*KEYS, "span"), F.xxhash64(*KEYS, "span")
    units = with_units(repeated_lines(keyed)).select(*KEYS, F.explode_outer("units").alias("unit"))
    seen = stored(units.filter("unit is not null").select(*KEYS, "unit.*"), "chunks")
    first = (
        seen.groupBy("hash")
        .agg(F.min(place).alias("first"), F.min(numbered).alias("least"), F.max(numbered).alias("most"))
        .filter("least != most")
        .select("hash", "first")
    )
    here = F.struct(*KEYS)
    overlaps = (here == F.struct(*[F.col("first")[k].alias(k) for k in KEYS])) & (
        _start(F.col("span")) < _start(F.col("first.span")) + _size(F.col("first.span"))
    )
    asked = (
        seen.join(first, "hash")
        .filter((place == F.col("first")) | ~overlaps)
        .select(*KEYS, F.struct("span", "chunks", "hash", (place == F.col("first")).alias("is_first")).alias("ask"))
        .groupBy(*KEYS)
        .agg(F.collect_set("ask").alias("asks"))  # chunks of one document
    )
    span = F.slice("lines", _start(F.col("ask.span")) + 1, _size(F.col("ask.span")))
    found = (
        keyed.join(asked, list(KEYS))
        .select(*KEYS, F.transform(_pieces(F.col("text")), _line).alias("lines"), F.explode_outer("asks").alias("ask"))
        .select(*KEYS, "ask.*", F.array_join(span, "\n").alias("bytes"))
    )
    found = stored(found, "repeated")
    # Stored, so that the join below reads two plain tables and can split a hot chunk.
    kept = stored(found.filter("is_first").select("hash", F.col("bytes").alias("first_bytes")).distinct(), "first")
    compared = found.filter("not is_first").join(kept, "hash")
    # Where hashes collide, the first of equal bytes stays.
    other = compared.filter("bytes != first_bytes")
    other_first = other.groupBy("hash", "bytes").agg(F.min(place).alias("first"))
    repeated = other.join(other_first, ["hash", "bytes"]).filter(place != F.col("first"))
    equal = compared.filter("bytes = first_bytes").select(*KEYS, "chunks").union(repeated.select(*KEYS, "chunks"))
    return equal.groupBy(*KEYS).agg(F.array_distinct(F.flatten(F.collect_set("chunks"))).alias("removed"))


def remove_repeated_chunks(
    docs: DataFrame, doc_id: str = "doc_id", text: str = "text", report: bool = False
) -> DataFrame:
    """``docs`` with ``text`` rid of repeated chunks; with ``report`` also the counts
    ``n_lines``, ``n_lines_removed`` and ``n_chunks_removed`` (which replace columns of
    those names)."""
    whole = F.col("row").getField(text)
    joined = _keyed(docs, doc_id, text, packed(docs)).join(
        repeated_chunks(docs, doc_id, text), list(KEYS), "left"
    )
    gone = F.flatten(F.transform("removed", lambda c: F.sequence(_start(c), _start(c) + _size(c) - 1)))
    left = F.array_except(F.sequence(F.lit(0), F.size("pieces") - 1), gone)
    rest = F.rtrim(F.array_join(F.transform(left, lambda i: F.get("pieces", i)), ""), F.lit("\n"))
    cut = joined.withColumn("pieces", F.when(F.col("removed").isNotNull() | F.lit(report), _pieces(whole)))
    rest = F.when(F.col("removed").isNull(), whole).otherwise(rest)
    counts = {
        "n_lines": F.when(whole.isNotNull(), F.size("pieces")),
        "n_lines_removed": F.when(F.col("removed").isNotNull(), F.aggregate("removed", F.lit(0), lambda n, c: n + _size(c))),
        "n_chunks_removed": F.when(F.col("removed").isNotNull(), F.size("removed")),
    }
    if not report:
        counts = {}
    columns = [c for c in docs.columns if c.lower() not in counts]
    return cut.select(
        *unpacked(columns, **{text: rest}),
        *[F.coalesce(v.cast("bigint"), F.lit(0).cast("bigint")).alias(k) for k, v in counts.items()],
    )


ORACLE = f"""
WITH docs AS (SELECT DISTINCT doc_id, text FROM documents WHERE text IS NOT NULL),
pieces AS (SELECT doc_id, text, regexp_extract_all(text, '\\n*[^\\n]+\\n*') AS ps FROM docs),
lines AS (
  SELECT *, trim(piece, chr(10)) AS line FROM (
    SELECT doc_id, text, unnest(ps) AS piece, generate_subscripts(ps, 1) AS i FROM pieces
  )
),
marks AS (
  SELECT *, CAST('0x' || substr(md5(line), 1, 8) AS BIGINT) AS h,
    length(line) - length(replace(line, ' ', '')) >= {LONG_WORDS} AS long
  FROM lines SEMI JOIN (SELECT line FROM lines GROUP BY line HAVING count(*) > 1) USING (line)
),
near AS (
  SELECT *, CASE WHEN lag(i) OVER w = i - 1 THEN lag(h) OVER w ELSE 0 END AS before,
    lead(i) OVER w AS next_i, lead(long) OVER w AS next_long
  FROM marks WINDOW w AS (PARTITION BY doc_id, text ORDER BY i)
),
ends AS (
  SELECT *, CASE WHEN next_i IS NULL OR next_i <> i + 1 OR long OR next_long
      OR (((h + before * {_FACTOR}) % {_MODULUS}) // 65536) % {MEAN_LINES} = 0 THEN 1 ELSE 0 END AS is_end
  FROM near
),
numbered AS (
  SELECT *, sum(is_end) OVER (PARTITION BY doc_id, text ORDER BY i) - is_end AS k FROM ends
),
chunks AS (
  SELECT doc_id, text, min(i) AS start, count(*) AS size, string_agg(line, chr(10) ORDER BY i) AS bytes, bool_or(long) AS long
  FROM numbered GROUP BY doc_id, text, k
),
units AS (
  SELECT doc_id, text, start, size, bytes, start AS last FROM chunks WHERE size > 1 OR long
  UNION ALL
  SELECT doc_id, text, start, size + next_size, bytes || chr(10) || next_bytes, next_start FROM (
    SELECT *, lead(bytes) OVER w AS next_bytes, lead(start) OVER w AS next_start, lead(size) OVER w AS next_size
    FROM chunks WINDOW w AS (PARTITION BY doc_id, text ORDER BY start)
  ) WHERE next_start = start + size
),
ordered AS (
  SELECT *, row_number() OVER w AS place, first_value(doc_id) OVER w AS first_id, first_value(text) OVER w AS first_text,
    first_value(start) OVER w AS first_start
  FROM units WINDOW w AS (PARTITION BY bytes ORDER BY doc_id NULLS LAST, text, start)
),
again AS (
  SELECT * FROM ordered WHERE place > 1
  AND NOT (doc_id IS NOT DISTINCT FROM first_id AND text = first_text AND start < first_start + size)
),
gone AS (SELECT doc_id, text, start FROM again UNION SELECT doc_id, text, last FROM again),
removed AS (
  SELECT g.doc_id, g.text, c.start, c.size FROM gone g JOIN chunks c
  ON g.doc_id IS NOT DISTINCT FROM c.doc_id AND g.text = c.text AND g.start = c.start
),
per AS (
  SELECT doc_id, text, count(*) AS chunks, CAST(sum(size) AS BIGINT) AS lines,
    flatten(list(range(start, start + size))) AS at
  FROM removed GROUP BY doc_id, text
)
SELECT d.doc_id, CAST(coalesce(len(p.ps), 0) AS BIGINT) AS n_lines, coalesce(r.lines, 0) AS n_lines_removed,
  coalesce(r.chunks, 0) AS n_chunks_removed,
  md5(CASE WHEN r.at IS NULL THEN d.text ELSE rtrim(array_to_string(
    list_filter(p.ps, lambda x, i: NOT list_contains(r.at, i)), ''), chr(10)) END) AS text_md5
FROM documents d
LEFT JOIN pieces p ON d.doc_id IS NOT DISTINCT FROM p.doc_id AND d.text = p.text
LEFT JOIN per r ON d.doc_id IS NOT DISTINCT FROM r.doc_id AND d.text = r.text
"""
