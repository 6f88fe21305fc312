"""Helpers shared by the operators: row identity, stored tables, token spans and hashes in numpy."""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from fareloom.workspace import scratch_path

#: White space of every contract: space and U+0009 to U+000D.
WORD = r"[^\x20\x09-\x0D]+"
WHITE = (" ", "\t", "\n", "\x0b", "\x0c", "\r")

#: Columns that tell rows apart; they never reach a caller.
ROW_KEY = ("__row_file", "__row_at")

_IS_WHITE = np.zeros(256, dtype=bool)
_IS_WHITE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True
#: All but ASCII letters and the bytes of other characters.
NOT_LETTER = np.array([not (65 <= b <= 90 or 97 <= b <= 122 or b >= 128) for b in range(256)])
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_BASE = np.uint64(0x9E3779B97F4A7C15)  # odd, so it has an inverse modulo 2**64
_BASE_INVERSE = np.uint64(pow(0x9E3779B97F4A7C15, -1, 2**64))


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/labels.parquet")


def remainder(doc_id: Column, divisor: int) -> Column:
    """crc32 of the id's decimal text modulo ``divisor``; a null id counts as remainder 0."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % divisor, F.lit(0))


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write a table to the shared folder and read it back: cuts lineage and survives lost executors."""
    path = scratch_path(df.sparkSession, name)
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def with_row_key(df: DataFrame) -> DataFrame:
    """Add ROW_KEY, by which two scans of the same rows agree.

    Rows read from Parquet are known by their file and their place in it, so nothing is copied. Any other
    input is first written to the shared folder. Rows that carry their key already keep it.
    """
    if set(ROW_KEY) <= set(df.columns):
        return df
    try:
        keyed = df.select("*", F.col("_metadata.file_path").alias(ROW_KEY[0]), F.col("_metadata.row_index").alias(ROW_KEY[1]))
    except AnalysisException:
        keyed = stored(df, "rows").select("*", F.col("_metadata.file_path").alias(ROW_KEY[0]), F.col("_metadata.row_index").alias(ROW_KEY[1]))
    return keyed.withColumn(ROW_KEY[0], F.xxhash64(ROW_KEY[0]))


def without_white_space(text: Column) -> Column:
    """Plain byte searches, several times as fast as a regular expression."""
    for c in WHITE:
        text = F.replace(text, F.lit(c), F.lit(""))
    return text


def bounded_sample(rows: DataFrame, by: str, most: int, key: Column) -> DataFrame:
    """At most ``most`` rows of each value of ``by``, chosen by a hash of ``key``; every value keeps its share of room.

    Fewer rows than ``most`` are all taken. No value is left out: their counts are a table, of which each row holds its own.
    """
    counts = rows.where(F.col(by).isNotNull()).groupBy(F.col(by).alias("__by")).agg(F.count("*").alias("__count"))
    shares = counts.select("__by", F.floor((1 << 20) * F.least(F.lit(1.0), F.lit(float(most)) / F.col("__count"))).alias("__share"))
    draw = F.pmod(F.xxhash64(key, F.lit("sample")), F.lit(1 << 20))
    return rows.join(F.broadcast(shares), F.col(by) == F.col("__by")).where(draw < F.col("__share")).select(*rows.columns)


def text_blocks(bytes_in: int, bytes_each: int, most_bits: int = 24) -> int:
    """Bits of a hash that split so much text into blocks of about ``bytes_each``."""
    return min(most_bits, max(0, int(np.ceil(np.log2(max(1, bytes_in) / bytes_each)))))


def text_bytes(df: DataFrame, column: str = "text") -> int:
    return df.agg(F.sum(F.octet_length(F.col(column).cast("string")))).first()[0] or 0


# --- numpy, inside tasks -------------------------------------------------------------------------


def text_buffer(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The UTF-8 bytes of a text column and the offsets of its rows; null is an empty text."""
    column = column.cast(pa.large_string())
    if column.null_count:
        column = column.fill_null("")
    if not len(column):
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    offsets = np.frombuffer(column.buffers()[1], np.int64)[column.offset : column.offset + len(column) + 1]
    data = column.buffers()[2]
    data = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    return data[offsets[0] : offsets[-1]], offsets - offsets[0]


def pieces_of(offsets: np.ndarray, most: int = 1 << 21) -> Iterator[tuple[int, int]]:
    """Runs of rows with about ``most`` bytes of text each; a longer row stands alone."""
    first, rows = 0, len(offsets) - 1
    while first < rows:
        last = int(np.searchsorted(offsets, offsets[first] + most, "right")) - 1
        last = min(rows, max(first + 1, last))
        yield first, last
        first = last


def word_spans(data: np.ndarray, offsets: np.ndarray, outside: np.ndarray = _IS_WHITE) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start and end of every word, and the number of words in each row; a word never crosses rows.

    ``outside`` tells for each byte whether it separates words.
    """
    inside = np.zeros(len(data) + 2, bool)
    inside[1:-1] = ~outside[data]
    begins = inside[1:-1] & ~inside[:-2]
    ends = inside[1:-1] & ~inside[2:]
    edge = offsets[1:-1]
    edge = edge[(edge > 0) & (edge < len(data))]
    begins[edge] |= inside[1:-1][edge]
    ends[edge - 1] |= inside[1:-1][edge - 1]
    starts, stops = np.flatnonzero(begins), np.flatnonzero(ends) + 1
    counts = np.diff(np.searchsorted(starts, offsets))
    return starts, stops, counts


class SpanHasher:
    """64-bit hashes of many spans of one buffer at once: prefix sums of a polynomial, then a mixer."""

    def __init__(self) -> None:
        self.powers = np.ones(1, np.uint64)
        self.inverses = np.ones(1, np.uint64)

    def _grow(self, n: int) -> None:
        if n > len(self.powers):
            n = 1 << int(np.ceil(np.log2(n)))
            for name, base in (("powers", _BASE), ("inverses", _BASE_INVERSE)):
                values = np.full(n, base, np.uint64)
                values[0] = 1
                setattr(self, name, np.multiply.accumulate(values))

    def __call__(self, data: np.ndarray, starts: np.ndarray, stops: np.ndarray) -> np.ndarray:
        self._grow(len(data) + 1)
        sums = np.zeros(len(data) + 1, np.uint64)
        np.cumsum((data.astype(np.uint64) + np.uint64(1)) * self.powers[: len(data)], out=sums[1:])
        return mixed((sums[stops] - sums[starts]) * self.inverses[starts])


def mixed(x: np.ndarray) -> np.ndarray:
    """The finaliser of splitmix64."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def lowered(data: np.ndarray) -> np.ndarray:
    """A-Z in lower case, every other byte as it is."""
    return _LOWER[data]


def counted(keys: np.ndarray, weights: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Distinct keys in order, and how often each occurs (or the sum of its weights)."""
    if not len(keys):
        return keys, np.zeros(0, np.int64)
    if weights is None:
        keys = np.sort(keys)
        at = np.flatnonzero(np.concatenate(([True], keys[1:] != keys[:-1])))
        return keys[at], np.diff(np.append(at, len(keys)))
    order = np.argsort(keys, kind="stable")
    keys, weights = keys[order], weights[order]
    at = np.flatnonzero(np.concatenate(([True], keys[1:] != keys[:-1])))
    return keys[at], np.add.reduceat(weights, at)


def summed_rows(values: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """Sums of consecutive runs; an empty run sums to 0."""
    sums = np.zeros(len(counts), np.float64)
    full = counts > 0
    if full.any():
        sums[full] = np.add.reduceat(values, np.concatenate(([0], np.cumsum(counts)[:-1]))[full])
    return sums


def split_by_block(keys: np.ndarray, bits: int) -> Iterable[tuple[int, slice]]:
    """Blocks of sorted keys by their leading bits."""
    if not len(keys):
        return
    block = (keys >> np.uint64(64 - bits)).astype(np.int64) if bits else np.zeros(len(keys), np.int64)
    first = np.flatnonzero(np.concatenate(([True], block[1:] != block[:-1])))
    for a, b in zip(first, np.append(first[1:], len(keys))):
        yield int(block[a]), slice(int(a), int(b))
