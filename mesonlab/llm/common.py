"""Helpers shared by the operators: shared-folder tables, word hashes, row keys."""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from mesonlab.session import scratch_path, ship_package

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


#: Rows of an Arrow batch: whole texts are long, and a worker holds a batch at a time.
BATCH_ROWS = 500


def prepare(spark: SparkSession) -> None:
    """Ships the package to the workers and bounds the session's Arrow batches."""
    ship_package(spark)
    if int(spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")) > BATCH_ROWS:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    prepare(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def written(df: DataFrame, name: str) -> DataFrame:
    """``df`` written as Parquet in the shared checkpoint folder and read back:
    cuts lineage in a way that survives the loss of executors."""
    spark = df.sparkSession
    prepare(spark)
    path = scratch_path(spark, name)
    df.write.parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    out.scratch_path = path
    return out


def spent(*tables: DataFrame) -> None:
    """Deletes the files of tables that came from ``written``, once all that was made of them
    is written itself."""
    for df in tables:
        spark = df.sparkSession
        path = spark._jvm.org.apache.hadoop.fs.Path(df.scratch_path)
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def lower_ascii(text: Column) -> Column:
    return F.translate(text, UPPER, LOWER)


def crc_mod(key: Column, n: int) -> Column:
    """crc32 of the key as text, modulo ``n`` (null for a null key)."""
    return F.crc32(key.cast("string").cast("binary")) % F.lit(n)


# ---- word hashes -------------------------------------------------------------
# A word's hash is a polynomial over per-byte random values modulo 2**64,
# finished by a mixing step; computed for a whole block of text at once.

_BASE = 0x9E3779B97F4A7C15 | 1
_BASE_INV = pow(_BASE, -1, 1 << 64)
_RNG = np.random.default_rng(20240607)
_BYTE = _RNG.integers(1, 1 << 63, 256, dtype=np.uint64)
_LOWERED = np.arange(256, dtype=np.uint8)
_LOWERED[65:91] += 32
_VALUE = _BYTE[_LOWERED]
_NONSPACE = np.ones(256, bool)
_NONSPACE[[9, 10, 11, 12, 13, 32]] = False
_ALNUM = np.zeros(256, bool)
_ALNUM[48:58] = _ALNUM[65:91] = _ALNUM[97:123] = _ALNUM[128:256] = True
#: Byte classes of words: anything but ASCII white space, and ASCII letters,
#: digits and everything beyond ASCII.
WORD_BYTES = {"nonspace": _NONSPACE, "alnum": _ALNUM}
BLOCK_BYTES = 1 << 20
_SPACE = re.compile(rb"[\x20\x09-\x0D]+")
_powers: list[np.ndarray] = [np.ones(1, np.uint64), np.ones(1, np.uint64)]


def power_tables(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the hashes' base and of its inverse, from 0 to n - 1."""
    if len(_powers[0]) < n:
        size = max(n, BLOCK_BYTES + 4096)
        for i, base in enumerate((_BASE, _BASE_INV)):
            steps = np.full(size, base, np.uint64)
            steps[0] = 1
            _powers[i] = np.multiply.accumulate(steps)
    return _powers[0][:n], _powers[1][:n]


def mix(h: np.ndarray) -> np.ndarray:
    """splitmix64's finishing step."""
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def _line_ends(raw: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """True for the words that end a line: a sentence mark ends them, or a line break
    follows before the next word."""
    out = _MARK[raw[end - 1]]
    word = np.searchsorted(end, np.flatnonzero(raw == 10), side="right") - 1  # the last one before each break
    out[word[word >= 0]] = True
    return out


_MARK = np.isin(np.arange(256), (33, 46, 63))
#: Values of bytes, 0 for those of no word: words' sums can run on to the next word.
_VALUES = {name: np.where(word, _VALUE, np.uint64(0)) for name, word in WORD_BYTES.items()}


def _edges(raw: np.ndarray, word: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First bytes of the words, and the bytes after them."""
    inside = word[raw]
    turn = np.flatnonzero(inside[1:] != inside[:-1]) + 1
    if len(raw) and inside[0]:
        turn = np.concatenate(([0], turn))
    if len(raw) and inside[-1]:
        turn = np.append(turn, len(raw))
    return turn[::2], turn[1::2]


def _hash_block(data: bytes, words: str, line_ends: list | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Hashes and byte starts of the words of one block."""
    raw = np.frombuffer(data, np.uint8)
    start, end = _edges(raw, WORD_BYTES[words])
    if line_ends is not None:
        line_ends.append(_line_ends(raw, start, end))
    if not len(start):
        return np.zeros(0, np.uint64), start
    up, down = power_tables(len(raw))
    values = _VALUES[words][raw]
    values *= up
    total = np.add.reduceat(values, start)
    return mix(total * down[start] + (end - start).astype(np.uint64)), start


def _cuts(data: bytes) -> Iterator[bytes]:
    """A long text in blocks that end in the white space after a word: a line break there
    is seen with the word before it."""
    at = 0
    while len(data) - at > BLOCK_BYTES:
        cut = data.rfind(b" ", at, at + BLOCK_BYTES)
        if cut <= at:
            cut = data.find(b" ", at + BLOCK_BYTES)
            if cut < 0:
                break
        cut = _SPACE.match(data, cut).end()
        yield data[at:cut]
        at = cut
    yield data[at:]


def word_hashes(texts, words: str, line_ends: list | None = None) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(index of the first text, word hashes, word offsets of the texts and
    their end) for groups of texts of about BLOCK_BYTES; a longer text is a
    group of its own. A-Z count as lower case; a null text has no words. Into
    ``line_ends`` go, for each group, arrays that tell which words end a line."""
    group: list[bytes] = []
    first = held = 0

    def flush():
        sizes = np.fromiter((len(x) + 1 for x in group), np.int64, len(group))
        hashes, start = _hash_block(b" ".join(group), words, line_ends)
        return hashes, np.searchsorted(start, np.concatenate(([0], np.cumsum(sizes))))

    for i, text in enumerate(texts):
        data = b"" if text is None else text.encode("utf-8")
        if group and held + len(data) > BLOCK_BYTES:
            yield (first, *flush())
            group, held, first = [], 0, i
        if len(data) > BLOCK_BYTES:
            hashes = np.concatenate([_hash_block(x, words, line_ends)[0] for x in _cuts(data)])
            yield first, hashes, np.array([0, len(hashes)])
            first = i + 1
            continue
        group.append(data)
        held += len(data) + 1
    if group:
        yield (first, *flush())


def word_places(data: bytes, words: str, starts: bool = False) -> tuple[np.ndarray, ...]:
    """Of each word of one block: its hash, its first byte's place if asked for, its length,
    and its first and last eight bytes as numbers (A-Z as lower case; of a shorter word
    all of them)."""
    hashes, start = _hash_block(data, words)
    raw = _LOWERED[np.frombuffer(data, np.uint8)]
    size = _edges(raw, WORD_BYTES[words])[1] - start
    end = start + size
    padded = np.concatenate((np.zeros(8, np.uint8), raw, np.zeros(8, np.uint8)))
    eight = np.lib.stride_tricks.as_strided(padded, (len(raw) + 9, 8), (1, 1))
    short = np.uint64(8) * (np.uint64(8) - np.minimum(size, 8).astype(np.uint64))
    ahead = np.ascontiguousarray(eight[start + 8]).view("<u8").ravel() << (short % np.uint64(64))
    back = np.ascontiguousarray(eight[end]).view("<u8").ravel() >> (short % np.uint64(64))
    return (hashes, *([start] if starts else []), size, ahead, back)


def word_starts(data: bytes, words: str) -> np.ndarray:
    """First bytes of the words of a text."""
    return _edges(np.frombuffer(data, np.uint8), WORD_BYTES[words])[0]


def window_hashes(hashes: np.ndarray, size: int) -> np.ndarray:
    """Hash of every run of ``size`` consecutive word hashes."""
    n = max(len(hashes) - size + 1, 0)
    out = np.zeros(n, np.uint64)
    for j in range(size):
        out = out * np.uint64(_BASE) + hashes[j:j + n]
    return mix(out)
