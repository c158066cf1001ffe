"""What the operators share: the folder all executors see, free column names, text buffers."""

from __future__ import annotations

import tempfile
import uuid
import zipfile
from pathlib import Path

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from excursio.sources.scratch import scratch_folder

#: Bytes of text that one Arrow batch holds; a single longer row makes a batch of its own.
BATCH_BYTES = 2 << 20

#: Bytes of the words split off by white space: all but space and 0x09-0x0D.
SPACE_SEPARATED = np.ones(256, bool)
SPACE_SEPARATED[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = False

_MASK = (1 << 64) - 1


def shared_folder(spark: SparkSession) -> str:
    """The folder named by spark.checkpoint.dir; a temporary one where that is unset and Spark runs on one machine."""
    return scratch_folder(spark)


def stored(df: DataFrame, label: str, **options: str) -> DataFrame:
    """The same rows, written to the shared folder and read back: no lineage behind them, safe against lost executors."""
    path = f"{shared_folder(df.sparkSession)}/{label}-{uuid.uuid4().hex}"
    df.write.options(**options).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def checkpointed(df: DataFrame) -> DataFrame:
    """The same rows in the same partitions, kept in the shared folder."""
    context = df.sparkSession.sparkContext
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(shared_folder(df.sparkSession))
    return df.checkpoint()


def fresh(df: DataFrame, name: str) -> str:
    """A column name that the frame does not have."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


_shipped: set[str] = set()


def ready(spark: SparkSession) -> None:
    """To be called before Python steps are put into a plan.

    Bounds the Arrow batches by bytes, so that long texts do not pile up in a Python worker,
    and gives the executors this package, so that it need not be installed there.
    """
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "2000")
    context = spark.sparkContext
    if context.applicationId not in _shipped:
        root = Path(__file__).resolve().parent.parent
        archive = Path(tempfile.mkdtemp(prefix="excursio-"), "excursio_package.zip")
        with zipfile.ZipFile(archive, "w") as z:
            for file in sorted(root.rglob("*.py")):
                z.write(file, file.relative_to(root.parent))
        context.addPyFile(str(archive))  # copied to the driver's file server, from which executors fetch it
        _shipped.add(context.applicationId)


def text_buffers(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes of all texts and their n + 1 offsets; null counts as empty."""
    texts = texts.fill_null("").cast(pa.large_string())
    _, offsets, data = texts.buffers()
    at = np.frombuffer(offsets, np.int64)[texts.offset : texts.offset + len(texts) + 1]
    if not len(at):
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    if data is None or at[-1] == at[0]:
        return np.zeros(0, np.uint8), np.zeros(len(texts) + 1, np.int64)
    return np.frombuffer(data, np.uint8)[at[0] : at[-1]], at - at[0]


def word_spans(data: np.ndarray, offsets: np.ndarray, inside: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start and end byte of every word, and for each text the index of its first word (n + 1 values)."""
    word = inside[data]
    before = np.zeros(len(word), bool)
    before[1:] = word[:-1]
    before[offsets[:-1][offsets[:-1] < len(word)]] = False
    after = np.zeros(len(word), bool)
    after[:-1] = word[1:]
    last = offsets[1:]
    after[last[last > 0] - 1] = False
    starts = np.flatnonzero(word & ~before)
    ends = np.flatnonzero(word & ~after) + 1
    return starts, ends, np.searchsorted(starts, offsets)


def splitmix(x: np.ndarray) -> np.ndarray:
    """Finaliser of SplitMix64."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


_BYTE = splitmix(np.arange(1, 257, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))
_BASE = 0x9E3779B97F4A7C15 | 1
_POWER = np.array([pow(_BASE, k, 1 << 64) for k in range(256)], np.uint64)


def hash_words(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, part: int = 1 << 18) -> np.ndarray:
    """64-bit polynomial hash of every word's bytes, in parts of so many words to bound memory."""
    out = np.empty(len(starts), np.uint64)
    for lo in range(0, len(starts), part):
        s, e = starts[lo : lo + part], ends[lo : lo + part]
        n = e - s
        long = n > len(_POWER)
        for k in np.flatnonzero(long):
            h = 0
            for byte in data[s[k] : e[k]].tobytes():
                h = (h * _BASE + byte + 1) & _MASK
            out[lo + k] = h
        if long.all():
            continue
        keep = np.flatnonzero(~long)
        s, n = s[keep], n[keep]
        first = np.zeros(len(n), np.int64)
        np.cumsum(n[:-1], out=first[1:])
        inner = np.arange(int(n.sum())) - np.repeat(first, n)
        byte = data[np.repeat(s, n) + inner]
        out[lo + keep] = np.add.reduceat(_BYTE[byte] * _POWER[inner], first)
    return splitmix(out)


def hash_shingles(words: np.ndarray, size: int) -> np.ndarray:
    """Hash of every run of so many consecutive word hashes."""
    n = max(len(words) - size + 1, 0)
    out = np.zeros(n, np.uint64)
    for k in range(size):
        out = out * np.uint64(_BASE) + words[k : k + n]
    return splitmix(out)


def in_parts(offsets: np.ndarray, most: int = 1 << 19):
    """Ranges (first, end) of consecutive texts of about so many bytes together."""
    lo, n = 0, len(offsets) - 1
    while lo < n:
        hi = max(lo + 1, int(np.searchsorted(offsets, offsets[lo] + most, "right")) - 1)
        yield lo, min(hi, n)
        lo = min(hi, n)
