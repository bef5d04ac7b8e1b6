"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sparkwright.session import write_shared

#: Words of the contracts that split at ASCII white space.
SPACE_WORDS = r"[^\x20\x09-\x0D]+"
ARROW_BYTES = "8m"
_ARROW_LIMIT = "spark.sql.execution.arrow.maxBytesPerBatch"


def materialise(df: DataFrame, what: str) -> DataFrame:
    """Write ``df`` once as Parquet to the shared folder and read it back (cuts lineage); the copy
    belongs to the open block of ``session.copies``."""
    return write_shared(df, what)


def fresh_names(columns, *names: str) -> list[str]:
    """The names, each with as many underscores in front as it takes to be none of ``columns``."""
    taken = {c.lower() for c in columns}
    out = []
    for name in names:
        while name.lower() in taken:
            name = f"_{name}"
        out.append(name)
    return out


def bound_batches(spark: SparkSession) -> None:
    """Arrow batches of texts: at most ARROW_BYTES each, unless the session sets its own limit.
    (10,000 rows of text, the default, are tens of MB on both sides of the socket for each task.)"""
    if _ARROW_LIMIT not in spark.conf.getAll:
        spark.conf.set(_ARROW_LIMIT, ARROW_BYTES)


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def read_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/documents.parquet")


def ids_and_texts(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id long, text string), a null text read as empty; other columns are left behind,
    so their names cannot clash with what an operator adds."""
    bound_batches(docs.sparkSession)
    return docs.select(F.col(f"`{id_col}`").cast("long").alias("doc_id"),
                       F.coalesce(F.col(f"`{text_col}`").cast("string"), F.lit("")).alias("text"))


# --------------------------------------------------------------------------------------
# Words of many texts at once, as numpy arrays.

_IS_SPACE = np.zeros(256, dtype=bool)
_IS_SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True
_M1 = np.uint64(0xFF51AFD7ED558CCD)
_M2 = np.uint64(0xC4CEB9FE1A85EC53)
_S = np.uint64(33)
_LOW = np.array([(1 << (8 * k)) - 1 for k in range(8)] + [2**64 - 1], dtype=np.uint64)


def mix64(x: np.ndarray) -> np.ndarray:
    """The 64-bit finaliser of MurmurHash3 (a bijection)."""
    x = (x ^ (x >> _S)) * _M1
    x = (x ^ (x >> _S)) * _M2
    return x ^ (x >> _S)


class Words:
    """Words ``[^\\x20\\x09-\\x0D]+`` of a list of texts: byte ranges, owners and 64-bit hashes.

    ``start``/``end`` index ``data`` (UTF-8 of all texts, one line feed between them);
    ``first[i]:first[i + 1]`` are the words of text i. With ``lower``, A-Z are read as a-z.
    """

    def __init__(self, texts: list[str], lower: bool = False):
        raw = [t.encode("utf-8", "surrogatepass") for t in texts]
        if lower:
            raw = [r.lower() for r in raw]  # of bytes: ASCII only
        self.data = b"\n".join(raw) + b"\n" + b"\0" * 8
        sizes = np.fromiter(map(len, raw), dtype=np.int64, count=len(raw)) + 1
        del raw
        self.base = np.concatenate([[0], np.cumsum(sizes)])  # where each text starts
        a = np.frombuffer(self.data, dtype=np.uint8, count=len(self.data) - 8)
        inside = ~_IS_SPACE[a]
        edge = np.flatnonzero(np.diff(inside.view(np.int8), prepend=0, append=0))
        self.start, self.end = edge[::2], edge[1::2]
        self.first = np.searchsorted(self.start, self.base)
        self.text = np.repeat(np.arange(len(texts)), np.diff(self.first))

    def __len__(self) -> int:
        return len(self.start)

    def spaced(self) -> tuple[pa.Array, np.ndarray, bytes]:
        """The words as an Arrow array, each with one space behind it, where each begins in
        their bytes (and where the last ends), and these bytes."""
        a = np.frombuffer(self.data, dtype=np.uint8)
        step = np.zeros(len(a) + 1, dtype=np.int8)
        step[self.start] = 1
        step[self.end + 1] -= 1  # the byte behind a word is white space: it goes along
        own = a[np.cumsum(step[:-1], dtype=np.int8).view(bool)]
        begin = np.r_[0, np.cumsum(self.end - self.start + 1)]
        own[begin[1:] - 1] = 0x20
        data = own.tobytes()
        return pa.Array.from_buffers(pa.large_binary(), len(self), [None, pa.py_buffer(begin), pa.py_buffer(data)]), begin, data

    def hashes(self, seed: int = 0) -> np.ndarray:
        """Eight bytes at a time; every step mixes by a bijection, so words of up to eight
        bytes and one length never collide."""
        eight = np.ndarray((len(self.data) - 7,), dtype="<u8", buffer=self.data, strides=(1,))
        length = self.end - self.start
        h = mix64(length.astype(np.uint64) + np.uint64(seed))
        rows, at = np.arange(len(self)), 0
        while len(rows):
            left = length[rows] - at
            lane = eight[self.start[rows] + at] & _LOW[np.minimum(left, 8)]
            h[rows] = mix64(h[rows] ^ lane) + _M2
            rows, at = rows[left > 8], at + 8
        return h


def window_hashes(word_hash: np.ndarray, size: int, multiplier: int) -> np.ndarray:
    """Hash of each run of ``size`` words (a polynomial over mixed word hashes, mixed again)."""
    n = len(word_hash) - size + 1
    if n <= 0:
        return np.empty(0, dtype=np.uint64)
    h, b = np.zeros(n, dtype=np.uint64), np.uint64(multiplier | 1)
    for k in range(size):
        h *= b
        h += word_hash[k:k + n]
    return mix64(h)
