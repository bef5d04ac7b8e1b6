"""Exact byte-pair encoding by dynamic programming over prefixes, and its inverse.

For every prefix of a piece there is exactly one token that can end the encoding of that prefix.
An automaton over all vocabulary tokens reports, for every end position, the tokens that end
there (longest first). A token t that covers bytes j..i is the last token of prefix i if it is
compatible with the stored last token of prefix j, that is, if merging the bytes of the two by
the merge rules gives back the two. Following the stored tokens back from the end gives the ids.
No merge loop over the piece takes place, and the work is linear in its length times the number
of tokens ending at one place.

Compatibility of a pair is decided on the merge trees: only subtokens at the right edge of the
left token and at the left edge of the right token can ever meet at the border, each during the
span of ranks in which it stands there. The pair is compatible if no merge rule joins two such
subtokens while both stand.

The tokenizer file (byte-level BPE) is a parameter and is read on each Python worker.
"""

from __future__ import annotations

import json
from array import array
from collections.abc import Iterator

import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sparkwright.llm.common import ids_and_texts

#: Pieces of a byte-level tokenizer (a fixed value of the file format).
PIECES = (r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\p{White_Space}\p{L}\p{N}]+"
          r"|\p{White_Space}+(?!\P{White_Space})|\p{White_Space}+")
#: Memory bounds of a worker: pieces and pairs remembered before the memory starts anew.
MOST_PIECES, MOST_PAIRS = 600_000, 600_000
NEVER = 1 << 60


def byte_characters() -> dict[str, int]:
    """The file format's printable character for every byte, as character -> byte."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    hidden = [b for b in range(256) if b not in set(shown)]
    return {chr(b): b for b in shown} | {chr(256 + k): b for k, b in enumerate(hidden)}


class Encoder(dict):
    """Maps a piece to its ids (little-endian unsigned 32-bit); missing pieces are encoded."""

    def __init__(self, path: str):
        super().__init__()
        import ahocorasick
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        to_byte = byte_characters()
        raw = lambda s: bytes(to_byte[c] for c in s)
        vocab = spec["model"]["vocab"]
        self.bytes_of: dict[int, bytes] = {i: raw(s) for s, i in vocab.items()}
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.merges: dict[tuple[int, int], int] = {}
        self.parts: dict[int, tuple[int, int, int]] = {}
        for rank, pair in enumerate(spec["model"]["merges"]):
            a, b = pair if isinstance(pair, list) else pair.split(" ")
            ids = vocab[a], vocab[b]
            self.merges[ids] = rank
            self.parts.setdefault(vocab[a + b], (*ids, rank))
        self.automaton = ahocorasick.Automaton()
        for i, b in self.bytes_of.items():
            self.automaton.add_word(b.decode("latin-1"), (len(b), i))
        self.automaton.make_automaton()
        self.bytes_of |= {i: s.encode() for s, i in self.special.items()}
        self.pieces = regex.compile(PIECES)
        self.cut = regex.compile("(" + "|".join(regex.escape(s) for s in self.special) + ")") if self.special else None
        self.pairs: dict[int, bool] = {}
        self.edges: tuple[dict, dict] = ({}, {})

    def edge(self, token: int, side: int) -> list[tuple[int, int]]:
        """Subtokens at the left (0) or right (1) edge, smallest first, each with the rank of the
        merge that takes it up."""
        known = self.edges[side].get(token)
        if known is None:
            chain, until = [], NEVER
            t = token
            while True:
                chain.append((t, until))
                if t not in self.parts:
                    break
                until = self.parts[t][2]
                t = self.parts[t][side]
            known = self.edges[side][token] = chain[::-1]
        return known

    def compatible(self, left: int, right: int) -> bool:
        a, b, i, j = self.edge(left, 1), self.edge(right, 0), 0, 0
        while True:
            (x, x_until), (y, y_until) = a[i], b[j]
            rank = self.merges.get((x, y), NEVER)
            # at equal ranks the leftmost merge goes first
            if rank < x_until and rank <= y_until and rank < NEVER:
                return False
            if x_until == NEVER and y_until == NEVER:
                return True
            if x_until <= y_until:
                i += 1
            else:
                j += 1

    def encode_bytes(self, piece: bytes) -> list[int]:
        last: list[int] = [-1] * (len(piece) + 1)  # last token of each prefix
        at, pairs = 0, self.pairs
        for end, (size, token) in self.automaton.iter(piece.decode("latin-1")):
            end += 1
            if last[end] >= 0:  # a longer token ends here already
                continue
            before = end - size
            if not before:
                last[end] = token
                continue
            left = last[before]
            key = left << 32 | token
            fits = pairs.get(key)
            if fits is None:
                if len(pairs) >= MOST_PAIRS:
                    pairs.clear()
                fits = pairs[key] = self.compatible(left, token)
            if fits:
                last[end] = token
        ids, at = [], len(piece)
        while at:
            ids.append(last[at])
            at -= len(self.bytes_of[last[at]])
        return ids[::-1]

    def __missing__(self, piece: str) -> bytes:
        if len(self) >= MOST_PIECES:
            self.clear()
        ids = array("I", self.encode_bytes(piece.encode("utf-8", "surrogatepass"))).tobytes()
        self[piece] = ids
        return ids

    def encode(self, text: str) -> bytes:
        if self.cut is None or not any(s in text for s in self.special):
            return b"".join(map(self.__getitem__, self.pieces.findall(text)))
        out = []
        for k, part in enumerate(self.cut.split(text)):
            if k % 2:
                out.append(array("I", [self.special[part]]).tobytes())
            elif part:
                out.extend(map(self.__getitem__, self.pieces.findall(part)))
        return b"".join(out)

    def decode(self, ids: bytes) -> str:
        return b"".join(map(self.bytes_of.__getitem__, array("I", ids))).decode("utf-8", "replace")


_ENCODERS: dict[str, Encoder] = {}


def encoder(path: str) -> Encoder:
    if path not in _ENCODERS:
        _ENCODERS[path] = Encoder(path)
    return _ENCODERS[path]


def _rows(batches: Iterator[pa.RecordBatch], most: int = 2_000_000) -> Iterator[pa.RecordBatch]:
    """Batches cut to about ``most`` bytes each."""
    for b in batches:
        step = max(1, int(b.num_rows * most / max(1, b.nbytes)))
        for at in range(0, b.num_rows, step):
            yield b.slice(at, step)


def encode(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, n_tokens, ids): ids of every whole text as little-endian unsigned 32-bit integers.

    Null texts are read as empty and give no tokens; special tokens' strings in a text give their
    ids. Rows stay one for one; other columns are left behind.
    """
    def run(batches):
        enc = encoder(path)
        for b in _rows(batches):
            ids = [enc.encode(t) for t in b.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [b.column(0), pa.array([len(x) // 4 for x in ids], pa.int64()), pa.array(ids, pa.binary())],
                ["doc_id", "n_tokens", "ids"])
    return ids_and_texts(docs, id_col, text_col).mapInArrow(run, "doc_id long, n_tokens long, ids binary")


def decode(encoded: DataFrame, path: str) -> DataFrame:
    """Add ``decoded``, the text that the ids stand for (bytes that are no UTF-8: U+FFFD)."""
    def run(batches):
        enc = encoder(path)
        for b in _rows(batches):
            texts = [enc.decode(x) for x in b.column(2).to_pylist()]
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(texts, pa.string())],
                                             [*b.schema.names, "decoded"])
    return encoded.select("doc_id", "n_tokens", "ids").mapInArrow(
        run, "doc_id long, n_tokens long, ids binary, decoded string")


def round_trip(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, n_tokens, ids, decoded): :func:`encode`, then :func:`decode` of the ids it gave, by
    one Python worker of each task."""
    def run(batches):
        enc = encoder(path)
        for b in _rows(batches):
            ids = [enc.encode(t) for t in b.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [b.column(0), pa.array([len(x) // 4 for x in ids], pa.int64()), pa.array(ids, pa.binary()),
                 pa.array(map(enc.decode, ids), pa.string())], ["doc_id", "n_tokens", "ids", "decoded"])
    return ids_and_texts(docs, id_col, text_col).mapInArrow(
        run, "doc_id long, n_tokens long, ids binary, decoded string")


def digests(docs: DataFrame, path: str) -> DataFrame:
    """Per document: token count and SHA-256 of ids and of the decoded text."""
    return round_trip(docs, path).select(
        "doc_id", "n_tokens", F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"))
