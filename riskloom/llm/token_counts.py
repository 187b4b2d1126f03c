"""Exact token counts at every prefix of a text, by dynamic programming over byte-pair tokens.

For byte-pair encoding the encoding of a prefix ends in exactly one token, and a token may follow
the last token of a shorter prefix exactly if the two, encoded together, stay those two tokens. So
one pass over a pre-token finds the last token, and with it the token count, of every prefix of it.
Counts of a text add up over its pre-tokens; the only prefixes whose pre-tokens differ from those of
the whole text end inside a run of white space or inside a pre-token, and both are worked out here.
The table of a text (one count per code point) then answers truncation and budget questions by search.
"""

from __future__ import annotations

import hashlib
import json
from array import array
from collections.abc import Iterator
from itertools import pairwise

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskloom.llm.common import kept_in_worker, text_batches

#: Fixed value: the split of byte-level pre-tokenizers.
SPLIT = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
SCHEMA = "doc_id long, n_bytes long, n_tokens long, kept_chars long"
TABLE_SCHEMA = "doc_id long, n_bytes long, n_tokens long, steps binary"
#: Bounds of what a task remembers; beyond them it computes anew.
REMEMBERED_PIECES, REMEMBERED_PAIRS, LONGEST_REMEMBERED = 600_000, 1_000_000, 64


def byte_alphabet() -> dict[str, int]:
    """The printable stand-in of every byte in byte-level vocabularies: printable ones stand for themselves."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    others = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(others)}


class Vocabulary:
    """Tokens, merge ranks and whole special strings of a byte-level BPE file."""

    def __init__(self, spec: str):
        data = json.loads(spec)
        alphabet = byte_alphabet()
        raw = lambda token: bytes(alphabet[c] for c in token)
        special = {t["content"] for t in data["added_tokens"]}
        self.special = sorted(special, key=len, reverse=True)
        self.tokens = {raw(t) for t in data["model"]["vocab"] if t not in special}
        merges = (m.split(" ") if isinstance(m, str) else m for m in data["model"]["merges"])
        self.ranks = {(raw(a), raw(b)): rank for rank, (a, b) in enumerate(merges)}
        self.longest = max(map(len, self.tokens))
        self.split = regex.compile(SPLIT)
        self.cut = regex.compile("(" + "|".join(map(regex.escape, self.special)) + ")") if special else None
        self.pairs: dict[tuple[bytes, bytes], bool] = {}
        self.pieces: dict[str, bytes] = {}

    def encode(self, data: bytes) -> list[bytes]:
        """Plain byte-pair merging; only ever asked for the bytes of two tokens."""
        parts = [data[i : i + 1] for i in range(len(data))]
        while len(parts) > 1:
            rank, at = min((self.ranks.get((parts[i], parts[i + 1]), 1 << 60), i) for i in range(len(parts) - 1))
            if rank == 1 << 60:
                break
            parts[at : at + 2] = [parts[at] + parts[at + 1]]
        return parts

    def follows(self, left: bytes, right: bytes) -> bool:
        """Whether the two tokens (or the second alone, if the first is empty) stay as they are when encoded together."""
        known = self.pairs.get((left, right))
        if known is None:
            if len(self.pairs) >= REMEMBERED_PAIRS:
                self.pairs.clear()
            known = self.pairs[left, right] = self.encode(left + right) == ([left, right] if left else [right])
        return known

    def byte_counts(self, data: bytes) -> list[int]:
        """Token count of every byte prefix of one pre-token: entry i is that of ``data[:i]``."""
        counts, last, tokens, pairs = [0], [b""], self.tokens, self.pairs
        for end in range(1, len(data) + 1):
            for start in range(max(0, end - self.longest), end):
                token = data[start:end]
                if token in tokens:
                    fits = pairs.get((last[start], token))
                    if fits is None:
                        fits = self.follows(last[start], token)
                    if fits:
                        counts.append(counts[start] + 1)
                        last.append(token)
                        break
            else:
                raise ValueError("no token ends at this byte: the vocabulary lacks a byte")
        return counts

    def steps(self, piece: str) -> bytes:
        """Change of the count with each code point of a pre-token, as 16-bit numbers."""
        known = self.pieces.get(piece)
        if known is None:
            known = packed(self._char_counts(piece))
            if len(piece) <= LONGEST_REMEMBERED:
                if len(self.pieces) >= REMEMBERED_PIECES:
                    self.pieces.clear()
                self.pieces[piece] = known
        return known

    def _char_counts(self, piece: str) -> list[int]:
        out = self.byte_counts(piece.encode())
        if not piece.isascii():
            ends, at = [0], 0
            for char in piece:
                at += len(char.encode())
                ends.append(at)
            out = [out[i] for i in ends]
        if piece[0] == "'":  # a contraction cut short is other pre-tokens
            for place in range(1, len(piece)):
                out[place] = sum(self.byte_counts(p.encode())[-1] for p in self.split.findall(piece[:place]))
        return out

    def plain_steps(self, pieces: list[str]) -> list[bytes]:
        """Steps of the pre-tokens of a text without special strings."""
        known, steps = self.pieces.get, self.steps
        out = [known(p) or steps(p) for p in pieces]
        runs = [i for i, p in enumerate(pieces) if p.isspace()]
        for i in (i + 1 for i in runs if i + 1 < len(pieces)):
            # A cut after the last character of a white-space run joins that character to the run before it.
            if pieces[i][0].isspace():
                before = unpacked(out[i - 1]).sum()
                joined = unpacked(self.steps(pieces[i - 1] + pieces[i][0])).sum() - before
                both = unpacked(out[i] + (out[i + 1] if i + 1 < len(pieces) else b"")).copy()
                if len(both) > 1:
                    both[1] += both[0] - joined
                both[0] = joined
                size = len(pieces[i])
                out[i] = both[:size].astype(np.int16).tobytes()
                if i + 1 < len(pieces):
                    out[i + 1] = both[size:].astype(np.int16).tobytes()
        return out

    def prefix_counts(self, text: str) -> np.ndarray:
        """Entry i is the exact token count of the first i code points, entry 0 is 0."""
        out, tail = [b""], ""
        for part in self.cut.split(text) if self.cut else [text]:
            if not part:
                continue
            if part in self.special:  # whole it is one token; cut short it is plain text, joined to what stands before
                own = np.cumsum(unpacked(b"".join(self.plain_steps(self.split.findall(tail + part)))))[len(tail) :]
                start = int(unpacked(self.steps(tail)).sum()) if tail else 0
                out.append(packed([0, *(int(x) - start for x in own[:-1]), 1]))
                tail = ""
            else:
                pieces = self.split.findall(part)
                out += self.plain_steps(pieces)
                tail = pieces[-1]
        return np.concatenate([[0], np.cumsum(unpacked(b"".join(out)))])


def packed(counts: list[int]) -> bytes:
    return array("h", [b - a for a, b in pairwise(counts)]).tobytes()


def unpacked(steps: bytes) -> np.ndarray:
    return np.frombuffer(steps, np.int16).astype(np.int64)


def longest_within(counts: np.ndarray, limit: int) -> int:
    """Code points of the longest prefix that has at most ``limit`` tokens."""
    return int(np.flatnonzero(counts <= limit)[-1])


def _over(docs: DataFrame, tokenizer_path: str, schema: str, row) -> DataFrame:
    with open(tokenizer_path, encoding="utf-8") as file:
        spec = file.read()
    digest = hashlib.sha256(spec.encode()).hexdigest()
    shared = docs.sparkSession.sparkContext.broadcast(spec)  # one vocabulary file, about 2 MB

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocabulary = kept_in_worker(("vocabulary", digest), lambda: Vocabulary(shared.value))
        names = [part.split()[0] for part in schema.split(", ")]
        kinds = {"long": pa.int64(), "binary": pa.binary()}
        types = [kinds[part.split()[1]] for part in schema.split(", ")]
        for batch in text_batches(batches):
            rows = []
            for doc_id, text in zip(batch["doc_id"].to_pylist(), batch["text"].to_pylist(), strict=True):
                text = text or ""
                rows.append((doc_id, len(text.encode()), *row(vocabulary.prefix_counts(text))))
            columns = list(zip(*rows, strict=True)) or [()] * len(names)
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types, strict=True)], names)

    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(run, schema)


def prefix_tables(docs: DataFrame, tokenizer_path: str) -> DataFrame:
    """One row per document row with its prefix table as 16-bit steps, one per code point.

    Null or empty text: no steps, no tokens. Repeated rows give repeated results; other columns are ignored.
    """
    return _over(docs, tokenizer_path, TABLE_SCHEMA, lambda counts: (int(counts[-1]), np.diff(counts).astype(np.int16).tobytes()))


def read_table(steps: bytes) -> np.ndarray:
    """Counts of all prefixes from a stored table."""
    return np.concatenate([[0], np.cumsum(unpacked(steps))])


def token_counts(docs: DataFrame, tokenizer_path: str, limit: int = 512) -> DataFrame:
    """Tokens of every whole text and where a budget of ``limit`` tokens ends, both read off its prefix table.

    Returns doc_id, n_bytes, n_tokens, over_limit and kept_chars (code points of the longest prefix within the
    limit). Null or empty text: zeros, not over the limit. A null doc_id is kept. One result row per input row.
    """
    counted = _over(docs, tokenizer_path, SCHEMA, lambda counts: (int(counts[-1]), longest_within(counts, limit)))
    return counted.select("doc_id", "n_bytes", "n_tokens", (F.col("n_tokens") > limit).alias("over_limit"), "kept_chars")
