"""Token counts: batch encoding in Arrow functions that return lengths only (operator 5)."""

from __future__ import annotations

import os
import re
from array import array
from collections.abc import Iterator
from itertools import accumulate, chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from caudal.llm.common import parts

#: Bytes of text encoded at once: batches are cut by bytes, not by rows.
BATCH_BYTES = 4 << 20
#: Distinct pieces whose encoding a Python worker keeps, at about 250 bytes each; the batch after starts anew.
KEPT_PIECES = 300_000

# A cut before a space or line break that follows another character is safe: no token of the byte-level
# pattern reaches over it; nor does one from a letter or digit to a stop or comma.  Texts with other white space
# are only cut after a visible ASCII character.
_PIECE = re.compile(r"[ \n]*[^\W_]++(?=[.,])|[ \n]*[^ \n]+|[ \n]+")
_OTHER_ASCII = "\t\r\x0b\x0c\x1c\x1d\x1e\x1f"
_OTHER_SPACE = re.compile(r"[^\S \n]|[\x1c-\x1f\x85]")
_SAFE_CUT = re.compile(r"(?<=[!-~])(?=[ \n])")


def safe_pieces(text: str) -> list[str]:
    """The text cut where tokens always end; the pieces joined give the text again."""
    if any(c in text for c in _OTHER_ASCII) if text.isascii() else _OTHER_SPACE.search(text):
        return [x for x in _SAFE_CUT.split(text) if x]
    return _PIECE.findall(text)


class PieceTable(dict):
    """Pieces numbered as they come, with the encoding of each: one look-up a piece, unknown ones encoded together."""

    def __init__(self, path: str, with_ids: bool):
        self.with_ids, self.whole_texts = with_ids, path.endswith(".model")
        self.unknown: list[str] = []
        self.ids, self.ends = array("I"), array("q", [0])
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        if self.whole_texts:
            import sentencepiece

            model = sentencepiece.SentencePieceProcessor(model_file=path)
            self.encode = lambda texts: model.encode(texts, num_threads=1)
        else:
            from tokenizers import Tokenizer

            model = Tokenizer.from_file(path)
            model.no_truncation()
            model.no_padding()
            self.encode = lambda texts: [x.ids for x in model.encode_batch_fast(texts, add_special_tokens=False)]

    def __missing__(self, piece: str) -> int:
        self.unknown.append(piece)
        self[piece] = number = len(self)
        return number

    def numbers(self, lists: list[list[str]], most: int) -> np.ndarray:
        """The number of every piece of a batch.  A table of more than ``most`` pieces (or of whole texts) starts anew."""
        if len(self) > most or self.whole_texts:
            self.clear()
            self.ids, self.ends = array("I"), array("q", [0])
        found = np.fromiter(map(self.__getitem__, chain.from_iterable(lists)), np.int64, sum(map(len, lists)))
        for i in range(0, len(self.unknown), 20_000):
            encoded = self.encode(self.unknown[i : i + 20_000])
            if self.with_ids:
                self.ids.extend(chain.from_iterable(encoded))
            self.ends.extend(accumulate(map(len, encoded), initial=self.ends.pop()))
        self.unknown.clear()
        return found

    def batch(self, lists: list[list[str]], most: int) -> tuple[np.ndarray, np.ndarray | None]:
        """Token bounds of the texts of a batch, given as pieces, and (``with_ids``) the ids of all in a row."""
        found = self.numbers(lists, most)
        ends = np.frombuffer(self.ends, dtype=np.int64)
        sizes = np.diff(ends)[found]
        reached = np.zeros(len(found) + 1, dtype=np.int64)
        np.cumsum(sizes, out=reached[1:])
        bounds = reached[np.cumsum([0, *map(len, lists)])]
        if not self.with_ids:
            return bounds, None
        at = np.arange(reached[-1]) + np.repeat(ends[found] - reached[:-1], sizes)
        return bounds, np.frombuffer(self.ids, dtype=np.uint32)[at] if len(at) else np.zeros(0, dtype=np.uint32)


_tables: dict[tuple[str, bool], PieceTable] = {}


def piece_table(path: str, with_ids: bool) -> PieceTable:
    """One table for a tokenizer file, kept while the Python worker lives."""
    if (path, with_ids) not in _tables:
        _tables[path, with_ids] = PieceTable(path, with_ids)
    return _tables[path, with_ids]


def cut(path: str, text: str) -> list[str]:
    """Pieces for a tokenizer: sentencepiece puts a mark before each text, so its texts stay whole."""
    return [text] if path.endswith(".model") else safe_pieces(text)


def count_tokens(docs: DataFrame, tokenizer_path: str, limit: int = 512, kept: int = KEPT_PIECES) -> DataFrame:
    """``doc_id, n_bytes, n_tokens, over_limit`` for every row; texts never leave the task.

    The scan is the only stage.  Each Arrow batch is cut by bytes, long texts are cut where tokens
    always end, and every distinct piece of a batch is encoded once, all in one call.
    ``kept`` bounds the pieces a worker remembers (memory against time, the result is the same).
    NULL text counts as empty (0 bytes, 0 tokens); a NULL id stays NULL; repeated rows give
    repeated results; other columns are never read; an empty table gives an empty result.
    """

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = piece_table(tokenizer_path, False)
        for batch in parts(batches, BATCH_BYTES):
            lists = [cut(tokenizer_path, x or "") for x in batch.column("text").to_pylist()]
            bounds, _ = known.batch(lists, kept)
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(np.diff(bounds)), batch.column("n_bytes")],
                ["doc_id", "n_tokens", "n_bytes"],
            )

    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text.alias("text"), F.octet_length(text).cast("long").alias("n_bytes"))
    counted = rows.mapInArrow(count, "doc_id long, n_tokens long, n_bytes long")
    return counted.select("doc_id", "n_bytes", "n_tokens", (F.col("n_tokens") > limit).alias("over_limit"))
