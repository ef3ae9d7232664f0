"""Sentencepiece encoding and decoding through tables of distinct chunks.

The model marks white space with U+2581, puts one mark in front of a text and has no piece with a mark after another
character. So no piece crosses from a word into the next mark, and a text falls into chunks, each a run of marks with
the word behind it, that are segmented alone. A worker segments every distinct chunk once (a table of chunk, ids) and
joins the ids back to the texts by position; decoding cuts the ids before every piece that begins with a mark and
looks each distinct run of ids up in a table in the same way. A table starts anew when it holds ``TABLE`` chunks and
chunks of over ``KEPT_CHARS`` characters are not kept, which bounds memory and changes no result. A long text is
looked up by blocks.

A model whose pieces do cross marks, or that changes white space, has one chunk per text.

The distinct chunks are those of a worker: one table for the whole corpus would shuffle every word of every text, and
grow with the corpus. Such a table saves a worker the segmentation of a chunk that another worker knows, no more.

Defined cases: null and empty texts have the end id only, and decode to an empty text; control strings inside a text
are plain text; characters that are no piece become bytes; U+2581 in a text counts as a blank, as in the library;
repeated rows are rows of their own; a null doc_id is kept; an empty table gives no rows; other columns are ignored.
Texts of any length are encoded whole.
"""

from __future__ import annotations

import re
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import slices, text_of, utf8_column, worker_state

MARK = "▁"
MODEL = "piece_bpe_32k.model"
TABLE = 500_000
KEPT_CHARS = 48
#: Characters, or runs of ids, that are looked up at once.
BLOCK = 1 << 18
#: Ids in one record batch of a task, about.
SENT_IDS = 1 << 20


_CHUNK = re.compile(" ([ ]*[^ ]*)")
_NEXT = re.compile("(?<! ) ")


def chunk_blocks(marked: str) -> Iterator[list[str]]:
    """The chunks of a text that begins with its mark (a blank stands for it), each without its first mark, by blocks
    of about ``BLOCK`` characters."""
    at = 0
    while at < len(marked):
        cut = _NEXT.search(marked, at + BLOCK)
        end = cut.start() if cut else len(marked)
        block = marked[at:end]
        yield _CHUNK.findall(block) if "  " in block else block[1:].split(" ")
        at = end


class Pieces:
    """A sentencepiece model with its tables of distinct chunks."""

    def __init__(self, model_file: str, table: int = TABLE):
        from sentencepiece import SentencePieceProcessor

        self.model = SentencePieceProcessor(model_file=model_file)
        names = [self.model.id_to_piece(i) for i in range(self.model.get_piece_size())]
        self.end = self.model.eos_id()
        probe = " a  b　 "
        self.cuts = not any(MARK in p.lstrip(MARK) for p in names) and self.model.decode(self.model.encode(probe)) == probe
        self.begins = np.array([p.startswith(MARK) for p in names])
        self.control = np.array([self.model.is_control(i) for i in range(len(names))])
        # texts of ordinary pieces; None for bytes, control pieces and the unknown piece, which the library decodes
        m = self.model
        self.spelt = [None if m.is_byte(i) or m.is_control(i) or m.is_unknown(i) or m.is_unused(i) else p.replace(MARK, " ")
                      for i, p in enumerate(names)]
        self.mark_id = self.model.piece_to_id(MARK)
        self.limit = table
        self.ids: dict[str, bytes] = {}  # chunk without its first mark: int32 ids
        self.texts: dict[bytes, str] = {}  # int32 ids: text without its first blank

    def _many(self, chunks: list[str]) -> list[bytes]:
        """The ids of chunks that have one mark each, from one call of the library: a chunk's ids begin where a piece
        begins with a mark."""
        ids = np.array(self.model.encode(" ".join(chunks), num_threads=1), np.int32)
        cuts = np.append(np.flatnonzero(self.begins[ids]) * 4, 4 * len(ids)).tolist()
        raw = ids.tobytes()
        return [raw[i:j] for i, j in zip(cuts, cuts[1:])]

    def segment(self, chunks: list[str]) -> dict[str, bytes]:
        """The ids of chunks, given without their first mark, by the library, which puts that mark in front. The mark
        alone is its piece."""
        plain = [c for c in chunks if c and c[0] != " "]
        made = dict(zip(plain, self._many(plain))) if plain else {}
        for c in chunks:
            if c not in made:
                made[c] = array("i", self.model.encode(c) if c else [self.mark_id]).tobytes()
        return made

    def spell(self, runs: list[bytes]) -> dict[bytes, str]:
        """The texts of runs of ids, without the blank of a first mark: pieces joined, or by the library where a piece
        has no spelling of its own."""
        made, get = {}, self.spelt.__getitem__
        for r in runs:
            ids = memoryview(r).cast("i").tolist()
            try:
                text = "".join(map(get, ids))
                made[r] = text[1:] if text[:1] == " " else text
            except TypeError:
                made[r] = self.model.decode(ids)
        return made

    def _known(self, table: dict, keys: list, make, most: int):
        """The values of ``keys`` in order, out of the table, which gets the distinct new keys first. Keys longer than
        ``most`` are not kept."""
        new = [k for k in set(keys) if k not in table]
        if not new:
            return map(table.__getitem__, keys)
        if len(table) + len(new) > self.limit:
            table.clear()
            new = list(set(keys))
        made = make(new)
        long = {k: v for k, v in made.items() if len(k) > most}
        if not long:
            table.update(made)
            return map(table.__getitem__, keys)
        table.update((k, v) for k, v in made.items() if k not in long)
        return (long[k] if k in long else table[k] for k in keys)

    def encode(self, text: str | None) -> np.ndarray:
        """All ids of a text and the end id."""
        parts = []
        if text and not self.cuts:
            parts.append(np.array(self.model.encode(text), np.int32))
        elif text:
            for chunks in chunk_blocks(" " + text.replace(MARK, " ")):
                parts.append(np.frombuffer(b"".join(self._known(self.ids, chunks, self.segment, KEPT_CHARS)), np.int32))
        return np.concatenate([*parts, np.array([self.end], np.int32)])

    def decode(self, ids: np.ndarray) -> str:
        """The text of ``ids``. A run of ids after the first begins with a mark, which its text leaves out, so runs are
        joined with a blank."""
        ids = np.ascontiguousarray(ids, np.int32)
        if not len(ids):
            return ""
        if not self.cuts:
            return self.model.decode(ids.tolist())
        at = np.flatnonzero(self.begins[ids])
        spoken = np.flatnonzero(~self.control[ids])
        first = int(spoken[0]) if len(spoken) else len(ids)
        at = np.concatenate(([0], at[at > first], [len(ids)])) * 4
        raw, out = ids.tobytes(), []
        for a in range(0, len(at) - 1, BLOCK):
            edges = at[a : a + BLOCK + 1].tolist()
            runs = [raw[i:j] for i, j in zip(edges, edges[1:])]
            out.extend(self._known(self.texts, runs, self.spell, 4 * KEPT_CHARS))
        return " ".join(out)


def _pieces(model_name: str) -> Pieces:
    def load():
        import public_tokenizers

        return Pieces(public_tokenizers.path(model_name))

    return worker_state(f"pieces:{model_name}", load)


def _encode_task(model_name: str):
    def send(doc_ids, found):
        flat = np.concatenate(found)
        ends = np.concatenate(([0], np.cumsum([len(f) for f in found]))).astype(np.int32)
        return pa.RecordBatch.from_arrays([doc_ids, pa.ListArray.from_arrays(pa.array(ends), pa.array(flat))], ["doc_id", "ids"])

    def task(rows):
        pieces = _pieces(model_name)
        for batch in rows:
            found, size, begin = [], 0, 0
            for k, text in enumerate(batch.column(1)):
                found.append(pieces.encode(text.as_py()))
                size += len(found[-1])
                if size >= SENT_IDS or k == batch.num_rows - 1:
                    yield send(batch.column(0).slice(begin, k + 1 - begin), found)
                    found, size, begin = [], 0, k + 1

    return task


def _decode_task(model_name: str):
    def task(rows):
        pieces = _pieces(model_name)
        for batch in rows:
            lists = batch.column(1)
            flat, ends = lists.values.to_numpy(zero_copy_only=False), lists.offsets.to_numpy()
            for i, j in slices(ends.astype(np.int64), SENT_IDS) if batch.num_rows else ():
                texts = [pieces.decode(flat[a:b]) for a, b in zip(ends[i:j], ends[i + 1 : j + 1])]
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(i, j - i), lists.slice(i, j - i), pa.array(texts, pa.string())],
                    ["doc_id", "ids", "text"])

    return task


def encode(docs: DataFrame, model_name: str = MODEL) -> DataFrame:
    """(doc_id, ids) for every row of ``docs`` (doc_id, text): the ids of the whole text and the end id. ``model_name``
    is a file of the tokenizer package that the workers have installed."""
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_of().alias("text"))
    return rows.mapInArrow(_encode_task(model_name), "doc_id long, ids array<int>")


def decode(encoded: DataFrame, model_name: str = MODEL) -> DataFrame:
    """(doc_id, ids, text) for every row of ``encoded`` (doc_id, ids); null ids have an empty text."""
    ids = F.coalesce(F.col("ids").cast("array<int>"), F.array().cast("array<int>"))
    rows = encoded.select(F.col("doc_id").cast("long").alias("doc_id"), ids.alias("ids"))
    return rows.mapInArrow(_decode_task(model_name), "doc_id long, ids array<int>, text string")


def digests(decoded: DataFrame) -> DataFrame:
    """The number of ids and digests of ids and text."""
    return decoded.select(
        "doc_id", F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), " "), 256).alias("ids_sha256"),
        F.sha2("text", 256).alias("decoded_sha256"))
