"""Token counts by byte-pair merging with a heap and a linked list, no identifiers made.

The vocabulary is a sentencepiece BPE model with byte fallback: text gets a blank in front, blanks become U+2581, and
the adjacent pair of symbols whose join is the piece of lowest rank merges first, the leftmost of equals. Symbols
start as characters; the count is their number less the merges, a character that is no piece counting its UTF-8
bytes. No piece has U+2581 after another character, and a character that is in no longer piece never merges, so the
text falls into segments that are counted alone (also at a mark that no piece has after a letter); a worker keeps the counts of segments it has met (``CACHE`` at most,
which bounds memory only).

Defined cases: null and empty texts have 0 tokens; control strings inside a text are plain text; repeated rows count
each; a null doc_id is kept; an empty table gives no rows; other columns are ignored. Texts of any length are counted
whole.
"""

from __future__ import annotations

import re
from heapq import heapify, heappop, heappush
from operator import add

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import worker_state

BLANK = "▁"
CACHE = 1_000_000
KEPT_CHARS = 32
LIMIT = 4096


def _set(chars: set[str]) -> str:
    return "".join(re.escape(c) for c in sorted(chars))


class Merges:
    """The pieces of a model with their ranks."""

    def __init__(self, model_file: str):
        from sentencepiece import SentencePieceProcessor

        model = SentencePieceProcessor(model_file=model_file)
        n = model.get_piece_size()
        plain = [i for i in range(n) if not (model.is_unknown(i) or model.is_control(i) or model.is_byte(i) or model.is_unused(i))]
        scores = {model.id_to_piece(i): model.get_score(i) for i in plain}
        # the higher the score, the lower the rank; equal scores share one, so the leftmost pair goes first
        order = {s: r for r, s in enumerate(sorted(set(scores.values()), reverse=True))}
        self.rank = {p: order[s] for p, s in scores.items()}
        longer = [p for p in self.rank if len(p) > 1]
        joined = set("".join(longer)) - {BLANK}
        letters = {c for c in joined if c.isalpha()}
        others = joined - letters
        # characters that some piece has right after a letter; before any other mark a segment ends
        tied = {q for p in longer for c, q in zip(p, p[1:]) if c in letters and q in others}
        if any(BLANK in p.lstrip(BLANK) for p in longer):  # then segments run on over blanks
            self.segments = re.compile(f"[{BLANK}{_set(joined)}]+|[^{BLANK}{_set(joined)}]")
        else:
            word = f"[{_set(letters)}]+"
            if tied:
                word = f"(?:{word}(?:[{_set(tied)}][{_set(others)}]*)?)+"
            self.segments = re.compile(
                f"{BLANK}*[{_set(others)}]*{word}|{BLANK}*[{_set(others)}]+|{BLANK}+|[^{BLANK}{_set(joined)}]")
        self.known: dict[str, int] = {}

    def merged(self, text: str) -> int:
        """Symbols left after all merges of one segment, by a heap of pairs over a linked list of symbols."""
        ranks = self.rank.get
        symbol = list(text)
        n = len(symbol)
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        heap = []
        for i, piece in enumerate(map(add, symbol, symbol[1:])):
            if (r := ranks(piece)) is not None:
                heap.append((r, i, piece))
        heapify(heap)
        count = n
        while heap:
            _, i, piece = heappop(heap)
            j = after[i]
            if j >= n or symbol[i] + symbol[j] != piece:  # one of the two has merged meanwhile
                continue
            symbol[i] = piece
            symbol[j] = None
            count -= 1
            k = after[i] = after[j]
            after[j] = n
            if k < n:
                before[k] = i
                if (r := ranks(found := piece + symbol[k])) is not None:
                    heappush(heap, (r, i, found))
            h = before[i]
            if h >= 0 and (r := ranks(found := symbol[h] + piece)) is not None:
                heappush(heap, (r, h, found))
        rank = self.rank
        return count + sum(len(s.encode("utf-8", "replace")) - 1 for s in symbol if s and s not in rank)

    def count(self, text: str | None) -> int:
        if not text:
            return 0
        known, total = self.known, 0
        for s in self.segments.findall(BLANK + text.replace(" ", BLANK)):
            n = known.get(s)
            if n is None:
                n = self.merged(s)
                if len(known) < CACHE and len(s) <= KEPT_CHARS:
                    known[s] = n
            total += n
        return total


def _count_task(model_name: str):
    def task(rows):
        def load():
            import public_tokenizers

            return Merges(public_tokenizers.path(model_name))

        merges = worker_state(f"merges:{model_name}", load)
        for batch in rows:
            counts = [merges.count(t.as_py()) for t in batch.column(1)]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(2), pa.array(counts, pa.int64())], ["doc_id", "n_bytes", "n_tokens"])

    return task


def count_tokens(docs: DataFrame, model_name: str = "piece_bpe_32k.model", limit: int = LIMIT) -> DataFrame:
    """(doc_id, n_bytes, n_tokens, over_limit) for every row of ``docs`` (doc_id, text). ``model_name`` is a file of
    the tokenizer package that the workers have installed."""
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text.alias("text"), F.octet_length(text).cast("long").alias("n_bytes"))
    return rows.mapInArrow(_count_task(model_name), "doc_id long, n_bytes long, n_tokens long").withColumn(
        "over_limit", F.col("n_tokens") > limit)
