"""Benchmark decontamination by BM25 retrieval with block-max WAND, verified on question and answer.

Index. Test items are lower-cased, taken as words between ASCII punctuation and white space, with every character of a
script that is written without blanks (Chinese, Japanese, Thai, Lao, Burmese, Khmer) as a word of its own, and cut into segments of
at most ``SEGMENT`` words, each scored by BM25 over the whole benchmark. A posting holds a segment and its
contribution divided by the segment's own score, so one threshold fits all; a term's postings, in segment order, have
a maximum per block of ``BLOCK``. The postings are made by Spark; a part of at most ``part_postings`` of them is
loaded at a time, with the texts of their items, each once and ``part_bytes`` of them together, and sent to the tasks;
a larger benchmark goes over the corpus part by part, with the same scores. One item is never divided, so a part has at
least one whole item, however long.

Query. Every document is cut into chunks of ``CHUNK`` words, and every two neighbouring chunks are a passage, so no
word is left out and every run of CHUNK words lies in a passage. Of each segment the terms of the most segments, as
many as stay below a share of the threshold together, are its common ones; the others are essential. A passage whose
essential terms, with the common rest, cannot reach the threshold for any segment ends there. The others run
block-max WAND: cursors sorted by segment find the pivot where summed maxima reach the threshold, block maxima decide
whether it is scored or skipped; all segments at or above the threshold are retrieved (a threshold, not a top k, so
nothing is cut off).

Verify. For a retrieved item the document's words around the passage (an item's length to either side) must hold at
least ``overlap`` of the item's question ``GRAM``-grams and of its answer ones. The answer is the last sentence, or
the last third of the words if there is one sentence only; sentences before it join it until it has GRAM words. A part
that stays shorter counts as one gram. The passages of an item are verified from the best score down, until none left
could be reported.

Defined cases: null and empty texts, and items without words, match nothing; repeated documents match row by row;
repeated items each match; a null doc_id or item_id is reported as null; an empty table gives no rows; other columns
are ignored.
"""

from __future__ import annotations

import re
from bisect import bisect_left

import pyarrow as pa
from pyspark.sql import DataFrame, Row
from pyspark.sql import functions as F

from ..session import materialize

CHUNK = 32
SEGMENT = 32
BLOCK = 64
GRAM = 3
K1, B = 1.2, 0.75
#: Share of the threshold that a segment's common terms may make up together.
COMMON = 0.5
THRESHOLD = 0.5
OVERLAP = 0.5
PART_POSTINGS = 2_000_000
PART_BYTES = 32 << 20

#: ASCII characters other than letters, digits and _ part words.
_PARTED = bytes(c if c > 127 or chr(c).isalnum() or c == ord("_") else 32 for c in range(256))
_SENTENCE = re.compile("[.!?\n\u3002\uff01\uff1f]+")
#: Characters of scripts without blanks, and the punctuation and blanks that go with them.
_ALONE = re.compile("[\u0e00-\u0eff\u1000-\u109f\u1780-\u17ff\u3040-\u30ff\u3400-\u4dbf\u4e00-\u9fff\uf900-\ufaff\U00020000-\U0003ffff]")
_BESIDE = re.compile("[\u3000-\u303f\uff01-\uff0f\uff1a-\uff20\uff3b-\uff40\uff5b-\uff65]")


def words_of(text: str | None) -> list[str]:
    said = (text or "").lower().encode("utf-8", "replace").translate(_PARTED).decode()
    if not said.isascii():
        said = _ALONE.sub(r" \g<0> ", _BESIDE.sub(" ", said))
    return said.split()


def question_and_answer(text: str | None) -> tuple[list[str], list[str]]:
    """The words of an item's question and of its answer."""
    parts = [w for w in (words_of(s) for s in _SENTENCE.split(text or "")) if w]
    answer = parts.pop() if len(parts) > 1 else []
    while len(answer) < GRAM and len(parts) > 1:
        answer = parts.pop() + answer
    question = [w for p in parts for w in p]
    if len(answer) < GRAM:
        words = question + answer
        cut = len(words) - len(words) // 3
        question, answer = words[:cut], words[cut:]
    return question, answer


def grams(words: list[str], size: int = GRAM) -> set[tuple[str, ...]]:
    return set(zip(*(words[i:] for i in range(size))))


def own_grams(part: list[str]) -> tuple[int, set[tuple[str, ...]]]:
    """The grams of a part of an item, and their size."""
    size = min(GRAM, len(part))
    return size, grams(part, size) if part else set()


def _held(own: tuple[int, set[tuple[str, ...]]], there: list[str]) -> float:
    """The share of these grams that ``there`` holds, 1 if there are none."""
    size, part = own
    return len(part & grams(there, size)) / len(part) if part else 1.0


def _segments(rows):
    for batch in rows:
        out = []
        for item, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            words = words_of(text)
            pieces = -(-len(words) // SEGMENT)
            for i in range(pieces):
                out.append((item, words[len(words) * i // pieces : len(words) * (i + 1) // pieces]))
        yield pa.RecordBatch.from_arrays(
            [pa.array([o[i] for o in out], t) for i, t in enumerate((pa.int64(), pa.list_(pa.string())))], ["item", "words"])


def postings(items: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Segments (segment, item_id) and postings (segment, term, weight), weights being shares of a segment's
    own BM25 score."""
    seg = materialize(
        items.select(F.col("item_id").cast("long"), F.col("text").cast("string"))
        .mapInArrow(_segments, "item long, words array<string>")
        .withColumn("segment", F.monotonically_increasing_id()).withColumn("len", F.size("words")), "segments")
    n, mean = seg.agg(F.count(F.lit(1)), F.avg("len")).first()
    tf = seg.select("segment", "len", F.explode("words").alias("term")).groupBy("segment", "len", "term").agg(
        F.count(F.lit(1)).alias("tf"))
    df = tf.groupBy("term").agg(F.count(F.lit(1)).alias("df"))
    idf = F.log(1 + (F.lit(n or 0) - F.col("df") + 0.5) / (F.col("df") + 0.5))
    norm = K1 * (1 - B + B * F.col("len") / F.lit(mean or 1.0))
    scored = tf.join(df, "term").select(
        "segment", "term", (idf * F.col("tf") * (K1 + 1) / (F.col("tf") + norm)).alias("w"))
    own = scored.groupBy("segment").agg(F.sum("w").alias("own"))
    post = scored.join(own, "segment").select("segment", "term", (F.col("w") / F.col("own")).alias("weight"))
    return seg.select("segment", F.col("item").alias("item_id")), post


class Index:
    """Postings by term with block maxima, essential terms, and the question and answer of the items."""

    def __init__(self, rows: list[Row], item_of: dict[int, int], text_of: dict[int, str], threshold: float):
        self.threshold = threshold
        self.item_of, self.text_of = item_of, text_of  # items of the segments, texts of the items
        by_term: dict[str, list[tuple[int, float]]] = {}
        by_segment: dict[int, list[tuple[str, float]]] = {}
        for segment, term, weight in rows:
            by_term.setdefault(term, []).append((segment, weight))
            by_segment.setdefault(segment, []).append((term, weight))
        self.segments: dict[str, list[int]] = {}
        self.weights: dict[str, list[float]] = {}
        self.blocks: dict[str, list[float]] = {}
        self.top: dict[str, float] = {}
        for term, found in by_term.items():
            found.sort()
            self.segments[term] = [s for s, _ in found]
            self.weights[term] = w = [x for _, x in found]
            self.blocks[term] = [max(w[i : i + BLOCK]) for i in range(0, len(w), BLOCK)]
            self.top[term] = max(w)
        self.essential: dict[str, list[tuple[int, float]]] = {}
        self.common: dict[int, float] = {}
        for segment, found in by_segment.items():
            found.sort(key=lambda f: (-len(self.segments[f[0]]), f[0]))
            mass = 0.0
            for i, (term, weight) in enumerate(found):
                if mass + weight >= COMMON * threshold:
                    break
                mass += weight
            self.common[segment] = mass
            for term, weight in found[i:]:
                self.essential.setdefault(term, []).append((segment, weight))
        self.essential_terms = set(self.essential)
        #: Words, and grams of question and answer, of the items met so far.
        self.parts: dict[int, tuple] = {}

    def reach(self, terms: set[str]) -> float:
        """The most that these essential terms give a segment."""
        sums: dict[int, float] = {}
        for t in terms:
            for segment, weight in self.essential[t]:
                sums[segment] = sums.get(segment, 0.0) + weight
        return max(sums.values(), default=0.0)

    def retrieve(self, terms: list[str]) -> list[tuple[int, float]]:
        """(segment, score) of all segments that reach the threshold, by block-max WAND."""
        threshold = self.threshold - 1e-9
        cursors = [[self.segments[t][0], 0, t] for t in terms]
        found = []
        while cursors:
            cursors.sort(key=lambda c: c[0])
            bound, pivot = 0.0, -1
            for i, c in enumerate(cursors):
                bound += self.top[c[2]]
                if bound >= threshold:
                    pivot = i
                    break
            if pivot < 0:
                break
            segment = cursors[pivot][0]
            while pivot + 1 < len(cursors) and cursors[pivot + 1][0] == segment:
                pivot += 1
            # block maxima of the lists up to the pivot, at the pivot's segment
            block_bound, block_end = 0.0, None
            for c in cursors[: pivot + 1]:
                docs = self.segments[c[2]]
                at = c[1] if c[0] == segment else bisect_left(docs, segment, c[1])
                if at >= len(docs):
                    continue
                block = at // BLOCK
                block_bound += self.blocks[c[2]][block]
                last = docs[min((block + 1) * BLOCK, len(docs)) - 1]
                block_end = last if block_end is None else min(block_end, last)
            if block_bound >= threshold:
                if cursors[0][0] == segment:
                    score = sum(self.weights[c[2]][c[1]] for c in cursors[: pivot + 1])
                    if score >= threshold:
                        found.append((segment, score))
                    to = segment + 1
                else:
                    to = segment
            else:  # nothing up to the nearest block end, or the next list's segment, can reach it
                to = block_end + 1
                if pivot + 1 < len(cursors):
                    to = min(to, cursors[pivot + 1][0])
                to = max(to, segment + 1)
            left = []
            for i, c in enumerate(cursors):
                if i <= pivot and c[0] < to:
                    docs = self.segments[c[2]]
                    c[1] = bisect_left(docs, to, c[1])
                    if c[1] >= len(docs):
                        continue
                    c[0] = docs[c[1]]
                left.append(c)
            cursors = left
        return found

    def matches(self, text: str | None, overlap: float) -> list[tuple[int, float, float, float]]:
        """(item, score, question overlap, answer overlap) of every verified item of a text, its best passage each."""
        words = words_of(text)
        rare = [self.essential_terms.intersection(words[i : i + CHUNK]) for i in range(0, len(words), CHUNK)]
        peaks = [self.reach(r) for r in rare]
        least = self.threshold - max(self.common.values(), default=0.0) - 1e-9
        hits: dict[int, dict[int, float]] = {}  # by item: score of each passage
        for i in range(max(1, len(rare) - 1) if rare else 0):
            if sum(peaks[i : i + 2]) < least or self.reach(set().union(*rare[i : i + 2])) < least:
                continue
            terms = self.top.keys() & set(words[i * CHUNK : (i + 2) * CHUNK])
            for segment, score in self.retrieve(sorted(terms)):
                of = hits.setdefault(self.item_of[segment], {})
                of[i] = max(of.get(i, 0.0), score)
        found = []
        for item, of in sorted(hits.items()):
            if item not in self.parts:
                question, answer = question_and_answer(self.text_of[item])
                self.parts[item] = len(question) + len(answer), own_grams(question), own_grams(answer)
            n, question, answer = self.parts[item]
            best = (0.0, 0.0, 0.0)
            for i, score in sorted(of.items(), key=lambda h: -h[1]):
                if (score, 1.0, 1.0) <= best:  # nor can any after it be better
                    break
                there = words[max(0, i * CHUNK - n) : (i + 2) * CHUNK + n]
                q, a = _held(question, there), _held(answer, there)
                if q >= overlap and a >= overlap:
                    best = max(best, (score, q, a))
            if best[0]:
                found.append((item, *best))
        return found


def _match_task(shared, threshold: float, overlap: float):
    def task(rows):
        index = Index(*shared.value, threshold)
        for batch in rows:
            out = []
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                out += [(doc_id, *m) for m in index.matches(text.as_py(), overlap)]
            yield pa.RecordBatch.from_arrays(
                [pa.array([o[i] for o in out], t) for i, t in enumerate((pa.int64(), pa.int64()) + (pa.float64(),) * 3)],
                ["doc_id", "item_no", "score", "question_overlap", "answer_overlap"])

    return task


def contaminated(docs: DataFrame, items: DataFrame, *, threshold: float = THRESHOLD, overlap: float = OVERLAP,
                 part_postings: int = PART_POSTINGS, part_bytes: int = PART_BYTES) -> DataFrame:
    """(doc_id, item_id, score, question_overlap, answer_overlap) for every document of ``docs`` (doc_id, text) that
    holds an item of ``items`` (item_id, text). See the module text."""
    spark = docs.sparkSession
    numbered = materialize(items.select(
        F.monotonically_increasing_id().alias("item_no"), F.col("item_id").cast("long").alias("item_id"), "text"), "items")
    segments, post = postings(numbered.select(F.col("item_no").alias("item_id"), "text"))
    post = materialize(post, "postings")
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    n, size = post.count(), numbered.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    parts = max(1, -(-n // part_postings), -(-size // part_bytes))
    schema = "doc_id long, item_no long, score double, question_overlap double, answer_overlap double"
    found = None
    for part in range(parts):  # one for a benchmark of up to part_postings and part_bytes
        mine = segments.filter(F.pmod(F.xxhash64("item_id"), F.lit(parts)) == part)
        item_of = {r.segment: r.item_id for r in mine.toLocalIterator()}
        text_of = {r.item_no: r.text for r in numbered.filter(F.pmod(F.xxhash64("item_no"), F.lit(parts)) == part)
                   .select("item_no", "text").toLocalIterator()}
        rows = [tuple(r) for r in post.join(mine.select("segment"), "segment").select(
            "segment", "term", "weight").toLocalIterator()]
        shared = spark.sparkContext.broadcast((rows, item_of, text_of))
        got = docs.mapInArrow(_match_task(shared, threshold, overlap), schema)
        got = materialize(got, "hits")
        found = got if found is None else found.union(got)
    named = numbered.select("item_no", "item_id")
    return found.join(named, "item_no").select("doc_id", "item_id", "score", "question_overlap", "answer_overlap")
