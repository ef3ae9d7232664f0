"""Quality rules whose thresholds adapt to each language and source.

Every document gets integer measures (below) from its whole text. Their distribution per (lang, source), over the
documents that pass the base rule, is kept as a mergeable quantile sketch: counts of log-linear bins with 32 steps an
octave (relative error 1/32, any two sketches of a measure add up bin by bin, and any order of merging gives the same
one). A group with fewer than ``min_group`` such documents takes the merged sketch of its language, and a language with
fewer that of all documents. Quantiles read off the sketches give fences, which are joined back and filter. No fence has
a fixed part but the width of one bin, so a group in which a measure is rare has a low fence, and one in which it is
usual a high one:

* ``symbols`` per mille of words, ``dup_lines`` per mille of lines, ``repeats`` per mille of words: above
  ``q + factor * (q - q50)`` and a bin fails. ``LAW`` gives the upper quantile q and the factor: a measure that junk
  lifts in many documents takes a low quantile and a high factor, one that it lifts in few a high quantile.
* ``word_len``, hundredths of a code point a word: outside ``q50 -/+ 5 * min(q50 - q10, q90 - q50)`` and a bin; the
  lesser side is the one that junk has not stretched.

Defined cases: a null or empty text has no words, fails the base rule and is not kept; documents that fail the base
rule are not counted in sketches, a group without any other has the fences of its language or of all; with no other
document at all nothing is kept; very long texts are measured whole; null ``lang`` or ``source`` are groups of their own; equal rows
count each; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window

from ..session import materialize
from .common import checked_broadcast, slices, utf8_column
from .words import shingle_hashes, word_hashes

#: Upper quantile (per cent) and factor, in halves, of each measure's fence; for ``word_len`` the quantile of both sides.
LAW = {"symbols": (75, 8), "dup_lines": (99, 1), "repeats": (99, 2), "word_len": (90, 10)}
#: Quantiles, per cent, that are read off the sketches.
LEVELS = (10, 50, 75, 90, 99)
MIN_GROUP = 50
MIN_WORDS = 20
WINDOW = 8

_SYMBOL = np.zeros(256, dtype=np.int64)
_SYMBOL[[ord(c) for c in "#*$%&|<>"]] = 1
_POINT = np.ones(256, dtype=np.int64)  # bytes that begin a code point outside white space
_POINT[0x80:0xC0] = 0
_POINT[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = 0

_MEASURED = ("doc_id long, lang string, source string, n_words long, word_chars long, n_symbols long, "
             "n_lines long, n_dup_lines long, n_repeat_words long")


def _repeats(runs: np.ndarray, n_words: int) -> int:
    """Words inside windows that occur twice or more, the first included."""
    if len(runs) < 2 or n_words < WINDOW:
        return 0
    _, where, n = np.unique(runs, return_inverse=True, return_counts=True)
    again = np.flatnonzero(n[where] > 1)
    if not len(again):
        return 0
    edge = np.zeros(n_words + 1, dtype=np.int64)
    np.add.at(edge, again, 1)
    np.add.at(edge, again + WINDOW, -1)
    return int((np.cumsum(edge)[:n_words] > 0).sum())


def _lines(text: str | None) -> tuple[int, int]:
    """Lines with a word, and those equal to an earlier one."""
    lines = [x for x in (text or "").split("\n") if x.strip(" \t\n\r\x0b\x0c")]
    return len(lines), len(lines) - len(set(lines))


def _measure(rows):
    for batch in rows:
        raw, offsets = utf8_column(batch.column(3))
        columns: list[list] = [[], [], [], []]
        for i, j in slices(offsets):
            at = offsets[i : j + 1]
            words, counts = word_hashes(raw, at)
            part = raw[at[0] : at[-1]]
            for column, table in ((1, _POINT), (2, _SYMBOL)):
                sums = np.concatenate(([0], np.cumsum(table[part])))
                columns[column] += np.diff(sums[at - at[0]]).tolist()
            columns[0] += counts.tolist()
            runs, n_runs = shingle_hashes(words, counts, WINDOW)
            to = 0
            for n, c in zip(n_runs.tolist(), counts.tolist()):
                columns[3].append(_repeats(runs[to : to + n], c))
                to += n
        lines = [_lines(t) for t in batch.column(3).to_pylist()]
        long = [pa.array(c, pa.int64()) for c in
                (columns[0], columns[1], columns[2], [a for a, _ in lines], [b for _, b in lines], columns[3])]
        names = [x.split()[0] for x in _MEASURED.split(", ")]
        yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), batch.column(2), *long], names)


def measure(docs: DataFrame) -> DataFrame:
    """The counts of every document's whole text (see ``_MEASURED``)."""
    return docs.select(*(F.col(c).cast(t).alias(c) for c, t in (
        ("doc_id", "long"), ("lang", "string"), ("source", "string"), ("text", "string")))).mapInArrow(_measure, _MEASURED)


def with_rates(measured: DataFrame) -> DataFrame:
    """The four rates as integers, 0 where there are no words."""
    def rate(a, b, scale):
        return F.coalesce(F.expr(f"({scale} * {a}) div nullif({b}, 0)"), F.lit(0)).cast("long")

    return measured.withColumns({
        "symbols": rate("n_symbols", "n_words", 1000), "dup_lines": rate("n_dup_lines", "n_lines", 1000),
        "repeats": rate("n_repeat_words", "n_words", 1000), "word_len": rate("word_chars", "n_words", 100)})


def base_failed(min_words: int = MIN_WORDS):
    return F.expr(f"n_words < {min_words} or 100 * n_repeat_words > 30 * n_words")


def sketch(rated: DataFrame, min_words: int = MIN_WORDS) -> DataFrame:
    """(lang, source, measure, bin, n): counts by log-linear bin, aggregated map-side."""
    stacked = rated.filter(~base_failed(min_words)).select("lang", "source", F.expr(
        "stack(4, 'symbols', symbols, 'dup_lines', dup_lines, 'repeats', repeats, 'word_len', word_len) "
        "as (measure, v)"))
    shift = "cast(greatest(length(bin(v)) - 6, 0) as int)"
    return stacked.select("lang", "source", "measure", F.expr(f"shiftleft(shiftright(v, {shift}), {shift})").alias(
        "bin")).groupBy("lang", "source", "measure", "bin").agg(F.count(F.lit(1)).alias("n"))


def quantiles(sketches: DataFrame, by: list[str], levels: tuple[int, ...] = LEVELS) -> DataFrame:
    """(by, measure, docs, q10, q50, ...) of the sketches merged by ``by``."""
    merged = sketches.groupBy(*by, "measure", "bin").agg(F.sum("n").alias("n"))
    w = Window.partitionBy(*by, "measure")
    run = merged.withColumn("upto", F.sum("n").over(w.orderBy("bin"))).withColumn("docs", F.sum("n").over(w))
    return run.groupBy(*by, "measure", "docs").agg(*(
        F.min(F.expr(f"case when 100 * upto >= {i} * docs then bin end")).alias(f"q{i}") for i in levels))


def fences(groups: DataFrame, sketches: DataFrame, min_group: int = MIN_GROUP, law: dict[str, tuple[int, int]] | None = None) -> DataFrame:
    """(lang, source, hi_symbols, hi_dup_lines, hi_repeats, lo_word_len, hi_word_len), a row for each of ``groups``
    (lang, source)."""
    law = law or LAW
    levels = tuple(sorted({*LEVELS, *(q for q, _ in law.values()), *(100 - q for q, _ in law.values())}))
    q = ["docs", *(f"q{i}" for i in levels)]
    own = quantiles(sketches, ["lang", "source"], levels)
    lang = quantiles(sketches, ["lang"], levels).select("lang", "measure", *(F.col(c).alias(f"l_{c}") for c in q))
    every = quantiles(sketches, [], levels).select("measure", *(F.col(c).alias(f"a_{c}") for c in q))
    asked = groups.select("lang", "source").distinct().withColumn("measure", F.explode(F.array(*(F.lit(m) for m in law)))).alias("g")
    both = asked.join(F.broadcast(every.alias("a")), F.expr("g.measure = a.measure"), "left").join(  # a row a measure
        own.alias("o"), F.expr("g.lang <=> o.lang and g.source <=> o.source and g.measure = o.measure"), "left").join(
        lang.alias("l"), F.expr("g.lang <=> l.lang and g.measure = l.measure"), "left")

    def pick(c):
        return F.expr(f"case when o.docs >= {min_group} then o.{c} when l_docs >= {min_group} then l_{c} "
                      f"else a_{c} end").alias(c)

    chosen = both.select("g.lang", "g.source", "g.measure", *(pick(c) for c in q[1:]))

    def bin_at(v):
        return f"shiftleft(1L, cast(greatest(length(bin({v})) - 6, 0) as int))"

    hi, reach = {}, {}
    for m, (level, halves) in law.items():
        if m == "word_len":
            reach[m] = f"({halves} * least(q50 - q{100 - level}, q{level} - q50)) div 2 + {bin_at('q50')}"
            hi[m] = f"q50 + {reach[m]}"
        else:
            hi[m] = f"q{level} + ({halves} * (q{level} - q50)) div 2 + {bin_at(f'q{level}')}"

    def at(m, value):
        return F.max(F.expr(f"case when measure = '{m}' then {value} end"))

    return chosen.groupBy("lang", "source").agg(
        *(at(m, hi[m]).alias(f"hi_{m}") for m in law), at("word_len", f"q50 - ({reach['word_len']})").alias("lo_word_len"))


def quality_verdicts(docs: DataFrame, *, min_words: int = MIN_WORDS, min_group: int = MIN_GROUP,
                     law: dict[str, tuple[int, int]] | None = None) -> DataFrame:
    """Every document of ``docs`` (doc_id, lang, source, text) with its counts, rates, fences, ``base_failed`` and
    ``kept``. See the module text."""
    rated = with_rates(materialize(measure(docs), "measures"))
    limits = fences(rated, sketch(rated, min_words), min_group, law).withColumnRenamed("lang", "f_lang").withColumnRenamed(
        "source", "f_source")
    joined = rated.join(checked_broadcast(materialize(limits, "fences")), F.expr("lang <=> f_lang and source <=> f_source"), "left")
    fine = F.expr("symbols <= hi_symbols and dup_lines <= hi_dup_lines and repeats <= hi_repeats "
                  "and word_len between lo_word_len and hi_word_len")
    return joined.withColumn("base_failed", base_failed(min_words)).withColumn(
        "kept", ~F.col("base_failed") & F.coalesce(fine, F.lit(False))).drop("f_lang", "f_source")


QUERY_COLUMNS = ["doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept"]

ORACLE = r"""
with w as (select doc_id, lang, source, coalesce(text, '') as text,
    regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') as ws from documents),
win as (select doc_id, i, ws[i:i + 7] as g from w, unnest(range(1, len(ws) - 6)) t(i)),
again as (select doc_id, i from (select doc_id, i, count(*) over (partition by doc_id, g) as c from win) where c > 1),
cov as (select doc_id, count(distinct i + j) as n from again, range(0, 8) r(j) group by doc_id),
lines as (select doc_id, list_filter(string_split(text, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) as l from w),
m as (select w.doc_id, lang, source, len(ws)::bigint as n_words,
    coalesce(list_sum(list_transform(ws, lambda x: length(x))), 0)::bigint as word_chars,
    length(regexp_replace(text, '[^#*$%&|<>]', '', 'g'))::bigint as n_symbols,
    len(l)::bigint as n_lines, (len(l) - len(list_distinct(l)))::bigint as n_dup_lines,
    coalesce(cov.n, 0)::bigint as n_repeat_words
    from w join lines using (doc_id) left join cov using (doc_id)),
r as (select *, case when n_words = 0 then 0 else 1000 * n_symbols // n_words end as symbols,
    case when n_lines = 0 then 0 else 1000 * n_dup_lines // n_lines end as dup_lines,
    case when n_words = 0 then 0 else 1000 * n_repeat_words // n_words end as repeats,
    case when n_words = 0 then 0 else 100 * word_chars // n_words end as word_len from m),
s as (select lang, source, f as measure, (v >> greatest(length(bin(v)) - 6, 0)) << greatest(length(bin(v)) - 6, 0) as b,
    count(*) as n from (select lang, source, 'symbols' as f, symbols as v from r where n_words >= 20 and 100 * n_repeat_words <= 30 * n_words
      union all select lang, source, 'dup_lines', dup_lines from r where n_words >= 20 and 100 * n_repeat_words <= 30 * n_words
      union all select lang, source, 'repeats', repeats from r where n_words >= 20 and 100 * n_repeat_words <= 30 * n_words
      union all select lang, source, 'word_len', word_len from r where n_words >= 20 and 100 * n_repeat_words <= 30 * n_words) group by all),
q as (select level, lang, source, measure, docs,
    min(b) filter (100 * upto >= 10 * docs) as q10, min(b) filter (100 * upto >= 50 * docs) as q50,
    min(b) filter (100 * upto >= 75 * docs) as q75, min(b) filter (100 * upto >= 90 * docs) as q90,
    min(b) filter (100 * upto >= 99 * docs) as q99
  from (select *, sum(n) over (partition by level, lang, source, measure order by b) as upto,
      sum(n) over (partition by level, lang, source, measure) as docs
    from (select 1 as level, lang, source, measure, b, sum(n) as n from s group by all
      union all select 2, lang, null, measure, b, sum(n) from s group by all
      union all select 3, null, null, measure, b, sum(n) from s group by all))
  group by level, lang, source, measure, docs),
c as (select g.lang, g.source, a.measure, case when o.docs >= 50 then o when l.docs >= 50 then l else a end as z
  from (select distinct lang, source from r) g join q a on a.level = 3
  left join q o on o.level = 1 and o.lang is not distinct from g.lang and o.source is not distinct from g.source and o.measure = a.measure
  left join q l on l.level = 2 and l.lang is not distinct from g.lang and l.measure = a.measure),
e as (select lang, source, measure, z.q10 as q10, z.q50 as q50, z.q75 as q75, z.q90 as q90, z.q99 as q99,
    1 << greatest(length(bin(z.q50)) - 6, 0) as s50, 1 << greatest(length(bin(z.q75)) - 6, 0) as s75,
    1 << greatest(length(bin(z.q99)) - 6, 0) as s99 from c),
t as (select lang, source, max(q75 + 8 * (q75 - q50) // 2 + s75) filter (measure = 'symbols') as hs,
    max(q99 + (q99 - q50) // 2 + s99) filter (measure = 'dup_lines') as hd,
    max(q99 + 2 * (q99 - q50) // 2 + s99) filter (measure = 'repeats') as hr,
    max(q50 + 10 * least(q50 - q10, q90 - q50) // 2 + s50) filter (measure = 'word_len') as hw,
    max(q50 - (10 * least(q50 - q10, q90 - q50) // 2 + s50)) filter (measure = 'word_len') as lw
  from e group by lang, source)
select doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
    n_words < 20 or 100 * n_repeat_words > 30 * n_words as base_failed,
    not (n_words < 20 or 100 * n_repeat_words > 30 * n_words) and coalesce(symbols <= hs and dup_lines <= hd
      and repeats <= hr and word_len between lw and hw, false) as kept
from r left join t on r.lang is not distinct from t.lang and r.source is not distinct from t.source
"""
