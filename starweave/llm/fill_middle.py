"""Fill-in-the-middle transformation as a pyarrow.compute pipeline.

Two cuts of every text come from a hash of the seed and doc_id, as column expressions. Tasks then work on Arrow
batches: texts become list arrays of their units (code points), the lists are flattened with their parent indices,
a unit's ordinal in its text and the two cuts give its role (prefix, middle, suffix), each role is filtered out, its
lists are rebuilt and ``binary_join`` makes the pieces of the batch, which are put together with the marks. A text of
more than ``SLICE_BYTES`` goes through this in several parts whose pieces are joined again, so the unit arrays stay
bounded by the slice, whatever the text's length; whole texts are transformed.

``restored`` rebuilds the text from output and form alone. It is exact: a text that holds a mark stays plain, and no
mark can come about at a seam, since ``<`` only begins a mark and ``>`` only ends one.

Defined cases: a null or empty text is plain and its output empty; a null doc_id hashes as the seed and an empty
number; equal rows are transformed alike; an empty table gives no rows; other columns are ignored, whatever their
names.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import slices, text_of, utf8_column

MARKS = ("<P>", "<S>", "<M>")  # prefix, suffix, middle
SEED = "1"
FIM_PERCENT = 90
SPM_PERCENT = 20
#: Bytes of text that the unit arrays of a task stand for at once; they take some 60 bytes for one of text.
SLICE_BYTES = 1 << 18
_SCHEMA = "doc_id long, n long, form string, prefix_chars long, middle_chars long, output string"


def plan_columns(docs: DataFrame, seed: str, fim_percent: int, spm_percent: int) -> DataFrame:
    """(doc_id, text, n, form, first, second): the form of each text and the ordinals of its two cuts."""
    doc_id = F.col("doc_id").cast("long")
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(doc_id.cast("string"), F.lit(""))), 256)
    h = [F.conv(F.substring("digest", 8 * i + 1, 8), 16, 10).cast("long") for i in range(4)]
    rows = docs.select(doc_id.alias("doc_id"), text_of().alias("text"), digest.alias("digest")).withColumn(
        "n", F.char_length("text").cast("long"))
    marked = F.lit(False)
    for m in MARKS:
        marked = marked | F.contains(F.col("text"), F.lit(m))
    x, y = h[0] % (F.col("n") + 1), h[1] % (F.col("n") + 1)
    form = (F.when((F.col("n") == 0) | marked | (h[2] % 100 >= fim_percent), "plain")
            .when(h[3] % 100 < spm_percent, "spm").otherwise("psm"))
    return rows.select("doc_id", "text", "n", form.alias("form"), F.least(x, y).alias("first"), F.greatest(x, y).alias("second"))


def unit_lists(texts: pa.Array) -> pa.ListArray:
    """Each text as the list of its code points. A unit begins at every byte that does not continue one; the units
    share the bytes of the texts."""
    raw, offsets = utf8_column(texts)
    body = raw[offsets[0] : offsets[-1]]
    begins = np.flatnonzero((body & 0xC0) != 0x80)
    ends = np.append(begins, len(body)).astype(np.int32)
    units = pa.StringArray.from_buffers(len(begins), pa.py_buffer(ends), pa.py_buffer(np.ascontiguousarray(body)))
    return pa.ListArray.from_arrays(pa.array(np.searchsorted(begins, offsets - offsets[0]).astype(np.int32)), units)


def role_pieces(texts: pa.Array, base: np.ndarray, first: np.ndarray, second: np.ndarray) -> list[pa.Array]:
    """(prefixes, middles, suffixes) of ``texts``, of which ``base[i]`` units came in earlier parts."""
    lists = unit_lists(texts)
    flat, parent = pc.list_flatten(lists), pc.list_parent_indices(lists)
    # the ordinal of a unit in its whole text: its place less that of its list's begin, and what came before
    shift = pa.array(base - lists.offsets.to_numpy()[:-1])
    ordinal = pc.add(pa.array(np.arange(len(flat))), pc.take(shift, parent))
    before = pc.less(ordinal, pc.take(pa.array(first), parent))
    after = pc.greater_equal(ordinal, pc.take(pa.array(second), parent))
    out = []
    for role in (before, pc.invert(pc.or_(before, after)), after):
        owners = pc.filter(parent, role).to_numpy()
        ends = np.concatenate(([0], np.cumsum(np.bincount(owners, minlength=len(texts))))).astype(np.int32)
        out.append(pc.binary_join(pa.ListArray.from_arrays(pa.array(ends), pc.filter(flat, role)), ""))
    return out


def _parts(raw: np.ndarray, limit: int) -> list[bytes]:
    """One long text cut at code points into parts of about ``limit`` bytes."""
    cuts, at = [0], 0
    while at + limit < len(raw):
        at += limit
        while (raw[at] & 0xC0) == 0x80:
            at -= 1
        cuts.append(at)
    return [raw[a:b].tobytes() for a, b in zip(cuts, [*cuts[1:], len(raw)])]


def pieces_of(texts: pa.Array, first: np.ndarray, second: np.ndarray, limit: int = SLICE_BYTES) -> list[pa.Array]:
    """``role_pieces`` of texts that are a slice together, or of one long text in parts."""
    raw, offsets = utf8_column(texts)
    if len(texts) > 1 or offsets[-1] - offsets[0] <= limit:
        return role_pieces(texts, np.zeros(len(texts), np.int64), first, second)
    done, found = 0, ([], [], [])
    for part in _parts(raw[offsets[0] : offsets[-1]], limit):
        array = pa.array([part], pa.binary()).cast(pa.string())
        for kept, piece in zip(found, role_pieces(array, np.array([done]), first, second)):
            kept.append(piece[0])
        done += pc.utf8_length(array)[0].as_py()
    return [pc.binary_join(pa.array([[p.as_py() for p in kept]], pa.list_(pa.string())), "") for kept in found]


def transform_batch(texts: pa.Array, forms: pa.Array, first: np.ndarray, second: np.ndarray,
                    limit: int = SLICE_BYTES) -> pa.Array:
    """The outputs of one slice of texts."""
    prefix, middle, suffix = pieces_of(texts, first, second, limit)
    p, s, m = (pa.scalar(x) for x in MARKS)
    psm = pc.binary_join_element_wise(p, prefix, s, suffix, m, middle, "")
    spm = pc.binary_join_element_wise(s, suffix, p, prefix, m, middle, "")
    return pc.if_else(pc.equal(forms, "plain"), texts, pc.if_else(pc.equal(forms, "spm"), spm, psm))


def _task(rows):
    for batch in rows:
        texts = pc.fill_null(batch.column("text"), "")
        _, offsets = utf8_column(texts)
        for i, j in slices(offsets, SLICE_BYTES) if batch.num_rows else ():
            b, t = batch.slice(i, j - i), texts.slice(i, j - i)
            first, second = b.column("first").to_numpy(), b.column("second").to_numpy()
            plain = pc.equal(b.column("form"), "plain")
            none = pa.scalar(None, pa.int64())
            yield pa.RecordBatch.from_arrays(
                [b.column("doc_id"), b.column("n"), b.column("form"), pc.if_else(plain, none, pa.array(first)),
                 pc.if_else(plain, none, pa.array(second - first)),
                 transform_batch(t, b.column("form"), first, second).cast(pa.string())],
                ["doc_id", "n", "form", "prefix_chars", "middle_chars", "output"])


def fill_in_middle(docs: DataFrame, *, seed: str = SEED, fim_percent: int = FIM_PERCENT,
                   spm_percent: int = SPM_PERCENT) -> DataFrame:
    """(doc_id, n, form, prefix_chars, middle_chars, output) for every row of ``docs`` (doc_id, text): the whole text
    transformed. See the module text."""
    return plan_columns(docs, seed, fim_percent, spm_percent).mapInArrow(_task, _SCHEMA)


def _after(mark: str, text: Column) -> list[Column]:
    """What stands before and after ``mark``, which ``text`` holds once. Cut in the text's bytes: a ``split`` by a pattern
    makes Java strings of every text, several times its size."""
    return [F.substring_index(text, mark, 1), F.substring_index(text, mark, -1)]


def restored(output: Column, form: Column) -> Column:
    """The text that ``output`` was made from."""
    p, s, m = MARKS
    body = F.substr(output, F.lit(len(p) + 1))
    head, rest = _after(s, body)
    suffix, middle = _after(m, rest)
    psm = F.concat(head, middle, suffix)
    tail, rest = _after(p, body)
    prefix, middle = _after(m, rest)
    spm = F.concat(prefix, middle, tail)
    return F.when(form == "plain", output).when(form == "spm", spm).otherwise(psm)


def digests(made: DataFrame) -> DataFrame:
    """``fill_in_middle``'s rows with digests of the output and of the text restored from it."""
    return made.select(
        "doc_id", "n", "form", "prefix_chars", "middle_chars", F.sha2("output", 256).alias("output_sha256"),
        F.sha2(restored(F.col("output"), F.col("form")), 256).alias("restored_sha256"))


ORACLE = """
with d as (select doc_id, coalesce(text, '') as text, length(coalesce(text, '')) as n, sha256('1:' || doc_id::varchar) as h
    from documents),
u as (select *, ('0x' || substr(h, 1, 8))::bigint % (n + 1) as x, ('0x' || substr(h, 9, 8))::bigint % (n + 1) as y,
    ('0x' || substr(h, 17, 8))::bigint % 100 as f, ('0x' || substr(h, 25, 8))::bigint % 100 as g from d),
c as (select *, least(x, y) as a, greatest(x, y) as b, case when n = 0 or contains(text, '<P>') or contains(text, '<S>')
      or contains(text, '<M>') or f >= 90 then 'plain' when g < 20 then 'spm' else 'psm' end as form from u),
p as (select *, substr(text, 1, a) as pre, substr(text, a + 1, b - a) as mid, substr(text, b + 1) as suf from c)
select doc_id, n::bigint as n, form, case when form <> 'plain' then a::bigint end as prefix_chars,
    case when form <> 'plain' then (b - a)::bigint end as middle_chars,
    sha256(case form when 'plain' then text when 'spm' then '<S>' || suf || '<P>' || pre || '<M>' || mid
      else '<P>' || pre || '<S>' || suf || '<M>' || mid end) as output_sha256, sha256(text) as restored_sha256
from p
"""
