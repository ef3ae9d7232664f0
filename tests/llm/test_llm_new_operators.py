"""Fill-in-the-middle, vector codes and sentencepiece round trips against brute force and the library."""

import hashlib
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from starweave.llm import fill_middle as FM
from starweave.llm import pieces as PC
from starweave.llm import vector_codes as VC

SMALL = "/root/testdata/sf0.001"
ODD = [None, "", " ", "a", "é", "日本語 テキスト", "😀" * 9, "x<P>y", "<S>", "a<M", "<P", "P>", "<<", "<S<M<P", ">S>",
       "line\nline\r\n\ttab", "\x00nul\x00", "▁ marks ▁▁", "  two  blanks  ", "<s> </s> <unk>", "same", "same"]


def text(rng, n):
    return "".join(rng.choice("ab <>PSM/é中😀\n▁") for _ in range(n))


def corpus(seed=5, n=300):
    rng = random.Random(seed)
    rows = [(i, t) for i, t in enumerate(ODD)]
    rows += [(1000 + i, text(rng, rng.randrange(60))) for i in range(n)]
    rows += [(None, "no id"), (None, "no id"), (7, "again"), (-3, "below zero"), (9001, "long " + "wörd " * 60_000)]
    return rows


def frame(spark, rows):
    """Documents with other columns whose names the operators use inside."""
    return spark.createDataFrame([(i, t, "x", 5, "psm") for i, t in rows],
                                 "doc_id long, text string, ids string, n int, form string")


def sha(t):
    return hashlib.sha256(t.encode()).hexdigest()


# ---------------------------------------------------------------- fill in the middle
def plain_fim(doc_id, t):
    t = t or ""
    n = len(t)
    d = hashlib.sha256(f"1:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h = [int(d[8 * i : 8 * i + 8], 16) for i in range(4)]
    a, b = sorted((h[0] % (n + 1), h[1] % (n + 1)))
    if not t or any(m in t for m in ("<P>", "<S>", "<M>")) or h[2] % 100 >= 90:
        return n, "plain", None, None, t
    p, m, s = t[:a], t[a:b], t[b:]
    if h[3] % 100 < 20:
        return n, "spm", a, b - a, f"<S>{s}<P>{p}<M>{m}"
    return n, "psm", a, b - a, f"<P>{p}<S>{s}<M>{m}"


def test_fill_in_middle_equals_string_slices(spark):
    rows = corpus()
    made = FM.fill_in_middle(frame(spark, rows).repartition(3))
    got = made.withColumn("back", FM.restored(F.col("output"), F.col("form"))).collect()
    key = lambda r: tuple(str(x) for x in r)
    assert sorted(((r.doc_id, r.n, r.form, r.prefix_chars, r.middle_chars, r.output) for r in got), key=key) == sorted(
        ((i, *plain_fim(i, t)) for i, t in rows), key=key)
    assert sorted(str((r.doc_id, r.back)) for r in got) == sorted(str((i, t or "")) for i, t in rows)
    assert {r.form for r in got} == {"plain", "psm", "spm"}


def test_fill_in_middle_holds_little_for_a_batch_of_any_size():
    import tracemalloc

    import pyarrow as pa

    rng, n = random.Random(8), 600
    texts = [text(rng, 4000) for _ in range(n)]
    cuts = [sorted((rng.randrange(4001), rng.randrange(4001))) for _ in range(n)]
    batch = pa.RecordBatch.from_pydict({
        "doc_id": range(n), "text": texts, "n": [4000] * n, "form": ["psm"] * n, "first": [a for a, _ in cuts],
        "second": [b for _, b in cuts]})
    made = []
    tracemalloc.start()
    for out in FM._task(iter([batch])):
        made += out.column("output").to_pylist()
    peak = tracemalloc.get_traced_memory()[1] - sum(len(t.encode()) for t in texts)
    tracemalloc.stop()
    assert made == [f"<P>{t[:a]}<S>{t[b:]}<M>{t[a:b]}" for t, (a, b) in zip(texts, cuts)]
    assert peak < 11 << 20


def test_restored_cuts_bytes_not_java_strings(spark):
    made = FM.digests(FM.fill_in_middle(frame(spark, [(1, "a text")])))
    assert "split(" not in made._jdf.queryExecution().optimizedPlan().toString()


def test_fill_in_middle_parts_of_a_long_text():
    import pyarrow as pa

    t = text(random.Random(2), 5000)
    for a, b in ((0, 0), (17, 4000), (2500, 2500), (5000, 5000), (0, 5000)):
        got = FM.pieces_of(pa.array([t]), np.array([a]), np.array([b]), limit=97)
        assert [g[0].as_py() for g in got] == [t[:a], t[a:b], t[b:]]


def test_fill_in_middle_other_seed_and_empty_table(spark):
    df = frame(spark, corpus(n=50))
    one = {r.doc_id: r.output for r in FM.fill_in_middle(df).collect()}
    two = {r.doc_id: r.output for r in FM.fill_in_middle(df, seed="2").collect()}
    assert one != two
    assert all(r.form == "plain" for r in FM.fill_in_middle(df, fim_percent=0).collect())
    assert FM.digests(FM.fill_in_middle(df.limit(0))).collect() == []


# ---------------------------------------------------------------- vector codes
def plain_codes(rows, parts, entries, rounds, scale=4096):
    kept = [(i, [int(np.floor(np.float64(x) * scale)) for x in v], lab) for i, v, lab in rows
            if v is not None and all(x is not None and np.isfinite(x) for x in v)]
    if not kept:
        return [], None
    d = len(kept[0][1]) // parts
    part = lambda v, p: v[p * d : (p + 1) * d]
    first = sorted(kept, key=lambda r: r[0])[:entries]
    books = [[part(v, p) for _, v, _ in first] for p in range(parts)]
    far = lambda x, c: sum((a - b) ** 2 for a, b in zip(x, c))

    def assign(v, p):
        return min((far(part(v, p), c), e) for e, c in enumerate(books[p]))

    for _ in range(rounds):
        for p in range(parts):
            best = [assign(v, p)[1] for _, v, _ in kept]
            for e in range(len(books[p])):
                mine = [part(v, p) for (_, v, _), b in zip(kept, best) if b == e]
                if mine:
                    books[p][e] = [sum(c) // len(mine) for c in zip(*mine)]
    out = []
    for i, v, lab in kept:
        a = [assign(v, p) for p in range(parts)]
        out.append((i, "".join(f"{e:02x}" for _, e in a), sum(x for x, _ in a), lab))
    by = {}
    for r in out:
        by[r[3]] = by.get(r[3], 0) + r[2]
    digest = hashlib.sha256(",".join(str(x) for b in books for c in b for x in c).encode()).hexdigest()
    return [(i, c, e, by[lab]) for i, c, e, lab in out], digest


def test_exact_product_beyond_float64():
    rng = np.random.default_rng(1)
    a = rng.integers(-(2**31), 2**31, (30, 1))
    b = rng.integers(-(2**31), 2**31, (1, 40))
    assert (VC.exact_product(a, b) == a * b).all()
    a, b = rng.integers(-(2**27), 2**27, (30, 100)), rng.integers(-(2**27), 2**27, (100, 20))
    want = np.array([[sum(int(x) * int(y) for x, y in zip(r, c)) for c in b.T] for r in a])
    assert (VC.exact_product(a, b) == want).all()
    assert (a.astype(float) @ b.astype(float)).astype(np.int64).tolist() != want.tolist()  # float64 alone is not exact


def test_limbs_put_together_give_the_integers():
    v = np.array([0, 1, -1, 2**15, -(2**15), 2**15 - 1, 65535, -65536, 2**31 - 1, -(2**31), 2**46])
    parts = list(VC.limbs(v))
    assert all((p >= -(2**15)).all() and (p < 2**15).all() for p in parts)
    assert (sum(p.astype(np.int64) << (16 * i) for i, p in enumerate(parts)) == v).all()


def vectors(spark, rows, parts=3):
    return spark.createDataFrame([(i, v, lab, "x", b"y") for i, v, lab in rows],
                                 "vec_id long, embedding array<double>, label int, code string, packed binary").repartition(parts)


@pytest.mark.parametrize("reach", [0.4, 30_000.0])
def test_vector_codes_equal_plain_lloyd(spark, reach):
    rng = random.Random(3)
    rows = [(i * 7 % 211, [rng.uniform(-reach, reach) for _ in range(16)], rng.choice([None, 1, 2])) for i in range(211)]
    rows += [(500 + i, list(rows[5][1]), 9) for i in range(70)]  # copies
    rows += [(900, None, 1), (901, [None] + [0.0] * 15, 1), (902, [float("nan")] * 16, None), (903, [float("inf")] + [0.0] * 15, 2)]
    want, digest = plain_codes(rows, 8, 16, 6)
    got = VC.vector_codes(vectors(spark, rows)).collect()
    assert sorted((r.vec_id, r.code, r.error, r.label_error) for r in got) == sorted(want)
    assert {r.codebooks_sha256 for r in got} == {digest}


def test_vector_codes_ties_and_few_vectors(spark):
    rows = [(3, [1.0, 2.0], 1), (1, [1.0, 2.0], 1), (2, [1.0, 4.0], None)]
    want, digest = plain_codes(rows, 2, 16, 6)
    got = VC.vector_codes(vectors(spark, rows), parts=2).collect()
    assert sorted((r.vec_id, r.code, r.error, r.label_error) for r in got) == sorted(want)
    assert {r.codebooks_sha256 for r in got} == {digest}
    doubled = VC.vector_codes(vectors(spark, [(None, [1.0, 2.0], 1)] * 2 + rows), parts=2).collect()
    assert len(doubled) == 5


def test_vector_codes_refused_and_empty(spark):
    assert VC.vector_codes(vectors(spark, [(1, None, 1)])).collect() == []
    assert VC.vector_codes(vectors(spark, [(1, [1.0] * 8, 1)]).limit(0)).collect() == []
    with pytest.raises(ValueError, match="equal parts"):
        VC.vector_codes(vectors(spark, [(1, [1.0] * 8, 1), (2, [1.0] * 16, 1)]))
    with pytest.raises(Exception, match="too large for exact distances"):
        VC.vector_codes(vectors(spark, [(1, [2.0**20] * 8, 1)])).collect()
    with pytest.raises(ValueError, match="too large for exact distances"):
        VC.vector_codes(vectors(spark, [(1, [2.0**18] * 8, 1)]))


# ---------------------------------------------------------------- sentencepiece
@pytest.fixture(scope="module")
def library():
    import public_tokenizers
    from sentencepiece import SentencePieceProcessor

    return SentencePieceProcessor(model_file=public_tokenizers.path(PC.MODEL))


def test_sentencepiece_equals_the_library(spark, library):
    rows = corpus(seed=8)
    got = PC.decode(PC.encode(frame(spark, rows).repartition(3))).collect()
    want = [(i, library.encode(t or "", add_eos=True)) for i, t in rows]
    assert sorted(str((r.doc_id, r.ids, r.text)) for r in got) == sorted(str((i, ids, library.decode(ids))) for i, ids in want)
    row = PC.digests(PC.decode(PC.encode(spark.createDataFrame([(1, "so it goes")], "doc_id long, text string")))).first()
    ids = library.encode("so it goes", add_eos=True)
    assert tuple(row) == (1, len(ids), sha(" ".join(map(str, ids))), sha("so it goes"))
    assert PC.digests(PC.decode(PC.encode(frame(spark, rows).limit(0)))).collect() == []


def test_small_tables_and_blocks_change_nothing(library, monkeypatch):
    import public_tokenizers

    monkeypatch.setattr(PC, "BLOCK", 3)
    pieces = PC.Pieces(public_tokenizers.path(PC.MODEL), table=20)
    rng = random.Random(4)
    for _ in range(3000):
        t = "".join(rng.choice(" ▁aAbe\n\t\r\x00é中😀　�<s></s>., ") for _ in range(rng.randrange(25)))
        ids = library.encode(t, add_eos=True)
        assert pieces.encode(t).tolist() == ids and pieces.decode(ids) == library.decode(ids)
    for _ in range(3000):  # any ids, control and byte pieces among them
        ids = [rng.choice([0, 1, 2, 3, 4, 28705, 259, 264, 200, rng.randrange(32000)]) for _ in range(rng.randrange(9))]
        assert pieces.decode(ids) == library.decode(ids)
    assert len(pieces.ids) <= 20 and len(pieces.texts) <= 20


def test_decode_of_null_ids(spark):
    df = spark.createDataFrame([(1, None), (2, []), (None, [2])], "doc_id long, ids array<int>")
    assert [r.text for r in PC.decode(df).collect()] == ["", "", ""]
