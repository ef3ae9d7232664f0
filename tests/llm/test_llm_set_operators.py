"""Near-duplicate components, mixing, sharding, URL lists, components and the pipeline."""

import random
import zlib

import pytest
from pyspark.sql import functions as F

SMALL = "/root/testdata/sf0.001"


def read(spark, name, d=SMALL):
    return spark.read.parquet(f"{d}/{name}.parquet")


def shingles(text):
    words = (text or "").encode().lower().split()
    if not words:
        return frozenset()
    return frozenset([tuple(words)] if len(words) < 5 else [tuple(words[i : i + 5]) for i in range(len(words) - 4)])


def brute_components(rows):
    """(n_shingles, component) by doc_id, over all pairs."""
    sets = {i: shingles(t) for i, t in rows}
    parent = {i: i for i in sets}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    ids = sorted(i for i in sets if sets[i])
    for a in ids:
        for b in ids:
            if b > a:
                both = len(sets[a] & sets[b])
                if 100 * both >= 75 * (len(sets[a]) + len(sets[b]) - both):
                    x, y = find(a), find(b)
                    parent[max(x, y)] = min(x, y)
    return {i: (len(sets[i]), find(i)) for i in sets}


def near_copies(seed, n):
    """Texts with groups of near copies, copies with shared passages, short and empty ones."""
    rng = random.Random(seed)
    base = [f"w{rng.randrange(5000)}" for _ in range(60)]
    passage = [f"p{i}" for i in range(30)]
    out = []
    for _ in range(n):
        kind = rng.randrange(5)
        if kind < 2:
            t = [w if rng.random() > rng.choice([0, 0.01, 0.03, 0.05]) else f"x{rng.randrange(10**6)}" for w in base]
        elif kind == 2:
            t = passage + [f"y{rng.randrange(10**6)}" for _ in range(rng.randrange(12))]
        elif kind == 3:
            t = [f"z{rng.randrange(10**6)}" for _ in range(rng.randrange(40))] + passage
        else:
            t = [f"s{rng.randrange(3)}" for _ in range(rng.randrange(4))]
        out.append(" ".join(t))
    return out


@pytest.mark.parametrize("rare_max", [2, 8, 64])
def test_components_equal_brute_force(spark, rare_max):
    from starweave.llm.jaccard_join import near_duplicates

    rows = list(enumerate(near_copies(rare_max, 400)))
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in near_duplicates(docs, rare_max=rare_max, frequent_max=10_000).collect()}
    assert got == brute_components(rows)


def test_components_with_a_full_list_of_frequent_tokens(spark):
    from starweave.llm.jaccard_join import near_duplicates

    rows = list(enumerate(near_copies(9, 200)))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in near_duplicates(docs, rare_max=2, frequent_max=5).collect()}
    assert got == brute_components(rows)


def test_components_on_given_documents(spark):
    from starweave.llm.jaccard_join import near_duplicates

    docs = read(spark, "documents")
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in near_duplicates(docs).collect()}
    assert got == brute_components([(r.doc_id, r.text) for r in docs.collect()])


def test_components_defined_cases(spark):
    from starweave.llm.jaccard_join import near_duplicates

    rows = [(5, "one two", 1), (3, "ONE  two", 1), (3, "ONE  two", 1), (7, None, 1), (8, "", 1), (9, " \n", 1),
            (None, "one two", 1), (None, "alone here", 1), (4, "w " * 50_000, 1)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, sig int")
    got = sorted((r.doc_id or 0, r.n_shingles, r.component_id or 0) for r in near_duplicates(docs).collect())
    assert got == sorted([(5, 1, 3), (3, 1, 3), (3, 1, 3), (7, 0, 7), (8, 0, 8), (9, 0, 9), (0, 1, 3), (0, 1, 0), (4, 1, 4)])
    assert near_duplicates(docs.limit(0)).count() == 0


def without_ids(seed, n):
    """(row, doc_id, text) of near copies with null and repeated ids."""
    rng = random.Random(seed)
    return [(i, rng.choice([None, rng.randrange(n // 2), i]), t) for i, t in enumerate(near_copies(seed, n))]


@pytest.mark.parametrize("rare_max", [8, 64])
def test_components_with_null_and_repeated_ids(spark, rare_max):
    from starweave.llm.jaccard_join import near_duplicates

    rows = without_ids(rare_max, 300)
    group = brute_components([(i, t) for i, _, t in rows])
    least = {}
    for i, doc_id, _ in rows:
        if doc_id is not None and i in group:
            least[group[i][1]] = min(doc_id, least.get(group[i][1], doc_id))
    want = []
    for i, doc_id, _ in rows:
        alone = group[i][0] == 0
        want.append((doc_id, group[i][0], doc_id if alone else least.get(group[i][1])))
    docs = spark.createDataFrame([(d, t) for _, d, t in rows], "doc_id long, text string").repartition(4)
    got = [(r.doc_id, r.n_shingles, r.component_id) for r in near_duplicates(docs, rare_max=rare_max).collect()]
    assert sorted(got, key=str) == sorted(want, key=str)


def test_pipeline_drops_rows_without_or_with_repeated_ids(spark, tmp_path):
    import corpus_pipeline as cp

    rows = without_ids(3, 200)
    docs = spark.createDataFrame(rows, "row long, doc_id long, text string")
    kept = {r.row for r in cp.drop_near_copies(spark, docs, "").collect()}
    group = brute_components([(i, t) for i, _, t in rows])
    id_of = {i: d for i, d, _ in rows}
    members = {}
    for i in group:
        members.setdefault(group[i][1], []).append(i)
    for found in members.values():
        words = group[found[0]][0]
        staying = [i for i in found if i in kept]
        if words:
            ids = [id_of[i] for i in found if id_of[i] is not None]
            assert len(staying) == 1 and id_of[staying[0]] == min(ids, default=None)
        elif id_of[found[0]] is None:
            assert staying == found

    item = "which river flows through the old town of the grey castle? the little winding silver river does"
    spark.createDataFrame([(1, item)], "item_id long, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    clean = "a text about something else that nobody asked for in any test"
    docs = spark.createDataFrame([(None, f"x {item} y"), (1, item), (1, clean), (None, clean)], "doc_id long, text string")
    got = cp.drop_contaminated(spark, docs, str(tmp_path)).collect()
    assert sorted((r.doc_id or 0, r.text) for r in got) == [(0, clean), (1, clean)]


def test_star_contraction(spark):
    from starweave.llm.components import components

    chain = [(i, i + 1) for i in range(0, 40)] + [(100, 101), (101, 100), (7, 7), (200, 300), (300, 250), (None, 4)]
    got = {r.node: r.root for r in components(spark.createDataFrame(chain, "a long, b long")).collect()}
    assert got == {**{i: 0 for i in range(41)}, 100: 100, 101: 100, 200: 200, 250: 200, 300: 200}


def test_mix_meets_targets_and_repeats(spark):
    from starweave.llm.mixing import mix, taken_words

    docs = read(spark, "documents")
    rows = taken_words(docs, block=64, bucket_rows=10).join(docs.select("doc_id", "source"), "doc_id").collect()
    by = {}
    for r in rows:
        assert 0 <= r.taken <= 3 * r["size"]
        s = by.setdefault(r.source, [0, r.target, r.source_size])
        s[0] += r.taken
    for took, target, size in by.values():
        assert target <= 3 * size and abs(took - target) < 1
    assert abs(sum(t for _, t, _ in by.values()) - sum(s for _, _, s in by.values())) < 1
    _, pieces = mix(docs, block=64, bucket_rows=10)
    per_slot = pieces.groupBy("slot").agg(F.sum("words").alias("w"), F.countDistinct("number", "block_no").alias("n")).collect()
    assert all(r.w <= 64 and r.n == 1 for r in per_slot)


def test_mix_reruns_agree_under_any_layout(spark):
    from starweave.llm.mixing import taken_words

    rng = random.Random(6)
    rows = [(None if i % 4 == 0 else i // 3, " ".join(["w"] * rng.randrange(1, 60)) + f" t{i % 50}", rng.choice(["a", "a", "b", None]))
            for i in range(240)]
    runs = []
    for layout in (1, 5, 17):
        rng.shuffle(rows)
        docs = spark.createDataFrame(rows, "doc_id long, text string, source string").repartition(layout)
        runs.append(sorted(map(str, taken_words(docs, block=32, bucket_rows=20).collect())))
    assert len(runs[0]) == 240 and runs[0] == runs[1] == runs[2]


def test_mix_points_of_far_slots(spark):
    from starweave.llm.mixing import point_of

    slots = [0, 1, 2, 3_470_000_000, 4_294_967_296, 10**11, 10**15, 2**62]
    got = spark.createDataFrame([(i,) for i in slots], "i long").select("i", point_of("i").alias("p")).collect()
    assert {r.i: r.p for r in got} == {i: i * 2654435769 % 2**32 for i in slots}


def test_mix_schedule_equals_brute_force(spark):
    from starweave.llm.mixing import schedule, targets

    sized = spark.createDataFrame([("a", 5000), ("b", 300), ("c", 900), (None, 77)], "source string, size long")
    by_source = targets(sized)
    words = {r.number: int(r.target) for r in by_source.collect()}
    total, block, at = sum(words.values()), 16, 0
    bounds, taken, want = {}, dict.fromkeys(words, 0), []
    for k in sorted(words):
        bounds[k] = (at, at + words[k])
        at += words[k]
    blocks = {k: -(-w // block) for k, w in words.items()}
    slots = -(-total // block)
    for i in range(slots):
        p = (i * 2654435769 % 2**32) / 2**32 * total
        k = next(k for k, (lo, hi) in bounds.items() if lo <= p < hi)
        if taken[k] < blocks[k]:
            want.append((k, taken[k], i))
        taken[k] += 1
    late = [(k, b) for k in sorted(words) for b in range(taken[k], blocks[k])]
    want += [(k, b, slots + j) for j, (k, b) in enumerate(late)]
    got = [(r.number, r.block_no, r.slot) for r in schedule(spark, by_source, block).collect()]
    assert sorted(got) == sorted(want)


def test_mixing_stage_meets_targets_with_null_and_repeated_ids(spark):
    import corpus_pipeline as cp
    from starweave.llm.mixing import sizes, targets

    rng = random.Random(9)
    rows = [(None if i % 4 == 0 else i // 2, " ".join(f"w{i}" for _ in range(rng.randrange(5, 30))), f"s{i % 7 % 3}", "en", i)
            for i in range(200)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string, lang string, n_chars long")
    want = {r.source: r.target for r in targets(sizes(docs)).collect()}
    out = cp.mix_sources(spark, docs, "")
    assert out.columns == docs.columns
    got = {r.source: r["sum(size)"] for r in sizes(out).groupBy("source").sum("size").collect()}
    assert set(got) == set(want) and all(abs(got[s] - want[s]) <= 30 for s in want)
    assert out.groupBy("n_chars").count().agg({"count": "max"}).first()[0] <= 3


def test_mix_defined_cases(spark):
    from starweave.llm.mixing import taken_words

    rows = [(1, "a b c", "x", 1), (2, None, "x", 1), (3, "", None, 1), (4, "d e", None, 1), (4, "d e", None, 1), (None, "f", "y", 1)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string, target int")
    out = taken_words(docs).collect()
    assert len(out) == 6 and sorted(r["size"] for r in out) == [0, 0, 1, 2, 2, 3]
    assert taken_words(docs.limit(0)).count() == 0
    assert {r.taken for r in taken_words(docs.filter("doc_id = 2")).collect()} == {0}


@pytest.mark.parametrize("shards", [1, 5, 24])
def test_shards_are_contiguous_and_balanced(spark, shards):
    from starweave.llm.sharding import shard_by_bytes

    docs = read(spark, "documents").union(read(spark, "documents"))
    texts = {r.doc_id: r.text for r in docs.collect()}
    rows = shard_by_bytes(docs, shards=shards).collect()
    assert len(rows) == docs.count()
    by = {}
    for r in rows:
        raw = (texts[r.doc_id] or "").encode()
        assert (r["size"], r.text_crc32, r.law, r.grown_shard) == (len(raw) + 8, zlib.crc32(raw), "bytes", None)
        by.setdefault(r.shard, []).append(r)
    most = max(r["size"] for r in rows)
    for part in by.values():
        assert sorted(r.slot for r in part) == list(range(len(part)))
        assert abs(sum(r["size"] for r in part) - sum(r["size"] for r in rows) / shards) <= 2 * most
    spans = sorted((min(r.text_crc32 for r in p), max(r.text_crc32 for r in p)) for p in by.values())
    assert all(a[1] <= b[0] for a, b in zip(spans, spans[1:]))


@pytest.mark.parametrize("shards,tolerance", [(24, 0.02), (7, 0.5), (3, 0.0)])
def test_shards_equal_brute_force(spark, shards, tolerance):
    from xxhash import xxh64_intdigest

    from starweave.llm.sharding import shard_by_bytes

    docs = read(spark, "documents").select("doc_id", "text")
    docs = docs.union(docs.filter("doc_id < 40")).union(docs.filter("doc_id < 5").selectExpr("doc_id + 900000", "text"))
    docs = docs.union(docs.filter("doc_id = 3").selectExpr("explode(sequence(800000, 800060))", "text"))  # a hot text

    def key(row):
        raw = (row.text or "").encode()
        h = xxh64_intdigest(row.doc_id.to_bytes(8, "little", signed=True), 42)
        return zlib.crc32(raw), len(raw) + 8, h - (1 << 64) * (h >> 63), row.doc_id

    rows = sorted(map(key, docs.collect()))
    begins, at = [], 0
    for r in rows:
        begins.append(at)
        at += r[1]
    cuts = []
    for k in range(1, shards):
        cut = at * k // shards
        for r, b in zip(rows, begins):
            if b < cut < b + r[1]:
                same = [c for q, c in zip(rows, begins) if q[:2] == r[:2]]
                lo, hi = min(same), max(same) + r[1]
                end = lo if cut - lo <= hi - cut else hi
                if abs(end - cut) > tolerance * at / shards:
                    end = b if cut - b <= b + r[1] - cut else b + r[1]
                cut = end
                break
        cuts.append(cut)
    want, next_slot = [], {}
    for (crc, size, _, doc_id), b in zip(rows, begins):
        s = sum(b >= c for c in cuts)
        want.append((doc_id, size, crc, s, next_slot.get(s, 0)))
        next_slot[s] = next_slot.get(s, 0) + 1
    got = [(r.doc_id, r["size"], r.text_crc32, r.shard, r.slot)
           for r in shard_by_bytes(docs.repartition(5), shards=shards, tolerance=tolerance).collect()]
    assert sorted(got) == sorted(want)


def test_shards_defined_cases(spark):
    from starweave.llm.sharding import shard_by_bytes

    rows = [(1, "same", 0), (1, "same", 0), (2, None, 0), (None, "", 0), (3, "x" * 100_000, 0)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, size int")
    out = shard_by_bytes(docs, keep=["text"]).collect()
    assert sorted((r.doc_id or 0, r["size"], r.text_crc32 if not r.text else 1) for r in out) == [
        (0, 8, 0), (1, 12, 1), (1, 12, 1), (2, 8, 0), (3, 100_008, 1)]
    assert shard_by_bytes(docs.limit(0)).count() == 0


def test_url_lists_as_of(spark):
    from datetime import date

    from starweave.llm.url_lists import evaluate

    def day(n):
        return date(2024, 1, n)

    changes = spark.createDataFrame(
        [("block", "bad.example", day(5), "add"), ("block", "bad.example", day(5), "add"), ("block", "bad.example", day(10), "remove"),
         ("block", "bad.example", day(20), "add"), ("allow", "www.bad.example/ok", day(1), "add"), ("block", None, day(1), "add"),
         ("block", "other.example", day(9), "remove"), ("block", "odd.example", day(2), "flag")],
        "list string, entry string, day date, action string")
    urls = ["http://www.bad.example/x", "http://www.bad.example/ok?q", "http://notbad.example/", None, "", "odd.example",
            "HTTPS://user@BAD.example:80/"]
    captures = spark.createDataFrame([(n, u, day(n)) for u in urls for n in range(1, 28)] + [(99, urls[0], None)],
                                     "page_id long, url string, day date")
    out = evaluate(captures, changes).collect()
    assert len(out) == captures.count()
    for r in out:
        n = r.page_id
        active = (5 <= n < 10 or 20 <= n) and n != 99
        assert r.blocked == (active and r.url in (urls[0], urls[6])), r
        if r.url == urls[1]:
            assert r.list == "allow" and r.n_active == 1 + active
    assert evaluate(captures, changes.limit(0)).filter("blocked").count() == 0
    assert evaluate(captures.limit(0), changes).count() == 0


def test_url_lists_take_entries_of_any_form_and_day(spark):
    from datetime import date

    from starweave.llm.url_lists import evaluate

    entries = ["ex.com/a/b", "Bad.COM", "https://Deep.example/X/y/", "example.org/only", "ok.com", "zz", "path.example/a/b/c/d/e"]
    changes = spark.createDataFrame([("block", e, date(2024, 1, 1), "add") for e in entries] + [
        ("block", "", date(2024, 1, 1), "add"), ("block", "/x", date(2024, 1, 1), "add"),
        ("block", "old.example", date(1990, 1, 1), "add"), ("block", "old.example", date(2030, 6, 15), "remove")],
        "list string, entry string, day date, action string")
    late = date(2101, 5, 5)
    cases = [("http://ex.com/a/b/c?q", late, True), ("http://ex.com/a/bc", late, False), ("http://ex.com/a", late, False),
             ("http://www.bad.com/", late, True), ("http://deep.example/X/y", date(9999, 12, 31), True),
             ("http://deep.example/x/y", late, False), ("http://www.example.org/only/this", late, True),
             ("http://ok.com./z", late, True), ("http://host.zz/", late, True), ("http://zz/", late, True),
             ("http://path.example/a/b/c/d/e/f", late, True), ("http://path.example/a/b/c/d/", late, False),
             ("http://old.example/", date(2030, 6, 14), True), ("http://old.example/", date(2030, 6, 15), False),
             ("http://ex.com" + "/a" * 200_000, late, False), ("http://ex.com/a/b" + "/c" * 200_000, late, True)]
    got = evaluate(spark.createDataFrame([(i, u, d) for i, (u, d, _) in enumerate(cases)], "page_id long, url string, day date"), changes)
    assert {r.page_id: r.blocked for r in got.collect()} == {i: b for i, (_, _, b) in enumerate(cases)}


def test_sql_oracles(spark):
    import os
    import sys

    sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    from oracle_check import compare, duck

    from starweave.llm.catalog import ORACLES, QUERIES

    con = duck(SMALL)
    for name, sql in ORACLES.items():
        assert compare(spark, con, name, QUERIES[name], sql, SMALL), name


def test_pipeline_stages_against_brute_force(spark):
    import corpus_pipeline as cp
    from starweave.llm import mixing, toxicity

    d = "/root/testdata/sf0.01"
    docs = read(spark, "documents", d)
    kept = docs
    frames = []
    for _, stage in cp.STAGES:
        frames.append(kept)
        kept = stage(spark, kept, d)
        kept = spark.createDataFrame(kept.collect(), kept.schema)
    frames.append(kept)
    assert all(f.columns == docs.columns for f in frames[:-1])
    ids = [[r.doc_id for r in f.select("doc_id").collect()] for f in frames]
    toxic = {r.doc_id for r in toxicity.score_toxicity(docs, read(spark, "labels", d)).filter("predicted = 1").collect()}
    assert set(ids[1]) == set(ids[0]) - toxic and len(ids[1]) == len(set(ids[1]))
    groups = brute_components([(r.doc_id, r.text) for r in frames[1].collect()])
    assert sorted(ids[2]) == sorted(i for i, (_, c) in groups.items() if c == i)
    items = [r.text for r in read(spark, "benchmark", d).collect()]
    leaked = {r.doc_id for r in frames[2].collect() if any(b in (r.text or "") for b in items)}
    assert leaked and not leaked & set(ids[3]) and len(ids[3]) >= len(ids[2]) - len(leaked) - 2
    taken = {r.doc_id: r for r in mixing.taken_words(frames[3]).collect()}
    for i in set(ids[3]):
        t = taken[i]
        assert ids[4].count(i) == (1 if not t["size"] else (2 * t.taken + t["size"]) // (2 * t["size"]))
    assert sorted(ids[5]) == sorted(ids[4])
    again = cp.run(spark, d)
    assert sorted(r.doc_id for r in again.collect()) == sorted(ids[5])
