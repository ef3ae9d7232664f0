"""Near-duplicate components by an exact set join on word shingles with token-combination prefixes.

Two texts link when their sets of k-word shingles (tokens) have a Jaccard similarity of ``num/den`` or more. Steps:

1. Token classes. Every task counts the tokens of its texts, each distinct text of a flush once, and sends them
   packed to cells (ranges of the token hash). A token in more than ``rare_max`` texts is *frequent*; should more
   than ``frequent_max`` tokens be, the limit rises until that many are left, which bounds the broadcast list and
   costs only time.
2. Prefixes. In one global order (rare tokens by hash, then frequent ones by hash) a set x keeps its first
   ``p = |x| - ceil(t|x|) + 1`` tokens: linked sets share one of them. Rare ones are indexed as single tokens. A set
   with fewer than p rare tokens is *hot*. Two hot sets without a common rare token share at least two tokens of
   their prefixes extended by one, all frequent, so these are matched on 2-token combinations, inside classes of hot
   sets that are connected over frequent prefix tokens. Hot sets with the same frequent tokens and size are one
   pattern; the patterns of a class meet block against block, so no task holds a whole class.
3. Verify. For a pair found by rare tokens, the count of shared ones plus what lies beyond the prefixes bounds the
   overlap; pairs that still can reach the limit are compared on their whole sets, made again from texts found by
   their hash, so null and repeated ids do not matter. Hot pairs share frequent tokens
   only (else the rare index has them), which the blocks count exactly.
4. Components of the links by star contraction. Equal sets are one node throughout.

Nothing is capped: a class, a token or a group of copies of any size only adds rows.

Defined cases: a text without words, an empty or a null text has no shingles and is alone; a text of fewer than k
words has one shingle, its whole sequence; repeated rows and equal texts share a component; a null ``doc_id`` never
names a component but its row gets one (null if all its members' ids are null). Other columns of the input,
whatever their names, are ignored.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import materialize
from .common import checked_broadcast, slices, utf8_column
from .components import components
from .words import shingle_hashes, sorted_sets, word_hashes

#: Tokens that a task gathers before it sends them to the cells.
FLUSH_TOKENS = 2_000_000
#: Patterns of a class that one task compares with as many others.
BLOCK = 512
#: Columns of the token matrix that a block comparison holds at once.
BLOCK_TOKENS = 4096
#: Parts of the sets that share a hot token.
SALTS = 64


def cell_bits(docs: DataFrame, text: str = "text", cell_bytes: int = 12 << 20) -> int:
    """Bits of the cell number, so that a cell gets the tokens of about ``cell_bytes`` of text, whatever the input."""
    total = docs.agg(F.sum(F.octet_length(F.col(text).cast("string")))).first()[0] or 0
    return max(6, int(total // cell_bytes).bit_length())


def _sets(batch: pa.RecordBatch, at: int, k: int):
    """The sorted shingle sets of the batch's texts, slice by slice."""
    raw, offsets = utf8_column(batch.column(at))
    for i, j in slices(offsets):
        words, counts = word_hashes(raw, offsets[i : j + 1], fold=True)
        yield i, sorted_sets(*shingle_hashes(words, counts, k))


def _signature(tokens: np.ndarray) -> int:
    """A 63-bit hash of a whole set (of its sorted tokens)."""
    if not len(tokens):
        return -1
    from xxhash import xxh3_64_intdigest

    return xxh3_64_intdigest(tokens.tobytes()) >> 1


def _split(keys: np.ndarray, bits: int):
    """(cell, from, to) of the runs of sorted ``keys`` that share a cell."""
    cells = keys >> np.uint64(64 - bits)
    edges = np.flatnonzero(np.concatenate(([True], cells[1:] != cells[:-1], [True])))
    for a, b in zip(edges[:-1].tolist(), edges[1:].tolist()):
        yield int(cells[a]), a, b


# ---- 1. token classes

_COUNTED = "cell int, keys binary, counts binary"


def _count_task(k: int, bits: int):
    def pack(found: list[np.ndarray]) -> pa.RecordBatch:
        keys, n = np.unique(np.concatenate(found), return_counts=True)
        low = (keys >> np.uint64(32 - bits)).astype(np.uint32)
        rows = [(c, low[a:b].tobytes(), b"" if (n[a:b] == 1).all() else n[a:b].astype(np.uint32).tobytes())
                for c, a, b in _split(keys, bits)]
        return pa.RecordBatch.from_arrays(
            [pa.array([r[0] for r in rows], pa.int32()), pa.array([r[1] for r in rows], pa.binary()),
             pa.array([r[2] for r in rows], pa.binary())], ["cell", "keys", "counts"])

    def task(rows):
        found, held, seen = [], 0, set()
        for batch in rows:
            for _, sets in _sets(batch, 0, k):
                for s in sets:
                    if len(s) and (g := _signature(s)) not in seen:
                        seen.add(g)
                        found.append(s)
                        held += len(s)
                if held >= FLUSH_TOKENS:
                    yield pack(found)
                    found, held, seen = [], 0, set()
        if held:
            yield pack(found)

    return task


def _frequent_of(limit: int):
    def one(key, g):
        keys = [np.frombuffer(x, np.uint32) for x in g["keys"]]
        n = [np.frombuffer(c, np.uint32) if len(c) else np.ones(len(x), np.uint32) for x, c in zip(keys, g["counts"])]
        keys, n = np.concatenate(keys), np.concatenate(n)
        order = np.argsort(keys, kind="stable")
        keys, n = keys[order], n[order]
        first = np.flatnonzero(np.concatenate(([True], keys[1:] != keys[:-1])))
        total = np.add.reduceat(n.astype(np.int64), first)
        hot = total > limit
        return pd.DataFrame({"cell": np.int32(key[0]), "low": keys[first][hot].astype(np.int64), "n": total[hot]})

    return one


def frequent_tokens(docs: DataFrame, k: int, bits: int, rare_max: int, frequent_max: int) -> np.ndarray:
    """Sorted leading 32 + ``bits`` bits of the hashes of frequent tokens, ``frequent_max`` at most: 8 MB a million."""
    found = materialize(
        docs.select("text").mapInArrow(_count_task(k, bits), _COUNTED).groupBy("cell")
        .applyInPandas(_frequent_of(rare_max), "cell int, low long, n long"), "frequent")
    n = found.count()
    if n > frequent_max:  # keep those above the count at that rank
        at = found.approxQuantile("n", [1.0 - frequent_max / n], 0.001)[0]
        while (kept := found.filter(F.col("n") > at)).count() > frequent_max:
            at = at * 1.1 + 1
        found = kept
    got = found.select("cell", "low").toPandas()
    return np.sort((got["cell"].to_numpy().astype(np.uint64) << np.uint64(32)) | got["low"].to_numpy().astype(np.uint64))


# ---- 2. prefixes

_PREFIXED = ("doc_id long, key long, sig long, n int, rare int, near binary, frequent binary, "
             "cell int, keys binary, sigs binary, sizes binary")


def _is_frequent(tokens: np.ndarray, frequent: np.ndarray, bits: int) -> np.ndarray:
    if not len(frequent):
        return np.zeros(len(tokens), dtype=bool)
    key = tokens >> np.uint64(32 - bits)
    at = np.minimum(np.searchsorted(frequent, key), len(frequent) - 1)
    return frequent[at] == key


def _prefix_task(k: int, bits: int, num: int, den: int, shared):
    """Documents (one row each), and the index entries of their rare prefix tokens (packed, with a null doc row)."""

    def entries(keys, sigs, sizes) -> list[tuple]:
        keys, sigs, sizes = (np.concatenate(x) for x in (keys, sigs, sizes))
        order = np.argsort(keys, kind="stable")
        keys, sigs, sizes = keys[order], sigs[order], sizes[order]
        low = (keys >> np.uint64(32 - bits)).astype(np.uint32)
        return [(None,) * 7 + (c, low[a:b].tobytes(), sigs[a:b].tobytes(), sizes[a:b].tobytes())
                for c, a, b in _split(keys, bits)]

    names = [x.split()[0] for x in _PREFIXED.split(", ")]
    kinds = [pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.binary(), pa.binary(), pa.int32()] + [pa.binary()] * 3

    def out(rows: list[tuple]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), kinds)], names)

    def task(rows):
        frequent = shared.value
        keys, sigs, sizes, held, seen = [], [], [], 0, set()
        for batch in rows:
            ids, hashes = batch.column(0).to_pylist(), batch.column(2).to_pylist()
            for i, sets in _sets(batch, 1, k):
                made = []
                hot = _is_frequent(np.concatenate(sets), frequent, bits) if sets else None
                at = 0
                for doc_id, key, s in zip(ids[i:], hashes[i:], sets):
                    n, sig = len(s), _signature(s)
                    often, at = hot[at : at + n], at + n
                    if not n:
                        made.append((doc_id, key, None, 0, 0, None, None) + (None,) * 4)
                        continue
                    p = n - (num * n + den - 1) // den + 1
                    rare = s[~often] if often.any() else s
                    near = whole = None
                    if len(rare) < p:
                        whole = s[often]
                        near = whole[: p + 1 - len(rare)].tobytes()
                        whole = whole.tobytes()
                    rare = rare[:p]
                    made.append((doc_id, key, sig, n, len(rare), near, whole) + (None,) * 4)
                    if sig not in seen and len(rare):
                        seen.add(sig)
                        keys.append(rare)
                        sigs.append(np.full(len(rare), sig, np.int64))
                        sizes.append(np.full(len(rare), min(n, 65535), np.uint16))
                        held += len(rare)
                yield out(made)
                if held >= FLUSH_TOKENS // 4:
                    yield out(entries(keys, sigs, sizes))
                    keys, sigs, sizes, held, seen = [], [], [], 0, set()
        if held:
            yield out(entries(keys, sigs, sizes))

    return task


def _pairs_of_cell(num: int, den: int):
    """Distinct pairs of sets that share rare tokens of a cell, with the number of these; sizes that rule a link out
    are left away."""

    def may_link(x, y):
        small, large = np.minimum(x, y), np.maximum(x, y)
        return (large == 65535) | (small.astype(np.int64) * den >= large.astype(np.int64) * num)

    def one(key, g):
        keys = np.concatenate([np.frombuffer(x, np.uint32) for x in g["keys"]])
        sigs = np.concatenate([np.frombuffer(x, np.int64) for x in g["sigs"]])
        sizes = np.concatenate([np.frombuffer(x, np.uint16) for x in g["sizes"]])
        order = np.lexsort((sigs, keys))
        keys, sigs, sizes = keys[order], sigs[order], sizes[order]
        new = np.concatenate(([True], (keys[1:] != keys[:-1]) | (sigs[1:] != sigs[:-1])))
        keys, sigs, sizes = keys[new], sigs[new], sizes[new]
        begin = np.flatnonzero(np.concatenate(([True], keys[1:] != keys[:-1], [True])))
        length = np.diff(begin)
        begin = begin[:-1]
        left, right = [], []
        for step in range(1, int(length.max(initial=1))):  # every entry with the one ``step`` further in its run
            runs = begin[length > step]
            n = length[length > step] - step
            a = np.arange(int(n.sum())) + np.repeat(runs - (np.cumsum(n) - n), n)
            a = a[may_link(sizes[a], sizes[a + step])]
            left.append(sigs[a])
            right.append(sigs[a + step])
        if not left or not sum(map(len, left)):
            return pd.DataFrame({"a": np.zeros(0, np.int64), "b": np.zeros(0, np.int64), "shared": np.zeros(0, np.int64)})
        a, b = np.concatenate(left), np.concatenate(right)
        order = np.lexsort((b, a))
        a, b = a[order], b[order]
        first = np.flatnonzero(np.concatenate(([True], (a[1:] != a[:-1]) | (b[1:] != b[:-1]))))
        return pd.DataFrame({"a": a[first], "b": b[first], "shared": np.diff(np.append(first, len(a)))})

    return one


# ---- hot sets

def _block_links(num: int, den: int):
    """Links between the patterns of two blocks of a class: a spanning forest of them, as (a, b)."""

    def one(key, g):
        i, j = key[1], key[2]
        rows = g[g["block"] == i].reset_index(drop=True)
        cols = rows if i == j else g[g["block"] == j].reset_index(drop=True)

        def table(blobs_r, blobs_c):
            """Number of common tokens of every row with every column."""
            r = [np.frombuffer(x, np.uint64) for x in blobs_r]
            c = [np.frombuffer(x, np.uint64) for x in blobs_c]
            both = np.unique(np.concatenate(r)), np.unique(np.concatenate(c))
            used = np.intersect1d(*both, assume_unique=True)
            total = np.zeros((len(r), len(c)), np.float32)
            for at in range(0, len(used), BLOCK_TOKENS):
                part = used[at : at + BLOCK_TOKENS]

                def incidence(sets):
                    m = np.zeros((len(sets), len(part)), np.float32)
                    for q, s in enumerate(sets):
                        s = s[(s >= part[0]) & (s <= part[-1])]
                        pos = np.searchsorted(part, s)
                        m[q, pos[part[pos] == s]] = 1
                    return m

                total += incidence(r) @ incidence(c).T
            return total

        nr, nc = rows["n"].to_numpy(np.int64)[:, None], cols["n"].to_numpy(np.int64)[None, :]
        match = (table(rows["near"], cols["near"]) >= 2) & (
            (num + den) * table(rows["frequent"], cols["frequent"]) >= num * (nr + nc))
        a_ids, b_ids = rows["sig"].to_numpy(), cols["sig"].to_numpy()
        if i == j:
            np.fill_diagonal(match, False)
        # spanning forest of the links: breadth first from each unreached row
        edges, open_r, open_c = [], match.any(axis=1), np.ones(match.shape[1], bool)
        for seed in np.flatnonzero(open_r).tolist():
            if not open_r[seed]:
                continue
            open_r[seed] = False
            todo = [seed]
            while todo:
                r = todo.pop()
                reach = np.flatnonzero(match[r] & open_c)
                open_c[reach] = False
                edges += [(a_ids[r], b_ids[c]) for c in reach.tolist()]
                if len(reach):
                    more = np.flatnonzero(open_r & match[:, reach].any(axis=1))
                    for m in more.tolist():
                        edges.append((a_ids[m], b_ids[reach[int(np.argmax(match[m, reach]))]]))
                    open_r[more] = False
                    todo += more.tolist()
        return pd.DataFrame(edges, columns=["a", "b"], dtype=np.int64)

    return one


def _near_tokens(rows):
    for batch in rows:
        near = [np.frombuffer(x, np.int64) for x in batch.column(1).to_pylist()]
        n = [len(x) for x in near]
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.repeat(batch.column(0).to_numpy(), n)), pa.array(np.concatenate(near) if near else [], pa.int64())],
            ["sig", "token"])


def hot_links(hot: DataFrame, num: int, den: int) -> DataFrame:
    """Links (a, b) of hot sets ``hot`` (sig, n, near, frequent; one row a set) that share no rare token."""
    # the sets of a token are tied to their least one in two steps, so a hot token is many tasks
    at = hot.select("sig", "near").mapInArrow(_near_tokens, "sig long, token long").withColumn(
        "salt", F.pmod(F.xxhash64("sig"), F.lit(SALTS)))
    some = materialize(at.groupBy("token", "salt").agg(F.min("sig").alias("b")), "token_ends")
    least = some.groupBy("token").agg(F.min("b").alias("a"))
    ties = at.join(some, ["token", "salt"]).select(F.col("sig").alias("a"), "b").union(
        some.join(least, "token").select(F.col("b").alias("a"), F.col("a").alias("b")))
    group = components(ties.distinct())
    members = materialize(
        hot.join(group.withColumnRenamed("node", "sig"), "sig")  # a set alone on its tokens has no class
        .withColumn("pattern", F.xxhash64("frequent", "n", "near")), "hot")
    of = ["root", "pattern"]
    patterns = members.groupBy(*of).agg(
        F.min("sig").alias("sig"), F.count(F.lit(1)).alias("members"), F.first("n").alias("n"),
        F.first("near").alias("near"), F.first("frequent").alias("frequent"))
    blocks = patterns.groupBy("root").agg(F.ceil(F.count(F.lit(1)) / F.lit(BLOCK)).cast("int").alias("blocks"))
    dealt = patterns.join(checked_broadcast(blocks), "root").withColumn(
        "block", F.pmod(F.col("pattern"), F.col("blocks").cast("long")).cast("int"))
    met = dealt.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))).select(
        "root", F.least("block", "other").alias("i"), F.greatest("block", "other").alias("j"),
        "block", "sig", "n", "near", "frequent")
    between = materialize(
        met.groupBy("root", "i", "j").applyInPandas(_block_links(num, den), "a long, b long"), "hot_links")
    # sets of one pattern: linked by themselves, or by any link of the pattern (all its sets have that link)
    linked = between.select(F.col("a").alias("sig")).union(between.select(F.col("b").alias("sig"))).distinct()
    whole = patterns.filter("members > 1").withColumn(
        "self", F.expr(f"{num + den} * (octet_length(frequent) div 8) >= {num} * 2 * n")).join(
        linked.withColumn("linked", F.lit(True)), "sig", "left").filter("self or linked")
    same = members.select(*of, F.col("sig").alias("a")).join(
        whole.select(*of, F.col("sig").alias("b")), of).filter("a <> b").select("a", "b")
    return between.union(same)


# ---- 3. verify

def _token_task(k: int):
    def task(rows):
        for batch in rows:
            for _, sets in _sets(batch, 0, k):
                yield pa.RecordBatch.from_arrays(
                    [pa.array([_signature(s) for s in sets], pa.int64()), pa.array([s.tobytes() for s in sets], pa.binary())],
                    ["sig", "tokens"])

    return task


def _verify_task(num: int, den: int):
    def task(rows):
        for batch in rows:
            a, b, x, y = (c.to_pylist() for c in batch.columns)
            keep = []
            for p, q in zip(x, y):
                p, q = np.frombuffer(p, np.uint64), np.frombuffer(q, np.uint64)
                common = len(np.intersect1d(p, q, assume_unique=True))
                keep.append(common * den >= num * (len(p) + len(q) - common))
            yield pa.RecordBatch.from_arrays(
                [pa.array([v for v, k in zip(c, keep) if k], pa.int64()) for c in (a, b)], ["a", "b"])

    return task


def near_duplicates(docs: DataFrame, *, k: int = 5, num: int = 75, den: int = 100, rare_max: int = 64,
                    frequent_max: int = 1 << 20) -> DataFrame:
    """(doc_id, n_shingles, component_id, n_copies) for every row of ``docs`` (doc_id, text). ``component_id`` is the
    smallest doc_id reachable by links, n_copies the number of rows with the same set. See the module text."""
    spark: SparkSession = docs.sparkSession
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    bits = cell_bits(docs)
    shared = spark.sparkContext.broadcast(frequent_tokens(docs, k, bits, rare_max, frequent_max))
    by_text = docs.withColumn("key", F.xxhash64("text"))
    made = materialize(by_text.mapInArrow(_prefix_task(k, bits, num, den, shared), _PREFIXED), "prefixes")
    rows = made.filter("n is not null").select("doc_id", "key", "sig", "n", "rare")
    nodes = materialize(
        rows.filter("sig is not null").groupBy("sig").agg(
            F.min("doc_id").alias("rep"), F.min("key").alias("key"), F.count(F.lit(1)).alias("copies"), F.max("n").alias("n"),
            F.max("rare").alias("rare")), "sets")

    pairs = made.filter("cell is not null").select("cell", "keys", "sigs", "sizes").groupBy("cell").applyInPandas(
        _pairs_of_cell(num, den), "a long, b long, shared long")
    pairs = pairs.groupBy("a", "b").agg(F.sum("shared").alias("shared"))
    side = nodes.select("sig", "n", (F.col("n") - F.col("rare")).alias("rest"))
    found = pairs.join(side.toDF("a", "na", "ra"), "a").join(side.toDF("b", "nb", "rb"), "b").filter(
        F.expr(f"{num + den} * (shared + greatest(ra, rb)) >= {num} * (na + nb)"))
    found = materialize(found.select("a", "b"), "candidates")
    ends = found.select(F.col("a").alias("sig")).union(found.select(F.col("b").alias("sig"))).distinct()
    wanted = materialize(ends.join(nodes, "sig").select("key"), "wanted")
    texts = by_text.join(checked_broadcast(wanted, 2_000_000), "key", "left_semi").select("key", "text")
    tokens = texts.dropDuplicates(["key"]).select("text").mapInArrow(_token_task(k), "sig long, tokens binary")
    tokens = materialize(tokens, "tokens")
    links = found.join(tokens.toDF("a", "x"), "a").join(tokens.toDF("b", "y"), "b").select("a", "b", "x", "y").mapInArrow(
        _verify_task(num, den), "a long, b long")

    hot = made.filter("near is not null").select("sig", "n", "near", "frequent").dropDuplicates(["sig"])
    links = links.union(hot_links(hot, num, den))

    group = components(links).withColumnRenamed("node", "sig")
    named = nodes.join(group, "sig", "left").filter("copies > 1 or root is not null").select(
        "sig", "copies", "rep", F.coalesce("root", "sig").alias("root"))
    named = materialize(named, "groups")
    least = named.groupBy("root").agg(F.min("rep").alias("component_id"))
    named = named.join(least, "root").select("sig", "copies", "component_id")
    return rows.join(named, "sig", "left").select(
        "doc_id", F.col("n").cast("long").alias("n_shingles"),
        F.coalesce("component_id", "doc_id").alias("component_id"),
        F.coalesce("copies", F.lit(1)).cast("long").alias("n_copies"))
