"""Token counts, toxicity, pseudonyms, page text, decontamination and quality rules on small fixtures."""

import random
import re
import zlib

import pytest
from pyspark.sql import functions as F

SMALL = "/root/testdata/sf0.001"
AWKWARD = [(1, "plain words here", "en", "s"), (2, None, None, None), (3, "", "en", "s"), (3, "", "en", "s"),
           (None, "no id at all", "en", "s"), (4, "x" * 30_000 + " " + "long word " * 4000, "de", None),
           (5, " \t\n ", "fr", "t")]
SCHEMA = "doc_id long, text string, lang string, source string, `n words` int, score string"


@pytest.fixture(scope="module")
def awkward(spark):
    """Nulls, empty, very long and repeated rows, and extra columns with names that the operators use themselves."""
    return spark.createDataFrame([(*r, 7, "own") for r in AWKWARD], SCHEMA)


def read(spark, name):
    return spark.read.parquet(f"{SMALL}/{name}.parquet")


def test_token_counts_equal_the_library(spark, awkward):
    import public_tokenizers
    from sentencepiece import SentencePieceProcessor

    from starweave.llm.tokens import count_tokens

    library = SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))
    random.seed(4)
    odd = ["".join(random.choice("ab \n\t▁  éßñ漢字😀​<s>0123.,THE'") for _ in range(30)) for _ in range(300)]
    docs = read(spark, "documents").select("doc_id", "text").union(awkward.select("doc_id", "text")).union(
        spark.createDataFrame(list(enumerate(odd)), "doc_id long, text string"))
    texts = {}
    for r in docs.collect():
        texts.setdefault((r.doc_id, len((r.text or "").encode())), set()).add(len(library.encode(r.text or "")))
    rows = count_tokens(docs).collect()
    assert len(rows) == docs.count()
    for r in rows:
        assert r.n_tokens in texts[r.doc_id, r.n_bytes]
        assert r.over_limit == (r.n_tokens > 4096)
    assert count_tokens(docs.limit(0)).count() == 0


def test_toxicity_finds_held_out_toxic_documents(spark):
    from starweave.llm.toxicity import score_toxicity

    d = "/root/testdata/sf0.01"
    labels = spark.read.parquet(f"{d}/labels.parquet")
    rows = score_toxicity(spark.read.parquet(f"{d}/documents.parquet"), labels).join(labels, "doc_id").collect()
    for r in rows:
        assert 0 <= r.score <= 1 and r.predicted == int(r.score >= 0.5)
        assert r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0)
    held = [r for r in rows if r.held_out]
    caught = [r.predicted for r in held if r.toxic]
    clean = [r.predicted for r in held if not r.toxic]
    assert sum(caught) >= 0.5 * len(caught) and sum(clean) <= 0.05 * len(clean)


def test_toxicity_defined_cases(spark, awkward):
    from starweave.llm.toxicity import score_toxicity

    labels = spark.createDataFrame([(1, 1), (3, 0), (4, 0), (9, None)], "doc_id long, toxic int")
    assert score_toxicity(awkward, labels).count() == len(AWKWARD)
    assert all(r.score < 1e-6 for r in score_toxicity(awkward, labels.limit(0)).collect())
    assert score_toxicity(awkward.limit(0), labels).count() == 0


def test_pseudonyms_round_trip_and_stay_linked(spark):
    from starweave.llm.pseudonyms import pseudonymise

    texts = ["card 4539578763621486, again 4539-5787-6362-1486, no card 9999999999999999",
             "+1 (017) 555-7713 and +44 20 7946 0958, 10.1.2.255 but 256.1.1.1", "2024-02-29 31.12.1999 03/04/2020 2023-02-30",
             "123-45-6789 and 000-12-1234", None, "", "none", "4539578763621486 " * 2000]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").withColumn("n_card", F.lit("own"))
    out = {r.doc_id: r for r in pseudonymise(docs, "k").collect()}
    back = {r.doc_id: r.text for r in pseudonymise(spark.createDataFrame(
        [(i, r.text) for i, r in out.items()], "doc_id long, text string"), "k", inverse=True).collect()}
    assert back == dict(enumerate(texts))
    one, two = re.findall(r"[0-9-]{16,}", out[0].text)[:2]
    assert one == two.replace("-", "") != "4539578763621486" and out[0].n_card == 2 and "9999999999999999" in out[0].text
    assert set(out[7].text.split()) == {one} and out[7].n_card == 2000
    assert out[1].n_phone == 2 and out[1].n_ip == 1 and "256.1.1.1" in out[1].text
    assert out[2].n_date == 3 and "2023-02-30" in out[2].text and "2024-02-29" not in out[2].text
    assert out[3].n_ssn == 1 and "000-12-1234" in out[3].text
    assert (out[4].text, out[5].text, out[6].text) == (None, "", "none")
    assert pseudonymise(docs, "other key").filter("doc_id = 0").first().text != out[0].text
    assert pseudonymise(docs.limit(0), "k").count() == 0


def test_pseudonyms_of_more_phone_and_card_shapes(spark):
    from starweave.llm.pseudonyms import pseudonymise

    values = ["+33 6 12 34 56 78", "+61 4 1234 5678", "+44 (0)20 7946 0958", "(555) 123-4567", "+1 (017) 555-7713",
              "3782 822463 10005", "4111 1111 1111 1111"]
    texts = [f"call or pay {v} now" for v in values] + ["4111 1111 1111 1111 12/27", "+33 6 12 34 56 78, (555) 123-4567"]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    out = sorted(pseudonymise(docs, "k").collect())
    assert [(r.n_phone, r.n_card) for r in out] == [(1, 0)] * 5 + [(0, 1)] * 3 + [(2, 0)]
    for r, t in zip(out, texts):
        assert r.text != t and re.sub("[0-9]", "0", r.text) == re.sub("[0-9]", "0", t)
    assert out[7].text.endswith(" 12/27") and out[0].text.startswith("call or pay +33 ")
    back = pseudonymise(spark.createDataFrame([(r.doc_id, r.text) for r in out], "doc_id long, text string"), "k", inverse=True)
    assert [r.text for r in sorted(back.collect())] == texts


def test_feistel_is_a_permutation(spark):
    from starweave.llm.pseudonyms import feistel

    a, b = F.lit(9).cast("long"), F.lit(7).cast("long")
    df = spark.range(63).withColumn("y", feistel("k", F.lit("t"), F.lit(1), F.col("id"), a, b))
    assert sorted(r.y for r in df.collect()) == list(range(63))
    assert df.filter(feistel("k", F.lit("t"), F.lit(1), F.col("y"), a, b, inverse=True) != F.col("id")).count() == 0


def test_page_text_takes_the_article(spark):
    from html import unescape

    from starweave.llm.page_text import main_text

    pages = read(spark, "pages")
    html = {r.page_id: r.html for r in pages.collect()}
    for r in main_text(pages).collect():
        article = re.search(r"<article>(.*?)(</article>|$)", html[r.page_id], re.S)[1]
        want = " ".join(unescape(re.sub(r"<[^>]*>", " ", re.sub(r"</?(b|i)>", "", article))).split())
        assert r.text == want and r.n_chars == len(want)


def test_page_text_learns_template_and_slots(spark):
    from starweave.llm.page_text import main_text

    def page(i):
        return (f"<html><body><div><a href=/>Home</a> <a href=/x>About</a></div><div id=main><h1>T{i}</h1><p>Every page says "
                f"this.</p><div class='body'><p>text &eacute;{i}  one<p>two {i}<script>var x = '</p>';</script></div>"
                f"<div class='comments'><p>bad {i}</p></div></div><form><p>sign up</p></form><footer>by {i}</footer></body>")

    rows = [(i, f"https://h.example/{i}", page(i)) for i in range(6)]
    rows += [(10, None, None), (11, "nonsense", ""), (12, "https://h.example/9", "just words &amp; more"), (0, *rows[0][1:]),
             (13, "https://deep.example/", "<div>" * 3000 + "deep" + "</div>" * 3000)]
    out = [(r.page_id, r.text) for r in main_text(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()]
    assert len(out) == len(rows)
    texts = dict(out)
    for i in range(6):
        assert texts[i] == f"T{i} text é{i} one two {i}"
    assert texts[10] == texts[11] == "" and texts[12] == "just words & more" and texts[13] == "deep"
    assert main_text(spark.createDataFrame([], "page_id long, url string, html string")).count() == 0


def texts_of(spark, rows):
    from starweave.llm.page_text import main_text

    out = main_text(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()
    return {r.page_id: r.text for r in out}


def test_page_text_wrapper_decides_over_article_tags(spark):
    def page(i):
        cards = "".join(f"<article class=card><p>card {i} {j}</p></article>" for j in range(2))
        return f"<body><div class=top>{cards}</div><div class=body><h1>T{i}</h1><p>{f'long body text {i} ' * 9}</p></div>"

    def beside(i):
        return f"<body><div id=x><h1>T{i}</h1><article><p>{f'long body text {i} ' * 9}</p></article></div>"

    body = {i: " ".join([f"T{i}"] + [f"long body text {i}"] * 9) for i in range(5)}
    assert texts_of(spark, [(i, f"https://c.example/{i}", page(i)) for i in body]) == body
    assert texts_of(spark, [(i, f"https://t.example/{i}", beside(i)) for i in body]) == body


def test_page_text_of_copies_is_no_template(spark):
    def page(i, more=""):
        return (f"<body><nav>menu</nav><div class=note><p>On every page.</p></div><article><h1>T{i}</h1>"
                f"<p>{f'text of {i} ' * 9}</p>{more}</article></body>")

    body = {i: " ".join([f"T{i}"] + [f"text of {i}"] * 9) for i in range(4)}
    copies = [(i, f"https://one.example/{i}", page(0)) for i in range(5)]
    assert set(texts_of(spark, copies + copies[:1]).values()) == {body[0]}
    for quoted in range(4):  # one of them is the seed, with three copies
        rows = [(i, f"https://h.example/{i}", page(i, "<pre>own part</pre>" if i == quoted else "")) for i in body]
        rows += [(10 + j, f"https://h.example/{10 + j}", rows[quoted][2]) for j in range(3)]
        want = body | {quoted: body[quoted] + " own part"}
        assert texts_of(spark, rows) == want | {10 + j: want[quoted] for j in range(3)}


def test_page_text_keeps_article_parts_under_any_tags(spark):
    def body(i):
        return f"{f'text of {i} ' * 9}"

    pages = {
        "nohead": lambda i: f"<html><head><title>t</title><meta a=b><body><article><h1>T{i}</h1><p>{body(i)}</p></article>",
        "nobody": lambda i: f"<head><title>t</title><style>p {{}}</style><h1>T{i}</h1><p>{body(i)}</p>",
        "sidebar": lambda i: (f"<body><div class='layout has-sidebar'><article><h1>T{i}</h1><p>{body(i)}</p></article>"
                              f"<div class=sidebar><p>side {i}</p></div></div></body>"),
        "noside": lambda i: f"<div id='main-no-sidebar'><div><h1>T{i}</h1><p>{body(i)}</p></div></div><div class=comments>c {i}</div>",
        "title": lambda i: f"<article><header class='article-header'><h1>T{i}</h1></header><p>{body(i)}</p></article>",
        "links": lambda i: f"<article><h1>T{i}</h1><p>{body(i)}</p><ul><li><a href=/r>reference of {i}</a></ul></article>",
    }
    want = {n: {i: " ".join([f"T{i}"] + [f"text of {i}"] * 9) for i in range(4)} for n in pages}
    want["links"] = {i: t + f" reference of {i}" for i, t in want["links"].items()}
    for of in (1, 4):  # hosts with one page, and with a wrapper
        rows = [(100 * k + i, f"https://{n}.example/{i}", page(i)) for k, (n, page) in enumerate(pages.items()) for i in range(of)]
        assert texts_of(spark, rows) == {100 * k + i: want[n][i] for k, n in enumerate(pages) for i in range(of)}


def test_decontamination_finds_what_plain_search_finds(spark, awkward):
    from starweave.llm.decontaminate import contaminated

    d = "/root/testdata/sf0.01"
    docs, items = spark.read.parquet(f"{d}/documents.parquet"), spark.read.parquet(f"{d}/benchmark.parquet")
    got = {(r.doc_id, r.item_id) for r in contaminated(docs, items).collect()}
    want = {(x.doc_id, b.item_id) for x in docs.collect() for b in items.collect() if b.text in (x.text or "")}
    assert want and want <= got and len(got) <= len(want) + 2
    parted = {(r.doc_id, r.item_id) for r in contaminated(docs, items, part_postings=200).collect()}
    assert parted == got
    assert contaminated(awkward, items.limit(0)).count() == contaminated(awkward.limit(0), items).count() == 0
    odd = spark.createDataFrame([(1, None), (2, ""), (None, "plain words here"), (7, "plain words here")], "item_id long, text string")
    assert sorted((r.doc_id, r.item_id or 0) for r in contaminated(awkward, odd).collect()) == [(1, 0), (1, 7)]


def test_wand_retrieves_what_full_scoring_does():
    from starweave.llm.decontaminate import Index

    random.seed(1)
    rows, words = [], [f"w{i}" for i in range(60)]
    for s in range(300):
        terms = random.sample(words, 12)
        weights = [random.random() for _ in terms]
        rows += [(s, t, w / sum(weights)) for t, w in zip(terms, weights)]
    for threshold in (0.1, 0.3, 0.6):
        index = Index(rows, {s: s for s in range(300)}, {s: "t" for s in range(300)}, threshold)
        for _ in range(60):
            query = set(random.sample(words, random.randint(1, 20)))
            full = {}
            for s, t, w in rows:
                if t in query:
                    full[s] = full.get(s, 0) + w
            assert {s for s, _ in index.retrieve(sorted(query))} == {s for s, x in full.items() if x >= threshold - 1e-9}


def test_quality_measures_and_defined_cases(spark, awkward):
    from starweave.llm.quality import measure, quality_verdicts

    docs = read(spark, "documents")
    texts = {r.doc_id: r.text for r in docs.collect()}
    for r in measure(docs).collect():
        words = re.findall(r"[^\x20\x09-\x0D]+", texts[r.doc_id])
        runs = [tuple(words[i : i + 8]) for i in range(len(words) - 7)]
        count = {}
        for x in runs:
            count[x] = count.get(x, 0) + 1
        covered = {i + j for i, x in enumerate(runs) if count[x] > 1 for j in range(8)}
        assert (r.n_words, r.word_chars, r.n_repeat_words) == (len(words), sum(map(len, words)), len(covered))
        assert r.n_symbols == sum(c in "#*$%&|<>" for c in texts[r.doc_id])
    rows = quality_verdicts(awkward).collect()
    assert len(rows) == len(AWKWARD) and not any(r.kept for r in rows if r.n_words < 20)
    assert quality_verdicts(awkward.limit(0)).count() == 0


def test_quality_sketches_merge(spark):
    from starweave.llm.quality import measure, quantiles, sketch, with_rates

    rated = with_rates(measure(read(spark, "documents")))
    halves = [sketch(rated.filter(F.col("doc_id") % 2 == i)) for i in range(2)]
    key = ["lang", "source"]
    merged, whole = quantiles(halves[0].union(halves[1]), key), quantiles(sketch(rated), key)
    assert sorted(map(str, merged.collect())) == sorted(map(str, whole.collect()))


def test_page_text_puts_no_blank_into_words(spark):
    html = "<p>He<b>llo</b>, <a href=x>link</a>. Good<i>bye</i>!<br>Next<wbr>word &amp;<span> more</span></p>\n<p> two\n\tlines</p>"
    assert texts_of(spark, [(1, "https://a.example/", html)]) == {1: "Hello, link. Goodbye! Nextword & more two lines"}


def test_page_text_keeps_all_regions_of_the_body(spark):
    def two(i):
        return (f"<body><nav><a href=/>menu</a></nav><div><div><p>{f'first part {i} ' * 20}</p></div><div><p>{f'second {i} ' * 7}</p></div></div>"
                f"<div class=comments><p>reader {i} says</p></div></body>")

    def results(i):
        return (f"<body><article><h1>T{i}</h1><p>{f'text {i} ' * 9}</p><div class='search-results'><p>found {i}</p></div>"
                f"<h2 id='social-media'>Media {i}</h2><div class='share'><p>share {i}</p></div></article></body>")

    want = {i: " ".join([f"first part {i}"] * 20 + [f"second {i}"] * 7) for i in range(6)}
    assert texts_of(spark, [(i, f"https://two.example/{i}", two(i)) for i in want]) == want
    want = {i: " ".join([f"T{i}"] + [f"text {i}"] * 9 + [f"found {i}", f"Media {i}"]) for i in range(6)}
    assert texts_of(spark, [(i, f"https://res.example/{i}", results(i)) for i in want]) == want
    plain = {i: results(i).replace("article>", "div>") for i in want}  # the wrapper's region, without a tag that says so
    assert texts_of(spark, [(i, f"https://div.example/{i}", plain[i]) for i in want]) == want


def test_page_text_of_deep_wide_and_broken_pages(spark):
    from time import process_time

    from starweave.llm.page_text import extract

    deep = "<div>" * 200 + "<nav>MENU</nav><p>body<script>x</script> text</p><div class=ad>AD</div>" + "</div>" * 200
    assert extract(deep, None) == "body text"
    wide = "".join(f"<div>part {i}</div>" for i in range(5000))
    rows = [(k, f"https://w.example/{k}", wide.replace("part", f"part of {k}")) for k in range(4)]
    got = texts_of(spark, rows)
    assert got[2] == " ".join(f"part of 2 {i}" for i in range(5000))
    for broken in ("<b>x " * 100_000, "<b>" * 50_000 + "</i>" * 50_000 + "x", "<b>" * 50_000 + "<h2>x</h2>" * 20_000,
                   "<head>" + "<title>" * 3 + "<b>x " * 50_000, "<p><b>x" * 50_000, "<li>x" * 50_000):
        begun = process_time()
        assert "x" in extract(broken, None)
        assert process_time() - begun < 4


def changed(spark, texts, inverse=False):
    from starweave.llm.pseudonyms import pseudonymise

    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    return [r.text for r in sorted(pseudonymise(docs, "k", inverse).collect())]


def test_pseudonyms_of_very_long_mail_addresses(spark):
    long = ["a@" + "b." * 500_000 + "c", "a" * 1_000_000 + "@b.example", "x" * 1_000_000 + "@", "a@" + "b." * 300_000, "9" * 500_000]
    out = changed(spark, long)
    assert out[0].endswith(long[0][2:]) and len(out[0]) == len(long[0]) + 16 and out[1].endswith("@b.example") and len(out[1]) == 27
    assert out[2] == long[2] and out[3].endswith("b." * 300_000) and out[4] == long[4]


def test_pseudonyms_link_a_number_in_every_notation(spark):
    same = [["+33 6 12 34 56 78", "+33612345678", "+33-612-345-678"], ["+44 (0)20 7946 0958", "+44 20 7946 0958", "+442079460958"],
            ["+1 555 123 4567", "+1 (555) 123-4567", "+15551234567"], ["+358 40 123 4567", "+358401234567"]]
    code = ["33", "44", "1", "358"]
    for values, c in zip(same, code):
        out = changed(spark, [f"call {v} now" for v in values])
        dialled = {re.sub("[^0-9]", "", t.replace("(0)", "")) for t in out}
        assert len(dialled) == 1 and dialled.pop().startswith(c) and out[0] != f"call {values[0]} now"
        assert changed(spark, out, inverse=True) == [f"call {v} now" for v in values]
    assert changed(spark, ["+44 (0)20 7946 0958"])[0].startswith("+44 (0)")
    # a national number and the same after +1 end alike
    assert changed(spark, ["(555) 123-4567"])[0][-8:] == changed(spark, ["+1 (555) 123-4567"])[0][-8:]


def test_pseudonyms_of_all_dates_stay_dates(spark):
    from datetime import date, timedelta

    days = [str(date(1900, 1, 1) + timedelta(i)) for i in range(73_049)]
    out = changed(spark, days)
    assert sorted(out) == days
    assert changed(spark, out, inverse=True) == days


def test_feistel_equals_a_plain_one(spark):
    import hashlib

    from starweave.llm.pseudonyms import ROUNDS, _number

    def plain(key, kind, digits):
        n = len(digits)
        low = -(-n // 2)
        a, b = 10 ** (n - low), 10**low
        left, right = divmod(int(digits), b)
        for i in range(ROUNDS):
            half = right if i % 2 == 0 else left
            h = int(hashlib.sha256(f"{key}|{kind}|{n}|{i}|{half}".encode()).hexdigest()[:12], 16)
            if i % 2 == 0:
                left = (left + h) % a
            else:
                right = (right + h) % b
        return str(left * b + right).zfill(n)

    random.seed(3)
    numbers = ["".join(random.choice("0123456789") for _ in range(random.randint(2, 18))) for _ in range(300)]
    df = spark.createDataFrame([(x,) for x in numbers], "d string").select("d", _number("k", "card", F.col("d"), False).alias("p"))
    assert {r.d: r.p for r in df.collect()} == {x: plain("k", "card", x) for x in numbers}


def test_quality_fences_follow_their_group(spark):
    from starweave.llm.quality import LAW, fences, measure, quality_verdicts, sketch, with_rates

    d = "/root/testdata/sf0.1"
    docs, labels = spark.read.parquet(f"{d}/documents.parquet"), spark.read.parquet(f"{d}/labels.parquet")
    rated = with_rates(measure(docs))
    limits = fences(rated, sketch(rated)).collect()
    assert len(limits) == docs.select("lang", "source").distinct().count()
    for c in ("hi_dup_lines", "hi_repeats", "hi_word_len", "lo_word_len"):
        assert len({r[c] for r in limits}) > 5, c
    rows = quality_verdicts(docs).join(labels.select("doc_id", "quality"), "doc_id", "left").collect()
    passed = [r for r in rows if not r.base_failed]
    for m in LAW:  # each rule fails some document that the base rule lets pass
        assert any(r[m] > r[f"hi_{m}"] or (m == "word_len" and r[m] < r.lo_word_len) for r in passed), m
    clean, junk = ([r.kept for r in passed if r.quality == q] for q in (1, 0))
    assert sum(clean) >= 0.99 * len(clean) and sum(junk) <= 0.05 * len(junk)


def test_quality_fences_of_one_group_with_symbols(spark):
    from starweave.llm.quality import quality_verdicts

    words = " ".join(f"word{i}" for i in range(60))
    rows = [(i, f"{words} {'& ' * (i % 4)}x{i}", "en", "code") for i in range(200)] + [(1000 + i, f"{words} y{i}", "en", "prose") for i in range(200)]
    rows += [(2000, f"{words} & & &", "en", "prose"), (2001, f"{words} & & &", "en", "code"), (2002, words + " #" * 60, "en", "code"),
             (2003, words, None, None)]
    kept = {r.doc_id: r.kept for r in quality_verdicts(spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")).collect()}
    assert all(kept[i] for i in range(200)) and all(kept[1000 + i] for i in range(200))
    assert (kept[2000], kept[2001], kept[2002], kept[2003]) == (False, True, False, True)  # what is usual differs


def test_decontamination_of_very_long_items(spark):
    from time import time

    from starweave.llm.decontaminate import contaminated

    random.seed(8)
    words = [f"w{random.randrange(30_000)}" for _ in range(170_000)]
    long = " ".join(words)  # about 1 MB
    assert len(long) > 1_000_000
    items = spark.createDataFrame([(1, long), (2, "what is the name of the river here? the little silver winding river")], "item_id long, text string")
    docs = spark.createDataFrame(
        [(1, "before " + long + " after"), (2, " ".join(words[:400])), (3, "clean text of its own " * 50),
         (4, "x y what is the name of the river here? the little silver winding river z")], "doc_id long, text string")
    begun = time()
    got = {(r.doc_id, r.item_id) for r in contaminated(docs, items).collect()}
    assert got == {(1, 1), (4, 2)} and time() - begun < 90
    parted = {(r.doc_id, r.item_id) for r in contaminated(docs, items, part_bytes=100_000).collect()}
    assert parted == got


def test_decontamination_in_scripts_without_blanks(spark):
    from starweave.llm.decontaminate import contaminated, words_of

    random.seed(2)

    def run(first, n):
        return "".join(chr(first + random.randrange(300)) for _ in range(n))

    chinese = [run(0x4E00 + 1000 * k, 30) + "\uff1f" + run(0x4E00 + 1000 * k, 12) + "\u3002" for k in range(5)]
    thai = "".join(chr(0x0E01 + random.randrange(46)) for _ in range(60))
    items = spark.createDataFrame([(k, t) for k, t in enumerate([*chinese, thai])], "item_id long, text string")
    docs = [(k, run(0x6E00, 80) + t + run(0x6E00, 90)) for k, t in enumerate([*chinese, thai])] + [(100 + k, run(0x6E00, 300)) for k in range(5)]
    got = {(r.doc_id, r.item_id) for r in contaminated(spark.createDataFrame(docs, "doc_id long, text string"), items).collect()}
    assert got == {(k, k) for k in range(6)}
    assert words_of("caf\u00e9-bar \u6771\u4eac\u3002A1") == ["caf\u00e9", "bar", "\u6771", "\u4eac", "a1"]


def test_toxicity_equals_a_plain_model(spark):
    """The whole model again in plain Python and dense numpy: n-gram sets, log-count ratios, chosen features, regression."""
    import zlib

    import numpy as np

    from starweave.llm import toxicity as T

    random.seed(5)
    bad, good = ["vile", "scum", "hate you"], ["kind", "river", "thank you", "table"]
    rows = []
    for i in range(160):
        toxic = int(random.random() < 0.4)
        words = [random.choice(good) for _ in range(random.randrange(3, 9))] + [random.choice(bad)] * toxic
        random.shuffle(words)
        rows.append((i, " ".join(words), toxic))
    docs = spark.createDataFrame([(i, t) for i, t, _ in rows], "doc_id long, text string")
    labels = spark.createDataFrame([(i, y) for i, _, y in rows], "doc_id long, toxic int")
    got = {r.doc_id: r for r in T.score_toxicity(docs, labels).collect()}

    m, top = 0x9E3779B97F4A7C15, 1 << 64

    def grams(text):
        text = f" {text.lower()} "
        value = [((ord(c) + 1) * m) % top for c in text]
        value = [v ^ (v >> 29) for v in value]
        n_of = {}
        for n in range(3, 8):
            for i in range(len(text) - n + 1):
                run = 0
                for v in value[i : i + n]:
                    run = (run * m + v) % top
                h = ((run ^ (run >> 32)) * m % top) >> (64 - T.BITS)
                n_of[h] = n_of.get(h, 0) + 1
        return set(n_of) | {h ^ (1 << (T.BITS - 1)) for h, n in n_of.items() if n > 1}

    held = {i: zlib.crc32(str(i).encode()) % 5 == 0 for i, _, _ in rows}
    train = [(grams(t), y) for i, t, y in rows if not held[i]]
    n = [sum(1 for _, y in train if y == k) for k in (0, 1)]
    every = sorted(set().union(*(g for g, _ in train)))
    count = {h: [sum(1 for g, y in train if y == k and h in g) for k in (0, 1)] for h in every}
    share = {h: [(count[h][k] + 1) / (n[k] + 2) for k in (0, 1)] for h in every}
    apart = {h: abs(share[h][1] - share[h][0]) / sum(share[h][k] * (1 - share[h][k]) / n[k] for k in (0, 1)) ** 0.5
             for h in every if sum(count[h]) >= 3}
    assert len(apart) <= T.FEATURES
    chosen = sorted(h for h in apart if apart[h] > 0)
    ratio = np.log([share[h][1] / share[h][0] for h in chosen])
    x = np.array([[h in g for h in chosen] for g, _ in train]) * ratio
    x, y = x / np.sqrt((x**2).sum() / len(train)), np.array([k for _, k in train])
    scale = np.sqrt(((np.array([[h in g for h in chosen] for g, _ in train]) * ratio) ** 2).sum() / len(train))
    weight = np.where(y == 1, 0.5 / n[1], 0.5 / n[0]) * len(y)
    w, b = np.zeros(len(chosen)), 0.0
    look = w, b
    for t in range(1, 121):
        gap = weight * (1 / (1 + np.exp(-np.clip(x @ look[0] + look[1], -30, 30))) - y) / len(y)
        new = look[0] - (0.5 / len(y) * look[0] + x.T @ gap), look[1] - gap.sum()
        push = (t - 1) / (t + 2)
        look, (w, b) = (new[0] + push * (new[0] - w), new[1] + push * (new[1] - b)), new
    for i, t, _ in rows:
        g = grams(t)
        z = b + sum(w[j] * ratio[j] / scale for j, h in enumerate(chosen) if h in g)
        assert got[i].held_out == held[i] and abs(got[i].score - 1 / (1 + np.exp(-z))) < 1e-3
