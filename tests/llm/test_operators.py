"""Each operator against a plain version on odd texts and on the smallest tables."""

import hashlib
import html
import math
import re
import zlib
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from threadlens.llm import bpe, fingerprints, html_text, line_templates, near_dups, packing, quality, queries, secret_scan, toxicity, url_rules

SF = "/root/testdata/sf0.001"
KEY = "AKIA" + "QWERTYUIOPASDF12"
ODD = [
    None, "", " ", "one", "\n\n", "a b\n\n a b\n\na b", "password = 'hunter2hunter2' token: short secret:token:abcdefghijkl é API_KEY=ABCDEFGHIJKL", f"é {KEY} {KEY.lower()} deadbeefdeadbeef00 x",
    "token=deadbeefdeadbeefdeadbeef", "w " * 3000 + "end", "don't <|endoftext|> stop\t\u00a0x\x1cy  z ", "日本語 \u0130\u017f \u212aelvin e\u0301", "tab\tsep\x0bvt\x0cff\rcr", "a b c d e a b c d e", "# * $ % & | < >" * 5,
    "x" * 5000, "same text here for two", "same text here for two",
]


@pytest.fixture(scope="module")
def odd(spark):
    rows = [(i, t, "en" if i % 2 else None, i) for i, t in enumerate(ODD)] + [(3, ODD[3], None, 3), (None, "no id at all", "fr", 9)]
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, score int")


@pytest.fixture(scope="module")
def docs(spark, odd):
    small = spark.read.parquet(f"{SF}/documents.parquet").select((F.col("doc_id") + 100).alias("doc_id"), "text", "lang", F.lit(1).alias("score"))
    return odd.unionByName(small)


def rows_of(df):
    return [r.asDict() for r in df.collect()]


def texts_of(docs):
    return [(r["doc_id"], r["text"] or "") for r in docs.select("doc_id", "text").collect()]


def base_spans(text):
    out = []
    for m in re.finditer(r"""(?ai:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", text):
        out += [(m.start(), 0, m.end(), "assign")] if len(m[1]) >= 12 else []
    out += [(m.start(), 1, m.end(), "access") for m in re.finditer(r"AKIA[A-Z0-9]+", text) if m.end() - m.start() >= 18]
    out += [(m.start(), 2, m.end(), "hex") for m in re.finditer(r"[0-9a-f]+", text) if m.end() - m.start() >= 16]
    return sorted(out)


def test_secrets_match_the_patterns(docs):
    got = Counter((r["doc_id"], r["n_assign"], r["n_access"], r["n_hex"], r["base_sha256"]) for r in rows_of(secret_scan.find_secrets(docs)))
    want = Counter()
    for i, t in texts_of(docs):
        s = base_spans(t)
        n = Counter(x[3] for x in s)
        want[i, n["assign"], n["access"], n["hex"], hashlib.sha256(",".join(f"{k}:{a}:{b}" for a, _, b, k in s).encode()).hexdigest()] += 1
    assert got == want


def test_random_strings_are_told_from_words(spark):
    rng = np.random.default_rng(5)
    random = lambda n: "".join(rng.choice(list(secret_scan.ALPHABET[:62]), n))
    words = [" ".join("".join(rng.choice(["the", "ra", "ti", "on", "es"], 7)) for _ in range(20)) for _ in range(60)]
    docs = spark.createDataFrame([(i, f"{w} token={random(24)}") for i, w in enumerate(words)] + [(1000, f"see {'therationestion' * 2} then {random(32)}")], "doc_id long, text string")
    last = next(r for r in rows_of(secret_scan.find_secrets(docs)) if r["doc_id"] == 1000)
    assert last["spans"].startswith("random:") and last["spans"].count(":") == 2
    cut = next(r for r in rows_of(secret_scan.redact_secrets(docs)) if r["doc_id"] == 1000)
    assert cut["text"].endswith("then [SECRET]")


def test_measures_match_plain_counts(docs):
    got = Counter(tuple(r[c] for c in ("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")) for r in rows_of(quality.text_measures(docs)))
    want = Counter()
    for i, t in texts_of(docs):
        words = re.findall(r"[^\x20\x09-\x0D]+", t)
        lines = [x for x in t.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
        windows = [tuple(words[k : k + 5]) for k in range(len(words) - 4)]
        often = Counter(windows)
        hit = {k + j for k, w in enumerate(windows) if often[w] > 1 for j in range(5)}
        want[i, len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", t)), len(lines) - len(set(lines)), len(hit)] += 1
    assert got == want


def test_binomial_tail_is_exact(spark):
    cases = [(0, 10, 0.1), (3, 100, 0.1), (12, 1000, 0.02), (40, 50, 0.5), (900, 100_000, 0.01)]
    df = spark.createDataFrame(cases, "k long, n long, p double").withColumn("got", quality.binomial_tail(F.col("k"), F.col("n"), F.col("p")))
    for r in df.collect():
        want = sum(math.exp(math.lgamma(r["n"] + 1) - math.lgamma(j + 1) - math.lgamma(r["n"] - j + 1) + j * math.log(r["p"]) + (r["n"] - j) * math.log1p(-r["p"])) for j in range(r["k"] + 1)) if r["k"] < r["n"] * r["p"] else 1.0
        assert r["got"] == pytest.approx(want, rel=1e-9)


def test_cutoffs_keep_the_good(spark):
    rows = [(i, ("word " * 40 if i % 5 else "bad ### " * 40) + str(i), "en", i % 5) for i in range(4000)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, q int").withColumn("text", F.concat_ws(" ", "text", F.md5("text"), *[F.md5(F.concat("text", F.lit(k))) for k in range(200)]))
    labels = docs.select("doc_id", (F.col("q") > 0).cast("int").alias("quality"))
    out = quality.quality_verdicts(docs, labels).join(labels, "doc_id")
    counts = {(r["quality"], r["kept"]): r["count"] for r in out.where("not base_failed").groupBy("quality", "kept").count().collect()}
    assert counts.get((1, False), 0) <= 0.01 * 3200 and counts.get((0, True), 0) == 0
    assert quality.quality_verdicts(docs, labels.limit(0)).where("kept = base_failed").count() == 0


def test_fingerprints(docs):
    order = sorted(texts_of(docs), key=lambda x: (x[0] is not None, x[0] or 0))
    out = {r["doc_id"]: r for r in rows_of(fingerprints.fingerprint_edits(docs))}
    got = Counter((r["doc_id"], r["n_chars"], r["edited_sha256"]) for r in rows_of(fingerprints.fingerprint_edits(docs)))
    edits = [(i, t, t[: len(t) - len(t) // 2] + follows[: len(t) // 2]) for (i, t), (_, follows) in zip(order, order[1:] + order[:1], strict=True)]
    assert got == Counter((i, len(t), hashlib.sha256(e.encode()).hexdigest()) for i, t, e in edits)
    for i, _ in order:
        assert 0 <= out[i]["near_next"] <= 1 and 0 <= out[i]["near_edited"] <= 1
    by_text = {t: out[i]["fingerprint"] for i, t in order}
    assert len(set(by_text.values())) == len(by_text)
    assert out[16]["fingerprint"] == out[17]["fingerprint"] and out[16]["near_next"] == 1.0


def test_edits_are_located(spark):
    text = "\n".join(f"line {i} has some words" for i in range(20))
    df = spark.createDataFrame([(text, text.replace("line 7 has", "line 7 had"))], "a string, b string")
    df = fingerprints.with_tree(fingerprints.with_tree(df, "a", "a_"), "b", "b_")
    assert df.select(fingerprints.edited_paragraphs(F.col("a_paragraphs"), F.col("b_paragraphs"))).first()[0] == [7]


def test_url_rules(spark):
    urls = [None, "", "no scheme", "http://Example.ORG/es/1", "https://a.example.org:80/en/12?x#y", "http://example.org", "x://org/", "http://b.com/fr/?q", "http://com/de/", "http://notexample.org.com/de/x", "a://b.org/x://c/d", "http://xorg/", "http://./"]
    pages = spark.createDataFrame([(i, u) for i, u in enumerate(urls)] + [(3, urls[3])], "page_id long, url string").withColumn("rule", F.lit(1))
    rules = spark.createDataFrame(queries.URL_RULES, "verdict string, host string, path string")
    got = Counter(tuple(r[c] for c in ("page_id", "host", "path", "rule", "verdict")) for r in rows_of(url_rules.judge_urls(pages, rules)))
    want = Counter()
    for i, u in [*enumerate(urls), (3, urls[3])]:
        rest = (u or "").partition("://")[2] if "://" in (u or "") else ""
        host = re.split(r"[/?#]", rest)[0]
        path = re.split(r"[?#]", rest[len(host) :])[0]
        host = re.sub("[A-Z]", lambda m: m[0].lower(), host)
        fits = [(len(h + p), h + p, v) for v, h, p in queries.URL_RULES if (host == h or host.endswith("." + h)) and path.startswith(p)]
        want[(i, host, path, *(max(fits)[1:] if fits else (None, "allow")))] += 1
    assert got == want
    assert url_rules.judge_urls(pages, rules.limit(0)).where("rule is not null").count() == 0


def test_bpe_equals_the_library(docs):
    path = public_tokenizers.path("byte_bpe_50k.json")
    library = Tokenizer.from_file(path)
    got = Counter((r["doc_id"], tuple(r["ids"]), r["decoded"]) for r in rows_of(bpe.encode_documents(docs, path)))
    want = Counter()
    for i, t in texts_of(docs):
        ids = library.encode(t, add_special_tokens=False).ids
        want[i, tuple(ids), library.decode(ids, skip_special_tokens=False)] += 1
    assert got == want


def test_packing(docs):
    path = public_tokenizers.path("word_bpe_49k.json")
    library = Tokenizer.from_file(path)
    out = rows_of(packing.pack_documents(docs, path))
    want = Counter()
    for i, t in texts_of(docs):
        ids = [*library.encode(t, add_special_tokens=False).ids, 0]
        for k in range(0, len(ids), 2048):
            want[i, k // 2048, k, zlib.crc32(np.array(ids[k : k + 2048], "<u4").tobytes())] += 1
    assert Counter((r["doc_id"], r["piece"], r["start"], zlib.crc32(r["ids"])) for r in out) == want
    sequences = {}
    for r in out:
        sequences.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    for s in sequences.values():
        s.sort()
        assert [a for a, _ in s] == [0, *np.cumsum([n for _, n in s])[:-1]] and sum(s[-1]) <= 2048
    assert len(sequences) <= packing.lower_bound(np.array([r["length"] for r in out]), 2048) + 1


def test_partitions_with_gaps_exchange(spark):
    rng = np.random.default_rng(3)
    pieces = spark.createDataFrame([(i, int(n)) for i, n in enumerate(rng.integers(300, 1100, 2000))], "doc_id long, length long")
    one = packing.pack(pieces, partition_rows=100, rounds=0).select("sequence_id").distinct().count()
    more = packing.pack(pieces, partition_rows=100, rounds=3)
    assert more.count() == 2000 and more.select("sequence_id").distinct().count() <= one
    assert packing.pack(pieces.limit(0)).count() == 0


@pytest.mark.parametrize("seed", range(5))
def test_bounds_hold(seed):
    rng = np.random.default_rng(seed)
    lengths = rng.integers(1, 2049, 200)
    bins, offsets, used = packing.best_fit_decreasing(lengths, 2048)
    assert packing.lower_bound(lengths, 2048) <= used and np.bincount(bins, lengths).max() <= 2048


def test_toxicity_separates_and_reads_no_held_out_label(spark):
    rows = [(i, f"plain words number {i} " + ("you utter nitwit " if i % 4 == 0 else "and so on ") * 3) for i in range(800)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumn("score", F.lit(2))
    labels = docs.select("doc_id", (F.col("doc_id") % 4 == 0).cast("int").alias("toxic"))
    out = {r["doc_id"]: r for r in rows_of(toxicity.score_documents(docs, labels))}
    assert all(r["predicted"] == (i % 4 == 0) and 0 <= r["score"] <= 1 and r["held_out"] == (zlib.crc32(str(i).encode()) % 5 == 0) for i, r in out.items())
    turned = labels.withColumn("toxic", F.when(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 0, 1 - F.col("toxic")).otherwise(F.col("toxic")))
    assert {i: r["score"] for i, r in out.items()} == {r["doc_id"]: r["score"] for r in rows_of(toxicity.score_documents(docs, turned))}
    assert toxicity.reject_toxic(docs, labels).columns == docs.columns and toxicity.reject_toxic(docs, labels).count() == 600
    assert toxicity.score_documents(docs, labels.limit(0)).where("score < 0 or score > 1").count() == 0


def test_index_finds_the_exact_nearest():
    rng = np.random.default_rng(2)
    vectors = rng.random((700, 12)) * (rng.random((700, 12)) < 0.3)
    vectors = vectors[vectors.any(axis=1)]
    vectors /= np.linalg.norm(vectors, axis=1, keepdims=True)
    index = toxicity.BlockMaxIndex([[(int(t), float(v[t])) for t in np.flatnonzero(v)] for v in vectors], 12)
    for q in vectors[:20]:
        near = index.nearest([(int(t), float(q[t])) for t in np.flatnonzero(q)], np.ones(len(vectors)), 10)
        assert np.allclose([s for s, _ in near], np.sort(vectors @ q)[::-1][:10])


PAGE = """<html><head><title>T</title></head><body><nav><a>Home</a></nav><div class="ad">Buy</div>{lines}<article><header>Kept</header><h1>A &amp; B</h1><p>one
 two<br>three<p>four <b>bold</b><script>x("</p>")</script><div class="comments">hey</div></article><footer>f</footer>"""


def test_main_text(spark):
    rows = [(1, "http://h.x/a/1", PAGE.format(lines="")), (2, "http://h.x/a/2", None), (3, None, ""), (4, "http://h.x/b", "plain &lt;b&gt; text")]
    body = "".join(f"<div>{t}</div>" for t in ("Site name", "{own} is what this page is about at some length", "Contact us"))
    rows += [(10 + i, f"http://s.x/p/{i}", body.format(own=f"Story {i}")) for i in range(6)] + [(20, "http://c.x/1", "<p>copy of this"), (21, "http://c.x/2", "<p>copy of this")]
    pages = spark.createDataFrame([*rows, rows[0]], "page_id long, url string, html string").withColumn("text", F.lit("x"))
    out = {r["page_id"]: r["text"] for r in rows_of(html_text.main_text(pages))}
    assert out[1] == "Kept\n\nA & B\n\none two three\n\nfour bold"
    assert out[2] == "" and out[3] == "" and out[4] == "plain <b> text" and out[20] == out[21] == "copy of this"
    assert all(out[10 + i] == f"Story {i} is what this page is about at some length" for i in range(6))
    assert html_text.main_text(pages).count() == len(rows) + 1 and html_text.main_text(pages.limit(0)).count() == 0


def test_test_pages_give_their_article(spark):
    got = {r["page_id"]: r["text"] for r in rows_of(queries.op8_html_text(spark, SF))}
    for r in spark.read.parquet(f"{SF}/pages.parquet").collect():
        inner = re.search(r"<article>(.*)</article>", r["html"], re.S)[1]
        blocks = [" ".join(html.unescape(re.sub(r"</?b>|<br>", " ", x)).split()) for x in re.split(r"</?(?:p|h1)>", inner)]
        assert got[r["page_id"]] == "\n\n".join(x for x in blocks if x)


@pytest.mark.parametrize("seed", range(20))
def test_common_lines_are_longest(seed):
    rng = np.random.default_rng(seed)
    a, b = rng.integers(0, 6, rng.integers(0, 25)).tolist(), rng.integers(0, 6, rng.integers(0, 25)).tolist()
    best = [[0] * (len(b) + 1) for _ in range(len(a) + 1)]
    for i, x in enumerate(a):
        for j, y in enumerate(b):
            best[i + 1][j + 1] = best[i][j] + 1 if x == y else max(best[i][j + 1], best[i + 1][j])
    found = html_text.common_lines(a, b)
    it = iter(b)
    assert len(found) == best[-1][-1] and found == sorted(set(found)) and all(a[i] in it for i in found)


def test_recurring_lines_go_and_copies_stay(spark):
    story = lambda i: "\n".join(f"{hashlib.md5(f'{i}-{k}'.encode()).hexdigest().translate(str.maketrans('0123456789', 'ghijklmnop'))} and its own words in a row" for k in range(6))
    rows = [(i, f"{story(i)}\nRead more about item {i} on our site today\n{story(i + 1000)}") for i in range(30)] + [(100 + i, story(77)) for i in range(30)]
    rows += [(200, None), (201, ""), (202, "short line")]
    docs = spark.createDataFrame([*rows, rows[0]], "doc_id long, text string").withColumn("lines", F.lit("x"))
    out = rows_of(line_templates.drop_recurring_lines(docs.drop("lines")))
    assert len(out) == len(rows) + 1
    for r in out:
        before = dict(rows)[r["doc_id"]]
        assert r["text"] == ("\n".join(x for x in before.split("\n") if "Read more" not in x) if r["doc_id"] < 100 else before)


def bag_of(text):
    words = text.split()
    return Counter([tuple(words[k : k + 5]) for k in range(max(1, len(words) - 4))] if words else [])


def plain_classes(texts):
    """Smallest id of each text's class, by comparing all pairs."""
    bags = [bag_of(t or "") for t in texts]
    root = list(range(len(texts)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i, a in enumerate(bags):
        for j, b in enumerate(bags[:i]):
            common = (a & b).total()
            if a == b or common and common / (a.total() + b.total() - common) >= 0.8:
                x, y = sorted((find(i), find(j)))
                root[y] = x
    return [find(i) for i in range(len(texts))]


def test_near_classes_equal_brute_force(spark):
    rng = np.random.default_rng(4)
    rows = []
    for g in range(25):
        words = [f"w{x}" for x in rng.integers(0, 400, rng.integers(30, 120))]
        for _ in range(rng.integers(1, 6)):
            edited = list(words)
            for at in rng.integers(0, len(words), rng.integers(0, 4)):
                edited[at] = f"e{rng.integers(0, 10**6)}"
            rows.append((len(rows), " ".join(edited)))
    rows += [(len(rows) + k, t) for k, t in enumerate([None, "", "a b", "a b", "x " * 500, "x " * 520])]
    docs = spark.createDataFrame([*rows, rows[0]], "doc_id long, text string").withColumn("node", F.lit(1))
    want = plain_classes([t for _, t in rows])
    out = rows_of(near_dups.near_classes(docs))
    assert len(out) == len(rows) + 1 and all(r["class_id"] == want[r["doc_id"]] for r in out)
    kept = near_dups.keep_one(docs)
    assert kept.columns == docs.columns and sorted(r["doc_id"] for r in rows_of(kept)) == sorted(set(want))


def test_a_large_group_of_edited_copies_keeps_its_links(spark):
    """Most copies are too far from the centre and linked, if at all, through copies edited in the same place."""
    rng = np.random.default_rng(8)
    rows = []
    for g in range(3):
        words = [f"g{g}w{x}" for x in range(110)]
        for _ in range(130):
            edited = list(words)
            for at in 13 * rng.integers(0, 8, rng.integers(1, 5)):
                edited[at] = f"e{rng.integers(0, 3)}"
            rows.append((len(rows), " ".join(edited)))
    want = plain_classes([t for _, t in rows])
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    assert 3 < len(set(want)) and {r["doc_id"]: r["class_id"] for r in rows_of(near_dups.near_classes(docs))} == dict(enumerate(want))
    assert sorted(r["doc_id"] for r in rows_of(near_dups.keep_one(docs))) == sorted(set(want))


def test_signatures_estimate_weighted_similarity():
    rng = np.random.default_rng(6)
    a, b = rng.integers(0, 9, 300), rng.integers(0, 9, 300)
    agree = []
    for turn in range(60):
        digest = rng.integers(0, 2**63, 300).astype(np.uint64)
        doc = np.repeat([0, 1], [np.count_nonzero(a), np.count_nonzero(b)])
        tags = near_dups.signatures(2, doc, np.concatenate([digest[a > 0], digest[b > 0]]), np.concatenate([a[a > 0], b[b > 0]]))
        agree.append((tags[0] == tags[1]).mean())
    assert np.mean(agree) == pytest.approx(np.minimum(a, b).sum() / np.maximum(a, b).sum(), abs=0.02)


def test_empty_tables(spark, docs):
    none, labels = docs.limit(0), spark.createDataFrame([], "doc_id long, quality int, toxic int")
    path = public_tokenizers.path("word_bpe_49k.json")
    for df in (
        secret_scan.find_secrets(none), line_templates.drop_recurring_lines(none), packing.pack_documents(none, path), toxicity.score_documents(none, labels),
        bpe.encode_documents(none, public_tokenizers.path("byte_bpe_50k.json")), fingerprints.fingerprint_edits(none), quality.quality_verdicts(none, labels), near_dups.near_classes(none),
    ):
        assert df.count() == 0


def test_pipeline_stages_keep_columns(spark):
    import corpus_pipeline

    docs = spark.read.parquet(f"{SF}/documents.parquet")
    for _, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, SF)
        assert out.columns == docs.columns and 0 < out.count() <= docs.count()
    assert corpus_pipeline.run(spark, SF).count() > 0
