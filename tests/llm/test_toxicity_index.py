"""The index's batches against plain cosines: common terms, block bounds, ties, withheld votes, empty queries and indexes."""

import numpy as np
import pytest

from threadlens.llm import toxicity
from threadlens.llm.chunks import Memo


def _vectors(n, terms, seed, common=0.5):
    rng = np.random.default_rng(seed)
    share = np.where(np.arange(terms) < 20, common, 0.01)
    made = rng.random((n, terms)) * (rng.random((n, terms)) < share)
    made[np.arange(n), rng.integers(0, terms, n)] += 1.0
    return made / np.linalg.norm(made, axis=1, keepdims=True)


def _rows(vectors):
    return [[(int(t), float(v[t])) for t in np.flatnonzero(v)] for v in vectors]


def _plain(index, query, votes, enough, less):
    exact = np.array([sum(query[t] * np.float64(np.float32(w)) for t, w in row) for row in index])
    out, total = [], 0.0
    for i in np.lexsort((np.arange(len(exact)), -np.round(exact, 12))):
        if exact[i] <= 0 or total >= enough:
            break
        out.append((int(i), exact[i]))
        total += votes[i] - (i == less)
    return out


@pytest.mark.parametrize(("n", "few"), [(700, 1), (700, 256), (1500, 4), (40, 4)])
def test_batches_equal_plain_cosines(n, few, monkeypatch):
    monkeypatch.setattr(toxicity, "_FEW", few)
    vectors = _vectors(n, 300, 1)
    vectors[n // 2] = vectors[3]  # a tie
    rows = _rows(vectors)
    index = toxicity.BlockMaxIndex(rows, 300)
    assert (index.dense.shape[1] > 0) == (n > 100)
    queries = [*vectors[:12], *_vectors(12, 300, 2), np.zeros(300)]
    sparse = [(np.flatnonzero(q), q[np.flatnonzero(q)]) for q in queries]
    votes = np.random.default_rng(3).integers(1, 3, n).astype(float)
    less = [*range(12), *[None] * 13]
    found = index.closest(sparse, votes, 10, less)
    for q, near, i in zip(queries, found, less, strict=True):
        wanted = _plain(rows, q, votes, 10, i)
        assert [e for _, e in near] == [e for e, _ in wanted] and np.allclose([s for s, _ in near], [s for _, s in wanted])
    assert found == [index.closest([s], votes, 10, [i])[0] for s, i in zip(sparse, less, strict=True)]


def test_empty_index():
    index = toxicity.BlockMaxIndex([], 0)
    assert index.closest([(np.zeros(0, np.int64), np.zeros(0))], np.zeros(0), 10) == [[]]


def test_numbers_tell_words_from_beginnings():
    words = toxicity.numbers_of("insulting")
    assert len(words) == 6 and words[0] % 2 == 0 and all(n % 2 for n in words[1:]) and len(set(words)) == 6
    assert toxicity.numbers_of("insulting", frozenset()) == words[:1]
    stem = frozenset([words[1] + toxicity._HALF & toxicity._STEM])
    assert toxicity.numbers_of("insulted", stem)[1:5] != [] and toxicity.numbers_of("insulting", stem) == words
    assert toxicity.numbers_of("insu") == toxicity.numbers_of("insu", stem) and len(toxicity.numbers_of("insu")) == 1


def test_counts_cover_the_whole_text():
    known = Memo(toxicity.numbers_of, 10)
    terms, counts = toxicity.counts_of("Ab cd, AB! " * 5000, known)
    assert sorted(counts) == [5000, 10000] and (np.diff(terms) > 0).all()
    assert [len(x) for x in toxicity.counts_of(" \n", known)] == [0, 0]


def test_words_equal_the_pattern():
    texts = ["".join(map(chr, range(k, min(k + 700, 0xD800)))) for k in range(0, 0xD800, 700)]
    for text in [*texts, "Kelvin K and İx", "a_b-c 1e9\x1cz\x85y", "", "__"]:
        assert toxicity.words_of(text) == toxicity._WORD.findall(text.lower())


def test_index_holds_the_vectors_once():
    starts, terms, weights = np.array([0, 2, 3]), np.array([0, 1, 1], np.int32), np.array([0.6, 0.8, 1.0], np.float32)
    index = toxicity.BlockMaxIndex.of(starts, terms, weights, 2)
    assert np.shares_memory(index.row_terms, terms) and np.shares_memory(index.row_weights, weights)
    assert index.postings.nbytes == 8 * len(terms) and not hasattr(index, "weights")


def test_long_texts_keep_their_nearest():
    """Thousands of terms a text, added up in 32 bits."""
    vectors = np.random.default_rng(5).random((3000, 2500)) + 0.5
    vectors /= np.linalg.norm(vectors, axis=1, keepdims=True)
    index = toxicity.BlockMaxIndex(_rows(vectors), 2500)
    near = index.nearest(_rows(vectors[7:8])[0], np.ones(3000), 30)
    exact = vectors.astype(np.float32).astype(float) @ vectors[7]
    assert near[0][1] == 7 and [i for _, i in near] == np.argsort(-exact, kind="stable")[:30].tolist()


def test_texts_are_taken_out_of_a_batch_run_by_run(monkeypatch):
    import pyarrow as pa

    from threadlens.llm import chunks

    batch = pa.RecordBatch.from_arrays([pa.array(range(7)), pa.array(["aa", None, "ééé", "", "bbbb", "c", "d"])], ["doc_id", "text"])
    runs = chunks.slices(iter([batch, batch.slice(0, 0)]), most_chars=4, most_rows=3)
    assert [(rows.column(0).to_pylist(), strings) for rows, strings in runs] == [([0, 1], ["aa", ""]), ([2, 3], ["ééé", ""]), ([4], ["bbbb"]), ([5, 6], ["c", "d"])]
    seen = []
    monkeypatch.setattr(chunks.pc, "utf8_length", lambda column: seen.append(len(column)) or pa.array([1] * len(column)))
    next(chunks.slices(iter([batch]), most_rows=2))
    assert seen == [7]


def test_vectors_do_not_depend_on_the_parts(monkeypatch):
    rng = np.random.default_rng(9)
    rows = [(i, int(i % 7 == 0), np.unique(rng.integers(-50, 50, rng.integers(0, 12)) * 2), i) for i in range(60)]
    rows = [(i, label, terms, rng.integers(1, 4, len(terms)).astype(np.int32)) for i, label, terms, _ in rows]
    made = []
    for part in (7, 1000):
        monkeypatch.setattr(toxicity, "_PART", part)
        made.append(toxicity.ToxicityModel(rows, 60, 9, np.zeros(0, np.int64)))
    for a, b in zip(*[[*m._vectors, m.terms, m.factor, m.votes] for m in made], strict=True):
        assert a.dtype == b.dtype and (a == b).all()
    assert made[0]._vectors[1].dtype == np.int32 and len(made[0]._vectors[0]) == len(made[0].votes) + 1


def test_asked_vectors_equal_those_by_numbers(monkeypatch):
    """Places of words, kept across texts and emptied when full, give what term numbers give."""
    texts = ["idiot idiots idiotic people", "good people here", "idiotic view, idiotic people", "good day here", "a fine day"] * 3
    rows = [(i, int("idiot" in t), *toxicity.counts_of(t, Memo(toxicity.numbers_of, 10))) for i, t in enumerate(texts)]
    telling = np.array(sorted(n for n in toxicity.numbers_of("idiotic") if n & 1), np.int64)
    model = toxicity.ToxicityModel([(i, y, t, n.astype(np.int32)) for i, y, t, n in rows], len(rows), sum(y for _, y, _, _ in rows), telling)
    monkeypatch.setattr(toxicity, "_KNOWN", 6)
    for text in ["Idiots, idiots and idiotics of today", "people here", "nothing known", "idiotically ... fine", "", *texts[:5]]:
        terms, counts = model.kept(*toxicity.counts_of(text, Memo(toxicity.numbers_of, 10)))
        found = model.asked(text)
        if not len(terms):
            assert found is None
            continue
        at = np.minimum(np.searchsorted(model.terms, terms), len(model.terms) - 1)
        known = model.terms[at] == terms
        weights = (1 + np.log(counts)) * np.where(known, model.factor[at], model.unknown)
        weights /= np.sqrt(weights @ weights)
        known &= weights > 0
        assert found[0].tolist() == at[known].tolist() and np.allclose(found[1], weights[known], rtol=1e-12)
        assert len(model.known) <= max(6, len(set(toxicity.words_of(text))))
    empty = toxicity.ToxicityModel([], 0, 0, np.zeros(0, np.int64))
    assert empty.asked("some words")[0].tolist() == [] and empty.scores(["some words", ""], empty.steps)[0][1] == []


def test_texts_asked_together_equal_texts_asked_alone(monkeypatch):
    """Words of a batch are numbered, placed and weighed together, also where the numbers are given up in between."""
    texts = ["Idiots — idiots und Ärzte", "", "idiotic view, idiotic people", "__ 　", "good ñandú 東京 people", "a fine day", "Idiots — idiots und Ärzte"]
    rows = [(i, int("idiot" in t.lower()), *toxicity.counts_of(t, Memo(toxicity.numbers_of, 10))) for i, t in enumerate(texts)]
    telling = np.array(sorted(n for n in toxicity.numbers_of("idiotic") if n & 1), np.int64)
    model = toxicity.ToxicityModel(rows, len(rows), 3, telling)
    alone = [model.asked(t) for t in texts]
    for most in (200_000, 4):
        monkeypatch.setattr(toxicity, "_KNOWN", most)
        for batch in (texts, texts[2:5], texts):
            for text, found in zip(batch, model.all_asked(batch), strict=True):
                one = alone[texts.index(text)]
                assert (one is None) == (found is None) == (not toxicity.words_of(text))
                assert one is None or (one[0].tolist() == found[0].tolist() and np.allclose(one[1], found[1], rtol=1e-12))
    beginnings = [toxicity.beginning("idiotics"[:n]) for n in (4, 5, 6, 7, 8)]
    assert toxicity.numbers_of("idioticss")[1:] == beginnings


def test_driver_gets_only_telling_beginnings(spark, monkeypatch):
    """The other beginnings, most of the numbers of an example, are left out before examples are sent to the driver."""
    docs = spark.createDataFrame([(i, f"wonderful words number{i % 5} about gardens " + ("insulting " * 2 if i % 3 == 0 else "flowering")) for i in range(200)], "doc_id long, text string")
    labels = spark.createDataFrame([(i, int(i % 3 == 0)) for i in range(200)], "doc_id long, toxic int")
    got, made = [], toxicity.ToxicityModel.__init__

    def kept(self, examples, total, toxic, telling):
        examples = list(examples)
        got.append((np.concatenate([terms for _, _, terms, _ in examples]), telling))
        made(self, examples, total, toxic, telling)

    monkeypatch.setattr(toxicity.ToxicityModel, "__init__", kept)
    toxicity.fit(docs, labels)
    (terms, telling), = got
    assert len(telling) and set(terms[terms & 1 == 1].tolist()) == set(telling.tolist())


def test_texts_reach_workers_in_small_batches(spark):
    """By bytes, not by 10,000 rows; a text above the limit goes alone, and a session's own limit stays."""
    import pyarrow as pa

    from threadlens.llm import common

    docs = spark.range(3000, numPartitions=1).selectExpr("id as doc_id", "repeat('ab ', if(id = 5, 2000000, 1500)) as text")
    labels = docs.selectExpr("doc_id", "cast(doc_id % 2 as int) as toxic")

    def sizes(batches):
        for batch in batches:
            yield pa.RecordBatch.from_arrays([pa.array([batch.num_rows]), pa.array([batch.nbytes])], ["n", "size"])

    spark.conf.unset(common._BATCH_BYTES)
    try:
        toxicity.fit(docs.limit(0), labels.limit(0))
        found = docs.mapInArrow(sizes, "n long, size long").collect()
        assert sum(r["n"] for r in found) == 3000 and sorted(r["size"] for r in found)[-2] < 8_000_000 and max(r["size"] for r in found) < 11_000_000
        spark.conf.set(common._BATCH_BYTES, "1m")
        toxicity.fit(docs.limit(0), labels.limit(0))
        assert spark.conf.get(common._BATCH_BYTES) == "1m"
    finally:
        spark.conf.unset(common._BATCH_BYTES)


def test_resting_index_gives_the_same(monkeypatch):
    """What a waiting worker gives up is made again; products in parts and batches above _BATCH change no result."""
    vectors = _vectors(700, 300, 1)
    index = toxicity.BlockMaxIndex(_rows(vectors), 300)
    sparse = [(np.flatnonzero(q), q[np.flatnonzero(q)]) for q in vectors[:12]]
    found = index.closest(sparse, np.ones(700), 10)
    assert {"dense", "_room"} <= set(vars(index))
    index.rest()
    assert not {"dense", "_room"} & set(vars(index))
    monkeypatch.setattr(toxicity, "_WIDE", 100)
    assert index.closest(sparse, np.ones(700), 10) == found
    monkeypatch.setattr(toxicity, "_BATCH", 5)
    index.rest()
    assert index.closest(sparse, np.ones(700), 10) == found == [x for q in sparse for x in index.closest([q], np.ones(700), 10)]


def test_resting_model_scores_the_same():
    texts = ["idiotic people", "good people here", "idiotic view", "good day here", "a fine day"] * 3
    rows = [(i, int("idiot" in t), *toxicity.counts_of(t, Memo(toxicity.numbers_of, 10))) for i, t in enumerate(texts)]
    model = toxicity.ToxicityModel(rows, len(rows), 6, np.zeros(0, np.int64))
    found = model.scores(texts, model.steps)
    for keep in (True, False):
        model.rest(keep)
        assert ("index" in vars(model)) == ("known" in vars(model)) == keep
        assert model.scores(texts, model.steps) == found
