"""Links across classes: exact, and with work that grows no faster than the texts of a group."""

from __future__ import annotations

import numpy as np
import pytest
from pyspark.sql import functions as F

from threadlens.llm import near_dups


def cloud(rng, copies, edits, words=110):
    """Copies of one text, each with new words in so many places."""
    base, out = [f"w{x}" for x in range(words)], []
    for _ in range(copies):
        text = list(base)
        for at in rng.choice(words, edits, replace=False):
            text[at] = f"e{rng.integers(0, 10**9)}"
        out.append(" ".join(text))
    return out


def steps(spark, monkeypatch, rows):
    """The tables that near_links writes, the last of each name, and its links."""
    made, plain = {}, near_dups.written

    def noted(df, label="step"):
        made[label] = plain(df, label)
        return made[label]

    docs = spark.createDataFrame(list(enumerate(rows)), "doc_id long, text string")
    with monkeypatch.context() as patch:
        patch.setattr(near_dups, "written", noted)
        return made, near_dups.near_links(docs, near_dups.banded(docs)).collect()


def test_distant_copies_of_one_text_do_not_meet_in_pairs(spark, monkeypatch):
    """Copies that share a few of their changes with many others, but never enough for a link, are not compared one by one."""
    made, links = steps(spark, monkeypatch, cloud(np.random.default_rng(3), 300, 5))
    assert made["pairs"].count() <= 30 + 2 * len(links)


def test_differences_grow_with_the_texts_of_a_group(spark, monkeypatch):
    rng = np.random.default_rng(4)
    small, large = cloud(rng, 15, 5), cloud(rng, 75, 5)
    items = [steps(spark, monkeypatch, rows)[0]["differences"].agg(F.sum(F.size("diff"))).first()[0] or 0 for rows in (small, large)]
    assert 0 < items[1] <= 12 * items[0]


@pytest.mark.parametrize("size", [4, 40, 200])
def test_links_across_classes_equal_brute_force(spark, size):
    """Texts of many sizes and distances to their head, some linked to it, some in small groups of their own."""
    rng = np.random.default_rng(size)
    bags = [set(range(size))]
    while len(bags) < 240:
        near = set(bags[0] if rng.random() < 0.4 else bags[rng.integers(0, len(bags))])
        near -= set(rng.choice(sorted(near), int(len(near) * rng.random() * 0.4), replace=False).tolist())
        near |= set(rng.integers(-9 * size, 3 * size, int(size * rng.random() ** 2 * 0.8)).tolist())
        if near and near not in bags:
            bags.append(near)
    alike = lambda i, j: len(bags[i] & bags[j]) / len(bags[i] | bags[j])
    linked = {i for i in range(1, len(bags)) if alike(0, i) >= 0.8}
    want = {(i, j): alike(i, j) for j in range(1, len(bags)) for i in range(1, j) if not (i in linked and j in linked) and alike(i, j) >= 0.8}
    node = lambda i: bytearray(i.to_bytes(2, "big"))
    table = spark.createDataFrame([(node(i), [int(v) for v in b], len(b)) for i, b in enumerate(bags)], "node binary, bag array<bigint>, size int")
    pairs = spark.createDataFrame([(node(0), node(i)) for i in range(1, len(bags))], "head binary, node binary")
    roots = spark.createDataFrame([(node(i), node(0)) for i in sorted({0} | linked)], "node binary, root binary")
    found = near_dups._across(near_dups._differences(pairs, table), roots, 0.8).collect()
    assert {(int.from_bytes(a, "big"), int.from_bytes(b, "big")): s for a, b, s in found} == pytest.approx(want) and len(found) == len(want) > 10
