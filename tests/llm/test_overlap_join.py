"""The Jaccard join against all pairs of a small table."""

import random
import re

import pytest

from staywise.llm import graph, overlap_join
from tests.llm.conftest import sentence

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def shingles(text):
    w = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(LOWER))
    return {tuple(w[i : i + 5]) for i in range(len(w) - 4)} if len(w) >= 5 else {tuple(w)} if w else set()


def brute_force(rows):
    sets = {i: shingles(t) for i, t in rows}
    root = {i: i for i in sets}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    ids = sorted(sets)
    for a in ids:
        for b in ids:
            both = len(sets[a] & sets[b])
            if a < b and both and 100 * both >= 75 * (len(sets[a]) + len(sets[b]) - both):
                x, y = find(a), find(b)
                root[max(x, y)] = min(x, y)
    return {i: (len(sets[i]), find(i)) for i in ids}


def result(frame):
    return {r.doc_id: (r.n_shingles, r.component_id) for r in frame.collect()}


def family(rng, base, edits):
    words = base.split()
    for _ in range(edits):
        words[rng.randrange(len(words))] = f"e{rng.randrange(10_000)}"
    return " ".join(words)


@pytest.fixture(scope="module")
def rows():
    rng = random.Random(3)
    bases = [sentence(rng, n) for n in (40, 80, 200)]
    passage = sentence(rng, 60)
    texts = [family(rng, rng.choice(bases), rng.randrange(9)) for _ in range(150)]
    texts += [passage + " " + sentence(rng, rng.choice([5, 12, 40])) for _ in range(40)]
    texts += [sentence(rng, rng.randrange(1, 9), 6) for _ in range(30)]
    texts += texts[:20] + [texts[0].upper(), None, "", "  "]
    rng.shuffle(texts)
    return list(enumerate(texts))


@pytest.mark.parametrize("block", [5, 1000])
def test_join_finds_the_components_of_all_pairs(make_docs, rows, block):
    got = result(overlap_join.near_duplicate_components(make_docs(rows), block=block))
    assert got == brute_force(rows)


@pytest.mark.parametrize("sample", [26, 60, 100])
def test_sample_of_the_first_count_changes_nothing(make_docs, rows, sample):
    got = result(overlap_join.near_duplicate_components(make_docs(rows), sample=sample))
    assert got == brute_force(rows)


def test_pairs_of_all_small_sizes_at_the_bound_are_found(make_docs):
    """One text is the other and words at its end: Jaccard 3/4 exactly, whatever the order of the hashes."""
    rng = random.Random(5)
    texts = []
    for size in (3, 6, 9, 12, 15, 18, 24, 30):
        for _ in range(25):
            words = [f"w{rng.randrange(10**9)}" for _ in range(size // 3 * 4 + 4)]
            texts += [" ".join(words[: size + 4]), " ".join(words)]
    rows = list(enumerate(texts))
    got = result(overlap_join.near_duplicate_components(make_docs(rows)))
    assert got == brute_force(rows)
    assert all(got[i + 1][1] == i for i in range(0, len(rows), 2))


def test_repeated_hashes_needed_hold_for_every_order():
    """The least number of hashes in both leads, by the worst order: each set's own hashes before the common ones."""
    for n in range(1, 61):
        least = n
        for m in range(1, 2 * n):
            for both in range(1, min(n, m) + 1):
                if 100 * both >= 75 * (n + m - both):
                    leads = [int(overlap_join._lead(x, 75, 35)) - (x - both) for x in (n, m)]
                    least = min(least, *leads)
        assert overlap_join._need(n, 75, 35) == least >= 1


def test_search_in_blocks_needs_no_leaders(make_docs, rows, monkeypatch):
    monkeypatch.setattr(overlap_join, "leader_links", lambda lists, members, percent: overlap_join.materialize(
        lists.selectExpr("doc_id AS a", "doc_id AS b").limit(0), "none"))
    got = result(overlap_join.near_duplicate_components(make_docs(rows), block=40))
    assert got == brute_force(rows)


def test_odd_rows_have_defined_results(make_docs, odd_docs):
    got = result(overlap_join.near_duplicate_components(make_docs(odd_docs)))
    assert set(got) == {i for i, *_ in odd_docs}
    assert overlap_join.near_duplicate_components(make_docs(odd_docs)).count() == len(odd_docs)
    assert got[1] == got[2] == (116, 1) and got[3] == (117, 1)
    assert got[4] == (0, 4) and got[5] == (0, 5) and got[6] == (0, 6) and got[7] == (1, 7)
    assert got[10][1] == 9


def test_empty_table(make_docs):
    assert overlap_join.near_duplicate_components(make_docs([])).count() == 0


def test_one_document_of_each_group_stays(make_docs, odd_docs):
    docs = make_docs(odd_docs)
    kept = overlap_join.keep_first(docs)
    assert kept.columns == docs.columns
    ids = sorted(r.doc_id or 0 for r in kept.collect())
    assert ids == [0, 1, 4, 5, 6, 7, 8, 9, 11, 12]
    assert {(r.maybe, r.place) for r in kept.collect()} == {("m", "p")}


def test_rows_of_one_id_and_without_an_id_are_told_apart(make_docs):
    rng = random.Random(12)
    x, y, z, v = (sentence(rng, 40) for _ in range(4))
    rows = [(1, x), (2, x), (2, y), (None, x), (None, z), (None, z), (3, y + " end"), (4, v), (4, v), (5, ""), (5, ""), (None, None)]
    got = sorted(overlap_join.near_duplicate_components(make_docs(rows)).select("doc_id", "component_id").collect(), key=str)
    want = [(1, 1), (2, 1), (2, 2), (None, 1), (None, None), (None, None), (3, 2), (4, 4), (4, 4), (5, 5), (5, 5), (None, None)]
    assert [tuple(r) for r in got] == sorted(want, key=lambda w: f"Row(doc_id={w[0]}, component_id={w[1]})")
    kept = overlap_join.keep_first(make_docs(rows))
    assert sorted(((r.doc_id, r.text) for r in kept.collect()), key=str) == sorted(
        [(1, x), (2, y), (None, z), (4, v), (5, ""), (5, ""), (None, None)], key=str
    )


@pytest.mark.parametrize("edges", [[], [(1, 1)], [(i, i + 1) for i in range(40)], [(99, i) for i in range(30)], [(5, 4), (4, 5), (9, 8)]])
def test_components(spark, edges):
    frame = spark.createDataFrame(edges, "a long, b long")
    got = {r.id: r.component for r in graph.components(frame).collect()}
    root = {x: x for e in edges for x in e if e[0] != e[1]}
    for _ in root:
        for a, b in edges:
            if a != b:
                root[a] = root[b] = min(root[a], root[b])
    assert got == root
