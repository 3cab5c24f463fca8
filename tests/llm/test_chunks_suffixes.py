"""Exact dedup and removal of repeats against brute force."""

import hashlib
import random

import numpy as np
import pytest

from staywise.llm import chunk_dedup, suffix_dedup, suffix_runs
from tests.llm.conftest import sentence


@pytest.fixture(scope="module")
def rows():
    rng = random.Random(11)
    passages = [sentence(rng, n) for n in (30, 45, 80, 300)]
    texts = []
    for _ in range(120):
        parts = [sentence(rng, rng.randrange(1, 60))]
        for _ in range(rng.randrange(3)):
            p = rng.choice(passages)
            a = rng.randrange(len(p) // 3)
            parts += [p[a : a + rng.randrange(100, len(p))], sentence(rng, rng.randrange(1, 30))]
        texts.append(" ".join(parts))
    texts += texts[:10] + ["ab" * 300, "x" * 199, "x" * 200, "é" * 100 + "ü", None, "", passages[3] * 2]
    rng.shuffle(texts)
    return list(enumerate(texts))


def brute_force(rows, length):
    count = {}
    data = [(i, (t or "").encode()) for i, t in rows]
    for _, b in data:
        for p in range(len(b) - length + 1):
            count[b[p : p + length]] = count.get(b[p : p + length], 0) + 1
    out = {}
    for i, b in data:
        gone = np.zeros(len(b), dtype=bool)
        for p in range(len(b) - length + 1):
            if count[b[p : p + length]] > 1:
                gone[p : p + length] = True
        spans = int((np.diff(np.concatenate([[0], gone.astype(int)])) == 1).sum())
        kept = hashlib.sha256(np.frombuffer(b, np.uint8)[~gone].tobytes()).hexdigest()
        out[i] = (len(b), int(gone.sum()), spans, kept)
    return out


@pytest.mark.parametrize(
    "parameters", [{}, {"bucket_rows": 40}, {"group_rows": 2}, {"group_rows": 0}, {"length": 60, "gram": 16}, {"gram": 200}]
)
def test_removed_bytes_are_those_of_brute_force(make_docs, rows, parameters):
    got = suffix_dedup.remove_repeats(make_docs(rows), **parameters).collect()
    want = brute_force(rows, parameters.get("length", 200))
    assert {r.doc_id: (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in got} == want
    assert sum(w[1] for w in want.values()) > 0


def test_removal_in_odd_rows(make_docs, odd_docs):
    got = suffix_dedup.remove_repeats(make_docs(odd_docs)).collect()
    assert len(got) == len(odd_docs)
    removed = {r.doc_id: (r.n_bytes, r.n_removed, r.n_spans) for r in got}
    assert removed[1] == removed[2] == (removed[1][0], removed[1][0], 1)
    assert removed[4] == removed[5] == (0, 0, 0)
    assert removed[11] == (1000, 1000, 1)  # within one text
    assert removed[10][0] - removed[10][1] == len(" end")
    assert suffix_dedup.remove_repeats(make_docs([])).count() == 0


def test_merge_of_front_coded_runs_is_the_sorted_list():
    rng = random.Random(2)
    entries = [bytes(rng.choice(b"ab") for _ in range(rng.randrange(1, 14))) for _ in range(900)]
    for k in (1, 2, 3, 7, 16):
        runs = []
        for part in range(k):
            own = {}
            for e in entries[part::k]:
                own[e, len(e)] = own.get((e, len(e)), 0) + 1
            runs.append(suffix_runs.decode(*suffix_runs.encode(suffix_runs.sorted_run(own))))
        merged = list(suffix_runs.merge(runs))
        keys = [m[0] for m in merged]
        assert sorted(keys) == keys and sum(m[3] for m in merged) == len(entries)
        assert [m[1] for m in merged[1:]] == [suffix_runs.common_prefix(a, b, 0) for a, b in zip(keys, keys[1:])]
    assert list(suffix_runs.merge([])) == []


def test_every_window_has_an_anchor_that_its_bytes_decide():
    rng = random.Random(4)
    data = np.array([rng.randrange(4) for _ in range(3000)], dtype=np.uint8)
    place, _ = suffix_dedup.anchors(data, 200, 64)
    for p in range(0, len(data) - 199, 37):
        inside = place[(place >= p) & (place <= p + 136)] - p
        own, _ = suffix_dedup.anchors(data[p : p + 200], 200, 64)
        assert set(own) <= set(inside) and len(own)


@pytest.mark.parametrize("hash_bytes", [16, 1])
def test_equal_texts_and_no_others_are_grouped(make_docs, rows, hash_bytes):
    got = chunk_dedup.exact_groups(make_docs(rows), hash_bytes).collect()
    groups = {}
    for i, t in rows:
        groups.setdefault(t or "", []).append(i)
    for r in got:
        text = dict(rows)[r.doc_id] or ""
        own = groups[text]
        assert (r.keep_id, r.group_size, r.kept) == (max(own), len(own), r.doc_id == max(own))
        assert r.text_sha256 == hashlib.sha256(text.encode()).hexdigest()
    assert len(got) == len(rows)


def test_chunks_put_together_are_the_text_and_follow_the_bytes():
    rng = random.Random(8)
    body = sentence(rng, 6000).encode()
    data = np.frombuffer(body, np.uint8)
    limits = chunk_dedup.chunk_limits(chunk_dedup.cut_places(data), 0, len(data))
    sizes = np.diff(limits)
    assert limits[0] == 0 and limits[-1] == len(data) and (sizes[:-1] >= chunk_dedup.LEAST).all() and (sizes <= chunk_dedup.MOST).all()
    moved = np.frombuffer(b"new start " + body, np.uint8)
    other = chunk_dedup.chunk_limits(chunk_dedup.cut_places(moved), 0, len(moved))
    chunks = {body[a:b] for a, b in zip(limits, limits[1:])}
    again = {moved[a:b].tobytes() for a, b in zip(other, other[1:])}
    assert len(chunks & again) > 0.7 * len(chunks)


def test_exact_dedup_of_odd_rows(make_docs, odd_docs):
    got = chunk_dedup.exact_groups(make_docs(odd_docs)).collect()
    assert len(got) == len(odd_docs)
    by = {r.doc_id: (r.keep_id, r.group_size, r.kept) for r in got}
    assert by[1] == (2, 2, False) and by[2] == (2, 2, True) and by[4] == (5, 2, False) and by[7] == (7, 2, True)
    assert by[None] == (None, 1, True)
    assert chunk_dedup.exact_groups(make_docs([])).count() == 0
