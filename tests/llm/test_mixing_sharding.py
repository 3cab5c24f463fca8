"""Budgets and loads: sums, bounds, ties and odd rows."""

import random
import zlib

import pytest

from staywise.llm import mixing, sharding
from tests.llm.conftest import sentence


@pytest.fixture(scope="module")
def rows():
    rng = random.Random(5)
    return [(i, sentence(rng, rng.randrange(1, 60)), rng.choice("aaaabcdef")) for i in range(600)]


@pytest.mark.parametrize("slice_rows", [7, 50_000])
def test_taken_words_meet_every_target(make_docs, rows, slice_rows):
    got = mixing.mix(make_docs(rows), rows_per_slice=slice_rows).collect()
    source = {i: s for i, _, s in rows}
    assert len(got) == len(rows)
    total = sum(r["size"] for r in got)
    by = {}
    for r in got:
        assert 0 <= r.taken <= 3 * r["size"]
        by.setdefault(source[r.doc_id], []).append(r)
    assert sum(v[0].target for v in by.values()) == pytest.approx(total)
    for own in by.values():
        assert sum(r.taken for r in own) == round(own[0].target)
        assert own[0].target <= 3 * own[0].source_size + 1e-6
        assert len({r.taken // r["size"] if r["size"] else 0 for r in own}) <= 2  # within one epoch of each other


def test_slices_do_not_change_the_mix(make_docs, rows):
    a, b = (sorted(map(tuple, mixing.mix(make_docs(rows), rows_per_slice=n).collect())) for n in (5, 50_000))
    assert a == b


def test_targets_stop_at_the_cap_and_reshare(make_docs):
    rows = [(1, "x " * 10, "a"), (2, "x " * 100, "b"), (3, "x " * 890, "c")]
    got = {r.doc_id: (r.target, r.taken) for r in mixing.mix(make_docs(rows)).collect()}
    assert got[1] == (30.0, 30)  # weight 5, three times its size
    assert got[2] == (300.0, 300)  # weight 2, three times its size
    assert got[3] == (pytest.approx(670.0), 670)


def test_mix_of_odd_rows(make_docs, odd_docs):
    got = mixing.mix(make_docs(odd_docs)).collect()
    assert len(got) == len(odd_docs)
    assert all(r.taken == 0 for r in got if r.doc_id in (4, 5, 6))
    assert mixing.mix(make_docs([])).count() == 0
    assert [r.taken for r in mixing.mix(make_docs([(1, None), (2, "")])).collect()] == [0, 0]


def test_mixed_documents_repeat_whole_rows(make_docs, rows):
    docs = make_docs(rows)
    taken = {r.doc_id: r.taken / r["size"] for r in mixing.mix(docs).collect()}
    out = mixing.mixed_documents(docs)
    assert out.columns == docs.columns
    count = {}
    for r in out.collect():
        count[r.doc_id] = count.get(r.doc_id, 0) + 1
    for i, share in taken.items():
        assert count.get(i, 0) == -(-share // 1)  # a part counts as a whole


def loads(got):
    out = {}
    for r in got:
        out.setdefault(r.shard, []).append(r)
    return out


@pytest.mark.parametrize("cell_rows", [10, 50_000])
def test_loads_are_bounded_and_slots_gapless(make_docs, rows, cell_rows):
    got = sharding.assign_shards(make_docs(rows), shards=6, rows_per_cell=cell_rows).collect()
    assert sorted(r.doc_id for r in got) == list(range(len(rows)))
    by, biggest = loads(got), max(r["size"] for r in got)
    mean = sum(r["size"] for r in got) / 6
    assert set(by) == set(range(6))
    for own in by.values():
        assert abs(sum(r["size"] for r in own) - mean) <= 0.01 * mean + 2 * biggest
        assert sorted(r.slot for r in own) == list(range(len(own)))
    texts = {i: t for i, t, _ in rows}
    assert all(r.text_crc32 == zlib.crc32(texts[r.doc_id].encode()) and r["size"] == len(texts[r.doc_id].encode()) + 8 for r in got)


def test_a_hot_group_is_spread_and_small_groups_stay_together(make_docs):
    rng = random.Random(1)
    rows = [(i, "copy " * 20 if i % 3 == 0 else sentence(rng, 20)) for i in range(900)]
    rows += [(1000 + i, f"pair {i // 2} " + "x " * 20) for i in range(300)]
    got = sharding.assign_shards(make_docs(rows), shards=5).collect()
    mean = sum(r["size"] for r in got) / 5
    assert all(abs(sum(r["size"] for r in own) - mean) < 0.05 * mean for own in loads(got).values())
    shard = {r.doc_id: r.shard for r in got}
    assert all(shard[1000 + i] == shard[1001 + i] for i in range(0, 300, 2))


def test_more_shards_move_a_limited_part(make_docs, rows):
    few = {r.doc_id: r.shard for r in sharding.assign_shards(make_docs(rows), shards=6).collect()}
    more = {r.doc_id: r.shard for r in sharding.assign_shards(make_docs(rows), shards=7).collect()}
    assert sum(few[i] != more[i] for i in few) < 0.5 * len(few)


def test_sharding_of_odd_rows(make_docs, odd_docs):
    got = sharding.assign_shards(make_docs(odd_docs), shards=3).collect()
    assert len(got) == len(odd_docs)
    assert {(r["size"], r.text_crc32) for r in got if r.doc_id in (4, 5)} == {(8, 0)}
    assert sharding.assign_shards(make_docs([])).count() == 0


def test_walk_takes_the_next_free_shard():
    pieces = sharding.walk([0, 1, 2], [50, 5, 0], 3, 20)
    assert pieces[:3] == [(0, 0, 0), (0, 20, 1), (0, 40, 2)]
    assert (1, 0, 2) in pieces  # the arc's own shard is full
