"""Words, shingles and long texts: what is cut in pieces must give what the whole gives."""

import random
import re

import numpy as np
import pyarrow as pa
import pytest

from staywise.llm import chunk_dedup, suffix_dedup, words

TEXTS = ["Ünï two  THREE-4\tfive", None, "", " ", "a" * 50, "x y", "漢字 🙂 ends", "one"] * 3


def found(texts, kind, **options):
    return words.split_words(*words.utf8(pa.array(texts, pa.string())), kind, **options)


@pytest.mark.parametrize(("kind", "pattern"), [(words.VISIBLE, r"[^\x20\x09-\x0D]+"), (words.ALNUM, r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")])
def test_words_are_those_of_the_pattern(kind, pattern):
    w = found(TEXTS, kind)
    for i, text in enumerate(TEXTS):
        own = re.findall(pattern, re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
        got = [w.data[w.start[k] : w.end[k]].tobytes().decode() for k in range(w.first[i], w.first[i + 1])]
        assert got == own
    by = {}
    for k in range(len(w.start)):
        by.setdefault(w.data[w.start[k] : w.end[k]].tobytes(), set()).add(int(w.hash[k]))
    assert all(len(h) == 1 for h in by.values()) and len({min(h) for h in by.values()}) == len(by)


@pytest.mark.parametrize("piece", [1, 7, 64])
def test_pieces_change_no_hash(monkeypatch, piece):
    rng = random.Random(1)
    texts = [" ".join("abcdefgh"[: rng.randrange(1, 9)] * rng.randrange(1, 4) for _ in range(80)) for _ in range(4)]
    whole = found(texts, words.ALNUM, prefixes=(2, 4))
    monkeypatch.setattr(words, "PIECE_BYTES", piece)
    cut = found(texts, words.ALNUM, prefixes=(2, 4))
    assert (whole.hash == cut.hash).all() and all((a == b).all() for a, b in zip(whole.prefixes, cut.prefixes))


def test_slices_of_a_batch_and_large_strings():
    column = pa.array(TEXTS, pa.string())
    part = column.slice(4, 5)
    data, limits = words.utf8(part)
    assert [data[a:b].tobytes().decode() for a, b in zip(limits[:-1], limits[1:])] == [t or "" for t in TEXTS[4:9]]
    again = words.utf8(part.cast(pa.large_string()))
    assert (again[0] == data).all() and (again[1] == limits).all()
    batch = pa.RecordBatch.from_arrays([column], ["text"])
    pieces = list(words.blocks(batch, "text", 20))
    assert sum(p.num_rows for p in pieces) == len(TEXTS) and len(pieces) > 3
    assert list(words.blocks(batch.slice(0, 0), "text")) == []


def test_shingle_sets():
    sets = list(words.shingle_sets(found(["a b c d e f", "a b c d e", "a b", "", "b a", "a b"], words.VISIBLE), 5))
    assert [len(s) for s in sets] == [2, 1, 1, 0, 1, 1]
    assert sets[1][0] in sets[0] and (sets[2] == sets[5]).all() and sets[2][0] != sets[4][0]


def test_segments_of_long_texts(monkeypatch):
    rng = np.random.default_rng(3)
    data = rng.integers(97, 101, 9000).astype(np.uint8)
    anchors, cuts = suffix_dedup.anchors(data, 200, 64), chunk_dedup.cut_places(data)
    monkeypatch.setattr(suffix_dedup, "SEGMENT_BYTES", 700)
    monkeypatch.setattr(chunk_dedup, "SEGMENT_BYTES", 700)
    again = suffix_dedup.anchors(data, 200, 64)
    assert (again[0] == anchors[0]).all() and (again[1] == anchors[1]).all()
    assert (chunk_dedup.cut_places(data) == cuts).all() and len(cuts) > 3
