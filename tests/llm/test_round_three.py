"""Importance resampling, embedding near-dedup and conversation repair against brute force and their SQL."""

import hashlib
import itertools
import math
import random
import re
import zlib

import duckdb
import numpy as np
import pandas as pd
import pytest

from staywise.llm import embedding_dedup, importance, statements, turn_repair

LOWER = {i: i + 32 for i in range(65, 91)}


def features(text):
    found = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (text or "").translate(LOWER))
    return found, found + [" ".join(p) for p in zip(found, found[1:])]


def plain_resample(docs, target, percent=25, least=20):
    def buckets(text):
        return [zlib.crc32(f.encode()) % 10_000 for f in features(text)[1]]

    s, t = np.zeros(10_000), np.zeros(10_000)
    for text in docs:
        np.add.at(s, buckets(text[1]), 1)
    for text in target:
        np.add.at(t, buckets(text), 1)
    gain = [math.floor(1000 * math.log((b + 1) * (s.sum() + 10_000) / ((a + 1) * (t.sum() + 10_000)))) for a, b in zip(s, t)]
    rows = []
    for doc_id, text in docs:
        held = buckets(text)
        weight = sum(gain[b] for b in held) // len(held) if held else 0
        h = int(hashlib.sha256(f"7:{'' if doc_id is None else doc_id}".encode()).hexdigest()[:8], 16)
        rows.append([doc_id, len(held), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296))), None, len(features(text)[0])])
    able = sorted((r for r in rows if r[5] >= least), key=lambda r: (-r[3], -1 if r[0] is None else r[0], r[1]))
    for i, r in enumerate(able[: percent * len(able) // 100], 1):
        r[4] = i
    return sorted((tuple(r[:5]) for r in rows), key=str)


def test_resampling_equals_a_plain_computation(spark, make_docs, odd_docs):
    rng = random.Random(2)
    rows = [*[r[:2] for r in odd_docs], *[(100 + i, " ".join(f"w{rng.randrange(60)}" for _ in range(rng.randrange(60)))) for i in range(120)]]
    rows += [(500, "X" * 5000 + " y " * 30), (501, "z" * 64 + " " + "z" * 65 + " q" * 25)]
    target = ["w1 w2 w3 w4 w5 w6", None, "", "one W1"]
    items = spark.createDataFrame([(i, t) for i, t in enumerate(target)], "item_id long, text string")
    got = importance.resample(make_docs(rows), items)
    assert got.columns == ["doc_id", "n_features", "weight", "score", "rank"]
    assert sorted(map(tuple, got.collect()), key=str) == plain_resample(rows, target)
    assert importance.resample(make_docs([]), items).count() == 0
    alone = importance.resample(make_docs(rows[:20]), items.limit(0))
    assert sorted(map(tuple, alone.collect()), key=str) == plain_resample(rows[:20], [])


def test_words_in_chunks_keep_their_neighbours(monkeypatch):
    texts = [b"a b c d e", b"", b"f", b"g h i j k l m"]
    whole = [[x.tolist() for x in part] for part in importance.batch_features(texts, 3)]
    monkeypatch.setattr(importance, "CHUNK", 4)
    parts = [[x.tolist() for x in part] for part in importance.batch_features(texts, 3)]
    assert len(parts) > 1

    def pairs(found):
        return sorted(p for part in found for p in zip(part[0], part[2]))

    assert pairs(whole) == pairs(parts)
    assert sorted(x for p in whole for x in p[1]) == sorted(x for p in parts for x in p[1])


def plain_links(rows, cosine=0.9):
    """(vec_id, n_links, component_id, kept) by comparing all pairs."""
    able = [e is not None and len(e) == 4 and all(x is not None and math.isfinite(x) for x in e) and any(e) for _, e in rows]
    root = list(range(len(rows)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    links = [0] * len(rows)
    for i, j in itertools.combinations(range(len(rows)), 2):
        if able[i] and able[j]:
            x, y = np.array(rows[i][1]), np.array(rows[j][1])
            if x @ y / math.sqrt(x @ x) / math.sqrt(y @ y) >= cosine:
                links[i] += 1
                links[j] += 1
                root[find(i)] = find(j)
    out = []
    for i, (vec_id, _) in enumerate(rows):
        ids = [rows[j][0] for j in range(len(rows)) if find(j) == find(i) and rows[j][0] is not None]
        least = min(ids, default=None)
        out.append((vec_id, links[i], least, vec_id is not None and vec_id == least))
    return sorted(out, key=str)


def test_near_vectors_equal_all_pairs(spark, monkeypatch):
    rng = np.random.default_rng(4)
    centres = rng.normal(size=(12, 4))
    rows = [(i, (centres[i % 12] + rng.normal(size=4) * rng.choice([0.01, 0.1, 0.3])).tolist()) for i in range(150)]
    rows += [(200, rows[3][1]), (201, [2 * x for x in rows[3][1]]), (3, rows[3][1]), (3, rows[4][1]), (None, rows[5][1])]
    rows += [(300, None), (301, [0.0] * 4), (302, [1.0, None, 0.0, 0.0]), (303, [1.0, float("nan"), 0.0, 0.0]), (304, [1.0, float("inf"), 0.0, 0.0]), (305, [1.0, 0.0]), (306, [])]
    schema = "vec_id long, embedding array<double>, label int, row string, ball string, code string"
    table = spark.createDataFrame([(*r, 1, "r", "b", "c") for r in rows], schema)
    want = plain_links(rows)
    monkeypatch.setattr(embedding_dedup, "MEET", 1 - 1e-14)  # every link, so the rest must be exact
    monkeypatch.setattr(embedding_dedup, "SPREAD", 100.0)
    for block in (3, 512):
        got = embedding_dedup.near_duplicates(table, block=block)
        assert got.columns == ["vec_id", "n_links", "component_id", "kept"]
        assert sorted(map(tuple, got.collect()), key=str) == want
    assert embedding_dedup.near_duplicates(table.limit(0)).count() == 0
    none = embedding_dedup.near_duplicates(table.where("vec_id >= 300 AND vec_id < 302")).collect()
    assert sorted(map(tuple, none)) == [(300, 0, 300, True), (301, 0, 301, True)]


def test_recall_at_the_threshold(spark):
    """Pairs just above the threshold, in production settings, with links found and none made up."""
    rng = np.random.default_rng(8)
    base = rng.normal(size=(400, 64))
    base /= np.linalg.norm(base, axis=1, keepdims=True)
    side = rng.normal(size=(400, 64))
    side -= (side * base).sum(axis=1, keepdims=True) * base
    side /= np.linalg.norm(side, axis=1, keepdims=True)
    aim = rng.uniform(0.88, 0.97, size=(400, 1))
    every = np.concatenate([base, aim * base + np.sqrt(1 - aim**2) * side]).astype(np.float32)
    table = spark.createDataFrame(pd.DataFrame({"vec_id": range(800), "embedding": every.tolist()}), "vec_id long, embedding array<float>")
    got = embedding_dedup.near_duplicates(table).toPandas().set_index("vec_id")["n_links"].loc[range(800)].to_numpy()
    unit = every.astype(float) / np.linalg.norm(every.astype(float), axis=1, keepdims=True)
    want = (unit @ unit.T >= 0.9).sum(axis=1) - 1
    assert (got <= want).all() and got.sum() >= 0.9 * want.sum() > 400


def test_a_large_group_is_one_ball_and_makes_no_pairs(spark):
    rng = np.random.default_rng(9)
    near = rng.normal(size=16) + 0.02 * rng.normal(size=(1500, 16))
    table = spark.createDataFrame(pd.DataFrame({"vec_id": range(1500), "embedding": near.tolist()}), "vec_id long, embedding array<double>")
    member = embedding_dedup.balls(embedding_dedup.coded_rows(table))
    assert member.select("ball").distinct().count() <= 3
    got = embedding_dedup.near_duplicates(table).toPandas()
    assert (got["n_links"] == 1499).all() and (got["component_id"] == 0).all() and got["kept"].sum() == 1


KEPT = {"": "su", "s": "u", "u": "a", "a": "u"}


def plain_repair(rows):
    """The cheapest repair of damaged rows (role, text), by trying all edits with the remaining cost as bound."""
    faults, seen = [], set()
    for role, text in rows:
        tail = text.rstrip(" \t\n\x0b\x0c\r")[-1:]
        faults.append("blank" if not tail else "duplicate" if (role, text) in seen else "cut" if tail not in ".!?" else "")
        seen.add((role, text))
    best = None
    stack = [(0, 0, "", "", ())]
    while stack:
        i, cost, state, audit, out = stack.pop()
        if best and cost > best[0]:
            continue
        if i == len(rows):
            if state in ("", "a"):
                best = min([b for b in (best, (cost, audit, out)) if b])
            elif cost < 40:
                role = "assistant" if state == "u" else "user"
                stack.append((i, cost + 3, role[0], audit + "I", (*out, f"{role}:")))
            continue
        role, text = rows[i]
        extra = 3 if faults[i] == "cut" else 0
        forced = "assistant" if state == "u" else "user"
        stack.append((i + 1, cost + 4, state, audit + "D", out))
        if not audit.endswith("III"):
            stack.append((i, cost + 3, forced[0], audit + "I", (*out, f"{forced}:")))
        if faults[i] not in ("blank", "duplicate"):
            stack.append((i + 1, cost + 3 + extra, forced[0], audit + "R", (*out, f"{forced}:{text}")))
            if role[:1] and role[0] in KEPT[state]:
                stack.append((i + 1, cost + extra, role[0], audit + "K", (*out, f"{role}:{text}")))
    illegal = sum(a[0][:1] + b[0][:1] not in ("su", "ua", "au") for a, b in zip(rows, rows[1:]))
    counts = [faults.count(f) for f in ("blank", "duplicate", "cut")]
    return *counts, illegal, best[0], best[1], hashlib.sha256("\n".join(best[2]).encode()).hexdigest()


def conversations(spark, rows):
    schema = "conv_id long, turn long, role string, text string, gone string, place string, fault string, pointers string"
    return spark.createDataFrame([(*r, "g", "p", "f", "b") for r in rows], schema)


def damage(rows):
    """The contract's damage and order, row by row: {conv_id: [(turn, role, text)]}."""
    out = {}
    for conv, turn, role, text in rows:
        part = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
        role, text = " " if role is None else role, " " if text is None else text
        found = out.setdefault(conv, [])
        text = "" if part == 1 else re.sub("[.!?]", "", text) if part == 2 else text
        role = "user" if part == 4 else role
        found.extend([(turn, role, text)] * (0 if part == 0 else 2 if part == 3 else 1))
    return {c: sorted(rs, key=lambda r: (r[0] is not None, r[0] or 0, r[1], r[2])) for c, rs in out.items()}


def test_repair_equals_trying_all_edits(spark, monkeypatch):
    rng = random.Random(6)
    roles = ["system", "user", "assistant", "user", "assistant", "tool", "", None]
    texts = ["Yes.", "No!", "so", " \t\n", "", None, "Why? ", "Yes."]
    rows = [(c, rng.choice([t, t + 3, None]) if rng.random() < 0.1 else t, rng.choice(roles), rng.choice(texts)) for c in range(60) for t in range(rng.randrange(1, 7))]
    rows += [(None, 0, "user", "Hm."), (None, 4, "assistant", "Ha."), (2**60 + 1, -5, "user", "x" * 10_000 + "."), *[(900, 1, "user", "Same.")] * 3]
    want = {}
    for conv, found in damage(rows).items():
        turns = [t for t, _, _ in found if t is not None]
        gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
        want[conv] = (gaps, *plain_repair([r[1:] for r in found])) if found else (0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())
    for batch in ("10000", "2"):  # of two rows: conversations go on over many Arrow batches
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", batch)
        got = {r.conv_id: tuple(r)[1:] for r in turn_repair.repair_damaged(conversations(spark, rows)).collect()}
        assert got == want
    spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    assert turn_repair.repair_damaged(conversations(spark, rows).limit(0)).count() == 0


def test_a_giant_conversation(spark):
    rows = [(1, t, ("user", "assistant")[t % 2], f"text {t}.") for t in range(30_000)]
    got = turn_repair.repair_damaged(conversations(spark, rows)).first()
    assert len(got.audit) > 27_000 and got.cost > 0 and set(got.audit) <= set("DIKR")
    assert sum(got.audit.count(x) for x in "DKR") == len(damage(rows)[1])


@pytest.mark.parametrize("text", ["", "a", "Ünï 漢", "x" * 300])
def test_crc_in_sql(text):
    found = duckdb.sql(f"SELECT {statements.crc32_sql('t')} FROM (SELECT '{text}' AS t)").fetchall()[0][0] if text else 0
    assert found == zlib.crc32(text.encode())
