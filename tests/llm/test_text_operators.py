"""Decontamination, toxicity, license scans, page texts and preference pairs on small tables."""

import random
import re

import numpy as np
import pytest

from staywise.llm import contamination, label_model, licenses, page_text, preferences, toxicity
from tests.llm.conftest import sentence


def words(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def hits(docs, items):
    windows = {}
    for i, t in items:
        w = words(t)
        n = min(13, len(w))
        for k in range(len(w) - n + 1 if n else 0):
            windows.setdefault(tuple(w[k : k + n]), set()).add(str(i))
    out = []
    for i, t in docs:
        w, hit, found = words(t), set(), set()
        for n in {len(x) for x in windows}:
            for k in range(len(w) - n + 1):
                if tuple(w[k : k + n]) in windows:
                    hit |= set(range(k, k + n))
                    found |= windows[tuple(w[k : k + n])]
        out.append((i, len(w), len(hit), sorted(found)))
    return sorted(out, key=str)


@pytest.fixture(scope="module")
def benchmark_rows():
    rng = random.Random(21)
    return [(i, sentence(rng, n, 900)) for i, n in enumerate([40, 13, 12, 25, 3, 1, 60])] + [(90, None), (91, ""), (92, "!?"), (0, "w1 w1")]


@pytest.mark.parametrize("block_words", [20, 1_000_000])
def test_hits_are_those_of_brute_force(spark, make_docs, benchmark_rows, block_words):
    rng = random.Random(22)
    texts = []
    for _ in range(60):
        parts = [sentence(rng, rng.randrange(60), 900)]
        for _ in range(rng.randrange(3)):
            w = (rng.choice(benchmark_rows)[1] or "").split()
            a = rng.randrange(len(w) // 2 + 1)
            parts += [" ".join(w[a : a + rng.randrange(10, 40)]).upper(), sentence(rng, 5, 900)]
        texts.append(", ".join(parts))
    rows = list(enumerate(texts + [None, "", texts[0]]))
    items = spark.createDataFrame(benchmark_rows, "item_id long, text string")
    got = contamination.contaminated_words(make_docs(rows).drop("n_words", "hit_items"), items, block_words=block_words)
    got = sorted(((r.doc_id, r.n_words, r.n_hit, r.hit_items) for r in got.collect()), key=str)
    assert got == hits(rows, benchmark_rows)
    assert any(g[2] for g in got)


def test_clean_documents_keep_their_columns(spark, make_docs, odd_docs):
    items = spark.createDataFrame([(1, odd_docs[0][1]), (None, "one")], "item_id long, text string")
    docs = make_docs(odd_docs)
    kept = contamination.clean_documents(docs, items)
    assert kept.columns == docs.columns
    assert sorted(r.doc_id or 0 for r in kept.collect()) == [0, 4, 5, 6, 7, 7, 8, 9, 10, 11, 12]
    assert kept.where("doc_id = 9").first().n_words == "z"
    nothing = items.limit(0)
    assert contamination.clean_documents(docs, nothing).count() == len(odd_docs)
    assert contamination.clean_documents(docs.limit(0), items).count() == 0


@pytest.fixture(scope="module")
def toxic(spark, make_docs):
    rng = random.Random(31)
    rows, labels = [], []
    for i in range(600):
        text, bad = sentence(rng, rng.randrange(5, 60)), i % 6 == 0
        if bad:
            for _ in range(rng.randrange(2, 5)):
                text += " " + rng.choice(["idiot", "scum", "grblx" + rng.choice("abcdef"), "pathetic"]) + " " + sentence(rng, 3)
        rows.append((i, text))
        if i % 2 == 0:
            labels.append((i, 0, int(bad)))
    return rows, make_docs(rows), spark.createDataFrame(labels, "doc_id long, quality int, toxic int")


def test_held_out_rows_are_told_apart(toxic):
    rows, docs, labels = toxic
    got = toxicity.toxicity(docs, labels).collect()
    assert len(got) == len(rows)
    held = [r for r in got if r.held_out]
    assert 100 < len(held) < 200
    wrong = sum(r.predicted != int(r.doc_id % 6 == 0) for r in held)
    assert wrong <= 0.05 * len(held)
    assert all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.3) for r in got)


def test_labels_of_held_out_rows_are_not_used(spark, toxic):
    rows, docs, labels = toxic
    flipped = labels.selectExpr(
        "doc_id", "quality", "CASE WHEN crc32(cast(cast(doc_id AS string) AS binary)) % 4 = 2 THEN 1 - toxic ELSE toxic END AS toxic"
    )
    a, b = (sorted((r.doc_id, r.score) for r in toxicity.toxicity(docs, x).collect()) for x in (labels, flipped))
    assert a == b


def test_lexicons_are_mined_from_all_labelled_rows(toxic):
    _, docs, labels = toxic
    lexicon = toxicity.fit(docs, labels, rows=10).lexicon
    assert (lexicon.voter >= 4).any()


def test_posteriors_decide_the_fit_where_labels_fill_the_sample(toxic, monkeypatch):
    _, docs, labels = toxic
    fitted = label_model.fit

    def turned(counts, voters, strong):
        model = fitted(counts, voters, strong)
        model.posterior = 1 - model.posterior
        return model

    def scores():
        return np.array([r.score for r in toxicity.toxicity(docs, labels, rows=100).orderBy("doc_id").collect()])

    right = scores()
    monkeypatch.setattr(label_model, "fit", turned)
    assert np.corrcoef(right, scores())[0, 1] < 0


def test_length_decides_nothing(spark, toxic):
    """Very long clean texts stay clean; a toxic passage within a long one is found; many toxic windows are no less than one."""
    rows, docs, labels = toxic
    model = toxicity.fit(docs, labels)
    rng = random.Random(77)
    clean = [t for i, t in rows if i % 6]
    bad = [t for i, t in rows if i % 6 == 0]

    def noise(n):
        return " ".join("".join(rng.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(rng.randrange(2, 9))) for _ in range(n))

    made = {f"noise {n}": noise(n) for n in (10, 1_000, 10_000, 100_000)}
    made |= {f"clean {n}": " ".join((clean * (1 + n // 10_000))[: n // 30]) for n in (1_000, 10_000, 100_000)}
    made |= {f"toxic {n}": " ".join(rng.choice(clean) for _ in range(n)) + " idiot scum pathetic grblxa " + " ".join(rng.choice(clean) for _ in range(n)) for n in (1, 30)}
    made["toxic all"] = " ".join(bad)
    frame = spark.createDataFrame(list(made.items()), "name string, text string")
    got = {r.name: r.score for r in toxicity.scored(frame, model, "score").collect()}
    assert all(s < 0.3 for name, s in got.items() if not name.startswith("toxic")), got
    assert all(s >= 0.3 for name, s in got.items() if name.startswith("toxic")), got


def test_windows_part_every_text():
    import pyarrow as pa

    from staywise.llm import words

    texts = ["a b c d e f g", "", None, "one", " x  y ", "a " * 600]
    data, limits = words.utf8(pa.array(texts))
    found = words.split_words(data, limits, words.ALNUM, (5, 8))
    cut = toxicity.cut_windows(found, limits, 3)
    assert np.bincount(cut.text).tolist() == [3, 1, 1, 1, 1, 200]
    assert cut.words.first[0] == 0 and cut.words.first[-1] == len(found.start) and (np.diff(cut.words.first) <= 3).all()
    assert cut.limits[0] == 0 and cut.limits[-1] == len(data) and (np.diff(cut.limits) >= 0).all()


def test_toxicity_of_odd_rows_and_without_labels(spark, make_docs, odd_docs):
    none = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    got = toxicity.toxicity(make_docs(odd_docs), none).collect()
    assert len(got) == len(odd_docs) and len({r.score for r in got if r.doc_id in (4, 5, 6)}) == 1
    some = spark.createDataFrame([(12, 0, 1), (1, 0, 0), (1, 0, None), (None, 0, 1), (77, 1, 1)], none.schema)
    docs = make_docs(odd_docs)
    kept = toxicity.accepted(docs, some)
    assert kept.columns == docs.columns and kept.where("doc_id = 9").first().score == "s"
    assert toxicity.toxicity(make_docs([]), none).count() == 0


def test_label_model_learns_accuracies_and_correlated_voters():
    rng = np.random.default_rng(0)
    label = rng.random(20_000) < 0.15
    fires = [np.where(label, rng.random(20_000) < a, rng.random(20_000) < b) for a, b in ((0.8, 0.02), (0.7, 0.05), (0.6, 0.01), (0.3, 0.3))]
    fires.append(np.where(rng.random(20_000) < 0.95, fires[1], rng.random(20_000) < 0.5))  # nearly a copy of voter 1
    pattern = sum(f.astype(int) << k for k, f in enumerate(fires))
    counts = np.zeros((32, 3))
    np.add.at(counts, (pattern, 2), 1)
    model = label_model.fit(counts, 5, [0, 1, 2])
    assert (1, 4) in model.pairs
    assert all(model.fires[1][k] > 5 * model.fires[0][k] for k in (0, 1, 2))
    assert abs(model.fires[1][3] - model.fires[0][3]) < 0.05
    assert model.prior == pytest.approx(0.15, abs=0.04)
    assert ((model.posterior[pattern] > 0.5) == label).mean() > 0.92
    np.add.at(counts, (pattern[:2000], label[:2000].astype(int)), 1)
    np.add.at(counts, (pattern[:2000], 2), -1)
    helped = label_model.fit(counts, 5, [0, 1, 2])
    assert ((helped.posterior[pattern] > 0.5) == label).mean() > 0.92


@pytest.mark.parametrize("containment", [75, 100])
def test_license_matches_are_those_of_all_windows(make_docs, containment):
    rng = random.Random(41)
    names = sorted(licenses.TEMPLATES)
    texts = []
    for _ in range(120):
        w = licenses.TEMPLATES[rng.choice(names)].split()
        for _ in range(rng.randrange(3)):
            w[rng.randrange(len(w))] = "changed"
        texts.append(sentence(rng, rng.randrange(40)) + " " + " ".join(w).upper() + "\n" + sentence(rng, rng.randrange(40)))
    rows = list(enumerate([*texts, None, "", "word"]))
    got = licenses.license_matches(make_docs(rows), containment=containment, certainty=1 - 1e-9).collect()
    sets = {n: {tuple(words(t)[i : i + 5]) for i in range(len(words(t)) - 4)} for n, t in licenses.TEMPLATES.items()}
    for r in got:
        w = words(dict(rows)[r.doc_id])
        own = [tuple(w[i : i + 5]) for i in range(len(w) - 4)]
        want = set()
        for name, s in sets.items():
            size = 1 << (len(s) - 1).bit_length()
            step = max(1, size // 2)
            width = 1 if size == 1 else 3 * step
            if any(100 * len(s & set(own[a : a + width])) >= containment * len(s) for a in range(0, len(own), step)):
                want.add(name)
        assert {m.template for m in r.matches} == want
        for m in r.matches:
            assert set(own[m.first_word : m.last_word - 3]) & sets[m.template]
    assert len(got) == len(rows) and sum(bool(r.matches) for r in got) > 30


def test_licenses_of_odd_rows(make_docs, odd_docs):
    got = licenses.license_matches(make_docs(odd_docs)).collect()
    assert len(got) == len(odd_docs) and not any(r.matches for r in got)
    assert licenses.license_matches(make_docs([])).count() == 0


PAGE = """<html><head><title>T</title><style>p{}</style></head><body><header><a href=/>Home</a></header>
<nav><ul><li><a>One</a><li><a>Two</a></ul></nav><div class="cookie-banner">We use cookies, really.</div>%s
<aside><p>Beside it, some words. And more, of course.</p></aside><form>Name <input> <button>Send</button></form>
<section id="comments"><article class="comment"><p>I say, as a reader, that this is long. Very long, indeed.</p></article></section>
<footer>&copy; Someone, 2024.</footer><script>var t = "</p>";</script></body></html>"""


@pytest.mark.parametrize(
    ("body", "want"),
    [
        ("<article><h1>Head &amp; line</h1><p>First, it says.<p>Second\n  one&nbsp;too.<br>Same block.</article>", ["Head & line", "First, it says.", "Second one too. Same block."]),
        ("<article><p>A</p><div class=advert>Buy, now!</div><ul><li>x<li>y</ul><blockquote>q</blockquote></article>", ["A", "x", "y", "q"]),
        ("<div class=wrap><h1>Head</h1><div class=text><p>Sentences, with marks. Two of them.</p><p>And a third, as it goes.</p></div></div>", ["Head", "Sentences, with marks. Two of them.", "And a third, as it goes."]),
        ("<article><header><h2>Kept</h2><p class=byline>By me</p></header><p>Text &lt;b&gt; &#233;.</p><footer>Filed.</footer></article>", ["Kept", "Text <b> é."]),
        ("<article><p><b>Unclosed.<p>Next <i>one</i>here</article>", ["Unclosed.", "Next onehere"]),
    ],
)
def test_main_text(body, want):
    assert page_text.main_blocks(PAGE % body) == want


def test_pages_table(spark):
    rows = [(1, "u", PAGE % "<article><p>Ünï 漢字.</p></article>"), (2, None, None), (3, "u", ""), (None, "u", "<p>x"), (1, "u", "<article>" + "<p>So it goes, on.</p>" * 5000)]
    pages = spark.createDataFrame([(*r, "e") for r in rows], "page_id long, url string, html string, text string")
    got = {(r.page_id, r.n_chars): r.text for r in page_text.main_texts(pages).collect()}
    assert got[1, 7] == "Ünï 漢字." and got[2, 0] == "" and got[3, 0] == "" and got[None, 1] == "x"
    assert got[1, 5000 * 17 - 2].count("\n\n") == 4999
    assert page_text.main_texts(pages.limit(0)).count() == 0


def chat(spark, rows):
    return spark.createDataFrame([(*r, "e") for r in rows], "conv_id long, turn long, role string, text string, start string")


def test_preference_pairs(spark):
    rows = [(0, 0, "user", "Hi"), (0, 1, "assistant", "Good <|im_end|> day"), (0, 2, "user", "Bye"), (0, 3, "assistant", "So long")]
    rows += [(1, 0, "user", "Hi"), (1, 1, "assistant", "Good <|im_end|> day"), (1, 5, "user", "Bye"), (1, 9, "assistant", "Go away"), (1, 9, "assistant", "Go away")]
    rows += [(2, 0, "user", None), (2, None, None, "first"), (None, 0, "user", "lost")]
    rows += [(4, 0, "user", "same"), (5, 0, "user", "same")]
    got = {r.pair_id: r for r in preferences.preference_rows(chat(spark, rows), *preferences.neighbours()).collect()}
    assert set(got) == {0, 1, 2}
    a = got[0]
    assert a.n_common == 3 and a.prompt.endswith("<|im_start|>user\nBye<|im_end|>\n") and "Good < |im_end| > day" in a.prompt
    assert a.chosen == "<|im_start|>assistant\nSo long<|im_end|>\n"
    assert [a.chosen[m["from"] : m["to"]] for m in a.chosen_mask] == ["So long<|im_end|>"]
    assert [a.rejected[m["from"] : m["to"]] for m in a.rejected_mask] == ["Go away<|im_end|>"]
    assert got[1].n_common == 0 and got[1].prompt == "" and got[1].rejected == "" and got[1].chosen.startswith("<|im_start|>\nfirst")
    assert got[2].n_common == 1 and got[2].chosen == got[2].rejected == "" and got[2].chosen_mask == []
    assert preferences.preference_rows(chat(spark, []), *preferences.neighbours()).count() == 0
