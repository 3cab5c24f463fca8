"""Toxicity by weak supervision: voters, a generative label model, a linear classifier on posterior labels.

1. Voters: fixed lexicons of insults, patterns of shouting, and lexicons mined from labelled rows (words and word
   beginnings that go with label 1 beyond chance). Labels come only from rows outside the held-out quarter.
2. Whole texts are cut into windows of at most ``WINDOW`` words, equally long within a text, and every window of every document votes;
   the counts of vote patterns (2 ** voters at most) fit the label model. A label 0 holds for all windows of its text, a
   label 1 for the window of a text that has but one; the windows of a longer text with label 1 count as unlabelled.
3. A logistic regression on how often a window has the words and word beginnings that go with toxic posteriors beyond chance learns the
   posterior labels of the windows of a bounded sample of documents outside the held-out quarter, with a label or without.
4. Every document is scored from its whole text in one pass, without a shuffle. A text is toxic if some window of it is: its odds
   are a mean of its windows' odds, as each is as likely to be that window. So a long clean text isn't called toxic for its
   many chances, and a toxic passage is found within a long text if it is plain enough.

``TRAINING_ROWS`` bounds the sample that the classifier is fitted on; lexicons and the label model see all rows. Text is all that a score depends on.

Inputs without a result of their own: an empty table gives no rows; a null or empty text has no words, and the score of
that; without labels only fixed lexicons and patterns vote; a null doc_id is never held out and never has a label;
repeated rows are scored each, and repeated labels count as often as they come; a very long text has very many windows;
other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.linalg import SparseVector, VectorUDT
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from staywise.llm import label_model, prefilter, words
from staywise.session import materialize

# Seed lexicons, one voter each.
INSULTS_EN = "idiot moron stupid dumb loser trash scum worthless pathetic disgusting clown fool garbage filthy ugly".split()
INSULTS_OTHER = (
    "idiote imbécile crétin connard salope ordure minable abruti dégueulasse "
    "dummkopf arschloch trottel schwachkopf abschaum wertlos widerlich blödmann "
    "idiota imbécil estúpido basura asqueroso inútil payaso patético"
).split()

#: Production parameters.
HELD_OUT = (4, 2)
THRESHOLD = 0.3
TRAINING_ROWS = 20_000
MINED_VOTERS = 8
MINED_TERMS = 512
LEAST_GAIN = 24.0
PREFIXES = (5, 8)
WINDOW = 256
#: Terms that the classifier knows: those with the largest gains, of at least ``LEAST_TERM_GAIN``.
TERMS = 8_192
LEAST_TERM_GAIN = 8.0
SHOUTING = 0.3
MARKS = 3
#: Power of the mean that a text's windows are pooled by: below 1 a single window counts for less the more there are.
POOL = 0.7
REGULARISATION = 0.1  # on the sum of the losses; the share on their mean goes with 1 / rows
VOTERS = 4 + MINED_VOTERS
FILTER_BITS = 16


def held_out(doc_id: Column) -> Column:
    modulus, rest = HELD_OUT
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % modulus == rest, F.lit(False))


def _terms(found: words.Words) -> tuple[np.ndarray, np.ndarray]:
    """(text, 64-bit term) of all words and word beginnings."""
    text = np.repeat(np.arange(len(found.first) - 1), np.diff(found.first))
    kinds = (found.hash, *found.prefixes)
    return np.tile(text, len(kinds)), np.concatenate(kinds)


@dataclass
class Windows:
    """Windows of some texts: their words, byte limits, and the text of each."""

    words: words.Words
    limits: np.ndarray
    text: np.ndarray


def cut_windows(found: words.Words, limits: np.ndarray, size: int = WINDOW) -> Windows:
    """Each text's words in windows of equal length, ``size`` at most; a text without words is one window."""
    n = np.diff(found.first)
    parts = np.maximum(1, -(-n // size))
    text = np.repeat(np.arange(len(n)), parts)
    inside = np.arange(len(text)) - np.repeat(np.cumsum(parts) - parts, parts)
    first = np.append(found.first[:-1][text] + inside * n[text] // parts[text], found.first[-1])
    at = limits[:-1][text]
    later = inside > 0
    at[later] = found.start[first[:-1][later]]
    cut = words.Words(found.data, found.start, found.end, found.hash, first, found.prefixes)
    return Windows(cut, np.append(at, limits[-1]), text)


def _split(part: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray, words.Words]:
    data, limits = words.utf8(part.column("text"))
    return data, limits, words.split_words(data, limits, words.ALNUM, PREFIXES)


def term_hashes(terms: list[str]) -> np.ndarray:
    data, limits = words.utf8(pa.array(terms, pa.string()))
    return words.split_words(data, limits, words.ALNUM).hash


@dataclass
class Lexicon:
    """Sorted term hashes, the voter of each, and a table that rules most terms out."""

    terms: np.ndarray
    voter: np.ndarray
    likely: np.ndarray

    @classmethod
    def of(cls, by_voter: dict[int, np.ndarray]) -> Lexicon:
        every = {int(t): v for v, terms in sorted(by_voter.items(), reverse=True) for t in terms}
        terms = np.array(sorted(every), dtype=np.uint64)
        return cls(terms, np.array([every[int(t)] for t in terms], dtype=np.int64), _likely(terms))


def _patterns(data: np.ndarray, limits: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Two votes per text: a high share of capitals among ASCII letters; runs of exclamation marks."""
    upper = (data >= 65) & (data <= 90)
    letters = upper | ((data >= 97) & (data <= 122))
    marks = np.zeros(len(data), dtype=bool)
    marks[1:] = (data[1:] == 33) & (data[:-1] == 33)

    def count(of: np.ndarray) -> np.ndarray:
        return np.diff(np.concatenate([[0], np.cumsum(of)])[limits])

    return count(upper) > SHOUTING * np.maximum(count(letters), 1), count(marks) >= MARKS


def votes(data: np.ndarray, windows: Windows, lexicon: Lexicon) -> np.ndarray:
    """Each window's vote pattern."""
    text, term = _terms(windows.words)
    out = np.zeros(len(windows.text), dtype=np.int64)
    near = lexicon.likely[(term & np.uint64((1 << FILTER_BITS) - 1)).astype(np.int64)]
    text, term = text[near], term[near]
    if len(lexicon.terms):
        place = np.minimum(np.searchsorted(lexicon.terms, term), len(lexicon.terms) - 1)
        hit = lexicon.terms[place] == term
        np.bitwise_or.at(out, text[hit], np.int64(1) << lexicon.voter[place[hit]])
    shouts, marks = _patterns(data, windows.limits)
    return out | (shouts.astype(np.int64) << 2) | (marks.astype(np.int64) << 3)


def _vote_rows(lexicon: Lexicon):
    """(pattern, label, rows): counted within each batch, so what is shuffled is bounded by the patterns."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in words.blocks(batch, "text"):
                data, limits, found = _split(part)
                windows = cut_windows(found, limits)
                label = np.asarray(part.column("label").fill_null(2)).astype(np.int64)[windows.text]
                several = np.bincount(windows.text)[windows.text] > 1
                label = np.where((label == 1) & several, 2, label)
                key, n = np.unique(votes(data, windows, lexicon) * 3 + label, return_counts=True)
                yield pa.RecordBatch.from_arrays([pa.array(key), pa.array(n.astype(np.int64))], ["key", "rows"])

    return rows


def _window_terms(lexicon: Lexicon, posterior: np.ndarray):
    """(term, n1, n): how many windows of a block hold a term, and the sum of their posteriors."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in words.blocks(batch, "text"):
                data, limits, found = _split(part)
                windows = cut_windows(found, limits)
                p = posterior[votes(data, windows, lexicon)]
                window, term = _distinct(*_terms(windows.words))
                terms, at = np.unique(term, return_inverse=True)
                n1, n = np.bincount(at, p[window], len(terms)), np.bincount(at, minlength=len(terms)).astype(float)
                yield pa.RecordBatch.from_arrays([pa.array(terms.view(np.int64)), pa.array(n1), pa.array(n)], ["term", "n1", "n"])

    return rows


def _distinct(text: np.ndarray, term: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Each text's terms once."""
    order = np.lexsort((term, text))
    text, term = text[order], term[order]
    once = np.ones(len(term), dtype=bool)
    once[1:] = (term[1:] != term[:-1]) | (text[1:] != text[:-1])
    return text[once], term[once]


def _known_terms(windows: Windows, terms: np.ndarray, likely: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(window, place among ``terms``, times) of each window's different terms that are among them."""
    window, term = _terms(windows.words)
    near = likely[(term & np.uint64((1 << FILTER_BITS) - 1)).astype(np.int64)]
    window, term = window[near], term[near]
    if not len(terms):
        return window[:0], window[:0], window[:0]
    place = np.minimum(np.searchsorted(terms, term), len(terms) - 1)
    hit = terms[place] == term
    key, times = np.unique(window[hit] * len(terms) + place[hit], return_counts=True)
    return key // len(terms), key % len(terms), times


def _likely(terms: np.ndarray) -> np.ndarray:
    """A table that rules most other terms out."""
    likely = np.zeros(1 << FILTER_BITS, dtype=bool)
    likely[(terms & np.uint64((1 << FILTER_BITS) - 1)).astype(np.int64)] = True
    return likely


def _sample_rows(lexicon: Lexicon, posterior: np.ndarray, terms: np.ndarray):
    """(p, places, times) of the windows of the training sample: the posterior of label 1, and the terms they hold."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        likely = _likely(terms)
        for batch in batches:
            for part in words.blocks(batch, "text"):
                data, limits, found = _split(part)
                windows = cut_windows(found, limits)
                window, place, times = _known_terms(windows, terms, likely)
                ends = pa.array(np.searchsorted(window, np.arange(len(windows.text) + 1)).astype(np.int32))
                held = [pa.ListArray.from_arrays(ends, pa.array(x.astype(np.int32))) for x in (place, times)]
                p = posterior[votes(data, windows, lexicon)]
                yield pa.RecordBatch.from_arrays([pa.array(p), *held], ["p", "places", "times"])

    return rows


def _labelled_terms(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(term, n1, n): how many texts of a block hold a term, and how many of these have label 1."""
    for batch in batches:
        for part in words.blocks(batch, "text"):
            text, term = _distinct(*_terms(_split(part)[2]))
            toxic = np.asarray(part.column("label")).astype(np.int64)[text]
            terms, at = np.unique(term, return_inverse=True)
            n1, n = np.bincount(at, toxic, len(terms)).astype(np.int64), np.bincount(at, minlength=len(terms))
            yield pa.RecordBatch.from_arrays(
                [pa.array(terms.view(np.int64)), pa.array(n1), pa.array(n.astype(np.int64))], ["term", "n1", "n"]
            )


def labelled(docs: DataFrame, labels: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The documents (doc_id, text) outside the held-out quarter, and the labels (of_doc, label) outside of it."""
    known = labels.select(F.col("doc_id").alias("of_doc"), F.col("toxic").cast("int").alias("label"))
    known = known.where(F.col("label").isin(0, 1) & F.col("of_doc").isNotNull() & ~held_out(F.col("of_doc")))
    known = known.groupBy("of_doc").agg(F.max("label").alias("label"))
    open_rows = docs.select("doc_id", "text").where(~held_out(F.col("doc_id")))
    return open_rows, known


def labelled_rows(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """(text, label) of all rows outside the held-out quarter that have a label."""
    open_rows, known = labelled(docs, labels)
    known = materialize(known, "toxicity-labels")
    likely = prefilter.likely(open_rows, known.select(F.col("of_doc").alias("doc_id")), "doc_id")
    found = likely.join(known, F.col("doc_id") == F.col("of_doc")).select("text", "label")
    return materialize(found, "toxicity-labelled")


def training_sample(docs: DataFrame, rows: int = TRAINING_ROWS) -> DataFrame:
    """(text) of at most ``rows`` documents outside the held-out quarter by hash of doc_id, whether they have a label or not."""
    open_rows = docs.select("doc_id", "text").where("doc_id IS NOT NULL").where(~held_out(F.col("doc_id")))
    order = F.xxhash64(F.col("doc_id"), F.lit("sample"))
    chosen = open_rows.select("doc_id").orderBy(order).limit(rows).select(F.col("doc_id").alias("of_doc"))
    chosen = materialize(chosen.dropDuplicates(["of_doc"]), "toxicity-sample")
    picked = open_rows.join(F.broadcast(chosen), F.col("doc_id") == F.col("of_doc"))  # bounded by ``rows``
    return materialize(picked.select("text"), "toxicity-training")


def mined_lexicons(have: DataFrame, voters: int = MINED_VOTERS, terms: int = MINED_TERMS) -> list[np.ndarray]:
    """Terms of the labelled rows that go with label 1 beyond chance (log-likelihood gain), dealt to voters by rank."""
    n, n1 = have.agg(F.count("*"), F.coalesce(F.sum("label"), F.lit(0))).first()
    if not n1:
        return [np.zeros(0, np.uint64) for _ in range(voters)]
    found = have.transform(words.map_texts, _labelled_terms, "term long, n1 long, n long")
    best = _best_terms(found, n1 / n, LEAST_GAIN, terms)
    return [np.array(best[v::voters], dtype=np.int64).view(np.uint64) for v in range(voters)]


def _best_terms(found: DataFrame, rate: float, least: float, terms: int) -> list[int]:
    """The terms that go with label 1 beyond chance, the largest gain first; ``found`` has (term, n1, n)."""
    each = found.groupBy("term").agg(F.sum("n1").alias("n1"), F.sum("n").alias("n"))
    share = F.least(F.col("n1") / F.col("n"), F.lit(1.0))
    other = F.when(share < 1, (F.col("n") - F.col("n1")) * F.log((1 - share) / (1 - rate))).otherwise(0.0)
    gain = 2 * (F.col("n1") * F.log(share / rate) + other)
    kept = each.where((F.col("n1") > 0) & (share > 2 * rate)).withColumn("gain", gain).where(F.col("gain") >= least)
    return [r.term for r in kept.orderBy(F.col("gain").desc(), "term").limit(terms).collect()]


@dataclass
class ToxicityModel:
    """``terms`` (sorted) that the classifier knows and their ``weights``, beside what it was fitted with."""

    lexicon: Lexicon
    labels: label_model.LabelModel
    terms: np.ndarray
    weights: np.ndarray
    intercept: float


def fit(docs: DataFrame, labels: DataFrame, rows: int = TRAINING_ROWS) -> ToxicityModel:
    """Voters, label model over all documents, classifier on the sample's posterior labels."""
    have = labelled_rows(docs, labels)
    by_voter = {0: term_hashes(INSULTS_EN), 1: term_hashes(INSULTS_OTHER)}
    by_voter |= {4 + v: terms for v, terms in enumerate(mined_lexicons(have))}
    lexicon = Lexicon.of(by_voter)

    # the rows with a known label are counted apart and taken from those that vote without one
    everyone = docs.select("text", F.lit(None).cast("int").alias("label"))
    counted = everyone.transform(words.map_texts, _vote_rows(lexicon), "key long, rows long").groupBy("key").agg(F.sum("rows").alias("rows"))
    given = have.transform(words.map_texts, _vote_rows(lexicon), "key long, rows long")
    given = given.groupBy("key").agg(F.sum("rows").alias("rows"))
    counts = np.zeros((1 << VOTERS, 3))
    for key, n in counted.collect():  # at most 3 x 2 ** VOTERS rows
        counts[key // 3, 2] += n
    for key, n in given.collect():
        counts[key // 3, key % 3] += n
        counts[key // 3, 2] -= n
    model = label_model.fit(np.maximum(counts, 0), VOTERS, [0, 1, *range(4, VOTERS)])
    return ToxicityModel(lexicon, model, *_fit_linear(training_sample(docs, rows), lexicon, model))


def _fit_linear(sample: DataFrame, lexicon: Lexicon, model: label_model.LabelModel) -> tuple[np.ndarray, np.ndarray, float]:
    rate = min(max(model.prior, 1e-4), 0.49)
    found = sample.transform(words.map_texts, _window_terms(lexicon, model.posterior), "term long, n1 double, n double")
    terms = np.sort(np.array(_best_terms(found, rate, LEAST_TERM_GAIN, TERMS), dtype=np.int64).view(np.uint64))
    size = max(1, len(terms))
    rows = sample.transform(words.map_texts, _sample_rows(lexicon, model.posterior, terms), "p double, places array<int>, times array<int>")
    if not len(terms):
        return terms, np.zeros(0), float(np.log(rate / (1 - rate)))
    # windows that hold the same terms and have the same posterior are one row
    rows = rows.groupBy("p", "places", "times").agg(F.count("*").cast("double").alias("n"))
    sparse = F.udf(lambda x, n: SparseVector(size, x, [float(k) for k in n]), VectorUDT())  # on the sample alone
    both = F.array(F.struct(F.lit(1.0).alias("y"), F.col("p").alias("w")), F.struct(F.lit(0.0).alias("y"), (1 - F.col("p")).alias("w")))
    split = rows.select("places", "times", "n", F.explode(both).alias("r")).where("r.w > 0.0005")
    split = split.select(sparse("places", "times").alias("features"), "r.y", (F.col("r.w") * F.col("n")).alias("w"))
    data = materialize(split, "toxicity-soft")
    total = data.agg(F.sum("w")).first()[0]
    learner = LogisticRegression(
        featuresCol="features", labelCol="y", weightCol="w", maxIter=60, regParam=REGULARISATION / total, standardization=False
    )
    fitted = learner.fit(data)
    return terms, fitted.coefficients.toArray(), float(fitted.intercept)


def text_scores(part: pa.RecordBatch, terms: np.ndarray, likely: np.ndarray, weights: np.ndarray, intercept: float) -> np.ndarray:
    """Per text the probability whose odds are the power mean of its windows' odds."""
    _, limits, found = _split(part)
    windows = cut_windows(found, limits)
    window, place, times = _known_terms(windows, terms, likely)
    total = np.bincount(window, weights[place] * times, len(windows.text)) + intercept
    mean = np.bincount(windows.text, np.exp(POOL * np.clip(total, -35, 35)), part.num_rows) / np.bincount(windows.text, minlength=part.num_rows)
    odds = mean ** (1 / POOL)
    return odds / (1 + odds)


def _score_rows(model: ToxicityModel, name: str):
    """All columns of a batch and their score."""
    terms, weights, intercept = model.terms, model.weights, model.intercept

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        likely = _likely(terms)
        for batch in batches:
            for part in words.blocks(batch, "text"):
                score = text_scores(part, terms, likely, weights, intercept)
                yield pa.RecordBatch.from_arrays([*part.columns, pa.array(score)], [*part.schema.names, name])

    return rows


def scored(docs: DataFrame, model: ToxicityModel, name: str) -> DataFrame:
    """``docs`` with the score of their ``text`` as column ``name`` behind the others."""
    schema = T.StructType([*docs.schema.fields, T.StructField(name, T.DoubleType())])
    return docs.transform(words.map_texts, _score_rows(model, name), schema)


def toxicity(docs: DataFrame, labels: DataFrame, rows: int = TRAINING_ROWS) -> DataFrame:
    """Per row: doc_id, held_out, score, predicted (1 from THRESHOLD on)."""
    out = scored(docs.select("doc_id", "text"), fit(docs, labels, rows), "score")
    predicted = (F.col("score") >= THRESHOLD).cast("int").alias("predicted")
    return out.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", predicted)


def accepted(docs: DataFrame, labels: DataFrame, rows: int = TRAINING_ROWS) -> DataFrame:
    """The documents scored below THRESHOLD, with their columns."""
    name = "score" + "_" * max(map(len, docs.columns))  # no column has that name
    out = scored(docs, fit(docs, labels, rows), name)
    return out.where(F.col(name) < THRESHOLD).drop(name)
