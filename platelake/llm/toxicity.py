"""Toxicity by weak supervision.

Many voters look at a text: one for each term of a lexicon (a whole word of any length, one of more than seven bytes by a hash, or a word
beginning of three to seven bytes, met at all or met often) that is mined from the labelled rows, some patterns over all of them, and the given label itself. A generative model
of two classes estimates by expectation maximisation how accurate each voter is, and from what the classes leave
unexplained how far voters repeat each other; repeated votes count less. (The lexicon is mined from the same labels and the posterior starts at
them, so voters are not independent of the given label.) A linear classifier is then trained on the
posterior labels and scores every whole text.

Counts of terms cover all labelled rows, and every term of the toxic rows is compared with the clean ones. All terms that pass are kept:
the most telling of each family of beginnings is counted by the patterns, the ``VOTERS`` most telling of these vote by themselves, and
the others reach the classifier as ``HASHED`` features. Fitting rows (``FIT_ROWS``, chosen by hash) are bounded. Language, source and id are no inputs.

Edge cases: NULL and empty texts have no votes and get the score of such texts; a document with several labels counts
as toxic if one says so; rows without a label are only scored; without any label every score is 0; equal rows are scored
each; an empty table gives an empty result; further columns, whatever their names, are not used; very long texts are looked at whole,
in a batch of their own.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from platelake.llm import bloom, spans
from platelake.llm.language_id import fold
from platelake.llm.shared import stored

PREFIXES = (3, 4, 5, 6, 7)
#: The longest word that a term holds byte by byte.
LONGEST = 7
VOTERS, HASHED, FIT_ROWS = 64, 64, 20_000
MIN_TOXIC, MIN_RATIO = 5, 20.0
DENSE, SPARSE = 0.005, 0.001
OFTEN_COUNT, OFTEN_SHARE = 2, 0.004
ROUNDS = 30
EXPLAINED = 0.01
TOXIC_FROM = 0.7

#: In a packed term: it votes only where it is frequent.
OFTEN = np.uint64(1 << 62)
#: The upper byte of a whole word's hash.
HASHED_WORD = 0x80 | (LONGEST + 1)


@dataclass
class Lexicon:
    """Packed terms, sorted; the feature that each adds to; which stand for their family."""

    terms: np.ndarray
    column: np.ndarray
    counted: np.ndarray


@dataclass
class ToxicityModel:
    """The lexicon, the weights of the linear classifier, and what the label model found."""

    lexicon: Lexicon
    weights: np.ndarray
    accuracy: np.ndarray = field(default_factory=lambda: np.zeros(0))
    correlation: np.ndarray = field(default_factory=lambda: np.zeros((0, 0)))


def packed_terms(data: np.ndarray, words: spans.Spans) -> tuple[np.ndarray, np.ndarray]:
    """Every term of each word as a number (bytes or hash, and above them length and a mark for whole words), and the word of each."""
    loads = np.ndarray((len(data) - 7,), np.dtype("<u8"), data, strides=(1,))
    value = loads[words.start] if len(words.start) else np.zeros(0, np.uint64)
    found, owner = [], []
    for n in range(1, LONGEST + 1):
        mask = np.uint64((1 << 8 * n) - 1)
        if n in PREFIXES:
            longer = np.flatnonzero(words.length > n)
            found.append((value[longer] & mask) | np.uint64(n << 56))
            owner.append(longer)
        whole = np.flatnonzero(words.length == n)
        found.append((value[whole] & mask) | np.uint64((n | 0x80) << 56))
        owner.append(whole)
    long = np.flatnonzero(words.length > LONGEST)
    own = spans.hashes(data, spans.Spans(words.start[long], words.length[long], np.array([0, len(long)])), seed=2)
    found.append((own & np.uint64((1 << 56) - 1)) | np.uint64(HASHED_WORD << 56))
    owner.append(long)
    return np.concatenate(found), np.concatenate(owner)


def term_text(term: int, head: int = 0) -> tuple[bytes, bool]:
    """The bytes of a packed term, and whether it is a whole word. Of a hashed one its ``head``, with the hash behind it."""
    n = term >> 56 & 0x0F
    if n > LONGEST:
        return head.to_bytes(8, "little")[:LONGEST] + term.to_bytes(8, "little")[:LONGEST], True
    return term.to_bytes(8, "little")[:n], bool(term >> 63)


def heads(data: np.ndarray, words: spans.Spans, terms: np.ndarray, owner: np.ndarray) -> np.ndarray:
    """The beginning of the word of each hashed term; 0 for other terms, which hold theirs."""
    loads = np.ndarray((len(data) - 7,), np.dtype("<u8"), data, strides=(1,))
    hashed = (terms & ~OFTEN) >> np.uint64(56) == HASHED_WORD
    out = np.zeros(len(terms), np.uint64)
    out[hashed] = loads[words.start[owner[hashed]]] & np.uint64((1 << 8 * LONGEST) - 1)
    return out


def is_often(count: np.ndarray, n_words: np.ndarray) -> np.ndarray:
    return (count >= OFTEN_COUNT) & (count >= OFTEN_SHARE * n_words)


def _documents_with(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """For each term how many texts of the partition hold it, and its head; the counts of several chunks are merged on the way."""
    held: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []

    def merged() -> pa.RecordBatch:
        keys, counts, begins = (np.concatenate(c) for c in zip(*held))
        own, first, inverse = np.unique(keys, return_index=True, return_inverse=True)
        total = np.bincount(inverse, weights=counts, minlength=len(own)).astype(np.int64)
        return pa.RecordBatch.from_pydict({"term": own.view(np.int64), "n": total, "head": begins[first].view(np.int64)})

    for part in spans.chunked(batches, "text"):
        texts = spans.texts_of(part.column("text"))
        found, _ = spans.lettered(texts)
        words, inverse = spans.distinct(texts, found)
        term, owner = packed_terms(texts.data, words)
        own, first, code = np.unique(term, return_index=True, return_inverse=True)
        head = heads(texts.data, words, own, owner[first])
        # The terms of each word, then those of the words of each text; a text counts once for a term.
        order = np.argsort(owner, kind="stable")
        code = code[order]
        per_word = np.bincount(owner, minlength=len(words.start))
        begin = np.cumsum(per_word) - per_word
        pair, seen = np.unique(found.owner() * max(len(words.start), 1) + inverse, return_counts=True)
        text, word = np.divmod(pair, max(len(words.start), 1))
        times = per_word[word]
        at = np.arange(times.sum()) - np.repeat(np.cumsum(times) - times, times) + np.repeat(begin[word], times)
        hits, of_hit = np.unique(np.repeat(text, times) * max(len(own), 1) + code[at], return_inverse=True)
        total = np.bincount(of_hit, weights=np.repeat(seen, times), minlength=len(hits))
        text, term = np.divmod(hits, max(len(own), 1))
        often = is_often(total, found.counts()[text])
        held.append((own, np.bincount(term, minlength=len(own)).astype(np.int64), head))
        n_often = np.bincount(term[often], minlength=len(own)).astype(np.int64)
        held.append((own[n_often > 0] | OFTEN, n_often[n_often > 0], head[n_often > 0]))
        if sum(len(k) for k, _, _ in held) > 2_000_000:
            yield merged()
            held = []
    if held:
        yield merged()


def lexicon(labelled: DataFrame) -> Lexicon:
    """Terms that tell toxic texts: far more frequent there by all labelled rows."""
    totals = {r["toxic"]: r["count"] for r in labelled.groupBy("toxic").count().collect()}
    n1, n0 = totals.get(1, 0), totals.get(0, 0)
    schema = "term long, n long, head long"
    toxic = labelled.filter("toxic = 1").select("text").mapInArrow(_documents_with, schema)
    compared = stored(toxic.groupBy("term").agg(F.sum("n").alias("n"), F.max("head").alias("head")).filter(F.col("n") >= MIN_TOXIC))
    number = compared.count()
    if not number or not n0:
        return Lexicon(np.zeros(0, np.uint64), np.zeros(0, np.int64), np.zeros(0, bool))
    clean = labelled.filter("toxic = 0").select("text").mapInArrow(_documents_with, schema)
    # Only what may be in the table is shuffled.
    likely = bloom.may_be_in(clean, F.col("term"), compared, "term", "likely").filter("likely")
    found = compared.withColumnRenamed("n", "toxic").join(likely.groupBy("term").agg(F.sum("n").alias("clean")), "term", "left").fillna(0, ["clean"])
    share = n1 / (n1 + n0)
    t, c = F.col("toxic"), F.col("clean")
    ratio = ((t + 0.5) / (n1 + 1)) / ((c + 0.5) / (n0 + 1))
    gain = 2 * (t * F.log(t / ((t + c) * share)) + F.when(c > 0, c * F.log(c / ((t + c) * (1 - share)))).otherwise(0.0))
    good = found.select("term", "head", ratio.alias("ratio"), gain.alias("gain")).filter((F.col("ratio") >= MIN_RATIO) & (F.col("gain") >= 2 * np.log(number) + 4))
    passed = good.select("term", "gain", "head").toArrow()
    return arranged(passed.column("term").to_numpy().view(np.uint64), passed.column("gain").to_numpy(), passed.column("head").to_numpy())


def arranged(terms: np.ndarray, gain: np.ndarray, head: np.ndarray) -> Lexicon:
    """All terms that passed; the most telling of each family of beginnings stands for it."""
    ranked = sorted(range(len(terms)), key=lambda i: (-gain[i], int(terms[i]) >> 56 & 0x0F, int(terms[i])))
    with np.errstate(over="ignore"):
        column = VOTERS + (spans.mix(terms) % np.uint64(HASHED)).astype(np.int64)
    counted = np.zeros(len(terms), bool)
    bodies: set[bytes] = set()
    beginnings: set[bytes] = set()
    for i in ranked:
        body, _ = term_text(int(terms[i]), int(head[i]))
        own = {body[:n] for n in range(1, len(body) + 1)}
        if body in beginnings or own & bodies:
            continue
        if len(bodies) < VOTERS:
            column[i] = len(bodies)
        counted[i] = True
        bodies.add(body)
        beginnings |= own
    order = np.argsort(terms)
    return Lexicon(terms[order], column[order], counted[order])


def hits(texts: spans.Texts, terms: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Text, term (its place in the sorted ``terms``) and how often it is there, wherever a term votes; the words of each text."""
    found, _ = spans.lettered(texts)
    words, inverse = spans.distinct(texts, found)
    n_words = found.counts()
    term, owner = packed_terms(texts.data, words)
    at, hit = _places(terms & ~OFTEN, term)
    order = np.argsort(owner[hit], kind="stable")
    plain = at[hit][order]
    per_word = np.bincount(owner[hit], minlength=len(words.start))
    begin = np.cumsum(per_word) - per_word
    wide, size = max(len(words.start), 1), max(len(terms), 1)
    here = per_word[inverse] > 0
    pair, seen = np.unique(found.owner()[here] * wide + inverse[here], return_counts=True)
    text, word = np.divmod(pair, wide)
    times = per_word[word]
    places = np.arange(times.sum()) - np.repeat(np.cumsum(times) - times, times) + np.repeat(begin[word], times)
    pair, of_pair = np.unique(np.repeat(text, times) * size + plain[places], return_inverse=True)
    count = np.bincount(of_pair, weights=np.repeat(seen, times), minlength=len(pair)).astype(np.int64)
    text, plain = np.divmod(pair, size)
    own = np.unique(terms & ~OFTEN)
    often = is_often(count, n_words[text])
    out = []
    for mark, keep in ((np.uint64(0), np.ones(len(text), bool)), (OFTEN, often)):
        wanted = (own[plain] if len(own) else np.zeros(0, np.uint64)) | mark
        place, has = _look_up(terms, wanted)
        out.append((text[has & keep], place[has & keep], count[has & keep]))
    return *(np.concatenate(c) for c in zip(*out)), n_words


def _look_up(held: np.ndarray, wanted: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    if not len(held):
        return np.zeros(len(wanted), np.int64), np.zeros(len(wanted), bool)
    at = np.minimum(np.searchsorted(held, wanted), len(held) - 1)
    return at, held[at] == wanted


def _places(terms: np.ndarray, wanted: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places among the different ``terms``."""
    return _look_up(np.unique(terms), wanted)


def look(texts: spans.Texts, terms: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """What each term counts in each text, and the words of each text."""
    text, term, count, n_words = hits(texts, terms)
    seen = np.zeros((len(texts), len(terms)), np.int64)
    seen[text, term] = count
    return seen, n_words


def evidence(texts: spans.Texts, found: Lexicon) -> tuple[np.ndarray, np.ndarray]:
    """For each text the counts by feature, then of all families and of different ones; the words of each text."""
    text, term, count, n_words = hits(texts, found.terms)
    seen = np.zeros((len(texts), VOTERS + HASHED + 2), np.int64)
    np.add.at(seen, (text, found.column[term]), count)
    counted = found.counted[term]
    np.add.at(seen, (text[counted], VOTERS + HASHED), count[counted])
    np.add.at(seen, (text[counted], VOTERS + HASHED + 1), 1)
    return seen, n_words


def votes(seen: np.ndarray, n_words: np.ndarray) -> np.ndarray:
    """1 toxic, -1 clean, 0 no vote: each voting term, then the patterns over all families."""
    total, kinds = seen[:, -2], seen[:, -1]
    density = total / np.maximum(n_words, 1)
    patterns = [
        np.where(density >= DENSE, 1, np.where(density < SPARSE, -1, 0)),
        np.where(kinds >= 2, 1, np.where(kinds == 0, -1, 0)),
        np.where(total >= 3, 1, np.where(total <= 1, -1, 0)),
    ]
    return np.column_stack([(seen[:, :VOTERS] > 0).astype(int), *patterns])


def label_model(cast: np.ndarray, given: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Posterior of the toxic class for each row, accuracy of each voter, correlations that the classes leave."""
    ballots = np.column_stack([cast, np.where(given == 1, 1, -1)])
    kinds = np.stack([ballots == v for v in (-1, 0, 1)]).astype(float)
    posterior = np.where(given == 1, 0.9, 0.1)
    weight = np.ones(ballots.shape[1])
    left = np.zeros((ballots.shape[1],) * 2)
    for step in range(ROUNDS):
        prior = np.clip(posterior.mean(), 1e-3, 1 - 1e-3)
        chance = np.stack([(kinds * p[None, :, None]).sum(1) + 0.1 for p in (1 - posterior, posterior)])
        chance /= chance.sum(1, keepdims=True)
        if step in (0, ROUNDS // 2):  # first by the given labels: later, copies of a voter would have bent the classes
            expected = [(p @ ballots) / max(p.sum(), 1e-9) for p in (1 - posterior, posterior)]
            rest = ballots - (1 - posterior)[:, None] * expected[0] - posterior[:, None] * expected[1]
            # Of a voter that the classes explain nothing is left that could be shared with others.
            spread = np.sqrt((rest**2).mean(0)) + EXPLAINED
            left = (rest.T @ rest) / len(rest) / np.outer(spread, spread)
            weight = 1 / (1 + (np.maximum(np.abs(left) - 0.1, 0).sum(1) - np.maximum(np.abs(np.diag(left)) - 0.1, 0)))
        log = np.log(chance[1] / chance[0]) * weight
        odds = np.log(prior / (1 - prior)) + np.einsum("vrj,vj->r", kinds, log)
        posterior = 1 / (1 + np.exp(-np.clip(odds, -50, 50)))
    spoke = np.maximum((ballots != 0).sum(0), 1)
    right = ((ballots == 1) * posterior[:, None] + (ballots == -1) * (1 - posterior)[:, None]).sum(0)
    return posterior, right / spoke, left


def features(seen: np.ndarray, n_words: np.ndarray) -> np.ndarray:
    total, kinds = seen[:, -2], seen[:, -1]
    density = 1000 * total / np.maximum(n_words, 1)
    return np.column_stack([np.log1p(seen[:, :-2]), np.log1p(total), kinds, np.log1p(density), np.ones(len(seen))])


def linear_fit(x: np.ndarray, target: np.ndarray, ridge: float = 1.0) -> np.ndarray:
    """Logistic regression on soft labels by Newton steps."""
    w = np.zeros(x.shape[1])
    penalty = np.full(x.shape[1], ridge)
    penalty[-1] = 1e-3
    for _ in range(25):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -50, 50)))
        hessian = (x * (p * (1 - p))[:, None]).T @ x + np.diag(penalty)
        step = np.linalg.solve(hessian, x.T @ (target - p) - penalty * w)
        w += np.clip(step, -5, 5)
    return w


def fit(labelled: DataFrame) -> ToxicityModel:
    """A model from rows ``doc_id, text, toxic``."""
    words = lexicon(labelled)
    parts = (words.terms, words.column, words.counted)  # workers need not know the class
    n = labelled.count()
    if not n:
        return ToxicityModel(words, np.zeros(0))
    span = 1 << 40
    chosen = labelled.filter(F.pmod(F.xxhash64("doc_id"), F.lit(span)) < F.lit(min(span, span * FIT_ROWS // n)))

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in spans.chunked(batches, "text"):
            seen, n_words = evidence(spans.texts_of(part.column("text")), Lexicon(*parts))
            yield pa.RecordBatch.from_pydict({"toxic": part.column("toxic"), "n_words": n_words, "seen": pa.array([c.astype("<i4").tobytes() for c in seen], pa.binary())})

    # The limit holds where one id has very many rows; a hash of what was seen keeps rows of all kinds.
    found = chosen.select("text", "toxic").mapInArrow(rows, "toxic int, n_words long, seen binary").orderBy(F.xxhash64("seen", "n_words"), "seen", "n_words", "toxic").limit(2 * FIT_ROWS).toArrow()
    seen = np.frombuffer(b"".join(found.column("seen").to_pylist()), "<i4").reshape(found.num_rows, VOTERS + HASHED + 2).astype(np.int64)
    n_words, given = found.column("n_words").to_numpy(), found.column("toxic").to_numpy()
    if not found.num_rows:
        return ToxicityModel(words, np.zeros(0))
    posterior, accuracy, left = label_model(votes(seen, n_words), given)
    return ToxicityModel(words, linear_fit(features(seen, n_words), posterior), accuracy, left)


def score(docs: DataFrame, model: ToxicityModel, extra: tuple[str, ...] = ()) -> DataFrame:
    """``doc_id``, further columns, and the probability that the text is toxic."""
    held = docs.sparkSession.sparkContext.broadcast((model.lexicon.terms, model.lexicon.column, model.lexicon.counted, model.weights))
    kept = ["doc_id", *extra]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        *parts, weights = held.value
        for part in spans.chunked(batches, "text"):
            seen, n_words = evidence(spans.texts_of(part.column("text")), Lexicon(*parts))
            p = 1 / (1 + np.exp(-np.clip(features(seen, n_words) @ weights, -50, 50))) if len(weights) else np.zeros(part.num_rows)
            yield pa.RecordBatch.from_arrays([*[part.column(c) for c in kept], pa.array(p)], [*kept, "score"])

    source = docs.select(*kept, F.col("text").cast("string").alias("text"))
    return source.mapInArrow(run, source.select(*kept).schema.add("score", "double"))


def toxicity(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """Every document's score; labels are learned outside the held-out fold."""
    known = labels.filter(F.col("toxic").isNotNull() & F.col("doc_id").isNotNull() & (fold(F.col("doc_id"), 3) != 1))
    marks = stored(known.groupBy(F.col("doc_id").alias("labelled_id")).agg(F.max("toxic").cast("int").alias("toxic")))
    rows = docs.filter(fold(F.col("doc_id"), 3) != 1).select("doc_id", F.col("text").cast("string").alias("text"))
    labelled = stored(bloom.matching(rows, F.col("doc_id"), marks, "labelled_id").select("doc_id", "text", "toxic"))
    model = fit(labelled)
    held = F.coalesce(fold(F.col("doc_id"), 3) == 1, F.lit(False)).alias("held_out")  # a row without an id is not held out
    scored = score(docs.select("doc_id", held, "text"), model, ("held_out",))
    return scored.withColumn("predicted", (F.col("score") >= TOXIC_FROM).cast("int"))
