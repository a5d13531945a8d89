"""Quality classifier: a weak-label model over overlapping heuristic labellers, then a hashed linear scorer.

Labellers look at a text's words and vote good, bad or nothing. Expectation-maximisation estimates the share of bad texts
and each labeller's accuracies from the patterns of votes of all texts (a table of counts, bounded by the number of
patterns, is all that leaves Spark). The posterior of a pattern is the soft label of its texts. A linear scorer over hashed
features of the words is trained on a bounded sample of texts with these labels, and scores every text.

There are two such models of the same kind: `junk` (markup and symbol noise, shouting, tables, repetition), which uses no
given labels, and `toxic`, whose labellers are word lists: a fixed one of common insults and lists that are learned from
bounded samples of labelled texts. A text is kept when neither scorer rejects it.
"""

from __future__ import annotations

import itertools
import re
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import common
from .common import stored

DIM = 1 << 18
CACHED = 600_000
SAMPLE = 6_000  # texts that train the scorers
LABELLED = 12_000  # labelled texts that the toxic word lists are learned from
GOOD, BAD, NONE = 0, 1, 2
RUN = np.uint64(0x9E3779B97F4A7C15)  # any odd number
EDGE = b".,;:!?\"'()#$%&*|-"

# Frequent function words of four languages, and common insults.
FUNCTION_WORDS = frozenset(
    b"the of and to in a is that for it was on are as with be this by from at or an have not but "
    b"der die und das den von zu mit sich des auf ist im dem nicht ein eine als auch es an er so dass "
    b"de la le et les des en un une du que est pour qui dans par plus pas au sur ne se ce il sont avec "
    b"el los que y del las por con para su al lo como mas o pero sus le ha me sin".split()
)
INSULTS = frozenset(
    b"idiot idiots moron morons stupid dumb imbecile loser losers scum trash garbage worthless pathetic disgusting clown clowns fool "
    b"fools filth vermin pig pigs freak freaks coward cowards liar liars ugly jerk jerks creep scumbag dimwit retard bastard bitch "
    b"asshole shit fuck fucking hate".split()
)

ODD_SIGNS = frozenset("#$%&*~^<>{}|")
SIGNS = frozenset(EDGE.decode()) - {"|"}
ODD = re.compile(rb"[#$%&*~^<>{}|]")
SYMBOLS = re.compile(rb"[#$%&*~^=<>{}|\\@]{2,}")
FLAGS = ("function", "symbol", "capital", "bar", "shout", "odd")
JUNK = 8  # labellers
CUT = re.compile(r"[^\W_]+")  # toxic lists look at runs of letters and digits
SPACED = bytes.maketrans(b".,", b"  ")


class Words(dict):
    """Word -> number of its facts: two hashed features, a hash, FLAGS, and one flag per list of toxic words. Forgets all when
    full; nothing that leaves a worker depends on the numbers."""

    def __init__(self, lists: tuple[frozenset, ...]) -> None:
        super().__init__()
        self.lists = lists
        self.rows = np.zeros((1 << 12, 2), np.int32)
        self.hashes = np.zeros(1 << 12, np.uint64)
        self.flags = np.zeros((1 << 12, len(FLAGS) + len(lists)), bool)

    def __missing__(self, word: bytes) -> int:
        n = len(self)
        if n == len(self.rows):
            self.rows = np.concatenate((self.rows, np.zeros_like(self.rows)))
            self.hashes = np.concatenate((self.hashes, np.zeros_like(self.hashes)))
            self.flags = np.concatenate((self.flags, np.zeros_like(self.flags)))
        self.hashes[n] = xxhash.xxh64_intdigest(word)
        flags = self.flags[n]
        flags[:] = False
        text = word.decode()
        sign = text[-1]
        plain = text if sign.isalpha() else text[:-1]
        if plain.isalpha() and plain.islower() and (plain is text or sign in SIGNS):  # most words: letters and one sign at most
            core = word if plain is text else word[:-1]
            self.rows[n] = hashed(b"w" + core), hashed_shape("a" if plain is text else "a" + sign)
            flags[0] = core in FUNCTION_WORDS
            flags[5] = sign in ODD_SIGNS
            for i, listed in enumerate(self.lists, len(FLAGS)):
                flags[i] = core in listed
        else:
            core, cut = core_of(word), cut_words(text)
            capital = len(core) > 1 and text.upper() == text and text.lower() != text
            self.rows[n] = hashed(b"w" + core), hashed_shape(shape(text))
            flags[: len(FLAGS)] = (core in FUNCTION_WORDS, bool(SYMBOLS.search(word)), capital, word in (b"|", b"||"), word.endswith(b"!!"), bool(ODD.search(word)))
            flags[len(FLAGS) :] = [not listed.isdisjoint(cut) for listed in self.lists]
        self[word] = n
        return n


def worker_words(lists: tuple[frozenset, ...]) -> Words:
    """The facts known to this Python worker, kept over its tasks."""
    return common.held_by_worker(("facts", lists), lambda: Words(lists))


def core_of(word: bytes) -> bytes:
    return word.lower().strip(EDGE)


def cut_words(text: str) -> list[bytes]:
    """The words that toxic lists hold and meet: lower-cased, cut at whatever isn't a letter or digit."""
    return [w.encode() for w in CUT.findall(text.lower())]


def hashed(name: bytes) -> int:
    return xxhash.xxh32_intdigest(name) % DIM


@lru_cache(maxsize=1 << 14)
def hashed_shape(shape: str) -> int:
    return hashed(b"s" + shape.encode())


@lru_cache(maxsize=1 << 10)
def hashed_mark(kind: str, number: int, value: int) -> int:
    return hashed(f"{kind}{number}.{value}".encode())


def shape(word: str) -> str:
    """Letters to a or A, digits to 0, other signs kept; runs become one."""
    kinds = ("A" if c.isupper() else "a" if c.isalpha() else "0" if c.isdigit() else c for c in word)
    return "".join(k for k, _ in itertools.groupby(kinds))


@dataclass
class Facts:
    """What labellers judge a text by."""

    n: int
    share: np.ndarray  # of FLAGS among the words
    hits: np.ndarray  # words on each toxic list
    again: float  # words equal to the one before
    same: float  # runs of four words that occurred before
    features: np.ndarray  # two hashed features of each distinct word, in ascending order


def facts_of(text: bytes, words: Words, featured: bool = True) -> Facts:
    found = text.translate(None, b".,").split()  # no labeller for junk looks at stops and commas
    apart = text.translate(SPACED).split()
    if len(words) >= CACHED:
        words.clear()
    n = len(found)
    if not n:
        return Facts(0, np.zeros(len(FLAGS)), np.zeros(len(words.lists), np.int64), 0.0, 0.0, np.zeros(0, np.int32))
    own = np.fromiter(map(words.__getitem__, found), np.int64, n)
    flags = words.flags[own]
    hits = flags[:, len(FLAGS) :].sum(axis=0)
    if len(apart) > n:  # a stop or comma inside a word parts words for the toxic lists
        hits = words.flags[np.fromiter(map(words.__getitem__, apart), np.int64, len(apart)), len(FLAGS) :].sum(axis=0)
    again = float((own[1:] == own[:-1]).mean()) if n > 1 else 0.0
    same = 0.0
    if n > 8:
        h = words.hashes[own]
        four = ((h[:-3] * RUN + h[1:-2]) * RUN + h[2:-1]) * RUN + h[3:]
        four.sort()
        same = float((four[1:] == four[:-1]).sum() / len(four))
    features = words.rows[0]
    if featured:
        own.sort()
        features = words.rows[own[np.append(True, own[1:] != own[:-1])]].ravel()
        features.sort()
    return Facts(n, flags.sum(axis=0)[: len(FLAGS)] / n, hits, again, same, features)


def steps_of(f: Facts) -> list[int]:
    """Hashed marks of the shares, in steps."""
    return [hashed_mark("r", i, int(min(10, 20 * x))) for i, x in enumerate((*f.share.tolist(), f.again, f.same))]


def marks_of(votes: tuple[int, ...]) -> list[int]:
    """Hashed marks of the votes themselves."""
    return [hashed_mark("v", i, v) for i, v in enumerate(votes)]


def linear(weights: np.ndarray, features: np.ndarray, marks: list[int]) -> float:
    """Words and shapes, together of length one, and marks of value one, under weights whose last is the bias."""
    return float(weights[features].sum() / np.sqrt(max(len(features), 1)) + weights[marks].sum() + weights[-1])


def junk_votes(f: Facts) -> tuple[int, ...]:
    """Votes of the labellers for junk; short texts get none."""
    function, symbol, capital, bar, shout, odd = f.share

    def vote(value: float, good: float, bad: float, least: int = 4) -> int:
        return NONE if f.n < least else BAD if value > bad else GOOD if value < good else NONE

    return (
        vote(symbol, 0.02, 0.1), vote(odd, 0.03, 0.15), vote(capital, 0.15, 0.4), vote(shout, 0.02, 0.1),
        vote(f.again, 0.05, 0.12, 25), vote(f.same, 0.1, 0.35, 40), vote(bar, 0.02, 0.1), vote(-function, -0.12, -0.04, 20),
    )


def pattern(votes: tuple[int, ...]) -> int:
    return sum(v * 3**i for i, v in enumerate(votes))


def votes_of(number: int, n: int) -> tuple[int, ...]:
    return tuple(number // 3**i % 3 for i in range(n))


@dataclass(frozen=True)
class LabelModel:
    """Posterior of bad for each pattern of votes, and what it was computed from."""

    prior: float
    table: np.ndarray  # labeller, class (good, bad), vote (good, bad)
    posterior: dict[int, float]


def estimate(counts: dict[int, int], labellers: int, rounds: int = 200, smooth: float = 1.0) -> LabelModel:
    """Expectation-maximisation for labellers that are independent given the class. Starts from a majority of votes in
    which one bad vote outweighs silence, so the second class is the one that labellers call bad."""
    if not counts:
        return LabelModel(0.0, np.full((labellers, 2, 2), 0.5), {})
    keys = sorted(counts)
    votes = np.array([votes_of(k, labellers) for k in keys])
    weight = np.array([counts[k] for k in keys], float)
    bad = np.where((votes == BAD).any(axis=1), 0.9, 0.02)
    shown = np.stack([votes == v for v in (GOOD, BAD)], axis=2).astype(float)  # pattern, labeller, vote; silence says nothing
    for _ in range(rounds):
        prior = float((bad * weight).sum() / weight.sum())
        table = np.stack([np.einsum("p,plv->lv", c * weight, shown) + smooth for c in (1 - bad, bad)], axis=1)
        table /= table.sum(axis=2, keepdims=True)
        logs = np.einsum("plv,lcv->pc", shown, np.log(table)) + np.log(np.clip([1 - prior, prior], 1e-9, 1))
        new = 1 / (1 + np.exp(np.clip(logs[:, 0] - logs[:, 1], -500, 500)))
        if np.abs(new - bad).max() < 1e-9:
            break
        bad = new
    return LabelModel(prior, table, dict(zip(keys, bad.tolist())))


def train_linear(
    words: np.ndarray, sizes: np.ndarray, marks: np.ndarray, labels: np.ndarray, rounds: int = 200, rate: float = 1.0, decay: float = 1e-4
) -> np.ndarray:
    """Logistic regression on soft labels by gradient descent with momentum; both classes have equal mass. Last: the bias.

    words: the texts' word features one after the other, `sizes` of them each; marks: a row a text.
    """
    w = np.zeros(DIM + 1)
    if not len(sizes):
        return w
    scale = 1 / np.sqrt(np.maximum(sizes, 1))
    filled = np.flatnonzero(sizes)
    starts = (np.cumsum(sizes) - sizes)[filled]
    good, bad = 2 * max((1 - labels).sum(), 1.0), 2 * max(labels.sum(), 1.0)
    own, bias, speed, drift = np.zeros(DIM), 0.0, np.zeros(DIM), 0.0
    for _ in range(rounds):
        z = own[marks].sum(axis=1) + bias
        if len(filled):
            z[filled] += np.add.reduceat(own[words], starts) * scale[filled]
        p = 1 / (1 + np.exp(-np.clip(z, -30, 30)))
        error = p * (1 - labels) / good - (1 - p) * labels / bad  # a soft label pulls to either class by its share
        slope = np.bincount(words, np.repeat(error * scale, sizes), DIM) + np.bincount(marks.ravel(), np.repeat(error, marks.shape[1]), DIM)
        speed = 0.9 * speed - rate * 0.1 * (slope + decay * own)
        drift = 0.9 * drift - rate * 0.1 * error.sum()
        own, bias = own + speed, bias + drift
    w[:-1], w[-1] = own, bias
    return w


@dataclass(frozen=True)
class Model:
    lists: tuple[frozenset, ...]  # toxic words: the fixed list, then learned ones
    junk: LabelModel
    toxic: LabelModel
    junk_weights: np.ndarray
    toxic_weights: np.ndarray


def toxic_votes(f: Facts) -> tuple[int, ...]:
    """A list votes bad on a word of the fixed list or two of a learned one, and good on a text of some length without any.
    One learned word alone says nothing: it may stand in a clean text by chance."""
    return tuple(BAD if hits > (at > 0) else NONE if hits or f.n < 3 else GOOD for at, hits in enumerate(f.hits.tolist()))


def bounded(df: DataFrame, key: str, most: int) -> DataFrame:
    """At most `most` rows, the same whatever the partitioning: those with the smallest hashes of the key."""
    return df.where(F.col(key).isNotNull()).orderBy(F.xxhash64(F.lit("sample"), F.col(key)), key).limit(most)


def toxic_lists(df: DataFrame, labels: DataFrame, key: str, text: str, most: int = LABELLED, ratio: float = 20.0, shortest: int = 3) -> tuple[frozenset, ...]:
    """Two lists of words (of `shortest` letters or more) that each half of a bounded sample of labelled texts has far more
    often in toxic texts.

    Words are counted in Spark; the driver gets those in a fiftieth or more of the toxic texts and `ratio` times as often there,
    at most fifty times as many as a toxic text has distinct words.
    """
    wanted = labels.where(F.col("toxic").isNotNull()).groupBy(F.col(key).cast("long").alias("key")).agg(F.max("toxic").cast("int").alias("toxic"))
    picked = stored(bounded(wanted, "key", most), "toxic-sample")
    rows = df.select(F.col(key).cast("long").alias("key"), F.col(text).alias("text")).join(F.broadcast(picked), "key")
    rows = rows.select(F.pmod(F.xxhash64("key"), F.lit(2)).cast("int").alias("half"), "toxic", "text")
    schema = pa.schema([("half", pa.int32()), ("toxic", pa.int32()), ("word", pa.binary())])

    def run(batches: common.Batches) -> common.Batches:
        for batch in batches:
            for half, toxic, t in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), common.utf8(batch, "text")):
                own = sorted({c for c in cut_words(t.decode()) if len(c.decode()) >= shortest})
                yield common.batch_of(schema, [[half] * (len(own) + 1), [toxic] * (len(own) + 1), [b"", *own]])  # the empty word counts texts

    counts = rows.mapInArrow(run, "half int, toxic int, word binary").groupBy("half", "word").agg(
        F.sum("toxic").alias("bad"), F.sum(1 - F.col("toxic")).alias("good")
    )
    counts = stored(counts.where("bad > 0 OR word = X''"), "toxic-words")
    texts = {r.half: (r.bad, r.good) for r in counts.where("word = X''").collect()}
    lists = []
    for half in (0, 1):
        bad, good = texts.get(half, (0, 0))
        lift = ((F.col("bad") + 0.5) / (bad + 1)) / ((F.col("good") + 0.5) / (good + 1))
        found = counts.where((F.col("half") == half) & (F.col("bad") >= max(3, 0.02 * bad)) & (lift >= ratio) & (F.length("word") > 0))
        lists.append(frozenset(bytes(r.word) for r in found.select("word").collect()))
    return tuple(lists)


def vote_table(df: DataFrame, lists: tuple[frozenset, ...], key: str, text: str) -> DataFrame:
    """key, junk, toxic: the numbers of each text's patterns of votes."""
    schema = pa.schema([("key", pa.int64()), ("junk", pa.int64()), ("toxic", pa.int64())])

    def run(batches: common.Batches) -> common.Batches:
        words = worker_words(lists)
        for batch in common.slices(batches):
            found = [facts_of(t, words, featured=False) for t in common.utf8(batch, "text")]
            yield common.batch_of(schema, [batch.column(0), [pattern(junk_votes(f)) for f in found], [pattern(toxic_votes(f)) for f in found]])

    return df.select(F.col(key).cast("long").alias("key"), F.col(text).alias("text")).mapInArrow(run, "key long, junk long, toxic long")


def trained(blocks: list[list[np.ndarray]], models: list[LabelModel], lists: int) -> list[np.ndarray]:
    """Weights of both scorers from the blocks of sampled texts. The order of rows and blocks doesn't matter."""
    if not blocks:
        return [np.zeros(DIM + 1) for _ in models]
    order, votes, sizes, steps, words = (np.concatenate([b[i] for b in blocks]) for i in range(5))
    blocks.clear()
    votes, steps = votes.reshape(-1, 2), steps.reshape(len(order), -1)
    by = np.lexsort((votes[:, 1], votes[:, 0], order))
    starts = np.cumsum(sizes) - sizes
    words = np.concatenate([words[starts[i] : starts[i] + sizes[i]] for i in by.tolist()])
    votes, sizes, steps = votes[by], sizes[by], steps[by]
    found = []
    for which, model in enumerate(models):
        patterns, back = np.unique(votes[:, which], return_inverse=True)
        marks = np.array([marks_of(votes_of(p, JUNK if which == 0 else lists)) for p in patterns.tolist()], np.int32)[back]
        labels = np.array([model.posterior.get(p, model.prior) for p in patterns.tolist()])[back]
        found.append(train_linear(words, sizes, np.append(steps, marks, axis=1), labels))
    return found


def fit(df: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text", sample: int = SAMPLE, labelled: int = LABELLED) -> Model:
    """Label models from the votes of all texts; scorers from a sample of at most `sample` texts; toxic lists from at most
    `labelled` labelled ones. Null texts count as empty; labels of unknown keys and null labels are left out."""
    lists = (INSULTS, *toxic_lists(df, labels, key, text, labelled))
    votes = stored(vote_table(df, lists, key, text), "votes")
    models = [
        estimate({r[0]: r[1] for r in votes.groupBy(name).count().collect()}, n) for name, n in (("junk", JUNK), ("toxic", len(lists)))
    ]
    picked = stored(bounded(votes.groupBy("key").agg(F.min("junk").alias("junk"), F.min("toxic").alias("toxic")), "key", sample), "scorer-sample")
    rows = df.select(F.col(key).cast("long").alias("key"), F.col(text).alias("text")).join(F.broadcast(picked), "key")
    schema = pa.schema([(n, pa.binary()) for n in ("order", "votes", "sizes", "steps", "words")])

    def run(batches: common.Batches) -> common.Batches:
        """One block for each task: per text a hash, patterns, steps and the word features."""
        words, order, votes, steps, features = worker_words(lists), [], [], [], []
        for batch in common.slices(batches):
            for junk, toxic, t in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist(), common.utf8(batch, "text")):
                f = facts_of(t, words)
                order.append(xxhash.xxh64_intdigest(t))
                votes.append((junk, toxic))
                steps.append(steps_of(f))
                features.append(f.features)
        if order:
            sizes = np.fromiter(map(len, features), "<i4", len(features))
            parts = (np.array(order, "<u8"), np.array(votes, "<i8"), sizes, np.array(steps, "<i4"), np.concatenate(features).astype("<i4"))
            yield common.batch_of(schema, [[x.tobytes()] for x in parts])

    sent = rows.select("key", "junk", "toxic", "text").mapInArrow(run, "order binary, votes binary, sizes binary, steps binary, words binary")
    blocks = [[np.frombuffer(x, kind) for x, kind in zip(r, ("<u8", "<i8", "<i4", "<i4", "<i4"))] for r in sent.collect()]
    weights = trained(blocks, models, len(lists))
    return Model(lists, *models, *weights)


class Scorer:
    """Scores texts inside one worker."""

    def __init__(self, model: Model):
        self.model, self.words = model, worker_words(model.lists)

    def score(self, text: bytes) -> tuple[float, float, float, float]:
        """Probabilities of junk and toxic by the scorers, then the label models' posteriors."""
        m, f = self.model, facts_of(text, self.words)
        votes = junk_votes(f), toxic_votes(f)
        steps = steps_of(f)
        own = [linear(w, f.features, steps + marks_of(v)) for w, v in zip((m.junk_weights, m.toxic_weights), votes)]
        labels = [x.posterior.get(pattern(v), x.prior) for x, v in zip((m.junk, m.toxic), votes)]
        return (*(float(1 / (1 + np.exp(-np.clip(z, -500, 500)))) for z in own), *labels)


def scores(df: DataFrame, model: Model, key: str = "doc_id", text: str = "text") -> DataFrame:
    """key, junk_score, toxic_score, junk_label, toxic_label (posteriors), kept of each row.

    Null and empty texts get no votes and the scorers' base scores; repeated rows give one row each; an empty table none. Texts
    of any length are read in whole, one at a time; columns of df other than key and text are not read.
    """
    sent = df.sparkSession.sparkContext.broadcast(model)
    names = ("junk_score", "toxic_score", "junk_label", "toxic_label")
    schema = pa.schema([("key", pa.int64()), *((n, pa.float64()) for n in names), ("kept", pa.bool_())])

    def run(batches: common.Batches) -> common.Batches:
        scorer = Scorer(sent.value)
        for batch in common.slices(batches):
            found = [scorer.score(t) for t in common.utf8(batch, "text")]
            columns = [list(x) for x in zip(*found)] or [[]] * 4
            yield common.batch_of(schema, [batch.column(0), *columns, [max(x[:2]) < 0.5 for x in found]])

    rows = df.select(F.col(key).cast("long").alias("key"), F.col(text).alias("text"))
    return rows.mapInArrow(run, "key long, junk_score double, toxic_score double, junk_label double, toxic_label double, kept boolean")


def keep(df: DataFrame, model: Model, text: str = "text") -> DataFrame:
    """The rows of df that neither scorer rejects, with all their columns, in one narrow pass."""
    sent = df.sparkSession.sparkContext.broadcast(model)

    def run(batches: common.Batches) -> common.Batches:
        scorer = Scorer(sent.value)
        for batch in common.slices(batches):
            yield batch.filter(pa.array([max(scorer.score(t)[:2]) < 0.5 for t in common.utf8(batch, text)], pa.bool_()))

    return df.mapInArrow(run, df.schema)
