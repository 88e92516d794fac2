"""Toxicity scores from a learned lexicon, met by Levenshtein automata, and the words around each hit.

The lexicon holds words and stems (``word*``) that occur in far more toxic than clean documents. It is a trie; a token's automaton
(bit-parallel, one mask per number of edits) walks it and so finds the terms that the token equals, begins with or
misspells. What a hit counts depends on its edits and on its context: a hit within quotation marks counts less, and words
that stand around hits in clean rather than toxic documents (learned as well) speak against it. A logistic model over
sums of hits gives the score.

Learning takes at most ``SAMPLE`` labelled documents of each class, those whose ids hash least, weighted up to all
labelled ones; equal texts count once. Their words are counted by Spark; the lexicon and the context words are bounded
(``LEXICON``, ``CUES``), as is what comes to the driver for the model: one row of numbers per sampled document. Scoring reads
the documents where they lie, without a shuffle; texts are never cut.

Defined results: null and empty texts, and texts without hits, get the score of a text without hits; a document with
several labels is toxic if one says so; null labels and null ids teach nothing; without both classes in the labels the score is the
share of toxic labels (0.5 without labels). Repeated rows are each scored; other columns pass through, existing columns of
the result's names are replaced.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterable, Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from forecourt.llm.common import documents, drop_names, written

SAMPLE = 20_000  # labelled documents of each class that are learned from, at most
LEXICON = 200  # terms, those that tell most
LEAST_SHARE = 0.05  # of the best term's log-likelihood ratio; words of a few near copies of one text stay below
CUES = 500  # context words, those that tell most
STEMS = range(4, 9)  # letters of a stem
LEAST_ODDS = 2.0  # log odds of a term
LEAST_GAIN = 8.0  # besides twice the logarithm of the number of candidates, for its log-likelihood ratio
WINDOW = 6  # words on both sides of a hit
QUOTED = 0.4  # what a hit within quotation marks counts
ONE_EDIT, TWO_EDITS = 5, 10  # letters of a token from which so many edits are allowed
DISCOUNT = (1.0, 0.7, 0.5)  # what a hit counts by its edits
CACHED = 1 << 18  # tokens a worker remembers
COUNTED = 1 << 18  # words that a task adds up before it hands them on

_TOKEN = re.compile(r"[^\W_](?:[^\W_]|[@$])*")
_LETTERS = str.maketrans("013457@$", "oieastas")
_QUOTES = re.compile(r"\"[^\"\n]{1,400}\"|“[^”\n]{1,400}”|„[^“”\n]{1,400}[“”]|«[^»\n]{1,400}»|»[^«\n]{1,400}«")


def tokens(text: str) -> list[str]:
    return _TOKEN.findall(text.lower())


def plain(token: str) -> str:
    """Digits and signs that stand for letters replaced, unless the token has no letter beside them."""
    return token if token.isalpha() or token.isdecimal() else token.translate(_LETTERS)


class Trie:
    """Terms with their weights; a term that ends in ``*`` is a stem.

    Most tokens are far from all terms. Of a term cut into one piece more than it may have edits, one must stand
    unchanged near its place, so tokens without such a piece are passed over before the automaton walks.
    """

    def __init__(self, weights: dict[str, float]):
        self.root: dict = {}
        self.pieces: dict[tuple[int, int], set[str]] = {}
        self.reach = max((len(t) for t in weights), default=0) + 3  # no letter behind it matters
        for term, weight in weights.items():
            node, stem = self.root, term.endswith("*")
            for letter in term.removesuffix("*"):
                node = node.setdefault(letter, {})
            node["*" if stem else "."] = (weight, term)
            self._add_pieces(term.removesuffix("*"), stem)

    def _add_pieces(self, word: str, stem: bool) -> None:
        m = len(word)
        budget = min(2, m // (ONE_EDIT + 1)) if stem else 0 if m < ONE_EDIT - 1 else 1 if m < TWO_EDITS - 2 else 2
        cuts = [m * i // (budget + 1) for i in range(budget + 2)]
        for a, b in zip(cuts, cuts[1:], strict=False):
            for at in range(max(0, a - budget), a + budget + 1):
                self.pieces.setdefault((at, at + b - a), set()).add(word[a:b])

    def near(self, token: str) -> bool:
        for (a, b), pieces in self.pieces.items():
            if token[a:b] in pieces:
                return True
        return False

    def matches(self, token: str, edits: int) -> list[tuple[int, float, str]]:
        """(edits, weight, term) of each term within so many edits of the token, or of its beginning for a stem."""
        token = token[: self.reach]
        if not self.near(token):
            return []
        m = len(token)
        masks: dict[str, int] = {}
        for i, letter in enumerate(token):
            masks[letter] = masks.get(letter, 0) | 1 << i
        everything, end = (1 << m + 1) - 1, 1 << m
        found = []
        # Bit j of mask e: the path so far is within e edits of the first j letters.
        stack = [(self.root, tuple((2 << e) - 1 & everything for e in range(edits + 1)), 0)]
        while stack:
            node, state, depth = stack.pop()
            for letter, below in node.items():
                if letter in "*.":
                    for e, mask in enumerate(state):
                        if mask & end if letter == "." else mask >> max(1, depth - e):
                            # A stem must be long enough for its edits.
                            if letter == "." or depth >= ONE_EDIT * e + e:
                                found.append((e, *below))
                            break
                    continue
                own = masks.get(letter, 0)
                new = [(state[0] & own) << 1]
                for e in range(1, edits + 1):
                    new.append(((state[e] & own) << 1 | state[e - 1] | state[e - 1] << 1 | new[e - 1] << 1) & everything)
                if new[-1]:
                    stack.append((below, tuple(new), depth + 1))
        return found


@dataclass
class Lexicon:
    """Weights of terms and context words, and tokens that are no misspellings although they look like it."""

    terms: dict[str, float]
    cues: dict[str, float] = field(default_factory=dict)
    known: frozenset = frozenset()

    def __post_init__(self):
        self.trie = Trie(self.terms)
        self.cache: dict[str, tuple[float, str, int] | None] = {}

    def __getstate__(self):
        return self.terms, self.cues, self.known

    def __setstate__(self, state):
        self.terms, self.cues, self.known = state
        self.__post_init__()

    def look_up(self, token: str) -> tuple[float, str, int] | None:
        """What a token counts, the term it stands for, and its edits."""
        word = plain(token)
        allowed = 0 if len(word) < ONE_EDIT or word in self.known else 1 if len(word) < TWO_EDITS else 2
        hits = [(weight * DISCOUNT[e], term, e) for e, weight, term in self.trie.matches(word, allowed)]
        return max(hits, key=lambda h: (h[0], -h[2], h[1]), default=None)

    def hit(self, token: str) -> tuple[float, str, int] | None:
        if token not in self.cache:
            if len(self.cache) >= CACHED:
                self.cache.clear()
            self.cache[token] = self.look_up(token)
        return self.cache[token]

    def hits(self, text: str) -> tuple[int, list[tuple[float, str, int, bool, list[str]]]]:
        """The number of words, and of each hit: weight, term, edits, whether quoted, and the words around it."""
        words = tokens(text)
        wanted = {w for w in set(words) if self.hit(w)}
        if not wanted:
            return len(words), []
        lowered = text.lower()
        quoted = [q.span() for q in _QUOTES.finditer(lowered)]
        out, inside = [], 0
        for i, place in enumerate(_TOKEN.finditer(lowered)):
            if place[0] not in wanted:
                continue
            while inside < len(quoted) and quoted[inside][1] <= place.start():
                inside += 1
            in_quotes = inside < len(quoted) and quoted[inside][0] <= place.start()
            out.append((*self.hit(place[0]), in_quotes, words[max(0, i - WINDOW) : i] + words[i + 1 : i + 1 + WINDOW]))
        return len(words), out

    def features(self, text: str) -> list[float]:
        n, hits = self.hits(text)
        strongest: dict[str, float] = {}
        total = quoted = context = 0.0
        for weight, term, _, in_quotes, around in hits:
            counts = weight * (QUOTED if in_quotes else 1.0)
            strongest[term] = max(strongest.get(term, 0.0), counts)
            total += counts
            quoted += in_quotes
            cues = [self.cues[w] for w in around if w in self.cues]
            context += sum(cues) / len(cues) if cues else 0.0
        m = max(1, len(hits))
        return [
            max(strongest.values(), default=0.0),
            math.log1p(sum(strongest.values())),
            math.log1p(100.0 * total / (n + 20)),
            quoted / m,
            context / m,
        ]


N_FEATURES = 5


def chosen_terms(counts: Iterable[tuple[str, float]], most: int) -> dict[str, float]:
    """Up to ``most`` of (term, weight), best first, without those that a chosen stem covers and stems of a
    chosen term that tells as much."""
    out: dict[str, float] = {}
    for term, weight in counts:
        word = term.removesuffix("*")
        covered = any(out.get(f"{word[:k]}*", 0.0) >= weight - 1.0 for k in STEMS if k < len(word) or (k == len(word) and not term.endswith("*")))
        covered = covered or (term.endswith("*") and any(t.startswith(word) and w >= weight for t, w in out.items()))
        if not covered:
            out[term] = weight
            if len(out) == most:
                break
    return out


def train_fold(doc_id: Column) -> Column:
    return F.crc32(doc_id.cast("string")) % 5


def labelled_sample(docs: DataFrame, labels: DataFrame, id_col: str, text_col: str, sample: int) -> tuple[DataFrame, dict[int, int]]:
    """Texts (each once) of sampled training documents with ``toxic``, and the number of labelled ones by class."""
    known = labels.select(F.col("doc_id").alias("id"), F.col("toxic").cast("int").alias("toxic")).filter(
        "id IS NOT NULL AND toxic IN (0, 1)"
    )
    known = known.filter(train_fold(F.col("id")) != 0).groupBy("id").agg(F.max("toxic").alias("toxic"))
    sizes = {row.toxic: row.n for row in known.groupBy("toxic").agg(F.count(F.lit(1)).alias("n")).collect()}
    parts = [known.filter(F.col("toxic") == c).orderBy(F.xxhash64("id"), "id").limit(sample) for c in (0, 1)]
    picked = parts[0].unionByName(parts[1])  # at most 2 * SAMPLE ids
    texts = docs.select(F.col(f"`{id_col}`").alias("id"), F.coalesce(F.col(f"`{text_col}`"), F.lit("")).alias("text"))
    found = texts.join(F.broadcast(picked), "id")
    return found.groupBy("text").agg(F.max("toxic").alias("toxic")), sizes


def class_counts(rows: DataFrame, words) -> DataFrame:
    """How many toxic and clean rows have each word of ``words(text, toxic)``: ``word``, ``t``, ``c``.

    A task adds up its own rows first, and hands on what it has whenever that is ``COUNTED`` words.
    """
    types = pa.schema([("word", pa.string()), ("t", pa.int64()), ("c", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = Counter(), Counter()  # clean, toxic

        def added_up() -> pa.RecordBatch:
            clean, toxic = counts
            every = [*(clean.keys() | toxic.keys())]
            out = pa.RecordBatch.from_pydict({"word": every, "t": [toxic[w] for w in every], "c": [clean[w] for w in every]}, types)
            clean.clear()
            toxic.clear()
            return out

        for batch in batches:
            for text, toxic in zip(batch.column("text").to_pylist(), batch.column("toxic").to_pylist(), strict=True):
                counts[toxic].update(words(text, toxic))
                if len(counts[0]) + len(counts[1]) >= COUNTED:
                    yield added_up()
        yield added_up()

    parts = rows.select("text", "toxic").mapInArrow(run, "word string, t bigint, c bigint")
    return parts.groupBy("word").agg(F.sum("t").alias("t"), F.sum("c").alias("c"))


def telling(counts: DataFrame, all_toxic: int, all_clean: int, most: int) -> list[tuple[str, float]]:
    """The words that tell most for toxic documents: ``(word, log odds)``, best first."""
    n = all_toxic + all_clean
    counts = written(counts, "toxicity-counts")
    candidates = max(2, counts.count())

    def part(seen: Column, expected: Column) -> Column:
        return F.when(seen > 0, seen * F.log(seen / expected)).otherwise(0.0)

    t, c = F.col("t").cast("double"), F.col("c").cast("double")
    share = (t + c) / n
    gain = 2 * (
        part(t, share * all_toxic) + part(c, share * all_clean)
        + part(all_toxic - t, (1 - share) * all_toxic) + part(all_clean - c, (1 - share) * all_clean)
    )
    odds = F.log((t + 0.5) / (all_toxic - t + 0.5)) - F.log((c + 0.5) / (all_clean - c + 0.5))
    good = counts.select("word", gain.alias("gain"), odds.alias("odds")).filter(
        (F.col("odds") >= LEAST_ODDS) & (F.col("gain") >= 2 * math.log(candidates) + LEAST_GAIN)
    )
    # Of terms with equal gain the longest comes first, which may be misspelled most.
    best = good.orderBy(F.desc(F.round("gain", 6)), F.desc(F.length(F.rtrim("word", F.lit("*")))), "word").limit(most).collect()
    return [(row.word, row.odds) for row in best if row.gain >= LEAST_SHARE * best[0].gain]


def _mapped(rows: DataFrame, function, schema: str) -> DataFrame:
    """``function(text, toxic)`` yields rows for each row of ``rows``."""
    names = [f.split()[0] for f in schema.split(", ")]
    arrow = {"string": pa.string(), "int": pa.int32(), "double": pa.float64()}
    types = pa.schema([(f.split()[0], arrow[f.split()[1]]) for f in schema.split(", ")])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for text, toxic in zip(batch.column("text").to_pylist(), batch.column("toxic").to_pylist(), strict=True):
                made = list(function(text, toxic))
                if made:
                    yield pa.RecordBatch.from_pydict(dict(zip(names, map(list, zip(*made, strict=True)), strict=True)), types)

    return rows.select("text", "toxic").mapInArrow(run, schema)


def _candidates(text: str, toxic: int) -> set[str]:
    words = {plain(w) for w in tokens(text)}
    return words | {f"{w[:k]}*" for w in words for k in STEMS if len(w) > k}


@dataclass
class Model:
    lexicon: Lexicon
    means: np.ndarray
    scales: np.ndarray
    weights: np.ndarray

    def scores(self, texts: list[str]) -> np.ndarray:
        x = np.array([self.lexicon.features(t) for t in texts], float).reshape(-1, N_FEATURES)
        z = self.weights[0] + (x - self.means) / self.scales @ self.weights[1:]
        return 1.0 / (1.0 + np.exp(-np.clip(z, -30, 30)))


def logistic(x: np.ndarray, y: np.ndarray, w: np.ndarray, ridge: float = 1.0) -> np.ndarray:
    """Weights of a logistic model, the constant first, by Newton's method."""
    x = np.hstack([np.ones((len(x), 1)), x])
    keep = np.diag([1e-6] + [ridge] * (x.shape[1] - 1))
    beta = np.zeros(x.shape[1])
    for _ in range(30):
        p = 1 / (1 + np.exp(-np.clip(x @ beta, -30, 30)))
        step = np.linalg.solve(x.T @ (x * (w * p * (1 - p))[:, None]) + keep, x.T @ (w * (y - p)) - keep @ beta)
        beta = beta + np.clip(step, -2, 2)
        if np.abs(step).max() < 1e-8:
            break
    return beta


def train(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", sample: int = SAMPLE) -> Model:
    rows, sizes = labelled_sample(docs, labels, id_col, text_col, sample)
    rows = written(rows, "toxicity-sample")
    seen = {row.toxic: row.n for row in rows.groupBy("toxic").agg(F.count(F.lit(1)).alias("n")).collect()}
    if not seen.get(0) or not seen.get(1):
        rate = min(max(seen.get(1, 0.0) / sum(seen.values()), 1e-6), 1 - 1e-6) if seen else 0.5
        return Model(Lexicon({}), np.zeros(N_FEATURES), np.ones(N_FEATURES), np.array([math.log(rate / (1 - rate))] + [0.0] * N_FEATURES))
    best = telling(class_counts(rows, _candidates), seen[1], seen[0], 20 * LEXICON)
    lexicon = Lexicon(chosen_terms(best, LEXICON))

    def near_misses(text: str, toxic: int) -> set[str]:
        words = set() if toxic else {plain(w) for w in tokens(text)}
        return {w for w in words if (hit := lexicon.hit(w)) and hit[2]}

    def around(text: str, toxic: int) -> set[str]:
        return {w for *_, words in lexicon.hits(text)[1] for w in words}

    known = class_counts(rows, near_misses).orderBy(F.desc("c"), "word").limit(100 * LEXICON)
    lexicon = Lexicon(lexicon.terms, {}, frozenset(row.word for row in known.collect()))
    clean_hits = class_counts(rows, around).select("word", F.col("c").alias("t"), F.col("t").alias("c"))
    cues = telling(clean_hits, seen[0], seen[1], CUES)
    lexicon = Lexicon(lexicon.terms, {w: -min(odds, 4.0) for w, odds in cues}, lexicon.known)
    columns = [f"f{i}" for i in range(N_FEATURES)]

    def featured(text: str, toxic: int) -> Iterator[tuple]:
        yield (*lexicon.features(text), toxic)

    table = _mapped(rows, featured, ", ".join(f"{c} double" for c in columns) + ", toxic int").toPandas()  # at most 2 * SAMPLE rows
    table = table.sort_values(table.columns.tolist())
    x, y = table[columns].to_numpy(float), table["toxic"].to_numpy(float)
    share = {c: sizes[c] / min(sizes[c], sample) for c in (0, 1)}
    means, scales = x.mean(0), x.std(0)
    scales[scales == 0] = 1.0
    return Model(lexicon, means, scales, logistic((x - means) / scales, y, np.where(y == 1, share[1], share[0])))


def score_toxicity(docs: DataFrame, model: Model, text_col: str = "text", out_col: str = "score", keep_text: bool = True) -> DataFrame:
    """``docs`` with the score (0 to 1) of each whole text."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    docs = drop_names(docs, out_col)
    at = docs.columns.index(text_col)
    kept = [i for i in range(len(docs.columns)) if keep_text or i != at]
    names = [*(docs.columns[i] for i in kept), out_col]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = ["" if t is None else t for t in batch.column(at).to_pylist()]
            scores = pa.array(shared.value.scores(texts), pa.float64())
            yield pa.RecordBatch.from_arrays([*(batch.column(i) for i in kept), scores], names)

    schema = type(docs.schema)([*(docs.schema.fields[i] for i in kept)]).add(out_col, "double")
    return docs.mapInArrow(run, schema)


def q_toxicity(spark, sf_dir):
    """Every document's score, whether it was held out from learning, and the decision at one half."""
    docs = documents(spark, sf_dir).select("doc_id", "text")
    model = train(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    scored = score_toxicity(docs, model, keep_text=False)
    return scored.select(
        "doc_id",
        F.coalesce(train_fold(F.col("doc_id")) == 0, F.lit(False)).alias("held_out"),
        "score",
        (F.col("score") >= 0.5).cast("int").alias("predicted"),
    )
