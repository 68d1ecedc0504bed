"""Operator 6: language identification by cross-parsing entropy.

Each language has a suffix automaton of labelled text.  A text is parsed against it into
phrases, each the longest match of what is left (at least one letter); the language that
needs the fewest phrases, normalised by letters and by the size of its training text
(phrases * log2(size) / letters), wins.  Phrases end at word boundaries, where a
word is a run of letters with a space before and behind it: so a word's phrases are the same wherever it
stands, and each task counts them once per distinct word (a bounded memo) and sums over whole
texts.

Training takes at most ``docs_per_language`` labelled documents of each language, chosen by a hash of id and
text, at most ``DOCUMENT_LETTERS`` of each and ``letters_per_language`` of them all, so what is broadcast is bounded
by the number of languages.  Languages differ in size, and the normalisation accounts for it; a label's size changes
no other label's text.  Labels beyond the ``MAX_LANGUAGES`` most frequent are not learned.

Edge cases: a null text, or one without a letter, is ``und`` with score 0, as is everything if nothing
could be learned (``drop_unknown`` then keeps every text with a letter); ties go to the smaller language name; with one language the score is 1; null labels are never
learned; repeated rows get equal results; an empty table gives an empty result; other
columns are not read, and are kept by ``drop_unknown``.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import byte_texts, crc_rest, slices

DOCS_PER_LANGUAGE = 200
LETTERS_PER_LANGUAGE = 25_000
#: Letters that one document adds to its language's text at most.
DOCUMENT_LETTERS = 2_000
#: A phrase costs at least the logarithm of this size: in a tiny text every letter is a phrase, and would be a cheap one.
LEAST_SIZE = 2_000
MEMO_ENTRIES = 200_000
#: Languages learned at most, the most frequent first (bounds the thresholds sent to the executors).
MAX_LANGUAGES = 500
UNKNOWN = "und"
LETTERS = regex.compile(r"\p{L}[\p{L}\p{M}]*")
#: ASCII other than letters ends a word, so it may as well be a space; A-Z lowered in the same pass.
PLAIN = bytes(c + 32 if 65 <= c <= 90 else c if 97 <= c <= 122 or c >= 128 else 32 for c in range(256))


class SuffixAutomaton:
    """All substrings of a text: ``next[state][letter]`` is the state after the letter."""

    def __init__(self, text: str):
        self.next: list[dict[str, int]] = [{}]
        link, length, last = [-1], [0], 0
        for c in text:
            new = len(self.next)
            self.next.append({})
            length.append(length[last] + 1)
            link.append(0)
            at = last
            while at >= 0 and c not in self.next[at]:
                self.next[at][c] = new
                at = link[at]
            if at >= 0:
                to = self.next[at][c]
                if length[to] == length[at] + 1:
                    link[new] = to
                else:
                    copy = len(self.next)
                    self.next.append(dict(self.next[to]))
                    length.append(length[at] + 1)
                    link.append(link[to])
                    link[to] = link[new] = copy
                    while at >= 0 and self.next[at].get(c) == to:
                        self.next[at][c] = copy
                        at = link[at]
            last = new

    def phrases(self, text: str) -> int:
        """Phrases of the greedy longest-match parse; a letter without a match is a phrase."""
        step, n, state, inside = self.next, 0, 0, False
        for c in text:
            to = step[state].get(c)
            if to is None:
                n += inside
                to = step[0].get(c)
                if to is None:  # a phrase of its own
                    n, state, inside = n + 1, 0, False
                    continue
            state, inside = to, True
        return n + inside


def words(text: str) -> list[str]:
    return LETTERS.findall(text.lower())


class Parser:
    """Phrase counts of chunks against every language, kept in a table."""

    def __init__(self, training: dict[str, str]):
        self.names = sorted(training)
        self.automata = [SuffixAutomaton(training[n]) for n in self.names]
        self.weight = np.array([math.log2(max(LEAST_SIZE, len(training[n]))) for n in self.names])
        self._clear()

    def _clear(self) -> None:
        self.memo: dict[bytes, int] = {}
        self.table = np.zeros((1 << 14, len(self.names) + 1), np.int64)

    def _row(self, chunk: bytes) -> None:
        """Letters, and phrases per language, of a white-space free chunk."""
        i = self.memo[chunk] = len(self.memo)
        if i >= len(self.table):
            self.table = np.concatenate([self.table, np.zeros_like(self.table)])
        for w in words(chunk.decode()):
            self.table[i, -1] += len(w)
            for k, a in enumerate(self.automata):
                self.table[i, k] += a.phrases(f" {w} ")

    def totals(self, texts: list[bytes | None]) -> Iterator[np.ndarray]:
        """Phrases per language, then letters, of each text."""
        if len(self.memo) > MEMO_ENTRIES:
            self._clear()
        split = [(t or b"").translate(PLAIN).split() for t in texts]
        for c in set().union(*split).difference(self.memo):
            self._row(c)
        for chunks in split:
            yield self.table[[self.memo[c] for c in chunks]].sum(0) if chunks else np.zeros(len(self.names) + 1)

    def batch(self, texts: list[bytes | None]) -> list[tuple[str, float]]:
        """(language, score) of each text; the score is 1 - best entropy / second best."""
        out = []
        for total in self.totals(texts):
            if not total[-1] or not self.names:
                out.append((UNKNOWN, 0.0))
                continue
            entropy = total[:-1] * self.weight / total[-1]
            best = int(entropy.argmin())
            rest = np.delete(entropy, best)
            out.append((self.names[best], float(1 - entropy[best] / rest.min()) if len(rest) and rest.min() > 0 else 1.0))
        return out


def training_texts(learn: DataFrame, docs: int = DOCS_PER_LANGUAGE, letters: int = LETTERS_PER_LANGUAGE,
                   id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang") -> dict[str, str]:
    """Training text of each language: words of a bounded, hash-chosen sample of its documents."""
    learn = learn.where(F.col(text_col).isNotNull() & F.col(lang_col).isNotNull())
    counts = learn.groupBy(lang_col).count().orderBy(F.desc("count"), lang_col).limit(MAX_LANGUAGES).collect()
    if not counts:
        return {}
    # many documents of each language, not one long one
    part = min(letters, DOCUMENT_LETTERS)
    draw = F.xxhash64(F.col(id_col).cast("string"), text_col, F.lit(6))
    # about three times the bound passes the draw, so only that much text meets the window
    share = F.create_map(*[F.lit(x) for lang, n in counts for x in (lang, 3e6 * docs / n)])
    few = (learn.where(F.pmod(draw, F.lit(1_000_000)) < F.try_element_at(share, F.col(lang_col)))
           .select(F.col(lang_col).alias("lang"), F.substring(text_col, 1, part).alias("text"), draw.alias("draw")))
    first = F.row_number().over(Window.partitionBy("lang").orderBy("draw"))
    out: dict[str, list[str]] = {}
    for lang, text in few.withColumn("n", first).where(F.col("n") <= docs).orderBy("lang", "n").select("lang", "text").collect():
        out.setdefault(lang, []).append(" ".join(words(text)))
    # each language by itself: a label with little text keeps what it has and takes nothing from the others
    return {k: f" {' '.join(v)} "[:letters] for k, v in out.items()}


def predict(docs: DataFrame, training: dict[str, str], id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, lang_pred, score) of every row."""
    shared = docs.sparkSession.sparkContext.broadcast(training)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parser = _parser(shared.value)
        for b in slices(batches):
            found = parser.batch(byte_texts(b.column(1)))
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array([x for x, _ in found], pa.string()),
                                              pa.array([s for _, s in found], pa.float64())], names=[id_col, "lang_pred", "score"])

    schema = T.StructType([T.StructField(id_col, docs.schema[id_col].dataType), T.StructField("lang_pred", T.StringType()),
                           T.StructField("score", T.DoubleType())])
    return docs.select(id_col, text_col).mapInArrow(run, schema)


def drop_unknown(docs: DataFrame, training: dict[str, str], text_col: str = "text") -> DataFrame:
    """``docs`` without the rows whose language is unknown; the rest unchanged.  If nothing could be
    learned, only null texts and those without a letter go."""
    cols = docs.columns
    shared = docs.sparkSession.sparkContext.broadcast(training)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parser, at = _parser(shared.value), cols.index(text_col)
        for b in slices(batches, at):
            texts = byte_texts(b.column(at))
            known = [x != UNKNOWN for x, _ in parser.batch(texts)] if parser.names else [bool(t[-1]) for t in parser.totals(texts)]
            yield b.filter(pa.array(known, pa.bool_()))

    return docs.mapInArrow(run, docs.schema)


_PARSERS: dict[int, Parser] = {}


def _parser(training: dict[str, str]) -> Parser:
    """One parser per worker process and training set."""
    key = hash(tuple(sorted(training.items())))
    if key not in _PARSERS:
        _PARSERS.clear()
        _PARSERS[key] = Parser(training)
    return _PARSERS[key]


def learned_rows(docs: DataFrame, folds: int = 3, held: int = 1, id_col: str = "doc_id") -> DataFrame:
    return docs.where(crc_rest(F.col(id_col), folds) != held)


def held_out(id_col: str = "doc_id", folds: int = 3, held: int = 1) -> Column:
    return crc_rest(F.col(id_col), folds) == held
