"""Language identification by cross-parsing entropy.

Per language, the distinct words of a bounded sample of labelled texts form
one suffix automaton. A text is parsed, word by word, into phrases: each is
the longest match the automaton has from that place on (one character if it
has none). The number of phrases, times the logarithm of the automaton's
text length (what naming a place in it costs), is the cross entropy; the
language needing fewest normalised phrases wins. Words keep their edges
(a mark before and after), and a phrase never leaves its word, so a word's
phrase counts can be remembered.
"""
from __future__ import annotations

import math
import re
from collections.abc import Iterator
from dataclasses import dataclass

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from usagelens.llm.common import chunks, per_worker, ship, text_or_empty

UNDETERMINED = "und"
REMEMBERED = 300_000
#: Words of more characters are not remembered, which bounds the cache in bytes.
LONGEST = 64
CHUNK = 1 << 20
EDGE = "\x00"
#: Bits that one language's phrase count takes in a packed sum.
BITS = 48
words_of = re.compile(r"[^\W\d_]+").findall


class SuffixAutomaton:
    """All substrings of a set of words, each framed by edge marks; ``next[state]`` maps a character to a state."""

    def __init__(self, words):
        self.next: list[dict[str, int]] = [{}]
        link, length = [-1], [0]
        self.size = 0
        for word in words:
            last = 0  # a generalised automaton: every word starts at the root
            for ch in EDGE + word + EDGE:
                self.size += 1
                last = self._extend(last, ch, link, length)

    def _extend(self, last: int, ch: str, link: list[int], length: list[int]) -> int:
        nexts = self.next
        q = nexts[last].get(ch)
        if q is not None and length[q] == length[last] + 1:
            return q  # the prefix is there already
        if q is None:
            cur = len(nexts)
            nexts.append({})
            length.append(length[last] + 1)
            link.append(0)
            p = last
            while p >= 0 and ch not in nexts[p]:
                nexts[p][ch] = cur
                p = link[p]
            if p < 0:
                return cur
            q = nexts[p][ch]
            if length[q] == length[p] + 1:
                link[cur] = q
                return cur
        else:
            cur, p = -1, last
        copy = len(nexts)
        nexts.append(dict(nexts[q]))
        length.append(length[p] + 1)
        link.append(link[q])
        while p >= 0 and nexts[p].get(ch) == q:
            nexts[p][ch] = copy
            p = link[p]
        link[q] = copy
        if cur < 0:
            return copy
        link[cur] = copy
        return cur

    def phrases(self, word: str) -> int:
        """Number of longest-match phrases that make up ``word`` with its edges."""
        nexts, state, n = self.next, 0, 0
        for ch in EDGE + word + EDGE:
            to = nexts[state].get(ch)
            if to is None:
                n += state != 0  # the phrase ends here; the next one starts with ch
                to = nexts[0].get(ch, 0)
                n += to == 0  # a character never seen is a phrase
            state = to
        return n + (state != 0)


@dataclass(frozen=True)
class Sample:
    """The words each language's automaton is built from, in a fixed order."""
    languages: tuple[str, ...]
    words: tuple[tuple[str, ...], ...]


class Parser(dict):
    """Phrase counts by word, all languages packed into one integer."""

    def __init__(self, sample: Sample, limit: int = REMEMBERED):
        self.automata = [SuffixAutomaton(w) for w in sample.words]
        self.languages, self.limit = sample.languages, limit
        self.cost = [math.log2(a.size + 2) for a in self.automata]

    def __missing__(self, word: str) -> int:
        packed = 0
        for i, a in enumerate(self.automata):
            packed |= a.phrases(word) << BITS * i
        if len(self) < self.limit and len(word) <= LONGEST:
            self[word] = packed
        return packed

    def predict(self, text: str) -> tuple[str, float]:
        """(language, score); the score is the runner-up's share of the two best costs."""
        total, letters = 0, False
        for part in chunks(text, CHUNK):
            if words := words_of(part.lower()):
                letters = True
                total += sum(map(self.__getitem__, words))
        if not letters or not self.languages:
            return UNDETERMINED, 0.0
        mask = (1 << BITS) - 1
        costs = sorted((((total >> BITS * i) & mask) * c, lang)
                       for i, (c, lang) in enumerate(zip(self.cost, self.languages)))
        if len(costs) == 1:
            return costs[0][1], 1.0
        return costs[0][1], costs[1][0] / (costs[0][0] + costs[1][0])


def parser(sample: Sample) -> Parser:
    return per_worker(Parser, sample)


def is_held_out(doc_id: str = "doc_id"):
    """crc32 of the id's text, modulo 3, is 1 (false for a null id)."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string")) % 3 == 1, F.lit(False))


def learn(docs: DataFrame, per_language: int = 48, shortest: int = 200, longest: int = 8000,
          max_chars: int = 40_000) -> Sample:
    """A bounded sample of labelled texts, as words per language.

    Of the rows with a language, an id that is not held out and a text of
    ``shortest`` to ``longest`` characters (any length if a language has
    none such), the ``per_language`` rows of smallest id hash are taken, and
    their distinct words up to ``max_chars`` characters. Of rows with one id
    and language the first text in order counts. Only this bounded sample
    comes to the driver; the rank filter is pushed below the shuffle.
    """
    ship(docs.sparkSession)
    rows = docs.select("doc_id", "lang", F.length("text").alias("n")).where(
        F.col("lang").isNotNull() & F.col("doc_id").isNotNull() & (F.col("n") > 0) & ~is_held_out())
    ranked = rows.withColumn("odd", ~F.col("n").between(shortest, longest)).selectExpr(
        "doc_id", "row_number() over (partition by lang order by odd, xxhash64(doc_id), doc_id) as k")
    chosen = [r.doc_id for r in ranked.where(F.col("k") <= per_language).select("doc_id").distinct().collect()]
    texts = docs.where(F.col("doc_id").isin(chosen) & F.col("lang").isNotNull() & F.col("text").isNotNull()).select(
        "lang", "doc_id", F.substring("text", 1, max_chars).alias("text")).groupBy("lang", "doc_id").agg(
            F.min("text").alias("text")) if chosen else None
    by_lang: dict[str, dict[str, None]] = {}
    for r in sorted(texts.collect(), key=lambda r: (r.lang, r.doc_id)) if chosen else []:
        by_lang.setdefault(r.lang, {}).update(dict.fromkeys(words_of(r.text.lower())))
    words = {}
    for lang, distinct in by_lang.items():
        taken, size = [], 0
        for w in distinct:
            size += len(w)
            if size > max_chars:
                break
            taken.append(w)
        if taken:
            words[lang] = tuple(taken)
    return Sample(tuple(sorted(words)), tuple(words[x] for x in sorted(words)))


def predictions(text: Column, sample: Sample) -> Column:
    """Struct (lang_pred, score) of a text column, a row at a time inside Arrow batches."""
    @F.pandas_udf("lang_pred string, score double")
    def predict(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        one = parser(sample).predict
        for texts in batches:
            yield pd.DataFrame([one(t) for t in texts], columns=["lang_pred", "score"])

    return predict(text)


def identify(docs: DataFrame, sample: Sample) -> DataFrame:
    """(doc_id, held_out, lang_pred, score) for every row of ``docs``, from its whole text alone.

    Null text, or a text without a letter: ``und``, score 0; so is every row
    if nothing was learned. Equal costs go to the language that sorts first.
    Null and repeated doc_ids pass through, a row each (a null id is never
    held out); other columns are not read; an empty table gives no rows.
    Narrow: the sample travels with the function.
    """
    return docs.select("doc_id", is_held_out().alias("held_out"), predictions(text_or_empty(), sample).alias("p")).select(
        "doc_id", "held_out", "p.lang_pred", "p.score")
