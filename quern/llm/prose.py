"""Problem 3: per-document statistics that tell prose from lists, tables and junk.

Every line is judged by a score that sums up what speaks for sentences and what
speaks against them:

* for: words, common words where the language is known, a mark that closes a
  sentence, sentences that end within the line. None of them is needed, so
  sentences count in any language, in one case and without a full stop;
* against, from the shape of the lines around it: delimiters or gaps in the same
  columns or the same number as in the neighbouring line (a table), periodicity of
  beginnings, indents and endings one, two or three lines apart, and
  autocorrelation of line lengths (a list). The last two weigh on short lines only:
  paragraphs that begin and end alike are still paragraphs;
* against, from the line itself: many cells for its words, symbols and digits in
  place of letters, marks of program code, words without vowels or without white
  space between them, and a stored ``m_punct`` or ``m_alpha_cjk`` that bears it out.

All measurements are taken over the code points of many texts at once.
"""

from __future__ import annotations

import unicodedata
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quern.functions.dist import spread
from quern.llm.batches import chunks, code_points, prefix_hashes, span_hashes

#: common_words is a fixed lexicon; a larger one than this is an error.
MAX_COMMON = 100_000

#: What each signal adds to a line's score; a line with more than 0 in all holds sentences.
WEIGHTS = {
    "start": -1.2, "words": 2.0, "common": 1.5, "ends": 1.0, "inner": 0.8,
    "alignment": -3.6, "periodicity": -1.9, "autocorrelation": -1.7, "cells": -2.6, "code": -3.0, "garbled": -4.0, "unclosed": -1.3, "stored": -0.6,
}

MEASURES = (
    "n_words", "mean_word_length", "common_word_share", "symbol_ratio", "digit_ratio", "lines", "lines_ending_in_punct",
    "table_lines", "list_lines", "indent_periodicity", "length_autocorrelation", "sentence_share",
)

_SPACE, _LETTER, _DENSE, _DIGIT, _LATIN, _VOWEL, _END, _CODE, _UPPER = (1 << i for i in range(9))
#: Delimiters of cells; the first four stand in tables only, commas and colons in sentences too.
_DELIMITERS = "|;\t=,:"


@lru_cache(1)
def _classes() -> tuple[np.ndarray, np.ndarray]:
    """For every code point its classes as bits, and its lower-case letter."""
    flags = np.zeros(0x110000, np.uint16)
    lower = np.arange(0x110000, dtype=np.uint32)
    for c in range(0x110000):
        x = chr(c)
        if x.isspace():
            flags[c] |= _SPACE
        elif x.isalpha():
            flags[c] |= _LETTER
            # scripts that are written without white space between words
            if 0x3040 <= c <= 0x30FF or 0x3400 <= c <= 0x9FFF or 0xF900 <= c <= 0xFAFF or c >= 0x20000 or 0x0E00 <= c <= 0x0EFF:
                flags[c] |= _DENSE
            low = x.lower()
            lower[c] = ord(low[0])
            if low != x:
                flags[c] |= _UPPER
            base = unicodedata.normalize("NFD", low)[0] if c < 0x250 or 0x1E00 <= c < 0x1F00 else ""
            if "a" <= base <= "z" or base and base in "æœøß":
                flags[c] |= _LATIN | (_VOWEL if base in "aeiouyæœø" else 0)
        elif x.isdigit():
            flags[c] |= _DIGIT
    for x in ".!?…。！？":
        flags[ord(x)] |= _END
    for x in "{}<>=;()[]_&$#\\":
        flags[ord(x)] |= _CODE
    return flags, lower


_QUOTES = np.array([ord(c) for c in "\"'”’»)]】」』"], np.uint32)


def _sums(values: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    total = np.concatenate([[0], np.cumsum(values, dtype=np.int64)])
    return total[b] - total[a]


def _around(hit: np.ndarray, weight: np.ndarray, reach: int, bounds: tuple[np.ndarray, np.ndarray]) -> np.ndarray:
    """Weighted mean of ``hit`` over the ``reach`` places to both sides, within ``bounds``."""
    at = np.arange(len(hit))
    lo, hi = np.maximum(at - reach, bounds[0]), np.minimum(at + reach + 1, bounds[1])
    part, whole = (np.concatenate([[0.0], np.cumsum(x)]) for x in (hit * weight, weight))
    return (part[hi] - part[lo]) / np.maximum(whole[hi] - whole[lo], 1e-9)


class Lines:
    """The lines of many texts that are not blank, and the signals of each."""

    def __init__(self, texts: list[str], common: np.ndarray):
        flags_of, lower_of = _classes()
        codes, starts = code_points([t + "\n" for t in texts])  # so that no word or gap goes on in the next text
        flags = flags_of[codes]
        space, letter, dense = flags & _SPACE > 0, flags & _LETTER > 0, flags & _DENSE > 0
        cut = (codes == 10) | (codes == 13)
        edge = np.zeros(len(codes) + 1, bool)
        edge[starts] = True
        edge[:-1] |= cut
        edge[1:] |= cut
        at = np.flatnonzero(edge)
        a, b = at[:-1], at[1:]
        ink = ~space
        full = _sums(ink, a, b) > 0
        a, b = a[full], b[full]
        self.doc = np.searchsorted(starts, a, side="right") - 1
        self.a, self.b, n = a, b, len(a)
        self.size = _sums(ink, a, b)
        place = np.flatnonzero(ink)
        first, last = place[np.searchsorted(place, a)], place[np.searchsorted(place, b) - 1]
        self.indent = first - a
        # words: runs of letters; in scripts without white space one for each character and a half
        plain = letter & ~dense
        word_start = plain & ~np.concatenate([[False], plain[:-1]]) if len(codes) else plain
        self.dense = _sums(dense, a, b)
        self.plain_words = _sums(word_start, a, b)
        self.words = self.plain_words + self.dense / 1.5
        self.letters = _sums(letter, a, b)
        self.digits = _sums(flags & _DIGIT > 0, a, b)
        self.latin, self.vowels = _sums(flags & _LATIN > 0, a, b), _sums(flags & _VOWEL > 0, a, b)
        self.symbols = self.size - self.letters - self.digits
        self.tokens = _sums(ink & ~np.concatenate([[False], ink[:-1]]), a, b) if len(codes) else np.zeros(0, np.int64)
        self.code = _sums(flags & _CODE > 0, a, b)
        # common words by the hash of their lower-case letters; of dense scripts single characters
        ws = np.flatnonzero(word_start)
        we = np.flatnonzero(plain & ~np.concatenate([plain[1:], [False]])) + 1 if len(codes) else ws
        known = np.zeros(len(codes), bool)
        low = lower_of[codes]
        prefix = prefix_hashes(low)
        known[ws] = np.isin(span_hashes(prefix, ws, we), common)
        one = np.flatnonzero(dense)
        known_dense = np.zeros(len(codes), bool)
        known_dense[one] = np.isin(span_hashes(prefix, one, one + 1), common)
        self.common = _sums(known, a, b) + _sums(known_dense, a, b)
        # the closing mark, behind quotes and brackets
        tail = last.copy()
        for _ in range(3):
            quote = np.isin(codes[tail], _QUOTES) & (tail > first)
            tail = np.where(quote, place[np.maximum(np.searchsorted(place, tail) - 1, 0)], tail)
        self.ends = flags[tail] & _END > 0
        stop = np.flatnonzero(flags & _END > 0)
        two = np.minimum(stop + 1, max(len(codes) - 1, 0)), np.minimum(stop + 2, max(len(codes) - 1, 0))
        inner = np.zeros(len(codes), bool)
        # a number and its point open an item, they close no sentence
        spoken = flags[np.maximum(stop - 1, 0)] & _DIGIT == 0
        inner[stop] = (codes[stop] > 0x2000) & letter[two[0]] | (space[two[0]] & ~cut[two[0]] & letter[two[1]] & spoken) if len(stop) else False
        self.inner = _sums(inner, a, b)
        # gaps inside lines: tabs, or white space of two and more
        gap_start = space & ~cut & np.concatenate([[False], ink[:-1]]) if len(codes) else space
        wide = gap_start & (np.concatenate([space[1:], [False]]) | (codes == 9)) if len(codes) else space
        run = np.flatnonzero(wide)
        ahead = np.searchsorted(place, run)
        run, ahead = run[ahead < len(place)], ahead[ahead < len(place)]
        line = np.searchsorted(a, run, side="right") - 1
        inside = (line >= 0) & (place[ahead] < b[line]) if n else np.zeros(len(run), bool)
        run, ahead, line = run[inside], place[ahead[inside]], line[inside]
        self.gaps = np.bincount(line, minlength=n)
        # a gap of two before a letter may be stray; wider ones, tabs and gaps before marks part cells
        strong = (ahead - run > 2) | (codes[run] == 9) | ~letter[ahead]
        column = line * np.int64(1 << 32) + (ahead - a[line])
        aligned = np.isin(column + (1 << 32), column)
        below = np.bincount(line[aligned], minlength=n)
        counts = np.stack([_sums(codes == ord(c), a, b) for c in _DELIMITERS])
        spaced = np.zeros(len(codes), bool)
        if len(codes) > 2:
            spaced[1:-1] = space[:-2] & space[2:] & np.isin(codes[1:-1], np.array([ord(c) for c in "/>»«•·–—|-"], np.uint32))
        self.cells = 1 + counts[0] + counts[1] * ~self.ends + counts[2] + _sums(spaced & (codes != 124), a, b) + np.bincount(line[strong & (codes[run] != 9)], minlength=n)
        self.items = 1 + _sums(np.isin(codes, np.array([0x2C, 0xFF0C, 0x3001, 0x3B], np.uint32)), a, b)
        self._shape(codes, flags, first, tail, counts, below)

    def _shape(self, codes: np.ndarray, flags: np.ndarray, first: np.ndarray, tail: np.ndarray, counts: np.ndarray, below: np.ndarray) -> None:
        """Alignment, periodicity and autocorrelation of each line with those around it in its text."""
        n = len(self.a)
        same_doc = {k: np.concatenate([np.zeros(k, bool), self.doc[k:] == self.doc[:-k]]) if n > k else np.zeros(n, bool) for k in (1, 2, 3)}
        # a line and the one before it have the same delimiters, or gaps in the same columns
        pair = np.zeros(n, bool)
        if n > 1:
            x, y = counts[:, 1:], counts[:, :-1]
            short = np.maximum(self.words[1:], self.words[:-1]) <= 6
            rows = ((x > 0) & ((x == y) | (np.minimum(x, y) > 1)))[:4].any(0) | (((x > 0) & (x == y))[4:].any(0) & short)
            columns = (below[:-1] * 2 >= np.minimum(self.gaps[1:], self.gaps[:-1])) & (np.minimum(self.gaps[1:], self.gaps[:-1]) >= 2)
            pair[1:] = (rows | columns) & same_doc[1][1:]
        self.alignment = (pair | np.concatenate([pair[1:], [False]])).astype(float) if n else np.zeros(0)
        # the kind of the first and last character, and the indent
        def kind(at: np.ndarray) -> np.ndarray:
            f = flags[at]
            return np.where(f & _LETTER > 0, np.where(f & _DENSE > 0, 1, 2 + (f & _UPPER > 0)), np.where(f & _DIGIT > 0, 4, 8 + codes[at].astype(np.int64)))

        first_line = np.searchsorted(self.doc, self.doc, side="left")
        bounds = first_line, np.searchsorted(self.doc, self.doc, side="right")
        shape = kind(first) * 4_000_000 + np.where(self.ends, 5, kind(tail)) * 2 + (self.indent > 0)
        length = self.size.astype(float)
        self.periodicity, self.autocorrelation = np.zeros(n), np.zeros(n)
        for lag, ok in same_doc.items():
            hit = np.zeros(n)
            like = np.zeros(n)
            hit[lag:] = (shape[lag:] == shape[:-lag]) & ok[lag:] if n > lag else 0
            if n > lag:
                like[lag:] = length[lag:] * length[:-lag] / ((length[lag:] ** 2 + length[:-lag] ** 2) / 2)
            weight = ok.astype(float)
            # a pair tells about both of its lines and those between; one pair is no period yet
            few = np.minimum(1.0, _around(weight, np.ones(n), 2, bounds) * 5 / 2)
            for name, x in (("periodicity", hit), ("autocorrelation", like)):
                back = np.concatenate([x[lag:], np.zeros(lag)])[:n]
                weight_back = np.concatenate([weight[lag:], np.zeros(lag)])[:n]
                mean = np.maximum(_around(x, weight, 1, bounds), _around(back, weight_back, 1, bounds)) * few
                np.maximum(getattr(self, name), np.where((weight + weight_back) > 0, mean, 0.0), out=getattr(self, name))

    def scores(self, weights: dict[str, float], stored: np.ndarray) -> np.ndarray:
        words = np.maximum(self.words, 1)
        share = self.common / words
        short = np.clip((12 - self.words) / 2.5, 0, 1) * (self.inner == 0)
        table = np.clip((16 - self.words / np.maximum(self.cells, 1)) / 8, 0, 1)
        cells = ((self.cells >= 3) & (self.words <= 5.5 * self.cells)) | ((self.items >= 4) & (self.words <= 2.4 * self.items)) | ((self.cells >= 3) & (self.dense > 0) & (self.words <= 6 * self.cells))
        vowels = self.vowels / np.maximum(self.latin, 1)
        packed = (self.tokens * 15 < self.size) & (self.dense * 2 < self.size)
        garbled = np.maximum(np.clip((0.7 - self.letters / np.maximum(self.size, 1)) / 0.2, 0, 1), ((self.latin >= 10) & (self.latin * 2 > self.letters) & ((vowels < 0.25) | (vowels > 0.75))) | packed)
        unclosed = (self.common == 0) & ~self.ends & (self.dense == 0)
        # a row of a table is no item of a list as well
        short = short * (self.alignment == 0)
        signals = {
            "start": 1.0, "words": np.minimum(1, self.words / 10), "common": np.minimum(1, share / 0.2), "ends": self.ends, "inner": self.inner > 0, "alignment": self.alignment * table, "periodicity": self.periodicity * short,
            "autocorrelation": self.autocorrelation * short, "cells": cells, "code": self.code >= np.maximum(2, 0.25 * words), "garbled": garbled, "unclosed": unclosed, "stored": stored[self.doc],
        }
        return sum((weights[k] * v for k, v in signals.items()), np.zeros(len(self.a)))


def lexicon(words: list[str]) -> np.ndarray:
    """Hashes of the words' letters, lower-cased."""
    codes, starts = code_points([w.lower() for w in words])
    return np.unique(span_hashes(prefix_hashes(codes), starts[:-1], starts[1:]))


def measure(texts: list[str], common: np.ndarray, stored: np.ndarray | None = None, weights: dict[str, float] | None = None) -> dict[str, np.ndarray]:
    """All MEASURES for a list of texts; zeros where there is no text. ``stored`` is 1 where the stored ratios speak against prose."""
    n = len(texts)
    x = Lines(texts, common)

    def total(values: np.ndarray) -> np.ndarray:
        return np.bincount(x.doc, values, n)

    score = x.scores(weights or WEIGHTS, np.zeros(n) if stored is None else stored)
    size, lines, words = np.maximum(total(x.size), 1), np.bincount(x.doc, minlength=n), np.maximum(total(x.plain_words + x.dense), 1)
    per_line = np.maximum(lines, 1)
    return {
        "n_words": total(x.plain_words + x.dense).astype(np.int64), "mean_word_length": total(x.letters) / words, "common_word_share": total(x.common) / words, "symbol_ratio": total(x.symbols) / size, "digit_ratio": total(x.digits) / size,
        "lines": lines, "lines_ending_in_punct": total(x.ends) / per_line, "table_lines": total(x.alignment > 0) / per_line, "list_lines": total((x.periodicity >= 0.6) & (x.words <= 9)) / per_line,
        "indent_periodicity": total(x.periodicity) / per_line, "length_autocorrelation": total(x.autocorrelation) / per_line, "sentence_share": total(x.size * (score > 0)) / size,
    }


def statistics(documents: DataFrame, common_words: DataFrame) -> DataFrame:
    """(doc_id, *MEASURES, m_non_ws, m_alpha_cjk, m_punct): one row per document row.

    A null, empty or blank text has zeros throughout and no prose to judge
    (``lines`` is 0). The stored ``m_*`` pass through unchanged, null or stale as
    they may be. Very long texts are read whole. Repeated rows stay repeated; an
    empty lexicon only weakens the judgement. Other columns are ignored.
    """
    rows = common_words.select(F.lower(F.trim("word")).alias("word")).where("word <> ''").distinct().limit(MAX_COMMON + 1).collect()
    if len(rows) > MAX_COMMON:
        raise ValueError(f"more than {MAX_COMMON} common words")
    common = frozenset(r["word"] for r in rows)
    known = lexicon(sorted(common))
    kind = dict(documents.dtypes)["doc_id"]
    stored = ("m_non_ws", "m_alpha_cjk", "m_punct")

    def scan(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            texts = [t or "" for t in b["text"]]
            # null, zero and stale values say nothing; the two ratios must agree
            against = ((b["m_alpha_cjk"] < 0.5) & (b["m_alpha_cjk"] > 0) & (b["m_punct"] > 0.1)).to_numpy(float)
            for i, j in chunks(texts, 1 << 19):
                out = pd.DataFrame(measure(texts[i:j], known, against[i:j]), columns=MEASURES)
                out.insert(0, "doc_id", b["doc_id"].to_numpy()[i:j])
                yield out.assign(**{c: b[c].to_numpy()[i:j] for c in stored})

    types = {"n_words": "long", "lines": "long"}
    schema = ", ".join([f"doc_id {kind}", *[f"{m} {types.get(m, 'double')}" for m in MEASURES], *[f"{c} double" for c in stored]])
    return spread(documents.select("doc_id", "text", *[F.col(c).cast("double").alias(c) for c in stored])).mapInPandas(scan, schema)


def not_prose(stats: DataFrame) -> DataFrame:
    """Documents with text in which more than half of the non-white characters belong to no sentence."""
    return stats.where((F.col("lines") > 0) & (F.col("sentence_share") < 0.5))
