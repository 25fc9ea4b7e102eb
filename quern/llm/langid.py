"""Problem 6: the language of each document and of each stretch of mixed-language text.

A linear-chain conditional random field labels every word with one of six
languages or with none (markup, code, garbage). Its features are affixes, letter
n-grams, accents and lexicon hits of a word and the common words beside it; its
transitions are learned from code-switched texts composed of the labelled
samples. Forward-backward gives each word a probability for each language, from
which shares and confidences follow.
"""

from __future__ import annotations

import base64
import random
import re
import unicodedata
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quern.functions.dist import spread
from quern.llm.crf import CRF, Types, fitted
from quern.llm.langlabels import LANGUAGES, language_of

LABELS = (*LANGUAGES, "none")
#: Training texts and lexicon entries that are fitted on at most (lang_samples and
#: common_words are fixed tables far below this).
MAX_SAMPLES, MAX_WORDS = 5_000, 20_000
SHARE = 0.2

_TOKEN = re.compile(r"[㐀-鿿豈-﫿]+|[^\W\d_㐀-鿿豈-﫿]+|\d+|\n|[^\w\s]")
_HAN_RUN = re.compile(r"[㐀-鿿豈-﫿]+")
_HAN = re.compile(r"[㐀-鿿豈-﫿]")
_CONSONANTS, _VOWELS = "bcdfghjklmnpqrstvwxz", "aeiou"


def _strip_accents(text: str) -> str:
    return "".join(c for c in unicodedata.normalize("NFD", text) if not unicodedata.combining(c))


class Features:
    """Picklable feature functions; ``lexicon`` maps a word to the languages that list it."""

    def __init__(self, lexicon: dict[str, tuple[str, ...]]):
        self.lexicon = lexicon

    def own(self, token: str) -> list[str]:
        first = token[:1]
        if not first.isalpha():
            return ["num" if first.isdigit() else f"p{first}"] if first else ["edge"]
        if _HAN.match(first):
            return ["han"]
        w = token.casefold()
        n = len(w)
        out = [f"w{w}", f"len{min(n, 14) // 2}"]
        out += [f"a{w[:k]}" for k in (1, 2, 3) if n >= k] + [f"z{w[-k:]}" for k in (1, 2, 3, 4) if n >= k]
        padded = f"^{w}$"
        out += [f"g{padded[i : i + 3]}" for i in range(len(padded) - 2)]
        out += [f"c{c}" for c in w if ord(c) > 127]
        out += [f"lex{x}" for x in self.lexicon.get(w, ())]
        if not any(c in _VOWELS or ord(c) > 127 or c == "y" for c in w):
            out.append("novowel")
        if n > 1 and not (token.islower() or token.istitle() or token.isupper()):
            out.append("mixedcase")
        return out

    def near(self, token: str) -> list[str]:
        first = token[:1]
        if not first.isalpha():
            return ["num" if first.isdigit() else f"p{first}"] if first else ["edge"]
        if _HAN.match(first):
            return ["han"]
        w = token.casefold()
        known = self.lexicon.get(w, ())
        return [f"w{w}", *[f"lex{x}" for x in known], *[f"z{w[-2:]}"]]


def tokens_of(text: str) -> list[str]:
    """Words, numbers, line ends and single marks; a stretch of Chinese characters is one word."""
    return _TOKEN.findall(text)


def _junk(rng: random.Random) -> str:
    """A line that is in no language: code, markup, addresses, random letters, encoded or garbled matter."""
    name = lambda: "".join(rng.choice(_CONSONANTS) + rng.choice(_VOWELS) + rng.choice(["", rng.choice(_CONSONANTS)]) for _ in range(rng.randrange(1, 4)))
    w, v, n = name(), name(), rng.randrange(1, 9999)
    kind = rng.randrange(18)
    if kind < 12:
        return [
            f"function {w}({v}) {{ return {v} + {n}; }}", f'<div class="{w} {v}" id="{w}{n}"><span>{n}</span></div>', f"{w}.{v}({name()}, {n});",
            f"var {w} = {v}({n});", f"if ({w}.{v} > {n}) {{", f".{w}-{v} {{ margin: {n}px; padding: {n}em }}", f"}} else {{ {w}[{v}] = {n}; }}",
            f"window.{w}.push({v}, {n}); const {v} = {w} => {w} + {n},", f"&nbsp;{w}&gt;{v}&amp;{n}", f"https://{w}.{v}.example/{name()}/{n}",
            f"for (let i = 0; i < {n}; i++) {w}[i] = {v};", f"import {w} from '{v}'; def {w}(self, {v}):",
        ][kind]
    if kind < 15:
        letters = "".join(rng.sample("abcdefghijklmnopqrstuvwxyz", rng.choice([12, 20, 26])))
        return " ".join("".join(rng.choice(letters) for _ in range(rng.randrange(2, 15))) for _ in range(rng.randrange(8, 25)))
    if kind == 15:
        return base64.b64encode(rng.randbytes(60)).decode()
    if kind == 16:
        return rng.randbytes(24).hex(" ")
    return "".join(rng.choice("ÃÂâ€œ™Ÿ¿½¼»†‡Ñ Ð°ï¬¤¶ ") for _ in range(rng.randrange(20, 80)))


def _rows(rng: random.Random, text: str) -> str:
    """Lists and tables of phrases of a text: they are in its language, whatever stands between them."""
    if _HAN.search(text):
        runs = _HAN_RUN.findall(text)
        phrase = lambda: (r := rng.choice(runs))[(a := rng.randrange(len(r))) : a + rng.randrange(2, 8)]
    else:
        words = re.findall(r"[^\W\d_]+(?:['’][^\W\d_]+)?", text)
        phrase = lambda: " ".join(words[(a := rng.randrange(len(words))) : a + rng.randrange(2, 5)])
    name = lambda: "".join(rng.choice(_CONSONANTS) + rng.choice(_VOWELS) + rng.choice(_CONSONANTS) for _ in range(rng.randrange(1, 4))).capitalize()
    x = lambda: f"{rng.randrange(9999)}.{rng.randrange(100):02d}"
    form = rng.choice([
        lambda i: f"{i}. {phrase()}", lambda i: f"{i}) {phrase()}", lambda i: f"- {phrase()}", lambda i: f"{phrase().title()} ({rng.randrange(500)})",
        lambda i: f"| {phrase()} | {name()} | {x()} | {x()} |", lambda i: f'"{phrase()}","{name()}","{x()}"', lambda i: f"{phrase()};{name()};{x()};{x()}",
        lambda i: f"{phrase()}\t{name()}\t{x()}", lambda i: f"{phrase()}: {x()} {rng.choice(['kg', 'mm', 'W', 'V', '°C', '%'])}",
        lambda i: f"20{rng.randrange(10, 99)}-0{rng.randrange(1, 9)}-1{rng.randrange(9)}  {x()}  {x()}  {phrase()}", lambda i: f"{rng.randrange(900)} {rng.choice(['ml', 'g', 'x'])} {phrase()}",
        lambda i: f"{phrase()}, {phrase()}, {phrase()} | {phrase()}", lambda i: phrase(), lambda i: " / ".join(phrase() for _ in range(4)), lambda i: ", ".join(phrase().split(" ")[-1] for _ in range(9)), lambda i: f"{phrase()}  {name()}   {x()}   {x()}", lambda i: f"> {phrase()} > {phrase()} / {phrase()}",
    ])
    return "\n".join(form(i) for i in range(1, rng.randrange(4, 9)))


def training_sequences(samples: list[tuple[str, str]], seed: int = 5) -> tuple[list[list[str]], list[list[int]]]:
    """Labelled token sequences: every sample as it is, in other cases, without accents, and mixed."""
    rng = random.Random(seed)
    pieces = [(LABELS.index(lang), s) for lang, text in samples for s in re.split(r"(?<=[.!?。！？])\s*", text) if s.strip()]
    seqs, gold = [], []

    def add(parts: list[tuple[int, str]]) -> None:
        t: list[str] = []
        y: list[int] = []
        for label, text in parts:
            own = tokens_of(text)
            t += own
            y += [label] * len(own)
        if t:
            seqs.append(t)
            gold.append(y)

    junk = lambda: (LABELS.index("none"), _junk(rng) + rng.choice(["", "\n"]))
    for lang, text in samples:
        label = LABELS.index(lang)
        form = rng.choice([str, str, str.upper, str.lower, _strip_accents, lambda x: _strip_accents(x).upper()])
        add([(label, form(text))])
    for _ in range(len(samples)):
        parts = []
        for _ in range(rng.randrange(2, 5)):
            label, text = rng.choice(pieces)
            form = rng.choice([str, str, str, str.upper, _strip_accents])
            parts += [(label, form(text) + rng.choice([" ", "\n"]))] + ([junk()] if rng.random() < 0.35 else [])
        add(parts)
        label, text = rng.choice(pieces)
        add([(label, _rows(rng, text))])
    for _ in range(max(50, len(samples))):
        add([junk() for _ in range(rng.randrange(1, 4))])
    return seqs, gold


def train(samples: DataFrame, common_words: DataFrame, seed: int = 5, rounds: int = 40) -> CRF:
    """Fit on the labelled samples, which are a small fixed table."""
    texts = samples.select(language_of(F.col("lang")).alias("lang"), "sample_text").where("lang is not null and sample_text <> ''").distinct().orderBy("lang", "sample_text").limit(MAX_SAMPLES).collect()
    words = common_words.select(language_of(F.col("lang")).alias("lang"), F.lower("word").alias("word")).where("lang is not null and word <> ''").distinct().orderBy("word", "lang").limit(MAX_WORDS).collect()
    lexicon: dict[str, list[str]] = {}
    for r in words:
        for form in {r["word"], _strip_accents(r["word"])}:
            lexicon.setdefault(form, []).append(r["lang"])
    rows = [(r["lang"], r["sample_text"]) for r in texts]

    def fit() -> CRF:
        features = Features({w: tuple(v) for w, v in lexicon.items()})
        seqs, gold = training_sequences(rows, seed)
        return CRF(LABELS, features.own, features.near).fit(seqs, gold, rounds=rounds, least=1)

    return fitted(["langid", rows, lexicon, rounds, seed], fit)


def _key(token: str) -> str:
    """Tokens with the same features share a type."""
    c = token[0]
    return "漢" if _HAN.match(c) else "0" if c.isdigit() else token


def _label(types: Types, texts: list[list[str]]) -> tuple[np.ndarray, np.ndarray]:
    """(probabilities of each token's labels, tokens of each text); a text is one sequence, however long."""
    lengths = np.array([len(ts) for ts in texts], np.int64)
    return types.model.posterior(types.rows([t for ts in texts for t in ts]), lengths), lengths


def _parts(texts: list[str], most: int = 1 << 20) -> Iterator[slice]:
    i = n = 0
    for j, t in enumerate(texts):
        n += len(t)
        if n > most or j == len(texts) - 1:
            yield slice(i, j + 1)
            i, n = j + 1, 0


def _weights(texts: list[list[str]]) -> np.ndarray:
    return np.array([len(t) if t[0].isalpha() else 0 for ts in texts for t in ts], np.float64)


def languages(documents: DataFrame, model: CRF, share: float = SHARE) -> DataFrame:
    """(doc_id, lang_label, lang_found, share, confidence): each language with at least ``share`` of a document's letters.

    ``lang_label`` is the stored label in two letters, null if it names none of
    the six. A text that is null, empty or in no language has no row. Long texts
    are read whole. Rows that repeat a doc_id are judged one by one; an empty
    table gives no rows; other columns are ignored.
    """
    kind = dict(documents.dtypes)["doc_id"]
    sent = documents.sparkSession.sparkContext.broadcast(model)

    def scan(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        types = sent.value.index(_key)
        for b in batches:
            texts = b["text"].tolist()
            for part in _parts(texts):
                tokens = [tokens_of(t) for t in texts[part]]
                post, lengths = _label(types, tokens)
                if not len(post):
                    continue
                doc = np.repeat(np.arange(len(lengths)), lengths)
                weight, best = _weights(tokens), post.argmax(1)
                key = doc * len(LABELS) + best
                n = len(lengths) * len(LABELS)
                letters = np.bincount(key, weight, n).reshape(-1, len(LABELS))
                sure = np.bincount(key, weight * post[np.arange(len(post)), best], n).reshape(-1, len(LABELS))
                total = letters.sum(1, keepdims=True)
                d, k = np.nonzero((letters[:, :-1] > 0) & (letters[:, :-1] >= share * total))
                own = b.iloc[part]
                yield pd.DataFrame({"doc_id": own["doc_id"].to_numpy()[d], "lang_label": own["label"].to_numpy()[d], "lang_found": np.array(LABELS, object)[k], "share": letters[d, k] / total[d, 0], "confidence": sure[d, k] / letters[d, k]})

    sources = documents.select("doc_id", "text", language_of(F.col("lang")).alias("label")).where(F.length("text") > 0)
    return spread(sources).mapInPandas(scan, f"doc_id {kind}, lang_label string, lang_found string, share double, confidence double")


def segments(documents: DataFrame, model: CRF) -> DataFrame:
    """(doc_id, segment_no, start, end, lang, confidence): stretches [start, end) of one language, in characters.

    ``lang`` is ``none`` for stretches in no language; marks and numbers go with
    the words before them. Null and empty texts have no segment.
    """
    kind = dict(documents.dtypes)["doc_id"]
    sent = documents.sparkSession.sparkContext.broadcast(model)

    def scan(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        types = sent.value.index(_key)
        for b in batches:
            texts, ids = b["text"].tolist(), b["doc_id"].tolist()
            for part in _parts(texts):
                spans = [[m.span() for m in _TOKEN.finditer(t)] for t in texts[part]]
                tokens = [[t[a:e] for a, e in s] for t, s in zip(texts[part], spans)]
                post, _ = _label(types, tokens)
                out, at = [], 0
                for doc_id, ts, ss in zip(ids[part], tokens, spans):
                    p = post[at : at + len(ts)]
                    at += len(ts)
                    best, rows = p.argmax(1), []
                    for i, t in enumerate(ts):
                        if not t[0].isalpha():
                            if rows:
                                rows[-1][1] = ss[i][1]
                            continue
                        if rows and rows[-1][2] == best[i]:
                            rows[-1][1] = ss[i][1]
                            rows[-1][3] += len(t) * float(p[i, best[i]])
                            rows[-1][4] += len(t)
                        else:
                            rows.append([ss[i][0], ss[i][1], int(best[i]), len(t) * float(p[i, best[i]]), len(t)])
                    out += [(doc_id, k, a, e, LABELS[y], c / n) for k, (a, e, y, c, n) in enumerate(rows)]
                yield pd.DataFrame(out, columns=["doc_id", "segment_no", "start", "end", "lang", "confidence"])

    return spread(documents.select("doc_id", "text").where(F.length("text") > 0)).mapInPandas(scan, f"doc_id {kind}, segment_no long, start long, end long, lang string, confidence double")


def mislabelled(found: DataFrame) -> DataFrame:
    """(doc_id, lang_found): languages that a document's label does not name."""
    return found.where(F.col("lang_label").isNull() | (F.col("lang_label") != F.col("lang_found"))).select("doc_id", "lang_found").distinct()
