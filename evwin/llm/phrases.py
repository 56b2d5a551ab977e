"""Substring deduplication of words by repeated-phrase automata.

The recurring passages of a shard (see ``repeats``) are confirmed by comparing the words
themselves: every 35-word window that stands twice or more among the shard's contexts is
a phrase.  The phrases of a shard are compiled to one Aho-Corasick automaton
(pyahocorasick; each different word is one sign, so a match begins and ends at words),
and the contexts from all documents are streamed through it to locate every occurrence.

Null text: no words.  Texts shorter than a window keep everything.  Rows alike in id and
text repeat each other.  Very long texts: read whole.  Ties: all occurrences go, also the
first, so there is no order to break.  Empty table: empty result.  Extra columns, of any
name, are not read.
"""

from __future__ import annotations

import hashlib
from collections import Counter

import ahocorasick
import numpy as np
from pyspark.sql import DataFrame

from evwin.llm.repeats import Tokens, covered, marks, ranges_of, removed

WINDOW, GRAM = 35, 8


def _signs(contexts: list[bytes]) -> list[str]:
    """Contexts as strings with one sign for each different word."""
    sign: dict[bytes, str] = {}
    out = []
    for context in contexts:
        text = []
        for word in context.split():
            s = sign.get(word)
            if s is None:  # past the surrogates; a shard has far fewer different words than there are signs
                s = sign[word] = chr(len(sign) + 1 if len(sign) < 0xD7FF else len(sign) + 1 + 0x800)
            text.append(s)
        out.append("".join(text))
    return out


def repeated_windows(contexts: list[bytes], n: np.ndarray, window: int = WINDOW) -> list[np.ndarray]:
    """For each context the ranges of words that lie in a window standing more than once,
    where context i stands n[i] times."""
    texts = _signs(contexts)
    times: Counter[str] = Counter()
    for text, many in zip(texts, n.tolist()):
        windows = [text[a : a + window] for a in range(len(text) - window + 1)]
        for _ in range(min(many, 2)):  # twice is enough to be repeated
            times.update(windows)
    automaton = ahocorasick.Automaton(ahocorasick.STORE_LENGTH)
    for phrase, many in times.items():
        if many > 1:
            automaton.add_word(phrase)
    if not len(automaton):
        return [np.zeros(0, np.int32) for _ in texts]
    automaton.make_automaton()
    return [ranges_of(np.fromiter((end + 1 - window for end, _ in automaton.iter(text)), np.int64), window) for text in texts]


def _finish(kind: Tokens, data: np.ndarray, edges) -> tuple:
    words = data.tobytes().split()  # at white space, as the tokens are
    gone = marks(len(words), edges)
    kept = b" ".join(w for w, g in zip(words, gone.tolist()) if not g) if gone.any() else b" ".join(words)
    return len(words), int(gone.sum()), hashlib.sha256(kept).hexdigest()


def repeated_passages(docs: DataFrame, window: int = WINDOW, gram: int = GRAM) -> DataFrame:
    """doc_id, rk and l: where each document has repeated words (first, cover)."""
    return covered(docs, Tokens(True, window, gram), repeated_windows, compare_all=True)


def dedup_words(docs: DataFrame) -> DataFrame:
    """doc_id, n_words, n_removed, kept_sha256 of every document."""
    return removed(docs, repeated_passages(docs), Tokens(True, WINDOW, GRAM), "n_words long, n_removed long, kept_sha256 string", _finish)
