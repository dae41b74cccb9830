"""Token counts of whole texts, as the tokenizer's library gives them.

Most pre-tokens are words that the vocabulary holds whole. Which of its strings the model
really encodes as one token is proved once per process by encoding each of them alone;
pre-tokens among them count one, and only the others are merged. Pre-tokens do not span white
space, so the count of a run between white space is found once and looked up when met again.

A NULL text has no tokens, as an empty one. Texts of any length are read whole; very long
ones are taken in pieces cut before white space, which no pre-token or special string spans.
Rows pass one for one: repeated rows, NULL ids and an empty table give just such results.
Columns other than id and text are not looked at.
"""

from __future__ import annotations

import functools
import json
import re
from collections import Counter
from collections.abc import Iterator

import regex
from pyspark.sql import DataFrame
from pyspark.sql.types import BooleanType, LongType, StructField, StructType
from tokenizers import Tokenizer

from .batches import map_texts

PIECE = 1 << 20
# Runs a process keeps before it forgets them.
REMEMBERED = 400_000
# Texts of these characters only are in normal form, and lower case the same everywhere.
_BEYOND_LATIN = re.compile("[^\t-\r -~ -ɏ]")
_CUT = re.compile("[ \t\r\n]")


def _byte_letters() -> dict[int, str]:
    """The printable letter by which byte-level vocabularies write each byte."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    others = [b for b in range(256) if b not in set(plain)]
    return {b: chr(b) for b in plain} | {b: chr(256 + i) for i, b in enumerate(others)}


_LETTERS = _byte_letters()


def pieces(text: str, size: int = PIECE) -> Iterator[str]:
    start = 0
    while len(text) - start > size and (cut := _CUT.search(text, start + size)):
        yield text[start:cut.start()]
        start = cut.start()
    yield text[start:]


class WholeTokens:
    """Counts with one vocabulary file of the tokenizers library."""

    def __init__(self, path: str):
        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        self.model = self.tokenizer.model
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        special = [t["content"] for t in spec["added_tokens"]]
        self.special = regex.compile("|".join(map(regex.escape, special))) if special else None
        split = next(s for s in spec["pre_tokenizer"]["pretokenizers"] if s["type"] == "Split")
        self.words = regex.compile(split["pattern"]["Regex"])
        self.whole = self._prove(spec["model"])
        self.runs = _Runs(self.count_run)

    def _prove(self, model: dict) -> frozenset[str]:
        """The texts of vocabulary strings that encode, alone, as one token."""
        end, raw = model["end_of_word_suffix"] or "", {c: b for b, c in _LETTERS.items()}
        found = set()
        for token in model["vocab"]:
            letters = token[:len(token) - len(end)] if token.endswith(end) else ""
            if letters and all(c in raw for c in letters) \
                    and len(self.model.tokenize(letters)) == 1:
                try:
                    found.add(bytes(raw[c] for c in letters).decode())
                except UnicodeDecodeError:  # part of a character: no pre-token by itself
                    continue
        return frozenset(found)

    def _pre_tokens(self, text: str) -> list[str]:
        return [text[s:e] for _, (s, e) in self.tokenizer.pre_tokenizer.pre_tokenize_str(text)]

    def _merge(self, word: str) -> int:
        return len(self.model.tokenize("".join([_LETTERS[b] for b in word.encode()])))

    def count_run(self, run: str) -> int:
        """Tokens of normalised text without white space."""
        if run in self.whole:
            return 1
        if run.isalpha():
            return self._merge(run)
        return sum([1 if w in self.whole else self.runs[w] if w.isalpha() else self._merge(w)
                    for w in self.words.findall(run)])

    def count(self, text: str | None) -> int:
        tokens = 0
        for piece in pieces(text or ""):
            parts = [piece]
            if self.special and self.special.search(piece):
                parts = self.special.split(piece)
                tokens += len(parts) - 1
            for part in parts:
                if _BEYOND_LATIN.search(part):
                    for word, n in Counter(self._pre_tokens(
                            self.tokenizer.normalizer.normalize_str(part))).items():
                        tokens += n if word in self.whole else n * self._merge(word)
                else:
                    tokens += self.runs.total(part.lower().split())
        return tokens


class _Runs(dict):
    """Tokens of runs seen before; forgets them all when there are too many."""

    def __init__(self, count):
        self.count = count

    def __missing__(self, run: str) -> int:
        count = self.count(run)
        if len(run) < 64:
            self[run] = count
        return count

    def total(self, runs: list[str]) -> int:
        if len(self) > REMEMBERED:
            self.clear()
        return sum(map(self.__getitem__, runs))


@functools.lru_cache(maxsize=4)
def whole_tokens(path: str) -> WholeTokens:
    return WholeTokens(path)


def count_tokens(docs: DataFrame, vocabulary: str, id_column: str = "doc_id",
                 text_column: str = "text", limit: int = 2048) -> DataFrame:
    """Per row: id, n_bytes (UTF-8), n_tokens, over_limit (more tokens than ``limit``).

    ``vocabulary`` is the path of a tokenizers file, the same on every executor.
    """
    def work(texts):
        counter = whole_tokens(vocabulary)
        counts = [counter.count(t) for t in texts]
        return [len((t or "").encode()) for t in texts], counts, [n > limit for n in counts]

    rows = docs.select(id_column, text_column)
    return map_texts(rows, StructType([
        StructField(id_column, docs.schema[id_column].dataType),
        StructField("n_bytes", LongType()), StructField("n_tokens", LongType()),
        StructField("over_limit", BooleanType())]), work)
