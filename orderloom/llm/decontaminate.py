"""Benchmark passages in documents, by a generalised suffix automaton of test items.

Test items are normalised to words, numbered, and entered in suffix automata: the smallest
automata that read every run of words of every item. Documents stream through them; at each
word the automaton gives the longest run ending there that an item holds. Where that is a
window (``window`` item words, or a whole shorter item) the words are hit.

No automaton grows with the number of items: a shard holds at most ``SHARD_WORDS`` item words,
and longer items are cut into overlapping parts that lose no window. Items are dealt by numbers, of
which there are as many as their words fill shards, so that the number of partitions adds none.
Tasks build the shards and store them. ``SHARDS_AT_ONCE`` of them, each broadcast with that bound,
are read in one pass over the documents, one after another per batch of rows; where there are
more, the rows go on to the next pass through the shared folder. Hits of several shards are
united by position. No document is shuffled.

A NULL or wordless text has no words; a NULL or wordless item has no window. Items are told
apart by id, so repeated ids count once; an item without id is the id "". Rows pass one for
one, repeated rows and NULL doc_ids alike. Texts are read whole.
"""

from __future__ import annotations

import itertools
import pickle
import re
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.pandas.types import to_arrow_schema

from ..session import scratch_dir
from .batches import fresh, slices

SHARD_WORDS = 200_000
SHARDS_AT_ONCE = 8
WORD = re.compile("[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
# The same words before A-Z are lower-cased, as Spark reads them.
RAW_WORD = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
_LOWER = {c: c + 32 for c in range(ord("A"), ord("Z") + 1)}


def words_of(text: str | None) -> list[str]:
    return WORD.findall((text or "").translate(_LOWER))


class Automaton:
    """Reads runs of item words. ``add`` every item, then ``finish`` before use.

    A state stands for runs that end at the same places of the items; the longest has ``length``
    words, and ``link`` leads to the state of the longest suffix that ends at more places.
    """

    def __init__(self, window: int):
        self.window = window
        self.number: dict[str, int] = {}
        self.next: list[dict[int, int]] = [{}]
        self.length, self.link = [0], [-1]
        self.pending: list[tuple[list[int], str, int]] = []

    def _grow(self, last: int, word: int) -> int:
        following = self.next
        known = following[last].get(word)
        if known is not None:
            if self.length[known] == self.length[last] + 1:
                return known
            return self._split(last, word, known)
        state = self._state(self.length[last] + 1, {})
        while last != -1 and word not in following[last]:
            following[last][word] = state
            last = self.link[last]
        if last == -1:
            self.link[state] = 0
        else:
            known = following[last][word]
            self.link[state] = known if self.length[known] == self.length[last] + 1 \
                else self._split(last, word, known)
        return state

    def _state(self, length: int, following: dict[int, int]) -> int:
        self.next.append(following)
        self.length.append(length)
        self.link.append(0)
        return len(self.next) - 1

    def _split(self, last: int, word: int, known: int) -> int:
        """A state for the shorter runs that ``known`` stood for, reached from ``last``."""
        state = self._state(self.length[last] + 1, dict(self.next[known]))
        self.link[state], self.link[known] = self.link[known], state
        while last != -1 and self.next[last].get(word) == known:
            self.next[last][word] = state
            last = self.link[last]
        return state

    def add(self, words: list[str], item: str, window: int) -> None:
        """Enter the words; the item holds every run of them as long as ``window``."""
        state, path = 0, []
        for text in words:
            word = self.number.setdefault(text, len(self.number))
            state = self._grow(state, word)
            path.append(word)
        self.pending.append((path, item, window))

    def finish(self) -> "Automaton":
        """Mark the states at which a window ends with the items that hold it."""
        self.marks: dict[tuple[int, int], set[str]] = {}
        for path, item, window in self.pending:
            for state, length in self._follow(path):
                if length >= window:
                    key = (self._at(state, window), window)
                    self.marks.setdefault(key, set()).add(item)
        self.windows = sorted({w for _, w in self.marks}, reverse=True)
        self.pending = []
        return self

    def _at(self, state: int, length: int) -> int:
        """The state of the last ``length`` words of a run read to ``state``."""
        while self.length[self.link[state]] >= length:
            state = self.link[state]
        return state

    def _follow(self, path: Iterable[int | None]) -> Iterator[tuple[int, int]]:
        """Per word: the state, and the longest run ending there that an item holds."""
        following, link, lengths = self.next, self.link, self.length
        state = length = 0
        for word in path:
            if word is None:
                state = length = 0
            else:
                while state and word not in following[state]:
                    state = link[state]
                    length = lengths[state]
                to = following[state].get(word)
                if to is None:
                    state = length = 0
                else:
                    state, length = to, length + 1
            yield state, length

    def hits(self, words: list[str]) -> tuple[list[tuple[int, int]], set[str]]:
        """Hit spans (start, end) in word positions, united, and the items whose windows occur."""
        spans: list[tuple[int, int]] = []
        items: set[str] = set()
        if not self.windows:
            return spans, items
        marks, windows, shortest = self.marks, self.windows, self.windows[-1]
        for i, (state, length) in enumerate(self._follow(map(self.number.get, words))):
            if length < shortest:
                continue
            longest = 0
            for window in windows:
                if window <= length and (found := marks.get((self._at(state, window), window))):
                    items |= found
                    longest = longest or window
            if longest:
                start = i + 1 - longest
                while spans and spans[-1][1] >= start:
                    start = min(start, spans.pop()[0])
                spans.append((start, i + 1))
        return spans, items


def _parts(words: list[str], window: int, most: int) -> list[list[str]]:
    """The words in parts of bounded length that overlap by all but one word of a window."""
    step = max(window, most // 8)
    return [words[i:i + step + window - 1]
            for i in range(0, max(1, len(words) - window + 1), step)]


def automata(items: Iterable[tuple[str, str | None]], window: int, most: int
             ) -> Iterator[Automaton]:
    """Automata of all items (id, text), one at a time, each of ``most`` words or one part."""
    automaton, size = Automaton(window), 0
    for item, text in items:
        words = words_of(text)
        if not words:
            continue
        size_of_window = min(window, len(words))
        for part in _parts(words, size_of_window, most):
            if size and size + len(part) > most:
                yield automaton.finish()
                automaton, size = Automaton(window), 0
            automaton.add(part, item, size_of_window)
            size += len(part)
    if size:
        yield automaton.finish()


def shards(spark: SparkSession, benchmark: DataFrame, window: int, id_column: str = "item_id",
           text_column: str = "text") -> DataFrame:
    """Stored automata of all items, pickled, one a row. Every task packs the items it is dealt;
    repeated items are one. All documents are read for every automaton, so tasks beyond those that
    the words fill are dealt nothing."""
    items = benchmark.select(F.coalesce(F.col(id_column).cast("string"), F.lit("")).alias("id"),
                             F.col(text_column).alias("text")).distinct()
    most = SHARD_WORDS
    words = items.agg(F.sum(F.regexp_count("text", F.lit(RAW_WORD)))).first()[0] or 0
    # Several are filled to nine tenths on average, so that few run over into a shard more.
    full = 1 if words <= most else -(-words * 10 // (9 * most))
    dealt = items.withColumn("shard", F.pmod(F.xxhash64("id", "text"), F.lit(full)))

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = (pair for batch in batches for pair in zip(*[c.to_pylist() for c in batch.columns]))
        for automaton in automata(rows, window, most):
            yield pa.RecordBatch.from_arrays(
                [pa.array([pickle.dumps(automaton)], pa.binary())], names=["automaton"])

    path = scratch_dir(spark, "automata")
    dealt.repartition(full, "shard").select("id", "text").mapInArrow(
        build, "automaton binary").write.parquet(path)
    return spark.read.schema("automaton binary").parquet(path)


def united(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    done: list[tuple[int, int]] = []
    for start, end in sorted(spans):
        if done and start <= done[-1][1]:
            done[-1] = (done[-1][0], max(end, done[-1][1]))
        else:
            done.append((start, end))
    return done


def without(text: str, spans: list[tuple[int, int]], shortest: int) -> str:
    """The text without spans of ``shortest`` or more words, from first to last word."""
    spans = [s for s in spans if s[1] - s[0] >= shortest]
    if not spans:
        return text
    at = [m.span() for m in WORD.finditer(text.translate(_LOWER))]
    kept, end = [], 0
    for first, after in spans:
        kept.append(text[end:at[first][0]])
        end = at[after - 1][1]
    return "".join(kept) + text[end:]


def _pass(rows: DataFrame, text: str, names: list[str], shared: list, cut: int | None
          ) -> DataFrame:
    """Rows with word count, spans and items brought up to date; with ``cut``, texts cut too."""
    schema, at = rows.schema, rows.columns.index(text)
    words_at, start_at, end_at, items_at = map(rows.columns.index, names)
    arrow = to_arrow_schema(schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = reader = None
        for batch in batches:
            texts, cuts = batch.column(at), list(slices(batch.column(at)))
            counts = [0] * len(texts)
            spans = [list(zip(*x)) for x in zip(*[batch.column(i).to_pylist()
                                                  for i in (start_at, end_at)])]
            items = [set(x) for x in batch.column(items_at).to_pylist()]
            # One at a time in memory, loaded once a batch; the one held is the first of the next.
            for k in sorted(range(len(shared)), key=lambda k: k != held) or [None]:
                if held != k:
                    reader, held = pickle.loads(shared[k].value), k
                for start, end in cuts:
                    part = texts.slice(start, end - start).to_pylist()
                    for i, text in enumerate(part, start):
                        words = words_of(text)
                        counts[i] = len(words)
                        if reader is not None:
                            found, holders = reader.hits(words)
                            spans[i] += found
                            items[i] |= holders
            for start, end in cuts:
                part = batch.slice(start, end - start)
                own = [united(x) for x in spans[start:end]]
                columns = {words_at: counts[start:end],
                           start_at: [[s for s, _ in x] for x in own],
                           end_at: [[e for _, e in x] for x in own],
                           items_at: [sorted(x) for x in items[start:end]]}
                if cut is not None:
                    columns[at] = [t if not x else without(t, x, cut)
                                   for t, x in zip(part.column(at).to_pylist(), own)]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(columns[i], arrow.field(i).type) if i in columns
                     else part.column(i).cast(arrow.field(i).type)
                     for i in range(len(arrow))], schema=arrow)

    return rows.mapInArrow(run, schema)


def mark(spark: SparkSession, docs: DataFrame, benchmark: DataFrame, window: int = 10,
         text_column: str = "text", cut: int | None = None) -> tuple[DataFrame, list[str]]:
    """``docs`` with four more columns, and their names: word count, starts and ends of hit
    spans in word positions, ids of items with occurring windows. With ``cut``, hit spans of so
    many words or more are taken out of the texts."""
    names = [fresh(docs, n) for n in ("n_words", "hit_starts", "hit_ends", "hit_items")]
    kinds = ["long", "array<int>", "array<int>", "array<string>"]
    rows = docs.withColumns({n: F.lit(0).cast(k) if k == "long" else F.array().cast(k)
                             for n, k in zip(names, kinds)})
    made = (r["automaton"] for r in shards(spark, benchmark, window).toLocalIterator())
    group = list(itertools.islice(made, SHARDS_AT_ONCE))
    while True:
        shared = [spark.sparkContext.broadcast(bytes(a)) for a in group]
        group = list(itertools.islice(made, SHARDS_AT_ONCE))
        rows = _pass(rows, text_column, names, shared, None if group else cut)
        if not group:
            return rows, names
        path = scratch_dir(spark, "decontaminate")
        rows.write.parquet(path)
        rows = spark.read.schema(rows.schema).parquet(path)
        for automaton in shared:
            automaton.unpersist()


def _hit(names: list[str]):
    return F.aggregate(F.zip_with(names[2], names[1], lambda e, s: e - s),
                       F.lit(0).cast("long"), lambda a, x: a + x)


def contamination(spark: SparkSession, docs: DataFrame, benchmark: DataFrame, window: int = 10,
                  id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """Per row: id, n_words, n_hit, n_items, items_sha256, contaminated, hit_spans.

    items_sha256 is of the item ids, sorted as strings and joined by commas (none: of "");
    hit_spans reads "start-end" by word positions, end excluded.
    """
    marked, names = mark(spark, docs.select(id_column, text_column), benchmark, window, text_column)
    spans = F.zip_with(names[1], names[2], lambda s, e: F.concat_ws("-", s.cast("string"),
                                                                    e.cast("string")))
    return marked.select(
        id_column, F.col(names[0]).alias("n_words"), _hit(names).alias("n_hit"),
        F.size(names[3]).cast("long").alias("n_items"),
        F.sha2(F.concat_ws(",", names[3]), 256).alias("items_sha256"),
        (F.size(names[1]) > 0).alias("contaminated"), F.concat_ws(",", spans).alias("hit_spans"))


def decontaminate(spark: SparkSession, docs: DataFrame, benchmark: DataFrame, window: int = 10,
                  max_coverage: float = 0.5, text_column: str = "text") -> DataFrame:
    """``docs`` without hit spans of ``window`` words or more, and without the documents of
    whose words more than ``max_coverage`` were hit. Shorter items are cut out as they are."""
    marked, names = mark(spark, docs, benchmark, window, text_column, cut=1)
    return marked.where(_hit(names) <= F.col(names[0]) * F.lit(max_coverage)).drop(*names)
