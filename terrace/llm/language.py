"""Language of a text by cross-parsing entropy.

Labelled text of each language becomes a suffix automaton. A text is parsed into phrases, each the
longest stretch that occurs in a language's labelled text; the language that needs the fewest
phrases per byte wins. Texts are cut into pieces of fixed length that are parsed side by side, so a
task steps through thousands of pieces at once; a cut adds one phrase at most, for each language
alike.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from terrace.llm.arrays import slices, utf8

#: Bytes of labelled text kept for each language, and for all languages together.
TRAIN_BYTES, TRAIN_BYTES_ALL = 48_000, 1_536_000
#: Bytes taken from any one labelled document.
DOCUMENT_BYTES = 600
#: Bytes of a piece.
PIECE = 256
UNKNOWN = "und"


def fold_table() -> np.ndarray:
    """Byte to symbol: letters in lower case, all digits alike, all ASCII marks alike, other bytes as they are."""
    table = np.arange(256)
    table[0x41:0x5B] += 0x20
    table[0x30:0x3A] = 0x30
    marks = [b for b in range(128) if not chr(b).isalnum()]
    table[marks] = 0x20
    return table.astype(np.uint8)


FOLD = fold_table()


@dataclass
class Automaton:
    """Moves of one language: from state and symbol, as one number, to a state. State 1 is the root, 0 is none."""

    language: str
    size: int
    at: np.ndarray
    to: np.ndarray

    def table(self) -> np.ndarray:
        """``table[state * width + symbol]`` is the next state, or 0 where the stretch does not go on.

        Nearly all of it is 0, so it is made for each slice of texts and not kept for every language.
        """
        step = np.zeros(self.size, dtype=np.int32)
        step[self.at] = self.to
        return step


def build_automaton(texts: list[bytes]) -> list[dict[int, int]]:
    """Transitions of the suffix automaton of the texts; no stretch runs over the end of one."""
    links, lengths, moves = [-1], [0], [{}]

    def extend(last: int, symbol: int) -> int:
        if symbol in moves[last]:
            onward = moves[last][symbol]
            if lengths[onward] == lengths[last] + 1:
                return onward
            return split(last, symbol, onward)
        new = len(moves)
        links.append(0), lengths.append(lengths[last] + 1), moves.append({})
        at = last
        while at != -1 and symbol not in moves[at]:
            moves[at][symbol] = new
            at = links[at]
        if at != -1:
            onward = moves[at][symbol]
            links[new] = onward if lengths[onward] == lengths[at] + 1 else split(at, symbol, onward)
        return new

    def split(at: int, symbol: int, onward: int) -> int:
        clone = len(moves)
        links.append(links[onward]), lengths.append(lengths[at] + 1), moves.append(dict(moves[onward]))
        links[onward] = clone
        while at != -1 and moves[at].get(symbol) == onward:
            moves[at][symbol] = clone
            at = links[at]
        return clone

    for text in texts:
        last = 0
        for symbol in text:
            last = extend(last, symbol)
    return moves


class Parser:
    """All languages' automata over one alphabet of symbols seen in the labelled texts."""

    def __init__(self, samples: dict[str, list[bytes]]) -> None:
        folded = {x: [FOLD[np.frombuffer(t, dtype=np.uint8)].tobytes() for t in texts] for x, texts in sorted(samples.items())}
        seen = np.zeros(256, dtype=bool)
        for texts in folded.values():
            for t in texts:
                seen[np.frombuffer(t, dtype=np.uint8)] = True
        # symbol 0 pads, symbol 1 is any byte never seen
        names = np.where(seen, np.cumsum(seen) + 1, 1).astype(np.uint8)
        self.symbols = names[FOLD]
        self.width = int(seen.sum()) + 2
        self.automata = []
        for language, texts in folded.items():
            moves = build_automaton([names[np.frombuffer(t, dtype=np.uint8)].tobytes() for t in texts])
            at = [state * self.width + symbol for state, onward in enumerate(moves, 1) for symbol in onward]
            to = [state + 1 for onward in moves for state in onward.values()]
            self.automata.append(Automaton(language, (len(moves) + 1) * self.width, np.array(at, dtype=np.int64), np.array(to, dtype=np.int32)))

    def phrases(self, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        """Phrases of each text (row) in each language (column)."""
        lengths = np.diff(offsets)
        pieces = -(-lengths // PIECE)
        owner = np.repeat(np.arange(len(lengths)), pieces)
        begin = np.repeat(offsets[:-1], pieces) + PIECE * (np.arange(len(owner)) - np.repeat(np.cumsum(pieces) - pieces, pieces))
        size = np.minimum(begin + PIECE, offsets[1:][owner]) - begin
        order = np.argsort(-size, kind="stable")
        begin, size = begin[order], size[order]
        found = np.zeros((len(lengths), len(self.automata)))
        # pieces still running at each step; longer pieces come first
        running = np.searchsorted(-size, -np.arange(PIECE), side="left") if len(size) else []
        symbols = self.symbols[data]
        columns = []
        for t in range(PIECE):
            n = int(running[t]) if len(size) else 0
            if not n:
                break
            columns.append(symbols[begin[:n] + t].astype(np.int32))
        for j, automaton in enumerate(self.automata):
            step, width = automaton.table(), self.width
            state = np.ones(len(begin), dtype=np.int32)
            count = np.zeros(len(begin), dtype=np.int32)
            for symbol in columns:
                n = len(symbol)
                onward = step[state[:n] * width + symbol]
                ended = np.flatnonzero(onward == 0)
                if len(ended):
                    # the phrase ends ahead of this byte; a byte that no text has is a phrase of its own
                    again = step[width + symbol[ended]]
                    count[ended] += (state[ended] != 1).astype(np.int32) + (again == 0)
                    onward[ended] = np.where(again == 0, 1, again)
                state[:n] = onward
            found[:, j] = np.bincount(owner[order], weights=count + (state != 1.0), minlength=len(lengths))
        return found

    def predict(self, texts: pa.Array) -> tuple[list[str], np.ndarray]:
        """The language and a score from 0 to 1: how far the phrases of the next language exceed those of the best."""
        data, offsets = utf8(texts)
        if not self.automata:
            return [UNKNOWN] * len(texts), np.zeros(len(texts))
        counts = self.phrases(data, offsets)
        best = counts.argmin(axis=1)
        least = counts[np.arange(len(best)), best]
        others = counts.copy()
        others[np.arange(len(best)), best] = np.inf
        second = others.min(axis=1)
        with np.errstate(divide="ignore", invalid="ignore"):
            score = np.where(np.isinf(second), 1.0, 1.0 - least / second)
        letters = pc.match_substring_regex(texts.fill_null("").cast(pa.large_string()), r"\p{L}").to_numpy(zero_copy_only=False)
        names = [self.automata[b].language if x else UNKNOWN for b, x in zip(best.tolist(), letters.tolist(), strict=True)]
        return names, np.where(letters, np.clip(np.nan_to_num(score), 0, 1), 0.0)


def sample_labelled(docs: DataFrame, label: str = "lang", key: str = "doc_id", text: str = "text") -> dict[str, list[bytes]]:
    """A bounded sample of labelled text: up to TRAIN_BYTES a language, in pieces of DOCUMENT_BYTES.

    Rows are drawn by a hash of key and text, at a rate that their number sets, so that reruns agree
    and only the sample reaches the driver.
    """
    labelled = docs.filter(F.col(label).isNotNull() & (F.length(F.trim(text)) > 0))
    totals = labelled.groupBy(label).agg(F.count(F.lit(1)).alias("n")).collect()
    if not totals:
        return {}
    budget = max(2_000, min(TRAIN_BYTES, TRAIN_BYTES_ALL // len(totals)))
    most = -(-4 * budget // DOCUMENT_BYTES)
    rate = F.lit(None).cast("double")
    for row in totals:
        rate = F.when(F.col(label) == row[label], F.lit(min(1.0, most / row["n"]))).otherwise(rate)
    drawn = F.pmod(F.xxhash64(F.lit("language"), key, text), F.lit(1_000_003))
    picked = labelled.filter(drawn < rate * 1_000_003).select(F.col(label).alias("label"), drawn.alias("drawn"), F.col(text).alias("text"))
    # a stretch from the middle, cut at the start of words
    cut = picked.withColumn("text", F.substring("text", F.greatest(F.lit(1), (F.length("text") / 3).cast("int")), F.lit(DOCUMENT_BYTES)))
    samples: dict[str, list[bytes]] = {row[label]: [] for row in totals}
    used = dict.fromkeys(samples, 0)
    for row in sorted(cut.collect(), key=lambda r: (r["label"], r["drawn"], r["text"])):
        piece = row["text"].encode()[: budget - used[row["label"]]]
        samples[row["label"]].append(piece)
        used[row["label"]] += len(piece)
    return {x: [t for t in texts if t] for x, texts in samples.items()}


def detect_language(docs: DataFrame, samples: dict[str, list[bytes]], text: str = "text", keep: list[Column] | None = None) -> DataFrame:
    """``keep`` columns of each document (all but the text by default) with ``lang_pred`` and ``score``.

    ``und`` with score 0 where the text is null or has no letter, and where no label was learned. Ties
    go to the language first by name. The samples travel to the tasks and are built there once a worker.
    """
    kept = [F.col(c) for c in docs.columns if c not in (text, "lang_pred", "score")] if keep is None else keep
    rows = docs.select(*kept, F.col(text).cast("string").alias("__text"))
    names = rows.columns[:-1]
    shared = docs.sparkSession.sparkContext.broadcast(samples)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parser = parser_of(shared)
        for batch in slices(batches, "__text"):
            languages, scores = parser.predict(batch.column("__text"))
            columns = [batch.column(c) for c in range(len(names))]
            yield pa.RecordBatch.from_arrays([*columns, pa.array(languages, pa.string()), pa.array(scores)], [*names, "lang_pred", "score"])

    schema = rows.drop("__text").withColumns({"lang_pred": F.lit(""), "score": F.lit(0.0)}).schema
    for field in schema.fields:
        field.nullable = True
    return rows.mapInArrow(run, schema)


def keep_known(docs: DataFrame, samples: dict[str, list[bytes]], text: str = "text", min_score: float = 0.0) -> DataFrame:
    """The rows of ``docs`` that have a language, with a score of ``min_score`` or more; their columns as they are."""
    shared = docs.sparkSession.sparkContext.broadcast(samples)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parser = parser_of(shared)
        for batch in slices(batches, text):
            languages, scores = parser.predict(batch.column(text))
            yield batch.filter(pa.array((np.array(languages) != UNKNOWN) & (scores >= min_score)))

    return docs.mapInArrow(run, docs.schema)


_PARSERS: dict[int, Parser] = {}


def parser_of(shared) -> Parser:
    """One parser a worker, however many tasks it runs."""
    samples = shared.value
    key = hash(tuple((x, tuple(t)) for x, t in sorted(samples.items())))
    if key not in _PARSERS:
        _PARSERS.clear()
        _PARSERS[key] = Parser(samples)
    return _PARSERS[key]
