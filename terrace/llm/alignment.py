"""Tokens of two tokenizers over the same bytes: common ends, groups, overlaps and how usual each link is.

Ends are byte offsets, both lists rise. The shorter list drives: for each of its ends the longer one is
searched by steps that double, then by halving inside the last step. Common ends cut both lists into
groups; inside a group the ranks of a token's two ends in the other list give the range of tokens that
it overlaps.

Both tokenizers end a token wherever a space follows anything but white space, so texts are cut there
and each distinct piece is aligned once in a task; a text is the sequence of its pieces.
"""

from __future__ import annotations

import hashlib
import json
import os
import re
from collections.abc import Iterator, Sequence
from functools import lru_cache
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from terrace.llm.arrays import slices
from terrace.session import scratch_path, write_table

#: Where both tokenizers end a token: ahead of a space that follows anything but white space. A last space
#: stays with what is ahead of it, since the piece tokenizer has no token for an empty text.
CUT = re.compile(r"(?<=\S)(?= .)", re.DOTALL)
#: Pieces that a worker keeps aligned (the first ones, among which the usual are), and their largest length in characters.
KEPT_PIECES, KEPT_CHARS = 250_000, 64
ENCODE_AT_ONCE = 2_000
#: Ends that start their search from the same place.
STRIDE = 64
LINK_BITS = 32


def gallop(short: np.ndarray, long: np.ndarray) -> np.ndarray:
    """For each end of ``short``, how many ends of ``long`` lie ahead of it; both rise.

    Every ``STRIDE``-th end goes on from where the one before it was found; the ends between start there
    and take their steps side by side.
    """
    n, begin, at = len(long), [], 0
    for end in short[::STRIDE].tolist():
        step, low, high = 1, at, at
        while high < n and long[high] < end:
            low, high = high + 1, high + step
            step *= 2
        at = low + int(np.searchsorted(long[low : min(high, n)], end))
        begin.append(at)
    low = np.repeat(np.array(begin, dtype=np.int64), STRIDE)[: len(short)]
    high, going, step = low.copy(), np.arange(len(short)), 1
    while len(going):
        going = going[high[going] < n]
        going = going[long[high[going]] < short[going]]
        low[going] = high[going] + 1
        high[going] += step
        step *= 2
    high = np.minimum(high, n)
    going = np.flatnonzero(low < high)
    while len(going):
        middle = (low[going] + high[going]) // 2
        ahead = long[middle] < short[going]
        low[going[ahead]] = middle[ahead] + 1
        high[going[~ahead]] = middle[~ahead]
        going = going[low[going] < high[going]]
    return low


def align(a: Sequence[int], b: Sequence[int]) -> tuple[np.ndarray, np.ndarray]:
    """Where the groups end (places behind, in ``a`` and in ``b``), and the overlapping pairs of places in order.

    Both lists rise and end at the same offset; two empty ones have no groups.
    """
    a, b = np.asarray(a, dtype=np.int64), np.asarray(b, dtype=np.int64)
    short, long = (a, b) if len(a) <= len(b) else (b, a)
    if not len(short):
        return np.zeros((0, 2), dtype=np.int64), np.zeros((0, 2), dtype=np.int64)
    rank = gallop(short, long)
    common = long[rank] == short
    ends = np.stack((np.flatnonzero(common), rank[common]), axis=1) + 1
    # a token reaches from the one that its start lies in to the one that its end lies in
    first = np.concatenate(([0], rank[:-1] + common[:-1]))
    count = rank - first + 1
    behind = np.cumsum(count)
    pairs = np.stack((np.repeat(np.arange(len(short)), count), np.arange(behind[-1]) - np.repeat(behind - count - first, count)), axis=1)
    return (ends, pairs) if short is a else (ends[:, ::-1], pairs[:, ::-1])


class Tokens:
    """Both tokenizers in a worker, and the pieces aligned so far."""

    def __init__(self, byte_level: str, pieces: str):
        # Spark runs the tasks side by side
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        import sentencepiece
        from tokenizers import Tokenizer

        self.a = Tokenizer.from_file(byte_level)
        self.a.encode_special_tokens = True
        self.b = sentencepiece.SentencePieceProcessor(model_file=pieces)
        letters = byte_letters()
        with open(byte_level, encoding="utf-8") as f:
            read = json.load(f)
        self.a_bytes = [b""] * self.a.get_vocab_size()
        for token, i in read["model"]["vocab"].items():
            self.a_bytes[i] = bytes(letters.get(c, 0) for c in token)
        self.b_bytes = [
            bytes([int(p[3:5], 16)]) if self.b.is_byte(i) else p.replace("▁", " ").encode()
            for i, p in enumerate(self.b.id_to_piece(k) for k in range(self.b.get_piece_size()))
        ]
        self.a_sizes, self.b_sizes = (np.array([len(t) for t in x], dtype=np.int64) for x in (self.a_bytes, self.b_bytes))
        count = range(max(len(self.a_bytes), len(self.b_bytes)))
        self.names, self.names_bar, self.names_end = (np.array([f"{i}{sign}" for i in count], dtype=object) for sign in ",|;")
        # a piece that goes on behind a space would join what CUT parts
        self.whole = any("▁" in p.lstrip("▁") for p in (self.b.id_to_piece(k) for k in range(self.b.get_piece_size())))
        self.kept: dict[str, tuple] = {}

    def cut(self, text: str) -> list[str]:
        """The pieces of a space and the text; none for an empty text."""
        if not text:
            return []
        return [f" {text}"] if self.whole else CUT.split(f" {text}")

    def aligned(self, pieces: list[str]) -> list[tuple]:
        """For each piece: numbers of tokens of both, groups as written, links as 64-bit pairs of ids; ``None`` where bytes differ."""
        found = list(map(self.kept.get, pieces, repeat(0)))
        new = [p for p, k in zip(pieces, found, strict=True) if k == 0]
        # pieces in a row are a text of their own, as long as none of them ends in white space
        chained = [p for p in new if not p[-1].isspace()]
        out: dict[str, tuple | None] = {}
        for at in range(0, len(chained), ENCODE_AT_ONCE):
            self.encode(chained[at : at + ENCODE_AT_ONCE], out)
        for piece in new:
            if piece[-1].isspace():
                self.encode([piece], out)
        room = [p for p in new if len(p) <= KEPT_CHARS][: max(KEPT_PIECES - len(self.kept), 0)]
        self.kept.update((p, out[p]) for p in room)
        return [out[p] if k == 0 else k for p, k in zip(pieces, found, strict=True)]

    def encode(self, pieces: list[str], out: dict[str, tuple | None]) -> None:
        """Adds each of the pieces, taken as one text, to ``out``."""
        text = "".join(pieces)
        # the piece tokenizer puts the first space itself
        a_ids, b_ids = self.a.encode(text, add_special_tokens=False).ids, self.b.encode(text[1:])
        same = b"".join([self.a_bytes[i] for i in a_ids]) == b"".join([self.b_bytes[i] for i in b_ids]) == text.encode()
        sizes = np.cumsum([len(p.encode()) for p in pieces])
        if same:
            a, b = np.array(a_ids, dtype=np.int64), np.array(b_ids, dtype=np.int64)
            a_ends, b_ends = np.cumsum(self.a_sizes[a]), np.cumsum(self.b_sizes[b])
            a_at, b_at = np.searchsorted(a_ends, sizes), np.searchsorted(b_ends, sizes)
            same = bool((a_ends[a_at] == sizes).all() and (b_ends[b_at] == sizes).all())
        if not same:
            # some piece does not give back its bytes: each is looked at alone
            if len(pieces) == 1:
                out[text] = None
            for piece in pieces if len(pieces) > 1 else ():
                self.encode([piece], out)
            return
        ends, pairs = align(a_ends, b_ends)
        codes = a[pairs[:, 0]] << LINK_BITS | b[pairs[:, 1]]
        # ids in the order written, each with the sign behind it: those of a in a group, then those of b
        names = np.empty(len(a) + len(b), dtype=object)
        group_a, group_b = np.searchsorted(ends[:, 0], np.arange(len(a)), "right"), np.searchsorted(ends[:, 1], np.arange(len(b)), "right")
        before = np.concatenate(([0], ends[:-1, 1]))
        place_a, place_b = np.arange(len(a)) + before[group_a], np.arange(len(b)) + ends[group_b, 0]
        names[place_a], names[place_b] = self.names[a], self.names[b]
        names[place_a[ends[:, 0] - 1]] = self.names_bar[a[ends[:, 0] - 1]]
        names[place_b[ends[:, 1] - 1]] = self.names_end[b[ends[:, 1] - 1]]
        a_at, b_at = a_at + 1, b_at + 1
        links = 8 * np.searchsorted(pairs[:, 0], a_at)
        bounds = np.stack((a_at, b_at, np.searchsorted(ends[:, 0], a_at) + 1, links), axis=1).tolist()
        words, raw = names.tolist(), codes.tobytes()
        p = q = g = n = 0
        for piece, (p_, q_, g_, n_) in zip(pieces, bounds, strict=True):
            out[piece] = p_ - p, q_ - q, g_ - g, "".join(words[p + q : p_ + q_])[:-1], raw[n:n_]
            p, q, g, n = p_, q_, g_, n_


@lru_cache(1)
def tokens_of(byte_level: str, pieces: str) -> Tokens:
    """The tokenizers of this worker, kept from task to task."""
    return Tokens(byte_level, pieces)


def byte_letters() -> dict[str, int]:
    """The byte that each letter of a byte-level vocabulary stands for: visible Latin-1 letters stand for
    themselves, the other bytes in order for the letters from 256 on."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + k): b for k, b in enumerate(rest)}


def per_text(docs: DataFrame, key: str, text: str, byte_level: str, pieces: str) -> DataFrame:
    """Counts and groups of every text, and its distinct pairs of linked ids with how often each occurs in it."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokens = tokens_of(byte_level, pieces)
        for batch in slices(batches):
            texts = [tokens.cut(t or "") for t in batch.column("text").to_pylist()]
            number: dict[str, int] = {}
            at = [[number.setdefault(p, len(number)) for p in t] for t in texts]
            known = tokens.aligned(list(number))
            lost = np.array([k is None for k in known], dtype=bool)
            # a text with a piece whose bytes differ has no tokens at all
            at = [[] if len(t) and lost[t].any() else t for t in at]
            owner, flat = np.repeat(np.arange(len(at)), [len(t) for t in at]), np.array([p for t in at for p in t], dtype=np.int64)
            sizes = np.array([(k[0], k[1], k[2], len(k[4]) // 8) if k else (0, 0, 0, 0) for k in known], dtype=np.int64).reshape(-1, 4)
            sums = [np.bincount(owner, weights=sizes[flat, c], minlength=len(at)).astype(np.int64) for c in range(4)]
            groups = [hashlib.sha256(";".join([known[p][3] for p in t]).encode()).digest() if t else None for t in at]
            offset, links = number_of_links(known, flat, owner, sizes[:, 3], len(at))
            pair_list = pa.ListArray.from_arrays(offset, pa.array(links[0]))
            n_list = pa.ListArray.from_arrays(offset, pa.array(links[1]))
            yield pa.RecordBatch.from_arrays(
                [batch.column("key"), *(pa.array(s) for s in sums), pa.array(groups, pa.binary()), pair_list, n_list],
                ["key", "n_a", "n_b", "n_groups", "n_links", "groups", "pairs", "times"],
            )

    kind = docs.schema[key].dataType.simpleString()
    rows = docs.select(F.col(key).alias("key"), F.col(text).cast("string").alias("text"))
    return rows.mapInArrow(run, f"key {kind}, n_a long, n_b long, n_groups long, n_links long, groups binary, pairs array<long>, times array<int>")


def number_of_links(known: list, flat: np.ndarray, owner: np.ndarray, sizes: np.ndarray, n: int) -> tuple[pa.Array, tuple[np.ndarray, np.ndarray]]:
    """Offsets of the texts, and their distinct pairs with how often each occurs."""
    codes, index = np.unique(np.frombuffer(b"".join([k[4] for k in known if k]), dtype=np.int64), return_inverse=True)
    per = sizes[flat]
    ends = np.cumsum(per)
    total = int(ends[-1]) if len(ends) else 0
    begins = np.cumsum(sizes) - sizes
    places = np.arange(total) - np.repeat(ends - per, per) + np.repeat(begins[flat], per)
    mixed = np.sort(np.repeat(owner, per) * max(len(codes), 1) + index[places])
    first = np.flatnonzero(np.concatenate((np.ones(min(total, 1), dtype=bool), mixed[1:] != mixed[:-1])))
    times = np.diff(np.concatenate((first, [total]))).astype(np.int32)
    text_of, code = np.divmod(mixed[first], max(len(codes), 1))
    return pa.array(np.searchsorted(text_of, np.arange(n + 1)).astype(np.int32)), (codes[code], times)


def pair_counts(aligned: DataFrame) -> DataFrame:
    """``pair``, ``held`` (texts that hold it linked) and ``best``: is no pair of its first id held by more."""
    held = aligned.select(F.explode("pairs").alias("pair")).groupBy("pair").agg(F.count(F.lit(1)).alias("held"))
    of = F.shiftright("pair", LINK_BITS).alias("a_id")
    most = held.groupBy(of).agg(F.max("held").alias("most"))
    return held.withColumn("a_id", of).join(most, "a_id").select("pair", "held", (F.col("held") == F.col("most")).alias("best"))


def align_texts(docs: DataFrame, byte_level: str, pieces: str, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``key``, ``n_a``, ``n_b``, ``n_groups``, ``n_links``, ``n_best``, ``count_sum`` and ``groups_sha256`` of every document.

    ``byte_level`` is a byte-level vocabulary of the tokenizers library, ``pieces`` a sentencepiece model that
    puts a space ahead of a text. A link counts as often as its ids overlap in the text; how usual a pair of
    ids is counts each row once. Null and empty texts, and those whose tokens do not give back their bytes,
    have zeros and an empty string. Null keys and repeated rows are kept, extra columns left out.
    """
    spark = docs.sparkSession
    rows = per_text(docs, key, text, byte_level, pieces).withColumn("row", F.monotonically_increasing_id())
    aligned = write_table(rows, scratch_path(spark, "align-texts"))
    counts = write_table(pair_counts(aligned), scratch_path(spark, "align-pairs"))
    zipped = F.explode(F.arrays_zip(F.col("pairs").alias("pair"), F.col("times").alias("times"))).alias("link")
    links = aligned.select("row", zipped).select("row", "link.pair", "link.times")
    # each row of the counts is once in its partition, so the table of a partition is small; the texts stay unsorted
    met = links.join(counts.hint("shuffle_hash"), "pair")
    scores = met.groupBy("row").agg(F.sum(F.when(F.col("best"), F.col("times")).otherwise(0)).alias("n_best"), F.sum(F.col("times") * F.col("held")).alias("count_sum"))
    out = aligned.drop("pairs", "times").join(scores, "row", "left")
    zero = F.lit(0).cast("long")
    return out.select(
        F.col("key").alias(key), "n_a", "n_b", "n_groups", "n_links",
        F.coalesce("n_best", zero).alias("n_best"), F.coalesce("count_sum", zero).alias("count_sum"),
        F.coalesce(F.lower(F.hex("groups")), F.lit("")).alias("groups_sha256"),
    )
