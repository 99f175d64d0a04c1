"""Line dedup by winnowing: one line of every window of lines, the minimum in the
order of (longest, smallest hash), is a fingerprint, so two texts that share a run of MIN_WORDS words in whole lines share
one. Passages that aren't cut at line ends are found in the same way over words: the
minimum of every window of SHINGLE_WORDS-grams is a fingerprint.

Positions of a fingerprint are joined with its first one, the source, and the match is
extended both ways on the hashes of the source's words: windows that hold the fingerprint
and agree with the source word by word are later occurrences and go. A window that
doesn't agree with the source may still repeat another occurrence of the fingerprint;
then that one doesn't agree with the source either. So in a second round these windows
alone, by the hash of all of their words, are fingerprints; what both rounds delete is
every run and passage but its first occurrence."""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from mesonlab.llm.common import mix, power_tables, prepare, table, word_hashes, word_starts, written

#: Words that a repeated run has at least.
MIN_WORDS = 25
#: Words that a repeated passage has at least, wherever its lines end; and those of the
#: grams that its fingerprints are taken from.
PASSAGE_WORDS, SHINGLE_WORDS = 50, 16
#: Keys of documents that may be broadcast (24 bytes each), deleted runs with them (16 bytes
#: each), and first places of fingerprints (16 bytes each); more are joined by a shuffle.
BROADCAST_KEYS, BROADCAST_RUNS, BROADCAST_PRINTS = 500_000, 1_000_000, 2_000_000
#: Words that are compared in a step (some 80 bytes each).
COMPARED = 1 << 20
_WORD = re.compile(r"[^\x20\x09-\x0D]+")
_WEIGHT = np.random.default_rng(5).integers(1, 1 << 63, 1 << 12, dtype=np.uint64) | np.uint64(1)
#: Told apart in the fingerprints: lines and passages.
_LINE, _PASSAGE = np.uint64(0x5851F42D4C957F2D), np.uint64(0x14057B7EF767814F)


def lines(text: str | None) -> list[str]:
    """A text cut into lines: a line ends at a line break or after a word that ends in
    a sentence mark; it starts at its first word (the first one at the text's start)
    and the white space after it belongs to it. A text without words has no line."""
    words = list(_WORD.finditer(text or ""))
    starts = [0] + [b.start() for a, b in zip(words, words[1:]) if a.group()[-1] in ".!?" or "\n" in text[a.end():b.start()]] if words else []
    return [text[s:e] for s, e in zip(starts, [*starts[1:], len(text or "")])]


def line_hashes(texts) -> Iterator[tuple[int, np.ndarray, np.ndarray, np.ndarray]]:
    """(first text, hashes and word counts of lines, line offsets of the texts) for groups
    of texts. White space and the case of A-Z don't count."""
    for first, _, _, hashes, size, offsets in _hashed(texts):
        yield first, hashes, size, offsets


def _hashed(texts) -> Iterator[tuple[int, np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """As line_hashes, with the words' hashes and offsets after the first text."""
    ends: list[np.ndarray] = []
    for first, hashes, offsets in word_hashes(texts, "nonspace", ends):
        last = np.concatenate(ends)
        ends.clear()
        last[offsets[1:][offsets[1:] > offsets[:-1]] - 1] = True
        start = np.concatenate(([0], np.flatnonzero(last)[:-1] + 1)) if len(hashes) else np.zeros(0, np.int64)
        size = np.diff(np.append(start, len(hashes)))
        place = np.arange(len(hashes)) - np.repeat(start, size)
        spread = hashes * _WEIGHT[place % len(_WEIGHT)] * (np.uint64(2) * (place // len(_WEIGHT)).astype(np.uint64) + np.uint64(1))
        yield first, hashes, offsets, mix(np.add.reduceat(spread, start) if len(start) else spread), size, np.searchsorted(start, offsets)


def windows(words: np.ndarray, offsets: np.ndarray, min_words: int) -> np.ndarray:
    """(first, last) of the shortest runs of at least ``min_words`` words that start,
    and that end, at each line and lie inside its text; each run once."""
    total = np.concatenate(([0], np.cumsum(words)))
    end = np.searchsorted(total, total[:-1] + min_words, "left")
    start = np.searchsorted(total, total[1:] - min_words, "right") - 1
    n = np.arange(len(words))
    lo, hi = np.repeat(offsets[:-1], np.diff(offsets)), np.repeat(offsets[1:], np.diff(offsets))
    ahead, back = end <= hi, (start >= lo) & (start >= 0)
    code = np.concatenate([(n << 32 | (end - 1))[ahead], (start << 32 | n)[back]])
    code.sort(kind="stable")  # two ascending halves, which this sort merges
    code = code[np.append(True, code[1:] != code[:-1])[:len(code)]]
    return np.stack([code >> 32, code & 0xFFFFFFFF], 1)


def _lowest(h: np.ndarray, window: int) -> np.ndarray:
    """Position of the (first) smallest value of every ``window`` consecutive ones."""
    at, span = np.arange(len(h)), 1
    if len(h) < window:
        return at[:0]
    while span < window:
        step = min(span, window - span)
        at = np.where(h[step:] < h[:-step], at[step:], at[:-step])
        h = np.minimum(h[step:], h[:-step])
        span += step
    return at


def run_hashes(hashes: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Hashes of the runs from ``start`` up to ``end``: a polynomial of their members, from
    running sums, so the cost doesn't follow the runs' lengths."""
    up, down = power_tables(len(hashes) + 1)
    total = np.concatenate((np.zeros(1, np.uint64), np.cumsum(hashes * up[:-1])))
    return mix((total[end] - total[start]) * down[start] + (end - start).astype(np.uint64))


def _passages(hashes: np.ndarray, passage: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the grams that fingerprints are taken from, and the position of the
    fingerprint of each window of ``passage`` words."""
    size = min(SHINGLE_WORDS, passage)
    begin = np.arange(max(len(hashes) - size + 1, 0))
    grams = run_hashes(hashes, begin, begin + size)
    return grams, _lowest(grams, passage - size + 1)


def _keyed(docs: DataFrame) -> tuple[DataFrame, DataFrame | None]:
    """(num, text): every document once, with numbers below 2^32 in the order of id, null ids
    first, and of the text's hash where ids repeat; and (k, tie, num) of the documents, or None
    where ids are such numbers themselves."""
    kind = docs.schema["doc_id"].dataType
    whole = isinstance(kind, (T.ByteType, T.ShortType, T.IntegerType, T.LongType))
    ends = [F.min("doc_id"), F.max("doc_id")] if whole else [F.lit(-1), F.lit(-1)]
    rows, ids, low, high = docs.agg(F.count(F.lit(1)), F.count_distinct("doc_id"), *ends).first()
    if not rows or whole and rows == ids and low >= 0 and high < 1 << 32:
        return docs.select(F.col("doc_id").cast("long").alias("num"), "text"), None
    one = docs.select("doc_id", "text", _key(), F.xxhash64("text").alias("tie"))
    keys = written(one.select("doc_id", "k", "tie").distinct().sort("doc_id", "tie").select("k", "tie", F.monotonically_increasing_id().alias("at")), "numbers")
    part, row = F.shiftright("at", 33), F.col("at").bitwiseAND((1 << 33) - 1)
    sizes = dict(keys.groupBy(part.alias("p")).agg(F.max(row)).collect())  # a row per partition of the sort
    before, start = [], 0
    for p in range(max(sizes) + 1):
        before.append(start)
        start += sizes[p] + 1 if p in sizes else 0
    keys = keys.select("k", "tie", (F.element_at(F.array(*[F.lit(n).cast("long") for n in before]), part.cast("int") + 1) + row).alias("num"))
    found = one.join(F.broadcast(keys) if start <= BROADCAST_KEYS else keys, ["k", "tie"]).select("num", "text")
    return (found.dropDuplicates(["num"]) if start < rows else found), keys


def _key():
    return F.xxhash64(F.col("doc_id").cast("string"), F.col("doc_id").isNull()).alias("k")


PRINTS = "fp long, num long, line boolean, pos int, lo int, hi int"


def _fingerprints(keyed: DataFrame, min_words: int, passage: int | None) -> DataFrame:
    """Fingerprints of lines and, if asked for, of passages: ``pos`` is the fingerprint's first
    word, ``lo`` to ``hi`` the words of all windows that chose it."""
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first, single, ends, hashes, words, offsets in _hashed(x.as_py() for x in batch.column(1)):
                start = np.concatenate(([0], np.cumsum(words)))
                runs = windows(words, offsets, min_words)
                best = _longest(runs, words, hashes)
                order = np.argsort(best, kind="stable")
                edge = np.flatnonzero(np.diff(best[order], prepend=-1) != 0)
                chosen = best[order][edge]
                lo, hi = (np.minimum.reduceat(start[runs[order, 0]], edge), np.maximum.reduceat(start[runs[order, 1] + 1], edge)) if len(edge) else (chosen, chosen)
                found = [(True, mix(hashes[chosen] ^ _LINE), start[chosen], lo, hi)]
                if passage:
                    grams, low = _passages(single, passage)
                    begin = np.arange(len(low))
                    inside = begin + passage <= ends[np.searchsorted(ends, begin, side="right")]
                    begin, low = begin[inside], low[inside]
                    edge = np.flatnonzero(np.append(True, np.diff(low) != 0))[:len(low)]
                    found.append((False, mix(grams[low[edge]] ^ _PASSAGE), low[edge], begin[edge], begin[np.append(edge[1:], len(low)) - 1] + passage if len(low) else low))
                for line, prints, pos, lo, hi in found:
                    text = np.searchsorted(ends, pos, side="right") - 1
                    yield pa.RecordBatch.from_arrays([pa.array(prints.view(np.int64)), batch.column(0).take(pa.array(first + text)), pa.array(np.full(len(prints), line)),
                                                      *[pa.array((x - ends[text]).astype(np.int32)) for x in (pos, lo, hi)]], ["fp", "num", "line", "pos", "lo", "hi"])
    return keyed.mapInArrow(rows, PRINTS)


def _longest(runs: np.ndarray, words: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    """The longest line of each run, of equals that of the smallest hash."""
    best = runs[:, 0].copy()
    going = np.flatnonzero(best < runs[:, 1])
    new, last = best[going], runs[going, 1]
    old, size = new, words[new]
    while len(going):
        new = new + 1
        other = words[new]
        better = other > size
        tie = np.flatnonzero(other == size)
        better[tie] = hashes[new[tie]] < hashes[old[tie]]
        old, size = np.where(better, new, old), np.where(better, other, size)
        on = new < last
        if not on.all():
            best[going[~on]] = old[~on]
            going, new, last, old, size = (x[on] for x in (going, new, last, old, size))
    return best


def _requests(prints: DataFrame) -> DataFrame:
    """(num, source, wanted): for every document and source the positions whose fingerprint
    the source holds first, and how far these are apart."""
    place = F.shiftleft("num", 31).bitwiseOR(F.col("pos").cast("long"))
    # written, so that a fingerprint which occurs everywhere may be split in the join
    first = written(prints.groupBy("fp").agg(F.min(place).alias("at"), F.count(F.lit(1)).alias("n")).where("n > 1").select("fp", "at"), "first-places")
    first = F.broadcast(first) if first.count() <= BROADCAST_PRINTS else first.hint("shuffle_hash")
    later = prints.join(first, "fp").where(place > F.col("at"))
    wanted = F.struct((F.col("pos") - F.col("at").bitwiseAND((1 << 31) - 1)).cast("int").alias("apart"), "line", "lo", "hi", "pos")
    pairs = later.select("num", F.shiftrightunsigned("at", 31).alias("source"), wanted.alias("w"))
    return written(pairs.groupBy("num", "source").agg(F.collect_list("w").alias("wanted")), "requests")


def _some(keyed: DataFrame, keys: DataFrame) -> DataFrame:
    """The documents whose numbers ``keys`` holds."""
    keys = keys.distinct()
    return keyed.join(F.broadcast(keys) if keys.count() <= BROADCAST_KEYS else keys, "num", "left_semi")


def _signs(single: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """Of each word 31 bits of its hash, and whether it ends a line."""
    out = (single >> np.uint64(33)).astype(np.uint32) << np.uint32(1)
    out[np.cumsum(sizes) - 1] |= np.uint32(1)
    return out


def _slices(sources: DataFrame, kind: str) -> DataFrame:
    """Per document and source the words of the source that the requests can match: ranges
    (first word, words) and the words' signs, one after the other."""
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            source, out = batch.column(1).to_numpy(), [None] * len(batch)
            some, at, which = np.unique(source, return_index=True, return_inverse=True)
            by_source = np.argsort(which, kind="stable")
            edge = np.searchsorted(which[by_source], np.arange(len(some) + 1))
            requests = batch.column(3).flatten()
            aparts, los, his = (requests.field(c).to_numpy() for c in ("apart", "lo", "hi"))
            upto = np.cumsum(np.append(0, pc.list_value_length(batch.column(3)).to_numpy())).tolist()
            for first, single, ends, _, words, offsets in _hashed(batch.column(2)[int(i)].as_py() for i in at):
                signs = _signs(single, words)
                for k in range(len(ends) - 1):
                    own = signs[ends[k]:ends[k + 1]]
                    for i in by_source[edge[first + k]:edge[first + k + 1]].tolist():
                        apart, lo, hi = (x[upto[i]:upto[i + 1]] for x in (aparts, los, his))
                        lo, hi = np.maximum(lo - apart - 1, 0), np.minimum(hi - apart, len(own))  # a word more, whose line end tells a line's start
                        order = np.argsort(lo, kind="stable")
                        lo, reach = lo[order], np.maximum.accumulate(hi[order])
                        new = np.flatnonzero(np.append(True, lo[1:] > reach[:-1]))
                        start, end = lo[new], reach[np.append(new[1:], len(lo)) - 1]
                        out[i] = (start.astype(np.int32), (end - start).astype(np.int32), np.concatenate([own[s:e] for s, e in zip(start, end)]).tobytes())
            columns = list(zip(*out)) or [(), (), ()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(columns[0], pa.list_(pa.int32())), pa.array(columns[1], pa.list_(pa.int32())), pa.array(columns[2], pa.binary()), batch.column(3)],
                                             ["num", "starts", "sizes", "signs", "wanted"])
    return sources.mapInArrow(rows, f"num long, starts array<int>, sizes array<int>, signs binary, wanted {kind}")


class Extension:
    """The words of several documents, one after the other, and which of their windows agree
    with a source. In the second round a request (``exact``) is for the one window that it spans."""

    def __init__(self, single: np.ndarray, ends: np.ndarray, sizes: np.ndarray, hashes: np.ndarray, offsets: np.ndarray, min_words: int, passage: int | None, by_line: bool, exact: bool):
        self.single, self.ends, self.hashes, self.passage, self.exact = single, ends, hashes, passage or 0, exact
        self.signs = _signs(single, sizes)
        line = np.concatenate(([0], np.cumsum(sizes)))
        self.runs = windows(sizes, offsets, min_words) if by_line else np.zeros((0, 2), np.int64)
        self.from_, self.to = line[self.runs[:, 0]], line[self.runs[:, 1] + 1]
        self.print = self.from_ if exact else line[_longest(self.runs, sizes, hashes)]
        # of passages (by first word) and runs: looked up, and found again
        self.asked = [np.zeros(len(single) + 1, bool), np.zeros(len(self.runs), bool)]
        self.found = [np.zeros(len(single) + 1, bool), np.zeros(len(self.runs), bool)]

    def compare(self, document: np.ndarray, ranges: np.ndarray, starts: np.ndarray, sizes: np.ndarray, signs: np.ndarray, requests: np.ndarray, wanted: tuple[np.ndarray, ...]) -> None:
        """Pairs of a document and a source, one after the other: each pair's document, its
        number of ranges and of requests. Sources are laid out 2^33 words apart."""
        apart, line, lo, hi, pos = (c.astype(np.int64) for c in wanted)
        pair = np.repeat(np.arange(len(document)), requests)
        base, lift = self.ends[document][pair], pair << 33
        starts = starts + (np.repeat(np.arange(len(document)), ranges) << 33)
        columns = (apart + base - lift, line, lo + base, hi + base, pos + base, lift)
        order = np.lexsort((columns[2], columns[0]))
        total = np.cumsum((hi - lo)[order])
        cuts = np.searchsorted(total, np.arange(0, (total[-1] if len(total) else 0) + 1, COMPARED), side="left")
        for k, n in zip(cuts, np.append(cuts[1:], len(order))):
            if n > k:
                self._compare(starts, sizes, signs, *(c[order[k:n]] for c in columns))

    def _compare(self, starts, sizes, signs, apart, line, lo, hi, pos, origin) -> None:
        """Requests in the order of (apart, lo): those that overlap share their words."""
        lift = np.concatenate(([0], np.cumsum(np.diff(apart) != 0))) * (1 << 32)
        reach = np.maximum.accumulate(lift + hi)
        new = np.append(True, (lift + lo)[1:] > reach[:-1])
        which, at = np.cumsum(new) - 1, np.flatnonzero(new)
        left = lo[at]
        size = (reach - lift)[np.append(at[1:], len(lo)) - 1] - left
        begin = np.concatenate(([0], np.cumsum(size)))
        place = np.arange(begin[-1]) - np.repeat(begin[:-1] - left, size)   # words of the document
        source = place - np.repeat(apart[at], size)
        offset = np.concatenate(([0], np.cumsum(sizes))) - np.append(starts, 0)

        # a piece's words mostly lie in one range of the source: its ends tell
        near = np.searchsorted(starts, left - apart[at], side="right")
        k = np.repeat(near, size)
        far = np.flatnonzero(np.repeat(near != np.searchsorted(starts, left + size - 1 - apart[at], side="right"), size))
        k[far] = np.searchsorted(starts, source[far], side="right")

        def sign_at(word: np.ndarray, k: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
            k = np.maximum(k - 1, 0)
            inside = (word >= starts[k]) & (word < starts[k] + sizes[k])
            return inside, signs[np.where(inside, offset[k] + word, 0)]
        inside, theirs = sign_at(source, k)
        differ = self.signs[place] ^ theirs
        same = np.concatenate(([0], np.cumsum(inside & (differ <= 1), dtype=np.int32)))
        own = begin[which] - left[which]                                    # from words to places in these arrays
        n = np.where(line == 0, hi - lo - self.passage + 1, 0)
        first = np.repeat(lo, n) + np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
        if len(first):
            to = first + np.repeat(own, n)
            ok = same[to + self.passage] - same[to] == self.passage
            self.asked[0][first] = True
            self.found[0][first[ok]] = True
        rows = np.flatnonzero(line)
        if len(rows):
            whole = np.concatenate(([0], np.cumsum(inside & (differ == 0), dtype=np.int32)))
            k, e = np.searchsorted(self.from_, lo[rows]), np.searchsorted(self.from_, hi[rows])
            r = np.repeat(rows, e - k)
            runs = np.repeat(k, e - k) + np.arange(len(r)) - np.repeat(np.cumsum(e - k) - (e - k), e - k)
            fits = (self.to[runs] == hi[r]) & (self.from_[runs] == lo[r]) if self.exact else (self.to[runs] <= hi[r]) & (self.print[runs] == pos[r])
            runs, r = runs[fits], r[fits]
            s, e = self.from_[runs] + own[r], self.to[runs] + own[r]
            before = self.from_[runs] - apart[r]
            held, sign = sign_at(before - 1, np.searchsorted(starts, before - 1, side="right"))
            ok = (whole[e] - whole[s] == e - s) & ((before == origin[r]) | held & (sign & np.uint32(1) == 1))
            self.asked[1][runs] = True
            self.found[1][runs[ok]] = True

    def deleted(self) -> tuple[np.ndarray, np.ndarray]:
        """First words and ends of what goes; a range ends with its document."""
        s = np.flatnonzero(self.found[0])
        s, e = np.concatenate((s, self.from_[self.found[1]])), np.concatenate((s + self.passage, self.to[self.found[1]]))
        edge = np.bincount(s, minlength=len(self.single) + 1) - np.bincount(e, minlength=len(self.single) + 1)
        cover = np.cumsum(edge)[:-1] > 0
        new = np.zeros(len(self.single) + 1, bool)
        new[self.ends] = True
        before = np.concatenate(([False], cover[:-1]))
        after = np.concatenate((cover[1:], [False]))
        return np.flatnonzero(cover & (~before | new[:-1])), np.flatnonzero(cover & (~after | new[1:])) + 1

    def open(self) -> Iterator[tuple[bool, np.ndarray, np.ndarray, np.ndarray]]:
        """(line, hashes of all words, first words, ends) of windows that were looked up in vain."""
        if self.exact:
            return
        s = np.flatnonzero(self.asked[0] & ~self.found[0])
        yield False, run_hashes(self.single, s, s + self.passage) ^ _PASSAGE, s, s + self.passage
        runs = np.flatnonzero(self.asked[1] & ~self.found[1])
        yield True, run_hashes(self.hashes, self.runs[runs, 0], self.runs[runs, 1] + 1) ^ _LINE, self.from_[runs], self.to[runs]


def _extended(own: DataFrame, min_words: int, passage: int | None, exact: bool) -> DataFrame:
    """Of each document the words to delete (rows without ``fp``), and its open windows as
    fingerprints of the next round."""
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first, single, ends, hashes, sizes, offsets in _hashed(x.as_py() for x in batch.column(1)):
                cells = batch.column(2).slice(first, len(ends) - 1)
                pairs = cells.flatten()
                starts, lengths, signs, wanted = (pairs.field(c) for c in ("starts", "sizes", "signs", "wanted"))
                many = lambda lists: pc.list_value_length(lists).to_numpy()
                asked = wanted.flatten()
                columns = tuple(asked.field(c).to_numpy(zero_copy_only=False) for c in ("apart", "line", "lo", "hi", "pos"))
                one = Extension(single, ends, sizes, hashes, offsets, min_words, passage, bool(columns[1].any()), exact)
                one.compare(np.repeat(np.arange(len(cells)), many(cells)), many(starts), starts.flatten().to_numpy().astype(np.int64), lengths.flatten().to_numpy().astype(np.int64),
                            np.frombuffer(b"".join(signs.to_pylist()), np.uint32), many(wanted), columns)
                s, e = one.deleted()
                out = [(None, np.zeros(len(s), np.int64), s, e), *((line, fp.view(np.int64), s, e) for line, fp, s, e in one.open())]
                none, line = (np.concatenate([np.full(len(x[2]), v) for x, v in zip(out, flags)]) for flags in ([x[0] is None for x in out], [bool(x[0]) for x in out]))
                fp, s, e = (np.concatenate([x[c] for x in out]) for c in (1, 2, 3))
                document = np.searchsorted(ends, s, side="right") - 1
                s, e = ((x - ends[document]).astype(np.int32) for x in (s, e))
                yield pa.RecordBatch.from_arrays([pa.array(fp, mask=none), batch.column(0).take(pa.array(first + document)), pa.array(line), pa.array(s), pa.array(s), pa.array(e)],
                                                 ["fp", "num", "line", "pos", "lo", "hi"])
    return own.mapInArrow(rows, PRINTS)


def _round(keyed: DataFrame, prints: DataFrame, min_words: int, passage: int | None, exact: bool) -> DataFrame:
    """The matches of ``prints`` with their sources, extended: see _extended."""
    requests = _requests(prints)
    sources = _some(keyed, requests.select(F.col("source").alias("num"))).withColumnRenamed("num", "source")
    joined = requests.join(sources, "source").select("num", "source", "text", "wanted")
    slices = _slices(joined, requests.schema["wanted"].dataType.simpleString())
    slices = slices.groupBy("num").agg(F.collect_list(F.struct("starts", "sizes", "signs", "wanted")).alias("slices"))
    own = _some(keyed, requests.select("num")).join(slices, "num").select("num", "text", "slices")
    return written(_extended(own, min_words, passage, exact), "extended")


def repeated_runs(docs: DataFrame, min_words: int = MIN_WORDS, passage_words: int | None = None) -> tuple[DataFrame, DataFrame | None]:
    """(num, s, e): by document the numbers of the words that start, and that end, what occurs
    earlier, in the order of id, hash of the text where ids repeat, and word; and the documents'
    numbers, as of _keyed."""
    keyed, numbers = _keyed(docs)
    one = _round(keyed, written(_fingerprints(keyed, min_words, passage_words), "fingerprints"), min_words, passage_words, False)
    two = _round(keyed, one.where("fp IS NOT NULL"), min_words, passage_words, True)
    gone = one.where("fp IS NULL").unionByName(two.where("fp IS NULL"))
    return gone.groupBy("num").agg(F.collect_list("lo").alias("s"), F.collect_list("hi").alias("e")), numbers


def _cleaned(texts: pd.Series, starts: pd.Series, ends_: pd.Series) -> pd.DataFrame:
    """The texts that have runs without them, the lines that lost words, and the words."""
    out: list[tuple] = [(None, 0, 0)] * len(texts)
    some = [i for i, (text, own) in enumerate(zip(texts, starts)) if own is not None and text is not None]
    for first, _, ends, _, sizes, offsets in _hashed(texts[i] for i in some):
        for k in range(len(ends) - 1):
            i, line = some[first + k], np.concatenate(([0], np.cumsum(sizes[offsets[k]:offsets[k + 1]])))  # first word of each
            data = texts[i].encode("utf-8")
            start = np.append(word_starts(data, "nonspace"), len(data))
            start[0] = 0
            gone = np.bincount(starts[i], minlength=len(start)) - np.bincount(ends_[i], minlength=len(start))
            drop = np.cumsum(gone)[:-1] > 0
            edge = np.flatnonzero(np.diff(drop, prepend=True, append=True))  # kept words from each even one to the next
            kept = b"".join(data[start[a]:start[b]] for a, b in zip(edge[::2], edge[1::2]))
            out[i] = (kept.decode("utf-8"), int(np.logical_or.reduceat(drop, line[:-1]).sum()), int(drop.sum()))
    return pd.DataFrame(out, columns=["text", "n_removed", "words_removed"])


def dedup_lines(docs: DataFrame, min_words: int = MIN_WORDS, passage_words: int | None = None) -> DataFrame:
    """``docs`` (doc_id, text, any other columns) with the cleaned ``text`` and with
    ``n_removed`` (lines that lost words) and ``words_removed``.

    Of every run of whole lines with at least ``min_words`` words that occurs again,
    in any document or the same one, the first occurrence stays; with ``passage_words``,
    so does that of every passage of at least so many words, word by word, wherever its
    lines end. Null and empty texts
    stay as they are. Rows that repeat both id and text count as one document and
    keep the same lines; null ids come first. Columns with the new names are replaced."""
    prepare(docs.sparkSession)
    new = ("n_removed", "words_removed")
    names = [c for c in docs.columns if c not in new]
    one = docs.select(F.struct(*[F.col(f"`{c}`") for c in names]).alias("row"), "doc_id", "text")
    runs, numbers = repeated_runs(one.select("doc_id", "text"), min_words, passage_words)
    if numbers is None:
        keyed, on = one.withColumn("num", F.col("doc_id").cast("long")), ["num"]
    else:
        keyed, on = one.withColumns({"k": _key(), "tie": F.xxhash64("text")}), ["k", "tie"]
        runs = runs.join(numbers, "num").select("k", "tie", "s", "e")
    runs = written(runs, "later-runs")
    n, held = runs.agg(F.count(F.lit(1)), F.coalesce(F.sum(F.size("s")), F.lit(0))).first()
    out = keyed.join(F.broadcast(runs) if n <= BROADCAST_KEYS and held <= BROADCAST_RUNS else runs, on, "left")
    out = out.withColumn("__new", F.pandas_udf(_cleaned, "text string, n_removed long, words_removed long")(F.when(F.col("s").isNotNull(), F.col("text")), "s", "e"))
    return out.select(*[F.coalesce("__new.text", "text").alias("text") if c == "text" else F.col("row")[c].alias(c) for c in names], *[F.col(f"__new.{c}") for c in new])


def op6_lines(spark, sf_dir: str) -> DataFrame:
    """All ``documents`` with later repeated runs of lines, and later repeated passages, deleted."""
    out = dedup_lines(table(spark, sf_dir, "documents").select("doc_id", "text"), passage_words=PASSAGE_WORDS)
    return out.select("doc_id", "n_removed", "words_removed", "text")
