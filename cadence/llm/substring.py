"""Removal of word spans that repeat anywhere in a corpus (operator 8).

A window is ``width`` consecutive words of one text. Every word covered by a
window whose word sequence also starts anywhere else, in the same text or in
another, is removed. Windows are judged on the input.

Suffix automata over the whole corpus would need every text to meet every
automaton. So the corpus is cut into reference shards that need to meet only
the spans which can match them:

1. *Profile* (one scan). Each window picks the smallest fingerprint among its
   word grams as its anchor; equal windows pick equal anchors. Consecutive
   windows with one anchor form a run of at most ``width - gram + 1`` windows.
   Equal texts collapse into one profile row that counts its copies.
2. *Anchors that occur twice or more*, by a counted aggregate; all other runs
   hold no repeated window.
3. *Reference shards.* The word spans of the remaining runs go to their
   anchor's shard. A shard is one suffix automaton with occurrence counts; the
   runs stream through it, and the state that holds the last ``width`` words
   tells whether the window occurs again. The spans of an anchor with more than ``HOT`` occurrences
   would make an unbounded automaton: they are cut into their single windows,
   which are counted with map-side combine and then dealt to shards of their own
   by digest, with automata like any other. Only where a span is cut and which
   shard it meets depends on the anchor; every window is judged by an automaton.
4. The marked windows go back to their texts, and the words that they cover go.

Shards are shipped to the task that streams the runs, not broadcast, because
what repeats grows with the corpus.

Edge cases: a null text is the empty text; texts shorter than ``width`` keep
all words; rows repeated as a whole, and rows that share an id or have none,
are copies like any other; other columns are not looked at.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cadence.llm.common import slices, text_key, whole_text, written
from cadence.llm.words import Words

WIDTH = 35
HOT = 1000          # occurrences of an anchor from which on its spans are cut into windows
_MAX_RUN = 48       # windows of a run fit the bits of a long
_LEAST_ID = -(1 << 63)


def gram_width(width: int) -> int:
    return max(1, width // 3, width - _MAX_RUN + 1)


def sliding_argmin(values: np.ndarray, span: int) -> np.ndarray:
    """Place of the leftmost smallest of ``values[i:i+span]`` for each i that has
    ``span`` values, by doubling."""
    n = len(values) - span + 1
    if n <= 0:
        return np.zeros(0, np.int64)
    best, size = np.arange(len(values)), 1
    while size < span:
        step = min(size, span - size)
        left, right = best[:len(best) - step], best[step:]
        best = np.where(values[right] < values[left], right, left)
        size += step
    return best[:n]


def runs_of_windows(words: Words, width: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(first window, number of windows, anchor) of each run, in order."""
    gram = gram_width(width)
    grams = words.window_fingerprints(words.fingerprints(), gram)
    starts = np.flatnonzero(words.window_starts(width))
    if not len(starts):
        return starts, starts, np.zeros(0, np.int64)
    place = sliding_argmin(grams, width - gram + 1)[starts]
    new = np.flatnonzero(np.r_[True, (place[1:] != place[:-1])])
    return starts[new], np.diff(np.r_[new, len(starts)]), grams[place[new]].view(np.int64)


PROFILE = ("key binary, id long, n_words long, whole_sha256 string, "
           "runs array<struct<first:int,n:int,anchor:long>>")


def _profiles(width: int):
    def profile(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text"):
                words = Words(part.column("text"))
                first, n, anchor = runs_of_windows(words, width)
                body, place = words.normal_bytes()
                cut = words.first
                of_doc = np.searchsorted(first, cut)
                text_of_run = np.searchsorted(cut, first, "right") - 1
                shas = [hashlib.sha256(body[place[a]:max(place[a], place[b] - 1)].tobytes()).hexdigest()
                        for a, b in zip(cut[:-1], cut[1:], strict=True)]
                runs = pa.StructArray.from_arrays(
                    [pa.array((first - cut[text_of_run]).astype(np.int32)), pa.array(n.astype(np.int32)),
                     pa.array(anchor)], names=["first", "n", "anchor"])
                yield pa.RecordBatch.from_arrays(
                    [part.column("key"), part.column("id"), pa.array(words.counts().astype(np.int64)),
                     pa.array(shas, pa.string()),
                     pa.ListArray.from_arrays(pa.array(of_doc.astype(np.int32)), runs)],
                    names=["key", "id", "n_words", "whole_sha256", "runs"])
    return profile


def _keyed(docs: DataFrame, id_column: str, text_column: str) -> DataFrame:
    return docs.select(text_key(text_column).alias("key"),
                       F.coalesce(F.col(id_column).cast("long"), F.lit(_LEAST_ID)).alias("id"),
                       whole_text(text_column).alias("text"))


def profiles(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text",
             width: int = WIDTH) -> DataFrame:
    """One row for each different text: copies, least id, word count, digest of
    its words joined by one space, and its runs of windows."""
    rows = _keyed(docs, id_column, text_column).mapInArrow(_profiles(width), PROFILE)
    return rows.groupBy("key").agg(
        F.min("id").alias("id"), F.count(F.lit(1)).alias("copies"),
        F.any_value("n_words").alias("n_words"), F.any_value("whole_sha256").alias("whole_sha256"),
        F.any_value("runs").alias("runs"))


def _candidates(docs: DataFrame, profile: DataFrame, id_column: str, text_column: str) -> DataFrame:
    """Different texts that hold an anchor found twice or more, with those runs."""
    runs = profile.select("key", "id", "copies", F.inline("runs"))
    # Written, so that the join reads two plain shuffles and Spark can split the
    # rows of a very common anchor over several tasks.
    often = written(runs.groupBy("anchor").agg(F.sum("copies").alias("times"))
                    .where(F.col("times") >= 2), "anchors")
    found = (runs.join(often, "anchor").groupBy("key", "id")
             .agg(F.any_value("copies").alias("copies"),
                  F.collect_list(F.struct("first", "n", "anchor", "times")).alias("runs")))
    # One text for each key: the id picks it, rows repeated as a whole collapse.
    return (_keyed(docs, id_column, text_column).join(found, ["key", "id"])
            .groupBy("key", "id").agg(F.any_value("text").alias("text"),
                                      F.any_value("copies").alias("copies"),
                                      F.any_value("runs").alias("runs")))


SPANS = "route long, digest binary, span binary, weight long, key binary, first int"


def _spans(width: int, hot: int, with_text: bool):
    """The spans of candidate runs: whole runs, or single windows of hot anchors.
    Without the text, the occurrences only."""
    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text"):
                words = Words(part.column("text"))
                body, place = words.normal_bytes()
                raw = body.tobytes()
                runs = part.column("runs")
                flat = runs.flatten()
                lengths = np.asarray(runs.value_lengths().fill_null(0))
                doc = np.repeat(np.arange(part.num_rows), lengths)
                first, n, anchor, times = (np.asarray(flat.field(i)) for i in range(4))
                key, copies = part.column("key").to_pylist(), part.column("copies").to_pylist()
                at = words.first[doc] + first
                out: list[tuple] = []
                for d, f, k, a, t, w in zip(doc.tolist(), first.tolist(), n.tolist(), anchor.tolist(),
                                            times.tolist(), at.tolist(), strict=True):
                    if t <= hot:
                        span = raw[place[w]:place[w + k + width - 1] - 1]
                        out.append((a, hashlib.md5(span).digest(), span if with_text else None, copies[d], key[d], f))
                    else:
                        for i in range(k):
                            span = raw[place[w + i]:place[w + i + width] - 1]
                            digest = hashlib.md5(span).digest()
                            out.append((int.from_bytes(digest[:8], "little", signed=True), digest, span if with_text else None,
                                        copies[d], key[d], f + i))
                for i in range(0, len(out), 20_000):
                    columns = list(zip(*out[i:i + 20_000], strict=True))
                    kinds = (pa.int64(), pa.binary(), pa.binary(), pa.int64(), pa.binary(), pa.int32())
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(c, kind) for c, kind in zip(columns, kinds, strict=True)],
                        names=["route", "digest", "span", "weight", "key", "first"])
    return emit


class SuffixAutomaton:
    """Suffix automaton of several word sequences, each with a weight; after
    ``close`` every state knows how often, weights counted, its words occur."""

    def __init__(self) -> None:
        self.next: list[dict[bytes, int]] = [{}]
        self.link, self.length, self.count = [-1], [0], [0]

    def _state(self, length: int, follow: dict[bytes, int], link: int, count: int) -> int:
        self.next.append(follow)
        self.length.append(length)
        self.link.append(link)
        self.count.append(count)
        return len(self.link) - 1

    def _split(self, p: int, word: bytes, q: int) -> int:
        """The part of state q reached from p by one word, as a state of its own."""
        copy = self._state(self.length[p] + 1, dict(self.next[q]), self.link[q], 0)
        self.link[q] = copy
        while p >= 0 and self.next[p].get(word) == q:
            self.next[p][word] = copy
            p = self.link[p]
        return copy

    def add(self, sequence: list[bytes], weight: int) -> None:
        last = 0
        for word in sequence:
            q = self.next[last].get(word)
            if q is not None:
                last = q if self.length[q] == self.length[last] + 1 else self._split(last, word, q)
                self.count[last] += weight
                continue
            state, p = self._state(self.length[last] + 1, {}, 0, weight), last
            while p >= 0 and word not in self.next[p]:
                self.next[p][word] = state
                p = self.link[p]
            if p >= 0:
                q = self.next[p][word]
                self.link[state] = q if self.length[q] == self.length[p] + 1 else self._split(p, word, q)
            last = state

    def close(self) -> None:
        for state in sorted(range(1, len(self.link)), key=self.length.__getitem__, reverse=True):
            self.count[self.link[state]] += self.count[state]

    def windows(self, sequence: list[bytes], width: int) -> Iterator[tuple[int, int]]:
        """Matching statistics of a sequence, cut off at ``width``: for each
        window matched whole, where it starts and how often it occurs."""
        state = matched = 0
        for end, word in enumerate(sequence):
            while state and word not in self.next[state]:
                state = self.link[state]
                matched = self.length[state]
            if word in self.next[state]:
                state, matched = self.next[state][word], matched + 1
            while matched >= width and self.length[self.link[state]] >= width:
                state = self.link[state]
            matched = min(matched, width)
            if matched == width:
                yield end - width + 1, self.count[state]


def repeated_in_shard(spans: list[bytes], weights: list[int], width: int) -> list[int]:
    """For each different span a number whose bit i says that the window from
    word i on occurs twice or more in the shard."""
    sequences = [span.split(b" ") for span in spans]
    automaton = SuffixAutomaton()
    for sequence, weight in zip(sequences, weights, strict=True):
        automaton.add(sequence, weight)
    automaton.close()
    return [sum(1 << start for start, times in automaton.windows(s, width) if times > 1) for s in sequences]


def _shards(width: int):
    """Rows of one route come together, ordered by digest."""
    def resolve(route: int, group: dict[bytes, list]) -> list[tuple[int, bytes, int]]:
        marks = repeated_in_shard([g[0] for g in group.values()], [g[1] for g in group.values()], width)
        return [(route, digest, mark) for digest, mark in zip(group, marks, strict=True) if mark]

    def stream(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        route, group, out = None, {}, []

        def table() -> pa.RecordBatch:
            columns = list(zip(*out, strict=True)) if out else [[], [], []]
            out.clear()
            return pa.RecordBatch.from_arrays(
                [pa.array(c, k) for c, k in zip(columns, (pa.int64(), pa.binary(), pa.int64()), strict=True)],
                names=["route", "digest", "marks"])

        for batch in batches:
            for r, digest, span, weight in zip(*(batch.column(c).to_pylist()
                                                 for c in ("route", "digest", "span", "weight")), strict=True):
                if r != route:
                    if group:
                        out.extend(resolve(route, group))
                    route, group = r, {}
                group.setdefault(digest, [span, 0])[1] += weight
            if len(out) > 20_000:
                yield table()
        if group:
            out.extend(resolve(route, group))
        yield table()
    return stream


def _cut(width: int):
    """Texts without the words that marked windows cover."""
    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text"):
                words = Words(part.column("text"))
                marked = part.column("marked")
                lengths = np.asarray(marked.value_lengths().fill_null(0))
                flat = marked.flatten()
                at = words.first[np.repeat(np.arange(part.num_rows), lengths)] + np.asarray(flat.field(0))
                marks = np.asarray(flat.field(1))
                edge = np.zeros(len(words) + width + 1, np.int64)
                for bit in range(_MAX_RUN):
                    on = at[(marks >> bit) & 1 == 1] + bit
                    np.add.at(edge, on, 1)
                    np.add.at(edge, on + width, -1)
                keep = np.cumsum(edge)[:len(words)] == 0
                body, place = words.normal_bytes()
                size = np.diff(place)
                kept_body = body[np.repeat(keep, size)]
                kept_words = np.r_[0, np.cumsum(keep)][words.first]
                kept_bytes = np.r_[0, np.cumsum(np.where(keep, size, 0))][words.first]
                texts = [kept_body[a:max(a, b - 1)].tobytes()
                         for a, b in zip(kept_bytes[:-1], kept_bytes[1:], strict=True)]
                yield pa.RecordBatch.from_arrays(
                    [part.column("key"), pa.array(words.counts() - np.diff(kept_words), pa.int64()),
                     pa.array([t.decode() for t in texts], pa.string()),
                     pa.array([hashlib.sha256(t).hexdigest() for t in texts], pa.string())],
                    names=["key", "n_removed", "kept_text", "kept_sha256"])
    return cut


def cut_texts(docs: DataFrame, profile: DataFrame, id_column: str = "doc_id", text_column: str = "text",
              width: int = WIDTH, hot: int = HOT) -> DataFrame:
    """(key, n_removed, kept_text, kept_sha256) of every different text that
    loses words. ``profile``: ``profiles`` of the same rows and width, written."""
    texts = written(_candidates(docs, profile, id_column, text_column), "candidates")
    # Equal spans of a task, and above all the windows of hot anchors, travel once.
    spans = (texts.mapInArrow(_spans(width, hot, True), SPANS).groupBy("route", "digest")
             .agg(F.any_value("span").alias("span"), F.sum("weight").alias("weight")))
    judged = (spans.repartition("route").sortWithinPartitions("route", "digest")
              .mapInArrow(_shards(width), "route long, digest binary, marks long"))
    places = texts.mapInArrow(_spans(width, hot, False), SPANS).select("route", "digest", "key", "first", "weight")
    marked = (places.join(judged, ["route", "digest"]).groupBy("key")
              .agg(F.collect_list(F.struct("first", "marks")).alias("marked")))
    return (texts.select("key", "text").join(marked, "key")
            .mapInArrow(_cut(width), "key binary, n_removed long, kept_text string, kept_sha256 string"))


def without_repeats(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text",
                    width: int = WIDTH) -> DataFrame:
    """All columns of ``docs``; texts that lose words become their kept words
    joined by one space, other texts stay as they are."""
    profile = written(profiles(docs, id_column, text_column, width), "profiles")
    cut = written(cut_texts(docs, profile, id_column, text_column, width), "cut")
    # The rows as one column, so that no name of theirs clashes.
    rows = docs.select(F.struct(*[F.col(_quoted(c)) for c in docs.columns]).alias("row"), text_key(_quoted(text_column)).alias("key"))
    joined = rows.join(cut.select("key", "kept_text"), "key", "left")
    return joined.select(*[F.coalesce("kept_text", F.col("row")[c]).alias(c) if c == text_column else F.col("row")[c].alias(c)
                           for c in docs.columns])


def _quoted(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def removal_report(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text",
                   width: int = WIDTH) -> DataFrame:
    """One row for each row of ``docs``: id, n_words, n_removed, kept_sha256."""
    profile = written(profiles(docs, id_column, text_column, width), "profiles")
    cut = cut_texts(docs, profile, id_column, text_column, width).drop("kept_text")
    # Written, so that the join below can split a text that many rows share.
    texts = written(profile.select("key", "n_words", "whole_sha256").join(cut, "key", "left")
                    .select(F.col("key").alias("__key"), "n_words",
                            F.coalesce("n_removed", F.lit(0)).cast("long").alias("n_removed"),
                            F.coalesce("kept_sha256", "whole_sha256").alias("kept_sha256")), "texts")
    rows = docs.select(F.col(id_column), text_key(text_column).alias("__key"))
    return rows.join(texts, "__key").select(id_column, "n_words", "n_removed", "kept_sha256")
